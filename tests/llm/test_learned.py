"""op3, op6, op10: held-out accuracy, plain-pattern spans, odd rows."""
import hashlib
import random
import re

import numpy as np
import pytest

from cargoframe.llm import langid, pii_crf, toxicity
from cargoframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ODD = [None, "", " ", "½ 12 !!", "é", "a" * 30000, "hello " * 9000, "漢字"]


def table(spark, name, *cols):
    return spark.read.parquet(f"{SF}/{name}.parquet").select(*cols)


def odd(spark, extra="'en' as lang"):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, ""), (None, "some words")]
    return spark.createDataFrame([(i, t, 1.0, "q") for i, t in rows], "doc_id long, text string, score double, spans string").selectExpr("*", extra)


def test_toxicity_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, SF).collect()}
    docs = table(spark, "documents", "doc_id").count()
    assert len(got) == docs and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    marks = [(r["toxic"], got[r["doc_id"]]) for r in table(spark, "labels", "doc_id", "toxic").collect()]
    held = [(y, r["predicted"]) for y, r in marks if r["held_out"]]
    assert np.mean([y == p for y, p in held]) >= 0.95
    clean = [p for y, p in ((y, r["predicted"]) for y, r in marks) if y == 0]
    assert np.mean(clean) <= 0.01


def test_toxicity_odd_rows(spark):
    docs, labels = odd(spark), spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    got = toxicity.score(docs, model, ("doc_id", "spans")).collect()
    assert len(got) == len(ODD) + 2 and all(0 < r["score"] < 0.5 for r in got)
    bad = spark.createDataFrame([(1, "you stupid pathetic idiot")], "doc_id long, text string")
    assert toxicity.score(bad, model, ("doc_id",)).first()["score"] > 0.5
    one_class = spark.createDataFrame([(0, 0), (1, 0), (1, 7), (None, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs.select("doc_id", "text"), one_class), ("doc_id",)).count() == len(ODD) + 2
    assert toxicity.score(docs.limit(0), model, ("doc_id",)).count() == 0


def test_label_model_finds_accuracies_and_correlations():
    """Without any mark: the hidden label comes out of the votes alone."""
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    right = lambda acc: 2 * np.where(rng.random(4000) < acc, y, ~y).astype(int) - 1
    a, b, c, d, noise = right(0.7), right(0.9), right(0.85), right(0.8), right(0.5)
    votes = np.stack([a, a, a, b, c, d, noise], 1)  # a voter that stands three times must not outvote the others
    post, est = toxicity.label_model(votes, 0.3)
    alone, _ = toxicity.label_model(votes[:, 2:], 0.3)
    assert [0, 1, 2] in est["factors"] and ((post > 0.5) == y).mean() >= ((alone > 0.5) == y).mean() - 0.01 > 0.9
    for i, acc in ((0, 0.7), (3, 0.9), (4, 0.85), (5, 0.8), (6, 0.5)):
        assert abs((est["rates"][i, 1, 2] + est["rates"][i, 0, 0]) / 2 - acc) < 0.06


def test_label_model_posterior_equals_enumeration():
    """The posterior is Bayes' rule over the estimated factors, row by row."""
    rng = np.random.default_rng(1)
    y = rng.random(1500) < 0.4
    votes = np.stack([np.where(rng.random(1500) < p, 2 * y.astype(int) - 1, rng.integers(-1, 2, 1500)) for p in (0.8, 0.7, 0.6, 0.5)], 1)
    post, est = toxicity.label_model(votes, 0.4, rounds=400)
    assert est["factors"] == [[0], [1], [2], [3]]
    for i in range(0, 1500, 50):
        joint = [prior * np.prod([est["rates"][m, label, votes[i, m] + 1] for m in range(4)]) for label, prior in ((0, 0.6), (1, 0.4))]
        assert abs(post[i] - joint[1] / sum(joint)) < 1e-3


def test_marks_choose_voters_but_do_not_vote(spark):
    """Turning a few marks round changes no posterior beyond what the choice of voters does."""
    hits, toxic = np.array([0, 0, 1, 1, 2, 3, 5, 4]), np.array([0, 0, 0, 0, 1, 1, 1, 1])
    assert toxicity.count_voters(hits, toxic)[:, 0].tolist() == [-1, -1, -1, -1, 1, 1, 1, 1]
    turned = toxic.copy()
    turned[0] = 1
    assert (toxicity.count_voters(hits, turned) == toxicity.count_voters(hits, toxic)).all()


def test_language_held_out(spark):
    got = QUERIES["op6_language_id"](spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in table(spark, "documents", "doc_id", "lang").collect()}
    held = [lang[r["doc_id"]] == r["lang_pred"] for r in got if r["held_out"]]
    assert len(got) == len(lang) and np.mean(held) >= 0.99 and all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(spark):
    train = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("no words", None), (None, "en")])],
                                  "doc_id long, text string, lang string")
    model = langid.learn(train)
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in langid.predict(odd(spark), model).collect()}
    for i in (0, 1, 2, 3):
        assert got[(i, "und")] == 0
    assert all((i, "und") not in got for i in (4, 5, 6))
    more = spark.createDataFrame([(1, "THE dogs"), (2, "katzen und hunde"), (3, "zzz qqq")], "doc_id long, text string")
    assert [r["lang_pred"] for r in sorted(langid.predict(more, model).collect(), key=lambda r: r["doc_id"])][:2] == ["en", "de"]
    empty = langid.learn(train.limit(0))
    assert {r["lang_pred"] for r in langid.predict(odd(spark), empty).collect()} == {"und"}
    assert langid.predict(odd(spark).limit(0), model).count() == 0


def plain_language(train, text, langs):
    """The method as it is written, one word and language at a time."""
    counts = {(x, n): {} for x in langs for n in range(5)}
    for t, x in train:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            for n, grams in [(0, [w]), (1, list(w))] + [(n, [f" {w} "[i:i + n] for i in range(len(w) + 3 - n)]) for n in (2, 3, 4)]:
                for g in grams:
                    counts[x, n][g] = counts[x, n].get(g, 0) + 1

    def log_share(x, n, g):
        own = counts[x, n]
        return np.log(own.get(g, 0) + 0.5) - np.log(sum(own.values()) + 0.5 * len(own))
    total, words = dict.fromkeys(langs, 0.0), re.findall(r"[^\W\d_]+", text.lower())
    for w in words:
        if any(w in counts[x, 0] for x in langs):
            for x in langs:
                total[x] += log_share(x, 0, w)
            continue
        for n in (4, 3, 2, 1):
            grams = list(w) if n == 1 else [f" {w} "[i:i + n] for i in range(len(w) + 3 - n)]
            known = [g for g in grams if any(g in counts[x, n] for x in langs)]
            if known:
                for x in langs:
                    total[x] += float(np.mean([log_share(x, n, g) for g in known]))
                break
    mean = np.array([total[x] for x in langs]) / len(words)
    p = np.exp((mean - mean.max()) * min(len(words), 10))
    return langs[int(p.argmax())], float(1 / p.sum())


def test_language_equals_a_plain_scorer(spark):
    docs = [r for r in table(spark, "documents", "doc_id", "text", "lang").collect() if r["text"] and r["lang"] and len(r["text"]) < 600][:60]
    train = [(r["text"], r["lang"]) for r in docs[:40]]
    model = langid.learn(spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(train)], "doc_id long, text string, lang string"))
    langs = sorted({x for _, x in train})
    ask = [(i, r["text"]) for i, r in enumerate(docs)] + [(100, "the thzzq qqqq Éà"), (101, "x")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(spark.createDataFrame(ask, "doc_id long, text string"), model).collect()}
    for i, t in ask:
        if re.search(r"[^\W\d_]", t):
            want = plain_language(train, t, langs)
            assert got[i][0] == want[0] and abs(got[i][1] - want[1]) < 1e-9, (i, got[i], want)


def test_more_than_a_thousand_languages(spark):
    text = lambda x: " ".join(chr(0x4E00 + x) + end for end in ("ax", "by", "cz"))  # noqa: E731  each language has words of its own
    rows = [(x * 3 + j, text(x), f"l{x:04}") for x in range(1100) for j in range(3)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=2, sample_docs=1500)
    assert len(model["langs"]) == 1100 and sum(len(t[1]) for t in model["tables"]) < 200_000
    ask = [(x, text(x)) for x in range(0, 1100, 7)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(spark.createDataFrame(ask, "doc_id long, text string"), model).collect()}
    assert got == {x: f"l{x:04}" for x, _ in ask}


def plain_spans(text):
    """The contract's patterns as they are written."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    card = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m.group())) <= 19 and pii_crf.luhn(digits(m.group()))]
    phone = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m.group())) <= 15]
    return [email, ip, card, phone]


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_equal_the_patterns(seed):
    rng = random.Random(seed)
    for _ in range(3000):
        t = "".join(rng.choice("a.1@+- 2(5)é٣_0,b%9") for _ in range(rng.randint(0, 40)))
        assert pii_crf.base_spans(t) == plain_spans(t), t
    t = "4111 1111-1111 1111 +1 (212) 555-0199; 255.255.0.1.7 a.b@c.d.e@f.g 4111111111111112"
    assert pii_crf.base_spans(t) == plain_spans(t) and all(plain_spans(t))


def test_long_runs_take_linear_time():
    for t in ("1" * 300000, "a" * 300000 + "@", "a@" * 100000, "+1" * 100000, "1." * 100000, "1 " * 100000 + "x"):
        pii_crf.base_spans(t)


def test_pii_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents", "doc_id", "text").collect()}
    got = QUERIES["op10_pii"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain_spans(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii_crf.KINDS] == [len(b) for b in base]
        assert r["base_sha256"] == hashlib.sha256(pii_crf.joined(base).encode()).hexdigest()
        assert set(filter(None, pii_crf.joined(base).split(","))) <= set(filter(None, r["spans"].split(",")))


def test_field_labels_repeated_mentions(spark):
    rng = random.Random(1)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(300):
        phone, name = f"+1 ({num(3)}) {num(3)}-{num(4)}", f"user{num(3)}.x"
        rows.append(f"call {phone} now or {phone} later, mail {name}@mail.org and {name}@mail.org, order {num(9)}, order {num(9)}, ip {rng.randrange(256)}.1.2.3")
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    model = pii_crf.learn(docs)
    text = "mail user77.x@mail.org or call +1 (212) 555-0199. " + "much later words " * 40 + " 212-555-0199 and user77.x, order 123456789"
    base = pii_crf.base_spans(text)
    more = pii_crf.added_spans(text, base, model)
    assert [text[s:e] for s, e in more[3]] == ["212-555-0199"] and [text[s:e] for s, e in more[0]] == ["user77.x"]
    assert not more[1] and not more[2]
    clean = pii_crf.redact(text, model)
    assert "0199" not in clean and "user77" not in clean and "123456789" in clean
    assert pii_crf.added_spans("order 123456789 and 123456789", [[], [], [], []], model) == [[], [], [], []]


def test_message_passing_equals_enumeration():
    """On a chain (no loop) the marginals are exact."""
    rng = np.random.default_rng(0)
    unary, pots = rng.normal(size=(4, 5)), rng.normal(size=(2, 5, 5))
    edges = [(0, 1, 0), (1, 2, 1), (2, 3, 0)]
    p = np.zeros((5,) * 4)
    for idx in np.ndindex(p.shape):
        p[idx] = np.exp(sum(unary[i, idx[i]] for i in range(4)) + sum(pots[k, idx[a], idx[b]] for a, b, k in edges))
    want = np.stack([p.sum(tuple(j for j in range(4) if j != i)) / p.sum() for i in range(4)])
    assert np.allclose(pii_crf.marginals(unary, edges, pots), want)


def test_pii_odd_rows(spark):
    docs = odd(spark)
    got = pii_crf.find_pii(docs, pii_crf.learn(docs), ("doc_id", "score")).collect()
    assert len(got) == len(ODD) + 2 and all(r["spans"] == "" for r in got)
    assert pii_crf.find_pii(docs.limit(0), pii_crf.learn(docs.limit(0))).count() == 0
