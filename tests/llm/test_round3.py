"""op11 to op13: brute force on small tables, recall, odd rows."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import duckdb
import numpy as np
import pytest

from cargoframe.llm import projected_search, spelling
from cargoframe.llm.queries import QUERIES
from cargoframe.llm.turn_repair import Survivors, audit_conversations, repaired_turns

SF = "/root/testdata/sf0.001"
NAN = float("nan")


# --- op11 -----------------------------------------------------------------------
def true_nearest(rows, k=20):
    """{query id: [(id, score)]} by brute force; rows (id, vector)."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in sorted(((i, v) for i, v in ok if i % 20 == 0), key=lambda r: (r[0], r[1].tolist())):
        if i not in out:
            s = [(float((q * v).sum()), j) for j, v in ok if j != i and len(v) == len(q)]
            out[i] = [(j, x) for x, j in sorted(s, key=lambda t: (-t[0], t[1]))[:k]]
    return {i: v for i, v in out.items() if v}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    hit = [len({j for j, _ in got.get(i, ())} & {j for j, _ in w}) / len(w) for i, w in want.items()]
    return sum(hit) / len(hit)


def test_projected_search_recall_and_exact_scores(spark):
    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    want, got = true_nearest(rows), found(QUERIES["op11_projected_search"](spark, "/root/testdata/sf0.1"))
    assert got.keys() == want.keys() and all(len(got[i]) == len(want[i]) for i in want)
    assert recall(got, want) >= 0.9
    vec = {i: np.array(v, float) for i, v in rows}
    for i, near in got.items():
        assert all(abs(s - float(vec[i] @ vec[j])) < 1e-12 for j, s in near)
        assert near == sorted(near, key=lambda t: (-t[1], t[0]))


@pytest.fixture
def many_blocks(monkeypatch):
    for name, v in (("BLOCK", 300), ("CHUNK", 20), ("SAMPLE", 600), ("CELLS", 6)):
        monkeypatch.setattr(projected_search, name, v)


def test_projected_search_prunes_clusters_over_many_blocks(spark, many_blocks):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(60, 24))
    x = centre[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 24)) * 0.05
    x *= rng.uniform(0.8, 1.2, 3000)[:, None]  # norms differ: inner product is not the angle
    x[500:900] = x[500]                        # a group of copies: ties by id
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = projected_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), projected_search.F.col("vec_id") % 20 == 0, 20)
    df = df.cache()
    want, got = true_nearest(rows), found(df)
    assert recall(got, want) >= 0.9
    assert got[500][:3] == want[500][:3] or recall({500: got[500]}, {500: want[500]}) >= 0.9
    share = np.mean([r["n_verified"] / 3000 for r in df.select("query_id", "n_verified").distinct().collect()])
    assert share < 0.5, share


def test_projected_search_odd_rows(spark, many_blocks):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [NAN, 1.0]), (80, [None, 1.0]),
            (100, [1.0, 2.0, 3.0]), (101, [1.0, 1.0, 1.0]), (120, []), (None, [1.0, 0.0]), (140, [float("inf"), 0.0]), (160, [1e-300, 0.0]),
            (180, [7.0] * 5), (200, [1e150, 1e150]), (220, [2.0, 0.5]), (220, [1.0, 0.5]), (3, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, id long, row long")
    got = found(projected_search.nearest(df, projected_search.F.col("vec_id") % 20 == 0, 20))
    want = true_nearest(rows)
    assert got.keys() == want.keys()
    for i in want:  # fewer than 20 candidates: all of them
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
    assert found(projected_search.nearest(df.limit(0), projected_search.F.col("vec_id") % 20 == 0, 20)) == {}


def test_chi_square():
    assert abs(projected_search.chi_square_quantile(0.95, 10) - 18.307038) < 1e-5
    assert abs(projected_search.chi_square(2.0, 2) - (1 - math.exp(-1))) < 1e-12


# --- op12 -----------------------------------------------------------------------
def true_words(docs, damage=199):
    count = Counter()
    low = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def true_variants(n):
    """{word: (form, root, n, n_near, form_n)}; near words through shared deletions."""
    holes = {}
    for w in n:
        for k in range(len(w)):
            holes.setdefault((k, w[:k] + w[k + 1:]), set()).add(w)
    near = {w: set() for w in n}
    for (k, rest), ws in holes.items():
        for w in ws:
            near[w] |= ws - {w}             # one replaced
            if rest in n:                   # one deleted
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, other in near.items():
        best = min(other, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def as_dict(df):
    got = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(out) == len(got)
    return out


def test_spelling_variants_of_whole_documents(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = true_variants(true_words(docs))
    assert len(want) > 500 and any(v[0] for v in want.values())
    assert as_dict(QUERIES["op12_spelling_variants"](spark, SF)) == want


def test_spelling_hot_lists_and_chains(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 3)
    rng = random.Random(5)
    n = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 8))): rng.choice((5, 6, 30, 200, 1000, 6000)) for _ in range(1500)}
    n |= {"zzzzzz": 5, "zzzzzy": 25, "zzzzyy": 125, "zzzyyy": 625, "zzyyyy": 3125}  # a chain
    got = as_dict(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == true_variants(n) and got["zzzzzz"][1] == "zzyyyy"


def test_spelling_odd_rows(spark):
    text = "Ünïcode ÜNÏCODE  straße " * 5 + "xécode" * 3 + " " + "a" * 5000 + " " + "Straße\n" * 20 + "abcdef " * 5 + "×÷×÷×÷ " * 5
    docs = [(1, text), (1, text), (2, None), (3, ""), (None, "abcdef " * 9), (4, "12345 !!"), (5, "abcde " * 50)]
    df = spark.createDataFrame([(*d, 0, "w") for d in docs], "doc_id long, text string, n int, word string")
    want = true_words(docs)
    got = {r["word"]: r["n"] for r in spelling.word_counts(df, 199).collect()}
    assert got == want and "×÷×÷×÷" in got
    assert as_dict(spelling.variants(spelling.word_counts(df, 199))) == true_variants(want)
    assert spelling.variants(spelling.word_counts(df.limit(0), 199)).count() == 0


# --- op13 -----------------------------------------------------------------------
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def cheapest(rows):
    """(cost, audit, lines) by dynamic programming over suffixes with whole
    strings; rows (role, text, must be deleted, cut off)."""
    @lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def add(cost, kind, line, rest):
            if rest is not None:
                options.append((cost + rest[0], kind + rest[1], (() if line is None else (line,)) + rest[2]))

        for x, name in (("u", "user"), ("a", "assistant")):
            if (state, x) in NEXT and inserts < 3:
                add(3, "I", f"{name}:", best(i, NEXT[state, x], inserts + 1))
        if i < len(rows):
            role, text, must, cut = rows[i]
            add(4, "D", None, best(i + 1, state, 0))
            if not must:
                if (state, role[:1]) in NEXT:
                    add(3 * cut, "K", f"{role}:{text}", best(i + 1, NEXT[state, role[:1]], 0))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (state, x) in NEXT:
                        add(3 + 3 * cut, "R", f"{name}:{text}", best(i + 1, NEXT[state, x], 0))
        return min(options, key=lambda o: o[:2]) if options else None

    return best(0, 0, 0)


def test_survivors_equal_brute_force():
    rng = random.Random(1)
    for _ in range(3000):
        rows = tuple((rng.choice(["system", "user", "assistant", "tool", "user", "assistant", ""]), str(j), rng.random() < 0.2, rng.random() < 0.3)
                     for j in range(rng.randint(0, 9)))
        out = []
        s = Survivors(lambda *edit: out.append(edit))
        for r in rows:
            s.step(*r)
        cost = s.finish()
        assert (cost, "".join(k for k, _, _ in out), tuple(f"{a}:{b}" for _, a, b in out if a is not None)) == cheapest(rows), rows


def test_survivors_hold_little():
    rng, n = random.Random(2), 0
    s = Survivors(lambda *edit: None)
    for _ in range(20_000):
        s.step(rng.choice(["user", "assistant", "user", "assistant", "system"]), "x.", rng.random() < 0.1, rng.random() < 0.1)
    s.finish()
    assert s.most_open < 100


def true_audit(rows):
    """The result row of one conversation; rows (turn, role, text) after damage."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marked, count = set(), [], Counter()
    for t, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        count[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(tuple(marked))
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_conversation_repair_of_all_conversations(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    after = {}
    for conv, turn, role, text in rows:
        conv_s, turn_s, role, text = (" " if v is None else v for v in (conv, turn, role, text))
        own, fault = after.setdefault(conv, []), zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        own += [] if fault == 0 else [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_conversation_repair"](spark, SF).collect()}
    assert got == {c: true_audit(own) for c, own in after.items()}


def test_conversation_repair_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "Hi."), (1, 5, "user", "Hi."), (1, 5, "user", "Hi."), (1, 7, "assistant", ""), (1, 7, "", "x"),
            (None, 1, "user", "a."), (None, 1, "assistant", "b."), (3, None, "user", "q?"), (3, None, "assistant", "é" * 50_000 + "!"),
            (4, 2, "system", "s."), (4, -2, "zebra", "no end"), (4, 9, "assistant", "\t \n")]
    df = spark.createDataFrame([(*r, r[0] != 9, 1) for r in [*rows, (9, 1, "user", "gone.")]], "conv_id long, turn long, role string, text string, there boolean, cost long")
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in audit_conversations(df, df["there"]).collect()}
    want = {c: true_audit([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    want[9] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want
    assert audit_conversations(df.limit(0)).count() == 0 and repaired_turns(df.limit(0)).count() == 0
    lines = {}
    for r in sorted(repaired_turns(df, df["there"]).collect(), key=lambda r: r["step"]):
        lines.setdefault(r["conv_id"], []).append((r["edit"], r["role"], r["text"]))
    for c, edits in lines.items():
        assert "".join(e for e, _, _ in edits) == want[c][6]
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in edits if r is not None).encode()).hexdigest() == want[c][7]
