"""op7, op9: brute force over the small tables, odd rows and small blocks."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cargoframe.llm import superminhash, suffix_dedup
from cargoframe.llm.common import connected_components
from cargoframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def word_sets(texts, k):
    def one(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return {d: one(t) for d, t in texts.items()}


def brute_components(sets, percent=80):
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def check_near(rows, texts, k):
    sets = word_sets(texts, k)
    want = brute_components(sets)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {d: (len(sets[d]), want[d], want[d] == d) for d in texts}


def near_texts(seed=0):
    """A base text, copies at many distances, chains, shorts and empties."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(60)]
    texts = []
    for i in range(120):
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
    chain = [word() for _ in range(50)]
    for i in range(20):
        texts.append(" ".join(chain[i:] + [word() for _ in range(i)]))
    texts += ["", None, "  ", "one", "ONE", "one two", "One\ttwo\n", "a b c d", "a b c d e", " ".join(base).upper(), "É é", "é É", "x " * 5000, "x " * 400, "x y " * 3000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return {10 * i + 1: texts[o] for i, o in enumerate(order)}


def test_near_duplicates_query(spark):
    check_near(QUERIES["op7_superminhash"](spark, SF).collect(), documents(spark), 4)


@pytest.mark.parametrize("batch,block", [(256, 2048), (5, 16)])
def test_near_duplicates_hard_group(spark, monkeypatch, batch, block):
    monkeypatch.setattr(superminhash, "BATCH", batch)
    monkeypatch.setattr(superminhash, "BLOCK", block)
    texts = near_texts()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in texts.items()], "doc_id long, text string, id long, digest string")
    check_near(superminhash.near_duplicates(df, 4).collect(), texts, 4)


def test_near_duplicates_ids(spark):
    t = "a b c d e f g h"
    rows = [(5, t), (5, t), (None, t), (3, t), (7, "z y x w v"), (7, "other words are here now"), (9, "other words are here now")]
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("5", 3, False), ("5", 3, False), ("None", None, True), ("3", 3, True), ("7", 7, True), ("7", 7, True), ("9", 7, False)], key=str)
    assert superminhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_superminhash_estimates_and_blocks(monkeypatch):
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 9000).astype(np.uint64)
    agree = []
    for _ in range(60):
        own = rng.integers(0, 2**63, 1000).astype(np.uint64)
        a, b = np.unique(own[:900]), np.unique(own[100:])
        agree.append((superminhash.signature(a) == superminhash.signature(b)).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02 and np.std(agree) < 0.06
    whole = superminhash.signature(np.unique(pool))
    monkeypatch.setattr(superminhash, "BLOCK", 7)
    assert (superminhash.signature(np.unique(pool)) == whole).all()
    one = superminhash.signature(pool[:1])  # one element visits all positions once
    assert sorted(one >> np.uint64(32)) == list(range(superminhash.SIZE))


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5, 5)]
    root = {x: x for p in links for x in p}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(links, "a long, b long").repartition(16), "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for p in links if p[0] != p[1] for x in p}
    assert len(got) == len({r["node"] for r in got})


def brute_removal(texts, length):
    """texts: list; per text (n_bytes, n_removed, n_spans, digest)."""
    seen = Counter()
    for t in texts:
        b = (t or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for t in texts:
        b = (t or "").encode()
        cut = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                cut[i + 1:i + length + 1] = True
        out.append((len(b), int(cut.sum()), int((np.diff(cut.astype(int)) == 1).sum()),
                    hashlib.sha256(bytes(c for c, x in zip(b, cut[1:]) if not x)).hexdigest()))
    return out


def run_removal(spark, texts, length):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, rep long, start int").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.removal_digests(df, length).collect()}
    return [got[i] for i in range(len(texts))]


def test_removal_query(spark):
    docs = documents(spark)
    want = dict(zip(docs, brute_removal(list(docs.values()), 200)))
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op9_suffix_dedup"](spark, SF).collect()} == want


@pytest.mark.parametrize("small", [False, True])
def test_removal_odd_texts(spark, monkeypatch, small):
    if small:
        for name, v in (("CHUNK", 64), ("BATCH", 16), ("KINDS", 3)):
            monkeypatch.setattr(suffix_dedup, name, v)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé ") for _ in range(30))
    passage = " ".join(word() for _ in range(8))
    texts = [None, "", "short", "é" * 300, "ab" * 500, passage + "x", "y" + passage, word() + passage[:60] + word(), "z" + passage[20:150] + "\x00" * 90]
    texts += [passage[:k] + word() + passage[k:] for k in range(0, 200, 9)]
    texts += ["same text " * 30, "same text " * 30, "".join(word() for _ in range(400))]
    assert run_removal(spark, texts, 50) == brute_removal(texts, 50)
    assert run_removal(spark, texts[:3], 50) == brute_removal(texts[:3], 50)
    assert suffix_dedup.removal_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_removal_repeated_and_null_ids(spark):
    a, b = "".join(map(str, range(200))), "".join(map(str, range(500, 700)))
    rows = [(1, a), (1, b), (None, b), (2, "c" + a + "d")]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in suffix_dedup.removal_digests(spark.createDataFrame(rows, "doc_id long, text string"), 200).collect())
    assert got == sorted([("1", len(a), len(a)), ("1", len(b), len(b)), ("None", len(b), len(b)), ("2", len(a) + 2, len(a))])


def crc_twins(make, n=400_000):
    """Two of ``make(i)`` with one crc32."""
    seen = {}
    for i in range(n):
        t = make(i)
        j = seen.setdefault(zlib.crc32(t.encode()), i)
        if j != i:
            return make(j), t


@pytest.mark.parametrize("doc", [None, 7])
def test_removal_tells_texts_of_one_id_apart(spark, doc):
    """Texts of one id and one crc32: one with repeated passages, one without, and a short one."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    a, b = crc_twins(lambda i: f"{i:09d} {passage if i % 2 else passage[::-1]} {i * 7919:012d}")
    texts = [a, b, "x" + passage + "y", "short", a[:100]]
    df = spark.createDataFrame([(doc, t) for t in texts] + [(1, passage[30:])], "doc_id long, text string")
    got = sorted(tuple(r)[1:] for r in suffix_dedup.removal_digests(df, 200).collect())
    assert zlib.crc32(a.encode()) == zlib.crc32(b.encode()) and a != b
    assert got == sorted(brute_removal([*texts, passage[30:]], 200))


def test_rows_that_repeat_a_text_collect_its_runs_once(spark, monkeypatch):
    """3000 rows equal in id and text: the list of runs stays that of one text."""
    rng = random.Random(10)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    monkeypatch.setattr(suffix_dedup, "merge", lambda runs, merge=suffix_dedup.merge: [(len(runs or []), 0), *merge(runs)])
    rows = [(None, text)] * 3000 + [(3, text[100:500] + "z" * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.repeated_spans(docs, 200, lambda t, runs: {"held": runs[0][0], "removed": sum(z - a for a, z in runs[1:])}, "held long, removed long").collect()
    most = max(r["held"] for r in got)
    assert 0 < most < 50
    assert {(r["doc_id"], r["removed"]) for r in got} == {(None, 900), (3, 400)}


def test_family_levels_are_geometric():
    rng = random.Random(6)
    f = suffix_dedup.Family(20)
    texts = [bytes(rng.choice(b"abcd") for _ in range(600)) for _ in range(60)]
    for t in texts:
        f.add(t)
    f.flush()
    assert sorted(f.levels) == [1 << i for i in range(len(bin(sum(f.levels))) - 2) if sum(f.levels) >> i & 1]
    assert all((lv[0][1:] > lv[0][:-1]).all() for lv in f.levels.values())


def test_whole_characters():
    t = "aéb".encode()
    assert suffix_dedup.whole_characters(t, [(0, 2)]) == "b" and suffix_dedup.whole_characters(t, [(2, 3)]) == "ab"
