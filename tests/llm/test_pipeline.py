"""The pipeline: each stage on what it was given, against brute force."""
import pytest

import corpus_pipeline as P
from cargoframe.llm import packing, pii_crf, suffix_dedup
from cargoframe.llm.common import materialise

from .test_dedup import brute_components, brute_removal, word_sets
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    for name, fn in P.STAGES:
        got = materialise(fn(spark, docs, SF), name)
        out.append((name, docs, got))
        docs = got
    return {name: (a, b) for name, a, b in out}


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stage_columns(stages, spark):
    want = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert all(b.dtypes == want for n, (_, b) in stages.items() if n != "packing")
    assert list(stages) == ["toxicity", "near_duplicates", "suffix_dedup", "pii", "packing"]


def test_toxic_documents_go(stages, spark):
    a, b = map(rows, stages["toxicity"])
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert set(b) < set(a) and all(b[d] == a[d] for d in b)
    assert all(d in b for d in a if marks.get(d) == 0)


def test_one_of_each_group_stays(stages):
    a, b = map(rows, stages["near_duplicates"])
    root = brute_components(word_sets({d: r["text"] for d, r in a.items()}, 5))
    assert set(b) == {d for d in a if root[d] == d} and all(b[d] == a[d] for d in b)


def test_repeats_go(stages):
    a, b = map(rows, stages["suffix_dedup"])
    want = brute_removal([a[d]["text"] for d in a], 200)
    assert set(a) == set(b)
    for d, (n, removed, spans, _) in zip(a, want):
        left = len(b[d]["text"].encode())
        assert n - removed - 6 * spans <= left <= n - removed and b[d]["n_chars"] == len(b[d]["text"])
    assert sum(w[1] for w in want) > 0


def test_personal_data_goes(stages):
    a, b = map(rows, stages["pii"])
    assert set(a) == set(b)
    for d in a:
        found = sum(map(len, pii_crf.base_spans(a[d]["text"])))
        assert (a[d]["text"] == b[d]["text"]) or found
        assert not found or sum(b[d]["text"].count(f"<{k}>") for k in pii_crf.KINDS) >= 1


def test_packing_is_whole(stages):
    a, b = stages["packing"]
    check_packing(b.collect(), {d: r["text"] for d, r in rows(a).items()})


def test_run_equals_its_stages(stages, spark):
    got = {tuple(r)[:6] for r in P.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect()}
    assert got == {tuple(r)[:6] for r in stages["packing"][1].select("doc_id", "piece", "start", "length", "ids_crc32").collect()}


def test_odd_documents_pass_all_stages(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0, 1), (1, None, "en", "s", 0, 1), (2, "", None, None, None, 2), (None, "word " * 90, "de", "s", 5, 3),
                                  (3, "word " * 90, "de", "s", 5, 4), (4, "é" * 300, "fr", "s", 300, 5)],
                                 "doc_id long, text string, lang string, source string, n_chars long, score int")
    for empty in (False, True):
        df = docs.limit(0) if empty else docs
        for name, fn in P.STAGES:
            df = materialise(fn(spark, df, SF), name)
        # 1 (two equal rows), 2, 3 (whose copy has no id) and 4
        assert df.count() == (0 if empty else 4)
    assert packing and suffix_dedup


def test_repeated_and_missing_ids_lose_no_text(spark):
    copy, own, third = ("one two three four five six seven eight nine ten " * 4, "all other words stand here and no one else says them",
                        "a third text that is its own and long enough to count")
    rows = [(1, copy), (1, own), (2, copy + "more"), (2, third), (3, copy), (None, copy), (None, own + " again and again"), (None, own + " again and again"),
            (4, ""), (4, ""), (5, ""), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in P.keep_one_of_near_copies(spark, docs, SF).collect()), key=str)
    # every text that is near to no other stays, whatever its id; near copies leave the one of the smallest id
    assert got == sorted([(1, copy), (1, own), (2, third), (None, own + " again and again"), (4, ""), (5, "")], key=str) or \
        got == sorted([(1, copy), (1, own), (2, third), (None, own + " again and again"), (4, None), (5, "")], key=str)
