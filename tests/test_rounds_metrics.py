import builtins
import importlib
import os

import pytest
from pyspark.sql import functions as F

from cargoframe.operators import clean as C
from cargoframe.operators import compare as CMP
from cargoframe.operators import knn as K
from cargoframe.operators import metrics as M
from cargoframe.operators import profile as PR
from cargoframe.operators import rounds as RO
from cargoframe.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _answer(prompts):
    """One attribute 'word' with the first word of every description, and one
    'known' whose value is the number of known attributes."""
    lines = F.filter(F.split("prompt", "\n"), lambda x: x.rlike(r"^\d+\. "))
    base = prompts.select("category", "call", "prompt", F.posexplode(lines).alias("val_ord", "line"))
    word = base.select("category", "call", F.lit(0).alias("prop_ord"), F.lit("word").alias("name"), F.lit("a word").alias("definition"), "val_ord",
                       F.get(F.split("line", " "), 1).alias("value"))
    known = prompts.select("category", "call", F.lit(1).alias("prop_ord"), F.lit("known").alias("name"), F.lit("").alias("definition"), F.lit(0).alias("val_ord"),
                           F.size(F.regexp_extract_all("prompt", F.lit("(?m)^(- )"), 1)).cast("string").alias("value"))
    return word.unionByName(known)


def test_rounds_feed_each_other(spark):
    goods = spark.createDataFrame([("c", f"w{i:02} x") for i in range(30)] + [("d", "solo x"), ("d", "solo x")], "category string, goods_shipped string")
    attrs, values, sent = RO.attribute_rounds(goods, _answer, rounds=3, per_call=5)
    prompts = {(r["category"], r["round"], r["call"]): r for r in sent.collect()}
    assert len(prompts) == 7 and sorted(r for c, r, _ in prompts if c == "c") == [0, 0, 1, 1, 2, 2]
    assert all(RO.PRIOR_HEAD not in p["prompt"] for k, p in prompts.items() if k[1] == 0)
    second = [p["prompt"] for (c, r, _), p in prompts.items() if c == "c" and r == 1]
    first_words = {w.split(" ")[1].title() for (c, r, _), p in prompts.items() if (c, r) == ("c", 0) for w in p["prompt"].split("\n")[2:]}
    for text in second:  # the second round's prompts hold the first one's result: 8 of its 10 words and a mark
        line = next(x for x in text.split("\n") if x.startswith("- Word: "))
        shown = line.removeprefix("- Word: ").removesuffix(" ...").split(", ")
        assert line.endswith(" ...") and len(shown) == 8 and set(shown) < first_words
        assert "- Known: 0" in text
    got = {(r["category"], r["attr"]): r["value"] for r in values.groupBy("category", "attr").agg(F.sort_array(F.collect_list("value")).alias("value")).collect()}
    assert got["c", "Word"] == sorted(f"W{i:02}" for i in range(30)) and got["c", "Known"] == ["0", "2"] and got["d", "Word"] == ["Solo"]
    defs = {(r["category"], r["attr"]): r["definition"] for r in attrs.collect()}
    assert defs == {("c", "Word"): "a word", ("c", "Known"): None, ("d", "Word"): "a word", ("d", "Known"): None}


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    raw = FX.shipments(spark, SF)
    spark.sparkContext.setJobGroup("observed", "one pass")
    got = M.load_counted(raw, str(tmp_path / "clean"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = C.removed_empty_count(raw).first()
    assert got == want.asDict()
    assert spark.read.parquet(str(tmp_path / "clean")).count() == want["rows_out"]


def test_sketches_merge_and_approximate_profile(spark):
    rows = spark.range(40_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 3).alias("p"), (F.col("id") % 9000).cast("string").alias("s"),
                                      F.lit(None).cast("string").alias("none"))
    sk = C.distinct_sketches(rows, ["day", "p"], ["s", "none"])
    got = C.merge_sketches(sk, ["p"], cube=True).collect()
    assert len(got) == 4
    for r in got:
        want = rows.filter(F.lit(r["p"] is None) | (F.col("p") == r["p"])).agg(F.countDistinct("s"), F.count("*")).first()
        assert r["n_rows"] == want[1] and abs(r["n_s"] - want[0]) <= 0.03 * want[0] and r["n_none"] == 0
    clean = C.load_clean(FX.shipments(spark, SF))
    exact, near = C.profile_shipments(clean).first(), C.profile_shipments(clean, approximate=True).first()
    assert near.asDict().keys() == exact.asDict().keys() and near["n_rows"] == exact["n_rows"]
    for c in ("n_hs_codes", "n_goods", "n_shipments"):
        assert abs(near[c] - exact[c]) <= 0.03 * exact[c]


def test_user_model_reranks_and_failures_keep_the_first_order(spark):
    cands = spark.createDataFrame([(q, k, 1.0 - r / 10, r + 1) for q in range(6) for r, k in enumerate([10, 11, 12])], "q_id long, k_id long, score double, rank int")
    texts = spark.createDataFrame([(q, f"q{q}") for q in range(6)] + [(10, "aaa"), (11, "a"), (12, None)], "id long, text string")

    def model(pairs):
        if any(q == "q3" for q, _ in pairs):
            raise RuntimeError("no")
        if any(q == "q4" for q, _ in pairs):
            return [1.0]
        return [float(-len(t)) for _, t in pairs]
    got = {}
    for r in K.rerank_with_model(cands, texts, texts, "id", "id", "text", model, top_n=3, batch=1).collect():
        got.setdefault(r.q_id, []).append((r.rerank, r.k_id, r.rerank_score))
    good, kept = [(1, 11, -1.0), (2, 10, -3.0), (3, 12, None)], [(1, 10, None), (2, 11, None), (3, 12, None)]
    assert {q: sorted(v) for q, v in got.items()} == {q: kept if q in (3, 4) else good for q in range(6)}


def test_disagreement_samples_of_huge_pair_counts(spark):
    pairs = spark.createDataFrame([("k1", "a", "b", 10**10), ("k0", "a", "b", 2), ("k2", "a", "a", 5)], "id string, label_a string, label_b string, n long")
    assert [r.id for r in CMP.disagreement_samples(pairs, "id", 4).collect()] == ["k0", "k0", "k1", "k1"]


def test_keyword_columns():
    assert PR.keyword_columns(["transport_method", "Pack_Size", "x", "GRADE"]) == {"Pack_Size": ["pack", "size"], "GRADE": ["grade"]}


def test_first_values_order_and_spelling(spark):
    rows = [("g", "b", 5), ("g", " B ", 2), ("g", "a", 3), ("g", "A", 9), ("g", "", 1), ("g", None, 0), ("g", "c", 7), ("h", "z", 1)]
    df = spark.createDataFrame(rows, "g string, v string, o int")
    got = [tuple(r) for r in PR.first_values(df, ["g"], "v", "o", 2).orderBy("g", "pos").collect()]
    assert got == [("g", 1, "B"), ("g", 2, "a"), ("h", 1, "z")]


@pytest.mark.parametrize("missing", ["cargoframe.llm", "corpus_pipeline", "public_tokenizers", "xxhash"])
def test_entry_imports_without_the_optional_parts(monkeypatch, missing):
    import __spark_entry__ as entry
    real = builtins.__import__

    def without(name, globals=None, locals=None, fromlist=(), level=0):
        if name == missing or name.startswith(missing + ".") or (fromlist and f"{name}.{fromlist[0]}" == missing):
            raise ImportError(f"No module named {missing!r}")
        return real(name, globals, locals, fromlist, level)
    import sys
    hidden = [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("cargoframe.llm") or m == missing]
    saved = {m: sys.modules.pop(m) for m in hidden}
    monkeypatch.setattr(builtins, "__import__", without)
    try:
        got = importlib.reload(entry)
        assert "dictionary_match" in got.queries() and "pipeline" not in got.queries()
    finally:
        monkeypatch.undo()
        sys.modules.update(saved)
        importlib.reload(entry)
    assert os.path.exists(entry.__file__)
