import random

from pyspark.sql import functions as F

from cargoframe.operators import knn as K
from cargoframe.operators import tables as TB
from cargoframe.operators.versions import BucketTable, KnowledgeBase


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    target = spark.createDataFrame([(str(i), f"p{i}", '{"a": 1}') for i in range(200)] + [(None, "p", None)], "shipment_id string, product_name string, attributes string")
    t = BucketTable.create(target, str(tmp_path / "t"), "shipment_id", 16)
    assert _rows(t.read()) == _rows(target)
    upd = spark.createDataFrame([("7", "new", '{"b": 2}', 1), ("9", "x", '{"a": 3}', 1), ("no such id", "y", "{}", 1)], "shipment_id string, product string, attrs_json string, ord int")
    agg = TB.aggregate_updates(upd)
    kept = {r[0]: r for r in t.live()}
    n = t.merge(agg, lambda rows, u: TB.attribute_upsert(rows, u).drop("attrs_kept"))
    assert 1 <= n <= 2
    assert _rows(t.read()) == _rows(TB.attribute_upsert(target, agg).drop("attrs_kept"))
    now = {r[0]: r for r in t.live()}
    assert sum(now[b] != kept[b] for b in kept) == n and t.version() == 2
    assert _rows(t.read(version=1)) == _rows(target)  # the old version still reads
    # an update that matches nothing changes nothing; a lost attempt leaves the old version in force
    assert t.merge(TB.aggregate_updates(upd.filter("shipment_id = 'no such id'")), TB.attribute_upsert) == 0 and t.version() == 2
    t._write(target.limit(50), 3)
    assert _rows(t.read()) == _rows(TB.attribute_upsert(target, agg).drop("attrs_kept"))


def test_delete_by_merge_can_empty_buckets(spark, tmp_path):
    target = spark.createDataFrame([(i, str(i)) for i in range(40)], "k long, name string")
    t = BucketTable.create(target, str(tmp_path / "t"), "k", 64)
    keys = spark.createDataFrame([(i,) for i in range(0, 40, 2)] + [(999,)], "k long")
    t.merge(keys, lambda rows, k: TB.delete_keys(rows, k, "k"))
    assert sorted(r[0] for r in t.read().select("k").collect()) == list(range(1, 40, 2))
    t.merge(spark.createDataFrame([(i,) for i in range(40)], "k long"), lambda rows, k: TB.delete_keys(rows, k, "k"))
    assert t.read().count() == 0


def _records(spark, rng, n, version, ids=60):
    rows = {}
    for _ in range(n):
        i = rng.randrange(ids)
        rows[i] = (f"id{i}", f"c{i % 3}", None if i % 3 == 2 else f"A{i % 2}", rng.choice("pqr"), version)
    return spark.createDataFrame(list(rows.values()), "id string, category string, attribute_name string, value string, version long")


def test_knowledge_base_log_equals_the_full_rewrite(spark, tmp_path):
    rng, ns = random.Random(3), ["category", "attribute_name"]
    base = _records(spark, rng, 80, 0)
    kb, whole = KnowledgeBase.create(base, str(tmp_path / "kb"), ns, buckets=8), base
    for step in range(1, 6):
        if step % 2:
            new = _records(spark, rng, 25, step - (step == 5) * 3)  # step 5: older versions come late
            kb.upsert(new)
            whole = K.kb_upsert(whole, new)
        else:
            gone = spark.createDataFrame([("c1", "A1"), ("c2", None)][step // 2 - 1:step // 2], "category string, attribute_name string")
            kb.delete(gone)
            same = whole["category"].eqNullSafe(gone["category"]) & whole["attribute_name"].eqNullSafe(gone["attribute_name"])
            whole = whole.join(gone, same, "left_anti")
        assert _rows(kb.read()) == _rows(whole.select(*base.columns)), step
    before = _rows(kb.read())
    assert kb.compact(min_versions=2) > 0
    assert _rows(kb.read()) == before
    assert kb.compact(min_versions=2) == 0                      # nothing has grown
    again = _records(spark, rng, 5, 9)
    kb.upsert(again)
    assert _rows(kb.read()) == _rows(K.kb_upsert(whole.select(*base.columns), again))
    counts = {(r.category, r.attribute_name): r.n for r in kb.namespace_counts().collect()}
    want = {}
    for r in kb.read().collect():
        want[r.category, r.attribute_name] = want.get((r.category, r.attribute_name), 0) + 1
    assert counts == want


def test_empty_knowledge_base(spark, tmp_path):
    empty = spark.createDataFrame([], "id string, category string, attribute_name string, value string, version long")
    kb = KnowledgeBase.create(empty, str(tmp_path / "kb"), ["category"], buckets=4)
    assert kb.read().count() == 0
    kb.upsert(_records(spark, random.Random(1), 5, 1))
    assert kb.read().count() > 0 and kb.compact() == 0
    assert kb.read().agg(F.countDistinct("id") == F.count("id")).first()[0]
