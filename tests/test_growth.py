"""Plans whose cost must follow the input (findings of round 3)."""

import glob
import json

from pyspark.sql import functions as F

from cargoframe.functions import text as T
from cargoframe.operators import clean as C
from cargoframe.operators import dictionary as D
from cargoframe.operators import profile as PR
from cargoframe.operators import rollup as R
from cargoframe.operators import tables as TB
from cargoframe.plans import queries as Q
from cargoframe.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_values_stand_under_adjacent_pairs(spark):
    schema = spark.createDataFrame([("p", "Lot", 0, v, i) for i, v in enumerate(
        ["Mill 7 (5% broken)", "Mill 7 (6% broken)", "Mill 5 (7% broken)", "Mill", "(%)"])],
        "product string, attr string, attr_ord int, value string, value_ord int")
    index = {r.value: r.token for r in D.value_index(schema, ["product"]).collect()}
    assert index == {"Mill 7 (5% broken)": "5 broken", "Mill 7 (6% broken)": "6 broken", "Mill 5 (7% broken)": "7 broken", "Mill": "mill", "(%)": "*"}
    goods = spark.createDataFrame([("p", "NEW MILL 7 (6% broken) lot"), ("p", "6 mills broken"), ("p", "mill"), ("p", "")], "product string, goods_shipped string")
    got = {r.goods_shipped: r.value for r in D.match_by_token(goods, D.value_index(schema, ["product"]), ["product"]).collect()}
    assert got == {"NEW MILL 7 (6% broken) lot": "Mill 7 (6% broken)", "mill": "Mill"}


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_part_texts_join_last(spark, tmp_path):
    """The wide columns of the part side are not shuffled by the other joins."""
    tables = {"lineitem": "SELECT 1L l_orderkey, 1 l_linenumber, 2L l_partkey, 3L l_suppkey, 1.5D l_extendedprice, 2D l_quantity",
              "part": "SELECT 2L p_partkey, 'red ring' p_name, 'Brand#1' p_brand, 'PROMO' p_type, 5 p_size",
              "orders": "SELECT 1L o_orderkey, '1-URGENT' o_orderpriority", "supplier": "SELECT 3L s_suppkey, 4 s_nationkey", "nation": "SELECT 4 n_nationkey, 'PERU' n_name"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = FX.shipments(spark, str(tmp_path), extended=True)
    joins = [line for line in _optimized(df).splitlines() if "Join " in line]
    assert len(joins) == 4 and "l_partkey" in joins[0]
    r = df.first()
    assert (r.shipment_origin, r.transport_method, r.goods_shipped.strip()) == ("PERU", "1-URGENT", "RED RING,  Brand#1 (5% broken)")


def test_appended_batches_are_small(spark, tmp_path):
    TB.append_to(spark.range(10), str(tmp_path / "t"))
    TB.append_to(spark.range(5), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 15
    assert all(".zstd." in f for f in glob.glob(str(tmp_path / "t" / "*.parquet")))


def test_shipment_rows_are_shuffled_before_they_are_merged(spark):
    rows = spark.createDataFrame([("s", 0, 1, "P", "Red", None), ("s", 1, 1, "", "none", 'a"b'), ("s", 1, 0, "Q", "Blue", "x"), (" t ", 0, 0, None, None, None)],
                                 "shipment_id string, file_ord int, ord int, product string, c0 string, c1 string")
    df = R.shipment_attributes(rows, [("c0", "color"), ("c1", "grade")])
    assert {tuple(r) for r in df.collect()} == {("s", "Q", '{"color": "Blue", "grade": "a\\"b"}'), ("t", "", "{}")}
    assert "RepartitionByExpression [shipment_id" in _optimized(df)


def test_shipments_in_ranges_are_the_same_and_sorted(spark):
    """One shuffle serves the merge and the order; keys in and out of column
    order, values with and without escapes, NULL and empty ids."""
    values = ["Red", " Blue ", 'a"b', "none", "", None, "back\\slash", "tab\tin", "\u00a0wide\u3000", "é", "NaN"]
    rows = [(f" s{i % 61:03} " if i % 53 else [None, "  "][i % 2], i % 3, i * 7 % 100, ["P", "", " Q ", None][i % 4], *[values[i * k % 11] for k in (1, 3, 5)]) for i in range(400)]
    df = spark.createDataFrame(rows, "shipment_id string, file_ord int, ord int, product string, c0 string, c1 string, c2 string")
    columns = [("c0", "color"), ("c1", "grade"), ("c2", "color")]
    bad = {"", "nan", "none", "null"}
    want = {}
    for sid, f, o, p, *cells in sorted((r for r in rows if r[0] and r[0].strip()), key=lambda r: r[1:3]):
        entry = want.setdefault(sid.strip(), ["", {}])
        entry[0] = (p or "").strip() or entry[0]
        for v, (_, k) in zip(cells, columns):
            if v is not None and v.strip().lower() not in bad:
                entry[1][k] = v.strip()
    want = sorted((k, p, json.dumps(a, ensure_ascii=False)) for k, (p, a) in want.items())
    assert sorted(map(tuple, R.shipment_attributes(df, columns).collect())) == want
    ranged = R.shipment_attributes(df, columns, in_ranges=True)
    assert [tuple(r) for part in ranged.rdd.glom().collect() for r in part] == want
    assert _optimized(ranged).count("RepartitionByExpression") == 1


def test_target_text_is_parsed_once(spark):
    target = spark.createDataFrame([("1", "P", '{"a": 1}'), ("2", "Q", "{bad"), ("3", "R", " "), ("4", "S", '{"k": 1}')], "shipment_id string, product_name string, attributes string")
    upd = spark.createDataFrame([("1", None, [("b", "2"), ("a", "3")]), ("2", "X", [("b", "2")]), ("3", "Y", None)],
                                "shipment_id string, product string, upd array<struct<k:string,v:string>>")
    df = TB.attribute_upsert(target, upd)
    assert {tuple(r) for r in df.collect()} == {("1", "P", '{"a": 3, "b": 2}', False), ("2", "X", "{bad", True), ("3", "Y", None, False), ("4", "S", '{"k": 1}', False)}
    assert _optimized(df).count("from_json(") == 1


def test_cube_counts_distinct_values_without_a_row_per_slice(spark):
    """More slices than one word holds, NULLs in the keys and in the values."""
    rows = spark.range(3000).select(F.when(F.col("id") % 31 != 0, F.col("id") % 31).alias("day"), F.when(F.col("id") % 7 != 0, (F.col("id") % 7).cast("string")).alias("flag"),
                                    F.when(F.col("id") % 5 != 0, F.col("id") % 400).alias("a"), (F.col("id") % 90).cast("string").alias("b"), F.lit(None).cast("long").alias("none"))
    df = C.cube_distinct(rows, ["day", "flag"], ["a", "b", "none"])
    want = rows.cube("day", "flag").agg(F.countDistinct("a"), F.countDistinct("b"), F.countDistinct("none"))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert "Expand" not in _optimized(df)
    assert C.cube_distinct(rows.limit(0), ["day", "flag"], ["a"]).count() == 0


def test_goods_are_cleaned_once_per_part(spark):
    """No text rule of the goods runs on shipment rows, and the rows are those of ``load_clean``."""
    df = Q.clean_shipments(spark, SF)
    plan = _optimized(df.select("hs4", "category", "goods_shipped")).splitlines()
    top = next(i for i, line in enumerate(plan) if "Join " in line)
    assert not any("trim(" in line or "regexp_replace" in line for line in plan[:top])
    want = C.load_clean(FX.shipments(spark, SF))
    assert df.columns == want.columns and df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()


def test_order_number_is_that_of_the_text(spark):
    rows = spark.createDataFrame([(1, 2, 3, 4, 5), (10**10 - 1, 9, 10**8 - 1, 10**6 - 1, 10**12 - 1), (0, 0, 0, 0, 0), (10**10, 1, 1, 1, 1), (1, 10, 1, 1, 1),
                                  (1, 1, 10**8, 1, 1), (1, 1, 1, 10**6, 1), (-5, 1, 1, 1, 1), (1, 1, 1, 1, -7), (None, 1, 1, 1, 1), (1, 1, 1, 1, None)],
                                 "o long, n int, p long, s long, c long")
    text = F.concat_ws("-", FX._pad("o", 10), F.col("n").cast("string"), FX._pad("p", 8), FX._pad("s", 6), FX._pad("c", 12))
    text = F.when(F.col("o").isNotNull() & F.col("c").isNotNull(), text)
    got = rows.select(FX.ord_number(*map(F.col, "onpsc"), text).alias("a"), FX.ord_key(text).alias("b"))
    assert got.schema["a"].dataType == got.schema["b"].dataType and all(r.a == r.b for r in got.collect())


def test_cells_are_stripped_as_before(spark):
    values = ["", " ", "a", " a", "a ", "\ta b\n", "\u3000x\u3000", "é", " é", "~", "!", "\x7f", "\x01", "x\u00a0", "5.0", None]
    df = spark.createDataFrame([(v,) for v in values], "x string").select(T.strip_cell("x").alias("a"), T.strip_ws("x").alias("b"), T.has_text("x").alias("c"))
    assert all(r.a == r.b and (r.c is None if r.b is None else r.c == (r.b != "")) for r in df.collect())


def test_first_values_group_by_the_column_number(spark):
    rows = spark.createDataFrame([("g", 1, "Red", 2.0), ("g", 2, "red ", 3.0), ("g", 3, " ", None)], "g string, o int, color string, weight_in_kg double")
    df = PR.column_summary(rows, "g", "o")
    assert [tuple(r) for r in df.collect()] == [("g", "weight_in_kg: 2.0, 3.0\ncolor: Red\nDetected dynamic attribute hints: color")]
    keys = [line for line in _optimized(df).splitlines() if "Aggregate [" in line and "min(o" in line]
    assert len(keys) == 1 and " col#" not in keys[0].split("], [")[0]


def test_proposals_are_read_once(spark):
    """Names, values and groups of the proposals come from one short table."""
    model = PR.normalise_proposals(Q._proposals(spark, SF), "category")
    assert "l_partkey" not in _optimized(model)
