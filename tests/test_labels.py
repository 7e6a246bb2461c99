import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cargoframe.operators import labels as L


def test_positions_by_range_equal_row_number(spark):
    random.seed(1)
    rows = [(random.choice("aab"), i, random.random()) for i in range(3000)]  # 'a' is a hot group
    df = spark.createDataFrame(rows, "g string, id long, x double").repartition(7)
    got = {(r.g, r.id): r.pos for r in L.positions_by_range(df, ["g"], ["x", "id"]).collect()}
    w = Window.partitionBy("g").orderBy("x", "id")
    exp = {(r.g, r.id): r.p for r in df.select("g", "id", (F.row_number().over(w) - 1).alias("p")).collect()}
    assert got == exp


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "k long, v long").repartition(5)
    got = {r.k: r.before for r in L.running_total(df, ["k"], "v").collect()}
    acc, exp = 0, {}
    for i in range(500):
        exp[i] = acc
        acc += i % 7
    assert got == exp


def test_id_lines_are_bounded(spark):
    rows = [("h", "p", "hot", f"id{i:05d}") for i in range(2500)] + [("h", "p", "cold", "x1"), ("h", "p", "cold", "x0")]
    df = spark.createDataFrame(rows, "hs4 string, product string, goods_shipped string, shipment_id string")
    out = L.id_lines(L.goods_to_shipments(df), 1000).collect()
    hot = [r for r in out if r.goods_shipped == "hot"]
    assert len(hot) == 3 and all(r.n_lines == 3 and r.n_ids == 2500 for r in hot)
    ids = sorted(i for r in hot for i in r.shipment_ids.split("|"))
    assert ids == sorted(f"id{i:05d}" for i in range(2500))
    cold = [r for r in out if r.goods_shipped == "cold"]
    assert [r.shipment_ids for r in cold] == ["x0|x1"]


def test_fanout_keeps_rows_and_defaults(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, goods_shipped string")
    labels = spark.createDataFrame([("a", "Cat")], "goods_shipped string, category string")
    got = sorted((r.id, r.category) for r in L.label_fanout(rows, labels).collect())
    assert got == [(1, "Cat"), (2, "Cat"), (3, "Unclassified")]


def test_explode_ids_blank(spark):
    df = spark.createDataFrame([("a|b",), ("",)], "shipment_ids string")
    assert sorted(r.shipment_id for r in L.explode_ids(df).collect()) == ["", "a", "b"]


def test_token_budget(spark):
    b = spark.createDataFrame([(i, 100) for i in range(5)], "batch long, tokens long")
    got = sorted((r.batch, r.admitted) for r in L.token_budget(b, "tokens", ["batch"], 250).collect())
    assert got == [(0, True), (1, True), (2, True), (3, False), (4, False)]


def test_union_ids_keeps_first_appearance(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), (None, ["x"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(L.union_ids(F.col("a"), F.col("b"))).collect()] == [["a", "b", "c"], ["x"]]


def test_seeded_rounds_draw_distinct_texts(spark):
    import hashlib
    texts = [f"t{i % 40}" for i in range(400)] + ["hot"] * 300
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    got = sorted((r["round"], r["sample_key"]) for r in L.seeded_rounds(df, "text", 5, [7, 8]).collect())
    exp = sorted((k, h) for k, s in enumerate([7, 8]) for h in sorted(hashlib.sha256(f"{s}{t}".encode()).hexdigest() for t in set(texts))[:5])
    assert got == exp
