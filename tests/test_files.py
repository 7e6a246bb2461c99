import os
import tempfile

from pyspark.sql import functions as F

from cargoframe.operators import labels as L
from cargoframe.session import cut_lineage
from cargoframe.sources import files as FS
from cargoframe.sources import fixtures as FX
from cargoframe.sources import layouts as LY
from cargoframe.sources import ordered as OR

SF = "/root/testdata/sf0.001"


def test_csv_roundtrip_keeps_text_codes(spark):
    base = tempfile.mkdtemp(prefix="cf-csv-")
    ship = FX.shipments(spark, SF).withColumn("goods_shipped", F.concat(F.col("goods_shipped"), F.lit('\n"quoted"')))
    FS.write_csv(ship.select("shipment_id", "hs_code", "goods_shipped", "category"), os.path.join(base, "in"))
    back = FS.load_shipments_csv(spark, os.path.join(base, "in"), multi_line=True)
    assert back.filter(F.col("hs_code") == "0901").count() > 0  # leading zero kept
    expected = ship.filter(F.trim("goods_shipped") != "").count()
    assert back.count() == expected
    assert back.filter(F.col("goods_shipped").contains('"quoted"')).count() == expected


def test_partitioned_files_and_aligned_union(spark):
    base = tempfile.mkdtemp(prefix="cf-parts-")
    a = spark.createDataFrame([("1", "x", "Red")], "shipment_id string, product string, attr_Color string")
    b = spark.createDataFrame([("2", "y", "Big")], "shipment_id string, product string, attr_Size string")
    FS.write_csv(a, os.path.join(base, "a"))
    FS.write_csv(b, os.path.join(base, "b"))
    FS.write_csv(a.drop("shipment_id"), os.path.join(base, "c"))  # no id column: skipped
    u = LY.read_csv_directory(spark, base)
    got = [(r.shipment_id, r.attr_Color, r.attr_Size) for r in sorted(u.collect(), key=lambda r: r.file_ord)]
    assert got == [("1", "Red", None), ("2", None, "Big")]
    FS.write_csv(a.withColumn("hs4", F.lit("0901")), os.path.join(base, "p"), partition_by=["hs4", "product"])
    assert os.path.isdir(os.path.join(base, "p", "hs4=0901", "product=x"))


def test_csv_columns_bind_by_name(spark):
    import pytest
    base = tempfile.mkdtemp(prefix="cf-hdr-")
    with open(os.path.join(base, "x.csv"), "w") as f:
        f.write('goods_shipped,extra_col,hs_code,shipment_id\n"COFFEE, BEANS",zz,0901, s1 \n')
    r = FS.load_shipments_csv(spark, os.path.join(base, "x.csv")).first()
    assert (r.shipment_id, r.hs_code, r.goods_shipped, r.extra_col) == ("s1", "0901", "COFFEE, BEANS", "zz")
    with open(os.path.join(base, "y.csv"), "w") as f:
        f.write("goods,code\na,b\n")
    with pytest.raises(ValueError, match="missing required columns"):
        FS.load_shipments_csv(spark, os.path.join(base, "y.csv"))


def test_load_table_filters(spark):
    spark.createDataFrame([("090111", "a"), ("100630", "b")], "hs_code string, k string").createOrReplaceTempView("t_ship")
    got = [tuple(r) for r in FS.load_table(spark, "t_ship", filters={"k": "a"}).collect()]
    assert got == [("0901", "a")]
    schema, rows = FS.peek(spark.table("t_ship"))
    assert len(rows) == 1 and schema.names == ["hs_code", "k"]


def test_many_files_of_several_layouts_are_one_scan(spark):
    """500 files in 5 layouts: no job per file, every cell under its own header."""
    base = tempfile.mkdtemp(prefix="cf-many-")
    layouts = [["shipment_id", "attr_A"], ["attr_B", "shipment_id", "attr_A"], ["shipment_id"], ['attr_"q", x', "shipment_id"], ["attr_A", "attr_B"]]
    want = {}
    for i in range(500):
        names = layouts[i % 5]
        os.makedirs(os.path.join(base, f"d{i % 7}"), exist_ok=True)
        with open(os.path.join(base, f"d{i % 7}", f"f{i:03}.csv"), "w") as f:
            quoted = ['"' + n.replace('"', '""') + '"' if '"' in n else n for n in names]
            f.write(",".join(quoted) + "\n")
            for j in range(i % 3):
                cells = {n: f"{n[-1]}{i}-{j}" for n in names}
                f.write(",".join(cells[n] for n in names) + "\n")
                if "shipment_id" in names:
                    want[cells["shipment_id"]] = cells
    open(os.path.join(base, "empty.csv"), "w").close()
    files = LY.header_registry(spark, base)
    got = files.groupBy("layout").count().collect()
    assert len(got) == 5 and {r["count"] for r in got} == {100}
    spark.sparkContext.setJobGroup("many", "files")
    rows = LY.read_csv_directory(spark, base).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("many")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 30
    assert {r["shipment_id"]: {k: v for k, v in r.asDict().items() if v is not None and not k.startswith("file_")} for r in rows} == want
    by_path = sorted({(r["file_ord"], r["file_name"]) for r in rows})
    assert len(by_path) == len({o for o, _ in by_path}) and max(o for o, _ in by_path) < 400


def test_ordered_sinks_are_sorted_and_one_object(spark):
    import glob
    import json
    base = tempfile.mkdtemp(prefix="cf-ord-")
    rows = [(f"id {i * 7919 % 5000:05}", json.dumps({"k": i, 'q"': None})) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, j string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        OR.write_sorted_csv(df, base + "/csv", ["id"])
        OR.write_json_object(df, base + "/json", "id", "j")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(glob.glob(base + "/json/part-*"))
    assert len(files) > 3
    text = "".join(open(f).read() for f in files)
    assert json.loads(text) == {k: json.loads(v) for k, v in rows} and list(json.loads(text)) == sorted(k for k, _ in rows)
    back = OR.read_sorted_csv(spark, base + "/csv").collect()
    assert [r["id"] for r in sorted(back, key=lambda r: tuple(r[c] for c in OR.PLACE))] == sorted(k for k, _ in rows)
    OR.write_json_object(df.limit(0), base + "/none", "id", "j")
    assert json.loads("".join(open(f).read() for f in glob.glob(base + "/none/part-*"))) == {}


def test_classification_object_is_one_document(spark):
    import glob
    import json
    base = tempfile.mkdtemp(prefix="cf-obj-")
    rows, want = [], {}
    for h in ("0901", "1006"):
        for p in ('A "x"', "B"):
            for g in range(5):
                item = {"goods_shipped": f"goods {g}", "attributes": {"Color": "Red"}, "shipment_ids": []}
                for line in (0, 2) if g % 2 else (1,):  # lines may be missing
                    ids = [f"{h}{p}{g}-{line}-{j}" for j in range(3)]
                    rows.append((h, p, item["goods_shipped"], json.dumps(item["attributes"]), line, ids))
                    item["shipment_ids"] += ids
                want.setdefault(h, {}).setdefault(p, []).append(item)
    df = spark.createDataFrame(rows, "hs4 string, product string, goods_shipped string, attributes string, line long, ids array<string>").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        OR.write_classification_object(df, base + "/o")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(glob.glob(base + "/o/part-*"))
    assert len(files) > 2 and json.loads("".join(open(f).read() for f in files)) == want
    OR.write_classification_object(df.limit(0), base + "/none")
    assert json.loads("".join(open(f).read() for f in glob.glob(base + "/none/part-*"))) == {}


def test_sinks_by_one_key_share_ranges_and_are_numbered_where_they_are_read(spark):
    """Rows dealt to ranges once are written by both sinks without another
    exchange, as small files, and read back in order without one."""
    import glob
    import gzip
    import json
    base = tempfile.mkdtemp(prefix="cf-rng-")
    rows = [(f"id {i * 7919 % 5000:05}", 'P "x", y' if i % 3 else None, json.dumps({"k": i, 'q"': "same text in all rows " * 4})) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, product string, j string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = cut_lineage(OR.in_ranges(df, ["id"]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.sparkContext.setJobGroup("sinks", "ranged")
    OR.write_sorted_csv(ranged, base + "/csv", ["id"], ranged=True, compression="gzip")
    OR.write_json_object(ranged, base + "/json", "id", "j", ranged=True, compression="gzip")
    tracker = spark.sparkContext.statusTracker()
    stages = [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("sinks")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) <= 4 and max(stages) <= 2  # two writes and the least and greatest id: no job with an exchange of rows
    files = {k: sorted(glob.glob(f"{base}/{k}/part-*.gz")) for k in ("csv", "json")}
    assert all(len(f) > 3 for f in files.values())
    want = sorted(rows)
    assert list(json.loads("".join(gzip.open(f, "rt").read() for f in files["json"])).items()) == [(k, json.loads(v)) for k, _, v in want]
    csv = L.positions_by_range(OR.read_sorted_csv(spark, base + "/csv"), [], list(OR.PLACE), list(OR.BLOCK))
    lines = L.positions_by_range(OR.read_lines(spark, base + "/json"), [], list(OR.PLACE), list(OR.BLOCK))
    for got in (csv, lines):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" not in plan and "LogicalRDD" not in plan
    assert [tuple(r) for r in csv.orderBy("pos").select("pos", "id", "product", "j", "group_size").collect()] == [(i, *r, 3000) for i, r in enumerate(want)]
    text = [r.line for r in lines.orderBy("pos").collect()]
    assert "\n".join(text) == "".join(gzip.open(f, "rt").read() for f in files["json"]).rstrip("\n")


def test_positions_in_blocks_of_split_files(spark):
    """Files cut into several blocks, and several files in one task."""
    base = tempfile.mkdtemp(prefix="cf-blk-")
    spark.range(5000).select(F.format_string("%05d", "id").alias("value")).repartitionByRange(3, "value").sortWithinPartitions("value").write.text(base + "/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = L.positions_by_range(OR.read_lines(spark, base + "/t"), [], list(OR.PLACE), list(OR.BLOCK)).select("pos", "line", "block_start", "group_size").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.pos, r.line) for r in got) == [(i, f"{i:05}") for i in range(5000)]
    assert len({r.block_start for r in got}) > 2 and {r.group_size for r in got} == {5000}
    OR.write_sorted_csv(spark.range(0).select(F.col("id").cast("string")), base + "/none", ["id"])
    assert L.positions_by_range(OR.read_sorted_csv(spark, base + "/none"), [], list(OR.PLACE), list(OR.BLOCK)).count() == 0
