"""Directories of CSV files with differing columns, as one scan.

A registry table names the columns of every file; it comes from one job that
keeps the first line of each file. The data is then one positional scan of
all files, joined with the registry by path: the plan grows neither with the
number of files nor with that of layouts, and no file list reaches the driver,
only the distinct column names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.labels import positions_by_range
from ..session import cut_lineage

#: Where a row stands: the number of the part file (of files written by Spark), its path, block and row.
PLACE = ("part_no", "file_path", "block_start", "row_no")
#: What names a block of a file: a scan reads its rows in order and in one task.
BLOCK = PLACE[:3]


def place_columns() -> list[Column]:
    """The columns ``PLACE`` of a file scan; taken directly on the scan, before any shuffle."""
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("long")
    return [F.coalesce(part, F.lit(0)).cast("long").alias("part_no"), F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("row_no")]


def header_names(line) -> Column:
    """Column names of a CSV header line; doubled quotes are quotes, a column
    without a name is ``_c`` and its place."""
    c = F.concat(F.regexp_replace(line, "^\ufeff", ""), F.lit(","))
    cells = F.regexp_extract_all(c, F.lit('("(?:[^"]|"")*"|[^,]*),'), 1)
    plain = F.transform(cells, lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.transform(plain, lambda x, i: F.when(x == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(x))


def _reader(spark: SparkSession, glob: str, partitioned: bool):
    r = spark.read.option("pathGlobFilter", glob)
    return r if partitioned else r.option("recursiveFileLookup", True)


def header_registry(spark: SparkSession, path: str, glob: str = "*.csv", partitioned: bool = False) -> DataFrame:
    """``file_path, file_name, names, layout``: one row per non-empty file;
    files with equal ``names`` share ``layout``. One job over the first block of
    every file; ``partitioned`` keeps the columns of ``key=value`` folders."""
    lines = _reader(spark, glob, partitioned).text(path)
    first = lines.select("value", F.col("_metadata.file_name").alias("file_name"), *place_columns()).filter(F.col("block_start") == 0)
    first = first.groupBy("file_path", "file_name").agg(F.min_by("value", "row_no").alias("line"))
    names = first.select("file_path", "file_name", header_names(F.col("line")).alias("names"))
    return names.withColumn("layout", F.md5(F.to_json("names")))


def scan_layouts(spark: SparkSession, path: str, registry: DataFrame, glob: str = "*.csv", multi_line: bool = False,
                 partitioned: bool = False) -> DataFrame:
    """All rows of the registry's files: ``names, vals`` (arrays in the file's
    own column order), ``file_name``, ``PLACE`` and any folder columns. One scan:
    cells are read by position, each file's header line is left out."""
    width = registry.agg(F.max(F.size("names"))).first()[0] or 1
    cells = [f"c{i}" for i in range(width)]
    r = _reader(spark, glob, partitioned).option("header", True).option("enforceSchema", True).option("multiLine", multi_line)
    rows = r.option("escape", '"').schema(StructType([StructField(c, StringType()) for c in cells])).csv(path)
    folders = [c for c in rows.columns if c not in cells]
    rows = rows.select(F.array(*cells).alias("vals"), *folders, *place_columns())
    return rows.join(registry.select("file_path", "file_name", "names"), "file_path").withColumn("vals", F.slice("vals", F.lit(1), F.size("names")))


def cell(name: str) -> Column:
    """The text under a column name, NULL where the file hasn't got it."""
    at = F.array_position("names", F.lit(name)).cast("int")
    return F.when(at > 0, F.get("vals", at - 1))


def read_csv_directory(spark: SparkSession, path: str, id_col: str = "shipment_id", glob: str = "*.csv",
                       multi_line: bool = False) -> DataFrame:
    """All files below a directory, aligned by column name (absent
    columns are NULL, all are text), with ``file_name`` and ``file_ord`` (the
    file's place in path order); files without the id column are skipped. A
    header name is on one line."""
    files = header_registry(spark, path, glob).filter(F.array_contains("names", id_col))
    files = cut_lineage(positions_by_range(files, [], ["file_path"]))
    names = files.select("pos", F.posexplode("names").alias("at", "name")).groupBy("name").agg(F.min(F.struct("pos", "at")).alias("o"))
    columns = [r[0] for r in names.orderBy("o").select("name").collect()]
    if not columns:
        raise ValueError(f"no file below {path} has the column {id_col}")
    rows = scan_layouts(spark, path, files, glob, multi_line).join(files.select("file_path", "pos"), "file_path")
    return rows.select(*[cell(c).alias(c) for c in columns], "file_name", F.col("pos").cast("int").alias("file_ord"))


def attribute_rows(scan: DataFrame, file: Column, prefix: str = "attr_") -> DataFrame:
    """P8 + S10 on a scan of layouts: ``file, attr, attr_ord, value, ord`` for
    every attribute cell that is there; ``attr_ord`` is the column's place in its
    own file, ``ord`` the row's place in the file."""
    pairs = F.filter(F.transform(F.arrays_zip("names", "vals"), lambda x, i: F.struct(x["names"].alias("n"), i.alias("i"), x["vals"].alias("v"))),
                     lambda x: x["n"].startswith(prefix) & x["v"].isNotNull())
    out = scan.select(file.alias("file"), F.struct(*PLACE).alias("ord"), F.explode(pairs).alias("x"))
    return out.select("file", F.substring("x.n", F.lit(len(prefix) + 1), F.length("x.n")).alias("attr"), F.col("x.i").alias("attr_ord"),
                      F.col("x.v").alias("value"), "ord")
