"""File and table sources and sinks.

CSV input is read by header name, all columns as text (no inference pass over
100 TB), so ``hs_code`` keeps leading zeros.  Directories of files with
differing columns are in ``layouts``, sorted sinks in ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.clean import load_clean, require_columns

SHIPMENT_TEXT_COLUMNS = ["shipment_id", "hs_code", "goods_shipped", "date", "shipment_origin", "shipment_destination",
                         "port_of_lading", "port_of_lading_country", "port_of_unlading", "port_of_unlading_country",
                         "trade_direction", "transport_method", "is_containerized", "value_of_goods_usd",
                         "weight_in_kg", "is_multi_product_shipment", "category", "product"]


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, glob: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """Header CSV; every column is text under its header's name (no inference
    pass), whatever the order, unless a schema is given for files whose
    columns stand in that order.  ``multi_line`` allows line breaks in quoted
    fields, at the price of one split per file.  ``file_name`` carries the
    source file (S12)."""
    r = (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
              .option("mode", "PERMISSIVE"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path if isinstance(path, str) else list(path))
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def load_shipments_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read by header name, check the required columns on the real header,
    trim, drop empty descriptions; other columns are kept."""
    return load_clean(require_columns(read_csv(spark, path, multi_line=multi_line), ["hs_code", "goods_shipped", "shipment_id"]))


def load_table(spark: SparkSession, table: str | None = None, query: str | None = None,
               filters: dict | None = None, args: dict | None = None) -> DataFrame:
    """A catalog table (or a SQL query with named parameters ``args``) with
    ``column = value`` filters pushed down; ``hs_code`` trimmed and cut to four
    characters like the reference's warehouse loader."""
    df = spark.sql(query, args=args or {}) if query else spark.table(table)
    for k, v in (filters or {}).items():
        df = df.filter(F.col(k) == F.lit(v))
    if "hs_code" in df.columns:
        df = df.withColumn("hs_code", F.substring(F.trim(F.col("hs_code").cast("string")), 1, 4))
    return df


def peek(df: DataFrame) -> tuple[StructType, list]:
    """Schema and one row (a bounded sample, for interactive checks)."""
    return df.schema, df.limit(1).collect()


def compressed(writer: DataFrameWriter, compression: str) -> DataFrameWriter:
    """Text files with that codec; gzip at its fastest level, whose time is near
    that of plain files."""
    return writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", compression: str = "none") -> None:
    """CSV sink with a header; ``partition_by`` gives one directory per key
    (K1's per-product files become ``hs4=…/product=…`` partitions)."""
    w = compressed(df.write.mode(mode), compression).option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_json_lines(df: DataFrame, text_col: str, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink for rows that already hold rendered JSON text (K2, K5)."""
    df.select(F.col(text_col).alias("value")).write.mode(mode).text(path)
