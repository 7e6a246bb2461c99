"""Sinks whose files, read in their order, are sorted as a whole (K2, K5).

Rows are dealt to ranges of the sort key and sorted within them, so part files
follow each other in key order without any task seeing all rows. Rows for several
sinks by one key are dealt once: with ``ranged`` a sink takes them as they stand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import json_string
from .files import compressed, write_csv
from .layouts import BLOCK, PLACE, place_columns


def in_ranges(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)


def write_sorted_csv(df: DataFrame, path: str, order_cols: Sequence[str], partition_by: Sequence[str] = (), drop: Sequence[str] = (),
                     ranged: bool = False, compression: str = "none") -> None:
    """CSV whose part files, in the order of their numbers, hold the rows by
    ``order_cols``; with ``partition_by``, so does every folder. ``drop`` names
    columns that only give the order."""
    df = df if ranged else in_ranges(df, [*partition_by, *order_cols])
    write_csv(df.drop(*drop), path, partition_by=partition_by, compression=compression)


def write_json_object(df: DataFrame, path: str, key_col: str, json_col: str, ranged: bool = False, compression: str = "none") -> None:
    """One JSON object ``{key: json, …}`` over all part files, by key; each row is
    a line, and only the least and the greatest key (two scalars) decide where
    the braces go. Keys are unique and not NULL; no rows give ``{}``."""
    low, high = df.agg(F.min(key_col), F.max(key_col)).first()
    if low is None:
        none = df.sparkSession.range(1).select(F.lit("{}").alias("value")).coalesce(1)
        compressed(none.write.mode("overwrite"), compression).text(path)
        return
    k = F.col(key_col)
    line = F.concat(F.when(k == F.lit(low), F.lit("{")).otherwise(F.lit("")), json_string(k.cast("string")), F.lit(": "), F.col(json_col),
                    F.when(k == F.lit(high), F.lit("}")).otherwise(F.lit(",")))
    lines = df.select(key_col, line.alias("value"))
    lines = lines if ranged else in_ranges(lines, [key_col])
    compressed(lines.select("value").write.mode("overwrite"), compression).text(path)


def write_classification_object(rows: DataFrame, path: str) -> None:
    """K2: ``{hs4: {product: [{"goods_shipped", "attributes", "shipment_ids"}]}}``
    over all part files, sorted by code, product and description.

    ``rows``: ``hs4, product, goods_shipped, attributes`` (JSON text) and one row
    per ``line`` of ``ids`` (array), so that a description with any number of
    shipments stays in bounded rows. Each row is a line of the file; where
    brackets open and close follows from the first and last row of every
    product, code and of all, which are aggregates. No rows give ``{}``."""
    group, item = ["hs4", "product"], ["hs4", "product", "goods_shipped"]
    at = F.struct("goods_shipped", "line")
    ends = rows.groupBy(*group).agg(F.min(at).alias("_low"), F.max(at).alias("_high"))
    codes = ends.groupBy("hs4").agg(F.min("product").alias("_first"), F.max("product").alias("_last"))
    low, high = codes.agg(F.min("hs4"), F.max("hs4")).first()
    if low is None:
        df = rows.sparkSession.range(1).select(F.lit("{}").alias("value"))
        df.coalesce(1).write.mode("overwrite").text(path)
        return
    lines = rows.groupBy(*item).agg(F.min("line").alias("_l0"), F.max("line").alias("_l1"))
    r = rows.join(lines, item).join(ends, group).join(codes, "hs4")
    first_item, last_item = F.col("line") == F.col("_l0"), F.col("line") == F.col("_l1")
    first_product, last_product = at == F.col("_low"), at == F.col("_high")
    first_code, last_code = first_product & (F.col("product") == F.col("_first")), last_product & (F.col("product") == F.col("_last"))
    text = lambda cond, *parts: F.when(cond, F.concat(*parts)).otherwise(F.lit(""))
    line = F.concat(
        text(first_code, F.when(F.col("hs4") == F.lit(low), F.lit("{")).otherwise(F.lit("")), json_string("hs4"), F.lit(": {")),
        text(first_product, json_string("product"), F.lit(": [")),
        text(first_item, F.lit('{"goods_shipped": '), json_string("goods_shipped"), F.lit(', "attributes": '), F.col("attributes"), F.lit(', "shipment_ids": [')),
        F.array_join(F.transform("ids", json_string), ", "),
        F.when(~last_item, F.lit(",")).when(~last_product, F.lit("]},")).when(~last_code, F.lit("]}],"))
         .when(F.col("hs4") == F.lit(high), F.lit("]}]}}")).otherwise(F.lit("]}]},")))
    in_ranges(r.select(*item, "line", line.alias("value")), [*item, "line"]).select("value").write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of part files (``line``) with the columns ``PLACE``, which sort them
    in file order."""
    return spark.read.text(path).select(F.col("value").alias("line"), *place_columns())


def read_sorted_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a header CSV as text, with the columns ``PLACE``."""
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.select("*", *place_columns())


__all__ = ["BLOCK", "PLACE", "in_ranges", "read_lines", "read_sorted_csv", "write_classification_object", "write_json_object", "write_sorted_csv"]
