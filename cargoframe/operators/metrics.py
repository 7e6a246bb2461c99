"""Counts taken by the pass that does the work.

``DataFrame.observe`` lets the job that writes a table count what it sees, so no
second scan is needed. The observed aggregate stands in the writing stage,
after the last shuffle, where Spark counts a partition once even if its task
ran again; before a shuffle a repeated stage could count twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .clean import drop_empty_goods, standardize_shipments


def write_counted(df: DataFrame, path: str, **counts) -> dict:
    """Write ``df`` as Parquet; the ``counts`` (aggregate Columns by name) of its rows."""
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.mode("overwrite").parquet(path)
    return seen.get


def load_counted(raw: DataFrame, path: str, after: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """P1 + P2: clean shipments, write them (after ``after``) and return
    ``rows_in, rows_removed, rows_out`` counted on the way."""
    before = Observation()
    rows = standardize_shipments(raw).observe(before, F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("goods_shipped") == "").alias("rows_removed"))
    kept = drop_empty_goods(rows)
    out = write_counted(kept if after is None else after(kept), path, rows_out=F.count(F.lit(1)))
    return {**before.get, **out}


def coverage_counts() -> dict:
    """A18's counts over ``dictionary.match_summary`` rows, for ``write_counted``."""
    return {
        "rows_with_any_match": F.count_if(F.col("attrs_matched") > 0), "rows_total": F.count(F.lit(1)),
        "attribute_matches": F.coalesce(F.sum(F.col("attrs_matched").cast("long")), F.lit(0)),
        "attribute_attempted": F.coalesce(F.sum(F.col("attrs_tried").cast("long")), F.lit(0)),
        "negation_blocked": F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0))}

