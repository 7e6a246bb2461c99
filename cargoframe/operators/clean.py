"""Load-time cleaning, filters and table profiles."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TRUTHY_FLAGS, hs4_from_digits, hs4_prefix, strip_ws
from ..session import cut_lineage

REQUIRED_SHIPMENT_COLUMNS = ["hs_code", "goods_shipped", "shipment_id"]
REQUIRED_CLASSIFIED_COLUMNS = ["hs_code", "goods_shipped", "category"]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail at plan-build time when a required column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    return df


def standardize_shipments(df: DataFrame) -> DataFrame:
    """Trim the key columns, NULL goods -> ''; derive both HS-4 forms."""
    require_columns(df, REQUIRED_SHIPMENT_COLUMNS)
    return standardize_goods(df).withColumn("shipment_id", strip_ws(F.col("shipment_id").cast("string")))


def standardize_goods(df: DataFrame) -> DataFrame:
    """P1 for what describes the goods only, so that a table of goods can be
    cleaned before it meets its shipments."""
    return (df.withColumn("hs_code", strip_ws(F.col("hs_code").cast("string")))
              .withColumn("goods_shipped", strip_ws(F.coalesce(F.col("goods_shipped").cast("string"), F.lit(""))))
              .withColumn("hs4", hs4_from_digits("hs_code"))
              .withColumn("hs4_prefix", hs4_prefix("hs_code")))


def drop_empty_goods(df: DataFrame) -> DataFrame:
    """Rows whose goods text is empty after trimming are dropped."""
    return df.filter(F.col("goods_shipped") != "")


def load_clean(df: DataFrame) -> DataFrame:
    """Standardise + drop empty goods (the CSV loader's output)."""
    return drop_empty_goods(standardize_shipments(df))


def removed_empty_count(df: DataFrame) -> DataFrame:
    """P2's counter, computed in the same single aggregate as the totals."""
    g = strip_ws(F.coalesce(F.col("goods_shipped").cast("string"), F.lit("")))
    return df.agg(F.count(F.lit(1)).alias("rows_in"),
                  F.count_if(g == "").alias("rows_removed"),
                  F.count_if(g != "").alias("rows_out"))


def is_truthy(c) -> F.Column:
    return F.coalesce(F.lower(strip_ws(F.col(c) if isinstance(c, str) else c)).isin(TRUTHY_FLAGS), F.lit(False))


def filter_multi_product(df: DataFrame, flag_col: str = "is_multi_product_shipment") -> DataFrame:
    """Drop rows flagged multi-product; NULL keeps the row; no column = no-op."""
    if flag_col not in df.columns:
        return df
    return df.filter(~is_truthy(flag_col))


def filter_hs(df: DataFrame, codes: Iterable[str] | None = None, hs_col: str = "hs4") -> DataFrame:
    """Keep rows whose HS-4 is in the user's list (first four characters)."""
    if not codes:
        return df
    return df.filter(F.col(hs_col).isin([str(c)[:4] for c in codes]))


def filter_hs_in_schema(df: DataFrame, schema: DataFrame, hs_col: str = "hs4") -> DataFrame:
    """Keep rows whose HS-4 the schema holds (semi join)."""
    return df.join(schema.select(hs_col).distinct(), hs_col, "left_semi")


def filter_equals(df: DataFrame, filters: dict | None) -> DataFrame:
    """Conjunction of ``column = value`` filters (pushed into the scan)."""
    cond = F.lit(True)
    for k, v in (filters or {}).items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond)


def load_classified(df: DataFrame, id_col: str = "shipment_id", order_col: str = "ord") -> DataFrame:
    """S3: classified rows -> (hs_code as HS-4 prefix, category, goods, shipment_id).

    When no shipment id exists one is numbered 1..n over ``order_col``, by
    range partitions (no task sorts the whole table)."""
    require_columns(df, REQUIRED_CLASSIFIED_COLUMNS)
    out = (df.withColumn("hs_code", hs4_prefix("hs_code"))
             .withColumn("goods_shipped", strip_ws(F.col("goods_shipped").cast("string")))
             .withColumn("category", strip_ws(F.col("category").cast("string"))))
    if id_col in df.columns:
        out = out.withColumn(id_col, strip_ws(F.col(id_col).cast("string")))
    else:
        from .labels import positions_by_range
        out = positions_by_range(out, [], [order_col]).withColumn(id_col, (F.col("pos") + 1).cast("string"))
    return out.filter(F.col("goods_shipped").isNotNull()).select("hs_code", "category", "goods_shipped", id_col)


def usable_training_rows(df: DataFrame) -> DataFrame:
    """Drop NULL/'Unclassified' categories and blank goods."""
    return df.filter(F.col("category").isNotNull() & (F.col("category") != "Unclassified")
                     & F.col("goods_shipped").isNotNull() & (strip_ws("goods_shipped") != ""))


def with_default(df: DataFrame, col: str, value: str) -> DataFrame:
    """Add a constant column only when it is absent."""
    return df if col in df.columns else df.withColumn(col, F.lit(value))


WORD_BITS = 62  # slices of a cube in one word
SKETCH_LG_K = 14  # 2^14 registers: a standard error of about 0.8 %


def distinct_sketches(df: DataFrame, slices: Sequence[str], columns: Sequence[str], lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A5 approximately, mergeable: per slice one HLL sketch of every column
    (``sk_<column>``, binary) and ``n_rows``. NULLs aren't counted."""
    return df.groupBy(*slices).agg(F.count(F.lit(1)).alias("n_rows"), *[F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"sk_{c}") for c in columns])


def merge_sketches(sketches: DataFrame, by: Sequence[str], cube: bool = False) -> DataFrame:
    """Coarser slices from finer ones without reading the rows again: sketches
    united and read as ``n_<column>``; ``cube`` gives every combination of
    ``by`` (NULL: all)."""
    cols = [c for c in sketches.columns if c.startswith("sk_")]
    g = sketches.cube(*by) if cube else sketches.groupBy(*by)
    # a column of NULLs only has no sketch in a slice
    return g.agg(F.sum("n_rows").cast("long").alias("n_rows"), *[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).cast("long").alias("n_" + c.removeprefix("sk_")) for c in cols])


def cube_distinct(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact distinct counts of ``columns`` in every combination of ``by``
    (NULL: all), as ``cube`` with ``countDistinct`` gives them.

    Every slice of the cube is a bit of a numbered word, so a row is one
    (value, word, bits) instead of a row per column and combination, and one
    aggregate per column (bits united before the shuffle) finds the slices
    that a value occurs in. The slices themselves are a report-sized table."""
    seen = df.select(*by).distinct()
    level = lambda m: F.struct(*[F.when(F.lit(bool(m >> i & 1)), F.col(c)).alias(c) for i, c in enumerate(by)], F.lit(m).alias("_level"))
    own = seen.withColumn("_s", F.explode(F.array(*[level(m) for m in range(1 << len(by))])))
    w = Window.orderBy("_s")  # the slices of the cube: a small table
    own = own.withColumn("_n", F.dense_rank().over(w) - 1).select(
        *by, "_s", F.floor(F.col("_n") / WORD_BITS).cast("int").alias("_word"), F.expr(f"shiftleft(1L, _n % {WORD_BITS})").alias("_bit"))
    own = cut_lineage(own)
    slices = own.select("_s", "_word", "_bit").distinct()
    names = [f"_by{i}" for i in range(len(by))]
    words = own.groupBy(*[F.col(c).alias(n) for c, n in zip(by, names)], "_word").agg(F.bit_or("_bit").alias("_bits"))
    same = functools.reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(c)) for c, n in zip(by, names)])
    out = slices
    for i, c in enumerate(columns):
        rows = df.select(*by, F.col(c).alias("_v")).filter(F.col("_v").isNotNull()).join(F.broadcast(words), same)
        per_value = rows.groupBy("_v", "_word").agg(F.bit_or("_bits").alias("_bits"))
        s = slices.select(F.col("_word").alias("_w"), "_bit")
        n = (per_value.join(F.broadcast(s), (F.col("_word") == F.col("_w")) & (F.col("_bits").bitwiseAND(F.col("_bit")) != 0))
             .groupBy("_word", "_bit").agg(F.count(F.lit(1)).alias(f"_c{i}")))
        out = out.join(n, ["_word", "_bit"], "left")
    return out.select(*[F.col("_s")[c].alias(c) for c in by], *[F.coalesce(f"_c{i}", F.lit(0)).alias(f"n_{c}") for i, c in enumerate(columns)])


def profile_shipments(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct HS/goods/shipments, all-empty flags, dedup ratio.
    Every distinct count is its own two-step aggregate over one pruned column
    (several in one aggregate would multiply the rows before the shuffle).
    ``approximate`` counts with sketches instead, all in one pass."""
    if approximate:
        flags = [(F.count_if(F.col(c).isNotNull() & (F.col(c) != "")) == 0).alias(n) for c, n in
                 (("goods_shipped", "goods_all_empty"), ("shipment_id", "ids_all_empty"), ("hs_code", "hs_all_empty"))]
        count = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(SKETCH_LG_K))), F.lit(0))
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), count("hs_code").alias("n_hs_codes"), count("goods_shipped").alias("n_goods"),
                     count("shipment_id").alias("n_shipments"), *flags)
        return one.withColumn("dedup_ratio", F.round(F.col("n_goods") / F.greatest(F.col("n_rows"), F.lit(1)), 6))
    def all_empty(c):
        return F.count_if(F.col(c).isNotNull() & (F.col(c) != "")) == 0

    def distinct(c):
        return df.select(c).filter(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()
    flags = df.agg(F.count(F.lit(1)).alias("n_rows"), all_empty("goods_shipped").alias("goods_all_empty"),
                   all_empty("shipment_id").alias("ids_all_empty"), all_empty("hs_code").alias("hs_all_empty"))
    return flags.select("n_rows", distinct("hs_code").alias("n_hs_codes"), distinct("goods_shipped").alias("n_goods"),
                        distinct("shipment_id").alias("n_shipments"), "goods_all_empty", "ids_all_empty", "hs_all_empty").withColumn(
        "dedup_ratio", F.round(F.col("n_goods") / F.greatest(F.col("n_rows"), F.lit(1)), 6))


def available_hs4(df: DataFrame, hs_col: str = "hs4") -> DataFrame:
    """Sorted distinct non-empty HS-4 codes."""
    return df.select(hs_col).filter(F.col(hs_col) != "").distinct().orderBy(hs_col)
