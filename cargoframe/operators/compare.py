"""Label-set comparisons and run statistics.

Each report is one aggregation pass; ``rollup`` gives the per-group and the
overall line together.  Sample rows are a stated-order top-k per group
(row_number <= k, which Spark turns into a per-task group limit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def category_distribution(df: DataFrame, cat_col: str = "category") -> DataFrame:
    """A4: count per category and its percentage of **all** rows (NULL
    categories are not a group but stay in the denominator)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.filter(F.col(cat_col).isNotNull()).groupBy(cat_col).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("pct", F.round(F.col("n") * 100.0 / total, 2)))


def label_pairs(a: DataFrame, b: DataFrame, key: str, label_col: str = "category") -> DataFrame:
    """Rows (key, label_a, label_b, n) of two label sets that stand in
    different tables."""
    return (a.select(key, F.col(label_col).alias("label_a")).join(b.select(key, F.col(label_col).alias("label_b")), key, "inner")
             .withColumn("n", F.lit(1).cast("long")))


def pairs_within(rows: DataFrame, key: str) -> DataFrame:
    """J7 for label sets that stand in the same rows (key, label_a, label_b):
    the pairs of a join on ``key`` with their number ``n``, without the join.
    Equal rows of a key are counted first, so a key's list is short."""
    c = rows.groupBy(key, "label_a", "label_b").agg(F.count(F.lit(1)).alias("n"))
    g = c.groupBy(key).agg(F.collect_list(F.struct("label_a", "label_b", "n")).alias("g"))
    x = g.select(key, "g", F.explode("g").alias("x")).select(key, "x", F.explode("g").alias("y"))
    return x.select(key, "x.label_a", "y.label_b", (F.col("x.n") * F.col("y.n")).alias("n"))


def label_agreement(pairs: DataFrame, label_col: str = "category") -> DataFrame:
    """Agreement of pairs (label_a, label_b, n) by ``label_b`` (the
    reference set) and overall (``category`` NULL, ``level`` = 'overall')."""
    r = pairs.rollup("label_b").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("label_a") == F.col("label_b"), F.col("n"))), F.lit(0)).alias("n_agree"),
                                    F.grouping_id().alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("overall")).otherwise(F.lit("category")).alias("level"),
                    F.col("label_b").alias(label_col), "n", "n_agree",
                    (F.col("n") - F.col("n_agree")).alias("n_disagree"),
                    F.round(F.col("n_agree") * 100.0 / F.col("n"), 2).alias("agreement_pct"))


def disagreement_samples(pairs: DataFrame, key: str, k: int = 10) -> DataFrame:
    """A7's sample: the first k disagreements in key order (a top-k report)."""
    top = pairs.filter(F.col("label_a") != F.col("label_b")).orderBy(key).limit(k)
    return top.select(key, "label_a", "label_b", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k).cast("long"))))).drop("col").orderBy(key).limit(k)


def attribute_agreement(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A8 + J8 + P13 on the long form ``keys + [attr, value]``: per attribute
    and overall — comparisons where both values are non-NULL, agreements,
    disagreements, rate (6 dp)."""
    j = (a.select(*keys, "attr", F.col("value").alias("va"))
          .join(b.select(*keys, "attr", F.col("value").alias("vb")), [*keys, "attr"], "inner")
          .filter(F.col("va").isNotNull() & F.col("vb").isNotNull()))
    r = j.rollup("attr").agg(F.count(F.lit(1)).alias("comparisons"),
                             F.count_if(F.col("va") == F.col("vb")).alias("agreements"),
                             F.grouping_id().alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("overall")).otherwise(F.lit("attribute")).alias("level"),
                    "attr", "comparisons", "agreements",
                    (F.col("comparisons") - F.col("agreements")).alias("disagreements"),
                    F.round(F.col("agreements") / F.col("comparisons"), 6).alias("agreement_rate"))


def attribute_disagreement_samples(a: DataFrame, b: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                                   k: int = 5) -> DataFrame:
    """A8's samples: first k disagreements per attribute in a stated order."""
    j = (a.select(*keys, "attr", F.col("value").alias("va"))
          .join(b.select(*keys, "attr", F.col("value").alias("vb")), [*keys, "attr"], "inner")
          .filter(F.col("va").isNotNull() & F.col("vb").isNotNull() & (F.col("va") != F.col("vb"))))
    w = Window.partitionBy("attr").orderBy(*order_cols)
    return j.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def pattern_profile(df: DataFrame, text_col: str, id_col: str, patterns: dict[str, str], k: int = 3) -> DataFrame:
    """Rows whose text contains each pattern (case-insensitive) and the
    first k ids as samples.  ``patterns`` maps a name to a regex (user
    configuration); the list rides along each row as a literal array, so only
    matching (row, pattern) pairs are emitted — no join fan-out."""
    arr = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("(?i)" + p).alias("pattern"))
                    for n, p in patterns.items()])
    hits = (df.select(id_col, F.explode(F.filter(arr, lambda p: F.regexp(F.col(text_col), p["pattern"]))).alias("p"))
              .select(id_col, F.col("p.name").alias("name")))
    counts = hits.groupBy("name").agg(F.count(F.lit(1)).alias("record_count"))
    w = Window.partitionBy("name").orderBy(id_col)
    samples = (hits.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
                   .groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(id_col)),
                                                                 lambda x: x.cast("string")), "|").alias("sample_ids")))
    return counts.join(samples, "name")


def report_rows(df: DataFrame, section: str, rank: Column | None = None) -> DataFrame:
    """A report section as JSON lines (``section``, ``json``, and ``rank``
    where the section has an order), one per result row; write with
    ``sources.files.write_json_lines``."""
    order = [] if rank is None else [rank.alias("rank")]
    return df.select(F.lit(section).alias("section"), *order, F.to_json(F.struct(*df.columns)).alias("json"))
