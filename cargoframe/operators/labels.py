"""Label-once-fan-out and batching.

Distinct descriptions are labelled once and the label is joined back to every
row.  Every "first seen" / "in order" rule takes an explicit order column;
nothing relies on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, store

UNCLASSIFIED = "Unclassified"


def distinct_goods(rows: DataFrame, keys: Sequence[str] = ("goods_shipped",), order_col: str = "ord") -> DataFrame:
    """A1: one row per distinct key with its first-seen order and row count.
    Partial aggregation runs before the shuffle, so a hot description costs one
    row per map task, not one per shipment.  Pass a numeric ``order_col``: a
    string min needs a sort-based aggregate."""
    return rows.groupBy(*keys).agg(F.min(order_col).alias("first_ord"), F.count(F.lit(1)).alias("n_rows"))


def first_value(rows: DataFrame, keys: Sequence[str], value_col: str, order_col: str,
                out_col: str | None = None) -> DataFrame:
    """Value of the first row (lowest ``order_col``) per key, in two hash-friendly
    steps: ``min(order)`` per (key, value) shrinks the rows first, then
    ``min_by`` runs on the reduced table (one row per distinct key/value pair)."""
    per = rows.groupBy(*keys, value_col).agg(F.min(order_col).alias("_o"))
    return per.groupBy(*keys).agg(F.min_by(value_col, "_o").alias(out_col or value_col), F.min("_o").alias("first_ord"))


def label_fanout(rows: DataFrame, labels: DataFrame, keys: Sequence[str] = ("goods_shipped",),
                 label_col: str = "category", default: str = UNCLASSIFIED) -> DataFrame:
    """Left join the per-description labels back to every row.
    ``labels`` has one row per key; AQE's skew-join split handles a hot key on
    the row side (the left side of a left outer join may be split)."""
    lab = labels.select(*keys, F.col(label_col).alias("_label"))
    return (rows.join(lab, list(keys), "left")
                .withColumn(label_col, F.coalesce(F.col("_label"), F.lit(default))).drop("_label"))


def remaining(todo: DataFrame, done: DataFrame, keys: Sequence[str] = ("goods_shipped",)) -> DataFrame:
    """Work items not already present in the done table (resume)."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def _chunk_of(id_col: Column, n_chunks: Column) -> Column:
    # Portable bucket: first 8 hex chars of sha256 as an integer, modulo chunks.
    return F.pmod(F.conv(F.substring(F.sha2(id_col, 256), 1, 8), 16, 10).cast("long"), n_chunks)


def goods_to_shipments(rows: DataFrame, keys: Sequence[str] = ("hs4", "product", "goods_shipped"),
                       id_col: str = "shipment_id") -> DataFrame:
    """A2: one row per (description, shipment), at any size of a description."""
    return rows.select(*keys, id_col)


def id_lines(pairs: DataFrame, ids_per_line: int, keys: Sequence[str] = ("hs4", "product", "goods_shipped"),
             id_col: str = "shipment_id") -> DataFrame:
    """K2 flat form, a sink: the ids of a description '|'-joined and sorted, in
    ``ceil(n / ids_per_line)`` lines dealt by a hash of the id, so a line is
    bounded whatever a description owns (``line``, ``n_lines``, ``n_ids``)."""
    sizes = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_ids"))
    n_lines = F.ceil(F.col("n_ids") / F.lit(ids_per_line)).cast("long")
    lined = (pairs.join(sizes, list(keys)).withColumn("n_lines", n_lines)
                  .withColumn("line", _chunk_of(F.col(id_col), F.col("n_lines"))))
    return (lined.groupBy(*keys, "n_ids", "n_lines", "line")
                 .agg(F.array_join(F.array_sort(F.collect_list(id_col)), "|").alias("shipment_ids"),
                      F.count(F.lit(1)).alias("n_in_line")))


def explode_ids(df: DataFrame, ids_col: str = "shipment_ids", out_col: str = "shipment_id",
                sep: str = "|") -> DataFrame:
    """One row per id; a blank id list still yields one row with ''."""
    arr = F.filter(F.split(F.coalesce(F.col(ids_col), F.lit("")), "\\" + sep if sep == "|" else sep),
                   lambda x: x != "")
    return df.withColumn(out_col, F.explode(F.when(F.size(arr) == 0, F.array(F.lit(""))).otherwise(arr)))


def union_ids(a: Column, b: Column) -> Column:
    """Array union of id lists (order of first appearance)."""
    return F.array_union(F.coalesce(a, F.array()), F.coalesce(b, F.array()))


def _range_split(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Range-partition on (group, order) so one hot group spans many tasks;
    ``_pid`` is the range index (ranges are in key order)."""
    return df.repartitionByRange(*group_cols, *order_cols).withColumn("_pid", F.spark_partition_id())


def _range_offsets(local: DataFrame, group_cols: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Per (range, group): the measures summed over all earlier ranges of the group.
    The table has one row per (range, group) pair, tiny next to the data."""
    per = local.groupBy("_pid", *group_cols).agg(*[m.alias(k) for k, m in measures.items()])
    base = Window.partitionBy(*group_cols) if group_cols else Window  # no groups: one row per range
    w = base.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    for k in measures:
        per = per.withColumn(f"_off_{k}", F.coalesce(F.sum(k).over(w), F.lit(0)).cast("long")).drop(k)
    return per


def positions_by_range(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], blocks: Sequence[str] = ()) -> DataFrame:
    """0-based ``pos`` of each row within its group in ``order_cols`` order,
    and the group's ``group_size``, without sending a whole group to one task.

    Rows are range-partitioned on (group, order) and sorted within the range,
    so a row's place in its range is its running id; that of the group's first
    row there is taken off and the counts of the group's earlier ranges are
    added. One exchange; pass the columns that are needed only, as the rows
    are written once so that ids and counts see the same ranges.

    ``blocks`` (the first of ``order_cols``; no groups) tells that rows are in
    order already within the blocks that these columns name, each unbroken in
    one partition, as a scan of files gives them: nothing is exchanged then, and
    a row's place in its block is its running id less that of the block's first."""
    if blocks:
        return _positions_in_blocks(df, blocks)
    cols = [*group_cols, *order_cols]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_mid", F.monotonically_increasing_id())
    local = cut_lineage(ranged).withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_at", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    per = local.groupBy("_pid", *group_cols).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))  # one row per range and group
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_pid", *group_cols, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_add"),
                     F.sum("_n").over(whole).alias("group_size"))
    out = local.join(per, ["_pid", *group_cols])
    return out.withColumn("pos", (F.col("_at") + F.col("_add")).cast("long")).drop("_pid", "_mid", "_at", "_add")


def _positions_in_blocks(df: DataFrame, blocks: Sequence[str]) -> DataFrame:
    # one materialisation: a second scan might cut the files into other blocks
    local = store(df.withColumn("_mid", F.monotonically_increasing_id()))
    per = local.groupBy(*blocks).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(F.lit(0))  # one row per block of a file
    before = whole.orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*blocks, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_add"),
                     F.sum("_n").over(whole).alias("group_size"))
    out = local.join(F.broadcast(per), list(blocks))
    return out.withColumn("pos", (F.col("_mid") + F.col("_add")).cast("long")).drop("_mid", "_add")


def batch_numbers_scaled(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                         batch_size: int) -> DataFrame:
    """W1 for groups of any size (see ``positions_by_range``)."""
    pos = positions_by_range(df, group_cols, order_cols)
    return (pos.withColumn("batch", F.floor(F.col("pos") / batch_size).cast("long"))
               .withColumn("pos_in_batch", (F.col("pos") % batch_size).cast("int"))
               .withColumn("n_batches", F.ceil(F.col("group_size") / batch_size).cast("long")).drop("group_size"))


def running_total(df: DataFrame, order_cols: Sequence[str], value_col: str, out_col: str = "before") -> DataFrame:
    """Sum of ``value_col`` over all rows strictly before each row in a global
    order, computed per range partition plus offsets (no single-task window)."""
    ranged = _range_split(df, [], order_cols)
    w_local = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    # one materialisation so the local sums and the range totals share bounds
    local = cut_lineage(ranged.withColumn("_lsum", F.coalesce(F.sum(value_col).over(w_local), F.lit(0))))
    offsets = _range_offsets(local, [], {"s": F.sum(value_col)})
    out = local.join(offsets, ["_pid"])
    return out.withColumn(out_col, (F.col("_off_s") + F.col("_lsum")).cast("long")).drop("_pid", "_lsum", "_off_s")


def token_budget(batches: DataFrame, tokens_col: str, order_cols: Sequence[str], budget: int) -> DataFrame:
    """A batch is admitted while the tokens used before it are below the
    budget (one global order over the per-batch table, via ``running_total``)."""
    return (running_total(batches, order_cols, tokens_col, "tokens_before")
            .withColumn("admitted", F.col("tokens_before") < F.lit(budget)))


def batch_tokens(rows: DataFrame, batch_keys: Sequence[str], tokens_col: str,
                 per_label_tokens: int = 3) -> DataFrame:
    """F12 per batch: the items' token estimates (``token_estimate``) summed,
    plus 3 output tokens per item."""
    return rows.groupBy(*batch_keys).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(tokens_col).cast("long").alias("input_tokens"),
    ).withColumn("tokens", F.col("input_tokens") + F.col("n_items") * per_label_tokens)


def sample_key(text_col: str, seed: int) -> Column:
    """W2's deterministic draw order: sha256 of seed and text (portable to SQL)."""
    return F.sha2(F.concat(F.lit(str(seed)), F.col(text_col)), 256)


def seeded_rounds(texts: DataFrame, text_col: str, n: int, seeds: Sequence[int], keep: Sequence[Column] = ()) -> DataFrame:
    """For each round (0-based) n distinct texts in the pseudo-random order
    of its seed (all when fewer): round, sample_key and the columns ``keep``
    of the text.  The texts are read once and don't travel: equal texts fall
    together by their keys, and the window keeps n rows per task first."""
    keyed = texts.select(*keep, F.posexplode(F.array(*[sample_key(text_col, s) for s in seeds])).alias("round", "sample_key")).distinct()
    w = Window.partitionBy("round").orderBy("sample_key")
    return keyed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def cap_per_group(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence, n: int) -> DataFrame:
    """Keep the first n rows per group in a stated order."""
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def render_batches(items: DataFrame, batch_keys: Sequence[str], pos_col: str, text_col: str,
                   header: Column | None = None, sep: str = "\n") -> DataFrame:
    """One prompt text per batch: header line then ``pos. text`` lines in order.
    The template text is a parameter; the plan is groupBy + ordered collect
    (a batch is small by construction)."""
    line = F.struct(F.col(pos_col).alias("p"), F.concat((F.col(pos_col) + 1).cast("string"), F.lit(". "),
                                                        F.col(text_col)).alias("l"))
    agg = items.groupBy(*batch_keys).agg(F.array_sort(F.collect_list(line)).alias("_lines"),
                                         F.count(F.lit(1)).alias("n_items"))
    body = F.array_join(F.transform("_lines", lambda x: x["l"]), sep)
    text = body if header is None else F.concat(header, F.lit(sep), body)
    return agg.withColumn("prompt", text).drop("_lines")
