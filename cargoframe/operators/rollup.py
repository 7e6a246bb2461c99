"""Per-product and per-shipment rollups.

Wide ``attr_*`` layouts exist only at the edges: internally everything is the
long form ``(keys…, attr, value, ord)`` so rules are one groupBy each, and a
wide row is built in place (``dictionary.resolve_attributes``) only when a
file-shaped output is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (JSON_ESCAPED, ROLLUP_MISSING_VALUES, attr_to_snake, clean_value, json_string,
                              json_text_array, json_text_object, snake_case_combined, strip_odd, strip_ws)

ATTR_PREFIX = "attr_"


def attr_columns(df: DataFrame) -> list[str]:
    """``attr_*`` columns, case-sensitive, in column order."""
    return [c for c in df.columns if c.startswith(ATTR_PREFIX)]


def unpivot_attributes(wide: DataFrame, ids: Sequence[str], drop_prefix: bool = True,
                       skip_none: bool = True) -> DataFrame:
    """Wide ``attr_*`` columns -> ``(ids…, attr, attr_ord, value)``;
    NULLs always dropped, 'None' and blanks dropped when ``skip_none``."""
    cols = attr_columns(wide)
    if not cols:
        return wide.select(*ids, F.lit("RawText").alias("attr"), F.lit(0).alias("attr_ord"),
                           F.lit("True").alias("value"))
    stacked = wide.select(*ids, F.explode(F.array(*[
        F.struct(F.lit(c[len(ATTR_PREFIX):] if drop_prefix else c).alias("attr"), F.lit(i).alias("attr_ord"),
                 F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])).alias("_a"))
    out = stacked.select(*ids, "_a.attr", "_a.attr_ord", "_a.value").filter(F.col("value").isNotNull())
    if skip_none:
        out = out.filter((strip_ws("value") != "") & (F.col("value") != "None"))
    return out


def schema_master(long_df: DataFrame, group_cols: Sequence[str], order_col: str = "ord") -> DataFrame:
    """A9 + K4: per file/product, per attribute column (snake-cased, prefix
    dropped): distinct cleaned values compared case-insensitively, first-seen
    spelling, in first-seen order; rendered as ``json.dumps`` text with
    attributes in column order.

    ``long_df``: ``group_cols + [attr (column name), attr_ord, value, ord]``."""
    v = long_df.withColumn("cv", clean_value("value"))
    # min order per exact value first (hash aggregate; a NULL cv keeps the
    # column present even when it has no usable value), then per folded value
    per = v.groupBy(*group_cols, "attr", "attr_ord", "cv").agg(F.min(order_col).alias("_o"))
    first = (per.groupBy(*group_cols, "attr", "attr_ord", F.lower(strip_ws("cv")).alias("_k"))
                .agg(F.min(F.struct(F.col("_o").alias("o"), F.col("cv").alias("v"))).alias("_f")))
    per_attr = first.groupBy(*group_cols, "attr", "attr_ord").agg(
        F.array_sort(F.collect_list(F.when(F.col("_k").isNotNull(), F.col("_f")))).alias("_vals"))
    # two columns with one key: the key keeps its place, the later column's values win
    keyed = per_attr.withColumn("_key", attr_to_snake(F.concat(F.lit(ATTR_PREFIX), F.col("attr"))))
    keyed = keyed.groupBy(*group_cols, "_key").agg(F.min("attr_ord").alias("_place"), F.max_by("_vals", "attr_ord").alias("_vals"))
    entry = F.struct(F.col("_place").alias("o"), F.col("_key").alias("k"), json_text_array(F.transform("_vals", lambda x: x["v"])).alias("v"))
    return keyed.groupBy(*group_cols).agg(
        json_text_object(F.array_sort(F.collect_list(entry))).alias("schema_json"))


def shipment_attributes(rows: DataFrame, columns: Sequence[tuple[str, str]], id_col: str = "shipment_id",
                        order_cols: Sequence[str] = ("file_ord", "ord"), product_col: str = "product",
                        in_ranges: bool = False) -> DataFrame:
    """A10 + K5: per shipment, attributes merged over files: ``columns`` names
    the attribute columns of the wide ``rows`` in file order with their key
    (``snake_case_combined`` of the name); the later (file, row, column) wins;
    a key keeps its first position; blanks and nan/none/null are skipped.
    Product is the last non-empty one.

    One aggregation per shipment: its rows are never exploded per attribute.
    Most shipments have few rows, so the rows are shuffled as they are, cleaned
    and sorted once; what ``max_by`` and ``min`` hold per key is wider than they.
    With ``in_ranges`` that shuffle deals ranges of ids, and the result stands in
    them sorted, for sinks by id."""
    def usable(u: str) -> Column:
        return F.when(~F.lower(u).isin(ROLLUP_MISSING_VALUES), F.col(u))

    at = F.struct(*[F.col(c) for c in order_cols])
    keys = list(dict.fromkeys(k for _, k in columns if k))
    own = {k: [i for i, (_, key) in enumerate(columns) if key == k] for k in keys}
    used = [(f"_u{i}", F.col(c).cast("string")) for i, (c, key) in enumerate(columns) if key]
    r = rows.withColumn(id_col, strip_ws(id_col)).filter(F.col(id_col) != "").select(
        id_col, at.alias("_at"), F.col(product_col).alias("_prod"), *[c.alias(u) for u, c in used])
    # cells are cleaned after the shuffle: ranges are found by a pass over what is before it
    r = r.repartitionByRange(id_col) if in_ranges else r.repartition(id_col)
    r = r.select(id_col, "_at", *[strip_odd(u).alias(u) for u in ("_prod", *(u for u, _ in used))])
    r = r.select(id_col, "_at", "_prod", *[usable(u).alias(u) for u, _ in used])
    aggs = [F.max_by("_prod", F.when(F.col("_prod") != "", F.col("_at"))).alias("_product")]
    for n, places in enumerate(own.values()):
        value = F.coalesce(*[F.col(f"_u{i}") for i in reversed(places)])
        first = F.coalesce(*[F.when(F.col(f"_u{i}").isNotNull(), F.lit(i)) for i in places])
        there = value.isNotNull()
        aggs += [F.max_by(value, F.when(there, F.col("_at"))).alias(f"_v{n}"),
                 F.min(F.when(there, F.struct("_at", first.alias("_c")))).alias(f"_p{n}")]
    g = r.groupBy(id_col).agg(*aggs)
    # Most shipments' keys stand in column order and their values need no escape: their text is one concatenation.
    # The others' entries go through lambda functions, whose arguments are not compiled; compiled, they are too
    # much code for one method, which slows all rows.
    places = [F.col(f"_p{n}") for n in range(len(keys))]
    simple = ~F.concat_ws("", *[F.col(f"_v{n}") for n in range(len(keys))]).rlike(JSON_ESCAPED)
    for n in range(1, len(keys)):
        simple = simple & F.coalesce(F.coalesce(*reversed(places[:n])) <= places[n], F.lit(True))
    plain = F.concat_ws(", ", *[F.concat(json_string(F.lit(k)), F.lit(': "'), F.col(f"_v{n}"), F.lit('"')) for n, k in enumerate(keys)])
    # an entry's text is made here, where a key is a constant, and not per element
    entries = F.array_sort(F.filter(F.array(*[
        F.struct(F.col(f"_p{n}._at").alias("o"), F.col(f"_p{n}._c").alias("c"),
                 F.concat(json_string(F.lit(k)), F.lit(": "), json_string(f"_v{n}")).alias("t")) for n, k in enumerate(keys)]), lambda e: e["t"].isNotNull()))
    text = F.concat(F.lit("{"), F.when(simple, plain).otherwise(F.array_join(entries["t"], ", ")), F.lit("}"))
    out = g.select(id_col, F.coalesce("_product", F.lit("")).alias(product_col), text.alias("attrs_json"))
    return out.sortWithinPartitions(id_col) if in_ranges else out


def keyed_columns(spark, names: Sequence[str]) -> list[tuple[str, str]]:
    """(column, key) of attribute columns, the key by the column rule F4
    (evaluated once on the names)."""
    text = spark.range(1).select(*[snake_case_combined(F.lit(n.removeprefix(ATTR_PREFIX))).alias(f"k{i}") for i, n in enumerate(names)]).first()
    return list(zip(names, text))
