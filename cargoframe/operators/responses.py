"""Labeller responses: parse, validate and merge.

A labeller (the reference calls a hosted model) is a seam: its output enters
as a table ``responses(batch keys…, text)`` — produced upstream by any job,
or by ``label_with`` (a user function through ``mapInPandas``).  Everything
after that is Column/SQL work:

* ``from_json`` on the text between the first '{' and the last '}';
* ``posexplode`` of the items, joined to the batch inputs by position
  (a left join pads missing items, extra items find no partner);
* per-attribute unwrap / coercion / flags as Column expressions;
* the "a value over 60 characters rejects the whole batch" rule as a window
  max over the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import MAX_VALUE_CHARS, json_object_slice, unwrap_is_custom, unwrap_value

UNCLASSIFIED = "Unclassified"


# --- product labels (C6) ----------------------------------------------------

def parse_product_response(text: Column) -> Column:
    """``classifications`` array of the first {...} in the text; NULL when the
    text is not JSON or the field is not a list."""
    parsed = F.from_json(json_object_slice(text), "classifications array<string>")
    return parsed["classifications"]


def validate_product_labels(items: DataFrame, responses: DataFrame, batch_keys: Sequence[str],
                            pos_col: str = "pos_in_batch", allowed: Sequence[str] | None = None) -> DataFrame:
    """C6 + J11: label of item ``pos`` = element ``pos`` of the response list;
    missing (short list, bad JSON, not a list) -> 'Unclassified'; extras are
    ignored.  ``allowed`` optionally re-checks the category list."""
    r = responses.select(*batch_keys, parse_product_response(F.col("text")).alias("_labels"))
    j = items.join(r, list(batch_keys), "left")
    lab = F.try_element_at(F.col("_labels"), (F.col(pos_col) + 1).cast("int"))
    lab = F.when(lab.isNotNull() & (F.trim(lab) != ""), lab)
    if allowed is not None:
        lab = F.when(lab.isin(list(allowed)), lab)
    return j.withColumn("category", F.coalesce(lab, F.lit(UNCLASSIFIED))).drop("_labels")


# --- attribute labels (C4) --------------------------------------------------

def parse_items(responses: DataFrame, batch_keys: Sequence[str]) -> DataFrame:
    """One row per response item: ``batch keys…, pos, item`` (item JSON text;
    NULL item rows are dropped).  ``has_items`` is False when the response
    carried no item list at all."""
    parsed = F.from_json(json_object_slice(F.col("text")), "items array<string>")["items"]
    r = responses.select(*batch_keys, parsed.alias("_items"))
    return r.select(*batch_keys, F.posexplode_outer("_items").alias("pos", "item"))


def validate_attribute_responses(goods: DataFrame, responses: DataFrame, schema_vals: DataFrame,
                                 batch_keys: Sequence[str], product_keys: Sequence[str],
                                 pos_col: str = "pos_in_batch", allow_out_of_schema: bool = False) -> DataFrame:
    """C4 per (goods, attribute): ``resp`` = validated response value or NULL
    when the item is missing/invalid JSON/failed batch, with flags
    ``invalid``, ``out_of_schema``, ``batch_failed``, ``has_item``.

    ``goods``: batch keys + ``pos_col`` + goods columns.  ``schema_vals``:
    product keys + ``attrs`` (array<struct<attr_ord, attr>>) + ``allowed``
    (map<attr, array<value>>)."""
    items = parse_items(responses, batch_keys)
    dict_items = items.filter(F.col("item").startswith("{"))
    g = goods.join(dict_items.withColumnRenamed("pos", pos_col), [*batch_keys, pos_col], "left")
    g = g.join(schema_vals, list(product_keys), "inner")
    attrs_map = F.from_json(F.get_json_object("item", "$.attributes"), "map<string,variant>")
    g = g.withColumn("_am", attrs_map).withColumn("_a", F.explode("attrs")).withColumn("attr", F.col("_a.attr"))
    present = F.col("item").isNotNull()
    raw = F.try_element_at("_am", F.col("attr"))
    # a missing key and a JSON null both mean 'None'
    val = F.when(present, unwrap_value(raw))
    custom = present & unwrap_is_custom(raw)
    allowed = F.try_element_at("allowed", F.col("attr"))
    in_schema = F.coalesce(F.array_contains(allowed, val), F.lit(False)) | (val == "None")
    too_long = present & (F.length(val) > MAX_VALUE_CHARS)
    g = (g.withColumn("_val", val).withColumn("custom", custom).withColumn("_in", in_schema)
          .withColumn("too_long", too_long))
    w = Window.partitionBy(*batch_keys)
    g = g.withColumn("batch_failed", F.max(F.col("too_long").cast("int")).over(w) == 1)
    invalid = present & ~F.col("custom") & ~F.col("_in") & ~F.col("batch_failed")
    oos = present & ~F.col("_in") & ~F.col("batch_failed") & (F.col("custom") | F.lit(allow_out_of_schema))
    resp = (F.when(~present | F.col("batch_failed"), F.lit(None).cast("string"))
             .when(invalid & F.lit(not allow_out_of_schema), F.lit("None"))
             .otherwise(F.col("_val")))
    return (g.withColumn("invalid", invalid & F.lit(not allow_out_of_schema))
             .withColumn("out_of_schema", oos)
             .withColumn("resp", resp).withColumn("has_item", present)
             .drop("_am", "_a", "_val", "_in", "too_long", "item"))


def precedence(det: Column, resp: Column, heur: Column) -> tuple[Column, Column]:
    """Dictionary > validated response > heuristic > 'None' (value, source)."""
    r = F.when(resp != "None", resp)
    value = F.coalesce(det, r, heur, F.lit("None"))
    source = (F.when(det.isNotNull(), "dictionary").when(r.isNotNull(), "response")
              .when(heur.isNotNull(), "heuristic").otherwise("none"))
    return value, source


def validation_stats(validated: DataFrame, product_keys: Sequence[str], batch_keys: Sequence[str],
                     allow_out_of_schema: bool = False) -> DataFrame:
    """A19 per product: batches, failed batches, assignments checked, coerced
    (invalid), out-of-schema kept, heuristic fills. A batch that answered
    without any item counts with all its assignments; out-of-schema values
    are reported only where they are allowed."""
    answered = F.max(F.col("has_item").cast("int")).over(Window.partitionBy(*product_keys, *batch_keys)) == 1
    v = validated.withColumn("_answered", answered)
    counted = F.col("batch").isNotNull() & ~F.col("batch_failed") & (F.col("has_item") | ~F.col("_answered"))
    return v.groupBy(*product_keys).agg(
        F.countDistinct(*batch_keys).alias("batches"),
        F.countDistinct(F.when(F.col("batch_failed"), F.struct(*batch_keys))).alias("failed_batches"),
        F.count_if(counted).alias("total"),
        F.count_if("invalid").alias("invalid"),
        (F.count_if("out_of_schema") if allow_out_of_schema else F.count_if(F.lit(False))).alias("out_of_schema"),
        F.count_if(F.col("source") == "heuristic").alias("heuristic_fills"))


def label_with(batches: DataFrame, fn: Callable, batch_keys: Sequence[str], prompt_col: str = "prompt") -> DataFrame:
    """Call a user labelling function on batches of prompts inside the
    executors (Arrow batches through ``mapInPandas``); ``fn(list[str]) ->
    list[str]`` returns one response text per prompt."""
    import pandas as pd

    cols = list(batch_keys)

    def run(it):
        for pdf in it:
            texts = fn(pdf[prompt_col].tolist()) if len(pdf) else []
            out = pdf[cols].copy()
            out["text"] = pd.Series(texts, index=pdf.index, dtype="object")
            yield out
    schema = batches.select(*cols).schema.add("text", "string")
    return batches.select(*cols, prompt_col).mapInPandas(run, schema)
