"""Answers of the external labeller as input tables.

The labeller, the schema model and the fallback model are services outside
this library; the flows start at tables of their answers.  The tables here are
fixtures in every shape that the services send (fenced, short and long lists,
text that is no JSON, nested, typed and over-long values); ``label_with`` makes
such a table with a user's own model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import json_string

FAIL_TEXT = "Sorry, I cannot label these."
EXTRA_ITEM = '{"item_preview": "extra", "attributes": {}}'
PROPOSAL_NAMES = [("Color", 0, "color"), ("Size", 1, " size "), ("Temperature", 2, "temperature"), ("Age", 3, "AGE"),
                  ("Item", 4, "item-name"), ("Broken", 5, "broken pct")]


def product_labels(first: DataFrame) -> DataFrame:
    """(goods_shipped, category): a label per description, none where its
    length is a multiple of 3."""
    label = F.when(F.length("goods_shipped") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("first_cat"))
    return first.withColumn("category", label)


def _list_text(kind: Column, name: str, items: Column, fail: int, fence: int, short: int, long: int, extra: str, prose: str) -> Column:
    def body(xs: Column) -> Column:
        return F.concat(F.lit(f'{{"{name}": ['), F.array_join(xs, ", "), F.lit("]}"))
    return (F.when(kind == fail, F.lit(prose))
             .when(kind == fence, F.concat(F.lit("```json\n"), body(items), F.lit("\n```")))
             .when(kind == short, body(F.slice(items, 1, F.greatest(F.size(items) - 1, F.lit(0)))))
             .when(kind == long, body(F.concat(items, F.array(F.lit(extra))))).otherwise(body(items)))


def product_responses(batched: DataFrame) -> DataFrame:
    """(batch, text) for batches of (batch, pos_in_batch, truth)."""
    cats = (batched.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("pos_in_batch", "truth"))).alias("_c"))
                   .withColumn("_l", F.transform("_c", lambda x: F.concat(F.lit('"'), x["truth"], F.lit('"')))))
    kind = F.col("batch") % 7
    text = _list_text(kind, "classifications", F.col("_l"), 0, 1, 2, 3, '"EXTRA"', "no answer")
    return cats.select("batch", F.when(kind == 4, F.lit('{"classifications": "ECONOMY"}')).otherwise(text).alias("text"))


def _attribute_answer(batch: Column, pos: Column, attr: Column, base: Column) -> Column:
    kind = batch % 8
    q = F.concat(F.lit('"'), base, F.lit('"'))
    return (F.when((kind == 2) & (pos == 0) & (attr == "Item"), F.lit('"' + "x" * 61 + '"'))
             .when((kind == 5) & (attr == "Color"), F.concat(F.lit('{"value": '), q, F.lit("}")))
             .when((kind == 5) & (attr == "Item"), F.lit('{"custom": "Thing"}'))
             .when((kind == 6) & (attr == "Size"), F.lit("5"))
             .when((kind == 6) & (attr == "Age"), F.lit("true"))
             .when((kind == 6) & (attr == "Temperature"), F.lit("null"))
             .when((kind == 7) & (attr == "Size"), F.lit('{"value": 5}'))
             .when((kind == 7) & (attr == "Age"), F.lit('"true"'))
             .when((kind == 7) & (attr == "Item"), F.lit('{"value": "[x]"}'))
             .otherwise(q))


def attribute_responses(batched: DataFrame, schema_vals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, batch, text) for batches of (keys, batch, pos_in_batch,
    goods_shipped, guard); one JSON item per description."""
    def entry(a: Column) -> Column:
        pct = F.concat(F.regexp_extract("goods_shipped", r"\((\d+)% broken", 1), F.lit("%"))
        base = F.coalesce(F.try_element_at("guard", a["attr"]), F.when(a["attr"] == "Size", F.lit("Medium"))
                          .when(a["attr"] == "Broken", pct).otherwise(F.lit("None")))
        return F.concat(F.lit('"'), a["attr"], F.lit('": '), _attribute_answer(F.col("batch"), F.col("pos_in_batch"), a["attr"], base))
    item = F.concat(F.lit('{"item_preview": '), json_string("goods_shipped"), F.lit(', "attributes": {'),
                    F.array_join(F.transform("attrs", entry), ", "), F.lit("}}"))
    items = batched.join(schema_vals.select(*keys, "attrs"), keys).select(*keys, "batch", "pos_in_batch", item.alias("item"))
    lists = items.groupBy(*keys, "batch").agg(F.array_sort(F.collect_list(F.struct("pos_in_batch", "item"))).alias("_it"))
    text = _list_text(F.col("batch") % 8, "items", F.transform("_it", lambda x: x["item"]), 0, 1, 3, 4, EXTRA_ITEM, FAIL_TEXT)
    return lists.select(*keys, "batch", text.alias("text"))


def attribute_proposals(values: DataFrame, categories: DataFrame) -> DataFrame:
    """Attribute proposals per category (category, prop_ord, name, definition,
    val_ord, value) from the values (category, attr, value, val_ord) found
    there: name variants, lower-case values, a repeated name, an empty
    attribute, and two categories with few proposals."""
    names = F.create_map(*[x for a, o, n in PROPOSAL_NAMES for x in (F.lit(a), F.struct(F.lit(o).alias("o"), F.lit(n).alias("n")))])
    props = values.select("category", F.element_at(names, F.col("attr")).alias("_p"), "val_ord", F.lower("value").alias("value"),
                          F.concat(F.lit("Proposed "), F.col("attr")).alias("definition"))
    props = props.select("category", F.col("_p.o").alias("prop_ord"), F.col("_p.n").alias("name"), "definition", "val_ord", "value")
    props = props.filter(~F.col("category").isin("SMALL", "PROMO") | (F.col("prop_ord") == 0))
    zero, none = F.lit(0).cast("decimal(38,0)"), F.lit(None)
    extra = categories.select("category", F.explode(F.array(
        F.struct(F.lit(6).alias("prop_ord"), F.lit("Color").alias("name"), F.lit("Duplicate").alias("definition"),
                 zero.alias("val_ord"), F.lit("purple").alias("value")),
        F.struct(F.lit(7).alias("prop_ord"), F.lit("notes").alias("name"), F.lit("").alias("definition"),
                 none.cast("decimal(38,0)").alias("val_ord"), none.cast("string").alias("value")))).alias("_e")).select("category", "_e.*")
    return props.unionByName(extra)


def category_proposals(part: DataFrame) -> DataFrame:
    """Category proposals (round, pos, name, description, reps) over three
    refinement rounds from parts: round r sees parts with key % 3 = r; one
    name is spelled differently in round 2; descriptions grow in round 1;
    round r proposes 3 + r representatives (first names in order)."""
    p = part.withColumn("round", (F.col("p_partkey") % 3).cast("int")).withColumn(
        "name", F.when((F.col("round") == 2) & (F.col("p_type") == "PROMO"), F.lit("Promo")).otherwise(F.col("p_type")))
    desc = p.groupBy("round", "name", "p_type").agg(F.max("p_size").alias("_mx"))
    desc = desc.withColumn("description", F.concat(F.lit("Parts of type "), F.col("p_type"), F.lit(" up to size "),
                                                   F.col("_mx").cast("string"),
                                                   F.when(F.col("round") == 1, F.lit(" (refined)")).otherwise(F.lit(""))))
    names = p.select("round", "name", "p_name").distinct()
    w = Window.partitionBy("round", "name").orderBy("p_name")
    reps = (names.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= F.col("round") + 3)
                 .groupBy("round", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("_rk", "p_name"))),
                                                            lambda x: x["p_name"]).alias("reps")))
    wpos = Window.partitionBy("round").orderBy("name")   # a handful of rows per round
    out = desc.join(reps, ["round", "name"]).withColumn("pos", F.row_number().over(wpos) - 1)
    return out.select("round", "pos", "name", "description", "reps")


def chunk_definition(chunk: Column) -> Column:
    return F.concat(F.lit("Seen in chunk "), chunk.cast("string"))


def fallback_values(vectors: DataFrame, attrs: list[str]) -> DataFrame:
    """(q_id, attr, answer): the fallback labeller's attribute values."""
    return vectors.select(F.col("vec_id").alias("q_id"), F.explode(F.array(*[F.lit(a) for a in attrs])).alias("attr"),
                          F.concat(F.lit("v"), (F.col("vec_id") % 2).cast("string")).alias("answer"))


def fallback_labels(vectors: DataFrame) -> DataFrame:
    """(q_id, category): the fallback labeller's product labels."""
    return vectors.select(F.col("vec_id").alias("q_id"), F.when(F.col("vec_id") % 10 == 0, F.lit("Unclassified")).otherwise(
        F.concat(F.lit("cat_"), (F.col("vec_id") % 3).cast("string"))).alias("category"))


def round_proposals(prompts: DataFrame) -> DataFrame:
    """Answers to the prompts of a schema round (category, call, prop_ord, name,
    definition, val_ord, value), read from the prompt's text alone: the words
    of its descriptions, makers over 12 only, and how many attributes the
    prompt says are known."""
    lines = F.filter(F.split("prompt", "\n"), lambda x: x.rlike(r"^\d+\. "))
    known = F.size(F.regexp_extract_all("prompt", F.lit(r"(?m)^(- )"), 1))
    rows = prompts.select("category", "call", known.alias("known"), F.posexplode(lines).alias("val_ord", "line"))
    part = lambda i: F.get(F.split("line", " "), i)
    maker = F.regexp_extract("line", r"#(\d+)$", 1).cast("int")
    found = F.array(F.struct(F.lit(0).alias("prop_ord"), F.lit("finish type").alias("name"), part(1).alias("value")),
                    F.struct(F.lit(1).alias("prop_ord"), F.lit("item").alias("name"), part(2).alias("value")),
                    F.struct(F.lit(2).alias("prop_ord"), F.lit("maker").alias("name"), F.when(maker > 12, part(3)).alias("value")))
    rows = rows.select("category", "call", "known", "val_ord", F.explode(found).alias("x")).filter(F.col("x.value").isNotNull())
    return rows.select("category", "call", "x.prop_ord", "x.name", F.concat(F.lit("Seen with "), F.col("known").cast("string"), F.lit(" known")).alias("definition"),
                       "val_ord", "x.value")
