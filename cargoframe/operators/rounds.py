"""Schema generation as rounds that feed each other.

All descriptions of a category are dealt to calls of at most ``per_call`` in a
seeded order, the calls in that order to rounds. A round's calls run side by
side for all categories; their prompts carry what the rounds before have
merged. After a round its answers are normalised (C12) and merged into the
state (A17), and the state is written, so that the next round's plan starts
there. The only loop is over rounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .labels import positions_by_range, sample_key
from .profile import normalise_proposals

PRIOR_PREVIEW = 8  # fixed value: prior values shown per attribute
PRIOR_HEAD = "KNOWN ATTRIBUTES"


def deal_calls(goods: DataFrame, key: str, text_col: str, per_call: int, rounds: int, seed: int = 42) -> DataFrame:
    """W2 + W1: ``key, text, pos, call, round`` of all distinct descriptions; a
    category with fewer calls than rounds skips rounds."""
    drawn = goods.select(key, text_col).distinct().withColumn("_key", sample_key(text_col, seed))
    p = positions_by_range(drawn, [key], ["_key", text_col])
    call = F.floor(F.col("pos") / per_call).cast("int")
    return p.select(key, text_col, "pos", call.alias("call"),
                    F.floor(call * rounds / F.ceil(F.col("group_size") / per_call)).cast("int").alias("round"))


def prior_lines(values: DataFrame, attrs: DataFrame, key: str) -> DataFrame:
    """``key, attr, line``: the first 8 merged values of every attribute,
    with a mark if there are more."""
    w = Window.partitionBy(key, "attr").orderBy("at")
    few = values.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= PRIOR_PREVIEW + 1)
    shown = few.groupBy(key, "attr").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "value"))), lambda x: x["value"]).alias("v"))
    line = F.concat(F.lit("- "), F.col("attr"), F.lit(": "), F.array_join(F.slice("v", 1, PRIOR_PREVIEW), ", "),
                    F.when(F.size("v") > PRIOR_PREVIEW, F.lit(" ...")).otherwise(F.lit("")))
    return shown.join(attrs.select(key, "attr", "attr_at"), [key, "attr"]).select(key, "attr", "attr_at", line.alias("line"))


def render_prompts(calls: DataFrame, lines: DataFrame, key: str, text_col: str, round_: int) -> DataFrame:
    """``key, call, round, n_goods, prompt``: one row per call, its numbered
    descriptions and what is known so far (at most ``per_call`` lines each)."""
    numbered = F.transform(F.array_sort(F.collect_list(F.struct("pos", text_col))), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x[text_col]))
    body = calls.filter(F.col("round") == round_).groupBy(key, "call").agg(F.count(F.lit(1)).alias("n_goods"), F.array_join(numbered, "\n").alias("body"))
    known = lines.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("attr_at", "attr", "line"))), lambda x: x["line"]), "\n").alias("known"))
    prompt = F.concat(F.lit("CATEGORY: "), F.col(key), F.lit("\nGOODS:\n"), F.col("body"),
                      F.coalesce(F.concat(F.lit(f"\n{PRIOR_HEAD}:\n"), F.col("known")), F.lit("")))
    return body.join(known, key, "left").select(key, "call", F.lit(round_).alias("round"), "n_goods", prompt.alias("prompt"))


def attribute_rounds(goods: DataFrame, answer: Callable[[DataFrame], DataFrame], rounds: int, per_call: int, key: str = "category",
                     text_col: str = "goods_shipped", seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C14: (attributes, values, prompts) after all rounds.

    ``answer`` turns a round's prompts into proposals ``key, call, prop_ord, name,
    definition, val_ord, value`` (a model, or a table of its answers).
    ``attributes``: ``key, attr, attr_at, definition`` (the last call's that gives
    one); ``values``: ``key, attr, value, at``; ``prompts``: all that were sent,
    which is what A24 counts."""
    calls = cut_lineage(deal_calls(goods, key, text_col, per_call, rounds, seed))
    values = attrs = sent = None
    for r in range(rounds):
        lines = None if values is None else prior_lines(values, attrs, key)
        if lines is None:
            lines = calls.select(key, F.lit("").alias("attr"), F.struct(F.lit(0).alias("call"), F.lit(0).alias("prop_ord")).alias("attr_at"), F.lit("").alias("line")).limit(0)
        prompts = cut_lineage(render_prompts(calls, lines, key, text_col, r))
        proposals = answer(prompts).withColumn("_call", F.struct(key, "call"))
        got = normalise_proposals(proposals, "_call").filter(F.size("values") > 0).select(
            F.col(f"_call.{key}").alias(key), F.col("_call.call").alias("call"), "prop_ord", "attr", F.nullif("definition", F.lit("")).alias("definition"), "values")
        got = cut_lineage(got)
        v = got.select(key, "attr", "call", F.posexplode("values").alias("pos", "value")).select(key, "attr", "value", F.struct("call", "pos").alias("at"))
        a = got.select(key, "attr", F.struct("call", "prop_ord").alias("attr_at"), "definition", F.when(F.col("definition").isNotNull(), F.col("call")).alias("def_call"))
        if values is not None:
            v, a = values.unionByName(v), attrs.unionByName(a)
        values = cut_lineage(v.groupBy(key, "attr", "value").agg(F.min("at").alias("at")))
        attrs = cut_lineage(a.groupBy(key, "attr").agg(F.min("attr_at").alias("attr_at"), F.max_by("definition", "def_call").alias("definition"),
                                                       F.max("def_call").alias("def_call")))
        sent = prompts if sent is None else sent.unionByName(prompts)
    return attrs.drop("def_call"), values, sent
