"""Dictionary matching of attribute values.

A value occurs in a text if it stands there between token boundaries. Text and
values are marked at their gaps once (``token_marked``), so that the test is a
plain substring search; only density values, which match by any of their
numbers, keep a regular expression.

Two plans share that test:

* ``compile_dictionary`` / ``match_hits``: a schema whose size is bounded by the
  configuration is compiled into one array of entries per product. Each distinct
  goods row joins its product's array (Catalyst's size check decides about
  broadcasting) and the hits are selected inside the row.
* ``value_index`` / ``match_by_token``: a dictionary that grows with the data is
  an inverted index, each value under its rarest pair of adjacent tokens (its
  token, if it has one only). Descriptions are exploded to their distinct tokens
  and pairs and joined on (product, token), so a description meets only the
  values whose rarest pair it holds, and no task holds a product's values
  together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (DENSITY_UNIT, HEURISTIC_SEPARATORS, NEGATION_WINDOW_CHARS, NEGATION_WORDS, WHITESPACE,
                              bounded_pattern, collapse_ws, is_density_value, marked_value, match_text, strip_ws,
                              token_marked, tokens, unmarked_length, value_pattern)
from ..session import cut_lineage

MIN_VALUE_CHARS = 3
_WS = list(WHITESPACE)


def dictionary_values(schema: DataFrame, keys: Sequence[str], min_chars: int = MIN_VALUE_CHARS) -> DataFrame:
    """``keys + [attr, norm, value, attr_ord, probe, pattern]``: the values to
    match. Values shorter than ``min_chars`` after trimming are dropped; values
    equal after lower-casing and whitespace collapsing keep the first in list
    order. ``pattern`` is NULL but for density values."""
    v = (schema.withColumn("_vv", strip_ws("value"))
               .filter(F.length("_vv") >= min_chars)
               .withColumn("norm", F.lower(collapse_ws("value"))))
    first = (v.groupBy(*keys, "attr", "norm")
              .agg(F.min(F.struct("value_ord", "value", "attr_ord")).alias("f"))
              .select(*keys, "attr", "norm", "f.value", "f.attr_ord"))
    return first.select(*keys, "attr", "norm", "value", "attr_ord", marked_value("norm").alias("probe"),
                        F.when(is_density_value("norm"), bounded_pattern(value_pattern("norm"))).alias("pattern"))


def compile_dictionary(schema: DataFrame, keys: Sequence[str], min_chars: int = MIN_VALUE_CHARS) -> DataFrame:
    """Per product key: ``dict`` = array of
    ``struct(attr_ord, neg_len, value, attr, probe, pattern)`` sorted in the
    order the matcher tries values (attribute, longest first, then alphabetical).

    ``schema`` has ``keys + [attr, attr_ord, value, value_ord]``; see
    ``dictionary_values``."""
    entries = dictionary_values(schema, keys, min_chars).select(
        *keys, F.struct("attr_ord", (-F.length("value")).alias("neg_len"), "value", "attr", "probe", "pattern").alias("e"))
    compiled = entries.groupBy(*keys).agg(F.array_sort(F.collect_list("e")).alias("dict"))
    # Heuristic candidates keep every value (no length minimum, no dedupe);
    # ``attrs`` is the product's attribute list in schema order.
    extra = schema.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("attr_ord", (-F.length("value")).alias("neg_len"),
                                             "value", "attr"))).alias("hvals"),
        F.array_sort(F.collect_set(F.struct("attr_ord", "attr"))).alias("attrs"))
    return extra.join(compiled, list(keys), "left").withColumn(
        "dict", F.coalesce(F.col("dict"), F.array().cast(compiled.schema["dict"].dataType)))


def _negation_regex() -> str:
    """One anchored regex equal to: for some word w, the look-back ends with
    ' ' + w, equals w, or ends with w without its spaces."""
    import re
    alts = []
    for w in NEGATION_WORDS:
        if " " in w:
            alts.append("(?:^| )" + re.escape(w))
        alts.append(re.escape(w.replace(" ", "")))
    return "(?:" + "|".join(alts) + ")$"


_NEG_RE = _negation_regex()


def _negated(text: Column, start0: Column) -> Column:
    """Intended negation rule: the trimmed, de-punctuated look-back window of
    28 characters before the value ends with a negation word."""
    lo = F.greatest(start0 - NEGATION_WINDOW_CHARS, F.lit(0))
    lb = F.lower(F.substring(text, lo + 1, start0 - lo))
    lb = F.trim(F.regexp_replace(lb, r"[^a-z0-9]+", " "))
    return lb.rlike(_NEG_RE)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row. A named column is no
    such promise: Catalyst may put its expression back into a lambda, where it
    runs once per dictionary entry."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _occurs(x: Column, d: Column) -> Column:
    """Whether entry ``d`` stands in ``x`` = struct(text, marked)."""
    return F.when(d["pattern"].isNull(), F.instr(x["marked"], d["probe"]) > 0).otherwise(F.regexp(x["text"], d["pattern"]))


def _start(x: Column, d: Column) -> Column:
    """0-based start of the first occurrence (a pattern's match begins with the
    boundary character before it)."""
    before = F.substring(x["marked"], F.lit(1), F.instr(x["marked"], d["probe"]) - 1)
    return F.when(d["pattern"].isNull(), unmarked_length(before)).otherwise(F.regexp_instr(x["text"], d["pattern"]))


def match_form(x) -> Column:
    """struct(text, marked): a description as the matcher reads it."""
    t = match_text(x)
    return F.struct(t.alias("text"), token_marked(t).alias("marked"))


def match_hits(x: Column, dictionary: Column, negation_guard: bool = False) -> Column:
    """Array of dictionary entries whose value occurs in ``x`` (a ``match_form``)
    at a token boundary (optionally not in a negated context), in try order."""
    found = F.filter(dictionary, lambda d: _occurs(x, d))
    if not negation_guard:
        return found
    return F.filter(found, lambda d: ~_negated(x["text"], _start(x, d)))


def first_per_attr(hits: Column) -> Column:
    """Hits are sorted (attr, longest, alphabetical): keep the first per
    attribute. ``hits`` is bound already (``_let``)."""
    return F.filter(hits, lambda x, i: (i == 0) | (x["attr"] != F.element_at(hits, i)["attr"]))


def dictionary_match(goods: DataFrame, dictionaries: DataFrame, keys: Sequence[str],
                     text_col: str = "goods_shipped", negation_guard: bool = False) -> DataFrame:
    """One row per (goods row, attribute) that the dictionary resolves:
    ``goods columns + attr, value``."""
    joined = goods.join(dictionaries.select(*keys, "dict"), list(keys), "inner")
    return (joined.select(*goods.columns, F.explode(_picked(text_col, negation_guard)).alias("_h"))
                  .select(*goods.columns, F.col("_h.attr").alias("attr"), F.col("_h.value").alias("value")))


def _picked(text_col: str, negation_guard: bool) -> Column:
    """The first hit per attribute of the joined ``dict``."""
    return _let(match_form(text_col), lambda x: _let(match_hits(x, F.col("dict"), negation_guard), first_per_attr))


# --- J3 for dictionaries that grow with the data --------------------------------

_ANY, _DENSITY = "*", "#"  # index keys of values without a token, and of density values


def _pairs(found: Column) -> Column:
    """Adjacent tokens as one name each."""
    n = F.greatest(F.size(found) - 1, F.lit(0))
    return F.zip_with(F.slice(found, F.lit(1), n), F.slice(found, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def value_index(schema: DataFrame, keys: Sequence[str], min_chars: int = MIN_VALUE_CHARS) -> DataFrame:
    """``dictionary_values`` and ``token``: of the value's pairs of adjacent
    tokens (its token, if it has one only) the one that the fewest values of its
    product hold (ties: the longest, then the first).

    The tokens of a value that stands in a text are tokens of the text, in the
    same order without others between them, so any pair finds it. Values without
    a token stand under ``*``, density values under ``#``.

    Equal entries of the schema become one (their first place) before any text
    rule runs, and the distinct values are computed once for both sides of the
    count."""
    there = F.col("value_ord").isNull()  # sorts before all numbers, as in ``dictionary_values``
    entries = schema.groupBy(*keys, "attr", "attr_ord", "value").agg(F.max(there).alias("_n"), F.min("value_ord").alias("value_ord"))
    v = cut_lineage(dictionary_values(entries.withColumn("value_ord", F.when(~F.col("_n"), F.col("value_ord"))).drop("_n"), keys, min_chars))

    def own(found):
        return F.when(F.size(found) > 1, F.array_distinct(_pairs(found))).otherwise(found)
    names = F.when(F.col("pattern").isNotNull(), F.array(F.lit(_DENSITY))).otherwise(_let(tokens("norm"), own))
    v = v.withColumn("token", F.explode(F.when(F.size(names) == 0, F.array(F.lit(_ANY))).otherwise(names)))
    held = v.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct("n", (-F.length("token")).alias("neg_len"), "token")).alias("r")
    by_value = [*keys, "attr", "norm", "value", "attr_ord", "probe", "pattern"]
    return v.join(held, [*keys, "token"]).groupBy(*by_value).agg(rarest).select(*by_value, F.col("r.token").alias("token"))


def match_by_token(goods: DataFrame, index: DataFrame, keys: Sequence[str],
                   text_col: str = "goods_shipped", negation_guard: bool = False) -> DataFrame:
    """C1/C2 by an equi-join with a ``value_index``: one row per (goods row,
    attribute) resolved, ``goods columns + attr, value``; the same rows as
    ``dictionary_match``.

    ``goods`` rows are told apart by ``keys`` and text: equal ones get the same
    matches. They are written once and read back: each use would compute them
    again, and the text rules would run on the rows that they are made from. The
    token rows are narrow (a 128-bit key and the token); texts are shuffled once
    to meet their candidates. A hot token is split by AQE's skew join, and the
    pick of the longest value is an aggregation that starts before the shuffle."""
    goods = cut_lineage(goods)
    # an escaped separator keeps ("a", "bc") and ("ab", "c") apart
    part = [F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("||")), F.lit("|n")) for c in (*keys, text_col)]
    g = goods.withColumn("_id", F.unhex(F.md5(F.concat_ws("|.", *part))))
    texts = g.select("_id", *keys, text_col).distinct().select("_id", *keys, match_form(text_col).alias("_t"))
    named = _let(tokens(F.col("_t.text")), lambda found: F.array_distinct(F.concat(found, _pairs(found))))
    own = F.concat(named, F.array(F.lit(_ANY)),
                   F.when(F.col("_t.text").rlike(DENSITY_UNIT), F.array(F.lit(_DENSITY))).otherwise(F.array().cast("array<string>")))
    candidates = texts.select("_id", *keys, F.explode(own).alias("token")).join(index, [*keys, "token"]).select(
        "_id", F.struct("attr", (-F.length("value")).alias("neg_len"), "value", "probe", "pattern").alias("d"))
    x, d = F.col("_t"), F.col("d")
    hit = _occurs(x, d)
    if negation_guard:
        hit = hit & ~_negated(x["text"], _start(x, d))
    best = (texts.select("_id", "_t").join(candidates, "_id").filter(hit).groupBy("_id", F.col("d.attr").alias("attr"))
            .agg(F.min(F.struct("d.neg_len", "d.value")).alias("b")).select("_id", "attr", F.col("b.value").alias("value")))
    return g.join(best, "_id").select(*goods.columns, "attr", "value")


def match_summary(goods: DataFrame, dictionaries: DataFrame, keys: Sequence[str],
                  text_col: str = "goods_shipped", negation_guard: bool = False) -> DataFrame:
    """Per goods row: attributes tried, matched, and matches rejected by the
    negation guard before the accepted value (the matcher stops at the first
    accepted value of each attribute)."""
    def summed(raw):
        accepted = F.filter(raw, lambda h: ~h["neg"])
        blocked = F.filter(raw, lambda h, i: h["neg"] & ~F.exists(F.slice(raw, 1, i), lambda y: (y["attr"] == h["attr"]) & ~y["neg"]))
        return F.struct(F.size(F.array_distinct(F.transform(accepted, lambda h: h["attr"]))).alias("matched"), F.size(blocked).alias("blocked"))

    def read(x):
        return F.transform(match_hits(x, F.col("dict")), lambda d: F.struct(
            d["attr"].alias("attr"), (_negated(x["text"], _start(x, d)) if negation_guard else F.lit(False)).alias("neg")))
    j = goods.join(dictionaries, list(keys), "inner")
    j = j.select(*goods.columns, F.size("attrs").alias("attrs_tried"), _let(match_form(text_col), lambda x: _let(read(x), summed)).alias("_s"))
    return j.select(*goods.columns, "attrs_tried", F.col("_s.matched").alias("attrs_matched"), F.col("_s.blocked").alias("blocked"))


def match_coverage(summary: DataFrame) -> DataFrame:
    """Rows with any match, attribute match rate (6 dp), negation blocks."""
    return summary.agg(
        F.count_if(F.col("attrs_matched") > 0).alias("rows_with_any_match"),
        F.count(F.lit(1)).alias("rows_total"),
        F.sum("attrs_matched").cast("long").alias("attribute_matches"),
        F.sum("attrs_tried").cast("long").alias("attribute_attempted"),
        F.sum("blocked").cast("long").alias("negation_blocked"),
    ).withColumn("attribute_match_rate",
                 F.round(F.col("attribute_matches") / F.greatest(F.col("attribute_attempted"), F.lit(1)), 6))


# --- C3: heuristic fill -----------------------------------------------------

def heuristic_text(x) -> Column:
    """Lower-case and turn ``# , ; / \\ ( )`` into spaces."""
    c = F.col(x) if isinstance(x, str) else x
    return F.translate(F.lower(c), HEURISTIC_SEPARATORS, " " * len(HEURISTIC_SEPARATORS))


def heuristic_candidates(text: Column, values: Column) -> Column:
    """Values whose **first** occurrence in ``text`` has whitespace (or an end)
    on both sides; ``values`` is ``array<struct<neg_len, value>>`` sorted."""
    def ok(v):
        lv = F.lower(v["value"])
        pos = F.instr(text, lv)                      # 1-based, 0 = absent
        before = F.substring(text, pos - 1, 1)
        after = F.substring(text, pos + F.length(lv), 1)
        left_ok = (pos == 1) | before.isin(*_WS)
        right_ok = ((pos + F.length(lv)) > F.length(text)) | after.isin(*_WS)
        return (F.length(lv) > 0) & (pos > 0) & left_ok & right_ok
    return F.filter(values, ok)


def heuristic_pick(htext: Column, hvals: Column, attr: Column) -> Column:
    """C3 for one attribute on an already ``heuristic_text``-normalised text:
    the longest (then alphabetical) allowed value whose first occurrence is
    whitespace-delimited; NULL when none."""
    own = F.filter(hvals, lambda v: v["attr"] == attr)
    return F.try_element_at(heuristic_candidates(htext, own), F.lit(1))["value"]


def resolve_attributes(goods: DataFrame, dictionaries: DataFrame, keys: Sequence[str],
                       text_col: str = "goods_shipped", negation_guard: bool = False,
                       heuristic: bool = True, response: Column | None = None,
                       wide: Sequence[str] | None = None) -> DataFrame:
    """C5 without a shuffle: every (goods, attribute) of the product resolved
    as dictionary > ``response`` (a map<attr, value> column, optional) >
    heuristic > 'None', with a ``source`` column.  Long form output, or with
    ``wide`` one ``attr_<Name>`` column per listed attribute (K1 layout built
    in the row, no pivot shuffle)."""
    j = goods.join(dictionaries, list(keys), "inner")

    def resolve(a, picked, htext):
        det = F.try_element_at(F.filter(picked, lambda h: h["attr"] == a["attr"]), F.lit(1))["value"]
        resp = F.lit(None).cast("string") if response is None else F.try_element_at(response, a["attr"])
        resp = F.when(resp != "None", resp)
        heur = heuristic_pick(htext, F.col("hvals"), a["attr"]) if heuristic else F.lit(None).cast("string")
        # the first of the candidates that is there, evaluated once each
        found = F.filter(F.array(*[F.struct(a["attr"].alias("attr"), v.alias("value"), F.lit(n).alias("source")) for v, n in (
            (det, "dictionary"), (resp, "response"), (heur, "heuristic"), (F.lit("None"), "none"))]), lambda x: x["value"].isNotNull())
        return F.element_at(found, 1)
    every = _let(_picked(text_col, negation_guard), lambda picked: _let(heuristic_text(text_col), lambda htext: F.transform(
        "attrs", lambda a: resolve(a, picked, htext))))
    if wide is not None:
        def is_attr(name):
            return lambda x: x["attr"] == name

        def row(found):
            return F.struct(*[F.try_element_at(F.filter(found, is_attr(a)), F.lit(1))["value"].alias("attr_" + a) for a in wide])
        return j.select(*goods.columns, _let(every, row).alias("_w")).select(*goods.columns, "_w.*")
    out = j.select(*goods.columns, F.explode(every).alias("_r"))
    return out.select(*goods.columns, "_r.attr", "_r.value", "_r.source")


def resolve_maps(goods: DataFrame, dictionaries: DataFrame, keys: Sequence[str],
                 text_col: str = "goods_shipped") -> DataFrame:
    """One in-row pass per description giving ``attrs`` (the product's
    attributes), ``det`` (dictionary values), ``guard`` (dictionary values
    with the negation guard), ``heur`` (heuristic values for attributes the
    dictionary left open) as maps, and ``n_open``."""
    j = goods.join(dictionaries, list(keys), "inner")

    def as_map(hits):
        return F.map_from_entries(F.transform(hits, lambda h: F.struct(h["attr"], h["value"])))

    def maps(plain, guarded):
        held = F.transform(plain, lambda h: h["attr"])
        open_attrs = F.filter("attrs", lambda a: ~F.array_contains(held, a["attr"]))
        heur = _let(heuristic_text(text_col), lambda htext: F.map_from_entries(F.transform(open_attrs, lambda a: F.struct(
            a["attr"], heuristic_pick(htext, F.col("hvals"), a["attr"])))))
        return F.struct(F.transform("attrs", lambda a: a["attr"]).alias("attr_names"), as_map(plain).alias("det"), as_map(guarded).alias("guard"),
                        heur.alias("heur"), (F.size("attrs") - F.size(plain)).alias("n_open"))
    hits = lambda x, guard: _let(match_hits(x, F.col("dict"), guard), first_per_attr)
    both = _let(match_form(text_col), lambda x: _let(hits(x, False), lambda p: _let(hits(x, True), lambda g: maps(p, g))))
    return j.select(*goods.columns, both.alias("_m")).select(*goods.columns, "_m.*")
