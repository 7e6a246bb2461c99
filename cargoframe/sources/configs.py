"""JSON configuration and classification documents (S5–S9, K2 JSON, K3).

Documents are read with ``spark.read.text`` (``wholetext`` for one document
per file, line mode for JSON lines) and parsed with ``from_json``: maps keep
their JSON key order, so positions come from ``posexplode``.  Dumps render
JSON text in Python's default layout so files stay byte-compatible with the
reference's.  A config document is bounded by the configuration (one per HS
code); classification output is written one line per description, so no
single record grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import json_string, json_text_array, json_text_object, strip_ws

_MAP = "map<string,string>"


def read_documents(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """``path, text`` — one row per file (``whole``) or per line."""
    r = spark.read.option("wholetext", whole).text(path)
    return r.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _entries(text: Column) -> Column:
    return F.map_entries(F.coalesce(F.from_json(text, _MAP), F.create_map().cast(_MAP)))


# --- S6 / K3: attribute schema ------------------------------------------------

def parse_attribute_schema(docs: DataFrame, text_col: str = "text", default_version: str = "") -> DataFrame:
    """``hs4, version, product, attr, attr_ord, value, value_ord``.
    Top-level entries that are not objects are metadata (skipped); products
    that are not objects are skipped; attributes whose values are not lists
    are dropped; values are stripped and blanks removed; products left with
    no attribute are dropped; an attribute whose list is empty keeps one row
    with a NULL value."""
    top = docs.select(F.posexplode(_entries(F.col(text_col))).alias("hs_ord", "e"))
    blocks = top.filter(strip_ws("e.value").startswith("{")).select(
        strip_ws("e.key").alias("hs4"), F.from_json("e.value", _MAP).alias("b"))
    ver = strip_ws(F.coalesce(F.try_element_at("b", F.lit("version")), F.lit("")))
    blocks = blocks.select("hs4", F.when(ver != "", ver).otherwise(F.lit(default_version)).alias("version"),
                           F.try_element_at("b", F.lit("products")).alias("products"))
    prods = blocks.select("hs4", "version", F.explode(_entries(F.col("products"))).alias("p")) \
        .filter(strip_ws("p.value").startswith("{")) \
        .select("hs4", "version", strip_ws("p.key").alias("product"),
                F.try_element_at(F.from_json("p.value", _MAP), F.lit("attributes")).alias("attrs"))
    attrs = prods.select("hs4", "version", "product", F.posexplode(_entries(F.col("attrs"))).alias("attr_ord", "a")) \
        .filter(strip_ws("a.value").startswith("[")) \
        .select("hs4", "version", "product", "attr_ord", strip_ws("a.key").alias("attr"),
                F.filter(F.transform(F.from_json("a.value", "array<string>"), strip_ws), lambda v: v != "").alias("vals"))
    # renumber attributes after dropping non-list ones
    from pyspark.sql import Window
    w = Window.partitionBy("hs4", "product").orderBy("attr_ord")
    attrs = attrs.withColumn("attr_ord", (F.row_number().over(w) - 1).cast("int"))
    return attrs.select("hs4", "version", "product", "attr", "attr_ord",
                        F.posexplode_outer("vals").alias("value_ord", "value"))


def dump_attribute_schema(long: DataFrame, version: Column | str = "1",
                          metadata: dict[str, str] | None = None) -> DataFrame:
    """K3: one JSON document per HS code: ``{hs4: {"version": v, "products":
    {product: {"attributes": {attr: [values]}}}}}`` plus top-level metadata
    keys that never override an HS key.  ``long``: ``hs4, product, attr,
    attr_ord, value, value_ord``."""
    per_attr = long.groupBy("hs4", "product", "attr", "attr_ord").agg(
        json_text_array(F.transform(F.array_sort(F.collect_list(F.struct("value_ord", "value"))),
                                    lambda x: x["value"])).alias("vals"))
    per_prod = per_attr.groupBy("hs4", "product").agg(
        json_text_object(F.transform(F.array_sort(F.collect_list(F.struct("attr_ord", "attr", "vals"))),
                                     lambda x: F.struct(x["attr"].alias("k"), x["vals"].alias("v")))).alias("attrs"))
    v = F.lit(version) if isinstance(version, str) else version
    per_hs = per_prod.groupBy("hs4").agg(json_text_object(F.array_sort(F.collect_list(F.struct(
        F.col("product").alias("k"), F.concat(F.lit('{"attributes": '), F.col("attrs"), F.lit("}")).alias("v"))))).alias("products"))
    block = F.concat(F.lit('{"version": '), json_string(v), F.lit(', "products": '), F.col("products"), F.lit("}"))
    # metadata keys never override an HS key
    meta = [F.when(F.col("hs4") != k, F.lit(", " + _json_py(k) + ": " + _json_py(val))).otherwise(F.lit(""))
            for k, val in (metadata or {}).items()]
    return per_hs.select("hs4", F.concat(F.lit("{"), json_string("hs4"), F.lit(": "), block, *meta, F.lit("}")).alias("text"))


def _json_py(s: str) -> str:
    import json
    return json.dumps(s, ensure_ascii=False)


# --- S5 / K3: product definition ---------------------------------------------

def dump_product_definition(cats: DataFrame, hs_code: str, metadata: dict[str, str] | None = None) -> DataFrame:
    """K3: product definition document from ``name, position, description``."""
    c = cats.agg(F.array_sort(F.collect_list(F.struct("position", "name", "description"))).alias("_c"))
    names = json_text_array(F.transform("_c", lambda x: x["name"]))
    descs = json_text_object(F.transform(F.filter("_c", lambda x: x["description"] != ""),
                                         lambda x: F.struct(x["name"].alias("k"), json_string(x["description"]).alias("v"))))
    meta_txt = "".join(", " + _json_py(k) + ": " + _json_py(v) for k, v in (metadata or {}).items())
    return c.select(F.concat(F.lit('{"hs_code": '), F.lit(_json_py(hs_code)), F.lit(', "product_categories": '), names,
                             F.lit(', "category_descriptions": '), descs, F.lit(meta_txt), F.lit("}")).alias("text"))


def parse_product_definition(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``hs_code, ord, category, description`` (+ ``metadata`` map of the
    other keys); blank category names are dropped, text is stripped."""
    m = F.from_json(F.col(text_col), _MAP)
    d = docs.select(strip_ws(F.coalesce(F.try_element_at(m, F.lit("hs_code")), F.lit(""))).alias("hs_code"),
                    F.from_json(F.try_element_at(m, F.lit("product_categories")), "array<string>").alias("_cats"),
                    F.from_json(F.try_element_at(m, F.lit("category_descriptions")), _MAP).alias("_desc"),
                    F.map_filter(m, lambda k, v: ~k.isin("hs_code", "product_categories", "category_descriptions")).alias("metadata"))
    cats = F.filter(F.transform(F.coalesce("_cats", F.array().cast("array<string>")), strip_ws), lambda x: x != "")
    desc = F.transform_keys(F.transform_values(F.coalesce("_desc", F.create_map().cast(_MAP)), lambda k, v: strip_ws(v)),
                            lambda k, v: strip_ws(k))
    return d.select("hs_code", "metadata", F.posexplode(cats).alias("ord", "category"), desc.alias("_d")) \
            .select("hs_code", "ord", "category", F.try_element_at("_d", F.col("category")).alias("description"), "metadata")


# --- S7: attribute definitions ------------------------------------------------

def parse_attribute_definitions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``attr_key, definition`` for keys starting with ``attr_``; every
    other key is metadata and skipped."""
    return (docs.select(F.explode(_entries(F.col(text_col))).alias("e"))
                .filter(F.col("e.key").startswith("attr_"))
                .select(F.col("e.key").alias("attr_key"), F.col("e.value").alias("definition")))


def dump_attribute_definitions(defs: DataFrame, metadata: dict[str, str] | None = None) -> DataFrame:
    """K3: definitions document from ``attr_key, definition`` (keys sorted),
    then the metadata keys."""
    meta = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(_json_py(v)).alias("v")) for k, v in (metadata or {}).items()])
    entries = F.transform(F.array_sort(F.collect_list(F.struct("attr_key", "definition"))),
                          lambda x: F.struct(x["attr_key"].alias("k"), json_string(x["definition"]).alias("v")))
    return defs.agg(json_text_object(F.concat(entries, meta.cast("array<struct<k:string,v:string>>"))).alias("text"))


# --- K2 JSON / S8 / S9: classification documents ------------------------------

def dump_classification_lines(long: DataFrame) -> DataFrame:
    """K2 (JSON lines): one ``{"<hs4>_<product>": {"<goods>": {attr: value}}}``
    line per description.  ``long``: ``hs4, product, goods_shipped, attr, attr_ord, value``."""
    per = long.groupBy("hs4", "product", "goods_shipped").agg(json_text_object(F.transform(
        F.array_sort(F.collect_list(F.struct("attr_ord", "attr", "value"))),
        lambda x: F.struct(x["attr"].alias("k"), json_string(x["value"]).alias("v")))).alias("_a"))
    key = F.concat(F.col("hs4"), F.lit("_"), F.col("product"))
    return per.select(F.concat(F.lit("{"), json_string(key), F.lit(": {"), json_string("goods_shipped"), F.lit(": "),
                               F.col("_a"), F.lit("}}")).alias("text"))


def parse_flat_classifications(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``{"hs4_product": {goods: {attr: value}}}`` -> ``hs_code, category,
    goods_shipped, attr, attr_ord, value``; keys without '_' are skipped; the
    key splits at the first '_'; non-object attribute sets are skipped."""
    top = docs.select(F.explode(_entries(F.col(text_col))).alias("e")).filter(F.instr("e.key", "_") > 0)
    g = top.select(F.substring_index("e.key", "_", 1).alias("hs_code"),
                   F.expr("substring(e.key, instr(e.key, '_') + 1)").alias("category"),
                   F.explode(_entries(F.col("e.value"))).alias("g"))
    g = g.filter(strip_ws("g.value").startswith("{"))
    return g.select("hs_code", "category", F.col("g.key").alias("goods_shipped"),
                    F.posexplode(_entries(F.col("g.value"))).alias("attr_ord", "a")) \
            .select("hs_code", "category", "goods_shipped", F.col("a.key").alias("attr"), "attr_ord",
                    F.col("a.value").alias("value"))


def parse_nested_classifications(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``{hs4: {product: [items] | {goods: attrs}}}``; list items carry
    ``goods_shipped`` and ``attributes``.  Output as ``parse_flat_classifications``."""
    top = docs.select(F.explode(_entries(F.col(text_col))).alias("h")).filter(strip_ws("h.value").startswith("{"))
    prods = top.select(strip_ws("h.key").alias("hs_code"), F.explode(_entries(F.col("h.value"))).alias("p"))
    as_list = (prods.filter(strip_ws("p.value").startswith("["))
                    .select("hs_code", F.col("p.key").alias("category"),
                            F.explode(F.from_json("p.value", "array<string>")).alias("it"))
                    .select("hs_code", "category", F.get_json_object("it", "$.goods_shipped").alias("goods_shipped"),
                            F.get_json_object("it", "$.attributes").alias("attrs")))
    as_map = (prods.filter(strip_ws("p.value").startswith("{"))
                   .select("hs_code", F.col("p.key").alias("category"), F.explode(_entries(F.col("p.value"))).alias("g"))
                   .select("hs_code", "category", F.col("g.key").alias("goods_shipped"), F.col("g.value").alias("attrs")))
    both = as_list.unionByName(as_map).filter(F.col("goods_shipped").isNotNull() & strip_ws("attrs").startswith("{"))
    return both.select("hs_code", "category", "goods_shipped", F.posexplode(_entries(F.col("attrs"))).alias("attr_ord", "a")) \
               .select("hs_code", "category", "goods_shipped", F.col("a.key").alias("attr"), "attr_ord",
                       F.col("a.value").alias("value"))
