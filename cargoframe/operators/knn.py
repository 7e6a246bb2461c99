"""Nearest-neighbour label transfer and the knowledge base (J2, J4, J5, W4,
F17, C7–C11, P10, P11, K10, K11, A3, A20–A22).

Exact top-k by cosine within a namespace, with clusters that are pruned:

* vectors are brought to unit length once, so cosine = dot product and the
  distance of two vectors is ``sqrt(2 - 2 cosine)``;
* a namespace of more than ``cluster_size`` KB vectors is cut into clusters
  around some of its own vectors; a cluster is known by the smallest and the
  largest distance of its vectors to its centre;
* a first pass searches each query's own cluster, which gives its k-th best
  so far;
* by the triangle inequality no vector of a cluster is nearer to a query than
  the gap between the query's distance to the centre and those two bounds. A
  second pass takes a query only to the clusters that this leaves open, before
  any vector is shuffled for it. Nothing is approximate: what is dropped can't
  be among the k best;
* a cluster of any size is dealt by a hash to blocks, its queries to chunks, and
  every (block, chunk) is one bounded matrix product that returns its top-k per
  query; a per-query ``row_number() <= k`` merges them (Spark inserts a per-task
  group limit before that shuffle).

A vector is usable if it is there, not empty, holds finite numbers only and isn't
zero; others take no part (``usable_vector``; C8 reports them as ``vector_error``).
Queries meet KB vectors of the same length only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_vector, short_id
from ..session import cut_lineage

UNCLASSIFIED = "Unclassified"
MAX_CENTRES = 256  # of a namespace; larger clusters have more blocks
CHUNK = 2048       # queries of one step


def usable_vector(vec: str) -> Column:
    """Whether a vector can be compared: finite components, not all zero."""
    c = F.col(vec)
    ok = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(c, lambda x: x != 0)
    return F.coalesce(c.isNotNull() & ok, F.lit(False))


def _units(df: DataFrame, ns_cols: Sequence[str], id_col: str, vec_col: str) -> DataFrame:
    """``ns…, dim, id, v``: usable vectors at unit length; rows without a
    namespace or id meet nothing."""
    known = F.col(id_col).isNotNull() & usable_vector(vec_col)
    for c in ns_cols:
        known = known & F.col(c).isNotNull()
    return df.filter(known).select(*ns_cols, F.size(vec_col).alias("dim"), F.col(id_col).cast("long").alias("id"),
                                   normalize_vector(vec_col).alias("v"))


def _matrix(t: pa.Table, dim: int) -> np.ndarray:
    v = t.column("v").combine_chunks()
    return np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(t.num_rows, dim)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (a @ b.T)))


def _step_key(left: pa.Table, right: pa.Table, names: Sequence[str]) -> list[pa.Array]:
    """The key columns of a step, as many rows as asked for later."""
    t = left if left.num_rows else right
    return [t.column(c).combine_chunks().slice(0, 1) for c in names]


def _repeat(one: pa.Array, n: int) -> pa.Array:
    return one.take(pa.array(np.zeros(n, np.int64)))


def _assign(keys: Sequence[str], whole: bool):
    """Step: the nearest centre of every vector of a block and its distance;
    ``whole`` adds the distances to all centres, in their order."""

    def run(key: tuple, x: pa.Table, centres: pa.Table) -> pa.Table:
        dim, n = key[len(keys) - 1].as_py(), x.num_rows if centres.num_rows else 0
        cols, x = [x.column(c).combine_chunks().slice(0, n) for c in (*keys, "id", "v")], x.slice(0, n)
        if n:
            order = np.argsort(centres.column("centre").to_numpy(), kind="stable")
            d = _distance(_matrix(x, dim), _matrix(centres, dim)[order])
        else:
            d = np.zeros((0, 1))
        home = d.argmin(1) if n else np.zeros(0, np.int64)
        cols += [pa.array(home.astype(np.int32)), pa.array(d[np.arange(n), home])]
        names = [*keys, "id", "v", "cluster", "dist"]
        if whole:
            cols, names = [*cols, pa.array(list(d), pa.list_(pa.float64()))], [*names, "dists"]
        return pa.table(cols, names=names)

    return run


def _best_of_block(keys: Sequence[str], k: int):
    """Step: the top-k of a KB block for each query of a chunk. One matrix
    product sorts out; what can be among the best is scored row by row, so that
    equal vectors score equal wherever they lie."""

    def run(key: tuple, x: pa.Table, q: pa.Table) -> pa.Table:
        dim = key[len(keys) - 1].as_py()
        one = _step_key(x, q, keys)
        out = [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        if x.num_rows and q.num_rows:
            xm, qm, ids = _matrix(x, dim), _matrix(q, dim), x.column("id").to_numpy()
            s = qm @ xm.T
            if s.shape[1] > k:
                least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            else:
                least = np.full(len(s), -np.inf)
            row, col = np.nonzero(s >= (np.maximum(least, q.column("floor").to_numpy()) - 1e-12)[:, None])
            s = (qm[row] * xm[col]).sum(1)
            order = np.lexsort((ids[col], -s, row))
            row, col, s = row[order], col[order], s[order]
            top = np.arange(len(row)) - np.searchsorted(row, row) < k
            out = [q.column("id").to_numpy()[row[top]], ids[col[top]], s[top]]
        return pa.table([*(_repeat(c, len(out[0])) for c in one), *map(pa.array, out)], names=[*keys, "q_id", "k_id", "score"])

    return run


def _ddl(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema)


def _apart(df: DataFrame, *names: str) -> DataFrame:
    """The columns under identities of their own: both sides of a cogroup may
    come from one table."""
    return df.select(*(F.col(c).alias(c) for c in names))


def _search(kb: DataFrame, asked: DataFrame, keys: Sequence[str], k: int, block_size: int) -> DataFrame:
    """Top-k of each asked (query, cluster): ``keys, q_id, k_id, score``.
    ``kb``: keys, cluster, id, v; ``asked``: the same and floor."""
    where = [*keys, "cluster"]
    blocks = kb.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias("_blocks"))
    chunks = asked.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("_chunks"))
    plan = blocks.join(chunks, where)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = kb.join(plan, where).withColumn("_block", own("_blocks")).withColumn("_chunk", every("_chunks"))
    right = asked.join(plan, where).withColumn("_chunk", own("_chunks")).withColumn("_block", every("_blocks"))
    step = [*keys, "cluster", "_block", "_chunk"]
    left, right = left.select(*step, "id", "v"), _apart(right, *step, "id", "v", "floor")
    run = _best_of_block(keys, k)
    by_keys = lambda key, x, q: run(key[:len(keys)], x, q)
    return left.groupBy(*step).cogroup(right.groupBy(*step)).applyInArrow(by_keys, f"{_ddl(kb, keys)}, q_id long, k_id long, score double")


def _top(found: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys, "q_id").orderBy(F.col("score").desc(), F.col("k_id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _clustered(b: DataFrame, q: DataFrame, keys: Sequence[str], block_size: int, cluster_size: int) -> tuple[DataFrame, DataFrame]:
    """KB vectors with their cluster and distance, and queries with theirs and
    the distances to all centres of their namespace (both written once)."""
    size = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # centres: the first vectors in the order of a hash; the group limit of row_number cuts every task's rows first
    w = Window.partitionBy(*keys).orderBy(F.xxhash64("id", F.lit("centre")), "id", "v")
    centres = b.withColumn("centre", F.row_number().over(w)).filter(F.col("centre") <= MAX_CENTRES).join(size, list(keys))
    centres = centres.filter(F.col("centre") <= F.ceil(F.col("_n") / cluster_size)).select(*keys, "centre", "v")

    def placed(rows: DataFrame, whole: bool) -> DataFrame:
        n = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias("_blocks"))
        left = rows.join(n, list(keys)).withColumn("_block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")).select(*keys, "_block", "id", "v")
        right = centres.join(n, list(keys)).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        right = _apart(right, *keys, "_block", "centre", "v")
        out = f"{_ddl(rows, [*keys, 'id', 'v'])}, cluster int, dist double" + (", dists array<double>" if whole else "")
        run = _assign(keys, whole)
        step = lambda key, x, c: run(key[:len(keys)], x, c)
        return cut_lineage(left.groupBy(*keys, "_block").cogroup(right.groupBy(*keys, "_block")).applyInArrow(step, out))

    return placed(b, False), placed(q, True)


def _passes(queries: DataFrame, kb: DataFrame, ns_cols: Sequence[str], q_id: str, k_id: str, vec_col: str, k: int,
            block_size: int, cluster_size: int) -> tuple[DataFrame, list[DataFrame], list[str], DataFrame]:
    """Found rows, the (query, cluster) rows of each pass, the key columns, and
    the clusters' KB rows."""
    b, q = _units(kb, ns_cols, k_id, vec_col), _units(queries, ns_cols, q_id, vec_col)
    keys, nothing = [*ns_cols, "dim"], F.lit(float("-inf")).alias("floor")
    most = b.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if most <= cluster_size:  # every namespace is one cluster: there is nothing to prune
        b, q = (x.withColumn("cluster", F.lit(0)) for x in (b, q))
        asked = q.select(*keys, "cluster", "id", "v", nothing)
        return _search(b, asked, keys, k, block_size), [asked], keys, b
    b, q = _clustered(b, q, keys, block_size, cluster_size)
    first = q.select(*keys, "cluster", "id", "v", nothing)
    found = cut_lineage(_search(b, first, keys, k, block_size))
    floor = _top(found, keys, k).filter(F.col("rank") == k).select(*keys, F.col("q_id").alias("id"), F.col("score").alias("floor"))
    rings = b.groupBy(*keys, "cluster").agg(F.min("dist").alias("low"), F.max("dist").alias("high"))
    rings = rings.groupBy(*keys).agg(F.collect_list(F.struct("cluster", "low", "high")).alias("rings"))  # MAX_CENTRES at most
    open_ = q.join(floor, [*keys, "id"], "left").join(rings, keys)
    # no vector of the ring is nearer than the gap between the query's distance to its centre and the ring
    reach = F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("floor"))), F.lit(3.0)) + 1e-7
    at = lambda r: F.element_at("dists", r["cluster"] + 1)
    left_open = F.filter("rings", lambda r: (r["cluster"] != F.col("cluster")) & (at(r) - r["high"] <= reach) & (r["low"] - at(r) <= reach))
    second = open_.select(*keys, F.explode(F.transform(left_open, lambda r: r["cluster"])).alias("cluster"), "id", "v",
                          F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    second = cut_lineage(second)
    return found.unionByName(_search(b, second, keys, k, block_size)), [first, second], keys, b


def knn(queries: DataFrame, kb: DataFrame, ns_cols: Sequence[str], q_id: str, k_id: str,
        vec_col: str = "embedding", k: int = 10, block_size: int = 1024, cluster_size: int = 4096) -> DataFrame:
    """Exact top-k KB neighbours by cosine per (namespace, query):
    ``ns_cols…, q_id, k_id, score, rank`` (rank 1 = best; ties by KB id).

    Query ids are unique within a namespace; a query that stands in two
    namespaces gets a list in each. A step holds about
    ``(block_size + CHUNK) * dim * 8`` bytes."""
    found, _, keys, _ = _passes(queries, kb, ns_cols, q_id, k_id, vec_col, k, block_size, cluster_size)
    return _top(found, keys, k).select("q_id", "k_id", "score", "rank", *ns_cols)


def knn_work(queries: DataFrame, kb: DataFrame, ns_cols: Sequence[str], q_id: str, k_id: str,
             vec_col: str = "embedding", k: int = 10, block_size: int = 1024, cluster_size: int = 4096) -> DataFrame:
    """What pruning saves, per namespace: ``ns_cols…, pairs_all`` ((query, KB
    vector) pairs), ``pairs_kept`` (those that a search scores) and ``share_kept``."""
    _, passes, keys, b = _passes(queries, kb, ns_cols, q_id, k_id, vec_col, k, block_size, cluster_size)
    size = b.groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("n"))
    asked = None
    for i, p in enumerate(passes):
        n = p.groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("asked")).withColumn("first", F.lit(i == 0))
        asked = n if asked is None else asked.unionByName(n)
    kept = asked.join(size, [*keys, "cluster"]).groupBy(*ns_cols).agg(F.sum(F.col("asked") * F.col("n")).alias("pairs_kept"))
    n_q = asked.filter("first").groupBy(*keys).agg(F.sum("asked").alias("q"))
    total = size.groupBy(*keys).agg(F.sum("n").alias("x")).join(n_q, keys).groupBy(*ns_cols).agg(F.sum(F.col("x") * F.col("q")).alias("pairs_all"))
    return total.join(kept, list(ns_cols)).withColumn("share_kept", F.col("pairs_kept") / F.col("pairs_all"))


def pearson(a, b) -> Column:
    """Rerank scorer: correlation of two vectors (cosine of mean-centred
    vectors), in double precision."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    n = F.size(a).cast("double")
    sa = F.aggregate(a, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double"))
    sb = F.aggregate(b, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double"))
    sab = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                      F.lit(0.0).cast("double"), lambda s, x: s + x)
    saa = F.aggregate(a, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    sbb = F.aggregate(b, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    return (n * sab - sa * sb) / F.sqrt((n * saa - sa * sa) * (n * sbb - sb * sb))


def rerank(cands: DataFrame, queries: DataFrame, kb: DataFrame, q_id: str, k_id: str,
           vec_col: str = "embedding", top_n: int = 5, scorer=pearson) -> DataFrame:
    """Rescore the top-k candidates with a second scorer and keep top_n
    (``rerank_score``, ``rerank``).  Only k rows per query are rescored."""
    qv = queries.select(F.col(q_id).cast("long").alias("q_id"), F.col(vec_col).alias("_qv"))
    kv = kb.select(F.col(k_id).cast("long").alias("k_id"), F.col(vec_col).alias("_kv"))
    j = cands.join(qv, "q_id").join(kv, "k_id").withColumn("rerank_score", scorer("_qv", "_kv"))
    w = Window.partitionBy("q_id").orderBy(F.col("rerank_score").desc(), F.col("k_id"))
    return j.withColumn("rerank", F.row_number().over(w)).filter(F.col("rerank") <= top_n).drop("_qv", "_kv")


def rerank_with_model(cands: DataFrame, queries: DataFrame, kb: DataFrame, q_id: str, k_id: str, text_col: str,
                      model, top_n: int = 5, batch: int = 64) -> DataFrame:
    """J5 + U2: the candidates of a query (``q_id, k_id, score, rank``) scored
    together by a user's model, ``model(list[(query text, KB text)]) ->
    list[float]``, in the executors: ``q_id, k_id, score, rank, rerank_score,
    rerank``, the best ``top_n``.

    A call gets all candidates of ``batch`` queries at most. If it raises, or
    returns anything but one finite number per pair, its queries keep the order
    of the first stage and their ``rerank_score`` is NULL; so do pairs without a
    text. Ties go to the better first rank."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<double>")
    def _score(query: pd.Series, docs: pd.Series) -> pd.Series:
        out: list = []
        for at in range(0, len(query), batch):
            rows = list(zip(query[at:at + batch], docs[at:at + batch]))
            pairs = [(q, t) for q, own in rows for t in own if q is not None and t is not None]
            try:
                got = [float(x) for x in model(pairs)] if pairs else []
                fine = len(got) == len(pairs) and bool(np.isfinite(got).all())
            except Exception:  # whatever a user's model raises: the first stage's order stands
                fine = False
            it = iter(got if fine else ())
            out += [[next(it) if fine and q is not None and t is not None else None for t in own] for q, own in rows]
        return pd.Series(out)

    qv = queries.select(F.col(q_id).cast("long").alias("q_id"), F.col(text_col).alias("_q"))
    kv = kb.select(F.col(k_id).cast("long").alias("k_id"), F.col(text_col).alias("_k"))
    own = cands.select("q_id", "k_id", "score", "rank").join(kv, "k_id", "left")
    own = own.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("rank", "k_id", "score", "_k"))).alias("_own")).join(qv, "q_id", "left")
    own = own.select("q_id", "_own", _score("_q", F.transform("_own", lambda x: x["_k"])).alias("_s"))
    rows = own.select("q_id", F.explode(F.arrays_zip("_own", "_s")).alias("x")).select(
        "q_id", "x._own.k_id", "x._own.score", "x._own.rank", F.col("x._s").alias("rerank_score"))
    w = Window.partitionBy("q_id").orderBy(F.desc_nulls_last("rerank_score"), "rank")
    return rows.withColumn("rerank", F.row_number().over(w)).filter(F.col("rerank") <= top_n)


def label_transfer(best: DataFrame, kb_labels: DataFrame, k_id: str, label_col: str, score_col: str,
                   threshold: float, default: str = UNCLASSIFIED) -> DataFrame:
    """Best neighbour's label when its score reaches the threshold
    (``vector_match``), else the default label, 0.0 and ``no_match``."""
    j = best.join(kb_labels.select(F.col(k_id).cast("long").alias("k_id"), F.col(label_col).alias("_lab")), "k_id", "left")
    ok = F.col(score_col) >= F.lit(threshold)
    return j.select("q_id", F.when(ok, F.col("_lab")).otherwise(F.lit(default)).alias("category"),
                    F.when(ok, F.col(score_col)).otherwise(F.lit(0.0)).alias("score"),
                    F.when(ok, F.lit("vector_match")).otherwise(F.lit("no_match")).alias("method"))


def attribute_transfer(best: DataFrame, allowed: DataFrame, thresholds: DataFrame | None,
                       default_threshold: float) -> DataFrame:
    """C8 + P10 + P11 per (query, attribute): ``best`` holds the top hit
    (``score``, ``hit_value``; NULL when the namespace had no KB rows; a NULL
    ``attr`` marks a category without a schema: one row, ``no_schema``; a false
    ``usable`` a query whose vector can't be compared: ``vector_error``).
    ``allowed(ns…, attr, value)`` is the schema; ``thresholds(attr, threshold)``
    overrides the default per attribute."""
    t = best
    if thresholds is not None:
        t = t.join(thresholds, "attr", "left")  # per-attribute config rows
    else:
        t = t.withColumn("threshold", F.lit(None).cast("double"))
    thr = F.coalesce(F.col("threshold"), F.lit(default_threshold))
    ok_vals = allowed.select(F.col("category").alias("_c"), F.col("attr").alias("_a"),
                             F.col("value").alias("_ok")).distinct()
    t = t.join(ok_vals, (F.col("category") == F.col("_c")) & (F.col("attr") == F.col("_a"))
               & (F.col("hit_value") == F.col("_ok")), "left").drop("_c", "_a")
    valid = F.col("_ok").isNotNull() | (F.col("hit_value") == "None")
    usable = F.col("usable") if "usable" in best.columns else F.lit(True)
    method = (F.when(F.col("attr").isNull(), "no_schema").when(~usable, "vector_error").when(F.col("score").isNull(), "vector_no_match")
              .when(F.col("score") < thr, "vector_low_similarity")
              .when(valid, "vector").otherwise("vector_invalid"))
    value = F.when(F.col("attr").isNull(), F.lit(None).cast("string")).when(method == "vector", F.col("hit_value")).otherwise(F.lit("None"))
    return t.select("q_id", "category", "attr", value.alias("value"),
                    F.coalesce(F.col("score"), F.lit(0.0)).alias("score"), method.alias("method"))


def per_query_summary(attr_results: DataFrame) -> DataFrame:
    """Per query — mean similarity over attributes, matched attributes,
    method 'vector' when any attribute matched."""
    return attr_results.groupBy("q_id").agg(
        F.avg("score").alias("mean_similarity"),
        F.count_if(F.col("method") == "vector").alias("matched_attributes"),
    ).withColumn("method", F.when(F.col("matched_attributes") > 0, "vector").otherwise("fallback"))


def method_stats(per_query: DataFrame) -> DataFrame:
    """Counts and rates per method and the mean similarity of vector matches."""
    total = per_query.agg(F.count(F.lit(1))).scalar()
    return per_query.groupBy("method").agg(F.count(F.lit(1)).alias("n"),
                                           F.avg("mean_similarity").alias("mean_similarity")) \
        .withColumn("rate", F.round(F.col("n") / total, 6))


# --- knowledge base maintenance ---------------------------------------------

KB_COLUMNS = ["id", "hs4", "category", "attribute_name", "attribute_value", "goods_shipped",
              "confidence", "classification_method", "shipment_count", "version"]


def kb_records_from_labels(rows: DataFrame, hs_col: str = "hs4", cat_col: str = "category",
                           goods_col: str = "goods_shipped", method: str = "historical_llm") -> DataFrame:
    """A3: one product-KB record per (goods, category, hs) with its shipment count."""
    g = rows.groupBy(goods_col, cat_col, hs_col).agg(F.count(F.lit(1)).cast("int").alias("shipment_count"))
    return g.select(short_id(hs_col, cat_col, goods_col).alias("id"), F.col(hs_col).alias("hs4"),
                    F.col(cat_col).alias("category"), F.lit(None).cast("string").alias("attribute_name"),
                    F.lit(None).cast("string").alias("attribute_value"), F.trim(goods_col).alias("goods_shipped"),
                    F.lit(1.0).alias("confidence"), F.lit(method).alias("classification_method"),
                    "shipment_count", F.lit(0).cast("long").alias("version"))


def kb_attribute_id(hs_col, cat_col, attr_col, goods_col) -> Column:
    """the one key of an attribute record: its namespace and description.
    A changed value replaces the record."""
    return short_id(hs_col, cat_col, attr_col, goods_col)


def kb_records_from_attributes(long_attrs: DataFrame, method: str = "manual_load",
                               count_col: str | None = None) -> DataFrame:
    """C11 + P7 + X2 + F10: one attribute-KB record per (namespace, goods):
    the value seen most often, then the smallest; 'None'/blank/NULL values are
    skipped; ids are stable across runs."""
    v = long_attrs.filter(F.col("value").isNotNull() & ~F.col("value").isin("None", "none", "")
                          & (F.trim("value") != ""))
    n = F.sum(count_col) if count_col else F.count(F.lit(1))
    keys = ["hs4", "category", "attr", "goods_shipped"]
    d = v.groupBy(*keys, "value").agg(n.cast("int").alias("n"))
    d = d.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("b"), F.sum("n").cast("int").alias("shipment_count"))
    return d.select(kb_attribute_id(*keys).alias("id"), "hs4", "category",
                    F.col("attr").alias("attribute_name"), F.col("b.value").alias("attribute_value"), "goods_shipped",
                    F.lit(1.0).alias("confidence"), F.lit(method).alias("classification_method"),
                    "shipment_count", F.lit(0).cast("long").alias("version"))


def kb_upsert(existing: DataFrame, updates: DataFrame, id_col: str = "id", version_col: str = "version") -> DataFrame:
    """Union and keep the newest record per id; equal versions are settled
    by all other columns, largest first (idempotent: upserting the same
    updates twice gives the same table)."""
    u = existing.unionByName(updates, allowMissingColumns=True)
    rest = [F.col(c).desc() for c in sorted(u.columns) if c not in (id_col, version_col)]
    w = Window.partitionBy(id_col).orderBy(F.col(version_col).desc(), *rest)
    return u.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def kb_delete(kb: DataFrame, namespaces: DataFrame, ns_cols: Sequence[str]) -> DataFrame:
    """Drop every record of the given namespaces (left anti join)."""
    return kb.join(namespaces.select(*ns_cols).distinct(), list(ns_cols), "left_anti")


def kb_namespace_counts(kb: DataFrame, ns_cols: Sequence[str], top: int = 10) -> DataFrame:
    """KB size per namespace, largest first (a top-10 report)."""
    return kb.groupBy(*ns_cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *ns_cols).limit(top)


def write_back(results: DataFrame, min_score: float, query_col: str = "q_id") -> DataFrame:
    """C10 filter: the results of vector queries whose mean score over the
    query's attributes is at least ``min_score``, and of model queries; one
    record per non-'None' value."""
    mean = F.avg("score").over(Window.partitionBy(query_col))
    keep = ((F.col("method").startswith("vector")) & (F.col("_mean") >= min_score)) | (F.col("method") == "llm")
    return results.withColumn("_mean", mean).filter(keep & F.col("value").isNotNull() & (F.col("value") != "None")).drop("_mean")


def product_write_back(labels: DataFrame, hs_col: str = "hs4", cat_col: str = "category", goods_col: str = "goods_shipped") -> DataFrame:
    """C10, products: fallback labels other than Unclassified as KB records
    with the lower confidence of a model."""
    own = labels.filter(F.col(cat_col).isNotNull() & (F.col(cat_col) != UNCLASSIFIED))
    return own.select(short_id(hs_col, cat_col, goods_col).alias("id"), F.col(hs_col).alias("hs4"), F.col(cat_col).alias("category"),
                      F.lit(None).cast("string").alias("attribute_name"), F.lit(None).cast("string").alias("attribute_value"),
                      F.trim(goods_col).alias("goods_shipped"), F.lit(0.8).alias("confidence"),
                      F.lit("llm_fallback").alias("classification_method"), F.lit(1).alias("shipment_count"), F.lit(1).cast("long").alias("version"))


def word_set(x) -> Column:
    """Distinct lower-case words of a text."""
    c = F.col(x) if isinstance(x, str) else x
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def set_jaccard(a, b) -> Column:
    """Rerank scorer over word sets made before the join (``word_set``), so that
    a text is split once and not for each candidate."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(all_ > 0, both / all_).otherwise(F.lit(0.0))


def token_jaccard(a, b) -> Column:
    """Rerank scorer over texts: shared distinct lower-case words over all of them."""
    return set_jaccard(word_set(a), word_set(b))


def embed_with(df: DataFrame, text_col: str, fn, out_col: str = "embedding") -> DataFrame:
    """A user embedding model applied in the executors on Arrow batches
    (``fn(list[str]) -> list[list[float]]``); the model is loaded once per
    Python worker by the caller's ``fn``."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<double>")
    def _embed(texts: pd.Series) -> pd.Series:
        return pd.Series([list(map(float, v)) for v in fn(texts.tolist())])
    return df.withColumn(out_col, _embed(F.col(text_col)))
