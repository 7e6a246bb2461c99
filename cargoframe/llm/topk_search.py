"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; a segment of ``l`` components is described by
its mean and deviation. By Cauchy-Schwarz a segment's share of an inner product
is at most ``l * (mean * mean' + dev * dev')`` (the same as bounding the
distance from below by ``l * ((mean - mean')^2 + (dev - dev')^2)``), so a few
numbers per vector bound every score from above. Levels go from 4 segments over
segments of two components to half of the components alone; at each one, candidates whose bound is below a
query's threshold drop out for that query, and only (query, candidate) pairs
that are left after the last level get an exact score, in whole numbers.
Components are put in an order first that a sample suggests: neighbours load
alike on its first principal component, so that means say more.

Candidates with like coarse statistics share a cell (a tree of median cuts,
fitted on a bounded sample); a cell knows the range of each statistic, which
bounds every score that it holds. A query goes to its own cell first; with the
k-th best from there (or from the sample) as its threshold, it goes on to the
blocks of those cells only whose bound reaches it, before any vector is
shuffled for it. Within a block candidates are scored by falling bound, and
thresholds rise as they are. Nothing is approximate; what remains is dealt out
in steps of a block and a chunk of queries.

Vectors without structure have bounds far above their scores on coarse levels:
there only the last level drops pairs, and no cell (figures in the README).

Defined cases: vectors that are NULL or hold NULL or non-finite components, and
rows with NULL vec_id, take no part; queries see only candidates with as many
components; a vec_id on several query rows is one query (its smallest vector);
repeated candidate rows count each; a query's own vec_id is no candidate; ties
go to the smaller vec_id; scores beyond the range of a long become its ends;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargoframe.llm.common import Tree, give_back, materialise, matrix

COARSE = 4        # segments of the first level and of the cells' statistics
CANDIDATES, QUERIES = 4096, 2048  # rows of a step
SAMPLE = 2048     # candidates that give the first thresholds, the order of components and the cells
CELLS = 256       # cells at most, over all lengths of vectors
_CHUNK = 512      # candidates of a block that are scored at once
_NONE = np.iinfo(np.int64).min  # no threshold yet


def levels(dim: int) -> list[int]:
    """Segments per level, coarse to fine: 4, 16, 32, ... to segments of two
    components, and one between those and the components themselves (which
    would be the exact score)."""
    out, n = [COARSE], 16
    while n < dim:
        out.append(n)
        n *= 2
    return [s for s in [*out, out[-1] + (dim - out[-1]) // 2] if s < dim]


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound the inner products of the rows of ``x``."""
    parts = [p for p in np.array_split(x, min(segments, max(1, x.shape[1])), axis=1) if p.shape[1]]
    if not parts:
        return np.zeros((len(x), 1))
    scale = [np.sqrt(p.shape[1]) for p in parts]
    return np.stack([s * p.mean(1) for s, p in zip(scale, parts)] + [s * p.std(1) for s, p in zip(scale, parts)], axis=1)


def component_order(x: np.ndarray) -> np.ndarray:
    """An order of components in which neighbours load alike on the first
    principal component of a sample (power iteration)."""
    if len(x) < 2 or x.shape[1] < 2:
        return np.arange(x.shape[1])
    c = x - x.mean(0)
    top = np.abs(c).max()
    c = c / top if top > 0 else c
    v = c[np.argmax((c * c).sum(1))].copy()
    for _ in range(30):
        w = c.T @ (c @ v)
        norm = np.sqrt((w * w).sum())
        if norm == 0:
            break
        v = w / norm
    return np.argsort(v, kind="stable")


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row in whole numbers."""
    most = (float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0))) * max(1, q.shape[1])
    if most < 2.0**62:
        return (q * x).sum(1)
    low, high = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max
    return np.array([min(high, max(low, sum(a * b for a, b in zip(r, c)))) for r, c in zip(q.tolist(), x.tolist())], np.int64)


def all_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all rows in whole numbers; one matrix
    product where doubles hold them exactly."""
    most = (float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0))) * max(1, q.shape[1])
    if most < 2.0**53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return np.stack([exact_scores(np.broadcast_to(r, x.shape), x) for r in q]) if len(q) else np.zeros((0, len(x)), np.int64)


def search_block(q: np.ndarray, q_id: np.ndarray, floor: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int,
                 order: np.ndarray | None = None) -> tuple[list, dict]:
    """Per query (ids, scores) of the rows of a block that can be among its best
    ``k``, and the number of pairs left after each level (and scored exactly).
    Vectors are int64; ``floor``: scores that a k-th best already has."""
    order = np.arange(x.shape[1]) if order is None or len(order) != x.shape[1] else order
    qf, xf = q[:, order].astype(float), x[:, order].astype(float)
    steps = levels(x.shape[1])
    stats = [(segment_statistics(qf, s), segment_statistics(xf, s)) for s in steps]
    slack = (1e-9 * np.sqrt((qf * qf).sum(1)) * np.sqrt((xf * xf).sum(1).max(initial=0)) + 1e-6)[:, None]
    least = floor.copy()
    left = dict.fromkeys(["pairs", *steps, "scored"], 0)
    ids: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
    scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
    rank = np.arange(len(x))
    if steps and len(q):  # by the best coarse bound that any query has
        best = np.concatenate([(stats[0][0] @ stats[0][1][i:i + _CHUNK].T).max(0) for i in range(0, len(x), _CHUNK)])
        rank = np.argsort(-best, kind="stable")
    for at in range(0, len(x), _CHUNK):
        cols = rank[at:at + _CHUNK]
        may = q_id[:, None] != x_id[cols]
        left["pairs"] += int(may.sum())
        reach = least[:, None] - slack
        for s, (a, b) in zip(steps, stats):
            rows = np.flatnonzero(may.any(1))
            if not len(rows):
                break
            may[rows] &= a[rows] @ b[cols].T >= reach[rows]
            left[s] += int(may.sum())
        r, c = np.nonzero(may)
        left["scored"] += len(r)
        c = cols[c]
        s = exact_scores(q[r], x[c])
        good = s >= least[r]
        r, c, s = r[good], c[good], s[good]
        for i in np.unique(r):
            own = slice(*np.searchsorted(r, [i, i + 1]))
            all_s, all_i = np.concatenate([scores[i], s[own]]), np.concatenate([ids[i], x_id[c[own]]])
            best = np.lexsort((all_i, -all_s))[:k]
            scores[i], ids[i] = all_s[best], all_i[best]
            if len(best) == k:
                least[i] = max(least[i], scores[i][-1])
    return list(zip(ids, scores)), left


def _step_rows(most: int) -> Column:
    """Rows of a step: ``most``, fewer for vectors of more than 512 components."""
    return F.greatest(F.lit(32), F.least(F.lit(most), F.floor(F.lit(most * 512) / F.greatest("dim", F.lit(1)))))


class _Fitted:
    """What the sample gives, per length of vectors: its ids and vectors, the
    order of components and the tree of cells."""

    def __init__(self, rows: list, cells: int):
        by_dim: dict[int, list] = {}
        for r in rows:
            by_dim.setdefault(len(r["v"]), []).append(r)
        self.ids = {d: np.array([r["id"] for r in own], np.int64) for d, own in by_dim.items()}
        self.vectors = {d: np.array([r["v"] for r in own], np.int64).reshape(len(own), d) for d, own in by_dim.items()}
        self.order = {d: component_order(x.astype(float)) for d, x in self.vectors.items()}
        self.tree = {d: Tree(self.spots(x), max(1, -(-len(rows) // cells))) for d, x in sorted(self.vectors.items())}

    def spots(self, x: np.ndarray) -> np.ndarray:
        order = self.order.get(x.shape[1])
        return segment_statistics((x if order is None else x[:, order]).astype(float), COARSE)

    def floors(self, q: np.ndarray, q_id: np.ndarray, k: int) -> np.ndarray:
        """A score that the k-th best of each query can't be below."""
        out, dim = np.full(len(q), _NONE), q.shape[1]
        if len(self.ids.get(dim, ())) > k:
            s = np.where(q_id[:, None] == self.ids[dim], _NONE, all_scores(q, self.vectors[dim]))
            out = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        return out


_FOUND = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "vec") -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row against all rows of
    ``vectors`` (id, array of whole numbers)."""
    spark = vectors.sparkSession
    v = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("long")).alias("v"), F.size(vec_col).alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("q"), F.monotonically_increasing_id().alias("row"))
    v = materialise(v, "vectors")
    n = v.count()
    share = F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    fitted = spark.sparkContext.broadcast(_Fitted(v.filter(share * n < SAMPLE).select("id", "v").collect(), min(CELLS, max(1, n // CANDIDATES))))  # about SAMPLE rows

    def by_length(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        dims = b.column("dim").to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            yield at, matrix(b.column("v").take(pa.array(at)), int(dim), np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cell of every row and its coarse statistics."""
        for b in batches:
            cell, known, spots = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, bool), np.zeros((b.num_rows, 2 * COARSE))
            for at, x in by_length(b):
                own = fitted.value.spots(x)
                spots[at, :own.shape[1]] = own
                if x.shape[1] in fitted.value.tree:
                    cell[at], known[at] = fitted.value.tree[x.shape[1]].leaf_of(own), True
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(known), pa.array(list(spots), pa.list_(pa.float64()))],
                                             names=[*b.schema.names, "cell", "sampled", "spot"])

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                out, ids = np.full(part.num_rows, _NONE), part.column("id").to_numpy()
                for at, q in by_length(part):
                    out[at] = fitted.value.floors(q, ids[at], k)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.int64())], names=[*part.schema.names, "floor"])

    def pair(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dim, got, q_id = key[0].as_py(), [], np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            q_id = right.column("id").to_numpy()
            got, _ = search_block(matrix(right.column("v"), dim, np.int64), q_id, right.column("floor").to_numpy(),
                                  matrix(left.column("v"), dim, np.int64), left.column("id").to_numpy(), k, fitted.value.order.get(dim))
        out = pa.table([pa.array(np.repeat(q_id, [len(i) for i, _ in got]), pa.int64()),
                        pa.array(np.concatenate([np.zeros(0, np.int64), *(i for i, _ in got)]), pa.int64()),
                        pa.array(np.concatenate([np.zeros(0, np.int64), *(s for _, s in got)]), pa.int64())], names=["query_id", "vec_id", "score"])
        give_back()
        return out

    placed = v.mapInArrow(place, "id long, v array<long>, dim int, q boolean, row long, cell int, sampled boolean, spot array<double>")
    placed = materialise(placed, "placed")
    axis = [F.get("spot", F.lit(j)) for j in range(2 * COARSE)]
    boxes = placed.groupBy("dim", "cell", "sampled").agg(
        F.count("*").alias("rows"), F.array(*(F.min(a) for a in axis)).alias("low"), F.array(*(F.max(a) for a in axis)).alias("high"))
    boxes = materialise(boxes.withColumn("blocks", F.ceil(F.col("rows") / _step_rows(CANDIDATES)).cast("int")), "boxes")
    dealt = boxes.select("dim", "cell", "blocks")
    x = placed.join(dealt, ["dim", "cell"]).select("dim", "cell", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"), "id", "v")
    # a repeated query row is one query: that of its smallest vector
    one = placed.filter("q").groupBy("id").agg(F.min(F.struct("v", "dim", "cell", "sampled", "spot")).alias("s")).select("id", "s.*")
    queries = one.mapInArrow(floors, "id long, v array<long>, dim int, cell int, sampled boolean, spot array<double>, floor long")
    queries = queries.join(dealt, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    queries = materialise(queries, "queries")

    def visit(asked: DataFrame) -> DataFrame:
        """Search blocks for (query, block) rows, in steps of bounded size."""
        asked = materialise(asked.select("dim", "cell", "block", "id", "v", "floor"), "asked")
        steps = asked.groupBy("dim", "cell", "block").agg(F.ceil(F.count("*") / _step_rows(QUERIES)).cast("int").alias("chunks"))
        left = x.join(steps, ["dim", "cell", "block"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        right = asked.join(steps, ["dim", "cell", "block"]).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit("c")), F.col("chunks")).cast("int"))
        keys = ["dim", "cell", "block", "chunk"]
        left, right = left.select(*keys, "id", "v"), right.select(*keys, "id", "v", "floor")
        return materialise(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, _FOUND), "found")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = visit(queries)
    floor = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("own"))
    asked = queries.withColumnsRenamed({"cell": "own_cell", "block": "own_block"}).join(floor, "id", "left")
    asked = asked.withColumn("floor", F.greatest("floor", "own")).drop("own")
    # the cells of sampled lengths are bounded by the sample's size, any other length of vectors has one cell
    bound = F.aggregate(F.zip_with("spot", F.arrays_zip("low", "high"), lambda s, b: F.greatest(s * b["low"], s * b["high"])), F.lit(0.0), lambda t, y: t + y)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda t, y: t + y * y))
    top = F.zip_with("low", "high", lambda a, b: F.greatest(F.abs(a), F.abs(b)))
    reached = bound + norm("spot") * norm(top) * 1e-9 + 1e-6 >= F.col("floor").cast("double")
    by_box = asked.filter("sampled").join(F.broadcast(boxes.filter("sampled").select("dim", "cell", "blocks", "low", "high")), "dim").filter(reached).drop("low", "high")
    alone = asked.filter("NOT sampled").join(boxes.filter("NOT sampled").select("dim", "cell", "blocks"), "dim")
    more = by_box.unionByName(alone).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    found = first.unionByName(visit(more.filter((F.col("cell") != F.col("own_cell")) | (F.col("block") != F.col("own_block")))))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
