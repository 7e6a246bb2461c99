"""Approximate nearest neighbours by low-dimensional stable projections.

Largest inner product becomes smallest distance: with ``M`` the largest norm, a
vector gets one component more, sqrt(M^2 - |x|^2), a query is scaled to norm M
and gets 0; all are divided by M. A Gaussian projection to ``PROJECTED``
components is 2-stable: the squared projected distance of two points is their
squared distance times a chi-square variable of that many degrees of freedom.

The projected points are indexed by kd-trees in two storeys. The upper one is
cut along medians of a bounded sample (``SAMPLE`` rows, ``CELLS`` leaves at
most); every row falls into a cell, a cell is dealt by row number to blocks of
about ``BLOCK`` rows, and a block has a kd-tree of its own down to ``LEAF`` rows.
A query visits the leaves of a block by increasing projected distance. Points
are verified (inner product of the original vectors, in double precision) as
long as their projected distance s leaves the test open: with d the distance of
the k-th best so far, the search stops when chi-square's distribution function
at s^2 / d^2 is ``confidence`` or more, since a nearer point would show a
projected distance below s with at least that probability.

The query's own block goes first and gives d; then the query goes to the blocks
of those cells that the test doesn't exclude, in steps of a block and at most
``CHUNK`` queries. Each true neighbour is found with probability
``confidence`` at least, so that is the expected recall; nothing else cuts the
search short. Vectors without structure (all about equally far) leave most
points within the test; clustered ones few: ``n_verified`` tells.

Defined cases: vectors that are NULL, zero, empty or hold NULL or non-finite
components, and rows with NULL id, take no part; queries see only candidates
with as many components; an id on several query rows is one query (its smallest
vector); repeated candidate rows count each; a query's own id is no candidate;
ties go to the smaller id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargoframe.llm.common import Tree, give_back, is_finite, materialise, matrix

PROJECTED = 10     # components of a projection (even)
CONFIDENCE = 0.95  # of the stopping test
SAMPLE = 16_384    # rows that the upper tree is cut along
CELLS = 256        # cells of the upper tree at most, over all lengths of vectors
BLOCK, CHUNK, LEAF = 8192, 2048, 64


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < p else (low, mid)
    return high


def projection(dim: int, to: int = PROJECTED) -> np.ndarray:
    """The Gaussian matrix for vectors of ``dim`` components and one more; the
    same in every task."""
    return np.random.default_rng([17, dim, to]).standard_normal((dim + 1, to))


def lengths(x: np.ndarray) -> np.ndarray:
    """Norms of non-zero rows, by way of their largest components."""
    big = np.abs(x).max(1)
    return big * np.sqrt(((x / big[:, None]) ** 2).sum(1))


def project(x: np.ndarray, top: float, query: bool, to: int = PROJECTED) -> np.ndarray:
    """Projected points of the rows of ``x``; ``top`` is the largest norm."""
    if query:
        y, more = x / np.abs(x).max(1)[:, None], np.zeros(len(x))
        y /= lengths(y)[:, None]
    else:
        y = x / top
        more = np.sqrt(np.maximum(0.0, 1 - (y * y).sum(1)))
    p = projection(x.shape[1], to)
    return y @ p[:-1] + more[:, None] * p[-1]


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to boxes (columns)."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        p = points[:, j, None]
        d = np.maximum(0, np.maximum(low[:, j] - p, p - high[:, j]))
        out += d * d
    return out


def search_block(q: np.ndarray, q_id: np.ndarray, floor: np.ndarray, x: np.ndarray, x_id: np.ndarray, top: float, k: int,
                 limit: float, to: int = PROJECTED) -> tuple[list, np.ndarray]:
    """Best rows of one block: per query (ids, scores), and how many rows were
    verified. ``floor``: inner products that a k-th best already has; ``limit``:
    the chi-square quantile of the stopping test."""
    px, pq = project(x, top, False, to), project(q, top, True, to)
    tree = Tree(px, LEAF)
    leaves = [part for r in tree.leaves for part in np.array_split(r, -(-len(r) // LEAF))]  # equal points make long leaves
    low = np.array([px[r].min(0) for r in leaves])
    high = np.array([px[r].max(0) for r in leaves])
    far = box_distance(pq, low, high)
    order = np.argsort(far, axis=1, kind="stable")
    length = lengths(q)
    ids: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
    scores: list[np.ndarray] = [np.zeros(0)] * len(q)
    verified = np.zeros(len(q), np.int64)
    least = floor.copy()
    slack = 1e-13 * x.shape[1] * length * top  # of a matrix product

    def reach(rows: np.ndarray) -> np.ndarray:
        """Squared projected distance beyond which the test stops."""
        d2 = np.maximum(0.0, 2 - 2 * (least[rows] / length[rows] / top))
        return limit * d2 * (1 + 1e-9) + 1e-9

    active = np.arange(len(q))
    for step in range(len(leaves)):
        leaf = order[active, step]
        going = far[active, leaf] <= reach(active)
        active, leaf = active[going], leaf[going]
        if not len(active):
            break
        turn = np.argsort(leaf, kind="stable")
        for rows in np.split(active[turn], np.flatnonzero(np.diff(leaf[turn])) + 1):
            members = leaves[int(order[rows[0], step])]
            s2 = ((pq[rows, None, :] - px[None, members, :]) ** 2).sum(2)
            near = (s2 <= reach(rows)[:, None]) & (x_id[members] != q_id[rows, None])
            verified[rows] += near.sum(1)
            at_q, at_x = np.nonzero(near & (q[rows] @ x[members].T >= (least[rows] - slack[rows])[:, None]))
            # products of one row with one row, summed alike wherever the row lies: equal vectors score equal
            s = (q[rows[at_q]] * x[members[at_x]]).sum(1)
            good = s >= least[rows[at_q]]
            at_q, at_x, s = at_q[good], at_x[good], s[good]
            for i in np.unique(at_q):
                r, own = rows[i], at_q == i
                all_s = np.concatenate([scores[r], s[own]])
                all_i = np.concatenate([ids[r], x_id[members[at_x[own]]]])
                best = np.lexsort((all_i, -all_s))[:k]
                scores[r], ids[r] = all_s[best], all_i[best]
                if len(best) == k:
                    least[r] = max(least[r], scores[r][-1])
    return list(zip(ids, scores)), verified


_FOUND = "query_id long, vec_id long, score double, verified long"


def _found(q_id: np.ndarray, got: list, verified: np.ndarray) -> pa.Table:
    """Found rows, and per query one row without vec_id that carries the count."""
    n = [len(i) for i, _ in got]
    return pa.table([
        pa.array(np.concatenate([np.repeat(q_id, n), q_id]), pa.int64()),
        pa.array(np.concatenate([*(i for i, _ in got), np.zeros(len(q_id), np.int64)]), pa.int64(),
                 mask=np.concatenate([np.zeros(sum(n), bool), np.ones(len(q_id), bool)])),
        pa.array(np.concatenate([*(s for _, s in got), np.zeros(len(q_id))]), pa.float64()),
        pa.array(np.concatenate([np.zeros(sum(n), np.int64), verified]), pa.int64()),
    ], names=["query_id", "vec_id", "score", "verified"])


def nearest(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
            confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score, n_verified) of every query row against all
    rows of ``vectors`` (id, array of numbers)."""
    spark = vectors.sparkSession
    limit = chi_square_quantile(confidence, PROJECTED)
    v = vectors.filter(F.col(id_col).isNotNull() & is_finite(vec_col)).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("v"), is_query.alias("q"))
    # the norm by way of the largest component, so that it neither overflows nor vanishes
    big = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    v = v.withColumn("big", big).filter("big > 0")
    norm = F.col("big") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("big")) * (x / F.col("big"))))
    v = v.select("id", "v", F.coalesce("q", F.lit(False)).alias("q"), F.size("v").alias("dim"), F.least(norm, F.lit(1e308)).alias("norm"))
    v = v.withColumn("row", F.monotonically_increasing_id())
    tops = materialise(v.groupBy("dim").agg(F.max("norm").alias("top"), F.count("*").alias("rows")), "tops")
    n = tops.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    # the upper tree: from projected points of a bounded sample, the more cells the more rows there are
    share = F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    point, columns = "array<double>", "id long, v array<double>, q boolean, dim int, top double, row long"
    picked = v.filter(share * max(n, 1) < SAMPLE).join(tops.select("dim", "top"), "dim").select("id", "v", "q", "dim", "top", "row")
    picked = picked.mapInArrow(_place(None), f"{columns}, cell int, sampled boolean, spot {point}").select("dim", "spot").collect()  # about SAMPLE rows
    sample: dict[int, list] = {}
    for r in picked:
        sample.setdefault(r["dim"], []).append(r["spot"])
    cells = min(CELLS, max(1, n // BLOCK))
    trees = {dim: Tree(np.array(rows), -(-len(picked) // cells)) for dim, rows in sorted(sample.items())}
    place = _place(spark.sparkContext.broadcast(trees))
    placed = v.join(tops.select("dim", "top"), "dim").select("id", "v", "q", "dim", "top", "row")
    placed = materialise(placed.mapInArrow(place, f"{columns}, cell int, sampled boolean, spot {point}"), "placed")
    axis = [F.get("spot", F.lit(j)) for j in range(PROJECTED)]
    boxes = placed.groupBy("dim", "cell", "sampled").agg(
        F.count("*").alias("rows"), F.array(*(F.min(a) for a in axis)).alias("low"), F.array(*(F.max(a) for a in axis)).alias("high"))
    boxes = materialise(boxes.withColumn("blocks", F.ceil(F.col("rows") / _step_rows(BLOCK)).cast("int")), "boxes")
    dealt = boxes.select("dim", "cell", "blocks")
    x = placed.join(dealt, ["dim", "cell"]).select(
        "dim", "cell", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"), "id", "v", "top")
    # a repeated query row is one query: that of its smallest vector
    one = placed.filter("q").groupBy("id").agg(F.min(F.struct("v", "dim", "cell", "sampled", "top")).alias("s")).select("id", "s.*")
    queries = one.join(dealt, ["dim", "cell"]).select(
        "dim", "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "v", "top", "sampled", F.lit(float("-inf")).alias("floor"))
    queries = materialise(queries, "queries")

    def pair(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        if not left.num_rows or not right.num_rows:
            return _found(np.zeros(0, np.int64), [], np.zeros(0, np.int64))
        q_id = right.column("id").to_numpy()
        got = search_block(matrix(right.column("v"), dim), q_id, right.column("floor").to_numpy(),
                           matrix(left.column("v"), dim), left.column("id").to_numpy(), right.column("top")[0].as_py(), k, limit)
        out = _found(q_id, *got)
        give_back()
        return out

    def visit(asked: DataFrame) -> DataFrame:
        """Search blocks for (query, block) rows, in steps of bounded size."""
        asked = materialise(asked, "asked")
        steps = asked.groupBy("dim", "cell", "block").agg(F.ceil(F.count("*") / _step_rows(CHUNK)).cast("int").alias("chunks"))
        left = x.join(steps, ["dim", "cell", "block"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        right = asked.join(steps, ["dim", "cell", "block"]).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit("c")), F.col("chunks")).cast("int"))
        keys = ["dim", "cell", "block", "chunk"]
        left, right = left.select(*keys, "id", "v"), right.select(*keys, "id", "v", "top", "floor")
        return materialise(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, _FOUND), "found")

    first = visit(queries)
    kth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = (first.filter("vec_id IS NOT NULL").withColumn("rank", F.row_number().over(kth)).filter(F.col("rank") == k)
              .select(F.col("query_id").alias("id"), F.col("score").alias("at_least")))
    asked = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("at_least", "floor")).drop("at_least")
    asked = asked.mapInArrow(_spots, "id long, v array<double>, dim int, top double, floor double, sampled boolean, own_cell int, own_block int, "
                             f"reach double, at {point}").withColumn("reach", F.col("reach") * limit * (1 + 1e-9) + 1e-9)
    # a query takes the cells whose box the test leaves open; the cells of sampled lengths are bounded by the
    # sample's size, any other length of vectors has one cell
    gap = F.aggregate(F.zip_with("at", F.arrays_zip("low", "high"), lambda p, box: F.greatest(F.lit(0.0), box["low"] - p, p - box["high"])),
                      F.lit(0.0), lambda s, d: s + d * d)
    by_box = asked.filter("sampled").join(F.broadcast(boxes.filter("sampled").select("dim", "cell", "blocks", "low", "high")), "dim")
    by_box = by_box.filter(gap <= F.col("reach")).drop("low", "high")
    alone = asked.filter("NOT sampled").join(boxes.filter("NOT sampled").select("dim", "cell", "blocks"), "dim")
    more = (by_box.unionByName(alone).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .filter((F.col("cell") != F.col("own_cell")) | (F.col("block") != F.col("own_block")))
            .select("dim", "cell", "block", "id", "v", "top", "floor"))
    found = first.unionByName(visit(more))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    counts = found.groupBy("query_id").agg(F.sum("verified").alias("n_verified"))
    ranked = found.filter("vec_id IS NOT NULL").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(counts, "query_id").select("query_id", "rank", "vec_id", "score", "n_verified")


def _step_rows(most: int) -> Column:
    """Rows of a step: ``most``, fewer for vectors of more than 512 components."""
    return F.greatest(F.lit(64), F.least(F.lit(most), F.floor(F.lit(most * 512) / F.col("dim"))))


def _place(trees):
    """Task function: the cell and the projected point of every row; ``trees``
    is a broadcast (None: no cells)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, tops = b.column("dim").to_numpy(), b.column("top").to_numpy()
            cell, known, spots = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, bool), np.zeros((b.num_rows, PROJECTED))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                spots[at] = project(matrix(b.column("v").take(pa.array(at)), int(dim)), tops[at[0]], False)
                if trees is not None and int(dim) in trees.value:
                    cell[at], known[at] = trees.value[int(dim)].leaf_of(spots[at]), True
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(known), pa.array(list(spots), pa.list_(pa.float64()))],
                                             names=[*b.schema.names, "cell", "sampled", "spot"])

    return run


def _spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Projected points of queries, and how far the test reaches (before the quantile)."""
    for b in batches:
        dims, tops = b.column("dim").to_numpy(), b.column("top").to_numpy()
        at, reach = np.zeros((b.num_rows, PROJECTED)), np.zeros(b.num_rows)
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            q, top = matrix(b.column("v").take(pa.array(rows)), int(dim)), tops[rows[0]]
            at[rows] = project(q, top, True)
            reach[rows] = np.maximum(0.0, 2 - 2 * (b.column("floor").to_numpy()[rows] / lengths(q) / top))
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("id", "v", "dim", "top", "floor", "sampled", "cell", "block")), pa.array(reach), pa.array(list(at), pa.list_(pa.float64()))],
            names=["id", "v", "dim", "top", "floor", "sampled", "own_cell", "own_block", "reach", "at"])
