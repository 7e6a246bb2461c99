"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoframe.session import ensure_checkpoint_dir, table_path


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """Scan one input table, naming the columns that are needed."""
    return spark.read.parquet(table_path(sf_dir, table)).select(*cols)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of what came
    before, and two readers of the result see the same rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: str, n: int):
    """crc32 of a column written as text, modulo ``n`` (NULL stays NULL)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def arrow_map(df: DataFrame, fn: Callable[[dict[str, pa.Array]], dict], schema: str) -> DataFrame:
    """``mapInArrow`` over column dictionaries: ``fn`` gets {name: Arrow array}
    of one batch and returns {name: values} with all output columns."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                got = fn({n: part.column(i) for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, got[f.name]) for f in out)],
                    schema=out)
        give_back()

    return df.mapInArrow(run, schema)


def slices(b: pa.RecordBatch, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that one Python step holds a bounded number of bytes."""
    step = max(1, int(b.num_rows * max_bytes / max(b.nbytes, 1)))
    for at in range(0, b.num_rows, step):
        yield b.slice(at, step)


def matrix(col: pa.Array, dim: int, dtype=np.float64) -> np.ndarray:
    """A list column whose rows all have ``dim`` values, as a dense matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(col), dim)


def is_finite(vec: str) -> Column:
    """Whether a vector is there and holds finite components only."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & ok, F.lit(False))


class Tree:
    """Median cuts over projected points: leaves of at most ``leaf`` points."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.cuts: list[tuple] = []  # (axis, value, left, right) or the leaf's number, by node
        self.leaves: list[np.ndarray] = []
        self._grow(points, np.arange(len(points)), leaf)

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        at = len(self.cuts)
        self.cuts.append(())
        own = points[rows]
        spread = own.max(0) - own.min(0) if len(rows) else np.zeros(1)
        axis = int(spread.argmax())
        right = own[:, axis] >= np.median(own[:, axis]) if len(rows) > leaf and spread[axis] > 0 else np.zeros(0, bool)
        if right.all() and len(right):  # the median is the least value
            right = own[:, axis] > own[:, axis].min()
        if right.any():
            value = own[right, axis].min()
            self.cuts[at] = (axis, float(value), self._grow(points, rows[~right], leaf), self._grow(points, rows[right], leaf))
        else:  # few points, or all equal
            self.cuts[at] = (len(self.leaves),)
            self.leaves.append(rows)
        return at

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            cut = self.cuts[node]
            if len(cut) == 1:
                out[rows] = cut[0]
            else:
                right = points[rows, cut[0]] >= cut[1]
                todo += [(cut[2], rows[~right]), (cut[3], rows[right])]
        return out


def give_back() -> None:
    """Return freed memory to the system, so that a Python worker that waits
    for its next task holds little (without glibc: Arrow's pool only)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_held: list = [None, None]


def held(key, make: Callable):
    """The one large object (a codec, a memo) that a Python worker keeps
    between tasks: asking for another key lets the last one go."""
    if _held[0] != key:
        _held[:] = [None, None]
        _held[:] = [key, make()]
    return _held[1]


class Memo(dict):
    """A bounded memo of ``compute(key)``. When the young half is full it
    becomes the old half; entries used again move back to the young half.
    Keys longer than ``longest`` are computed each time."""

    def __init__(self, compute: Callable, size: int, longest: int = 64):
        super().__init__()
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_CONTRACT = 500_000  # nodes that a partition's union-find holds at once


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: each node with the smallest
    node it reaches here. Holds a bounded number of nodes: a full table is
    given out and started anew, which later rounds make good."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def stars() -> pa.RecordBatch:
        pairs = [(x, r) for x in root if (r := find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            root.setdefault(u, u)
            root.setdefault(v, v)
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
        if len(root) >= _CONTRACT:
            yield stars()
            root = {}
    yield stars()
    root = {}
    give_back()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``links``; component is the smallest
    node reached.

    Each partition first contracts its own links with union-find, then
    large-star / small-star rounds run until only stars are left. No component is
    ever gathered in one task: a round keeps one row per link and reduces
    with ``min``.
    """
    small = F.least(F.col(a), F.col(b)).alias("v")
    big = F.greatest(F.col(a), F.col(b)).alias("u")
    edges = links.filter(F.col(a) != F.col(b)).select(big, small).mapInArrow(_contract, "u long, v long")
    edges = materialise(edges.distinct(), "links")
    while not _all_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u")
        star = (star.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(low.select("u", F.col("m").alias("v"))).filter("u != v"))
        edges = materialise(star.distinct(), "links")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select("v", F.col("v").alias("component")).distinct()))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, itself without one."""
    ends = edges.select(F.col("u").alias("x"), F.col("v").alias("p")).union(edges.select("v", F.lit(None).cast("long")))
    n = ends.groupBy("x").agg(F.min("p").alias("a"), F.max("p").alias("b"), F.max(F.col("p").isNull()).alias("root"))
    return n.filter(F.col("a").isNotNull() & (F.col("root") | (F.col("a") != F.col("b")))).limit(1).count() == 0
