"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors are compared by cosine within their label only.

1. Equal vectors form a class; the graph holds one node per class.
2. Labels larger than ``SHARD`` rows are clustered: centroids are fitted on
   about ``SAMPLE`` of a label's rows. A node is a member of its nearest
   centroid's shard (its home) and of every shard whose border is closer than
   ``overlap``, so shards overlap: by the whole link distance, so that a
   node's home shard holds every node it may link with. Shards larger than ``BLOCK`` are dealt into
   blocks by a hash.
3. Every block builds a flat graph over its members: a node's nearest
   neighbours, robust-pruned (a neighbour goes if one that stays is ``ALPHA``
   times closer to it than the node is).
4. The adjacency lists that a node got in several blocks are united.
5. Every node is searched for in the blocks of its home shard: greedy search
   from the block's entry points (the medoid, and one for each piece of the
   graph that the others do not reach; also the node itself where the block
   holds it) keeps a beam of the best; while nodes within the link distance
   turn up it goes on expanding, however many there are.
6. Found nodes are verified in double precision. A block returns a node's
   link count and a spanning forest of its links, never the pairs of a dense
   group; union-find over the forests gives components.
7. An audit searches a bounded sample of nodes by brute force against all
   rows; the sample grows until ``LINKED`` of its nodes have links. Recall is
   the mean over those nodes of the share of their linked nodes that was
   found. If it is below ``target``, the search runs again with twice the
   beam (and overlap, if it is set below the link distance). After the last try, or if the largest sample holds too
   few linked nodes to tell, the blocks of a home shard are compared exactly,
   pair by pair, by matrix products. Recall is NULL where no audited node has
   a link (1.0 if every node was audited: there is nothing to find).

Defined cases: vectors that are NULL, zero or hold NULL or non-finite
components, and rows with NULL label or vec_id, link with nothing; vectors of
different length are not compared; rows that repeat a vec_id are one node of
the graph; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoframe.llm.common import connected_components, is_finite, materialise, matrix

SHARD, BLOCK, SAMPLE = 1024, 4096, 2048
CENTROIDS = 256      # of one label
CLUSTERED = 4096     # labels that are clustered; the rest are only dealt into blocks
DEGREE, NEAREST, ALPHA = 24, 48, 1.2
AUDIT = 200          # nodes that the audit searches by brute force at first
LINKED = 50          # of them with links; fewer, and the audit takes four times the nodes
AUDITS = 4           # samples it takes at most
CELLS = 2_000_000    # inner products that an audit step holds at once


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        c = np.where(norm > 0, total / np.maximum(norm, 1e-12), c)
    return c


def shards_of(x: np.ndarray, c: np.ndarray, overlap: float) -> tuple[np.ndarray, np.ndarray]:
    """Home shard of every row, and the membership matrix [row, shard]: the
    border to another centroid is the plane half way between."""
    s = x @ c.T
    home = s.argmax(1)
    gap = np.sqrt(np.maximum(2 - 2 * c @ c.T, 1e-12))  # between unit centroids
    member = (s.max(1, keepdims=True) - s) / gap[home] <= overlap
    member[np.arange(len(x)), home] = True
    return home, member


def build_graph(x: np.ndarray) -> np.ndarray:
    """Adjacency [node, DEGREE] of a block, -1 where there is none."""
    n = len(x)
    out = np.full((n, DEGREE), -1)
    m = min(NEAREST, n - 1)
    if m < 1:
        return out
    for a in range(0, n, 512):
        d = 2 - 2 * (x[a:a + 512] @ x.T)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        near = np.argpartition(d, m - 1, axis=1)[:, :m]
        own = np.take_along_axis(d, near, 1)
        order = np.argsort(own, axis=1, kind="stable")
        near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
        v = x[near]
        between = 2 - 2 * np.einsum("nid,njd->nij", v, v, optimize=True)
        alive = np.ones_like(near, bool)
        kept = np.zeros(len(near), int)
        for i in range(m):
            take = alive[:, i] & (kept < DEGREE)
            rows = np.flatnonzero(take)
            out[a + rows, kept[rows]] = near[rows, i]
            kept[rows] += 1
            alive[rows] &= ~(ALPHA * ALPHA * between[rows, i] <= own[rows]) | (np.arange(m) <= i)
    return out


def with_reverse(adj: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, neighbour) and reverse edges: a node's nearest neighbour
    always points back at it, so that every node can be reached; of the other
    nodes that point to it, a node keeps the DEGREE that rank it highest."""
    row, rank = np.nonzero(adj >= 0)
    to = adj[row, rank]
    order = np.lexsort((row, rank, to))
    back = to[order]
    nth = np.arange(len(back)) - np.searchsorted(back, back)
    keep = (nth < DEGREE) | (rank[order] == 0)
    return np.append(row, back[keep]), np.append(to, row[order][keep])


def entry_points(x: np.ndarray, adj: list[np.ndarray]) -> list[int]:
    """Nodes from which every node can be reached: the medoid, and again the
    medoid of the nodes that are still out of reach (a tight group with more
    members than NEAREST has no edge in or out)."""
    seen, out = np.zeros(len(x), bool), []
    while not seen.all():
        rest = np.flatnonzero(~seen)
        front = rest[[(x[rest] @ x[rest].mean(0)).argmax()]]
        out.append(int(front[0]))
        seen[front] = True
        while len(front):
            to = np.unique(np.concatenate([adj[i] for i in front]))
            front = to[~seen[to]]
            seen[front] = True
    return out


def range_search(x: np.ndarray, adj: list[np.ndarray], q: np.ndarray, start: list[list[int]], reach: float, beam: int) -> list[np.ndarray]:
    """Per query the nodes found within squared distance ``reach``: greedy
    search with a beam that widens to all nodes within reach."""
    n = len(x)
    ends = np.append(0, np.cumsum([len(a) for a in adj] + [0]))  # node n has no neighbours
    flat = np.concatenate([*adj, np.zeros(0, int)]).astype(int)
    x = np.vstack([x, np.zeros_like(x[:1])]).astype(np.float32)
    q = q.astype(np.float32)
    dist = np.full((len(q), n + 1), np.inf, np.float32)
    todo = np.zeros((len(q), n + 1), bool)
    best = np.full((len(q), beam), np.inf, np.float32)
    for i, s in enumerate(start):
        dist[i, s] = 2 - 2 * (x[s] @ q[i])
        todo[i, s] = True
        best[i, :len(s)] = np.sort(dist[i, s])[:beam]
    active = np.arange(len(q))
    while len(active):
        d = np.where(todo[active], dist[active], np.inf)
        pick = np.argpartition(d, min(4, n) - 1, axis=1)[:, :min(4, n)]
        near = np.take_along_axis(d, pick, 1)
        go = (near <= np.maximum(best[active].max(1), reach)[:, None]) & np.isfinite(near)
        more = go.any(1)
        active, pick, go = active[more], pick[more], go[more]
        if not len(active):
            break
        pick = np.where(go, pick, n)
        todo[active[:, None], pick] = False
        pick, row = pick.ravel(), np.repeat(np.arange(len(active)), pick.shape[1])
        size = ends[pick + 1] - ends[pick]
        row = np.repeat(row, size)
        new = flat[np.repeat(ends[pick + 1] - np.cumsum(size), size) + np.arange(len(row))]
        fresh = ~np.isfinite(dist[active[row], new])
        key = np.unique(row[fresh] * np.int64(n) + new[fresh])
        row, new = key // n, key % n
        got = 2 - 2 * np.einsum("nd,nd->n", x[new], q[active[row]])
        dist[active[row], new] = got
        todo[active[row], new] = True
        first = np.searchsorted(row, row)
        most = int((np.arange(len(row)) - first).max(initial=-1)) + 1
        extra = np.full((len(active), most), np.inf, np.float32)
        extra[row, np.arange(len(row)) - first] = got
        both = np.concatenate([best[active], extra], 1)
        best[active] = np.partition(both, beam - 1, axis=1)[:, :beam]
    return [np.flatnonzero(r[:n] <= reach) for r in dist]


class Forest:
    """Components of a block's nodes; ``add`` returns the new links that join
    them, so a dense group gives as many links as it has nodes."""

    def __init__(self, n: int):
        self.of = np.arange(n)  # smallest node of each node's component

    def add(self, own: int | None, near: np.ndarray) -> np.ndarray:
        """Join node ``own`` (None: it stands outside the block) with ``near``;
        the components' smallest nodes that it is to be linked with."""
        met = np.unique(self.of[near])
        mine = -1 if own is None else self.of[own]
        every = met if own is None else np.union1d(met, mine)
        if len(every) > 1:
            self.of[np.isin(self.of, every)] = every[0]
        return met[met != mine]


def _nodes(vectors: DataFrame) -> DataFrame:
    ok = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite("embedding")
                        & F.exists("embedding", lambda x: x != 0))
    return materialise(ok.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
                       .withColumn("dim", F.size("embedding")).withColumn("group", F.concat_ws("/", F.col("label").cast("string"), F.col("dim"))), "nodes")


def _centroids(nodes: DataFrame) -> dict[str, np.ndarray]:
    """Centroids of the large groups: at most CENTROIDS each, CLUSTERED groups."""
    sizes = nodes.groupBy("group").agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > SHARD).orderBy(F.desc("n"), "group").limit(CLUSTERED)
    share = F.pmod(F.xxhash64("id", F.lit("centroids")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = nodes.join(large, "group").filter(share * F.col("n") < SAMPLE).select("group", "n", "id", "embedding")

    def fit(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        x = unit(matrix(t.column("embedding"), len(t.column("embedding")[0])))
        k = min(CENTROIDS, len(x), -(-t.column("n")[0].as_py() // SHARD))
        c = fit_centroids(x, k)
        return pa.table({"group": [key[0].as_py()], "k": pa.array([k], pa.int32()), "c": pa.array([c.ravel().tolist()], pa.list_(pa.float64()))})

    got = sample.groupBy("group").applyInArrow(fit, "group string, k int, c array<double>").collect()
    return {r["group"]: np.array(r["c"]).reshape(r["k"], -1) for r in got}


def _assign(nodes: DataFrame, centroids: dict, overlap: float) -> DataFrame:
    """(group, shard, id, embedding, copies, home) of every membership."""
    sent = nodes.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            groups = np.array(b.column("group").to_pylist(), object)
            rows, shards, homes = [], [], []
            for g in sorted(set(groups)):
                at = np.flatnonzero(groups == g)
                c = sent.value.get(g)
                if c is None:
                    home, member = np.zeros(len(at), int), np.ones((len(at), 1), bool)
                else:
                    home, member = shards_of(unit(matrix(b.column("embedding").take(pa.array(at)), c.shape[1])), c, overlap)
                r, s = np.nonzero(member)
                rows.append(at[r])
                shards.append(s)
                homes.append(home[r] == s)
            if rows:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column("group").take(take), pa.array(np.concatenate(shards).astype(np.int32)), b.column("id").take(take),
                     b.column("embedding").take(take), b.column("copies").take(take), pa.array(np.concatenate(homes))],
                    names=["group", "shard", "id", "embedding", "copies", "home"])

    kind = nodes.schema["embedding"].dataType.simpleString()
    return nodes.select("group", "id", "embedding", "copies").mapInArrow(
        run, f"group string, shard int, id long, embedding {kind}, copies long, home boolean")


def _search(members: DataFrame, cosine: float, beam: int, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(id, n_links, n_near) and the forest (a, b) of all blocks; ``exact``
    compares all pairs of a block of points and a block of a home shard."""
    sizes = members.groupBy("group", "shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = members.join(sizes, ["group", "shard"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def build(key: tuple, t: pa.Table) -> pa.Table:
        ids = t.column("id").to_numpy()
        adj = build_graph(unit(matrix(t.column("embedding"), len(t.column("embedding")[0]))))
        row, to = with_reverse(adj)
        return pa.table({"group": pa.array([key[0].as_py()] * len(row), pa.string()), "id": pa.array(ids[row]), "to": pa.array(ids[to])})

    edges = members.select("group", "shard", "block", "id", "embedding").groupBy("group", "shard", "block").applyInArrow(
        build, "group string, id long, to long")
    lists = edges.groupBy("group", "id").agg(F.collect_set("to").alias("to"))  # less than BLOCK a block
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    if exact:  # a part is a block of queries
        points = members.select("group", "shard", "block", every.alias("part"), "id", "embedding", "copies")
    else:
        points = members.join(lists, ["group", "id"], "left").select("group", "shard", "block", F.lit(0).alias("part"), "id", "embedding", "copies", "to")
    queries = members.filter("home").select(
        *(F.col(c).alias(c) for c in ("group", "shard")), every.alias("block"), (F.col("block") if exact else F.lit(0)).alias("part"),
        *(F.col(c).alias(c) for c in ("id", "embedding")))

    def find(key: tuple, p: pa.Table, q: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if p.num_rows and q.num_rows:
            p = p.sort_by("id")
            dim = len(p.column("embedding")[0])
            ids, q_ids = p.column("id").to_numpy(), q.column("id").to_numpy()
            x, y = unit(matrix(p.column("embedding"), dim)), unit(matrix(q.column("embedding"), dim))
            copies = p.column("copies").to_numpy()
            at = {int(i): k for k, i in enumerate(ids)}
            if not exact:
                adj = [np.array([at[j] for j in to or [] if j in at], int) for to in p.column("to").to_pylist()]
                entries = entry_points(x, adj)
            forest = Forest(len(ids))
            for a in range(0, len(y), 1024):
                if exact:
                    got = [np.flatnonzero(r) for r in y[a:a + 1024] @ x.T >= cosine - 1e-9]
                else:
                    start = [sorted({*entries, at.get(int(i), entries[0])}) for i in q_ids[a:a + 1024]]
                    got = range_search(x, adj, y[a:a + 1024], start, 2 - 2 * cosine + 1e-5, beam)
                for i, near in enumerate(got, a):
                    near = near[(x[near] @ y[i] >= cosine) & (ids[near] != q_ids[i])]
                    if len(near):
                        me = int(q_ids[i])
                        out.append((me, None, int(copies[near].sum()), len(near)))
                        out += [(me, int(j), None, None) for j in ids[forest.add(at.get(me), near)]]
        cols = list(zip(*out)) or [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["id", "to", "n_links", "n_near"])

    keys = ["group", "shard", "block", "part"]
    found = points.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(find, "id long, to long, n_links long, n_near long")
    found = materialise(found, "found")
    counts = found.filter("to is null").groupBy("id").agg(F.sum("n_links").alias("n_links"), F.sum("n_near").alias("n_near"))
    return counts, found.filter("to is not null").select("id", "to")


def brute_force_counts(nodes: DataFrame, cosine: float, sample: int, n: int) -> DataFrame:
    """(id, n_true) of about ``sample`` of ``n`` nodes: linked nodes among all."""
    share = F.pmod(F.xxhash64("id", F.lit("audit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = nodes.filter(share * n < sample).select("group", "id", "dim", "embedding").toArrow()
    names = np.array(rows.column("group").to_pylist(), object)
    by: dict[str, tuple] = {}
    for g in set(names):
        own = rows.take(pa.array(np.flatnonzero(names == g)))
        by[g] = own.column("id").to_numpy(), unit(matrix(own.column("embedding"), own.column("dim")[0].as_py()))
    sent = nodes.sparkSession.sparkContext.broadcast(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            groups, of = np.unique(np.array(b.column("group").to_pylist(), object), return_inverse=True)
            order, ends = np.argsort(of, kind="stable"), np.cumsum(np.bincount(of, minlength=len(groups)))
            for g, at in zip(groups, np.split(order, ends[:-1]) if len(groups) else []):
                ids, q = sent.value.get(g, ((), None))
                step = max(1, CELLS // max(len(ids), 1))
                for a in range(0, len(at) if len(ids) else 0, step):
                    part = at[a:a + step]
                    x = unit(matrix(b.column("embedding").take(pa.array(part)), q.shape[1]))
                    other = b.column("id").to_numpy()[part] != ids[:, None]
                    total[g] = total.get(g, 0) + ((q @ x.T >= cosine) & other).sum(1)
        for g, c in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(sent.value[g][0], pa.int64()), pa.array(c, pa.int64())], names=["id", "n_true"])

    return nodes.select("group", "id", "embedding").mapInArrow(run, "id long, n_true long").groupBy("id").agg(F.sum("n_true").alias("n_true"))


def _audit(nodes: DataFrame, cosine: float) -> tuple[DataFrame, bool, bool]:
    """(id, n_true) of the audited nodes that have links, whether these are
    enough to tell recall, and whether all nodes were audited."""
    n = nodes.count()
    for k in range(AUDITS):
        sample = AUDIT * 4**k
        true = materialise(brute_force_counts(nodes, cosine, sample, n).filter("n_true > 0"), "audit")
        enough = sample >= n or true.count() >= LINKED
        if enough:
            break
    return true, enough, sample >= n


def _recall(true: DataFrame, counts: DataFrame) -> float | None:
    """Mean share of their linked nodes that audited nodes found."""
    share = F.least(F.coalesce("n_near", F.lit(0)), F.col("n_true")) / F.col("n_true")
    return true.join(counts, "id", "left").agg(F.avg(share)).first()[0]


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, beam: int = 32, overlap: float | None = None, target: float = 0.98,
                    tries: int = 3) -> DataFrame:
    """(vec_id, n_links, component_id, kept, audit_recall) of every row of
    (vec_id, embedding, label)."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    nodes = _nodes(v)
    centroids = _centroids(nodes)
    true, enough, all_ = _audit(nodes, cosine)
    whole = (2 - 2 * cosine) ** 0.5 + 1e-6  # link distance: both ends of a link find each other
    members = width = None
    for k in range(tries + 1):
        exact = k == tries or not enough
        wide = whole if exact or overlap is None else min(whole, overlap * 2**k)
        if wide != width:
            members, width = materialise(_assign(nodes, centroids, wide), "members"), wide
        counts, forest = _search(members, cosine, beam * 2**k, exact)
        recall = _recall(true, counts)
        if recall is None and all_:
            recall = 1.0  # no node has a link
        if exact or recall >= target:
            break
    comp = connected_components(forest, "id", "to").withColumnRenamed("node", "id")
    full = (nodes.join(counts, "id", "left").join(comp, "id", "left")
            .select("label", "embedding", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")))
    out = v.withColumn("_ok", F.col("vec_id").isNotNull()).join(full.withColumn("_ok", F.lit(True)), ["label", "embedding", "_ok"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"), F.lit(recall).cast("double").alias("audit_recall"))
