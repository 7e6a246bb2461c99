"""op2, op4: brute force over the small tables and odd rows."""
import math

import numpy as np
import pytest

from cargoframe.llm import common, flat_graph, topk_search
from cargoframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN = float("nan")


def linked(rows, cosine=0.98):
    """{vec_id: (links, component)} of rows (vec_id, vector, label) by brute force."""
    ok = {i: (np.array(v, float), lab) for i, v, lab in rows
          if v and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    root = {i: i for i, _, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    n = dict.fromkeys(root, 0)
    for a, (va, la) in ok.items():
        for b, (vb, lb) in ok.items():
            if a != b and la == lb and len(va) == len(vb) and va @ vb / math.sqrt(va @ va) / math.sqrt(vb @ vb) >= cosine:
                n[a] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (n[i], find(i)) for i in root}


def test_flat_graph_odd_rows(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(size=8) * 0.05).tolist(), 1) for i in range(40)]
    rows += [(100 + i, rng.normal(size=8).tolist(), i % 2) for i in range(30)]
    rows += [(200, base.tolist(), 1), (201, base.tolist(), 1), (202, (3 * base).tolist(), 1), (203, base.tolist(), 2), (204, base.tolist(), None),
             (205, None, 1), (206, [0.0] * 8, 1), (207, [NAN] + [1.0] * 7, 1), (208, [None] + [1.0] * 7, 1), (209, [], 1), (210, [1.0, 2.0], 1),
             (211, [float("inf")] * 8, 1)]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>, label int, id long, copies long")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in flat_graph.near_duplicates(df).collect()}
    assert got == linked(rows)
    assert flat_graph.near_duplicates(df.limit(0)).count() == 0


def test_flat_graph_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1)]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in flat_graph.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)], key=str)


def test_graph_search_finds_dense_groups_and_shards(spark, monkeypatch):
    """Many shards and blocks: recall stays above the contract's."""
    for name, v in (("SHARD", 60), ("BLOCK", 100), ("SAMPLE", 300), ("AUDIT", 50)):
        monkeypatch.setattr(flat_graph, name, v)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(120, 16))
    rows = [(i, (centre[i % 120] + rng.normal(size=16) * 0.06 * (i % 3)).tolist(), 0) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = flat_graph.near_duplicates(df).collect()
    want = linked(rows)
    found, true = sum(r["n_links"] for r in got), sum(n for n, _ in want.values())
    assert 0.98 * true <= found <= true and got[0]["audit_recall"] >= 0.9
    assert sum(want[r["vec_id"]][1] == r["component_id"] for r in got) >= 0.98 * len(got)


def all_links(x, cosine=0.98):
    """{row: number of other rows linked with it} by one matrix product."""
    x = flat_graph.unit(np.asarray(x, float))
    return dict(enumerate(((x @ x.T >= cosine).sum(1) - 1).tolist()))


def as_vectors(spark, x, label=0):
    return spark.createDataFrame([(i, v.tolist(), label) for i, v in enumerate(np.asarray(x, float))], "vec_id long, embedding array<double>, label int")


def test_tight_groups_are_found_in_other_blocks(spark, monkeypatch):
    """Six groups of 150 distinct vectors in two blocks: groups with more
    members in a block than NEAREST have no edge to one another."""
    monkeypatch.setattr(flat_graph, "BLOCK", 450)
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(6, 16))[:, None] + rng.normal(size=(6, 150, 16)) * 0.02).reshape(-1, 16)
    nodes = flat_graph._nodes(as_vectors(spark, x))
    counts, forest = flat_graph._search(flat_graph._assign(nodes, {}, 0.1), 0.98, 32)
    assert {r["id"]: r["n_links"] for r in counts.collect()} == all_links(x)
    assert len({r["component"] for r in flat_graph.connected_components(forest, "id", "to").collect()}) == 6


def test_entry_points_reach_every_node():
    adj = [np.array(a, int) for a in ([1], [0], [3], [2], [2], [])]
    got = flat_graph.entry_points(flat_graph.unit(np.random.default_rng(6).normal(size=(6, 4))), adj)
    reached, todo = set(), list(got)
    while todo:
        i = todo.pop()
        if i not in reached:
            reached.add(i)
            todo += adj[i].tolist()
    assert reached == set(range(6))


@pytest.fixture
def finds_nothing(monkeypatch):
    monkeypatch.setattr(flat_graph, "range_search", lambda x, adj, q, *_: [np.zeros(0, int)] * len(q))


def test_a_failed_search_ends_exactly(spark, monkeypatch, finds_nothing):
    """Links stay whole if the greedy search finds nothing; in shards and blocks."""
    for name, v in (("SHARD", 60), ("BLOCK", 50), ("SAMPLE", 300)):
        monkeypatch.setattr(flat_graph, name, v)
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(30, 8))
    x = [centre[i % 30] + rng.normal(size=8) * 0.06 * (i % 3) for i in range(300)]
    want = linked([(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = flat_graph.near_duplicates(as_vectors(spark, x), tries=1).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert {r["audit_recall"] for r in got} == {1.0}


def test_rare_links_are_no_evidence(spark, monkeypatch, finds_nothing):
    """Three links among 1500 nodes: an audit without linked nodes passes nothing."""
    monkeypatch.setattr(flat_graph, "AUDIT", 1)
    x = np.random.default_rng(8).normal(size=(1500, 24))
    x[:3] = x[100:103] + 0.001
    got = flat_graph.near_duplicates(as_vectors(spark, x)).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == all_links(x) and sum(r["n_links"] for r in got) == 6
    assert got[0]["audit_recall"] in (None, 1.0)
    monkeypatch.setattr(flat_graph, "AUDIT", 200)
    few = flat_graph.near_duplicates(as_vectors(spark, x[200:300])).collect()  # all audited, no links
    assert {(r["n_links"], r["audit_recall"]) for r in few} == {(0, 1.0)}


def test_recall_weighs_nodes_equally(spark):
    true = spark.createDataFrame([(1, 1000), (2, 1), (3, 2), (4, 4)], "id long, n_true long")
    counts = spark.createDataFrame([(1, 10**6, 1000), (3, 900, 1)], "id long, n_links long, n_near long")
    assert flat_graph._recall(true, counts) == (1 + 0 + 0.5 + 0) / 4
    assert flat_graph._recall(true.limit(0), counts) is None


def test_links_across_shard_borders_count_on_both_sides(spark, monkeypatch):
    """A cloud in many shards, searched whole in each: all counts are right
    though the target would accept half of them."""
    for name, v in (("SHARD", 60), ("SAMPLE", 300)):
        monkeypatch.setattr(flat_graph, name, v)
    x = np.random.default_rng(9).normal(size=(500, 4))
    got = flat_graph.near_duplicates(as_vectors(spark, x), beam=500, target=0.5).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == all_links(x)


def test_robust_pruning_keeps_the_nearest():
    x = flat_graph.unit(np.random.default_rng(2).normal(size=(50, 6)))
    adj = flat_graph.build_graph(x)
    d = x @ x.T - 2 * np.eye(50)
    assert (adj[:, 0] == d.argmax(1)).all()
    assert flat_graph.build_graph(x[:1]).max() == -1


def brute_top(rows, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in sorted(ok, reverse=True):
        if i % 20 == 0:  # the smallest vector of an id stays
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
            out[i] = [(j, -x) for x, j in s]
    return out


def run_top(spark, rows, k=20):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, dim int").filter(common.is_finite("embedding"))
    from pyspark.sql import functions as F
    v = df.select("vec_id", "dim", F.transform("embedding", lambda x: F.floor(64 * x).cast("long")).alias("vec"))
    out = {}
    for r in sorted(topk_search.top_k(v, F.col("vec_id") % 20 == 0, k).collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_top_k_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(70)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(200, None), (201, [None] * 24), (202, [NAN] * 24), (220, [0.0] * 24), (240, [1.0, 2.0]), (241, [1.0, 3.0]), (None, rows[0][1]), (260, []), (0, rows[0][1])]
    want = {i: v for i, v in brute_top(rows, 20).items() if v}
    assert run_top(spark, rows) == want
    assert run_top(spark, rows[:0]) == {}


def test_top_k_blocks(spark, monkeypatch):
    for name, v in (("CANDIDATES", 40), ("QUERIES", 3), ("SAMPLE", 60), ("CELLS", 8)):
        monkeypatch.setattr(topk_search, name, v)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=32) + (i % 5) * 2).tolist()) for i in range(300)]
    assert run_top(spark, rows, 7) == brute_top(rows, 7)


def test_bounds_prune_clusters_and_scores_stay_exact():
    """At least nine tenths of the pairs drop out before an exact score."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(50, 64)) * 60
    make = lambda n: np.floor(centre[rng.integers(0, 50, n)] + rng.normal(size=(n, 64)) * 6).astype(np.int64)
    x, q = make(4000), make(200)
    ids, q_id = np.arange(4000), 10_000 + np.arange(200)
    got, left = topk_search.search_block(q, q_id, np.full(200, np.iinfo(np.int64).min), x, ids, 20)
    floor = np.array([s[-1] for _, s in got])
    got, left = topk_search.search_block(q, q_id, floor, x, ids, 20)
    assert left["scored"] <= 0.1 * left["pairs"] and left[4] >= left[16] >= left[32] >= left[48] == left["scored"]
    exact = q @ x.T
    for i, (found, s) in enumerate(got):
        best = np.lexsort((ids, -exact[i]))[:20]
        assert found.tolist() == ids[best].tolist() and s.tolist() == exact[i][best].tolist()


def test_random_vectors_are_pruned_on_the_last_level():
    rng = np.random.default_rng(6)
    unit = lambda n: (lambda z: np.floor(64 * z / np.linalg.norm(z, axis=1, keepdims=True)).astype(np.int64))(rng.normal(size=(n, 64)))
    x, q = unit(4000), unit(100)
    floor = np.sort(q @ x.T, axis=1)[:, -20]
    _, left = topk_search.search_block(q, 10_000 + np.arange(100), floor, x, np.arange(4000), 20)
    assert left["scored"] < 0.2 * left["pairs"] and left[16] > 0.95 * left["pairs"]


def test_scores_beyond_doubles_are_whole_numbers():
    q, x = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, 5], [2**62, 2**62]])
    want = [(2**40 + 1) * (2**20 + 1) + 15, 2**63 - 1]
    assert topk_search.exact_scores(np.repeat(q, 2, axis=0), x).tolist() == want and topk_search.all_scores(q, x).tolist() == [want]


@pytest.mark.parametrize("segments", [1, 4, 16])
def test_segment_bounds_hold(segments):
    rng = np.random.default_rng(segments)
    a, b = rng.normal(size=(20, 30)), rng.normal(size=(25, 30))
    assert (topk_search.segment_statistics(a, segments) @ topk_search.segment_statistics(b, segments).T >= a @ b.T - 1e-9).all()
