import numpy as np

from cargoframe.operators import knn as K


def test_blocked_knn_is_exact(spark):
    rng = np.random.default_rng(7)
    q = rng.normal(size=(40, 8))
    kb = rng.normal(size=(300, 8))
    kb[5] = kb[4]  # a tie: the smaller id must win
    qdf = spark.createDataFrame([(i, int(i % 2), q[i].tolist()) for i in range(40)], "qid long, ns int, embedding array<double>")
    kdf = spark.createDataFrame([(1000 + j, int(j % 2), kb[j].tolist()) for j in range(300)],
                                "kid long, ns int, embedding array<double>")
    got = K.knn(qdf, kdf, ["ns"], "qid", "kid", k=5, block_size=16).collect()  # many blocks per namespace
    res = {}
    for r in got:
        res.setdefault(r.q_id, []).append((r.rank, r.k_id))
    qn = q / np.linalg.norm(q, axis=1, keepdims=True)
    kn = kb / np.linalg.norm(kb, axis=1, keepdims=True)
    for i in range(40):
        idx = [j for j in range(300) if j % 2 == i % 2]
        s = kn[idx] @ qn[i]
        order = sorted(range(len(idx)), key=lambda t: (-s[t], idx[t]))[:5]
        assert [k for _, k in sorted(res[i])] == [1000 + idx[t] for t in order]


def test_kb_upsert_idempotent(spark):
    base = spark.createDataFrame([("a", "x", 0), ("b", "y", 0)], "id string, v string, version long")
    upd = spark.createDataFrame([("b", "z", 1), ("c", "w", 1)], "id string, v string, version long")
    once = K.kb_upsert(base, upd)
    twice = K.kb_upsert(once, upd)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == \
        [("a", "x", 0), ("b", "z", 1), ("c", "w", 1)]


def test_embed_with_user_model(spark):
    df = spark.createDataFrame([("ab",), ("ba",), ("zz",)], "t string")

    def model(texts):  # character counts over a tiny alphabet
        return [[t.count(c) for c in "abz"] for t in texts]
    out = {r.t: r.embedding for r in K.embed_with(df, "t", model).collect()}
    assert out == {"ab": [1.0, 1.0, 0.0], "ba": [1.0, 1.0, 0.0], "zz": [0.0, 0.0, 2.0]}


def test_write_back_uses_the_mean(spark):
    rows = [(1, "A", "x", 0.9, "vector"), (1, "B", "y", 0.5, "vector_low_similarity"), (2, "A", "x", 0.4, "vector"), (2, "B", "None", 0.2, "vector"),
            (3, "A", "z", 0.0, "llm"), (4, None, None, 0.0, "no_schema")]
    df = spark.createDataFrame(rows, "q_id long, attr string, value string, score double, method string")
    assert sorted((r.q_id, r.attr) for r in K.write_back(df, 0.6).collect()) == [(1, "A"), (1, "B"), (3, "A")]


def test_kb_ties_are_settled(spark):
    rows = [("a", v, 1) for v in "pqr"]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id string, v string, version long")
        assert [tuple(r) for r in K.kb_upsert(df.limit(0), df).collect()] == [("a", "r", 1)]


def test_token_jaccard(spark):
    df = spark.createDataFrame([("Red widget, red", "RED bolt"), ("", "")], "a string, b string")
    assert [round(r[0], 6) for r in df.select(K.token_jaccard("a", "b")).collect()] == [round(1 / 3, 6), 0.0]


def _brute(q, kb, k):
    """{(ns, q_id): [k_id]} over rows (id, ns, vector)."""
    out = {}
    for i, ns, v in q:
        rows = [(-float((np.array(v) / np.linalg.norm(v)) @ (np.array(x) / np.linalg.norm(x))), j) for j, m, x in kb if m == ns and len(x) == len(v)]
        if rows:
            out[ns, i] = [j for _, j in sorted((round(s, 12), j) for s, j in rows)[:k]]
    return out


def _frames(spark, q, kb):
    t = "long, ns int, embedding array<double>"
    return spark.createDataFrame(q, f"qid {t}"), spark.createDataFrame(kb, f"kid {t}")


def _lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault((r.ns, r.q_id), []).append(r.k_id)
    return out


def test_clusters_are_pruned_and_the_answer_stays_exact(spark):
    rng = np.random.default_rng(11)
    centre = rng.normal(size=(40, 16)) * 3
    near = lambda n: (centre[rng.integers(0, 40, n)] + rng.normal(size=(n, 16)) * 0.1).tolist()
    kb = [(1000 + i, i % 3 // 2, v) for i, v in enumerate(near(3000))]   # one namespace holds two thirds
    kb += [(9000 + i, 0, kb[0][2]) for i in range(300)]                  # copies: ties by id
    q = [(i, i % 3 // 2, v) for i, v in enumerate(near(150))] + [(500, 0, kb[0][2]), (0, 1, kb[5][2])]  # id 0 in two namespaces
    qdf, kdf = _frames(spark, q, kb)
    args = dict(k=5, block_size=100, cluster_size=60)
    assert _lists(K.knn(qdf, kdf, ["ns"], "qid", "kid", **args)) == _brute(q, kb, 5)
    work = {r.ns: r.share_kept for r in K.knn_work(qdf, kdf, ["ns"], "qid", "kid", **args).collect()}
    assert set(work) == {0, 1} and all(share < 0.25 for share in work.values()), work


def test_random_vectors_stay_exact_with_clusters(spark):
    rng = np.random.default_rng(12)
    q = [(i, 0, rng.normal(size=6).tolist()) for i in range(60)]
    kb = [(i, 0, rng.normal(size=6).tolist()) for i in range(800)]
    assert _lists(K.knn(*_frames(spark, q, kb), ["ns"], "qid", "kid", k=7, block_size=64, cluster_size=50)) == _brute(q, kb, 7)


def test_vectors_that_cannot_be_compared(spark):
    nan, inf = float("nan"), float("inf")
    q = [(1, 0, [1.0, 0.0]), (2, 0, None), (3, 0, [nan, 1.0]), (4, 0, [0.0, 0.0]), (5, 0, [1.0, 0.0, 0.0]), (6, None, [1.0, 0.0]), (None, 0, [1.0, 0.0])]
    kb = [(1, 0, [0.5, 0.1]), (2, 0, None), (3, 0, [None, 1.0]), (4, 0, []), (5, 0, [inf, 1.0]), (6, 0, [0.0, 0.0]), (7, 0, [1.0, 1.0, 1.0]), (8, 0, [0.0, 2.0])]
    assert _lists(K.knn(*_frames(spark, q, kb), ["ns"], "qid", "kid", k=3)) == {(0, 1): [1, 8], (0, 5): [7]}
    qdf, kdf = _frames(spark, q, kb)
    assert K.knn(qdf, kdf.limit(0), ["ns"], "qid", "kid").count() == 0
    assert K.knn(qdf.limit(0), kdf, ["ns"], "qid", "kid").count() == 0
