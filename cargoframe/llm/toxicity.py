"""Toxicity by weak supervision.

1. Voters. Words and word beginnings that stand out in toxic labelled texts
   become lexicon and pattern voters; more voters look at how many of them a
   text holds, at a short fixed list of insults, at shouting and at exclamation
   marks. A voter says toxic, clean or nothing. The marks of the labels table
   choose the lexicon and say which way it leans; they are no voter, and the
   label model never sees them.
2. Label model. A generative model with a hidden label estimates, by EM on the
   votes alone, how often each voter says what under either label. Voters that
   stay correlated given the label become one factor, whose joint votes it
   estimates instead of a product. It gives each text a posterior label.
3. A linear (logistic) classifier is trained on the posterior labels over
   presence features and scores every whole text.

Labelled rows are read as a bounded sample: about ``per_class`` rows of either
class, by a hash of the id (all, where there are fewer). Counting runs in
Spark; only the mined features (at most ``keep``) and the sample's feature ids
reach the driver. Scoring covers every row.

Defined cases: labels other than 0 and 1 and NULL ids are left out, an id that
is labelled twice counts as toxic if either row says so; without labels of
both classes only the fixed list votes; NULL and empty texts get the
classifier's base score; repeated rows are scored each; other columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoframe.llm.common import Memo, arrow_map, give_back, held, materialise, slices
from cargoframe.llm.langid import sample_rows

_WORDS = re.compile(r"[^\W\d_]+")
# fixed values: seed lexicon
SEEDS = ("stupid", "idiot", "moron", "loser", "worthless", "pathetic", "disgusting", "scum", "trash", "clown")
STEMS = (4, 5, 6)  # lengths of word beginnings
LEAST = (2, 3, 5)
LINKED = 0.3       # correlation given the label from which voters share a factor
ALIKE = 0.9        # correlation of the votes themselves from which they share one from the start
FACTOR = 5         # voters of a factor at most
CLEAN = 10         # how many times the share of clean texts taken for toxic weighs that of toxic ones missed
ODDS = 4.0         # how many times as frequent in one class a mined feature is at least
_MEMO = 100_000


def parts_of(word: str) -> list[str]:
    """A word as features: itself, and its beginnings where it is longer."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


_NOTHING = ((), False)


class Features:
    """Feature ids of a text: the mined parts it holds, and how many of its
    words hold a toxic one (``LEAST``, after the parts)."""

    def __init__(self, index: dict[str, int], toxic: set[str]):
        def parts(word: str) -> tuple:
            ids = tuple(index[p] for p in parts_of(word) if p in index)
            return (ids, any(p in toxic for p in parts_of(word))) if ids else _NOTHING

        self.memo, self.first = Memo(parts, _MEMO), len(index)

    def of(self, text: str) -> list[int]:
        hits, n = set(), 0
        for (ids, toxic), c in ((self.memo[w], c) for w, c in Counter(_WORDS.findall(text.lower())).items()):
            if ids:
                hits.update(ids)
                n += c * toxic
        return sorted(hits) + [self.first + k for k, least in enumerate(LEAST) if n >= least]


def mine(sample: DataFrame, keep: int) -> list[tuple[str, int, bool]]:
    """Features that stand out in either class, strongest first: (feature,
    toxic contexts, whether it speaks for toxic). A word counts once for each distinct pair of neighbours that it
    has in a class, so copies of a text add nothing; a word beginning needs
    three words that lean the same way, beside those that stand out alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1 << 20)):
            rows = set()
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1)):
                w = ["", *_WORDS.findall((text.as_py() or "").lower()), ""]
                rows.update((w[i], xxhash.xxh64_intdigest(f"{w[i - 1]} {w[i + 1]}") - (1 << 63), toxic) for i in range(1, len(w) - 1))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32()))],
                                             names=["word", "near", "toxic"])
        give_back()

    rows = sample.select("toxic", "text").mapInArrow(count, "word string, near long, toxic int").distinct()
    words = materialise(rows.groupBy("word").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")), "words")
    n1, n0 = words.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    if not n1 or not n0:
        return []
    more = (F.col("pos") * n0 > F.col("neg") * n1).cast("int")
    own = _standing_out(words.withColumn("feature", F.col("word")), n1, n0)
    stems = (words.join(own.select(F.col("feature").alias("word")), "word", "left_anti")
             .select("pos", "neg", more.alias("more"), F.explode(F.array(*(
                 F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in STEMS))).alias("feature"))
             .filter("feature is not null").groupBy("feature")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("more").alias("more"), F.count("*").alias("n")))
    stems = _standing_out(stems, n1, n0).filter(F.when(F.col("up"), F.col("more")).otherwise(F.col("n") - F.col("more")) >= 3)
    cols = ["feature", "pos", "up", "chi"]
    return [(r["feature"], r["pos"], r["up"]) for r in
            own.select(cols).union(stems.select(cols)).orderBy(F.desc("chi"), "feature").limit(keep).collect()]


def _standing_out(counts: DataFrame, n1: int, n0: int) -> DataFrame:
    """Rows (feature, pos, neg, ...) whose class rates differ beyond chance, with chi and up (toxic)."""
    p1, p0 = F.col("pos") / n1, F.col("neg") / n0
    p = (F.col("pos") + F.col("neg")) / (n1 + n0)
    chi = F.pow(p1 - p0, 2) / (p * (1 - p) * (1 / n1 + 1 / n0) + 1e-18)
    rate = lambda k, n: ((F.col(k) - F.sqrt(k)) / n, (F.col(k) + F.sqrt(k) + 1) / n)  # noqa: E731  about one deviation down, up
    (low1, high1), (low0, high0) = rate("pos", n1), rate("neg", n0)
    up, down = low1 >= ODDS * high0, low0 >= ODDS * high1
    return counts.withColumn("chi", chi).withColumn("up", up).filter((F.col("chi") >= 30) & (up | down))


def votes_of(text: str, lex: list[str], lex_set: set[str]) -> list[int]:
    """Votes of the voters that look at one thing (1 toxic, 0 none), and last
    how many words of the lexicon the text holds (``count_voters``)."""
    words = Counter(_WORDS.findall(text.lower()))
    have = {p for w in words for p in parts_of(w)}
    hits = sum(c for w, c in words.items() if any(p in lex_set for p in parts_of(w)))
    seeds = sum(words[x] for x in SEEDS)
    letters, upper = sum(map(str.isalpha, text)), sum(map(str.isupper, text))
    return [*(int(x in have) for x in lex), int(seeds >= 1), int(upper > 0.5 * letters > 10), int(text.count("!") * 20 > len(text) > 0), hits]


def count_voters(hits: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Two voters on the number of lexicon words: toxic from ``k`` on and clean
    below, and toxic from ``2 k`` on; the marks choose k: the largest share of
    toxic texts at least k, less ``CLEAN`` times that of clean ones (ties: the
    smallest k)."""
    if len(set(toxic.tolist())) < 2:
        k = 1
    else:
        k = max(range(1, 9), key=lambda n: ((hits >= n)[toxic == 1].mean() - CLEAN * (hits >= n)[toxic == 0].mean(), -n))
    return np.stack([np.where(hits >= k, 1, -1), (hits >= 2 * k).astype(int)], 1)


def factors_of(left: np.ndarray, least: float) -> list[list[int]]:
    """Voters grouped by the correlations of the columns of ``left`` from
    ``least`` on, the strongest first, ``FACTOR`` to a group."""
    left = left - left.mean(0)
    sd = np.sqrt((left**2).mean(0)) + 1e-9
    corr = (left.T @ left) / len(left) / np.outer(sd, sd)
    group = {i: [i] for i in range(len(corr))}
    pairs = [(-corr[i, j], i, j) for i in range(len(corr)) for j in range(i) if corr[i, j] > least]
    for _, i, j in sorted(pairs):
        if group[i] is not group[j] and len(group[i]) + len(group[j]) <= FACTOR:
            group[i].extend(group[j])
            for x in group[j]:
                group[x] = group[i]
    return sorted(sorted(g) for g in {id(g): g for g in group.values()}.values())


def label_model(votes: np.ndarray, prior: float, rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Posterior P(toxic) per row of votes (1 toxic, -1 clean, 0 none), and the
    estimates: ``rates`` [voter, label, vote + 1] and ``factors`` (groups of
    voters with a joint distribution). A factor's joint votes are counted under
    either label and fall back on the product of its voters' rates where they
    are rare."""
    n, m = votes.shape
    if not n or not m:
        return np.full(n, prior), {"rates": np.full((m, 2, 3), 1 / 3), "factors": [[i] for i in range(m)]}
    said = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)  # n, m, 3
    factors = factors_of(votes.astype(float), ALIKE)  # voters that repeat each other have one say between them
    majority = sum(votes[:, f].mean(1) for f in factors)
    post = np.clip(0.5 + 0.45 * np.sign(majority), 0.02, 0.98)
    for k in range(rounds):
        y = np.stack([1 - post, post], 1)
        rates = np.einsum("ny,nmv->myv", y, said) + 0.5
        rates /= rates.sum(2, keepdims=True)
        if k == rounds // 3:  # what the label leaves unexplained becomes factors
            factors = factors_of(votes - y @ np.einsum("myv,v->ym", rates, np.array([-1.0, 0, 1])), LINKED)
        if k in (0, rounds // 3):
            patterns = [np.unique(votes[:, f], axis=0, return_inverse=True) for f in factors]
        z = np.full(n, np.log(prior / (1 - prior)))
        log = np.log(rates)
        for f, p in zip(factors, patterns):
            alone = np.einsum("nmv,myv->ny", said[:, f], log[f])
            if len(f) == 1:
                z += alone[:, 1] - alone[:, 0]
            else:
                which = p[1].reshape(-1)
                seen = np.stack([np.bincount(which, y[:, c], len(p[0])) for c in (0, 1)], 1)
                joint = np.log((seen[which] + 10 * np.exp(alone)) / (y.sum(0) + 10))
                z += joint[:, 1] - joint[:, 0]
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if np.abs(new - post).max() < 1e-6 and k > rounds // 3:
            break
        post = new
    return post, {"rates": rates, "factors": factors}


def logistic(ids: list[np.ndarray], target: np.ndarray, n_features: int, steps: int = 1500, ridge: float = 0.3) -> np.ndarray:
    """Weights [features, intercept] of a logistic model on presence features
    and soft targets (Adam on the whole sample); the penalty is that of ``ridge``
    texts, however large the sample."""
    l2 = ridge / max(1, len(ids))
    row = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    col = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
    w = np.zeros(n_features + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], len(ids)) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(ids)
        g = np.append(np.bincount(col, err[row], n_features), err.sum())
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 4000, keep: int = 3000, voters: int = 80) -> dict:
    """Classifier from documents (doc_id, text) and labels (doc_id, toxic)."""
    one = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ids = sample_rows(one, "toxic", per_class, "toxicity").select("doc_id", "toxic")
    sample = docs.join(F.broadcast(ids), "doc_id").select("toxic", "text")  # about 2 x per_class ids
    sample = materialise(sample, "toxic-sample")
    took = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    mined = mine(sample, keep)
    strong = [(a, f) for f, a, up in mined if up]
    names = [f for f, _, _ in mined]
    names += [s for s in SEEDS if s not in set(names)]
    index = {f: i for i, f in enumerate(names)}
    lex = [f for _, f in sorted(strong, key=lambda x: (-x[0], x[1]))[:voters]]
    lex_set = {f for _, f in strong} or set(SEEDS)

    def vote(cols: dict[str, pa.Array]) -> dict:
        texts = [t.as_py() or "" for t in cols["text"]]
        features = Features(index, lex_set)
        return {"toxic": cols["toxic"], "votes": [votes_of(t, lex, lex_set) for t in texts], "ids": [features.of(t) for t in texts]}

    got = arrow_map(sample.select("toxic", "text"), vote, "toxic int, votes array<int>, ids array<int>").toArrow()
    votes = np.array(got.column("votes").to_pylist(), np.int64).reshape(got.num_rows, -1 if got.num_rows else 1)
    votes = np.concatenate([count_voters(votes[:, -1], np.array(got.column("toxic").to_pylist(), int)), votes[:, :-1]], 1)
    prior = np.clip(1 / (1 + np.exp(-_logit(took.get(1, 0), took.get(0, 0)))), 0.02, 0.98)
    post, estimates = label_model(votes, prior)
    size = len(names) + len(LEAST)
    w = logistic([np.array(x, np.int64) for x in got.column("ids").to_pylist()], post, size) if got.num_rows else np.append(
        np.full(size, 3.0), -2.0)
    if got.num_rows:  # the sample takes more of the rarer class
        w[-1] += _logit(sizes.get(1, 0), sizes.get(0, 0)) - _logit(took.get(1, 0), took.get(0, 0))
    return {"index": index, "toxic": lex_set, "weights": w, "voters": [*lex], "estimates": estimates}


def _logit(a: int, b: int) -> float:
    return float(np.log((a + 0.5) / (b + 0.5)))


def score(docs: DataFrame, model: dict, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` and score of every row of ``docs`` (column text)."""
    sent = docs.sparkSession.sparkContext.broadcast((model["index"], model["toxic"], model["weights"]))  # at most keep features
    key = uuid.uuid4().hex

    def run(cols: dict[str, pa.Array]) -> dict:
        index, toxic, w = sent.value
        features = held(("toxicity", key), lambda: Features(index, toxic))
        z = np.array([w[features.of(t.as_py() or "")].sum() for t in cols["text"]]) + w[-1]
        return {c: cols[c] for c in keep} | {"score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return arrow_map(docs.select(*dict.fromkeys([*keep, "text"])), run, f"{fields}, score double")
