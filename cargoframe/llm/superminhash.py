"""Near-duplicate documents by SuperMinHash signatures.

1. Where a document is read, its words (ASCII lower case) become 64-bit
   shingle hashes, the distinct ones its set. SuperMinHash gives the
   signature: each element visits the positions in its own random order, and
   its rank there plus a random fraction competes for the minimum, so the
   values of an element are correlated and vary less than independent ones.
   An element stops as soon as its rank can no longer win anywhere.
2. Documents with equal sets form one class (no pairs among copies); one
   signature per class goes on.
3. Banding: classes that agree on all rows of a band meet in a bucket. Within
   a bucket a class is a candidate of the bucket's hub only, the class that
   meets most others anywhere; a class keeps the hub it meets in most bands.
4. Candidates are confirmed on the full sets, recomputed from the texts in
   groups of about ``BATCH`` texts beside one partner, and linked by
   union-find.
5. Classes that buckets connect form a family. In families that are still in
   several components, all classes outside the largest one are compared with
   the whole family on the full sets, block by block, so that no pair of a
   bucket is left out and none is emitted that isn't a link.

With 24 bands of 4 rows a pair at similarity 0.8 is missed with probability
4e-6.

Defined cases: NULL or wordless text has an empty set, links with nothing and
is kept; fewer words than a shingle are one shingle; rows that repeat a doc_id
count as one document of the graph; rows with NULL doc_id link with nothing,
have no component and are kept; other columns are ignored; empty tables give
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoframe.llm.common import Memo, arrow_map, connected_components, give_back, held, materialise

BANDS, ROWS = 24, 4
SIZE = BANDS * ROWS
BATCH = 256
BLOCK = 2048  # elements that a signature step handles at once
_GOLD, _M1, _M2 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Distinct 64-bit hashes of a text's ``k``-word shingles, sorted."""
    words = (text or "").encode().lower().split()  # bytes: ASCII case and white space
    if not words:
        return np.zeros(0, np.uint64)
    known = held("superminhash", lambda: Memo(xxhash.xxh64_intdigest, 50_000))
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(k, len(h)), np.uint64)
    for i in range(min(k, len(h))):
        out = mix(out * _GOLD + h[i:i + n])
    return np.unique(out)


def signature(elements: np.ndarray) -> np.ndarray:
    """SuperMinHash of a set: per position the least (rank << 32 | fraction)."""
    h = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), BLOCK):
        e = elements[at:at + BLOCK]
        order = rows = None
        for j in range(SIZE):
            if j << 32 > h.max():
                break
            r = mix(e + np.uint64((j + 1) * int(_GOLD) & (1 << 64) - 1))
            pick = ((r & np.uint64(0xFFFFFFFF)) * np.uint64(SIZE - j) >> np.uint64(32)).astype(np.int64) + j
            value = (r >> np.uint64(32)) | np.uint64(j << 32)
            if j == 0:
                first, where = pick, pick
            else:
                if order is None:  # the element's permutation, after its first exchange
                    rows = np.arange(len(e))
                    order = np.tile(np.arange(SIZE, dtype=np.uint8), (len(e), 1))
                    order[rows, first] = 0
                where = order[rows, pick].copy()
                order[rows, pick] = order[:, j]
            np.minimum.at(h, where, value)
    return h


def bands_of(sigs: np.ndarray) -> np.ndarray:
    """Band hashes [row, band] of signatures [row, position]."""
    s = mix(sigs.astype(np.uint64).reshape(-1, BANDS, ROWS) + np.arange(BANDS, dtype=np.uint64)[None, :, None] * _M1)
    out = s[:, :, 0]
    for i in range(1, ROWS):
        out = mix(out * _GOLD + s[:, :, i])
    return out.astype(np.int64)


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, sig) of every row."""
    def run(cols: dict[str, pa.Array]) -> dict:
        n, digest, sig = [], [], []
        for t in cols["text"]:
            s = shingles(t.as_py(), k)
            n.append(len(s))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sig.append(mix(signature(s)).astype(np.uint32).tobytes() if len(s) else None)
        return {"doc_id": cols["doc_id"], "n_shingles": n, "digest": digest, "sig": sig}

    return arrow_map(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), run,
                     "doc_id long, n_shingles long, digest binary, sig binary")


def band_rows(classes: DataFrame) -> DataFrame:
    """(band, bucket, id) of every class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, SIZE)
                keys = bands_of(sig).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(sig))), pa.array(keys),
                     pa.array(np.repeat(b.column("id").to_numpy(), BANDS))], names=["band", "bucket", "id"])
        give_back()

    return classes.select("id", "sig").mapInArrow(run, "band int, bucket long, id long")


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Pairs stand with their partner ``b``; a partner with many is dealt to
    several groups, each with its own copy of the partner's text.
    """
    n = pairs.groupBy("b").agg(F.count("*").alias("n"))
    dealt = (pairs.join(n, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / BATCH)).cast("int"))
             .select("a", "b", "part"))
    dealt = materialise(dealt, "pairs")
    one = dealt.join(texts.select(F.col("id").alias("a"), "text"), "a").select("b", "part", "a", "text")
    two = (dealt.select("b", "part").distinct().join(texts.select(F.col("id").alias("b"), "text"), "b")
           .select("b", "part", F.lit(None).cast("long").alias("a"), "text"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, txt = table.column("a").to_pylist(), table.column("text")
        at = ids.index(None)
        own = shingles(txt[at].as_py(), k)
        good = []
        for i, a in enumerate(ids):
            if a is not None:
                s = shingles(txt[i].as_py(), k)
                both = np.intersect1d(own, s, assume_unique=True).size
                if 100 * both >= percent * (own.size + s.size - both):
                    good.append(a)
        return pa.table({"a": pa.array(good, pa.int64()), "b": pa.array([key[0].as_py()] * len(good), pa.int64())})

    return one.union(two).groupBy("b", "part").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text):
    documents are linked if 100 * intersection >= percent * union."""
    sets = materialise(document_sets(docs, k), "sets")
    classes = (sets.filter("doc_id is not null and digest is not null").groupBy("digest")
               .agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")))
    classes = materialise(classes, "classes")
    rows = band_rows(classes)
    size = rows.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialise(rows.join(size, ["band", "bucket"]), "met")
    central = met.groupBy("id").agg(F.sum("n").alias("weight"))
    hubs = met.join(central, "id").groupBy("band", "bucket").agg(F.max(F.struct("weight", (-F.col("id")).alias("hub"))).alias("h"))
    stars = (met.join(hubs, ["band", "bucket"]).select("id", (-F.col("h.hub")).alias("hub"), "h.weight").filter("id != hub")
             .groupBy("id", "hub").agg(F.count("*").alias("n"), F.first("weight").alias("weight")))
    stars = materialise(stars, "stars")
    pairs = stars.groupBy("id").agg(F.max(F.struct("n", "weight", (-F.col("hub")).alias("hub"))).alias("h"))
    pairs = pairs.select(F.col("id").alias("a"), (-F.col("h.hub")).alias("b"))
    need = central.select("id").join(classes.select("id", "digest"), "id")
    found = docs.selectExpr("cast(doc_id as long) as id", "text").join(need, "id")
    texts = materialise(_one_text(found, k), "texts")
    good = materialise(confirm(pairs, texts, k, percent), "links")
    first = materialise(connected_components(good, "a", "b").withColumnRenamed("node", "id"), "components")

    family = connected_components(stars, "id", "hub").select(F.col("node").alias("id"), F.col("component").alias("family"))
    placed = family.join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    more = _compare_apart(materialise(placed, "families"), texts, k, percent)
    stars = first.select(F.col("id").alias("a"), F.col("component").alias("b"))
    comp = connected_components(stars.union(more).union(_same_id(sets, classes)), "a", "b")

    classed = sets.join(classes.select("digest", "id"), "digest", "left")
    out = classed.join(comp.withColumnRenamed("node", "id"), "id", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _same_id(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that repeat a doc_id."""
    return (sets.filter("doc_id is not null and digest is not null").join(classes.select("digest", "id"), "digest")
            .filter("id != doc_id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
            .join(classes.select(F.col("id").alias("a")), "a", "left_semi").distinct())


def _one_text(found: DataFrame, k: int) -> DataFrame:
    """(id, text): of the rows with a class's id, those with its set (rows
    that repeat a document stay; they only confirm its links again)."""
    def run(cols: dict[str, pa.Array]) -> dict:
        keep = [hashlib.blake2b(shingles(t.as_py(), k).tobytes(), digest_size=16).digest() == d.as_py() for t, d in zip(cols["text"], cols["digest"])]
        mask = pa.array(keep, pa.bool_())
        return {"id": cols["id"].filter(mask), "text": cols["text"].filter(mask)}

    return arrow_map(found.select("id", "text", "digest"), run, "id long, text string")


def _compare_apart(placed: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between different components of a family (documents that
    buckets connect), from rows (id, family, component).

    All documents outside a family's largest component are compared with the
    whole family on the full sets, a block of one against a block of the
    other; only links come back."""
    size = placed.groupBy("family", "component").agg(F.count("*").alias("n"))
    size = size.groupBy("family").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("parts")).filter("parts > 1")
    size = size.select("family", F.col("top.component").alias("main"), F.ceil((F.col("n") - F.col("top.n")) / BATCH).cast("int").alias("xs"),
                       F.ceil(F.col("n") / (8 * BATCH)).cast("int").alias("ys"))
    rows = materialise(placed.join(size, "family").join(texts, "id"), "apart")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    out = rows.filter("component != main").select("family", block("xs").alias("x"), every("ys").alias("y"), "id", "component", "text")
    all_ = rows.select(F.col("family").alias("family"), every("xs").alias("x"), block("ys").alias("y"), F.col("id").alias("id"),
                       F.col("component").alias("component"), F.col("text").alias("text"))

    def run(key: tuple, one: pa.Table, other: pa.Table) -> pa.Table:
        pairs = []
        if one.num_rows and other.num_rows:
            ids, comp = one.column("id").to_numpy(), one.column("component").to_numpy()
            own = [shingles(t.as_py(), k) for t in one.column("text")]
            sizes = np.array([len(o) for o in own])
            flat, owner = np.concatenate(own), np.repeat(np.arange(len(own)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for i, c, t in zip(other.column("id").to_pylist(), other.column("component").to_pylist(), other.column("text")):
                s = shingles(t.as_py(), k)
                left, right = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
                n = right - left
                at = np.repeat(right - np.cumsum(n), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(own))
                hit = (100 * both >= percent * (sizes + len(s) - both)) & (comp != c)
                pairs += [(int(j), i) for j in ids[hit]]
        return pa.table([pa.array([p[x] for p in pairs], pa.int64()) for x in (0, 1)], names=["a", "b"])

    keys = ["family", "x", "y"]
    return out.groupBy(*keys).cogroup(all_.groupBy(*keys)).applyInArrow(run, "a long, b long")
