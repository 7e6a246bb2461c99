"""Removal of long byte strings that occur more than once in a corpus.

Every byte covered by a string of ``length`` bytes that also starts somewhere
else (any document, or another place of the same one) is removed.

1. Prefilter, exact. Each window of ``length`` bytes is represented by its
   least hashed gram of ``GRAM`` bytes, so equal windows have equal
   representatives. A maximal run of windows with one representative is a
   *stretch*. Counting representatives over the corpus leaves only stretches
   whose representative occurs elsewhere.
2. Stretches with equal bytes are one kind; a kind that occurs twice is
   repeated as a whole and needs no comparison.
3. The other kinds of a representative are compared by a logarithmic family of
   suffix arrays: kinds arrive in batches; a batch's windows are sorted into a
   suffix array, merge-scanned against every level for equal windows, and
   becomes a level; two levels of equal size merge into one of twice the size.
   A family is bounded: the windows of a representative with more than
   ``KINDS`` kinds (the edge of a passage that very many texts share) are
   dealt out by a 128-bit hash and counted instead.
4. The repeated intervals go back to their documents, which are cut.

Texts are shuffled once, by a 128-bit digest of doc_id and text, which stands
for the document in all steps. No group is collected beyond the distinct
intervals of one text, however many rows repeat it.

Defined cases: NULL text is empty; texts shorter than ``length`` lose nothing;
rows that repeat a doc_id are told apart by their texts, and equal rows are
repeats of one another; rows with NULL doc_id take part like others; other
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoframe.llm.common import arrow_map, give_back, materialise

GRAM = 32
CHUNK = 1 << 16      # windows that one step over a text handles
BATCH = 4096         # windows of a suffix array batch
KINDS = 2048         # kinds of one representative that a family takes
_POS = np.uint64((1 << 17) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``GRAM`` bytes from each position on."""
    h = _mix((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    m, s = 0xD6E8FEB86659FD93, 1
    while s < GRAM:
        h = h[:-s] * np.uint64(m) + h[s:]
        m, s = m * m % (1 << 64), s * 2
    return _mix(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    s = 1
    while 2 * s <= width:
        x = np.minimum(x[:-s], x[s:])
        s *= 2
    return np.minimum(x[:s - width], x[width - s:]) if s < width else x


def stretches(text: bytes, length: int) -> Iterator[tuple[int, int, int, bool]]:
    """(representative, start, windows, whether it holds its representative
    more than once) in reading order."""
    total = len(text) - length + 1
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(total, 0), CHUNK):
        n = min(CHUNK, total - at)
        g = gram_hashes(data[at:at + n + length - 1])
        pos = (sliding_min((g & ~_POS) | np.arange(len(g), dtype=np.uint64), length - GRAM + 1) & _POS).astype(np.int64)
        rep = g[pos].astype(np.int64)
        first = np.append(0, np.flatnonzero(rep[1:] != rep[:-1]) + 1)
        last = np.append(first[1:], n) - 1
        twice = pos[first] != pos[last]
        yield from zip(rep[first].tolist(), (first + at).tolist(), (last - first + 1).tolist(), twice.tolist())


class Family:
    """Logarithmic family of suffix arrays over the windows of one group."""

    def __init__(self, length: int):
        self.length, self.levels, self.waiting, self.held = length, {}, [], 0
        self.repeated: list[np.ndarray] = []  # per string: its windows that occur elsewhere

    def add(self, text: bytes) -> None:
        n = len(text) - self.length + 1
        self.repeated.append(np.zeros(n, bool))
        windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), self.length)
        for a in range(0, n, BATCH):
            part = np.arange(a, min(n, a + BATCH))
            self.waiting.append((np.ascontiguousarray(windows[part]).view(f"S{self.length}").ravel(), len(self.repeated) - 1, part))
            self.held += len(part)
            if self.held >= BATCH:
                self.flush()

    def mark(self, owner: np.ndarray, at: np.ndarray) -> None:
        for o in np.unique(owner):
            self.repeated[o][at[owner == o]] = True

    def flush(self) -> None:
        if not self.waiting:
            return
        keys = np.concatenate([w[0] for w in self.waiting])
        owner = np.concatenate([np.full(len(w[2]), w[1]) for w in self.waiting])
        at = np.concatenate([w[2] for w in self.waiting])
        self.waiting, self.held = [], 0
        order = np.argsort(keys, kind="stable")  # the batch's suffix array
        keys, owner, at = keys[order], owner[order], at[order]
        same = keys[1:] == keys[:-1]
        twin = np.append(same, False) | np.append(False, same)
        self.mark(owner[twin], at[twin])
        level = tuple(x[np.append(True, ~same)] for x in (keys, owner, at))
        for other in self.levels.values():  # merge scan
            place = np.searchsorted(other[0], level[0])
            hit = place < len(other[0])
            hit[hit] = other[0][place[hit]] == level[0][hit]
            self.mark(level[1][hit], level[2][hit])
            self.mark(other[1][place[hit]], other[2][place[hit]])
            if hit.any():
                level = tuple(x[~hit] for x in level)  # each window stands in one level
        size = 1
        while size in self.levels:
            other = self.levels.pop(size)
            place = np.searchsorted(other[0], level[0])
            level = tuple(np.insert(o, place, x) for o, x in zip(other, level))
            size *= 2
        self.levels[size] = level

    def ranges(self) -> list[list[tuple[int, int]]]:
        """Per string: maximal runs (first, last) of repeated windows."""
        self.flush()
        out = []
        for r in self.repeated:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], r.view(np.int8), [0]))))
            out.append(list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())))
        return out


def _stretch_rows(keyed: DataFrame, length: int) -> DataFrame:
    def run(cols: dict[str, pa.Array]) -> dict:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for key, t in zip(cols["key"].to_pylist(), cols["text"]):
            text = t.as_py().encode()
            for rep, start, n, twice in stretches(text, length):
                digest = xxhash.xxh3_64_intdigest(text[start:start + n + length - 1]) - (1 << 63)
                for o, v in zip(out, (rep, digest, key, start, n, twice)):
                    o.append(v)
        return dict(zip(("rep", "digest", "key", "start", "n", "twice"), out))

    return arrow_map(keyed, run, "rep long, digest long, key binary, start int, n int, twice boolean")


def _kind_bytes(kinds: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(rep, digest, bytes) of kinds, cut from the texts where they stand."""
    by_key = kinds.groupBy("key").agg(F.collect_list(F.struct("rep", "digest", "start", "n")).alias("want"))
    # all columns of texts go along: its shuffle is then the one that the last join reads as well
    cut = by_key.join(texts, F.col("key") == F.col("_key")).select("want", *texts.columns)
    given: set[bytes] = set()  # keys of a task: rows that repeat one give its kinds once

    def run(cols: dict[str, pa.Array]) -> dict:
        out: tuple[list, ...] = ([], [], [])
        for key, want, t in zip(cols["_key"].to_pylist(), cols["want"], cols["_text"]):
            if key in given:
                continue
            given.add(key)
            text = t.as_py().encode()
            for w in want.as_py():
                for o, v in zip(out, (w["rep"], w["digest"], text[w["start"]:w["start"] + w["n"] + length - 1])):
                    o.append(v)
        return dict(zip(("rep", "digest", "bytes"), out))

    return arrow_map(cut, run, "rep long, digest long, bytes binary")


_RUNS = "rep long, digest long, first int, last int"


def _compare(kinds: DataFrame, length: int) -> DataFrame:
    """(rep, digest, first, last): runs of windows that other kinds of a
    representative hold too; its rows stand together."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, digests, family = None, [], None

        def results() -> list[tuple]:
            return [(group, d, a, z) for d, runs in zip(digests, family.ranges()) for a, z in runs] if family else []

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["rep", "digest", "first", "last"])

        for b in batches:
            rows = []
            for rep, digest, data in zip(*(b.column(c).to_pylist() for c in range(3))):
                if rep != group:
                    rows += results()
                    group, digests, family = rep, [], Family(length)
                digests.append(digest)
                family.add(data)
            yield batch(rows)
        yield batch(results())
        give_back()

    return kinds.mapInArrow(run, _RUNS)


def _count_windows(kinds: DataFrame, length: int) -> DataFrame:
    """The same for representatives with too many kinds for one task: their
    windows are dealt out and counted by a 128-bit hash of their bytes."""
    def run(cols: dict[str, pa.Array]) -> dict:
        out: tuple[list, ...] = ([], [], [], [])
        for rep, digest, data in zip(*(cols[c].to_pylist() for c in ("rep", "digest", "bytes"))):
            for i in range(len(data) - length + 1):
                for o, v in zip(out, (rep, digest, i, xxhash.xxh3_128_digest(data[i:i + length]))):
                    o.append(v)
        return dict(zip(("rep", "digest", "at", "window"), out))

    windows = arrow_map(kinds, run, "rep long, digest long, at int, window binary")
    again = windows.groupBy("window").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("window").alias("again"))
    return windows.join(again, F.col("window") == F.col("again"), "left_semi").select("rep", "digest", F.col("at").alias("first"), F.col("at").alias("last"))


def repeated_spans(docs: DataFrame, length: int, fn: Callable[[bytes, list[tuple[int, int]]], dict], schema: str,
                   keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``fn(text bytes, removed runs)`` of every row of
    ``docs``; runs are maximal, disjoint and in reading order."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit("/"), F.coalesce("text", F.lit("")))
    texts = docs.select(F.unhex(F.md5(named.cast("binary"))).alias("_key"),
                        *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), F.coalesce("text", F.lit("")).alias("_text"))
    spans = materialise(_stretch_rows(texts.select(F.col("_key").alias("key"), F.col("_text").alias("text"))
                                      .filter(F.octet_length("text") >= length), length), "stretches")
    again = spans.groupBy("rep").agg(F.count("*").alias("c"), F.max("twice").alias("t")).filter("c > 1 or t").select("rep")
    marked = materialise(spans.join(again, "rep"), "marked")
    kinds = marked.groupBy("rep", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "start", "n")).alias("at"), F.max("twice").alias("twice"))
    kinds = kinds.join(kinds.groupBy("rep").agg(F.count("*").alias("kinds")), "rep")
    kinds = materialise(kinds.select("rep", "digest", "copies", "at.*", "twice", "kinds"), "kinds")

    open_ = kinds.filter((F.col("kinds") > 1) | ((F.col("copies") == 1) & F.col("twice")))
    few = _kind_bytes(open_.filter(F.col("kinds") <= KINDS), texts, length).repartition("rep").sortWithinPartitions("rep")
    many = _kind_bytes(open_.filter(F.col("kinds") > KINDS), texts, length)
    part = _compare(few, length).union(_count_windows(many, length)).join(kinds.filter("copies = 1").select("rep", "digest"), ["rep", "digest"])
    whole = kinds.filter("copies > 1").select("rep", "digest", F.lit(0).alias("first"), (F.col("n") - 1).alias("last"))
    hits = marked.join(whole.union(part), ["rep", "digest"]).select(
        "key", F.struct((F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last") + length).alias("z")).alias("run"))
    runs = hits.groupBy("key").agg(F.collect_set("run").alias("runs"))  # distinct before the shuffle
    done = texts.join(runs, F.col("key") == F.col("_key"), "left")

    def finish(cols: dict[str, pa.Array]) -> dict:
        got = [fn(t.as_py().encode(), merge(r)) for t, r in zip(cols["_text"], cols["runs"].to_pylist())]
        return {c: cols[f"_k{i}"] for i, c in enumerate(keep)} | {n: [g[n] for g in got] for n in names}

    from pyspark.sql.types import StructType
    names = StructType.fromDDL(schema).names
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return arrow_map(done.select(*(f"_k{i}" for i in range(len(keep))), "_text", "runs"), finish, f"{fields}, {schema}")


def merge(runs: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by the given ones."""
    out: list[tuple[int, int]] = []
    for a, z in sorted((r["a"], r["z"]) for r in runs or []):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(z, out[-1][1])
        else:
            out.append((a, z))
    return out


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(z for _, z in runs)]
    return b"".join(text[a:z] for a, z in zip(ends, [*(a for a, _ in runs), len(text)]))


def removal_digests(docs: DataFrame, length: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    def fn(text: bytes, runs: list) -> dict:
        return {"n_bytes": len(text), "n_removed": sum(z - a for a, z in runs), "n_spans": len(runs),
                "kept_sha256": hashlib.sha256(kept_bytes(text, runs)).hexdigest()}

    return repeated_spans(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), length, fn,
                          "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(text: bytes, runs: list[tuple[int, int]]) -> str:
    """What is left as a string: a character that loses a byte goes."""
    cut = [(a, z) for a, z in runs]
    for i, (a, z) in enumerate(cut):
        while text[a] & 0xC0 == 0x80:
            a -= 1
        while z < len(text) and text[z] & 0xC0 == 0x80:
            z += 1
        cut[i] = (a, z)
    return kept_bytes(text, merge([{"a": a, "z": z} for a, z in cut])).decode()


def remove_repeats(docs: DataFrame, length: int = 200, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and the text that is left of every row."""
    return repeated_spans(docs, length, lambda text, runs: {"kept_text": whole_characters(text, runs)}, "kept_text string", keep)
