"""Best-fit-decreasing packing of tokenised documents into fixed-size sequences.

1. Every document is tokenised, ended and cut into pieces where it is read.
   A piece row carries its rank among the pieces of equal length of its task,
   and the rows are written once.
2. Best fit decreasing depends on lengths only, so the packing is planned on
   the histogram of lengths (at most ``capacity`` rows, whatever the corpus).
   Bins with equal remaining capacity stand together as ranges of bin numbers;
   a segment tree over remaining capacities finds the tightest open bins for
   a length in logarithmic time, and a whole range is filled in one step. The
   result equals placing the pieces one at a time.
3. A piece's number among all of its length is its rank in its task plus the
   count of earlier tasks; the plan maps (length, number) to bin and offset.
   A length that a third of all pieces share is thus never in one task.

Defined cases: NULL or empty text is one piece with the end id; a document
longer than ``capacity`` gives full pieces and a shorter last one; repeated
rows are packed each; NULL ids stay NULL; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargoframe.llm.common import Memo, give_back, held, materialise, slices

_MEMO = 400_000  # chunks in each half of a worker's memo


class WordEncoder:
    """Ids of a text by a tokenizers file with byte-level words that never
    reach across ASCII white space: the chunks between white space are encoded
    once each and kept in a bounded memo.

    A chunk of letters (and one final stop or comma), all below U+0130, is one
    word for the file's normaliser and pre-tokeniser, so its lower-case form
    goes straight to the file's BPE model; any other chunk takes the whole way.
    The file's special strings hold no white space, so a chunk holds them whole
    and they get their own ids, as in the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed rule: bytes that stand for themselves
        hidden = [b for b in range(256) if b not in set(shown)]
        self.chars = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.memo = Memo(self._fresh, _MEMO)

    def _fresh(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        word, stop = (text[:-1], text[-1:]) if text[-1] in ".," else (text, "")
        if word.isalpha() and max(word) < "\u0130":
            ids = [t.id for t in self.model.tokenize(word.lower().encode().decode("latin-1").translate(self.chars))]
            return np.array(ids, "<u4").tobytes() + (self.memo[stop.encode()] if stop else b"")
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, text.encode().split()))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Piece rows: doc_id, piece, start, length, ids_crc32, and (task, nth):
    the ``nth`` piece of that length in that task."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, task = held(("packing", tokenizer_path), lambda: WordEncoder(tokenizer_path)), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        end = np.uint32(end_id).tobytes()
        for whole in batches:
            for b in slices(whole):
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = enc.encode(text.as_py() or "") + end
                    total = len(ids) // 4
                    for k, at in enumerate(range(0, total, capacity)):
                        n = min(capacity, total - at)
                        nth = seen.get(n, 0)
                        seen[n] = nth + 1
                        rows.append((doc, k, at, n, zlib.crc32(ids[4 * at:4 * (at + n)]), task, nth))
                cols = list(zip(*rows)) or [()] * 7
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
        give_back()

    return docs.selectExpr(f"cast({id_col} as long) as i", f"{text_col} as t").mapInArrow(run, schema)


class CapacityTree:
    """Segment tree over remaining capacities: which have open bins."""

    def __init__(self, capacity: int):
        self.half = 1
        while self.half <= capacity:
            self.half *= 2
        self.any = bytearray(2 * self.half)

    def set(self, r: int, on: bool) -> None:
        i = r + self.half
        self.any[i] = on
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest capacity >= ``least`` with an open bin."""
        i = least + self.half
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.half:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.half
            i //= 2
        return None


def plan_bins(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit decreasing over {length: pieces}.

    Rows (length, first, each, bin, offset), sorted: the pieces of a length
    from number ``first`` on go, ``each`` to a bin, into the bins from ``bin``
    on at ``offset``.
    """
    tree, open_bins, bins = CapacityTree(capacity), {}, 0
    rows = []
    for length in sorted(histogram, reverse=True):
        left, first = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, start, n = capacity, bins, None
            else:
                start, n = open_bins[room].pop()
            each = min(room // length, left)
            used = left // each if n is None else min(n, left // each)
            if n is None:
                bins += used
            elif used < n:
                open_bins[room].append((start + used, n - used))
            if n is not None and not open_bins[room]:
                tree.set(room, False)
            rows.append((length, first, each, start, capacity - room))
            rest = room - each * length
            if rest:
                open_bins.setdefault(rest, []).append((start, used))
                tree.set(rest, True)
            first += used * each
            left -= used * each
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(plan: np.ndarray, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the ``number``-th piece of a length."""
    key = lambda a, b: (a.astype(np.int64) << 44) | b
    row = plan[np.searchsorted(key(plan[:, 0], plan[:, 1]), key(length, number), "right") - 1]
    k = number - row[:, 1]
    return row[:, 3] + k // row[:, 2], row[:, 4] + k % row[:, 2] * length


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Piece rows with sequence_id and offset."""
    pieces = materialise(pieces, "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    plan = pieces.sparkSession.sparkContext.broadcast(plan_bins(histogram, capacity))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    numbered = pieces.join(starts, ["task", "length"]).select(*keep, (F.col("nth") + F.col("earlier")).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                seq, off = place(plan.value, b.column("length").to_numpy(), b.column("number").to_numpy())
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(seq), pa.array(off)],
                                                 names=[*keep, "sequence_id", "offset"])

    return numbered.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack all rows of ``docs``."""
    return pack(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), capacity)
