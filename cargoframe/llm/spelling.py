"""Spelling variants: words one edit apart, and the common form each points to.

Two words one edit apart share their first or their last half (halves of the
shorter word), whichever the edit is not in. So words meet in small lists: one
per (length of the shorter word, side, shared half). Spark sorts every list by
what follows the shared half (read from the inside outwards); a task walks the
sorted list for each word with one row of the banded edit matrix per depth.
Neighbours in the list share a prefix (their LCP), so the rows up to it are
reused; where a row holds no value of one edit or less, the walk jumps over
all words that share that prefix.

A list of more than ``BLOCK`` words (a common ending) is dealt out: its words
by hash to blocks, its queries to as many chunks, and each pair of block and
chunk is one bounded step. A step returns one row per word (count and best
near word), never the pairs.

Defined cases: NULL texts have no words; runs with NULL doc_id are never
deleted from; words that occur in several rows of the word table count once per
row given (``variants`` expects distinct words); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoframe.llm.common import give_back, materialise

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
BLOCK = 4096  # words of a list that are scanned in one step
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FAR = 2  # any distance above one edit


def word_counts(docs: DataFrame, damage: int = 0, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of the letter runs of ``docs`` (doc_id, text), A-Z lower-cased,
    with at least ``shortest`` code points and ``least`` occurrences.

    With ``damage``, a run whose crc32 with its doc_id that number divides
    loses the code point that the crc32 names (a planted spelling mistake).
    """
    run = F.col("run")
    # lower() only where it can touch nothing but A-Z
    low = F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))
    w = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).select("doc_id", low.alias("run"))
    if damage:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), run).cast("binary"))
        at = (h % F.length(run)).cast("int")
        cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        w = w.select(F.when(h % damage == 0, cut).otherwise(run).alias("run"))
    return (w.filter(F.length("run") >= shortest).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least))


class SortedList:
    """A sorted list of words, scanned for all that are one edit from a query."""

    def __init__(self, words: list[str]):
        self.words, n = words, len(words)
        self.lcp = [0] * (n + 1)
        for i in range(1, n):
            a, b = words[i - 1], words[i]
            k = 0
            for x, y in zip(a, b):
                if x != y:
                    break
                k += 1
            self.lcp[i] = k
        # past[d][i]: the first later word that doesn't share d code points with word i
        # (word i + 1, deeper than any two neighbours share)
        self.past = [[n] * n for _ in range(max(self.lcp) + 1)]
        for d in range(1, len(self.past)):
            past, end = self.past[d], n
            for i in range(n - 1, -1, -1):
                past[i] = end
                if self.lcp[i] < d:
                    end = i

    def one_edit(self, query: str) -> list[int]:
        """Positions of the words at distance exactly one, as long as the query
        or one code point longer."""
        words, lcp, past, n, size = self.words, self.lcp, self.past, len(self.words), len(query)
        found = []
        # rows[d]: distances of the first d code points to query[:d-1], query[:d], query[:d+1]
        rows = [(_FAR, 0, 1 if size else _FAR)]
        i = 0
        while i < n:
            word = words[i]
            depth = lcp[i] if lcp[i] < len(rows) else len(rows) - 1
            del rows[depth + 1:]
            a, b, c = rows[depth]
            for d in range(depth, len(word)):
                x = word[d]
                lower = a if d and d <= size and x == query[d - 1] else a + 1
                if b + 1 < lower:
                    lower = b + 1
                mid = b if d < size and x == query[d] else b + 1
                if c + 1 < mid:
                    mid = c + 1
                if lower + 1 < mid:
                    mid = lower + 1
                if d + 1 > size:
                    mid = _FAR
                upper = (c if x == query[d + 1] else c + 1) if d + 1 < size else _FAR
                if mid + 1 < upper and d + 1 < size:
                    upper = mid + 1
                a, b, c = lower, mid, upper
                if a > 1 and b > 1 and c > 1:
                    i = past[d + 1][i] if d + 1 < len(past) else i + 1
                    break
                rows.append((a, b, c))
            else:
                if (b if len(word) == size else a if len(word) == size + 1 else _FAR) == 1:
                    found.append(i)
                i += 1
        return found


_PART = "word string, n_near long, form_n long, form string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within the lists of one partition, which come one after the
    other, each sorted; holds one list at a time."""
    names = [f.split()[0] for f in _PART.split(", ")]

    def results(group: list[tuple]) -> pa.RecordBatch:
        side, m, half = group[0][0]
        # ask: NULL for a whole list, whose words are its queries too
        inside = [r for r in group if not r[4]]
        asking = [r for r in group if r[4] is not False and len(r[2]) == m]
        best: dict[str, list] = {}

        def near(word: str, other: str, n: int) -> None:
            got = best.setdefault(word, [0, -1, ""])
            got[0] += 1
            if n > got[1] or (n == got[1] and other < got[2]):
                got[1:] = n, other

        if inside and asking:
            lists = SortedList([r[1] for r in inside])
            for _, rest, word, n, _ in asking:
                for i in lists.one_edit(rest):
                    other, n_other = inside[i][2], inside[i][3]
                    if side and word[:half] == other[:half]:
                        continue  # these meet by their first half
                    near(word, other, n_other)
                    if len(other) > m:
                        near(other, word, n)
        out = [(w, *b) for w, b in best.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], names=names)

    at, group = None, []
    for b in batches:
        for key, kind, rest, word, n, ask in zip(*(b.column(c).to_pylist() for c in ("key", "kind", "rest", "word", "n", "ask"))):
            if key != at:
                if len(group) > 1:
                    yield results(group)
                at, group = key, []
            group.append(((kind["side"], kind["m"], kind["half"]), rest, word, n, ask))
    if len(group) > 1:
        yield results(group)
    give_back()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) for every word of ``words`` (word, n) with a
    word one edit away: how many, and the one of largest n (ties: the
    smallest in code-point order)."""
    size = F.length("word")
    half = lambda m: F.floor(m / 2).cast("int")
    lists = F.array(*(F.struct(m.alias("m"), F.lit(side).alias("side"), half(m).alias("half")) for m in (size, size - 1) for side in (0, 1)))
    w = words.select("word", "n", F.explode(lists).alias("kind"))
    m, h = F.col("kind.m"), F.col("kind.half")
    shared = F.when(F.col("kind.side") == 0, F.substring("word", F.lit(1), h)).otherwise(F.substring("word", size - (m - h) + 1, m - h))
    rest = F.when(F.col("kind.side") == 0, F.substring("word", h + 1, size)).otherwise(F.reverse(F.substring("word", F.lit(1), size - (m - h))))
    w = w.select("kind", shared.alias("shared"), rest.alias("rest"), "word", "n")
    full = w.groupBy("kind", "shared").agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    w = w.join(full, ["kind", "shared"]).withColumn("parts", F.ceil(F.col("rows") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    # a list within BLOCK is its own queries; a larger one meets every chunk of them
    copies = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("block"), F.lit(0).alias("chunk"), F.lit(None).cast("boolean").alias("ask")))).otherwise(F.concat(
        F.transform(every, lambda c: F.struct(own.alias("block"), c.cast("int").alias("chunk"), F.lit(False).alias("ask"))),
        F.transform(every, lambda b: F.struct(b.cast("int").alias("block"), own.alias("chunk"), F.lit(True).alias("ask")))))
    w = w.withColumn("copy", F.explode(copies)).select(
        F.concat_ws(" ", "kind.m", "kind.side", "shared", "copy.block", "copy.chunk").alias("key"), "kind", "rest", "word", "n", "copy.ask")
    found = w.repartition("key").sortWithinPartitions("key", "rest", "word").mapInArrow(_scan, _PART)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("form_n"), F.col("b.form").alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where each word of ``forms`` (word, form) ends up by
    following forms. The steps double every round, so chains of any length
    (forms must not run in circles) take a logarithmic number of rounds."""
    at = materialise(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialise(moved, "roots")
        at = moved.select("word", "root")
        if moved.filter("moved").limit(1).count() == 0:
            return at


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct ``words`` (word, n).

    A word's form is its best near word if that occurs at least ``times`` as
    often, else NULL; its root is the last word reached by forms, itself
    without one.
    """
    words = materialise(words.filter("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "words")
    enough = F.col("form_n") >= times * F.col("n")
    w = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    w = materialise(w, "forms")
    return w.join(roots(w), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
