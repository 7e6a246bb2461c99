"""Language identification by word-first backoff.

A known word scores with its per-language log frequency. A word that is not
known falls back to the longest character n-grams of it (with word ends) that
are known for any language: length 4, then 3, 2 and 1. A text's score for a
language is the sum over all its words; ``score`` is the softmax of the mean
over words, sharpened by the word count up to ``sure_after`` words.

The counts are learned from a bounded sample of the labelled rows: rows are
taken by a hash of their id at a rate that gives about ``per_lang`` rows of
each language (all rows where there are fewer), ``sample_docs`` rows over all
languages, so that with many languages each gives fewer. Every language with a
labelled row is learned (at least its first row in the hash's order), and
every word and n-gram of the sample is in the model. It holds one entry per (word or n-gram,
language) that the sample has, never one per pair that it could have: its
size follows the sample, not the number of languages. Scoring reads every
whole text.

Defined cases: NULL text or text without a letter is ``und`` with score 0, as
is everything if no labelled row exists; ties go to the smaller language name;
NULL ids are never learned from; repeated rows count each; other columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoframe.llm.common import arrow_map, held, materialise

LONGEST = 4
_WORDS = re.compile(r"[^\W\d_]+")
_MEMO = 200_000  # unseen words that a worker remembers


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters; empty if the text has no letter."""
    found = _WORDS.findall(text.lower())
    return found if any(w.isalpha() for w in found) or any(c.isalpha() for w in found for c in w) else []


def grams_of(word: str, n: int) -> list[str]:
    w = f" {word} "
    return [w[i:i + n] for i in range(len(w) - n + 1)] if n > 1 else list(word)


def sample_rows(rows: DataFrame, group: str, per_group: int, seed: str, total: int | None = None) -> DataFrame:
    """About ``per_group`` rows of each value of ``group`` (all, if fewer), by
    a hash of doc_id, and about ``total`` rows over all values: beyond that every
    value gives an equal part, its row of the least hash at least. The counts
    read no texts, and are joined as a table: there is one row per value."""
    share = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30))
    n = rows.groupBy(group).agg(F.count("*").alias("_n"), F.min(share).alias("_least"))
    if total is not None:
        n = n.withColumn("_part", F.least(F.lit(float(per_group)), F.lit(float(total)) / n.agg(F.greatest(F.count("*"), F.lit(1))).scalar()))
    else:
        n = n.withColumn("_part", F.lit(float(per_group)))
    taken = (share / F.lit(float(1 << 30)) * F.col("_n") < F.col("_part")) | (share == F.col("_least"))
    return rows.join(n, group).filter(taken).drop("_n", "_least", "_part")


def learn(docs: DataFrame, per_lang: int = 1500, sample_docs: int = 20_000) -> dict:
    """Model from rows (doc_id, text, lang); rows without text or lang are left out."""
    texts = docs.filter("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                seen.setdefault(lang, Counter()).update(words_of(text.as_py()))
        for lang, words in seen.items():
            by_n = {0: words} | {n: Counter() for n in range(1, LONGEST + 1)}
            for w, c in words.items():
                for n in range(1, LONGEST + 1):
                    for g in grams_of(w, n):
                        by_n[n][g] += c
            for n, grams in by_n.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array([n] * len(grams), pa.int32()), pa.array(list(grams), pa.string()),
                     pa.array(list(grams.values()), pa.int64())], names=["lang", "n", "gram", "c"])

    # the sample's ids are bounded by sample_docs (and one for each language); texts stay where they are
    ids = sample_rows(texts.select("doc_id", "lang"), "lang", per_lang, "langid", sample_docs).distinct()
    counts = (texts.join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "text")
              .mapInArrow(count, "lang string, n int, gram string, c long").groupBy("lang", "n", "gram").agg(F.sum("c").alias("c")))
    counts = materialise(counts, "grams")
    totals = counts.groupBy("lang", "n").agg(F.sum("c").alias("c"), F.count("*").alias("kinds")).collect()
    langs = sorted({r["lang"] for r in totals})
    at = {x: i for i, x in enumerate(langs)}
    base = np.full((LONGEST + 1, len(langs)), np.log(0.5))
    for r in totals:  # log frequency of a kind that a language lacks: half a count
        base[r["n"], at[r["lang"]]] = np.log(0.5) - np.log(r["c"] + 0.5 * r["kinds"])
    rows = counts.select("lang", "n", "gram", "c").toArrow()  # as large as the sample
    names, n_col = rows.column("gram").to_pylist(), rows.column("n").to_numpy()
    lang_at = np.array([at[x] for x in rows.column("lang").to_pylist()], np.int32)
    gain = np.log(rows.column("c").to_numpy() + 0.5) - np.log(0.5)  # over what a language gets that lacks the kind
    keys: list[dict] = []
    tables = []
    for n in range(LONGEST + 1):
        own = np.flatnonzero(n_col == n)
        key: dict = {}
        kind = np.array([key.setdefault(names[i], len(key)) for i in own], np.int64)
        order = np.argsort(kind, kind="stable")
        tables.append((np.searchsorted(kind[order], np.arange(len(key) + 1)), lang_at[own][order], gain[own][order]))
        keys.append(key)
    return {"langs": langs, "keys": keys, "tables": tables, "base": base}


class Scorer:
    """Scores texts with a learned model. A table is (start of each kind's
    entries, their languages, their gains); words that were looked up stand in
    one such table, known ones first, unseen ones behind them until there are
    too many."""

    def __init__(self, model: dict):
        self.langs, self.keys, self.tables = model["langs"], model["keys"], model["tables"]
        self.base = np.vstack([model["base"], np.zeros(len(self.langs))])  # the last level: no n-gram is known
        start, self.lang, self.gain = self.tables[0]
        self.known, self.filled = len(start) - 1, len(self.lang)
        self.start, self.size = start[:-1].copy(), np.diff(start)
        self.level = np.zeros(self.known, np.int64)
        self.next, self.free = self.known, self.filled
        self.unseen: dict[str, int] = {}

    def backoff(self, word: str) -> tuple:
        """(level, languages, gains) of the longest n-grams that are known."""
        for n in range(LONGEST, 0, -1):
            hits = [self.keys[n][g] for g in grams_of(word, n) if g in self.keys[n]]
            if hits:
                start, lang, gain = self.tables[n]
                at = np.concatenate([np.arange(start[h], start[h + 1]) for h in hits])
                own, back = np.unique(lang[at], return_inverse=True)
                return n, own, np.bincount(back, gain[at], len(own)) / len(hits)
        return LONGEST + 1, np.zeros(0, np.int32), np.zeros(0)

    def add(self, word: str) -> int:
        """A row for an unseen word; the arrays grow as they must."""
        n, lang, gain = self.backoff(word)
        if self.next == len(self.start):
            more = max(1024, len(self.start) // 2)
            self.start, self.size, self.level = (np.append(x, np.zeros(more, x.dtype)) for x in (self.start, self.size, self.level))
        if self.free + len(lang) > len(self.lang):
            more = max(4096, len(self.lang) // 2, len(lang))
            self.lang, self.gain = np.append(self.lang, np.zeros(more, np.int32)), np.append(self.gain, np.zeros(more))
        i, end = self.next, self.free + len(lang)
        self.start[i], self.size[i], self.level[i] = self.free, len(lang), n
        self.lang[self.free:end], self.gain[self.free:end] = lang, gain
        self.next, self.free = i + 1, end
        self.unseen[word] = i
        return i

    def score(self, text: str | None, sure_after: int = 10) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.langs:
            return "und", 0.0
        total, level = np.zeros(len(self.langs)), np.zeros(LONGEST + 2)
        for a in range(0, len(words), 20_000):
            if self.next - self.known > _MEMO or self.free - self.filled > 8 * _MEMO:
                self.unseen.clear()
                self.next, self.free = self.known, self.filled
            part = words[a:a + 20_000]
            ids = np.fromiter(map(self.keys[0].get, part, repeat(-1)), np.int64, len(part))
            for i in np.flatnonzero(ids < 0).tolist():
                row = self.unseen.get(part[i])
                ids[i] = self.add(part[i]) if row is None else row
            size = self.size[ids]
            end = np.cumsum(size)
            flat = np.arange(end[-1]) + np.repeat(self.start[ids] - end + size, size)
            total += np.bincount(self.lang[flat], self.gain[flat], len(self.langs))
            level += np.bincount(self.level[ids], minlength=LONGEST + 2)
        mean = (total + level @ self.base) / len(words)
        p = np.exp((mean - mean.max()) * min(len(words), sure_after))
        best = int(p.argmax())
        return self.langs[best], float(1 / p.sum())


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # as large as the sample
    key = uuid.uuid4().hex

    def run(cols: dict[str, pa.Array]) -> dict:
        scorer = held(("langid", key), lambda: Scorer(sent.value))
        got = [scorer.score(t.as_py()) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return arrow_map(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), run, "doc_id long, lang_pred string, score double")
