"""Corpus pipeline over ``documents``: toxicity, near-duplicates, repeated
passages, personal data, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoframe.llm import packing, pii_crf, suffix_dedup, superminhash, toxicity
from cargoframe.llm.common import arrow_map, crc_mod, materialise, read

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: No SQL: the stages are learned models, set similarity and packing.
ORACLE_SQL = None


def _documents(rows: DataFrame, text: str) -> DataFrame:
    return rows.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, doesn't reject."""
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").filter(crc_mod("doc_id", 5) != 0)
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs, model, COLUMNS).filter("score < 0.5").select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one of
    the smallest doc_id (NULL after all others), then of the smallest text hash,
    lang and source.

    A document is a row's doc_id and text: rows equal in both are one, rows that
    share a doc_id but not the text are told apart, so are rows with NULL
    doc_id. Documents without words are near to nothing else."""
    d = docs.select(*COLUMNS)
    if d.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").limit(1).count() == 0:
        kept = superminhash.near_duplicates(d.select("doc_id", "text")).filter("kept").select("doc_id")
        return d.join(kept, "doc_id").select(*COLUMNS)
    # doc_id tells rows apart no more: rows get a key, written once
    d = materialise(d.withColumn("_key", F.monotonically_increasing_id()), "keyed")
    near = superminhash.near_duplicates(d.select(F.col("_key").alias("doc_id"), "text"))
    near = near.select(F.col("doc_id").alias("_key"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("_group"))
    rows = d.select("_key", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_hash"), "lang", "source").join(near, "_key")
    alone = F.when(F.col("_group").isNull(), F.struct("doc_id", "_hash"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_hash", "lang", "source", "_key")).alias("f")
    kept = rows.groupBy("_group", alone.alias("_alone")).agg(first).select("f._key")
    return d.join(kept, "_key", "left_semi").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings of 200 that occur elsewhere."""
    keep = tuple(c for c in COLUMNS if c not in ("text", "n_chars"))
    return _documents(suffix_dedup.remove_repeats(docs, 200, keep), "kept_text")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    model = pii_crf.learn(docs.select("doc_id", "text"))
    keep = [c for c in COLUMNS if c not in ("text", "n_chars")]

    def run(cols: dict) -> dict:
        return {c: cols[c] for c in keep} | {"clean": [pii_crf.redact(t.as_py() or "", model) for t in cols["text"]]}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return _documents(arrow_map(docs.select(*keep, "text"), run, f"{fields}, clean string"), "clean")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeats),
    ("pii", redact),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
