"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoframe.llm import (
    byte_bpe,
    chat_format,
    common,
    flat_graph,
    langid,
    packing,
    pii_crf,
    projected_search,
    spelling,
    suffix_dedup,
    superminhash,
    topk_search,
    toxicity,
    turn_repair,
)
from cargoframe.llm.common import crc_mod, read

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    own = "</s>[INST] ok [/INST]"
    probe = spark.sql(f"SELECT -1L AS conv_id, turn, role, '{own}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat_format.conversation_digests(chat_format.format_conversations(turns.union(probe)))


_ESC = r"replace(replace(replace(replace(replace({0}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"
ORACLE["op1_chat_formatting"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length('<s>[INST] ') + length({_ESC.format('role')}) + length(' [/INST] ') + length({_ESC.format('text')}) + length('</s>'))
      OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR rn = n) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR rn = n) AS n_examples
FROM s GROUP BY conv_id"""


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the rank file and decoded again."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe.encoding_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _held_out(n: int, r: int):
    return F.coalesce(crc_mod("doc_id", n) == r, F.lit(False))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels of four fifths."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").filter(crc_mod("doc_id", 5) != 0)
    got = toxicity.score(docs, toxicity.learn(docs, labels), ("doc_id",))
    return got.select("doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from three quarters."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.learn(docs.filter(crc_mod("doc_id", 4) != 2))
    got = langid.predict(docs, model)
    return got.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: pattern spans and the field's."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return pii_crf.find_pii(docs, pii_crf.learn(docs))


@query
def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: four words, 0.8."""
    return superminhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), k=4, percent=80)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 200-byte strings."""
    return suffix_dedup.removal_digests(read(spark, sf_dir, "documents", "doc_id", "text"), 200)


@query
def op2_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of equal label at cosine 0.98."""
    return flat_graph.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), 0.98)


@query
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 20 best inner products of the embeddings in 64ths."""
    v = read(spark, sf_dir, "embeddings", "vec_id", "embedding").filter(common.is_finite("embedding"))
    v = v.select("vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("long")).alias("vec"))
    return topk_search.top_k(v, F.col("vec_id") % 20 == 0, 20)


@query
def op11_projected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest of the embeddings by inner product, through stable projections."""
    v = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return projected_search.nearest(v, F.col("vec_id") % 20 == 0, 20)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, planted mistakes included, and their common forms."""
    words = spelling.word_counts(read(spark, sf_dir, "documents", "doc_id", "text"), damage=199)
    return spelling.variants(words)


def damaged_turns(turns: DataFrame) -> DataFrame:
    """``conversations`` with planted faults; ``present`` is false for dropped rows."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    t = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault"))
    return t.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again")).drop("again")


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged as the contract says, audited and repaired."""
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turn_repair.audit_conversations(damaged_turns(turns), F.col("present"))


ORACLE["op4_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

ORACLE["op2_flat_graph"] = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, l.b FROM reach r JOIN l ON l.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept, 1.0::DOUBLE AS audit_recall
FROM embeddings e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
