"""Incremental labelling with Structured Streaming.

The reference resumes a run by reloading a checkpoint file and skipping
descriptions already labelled.  Here new shipment files arrive as a stream;
each micro-batch is cleaned, reduced to its distinct descriptions, stripped
of descriptions already in the label table (left anti join — the resume
rule), labelled by dictionary (+ heuristic), and appended.

Exactly-once output: each epoch writes its own ``epoch=<id>`` directory with
overwrite, so a micro-batch replayed after a failure replaces its own output
instead of duplicating it; the "already labelled" read skips the current
epoch.  The stream's checkpoint and the label table live under the shared
folder the cluster names (``spark.checkpoint.dir``) unless given.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import clean as C
from ..operators import dictionary as D
from ..operators import labels as L
from ..session import ensure_checkpoint_dir


def _existing_labels(spark: SparkSession, labels_path: str, epoch_id: int, keys: Sequence[str]) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(labels_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):  # no epoch written yet
        return None
    done = spark.read.parquet(labels_path)
    return done.filter(F.col("epoch") != epoch_id).select(*keys).distinct()


def label_micro_batch(batch: DataFrame, epoch_id: int, dictionaries: DataFrame, labels_path: str,
                      keys: Sequence[str] = ("hs4", "product", "goods_shipped")) -> None:
    """foreachBatch body: clean -> distinct descriptions -> not yet labelled ->
    dictionary + heuristic -> write this epoch's directory."""
    spark = batch.sparkSession
    clean = C.load_clean(batch).withColumnRenamed("category", "product")
    goods = L.distinct_goods(clean, keys=keys)
    done = _existing_labels(spark, labels_path, epoch_id, keys)
    todo = goods if done is None else L.remaining(goods, done, keys)
    out = D.resolve_attributes(todo, dictionaries, ["hs4", "product"])
    (out.select(*keys, "attr", "value", "source", "n_rows")
        .withColumn("epoch", F.lit(epoch_id))
        .write.mode("overwrite").parquet(os.path.join(labels_path, f"epoch={epoch_id}")))


def start_incremental_labelling(spark: SparkSession, source_dir: str, schema: StructType, dictionaries: DataFrame,
                                labels_path: str | None = None, checkpoint_path: str | None = None,
                                available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream over parquet shipment files in ``source_dir``."""
    base = ensure_checkpoint_dir(spark)
    labels_path = labels_path or os.path.join(base, "labels")
    checkpoint_path = checkpoint_path or os.path.join(base, "labels-stream")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    w = (stream.writeStream
               .foreachBatch(lambda df, eid: label_micro_batch(df, eid, dictionaries, labels_path))
               .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
