"""Maintained tables that rewrite or append only what changes.

A ``BucketTable`` is a folder of parquet files laid out as
``data/_v=<version>/_b=<bucket>``; a row's bucket is a hash of its key. A small
table ``live`` names, for every version of the whole, the span of versions whose
files hold each bucket (at most one row per bucket). So

* ``merge`` rewrites the buckets that hold a changed key into a new version and
  carries the others over by naming their old files;
* ``append`` adds a version (a change log); ``compact`` folds the buckets whose
  log has grown into one version again.

``live`` is written last: a job that is lost before it leaves the version
before in force, and running it again overwrites the same folders (dynamic
partition overwrite). One writer at a time; readers of an older version keep
reading it, since no file is changed in place.

``KnowledgeBase`` keeps records as such a log with tombstones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

_LIVE = "version int, bucket int, low int, high int, n_rows long"


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key: the first 32 bits of the SHA-256 of its text (NULL
    keys: of the empty text)."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


class BucketTable:
    """A table in ``path``, keyed by ``key``, in ``buckets`` hash buckets. The
    number of buckets bounds all that reaches the driver."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, buckets: int = 64):
        self.spark, self.path, self.key, self.schema, self.buckets = spark, path, key, schema, buckets

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int = 64) -> BucketTable:
        t = cls(df.sparkSession, path, key, df.schema, buckets)
        t._commit(1, t._write(df, 1), [])
        return t

    # --- files ---------------------------------------------------------------

    def _write(self, df: DataFrame, version: int) -> list[tuple]:
        """Write rows as ``version``: (bucket, low, high, rows) of what was written.
        The rebalance hint lets AQE split a bucket that a hot key fills."""
        rows = df.select(*self.schema.names, F.lit(version).alias("_v"), bucket_of(self.key, self.buckets).alias("_b"))
        (rows.hint("rebalance", F.col("_b")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_v", "_b").parquet(f"{self.path}/data"))
        return [(b, version, version, n) for b, n in self._files().filter(F.col("_v") == version).groupBy("_b").count().collect()]

    def _files(self) -> DataFrame:
        place = [StructField("_v", IntegerType()), StructField("_b", IntegerType())]
        return self.spark.read.schema(StructType([*self.schema.fields, *place])).parquet(f"{self.path}/data")

    def _commit(self, version: int, written: Sequence[tuple], kept: Sequence[tuple]) -> None:
        rows = [(version, *r) for r in (*written, *kept, (-1, version, version, 0))]  # -1 marks the version, empty or not
        live = self.spark.createDataFrame(rows, _LIVE).withColumn("_v", F.col("version"))
        (live.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_v").parquet(f"{self.path}/live"))

    def live(self, version: int | None = None) -> list[tuple]:
        """(bucket, low, high, n_rows) of a version (the newest)."""
        every = self.spark.read.schema(f"{_LIVE}, _v int").parquet(f"{self.path}/live")
        if version is None:
            version = self.version()
        return [tuple(r) for r in every.filter((F.col("_v") == version) & (F.col("bucket") >= 0)).select("bucket", "low", "high", "n_rows").collect()]

    def version(self) -> int:
        return self.spark.read.schema(f"{_LIVE}, _v int").parquet(f"{self.path}/live").agg(F.max("_v")).first()[0] or 0

    # --- reading -------------------------------------------------------------

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None, with_version: bool = False) -> DataFrame:
        """The rows of a version; only the folders of ``buckets`` are listed as
        input (partition pruning on constants)."""
        spans: dict[tuple, list[int]] = {}
        for b, low, high, _ in self.live(version):
            if buckets is None or b in buckets:
                spans.setdefault((low, high), []).append(b)
        keep = F.lit(False)
        for (low, high), own in spans.items():
            keep = keep | (F.col("_v").between(low, high) & F.col("_b").isin(own))
        rows = self._files().filter(keep)
        return rows if with_version else rows.select(*self.schema.names)

    # --- changes -------------------------------------------------------------

    def touched(self, changes: DataFrame, key: str | None = None) -> list[int]:
        """Buckets that hold a key of ``changes``: the buckets of the keys, then
        a semi join that reads the key column of those buckets only."""
        keys = changes.select(F.col(key or self.key).alias("_k")).distinct()
        near = [r[0] for r in keys.select(bucket_of("_k", self.buckets).alias("_b")).distinct().collect()]
        own = self.read(buckets=near, with_version=True).select(F.col(self.key).alias("_k"), "_b")
        return sorted(r[0] for r in own.join(keys, "_k", "left_semi").select("_b").distinct().collect())

    def merge(self, changes: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], key: str | None = None) -> int:
        """Replace every touched bucket by ``change(its rows, changes)``, whose
        rows must keep their keys; how many buckets were rewritten."""
        version, hit = self.version(), self.touched(changes, key)
        live = self.live(version)
        if hit:
            new = self._write(change(self.read(version, hit), changes), version + 1)
            self._commit(version + 1, new, [r for r in live if r[0] not in hit])
        return len(hit)

    def append(self, rows: DataFrame) -> None:
        """Add rows as a new version beside the old ones (a change log)."""
        version = self.version()
        new = {b: n for b, _, _, n in self._write(rows, version + 1)}
        live = {r[0]: r for r in self.live(version)}
        kept = [(b, low, version + 1 if b in new else high, n + new.get(b, 0)) for b, low, high, n in live.values()]
        self._commit(version + 1, [(b, version + 1, version + 1, n) for b, n in new.items() if b not in live], kept)

    def compact(self, fold: Callable[[DataFrame], DataFrame], min_versions: int = 2) -> int:
        """Fold the buckets whose span holds at least ``min_versions`` versions
        into one; how many were rewritten. ``fold`` gets rows with ``_v``."""
        version, live = self.version(), self.live()
        long = [b for b, low, high, _ in live if high - low + 1 >= min_versions]
        if long:
            new = self._write(fold(self.read(version, long, with_version=True)), version + 1)
            self._commit(version + 1, new, [r for r in live if r[0] not in long])
        return len(long)


class KnowledgeBase:
    """Records as an append-only log of puts and tombstones.

    ``upsert`` appends records, ``delete`` appends one tombstone per namespace;
    neither reads the records. ``read`` takes, per id, the record of the newest
    ``version`` column (ties: the largest of all other columns), leaving out
    records that were put before their namespace's tombstone. It is one
    aggregation that starts before the shuffle. An id belongs to one
    namespace, since its hash holds the namespace (F10).
    """

    def __init__(self, table: BucketTable, dropped: BucketTable, ns_cols: Sequence[str], version_col: str):
        self.table, self.dropped, self.ns_cols, self.version_col = table, dropped, list(ns_cols), version_col

    @classmethod
    def create(cls, records: DataFrame, path: str, ns_cols: Sequence[str], id_col: str = "id", version_col: str = "version",
               buckets: int = 64) -> KnowledgeBase:
        table = BucketTable.create(records, f"{path}/records", id_col, buckets)
        none = records.select(*ns_cols).limit(0).withColumn("at", F.lit(0))
        dropped = BucketTable(records.sparkSession, f"{path}/dropped", ns_cols[0], none.schema, 1)
        dropped._commit(1, [], [])
        return cls(table, dropped, ns_cols, version_col)

    def upsert(self, records: DataFrame) -> None:
        self.table.append(records)

    def delete(self, namespaces: DataFrame) -> None:
        """Tombstones: records of these namespaces put so far are gone."""
        at = self.table.version()
        self.dropped.append(namespaces.select(*self.ns_cols).distinct().withColumn("at", F.lit(at)))

    def _alive(self, log: DataFrame) -> DataFrame:
        if not self.dropped.live():
            return log
        last = self.dropped.read().groupBy(*self.ns_cols).agg(F.max("at").alias("_at"))
        # NULL is a namespace value like any other
        same = F.lit(True)
        for c in self.ns_cols:
            same = same & log[c].eqNullSafe(last[c])
        return log.join(last, same & (log["_v"] <= last["_at"]), "left_anti")

    def _newest(self, log: DataFrame) -> DataFrame:
        key, names = self.table.key, self.table.schema.names
        rest = [self.version_col, *sorted(c for c in names if c not in (key, self.version_col))]
        newest = self._alive(log).groupBy(key).agg(F.max(F.struct(*rest)).alias("_r"))
        return newest.select(*(F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in names))

    def read(self) -> DataFrame:
        return self._newest(self.table.read(with_version=True))

    def compact(self, min_versions: int = 2) -> int:
        """Fold grown buckets; tombstones stay, as other buckets may need them."""
        return self.table.compact(self._newest, min_versions)

    def namespace_counts(self, top: int = 10) -> DataFrame:
        """Live records per namespace, largest first (a top-10 report)."""
        return self.read().groupBy(*self.ns_cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *self.ns_cols).limit(top)
