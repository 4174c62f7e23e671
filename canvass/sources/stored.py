"""Stored tables that stay readable while they are rewritten (SNK3, SNK4).

A table is a folder with two parts: ``files/<version>/bucket=<n>`` holds rows,
``commits`` one small row per bucket and version that says where the bucket's
rows lie. A write puts its rows beside the old ones and publishes them last, by
appending its commit rows; Spark's committer makes that one file appear whole or
not at all. A job that fails before leaves only files that no commit names, so readers
keep the old table. Rows are dealt to buckets by a hash of the primary key: an
upsert reads and rewrites only buckets that hold a key of the incoming rows.

One writer at a time; readers need no lock, as files are never changed. Old
versions stay until ``vacuum_list`` names them to whoever cleans the folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"
_COMMIT = "version long, bucket int, folder string, buckets int, rows long"


@dataclass(frozen=True)
class StoredTable:
    """``key``: the primary key. ``buckets``: at most so many small rows describe the table; it is fixed by the
    first write (a full ``replace`` may change it)."""
    spark: SparkSession
    path: str
    key: tuple[str, ...]
    buckets: int = 64

    # ------------------------------------------------------------ commits
    def _exists(self) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(p)

    def commits(self) -> DataFrame:
        """The newest commit of every bucket; a whole replacement (bucket null) hides all older ones."""
        if not self._exists():
            return self.spark.createDataFrame([], _COMMIT)
        log = self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
        start = log.where(F.col("bucket").isNull()).agg(F.max("version")).first()[0] or 0
        live = log.where((F.col("version") >= start) & F.col("bucket").isNotNull())
        newest = F.max_by(F.struct("version", "bucket", "folder", "buckets", "rows"), F.col("version")).alias("c")
        return live.groupBy("bucket").agg(newest).select("c.*")

    def _state(self) -> list:
        return self.commits().collect()     # at most ``buckets`` rows

    def version(self) -> int:
        """Number of the last published write; 0 for none."""
        if not self._exists():
            return 0
        return self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits").agg(F.max("version")).first()[0] or 0

    def _bucket_of(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")

    def _write(self, df: DataFrame, buckets: int) -> tuple[str, list]:
        """Rows into a new folder that nobody reads yet; per bucket the rows written. ``rebalance`` lets AQE split
        a bucket that holds very many rows over several tasks."""
        folder = f"{self.path}/files/{uuid.uuid4().hex}"
        dealt = df.withColumn(BUCKET, self._bucket_of(buckets)).hint("rebalance", F.col(BUCKET))
        dealt.write.partitionBy(BUCKET).parquet(folder)
        return folder, self.spark.read.parquet(folder).groupBy(BUCKET).count().collect() if self._any(folder) else []

    def _any(self, folder: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = hadoop.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return any(s.isDirectory() for s in fs.listStatus(hadoop))

    def _publish(self, rows: list) -> None:
        self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    # ------------------------------------------------------------ reading
    def read(self, only: set[int] | None = None) -> DataFrame:
        """The published rows (of the buckets ``only``). Raises ``ValueError`` if nothing was published yet."""
        state = [r for r in self._state() if r["rows"]]
        if not state:
            raise ValueError(f"no table published at {self.path}")
        wanted = [r for r in state if only is None or r["bucket"] in only]
        if not wanted:
            return self.spark.read.parquet(f"{state[0]['folder']}/{BUCKET}={state[0]['bucket']}").limit(0)
        return self.spark.read.parquet(*[f"{r['folder']}/{BUCKET}={r['bucket']}" for r in wanted])

    # ------------------------------------------------------------ writing
    def replace(self, df: DataFrame) -> bool:
        """SNK3: the whole table anew. An empty frame replaces nothing. The frame runs once: rows are counted in
        what was written. Returns whether a version was published."""
        folder, counts = self._write(df, self.buckets)
        if not counts:
            return False
        v = self.version() + 1
        self._publish([(v, None, folder, self.buckets, 0)]
                      + [(v, r[BUCKET], folder, self.buckets, r["count"]) for r in counts])
        return True

    def upsert(self, incoming: DataFrame) -> list[int]:
        """SNK4: delete by primary key, then insert. Rows with a null in the key delete nothing and are inserted;
        of incoming rows that share a key all are inserted. Returns the buckets that were rewritten."""
        state = self._state()
        if not any(r["rows"] for r in state):
            return [r["bucket"] for r in self._state()] if self.replace(incoming) else []
        buckets = state[0]["buckets"]
        keys = incoming.select(*self.key).distinct()
        touched = {r[0] for r in keys.select(self._bucket_of(buckets)).distinct().collect()}   # at most ``buckets``
        if not touched:
            return []
        kept = self.read(touched).join(keys, list(self.key), "left_anti")
        folder, counts = self._write(kept.unionByName(incoming), buckets)
        v = self.version() + 1
        by = {r[BUCKET]: r["count"] for r in counts}
        self._publish([(v, b, folder, buckets, by.get(b, 0)) for b in sorted(touched)])
        return sorted(touched)

    def vacuum_list(self) -> DataFrame:
        """(folder, bucket) of published rows that the current version no longer reads."""
        log = (self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
               .where(F.col("bucket").isNotNull()).select("folder", "bucket").distinct())
        return log.join(self.commits().select("folder", "bucket"), ["folder", "bucket"], "left_anti")
