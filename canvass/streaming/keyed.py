"""A table of rows by key that a stream keeps up to date, micro-batch by micro-batch.

Every micro-batch writes the rows that it changes under its own id
(``kind=delta/batch=N``) and reads only rows of smaller ids. So a batch that
runs again, after a failure or a restart, reads what it read before and replaces
what it wrote: it changes nothing. Every ``full_every`` batches the latest row
of each key is also written as one whole (``kind=full/batch=N``); reading starts
from the last whole before the batch.

All of it is joins and aggregates of DataFrames: a key with very many events in
one micro-batch is no group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FULL_EVERY = 32
_PLACE = [T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType())]


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: list[str], full_every: int = FULL_EVERY):
        self.spark, self.path, self.schema, self.key, self.full_every = spark, path, schema, key, full_every
        # an empty whole before all batches, so that there is always one to start from
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/kind=full/batch=-1")

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema.fields, *_PLACE])).option("basePath", self.path).parquet(self.path)

    def _latest(self, rows: DataFrame) -> DataFrame:
        others = [c for c in self.schema.names if c not in self.key]
        best = rows.groupBy(*self.key).agg(F.max_by(F.struct(*others), "batch").alias("_row"))
        return best.select(*[F.col(c) if c in self.key else F.col(f"_row.{c}").alias(c) for c in self.schema.names])

    def before(self, batch: int) -> DataFrame:
        """The latest row of every key, as of all batches before this one. Keys are not null."""
        rows = self._rows().where(F.col("batch") < batch)
        whole = rows.where("kind = 'full'").agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
        return self._latest(rows.where((F.col("batch") > whole) & (F.col("kind") == "delta") | (F.col("batch") == whole) & (F.col("kind") == "full")))

    def put(self, rows: DataFrame, batch: int) -> None:
        """Write the rows that this batch changes, one per key."""
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/kind=delta/batch={batch}")
        if batch % self.full_every == self.full_every - 1:
            self.before(batch + 1).write.mode("overwrite").parquet(f"{self.path}/kind=full/batch={batch}")

    def latest(self) -> DataFrame:
        return self.before(1 << 62)

    def log(self) -> DataFrame:
        """All rows as they were written, with the batch that wrote them."""
        return self._rows().where("kind = 'delta'").drop("kind")


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Rows that a micro-batch gives out, under its id: a repeated batch replaces them."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")
