"""Shared helpers of the corpus operators: reading tables, written stages, connected components."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from canvass.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, UPPER.lower())


def small_batches(spark: SparkSession) -> None:
    """Arrow batches bound by rows and bytes: documents are long, and a worker holds a batch whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``: executors lost later cost no
    recomputation, and a frame used several times is computed once. The folder
    is the shared one that the session names; its clean-up is the cluster's,
    as for checkpoints.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges: (id, component = smallest id reachable).

    Alternating large-star and small-star steps, each one aggregate and one
    join. Ids without an edge to another id do not appear. Nulls are ignored.
    """
    links = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    links = staged(links, "links")

    def done(df: DataFrame) -> bool:
        # stars: no node has two smaller neighbours, or smaller and larger ones
        ends = df.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(
            df.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where(
            "low > 1 or (low > 0 and high > 0)").isEmpty()

    while not done(links):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        links = staged(small, "links")
    return (links.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(links.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct())


def with_arrow(df: DataFrame, columns: list[str], fields: list[tuple[str, str]], work, max_bytes: int = 2 << 20) -> DataFrame:
    """``df`` with the columns ``fields`` (name, type) that ``work`` makes from ``columns``.

    ``work`` gets one Arrow array per column, a run of rows of at most
    ``max_bytes`` (or one row), and returns one list or array per field. Other
    columns pass through; those named like a field are replaced. One narrow
    ``mapInArrow``: nothing is shuffled, and memory is bound by the batch. What a
    worker holds goes with its task, so that an idle one leaves the memory to
    other steps, those without Python too.
    """
    small_batches(df.sparkSession)
    names = [n for n, _ in fields]
    kept = [c for c in df.columns if c not in names]
    # every column is sent once; those that ``work`` reads come last
    sent = [c for c in kept if c not in columns] + list(dict.fromkeys(columns))
    source = df.select(*[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(sent)])
    schema = T.StructType([df.schema[c] for c in kept] + [
        T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    passed, read = [sent.index(c) for c in kept], [sent.index(c) for c in columns]
    first, width = min(read), len(kept)

    def run(batches):
        arrow = to_arrow_schema(schema)
        try:
            for batch in batches:
                for part in byte_slices(batch, first, max_bytes):
                    made = work(*[part.column(i) for i in read])
                    made = [x if isinstance(x, pa.Array) else pa.array(x, arrow.field(width + i).type) for i, x in enumerate(made)]
                    yield pa.RecordBatch.from_arrays([*[part.column(i) for i in passed], *made], schema=arrow)
        finally:
            batch = part = made = None
            drop_held()

    return source.mapInArrow(run, schema)


def byte_slices(batch, first: int, max_bytes: int):
    """Runs of the batch's rows whose texts, in the columns from ``first`` on, take at most ``max_bytes`` (or one row)."""
    size = np.zeros(batch.num_rows, np.int64)
    for col in batch.columns[first:]:
        if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) or pa.types.is_binary(col.type):
            size += pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + max_bytes, "right")))
        yield batch.slice(at, end - at)
        at = end


def set_aside(df: DataFrame, used: tuple[str, ...]):
    """``df`` with its columns but ``used`` under names that no operator makes, and a function that gives back the old ones."""
    names = {c: f"__own{i}" for i, c in enumerate(df.columns) if c not in used}

    def give_back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(names.get(c, f"`{c}`")).alias(c) for c in df.columns])

    return df.withColumnsRenamed(names), give_back


_held: dict = {}


def held(key, make):
    """What a Python worker keeps between tasks: one thing at a time, so that operators in a row do not add up."""
    if _held.get("key") != key:
        drop_held()
        _held.update(key=key, value=make())
    return _held["value"]


def drop_held() -> None:
    """Drop what this Python worker holds and return the memory."""
    _held.clear()
    give_back_memory()


def give_back_memory() -> None:
    """Return freed memory of this process to the system, where the C library can; Arrow's pool gives up its own first."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def empty_workers(spark: SparkSession) -> None:
    """Let idle Python workers drop what they hold, before a step that needs the memory for other things.

    One short job with several tasks a core; a worker that it misses drops its
    own at its next ``held``. Results never depend on it.
    """
    tasks = 2 * spark.sparkContext.defaultParallelism

    def run(batches):
        for batch in batches:
            drop_held()
            time.sleep(0.05)  # so that one worker does not take all tasks of its core's neighbours
            yield batch

    spark.range(0, tasks, 1, tasks).mapInArrow(run, "id bigint").agg(F.count("*")).collect()
