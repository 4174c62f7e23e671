"""Skew-safe ordered scans: running max per key and row numbers per group.

A window ``PARTITION BY key ORDER BY t`` puts every row of a key in one task;
if one key holds a third of the data, that task holds a third of the data.
These scans split each key into contiguous ranges of the order column
(``bucket``), work inside each (key, bucket), and carry a one-row-per-bucket
summary forward from the earlier buckets — a two-pass parallel prefix scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canvass.session import ensure_checkpoint_dir

# Rows of one key in one range of the (integral) order column.
DEFAULT_BUCKET_WIDTH = 1 << 16


def prior_max(df: DataFrame, keys: list[str], order: str, value: str, out: str,
              bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """``out`` = max of ``value`` over the rows of the same key with a smaller
    ``order`` (strictly earlier; ``order`` is integral and unique per key).

    Equals ``max(value) OVER (PARTITION BY keys ORDER BY order ROWS BETWEEN
    UNBOUNDED PRECEDING AND 1 PRECEDING)`` but no window spans more than one
    bucket of one key.
    """
    return prior_maxes(df, keys, order, {out: value}, bucket_width)


def prior_maxes(df: DataFrame, keys: list[str], order: str, values: dict[str, str],
                bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """``prior_max`` of several columns (out -> value) in one scan."""
    b = F.floor(F.col(order) / F.lit(bucket_width)).alias("_bucket")
    x = df.withColumn("_bucket", b)
    inner = (Window.partitionBy(*keys, "_bucket").orderBy(order)
             .rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumns({f"_in_{out}": F.max(v).over(inner) for out, v in values.items()})
    per_bucket = x.groupBy(*keys, "_bucket").agg(*[F.max(v).alias(f"_bmax_{out}") for out, v in values.items()])
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*keys, "_bucket", *[F.max(f"_bmax_{out}").over(before).alias(f"_carry_{out}") for out in values])
    return (join_null_safe(x, carry, [*keys, "_bucket"])
            .withColumns({out: F.greatest(f"_in_{out}", f"_carry_{out}") for out in values})
            .drop("_bucket", *[f"_{k}_{out}" for out in values for k in ("in", "carry")]))


def fixed_ranges(df: DataFrame, columns: list[str], partitions: int) -> DataFrame:
    """``df`` in range partitions of ``columns``, with the partition in ``_pid``.

    Range bounds come from a sample, so two plans over the same rows may draw
    other bounds. The checkpoint (in the cluster's folder) fixes rows and
    partition numbers together; all later steps read the same ones.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(partitions, *columns).withColumn("_pid", F.spark_partition_id()).checkpoint()


def numbered(df: DataFrame, group: list[str], order: list[str], out: str = "rn",
             partitions: int | None = None) -> DataFrame:
    """1-based row number per ``group`` under ``order`` (unique), without a
    one-task window per group. A null group is a group.

    Rows are range-partitioned on (group, order) once; each partition numbers
    its own rows, and a per-(partition, group) count table — a few rows per
    partition — gives every partition its starting offset.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = fixed_ranges(df, [*group, *order], n)
    local = F.row_number().over(Window.partitionBy("_pid", *group).orderBy(*order))
    x = x.withColumn("_local", local)
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = (x.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    return (join_null_safe(x, offs.select("_pid", *group, "_off"), ["_pid", *group])
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_local", "_off"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` where null meets null; the right side's keys are dropped."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def batches(df: DataFrame, size: int, order: list[str], group: list[str] | None = None,
            out: str = "batch") -> DataFrame:
    """SNK6: cut rows into numbered batches of ``size`` (per group if given)."""
    x = numbered(df, list(group or []), order, out="_rn")
    return x.withColumn(out, F.floor((F.col("_rn") - 1) / F.lit(size)).cast("long")).drop("_rn")
