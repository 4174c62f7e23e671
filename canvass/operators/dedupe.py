"""One-row-per-key operators.

Aggregates (``max``, ``max_by``) are preferred to windows where no ranking is
needed: they combine map-side, so a hot key costs one partial row per task
instead of one sorted window partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_by_key(df: DataFrame, key: Column | str, attrs: list[str], key_name: str = "key",
                 count_as: str | None = None) -> DataFrame:
    """A1: one row per key, ``MAX`` of every attribute and, if asked for, the
    number of rows. A null key forms its own group (SQL ``GROUP BY``)."""
    k = F.col(key) if isinstance(key, str) else key
    aggs = [F.max(a).alias(a) for a in attrs] + ([F.count(F.lit(1)).alias(count_as)] if count_as else [])
    return df.groupBy(k.alias(key_name)).agg(*aggs)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key under ``order``. ``order`` must end
    in a unique tie-breaker and state its nulls placement. Catalyst turns
    ``row_number() = 1`` into a partial WindowGroupLimit before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") == 1).drop("_rn")


def latest_by(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """W2/W3 without a window: ``max_by`` on a struct of the ordering columns.
    Returns the keys plus ``cols`` of the greatest row (ties go to the last
    ordering column, so make it unique)."""
    ordering = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(c) for c in cols])
    best = df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in cols])


def union_feeds(*dfs: DataFrame) -> DataFrame:
    """Bag union of feeds sharing a layout (by column name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_union(*dfs: DataFrame) -> DataFrame:
    """Set union."""
    return union_feeds(*dfs).distinct()
