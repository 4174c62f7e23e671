"""Size checks behind every broadcast.

A side is broadcast only after a bounded count proves it small: the count
reads at most ``limit + 1`` rows. Over a plain scan that is all the work; over
an aggregate or a distinct list the check runs it once more. Past the bound the caller gets the
frame back unchanged and Spark plans a shuffle join (AQE may still switch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count_at_most(df: DataFrame, limit: int) -> bool:
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
