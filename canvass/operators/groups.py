"""Audience groups (F23, A11, S4, S5, SNK4, O5).

Memberships stay long — one row per (group, target, member) — so a group
holding a third of everyone is just many rows spread over many tasks, never
one collected list. Lists for an API call are cut later by ``scan.batches``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.arrays import present


def time_buckets(df: DataFrame, ts: str, as_of: str, names: list[tuple[Column, Column]]) -> DataFrame:
    """a row may land in several groups; ``names`` pairs (condition, group
    name). Returns the input rows exploded to one row per matching group."""
    arr = present(*[F.when(cond, name) for cond, name in names])
    return df.withColumn("group_name", F.explode(arr))


def group_members(memberships: DataFrame, group: str, target: str, member: str,
                  keep_empty_targets: list[str] | None = None, all_groups: DataFrame | None = None) -> DataFrame:
    """Distinct members per (group, target). For targets listed in
    ``keep_empty_targets`` every group of ``all_groups`` appears, with a null
    member when it has none (the SMS side keeps empty lists; the CRM side
    drops them)."""
    m = memberships.filter(F.col(member).isNotNull()).select(group, target, member).distinct()
    if keep_empty_targets and all_groups is not None:
        empty = (all_groups.select(group).distinct()
                 .withColumn(target, F.explode(F.array(*[F.lit(t) for t in keep_empty_targets])))
                 .join(m.select(group, target).distinct(), [group, target], "left_anti")
                 .withColumn(member, F.lit(None).cast(m.schema[member].dataType)))
        m = m.unionByName(empty)
    return m


def membership_delta(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``add`` for members only in ``new``, ``remove`` for members only in
    ``old`` (one full outer join on the membership key)."""
    o = old.select(*keys).distinct().withColumn("_o", F.lit(True))
    n = new.select(*keys).distinct().withColumn("_n", F.lit(True))
    j = o.join(n, keys, "full_outer")
    return (j.filter(F.col("_o").isNull() | F.col("_n").isNull())
            .select(*keys, F.when(F.col("_n").isNull(), F.lit("remove")).otherwise(F.lit("add")).alias("change")))


def delta_counts(old: DataFrame, new: DataFrame, group: str, member: str) -> DataFrame:
    """S4 counts: old, new, to-add and to-remove per group."""
    d = membership_delta(old, new, [group, member])
    oc = old.select(group, member).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("old_count"))
    nc = new.select(group, member).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("new_count"))
    dc = d.groupBy(group).agg(F.count_if(F.col("change") == "add").alias("to_add"),
                              F.count_if(F.col("change") == "remove").alias("to_remove"))
    return oc.join(nc, group, "full_outer").join(dc, group, "left").na.fill(0)


def new_groups(created: DataFrame, existing: DataFrame, group: str, kind: str) -> DataFrame:
    """Only groups not logged before; id is ``kind:group``."""
    c = created.select(group).distinct()
    return (c.join(existing.select(group).distinct(), group, "left_anti")
            .withColumn("group_id", F.concat(F.lit(f"{kind}:"), F.col(group))))


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """SNK4: delete-then-insert by primary key."""
    return existing.join(incoming.select(*key).distinct(), key, "left_anti").unionByName(incoming)


def first_groups(groups: DataFrame, group: str, n: int) -> DataFrame:
    """The first ``n`` groups by name (a limit that is the feature)."""
    return groups.select(group).distinct().orderBy(F.col(group).asc()).limit(n)
