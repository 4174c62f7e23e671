"""Aggregations (A3-A6, A8, A9, A10, J18 identity match).

All are hash aggregates with map-side partial aggregation, so a hot key
adds one partial row per task, not a skewed task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions import contacts as C


def precinct_stats(df: DataFrame, precinct: str, person: str, score: str) -> DataFrame:
    """A3: persons, total, scored persons and mean score per precinct.
    With no scored person the mean (and the total) is null."""
    return (df.groupBy(precinct)
            .agg(F.count(person).alias("persons"), F.sum(score).alias("total_score"),
                 F.count(score).alias("persons_scored"))
            .withColumn("avg_score", F.try_divide(F.col("total_score"), F.col("persons_scored"))))


def bulk_users(df: DataFrame, user: str, day: Column, item: str, threshold: int) -> DataFrame:
    """A4: users with more than ``threshold`` distinct items on any one day."""
    per_day = df.groupBy(F.col(user), day.alias("_day")).agg(F.count_distinct(item).alias("_n"))
    return per_day.filter(F.col("_n") > threshold).select(user).distinct()


def sub_state(df: DataFrame, key: Column, unsub_epoch: Column, is_unsub: Column) -> DataFrame:
    """A5: latest unsubscribe time and "ever unsubscribed" per key
    (``bool_or`` ignores nulls; all-null gives null)."""
    return df.groupBy(key.alias("email")).agg(F.max(unsub_epoch).alias("unsub_epoch"),
                                              F.bool_or(is_unsub).alias("isunsub"))


def blacklist(df: DataFrame, email: str, is_resub: str, reason: str, hard: str = "%deadrcpt%") -> DataFrame:
    """Two or more unsubscribes (or resubscribes), or any hard bounce."""
    repeat = df.groupBy(email, is_resub).agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 2").select(email)
    bounced = df.filter(F.col(reason).ilike(hard)).select(email)
    return repeat.union(bounced).distinct()


def max_id(df: DataFrame, key: str, id_col: str, out: str) -> DataFrame:
    """Greatest foreign id per key."""
    return df.groupBy(key).agg(F.max(id_col).alias(out))


def counts_by(df: DataFrame, by: str, rejected: Column | None = None) -> DataFrame:
    """Rows per type, plus rejected rows when a predicate is given."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if rejected is not None:
        aggs.append(F.count_if(rejected).alias("n_rejected"))
    return df.groupBy(by).agg(*aggs)


def pivot_fields(df: DataFrame, key: str, name: str, value: str, fields: list[str],
                 ids: DataFrame | None = None) -> DataFrame:
    """A10: long (key, name, value) -> one column per configured field.
    One shuffle (the pivot's group by) instead of one self join per field.
    With ``ids`` every id stays, with nulls where it has no fields."""
    wide = df.filter(F.col(name).isin(fields)).groupBy(key).pivot(name, fields).agg(F.max(value))
    if ids is not None:
        wide = ids.select(key).distinct().join(wide, key, "left")
    return wide


def canonical_identity(people: DataFrame, email: str, phone: str) -> DataFrame:
    """``people`` with ``identity_id``, one id per (canonical e-mail,
    canonical phone) pair; a missing part is part of the pair. The columns
    ``email`` and ``phone`` become canonical."""
    e = F.nullif(F.lower(F.trim(F.col(email))), F.lit(""))
    p = C.extract_phone(F.col(phone))
    pair = F.concat(F.coalesce(e, F.lit("")), F.lit("|"), F.coalesce(p, F.lit("")))
    return people.withColumns({"email": e, "phone": p, "identity_id": F.md5(pair)})


def match_identity(users: DataFrame, crm: DataFrame, sms: DataFrame, key: str = "user_id") -> DataFrame:
    """Long (key, target, member_id): all CRM ids with the user's e-mail,
    and the SMS profiles with the user's phone or, where none has it, with the
    user's e-mail. Only active, not opted-out profiles count.

    ``users``: key, email, phone (canonical); ``crm``: email, cons_id; ``sms``:
    phone, email, profile_id, status, opted_out_at. Sets stay rows, so nothing
    is cut to one id and no list is collected.
    """
    def canon(c: str):
        return F.lower(F.trim(F.col(c)))

    by_crm = users.join(crm.select(canon("email").alias("email"), F.col("cons_id").alias("member_id")), "email")
    active = sms.filter((F.col("status") == "Active Subscriber") & F.col("opted_out_at").isNull())
    by_phone = users.join(active.select("phone", F.col("profile_id").alias("member_id")), "phone")
    by_email = (users.join(by_phone.select(key).distinct(), key, "left_anti")
                .join(active.select(canon("email").alias("email"), F.col("profile_id").alias("member_id")), "email"))
    return (by_crm.select(key, F.lit("crm").alias("target"), "member_id")
            .unionByName(by_phone.select(key, F.lit("sms").alias("target"), "member_id"))
            .unionByName(by_email.select(key, F.lit("sms").alias("target"), "member_id"))
            .distinct())
