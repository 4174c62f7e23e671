"""Join operators.

Equi joins are left to Catalyst + AQE: a side that turns out small at run
time is switched to a broadcast by AQE (a measured size bound), everything
else is a sort-merge join with skew splitting. Explicit broadcasts are used
only for config tables whose size is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.operators.sizing import broadcast_if_small

CONFIG_ROWS = 100_000


def flag_in(df: DataFrame, universe: DataFrame, key: str, name: str,
            universe_key: str | None = None) -> DataFrame:
    """0/1 membership flag. The universe is reduced to distinct keys first,
    so duplicates on the right never fan rows out. Written as a left join on
    a distinct key set (the planner turns it into a hash/sort-merge join)."""
    u = universe.select(F.col(universe_key or key).alias(key)).distinct().withColumn(name, F.lit(1))
    return df.join(u, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def left_join_where(df: DataFrame, right: DataFrame, on: list[str], right_pred: Column | None,
                    how: str = "left") -> DataFrame:
    """A predicate that belongs to the right side of an outer join is
    applied to the right input before the join (not in WHERE)."""
    r = right.filter(right_pred) if right_pred is not None else right
    return df.join(r, on, how)


def subtract_known(df: DataFrame, known: DataFrame, on: list[str] | str,
                   known_on: list[str] | str | None = None) -> DataFrame:
    """Rows whose key is not in ``known`` (left anti join). Null keys
    survive, as with ``LEFT JOIN ... WHERE known.key IS NULL``."""
    on = [on] if isinstance(on, str) else on
    kon = known_on or on
    kon = [kon] if isinstance(kon, str) else kon
    k = known.select(*[F.col(a).alias(b) for a, b in zip(kon, on)])
    cond = None
    for c in on:
        e = df[c] == k[c]
        cond = e if cond is None else cond & e
    return df.join(k, cond, "left_anti")


def semi(df: DataFrame, other: DataFrame, on: list[str] | str) -> DataFrame:
    """``IN (subquery)`` / left join + ``IS NOT NULL``."""
    return df.join(other, on, "left_semi")


def suppress(df: DataFrame, lists: DataFrame, key: str, scope: str) -> DataFrame:
    """Per-scope suppression (e.g. per state): one anti join on
    (scope, key), each list only suppressing rows of its own scope."""
    return df.join(lists.select(scope, key).distinct(), [scope, key], "left_anti")


def classify_phone(df: DataFrame, phone: str, blocks: DataFrame, to_wireless: DataFrame,
                   to_landline: DataFrame, out: str = "phone_type",
                   landline_wins: bool = True) -> DataFrame:
    """``C`` when the 7-digit block is wireless or the number was ported
    to wireless, ``L`` when ported to landline (wins over both when
    ``landline_wins``), else null. Reference lists are reduced to distinct
    keys and joined as flags; small ones are broadcast after a size check."""
    b = broadcast_if_small(blocks.select(F.col(blocks.columns[0]).alias("_block")).distinct()
                           .withColumn("_wb", F.lit(True)), CONFIG_ROWS)
    w = to_wireless.select(F.col(to_wireless.columns[0]).alias(phone)).distinct().withColumn("_pw", F.lit(True))
    ll = to_landline.select(F.col(to_landline.columns[0]).alias(phone)).distinct().withColumn("_pl", F.lit(True))
    x = (df.withColumn("_block", F.substring(F.col(phone), 1, 7))
         .join(b, "_block", "left").join(w, phone, "left").join(ll, phone, "left"))
    wireless = F.coalesce(F.col("_wb"), F.lit(False)) | F.coalesce(F.col("_pw"), F.lit(False))
    landline = F.coalesce(F.col("_pl"), F.lit(False))
    if landline_wins:
        t = F.when(landline, F.lit("L")).when(wireless, F.lit("C"))
    else:
        t = F.when(wireless, F.lit("C"))
    return x.withColumn(out, t).drop("_block", "_wb", "_pw", "_pl")


def fallback_lookup(requests: DataFrame, req_key: Column, table: DataFrame, exact_key: str,
                    loose_key: Column, value_cols: list[str]) -> DataFrame:
    """Exact key first, else a looser key; ``coalesce`` of two left
    joins. The looser side is reduced to one row per loose key first."""
    exact = table.select(F.col(exact_key).alias("_ek"), *[F.col(c).alias(f"_e_{c}") for c in value_cols])
    loose = (table.select(loose_key.alias("_lk"), *value_cols)
             .groupBy("_lk").agg(*[F.min(c).alias(f"_l_{c}") for c in value_cols]))
    r = (requests.withColumn("_rk", req_key)
         .join(exact, F.col("_rk") == F.col("_ek"), "left")
         .join(loose, F.lower(F.col("_rk")) == F.col("_lk"), "left"))
    for c in value_cols:
        r = r.withColumn(c, F.coalesce(F.col(f"_e_{c}"), F.col(f"_l_{c}")))
    return r.drop("_rk", "_ek", "_lk", *[f"_e_{c}" for c in value_cols], *[f"_l_{c}" for c in value_cols])


def tag_lists(keys: DataFrame, scopes: list[str], scope: str) -> DataFrame:
    """Copy a key list once per configured scope (a short constant list)."""
    return keys.withColumn(scope, F.explode(F.array(*[F.lit(s) for s in scopes])))


def eligible_or_resubscribe(combined: DataFrame, known: DataFrame, blacklist: DataFrame,
                            email: str, action_epoch: str) -> DataFrame:
    """J7 + F2: contacts not already known, plus known ones whose last
    unsubscribe is older than their latest qualifying action; never a
    blacklisted one. Both matches use the dotless email key. Emits
    ``is_resubscribe`` (known side matched) and ``unsub_epoch``."""
    def key(c):
        return F.replace(F.trim(F.lower(c)), F.lit("."), F.lit(""))
    k = known.select(key(F.col("email")).alias("_k"), F.col("email").alias("_known_email"),
                     "unsub_epoch", "isunsub")
    b = blacklist.select(key(F.col(blacklist.columns[0])).alias("_k")).distinct()
    x = combined.withColumn("_k", key(F.col(email)))
    x = x.join(k, "_k", "left").join(b, "_k", "left_anti")
    keep = (F.col("_known_email").isNull()
            | (F.col("isunsub") & F.col("unsub_epoch").isNotNull() & (F.col("unsub_epoch") < F.col(action_epoch))))
    return (x.filter(keep).withColumn("is_resubscribe", F.col("_known_email").isNotNull())
            .drop("_k", "_known_email", "isunsub"))
