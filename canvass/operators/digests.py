"""Diffs that leave equal ranges of keys aside (D1, D2, S4 on large tables).

Two versions of a table mostly agree. Both sides are cut into ranges of keys and
every range is summed up by one digest: the number of rows, a sum and an exclusive or of two 64-bit hashes
of the rows. The aggregate has fixed-width buffers and combines before the
shuffle, so its shuffle is one small row per range and task. Only rows of ranges whose digests differ go on to the full
diff; rows are compared as bags, so an equal digest means equal rows (but for a
collision of 128 bits of hashes).

``range_of`` names a row's range, from the key alone and by the same rule on both sides.
Where tables are stored in key order, ranges of consecutive keys (``key_range``)
keep the digests few and the changed rows together; ``hash_range`` serves any
key, then 1 % of changed rows spread evenly touch about as many per cent of the
ranges as a range holds rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.operators import diff as DF
from canvass.operators import groups as G
from canvass.operators.sizing import broadcast_if_small

CHANGED_RANGES = 500_000     # changed ranges (one long each) are broadcast up to so many


def key_range(key: str, width: int) -> Column:
    """Ranges of ``width`` consecutive whole-number keys."""
    return F.floor(F.col(key) / width).cast("long")


def hash_range(keys: list[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("long")


def digests(df: DataFrame, values: list[Column], range_of: Column) -> DataFrame:
    """(_range, _n, _s, _x) per range; a null range is one of its own (the least long)."""
    x = df.select(F.coalesce(range_of, F.lit(-2 ** 63)).alias("_range"), F.xxhash64(*values).alias("_h"),
                  F.xxhash64(F.lit("second"), *[_marked(v) for v in values]).alias("_g"))
    return x.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("_s"),
                                   F.bit_xor("_g").alias("_x"))


def _marked(v: Column) -> Column:
    # a null leaves a hash as it is: the mark keeps (null, 1) and (1, null) apart
    return F.struct(v.isNull().alias("n"), v.alias("v"))


def changed_ranges(a: DataFrame, b: DataFrame, a_values: list[Column], b_values: list[Column], range_of: Column) -> DataFrame:
    """``_range`` of every range that is not the same bag of values on both sides."""
    da = digests(a, [_marked(v) for v in a_values], range_of)
    db = digests(b, [_marked(v) for v in b_values], range_of).select("_range", *[F.col(c).alias(f"{c}2") for c in ("_n", "_s", "_x")])
    same = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"{c}2")) for c in ("_n", "_s", "_x")])
    return da.join(db, "_range", "full_outer").where(~same).select("_range")


def only_changed(a: DataFrame, b: DataFrame, a_values: list[Column], b_values: list[Column],
                 range_of: Column) -> tuple[DataFrame, DataFrame]:
    """Both sides without the ranges that agree. The changed ranges are kept in the checkpoint folder: both sides read them."""
    changed = changed_ranges(a, b, a_values, b_values, range_of).checkpoint(eager=True)
    changed = broadcast_if_small(changed, CHANGED_RANGES)

    def cut(df: DataFrame) -> DataFrame:
        return df.withColumn("_range", F.coalesce(range_of, F.lit(-2 ** 63))).join(changed, "_range", "left_semi").drop("_range")
    return cut(a), cut(b)


def membership_delta(old: DataFrame, new: DataFrame, keys: list[str], range_of: Column) -> DataFrame:
    """S4, same rows as ``groups.membership_delta``. A repeated membership only makes its range look changed."""
    values = [F.col(k) for k in keys]
    return G.membership_delta(*only_changed(old.select(*keys), new.select(*keys), values, values, range_of), keys)


def _canonical(kind: str, wanted_text: bool) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """(stored, wanted) -> text that is equal only where the field needs no update. Blank stored
    values and null wanted ones are ``-``; a value that cannot be read as the field's kind equals no wanted value."""
    def number(c: Column) -> Column:
        return c.try_cast("double").cast("string")

    def read(c: Column) -> Column:
        if kind == DF.DATE:
            return c.try_cast("date").cast("string")
        if kind == DF.YESNO:
            return number(F.when(c.cast("string") == "Yes", F.lit("1")).when(c.cast("string") == "No", F.lit("0")).otherwise(c.cast("string")))
        return c.cast("string") if wanted_text and kind == DF.PLAIN else number(c)

    def stored(o: Column) -> Column:
        return F.when(o.isNull() | (o == ""), F.lit("-")).otherwise(F.coalesce(F.concat(F.lit("="), read(o)), F.lit("?stored")))

    def wanted(n: Column) -> Column:
        if kind == DF.YESNO:
            value = number(n.cast("string"))          # a wanted 'Yes' is no number: never equal
        else:
            value = read(n)
        return F.when(n.isNull(), F.lit("-")).otherwise(F.coalesce(F.concat(F.lit("="), value), F.lit("?wanted")))
    return stored, wanted


def diff_fields(stored: DataFrame, wanted: DataFrame, key: str, rules: list[DF.FieldRule], range_of: Column,
                sms: bool = False) -> DataFrame:
    """D1 / D2, same rows as ``diff.diff_fields``. Keys that only one side has make their range look changed."""
    kinds = dict(wanted.dtypes)
    live = [r for r in rules if r.kind != DF.IGNORE]
    both = [_canonical(r.kind if sms else DF.PLAIN, kinds[r.name] == "string") for r in live]
    s_values = [F.col(key), *[s(F.col(r.name)) for (s, _), r in zip(both, live)]]
    w_values = [F.col(key), *[w(F.col(r.name)) for (_, w), r in zip(both, live)]]
    s, w = only_changed(stored, wanted, s_values, w_values, range_of)
    return DF.diff_fields(s, w, key, rules, sms)
