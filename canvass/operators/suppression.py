"""Suppression against long lists (J6, J8) without shuffling the rows that no list can touch.

``anti_split`` keeps the rows whose key is not listed, as a left anti join
does. A blocked Bloom filter of the listed keys is built as a small table
(one row per block, four 64-bit words, one bit in each word per key) and
broadcast: a row that misses it is certainly not listed and goes straight to the
result; only possible hits are shuffled and joined exactly, which also removes
the filter's false alarms.

The filter's size follows the number of listed keys and is bounded
(``MAX_BLOCKS``); a longer list than it can serve gets the plain anti join.
The input is read by both branches: stage an expensive one first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_BLOCK = 16       # some 2.5 bytes a key, one false alarm in about 300 rows
MAX_BLOCKS = 500_000      # some 40 MB as a broadcast table
_SEED = 7                 # parts the bits' hash from the block's


def _block(keys: list[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def _bits(keys: list[Column]) -> list[Column]:
    """Four masks of one bit each: six bits of a second hash for every word."""
    h = F.xxhash64(*keys, F.lit(_SEED))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int"))
            for i in range(4)]


def key_filter(listed: DataFrame, on: list[str], blocks: int) -> DataFrame:
    """The filter as a table: at most ``blocks`` rows, combined before the shuffle."""
    keys = [F.col(c) for c in on]
    rows = listed.select(_block(keys, blocks).alias("_block"), *[b.alias(f"_w{i}") for i, b in enumerate(_bits(keys))])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(4)])


def _comparable(df: DataFrame, listed: DataFrame, on: list[str]) -> bool:
    """Equal keys have equal hashes: same types, no fractions (0.0 equals -0.0)."""
    a, b = dict(df.dtypes), dict(listed.dtypes)
    return all(a[c] == b[c] and a[c] in ("tinyint", "smallint", "int", "bigint", "string", "date", "timestamp", "boolean")
               for c in on)


def split_by_filter(df: DataFrame, listed: DataFrame, on: list[str], blocks: int) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows that are certainly not listed, and possible hits."""
    keys = [F.col(c) for c in on]
    table = key_filter(listed, on, blocks)
    marked = df.withColumn("_block", _block(keys, blocks)).join(F.broadcast(table), "_block", "left")
    hit = reduce(lambda x, y: x & y, [F.col(f"_w{i}").bitwiseAND(b) != 0 for i, b in enumerate(_bits(keys))]
                 + [k.isNotNull() for k in keys])
    marked = marked.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    return marked.filter(~F.col("_hit")).select(*df.columns), marked.filter("_hit").select(*df.columns)


def anti_split(df: DataFrame, listed: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns equal no row of ``listed``.

    Keys with a null match nothing and stay (they are never shuffled); repeated
    rows stay repeated; repeated and null listed keys change nothing; other
    columns of ``listed`` are ignored. Keys of different types on the two sides,
    or of types with several forms of one value, get the plain join.
    """
    on = [on] if isinstance(on, str) else on
    listed = listed.select(*on).dropna()
    n = listed.count() if _comparable(df, listed, on) else None
    if n is None or n > KEYS_PER_BLOCK * MAX_BLOCKS:
        return df.join(listed, on, "left_anti").select(*df.columns)
    clear, hits = split_by_filter(df, listed, on, max(1, -(-n // KEYS_PER_BLOCK)))
    return clear.unionAll(hits.join(listed, on, "left_anti").select(*df.columns))
