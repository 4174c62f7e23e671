"""As-of phase mapping (J13), phase table (A12) and site-in-phase join.

``asof_bound`` finds, for every key, the latest boundary <= key (or earliest
>= key). Small boundary lists (checked) are broadcast into a range join.
Past the bound it runs a two-pass prefix scan over range partitions fixed by a
checkpoint: keys and boundaries together, a running max inside each partition,
then the last boundary of all earlier partitions (one row per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.operators.scan import fixed_ranges
from canvass.operators.sizing import row_count_at_most

# Up to so many boundaries a nested loop over a broadcast list is cheaper than
# the scan; both give the same rows.
BROADCAST_BOUNDARIES = 1_000
# Phases, by the blocks of days that make them up, which a task may hold.
BROADCAST_SPANS = 200_000
# Blocks of up to 2^24 days cover every date that Spark can write.
MAX_LEVEL = 24


def _asof_scan(keys: DataFrame, key: str, bounds: DataFrame, bcol: str, out: str,
               latest_le: bool) -> DataFrame:
    # For "earliest >= key" negate the order and reuse the "latest <=" scan.
    sign = 1 if latest_le else -1
    k = keys.select(F.col(key).alias("_key"), F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_b"))
    b = bounds.select(F.col(bcol).alias("_key"), F.lit(1).alias("_kind"), F.col(bcol).alias("_bv"))
    ordv = (F.unix_date(F.col("_key")) if dict(keys.dtypes)[key] == "date" else F.col("_key").cast("long")) * sign
    u = (k.withColumn("_bv", F.lit(None).cast(bounds.schema[bcol].dataType)).drop("_b")
         .unionByName(b).withColumn("_ord", ordv))
    nparts = max(1, keys.sparkSession.sparkContext.defaultParallelism)
    u = fixed_ranges(u, ["_ord"], nparts)
    # boundary before key on equal order: a boundary equal to the key counts
    w = (Window.partitionBy("_pid").orderBy(F.col("_ord"), F.col("_kind").desc())
         .rowsBetween(Window.unboundedPreceding, 0))
    agg = F.max if latest_le else F.min
    u = u.withColumn("_run", agg("_bv").over(w))
    carry = (u.groupBy("_pid").agg(agg("_bv").alias("_last"))
             .withColumn("_carry", agg("_last").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
             .select("_pid", "_carry"))
    # ``carry`` has one row per partition: bounded by construction.
    res = (u.filter(F.col("_kind") == 0).join(F.broadcast(carry), "_pid", "left")
           .select(F.col("_key").alias(key),
                   (F.greatest if latest_le else F.least)("_run", "_carry").alias(out)))
    return res


def asof_bound(keys: DataFrame, key: str, bounds: DataFrame, bcol: str, out: str,
               latest_le: bool = True, bounds_small: bool | None = None) -> DataFrame:
    """Distinct ``key`` values with the latest boundary <= key (``latest_le``)
    or the earliest boundary >= key. Keys with no such boundary get null.
    ``bounds_small`` passes a size check the caller already made."""
    keys = keys.select(key).distinct()
    bounds = bounds.select(bcol).distinct()
    if bounds_small is None:
        bounds_small = row_count_at_most(bounds, BROADCAST_BOUNDARIES)
    if bounds_small:
        cond = (F.col(bcol) <= F.col(key)) if latest_le else (F.col(bcol) >= F.col(key))
        agg = F.max if latest_le else F.min
        return (keys.join(F.broadcast(bounds), cond, "left")
                .groupBy(key).agg(agg(bcol).alias(out)))
    return _asof_scan(keys, key, bounds, bcol, out, latest_le)


def assign_phase(days: DataFrame, day_col: str, starts: DataFrame, ends: DataFrame,
                 boundary_col: str = "boundary") -> DataFrame:
    """Each day with the latest start <= day and earliest end >= day.
    A day missing either side disappears (the reference's inner joins)."""
    # one size check covers both lists: each is at most as long as their union
    small = row_count_at_most(starts.select(boundary_col).unionByName(ends.select(boundary_col)),
                              BROADCAST_BOUNDARIES)
    s = asof_bound(days, day_col, starts, boundary_col, "timeframe_start", latest_le=True, bounds_small=small)
    e = asof_bound(days, day_col, ends, boundary_col, "timeframe_end", latest_le=False, bounds_small=small)
    return (s.join(e, day_col).filter(F.col("timeframe_start").isNotNull() & F.col("timeframe_end").isNotNull())
            .withColumn("timeframe", F.lit("Phase")))


def phase_table(mapping: DataFrame) -> DataFrame:
    """One row per phase."""
    return mapping.select("timeframe", "timeframe_start", "timeframe_end").distinct()


def _dyadic_nodes(start: Column, stop: Column) -> Column:
    """The canonical dyadic blocks of days that make up [start, stop): disjoint,
    at most two per level, so O(log length) of them. At level ``k`` the open
    part runs from ceil(start / 2^k) to floor(stop / 2^k); an odd first block
    and the block before an odd end belong to no larger block and are taken."""
    blocks = []
    for k in range(MAX_LEVEL + 1):
        lo, hi = F.ceil(start / 2 ** k).cast("long"), F.floor(stop / 2 ** k).cast("long")
        blocks += [F.when((lo < hi) & (F.pmod(lo, F.lit(2)) == 1), F.struct(F.lit(k).alias("level"), lo.alias("block"))),
                   F.when((lo < hi) & (F.pmod(hi, F.lit(2)) == 1), F.struct(F.lit(k).alias("level"), (hi - 1).alias("block")))]
    return F.filter(F.array(*blocks), lambda b: b.isNotNull())


def sites_by_phase(sites: DataFrame, phases: DataFrame) -> DataFrame:
    """Sites whose start lies inside a phase (and still open at its start);
    phases may overlap and be of any lengths.

    A dyadic interval index: a phase is listed under the O(log) disjoint blocks
    of 2^k days that make it up, a site under the one block of every level that
    holds its start (levels that no phase uses are left out). They meet by an
    equi join on (level, block). A phase's blocks are disjoint, so each (site,
    phase) pair appears once, and the list stays within 2 log2(length) rows a
    phase whether it lasts a day or decades. It is broadcast while it is small
    (checked).

    A null in either date of a phase, a phase that ends before it starts and a
    site without a start or an end match nothing. Repeated phases or sites give
    repeated rows, as in SQL.
    """
    ph = phases.select("timeframe_start", "timeframe_end").where("timeframe_start <= timeframe_end")
    nodes = _dyadic_nodes(F.unix_date(F.col("timeframe_start").cast("date")).cast("long"),
                          F.unix_date(F.col("timeframe_end").cast("date")).cast("long") + 1)
    listed = (ph.withColumn("_node", F.explode(nodes))
              .select("timeframe_start", "timeframe_end", F.col("_node.level").alias("_level"),
                      F.col("_node.block").alias("_block")))
    # one number and at most MAX_LEVEL + 1 levels
    rows, used = listed.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("_level"))).first()
    day = F.unix_date(F.col("start_date").cast("date"))
    holding = [F.struct(F.lit(k).alias("_level"), F.floor(day / 2 ** k).alias("_block")) for k in used]
    if not used:
        holding = [F.lit(None).cast("struct<_level:int,_block:bigint>")]
    at = sites.withColumn("_at", F.explode(F.array(*holding))).select("*", "_at._level", "_at._block").drop("_at")
    listed = F.broadcast(listed) if rows <= BROADCAST_SPANS else listed
    return (at.join(listed, ["_level", "_block"])
            .where((F.col("start_date") <= F.col("timeframe_end")) & (F.col("start_date") >= F.col("timeframe_start"))
                   & (F.col("end_date") >= F.col("timeframe_start"))).drop("_level", "_block"))
