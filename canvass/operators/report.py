"""Result report row (AR1, O2, O3, X11, X12): nested results -> 59 text cells.

All array work is higher-order built-ins over one event's own (small)
results array: no explode, no shuffle, no Python.

Cells: 8 metadata, 2 per main candidate (13 candidates in the original
configuration; 0 by default for alignment and realignment events, blank
otherwise), 5 x 3 top write-ins (top five by votes, input order on equal
votes, then listed by name), 3 overflow cells ("name: votes -> delegates"
joined by "; ", vote sum, delegate sum), 3 x 2 ties (key = sorted member
names, value = sorted winners; first three in order) and 1 tie overflow.
Nulls become ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.timefmt import report_time

# The main-candidate list (13 names in sheet order in the original report)
# is run configuration and is passed in by the caller.
ZERO_DEFAULT_EVENTS = ["alignment", "realignment"]
TOP_WRITE_INS = 5
TOP_TIES = 3


def _cmp(a: Column, b: Column) -> Column:
    return F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)).otherwise(F.lit(0))


def event_id(phone: Column, precinct: Column, created_at: Column) -> Column:
    """``phone|precinct|epoch millis``."""
    return F.concat_ws("|", phone, precinct, F.unix_millis(created_at).cast("string"))


def _stage_arrays(df: DataFrame, results: str, main: list[str]) -> DataFrame:
    """Sorted write-ins and ties, computed once per row as columns (cells
    below refer to them, so they are not rebuilt for every cell)."""
    res = F.coalesce(F.col(results), F.array())
    mains = F.array(*[F.lit(m) for m in main])
    w = F.filter(F.transform(res, lambda r, i: F.struct(r["name"].alias("name"), r["caucusers"].alias("c"),
                                                        r["delegates"].alias("d"), i.alias("i"))),
                 lambda r: ~F.array_contains(mains, r["name"]))
    by_votes = F.array_sort(w, lambda a, b: F.when(a["c"] > b["c"], -1).when(a["c"] < b["c"], 1)
                            .otherwise(_cmp(a["i"], b["i"])))
    ranked = F.transform(by_votes, lambda r, j: F.struct(r["name"].alias("name"), r["c"].alias("c"),
                                                         r["d"].alias("d"), j.alias("j")))
    won = F.filter(res, lambda r: r["tieStatus"] == F.lit("won"))
    keyed = F.transform(won, lambda r: F.struct(
        F.array_join(F.sort_array(F.concat(F.array(r["name"]), F.coalesce(r["ties"], F.array().cast("array<string>")))),
                     " ").alias("k"), r["name"].alias("n")))
    # name -> (votes, delegates); a repeated name keeps its last entry
    # (the session's LAST_WIN map-key policy), like a dict update.
    by_name = F.map_from_entries(F.transform(res, lambda r: F.struct(
        r["name"], F.struct(r["caucusers"].alias("c"), r["delegates"].alias("d")))))
    x = (df.withColumn("_res", res).withColumn("_main", by_name)
         .withColumn("_ranked", ranked).withColumn("_keyed", keyed))
    top = F.array_sort(F.slice("_ranked", 1, TOP_WRITE_INS),
                       lambda a, b: F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1)
                       .otherwise(_cmp(a["j"], b["j"])))
    keys = F.array_distinct(F.transform("_keyed", lambda t: t["k"]))
    ties = F.array_sort(F.transform(keys, lambda k: F.struct(k.alias("k"), F.array_join(F.array_sort(F.array_distinct(
        F.transform(F.filter("_keyed", lambda t: t["k"] == k), lambda t: t["n"]))), " ").alias("v"))))
    return (x.withColumn("_top", top).withColumn("_over", F.slice("_ranked", F.lit(TOP_WRITE_INS + 1), F.greatest(F.size("_ranked"), F.lit(1))))
            .withColumn("_ties", ties))


def _cells(event_type: Column, meta: list[Column], main: list[str]) -> Column:
    zero_default = event_type.isin(ZERO_DEFAULT_EVENTS)
    cells: list[Column] = list(meta)
    for name in main:
        hit = F.try_element_at(F.col("_main"), F.lit(name))
        for f in ("c", "d"):
            cells.append(F.when(hit.isNotNull(), hit[f]).when(zero_default, F.lit(0)))
    for k in range(TOP_WRITE_INS):
        e = F.get(F.col("_top"), k)
        cells += [e["name"], e["c"], e["d"]]
    over = F.col("_over")
    has_over = F.size(over) > 0
    cells.append(F.when(has_over, F.array_join(F.transform(over, lambda r: F.concat(
        r["name"], F.lit(": "), r["c"].cast("string"), F.lit(" -> "), r["d"].cast("string"))), "; ")))
    cells.append(F.when(has_over, F.aggregate(over, F.lit(0).cast("long"), lambda acc, r: acc + r["c"])))
    cells.append(F.when(has_over, F.aggregate(over, F.lit(0).cast("long"), lambda acc, r: acc + r["d"])))
    for k in range(TOP_TIES):
        e = F.get(F.col("_ties"), k)
        cells += [e["k"], e["v"]]
    tover = F.slice("_ties", F.lit(TOP_TIES + 1), F.greatest(F.size("_ties"), F.lit(1)))
    cells.append(F.when(F.size(tover) > 0, F.array_join(
        F.transform(tover, lambda t: F.concat(t["k"], F.lit(": "), t["v"])), "; ")))
    return F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in cells])


def result_report(events: DataFrame, main: list[str], media_url: str = "media_url") -> DataFrame:
    """AR1: one 59-cell report row per result event."""
    staged = _stage_arrays(events, "results", main)
    meta = [F.col("id"), F.col("precinct_id"), F.col("phone_number"), F.col("event_type"),
            report_time(F.col("created_at")), F.col("notes"), F.col(media_url),
            F.coalesce(F.col("attendee_count"), F.lit(0))]
    return staged.select("id", _cells(F.col("event_type"), meta, main).alias("cells"))
