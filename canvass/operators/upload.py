"""Upload of new people from merged contact feeds (P3): which rows are sent, turned away, already there.

Input rows carry ``LAYOUT`` and what the re-subscribe rule adds
(``is_resubscribe``, ``unsub_epoch``). Rows of a source type are taken in the
order (e-mail, id); an address that is not deliverable is turned away and does not
count towards the type's limit; rows after the limit-th accepted one are not
looked at in this run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions import filters as FL
from canvass.operators import joins as J
from canvass.operators.sizing import broadcast_if_small
from canvass.sources import sinks as SK

PERSON = ["first_name", "last_name", "postal_code", "addr1", "addr2", "city", "state_cd", "phone_number"]
LAYOUT = ["email", *PERSON, "ext_type", "ext_id", "source", "subsource", "action_epoch"]
ORDER = ["email", "ext_id"]


def feed(df: DataFrame, ext_type: str, **cols: Column) -> DataFrame:
    """One feed in the common layout: columns given by name, the others null; ``action_epoch`` is a number, all else text."""
    kinds = {c: "double" if c == "action_epoch" else "string" for c in LAYOUT}
    values = {**cols, "ext_type": F.lit(ext_type)}
    return df.select(*[(values[c] if c in values else F.lit(None)).cast(kinds[c]).alias(c) for c in LAYOUT])


def deliverable(df: DataFrame, email: str, domains: DataFrame, out: str) -> DataFrame:
    """Whole-string syntax and a known domain (``domains``: one column of names, each known good)."""
    good = domains.select(F.lower(domains.columns[0]).alias("_domain")).where("_domain is not null").distinct().withColumn("_good", F.lit(True))
    return (df.withColumn("_domain", FL.email_domain(email)).join(broadcast_if_small(good, J.CONFIG_ROWS), "_domain", "left")
            .withColumn(out, F.coalesce(FL.email_syntax_ok(email) & F.col("_good"), F.lit(False))).drop("_domain", "_good"))


def within_limit(df: DataFrame, accepted: str, limit: int | None) -> DataFrame:
    """W8 for a run that counts only accepted rows: rows of each type up to and with the one that fills its limit.
    The literal limit cuts every partition before the shuffle; one row a type is then joined back."""
    if limit is None:
        return df
    place = F.struct(*ORDER)
    rank = F.row_number().over(Window.partitionBy("ext_type").orderBy(place))
    last = (df.where(F.col(accepted)).select("ext_type", *ORDER).withColumn("_rn", rank).where(F.col("_rn") <= limit)
            .groupBy("ext_type").agg(F.max(place).alias("_last"), F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= limit).drop("_n"))
    return (df.join(broadcast_if_small(last, J.CONFIG_ROWS), "ext_type", "left")
            .where(F.col("_last").isNull() | (place <= F.col("_last"))).drop("_last"))


def process(candidates: DataFrame, domains: DataFrame, existing: DataFrame, replies: DataFrame | None = None,
            limit: int | None = None, dry_run: bool = False) -> DataFrame:
    """Every row looked at, with ``outcome`` and what the log keeps of it.

    ``existing`` (email): addresses the target has. ``replies`` (email, was_new, was_error):
    saved answers of the target to creations, one row an address; without one, both are null.
    ``outcome``: ``rejected`` (not deliverable), ``resubscribe`` (known, not sent), ``create``.
    ``was_new``: of a dry run, whether the address is missing there; of a creation, the
    answer; else null. ``limit`` as in ``within_limit`` (ids and types are not null).
    """
    x = deliverable(candidates, "email", domains, "_valid")
    if limit is not None:       # read twice: once for the rows that fill the limits, once to cut
        x = within_limit(x.checkpoint(eager=True), "_valid", limit)
    x = x.withColumn("_address", C.canon_email("email"))
    have = existing.select(C.canon_email(existing.columns[0]).alias("_address"))
    x = J.flag_in(x, have, "_address", "_have")
    outcome = (F.when(~F.col("_valid"), F.lit("rejected")).when(F.col("is_resubscribe"), F.lit("resubscribe"))
               .otherwise(F.lit("create")))
    x = x.withColumn("outcome", outcome).withColumn("did_exist", F.when(F.col("_valid"), F.col("_have") == 1))
    if dry_run or replies is None:
        new = F.when(F.col("_valid"), ~F.col("did_exist")) if dry_run else F.lit(None).cast("boolean")
        x = x.withColumn("was_new", new).withColumn("was_error", F.lit(None).cast("boolean"))
    else:
        r = replies.select(C.canon_email("email").alias("_address"), F.col("was_new").alias("_new"), F.col("was_error").alias("_error"))
        sent = F.col("outcome") == "create"
        x = (x.join(r, "_address", "left").withColumn("was_new", F.when(sent, F.col("_new")))
             .withColumn("was_error", F.when(sent, F.col("_error"))).drop("_new", "_error"))
    return x.drop("_address", "_valid", "_have")


def run_counts(seen: DataFrame) -> DataFrame:
    """Rows, creations, new people, re-subscriptions and rejected rows per source type."""
    def n(cond: Column) -> Column:
        return F.count_if(F.coalesce(cond, F.lit(False)))
    made = F.col("outcome") == "create"
    return seen.groupBy("ext_type").agg(
        F.count(F.lit(1)).alias("n_rows"), n(made).alias("n_sent"),
        n(F.col("was_new") & ~F.coalesce("was_error", F.lit(False))).alias("n_new"),
        n(F.col("outcome") == "resubscribe").alias("n_resubscribe"), n(F.col("outcome") == "rejected").alias("n_rejected"))


def records(seen: DataFrame, group_ids: list[int], type_groups: dict[str, int], type_field_id: int) -> DataFrame:
    """SNK7: (email, ext_type, ext_id, record) of the rows to create. A type without a group of its own gets the common ones only."""
    made = seen.where("outcome = 'create'")
    own = F.coalesce(*[F.when(F.col("ext_type") == t, F.lit(str(g))) for t, g in type_groups.items()], F.lit(None).cast("string"))
    return made.select("email", "ext_type", "ext_id", SK.person_xml(made, group_ids, own, type_field_id).alias("record"))


def write_run(seen: DataFrame, path: str, processed_at: str, dry_run: bool = False) -> None:
    """SNK2 + SNK3: append the run's processed rows and counts to the logs, replace the table of rejected rows (kept as
    it is when there are none; a dry run writes a sibling and no counts)."""
    at = F.lit(processed_at).cast("timestamp")
    log = seen.where("outcome <> 'rejected'").drop("outcome").select(at.alias("processed_at"), "*", F.lit(dry_run).alias("dry_run"))
    SK.append_log(log, f"{path}/detailed_log")
    SK.replace_table(seen.where("outcome = 'rejected'").select(*LAYOUT, "is_resubscribe", "unsub_epoch"), f"{path}/rejected", dry_run)
    if not dry_run:
        SK.append_log(run_counts(seen).select(at.alias("processed_at"), "*"), f"{path}/counts")
