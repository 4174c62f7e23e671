"""Sinks and renderers (SNK2-SNK11).

Writers use Spark's committers (atomic task output, retried tasks never
duplicate rows). Renderers turn rows into the payload text each target
expects, per row, with built-in ``to_json`` / ``to_xml``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.contacts import normalize_name_case
from canvass.functions.text import whole_number_text
from canvass.operators.scan import batches


def append_log(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK2: append-only audit log, one row per processed record."""
    df.write.mode("append").format(fmt).save(path)


def replace_table(df: DataFrame, path: str, dry_run: bool = False, fmt: str = "parquet") -> bool:
    """SNK3: replace a table; skipped when the frame is empty; a dry run
    writes to a sibling ``<path>_dry_run``. Returns whether it wrote."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").format(fmt).save(path + ("_dry_run" if dry_run else ""))
    return True


def write_csv(df: DataFrame, path: str, cols: list[str]) -> None:
    """SNK5: CSV export of the selected fields, with a header."""
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def snapshot(df: DataFrame, path: str, as_of: str, fmt: str = "parquet") -> str:
    """SNK11: dated copy of a result under ``path/ds=<as_of>``."""
    out = f"{path.rstrip('/')}/ds={as_of}"
    df.write.mode("overwrite").format(fmt).save(out)
    return out


def constituent_xml(df: DataFrame, fields: list[str], group_ids: list[int], source: str,
                    flags: dict[str, str] | None = None) -> Column:
    """SNK7: one constituent record as XML: empty strings become nulls and
    nulls are omitted; fixed flags, group ids and the source field included."""
    cols = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in fields]
    cols += [F.lit(v).alias(k) for k, v in (flags or {}).items()]
    cols.append(F.array(*[F.struct(F.lit(str(g)).alias("_id")) for g in group_ids]).alias("cons_group"))
    cols.append(F.lit(source).alias("source"))
    return F.to_xml(F.struct(*cols), {"rowTag": "cons"})


PHONE_KIND, EMAIL_KIND = "home", "personal"   # fixed: kinds of a record's phone and address


def person_xml(df: DataFrame, group_ids: list[int], own_group: Column, type_field_id: int) -> Column:
    """SNK7 (nested): the record of one person: re-cased names, source, postal address, phone (only if there is one),
    e-mail, the common groups and ``own_group`` (text, may be null), and the source type as a custom field. Null and
    empty values render no element; the address always has its country."""
    def text(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(""))
    first, last = normalize_name_case(F.coalesce("first_name", F.lit("")), F.coalesce("last_name", F.lit("")))
    address = F.struct(*[text(c).alias(n) for c, n in [("addr1", "addr1"), ("addr2", "addr2"), ("city", "city"),
                                                       ("state_cd", "state_cd"), ("postal_code", "zip")]], F.lit("US").alias("country"))
    phone = F.when(text("phone_number").isNotNull(), F.struct(
        F.col("phone_number").alias("phone"), F.lit(PHONE_KIND).alias("phone_type"),
        F.lit("0").alias("is_subscribed"), F.lit("1").alias("is_primary")))
    mail = F.struct(F.col("email").alias("email"), F.lit(EMAIL_KIND).alias("email_type"),
                    F.lit("1").alias("is_subscribed"), F.lit("1").alias("is_primary"))
    groups = F.array_compact(F.array(*[F.lit(str(g)) for g in group_ids], own_group))
    kind = F.struct(F.lit(str(type_field_id)).alias("_id"), F.col("ext_type").alias("value"))
    person = F.struct(F.nullif(first, F.lit("")).alias("firstname"), F.nullif(last, F.lit("")).alias("lastname"), F.lit("0").alias("is_banned"),
                      text("source").alias("source"), text("subsource").alias("subsource"), address.alias("cons_addr"),
                      phone.alias("cons_phone"), mail.alias("cons_email"),
                      F.transform(groups, lambda g: F.struct(g.alias("_id"))).alias("cons_group"), kind.alias("cons_field"))
    return F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?><api>'), F.to_xml(person, {"rowTag": "cons"}), F.lit("</api>"))


def field_xml(key: Column, fields: list[str], field_ids: dict[str, int]) -> Column:
    """SNK8: custom-field update XML. A field with no value (null, empty text,
    the number 0, false) renders without a ``value`` element, which clears it.
    Texts stay as they are, also '0'; whole numbers print as integers, also
    those that a diff made text ('24.0')."""
    def value(f: str) -> Column:
        c = F.col(f)
        number = c.cast("string").try_cast("double")
        return (F.when((F.typeof(c) == "string") & c.cast("string").rlike(r"^-?[0-9]+\.[0-9]+$"), whole_number_text(number))
                .when(F.typeof(c) == "string", F.nullif(c.cast("string"), F.lit("")))
                .when(F.typeof(c).isin("date", "timestamp"), c.cast("string"))
                .when(F.typeof(c) == "boolean", F.when(c.cast("string") == "true", F.lit("True")))
                .when(number != 0, whole_number_text(number)))
    items = [F.struct(F.lit(field_ids[f]).alias("_id"), value(f).alias("value")) for f in fields]
    return F.to_xml(F.struct(key.alias("_id"), F.array(*items).alias("cons_field")), {"rowTag": "cons"})


FIELD_GROUP = 100   # fixed: people in one custom-field update


def field_requests(df: DataFrame, key: str, fields: list[str], field_ids: dict[str, int], limit: int | None = None) -> DataFrame:
    """SNK8 + SNK6: (batch, n, request): updates of ``FIELD_GROUP`` people at most, in order of ``key`` (unique), of the
    first ``limit`` people if one is given. Rows without a key are left out."""
    x = df.where(F.col(key).isNotNull())
    if limit is not None:
        x = x.orderBy(key).limit(limit)
    row = F.struct(F.col(key), field_xml(F.col(key), fields, field_ids).alias("_xml"))
    grouped = batches(x, FIELD_GROUP, [key]).groupBy("batch").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    body = F.array_join(F.transform("_rows", lambda r: r["_xml"]), "\n")
    return grouped.select("batch", F.size("_rows").cast("bigint").alias("n"), F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?><api>'), body, F.lit("</api>")).alias("request"))


def profile_payload(phone11: Column, fields: list[str], ints: list[str], yesno: list[str]) -> Column:
    """SNK9: SMS profile JSON: null/empty keys dropped (``to_json`` omits
    nulls), ints rounded half-even, 1/0 as Yes/No and Yes/No as they are, other
    values unchanged, phone as ``1`` + 10 digits."""
    def val(f: str) -> Column:
        c = F.col(f)
        if f in ints:
            return F.bround(c.try_cast("double"), 0).cast("bigint")
        if f in yesno:
            d = c.cast("string").try_cast("double")
            return (F.when(d == 1, F.lit("Yes")).when(d == 0, F.lit("No"))
                    .otherwise(F.nullif(c.cast("string"), F.lit(""))))
        return F.nullif(c.cast("string"), F.lit(""))
    phone = F.concat(F.lit("1"), F.right(phone11, F.lit(10)))
    return F.to_json(F.struct(phone.alias("phone_number"), *[val(f).alias(f) for f in fields]))


MERGE_GROUP = 50   # fixed: recipients in one bulk request


def merge_rows(email: Column, cols: list[str]) -> Column:
    """SNK10: one recipient of a mail merge: the address, and its own values (the address among them) as JSON text."""
    values = F.to_json(F.struct(email.alias("email"), *[F.col(c) for c in cols]))
    return F.struct(F.struct(F.array(email).alias("ToAddresses")).alias("Destination"), values.alias("ReplacementTemplateData"))


def merge_requests(df: DataFrame, email: str, cols: list[str], order: list[str], default: dict | None = None) -> DataFrame:
    """SNK10 (bulk form): (batch, n, request): requests of ``MERGE_GROUP`` recipients at most, in ``order`` (unique),
    each with the default values. Rows without an address go to nobody."""
    numbered = batches(df.where(F.col(email).isNotNull()), MERGE_GROUP, order)
    row = F.struct(*[F.col(c) for c in order], merge_rows(F.col(email), cols).alias("_row"))
    grouped = numbered.groupBy("batch").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    request = F.to_json(F.struct(F.transform("_rows", lambda r: r["_row"]).alias("Destinations"),
                                 F.lit(json.dumps(default or {}, separators=(",", ":"))).alias("DefaultTemplateData")))
    return grouped.select("batch", F.size("_rows").cast("bigint").alias("n"), request.alias("request"))


def triggered_form(cols: list[str]) -> Column:
    """SNK10 (triggered form): URL-quoted JSON of the values."""
    return F.url_encode(F.to_json(F.struct(*[F.col(c) for c in cols])))
