"""Array / struct / JSON operators (AR2-AR11, ST8 batch form).

All are higher-order built-ins (``transform``, ``filter``, ``arrays_zip``,
``posexplode``) evaluated inside the JVM, row by row, with no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.arrays import present


def latest_kv(puts: DataFrame, key: str, value: str, arrival: str, ts: str) -> DataFrame:
    """ST8: keyed upsert replayed in batch: last write (by arrival) wins,
    ``created_at`` is the first write's time, ``updated_at`` the last's.
    Blank keys are rejected."""
    ok = puts.filter(F.col(key).isNotNull() & (F.trim(F.col(key)) != ""))
    return ok.groupBy(key).agg(F.max_by(value, arrival).alias(value),
                               F.min_by(ts, arrival).alias("created_at"),
                               F.max_by(ts, arrival).alias("updated_at"))


def inbound_text(df: DataFrame, conv: str, thread: str, role: str, text: str,
                 inbound_role: str = "customer") -> DataFrame:
    """AR7: keep inbound (customer) threads: (conversation, thread, text)."""
    return df.filter(F.col(role) == inbound_role).select(conv, F.col(thread).alias("thread_id"), text)


def explode_threads(df: DataFrame, conv: str, threads: str) -> DataFrame:
    """AR7 over nested conversation documents: one row per thread."""
    return df.select(conv, F.explode_outer(threads).alias("_t")).select(conv, "_t.*")


def get_or_default(c: Column, default: Column) -> Column:
    """AR4: nested value, or the default when it is missing or falsy: null, the
    empty text, the number 0, false. A text '0' or 'false' is a value."""
    text = c.cast("string")
    falsy = F.when(F.typeof(c) == "string", text == "").otherwise(
        F.coalesce(text.try_cast("double") == 0, F.lit(False)) | (text == "false"))
    return F.when(F.coalesce(falsy, F.lit(True)), default).otherwise(c)


def missing_fields(record: Column, names: list[str]) -> Column:
    """AR9: names of required fields that are null, in list order."""
    return present(*[F.when(record[n].isNull(), F.lit(n)) for n in names])


def render_invites(df: DataFrame, urls: str, labels: str, refcode: str, sep: str = "|",
                   skip: str = "6:00pm", highlight: str = "Sunday") -> DataFrame:
    """AR8: zip two ``sep``-lists by position and render one button per
    shift. Shifts whose label contains ``skip`` are left out; the link keeps
    the original 1-based position; ``highlight`` days get the light colour."""
    z = F.arrays_zip(F.split(F.col(urls), "\\" + sep).alias("url"), F.split(F.col(labels), "\\" + sep).alias("label"))
    x = df.select("*", F.posexplode(z).alias("_pos", "_z"))
    x = x.filter(~F.col("_z.label").contains(skip))
    hl = F.col("_z.label").contains(highlight)
    return x.select(
        "*", (F.col("_pos") + 1).alias("shift_index"), F.col("_z.label").alias("start_time"),
        F.when(hl, F.lit("#B7E4CF")).otherwise(F.lit("#232444")).alias("button_color"),
        F.when(hl, F.lit("#232444")).otherwise(F.lit("#FFFFFF")).alias("text_color"),
        F.concat(F.col("_z.url"), F.lit(f"&utm_source={refcode}-bt"), (F.col("_pos") + 1).cast("string")).alias("link"),
    ).drop("_pos", "_z")


def first_component(components: Column, kind: str, field: str = "short_name") -> Column:
    """AR3: ``field`` of the first component whose first type is ``kind``."""
    return F.get(F.filter(components, lambda c: c["types"][0] == F.lit(kind)), 0)[field]


def flatten_address(df: DataFrame, result: str) -> DataFrame:
    """AR3: geocoder result -> flat address columns."""
    comps = F.col(f"{result}.address_components")
    zip5 = first_component(comps, "postal_code")
    suffix = first_component(comps, "postal_code_suffix")
    return df.select(
        "*",
        first_component(comps, "street_number").alias("street_number"),
        first_component(comps, "route").alias("route"),
        first_component(comps, "locality").alias("city"),
        first_component(comps, "administrative_area_level_1").alias("state"),
        zip5.alias("zip5"),
        F.when(suffix.isNotNull(), F.concat(zip5, F.lit("-"), suffix)).otherwise(zip5).alias("zip9"),
        F.col(f"{result}.place_id").alias("place_id"),
        F.col(f"{result}.geometry.location.lat").alias("lat"),
        F.col(f"{result}.geometry.location.lng").alias("lng"))


def flatten_profiles(df: DataFrame, profile: str = "profile") -> DataFrame:
    """AR2: SMS profile record -> id, phone, names, opt-out time, campaign-id
    set, custom-field map, messages newest first. A missing container is an
    empty list."""
    p = F.col(profile)
    subs = F.coalesce(p["subscriptions"]["subscription"], F.array())
    cols = F.coalesce(p["custom_columns"]["custom_column"], F.array())
    msgs = F.coalesce(p["messages"]["message"], F.array())
    newest_first = F.array_sort(msgs, lambda a, b: F.when(a["when"] > b["when"], -1)
                                .when(a["when"] < b["when"], 1).otherwise(0))
    return df.select(
        p["id"].alias("id"), p["phone_number"].alias("phone_number"),
        p["first_name"].alias("first_name"), p["last_name"].alias("last_name"),
        p["opted_out_at"].alias("opted_out_at"),
        F.array_sort(F.array_distinct(F.transform(subs, lambda s: s["campaign_id"].cast("int")))).alias("campaign_ids"),
        F.map_from_entries(F.transform(cols, lambda c: F.struct(c["name"], c["value"]))).alias("custom_columns"),
        newest_first.alias("messages"),
        F.get(newest_first, 0).alias("last_message"))


def format_events(response: DataFrame, utm_source: str | None = None,
                  sponsor_whitelist: list[int] | None = None) -> DataFrame:
    """AR6 / P11: one row per event of a saved search response. ``data`` may
    be null (count 0 and no rows); time slots become local display strings in
    the event's own zone; the link gets ``utm_source`` (X16); an optional
    sponsor whitelist keeps only listed sponsors."""
    from canvass.functions.text import add_utm_source
    from canvass.functions.timefmt import local_event_time
    data = F.coalesce(F.col("data"), F.array())
    ev = response.select(F.size(data).alias("count"), F.explode(data).alias("e")).select("count", "e.*")
    if sponsor_whitelist:
        ev = ev.filter(F.col("sponsor.id").isin(sponsor_whitelist))
    slots = F.transform(F.coalesce(F.col("timeslots"), F.array()), lambda t: F.struct(
        t["id"].alias("id"), t["is_full"].alias("is_full"),
        local_event_time(t["start_date"], F.col("timezone")).alias("start"),
        local_event_time(t["end_date"], F.col("timezone")).alias("end")))
    url = add_utm_source(F.col("browser_url"), utm_source) if utm_source else F.col("browser_url")
    return ev.select("count", "id", "title", "event_type", "timezone", url.alias("url"), slots.alias("timeslots"),
                     F.col("location.locality").alias("city"), F.col("location.region").alias("state"),
                     F.col("location.postal_code").alias("postal_code"))


def classify_replies(df: DataFrame, body: str = "body") -> DataFrame:
    """AR11: saved API replies (XML text) -> is_new, error present, first 500
    characters, and the known e-mails listed (one or many records)."""
    schema = ("cons ARRAY<STRUCT<_is_new: STRING, _id: STRING, email: STRING>>, "
              "error STRUCT<code: STRING, description: STRING>")
    p = F.from_xml(F.col(body), schema, {"rowTag": "api"})
    cons = F.coalesce(p["cons"], F.array())
    return df.select(
        "*", F.exists(cons, lambda c: c["_is_new"] == F.lit("1")).alias("is_new"),
        p["error"].isNotNull().alias("has_error"), F.left(F.col(body), F.lit(500)).alias("body_head"),
        F.filter(F.transform(cons, lambda c: c["email"]), lambda e: e.isNotNull()).alias("emails"))
