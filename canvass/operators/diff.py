"""Custom-field diffs (D1, D2): which wanted values must be pushed.

``stored`` holds the values the target system has (text, as it comes back
from the target), ``wanted`` the values we want there. A row is kept when any
field needs an update and at least one wanted field is non-null. The rules
are SQL three-valued logic on purpose: a comparison with null is "unknown",
and unknown never selects a row. Text-vs-number comparisons go through
``try_cast`` so ANSI mode never raises on '' or junk.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN, INT, YESNO, DATE, IGNORE = "plain", "int", "yesno", "date", "ignore"


@dataclass(frozen=True)
class FieldRule:
    name: str
    kind: str = PLAIN


def _blank(o: Column) -> Column:
    return o.isNull() | (o == "")


def _differs(o: Column, n: Column, kind: str) -> Column:
    if kind == INT:
        return F.ceil(o.try_cast("double")) != F.ceil(n.try_cast("double"))
    if kind == YESNO:
        return ((o.isin("1", "Yes") & (n.isNull() | _is(n, 0)))
                | ((o.isNull() | o.isin("0", "No", "")) & _is(n, 1)))
    if kind == DATE:
        return o.try_cast("date") != n.try_cast("date")
    # a text field is compared as text, a number by value
    return F.when(F.typeof(n) == "string", o != n.cast("string")).otherwise(o.try_cast("double") != n.try_cast("double"))


def _is(n: Column, value: int) -> Column:
    """``n = value`` for numbers and texts alike; a text that is no number is unequal, null stays unknown."""
    return F.when(n.isNotNull(), F.coalesce(n.try_cast("double") == value, F.lit(False)))


def crm_needs_update(o: Column, n: Column) -> Column:
    """Skip "wanted 0, stored null or ''"; else blank->value,
    value->null, or both present and different."""
    return (~(_is(n, 0) & _blank(o))
            & ((_blank(o) & n.isNotNull()) | (~_blank(o) & n.isNull()) | _differs(o, n, PLAIN)))


def sms_needs_update(o: Column, n: Column, kind: str) -> Column:
    """Like D1 but the zero-skip checks only null (not ''), and the
    comparison depends on the field kind (int by CEIL, yes/no, date)."""
    zero_skip = F.lit(False) if kind == DATE else (_is(n, 0) & o.isNull())
    return (~zero_skip
            & ((_blank(o) & n.isNotNull()) | (~_blank(o) & n.isNull()) | _differs(o, n, kind)))


def _text(n: Column, kind: str) -> Column:
    if kind == DATE:
        return F.date_format(n, "yyyy-MM-dd")
    return F.substring(n.cast("string"), 1, 1024)


def diff_fields(stored: DataFrame, wanted: DataFrame, key: str, rules: list[FieldRule],
                sms: bool = False, key_whitelist: list | None = None) -> DataFrame:
    """Rows of ``wanted`` (joined to ``stored`` on ``key``) that need a push,
    all fields as text(1024), distinct. Field ``f`` is ``f`` in ``wanted`` and
    ``f`` in ``stored``; ``ignore`` fields take no part (D2 null list). An
    optional key whitelist (D2's single-phone test mode) limits the keys."""
    live = [r for r in rules if r.kind != IGNORE]
    if key_whitelist:
        stored = stored.filter(F.col(key).isin(list(key_whitelist)))
    s = stored.select(key, *[F.col(r.name).alias(f"_old_{r.name}") for r in live])
    x = wanted.join(s, key, "inner")
    if sms:
        need = [sms_needs_update(F.col(f"_old_{r.name}"), F.col(r.name), r.kind) for r in live]
    else:
        need = [crm_needs_update(F.col(f"_old_{r.name}"), F.col(r.name)) for r in live]
    any_need = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in need])
    any_value = reduce(lambda a, b: a | b, [F.col(r.name).isNotNull() for r in live])
    out = x.filter(any_need & any_value).select(key, *[_text(F.col(r.name), r.kind).alias(r.name) for r in rules])
    return out.distinct()
