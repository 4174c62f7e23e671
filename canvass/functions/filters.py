"""Row predicates and small config helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole-string e-mail syntax: local part, "@", dotted domain with a 2+ letter TLD.
EMAIL_SYNTAX = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}$"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def not_deleted(*cols: str) -> Column:
    """soft-delete filter: every deletion marker is null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def null_when(cond: Column, value) -> Column:
    """null when ``cond`` holds, else the value."""
    return F.when(~cond | cond.isNull(), _c(value))


def exclude_status(col, values: list[str]) -> Column:
    """``NOT IN`` list; a null status is dropped too (SQL 3VL)."""
    return ~_c(col).isin(values)


def attended_or_unknown(col) -> Column:
    """attended flag is null or 1."""
    c = _c(col)
    return c.isNull() | (c == 1)


def not_like_suffix(col, suffix: str) -> Column:
    """``NOT LIKE '%<suffix>'``."""
    return ~_c(col).like("%" + suffix.replace("%", r"\%").replace("_", r"\_"))


def upcoming(day, as_of: str) -> Column:
    """F16: on or after the day after ``as_of``."""
    return _c(day) >= F.date_add(F.lit(as_of).cast("date"), 1)


def due(day, as_of: str) -> Column:
    """F16: exactly the day after ``as_of``."""
    return _c(day) == F.date_add(F.lit(as_of).cast("date"), 1)


def whitelist(df: DataFrame, col: str, values: list | None) -> DataFrame:
    """an empty or missing whitelist allows everything."""
    return df if not values else df.filter(F.col(col).isin(list(values)))


def push_order(df: DataFrame, ts: str, start, order: list[Column]) -> DataFrame:
    """rows changed after ``start``, in a stated order (for export only)."""
    return df.filter(F.col(ts) > F.lit(start)).orderBy(*order)


def email_syntax_ok(col) -> Column:
    """X18 (syntax part): whole-string address check."""
    return _c(col).rlike(EMAIL_SYNTAX)


def email_domain(col) -> Column:
    return F.lower(F.substring_index(_c(col), "@", -1))


def parse_pairs(text: str) -> list[tuple[str, int]]:
    """Job argument ``a,1,b,2`` -> [("a", 1), ("b", 2)] (driver-side config)."""
    parts = [p.strip() for p in text.split(",") if p.strip()]
    if len(parts) % 2:
        raise ValueError(f"odd number of items in {text!r}")
    return [(parts[i], int(parts[i + 1])) for i in range(0, len(parts), 2)]
