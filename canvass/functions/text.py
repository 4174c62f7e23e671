"""Text and arithmetic helpers (X16, X17, SNK8, SNK9 value rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_path(s: Column) -> Column:
    """Percent-encode like a URL path quote: spaces as %20, '/' kept."""
    enc = F.url_encode(s)
    return F.replace(F.replace(enc, F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def add_utm_source(url: Column, source: str | Column) -> Column:
    """Append ``?utm_source=<quoted>`` unless the URL already has a
    query or the source is empty."""
    src = source if isinstance(source, Column) else F.lit(source)
    return (F.when(src.isNull() | (src == ""), url)
            .when(url.contains("?"), url)
            .otherwise(F.concat(url, F.lit("?utm_source="), quote_path(src))))


# Debt-relief formula bounds.
RELIEF_FULL_INCOME = 100000
RELIEF_ZERO_INCOME = 250000
RELIEF_MAX = 50000


def debt_relief(income: Column, debt: Column) -> Column:
    """Relief 50,000 up to 100k income, none from 250k, linear (1/3 per
    dollar, half-even rounding) between; cancellation = min(relief, debt);
    remaining debt rounded, never negative."""
    relief = (F.when(income >= RELIEF_ZERO_INCOME, F.lit(0).cast("bigint"))
              .when(income <= RELIEF_FULL_INCOME, F.lit(RELIEF_MAX).cast("bigint"))
              .otherwise(F.bround(F.lit(RELIEF_MAX) - (income - RELIEF_FULL_INCOME) / 3, 0).cast("bigint")))
    cancelled = F.least(relief.cast("double"), debt)
    remaining = F.bround(F.greatest(debt - cancelled, F.lit(0.0)), 0).cast("bigint")
    return F.struct(relief.alias("relief"), cancelled.alias("cancelled"), remaining.alias("remaining"))


def whole_number_text(v: Column, tol: float = 1e-6) -> Column:
    """SNK8: whole floats printed as integers (within ``tol``), else as is."""
    r = F.bround(v, 0)
    return F.when(F.abs(r - v) < tol, r.cast("bigint").cast("string")).otherwise(v.cast("string"))


def yes_no(v: Column) -> Column:
    """SNK9: 1/0 -> Yes/No."""
    return F.when(v == 1, F.lit("Yes")).when(v == 0, F.lit("No"))
