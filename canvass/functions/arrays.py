"""Array helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(*cols: Column) -> Column:
    """Array of the non-null (and non-empty) strings among ``cols``, in order.

    ``array_compact`` is rewritten by Spark into a lambda ``filter``, which is
    evaluated outside generated code; ``array_remove`` is generated code.
    """
    return F.array_remove(F.array(*[F.coalesce(c, F.lit("")) for c in cols]), "")
