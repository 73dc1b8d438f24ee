"""Column predicates that reproduce NaN comparison semantics on NULL.

In the source arithmetic, a missing number compares ``!= 0`` as true and
``== 0`` as false. Plain SQL ``x <> 0`` is NULL on NULL and would take the
wrong branch of a CASE, so these two helpers are used everywhere instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def eq0(c) -> Column:
    """``x == 0`` with a missing x being false."""
    return F.coalesce(_col(c) == 0, F.lit(False))


def ne0(c) -> Column:
    """``x != 0`` with a missing x being true (the exact complement of eq0)."""
    return ~eq0(c)


def null_safe_div(num, den) -> Column:
    """Division that yields NULL instead of raising on a zero divisor."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
