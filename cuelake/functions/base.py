from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def as_col(value: C) -> Column:
    return F.col(value) if isinstance(value, str) else value


def idiv(value: C, by: int | Column) -> Column:
    """Integer division without a trip through DOUBLE (truncates; keep operands non-negative)."""
    return F.call_function("div", as_col(value), by if isinstance(by, Column) else F.lit(by))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute `value` once and use it many times.

    Inside a higher-order function an outer expression is worked out again for every element;
    bound as a lambda variable it is not.
    """
    return F.transform(F.array(value), body)[0]
