"""Name an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside array lambdas.

    Lambdas over arrays get no common-subexpression elimination, so a value
    that a CASE expression mentions several times is bound this way.
    """
    return F.transform(F.array(value), body).getItem(0)
