"""Values that an expression refers to often and computes once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once however often f refers to it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))
