"""Column functions: everything here maps Column -> Column and stays JVM-side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Inside higher-order functions Spark does not share common subexpressions; a lambda
    variable over a one-element array does.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
