"""Evaluate an expensive expression once and use it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Common-subexpression elimination does not reach into lambdas, so a parse used inside
    one would run again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
