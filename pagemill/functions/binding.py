"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``use``.

    A column defined in an earlier projection may be merged back into every place that
    reads it, also inside lambdas, where it would be computed per element. Bound to a
    lambda variable it stays one evaluation, and nested rules stay small expressions.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
