"""Column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it.

    An expression that a lambda or the branches of a ``when`` name again is else
    computed again for each element and branch.
    """
    return F.transform(F.array(value), body)[0]
