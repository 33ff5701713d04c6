"""Helpers for array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def evaluate_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it.

    Expressions inside array lambdas are not shared by the optimizer; a
    one-element array gives the value a name of its own.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
