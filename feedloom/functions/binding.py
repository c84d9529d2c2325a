"""Bind an expression once.

A lambda body is evaluated for every element, together with every expression it mentions. ``let`` turns
such an expression into a lambda variable, so that it is evaluated once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
