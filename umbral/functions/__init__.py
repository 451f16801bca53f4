"""Column expressions: no action, no shuffle, usable in any select or filter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it.

    A Python variable holding a Column is copied into every place it is used, inside CASE
    branches too; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]
