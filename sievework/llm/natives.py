"""Column helpers for operators that stay with built-in functions."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once even where use names it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters keep their case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
