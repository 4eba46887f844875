"""Columns by name, whatever the name holds."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str, prefix: str | None = None) -> Column:
    """A column by its exact name; dots, spaces and back-ticks are part of the name."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{prefix}.{quoted}" if prefix else quoted)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def settled(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Select columns that are costly to compute, as by parsing JSON.

    Filters on ordinary columns are moved below their computation and repeat
    it; a generator's output can only be filtered once it is there.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
