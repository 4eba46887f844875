"""Conditions of the form column = value, joined by AND, without SQL text."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, named
from tidemark.functions.envelope import text_to

Conditions = str | Mapping[str, object] | Iterable[Mapping[str, object]]


def condition_pairs(conditions: Conditions) -> list[tuple[str, str]]:
    """(column, value as text) from a key object, a list of
    ``{"column", "value"}`` entries, or the JSON text of either one
    (a list may stand under ``conditions``)."""
    if isinstance(conditions, str):
        conditions = json.loads(conditions)
    if isinstance(conditions, Mapping):
        if isinstance(conditions.get("conditions"), list):
            return condition_pairs(conditions["conditions"])
        pairs = list(conditions.items())
    else:
        pairs = [(c["column"], c["value"]) for c in conditions]
    if not pairs:
        raise ValueError("no conditions given")
    if missing := [c for c, v in pairs if v is None]:
        raise ValueError(f"a condition needs a value: {missing}")
    return [(c, as_text(v)) for c, v in pairs]


def as_text(value: object) -> str | None:
    """A value the way JSON writes it, but strings without quotes."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value)


def column_of(df: DataFrame, name: str) -> str:
    """The spelling of a column in the table; names match in any case."""
    for column in df.columns:
        if column.lower() == name.lower():
            return column
    raise ValueError(f"no column {name!r} in {df.columns}")


def typed_literal(df: DataFrame, column: str, value: object) -> Column:
    """A value given as text, as the column's type."""
    return text_to(F.lit(as_text(value)).cast("string"), df.schema[column].dataType)


def predicate(df: DataFrame, conditions: Conditions) -> Column:
    pairs = [(column_of(df, c), v) for c, v in condition_pairs(conditions)]
    return all_of([named(c) == typed_literal(df, c, v) for c, v in pairs])

