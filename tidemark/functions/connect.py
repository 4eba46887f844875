"""Table schemas from the schema block that change records may carry."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import settled
from tidemark.functions.envelope import value_payload
from tidemark.operators.runs import runs

# Scalar type names of the schema block. Bytes travel as base64
# text and stay text, as do named types such as enums.
SCALARS = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "bytes": T.StringType(),
}

VALUE_SCHEMA = "schema STRUCT<fields: ARRAY<STRUCT<field: STRING, fields: STRING>>>"


def _type_reader():
    """Reads one schema entry. What is made in here goes to the executors by
    value, so they need not have this package."""
    scalars = SCALARS

    def struct_of(fields: list[dict]) -> T.StructType:
        return T.StructType(
            [T.StructField(f["field"], type_of(f), f.get("optional", True)) for f in fields]
        )

    def type_of(field: dict) -> T.DataType:
        kind = field.get("type")
        if kind == "struct":
            return struct_of(field.get("fields") or [])
        if kind == "array":
            return T.ArrayType(type_of(field["items"]))
        if kind == "map":
            return T.MapType(type_of(field["keys"]), type_of(field["values"]))
        if kind not in scalars:
            raise ValueError(f"unknown type in a record schema: {kind!r}")
        return scalars[kind]

    def names(fields: pd.Series) -> pd.Series:
        def name(text: str) -> str | None:
            try:
                return type_of(json.loads(text)).simpleString()
            except (KeyError, TypeError, ValueError):
                return None

        return fields.map(name)

    def columns(fields: pd.Series) -> pd.Series:
        def listed(text: str) -> str | None:
            try:
                return ", ".join(f"{f['field']} {type_of(f).simpleString()}" for f in json.loads(text))
            except (KeyError, TypeError, ValueError):
                return None

        return fields.map(listed)

    return struct_of, names, columns


struct_type, type_names, column_lists = _type_reader()
_type_name = F.pandas_udf(type_names, T.StringType())
_columns = F.pandas_udf(column_lists, T.StringType())


def row_fields(value: Column) -> Column:
    """The schema of the row image, as the JSON text of its list of fields."""
    blocks = F.from_json(value, VALUE_SCHEMA)["schema"]["fields"]
    return F.get(F.filter(blocks, lambda f: f["field"] == "after"), 0)["fields"]


def connect_schema(feed: DataFrame) -> DataFrame:
    """The columns each topic's records declare, with Spark types (NULL for an
    unknown one) and the number of records that carry that same schema."""
    carried = settled(feed, "topic", row_fields(F.col("value")).alias("fields"))
    versions = carried.where(F.col("fields").isNotNull()).groupBy("topic", "fields")
    listed = versions.agg(F.count(F.lit(1)).alias("n")).select(
        "topic", "n", F.posexplode(F.from_json("fields", "ARRAY<STRING>")).alias("place", "field")
    )
    return listed.select(
        "topic",
        "place",
        F.get_json_object("field", "$.field").alias("c"),
        _type_name("field").alias("type"),
        "n",
    )


def schema_history(feed: DataFrame) -> DataFrame:
    """topic, partition, first, last (offsets), n and columns, the names and types, of each run
    of records that carry the same schema; records without one are passed over."""
    found = runs(feed, row_fields(F.col("value")))
    return found.select("topic", "partition", "first", "last", "n", _columns("value").alias("columns"))


# Fixed value: how a schema block lists the values that a column may have.
ALLOWED = (
    "schema STRUCT<fields: ARRAY<STRUCT<field: STRING, fields: ARRAY<STRUCT<field: STRING, "
    "parameters: STRUCT<allowed: STRING>>>>>>"
)


def not_allowed(value: Column, image: Column) -> Column:
    """The names of the row image's columns whose value is none of those that the record's own
    schema allows; NULL is always allowed. ``image`` holds names and texts."""
    blocks = F.from_json(value, ALLOWED)["schema"]["fields"]
    fields = F.get(F.filter(blocks, lambda f: f["field"] == "after"), 0)["fields"]

    def broken(field: Column) -> Column:
        allowed = F.transform(F.split(field["parameters"]["allowed"], ","), lambda a: F.trim(a))
        said = F.try_element_at(image, field["field"])
        return F.coalesce(~F.array_contains(allowed, said), F.lit(False))

    return F.coalesce(F.transform(F.filter(fields, broken), lambda f: f["field"]), F.array().cast("array<string>"))


def enum_check(feed: DataFrame) -> DataFrame:
    """topic, partition, offset, c and value of each cell that its record's schema does not allow."""
    image = value_payload(F.col("value"))["after"]
    cells = settled(feed, "topic", "partition", "offset", image.alias("image"), not_allowed(F.col("value"), image).alias("broken"))
    listed = cells.select("topic", "partition", "offset", "image", F.explode("broken").alias("c"))
    return listed.select("topic", "partition", "offset", "c", F.try_element_at("image", F.col("c")).alias("value"))


def latest_schema(feed: DataFrame) -> T.StructType:
    """The row schema declared by the record with the highest offset that has
    one. Use on one topic, to set up its table."""
    carried = settled(feed, "offset", row_fields(F.col("value")).alias("fields"))
    carried = carried.where(F.col("fields").isNotNull())
    newest = carried.agg(F.max_by("fields", "offset").alias("fields")).first()
    if newest is None or newest["fields"] is None:
        raise ValueError("no record carries a schema")
    return struct_type(json.loads(newest["fields"]))
