"""Row schemas inferred from row images, where none is declared or carried."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.table import TableSpec


def inferred_schema(feed: DataFrame) -> DataFrame:
    """topic, c, type, n (images that name the column) and nulls, for every column of
    the topic's row images.

    A type holds all values of its column: numbers widen, and texts beside numbers
    make a VARIANT. A column that is never set has the type VOID. Types are
    merged in every map task, so a topic costs its reducer a row for each of them.
    """
    images = feed.select("topic", F.try_variant_get(F.try_parse_json("value"), "$.payload.after", "variant").alias("_after"))
    # an image that is no object has no columns
    whole = F.schema_of_variant("_after").startswith("OBJECT<")
    images = images.where(F.col("_after").isNotNull() & whole)
    cells = images.lateralJoin(feed.sparkSession.tvf.variant_explode(F.col("_after").outer())).select(
        "topic", F.col("key").alias("c"), F.col("value").alias("_cell")
    )
    return cells.groupBy("topic", "c").agg(
        F.schema_of_variant_agg("_cell").alias("type"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.is_variant_null("_cell")).alias("nulls"),
    )


def sql_type(inferred: str) -> T.DataType:
    """The Spark type of an inferred one; a column that was never set is a text."""
    ddl = inferred.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    return T.StructType.fromDDL(f"x {'STRUCT<>' if ddl == 'OBJECT' else ddl}")[0].dataType


def inferred_table(feed: DataFrame, name: str, keys: tuple[str, ...], **more) -> TableSpec:
    """A table for one topic's records as they are; see TableSpec for the rest. Key columns come
    first, then the others by name. A column is required if it is a key or every image sets it."""
    found = {r["c"]: r for r in inferred_schema(feed).collect()}  # a row for each column
    images = max((r["n"] for r in found.values()), default=0)
    order = [*keys, *sorted(c for c in found if c not in keys)]
    if missing := [k for k in keys if k not in found]:
        raise ValueError(f"no row image has the key columns {missing}")
    fields = [
        T.StructField(c, sql_type(found[c]["type"]), not (c in keys or (found[c]["n"] == images and not found[c]["nulls"])))
        for c in order
    ]
    return TableSpec(name, T.StructType(fields), keys, **more)
