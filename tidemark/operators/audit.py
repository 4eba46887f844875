"""Looking at feeds and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import named


def feed_audit(decoded: DataFrame) -> DataFrame:
    """Records and offset range per topic, partition and action."""
    return decoded.groupBy("topic", "partition", "action").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi")
    )


def action_counts(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("topic", "action").agg(F.count(F.lit(1)).alias("n"))


def preview(table: DataFrame, keys: tuple[str, ...], rows: int = 20) -> DataFrame:
    """The first rows in key order."""
    return table.orderBy(*[named(k) for k in keys]).limit(rows)


def explode_entries(df: DataFrame, entries: Column) -> DataFrame:
    """One row per field of a JSON object: name and text."""
    return df.select(F.explode(entries).alias("k", "v"))
