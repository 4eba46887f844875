"""Runs and gaps along the offsets of a feed's partitions.

What a window over a whole partition of the feed would find, cut at the borders of
spans of offsets: each span is looked at by itself, and what meets at a border, a
row or two for each span, is put together afterwards. So the work on a large
partition is spread, and only spans with many changes have many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import settled
from tidemark.operators.order import SPAN

PARTITION = ["topic", "partition"]


def _numbered(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows with the number of their run of equal values, within groups."""
    along = Window.partitionBy(*by).orderBy(order)
    same = F.col("value").eqNullSafe(F.lag("value").over(along)) & (F.row_number().over(along) > 1)
    marked = rows.withColumn("_new", F.when(same, 0).otherwise(1))
    return marked.withColumn("_run", F.sum("_new").over(along)).drop("_new")


def runs(records: DataFrame, value: Column, span: int = SPAN) -> DataFrame:
    """topic, partition, first, last, value and n (records) of each run of records with equal
    values; those whose value is NULL are passed over. Repeated offsets count each."""
    placed = settled(records, *PARTITION, "offset", F.floor(F.col("offset") / span).alias("_span"), value.alias("value"))
    spanned = [*PARTITION, "_span"]
    pieces = (
        _numbered(placed.where(F.col("value").isNotNull()), spanned, "offset")
        .groupBy(*spanned, "_run")
        .agg(
            F.min("offset").alias("first"),
            F.max("offset").alias("last"),
            F.first("value").alias("value"),
            F.count(F.lit(1)).alias("n"),
        )
        .drop("_run")
    )
    return (
        _numbered(pieces, PARTITION, "first")
        .groupBy(*PARTITION, "_run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.first("value").alias("value"), F.sum("n").alias("n"))
        .drop("_run")
    )


def offset_gaps(feed: DataFrame, span: int = SPAN) -> DataFrame:
    """topic, partition, first, last and n of the offsets that are missing between a
    partition's first and last record. Repeated offsets do no harm."""
    placed = feed.select(*PARTITION, "offset", F.floor(F.col("offset") / span).alias("_span"))
    along = Window.partitionBy(*PARTITION, "_span").orderBy("offset")
    within = placed.select(*PARTITION, F.lag("offset").over(along).alias("before"), F.col("offset").alias("after"))
    # the last offset of a span and the first of the next one that has any
    ends = placed.groupBy(*PARTITION, "_span").agg(F.min("offset").alias("after"), F.max("offset").alias("last"))
    borders = ends.select(
        *PARTITION, F.lag("last").over(Window.partitionBy(*PARTITION).orderBy("_span")).alias("before"), "after"
    )
    found = within.unionByName(borders).where(F.col("after") > F.col("before") + 1)
    return found.select(
        *PARTITION,
        (F.col("before") + 1).alias("first"),
        (F.col("after") - 1).alias("last"),
        (F.col("after") - F.col("before") - 1).alias("n"),
    )
