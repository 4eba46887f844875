"""Order of changes from the log numbers inside their envelopes.

A source's log numbers tell the order of its commits wherever its records land,
also after a restart that sends records again. They stand in ``payload.source``;
several together make one order key, compared as bytes.

A delete without a value carries none. It stands right behind the last change of
its key in its partition, so it takes that change's order and wins over it by its
offset. To find that change, records without their texts meet by partition, key
and span of offsets: a key with most of a partition is cut into spans, and what a
span needs from earlier ones is one row for each of them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import settled
from tidemark.table import COMMIT

SOURCE_ENVELOPE = "payload STRUCT<source: MAP<STRING, STRING>>"
#: Offsets of a partition that are looked at together.
SPAN = 1 << 17
_SIGN = -(1 << 63)


def order_part(text: Column, kind: str) -> Column:
    """A log number as bytes that compare like it; NULL if it is none.

    ``hex``: groups of up to eight hex digits with colons between, as many in all
    records; ``number``: a whole number.
    """
    if kind == "hex":
        groups = F.transform(F.split(text, ":"), lambda g: F.lpad(g, 8, "0"))
        return F.when(text.rlike("^[0-9a-fA-F]{1,8}(:[0-9a-fA-F]{1,8})*$"), F.unhex(F.array_join(groups, "")))
    # with the sign turned over, negative numbers come first
    flipped = text.try_cast("long").bitwiseXOR(F.lit(_SIGN))
    return F.unhex(F.lpad(F.hex(flipped), 16, "0"))


def commit_key(value: Column, fields: Mapping[str, str]) -> Column:
    """The order key of a record by the named fields of ``payload.source``; NULL if one is missing."""
    source = F.from_json(value, SOURCE_ENVELOPE)["payload"]["source"]
    return F.concat(*[order_part(source[name], kind) for name, kind in fields.items()])


def commit_ordered(feed: DataFrame, fields: Mapping[str, str], span: int = SPAN) -> DataFrame:
    """The feed with its order key as a further column, NULL where a record has none:
    deletes that no change of their key comes before, in their partition and this feed."""
    rest = [c for c in feed.columns if c not in ("topic", "partition", "offset", "key")]
    own = commit_key(F.col("value"), fields).alias(COMMIT)
    changes = feed.where(F.col("value").isNotNull()).select(*feed.columns, own)

    group = ["topic", "partition", "_key", "_span"]
    gone = F.col("value").isNull()
    placed = settled(
        feed.where(F.col("key").isNotNull()),
        "topic",
        "partition",
        F.col("key").alias("_key"),
        F.floor(F.col("offset") / span).alias("_span"),
        "offset",
        own,
        F.when(gone, F.struct(*rest)).alias("_rest"),
    )
    near = Window.partitionBy(*group).orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    deletes = placed.withColumn("_near", F.last(COMMIT, ignorenulls=True).over(near)).where(F.col("_rest").isNotNull())
    # the last order of each span, then of all spans before it
    known = F.when(F.col(COMMIT).isNotNull(), F.col("offset"))
    spans = placed.groupBy(*group).agg(F.max_by(COMMIT, known).alias("_end"))
    before = Window.partitionBy(*group[:3]).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    far = spans.withColumn("_far", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    told = deletes.join(far, group).select(
        "topic",
        "partition",
        "offset",
        F.col("_key").alias("key"),
        "_rest.*",
        F.coalesce("_near", "_far").alias(COMMIT),
    )
    no_key = feed.where(gone & F.col("key").isNull()).withColumn(COMMIT, F.lit(None).cast("binary"))
    return changes.unionByName(told).unionByName(no_key)
