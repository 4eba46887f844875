"""Change feeds: Kafka's columns with key and value as text, from any source.

A function given ``stream=True`` returns a streaming DataFrame, else a batch
one over the whole feed; everything after that is the same for both.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import topic_list

FEED_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def as_feed(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """The feed columns of any record source; binary key and value become text.

    ``order_by`` names a further column that orders changes, such as Kafka's
    record timestamp; times become milliseconds.
    """
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in FEED_SCHEMA.fields]
    if order_by:
        kind = df.schema[order_by].dataType
        time = F.unix_millis(order_by) if isinstance(kind, T.TimestampType) else F.col(order_by).cast("long")
        columns.append(time.alias(order_by))
    return df.select(*columns)


def kafka_options(
    servers: str, topics: str | Iterable[str] | None = None, pattern: str | None = None, **more
) -> dict[str, str]:
    """Options of Spark's Kafka source: topics as a list or comma-separated
    text, or else a regular expression; the whole feed unless told otherwise."""
    if bool(topics) == bool(pattern):
        raise ValueError("give either topics or a topic pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": "earliest"}
    if topics:
        listed = topic_list(topics if isinstance(topics, str) else ",".join(topics))
        if not listed:
            raise ValueError("the topic list is empty")
        options["subscribe"] = ",".join(listed)
    else:
        options["subscribePattern"] = pattern
    return options | {name: str(value) for name, value in more.items()}


def kafka_feed(
    spark: SparkSession,
    servers: str,
    topics: str | Iterable[str] | None = None,
    pattern: str | None = None,
    stream: bool = True,
    order_by: str | None = None,
    **more,
) -> DataFrame:
    """Records from Kafka. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream if stream else spark.read
    options = kafka_options(servers, topics, pattern, **more)
    return as_feed(reader.format("kafka").options(**options).load(), order_by)


def file_feed(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    stream: bool = False,
    order_by: str | None = None,
    **options,
) -> DataFrame:
    """Records kept in files with the feed's columns, and a number to order by if named."""
    reader = spark.readStream if stream else spark.read
    schema = T.StructType([*FEED_SCHEMA.fields, *([T.StructField(order_by, T.LongType())] if order_by else [])])
    return reader.format(format).schema(schema).options(**options).load(path)


def spread(feed: DataFrame) -> DataFrame:
    """A batch of records, shuffled by offset.

    Parsing a record costs several times what moving its text does, so this pays
    for feeds of fewer partitions than there are cores. Kafka feeds get more
    partitions without a shuffle by the option minPartitions.
    """
    return feed if feed.isStreaming else feed.repartition("offset")


def by_topics(feed: DataFrame, topics: str | Iterable[str]) -> DataFrame:
    """Records of the listed topics."""
    listed = topic_list(topics if isinstance(topics, str) else ",".join(topics))
    return feed.where(F.col("topic").isin(*listed))


def by_pattern(feed: DataFrame, pattern: str) -> DataFrame:
    """Records of the topics whose whole name matches a regular expression."""
    return feed.where(F.col("topic").rlike(f"^(?:{pattern})$"))
