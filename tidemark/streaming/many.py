"""Many tables of one layout in one fold.

A micro-batch is folded once, by table and key, and what is left of it is written
once, in a folder for each table that had records. So the jobs of a micro-batch
are as many for a thousand tables as for one, and idle tables cost nothing. Since
a record's position decides which change wins, the tables are the fold of all that
was written, in whatever order the batches came and however often.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import named
from tidemark.functions.naming import routed_name
from tidemark.operators.decode import decode
from tidemark.operators.fold import batch_outcome, net_changes
from tidemark.table import DELETED, POS, REJECTED, TableSpec

TABLE = "_table"


def routed_outcome(feed: DataFrame, layout: TableSpec, table: Column) -> DataFrame:
    """What a batch amounts to for all tables, as ``batch_outcome`` with a column ``_table``.

    ``table`` names the table of a record's ``topic``. Records that it has no name
    for are not decoded.
    """
    return batch_outcome(decode(feed.where(table.isNotNull()), layout), layout, table)


def apply_to_many(
    feed: DataFrame,
    layout: TableSpec,
    tables: Sequence[str],
    folder: str,
    checkpoint: str,
    routes: Mapping[str, str] | None = None,
    default: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start a query that applies a streaming feed to tables of one layout, kept in one folder.

    Records find their table by ``routes`` (topic to table name), then ``default``,
    then the name rule; those for none of ``tables`` are kept under ``unrouted``.
    Runs until the feed is read up unless ``trigger`` says otherwise.
    """
    root = folder.rstrip("/")
    name = routed_name(F.col("topic"), routes, default)
    table = F.when(name.isin(*tables), name)

    def apply(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("this Spark does not tell which query a batch belongs to")
        tag = f"{query_id}-{batch_id}"
        outcome = routed_outcome(batch, layout, table)
        outcome.write.mode("overwrite").partitionBy(REJECTED, TABLE).parquet(f"{root}/changes/batch={tag}")
        batch.where(table.isNull()).write.mode("overwrite").parquet(f"{root}/unrouted/{tag}")

    return (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _written(spark: SparkSession, folder: str, schema: T.StructType, rejected: bool) -> DataFrame:
    folders = {"batch": T.StringType(), REJECTED: T.BooleanType(), TABLE: T.StringType()}
    parted = T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in folders.items()]])
    read = spark.read.schema(parted).parquet(f"{folder.rstrip('/')}/changes")
    return read.where(F.col(REJECTED) == rejected).select(*[named(c) for c in schema.names], TABLE)


def many_tables(spark: SparkSession, folder: str, layout: TableSpec, *names: str) -> DataFrame:
    """The rows of all tables, or of those named, whose folders alone are read then, with
    their table's name as ``_table``."""
    changes = _written(spark, folder, layout.state_schema, rejected=False)
    if names:
        changes = changes.where(F.col(TABLE).isin(*names))
    net = net_changes(changes, layout, F.col(TABLE))
    return net.where(~F.col(DELETED)).select(TABLE, *[named(c) for c in layout.columns])


def many_rejects(spark: SparkSession, folder: str, layout: TableSpec) -> DataFrame:
    """The records that could not be applied to their tables, each once, with the reason."""
    record = T.StructType([T.StructField(n, T.StringType()) for n in ("action", "raw_key", "raw_value")])
    schema = T.StructType([T.StructField(POS, layout.position), T.StructField("_record", record)])
    place = [F.col(f"{POS}.{c}") for c in ("topic", "partition", "offset")]
    found = _written(spark, folder, schema, rejected=True).select(TABLE, *place, "_record.*")
    return found.dropDuplicates(["topic", "partition", "offset"])


def many_unrouted(spark: SparkSession, folder: str) -> DataFrame:
    """The records that went to none of the tables, each once."""
    return spark.read.parquet(f"{folder.rstrip('/')}/unrouted/*").dropDuplicates(["topic", "partition", "offset"])
