"""Applying a feed to stored tables, batch by batch."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.naming import routed_name
from tidemark.operators.audit import preview
from tidemark.operators.decode import APPLIED, REASONS, decode
from tidemark.operators.order import commit_key
from tidemark.sources.feed import spread
from tidemark.sources.store import TableStore
from tidemark.table import TableSpec

log = logging.getLogger(__name__)


def _audit_columns() -> list[Column]:
    counts = [F.count_if(F.col("action") == a).alias(a) for a in (*APPLIED, *REASONS)]
    return [*counts, F.min("offset").alias("lo"), F.max("offset").alias("hi")]


def apply_batch(
    feed: DataFrame, store: TableStore, tag: str, spread_records: bool = False
) -> dict | None:
    """Apply one batch of records to one table and return what was seen.

    The tag names the batch: a batch that was committed before is left alone
    (None), one that broke off is written anew.
    """
    seen = Observation()
    records = spread(feed) if spread_records else feed
    decoded = decode(records, store.spec).observe(seen, *_audit_columns())
    if not store.commit(decoded, tag):
        return None
    audit = seen.get
    log.info("table %s, batch %s: %s", store.spec.name, tag, audit)
    return audit


def unrouted_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records that went to no table, each once however often it was replayed."""
    return spark.read.parquet(f"{folder.rstrip('/')}/*").dropDuplicates(["topic", "partition", "offset"])


def apply_stream(
    feed: DataFrame,
    stores: TableStore | Sequence[TableStore],
    checkpoint: str,
    routes: Mapping[str, str] | None = None,
    default: str | None = None,
    unrouted: str | None = None,
    compact_ratio: float | None = None,
    compact_every: int = 1,
    forget: Column | None = None,
    show: bool = False,
    spread_records: bool = False,
    tables_at_once: int = 8,
    progress: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start a query that applies a streaming feed to its tables.

    Records find their table by ``routes`` (topic to table name), then
    ``default``, then the name rule; those for no listed table are written to
    the folder ``unrouted``. One table given without any of the three takes
    every topic. A routed batch is written once, by table, and the tables that it
    has records for then take their parts at the same time; nothing is written
    for the others.

    Compaction is left to a call of ``compact`` while no query runs. With a
    ``compact_ratio`` a table is compacted after every ``compact_every``-th batch
    if its changes exceed that ratio x its snapshot, without the delete markers
    that ``forget``, a condition on ``_pos``, allows to drop.

    ``progress`` names a folder that keeps what each batch brought to each table;
    see ``stream_progress``.

    A new checkpoint replays the feed from its start, which leaves a table as it
    was. ``spread_records`` shuffles the records of a feed with few large
    partitions before parsing them. Runs until the feed is read up unless
    ``trigger`` says otherwise.
    """
    stores = [stores] if isinstance(stores, TableStore) else list(stores)
    routed = len(stores) > 1 or bool(routes) or default is not None or unrouted is not None
    if routed and not unrouted:
        raise ValueError("routed records need a folder for those that go to none of the tables")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("this Spark does not tell which query a batch belongs to")
        tag = f"{query_id}-{batch_id}"
        if routed:
            changed = _apply_routed(batch, tag)
        else:
            changed = stores
            note(apply_batch(batch, stores[0], tag, spread_records), stores[0], tag)
        for store in changed:
            if compact_ratio is not None and (batch_id + 1) % compact_every == 0:
                store.compact_if_due(compact_ratio, forget)
            if show:
                preview(store.read(), store.spec.keys).show()

    def note(audit: dict | None, store: TableStore, tag: str) -> None:
        if progress and audit is not None:
            write_progress(store.spark, progress, store.spec.name, tag, audit)

    def _apply_routed(batch: DataFrame, tag: str) -> list[TableStore]:
        listed = [store.spec.name for store in stores]
        name = routed_name(F.col("topic"), routes, default)
        staged = f"{checkpoint.rstrip('/')}/routed/{tag}"
        parted = batch.withColumn("_table", F.when(name.isin(*listed), name))
        parted.write.mode("overwrite").partitionBy("_table").parquet(staged)
        schema = parted.schema  # not inferred: a table may be named like a number
        records = batch.sparkSession.read.schema(schema).parquet(staged)

        def apply_table(store: TableStore) -> None:
            own = records.where(F.col("_table") == store.spec.name).drop("_table")
            note(apply_batch(own, store, tag, spread_records), store, tag)

        named = _folders(batch.sparkSession, staged)
        changed = [s for s in stores if f"_table={escaped(batch.sparkSession, s.spec.name)}" in named]
        with ThreadPoolExecutor(min(tables_at_once, len(stores))) as pool:
            work = inheritable_thread_target(batch.sparkSession)(apply_table)
            list(pool.map(work, changed))
        lost = records.where("_table IS NULL").drop("_table")
        lost.write.mode("overwrite").parquet(f"{unrouted.rstrip('/')}/{tag}")
        _remove(batch.sparkSession, staged)
        return changed

    return (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def escaped(spark: SparkSession, name: str) -> str:
    """A value as Spark writes it in the name of a partition's folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)


def _folders(spark: SparkSession, folder: str) -> set[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in files.listStatus(path)}


PROGRESS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("batch", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in (*APPLIED, *REASONS, "lo", "hi")],
    ]
)


def write_progress(spark: SparkSession, folder: str, table: str, tag: str, audit: Mapping[str, object]) -> None:
    """What a batch brought: one row in a folder of its own, so that a batch that is done again is counted once."""
    row = {"table_name": table, "batch": tag} | {k: audit[k] for k in PROGRESS.names[2:]}
    noted = spark.createDataFrame([row], PROGRESS)
    noted.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{table}-{tag}")


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each batch and table: records by what became of them, and their range of offsets."""
    return spark.read.schema(PROGRESS).parquet(f"{folder.rstrip('/')}/*")


def redrive(store: TableStore, spec: TableSpec, tag: str) -> bool:
    """Decode the rejected records again, as ``spec`` now has it, and apply those that can be.

    They stand where they stood in the feed, so that later changes of their keys
    keep winning. ``spec`` has the table's columns and key; what it takes as
    upserts and how it reads cells may differ. ``rejects`` goes on listing what
    batches have rejected, these records too. False if the tag is there already.
    """
    spec_columns = (spec.schema, spec.keys, spec.order_column)
    if spec_columns != (store.spec.schema, store.spec.keys, store.spec.order_column):
        raise ValueError(f"{spec.name}: records are driven again into the same columns, key and order")
    records = store.rejects(times=True).where(F.col("action").isin(*REASONS))
    feed = records.select(
        "topic",
        "partition",
        "offset",
        F.col("raw_key").alias("key"),
        F.col("raw_value").alias("value"),
        *([F.col("time").alias(spec.order_column)] if spec.order_column else []),
    )
    return store.commit(decode(feed, spec), tag)


def once_by_source(feed: DataFrame, fields: Mapping[str, str], delay: str) -> DataFrame:
    """A streaming feed without the records that its source has sent again.

    A record is known by its topic and its log numbers (see ``commit_key``), one
    without them by its place in the feed. It is remembered for ``delay`` after it
    was read. That is the time of reading, not the record's own: so no record is
    too late and lost, however old it is.
    """
    place = F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string"))
    log = F.concat(F.lit("log "), F.hex(commit_key(F.col("value"), fields)))
    known = feed.withColumns({"_known": F.coalesce(log, F.concat(F.lit("at "), place)), "_read": F.current_timestamp()})
    once = known.withWatermark("_read", delay).dropDuplicatesWithinWatermark(["topic", "_known"])
    return once.select(*feed.columns)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
