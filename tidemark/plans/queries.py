"""The registered queries: each operator over whole test tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import settled
from tidemark.functions.connect import connect_schema, enum_check, schema_history
from tidemark.functions.envelope import value_payload
from tidemark.functions.inference import inferred_schema
from tidemark.functions.naming import routed_name, table_name
from tidemark.operators import audit, decode as d, merge as m
from tidemark.operators.fold import last_per_key, rows_after
from tidemark.operators.order import commit_key
from tidemark.operators.runs import offset_gaps
from tidemark.plans.feeds import (
    BY_LABEL,
    CHECKED,
    COMMITTED,
    CURRENT,
    OPEN,
    REPEATED,
    TIMED,
    TYPED,
    commit_feed,
    customer_base,
    customer_base_by_label,
    event_feed,
    event_image,
    events,
    holed_feed,
    moving_feed,
    order_base,
    order_feed,
    schema_feed,
    untyped_feed,
)
from tidemark.sources.feed import by_pattern, by_topics, file_feed, spread
from tidemark.sources.store import TableStore
from tidemark.sources.tables import append_path, scan_path
from tidemark.sources.workdir import work_dir
from tidemark.streaming.apply import apply_stream, once_by_source, redrive, stream_progress, unrouted_records
from tidemark.streaming.many import apply_to_many, many_tables
from tidemark.table import TableSpec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_feed(events(spark, sf_dir))


def dealt_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, its records dealt by offset to as many tasks as their size asks for, and so
    to as many files where it is written, however the events lay."""
    return event_feed(events(spark, sf_dir).repartition("event_id"))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.decode(spread(feed(spark, sf_dir)), CURRENT)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.changes(decoded(spark, sf_dir))


# -- reading and classifying the feed ---------------------------------------


@query
def decode_feed(spark, sf_dir):
    upserts = decoded(spark, sf_dir).where(F.col("action").isin(d.CREATE, d.UPDATE))
    return upserts.select("offset", "row.*")


@query
def decode_rows(spark, sf_dir):
    return d.row_images(decoded(spark, sf_dir))


@query
def classify_actions(spark, sf_dir):
    return audit.action_counts(d.verdicts(spread(feed(spark, sf_dir)), CURRENT))


@query
def feed_audit(spark, sf_dir):
    return audit.feed_audit(d.verdicts(spread(feed(spark, sf_dir)), CURRENT))


@query
def rejects(spark, sf_dir):
    return d.rejects(decoded(spark, sf_dir)).select("topic", "partition", "offset", "action")


@query
def topic_filter(spark, sf_dir):
    chosen = by_topics(feed(spark, sf_dir), "srv.db.dbo.Emp0,srv.db.dbo.Emp2,srv.db.dbo.Emp0")
    return chosen.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query
def topic_pattern(spark, sf_dir):
    chosen = by_pattern(feed(spark, sf_dir), r"srv\..*Emp[01]")
    return chosen.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query
def route_topics(spark, sf_dir):
    upserts = decoded(spark, sf_dir).where(F.col("action").isin(d.CREATE, d.UPDATE))
    return upserts.groupBy(table_name(F.col("topic")).alias("table_name")).agg(
        F.countDistinct("row.ID").alias("k")
    )


@query
def route_constant(spark, sf_dir):
    routed = routed_name(F.col("topic"), default=CURRENT.name).alias("table_name")
    return feed(spark, sf_dir).groupBy(routed).agg(F.count(F.lit(1)).alias("n"))


@query
def route_map(spark, sf_dir):
    routes = {"srv.db.dbo.Emp0": "staff", "srv.db.dbo.Emp1": "staff"}
    routed = routed_name(F.col("topic"), routes).alias("table_name")
    return feed(spark, sf_dir).groupBy(routed).agg(F.count(F.lit(1)).alias("n"))


@query
def key_columns(spark, sf_dir):
    return d.key_columns(spread(feed(spark, sf_dir)))


@query
def explode_entries(spark, sf_dir):
    records = settled(spread(feed(spark, sf_dir)), value_payload(F.col("value")).alias("payload"))
    entries = audit.explode_entries(records.where("payload.op = 'u'"), F.col("payload.after"))
    return entries.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("nv"))


@query
def typed_rows(spark, sf_dir):
    """Rows with numbers, decimals, truth values and times, as far as every cell is one."""
    rows = d.row_images(d.decode(spread(order_feed(spark, sf_dir)), TYPED))
    parts = [F.col("Due").cast("string").alias("Due"), F.col("Part.Code").alias("Code"), F.col("Part.Weight").alias("Weight")]
    return rows.select(*[c for c in TYPED.columns if c not in ("Due", "Part")], *parts)


@query
def typed_actions(spark, sf_dir):
    """How many of the typed rows have a cell that cannot be read."""
    return audit.action_counts(d.verdicts(spread(order_feed(spark, sf_dir)), TYPED))


@query
def drift_check(spark, sf_dir):
    """Row images built as text: Amount is left out of some, others have a
    column the table lacks, and every name is in a case of its own."""
    n = F.col("event_id")
    image = F.concat(
        F.lit('{"id":'), F.col("user_id").cast("string"),
        F.lit(',"LABEL":"'), F.col("event_type"), F.lit('"'),
        F.when(n % 7 != 0, F.concat(F.lit(',"amount":'), F.col("value").cast("string")))
        .otherwise(""),
        F.when(n % 11 == 0, F.lit(',"Extra":true')).otherwise(""),
        F.lit(',"Note":null}'),
    )
    value = F.concat(F.lit('{"payload":{"op":"u","after":'), image, F.lit("}}"))
    return d.drift_check(events(spark, sf_dir).select(value.alias("value")), CURRENT)


@query
def record_schema(spark, sf_dir):
    return connect_schema(spread(schema_feed(events(spark, sf_dir))))


@query
def carried_schemas(spark, sf_dir):
    """From where to where along each partition records carry the same schema."""
    return schema_history(spread(schema_feed(events(spark, sf_dir))))


@query
def enum_cells(spark, sf_dir):
    """Cells whose value the record's own schema does not allow."""
    return enum_check(spread(schema_feed(events(spark, sf_dir))))


@query
def allowed_actions(spark, sf_dir):
    """The same as a reason to reject records."""
    return audit.action_counts(d.verdicts(spread(schema_feed(events(spark, sf_dir))), CHECKED))


@query
def inferred_columns(spark, sf_dir):
    """Columns and types of two topics that no table is declared for."""
    return inferred_schema(spread(untyped_feed(spark, sf_dir)))


@query
def missing_offsets(spark, sf_dir):
    return offset_gaps(holed_feed(events(spark, sf_dir)))


# -- last change per key ----------------------------------------------------


@query
def last_change(spark, sf_dir):
    kinds = decoded(spark, sf_dir).where(F.col("action").isin(*d.APPLIED))
    picked = kinds.select("row.ID", "action", "_pos")
    return last_per_key(picked, CURRENT).select("ID", "_pos.offset", "action")


@query
def state_after_feed(spark, sf_dir):
    return rows_after(changes(spark, sf_dir), CURRENT)


# -- changing tables --------------------------------------------------------


@query
def upsert_merge(spark, sf_dir):
    return m.apply_changes(customer_base(spark, sf_dir), changes(spark, sf_dir), CURRENT)


@query
def commit_order(spark, sf_dir):
    """Keys that move between partitions, ordered by the log numbers in their envelopes."""
    records = d.decode(commit_feed(events(spark, sf_dir)), COMMITTED)
    return m.apply_changes(customer_base(spark, sf_dir), d.changes(records), COMMITTED)


@query
def delete_by_key(spark, sf_dir):
    gone = d.deleted_keys(decoded(spark, sf_dir), CURRENT)
    return m.delete_by_key(customer_base(spark, sf_dir), gone, CURRENT)


@query
def merge_composite_key(spark, sf_dir):
    records = event_feed(events(spark, sf_dir), keys=BY_LABEL.keys)
    applied = d.changes(d.decode(spread(records), BY_LABEL))
    return m.apply_changes(customer_base_by_label(spark, sf_dir), applied, BY_LABEL)


@query
def merge_multi_match(spark, sf_dir):
    return m.apply_changes(order_base(spark, sf_dir), changes(spark, sf_dir), REPEATED)


@query
def merge_null_key(spark, sf_dir):
    """Signups carry a null key, so each of them is a row of its own."""
    unknown = F.when(F.col("event_type") != "signup", F.col("user_id"))
    records = event_feed(events(spark, sf_dir), event_image(id=unknown))
    applied = d.changes(d.decode(spread(records), OPEN))
    return m.apply_changes(customer_base(spark, sf_dir), applied, OPEN)


@query
def append_log(spark, sf_dir):
    return m.append_log(customer_base(spark, sf_dir), decoded(spark, sf_dir))


@query
def keyed_update(spark, sf_dir):
    return m.keyed_update(
        customer_base(spark, sf_dir), {"label": "BUILDING"}, {"Note": "hold", "Label": "ignored"}
    )


@query
def keyed_update_overwrite(spark, sf_dir):
    return m.keyed_update_overwrite(
        customer_base(spark, sf_dir), {"Label": "BUILDING"}, {"Note": "hold"}
    )


@query
def filter_by_conditions(spark, sf_dir):
    wanted = [{"column": "l_linenumber", "value": "3"}, {"column": "L_RETURNFLAG", "value": "A"}]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return m.filter_by_conditions(lines, wanted).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )


@query
def preview(spark, sf_dir):
    return audit.preview(upsert_merge(spark, sf_dir), CURRENT.keys)


# -- stored tables and streams ----------------------------------------------


def _seeded(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> TableStore:
    store = TableStore(spark, work_dir(spark), CURRENT, buckets)
    store.overwrite(customer_base(spark, sf_dir))
    return store


PARTS = 5


def _feed_folder(spark: SparkSession, records: DataFrame, order: str = "offset") -> str:
    """A feed as files, the latest records first: a stream takes them part by part."""
    folder = f"{work_dir(spark)}/feed"
    top = records.agg(F.max(order)).first()[0] or 0
    part = F.floor(F.col(order) * PARTS / F.lit(top + 1))
    for n in reversed(range(PARTS)):
        records.where(part == n).write.mode("append").parquet(folder)
    return folder


def _files_at_once(spark: SparkSession, folder: str, batches: int = PARTS) -> int:
    """How many of a feed's files a batch takes, so that the batches are not more for a larger feed."""
    return max(1, math.ceil(len(spark.read.parquet(folder).inputFiles()) / batches))


def _run(spark: SparkSession, folder: str, stores, order_by: str | None = None, **options) -> None:
    files = _files_at_once(spark, folder)
    stream = file_feed(spark, folder, stream=True, order_by=order_by, maxFilesPerTrigger=files)
    checkpoint = f"{work_dir(spark)}/checkpoint"
    apply_stream(stream, stores, checkpoint, **options).awaitTermination()


def _streamed(spark: SparkSession, sf_dir: str, store: TableStore, **options) -> str:
    """Apply the event feed to a store, and return the feed's folder."""
    folder = _feed_folder(spark, dealt_feed(spark, sf_dir))
    _run(spark, folder, store, **options)
    return folder


@query
def overwrite_table(spark, sf_dir):
    store = TableStore(spark, work_dir(spark), CURRENT)
    store.overwrite(customer_base_by_label(spark, sf_dir))
    store.overwrite(customer_base(spark, sf_dir))
    return store.read()


@query
def overwrite_then_feed(spark, sf_dir):
    """An overwrite takes the place of the feed's first half, which is replayed after it;
    the second half comes from topics made anew, whose offsets begin at 0 again."""
    store = TableStore(spark, work_dir(spark), TIMED)
    records = moving_feed(dealt_feed(spark, sf_dir))
    half = F.lit((records.agg(F.max("timestamp")).first()[0] or 0) // 2)
    first = records.where(F.col("timestamp") < half)
    second = records.where(F.col("timestamp") >= half).withColumn("offset", F.col("offset") - F.floor(half / 4))
    folder = _feed_folder(spark, first, "timestamp")
    _run(spark, folder, store, "timestamp", compact_ratio=None)
    store.overwrite(customer_base(spark, sf_dir))
    second.write.mode("append").parquet(folder)
    _run(spark, folder, store, "timestamp", compact_ratio=None)
    return store.read()


@query
def scan_table(spark, sf_dir):
    return _seeded(spark, sf_dir).read()


@query
def append_table(spark, sf_dir):
    path = f"{work_dir(spark)}/log"
    customer_base(spark, sf_dir).write.parquet(path)
    append_path(decoded(spark, sf_dir), path)
    return scan_path(spark, path)


@query
def apply_stream_table(spark, sf_dir):
    store = _seeded(spark, sf_dir)
    _streamed(spark, sf_dir, store, compact_ratio=0.0, compact_every=2)
    return store.read()


@query
def compacted_table(spark, sf_dir):
    store = _seeded(spark, sf_dir)
    _streamed(spark, sf_dir, store, compact_ratio=None)
    store.compact()
    return store.read()


@query
def bucketed_table(spark, sf_dir):
    store = _seeded(spark, sf_dir, buckets=8)
    _streamed(spark, sf_dir, store, compact_ratio=None)
    return store.read()


@query
def merge_multi_match_compacted(spark, sf_dir):
    """Repeated keys, batches from the last to the first, a snapshot after each."""
    store = TableStore(spark, work_dir(spark), REPEATED)
    store.overwrite(order_base(spark, sf_dir))
    _streamed(spark, sf_dir, store, compact_ratio=0.0)
    return store.read()


@query
def replay(spark, sf_dir):
    """The feed applied twice from its start, with a snapshot in between."""
    store = _seeded(spark, sf_dir)
    folder = _streamed(spark, sf_dir, store, compact_ratio=0.0, compact_every=PARTS)
    _run(spark, folder, store, compact_ratio=None)
    return store.read()


@query
def moved_keys(spark, sf_dir):
    """Keys that move between partitions, ordered by the records' timestamps."""
    store = TableStore(spark, work_dir(spark), TIMED)
    store.overwrite(customer_base(spark, sf_dir))
    folder = _feed_folder(spark, moving_feed(dealt_feed(spark, sf_dir)), "timestamp")
    _run(spark, folder, store, "timestamp", compact_ratio=0.0, compact_every=2)
    return store.read()


@query
def moved_keys_rejected(spark, sf_dir):
    """The same without a declared order: a key keeps to one partition."""
    store = TableStore(spark, work_dir(spark), CURRENT)
    _run(spark, _feed_folder(spark, moving_feed(dealt_feed(spark, sf_dir)).drop("timestamp")), store, compact_ratio=None)
    moved = store.rejects().where(F.col("action") == d.MOVED_KEY)
    return moved.select("topic", "partition", "offset")


@query
def stored_update(spark, sf_dir):
    """Rows changed by a condition stay so when the feed is replayed."""
    store = _seeded(spark, sf_dir)
    folder = _streamed(spark, sf_dir, store, compact_ratio=None)
    store.update_where({"Label": "view"}, {"Note": "hold"})
    _run(spark, folder, store, compact_ratio=None)
    return store.read()


@query
def stored_delete(spark, sf_dir):
    """Rows deleted by a condition stay so when the feed is replayed."""
    store = _seeded(spark, sf_dir)
    folder = _streamed(spark, sf_dir, store, compact_ratio=None)
    store.delete_where({"Label": "view"})
    _run(spark, folder, store, compact_ratio=None)
    return store.read()


def _rejected(store: TableStore) -> DataFrame:
    return store.rejects().select("topic", "partition", "offset", "action")


@query
def apply_stream_rejects(spark, sf_dir):
    store = TableStore(spark, work_dir(spark), CURRENT)
    _streamed(spark, sf_dir, store, compact_ratio=None)
    return _rejected(store)


@query
def replay_rejects(spark, sf_dir):
    """However often a feed is replayed, a record is rejected once."""
    store = TableStore(spark, work_dir(spark), CURRENT)
    folder = _streamed(spark, sf_dir, store, compact_ratio=0.0, compact_every=PARTS)
    _run(spark, folder, store, compact_ratio=None)
    return _rejected(store)


def _routed(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """Rows of each table after a stream, and the records that went to none."""
    root = work_dir(spark)
    stores = [TableStore(spark, root, TableSpec(n, CURRENT.schema, CURRENT.keys)) for n in names]
    unrouted = f"{root}/unrouted"
    _run(spark, _feed_folder(spark, dealt_feed(spark, sf_dir)), stores, compact_ratio=None, unrouted=unrouted)
    counts = unrouted_records(spark, unrouted).agg(
        F.lit("unrouted").alias("table_name"), F.count(F.lit(1)).alias("n")
    )
    for store, name in zip(stores, names):
        rows = store.read().agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        counts = counts.unionByName(rows)
    return counts


@query
def apply_stream_routed(spark, sf_dir):
    """Topics to their own tables by name; one topic has no table here."""
    return _routed(spark, sf_dir, ["srv_db_dbo_emp0", "srv_db_dbo_emp1"])


@query
def route_one_table(spark, sf_dir):
    """A single table takes only what is routed to it."""
    return _routed(spark, sf_dir, ["srv_db_dbo_emp0"])


@query
def stream_dedup(spark, sf_dir):
    """A feed of which some records are sent again at other offsets, read by a stream
    that stops half-way: what becomes of each record that its source sent once."""
    records = commit_feed(events(spark, sf_dir))
    again = records.where((F.col("offset") % 5 == 0) & commit_key(F.col("value"), COMMITTED.source_order).isNotNull())
    folder, out, checkpoint = (f"{work_dir(spark)}/{part}" for part in ("feed", "out", "checkpoint"))
    resent = again.withColumn("offset", F.col("offset") + 1_000_000_000)
    for n in (0, 1):
        records.where(F.col("partition") % 2 == n).write.mode("append").parquet(folder)
        resent.where(F.col("partition") % 2 != n).write.mode("append").parquet(folder)
        stream = file_feed(spark, folder, stream=True, maxFilesPerTrigger=_files_at_once(spark, folder, n + 1))
        once = once_by_source(stream, COMMITTED.source_order, "7 days")
        writer = once.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.format("parquet").option("path", out).start().awaitTermination()
    return audit.action_counts(d.verdicts(spread(file_feed(spark, out)), CURRENT))


@query
def noted_progress(spark, sf_dir):
    """What the batches of a stream brought, all in all."""
    store, progress = TableStore(spark, work_dir(spark), CURRENT), f"{work_dir(spark)}/progress"
    _streamed(spark, sf_dir, store, progress=progress)
    noted = stream_progress(spark, progress)
    counts = [F.sum(c).alias(c) for c in (*d.APPLIED, *d.REASONS)]
    return noted.groupBy("table_name").agg(*counts, F.min("lo").alias("lo"), F.max("hi").alias("hi"))


@query
def redriven_rejects(spark, sf_dir):
    """Creates are rejected at first; driven again, they stand where they stood in the feed."""
    strict = TableSpec(CURRENT.name, CURRENT.schema, CURRENT.keys, upsert_ops=("u",), unique=True)
    store = TableStore(spark, work_dir(spark), strict)
    _streamed(spark, sf_dir, store)
    redrive(store, CURRENT, "again")
    return store.read()


TABLES = 50


@query
def tables_at_once(spark, sf_dir):
    """Fifty topics to tables of their own, all in one fold of each batch."""
    topic = F.concat(F.lit("srv.db.dbo.T"), (F.col("user_id") % TABLES).cast("string"))
    users = events(spark, sf_dir).select(F.col("event_id").alias("offset"), topic.alias("own"))
    records = dealt_feed(spark, sf_dir).join(users, "offset").drop("topic").withColumnRenamed("own", "topic")
    root = work_dir(spark)
    folder = _feed_folder(spark, records)
    stream = file_feed(spark, folder, stream=True, maxFilesPerTrigger=_files_at_once(spark, folder))
    names = [f"srv_db_dbo_t{n}" for n in range(TABLES)]
    apply_to_many(stream, CURRENT, names, root, f"{work_dir(spark)}/checkpoint").awaitTermination()
    return many_tables(spark, root, CURRENT).withColumnRenamed("_table", "table_name")


# Names under which some of the queries above are listed.
QUERIES["apply_stream"] = QUERIES.pop("apply_stream_table")
QUERIES["last_per_key"] = QUERIES.pop("last_change")
QUERIES["connect_schema"] = QUERIES.pop("record_schema")
QUERIES["schema_history"] = QUERIES.pop("carried_schemas")
QUERIES["enum_check"] = QUERIES.pop("enum_cells")
QUERIES["inferred_schema"] = QUERIES.pop("inferred_columns")
QUERIES["many_tables"] = QUERIES.pop("tables_at_once")
QUERIES["stream_progress"] = QUERIES.pop("noted_progress")
QUERIES["offset_gaps"] = QUERIES.pop("missing_offsets")
