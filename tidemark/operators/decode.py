"""Change records to typed, classified rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, any_of, named, settled
from tidemark.functions.connect import not_allowed
from tidemark.functions.envelope import (
    Fields,
    has_payload_field,
    key_payload,
    text_to,
    value_payload,
)
from tidemark.operators.order import commit_ordered
from tidemark.table import COMMIT, DELETED, GONE, POS, REJECTED, TableSpec

CREATE, UPDATE, DELETE = "create", "update", "delete"
APPLIED = (CREATE, UPDATE, DELETE)
BAD_KEY, BAD_VALUE, INVALID_OP, DRIFT = "bad_key", "bad_value", "invalid_op", "drift"
#: A value that the record's own schema does not allow, where the table asks for that.
NOT_ALLOWED = "not_allowed"
#: Set aside when a table is read: a change from a partition that its key has left.
MOVED_KEY = "moved_key"
#: Set aside by an overwrite, which takes the place of all records up to then.
SUPERSEDED = "superseded"
REASONS = (BAD_KEY, BAD_VALUE, INVALID_OP, DRIFT, NOT_ALLOWED)


def position(spec: TableSpec) -> Column:
    """Where a record stands in the feed, as a struct that orders changes."""
    time = _time(spec) if spec.order_column else F.lit(0).cast("long")
    return F.struct(time.alias("time"), "topic", "partition", "offset")


def _time(spec: TableSpec) -> Column:
    return F.col(COMMIT) if spec.source_order else named(spec.order_by).cast("long")


def _judged(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """Records with their place, raw texts, ``row`` and ``action``; not settled yet."""
    if spec.source_order and COMMIT not in feed.columns:
        feed = commit_ordered(feed, spec.source_order)
    keys = Fields(F.col("_key"), list(spec.keys), "_k")
    image = Fields(F.col("_value.after"), spec.columns, "_a")
    place = _place(spec)
    parsed = feed.select(
        *place,
        "key",
        "value",
        key_payload(F.col("key")).alias("_key"),
        value_payload(F.col("value")).alias("_value"),
    )
    parsed = parsed.select(
        *place,
        "key",
        "value",
        F.col("_value.op").alias("_op"),
        *keys.parts,
        *image.parts,
        *([F.map_keys("_value.after").alias("_names")] if spec.check_allowed else []),
    )
    is_delete = F.col("value").isNull()

    def text(field) -> Column:
        own = image.text(field.name)
        if field.name in spec.keys:
            return F.when(is_delete, keys.text(field.name)).otherwise(own)
        return own

    def cell(field) -> Column:
        written = spec.epochs.get(field.name) or spec.encodings.get(field.name)
        return text_to(text(field), field.dataType, written).alias(field.name)

    rows = parsed.withColumn("row", F.struct(*[cell(f) for f in spec.schema.fields]))

    def unreadable(of_key: bool) -> Column:
        """Whether a text is there that is no value of its column's type."""
        fields = [f for f in spec.schema.fields if (f.name in spec.keys) == of_key]
        return any_of(
            [F.lit(False)] + [text(f).isNotNull() & named(f.name, "row").isNull() for f in fields]
        )

    op = F.col("_op")
    key_known = all_of([named(k, "row").isNotNull() for k in spec.keys])
    required = [named(f.name, "row").isNull() for f in spec.schema.fields if not f.nullable]
    action = (
        F.when(~keys.exact(), BAD_KEY)
        .when(is_delete, F.when(key_known, DELETE).otherwise(BAD_KEY))
        .when(op.isNull(), BAD_VALUE)
        .when(
            ~op.isin(*spec.upsert_ops),
            F.when(has_payload_field(F.col("value"), "after"), INVALID_OP).otherwise(BAD_VALUE),
        )
        .when(image.values.isNull(), BAD_VALUE)
        .when(~image.complete(), DRIFT)
        .when(unreadable(of_key=True), BAD_KEY)
        .when(unreadable(of_key=False), BAD_VALUE)
    )
    if required:
        action = action.when(any_of(required), BAD_VALUE)
    if spec.check_allowed:
        broken = F.size(not_allowed(F.col("value"), F.map_from_arrays(F.col("_names"), image.values)))
        action = action.when(broken > 0, NOT_ALLOWED)
    action = action.when(op == "u", UPDATE).otherwise(CREATE)
    if spec.order_column:
        unordered = _time(spec).isNull()
        action = F.when(unordered & (action != BAD_KEY), BAD_VALUE).otherwise(action)
    return rows.withColumn("action", action)


def _place(spec: TableSpec) -> list[str]:
    ordered = [spec.order_column] if spec.order_column else []
    return ["topic", "partition", "offset", *[c for c in ordered if c not in ("topic", "partition", "offset")]]


def decode(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """Give each record an ``action`` and, as ``row``, the typed row it carries.

    An upsert's row is its row image; a delete's row holds the key only. The
    raw key and value stay with rejected records alone. A value that cannot be
    read as its column's type makes the record a ``bad_value``, or a ``bad_key``
    in a key column.
    """
    rejected = ~F.col("action").isin(*APPLIED)
    return settled(
        _judged(feed, spec),
        *[named(c) for c in _place(spec)],
        "action",
        "row",
        position(spec).alias(POS),
        F.when(rejected, F.col("key")).alias("raw_key"),
        F.when(rejected, F.col("value")).alias("raw_value"),
    )


def verdicts(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """Each record's place and ``action`` alone."""
    return settled(_judged(feed, spec), "topic", "partition", "offset", "action")


def all_records(decoded: DataFrame) -> DataFrame:
    """Every record as table columns plus bookkeeping, rejected ones included."""
    is_delete = F.col("action") == DELETE
    return decoded.select(
        "row.*",
        POS,
        is_delete.alias(DELETED),
        F.when(is_delete, F.col(POS)).alias(GONE),
        (~F.col("action").isin(*APPLIED)).alias(REJECTED),
        F.struct("action", "raw_key", "raw_value").alias("_record"),
    )


def changes(decoded: DataFrame) -> DataFrame:
    """The records that change the table, as table columns plus bookkeeping."""
    return all_records(decoded).where(~F.col(REJECTED)).drop(REJECTED, "_record")


def row_images(decoded: DataFrame) -> DataFrame:
    """Every created or updated row, in the table's columns."""
    return decoded.where(F.col("action").isin(CREATE, UPDATE)).select("row.*")


def deleted_keys(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """The keys of the delete records."""
    return decoded.where(F.col("action") == DELETE).select(
        *[named(k, "row").alias(k) for k in spec.keys]
    )


def rejects(decoded: DataFrame) -> DataFrame:
    """The records that cannot be applied, with the reason and the raw texts."""
    return decoded.where(F.col("action").isin(*REASONS)).select(
        "topic", "partition", "offset", "action", "raw_key", "raw_value"
    )


def key_columns(feed: DataFrame) -> DataFrame:
    """Per topic, the key column names its records carry and how often."""
    named_keys = feed.select("topic", F.explode(F.map_keys(key_payload(F.col("key")))).alias("c"))
    return named_keys.groupBy("topic", "c").agg(F.count(F.lit(1)).alias("n"))


def drift_check(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """How many row images fit the table and how many lack a column."""
    image = Fields(F.col("after"), spec.columns, "_a")
    images = feed.select(value_payload(F.col("value"))["after"].alias("after"))
    checked = settled(
        images.select(*image.parts),
        image.values.isNotNull().alias("has"),
        image.complete().alias("ok"),
    )
    return checked.where("has").groupBy("ok").agg(F.count(F.lit(1)).alias("n"))
