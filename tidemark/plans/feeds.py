"""Change feeds and target tables derived from the test tables.

Every event becomes one change record with real JSON in key and value, so the
queries run the same decoding as a live feed. Signups create, errors stand for
deletes and broken records of each kind, all other events update.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.table import TableSpec

COLUMNS = T.StructType(
    [
        T.StructField("ID", T.LongType(), nullable=False),
        T.StructField("Label", T.StringType()),
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Note", T.StringType()),
    ]
)
CURRENT = TableSpec("current", COLUMNS, ("ID",), unique=True)
# A target that may hold many rows for a key.
REPEATED = TableSpec("repeated", COLUMNS, ("ID",))
OPEN = TableSpec("open", T.StructType([T.StructField(f.name, f.dataType) for f in COLUMNS]), ("ID",))
BY_LABEL = TableSpec(
    "by_label",
    T.StructType([T.StructField(f.name, f.dataType, f.name not in ("ID", "Label")) for f in COLUMNS]),
    ("ID", "Label"),
    unique=True,
)

PART = T.StructType([T.StructField("Code", T.StringType()), T.StructField("Weight", T.DecimalType(6, 1))])
# Orders with a column of each kind of type; times come as milliseconds.
TYPED = TableSpec(
    "typed",
    T.StructType(
        [
            T.StructField("ID", T.LongType(), nullable=False),
            T.StructField("Cust", T.IntegerType()),
            T.StructField("Price", T.DecimalType(12, 2)),
            T.StructField("Open", T.BooleanType()),
            T.StructField("Placed", T.TimestampNTZType()),
            T.StructField("Due", T.DateType()),
            T.StructField("Part", PART),
        ]
    ),
    ("ID",),
    epochs={"Placed": "ms"},
)
# Changes ordered by a column of the feed, wherever they come from.
TIMED = TableSpec("current", COLUMNS, ("ID",), order_by="timestamp", unique=True)

# Changes ordered by the log numbers inside their envelopes.
COMMITTED = TableSpec(
    "current",
    COLUMNS,
    ("ID",),
    source_order={"commit_lsn": "hex", "change_lsn": "hex", "event_serial_no": "number"},
    unique=True,
)
# Row images held against the values that their own schemas allow.
CHECKED = TableSpec("current", COLUMNS, ("ID",), unique=True, check_allowed=True)

KEEP_NULLS = {"ignoreNullFields": "false"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_image(id: Column | None = None) -> dict[str, Column]:
    """The row image of an event, by column name."""
    return {
        "ID": F.col("user_id") if id is None else id,
        "Label": F.col("event_type"),
        "Amount": F.col("value"),
        "Note": F.when(F.col("event_id") % 5 != 0, F.col("props")),
    }


def _json(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), KEEP_NULLS)


def _object(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def event_feed(
    events: DataFrame,
    image: dict[str, Column] | None = None,
    keys: tuple[str, ...] = ("ID",),
    value_schema: Column | None = None,
    source: Column | None = None,
) -> DataFrame:
    """One change record per event, offset by event id, partitioned by user."""
    image = image or event_image()
    kind, n = F.col("event_type"), F.col("event_id")
    error = kind == "error"
    op = (
        F.when(kind == "signup", "c")
        .when(~error, "u")
        .when(n % 4 == 1, "d")
        .when(n % 4 == 2, "r")
    )
    # an error record carries no row image
    after = F.when(~error, _object(image))
    payload = {"before": F.lit(None).cast("string"), "after": after, "op": op}
    if source is not None:
        payload["source"] = source
    value = {"payload": _object(payload)}
    if value_schema is not None:
        value = {"schema": value_schema, **value}
    key = {"payload": _object({k: image[k] for k in keys})}
    return events.select(
        F.concat(F.lit("srv.db.dbo.Emp"), (F.col("user_id") % 3).cast("string")).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        n.alias("offset"),
        F.when(~(error & (n % 8 == 7)), _json(key)).alias("key"),
        F.when(error & (n % 8 == 3), "not json")
        .when(~(error & (n % 4 == 0)), _json(value))
        .alias("value"),
    )


def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as a target table. Their ids are doubled, so that every
    other event user is already in the table at any scale."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        (F.col("c_custkey") * 2).alias("ID"),
        F.col("c_mktsegment").alias("Label"),
        F.col("c_acctbal").alias("Amount"),
        F.col("c_name").alias("Note"),
    )


def customer_base_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers under event type labels, for the two-column key."""
    labels = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        (F.col("c_custkey") * 2).alias("ID"),
        F.get(labels, F.col("c_nationkey") % 5).alias("Label"),
        F.col("c_acctbal").alias("Amount"),
        F.col("c_name").alias("Note"),
    )


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders under their customer's id: a target with repeated keys."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        (F.col("o_custkey") * 2).alias("ID"),
        F.col("o_orderpriority").alias("Label"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderstatus").alias("Note"),
    )


def moving_feed(feed: DataFrame) -> DataFrame:
    """The same changes with their order as a timestamp. Keys move between topics
    and partitions, and each partition counts its own offsets."""
    n = F.col("offset")
    return feed.select(
        F.concat(F.lit("srv.db.dbo.Emp"), (n % 3).cast("string")).alias("topic"),
        (n % 4).cast("int").alias("partition"),
        F.floor(n / 4).alias("offset"),
        "key",
        "value",
        n.alias("timestamp"),
    )


def _log_number(n: Column) -> Column:
    """A number as groups of hex digits, the way logs number their records."""
    groups = ((F.floor(n / 4096), 8), (n % 4096, 8), (n % 7, 4))
    return F.concat_ws(":", *[F.lower(F.lpad(F.hex(g.cast("long")), width, "0")) for g, width in groups])


def commit_feed(events: DataFrame) -> DataFrame:
    """The same changes with their order in the envelope alone: three to a commit, told
    apart by the change's number. Keys move between topics and partitions, which count
    their own offsets; a delete is announced by a record with its log numbers."""
    n = F.col("event_id")
    source = _object(
        {
            "commit_lsn": _log_number(F.floor(n / 3) * 3),
            "change_lsn": _log_number(n),
            "event_serial_no": F.lit(1),
        }
    )
    feed = event_feed(events, source=source)
    announced = _json({"payload": _object({"after": F.lit(None).cast("string"), "op": F.lit("d"), "source": source})})
    records = feed.join(events.select(n.alias("offset"), announced.alias("announced")), "offset")
    first = F.struct(F.lit(0).alias("nth"), F.coalesce("value", "announced").alias("value"))
    second = F.struct(F.lit(1).alias("nth"), F.col("value"))
    both = records.withColumn("sent", F.explode(F.when(F.col("value").isNull(), F.array(first, second)).otherwise(F.array(first))))
    n = F.col("offset")
    return both.select(
        F.concat(F.lit("srv.db.dbo.Emp"), (n % 3).cast("string")).alias("topic"),
        (n % 4).cast("int").alias("partition"),
        (F.floor(n / 4) * 2 + F.col("sent.nth")).alias("offset"),
        "key",
        "sent.value",
    )


SCHEMA_BLOCK_TYPE = (
    "type STRING, fields ARRAY<STRUCT<field: STRING, type: STRING, fields: ARRAY<STRUCT<field: STRING, "
    "type: STRING, optional: BOOLEAN, parameters: STRUCT<allowed: STRING>>>>>"
)
#: The schemas that records carry, by turns: columns, types and allowed values.
VERSIONS = (
    (("ID", "int64", None), ("Label", "string", None), ("Amount", "float64", None), ("Note", "string", None)),
    (("ID", "int64", None), ("Label", "string", "click, purchase, signup"), ("Amount", "float64", None), ("Note", "string", None)),
    (("ID", "int32", None), ("Label", "string", None), ("Amount", "float64", None)),
)
#: Events that carry the same schema before the next one has its turn.
TURN = 700


def schema_feed(events: DataFrame) -> DataFrame:
    """Change records whose embedded schema changes along the feed."""

    def block(columns) -> Column:
        row = [{"field": c, "type": t, "optional": c != "ID", "parameters": a and {"allowed": a}} for c, t, a in columns]
        fields = [{"field": side, "type": "struct", "fields": row} for side in ("before", "after")]
        return F.from_json(F.lit(json.dumps({"type": "struct", "fields": fields})), SCHEMA_BLOCK_TYPE)

    turn = F.floor(F.col("event_id") / TURN) % len(VERSIONS)
    carried = F.when(turn == 0, block(VERSIONS[0])).when(turn == 1, block(VERSIONS[1])).otherwise(block(VERSIONS[2]))
    return event_feed(events, value_schema=carried)


def holed_feed(events: DataFrame) -> DataFrame:
    """Records of one topic, numbered in each partition, of which some were lost."""
    n = F.col("event_id")
    lost = (n % 89 < 9) | (F.floor(n / 512) % 5 == 3)
    return event_feed(events.where(~lost)).select(
        F.lit("srv.db.dbo.Emp").alias("topic"),
        (F.col("offset") % 4).cast("int").alias("partition"),
        F.floor(F.col("offset") / 4).alias("offset"),
        "key",
        "value",
    )


def untyped_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and orders without a declared table, some of their columns of mixed types."""
    n, user = F.col("event_id"), F.col("user_id")
    whole = F.floor(F.col("value")).cast("string")
    event = {
        "ID": user,
        "Label": F.col("event_type"),
        "Amount": F.parse_json(F.when(n % 2 == 0, whole).otherwise(F.concat(whole, F.lit(".5")))),
        "Note": F.parse_json(F.when(n % 3 == 0, user.cast("string")).otherwise('"none"')),
        "Gone": F.lit(None).cast("string"),
        "Tags": F.array(user, n),
        "Part": _object({"Code": F.col("event_type"), "Size": n}),
    }
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    o, cust = F.col("o_orderkey"), F.col("o_custkey")
    order = {
        "Key": o,
        "Open": F.col("o_orderstatus") == "O",
        "Cust": F.parse_json(F.when(o % 2 == 0, cust.cast("string")).otherwise("null")),
        "Lines": F.parse_json(F.when(o % 4 == 0, "[1, 2]").otherwise("[0.25]")),
    }
    value = {"payload": _object({"op": F.lit("c"), "after": _object(order)})}
    of_orders = orders.select(
        F.lit("srv.db.dbo.Order").alias("topic"),
        F.lit(0).alias("partition"),
        o.alias("offset"),
        _json({"payload": _object({"Key": o})}).alias("key"),
        _json(value).alias("value"),
    )
    return event_feed(events(spark, sf_dir), event).unionByName(of_orders)


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert for each order, some with a cell that is no value of its type:
    customers with a half or a letter, prices in words or of a tenth of a cent, ids with
    a fraction, dates with a time of day, weights in words inside an object."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    n, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    image = {
        "ID": F.when(n % 20 == 7, F.concat(n.cast("string"), F.lit(".5"))).otherwise(
            F.concat(n.cast("string"), F.when(n % 2 == 0, ".0").otherwise(""))
        ),
        "Cust": F.when(n % 20 == 3, F.concat(cust, F.lit(".5")))
        .when(n % 20 == 11, F.concat(cust, F.lit("x")))
        .otherwise(cust),
        "Price": F.when(n % 20 == 13, "a lot").when(n % 20 == 15, "12.345").otherwise(F.col("o_totalprice").cast("string")),
        "Open": F.col("o_orderstatus") == "O",
        "Placed": F.unix_date(F.col("o_orderdate").cast("date")) * F.lit(86_400_000).cast("long"),
        "Due": F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.when(n % 20 == 17, "T23:59:59").when(n % 2 == 0, " 00:00:00").otherwise(""),
        ),
        "Part": _object(
            {
                "Code": F.col("o_orderpriority"),
                "Weight": F.when(n % 20 == 19, "heavy").otherwise((n % 100 / 10).cast("string")),
            }
        ),
    }
    value = {"payload": _object({"op": F.lit("c"), "after": _object(image)})}
    return orders.select(
        F.lit("srv.db.dbo.Order").alias("topic"),
        F.lit(0).alias("partition"),
        n.alias("offset"),
        _json({"payload": _object({"ID": n})}).alias("key"),
        _json(value).alias("value"),
    )


def line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert for each line item, by order: a large feed with a few changes per key."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    image = {
        "ID": F.col("l_orderkey"),
        "Label": F.col("l_returnflag"),
        "Amount": F.col("l_extendedprice"),
        "Note": F.col("l_linestatus"),
    }
    value = {"payload": _object({"op": F.lit("u"), "after": _object(image)})}
    return lines.select(
        F.lit("srv.db.dbo.Line").alias("topic"),
        (F.col("l_orderkey") % 16).cast("int").alias("partition"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("offset"),
        _json({"payload": _object({"ID": F.col("l_orderkey")})}).alias("key"),
        _json(value).alias("value"),
    )
