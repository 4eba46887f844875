"""Conditions, names, feeds, schemas and updates."""

import json
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from model import feed_of, key_of, record, rows_of, upsert
from tidemark.functions.conditions import condition_pairs
from tidemark.functions.connect import connect_schema, latest_schema, struct_type, type_names
from tidemark.functions.envelope import entries
from tidemark.functions.naming import routed_name, table_name, topic_list
from tidemark.operators.audit import explode_entries, feed_audit, preview
from tidemark.operators.decode import decode
from tidemark.operators.merge import filter_by_conditions, keyed_update, keyed_update_overwrite
from tidemark.sources.feed import as_feed, by_pattern, by_topics, file_feed, kafka_feed, kafka_options, spread
from tidemark.sources.workdir import work_dir
from tidemark.table import TableSpec


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "Ann", 1.5), (2, "O'Neil", None), (3, "Ann", 2.5), (4, None, 0.0)]
    return spark.createDataFrame(rows, "ID BIGINT, Name STRING, `a b` DOUBLE")


# -- conditions ---------------------------------------------------------------

LISTED = '{"conditions": [{"column": "Town", "value": "Ulm"}, {"column": "Floor", "value": "3"}]}'


def test_condition_forms():
    assert condition_pairs(LISTED) == condition_pairs({"Town": "Ulm", "Floor": "3"})
    assert condition_pairs('{"ID": 1.5}') == [("ID", "1.5")]
    for none in ("{}", [], '{"ID": null}'):
        with pytest.raises(ValueError):
            condition_pairs(none)


@pytest.mark.parametrize(
    "conditions, ids",
    [
        ({"Name": "Ann"}, [1, 3]),
        ({"name": "Ann", "id": "3"}, [3]),
        ({"Name": "O'Neil"}, [2]),
        ({"a b": "1.5"}, [1]),
        ({"ID": "no number"}, []),
        ({"ID": 4, "Name": "Ann"}, []),
        ({"Name": "' OR '1'='1"}, []),
    ],
)
def test_filter_by_conditions(people, conditions, ids):
    found = filter_by_conditions(people, conditions)
    assert sorted(r["ID"] for r in found.collect()) == ids


def test_conditions_reach_the_scan(spark, people, tmp_path):
    people.write.parquet(f"{tmp_path}/p")
    found = filter_by_conditions(spark.read.parquet(f"{tmp_path}/p"), {"ID": "3", "Name": "Ann"})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ID,3)" in plan and "EqualTo(Name,Ann)" in plan


def test_keyed_update(people):
    changed = keyed_update(people, {"Name": "Ann"}, {"a b": "9", "name": "never"})
    assert changed.schema == people.schema
    assert rows_of(changed) == rows_of(people.sparkSession.createDataFrame(
        [(1, "Ann", 9.0), (2, "O'Neil", None), (3, "Ann", 9.0), (4, None, 0.0)], people.schema))
    assert [r["Name"] for r in keyed_update(people, {"ID": 1}, {"Name": None}).collect()][0] is None


def test_keyed_update_overwrite(people):
    only = keyed_update_overwrite(people, {"Name": "Ann"}, {"a b": 9})
    assert rows_of(only) == [(1, "Ann", 9.0), (3, "Ann", 9.0)]
    assert [f.dataType for f in only.schema] == [f.dataType for f in people.schema]


def test_unknown_columns_fail(people):
    with pytest.raises(ValueError):
        keyed_update(people, {"ID": 1}, {"Phone": "1"})
    with pytest.raises(ValueError):
        filter_by_conditions(people, {"Phone": "1"})


# -- names and topics ---------------------------------------------------------


def test_topic_list():
    assert topic_list("a.b, c,a.b,,d ") == ["a.b", "c", "d"]
    assert topic_list("") == []


def test_table_names(spark):
    topics = spark.createDataFrame([("srv.DB1.dbo.Emp2",), ("other",)], "topic STRING")
    name = topics.select(
        table_name(F.col("topic")).alias("rule"),
        routed_name(F.col("topic"), {"other": "t"}).alias("mapped"),
        routed_name(F.col("topic"), {"other": "t"}, "rest").alias("with_default"),
        routed_name(F.col("topic"), default="rest").alias("constant"),
    )
    assert rows_of(name) == [
        ("other", "t", "t", "rest"), ("srv_db1_dbo_emp2", "srv_db1_dbo_emp2", "rest", "rest")]


def test_topic_choice(spark):
    topics = ["srv.a", "srv.ab", "srv_a", "xsrv.a"]
    feed = feed_of(spark, [record(n, None, None, topic=t) for n, t in enumerate(topics)])
    chosen = lambda df: sorted(r["topic"] for r in df.collect())
    assert chosen(by_topics(feed, "srv.a,srv_a,none")) == ["srv.a", "srv_a"]
    assert chosen(by_topics(feed, ["srv.ab"])) == ["srv.ab"]
    assert chosen(by_pattern(feed, r"srv\.a|srv_a")) == ["srv.a", "srv_a"]


# -- feeds --------------------------------------------------------------------


def test_kafka_options():
    assert kafka_options("host:9092", "a, b,a", maxOffsetsPerTrigger=10) == {
        "kafka.bootstrap.servers": "host:9092", "startingOffsets": "earliest",
        "subscribe": "a,b", "maxOffsetsPerTrigger": "10"}
    assert kafka_options("h", pattern="a.*", startingOffsets="latest") == {
        "kafka.bootstrap.servers": "h", "startingOffsets": "latest", "subscribePattern": "a.*"}
    for wrong in ({}, {"topics": "a", "pattern": "b"}, {"topics": ", ,"}):
        with pytest.raises(ValueError):
            kafka_options("h", **wrong)


@pytest.mark.parametrize("stream", [True, False])
def test_kafka_needs_its_connector(spark, stream):
    try:
        feed = kafka_feed(spark, "localhost:1", "a", stream=stream)
    except Exception as failed:
        assert "kafka" in str(failed).lower()
    else:
        assert feed.columns == ["topic", "partition", "offset", "key", "value"]


def test_binary_records_become_text(spark):
    raw = spark.createDataFrame(
        [(bytearray("ß".encode()), None, "t", 0, 1, 0)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestampType INT")
    assert tuple(as_feed(raw).first()) == ("t", 0, 1, "ß", None)


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_file_feed(spark, tmp_path, format):
    records = [upsert(0, ID=1), record(1, key_of(ID=1), None)]
    feed_of(spark, records).write.format(format).save(f"{tmp_path}/f")
    assert rows_of(file_feed(spark, f"{tmp_path}/f", format)) == sorted(records, key=repr)
    assert file_feed(spark, f"{tmp_path}/f", format, stream=True).isStreaming


def test_spread(spark):
    feed = feed_of(spark, [upsert(n, ID=n) for n in range(64)])
    few = feed.coalesce(1)
    plan = spread(few)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(offset" in plan
    assert rows_of(spread(few)) == rows_of(feed)


def test_work_dir_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark).startswith(shared) and work_dir(spark) != work_dir(spark)


# -- audits -------------------------------------------------------------------


def test_feed_audit(spark):
    spec = TableSpec("t", "ID BIGINT", ("ID",))
    records = [upsert(4, ID=1), upsert(9, ID=2), record(5, None, None), upsert(1, "u", ID=1)]
    audit = feed_audit(decode(feed_of(spark, records), spec)).select("action", "n", "lo", "hi")
    assert rows_of(audit) == [("bad_key", 1, 5, 5), ("create", 2, 4, 9), ("update", 1, 1, 1)]


def test_preview(spark, people):
    assert [r["ID"] for r in preview(people, ("ID",), 2).collect()] == [1, 2]
    many = spark.range(100).select(F.col("id").alias("ID"))
    assert [r["ID"] for r in preview(many, ("ID",)).collect()] == list(range(20))


def test_explode_entries(spark):
    text = '{"ID":7,"Town":"Köln","Street":"Am Markt 4","x":null}'
    df = spark.createDataFrame([(text,)], "j STRING")
    assert rows_of(explode_entries(df, entries(F.col("j")))) == [
        ("ID", "7"), ("Street", "Am Markt 4"), ("Town", "Köln"), ("x", None)]


# -- schemas carried by records -----------------------------------------------


def with_schema(offset, fields):
    block = {"type": "struct", "fields": [
        {"type": "struct", "field": "before", "fields": []},
        {"type": "struct", "field": "after", "fields": fields},
        {"type": "string", "field": "op"}]}
    return record(offset, key_of(ID=1), json.dumps({"schema": block, "payload": {}}))


OLD = [{"type": "int64", "optional": False, "field": "ID"}, {"type": "string", "optional": True, "field": "Email"}]
NEW = [*OLD,
       {"type": "array", "optional": True, "field": "tags", "items": {"type": "string"}},
       {"type": "struct", "optional": True, "field": "at", "fields": [{"type": "float32", "field": "x"}]},
       {"type": "map", "optional": True, "field": "m", "keys": {"type": "string"}, "values": {"type": "int16"}},
       {"type": "no such type", "optional": True, "field": "odd"}]


def test_connect_schema(spark):
    records = [with_schema(0, OLD), with_schema(1, OLD), with_schema(2, NEW), record(3, key_of(ID=1), None)]
    found = connect_schema(feed_of(spark, records)).select("place", "c", "type", "n")
    assert rows_of(found) == sorted([
        (0, "ID", "bigint", 2), (1, "Email", "string", 2),
        (0, "ID", "bigint", 1), (1, "Email", "string", 1), (2, "tags", "array<string>", 1),
        (3, "at", "struct<x:float>", 1), (4, "m", "map<string,smallint>", 1), (5, "odd", None, 1)], key=repr)


def test_executors_need_not_have_the_package(tmp_path):
    file = tmp_path / "f"
    file.write_bytes(cloudpickle.dumps(type_names))
    code = (
        "import pickle, sys, pandas as pd\n"
        f"f = pickle.load(open({str(file)!r}, 'rb'))\n"
        "assert list(f(pd.Series(['{\"type\": \"int8\"}', 'x']))) == ['tinyint', None]\n"
        "assert not [m for m in sys.modules if m.startswith('tidemark')]\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd="/", check=True)


def test_latest_schema_sets_up_a_table(spark):
    feed = feed_of(spark, [with_schema(1, OLD), with_schema(0, NEW[:3])])
    schema = latest_schema(feed)
    assert schema == struct_type(OLD)
    assert schema["ID"].nullable is False and schema["Email"].dataType == T.StringType()
    assert TableSpec("t", schema, ("id",)).null_keys == []
    with pytest.raises(ValueError):
        latest_schema(feed_of(spark, [upsert(0, ID=1)]))
