"""Many tables in one fold, and low-water marks."""

import random

import pytest
from pyspark.sql import functions as F

from model import delete, feed_of, run, upsert
from tidemark.operators.decode import decode
from tidemark.sources.feed import file_feed
from tidemark.sources.store import TableStore
from tidemark.streaming.many import apply_to_many, many_rejects, many_tables, many_unrouted
from tidemark.table import TableSpec


def layout(**more):
    return TableSpec("any", "ID BIGINT NOT NULL, N STRING", ("ID",), unique=True, **more)


def on(topic, rec, partition=0):
    return (topic, partition, *rec[2:])


def test_fifty_tables_take_few_jobs_a_batch(spark, tmp_path):
    rnd = random.Random(1)
    records = []
    for offset in range(600):
        key = rnd.randint(0, 5)
        rec = delete(offset, ID=key) if rnd.random() < 0.3 else upsert(offset, "u", ID=key, N=f"n{offset}")
        records.append(on(f"T{rnd.randint(0, 51)}", rec))
    records.append(on("T0", upsert(1000, "x", ID=1, N="bad")))
    feed, folder = str(tmp_path / "feed"), str(tmp_path / "tables")
    rnd.shuffle(records)
    for part in range(3):
        feed_of(spark, records[part::3]).coalesce(1).write.mode("append").parquet(feed)
    names = [f"t{n}" for n in range(50)]
    stream = file_feed(spark, feed, stream=True, maxFilesPerTrigger=1)
    query = apply_to_many(stream, layout(), names, folder, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))
    assert len(query.recentProgress) >= 3 and len(jobs) <= 3 * 3
    found = many_tables(spark, folder, layout()).collect()
    for n in range(50):
        own = [r for r in records if r[0] == f"T{n}" and r[2] < 1000]
        assert sorted((r["ID"], r["N"]) for r in found if r["_table"] == f"t{n}") == run(own, ["ID", "N"], ["ID"])
    assert {r["_table"] for r in found} <= set(names)
    assert [(r["_table"], r["offset"], r["action"]) for r in many_rejects(spark, folder, layout()).collect()] == [("t0", 1000, "invalid_op")]
    lost = {(r["topic"], r["offset"]) for r in many_unrouted(spark, folder).collect()}
    assert lost == {r[:1] + r[2:3] for r in records if r[0] in ("T50", "T51")}

    again = apply_to_many(file_feed(spark, feed, stream=True), layout(), names, folder, str(tmp_path / "checkpoint2"))
    again.awaitTermination()  # a replay from the start changes nothing
    replayed = many_tables(spark, folder, layout()).collect()
    assert sorted(map(tuple, replayed)) == sorted(map(tuple, found))


def test_one_table_reads_its_own_folders(spark, tmp_path):
    folder = str(tmp_path / "tables")
    feed_of(spark, [on("a", upsert(0, ID=1, N="x")), on("b", upsert(1, ID=1, N="y"))]).write.parquet(str(tmp_path / "feed"))
    apply_to_many(
        file_feed(spark, str(tmp_path / "feed"), stream=True), layout(), ["left", "b"], folder, str(tmp_path / "c"), routes={"a": "left"}
    ).awaitTermination()
    one = many_tables(spark, folder, layout(), "left")
    assert [tuple(r) for r in one.collect()] == [("left", 1, "x")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_table" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("ordered", [False, True])
def test_markers_below_the_low_water_mark_go_and_late_changes_are_listed(spark, tmp_path, ordered):
    spec = layout(order_by="timestamp") if ordered else layout()
    store = TableStore(spark, str(tmp_path), spec)

    def commit(tag, *records):
        feed = feed_of(spark, records)
        store.commit(decode(feed.withColumn("timestamp", F.col("offset")) if ordered else feed, spec), tag)

    commit("a", upsert(1, ID=1, N="a"), delete(5, ID=2), upsert(6, ID=3, N="c"))
    store.compact(low_water=True)
    assert store._snapshot(store._layers()[1]).where("_deleted").count() == 0
    commit("b", upsert(4, ID=2, N="late"), upsert(9, ID=4, N="d"), upsert(6, ID=3, N="c"))
    assert sorted(map(tuple, store.read().collect())) == [(1, "a"), (3, "c"), (4, "d")]
    assert {(r["offset"], r["action"]) for r in store.rejects().collect()} == {(4, "superseded"), (6, "superseded")}
    commit("c", delete(12, ID=1))
    store.compact(low_water=True)
    commit("d", upsert(11, ID=1, N="late too"), upsert(13, ID=5, N="e"))
    assert sorted(map(tuple, store.read().collect())) == [(3, "c"), (4, "d"), (5, "e")]
    assert {(r["offset"], r["action"]) for r in store.rejects().collect()} == {(n, "superseded") for n in (4, 6, 11)}
