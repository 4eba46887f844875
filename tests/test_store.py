"""Stored tables: batches in any order, repeated, compacted, broken off."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from model import delete, feed_of, record, rows_of, run, upsert
from tidemark.operators.decode import changes, decode
from tidemark.sources.store import TableStore
from tidemark.sources.tables import append_path, merge_into, scan_path
from tidemark.sources.workdir import work_dir
from tidemark.streaming.apply import apply_batch
from tidemark.table import TableSpec
from test_merge import as_record, no_broadcast, steps

COLUMNS = ["ID", "Name"]


@pytest.fixture(scope="module")
def spec(spark):
    return TableSpec("t", "ID BIGINT, Name STRING", ("ID",))


def new_store(spark, spec, rows=None, buckets=None):
    store = TableStore(spark, work_dir(spark), spec, buckets)
    if rows is not None:
        store.overwrite(spark.createDataFrame(rows, spec.schema))
    return store


def test_an_empty_store_is_an_empty_table(spark, spec):
    store = new_store(spark, spec)
    assert store.read().schema.names == COLUMNS and store.read().count() == 0
    assert store.version == 0 and store.rejects().count() == 0 and store.compact() == 0


def test_overwrite_and_versions(spark, spec):
    store = new_store(spark, spec, [(1, "a")])
    store.overwrite(store.read().unionByName(spark.createDataFrame([(2, "b")], spec.schema)))
    assert rows_of(store.read()) == [(1, "a"), (2, "b")]
    assert rows_of(store.read(version=1)) == [(1, "a")]
    assert [path.rsplit("/", 1)[1] for path in store.obsolete()] == ["0000000001"]


def test_batches_make_versions(spark, spec):
    store = new_store(spark, spec, [(1, "a"), (2, "b")])
    apply_batch(feed_of(spark, [upsert(0, "u", ID=1, Name="x"), delete(1, ID=2)]), store, "b0")
    apply_batch(feed_of(spark, [upsert(2, "u", ID=2, Name="y")]), store, "b1")
    expected = {1: [(1, "a"), (2, "b")], 2: [(1, "x")], 3: [(1, "x"), (2, "y")]}
    assert {v: rows_of(store.read(v)) for v in expected} == expected
    assert store.compact() == 3 and rows_of(store.read()) == expected[3]
    assert {v: rows_of(store.read(v)) for v in expected} == expected


def test_an_older_change_never_wins(spark, spec):
    """Not over rows, not over delete markers, and not after compaction."""
    for compacted in (False, True):
        store = new_store(spark, spec)
        apply_batch(feed_of(spark, [upsert(8, ID=1, Name="new"), delete(9, ID=2)]), store, "late")
        if compacted:
            store.compact()
        old = [upsert(1, ID=1, Name="old"), upsert(2, ID=2, Name="old"), delete(3, ID=1)]
        apply_batch(feed_of(spark, old), store, "early")
        assert rows_of(store.read()) == [(1, "new")]
        store.compact()
        assert rows_of(store.read()) == [(1, "new")]


def test_a_deleted_key_can_come_back_once(spark, spec):
    """Its former rows are gone, however many there were."""
    store = new_store(spark, spec, [(1, "a"), (1, "b")])
    for tag, rec in enumerate([delete(0, ID=1), upsert(1, ID=1, Name="c")]):
        apply_batch(feed_of(spark, [rec]), store, str(tag))
        store.compact()
    assert rows_of(store.read()) == [(1, "c")]


def test_a_repeated_key_deleted_in_one_batch_or_over_two(spark, spec):
    steps = [delete(0, ID=1), upsert(1, ID=1, Name="c"), upsert(2, "u", ID=1, Name="d")]
    for batches in ([steps], [steps[:1], steps[1:]], [steps[:2], steps[2:]], [steps[2:], steps[:2]]):
        store = new_store(spark, spec, [(1, "a"), (1, "b"), (2, "x"), (2, "y")])
        for n, batch in enumerate(batches):
            apply_batch(feed_of(spark, batch), store, str(n))
        expected = [(1, "d"), (2, "x"), (2, "y")]
        assert rows_of(store.read()) == expected
        store.compact()
        assert rows_of(store.read()) == expected


def test_a_batch_is_committed_once(spark, spec):
    store = new_store(spark, spec)
    feed = feed_of(spark, [upsert(0, ID=1, Name="a"), upsert(1, "r", ID=1, Name="a")])
    seen = apply_batch(feed, store, "b0")
    assert (seen["create"], seen["invalid_op"], seen["lo"], seen["hi"]) == (1, 1, 0, 1)
    assert apply_batch(feed, store, "b0") is None
    assert store.version == 1 and store.rejects().count() == 1


def test_empty_batches_and_batches_of_rejects(spark, spec):
    store = new_store(spark, spec, [(1, "a")])
    batches = [[], [record(0, None, None)], [upsert(1, ID=2, Name="b")], []]
    for n, records in enumerate(batches):
        apply_batch(feed_of(spark, records), store, str(n))
        assert store.read().count() == (1 if n < 2 else 2)
    assert store.version == 5 and store.rejects().count() == 1
    store.compact()
    assert rows_of(store.read()) == [(1, "a"), (2, "b")]


def test_a_broken_write_does_not_count(spark, spec):
    """A folder without the committer's mark is skipped, and written anew."""
    store = new_store(spark, spec, [(1, "a")])
    other = new_store(spark, spec)
    apply_batch(feed_of(spark, [upsert(0, "u", ID=1, Name="half")]), other, "b0")
    half = spark.read.parquet(f"{other.path}/changes/after=None/batch=0000000001-b0")
    unmarked = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    half.write.option(unmarked, "false").parquet(f"{store.path}/changes/after=0000000001/batch=0000000002-b1")
    half.write.option(unmarked, "false").parquet(f"{store.path}/snapshots/0000000009")
    assert store.version == 1 and rows_of(store.read()) == [(1, "a")]
    apply_batch(feed_of(spark, [upsert(0, "u", ID=1, Name="whole")]), store, "b1")
    assert store.version == 2 and rows_of(store.read()) == [(1, "whole")]


def test_markers_can_be_forgotten(spark, spec):
    store = new_store(spark, spec)
    apply_batch(feed_of(spark, [delete(1, ID=1), delete(7, ID=2)]), store, "b0")
    store.compact(forget=F.col("_pos.offset") < 5)
    state = spark.read.parquet(f"{store.path}/snapshots/0000000001")
    assert rows_of(state.select("ID", "_deleted")) == [(2, True)]


def test_compaction_is_due_by_size(spark, spec):
    store = new_store(spark, spec, [(n, f"name {n}") for n in range(2000)])
    apply_batch(feed_of(spark, [upsert(0, "u", ID=1, Name="x")]), store, "b0")
    assert not store.compact_if_due(5.0) and store.compact_if_due(0.0)
    assert not store.compact_if_due(0.0)
    assert store.read().count() == 2000


def test_reading_without_changes_is_a_plain_scan(spark, spec):
    store = new_store(spark, spec, [(1, "a")])
    plan = store.read().where("ID = 1").select("Name")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ID,1)" in plan and "Exchange" not in plan and "Join" not in plan


def test_conditions_on_the_key_reach_the_rows(spark, spec):
    """Every scan of the snapshot's rows; markers and changes are read in parts."""
    store = new_store(spark, spec, [(1, "a"), (2, "b")])
    apply_batch(feed_of(spark, [upsert(0, "u", ID=1, Name="x")]), store, "b0")
    found = store.read().where("ID = 1")
    assert rows_of(found) == [(1, "x")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [n for n in plan.splitlines() if "FileScan" in n and "_gone:" not in n]
    assert len(scans) >= 2 and all("EqualTo(ID,1)" in n for n in scans)


def above_the_rows(table, others="_gone:"):
    """For each scan of snapshot rows, the nearest shuffle or join above it."""
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [(len(n) - len(n.lstrip(" :+-*")), n.strip()) for n in plan.splitlines()]
    found = []
    for at, (depth, line) in enumerate(lines):
        if "FileScan" not in line or others in line:
            continue
        for above, node in reversed(lines[:at]):
            if above < depth:
                depth = above
                if "Exchange" in node or "Join" in node:
                    found.append(node)
                    break
    return found


def many_names(spark, buckets=None):
    strict = TableSpec("s", "ID BIGINT NOT NULL, Name STRING", ("ID",))
    store = new_store(spark, strict, [(n, f"name {n}") for n in range(100)], buckets)
    apply_batch(feed_of(spark, [upsert(0, "u", ID=1, Name="x"), upsert(1, ID=500, Name="y")]), store, "b")
    return store


def test_few_changes_do_not_shuffle_the_rows(spark):
    """Changes under the broadcast size leave the snapshot where it is."""
    table = many_names(spark).read()
    nearest = above_the_rows(table)
    assert nearest and all("BroadcastHashJoin" in n for n in nearest)
    assert table.count() == 101


def test_many_changes_do_not_shuffle_rows_in_buckets(spark, no_broadcast):
    """Nor do changes of any size where the snapshot is bucketed, before and
    after a compaction."""
    store = many_names(spark, buckets=16)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    for _ in range(2):
        nearest = above_the_rows(store.read())
        assert nearest and all("SortMergeJoin" in n for n in nearest)
        assert store.read().count() == 101
        store.compact()
        apply_batch(feed_of(spark, [upsert(2, "u", ID=2, Name="z")]), store, "c")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")] == []


def test_buckets_may_change(spark, spec):
    store = new_store(spark, spec, [(1, "a"), (2, "b")])
    path = store.path.rsplit("/", 1)[0]
    for n, buckets in enumerate([3, None, 7]):
        store = TableStore(spark, path, spec, buckets)
        apply_batch(feed_of(spark, [upsert(n, "u", ID=1, Name=str(n))]), store, str(n))
        store.compact()
        assert rows_of(store.read()) == [(1, str(n)), (2, "b")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    todo=st.lists(steps, min_size=1, max_size=20),
    rows=st.lists(st.tuples(st.one_of(st.integers(0, 4), st.none()), st.sampled_from("ab")), max_size=5),
    cuts=st.lists(st.integers(0, 3), min_size=20, max_size=20),
    compacted=st.lists(st.booleans(), min_size=8, max_size=8),
    buckets=st.sampled_from([None, 5]),
    seed=st.randoms(use_true_random=False),
)
def test_any_split_order_and_replay(spark, spec, todo, rows, cuts, compacted, buckets, seed):
    """Whatever batches a feed comes in, in any order and then once more, the
    table is that of the record loop. (Keys of the target are unique here: of
    repeated rows that are deleted and inserted again, order would show.)"""
    rows = list({r[0]: r for r in rows}.values())
    records = [as_record(n, step) for n, step in enumerate(todo)]
    batches = [[r for r, cut in zip(records, cuts) if cut == n] for n in range(4)]
    batches = [b for b in batches if b]
    seed.shuffle(batches)
    store = new_store(spark, spec, rows, buckets)
    for n, batch in enumerate(batches + batches[:2]):
        apply_batch(feed_of(spark, batch), store, f"b{n}")
        if compacted[n]:
            store.compact()
    dicts = [dict(zip(COLUMNS, r)) for r in rows]
    assert rows_of(store.read()) == run(records, COLUMNS, ["ID"], dicts)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    todo=st.lists(steps, min_size=1, max_size=16),
    places=st.lists(st.integers(0, 3), min_size=16, max_size=16),
    cuts=st.lists(st.integers(0, 3), min_size=16, max_size=16),
    compacted=st.lists(st.booleans(), min_size=8, max_size=8),
    unique=st.booleans(),
    seed=st.randoms(use_true_random=False),
)
def test_a_declared_order_holds_across_partitions(spark, todo, places, cuts, compacted, unique, seed):
    """Offsets mean nothing there: each partition counts on its own."""
    spec = TableSpec("timed", "ID BIGINT, Name STRING", ("ID",), order_by="timestamp", unique=unique)
    records = [as_record(n, step) for n, step in enumerate(todo)]
    moved = [(r[0], place, 1000 - n, *r[3:], n) for n, (r, place) in enumerate(zip(records, places))]
    batches = [[r for r, cut in zip(moved, cuts) if cut == n] for n in range(4)]
    batches = [b for b in batches if b]
    seed.shuffle(batches)
    store = new_store(spark, spec)
    for n, batch in enumerate(batches + batches[:2]):
        feed = spark.createDataFrame(batch, "topic STRING, partition INT, offset BIGINT, key STRING, value STRING, timestamp BIGINT")
        apply_batch(feed, store, f"b{n}")
        if compacted[n]:
            store.compact()
    assert rows_of(store.read()) == run(records, COLUMNS, ["ID"])


@pytest.mark.parametrize("compacted", [False, True])
def test_a_key_without_declared_order_stays_in_its_partition(spark, spec, compacted):
    """No offset is compared with one of another partition, and what is not
    applied is told, whatever the order of the batches."""
    first = [upsert(1_000_000, ID=1, Name="old"), upsert(5, ID=2, Name="x")]
    then = [(t, 7, *rest) for t, _, *rest in [upsert(12, "u", ID=1, Name="new"), delete(3, ID=3)]]
    for batches in ([first, then], [then, first], [first + then]):
        store = new_store(spark, spec, [(1, "seed"), (3, "seed")])
        for n, batch in enumerate(batches):
            apply_batch(feed_of(spark, batch), store, str(n))
            if compacted:
                store.compact()
        assert rows_of(store.read()) == [(1, "new"), (2, "x")]
        told = store.rejects().select("partition", "offset", "action", "raw_key").collect()
        assert [tuple(r) for r in told] == [(0, 1_000_000, "moved_key", '{"ID":1}')]


def test_compaction_never_changes_the_table(spark, spec):
    """A late delete of a repeated key, with and without a compaction between."""
    for compacted in (False, True):
        store = new_store(spark, spec, [(1, "a"), (1, "b"), (2, "a"), (2, "b")])
        apply_batch(feed_of(spark, [upsert(9, ID=1, Name="c"), upsert(8, ID=2, Name="d")]), store, "0")
        if compacted:
            store.compact()
        apply_batch(feed_of(spark, [delete(3, ID=1)]), store, "1")
        assert rows_of(store.read()) == [(1, "c"), (2, "d"), (2, "d")]
        store.compact()
        assert rows_of(store.read()) == [(1, "c"), (2, "d"), (2, "d")]


@pytest.mark.parametrize("buckets", [None, 3])
def test_overwriting_takes_the_place_of_records_seen(spark, spec, buckets):
    store = new_store(spark, spec, buckets=buckets)
    feed = [upsert(1, ID=1, Name="a"), delete(2, ID=1), upsert(3, ID=2, Name="b"), upsert(4, "r", ID=9, Name="r")]
    apply_batch(feed_of(spark, feed), store, "0")
    store.overwrite(store.read())
    for n in range(2):
        apply_batch(feed_of(spark, feed + [upsert(0, ID=2, Name="older")]), store, f"again{n}")
        assert rows_of(store.read()) == [(2, "b")]
        store.compact()
        assert rows_of(store.read()) == [(2, "b")]
    store.overwrite(spark.createDataFrame([(5, "new")], spec.schema))
    apply_batch(feed_of(spark, feed + [upsert(7, ID=2, Name="later")]), store, "more")
    assert rows_of(store.read()) == [(2, "later"), (5, "new")]


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("nullable", [False, True])
def test_update_and_delete_where_keep_positions(spark, unique, nullable):
    kind = "BIGINT" if nullable else "BIGINT NOT NULL"
    spec = TableSpec("t", f"ID {kind}, Name STRING", ("ID",), unique=unique)
    store = new_store(spark, spec, [(1, "seed"), (7, "seed")])
    feed = [upsert(n, ID=n, Name=f"n{n}") for n in range(2, 6)] + [delete(6, ID=3)]
    apply_batch(feed_of(spark, feed), store, "0")
    with pytest.raises(ValueError):
        store.update_where({"Name": "n2"}, {"id": 99})
    store.update_where({"ID": 2}, {"Name": "changed"})
    store.delete_where({"Name": "n4"})
    store.delete_where({"ID": 7})
    store.delete_where({"ID": 3})  # gone already
    expected = [(1, "seed"), (2, "changed"), (5, "n5")]
    assert rows_of(store.read()) == expected
    apply_batch(feed_of(spark, feed), store, "replay")
    assert rows_of(store.read()) == expected
    store.compact()
    apply_batch(feed_of(spark, [upsert(10, ID=4, Name="back"), upsert(11, ID=2, Name="later")]), store, "1")
    assert rows_of(store.read()) == [(1, "seed"), (2, "later"), (4, "back"), (5, "n5")]


def test_deleted_rows_with_null_keys_stay_deleted(spark, spec):
    store = new_store(spark, spec)
    feed = [upsert(0, key={"ID": 1}, ID=None, Name="a"), upsert(1, key={"ID": 1}, ID=None, Name="b")]
    apply_batch(feed_of(spark, feed), store, "0")
    store.delete_where({"Name": "a"})
    for n in range(2):
        apply_batch(feed_of(spark, feed), store, f"again{n}")
        assert rows_of(store.read()) == [(None, "b")]
        store.compact()


def test_unique_keys_take_one_scan_and_no_shuffle_of_buckets(spark, no_broadcast):
    strict = TableSpec("u", "ID BIGINT NOT NULL, Name STRING", ("ID",), unique=True)
    for buckets in (None, 16):
        store = new_store(spark, strict, [(n, f"name {n}") for n in range(100)], buckets)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        apply_batch(feed_of(spark, [upsert(0, "u", ID=1, Name="x"), upsert(1, ID=500, Name="y"), delete(2, ID=3)]), store, "b")
        table = store.read()
        assert table.count() == 100
        table.collect()
        plan = table._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        snapshot = [n for n in plan.splitlines() if "FileScan" in n and "snapshots" in n]
        assert len(snapshot) == 1 and plan.count("Join") == 1
        if buckets:
            assert "Join" in above_the_rows(table, "changes")[0]


def test_append_and_scan_by_path(spark, spec):
    path = f"{work_dir(spark)}/log"
    decoded = decode(feed_of(spark, [upsert(0, ID=1, Name="a"), delete(1, ID=1)]), spec)
    append_path(decoded, path)
    append_path(decoded, path)
    assert rows_of(scan_path(spark, path)) == [(1, "a"), (1, "a")]


def test_merge_into_needs_a_format_with_merge(spark, spec):
    spark.sql("CREATE TABLE plain (ID BIGINT, Name STRING) USING parquet")
    decoded = decode(feed_of(spark, [upsert(0, ID=1, Name="a")]), spec)
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge_into(decoded, "plain", spec)
    spark.sql("DROP TABLE plain")
