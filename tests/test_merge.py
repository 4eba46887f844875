"""Folding and merging, against the one-by-one model."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from model import delete, feed_of, key_of, record, rows_of, run, upsert
from tidemark.operators.decode import changes, decode, deleted_keys
from tidemark.operators.fold import batch_outcome, last_per_key, rows_after
from tidemark.operators.merge import append_log, apply_changes, delete_by_key
from tidemark.table import TableSpec

QUICK = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
COLUMNS = ["ID", "Name"]


@pytest.fixture(scope="module")
def spec(spark):
    return TableSpec("t", "ID BIGINT, Name STRING", ("ID",))


@pytest.fixture(scope="module")
def strict(spark):
    return TableSpec("t", "ID BIGINT NOT NULL, Name STRING", ("ID",))


def changes_of(spark, records, spec):
    return changes(decode(feed_of(spark, records), spec))


def table_of(spark, rows, spec):
    return spark.createDataFrame(rows, spec.state_schema[: len(spec.columns)])


def check(spark, spec, records, rows, columns=COLUMNS):
    merged = apply_changes(table_of(spark, rows, spec), changes_of(spark, records, spec), spec)
    dicts = [dict(zip(columns, r)) for r in rows]
    assert merged.columns == columns
    assert rows_of(merged) == run(records, columns, list(spec.keys), dicts)


def test_create_on_existing_and_update_on_missing(spark, spec):
    check(spark, spec, [upsert(0, "c", ID=1, Name="b"), upsert(1, "u", ID=2, Name="c")], [(1, "a")])


def test_order_is_by_offset_not_by_arrival(spark, spec):
    records = [upsert(5, "u", ID=1, Name="new"), upsert(3, "c", ID=1, Name="old")]
    check(spark, spec, records, [])


def test_create_delete_create(spark, spec):
    records = [
        upsert(0, ID=1, Name="a"), delete(1, ID=1), upsert(2, ID=1, Name="b"),
        upsert(3, ID=2, Name="c"), delete(4, ID=2), delete(5, ID=9),
    ]
    check(spark, spec, records, [(2, "x"), (3, "y")])


def test_last_valid_change_counts(spark, spec):
    """A rejected record does not hide the change before it."""
    records = [upsert(0, ID=1, Name="a"), upsert(1, "r", ID=1, Name="b"), upsert(2, ID=1)]
    check(spark, spec, records, [(1, "x")])


def test_repeated_keys_in_the_target(spark, spec):
    rows = [(1, "a"), (1, "b"), (2, "c"), (2, "d"), (3, "e"), (3, "e")]
    check(spark, spec, [upsert(0, "u", ID=1, Name="z"), delete(1, ID=2)], rows)


def test_a_repeated_key_that_was_deleted_comes_back_as_one_row(spark, spec):
    rows = [(1, "a"), (1, "b"), (2, "c"), (2, "c")]
    records = [delete(0, ID=1), upsert(1, "u", ID=1, Name="z"), upsert(2, ID=2, Name="d"),
               upsert(3, ID=1, Name="y")]
    check(spark, spec, records, rows)


def test_null_keys(spark, spec):
    rows = [(None, "kept"), (None, "kept"), (1, "a")]
    records = [
        upsert(0, key={"ID": 1}, ID=None, Name="p"),
        upsert(1, key={"ID": 1}, ID=None, Name="p"),
        upsert(2, "u", ID=1, Name="q"),
    ]
    check(spark, spec, records, rows)


def test_a_null_key_delivered_twice_is_one_row(spark, spec):
    twice = upsert(0, key={"ID": 1}, ID=None, Name="p")
    assert rows_of(rows_after(changes_of(spark, [twice, twice], spec), spec)) == [(None, "p")]


def test_rows_after_a_feed(spark, spec):
    records = [upsert(0, ID=1, Name="a"), upsert(1, key={"ID": 1}, ID=None, Name="b"),
               upsert(2, ID=2, Name="c"), delete(3, ID=2)]
    rows = rows_after(changes_of(spark, records, spec), spec)
    assert rows_of(rows) == run(records, COLUMNS, ["ID"])


def test_null_columns_replace_values(spark, spec):
    check(spark, spec, [upsert(0, "u", ID=1, Name=None)], [(1, "a")])


def test_two_key_columns(spark):
    spec = TableSpec("t", "A BIGINT, B STRING, V DOUBLE", ("A", "B"))
    records = [
        upsert(0, "u", key={"A": 1, "B": "x"}, A=1, B="x", V=1.5),
        upsert(1, "u", key={"B": "y", "A": 1}, A=1, B="y", V=2.5),
        delete(2, A=2, B="x"),
        record(3, key_of(A=3), None),
        upsert(4, "c", key={"A": 1, "B": None}, A=1, B=None, V=3.5),
    ]
    rows = [(1, "x", 0.0), (2, "x", 0.0), (2, "y", 0.0), (3, "x", 0.0), (1, None, 0.0)]
    check(spark, spec, records, rows, ["A", "B", "V"])


def test_quotes_and_other_letters_in_keys(spark):
    spec = TableSpec("t", "K STRING, V STRING", ("K",))
    records = [delete(0, K="it's"), upsert(1, "u", K="Müller", V="ß"), delete(2, K="' OR 'a'='a")]
    check(spark, spec, records, [("it's", "a"), ("Müller", "b"), ("x", "c")], ["K", "V"])


def test_target_columns_in_other_order_case_and_type(spark, spec):
    target = spark.createDataFrame([("a", 1)], "name STRING, id INT")
    applied = changes_of(spark, [upsert(0, "u", ID=1, Name="b"), upsert(1, "u", ID=2, Name="c")], spec)
    assert rows_of(apply_changes(target, applied, spec)) == [(1, "b"), (2, "c")]


def test_delete_by_key(spark, spec):
    decoded = decode(feed_of(spark, [delete(0, ID=1), delete(1, ID=1), delete(2, ID=5)]), spec)
    target = table_of(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "d")], spec)
    left = delete_by_key(target, deleted_keys(decoded, spec), spec)
    assert rows_of(left) == [(2, "c"), (None, "d")]


def test_append_log(spark, spec):
    decoded = decode(feed_of(spark, [upsert(0, ID=1, Name="a"), upsert(1, "u", ID=1, Name="b"),
                                     delete(2, ID=1)]), spec)
    target = table_of(spark, [(1, "x")], spec)
    assert rows_of(append_log(target, decoded)) == [(1, "a"), (1, "b"), (1, "x")]


ids = st.integers(0, 4)
steps = st.one_of(
    st.tuples(st.just("c"), ids, st.sampled_from(["p", "q", None])),
    st.tuples(st.just("u"), st.one_of(ids, st.none()), st.sampled_from(["r", "s"])),
    st.tuples(st.just("r"), ids, st.just("skipped")),
    st.tuples(st.just("delete"), ids, st.none()),
    st.tuples(st.just("junk"), ids, st.none()),
)


def as_record(offset, step):
    kind, id, name = step
    if kind == "delete":
        return delete(offset, ID=id)
    if kind == "junk":
        return record(offset, key_of(ID=id), "{")
    return upsert(offset, kind, key={"ID": 0}, ID=id, Name=name)


@QUICK
@given(
    todo=st.lists(steps, max_size=25),
    rows=st.lists(st.tuples(st.one_of(ids, st.none()), st.sampled_from("ab")), max_size=8),
    seed=st.randoms(use_true_random=False),
)
def test_any_feed(spark, spec, todo, rows, seed):
    records = [as_record(n, step) for n, step in enumerate(todo)]
    seed.shuffle(records)
    check(spark, spec, records, rows)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffled_records(plan):
    """Records written by each shuffle of an executed plan."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return shuffled_records(plan.executedPlan())
    if "QueryStage" in name:
        return shuffled_records(plan.plan())
    own = []
    if name == "Exchange":
        own = [plan.metrics().apply("shuffleRecordsWritten").value()]
    children = plan.children()
    return own + [n for i in range(children.size()) for n in shuffled_records(children.apply(i))]


@pytest.fixture
def no_broadcast(spark):
    """Sizes at which neither side would be broadcast, and any skew is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed_target(spark):
    """20,000 rows in 8 partitions, a third of them under key 7."""
    return spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("ID"),
        F.sha2(F.col("id").cast("string"), 256).alias("Name"),
    )


def test_a_hot_key_in_the_target_is_split(spark, strict, no_broadcast):
    applied = changes_of(spark, [upsert(n, "u", ID=n, Name=f"n{n}") for n in range(50)], strict)
    merged = apply_changes(skewed_target(spark), applied, strict)
    joins = [n for n in final_plan(merged).splitlines() if "SortMergeJoin" in n]
    assert ["skew=true" in n for n in joins] == [True, False]
    assert "LeftOuter" in joins[0] and "LeftAnti" in joins[1]
    assert merged.where("ID = 7").count() == skewed_target(spark).where("ID = 7").count()
    assert merged.where("ID = 7 AND Name <> 'n7'").count() == 0


def test_the_target_s_keys_are_reduced_before_the_shuffle(spark, strict, no_broadcast):
    """A hot key leaves each map task once, in the search for inserts."""
    applied = changes_of(spark, [upsert(n, "u", ID=n, Name=f"n{n}") for n in range(50)], strict)
    merged = apply_changes(skewed_target(spark), applied, strict)
    merged.collect()
    per_task = skewed_target(spark).groupBy(F.spark_partition_id()).agg(F.countDistinct("ID").alias("n"))
    written = shuffled_records(merged._jdf.queryExecution().executedPlan())
    assert per_task.agg(F.sum("n")).first()[0] in written


def test_a_hot_key_is_split_when_deleting(spark, strict, no_broadcast):
    gone = spark.createDataFrame([(1,), (2,)], "ID BIGINT")
    left = delete_by_key(skewed_target(spark), gone, strict)
    assert "SortMergeJoin(skew=true)" in final_plan(left)
    assert left.count() == 20000 - 2


def test_the_feed_is_folded_once_and_reduced_before_the_shuffle(spark, strict, no_broadcast):
    applied = changes_of(spark, [upsert(0, ID=1, Name="a")], strict)
    plan = final_plan(apply_changes(table_of(spark, [(1, "b")], strict), applied, strict))
    assert plan.count("ReusedExchange") == 1 and plan.count("partial_max_by") == 1


@pytest.mark.parametrize("whole_batch", [False, True])
def test_a_hot_key_in_the_feed_crosses_the_shuffle_once_per_task(
    spark, strict, no_broadcast, whole_batch
):
    """8 map tasks, each with every key of the feed: key 7 holds most rows."""
    image = F.concat(F.lit('{"payload":{"op":"u","after":{"ID":'),
                     F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id") % 3).cast("string"),
                     F.lit(',"Name":"x"}}}'))
    feed = spark.range(0, 8000, 1, 8).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit(key_of(ID=7)).alias("key"), image.alias("value"),
    )
    decoded = decode(feed, strict)
    net = batch_outcome(decoded, strict) if whole_batch else last_per_key(changes(decoded), strict)
    assert net.count() == 4
    net.collect()
    assert shuffled_records(net._jdf.queryExecution().executedPlan()) == [8 * 4]
