"""Systematic sampling of sources."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import WEIGHTS, mix, mixed_documents, targets

SCHEMA = "doc_id long, text string, source string"


def shares(sizes: dict, weights=WEIGHTS, most=3):
    """Targets by raising and capping, round after round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    left, open_ = float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        total, given = sum(weight[s] for s in open_), left
        for s in sorted(open_, key=names.index):
            want = target[s] + given * weight[s] / total
            got = min(want, most * sizes[s])
            left -= got - target[s]
            target[s] = got
        open_ = {s for s in open_ if target[s] < most * sizes[s] - 1e-9}
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 50, "c": 10},
        {"a": 1, "b": 1000, "c": 1000, "d": 3, None: 7},
        {"a": 0, "b": 5},
        {"a": 0},
        {None: 12},
        {f"s{i:03}": (i * 37) % 101 for i in range(60)},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r for r in targets(df).collect()}
    want = shares(sizes)
    assert {s: r.target for s, r in got.items()} == pytest.approx(want)
    assert all(r.source_size == sizes[s] for s, r in got.items())


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_mix_takes_what_the_targets_say(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7919 % 50)), "big" if i % 3 else f"s{i % 12}") for i in range(3000)]
    got = mix(docs(spark, rows)).collect()
    assert len(got) == 3000
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    for s in target:
        assert abs(taken[s] - target[s]) <= 2 * 50
    assert sorted(got) == sorted(mix(docs(spark, rows[::-1]).repartition(7)).collect())


def test_defined_results(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", None), (None, "x y", None), (3, "one two three", "b"), (3, "z", "b")]
    got = mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.taken for r in got if r.doc_id in (1, 2)} == {1: 0, 2: 0}
    assert sum(r.size for r in got) == 8
    assert {(r.target, r.source_size) for r in got if r.source == "a"} == {(0.0, 0)}


def test_mixed_rows_keep_their_columns(spark):
    rows = [(i, f"t{i} word", "a" if i % 4 else "b") for i in range(40)] + [(7, "t7 word", "a"), (None, "no id", "b")]
    df = docs(spark, rows).withColumn("copies", F.lit("mine")).withColumn("text_hash", F.lit(1)).withColumn("size", F.lit(2))
    copies = Counter((r.doc_id, r.source) for r in mix(df).collect() for _ in range(r.copies))
    got = mixed_documents(df).collect()
    assert Counter((r.doc_id, r.source) for r in got) == copies
    assert set(got[0].asDict()) == {*df.columns, "copy"}
    assert all(r.copies == "mine" and r["copy"] in (1, 2, 3) for r in got)


def test_a_column_named_copy_is_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", "s", "mine")], "doc_id long, text string, source string, Copy string")
    found = mixed_documents(df)
    assert found.columns == ["doc_id", "text", "source", "copy"]
    found.write.parquet(str(tmp_path / "mix"))
    assert [r.copy for r in found.collect()] == [1]
