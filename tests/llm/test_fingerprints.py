"""Content-defined chunks, and likenesses against plain Python."""

import random

import numpy as np
import pytest
from plain import sha

from tidemark.llm import fingerprints as f
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_gear_hashes():
    data = random.Random(1).randbytes(500)
    gears = f._GEAR.tolist()
    h, wanted = 0, []
    for n in range(len(data)):
        h = sum(gears[data[n - k]] << k for k in range(min(n + 1, 32))) & 0xFFFFFFFF
        wanted.append(h)
    assert f.gear_hashes(data).tolist() == wanted


def test_boundaries():
    data = random.Random(2).randbytes(30_000)
    hashes = f.gear_hashes(data).tolist()
    ends, start = [], 0
    while start < len(data):  # byte after byte
        end = len(data)
        for n in range(start + f.LEAST - 1, len(data)):
            bits = f.STRICT_BITS if n < start + f.NORMAL else f.EASY_BITS
            if hashes[n] >> (32 - bits) == 0 or n + 1 - start == f.MOST:
                end = n + 1
                break
        ends.append(end)
        start = end
    assert f.boundaries(data) == ends
    sizes = np.diff([0, *ends])
    assert sizes.max() <= f.MOST and sizes[:-1].min() >= f.LEAST


def test_chunks_resist_a_shift():
    text = " ".join(random.Random(3).choices("lorem ipsum dolor sit amet elit sed do".split(), k=2000))
    own, moved = f.fingerprint(text), f.fingerprint("A new beginning. " + text)
    assert f.containment(own, moved) > 0.95
    assert f.containment(own, f.fingerprint(text[len(text) // 2 :])) == pytest.approx(0.5, abs=0.05)
    assert f.containment(own, own) == 1.0


@pytest.mark.parametrize("a, b, wanted", [("", "", 1.0), ("", "x", 0.0), ("x", "", 0.0), ("x", "x", 1.0)])
def test_likeness_of_small_texts(a, b, wanted):
    assert f.containment(f.fingerprint(a), f.fingerprint(b)) == wanted


def wanted(rows):
    """(doc_id, text) in order, to the result."""
    out = []
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        prints = [f.fingerprint(x) for x in (text, changed, following)]
        out.append(
            (i, len(text), sha(changed), f.spelled(prints[0]), f.spelled(prints[1]))
            + tuple(f.containment(prints[0], p) for p in prints[1:])
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("piece", [1, 7, 2000])
def test_query(spark, monkeypatch, piece):
    monkeypatch.setattr(f, "PIECE", piece)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = sorted(((r.doc_id, r.text or "") for r in docs), reverse=True)
    got = QUERIES["op5_fingerprints"](spark, SF_DIR)
    assert sorted(map(tuple, got.collect()), key=str) == wanted(rows)


@pytest.mark.parametrize("piece", [1, 3, 2000])
def test_defined_results(spark, monkeypatch, piece):
    monkeypatch.setattr(f, "PIECE", piece)
    rows = [(9, "nine " * 40), (8, ""), (8, "b"), (8, "b"), (3, "é" * 101), (-5, "x" * 3000), (None, ""), (None, "none")]
    df = spark.createDataFrame(rows + [], "doc_id long, text string").selectExpr("*", "1 AS piece", "2 AS echo", "3 AS key")
    assert sorted(map(tuple, f.compared(df).collect()), key=str) == wanted(rows)
    one = spark.createDataFrame([(4, "alone")], df.select("doc_id", "text").schema)
    assert f.compared(one).collect()[0].near_next == 1.0
    none = spark.createDataFrame([(None, None), (None, "b")], one.schema)
    assert sorted(map(tuple, f.compared(none).collect()), key=str) == wanted([(None, ""), (None, "b")])


def test_rows_of_one_id_are_split(spark, monkeypatch):
    monkeypatch.setattr(f, "PIECE", 10)
    numbers = random.Random(4)
    rows = [(None, f"{numbers.random()} text {n}") for n in range(300)] + [(n, "same") for n in range(5)] + [(7, "same")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = {r.piece: r["count"] for r in f._dealt(df).groupBy("piece").count().collect()}
    assert max(sizes.values()) < 100  # of 300 rows without an id
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    assert sorted(map(tuple, f.compared(df).collect()), key=str) == wanted(ordered)


@pytest.mark.parametrize("piece", [1, 2000])
def test_cuts_are_folded_into_the_plan(spark, monkeypatch, piece):
    monkeypatch.setattr(f, "PIECE", piece)
    dealt = f._dealt(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and plan.count("array(") < 10
