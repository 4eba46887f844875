"""Repeated passages against plain Python over all windows."""

import random
import re

import numpy as np
import pytest
from plain import sha

from tidemark.llm import substring_dedup as s
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def wanted(docs, depth=20):
    """(doc_id, text) to the result."""
    said = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in docs]
    earliest = {}
    for i, words in said:
        for n in range(len(words) - depth + 1):
            key, place = tuple(words[n : n + depth]), (i is None, i or 0, n)
            earliest[key] = min(earliest.get(key, place), place)
    rows = []
    for i, words in said:
        gone = set()
        for n in range(len(words) - depth + 1):
            if earliest[tuple(words[n : n + depth])] < (i is None, i or 0, n):
                gone.update(range(n, n + depth))
        kept = [w for n, w in enumerate(words) if n not in gone]
        rows.append((i, len(words), len(gone), sha(" ".join(kept))))
    return sorted(rows, key=repr)


def found(df):
    rows = s.without_repeats(df).select("doc_id", "n_words", "n_removed", "kept").collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, sha(r.kept)) for r in rows), key=repr)


@pytest.mark.parametrize("group, packed", [(1 << 16, 1 << 18), (50, 300), (1, 40)])
def test_query(spark, monkeypatch, group, packed):
    """Groups so small that prefixes are prolonged, and all windows go alone, give the same."""
    monkeypatch.setattr(s, "GROUP", group)
    monkeypatch.setattr(s, "PACKED", packed)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = sorted(map(tuple, QUERIES["op12_substrings"](spark, SF_DIR).collect()), key=repr)
    assert rows == wanted(docs)
    assert sum(r[2] for r in rows) > 0


def passages(seed, n_docs=60, vocabulary=4):
    """Texts over few words, so that prefixes are shared widely, with passages that repeat and overlap."""
    rnd = random.Random(seed)
    shared = [[rnd.choice("abcdefgh") for _ in range(rnd.randint(15, 70))] for _ in range(5)]
    docs = []
    for i in range(n_docs):
        words = []
        for _ in range(rnd.randint(0, 4)):
            words += [rnd.choice("abcdefghijklmnop"[:vocabulary]) for _ in range(rnd.randint(0, 60))]
            if rnd.random() < 0.6:
                part = rnd.choice(shared)
                words += part[rnd.randint(0, 5) : len(part) - rnd.randint(0, 5)]
        docs.append((i, rnd.choice(" \n\t").join(words)))
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("group", [1 << 16, 20, 1])
def test_random_passages(spark, monkeypatch, group):
    monkeypatch.setattr(s, "GROUP", group)
    for seed, vocabulary in ((1, 2), (2, 16)):
        docs = passages(seed, vocabulary=vocabulary)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        assert found(df) == wanted(docs)


@pytest.mark.parametrize("group", [1 << 16, 1])
def test_defined_results(spark, monkeypatch, group):
    monkeypatch.setattr(s, "GROUP", group)
    long = " ".join(f"w{n}" for n in range(50))
    rows = [(5, long), (5, long), (5, long.replace("w49", "x")), (3, "new " + long), (None, long), (None, long + " end")]
    rows += [(7, None), (8, ""), (9, " \n "), (10, "a " * 19), (11, "a " * 20), (12, "a " * 45), (13, "A " * 45)]
    rows += [(20, "é ü " * 30), (21, " x " * 30), (22, "x" * 5000 + " " + long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS n", "3 AS starts", "4 AS kept")
    assert found(df) == wanted(rows)
    assert found(df.limit(0)) == []


def test_removed_passages(spark):
    part = " ".join(f"p{n}" for n in range(25))
    rows = [(1, f"one {part} two"), (2, f"a b {part} c {part}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by_id = {r.doc_id: r for r in s.without_repeats(df).collect()}
    assert by_id[1].removed == [] and by_id[2].kept == "a b c"
    assert [tuple(span) for span in by_id[2].removed] == [(2, 27), (28, 53)]


def test_very_long_text(spark):
    rnd = random.Random(3)
    words = [f"w{rnd.randint(0, 10**6)}" for _ in range(400_000)]
    text = " ".join(words + words[1000:1100])
    (row,) = s.without_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (row.n_words, row.n_removed) == (400_100, 100)
    assert row.kept == " ".join(words)


def test_words_and_pieces(monkeypatch):
    monkeypatch.setattr(s, "_PIECE", 64)
    rnd = random.Random(4)
    data = "".join(rnd.choices("ab é\n\t\x0b ", k=5000)).encode() + b"z" * 300
    starts, ends, digests = s.words_of(data)
    assert [data[a:b] for a, b in zip(starts, ends)] == data.split()
    assert len(set(digests.tolist())) == len(set(data.split()))


def test_equal_windows_choose_the_same_suffix():
    rnd = np.random.default_rng(5)
    words = rnd.integers(0, 1 << 62, 300).astype(np.uint64)
    place = s.anchors(words, 20, 8)
    grams = s.gram_digests(words, 8)
    assert len(place) == 281
    for n, p in enumerate(place.tolist()):
        assert p == n + int(np.argmin(grams[n : n + 13]))
    moved = s.anchors(words[37:], 20, 8)
    assert (moved + 37 == place[37:]).all()


def test_deep_nodes():
    rnd = np.random.default_rng(6)
    suffixes = rnd.integers(1, 3, (400, 6))
    order, node = s.deep_nodes(suffixes)
    seen = {}
    for n, k in zip(order.tolist(), node.tolist()):
        assert seen.setdefault(tuple(suffixes[n].tolist()), k) == k
    assert len(set(node.tolist())) == len(seen)
