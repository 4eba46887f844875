"""Leaks against brute force."""

import random

import numpy as np
import pytest
from plain import normal

from tidemark.llm import decontaminate as d
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def index(spark):
    return next(d.indexes(spark.read.parquet(f"{SF_DIR}/benchmark.parquet")))


def impacts(index):
    matrix = np.zeros((len(index.postings), len(index.ids)))
    for t, (items, weights, most, blocks) in enumerate(index.postings):
        matrix[t, list(items)] = weights
        assert most == max(weights) and max(blocks.values()) == most
    return matrix


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
def test_wand_retrieves_all_above_the_threshold(index, threshold):
    matrix, rng = impacts(index), random.Random(threshold)
    index.threshold, before = threshold, index.threshold
    index.finish()
    for _ in range(300):
        item = rng.randrange(len(index.ids))
        own = np.nonzero(matrix[:, item])[0].tolist()
        terms = sorted(set(rng.sample(own, rng.randint(0, len(own))) + rng.sample(range(len(matrix)), 40)))
        scores = matrix[terms].sum(axis=0)
        wanted = {i for i in range(len(scores)) if scores[i] >= threshold - 1e-9}
        got = dict(index.retrieve(terms))
        assert set(got) == wanted
        assert all(got[i] == pytest.approx(scores[i]) for i in got)
        found = np.array(rng.sample(terms, len(terms)) + [-1] * rng.randint(0, 200), dtype=np.int64)
        rng.shuffle(list(found))
        passages = {
            p
            for p in range(index.passages(len(found)))
            for u in [np.unique(found[p * index.stride : (p + 2) * index.stride])]
            if (matrix[u[u >= 0]].sum(axis=0) >= threshold - 1e-9).any()
        }
        assert passages <= set(map(int, index.hopeful(found, len(found))))
    index.threshold = before
    index.finish()


def test_query_finds_all_items_that_stand_whole(spark):
    items = [(r.item_id, normal(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    wanted = {(r.doc_id, i) for r in docs for i, t in items if t in normal(r.text)}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, SF_DIR).collect()}
    assert got == wanted and wanted


def test_blocks_of_the_index_find_the_same(spark):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    found = [sorted(map(tuple, d.leaks(docs, items, block=b).select("doc_id", "item_id").collect())) for b in (d.BLOCK, 400)]
    assert found[0] == found[1]


QUESTION = "What is the name of the large river that flows through the old town of Basel? It is called the Rhine by everyone."


@pytest.mark.parametrize(
    "text, leaks",
    [
        (QUESTION, True),
        ("filler words go here " * 500 + QUESTION.upper().replace(" ", "\n") + " and more" * 500, True),
        (QUESTION.replace("large", "big"), True),
        (QUESTION.split("?")[0], False),  # the question alone
        (QUESTION.split("? ")[1], False),  # the answer alone
        ("The river is old and large. " * 50, False),
        (None, False),
        ("", False),
        ("Rhine", False),
    ],
)
def test_question_and_answer_must_both_be_there(spark, text, leaks):
    items = spark.createDataFrame([(1, QUESTION), (2, None), (3, ""), (4, "..."), (5, "Short one. Very short.")], ITEMS)
    docs = spark.createDataFrame([(7, text), (8, "A clean text of no interest."), (7, text)], DOCS)
    assert [(r.doc_id, r.item_id) for r in d.leaks(docs, items).collect()] == ([(7, 1)] if leaks else [])
    kept = d.decontaminated(docs.selectExpr("'e' AS score", "*", "1 AS item_id"), items)
    assert kept.columns == ["score", "doc_id", "text", "item_id"]
    assert sorted(r.doc_id for r in kept.collect()) == ([8] if leaks else [7, 7, 8])


def test_empty_benchmark_and_null_ids(spark):
    docs = spark.createDataFrame([(None, QUESTION), (1, QUESTION)], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert d.leaks(docs, none).count() == 0 and d.decontaminated(docs, none).count() == 2
    items = spark.createDataFrame([(None, QUESTION), (3, QUESTION)], ITEMS)
    got = {tuple(r) for r in d.leaks(docs, items).select("doc_id", "item_id").collect()}
    assert got == {(a, b) for a in (None, 1) for b in (None, 3)}


def test_long_items(spark):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(900)) + ". " + " ".join(f"w{rng.randrange(500)}" for _ in range(30))
    items = spark.createDataFrame([(1, text)], ITEMS)
    docs = spark.createDataFrame([(1, "before " * 777 + text + " after" * 99), (2, text[: len(text) // 3])], DOCS)
    assert [r.doc_id for r in d.leaks(docs, items).collect()] == [1]


def test_parts_of_items():
    assert d.question_and_answer("Who? Me.") == (["who"], ["me"])
    assert d.question_and_answer("one two three") == (["one", "two"], ["three"])
    assert d.overlap([], ["a"]) == 1.0 and d.overlap(["a"], ["b", "a"]) == 1.0
    assert d.overlap("a b c d".split(), "x a b c".split()) == 0.5


def test_short_items_beside_long_ones(spark):
    """Passages are as long as the items they are matched with."""
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(900)}" for _ in range(3000)) + ". The end of it is here at last."
    items = spark.createDataFrame([(1, long), (2, QUESTION)], ITEMS)
    said = QUESTION.split()
    scattered = " ".join(" ".join(said[i : i + 3]) + " so" * 200 for i in range(len(said) - 2))
    docs = spark.createDataFrame([(1, long), (2, "x " * 500 + QUESTION + " y" * 5000), (3, scattered)], DOCS)
    assert sorted((r.doc_id, r.item_id) for r in d.leaks(docs, items).collect()) == [(1, 1), (2, 2)]
    assert sorted(i.stride for i in d.indexes(items)) == [64, 4096]


def plain_in_order(part, window):
    best = [0] * (len(window) + 1)
    for a in part:
        before = best[:]
        for n, b in enumerate(window):
            best[n + 1] = before[n] + 1 if a == b else max(best[n], before[n + 1])
    return best[-1]


def test_words_in_order():
    rng = random.Random(2)
    for _ in range(200):
        part, window = (rng.choices("abcdef", k=rng.randint(1, 12)) for _ in range(2))
        places = {w: sum(1 << n for n, x in enumerate(part) if x == w) for w in part}
        assert d._most_in_order(places, len(part), window) == plain_in_order(part, window)
    assert d.in_order([], ["a"]) == 1.0 and d.in_order(["a"], []) == 0.0
    assert d.in_order("a b c d e".split(), "x x a b z d e x".split()) == 0.8
    assert d.in_order("a b c d e".split(), ("a " + "x " * 20 + "b " + "x " * 20 + "c").split()) == 0.2
    long = [f"w{n}" for n in range(300)]
    assert d.in_order(long, ["x"] * 77 + long + ["x"] * 500) == 1.0


@pytest.mark.parametrize("share, least", [(None, 0.99), (0.01, 0.99), (0.05, 0.97), (0.1, 0.95)])
def test_items_with_changed_words_are_found(spark, share, least):
    rng = random.Random(7)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    docs, parts_alone = [], []
    for r in items.collect():
        said = d.words(r.text)
        at = rng.randrange(len(said))
        changed = [f"zz{n}" if (n == at if share is None else rng.random() < share) else w for n, w in enumerate(said)]
        docs.append((r.item_id, " ".join(["before"] * rng.randrange(99) + changed + ["after"] * 99)))
        question, answer = d.question_and_answer(r.text)
        # too few words to tell the item from its question
        if len(answer) > 1 and len(question) > 1:
            parts_alone.append((r.item_id, " ".join(["before"] * 50 + question + ["after"] * 99)))
    found = d.leaks(spark.createDataFrame(docs, DOCS), items).filter("doc_id = item_id").count()
    assert found >= least * len(docs)
    assert d.leaks(spark.createDataFrame(parts_alone, DOCS), items).filter("doc_id = item_id").count() == 0
