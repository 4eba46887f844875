"""Weak labels and the scorer."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import quality as q
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_posteriors_find_the_accuracies():
    """Votes drawn from known rates."""
    rng = random.Random(3)
    n = 9
    rates = {1: [0.97] * n, 0: [0.35, 0.4, 0.5, 0.3, 0.6, 0.45, 0.5, 0.4, 0.55]}  # of calling it good
    counts, truth = {}, {}
    for _ in range(20_000):
        side = int(rng.random() < 0.8)
        p = "".join("2" if rng.random() < 0.1 else str(int(rng.random() < rates[side][k])) for k in range(n))
        counts[p] = counts.get(p, 0) + 1
        truth.setdefault(p, []).append(side)
    good, found = q.posteriors(counts)
    assert found[1, :, q.GOOD] == pytest.approx(rates[1], abs=0.02)
    assert found[0, :, q.GOOD] == pytest.approx(rates[0], abs=0.05)
    right = sum(s == (good[p] >= 0.5) for p, sides in truth.items() for s in sides)
    assert right / 20_000 > 0.97


def test_posteriors_of_nothing_and_of_abstentions():
    assert q.posteriors({})[0] == {}
    good, _ = q.posteriors({"222": 5, "112": 50, "002": 5})
    assert good["112"] > 0.5 > good["002"] and 0 < good["222"] < 1


@pytest.mark.parametrize(
    "text, bad",
    [
        ("This is a plain text. It has some sentences, and they end as they should. Nothing is said twice, nor in a loud voice.", set()),
        ("WORDS IN CAPITALS ARE LOUD. THEY GO ON AND ON AND ON!! " * 3, {"capitals"}),
        ("buy### now$$$ or%%% never&&& again### and$$$ more%%% of&&& it### " * 3, {"symbols", "punctuation", "sentences"}),
        ("Home | News | Sport | Weather | Home | Travel | Food | Money | Help | Jobs | Cars", {"symbols", "wordless", "sentences"}),
        ("spam spam spam spam spam spam spam. " * 10, {"fresh", "stutter"}),
        ("A line of text here.\n" * 10, {"lines", "fresh"}),
    ],
)
def test_labellers(text, bad):
    cast = dict(zip(q.LABELLERS, q.votes(text)))
    assert bad <= {name for name, v in cast.items() if v == str(q.BAD)}
    if not bad:
        assert str(q.BAD) not in cast.values()


def test_facts_of_odd_texts():
    for text in ("", " ", "\n", "a", "😀", "é" * 100_000):
        assert len(q.votes(text)) == len(q.LABELLERS)
        where, values = q.hashed(q.Facts(text))
        assert len(where) == len(values) and (where < q.FEATURES).all() and np.isfinite(values).all()


def test_query_agrees_with_labels_it_never_saw(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = QUERIES["op2_quality"](spark, SF_DIR).collect()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    known = [(r.keep, labels[r.doc_id]) for r in got if r.doc_id in labels]
    good, bad = ([k for k, y in known if y == side] for side in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    assert all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in got)


def plain_posteriors(votes, rounds=200):
    """Document after document: each one's probability of being good."""
    cast = [[(k, int(v)) for k, v in enumerate(p) if int(v) != q.ABSTAIN] for p in votes]
    good = [0.2 if any(v == q.BAD for _, v in c) else 0.9 for c in cast]
    for _ in range(rounds):
        of_good = [[0.5, 0.5] for _ in q.LABELLERS]  # sums of good and bad votes, of good documents
        of_bad = [[0.5, 0.5] for _ in q.LABELLERS]
        for c, g in zip(cast, good):
            for k, v in c:
                of_good[k][v] += g
                of_bad[k][v] += 1 - g
        prior = (math.fsum(good) + 1) / (len(good) + 2)
        now = []
        for c in cast:
            a, b = prior, 1 - prior
            for k, v in c:
                a *= of_good[k][v] / sum(of_good[k])
                b *= of_bad[k][v] / sum(of_bad[k])
            now.append(a / (a + b))
        moved = max(abs(x - y) for x, y in zip(good, now))
        if moved < 1e-9:
            break
        good = now
    return good


def plain_scores(texts, labels, of):
    """A logistic regression by adaptive steps, feature after feature, and the scores of the texts `of`."""
    weights, slopes = defaultdict(float), defaultdict(lambda: 1e-6)

    def features(text):
        out = defaultdict(float)
        for where, value in zip(*q.hashed(q.Facts(text))):
            out[int(where)] += float(value)  # names that meet in one place add up
        return out

    def probability(found):
        raw = sum(weights[w] * v for w, v in found.items()) + weights["bias"]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, raw))))

    examples = [(features(t), y) for t, y in zip(texts, labels)]
    order = np.random.default_rng(0)
    for _ in range(q.EPOCHS):
        for n in order.permutation(len(examples)):
            found, y = examples[n]
            gap = probability(found) - y
            for w, v in [*found.items(), ("bias", 1.0)]:
                slopes[w] += (gap * v) ** 2
                weights[w] -= q.STEP * gap * v / math.sqrt(slopes[w])
    return [probability(features(t)) for t in of]


def test_query_is_plain_expectation_maximisation_and_regression(spark):
    folder = "/root/testdata/sf0.001"
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()))
    texts = [text for _, text in docs]
    assert len(docs) <= q.TRAIN_DOCS and len(set(docs)) == len(docs)  # so all are learned from
    labels = plain_posteriors([q.votes(text) for text in texts])
    scores = plain_scores(texts, labels, texts)
    got = {r.doc_id: r for r in QUERIES["op2_quality"](spark, folder).collect()}
    assert [got[i].weak_label for i, _ in docs] == pytest.approx(labels, abs=1e-6)
    assert [got[i].score for i, _ in docs] == pytest.approx(scores, abs=0.02)
    assert all(got[i].keep == (s >= 0.5) for (i, _), s in zip(docs, scores) if abs(s - 0.5) > 0.02)


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (None, "Some words here."), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS votes", "1 AS score")
    got = q.scored(docs, *q.scorer(docs)).collect()
    assert sorted((r.doc_id for r in got), key=str) == [1, 2, 2, None]
    assert len({r.score for r in got if r.doc_id}) == 1
    assert q.scored(docs.limit(0), *q.scorer(docs.limit(0))).count() == 0


def test_same_scorer_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(200)
    a, b = q.scorer(docs.repartition(3))[0], q.scorer(docs.repartition(11))[0]
    assert np.allclose(a, b)
    assert list(itertools.islice(np.nonzero(a)[0], 1))
