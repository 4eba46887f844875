"""Text quality without labels.

Heuristic labellers each call a text good, bad, or abstain. Their accuracies are
not known; they are estimated from how the labellers agree, by expectation
maximisation: given the accuracies, each pattern of votes has a posterior
probability of being good, and given the posteriors, each labeller has its rates
of calling good texts and bad texts good. Texts with one pattern are one row with
a count, so a round costs the patterns (3 to the number of labellers at most),
and the counts are those of all texts.

The posteriors are the labels that train a linear scorer of hashed features:
relative frequencies of a text's words and of their shapes, and the heuristics'
measures in tenths. It learns from at
most TRAIN_DOCS texts, chosen by a hash of their id, in one task; every whole text
is scored.

Defined results: a null text is empty; an empty text gets no votes but abstention
and the score of a text without features; a null id is hashed as such; rows that
repeat count and are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from math import ceil, exp
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import share_of_rows, stored, table

GOOD, BAD, ABSTAIN = 1, 0, 2
TRAIN_DOCS = 4000
FEATURES = 1 << 16
EPOCHS = 10
#: Words from which shares of sentences and of repeated trigrams mean something.
LEAST_WORDS = 20
STEP = 0.5


def _classes() -> bytes:
    """For each byte: A, a (also beyond ASCII), 0, blank, . for sentence ends, comma for other punctuation, s."""
    kinds = bytearray(b"s" * 128 + b"a" * 128)
    for chars, kind in ((b" \t\n\r\x0b\x0c", b" "), (b".!?", b"."), (b",;:'\"()-", b",")):
        for c in chars:
            kinds[c] = kind[0]
    for first, last, kind in (("A", "Z", b"A"), ("a", "z", b"a"), ("0", "9", b"0")):
        for c in range(ord(first), ord(last) + 1):
            kinds[c] = kind[0]
    return bytes(kinds)


_KIND = _classes()
_run = re.compile(rb"[.,s]{2}").search
_letter = re.compile(rb"[Aa]").search


class Facts:
    """What the labellers look at."""

    def __init__(self, text: str):
        data = text.encode()
        kinds = data.translate(_KIND)
        self.words = data.lower().split()
        self.shapes = Counter(kinds.split())
        self.n = len(self.words)
        self.chars = len(kinds) - kinds.count(b" ")
        self.symbols = kinds.count(b"s") / max(1, self.chars)
        upper = kinds.count(b"A")
        self.capitals = upper / max(1, upper + kinds.count(b"a"))
        of_shapes = self.shapes.items()
        self.wordless = sum(n for s, n in of_shapes if not _letter(s)) / max(1, self.n)
        self.punctuation = sum(n for s, n in of_shapes if _run(s)) / max(1, self.n)
        self.ends = sum(n for s, n in of_shapes if s.endswith(b".")) / max(1, self.n)
        w = self.words
        self.fresh = len(set(zip(w, w[1:], w[2:]))) / max(1, self.n - 2)
        self.stutter = sum(map(eq, w, w[1:])) / max(1, self.n - 1)
        lines = [x for x in data.split(b"\n") if x.strip()]
        self.lines = len(lines)
        self.repeated = 1 - len(set(lines)) / max(1, len(lines))


def _rule(value: Callable[[Facts], float], good: Callable[[float], bool], bad: Callable[[float], bool], least: int = 1):
    """A labeller of texts with at least that many words."""

    def vote(facts: Facts) -> int:
        if facts.n < least:
            return ABSTAIN
        x = value(facts)
        return GOOD if good(x) else BAD if bad(x) else ABSTAIN

    return vote


LABELLERS = {
    "symbols": _rule(lambda f: f.symbols, lambda x: x < 0.01, lambda x: x > 0.05),
    "capitals": _rule(lambda f: f.capitals, lambda x: x < 0.15, lambda x: x > 0.4),
    "wordless": _rule(lambda f: f.wordless, lambda x: x < 0.05, lambda x: x > 0.2, 10),
    "punctuation": _rule(lambda f: f.punctuation, lambda x: x < 0.05, lambda x: x > 0.2, 10),
    "sentences": _rule(lambda f: f.ends, lambda x: 0.01 <= x <= 0.4, lambda x: True, LEAST_WORDS),
    "word_length": _rule(lambda f: f.chars / f.n, lambda x: 3.5 < x < 7.5, lambda x: not 2.5 < x < 12, 5),
    "fresh": _rule(lambda f: f.fresh, lambda x: x > 0.85, lambda x: x < 0.6, LEAST_WORDS),
    "stutter": _rule(lambda f: f.stutter, lambda x: x < 0.03, lambda x: x > 0.1, LEAST_WORDS),
    "lines": _rule(lambda f: f.repeated if f.lines > 1 else 0.15, lambda x: x < 0.1, lambda x: x > 0.3),
}


def votes(text: str) -> str:
    """One digit for each labeller."""
    facts = Facts(text)
    return "".join(str(vote(facts)) for vote in LABELLERS.values())


def posteriors(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Probability of good for each pattern, and each labeller's rates [side, labeller, vote] of votes cast.

    An abstention says nothing. Each labeller knows some kinds of bad texts and
    takes the others for good, so a single call of bad is where it starts from.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}, np.empty((2, 0, 2))
    weights = np.array([counts[p] for p in patterns], dtype=float)
    cast = np.eye(3)[np.array([[int(v) for v in p] for p in patterns])][:, :, [BAD, GOOD]]
    good = np.where(cast[:, :, 0].any(axis=1), 0.2, 0.9)
    for _ in range(rounds):
        sides = np.stack((1 - good, good)) * weights  # bad, good
        rates = np.einsum("sp,plv->slv", sides, cast) + 0.5
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (sides.sum(axis=1) + 1) / (sides.sum() + 2)
        logs = np.log(prior)[:, None] + np.einsum("plv,slv->sp", cast, np.log(rates))
        now = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return dict(zip(patterns, good.tolist())), rates


def hashed(facts: Facts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their values: shares of words and of shapes, and the facts by tenths."""
    named = [(b"w" + w, n / facts.n) for w, n in Counter(facts.words).items()]
    named += [(b"s" + s, n / facts.n) for s, n in facts.shapes.items()]
    for name in ("symbols", "capitals", "wordless", "punctuation", "ends", "fresh", "stutter", "repeated"):
        known = facts.n >= (LEAST_WORDS if name in ("ends", "fresh") else 1)
        named.append((f"f{name}{ceil(10 * getattr(facts, name)) if known else None}".encode(), 1.0))
    where = np.fromiter((crc32(k) for k, _ in named), dtype=np.int64, count=len(named)) % FEATURES
    return where, np.fromiter((n for _, n in named), dtype=float, count=len(named))


def _trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights and bias of a logistic regression on soft labels, by adaptive steps."""
    examples = []
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            examples.append((*hashed(Facts(text or "")), label))
    weights, slopes = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for n in order.permutation(len(examples)):
            where, values, label = examples[n]
            p = 1 / (1 + exp(-max(-30.0, min(30.0, weights[where] @ values + weights[-1]))))
            where, values = np.append(where, FEATURES), np.append(values, 1.0)
            slope = (p - label) * values
            np.add.at(slopes, where, slope * slope)
            np.add.at(weights, where, -STEP * slope / np.sqrt(slopes[where]))
    yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()], pa.list_(pa.float64()))], names=["weights"])


def weak_labels(docs: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """doc_id and votes of each row, written once, and the posterior of each pattern."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast = [votes(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cast, pa.string())], names=["doc_id", "votes"])

    rows = docs.select("doc_id", "text")
    voted = stored(rows.mapInArrow(each, rows.select("doc_id", F.lit("").alias("votes")).schema))
    counts = {r.votes: r["count"] for r in voted.groupBy("votes").count().collect()}
    return voted, posteriors(counts)[0]


def scorer(docs: DataFrame, most: int = TRAIN_DOCS) -> tuple[np.ndarray, dict[str, float]]:
    """Weights of the linear scorer, and the posteriors that labelled its texts."""
    voted, good = weak_labels(docs)
    total = voted.count()
    sample = docs.filter(share_of_rows(min(1.0, most / max(1, total)))).select("doc_id", "text").dropDuplicates()

    def labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [good[votes(text.as_py() or "")] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.float64())], names=["doc_id", "text", "label"])

    chosen = stored(sample.mapInArrow(labelled, sample.withColumn("label", F.lit(0.0)).schema))
    trained = chosen.repartition(1).sortWithinPartitions("doc_id", "text").mapInArrow(_trained, "weights array<double>")
    rows = trained.collect()
    return np.array(rows[0].weights if rows else np.zeros(FEATURES + 1)), good


def scored(docs: DataFrame, weights: np.ndarray, good: dict[str, float]) -> DataFrame:
    """doc_id, weak_label (the labellers' posterior) and score (the scorer's) of each row."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = [], []
            for text in batch.column("text"):
                facts = Facts(text.as_py() or "")
                where, values = hashed(facts)
                raw = weights[where] @ values + weights[-1]
                scores.append(1 / (1 + exp(-max(-500.0, min(500.0, raw)))))
                labels.append(good.get("".join(str(vote(facts)) for vote in LABELLERS.values())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(labels, pa.float64()), pa.array(scores, pa.float64())],
                names=["doc_id", "weak_label", "score"],
            )

    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id", F.lit(None).cast("double").alias("weak_label"), F.lit(None).cast("double").alias("score")).schema
    return rows.mapInArrow(each, schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, and whether it would be kept."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, *scorer(docs)).withColumn("keep", F.col("score") >= 0.5)
