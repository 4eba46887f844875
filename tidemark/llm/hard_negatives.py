"""Hard negatives of anchors, by bounds along a spanning tree of the anchors.

Vectors become whole numbers, floor(256 x), and a score is the exact inner product
of two of them. For each anchor, its positives are the best rows of its own label;
for each positive, its hard negatives are the best rows of other labels whose
score lies in a window, a share of the positive's.

Anchors are taken in blocks. A block's anchors are joined by a minimum spanning
tree of their distances. At the root every candidate is scored. At a child, a
candidate's score differs from that at the parent by no more than the edge's
length times the candidate's norm; only candidates whose bounds overlap what the
anchor looks for are scored again, the others hand their bounds on to the child's
own children. So no score in a window is missed, however loose the bounds are.

Each block is one pass over the candidates for the positives and one for the
negatives. A task holds CANDIDATES rows and their bounds at a time and gives the
best of its rows for each anchor; windows over these few give the final ranks.
What a block sends to the executors is bounded by ANCHORS, whatever the data are.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part. A row without an id is no anchor, keeps its label and
comes last among ties. Rows that repeat an id are rows each, as anchors too; equal
rows stand in the order of the cleaned table. A shorter vector lacks components,
which count as zeros; an empty one scores zero. Components beyond a long are taken
as its bounds, and so are scores, after ranks have been found by their true
values. An anchor without another row of its label gives no rows, nor does a
positive with an empty window, as where its score is below zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.sources.workdir import work_dir

POSITIVES, NEGATIVES = 5, 3
#: A negative's score, in percent of the positive's.
LEAST, MOST = 50, 95
#: Anchors in a block on average, and candidates that a task compares at a time.
ANCHORS, CANDIDATES = 2048, 2048
SCALE = 256
#: Every sum of products below this is exact in a double.
_EXACT = 1 << 53
_LONG = (1 << 63) - 1
#: Relabelled rows, and anchors, by what their id is divisible by.
RELABELLED, ANCHORED = 7, 50

_FOUND = "anchor long, positive long, row long, vec_id long, score decimal(38,0)"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector, an array of whole numbers, of the rows that take part.

    vectors: vec_id, label, embedding.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("long"))
    return vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector")
    )


class SpanningTree:
    """A minimum spanning tree of points: an order from the root on, and for each point its parent and the distance to it."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        squares = (points * points).sum(axis=1)
        self.parent = np.full(n, -1)
        self.edge = np.zeros(n)
        self.order = []
        nearest, outside = np.full(n, np.inf), np.ones(n, dtype=bool)
        new = 0
        for _ in range(n):
            self.order.append(new)
            outside[new] = False
            distance = squares + squares[new] - 2.0 * (points @ points[new])
            closer = outside & (distance < nearest)
            nearest[closer], self.parent[closer] = distance[closer], new
            if outside.any():
                new = int(np.argmin(np.where(outside, nearest, np.inf)))
                # a little more than the root, so that rounding cannot make a bound too tight
                difference = points[new] - points[self.parent[new]]
                self.edge[new] = np.sqrt(difference @ difference) * (1 + 1e-9)

    def overlapping(
        self, rows: np.ndarray, wanted: Callable[[int], np.ndarray], low: np.ndarray, high: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each point, the rows that are wanted there and can score from `low` to `high`, and their scores."""
        norms = np.sqrt((rows * rows).sum(axis=1)) * (1 + 1e-9)
        least = np.empty((len(self.points), len(rows)))
        most = np.empty_like(least)
        for n in self.order:
            parent = self.parent[n]
            if parent < 0:
                least[n] = most[n] = rows @ self.points[n]
            else:
                reach = self.edge[n] * norms
                np.subtract(least[parent], reach, out=least[n])
                np.add(most[parent], reach, out=most[n])
            at = np.nonzero((most[n] >= low[n]) & (least[n] <= high[n]) & wanted(n))[0]
            if 4 * len(at) > len(rows):  # sooner all at once
                scores = rows @ self.points[n]
                least[n] = most[n] = scores
                scores = scores[at]
            else:
                scores = rows[at] @ self.points[n]
                least[n][at] = most[n][at] = scores
            yield n, at, scores


class ExactScores:
    """The same for numbers too large for doubles: every wanted row is scored, by Python's whole numbers."""

    def __init__(self, points: np.ndarray):
        self.points = points

    def overlapping(self, rows, wanted, low, high):
        for n, point in enumerate(self.points):
            at = np.nonzero(wanted(n))[0]
            yield n, at, np.array([sum(map(int.__mul__, rows[i].tolist(), point.tolist())) for i in at], dtype=object)


def matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    """Whole numbers, shorter vectors filled up with zeros."""
    rows = np.zeros((len(vectors), width), dtype=np.int64)
    for n, vector in enumerate(vectors):
        rows[n, : len(vector)] = vector[:width]
    return rows


class Block:
    """Some anchors: their rows, ids, labels and vectors."""

    def __init__(self, rows: list):
        self.rows = np.array([r.row for r in rows], dtype=np.int64)
        self.ids = [r.vec_id for r in rows]
        self.labels = np.array([r.label for r in rows], dtype=np.int64)
        self.width = max((len(r.vector) for r in rows), default=0)
        self.vectors = matrix([r.vector for r in rows], self.width)
        self.tree = SpanningTree(self.vectors.astype(np.float64))
        self.largest = max((abs(x) for r in rows for x in r.vector), default=0)

    def compared(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        """Of each batch of candidates: row numbers, ids, whether there is no id, labels, vectors and the way to score them."""
        for whole in batches:
            for start in range(0, len(whole), CANDIDATES):
                batch = whole.slice(start, CANDIDATES)
                ids = batch.column("vec_id")
                vectors = matrix(batch.column("vector").to_pylist(), self.width)
                largest = max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0))))
                exact = largest * self.largest * max(1, self.width) >= _EXACT
                yield (
                    batch.column("row").to_numpy(zero_copy_only=False),
                    ids.fill_null(0).to_numpy(zero_copy_only=False),
                    ids.is_null().to_numpy(zero_copy_only=False),
                    batch.column("label").to_numpy(zero_copy_only=False),
                    vectors if exact else vectors.astype(np.float64),
                    ExactScores(self.vectors) if exact else self.tree,
                )


class Leaders:
    """The best few rows of each group, among all that have been added."""

    def __init__(self, most: int):
        self.most = most
        self.kept: dict[tuple, list[tuple]] = {}

    def add(self, group: tuple, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        new = [(-int(s), bool(m), int(i), int(r)) for s, m, i, r in zip(scores, missing, ids, rows)]
        self.kept[group] = sorted(self.kept.get(group, []) + new)[: self.most]

    def least(self, group: tuple) -> float:
        """The score that a row must reach to get in."""
        kept = self.kept.get(group, [])
        return float(-kept[-1][0]) if len(kept) == self.most else -np.inf

    def batch(self) -> pa.RecordBatch:
        """anchor, positive, row, vec_id, score"""
        found = [(*group, r, None if m else i, -s) for group, kept in self.kept.items() for s, m, i, r in kept]
        columns = list(zip(*found)) or [[]] * 5
        types = [pa.int64()] * 4 + [pa.decimal128(38, 0)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["anchor", "positive", "row", "vec_id", "score"]
        )


def _first(scores: np.ndarray, missing: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Order by score, best first, then by id, none last."""
    return np.lexsort((rows, ids, missing, -scores))


def _positives(block: Block, most: int) -> Callable:
    """The best rows of each anchor's label in a task, the anchor itself left out."""

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = Leaders(most)
        high = np.full(len(block.rows), np.inf)
        for rows, ids, missing, labels, vectors, scorer in block.compared(batches):
            low = np.array([leaders.least((n, 0)) for n in range(len(block.rows))])
            alike = {label: labels == label for label in set(block.labels.tolist())}
            for n, at, scores in scorer.overlapping(vectors, lambda n: alike[int(block.labels[n])], low, high):
                keep = (scores >= low[n]) & (rows[at] != block.rows[n])
                at, scores = at[keep], scores[keep]
                first = _first(scores, missing[at], ids[at], rows[at])[:most]
                at = at[first]
                leaders.add((n, 0), scores[first], missing[at], ids[at], rows[at])
        yield leaders.batch()

    return best


def _negatives(block: Block, windows: dict[int, list[tuple[int, int, int]]], most: int) -> Callable:
    """The best rows of other labels in a task, for each window of each anchor: number, least and most score."""

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = Leaders(most)
        low, high = np.full(len(block.rows), np.inf), np.full(len(block.rows), -np.inf)
        for n, each in windows.items():
            low[n], high[n] = float(min(w[1] for w in each)), float(max(w[2] for w in each))
        for rows, ids, missing, labels, vectors, scorer in block.compared(batches):
            others = {label: labels != label for label in set(block.labels.tolist())}
            for n, at, scores in scorer.overlapping(vectors, lambda n: others[int(block.labels[n])], low, high):
                if n not in windows or not len(at):
                    continue
                first = _first(scores, missing[at], ids[at], rows[at])
                at, descending = at[first], -scores[first]
                for place, least, upmost in windows[n]:
                    start = np.searchsorted(descending, -upmost)
                    end = min(np.searchsorted(descending, -least, side="right"), start + most)
                    if start < end:
                        few = at[start:end]
                        leaders.add((n, place), -descending[start:end], missing[few], ids[few], rows[few])
        yield leaders.batch()

    return best


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def window_of(score: int, least: int = LEAST, most: int = MOST) -> tuple[int, int]:
    """The scores from `least` to `most` percent of a score; empty if the first is above the second."""
    return -(-least * score // 100), most * score // 100


def _long(value: int) -> int:
    return max(-_LONG - 1, min(_LONG, value))


def hard_negatives(
    rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, label, vector (see `whole_vectors`); is_anchor: a condition on them.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # scoring a candidate costs far more than moving it: small tables are dealt out too
    dealt = rows.select("vec_id", "label", "vector").repartition(parts, F.xxhash64("vec_id", "vector"))
    candidates = stored(dealt.withColumn("row", F.monotonically_increasing_id()))
    anchors = candidates.filter(is_anchor)
    blocks = ceil(anchors.count() / ANCHORS)
    anchors = stored(anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, blocks)))))
    folder = f"{work_dir(spark)}/negatives"
    spark.createDataFrame([], _RESULT).write.parquet(folder)
    for n in range(blocks):
        block = Block(anchors.filter(F.col("block") == n).orderBy("row").collect())
        if len(block.rows):
            shared = spark.sparkContext.broadcast(block)
            _block_result(candidates, shared, positives, negatives, least, most).write.mode("append").parquet(folder)
            shared.unpersist()
    return spark.read.schema(_RESULT).parquet(folder)


def _block_result(candidates: DataFrame, shared, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    block = shared.value
    found = _ranked(candidates.mapInArrow(lambda batches: _positives(shared.value, positives)(batches), _FOUND), positives)
    best = found.orderBy("anchor", "rank").collect()  # a few for each anchor of the block
    windows: dict[int, list[tuple[int, int, int]]] = {}
    about = []
    for place, row in enumerate(best):
        low, high = window_of(int(row.score), least, most)
        if low <= high:
            windows.setdefault(row.anchor, []).append((place, low, high))
            about.append((row.anchor, place, block.ids[row.anchor], row.vec_id, _long(int(row.score))))
    spark = candidates.sparkSession
    told = spark.createDataFrame(about, "anchor long, positive long, anchor_id long, positive_id long, positive_score long")
    ranked = _ranked(candidates.mapInArrow(lambda batches: _negatives(shared.value, windows, negatives)(batches), _FOUND), negatives)
    bounded = F.greatest(F.least(F.col("score"), F.lit(_LONG).cast("decimal(38,0)")), F.lit(-_LONG - 1).cast("decimal(38,0)"))
    return ranked.join(told, ["anchor", "positive"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        bounded.cast("long").alias("negative_score"),
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of the embeddings, some of whose labels are wrong."""
    vectors = whole_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    wrong = F.coalesce(F.col("vec_id") % RELABELLED == 0, F.lit(False))
    rows = vectors.withColumn("label", F.when(wrong, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % ANCHORED == 0)


OP13_SQL = """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n
  FROM scored WHERE alike) WHERE n <= 5),
ranked AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""
