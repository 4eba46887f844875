"""Document fingerprints by content-defined chunking.

A gear hash runs over the text's UTF-8 bytes; its value at a byte depends on the
32 bytes before it alone. A chunk ends where the hash has enough leading zero
bits: more of them before the chunk has its normal size than after it (normalised
chunking), never before LEAST bytes and always at MOST. Boundaries follow the
content, so a change moves only the boundaries near it.

A fingerprint is the set of a text's chunks: for each different chunk its digest
and the bytes it covers, in the order of digests. The likeness of one fingerprint
to another is the share of its bytes in chunks that the other has as well
(containment; a chunk that repeats counts as often as both have it).

Each text is compared with the next document's, and with its own edited text,
whose end is the next document's beginning. Documents are dealt to pieces of
neighbouring ids, by cuts taken from the ids, and from beginnings of texts where
one id has many rows; the first document of each piece also goes to the piece
before it. Texts are shuffled once, and a task
holds two of them at a time.

Defined results: a null text is empty; an empty text has the empty fingerprint;
two empty fingerprints have likeness 1, an empty and another one 0. The next of
the last document is the first, so a single document is its own next. Rows that
repeat an id follow each other by text; null ids come last. An empty table gives
no rows.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

LEAST, NORMAL, MOST = 16, 64, 256
#: Leading zero bits asked for before and after the normal size.
STRICT_BITS, EASY_BITS = 7, 4
#: Hex digits of a chunk's digest.
DIGITS = 12
_WINDOW = 32
_GEAR = np.random.default_rng(2016).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Documents to a piece on average, as long as there are no more than PIECES pieces.
PIECE, PIECES = 2_000, 50_000
#: Places picked for each one at which a piece starts, which makes pieces of like sizes.
PICKS = 8
#: Characters that tell rows of one id apart, where it has more rows than a piece.
HEAD = 64
_KEY = "CAST(coalesce(doc_id, -9223372036854775808) AS BIGINT)"


def gear_hashes(data: bytes) -> np.ndarray:
    """The hash at each byte: sum of the last 32 bytes' gears, each doubled once a step."""
    sums = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    span = 1
    while span < _WINDOW:  # sums over `span` bytes to sums over twice as many
        longer = sums.copy()
        longer[span:] += sums[:-span] << np.uint32(span)
        sums, span = longer, 2 * span
    return sums


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks."""
    size = len(data)
    if not size:
        return []
    hashes = gear_hashes(data)
    places = np.nonzero(hashes < 1 << (32 - EASY_BITS))[0]
    easy = (places + 1).tolist()
    strict = (places[hashes[places] < 1 << (32 - STRICT_BITS)] + 1).tolist()
    ends, start = [], 0
    while start < size:
        n = bisect_left(strict, start + LEAST)
        end = strict[n] if n < len(strict) else size
        if end > start + NORMAL:
            n = bisect_left(easy, start + NORMAL + 1)
            end = easy[n] if n < len(easy) else size
        start = min(end, start + MOST, size)
        ends.append(start)
    return ends


def fingerprint(text: str) -> dict[str, int]:
    """Digest of each different chunk, with the bytes that its occurrences cover."""
    data, start, chunks = text.encode(), 0, Counter()
    for end in boundaries(data):
        chunks[xxhash.xxh64_hexdigest(data[start:end])[:DIGITS]] += end - start
        start = end
    return dict(sorted(chunks.items()))


def spelled(chunks: dict[str, int]) -> str:
    return ",".join(f"{digest}:{size}" for digest, size in chunks.items())


def containment(chunks: dict[str, int], other: dict[str, int]) -> float:
    """Share of the bytes of `chunks` that lie in chunks of `other`, 0 to 1."""
    if not chunks:
        return 0.0 if other else 1.0
    return sum(min(size, other.get(digest, 0)) for digest, size in chunks.items()) / sum(chunks.values())


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _place(head: Column) -> Column:
    """Where a row stands: by descending id, null ids last, and by the first characters of its text."""
    return F.struct(F.bitwise_not("key").alias("back"), F.col("doc_id").isNull().alias("missing"), head.alias("head"))


def _cuts(rows: DataFrame) -> tuple[DataFrame, list[Row]]:
    """The rows with the place `at`, and the places, in order, at which pieces start.

    A hash picks places, `PICKS` for each piece, and every `PICKS`-th of them from
    the first place on is a cut. A place tells rows of one id apart only if some id has more rows than
    a piece should: only then are texts read for it.
    """
    ids = rows.groupBy("key").agg(F.count("*").alias("rows"))
    total = ids.agg(F.sum("rows").alias("rows"), F.max("rows").alias("most")).first()
    size = max(PIECE, (total.rows or 0) // PIECES)
    head = F.substring("text", 1, HEAD) if (total.most or 0) > size else F.lit("")
    placed = rows.withColumn("at", _place(head))
    step = min(PICKS, size)
    picked = placed.filter(F.pmod(F.xxhash64("at"), F.lit(size // step)) == 0).select("at").distinct()
    first = placed.agg(F.min("at").alias("at")).filter("at IS NOT NULL")
    return placed, sorted({r.at for r in picked.unionByName(first).collect()})[::step]


def _dealt(docs: DataFrame) -> DataFrame:
    """piece, echo, key, doc_id, text: neighbours by descending id, in pieces that start at a cut.

    The documents at a cut are echoed at the end of the piece before.
    """
    rows = docs.select(
        F.expr(_KEY).alias("key"), F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    placed, cuts = _cuts(rows)
    n = len(cuts)
    # one folded literal, whatever the number of cuts
    kind = "array<struct<back: bigint, missing: boolean, head: string>>"
    all_cuts = F.from_json(F.lit(json.dumps([c.asDict() for c in cuts])), kind)
    steps = [1 << b for b in reversed(range(n.bit_length()))]

    def further(place: Column, step: Column) -> Column:
        reached = F.try_element_at(all_cuts, place + step)
        return F.when((place + step <= n) & (reached <= F.col("at")), place + step).otherwise(place)

    place = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further) if n else F.lit(0)
    placed = placed.withColumn("piece", place)
    is_cut = F.try_element_at(all_cuts, F.col("piece")) == F.col("at") if n else F.lit(False)
    before = F.when(F.col("piece") == 1, n).otherwise(F.col("piece") - 1)
    own = F.struct(F.col("piece").alias("piece"), F.lit(0).alias("echo"))
    echo = F.struct(before.alias("piece"), F.lit(1).alias("echo"))
    copies = F.when(is_cut, F.array(own, echo)).otherwise(F.array(own))
    return placed.withColumn("to", F.explode(copies)).select("to.*", "key", "doc_id", "text")


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, from rows in order; each is compared with the row after it."""
    waiting = None
    for batch in batches:
        rows = []
        for n, echo in enumerate(batch.column("echo").to_pylist()):
            if echo and waiting is None:  # a further row with the id of the cut
                continue
            text = batch.column("text")[n].as_py()
            chunks = fingerprint(text)
            if waiting is not None:
                doc_id, own, own_chunks = waiting
                changed = edited(own, text)
                changed_chunks = fingerprint(changed)
                rows.append(
                    (
                        doc_id,
                        len(own),
                        sha256(changed.encode()).hexdigest(),
                        spelled(own_chunks),
                        spelled(changed_chunks),
                        containment(own_chunks, changed_chunks),
                        containment(own_chunks, chunks),
                    )
                )
            waiting = None if echo else (batch.column("doc_id")[n].as_py(), text, chunks)
        columns = list(zip(*rows)) or [[]] * len(_FIELDS)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], names=[f for f, _ in _FIELDS])


_FIELDS = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, and the likenesses."""
    order = ["piece", "echo", F.desc("key"), F.col("doc_id").desc_nulls_last(), "text"]
    rows = _dealt(docs).repartition("piece").sortWithinPartitions(*order)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select("echo", "doc_id", "text").mapInArrow(_compared, schema)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, with the likeness to the next and to the edited text."""
    return compared(table(spark, sf_dir, "documents"))
