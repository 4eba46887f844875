"""Near-duplicates by SimHash.

A text is lower-cased (A-Z), cut into words, and its shingles of `words` words
are hashed (XXH64, seed 42); a bit of the fingerprint is 1 if it is set in over
half of the hashes. Texts whose fingerprints differ in at most `bits` bits are
linked, and links are followed to the end.

Pigeonhole blocks: a fingerprint is cut into `bits` + r blocks; two that differ
in at most `bits` bits agree in some r blocks. Each choice of r blocks is a key,
and fingerprints that share a key are compared by their Hamming distance. r rises
with the number of different fingerprints so that a key has few of them by
chance; the links found are the same for any r.

Equal fingerprints are one node, however many texts have them. Fingerprints with
one key are compared in one task and give a spanning forest, not all their
pairs; there are at most CROWD of them. Beyond that the key's fingerprints give
all points within half of `bits` bits instead: two fingerprints are linked just
if they share such a point. That takes no comparison, and rows in proportion to
the number of fingerprints.

Defined results: a text without words, or null, has fingerprint zero and is
linked like any other; a text of fewer words than a shingle has one shingle, all
of it; rows that repeat an id are rows of the result each; a null id never names
a component unless nothing else is in it; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, stored, table
from tidemark.llm.components import components, with_least

WORDS = 4
BITS = 4
SEED = 42
#: Fingerprints that one task compares for one key.
CROWD = 2000
#: Shingles hashed at a time, which bounds the memory for a long text.
RUN = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits, as a signed integer."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    width = min(words, len(parts))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(parts) - width + 1]
    stops = ends[width - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), RUN):
        pieces = zip(starts[at : at + RUN].tolist(), stops[at : at + RUN].tolist())
        hashes = np.array([digest(line[i:j], SEED) for i, j in pieces], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, print (a signed 64-bit number) and the columns named in `carry`, for each row."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), words) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(prints, pa.int64())], names=[*batch.schema.names[1:], "print"]
            )

    rows = docs.select("text", "doc_id", *carry)
    return rows.mapInArrow(each, rows.drop("text").withColumn("print", F.lit(0).cast("long")).schema)


def agreeing(prints: int, bits: int = BITS) -> int:
    """How many blocks a key has, for that many different fingerprints."""
    return next(r for r in range(1, 61) if 64 * r / (bits + r) >= log2(max(prints, 2)) + 3 or r == 60)


def _keys(prints: DataFrame, bits: int, r: int) -> DataFrame:
    """Each print with each of its keys."""
    cuts = [round(64 * i / (bits + r)) for i in range(bits + r + 1)]

    def block(i: int) -> Column:
        size = cuts[i + 1] - cuts[i]
        return F.shiftrightunsigned("print", cuts[i]).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1))

    keys = [
        F.xxhash64(F.lit(n), *[block(i) for i in chosen])
        for n, chosen in enumerate(combinations(range(bits + r), r))
    ]
    return prints.select("print", F.explode(F.array(*keys)).alias("key"))


def _forest(prints: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what links of at most `bits` bits connect."""
    rest = prints
    while len(rest) > 1:
        root, ahead, rest = rest[0], [rest[0]], rest[1:]
        while ahead and len(rest):
            near = np.bitwise_count(rest ^ ahead.pop()) <= bits
            found, rest = rest[near], rest[~near]
            ahead.extend(found)
            yield np.full(len(found), root), found


def _compared(shared: DataFrame, bits: int) -> DataFrame:
    """Edges among fingerprints that share a key."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, dtype=np.uint64)
        for batch in batches:
            edges = [(none, none)]
            for prints in batch.column("prints"):
                edges.extend(_forest(prints.values.to_numpy().view(np.uint64), bits))
            ends = [np.concatenate(side).view(np.int64) for side in zip(*edges)]
            yield pa.RecordBatch.from_arrays([pa.array(e) for e in ends], names=["a", "b"])

    groups = shared.groupBy("key").agg(F.collect_list("print").alias("prints")).select("prints")
    return groups.mapInArrow(each, "a long, b long")


def _meeting(prints: DataFrame, bits: int) -> DataFrame:
    """Edges by shared points, each within half of `bits` bits of a fingerprint.

    For an odd number of bits one side may be a bit further: points within the
    smaller half are offered, points within the larger half are looked up.
    """

    def points(radius: int) -> Column:
        masks = [sum(1 << i for i in chosen) for n in range(radius + 1) for chosen in combinations(range(64), n)]
        signed = F.expr(f"array({','.join(f'{m - (m >> 63 << 64)}L' for m in masks)})")
        return F.transform(signed, lambda m: F.col("print").bitwiseXOR(m))

    near = prints.select("print", F.explode(points(bits // 2)).alias("point"))
    least = near.groupBy("point").agg(F.min("print").alias("a"))
    far = near if bits % 2 == 0 else prints.select("print", F.explode(points(bits - bits // 2)).alias("point"))
    return far.join(least, "point").filter("a <> print").select("a", F.col("print").alias("b")).distinct()


def links(prints: DataFrame, bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that connect the different fingerprints `print` as all links do."""
    r = agreeing(prints.count(), bits)
    keys = _keys(prints, bits, r)
    shared = stored(keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key"))
    crowded = shared.filter(F.col("n") > crowd).select("print").distinct()
    edges = _compared(shared.filter(F.col("n") <= crowd), bits)
    return edges.unionByName(_meeting(crowded, bits))


def near_duplicates(
    docs: DataFrame, words: int = WORDS, bits: int = BITS, crowd: int = CROWD, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, print, root, component_id, and the columns named in `carry`, for each row.

    root is a fingerprint of the component; component_id is the least doc_id of
    all rows that links reach.
    """
    rows = stored(fingerprints(docs, words, carry))
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = components(links(prints.select("print"), bits, crowd))
    rooted = prints.join(roots, prints["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    named = with_least(rooted, "root", "least", "component_id").select("print", "root", "component_id")
    return rows.join(named, "print").select(
        "doc_id", "print", "root", "component_id", *carry
    )


def deduplicated(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row of each component, all columns kept: the row with the least id.

    Rows with the same id are told apart by their text; a row without an id
    stays only if none of its component has one.
    """
    key = row_key("text").alias("row_key")
    found = near_duplicates(docs.select("doc_id", "text", key), words, bits, carry=("row_key",))
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_key")
    kept = found.groupBy("root").agg(F.min(rank).alias("kept")).select("kept.row_key")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("document"), key)
    # the texts are shuffled once, by the one key of the join and of what follows
    return rows.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select("document.*")


def spelled(fingerprint_: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint_), 16, "0"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", spelled(F.col("print")).alias("fingerprint"), "component_id")
