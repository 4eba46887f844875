"""Alignment of two tokenizers' tokens by the bytes that they cover.

Tokenizer A is a byte-level BPE read from its JSON file, B a SentencePiece model.
Both cut the same bytes, a space and the text, into tokens. All tokens of a text
are sorted by start and, where two start together, the longer first; the running
maximum of their ends shows where the text falls apart: a group of tokens ends
where the next start reaches that maximum. Within a group, the tokens of B that a
token of A overlaps follow each other, so its links are a range of B's tokens.

How many documents hold a pair of ids linked is counted over the whole corpus.
Texts are tokenised once; what is kept of each is its different pairs, as one
number each, and how often they are linked. Every task adds up its documents'
pairs before they are shuffled. The counts, no more than there are pairs of
tokens in the two vocabularies, then meet the documents' pairs: up to SHARED
pairs are handed to all tasks, beyond that both sides are joined by pair.

Defined results: a text that is null, empty or not spelled out by the joined
bytes of either tokenizer (SentencePiece may normalise it) has no tokens, zeros
and the empty string instead of a digest. Special tokens' strings are ordinary
text. Rows that repeat are documents each, with or without an id. An empty table
gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

#: Where the tokenizers' files lie on the driver.
FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Fixed value: how byte-level BPE splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pairs whose counts are handed to every task, at 16 bytes each.
SHARED = 4_000_000
#: Pairs that a task collects before it adds them up.
COLLECTED = 2_000_000
#: A pair is id A times this plus id B.
BASE = 1 << 31

_ROW = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
_TYPES = [
    ("row", pa.int64()),
    ("doc_id", pa.int64()),
    ("n_a", pa.int64()),
    ("n_b", pa.int64()),
    ("n_groups", pa.int64()),
    ("n_links", pa.int64()),
    ("groups_sha256", pa.string()),
    ("pairs", pa.list_(pa.int64())),
    ("times", pa.list_(pa.int32())),
]


def _byte_of_letter() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves, the others as letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + n): b for n, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, from their files' bytes: token ids of texts, and how many bytes each id covers."""

    def __init__(self, file_a: bytes, file_b: bytes):
        described = json.loads(file_a)
        special = {token["content"] for token in described["added_tokens"] if token["special"]}
        letters = _byte_of_letter()
        self.bytes_a = {
            n: bytes(letters[c] for c in token) for token, n in described["model"]["vocab"].items() if token not in special
        }
        self.a = tiktoken.Encoding(
            "a", pat_str=PATTERN, mergeable_ranks={b: n for n, b in self.bytes_a.items()}, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        self.bytes_b = {n: self._piece(n) for n in range(self.b.get_piece_size())}
        self.sizes_a, self.sizes_b = _sizes(self.bytes_a), _sizes(self.bytes_b)
        self.said_a, self.said_b = _said(len(self.sizes_a), "|"), _said(len(self.sizes_b), ";")

    def _piece(self, n: int) -> bytes:
        if self.b.is_byte(n):
            return bytes([int(self.b.id_to_piece(n)[1:-1], 16)])
        return self.b.id_to_piece(n).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """For each text A's and B's ids, or None where either does not spell out the text."""
        for text, pieces in zip(texts, self.b.encode(texts, num_threads=1)):
            whole = b" " + text.encode()
            ids = self.a.encode_ordinary(" " + text) if text else []
            spelled = (
                bool(text)
                and self.a.decode_bytes(ids) == whole
                and b"".join(map(self.bytes_b.__getitem__, pieces)) == whole
            )
            yield (np.array(ids, dtype=np.int64), np.array(pieces, dtype=np.int64)) if spelled else None


def _sizes(spelled: dict[int, bytes]) -> np.ndarray:
    sizes = np.zeros(max(spelled) + 1, dtype=np.int64)
    for n, token in spelled.items():
        sizes[n] = len(token)
    return sizes


@lru_cache(maxsize=1)
def _loaded(file_a: bytes, file_b: bytes) -> Tokenizers:
    return Tokenizers(file_a, file_b)


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B the number of its group, from the tokens' ends."""
    n = len(ends_a)
    ends = np.concatenate((ends_a, ends_b))
    starts = np.concatenate(([0], ends_a[:-1], [0], ends_b[:-1])) if n else ends[:0]
    order = np.lexsort((-ends, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(ends), dtype=np.int64)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty_like(breaks)
    group[order] = np.cumsum(breaks)
    return group[:n], group[n:]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a token of A and one of B whose bytes overlap, by A's order."""
    starts_a = np.concatenate(([0], ends_a[:-1])) if len(ends_a) else ends_a
    starts_b = np.concatenate(([0], ends_b[:-1])) if len(ends_b) else ends_b
    first = np.searchsorted(ends_b, starts_a, side="right")  # the first that ends behind the start
    count = np.searchsorted(starts_b, ends_a, side="left") - first
    before = np.cumsum(count) - count
    return np.repeat(np.arange(len(ends_a)), count), np.arange(count.sum()) - np.repeat(before - first, count)


def spelled_groups(
    a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, said_a: np.ndarray, said_b: np.ndarray
) -> str:
    """Ids by group: `a1,a2|b1;a3|b2,b3`. See `_said` for the last two."""
    if not len(a):
        return ""
    last_a, last_b = (np.concatenate((g[1:] != g[:-1], [True])).astype(np.int64) for g in (group_a, group_b))
    out = np.empty(len(a) + len(b), dtype=object)
    # behind a token of A stand B's tokens of earlier groups, behind one of B also A's of the same group
    out[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = said_a[last_a, a]
    out[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = said_b[last_b, b]
    return "".join(out.tolist())[:-1]


def _said(count: int, end: str) -> np.ndarray:
    """Ids as text, with what follows them: a comma inside a group, `end` behind its last."""
    return np.array([[f"{n}{mark}" for n in range(count)] for mark in (",", end)], dtype=object)


def _aligned(tokenizers: Tokenizers, text: str, tokens: tuple[np.ndarray, np.ndarray] | None) -> tuple:
    """n_a, n_b, n_groups, n_links, groups_sha256, pairs, times"""
    if tokens is None:
        return 0, 0, 0, 0, "", (), ()
    a, b = tokens
    ends_a, ends_b = np.cumsum(tokenizers.sizes_a[a]), np.cumsum(tokenizers.sizes_b[b])
    group_a, group_b = groups(ends_a, ends_b)
    at_a, at_b = links(ends_a, ends_b)
    pairs, times = np.unique(a[at_a] * BASE + b[at_b], return_counts=True)
    said = spelled_groups(a, b, group_a, group_b, tokenizers.said_a, tokenizers.said_b)
    digest = sha256(said.encode()).hexdigest()
    return len(a), len(b), int(group_a[-1]) + 1, len(at_a), digest, pairs, times.astype(np.int32)


def aligned(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """row (a number told to each row), doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the
    document's different linked pairs in order (id A x BASE + id B) with how often each is linked.

    docs: doc_id, text.
    """
    files = [Path(folder, name).read_bytes() for name in (FILE_A, FILE_B)]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _loaded(*files)
        for whole in batches:
            for start in range(0, len(whole), 64):  # few texts' tokens at a time
                batch = whole.slice(start, 64)
                texts = [text or "" for text in batch.column("text").to_pylist()]
                rows = [_aligned(tokenizers, text, tokens) for text, tokens in zip(texts, tokenizers.encode(texts))]
                columns = [batch.column("row"), batch.column("doc_id")]
                columns += [pa.array(c, t) for c, (_, t) in zip(zip(*rows), _TYPES[2:])]
                yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in _TYPES])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(each, _ROW)


def pair_counts(documents: DataFrame) -> DataFrame:
    """pair, id_a, n (documents that hold it linked) and best (whether no pair of that id of A is held by more)."""

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch.column("pairs").flatten().to_numpy(zero_copy_only=False))
            size += len(waiting[-1])
            if size > COLLECTED:
                yield _counted(waiting)
                waiting, size = [], 0
        if size:
            yield _counted(waiting)

    counts = documents.select("pairs").mapInArrow(added, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("id_a", F.floor(F.col("pair") / BASE)))
    # one row for each id of A leaves every task
    highest = counts.groupBy("id_a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "id_a").select("pair", "id_a", "n", (F.col("n") == F.col("highest")).alias("best"))


def _counted(waiting: list[np.ndarray]) -> pa.RecordBatch:
    pairs, n = np.unique(np.concatenate(waiting), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])


_SUMS = "row long, n_best long, count_sum long"


def _sums_by_lookup(documents: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums over each document's links, with all counts at hand in every task."""
    listed = counts.select("pair", "n", "best").toArrow()
    pairs = listed.column("pair").to_numpy()
    order = np.argsort(pairs)
    held = [listed.column(c).to_numpy()[order] for c in ("n", "best")]
    shared = documents.sparkSession.sparkContext.broadcast((pairs[order], *held))

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            found = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(known, found)
            sizes = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            sums = []
            for value in (times * best[at], times * n[at]):
                total = np.concatenate(([0], np.cumsum(value)))
                sums.append(pa.array(total[ends] - total[ends - sizes], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *sums], names=["row", "n_best", "count_sum"])

    return documents.select("row", "pairs", "times").mapInArrow(each, _SUMS)


def _sums_by_join(documents: DataFrame, counts: DataFrame) -> DataFrame:
    """The same where the counts are too many for one task: each pair of each document meets its count."""
    held = documents.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("held"))
    held = held.select("row", F.col("held.pairs").alias("pair"), F.col("held.times").cast("long").alias("times"))
    met = held.join(counts.select("pair", "n", "best"), "pair")
    return met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )


def alignment(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """One row for each document: its tokens, groups and links, and the sums over its links of how widely each pair is held."""
    documents = stored(aligned(docs, folder))
    counts = stored(pair_counts(documents))
    few = counts.count() <= SHARED
    sums = (_sums_by_lookup if few else _sums_by_join)(documents, counts)
    columns = documents.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    joined = columns.join(sums, "row", "left")
    return joined.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256",
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers over every document, aligned."""
    return alignment(table(spark, sf_dir, "documents").select("doc_id", "text"))
