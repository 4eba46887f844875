"""Repeated passages by suffix trees that are partitioned by prefix.

A passage repeats if `depth` words in a row occur somewhere else; every later
occurrence goes, word by word. What counts are the inner nodes of a suffix tree
over words, at a depth of `depth` words or more: the leaves below such a node are
the places where the same words stand.

No task holds that tree. Suffixes are split by their prefixes, and a prefix that
too many of them share is prolonged: two words, then four, then PREFIX, so that a
group of suffixes fits into memory (GROUP). Each group gives a subtree: its
suffixes are sorted, the lengths of the prefixes that neighbours share show the
inner nodes, and below each deep one all leaves but the earliest repeat.

The tree is sparse. Of each window of `depth` words one suffix is taken to a group,
the one whose first PREFIX words have the least digest among those that begin with
PREFIX words inside the window; windows with the same words agree on it, so they
meet. It brings the words on its left that its windows need. Windows next to each
other share suffixes: there is one for about eight words. If more than GROUP
suffixes share all PREFIX words, each of their windows goes alone, by all of its
words, and a task sends the earliest of equal ones only. So a passage that stands
in a third of all documents comes in as many times as there are tasks.

The words of the suffixes travel once, and the texts once, to meet what is removed
from them, both compressed. Words are told apart by 64-bit digests.

Defined results: a null text has no words; a document with fewer than `depth`
words keeps them. Windows stand in the order of ids, null ones last, then of
starts. Rows that share an id are one document in that order: equal windows at
equal starts of such rows do not remove each other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, stored, table

DEPTH = 20
#: Words by which suffixes are split, at most; shorter prefixes are tried first.
PREFIX = 6
SHORTER = (2, 4)
#: Suffixes in a group on average, and the number of prefixes that may be prolonged, at most.
GROUP, PROLONGED = 1 << 16, 1 << 20
#: Suffixes that a task packs, and prefixes that it counts, at a time.
PACKED, COUNTED = 1 << 18, 1 << 21
#: Bytes of a text that are looked at together.
_PIECE = 1 << 20

_rng = np.random.default_rng(20)
_LETTER = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=2)
def _powers(base: np.uint64, size: int) -> np.ndarray:
    powers = np.full(size + 1, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests of the words."""
    found, at = [], 0
    while at < len(data):
        end = at + _PIECE
        if end < len(data):  # up to the next blank
            blanks = (data.find(c, end) for c in b" \n\t\r\x0b\x0c")
            end = min((b for b in blanks if b >= 0), default=len(data))
        found.append(_words_of_piece(data[at:end], at))
        at = end
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    return tuple(np.concatenate(part) for part in zip(*found))


def _words_of_piece(data: bytes, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    letters = np.frombuffer(data, dtype=np.uint8)
    blank = np.concatenate(([True], _BLANK[letters], [True]))
    edges = np.nonzero(blank[1:] != blank[:-1])[0]
    starts, ends = edges[::2], edges[1::2]
    size = max(_PIECE, len(letters))
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[letters] * _powers(_BASE, size)[: len(letters)], out=sums[1:])
    digests = _mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, size)[starts])
    return starts + offset, ends + offset, digests


def gram_digests(words: np.ndarray, size: int) -> np.ndarray:
    """The digest of each `size` words in a row."""
    count = max(0, len(words) - size + 1)
    total = np.zeros(count, dtype=np.uint64)
    for n in range(size):
        total += words[n : n + count] * _PLACE[n]
    return _mixed(total)


def anchors(words: np.ndarray, depth: int, prefix: int) -> np.ndarray:
    """For each window of `depth` words the place of its suffix: the first with the least digest."""
    least = gram_digests(words, prefix)
    place = np.arange(len(least))
    span, wanted = 1, depth - prefix + 1
    while span < wanted:  # the least of `span` neighbours to the least of `more`
        step = min(span, wanted - span)
        left = least[:-step] <= least[step:]
        place = np.where(left, place[:-step], place[step:])
        least = np.where(left, least[:-step], least[step:])
        span += step
    return place


class Suffixes:
    """A text's words, and the suffixes taken from it: place, first and last window of each."""

    def __init__(self, data: bytes, depth: int, prefix: int):
        self.starts, self.ends, self.words = words_of(data)
        place = anchors(self.words, depth, prefix) if len(self.words) >= depth else np.empty(0, dtype=np.int64)
        new = np.nonzero(np.concatenate(([True], place[1:] != place[:-1])))[0] if len(place) else place
        self.place = place[new]
        self.first = new
        self.last = np.concatenate((new[1:], [len(place)])) - 1 if len(new) else new

    def prefixes(self, size: int) -> np.ndarray:
        return gram_digests(self.words, size)[self.place]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values if len(known) else np.zeros(len(values), dtype=bool)


def shared_prefixes(docs: DataFrame, depth: int, prefix: int) -> tuple[int, dict[int, np.ndarray]]:
    """The number of suffixes, and by length the digests of prefixes that more than a group's worth of them share.

    Tasks tell of prefixes that are frequent with them, those below a task's share
    of half a group left out: a group can be larger by that half. No more than
    PROLONGED prefixes of a length can exceed a group.
    """
    sizes = [*[s for s in SHORTER if s < prefix], prefix]
    tasks = max(1, docs.rdd.getNumPartitions())
    least = max(2, GROUP // (2 * tasks))

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting = 0, []
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                suffixes = Suffixes(text or b"", depth, prefix)
                if not len(suffixes.place):
                    continue
                waiting.append([suffixes.prefixes(size) for size in sizes])
                total += len(suffixes.place)
                if total >= COUNTED:
                    yield _frequent(waiting, sizes, least)
                    total, waiting = 0, []
        if total:
            yield _frequent(waiting, sizes, least)

    parts = docs.select("text").mapInArrow(counted, "size int, digest long, n long")
    counts = stored(parts.groupBy("size", "digest").agg(F.sum("n").alias("n")))
    (total,) = counts.filter("size = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()
    found = counts.filter((F.col("size") > 0) & (F.col("n") > max(GROUP, total // PROLONGED))).toArrow()
    size, digest = (found.column(c).to_numpy() for c in ("size", "digest"))
    return int(total), {s: np.sort(digest[size == s].astype(np.int64).view(np.uint64)) for s in sizes}


def _frequent(waiting: list[list[np.ndarray]], sizes: list[int], least: int) -> pa.RecordBatch:
    """size, digest, n of the frequent prefixes; size 0 is the number of all."""
    rows = [(np.zeros(1, dtype=np.int32), np.zeros(1, dtype=np.int64), np.array([sum(len(w[0]) for w in waiting)]))]
    for size, digests in zip(sizes, zip(*waiting)):
        values, n = np.unique(np.concatenate(digests), return_counts=True)
        often = n >= least
        rows.append((np.full(often.sum(), size, dtype=np.int32), values[often].view(np.int64), n[often]))
    columns = [np.concatenate(part) for part in zip(*rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["size", "digest", "n"]
    )


# Of each suffix that travels: words before its prefix, windows, bytes, word number of its first window, and its row.
_FIELDS = [("lead", "u1"), ("windows", "u1"), ("size", "u4"), ("start", "u4"), ("no_id", "u1"), ("doc_id", "i8"), ("text_hash", "i8")]
_RANGES = "doc_id long, text_hash long, begins array<int>, ends array<int>"
_PACK = f"group_of long, n int, about binary, words binary, {_RANGES}"
_KINDS = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
_NAMES = ["doc_id", "text_hash", "begins", "ends"]


class Packer:
    """Suffixes with their words, packed by group; and what is known to repeat within the task."""

    def __init__(self, depth: int, prefix: int, groups: int, shared: dict[int, np.ndarray]):
        self.depth, self.prefix, self.groups, self.shared = depth, prefix, groups, shared
        self.clear()

    def clear(self) -> None:
        self.columns: dict[str, list] = {name: [] for name, _ in [*_FIELDS, ("group_of", "i8")]}
        self.segments: list[bytes] = []
        self.alone: dict[bytes, tuple] = {}
        self.repeats: list[tuple] = []

    def __len__(self) -> int:
        return len(self.segments) + len(self.alone) + len(self.repeats)

    def add(self, data: bytes, doc_id: int | None, text_hash: int) -> None:
        found = Suffixes(data, self.depth, self.prefix)
        if not len(found.place):
            return
        group = np.zeros(len(found.place), dtype=np.uint64)
        undecided = np.ones(len(group), dtype=bool)
        for size, known in self.shared.items():  # by the shortest prefix that few share
            digests = found.prefixes(size)
            few = undecided & ~_among(digests, known)
            group[few] = digests[few]
            undecided &= ~few
        row = {"no_id": doc_id is None, "doc_id": doc_id or 0, "text_hash": text_hash}
        together = np.nonzero(~undecided)[0]
        first, last = found.first[together], found.last[together]
        begin, end = found.starts[first], found.ends[last + self.depth - 1]
        self.segments += [data[b:e] for b, e in zip(begin.tolist(), end.tolist())]
        self._add(
            {"lead": found.place[together] - first, "windows": last - first + 1, "size": end - begin, "start": first},
            row,
            group[together],
        )
        if undecided.any():
            order = (doc_id is None, doc_id or 0)
            whole = gram_digests(found.words, self.depth)
            for n in np.nonzero(undecided)[0].tolist():
                for start in range(found.first[n], found.last[n] + 1):
                    begin, end = int(found.starts[start]), int(found.ends[start + self.depth - 1])
                    words = b" ".join(data[begin:end].split())
                    self._alone(words, (*order, start), text_hash, int(found.place[n] - start), int(whole[start]))

    def _add(self, columns: dict, row: dict, group: np.ndarray) -> None:
        for name, values in columns.items():
            self.columns[name].append(values)
        for name, value in row.items():
            self.columns[name].append(np.full(len(group), value, dtype=np.int64))
        self.columns["group_of"].append((group % np.uint64(self.groups)).astype(np.int64))

    def _alone(self, words: bytes, order: tuple, text_hash: int, lead: int, digest: int) -> None:
        """A window by itself: the earliest of the task's equal ones stays, and those at the same place."""
        known = self.alone.get(words)
        if known is None or order < known[0]:
            if known is not None:
                self.repeats += [(known[0], h) for h in known[1]]
            self.alone[words] = (order, {text_hash}, lead, digest)
        elif order == known[0]:
            known[1].add(text_hash)
        else:
            self.repeats.append((order, text_hash))

    def packed(self) -> Iterator[pa.RecordBatch]:
        """A row for each group, and one for each document with repeats."""
        for words, ((no_id, doc_id, start), hashes, lead, digest) in self.alone.items():
            for text_hash in hashes:
                self.segments.append(words)
                one = {"lead": lead, "windows": 1, "size": len(words), "start": start}
                row = {"no_id": no_id, "doc_id": doc_id, "text_hash": text_hash}
                self._add({c: np.array([v]) for c, v in one.items()}, row, np.array([digest], dtype=np.uint64))
        columns = {name: np.concatenate(parts) for name, parts in self.columns.items() if parts}
        rows = []
        if self.segments:
            order = np.argsort(columns["group_of"], kind="stable")
            group = columns["group_of"][order]
            cuts = np.nonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))[0]
            press = zstandard.ZstdCompressor(level=3)
            sorted_columns = [columns[name][order].astype(kind) for name, kind in _FIELDS]
            segments = [self.segments[n] for n in order.tolist()]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                about = b"".join(_by_bytes(c[a:b]) for c in sorted_columns)
                rows.append((int(group[a]), b - a, press.compress(about), press.compress(b" ".join(segments[a:b])), *[None] * 4))
        if self.repeats:
            places, hashes = zip(*self.repeats)
            known = _ranges(*(np.array(c, dtype=np.int64) for c in (*zip(*places), hashes)), self.depth)
            listed = zip(*(known.column(c).to_pylist() for c in _NAMES))
            rows += [(-1 - n % self.groups, 0, None, None, *r) for n, r in enumerate(listed)]
        self.clear()
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), *_KINDS]
        names = ["group_of", "n", "about", "words", *_NAMES]
        for n in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[n : n + 256]), kinds)], names=names)


def _by_bytes(values: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on, which compresses better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_bytes(data: bytes, n: int) -> dict[str, np.ndarray]:
    columns, at = {}, 0
    for name, kind in _FIELDS:
        width = np.dtype(kind).itemsize
        part = np.frombuffer(data, dtype=np.uint8, count=n * width, offset=at).reshape(width, n)
        columns[name] = np.ascontiguousarray(part.T).view(kind).ravel()
        at += n * width
    return columns


def _ranges(no_id: np.ndarray, doc_id: np.ndarray, start: np.ndarray, text_hash: np.ndarray, depth: int) -> pa.RecordBatch:
    """A row for each document, with the ranges of words that its windows of `depth` words cover.

    Windows next to each other are one range.
    """
    order = np.lexsort((start, text_hash, doc_id, no_id))
    no_id, doc_id, start, text_hash = (x[order].astype(np.int64) for x in (no_id, doc_id, start, text_hash))

    def breaks(changes: np.ndarray) -> np.ndarray:
        return np.concatenate(([True], changes))[: len(start)]

    other = breaks((text_hash[1:] != text_hash[:-1]) | (doc_id[1:] != doc_id[:-1]) | (no_id[1:] != no_id[:-1]))
    new = np.nonzero(other | breaks(start[1:] != start[:-1] + 1))[0]
    row = np.nonzero(other)[0]
    begins = pa.array(start[new], pa.int32())
    ends = pa.array(start[np.concatenate((new[1:], [len(start)])) - 1] + depth if len(new) else start, pa.int32())
    offsets = pa.array(np.searchsorted(new, np.concatenate((row, [len(start)]))), pa.int32())
    columns = [
        pa.array(doc_id[row], pa.int64(), mask=no_id[row] > 0),
        pa.array(text_hash[row], pa.int64()),
        pa.ListArray.from_arrays(offsets, begins),
        pa.ListArray.from_arrays(offsets, ends),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def deep_nodes(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves in the tree's order, and for each of them the number of the deep node above it.

    suffixes: a row for each, its words as small numbers, cut off at the depth that
    counts. Neighbours in the order that share all of it are below the same node.
    """
    count, depth = suffixes.shape
    if not count:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    keys = np.ascontiguousarray(suffixes.astype(">u4")).view(f"S{4 * depth}").ravel()
    order = np.argsort(keys, kind="stable")
    differs = suffixes[order[1:]] != suffixes[order[:-1]]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
    return order, np.concatenate(([0], np.cumsum(common < depth)))


def repeats_in_group(packs: list[tuple[int, bytes, bytes]], depth: int, prefix: int) -> pa.RecordBatch:
    """What the windows of a group's suffixes cover whose words stand earlier too; see `_ranges`."""
    press = zstandard.ZstdDecompressor()
    parts = [_from_bytes(press.decompress(about), n) for n, about, _ in packs]
    of = {name: np.concatenate([p[name] for p in parts]) for name, _ in _FIELDS}
    _, _, words = words_of(b" ".join(press.decompress(text) for _, _, text in packs))
    windows = of["windows"].astype(np.int64)
    ends = np.cumsum(windows + depth - 1)
    begins = ends - (windows + depth - 1)
    # a suffix that shares its prefix with no other one is a leaf that hangs above any deep node
    _, which, n = np.unique(gram_digests(words, prefix)[begins + of["lead"]], return_inverse=True, return_counts=True)
    met = np.nonzero(n[which] > 1)[0]
    row = np.repeat(met, windows[met])
    before = np.cumsum(windows[met]) - windows[met]
    within = np.arange(len(row)) - np.repeat(before, windows[met])
    sizes = windows[met] + depth - 1  # in words; only theirs are numbered
    moved = np.cumsum(sizes) - sizes
    _, small = np.unique(words[np.arange(sizes.sum()) + np.repeat(begins[met] - moved, sizes)], return_inverse=True)
    at = np.repeat(moved, windows[met]) + within
    order, node = deep_nodes((small.astype(np.uint32) + 1)[at.astype(np.int32)[:, None] + np.arange(depth, dtype=np.int32)])
    row, start = row[order], (of["start"][row] + within)[order]
    no_id, doc_id, text_hash = (of[c][row] for c in ("no_id", "doc_id", "text_hash"))
    by_place = np.lexsort((start, doc_id, no_id, node))
    node, start, no_id, doc_id, text_hash = (x[by_place] for x in (node, start, no_id, doc_id, text_hash))
    first = np.concatenate(([True], node[1:] != node[:-1]))
    earliest = np.maximum.accumulate(np.where(first, np.arange(len(node)), 0))
    later = (start != start[earliest]) | (doc_id != doc_id[earliest]) | (no_id != no_id[earliest])
    return _ranges(*(x[later] for x in (no_id, doc_id, start, text_hash)), depth)


def repeated_windows(docs: DataFrame, depth: int = DEPTH, prefix: int = PREFIX) -> DataFrame:
    """doc_id, text_hash, begins, ends: the words covered by windows whose words also start earlier.

    docs: doc_id, text. A document has several rows here, or none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    total, shared = shared_prefixes(docs, depth, prefix)
    groups = max(1, ceil(total / GROUP))

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(depth, prefix, groups, shared)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            about = zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist())
            for text, (doc_id, text_hash) in zip(texts, about):
                packer.add(text.as_py() or b"", doc_id, text_hash)
                if len(packer) >= PACKED:
                    yield from packer.packed()
        yield from packer.packed()

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packs = None, []
        for batch in batches:
            known = batch.filter(pa.compute.less(batch.column("group_of"), 0))
            if len(known):
                yield known.select(_NAMES)
            rest = batch.filter(pa.compute.greater_equal(batch.column("group_of"), 0))
            columns = (rest.column(c).to_pylist() for c in ("group_of", "n", "about", "words"))
            for g, *pack in zip(*columns):
                if g != group and packs:
                    yield repeats_in_group(packs, depth, prefix)
                    packs = []
                group = g
                packs.append(tuple(pack))
        if packs:
            yield repeats_in_group(packs, depth, prefix)

    dealt = rows.mapInArrow(packed, _PACK).repartition("group_of").sortWithinPartitions("group_of")
    return dealt.mapInArrow(searched, _RANGES)


def covered(n_words: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words the ranges cover."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def _pressed(docs: DataFrame) -> DataFrame:
    """doc_id, row and the compressed text, for the way to what is removed from it."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [press.compress(text.as_py() or b"") for text in batch.column("text").cast(pa.binary())]
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", row_key("text"))
    return rows.mapInArrow(each, "doc_id long, row string, text binary")


def without_repeats(docs: DataFrame, depth: int = DEPTH, prefix: int = PREFIX) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) and
    removed (the passages that go: start and end in words) of every document."""
    windows = repeated_windows(docs, depth, prefix)
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_hash").cast("string"))
    gathered = [F.flatten(F.collect_list(c)).alias(c) for c in ("begins", "ends")]
    windows = windows.groupBy(row.alias("row")).agg(*gathered)
    joined = _pressed(docs).join(windows, "row", "left").select("doc_id", "text", "begins", "ends")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for text, begins, ends in zip(*(batch.column(c) for c in ("text", "begins", "ends"))):
                words, kept, spans = press.decompress(text.as_py()).split(), None, []
                if begins.is_valid:
                    gone = covered(len(words), begins.values.to_numpy(), ends.values.to_numpy())
                    edges = np.nonzero(np.diff(np.concatenate(([0], gone, [0]))))[0].tolist()
                    spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
                    kept = [words[n] for n in np.nonzero(~gone)[0].tolist()]
                kept = words if kept is None else kept
                rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode(), spans))
            columns = list(zip(*rows)) or [[]] * 4
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), pa.string(), span)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_words", "n_removed", "kept", "removed"],
            )

    schema = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:int,end:int>>"
    return joined.mapInArrow(cut, schema)


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that stand earlier in the corpus."""
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER
    (PARTITION BY array_to_string(w[s:s + 19], ' ') ORDER BY doc_id, s) AS n FROM placed) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS place FROM later),
kept AS (SELECT k.doc_id, count(*) AS n, string_agg(k.word, ' ' ORDER BY k.place) AS text FROM
    (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words) k
    ANTI JOIN gone g ON g.doc_id = k.doc_id AND g.place = k.place GROUP BY 1)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""
