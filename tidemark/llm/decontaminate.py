"""Training passages that leak benchmark items.

The items are indexed by BM25: postings by word, with impacts scaled so that an
item scores 1 against a passage with all of its words. Items are indexed by length,
up to 64 words, 128, and so on. For each index every document is cut into
overlapping passages, twice that long and that far apart, so that each item that
stands in a text stands whole in one passage that is not much longer. Each
passage is a query of its different words, and all items that score THRESHOLD or
more are retrieved:

* A first bound is taken for all passages of a text at once: an item's heaviest
  words are summed where they occur, and what its other words can add is a fixed
  rest of less than half of the threshold. Passages where no item can reach the
  threshold are done.
* The others run block-max WAND: cursors over the words' postings, the pivot by
  the words' largest impacts, and blocks of items skipped by their block maxima.

Each retrieved item is verified: its question and its answer must both reach
OVERLAP, by the share of its word trigrams that stand in the passage or by the
share of its words that stand there in order, in a stretch not much longer than
itself. A changed word takes three trigrams, all that a short answer has, but one
word in order only. The answer is the end of the item, by sentences, at least five
words.

Documents are not shuffled. An index is shipped to the tasks, in blocks of a
bounded number of postings, one pass over the documents for each block; counts of
words over all items are made before. A benchmark of items of up to 64 words with
up to BLOCK postings takes one pass.

Defined results: a null or empty text leaks nothing; an item without words is
never found; repeated items are found each; rows that repeat a document id are
searched each, and give one row an id and item; empty tables give no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

THRESHOLD = 0.6
OVERLAP = 0.6
#: Parameters of BM25, and items to a block of the index.
K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
#: Postings of the index that are shipped at once.
BLOCK = 500_000
GRAM = 3
ANSWER_WORDS = 5
LEAST_STRIDE = 64

words = re.compile(r"\w+").findall
_sentence = re.compile(r"[.!?\n]+")


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words: its last sentences with at least ANSWER_WORDS words are the answer."""
    sentences = [s for s in (words(x) for x in _sentence.split(text.lower())) if s]
    answer: list[str] = []
    while len(sentences) > 1 and len(answer) < ANSWER_WORDS:
        answer = sentences.pop() + answer
    question = [w for s in sentences for w in s]
    if not answer:
        half = (len(question) + 1) // 2
        question, answer = question[:half], question[half:]
    return question, answer


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of a part's trigrams, or of all of a shorter part, that stand in a passage."""
    size = min(GRAM, len(part))
    if not size:
        return 1.0
    grams = {tuple(part[i : i + size]) for i in range(len(part) - size + 1)}
    return len(grams & set(zip(*(passage[i:] for i in range(size))))) / len(grams)


def _most_in_order(places: dict[str, int], size: int, window: list[str]) -> int:
    """Length of the longest common subsequence, by bits: places has each word's places in the part."""
    full = rest = (1 << size) - 1
    for word in window:
        here = rest & places.get(word, 0)
        if here:
            rest = (rest + here | rest - here) & full
    return size - rest.bit_count()


def in_order(part: list[str], passage: list[str]) -> float:
    """The largest share of a part's words that stand in order in a stretch of the passage, a quarter longer than it.

    Parts of 16 words and more are tried at every n-th start, n an eighth of their length, in stretches longer by n:
    each stretch that trying all starts would see lies in one of them, so none is missed.
    """
    size = len(part)
    if not size:
        return 1.0
    places: dict[str, int] = {}
    for n, word in enumerate(part):
        places[word] = places.get(word, 0) | 1 << n
    # of long parts not every start is tried: stretches are that much longer
    step = max(1, size // 8)
    length, best = size + size // 4 + step, 0
    for start in range(0, len(passage), step):
        window = passage[start : start + length]
        if step > 1 or window[0] in places:
            best = max(best, _most_in_order(places, size, window))
            if best == size:
                break
    return best / size


def agreement(part: list[str], passage: list[str], least: float) -> float:
    """By trigrams if that reaches `least`, else the better of trigrams and words in order."""
    share = overlap(part, passage)
    return share if share >= least else max(share, in_order(part, passage))


@dataclass
class Index:
    """BM25 postings of some items. Items are numbered by their place in `ids`."""

    ids: list = field(default_factory=list)
    parts: list = field(default_factory=list)
    term: dict = field(default_factory=dict)
    #: by word: items in order, their impacts, the largest, and the largest by block of items
    postings: list = field(default_factory=list)
    stride: int = LEAST_STRIDE
    threshold: float = THRESHOLD

    def finish(self) -> None:
        """The heavy words of each item as arrays, by word; `rest` is what its others can add."""
        by_item: dict[int, list] = {}
        for t, (items, impacts, _, _) in enumerate(self.postings):
            for i, w in zip(items, impacts):
                by_item.setdefault(i, []).append((w, t))
        heavy: list[list] = [[] for _ in self.postings]
        self.rest = np.zeros(len(self.ids))
        for i, impacts in by_item.items():
            impacts.sort()
            light = np.cumsum([w for w, _ in impacts])
            n = int(np.searchsorted(light, self.threshold / 2))
            self.rest[i] = light[n - 1] if n else 0.0
            for w, t in impacts[n:]:
                heavy[t].append((i, w))
        self.first = np.cumsum([0] + [len(h) for h in heavy])
        self.heavy_items = np.array([i for h in heavy for i, _ in h], dtype=np.int64)
        self.heavy_impacts = np.array([w for h in heavy for _, w in h])
        self.is_heavy = np.append(np.diff(self.first) > 0, False)  # the last is for words not in the index

    def passages(self, n_words: int) -> int:
        return max(1, ceil(n_words / self.stride) - 1)

    def hopeful(self, found: np.ndarray, n_words: int) -> Iterable[int]:
        """Passages in which some item's bound reaches the threshold. found: each word's number, or -1."""
        at = np.nonzero(self.is_heavy[found])[0]
        if not len(at):
            return ()
        step, t = np.divmod(np.unique(at // self.stride * len(self.postings) + found[at]), len(self.postings))
        counts = self.first[t + 1] - self.first[t]
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        place = np.repeat(self.first[t], counts) + offset
        step, item, impact = np.repeat(step, counts), self.heavy_items[place], self.heavy_impacts[place]
        # step s belongs to passages s - 1 and s
        last = self.passages(n_words) - 1
        passage, item, impact = np.concatenate((step - 1, step)), np.tile(item, 2), np.tile(impact, 2)
        inside = (passage >= 0) & (passage <= last)
        keys, where = np.unique(passage[inside] * len(self.ids) + item[inside], return_inverse=True)
        bounds = np.bincount(where, impact[inside], len(keys)) + self.rest[keys % len(self.ids)]
        return np.unique(keys[bounds >= self.threshold - 1e-9] // len(self.ids))

    def retrieve(self, terms: Iterable[int]) -> Iterator[tuple[int, float]]:
        """All items that reach the threshold, by block-max WAND."""
        least = self.threshold - 1e-9
        cursors = [[self.postings[t][0][0], 0, self.postings[t]] for t in terms]
        end = len(self.ids)
        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for n, (item, _, posting) in enumerate(cursors):
                if item >= end:
                    break
                bound += posting[2]
                if bound >= least:
                    pivot = n
                    break
            if pivot < 0:
                return
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK_ITEMS
            if sum(c[2][3].get(block, 0.0) for c in cursors[: pivot + 1]) >= least:
                onward = item
                if cursors[0][0] == item:
                    score = sum(c[2][1][c[1]] for c in cursors[: pivot + 1])
                    if score >= least:
                        yield item, score
                    onward = item + 1
            else:  # no item of the block, before the next cursor, can reach it
                onward = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(cursors):
                    onward = min(onward, cursors[pivot + 1][0])
            for cursor in cursors[: pivot + 1]:
                if cursor[0] < onward:
                    items = cursor[2][0]
                    cursor[1] = bisect_left(items, onward, cursor[1])
                    cursor[0] = items[cursor[1]] if cursor[1] < len(items) else end

    def leaks(self, text: str | None, least_overlap: float) -> Iterator[tuple[int, float, float, float]]:
        """Verified (item, score, question agreement, answer agreement) of each passage."""
        said = words((text or "").lower())
        number = self.term.get
        found = np.array([number(w, -1) for w in said], dtype=np.int64)
        for p in self.hopeful(found, len(said)):
            start, stop = int(p) * self.stride, (int(p) + 2) * self.stride
            terms = np.unique(found[start:stop])
            for item, score in self.retrieve(terms[terms >= 0].tolist()):
                passage = said[start:stop]
                question = agreement(self.parts[item][0], passage, least_overlap)
                if question >= least_overlap:
                    answer = agreement(self.parts[item][1], passage, least_overlap)
                    if answer >= least_overlap:
                        yield item, score, question, answer


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item, (text,) in enumerate(zip(batch.column("text").to_pylist())):
            counts = Counter(words((text or "").lower()))
            rows += [(batch.column("item")[item].as_py(), w, n, sum(counts.values())) for w, n in counts.items()]
        columns = list(zip(*rows)) or [[]] * 4
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["item", "word", "tf", "size"]
        )


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> Iterator[Index]:
    """The items' indexes, by length and in blocks of about `block` postings at most.

    Every block has the word counts of all items.
    """
    items = stored(
        benchmark.select("item_id", "text", F.monotonically_increasing_id().alias("item"))
    )
    counted = stored(items.select("item", "text").mapInArrow(_counted, "item long, word string, tf long, size long"))
    stride = F.greatest(F.lit(LEAST_STRIDE), F.pow(F.lit(2), F.ceil(F.log2("size"))).cast("long"))
    of_items = counted.groupBy("item").agg(F.first("size").alias("size"), F.count("*").alias("postings"))
    lengths = of_items.groupBy(stride.alias("stride")).agg(
        F.count("*").alias("items"), F.sum("size").alias("words"), F.sum("postings").alias("postings")
    )
    classes = sorted(lengths.collect())  # one row for each doubling of the length
    n_items, n_words = (sum(c[k] for c in classes) for k in ("items", "words"))
    known = counted.withColumn("stride", stride).join(counted.groupBy("word").agg(F.count("*").alias("df")), "word")
    for c in classes:
        n_blocks = ceil(c.postings / block)
        part = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
        for b in range(n_blocks):
            chosen = known.filter((F.col("stride") == c.stride) & (part == b))
            rows, texts = chosen.collect(), items.filter(part == b).join(chosen.select("item").distinct(), "item")
            yield _index(rows, texts.collect(), n_items, n_words, c.stride, threshold)


def _index(rows: list, items: list, n_items: int, n_words: int, stride: int, threshold: float) -> Index:
    index = Index(threshold=threshold, stride=stride)
    of_item: dict[int, list] = {}
    for row in rows:
        idf = log(1 + (n_items - row.df + 0.5) / (row.df + 0.5))
        norm = K1 * (1 - B + B * row.size * n_items / n_words)
        of_item.setdefault(row.item, []).append((row.word, idf * row.tf * (K1 + 1) / (row.tf + norm)))
    texts = {row.item: row for row in items}
    # items of like sizes share blocks, which makes the block maxima tight
    by_word: dict[str, list] = {}
    for item in sorted(of_item, key=lambda i: (len(of_item[i]), i)):
        number, whole = len(index.ids), sum(w for _, w in of_item[item])
        index.ids.append(texts[item].item_id)
        index.parts.append(question_and_answer(texts[item].text))
        for word, impact in of_item[item]:
            by_word.setdefault(word, []).append((number, impact / whole))
    for word in sorted(by_word):
        index.term[word] = len(index.postings)
        numbers, impacts = zip(*by_word[word])
        blocks: dict[int, float] = {}
        for n, w in by_word[word]:
            blocks[n // BLOCK_ITEMS] = max(w, blocks.get(n // BLOCK_ITEMS, 0.0))
        index.postings.append((numbers, impacts, max(impacts), blocks))
    index.finish()
    return index


def _search(index: Index, least_overlap: float) -> Callable:
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column("doc_id")
            for n, text in enumerate(batch.column("text")):
                best: dict[int, tuple] = {}
                for item, *scores in index.leaks(text.as_py(), least_overlap):
                    best[item] = max(best.get(item, ()), tuple(scores))
                rows += [(ids[n].as_py(), index.ids[item], *scores) for item, scores in best.items()]
            columns = list(zip(*rows)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )

    return each


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least_overlap: float = OVERLAP, block: int = BLOCK
) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: the best passage for each leaked item.

    What a block of the index finds is written before the next block is built, so
    that the driver holds one block, however large the benchmark is.
    """
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    texts = docs.select("doc_id", "text")
    found = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, threshold, block):
        found = found.unionByName(stored(texts.mapInArrow(_search(index, least_overlap), schema)))
    scores = F.struct("score", "question_overlap", "answer_overlap")
    return found.groupBy("doc_id", "item_id").agg(F.max(scores).alias("best")).select("doc_id", "item_id", "best.*")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least_overlap: float = OVERLAP, block: int = BLOCK
) -> DataFrame:
    """The rows that leak no item, all columns kept."""

    def clean(index: Index) -> Callable:
        @F.arrow_udf("boolean")
        def leaks_nothing(texts: pa.Array) -> pa.Array:
            found = (next(index.leaks(text.as_py(), least_overlap), None) for text in texts)
            return pa.array([leak is None for leak in found], pa.bool_())

        return leaks_nothing

    for index in indexes(benchmark, threshold, block):
        docs = docs.filter(clean(index)("text"))
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the items."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
