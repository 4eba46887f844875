"""Language of a text by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. Three
letters in a row are bound into one vector: the first letter's, rotated by two
places, times the second's, rotated by one, times the third's. A text's profile
is the sum (the bundle) of the vectors of all its trigrams; a language's
prototype is the sum of its training texts' profiles at unit length. A text gets
the language whose prototype has the largest cosine with its profile, and that
cosine (0 at least) as its score.

Letters are lower-cased; everything else, in any amount, is one blank, also at
both ends.

Texts are never shuffled. Prototypes learn from at most TRAIN_DOCS texts of each
language, chosen by a hash of id and text among those that are not held out; that
bound keeps training small. Prediction reads every whole text.

Recognition rejects texts that are in no learned language. A cosine alone does not
tell that: it falls with the length of a text and with its distance from the prose
that was learned. So the share of a text's different trigrams that are common in a
language, each at least one in RARE of that language's, is added to the cosine: a
text needs LIKE of both together. Prose of a learned language that is unlike the
learned prose has half of that share at least, random letters and languages of
other families a fifth. A near relation of a learned language may pass as it.

Defined results: `und` with score 0 for a text that is null or has no letter,
and for all texts if nothing was learned; equal cosines go to the first language
by name; a null language is not learned; a null id is not held out, and not
learned from; rows that repeat an id are predicted each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import share_of_rows, stored, table

DIMENSIONS = 1024
SEED = 7
TRAIN_DOCS = 2000
UNKNOWN = "und"
#: Cosine and share of common trigrams that a text of a learned language has together.
LIKE = 0.45
#: A trigram is common if it is one in so many of its language's, or more.
RARE = 50_000
#: Trigram vectors that a task keeps at hand, a byte for each dimension.
KEPT = 1 << 15
#: Trigrams of a text that are bundled at a time.
RUN = 512
_BLANK = 32
_BITS = 21  # of a code point


@cache
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or the blank."""
    letters = (ord(chr(c).lower()[0]) if chr(c).isalpha() else _BLANK for c in range(0x110000))
    return np.fromiter(letters, dtype=np.int32, count=0x110000)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The different trigrams of a text, each as one number, and how often each occurs."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    points = np.concatenate(([_BLANK], points, [_BLANK])).astype(np.int64, copy=False)
    blank = points == _BLANK
    points = points[~(blank & np.concatenate(([False], blank[:-1])))]
    if len(points) < 3:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.unique((points[:-2] << 2 * _BITS) | (points[1:-1] << _BITS) | points[2:], return_counts=True)


class Encoder:
    """Profiles of texts. Keeps the vectors of the trigrams seen, up to KEPT."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.letter: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.known = np.empty(0, dtype=np.int64)  # sorted
        self.row = np.empty(0, dtype=np.int64)
        self.vectors = np.empty((256, self.dimensions), dtype=np.int8)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letter:
            bits = np.random.default_rng([SEED, point]).integers(0, 2, self.dimensions)
            self.letter[point] = (2 * bits - 1).astype(np.int8)
        return self.letter[point]

    def _bound(self, gram: int) -> np.ndarray:
        mask = (1 << _BITS) - 1
        first, second, third = (self._letter(gram >> s & mask) for s in (2 * _BITS, _BITS, 0))
        return np.roll(first, 2) * np.roll(second, 1) * third

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        """Rows of `vectors` of sorted grams; new ones are added."""
        at = np.searchsorted(self.known, grams)
        inside = at < len(self.known)
        new = ~inside
        new[inside] = self.known[at[inside]] != grams[inside]
        if new.any():
            if len(self.known) + new.sum() > KEPT:
                self.clear()
                new[:] = True
            old, more = len(self.known), grams[new]
            while old + len(more) > len(self.vectors):
                self.vectors = np.concatenate((self.vectors, np.empty_like(self.vectors)))
            for n, gram in enumerate(more.tolist()):
                self.vectors[old + n] = self._bound(gram)
            known = np.concatenate((self.known, more))
            order = np.argsort(known)
            self.known, self.row = known[order], np.concatenate((self.row, np.arange(old, old + len(more))))[order]
            at = np.searchsorted(self.known, grams)
        return self.row[at]

    def profile(self, text: str | None) -> np.ndarray | None:
        """At unit length; None if there is no letter."""
        grams, counts = trigrams(text or "")
        total = np.zeros(self.dimensions, dtype=np.float64)
        run = min(RUN, KEPT // 8)
        for at in range(0, len(grams), run):
            part = slice(at, at + run)
            total += counts[part].astype(np.float32) @ self.vectors_of(grams[part])
        length = np.sqrt(total @ total)
        return total / length if length else None

    def vectors_of(self, grams: np.ndarray) -> np.ndarray:
        rows = self._rows(grams)
        return self.vectors[rows].astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(labelled: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """text and lang of up to about `most` different texts of each language, written once.

    labelled: doc_id, text, lang.
    """
    usable = labelled.filter("doc_id IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, most / n))])
    chosen = usable.filter(share_of_rows(share[F.col("lang")])) if counts else usable
    return stored(chosen.dropDuplicates().select("text", "lang"))


def prototypes(sample: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """A vector at unit length for each language. One for each language and task of the
    small sample comes to the driver."""

    def bundled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        encoder = Encoder(dimensions)
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                profile = encoder.profile(text.as_py())
                if profile is not None:
                    totals[lang] = totals.get(lang, 0) + profile
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.list_(pa.float64()))],
            names=["lang", "vector"],
        )

    bundles: dict[str, np.ndarray] = {}
    for row in sorted(sample.mapInArrow(bundled, "lang string, vector array<double>").collect()):
        bundles[row.lang] = bundles.get(row.lang, 0) + np.array(row.vector)
    return {lang: v / np.sqrt(v @ v) for lang, v in sorted(bundles.items()) if v @ v > 0}


def common_trigrams(sample: DataFrame) -> dict[str, np.ndarray]:
    """By language the trigrams that are common in its texts, sorted; no more than RARE can be."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said: dict[str, list] = {}
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                said.setdefault(lang, []).append(trigrams(text.as_py() or ""))
            for lang, each in said.items():
                grams, counts = (np.concatenate(part) for part in zip(*each))
                grams, where = np.unique(grams, return_inverse=True)
                counts = np.bincount(where, counts, len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())],
                    names=["lang", "gram", "n"],
                )

    counts = sample.mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts)
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    found: dict[str, list[int]] = {}
    for row in counts.join(total, "lang").filter(F.col("n") * RARE >= F.col("total")).collect():
        found.setdefault(row.lang, []).append(row.gram)
    return {lang: np.sort(np.array(grams, dtype=np.int64)) for lang, grams in found.items()}


def _judge(learned: dict[str, np.ndarray]) -> Callable[[str | None], tuple[str, float]]:
    """A function from text to language and score. Its vectors go when it does."""
    names, matrix = list(learned), np.array(list(learned.values()))
    encoder = Encoder(matrix.shape[1]) if learned else None

    def best(text: str | None) -> tuple[str, float]:
        profile = encoder.profile(text) if encoder else None
        if profile is None:
            return UNKNOWN, 0.0
        cosines = matrix @ profile
        n = int(np.argmax(cosines))
        return names[n], float(min(1.0, max(0.0, cosines[n])))

    return best


def predicted(docs: DataFrame, learned: dict[str, np.ndarray]) -> DataFrame:
    """The rows with lang_pred and score added (columns of these names are replaced)."""
    rest = docs.drop("lang_pred", "score")

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _judge(learned)
        for batch in batches:
            found = [best(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    schema = rest.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return rest.mapInArrow(each, schema)


class Languages:
    """What recognition needs: prototypes and common trigrams by language."""

    def __init__(self, vectors: dict[str, np.ndarray], common: dict[str, np.ndarray]):
        self.vectors, self.common = vectors, common


def likeness(text: str, score: float, common: dict[str, np.ndarray]) -> float:
    """A text's cosine and the largest share of its different trigrams that are common in a language."""
    grams, _ = trigrams(text)
    return score + max((float(np.isin(grams, known).mean()) for known in common.values()), default=0.0)


def recognised(docs: DataFrame, learned: Languages) -> DataFrame:
    """The rows whose text is in a learned language; all columns kept."""

    @F.arrow_udf("boolean")
    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        best = _judge(learned.vectors)
        for batch in texts:
            found = ((text, *best(text)) for text in (value.as_py() for value in batch))
            # mostly the cosine is enough
            yield pa.array(
                [
                    lang != UNKNOWN and (score >= LIKE or likeness(text, score, learned.common) >= LIKE)
                    for text, lang, score in found
                ],
                pa.bool_(),
            )

    return docs.filter(known("text"))


def _to_learn_from(docs: DataFrame) -> DataFrame:
    """A sample of the documents that are not held out."""
    return training_sample(docs.filter(~held_out(F.col("doc_id"))))


def learned_languages(docs: DataFrame) -> Languages:
    """Prototypes and common trigrams from the documents that are not held out."""
    sample = _to_learn_from(docs)
    return Languages(prototypes(sample), common_trigrams(sample))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = predicted(docs.select("doc_id", "text"), prototypes(_to_learn_from(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
