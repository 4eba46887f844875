"""Secrets in texts: three patterns, and strings that look random.

Patterns (leftmost, non-overlapping per kind): values assigned to a password,
token or key; access key ids; long lower-case hex strings.

Random strings: every run of 20 or more base64 characters that holds a letter is a
candidate. Of a run that has marks of both kinds of base64, which no encoding has,
the candidates are its runs of 20 or more characters with marks of one kind and
those without a mark. A candidate's encoding is the narrowest alphabet that has all
its characters: hex, base32, base36, base64, or for those without a digit letters,
with marks or not, the ones common in words first. The characters' places in the
alphabet go through three tests of randomness:

* chi-squared, over eight equal ranges of the alphabet;
* runs above and below the middle of the alphabet;
* serial correlation of neighbours.

The null hypothesis is that the string is *not* random: that it departs from
randomness by an effect of at least EFFECT in some test. Under it each
statistic has a known non-central law, whose centre moves away with the length,
so that a short string cannot pass by weakness of the tests. The p-value of a
string is the largest of the three: all must rule out structure. Discoveries are
controlled at a false-discovery rate of FDR within each encoding and class of
lengths, by the step-up rule over all candidates of the corpus, on a fixed grid
of p-values: the grid makes it one small aggregation instead of a global sort.

Only DataFrame functions are used; a text is scanned where it lies, nothing is
shuffled but the counts on the grid. Spans are found, joined and cut out in passes
along the text, so that work grows with a text's length and its spans alike.

Defined results: a null or empty text has no spans; spans are in code points,
end exclusive; a random string that touches a pattern's span, or lies inside a
longer one, adds nothing; digits and marks alone are no candidate; rows
that repeat are scanned each on its own and count each as a candidate; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table

#: Fixed patterns: kind, regular expression, the group whose length counts, least length.
#: A run that is too short hides no longer one of its kind, so that `{n,}` stands
#: for a maximal run and a check of its length; not so for values that hold a keyword.
PATTERNS = [
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
KINDS = [kind for kind, *_ in PATTERNS] + ["random"]

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Of a run with marks of both kinds: what has marks of one kind, or none.
PIECES = (r"[A-Za-z0-9+/]{20,}", r"[A-Za-z0-9_-]{20,}", r"[A-Za-z0-9]{20,}")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Letters as they are common in words, so that words are uneven over the ranges.
_COMMON = "eanirtsoludhcmgpbfwvzkyqjx"
#: Encoding, what its strings match, its alphabet in order.
ENCODINGS = [
    ("lower", "^[a-z]+$", _COMMON),
    ("UPPER", "^[A-Z]+$", _COMMON.upper()),
    ("letters", "^[A-Za-z]+$", _COMMON + _COMMON.upper()),
    ("letters+/", "^[A-Za-z+/]+$", _COMMON + _COMMON.upper() + "+/"),
    ("letters-_", "^[A-Za-z_-]+$", _COMMON + _COMMON.upper() + "-_"),
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", _DIGITS + _LOWER),
    ("BASE36", "^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
]
LENGTH_CLASSES = (20, 28, 40, 64, 128)
BINS = 8
EFFECT = 0.8
FDR = 0.05
#: Edges of the grid of p-values: 20 to a power of ten, from 10^-8 to 1.
GRID = 20
GRID_POWERS = 8
#: Spans to a chunk, where a long text's are swept over.
CHUNK = 64


def _matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """A pattern's matches that are long enough: (start, kind, end, string)."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"),
        whole.alias("found"),
        F.transform(counted, F.length).alias("counted"),
    )

    def span(at: Column, m: Column) -> Column:
        start = at + m["gap"]
        end = start + F.length(m["found"])
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m["found"].alias("string"))

    found = _swept(
        pieces,
        after=lambda at, m: at + m["gap"] + F.length(m["found"]),
        joined=lambda at, further: at + further,
        keep=lambda at, m: m["counted"] >= least,
        value=span,
    )
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,string:string>>)")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _swept(items: Column, after: Callable, joined: Callable, keep: Callable, value: Callable) -> Column:
    """The values of the items that are kept, in one pass with a place in the text that begins at 0.

    after, keep, value: functions of the place before an item and the item; joined: the place after
    items that alone lead to a place. What aggregation carries is copied at each step, so it carries
    the places of a chunk at most, and the places at which chunks begin.
    """
    none = F.expr("CAST(array() AS array<int>)")

    def gathered(xs: Column, begin: Column, onward: Callable) -> Column:
        def step(state: Column, x: Column) -> Column:
            found = F.concat(state["found"], F.array(state["at"]))
            return F.struct(onward(state["at"], x).alias("at"), found.alias("found"))

        return F.aggregate(xs, F.struct(begin.alias("at"), none.alias("found")), step, lambda state: state["found"])

    def before(chunks: Column) -> Column:
        each = F.transform(chunks, lambda chunk: F.aggregate(chunk, F.lit(0), after))
        begins = gathered(each, F.lit(0), joined)
        return F.flatten(F.zip_with(chunks, begins, lambda chunk, begin: gathered(chunk, begin, after)))

    def of(xs: Column) -> Column:
        starts = F.when(F.size(xs) > 0, F.sequence(F.lit(1), F.size(xs), F.lit(CHUNK))).otherwise(none)
        chunks = F.transform(starts, lambda n: F.slice(xs, n, F.lit(CHUNK)))
        placed = F.zip_with(xs, _let(chunks, before), lambda x, at: F.struct(x.alias("x"), at.alias("at")))
        return F.transform(F.filter(placed, lambda p: keep(p["at"], p["x"])), lambda p: value(p["at"], p["x"]))

    return _let(items, of)


def _farthest(reach: Column, item: Column) -> Column:
    return F.greatest(reach, item["end"])


def _cdf(z: Column) -> Column:
    """Standard normal distribution function, to about 1e-7 (a fixed rational approximation)."""

    def tail(t: Column) -> Column:
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-z * z / 2) * 0.3989422804014327 * poly

    return _let(_let(1 / (1 + 0.2316419 * F.abs(z)), tail), lambda p: F.when(z >= 0, 1 - p).otherwise(p))


def _uniform_z(n: Column, statistic: Column) -> Column:
    """Normal score of how even a string is, if it has an effect of EFFECT.

    The lower tail of the non-central chi-squared law, by its power that is
    nearly normal.
    """
    k = F.lit(float(BINS - 1))

    def powered(x: Column) -> Column:
        m = (x["h"] - 1) * (1 - 3 * x["h"])
        centre = 1 + x["h"] * x["p"] * (x["h"] - 1 - 0.5 * (2 - x["h"]) * m * x["p"])
        width = x["h"] * F.sqrt(2 * x["p"]) * (1 + 0.5 * m * x["p"])
        return (F.pow(x["scaled"], x["h"]) - centre) / width

    def shaped(shift: Column) -> Column:
        mean, spread = k + shift, k + 2 * shift
        return F.struct(
            (1 - 2 * mean * (k + 3 * shift) / (3 * spread * spread)).alias("h"),
            (spread / (mean * mean)).alias("p"),
            (statistic / mean).alias("scaled"),
        )

    return _let(_let(n * EFFECT, shaped), powered)


def _shifted_p(n: Column, z: Column) -> Column:
    """Chance that a statistic shifted by EFFECT standard steps lies as near to 0 as z."""
    return _let(
        F.struct(F.abs(z).alias("z"), (EFFECT * F.sqrt(n)).alias("shift")),
        lambda x: _let(x["z"] - x["shift"], _cdf) - _let(-x["z"] - x["shift"], _cdf),
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _chi_squared(places: Column, n: Column, size: Column) -> Column:
    """Over BINS equal ranges; a range expects its part of the alphabet."""

    def total(bins: Column) -> Column:
        def term(b: Column) -> Column:
            seen = F.size(F.filter(bins, lambda x: x == b))
            expected = n * (F.ceil((b + 1) * size / BINS) - F.ceil(b * size / BINS)) / size
            return (seen - expected) * (seen - expected) / expected

        return _total(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), term))

    return _let(F.transform(places, lambda v: F.floor(v * BINS / size)), total)


def _pairs(places: Column) -> Column:
    n = F.size(places)
    return F.arrays_zip(F.slice(places, F.lit(1), n - 1).alias("a"), F.slice(places, F.lit(2), n - 1).alias("b"))


def _runs_z(places: Column, n: Column, size: Column) -> Column:
    """Runs above and below the middle; all on one side counts as far off."""
    middle = size / 2

    def z(x: Column) -> Column:
        mean = 2 * x["above"] * (n - x["above"]) / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        return F.when(variance > 0, (x["runs"] - mean) / F.sqrt(variance)).otherwise(F.sqrt(n))

    above = F.size(F.filter(places, lambda v: v >= middle)).cast("double")
    runs = 1 + F.size(F.filter(_pairs(places), lambda x: (x["a"] >= middle) != (x["b"] >= middle)))
    return _let(F.struct(above.alias("above"), runs.alias("runs")), z)


def _serial_z(places: Column, n: Column) -> Column:
    def z(centred: Column) -> Column:
        spread = _total(F.transform(centred, lambda v: v * v))
        shared = _total(F.transform(_pairs(centred), lambda x: x["a"] * x["b"]))
        return F.when(spread > 0, shared / spread * F.sqrt(n)).otherwise(F.sqrt(n))

    return _let(_total(places) / n, lambda mean: _let(F.transform(places, lambda v: v - mean), z))


def _pick(encoding: Column, of: dict) -> Column:
    chosen = F.lit(None)
    for name, value in of.items():
        chosen = F.when(encoding == name, F.lit(value)).otherwise(chosen)
    return chosen


def encoding_of(string: Column) -> Column:
    """The narrowest encoding with all characters; null without a letter."""
    narrowest = F.lit(None).cast("string")
    for name, pattern, _ in reversed(ENCODINGS):
        narrowest = F.when(string.rlike(pattern), name).otherwise(narrowest)
    return F.when(string.rlike("[A-Za-z]"), narrowest)


def battery(string: Column, encoding: Column) -> Column:
    """The largest p-value of the three tests, for a string of 2 or more characters."""
    letters = _pick(encoding, {name: letters for name, _, letters in ENCODINGS})

    def places_in(alphabet: Column) -> Column:
        chars = F.filter(F.split(string, ""), lambda c: c != "")
        return F.transform(chars, lambda c: (F.call_function("instr", alphabet, c) - 1).cast("double"))

    def statistics(x: Column) -> Column:
        return F.struct(
            x["n"].alias("n"),
            _chi_squared(x["places"], x["n"], x["size"]).alias("uneven"),
            _runs_z(x["places"], x["n"], x["size"]).alias("runs"),
            _serial_z(x["places"], x["n"]).alias("serial"),
        )

    drawn = _let(
        letters,
        lambda alphabet: F.struct(
            F.length(string).cast("double").alias("n"),
            F.length(alphabet).cast("double").alias("size"),
            places_in(alphabet).alias("places"),
        ),
    )
    return _let(
        _let(drawn, statistics),
        lambda x: F.greatest(
            _let(_uniform_z(x["n"], x["uneven"]), _cdf),
            _shifted_p(x["n"], x["runs"]),
            _shifted_p(x["n"], x["serial"]),
        ),
    )


def _length_class(n: Column) -> Column:
    return F.size(F.filter(F.array(*[F.lit(x) for x in LENGTH_CLASSES]), lambda least: least <= n))


def candidates(text: Column) -> Column:
    """Encoded strings of a text, each with its stratum and the grid level of its p-value."""
    def pieces(run: Column) -> Column:
        def placed(m: Column) -> Column:
            start = run["start"] + m["start"]
            end = run["start"] + m["end"]
            return F.struct(start.alias("start"), m["kind"].alias("kind"), end.alias("end"), m["string"].alias("string"))

        each = [_matches(run["string"], pattern, 0, LENGTH_CLASSES[0], len(KINDS) - 1) for pattern in PIECES]
        mixed = run["string"].rlike("[+/]") & run["string"].rlike("[_-]")
        return F.when(mixed, _let(F.array_sort(F.transform(F.concat(*each), placed)), once)).otherwise(F.array(run))

    def once(found: Column) -> Column:
        def is_new(m: Column, n: Column) -> Column:
            before = F.get(found, n - 1)
            return (n == 0) | (m["start"] != before["start"]) | (m["end"] != before["end"])

        return F.filter(found, is_new)

    strings = F.transform(
        F.flatten(F.transform(_matches(text, CANDIDATE, 0, LENGTH_CLASSES[0], len(KINDS) - 1), pieces)),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["string"].alias("string"),
            encoding_of(m["string"]).alias("encoding"),
        ),
    )

    def judged(m: Column) -> Column:
        p = F.greatest(battery(m["string"], m["encoding"]), F.lit(1e-30))
        level = F.least(F.floor(-F.log10(p) * GRID), F.lit(GRID * GRID_POWERS))
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.concat_ws(":", m["encoding"], _length_class(F.length(m["string"]))).alias("stratum"),
            F.greatest(level, F.lit(0)).cast("int").alias("level"),
        )

    return F.transform(F.filter(strings, lambda m: m["encoding"].isNotNull()), judged)


def discovery_levels(docs: DataFrame, fdr: float = FDR) -> dict[str, int]:
    """For each stratum the level from which its strings are discoveries.

    The step-up rule over all candidates: the largest grid value t with
    t * candidates <= fdr * candidates at or below t. The result is bounded by
    the numbers of encodings and length classes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    each = docs.select(F.explode(candidates(text)).alias("c")).select("c.stratum", "c.level")
    counts = each.groupBy("stratum", "level").agg(F.count("*").alias("strings"))
    stratum = Window.partitionBy("stratum")
    at_most = counts.select(
        "stratum",
        "level",
        F.sum("strings").over(stratum.orderBy(F.desc("level"))).alias("found"),
        F.sum("strings").over(stratum).alias("strings"),
    )
    passes = F.pow(F.lit(10.0), -F.col("level") / GRID) * F.col("strings") <= fdr * F.col("found")
    levels = at_most.filter(passes).groupBy("stratum").agg(F.min("level").alias("level"))
    return {row.stratum: row.level for row in levels.collect()}


def base_spans(text: Column) -> Column:
    """Spans of the patterns, by start, then kind: (start, kind, end)."""
    each = [
        _matches(text, pattern, group, least, kind) for kind, (_, pattern, group, least) in enumerate(PATTERNS)
    ]
    return F.transform(
        F.array_sort(F.concat(*each)),
        lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")),
    )


def _joined(base: Column, random: Column) -> Column:
    """The patterns' spans and the random strings that touch none of them; of pieces of one run the longest.

    Two sweeps over sorted spans, each of which carries how far the spans before reach.
    """
    def at(place: str, kind: int) -> Callable[[Column], Column]:
        def of(s: Column) -> Column:
            return F.struct(
                s[place].alias("place"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
            )

        return of

    def as_span(_: Column, s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), s["end"].alias("end"))

    # a string, at its end, meets all pattern spans that begin before it
    ends = F.array_sort(F.concat(F.transform(random, at("end", 0)), F.transform(base, at("start", 1))))
    apart = _swept(
        ends,
        after=lambda reach, s: F.when(s["kind"] == 1, _farthest(reach, s)).otherwise(reach),
        joined=F.greatest,
        keep=lambda reach, s: (s["kind"] == 0) & (s["start"] >= reach),
        value=as_span,
    )
    # by start, the longest first: what reaches no farther than one before lies in it
    by_start = F.transform(
        F.array_sort(F.transform(apart, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back")))),
        lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end")),
    )
    longest = _swept(
        by_start, after=_farthest, joined=F.greatest, keep=lambda reach, s: s["end"] > reach, value=as_span
    )
    return F.array_sort(F.concat(base, longest))


def scan(docs: DataFrame, levels: dict[str, int]) -> DataFrame:
    """The rows with `secrets_base` and `secrets_spans`: the patterns' and all spans (start, kind, end).

    Columns of these names are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    discovered = F.filter(
        F.col("secrets_spans"),
        lambda c: c["level"] >= F.coalesce(_pick(c["stratum"], levels).cast("int"), F.lit(GRID * GRID_POWERS + 1)),
    )
    spans = F.when(F.size(discovered) > 0, _joined(F.col("secrets_base"), discovered)).otherwise(F.col("secrets_base"))
    found = docs.withColumns({"secrets_base": base_spans(text), "secrets_spans": candidates(text)})
    return found.withColumn("secrets_spans", spans)


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or each chain of overlapping spans, as one mark."""
    whole = F.struct(F.length(text).alias("start"), F.lit(0).alias("kind"), F.length(text).alias("end"))
    gaps = _swept(
        F.concat(spans, F.array(whole)),
        after=_farthest,
        joined=F.greatest,
        keep=lambda reach, s: s["start"] >= reach,
        value=lambda reach, s: F.struct(reach.alias("start"), s["start"].alias("end")),
    )

    # places are counted from the beginning of a text: what holds some gaps is cut out first
    def of_chunk(chunk: Column) -> Column:
        base = F.get(chunk, 0)["start"]
        stretch = text.substr(base + 1, F.element_at(chunk, -1)["end"] - base)

        def cut(string: Column) -> Column:
            parts = F.transform(chunk, lambda g: string.substr(g["start"] - base + 1, g["end"] - g["start"]))
            return F.array_join(parts, mark)

        return _let(stretch, cut)

    def joined(gaps: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(gaps), F.lit(CHUNK))
        return F.array_join(F.transform(starts, lambda n: _let(F.slice(gaps, n, F.lit(CHUNK)), of_chunk)), mark)

    return F.when(F.size(spans) > 0, _let(gaps, joined)).otherwise(text)


def without_secrets(docs: DataFrame, levels: dict[str, int], mark: str = "[SECRET]") -> DataFrame:
    """The rows with marks in place of secrets, and n_chars, if there is one, of the new text; all columns kept."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("document"), "text")
    text = redacted(F.col("text"), F.col("secrets_spans"), mark)
    made = scan(packed, levels).select("document", text.alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return made.select(
        *[
            F.when(F.col("document.text").isNull() | (F.col("text") == F.col("document.text")), F.col(f"document.{c}"))
            .otherwise(changed[c])
            .alias(c)
            if c in changed
            else F.col(f"document.{c}")
            for c in docs.columns
        ]
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, as counts, digest and spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, discovery_levels(docs))
    base = F.col("secrets_base")

    def of_kind(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{kind}") for k, (kind, *_) in enumerate(PATTERNS)],
        F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("secrets_spans")).alias("spans"),
    )
