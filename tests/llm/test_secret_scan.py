"""Secrets against plain Python, and the randomness tests on made-up strings."""

import math
import random
import re
import time

import pytest
from plain import base_spans, sha, spelled
from pyspark.sql import functions as F

from tidemark.llm import secret_scan as s
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

TEXTS = [
    None,
    "",
    "no secret here",
    'token = "0123456789abcdef0123"',
    "PASSWORD:hunter2hunter2 api-key=a apikey='zzzzzzzzzzzz' Api_Key==abcdefghijkl",
    "password=token: abcdefghijklmnop",  # the first keyword takes the second
    "secret=short token=token=token=token",
    "AKIA" + "A" * 13 + " AKIA" + "A" * 14 + " xAKIAKIA" + "B2" * 8,
    "é" * 5 + "deadbeefdeadbeef" + "😀 cafe" + "0" * 15 + "g" + "0" * 16,
    "token=" + "a" * 40 + "\ntoken\t=abcdefghijklmnop",
    "passwd : 'with.dots/and+more=='tail",
    "ſecret=abcdefghijklmnop paſſword=abcdefghijklmnop",
    "4111111111111111 is a card",
    ("x" * 50 + " token=abcdefabcdefabcdef ") * 300,
]


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans(spark):
    df = rows(spark, TEXTS).select("doc_id", s.base_spans(F.coalesce("text", F.lit(""))).alias("spans"))
    got = {r.doc_id: [(x.start, x.kind, x.end) for x in r.spans] for r in df.collect()}
    assert got == {n: base_spans(t) for n, t in enumerate(TEXTS)}


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op8_secrets"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = base_spans(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert r.base_sha256 == sha(spelled(spans))
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == [x for x in spelled(spans).split(",") if x]


def statistics(string, alphabet):
    """The three statistics by the book."""
    n, size = len(string), len(alphabet)
    v = [alphabet.index(c) for c in string]
    cells = [[i for i in range(size) if i * 8 // size == b] for b in range(8)]
    chi = sum((sum(x in c for x in v) - n * len(c) / size) ** 2 / (n * len(c) / size) for c in cells)
    up = [x >= size / 2 for x in v]
    a, runs = sum(up), 1 + sum(x != y for x, y in zip(up, up[1:]))
    mean = 2 * a * (n - a) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    m = sum(v) / n
    spread = sum((x - m) ** 2 for x in v)
    serial = sum((x - m) * (y - m) for x, y in zip(v, v[1:])) / spread * math.sqrt(n) if spread else math.sqrt(n)
    return chi, (runs - mean) / math.sqrt(var) if var > 0 else math.sqrt(n), serial


def p_value(string, alphabet):
    phi = lambda z: math.erfc(-z / math.sqrt(2)) / 2
    n = len(string)
    chi, runs, serial = statistics(string, alphabet)
    k, lam = 7, n * s.EFFECT
    h = 1 - 2 * (k + lam) * (k + 3 * lam) / (3 * (k + 2 * lam) ** 2)
    p = (k + 2 * lam) / (k + lam) ** 2
    m = (h - 1) * (1 - 3 * h)
    z = ((chi / (k + lam)) ** h - (1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p))) / (h * math.sqrt(2 * p) * (1 + 0.5 * m * p))
    shift = s.EFFECT * math.sqrt(n)
    return max(phi(z), *(phi(abs(x) - shift) - phi(-abs(x) - shift) for x in (runs, serial)))


@pytest.mark.parametrize("name, pattern, alphabet", s.ENCODINGS)
def test_battery(spark, name, pattern, alphabet):
    rng = random.Random(name)
    strings = ["".join(rng.choices(alphabet, k=n)) for n in (20, 25, 40, 64, 200)]
    strings += [alphabet[0] * 30, (alphabet[:2] * 20)[:30], "".join(sorted(strings[3]))]
    df = spark.createDataFrame([(x,) for x in strings], "x string").select("x", s.battery(F.col("x"), F.lit(name)).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(p_value(r.x, alphabet), abs=2e-7)


def test_random_strings_are_found_and_words_are_not(spark):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    words = ["river", "stone", "Walking", "over", "the", "bridge", "2024", "chapter", "of", "many"]
    texts, wanted = [], []
    for n in range(300):
        secret = "".join(rng.choices(letters, k=rng.choice((40, 64))))
        wordy = "_".join(rng.choices(words, k=8)) + "1"
        texts.append(f"{'é' * (n % 5)} see {secret} and {wordy}")
        wanted.append((n % 5 + 5, n % 5 + 5 + len(secret)))
    df = rows(spark, texts)
    levels = s.discovery_levels(df)
    assert levels == s.discovery_levels(df.repartition(5))
    found = {r.doc_id: r.secrets_spans for r in s.scan(df, levels).collect()}
    random_kind = len(s.KINDS) - 1
    hits = [[(x.start, x.end) for x in found[n] if x.kind == random_kind] for n in range(300)]
    assert sum([w] == h for w, h in zip(wanted, hits)) > 285
    assert sum(len(set(h) - {w}) for w, h in zip(wanted, hits)) <= 3  # false discoveries


def test_step_up_rule(spark):
    """Against the rule on sorted p-values, on the same grid."""
    rng = random.Random(8)
    df = rows(spark, ["".join(rng.choices("0123456789abcdef", k=30)) if n % 2 else "a1" * 15 for n in range(80)])
    each = df.select(F.explode(s.candidates(F.col("text"))).alias("c")).select("c.*").collect()
    wanted = {}
    for stratum in {r.stratum for r in each}:
        found = [r.level for r in each if r.stratum == stratum]
        passing = [x for x in sorted(set(found)) if 10 ** (-x / s.GRID) * len(found) <= s.FDR * sum(y >= x for y in found)]
        if passing:
            wanted[stratum] = passing[0]
    assert s.discovery_levels(df) == wanted


def test_redaction_keeps_the_rest(spark):
    df = rows(spark, TEXTS).selectExpr("*", "length(text) AS n_chars", "1 AS secrets_spans", "'x' AS document")
    df = df.withColumn("n_chars", F.col("n_chars").cast("long"))
    got = s.without_secrets(df, {})
    assert got.schema == df.schema or got.columns == df.columns
    for r in got.collect():
        text = TEXTS[r.doc_id]
        if text is None:
            assert r.text is None and r.n_chars is None
            continue
        out, at = "", 0
        for start, _, end in base_spans(text):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        assert r.text == out + text[at:]
        assert r.n_chars == len(r.text) and (r.secrets_spans, r.document) == (1, "x")
        assert not re.search("[0-9a-f]{16}", r.text)


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def found_in(spark, texts):
    df = rows(spark, texts)
    got = s.scan(df, s.discovery_levels(df)).collect()
    return {r.doc_id: [(x.start, x.end) for x in r.secrets_spans if x.kind == len(s.KINDS) - 1] for r in got}


@pytest.mark.parametrize("marks", ["", "+/"])
def test_random_strings_in_paths_with_both_marks_are_found(spark, marks):
    rng = random.Random(6)
    paths = ["build/x86_64/", "my-service/", "a-b/c_d/some_long_name_of_a/"]
    secrets = ["".join(rng.choices(ALNUM + marks, k=44)) for _ in range(120)]
    places = [f"see {paths[n % 3]}" for n in range(120)]
    found = found_in(spark, [f"{a}{x} end" for a, x in zip(places, secrets)])
    whole = [any(a <= len(p) and len(p) + 44 <= b for a, b in found[n]) for n, p in enumerate(places)]
    assert sum(whole) > 105


def test_wordy_paths_with_both_marks_are_not_found(spark):
    rng = random.Random(7)
    words = ["river", "stone", "walking", "over", "the", "bridge", "2024", "chapter", "of", "many", "build", "x86"]
    texts = ["".join(w + rng.choice("/_-") for w in rng.choices(words, k=9)) for _ in range(300)]
    assert sum(map(bool, found_in(spark, texts).values())) <= 3


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ALNUM[:52]])
def test_random_letters_are_found_and_words_in_letters_are_not(spark, letters):
    rng = random.Random(9)
    words = "river stone walking over the bridge chapter many people national information government between this"
    words = [w.upper() if letters.isupper() else w for w in words.split()]
    if letters == ALNUM[:52]:
        words = [w.title() for w in words]
    secrets = ["".join(rng.choices(letters, k=44)) for _ in range(150)]
    wordy = ["".join(rng.choices(words, k=7))[:44] for _ in range(150)]
    found = found_in(spark, secrets + wordy)
    assert sum(found[n] == [(0, 44)] for n in range(150)) > 130
    assert sum(bool(found[150 + n]) for n in range(150)) <= 15


def plain_random(spark, texts):
    """Random spans of texts by id: candidates, the step-up rule and what they add, in plain Python; p-values by `battery`."""
    each = []
    for doc, text in texts.items():
        for run in re.finditer(s.CANDIDATE, text or ""):
            pieces = {run.span()}
            if re.search("[+/]", run[0]) and re.search("[_-]", run[0]):
                pieces = {(run.start() + m.start(), run.start() + m.end()) for x in s.PIECES for m in re.finditer(x, run[0])}
            for a, b in pieces:
                names = [name for name, pattern, _ in s.ENCODINGS if re.search(pattern, text[a:b])]
                if names and re.search("[A-Za-z]", text[a:b]):
                    each.append((doc, a, b, text[a:b], names[0]))
    strings = spark.createDataFrame(sorted({x[3:] for x in each}) or [("a" * 20, "lower")], "string string, encoding string")
    p = {r.string: r.p for r in strings.select("string", s.battery(F.col("string"), F.col("encoding")).alias("p")).collect()}
    strata = {}
    for doc, a, b, string, name in each:
        level = max(0, min(math.floor(-math.log10(max(p[string], 1e-30)) * s.GRID), s.GRID * s.GRID_POWERS))
        strata.setdefault((name, sum(n <= b - a for n in s.LENGTH_CLASSES)), []).append((level, doc, a, b))
    found = {doc: [] for doc in texts}
    for members in strata.values():
        levels = [level for level, *_ in members]
        passing = [t for t in sorted(set(levels)) if 10 ** (-t / s.GRID) * len(levels) <= s.FDR * sum(x >= t for x in levels)]
        for level, doc, a, b in members:
            if passing and level >= passing[0] and not any(x < b and a < y for x, _, y in base_spans(texts[doc])):
                found[doc].append((a, b))
    return {
        doc: sorted(c for c in spans if not any(o != c and o[0] <= c[0] and c[1] <= o[1] for o in spans))
        for doc, spans in found.items()
    }


def test_random_spans_of_the_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r.spans.split(",") for r in QUERIES["op8_secrets"](spark, SF_DIR).collect()}
    random_spans = {doc: sorted(tuple(map(int, x.split(":")[1:])) for x in spans if x.startswith("random")) for doc, spans in got.items()}
    assert random_spans == plain_random(spark, texts)


def strings(rng, n):
    kinds = ["0123456789abcdef", ALNUM, ALNUM + "+/", ALNUM + "_-", ALNUM + "+/_-"]
    each = ["".join(rng.choices(rng.choice(kinds), k=rng.choice((8, 16, 24, 44, 70)))) for _ in range(n)]
    words = ["token=", "river/", "a_b-c/", " ", "\n", "é ", "stone ", "x" * 30 + " "]
    return "".join(x + rng.choice(words) for x in each)


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_spans_of_mixed_texts(spark, monkeypatch, chunk):
    """Patterns, random strings, runs with both marks, next to and over each other, in chunks of any size."""
    monkeypatch.setattr(s, "CHUNK", chunk)
    rng = random.Random(11)
    texts = {n: strings(rng, n) for n in range(70)}
    assert found_in(spark, list(texts.values())) == plain_random(spark, texts)
    df = rows(spark, list(texts.values()))
    levels = s.discovery_levels(df)
    spans = {r.doc_id: [(x.start, x.end) for x in r.secrets_spans] for r in s.scan(df, levels).collect()}
    for r in s.without_secrets(df, levels).collect():
        text, out, at = texts[r.doc_id], "", 0
        for start, end in spans[r.doc_id]:
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        assert r.text == out + text[at:]


def test_very_long_text_with_very_many_spans(spark):
    rng = random.Random(12)
    text = " ".join("".join(rng.choices("0123456789abcdef", k=16)) for _ in range(64_000))
    df = rows(spark, [text, "token=" + "a" * 12])
    begun = time.monotonic()
    got = s.scan(df, {}).select("doc_id", F.size("secrets_spans").alias("n"), s.redacted(F.col("text"), F.col("secrets_spans")).alias("text"))
    assert [(r.n, r.text) for r in got.orderBy("doc_id").collect()] == [(64_000, " ".join(["[SECRET]"] * 64_000)), (1, "[SECRET]")]
    assert time.monotonic() - begun < 60  # seconds here, hours if each span were to copy those before it
