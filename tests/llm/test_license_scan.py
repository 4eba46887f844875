"""License notices against brute force."""

import random
import re

import pytest

from tidemark.llm.license_scan import GAP, TEMPLATES, align, built_in, licenses
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def plain_align(template, words, at, band):
    """Best score over all alignments, cell by cell of the whole table."""
    best = {}

    def score(n, w, begun):
        # template words from n, text words from w
        if (n, w, begun) in best:
            return best[n, w, begun]
        if n == len(template):
            return 0.0
        if abs(w - at - n) > band:
            return float("-inf")
        options = [score(n + 1, w, begun) - GAP]
        if 0 <= w < len(words) and words[w] == template[n]:
            options.append(1 + score(n + 1, w + 1, True))
        else:
            options.append(score(n + 1, w + 1, begun) - (2 * GAP if begun else GAP))
        options.append(score(n, w + 1, begun) - (GAP if begun else 0.0))
        best[n, w, begun] = max(options)
        return best[n, w, begun]

    return max(score(0, at + d, False) for d in range(-band, band + 1))


def test_align_is_the_best():
    rng = random.Random(1)
    for _ in range(60):
        template = rng.choices("abcdefg", k=rng.randint(1, 9))
        words = rng.choices("abcdefg", k=5) + [w for w in template if rng.random() < 0.8] + rng.choices("abcdefg", k=3)
        got = align(template, words, 5, 3)
        assert got[0] == pytest.approx(plain_align(template, words, 5, 3))


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_template_is_found_in_any_dress(name):
    text = TEMPLATES[name]
    said = "Before it.\n" + re.sub(r"\s+", " \n * ", text).upper() + "\nAfter it."
    for whole in (text, said, "é😀 " + text + " " + "x " * 3000 + text):
        found = built_in().matches(whole)
        assert {m.license for m, _, _ in found} == {name}
        assert len(found) == whole.lower().count(" ".join(text.lower().split())) or len(found) in (1, 2)
        for m, start, end in found:
            assert m.coverage == 1.0
            assert re.findall(r"\w+", whole[start:end].lower()) == re.findall(r"\w+", text.lower())


def test_changed_templates_are_found_with_their_coverage():
    words = TEMPLATES["ISC"].split()
    changed = words[:10] + ["every", "single"] + words[12:20] + ["extra"] + words[20:-2]
    ((m, start, end),) = built_in().matches("x " + " ".join(changed) + " y")
    assert m.license == "ISC" and 0.8 <= m.coverage < 1 and start == 2


@pytest.mark.parametrize("text", [None, "", "license", "The licensed copy of the work is under the table.", "rights all reserved"])
def test_nothing_to_find(text):
    assert built_in().matches(text) == []


def test_query_finds_every_exact_notice(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    wanted = set()
    for name, text in TEMPLATES.items():
        pattern = re.compile(r"\b" + r"\W+".join(re.findall(r"\w+", text)) + r"\b", re.I)
        wanted |= {(i, name, *m.span()) for i, t in docs.items() for m in pattern.finditer(t)}
    got = QUERIES["op9_licenses"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.license, r.span_start, r.span_end) for r in got if r.coverage == 1.0} == wanted and wanted


def test_defined_results(spark):
    rows = [(1, None), (None, "Released under the MIT License."), (2, "All rights reserved.")] + [(2, "All rights reserved.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS license")
    got = [(r.doc_id, r.license, r.span_start, r.span_end) for r in licenses(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(None, "MIT (notice)", 0, 30), (2, "all rights reserved", 0, 19), (2, "all rights reserved", 0, 19)], key=str
    )
    own = licenses(docs, {"mine": "under the MIT"}).collect()
    assert [(r.license, r.matched_words) for r in own] == [("mine", 3)]
    assert licenses(docs.limit(0)).count() == 0


SHORT = sorted(n for n, t in TEMPLATES.items() if len(re.findall(r"\w+", t)) <= 8)


@pytest.mark.parametrize("between", ["", " x", " a b", " a b c", " a b c d e f g"])
@pytest.mark.parametrize("name", SHORT)
def test_notices_that_repeat_are_found_each(name, between):
    said = TEMPLATES[name]
    for times in (2, 3, 4, 9):
        text = "Before it. " + (said + between + " ") * times + "after it"
        pattern = re.compile(r"\b" + r"\W+".join(re.findall(r"\w+", said)) + r"\b", re.I)
        wanted = [m.span() for m in pattern.finditer(text)]
        got = built_in().matches(text)
        assert len(wanted) == times
        assert [(re.sub(r"\W+$", "", text[a:b]), m.license) for m, a, b in got] == [(text[a:b], name) for a, b in wanted]
        assert [(a, b) for _, a, b in got] == wanted


def test_a_notice_without_a_word_beside_a_whole_one():
    text = "Under the MIT License. Released under the MIT License."
    said = [(m.license, m.matched, a) for m, a, _ in built_in().matches(text)]
    assert said == [("MIT (licensed)", 4, 0), ("MIT (notice)", 5, 23)]  # of equal ones the first by name


def test_runs_of_random_notices():
    rng = random.Random(4)
    for _ in range(60):
        names = rng.choices(sorted(TEMPLATES), k=rng.randint(2, 8))
        text = " ".join(TEMPLATES[n] + rng.choice(["", " word", "\nand then some"]) for n in names)
        assert [m.license for m, _, _ in built_in().matches(text)] == names


def test_many_repeats_in_one_text():
    assert len(built_in().matches("All rights reserved.\n" * 20_000)) == 20_000


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_notice_is_given_its_own_name(name):
    """Alone, among other words, and over lines."""
    text = TEMPLATES[name]
    for around in (text, f"Some words before. {text} And some after it.", text.replace(" ", "\n * ")):
        found = [m.license for m, _, _ in built_in().matches(around)]
        own = {name} | ({"all rights reserved"} if "All rights reserved" in text else set())
        assert name in found and set(found) <= own


def test_lines_that_name_their_license(spark):
    text = "// SPDX-License-Identifier: (MIT OR Apache-2.0)\n# SPDX-License-Identifier: GPL-1.0-or-later WITH X-exception-2.0\nnone"
    rows = licenses(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()
    found = sorted((r.span_start, r.license, text[r.span_start : r.span_end].split(":")[1].strip()) for r in rows)
    assert [f[1] for f in found] == [f[2] for f in found] == ["(MIT OR Apache-2.0)", "GPL-1.0-or-later WITH X-exception-2.0"]
    assert all(r.coverage == 1.0 for r in rows)
