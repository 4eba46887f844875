"""Aligned tokens against plain Python over the tokenizers' own output."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from plain import sha
from tokenizers import Tokenizer

from tidemark.llm import token_alignment as t
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    a = Tokenizer.from_file(str(Path(t.FOLDER, t.FILE_A)))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(Path(t.FOLDER, t.FILE_B)))
    return a, b


def byte_of(letter):
    """GPT-style letters to bytes, found by trying: the n-th hidden byte is U+0100 + n."""
    hidden = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
    return hidden[ord(letter) - 0x100] if ord(letter) >= 0x100 else ord(letter)


def tokens(own, text):
    """(id, start, end) of both tokenizers, or none."""
    a, b = own
    whole, out = (" " + (text or "")).encode(), []
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids
    spelled_a = [bytes(byte_of(c) for c in a.id_to_token(i)) for i in ids]
    pieces = b.encode(text)
    spelled_b = [
        bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in ((i, b.id_to_piece(i)) for i in pieces)
    ]
    for each, spelled in ((ids, spelled_a), (pieces, spelled_b)):
        if b"".join(spelled) != whole:
            return None
        start, placed = 0, []
        for i, s in zip(each, spelled):
            placed.append((i, start, start + len(s)))
            start += len(s)
        out.append(placed)
    return out


def wanted(own, docs):
    """(doc_id, text) to the result."""
    linked, rows = [], []
    for _, text in docs:
        found = tokens(own, text)
        a, b = found or ([], [])
        linked.append([(i, j) for i, s, e in a for j, x, y in b if s < y and x < e])
    counts = Counter(pair for pairs in linked for pair in set(pairs))
    best = Counter()
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    for (doc_id, text), pairs in zip(docs, linked):
        a, b = tokens(own, text) or ([], [])
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        said, start = [], 0
        for cut in cuts:
            parts = [",".join(str(i) for i, s, e in each if start <= s and e <= cut) for each in (a, b)]
            said.append("|".join(parts))
            start = cut
        rows.append(
            (
                doc_id,
                len(a),
                len(b),
                len(cuts),
                len(pairs),
                sum(counts[p] == best[p[0]] for p in pairs),
                sum(counts[p] for p in pairs),
                sha(";".join(said)) if a else "",
            )
        )
    return sorted(rows, key=repr)


def small(spark, tmp_path, most=1500):
    """The short documents: plain Python compares all tokens of a document with each other."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter(f"length(text) < {most} OR text IS NULL")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("shared, collected", [(4_000_000, 2_000_000), (0, 100)])
def test_query(spark, tmp_path, monkeypatch, own, shared, collected):
    monkeypatch.setattr(t, "SHARED", shared)
    monkeypatch.setattr(t, "COLLECTED", collected)
    docs = small(spark, tmp_path)
    found = QUERIES["op11_alignment"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == wanted(own, docs)
    assert len(docs) > 50


ODD = [
    "<|endoftext|> and </s> <s> <unk> <0x41>",
    "▁ looks like a blank",
    "two  blanks, a tab\t, a line\n\n end ",
    " ",
    "\n",
    "Zoë naïve ﬁne ½ 日本語 한국어 🎉👩‍👩‍👧 Ελλάδα",
    "\x00\x01 control \x7f",
    "é combining, ­ soft, ﻿ mark",
    "12345678901234567890 ::::---- ''''ll I'll",
    "unbroken" * 300,
]


@pytest.mark.parametrize("shared", [4_000_000, 0])
def test_defined_results(spark, monkeypatch, own, shared):
    monkeypatch.setattr(t, "SHARED", shared)
    rows = [(n, text) for n, text in enumerate(ODD)]
    rows += [(50, None), (51, ""), (None, "no id"), (None, None), (52, "same"), (52, "same"), (52, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS n_a", "3 AS pairs")
    found = t.alignment(df)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == wanted(own, rows)
    assert t.alignment(df.limit(0)).collect() == []


def test_same_ids_as_the_file_says(own):
    """The byte-level BPE is merged by another library here than the one that wrote the file."""
    files = [Path(t.FOLDER, name).read_bytes() for name in (t.FILE_A, t.FILE_B)]
    tokenizers = t.Tokenizers(*files)
    rnd = random.Random(5)
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(rnd.choice(points[: 10 ** rnd.randint(2, 5)])) for _ in range(rnd.randint(1, 60))) for _ in range(500)]
    for text in [*ODD, *texts]:
        assert tokenizers.a.encode_ordinary(" " + text) == own[0].encode(" " + text, add_special_tokens=False).ids


def test_groups_and_links():
    rnd = np.random.default_rng(6)
    for _ in range(200):
        size = int(rnd.integers(1, 40))
        ends = [np.append(np.sort(rnd.choice(size, int(rnd.integers(0, size)), replace=False) + 1), size) for _ in range(2)]
        ends = [np.unique(e) for e in ends]
        group_a, group_b = t.groups(*ends)
        shared = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        for group, each in zip((group_a, group_b), ends):
            assert group.tolist() == [next(n for n, cut in enumerate(shared) if e <= cut) for e in each.tolist()]
        starts = [np.concatenate(([0], e[:-1])) for e in ends]
        at_a, at_b = t.links(*ends)
        pairs = [
            (i, j)
            for i in range(len(ends[0]))
            for j in range(len(ends[1]))
            if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]
        ]
        assert list(zip(at_a.tolist(), at_b.tolist())) == pairs


def test_very_long_text(spark):
    text = "word after word " * 60_000
    (row,) = t.alignment(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.n_links >= row.n_groups > 100_000
    assert row.count_sum == row.n_links and row.n_best <= row.n_links
