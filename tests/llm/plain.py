"""The operators' results by plain Python over whole tables: models for tests."""

from __future__ import annotations

import hashlib
import re

import xxhash

KINDS = ["assign", "access", "hex"]
_assign = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in _assign.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def spelled(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text: str | None, words: int = 4) -> int:
    said = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not said:
        return 0
    grams = [" ".join(said[i : i + words]) for i in range(max(1, len(said) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict, bits: int = 4) -> dict:
    """Least id that links reach, for each id."""
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def word_count(text: str | None) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def normal(text: str) -> str:
    return " " + " ".join(re.findall(r"\w+", text.lower())) + " "
