"""The contracts of the text operators, spelled out in plain Python over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[tuple[int, int]], max_bits: int = 4) -> dict[int, int]:
    """doc_id -> smallest doc_id that links lead to, of (doc_id, fingerprint)."""
    values = sorted({p for _, p in prints})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    first = defaultdict(list)
    for doc, p in prints:
        first[find(p)].append(doc)
    return {doc: min(first[find(p)]) for doc, p in prints}


def quality(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    n, repeat = len(words), len(covered)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
        n < 50 or 100 * repeat > 50 * n,
    )


def line_dedup(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= 20 and len(d) >= 3}
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), doc) == doc]
        out[doc] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def decontaminate(docs, items, size: int = 10) -> dict[int, tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = BENCH_WORD.findall((text or "").translate(UPPER))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows[tuple(words[i : i + size])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = BENCH_WORD.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        out[doc] = (len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def kept(text: str | None) -> bool:
    """The verdict of all quality rules."""
    n, chars, symbols, dup, _, failed = quality(text)
    if failed:
        return False
    words, lines = WORD.findall(text), [x.strip(" \t\n\x0b\x0c\r") for x in text.split("\n") if WORD.search(x)]
    return (
        2 * n <= chars <= 12 * n
        and 10 * symbols <= n
        and 2 * dup <= len(lines)
        and sum(x[0] in "-*•" for x in lines) <= 0.9 * len(lines)
        and sum(x.endswith(("...", "…")) for x in lines) <= 0.3 * len(lines)
        and sum(any(c.isalpha() for c in w) for w in words) >= 0.8 * n
        and sum(w == w.upper() and w != w.lower() for w in words) <= 0.5 * n
    )


def without_lines(docs: list[tuple[int, str | None]]) -> list[tuple[int, str]]:
    """The texts that line dedup leaves."""
    holders = defaultdict(set)
    for doc, text in docs:
        for line in text.split("\n"):
            holders[line.strip(" \t\n\x0b\x0c\r").translate(UPPER)].add(doc)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= 20 and len(d) >= 3}
    return [
        (d, "\n".join(x for x in t.split("\n") if gone.get(x.strip(" \t\n\x0b\x0c\r").translate(UPPER), d) == d)) for d, t in docs
    ]
