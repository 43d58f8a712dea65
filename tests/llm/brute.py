"""Plain versions of the corpus operators, to hold small results against."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

VOCABULARY = path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    """doc -> (bytes, removed, spans, sha256 of the rest); ids are unique."""
    seen: set[bytes] = set()
    out = {}
    for doc, text in sorted(docs):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        gone = gone[:-1]
        spans = int(np.sum(gone & ~np.concatenate(([False], gone[:-1])))) if len(raw) else 0
        rest = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        out[doc] = len(raw), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()
    return out


def shingles(text: str | None) -> frozenset:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similar(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc -> (number of shingles, smallest doc of its component), by all pairs that share one."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders: dict = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    pairs = {(a, b) for group in holders.values() for i, a in enumerate(group) for b in group[i + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def best_scores(vectors: list[tuple[int, list | None]], k: int = 5, step: int = 50) -> list[tuple]:
    good = []
    for i, v in vectors:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for q, v in good:
        if q % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def counts(texts: list[str]) -> list[int]:
    library = Tokenizer.from_file(VOCABULARY)
    return [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def check_packing(docs: list[tuple], rows: list[dict], capacity: int = 1024, end: int = 2) -> int:
    """Assert that rows pack the documents rightly; the number of sequences."""
    library = Tokenizer.from_file(VOCABULARY)
    wanted = []
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        first = len(ids) % capacity if len(ids) > capacity else len(ids)
        cuts = ([first] if first else []) + ([capacity] * (len(ids) // capacity) if len(ids) > capacity else [])
        begin = 0
        for piece, size in enumerate(cuts):
            part = np.array(ids[begin : begin + size], dtype="<u4")
            wanted.append((doc, piece, begin, size, zlib.crc32(part.tobytes())))
            begin += size
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted((tuple(r[n] for n in names) for r in rows), key=key) == sorted(wanted, key=key)
    places: dict[int, list] = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for sequence in places.values():
        at = 0
        for offset, size in sorted(sequence):
            assert offset == at
            at += size
        assert at <= capacity
    return len(places)
