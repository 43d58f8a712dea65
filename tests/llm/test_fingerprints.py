"""Fingerprints and likenesses against plain sets, by either way to the lexicon."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weirgate.llm import fingerprints

# Underscores part terms too.
TERM = re.compile(r"[^\W_]+")


def made(rng):
    texts = [" ".join(f"t{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(80))) for _ in range(90)]
    return [*texts, texts[3], texts[3].upper(), "", None, "...", "lone Word"]


def plain_likeness(a, b, lexicon, codes):
    names = []
    for words in (a, b):
        inside = sorted(codes[w] for w in words & lexicon)
        sets = [frozenset(inside)] + [
            frozenset(c for c in inside if c >> 4 * chain & 15 >= level)
            for chain in range(fingerprints.CHAINS) for level in range(1, fingerprints.LEVELS + 1)
        ]
        names.append(sets if inside else [frozenset(words)] + [frozenset()] * (fingerprints.SUBSETS - 1))
    met = [(x, y) for x, y in zip(*names, strict=True) if x or y]
    return sum(x == y for x, y in met) / len(met) if met else 1.0


def test_likeness_is_that_of_the_sets(spark, monkeypatch):
    texts = made(random.Random(2))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    low, high = 0.05, 0.4
    words = [set(TERM.findall((t or "").lower())) for t in texts]
    counts = Counter(w for ws in words for w in ws)
    lexicon = {w for w, n in counts.items() if max(2, low * len(texts)) <= n <= max(2, high * len(texts))}
    every = spark.createDataFrame([(w,) for w in counts], "w string")
    codes = {r.w: r.c for r in every.select("w", fingerprints.code_of(F.xxhash64("w")).alias("c")).collect()}
    depths = np.array([[c >> 4 * n & 15 for n in range(fingerprints.CHAINS)] for c in codes.values()])
    assert depths.max() <= 10 and 0.3 < (depths >= 1).mean() < 0.7
    wanted = {}
    for i, text in enumerate(texts):
        text, after = text or "", texts[(i - 1) % len(texts)] or ""
        tail = len(text) // 3
        edited = set(TERM.findall((text[: len(text) - tail] + after[:tail]).lower()))
        wanted[i] = (
            round(plain_likeness(words[i], edited, lexicon, codes), 9),
            round(plain_likeness(words[i], words[(i - 1) % len(texts)], lexicon, codes), 9),
        )
    found = fingerprints.edited_fingerprints(df, low=low, high=high).orderBy("doc_id").collect()
    assert {r.doc_id: (round(r.near_edited, 9), round(r.near_next, 9)) for r in found} == wanted
    monkeypatch.setattr(fingerprints.with_hashes, "__defaults__", (0,))
    assert fingerprints.edited_fingerprints(df, low=low, high=high).orderBy("doc_id").collect() == found


def test_every_term_is_in_its_table():
    rng = random.Random(3)
    for n in (0, 1, 30, 5000):
        terms = {rng.randrange(-(2**63), 2**63) for _ in range(n)} | ({5, 5 + 2**40} if n else set())
        table = fingerprints.term_table(list(terms))
        values = np.array(sorted(terms), dtype=np.int64)
        first, second = fingerprints._places(values, len(table))
        marks = np.array([fingerprints._mark(t) for t in values.tolist()], dtype=np.int32)
        assert np.count_nonzero(table) == len(terms)
        assert np.all((table[first] == marks) | (table[second] == marks)) if n else True
