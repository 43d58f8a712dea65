"""Periodic runs against a plain scan over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from weirgate.llm import periods
from weirgate.llm.queries import plans

SCHEMA = "doc_id long, text string, runs string, collapsed int, n_runs int"
SF = "/root/testdata/sf0.001"


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q - s), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc, text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_runs_match_plain_scan():
    rng = random.Random(4)
    for _ in range(1500):
        words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(70))]
        if len(words) > 10 and rng.random() < 0.6:
            q, at = rng.randrange(1, 9), rng.randrange(len(words))
            for i in range(at + q, len(words)):
                words[i] = words[i - q]
        got = periods.find_runs(np.array(words, dtype=np.int64))
        assert list(zip(*(x.tolist() for x in got), strict=True)) == plain_runs(words)


def test_documents_do_not_touch():
    docs = [[b"a"] * 5, [b"a"] * 5, [b"a"] * 6, [], [b"x", b"y"] * 4, [b"x", b"y"] * 3]
    assert periods._runs_of(docs) == [[], [], [(0, 6, 1)], [], [(0, 8, 2)], []]


def test_odd_tables(spark):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "a", "no no no no no no", "NO no " * 4, "a b " * 9 + "c " * 7 + "d"]
    texts += [" ".join(f"w{rng.randrange(3)}" for _ in range(90)) for _ in range(40)]
    texts += [" ".join(f"w{rng.randrange(900)}" for _ in range(300)) for _ in range(20)]
    # Unicode and control spaces do not part words.
    texts += ["a b a b a  " * 8, "x\x1cy x\x1cy\x85 " * 7, "é ü " * 5]
    rows = [(i, t, "r", 1, 2) for i, t in enumerate(texts)]
    rows += [(None, "z " * 8, "r", 1, 2), rows[6], rows[6]]
    number = "crc32(cast(cast(doc_id as string) as binary))"
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    got = periods.run_digests(periods.collapse_runs(df, keep=["doc_id"], plant=F.expr(number))).collect()
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *plain_row(r[0], r[1])) for r in rows), key=key)
    assert periods.collapse_runs(spark.createDataFrame([], SCHEMA)).count() == 0
    # Kept columns that clash give way to the operator's.
    assert periods.collapse_runs(df).columns == ["doc_id", "text", "n_runs", "runs", "collapsed"]


def test_very_long_text(spark):
    words = [f"w{i * i % 9973}" for i in range(120_000)]
    words[50_000:90_000] = ["p", "q", "r", "s"] * 10_000
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periods.collapse_runs(df).first()
    # The squares mod 9973 repeat 12 times themselves, cut in two by the planted run.
    assert (50_000, 40_000, 4) in [tuple(r) for r in row["runs"]]
    assert all(n >= 4 * q for _, n, q in map(tuple, row["runs"]))


def test_query_matches_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in plans.queries["op13_periodic_runs"](spark, SF).collect()}
    assert any(r[0] for r in got.values())
    for doc, text in rows:
        if len(text or "") < 20_000:
            assert got[doc] == plain_row(doc, text)
