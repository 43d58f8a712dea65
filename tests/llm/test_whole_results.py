"""Rows, digits and letters that earlier versions lost."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from weirgate.llm import knn, lines, tokens
from weirgate.llm.queries import plans


def plain_top(rows, step=50, k=5):
    """(query, rank, id, score) by whole numbers over all pairs of one length."""
    whole = [(i, [int(x) if abs(x) >= 2**52 else int(np.floor(x)) for x in np.array(v, dtype=np.float64) * 256]) for i, v in rows]
    out = []
    for q in {i for i, _ in whole if i % step == 0}:
        scored = [
            (-sum(a * b for a, b in zip(x, y)), j)
            for i, x in whole if i == q for j, y in whole if j != q and len(x) == len(y)
        ]
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k_of_large_mixed_and_repeated_vectors(spark):
    rng = random.Random(4)
    near = [[rng.uniform(60_000, 65_000) for _ in range(64)] for _ in range(60)]
    rows = [(i, near[i]) for i in range(60)]
    rows += [(100 + i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(55)]
    rows += [(200, [1.0, 2.0]), (201, [2.0**40, -1.0]), (202, [2.0**30, 5.5]), (250, [3.5]), (251, [1e13]), (300, [])]
    # The best candidate of query 100 and the query itself are given three times.
    best = [x * 9 for x in rows[60][1]]
    rows += [(199, best)] * 3 + [rows[60]] * 2
    # Another vector under a query's id.
    rows += [(150, [5.0, 5.0, 5.0]), (150, [4.0, 5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in knn.top_k(df).select("query_id", "rank", "vec_id", "score").collect())
    assert found == plain_top(rows)
    assert [r[1:3] for r in found if r[0] == 100] == [(i, 199) for i in range(1, 6)]


def test_products_beyond_a_long_fail(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<double>")
    try:
        knn.top_k(df).collect()
    except Exception as error:  # noqa: BLE001
        assert "does not fit" in str(error)
    else:
        raise AssertionError("no error")


def test_letters_of_newer_scripts_are_the_librarys():
    kinds = tokens.Splitter(tokens.letter_classes(brute.VOCABULARY)).kinds
    # Letters and numbers beyond Python's tables, and a sample of everything else.
    rng = random.Random(1)
    codes = [0x1C89, 0xA7CB, 0xA7DA, 0x105C0, 0x16D40, 0x11BF0]
    codes += [c for c in np.flatnonzero((kinds == tokens.LETTER) | (kinds == tokens.NUMBER)).tolist() if not chr(c).isalnum()][::3]
    codes += [c for c in (rng.randrange(0x110000) for _ in range(3000)) if not 0xD800 <= c < 0xE000]
    texts = [f"a {chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}1's {chr(c)}'{chr(c)}" for c in codes]
    assert tokens.compiled(brute.VOCABULARY).counts(texts).tolist() == brute.counts(texts)


def test_the_ratio_decides_on_small_hosts(spark):
    rows = plans.queries["op3_line_dedup"](spark, "/root/testdata/sf0.01")
    assert rows.agg(F.sum("n_dropped")).first()[0] > 700
    # A very long text, and a null host beside a host.
    long = "\n".join(f"line {i}" for i in range(60_000)) + "\nshared"
    df = spark.createDataFrame([(1, "h", long), (2, "h", "shared\nown"), (3, None, "shared\nown"), (4, None, None)], "id int, host string, text string")
    got = {r["id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in lines.line_dedup(df, "text", "host").collect()}
    assert got[1] == (60_001, 1, long[: -len("\nshared")]) and got[2] == (2, 1, "own")
    assert got[3] == (2, 0, "shared\nown") and got[4] == (1, 0, "")
