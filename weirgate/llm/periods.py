"""Periodic runs of words, found by branching tandem repeats in suffix arrays.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
equal) and length of at least ``max(6, 4 * q)`` that no neighbouring word extends. At the
right end of a run lies exactly one square whose two halves are followed by different
words: suffixes ``i`` and ``i + q`` then agree in exactly ``q`` words, so they lie in
different children of the LCP interval of depth ``q``. For each interval the suffixes of
the smaller child look up ``ISA[i + depth]`` and ``ISA[i - depth]``; a hit in the other
child is such a square, which is rotated to the left as far as words agree. Stretches found
with several periods keep the smallest.

The documents of an Arrow batch are one sequence whose words carry their document, so no
match crosses documents and numpy works on all of them at once. Suffixes are ordered by
doubling; only suffixes that still tie are sorted again. A document without two equal
four-word windows holds no run (a run repeats at least five words) and stops there.
Memory follows a batch, or its longest text: words times the logarithm of the longest repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_PERIODS = 4
# Bytes of text that are worked on together.
STEP_BYTES = 1 << 19

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order of the keys, the dense rank of each, and which of them share theirs."""
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), dtype=bool)
    new[:1] = True
    ordered = keys[order]
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(new) - 1
    last = np.append(new[1:], True)
    tied = np.empty(len(keys), dtype=bool)
    tied[order] = ~(new & last)
    return order, ranks, tied


def _refine(ranks: np.ndarray, tied: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by the first ``2 * width`` words from those by the first ``width``.

    A rank is the number of suffixes that are smaller for sure, so the ranks of suffixes
    that tie with nothing stay as they are.
    """
    n = len(ranks)
    open_ones = np.flatnonzero(tied)
    after = open_ones + width
    second = np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
    first = ranks[open_ones]
    order = np.lexsort((second, first))
    f, s = first[order], second[order]
    new_first = np.append(True, f[1:] != f[:-1])
    new = new_first | np.append(True, s[1:] != s[:-1])
    at = np.arange(len(f))
    start = np.maximum.accumulate(np.where(new, at, 0))
    group = np.maximum.accumulate(np.where(new_first, at, 0))
    out = ranks.copy()
    out[open_ones[order]] = f + (start - group)
    still = tied.copy()
    still[open_ones[order]] = ~(new & np.append(new[1:], True))
    return out, still


def _bounds(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each split ``k``: first and last place of the stretch around it in which it is
    the lowest value, ties belonging to the leftmost. Halving steps over a table of minima."""
    n = len(lcp)
    minima = [lcp]
    while (1 << len(minima)) <= n:
        half, low = 1 << (len(minima) - 1), minima[-1]
        minima.append(np.minimum(low[: len(low) - half], low[half:]))
    left, right = np.arange(n), np.arange(n)
    for level in range(len(minima) - 1, -1, -1):
        table, size = minima[level], 1 << level
        start = left - size
        ok = (start >= 0) & (table[np.maximum(start, 0)] > lcp)
        left = np.where(ok, start, left)
        fits = right + size < n
        ok = fits & (table[np.minimum(right + 1, len(table) - 1)] >= lcp)
        right = np.where(ok, right + size, right)
    return left, right


def _spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and offset of every element of ranges of these lengths."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a sequence of word numbers, by start and period.

    Documents may stand one after the other if they share no word number.
    """
    none = np.empty(0, dtype=np.int64)
    if len(words) < LEAST_WORDS:
        return none, none, none
    order, dense, tied = _ranked(words)
    sizes = np.bincount(dense)
    ranks = (np.cumsum(sizes) - sizes)[dense]
    levels, width = [ranks], 1
    while tied.any():
        ranks, tied = _refine(ranks, tied, width)
        levels.append(ranks)
        width *= 2
    n = len(words)
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[ranks] = np.arange(n)  # now every rank is a place
    # Common prefixes of neighbours: blocks of falling size that agree.
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    lcp = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(levels) - 2, -1, -1):
        size = 1 << level
        inside = (a < n) & (b < n)
        same = inside & (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)])
        step = np.where(same, size, 0)
        lcp += step
        a += step
        b += step
    low, high = _bounds(lcp)
    splits = np.flatnonzero(lcp > 0)
    low, high, depth = low[splits], high[splits], lcp[splits]
    # Suffixes low..split are one child, split+1..high+1 the other.
    left_size, right_size = splits - low + 1, high - splits + 1
    small_left = left_size <= right_size
    first = np.where(small_left, low, splits + 1)
    owner, offset = _spread(np.where(small_left, left_size, right_size))
    place = first[owner] + offset
    other_low = np.where(small_left, splits + 1, low)[owner]
    other_high = np.where(small_left, high + 1, splits)[owner]
    at, far = suffixes[place], depth[owner]
    found_at, found_far = [], []
    for shift, start in ((far, at), (-far, at - far)):
        there = at + shift
        ok = (there >= 0) & (there < n)
        rank = ranks[np.clip(there, 0, n - 1)]
        hit = ok & (rank >= other_low) & (rank <= other_high)
        found_at.append(start[hit])
        found_far.append(far[hit])
    square, period = np.concatenate(found_at), np.concatenate(found_far)
    # Rotate to the left while the words before both halves agree.
    moved = np.zeros(len(square), dtype=np.int64)
    for level in range(len(levels) - 2, -1, -1):
        size = 1 << level
        x = square - moved - size
        y = x + period
        same = (x >= 0) & (levels[level][np.maximum(x, 0)] == levels[level][np.maximum(y, 0)])
        moved += np.where(same, size, 0)
    start, end = square - moved, square + 2 * period
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # Of one stretch the first has the smallest period; the others are multiples of it.
    head = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(start) else none.astype(bool)
    length = end - start
    keep = head & (length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period))
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _runs_of(docs: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each document, with places counted inside it."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    total = int(sizes.sum())
    if not total:
        return out
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter((numbers[w] for d in docs for w in d), dtype=np.int64, count=total)
    doc = np.repeat(np.arange(len(docs)), sizes)
    ids += doc * len(numbers)
    # Two rounds tell windows of four words apart; whoever has no equal ones is done.
    _, dense, tied = _ranked(ids)
    counts = np.bincount(dense)
    ranks = (np.cumsum(counts) - counts)[dense]
    for width in (1, 2):
        if tied.any():
            ranks, tied = _refine(ranks, tied, width)
    busy = np.zeros(len(docs), dtype=bool)
    busy[doc[tied]] = True
    starts = np.cumsum(sizes) - sizes
    chosen = np.flatnonzero(busy)
    if not len(chosen):
        return out
    words = ids[busy[doc]]
    begin = np.cumsum(sizes[chosen]) - sizes[chosen]
    del doc, dense, starts
    start, length, period = find_runs(words)
    of = np.searchsorted(begin, start, side="right") - 1
    for d, s, size, q in zip(chosen[of].tolist(), (start - begin[of]).tolist(), length.tolist(), period.tolist(), strict=True):
        out[d].append((s, size, q))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those after the first period of a run."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k])


def planted(words: list[bytes], number: int | None) -> list[bytes]:
    """The words with a periodic tail, if the number (crc32 of the id) asks for one."""
    n = len(words)
    if number is None or number % 10 or not n:
        return words
    g = number // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    source = words[at : at + period]
    return words[:at] + (source * -(-(n - at) // period))[: n - at]


def collapse_runs(
    df: DataFrame, text: str = "text", keep: list[str] | None = None, plant: Column | None = None
) -> DataFrame:
    """``keep`` columns, ``runs`` (array of start, length, period) and ``collapsed``.

    Words are stretches of other bytes than space and ASCII controls 9 to 13; their order
    and case count. ``collapsed`` holds the words that stay, joined by one space. Rows are
    independent: repeated rows and null keys each give their row, an empty table an empty
    one. A null or empty text has no runs and collapses to the empty text; a very long
    text is one sequence, never cut. A kept column named like an added one gives way to it.
    ``plant``, a number for each row, first repeats words as :func:`planted` says.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("runs", "collapsed")]
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    number = F.lit(None).cast("long") if plant is None else plant.cast("long")
    inner = df.select(*[F.col(f"`{c}`") for c in kept], number.alias("_w_plant"), raw.alias("_w_raw"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[: len(kept)])
    schema = f"{fields}{', ' if fields else ''}runs array<{RUN}>, collapsed string"
    width = len(kept)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(width + 1)).to_pylist()
            start = 0
            while start < len(sizes):
                end, total = start, 0
                while end < len(sizes) and (end == start or total + sizes[end] <= STEP_BYTES):
                    total += sizes[end]
                    end += 1
                part = batch.slice(start, end - start)
                docs = [
                    planted(body.split(), x)
                    for body, x in zip(part.column(width + 1).to_pylist(), part.column(width).to_pylist(), strict=True)
                ]
                runs = _runs_of(docs)
                columns = [part.column(i) for i in range(width)]
                columns.append(pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs], run_type))
                columns.append(pa.array([_collapsed(d, rs) for d, rs in zip(docs, runs, strict=True)], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "runs", "collapsed"])
                start = end

    return inner.mapInArrow(work, schema)


def run_digests(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract's columns from :func:`collapse_runs`: count, strongest run and digests.

    Exponents are compared as fractions, by cross multiplication.
    """
    # A run beats the best so far by exponent, then by smaller start, then by smaller period.
    def better(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))
        return F.when(b["period"].isNull() | (a["period"].isNotNull() & ((x > y) | ((x == y) & ~earlier))), a).otherwise(b)

    nothing = F.lit(None).cast(RUN)
    best = F.aggregate("runs", nothing, lambda a, b: better(a, b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return df.withColumn("_w_best", best).select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_w_best.start").alias("start"),
        F.col("_w_best.length").alias("length"),
        F.col("_w_best.period").alias("period"),
        F.floor(F.col("_w_best.length") * 1000 / F.col("_w_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
