"""Best-fit packing with large-item matching, planned on the histogram of lengths.

How many pieces of each length there are decides the whole packing; which piece of a
length goes where does not matter. So only counts per length (at most ``capacity``
numbers) reach the driver. It matches pieces above a third of the capacity at most two to
a sequence, then best-fits the smaller ones into what is left, for all sequences of one
shape at once. Each piece then finds its place from its rank among pieces of its length.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.llm.common import filled, worker_store
from weirgate.llm.tokens import _byte_letters
from weirgate.session import cut_lineage

# Fixed value: the splitting pattern of byte-level BPE files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLACES = "sequence_id long, offset long"


def _encoder(path: str):
    store = worker_store()
    if ("encoder", path) not in store:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            source = json.load(file)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in source["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i
                 for token, i in source["model"]["vocab"].items() if token not in special}
        fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        store["encoder", path] = fast, Tokenizer.from_file(path)
    return store["encoder", path]


def token_ids(text: str, path: str) -> list[int]:
    """Ids of the text under the vocabulary file, special strings as the library reads them."""
    fast, library = _encoder(path)
    # Extremely long runs exceed the fast matcher's stack; the library takes those.
    if len(text) > 100_000:
        return library.encode(text, add_special_tokens=False).ids
    return fast.encode(text, allowed_special="all")


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: all full, the first one may be shorter."""
    if total <= capacity:
        return [total]
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def pieces_of(
    df: DataFrame, vocabulary: str, capacity: int, end_id: int, text: str = "text",
    keep: list[str] | None = None, with_ids: bool = False,
) -> DataFrame:
    """Token pieces of every document: ``keep`` columns, piece, start, length, ids_crc32."""
    kept = [c for c in (keep or ["doc_id"]) if c != text]
    inner = df.select(*[F.col(f"`{c}`") for c in kept], filled(text).alias("_w_text"))
    added = "piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    schema = T.StructType([*inner.schema.fields[:-1], *T.StructType.fromDDL(added).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            # Rows are taken a few at a time, so that ids of one batch stay small.
            for at in range(0, len(whole), 256):
                batch = whole.iloc[at : at + 256]
                rows, piece, start, length, crc, all_ids = [], [], [], [], [], []
                for row, body in enumerate(batch["_w_text"]):
                    ids = np.array([*token_ids(body, vocabulary), end_id], dtype="<u4")
                    begin = 0
                    for number, size in enumerate(cut_lengths(len(ids), capacity)):
                        part = ids[begin : begin + size]
                        rows.append(row)
                        piece.append(number)
                        start.append(begin)
                        length.append(size)
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            all_ids.append(part.astype("int32"))
                        begin += size
                out = batch[kept].iloc[rows].reset_index(drop=True)
                out["piece"], out["start"], out["length"], out["ids_crc32"] = piece, start, length, crc
                if with_ids:
                    out["ids"] = all_ids
                yield out

    return inner.mapInPandas(run, schema)


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, ...]], int]:
    """Segments (length, first rank, pieces, first bin, pieces per bin, offset), and the bins.

    The number of segments depends on the capacity, not on the number of pieces.
    """
    left = dict(counts)
    ranks = dict.fromkeys(counts, 0)
    segments: list[tuple[int, ...]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    open_gaps: list[int] = []
    bins = 0

    def put(length: int, number: int, base: int, per_bin: int, offset: int) -> None:
        segments.append((length, ranks[length], number, base, per_bin, offset))
        ranks[length] += number
        left[length] -= number

    def leave(gap: int, number: int, base: int) -> None:
        if number and gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(open_gaps, gap)
            gaps[gap].append((number, base))

    large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
    for a in large:
        partners = (b for b in large if b <= min(a, capacity - a))
        for b in partners:
            if not left[a]:
                break
            number = left[a] // 2 if a == b else min(left[a], left[b])
            if number:
                put(a, number, bins, 1, 0)
                put(b, number, bins, 1, a)
                leave(capacity - a - b, number, bins)
                bins += number
        if left[a]:
            number = left[a]
            put(a, number, bins, 1, 0)
            leave(capacity - a, number, bins)
            bins += number

    for s in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        while left[s]:
            at = bisect.bisect_left(open_gaps, s)
            if at == len(open_gaps):
                per_bin = capacity // s
                leave(capacity, max(1, left[s] // per_bin), bins)
                bins += max(1, left[s] // per_bin)
                continue
            gap = open_gaps[at]
            number, base = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                open_gaps.pop(at)
            per_bin = gap // s
            whole = min(number, left[s] // per_bin)
            if whole:
                put(s, whole * per_bin, base, per_bin, capacity - gap)
                leave(gap - per_bin * s, whole, base)
            if whole < number:
                rest = left[s]
                if rest:
                    put(s, rest, base + whole, rest, capacity - gap)
                    leave(gap - rest * s, 1, base + whole)
                    whole += 1
                leave(gap, number - whole, base + whole)
    return segments, bins


def ranks_in_length(pieces: DataFrame, order: list[str], total: int, rows_per_task: int = 20_000) -> DataFrame:
    """Add ``rank`` (from 0) among the pieces of a length; a frequent length spreads over tasks."""
    buckets = max(1, -(-total // rows_per_task))
    spread = pieces.withColumn("_w_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = spread.groupBy("length", "_w_bucket").agg(F.count("*").alias("_w_n"))
    before = Window.partitionBy("length").orderBy("_w_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "length", "_w_bucket", F.coalesce(F.sum("_w_n").over(before), F.lit(0)).alias("_w_before")
    )
    inside = Window.partitionBy("length", "_w_bucket").orderBy(*order)
    return (
        spread.withColumn("_w_row", F.row_number().over(inside))
        .join(offsets, ["length", "_w_bucket"])
        .withColumn("rank", F.col("_w_before") + F.col("_w_row") - 1)
        .drop("_w_bucket", "_w_row", "_w_before")
    )


def pack(
    df: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, id: str = "doc_id",
    text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Every document's pieces with their sequence and place in it.

    A document is its token ids and ``end_id``; null text counts as empty, so it is one
    piece of length 1. Only documents longer than ``capacity`` are cut. Repeated rows are
    packed once each; rows with a null id are packed too. Extra columns are not returned.
    ``with_ids`` adds the ids themselves. An empty table gives an empty table.
    """
    pieces = cut_lineage(
        pieces_of(df.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                  vocabulary, capacity, end_id, with_ids=with_ids)
    )
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    segments, _ = plan_bins(counts, capacity)
    ordered = np.array(sorted(segments), dtype=np.int64).reshape(-1, 6)
    lengths, first, _, base, per_bin, offset = ordered.T
    keys = (lengths << 44) | first
    ranked = ranks_in_length(pieces, ["doc_id", "piece", "ids_crc32"], sum(counts.values()))
    kept = [c for c in pieces.columns]
    schema = T.StructType([*pieces.schema.fields, *T.StructType.fromDDL(PLACES).fields])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            at = np.searchsorted(keys, (size << 44) | rank, side="right") - 1
            step = rank - first[at]
            out = batch[kept].copy()
            out["sequence_id"] = base[at] + step // per_bin[at]
            out["offset"] = offset[at] + step % per_bin[at] * size
            yield out

    return ranked.select(*kept, "rank").mapInPandas(place, schema)
