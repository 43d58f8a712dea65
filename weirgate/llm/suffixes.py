"""Removing repeated byte strings by sharded suffix arrays.

Every window of ``length`` bytes is owned by one anchor: the leftmost smallest hash of
``GRAM`` bytes in it. Equal windows have equal anchors, so a window can repeat only where
its anchor's hash does. Stretches of text whose windows are owned by a repeated anchor go
to the shard of that anchor; equal stretches are folded first, their earliest one stays.
A shard sorts its suffixes by Larsson-Sadakane refinement, takes common prefixes by
Kasai's rule, and marks every window but the earliest of each run of equal ones. An anchor
with very many different stretches is split over several shards; what these could not
refute among themselves is merged by range partitions and binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import filled, sized_side, written
from weirgate.llm.parity import mix64
from weirgate.session import cut_lineage

GRAM = 32
# Positions hashed in one go; position and hash share a word in the sliding minimum.
BLOCK_BITS = 20
BLOCK = (1 << BLOCK_BITS) - (1 << 12)
# Texts are hashed together up to this size: what numpy costs a call is spread, arrays stay in the cache.
PACK_BYTES = 1 << 16
# Base of the polynomials that tell stretches apart.
DIGEST_BASE = 0xD6E8FEB86659FD93
# Bytes of one shard (its arrays then stay in the cache), and stretches of one anchor in it.
SHARD_BYTES = 1 << 18
SHARD_STRETCHES = 4096
# Initial sort key: seven bytes, nine bits each, so that an end sorts before any byte.
FIRST_KEY = 7
# Positions after which the common prefixes of a stretch are compared from their first byte again.
STRIDE = 16


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position that has them."""
    count = len(data) - GRAM + 1
    # The eight bytes from every position as one word, read in place.
    eight = np.array(np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,)))
    out, part, high = (np.zeros(count, dtype=np.uint64) for _ in range(3))
    for i, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)):
        np.multiply(eight[8 * i : 8 * i + count], np.uint64(factor), out=part)
        np.right_shift(part, np.uint64(29), out=high)
        part ^= high
        out += part
    return mix64(out)


def owners(hashes: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first window, windows) of each run of windows with one owner, as positions.

    ``ends``: where each of the hashed texts ends; a window lies in one of them, and none is shorter than a window.
    """
    windows = len(hashes) + GRAM - length
    packed = hashes & np.uint64(~((1 << BLOCK_BITS) - 1) & (1 << 64) - 1)
    packed |= np.arange(len(hashes), dtype=np.uint64)
    reach, span = length - GRAM + 1, 1
    while 2 * span <= reach:
        packed = np.minimum(packed[:-span], packed[span:])
        span *= 2
    if span < reach:
        rest = reach - span
        packed = np.minimum(packed[: len(packed) - rest], packed[rest:])
    anchor = (packed[:windows] & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int32)
    for end in ends[:-1].tolist():
        anchor[end - length + 1 : end] = -1
    new = np.ones(windows, dtype=bool)
    np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, windows))
    whole = anchor[first] >= 0
    first, counts = first[whole], counts[whole]
    return anchor[first], first, counts


def stretch_digests(hashes: np.ndarray, first: np.ndarray, grams: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Digest of ``grams`` hashes from every ``first``: their polynomial modulo 2 ** 64, by prefix sums."""
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers[: len(hashes)], out=sums[1:])
    # The same power for the first hash of every stretch, wherever it starts.
    return mix64((sums[first + grams] - sums[first]) * powers[len(powers) - 1 - first])


def _packs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(doc, position in it, bytes) of blocks of texts that are hashed in one go."""
    docs, at, bodies, size = [], [], [], 0
    for batch in batches:
        for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = raw.as_py()
            for start in range(0, len(raw) - length + 1, BLOCK):
                body = raw[start : start + BLOCK + length - 1]
                if bodies and size + len(body) > PACK_BYTES:
                    yield np.array(docs), np.array(at), bodies
                    docs, at, bodies, size = [], [], [], 0
                docs.append(doc)
                at.append(start)
                bodies.append(body)
                size += len(body)
    if bodies:
        yield np.array(docs), np.array(at), bodies


def anchors(df: DataFrame, length: int, halves: bool = False, digests: bool = False) -> DataFrame:
    """(doc, hash, start, windows) of every text in ``_w_raw``, with the stretch's digest if asked.

    ``halves``: only the upper half of every hash instead.
    """
    names = ["half"] if halves else ["doc", "hash", "start", "windows", *["digest"] * digests]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in names]
        rows = 0
        powers = np.cumprod(np.full(1 << BLOCK_BITS if digests else 0, DIGEST_BASE, dtype=np.uint64))
        for docs, at, bodies in _packs(batches, length):
            raw = b"".join(bodies)
            ends = np.cumsum([len(body) for body in bodies])
            hashes = gram_hashes(np.frombuffer(raw, dtype=np.uint8))
            owner, first, windows = owners(hashes, ends, length)
            owning = hashes[owner].view(np.int64)
            if halves:
                columns = [(owning >> 32).astype(np.int32)]
            else:
                text = np.searchsorted(ends, first, side="right")
                begins = np.concatenate(([0], ends[:-1]))
                columns = [docs[text], owning, first - begins[text] + at[text], windows]
            if digests:
                columns.append(stretch_digests(hashes, first, windows + (length - GRAM), powers).view(np.int64))
            for column, values in zip(held, columns):
                column.append(values)
            rows += len(owning)
            if rows >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], names=names)
                held, rows = [[] for _ in names], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], names=names)

    schema = "half int" if halves else ", ".join(f"{n} long" for n in names)
    return df.select("doc", "_w_raw").mapInArrow(run, schema)


def suffix_order(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes' first ``depth`` bytes, and each one's rank.

    ``ends``: for every position, where its stretch ends; a suffix stops there. Refinement
    doubles the compared length and touches only groups that are not yet single and have
    bytes left to compare. Equal suffixes stand by position.
    """
    size = len(data)
    room = (ends - np.arange(size)).astype(np.int32)
    codes = np.zeros(size + FIRST_KEY - 1, dtype=np.int64)
    codes[:size] = data
    codes[:size] += 1
    key = codes[:size] << 9 * (FIRST_KEY - 1)
    for i in range(1, FIRST_KEY):
        key |= codes[i : i + size] << 9 * (FIRST_KEY - 1 - i)
    short = np.flatnonzero(room < FIRST_KEY)
    key[short] &= np.int64(-1) << 9 * (FIRST_KEY - room[short].astype(np.int64))
    order = np.argsort(key)
    key = key.take(order)
    # One more, never compared: the rank behind the last byte.
    rank = np.zeros(size + 1, dtype=np.int32)
    open_at, position, reach = np.arange(size), order, FIRST_KEY
    alike = []
    while True:
        head = np.ones(len(key), dtype=bool)
        np.not_equal(key[1:], key[:-1], out=head[1:])
        begins = np.flatnonzero(head)
        counts = np.diff(np.append(begins, len(key)))
        rank[position] = np.repeat(open_at[begins].astype(np.int32), counts)
        many = np.flatnonzero(np.repeat(counts > 1, counts))
        open_at, position = open_at.take(many), position.take(many)
        left = room.take(position)
        going = left >= reach
        alike.append(open_at[~going])
        open_at, position, left = open_at[going], position[going], left[going]
        if reach >= depth or not len(open_at):
            break
        second = rank.take(position + reach) + 1
        second[left == reach] = 0
        key = rank.take(position).astype(np.int64) << 32 | second
        resort = np.argsort(key)
        position, key = position.take(resort), key.take(resort)
        order[open_at] = position
        reach *= 2
    # Kasai's rule needs one order of equal suffixes.
    tied = np.sort(np.concatenate([*alike, open_at]))
    position = order[tied]
    order[tied] = position[np.argsort(rank[position].astype(np.int64) << 32 | position)]
    return order, rank[:size]


def common_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Length (at most ``limit``) each suffix shares with the one before it in ``order``.

    Kasai's rule: one position further, at most one byte is lost. It starts anew every
    STRIDE positions of a stretch, and all these pieces go on together.
    """
    size = len(data)
    # The first in order has the empty suffix behind the last byte before it.
    before = np.full(size, size, dtype=np.int64)
    before[order[1:]] = order[:-1]
    room = np.zeros(size + 1, dtype=np.int64)
    room[:size] = np.minimum(ends - np.arange(size), limit)
    padded = np.concatenate((data, np.zeros(16, dtype=np.uint8)))
    words = np.array(np.ndarray(size + 8, dtype="<u8", buffer=padded, strides=(1,)))
    shared = np.zeros(size, dtype=np.int64)
    lengths = ends[starts] - starts
    at = np.flatnonzero((np.arange(size) - np.repeat(starts, lengths)) % STRIDE == 0)
    stops, known = np.minimum(at + STRIDE, ends[at]), np.zeros(len(at), dtype=np.int64)
    while len(at):
        other = before.take(at)
        most = np.minimum(room.take(at), room.take(other))
        known = np.minimum(known, most)
        live = np.flatnonzero(known < most)
        here, there, bound = (at + known)[live], (other + known)[live], most[live]
        gained = np.zeros(len(live), dtype=np.int64)
        bound -= known[live]
        open_at = np.arange(len(live))
        while len(open_at):
            differ = words.take(here) ^ words.take(there)
            # Equal bytes before the lowest differing one.
            equal = (np.bitwise_count(~differ & (differ - np.uint64(1))) >> 3).astype(np.int64)
            gained[open_at] += equal
            on = np.flatnonzero((equal == 8) & (gained[open_at] < bound[open_at]))
            open_at, here, there = open_at[on], here[on] + 8, there[on] + 8
        known[live] += np.minimum(gained, bound)
        shared[at] = known
        going = at + 1 < stops
        at, known, stops = at[going] + 1, np.maximum(known[going] - 1, 0), stops[going]
    return shared


def repeated_windows(
    bodies: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a shard: (stretch, window in it, is it repeated).

    Of each class of equal windows the earliest by (document, start) is not repeated.
    """
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    stretch = np.repeat(np.arange(len(bodies)), sizes)
    ends = offsets[1:][stretch]
    # Sorted to the end of every stretch: Kasai's rule needs the true order.
    order, _ = suffix_order(data, ends, int(sizes.max()))
    shared = common_prefixes(data, offsets[:-1], ends, order, length)
    inside = np.arange(len(data)) - offsets[:-1][stretch]
    whole = ends - np.arange(len(data)) >= length
    ordered = order[whole[order]]
    # Whole windows that are equal are neighbours: a shorter suffix sorts before them.
    heads = shared[ordered] < length
    begins = np.flatnonzero(heads)
    counts = np.diff(np.append(begins, len(ordered)))
    owner, window = stretch[ordered], inside[ordered]
    # Only in classes of several windows the earliest is sought.
    several = np.flatnonzero(np.repeat(counts > 1, counts))
    klass = (np.cumsum(heads) - 1)[several]
    by = np.lexsort((starts[owner[several]] + window[several], docs[owner[several]], klass))
    repeated = np.zeros(len(ordered), dtype=bool)
    repeated[several[by[1:]]] = klass[by[1:]] == klass[by[:-1]]
    return owner, window, repeated


def _spans(docs: np.ndarray, windows: np.ndarray, length: int) -> pd.DataFrame:
    """Byte spans that runs of removed windows cover."""
    order = np.lexsort((windows, docs))
    docs, windows = docs[order], windows[order]
    if not len(docs):
        return pd.DataFrame({"doc": docs, "a": windows, "b": windows})
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (windows[1:] > windows[:-1] + 1)
    last = np.append(new[1:], True)
    return pd.DataFrame({"doc": docs[new], "a": windows[new], "b": windows[last] + length})


SPANS = "doc long, a long, b long, window binary, at long"


def _shard(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        split = bool(group["split"].iloc[0])
        docs, starts = group["doc"].to_numpy(), group["start"].to_numpy()
        bodies = [bytes(b) for b in group["body"]]
        stretch, inside, repeated = repeated_windows(bodies, docs, starts, length)
        gone = _spans(docs[stretch[repeated]], starts[stretch[repeated]] + inside[repeated], length)
        gone["window"], gone["at"] = None, 0
        if split:
            # First of its class here, perhaps not in the anchor's other shards.
            left = np.flatnonzero(~repeated)
            open_rows = pd.DataFrame({
                "doc": docs[stretch[left]], "a": 0, "b": 0,
                "window": [bodies[s][i : i + length] for s, i in zip(stretch[left], inside[left])],
                "at": starts[stretch[left]] + inside[left],
            })
            gone = pd.concat([gone, open_rows], ignore_index=True)
        return gone

    return run


def _merge(open_rows: DataFrame, length: int) -> DataFrame:
    """Spans of windows that an earlier shard of the anchor holds too.

    Range partitions hold neighbouring strings of all shards; inside one, each string finds
    its first occurrence by binary search in the sorted batch.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            keys = batch["window"].map(bytes).to_numpy(dtype=object)
            where = np.searchsorted(keys, keys, side="left")
            repeated = where < np.arange(len(keys))
            if last is not None and len(keys):
                repeated[: np.searchsorted(keys, last, side="right")] = True
            if len(keys):
                last = keys[-1]
            yield _spans(batch["doc"].to_numpy()[repeated], batch["at"].to_numpy()[repeated], length)

    return (
        open_rows.repartitionByRange("window").sortWithinPartitions("window", "doc", "at")
        .select("window", "doc", "at").mapInPandas(run, "doc long, a long, b long")
    )


def _bodies(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """(split, shard, doc, start, body) of the placed stretches.

    What is wanted of a text goes to it where the measured size allows; else each text moves once.
    """
    per_doc = placed.groupBy("doc").agg(F.collect_list(F.struct("split", "shard", "start", "size")).alias("runs"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 64):
                batch = whole.iloc[at : at + 64]
                rows = [
                    (r["split"], r["shard"], doc, r["start"], raw[r["start"] : r["start"] + r["size"]])
                    for doc, raw, runs in zip(batch["doc"], batch["_w_raw"], batch["runs"]) for r in runs
                ]
                yield pd.DataFrame(rows, columns=["split", "shard", "doc", "start", "body"])

    wanted = sized_side(per_doc, F.size("runs") * 32 + 32)
    return texts.join(wanted, "doc").mapInPandas(run, "split boolean, shard long, doc long, start long, body binary")


def removed_spans(texts: DataFrame, length: int) -> DataFrame:
    """(doc, a, b): spans of bytes covered by a window that starts earlier too; they may overlap.

    ``texts``: (doc, _w_raw binary), doc unique and ascending in the order that counts.
    Stretches are the same if their anchor's hash, their size and their digest are, 128 bits
    in all. Only stretches that are the first of several different ones of an anchor become
    bytes again.
    """
    long_enough = texts.where(F.octet_length("_w_raw") >= length)
    # Only whether a hash repeats counts; half of it is enough to sift.
    half = F.shiftright("hash", 32).cast("int")
    often = (
        anchors(long_enough, length, halves=True).groupBy(F.col("half").alias("_w_half")).agg(F.count("*").alias("n"))
        .where("n > 1").select("_w_half")
    )
    named = written(
        anchors(long_enough, length, digests=True).join(often, half == often["_w_half"])
        .select("hash", "digest", (F.col("windows") + (length - 1)).alias("size"), "doc", "start")
    )
    # Equal stretches of an anchor: all but the earliest are repeated as a whole.
    same = ["hash", "digest", "size"]
    leaders = written(
        named.groupBy(*same).agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n"))
        .select(*same, "first.*", "n")
    )
    earliest = leaders.where("n > 1").select(*same, F.col("doc").alias("_w_doc"), F.col("start").alias("_w_start"))
    members = (
        named.join(earliest, same)
        .where((F.col("doc") != F.col("_w_doc")) | (F.col("start") != F.col("_w_start")))
        .select("doc", F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b"))
    )
    several = leaders.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    open_ones = written(leaders.drop("n").join(several, "hash"))
    total = open_ones.agg(F.sum("size").alias("s")).first()["s"] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    pieces = F.ceil(F.col("n") / SHARD_STRETCHES).cast("int")
    placed = open_ones.select(
        "doc", "start", "size",
        (F.col("n") > SHARD_STRETCHES).alias("split"),
        F.when(F.col("n") > SHARD_STRETCHES, F.xxhash64("hash", F.pmod(F.xxhash64("digest"), pieces)))
        .otherwise(F.pmod(F.xxhash64("hash"), F.lit(shards)))
        .alias("shard"),
    )
    solved = written(
        _bodies(placed, long_enough).groupBy("split", "shard").applyInPandas(_shard(length), SPANS)
    )
    merged = _merge(solved.where(F.col("window").isNotNull()), length)
    return members.union(solved.where(F.col("window").isNull()).select("doc", "a", "b")).union(merged)


KEPT = "n_removed long, n_spans long, kept_sha256 string"


def _cut(raw: bytes, runs) -> tuple[int, int, str]:
    if runs is None or not len(runs):
        return 0, 0, hashlib.sha256(raw).hexdigest()
    digest, at, removed, spans = hashlib.sha256(), 0, 0, 0
    end = -1
    for a, b in sorted((r["a"], r["b"]) for r in runs):
        if a > end:
            digest.update(raw[at:a])
            spans += 1
            removed += b - a
        elif b > end:
            removed += b - end
        end = max(end, b)
        at = end
    digest.update(raw[at:])
    return removed, spans, digest.hexdigest()


def drop_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A byte goes when a string of ``length`` bytes over it also starts earlier: in a smaller
    id, or earlier in the text. Null counts as empty, texts shorter than ``length`` lose
    nothing. Where an id repeats, only its smallest text takes part, and rows of that id
    with another text, like rows without an id, keep all their bytes; repeated rows get the
    same result. Extra columns are not read. An empty table gives an empty table.
    """
    rows = df.select(F.col(f"`{id}`").cast("long").alias("doc"), filled(text).cast("binary").alias("_w_raw"))
    keyed = rows.withColumn("digest", F.md5("_w_raw"))
    thin = cut_lineage(
        keyed.where(F.col("doc").isNotNull())
        .groupBy("doc", "digest", F.octet_length("_w_raw").cast("long").alias("size")).agg(F.count("*").alias("n"))
    )
    own = thin.groupBy("doc").agg(F.min(F.struct("digest", "size")).alias("x")).select("doc", "x.*")
    # Equal texts: the first stands for all; of the others everything is repeated.
    leaders = own.groupBy("digest").agg(F.min("doc").alias("leader"))
    copies = own.join(leaders, "digest").where(F.col("leader") != F.col("doc")).select("doc", "digest", "size")
    others = thin.join(own, ["doc", "digest"], "left_anti").select("doc", "digest")
    left_out = copies.select("doc", "digest").union(others)
    # A repeated row takes part once: removed_spans needs doc to be unique.
    again = cut_lineage(thin.where("n > 1").select("doc", "digest").join(left_out, ["doc", "digest"], "left_anti"))
    aside = sized_side(left_out.union(again), F.lit(56))
    texts = keyed.where(F.col("doc").isNotNull()).join(aside, ["doc", "digest"], "left_anti").select("doc", "_w_raw")
    if not again.isEmpty():
        once = keyed.join(sized_side(again, F.lit(56)), ["doc", "digest"], "left_semi").dropDuplicates(["doc", "digest"])
        texts = texts.union(once.select("doc", "_w_raw"))
    whole = copies.where(F.col("size") >= length).select("doc", F.lit(0).cast("long").alias("a"), F.col("size").alias("b"))
    merged = removed_spans(texts, length).union(whole).groupBy("doc").agg(
        F.collect_list(F.struct("a", "b")).alias("runs")
    )
    marked = sized_side(
        merged.join(own.select("doc", "digest"), "doc"), F.size("runs") * 16 + 64
    )
    both = keyed.join(marked, ["doc", "digest"], "left").select("doc", "_w_raw", "runs")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = [_cut(bytes(raw), runs) for raw, runs in zip(batch["_w_raw"], batch["runs"])]
            yield pd.DataFrame({
                "doc_id": batch["doc"].astype("Int64"),
                "n_bytes": [len(x) for x in batch["_w_raw"]],
                "n_removed": [c[0] for c in cut], "n_spans": [c[1] for c in cut],
                "kept_sha256": [c[2] for c in cut],
            })

    return both.mapInPandas(run, f"doc_id long, n_bytes long, {KEPT}")
