"""Near-duplicate join on word shingles by parity sketches.

A set's shingle hashes are dealt to parts; a part's word is the XOR of its hashes, that is
the fingerprint of its parity bits. A shingle that only one of two sets holds changes one
part, so the parts that differ are at most the symmetric difference, which a similarity of
at least 0.8 bounds by a quarter of either set. By the pigeonhole principle two such sets
agree on a part among the first (bound + 1) non-empty parts of each, in any order that
depends on the part alone. Parts known from a sample to be frequent come last in that
order, and parts of several shingles first, since they tell more.

Sets of like size share the number of parts (size bands of a factor two; a set less than a
quarter below the next band joins both). Pairs that agree on a part are checked by the
Hamming distance of parity bit sketches and then by exact set intersection. Sets that are
equal are one node. Within a group of sets that share a part, only a star is checked at
first; then all pairs that the links found so far leave in different components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import BROADCAST_BYTES, STEP_CHARS, filled, map_texts
from weirgate.llm.graph import components, tasks_for
from weirgate.session import cut_lineage

WORDS = 5
# Similarity of at least PERCENT / 100; the bounds below hold for 80 and more.
PERCENT = 80
SKETCH_BITS = 2048
# Sets below this size have one shingle per part.
SMALL = 64
# Documents whose parts are counted to find frequent ones, and the count that makes one.
# Only the order of parts depends on it, never the result.
SAMPLE_DOCS, FREQUENT = 1 << 14, 6
PAIR_BYTES = 16
# Rounds in which open sets meet one set of the group's largest component.
HUB_ROUNDS = 1
# Groups up to this size are joined; larger ones are compared in blocks of sketches.
SMALL_GROUP, SKETCH_BLOCK = 32, 2048

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + _M1
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct word-shingle hashes of many texts at once."""

    def __init__(self) -> None:
        self.values = mix64(np.arange(256, dtype=np.uint64) + np.uint64(977))
        self.lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)
        self.shifts = [np.uint64(c) for c in mix64(np.arange(64, dtype=np.uint64)) | np.uint64(1)]

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, 4 * STEP_CHARS)
            factor = 0x5851F42D4C957F2D
            inverse = pow(factor, -1, 1 << 64)
            for name, number in (("powers", factor), ("inverses", inverse)):
                steps = np.full(size, number, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and where each text's words begin (one more at the end)."""
        raw = [t.encode() for t in texts]
        joined = (b"\n".join([*raw, b""])).translate(self.lower)
        data = np.frombuffer(joined, dtype=np.uint8)
        self._grow(len(data) + 1)
        blank = self.blank[data]
        starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
        stops = np.flatnonzero(blank & ~np.concatenate(([True], blank[:-1])))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.values[data] * self.powers[: len(data)])))
        hashes = mix64((sums[stops] - sums[starts]) * self.inverses[starts] + (stops - starts).astype(np.uint64))
        edges = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
        return hashes, np.searchsorted(starts, edges)

    def sets(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        hashes, edges = self.words(texts)
        runs = np.zeros(0, dtype=np.uint64)
        if len(hashes) >= WORDS:
            count = len(hashes) - WORDS + 1
            runs = sum((hashes[i : i + count] * self.shifts[i] for i in range(WORDS)), np.zeros(count, np.uint64))
            runs = mix64(runs)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(runs[a : b - WORDS + 1])
            elif b > a:
                short = hashes[a:b] * np.array(self.shifts[8 : 8 + b - a])
                yield mix64(np.add.reduce(short, keepdims=True) + np.uint64(b - a))
            else:
                yield runs[:0]


def set_key(shingles: np.ndarray) -> int:
    """64-bit name of a set."""
    if not len(shingles):
        return 0
    total = np.array([np.add.reduce(mix64(shingles)) + np.uint64(len(shingles))], dtype=np.uint64)
    return int(mix64(total).view(np.int64)[0])


def parts_of(shingles: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, shingles per part) of the non-empty parts, for each size band of the set."""
    n = len(shingles)
    if n < SMALL:
        yield mix64(shingles ^ np.uint64(1)), np.ones(n, dtype=np.int64)
        if n * 5 < SMALL * 4:
            return
    octave = n.bit_length() - 1
    bands = [octave] if n >= SMALL else []
    if n * 5 >= (2 << octave) * 4:
        bands.append(octave + 1)
    for band in bands:
        parts = np.uint64(3 << (band - 2))
        where = (shingles >> np.uint64(20)) % parts
        order = np.argsort(where, kind="stable")
        where = where[order]
        first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        words = np.bitwise_xor.reduceat(shingles[order], first)
        yield mix64(words ^ mix64(where[first] + (np.uint64(band) << np.uint64(40)))), np.diff(np.append(first, n))


def signatures(shingles: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signatures a set is joined on, whether each is known to be frequent)."""
    found, hot = [], []
    bound = len(shingles) // 4
    for words, counts in parts_of(shingles):
        common = np.zeros(len(words), dtype=bool)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
            common = frequent[at] == words
        chosen = np.lexsort((words, -counts, common))[: bound + 1]
        found.append(words[chosen])
        hot.append(common[chosen])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    return np.concatenate(found), np.concatenate(hot)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits; their Hamming distance is at most the symmetric difference."""
    bits = np.bincount((shingles >> np.uint64(3)).astype(np.int64) & (SKETCH_BITS - 1), minlength=SKETCH_BITS)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def _emit(df: DataFrame, frequent: np.ndarray, every_part: bool = False) -> DataFrame:
    """(sig, key, hot) rows of every non-empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= STEP_CHARS):
                    size += len(texts[end])
                    end += 1
                sigs, keys, hots = [], [], []
                for shingles in shingler.sets(texts[at:end]):
                    if not len(shingles):
                        continue
                    if every_part:
                        found = np.concatenate([w for w, _ in parts_of(shingles)])
                        hot = np.zeros(len(found), bool)
                    else:
                        found, hot = signatures(shingles, frequent)
                    sigs.append(found.view(np.int64))
                    hots.append(hot)
                    keys.append(np.full(len(found), set_key(shingles), dtype=np.int64))
                if sigs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (sigs, keys, hots)], names=["sig", "key", "hot"]
                    )
                at = end

    return df.select("_w_text").mapInArrow(run, "sig long, key long, hot boolean")


def _repeated(emitted: DataFrame) -> DataFrame:
    """Rows whose signature occurs with two keys. Sorted rows stream by; nothing is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig, last_key = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            # The last row goes along; a row given twice is folded by the caller.
            sig = np.concatenate((last_sig, batch.column(0).to_numpy()))
            key = np.concatenate((last_key, batch.column(1).to_numpy()))
            border = (sig[1:] == sig[:-1]) & (key[1:] != key[:-1])
            out = np.zeros(len(sig), dtype=bool)
            out[1:] |= border
            out[:-1] |= border
            last_sig, last_key = sig[-1:], key[-1:]
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[out]), pa.array(key[out])], names=["sig", "key"])

    return (
        emitted.select("sig", "key")
        .repartition("sig")
        .sortWithinPartitions("sig", "key")
        .mapInArrow(run, "sig long, key long")
    )


def _frequent(df: DataFrame, total: int) -> np.ndarray:
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    sample = df.where(F.pmod(F.xxhash64("_w_text", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30)))
    counted = (
        _emit(sample, np.zeros(0, np.uint64), every_part=True)
        .groupBy("sig").agg(F.count_distinct("key").alias("n")).where(F.col("n") >= FREQUENT)
    )
    # At most the parts of the sampled documents / FREQUENT numbers.
    return np.sort(np.array([r["sig"] for r in counted.collect()], dtype=np.int64).view(np.uint64))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough: sketches first, then the sets themselves."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("an"), F.col("sketch").alias("ask"), F.col("shingles").alias("ash"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("bn"), F.col("sketch").alias("bsk"), F.col("shingles").alias("bsh"))
    both = F.col("an") + F.col("bn")
    distance = F.aggregate(
        F.zip_with("ask", "bsk", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    near = (
        pairs.join(left.select("a", "an", "ask"), "a").join(right.select("b", "bn", "bsk"), "b")
        # similar enough: difference * (100 + PERCENT) <= (100 - PERCENT) * (sum of sizes)
        .where(F.least("an", "bn") * 100 >= F.greatest("an", "bn") * PERCENT)
        .where(distance * (100 + PERCENT) <= (100 - PERCENT) * both)
        .select("a", "b")
    )
    near = cut_lineage(near)
    rows = near.count()
    near = near.coalesce(tasks_for(rows))
    # The few pairs go to the sets where their measured size allows, not the sets to the pairs.
    side = F.broadcast(near) if rows * PAIR_BYTES <= BROADCAST_BYTES else near
    shared = F.size(F.array_intersect("ash", "bsh"))
    return cut_lineage(
        left.select("a", "an", "ash").join(side, "a")
        .join(right.select("b", "bn", "bsh").join(side, "b"), ["a", "b"])
        .where(shared * 100 >= PERCENT * (both - shared))
        .select("a", "b").coalesce(tasks_for(rows))
    )


def similar_components(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are separated by ASCII blanks and lower-cased in A-Z; fewer than five words are
    one shingle; an empty or null text has none and links with nothing. Equal sets link, so
    repeated rows and ids do; rows whose id is null keep a null component and lend none.
    Extra columns are not read. An empty table gives an empty table. Shingles and sets are
    named by 64-bit hashes.
    """
    rows = df.select(F.col(f"`{id}`").alias("doc_id"), filled(text).alias("_w_text"))

    def make():
        shingler = Shingler()

        def run(texts: list[str]) -> list:
            sets = list(shingler.sets(texts))
            return [[len(s) for s in sets], [set_key(s) for s in sets]]

        return run

    thin = cut_lineage(map_texts(rows, "_w_text", make, "n_shingles long, key long", ["doc_id"]))
    nodes = (
        thin.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    )
    emitted = _emit(rows, _frequent(rows, thin.count()))
    # Frequent parts need no count, and would gather in one sorted run.
    shared = cut_lineage(
        _repeated(emitted.where(~F.col("hot"))).union(emitted.where("hot").select("sig", "key")).distinct()
    )
    tasks = tasks_for(shared.count())
    shared = shared.coalesce(tasks)
    live = cut_lineage(shared.select("key").distinct().coalesce(tasks).join(nodes, "key"))
    rows_live = live.count()
    live = live.coalesce(tasks_for(rows_live))
    # The wanted ids go to the texts where their measured size allows, so that no text is shuffled.
    side = F.broadcast(live) if rows_live * PAIR_BYTES <= BROADCAST_BYTES else live

    def make_sets():
        shingler = Shingler()

        def run(texts: list[str]) -> list:
            sets = list(shingler.sets(texts))
            return [
                [set_key(s) for s in sets], [len(s) for s in sets],
                [bit_sketch(s) for s in sets], [s.view(np.int64) for s in sets],
            ]

        return run

    wanted = rows.join(side.select("doc_id"), "doc_id").select("_w_text")
    sets = cut_lineage(
        map_texts(wanted, "_w_text", make_sets, "key long, n long, sketch array<long>, shingles array<long>", [])
        .join(side.select("key"), "key", "left_semi")
        .dropDuplicates(["key"])
    )

    def star(leader) -> DataFrame:
        centres = shared.groupBy("sig").agg(leader("key").alias("centre"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        return (
            shared.join(centres.where("lo <> hi").select("sig", "centre"), "sig")
            .where(F.col("key") != F.col("centre"))
            .select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b"))
            .distinct().coalesce(tasks)
        )

    links = _links(star(F.min), sets)
    found = components(links)
    for number in range(HUB_ROUNDS):
        more = _links(_hub_pairs(shared, found, number).coalesce(tasks), sets)
        if more.isEmpty():
            break
        links = cut_lineage(links.union(more))
        found = components(links)
    rest = _links(_open_pairs(shared, found, sets, tasks), sets)
    if not rest.isEmpty():
        found = components(links.union(rest))
    named = thin.join(found, thin["key"] == found["node"], "left").withColumn(
        "key", F.coalesce("component", "key")
    )
    least = named.where(F.col("doc_id").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("component_id"))
    linked = named.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).join(least, "key")
    alone = named.where((F.col("n_shingles") == 0) | F.col("doc_id").isNull())
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).union(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _open(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(sig, key, part) of signatures whose sets lie in several components."""
    tagged = shared.join(found, shared["key"] == found["node"], "left").select(
        "sig", "key", F.coalesce("component", "key").alias("part")
    )
    several = tagged.groupBy("sig").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
    return tagged.join(several, "sig")


def _hub_pairs(shared: DataFrame, found: DataFrame, number: int) -> DataFrame:
    """Each open set with one set of the component that most sets of a signature are in.

    Signatures choose their hubs by hash, so a set that shares many meets many hubs.
    """
    several = cut_lineage(_open(shared, found))
    hubs = (
        several.groupBy("sig", "part")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("key", "sig", F.lit(number)).alias("h"), "key")).alias("x"))
        .groupBy("sig").agg(F.max(F.struct("n", F.col("part").alias("hub_part"), F.col("x.key").alias("hub"))).alias("y"))
        .select("sig", "y.hub_part", "y.hub")
    )
    return (
        several.join(hubs, "sig").where(F.col("part") != F.col("hub_part"))
        .select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b"))
        .distinct()
    )


def _near_in_blocks(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
    """Pairs of different components whose sizes and sketches allow a link."""
    a_key, a_part, a_n = (left[c].to_numpy() for c in ("key", "part", "n"))
    b_key, b_part, b_n = (right[c].to_numpy() for c in ("key", "part", "n"))
    a_bits, b_bits = (np.stack(x["sketch"].to_numpy()).view(np.uint64) for x in (left, right))
    out = []
    for at in range(0, len(left), 32):
        rows = slice(at, at + 32)
        both = a_n[rows, None] + b_n[None, :]
        fits = (a_part[rows, None] != b_part[None, :]) & (
            np.minimum(a_n[rows, None], b_n[None, :]) * 100 >= np.maximum(a_n[rows, None], b_n[None, :]) * PERCENT
        )
        if same:
            fits &= a_key[rows, None] < b_key[None, :]
        i, j = np.nonzero(fits)
        distance = np.bitwise_count(a_bits[rows][i] ^ b_bits[j]).sum(axis=1, dtype=np.int64)
        near = distance * (100 + PERCENT) <= (100 - PERCENT) * both[i, j]
        x, y = a_key[rows][i[near]], b_key[j[near]]
        out.append(pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}))
    return pd.concat(out, ignore_index=True)


def _open_pairs(shared: DataFrame, found: DataFrame, sets: DataFrame, tasks: int) -> DataFrame:
    """Pairs that share a signature, may be linked and still lie in different components."""
    tagged = cut_lineage(_open(shared, found).select("sig", "key", "part").coalesce(tasks))
    counts = tagged.groupBy("sig").agg(F.count("*").alias("members"))
    sized = cut_lineage(tagged.join(counts, "sig").join(sets.select("key", "n"), "key").coalesce(tasks))
    few = sized.where(F.col("members") <= SMALL_GROUP)
    other = few.select("sig", F.col("key").alias("b"), F.col("part").alias("bpart"), F.col("n").alias("bn"))
    joined = (
        few.join(other, "sig")
        .where((F.col("key") < F.col("b")) & (F.col("part") != F.col("bpart")))
        .where(F.least("n", "bn") * 100 >= F.greatest("n", "bn") * PERCENT)
        .select(F.col("key").alias("a"), "b")
    )
    blocks = F.ceil(F.col("members") / SKETCH_BLOCK).cast("int")
    block = F.pmod(F.xxhash64("key"), blocks).cast("int")
    many = (
        sized.where(F.col("members") > SMALL_GROUP).withColumn("block", block)
        .withColumn("against", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .join(sets.select("key", "sketch"), "key")
        .select("sig", F.least("block", "against").alias("i"), F.greatest("block", "against").alias("j"), "block", "key", "part", "n", "sketch")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        left = group[group["block"] == i]
        right = left if i == j else group[group["block"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        return _near_in_blocks(left, right, i == j)

    return joined.union(many.groupBy("sig", "i", "j").applyInPandas(compare, "a long, b long")).distinct().coalesce(tasks)
