"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The driver draws only how many rows each source part sends to each shard: a matrix of at
most ``MAX_PARTS`` by shards numbers, exact in rows and columns. Each part permutes its
rows and deals them out by its row of the matrix, the rows are exchanged, and each shard
permutes what it received. Every assignment of rows to shards of those sizes is equally
likely under the hash keys.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import filled
from weirgate.session import cut_lineage, local_rows

# Bounds the matrix, not the rows: beyond it parts only grow.
MAX_PARTS = 4096
ROWS_PER_PART = 20_000


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """Exact draw for any population; the library's sampler stops at 10**9."""
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    mean = draws * good / total
    spread = math.sqrt(max(1.0, mean * (bad / total) * (total - draws) / max(1, total - 1)))
    low = max(0, draws - bad, int(mean - 14 * spread - 20))
    high = min(draws, good, int(mean + 14 * spread + 20))
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(ratio)))
    weights = np.exp(logs - logs.max())
    return low + int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), side="right"))


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Rows from part to shard; row sums are ``parts``, column sums ``shards``."""
    rng = np.random.default_rng(seed)
    left = list(shards)
    matrix = np.zeros((len(parts), len(shards)), dtype=np.int64)
    for i, rows in enumerate(parts):
        rest = sum(left)
        for j in range(len(left)):
            rest -= left[j]
            matrix[i, j] = taken = hypergeometric(left[j], rest, rows, rng)
            rows -= taken
            left[j] -= taken
    return matrix


def assign_shards(df: DataFrame, shards: int, keys: list[str], seed: int = 0) -> DataFrame:
    """Add ``shard`` (sizes at most one row apart) and ``slot`` (gapless from 0 in a shard).

    ``keys`` are columns that order rows; rows equal in all of them are interchangeable, so
    repeated rows are dealt out like others. Null keys are allowed. Columns named ``shard``
    or ``slot`` are replaced. An empty table gives an empty table.
    """
    spark = df.sparkSession
    rows = df.drop("shard", "slot")
    total = rows.count()
    count = min(MAX_PARTS, max(1, -(-total // ROWS_PER_PART)))
    part = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(count)).cast("int")
    parted = rows.withColumn("_w_part", part)
    sizes = [0] * count
    for row in parted.groupBy("_w_part").agg(F.count("*").alias("n")).collect():
        sizes[row["_w_part"]] = row["n"]
    wanted = [total // shards + (i < total % shards) for i in range(shards)]
    bounds = np.cumsum(communication_matrix(sizes, wanted, seed), axis=1)
    table = local_rows(spark, [(i, b.tolist()) for i, b in enumerate(bounds)], "_w_part int, _w_bounds array<long>")
    local = Window.partitionBy("_w_part").orderBy(F.xxhash64(F.lit(seed + 1), *keys), *keys)
    # At most MAX_PARTS rows of one number per shard.
    dealt = cut_lineage(
        parted.withColumn("_w_row", F.row_number().over(local))
        .join(F.broadcast(table), "_w_part")
        .withColumn("shard", F.size(F.filter("_w_bounds", lambda b: b < F.col("_w_row"))))
        .drop("_w_part", "_w_bounds", "_w_row")
    )
    blocks = max(1, -(-total // shards // ROWS_PER_PART))
    block = F.pmod(F.xxhash64(F.lit(seed + 2), *keys), F.lit(blocks)).cast("int")
    exchanged = dealt.withColumn("_w_block", block)
    counts = exchanged.groupBy("shard", "_w_block").agg(F.count("*").alias("_w_n"))
    before = Window.partitionBy("shard").orderBy("_w_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_w_block", F.coalesce(F.sum("_w_n").over(before), F.lit(0)).alias("_w_before")
    )
    again = Window.partitionBy("shard", "_w_block").orderBy(F.xxhash64(F.lit(seed + 3), *keys), *keys)
    return (
        exchanged.withColumn("_w_row", F.row_number().over(again))
        .join(offsets, ["shard", "_w_block"])
        .withColumn("slot", (F.col("_w_before") + F.col("_w_row") - 1).cast("long"))
        .select(*rows.columns, "shard", "slot")
    )


def shard_documents(
    df: DataFrame, shards: int, id: str = "doc_id", text: str = "text", seed: int = 0
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Size is the UTF-8 length plus 16; null text counts as empty. The law is ``rows``: the
    uniform shuffle gives shards whose counts differ by one at most, so equal texts are
    spread like any others.
    """
    body = filled(text).cast("binary")
    thin = df.select(
        F.col(f"`{id}`").alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    return assign_shards(thin, shards, ["doc_id", "text_crc32", "size"], seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, shards: int, keys: list[str], seed: int = 0) -> None:
    """Write whole rows as one folder per shard, rows of a file in slot order."""
    placed = assign_shards(df, shards, keys, seed)
    block = F.floor(F.col("slot") / ROWS_PER_PART)
    placed.repartition("shard", block).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
