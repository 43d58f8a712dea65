"""Exact choice of n rows per class in hash order, as a narrow predicate.

Ranking every row per class would give one task per class. Instead the 52-bit row hash
is cut into digits: count per leading digit, find the digit where the quota runs out,
and go on inside that digit only. What remains to be ranked is a handful of rows, and
the result is one boundary (hash, key) per class. Applying it is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgate.functions.columns import HASH_BITS, hash52
from weirgate.session import local_rows

DIGIT_BITS = 13
MAX_CLASSES = 10_000


@dataclass(frozen=True)
class HashCut:
    """Rows of a class at or below its boundary are chosen."""

    label: str
    key: str
    seed: int | str
    boundaries: dict[object, tuple[int, object]]

    def chosen(self, df: DataFrame, name: str = "chosen") -> DataFrame:
        """Add the boolean column ``name``. No shuffle: one boundary row per class."""
        types = dict(df.dtypes)
        rows = [(label, cut, key) for label, (cut, key) in self.boundaries.items()]
        bounds = local_rows(
            df.sparkSession, rows, f"_label {types[self.label]}, _cut bigint, _key {types[self.key]}"
        )
        h = hash52(self.seed, F.col(self.key))
        picked = (h < F.col("_cut")) | ((h == F.col("_cut")) & (F.col(self.key) <= F.col("_key")))
        return (
            df.join(F.broadcast(bounds), F.col(self.label).eqNullSafe(F.col("_label")), "left")
            .withColumn(name, F.coalesce(picked, F.lit(False)))
            .drop("_label", "_cut", "_key")
        )


def class_sizes(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per class; refuses labels with more classes than a driver-side plan can hold."""
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    if any(r[0] is None for r in rows):
        raise ValueError(f"{label} has missing values")
    return {r[0]: r[1] for r in rows}


def pick_by_hash(
    df: DataFrame,
    label: str,
    key: str,
    quotas: dict[object, int],
    seed: int | str,
    rank_at_most: int = 10_000,
) -> HashCut:
    """Boundary per class so that exactly ``quotas[class]`` rows are chosen.

    Classes with a zero quota get no boundary. ``key`` must be unique.
    """
    spark = df.sparkSession
    types = dict(df.dtypes)
    hashed = df.select(
        F.col(label).alias("label"), F.col(key).alias("key"), hash52(seed, F.col(key)).alias("h")
    )
    open_classes = {
        c: {"low": 0, "left": q, "size": None} for c, q in quotas.items() if q > 0
    }
    shift = HASH_BITS
    pool = hashed
    while shift > 0 and open_classes:
        if all(s["size"] is not None and s["size"] <= rank_at_most for s in open_classes.values()):
            break
        shift -= DIGIT_BITS
        # Leading digits seen so far; at most 2^13 new values per class.
        counts = (
            pool.withColumn("d", F.shiftright("h", shift)).groupBy("label", "d").agg(F.count("*").alias("n"))
        )
        ordered = Window.partitionBy("label").orderBy("d")
        state = local_rows(
            spark,
            [(c, s["left"]) for c, s in open_classes.items()],
            f"label {types[label]}, quota bigint",
        )
        crossing = (
            counts.withColumn("upto", F.sum("n").over(ordered))
            .join(F.broadcast(state), "label")
            .where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
            .select("label", "d", "n", (F.col("quota") - F.col("upto") + F.col("n")).alias("left"))
            .collect()
        )
        if len(crossing) < len(open_classes):
            raise ValueError("a quota is larger than its class")
        open_classes = {r.label: {"low": r.d, "left": r.left, "size": r.n} for r in crossing}
        prefixes = local_rows(
            spark,
            [(c, s["low"]) for c, s in open_classes.items()],
            f"label {types[label]}, _prefix bigint",
        )
        pool = (
            hashed.join(F.broadcast(prefixes), "label")
            .where(F.shiftright("h", shift) == F.col("_prefix"))
            .drop("_prefix")
        )
    if not open_classes:
        return HashCut(label, key, seed, {})
    state = local_rows(
        spark,
        [(c, s["left"]) for c, s in open_classes.items()],
        f"label {types[label]}, quota bigint",
    )
    ranked = Window.partitionBy("label").orderBy("h", "key")
    last = (
        pool.withColumn("rank", F.row_number().over(ranked))
        .join(F.broadcast(state), "label")
        .where(F.col("rank") == F.col("quota"))
        .collect()
    )
    return HashCut(label, key, seed, {r.label: (r.h, r.key) for r in last})
