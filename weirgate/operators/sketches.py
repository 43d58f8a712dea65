"""Drift from mergeable quantile sketches, with a stated error.

The exact statistics of :mod:`weirgate.operators.drift` count every distinct value. Here each
column of a batch is one row of a few kilobytes: a KLL sketch with its smallest and largest
value. Sketches of parts, days or clusters merge, so a stored reference is never read again.
Both sides are ranked at common cuts, quantiles of either side, and the answer is an interval:
the distance at the cuts, widened by what can happen between them and by the rank error of
the two sketches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import known
from weirgate.operators.drift import stacked
from weirgate.session import cut_lineage

SIZE = 2000
CUTS = 200


def rank_error(size: int = SIZE) -> float:
    """Normalised rank error of a KLL sketch of this size, over all ranks at once, with 99 %
    confidence: fixed values published for the sketch."""
    return 2.446 / size**0.9433


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str] = (), size: int = SIZE) -> DataFrame:
    """(by..., column, n, missing, low, high, sketch): one row per column, built in one pass.

    Missing and NaN values are counted, not sketched. Partial sketches are built before the
    shuffle, so a group with a third of the rows sends one sketch per task.
    """
    values = df.select(*by, *[known(df, c).cast("double").alias(c) for c in columns])
    cells = values.unpivot(list(by), columns, "column", "value")
    there = F.when(~F.isnan("value"), F.col("value"))
    return cells.groupBy(*by, "column").agg(
        F.count(there).alias("n"),
        (F.count(F.lit(1)) - F.count(there)).alias("missing"),
        F.min(there).alias("low"),
        F.max(there).alias("high"),
        F.kll_sketch_agg_double(there, F.lit(size)).alias("sketch"),
    )


def merged(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """Sketches of the same (by..., column) as one."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def _listed(values: list[float]) -> Column:
    """Numbers as a constant; ranks are asked for at constants only."""
    return F.expr(f"array({', '.join(f'double({chr(39)}{v!r}{chr(39)})' for v in values)})")


def binned_drift(reference: DataFrame, current: DataFrame, size: int = SIZE, cuts: int = CUTS) -> DataFrame:
    """Per column: ks and wasserstein (in units of the column) as intervals.

    ``reference``, ``current``: rows of :func:`quantile_sketches`, one per column. The true
    ks lies in [ks_low, ks_high] and the true wasserstein distance in [wasserstein_low,
    wasserstein_high] unless a sketch misses its rank error; with at most ``size`` values a
    side sketches are exact. A column missing or empty on one side has null distances.
    """
    sides = reference.select("column", F.col("n").alias("ref_n"), F.col("low").alias("_rl"), F.col("high").alias("_rh"), F.col("sketch").alias("_r")).join(
        current.select("column", F.col("n").alias("cur_n"), F.col("low").alias("_cl"), F.col("high").alias("_ch"), F.col("sketch").alias("_c")),
        "column", "full",
    )
    both = (F.coalesce("ref_n", F.lit(0)) > 0) & (F.coalesce("cur_n", F.lit(0)) > 0)
    pinned = cut_lineage(sides)
    ranks = F.array(*[F.lit(i / cuts) for i in range(cuts + 1)])
    # Rows of empty sketches stay out: quantiles and ranks of nothing do not exist. A row for
    # each column comes back, of a few hundred numbers.
    found = pinned.where(both).select(
        "column", "_rl", "_rh", "_cl", "_ch",
        F.kll_sketch_get_quantile_double("_r", ranks).alias("a"), F.kll_sketch_get_quantile_double("_c", ranks).alias("b"),
    ).collect()
    at, p, q = (F.lit(None).cast("array<double>") for _ in range(3))
    for row in found:
        values = {float(v) for v in (*row["a"], *row["b"], row["_rl"], row["_rh"], row["_cl"], row["_ch"])}
        points = _listed(sorted(values | {math.nextafter(v, -math.inf) for v in values}))
        own = F.col("column") == row["column"]
        at = F.when(own, points).otherwise(at)
        p = F.when(own, F.kll_sketch_get_rank_double("_r", points)).otherwise(p)
        q = F.when(own, F.kll_sketch_get_rank_double("_c", points)).otherwise(q)
    placed = pinned.withColumns({"_at": at, "_p": p, "_q": q})
    steps = F.sequence(F.lit(0), F.size("_at") - 2)

    def step(i: Column) -> Column:
        p, q, at = F.col("_p"), F.col("_q"), F.col("_at")
        gap, following = p[i] - q[i], p[i + 1] - q[i + 1]
        # Between two cuts either side may rise first; between a value and the double before it
        # there is nothing. A gap of one unit in the last place, as no other two cuts have.
        bare = at[i + 1] - at[i] <= F.greatest(F.abs(at[i]), F.abs(at[i + 1])) * 2.0**-52 + 5e-324
        up = F.when(bare, gap).otherwise(p[i + 1] - q[i])
        down = F.when(bare, -gap).otherwise(q[i + 1] - p[i])
        return F.struct(
            F.greatest(F.abs(gap), F.abs(following)).alias("low"),
            F.greatest(up, down).alias("high"),
            F.greatest(F.lit(0.0), -up, -down).alias("least"),
            (at[i + 1] - at[i]).alias("width"),
        )

    bins = F.transform(steps, step)
    # A sketch that has dropped nothing makes no error.
    def error(n: str) -> Column:
        return F.when(F.col(n) <= size, F.lit(0.0)).otherwise(F.lit(rank_error(size)))

    miss = error("ref_n") + error("cur_n")
    total = lambda f: F.aggregate(F.col("_bins"), F.lit(0.0), lambda a, b: a + f(b))
    done = placed.withColumn("_bins", F.when(both, bins)).withColumn("rank_error", F.when(both, miss))
    span = F.greatest("_rh", "_ch") - F.least("_rl", "_cl")
    figures = done.select(
        "column", "ref_n", "cur_n", "rank_error", both.alias("_both"),
        F.greatest(F.lit(0.0), F.array_max(F.transform("_bins", lambda b: b["low"])) - F.col("rank_error")).alias("ks_low"),
        F.least(F.lit(1.0), F.array_max(F.transform("_bins", lambda b: b["high"])) + F.col("rank_error")).alias("ks_high"),
        F.greatest(F.lit(0.0), total(lambda b: b["least"] * b["width"]) - F.col("rank_error") * span).alias("wasserstein_low"),
        (total(lambda b: b["high"] * b["width"]) + F.col("rank_error") * span).alias("wasserstein_high"),
    )
    return figures.select(
        "column", "ref_n", "cur_n", "rank_error",
        *[F.when(F.col("_both"), F.col(c)).alias(c) for c in ("ks_low", "ks_high", "wasserstein_low", "wasserstein_high")],
    )


def binned_report(reference: DataFrame, current: DataFrame, columns: list[str], threshold: float = 0.1, size: int = SIZE) -> DataFrame:
    """Drift verdicts that hold whatever the sketches have missed: ``drifted`` is true or false
    where the whole ks interval is on one side of the threshold, else null."""
    both = stacked(reference, current, columns)
    sketches = quantile_sketches(both, columns, by=["is_current"], size=size)
    sides = [sketches.where(F.col("is_current") == side).drop("is_current") for side in (0, 1)]
    found = binned_drift(*sides, size=size)
    drifted = F.when(F.col("ks_low") >= threshold, True).when(F.col("ks_high") < threshold, False)
    return found.withColumn("drifted", drifted)
