"""Exact k nearest neighbours by pivot cells.

Points are assigned to the closest of a bounded set of pivots. Distances to pivots bound
how far the k-th neighbour of any point of a cell can be, so a candidate travels only to
cells it could matter to (triangle inequality; Lu et al., "Efficient Processing of k
Nearest Neighbor Joins using MapReduce", VLDB 2012). The k nearest of a point among its own
block of the cell tighten that bound first. Each cell is cut into blocks of
bounded size, every task compares one block of points with one block of candidates and
keeps k per point, and a final top-k per point merges the blocks. No pair list is ever
built, and no candidate is dropped that could be among the k. Cells take their turns where
copies of the candidates for all of them would be many times the points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.session import cut_lineage

ROWS_AT_ONCE, OTHERS_AT_ONCE = 64, 2048
# Blocks of candidates are larger than those of points by this factor: each block sends k rows a point on.
OTHER_BLOCKS = 32
SLACK = 1e-9  # relative allowance for rounding in the pruning bounds


@dataclass(frozen=True)
class Cells:
    """Driver-side summary of the cells; its size depends on the pivots only."""

    pivots: np.ndarray
    between: np.ndarray
    radius: np.ndarray
    reach: np.ndarray
    ring: np.ndarray
    point_blocks: np.ndarray


def _distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances, summed dimension by dimension to avoid cancellation."""
    total = np.zeros((len(points), len(others)))
    apart = np.empty_like(total)
    columns = np.ascontiguousarray(others.T)
    for d in range(points.shape[1]):
        np.subtract(points[:, d, None], columns[d], out=apart)
        total += np.square(apart, out=apart)
    return total


def _slices(batches: Iterator[pd.DataFrame], rows: int = 1024) -> Iterator[pd.DataFrame]:
    """Arrow batches in pieces, so that distance matrices stay small."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows].reset_index(drop=True)


def _assign(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            squared = _distances(np.stack(batch["features"].to_numpy()), pivots)
            cell = squared.argmin(axis=1)
            yield batch.assign(
                cell=cell.astype("int32"), away=np.sqrt(squared[np.arange(len(batch)), cell])
            )

    return points.mapInPandas(
        run, "pid bigint, features array<double>, copies bigint, cell int, away double"
    )


def _summarise(assigned: DataFrame, pivots: np.ndarray, k: int, block_rows: int) -> Cells:
    count = len(pivots)
    sizes = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()
    nearest = Window.partitionBy("cell").orderBy("away")
    closest = (
        assigned.select("cell", "away")
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k + 1)
        .collect()
    )
    radius, blocks = np.full(count, -1.0), np.ones(count, dtype=int)
    for row in sizes:
        radius[row.cell] = row.radius
        blocks[row.cell] = -(-row.n // block_rows)
    between = np.sqrt(_distances(pivots, pivots))
    cells = np.array([r.cell for r in closest], dtype=int)
    away = np.array([r.away for r in closest])
    # k + 1 because a point finds itself among the candidates.
    bound = radius[:, None] + between[:, cells] + away[None, :]
    reach = np.partition(bound, k, axis=1)[:, k] if bound.shape[1] > k else np.full(count, np.inf)
    return Cells(pivots, between, radius, reach, radius + reach, blocks)


def _tightened(assigned: DataFrame, cells: Cells, k: int, block: Column) -> Cells:
    """Bounds by the k nearest of each point among the points of its own block.

    ``reach`` is how far the k-th neighbour of any point of a cell can be from that point,
    ``ring`` how far from the pivot.
    """
    known = cells.reach

    def run(points: pd.DataFrame) -> pd.DataFrame:
        own, away = np.stack(points["features"].to_numpy()), points["away"].to_numpy()
        cell = int(points["cell"].iloc[0])
        bound = np.full(len(own), known[cell])
        if len(own) > k:
            for start in range(0, len(own), ROWS_AT_ONCE):
                squared = _distances(own[start : start + ROWS_AT_ONCE], own)
                rows = np.arange(len(squared))
                squared[rows, start + rows] = np.inf
                nearest = np.sqrt(np.partition(squared, k - 1, axis=1)[:, k - 1])
                bound[start : start + ROWS_AT_ONCE] = np.minimum(nearest, known[cell])
        return pd.DataFrame({"cell": [cell], "reach": [bound.max()], "ring": [(away + bound).max()]})

    found = (
        assigned.select("cell", block.alias("pb"), "away", "features")
        .groupBy("cell", "pb")
        .applyInPandas(run, "cell int, reach double, ring double")
        .groupBy("cell").agg(F.max("reach").alias("reach"), F.max("ring").alias("ring"))
        .collect()
    )
    reach, ring = cells.reach.copy(), cells.ring.copy()
    for row in found:
        reach[row.cell], ring[row.cell] = row.reach, row.ring
    return replace(cells, reach=reach, ring=ring)


def _candidates(assigned: DataFrame, cells: Cells) -> DataFrame:
    """(pid, features, copies, target cells) for every point, as a neighbour of others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        occupied = cells.radius >= 0
        for batch in _slices(batches):
            to_pivot = np.sqrt(_distances(np.stack(batch["features"].to_numpy()), cells.pivots))
            own = batch["cell"].to_numpy()
            apart = cells.between[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                # Distance to the plane between the own pivot and the target pivot.
                plane = (to_pivot**2 - to_pivot[np.arange(len(own)), own][:, None] ** 2) / (2 * apart)
            plane[~np.isfinite(plane)] = 0.0
            wanted = occupied[None, :] & (plane <= cells.reach[None, :] * (1 + SLACK) + SLACK)
            wanted &= to_pivot <= cells.ring[None, :] * (1 + SLACK) + SLACK
            yield pd.DataFrame(
                {
                    "pid": batch["pid"],
                    "features": batch["features"],
                    "copies": batch["copies"],
                    "targets": [np.flatnonzero(w).astype("int32") for w in wanted],
                }
            )

    return assigned.mapInPandas(
        run, "pid bigint, features array<double>, copies bigint, targets array<int>"
    )


def _best_of_block(k: int):
    columns = ["pid", "neighbour", "distance2", "copies", "features"]

    def run(points: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(others):
            return pd.DataFrame(columns=columns)
        ids, other_ids = points["pid"].to_numpy(), others["pid"].to_numpy()
        own, other = np.stack(points["features"].to_numpy()), np.stack(others["features"].to_numpy())
        kept_rows, kept_others, kept_squared = [], [], []
        # A few points at a time, so that their distances stay in the processor's cache.
        for start in range(0, len(ids), ROWS_AT_ONCE):
            found = []
            worst = np.full((len(ids[start : start + ROWS_AT_ONCE]), 1), np.inf)
            for begin in range(0, len(other_ids), OTHERS_AT_ONCE):
                some = other_ids[begin : begin + OTHERS_AT_ONCE]
                squared = _distances(own[start : start + ROWS_AT_ONCE], other[begin : begin + OTHERS_AT_ONCE])
                squared[ids[start : start + ROWS_AT_ONCE, None] == some[None, :]] = np.inf
                near = np.isfinite(squared) & (squared <= worst)
                if squared.shape[1] > k:
                    worst = np.minimum(worst, np.partition(squared, k - 1, axis=1)[:, k - 1, None])
                    near &= squared <= worst
                i, j = np.nonzero(near)
                found.append((i, begin + j, squared[i, j]))
            i, j, apart = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((other_ids[j], apart, i))
            i, j, apart = i[order], j[order], apart[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            kept_rows.append(start + i[first])
            kept_others.append(j[first])
            kept_squared.append(apart[first])
        a, b = np.concatenate(kept_rows), np.concatenate(kept_others)
        return pd.DataFrame(
            {
                "pid": ids[a],
                "neighbour": other_ids[b],
                "distance2": np.concatenate(kept_squared),
                "copies": others["copies"].to_numpy()[b],
                "features": others["features"].to_numpy()[b],
            }
        )

    return run


def _turns(rows: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges (first, end) of cells whose ``rows`` add up to ``most`` or that are one cell."""
    ends, total = [], 0
    for i, n in enumerate(rows):
        if total and total + n > most:
            ends.append(i)
            total = 0
        total += n
    return list(zip([0, *ends], [*ends, len(rows)], strict=True))


def nearest_neighbours(
    points: DataFrame, k: int, max_pivots: int = 1024, block_rows: int = 2048, spread: int = 8
) -> DataFrame:
    """(pid, rank, neighbour, distance2, copies, features of the neighbour), rank from 0.

    ``points``: pid bigint, features array<double>, copies bigint, with distinct features.
    Ties in distance go to the smaller pid. Cells are worked through together as long as
    they move ``spread`` rows for each point; then the next ones have their turn, and the
    disk of a turn is free again.
    """
    spark = points.sparkSession
    points = cut_lineage(points.select("pid", "features", "copies"))
    total = points.count()
    count = int(min(max_pivots, max(1, total // 256)))
    chosen = points.orderBy(F.xxhash64("pid"), "pid").limit(count).collect()
    pivots = np.array([r.features for r in chosen], dtype=float)
    assigned = cut_lineage(_assign(points, pivots))
    cells = _summarise(assigned, pivots, k, block_rows)

    def blocks(values) -> DataFrame:
        return F.array(*[F.lit(int(v)) for v in values])

    def block_of(name: str, total_blocks):
        return F.pmod(F.xxhash64(name), total_blocks).cast("int")

    def every(total_blocks):
        return F.explode(F.sequence(F.lit(0), total_blocks - 1))

    point_total = F.element_at(blocks(cells.point_blocks), F.col("cell") + 1)
    cells = _tightened(assigned, cells, k, block_of("pid", point_total))
    reached = cut_lineage(_candidates(assigned, cells))

    target = F.explode("targets").alias("cell")
    load = {r.cell: r.n for r in reached.select(target).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    own = {r.cell: r.n for r in assigned.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    other_blocks = [-(-load.get(i, 1) // (OTHER_BLOCKS * block_rows)) for i in range(count)]
    other_total = F.element_at(blocks(other_blocks), F.col("cell") + 1)
    left = assigned.select(
        "cell", block_of("pid", point_total).alias("pb"), every(other_total).alias("ob"), "pid", "features"
    )
    right = reached.select("pid", "features", "copies", target).select(
        "cell", every(point_total).alias("pb"), block_of("pid", other_total).alias("ob"), "pid", "features", "copies"
    )
    keys = ["cell", "pb", "ob"]
    order = Window.partitionBy("pid").orderBy("distance2", "neighbour")

    def turn(first: int, end: int) -> DataFrame:
        here = (F.col("cell") >= first) & (F.col("cell") < end)
        partial = (
            left.where(here)
            .groupBy(*keys)
            .cogroup(right.where(here).groupBy(*keys))
            .applyInPandas(
                _best_of_block(k),
                "pid bigint, neighbour bigint, distance2 double, copies bigint, features array<double>",
            )
        )
        return (
            partial.withColumn("rank", F.row_number().over(order) - 1)
            .where(F.col("rank") < k)
            .select("pid", "rank", "neighbour", "distance2", "copies", "features")
        )

    moved = [load.get(i, 0) * int(cells.point_blocks[i]) + own.get(i, 0) * other_blocks[i] for i in range(count)]
    turns = _turns(moved, spread * total)
    if len(turns) == 1:
        return turn(*turns[0])
    return reduce(DataFrame.unionByName, [cut_lineage(turn(*x)) for x in turns])
