"""Exact top-k inner products by a Voronoi join.

Data vectors belong to the cell of their nearest pivot. From the summaries of the cells
(pivot, radius, number of vectors) a group of queries gets a bound that its k best scores
reach for certain; only cells whose upper bound reaches it get the query. By Cauchy and
Schwarz, a score differs from the query's score with the pivot by at most the query's
length times the vector's distance from the pivot. Cells are solved in blocks of bounded
size, so a vector that a third of the rows hold makes many blocks, not a large one. The
queries routed to a cell are counted and cut into blocks too; a data block is sent once to
each query block of its cell, and not at all where no query comes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.session import cut_lineage

# Pivots are a hashed sample; their number follows the square root of the rows up to this.
MAX_PIVOTS = 2048
BLOCK_ROWS = 4096
QUERY_ROWS = 4096
# Scores below this are exact in floating point, and below the next in long integers.
FLOAT_EXACT, LONG_EXACT = 2**53, 2**63
SLACK = 1e-9


def whole_vectors(df: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(vid, v array<double>, times) of rows that take part: every component floor(scale * x).

    Left out are null ids and vectors, and vectors with null or non-finite components. Equal
    rows, id and vector, are one row that says how many they are.
    """
    def whole(e: Column) -> Column:
        y = F.lit(float(scale)) * e.cast("double")
        # Doubles beyond are whole numbers already, and may be too large for a long.
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    def finite(e: Column) -> Column:
        y = F.lit(float(scale)) * e.cast("double")
        return e.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf"))

    given = F.col(f"`{vector}`")
    rows = df.where(F.col(f"`{id}`").isNotNull() & given.isNotNull() & F.coalesce(F.forall(given, finite), F.lit(False)))
    vectors = rows.select(F.col(f"`{id}`").cast("long").alias("vid"), F.transform(given, whole).alias("v"))
    return vectors.groupBy("vid", "v").agg(F.count("*").alias("times"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _assign(data: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Nearest pivot of every vector and the distance to it."""
    norms = (pivots**2).sum(axis=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.iloc[at : at + 1024]
                x = _matrix(batch["v"])
                cell = np.argmin(norms[None, :] - 2 * (x @ pivots.T), axis=1)
                away = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
                yield pd.DataFrame({
                    "vid": batch["vid"], "v": batch["v"], "times": batch["times"], "cell": cell.astype("int32"),
                    "away": np.where(np.isnan(away), np.inf, away),
                })

    return data.mapInPandas(run, "vid long, v array<double>, times long, cell int, away double")


def _floor_of(lower: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Per row, a score that at least k vectors reach: lower bounds of cells, best first."""
    order = np.argsort(-lower, axis=1)
    reached = np.cumsum(sizes[order], axis=1) >= k
    at = reached.argmax(axis=1)
    floor = np.take_along_axis(lower, order, axis=1)[np.arange(len(lower)), at]
    return np.where(reached.any(axis=1), floor, -np.inf)


def _wanted(pivots: np.ndarray, radius: np.ndarray, sizes: np.ndarray, need: int):
    """Function of a batch of queries: parts of it, and (row, cell) where a cell may hold one of
    the best; ``need`` vectors hold k of another id than the query's."""
    filled_cells = np.flatnonzero(sizes)
    centres, reach, number = pivots[filled_cells], radius[filled_cells], sizes[filled_cells]

    far = np.sqrt((centres**2).sum(axis=1))

    def bounds(scores: np.ndarray, width: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds with room for rounding; what overflows bounds nothing."""
        wide = width + SLACK * (size + width) + SLACK
        low, high = scores - wide, scores + wide
        return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)

    def pairs(whole: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
        for _, group in whole.groupby("cell"):
            for at in range(0, len(group), 256):
                batch = group.iloc[at : at + 256]
                q = _matrix(batch["v"])
                with np.errstate(over="ignore", invalid="ignore"):
                    # Bounds of the whole group, from its middle and extent.
                    middle = q.mean(axis=0)
                    extent = np.sqrt(((q - middle) ** 2).sum(axis=1).max())
                    length = np.sqrt(middle @ middle) + extent
                    low, high = bounds((centres @ middle)[None, :], (extent * far + length * reach)[None, :], (length * far)[None, :])
                    near = np.flatnonzero(high[0] >= _floor_of(low, number, need)[0])
                    # The remaining cells, query by query.
                    norms = np.sqrt((q**2).sum(axis=1))[:, None]
                    low, high = bounds(q @ centres[near].T, norms * reach[None, near], norms * far[None, near])
                    wanted = high >= _floor_of(low, number[near], need)[:, None]
                row, cell = np.nonzero(wanted)
                yield batch, row, filled_cells[near[cell]]

    return pairs


def _routed(queries: DataFrame, pairs, cells: int) -> np.ndarray:
    """How many queries go to every cell. The routes are found again later: kept, they would
    hold every query once per cell."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(cells, dtype=np.int64)
        for whole in batches:
            for _, _, cell in pairs(whole):
                counts += np.bincount(cell, minlength=cells)
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"cell": some.astype("int32"), "n": counts[some]})

    total = np.zeros(cells, dtype=np.int64)
    for row in queries.mapInPandas(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[row["cell"]] = row["n"]
    return total


def _routes(queries: DataFrame, pairs, blocks: np.ndarray) -> DataFrame:
    """(query id, q, cell, block) for every block of a cell that may hold one of the k best."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for batch, row, cell in pairs(whole):
                times = blocks[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                for part in range(0, len(row), 20_000):
                    pick = slice(part, part + 20_000)
                    yield pd.DataFrame({
                        "qid": batch["vid"].to_numpy()[row[pick]], "q": batch["v"].to_numpy()[row[pick]],
                        "asked": batch["times"].to_numpy()[row[pick]],
                        "cell": cell[pick].astype("int32"), "block": block[pick].astype("int32"),
                    })

    return queries.mapInPandas(run, "qid long, q array<double>, asked long, cell int, block int")


def _of_cell(numbers: np.ndarray):
    """Column: the cell's entry in ``numbers``."""
    return F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), F.col("cell") + 1)


def _products(q: np.ndarray, x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact inner products as long integers; one that does not fit is an error, but for a
    query's ``own`` vectors, whose products are not used."""
    most = lambda m: float(np.abs(m).max()) if m.size else 0.0
    bound = most(q) * most(x) * max(1, q.shape[1])
    if bound < FLOAT_EXACT:
        return (q @ x.T).astype(np.int64)
    if bound < LONG_EXACT:
        return q.astype(np.int64) @ x.T.astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q) @ whole(x).T
    exact[own] = 0
    if exact.size and (exact.max() >= LONG_EXACT or exact.min() < -LONG_EXACT):
        raise OverflowError("an inner product does not fit a long integer")
    return exact.astype(np.int64)


def _solve(k: int):
    columns = ["query_id", "vec_id", "score"]

    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(data):
            return pd.DataFrame(columns=columns)
        data = data.sort_values("vid", kind="stable")
        ids, x, times = data["vid"].to_numpy(), _matrix(data["v"]), data["times"].to_numpy()
        out = []
        for at in range(0, len(queries), 256):
            part = queries.iloc[at : at + 256]
            qids, asked = part["qid"].to_numpy(), part["asked"].to_numpy()
            scores = _products(_matrix(part["q"]), x, qids[:, None] == ids[None, :])
            for i, row in enumerate(scores):
                others = np.flatnonzero(ids != qids[i])
                found = row[others]
                if len(found) > k:
                    found_at = found >= np.partition(found, len(found) - k)[len(found) - k]
                    others, found = others[found_at], found[found_at]
                # Descending scores; -1 - score cannot leave the range.
                order = np.argsort(-1 - found, kind="stable")[:k]
                # Repeated rows count as often as they are given.
                order = np.repeat(order, np.minimum(times[others[order]] * asked[i], k))[:k]
                out.append(pd.DataFrame({"query_id": qids[i], "vec_id": ids[others[order]], "score": found[order]}))
        return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)

    return run


def top_k(
    df: DataFrame, k: int = 5, query_step: int = 50, id: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products.

    Queries are the rows whose id is divisible by ``query_step``; candidates are all rows
    with another id and a vector of the same length, so each length is a search of its own.
    Ties go to the smaller id. A row given several times is as many candidates, and as many
    queries under its id; of different vectors under one id each takes part. Components of
    any finite size are exact; a product beyond a long integer is an error. Extra columns
    are not read. An empty table, or one without a usable vector, gives an empty table.
    """
    every = cut_lineage(whole_vectors(df, id, vector, scale))
    lengths = [r["d"] for r in every.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]
    found = [_top_of_length(every.where(F.size("v") == d), k, query_step) for d in lengths]
    if not found:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    partial = reduce(DataFrame.unionAll, found)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _top_of_length(data: DataFrame, k: int, query_step: int) -> DataFrame:
    """(query_id, vec_id, score) of vectors of one length: the k best of every block."""
    total = data.count()
    count = int(min(MAX_PIVOTS, max(1, np.sqrt(total))))
    chosen = data.orderBy(F.xxhash64("vid"), "vid", "v").limit(count).collect()
    pivots = np.array([r["v"] for r in chosen], dtype=np.float64)
    assigned = cut_lineage(_assign(data, pivots))
    radius, sizes = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    for row in assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect():
        # Rounding in the distances may not cost a vector.
        radius[row["cell"]], sizes[row["cell"]] = row["r"] * (1 + SLACK) + SLACK, row["n"]
    blocks = -(-sizes // BLOCK_ROWS)
    queries = assigned.where(F.col("vid") % query_step == 0)
    # A query does not count the vectors of its own id, mostly one.
    own = queries.groupBy("vid").count().agg(F.max("count")).first()[0] or 0
    pairs = _wanted(pivots, radius, sizes, k + own)
    query_blocks = -(-_routed(queries, pairs, len(pivots)) // QUERY_ROWS)
    spread = (
        assigned.withColumn("parts", _of_cell(query_blocks)).where(F.col("parts") > 0)
        .select(
            "vid", "v", "times", "cell", F.pmod(F.xxhash64("vid", "v"), _of_cell(blocks)).cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        )
    )
    routes = _routes(queries, pairs, blocks).withColumn(
        "part", F.pmod(F.xxhash64("qid", "q"), _of_cell(np.maximum(query_blocks, 1))).cast("int")
    )
    keys = ["cell", "block", "part"]
    return (
        routes.groupBy(*keys).cogroup(spread.groupBy(*keys))
        .applyInPandas(_solve(k), "query_id long, vec_id long, score long")
    )
