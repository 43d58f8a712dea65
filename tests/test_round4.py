"""Streams and neighbours that once cost a call, a pass or a copy for each row."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from weirgate.operators import capture, gates, neighbours
from weirgate.session import RESERVE_AHEAD, STATE_STORE, state_on_disk
from weirgate.sources.derived import ROWWISE
from weirgate.sources.tables import SCHEMAS
from weirgate.streaming import monitor, stateful


class Store:
    """A state variable of one grouping key, and the calls it took."""

    def __init__(self, calls):
        self.calls, self.values, self.value = calls, {}, None

    def __getattr__(self, name):
        def call(*args):
            self.calls[name] += 1
            return getattr(self, f"_{name}")(*args)

        return call

    def _exists(self):
        return self.value is not None

    def _get(self):
        return self.value

    def _update(self, value):
        self.value = value

    def _keys(self):
        return iter(list(self.values))

    def _getValue(self, key):
        return self.values[key]

    def _updateValue(self, key, value):
        self.values[key] = value

    def _removeKey(self, key):
        del self.values[key]


class Handle:
    def __init__(self):
        self.calls, self.timers = defaultdict(int), set()

    def getMapState(self, name, key, value):
        return Store(self.calls)

    def getValueState(self, name, schema):
        return Store(self.calls)

    def registerTimer(self, at):
        self.calls["registerTimer"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls["deleteTimer"] += 1
        self.timers.remove(at)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def _stream(batches, runs):
    """Rows emitted for batches of (rows, watermark after them), in order, and the calls to the store."""
    handle, out, sizes = Handle(), [], []
    runs_of = stateful.SignalRuns(runs, "string", "bigint")
    runs_of.init(handle)
    fields = Row("bucket", "key", "at", "micros", "run_id", "fired")
    for rows, watermark in batches:
        list(runs_of.handleInputRows((0,), iter([fields(0, k, None, m, i, f) for k, m, i, f in rows]), At(0)))
        assert len(handle.timers) <= 1
        for timer in [t for t in handle.timers if t <= watermark]:
            for r in runs_of.handleExpiredTimer((0,), At(watermark), At(timer)):
                sizes.append(len(r["keys"]))
                out += zip(r["keys"], r["micros"], r["ids"], r["repeated"], strict=True)
            handle.timers.remove(timer)
    return out, sizes, handle


def _expected(rows, runs):
    last, out = defaultdict(list), {}
    for key, micros, run_id, fired in sorted(rows, key=lambda r: (r[1], r[2])):
        last[key] = [*last[key], bool(fired)][-runs:]
        out[run_id] = (key, micros, len(last[key]) == runs and all(last[key]))
    return out


def _rows(n, seed=1):
    rnd = random.Random(seed)
    keys = ["a", "b", None, "c"]
    return [(rnd.choice(keys), rnd.randrange(40_000_000), i, rnd.choice([True, True, True, False, None])) for i in range(n)]


@pytest.mark.parametrize("sizes", [(100_000, 10_000), (64, 16), (1, 1)])
def test_runs_are_found_however_their_state_is_cut(monkeypatch, sizes):
    monkeypatch.setattr(stateful, "BLOCK_ROWS", sizes[0])
    monkeypatch.setattr(stateful, "PART_ROWS", sizes[1])
    rows = sorted(_rows(600), key=lambda r: r[1] + hash((r[2], 7)) % 9_000_000)
    # The watermark lags, moves in the middle of parts, stands still, and passes all at the end.
    batches, start = [], 0
    for size, step in ((200, 0), (150, 0), (150, 1), (100, 1)):
        some = rows[start : start + size]
        start += size
        rest = rows[start:]
        batches.append((some, min((r[1] for r in rest), default=10**9) // 1000 - 1 if step else 0))
    out, packed, handle = _stream([*batches, ([], 41_000)], 3)
    assert {i: (k, m, r) for k, m, i, r in out} == _expected(rows, 3) and len(out) == 600
    times = [m for _, m, _, _ in out]
    assert times == sorted(times) and max(packed) <= sizes[1] and not handle.timers


def test_the_store_is_not_called_for_each_row():
    calls = []
    for n in (1_000, 8_000):
        out, _, handle = _stream([(_rows(n), 0), ([], 41_000)], 2)
        assert len(out) == n
        calls.append(sum(handle.calls.values()))
    assert calls[0] == calls[1] < 30


def test_a_new_run_before_all_that_wait_moves_the_timer():
    early, late = ("a", 1_000_000, 1, True), ("a", 9_000_000, 2, True)
    out, _, handle = _stream([([late], 0), ([early], 2_000), ([], 10_000)], 2)
    assert [(i, r) for _, _, i, r in out] == [(1, False), (2, True)] and handle.calls["deleteTimer"] == 1


def test_a_line_is_parsed_once_for_all_its_fields(spark):
    lines = spark.createDataFrame([("{}",)], "line string")
    for strict in (True, False):
        plan = capture.parse_capture_lines(lines, strict=strict)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == 1


def test_the_windows_of_a_batch_are_worked_out_once(spark, tmp_path):
    """A batch joins releases and evidence; its state must not be read for each of them."""
    used = spark.sparkContext.accumulator(0)

    def count(n):
        used.add(1)
        return n

    orders = [(i, i % 3, "F", 1.0, datetime(2024, 1, 1), "1-URGENT") for i in range(1, 7)]
    at = datetime(2024, 1, 2)
    names = "window struct<start: timestamp, end: timestamp>, endpoint_name string, deployment_name string, record_count bigint, schema_consistent boolean, predictions bigint, max_single_class_share double"
    rows = [((at, at + timedelta(days=1)), "e", f"dep-{i}", 5, True, 5, 0.9) for i in range(4)]
    spark.createDataFrame(orders, SCHEMAS["orders"].replace("timestamp_ntz", "timestamp")).createOrReplaceTempView("round4_orders")
    releases = spark.table("round4_orders").selectExpr(*[f"{e} AS {c}" for c, e in ROWWISE["releases"][1].items()])
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/facts")
    facts = spark.readStream.schema(names).parquet(f"{tmp_path}/facts")
    facts = facts.withColumn("record_count", F.udf(count, "bigint").asNondeterministic()("record_count"))
    before, default = spark.conf.get(STATE_STORE), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_STORE, default)
    try:
        monitor.finish(monitor.policy_stream(
            facts, releases, gates.MonitorConfig(min_capture_records=3, expected_feature_count=2, max_single_class_share=0.6),
            gates.RetrainingConfig(), f"{tmp_path}/out", f"{tmp_path}/checkpoint",
        ))
        assert spark.conf.get(STATE_STORE) == default and spark.conf.get(RESERVE_AHEAD, None) is None
        with state_on_disk(spark):
            assert spark.conf.get(RESERVE_AHEAD) == "false"
    finally:
        spark.conf.set(STATE_STORE, before)
    out = spark.read.schema("release_id bigint, deployment_name string, fired boolean").parquet(f"{tmp_path}/out").collect()
    assert {(r["deployment_name"], r["release_id"]) for r in out} == {("dep-0", 6), ("dep-1", 4), ("dep-2", 5)}
    assert used.value == len(rows)
    # State of windows beyond the heap, as in streams that write tables.
    assert "RocksDB" in next(Path(f"{tmp_path}/checkpoint/offsets").glob("0")).read_text()


def _spread_points(spark, n=600, seed=5):
    rng = np.random.default_rng(seed)
    data = np.concatenate([rng.normal(size=(n - 100, 4)), rng.normal(size=(100, 4)) * 50])
    rows = [(i, [float(x) for x in p], 1) for i, p in enumerate(data)]
    return data, spark.createDataFrame(rows, "pid bigint, features array<double>, copies bigint")


@pytest.mark.parametrize("spread", [0, 2, 1000])
def test_neighbours_do_not_depend_on_the_turns_of_the_cells(spark, spread):
    data, points = _spread_points(spark)
    out = neighbours.nearest_neighbours(points, 4, max_pivots=12, block_rows=40, spread=spread).collect()
    squared = ((data[:, None] - data[None]) ** 2).sum(axis=2)
    np.fill_diagonal(squared, np.inf)
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        got[r["pid"]].append(r["neighbour"])
    assert len(out) == 4 * len(data)
    assert all(got[i] == list(np.argsort(squared[i], kind="stable")[:4]) for i in range(len(data)))


def test_cells_take_turns_within_the_rows_they_may_move():
    assert neighbours._turns([3, 3, 3], 100) == [(0, 3)]
    assert neighbours._turns([3, 3, 3, 9, 1], 6) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert neighbours._turns([5], 0) == [(0, 1)]


def test_far_candidates_do_not_travel_to_a_cell(spark):
    """Bounds of whole cells let most candidates travel; those of the points' own blocks do not."""
    data = np.random.default_rng(5).uniform(size=(3000, 2))
    points = spark.createDataFrame([(i, [float(x) for x in p], 1) for i, p in enumerate(data)], "pid bigint, features array<double>, copies bigint")
    pivots = data[:40]
    assigned = neighbours._assign(points, pivots).cache()
    wide = neighbours._summarise(assigned, pivots, 4, 500)
    tight = neighbours._tightened(assigned, wide, 4, F.pmod("pid", F.lit(2)))
    squared = ((data[:, None] - data[None]) ** 2).sum(axis=2)
    np.fill_diagonal(squared, np.inf)
    kth = np.sqrt(np.partition(squared, 3, axis=1)[:, 3])
    moved = []
    for cells in (wide, tight):
        targets = {r["pid"]: set(r["targets"]) for r in neighbours._candidates(assigned, cells).collect()}
        moved.append(sum(map(len, targets.values())))
        home = {r["pid"]: r["cell"] for r in assigned.collect()}
        assert all(home[p] in targets[c] for p, c in zip(*np.nonzero(squared <= kth[:, None] ** 2), strict=True))
    assert moved[1] < moved[0] * 0.8
