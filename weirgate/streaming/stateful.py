"""Keyed state over event time: runs of signals, and windows that keep their late rows.

Both hold rows back until the watermark has passed them and then work in order of time, so
what they emit does not depend on how the input was cut into micro-batches. State lives in
the state store, not on the heap; a key's rows beyond the watermark are deleted when emitted.
One key's events form one sequence by definition, so a busy key is as large as its rows
between two watermarks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor


# Keys share a state by hash, so the state store is called for blocks of rows and not for each
# row. A checkpoint keeps the number it was started with.
BUCKETS = 1024
# Rows of a bucket that are sorted together, and rows of one entry of its state.
BLOCK_ROWS, PART_ROWS = 100_000, 10_000


def _place(row: tuple) -> tuple:
    """Order of (micros, run_id, key, fired); a missing id comes first."""
    return row[0], row[1] is not None, row[1]


class SignalRuns(StatefulProcessor):
    """Rows (key, micros, run_id, fired) of a bucket of keys, emitted in order of time with the state of the last runs.

    Rows wait in parts, each in order of time and stored under its first millisecond. When
    the watermark moves, parts are read from the earliest on and merged only as far as they
    overlap. Of a key no more than the number of its last fired runs is kept.
    """

    def __init__(self, runs: int, key_type: str, id_type: str) -> None:
        self.runs, self.key_type, self.id_type = runs, key_type, id_type

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.waiting = handle.getMapState(
            "waiting", "first_ms bigint, part bigint",
            f"micros array<bigint>, ids array<{self.id_type}>, keys array<{self.key_type}>, fired array<boolean>",
        )
        self.streaks = handle.getValueState("streaks", f"keys array<{self.key_type}>, fired array<bigint>")
        # The only timer of the bucket, after the earliest millisecond that waits, and the parts so far.
        self.next = handle.getValueState("next", "timer bigint, parts bigint")

    def _wait(self, rows: list[tuple], parts: int) -> int:
        """Store sorted rows; the number of parts so far."""
        for start in range(0, len(rows), PART_ROWS):
            some = rows[start : start + PART_ROWS]
            self.waiting.updateValue((some[0][0] // 1000, parts), tuple(list(x) for x in zip(*some, strict=True)))
            parts += 1
        return parts

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        timer, parts = self.next.get() if self.next.exists() else (None, 0)
        wanted = timer
        new = ((micros, run_id, name, bool(fired)) for _, name, _, micros, run_id, fired in rows)
        while block := sorted(islice(new, BLOCK_ROWS), key=_place):
            parts = self._wait(block, parts)
            first = block[0][0] // 1000 + 1
            wanted = first if wanted is None else min(first, wanted)
        if wanted != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wanted)
        self.next.update((wanted, parts))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now, (_, parts) = timerValues.getCurrentWatermarkInMs(), self.next.get()
        stored = sorted(tuple(name) for name in self.waiting.keys())
        due = [name for name in stored if name[0] < now]
        streaks = {}
        if self.streaks.exists():
            streaks = {_same(k): (k, n) for k, n in zip(*self.streaks.get(), strict=True)}
        held, unsorted = [], 0
        for name, following in zip(due, [*due[1:], None], strict=True):
            found = list(zip(*self.waiting.getValue(name), strict=True))
            self.waiting.removeKey(name)
            held += found
            unsorted += len(found)
            if following and unsorted < BLOCK_ROWS:
                continue
            held.sort(key=_place)
            unsorted = 0
            # Nothing before the next part's first row can come any more.
            ready = bisect_left(held, (following[0] if following else now) * 1000, key=lambda row: row[0])
            for start in range(0, ready, PART_ROWS):
                some = held[start : min(start + PART_ROWS, ready)]
                micros, ids, keys, fired = (list(x) for x in zip(*some, strict=True))
                yield Row(micros=micros, ids=ids, keys=keys, repeated=[self._repeated(streaks, *x) for x in zip(keys, fired, strict=True)])
            held = held[ready:]
        kept = list(streaks.values())
        self.streaks.update(([k for k, _ in kept], [n for _, n in kept]))
        parts = self._wait(held, parts)
        left = [name[0] for name in stored[len(due) :]] + [row[0] // 1000 for row in held[:1]]
        timer = min(left) + 1 if left else None
        if left:
            self.handle.registerTimer(timer)
        self.next.update((timer, parts))

    def _repeated(self, streaks: dict, key: Any, fired: bool) -> bool:
        """Whether this run ends a full streak of its key; ``streaks`` is brought up to date."""
        same = _same(key)
        if not fired:
            streaks.pop(same, None)
            return False
        streak = min(streaks.get(same, (None, 0))[1] + 1, self.runs)
        streaks[same] = (key, streak)
        return streak == self.runs

    def close(self) -> None:
        pass


def _same(key: Any) -> Any:
    """What equal keys have in common, also where Python compares them otherwise or not at all."""
    return key if key is None or isinstance(key, (str, int)) else repr(key)


def persistence_stream(history: DataFrame, by: str, at: str, run_id: str, fired: str, runs: int = 2, watermark: str = "10 minutes") -> DataFrame:
    """(by, at, run_id, signal_persistence) of a stream of runs, as the batch
    :func:`weirgate.operators.capture.signal_persistence` gives for the whole history.

    A run waits until the watermark has passed it, is then placed after all earlier runs of
    its key, and needs only the last ``runs`` flags. Runs later than the watermark are
    dropped and counted by Spark; runs without a time have no place and are left out.
    """
    types = dict(history.dtypes)
    timed = history.where(F.col(at).isNotNull()).withColumn(at, F.col(at).cast("timestamp"))
    rows = timed.withWatermark(at, watermark).select(
        F.pmod(F.xxhash64(by), F.lit(BUCKETS)).cast("int").alias("bucket"),
        F.col(by).alias("key"), F.col(at), F.unix_micros(at).alias("micros"),
        F.col(run_id).alias("run_id"), F.col(fired).alias("fired"),
    )
    out = rows.groupBy("bucket").transformWithState(
        SignalRuns(runs, types[by], types[run_id]),
        f"micros array<bigint>, ids array<{types[run_id]}>, keys array<{types[by]}>, repeated array<boolean>", "append", "EventTime",
    )
    found = out.select(F.inline(F.arrays_zip("keys", "micros", "ids", "repeated")))
    return found.select(
        F.col("keys").alias(by), F.timestamp_micros("micros").alias(at), F.col("ids").alias(run_id),
        F.when(F.col("repeated"), "repeated_signal").otherwise("single_event").alias("signal_persistence"),
    )


class WindowsWithLate(StatefulProcessor):
    """Label counts of tumbling windows; rows of windows already closed come out as they are."""

    def __init__(self, size_ms: int) -> None:
        self.size = size_ms

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start bigint", "labels array<string>, n array<bigint>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        counts: dict[int, dict] = defaultdict(lambda: defaultdict(int))
        for row in rows:
            start = row["ms"] // self.size * self.size
            if start + self.size <= now:
                yield Row(endpoint_name=key[0], deployment_name=key[1], kind="late", ms=row["ms"], label=row["label"], n=1)
            else:
                counts[start][row["label"]] += 1
        for start, labels in counts.items():
            if self.windows.containsKey((start,)):
                for label, n in zip(*self.windows.getValue((start,)), strict=True):
                    labels[label] += n
            else:
                self.handle.registerTimer(start + self.size)
            self.windows.updateValue((start,), (list(labels), list(labels.values())))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size
        for label, n in zip(*self.windows.getValue((start,)), strict=True):
            yield Row(endpoint_name=key[0], deployment_name=key[1], kind="window", ms=start, label=label, n=n)
        self.windows.removeKey((start,))

    def close(self) -> None:
        pass


def windows_with_late_rows(records: DataFrame, size_seconds: int = 3600) -> DataFrame:
    """(endpoint_name, deployment_name, kind, at, label, n): counts of each closed window
    (``window``, at its start) and every row that came after its window (``late``, at its own time).

    ``records`` come from :func:`weirgate.streaming.monitor.stream_records`, whose watermark
    decides what is late. Spark drops late rows by the watermark column before an operator
    sees them; here only a plain copy of the time goes on, so the operator itself tells them
    apart. Counts of the windows and late rows add up to all labels of records with a time.
    """
    labels = records.where(F.col("timestamp_utc").isNotNull()).select(
        "endpoint_name", "deployment_name", F.unix_millis("timestamp_utc").alias("ms"), F.explode("labels").alias("label")
    )
    out = labels.groupBy("endpoint_name", "deployment_name").transformWithState(
        WindowsWithLate(size_seconds * 1000),
        "endpoint_name string, deployment_name string, kind string, ms bigint, label string, n bigint", "append", "EventTime",
    )
    return out.select("endpoint_name", "deployment_name", "kind", F.timestamp_millis("ms").alias("at"), "label", "n")
