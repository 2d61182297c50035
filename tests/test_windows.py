"""Event-time windows of streams out of order: what is in a window, and what came too late."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from storepulse.schemas import struct
from storepulse.streaming import aggregates, batches, windows

EVENT = struct("event_timestamp timestamp, category string, total_amount double, risk_score double")
NOON = datetime(2024, 5, 1, 12)


def stage(spark, folder, rows):
    """One file of events, given as second, category."""
    full = [(None if s is None else NOON + timedelta(seconds=s), c, 1.0, 0.5) for s, c in rows]
    n = len(list(Path(folder).glob("*.parquet"))) if Path(folder).exists() else 0
    Path(folder).mkdir(exist_ok=True)
    spark.createDataFrame(full, EVENT).coalesce(1).write.parquet(f"{folder}-{n}")
    (part,) = Path(f"{folder}-{n}").glob("part-*.parquet")
    (Path(folder) / f"{n:03}.parquet").write_bytes(part.read_bytes())


def run(spark, folder, out, width="10 seconds", lateness="20 seconds"):
    events = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(folder)
    batches.run_to_end(windows.start_windows(events, out, width, lateness, availableNow=True))


def found(spark, out):
    at_rest = spark.createDataFrame([], EVENT)
    schema = aggregates.windowed_summary(at_rest, "10 seconds", "20 seconds").schema
    return {((r.window_start - NOON).seconds, r.category): (r.n_events, r.n_late)
            for r in windows.read_windows(spark, out, schema).collect()}


def plainly(parts, width=10, lateness=20):
    """The rule itself; a batch without rows follows the last one that has some."""
    newest, marks, windows_, late = None, [], {}, {}
    for rows in [*parts, []]:
        mark = marks[-2] if len(marks) > 1 else None
        for second, category in rows:
            if second is None:
                continue
            start = second // width * width
            is_late = mark is not None and start + width <= mark - lateness
            own = late if is_late else windows_
            own[start, category] = own.get((start, category), 0) + 1
            newest = second if newest is None else max(newest, second)
        marks.append(newest)
    closed = {k: n for k, n in windows_.items() if k[0] + width <= newest - lateness}
    return {k: (closed.get(k, 0), late.get(k, 0)) for k in {*closed, *late}}


PARTS = [
    [(0, "a"), (3, "a"), (12, "b"), (None, "a")],
    [(45, "a"), (1, "b")],             # 1 is late by no watermark yet
    [(50, "a"), (14, "b"), (5, None)],  # neither: the watermark of the batch before counts
    [(95, "b"), (2, "a"), (33, "c")],  # 2 is late, 33 is not
    [(41, "a"), (60, "c"), (4, None)],
    [(200, "a")],
]


def test_windows_and_late_events(spark, scratch):
    folder, out = f"{scratch}/in", f"{scratch}/out"
    for part in PARTS:
        stage(spark, folder, part)
    run(spark, folder, out)
    expected = plainly(PARTS)
    assert found(spark, out) == expected
    assert sum(late for _, late in expected.values()) == 2
    # Every event is in a closed window, too late, or in a window that is open still.
    counted = sum(n + late for n, late in found(spark, out).values())
    assert counted == sum(s is not None for part in PARTS for s, _ in part) - 1


def test_a_stream_that_goes_on_later(spark, scratch):
    """Started anew for each file, batches without rows come between; the rule holds."""
    folder, out = f"{scratch}/in", f"{scratch}/out"
    stage(spark, folder, [(0, "a")])
    run(spark, folder, out)
    stage(spark, folder, [(100, "a"), (5, "a")])
    run(spark, folder, out)
    stage(spark, folder, [(6, "a"), (85, "a")])
    run(spark, folder, out)
    stage(spark, folder, [(300, "a")])
    run(spark, folder, out)
    assert found(spark, out) == {(0, "a"): (2, 1), (80, "a"): (1, 0), (100, "a"): (1, 0)}


def test_a_replayed_batch_changes_nothing(spark, scratch):
    folder, out = f"{scratch}/in", f"{scratch}/out"
    for part in PARTS:
        stage(spark, folder, part)
    run(spark, folder, out)
    before = found(spark, out)
    rows = spark.read.parquet(f"{out}/passed/batch_id=3")
    write = windows.window_writer(out, "20 seconds", rows.schema, "category")
    held = spark.createDataFrame(rows.collect(), rows.schema)
    write(held, 3)
    assert found(spark, out) == before


@pytest.mark.parametrize("rows", [[], [(None, "a")]])
def test_streams_without_events(spark, scratch, rows):
    stage(spark, f"{scratch}/in", rows)
    run(spark, f"{scratch}/in", f"{scratch}/out")
    assert found(spark, f"{scratch}/out") == {}
