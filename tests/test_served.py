"""Running results over many batches: as much work at the end as at the beginning."""

from __future__ import annotations

from pathlib import Path

import pytest

from storepulse.schemas import struct
from storepulse.streaming import aggregates, batches, served

SCHEMA = struct("district string, n_orders bigint")
KEYS = ("district",)


def play(spark, out, n, every=4, keep=None, first=0):
    """Batches in which district b and one of five others are changed."""
    write = served.folding_writer(out, "totals", SCHEMA, KEYS, every, keep)
    for b in range(first, n):
        rows = [("b", b), (None if b % 5 == 0 else f"d{b % 5}", b)]
        write(spark.createDataFrame(rows, SCHEMA).coalesce(1), b)


def found(spark, out, **more):
    rows = served.current(spark, out, "totals", SCHEMA, *KEYS, **more)
    return {row.district: row.n_orders for row in rows.collect()}


def expected(n):
    out = {}
    for b in range(n):
        out["b"] = b
        out[None if b % 5 == 0 else f"d{b % 5}"] = b
    return out


@pytest.mark.parametrize("n", [1, 3, 4, 9])
def test_current_rows_equal_the_newest_of_all_batches(spark, scratch, n):
    play(spark, scratch, n)
    everything = batches.read_output(spark, scratch, "totals", SCHEMA)
    newest = {r.district: r.n_orders for r in aggregates.latest(everything, *KEYS).collect()}
    assert found(spark, scratch) == newest == expected(n)


def test_work_does_not_grow_with_the_number_of_batches(spark, scratch):
    files = {}
    for n in (7, 27, 50):
        play(spark, scratch, n, keep=2, first=max((k for k in files), default=0))
        rows = served.current(spark, scratch, "totals", SCHEMA, *KEYS)
        files[n] = len(rows.inputFiles())
        assert found(spark, scratch) == expected(n)
    # A snapshot is one file or a few, and at most every - 1 batches come after it.
    assert max(files.values()) <= 4 + 3 * 2
    assert len(list(Path(scratch, "totals").glob("batch_id=*"))) <= 2 * 4
    assert len(list(Path(scratch, "snapshot/totals").glob("upto=*"))) == 2


def test_a_replayed_batch_makes_the_same_snapshot(spark, scratch):
    play(spark, scratch, 4)
    before = found(spark, scratch)
    play(spark, scratch, 4, first=3)
    assert found(spark, scratch) == before == expected(4)
    assert served.snapshots(spark, scratch, "totals") == [3]


def test_a_snapshot_that_was_not_finished_is_not_read(spark, scratch):
    play(spark, scratch, 6)
    (Path(scratch) / "snapshot/totals/upto=3/_SUCCESS").unlink()
    assert served.snapshots(spark, scratch, "totals") == []
    assert found(spark, scratch) == expected(6)


def test_an_unfinished_batch_is_not_read(spark, scratch):
    play(spark, scratch, 6)
    (Path(scratch) / "totals/batch_id=5/_SUCCESS").unlink()
    assert found(spark, scratch) == expected(5)


def test_as_of_an_earlier_batch(spark, scratch):
    play(spark, scratch, 9)
    assert found(spark, scratch, upto=5) == expected(6)


def test_nothing_written_gives_no_rows(spark, scratch):
    assert found(spark, scratch) == {}


def test_served_from_a_running_summary(spark, scratch):
    """A stateful stream of ten batches against grouping all rows at once."""
    folder = Path(scratch) / "in"
    folder.mkdir()
    schema = "district string, event_type string, total_amount double"
    for i in range(10):
        rows = [(f"d{j % (i + 1)}", "placed", float(j)) for j in range(20)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/part{i}")
        (part,) = Path(f"{scratch}/part{i}").glob("part-*.parquet")
        (folder / f"{i:02}.parquet").write_bytes(part.read_bytes())
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    totals = aggregates.running_totals(stream)
    out = f"{scratch}/out"
    query = served.start_served(totals, out, "totals", "district", every=3, availableNow=True)
    batches.run_to_end(query)
    rest = aggregates.running_totals(spark.read.schema(schema).parquet(str(folder)))
    bag = lambda rows: sorted(map(tuple, rows.select(*rest.columns).collect()))
    assert bag(served.current(spark, out, "totals", totals.schema, "district")) == bag(rest)
    assert served.snapshots(spark, out, "totals")[-1] >= 8
