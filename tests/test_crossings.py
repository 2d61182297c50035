"""Alerts that begin and end as a running mean crosses its limit."""

from __future__ import annotations

from datetime import datetime, timedelta
from fractions import Fraction
from pathlib import Path

import numpy as np

from storepulse.schemas import struct
from storepulse.streaming import batches, crossings

RATED = struct("courier_id string, order_id string, event_type string, rating double, "
               "event_timestamp timestamp")
NOON = datetime(2024, 5, 1, 12)


def stage(spark, folder, rows):
    """One file of ratings, given as courier, second, rating."""
    full = [(c, f"o{s:03}", "delivered", r, None if s < 0 else NOON + timedelta(seconds=s))
            for c, s, r in rows]
    n = len(list(Path(folder).glob("*.parquet"))) if Path(folder).exists() else 0
    Path(folder).mkdir(exist_ok=True)
    spark.createDataFrame(full, RATED).repartition(1).write.parquet(f"{folder}-{n}")
    (part,) = Path(f"{folder}-{n}").glob("part-*.parquet")
    (Path(folder) / f"{n:03}.parquet").write_bytes(part.read_bytes())


def run(spark, folder, out):
    orders = spark.readStream.schema(RATED).option("maxFilesPerTrigger", 1).parquet(folder)
    batches.run_to_end(crossings.start_crossings(orders, out, availableNow=True))
    return batches.read_output(spark, out, "crossings", crossings.rating_crossings(orders).schema)


def seen(rows):
    return sorted((r.courier_id or "", r.n_ratings, r.alert, r.mean_rating) for r in rows.collect())


def test_only_crossings_give_rows(spark, scratch):
    folder, out = f"{scratch}/in", f"{scratch}/out"
    # In the file's order b's second rating comes first; time decides.
    stage(spark, folder, [("a", 1, 2.0), ("a", 2, 2.0), ("b", 5, 5.0), ("b", 4, 1.0),
                          ("c", 1, 2.5), (None, 1, 1.0), ("a", 3, None), ("a", 4, float("nan"))])
    stage(spark, folder, [("a", 6, 2.9), ("a", 7, 3.1), ("c", 8, 2.5), ("b", 9, 1.0)])
    stage(spark, folder, [("a", 10, 0.0), ("b", 11, 1.0), ("c", 12, 2.4999)])
    rows = run(spark, folder, out)
    assert seen(rows) == [
        ("", 1, "begin", 1.0),
        ("a", 1, "begin", 2.0), ("a", 4, "end", 2.5), ("a", 5, "begin", 2.0),
        ("b", 1, "begin", 1.0), ("b", 2, "end", 3.0), ("b", 3, "begin", 2.33),
        ("c", 3, "begin", 2.5)]
    on = {r.courier_id: (r.n_ratings, r.order_id) for r in crossings.alerts_on(rows).collect()}
    assert on == {None: (1, "o001"), "a": (5, "o010"), "b": (3, "o009"), "c": (3, "o012")}


def test_state_outlives_the_query(spark, scratch):
    folder, out = f"{scratch}/in", f"{scratch}/out"
    stage(spark, folder, [("a", 1, 2.0)])
    assert seen(run(spark, folder, out)) == [("a", 1, "begin", 2.0)]
    assert seen(run(spark, folder, out)) == [("a", 1, "begin", 2.0)]
    stage(spark, folder, [("a", 2, 2.0), ("a", 3, 4.0)])
    assert seen(run(spark, folder, out)) == [("a", 1, "begin", 2.0), ("a", 3, "end", 2.67)]


def test_the_session_keeps_its_state_store(spark):
    before = spark.conf.get(crossings.PROVIDER)
    with crossings.rocks(spark):
        assert spark.conf.get(crossings.PROVIDER) == crossings.ROCKS
    assert spark.conf.get(crossings.PROVIDER) == before


def test_crossings_equal_exact_fractions():
    random = np.random.default_rng(4)
    for _ in range(300):
        micros = [int(x) for x in random.choice([0, 1, 2_499_999, 2_500_000, 2_500_001, 10 ** 37], 9,
                                                p=[.1, .1, .2, .3, .28, .02])]
        cut = random.integers(0, 8)
        state, found = (0, 0, False), []
        for part in (micros[:cut], micros[cut:]):
            if not part:
                continue
            total, n, low, _, at = crossings.crossings(*state, part, 2_500_000)
            found += [state[1] + int(i) + 1 for i in at]
            state = (total, n, low)
        low, expected = False, []
        for i in range(1, 10):
            now = Fraction(sum(micros[:i]), i) < 2_500_000
            expected += [i] * (now != low)
            low = now
        assert found == expected and state == (sum(micros), 9, low)
