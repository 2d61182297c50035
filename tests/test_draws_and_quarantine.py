"""Draws of an exact size; CSV lines that cannot be read."""

from __future__ import annotations

from collections import Counter
from hashlib import md5
from pathlib import Path

import pytest

from storepulse.operators.draws import draw, draw_again
from storepulse.schemas import struct
from storepulse.sources.quarantine import read_csv_split, summary

ROW = struct("a bigint, b string")


def frame(spark, n):
    rows = [(None if i == 3 else i, f"x{i % 3}") for i in range(n)]
    return spark.createDataFrame(rows, ROW).repartition(4), rows


def ordered(rows, seed):
    name = lambda r: ":".join([seed, *("null" if v is None else str(v) for v in r)])
    return sorted(rows, key=lambda r: md5(name(r).encode()).hexdigest())


@pytest.mark.parametrize("n", [0, 1, 57, 299, 300, 1000])
def test_draw_takes_exactly_the_first_of_the_shuffled_order(spark, n):
    given, rows = frame(spark, 300)
    found = [tuple(r) for r in draw(given, n, ("a", "b"), "s").collect()]
    assert Counter(found) == Counter(ordered(rows, "s")[:n])


@pytest.mark.parametrize("n", [0, 1, 40, 2000])
def test_draw_again_takes_any_row_any_number_of_times(spark, n):
    given, rows = frame(spark, 50)
    places = Counter(int(md5(f"s:draw:{i}".encode()).hexdigest()[:15], 16) * 50 // 16 ** 15
                     for i in range(n))
    order = ordered(rows, "s")
    found = {(r.a, r.b): r.times for r in draw_again(given, n, ("a", "b"), "s").collect()}
    assert found == {order[place]: times for place, times in places.items()}
    assert sum(found.values()) == n


def test_equal_rows_are_rows_of_their_own(spark):
    same = spark.createDataFrame([(1, "x")] * 20, ROW)
    assert draw(same, 7, ("a",), "s").count() == 7
    assert sum(r.times for r in draw_again(same, 30, ("a",), "s").collect()) == 30


def test_nothing_to_draw_from(spark):
    empty = spark.createDataFrame([], ROW)
    assert draw(empty, 5, ("a",), "s").collect() == []
    assert draw_again(empty, 5, ("a",), "s").collect() == []


def test_draws_of_another_seed_differ(spark):
    given, _ = frame(spark, 300)
    one, two = ({tuple(r) for r in draw(given, 50, ("a", "b"), s).collect()} for s in ("s", "t"))
    assert one != two


CUSTOMER = struct("id bigint, name string, age int, born date")
GOOD = ["1,Ana,30,1990-01-02", '2,"B, ""x""",,', "3,,41,"]
BAD = ["4,Eva", "5,Eva,old,1990-01-01", '6,"Eva,30,1990-01-01', "7,Eva,30,1990-01-01,more",
       "x8,Eva,30,1990-01-01", "9,Eva,30,yesterday"]


def files(scratch, lines, header="id,name,age,born\n"):
    for i in range(3):
        Path(f"{scratch}/{i}.csv").write_text(header + "".join(f"{x}\n" for x in lines[i::3]))


def test_lines_are_good_or_rejected(spark, scratch):
    files(scratch, GOOD + BAD)
    split = read_csv_split(spark, scratch, CUSTOMER)
    assert sorted((r.id, r.name, r.age, str(r.born)) for r in split.good.collect()) == [
        (1, "Ana", 30, "1990-01-02"), (2, 'B, "x"', None, "None"), (3, None, 41, "None")]
    assert sorted(r.text for r in split.rejected.collect()) == sorted(BAD)
    assert {Path(r.file).name for r in split.rejected.collect()} == {"0.csv", "1.csv", "2.csv"}
    assert {r.kind: r.n_rows for r in summary(split).collect()} == {"good": 3, "rejected": 6}


def test_lines_are_judged_by_all_fields_whatever_is_asked_for(spark, scratch):
    files(scratch, GOOD + BAD)
    split = read_csv_split(spark, scratch, CUSTOMER)
    assert sorted(r.id for r in split.good.select("id").collect()) == [1, 2, 3]
    assert split.good.count() == 3 and split.rejected.count() == 6


def test_without_header_and_without_lines(spark, scratch):
    files(scratch, GOOD + BAD, header="")
    split = read_csv_split(spark, scratch, CUSTOMER, header=False)
    assert (split.good.count(), split.rejected.count()) == (3, 6)
    Path(f"{scratch}/none").mkdir()
    Path(f"{scratch}/none/a.csv").write_text("id,name,age,born\n")
    split = read_csv_split(spark, f"{scratch}/none", CUSTOMER)
    assert (split.good.count(), split.rejected.count()) == (0, 0)
