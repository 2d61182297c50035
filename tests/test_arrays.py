"""Array documents read by several tasks."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest

from storepulse.schemas import struct
from storepulse.sources import arrays, files

SCHEMA = struct("id bigint, name string")
ODD = ['}', '{', '"', '\\', '\\"', '}{', 'a', 'é', '\n', ',', '[', ']', '\\\\', "'", '日']


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(scratch, name, rows, **how):
    Path(scratch, name).write_text(json.dumps(rows, **how), encoding="utf-8")


def test_as_the_multi_line_reader_in_several_tasks(spark, scratch, small_blocks):
    draw = random.Random(5)
    for n, how in enumerate(({}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")})):
        write(scratch, f"{n}.json", [
            {"id": n * 1000 + i, "name": "".join(draw.choices(ODD, k=draw.randint(0, 30))),
             "more": {"deep": [{"x": "}"}, {}]}} for i in range(40)], **how)
    write(scratch, "long.json", [{"id": 9000, "name": '}"{' * 500}, {"id": 9001, "name": None}])
    write(scratch, "none.json", [])
    found = arrays.read_json_array(spark, scratch, SCHEMA)
    expected = files.read_json(spark, scratch, SCHEMA, one_document=True)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.count() == 122
    assert arrays.pieces(spark, f"{scratch}/1.json").rdd.getNumPartitions() > 10


def test_what_is_cut_off_or_no_object(spark, scratch):
    Path(scratch, "a.json").write_text(' [1, "}", {"id": 1, "name": "x"}, {"id": 2, "na')
    assert [tuple(r) for r in arrays.read_json_array(spark, scratch, SCHEMA).collect()] == [(1, "x")]
    Path(scratch, "a.json").write_text("")
    assert arrays.read_json_array(spark, scratch, SCHEMA).count() == 0
