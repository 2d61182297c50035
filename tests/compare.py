"""Comparing a Spark result with the oracle's, as unordered bags of typed rows."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import SparkSession

from storepulse.session import builder


def local_session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        builder("storepulse-local")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def canonical(rows: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values by kind, rows in one order."""
    rows = rows[sorted(rows.columns)].copy()
    for name in rows.columns:
        column = rows[name]
        if pd.api.types.is_datetime64_any_dtype(column) or name.endswith("_date"):
            rows[name] = pd.to_datetime(column).astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(column):
            rows[name] = column.map(repr)
        else:
            rows[name] = column.map(str)
    return rows.sort_values(list(rows.columns)).reset_index(drop=True)


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> list[str]:
    if sorted(actual.columns) != sorted(expected.columns):
        return [f"columns {sorted(actual.columns)} instead of {sorted(expected.columns)}"]
    kinds = [
        f"{name}: {actual[name].dtype} instead of {expected[name].dtype}"
        for name in actual.columns
        if actual[name].dtype.kind != expected[name].dtype.kind
    ]
    if len(actual) != len(expected):
        return kinds + [f"{len(actual)} rows instead of {len(expected)}"]
    left, right = canonical(actual), canonical(expected)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        first = unequal.idxmax()
        kinds.append(f"{unequal.sum()} rows differ, first {left.loc[first].to_dict()} "
                     f"instead of {right.loc[first].to_dict()}")
    return kinds
