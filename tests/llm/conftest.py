from __future__ import annotations

import pytest

# doc_id, text: nulls, empty and white texts, one very long word and text, repeated rows.
LONG = " ".join(f"word{i % 997}" for i in range(60_000))
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a row without an id"), (5, "x" * 100_000),
    (6, LONG), (7, "the same row twice"), (7, "the same row twice"), (8, "\x00\x85 \u3000é😀\r\n  "),
]
# Extra columns whose names the operators use inside.
CLASHING = ("size", "score", "id", "root", "held", "place", "list", "draw", "bin", "host", "kept")


def documents(spark, rows, source="s"):
    """Documents with extra columns that clash with names used inside."""
    full = [(i, t, "en", source, None if t is None else len(t), *["clash"] * len(CLASHING))
            for i, t in rows]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long, "
        + ", ".join(f"{name} string" for name in CLASHING))


@pytest.fixture(scope="session")
def awkward(spark):
    return documents(spark, AWKWARD)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
