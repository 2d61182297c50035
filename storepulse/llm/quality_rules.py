"""Quality rules: clean line by line, reject what loses too much text."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from storepulse.llm.common import SPACES, map_rows

# Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
WINDOW = 5
MOST_REPEATED = 20  # per cent of the words

# A line fails the punctuation rule if symbols and exclamation marks are more than this
# part of its characters, or if it has this many words and nearly all are in capitals.
MOST_MARKS = 0.1
SHOUTED_WORDS, SHOUTED = 4, 0.9
# A line fails the navigation rule if separators are this part of its words.
MOST_SEPARATORS = 0.25
LEAST_SEPARATORS = 2
SEPARATORS = {"|", ">", "»", "·", "•", "::"}
# Phrases of boilerplate lines. Licence notices are not among them: a text must keep its own.
BOILERPLATE = re.compile(
    r"(?i)all rights reserved|terms of (use|service)|privacy policy|accept (all )?cookies|"
    r"cookie (policy|settings)|click here|sign up|log ?in to|subscribe (now|to our)|"
    r"share (this|on)|javascript (is|must be)|lorem ipsum"
)
# A document is rejected if its lines lose more than this part of its word characters.
MOST_LOST = 0.5


def size_of(text: str) -> int:
    """Code points that are not white space."""
    return len(text) - sum(text.count(c) for c in SPACES)


def fails(line: str) -> str | None:
    """The rule that a line with at least one word fails, or None."""
    size, words = size_of(line), line.split()
    marks = sum(line.count(c) for c in SYMBOLS + "!")
    if marks > MOST_MARKS * size and sum(w in SEPARATORS for w in words) < LEAST_SEPARATORS:
        return "punctuation"
    if len(words) >= SHOUTED_WORDS and sum(
            w.isupper() and len(w) > 1 for w in words) >= SHOUTED * len(words):
        return "punctuation"
    separators = sum(w in SEPARATORS for w in words)
    if separators >= LEAST_SEPARATORS and separators > MOST_SEPARATORS * len(words):
        return "navigation"
    if BOILERPLATE.search(line):
        return "boilerplate"
    return None


def repeated_words(words: list) -> int:
    """Words that lie in a window of five words that the text has more than once."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, until = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + WINDOW - max(until, i)
            until = i + WINDOW
    return covered


@dataclass(frozen=True)
class Judged:
    """Base counts, what the line rules removed, and the verdicts on one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    lost_chars: int
    cleaned: str

    @staticmethod
    def of(text: str | None) -> Judged:
        text = text or ""
        words = text.encode().split()
        seen: set[str] = set()
        duplicates = lost = 0
        left = []
        for line in text.split("\n"):
            if not line.strip(SPACES):
                left.append(line)
                continue
            again = line in seen
            duplicates += again
            seen.add(line)
            if again or fails(line):
                lost += size_of(line)
            else:
                left.append(line)
        size, n = size_of(text), len(words)
        repeated = repeated_words(words)
        failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
        return Judged(
            n, size, sum(text.count(c) for c in SYMBOLS), duplicates, repeated, failed,
            not failed and lost <= MOST_LOST * size, lost, "\n".join(left),
        )


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, lost_chars long"
)


def clean(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Counts, verdict and (on request) the cleaned text of every document.

    Reads ``doc_id, text``; other columns are ignored, whatever their names. Lines that
    repeat an earlier one or fail a rule are removed whole; a document whose lines lose
    more than half of its word characters, or that fails the base rules, is not kept.
    NULL and empty texts have no words, fail the base and stay the empty text; repeated
    rows are judged alike. One pass, no shuffle; a text is held by one task.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {COLUMNS}" + (", cleaned string" if with_text else "")
    names = [part.split()[0] for part in schema.split(", ")][1:]

    def of(batch: pa.RecordBatch) -> list:
        judged = [Judged.of(text) for text in batch.column(1).to_pylist()]
        return [batch.column(0), *([getattr(j, name) for j in judged] for name in names)]

    return map_rows(docs.select("doc_id", "text"), schema, of)
