"""Personal data: labelers that vote, expectation-maximisation, a final span classifier."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import map_rows, slices

# The kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

# Base patterns. Fixed values, but for guards that spare starts which cannot match.
EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Loose patterns of what may be personal data; they cover far more than the base.
LOOSE = {
    "email": re.compile(
        r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]|\{at\}|@) ?"
        r"[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]{1,63}){1,8}"),
    "ip": re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\[?\.\]?[0-9]{1,3}){3}(?![0-9A-Za-z])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ .-]?[0-9]{2,7}){2,4}(?![0-9A-Za-z])"),
    "phone": re.compile(
        r"(?<![0-9A-Za-z.])(?:00|\+)?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}"
        r"(?![0-9A-Za-z])"),
}
HINTS = {"email": re.compile(r"@|at[)\]}]"), "ip": DIGIT, "card": DIGIT, "phone": DIGIT}

# The gazetteer. Ends of host names; first digits of card networks; what
# private networks and dialling codes begin with.
HOST_ENDS = frozenset("com org net edu gov info io co uk de fr es it eu".split())
CARD_STARTS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
PRIVATE = ("10.", "127.", "192.168.", "0.", "255.")
DIALLING = ("+1", "+33", "+34", "+44", "+49", "0033", "0034", "0044", "0049")
# Words before a span that speak for each kind, in four languages.
CUES = {
    "email": "email e-mail mail contact write correo courriel kontakt".split(),
    "ip": "ip address host server addr adresse serveur".split(),
    "card": "card visa mastercard amex credit iban account karte tarjeta carte".split(),
    "phone": "phone tel call fax mobile telefon teléfono téléphone handy".split(),
}
# Words before a span that speak against every kind.
COUNTER_CUES = frozenset("version order invoice isbn section figure page release id ref".split())
# Characters before a span that the context labelers read.
CONTEXT = 24

LABELERS = ("shape", "gazetteer", "checksum", "cue", "counter", "setting")
# A span is added from this probability on.
THRESHOLD = 0.9
EM_ROUNDS = 100
# Pseudo-votes that keep a labeler's reliability within bounds, and tie its classes down.
PSEUDO = 2.0
STEPS, RATE, RIDGE = 400, 0.5, 0.01


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(span: str) -> str:
    return "".join(DIGIT.findall(span))


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each at sign: the name before it as far as it goes, and the host after."""
    until, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > until and EMAIL_NAME.match(text[start - 1]):
            start -= 1
        host = EMAIL_HOST.match(text, at + 1) if start < at else None
        until = host.end() if host else at + 1
        if host:
            yield start, until
        at = text.find("@", until)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind and then start; code points, end exclusive."""
    spans = [("email", *span) for span in base_emails(text)]
    if not DIGIT.search(text):
        return spans
    spans += [("ip", *m.span()) for m in IP.finditer(text)
              if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255
                     for part in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = digits_of(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text)
                  if 8 <= len(digits_of(m[0])) <= 15]
    return spans


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """Each labeler's vote on a candidate: 1 for, -1 against, 0 none."""
    span, before = text[start:end], text[max(0, start - CONTEXT):start]
    digits, words = digits_of(span), re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", before.lower())
    if kind == "email":
        shape = 1 if " " not in span else -1
        gazetteer = 1 if re.split(r"[.)\]} ]", span.lower())[-1] in HOST_ENDS else -1
        checksum = 1 if "@" in span else 0
    elif kind == "ip":
        parts = [int(p) for p in re.findall("[0-9]+", span)]
        shape = 1 if all(p <= 255 for p in parts) else -1
        gazetteer = -1 if span.startswith(PRIVATE) else 0
        checksum = 1 if max(parts) > 99 else -1
    elif kind == "card":
        shape = 1 if 13 <= len(digits) <= 19 else -1
        gazetteer = 1 if digits.startswith(CARD_STARTS) else -1
        checksum = 1 if luhn(digits) else -1
    else:
        shape = 1 if 9 <= len(digits) <= 15 else -1
        gazetteer = 1 if span.startswith(DIALLING) else 0
        checksum = 1 if re.search(r"[ ().-]", span) else -1
    cue = 1 if any(w in CUES[kind] for w in words) else 0
    counter = -1 if any(w in COUNTER_CUES for w in words) or before[-1:] in {"#", "$", "€"} else 0
    outside = text[start - 1:start] + text[end:end + 1]
    setting = -1 if any(c.isalnum() or c in "/=_\"" for c in outside) else 1
    return shape, gazetteer, checksum, cue, counter, setting


def candidates(text: str) -> list[tuple[str, int, int, tuple[int, ...]]]:
    """Loose matches of each kind with the labelers' votes."""
    found = []
    for kind, pattern in LOOSE.items():
        if HINTS[kind].search(text):
            found += [(kind, *m.span(), votes(kind, text, *m.span()))
                      for m in pattern.finditer(text)]
    return found


@lru_cache(maxsize=4096)
def features(kind: str, pattern: tuple[int, ...]) -> np.ndarray:
    """Indicators of each vote, each agreeing pair with the checksum, and the kind."""
    one = [float(v == x) for v in pattern for x in (1, -1)]
    return np.array([*one, float(pattern[0] == pattern[2] == 1), float(pattern[1] == pattern[2] == 1),
                     *(float(kind == k) for k in KINDS)])


def agreed(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probability that candidates of each vote pattern are personal data, by EM.

    A labeler votes for, against or not at all, independently given the truth. Starts
    from the majority; ``PSEUDO`` votes keep a labeler a little better than chance, which
    also keeps the two classes from changing places.
    """
    truth = 1 / (1 + np.exp(-patterns.sum(1).astype(float)))
    for _ in range(EM_ROUNDS):
        share = (counts @ truth + 1) / (counts.sum() + 2)
        log = np.tile(np.log([[1 - share], [share]]), len(patterns))
        for j in range(patterns.shape[1]):
            for k, weight in enumerate((counts * (1 - truth), counts * truth)):
                tally = np.array([weight[patterns[:, j] == v].sum() for v in (-1, 0, 1)])
                tally += PSEUDO * np.array([2, 1, 1] if k == 0 else [1, 1, 2])
                log[k] += np.log(tally / tally.sum())[patterns[:, j] + 1]
        truth, before = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500))), truth
        if np.abs(truth - before).max() < 1e-9:
            break
    return truth


@dataclass(frozen=True)
class SpanClassifier:
    """A logistic classifier of candidates, trained on the aggregated votes."""

    weights: np.ndarray

    @staticmethod
    def fit(tally: list[tuple[str, tuple[int, ...], int]]) -> SpanClassifier:
        """From how often each kind met each vote pattern. Nothing seen, nothing added."""
        size = len(features("email", (0,) * len(LABELERS))) + 1
        if not tally:
            return SpanClassifier(np.append(np.zeros(size - 1), -20.0))
        truth = np.zeros(len(tally))
        for kind in KINDS:
            at = [i for i, t in enumerate(tally) if t[0] == kind]
            if at:
                truth[at] = agreed(np.array([tally[i][1] for i in at]),
                                   np.array([tally[i][2] for i in at], float))
        x = np.array([np.append(features(kind, pattern), 1.0) for kind, pattern, _ in tally])
        counts = np.sqrt(np.array([n for *_, n in tally], float))
        counts /= counts.sum()
        weights = np.zeros(size)
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-x @ weights))
            slope = x.T @ (counts * (p - truth)) + RIDGE * weights / len(tally)
            curve = (x * (counts * p * (1 - p))[:, None]).T @ x
            step = np.linalg.solve(curve + (RIDGE / len(tally) + 1e-6) * np.eye(size), slope)
            weights = weights - RATE * step
            if np.abs(step).max() < 1e-9:
                break
        return SpanClassifier(weights)

    def probability(self, kind: str, pattern: tuple[int, ...]) -> float:
        logit = float(features(kind, pattern) @ self.weights[:-1] + self.weights[-1])
        return 1 / (1 + np.exp(-min(max(logit, -500.0), 500.0)))

    def accepts(self) -> dict:
        """A memory of verdicts by kind and vote pattern."""
        return Verdicts(self)


class Verdicts(dict):
    def __init__(self, model: SpanClassifier):
        super().__init__()
        self.model = model

    def __missing__(self, key: tuple) -> bool:
        self[key] = verdict = self.model.probability(*key) >= THRESHOLD
        return verdict


def train(docs: DataFrame) -> SpanClassifier:
    """Votes are counted over every document; the driver sees one row per vote pattern.

    There are at most 4 * 3 ** 6 patterns. Each batch is tallied before anything is
    shuffled.
    """
    def of(batch: pa.RecordBatch) -> list[list]:
        counts: dict[tuple, int] = {}
        for text in batch.column(0):
            for kind, _, _, pattern in candidates(text.as_py() or ""):
                counts[kind, pattern] = counts.get((kind, pattern), 0) + 1
        return [[k for k, _ in counts], [list(p) for _, p in counts], list(counts.values())]

    rows = map_rows(docs.select("text"), "kind string, votes array<int>, n long", of).groupBy(
        "kind", "votes").agg(F.sum("n").alias("n")).collect()
    return SpanClassifier.fit(sorted((r.kind, tuple(r.votes), r.n) for r in rows))


def all_spans(text: str, accepts: dict) -> tuple[list, list]:
    """Base spans, and all: the base and accepted candidates that overlap none of them."""
    base = base_spans(text)
    # Disjoint stretches in order, so that a neighbour on each side tells of an overlap.
    taken: list[tuple[int, int]] = []
    for start, end in sorted((start, end) for _, start, end in base):
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(end, taken[-1][1]))
        else:
            taken.append((start, end))
    added = []
    for kind, start, end, pattern in candidates(text):
        if accepts[kind, pattern]:
            place = bisect_left(taken, (end, 0))
            if not place or taken[place - 1][1] <= start:
                added.append((kind, start, end))
                taken.insert(place, (start, end))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), *s[1:]))


def joined(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find(docs: DataFrame, model: SpanClassifier) -> DataFrame:
    """``doc_id``, counts by kind and digest of the base spans, and all ``spans``.

    Reads ``doc_id, text``; other columns are ignored, whatever their names. NULL texts
    are empty and have no spans; repeated rows are searched alike. Spans are listed by
    kind (email, ip, card, phone) and start, as code points, end exclusive.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batch: pa.RecordBatch) -> list:
        accepts = shared.value.accepts()
        out: list[list] = [[], [], [], [], [], []]
        for text in batch.column(1):
            base, spans = all_spans(text.as_py() or "", accepts)
            for i, kind in enumerate(KINDS):
                out[i].append(sum(s[0] == kind for s in base))
            out[4].append(sha256(joined(base).encode()).hexdigest())
            out[5].append(joined(spans))
        return [batch.column(0), *out]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(
        docs.select("doc_id", "text"),
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string", of)


def masked(text: str, accepts: dict) -> str:
    """The text with each span replaced by its kind in angle brackets; overlaps merged."""
    _, spans = all_spans(text, accepts)
    out, until = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= until:
            out += [text[until:start], f"<{kind.upper()}>"]
        until = max(until, end)
    return "".join([*out, text[until:]])


def redact(docs: DataFrame, model: SpanClassifier) -> DataFrame:
    """The documents with all spans masked; ``n_chars``, if there, follows the text.

    Other columns pass through as they are; NULL texts stay NULL.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepts = shared.value.accepts()
        for batch in slices(batches):
            texts = [None if t.as_py() is None else masked(t.as_py(), accepts)
                     for t in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
