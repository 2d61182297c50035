from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import lru_cache
from itertools import product
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storepulse.llm import collocations, conversations, topk
from storepulse.llm.common import BATCH, written
from tests.llm.conftest import CLASHING, documents


# Phrases

def mined_plainly(rows, least, first):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    f = {p: a for p, a in f.items() if a >= least}
    out = []
    for (lang, words), a in f.items():
        if len(words) < 2:
            continue
        longer = [q for (own, q), b in f.items() if own == lang and len(q) > len(words) and b >= a
                  and any(q[i:i + len(words)] == words for i in range(len(q)))]
        if longer:
            continue
        score, _, left, right = min(
            (1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k,
             f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        out.append((lang, " ".join(words), a, left, right, n[lang], score))
    ranked = []
    for lang in {row[0] for row in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(own[:first], 1)]
    return sorted(ranked)


def phrase_docs(spark, seed=3, n=120):
    random = np.random.default_rng(seed)
    words = ["a", "B", "cé", "the", "of", "x-y", "ÀB", "zz", "q　r", "w"]
    weights = np.array([9, 8, 3, 6, 5, 1, 1, 2, 1, 1.0])
    texts = []
    for i in range(n):
        parts = random.choice(words, size=random.integers(0, 60), p=weights / weights.sum())
        gaps = random.choice([" ", "  ", "\t", ". ", ",", "\n", "! "], size=len(parts),
                             p=[.7, .05, .05, .05, .05, .05, .05])
        texts.append("".join(w + g for w, g in zip(parts, gaps)))
    rows = [(["en", "de", None][i % 3], t) for i, t in enumerate(texts)]
    return rows + [("en", None), ("en", ""), (None, " \n "), ("fr", "the of the of " * 400)]


def given(spark, rows):
    full = [(i, t, lang, *["clash"] * len(CLASHING)) for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, "
                                 + ", ".join(f"{c} string" for c in CLASHING)).repartition(3)


# Groups of all, of few and of hardly any suffixes: the last extends prefixes to full length.
@pytest.mark.parametrize(("group", "least"), [(1 << 20, 3), (200, 20), (12, 3)])
def test_phrases_equal_plain_counting(spark, monkeypatch, group, least):
    monkeypatch.setattr(collocations, "BUILT", 100)
    rows = phrase_docs(spark)
    found = collocations.mine(given(spark, rows), least, 40, group).collect()
    assert sorted(map(tuple, found)) == mined_plainly(rows, least, 40)


def test_phrases_over_closed_blocks_and_sliced_texts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 7)
    numbers = collocations.Numbers()
    text = "ab cd. ef  gh\tab abcdefghijklmnop q"
    parts = list(collocations.tokens(text, numbers))
    names = list(numbers)
    assert len(parts) > 2
    assert [names[i] for i in np.concatenate(parts)] == [
        b"ab", b"cd", b"\xff", b"ef", b"gh", b"ab", b"abcdefghijklmnop", b"q"]


def test_phrases_send_workers_a_block_at_a_time(spark, monkeypatch):
    at_once = {}
    monkeypatch.setattr(collocations, "written", lambda rows, purpose, n=None: (
        at_once.setdefault(purpose, n), written(rows, purpose, n))[1])
    before = spark.conf.get(BATCH)
    rows = phrase_docs(spark)
    found = collocations.mine(given(spark, rows), 3, 40, 200).collect()
    assert sorted(map(tuple, found)) == mined_plainly(rows, 3, 40)
    assert at_once["blocks"] == collocations.TEXTS
    assert {at_once[p] for p in ("words", "prefixes-2", "phrases")} == {collocations.BLOCKS}
    assert spark.conf.get(BATCH) == before


def test_written_by_few_rows_at_once(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows = spark.range(10).coalesce(1).mapInArrow(sizes, "n long")
    assert sorted(r.n for r in written(rows, "test-few", 3).collect()) == [1, 3, 3, 3]
    assert [r.n for r in written(rows, "test-all").collect()] == [10]


def test_phrases_send_suffixes_of_frequent_pairs_only(spark, monkeypatch):
    """Words that are frequent side by side; each rare pair of them parts a text."""
    monkeypatch.setattr(collocations, "PAIRS", 50)
    monkeypatch.setattr(collocations, "PAIR_SHARE", 500)
    random = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(60)])
    rows = [(["en", None][i % 2], " ".join([*random.choice(words, 40), "so it is said"]))
            for i in range(150)]
    sent, routed = [], collocations.routed
    monkeypatch.setattr(collocations, "routed", lambda *a: (sent.append(routed(*a)), sent[0])[1])
    found = collocations.mine(given(spark, rows), 20, 40, 200).collect()
    assert sorted(map(tuple, found)) == mined_plainly(rows, 20, 40)
    places = 150 * 43
    assert sent[0].agg(F.sum("n")).first()[0] < places // 5


def test_pairs_are_packed_by_their_bytes():
    numbers = np.array([0, 1, 255, 256, 70_000, (1 << 32) - 1], np.int64)
    assert collocations.unplaned(collocations.planes(numbers)).tolist() == numbers.tolist()
    assert len(collocations.unplaned(collocations.planes(numbers[:0]))) == 0


def test_phrases_of_awkward_texts(spark, awkward, nothing):
    assert collocations.mine(nothing).collect() == []
    long = collocations.mine(awkward, least=60).collect()
    assert all(row.lang == "en" for row in long) and long
    assert all(row.n == long[0].n for row in long)


# Top k

def vectors(spark, rows):
    full = [(i, v, *["clash"] * len(CLASHING)) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, "
                                 + ", ".join(f"{c} string" for c in CLASHING)).repartition(3)


def best_plainly(rows, k, every):
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (query, q) in enumerate(whole):
        if query % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i)
                        for place, (i, v) in enumerate(whole) if place != at and len(v) == len(q))
        out += [(query, rank, i, max(-2**63, min(2**63 - 1, -s)))
                for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_topk_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 64)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "STRIP", 2)
    random = np.random.default_rng(1)
    x = random.normal(size=(500, 8))
    x[::5] = np.round(x[::5])          # ties
    x[100:140] = x[100]                # one vector many times
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(0, x[3].tolist()), (50, x[7].tolist()), (50, x[7].tolist()), (None, x[1].tolist()),
             (600, None), (650, []), (700, [1.0, None]), (750, [float("nan")] * 8),
             (800, [float("inf")] * 8), (850, [0.0] * 8), (900, [1.0, 2.0]), (901, [3.0, -1.0]),
             (950, [5.0]), (1000, [1e30, -1e30, 1.0]), (1001, [1e30, 1e25, 7.0])]
    found = topk.search(vectors(spark, rows)).collect()
    assert sorted(map(tuple, found)) == best_plainly(rows, 5, 50)


def test_topk_with_few_candidates_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    found = topk.search(vectors(spark, rows)).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 1, 256 * 128), (0, 2, 2, -256 * 256)]
    assert topk.search(vectors(spark, [])).collect() == []


def test_reading_stops_before_the_lists_end():
    random = np.random.default_rng(2)
    centres = random.normal(size=(20, 16))
    x = np.floor(256 * (np.repeat(centres, 50, 0) + 0.05 * random.normal(size=(1000, 16))))
    lists = np.argsort(-x, axis=0, kind="stable").T.astype(np.uint16)
    q = x[::100]
    original = topk.DEPTHS
    at, place = topk.read_lists(q, x, lists, 5, np.full(len(q), -np.inf), np.arange(0, 1000, 100))
    best = {(i, j) for i in range(len(q))
            for j in [j for j in np.argsort(-(q[i] @ x.T), kind="stable") if j != 100 * i][:5]}
    assert {(i, j) for i, j in zip(at, place)} >= best
    # A depth short of all resolves some queries already.
    topk.DEPTHS = original[:-1]
    try:
        early, _ = topk.read_lists(q, x, lists, 5, np.full(len(q), -np.inf), np.full(len(q), -1))
    finally:
        topk.DEPTHS = original
    assert len(early)


# Conversations

def audited_plainly(codes):
    """All alignments with all strings of the grammar up to twice the turns and three more."""
    best = None
    for length in range(2 * len(codes) + 4):
        if length == 1:
            continue
        letters = "s" * (length % 2) + "ua" * (length // 2)

        @lru_cache(None)
        def of(i, j):
            if i == len(codes) and j == len(letters):
                return 0, ""
            options = []
            if i < len(codes):
                cost, audit = of(i + 1, j)
                options.append((cost + 4, "D" + audit))
            if j < len(letters) and letters[j] != "s":
                cost, audit = of(i, j + 1)
                options.append((cost + 3, "I" + audit))
            if i < len(codes) and j < len(letters) and codes[i] != "x":
                cost, audit = of(i + 1, j + 1)
                cost += 3 * codes[i].isupper()
                if codes[i].lower() == letters[j]:
                    options.append((cost, "K" + audit))
                if letters[j] != "s":
                    options.append((cost + 3, "R" + audit))
            return min(options) if options else (10 ** 9, "")

        found = of(0, 0)
        best = min(best, found) if best else found
    return best


def test_audits_equal_all_alignments():
    for n in range(5):
        for codes in product("suaxUAo", repeat=n):
            assert conversations.cheapest("".join(codes)) == audited_plainly("".join(codes))
    random = np.random.default_rng(1)
    for _ in range(300):
        codes = "".join(random.choice(list("suaxUASoO"), size=random.integers(5, 11)))
        assert conversations.cheapest(codes) == audited_plainly(codes)


def test_chained_segments_equal_the_whole():
    random = np.random.default_rng(2)
    for _ in range(200):
        codes = "".join(random.choice(list("suuuaaaxUAo"), size=random.integers(0, 24)))
        chain, at = conversations.Chain(), 0
        while at < len(codes):
            size = random.integers(1, 6)
            chain.add(codes[at:at + size])
            at += size
        assert chain.whole()[:2] == conversations.cheapest(codes)


def facts_plainly(rows):
    """Rows of one conversation after damage, in order."""
    seen, faults, codes = set(), Counter(), ""
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            fault = "truncated"
        else:
            fault = ""
        seen.add((role, text))
        faults[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = audited_plainly(codes) if len(codes) < 14 else conversations.cheapest(codes)
    length = len(audit) - audit.count("D")
    letters = "s" * (length % 2) + "ua" * (length // 2)
    names, at, place, out = {"u": "user", "a": "assistant"}, 0, 0, []
    for edit in audit:
        _, role, text = rows[at] if edit != "I" else (None, "", "")
        at += edit != "I"
        if edit != "D":
            out.append(f"{role if edit == 'K' else names[letters[place]]}:{text}")
            place += 1
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def plainly(rows):
    groups = {}
    for conv_id, turn, role, text in rows:
        own = groups.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv_id: facts_plainly(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
            for conv_id, own in groups.items()}


def conversation_rows():
    random = np.random.default_rng(5)
    rows = []
    for conv_id in range(300):
        for turn in range(random.integers(1, 9)):
            rows.append((conv_id, turn + int(random.random() < .1),
                         str(random.choice(["user", "assistant", "system", "tool", "u"])),
                         str(random.choice(["Hi.", "No", "Yes! ", "\t", "Ü?\n", f"t{turn}."]))))
    once = {}
    for row in rows:      # one text per turn and role, so that their order is defined
        once.setdefault(row[:3], row)
    rows = list(once.values())
    rows += [(900, None, None, None), (900, None, "user", "Hi."), (None, 3, "user", "Hi."),
             (None, None, "", ""), (901, None, None, "x")]
    return rows


def repaired(spark, rows, parts=3):
    full = [(*row, *["clash"] * len(CLASHING)) for row in rows]
    frame = spark.createDataFrame(full, "conv_id long, turn long, role string, text string, "
                                  + ", ".join(f"{c} string" for c in CLASHING)).repartition(parts)
    return conversations.repair(conversations.damaged(frame))


@pytest.mark.parametrize("turns", [64, 3])
def test_conversations_equal_plain_repair(spark, monkeypatch, turns):
    monkeypatch.setattr(conversations, "TURNS", turns)
    rows = conversation_rows()
    facts, _ = repaired(spark, rows)
    found = {row.conv_id: tuple(row)[1:] for row in facts.collect()}
    assert found == plainly(rows)


def test_one_conversation_that_holds_nearly_all_rows(spark):
    rows = [(7, t, ["user", "assistant"][t % 2], f"said {t % 251}.") for t in range(3000)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Yes.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts, turns = repaired(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = {row.conv_id: tuple(row)[1:] for row in facts.collect()}
    assert set(found) == {7, 8}
    own = sorted(turns.filter("conv_id = 7").collect(), key=lambda r: (r.part, r.segment))
    # Several tasks hold parts of it, and no row holds more than a segment.
    assert len({r.part for r in own}) > 1 and max(len(r.turns) for r in own) <= 3 * conversations.TURNS
    text = "\n".join(f"{t.role}:{t.text}" for r in own for t in r.turns)
    assert hashlib.sha256(text.encode()).hexdigest() == found[7][7]
    roles = "".join(t.role[0] for r in own for t in r.turns)
    assert re.fullmatch("(s?(ua)+)?", roles)


def test_no_conversations(spark):
    facts, turns = repaired(spark, [])
    assert facts.collect() == [] and turns.collect() == []
