"""Conversations brought to the grammar of roles, by aligning turns to its strings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import written

# What an edit costs; a truncated turn that stays costs as much again.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# Role initials that may follow each other.
LEGAL = ("su", "ua", "au")
# Turns, and characters of text, that are aligned and held at a time. Longer conversations
# are aligned in segments.
TURNS, CHARACTERS = 32, 1 << 22
# Strings of turn codes whose alignments a worker remembers.
REMEMBERED = 100_000
# What the grammar has read: nothing, then its last letter. Whole strings end in nothing
# or in ``a``.
STATES = "-sua"
NAMES = {"u": "user", "a": "assistant"}
INFINITE = 1 << 60

SEGMENT = """part int, segment int, whole boolean, n long, blank long, duplicate long,
    truncated long, illegal long, first_initial string, last_initial string,
    first_turn long, last_turn long, distinct_turns long, codes string,
    turns array<struct<role: string, text: string>>, cost long, audit string, digest string"""


def target(start: str, end: str, length: int) -> str | None:
    """The letters that lead the grammar ``(s?(ua)+)?`` from one state to another."""
    if length == 0:
        return "" if start == end else None
    if end == "-":
        return None
    if start == "-" and end == "s":
        return "s" if length == 1 else None
    if end == "s" or start == "-" and length == 0:
        return None
    # u and a take turns backwards from the end.
    letters = ("ua" if end == "a" else "au") * (length // 2 + 1)
    letters = letters[len(letters) - length:]
    if start == "-":
        if letters[0] == "u":
            return letters
        return "s" + letters[1:] if length > 1 else None
    return letters if letters[0] == ("a" if start == "u" else "u") else None


def least(difference: int) -> int:
    """The least that letters more (or, negative, fewer) than turns cost."""
    return INSERT * difference if difference >= 0 else -DELETE * difference


def align(codes: str, letters: str, most: int) -> tuple[int, str] | None:
    """The cheapest audit, of these the least, that turns ``codes`` into ``letters``.

    None if it costs over ``most``. Wagner-Fischer from the end, so that the audit is read
    off from the start with the least letter first; only cells on diagonals that a path
    within ``most`` can touch are filled (Ukkonen's band). Diagonals are counted over the
    turns that may stay, so turns that must go do not widen the band.

    A code is a turn's initial, or ``x`` for one that must be deleted; capital if it is
    truncated.
    """
    n, m, forced = len(codes), len(letters), codes.count("x")
    stay, spare = n - forced, most - DELETE * forced
    rest = m - stay
    if least(rest) > spare:
        return None
    low = high = 0
    while low > -stay and least(low - 1) + least(rest - low + 1) <= spare:
        low -= 1
    while high < m and least(high + 1) + least(rest - high - 1) <= spare:
        high += 1
    costs = [[INFINITE] * (high - low + 3) for _ in range(n + 1)]
    # Where in a row of cells a letter stands: by the turns before that may stay.
    shift = [1 - low]
    for code in codes:
        shift.append(shift[-1] - (code != "x"))
    for i in range(n, -1, -1):
        row, base = costs[i], shift[i]
        code = codes[i] if i < n else "x"
        below, step = (costs[i + 1], shift[i + 1]) if i < n else (None, 0)
        plain, more = code.lower(), TRUNCATED if code.isupper() else 0
        for j in range(min(m, high + 1 - base - low), max(0, 1 - base) - 1, -1):
            best = 0 if i == n and j == m else INFINITE
            if below is not None:
                # The turn must or may go.
                best = min(best, below[j + step] + DELETE)
                if j < m and code != "x":
                    if plain == letters[j]:
                        best = min(best, below[j + 1 + step] + more)
                    elif letters[j] in NAMES:
                        best = min(best, below[j + 1 + step] + REROLE + more)
            if j < m and letters[j] in NAMES:
                best = min(best, row[j + 1 + base] + INSERT)
            row[j + base] = best
    total = costs[0][shift[0]]
    if total > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = costs[i][j + shift[i]]
        if i < n and costs[i + 1][j + shift[i + 1]] + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and letters[j] in NAMES and costs[i][j + 1 + shift[i]] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if codes[i].lower() == letters[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(audit)


@lru_cache(maxsize=REMEMBERED)
def between(codes: str, start: str, end: str) -> tuple[int, str] | None:
    """The cheapest and least audit of turns that takes the grammar from state to state.

    Aligns to each feasible length, from the number of turns that may stay outwards, until
    the difference in length alone costs more than the cheapest so far. Before there is
    one, the bound that gives the band is doubled until it holds an alignment.
    """
    n, forced = len(codes), codes.count("x")
    best = (DELETE * n, "D" * n) if start == end else (INFINITE, "")
    step, stay = 0, n - forced
    while step <= stay or least(step) + DELETE * forced <= best[0]:
        for length in sorted({stay - step, stay + step}):
            letters = target(start, end, length) if length > 0 else None
            bound = least(length - stay) + DELETE * forced
            if letters is None or bound > best[0]:
                continue
            top = DELETE * n + INSERT * length
            most = min(best[0], bound + 2 * REROLE, top)
            found = align(codes, letters, most)
            while found is None and most < min(best[0], top):
                most = min(best[0], top, 2 * most + REROLE)
                found = align(codes, letters, most)
            if found and found < best:
                best = found
        if best[0] == INFINITE and step > stay + len(STATES):
            return None
        step += 1
    return best


def cheapest(codes: str) -> tuple[int, str]:
    """The audit of a whole conversation."""
    return min(filter(None, (between(codes, "-", end) for end in "-a")))


def edited(
    audit: str, turns: Iterable[tuple[str, str]], start: str, end: str,
) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of each turn that an audit leaves or makes."""
    letters = target(start, end, len(audit) - audit.count("D"))
    turns, place = iter(turns), 0
    for edit in audit:
        role, text = next(turns) if edit != "I" else ("", "")
        if edit == "D":
            continue
        yield edit, role if edit == "K" else NAMES[letters[place]], text
        place += 1


def ending(audit: str, start: str, end: str) -> str:
    """The state that audits of whole conversations lead to."""
    return end if len(audit) > audit.count("D") else start


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped`` after damage by a crc32 of ``conv_id:turn``.

    Of 20 kinds of rows one each is dropped (it stays as a row that is marked so), emptied,
    loses its ``.!?``, is repeated, becomes the user's. A NULL conv_id or turn counts as
    one space in the crc32; NULL roles and texts become one space.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text, role = spaced("text"), spaced("role")
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
        .alias("text"),
        (kind == 0).alias("dropped"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")
    return rows.select("*", copies).drop("copies", "copy")


def coded(turns: DataFrame) -> DataFrame:
    """Turns with the code of their first fault: b(lank), d(uplicate), t(runcated) or none.

    A duplicate says what an earlier turn of its conversation has said in the same role.
    The earliest is found by grouping, so one text that fills a conversation leaves each
    task as a row; of equal rows the first in a segment's order counts as the earlier one.
    """
    turns = turns.withColumns({
        "said": F.xxhash64("role", "text"), "said_too": F.md5(F.concat_ws(":", "role", "text")),
        "dropped": F.coalesce("dropped", F.lit(False)),
        # NULL turns come first.
        "place": F.struct(F.col("turn").isNotNull().alias("given"), "turn"),
    })
    keys = ["conv_id", "said", "said_too"]
    seen = turns.filter("not dropped").groupBy(*keys).agg(
        F.min("place").alias("earliest"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"s.{key}").eqNullSafe(F.col(f"t.{key}"))
    joined = turns.alias("t").join(seen.alias("s"), same, "left").select("t.*", "earliest")
    word = r"[^\x20\x09-\x0D]"
    end = rf"(?s)[.!?][\x20\x09-\x0D]*\z"
    fault = (
        F.when(~F.col("text").rlike(word), "b")
        .when(F.col("earliest").isNotNull() & (F.col("earliest") < F.col("place")), "d")
        # As early as the earliest: all but the first of them are duplicates.
        .when(F.col("earliest").isNotNull(), F.when(F.col("text").rlike(end), "f").otherwise("g"))
        .when(~F.col("text").rlike(end), "t").otherwise("")
    )
    return joined.select("conv_id", "turn", "role", "text", "dropped", "said", fault.alias("fault"))


class Held:
    """The turns of a conversation that a task has read and not yet aligned."""

    def __init__(self) -> None:
        self.turns: list[tuple[str, str]] = []
        self.numbers: list = []
        self.faults: list[str] = []
        self.characters = 0
        # The row before, of this conversation, in the order of the table.
        self.previous: tuple | None = None

    def add(self, turn, role: str, text: str, said: int, fault: str) -> None:
        if fault in ("f", "g"):
            fault = "d" if (turn, said) == self.previous else "t" if fault == "g" else ""
        self.previous = (turn, said)
        self.turns.append((role, text))
        self.numbers.append(turn)
        self.faults.append(fault)
        self.characters += len(text)

    def clear(self) -> None:
        self.turns, self.numbers, self.faults, self.characters = [], [], [], 0

    def codes(self) -> str:
        out = []
        for (role, _), fault in zip(self.turns, self.faults):
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            out.append("x" if fault in ("b", "d") else initial.upper() if fault == "t" else initial)
        return "".join(out)

    def row(self, conv_id, part: int, segment: int, whole: bool) -> dict:
        initials = [role[:1] for role, _ in self.turns]
        numbers = [x for x in self.numbers if x is not None]
        row = {
            "conv_id": conv_id, "part": part, "segment": segment, "whole": whole,
            "n": len(initials), "blank": self.faults.count("b"),
            "duplicate": self.faults.count("d"), "truncated": self.faults.count("t"),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "first_initial": initials[0] if initials else None,
            "last_initial": initials[-1] if initials else None,
            "first_turn": numbers[0] if numbers else None,
            "last_turn": numbers[-1] if numbers else None,
            "distinct_turns": len(set(numbers)), "codes": self.codes(),
            "turns": None, "cost": None, "audit": None, "digest": None,
        }
        if whole:
            cost, audit = cheapest(row["codes"])
            done = list(edited(audit, self.turns, "-", ending(audit, "-", "a")))
            row |= {"cost": cost, "audit": audit, "codes": None,
                    "turns": [{"role": r, "text": t} for _, r, t in done],
                    "digest": hashlib.sha256(
                        "\n".join(f"{r}:{t}" for _, r, t in done).encode()).hexdigest()}
        else:
            row["turns"] = [{"role": r, "text": t} for r, t in self.turns]
        return row


def segments(turns: DataFrame) -> DataFrame:
    """Conversations in segments; one that fits a segment and a task is whole and done.

    Ranges of ``conv_id, turn`` are dealt to tasks, so a conversation of any length is
    spread, and a task holds one segment. A conversation that a range's end parts is not
    whole, nor is one that is longer than a segment. Rows of one turn go by role and text.
    """
    order = ["conv_id", "turn", "role", "said"]
    rows = coded(turns)
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"conv_id {kind}, {SEGMENT}"
    out = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, characters = TaskContext.get().partitionId(), 0, 0
        held, current, ready = Held(), None, []

        def close(last: bool, border: bool) -> None:
            """``border``: the conversation may go on in a neighbouring task."""
            nonlocal segment, characters
            whole = last and segment == 0 and not border
            if held.turns or segment == 0:
                ready.append(held.row(current[0], part, segment, whole))
            characters += held.characters
            held.clear()
            segment += 1

        names = ["conv_id", "turn", "role", "text", "dropped", "said", "fault"]
        started = True
        for batch in batches:
            for conv_id, turn, role, text, dropped, said, fault in zip(
                    *(batch.column(c).to_pylist() for c in names)):
                if current is None or current[0] != conv_id:
                    if current is not None:
                        close(True, border=started)
                        started = False
                    current, segment = (conv_id,), 0
                    held.clear()
                    held.previous = None
                if dropped:
                    continue
                if len(held.turns) >= TURNS or held.characters >= CHARACTERS:
                    close(False, border=started)
                held.add(turn, role, text, said, fault)
                if len(ready) >= 1024 or characters >= CHARACTERS:
                    yield pa.RecordBatch.from_pylist(ready, out)
                    ready.clear()
                    characters = 0
        if current is not None:
            close(True, border=True)
        if ready:
            yield pa.RecordBatch.from_pylist(ready, out)

    return rows.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


class Chain:
    """The cheapest audits of a conversation's segments so far, by the state they end in.

    Audits of the same turns with the same cost are never the beginning of each other: the
    longer one would insert more, and so cost more. So the least audit of a whole is made of
    least audits of its parts, and segments can be aligned by themselves.
    """

    def __init__(self) -> None:
        self.best = {"-": (0, "", ())}

    def add(self, codes: str) -> None:
        ahead: dict[str, tuple[int, str, tuple]] = {}
        for start, (cost, audit, ends) in self.best.items():
            for end in STATES:
                found = between(codes, start, end)
                if found:
                    new = (cost + found[0], audit + found[1], (*ends, (end, len(found[1]))))
                    if end not in ahead or new[:2] < ahead[end][:2]:
                        ahead[end] = new
        self.best = ahead

    def whole(self) -> tuple[int, str, tuple]:
        return min(self.best[end] for end in "-a" if end in self.best)


def chained(parts: DataFrame) -> DataFrame:
    """``conv_id, part, segment, start, end, edits`` of segments, and their sums.

    Reads what segments say of themselves, not their texts: a byte per turn.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    facts = ["n", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial",
             "first_turn", "last_turn", "distinct_turns", "codes"]
    schema = (f"conv_id {kind}, part int, segment int, start string, end string, edits string, "
              "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string")
    out = _arrow(schema)
    rows = parts.select("conv_id", "part", "segment", *facts).repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "part", "segment")

    def solved(rows: list[dict]) -> Iterator[dict]:
        chain, sums = Chain(), dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        distinct, first, last, before = 0, None, None, None
        for row in rows:
            chain.add(row["codes"])
            for name in sums:
                sums[name] += row[name]
            if row["n"]:
                if before is not None:
                    sums["illegal"] += before + row["first_initial"] not in LEGAL
                before = row["last_initial"]
            if row["first_turn"] is not None:
                distinct += row["distinct_turns"] - (last == row["first_turn"])
                first = row["first_turn"] if first is None else first
                last = row["last_turn"]
        cost, audit, ends = chain.whole()
        start, at = "-", 0
        for i, (row, (end, size)) in enumerate(zip(rows, ends)):
            head = {"gaps": 0 if first is None else last - first + 1 - distinct, "cost": cost,
                    "audit": audit, **sums} if i == 0 else {}
            yield {"conv_id": row["conv_id"], "part": row["part"], "segment": row["segment"],
                   "start": start, "end": end, "edits": audit[at:at + size], **head}
            start, at = end, at + size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    yield pa.RecordBatch.from_pylist(list(solved(held)), out)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist(list(solved(held)), out)

    return rows.mapInArrow(run, schema)


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id`` and the sha256 of its ``role:text`` lines, a line at a time.

    ``turns`` has ``conv_id, part, segment, turns``. A hash has one order, so one task reads
    a conversation to its end; it holds a segment of it.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "part", "segment", "turns").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "part", "segment")
    schema = f"conv_id {kind}, digest string"
    out = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, empty = None, None, True
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if current is None or current[0] != row["conv_id"]:
                    if current is not None:
                        done.append({"conv_id": current[0], "digest": state.hexdigest()})
                    current, state, empty = (row["conv_id"],), hashlib.sha256(), True
                for turn in row["turns"]:
                    state.update(("" if empty else "\n").encode())
                    state.update(f"{turn['role']}:{turn['text']}".encode())
                    empty = False
            yield pa.RecordBatch.from_pylist(done, out)
        if current is not None:
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": current[0], "digest": state.hexdigest()}], out)

    return rows.mapInArrow(run, schema)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts per conversation, and the repaired turns in segments.

    Reads ``conv_id, turn, role, text, dropped``; rows marked dropped only name their
    conversation, and other columns are ignored, whatever their names. Conversations are
    read by turn, NULL turns first; rows of one turn by role, then text. A turn's first
    fault counts: blank, duplicate (role and text were there before), truncated (it does
    not end in one of ``.!?``). Blank and duplicate turns are deleted; the cheapest edits
    (Keep 0, Rerole 3, Delete 4, Insert 3, and 3 for each truncated turn that stays) bring
    the role initials to ``(s?(ua)+)?``; ties go to the least audit. NULL roles and texts
    count as one space; rows without conv_id are one conversation. No rows give no rows.

    Facts are ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Segments are ``conv_id, part, segment, turns`` in order, ``turns`` an
    array of role and text: the repaired conversations themselves.

    Conversations that fit a segment are done where they are sorted. The others' segments
    are aligned from each state of the grammar to each, chained by cost and audit, and
    edited and hashed segment by segment, so no task holds the texts of a conversation.
    """
    spaced = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text",
                         "dropped").withColumns(spaced)
    read = written(segments(turns), "segments")
    whole, parts = read.filter("whole"), read.filter("not whole")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct_turns"),
                      F.lit(0))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    done = whole.withColumn("gaps", gaps).select(*names, F.col("digest").alias("repaired_sha256"))

    edits = written(chained(parts), "chained")
    spread = parts.select("conv_id", "part", "segment", "turns").withColumnsRenamed(
        {"conv_id": "c", "part": "p", "segment": "s"})
    own = edits.select("conv_id", "part", "segment", "start", "end", "edits")
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
            & (F.col("segment") == F.col("s")))
    kind = read.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, part int, segment int, "
              "turns array<struct<role: string, text: string>>")
    out = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready = []
            for row in batch.to_pylist():
                before = ((t["role"], t["text"]) for t in row["turns"])
                after = edited(row["edits"], before, row["start"], row["end"])
                ready.append({"conv_id": row["conv_id"], "part": row["part"],
                              "segment": row["segment"],
                              "turns": [{"role": r, "text": t} for _, r, t in after]})
            yield pa.RecordBatch.from_pylist(ready, out)

    mended = written(own.join(spread, same).drop("c", "p", "s").mapInArrow(run, schema), "mended")
    heads = edits.filter("cost is not null").select(*names)
    hashed = digests(mended).withColumnRenamed("conv_id", "c")
    long = heads.join(hashed, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        *names, F.col("digest").alias("repaired_sha256"))
    return done.unionByName(long), whole.select(
        "conv_id", "part", "segment", "turns").unionByName(mended)
