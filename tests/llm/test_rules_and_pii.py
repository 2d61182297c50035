from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

from storepulse.llm import pii, quality_rules
from storepulse.llm.common import table
from storepulse.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD

SMALL = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_base(text):
    """The base columns by their definitions, without shortcuts."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1
               for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(line in lines[:i] for i, line in enumerate(lines)) if len(lines) < 500 else
            len(lines) - len(set(lines)), len(covered), failed)


def test_base_by_definition(spark):
    texts = dict(table(spark, SMALL, "documents").select("doc_id", "text").collect())
    for row in QUERIES["op6_quality_rules"](spark, SMALL).collect():
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
                row.base_failed) == expected_base(texts[row.doc_id])
        assert not (row.base_failed and row.kept)


def test_clean_documents_are_kept_and_junk_is_not(spark):
    found = QUERIES["op6_quality_rules"](spark, SMALL).join(
        table(spark, SMALL, "labels"), "doc_id").filter("not base_failed").toPandas()
    assert found[found.quality == 1].kept.all()
    assert found[found.quality == 0].kept.mean() < 0.1


def test_line_rules():
    assert quality_rules.fails("home | about | contact") == "navigation"
    assert quality_rules.fails("buy### now$$$ it%%%") == "punctuation"
    assert quality_rules.fails("THIS IS ALL SHOUTED NOISE") == "punctuation"
    assert quality_rules.fails("Accept all cookies to go on") == "boilerplate"
    assert quality_rules.fails("Released under the MIT License.") is None
    assert quality_rules.fails("An ordinary sentence, with a comma.") is None
    body = "An ordinary sentence with quite enough words to be kept as it stands."
    judged = quality_rules.Judged.of(f"home | about | us\n{body}\n{body}")
    assert judged.cleaned == body and judged.n_dup_lines == 1


def test_awkward_rules(awkward, nothing):
    found = quality_rules.clean(awkward).collect()
    assert sorted(r.n_words for r in found) == sorted(expected_base(t)[0] for _, t in AWKWARD)
    assert quality_rules.clean(nothing).count() == 0


def plain_spans(text):
    """The base spans by the patterns as they are given."""
    out = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(d := re.sub(r"[^0-9]", "", m[0])) <= 19 and pii.luhn(d)]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]


def test_base_spans_by_the_patterns():
    draw = random.Random(5)
    pieces = ["a", "@", ".", "1", "23", "+1", " ", "-", "(", ")", "4111111111111111", "255", "256",
              "b.c", "%", "jo@x.com", "10.2.3.4", "é", "+49 (30) 1234-567"]
    for _ in range(5000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 20)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("1" * 50_000 + "@" * 50_000 + "0" * 6000 + ".1.2.3")


def test_query_spans(spark):
    texts = dict(table(spark, SMALL, "documents").select("doc_id", "text").collect())
    for row in QUERIES["op10_pii"](spark, SMALL).collect():
        base = plain_spans(texts[row.doc_id] or "")
        assert row.base_sha256 == sha256(pii.joined(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s[0] == k for s in base) for k in pii.KINDS]
        assert not base or set(pii.joined(base).split(",")) <= set(row.spans.split(","))


def test_method_adds_and_masks(spark):
    rows = [(i, f"call me on phone 0049 30 {1000 + i} {2000 + i} or jo{i}@mail.com, version 1.2.3.4567")
            for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(docs)
    text = pii.redact(docs, model).filter("doc_id = 1").first().text
    assert text == "call me on phone <PHONE> or <EMAIL>, version 1.2.3.4567"


def test_em_finds_the_reliable_labelers():
    import numpy as np
    patterns = np.array([[1, 1, 1], [-1, -1, 1], [-1, -1, -1], [1, 1, -1]])
    truth = pii.agreed(patterns, np.array([50., 50., 50., 50.]))
    assert truth[0] > 0.9 and truth[3] > 0.9 and truth[1] < 0.1 and truth[2] < 0.1


def test_awkward_pii(awkward, nothing):
    model = pii.train(awkward)
    assert pii.find(awkward, model).count() == len(AWKWARD)
    masked = pii.redact(awkward, model)
    assert masked.columns == awkward.columns
    assert masked.filter("text is null").count() == 1
    assert pii.find(nothing, pii.train(nothing)).count() == 0
    assert pii.redact(nothing, model).columns == nothing.columns
