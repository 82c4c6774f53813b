"""License notices as they stand in files: wrapped, within other words, several at once."""

from __future__ import annotations

import random
import textwrap
from difflib import SequenceMatcher

import pytest

from tallywatch.llm import licenses

DRAW = random.Random(2)
PROSE = [" ".join("".join(DRAW.choices("aeioulnrst", k=DRAW.randint(2, 9))) for _ in range(n)) for n in (10, 300, 3000)]


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


def found(scanner, text):
    return [(line + block.count(b"\n", 0, f.start), f.license, f.exact) for line, block in scanner.blocks(text.encode()) for f in scanner.matches(block)]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "-- "])
@pytest.mark.parametrize("width", [24, 40, 70, 80, 1000])
def test_wrapped_notices(scanner, mark, width):
    for name, notice in licenses.TEMPLATES:
        lines = textwrap.wrap(notice, width, break_long_words=False, break_on_hyphens=False)
        text = "\n".join(["head", "", *[mark + line for line in lines], mark.strip(), "tail"])
        assert found(scanner, text) == [(2, name, True)], text


@pytest.mark.parametrize("before", PROSE)
def test_notices_within_other_words(scanner, before):
    for name, notice in licenses.TEMPLATES:
        for text in (f"{before} {notice}", f"{notice} {before}", f"{before} {notice} {before}"):
            assert found(scanner, text) == [(0, name, True)], (len(before), notice)


def test_several_licenses_in_a_block(scanner):
    dual = "this code is released under the MIT License or the Apache License, Version 2.0 at your choice"
    assert [name for _, name, _ in found(scanner, dual)] == ["MIT", "Apache-2.0"]
    every = list(licenses.TEMPLATES)
    random.Random(1).shuffle(every)
    joined = " and also ".join(text.rstrip(".") for _, text in every)
    assert [name for _, name, _ in found(scanner, joined)] == [name for name, _ in every]
    assert [name for _, name, _ in found(scanner, "Licensed under CC BY 4.0. " * 3)] == ["CC-BY-4.0"] * 3


def test_scan_of_wrapped_notices(spark):
    rows = [(i, "x\n" + textwrap.fill(text, 40)) for i, (_, text) in enumerate(licenses.TEMPLATES)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted((r.doc_id, r.line, r.license, r.exact) for r in got) == [(i, 1, name, True) for i, (name, _) in enumerate(licenses.TEMPLATES)]


def test_compression_ranks_and_decides(scanner):
    """The notice's own license takes off most or nearly so, ordinary words around a license word next to nothing."""
    for name, notice in licenses.TEMPLATES:
        words = licenses.WORDS.findall(f"{PROSE[0]} {notice} {PROSE[0]}".lower().encode())
        joined = b" ".join(words)
        cue = joined[: licenses.CUES.search(joined).start()].count(b" ")
        ranked = scanner.ranked(words, cue, 0, len(words))
        own = next(r for r in ranked if licenses.TEMPLATES[r[2]][0] == name)
        # a license whose name differs in a word may take off as much: words tell them apart
        assert own[0] >= 0.9 * ranked[0][0] and own[1] > 0.7, notice
    prose = [word.encode() for word in PROSE[1].split()]
    for at in range(50, 250, 10):
        assert not scanner.ranked([*prose[:at], b"license", *prose[at:]], at, 0, len(prose) + 1)
    strict = licenses.Scanner(limits=licenses.ScanLimits(least_saving=1.01))
    assert not any(found(strict, notice) for _, notice in licenses.TEMPLATES)


def every_span(scanner, words):
    """The most bytes taken off, by license, over all spans of all templates that wording and names confirm."""
    most, limits = {}, scanner.limits
    for i, (name, _) in enumerate(licenses.TEMPLATES):
        wanted = scanner.words[i]
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + scanner.reach[i]) + 1):
                span = words[a:b]
                if (b - a) < limits.least_recall * len(wanted) or licenses.names(span) != scanner.names[i]:
                    continue
                pieces = SequenceMatcher(None, wanted, span, autojunk=False).get_matching_blocks()
                common = sum(piece.size for piece in pieces)
                if common < limits.least_recall * len(wanted) or common < limits.least_precision * (b - a):
                    continue
                taken_off = scanner.reduction(i, b" ".join(span))
                if taken_off >= limits.least_saving * scanner.own[i]:
                    most[name] = max(most.get(name, 0), taken_off)
    return most


@pytest.mark.parametrize("damage", [0, 1, 2, 5])
def test_damaged_notices_against_every_span(scanner, damage):
    draw = random.Random(damage)
    for name, notice in licenses.TEMPLATES:
        words = notice.split()
        for _ in range(min(damage, len(words) // 3)):
            at = draw.randrange(len(words))
            words[at : at + draw.randrange(2)] = draw.choice((["some"], ["words", "more"], []))
        text = " ".join([*PROSE[0].split()[:4], *words, *PROSE[0].split()[4:8]])
        most = every_span(scanner, licenses.WORDS.findall(text.lower().encode())) if licenses.has_cue(text.encode()) else {}
        best = {license for license, taken_off in most.items() if taken_off == max(most.values())}
        got = {license for _, license, _ in found(scanner, text)}
        assert got <= best and bool(got) == bool(best), (name, text)


def test_defined_results(spark):
    rows = [(None, "Licensed under CC BY 4.0."), (1, None), (1, ""), (2, "Licensed under CC BY 4.0."), (2, "Licensed under CC BY 4.0.")]
    docs = spark.createDataFrame([(*row, "x", 1.0) for row in rows], "doc_id int, text string, license string, saving double")
    got = licenses.scan_licenses(docs).select("doc_id", "license", "exact").collect()
    assert sorted((r.doc_id or 0, r.license, r.exact) for r in got) == [(i, "CC-BY-4.0", True) for i in (0, 2, 2)]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
