"""License scans by conditional compression.

A text is cut into paragraphs (runs of lines with letters or digits). White
space, line ends, comment marks and other punctuation only separate words. The
candidate blocks are runs of words around each license word, as long as the
template. Each is compressed by itself and with the template as a raw zstandard
dictionary, and templates are ranked by how many bytes they take off. A template must take off a share of
what it takes off its own text. In that order the templates are confirmed by
their exact wording differences: the shares of the template's words, in order,
that a span near the license word has, and of the span's words that the template has,
where names and versions must agree. The first one confirmed takes its span;
the words on either side are blocks of their own, ranked anew.

Defined results: a null or empty text has no blocks; long texts and blocks are
scanned whole, in pieces that overlap by more than any span can have; between
templates that take off equally much the one whose words agree better, then the
first of the table is taken; repeated rows are scanned each; a null
doc_id is carried; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import text_bytes

# Usual notices of public licenses: fixed values.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("proprietary", "Copyright. All rights reserved."),
)
CUES = re.compile(
    rb"licen[sc]e|copyright|rights[^a-z0-9]+reserved|public[^a-z0-9]+domain|permission|redistribut|cc[^a-z0-9]+by|cc0|free[^a-z0-9]+software"
)
PARAGRAPH = re.compile(rb"(?:[^\n]*[a-zA-Z0-9][^\n]*(?:\n|\Z))+")
WORDS = re.compile(rb"[a-z0-9]+(?:[.-][a-z0-9]+)*")
# words that tell licenses apart: a block and a template must agree in them
NAMES = frozenset("mit apache gnu gpl lesser affero bsd mozilla cc by sa nc nd by-sa by-nc by-nd by-nc-sa cc0 isc".encode().split())
NUMBER = re.compile(rb"v?\d+(?:\.\d+)*")
REMEMBERED = 4096


@dataclass(frozen=True)
class ScanLimits:
    """Least saving (bytes taken off, as a share of those off the template's own text) and least agreement of words."""

    least_saving: float = 0.25
    least_recall: float = 0.7
    least_precision: float = 0.6


@dataclass(frozen=True)
class Found:
    """A license's wording in a block: where its words begin and end, in bytes, and how well they agree."""

    start: int
    end: int
    license: str
    saving: float
    recall: float
    precision: float
    exact: bool
    words: int
    template: int


def has_cue(text: bytes) -> bool:
    return CUES.search(text.lower()) is not None


def names(words: list[bytes]) -> set[bytes]:
    """The words that tell licenses apart: names and version numbers."""
    return {word for word in words if word in NAMES or NUMBER.fullmatch(word)}


class Scanner:
    """Compressors of all templates, and their words."""

    def __init__(self, templates=TEMPLATES, limits: ScanLimits = ScanLimits()) -> None:
        self.templates, self.limits = templates, limits
        parameters = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.plain = zstandard.ZstdCompressor(compression_params=parameters)
        self.words = [WORDS.findall(text.lower().encode()) for _, text in templates]
        self.primed = [
            zstandard.ZstdCompressor(
                compression_params=parameters,
                dict_data=zstandard.ZstdCompressionDict(b" ".join(words), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for words in self.words
        ]
        self.own = [self.reduction(i, b" ".join(words)) for i, words in enumerate(self.words)]
        self.names = [names(words) for words in self.words]
        # a span has at most so many words, by the least precision
        self.reach = [int(len(words) / limits.least_precision) + 1 for words in self.words]
        self.known: dict[bytes, list[Found]] = {}

    def reduction(self, template: int, data: bytes) -> int:
        """Bytes that the template as a dictionary takes off the compressed size."""
        return len(self.plain.compress(data)) - len(self.primed[template].compress(data))

    def blocks(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """Number of the first line and bytes of each candidate block."""
        if not has_cue(text):
            return
        at = line = 0
        for paragraph in PARAGRAPH.finditer(text):
            block = paragraph[0]
            if has_cue(block):
                line += text.count(b"\n", at, paragraph.start())
                at = paragraph.start()
                yield line, block

    def match(self, block: bytes) -> tuple[str, float, float, float, bool] | None:
        """License, saving, recall, precision and whether the wording is exact, where words agree best; None if no template fits."""
        found = max(self.matches(block), key=lambda f: (f.recall + f.precision, f.words), default=None)
        return found and (found.license, found.saving, found.recall, found.precision, found.exact)

    def matches(self, block: bytes) -> list[Found]:
        """Every license that has a span of its own in the block, by place."""
        if len(block) > REMEMBERED:
            return self._matches(block)
        if block not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            self.known[block] = self._matches(block)
        return self.known[block]

    def _matches(self, block: bytes) -> list[Found]:
        lowered = block.lower()
        places = [(m.start(), m.end()) for m in WORDS.finditer(lowered)]
        words = [lowered[a:b] for a, b in places]
        starts = [a for a, _ in places]
        taken: list[tuple[int, int, Found]] = []
        for cue in sorted({max(0, bisect_right(starts, m.start()) - 1) for m in CUES.finditer(lowered)}):
            low = max((b for _, b, _ in taken if b <= cue), default=0)
            high = min((a for a, _, _ in taken if a > cue), default=len(words))
            while not any(a <= cue < b for a, b, _ in taken):
                span = self._winner(words, cue, low, high)
                if span is None:
                    break
                i, a, b, common, saving = span
                wording = common / len(self.words[i]), common / (b - a), words[a:b] == self.words[i]
                found = Found(places[a][0], places[b - 1][1], self.templates[i][0], saving, *wording, b - a, i)
                taken.append((a, b, found))
                low, high = (b, high) if b <= cue else (low, a)
        return [found for _, _, found in sorted(taken, key=lambda t: t[0])]

    def ranked(self, words: list[bytes], cue: int, low: int, high: int) -> list[tuple[int, float, int, int, int]]:
        """Bytes taken off, their share, template and words to confirm it in, of the templates that take off enough, best first."""
        ranked = []
        for i, own in enumerate(self.own):
            n = len(self.words[i])
            # blocks as long as the template, at quarters of its length, that hold the license word
            begins = {max(low, min(at, high - n)) for at in (*range(cue - n + 1, cue, max(1, n // 4)), cue)}
            taken_off = max(self.reduction(i, b" ".join(words[at : min(high, at + n)])) for at in begins)
            if taken_off >= self.limits.least_saving * own:
                a, b = max(low, cue - self.reach[i]), min(high, cue + self.reach[i] + 1)
                ranked.append((taken_off, taken_off / own, i, a, b))
        return sorted(ranked, key=lambda r: (-r[0], r[2]))

    def _winner(self, words: list[bytes], cue: int, low: int, high: int) -> tuple[int, int, int, int, float] | None:
        """Template, span, words in common and saving of the first template in rank that its wording confirms."""
        best = None
        for taken_off, saving, i, a, b in self.ranked(words, cue, low, high):
            if best and taken_off < best[0]:
                break
            span = self._span(i, words, a, b)
            if span and (best is None or span[3] > best[1]):
                best = taken_off, span[3], (i, *span[:3], saving)
        return best and best[2]

    def _span(self, i: int, words: list[bytes], low: int, high: int) -> tuple[int, int, int, float] | None:
        """First and last word of the span that agrees best with the template, the words in common, and how well."""
        wanted = self.words[i]
        if high - low < self.limits.least_recall * len(wanted):
            return None
        pieces = SequenceMatcher(None, wanted, words[low:high], autojunk=False).get_matching_blocks()
        pieces = [(low + p.b, low + p.b + p.size, p.size) for p in pieces if p.size]
        best = None
        # words that stray outside the wording are left out where the rest agrees better
        for first in range(len(pieces)):
            common = 0
            for last in range(first, len(pieces)):
                a, b, common = pieces[first][0], pieces[last][1], common + pieces[last][2]
                recall, precision = common / len(wanted), common / (b - a)
                if recall < self.limits.least_recall or precision < self.limits.least_precision:
                    continue
                if (best is None or recall + precision > best[3]) and names(words[a:b]) == self.names[i]:
                    best = a, b, common, recall + precision
        return best


def scan_licenses(docs: DataFrame, templates=TEMPLATES, limits: ScanLimits = ScanLimits()) -> DataFrame:
    """One row per license found in a block: where, which, and how well.

    ``doc_id``, ``line`` of its first word (from 0), ``license``, ``saving``, ``recall``,
    ``precision``, ``exact`` and the ``text`` from its first word to its last.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, limits)
        for batch in batches:
            places, rows = [], []
            for i, text in enumerate(batch.column(1)):
                for line, block in scanner.blocks(text.as_py()):
                    for found in scanner.matches(block):
                        places.append(i)
                        own = block[found.start : found.end].decode("utf-8", "replace")
                        at = line + block.count(b"\n", 0, found.start)
                        rows.append((at, found.license, found.saving, found.recall, found.precision, found.exact, own))
            if not rows:
                continue
            kinds = [pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.string()]
            arrays = [batch.column(0).take(pa.array(places))] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "line", "license", "saving", "recall", "precision", "exact", "text"])

    picked = docs.select("doc_id", text_bytes().alias("text"))
    schema = f"doc_id {kind}, line int, license string, saving double, recall double, precision double, exact boolean, text string"
    return picked.mapInArrow(compute, schema)


def document_licenses(docs: DataFrame, templates=TEMPLATES, limits: ScanLimits = ScanLimits()) -> DataFrame:
    """Per document with a license: ``doc_id``, ``licenses`` (sorted, distinct) and ``n_blocks``."""
    found = scan_licenses(docs, templates, limits).groupBy("doc_id", "license").agg(F.count("*").alias("n"))
    per = found.groupBy("doc_id").agg(F.sort_array(F.collect_list("license")).alias("licenses"), F.sum("n").alias("n_blocks"))
    return per.select("doc_id", "licenses", "n_blocks")
