"""Quality rules: base counts, and divergence from language references.

A document's histograms of character classes and of common words are compared
with those of its language by Jensen-Shannon distance (base 2, from 0 to 1).
The references are counted over all documents: the character classes, and the
``common`` most frequent words of each language with everything else as one
class. A histogram is judged only from a minimum length on, as short texts
stray by chance.

A language has a reference if it has ``LEAST_WORDS`` words or ``LANGUAGE_SHARE``
of all words; so does a script, that is, all documents most of whose letters
have lead bytes of one group of ``SCRIPTS``. A document of a language without a
reference is judged by the character classes of its script, one without a
language also by the words of its script, where the group is one script only.
If its script has no reference either, the base rules alone decide. What is
broadcast grows with the number of languages of ``LEAST_WORDS`` words.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows are judged each; other columns, whatever their names, pass
through untouched; an empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.common import column_or_null, free_tables, fresh, save_and_reload, text_bytes

LANGUAGE_SHARE = 0.002
LEAST_WORDS = 2_000
SHARES = 64
EVERY = "*"
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "other letter", "digit", "blank", "line end", "stop", "symbol", "other")


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the rules; distances are Jensen-Shannon, base 2."""

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    common: int = 40
    min_chars_judged: int = 300
    min_words_judged: int = 50
    max_class_distance: float = 0.30
    max_word_distance: float = 0.48


def _class_table() -> np.ndarray:
    """The class of each leading byte; ``len(CLASSES)`` for bytes inside a character."""
    table = np.full(256, CLASSES.index("other"), np.uint8)
    table[0x80:0xC0] = len(CLASSES)
    table[0xC0:] = CLASSES.index("other letter")
    for name, members in (
        ("lower", range(97, 123)),
        ("upper", range(65, 91)),
        ("digit", range(48, 58)),
        ("blank", b" \t"),
        ("line end", b"\n\r"),
        ("stop", b".,;:!?'\"()-"),
        ("symbol", SYMBOLS),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


CLASS_OF = _class_table()
IN_CLASS = (CLASS_OF[:, None] == np.arange(len(CLASSES))).astype(np.int64)


# lead bytes of letters; the groups of OF_MANY hold several scripts
SCRIPTS = {
    "latin": (*range(65, 91), *range(97, 123), *range(0xC3, 0xCB)),
    "greek": (0xCE, 0xCF),
    "cyrillic": range(0xD0, 0xD4),
    "armenian, hebrew": range(0xD4, 0xD8),
    "arabic": range(0xD8, 0xDC),
    "syriac and others": range(0xDC, 0xE0),
    "indic, thai": (0xE0,),
    "georgian, ethiopic, khmer": (0xE1,),
    "kana, han": range(0xE3, 0xEA),
    "hangul": range(0xEA, 0xEE),
}
SCRIPT_NAMES = (*SCRIPTS, "none")
OF_MANY = frozenset(("armenian, hebrew", "syriac and others", "indic, thai", "georgian, ethiopic, khmer", "kana, han"))
IN_SCRIPT = np.stack([np.isin(np.arange(256), list(members)) for members in SCRIPTS.values()], axis=1).astype(np.int64)


def script_of(of_bytes: np.ndarray) -> str:
    """The script of most letters of a text; ``none`` without letters."""
    letters = of_bytes @ IN_SCRIPT
    return SCRIPT_NAMES[int(letters.argmax()) if letters.any() else -1]


def byte_counts(text: bytes) -> np.ndarray:
    """How often each byte value occurs; all character counts follow from it."""
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256)


def repeated_window_words(words: list[bytes], width: int = 5) -> int:
    """Words that stand in a window of ``width`` words found twice or more, each once."""
    if len(words) <= width:
        return 0
    numbers = {word: number for number, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    # windows with distinct hashes are distinct, which settles most texts
    mixed = np.zeros(len(words) - width + 1, np.uint64)
    for step in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[step : len(ids) - width + 1 + step].astype(np.uint64)
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():
        return 0
    code = ids
    for step in range(1, width):
        # codes stay exact: each step's pairs are ranked before the next
        found, code = np.unique(code[:-1] * (len(numbers) + 1) + ids[step:], return_inverse=True)
        if len(found) == len(code):
            return 0
    twice = np.flatnonzero((np.bincount(code) > 1)[code])
    if not len(twice):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_counts(text: bytes, words: list[bytes], of_bytes: np.ndarray, window: int = 5) -> tuple[int, int, int, int, int]:
    inside, blank = of_bytes[0x80:0xC0].sum(), of_bytes[9:14].sum() + of_bytes[32]
    return (
        len(words),
        int(len(text) - inside - blank),
        int(of_bytes[list(SYMBOLS)].sum()),
        duplicate_lines(text),
        repeated_window_words(words, window),
    )


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms with a positive sum each."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def divergence(a: np.ndarray) -> float:
        some = a > 0
        return float((a[some] * np.log2(a[some] / m[some])).sum())

    return float(np.sqrt(max(0.0, (divergence(p) + divergence(q)) / 2)))


@dataclass(frozen=True)
class Reference:
    """Histograms of one language: character classes, and common words with the rest last."""

    classes: np.ndarray
    words: dict[bytes, int]
    counts: np.ndarray


FLUSH = 200_000
# begins the keys of classes; no word holds a blank, while any other byte may begin one
CLASS_KEY = b" "


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and script: of words, and of classes under ``CLASS_KEY`` and their number."""

    def rows(place: tuple[str, str], counts: dict[bytes, int]) -> pa.RecordBatch:
        arrays = [pa.array([name] * len(counts), pa.string()) for name in place]
        arrays += [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "script", "item", "n"])

    free_tables()
    seen: dict[tuple[str, str], Counter] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            of_bytes = byte_counts(text)
            counter = seen.setdefault((lang or EVERY, EVERY + script_of(of_bytes)), Counter())
            held -= len(counter)
            counter.update(text.split())
            for number, n in enumerate((of_bytes @ IN_CLASS).tolist()):
                if n:
                    counter[b"%b%d" % (CLASS_KEY, number)] += n
            held += len(counter)
            if held > FLUSH:
                yield from (rows(*one) for one in seen.items())
                seen, held = {}, 0
    yield from (rows(*one) for one in seen.items())


def language_references(docs: DataFrame, limits: RuleLimits = RuleLimits()) -> dict[str, Reference]:
    """References of each language and, under ``EVERY`` and its name, each script with enough words."""
    picked = docs.select(column_or_null(docs, "lang", "string").alias("lang"), text_bytes().alias("text"))
    tallied = picked.mapInArrow(_tally, "lang string, script string, item binary, n long")
    counted = save_and_reload(tallied.groupBy("lang", "script", "item").agg(F.sum("n").alias("n")), "word-counts")
    is_class = F.substring("item", 1, 1) == F.lit(CLASS_KEY)
    floor = (counted.where(~is_class).agg(F.sum("n")).first()[0] or 0) * LANGUAGE_SHARE
    parts = []
    for place in (F.when(~F.startswith("lang", F.lit(EVERY)), F.col("lang")), F.col("script")):
        own = counted.select(place.alias("lang"), "item", "n").where("lang IS NOT NULL")
        parts.append(own.groupBy("lang", "item").agg(F.sum("n").alias("n")))
    both = parts[0].unionByName(parts[1])
    totals = both.where(~is_class).groupBy("lang").agg(F.sum("n").alias("total"))
    large = totals.where((F.col("total") > floor) | (F.col("total") >= LEAST_WORDS))
    found: dict[str, Reference] = {}
    # a language's words are ranked in shares first, so that no task gets more than the best of each
    # share; totals come last, as a join of all words by language would undo that
    common = both.where(~is_class).withColumn("share", F.pmod(F.xxhash64("item"), F.lit(SHARES)))
    for place in (("lang", "share"), ("lang",)):
        order = Window.partitionBy(*place).orderBy(F.desc("n"), "item")
        common = common.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limits.common).drop("rank")
    wanted = common.drop("share").union(both.where(is_class)).join(large, "lang")
    rows: dict[str, list] = {}
    for row in wanted.collect():
        rows.setdefault(row.lang, []).append(row)
    for lang, own in rows.items():
        classes = np.zeros(len(CLASSES))
        words = sorted(((r.n, bytes(r.item)) for r in own if not r.item.startswith(CLASS_KEY)), key=lambda x: (-x[0], x[1]))
        for r in own:
            if r.item.startswith(CLASS_KEY):
                classes[int(bytes(r.item)[len(CLASS_KEY) :])] = r.n
        counts = [n for n, _ in words] + [own[0].total - sum(n for n, _ in words)]
        found[lang] = Reference(classes, {w: i for i, (_, w) in enumerate(words)}, np.array(counts, float))
    return found


def reference_of(references: dict[str, Reference], lang: str | None, text: bytes) -> Reference | None:
    """The reference that a text of a language is judged by; None if there is none."""
    if lang in references and not lang.startswith(EVERY):
        return references[lang]
    script = script_of(byte_counts(text))
    reference = references.get(EVERY + script)
    if reference is None or (not lang and script not in OF_MANY):
        return reference
    # words of other languages say nothing of this one
    return replace(reference, counts=np.zeros_like(reference.counts))


def judge(text: bytes, reference: Reference | None, limits: RuleLimits) -> tuple:
    """The values of ``VERDICT`` for one text. A distance that is not judged is 0."""
    words, of_bytes = text.split(), byte_counts(text)
    counts = base_counts(text, words, of_bytes, limits.window)
    failed = counts[0] < limits.min_words or 100 * counts[4] > limits.max_repeat_percent * counts[0]
    by_class = by_word = 0.0
    classes = of_bytes @ IN_CLASS
    if reference is not None and classes.sum() >= limits.min_chars_judged and reference.classes.sum():
        by_class = js_distance(classes, reference.classes)
    if reference is not None and len(words) >= limits.min_words_judged and reference.counts.sum():
        rest = len(reference.words)
        places = [reference.words.get(word, rest) for word in words]
        by_word = js_distance(np.bincount(places, minlength=rest + 1), reference.counts)
    near = by_class <= limits.max_class_distance and by_word <= limits.max_word_distance
    return (*counts, by_class, by_word, failed, not failed and near)


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "class_distance double, word_distance double, base_failed boolean, kept boolean"
)
VERDICT_COLUMNS = tuple(part.split()[0] for part in VERDICT.split(", "))


def judge_documents(docs: DataFrame, limits: RuleLimits = RuleLimits(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row, and the counts, distances and verdict of its text."""
    spark = docs.sparkSession
    references = spark.sparkContext.broadcast(language_references(docs, limits))
    lang, text = fresh("lang", "text")
    picked = docs.select(
        *[F.col(f"`{name}`") for name in keep],
        column_or_null(docs, "lang", "string").alias(lang),
        text_bytes().alias(text),
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_tables()
        by_lang = references.value
        for batch in batches:
            columns: list[list] = [[] for _ in VERDICT_COLUMNS]
            for code, value in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1)):
                value = value.as_py()
                for column, x in zip(columns, judge(value, reference_of(by_lang, code, value), limits)):
                    column.append(x)
            kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *VERDICT_COLUMNS])

    kept = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keep)
    return picked.mapInArrow(compute, f"{kept}, {VERDICT}")


def keep_good_documents(docs: DataFrame, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, unchanged.

    The verdict is made where the row is, so no join brings them together.
    """
    spark = docs.sparkSession
    references = spark.sparkContext.broadcast(language_references(docs, limits))
    text = docs.columns.index("text")
    lang = docs.columns.index("lang") if "lang" in docs.columns else None

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_tables()
        by_lang = references.value
        for batch in batches:
            codes = [None] * batch.num_rows if lang is None else batch.column(lang).to_pylist()
            verdicts = []
            for code, value in zip(codes, batch.column(text).cast(pa.binary())):
                value = value.as_py() or b""
                verdicts.append(judge(value, reference_of(by_lang, code, value), limits)[-1])
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return docs.mapInArrow(compute, docs.schema)
