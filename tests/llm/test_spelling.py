"""Spelling variants against a brute-force reader of all pairs."""

from __future__ import annotations

import random
import re
import string
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallywatch.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, root string"


def one_edit(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_words(rows) -> dict[str, int]:
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}


def brute_groups(rows):
    words = brute_words(rows)
    near = {word: [] for word in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[word] = best if best and words[best] >= 5 * words[word] else None

    def root(word):
        return root(form[word]) if form[word] else word

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    stems = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(5, 12))) for _ in range(60)]
    variants = [s for s in stems for _ in range(12)]
    for i, word in enumerate(variants):
        for _ in range(draw.randint(0, 2)):
            at = draw.randrange(len(word))
            word = draw.choice([word[:at] + word[at + 1 :], word[:at] + "x" + word[at:], word[:at] + "y" + word[at + 1 :]])
        variants[i] = word
    texts = []
    for doc_id in range(300):
        pool = stems if doc_id % 3 else variants
        texts.append((doc_id, " ".join(draw.choice(pool).title() for _ in range(120))))
    # a chain of forms: each five times as common as the one before
    chain = ["chainab", "chainabc", "chainabcd", "chainabcde", "chainabcdef"]
    texts += [(1000 + i, " ".join([word] * 5 * 5**i)) for i, word in enumerate(chain)]
    texts += [(7, None), (None, "Nowhere nowhere, nowhere nowhere nowhere"), (8, ""), (9, "123 \n"), (10, "ÀÉ " + "very" * 40_000)]
    return texts + [texts[3]] * 4


def test_equals_all_pairs(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", 1, None) for i, t in rows], SCHEMA)
    got = found(spelling.spelling_groups(docs))
    assert got == brute_groups(rows)
    assert any(form for _, form, *_ in got) and ("chainab", "chainabc", "chainabcdef", 5, 1, 25) in got


def test_short_words_and_other_parameters(spark):
    words = ["a", "b", "ab", "abc", "abd", "bc", "ba", "abcd", "bcd", "\U0001f44dbcd"]
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = {(r.a, r.b) for r in spelling.near_pairs(table).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert len(spelling.near_pairs(table).collect()) == len(got)


def test_ties_go_to_code_point_order(spark):
    rows = [(1, "abcdefg " * 5 + "abcdefz " * 30 + "abcdefé " * 30)]
    assert ("abcdefg", "abcdefz", "abcdefz", 5, 2, 30) in brute_groups(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(spelling.spelling_groups(docs)) == brute_groups(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert spelling.spelling_groups(docs).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelling.spelling_groups(docs).count() == 0


def test_common_halves_do_not_meet(spark):
    """Words with one common beginning make candidates in proportion, not all pairs."""
    draw = random.Random(5)
    words = {"prefix" + "".join(draw.choice(string.ascii_lowercase) for _ in range(6)) for _ in range(4000)}
    table = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n long")
    keys = table.select(F.explode(spelling._keys(F.col("word"), F.length("word"), 0)).alias("key"))
    met = keys.groupBy("key").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert met < 4 * len(words) * 10
