"""Language identification: counts by hand, clusters, held-out accuracy, odd tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallywatch.llm import language_id
from tallywatch.llm.language_id import DIM, gram_counts

SCHEMA = "doc_id long, text string, lang string, source string, score string, lang_pred int, drawn string, size string"
SYLLABLES = {
    "aa": ["the", "ing", "tion", "her", "on"],
    "bb": ["que", "ment", "eau", "oir", "é"],
    "cc": ["ung", "sch", "ein", "ich", "ü"],
    "dd": ["при", "вет", "ост", "ени", "я"],
}


def place(gram: str) -> int:
    mixed, mask = 0, (1 << 64) - 1
    for n, letter in enumerate(reversed(gram)):
        mixed = (mixed * 0xC2B2AE3D27D4EB4F + ord(letter) * 0x9E3779B97F4A7C15 + n) & mask
    return ((mixed * 0x165667B19E3779F9) & mask) >> (64 - DIM.bit_length() + 1)


def test_counts_by_hand():
    counts = gram_counts("Hé, HÉ 42!\n日本x")
    padded = " hé hé 日本x "
    want = Counter()
    for n in (1, 2, 3):
        # grams are mixed from their last character on
        want.update(place(padded[i : i + n]) for i in range(len(padded) - n + 1))
    assert {i: int(c) for i, c in enumerate(counts) if c} == dict(want)


@pytest.mark.parametrize("text", [None, "", " \n", "123 !? ½"])
def test_no_letter(text):
    assert gram_counts(text) is None


def test_stretches_lose_nothing(monkeypatch):
    text = " ".join("word%s" % chr(97 + i % 26) for i in range(3000))
    whole = gram_counts(text)
    monkeypatch.setattr(language_id, "STRETCH", 97)
    assert (gram_counts(text) == whole).all()


def test_clusters():
    draw = np.random.default_rng(1)
    centres = np.eye(3, 20)
    rows = np.repeat(centres, 50, axis=0) + draw.normal(0, 0.02, (150, 20))
    rows = (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)
    found, reach = language_id.cluster(rows, 3)
    assert sorted((found @ centres.T).argmax(axis=1)) == [0, 1, 2] and reach.max() < 0.05
    assert len(language_id.cluster(rows[:2], 4)[0]) == 2
    assert len(language_id.cluster(np.repeat(rows[:1], 9, axis=0), 4)[0]) == 1


def sentence(draw, lang, words):
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(3)
    rows = []
    for i in range(400):
        lang = draw.choice(list(SYLLABLES))
        rows.append((i, sentence(draw, lang, draw.choice([5, 40, 200])), lang))
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "42 ½ !", "bb"), (None, sentence(draw, "cc", 30), "cc"), (1003, sentence(draw, "bb", 30), None)]
    rows += [(1004, "ᚠᚢᚦ ᚨᚱᚲ " * 30, None), (1005, "the " * 60_000, "aa")] + [rows[0]] * 50
    return spark.createDataFrame([(*r, None, "x", 1, "y", "z") for r in rows], SCHEMA)


def test_predictions(docs):
    got = language_id.identify_languages(docs).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (1000, 1001, 1002))
    assert by[None].lang_pred == "cc" and by[1003].lang_pred == "bb" and by[1005].lang_pred == "aa"
    assert by[1004].rejected and by[1004].lang_pred in SYLLABLES
    judged = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.held_out]
    assert len(judged) > 50 and np.mean([r.lang_pred == truth[r.doc_id] for r in judged]) > 0.98
    again = language_id.identify_languages(docs.repartition(5)).collect()
    rounded = lambda rows: Counter((r.doc_id, r.lang_pred, round(r.score, 5), r.rejected) for r in rows)
    assert rounded(got) == rounded(again)


def test_inputs_are_the_text_alone(docs):
    """Other languages of held-out rows change no score."""
    from pyspark.sql import functions as F

    changed = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    first, second = (sorted((r.doc_id or -1, r.lang_pred, round(r.score, 5)) for r in language_id.identify_languages(d).collect()) for d in (docs, changed))
    assert first == second


def test_nothing_to_learn_and_empty(spark, docs):
    from pyspark.sql import functions as F

    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.identify_languages(unlabelled).collect()} == {("und", 0.0)}
    assert language_id.identify_languages(docs.limit(0)).count() == 0


def test_sample_is_bounded(docs):
    sizes = {r.lang: r["count"] for r in language_id.sample_by_language(docs.where("lang IS NOT NULL"), 20).groupBy("lang").count().collect()}
    assert all(n <= 45 for n in sizes.values())


def test_accuracy_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify_languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.98
