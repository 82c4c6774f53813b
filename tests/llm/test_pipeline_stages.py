"""The pipeline's near-duplicate stage against all pairs of fingerprints."""

from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline
from tallywatch.llm.simhash import fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, fp string, root long"


def kept_by_all_pairs(rows):
    marks = [fingerprint((text or "").encode()) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= 2:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def test_near_duplicate_stage(spark):
    draw = random.Random(3)
    rows = []
    for family in range(30):
        base = [f"w{draw.randrange(3000)}" for _ in range(400)]
        for edits in (0, 0, 1, 1, 2, 9, 60):
            words = list(base)
            for at in draw.sample(range(400), edits):
                words[at] = f"x{draw.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(900, None), (901, ""), (902, "a b"), (903, "A  b"), (904, "c d"), (905, "long " * 30_000)]
    docs = spark.createDataFrame([(*r, "en", "s", 1, "clash", 7) for r in rows], SCHEMA)
    stage = corpus_pipeline.near_duplicates(spark, docs, "")
    assert stage.columns == docs.columns
    got = [r.doc_id for r in stage.collect()]
    assert len(got) == len(set(got)) and set(got) == kept_by_all_pairs(rows)
    assert 40 < len(got) < len(rows) - 60


def test_near_duplicate_stage_on_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (2, "a b c")], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [2]
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
