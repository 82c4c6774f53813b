"""References of the quality rules for rare languages, and rows without one."""

from __future__ import annotations

import random
from collections import Counter

from tallywatch.llm import quality_rules

ENGLISH = "the of and to in is was for on that with as by at from they are this have river stone light garden morning letter".split()
RUSSIAN = "и в не на что он как это по но они был дом река камень свет сад утро письмо город вода зима лето рука".split()
GREEK = "και το της να του με για στο που από είναι δεν νερό πόλη φως κήπος πρωί γράμμα χέρι βουνό".split()


def prose(words, n, draw):
    return " ".join(w + draw.choice(["", "", "", ",", "."]) for w in draw.choices(words, k=n))


def test_rare_scripts_are_kept(spark):
    draw = random.Random(4)
    rows = [(i, prose(ENGLISH, 3000, draw), "en") for i in range(800)]
    rows += [(1000 + i, prose(RUSSIAN, 120, draw), "ru") for i in range(20)]  # 0.1 % of all words, yet enough
    rows += [(1100, prose(GREEK, 120, draw), "el"), (1101, prose(GREEK, 120, draw), None), (1102, prose(RUSSIAN, 120, draw), None)]
    rows += [(1200, "#$%& " * 20 + prose(ENGLISH, 5, draw) + " 0123456789" * 40, None), (1201, "0 1 2 3 4 5 6 7 8 9 " * 40, "ru")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(4)
    references = quality_rules.language_references(docs)
    assert {"en", "ru"} <= set(references) and "el" not in references
    kept = {r.doc_id for r in quality_rules.judge_documents(docs).where("kept").collect()}
    assert set(range(1000, 1020)) | {1100, 1101, 1102} <= kept and not {1200, 1201} & kept
    assert {r.doc_id for r in quality_rules.keep_good_documents(docs).select("doc_id").collect()} == kept


def test_empty_texts_among_others(spark):
    draw = random.Random(5)
    rows = [(i, prose(ENGLISH, 100, draw), "en") for i in range(30)]
    odd = [(100, "", "en"), (101, None, "fr"), (102, "", None), (103, None, None)]
    docs = spark.createDataFrame(odd[:2] + rows + odd[2:], "doc_id int, text string, lang string").coalesce(1)
    judged = {r.doc_id: r for r in quality_rules.judge_documents(docs).collect()}
    assert len(judged) == len(rows) + len(odd)
    assert all(judged[i].base_failed and not judged[i].kept and judged[i].n_words == 0 for i, _, _ in odd)
    alone = quality_rules.judge_documents(docs.where("text != ''")).collect()
    assert all(judged[r.doc_id] == r for r in alone) and len(alone) == len(rows)
    kept = {r.doc_id for r in quality_rules.keep_good_documents(docs).collect()}
    assert kept == {i for i, r in judged.items() if r.kept}
    assert not quality_rules.language_references(docs.where("doc_id >= 100"))


def test_words_that_begin_with_a_zero_byte(spark):
    draw = random.Random(6)
    rows = [(i, prose(ENGLISH, 100, draw) + " \x00 \x00abc \x003 \x0042 \x003", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(3)
    texts = [text.encode() for _, text, _ in rows]
    counts = Counter(word for text in texts for word in text.split())
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: quality_rules.RuleLimits().common]
    references = quality_rules.language_references(docs)
    assert set(references) == {"en", "*latin"}
    for reference in references.values():
        assert list(reference.words) == [word for word, _ in best] and {b"\x00", b"\x003"} <= set(reference.words)
        assert reference.counts.tolist() == [n for _, n in best] + [counts.total() - sum(n for _, n in best)]
        assert reference.classes.tolist() == sum(quality_rules.byte_counts(t) @ quality_rules.IN_CLASS for t in texts).tolist()
    assert quality_rules.judge_documents(docs).count() == quality_rules.judge_documents(docs).where("NOT base_failed").count() == 30
