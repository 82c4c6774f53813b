"""Brute-force versions, round trips and odd tables for the training-data operators."""

from __future__ import annotations

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallywatch.llm import archive, bpe, graph_search, html_text, licenses, lm_score, mixing, quality_model, quality_rules, simhash
from tallywatch.llm.components import connected_components
from tallywatch.llm.queries import vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept int, size string"
LONG = " ".join(f"w{i % 977}" for i in range(20_000))
PROSE = "The cat sat on the mat and looked at the rain. " * 3
ROWS = [
    (1, PROSE, "en", "b"),
    (2, PROSE.upper(), "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \n\t ", "fr", "a"),
    (6, LONG, "en", "a"),
    (7, "é 日本 \U0001f44d <|endoftext|> x", None, "ü"),
    (7, "é 日本 \U0001f44d <|endoftext|> x", None, "ü"),
    (None, "no id at all, but some words", "en", "b"),
    (8, "Released under the MIT License.\nsame\nsame", "en", None),
    (9, " ".join(["a b c d e"] * 9), "de", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, None, "x", 1, "y") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(text):
    return (text or "").encode().split()


def brute_fingerprint(text):
    ws = [w.lower() for w in words(text)]
    if not ws:
        return 0
    shingles = [b" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_classes(spark, docs, none):
    got = simhash.near_duplicate_classes(docs).collect()
    want = [brute_fingerprint(r[1]) for r in ROWS]
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in got) == Counter((r[0], f) for r, f in zip(ROWS, want))
    by = {r.doc_id: r.component_id for r in got}
    assert by[2] == by[1] == 1 and by[4] == by[5] == by[3] == 3
    assert simhash.near_duplicate_classes(none).count() == 0
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert Counter(r.component_id for r in got).keys() == {r.doc_id for r in kept.collect()}


def test_links_match_all_pairs(spark):
    draw = random.Random(4)
    seeds = [draw.getrandbits(64) for _ in range(20)]
    values = {s ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 3))) for s in seeds for _ in range(12)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    roots = connected_components(simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long")))
    got = {r.node: r.component for r in roots.collect()}
    parent = {v: v for v in signed}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in signed:
        for b in signed:
            if ((a ^ b) % (1 << 64)).bit_count() <= 2:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    assert all(got.get(v, v) == find(v) for v in signed)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))


def brute_targets(sizes, cycle=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in names if s not in capped)
        if not open_:
            return {s: cap * sizes[s] for s in names}
        more = {s for s in names if s not in capped and rest * weight[s] / open_ >= cap * sizes[s]}
        if not more:
            return {s: cap * sizes[s] if s in capped else rest * weight[s] / open_ for s in names}
        capped |= more


def test_mix_targets_and_balance(spark, docs, none):
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in ROWS:
        sizes[r[3]] += len(words(r[1]))
    want = brute_targets(sizes)
    assert len(got) == len(ROWS)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
    assert mixing.mix(none).count() == 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    draw = random.Random(1)
    many = [(i, " ".join(["w"] * draw.randint(1, 60)), f"s{min(i % 7, 3)}") for i in range(4000)]
    frame = spark.createDataFrame(many, "doc_id long, text string, source string")
    first = mixing.mix(frame, block_rows=100).collect()
    again = mixing.mix(frame.repartition(7), block_rows=100).collect()
    assert sorted(first) == sorted(again)
    taken, target = Counter(), {}
    for r in first:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_flight_keeps_totals():
    draw = np.random.default_rng(2)
    sizes, chances = draw.integers(0, 50, 500).astype(float), draw.random(500)
    out = mixing.flight(sizes, chances, draw)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert math.isclose(out.sum(), chances.sum(), abs_tol=1e-6)
    assert math.isclose(out @ sizes, chances @ sizes, abs_tol=1e-4)


def test_bpe_equals_the_library(docs, none):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    codec = bpe.Codec(open(vocabulary_path(), encoding="utf-8").read())
    draw = random.Random(3)
    pool = ["a", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "é", "日本", "\U0001f44d", "'s", "12", "<|endoftext|>", "<|", "$$", "\x00"]
    for _ in range(1500):
        text = "".join(draw.choice(pool) for _ in range(draw.randint(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    got = bpe.encoding_digests(docs, vocabulary_path()).collect()
    want = Counter()
    for r in ROWS:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        joined, back = ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        want[(r[0], len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] += 1
    assert Counter(map(tuple, got)) == want
    encoded = bpe.encode_documents(docs, vocabulary_path())
    assert Counter(map(tuple, bpe.decode_documents(encoded, vocabulary_path()).collect())) == Counter((r[0], r[1] or "") for r in ROWS)
    assert bpe.encoding_digests(none, vocabulary_path()).count() == 0


def test_rule_counts_match_brute_force(docs, none):
    def repeats(ws):
        seen = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
        return len({j for i in range(len(ws) - 4) if seen[tuple(ws[i : i + 5])] > 1 for j in range(i, i + 5)})

    got = quality_rules.judge_documents(docs).collect()
    want = Counter()
    for r in ROWS:
        text, ws = r[1] or "", words(r[1])
        lines = [line for line in text.split("\n") if line.encode().split()]
        chars = sum(len(w.decode()) for w in ws)
        n = repeats(ws)
        failed = len(ws) < 10 or 100 * n > 20 * len(ws)
        want[(r[0], len(ws), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), n, failed)] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    kept = quality_rules.keep_good_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert quality_rules.judge_documents(none).count() == 0
    assert quality_rules.js_distance(np.array([1, 0]), np.array([0, 3])) == 1


def test_rules_and_classifier_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = labels.where("quality = 1").select("doc_id")
    judged = quality_rules.judge_documents(table).where("NOT base_failed").join(good, "doc_id")
    assert judged.where("NOT kept").count() == 0
    scored = quality_model.quality_scores(table, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) >= 0.93


def test_classifier_on_odd_tables(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_model.quality_scores(docs, labels).collect())
    assert {r.score for r in quality_model.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.quality_scores(none, labels).count() == 0
    assert quality_model.keep_good_quality(docs, labels.limit(0)).columns == docs.columns


def test_html_text(spark):
    tree = html_text.train_tree()
    page = (
        "<title>t</title><script>var t='</p>';</script><nav><ul><li><a href=x>Home</a></ul></nav><div class=ad>Buy it now</div>"
        "<article><h1>Head &amp; more</h1><p>First <b>line<br>goes on.<p>So does&nbsp;this &#233;.<form><label>Mail</label></form></article>"
        "<section id='comments'><p>I liked it very much indeed.</p></section><footer>&copy; x</footer><p cla"
    )
    assert html_text.main_text(page, tree) == "Head & more\n\nFirst line goes on.\n\nSo does this é."
    rows = [(1, "u", page), (1, None, None), (None, "u", ""), (2, "v", "just text"), (3, "w", "<p>" + "long " * 50_000)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract_pages(frame).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[2] == "just text" and max(r.n_chars for r in got) == 5 * 50_000 - 1
    assert html_text.extract_pages(frame.limit(0)).count() == 0


def test_graph_search(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(1200, 16)).astype(np.float32)
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [1.0, 2.0]), (None, x[3].tolist()), (0, x[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in graph_search.search(frame, F.col("vec_id") % 100 == 0, shard_rows=400).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    assert set(got) == set(range(0, 1200, 100))
    found = 0
    for q, pairs in got.items():
        far = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        want = sorted((d, i) for i, d in enumerate(far) if i != q)[:10]
        found += len({i for _, i in want} & {i for _, i in pairs})
        assert pairs == sorted(pairs) and all(math.isclose(s, far[i], abs_tol=1e-9) for s, i in pairs)
    assert found / (10 * len(got)) >= 0.9
    assert graph_search.search(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_licenses(docs, none):
    got = licenses.scan_licenses(docs).collect()
    assert [(r.doc_id, r.line, r.license, r.exact) for r in got] == [(8, 0, "MIT", True)]
    scanner = licenses.Scanner()
    assert all(scanner.match(text.encode())[0] == name for name, text in licenses.TEMPLATES)
    assert scanner.match(b"his driver license was lost in the rain") is None
    assert licenses.document_licenses(none).count() == 0


def test_language_model(docs, none):
    got = lm_score.stupid_backoff(docs, group_docs=3).collect()
    texts = [words(r[1]) for r in ROWS]
    one, two = Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(t, t[1:]))
    total, want = sum(one.values()), []
    for r, t in zip(ROWS, texts):
        o, b, rest, score = Counter(t), Counter(zip(t, t[1:])), max(1, total - len(t)), 0.0
        for i, w in enumerate(t):
            factor = 1.0
            if i:
                v = t[i - 1]
                if two[v, w] > b[v, w]:
                    score += math.log((two[v, w] - b[v, w]) / (one[v] - o[v]))
                    continue
                factor = 0.4
            score += math.log(factor * (one[w] - o[w]) / rest if one[w] > o[w] else factor * 0.4 / rest)
        want.append((r[0] or -1, len(t), round(score, 5)))
    assert sorted((r.doc_id or -1, r.n_words, round(r.log_score, 5)) for r in got) == sorted(want)
    assert lm_score.stupid_backoff(none).count() == 0


def test_archive_round_trip(spark, tmp_path):
    rows = [(1, "u", "<p>é"), (2, "a\nb", "<p>é"), (3, None, None), (4, "x", ""), (None, "y", "<p>é"), (5, "z", "q\r\n\r\nWARC/1.1")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    archive.write_archive(frame, str(tmp_path / "a"))
    got = {r.page_id: r for r in archive.parse_records(archive.read_records(spark, str(tmp_path / "a"))).collect()}
    refers = {1: 2, 2: None, 3: 4, 4: None, None: 2, 5: None}
    for page, _, html in rows:
        data, r = (html or "").encode(), got[page]
        assert r.payload_bytes == len(data) and r.refers_to == refers[page]
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r.record_type == ("revisit" if refers[page] else "response")
        assert r.payload is None or bytes(r.payload) == data
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == 3
    archive.write_archive(frame.limit(0), str(tmp_path / "b"))
    assert archive.read_records(spark, str(tmp_path / "b")).count() == 0


def test_pipeline_stages_keep_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-2]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert set(corpus_pipeline.run(spark, sf).columns) == {"doc_id", "source", "ids", "n_tokens"}
