"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import (
    archive,
    bpe,
    graph_search,
    html_text,
    language_id,
    licenses,
    lm_score,
    mixing,
    prefix_trie,
    quality_model,
    quality_rules,
    simhash,
    spelling,
)
from tallywatch.llm.common import documents, shared_dir, table


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicate_classes(documents(spark, sf_dir))
    return classes.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(documents(spark, sf_dir), vocabulary_path())


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.stupid_backoff(documents(spark, sf_dir))
    return scored.select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score")
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "archive")
    archive.write_archive(table(spark, sf_dir, "pages"), path)
    records = archive.parse_records(archive.read_records(spark, path))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(documents(spark, sf_dir))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "class_distance",
        "word_distance",
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_simhash": op2_simhash,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_html_extraction": op4_html_extraction,
    "op5_bpe": op5_bpe,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_license_scan": op7_license_scan,
    "op8_language_model": op8_language_model,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_language_id": op13_language_id,
}

# crc32 of a text in SQL: the table of the polynomial, then one step a byte
CRC = """
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS steps
)
"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text expression, where the row has ``steps`` of ``crc``."""
    return f"""xor(list_reduce(list_transform(range(octet_length(encode({text}))),
      lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT),
      lambda a, b: xor(steps[((xor(a, b)) & 255) + 1], a >> 8), 4294967295::BIGINT), 4294967295)"""


ORACLES: dict[str, str] = {
    "op8_language_model": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
t AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
total AS (SELECT count(*) AS n FROM t),
own AS (SELECT rid, count(*) AS n FROM t GROUP BY rid),
c1 AS (SELECT w, count(*) AS n FROM t GROUP BY w),
d1 AS (SELECT rid, w, count(*) AS n FROM t GROUP BY rid, w),
b AS (SELECT x.rid, x.i, y.w AS v, x.w FROM t x LEFT JOIN t y ON y.rid = x.rid AND y.i = x.i - 1),
c2 AS (SELECT v, w, count(*) AS n FROM b WHERE v IS NOT NULL GROUP BY v, w),
d2 AS (SELECT rid, v, w, count(*) AS n FROM b WHERE v IS NOT NULL GROUP BY rid, v, w),
s AS (
  SELECT b.rid,
    CASE WHEN b.v IS NOT NULL AND c2.n > d2.n THEN ln((c2.n - d2.n)::DOUBLE / (cv.n - dv.n))
         WHEN cw.n > dw.n THEN ln((CASE WHEN b.v IS NULL THEN 1.0 ELSE 0.4 END)::DOUBLE * (cw.n - dw.n) / greatest(1, total.n - own.n))
         ELSE ln((CASE WHEN b.v IS NULL THEN 1.0 ELSE 0.4 END)::DOUBLE * 0.4::DOUBLE / greatest(1, total.n - own.n)) END AS score
  FROM b CROSS JOIN total JOIN own ON own.rid = b.rid
  JOIN c1 cw ON cw.w = b.w JOIN d1 dw ON dw.rid = b.rid AND dw.w = b.w
  LEFT JOIN c1 cv ON cv.w = b.v LEFT JOIN d1 dv ON dv.rid = b.rid AND dv.w = b.v
  LEFT JOIN c2 ON c2.v = b.v AND c2.w = b.w LEFT JOIN d2 ON d2.rid = b.rid AND d2.v = b.v AND d2.w = b.w
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, round(coalesce(sum(s.score), 0.0), 4) AS log_score,
  round(CASE WHEN len(d.ws) > 0 THEN coalesce(sum(s.score), 0.0) / len(d.ws) ELSE 0.0 END, 6) AS mean_log_score
FROM d LEFT JOIN s ON s.rid = d.rid GROUP BY d.rid, d.doc_id, d.ws
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
r AS (SELECT h, max(page_id) AS responder FROM p GROUP BY h)
SELECT p.page_id, p.payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(p.h, (1 + 5 * (i // 4))::INT, 5))::BIGINT) >> (5 * (3 - i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN p.page_id IS NOT DISTINCT FROM r.responder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id IS NOT DISTINCT FROM r.responder THEN NULL ELSE r.responder END AS refers_to
FROM p JOIN r USING (h)
""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE {CRC},
r AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 6
),
g AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, {crc32_sql("named")} AS h FROM g CROSS JOIN crc),
w AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n
  FROM h GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
near AS (
  SELECT DISTINCT x.word AS a, y.word AS b, y.n AS n FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT DISTINCT x.word, w.word, w.n FROM cut x JOIN w ON w.word = x.rest
  UNION SELECT DISTINCT w.word, x.word, x.n FROM cut x JOIN w ON w.word = x.rest
),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS b, max(n) AS m FROM near GROUP BY a),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN b END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM w LEFT JOIN best ON best.a = w.word
),
p AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT p.word, f.word, f.form FROM p JOIN f ON f.word = p.next)
SELECT f.word, f.form, p.at AS root, f.n, f.n_near, f.form_n FROM f JOIN p ON p.word = f.word AND p.next IS NULL
""",
    "op12_prefix_trie": rf"""
WITH {CRC},
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, {crc32_sql("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t) CROSS JOIN crc),
r AS (
  SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND i <= h
  UNION ALL SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND i > h
),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS depth, sha256(length(role) || ':' || role || text) AS x, length(text) AS chars FROM r),
k AS (
  SELECT conv_id, depth, chars, sha256(string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM d
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
),
l AS (SELECT conv_id, max(depth) AS last FROM k GROUP BY conv_id),
n AS (
  SELECT key, k.depth, any_value(chars) AS chars, min(k.conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN k.depth = l.last THEN k.conv_id::VARCHAR END, ',' ORDER BY k.conv_id), '')) AS ends_sha256
  FROM k JOIN l USING (conv_id) GROUP BY key, k.depth
),
m AS (SELECT k.conv_id AS member, n.conv_id, n.depth FROM k JOIN n ON n.key = k.key AND n.depth = k.depth),
p AS (SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id FROM n JOIN m ON m.member = n.conv_id AND m.depth = n.depth - 1),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM p GROUP BY ALL),
v AS (SELECT n.conv_id, n.depth, (n_convs - 1) * chars AS saved, (n_children IS NULL)::INT AS leaf FROM n LEFT JOIN kids USING (conv_id, depth)),
s AS (
  SELECT m.conv_id, m.depth, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves
  FROM v JOIN m ON m.member = v.conv_id AND m.depth <= v.depth GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM n JOIN s USING (conv_id, depth) LEFT JOIN p USING (conv_id, depth) LEFT JOIN kids USING (conv_id, depth)
""",
}
