"""Near-duplicate texts by SimHash fingerprints and ball hashing.

Texts are lower-cased (A to Z), cut into words and 3-word shingles; each bit
of the 64-bit fingerprint is the majority of that bit over the shingles'
XXH64 (seed 42). Two fingerprints are linked at ``radius`` or fewer differing
bits. The search meets in the middle: every distinct fingerprint emits all
values within half the radius of itself, so two linked fingerprints share at
least one value. One shuffle on those values brings them together; a value
can be reached from no more fingerprints than its ball holds (65 for radius
2), so no group grows with the data however many copies a text has: copies
share a fingerprint and are collapsed before the search.

Defined results: a null text counts as empty; texts without words have
fingerprint zero and link like any other; shorter texts are one shingle;
rows that repeat a doc_id stay separate rows; a null doc_id never names a
component unless every member's is null. An empty table gives no rows.
Columns of the input other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.common import free_tables, fresh, save_and_reload, text_bytes
from tallywatch.llm.components import connected_components

SEED = 42


def fingerprint(text: bytes, shingle: int = 3, seed: int = SEED) -> int:
    """The unsigned fingerprint of a text given as UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: 1 - shingle].tolist()
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Per row: ``doc_id``, ``key`` (a hash of id and text) and ``fp``, signed 64 bits."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_tables()
        for batch in batches:
            values = [fingerprint(text.as_py(), shingle) for text in batch.column(2)]
            fp = pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], names=["doc_id", "key", "fp"])

    picked = docs.select("doc_id", row_key().alias("key"), text_bytes().alias("text"))
    return picked.mapInArrow(compute, f"doc_id {kind}, key long, fp long")


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def ball(fp: Column, reach: int) -> Column:
    """All 64-bit values within ``reach`` bits of ``fp``, itself included."""
    masks = [0] + [sum(1 << bit for bit in bits) for n in range(1, reach + 1) for bits in combinations(range(64), n)]
    return F.array(*[fp.bitwiseXOR(F.lit(_signed(mask)).cast("long")) for mask in masks])


def fingerprint_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Verified links ``a < b`` that join all fingerprints within ``radius`` bits.

    Members of one ball are at most ``2 * reach`` bits apart, so for an even
    radius neighbours in its order are links, and a chain of them joins the
    whole ball. For an odd radius a ball also holds pairs one bit too far, so
    all its pairs are verified (a ball's size is bounded, see above).
    """
    reach = (radius + 1) // 2
    emitted = distinct.select("fp", F.explode(ball(F.col("fp"), reach)).alias("variant"))
    if radius % 2 == 0:
        order = Window.partitionBy("variant").orderBy("fp")
        pairs = emitted.select(F.lag("fp").over(order).alias("a"), F.col("fp").alias("b")).where("a IS NOT NULL")
    else:
        left, right = emitted.withColumnRenamed("fp", "a"), emitted.withColumnRenamed("fp", "b")
        pairs = left.join(right, "variant").where("a < b").select("a", "b")
    return pairs.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicate_classes(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``key``, ``fp`` and ``component_id``.

    ``component_id`` is the smallest doc_id among all rows whose fingerprint
    can be reached over links.
    """
    marked, by_root = _rooted(docs, radius, shingle)
    named = by_root.groupBy("root").agg(F.min("least.doc_id").alias("component_id"))
    by_fp = by_root.join(named, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "key", "fp", "component_id")


def _rooted(docs: DataFrame, radius: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The marked rows, and per distinct fingerprint its first row and the root of its group."""
    marked = save_and_reload(fingerprints(docs, shingle), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    classes = save_and_reload(marked.groupBy("fp").agg(F.min(first).alias("least")), "simhash-classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), radius))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return marked, placed.select("fp", "least", F.coalesce("component", "fp").alias("root"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_per_group(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """The rows of ``docs``, one of each near-duplicate group, with their columns.

    Kept is the row with the group's smallest doc_id (null last; between texts
    that share it, the one whose hash is smaller).
    """
    _, by_root = _rooted(docs, radius, shingle)
    heads = by_root.groupBy("root").agg(F.min("least").alias("least"))
    head_id, head_key, own_key = fresh("head_id", "head_key", "own_key")
    heads = heads.select(F.col("least.doc_id").alias(head_id), F.col("least.key").alias(head_key))
    keyed = docs.withColumn(own_key, row_key())
    kept = keyed.join(heads, F.col(own_key).eqNullSafe(F.col(head_key)) & F.col("doc_id").eqNullSafe(F.col(head_id)), "left_semi")
    return kept.dropDuplicates([own_key, "doc_id"]).select(*[F.col(f"`{name}`") for name in docs.columns])
