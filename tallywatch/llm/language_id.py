"""Language identification by nearest centroids.

A text is the TF-IDF vector of its character n-grams (one to three lower-cased
letters, words set apart by blanks), hashed into ``DIM`` places and normalised.
Document frequencies come from every learning document. The vectors of each
language are clustered (spherical k-means) into several centroids; only this
fit works on a sample, about ``SAMPLE`` documents a language drawn by a hash of
id and text. A text belongs to the language of the centroid with the largest
cosine. Every centroid knows how far its own learning documents lie from it; a
text that is farther from its nearest centroid than ``SLACK`` times that
distance is marked as rejected.

Languages with fewer learning documents than ``CENTROIDS`` have fewer
centroids. All centroids are broadcast: ``CENTROID_BYTES`` bounds them, and
many languages get fewer centroids each to stay below it.

Defined results: a null text and one without a letter are ``und`` with score 0,
and rejected; so is every text if nothing can be learned. A null language is
not learned from; a null id counts as held out. Ties go to the language that
sorts first. Repeated rows are scored each, and learned from once in the
sample. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import save_and_reload

DIM = 1 << 12
CENTROIDS = 4
SAMPLE = 1500
ROUNDS = 12
SLACK = 1.25
CENTROID_BYTES = 1 << 27
FOLDS = 5
SEED = 13
STRETCH = 1 << 18
NONE = "und"
BLANK = 32
# Odd multipliers that mix the letters of an n-gram.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str | None) -> np.ndarray | None:
    """How often each place of the vector occurs in the whole text; None without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return None
    # other characters become one blank, and the text begins and ends with one
    edges = np.concatenate(([False], is_letter[:-1]))
    codes = np.where(is_letter, codes, BLANK)[is_letter | edges]
    codes = np.concatenate(([BLANK], codes, [BLANK])).astype(np.uint64)
    counts = np.zeros(DIM, np.int64)
    shift = np.uint64(64 - DIM.bit_length() + 1)
    for start in range(0, len(codes), STRETCH):
        # with the two characters before, so that no n-gram is lost between stretches
        piece = codes[max(0, start - 2) : start + STRETCH]
        known = min(start, 2)
        mixed = np.zeros(len(piece), np.uint64)
        for n in range(3):
            mixed[n:] = mixed[n:] * MIX[1] + piece[: len(piece) - n] * MIX[0] + np.uint64(n)
            places = (mixed[max(n, known) :] * MIX[2]) >> shift
            counts += np.bincount(places.astype(np.int64), minlength=DIM)
    return counts


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows of gram counts."""
    weighted = np.log1p(counts) * idf
    norms = np.linalg.norm(weighted, axis=1, keepdims=True)
    return (weighted / np.maximum(norms, 1e-12)).astype(np.float32)


def held_out(doc_id: str = "doc_id") -> Column:
    remainder = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == 0, F.lit(True))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts with a letter, and for each place in how many of them it occurs.

    Every task adds up its texts and sends ``DIM`` + 1 numbers.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    seen[:DIM] += counts > 0
                    seen[DIM] += 1
        if seen[DIM]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1, dtype=np.int32)), pa.array(seen)], names=["place", "seen"])

    sums = texts.select("text").mapInArrow(tally, "place int, seen long").groupBy("place").agg(F.sum("seen").alias("seen"))
    total = np.zeros(DIM + 1, np.int64)
    for row in sums.collect():  # DIM + 1 rows
        total[row.place] = row.seen
    return int(total[DIM]), total[:DIM]


def sample_by_language(learning: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``lang`` and ``text`` of about ``sample`` different documents of each language.

    A document is drawn if the hash of its id and text is below the share its
    language needs, so nothing is ranked and a large language costs no more.
    The sizes of the languages are broadcast; there are as many as centroids fit.
    """
    sizes = save_and_reload(learning.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "language-sizes")
    languages, room = sizes.count(), CENTROID_BYTES // (4 * DIM)
    if languages > room:
        raise ValueError(f"{languages} languages do not fit into {room} centroids")
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("size")) * float(1 << 32)
    hashed = learning.select("lang", "text", F.xxhash64("doc_id", "text").alias("drawn"))
    kept = hashed.join(F.broadcast(sizes), "lang").where(F.pmod("drawn", F.lit(1 << 32)) < share)
    return kept.dropDuplicates(["lang", "drawn"]).select("lang", "text", "drawn")


def cluster(vectors: np.ndarray, many: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit rows and the distance within which 99 % of each one's rows lie."""
    draw = np.random.default_rng(SEED)
    many = min(many, len(vectors))
    chosen = [int(draw.integers(len(vectors)))]
    while len(chosen) < many:
        # the next seed is drawn with the squared distance to the nearest one so far
        apart = np.maximum(1 - (vectors @ vectors[chosen].T).max(axis=1), 0).astype(float) ** 2
        if apart.sum() <= 1e-9:
            break
        chosen.append(int(draw.choice(len(vectors), p=apart / apart.sum())))
    centroids = vectors[chosen]
    for _ in range(rounds):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[nearest == i].sum(axis=0) if (nearest == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    likeness = vectors @ centroids.T
    nearest = likeness.argmax(axis=1)
    reach = [1 - float(np.quantile(likeness[nearest == i, i], 0.01)) if (nearest == i).any() else 0.0 for i in range(len(centroids))]
    return centroids.astype(np.float32), np.array(reach, np.float32)


@dataclass
class Centroids:
    """Unit centroids by row, their languages, how far each reaches, and the weights of the places."""

    languages: list[str]
    vectors: np.ndarray
    reach: np.ndarray
    idf: np.ndarray


def fit(docs: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Centroids:
    """Learn from the rows of ``docs`` that have a language and are not held out."""
    learning = docs.where(F.col("lang").isNotNull() & ~held_out()).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    size, frequency = document_frequencies(learning)
    idf = np.log((1 + size) / (1 + frequency)) + 1
    drawn = save_and_reload(sample_by_language(learning, sample), "language-sample")
    languages = drawn.select("lang").distinct().count()
    many = max(1, min(centroids, CENTROID_BYTES // (4 * DIM) // max(languages, 1)))

    def fit_one(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("drawn").to_numpy(), kind="stable")
        texts = rows.column("text")
        counts = [gram_counts(texts[int(i)].as_py()) for i in order]
        counts = [found.astype(np.float32) for found in counts if found is not None]
        if not counts:
            return pa.table({"lang": pa.array([], pa.string()), "number": pa.array([], pa.int32()), "reach": pa.array([], pa.float32()), "packed": pa.array([], pa.binary())})
        found, reach = cluster(unit_vectors(np.stack(counts), idf), many)
        lang = rows.column("lang")[0].as_py()
        return pa.table(
            {
                "lang": [lang] * len(found),
                "number": pa.array(range(len(found)), pa.int32()),
                "reach": pa.array(reach, pa.float32()),
                "packed": [row.astype("<f4").tobytes() for row in found],
            }
        )

    fitted = drawn.groupBy("lang").applyInArrow(fit_one, "lang string, number int, reach float, packed binary")
    rows = sorted(fitted.collect(), key=lambda row: (row.lang, row.number))  # at most ``room`` rows
    vectors = np.stack([np.frombuffer(row.packed, "<f4") for row in rows]) if rows else np.zeros((0, DIM), np.float32)
    return Centroids([row.lang for row in rows], vectors, np.array([row.reach for row in rows], np.float32), idf)


def predict(docs: DataFrame, model: Centroids, slack: float = SLACK) -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score`` (cosine) and ``rejected``.

    ``lang_pred`` names the nearest language also where ``rejected`` says that
    the text is too far from it; callers that want silence there drop those.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            names, scores, far = [], [], []
            for start in range(0, batch.num_rows, 256):
                counts = [gram_counts(text.as_py()) for text in batch.column(1).slice(start, 256)]
                has = [found is not None and bool(known.languages) for found in counts]
                if any(has):
                    rows = unit_vectors(np.stack([c for c, h in zip(counts, has) if h]), known.idf)
                    likeness = rows @ known.vectors.T
                    best = likeness.argmax(axis=1)
                    best_score = np.clip(likeness[np.arange(len(best)), best], 0, 1)
                    results = iter(zip(best.tolist(), best_score.tolist(), (1 - best_score > slack * known.reach[best]).tolist()))
                for some in has:
                    place, value, away = next(results) if some else (-1, 0.0, True)
                    names.append(known.languages[place] if some else NONE)
                    scores.append(value)
                    far.append(away)
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def identify_languages(docs: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, slack: float = SLACK) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected``."""
    return predict(docs, fit(docs, centroids, sample), slack).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
