"""Stupid-backoff language-model scores from relational n-gram counts.

Documents are dealt into groups of bounded size. Every group counts its
distinct n-grams and sends them, hashed, to the hash partition that owns
them: the count tables are partitioned by hash and never gathered. Each
partition adds the groups' counts up and answers every group with the totals
of the n-grams it asked for, in the order asked; a last join brings answers
and texts of a group together, where each document sums its scores. N-grams are
counted within a group before they are sent, so one that stands in every text is sent once a
group, and counts travel packed, a partition's share of a group in one row.

A document does not vouch for itself: its own n-grams are taken off the counts
before it is scored. With ``f`` the remaining counts and ``N`` the remaining
words, a word ``w`` after ``v`` scores ``f(vw) / f(v)`` where ``f(vw) > 0``, else
``alpha * f(w) / N`` where ``f(w) > 0``, else ``alpha^2 / N``; the first word
skips the first step (and its factor). Longer orders back off one word at a
time in the same way.

Defined results: words are as in ``common.WORD``; a null or empty text has no
words and score 0; a document that is all there is has ``N = 0``, for which 1
is used; rows that repeat, also in doc_id, are separate documents; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import WORD, text_bytes

ORDER = 2
ALPHA = 0.4
GROUP_DOCS = 2_000
GROUPS_PER_SHARE = 2
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def gram_hashes(text: bytes, order: int, hashes: WordHashes) -> list[np.ndarray]:
    """Hashes of the n-grams of a text that end at each word; index 0 holds words.

    The n-gram of length n that ends at word i is at i - n + 1 of list n - 1.
    """
    words = text.split()
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    grams = [one]
    for n in range(2, order + 1):
        longer = grams[-1][:-1] if len(grams[-1]) else grams[-1]
        mixed = (longer ^ (longer >> np.uint64(29))) * MIX + one[n - 1 :] + np.uint64(n)
        grams.append(mixed ^ (mixed >> np.uint64(32)))
    return grams


def group_grams(texts: list[bytes], order: int) -> tuple[list[list[np.ndarray]], np.ndarray, np.ndarray]:
    """The hashes of each text, and the distinct ones of all with their counts."""
    hashes = WordHashes()
    grams = [gram_hashes(text, order, hashes) for text in texts]
    flat = [part for one in grams for part in one]
    distinct, counts = np.unique(np.concatenate(flat) if flat else np.zeros(0, np.uint64), return_counts=True)
    return grams, distinct, counts


def share_bounds(distinct: np.ndarray, shares: int) -> np.ndarray:
    """Where the shares of equal hash ranges begin in sorted hashes, and the end."""
    limits = [(i << 64) // shares for i in range(1, shares)]
    inner = np.searchsorted(distinct, np.array(limits, np.uint64))
    return np.concatenate([[0], inner, [len(distinct)]]).astype(int)


def _packed(values: np.ndarray) -> bytes:
    """Positive whole numbers, small ones in little room."""
    return zlib.compress(values.astype("<u4" if values.size and values.max() >= 256 else "u1").tobytes(), 1)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(packed)
    return np.frombuffer(raw, "u1" if len(raw) == n else "<u4").astype(np.int64)


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes as steps, byte by byte: the leading bytes of small steps are runs of zeros."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    steps[:1] = hashes[:1]
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def log_scores(grams: list[np.ndarray], distinct: np.ndarray, totals: np.ndarray, n_words: int, alpha: float) -> float:
    """The sum of the log scores of one text's words; ``totals`` are the corpus' counts of ``distinct``."""
    words = len(grams[0])
    if not words:
        return 0.0
    rest = float(max(1, n_words - words))
    left = []
    for hashes in grams:
        own, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        others = totals[np.searchsorted(distinct, own)] - counts
        left.append(others[inverse].astype(float))
    score = np.full(words, np.nan)
    factor = np.ones(words)
    for n in range(len(grams), 1, -1):
        ends = np.arange(n - 1, words)
        above, below = left[n - 1], left[n - 2][: len(ends)]
        open_ = np.isnan(score[ends])
        hit = open_ & (above > 0)
        score[ends[hit]] = np.log(factor[ends[hit]] * above[hit] / below[hit])
        factor[ends[open_ & ~hit]] *= alpha
    open_ = np.isnan(score)
    known = open_ & (left[0] > 0)
    score[known] = np.log(factor[known] * left[0][known] / rest)
    unknown = open_ & ~known
    score[unknown] = np.log(factor[unknown] * alpha / rest)
    return float(score.sum())


def stupid_backoff(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``log_score`` (natural) and ``mean_log_score``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows, n_words = docs.agg(F.count("*"), F.coalesce(F.sum(F.regexp_count("text", F.lit(WORD))), F.lit(0))).first()
    groups = max(1, -(-rows // group_docs))
    shares = max(8, groups // GROUPS_PER_SHARE)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    dealt = docs.select("doc_id", text_bytes().alias("text"), place.alias("place"))

    def ask(part: pa.Table) -> pa.Table:
        texts = [x.as_py() for x in part.column("text")]
        grams, distinct, counts = group_grams(texts, order)
        bounds = share_bounds(distinct, shares)
        asked, numbers = [], []
        for low, high in zip(bounds, bounds[1:]):
            asked.append(pack_sorted(distinct[low:high]))
            numbers.append(_packed(counts[low:high]))
        n = len(asked)
        return pa.table(
            {
                "place": pa.array([part.column("place")[0].as_py()] * n, pa.int32()),
                "share": pa.array(range(n), pa.int32()),
                "grams": pa.array(asked, pa.binary()),
                "counts": pa.array(numbers, pa.binary()),
            }
        ).filter(pa.array([bool(x) for x in asked]))

    def answer(part: pa.Table) -> pa.Table:
        grams = [unpack_sorted(x.as_py()) for x in part.column("grams")]
        counts = [_unpacked(x.as_py(), len(g)) for x, g in zip(part.column("counts"), grams)]
        distinct, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        answers, at = [], 0
        for own in grams:
            answers.append(_packed(totals[inverse[at : at + len(own)]]))
            at += len(own)
        return pa.table({"place": part.column("place"), "share": part.column("share"), "totals": pa.array(answers, pa.binary())})

    asked = dealt.groupBy("place").applyInArrow(ask, "place int, share int, grams binary, counts binary")
    answered = asked.groupBy("share").applyInArrow(answer, "place int, share int, totals binary")

    def score(texts: pa.Table, totals: pa.Table) -> pa.Table:
        bodies = [x.as_py() for x in texts.column("text")]
        grams, distinct, _ = group_grams(bodies, order)
        bounds = share_bounds(distinct, shares)
        found = np.zeros(len(distinct), np.int64)
        for share, packed in zip(totals.column("share").to_pylist(), totals.column("totals")):
            low, high = bounds[share], bounds[share + 1]
            found[low:high] = _unpacked(packed.as_py(), high - low)
        sums = [log_scores(one, distinct, found, n_words, alpha) for one in grams]
        counts = [len(one[0]) for one in grams]
        return pa.table({"doc_id": texts.column("doc_id"), "n_words": pa.array(counts, pa.int64()), "log_score": pa.array(sums, pa.float64())})

    scored = dealt.groupBy("place").cogroup(answered.groupBy("place")).applyInArrow(score, f"doc_id {kind}, n_words long, log_score double")
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).otherwise(F.lit(0.0))
    return scored.withColumn("mean_log_score", mean)
