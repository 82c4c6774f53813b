"""Spelling variants by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. The longer word (either, if equally long) contributes two
disjoint chunks, its halves; the other contributes positional grams of the
chunks' lengths. One edit leaves one of the two chunks whole, and moves it by
one place at most: not at all between words of one length, at most one place to
the left in the shorter word. Only grams at such places can join, so only those
are made. The damaged half in turn keeps one of its own halves, which is part
of the join key too: a group then holds words that share about three quarters
of their code points, so groups of a common beginning or ending do not meet.
Joined pairs are verified by their edit distance.

Every word has a form, the near word that occurs most often, if it occurs at
least ``ratio`` times as often. Forms are followed by pointer doubling: each
step multiplies the count by ``ratio``, so the largest count bounds the steps.

Defined results: a null text has no words; a null doc_id counts as empty text
where an id is hashed; rows that repeat are counted each; ties between forms go
to the smallest in code-point order; an empty table gives no rows. Columns of
the input other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import save_and_reload

RUNS = "[A-Za-zÀ-ÿ]+"
DAMAGE = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5


def damaged_words(docs: DataFrame, damage: int = DAMAGE, least_length: int = LEAST_LENGTH) -> DataFrame:
    """One row ``word`` per run of letters that has ``least_length`` code points in the end.

    A run whose hash with its document's id is a multiple of ``damage`` loses
    the code point at the hash's remainder by its length.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(RUNS), F.lit(0))).alias("run"))
    long_runs = runs.where(F.length("run") >= least_length).select(
        "id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run")
    )
    hashed = long_runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    shortened = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % damage == 0, shortened).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= least_length)


def word_counts(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that occur ``least_count`` times or more."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _cut(word: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` (from 0) up to ``end``; none if that is an empty range."""
    return F.substring(word, start + 1, F.greatest(end - start, F.lit(0)))


def _keys(word: Column, length: Column, shift: int) -> Column:
    """Join keys of a word as partner of words with ``length`` code points.

    ``shift`` is how many code points fewer the word itself has. A key names
    the length, which chunk is whole, which half of the damaged chunk is whole,
    and both texts.
    """
    middle = F.floor(length / 2).cast("int")
    early, late = F.floor(middle / 2).cast("int"), middle + F.floor((length - middle) / 2).cast("int")
    zero, end = F.lit(0), length - shift

    def key(which: int, chunk: tuple[Column, Column], half: tuple[Column, Column]) -> Column:
        return F.xxhash64(length, F.lit(which), _cut(word, *chunk), F.lit("|"), _cut(word, *half))

    return F.array(
        # the first chunk is whole; of the second, its first or its second half
        key(0, (zero, middle), (middle, late)),
        key(1, (zero, middle), (late - shift, end)),
        # the second chunk is whole; of the first, its first or its second half
        key(2, (middle - shift, end), (zero, early)),
        key(3, (middle - shift, end), (early - shift, middle - shift)),
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs ``a``, ``b`` of words that one edit separates, in both orders, with ``n`` of ``b``.

    ``words`` has distinct ``word`` values with their ``n``. Keys are hashes;
    what they join by accident fails the verification. Words shorter than four
    code points would have empty chunks and meet in large groups, but still
    give right results.
    """
    length = F.length("word")
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(_keys(F.col("word"), length, 0)).alias("key"))
    own, longer = _keys(F.col("word"), length, 0), _keys(F.col("word"), length + 1, 1)
    grams = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.explode(F.concat(own, longer)).alias("key"))
    # pairs of one length meet twice, once in either order
    meet = (F.length("a") > F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    pairs = chunks.join(grams, "key").where(meet & (F.levenshtein("a", "b", 1) == 1))
    both = F.explode(F.array(F.struct("a", "b", F.col("b_n").alias("n")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("n"))))
    return pairs.select("a", "a_n", "b", "b_n").distinct().select(both.alias("pair")).select("pair.*")


def word_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word: ``word``, ``n``, ``n_near``, ``form`` and ``form_n`` (null without a form)."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("b").alias("word"))).alias("best")
    near = near_pairs(words).groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best)
    formed = -F.col("best.rank") >= ratio * F.col("n")
    return words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("best.word")).alias("form"),
        F.when(formed, -F.col("best.rank")).alias("form_n"),
    )


def with_roots(formed: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Adds ``root``, the last word that forms lead to, itself without a form.

    Each round doubles how far every pointer reaches. A path of forms gains a
    factor ``ratio`` a step, hence cannot be longer than the logarithm of the
    largest over the smallest count.
    """
    if ratio < 2:
        raise ValueError("forms of a ratio below two could lead in circles")
    pointers = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    least, most = formed.agg(F.min("n"), F.max("n")).first()
    steps = int(math.log(most / least, ratio) + 1e-9) if most else 0
    for _ in range(max(0, steps - 1).bit_length()):
        pointers = save_and_reload(pointers, "spelling-roots")
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        pointers = pointers.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
    return formed.join(pointers, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_groups(
    docs: DataFrame,
    damage: int = DAMAGE,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """Per word of ``docs``: ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``."""
    words = save_and_reload(word_counts(damaged_words(docs, damage, least_length), least_count), "spelling-words")
    formed = save_and_reload(word_forms(words, ratio), "spelling-forms")
    return with_roots(formed, ratio).select("word", "form", "root", "n", "n_near", "form_n")
