"""Quality scores from random-indexing word vectors and a small neural network.

Every token has a sparse random index vector; a word's vector is the sum of
the index vectors around it over the whole corpus (random indexing), kept in
a table of ``BUCKETS`` hashed rows, so its size never grows with the corpus.
A document is the mean and the spread of its tokens' vectors, the likeness of
neighbouring tokens and its length. A two-layer network in numpy is trained on
at most ``TRAIN_ROWS`` labelled rows (those with the smallest hashes of their
id); a temperature fitted on rows kept out of the training calibrates its
probabilities.

Only the text is an input of a score. Labels are learned from rows whose
``crc32(doc_id) mod 3`` is not 1, the others are held out.

Defined results: null and empty texts get the score of the zero vector; a
doc_id with several labels counts with the smallest; null labels and null ids
are not learned from; without any label every score is 0.5, with labels of
one kind the share of that kind; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import free_tables, fresh, save_and_reload, text_bytes

BUCKETS = 1 << 15
DIM = 64
NONZERO = 4
REACH = 2
BLOCKS = 64
FAN_IN = 64
TRAIN_ROWS = 20_000
HIDDEN = 32
SEED = 20_24
CHUNK = 1 << 17
# letters (with all bytes of other scripts) or runs of other visible bytes
TOKENS = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+").findall


class TokenRows(dict):
    """The table row of each token, remembered for a bounded number of tokens."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        row = self[token] = xxhash.xxh32_intdigest(token) % BUCKETS
        return row


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every row's index vector."""
    draw = np.random.default_rng(SEED)
    places = draw.random((BUCKETS, DIM)).argpartition(NONZERO, axis=1)[:, :NONZERO]
    return places.astype(np.int64), draw.choice(np.array([-1.0, 1.0]), (BUCKETS, NONZERO))


def _token_chunks(texts: Iterator[bytes], rows: TokenRows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token rows of several texts in one array, and the length of each text, a bounded number at a time."""
    parts: list[np.ndarray] = []
    total = 0
    for text in texts:
        tokens = TOKENS(text)
        parts.append(np.fromiter(map(rows.__getitem__, tokens), np.int64, len(tokens)))
        total += len(tokens)
        if total >= CHUNK:
            yield np.concatenate(parts), np.array([len(p) for p in parts])
            parts, total = [], 0
    if parts:
        yield np.concatenate(parts), np.array([len(p) for p in parts])


def _add_contexts(table: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    document = np.repeat(np.arange(len(lengths)), lengths)
    for step in range(1, REACH + 1):
        together = document[step:] == document[:-step]
        left, right = tokens[:-step][together], tokens[step:][together]
        here, there = np.concatenate((left, right)), np.concatenate((right, left))
        # one pass over the table for all entries of a step
        spots = (here * DIM)[:, None] + places[there]
        table += np.bincount(spots.ravel(), weights=signs[there].ravel(), minlength=BUCKETS * DIM)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all table rows, from every text of ``docs``.

    Tasks add up their texts and emit the table in ``BLOCKS`` packed pieces;
    pieces are added up in levels of ``FAN_IN``, so no group holds more than
    that. Sums are of whole numbers and hence independent of the order.
    """
    width = BUCKETS * DIM // BLOCKS

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_tables()
        places, signs = index_vectors()
        table, rows, any_text = np.zeros(BUCKETS * DIM), TokenRows(), False
        for batch in batches:
            for tokens, lengths in _token_chunks((x.as_py() for x in batch.column(0)), rows):
                any_text = True
                _add_contexts(table, tokens, lengths, places, signs)
        if any_text:
            yield _pack(table.astype(np.int64).reshape(BLOCKS, width), range(BLOCKS), np.random.default_rng().integers(1 << 40))

    schema = "block int, salt long, packed binary"
    sums = docs.select(text_bytes().alias("text")).mapInArrow(tally, schema)
    sums = save_and_reload(sums, "word-sums")

    def add(pieces: pa.Table) -> pa.Table:
        total = sum(_unpack(x.as_py()) for x in pieces.column("packed"))
        return pa.Table.from_batches([_pack(total[None, :], [pieces.column("block")[0].as_py()], pieces.column("salt")[0].as_py())])

    groups = -(-sums.count() // BLOCKS)
    while groups > 1:
        groups = -(-groups // FAN_IN)
        place = F.pmod(F.xxhash64("salt", F.lit(groups)), F.lit(groups)).alias("salt")
        sums = sums.select("block", place, "packed").groupBy("block", "salt").applyInArrow(add, schema)
    table = np.zeros((BLOCKS, width))
    for row in sums.select("block", "packed").toLocalIterator():
        table[row.block] += _unpack(row.packed)
    return unit_vectors(table.reshape(BUCKETS, DIM))


def _pack(table: np.ndarray, blocks, salt: int) -> pa.RecordBatch:
    packed = [zlib.compress(row.astype("<i8").tobytes(), 1) for row in table]
    arrays = [pa.array(list(blocks), pa.int32()), pa.array([int(salt)] * len(packed), pa.int64()), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["block", "salt", "packed"])


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), "<i8")


def unit_vectors(contexts: np.ndarray) -> np.ndarray:
    """Per row the direction of its contexts plus that of its own index vector."""
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIM))
    np.put_along_axis(own, places, signs / np.sqrt(NONZERO), axis=1)
    norms = np.linalg.norm(contexts, axis=1, keepdims=True)
    return (own + contexts / np.maximum(norms, 1e-9)).astype(np.float32)


FEATURES = 2 * DIM + 4


def pooled(tokens: np.ndarray, lengths: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Feature rows of several texts: mean, spread, likeness and equality of neighbours, length."""
    out = np.zeros((len(lengths), FEATURES), np.float32)
    some = np.flatnonzero(lengths)
    if not len(some):
        return out
    starts = (np.cumsum(lengths) - lengths)[some]
    n = lengths[some][:, None].astype(np.float32)
    rows = vectors[tokens]
    mean = np.add.reduceat(rows, starts, axis=0) / n
    square = np.add.reduceat(rows * rows, starts, axis=0) / n
    alike = np.zeros(len(tokens), np.float32)
    alike[1:] = (rows[1:] * rows[:-1]).sum(axis=1) / 2
    alike[starts] = 0
    out[some, :DIM] = mean
    out[some, DIM : 2 * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[some, 2 * DIM] = np.add.reduceat(alike, starts) / n[:, 0]
    out[some, 2 * DIM + 1] = np.log1p(lengths[some])
    for step in (1, 2):
        same = np.zeros(len(tokens), np.float32)
        same[step:] = tokens[step:] == tokens[:-step]
        for offset in range(step):
            same[np.minimum(starts + offset, len(same) - 1)] = 0
        out[some, 2 * DIM + 1 + step] = np.add.reduceat(same, starts) / n[:, 0]
    return out


def document_features(docs: DataFrame, vectors: np.ndarray, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` and ``features``, packed 32-bit floats, per row."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    text, features = fresh("text", "features")
    picked = docs.select(*[F.col(f"`{name}`") for name in keep], text_bytes().alias(text))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = TokenRows()
        for batch in batches:
            found = [row.astype("<f4").tobytes() for x in _pooled_texts(batch.column(len(keep)), shared.value, rows) for row in x]
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, features])

    kept = "".join(f"`{name}` {docs.schema[name].dataType.simpleString()}, " for name in keep)
    return picked.mapInArrow(compute, f"{kept}{features} binary").withColumnRenamed(features, "features")


def _pooled_texts(texts: pa.Array, vectors: np.ndarray, rows: TokenRows) -> Iterator[np.ndarray]:
    """The feature rows of all texts, in order, a bounded number of tokens at a time."""
    for tokens, lengths in _token_chunks((x.as_py() or b"" for x in texts), rows):
        for low, high in _spans(lengths):
            first = int(lengths[:low].sum())
            yield pooled(tokens[first : first + int(lengths[low:high].sum())], lengths[low:high], vectors)


def _spans(lengths: np.ndarray, most: int = 1 << 12) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``most`` tokens together, whose vectors stay in the cache, or one text."""
    low = total = 0
    for i, n in enumerate(lengths.tolist()):
        if total + n > most and i > low:
            yield low, i
            low, total = i, 0
        total += n
    yield low, len(lengths)


@dataclass
class Network:
    """Standardised inputs, one hidden layer, and a temperature for its logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def _constant(width: int, share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    zero = np.zeros((width, 1))
    return Network(np.zeros(width), np.ones(width), zero, np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def train(x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4) -> Network:
    """Fit by Adam on nine tenths of the rows; calibrate on the last tenth."""
    if len(y) == 0 or y.min() == y.max():
        return _constant(x.shape[1] if x.ndim == 2 else FEATURES, float(y.mean()) if len(y) else 0.5)
    draw = np.random.default_rng(SEED)
    order = draw.permutation(len(y))
    cut = max(1, len(y) // 10)
    held, used = order[:cut], order[cut:]
    mean, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
    net = Network(mean, scale, draw.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, 0.1, HIDDEN), 0.0)
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        shuffled = draw.permutation(used)
        for at in range(0, len(shuffled), batch):
            rows = shuffled[at : at + batch]
            inputs = (x[rows] - mean) / scale
            before = inputs @ weights[0] + weights[1]
            hidden = np.maximum(before, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3][0], -30, 30)))
            off = (p - y[rows]) / len(rows)
            back = np.outer(off, weights[2]) * (before > 0)
            slopes = [inputs.T @ back + decay * weights[0], back.sum(axis=0), hidden.T @ off + decay * weights[2], np.array([off.sum()])]
            step += 1
            for w, m, v, g in zip(weights, first, second, slopes):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(weights[3][0])
    net.temperature = fit_temperature(net.logit(x[held]), y[held])
    return net


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, on a logarithmic grid."""
    grid = np.geomspace(0.25, 8, 121)

    def loss(t: float) -> float:
        z = logits / t
        return float((np.logaddexp(0, z) - y * z).mean())

    return float(min(grid, key=loss))


def remainder(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3))


def training_labels(labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id`` and ``label`` of at most ``train_rows`` labelled ids outside the held-out third."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder() != 1))
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Network:
    """A network from rows of ``doc_id``, ``features`` and ``label``; of repeated ids one row is used."""
    chosen = rows.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).collect()
    if not chosen:
        return _constant(FEATURES, 0.5)
    x = np.stack([np.frombuffer(row.features, "<f4") for row in chosen]).astype(float)
    return train(x, np.array([float(row.label) for row in chosen]))


def score_features(features: DataFrame, network: Network, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` and ``score``."""
    shared = features.sparkSession.sparkContext.broadcast(network)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([np.frombuffer(value.as_py(), "<f4") for value in batch.column(len(keep))])
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(shared.value.probability(x.astype(float)))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "score"])

    kept = "".join(f"`{name}` {features.schema[name].dataType.simpleString()}, " for name in keep)
    return features.select(*keep, "features").mapInArrow(compute, f"{kept}score double")


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    features = save_and_reload(document_features(docs, word_vectors(docs), ("doc_id",)), "features")
    network = fit(features.join(training_labels(labels, train_rows=train_rows), "doc_id"), train_rows)
    scored = score_features(features, network, ("doc_id",))
    return scored.select(
        "doc_id",
        F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with their columns.

    Scores are made where the row is, so no join brings them together.
    """
    vectors = word_vectors(docs)
    # at most train_rows ids: that bound allows the broadcast, and only their texts are pooled here
    chosen = docs.select("doc_id", "text").join(F.broadcast(training_labels(labels, train_rows=train_rows)), "doc_id")
    network = fit(document_features(chosen, vectors, ("doc_id", "label")), train_rows)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))
    text = docs.columns.index("text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = TokenRows()
        table, model = shared.value
        for batch in batches:
            scores = [model.probability(x.astype(float)) for x in _pooled_texts(batch.column(text).cast(pa.binary()), table, rows)]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *scores]) >= least))

    return docs.mapInArrow(compute, docs.schema)
