"""Byte-level BPE encoding and decoding with a given vocabulary.

A text is cut by the pattern of byte-level vocabularies; each piece starts as
one symbol per byte in a doubly linked list. Adjacent pairs wait in a priority
queue by merge rank, leftmost first; an entry whose pair has changed since is
stale and skipped. Decoding concatenates the bytes of the ids' vocabulary
strings and reads them as UTF-8, with U+FFFD for what is not.

The vocabulary file is read on the driver and broadcast; its size is fixed by
the file, not by the data. Pieces met before are looked up in a per-worker
table of bounded size.

Defined results: a null text counts as empty and has no ids; special tokens
standing in a text become their ids; texts are never cut short; an empty
table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import fresh, worker_table

# The pattern belongs to the vocabulary format: fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 300_000
LONGEST_REMEMBERED = 48


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary strings.

    Printable Latin-1 characters stand for themselves, all other bytes for
    the characters from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in plain]
    return letters | {chr(0x100 + i): b for i, b in enumerate(others)}


def _numbers(joined: str) -> np.ndarray:
    return np.fromstring(joined, np.int32, sep=",") if joined else np.zeros(0, np.int32)


class Remembered(dict):
    """Results of ``compute`` by text, in two generations of ``REMEMBERED`` at most.

    When the younger one is full it becomes the older one, whose results are
    taken over when they are met again; what was not met is forgotten.
    """

    def __init__(self, compute) -> None:
        super().__init__()
        self.compute = compute
        self.older: dict = {}

    def __missing__(self, text: str):
        result = self.older.get(text)
        if result is None:
            result = self.compute(text)
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[text] = result
        return result


class Codec:
    """Encodes and decodes with the vocabulary and merges of a tokenizer file."""

    def __init__(self, description: str) -> None:
        parsed = json.loads(description)
        letters = byte_letters()
        vocab, special = parsed["model"]["vocab"], parsed["added_tokens"]
        self.strings = {number: bytes(letters[c] for c in string) for string, number in vocab.items()}
        self.special = {token["content"]: token["id"] for token in special}
        self.strings |= {number: content.encode() for content, number in self.special.items()}
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        # by left id: right id -> (rank << 32 | merged id)
        self.merges: list[dict[int, int]] = [{} for _ in range(max(self.strings) + 1)]
        for rank, merge in enumerate(parsed["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocab[left]][vocab[right]] = rank << 32 | vocab[left + right]
        self.pieces = regex.compile(PATTERN).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self.space_before_blank = regex.compile(r" \s").search
        self.known = Remembered(self._chunk)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        ids, merges = [self.byte_ids[b] for b in piece], self.merges
        n = len(ids)
        # one symbol more at the end that merges with nothing
        ids.append(-1)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        # an entry is rank and place in one number, so the heap orders by both
        queue = []
        for at in range(n - 1):
            found = merges[ids[at]].get(ids[at + 1])
            if found is not None:
                queue.append(found >> 32 << 32 | at)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            at = entry & 0xFFFFFFFF
            own = ids[at]
            if own < 0:
                continue
            right = after[at]
            found = merges[own].get(ids[right])
            # stale: the pair here is not the one that was queued
            if found is None or found >> 32 != entry >> 32:
                continue
            ids[at] = merged = found & 0xFFFFFFFF
            ids[right] = -1
            after[at] = right = after[right]
            before[right] = at
            found = merges[merged].get(ids[right])
            if found is not None:
                heappush(queue, found >> 32 << 32 | at)
            left = before[at]
            if left >= 0:
                found = merges[ids[left]].get(merged)
                if found is not None:
                    heappush(queue, found >> 32 << 32 | left)
        return [i for i in ids if i >= 0]

    def _chunk(self, chunk: str) -> str | tuple[str, bytes]:
        """The joined ids of a chunk, and the bytes that they decode to unless those are its own."""
        pieces = self.pieces(chunk)
        if len(pieces) == 1:
            own = chunk.encode()
            ids = self.merge(own)
            joined, back = ",".join(map(str, ids)), b"".join([self.strings[i] for i in ids])
            return joined if back == own else (joined, back)
        found = [self.known[piece] for piece in pieces]
        joined = ",".join([one if type(one) is str else one[0] for one in found])
        if all(type(one) is str for one in found):
            return joined
        return joined, b"".join([piece.encode() if type(one) is str else one[1] for piece, one in zip(pieces, found)])

    def _chunks(self, text: str) -> tuple[list[str], list[str | tuple[str, bytes]]]:
        """The chunks of a text in order, and what is known of each.

        Where every space is followed by something visible, no piece of the
        pattern crosses the place before a space, so such texts are looked up
        by the stretch from one space to the next.
        """
        runs = self.split_special.split(text) if self.split_special else [text]
        known = self.known
        chunks: list[str] = []
        found: list[str | tuple[str, bytes]] = []
        for run in runs:
            if run in self.special:
                chunks.append(run)
                found.append(str(self.special[run]))
            elif run:
                if self.space_before_blank(run):
                    own = self.pieces(run)
                else:
                    first, *rest = run.split(" ")
                    own = [first] * bool(first) + [" " + x for x in rest]
                chunks += own
                found += [known[x] for x in own]
        return chunks, found

    def joined(self, text: str) -> str:
        """The ids of a text, joined by commas."""
        return ",".join([one if type(one) is str else one[0] for one in self._chunks(text)[1]])

    def round_trip(self, text: str) -> tuple[str, str]:
        """The joined ids of a text and the text that they decode to."""
        chunks, found = self._chunks(text)
        if set(map(type, found)) <= {str}:
            return ",".join(found), "".join(chunks)
        back = [chunk.encode() if type(one) is str else one[1] for chunk, one in zip(chunks, found)]
        return ",".join([one if type(one) is str else one[0] for one in found]), b"".join(back).decode("utf-8", "replace")

    def encode(self, text: str) -> np.ndarray:
        return _numbers(self.joined(text))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def _codec(description: str) -> Codec:
    """The worker's codec for this description, with the pieces it has met."""
    return worker_table(f"codec {sha256(description.encode()).hexdigest()}", lambda: Codec(description))


def _broadcast(docs: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row, ``ids`` (array of int) and ``n_tokens``, by the file ``vocabulary``."""
    shared = _broadcast(docs, vocabulary)
    (text,) = fresh("text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            ids = [codec.encode(value.as_py()) for value in batch.column(len(keep))]
            counts = np.array([len(x) for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int32), *ids])
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "ids", "n_tokens"])

    picked = docs.select(*[F.col(f"`{name}`") for name in keep], F.coalesce("text", F.lit("")).alias(text))
    kept = "".join(f"`{name}` {docs.schema[name].dataType.simpleString()}, " for name in keep)
    return picked.mapInArrow(compute, f"{kept}ids array<int>, n_tokens long")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids``; null ids decode to the empty text."""
    shared = _broadcast(encoded, vocabulary)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            texts = [codec.decode(ids.as_py() or ()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(compute, f"doc_id {kind}, text string")


def encoding_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, and SHA-256 of the joined ids and of the decoded text.

    The same encoding as ``encode_documents``, but ids stay in the task; the
    bytes of a chunk's vocabulary strings are put together when its ids are.
    """
    shared = _broadcast(docs, vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in batch.column(1):
                joined, back = codec.round_trip(text.as_py())
                counts.append(joined.count(",") + 1 if joined else 0)
                digests.append(sha256(joined.encode()).hexdigest())
                decoded.append(sha256(back.encode()).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias(fresh("text")[0]))
    return picked.mapInArrow(compute, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
