"""What workers keep between tasks."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pytest

from tallywatch.llm import bpe, common, quality_rules
from tallywatch.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def description():
    return Path(vocabulary_path()).read_text(encoding="utf-8")


def test_a_remembered_chunk_is_one_string_and_decodes_to_itself(description):
    codec = bpe.Codec(description)
    special = next(iter(codec.special), "")
    for text in ("one two  three\n\nfour", " héllo wörld, it's 2024 ", f"a{special}b {special}", "日本語 emoji 🙂🙂", ""):
        joined, back = codec.round_trip(text)
        assert back == text == codec.decode(codec.encode(text).tolist())
        assert joined == codec.joined(text) == ",".join(map(str, codec.encode(text).tolist()))
    assert codec.known and all(type(value) is str for value in codec.known.values())


def test_a_chunk_that_decodes_to_other_bytes_keeps_them(description):
    codec = bpe.Codec(description)
    number = codec.byte_ids[ord("q")]
    codec.strings[number] = b"\xff"
    assert codec.round_trip("q q") == (codec.joined("q q"), codec.decode(codec.encode("q q").tolist()))
    assert codec.round_trip("q")[1] == "\ufffd"


def test_a_task_of_another_stage_frees_the_codec(description):
    first = bpe._codec(description)
    assert bpe._codec(description) is first
    texts = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([b"some words"])], names=["lang", "text"])
    assert list(quality_rules._tally(iter([texts])))
    assert not common._TABLES and bpe._codec(description) is not first
