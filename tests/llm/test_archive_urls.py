"""Urls that carry line ends and fields of their own."""

from __future__ import annotations

from urllib.parse import unquote

import pytest

from tallywatch.llm import archive

ENDS = ["\r\n", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\u2028", "\u2029", "\x00"]
FORGED = ["X-Page-ID: 999", "WARC-Type: revisit", "WARC-Payload-Digest: sha1:AAAA", "Content-Length: 7", "X-Refers-To-Page-ID: 5"]


def test_forged_fields_stay_in_the_url(spark, tmp_path):
    rows = []
    for end in ENDS:
        for field in FORGED:
            rows.append((len(rows), f"http://a/{end}{field}{end}{end}<p>", f"<p>{len(rows) // 2}</p>"))
    rows += [(1000, None, None), (1001, "", ""), (1002, "http://é/%20 x", "ü")]
    archive.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"))
    got = {r.page_id: r for r in archive.parse_records(archive.read_records(spark, str(tmp_path / "a"))).collect()}
    assert sorted(got) == [row[0] for row in rows]
    last = {html or "": page for page, _, html in rows}
    for page, url, html in rows:
        found = got[page]
        assert found.record_type == ("response" if last[html or ""] == page else "revisit")
        assert found.refers_to == (None if found.record_type == "response" else last[html or ""])
        assert found.payload_bytes == len((html or "").encode())
        if page < 1000:
            assert unquote(found.url) == url


@pytest.mark.parametrize("character", archive.NOT_IN_FIELDS)
def test_every_such_character_is_encoded(character):
    assert archive.quote(character) != character
