from __future__ import annotations

import base64
import hashlib
import io
import struct
import zipfile

import pytest

from wintide.llm import warc_zip
from wintide.llm.shared import fresh_folder


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows, least=0):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = min(same) if same else None
        revisit = len(data) >= least and first is not None and page != first
        out.append(
            (page, len(data), digest(data), "revisit" if revisit else "response", first if revisit else None)
        )
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/é\r\nx", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (5, "u", "z" * 300_000),
    (6, "u", "\r\n\r\nWARC/1.1"), (4, "u", "<p>é</p>"), (None, "u", "<p>é</p>"), (None, "u", "alone"), (None, "v", "alone"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(
        [(*r, 1) for r in ROWS], "page_id bigint, url string, html string, digest int"
    ).repartition(3)
    found = warc_zip.through_packages(pages, payloads=True, min_revisit_bytes=least).collect()
    got = []
    for r in found:
        page = int(r["record_id"]) if r["record_id"] else None
        refers = int(r["refers_to"]) if r["refers_to"] else None
        got.append((page, r["payload_bytes"], r["payload_digest"], r["record_type"], refers))
        assert digest(bytes(r["payload"])) == r["payload_digest"] or r["record_type"] == "revisit"
    assert sorted(got, key=str) == brute(ROWS, least)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc_zip.through_packages(pages).count() == 0


def test_packages_without_index_and_many_runs(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "INDEX_NAME", "other/list")
    pages = spark.createDataFrame([(n, "u", f"page {n} " * n) for n in range(300)], "page_id bigint, url string, html string")
    found = warc_zip.through_packages(pages).collect()
    assert sorted(int(r["record_id"]) for r in found) == list(range(300))


def test_zip64_directory():
    body, name = b"stored bytes", b"archive/a.warc.gz"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(body), len(body)) + body
    central = b"PK\x01\x02" + struct.pack(
        "<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 28, 0, 0, 0, 0, 0xFFFFFFFF
    )
    central += name + struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(local) + len(central), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = local + central + end64 + locator + end
    (member,) = warc_zip.zip_members(io.BytesIO(data), len(data))
    assert member.name == name.decode() and data[member.start : member.start + member.size] == body


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/x", "a" * 100)
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.zip_members(out, len(out.getvalue()))


def test_a_changed_payload_is_noticed():
    data = warc_zip._record("response", "1", "u", digest(b"other"), None, b"body", 4)
    with pytest.raises(ValueError, match="digest"):
        warc_zip.parse_record(data)


def test_folder_is_shared(spark):
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
