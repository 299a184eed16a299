"""WARC records in ZIP packages: written by Spark tasks, read back by ranges and never extracted.

A package is a ZIP file with stored (uncompressed) members: ``archive/*.warc.gz``, one gzip member for
each record, and ``indexes/index.cdxj``, one line for each record. The reader takes a package's tail to
find the central directory (the ZIP64 one if there is one), places the members by their local headers,
reads the index, and then fetches runs of neighbouring records, each run by one range read. The runs are
dealt out by a shuffle of small rows, so a single large package is read by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wintide.llm.shared import fresh_folder, staged

RUN_BYTES = 4 << 20
RUN_RECORDS = 2_000
INDEX_BLOCK = 4 << 20
INDEX_NAME = "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Member(NamedTuple):
    """A stored member: where its bytes lie in the package."""

    name: str
    start: int
    size: int


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _range(file, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) != size:
        raise ValueError("the package ends early")
    return data


def zip_members(file, size: int) -> list[Member]:
    """Members by the central directory, read with a few range reads; ZIP64 fields are followed."""
    tail_start = max(0, size - 65_557 - 20)
    tail = _range(file, tail_start, size - tail_start)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("not a ZIP package")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        (end64,) = struct.unpack("<Q", tail[at - 12 : at - 4])
        head = _range(file, end64, 56)
        if head[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is not where its locator says")
        count, length, start = struct.unpack("<QQQ", head[32:56])
    directory, members, p = _range(file, start, length), [], 0
    for _ in range(count):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is broken")
        (method,) = struct.unpack("<H", directory[p + 10 : p + 12])
        packed, whole, names, extras, notes = struct.unpack("<IIHHH", directory[p + 20 : p + 34])
        (local,) = struct.unpack("<I", directory[p + 42 : p + 46])
        name = directory[p + 46 : p + 46 + names].decode()
        extra, q = directory[p + 46 + names : p + 46 + names + extras], 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[q : q + 4])
            if kind == 1:  # the fields that did not fit, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[q + 4 : q + 4 + n // 8 * 8]))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            q += 4 + n
        p += 46 + names + extras + notes
        if name.endswith("/"):
            continue
        if method != 0 or packed != whole:
            raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
        names, extras = struct.unpack("<HH", _range(file, local + 26, 4))
        members.append(Member(name, local + 30 + names + extras, whole))
    return members


def _block(page_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page_bytes}\r\n\r\n".encode()


def _record(kind: str, key: str, url: str, digest: str, refers: str | None, payload: bytes, size: int) -> bytes:
    block = _block(size) + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{key}>", f"WARC-Date: {DATE}"]
    if url:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def write_packages(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """One WARC record for each row, in packages below ``folder``; returns their manifest (a small table).

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, that with the smallest key is a
    response and the others revisit it; all other rows are responses. A null payload is empty. A null key
    counts as larger than any; if all keys of a payload are null, all are responses, and so are repeated
    rows of the smallest key. An empty table gives no package. Each task writes under a name of its own
    and reports it when it is done, so a task that is run again leaves a stray file and no wrong row.
    """
    keyed = pages.select(
        F.col(key).alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    first = (
        keyed.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    rows = keyed.join(first, "digest", "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "payload",
        "digest",
        F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_batch = next((b for b in batches if b.num_rows), None)
        if first_batch is None:
            return
        store, base = _opened(folder)
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        index, records, member = [], 0, "archive/data.warc.gz"
        with store.open_output_stream(f"{base}/{name}") as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(zipfile.ZipInfo(member), "w", force_zip64=True) as archive:
                    at = 0
                    for batch in _chained(first_batch, batches):
                        for k, u, body, hexed, refers in zip(*(c.to_pylist() for c in batch.columns)):
                            digest = base64.b32encode(bytes.fromhex(hexed)).decode()
                            kind = "response" if refers is None else "revisit"
                            data = _record(
                                kind, k or "", u or "", digest, refers, body if refers is None else b"", len(body)
                            )
                            archive.write(data)
                            index.append(json.dumps({"filename": member, "offset": at, "length": len(data)}))
                            at += len(data)
                            records += 1
                with package.open(zipfile.ZipInfo(INDEX_NAME), "w", force_zip64=True) as lines:
                    lines.write("".join(f"{x}\n" for x in index).encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64())], ["path", "records"]
        )

    return staged(rows.mapInArrow(write, "path string, records bigint"), "warc-manifest")


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def _index_lines(file, member: Member) -> Iterator[dict]:
    rest = b""
    for at in range(0, member.size, INDEX_BLOCK):
        *lines, rest = (rest + _range(file, member.start + at, min(INDEX_BLOCK, member.size - at))).split(b"\n")
        for line in lines:
            if b"{" in line:
                yield json.loads(line[line.index(b"{") :])
    if b"{" in rest:
        yield json.loads(rest[rest.index(b"{") :])


def _scanned(file, member: Member) -> Iterator[dict]:
    """Records of a member that no index lists, found by walking over its gzip members."""
    at, start, held = 0, 0, b""
    unpack = zlib.decompressobj(31)
    while at < member.size or held:
        if not held:
            held = _range(file, member.start + at, min(INDEX_BLOCK, member.size - at))
            at += len(held)
        unpack.decompress(held)
        held = b""
        if unpack.eof:
            held = unpack.unused_data
            end = at - len(held)
            yield {"filename": member.name, "offset": start, "length": end - start}
            start, unpack = end, zlib.decompressobj(31)


def record_runs(packages: DataFrame, path: str = "path") -> DataFrame:
    """Runs of neighbouring records: package, start of the run in the package, sizes of its records."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, inner = _opened(name)
                with store.open_input_file(inner) as file:
                    members = {m.name: m for m in zip_members(file, file.size())}
                    listed = [m for m in members.values() if m.name.startswith("indexes/") and ".cdx" in m.name]
                    archives = [m for m in members.values() if m.name.startswith("archive/")]
                    lines = (x for m in listed for x in _index_lines(file, m))
                    if not listed:
                        lines = (x for m in archives for x in _scanned(file, m))
                    start, end, sizes = 0, -1, []
                    for x in lines:
                        where = members.get(x["filename"]) or members[f"archive/{x['filename']}"]
                        at = where.start + int(x["offset"])
                        if sizes and (at != end or end - start >= RUN_BYTES or len(sizes) >= RUN_RECORDS):
                            yield _run(name, start, sizes)
                            sizes = []
                        if not sizes:
                            start = at
                        sizes.append(int(x["length"]))
                        end = at + int(x["length"])
                    if sizes:
                        yield _run(name, start, sizes)

    return packages.select(F.col(path).alias("path")).mapInArrow(plan, "path string, start bigint, sizes array<int>")


def _run(name: str, start: int, sizes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([start], pa.int64()), pa.array([sizes], pa.list_(pa.int32()))],
        ["path", "start", "sizes"],
    )


def parse_record(data: bytes) -> dict:
    """Header fields and payload of one gzip-packed record; a response's payload is held to its digest."""
    whole = zlib.decompress(data, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest and found != digest:
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not fit its digest")
        digest = found
    ident = lambda field: fields.get(field, "")[1:-1].removeprefix("urn:page:") or None
    return {
        "record_id": ident("WARC-Record-ID"),
        "record_type": fields["WARC-Type"],
        "target_uri": fields.get("WARC-Target-URI"),
        "payload_bytes": int(sizes[0]) if sizes else len(payload),
        "payload_digest": digest,
        "refers_to": ident("WARC-Refers-To"),
        "payload": payload,
    }


RECORD = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_packages(packages: DataFrame, path: str = "path", payloads: bool = True) -> DataFrame:
    """Every record of the packages named in a table, one row each.

    ``payload`` is the stored payload (empty for revisits), left out if ``payloads`` is false. Packages
    without an index are walked record by record to place them. No packages give no rows.
    """
    # a set number of tasks: the rows are small, and their bytes do not tell how much each one reads
    width = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = record_runs(packages, path).repartition(width, "path", "start")
    schema = pa.schema([f for f in RECORD if payloads or f.name != "payload"])
    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                store, inner = _opened(name)
                with store.open_input_file(inner) as file:
                    data = _range(file, start, sum(sizes))
                rows, at = [], 0
                for size in sizes:
                    row = parse_record(data[at : at + size])
                    rows.append({f.name: row[f.name] for f in schema})
                    at += size
                yield pa.RecordBatch.from_pylist(rows, schema)

    return runs.mapInArrow(fetch, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))


def through_packages(pages: DataFrame, payloads: bool = False, **options) -> DataFrame:
    """Writes all pages to packages in the shared folder and reads the records back."""
    folder = fresh_folder(pages.sparkSession, "warc")
    return read_packages(write_packages(pages, folder, **options), payloads=payloads)
