"""WARC archives packed in ZIP files: written by executors, read back by ranges without extraction.

Each ZIP file holds, as *stored* (uncompressed) members, WARC files below ``archive/`` whose records are gzip members of
their own (or plain) and indexes of their places below ``indexes/``, lines of key, time and JSON with filename, offset
and length (CDXJ, also as gzip), so that any record is a range of the ZIP file. The reader parses the end record, the
ZIP64 end record and the central directory, finds all archive members and their entries in any index, groups
neighbouring records into ranges, deals the ranges out to all tasks, and reads each range alone. An archive member
without entries is an error, as are compressed archive members; nothing is left out silently.

Files go to the shared folder; each attempt of a task writes under names of its own, and only what a finished
task reports is read, so lost executors leave nothing but files that no one lists.

Records with equal payloads (by SHA-1) are revisits of the one with the largest id. Digests are found by a partial
aggregate, and the join that brings them to the payloads is one that adaptive execution can split, so a payload in
a third of all rows is no hot spot.

Defined results: a null payload is empty; a null id is below all others; rows that repeat the largest id of a
payload are all responses; a null address becomes a name made of the id; control characters in an address are
percent-encoded; an empty table gives no files and an empty result; other columns are ignored."""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace

#: Bytes of compressed records in one archive, and of one range that is read at once; a larger record stands alone.
ARCHIVE_BYTES, RANGE_BYTES = 64 << 20, 4 << 20
DATE = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
URN = "urn:sonarloom:page:"


def record(page: int | None, url: str | None, payload: bytes, digest: str, of: int | None, revisit: bool, date: dt.datetime = DATE) -> bytes:
    """A WARC record as a gzip member; a revisit has the response's HTTP head alone."""
    name = "none" if page is None else str(page)
    url = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or f"{URN}{name}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{name}>",
        f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{'none' if of is None else of}>"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def sort_key(url: str) -> str:
    """The host's names in reverse, then the path: the key that index lines are sorted by."""
    host, _, path = re.sub("^[a-z]+://", "", url.lower()).partition("/")
    return f"{','.join(reversed(host.split('.')))})/{path}".replace(" ", "%20")


def write_zip(sink, data: list[bytes], zip64: bool = False, about: list[dict[str, str]] | None = None) -> int:
    """Write one archive of records with its index; the bytes of records. ``about`` has the url and digest of each;
    ``zip64`` forces the large form."""
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=zip64) as f:
            for r in data:
                f.write(r)
        at, lines = 0, []
        for r, told in zip(data, about or [{}] * len(data)):
            entry = {**told, "filename": DATA.rpartition("/")[2], "offset": str(at), "length": str(len(r))}
            lines.append(f"{sort_key(told.get('url', ''))} {DATE:%Y%m%d%H%M%S} {json.dumps(entry)}\n")
            at += len(r)
        with z.open(zipfile.ZipInfo(INDEX), "w", force_zip64=zip64) as f:
            f.write("".join(sorted(lines)).encode())
    return at


def _tail(source, size: int) -> tuple[bytes, int]:
    n = min(size, 65_557 + 20)
    return source.read_at(n, size - n), size - n


def directory(source, size: int) -> dict[str, tuple[int, int, int]]:
    """Name -> (local header's offset, stored size, method) of every member, from the central directory."""
    tail, base = _tail(source, size)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut short")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        if at < 20 or tail[at - 20 : at - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (end64,) = struct.unpack_from("<Q", tail, at - 12)
        end = source.read_at(56, end64)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end, 32)
    central, members, at = source.read_at(length, start), {}, 0
    for _ in range(count):
        if central[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, n, extra, comment, local = struct.unpack_from("<10xH8xIIHHH8xI", central, at)
        name = central[at + 46 : at + 46 + n].decode()
        more, k = central[at + 46 + n : at + 46 + n + extra], 0
        while k + 4 <= len(more):
            tag, m = struct.unpack_from("<HH", more, k)
            if tag == 1:
                # Only the fields that don't fit stand here, in this order.
                wide = iter(struct.unpack_from(f"<{m // 8}Q", more, k + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            k += 4 + m
        members[name] = (local, packed, method)
        at += 46 + n + extra + comment
    return members


def place(source, member: tuple[int, int, int]) -> tuple[int, int]:
    """Offset and size of a stored member's bytes in the file."""
    local, size, method = member
    if method:
        raise ValueError("the member is compressed; only stored ones can be read by ranges")
    head = source.read_at(30, local)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    n, extra = struct.unpack_from("<HH", head, 26)
    return local + 30 + n + extra, size


def entries(source, members: dict[str, tuple[int, int, int]]) -> dict[str, list[tuple[int, int]]]:
    """Archive member -> (offset, length) of its records in order, from all indexes."""
    out: dict[str, list[tuple[int, int]]] = {}
    for name, member in members.items():
        if not (name.startswith("indexes/") and name.removesuffix(".gz").endswith((".cdx", ".cdxj"))):
            continue
        at, n = place(source, member)
        data = source.read_at(n, at)
        for line in (gzip.decompress(data) if name.endswith(".gz") else data).decode().splitlines():
            if "{" in line and not line.startswith("!"):
                entry = json.loads(line[line.index("{") :])
                out.setdefault("archive/" + entry["filename"].removeprefix("archive/"), []).append((int(entry["offset"]), int(entry["length"])))
    return {name: sorted(set(places)) for name, places in out.items()}


def ranges(source, size: int, most: int = RANGE_BYTES) -> Iterator[tuple[int, int]]:
    """(offset, bytes) in the file of runs of whole records, from the index entries of every archive member."""
    members = directory(source, size)
    known = entries(source, members)
    for name in members:
        if not (name.startswith("archive/") and name.endswith((".warc.gz", ".warc"))):
            continue
        start, n = place(source, members[name])
        if n and name not in known:
            raise ValueError(f"no index has entries for {name}")
        first = last = 0
        for a, length in known.get(name, ()):
            if last > first and (a != last or a + length - first > most):
                yield start + first, last - first
                first = a
            elif last == first:
                first = a
            last = a + length
        if last > first:
            yield start + first, last - first


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of each record in a range: gzip members, or plain ones."""
    while data:
        if data[:2] == b"\x1f\x8b":
            z = zlib.decompressobj(wbits=31)
            raw = z.decompress(data) + z.flush()
            data, plain = z.unused_data, False
        else:
            raw, plain = data, True
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        if plain:
            data = rest[len(block) + 4 :]
        http, _, payload = block.partition(b"\r\n\r\n")
        fields["http-length"] = next((x[16:] for x in http.decode().split("\r\n") if x.lower().startswith("content-length: ")), str(len(payload)))
        yield fields, payload


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", payload: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all rows; a row per archive: path, bytes. Payloads of under ``min_bytes`` are never revisits."""
    workspace.small_batches(pages.sparkSession, 500)
    # An empty binary for null; text as UTF-8.
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).cast("string").alias("url"), body.alias("body")).withColumn("sha", F.sha1("body"))
    largest = rows.where(F.octet_length("body") >= min_bytes).groupBy("sha").agg(F.max("page").alias("largest"), F.lit(True).alias("known"))
    named = rows.join(largest, "sha", "left").select(
        "page", "url", "body", "sha", "largest", (F.col("known").isNotNull() & ~F.col("page").eqNullSafe(F.col("largest"))).alias("again")
    )

    def run(batches):
        store, top = fs.FileSystem.from_uri(folder)
        kept, told, size = [], [], 0

        def flush():
            path = f"{top}/{uuid.uuid4().hex}.zip"
            store.create_dir(top, recursive=True)
            with store.open_output_stream(path) as sink:
                write_zip(sink, kept, about=told)
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": pa.array([store.get_file_info(path).size], pa.int64())})

        for b in batches:
            for page, u, data, sha, of, again in zip(*(c.to_pylist() for c in b.columns)):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                r = record(page, u, data, digest, of, again)
                if kept and size + len(r) > archive_bytes:
                    yield flush()
                    kept, told, size = [], [], 0
                kept.append(r)
                told.append({"url": u or "", "digest": f"sha1:{digest}"})
                size += len(r)
        if kept:
            yield flush()

    return workspace.materialize(named.mapInArrow(run, "path string, bytes bigint"), "archives")


PAGES = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"


def read_archives(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """A row per record of the archives listed in ``path`` and ``bytes``. Payloads are checked against their
    digests; they are returned only if asked for, and a revisit has none."""
    spark = archives.sparkSession
    total = archives.agg(F.sum("bytes")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, total // (16 * RANGE_BYTES))

    def locate(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_file(path) as source:
                    found = list(ranges(source, size))
                yield pa.RecordBatch.from_pydict({"path": [path] * len(found), "at": pa.array([a for a, _ in found], pa.int64()), "n": pa.array([n for _, n in found], pa.int64())})

    def read(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        number = lambda s: None if s in (None, f"<{URN}none>") else int(s[len(URN) + 1 : -1])
        for b in batches:
            for path, at, n in zip(*(c.to_pylist() for c in b.columns)):
                with store.open_input_file(path) as source:
                    data = source.read_at(n, at)
                out = []
                for f, payload in records(data):
                    digest, kind = f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"]
                    if kind == "response" and digest_of(payload) != digest:
                        raise ValueError(f"{f['WARC-Record-ID']} in {path}: the payload doesn't have its digest")
                    out.append((number(f["WARC-Record-ID"]), int(f["http-length"]), digest, kind, number(f.get("WARC-Refers-To")), f["WARC-Target-URI"], payload if payloads and kind == "response" else None))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in PAGES.split(", ")])

    found = archives.select("path", "bytes").repartition(spark.sparkContext.defaultParallelism).mapInArrow(locate, "path string, at bigint, n bigint")
    return found.repartition(int(parts)).mapInArrow(read, PAGES)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace.new_folder(spark, "warc")
    archives = write_archives(workspace.table(spark, sf_dir, "pages"), folder)
    return read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base 32 of the digest: groups of five bits from blocks of five hexadecimal digits.
_BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '')"
ORACLE = f"""WITH d AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS s, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM d"""
