"""WARC archives, Zstandard-compressed record by record with an embedded dictionary.

An archive begins with a skippable frame (0x184D2A5D) that holds the dictionary; every record is a
frame of its own. The dictionary is built from a bounded sample of the archived payloads. Of
records with the same payload, the one with the largest page id carries it, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import hash_share
from newsloom.llm.files import codec, create, open_stream, train_dictionary
from newsloom.session import broadcast_if_small, shared_dir, stage

DICTIONARY_FRAME = 0x184D2A5D
_ZSTD_FRAME = struct.pack("<I", 0xFD2FB528)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the name space of URLs


def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {url}')}>"


def _one_line(value: str) -> str:
    """A header value: control characters in percent form."""
    return re.sub(r"[\x00-\x1F\x7F]", lambda m: f"%{ord(m[0]):02X}", value)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                revisit: bool, date: str) -> bytes:
    """A response, or a revisit that carries the HTTP header alone.

    A null page id or URL leaves its field out.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, url)),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if revisit:
        fields.append(("WARC-Profile", _PROFILE))
        if refers_to is not None:
            fields.append(("WARC-Refers-To-Page-ID", str(refers_to)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "replace") + block + b"\r\n\r\n"


def read_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record, one record in memory at a time."""
    with open_stream(path) as raw:
        mark = raw.read(8)
        dictionary, rest = b"", mark
        if len(mark) == 8 and struct.unpack("<II", mark)[0] == DICTIONARY_FRAME:
            dictionary, rest = raw.read(struct.unpack("<II", mark)[1]), b""
            if dictionary.startswith(_ZSTD_FRAME):
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
        stream = codec(dictionary, 3)[1].stream_reader(_Joined(rest, raw), read_across_frames=True)
        text = _Joined(b"", stream)
        while head := text.until(b"\r\n\r\n"):
            lines = head.decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no record where one should begin in {path}")
            fields = dict(line.split(": ", 1) for line in lines[1:] if line)
            block = text.read(int(fields["Content-Length"]))
            if len(block) < int(fields["Content-Length"]) or text.read(4) != b"\r\n\r\n":
                raise ValueError(f"a record breaks off in {path}")
            yield fields, block


class _Joined:
    """A stream with some bytes put back before it; reads in full and up to a mark."""

    def __init__(self, first: bytes, stream):
        self.held, self.stream = first, stream

    def read(self, n: int = -1) -> bytes:
        parts, have = [self.held], len(self.held)
        while n < 0 or have < n:
            more = self.stream.read(1 << 16 if n < 0 else max(n - have, 1 << 16))
            if not more:
                break
            parts.append(more)
            have += len(more)
        data = b"".join(parts)
        n = len(data) if n < 0 else n
        self.held = data[n:]
        return data[:n]

    def until(self, mark: bytes) -> bytes:
        while (at := self.held.find(mark)) < 0:
            more = self.stream.read(1 << 16)
            if not more:
                if self.held.strip():
                    raise ValueError("a record breaks off")
                return b""
            self.held += more
        head, self.held = self.held[:at], self.held[at + len(mark):]
        return head


def write_archives(
    pages: DataFrame, folder: str, html: str = "html", url: str = "url", id_col: str = "page_id",
    min_revisit_bytes: int = 0, sample_pages: int = 500, sample_bytes: int = 65_536, dictionary_bytes: int = 110_000,
    level: int = 3, max_file_bytes: int = 1 << 30, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of ``pages`` and return the archives: ``path, n_records, n_bytes``.

    The payload is the page in UTF-8, empty for null. Payloads of ``min_revisit_bytes`` or more that
    repeat are stored once, with the largest page id; if rows repeat that id too, all of these are
    responses. A null page id is below all others. The dictionary is trained on about
    ``sample_pages`` pages, chosen by a hash, of which at most ``sample_bytes`` each; with too few of
    them the archives have none. An empty table gives no archives. Further columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    repeated = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("sha").agg(
        F.count("*").alias("n"), F.max("id").alias("first_id")).where("n > 1").select("sha", "first_id")
    repeated = broadcast_if_small(stage(repeated, "repeated-payloads"))
    kept = float(sample_pages) / max(1, rows.count()) * float(1 << 32)
    samples = rows.where((hash_share("id") < kept) & (F.octet_length("payload") > 0)).select(
        F.substring("payload", 1, sample_bytes).alias("p")).limit(2 * sample_pages)
    dictionary = train_dictionary([bytes(r.p) for r in samples.collect()], dictionary_bytes)
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)
    marked = rows.join(repeated.withColumn("repeated", F.lit(True)), "sha", "left").select(
        "id", "url", "payload", "sha", "first_id",
        (F.coalesce(F.col("repeated"), F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first_id"))).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress, file, done = codec(shared.value, level)[0].compress, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if file is None:
                    path, file = create(folder, ".warc.zst")
                    head = struct.pack("<II", DICTIONARY_FRAME, len(shared.value)) + shared.value if shared.value else b""
                    file.write(head)
                    n, size = 0, len(head)
                digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                frame = compress(make_record(row["id"], row["url"], row["payload"], digest, row["first_id"], row["revisit"], date))
                file.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= max_file_bytes:
                    file.close()
                    done.append((path, n, size))
                    file = None
        if file is not None:
            file.close()
            done.append((path, n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["path", "n_records", "n_bytes"])

    return stage(marked.mapInArrow(write, "path string, n_records long, n_bytes long"), "warc-files")


def read_archives(archives: DataFrame, id_col: str = "page_id") -> DataFrame:
    """A row per record, archives one task each. A response whose payload does not fit its digest is an error."""
    schema = pa.schema([(id_col, pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(fields: dict, name: str) -> int | None:
            return int(fields[name]) if name in fields else None

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for fields, block in read_records(path):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and (
                            size != len(payload) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"{fields['WARC-Record-ID']} in {path} is damaged")
                    rows.append((number(fields, "WARC-Page-ID"), fields.get("WARC-Target-URI"), size, digest,
                                 fields["WARC-Type"], number(fields, "WARC-Refers-To-Page-ID")))
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    n_files = max(1, archives.count())
    return archives.select("path").repartition(n_files).mapInArrow(
        read, f"`{id_col}` long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op1_warc(pages: DataFrame) -> DataFrame:
    archives = write_archives(pages, shared_dir(pages.sparkSession, "warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id FROM pages
), b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    lpad(bin(strpos('0123456789abcdef', substr(h, CAST(i AS BIGINT), 1)) - 1), 4, '0')), '') AS bits FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
    + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
    + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INT) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to
FROM b
"""
