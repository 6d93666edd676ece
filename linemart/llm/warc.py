"""WARC archives as a chunked record table.

A record is a run of rows (archive, record, copy, chunk, data, running): its bytes cut into chunks, numbered from 0, with
the SHA-1 of the payload so far in each. The data of a record's chunks, put together, are one gzip member that holds a
WARC/1.1 record. The writer cuts a payload through a view of it and the reader takes one chunk after another, so neither
makes a copy of a record. Of the records with equal payloads of at least `min_bytes` the one with the smallest page id is
a response; the others are revisit records (identical payload digest) without a payload, which refer to it.

Equal payloads meet as digests. Payloads move once, to the roles of their records, and the table is written in the
buckets of that exchange, so the reader finds each record's chunks in one place. What it returns is counted from the
bytes read; a record whose lengths or digests do not agree with its bytes is an error, unless `strict` is off.

Null payloads are empty. Rows that repeat page id and payload are of the same type (told apart as copies); a null page id
never is referred to. Line breaks and other control characters in a url are written percent-encoded. Other columns do not
matter, whatever their names. An empty table makes no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linemart.llm.shared import bucketed

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "archive int, record string, copy long, chunk int, data binary, running string"


def with_roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(record, page, url, payload, digest, refers_to) for each row: its name by id and SHA-1 (hexadecimal), and for revisits the response's id.

    The join is one that sorts, so its rows come out in the partitions of `record`.
    """
    bytes_of = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    named = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"), F.sha1(bytes_of).alias("digest"), F.octet_length(bytes_of).alias("size"))
    named = named.withColumn("record", F.concat(F.coalesce(F.col("page").cast("string"), F.lit("")), F.lit(":"), "digest"))
    large = named.filter((F.col("size") >= min_bytes) & F.col("page").isNotNull())
    first = large.groupBy("digest", "size").agg(F.min("page").alias("refers_to"), F.max("page").alias("last"))
    repeated = first.filter(F.col("last") > F.col("refers_to")).drop("last")
    again = large.select("record", "page", "digest", "size").join(repeated, ["digest", "size"]).filter("page > refers_to").select("record", "refers_to").distinct()
    return named.drop("size").join(again.hint("merge"), "record", "left")


def _header(fields: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields).encode()


def _safe(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url)


def _name(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record_parts(page, url: str | None, payload: pa.BinaryScalar | bytes, digest: str, refers_to, date: str) -> tuple[bytes, memoryview, bytes]:
    """What stands before a record's payload, the payload (empty for revisits), and what ends the record."""
    body = memoryview(payload)
    http = b"HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]) + b"\r\n"
    sent = body if refers_to is None else body[:0]
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _name(page)),
        ("WARC-Target-URI", _safe(url or "")),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([] if refers_to is None else [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)]),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(http) + len(sent))),
    ]
    return b"WARC/1.1\r\n" + _header(fields) + b"\r\n" + http, sent, b"\r\n\r\n"


def write_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, chunk_bytes: int = 1 << 20, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """The chunk table of one record for each row of pages; an archive is what one task writes."""
    rows = with_roles(pages, id_col, url_col, payload_col, min_bytes).select(
        F.spark_partition_id().alias("archive"), "record", F.monotonically_increasing_id().alias("copy"), "page", "url", "payload", "digest", "refers_to"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            archive, record, copy, page, url, digest, refers_to = (b.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 6, 7))
            payload = b.column(5).cast(pa.binary())
            held: list[tuple] = []
            size = 0
            for k in range(b.num_rows):
                whole = payload[k].as_buffer() if payload[k].is_valid else b""
                name = base64.b32encode(bytes.fromhex(digest[k])).decode()
                before, body, after = record_parts(page[k], url[k], whole, name, refers_to[k], date)
                sha, gz = hashlib.sha1(usedforsecurity=False), zlib.compressobj(1, zlib.DEFLATED, 31)
                cut = [body[a : a + chunk_bytes] for a in range(0, max(len(body), 1), chunk_bytes)]
                for n, c in enumerate(cut):
                    sha.update(c)
                    last = n == len(cut) - 1
                    parts = [before if n == 0 else b"", c, after if last else b""]
                    data = b"".join([*map(gz.compress, parts), gz.flush(zlib.Z_FINISH if last else zlib.Z_SYNC_FLUSH)])
                    held.append((archive[k], record[k], copy[k], n, data, sha.hexdigest()))
                    size += len(data)
                    if size > 4 * chunk_bytes:
                        yield _chunk_batch(held)
                        held, size = [], 0
            if held:
                yield _chunk_batch(held)

    return rows.mapInArrow(run, CHUNKS)


def _chunk_batch(held: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


class Reader:
    """Takes a record's chunks in order; keeps the head until it is complete, then digests and forgets."""

    def __init__(self) -> None:
        self.head, self.fields, self.http, self.left = b"", None, None, 0
        self.sha, self.size, self.sound, self.tail = hashlib.sha1(usedforsecurity=False), 0, True, b""
        self.gz, self.chunks = zlib.decompressobj(31), 0

    def take(self, chunk: int, packed, running: str) -> None:
        self.sound &= chunk == self.chunks
        self.chunks += 1
        try:
            data = self.gz.decompress(packed)
        except zlib.error:
            data, self.sound = b"", False
        body = memoryview(data)
        if self.http is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            then = self.head.find(b"\r\n\r\n", end + 4) if end >= 0 else -1
            if then < 0:
                return
            self.fields, self.http = self._fields(self.head[:end]), self._fields(self.head[end + 4 : then])
            self.left = int(self.fields["content-length"]) - (then + 4 - (end + 4))
            body, self.head = memoryview(self.head)[then + 4 :], b""
        mine = body[: self.left]
        self.sha.update(mine)
        self.size, self.left = self.size + len(mine), self.left - len(mine)
        self.tail += bytes(body[len(mine) :])[:8]
        self.sound &= self.sha.hexdigest() == running

    @staticmethod
    def _fields(block: bytes) -> dict[str, str]:
        lines = block.decode("utf-8", "replace").split("\r\n")[1:]
        return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}

    def row(self) -> tuple:
        """Size and digest as counted; those that a revisit states of the payload that it refers to."""
        if self.http is None:
            return None, None, self.size, None, None, None, False
        page = lambda name: int(name[10:-1]) if name and name[10:-1] else None
        kind, digest = self.fields["warc-type"], self.fields["warc-payload-digest"].removeprefix("sha1:")
        size, counted = int(self.http["content-length"]), base64.b32encode(self.sha.digest()).decode()
        ok = self.sound and self.left == 0 and self.tail == b"\r\n\r\n" and self.gz.eof
        if kind == "response":
            ok, size, digest = ok and (size, digest) == (self.size, counted), self.size, counted
        return page(self.fields["warc-record-id"]), self.fields["warc-target-uri"], size, digest, kind, page(self.fields.get("warc-refers-to", "")), ok


def read_records(chunks: DataFrame, strict: bool = True) -> DataFrame:
    """A row for each record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and `sound`:
    all lengths and digests, those of each chunk included, agree with the bytes. If strict, a record that is not sound is an error.

    Each record's chunks meet the number of chunks of that name, by a join that leaves a table in buckets where it is.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, sound boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader = None, None
        names = [x.strip().split()[0] for x in schema.split(",")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        def done() -> tuple:
            row = reader.row()
            if strict and not row[-1]:
                raise ValueError(f"record {now} is damaged")
            return row

        for b in batches:
            rows = []
            key = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            chunk, running = b.column(2).to_pylist(), b.column(4).to_pylist()
            for k in range(b.num_rows):
                if key[k] != now:
                    if reader is not None:
                        rows.append(done())
                    now, reader = key[k], Reader()
                reader.take(chunk[k], b.column(3)[k].as_buffer(), running[k])
            yield batch(rows)
        if reader is not None:
            yield batch([done()])

    known = chunks.groupBy("record").agg(F.count("*").alias("n_chunks"))
    dealt = chunks.join(known.hint("merge"), "record").select("record", "copy", "chunk", "data", "running")
    return dealt.sortWithinPartitions("record", "copy", "chunk").mapInArrow(run, schema)


def round_trip(pages: DataFrame, min_bytes: int = 0, chunk_bytes: int = 1 << 20) -> DataFrame:
    """Writes a record for each row of pages to a table in the shared folder and reads the archives back."""
    return read_records(bucketed(write_records(pages, min_bytes=min_bytes, chunk_bytes=chunk_bytes), "record"))
