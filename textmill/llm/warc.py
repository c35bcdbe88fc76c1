"""WARC archives: one gzip member a record, written by tasks and read back as a stream.

Writing. Payload digests are grouped in Spark; the smallest id of equal payloads keeps the payload (``response``), the others
refer to it (``revisit``). Every task writes its rows to archives of bounded size in the shared folder and returns their names;
only names of finished tasks are in the table of archives, so what a lost task left behind is never read.

Reading. A reader goes through an archive once, in steps of some KB: it inflates one member after the other, takes the header
up to its blank line, then exactly Content-Length bytes, then the end of the record, and compares the digests of block and
payload with the declared ones while the bytes go by. A record is never held as a whole unless its payload is asked for.
"""

from __future__ import annotations

import base64
import hashlib
import string
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import batches_of, one_text, table
from textmill.staging import checkpoint_root, stage

#: Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 256 * 1024 * 1024
#: Bytes that are read, inflated or hashed at once, and the longest header.
STEP, MAX_HEADER = 64 * 1024, 1024 * 1024
#: A payload shared by more than this part of all copies goes by broadcast; there are fewer such payloads than parts.
HOT_PARTS = 1024
DATE = "2024-01-01T00:00:00Z"

# Names of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b\x08"

_ID, _NO_ID = "<urn:record:", "<urn:null>"
RECORDS = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_bytes bigint, payload_digest string, "
    "digest_ok boolean, payload binary, archive string, offset bigint, error string"
)


class WarcError(ValueError):
    """A record that breaks the rules of framing."""


def digest_text(digest: bytes) -> str:
    """Bare upper-case base32."""
    return base64.b32encode(digest).decode()


def _id_header(value) -> str:
    return _NO_ID if value is None else f"{_ID}{urllib.parse.quote(str(value), safe='')}>"


def _id_of(header: str | None) -> str | None:
    return urllib.parse.unquote(header[len(_ID) : -1]) if header and header.startswith(_ID) else None


# -- writing -------------------------------------------------------------------------------------------------------------


def with_revisits(df: DataFrame, id_column: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """``id``, ``body`` (the payload as text, null as empty), ``refers_to`` and all columns of ``df`` as the struct ``row``.

    ``refers_to`` is the smallest id with an equal payload of at least ``least_bytes`` bytes, null for that row itself, for
    smaller payloads and where no equal row has an id. Rows that repeat the smallest id each keep their payload.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{id_column}`").alias("id"), one_text(f"`{payload}`").alias("body"))
    rows = rows.withColumn("digest", F.sha2(F.col("body").cast("binary"), 256))
    groups = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.max(F.octet_length("body")).alias("bytes"))
    groups = stage(groups.where((F.col("n") > 1) & (F.col("bytes") >= least_bytes) & F.col("first").isNotNull()), "equal-payloads")
    hot = F.col("n") * HOT_PARTS > groups.agg(F.sum("n")).scalar()
    often = groups.where(hot).select("digest", F.col("first").alias("often_first"))
    seldom = groups.where(~hot).select(F.col("digest").alias("key"), F.col("first").alias("seldom_first"))
    # rows of a frequent payload have their answer and are dealt out by a key of their own
    known = rows.join(F.broadcast(often), "digest", "left").withColumn(
        "key", F.when(F.col("often_first").isNull(), F.col("digest")).otherwise(F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string")))
    )
    first = F.coalesce("often_first", "seldom_first")
    return known.join(seldom, "key", "left").select("row", "id", "body", F.when(~F.col("id").eqNullSafe(first), first).alias("refers_to"))


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([packer.compress(VERSION + b"\r\n" + lines.encode() + b"\r\n"), packer.compress(block), packer.compress(_END), packer.flush()])


def page_record(record_id, uri: str | None, body: str, refers_to=None, date: str = DATE) -> bytes:
    """A ``response`` record, or a ``revisit`` record, whose block is the HTTP header alone."""
    payload = body.encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _id_header(record_id)), ("WARC-Date", date)]
    if uri is not None:
        headers.append(("WARC-Target-URI", urllib.parse.quote(uri, safe=string.punctuation)))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest_text(hashlib.sha1(payload).digest())}"))
    if refers_to is None:
        block += payload
    else:
        headers += [("WARC-Refers-To", _id_header(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    headers += [("WARC-Block-Digest", f"sha1:{digest_text(hashlib.sha1(block).digest())}"), ("Content-Type", "application/http; msgtype=response")]
    return member(headers, block)


def write_archives(rows: DataFrame, uri: str, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of :func:`with_revisits` below ``folder`` and return ``archive`` (its place), ``records`` and ``bytes``.

    ``uri`` is a column of ``row``. The folder is opened with ``pyarrow.fs`` on the workers (local or shared paths, HDFS,
    object stores). An archive begins with a ``warcinfo`` record and is closed after ``archive_bytes``; a task without rows
    writes none. The table of archives is written before it is returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        out, place, records, size = None, "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.record_batch([[place], [records], [size]], ["archive", "records", "bytes"])

        for batch in batches:
            for part in batches_of(batch):
                for record_id, target, body, refers_to in zip(*[part.column(i).to_pylist() for i in range(4)], strict=True):
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        store.create_dir(base, recursive=True)
                        out, place, records = store.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0
                        size = out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Filename", name)], b""))
                    size += out.write(page_record(record_id, target, body, refers_to))
                    records += 1
                    if size >= archive_bytes:
                        yield close()
                        out = None
        if out is not None:
            yield close()

    chosen = rows.select("id", F.col(f"row.`{uri}`").cast("string").alias("uri"), "body", "refers_to")
    return stage(chosen.mapInArrow(run, "archive string, records bigint, bytes bigint"), "archives")


# -- reading -------------------------------------------------------------------------------------------------------------


class _Member:
    """The inflated bytes of one gzip member, taken in steps from a seekable file."""

    def __init__(self, file, start: int):
        self.file, self.start, self.next = file, start, start
        self.inflate, self.held, self.rest = zlib.decompressobj(31), bytearray(), b""
        file.seek(start)

    def more(self) -> bool:
        """Inflate at most one step more; False at the end of the member."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.rest or self.file.read(STEP)
        self.rest = b""
        if not data:
            raise WarcError("the archive ends inside a record")
        self.held += self.inflate.decompress(data, STEP)
        if self.inflate.eof:
            self.next = self.file.tell() - len(self.inflate.unused_data)
        return True

    def header(self, limit: int = MAX_HEADER) -> bytes:
        """Bytes up to the next blank line, which is taken too."""
        at = -1
        while (at := self.held.find(_END)) < 0:
            if len(self.held) > limit or not self.more():
                raise WarcError("a header without end")
        found = bytes(self.held[:at])
        del self.held[: at + len(_END)]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """Exactly ``size`` bytes, in steps."""
        while size:
            if not self.held and not self.more():
                raise WarcError("a record shorter than its Content-Length")
            step = bytes(self.held[:size])
            del self.held[: len(step)]
            size -= len(step)
            if step:
                yield step

    def end(self) -> None:
        """The two line ends after the block, and nothing behind them."""
        while self.more():
            if len(self.held) > len(_END):
                break
        if bytes(self.held) != _END:
            raise WarcError("a record longer than its Content-Length")


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    found = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError("a header line without a colon")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def _length(fields: dict[str, str]) -> int:
    text = fields.get("content-length", "")
    if not (text.isascii() and text.isdigit()):
        raise WarcError("no Content-Length")
    return int(text)


def _record(member: _Member, keep_payload: bool) -> dict:
    header = member.header()
    if not header.startswith(b"WARC/"):
        raise WarcError("not a WARC record")
    fields = _fields(header)
    size, kind = _length(fields), fields.get("warc-type")
    if kind not in ("response", "revisit"):
        for _ in member.take(size):
            pass
        member.end()
        return {"record_type": kind}
    whole, own, seen, kept = hashlib.sha1(), hashlib.sha1(), 0, []
    # the HTTP header of the block, then its payload
    start = bytearray()
    steps, cut = member.take(size), -1
    for step in steps:
        whole.update(step)
        start += step
        if (cut := start.find(_END)) >= 0:
            break
        if len(start) > MAX_HEADER:
            raise WarcError("an HTTP header without end")
    if cut < 0:
        raise WarcError("a block without an HTTP header")
    http = _fields(bytes(start[:cut]))
    payload = bytes(start[cut + len(_END) :])
    while payload is not None:
        own.update(payload)
        seen += len(payload)
        if keep_payload:
            kept.append(payload)
        payload = next(steps, None)
        if payload is not None:
            whole.update(payload)
    member.end()
    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    block_ok = fields.get("warc-block-digest", "").removeprefix("sha1:") == digest_text(whole.digest())
    found = {"record_type": kind, "record_id": _id_of(fields.get("warc-record-id")), "target_uri": fields.get("warc-target-uri")}
    if kind == "revisit":
        return found | {"refers_to": _id_of(fields.get("warc-refers-to")), "payload_bytes": _length(http), "payload_digest": declared, "digest_ok": block_ok}
    found |= {"payload_bytes": seen, "payload_digest": digest_text(own.digest()), "payload": b"".join(kept) if keep_payload else None}
    return found | {"digest_ok": block_ok and declared == found["payload_digest"] and seen == _length(http)}


def _next_member(file, start: int) -> int | None:
    """Place of the next gzip magic at or behind ``start``."""
    file.seek(start)
    tail, at = b"", start
    while data := file.read(STEP):
        joined = tail + data
        if (found := joined.find(_GZIP)) >= 0:
            return at - len(tail) + found
        at += len(data)
        tail = joined[-(len(_GZIP) - 1) :]
    return None


def read_archive(file, size: int, keep_payload: bool = False) -> Iterator[dict]:
    """The response and revisit records of one archive, in order, with the ``offset`` of their member.

    A damaged stretch gives one row with ``error``; reading goes on at the next member that holds a WARC record.
    """
    at, damaged = 0, False
    while at is not None and at < size:
        member = _Member(file, at)
        try:
            found = _record(member, keep_payload)
        except (WarcError, zlib.error) as fault:
            if not damaged:
                yield {"offset": at, "error": str(fault)}
            damaged, at = True, _next_member(file, at + 1)
            continue
        damaged = False
        if found["record_type"] in ("response", "revisit"):
            yield found | {"offset": at}
        at = member.next


def read_archives(archives: DataFrame, keep_payload: bool = False) -> DataFrame:
    """The records of all archives named in ``archive``; columns as in ``RECORDS``.

    ``payload_bytes`` and ``payload_digest`` are those of the bytes read for a response, the declared ones of the full payload
    for a revisit. ``digest_ok`` tells whether the digests of block and payload are as declared. An archive is read by one
    task, in order; a null name and an empty table give no rows.
    """
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("payload", pa.binary()), ("archive", pa.string()), ("offset", pa.int64()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(place)
                with store.open_input_file(path) as file:
                    rows, held = [], 0
                    for record in read_archive(file, file.size(), keep_payload):
                        rows.append(record | {"archive": place})
                        held += len(record.get("payload") or b"")
                        if len(rows) >= 4096 or held > 64 * STEP:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    names = archives.select("archive").where("archive IS NOT NULL")
    return names.repartition(max(1, names.count())).mapInArrow(run, RECORDS)


def round_trip(df: DataFrame, id_column: str, uri: str, payload: str, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record of every row and read the archives back; columns of :func:`read_archives`, ids as text.

    A null payload is empty; a null id stays null; a null address is left out. Repeated rows are records of their own. Ids are
    compared in their own type. Columns of ``df`` may have any name.
    """
    return read_archives(write_archives(with_revisits(df, id_column, payload, least_bytes), uri, folder))


def page_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives. Damaged records end the query: nothing was lost on the way."""
    folder = f"{checkpoint_root(spark)}/textmill/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    records = round_trip(table(spark, sf, "pages"), "page_id", "url", "html", folder)
    sound = F.coalesce(F.col("digest_ok"), F.lit(False)) & F.col("error").isNull()
    checked = F.when(sound, F.col("record_type")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("damaged record in"), "archive", "offset", "error")))
    return records.select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", checked.alias("record_type"), F.col("refers_to").cast("bigint").alias("refers_to")
    )


PAGE_ARCHIVES_SQL = """
WITH pages_of AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM pages_of)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substring(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM coalesce(first, page_id) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""
