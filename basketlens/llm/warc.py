"""WARC archives through a chunked record table.

Writing: a payload becomes rows (record, chunk number, bytes, digest so far) of at most ``chunk_bytes``
each; the digest is carried from chunk to chunk. Each row is written as one WARC record: the first as
``response``, the following ones as ``continuation`` records of the same origin (WARC segmentation). Of
equal payloads one record is the response and the others are ``revisit`` records without payload.

Spark's text writer puts the records into gzip files, with the blank lines between WARC records as its line
separator, so each executor writes its own archive files to the shared folder. A chunk ends inside any byte
string of a payload that would look like the head of a record, so archives split exactly at record heads.

Reading: the text reader splits archives at record heads, each row is parsed, checked against its
Content-Length and turned back into a chunk row; the rows of a record then meet in chunk order and its
digest is carried over them again, one chunk in memory at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.bytes import binary_column
from basketlens.llm.columns import utf8
from basketlens.session import cut_lineage

#: Fixed by the WARC format: what ends a record, and how the next one begins.
BLANK, HEAD = "\r\n\r\n", "WARC/1.1\r\n"
MARK = (BLANK + HEAD).encode()
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNK_BYTES = 1 << 16
#: Bytes of records that a task gathers before it hands them to Spark.
FLUSH_BYTES = 1 << 20


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def cut(payload: memoryview | bytes, most: int) -> Iterator[bytes]:
    """Pieces of a payload in order, none longer than ``most`` and none holding a record mark."""
    view, low = memoryview(payload), 0
    while True:
        piece = bytes(view[low : low + most])
        at = piece.find(MARK)
        if at >= 0:  # end inside the mark
            piece = piece[: at + len(BLANK) + 1]
        low += len(piece)
        yield piece
        if low >= len(view):
            return


def _record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{name}: {value}" for name, value in fields), f"Content-Length: {len(block)}"]
    return HEAD.encode() + "\r\n".join(lines).encode() + BLANK.encode() + block


def chunk_records(pages: DataFrame, chunk_bytes: int, date: str) -> DataFrame:
    """One row per WARC record of (id, url, response_id, body): the record's bytes as text.

    A written record is named by its page and a number of its own, so rows that repeat a key stay apart. Payloads
    are cut as they are written: chunks go on to Spark whenever ``FLUSH_BYTES`` of them are ready.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, record = TaskContext.get().partitionId(), 0
        for batch in batches:
            ready, held = [], 0
            bodies = binary_column(batch, "body")
            for i in range(len(batch)):
                page, url, response = (batch.column(c)[i].as_py() for c in range(3))
                name, record = f"{'' if page is None else page}:{part}-{record}", record + 1
                url = "".join(c for c in (url or "") if c.isprintable())
                common = [("WARC-Date", date), ("WARC-Target-URI", url)]
                body = bodies[i].as_buffer()
                if response != page:
                    digest = base32(hashlib.sha1(body).digest())
                    extra = [("WARC-Refers-To", f"<urn:page:{response}>"), ("WARC-Payload-Digest", f"sha1:{digest}")]
                    profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
                    ready.append(_record("revisit", [("WARC-Record-ID", f"<urn:page:{name}>"), *common, *extra, profile], b""))
                else:
                    carried, total = hashlib.sha1(), len(body) + len(HTTP_HEAD)
                    pieces, number = cut(body, chunk_bytes), 1
                    piece, ahead = next(pieces), next(pieces, None)
                    while piece is not None:
                        carried.update(piece)
                        fields = [("WARC-Record-ID", f"<urn:page:{name}>" if number == 1 else f"<urn:page:{name}:{number}>"), *common]
                        if number > 1 or ahead is not None:
                            fields.append(("WARC-Segment-Number", number))
                            if number > 1:
                                fields.append(("WARC-Segment-Origin-ID", f"<urn:page:{name}>"))
                            if ahead is None:
                                fields.append(("WARC-Segment-Total-Length", total))
                        fields.append(("WARC-Payload-Digest" if ahead is None else "X-Digest-So-Far", f"sha1:{base32(carried.digest())}"))
                        if number == 1:
                            fields.append(("Content-Type", "application/http; msgtype=response"))
                        ready.append(_record("response" if number == 1 else "continuation", fields, (HTTP_HEAD if number == 1 else b"") + piece))
                        held += len(piece)
                        if held >= FLUSH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], ["value"])
                            ready, held = [], 0
                        piece, ahead, number = ahead, next(pieces, None) if ahead is not None else None, number + 1
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], ["value"])

    records = pages.select("id", "url", "response_id", "body").mapInArrow(run, "value binary")
    return records.select(F.col("value").cast("string").alias("value"))


def _base32_digest(body):
    """Base32 SHA-1 of a column, in groups of five bytes."""
    digest = F.sha1(body)
    groups = [F.lpad(F.conv(F.substring(digest, 10 * g + 1, 10), 16, 32), 8, "0") for g in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
    chunk_bytes: int = CHUNK_BYTES, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write a WARC record for every row to gzip files under ``path``.

    Of the records with equal payloads of at least ``least`` bytes, the one with the largest key is the
    response and the others are revisits; smaller ones are all responses, and so are rows with a null key.
    A null payload is empty. Rows that repeat key and payload are written once each. Extra columns are
    ignored.
    """
    body = utf8(F.col(f"`{payload}`"))
    rows = pages.select(F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumns({"digest": _base32_digest(F.col("body")), "n": F.octet_length("body")})
    facts = pages.select(F.col(f"`{key}`").alias("id"), _base32_digest(body).alias("digest"), F.octet_length(body).alias("n"))
    repeated = facts.where(F.col("n") >= least).groupBy("digest", "n").agg(F.max("id").alias("head"), F.min("id").alias("other"))
    repeated = repeated.where("head <> other").drop("other")
    response = F.when(F.col("id").isNotNull(), F.coalesce("head", "id")).alias("response_id")
    met = rows.join(repeated, ["digest", "n"], "left").select("id", "url", response, "body")
    chunk_records(met, chunk_bytes, date).write.option("lineSep", BLANK).option("compression", "gzip").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of the archives under ``path``.

    (page_id, record, record_type, refers_to, declared, chunk, whole, n_bytes, so_far, data): ``whole`` tells that
    the record has this one chunk, whose digest is then in ``so_far`` and whose data are not repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in binary_column(batch, "value"):
                raw = value.as_buffer().to_pybytes()
                if not raw:
                    continue
                raw = raw.removeprefix(HEAD.encode())
                head, _, block = raw.partition(BLANK.encode())
                fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n") if ": " in line)
                length = int(fields["Content-Length"])
                if block[length:] not in (b"", BLANK.encode()):
                    raise ValueError(f"record {fields.get('WARC-Record-ID')}: {len(block)} bytes, {length} declared")
                block, kind = block[:length], fields["WARC-Type"]
                if len(block) < length:
                    raise ValueError(f"record {fields.get('WARC-Record-ID')}: {len(block)} bytes, {length} declared")
                if kind == "response":
                    block = block.partition(BLANK.encode())[2]
                number = int(fields.get("WARC-Segment-Number", 1))
                origin = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]).removeprefix("<urn:page:").rstrip(">")
                origin, _, record = origin.partition(":")
                refers = fields.get("WARC-Refers-To", "").removeprefix("<urn:page:").rstrip(">")
                whole = "WARC-Segment-Number" not in fields
                declared = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
                so_far = base32(hashlib.sha1(block).digest()) if whole and kind != "revisit" else None
                rows.append((
                    int(origin) if origin else None, record, "revisit" if kind == "revisit" else "response", int(refers) if refers else None,
                    declared, number, whole, len(block), so_far, None if whole else block,
                ))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["page_id", "record", "record_type", "refers_to", "declared", "chunk", "whole", "n_bytes", "so_far", "data"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    lines = spark.read.option("lineSep", MARK.decode()).text(path).select(F.col("value").cast("binary").alias("value"))
    schema = "page_id bigint, record string, record_type string, refers_to bigint, declared string, chunk int, whole boolean, n_bytes bigint, so_far string, data binary"
    return lines.mapInArrow(run, schema)


def fold_chunks(chunks: DataFrame) -> DataFrame:
    """One row per record: its payload's length and digest, carried over its chunks in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, length = hashlib.sha1(), 0
        for batch in batches:
            rows = []
            for page, _, kind, refers, declared, chunk, whole, n, so_far, data in zip(*(c for c in batch.columns), strict=True):
                if whole.as_py():
                    digest, total = so_far.as_py() or declared.as_py(), n.as_py()
                else:
                    if chunk.as_py() == 1:
                        carried, length = hashlib.sha1(), 0
                    carried.update(data.as_buffer())
                    length += n.as_py()
                    if not declared.is_valid:
                        continue
                    digest, total = base32(carried.digest()), length
                if declared.is_valid and digest != declared.as_py():
                    raise ValueError(f"record {page}: digest {digest}, {declared} declared")
                rows.append((page.as_py(), kind.as_py(), refers.as_py(), digest, total))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["page_id", "record_type", "refers_to", "payload_digest", "payload_bytes"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    # the rows of one record in chunk order; records that are whole need no company
    met = chunks.repartition("record").sortWithinPartitions("record", "chunk")
    return met.mapInArrow(run, "page_id bigint, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit has the length of the payload of the response that it refers to. Raises ValueError on a
    record whose length or digest is not what its head declares. An empty folder of archives gives no rows.
    """
    records = cut_lineage(fold_chunks(read_chunks(spark, path)))
    lengths = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("referred"))
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(lengths.dropDuplicates(["refers_to"]), "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = records.where("record_type = 'response'").select(*columns)
    return responses.unionByName(revisits.withColumnRenamed("referred", "payload_bytes").select(*columns))


SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages
), named AS (
  SELECT page_id, n, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    (((strpos('0123456789abcdef', substr(d, CAST(5 * i // 4 AS INT) + 1, 1)) - 1) * 16 +
      greatest(strpos('0123456789abcdef', substr(d, CAST(5 * i // 4 AS INT) + 2, 1)) - 1, 0)) >> CAST(3 - 5 * i % 4 AS INT)) % 32, 1)), '') AS digest
  FROM digests
), heads AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS head FROM named)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM heads
"""
