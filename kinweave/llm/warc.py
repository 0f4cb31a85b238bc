"""WARC archives: writing records, and putting segmented records together again.

Archives are ordinary files in the shared file system, written and read by Spark, so a lost task writes its file anew.
A block larger than a segment goes on in continuation records. Reading groups those by the identifier of their
origin, orders them by segment number, verifies the total length and undoes chunked transfer framing. Records in one
piece are never shuffled.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.skew import lookup

SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
#: With the segment size this bounds an archive, which is read in one piece.
RECORDS_PER_ARCHIVE = 1_000
REVISIT_BYTES = 1_000

_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + _END
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORDS = (
    "record_id string, warc_type string, segment int, total_length long, target_uri string, refers_to string, "
    "whole boolean, body binary, fault string")


class Malformed(ValueError):
    """What the reader reports in column ``fault``."""


def chunked(payload: bytes) -> bytes:
    parts = [payload[i:i + CHUNK_BYTES] for i in range(0, len(payload), CHUNK_BYTES)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = re.fullmatch(rb"\s*([0-9a-fA-F]+)\s*(;.*)?", body[at:line]) if line >= 0 else None
        if not size:
            raise Malformed("a chunk has no size")
        n = int(size[1], 16)
        if n == 0:
            return b"".join(out)
        if body[line + 2 + n:line + 4 + n] != b"\r\n":
            raise Malformed("a chunk is cut short")
        out.append(body[line + 2:line + 2 + n])
        at = line + 4 + n


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response, without its headers and transfer framing."""
    head, end, body = block.partition(_END)
    if not end:
        raise Malformed("the HTTP head has no end")
    if re.search(rb"\r\ntransfer-encoding:[^\r]*\bchunked\s*(\r\n|$)", head, re.IGNORECASE):
        return dechunked(body)
    return body


def _record(warc_type: str, record_id: str, block: bytes, **fields: object) -> bytes:
    named = {"WARC-Type": warc_type, "WARC-Record-ID": record_id}
    named |= {k.replace("_", "-"): v for k, v in fields.items() if v is not None}
    named["Content-Length"] = len(block)
    head = "".join(f"{k}: {str(v).replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n" for k, v in named.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + _END


def _response(record_id: str, uri: str | None, digest: str, date: str, payload: bytes) -> Iterator[bytes]:
    block = _HTTP + chunked(payload)
    pieces = [block[i:i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    common = {"WARC_Date": date}
    own = {"WARC_Target_URI": uri, "WARC_Payload_Digest": digest, "Content_Type": "application/http;msgtype=response"}
    if len(pieces) == 1:
        yield _record("response", record_id, block, **common, **own)
        return
    yield _record("response", record_id, pieces[0], **common, **own, WARC_Segment_Number=1)
    for n, piece in enumerate(pieces[1:], 2):
        yield _record(
            "continuation", f"{record_id[:-1]}:{n}>", piece, **common, WARC_Target_URI=uri,
            WARC_Segment_Origin_ID=record_id, WARC_Segment_Number=n,
            WARC_Segment_Total_Length=len(block) if n == len(pieces) else None)


def _records(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    """Archive text of (record id, target, SHA-1 in hex, id of the response, payload), in Arrow batches."""
    for batch in batches:
        out, held = [], 0
        for record_id, uri, sha1, refers_to, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
            if refers_to is None:
                made = list(_response(record_id, uri, digest, date, payload))
            else:
                made = [_record(
                    "revisit", record_id, b"", WARC_Date=date, WARC_Target_URI=uri, WARC_Payload_Digest=digest,
                    WARC_Profile=_REVISIT_PROFILE, WARC_Refers_To=refers_to)]
            out += [m[:-1] for m in made]  # the writer of lines adds the last byte
            held += sum(map(len, made))
            if held >= 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def _urn(page_id: Column, sha1: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), sha1, F.lit(">"))


def payload_owners(pages: DataFrame) -> DataFrame:
    """``payload_key, owner``: for payloads of at least ``REVISIT_BYTES`` that several ids share, the largest id.

    Input (``_id``, ``_payload``). Only ids and digests are shuffled, combined before.
    """
    long_enough = pages.filter(F.octet_length("_payload") >= REVISIT_BYTES)
    return (
        long_enough.select("_id", F.sha2("_payload", 256).alias("payload_key"))
        .groupBy("payload_key").agg(F.max("_id").alias("owner"), F.min("_id").alias("_least"))
        .filter(F.col("_least") < F.col("owner")).drop("_least"))


def write_archives(
    pages: DataFrame, owners: DataFrame, path: str, date: str,
    id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
) -> None:
    """Writes a record for each row of ``pages`` to archives in the new folder ``path``.

    The row is a revisit, without payload, if ``owners`` names a larger id for its payload, else a response. A null
    payload is empty; rows with a null id are responses; a null URL leaves its field out. Repeated rows make repeated
    records. Payloads are strings or binary.
    """
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_url"), payload.alias("_payload"))
    # Hashes of the payload, taken once: the key also spares short payloads the join.
    keyed = rows.select(
        "*", F.sha1("_payload").alias("_sha1"),
        F.when(F.octet_length("_payload") >= REVISIT_BYTES, F.sha2("_payload", 256)).alias("payload_key"))
    known = lookup(keyed, owners, "payload_key")
    revisit = F.col("_id") < F.col("owner")
    records = known.select(
        _urn(F.col("_id"), F.col("_sha1")).alias("record_id"), F.col("_url").alias("url"), F.col("_sha1").alias("sha1"),
        F.when(revisit, _urn(F.col("owner"), F.col("_sha1"))).alias("refers_to"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("_payload")).alias("payload"),
    ).mapInArrow(partial(_records, date=date), "value binary")
    (
        records.select(F.col("value").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).option("compression", "gzip").text(path))


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields, in lower case, and block of each record of an archive, gzip or plain."""
    if archive[:2] == b"\x1f\x8b":
        archive = _unzipped(archive)
    at = 0
    while at < len(archive):
        head = archive.find(_END, at)
        lines = archive[at:head].decode("utf-8", "replace").split("\r\n") if head >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise Malformed(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not fields.get("content-length", "").isdigit():
            raise Malformed(f"no length at byte {at}")
        begin, size = head + 4, int(fields["content-length"])
        if archive[begin + size:begin + size + 4] != _END:
            raise Malformed(f"the record at byte {at} is cut short")
        yield fields, archive[begin:begin + size]
        at = begin + size + 4


def _unzipped(data: bytes) -> bytes:
    """All members of a gzip file."""
    import zlib

    out = []
    while data:
        member = zlib.decompressobj(31)
        out += [member.decompress(data), member.flush()]
        data = member.unused_data
    return b"".join(out)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind, number = fields.get("warc-type"), fields.get("warc-segment-number")
    own = fields.get("warc-segment-origin-id" if kind == "continuation" else "warc-record-id")
    total = fields.get("warc-segment-total-length")
    fault, body = None, block
    if number is None and kind == "response":
        try:
            body = http_payload(block)
        except Malformed as e:
            fault, body = str(e), None
    return (
        own, kind, int(number or 1), int(total) if total else None, fields.get("warc-target-uri"),
        fields.get("warc-refers-to"), number is None, body, fault)


def _parse(batches: Iterator[pa.RecordBatch], whole: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0):
            rows, held = [], 0
            for fields, block in parsed(archive.as_py()):
                if (fields.get("warc-segment-number") is None) == whole:
                    rows.append(_row(fields, block))
                    held += len(block)
                if held >= 1 << 23:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payload or fault from (total length, [(segment, body)])."""
    for batch in batches:
        payloads, faults = [], []
        for total, segments in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ordered = sorted(segments, key=lambda s: s["segment"])
            block = b"".join(s["body"] for s in ordered)
            payload = fault = None
            if [s["segment"] for s in ordered] != list(range(1, len(ordered) + 1)):
                fault = "a segment is missing"
            elif total != len(block):
                fault = f"{len(block)} bytes, announced were {total}"
            else:
                try:
                    payload = http_payload(block)
                except Malformed as e:
                    fault = str(e)
            payloads.append(payload)
            faults.append(fault)
        out = [*batch.columns[2:], pa.array(payloads, pa.binary()), pa.array(faults, pa.string())]
        yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[2:], "payload", "fault"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, warc_type, target_uri, refers_to, payload, fault`` for each response and revisit in the archives.

    ``payload`` is binary, null for revisits and for records with a fault: a missing segment, a wrong total length, or
    broken framing. Segments of a record may lie in different archives. Equal records written several times come out
    as often. A broken archive ends the job; a folder without records gives an empty result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_RECORDS))
    archives = spark.read.format("binaryFile").load(path).select("content")
    single = archives.mapInArrow(partial(_parse, whole=True, schema=schema), _RECORDS)
    segments = archives.mapInArrow(partial(_parse, whole=False, schema=schema), _RECORDS)
    # Copies of a segment are combined first, so what meets in one place is one record.
    distinct = segments.groupBy("record_id", "segment", F.md5("body").alias("_same")).agg(
        F.min("body").alias("body"), F.max("total_length").alias("total_length"), F.min("target_uri").alias("target_uri"),
        F.max(F.when(F.col("warc_type") != "continuation", F.col("warc_type"))).alias("warc_type"),
        F.count(F.when(F.col("segment") == 1, 1)).alias("copies"))
    whole = distinct.groupBy("record_id").agg(
        F.max("total_length").alias("total_length"), F.collect_list(F.struct("segment", "body")).alias("segments"),
        F.max("warc_type").alias("warc_type"), F.min("target_uri").alias("target_uri"), F.max("copies").alias("copies"))
    joined = (
        whole.select("total_length", "segments", "record_id", "warc_type", "target_uri", "copies")
        .mapInArrow(_decode, "record_id string, warc_type string, target_uri string, copies long, payload binary, fault string")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col("copies"), F.lit(1))))))
    columns = ("record_id", "warc_type", "target_uri", "refers_to", "payload", "fault")
    one = single.filter(F.col("warc_type").isin("response", "revisit")).withColumn(
        "payload", F.when(F.col("warc_type") == "response", F.col("body")))
    return one.select(*columns).unionByName(joined.withColumn("refers_to", F.lit(None).cast("string")).select(*columns))


def payload_facts(records: DataFrame) -> DataFrame:
    """``record_id, warc_type, refers_to, payload_bytes, payload_digest``: revisits take theirs from the response.

    The digest is SHA-1 in lower-case hex. Both are null where the payload is unreadable or its response is missing.
    Expects what :func:`read_archives` returns, best written once with only these facts: see :func:`facts_of_responses`.
    """
    answers = records.filter(F.col("warc_type") == "response").groupBy("record_id").agg(
        F.max("payload_bytes").alias("_bytes"), F.max("payload_digest").alias("_digest"))
    revisits = lookup(
        records.filter(F.col("warc_type") == "revisit"), answers.withColumnRenamed("record_id", "refers_to"), "refers_to")
    return records.filter(F.col("warc_type") == "response").unionByName(revisits.select(
        "record_id", "warc_type", "refers_to", F.col("_bytes").alias("payload_bytes"),
        F.col("_digest").alias("payload_digest")))


def facts_of_responses(records: DataFrame) -> DataFrame:
    return records.select(
        "record_id", "warc_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))
