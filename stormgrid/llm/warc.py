"""WARC archives: writing with revisits and segments, reading with segment reassembly and chunked decoding.

Archives are gzip files written and read by Spark's own text source, so they may lie in any store it knows: a
record ends in CR LF CR LF, which is the text source's line feed after the last three bytes, and on the way back records
are split at ``CR LF CR LF WARC/1.``. A payload that holds this mark itself is put together again by its
declared length. Only continuation records are shuffled when read, by their origin's identifier.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from .common import row_ranges

VERSION = b"WARC/1."
_MARK = b"\r\n\r\n" + VERSION
SEGMENT = 16 * 1024         # bytes of a block per record; longer blocks continue in further records
CHUNK = 4 * 1024            # of the chunked transfer framing
REVISIT_FROM = 1000         # bytes from which equal payloads are stored once
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH = 8 << 20


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def digest(payload: bytes) -> str:
    """The labelled base-32 SHA-1 that archives carry."""
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for i in range(0, len(body), size) if (p := body[i:i + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """Decoded body; None if the framing is broken. Extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if size < 0 or body[at:at + 2] != b"\r\n":
            return None
        out.append(body[end + 2:at])
        at += 2


def _record(fields: dict[str, object], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in (fields | {"Content-Length": len(block)}).items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r"


def records_of(name: str | None, uri: str | None, payload: bytes, refers_to: str | None, segment: int = SEGMENT):
    """The records of one page, each without its last line feed; ids follow from page and payload alone."""
    sha = digest(payload)
    own = record_id(f"{name}/{sha}")
    fields = {"WARC-Type": "revisit" if refers_to else "response", "WARC-Record-ID": own, "WARC-Target-URI": _line(uri),
              "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Payload-Digest": sha, "Page-ID": _line(name)}
    if refers_to:
        yield _record(fields | {"WARC-Profile": _PROFILE, "WARC-Refers-To": record_id(f"{refers_to}/{sha}"),
                                "Content-Type": "application/http;msgtype=response"}, b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    fields["Content-Type"] = "application/http;msgtype=response"
    if len(block) <= segment:
        yield _record(fields, block)
        return
    cuts = range(0, len(block), segment)
    for i, at in enumerate(cuts, 1):
        more = {"WARC-Segment-Number": i}
        if i > 1:
            more |= {"WARC-Type": "continuation", "WARC-Record-ID": record_id(f"{name}/{sha}#{i}"),
                     "WARC-Segment-Origin-ID": own, "WARC-Payload-Digest": None, "Content-Type": None, "Page-ID": None}
        if i == len(cuts):
            more["WARC-Segment-Total-Length"] = len(block)
        yield _record(fields | more, block[at:at + segment])


def _line(text: str | None) -> str | None:
    return None if text is None else " ".join(text.split())


def with_revisits(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """``pages(page_id, uri, payload)`` plus ``refers_to``: the largest page_id with the same payload.

    Set where that is another page and the payload has ``least`` bytes or more. Digests are aggregated; the payloads
    meet only those digests that occur more than once.
    """
    hashed = pages.withColumn("_sha", F.when(F.length("payload") >= least, F.sha1("payload")))
    groups = hashed.where(F.col("_sha").isNotNull()).groupBy("_sha").agg(
        F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    # without a digest of its own a row is spread by its id, so that short pages are not one join key
    keyed = hashed.withColumn("_sha", F.coalesce("_sha", F.concat(F.lit("-"), F.col("page_id").cast("string"))))
    return keyed.join(groups, "_sha", "left").withColumn(
        "refers_to", F.when(F.col("_last") != F.col("page_id"), F.col("_last"))).drop("_sha", "_last")


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Write ``pages(page_id, uri, payload, refers_to)`` as gzip archives below ``path``."""
    def rows(batches):
        for batch in batches:
            for lo, hi in row_ranges(batch.column(2), _BATCH):
                cols = [batch.column(i)[lo:hi].to_pylist() for i in range(4)]
                out = [r for name, uri, payload, to in zip(*cols)
                       for r in records_of(name, uri, payload or b"", to, segment)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    made = pages.select(F.col("page_id").cast("string"), F.col("uri").cast("string"), "payload",
                        F.col("refers_to").cast("string"))
    made.mapInArrow(rows, "value binary").select(F.col("value").cast("string").alias("value")).write.option(
        "compression", "gzip").text(path)


class Head(NamedTuple):
    fields: dict[str, str]
    body: int               # offset of the block
    length: int             # of the block, as declared


def parse_head(data: bytes) -> Head | None:
    """Named fields (lower-case names) of a record that begins with its version line; None if it doesn't."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(VERSION) or end < 0:
        return None
    fields: dict[str, str] = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    return Head(fields, end + 4, int(length) if length.isdigit() else 0)


def whole_records(pieces):
    """Records of one archive from its pieces between marks, in order: a block as long as its head declares.

    Yields ``(head, block, complete)``; pieces outside any record are passed over.
    """
    held, head = b"", None
    for first, piece in pieces:
        data = piece if first else VERSION + piece
        if head is not None and len(held) < head.body + head.length:
            held += data if first else _MARK + piece
        else:
            if head is not None:
                yield head.fields, held[head.body:head.body + head.length], True
            held, head = data, parse_head(data)
    if head is not None:
        block = held[head.body:head.body + head.length]
        yield head.fields, block, len(block) == head.length


_FIELDS = {"type": "warc-type", "record_id": "warc-record-id", "uri": "warc-target-uri", "refers_to": "warc-refers-to",
           "payload_digest": "warc-payload-digest", "origin": "warc-segment-origin-id", "page_id": "page-id"}
_NUMBERS = {"segment": "warc-segment-number", "total": "warc-segment-total-length"}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(type, record_id, uri, refers_to, payload_digest, origin, segment, total, complete, block)`` per record.

    A gzip file is read by one task as a stream, record by record, whatever its size. ``complete`` is false where the
    file ends before the declared length. (In a file that is not compressed, and so read in splits, a record that
    holds the mark across the border of two splits is not complete either.)
    """
    lines = spark.read.option("lineSep", _MARK.decode()).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"))

    def rows(batches):
        def pieces():
            for batch in batches:
                for lo, hi in row_ranges(batch.column(0), _BATCH):
                    yield from zip(*(batch.column(i)[lo:hi].to_pylist() for i in (1, 2, 0)))

        def by_file():
            place = None
            for path, start, value in pieces():
                if (path, start) != place:
                    place, first = (path, start), start == 0
                    yield None, None
                else:
                    first = False
                yield first, value

        def records():
            stream, done = by_file(), False
            next(stream, None)
            while not done:
                def one_file():
                    nonlocal done
                    for first, value in stream:
                        if first is None:
                            return
                        yield first, value
                    done = True
                yield from whole_records(one_file())

        held, size = [], 0
        for fields, block, complete in records():
            held.append((fields, block, complete))
            size += len(block)
            if size > _BATCH:
                yield _record_batch(held)
                held, size = [], 0
        yield _record_batch(held)

    schema = (", ".join(f"{k} string" for k in _FIELDS) + ", " + ", ".join(f"{k} bigint" for k in _NUMBERS)
              + ", complete boolean, block binary")
    return lines.mapInArrow(rows, schema)


def _record_batch(held) -> pa.RecordBatch:
    def number(text):
        return int(text) if text and text.isdigit() else None

    cols = [pa.array([f.get(v) for f, _, _ in held], pa.string()) for v in _FIELDS.values()]
    cols += [pa.array([number(f.get(v)) for f, _, _ in held], pa.int64()) for v in _NUMBERS.values()]
    cols += [pa.array([c for _, _, c in held], pa.bool_()), pa.array([b for _, b, _ in held], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, [*_FIELDS, *_NUMBERS, "complete", "block"])


def reassembled(records: DataFrame) -> DataFrame:
    """Records with their continuations' blocks appended in the order of the segment numbers.

    Records without segments pass by the shuffle. ``complete`` is false if a number is missing or repeated, the last
    segment's total length is missing or another, or a part was cut short. Continuations whose origin is nowhere come
    out as one incomplete record each.
    """
    alone = records.where(F.col("segment").isNull() & F.col("origin").isNull())
    parts = records.where(F.col("segment").isNotNull() | F.col("origin").isNotNull())
    fields = [k for k in _FIELDS if k != "origin"]
    head = F.when(F.col("origin").isNull(), F.struct(*fields))
    joined = parts.groupBy(F.coalesce("origin", "record_id").alias("_id")).agg(
        F.first(head, ignorenulls=True).alias("head"), F.max("total").alias("total"), F.count(head).alias("copies"),
        F.array_sort(F.collect_set(F.struct("segment", F.col("block").cast("string").alias("block")))).alias("parts"),
        F.bool_and("complete").alias("whole"))
    block = F.array_join(F.col("parts.block"), "").cast("binary")       # strings of bytes, joined as they are
    numbered = F.col("parts.segment") == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))
    made = joined.withColumn("block", block).select(
        *[F.col(f"head.{k}").alias(k) for k in fields],
        F.coalesce(F.col("head").isNotNull() & F.col("whole") & numbered & (F.length("block") == F.col("total")),
                   F.lit(False)).alias("complete"), "block",
        # a record written twice is put together once and comes out twice
        F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)).cast("int"))).alias("copy")).drop("copy")
    return alone.select(*fields, "complete", "block").unionByName(made)


_KEPT = ("record_id", "page_id", "uri", "type", "refers_to")


def payloads(records: DataFrame) -> DataFrame:
    """``(record_id, page_id, uri, type, refers_to, declared, payload, valid)`` of reassembled records.

    The payload is the HTTP body, its chunked framing decoded; ``valid``: the record is complete, the framing sound and
    the digest the declared one. A revisit's payload is null, ``declared`` is its digest in bare hex.
    """
    def rows(batches):
        for batch in batches:
            for lo, hi in row_ranges(batch.column(len(_KEPT) + 2), _BATCH):
                part = batch.slice(lo, hi - lo).to_pydict()
                out, valid, declared = [], [], []
                for kind, want, complete, block in zip(part["type"], part["payload_digest"], part["complete"],
                                                       part["block"]):
                    head, _, body = (block or b"").partition(b"\r\n\r\n")
                    if b"transfer-encoding: chunked" in head.lower():
                        body = unchunked(body)
                    body = None if kind == "revisit" else body
                    declared.append(_bare(want))
                    out.append(body)
                    valid.append(bool(complete) and (kind == "revisit" or body is not None and (
                        want is None or hashlib.sha1(body).hexdigest() == _bare(want))))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(part[k], pa.string()) for k in _KEPT),
                     pa.array(declared, pa.string()), pa.array(out, pa.binary()), pa.array(valid, pa.bool_())],
                    [*_KEPT, "declared", "payload", "valid"])

    return records.select(*_KEPT, "payload_digest", "complete", "block").mapInArrow(
        rows, ", ".join(f"{k} string" for k in _KEPT) + ", declared string, payload binary, valid boolean")


def _bare(label: str | None) -> str | None:
    """Hex of a labelled SHA-1 in base 32 or in hex."""
    if not label or not label.lower().startswith("sha1:"):
        return None
    text = label[5:]
    try:
        return text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()
    except ValueError:
        return None


def stored_pages(records: DataFrame) -> DataFrame:
    """``(page_id, type, payload_bytes, payload_digest, refers_to, valid)`` per page, revisits looked up.

    One row per record; records equal in id and payload share a record id and come out as often as they were written, also with
    a null page id. A revisit has length and digest of the
    response it refers to; where that is in no archive the length is null, the digest the declared one, ``valid`` false.
    """
    own = payloads(records).select("record_id", "page_id", "type", "refers_to", "declared", "valid",
                                   F.length("payload").cast("long").alias("n"), F.sha1("payload").alias("sha"))
    own = staged(own, "warc-pages")
    first = own.where("type = 'response'").dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"), F.col("n").alias("_n"),
        F.col("sha").alias("_sha"), F.col("valid").alias("_valid"))
    again = own.where("type = 'revisit'").join(first, "refers_to", "left").select(
        "page_id", "type", F.col("_n").alias("payload_bytes"), F.coalesce("_sha", "declared").alias("payload_digest"),
        F.col("_page").alias("refers_to"),
        F.coalesce(F.col("_valid") & F.col("valid") & (F.col("_sha") == F.col("declared")), F.lit(False)).alias("valid"))
    return own.where("type = 'response'").select(
        "page_id", "type", F.col("n").alias("payload_bytes"), F.col("sha").alias("payload_digest"),
        F.lit(None).cast("string").alias("refers_to"), "valid").unionByName(again)
