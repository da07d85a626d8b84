"""WARC archives with a Zstandard dictionary, one frame for each record.

An archive is a sequence of Zstandard frames: first a skippable frame
(magic 0x184D2A5D) that holds the dictionary, then one frame for each record,
compressed with it. Spark's text writer stores the frames through its commit
protocol, so that archives go to any file system and lost executors only
repeat their part: a row is a frame, and the line separator is itself an
empty skippable frame (magic 0x184D2A50, length 0), which readers pass over.
Frames of a part are sorted by page id.

Reading takes whole archives as rows of the ``binaryFile`` source (files are
kept near ``ARCHIVE_BYTES``), loads the dictionary from the leading frame,
walks the frames by their block headers, decodes one at a time and checks the
magic numbers, frame and content lengths, the WARC version line, the
required header fields, ``Content-Length`` and the HTTP length; response
payloads are held against their digest. ``ArchiveError`` names the archive
and offset of what fails.

Of records with equal payloads of ``REVISIT_BYTES`` or more, that with the
smallest page id is the response, the others are revisits that refer to it.
They are found in a narrow table of ids and digests: an aggregate that is
combined map-side and a join on the digest, whose hot partitions AQE splits;
payloads are shuffled once.

Defined results: a null html is an empty payload; a null url has no
``WARC-Target-URI``; control characters, spaces and ``%`` of a url are
percent-encoded in the header and decoded by the reader; null page ids come
first (a null id is a revisit only of a null id's record); repeated page ids
each have a record, and of several equal payloads with the same smallest id
all stay responses; an empty table gives archives without records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches, unit_hash

REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 << 20
#: bound of the pages that the dictionary is trained on, and of the part of each
DICTIONARY_PAGES, DICTIONARY_PAGE_BYTES, DICTIONARY_BYTES = 1_000, 8_192, 65_536
LEVEL, PACK_LEVEL = 6, 3

# fixed values of the formats
DICTIONARY_MAGIC = bytes.fromhex("5d2a4d18")
FRAME_MAGIC = bytes.fromhex("28b52ffd")
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest")


class ArchiveError(ValueError):
    """An archive doesn't hold what its headers say."""


def record_id(page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + page)}>"


def render(page: str | None, url: str | None, payload: bytes, digest: str, refers: str | None,
           revisit: bool, date: str) -> bytes:
    """The bytes of a record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page or "")),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    if page is not None:
        fields.append(("Page-ID", page))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers or "")), ("Refers-To-Page-ID", refers or "")]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """The fields of a record, checked."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise ArchiveError("no WARC/1.1 header")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ArchiveError(f"missing {', '.join(missing)}")
    if fields["WARC-Type"] not in ("response", "revisit") or not re.fullmatch("sha256:[0-9a-f]{64}", fields["WARC-Payload-Digest"]):
        raise ArchiveError("unknown record type or digest")
    if len(rest) != int(fields["Content-Length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ArchiveError("Content-Length differs from the block")
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"\r\nContent-Length: ([0-9]+)", http)
    if not mark or not http.startswith(b"HTTP/1.1 ") or not length:
        raise ArchiveError("no HTTP header")
    revisit, digest = fields["WARC-Type"] == "revisit", fields["WARC-Payload-Digest"][7:]
    if revisit and (payload or "Refers-To-Page-ID" not in fields):
        raise ArchiveError("a revisit with a payload, or that refers to nothing")
    if not revisit and (len(payload) != int(length[1]) or hashlib.sha256(payload).hexdigest() != digest):
        raise ArchiveError("the payload differs from its length or digest")
    url = fields.get("WARC-Target-URI")
    return {"page_id": fields.get("Page-ID"), "url": None if url is None else unquote(url),
            "payload": None if revisit else payload, "payload_bytes": int(length[1]), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": fields.get("Refers-To-Page-ID") or None}


def frame_size(data: memoryview, at: int) -> int:
    """Bytes of the Zstandard frame at an offset, by its headers."""
    magic = bytes(data[at:at + 4])
    if len(magic) == 4 and 0x50 <= magic[0] <= 0x5F and magic[1:] == DICTIONARY_MAGIC[1:]:
        size = 8 + int.from_bytes(data[at + 4:at + 8], "little")
    elif magic == FRAME_MAGIC:
        flags = data[at + 4]
        single, size = flags >> 5 & 1, 5
        size += (not single) + (0, 1, 2, 4)[flags & 3] + ((single, 2, 4, 8)[flags >> 6])
        last = False
        while not last:
            if at + size + 3 > len(data):
                raise ArchiveError(f"a frame is cut off at byte {at}")
            block = int.from_bytes(data[at + size:at + size + 3], "little")
            last, kind, n = block & 1, block >> 1 & 3, block >> 3
            size += 3 + (1 if kind == 1 else n)
        size += 4 * (flags >> 2 & 1)
    else:
        raise ArchiveError(f"no frame at byte {at}")
    if at + size > len(data):
        raise ArchiveError(f"a frame is cut off at byte {at}")
    return size


def records(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    data, at = memoryview(archive), 0
    if bytes(data[:4]) != DICTIONARY_MAGIC:
        raise ArchiveError("no dictionary frame leads the archive")
    size = frame_size(data, 0)
    dictionary = bytes(data[8:size])
    reader = zstandard.ZstdDecompressor(**dictionary_options(dictionary))
    at = size
    while at < len(data):
        size = frame_size(data, at)
        if bytes(data[at:at + 4]) == FRAME_MAGIC:
            frame = bytes(data[at:at + size])
            out = reader.decompress(frame)  # needs the content size and, where there is one, checks the checksum
            if zstandard.frame_content_size(frame) != len(out):
                raise ArchiveError(f"the frame at byte {at} has another length")
            yield out
        at += size


def train_dictionary(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> bytes:
    """A dictionary from at most about ``DICTIONARY_PAGES`` pages (b"": none
    can be made)."""
    n = pages.count()
    share = min(1.0, DICTIONARY_PAGES / max(n, 1))
    rows = (pages.where(unit_hash(id_col, 5) < share).where(F.col(html_col).isNotNull())
            .select(F.substring(F.col(html_col).cast("binary"), 1, DICTIONARY_PAGE_BYTES).alias("h"))
            .limit(2 * DICTIONARY_PAGES).collect())
    samples = sorted(bytes(r.h) for r in rows if r.h)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, threads=0).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def dictionary_options(raw: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


def page_key(id_col: str, url_col: str):
    """A page's id as text; pages without an id are told apart by url."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("no id:"), F.xxhash64(F.col(url_col)).cast("string")))


def revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             least: int = REVISIT_BYTES) -> DataFrame:
    """(key, refers): for each page that is a revisit, the digests of its
    payloads and the pages they refer to. Only ids and digests are shuffled,
    not payloads."""
    payload = F.col(html_col).cast("binary")
    narrow = (pages.where(F.octet_length(payload) >= least)
              .select(F.col(id_col).alias("id"), page_key(id_col, url_col).alias("key"), F.sha2(payload, 256).alias("digest")))
    # null ids come before others
    first = (narrow.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.max(F.col("id").isNull()).alias("odd"))
             .where("n > 1").select("digest", F.when(~F.col("odd"), F.col("least")).alias("first")))
    return (narrow.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("first")))
            .groupBy("key").agg(F.collect_set(F.struct("digest", F.col("first").cast("string").alias("first"))).alias("refers")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", date: str = "2000-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` as archives below ``path``."""
    spark = pages.sparkSession
    bound_batches(spark)
    dictionary = train_dictionary(pages, id_col, html_col)
    shared = spark.sparkContext.broadcast(dictionary)
    size = pages.agg(F.sum(F.octet_length(F.col(html_col).cast("binary")) + 600)).first()[0] or 0
    parts = max(1, -(-size // (4 * archive_bytes)))  # html shrinks to a quarter or less
    # both sides are dealt out by the page's key, so that payloads are shuffled once, for the join and the archives
    whole = pages.select(page_key(id_col, url_col).alias("key"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    whole = whole.withColumn("digest", F.sha2("payload", 256))

    at = whole.columns.index("payload")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=PACK_LEVEL, **dictionary_options(shared.value))
        for b in batches:
            packed = pa.array([writer.compress(x) for x in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], packed, *b.columns[at + 1:]], b.schema.names)

    # payloads travel packed: a quarter of what the shuffle's own compression leaves
    whole = whole.mapInArrow(pack, whole.schema).repartition(parts, "key")
    marks = revisits(pages, id_col, url_col, html_col).repartition(parts, "key")
    rows = whole.join(marks, "key", "left")
    rows = rows.withColumn("own", F.get(F.filter("refers", lambda x: x["digest"] == F.col("digest")), F.lit(0)))
    rows = (rows.sortWithinPartitions(F.col("page_id").asc_nulls_first(), "url")
            .select(F.col("page_id").cast("string").alias("page"), "url", "payload", "digest",
                    F.coalesce(F.col("own").isNotNull() & F.col("page_id").isNotNull(), F.lit(False)).alias("revisit"),
                    F.col("own.first").alias("refers_to")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shared.value
        options = dictionary_options(raw)
        writer, reader = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **options), zstandard.ZstdDecompressor(**options)
        yield pa.RecordBatch.from_arrays([pa.array([DICTIONARY_MAGIC + len(raw).to_bytes(4, "little") + raw], pa.binary())], ["frame"])
        for whole in batches:
            for b in W.pieces(whole, "payload", 4 << 20):
                out = [writer.compress(render(r["page"], r["url"], reader.decompress(r["payload"]), r["digest"], r["refers_to"], r["revisit"], date))
                       for r in b.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    frames = rows.mapInArrow(run, "frame binary")
    (frames.select(F.col("frame").cast("string").alias("value")).write
     .option("lineSep", SEPARATOR).option("compression", "none").text(path))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``: (page_id, url, payload,
    payload_bytes, payload_digest, record_type, refers_to, archive), ids as
    strings; ``payload`` is null for revisits."""
    names = ["page_id", "url", *["payload"] * payloads, "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows, name):
            cols = [pa.array([r[k] for r in rows], kinds.get(k, pa.string())) for k in names]
            return pa.RecordBatch.from_arrays([*cols, pa.array([name] * len(rows), pa.string())], [*names, "archive"])

        for b in batches:
            for i in range(b.num_rows):
                name, rows, held = W.column(b, "path")[i].as_py(), [], 0
                try:
                    for raw in records(W.column(b, "content")[i].as_py()):
                        rows.append(parse(raw))
                        held += len(raw) if payloads else 500
                        if held > 4 << 20:
                            yield flush(rows, name)
                            rows, held = [], 0
                except (ArchiveError, zstandard.ZstdError, ValueError) as e:
                    raise ArchiveError(f"{name}, after {len(rows)} records of a batch: {e}") from e
                yield flush(rows, name)

    schema = ", ".join([*(f"{k} {'binary' if k == 'payload' else 'bigint' if k == 'payload_bytes' else 'string'}" for k in names), "archive string"])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)
