"""WARC archives of individually compressed records with a Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyforge.llm.hash_tables import new_folder, open_file, write_file
from tidyforge.llm.links import split_join

LEAST_REVISIT = 1000         # bytes from which an equal payload is archived once
SAMPLE = 1000                # records the dictionary is trained on, about
SAMPLE_BYTES = 16 << 10      # of each of them
DICTIONARY_BYTES = 64 << 10
FILE_BYTES = 256 << 20       # an archive file is ended when it has so many
DATE = "2024-01-01T00:00:00Z"

# Constants of the two formats (fixed values).
_DICTIONARY_FRAME = 0x184D2A5D
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 15              # bytes of an archive read at once
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _record_id(page_id) -> str:
    return f"<{uuid.uuid5(_SPACE, f'page:{page_id}').urn}>"


def record(kind: str, page_id, url, payload: bytes, digest: str, refers_to=None,
           date: str = DATE) -> bytes:
    """One record: headers, an HTTP response as its block, and for a response the payload.

    ``digest`` is the SHA-1 of the payload in hex.  The block of a revisit is the HTTP header
    alone, whose Content-Length still tells the size of the payload.
    """
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
            "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                     html: str = "html") -> bytes:
    """A dictionary from records of about ``SAMPLE`` pages, chosen by a hash of their id.

    Sample and dictionary have a fixed size.  With too few records to train on, the records
    themselves are the dictionary's content; without any it is empty.
    """
    share = max(1, -(-pages.count() // SAMPLE))
    rows = pages.where(F.pmod(F.xxhash64(F.col(f"`{page_id}`")), F.lit(share)) == 0).select(
        F.col(f"`{page_id}`"), F.col(f"`{url}`"),
        F.substring(F.col(f"`{html}`").cast("string"), 1, SAMPLE_BYTES)).limit(2 * SAMPLE).collect()
    samples = []
    for number, address, text in rows:
        payload = (text or "").encode()
        samples.append(record("response", number, address, payload,
                              hashlib.sha1(payload).hexdigest()))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def with_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``pages`` with ``payload``, ``digest``, ``kind`` and ``refers_to`` for the writer.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes those with the largest page_id are
    responses and the others revisit them; all smaller ones are responses.  Payloads are equal
    if their SHA-1 and length are.  A missing page has an empty payload; a missing page_id counts
    as the smallest, and payloads that have no other id are all responses.  Rows that share
    page_id and payload are written alike, under one record id.  A payload that very many pages
    have is split between tasks by the join.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.withColumn("payload", payload).withColumns(
        {"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    rows = rows.withColumn("same", F.concat_ws(":", "digest", F.col("bytes").cast("string")))
    groups = rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("same").agg(
        F.max(f"`{page_id}`").alias("newest"), F.count("*").alias("members"))
    groups = groups.where("members > 1 AND newest IS NOT NULL").drop("members")
    own = F.col(f"`{page_id}`")
    newer = F.col("newest").isNotNull() & ~own.eqNullSafe(F.col("newest"))
    return split_join(rows, groups, "same", "left").withColumns({
        "kind": F.when(newer, F.lit("revisit")).otherwise(F.lit("response")),
        "refers_to": F.when(newer, F.col("newest"))}).drop("newest", "bytes", "same")


def write_archives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id",
                   url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """Write every page into archives below ``folder``; ``path``, ``records``, ``bytes`` of each.

    A file starts with a skippable frame that holds the dictionary; each record follows as a
    frame of its own.  Every task writes its own files, whole or not at all and under names that
    a repeated task uses again.  Missing urls have no target header.  An empty table gives no
    file.  The folder defaults to a new one below ``spark.checkpoint.dir``.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"),
                        F.col(f"`{url}`").cast("string").alias("url"),
                        F.col(f"`{html}`").cast("string").alias("html"))
    dictionary = train_dictionary(rows)
    ready = with_revisits(rows).select("kind", "page_id", "url", "payload", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, task = [], TaskContext.get().partitionId()
        records = (r for batch in batches for i in range(batch.num_rows)
                   for r in batch.slice(i, 1).to_pylist())
        first = next(records, None)
        while first is not None:
            path = f"{folder}/pages-{task:06d}-{len(files):04d}.warc.zst"
            told = {"path": path, "records": 0, "bytes": 0}
            rest = [first]
            write_file(path, _frames(rest, records, dictionary, date, told))
            files.append(told)
            first = rest[0] if rest else None
        yield pa.RecordBatch.from_pylist(files, _FILES)

    written = ready.mapInArrow(write, "path string, records long, bytes long")
    told = new_folder(spark, "warc-files")
    written.write.parquet(told)
    return spark.read.schema(written.schema).parquet(told)


_FILES = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def _frames(rest: list, records: Iterator[dict], dictionary: bytes, date: str,
            told: dict) -> Iterator[bytes]:
    """Frames of one file; ``rest`` has its first record and gets the next file's, if any."""
    yield struct.pack("<II", _DICTIONARY_FRAME, len(dictionary)) + dictionary
    packer = zstandard.ZstdCompressor(level=3, dict_data=_usable(dictionary), write_checksum=True)
    row = rest.pop()
    while row is not None:
        frame = packer.compress(record(row["kind"], row["page_id"], row["url"], row["payload"],
                                       row["digest"], row["refers_to"], date))
        told["records"] += 1
        told["bytes"] += len(frame)
        yield frame
        row = next(records, None)
        if row is not None and told["bytes"] >= FILE_BYTES:
            rest.append(row)
            return


def _usable(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def read_file(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive file.

    One frame is read at a time; a file that ends inside a frame is an error.
    """
    with open_file(path) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != _DICTIONARY_FRAME:
            raise ValueError(f"{path} does not start with a dictionary")
        unpacker = zstandard.ZstdDecompressor(dict_data=_usable(source.read(size)))
        held = source.read(_READ)
        while held:
            frame, parts = unpacker.decompressobj(), []
            while not frame.eof:
                if not held:
                    raise ValueError(f"{path} ends inside a record")
                parts.append(frame.decompress(held))
                held = frame.unused_data if frame.eof else source.read(_READ)
            held = held or source.read(_READ)
            head, block = b"".join(parts).split(b"\r\n\r\n", 1)
            headers = dict((k.lower(), v.strip()) for k, v in (
                line.split(":", 1) for line in head.decode().split("\r\n")[1:]))
            yield headers, block[:int(headers["content-length"])]


def read_archives(files: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``record_type``, ``payload``, ``payload_bytes``, ``payload_digest``
    and ``refers_to`` of every record of the files in column ``path``.

    The payload of a revisit is missing; its size and digest are those of the full payload.  A
    payload that does not have the digest in its header is an error.
    """
    schema = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
              "payload_digest string, refers_to long")
    fields = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for path in batch.column(0):
                for headers, block in read_file(path.as_py()):
                    held.append(_parsed(headers, block))
                    size += len(block)
                    if size >= 1 << 23:
                        yield pa.RecordBatch.from_pylist(held, fields)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, fields)

    paths = files.select("path")
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(read, schema)


def _parsed(headers: dict[str, str], block: bytes) -> dict:
    head, payload = block.split(b"\r\n\r\n", 1)
    digest = base64.b32decode(headers["warc-payload-digest"].split(":", 1)[1]).hex()
    kind = headers["warc-type"]
    if kind == "revisit":
        size = int(dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])[
            "Content-Length"])
    else:
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"wrong payload digest in {headers['warc-record-id']}")
    number, other = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
    return {"page_id": None if number is None else int(number),
            "url": headers.get("warc-target-uri"), "record_type": kind,
            "payload": None if kind == "revisit" else payload, "payload_bytes": size,
            "payload_digest": digest, "refers_to": None if other is None else int(other)}
