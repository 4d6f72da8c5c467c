"""WARC archives, compressed record by record with a Zstandard dictionary made from the records.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary; every record is a frame of its
own, so any record can be read alone once the dictionary is known. Equal payloads are stored once: the first is a
response, the others are revisits that refer to it.

Archives are written by tasks into a folder that all executors reach; each attempt writes files of its own, and only those
that a finished task reports are listed in the table ``manifest`` beside them, which readers follow.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.words import chunks, column

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
# The dictionary is trained on about so many pieces, drawn evenly from all payloads by hash.
SAMPLE_PIECES, PIECE_BYTES = 1024, 4096
# Payloads below this size are not worth a reference.
LEAST_REVISIT_BYTES = 100
ARCHIVE_BYTES = 1 << 30
# Tasks that read archives, at most; beyond that a task reads several.
MOST_READERS = 30_000
LEVEL = 3
_BREAK = b"\r\n"


def train_dictionary(pages: DataFrame, payload: str, size: int = DICTIONARY_BYTES, pieces: int = SAMPLE_PIECES) -> bytes:
    """A dictionary from a bounded, evenly drawn sample of the pieces of all payloads; empty if there is too little.

    Every distinct piece of every payload has the same chance: those are taken whose digest is below a bound, which
    follows from the number of all pieces and the number wanted. Each is sent once, so the driver gets about ``pieces``
    of them whatever the number of tasks, and never more than twice as many.
    """
    payloads = pages.select(F.col(payload).cast("binary").alias("payload"))
    total = payloads.agg(F.coalesce(F.sum(F.ceil(F.octet_length("payload") / PIECE_BYTES)), F.lit(0))).first()[0]
    bound = min(1 << 64, (1 << 64) * pieces // max(1, total))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "payload"):
            found: dict[bytes, bytes] = {}
            for value in column(batch, "payload").to_pylist():
                for at in range(0, len(value or b""), PIECE_BYTES):
                    piece = value[at : at + PIECE_BYTES]
                    place = hashlib.blake2b(piece, digest_size=8).digest()
                    if int.from_bytes(place, "big") < bound:
                        found[place] = piece
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["place", "piece"])

    drawn = payloads.mapInArrow(draw, "place binary, piece binary").groupBy("place").agg(F.first("piece").alias("piece"))
    samples = [bytes(r["piece"]) for r in sorted(drawn.limit(2 * pieces).collect(), key=lambda r: bytes(r["place"]))]
    if sum(map(len, samples)) < 8 * 256 or len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:  # too uniform or too small to train on
        return b""


def record(kind: str, key: str, url: str, payload: bytes, digest: str, refers_to: str | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record, archived at ``date``; a revisit carries no payload but the length and digest of the one it refers to."""
    block = payload if kind == "response" else b""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{key}>", f"WARC-Date: {date}", "Content-Type: text/html; charset=utf-8",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + _BREAK * 2


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(_BREAK * 2)
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[length:] != _BREAK * 2:
        raise ValueError("not a WARC record")
    return fields, rest[:length]


class ArchiveWriter:
    """One archive: the dictionary frame, then a frame per record."""

    def __init__(self, path: str, dictionary: bytes, level: int = LEVEL):
        filesystem, inner = pa.fs.FileSystem.from_uri(path)
        self.path, self.records, self.size = path, 0, 0
        self.out = filesystem.open_output_stream(inner, compression=None)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.compressor.compress(data))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.size


def read_archive(path: str, block: int = 1 << 20) -> Iterator[bytes]:
    """The records of one archive, decompressed, one at a time."""
    filesystem, inner = pa.fs.FileSystem.from_uri(path)
    with filesystem.open_input_stream(inner, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != DICTIONARY_MAGIC:
            raise ValueError(f"{path} has no dictionary frame")
        dictionary = source.read(size)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        decompressor = zstandard.ZstdDecompressor(dict_data=known)
        data = b""
        while True:
            more = data or source.read(block)
            if not more:
                return
            frame, parts = decompressor.decompressobj(), []
            while True:
                parts.append(frame.decompress(more))
                if frame.eof:
                    break
                more = source.read(block)
                if not more:
                    raise ValueError(f"{path} ends inside a record")
            data = frame.unused_data
            yield b"".join(parts)


def with_references(pages: DataFrame, page_id: str, url: str, html: str, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses).

    Of equal payloads of at least ``least`` bytes, all rows with the smallest id are responses, so repeated rows of it
    are alike; null ids come last. Groups of equal payloads are found by digest with partial aggregation. The payloads
    that a thousandth of all rows share are looked up by broadcast, there being at most a thousand of them, and their rows
    stay spread; the rest meets by digest.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    groups = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    n_rows = pages.count()
    hot = groups.where(F.col("n") * 1000 > n_rows).select(F.col("digest").alias("hot_digest"), F.col("first").alias("hot_first"))
    marked = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
    cold = groups.where(F.col("n") * 1000 <= n_rows).select(F.col("digest").alias("cold_digest"), F.col("first").alias("cold_first"))
    # A hot row's key is one that no cold group has, and is as varied as the rows.
    key = F.when(F.col("hot_digest").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    found = marked.withColumn("key", key).join(cold, F.col("key") == F.col("cold_digest"), "left")
    first = F.coalesce("hot_first", "cold_first")
    return found.select("page_id", "url", "payload", "digest", F.when(first != F.coalesce("page_id", first - 1), first).alias("refers_to"))


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive every row of ``pages`` and return the manifest: path, records, bytes of each archive.

    The payload is the html in UTF-8, empty for a null. An empty table makes no archive. ``folder`` is a URI or path that
    all executors reach; columns other than the three are not archived.
    """
    spark = pages.sparkSession
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    folder = folder.replace("file:///", "file:/").replace("file:/", "file:///")
    dictionary = train_dictionary(pages, html)
    rows = with_references(pages, page_id, url, html)
    # One time for all records, so a task that runs again writes the same.
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in chunks(batches, "payload"):
            for row in batch.to_pylist():
                if writer and writer.size >= archive_bytes:
                    done.append(writer.close())
                    writer = None
                writer = writer or ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst", dictionary)
                key = "" if row["page_id"] is None else str(row["page_id"])
                refers = row["refers_to"]
                address = " ".join(row["url"].split())  # a header is one line
                writer.add(record("response" if refers is None else "revisit", key, address, row["payload"], row["digest"], str(refers), date))
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[], [], []], (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "records", "bytes"])

    filesystem, inner = pa.fs.FileSystem.from_uri(folder)
    filesystem.create_dir(inner, recursive=True)
    rows.mapInArrow(archive, "path string, records bigint, bytes bigint").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of a folder's archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The length and digest of a response are computed from what is read and held against its header; those of a revisit
    come from its header, and its payload is null. Damaged archives fail.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def number(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in column(batch, "path").to_pylist():
                for data in read_archive(path):
                    fields, payload = parse(data)
                    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(fields["X-Payload-Length"])):
                        raise ValueError(f"a record of {path} differs from its digest")
                    rows.append((number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, kind, number(fields.get("WARC-Refers-To")), payload if kind == "response" else None))
                    size += len(payload)
                    if size > 4 << 20 or len(rows) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    # An archive per task; the manifest has a row per archive, so numbering it is small work. Empty without archives.
    tasks = max(1, min(manifest.count(), MOST_READERS))
    dealt = manifest.select("path", ((F.row_number().over(Window.orderBy("path")) - 1) % tasks).cast("int").alias("task"))
    return dealt.repartitionById(tasks, F.col("task")).select("path").mapInArrow(extract, schema)
