"""WARC archives compressed record by record with an embedded Zstandard dictionary.

Each archive is a `.warc.zst` stream: a leading skippable frame (magic 0x184D2A5D) holds a dictionary trained on
archived records, and every WARC record is a Zstandard frame of its own, so a record can be read by its offset.
Spark's text sink writes the archives to any store that Spark can write: its line separator is an empty skippable
frame, which Zstandard readers pass over. Spark's binaryFile source reads them back.

Records with equal payloads: the smallest key is a `response`, the others `revisit` it. The group's minimum comes
from two aggregations (by digest and salt, then by digest), and its join is salted too, so a group that holds a
third of all rows is spread over SALTS tasks. Null payloads count as empty; a null key sorts after all others. Rows that
repeat a key each get a record with an id of its own, and equal pages under the same smallest key are all responses. A
page of any length is one record, whole; archives end before they pass ARCHIVE_BYTES, but for a longer record.
Columns other than page_id, url and html are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_rows, scratch

SALTS = 64
#: Fixed values of the Zstandard and WARC-in-Zstandard formats.
DICTIONARY_MAGIC, SKIPPABLE, FRAME_MAGIC = 0x184D2A5D, range(0x184D2A50, 0x184D2A60), 0xFD2FB528
#: An empty skippable frame; plain ASCII, so that it can be a line separator.
SEPARATOR = "P*M\x18\0\0\0\0"
#: Bounds of the dictionary's training sample (whole records, of pages up to a size) and of the dictionary.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 131_072, 65_536
#: Compressed bytes of an archive.
ARCHIVE_BYTES = 1 << 24

_OUT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, archive string, byte_start long, byte_size long, intact boolean"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(name: str, kind: str, key: int | None, url: str | None, payload: bytes, sha1: str, size: int, refers_to: int | None, target: str | None = None) -> bytes:
    """One WARC/1.1 record under a unique name. Revisits carry the digest and the length but not the payload, and the response's address."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"X-Page-Id: {'' if key is None else key}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To-Target-URI: {' '.join((target or '').split())}", f"X-Refers-To-Page-Id: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def frames(data: bytes, reader) -> Iterator[tuple[int, int, bytes]]:
    """(start, size, content) of each Zstandard frame in a `.warc.zst` stream; takes the dictionary from its front."""
    import zstandard

    at, dctx = 0, reader
    while at + 8 <= len(data):
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic in SKIPPABLE:
            size = int.from_bytes(data[at + 4 : at + 8], "little")
            if magic == DICTIONARY_MAGIC and at == 0 and size:
                dctx = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            one = dctx.decompressobj()
            content = one.decompress(memoryview(data)[at : at + _bound(data, at)])
            used = _bound(data, at) - len(one.unused_data)
            yield at, used, content
            at += used
        else:
            raise ValueError(f"no Zstandard frame at {at}")


def _bound(data: bytes, at: int) -> int:
    """The frame's size from its header and block headers."""
    flags = data[at + 4]
    single, has_sum = flags >> 5 & 1, flags >> 2 & 1
    pos = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((single, 2, 4, 8)[flags >> 6])
    while True:
        head = int.from_bytes(data[pos : pos + 3], "little")
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return pos + 4 * has_sum - at


def train(samples: list[bytes]) -> bytes:
    """A dictionary from records; empty where there are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def firsts(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Pages with sha1, salt, and `first` and `target`: the smallest key among the records with an equal payload, and its address."""
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    pages = pages.withColumn("sha1", F.unhex(F.sha1(F.col("html").cast("binary")))).withColumn("salt", salt)
    small = pages.where(F.octet_length("html") >= min_bytes).groupBy("sha1", "salt").agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("target"), F.count("*").alias("n"))
    groups = small.groupBy("sha1").agg(F.min("first").alias("first"), F.min_by("target", "first").alias("target"), F.sum("n").alias("n"), F.collect_set("salt").alias("salts")).where("n > 1")
    return pages.join(groups.select("sha1", "first", "target", F.explode("salts").alias("salt")), ["sha1", "salt"], "left")


def write(pages: DataFrame, path: str, min_bytes: int = 0, level: int = 3) -> None:
    """Writes (page_id, url, html) as archives below `path`: a task's records in as many as their size asks for."""
    spark = pages.sparkSession
    count = pages.count()
    rate = min(1.0, SAMPLE_RECORDS / max(1, count))
    sample = pages.where(F.octet_length("html") <= SAMPLE_BYTES).where(F.pmod(F.xxhash64("page_id", F.lit(7)), F.lit(1_000_000)) < int(rate * 1_000_000)).select("page_id", "url", "html").limit(SAMPLE_RECORDS)
    samples = [record(f"{k}", "response", k, u, (h or "").encode(), digest((h or "").encode()), len((h or "").encode()), None) for k, u, h in sample.collect()]
    dictionary = spark.sparkContext.broadcast(train(samples))
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        known = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        press = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True, write_checksum=True)

        lead = DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary.value).to_bytes(4, "little") + dictionary.value
        task, n = TaskContext.get().partitionId(), 0

        def rows():
            nonlocal n
            held, size = [lead], 0
            for batch in batches:
                for key, url, sha1, first, target, html in zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5).cast(pa.binary())):
                    payload = html.as_py() or b""
                    kind = "response" if first is None or first == key else "revisit"
                    frame = press.compress(record(f"{run_id}/{task}/{n}", kind, key, url, payload, base64.b32encode(sha1).decode(), len(payload), first, target))
                    n += 1
                    if size and size + len(frame) > ARCHIVE_BYTES:
                        yield (b"".join(held),)
                        held, size = [lead], 0
                    held.append(frame)
                    size += len(frame)
            if size:
                yield (b"".join(held),)

        yield from arrow_rows(rows(), pa.schema([("archive", pa.binary())]), 1)

    out = firsts(pages, min_bytes).select("page_id", "url", "sha1", "first", "target", "html").mapInArrow(run, "archive binary")
    # a row is a whole archive and a file holds one row
    out.select(F.col("archive").cast("string")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


def read(spark, path: str) -> DataFrame:
    """Every record of the archives below `path`, with its archive and byte range. Digest and length are those of the payload that is read (of a revisit, those of its header); `intact` tells whether they are what the header says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def rows():
            for batch in batches:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for start, size, raw in frames(content.as_py(), zstandard.ZstdDecompressor()):
                        h, payload = parse_record(raw)
                        revisit, sha1 = h["WARC-Type"] == "revisit", h["WARC-Payload-Digest"].removeprefix("sha1:")
                        said = int(h["X-Payload-Length"]), sha1
                        found = said if revisit else (len(payload), digest(payload))
                        yield int(h["X-Page-Id"]) if h["X-Page-Id"] else None, *found, h["WARC-Type"], int(h["X-Refers-To-Page-Id"]) if revisit else None, h["WARC-Record-ID"], name, start, size, found == said

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        yield from arrow_rows(rows(), pa.schema([(c.split()[0], t) for c, t in zip(_OUT.split(", "), kinds)]))

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _OUT)


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes `pages` as archives and returns what reading them back gives."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    path = path or scratch(spark, "warc")
    write(pages, path, min_bytes)
    return read(spark, path)
