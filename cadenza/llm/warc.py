"""WARC archives of web pages, compressed by Zstandard with a dictionary of their own.

An archive is one file:

* a leading skippable frame (magic 0x184D2A5D) with the dictionary, itself a
  Zstandard frame;
* a frame per record, compressed with that dictionary and closed by a
  checksum: first a ``warcinfo`` record, then a record per page;
* an empty skippable frame (``TAIL``).

The dictionary is built from the archive's own records: about
``SAMPLE_BYTES`` of them, taken at even steps and ``SAMPLE_RECORD`` bytes of
each at most. It changes an archive's size, never its contents. Where the
records are too few to train one, their bytes are the dictionary.

Of pages with equal payloads of at least ``LEAST`` bytes the one with the
smallest page_id is a ``response`` record, the others are ``revisit`` records
without payload that refer to it. Smaller payloads are all responses.

An archive closes at ``ARCHIVE_BYTES`` of payload, so a task holds that much
and one page. Spark's text sink writes one archive a file: ``TAIL`` is plain
ASCII and serves as its line separator, so any store that Spark writes will
do, a failed task leaves nothing behind, and ``binaryFile`` reads them back.

Who is the response is settled on digests alone: minima per (digest, salt),
then per digest, dealt back to the salts in which a digest occurs. A digest
that a third of all pages share is met in ``SALTS`` parts. Only digests that
repeat are joined to the pages, broadcast or shuffled as their size tells.

Defined results: null html as empty; a null page_id or url is left out of the
record and read as null, and a null page_id is never the smallest one (pages
without any id are all responses); rows that repeat the smallest page_id are
all responses, others all revisits; an empty table gives an empty result;
other columns are dropped. Control characters and blanks of a url are
percent-encoded in the record.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import ship
from cadenza.session import materialize

#: Fixed values of the formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
TAIL = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below so many bytes are never revisits.
LEAST = 100
SALTS = 64
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 110 << 10
SAMPLE_BYTES, SAMPLE_RECORD = 2 << 20, 128 << 10
LEVEL = 3
#: The tables have no time of capture.
DATE = "1970-01-01T00:00:00Z"
#: Rows and payload bytes that a reader hands on at once.
READ_ROWS, READ_BYTES = 4096, 8 << 20

_NAMES = uuid.UUID("6d0f0e43-7c57-4f0b-9a3e-52f2d1c1a7b1")


def record_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to`` per page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha2("payload", 256), "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")})
    parts = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "salt").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # At most SALTS parts per digest.
    whole = parts.groupBy("payload_digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).where("n > 1")
    known = materialize(whole.select("payload_digest", "first", F.explode("salts").alias("salt")))
    rows = rows.join(known, ["payload_digest", "salt"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}:{digest}')}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"".join([VERSION, b"\r\n", head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block, b"\r\n\r\n"])


def _header_safe(url: str | None) -> str | None:
    return url if url is None else re.sub(r"[\x00-\x20\x7f\x85  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """The response record of a page, or its revisit record if it refers to another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    again = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if again else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _header_safe(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", PROFILE if again else None),
        ("WARC-Refers-To", _record_id(refers_to, digest) if again else None),
        ("Page-ID", page_id),
        ("Page-Refers-To", refers_to),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return _record(fields, http if again else http + payload)


def _info_record(date: str) -> bytes:
    block = b"software: cadenza\r\nformat: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, "")), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], block)


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary of some of the records, taken at even steps."""
    total = sum(min(len(r), SAMPLE_RECORD) for r in records)
    sample = [r[:SAMPLE_RECORD] for r in records[:: max(1, -(-total // SAMPLE_BYTES))]]
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, sample)) // 8))
    try:
        return zstandard.train_dictionary(size, sample, k=256, d=8)
    except zstandard.ZstdError:  # too few or too small
        return zstandard.ZstdCompressionDict(b"".join(sample)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], date: str = DATE) -> bytes:
    """The file of these records, but for its ``TAIL``, which the sink writes."""
    records = [_info_record(date), *records]
    dictionary = build_dictionary(records)
    plain = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    return b"".join([DICTIONARY_MAGIC, len(plain).to_bytes(4, "little"), plain, *map(compressor.compress, records)])


def read_dictionary(content: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of an archive and where its records begin."""
    if content[:4] != DICTIONARY_MAGIC:
        return None, 0
    end = 8 + int.from_bytes(content[4:8], "little")
    own = bytes(content[8:end])
    if own[:4] == ZSTD_MAGIC:
        own = zstandard.ZstdDecompressor().decompress(own)
    return zstandard.ZstdCompressionDict(own), end


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a file, read off the frames as a stream.

    A file without its ``TAIL`` was cut, and a stream alone wouldn't tell.
    """
    if bytes(content[-len(TAIL) :]) != TAIL.encode():
        raise ValueError("an archive ends early")
    dictionary, start = read_dictionary(content)
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(memoryview(content)[start:], read_across_frames=True), 1 << 16)
    while line := stream.readline():
        if line.rstrip(b"\r\n") != VERSION:
            raise ValueError("not a WARC record")
        fields = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record ends early")
        yield fields, block


def _page(fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(x.lower().split(": ", 1) for x in head.decode().split("\r\n")[1:])
    digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of page {fields.get('page-id')} does not match its digest")
    number = lambda x: None if x is None else int(x)
    return number(fields.get("page-id")), fields.get("warc-target-uri"), kind, number(fields.get("page-refers-to")), int(http["content-length"]), digest, payload if kind == "response" else None


READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def write_archives(pages: DataFrame, path: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> None:
    """Write a record per page into archives below ``path``; inside an archive page_id ascends."""
    ship(pages.sparkSession)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "refers_to"))):
                body = payload.as_py()
                held.append(page_record(page_id.as_py(), url.as_py(), body, digest.as_py(), refers_to.as_py(), date))
                size += len(body)
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_pydict({"archive": pa.array([archive(held, date)], pa.binary())})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"archive": pa.array([archive(held, date)], pa.binary())})

    rows = record_types(pages, least).select("page_id", "url", "payload", "payload_digest", "refers_to").sortWithinPartitions("page_id", "payload_digest")
    files = rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    files.write.mode("overwrite").option("lineSep", TAIL).option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per page record of the archives below ``path``; the payload is null for revisits, and throughout if not asked for."""
    ship(spark)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for fields, block in records(content.as_buffer()):
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    row = _page(fields, block)
                    rows.append(row if payloads else (*row[:-1], None))
                    size += len(block) if payloads else 0
                    if len(rows) >= READ_ROWS or size >= READ_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    return spark.read.format("binaryFile").load(path).select("content").where("length > 0").mapInArrow(run, READ)


SQL = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
r AS (SELECT *, payload_bytes >= {LEAST} AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM r"""
