"""WARC archives with a shared dictionary (operator 2).

Writer: a Zstandard dictionary is built from a bounded sample of records; every archive starts with
a skippable frame that holds it, and every record is a Zstandard frame of its own.  Of records with
equal payloads of ``MIN_REVISIT`` bytes or more, the one with the smallest page_id is a response and
the others are revisit records without the payload.

Spark writes the archives: rows are frames, and Spark's text writer sets them one after another
with an empty skippable frame as the separator, which readers of Zstandard streams pass over.  So
archives go to any store that Spark writes to, and a lost task is simply written again.

Reader: each archive is read as a whole (the writer bounds its size), its leading dictionary is
loaded, and records are decompressed one by one; a response whose payload doesn't have the digest
in its header raises.

Defined cases.  A null html is an empty payload.  A null url is left out; line breaks in a url are
percent-encoded.  Repeated rows are records of their own: rows equal in payload and page_id to the
smallest are all responses.  A row without page_id comes after all others, and refers to the
smallest page_id there is.  Extra columns are not looked at.  Without rows no archive is written
and reading gives no rows.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch_dir
from .tables import kept, table

MIN_REVISIT = 100
#: Payload bytes that an archive aims at.
ARCHIVE_BYTES = 32 << 20
#: Bounds of the dictionary's sample: records, and bytes of each.
SAMPLE_RECORDS = 512
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
# Frame signs of the Zstandard format; the dictionary's sign is that of WARC files.
_FRAME = 0xFD2FB528
_DICTIONARY = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
#: An empty skippable frame, all of whose bytes are ASCII.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    name = uri.rpartition(":")[2].rstrip(">")
    return None if name == "none" else int(name)


def record(page_id, url, payload: bytes, digest: str, response: bool, refers_to) -> bytes:
    """One WARC record, headers and block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if response else http
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: {_uri(page_id)}"]
    if url is not None:
        clean = url.replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {clean}")
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if not response:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return {"headers": headers, "block": rest[: int(headers["content-length"])]}


def train(samples: list[bytes]) -> bytes:
    """Dictionary bytes, or none when the samples are too few to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame; its content is itself compressed, as WARC readers allow."""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", _DICTIONARY, len(body)) + body


def _compressor(dictionary: bytes, level: int):
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=True)


def _frames(dictionary: bytes):
    separator = SEPARATOR.encode("ascii")

    def run(batches):
        levels = [_compressor(dictionary, level) for level in (LEVEL, LEVEL + 1, 1)]
        first = bool(dictionary)
        for batch in batches:
            out = []
            if first and batch.num_rows:
                out.append(dictionary_frame(dictionary))
                first = False
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "response", "refers_to")]
            for page_id, url, html, digest, response, refers_to in zip(*columns, strict=True):
                data = record(page_id, url, html or b"", digest, response, refers_to)
                frame = next(f for f in (c.compress(data) for c in levels) if separator not in f)
                out.append(frame)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    return run


def records_in(archive: bytes):
    """The records of an archive, decompressed one by one."""
    view, at, reader = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        (sign,) = struct.unpack_from("<I", view, at)
        if sign in _SKIPPABLE:
            (size,) = struct.unpack_from("<I", view, at + 4)
            if sign == _DICTIONARY:
                body = bytes(view[at + 8 : at + 8 + size])
                if struct.unpack_from("<I", body)[0] == _FRAME:
                    body = zstandard.ZstdDecompressor().decompress(body)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
            continue
        if sign != _FRAME:
            raise ValueError(f"no Zstandard frame at byte {at}")
        one, parts = reader.decompressobj(), []
        while not one.eof:
            piece = view[at : at + 16_384]
            if not len(piece):
                raise ValueError("the archive ends within a record")
            parts.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        yield b"".join(parts)


def _read(batches, payloads: bool):
    for batch in batches:
        rows = []
        for archive in batch.column("content"):
            for data in records_in(archive.as_py()):
                r = parse(data)
                h = r["headers"]
                http, _, payload = r["block"].partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length:")[2])
                digest = h["warc-payload-digest"].removeprefix("sha256:")
                response = h["warc-type"] == "response"
                if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"{h['warc-record-id']}: the payload is not the one written")
                refers = None if response else _page(h["warc-refers-to"])
                rows.append((_page(h["warc-record-id"]), h.get("warc-target-uri"), size, digest, h["warc-type"], refers, payload if payloads else None))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
        )


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes ``pages`` (page_id, url, html) as archives below ``path``.

    Digests are made in a first scan; only they are shuffled to find equal payloads, combined
    before the shuffle.  The html is shuffled once, by page and digest, into as many parts as give
    archives of ``ARCHIVE_BYTES``.
    """
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    seen = kept(rows.select("page_id", "digest", F.octet_length("html").cast("bigint").alias("size")), "digests")
    total = seen.agg(F.sum("size").alias("bytes")).first()["bytes"]
    if total is None:
        rows.select("url").write.text(path)
        return
    chosen = [r["page_id"] for r in seen.select("page_id").distinct().orderBy(F.xxhash64("page_id")).limit(SAMPLE_RECORDS).collect()]
    sample = rows.filter(F.col("page_id").isin([c for c in chosen if c is not None]))
    sample = sample.dropDuplicates(["page_id"]).select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html"), "digest")
    dictionary = train([record(r["page_id"], r["url"], bytes(r["html"]), r["digest"], True, None) for r in sample.collect()])

    equal = seen.filter(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    equal = equal.filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    revisits = seen.select("page_id", "digest").distinct().join(equal, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first")))
    revisits = revisits.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")).alias("key"), "digest", F.col("first").alias("refers_to")
    )
    parts = max(1, -(-total // ARCHIVE_BYTES))
    keyed = rows.withColumn("key", F.coalesce(F.col("page_id").cast("string"), F.lit("none")))
    keyed = keyed.repartition(parts, "key", "digest").join(revisits, ["key", "digest"], "left")
    keyed = keyed.select("page_id", "url", "html", "digest", F.col("refers_to").isNull().alias("response"), "refers_to")
    frames = keyed.mapInArrow(_frames(dictionary), "frame binary")
    # Bytes as they are: the writer copies them, and the separator is a frame of its own.
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to and
    the payload itself (empty for revisits; null when only the digests are asked for)."""
    kinds = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(lambda batches: _read(batches, payloads), kinds)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = new_scratch_dir(spark, "llm-warc")
    write_archives(pages, path)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read_archives(spark, path, payloads=False).select(*names)


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT *, CASE WHEN n >= {MIN_REVISIT} THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS f FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to
FROM f
"""
