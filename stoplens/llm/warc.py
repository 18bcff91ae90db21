"""Zstandard web archives: one frame per record, dictionary in the leading skippable frame.

Archives are written and read by Spark's own file sources, so they may lie in any
store Spark reaches. An archive is one row of bytes, closed by an empty skippable
frame, which the text writer puts where it would end a line.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import staged

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC, SKIPPABLE_MASK = 0x184D2A50, 0xFFFFFFF0
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

MIN_REVISIT_BYTES = 100
# Uncompressed bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLE_PAGES = 200
DATE = "2024-01-01T00:00:00Z"

RECORDS = (
    "record_id string, record_type string, target_uri string, refers_to_id string, date string, "
    "payload_bytes bigint, payload_digest string, payload binary, error string"
)


class ArchiveError(ValueError):
    """What is wrong with an archive or a record."""


# --- records ----------------------------------------------------------------


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None or pd.isna(page_id) else int(page_id)}>"


def _header_safe(url: str | None, page_id) -> str:
    from urllib.parse import quote

    return quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else _urn(page_id)[1:-1]


def build_record(page_id, url, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """A response record, or a revisit of page ``refers_to`` that leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None and not pd.isna(refers_to)
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_header_safe(url, page_id)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ArchiveError("header line without a name")
        found[name.decode("utf-8", "replace").strip()] = value.decode("utf-8", "replace").strip()
    return found


def _length(text: str | None) -> int:
    if text is None or not text.isdigit():
        raise ArchiveError("length that is no number")
    return int(text)


def parse_record(record: bytes) -> tuple:
    """The row of RECORDS for a record, its headers, lengths and digest checked."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not lines[0].startswith(b"WARC/1."):
        raise ArchiveError("no record header")
    fields = _fields(lines[1:])
    if missing := [x for x in REQUIRED if x not in fields]:
        raise ArchiveError(f"no {missing[0]}")
    size = _length(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError("block of another length than stated")
    http, blank, payload = rest[:size].partition(b"\r\n\r\n")
    status = http.split(b"\r\n")
    if not blank or not status[0].startswith(b"HTTP/"):
        raise ArchiveError("no HTTP header")
    stated = _length(_fields(status[1:]).get("Content-Length"))
    kind, digest = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "").removeprefix("sha256:")
    if kind == "response":
        if len(payload) != stated:
            raise ArchiveError("payload of another length than stated")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ArchiveError("payload of another digest than stated")
    elif kind == "revisit":
        if payload or "WARC-Refers-To" not in fields:
            raise ArchiveError("revisit with a payload or without a target")
        payload = None
    else:
        raise ArchiveError(f"record of type {kind}")
    return (
        fields["WARC-Record-ID"],
        kind,
        fields.get("WARC-Target-URI"),
        fields.get("WARC-Refers-To"),
        fields["WARC-Date"],
        stated,
        digest,
        payload,
        None,
    )


# --- frames -----------------------------------------------------------------


def frame_end(data: memoryview, start: int) -> int:
    """Where the frame that starts at ``start`` ends, from its headers and those of its blocks."""
    try:
        magic = struct.unpack_from("<I", data, start)[0]
        if magic & SKIPPABLE_MASK == SKIPPABLE_MAGIC:
            end = start + 8 + struct.unpack_from("<I", data, start + 4)[0]
        elif magic == FRAME_MAGIC:
            flags = data[start + 4]
            single = flags >> 5 & 1
            size_bytes = (single, 2, 4, 8)[flags >> 6]
            end = start + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + size_bytes
            last = 0
            while not last:
                block = int.from_bytes(data[end : end + 3], "little")
                if end + 3 > len(data):
                    raise ArchiveError("frame cut short")
                last, kind, size = block & 1, block >> 1 & 3, block >> 3
                end += 3 + (1 if kind == 1 else size)
            end += 4 * (flags >> 2 & 1)
        else:
            raise ArchiveError("no frame where one should start")
    except (struct.error, IndexError) as e:
        raise ArchiveError("frame cut short") from e
    if end > len(data):
        raise ArchiveError("frame cut short")
    return end


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def read_records(archive: bytes) -> Iterator[tuple]:
    """Rows of RECORDS. A bad record gives a row with its error; broken frames end the archive so."""
    import zstandard

    failed = (None,) * 8
    data, at, decoder = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = frame_end(data, at)
        except ArchiveError as e:
            yield (*failed, f"{e} at byte {at}")
            return
        magic = struct.unpack_from("<I", data, at)[0]
        try:
            if magic == DICTIONARY_MAGIC and at == 0:
                content = bytes(data[8:end])
                if content[:4] == struct.pack("<I", FRAME_MAGIC):
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            elif magic == FRAME_MAGIC:
                yield parse_record(decoder.decompressobj().decompress(data[at:end]))
        except (ArchiveError, zstandard.ZstdError) as e:
            yield (*failed, f"{e} at byte {at}")
        at = end


# --- jobs -------------------------------------------------------------------


def train_dictionary(pages: DataFrame, pages_used: int = SAMPLE_PAGES, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``pages_used`` pages of up to 64 kB; empty without pages.

    It changes the size of archives, not what is read from them.
    """
    import zstandard

    short = pages.where(F.octet_length("html").between(1, 64 << 10)).select("html").limit(pages_used)
    samples = [r["html"].encode() for r in short.collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on: their text serves as it is
        return b"".join(samples)[-size:]


def _deduplicated(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= MIN_REVISIT_BYTES
    firsts = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = staged(firsts.where("n > 1").select(F.col("digest").alias("key"), "first"), "payloads")
    # Small payloads, such as the empty one, are no copies of each other: keys of their own.
    key = F.when(large, F.col("digest")).otherwise(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    joined = rows.withColumn("key", key).join(firsts, "key", "left")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    refers_to = F.when(F.col("first").isNotNull() & later, F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))


def write_archives(
    pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE, level: int = 3
) -> None:
    """A record per row of ``pages`` (page_id, url, html), in archives below ``path``.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least
    100 bytes, rows with the smallest page_id are responses and the others revisits of
    it; rows without a page_id revisit the rest, and are responses among themselves.
    """
    dictionary = train_dictionary(pages)

    def archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        lead = [dictionary_frame(dictionary)] if dictionary else []
        frames, held = list(lead), 0
        for batch in batches:
            for row in zip(*(batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                record = build_record(row[0], row[1], bytes(row[2]), row[3], row[4], date)
                frames.append(encoder.compress(record))
                held += len(record)
                if held >= archive_bytes:
                    yield pd.DataFrame({"archive": [b"".join(frames)]})
                    frames, held = list(lead), 0
        if held:
            yield pd.DataFrame({"archive": [b"".join(frames)]})

    files = _deduplicated(pages).mapInPandas(archives, "archive binary")
    (
        files.select(F.col("archive").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_FRAME)
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row per record of the archives below ``path``, or per fault, with ``error`` set.

    payload_bytes and payload_digest are those of the full payload, for revisits too;
    ``payload`` is null for revisits, and for all without ``payload``.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        for batch in batches:
            for archive in batch["content"]:
                rows = []
                for row in read_records(bytes(archive)):
                    rows.append(row if payload else (*row[:7], None, row[8]))
                    if len(rows) == 512:
                        yield _frame(rows, names)
                        rows = []
                if rows:
                    yield _frame(rows, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(records, RECORDS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names, dtype="object")
    out["payload_bytes"] = out["payload_bytes"].astype("Int64")
    return out
