"""WARC archives with a Zstandard dictionary in front and each record compressed on its own."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barproof.llm.rolling import chunks
from barproof.session import materialize, new_path

#: Fixed values of the format: magic numbers of skippable frames, and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
PADDING_MAGIC = 0x184D2A50
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A skippable frame without content. Spark's text writer puts it after each record.
PADDING = struct.pack("<II", PADDING_MAGIC, 0).decode("ascii")

#: Payloads shorter than this are never revisits.
LEAST_BYTES = 1000
#: Bytes of payload an archive holds, about, and at most if all of its payloads were the largest one.
ARCHIVE_BYTES, MOST_BYTES = 64 << 20, 1 << 30
#: Bytes that a record's headers take, about.
HEADER_BYTES = 512
#: Bytes of payloads that a task has in Python at a time, besides one Arrow batch.
HELD_BYTES = 4 << 20
#: The sample that the dictionary is built from: records, and bytes of each; bytes of the dictionary.
SAMPLE_RECORDS = 512
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"


def _header_text(value: object) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One record. A revisit (``refers_to`` is not None) has the payload's headers only."""
    revisit = refers_to is not None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([] if url is None else [f"WARC-Target-URI: {_header_text(url)}"]),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def records(archive: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive in turn: headers by lower-case name, and the block."""
    if not len(archive):
        return
    archive = memoryview(archive)
    magic, length = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("archive without a leading dictionary")
    dictionary = zstandard.ZstdCompressionDict(bytes(archive[8 : 8 + length])) if length else None
    frames = zstandard.ZstdDecompressor(dict_data=dictionary)
    with frames.stream_reader(archive[8 + length :], read_across_frames=True) as raw:
        stream = io.BufferedReader(raw, 1 << 20)
        while first := stream.readline():
            if first != b"WARC/1.1\r\n":
                raise ValueError(f"not a record: {first[:40]!r}")
            headers = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.decode().partition(":")
                headers[name.lower()] = value.strip()
            block = stream.read(int(headers["content-length"]))
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError("record cut short")
            yield headers, block


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary trained on samples of records, or none if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


@dataclass(frozen=True)
class Copies:
    """What is known of all payloads without reading them again."""

    shared: DataFrame  # digest, largest: payloads that several pages have, with their largest page_id
    rows: int
    bytes: int
    most_bytes: int  # of one payload


def _payload() -> Column:
    return F.coalesce("html", F.lit("")).cast("binary")


def _copies(pages: DataFrame, least_bytes: int) -> Copies:
    keyed = pages.select("page_id", F.sha1(_payload()).alias("digest"), F.length(_payload()).alias("bytes"))
    copies = materialize(
        keyed.groupBy("digest", "bytes").agg(F.count("*").alias("rows"), F.max("page_id").alias("largest"))
    )
    total = copies.agg(F.sum("rows"), F.sum(F.col("rows") * F.col("bytes")), F.max("bytes")).first()
    shared = copies.where((F.col("rows") > 1) & (F.col("bytes") >= least_bytes)).select("digest", "largest")
    return Copies(shared, *(value or 0 for value in total))


def _decided(pages: DataFrame, copies: Copies) -> DataFrame:
    """Pages with ``refers_to``, which is null for responses.

    The payloads move for this join only, and not at all where few payloads are shared.
    """
    keyed = pages.select("page_id", "url", _payload().alias("payload"), F.sha1(_payload()).alias("digest"))
    revisits = ~F.col("page_id").eqNullSafe(F.col("largest"))
    return keyed.join(copies.shared, "digest", "left").select(
        "page_id", "url", "payload", F.when(revisits, F.col("largest")).alias("refers_to")
    )


def _sample(pages: DataFrame, rows: int) -> list[bytes]:
    """About ``SAMPLE_RECORDS`` records, those with hashes under the threshold that ``rows`` gives."""
    cut = F.substring(F.coalesce("html", F.lit("")), 1, SAMPLE_BYTES)
    part = (SAMPLE_RECORDS << 30) // max(1, rows)
    position = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(1 << 30))
    some = pages.where(position < part).select("page_id", "url", cut.alias("html"))
    # The limit is for rows that repeat one hash; the samples' order does not matter.
    return sorted(record(r.page_id, r.url, r.html.encode()[:SAMPLE_BYTES], None) for r in some.limit(2 * SAMPLE_RECORDS).collect())


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives ``*.warc.zst`` below ``path``.

    Each archive starts with the dictionary in a skippable frame; then each record is a frame of
    its own, so that a reader can start at any record. Of pages with equal payloads of at least
    ``least_bytes``, the one with the largest page_id is written whole and the others refer to it.

    How: digests and sizes are counted first, with partial sums, so a payload that a third of the
    pages share costs a row a task. One join by digest decides; what it deals out is written as it
    is. Archives are Spark's own output files, committed by its protocol: a lost executor's tasks
    run again and leave no halves. A task begins a new archive after as many records as
    ``archive_bytes`` have on average, and before the largest ones could make it too large to be
    read as one file. The dictionary is trained on a bounded sample (about ``SAMPLE_RECORDS`` records
    by their hashes, up to ``SAMPLE_BYTES`` of each); too few records train none, and the leading
    frame is then empty.

    Edge cases: null html is an empty payload; a null url leaves its header out; line ends in a
    url are written as %0D and %0A. Pages that repeat the largest page_id are all responses, and a
    null page_id refers to the largest one, if there is any. No pages give no archive.
    """
    spark = pages.sparkSession
    copies = _copies(pages, least_bytes)
    dictionary = build_dictionary(_sample(pages, copies.rows))
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
    average = copies.bytes // max(1, copies.rows) + HEADER_BYTES
    per_archive = max(1, min(archive_bytes // average, MOST_BYTES // (copies.most_bytes + HEADER_BYTES)))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        written = 0
        for batch in batches:
            sizes = pc.binary_length(batch.column("payload")).to_pylist()
            for part in chunks(sizes, HELD_BYTES):
                rows = batch.slice(part.start, part.stop - part.start)
                out = []
                for page_id, url, payload, refers_to in zip(*(column.to_pylist() for column in rows.columns), strict=True):
                    if written % per_archive == 0:
                        out.append(lead)
                    written += 1
                    out.append(press.compress(record(page_id, url, payload, refers_to)))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    # The text writer puts the bytes down as they are; a file has a leading frame and its records.
    framed = _decided(pages, copies).mapInArrow(frames, "frame binary").select(F.col("frame").cast("string"))
    framed.write.option("lineSep", PADDING).option("maxRecordsPerFile", per_archive + 1).text(path)
    _name_archives(spark, path)


def _name_archives(spark: SparkSession, path: str) -> None:
    """part-00012-...-c003.txt becomes pages-00012-003.warc.zst."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if found := re.match(r"part-(\d+)-.*-c(\d+)", name):
            files.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(folder, f"pages-{found[1]}-{found[2]}.warc.zst"))


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Read archives back: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    A response's payload is checked against its digest. A revisit has a null payload, and so has
    every record without ``payloads``.
    """

    def number(uri: str | None) -> int | None:
        digits = (uri or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows, held = [], 0
                for headers, block in records(memoryview(archive.as_buffer())):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    length = int(head.rpartition(b"Content-Length: ")[2])
                    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    kind = headers["warc-type"]
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
                    rows.append(
                        (
                            number(headers["warc-record-id"]),
                            headers.get("warc-target-uri"),
                            length,
                            digest,
                            kind,
                            number(headers.get("warc-refers-to")),
                            payload if kind == "response" and payloads else None,
                        )
                    )
                    held += len(payload) + HEADER_BYTES
                    if held > HELD_BYTES:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return found.select("content").mapInArrow(
        parsed,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and tell what they hold when read back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path, payloads=False).drop("url", "payload")


SQL = r"""
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
  select page_id, cast(octet_length(payload) as bigint) as payload_bytes, sha1(payload) as payload_digest from p
), g as (
  select *, max(page_id) over (partition by payload_digest) as largest from d
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> largest then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> largest then largest end as refers_to
from g
"""
