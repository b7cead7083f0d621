"""WARC archives, compressed record by record with a dictionary that the archive itself carries.

Each task writes its records to archives of bounded size in the shared folder. An archive begins with a
skippable frame that holds a Zstandard dictionary, built from the first records of that archive (a
bounded sample; all records are written). Every record follows as a frame of its own, so any of them
can be read alone by its offset.

Of records with equal payloads the one with the largest id is the response, the others are revisits
of it without the payload. The groups come from one aggregate over digests, and one join, which can
split a hot digest, hands the chosen id to the records.

Files carry a name of their own per attempt of a task, and only what a successful attempt reports is in
the index. A retried or duplicated task leaves files behind that nothing refers to.

Defined cases: a null payload is an empty one; with a null id a record has no id header, and is never
the response of records that have one; rows alike in id and payload are each a response if theirs is the
largest id; control characters and spaces in a URL are percent-encoded; an empty table writes no
archive. Only the columns named are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import joined
from tallyloom.session import as_table

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"

INDEX = "file string, offset long, length long, record_id string, page_id long"
RECORDS = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
           "refers_to long, payload binary")


@dataclass(frozen=True)
class Settings:
    level: int = 3
    dictionary_bytes: int = 32 << 10
    sample_bytes: int = 2 << 20  # of the first records of an archive, for its dictionary
    sample_record: int = 32 << 10  # most bytes of one record in the sample
    archive_bytes: int = 256 << 20
    least_payload: int = 0  # smaller payloads are always written in full
    date: str = "2024-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}')}>"


def _header_value(text: str) -> str:
    return "".join(c if 32 < ord(c) != 127 else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers if value is not None),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, chosen, chosen_url, revisit: bool, date: str) -> tuple[str, bytes]:
    """Id and bytes of one page's record."""
    digest = digest_of(payload)
    identity = record_id(page_id, url, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [("WARC-Type", REVISIT if revisit else RESPONSE), ("WARC-Record-ID", identity), ("WARC-Date", date),
               ("WARC-Target-URI", None if url is None else _header_value(url)),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
               ("X-Page-Id", page_id), ("X-Payload-Length", len(payload))]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(chosen, chosen_url, digest)),
                    ("WARC-Refers-To-Target-URI", None if chosen_url is None else _header_value(chosen_url)),
                    ("X-Refers-To-Page-Id", chosen)]
    return identity, _record(headers, http.encode() + (b"" if revisit else payload))


def dictionary(records: list[bytes], settings: Settings) -> zstandard.ZstdCompressionDict | None:
    """Trained on the records given; where they are too few for training, their last bytes as they are."""
    samples = [r[:settings.sample_record] for r in records]
    size = min(settings.dictionary_bytes, sum(map(len, samples)) // 4)
    if size < 256:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, level=settings.level)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@dataclass
class Archive:
    """One archive being written. Records wait until there are enough for the dictionary."""

    path: str
    settings: Settings
    waiting: list[tuple[str, int | None, bytes]] = field(default_factory=list)
    held: int = 0
    offset: int = 0
    index: list[tuple] = field(default_factory=list)
    stream: object = None
    compressor: object = None

    def add(self, identity: str, page_id: int | None, record: bytes) -> None:
        if self.stream is not None:
            self._write(identity, page_id, record)
            return
        self.waiting.append((identity, page_id, record))
        self.held += min(len(record), self.settings.sample_record)
        if self.held >= self.settings.sample_bytes:
            self._begin()

    def _begin(self) -> None:
        system, path = _filesystem(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(path, compression=None)  # no second time, whatever the suffix
        words = dictionary([r for _, _, r in self.waiting], self.settings)
        if words is not None:
            content = zstandard.ZstdCompressor(level=self.settings.level).compress(words.as_bytes())
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
            words.precompute_compress(level=self.settings.level)
        self.compressor = zstandard.ZstdCompressor(level=self.settings.level, dict_data=words, write_checksum=True)
        info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                        ("WARC-Date", self.settings.date), ("Content-Type", "application/warc-fields")],
                       b"format: WARC File Format 1.1\r\n")
        self._put(self.compressor.compress(info))
        for waiting in self.waiting:
            self._write(*waiting)
        self.waiting = []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.offset += len(data)

    def _write(self, identity: str, page_id: int | None, record: bytes) -> None:
        data = self.compressor.compress(record)
        self.index.append((self.path, self.offset, len(data), identity, page_id))
        self._put(data)

    def close(self) -> list[tuple]:
        if self.waiting:
            self._begin()
        if self.stream is not None:
            self.stream.close()
        return self.index


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
    names = ("file", "offset", "length", "record_id", "page_id")
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))


def plan_records(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(page_id, url, payload, chosen, chosen_url, revisit) of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = (rows.where(F.octet_length("payload") >= settings.least_payload).groupBy("digest")
              .agg(F.max(F.struct(F.col("page_id").alias("id"), F.col("url").alias("url"))).alias("chosen"),
                   F.count("*").alias("copies")).where("copies > 1 and chosen.id is not null")
              .select("digest", "chosen"))
    known = joined(rows, groups, ["digest"], "left")
    revisit = F.col("chosen.id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("chosen.id"))
    return known.select("page_id", "url", "payload", F.col("chosen.id").alias("chosen"),
                        F.col("chosen.url").alias("chosen_url"), revisit.alias("revisit"))


def write(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Writes the archives; returns their index, one row per page, as a table in the shared folder."""

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> Archive:
            return Archive(f"{folder.rstrip('/')}/pages-{uuid.uuid4().hex}.warc.zst", settings)

        now = fresh()
        for batch in batches:
            for page_id, url, payload, chosen, chosen_url, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                identity, record = page_record(page_id, url, payload, chosen, chosen_url, revisit, settings.date)
                now.add(identity, page_id, record)
                if now.offset >= settings.archive_bytes:
                    yield _index_batch(now.close())
                    now = fresh()
        yield _index_batch(now.close())

    return as_table(plan_records(pages, settings).mapInArrow(archive, INDEX), "warc-index")


def open_archive(source) -> io.BufferedReader:
    """The records of an archive as one stream of bytes, uncompressed."""
    head = source.read(8)
    words = None
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_FRAME:
        content = source.read(struct.unpack("<II", head)[1])
        if content[:4] == b"\x28\xb5\x2f\xfd":
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        words, head = zstandard.ZstdCompressionDict(content), b""
    reader = zstandard.ZstdDecompressor(dict_data=words).stream_reader(
        source if not head else _Chained(head, source), read_across_frames=True)
    return io.BufferedReader(reader, 1 << 20)


class _Chained:
    """A stream with some bytes put back in front."""

    def __init__(self, head: bytes, rest):
        self.head, self.rest = head, rest

    def read(self, size: int = -1) -> bytes:
        if self.head:
            head, self.head = self.head, b""
            return head
        return self.rest.read(size)


def records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        headers = {}
        while (line := stream.readline().decode().rstrip("\r\n")):
            name, _, value = line.partition(":")
            headers[name.lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def read(files: DataFrame, payloads: bool = False) -> DataFrame:
    """RECORDS of all page records in the archives that ``files`` (file) names.

    The digest of every response is computed anew and must be the one that its header states.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, path = _filesystem(file)
                rows, size = [], 0
                with system.open_input_stream(path, compression=None) as source:
                    for headers, block in records(open_archive(source)):
                        if headers["warc-type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        whole = headers["warc-type"] == RESPONSE
                        if whole and digest_of(payload) != digest:
                            raise ValueError(f"a payload in {file} does not match its digest")
                        page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                        rows.append((None if page is None else int(page), headers.get("warc-target-uri"),
                                     headers["warc-type"], digest,
                                     len(payload) if whole else int(headers["x-payload-length"]),
                                     None if refers is None else int(refers), payload if payloads and whole else None))
                        size += len(payload) if payloads else 0
                        if len(rows) >= 5000 or size > 8 << 20:
                            yield packed(rows)
                            rows, size = [], 0
                yield packed(rows)

    return files.select("file").mapInArrow(parse, RECORDS)


def archives(index: DataFrame) -> DataFrame:
    """The files of an index, each in a partition of its own as far as hashing allows."""
    files = as_table(index.select("file").distinct(), "warc-files")
    return files.repartition(max(1, files.count()))


def oracle() -> str:
    """What reading the archives back gives, per page."""
    bit = " + ".join(f"{1 << (4 - k)} * substr(bits, (5 * j + {k + 1})::INT, 1)::INT" for k in range(5))
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    hexed AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex,
        max(page_id) OVER (PARTITION BY payload) AS chosen, count(*) OVER (PARTITION BY payload) AS copies FROM p),
    bitted AS (SELECT *, array_to_string(list_transform(range(40),
        lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, (i + 1)::INT, 1)) - 1), 4, '0')), '') AS bits FROM hexed)
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(32),
            lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {bit}, 1)), '') AS payload_digest,
        CASE WHEN copies > 1 AND page_id <> chosen THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN copies > 1 AND page_id <> chosen THEN chosen END AS refers_to
    FROM bitted"""
