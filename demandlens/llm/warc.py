"""WARC archives with Zstandard frames and a shared dictionary.

Layout of an archive: a leading skippable frame (magic 0x184D2A5D) holds a dictionary, itself
one Zstandard frame; then one Zstandard frame per record, compressed with that dictionary.
The reader takes the dictionary from the leading frame, decodes frame by frame, and validates
each record: version line, mandatory headers, unique names, Content-Length against the block,
the CRLF CRLF end, the payload digest of a response, and that a frame holds one record only.

``write_archives`` writes archives of bounded size through ``pyarrow.fs`` into the shared folder,
in two steps. Tasks write drafts, under names of their attempt, where no reader looks; the list of
drafts of the attempts that succeeded is written as a table. Then these drafts, and no others,
move to their final names. An attempt that failed, or ran twice, with whatever rows in whatever
order, leaves drafts that nobody lists; they are removed. ``read_archives`` reads archives with
Spark's ``binaryFile`` source, so they may lie in any store that Spark reads; an archive is one
row, which is why the writer bounds its size.

Revisits: of records with equal payloads of at least ``LEAST_SHARED`` bytes, the one with the
smallest id is the response; the others are revisit records without a payload that name it.
``resolve`` joins them back to their response.

Defined cases: a null payload counts as empty; a null url is written as an empty target and
read back as null; ids are written in decimal, a null id as an empty value. Rows with a null id
revisit the smallest id with their payload, and are responses where no id has it. Rows that
repeat the smallest id are all responses. Empty tables give archives without records, or no
archives. Extra columns are not archived.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm._common import Rows, scratch_path, table, written

SKIPPABLE = 0x184D2A5D           # fixed value of the format
VERSION = b"WARC/1.1"
LEAST_SHARED = 100               # bytes
ARCHIVE_BYTES = 16 << 20         # payload bytes after which a task starts its next archive
DICTIONARY_BYTES = 16 << 10
TRAINED_ON = 64                  # records of an archive that its dictionary is trained on
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"    # archives of equal input are equal

RECORD_SCHEMA = pa.schema([
    ("archive", pa.string()), ("record", pa.int64()), ("page_id", pa.int64()),
    ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary())])
RECORD_DDL = ("archive string, record long, page_id long, url string, record_type string, "
              "refers_to long, payload_digest string, payload binary")


# ------------------------------------------------------------------------------- records

def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def build_record(page_id, url, kind: str, refers_to, digest: str, payload: bytes) -> bytes:
    block = payload if kind == "response" else b""
    name = "" if page_id is None else str(page_id)
    lines = [VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url or '')}",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BadRecord(ValueError):
    """An archive that does not follow the format."""


def parse_record(raw: bytes) -> dict:
    """Headers (lower-case names) and block of one validated record."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    if not mark:
        raise BadRecord("headers do not end")
    version, *lines = head.split(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1"):
        raise BadRecord(f"version {version[:20]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        key = name.strip().lower().decode("ascii", "replace")
        if not colon or not key or key in headers:
            raise BadRecord(f"header {line[:60]!r}")
        headers[key] = value.strip(b" \t").decode("utf-8", "replace")
    for needed in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if needed not in headers:
            raise BadRecord(f"{needed} is missing")
    if not (headers["content-length"].isascii() and headers["content-length"].isdigit()):
        raise BadRecord("Content-Length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadRecord(f"Content-Length {length}, found {len(rest) - 4}")
    return {"headers": headers, "block": rest[:length]}


def _page(value: str | None) -> int | None:
    if value is None:
        return None
    inner = value.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


# ------------------------------------------------------------------------------ archives

def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary for the archive, or none where there is too little to train on."""
    if sum(map(len, samples)) < 8 * DICTIONARY_BYTES or len(samples) < 8:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:          # samples that share nothing
        return None


def pack(records: list[bytes]) -> bytes:
    """One archive."""
    trained = train([r[:8192] for r in records[:: max(1, len(records) // TRAINED_ON)]])
    shipped = zstandard.ZstdCompressor().compress(trained.as_bytes()) if trained else b""
    head = SKIPPABLE.to_bytes(4, "little") + len(shipped).to_bytes(4, "little") + shipped
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True,
                                      write_content_size=True)
    return head + b"".join(map(packer.compress, records))


def unpack(archive: bytes) -> Iterator[bytes]:
    """The records, one frame each."""
    view = memoryview(archive)
    if len(view) < 8 or int.from_bytes(view[:4], "little") != SKIPPABLE:
        raise BadRecord("no leading dictionary frame")
    at = 8 + int.from_bytes(view[4:8], "little")
    if at > len(view):
        raise BadRecord("the dictionary frame is cut off")
    trained = None
    if at > 8:
        shipped = bytes(view[8:at])
        if shipped[:4] == zstandard.FRAME_HEADER:
            shipped = zstandard.ZstdDecompressor().decompress(shipped)
        trained = zstandard.ZstdCompressionDict(shipped)
    opener = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(view):
        frame = opener.decompressobj()
        parts = []
        start = at
        while not frame.eof:
            if at >= len(view):
                raise BadRecord(f"the frame at byte {start} is cut off")
            step = view[at:at + (1 << 18)]
            try:
                parts.append(frame.decompress(step))
            except zstandard.ZstdError as e:
                raise BadRecord(f"the frame at byte {start}: {e}") from e
            at += len(step)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def _parse_archive(name: str, archive: bytes, verify: bool = True) -> Iterator[tuple]:
    for k, raw in enumerate(unpack(archive)):
        record = parse_record(raw)
        headers, block = record["headers"], record["block"]
        kind = headers["warc-type"]
        digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
        if kind == "response" and verify and digest != hashlib.sha256(block).hexdigest():
            raise BadRecord(f"{name}, record {k}: the digest does not fit the payload")
        yield (name, k, _page(headers["warc-record-id"]), headers.get("warc-target-uri") or None,
               kind, _page(headers.get("warc-refers-to")), digest,
               block if kind == "response" else None)


# --------------------------------------------------------------------------------- Spark

def mark_revisits(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``(page_id, url, payload, payload_digest, record_type, refers_to)`` to be written.

    The smallest id per digest is a map-side combinable minimum; it comes back by a join that
    Spark splits where one payload holds many rows. Only digests with a second row join.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least
    first = (rows.where(large).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and first_id is not null").select("payload_digest", "first_id"))
    other = large & F.col("first_id").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")))
    return (rows.join(first, "payload_digest", "left")
            .select("page_id", "url", "payload", "payload_digest",
                    F.when(other, "revisit").otherwise("response").alias("record_type"),
                    F.when(other, F.col("first_id")).alias("refers_to")))


DRAFTS = "_drafts"               # hidden from Spark's readers
DRAFT_SCHEMA = pa.schema([("draft", pa.string()), ("archive", pa.string()),
                          ("records", pa.int64()), ("bytes", pa.int64())])
DRAFT_DDL = "draft string, archive string, records long, bytes long"


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI as Spark names it."""
    return pyarrow.fs.FileSystem.from_uri("s3" + uri[3:] if uri.startswith("s3a:") else uri)


def write_drafts(rows: Iterator[tuple], uri: str, part: str, attempt: int,
                 archive_bytes: int) -> Iterator[tuple]:
    """Archives of one task attempt: ``(draft, archive, records, bytes)`` for each."""
    store, base = _store(uri)
    store.create_dir(f"{base}/{DRAFTS}", recursive=True)

    def put(held: list[bytes], number: int) -> tuple:
        name = f"part-{part}-{number:05d}.warc.zst"
        draft, data = f"{DRAFTS}/{attempt}-{name}", pack(held)
        # the frames are in the data already; by its name the stream would compress it again
        with store.open_output_stream(f"{base}/{draft}", compression=None) as out:
            out.write(data)
        return draft, name, len(held), len(data)
    held: list[bytes] = []
    size = number = 0
    for page_id, url, payload, digest, kind, refers_to in rows:
        held.append(build_record(page_id, url, kind, refers_to, digest, payload))
        size += len(held[-1])
        if size >= archive_bytes:
            yield put(held, number)
            held, size, number = [], 0, number + 1
    if held:
        yield put(held, number)


def publish(uri: str, draft: str, name: str) -> None:
    """Move a draft to its final name; moving it again changes nothing."""
    store, base = _store(uri)
    try:
        store.move(f"{base}/{draft}", f"{base}/{name}")
    except OSError:
        if store.get_file_info(f"{base}/{name}").type != pyarrow.fs.FileType.File:
            raise


def write_archives(records: DataFrame, uri: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write what ``mark_revisits`` made; returns ``(archive, records, bytes)`` per file written."""
    run_id = uuid.uuid4().hex[:8]

    def draft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        rows = (row for batch in batches for k in range(0, batch.num_rows, 256)
                for row in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns)))
        for made in write_drafts(rows, uri, f"{run_id}-{context.partitionId():06d}",
                                 context.taskAttemptId(), archive_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in
                                              zip(made, DRAFT_SCHEMA)], schema=DRAFT_SCHEMA)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, final in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                publish(uri, name, final)
            yield batch
    drafts = written(records.select("page_id", "url", "payload", "payload_digest", "record_type",
                                    "refers_to").mapInArrow(draft, DRAFT_DDL), "warc-drafts")
    archives = written(drafts.mapInArrow(move, DRAFT_DDL), "warc-archives")
    store, base = _store(uri)
    if store.get_file_info(f"{base}/{DRAFTS}").type == pyarrow.fs.FileType.Directory:
        store.delete_dir(f"{base}/{DRAFTS}")
    return archives.select("archive", "records", "bytes")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; a broken one fails the read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
             .select("path", "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(RECORD_SCHEMA)
        for batch in batches:
            for k in range(batch.num_rows):
                name = urlsplit(batch.column(0)[k].as_py()).path.rsplit("/", 1)[-1]
                for row in _parse_archive(name, batch.column(1)[k].as_buffer()):
                    out.add(*row, weight=len(row[-1] or b""))
                    if out.full:
                        yield out.take()
        yield from out.rest()
    return files.mapInArrow(run, RECORD_DDL)


def resolve(records: DataFrame) -> DataFrame:
    """Give every record the length of its full payload: revisits take their response's.

    The archives are decoded once; what is measured goes to a table.
    """
    measured = written(records.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
                       .drop("payload"), "warc-measured")
    found = (measured.where("record_type = 'response'")
             .groupBy(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"))
             .agg(F.max("payload_bytes").alias("r_bytes")))
    own = measured.where("record_type <> 'revisit'")
    others = (measured.where("record_type = 'revisit'")
              .join(found, (F.col("refers_to") == F.col("r_id"))
                    & (F.col("payload_digest") == F.col("r_digest")), "left")
              .withColumn("payload_bytes", F.col("r_bytes")).drop("r_id", "r_digest", "r_bytes"))
    return own.unionByName(others)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to archives, read the archives back."""
    uri = scratch_path(spark, "warc")
    spark_uri = uri if "://" in uri or uri.startswith("file:") else "file://" + uri
    sums = write_archives(mark_revisits(table(spark, sf_dir, "pages")), spark_uri).agg(
        F.count(F.lit(1)).alias("files")).first()
    if not sums.files:
        empty = spark.createDataFrame([], RECORD_DDL)
        records = resolve(empty)
    else:
        records = resolve(read_archives(spark, spark_uri))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type",
                          "refers_to", "url")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, url FROM pages),
d AS (SELECT page_id, url, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to, url
FROM m
"""
