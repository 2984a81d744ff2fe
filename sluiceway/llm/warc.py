"""Deterministic sharded WARC writing, and reading back.

Records are dealt to shards by ranges of their key and sorted within. The bounds come from
exact sums of bytes over equal key ranges, not from a sample, so the same input always gives
the same files. A task streams its shards through gzip members, one per record, and starts a
new file when the compressed size passes a limit. Each file is written under a temporary name
of the attempt and moved to its final name when complete; a retried or doubled task produces
the same bytes. The manifest (one row per file) is written last, by Spark: readers follow it,
so files of a run that failed before are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.texts import bounded_batches, quoted
from sluiceway.operators import stage
from sluiceway.sources.storage import delete_path

#: Payload bytes a shard should hold, and compressed bytes after which a file is closed.
SHARD_BYTES = 64 << 20
FILE_BYTES = 32 << 20
#: Equal key ranges whose bytes are summed to find the bounds of shards.
RANGES = 4096
#: Date of all records: part of the input, as a clock would make files differ.
DATE = "2026-01-01T00:00:00Z"

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 5
_TEMPORARY = "_temporary"
# Tasks that read archives, at most; beyond, a task reads several files one after the other.
_READERS = 100_000

MANIFEST = "file string, shard int, records long, bytes long, sha256 string"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base 32, in built-in functions.

    A digest has 160 bits: four groups of ten hexadecimal digits, each eight letters.
    """
    digest = F.sha1(payload)
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for group in range(4):
        number = F.conv(F.substring(digest, group * 10 + 1, 10), 16, 10).cast("bigint")
        for letter in range(8):
            place = F.shiftright(number, 35 - 5 * letter).bitwiseAND(F.lit(31))
            out.append(F.substring(letters, (place + 1).cast("int"), F.lit(1)))
    return F.concat(*out)


def describe(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """One row per page: key, url, payload, its size and digest, record type and reference.

    Of pages with equal payloads the one with the largest key is the response and the others
    revisit it. Rows that repeat that key with that payload are responses as well. A null key
    is less than any other; pages that all have a null key are all responses.
    """
    payload = F.encode(F.coalesce(F.col(quoted(html)).cast("string"), F.lit("")), "UTF-8")
    hashed = pages.select(
        F.col(quoted(key)).cast("long").alias("page_id"),
        F.col(quoted(url)).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": base32_sha1(F.col("payload")),
        }
    )
    # Payloads seen once need no partner; only the others' largest keys take part in the join.
    shared = stage(
        hashed.select("payload_digest", "payload_bytes", "page_id")
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("_largest"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n"),
        "warc-shared",
    )
    joined = hashed.join(shared, ["payload_digest", "payload_bytes"], "left")
    revisits = F.col("_largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_largest"))
    return joined.select(
        "page_id",
        "url",
        # A revisit has no payload, so it need not travel.
        F.when(~revisits, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("_largest")).alias("refers_to"),
    )


def shard_of(records: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[Column, int]:
    """The shard of a record as a function of its row, and the number of shards.

    Sums of bytes over at most ``RANGES`` equal ranges of the key reach the driver. Neighbouring
    ranges share a shard up to ``shard_bytes``; a range above that (ids crowded together, or
    one id many times) is split by the hash of the digest.
    """
    travels = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    size = travels + 400  # and about so many bytes of headers
    bounds = records.agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).head()
    low, high = bounds["a"], bounds["b"]
    if low is None:
        low, high = 0, 0
    width = max(1, -(-(high - low + 1) // RANGES))
    # Null keys come first, with the smallest.
    place = F.floor((F.coalesce(F.col("page_id"), F.lit(low)) - F.lit(low)) / F.lit(width)).cast("int")
    sums = {r["p"]: r["n"] for r in records.groupBy(place.alias("p")).agg(F.sum(size).alias("n")).collect()}
    firsts, pieces, shard, held = [0] * RANGES, [1] * RANGES, -1, shard_bytes
    for at in range(RANGES):
        own = sums.get(at, 0)
        if own > shard_bytes:
            firsts[at], pieces[at] = shard + 1, -(-own // shard_bytes)
            shard, held = shard + pieces[at], shard_bytes
            continue
        if held + own > shard_bytes:
            shard, held = shard + 1, 0
        held += own
        firsts[at] = shard

    def constant(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")

    piece = F.pmod(F.xxhash64("payload_digest", "page_id"), F.get(constant(pieces), place))
    return (F.get(constant(firsts), place) + piece).cast("int"), max(1, shard + 1)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}:{digest}')}>"


def _line(value: str | None) -> str:
    """A header value: control characters are percent-encoded, so no value ends its line."""
    if value is None:
        return "urn:unknown"
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record: headers regenerated from the row, block, two line ends."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + (row["payload"] or b"")
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", _record_id(row["page_id"], row["payload_digest"])),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(row["url"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Block-Digest", f"sha1:{block_digest}"),
    ]
    if revisit:
        headers += [
            ("WARC-Profile", _REVISIT),
            ("WARC-Refers-To", _record_id(row["refers_to"], row["payload_digest"])),
            ("X-Refers-To-Page", str(row["refers_to"])),
        ]
    if row["page_id"] is not None:
        headers.append(("X-Page", str(row["page_id"])))
    if row["url"] is None:
        headers.append(("X-Target-Unknown", "yes"))
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """A WARC file under a temporary name until it is closed."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, number: int):
        self.name = f"shard-{shard:06d}-{number:04d}.warc.gz"
        self.shard, self.records, self.bytes = shard, 0, 0
        self._store, self._folder = store, folder
        self._temporary = f"{folder}/{_TEMPORARY}/{uuid.uuid4().hex}-{self.name}"
        self._digest = hashlib.sha256()
        self._out = store.open_output_stream(self._temporary, compression=None)
        self.add(
            "WARC/1.1\r\nWARC-Type: warcinfo\r\n"
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, self.name)}>\r\n"
            f"WARC-Date: {DATE}\r\nWARC-Filename: {self.name}\r\n"
            "Content-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\n"
            "format: WARC/1.1\r\n\r\n\r\n".encode(),
            0,
        )

    def add(self, record: bytes, count: int = 1) -> None:
        packed = _member(record)
        self._out.write(packed)
        self._digest.update(packed)
        self.bytes += len(packed)
        self.records += count

    def close(self) -> dict:
        self._out.close()
        self._store.move(self._temporary, f"{self._folder}/{self.name}")
        return {
            "file": self.name,
            "shard": self.shard,
            "records": self.records,
            "bytes": self.bytes,
            "sha256": self._digest.hexdigest(),
        }


_MANIFEST_TYPE = pa.schema(
    [("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()),
     ("sha256", pa.string())]
)


def write_archive(records: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES,
                  file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write described pages as WARC files below ``folder``; returns the manifest, as written.

    ``folder`` is a URI that every executor can reach (a shared folder or an object store).
    An empty table gives an empty manifest.
    """
    spark = records.sparkSession
    bounded_batches(spark)
    # The bounds need no payload, and a record's shard follows from its own columns alone. So
    # only narrow rows are written for the bounds, and payloads travel once, to their shard's
    # task; its number is given, as ranges drawn from a sample would need a further pass.
    narrow = stage(
        records.select("page_id", "payload_bytes", "payload_digest", "record_type"), "warc-bounds"
    )
    shard, shards = shard_of(narrow, shard_bytes)
    dealt = (
        records.withColumn("shard", shard)
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "payload_digest", "url")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{path}/{_TEMPORARY}", recursive=True)
        current, number = None, 0
        done = []
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if current is not None and current.shard != row["shard"]:
                    done.append(current.close())
                    current, number = None, 0
                elif current is not None and current.bytes >= file_bytes:
                    done.append(current.close())
                    current, number = None, number + 1
                if current is None:
                    current = _File(store, path, row["shard"], number)
                current.add(record_bytes(row))
        if current is not None:
            done.append(current.close())
        yield pa.RecordBatch.from_pylist(done, schema=_MANIFEST_TYPE)

    manifest = dealt.mapInArrow(write, MANIFEST)
    path = f"{folder}/manifest"
    manifest.write.mode("overwrite").parquet(path)
    # What failed attempts left; files of the manifest have their final names.
    delete_path(spark, f"{folder}/{_TEMPORARY}")
    return spark.read.schema(MANIFEST).parquet(path)


def parse_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped stream, holding one record at a time."""
    unpack, held = zlib.decompressobj(31), bytearray()
    head, begin, need, headers = None, 0, 0, {}
    for chunk in chunks:
        while chunk:
            held += unpack.decompress(chunk)
            chunk = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(31)
            while True:
                if head is None:
                    end = held.find(b"\r\n\r\n")
                    if end < 0:
                        break
                    head, begin = held[:end].decode("utf-8"), end + 4
                    headers = dict(
                        line.split(": ", 1) for line in head.split("\r\n")[1:]
                    )
                    need = int(headers["Content-Length"])
                if len(held) < begin + need + 4:
                    break
                yield headers, bytes(held[begin : begin + need])
                del held[: begin + need + 4]
                head = None
    if held or head is not None:
        raise ValueError("the archive ends within a record")


_RECORD_TYPE = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
     ("payload", pa.binary())]
)


def _parsed(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    """A record as a row; a response's size and digest are taken from its payload, and checked."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    if headers["WARC-Block-Digest"] != f"sha1:{digest}":
        raise ValueError(f"block digest of {headers['WARC-Record-ID']} does not hold")
    revisit = headers["WARC-Type"] == "revisit"
    length = int(http.rsplit(b"Content-Length: ", 1)[1])
    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit:
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if own != stated or len(payload) != length:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not hold")
    page, refers = headers.get("X-Page"), headers.get("X-Refers-To-Page")
    return {
        "page_id": None if page is None else int(page),
        "payload_bytes": length,
        "payload_digest": stated,
        "record_type": headers["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
        "url": None if "X-Target-Unknown" in headers else headers["WARC-Target-URI"],
        "payload": payload if payloads and not revisit else None,
    }


def read_archive(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every response and revisit of the manifest's files, digests checked.

    Files are read in streams, many tasks at a time; a task holds one record besides its batch.
    """
    # The manifest is a few kilobytes, so left alone all its files would be read by one task.
    readers = min(max(1, manifest.count()), _READERS)
    files = manifest.select("file").repartition(readers, "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for headers, block in parse_records(iter(lambda: stream.read(1 << 20), b"")):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_parsed(headers, block, payloads))
                        held += len(block)
                        if len(rows) >= 1000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_TYPE)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_TYPE)

    return files.mapInArrow(read, RECORDS)


def archive_pages(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write one record per row of ``pages`` below ``folder`` and read the archives back.

    A null html is the empty payload, a null url stays null (``urn:unknown`` and a header of
    its own in the file), control characters of a url are percent-encoded; repeated rows give repeated records. Other columns of
    ``pages`` take no part.
    """
    manifest = write_archive(describe(pages, key, url, html), folder)
    return read_archive(manifest, folder)
