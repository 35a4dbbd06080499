"""WARC: deterministic sharded writer, and its reader.

Records are range-sorted by page_id, and by digest and url where ids are
missing or repeat: shard bounds are quantiles of a sample of such keys chosen
by hash, so the same table gives the same shards whatever the tasks, and only
rows that are equal in all three cannot be cut apart.  A shard's records go to gzip files, a member for each record, which
roll when the next record would pass ``file_bytes`` of compressed size.
Headers, record ids and digests are made anew from the payload.  Of equal
payloads of ``MIN_REVISIT`` bytes or more, the smallest page_id is written as
response and the others as revisits of it, without the payload.

Commit: a task writes under a temporary name and renames the closed file; a
repeated task writes the same bytes under the same final name.  The list of
files, with sizes and digests, is written last as one Spark job (``_manifest``,
whole once ``_SUCCESS`` is there).  The reader takes the files of the
manifest only, compares their digests, and fails on a missing or changed one.

Files are written with pyarrow's file systems, so the folder may be any
store that it reaches (``file``, ``hdfs``, ``s3``, ``gs``).

Cases: null html is an empty payload; a null url leaves out the target
header, control characters and spaces in it are percent-encoded; a null
page_id sorts first, is the response only where no other id has the payload,
and has no id header; rows that repeat the smallest id are responses each; an
empty table gives an empty manifest.  Other columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.store import keep, new_folder

MIN_REVISIT = 100
SHARD_BYTES, FILE_BYTES = 32 << 20, 8 << 20
#: Sampled keys a shard, and shards in all: beyond ``MAX_SHARDS`` times
#: ``shard_bytes`` (2 TB) shards grow instead.  A task streams its shard into
#: files of ``file_bytes``, so its memory does not follow the shard's size,
#: and the sampled keys on the driver stay bounded.
KEYS_PER_SHARD, MAX_SHARDS = 16, 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("5e1f9d3a-7a0c-4b0e-9f0a-0d7f5c1b2a33")
_NULL_ID = -(1 << 63)


def record_id(page_id: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind} {page_id} {digest}')}>"


def _block(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _clean_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, digest: str,
                refers_to: int | None, date: str = DATE) -> bytes:
    """A response, or a revisit (payload is None) of the page ``refers_to``."""
    kind = "response" if payload is not None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest, kind)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _clean_url(url)))
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if kind == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, "response")),
                    ("WARC-Refers-To-Page-ID", str(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n"
    return _block(headers, http.encode() + (payload or b""))


def info_record(name: str, date: str = DATE) -> bytes:
    return _block([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name, "warcinfo")), ("WARC-Date", date),
                   ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                  b"software: mercato\r\nformat: WARC File Format 1.1\r\n")


class _Roll:
    """The files of one shard, one after the other."""

    def __init__(self, folder: str, shard: int, file_bytes: int):
        self.store, self.base = fs.FileSystem.from_uri(folder)
        self.shard, self.limit, self.number, self.done = shard, file_bytes, 0, []
        self.out = None

    def _open(self) -> None:
        self.name = f"part-{self.shard:06d}-{self.number:04d}.warc.gz"
        self.temp = f"{self.base}/_attempts/{self.name}.{uuid.uuid4().hex}"
        self.store.create_dir(f"{self.base}/_attempts", recursive=True)
        self.out, self.size, self.records, self.sha = self.store.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        self._put(gzip.compress(info_record(self.name), mtime=0))

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def add(self, record: bytes) -> None:
        member = gzip.compress(record, compresslevel=6, mtime=0)
        if self.out is not None and self.records and self.size + len(member) > self.limit:
            self.close()
        if self.out is None:
            self._open()
        self._put(member)
        self.records += 1

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.store.move(self.temp, f"{self.base}/{self.name}")
        self.done.append({"file": self.name, "bytes": self.size, "records": self.records, "sha256": self.sha.hexdigest()})
        self.out, self.number = None, self.number + 1


_MANIFEST = "file string, bytes long, records long, sha256 string"
_MANIFEST_SCHEMA = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64()), ("sha256", pa.string())])


def _write(folder: str, file_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, revisit = None, None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["page_id"], row["digest"])
                if not row["page"]:  # comes before the pages that it holds for
                    revisit = (*key, row["first"])
                    continue
                first = revisit[2] if revisit and revisit[:2] == key else None
                if roll is None or roll.shard != row["shard"]:
                    if roll is not None:
                        roll.close()
                        yield pa.RecordBatch.from_pylist(roll.done, schema=_MANIFEST_SCHEMA)
                    roll = _Roll(folder, row["shard"], file_bytes)
                roll.add(page_record(*key[:1], row["url"], row["payload"] if first is None else None,
                                     row["n"], row["digest"], first, date))
        if roll is not None:
            roll.close()
            yield pa.RecordBatch.from_pylist(roll.done, schema=_MANIFEST_SCHEMA)

    return run


def _shard_of(bounds: list[tuple[int, str, int]]):
    """Column of the shard of a key (page_id, digest, url hash): how many
    bounds it has reached, by binary search; payloads stay in the JVM."""
    if not bounds:
        return lambda *key: F.lit(0)

    @F.arrow_udf("int")
    def shard(ids: pa.Array, digests: pa.Array, urls: pa.Array) -> pa.Array:
        rows = zip(ids.to_pylist(), digests.to_pylist(), urls.to_pylist(), strict=True)
        return pa.array([bisect.bisect_right(bounds, row) for row in rows], pa.int32())

    return shard


def write_warc(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES,
               date: str = DATE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write the pages as WARC files and a manifest into ``folder``; returns it."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
                        F.octet_length(payload).cast("long").alias("n"))
    narrow = keep(rows.select("page_id", "digest", F.xxhash64("url").alias("u"), "n"), "digests")
    total = narrow.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = min(MAX_SHARDS, max(1, -(-total // shard_bytes)))
    key_columns = [F.coalesce("page_id", F.lit(_NULL_ID)).alias("page_id"), F.substring("digest", 1, 16).alias("digest"), "u"]
    keys = sorted(tuple(r) for r in narrow.select(*key_columns).orderBy(F.xxhash64("page_id", "digest", "u"), "page_id", "digest", "u")
                  .limit(KEYS_PER_SHARD * shards).collect()) if shards > 1 else []
    shard_of = _shard_of(sorted({keys[i * len(keys) // shards] for i in range(1, shards)}) if keys else [])
    first = narrow.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"))
    # which pages revisit which goes to the shards beside the payloads, so
    # payloads move once
    revisits = narrow.select("page_id", "digest", "u").distinct().join(first, "digest").where(
        ~F.col("page_id").eqNullSafe(F.col("first")))
    records = (rows.withColumn("u", F.xxhash64("url"))
               .select(shard_of(*key_columns).alias("shard"), "page_id", "digest", "u", F.lit(True).alias("page"), "url", "payload", "n",
                       F.lit(None).cast("long").alias("first"))
               .unionByName(revisits.select(shard_of(*key_columns).alias("shard"), "page_id", "digest", "u", F.lit(False).alias("page"),
                                            "first"), allowMissingColumns=True)
               # by hash, several shards may meet in a task: fewer do in more partitions
               .repartition(4 * shards, "shard").sortWithinPartitions("shard", "page_id", "digest", "u", "page", "url"))
    records.mapInArrow(_write(folder, file_bytes, date), _MANIFEST).write.json(f"{folder}/_manifest")
    store, base = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{base}/_attempts").type == fs.FileType.Directory:
        store.delete_dir(f"{base}/_attempts")  # what lost attempts left
    return folder


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an uncompressed archive."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        first, *lines = raw[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        n = int(headers["Content-Length"])
        block = raw[end + 4:end + 4 + n]
        if len(block) < n or raw[end + 4 + n:end + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield headers, block
        at = end + 8 + n


_PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _pages(raw: bytes) -> Iterator[dict]:
    # GzipFile reads on through small buffers; decompress() copies the whole rest for each member
    with gzip.GzipFile(fileobj=io.BytesIO(raw)) as members:
        whole = members.read()
    for h, block in parse(whole):
        if h["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"block digest of {h['WARC-Record-ID']} differs")
        if h["WARC-Type"] == "warcinfo":
            continue
        http, payload = block.split(b"\r\n\r\n", 1)
        revisit = h["WARC-Type"] == "revisit"
        declared = h["WARC-Payload-Digest"].removeprefix("sha256:")
        digest = declared if revisit else hashlib.sha256(payload).hexdigest()
        if digest != declared:
            raise ValueError(f"payload digest of {h['WARC-Record-ID']} differs")
        n = int(re.search(rb"Content-Length: (\d+)", http)[1])
        yield {"page_id": int(h["WARC-Page-ID"]) if "WARC-Page-ID" in h else None, "url": h.get("WARC-Target-URI"),
               "payload": None if revisit else payload, "payload_bytes": n if revisit else len(payload),
               "payload_digest": digest, "record_type": h["WARC-Type"],
               "refers_to": int(h["WARC-Refers-To-Page-ID"]) if revisit else None}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content, sha in zip(*(batch.column(c).to_pylist() for c in ("file", "content", "sha256")), strict=True):
            if hashlib.sha256(content).hexdigest() != sha:
                raise ValueError(f"{file} differs from the manifest")
            held: list[dict] = []
            for page in _pages(content):
                held.append(page)
                if len(held) == 500:
                    yield pa.RecordBatch.from_pylist(held, schema=_PAGE)
                    held = []
            yield pa.RecordBatch.from_pylist(held, schema=_PAGE)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest,
    record_type, refers_to of every page record of the manifest's files."""
    manifest = spark.read.schema(_MANIFEST).json(f"{folder}/_manifest")
    content = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
               .select(F.element_at(F.split("path", "/"), -1).alias("_name"), "content"))
    named = F.col("file") == F.col("_name")
    missing = manifest.join(content.select("_name"), named, "left_anti").select("file").limit(5).collect()
    if missing:
        raise ValueError(f"files of the manifest are missing: {[r.file for r in missing]}")
    # a file is at most file_bytes and a record; a task takes a few of them
    return (content.join(manifest, named).select("file", "sha256", "content")
            .mapInArrow(_read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                               "record_type string, refers_to long"))


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write the pages to a new folder of the shared store and read them back."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, new_folder(spark, "warc"), **how))


def digest(read: DataFrame) -> DataFrame:
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
