"""WARC archives with a two-level capture index (operator 6).

Writing: one gzip member per record, so a record can be read from its byte
range alone. Payloads of a size worth it that occur more than once are
written once, as the response of the largest id; the others become revisits. Every task
writes its own files under fresh names and returns where each record went;
only the rows of successful tasks reach the capture table, so a retried or
speculative task leaves at most an unused file.

Index: captures sorted by URL key (reversed host, then path) into compressed
blocks, plus a directory with the first and last key of each block. A lookup
bisects the directory for the blocks that can hold a key, decompresses
only these, finds the key's captures there by bisection and reads their byte ranges.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screensift.llm.frames import chunks, materialise, shuffle_partitions
from screensift.session import scratch_path

#: Payloads from this size on are written once.
MIN_DEDUP_BYTES = 1000
#: Captures per index block; bytes from which a task begins a new archive file; gzip level.
BLOCK_CAPTURES, FILE_BYTES, LEVEL = 1000, 256 << 20, 3
#: A directory of more blocks than this is not broadcast: its key ranges are, and blocks meet keys within a range.
MAX_DIRECTORY = 200_000
DATE = "1970-01-01T00:00:00Z"
CRLF = b"\r\n"

CAPTURE = "url_key string, id string, file string, offset bigint, length bigint"
RECORD = ("url_key string, id string, url string, record_type string, refers_to string, "
          "payload_bytes bigint, payload_digest string, payload binary")


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query: ``com,example,www)/path?q``. '' for NULL or no host."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", url or "")
    if not m:
        return (url or "").lower()
    host, _, port = m[1].rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (m[2] or "/")


def _record_uri(page_id: str) -> str:
    return f"<urn:page:{page_id}>"


def _record(kind: str, page_id: str, url: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header (with the full payload's length) and no payload."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: %d" % len(payload), b"", b""])
    block = http + (payload if kind == "response" else b"")
    uri = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)
    head = [("WARC-Type", kind), ("WARC-Record-ID", _record_uri(page_id)), ("WARC-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block)))]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _record_uri(refers_to))]
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in head)]
    return CRLF.join([*lines, b"", b""]) + block + CRLF + CRLF


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one uncompressed record."""
    head, _, rest = data.partition(CRLF + CRLF)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: local, HDFS, S3, GCS, ABFS, by its scheme."""
    return pafs.FileSystem.from_uri(uri if re.match(r"[a-z0-9]+:", uri) else f"file://{uri}")


@dataclass
class Archive:
    """A written archive: its folder, capture table, index blocks and block directory."""

    folder: str
    blocks: DataFrame
    directory: DataFrame


def revisits(payloads: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """(id, digest, n_bytes) -> (digest, response): the payloads that occur more than once, and the largest id with each.

    Pre-aggregated per digest, so a payload on a third of all pages costs one row per task.
    """
    return payloads.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.max("id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = MIN_DEDUP_BYTES, folder: str | None = None,
                  date: str = DATE) -> tuple[DataFrame, str]:
    """Write one record per row into .warc.gz files; returns the capture table (url_key, id, file, offset, length) and the folder.

    The payload is the UTF-8 text (NULL: empty). Of equal payloads of
    ``min_bytes`` or more the largest id is the response; repeated rows of that id are
    all responses, and a NULL id is one only where no id exists. NULL URLs are written empty.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"),
                        F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n_bytes"), payload.alias("payload"))
    again = revisits(rows.select("id", "digest", "n_bytes"), min_bytes)
    # small payloads and unique ones meet nothing; their keys are spread so that they do not pile up
    join_key = F.when(F.col("n_bytes") >= min_bytes, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("id").cast("string"), F.col("url"))))
    typed = rows.withColumn("join_key", join_key).join(again.withColumnRenamed("digest", "join_key"), "join_key", "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("id"), "url", "digest", "payload",
        F.when(F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("id")), F.col("response").cast("string")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for b in chunks(batches, "payload"):
            captures = []
            for page_id, url, digest, text, refers_to in zip(*(b.column(c).to_pylist() for c in ("id", "url", "digest", "payload", "refers_to"))):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                kind = "revisit" if refers_to is not None else "response"
                member = gzip.compress(_record(kind, page_id, url, text.encode("utf-8", "surrogatepass"), digest, refers_to, date), LEVEL, mtime=0)
                out.write(member)
                captures.append((url_key(url), page_id, name, at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*captures)], ["url_key", "id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return materialise(typed.mapInArrow(write, CAPTURE), "captures"), folder


def build_index(captures: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> Archive:
    """Sort captures by key into compressed blocks; the directory keeps the first and last key of each block.

    ``part`` names the key range a block lies in; there are as many ranges as shuffle partitions.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part = uuid.uuid4().hex  # the key range that this task has

        def block(rows):
            lines = "\n".join(json.dumps(r, ensure_ascii=True) for r in rows)
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([uuid.uuid4().hex]), pa.array([rows[0][0]]), pa.array([rows[-1][0]]),
                                               pa.array([zlib.compress(lines.encode())], pa.binary())], ["part", "block", "first", "last", "data"])

        for b in batches:
            held += zip(*(b.column(c).to_pylist() for c in ("url_key", "id", "file", "offset", "length")))
            while len(held) >= block_captures:
                yield block(held[:block_captures])
                held = held[block_captures:]
        if held:
            yield block(held)

    ranged = captures.repartitionByRange(shuffle_partitions(captures), "url_key", "id").sortWithinPartitions("url_key", "id", "file", "offset")
    blocks = materialise(ranged.mapInArrow(pack, "part string, block string, first string, last string, data binary"), "capture-index")
    return Archive(folder, blocks, blocks.select("part", "block", "first", "last"))


def _bisected(keys: DataFrame, rows: list[tuple[str, str, str]], before: bool = False) -> DataFrame:
    """(url_key) -> (name, url_key) for the sorted (first, last, name) ranges that can hold the key.

    ``before``: the last range that begins below the key, or none.
    """
    shared = keys.sparkSession.sparkContext.broadcast(tuple(zip(*rows)) if rows else ((), (), ()))

    def bisect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, name = shared.value

        def ranges(key: str) -> range:
            upto = bisect_left(first, key) if before else bisect_right(first, key)
            return range(max(0, upto - 1) if before else bisect_left(last, key), upto)

        for b in batches:
            found = [(name[i], k) for k in b.column(0).to_pylist() for i in ranges(k)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())],
                                             ["name", "url_key"])

    return keys.mapInArrow(bisect, "name string, url_key string")


def _blocks_of(archive: Archive, keys: DataFrame, max_directory: int) -> DataFrame:
    """(url_key) -> (block, url_key): the blocks that can hold a key; neighbouring blocks may share one.

    A directory of up to ``max_directory`` blocks is bisected whole. Of a larger one only its
    key ranges are (one per index partition); within a range the keys meet the blocks in sorted
    order: a key lies in the last block that begins below it, and in those that begin with it.
    """
    directory = archive.directory
    if directory.count() <= max_directory:
        rows = sorted((r.first, r.last, r.block) for r in directory.toLocalIterator())
        return _bisected(keys, rows).withColumnRenamed("name", "block")
    parts = directory.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect()
    dealt = _bisected(keys, sorted((r["first"], r["last"], r.part) for r in parts), before=True).select(
        F.col("name").alias("part"), F.col("url_key").alias("key"), F.lit(None).cast("string").alias("block"), F.lit(None).cast("string").alias("last"))
    merged = dealt.union(directory.select("part", F.col("first").alias("key"), "block", "last"))
    # keys come before the blocks that begin with them; of such blocks the one that reaches furthest is last
    order = Window.partitionBy("part").orderBy("key", F.col("block").isNotNull(), "last")
    latest = F.last(F.when(F.col("block").isNotNull(), F.struct("block", "last")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    below = merged.withColumn("held", latest).where(F.col("block").isNull() & (F.col("held.last") >= F.col("key"))).select("held.block", F.col("key").alias("url_key"))
    begin = directory.join(keys, F.col("first") == F.col("url_key")).select("block", "url_key")
    return below.union(begin)


def lookup(archive: Archive, keys: DataFrame, max_directory: int = MAX_DIRECTORY) -> DataFrame:
    """(url_key) -> captures of these keys; repeated keys count once, unknown and NULL keys find nothing."""
    wanted = _blocks_of(archive, keys.where("url_key IS NOT NULL").distinct(), max_directory)
    # a block holds at most block_captures keys that exist; a request for more (unknown keys) is dealt into parts
    part = F.pmod(F.xxhash64("url_key"), F.lit(8))
    asked = wanted.groupBy("block", part.alias("part")).agg(F.collect_set("url_key").alias("keys"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1)
                rows = [json.loads(x) for x in zlib.decompress(b.column("data")[0].as_py()).split(b"\n")]
                sorted_keys = [r[0] for r in rows]
                hits = [rows[j] for k in b.column("keys")[0].as_py() for j in range(bisect_left(sorted_keys, k), bisect_right(sorted_keys, k))]
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*hits)], ["url_key", "id", "file", "offset", "length"])

    return archive.blocks.select("block", "data").join(asked, "block").select("data", "keys").mapInArrow(find, CAPTURE)


def read_records(archive_folder: str, captures: DataFrame) -> DataFrame:
    """Range-read captures: (url_key, id, url, record_type, refers_to, payload_bytes, payload_digest, payload).

    Byte ranges are dealt by file and 64 MB stretch and read in order. Digest
    and size are of the full payload: a response's are recomputed from the bytes read (a
    mismatch fails the task), a revisit's stand in its header, and its payload is NULL.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(archive_folder)
        name, file = None, None
        for b in batches:
            rows, size = [], 0
            for key, file_name, offset, length in zip(*(b.column(c).to_pylist() for c in ("url_key", "file", "offset", "length"))):
                if file_name != name:
                    if file is not None:
                        file.close()
                    name, file = file_name, fs.open_input_file(f"{root}/{file_name}")
                fields, block = parse_record(gzip.decompress(file.read_at(length, offset)))
                http, _, payload = block.partition(CRLF + CRLF)
                digest = fields["WARC-Payload-Digest"].partition(":")[2]
                full = int(re.search(rb"Content-Length: (\d+)", http)[1])
                if fields["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != full):
                    raise ValueError(f"damaged record at {file_name}:{offset}")
                refers_to = fields.get("WARC-Refers-To")
                rows.append((key, fields["WARC-Record-ID"][10:-1], fields["WARC-Target-URI"], fields["WARC-Type"],
                             refers_to and refers_to[10:-1], full, digest, payload if fields["WARC-Type"] == "response" else None))
                size += len(payload)
                if size > 1 << 22:
                    yield _record_batch(rows)
                    rows, size = [], 0
            yield _record_batch(rows)
        if file is not None:
            file.close()

    stretch = F.expr("offset div 67108864")
    dealt = captures.repartition(shuffle_partitions(captures), "file", stretch).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, RECORD)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
    names = ["url_key", "id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    cols = zip(*rows) if rows else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def url_key_column(url: Column) -> Column:
    """``url_key`` of a URL column."""
    @F.pandas_udf("string")
    def keys(urls):
        return urls.map(url_key)

    return keys(F.coalesce(url.cast("string"), F.lit("")))


def archive_pages(spark: SparkSession, pages: DataFrame, **columns) -> Archive:
    """Write the pages and index their captures."""
    captures, folder = write_archive(pages, **columns)
    return build_index(captures, folder)
