"""WARC archives with a two-level capture index.

Writers put gzipped records (one member each) in archive files. The index is sorted by reversed-host URL key, cut in
compressed blocks of BLOCK captures; a sparse directory holds each block's first key, file, offset and length. A
lookup searches the directory by bisection, reads one range for a block, searches the block by bisection and reads
one range for the record. Files go through pyarrow.fs, to whatever store the folder names.

A writer's file is named by its task attempt, and only rows of attempts that succeeded name files: a lost executor's
half-written file is never read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import cut, shared_dir, small

BLOCK = 512
LEVEL = 1
STRETCH = 16 << 20


def store(folder: str):
    """(file system, path) of a folder's URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query: captures of a domain and its subdomains sort together. A null or broken URL's key is its text."""
    url = url or ""
    try:
        u = urlsplit(url)
        host = ",".join(reversed((u.hostname or "").split(".")))
        port = f":{u.port}" if u.port else ""
    except ValueError:
        return url
    return f"{host}{port}){u.path or '/'}{'?' + u.query if u.query else ''}".lower() if host else url


def b32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, revisit_of, size: int, digest: str) -> bytes:
    """One WARC/1.1 record, gzipped. A revisit has no payload; the full payload's size is in an extension header."""
    kind = "response" if revisit_of is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Target-URI: {re.sub(r'[\r\n]', '', url or '')}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit_of is not None:
        head += [f"WARC-Refers-To: <urn:page:{revisit_of}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if revisit_of is None else b"")
    head.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", LEVEL, mtime=0)


def parse(member: bytes) -> dict:
    """Headers, payload and kind of a gzipped record. A payload that its digest doesn't fit is an error."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[: int(headers["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    out = {"kind": headers["WARC-Type"], "headers": headers, "payload": payload, "digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"), "size": int(headers["X-Payload-Length"])}
    if out["kind"] == "response" and (len(payload) != out["size"] or b32_sha1(payload) != out["digest"]):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return out


def page_number(urn: str | None):
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def verdicts(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(digest, refers_to) of payloads of at least least_bytes that several rows share: refers_to is the largest page_id. Counted on the map side; html itself isn't shuffled."""
    slim = pages.where(F.octet_length("html") >= least_bytes).groupBy(F.sha1(F.col("html").cast("binary")).alias("_sha"))
    return slim.agg(F.count("*").alias("_n"), F.max("page_id").alias("_first")).where("_n > 1").select("_sha", "_first")


def write(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes a record for every row of pages (page_id, url, html) and the index; returns the folder and the directory of blocks.

    Null html is an empty payload. Rows with equal payloads: those with the largest page_id are responses, the others revisit it; a null page_id is less than any. Repeated rows are records of their own.
    """
    spark = pages.sparkSession
    folder = folder or shared_dir(spark)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    marked = slim.withColumn("_sha", F.sha1(F.col("html").cast("binary"))).join(small(verdicts(slim, least_bytes)), "_sha", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))

    def archive(batches):
        from pyspark import TaskContext

        system, root = store(folder)
        system.create_dir(root, recursive=True)
        c = TaskContext.get()
        name = f"part-{c.partitionId():06d}-{c.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
        at, out = 0, None
        try:
            for batch in batches:
                cols = {"key": [], "file": [], "at": [], "size": []}
                for p, u, h, r in zip(*(batch.column(x).to_pylist() for x in ("page_id", "url", "html", "refers_to")), strict=True):
                    payload = h.encode()
                    member = record(p, u, payload, r, len(payload), b32_sha1(payload))
                    out = out or system.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(member)
                    for k, v in (("key", url_key(u)), ("file", name), ("at", at), ("size", len(member))):
                        cols[k].append(v)
                    at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(cols["key"], pa.string()), pa.array(cols["file"], pa.string()), pa.array(cols["at"], pa.int64()), pa.array(cols["size"], pa.int64())], list(cols))
        finally:
            if out is not None:
                out.close()

    captures = cut(marked.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(archive, "key string, file string, at long, size long"))
    # range partitions by key: hot hosts split by path, equal keys by place in the archive
    spread = captures.repartitionByRange("key", "file", "at").sortWithinPartitions("key", "file", "at")

    def index(batches):
        from pyspark import TaskContext

        system, root = store(folder)
        system.create_dir(root, recursive=True)
        c = TaskContext.get()
        name = f"index-{c.partitionId():06d}-{c.taskAttemptId()}-{uuid.uuid4().hex[:8]}.gz"
        at, out, held, rows = 0, None, [], []

        def block():
            nonlocal at, out, held
            data = zlib.compress("\n".join(json.dumps(x) for x in held).encode(), 6)
            out = out or system.open_output_stream(f"{root}/{name}", compression=None)
            out.write(data)
            rows.append((held[0][0], name, at, len(data), len(held), sum(x[3] for x in held)))
            at += len(data)
            held = []

        try:
            for batch in batches:
                for x in zip(*(batch.column(n).to_pylist() for n in ("key", "file", "at", "size")), strict=True):
                    held.append(x)
                    if len(held) == BLOCK:
                        block()
            if held:
                block()
        finally:
            if out is not None:
                out.close()
        cols = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.string(), pa.string(), *[pa.int64()] * 4), strict=True)], ["first_key", "index", "at", "size", "n", "record_bytes"])

    directory = cut(spread.mapInArrow(index, "first_key string, index string, at long, size long, n long, record_bytes long"))
    return folder, directory


def read_block(system, path: str, at: int, size: int) -> list[list]:
    with system.open_input_file(path) as f:
        return [json.loads(x) for x in zlib.decompress(f.read_at(size, at)).split(b"\n")]


def segmented(directory: DataFrame) -> tuple[DataFrame, list[str]]:
    """The directory in segments of ascending first keys, equal keys together, and where each starts. A segment also has the last block of the one before, which may hold captures of its first key. Segments are as many as the session's partitions."""
    parts = cut(directory.repartitionByRange("first_key").withColumn("segment", F.spark_partition_id()))
    ends = parts.groupBy("segment").agg(F.min("first_key").alias("start"), F.max(F.struct("first_key", "index", "at", "size")).alias("last")).orderBy("segment").collect()
    after = [(i + 1, *ends[i].last) for i in range(len(ends) - 1)]
    number = F.create_map(*(F.lit(x) for i, r in enumerate(ends) for x in (r.segment, i))) if ends else F.lit(None).cast("map<int,int>")
    own = parts.select(number[F.col("segment")].alias("segment"), "first_key", "index", "at", "size")
    schema = "segment int, first_key string, index string, at long, size long"
    return own.unionByName(directory.sparkSession.createDataFrame(after, schema)), [r.start for r in ends]


def find(spark: SparkSession, folder: str, directory: DataFrame, urls: DataFrame) -> DataFrame:
    """file, at, size of every capture of urls (column url, repeats count once): a bisection of a segment of the directory gives the blocks that may hold a key, a bisection of each block its captures. Blocks are read once for all their keys, and those of one key by many tasks."""

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], ["key"])

    blocks, starts = segmented(directory)

    def segment_of(batches):
        for batch in batches:
            at = [max(0, bisect.bisect_right(starts, k) - 1) for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(at, pa.int32())], ["key", "segment"])

    def search(batches):
        """Rows by segment: its blocks in order, then the keys."""
        last, first, held = None, [], []
        for batch in batches:
            out = []
            for seg, key, *block in zip(*(batch.column(x).to_pylist() for x in ("segment", "key", "first_key", "index", "at", "size")), strict=True):
                if seg != last:
                    last, first, held = seg, [], []
                if key is None:
                    first.append(block[0])
                    held.append(block[1:])
                    continue
                i = max(0, bisect.bisect_left(first, key) - 1)
                while i < len(first) and first[i] <= key:
                    out.append((*held[i], key))
                    i += 1
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["index", "at", "size", "key"])

    def captures(batches):
        """Rows by block: the keys that it may hold."""
        system, root = store(folder)
        last, rows = None, []
        for batch in batches:
            out = []
            for *block, key in zip(*(batch.column(x).to_pylist() for x in ("index", "at", "size", "key")), strict=True):
                if block != last:
                    last, rows = block, read_block(system, f"{root}/{block[0]}", *block[1:])
                j = bisect.bisect_left(rows, [key])
                while j < len(rows) and rows[j][0] == key:
                    out.append(rows[j][1:])
                    j += 1
            cols = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["file", "at", "size"])

    wanted = urls.select("url").distinct().mapInArrow(keys, "key string").distinct().mapInArrow(segment_of, "key string, segment int")
    both = blocks.select("segment", F.lit(None).cast("string").alias("key"), "first_key", "index", "at", "size").unionByName(wanted.select("segment", "key"), allowMissingColumns=True)
    order = ["segment", F.col("key").asc_nulls_first(), "first_key", "index", "at"]
    found = both.repartition("segment").sortWithinPartitions(*order).mapInArrow(search, "index string, at long, size long, key string")
    return found.repartition("index", "at").sortWithinPartitions("index", "at", "key").mapInArrow(captures, "file string, at long, size long")


def read(spark: SparkSession, folder: str, directory: DataFrame, urls: DataFrame) -> DataFrame:
    """Every record of urls (column url): page_id, payload_bytes, payload_digest, record_type, refers_to, payload (a revisit has none of its own). URLs that were not captured have no row."""

    def records(batches):
        system, root = store(folder)
        held, name = None, None
        try:
            for batch in batches:
                out = []
                for file, at, size in zip(*(batch.column(x).to_pylist() for x in ("file", "at", "size")), strict=True):
                    if file != name:
                        if held:
                            held.close()
                        held, name = system.open_input_file(f"{root}/{file}"), file
                    r = parse(held.read_at(size, at))
                    out.append((page_number(r["headers"]["WARC-Record-ID"]), r["size"], r["digest"], r["kind"], page_number(r["headers"].get("WARC-Refers-To")), r["payload"]))
                cols = list(zip(*out, strict=True)) or [()] * 6
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
        finally:
            if held:
                held.close()

    # records of a file are read in its order, in stretches of 16 MB; entries are small, so tasks are counted by what they point to
    stretch = (F.col("at") / STRETCH).cast("long")
    tasks = max(1, -(-(directory.agg(F.sum("record_bytes")).first()[0] or 0) // STRETCH))
    places = find(spark, folder, directory, urls).repartition(tasks, "file", stretch).sortWithinPartitions("file", "at")
    return places.mapInArrow(records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The op7 query: writes a record for every row of pages (page_id, url, html), then looks all their URLs up. Null html is an empty payload, a null or broken URL a key of its own text; repeated rows are records of their own. No rows: no rows."""
    folder, directory = write(pages, least_bytes)
    return read(pages.sparkSession, folder, directory, pages).drop("payload")


#: SQL of round_trip over `pages`. Base 32 goes by five hexadecimal digits, four characters, at a time.
ORACLE = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
q AS (SELECT *, sha1(raw) AS hex, max(page_id) OVER (PARTITION BY raw) AS last FROM p)
SELECT page_id, octet_length(raw)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM q"""
