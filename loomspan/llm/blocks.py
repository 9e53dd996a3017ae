"""Block exchange: what the corpus-wide operators of this package share.

A map task reads one partition of whole texts, reduces it locally and sends each bucket of a hash space one packed
binary per block. A reduce task sees one bucket: at most one packed record per block, however hot a key is, since
the local reduction has already merged the key's rows. Rows in flight grow with blocks x buckets, bytes with what the
blocks hold.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one bucket of an exchange is meant to serve.
BUCKET_BYTES = 24 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, a session of one machine gets a temporary one; a cluster is refused, as its executors would not share it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="loomspan-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/loomspan-{uuid.uuid4().hex}"


def fresh(df: DataFrame, name: str) -> str:
    """A column name like this one that df doesn't have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the shared folder and cuts its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Materialises df, of a few numbers a row, and marks it for broadcast if it has no more than so many rows; a larger one is joined by shuffle."""
    df = cut(df)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def arrow_rows(spark: SparkSession, rows: int):
    """Within it, jobs pass so many rows at a time to Python: whole texts make large batches, in the JVM and in the worker."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffles_freed(spark: SparkSession):
    """Within it, a DataFrame that is made and materialised leaves no shuffle files; else they stay until the driver happens to collect its garbage. For rounds of jobs that go on from what cut() holds."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def slices(batches, rows: int = 1000):
    """Record batches in slices of so many rows, so that Python holds few whole texts at a time; memory goes back at the end."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
    give_back()


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of a column over all rows: the size that bucket counts are derived from."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def bucket_count(size: int, per_bucket: int = BUCKET_BYTES) -> int:
    return max(1, -(-size // per_bucket))


def strings(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column, nulls as empty texts, without a copy where there are none."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off.astype(np.int64)


def spans_of(off: np.ndarray, limit: int):
    """Row ranges whose texts hold about `limit` bytes; a longer text is a range of its own."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def sent(names: list[str], types: list[pa.DataType], rows: list[tuple], size: int = 1 << 20):
    """Rows that end in a binary as record batches of about `size` bytes: the JVM holds a batch whole, and large arrays fill its heap with humongous objects."""
    lo = held = 0
    for i, row in enumerate(rows):
        held += len(row[-1])
        if held >= size or i == len(rows) - 1:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo : i + 1], strict=True), types, strict=True)], names)
            lo, held = i + 1, 0


def groups(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in a sorted array."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)


def give_back() -> None:
    """Returns freed memory to the system: Python workers are kept for later tasks, and their executor's memory is shared."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one binary: their lengths, then their bytes."""
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, np.int64, len(types))
    at, out = 8 * len(types), []
    for n, t in zip(sizes, types, strict=True):
        out.append(np.frombuffer(blob, t, int(n), at))
        at += int(n) * np.dtype(t).itemsize
    return out


def shrink(x: np.ndarray, ascending: bool = False) -> np.ndarray:
    """An array's bytes, differences of ascending values, by place in the value and compressed."""
    if ascending:
        x = np.diff(x, prepend=x.dtype.type(0))
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T
    z = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)
    return np.frombuffer(np.array([len(x)], np.int64).tobytes() + z, np.uint8)


def expand(z: np.ndarray, dtype, ascending: bool = False) -> np.ndarray:
    """What shrink packed."""
    z, size = z.tobytes(), np.dtype(dtype).itemsize
    n = int(np.frombuffer(z, np.int64, 1)[0])
    planes = np.frombuffer(pa.decompress(z[8:], decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    x = np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).reshape(n)
    return np.cumsum(x, dtype=dtype) if ascending else x
