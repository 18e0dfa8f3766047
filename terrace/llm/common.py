"""Shared plumbing of the training-data operators: staged tables in the cluster's shared folder,
block-wise exchanges of packed arrays, and vectorised tokenisation."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whitespace of every contract: \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none and is all on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='terrace-')}"
        spark.sparkContext.setCheckpointDir(base)
    return base


@contextlib.contextmanager
def cleaned_shuffles(spark: SparkSession):
    """Inside, a job's shuffle files are removed as soon as its output is committed, and Python gets a thousand rows at a time,
    as long texts make large batches."""
    wanted = {CLEANUP: "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def file_system(spark: SparkSession, path: str):
    """The path and its file system, whichever it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


class Scratch:
    """Staged tables of one operator call, under the shared folder; what is left goes when the session ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._end)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and return a scan of the files: lineage ends here and survives lost executors."""
        path = f"{self.root}/{name}"
        with cleaned_shuffles(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, f"{self.root}/{name}")

    def _end(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            delete(self.spark, self.root)


#: Keys with more than this share of all rows, and so no more than its inverse, are joined where their rows are.
HOT = 1 / 1000


def met(rows: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """rows joined with `few`, which has one row a key. Rows of hot keys aren't dealt by key: what `few` has for those is
    broadcast, at most 1 / HOT rows, whatever the size of either side. `rows` is read three times, so it should be a staged table."""
    total = rows.count()
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT * total).select(key)
    known = F.broadcast(few.join(F.broadcast(hot), key, "left_semi"))
    others = rows.join(F.broadcast(hot), key, "left_anti").join(few, key)
    return rows.join(known, key).unionByName(others)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0


# ---- native text expressions -------------------------------------------------------------------


def ascii_lower(c):
    """A-Z to a-z, nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def utf8_crc32(c):
    return F.crc32(F.encode(c, "UTF-8"))


# ---- vectorised tokenisation (inside Arrow functions) ------------------------------------------


def column(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def slices(t: pa.Table | pa.RecordBatch, text: str = "text", limit: int = 4 << 20):
    """Runs of rows with about `limit` bytes of text; a longer text comes alone and whole."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column(t, text)), 0).to_numpy(zero_copy_only=False))
    at, n = 0, t.num_rows
    while at < n:
        base = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, base + limit, "right")))
        yield t.slice(at, end - at)
        at = end


def gathered(batches, limit: int):
    """Tables of about `limit` bytes of text, over the borders of batches."""
    held, size = [], 0
    for batch in batches:
        for part in slices(pa.Table.from_batches([batch])):
            held.append(part)
            size += pc.sum(pc.binary_length(column(part, "text"))).as_py() or 0
            if size >= limit:
                yield pa.concat_tables(held)
                held, size = [], 0
    if held:
        yield pa.concat_tables(held)


def words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and how many each text has; null has none."""
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, per = split.flatten(), np.diff(split.offsets.to_numpy())
    real = pc.greater(pc.binary_length(flat), 0)
    doc = np.repeat(np.arange(len(per)), per)
    keep = real.to_numpy(zero_copy_only=False)
    return flat.filter(real), np.bincount(doc[keep], minlength=len(per)).astype(np.int64)


def word_hashes(flat: pa.Array, *digests) -> list[np.ndarray]:
    """Each word's 64-bit hashes; every distinct word is hashed once."""
    coded = flat.dictionary_encode()
    distinct, at = coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    return [np.fromiter((d(w) for w in distinct), np.uint64, len(distinct))[at] if len(at) else np.zeros(0, np.uint64) for d in digests or (xxhash.xxh64_intdigest,)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(28))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(h: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each k consecutive values; the caller masks those across texts."""
    n = max(0, len(h) - k + 1)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g = g * np.uint64(base) + h[j : j + n]
    return mixed(g)


def starts_inside(counts: np.ndarray, k: int) -> np.ndarray:
    """For each of the first total-k+1 positions: do k words from here stay in one text?"""
    doc = np.repeat(np.arange(len(counts)), counts)
    n = max(0, len(doc) - k + 1)
    return doc[:n] == doc[k - 1 : k - 1 + n]


# ---- packed arrays -----------------------------------------------------------------------------


SHRINK, GROW = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, each weight a zstd frame of its own; weights that are zero throughout take no space."""
    if not len(a):
        return b""
    weights = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
    frames = [SHRINK.compress(w.tobytes()) if w.any() else b"" for w in weights]
    return np.array([len(a), *map(len, frames)], np.uint32).tobytes() + b"".join(frames)


def unpack(b: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    if not b:
        return np.zeros(0, dtype)
    n, *sizes = np.frombuffer(b, np.uint32, 1 + dtype.itemsize).tolist()
    out, at = np.zeros((n, dtype.itemsize), np.uint8), 4 * (1 + dtype.itemsize)
    for i, size in enumerate(sizes):
        if size:
            out[:, i] = np.frombuffer(GROW.decompress(b[at : at + size]), np.uint8)
            at += size
    return out.view(dtype).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b: bytes, dtype=np.uint64) -> np.ndarray:
    return np.cumsum(unpack(b, dtype), dtype=dtype)


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    """Ranges of equal width over 64-bit keys, so sorted keys have sorted buckets."""
    return ((key >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def cuts(bucket: np.ndarray, n: int):
    """(bucket, from, to) of each run of a sorted column of buckets."""
    at = np.searchsorted(bucket, np.arange(n + 1))
    return [(i, x, y) for i, (x, y) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)) if y > x]


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted columns."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
