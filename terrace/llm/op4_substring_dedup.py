"""Substring dedup by a log-structured fingerprint index.

Every run of 13 words is a window. The index holds, for each window, a sampled fingerprint: the least hash of the seven
7-word sequences in it, so equal windows always have equal fingerprints and a text of n words has about n/4 different
ones. Documents come in batches, in the order of their ids. A batch's texts are stored as blocks of word numbers and its
fingerprints as a sorted immutable run; the batch is merge-joined, bucket by bucket, with the runs of all batches so
far. Windows whose fingerprint another document has are verified by a 128-bit hash of all 13 words, to which the blocks
of earlier batches add theirs, and by the least doc_id that has the window. Runs are compacted when there are many; a
run is never changed, only replaced by the one that holds it.

An `Index` lives in a folder and outlives the call: adding a batch reads the fingerprints and word numbers of earlier
ones, never their texts, and gives the result of that batch, the same as if all had come at once. Earlier results
stand, which is why batches come in the order of ids; one that doesn't is refused.

A block sends each bucket its distinct sorted keys and gets back values in the same order, so a passage that very many
documents share costs one entry a block, and no group of copies meets in one task.

Nulls: a null text has no words; a null doc_id counts as larger than any other. Empty texts have no words and
the SHA-256 of the empty string. Very long texts are a block of their own. Rows with equal doc_ids never remove words of
each other. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

WINDOW, GRAM = 13, 7
NO_ID = np.iinfo(np.int64).max
BLOCK_BYTES, BUCKET_BYTES = 5 << 20, 16 << 20
#: Runs that an index has at most before they are made one, and batches of a single call.
MAX_RUNS, BATCHES = 8, 2
BLOCKS = "blk string, ids array<bigint>, counts binary, tokens binary, words binary, entries array<struct<bucket: int, keys: binary, least: binary, several: binary>>"
RUN = "bucket int, keys binary, least binary, several binary"
WINDOWS = "blk string, own boolean, bucket int, keys binary, more binary, least binary"
ANSWER = "blk string, bucket int, kind string, answer binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
KINDS = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow(rows: list, ddl: str) -> pa.Table:
    fields = [x.split() for x in ddl.split(", ")]
    cols = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table([pa.array(list(x), KINDS[k]) for x, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


# ---- blocks ------------------------------------------------------------------------------------


def store_blocks(batches, buckets: int, name: str):
    """A row a block: its rows, its words, tokens as places among them, and its fingerprints by bucket."""
    task = TaskContext.get().partitionId()
    for number, t in enumerate(c.gathered(batches, BLOCK_BYTES)):
        flats, counts = zip(*(c.words(c.column(part, "text")) for part in c.slices(t)), strict=True)
        coded = pa.chunked_array(flats).combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        words = zstandard.ZstdCompressor(level=1).compress(b" ".join(coded.dictionary.cast(pa.binary()).to_pylist()))
        tokens, counts = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32), np.concatenate(counts).astype(np.uint32)
        row = pa.table({"ids": pa.array([c.column(t, "doc_id").to_pylist()], pa.list_(pa.int64())), "counts": [c.pack(counts)], "tokens": [c.pack(tokens)], "words": [words]})
        block = Block(row)
        keys, least, several = distinct(block.ids[block.doc], block.fp)
        at = c.cuts(c.bucket_of(keys, buckets), buckets)
        entries = [{"bucket": i, "keys": c.pack_sorted(keys[x:y]), "least": c.pack(least[x:y]), "several": c.pack(several[x:y])} for i, x, y in at]
        kind = pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary()), ("least", pa.binary()), ("several", pa.binary())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{name}-{task}-{number}"]), *(c.column(row, x) for x in ("ids", "counts", "tokens", "words")), pa.array([entries], kind)],
            names=["blk", "ids", "counts", "tokens", "words", "entries"],
        )


class Block:
    """A block's words, and for each of its windows the row it is in, where it begins and its fingerprint."""

    def __init__(self, t: pa.Table):
        ids = t.column("ids").combine_chunks().values
        self.doc_id, self.ids = ids, pc.fill_null(ids, NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        self.counts = c.unpack(t.column("counts")[0].as_py(), np.uint32).astype(np.int64)
        self.tokens = c.unpack(t.column("tokens")[0].as_py(), np.uint32)
        words = zstandard.ZstdDecompressor().decompress(t.column("words")[0].as_py())
        self.words = words.split(b" ") if words else []
        self.h = self.hashed(xxhash.xxh64_intdigest)
        ok = c.starts_inside(self.counts, WINDOW)
        s = c.grams(self.h, GRAM)
        m = s[: len(ok)].copy()
        for j in range(1, WINDOW - GRAM + 1):
            np.minimum(m, s[j : j + len(ok)], out=m)
        self.at = np.flatnonzero(ok)
        self.fp, self.doc = m[ok], np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)[: len(ok)][ok]

    def hashed(self, digest) -> np.ndarray:
        """Each token's hash; every distinct word is hashed once."""
        return np.fromiter((digest(w) for w in self.words), np.uint64, len(self.words))[self.tokens] if len(self.tokens) else np.zeros(0, np.uint64)

    def candidates(self, shared: np.ndarray):
        """Windows with a shared fingerprint, with both halves of their 128-bit hash. `shared` goes by sorted fingerprints."""
        hit = np.flatnonzero(shared[np.searchsorted(np.unique(self.fp), self.fp)]) if len(self.fp) else np.zeros(0, np.int64)
        if not len(hit):
            return hit, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        at = self.at[hit]
        return hit, c.grams(self.h, WINDOW)[at], c.grams(self.hashed(xxhash.xxh3_64_intdigest), WINDOW, 0xC2B2AE3D27D4EB4F)[at]


def distinct(ids: np.ndarray, *keys: np.ndarray):
    """The distinct keys in order, the least id of each, and whether several ids have it."""
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(tuple(reversed(keys)))
    keys, ids = [k[order] for k in keys], ids[order]
    s = c.group_starts(*keys)
    if not len(s):
        return *keys, ids, np.zeros(0, bool)
    low, high = np.minimum.reduceat(ids, s), np.maximum.reduceat(ids, s)
    return *[k[s] for k in keys], low, low != high


def received(t: pa.Table, kind: str, dtype) -> np.ndarray:
    """The answers of one kind, in the order of the keys sent."""
    got = sorted((b, a) for b, k, a in zip(t.column("bucket").to_pylist(), t.column("kind").to_pylist(), t.column("answer").to_pylist(), strict=True) if k == kind)
    return np.concatenate([c.unpack(a, dtype) for _, a in got]) if got else np.zeros(0, dtype)


# ---- runs --------------------------------------------------------------------------------------


def merge_runs(key, t: pa.Table) -> pa.Table:
    """One sorted run of the entries of a bucket."""
    keys = [c.unpack_sorted(x) for x in t.column("keys").to_pylist()]
    low = [c.unpack(x, np.int64) for x in t.column("least").to_pylist()]
    several = np.concatenate([c.unpack(x, bool) for x in t.column("several").to_pylist()])
    k, ids = np.concatenate(keys), np.concatenate(low)
    order = np.argsort(k)
    k, ids, several = k[order], ids[order], several[order]
    s = c.group_starts(k)
    least, most = np.minimum.reduceat(ids, s), np.maximum.reduceat(ids, s)
    more = np.logical_or.reduceat(several, s) | (least != most)
    return arrow([(key[0].as_py(), c.pack_sorted(k[s]), c.pack(least), c.pack(more))], RUN)


def probe_runs(key, batch: pa.Table, own: pa.Table, old: pa.Table) -> pa.Table:
    """Merge join of a bucket's fingerprints with the batch's run and the older ones: which belong to several documents?
    The batch gets an answer an entry; what it shares with older runs is one row, for the blocks that made those."""
    blk, bucket = batch.column("blk").to_pylist(), key[0].as_py()
    k, shared = c.unpack_sorted(own.column("keys")[0].as_py()), c.unpack(own.column("several")[0].as_py(), bool).copy()
    hit = np.zeros(len(k), bool)
    for x in old.column("keys").to_pylist():
        hit |= np.isin(k, c.unpack_sorted(x), assume_unique=True)
    shared |= hit
    rows = [(b, bucket, "shared", c.pack(shared[np.searchsorted(k, c.unpack_sorted(x))])) for b, x in zip(blk, batch.column("keys").to_pylist(), strict=True)]
    return arrow([*rows, (None, bucket, "hit", c.pack_sorted(k[hit]))], ANSWER)


def probe_old(key, entries: pa.Table, hit: pa.Table) -> pa.Table:
    """Which fingerprints of older blocks did the batch bring again?"""
    again = c.unpack_sorted(hit.column("answer")[0].as_py()) if hit.num_rows else np.zeros(0, np.uint64)
    rows = zip(entries.column("blk").to_pylist(), entries.column("keys").to_pylist(), strict=True)
    return arrow([(b, key[0].as_py(), "shared", c.pack(np.isin(c.unpack_sorted(x), again, assume_unique=True))) for b, x in rows], ANSWER)


# ---- windows -----------------------------------------------------------------------------------


def emit_windows(key, t: pa.Table, got: pa.Table, own: bool, buckets: int) -> pa.Table:
    block = Block(t)
    hit, a, b = block.candidates(received(got, "shared", bool))
    a, b, least, _ = distinct(block.ids[block.doc[hit]], a, b)
    return arrow(
        [(key[0].as_py(), own, i, c.pack_sorted(a[x:y]), c.pack(b[x:y]), c.pack(least[x:y])) for i, x, y in c.cuts(c.bucket_of(a, buckets), buckets)],
        WINDOWS,
    )


def verify(key, t: pa.Table) -> pa.Table:
    """For each block's windows of a bucket: how far below the block's own least doc_id is the least of all?"""
    names = ("blk", "own", "bucket", "keys", "more", "least")
    sent = [(blk, own, b, c.unpack_sorted(k), c.unpack(m, np.uint64), c.unpack(x, np.int64)) for blk, own, b, k, m, x in zip(*(t.column(n).to_pylist() for n in names), strict=True)]
    a, m, ids = (np.concatenate([x[i] for x in sent]) for i in (3, 4, 5))
    order = np.lexsort((m, a))
    s = c.group_starts(a[order], m[order])
    low = np.empty(len(ids), np.int64)
    low[order] = np.repeat(np.minimum.reduceat(ids[order], s), np.diff(np.append(s, len(ids))))
    cut = np.cumsum([0, *(len(x[3]) for x in sent)])
    return arrow([(x[0], x[2], "below", c.pack((x[5] - low[i:j]).astype(np.uint64))) for x, i, j in zip(sent, cut[:-1], cut[1:], strict=True) if x[1]], ANSWER)


def clean(t: pa.Table, got: pa.Table, texts: bool) -> pa.Table:
    block = Block(t)
    hit, a, b = block.candidates(received(got, "shared", bool))
    below = received(got, "below", np.uint64)
    ids = block.ids[block.doc[hit]]
    gone = np.zeros(len(block.h) + 1, np.int32)
    if len(hit):
        order = np.lexsort((b, a))
        s = c.group_starts(a[order], b[order])
        least = (np.minimum.reduceat(ids[order], s).astype(np.uint64) - below).astype(np.int64)
        low = np.empty(len(ids), np.int64)
        low[order] = np.repeat(least, np.diff(np.append(s, len(ids))))
        at = block.at[hit[low < ids]]
        np.add.at(gone, at, 1)
        np.add.at(gone, at + WINDOW, -1)
    kept = np.cumsum(gone[:-1]) == 0
    words, out, removed, texts_out, x = np.array(block.words, object), [], [], [], 0
    for n in block.counts.tolist():
        stay = kept[x : x + n]
        text = b" ".join(words[block.tokens[x : x + n][stay]].tolist()) if n else b""
        out.append(hashlib.sha256(text).hexdigest())
        removed.append(n - int(stay.sum()))
        texts_out.append(text.decode() if texts else None)
        x += n
    cols = {"doc_id": block.doc_id, "n_words": pa.array(block.counts), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(out, pa.string())}
    return pa.table(cols | ({"kept_text": pa.array(texts_out, pa.string())} if texts else {}))


# ---- the index ---------------------------------------------------------------------------------


class Index:
    """Blocks and runs of the batches so far, in a folder that driver and executors share.

    `blocks/<batch>` and `runs/<batch>` are written once. A compacted run stands for the batches up to its number; the
    runs that it holds are removed after it is whole. `buckets` is chosen when the index is made, for the size that it is
    to reach (BUCKET_BYTES of text each), and is a folder's name, so it can't change unseen."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        made = self._listed(f"{self.path}/buckets")
        self.buckets = int(made[0]) if made else buckets
        if not made:
            p, fs = c.file_system(spark, f"{self.path}/buckets/{buckets}")
            fs.mkdirs(p)

    def _listed(self, path: str) -> list[str]:
        p, fs = c.file_system(self.spark, path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def _whole(self, kind: str) -> list[int]:
        """Numbers of the tables of a kind that were written to their end."""
        names = [x for x in self._listed(f"{self.path}/{kind}") if x.isdigit()]
        return sorted(int(x) for x in names if "_SUCCESS" in self._listed(f"{self.path}/{kind}/{x}"))

    def runs(self) -> list[int]:
        """Numbers of the runs that count: the last compacted one and those after it."""
        packed = self._whole("compacted")
        return [n for n in self._whole("runs") if not packed or n > packed[-1]]

    def _read(self, kind: str, numbers: list[int], schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/{n}" for n in numbers]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, kind: str, number: int) -> None:
        with c.cleaned_shuffles(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{kind}/{number}")

    def _all_runs(self) -> DataFrame:
        return self._read("compacted", self._whole("compacted")[-1:], RUN).unionByName(self._read("runs", self.runs(), RUN))

    def _in_order(self, stored: DataFrame, number: int) -> None:
        """Note the batch's greatest id, a folder's name; raise if its least one is smaller than that of a batch before."""
        ids = stored.select(F.explode("ids").alias("i")).select(F.coalesce("i", F.lit(NO_ID)).alias("i")).agg(F.min("i").alias("low"), F.max("i").alias("high")).first()
        known = [int(self._listed(f"{self.path}/ids/{n}")[-1]) for n in self._listed(f"{self.path}/ids") if int(n) < number]
        if ids["low"] is None:
            return
        if known and ids["low"] < max(known):
            c.delete(self.spark, f"{self.path}/blocks/{number}")
            raise ValueError(f"doc_id {ids['low']} comes after {max(known)}: results so far would be stale; add it to a new index")
        c.delete(self.spark, f"{self.path}/ids/{number}")
        p, fs = c.file_system(self.spark, f"{self.path}/ids/{number}/{ids['high']}")
        fs.mkdirs(p)

    def add(self, docs: DataFrame, texts: bool = False) -> DataFrame:
        """The batch's documents without the words that windows of smaller doc_ids cover, in this batch or in those before;
        `texts` adds the kept text. Run again after a failure, it overwrites what it had begun."""
        spark, buckets, before = self.spark, self.buckets, sorted({*self._whole("runs"), *self._whole("compacted")})
        number = before[-1] + 1 if before else 0
        name = f"{number}-{uuid.uuid4().hex[:8]}"
        scratch = c.Scratch(spark, "substring")
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self._write(docs.mapInArrow(lambda batches: store_blocks(batches, buckets, name), BLOCKS), "blocks", number)
        old_runs, history = self._all_runs(), self._read("blocks", [n for n in self._whole("blocks") if n < number], BLOCKS)
        stored = self._read("blocks", [number], BLOCKS)
        self._in_order(stored, number)
        entries = stored.select("blk", F.inline("entries"))
        run = scratch.put(entries.groupBy("bucket").applyInArrow(lambda k, t: merge_runs(k, t), RUN), "run")

        # one bucket's entries, its run and the older runs meet in one task
        both = (
            run.select(F.lit(None).cast("string").alias("blk"), "*")
            .withColumn("old", F.lit(False))
            .unionByName(old_runs.select(F.lit(None).cast("string").alias("blk"), "*").withColumn("old", F.lit(True)))
        )

        def probe(key, x, y):
            if not x.num_rows:
                return arrow([], ANSWER)
            return probe_runs(key, x, y.filter(pc.invert(y.column("old"))), y.filter(y.column("old")))

        shared = scratch.put(
            entries.select("blk", "bucket", "keys").groupBy("bucket").cogroup(both.select("bucket", "keys", "several", "old").groupBy("bucket")).applyInArrow(lambda k, x, y: probe(k, x, y), ANSWER),
            "shared",
        )
        own = shared.filter("kind = 'shared'")
        blocks = lambda df: df.drop("entries").groupBy("blk")
        windows = blocks(stored).cogroup(own.groupBy("blk")).applyInArrow(lambda k, t, g: emit_windows(k, t, g, True, buckets), WINDOWS)
        if before:
            hits = shared.filter("kind = 'hit'")
            again = (
                history.select("blk", F.inline("entries"))
                .select("blk", "bucket", "keys")
                .groupBy("bucket")
                .cogroup(hits.groupBy("bucket"))
                .applyInArrow(lambda k, x, y: probe_old(k, x, y), ANSWER)
            )
            again = scratch.put(again, "again")
            windows = windows.unionByName(
                blocks(history).cogroup(again.groupBy("blk")).applyInArrow(lambda k, t, g: emit_windows(k, t, g, False, buckets), WINDOWS)
            )
        below = scratch.put(windows.groupBy("bucket").applyInArrow(lambda k, t: verify(k, t), ANSWER), "below")
        self._write(run, "runs", number)  # last, so a batch that failed before is as if it hadn't come
        scratch.drop("run", "again")
        if len(self.runs()) > MAX_RUNS:
            self.compact()
        schema = RESULT + ", kept_text string" * texts
        return blocks(stored).cogroup(own.unionByName(below).groupBy("blk")).applyInArrow(lambda k, t, g: clean(t, g, texts), schema)

    def compact(self) -> None:
        """All runs as one, which replaces them once it is whole."""
        mine, packed = self.runs(), self._whole("compacted")
        if not mine:
            return
        self._write(self._all_runs().groupBy("bucket").applyInArrow(lambda k, t: merge_runs(k, t), RUN), "compacted", mine[-1])
        for kind, numbers in (("compacted", packed), ("runs", mine)):
            for n in numbers:
                c.delete(self.spark, f"{self.path}/{kind}/{n}")


def remove_repeats(spark: SparkSession, docs: DataFrame, batches: int = BATCHES, texts: bool = False) -> DataFrame:
    """Each document without the words that windows of smaller doc_ids cover, by an index of its own; `texts` adds the kept
    text. Documents are added in `batches` ranges of ids; the result doesn't depend on their number."""
    buckets = max(16, c.text_bytes(docs) // BUCKET_BYTES)
    index = Index(spark, c.Scratch(spark, "substring-index").root, buckets)
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], F.lit(1000))).first()[0] if batches > 1 else []
    parts, above = [], F.lit(True)
    for cut in sorted(set(cuts or [])):
        here = F.col("doc_id").cast("long") <= cut
        parts.append(index.add(docs.filter(above & here), texts))
        above = F.coalesce(~here, F.lit(True))  # null ids come last
    out = index.add(docs.filter(above), texts)
    for p in parts:
        out = out.unionByName(p)
    return out


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, c.table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, p, array_to_string(ws[p:p+12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w WHERE len(ws) >= 13)),
f AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g HAVING min(doc_id) <> max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM (SELECT g.doc_id, g.p FROM g JOIN f USING (g) WHERE f.low < g.doc_id)),
words AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS t
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
