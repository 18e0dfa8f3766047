"""Similarity search over a vector table: exact, or by an index of cells.

Both compare blocks of vectors with blocks of query vectors, as a product of matrices in a task, which returns no more
than k rows a query; so neither a large cell nor many queries, nor one vector that very many rows share, meet in one task.

The index has each vector in the cell of its nearest centre. Centres are fitted by k-means on a bounded sample (SAMPLE rows)
and place every row, those that come later too. A query looks into the cells nearest to it; how many, is measured when the index
is built: the least number that finds TARGET of the k best rows of a sample of queries, against all rows. Vectors without structure
need many cells, clustered ones few. Scores are exact, as the vectors found are compared themselves.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Rows that centres are fitted on, queries that the number of cells to look into is measured with, and the share to be found.
SAMPLE, ASKED, TARGET = 20_000, 200, 0.95
#: Most centres, and rows and queries compared in one go.
CELLS, ROWS, QUERIES = 4096, 1 << 16, 1 << 10


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def index_rows(chunks: DataFrame, embed) -> DataFrame:
    """(chunk_id, embedding, text_hash), a vector for each chunk and what it was made from; `embed` is an expression over chunk_text."""
    return chunks.select("chunk_id", embed(F.col("chunk_text")).alias("embedding"), F.sha2("chunk_text", 256).alias("text_hash"))


def sync(index: DataFrame, chunks: DataFrame, embed) -> DataFrame:
    """The index after a triggered sync: vectors of unchanged chunks are kept, new and changed chunks are embedded, deleted ones go."""
    now = chunks.select("chunk_id", F.sha2("chunk_text", 256).alias("text_hash"), "chunk_text")
    old = index.select("chunk_id", "text_hash")
    kept = index.join(now.select("chunk_id", "text_hash"), ["chunk_id", "text_hash"], "left_semi")
    new = now.join(old, ["chunk_id", "text_hash"], "left_anti")
    return kept.select("chunk_id", "embedding", "text_hash").unionByName(index_rows(new, embed))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, of unit length; zero and null vectors as NaN."""
    width = max((len(x) for x in column if x.is_valid), default=0)
    flat = np.full((len(column), width), np.nan)
    valid = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    if len(valid):
        lengths = pc.list_value_length(column.filter(column.is_valid())).to_numpy(zero_copy_only=False)
        if (lengths != width).any():
            raise ValueError("vectors of several lengths")
        flat[valid] = column.filter(column.is_valid()).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(valid), width)
    with np.errstate(invalid="ignore", divide="ignore"):
        norm = np.sqrt((flat * flat).sum(axis=1))
        return flat / np.where(norm > 0, norm, np.nan)[:, None]


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, key and score of the k rows most similar to each query within its cells: vectors (cell, key, embedding), queries
    (cell, query_id, q)."""
    blocks = vectors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("blocks"))
    chunks = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("chunks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    sizes = blocks.join(chunks, "cell")
    left = vectors.join(sizes, "cell").withColumn("block", place("key", "blocks")).withColumn("chunk", each("chunks"))
    right = queries.join(sizes, "cell").withColumn("chunk", place("query_id", "chunks")).withColumn("block", each("blocks"))
    kinds = {n: df.schema[n].dataType.simpleString() for df, n in ((queries, "query_id"), (vectors, "key"))}

    def compare(_, rows: pa.Table, asks: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("key", "ascending")]))
        if not rows.num_rows or not asks.num_rows:
            return pa.table({"query_id": asks.column("query_id").slice(0, 0), "key": rows.column("key").slice(0, 0), "score": pa.array([], pa.float64())})
        x, found = _matrix(_column(rows, "embedding")), []
        q = _matrix(_column(asks, "q"))
        step = max(1, (1 << 22) // len(x))
        for at in range(0, len(q), step):
            score = q[at : at + step] @ x.T
            order = np.where(np.isnan(score), -np.inf, np.floor(score * 1e6 + 0.5))
            for i in range(len(order)):  # the k best, first by score, then by key
                least = np.partition(order[i], -k)[-k] if k < len(x) else -np.inf
                above, level = np.flatnonzero(order[i] > least), np.flatnonzero(order[i] == least)
                best = np.concatenate([above, level[: max(0, k - len(above))]])
                found.append((np.full(len(best), at + i), best, score[i][best]))
        who, which, score = (np.concatenate(v) for v in zip(*found, strict=True))
        return pa.table({"query_id": _column(asks, "query_id").take(pa.array(who)), "key": _column(rows, "key").take(pa.array(which)), "score": pa.array(score, from_pandas=True)})

    by = ["cell", "block", "chunk"]
    out = left.select(*by, "key", "embedding").groupBy(*by).cogroup(right.select(*by, "query_id", "q").groupBy(*by))
    scored = out.applyInArrow(compare, f"query_id {kinds['query_id']}, key {kinds['key']}, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), "key")
    return scored.withColumn("score", F.round("score", 6)).withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k).drop("_n")


def _asked(queries: DataFrame, key: str, embedding: str) -> DataFrame:
    """query_id and q, each query once."""
    return queries.groupBy(F.col(key).alias("query_id")).agg(F.first(embedding).alias("q"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For each query row, under its key as query_id, the k rows most similar to it with all their columns; ties by key."""
    cell = F.lit(0).alias("cell")
    found = _nearest(vectors.select(cell, F.col(key).alias("key"), F.col(embedding).alias("embedding")), _asked(queries, key, embedding).select(cell, "*"), k)
    return vectors.join(found.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key")).drop("_key").orderBy("query_id", F.col("score").desc_nulls_last(), key)


def _cells(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest cells of each vector, nearest first; cell 0 for what has no direction."""
    near = np.nan_to_num(x) @ centres.T if x.shape[1] == centres.shape[1] else np.zeros((len(x), len(centres)))
    return np.argsort(-near, axis=1, kind="stable")[:, :n]


def _with(df: DataFrame, *names: str) -> StructType:
    """The schema of df and these whole numbers."""
    return StructType([*df.schema.fields, *(StructField(n, IntegerType()) for n in names)])


def fit(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of unit vectors."""
    rng = np.random.default_rng(7)
    centres = x[np.sort(rng.choice(len(x), min(cells, len(x)), replace=False))]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centres = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centres)
    return centres


class Index:
    """Vectors by cell in a folder: rows/cell=N has key, embedding and what came with them; `index.json` the centres and how
    many cells a query looks into."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._finish()
        rows = spark.read.text(f"{self.path}/index.json", wholetext=True).collect()  # one file, bounded by CELLS
        meta = json.loads(rows[0]["value"])
        self.centres, self.probes, self.key = np.array(meta["centres"]), meta["probes"], meta["key"]

    @classmethod
    def build(cls, vectors: DataFrame, path: str, key: str = "vec_id", k: int = 5, cells: int | None = None) -> Index:
        """Write an index of all rows of vectors (key, embedding and more columns)."""
        spark = vectors.sparkSession
        n = vectors.count()
        some = vectors.filter("embedding IS NOT NULL").orderBy(F.xxhash64(key)).select("embedding").limit(SAMPLE).toArrow()
        x = _matrix(_column(some, "embedding"))
        x = x[~np.isnan(x).any(axis=1)]
        centres = fit(x, cells or min(CELLS, max(1, int(np.sqrt(n))))) if len(x) else np.zeros((1, 1))
        made = cls.__new__(cls)
        made.spark, made.path, made.centres, made.key, made.probes = spark, path.rstrip("/"), centres, key, len(centres)
        made._place(vectors).write.mode("overwrite").partitionBy("cell").parquet(f"{made.path}/rows")
        made.probes = made._measured(k)
        made._put("index.json", json.dumps({"centres": centres.tolist(), "probes": made.probes, "key": key}))
        return made

    def _place(self, vectors: DataFrame) -> DataFrame:
        """Rows with their cell, large cells in several files."""
        centres = self.centres

        def run(batches):
            for batch in batches:
                own = _cells(_matrix(batch.column("embedding")), centres, 1)[:, 0] if batch.num_rows else np.zeros(0, np.int64)
                yield batch.append_column("cell", pa.array(own.astype(np.int32)))

        return vectors.mapInArrow(run, _with(vectors, "cell")).hint("rebalance", "cell")

    def _probed(self, queries: DataFrame, n: int) -> DataFrame:
        """query_id, q, cell and rank: the n cells nearest to each query."""
        centres = self.centres

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    near = _cells(_matrix(batch.column("q")), centres, n)
                    at = pa.array(np.repeat(np.arange(len(near)), near.shape[1]))
                    cols = [batch.column("query_id").take(at), batch.column("q").take(at), pa.array(near.ravel().astype(np.int32)), pa.array(np.tile(np.arange(near.shape[1], dtype=np.int32), len(near)))]
                    yield pa.RecordBatch.from_arrays(cols, names=["query_id", "q", "cell", "rank"])

        return queries.mapInArrow(run, _with(queries.select("query_id", "q"), "cell", "rank"))

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def _measured(self, k: int) -> int:
        """The least number of cells in which TARGET of the k best rows of ASKED queries lie."""
        rows = self.rows()
        asked = _asked(rows.orderBy(F.xxhash64(F.lit(1), self.key)).limit(ASKED), self.key, "embedding")
        zero = F.lit(0).alias("cell")
        best = _nearest(rows.select(zero, F.col(self.key).alias("key"), "embedding"), asked.select(zero, "*"), k)
        home = best.join(rows.select(F.col(self.key).alias("key"), "cell"), "key")
        ranks = home.join(self._probed(asked, len(self.centres)).drop("q"), ["query_id", "cell"]).groupBy("rank").count().collect()  # a row a cell at most
        found = np.zeros(len(self.centres))
        for r in ranks:
            found[r["rank"]] = r["count"]
        return int(np.searchsorted(np.cumsum(found), TARGET * found.sum()) + 1) if found.sum() else 1

    def search(self, queries: DataFrame, k: int = 5, probes: int | None = None) -> DataFrame:
        """query_id, the index's key and score of about the k best rows of each query (key, embedding). Only files of cells that
        a query looks into are read."""
        asks = self._probed(_asked(queries, self.key, "embedding"), min(probes or self.probes, len(self.centres))).drop("rank")
        cells = [r["cell"] for r in asks.select("cell").distinct().collect()]  # CELLS at most
        rows = self.rows().filter(F.col("cell").isin(cells)).select("cell", F.col(self.key).alias("key"), "embedding")
        return _nearest(rows, asks, k).withColumnRenamed("key", self.key)

    def sync(self, changed: DataFrame, gone: DataFrame) -> None:
        """Take new and changed rows, and drop those whose keys are gone: only the cells that lose or get rows are written anew."""
        rows = self.rows()
        new, out = self._place(changed), changed.select(self.key).unionByName(gone.select(self.key)).distinct()
        touched = rows.join(out, self.key, "left_semi").select("cell").unionByName(new.select("cell")).distinct()
        cells = [r["cell"] for r in touched.collect()]  # CELLS at most
        if not cells:
            return
        kept = rows.filter(F.col("cell").isin(cells)).join(out, self.key, "left_anti")
        kept.unionByName(new).select(*rows.columns).write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/staged")
        self._put("staged/cells.json", json.dumps({c: self._there(f"staged/cell={c}") for c in cells}))
        self._finish()

    def _at(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _there(self, name: str) -> bool:
        p, fs = self._at(name)
        return fs.exists(p)

    def _put(self, name: str, text: str) -> None:
        p, fs = self._at(name)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _finish(self) -> None:
        """Put the cells of a sync in place. One that broke off on the way is finished by whoever opens the index next."""
        if not self._there("staged/cells.json"):
            return
        listed = self.spark.read.text(f"{self.path}/staged/cells.json", wholetext=True).collect()
        try:
            cells = json.loads(listed[0]["value"])
        except (ValueError, IndexError):  # broken off before it was whole: nothing is in place yet
            cells = {}
        for c, has_rows in cells.items():
            (new, fs), (old, _) = self._at(f"staged/cell={c}"), self._at(f"rows/cell={c}")
            if not has_rows or fs.exists(new):  # else it is in place already
                fs.delete(old, True)
            if has_rows and fs.exists(new):
                fs.rename(new, old)
        p, fs = self._at("staged")
        fs.delete(p, True)
        self.spark.catalog.refreshByPath(f"{self.path}/rows")
