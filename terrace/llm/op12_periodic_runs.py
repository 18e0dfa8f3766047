"""Runs of words that repeat with a period, over a harmonic grid.

A run is a longest stretch of words that stays the same when moved by its smallest period q, and that is at least
LEAST words and TIMES periods long. For each period p up to a quarter of the text, every 3p-th word is a grid point;
a run has 3p words or more that equal the word one period on, so it holds a grid point. There are n/3 * ln(n/4) pairs
of a grid point and the word a period on, at most; those of equal words are extended to both sides, all at once, by a
binary search over prefix hashes. The stretches found are then verified word by word. A stretch that fails, as two
texts had one hash, is replaced by a scan of its text and period, so results don't depend on hashes. Of stretches with
the same ends the smallest period stays.

A row's text is worked on alone: nothing is shuffled, and a task holds a few megabytes of text, or one longer text with
its pairs in blocks of PAIRS.

Null and empty texts have no words and no runs; their collapsed text is empty. Very long texts are read whole. A null
doc_id and repeated rows come out as they went in. Ties: runs come by start, then period. Other columns are ignored,
whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

#: Least length of a run in words and in periods.
LEAST, TIMES = 6, 4
#: Pairs that are extended at once.
PAIRS = 1 << 19
BASE = 0x9E3779B97F4A7C15
RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of so many items: each item's group, and its number in it."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - (np.cumsum(counts) - counts)[group]


class Prefixes:
    """Hashes of all stretches of a sequence of numbers."""

    def __init__(self, ids: np.ndarray, base: int = BASE):
        self.power = np.ones(len(ids) + 1, np.uint64)
        np.multiply.accumulate(np.full(len(ids), base | 1, np.uint64), out=self.power[1:])
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(c.mixed(ids.astype(np.uint64) + np.uint64(1)) * self.power[:-1], out=self.sums[1:])

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the stretches of this length from i and from j (i <= j) the same, by their hashes?"""
        return (self.sums[i + length] - self.sums[i]) * self.power[j - i] == self.sums[j + length] - self.sums[j]

    def forward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from i on are those from j on, at most so many; for all pairs at once."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.equal(i, j, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def backward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before i are those before j."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.equal(i - mid, j - mid, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def long_enough(length: np.ndarray, period: np.ndarray) -> np.ndarray:
    return length >= np.maximum(LEAST, TIMES * period)


def stretches(ids: np.ndarray, counts: np.ndarray, base: int = BASE) -> np.ndarray:
    """Rows (start, end, period) of what the grid finds in the texts of these word numbers, each once."""
    hashes, end = Prefixes(ids, base), np.cumsum(counts)
    begin = end - counts
    text, p = spread(np.where(counts >= LEAST, counts // TIMES, 0))
    p = p + 1
    points = -(-(counts[text] - p) // ((TIMES - 1) * p))
    block = (np.cumsum(points) - points) // PAIRS
    found = []
    at = c.group_starts(block).tolist()
    for x, y in zip(at, [*at[1:], len(block)][: len(at)], strict=True):
        of, k = spread(points[x:y])
        q, t = p[x:y][of], text[x:y][of]
        i = begin[t] + (TIMES - 1) * q * k
        hit = ids[i] == ids[i + q]
        i, q, t = i[hit], q[hit], t[hit]
        first = i - hashes.backward(i, i + q, i - begin[t])
        last = i + q + hashes.forward(i, i + q, end[t] - i - q)
        ok = long_enough(last - first, q)
        found.append(np.unique(np.stack([first[ok], last[ok], q[ok]], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def scanned(ids: np.ndarray, begin: int, end: int, p: int) -> np.ndarray:
    """Rows (start, end, period) of one text and period, by comparing all its words."""
    same = np.concatenate([[False], ids[begin : end - p] == ids[begin + p : end], [False]])
    edge = np.flatnonzero(same[1:] != same[:-1])
    first, last = begin + edge[::2], begin + edge[1::2] + p
    ok = long_enough(last - first, np.int64(p))
    return np.stack([first[ok], last[ok], np.full(ok.sum(), p)], 1)


def runs_of(ids: np.ndarray, counts: np.ndarray, base: int = BASE) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period; places count over all texts."""
    pool, begin, good = stretches(ids, counts, base), np.cumsum(counts) - counts, []
    while len(pool):
        # sorted by start, end and period: the smallest period of each stretch; if that holds, its multiples say nothing new
        least = c.group_starts(pool[:, 0], pool[:, 1])
        found = pool[least]
        row, k = spread(found[:, 1] - found[:, 2] - found[:, 0])
        at = found[row, 0] + k
        wrong = np.bincount(row, ids[at] != ids[at + found[row, 2]], minlength=len(found)) > 0
        good.append(found[~wrong])
        again = np.stack([np.searchsorted(begin + counts, found[wrong, 0], "right"), found[wrong, 2]], 1)
        good += [scanned(ids, int(begin[t]), int(begin[t] + counts[t]), int(p)) for t, p in np.unique(again, axis=0).tolist()]
        pool = np.delete(pool, least, axis=0)[np.delete(np.repeat(wrong, np.diff([*least.tolist(), len(pool)])), least)]
    if not good:
        return np.zeros((0, 3), np.int64)
    found = np.unique(np.concatenate(good), axis=0)
    found = found[c.group_starts(found[:, 0], found[:, 1])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def listed(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def find(texts: pa.Array, base: int = BASE) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Words, runs and collapsed text of each text."""
    flat, counts = c.words(texts)
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs, begin = runs_of(ids, counts, base), np.cumsum(counts) - counts
    home = np.searchsorted(begin + counts, runs[:, 0], "right")
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 1], -1)
    keep = np.cumsum(cover[:-1]) == 0
    owner = np.repeat(np.arange(len(counts)), counts)
    texts = pc.binary_join(listed(np.bincount(owner[keep], minlength=len(counts)), flat.filter(pa.array(keep))), " ")
    parts = [pa.array(x) for x in (runs[:, 0] - begin[home], runs[:, 1] - runs[:, 0], runs[:, 2])]
    return counts, listed(np.bincount(home, minlength=len(counts)), pa.StructArray.from_arrays(parts, ["start", "length", "period"])), texts


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start, then period) and collapsed, the text without the
    words that a run has after its first period."""

    def run(batches):
        for batch in batches:
            for part in c.slices(batch):
                n, runs, left = find(c.column(part, "text"))
                yield pa.RecordBatch.from_arrays([c.column(part, "doc_id"), pa.array(n), runs, left], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, RESULT)


def strongest(runs: Column) -> Column:
    """The run with the greatest length in periods, compared exactly; the first of equals. Null without runs."""
    better = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda a, r: F.when(better(a, r), r).otherwise(a))


def planted(docs: DataFrame) -> DataFrame:
    """documents in which every tenth text by the hash of its id repeats a stretch of its words from some word on."""
    h = c.utf8_crc32(F.col("doc_id").cast("string"))
    g = ((h - h % 10) / 10).cast("long")

    def again(w: Column) -> Column:
        n = F.nullif(F.size(w), F.lit(0)).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, at(i).cast("int"))), " ")

    words = F.array(F.filter(F.split("text", c.SPACE), lambda w: w != ""))
    made = F.transform(words, again)[0]  # the words are bound by the outer lambda, so they are split once
    return docs.withColumn("text", F.when(h % 10 == 0, F.coalesce(made, "text")).otherwise(F.col("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(planted(c.table(spark, sf_dir, "documents").select("doc_id", "text")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    best = out.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
