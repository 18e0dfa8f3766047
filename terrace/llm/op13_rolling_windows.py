"""Features of the rows just before each row, by square-root decomposition.

A row has a source, a time, a length and a language. For each row and each window W, features are taken over all rows of
its source with a time from W seconds before its own up to, but without, its own. Rows of one source and time have one
window, so features are made for each source and time and joined back.

Time is cut into slots, SLOTS to the longest window. A row goes to its own slot and to those whose rows may still look
back at it, so a task has whole slots, each of one source, and never a whole source. Before that, rows are summed up by
time, language and coarse bucket of their length (STEPS buckets for each doubling), so however many rows a source has, a slot
has no more than a row for each time, language and bucket.

First pass, by (source, slot): the rows in order of time get a checkpoint after each block of about the square root of
their number, with cumulative histograms of coarse buckets and of languages. A window's histogram is the difference
of two checkpoints, patched with the rows at both edges that lie in no whole block. Its languages are the ones with a
row in it; a scan over its coarse buckets gives, for each rank, the bucket that holds it and the rank within. Second
pass, by (source, slot, bucket): the same with a fine histogram, in which each length of that bucket counts alone, and
a scan of it gives the length. A task holds slots with some GATHER rows, or one larger slot, and histograms of CELLS numbers.

Null source: one source. Null text: the row counts, but has no length. Null lang: the row counts, but is no language. A row
without a time is in no window, and its own windows are empty: no rows, no lengths, no ranks. Repeated rows count and come
out as often as they are there; rows of equal time don't see each other. Very long texts: lengths up to 2^62 work. Other
columns are ignored, whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

WINDOWS = (600, 43200)
#: Ranks, as numerator and denominator of a share of the lengths.
RANKS = {"median_chars": (1, 2), "high_chars": (90, 100)}
#: Coarse buckets for each doubling of the length; shorter lengths than twice that have buckets of their own.
STEPS = 16
#: More slots to a window are dealt out more evenly, but a row goes to one more slot than that.
SLOTS = 2
#: Rows that are gathered for one go, numbers that its histograms hold at once, and symbols of a histogram of languages.
GATHER, CELLS, SYMBOLS = 1 << 16, 1 << 22, 1 << 10


def coarse(length: Column) -> Column:
    """The bucket of a length: buckets are in order, and as wide as a STEPS-th of the power of two below them."""
    bits = F.length(F.bin(length)) - 1
    shift = bits - int(math.log2(STEPS))
    wide = F.lit(2 * STEPS) + (shift - 1) * STEPS + (F.call_function("shiftright", length, shift) - STEPS)
    return F.when(length < 2 * STEPS, length).otherwise(wide).cast("int")


# ---- inside a task -----------------------------------------------------------------------------


def whole_groups(batches, keys: list[str], limit: int):
    """Tables of about so many rows with whole groups of rows, which come sorted by their keys; and each row's group."""
    held: list[pa.RecordBatch] = []
    wanted = limit

    def numbered(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        for k in keys:
            code = pc.fill_null(c.column(t, k).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
        return np.cumsum(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= wanted:
            t = pa.Table.from_batches(held)
            group = numbered(t)
            last = int(np.searchsorted(group, group[-1]))
            held = t.slice(last).to_batches()
            wanted = max(limit, 2 * (t.num_rows - last))  # a large group isn't looked at again for each batch
            if last:
                yield t.slice(0, last), group[:last]
    if held:
        t = pa.Table.from_batches(held)
        yield t, numbered(t)


class Checkpoints:
    """Cumulative histograms of symbols 0 to n - 1 after each block of a sequence; symbol n is left out of them."""

    def __init__(self, symbol: np.ndarray, weight: np.ndarray, n: int):
        self.symbol, self.weight, self.n, rows = symbol, weight, n, len(symbol)
        self.block = max(16, math.isqrt(rows), -(-rows * (n + 1) // CELLS))
        blocks = rows // self.block + 1
        each = np.zeros((blocks + 1, n + 1), np.int64)
        np.add.at(each, (np.arange(rows) // self.block + 1, symbol), weight)
        self.total = np.cumsum(each, axis=0)

    def histograms(self, a: np.ndarray, b: np.ndarray):
        """(from, to, histograms) of the stretches from a up to b, some at a time."""
        step = max(1, CELLS // (self.n + 1 + 2 * self.block))
        for x in range(0, len(a), step):
            lo, hi = a[x : x + step], b[x : x + step]
            first, last = -(-lo // self.block), hi // self.block
            inside = first <= last
            out = np.where(inside[:, None], self.total[last] - self.total[np.minimum(first, last)], 0)
            # edges: before the first checkpoint and after the last, or all of a stretch without one
            for begin, end in ((lo, np.where(inside, first * self.block, hi)), (np.where(inside, last * self.block, hi), hi)):
                size = end - begin
                row = np.repeat(np.arange(len(lo)), size)
                at = begin[row] + np.arange(len(row)) - (np.cumsum(size) - size)[row]
                np.add.at(out, (row, self.symbol[at]), self.weight[at])
            yield x, x + len(lo), out[:, : self.n]


def ranked(points: Checkpoints, a: np.ndarray, b: np.ndarray, ranks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each list of ranks (0: none), the symbol that has the rank in each stretch, and the rank within the symbol."""
    out = [(np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)) for _ in ranks]
    for x, y, h in points.histograms(a, b):
        upto = np.cumsum(h, axis=1)
        for rank, (symbol, rest) in zip(ranks, out, strict=True):
            r = rank[x:y]
            s = (upto < r[:, None]).sum(axis=1)
            s = np.minimum(s, points.n - 1)
            symbol[x:y], rest[x:y] = s, r - (upto[np.arange(len(s)), s] - h[np.arange(len(s)), s])
    return out


def in_order(group: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """One number for group and time; a window that ends in a group doesn't reach back to the one before."""
    low, high = int(at.min()), int(at.max())
    return group.astype(np.int64) * (high - low + window + 1) + (at - low)


def first_pass(t: pa.Table, group: np.ndarray, windows: tuple[int, ...]) -> pa.Table:
    """Counts of each window, and for each rank its coarse bucket and the rank within."""
    num = lambda x: c.column(t, x).to_numpy(zero_copy_only=False).astype(np.int64)
    at, n = num("event_s"), num("n")
    bucket = pc.fill_null(c.column(t, "bucket"), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = c.column(t, "lang").dictionary_encode()
    lang, langs = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    key = in_order(group, at, max(windows))
    own = np.flatnonzero(c.column(t, "own").to_numpy(zero_copy_only=False))
    asked = own[c.group_starts(key[own])]
    sums = {k: np.concatenate([[0], np.cumsum(v)]) for k, v in (("n_events", n), ("m", n * (bucket >= 0)), ("sum_chars", pc.fill_null(c.column(t, "chars"), 0).to_numpy(zero_copy_only=False)))}
    most = int(bucket.max()) + 1 if len(bucket) else 0
    points = Checkpoints(np.where(bucket < 0, max(most, 1), bucket), n, max(most, 1))
    parts = []
    for w in windows:
        a, b = np.searchsorted(key, key[asked] - w), np.searchsorted(key, key[asked])
        out = {k: v[b] - v[a] for k, v in sums.items()}
        m = out.pop("m")
        ranks = [-(-x * m // y) for x, y in RANKS.values()]
        for name, rank, (s, rest) in zip(RANKS, ranks, ranked(points, a, b, ranks), strict=True):
            out[f"{name}_bucket"], out[f"{name}_rank"] = np.where(rank > 0, s, -1), rest
        kinds = np.zeros(len(asked), np.int64)
        for x in range(0, langs, SYMBOLS):
            mine = (lang >= x) & (lang < x + SYMBOLS)
            before = np.concatenate([[0], np.cumsum(mine)])
            for i, j, h in Checkpoints(lang[mine] - x, n[mine], min(SYMBOLS, langs - x)).histograms(before[a], before[b]):
                kinds[i:j] += (h > 0).sum(axis=1)
        cols = {k: c.column(t, k).take(pa.array(asked)) for k in ("source", "slot", "event_s")}
        parts.append(pa.table(cols | {"window_s": pa.array(np.full(len(asked), w))} | {k: pa.array(v) for k, v in (out | {"n_langs": kinds}).items()}))
    return pa.concat_tables(parts)


def second_pass(t: pa.Table, group: np.ndarray) -> pa.Table | None:
    """The length at each asked rank of a window, among the lengths of one bucket."""
    num = lambda x: pc.fill_null(c.column(t, x), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    window, rank, length, n = num("window_s"), num("rank"), num("length"), num("n")
    asked, have = np.flatnonzero(rank > 0), np.flatnonzero(rank == 0)
    if not len(asked):
        return None
    key = in_order(group, num("event_s"), int(window.max()))
    # each bucket's lengths, numbered from 0
    order = np.lexsort((length[have], group[have]))
    g, v = group[have][order], length[have][order]
    new = c.group_starts(g, v)
    number = np.zeros(len(have), np.int64)
    number[order] = np.repeat(np.arange(len(new)), np.diff([*new.tolist(), len(have)]))
    kind_group, kind_value = g[new], v[new]
    base = np.searchsorted(kind_group, np.arange(group[-1] + 1))
    symbol = number - base[group[have]]
    points = Checkpoints(symbol, n[have], int(symbol.max()) + 1)
    a, b = np.searchsorted(key[have], key[asked] - window[asked]), np.searchsorted(key[have], key[asked])
    ((s, _),) = ranked(points, a, b, [rank[asked]])
    take = pa.array(asked)
    cols = {k: c.column(t, k).take(take) for k in ("source", "event_s", "window_s", "name")}
    return pa.table(cols | {"value": pa.array(kind_value[base[group[asked]] + s])})


# ---- on the cluster ----------------------------------------------------------------------------


def features(spark: SparkSession, events: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """source, event_s and a struct w<W> of features for each window W, for each source and time of `events` (source,
    event_s, length, lang)."""
    scratch, long = c.Scratch(spark, "rolling"), max(windows)
    known = events.filter("event_s IS NOT NULL").withColumn("bucket", coarse(F.col("length")))
    slot = lambda at: F.floor(at / F.lit(long / SLOTS))

    def dealt(cells: DataFrame) -> DataFrame:
        """Each row in its own slot and in the next ones that may look back at it."""
        return cells.withColumn("slot", F.explode(F.sequence(slot(F.col("event_s")), slot(F.col("event_s") + long))))

    cells = known.groupBy("source", "event_s", "lang", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("chars"))
    cells = dealt(cells).withColumn("own", F.col("slot") == slot(F.col("event_s")))
    names = [f"{name}_{x}" for name in RANKS for x in ("bucket", "rank")]
    result = "source string, slot long, event_s long, window_s long, n_events long, sum_chars long, " + ", ".join(f"{x} long" for x in names) + ", n_langs long"

    def first(batches):
        for t, group in whole_groups(batches, ["source", "slot"], GATHER):
            yield from first_pass(t, group, windows).to_batches()

    by = ["source", "slot"]
    found = scratch.put(cells.repartition(*by).sortWithinPartitions(*by, "event_s").mapInArrow(first, result), "first")

    asked = found.select(*by, "event_s", "window_s", F.inline(F.array(*(F.struct(F.lit(x).alias("name"), F.col(f"{x}_bucket").cast("int").alias("bucket"), F.col(f"{x}_rank").alias("rank")) for x in RANKS))))
    fine = dealt(known.filter("bucket IS NOT NULL").groupBy("source", "event_s", "bucket", "length").agg(F.count(F.lit(1)).alias("n")))
    both = asked.filter("rank > 0").unionByName(fine, allowMissingColumns=True)

    def second(batches):
        for t, group in whole_groups(batches, ["source", "slot", "bucket"], GATHER):
            out = second_pass(t, group)
            if out:
                yield from out.to_batches()

    by = ["source", "slot", "bucket"]
    exact = both.repartition(*by).sortWithinPartitions(*by, "event_s").mapInArrow(second, "source string, event_s long, window_s long, name string, value long")
    plain = ["n_events", "sum_chars", "n_langs"]
    rows = found.select("source", "event_s", "window_s", *plain).unionByName(
        exact.select("source", "event_s", "window_s", *(F.when(F.col("name") == x, F.col("value")).alias(x) for x in RANKS)), allowMissingColumns=True
    )
    one = lambda w: F.struct(*(F.max(F.when(F.col("window_s") == w, F.col(x))).alias(x) for x in [*plain, *RANKS])).alias(f"w{w}")
    return rows.groupBy("source", "event_s").agg(*(one(w) for w in windows))


def rolling(spark: SparkSession, docs: DataFrame, at: Column, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """A row for each row of docs and each window: doc_id, window_s, event_s, n_events, sum_chars, n_langs and the ranks."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), at.cast("long").alias("event_s"), "source", "lang", F.length("text").cast("long").alias("length"))
    rows = c.Scratch(spark, "rolling-rows").put(cols, "rows")
    made = features(spark, rows, windows).withColumnsRenamed({"source": "_source", "event_s": "_at"})
    # the join deals rows by source and time; a time that very many rows share is split by Spark, as only one side repeats
    met = rows.select("doc_id", "source", "event_s").join(made.hint("merge"), F.col("source").eqNullSafe(F.col("_source")) & (F.col("event_s") == F.col("_at")), "left")
    none = lambda w, x: F.col(f"w{w}.{x}") if x in RANKS else F.coalesce(F.col(f"w{w}.{x}"), F.lit(0).cast("long"))
    each = [F.struct(F.lit(w).cast("long").alias("window_s"), *(none(w, x).alias(x) for x in ["n_events", "sum_chars", "n_langs", *RANKS])) for w in windows]
    return met.select("doc_id", "event_s", F.inline(F.array(*each)))


def event_time() -> Column:
    """60 * floor((doc_id + (h mod 10000)) / 6), h the CRC-32 of the id."""
    x = F.col("doc_id") + c.utf8_crc32(F.col("doc_id").cast("string")) % 10000
    return (x - F.pmod(x, F.lit(6))) * 10


def op13_rolling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling(spark, c.table(spark, sf_dir, "documents"), event_time())


#: CRC-32 by its table: 256 numbers of eight steps each, then a byte of the id at a time.
SQL = """WITH RECURSIVE steps(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL
    SELECT i, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) FROM steps WHERE k < 8),
bytes AS (SELECT i, v FROM steps WHERE k = 8),
ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
crc(doc_id, s, pos, h) AS (SELECT doc_id, s, 0, 4294967295 FROM ids UNION ALL
    SELECT c.doc_id, c.s, c.pos + 1, xor(c.h >> 8, b.v) FROM crc c JOIN bytes b ON b.i = xor(c.h & 255, ascii(substring(c.s, c.pos + 1, 1))) WHERE c.pos < length(c.s)),
hashed AS (SELECT doc_id, xor(h, 4294967295) AS h FROM crc WHERE pos = length(s)),
timed AS (SELECT d.doc_id, d.lang, d.source, length(d.text) AS len, CAST(60 * floor((d.doc_id + h.h % 10000) / 6) AS BIGINT) AS event_s FROM documents d LEFT JOIN hashed h USING (doc_id)),
rolled AS ({each})
SELECT doc_id, window_s, event_s, n_events, sum_chars, n_langs, lens[(len(lens) + 1) // 2] AS median_chars, lens[(90 * len(lens) + 99) // 100] AS high_chars
FROM (SELECT * EXCLUDE lens, list_sort(coalesce(lens, [])) AS lens FROM rolled)""".replace(
    "{each}",
    " UNION ALL ".join(
        f"SELECT doc_id, CAST({w} AS BIGINT) AS window_s, event_s, count(*) OVER w AS n_events, CAST(coalesce(sum(len) OVER w, 0) AS BIGINT) AS sum_chars, count(DISTINCT lang) OVER w AS n_langs, "
        f"list(len) FILTER (len IS NOT NULL) OVER w AS lens FROM timed WINDOW w AS (PARTITION BY source ORDER BY event_s RANGE BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        for w in WINDOWS
    ),
)
