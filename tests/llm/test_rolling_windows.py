import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from terrace.llm import op13_rolling_windows as op13


def brute(rows, windows):
    """rows: (doc_id, source, at, text, lang)."""
    out = []
    for doc, source, at, _, _ in rows:
        for w in windows:
            seen = [r for r in rows if at is not None and r[2] is not None and r[1] == source and at - w <= r[2] < at]
            lengths = sorted(len(r[3]) for r in seen if r[3] is not None)
            m = len(lengths)
            rank = lambda x, y: lengths[-(-x * m // y) - 1] if m else None  # noqa: E731, B023
            out.append((doc, w, at, len(seen), sum(lengths), len({r[4] for r in seen} - {None}), rank(1, 2), rank(90, 100)))
    return sorted(out, key=repr)


def rolled(spark, rows, windows):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], "doc_id long, source string, at long, text string, lang string, slot int, bucket string, n int, window_s long").repartition(3)
    got = op13.rolling(spark, df, F.col("at"), windows)
    return sorted((tuple(r) for r in got.select("doc_id", "window_s", "event_s", "n_events", "sum_chars", "n_langs", "median_chars", "high_chars").collect()), key=repr)


def test_against_brute_force(spark):
    """A hot source and time, null sources, texts, languages and times, repeated rows, lengths of several buckets, negative times."""
    rng = random.Random(3)
    text = lambda: rng.choice([None, "", "é" * rng.randint(1, 40), "x" * rng.randint(30, 3000), "y" * 70_000])
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([rng.randint(-900, 900), 7, 500]), text(), rng.choice(["en", "de", "fr", None])) for i in range(250)]
    rows += rows[:9] + [(None, "a", 5, "z", "en"), (900, "a", None, "zz", "en"), (901, "c", 0, "alone", "en")]
    for windows in ((60, 300), (1, 5000)):
        assert rolled(spark, rows, windows) == brute(rows, windows)


def test_empty_table(spark):
    assert rolled(spark, [(1, "a", 1, "x", "en")], (5, 9)) == brute([(1, "a", 1, "x", "en")], (5, 9))
    df = spark.createDataFrame([], "doc_id long, source string, at long, text string, lang string")
    assert op13.rolling(spark, df, F.col("at")).count() == 0


def test_coarse_buckets_keep_order(spark):
    n = [*range(5000), *(2**k + d for k in range(13, 62) for d in (-1, 0, 1))]
    df = spark.createDataFrame([(x,) for x in n], "x long").select("x", op13.coarse(F.col("x")).alias("b"))
    got = sorted((r.x, r.b) for r in df.collect())
    buckets = [b for _, b in got]
    assert buckets == sorted(buckets)
    assert buckets[:32] == list(range(32))
    assert max(buckets) < 1000


def test_checkpoints(monkeypatch):
    """Stretches within a block, over many, empty ones, and few numbers at a time."""
    rng = np.random.default_rng(5)
    for cells in (1 << 22, 300):
        monkeypatch.setattr(op13, "CELLS", cells)
        symbol, weight = rng.integers(0, 8, 900), rng.integers(1, 4, 900)
        a = rng.integers(0, 900, 200)
        b = np.minimum(a + rng.integers(0, 400, 200), 900)
        points = op13.Checkpoints(symbol, weight, 7)
        want = np.stack([np.bincount(symbol[x:y], weight[x:y], 8)[:7] for x, y in zip(a, b, strict=True)])
        got = np.zeros_like(want)
        for x, y, h in points.histograms(a, b):
            got[x:y] = h
        assert np.array_equal(got, want)
        rank = np.maximum(want.sum(axis=1).astype(int) // 2, 0)
        ((s, rest),) = op13.ranked(points, a, b, [rank])
        for h, r, x, left in zip(want, rank, s, rest, strict=True):
            if r:
                values = np.repeat(np.arange(7), h.astype(int))
                assert values[r - 1] == x
                assert left == r - (values < x).sum()


def test_whole_groups():
    rows = sorted((k, i % 4) for k in "abcdefg" for i in range(len(k) * 5))
    t = pa.table({"source": [r[0] if r[0] != "a" else None for r in rows], "slot": [r[1] for r in rows]})
    for limit in (1, 7, 1000):
        parts = list(op13.whole_groups(iter(t.to_batches(max_chunksize=3)), ["source", "slot"], limit))
        assert pa.concat_tables(p for p, _ in parts).to_pylist() == t.to_pylist()
        keys = [{(r["source"], r["slot"]) for r in p.to_pylist()} for p, _ in parts]
        assert sum(map(len, keys)) == len(set().union(*keys)) == 28
        assert all(len(set(g.tolist())) == len(k) for (_, g), k in zip(parts, keys, strict=True))
