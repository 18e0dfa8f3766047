import hashlib
import random
import re
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest

from terrace.llm import op12_periodic_runs as op12


def tokens(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def brute(words):
    """(start, length, period) of all runs, by comparing each word with the one a period on."""
    n, least = len(words), {}
    for p in range(1, n // 4 + 1):
        t = 0
        while t < n - p:
            if words[t] != words[t + p]:
                t += 1
                continue
            s = t
            while t < n - p and words[t] == words[t + p]:
                t += 1
            if t + p - s >= max(6, 4 * p):
                least.setdefault((s, t + p), p)
    return sorted(((s, e - s, p) for (s, e), p in least.items()), key=lambda r: (r[0], r[2]))


def left(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_text(rng):
    out = []
    for _ in range(rng.randint(0, 5)):
        period = rng.choices("abc", k=rng.randint(1, 6))
        out += period * rng.randint(1, 7) + period[: rng.randint(0, 6)]
    return " ".join(out)


@pytest.mark.parametrize("base", [op12.BASE, 1])
def test_runs_of_small_texts(base):
    """Also with a base for which stretches of the same words in another order have one hash: verification mends it."""
    rng = random.Random(7)
    for _ in range(150):
        texts = [some_text(rng) for _ in range(rng.randint(1, 6))]
        n, runs, kept = op12.find(pa.array([*texts, None, ""]), base)
        for text, count, got, rest in zip(texts, n.tolist(), runs.to_pylist(), kept.to_pylist(), strict=False):
            want = brute(text.split())
            assert count == len(text.split())
            assert [(r["start"], r["length"], r["period"]) for r in got] == want
            assert rest == left(text.split(), want)
        assert kept.to_pylist()[-2:] == ["", ""]


def test_blocks_of_pairs(monkeypatch):
    text = pa.array(["x y " + "a b c " * 40 + "z", "q " * 300, "k"])
    whole = op12.find(text)
    monkeypatch.setattr(op12, "PAIRS", 50)
    assert [x.to_pylist() if hasattr(x, "to_pylist") else x.tolist() for x in op12.find(text)] == [x.to_pylist() if hasattr(x, "to_pylist") else x.tolist() for x in whole]


def test_very_long_text():
    n, runs, kept = op12.find(pa.array(["a " * 200_000 + " ".join(f"w{i}" for i in range(100_000))]))
    assert runs.to_pylist() == [[{"start": 0, "length": 200_000, "period": 1}]]
    assert len(kept[0].as_py().split()) == 100_001


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in op12.op12_periodic_runs(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    several = 0
    for d in docs:
        w, h = tokens(d.text), zlib.crc32(str(d.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs, r = brute(w), got[d.doc_id]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(left(w, runs).encode()).hexdigest()
        several += len(runs) > 0
    assert several > 5


def test_edge_cases(spark):
    schema = "doc_id long, text string, runs int, n_words string, start double"
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a a a a a a"), (4, "a b " * 9), (4, "a b " * 9), (5, "a\u00a0b a\u00a0b " * 3), (6, "a a a a a")]
    df = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], schema)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in op12.periodic_runs(df).collect()), key=repr)
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 6, [(0, 6, 1)], "a"), (4, 18, [(0, 18, 2)], "a b"), (4, 18, [(0, 18, 2)], "a b"), (5, 6, [(0, 6, 1)], "a\u00a0b"), (6, 5, [], "a a a a a")]
    assert got == sorted(want, key=repr)
    assert op12.periodic_runs(df.limit(0)).count() == 0
    assert [r.best for r in op12.periodic_runs(df.filter("doc_id = 2")).select(op12.strongest("runs").alias("best")).collect()] == [None]
    assert op12.planted(df).count() == len(rows)
