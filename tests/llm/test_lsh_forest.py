import collections
import random
import re

import numpy as np
import pytest

from terrace.llm import op11_lsh_forest as op11


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing the sets of all texts that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    having = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            having[g].append(i)
    both = collections.Counter((a, b) for own in having.values() for j, b in enumerate(own) for a in own[:j])
    for (a, b), k in both.items():
        if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
            up[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, b"x", 3) for r in rows], "doc_id long, text string, set int, row int, levels binary, n int").repartition(3)
    got = op11.linked(spark, df)
    return sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_whole_tables_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = op11.op11_lsh_forest(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute([tuple(d) for d in docs])
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_regions(spark):
    """A large group of near copies, and many texts that share a passage but aren't similar: both fill large regions."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(60):  # chains: each differs from the last a little, the ends by much
        w = list(base)
        for k in range(i):
            w[(k * 5) % 300] = f"c{k}"
        rows.append((i, " ".join(w)))
    passage = [f"p{i}" for i in range(100)]
    rows += [(100 + i, " ".join([*passage, *(f"q{i}x{k}" for k in range(rng.choice([8, 30, 60])))])) for i in range(60)]
    rows += [(200 + i, " ".join([*passage, "end", *(f"r{i}x{k}" for k in range(3))])) for i in range(20)]
    rng.shuffle(rows)
    want = brute(rows)
    assert found(spark, rows) == want
    assert len({x[2] for x in want}) < 80


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}x{i % 89}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (6, "one two three"), (None, "one two"), (None, None), (7, long), (8, long + " end"), (9, "É é ß a b c"), (10, "é é ß a b c")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(None, "a b"), (None, "A b")]) == [(None, 1, None)] * 2
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op11.linked(spark, df).count() == 0


@pytest.mark.parametrize("similarity", [0.5, 0.85, 0.95])
def test_equal_levels_tell_the_similarity(similarity):
    rng = np.random.default_rng(1)
    total = 2000
    shared = int(total * similarity)
    h = rng.integers(0, 1 << 63, total, dtype=np.uint64)
    a, b = h[: shared + (total - shared) // 2], np.concatenate([h[:shared], h[shared + (total - shared) // 2 :]])
    x = op11.levels(np.concatenate([a, b]), np.array([len(a), len(b)]))
    assert abs((x[0] == x[1]).mean() - similarity) < 0.13
    assert op11.prefixes(x[:1].reshape(-1, op11.DEPTH), x[:1].reshape(-1, op11.DEPTH)).tolist() == [op11.DEPTH] * op11.TREES
