"""SimHash near-dedup over vantage-point trees.

A document's 64-bit fingerprint has each bit that most hashes of its word shingles have. Distinct fingerprints are
split by a vantage-point tree: a node sends what lies within its radius of its vantage point inside, the rest outside.
The tree is fitted on a bounded sample of fingerprints (SAMPLE of them) and only routes rows: every fingerprint is
stored in one leaf, and each that the triangle bound leaves within reach of the other side of a boundary also
queries the leaves there, so all pairs within the limit are found whatever the sample. In a leaf, rows are compared
only where their distances to a local vantage point differ by no more than the limit, and a leaf returns, for each
row, one link to the least fingerprint that it is tied to: no pairs of a large group are listed. Links are then
joined to components by repeated least labels with pointer jumping.

With a similarity, links are texts whose sets of shingles have that Jaccard similarity. Their fingerprints differ by
some 10 of 64 bits, and a vantage-point tree can't prune at that radius: distances of unlike texts all lie near 32, so
each query would visit each leaf. The tree then finds the close candidates, and the far ones come from bands of least
hashes of the same shingles; all are verified on the sets. Members of a group of candidates are first compared with its
least member, so a large group of copies costs a comparison each. Sets whose group still lies in several components get
finer bands, which tell 0.8 from 0.6, and are compared in the same way; groups that then still lie in several components
are compared all with all, as a product of matrices, and return a link a member. Large groups are dealt out in blocks.

Nulls and texts without words have fingerprint zero and are linked like any other. A null doc_id is returned, but
never names a component unless its members have no other. Very long texts are read whole. Repeated rows come out as
often as they went in, but for `near_dedup`, which keeps one. Other columns are ignored, or kept by `near_dedup` whatever
their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

SHINGLE, LIMIT, SEED = 3, 2, 42
#: Bound of the sample that the tree is fitted on, and rows aimed at in a leaf.
SAMPLE, LEAF = 1 << 15, 1 << 11
#: Bands and their rows, for all texts and for those that are left: of pairs of similarity 0.8, 7 in a million share none
#: of 30 bands of 5, and 2 in ten thousand none of 300 bands of 16, of which pairs of 0.6 share a twelfth of one.
BANDS, ROWS, FINE_BANDS, FINE_ROWS = 30, 5, 300, 16
#: Members of a group that are compared all with all in one task are at most two blocks of about so many.
BLOCK = 1024


# ---- fingerprints ------------------------------------------------------------------------------


def shingle_hashes(flat: pa.Array, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each text's shingles, and how many each text has."""
    joined = flat.cast(pa.binary()).to_pylist()
    text = memoryview(b" ".join(joined))
    length = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]]) if len(length) else length
    end = start + length
    first = np.cumsum(counts) - counts
    per = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    own = np.repeat(np.arange(len(counts)), per)
    at = first[own] + np.arange(len(own)) - (np.cumsum(per) - per)[own]
    last = np.minimum(at + size, (first + counts)[own]) - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[x:y], SEED) for x, y in zip(start[at].tolist(), end[last].tolist(), strict=True)), np.uint64, len(at)), per


def majority(h: np.ndarray, per: np.ndarray) -> np.ndarray:
    """Per text, the bits that over half of its hashes have. Eight byte lanes are summed at a time, in runs of at most 255."""
    has = per > 0
    n = per[has]
    if not len(n):
        return np.zeros(len(per), np.uint64)
    runs = -(-n // 255)
    first = np.cumsum(n) - n
    own = np.repeat(np.arange(len(n)), runs)
    lane_at = first[own] + 255 * (np.arange(len(own)) - (np.cumsum(runs) - runs)[own])
    out = np.zeros((len(n), 8), np.uint8)
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & np.uint64(0x0101010101010101), lane_at)
        total = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), np.cumsum(runs) - runs, axis=0)
        out |= ((2 * total > n[:, None]).astype(np.uint8) << np.uint8(bit)).astype(np.uint8)
    result = np.zeros(len(per), np.uint64)
    result[has] = out.view(np.uint64).ravel()
    return result


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, row (a hash of id and text) and fp, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for part in c.slices(batch):
                flat, counts = c.words(c.column(part, "text"), lower=True)
                fp = majority(*shingle_hashes(flat, counts, size))
                yield pa.RecordBatch.from_arrays([c.column(part, "doc_id"), c.column(part, "row"), pa.array(fp.view(np.int64))], names=["doc_id", "row", "fp"])

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
        .mapInArrow(run, "doc_id long, row long, fp long")
    )


# ---- vantage-point tree ------------------------------------------------------------------------


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def fit(sample: np.ndarray, leaves: int) -> list[tuple]:
    """Nodes (vantage, radius, inside, outside); a child below zero is leaf -child-1."""
    nodes: list[tuple] = []
    count = 0

    def grow(part: np.ndarray, want: int) -> int:
        nonlocal count
        if want > 1 and len(part) > 2:
            # of a few candidates, the vantage point whose boundary has the fewest rows near it
            best = None
            for v in part[:: max(1, len(part) // 8)][:8]:
                d = distance(part, v)
                r = int(np.partition(d, (len(d) - 1) // 2)[(len(d) - 1) // 2])
                for radius in (r - 1, r):
                    n_in = int((d <= radius).sum())
                    if 0 < n_in < len(part):
                        near = int(((d > radius - LIMIT) & (d <= radius + LIMIT)).sum()) + abs(2 * n_in - len(part))
                        if best is None or near < best[0]:
                            best = (near, v, radius, d <= radius)
            if best:
                at = len(nodes)
                nodes.append(())
                _, v, radius, inner = best
                share = min(want - 1, max(1, round(want * inner.mean())))
                nodes[at] = (int(v), radius, grow(part[inner], share), grow(part[~inner], want - share))
                return at
        count += 1
        return -count

    grow(sample, leaves)
    return nodes


def route(fp: np.ndarray, nodes: list[tuple], limit: int, stored: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, home): the leaf that stores each fingerprint and those that it queries; those that aren't `stored` only query.

    Of a pair on both sides of a boundary the inner one goes across, so it is met once."""
    out: list[tuple] = []

    def go(node: int, rows: np.ndarray, home: np.ndarray) -> None:
        if not len(rows):
            return
        if node < 0 or not nodes:
            out.append((rows, np.full(len(rows), max(0, -node - 1)), home))
            return
        v, radius, inside, outside = nodes[node]
        d = distance(fp[rows], np.uint64(v))
        inner = d <= radius
        # stored rows: home side; of them the inner ones near the boundary also query outside. Queries go where they may reach.
        to_in = (home & inner) | (~home & (d <= radius + limit))
        to_out = (home & ~inner) | (~home & (d > radius - limit)) | (home & inner & (d > radius - limit))
        go(inside, rows[to_in], home[to_in])
        go(outside, rows[to_out], home[to_out] & ~inner[to_out])

    go(0, np.arange(len(fp)), np.ones(len(fp), bool) if stored is None else stored)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 3


def tree_links(fp: np.ndarray, home: np.ndarray, limit: int, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a leaf of any size: a large one is split by a tree of its own, so comparisons don't grow with its square."""
    if len(fp) <= 4 * leaf or not home.any():
        return leaf_links(fp, home, limit)
    own = fp[home]
    nodes = fit(own[:: max(1, len(own) // SAMPLE)], len(own) // leaf)
    if not nodes:
        return leaf_links(fp, home, limit)
    rows, to, stored = route(fp, nodes, limit, home)
    order = np.argsort(to, kind="stable")
    rows, to, stored = rows[order], to[order], stored[order]
    cut = np.append(c.group_starts(to), len(to))
    found = [leaf_links(fp[rows[x:y]], stored[x:y].astype(bool), limit) for x, y in zip(cut[:-1], cut[1:], strict=True)]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def leaf_links(fp: np.ndarray, home: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, least fp tied to it in this leaf). Queries are compared with stored rows, stored ones also with each other."""
    if len(fp) < 2:
        return fp[:0], fp[:0]
    d = distance(fp, fp[np.flatnonzero(home)[0]] if home.any() else fp[0])
    order = np.argsort(d, kind="stable")
    fp, home, d = fp[order], home[order], d[order]
    stored = np.flatnonzero(home)
    lo, hi = np.searchsorted(d[stored], d - limit), np.searchsorted(d[stored], d + limit, "right")
    pairs_a, pairs_b = [], []
    root = np.arange(len(fp))
    step = 256
    for x in range(0, len(fp), step):
        y = min(len(fp), x + step)
        s = stored[lo[x] : hi[y - 1]]
        for z in range(0, len(s), 1 << 14):
            near = np.argwhere(distance(fp[x:y, None], fp[None, s[z : z + (1 << 14)]]) <= limit)
            a, b = near[:, 0] + x, s[z + near[:, 1]]
            other = a != b
            pairs_a.append(a[other]), pairs_b.append(b[other])
        if sum(map(len, pairs_a)) > 1 << 20 or y == len(fp):
            root = joined(root, np.concatenate(pairs_a) if pairs_a else root[:0], np.concatenate(pairs_b) if pairs_b else root[:0])
            pairs_a, pairs_b = [], []
    least = np.full(len(fp), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, root, fp)
    least = least[root]
    tied = least != fp
    return fp[tied], least[tied]


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after more pairs: least labels with pointer jumping, in memory."""
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, root[root]):
            root = root[root]
    return root


def links(spark: SparkSession, distinct: DataFrame, limit: int = LIMIT, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) that join all fingerprints within the limit; `distinct` has one column fp."""
    n = distinct.count()
    leaves = max(1, min(n // leaf, sample // 8))
    picked = [r.fp for r in distinct.orderBy(F.xxhash64("fp")).limit(sample).collect()] if leaves > 1 else []
    nodes = fit(np.array(picked, np.int64).view(np.uint64), leaves)  # bounded by `sample`

    def send(batches):
        for batch in batches:
            fp = c.column(batch, "fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for x in range(0, len(fp), 4096):
                rows, to, home = route(fp[x : x + 4096].view(np.uint64), nodes, limit)
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(fp[x : x + 4096][rows]), pa.array(home.astype(bool))], names=["leaf", "fp", "home"])

    def compare(key, t):
        fp, home = c.column(t, "fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), c.column(t, "home").to_numpy(zero_copy_only=False).astype(bool)
        a, b = tree_links(fp, home, limit, leaf)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct.mapInArrow(send, "leaf int, fp long, home boolean").groupBy("leaf").applyInArrow(compare, "a long, b long")


# ---- components --------------------------------------------------------------------------------


def components(scratch: c.Scratch, edges: DataFrame) -> DataFrame:
    """(node, label): the least node reachable, for nodes with edges. Edges are contracted to their labels each round."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    labels = scratch.put(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels0")
    left, step = edges, 0
    while True:
        step += 1
        # pointer jumping: a node takes its label's label, so chains halve
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels2 = scratch.put(
            labels.join(up, "label").select("node", F.col("top").alias("label"), (F.col("top") != F.col("label")).alias("moved")),
            f"jumped{step}",
        )
        if labels2.filter("moved").limit(1).count():
            scratch.drop(f"labels{step - 1}")
            labels = labels2.select("node", "label")
            scratch_name = f"jumped{step}"
        else:
            labels, scratch_name = labels2.select("node", "label"), f"jumped{step}"
            la, lb = labels.select(F.col("node").alias("a"), F.col("label").alias("x")), labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
            left = scratch.put(
                left.join(la, "a").join(lb, "b").filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(),
                f"left{step}",
            )
            if not left.limit(1).count():
                return labels
            # roots take the least root that an edge ties them to; nodes follow by jumping
            down = left.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), "low")
            labels = labels.join(down, "node", "left").select("node", F.coalesce("low", "label").alias("label"))
        labels = scratch.put(labels, f"labels{step}")
        scratch.drop(scratch_name)


def cluster(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """doc_id, row, fp (signed long), component (a fingerprint), component_id (least doc_id linked to, the document's own included)."""
    scratch = c.Scratch(spark, "simhash")
    own = scratch.put(fingerprints(docs, size), "fingerprints")
    nodes = scratch.put(own.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    edges = scratch.put(links(spark, nodes.select("fp"), limit).distinct(), "links")
    labels = components(scratch, edges)
    named = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("low").alias("component_id"))
    ids = scratch.put(named.join(least, "label").select("fp", F.col("label").alias("component"), "component_id"), "components")
    return own.join(ids, "fp").select("doc_id", "row", "fp", "component", "component_id")


# ---- near duplicates by similarity ---------------------------------------------------------------


def gram_hashes(flat: pa.Array, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles made of its words' hashes, and how many each text has; shorter texts are one shingle."""
    (h,) = c.word_hashes(flat)
    first = np.cumsum(counts) - counts
    per = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    own = np.repeat(np.arange(len(counts)), per)
    at = first[own] + np.arange(len(own)) - (np.cumsum(per) - per)[own]
    length, out = np.minimum(counts, size)[own], np.zeros(len(own), np.uint64)
    for k in np.unique(length).tolist():
        of = length == k
        out[of] = c.grams(h, k)[at[of]]
    return out, per


def band_keys(h: np.ndarray, per: np.ndarray, bands: int, rows: int, seed: int = SEED) -> np.ndarray:
    """Per text with shingles, a key for each band of least values under `rows` orders of the shingles."""
    has = per[per > 0]
    start = np.cumsum(has) - has
    constants = np.random.default_rng(seed).integers(1 << 62, 1 << 63, (bands, rows), dtype=np.uint64) | np.uint64(1)
    keys = np.zeros((len(has), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(has), b, np.uint64)
        for a in constants[b]:
            key = key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h * a, start) if len(has) else key
        keys[:, b] = c.mixed(key)
    return keys


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row, and for the text's set of shingles: set, a hash that names it; n, its size; fp, the text's fingerprint; keys, its bands."""

    def run(batches):
        for batch in batches:
            for part in c.slices(batch):
                flat, counts = c.words(c.column(part, "text"), lower=True)
                h, per = gram_hashes(flat, counts, words)
                cut = np.cumsum(per)
                sets = [np.unique(h[x:y]) for x, y in zip((cut - per).tolist(), cut.tolist(), strict=True)]
                named = np.fromiter((xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets), np.uint64, len(sets))
                keys = band_keys(h, per, bands, rows)
                offsets = np.concatenate([[0], np.cumsum((per > 0) * bands)]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64)))
                cols = [
                    c.column(part, "doc_id"), c.column(part, "row"), pa.array(named.view(np.int64)),
                    pa.array([len(x) for x in sets], pa.int32()), pa.array(majority(h, per).view(np.int64)), listed,
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "set", "n", "fp", "keys"])

    rows_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    return rows_of.mapInArrow(run, "doc_id long, row long, set long, n int, fp long, keys array<bigint>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """row and the sorted hashes of the text's distinct shingles, packed."""

    def run(batches):
        for batch in batches:
            for part in c.slices(batch):
                h, per = gram_hashes(*c.words(c.column(part, "text"), lower=True), words)
                cut = np.cumsum(per)
                sets = [c.pack_sorted(np.unique(h[x:y])) for x, y in zip((cut - per).tolist(), cut.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([c.column(part, "row"), pa.array(sets, pa.binary())], names=["row", "shingles"])

    return docs.mapInArrow(run, "row long, shingles binary")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) of sets whose Jaccard similarity is at least that."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = c.unpack_sorted(x), c.unpack_sorted(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([c.column(batch, "a"), c.column(batch, "b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def fine_keys(sets: DataFrame, bands: int, rows: int) -> DataFrame:
    """(set, key) of each band of a packed set."""

    def run(batches):
        for batch in batches:
            for x in range(0, batch.num_rows, 64):
                part = batch.slice(x, 64)
                hashes = [c.unpack_sorted(v) for v in part.column("shingles").to_pylist()]
                per = np.array([len(h) for h in hashes])
                keys = band_keys(np.concatenate(hashes), per, bands, rows, SEED + 1)
                named = np.repeat(c.column(part, "set").to_numpy()[per > 0], bands)
                yield pa.RecordBatch.from_arrays([pa.array(named), pa.array(keys.ravel().view(np.int64))], names=["set", "key"])

    return sets.mapInArrow(run, "set long, key long")


def group_links(sets: pa.Array, shingles: list[bytes], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (set, least set tied to it) of a group's sets: those with the similarity, all with all."""
    ids = sets.to_numpy(zero_copy_only=False)
    hashes = [c.unpack_sorted(x) for x in shingles]
    n = np.array([len(x) for x in hashes])
    own = np.repeat(np.arange(len(n)), n)
    _, at, often = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    shared = often > 1  # a shingle of one set is in no intersection
    column = np.cumsum(shared) - 1
    use = shared[at]
    row, at = own[use], column[at[use]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    both = np.zeros((len(n), len(n)), np.float32)
    for x in range(0, int(shared.sum()), 2048):
        lo, hi = np.searchsorted(at, (x, x + 2048))
        part = np.zeros((len(n), 2048), np.float32)
        part[row[lo:hi], at[lo:hi] - x] = 1
        both += part @ part.T
    a, b = np.nonzero(np.triu(both >= similarity * (n[:, None] + n[None, :] - both) - 1e-6, 1))
    root = joined(np.arange(len(n)), a, b)
    least = np.full(len(n), np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    tied = least[root] != ids
    return ids[tied], least[root][tied]


def compared(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join what is similar in each group of (key, set)."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    here = members.join(sizes, "key").withColumn("_b", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("_b", j).alias("i"), F.greatest("_b", j).alias("j")))
    dealt = here.select("key", "set", F.inline(pair)).join(sets, "set")

    def run(key, t):
        if t.num_rows < 2:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        a, b = group_links(c.column(t, "set"), t.column("shingles").to_pylist(), similarity)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("key", "i", "j").applyInArrow(run, "a long, b long").distinct()


def verified_cluster(spark: SparkSession, docs: DataFrame, words: int, similarity: float, limit: int = LIMIT) -> DataFrame:
    """doc_id, row, component (a set of shingles), component_id: linked are texts whose sets of shingles of so many words
    have that Jaccard similarity. See the head of the module for how candidates are found."""
    scratch = c.Scratch(spark, "near-pairs")
    own = scratch.put(sketches(docs, words, BANDS, ROWS), "own")
    nodes = scratch.put(own.groupBy("set").agg(F.min(F.struct("n", "fp", "row", "keys")).alias("s")).select("set", "s.*"), "nodes")
    own = own.select("doc_id", "row", "set")
    size = nodes.select("set", "n")

    def grouped(keys: DataFrame, name: str) -> DataFrame:
        """(key, set, least) of keys that several sets have."""
        shared = keys.groupBy("key").agg(F.min("set").alias("least"), F.max("set").alias("_most")).filter("least < _most").select("key", "least")
        return scratch.put(keys.join(shared, "key"), name)

    def of_size(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs of sets, each once. Sets whose sizes differ by more than the similarity allows can't have it."""
        known = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        known = known.join(size.withColumnsRenamed({"set": "a", "n": "an"}), "a").join(size.withColumnsRenamed({"set": "b", "n": "bn"}), "b")
        return scratch.put(known.filter(F.least("an", "bn") >= F.lit(similarity) * F.greatest("an", "bn") - 1e-9).select("a", "b"), name)

    def labelled(members: DataFrame, edges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Members with the components that edges make, of those groups that lie in several; and all labels."""
        labels = components(c.Scratch(spark, f"near-{name}"), edges).withColumnRenamed("node", "set")
        named = scratch.put(members.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set")), f"named-{name}")
        mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
        return scratch.put(named.join(mixed, "key", "left_semi"), f"open-{name}"), labels

    # candidates: equal fingerprints, those that the tree links, and equal bands
    members = grouped(nodes.select("set", F.explode(F.array_append("keys", F.col("fp"))).alias("key")), "members")
    one_of = nodes.groupBy("fp").agg(F.min("set").alias("s"))
    tree = links(spark, one_of.select("fp"), limit).distinct()
    for x in ("a", "b"):
        tree = tree.join(one_of.withColumnsRenamed({"fp": x, "s": f"s{x}"}), x)
    first = of_size(
        members.select(F.col("least").alias("a"), F.col("set").alias("b")).unionByName(tree.select(F.col("sa").alias("a"), F.col("sb").alias("b"))),
        "first",
    )
    asked = members.select("set").unionByName(first.select(F.explode(F.array("a", "b")).alias("set"))).distinct()
    one = scratch.put(nodes.join(asked, "set", "left_semi").select("row", "set"), "one")
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text").join(one.select("row").hint("merge"), "row", "left_semi")
    sets = scratch.put(shingle_sets(texts, words).dropDuplicates(["row"]).join(one, "row").select("set", "shingles"), "sets")
    edges = scratch.put(similar(first, sets, similarity), "edges1")

    # what is left of groups, by finer bands: with the least member, then in pairs of different components
    left, _ = labelled(members, edges, "first")
    fine = grouped(fine_keys(sets.join(left.select("set").distinct(), "set", "left_semi"), FINE_BANDS, FINE_ROWS), "fine")
    second = of_size(fine.select(F.col("least").alias("a"), F.col("set").alias("b")), "second").join(first, ["a", "b"], "left_anti")
    edges = scratch.put(edges.unionByName(similar(scratch.put(second, "new"), sets, similarity)), "edges2")
    left, _ = labelled(fine, edges, "second")
    edges = scratch.put(edges.unionByName(compared(left.select("key", "set"), sets, similarity)), "edges3")
    labels = components(c.Scratch(spark, "near-all"), edges).withColumnRenamed("node", "set")
    known = scratch.put(own.join(labels, "set", "left").select("doc_id", "row", F.coalesce("label", "set").alias("component")), "known")
    least = scratch.put(known.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    return known.join(least, "component").select("doc_id", "row", "component", "component_id")


def near_dedup(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, limit: int = LIMIT, similarity: float | None = None) -> DataFrame:
    """One row of each component, that of its least doc_id, nulls last; columns as they were. With a similarity, links are
    texts whose shingles of `size` words have that Jaccard similarity; without, fingerprints within the limit.

    Rows are known by doc_id and a hash of id and text. The rows that go are listed, as they are far fewer than those
    that stay; the list grows with the corpus, so texts are moved once to meet it, at any size. Rows that repeat with id
    and text are the only ones that are grouped."""
    scratch, lost = c.Scratch(spark, "near-dedup"), -(2**63)
    found = verified_cluster(spark, docs, size, similarity, limit) if similarity else cluster(spark, docs, size, limit)
    rows = scratch.put(found.groupBy("component", "component_id", "doc_id", "row").agg(F.count("*").alias("n")), "rows")
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    named = rows.filter(least)
    # several texts may share their component's least id
    tied = named.groupBy("component").agg(F.min("row").alias("low"), F.max("row").alias("high")).filter("low < high").select("component", "low")
    mark = "_row"
    while any(x.lower().startswith(mark) for x in docs.columns):
        mark += "_"
    key = [mark, f"{mark}id"]
    keyed = lambda df: df.select(F.col("row").alias(key[0]), F.coalesce("doc_id", F.lit(lost)).alias(key[1]))
    gone = keyed(rows.filter(~least)).unionByName(keyed(named.join(tied, "component").filter("row > low")))
    gone = scratch.put(gone, "gone")
    kept = (
        docs.withColumns({key[0]: F.xxhash64("doc_id", "text"), key[1]: F.coalesce(docs["doc_id"].cast("long"), F.lit(lost))})
        .join(gone.hint("merge"), key, "left_anti")
    )
    again = scratch.put(keyed(named.filter("n > 1")), "again")
    if again.limit(1).count():
        kept = kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates(key))
    return kept.select(*docs.columns)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cluster(spark, c.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
