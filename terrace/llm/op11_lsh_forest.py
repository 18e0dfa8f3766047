"""MinHash near-dedup over an LSH forest.

A text's set has its distinct shingles of five words; texts of equal sets are one node. A node has TREES labels, each of
DEPTH levels; a level is the least value of the set under an order of its own, cut to 16 bits. Each tree is a sorted order of
the labels, in which nodes that share a longer prefix lie closer together. A region is what shares a prefix of FIRST levels:
of pairs of similarity 0.85, 7 in a million share none.

Depth follows density. A region of up to SMALL nodes is compared at that depth, each node with all its neighbours. In a
larger one a node first meets the neighbour with the longest common prefix, in the tree where that is longest and in most
trees, and the least node of its region; so a large group of near copies costs two comparisons a node. Regions
that then still lie in several components are cut at DEEPER levels in as many more orders as keep pairs of 0.85
(6 in 100,000 share none): there, nodes meet the least of their region, and what is still apart is compared all with all, in
blocks of bounded size, as a product of matrices. No depth, region or node has a cap on its partners.

Candidates are sifted by size and by the share of equal levels of their labels, five standard deviations below the
similarity, and then confirmed on their full sets. Links are joined to components.

Nodes are known by a 64-bit hash of their set, as are shingles. Null and empty texts, and those without words, have an empty
set and are linked with nothing. A text of fewer words is one shingle. Very long texts are read whole. A null doc_id
is returned, but names a component only if its members have no other. Repeated rows come out as often as they went in. Ties: the least
doc_id. Other columns are ignored, whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .op9_simhash import compared, components, fine_keys, gram_hashes, shingle_sets, similar

WORDS, SIMILARITY, SEED = 5, 0.85, 1729
TREES, DEPTH, FIRST, SMALL = 16, 8, 4, 6
#: Orders and levels for regions that are still open.
DEEPER_TREES, DEEPER = 64, 12


def levels(h: np.ndarray, per: np.ndarray) -> np.ndarray:
    """For each text with shingles, TREES x DEPTH levels of 16 bits."""
    has = per[per > 0]
    start = np.cumsum(has) - has
    factors = np.random.default_rng(SEED).integers(1 << 62, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
    out = np.zeros((len(has), TREES * DEPTH), np.uint16)
    if len(has):
        for k, f in enumerate(factors):
            out[:, k] = c.mixed(np.minimum.reduceat(h * f, start)).astype(np.uint16)
    return out


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, row, and for the text's set of shingles: set, a hash that names it; n, its size; levels, its labels side by side."""

    def run(batches):
        for batch in batches:
            for part in c.slices(batch):
                h, per = gram_hashes(*c.words(c.column(part, "text"), lower=True), words)
                cut = np.cumsum(per)
                sets = [np.unique(h[x:y]) for x, y in zip((cut - per).tolist(), cut.tolist(), strict=True)]
                named = np.fromiter((xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets), np.uint64, len(sets))
                own = np.full(len(per), None, object)
                own[per > 0] = [x.tobytes() for x in levels(h, per)]
                cols = [c.column(part, "doc_id"), c.column(part, "row"), pa.array(named.view(np.int64)), pa.array([len(x) for x in sets], pa.int64()), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "set", "n", "levels"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    return rows.mapInArrow(run, "doc_id long, row long, set long, n long, levels binary")


def prefixes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Equal levels at the head of each pair of rows."""
    return np.logical_and.accumulate(before == after, axis=1).sum(axis=1)


def neighbours(members: DataFrame) -> DataFrame:
    """(a, b, common): in each tree's order, each node b of a region with the one before it and the length of their common
    prefix. Orders are cut by range, also within a region; the pair at a cut is left to the region's least node."""

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.frombuffer(b"".join(c.column(batch, "label").to_pylist()), np.uint16).reshape(-1, DEPTH)
            node, tree = c.column(batch, "set").to_numpy(zero_copy_only=False), c.column(batch, "tree").to_numpy(zero_copy_only=False)
            head = (at[:1], node[:1], tree[:1]) if last is None else last
            before = [np.concatenate([x, y[:-1]]) for x, y in zip(head, (at, node, tree), strict=True)]
            same = prefixes(before[0], at)
            keep = (before[2] == tree) & (same >= FIRST) & (before[1] != node)
            last = (at[-1:], node[-1:], tree[-1:])
            yield pa.RecordBatch.from_arrays([pa.array(before[1][keep]), pa.array(node[keep]), pa.array(same[keep].astype(np.int32))], names=["a", "b", "common"])

    order = ["tree", "label", "set"]
    return members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long, common int")


def likely(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Each pair (a, b) of nodes once, if sizes and labels allow the similarity."""
    least = similarity - 5 * math.sqrt(similarity * (1 - similarity) / (TREES * DEPTH))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.column(batch, k).to_pylist()), np.uint16).reshape(-1, TREES * DEPTH) for k in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    known = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for key, label, size in (("a", "x", "nx"), ("b", "y", "ny")):
        known = known.join(nodes.select(F.col("set").alias(key), F.col("levels").alias(label), F.col("n").alias(size)), key)
    fits = F.least("nx", "ny") >= F.lit(similarity) * F.greatest("nx", "ny") - 1e-9
    return known.filter(fits).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def linked(spark: SparkSession, docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles and component_id of each row; component_id is the least doc_id reachable, its own included."""
    scratch = c.Scratch(spark, "forest")
    own = scratch.put(sketches(docs, words), "own")
    nodes = scratch.put(own.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("low"), F.min(F.struct("row", "n", "levels")).alias("s")).select("set", "low", "s.*"), "nodes")
    own = own.select("doc_id", "set", "n")

    def grouped(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        """The rows of regions that have several nodes, with the region's size and least node."""
        shared = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.min("set").alias("least")).filter("size > 1")
        return scratch.put(rows.join(shared, keys), name)

    def still_open(members: DataFrame, keys: list[str], edges: DataFrame, name: str) -> DataFrame:
        """Members of the regions that lie in several components of what the edges link."""
        labels = components(c.Scratch(spark, f"forest-{name}"), edges).withColumnRenamed("node", "set")
        named = scratch.put(members.join(labels, "set", "left").withColumn("own_label", F.coalesce("label", "set")), f"named-{name}")
        mixed = named.groupBy(*keys).agg(F.min("own_label").alias("lo"), F.max("own_label").alias("hi")).filter("lo < hi").select(*keys)
        return scratch.put(named.join(mixed, keys, "left_semi").select(*keys, "set"), f"open-{name}")

    def pair(a: str, b: str):
        return [F.col(a).alias("a"), F.col(b).alias("b")]

    # the forest: regions of FIRST levels
    labels = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("tree"), F.substring("levels", t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)).alias("label")))
    entries = nodes.select("set", F.inline(labels)).withColumn("prefix", F.substring("label", 1, 2 * FIRST))
    region = ["tree", "prefix"]
    members = grouped(entries, region, "members")
    small, large = members.filter(F.col("size") <= SMALL), members.filter(F.col("size") > SMALL)
    # within SMALL nodes, all are neighbours
    near = small.select(*region, *pair("set", "set")[:1]).join(small.select(*region, F.col("set").alias("b")), region).filter("a < b").select("a", "b")
    # in larger regions: the best neighbour, and the least node
    met = scratch.put(neighbours(large).groupBy("a", "b").agg(F.max("common").alias("common"), F.count(F.lit(1)).alias("trees")), "met")
    longest, often = F.max(F.struct("common", "trees", "a")), F.max(F.struct("trees", "common", "a"))
    best = met.groupBy("b").agg(longest.alias("p"), often.alias("q")).select("b", F.explode(F.array("p.a", "q.a")).alias("a")).select("a", "b")
    least = large.groupBy("set").agg(F.min("least").alias("least")).select(*pair("least", "set"))
    first = scratch.put(likely(near.unionByName(best).unionByName(least), nodes, similarity), "first")

    # the sets of all that may be compared: of candidates and of large regions
    asked = first.select(F.explode(F.array("a", "b")).alias("set")).unionByName(large.select("set")).distinct()
    one = scratch.put(nodes.join(asked, "set", "left_semi").select("row", "set"), "one")
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text").join(one.select("row").hint("merge"), "row", "left_semi")
    sets = scratch.put(shingle_sets(texts, words).dropDuplicates(["row"]).join(one, "row").select("set", "shingles"), "sets")
    edges = scratch.put(similar(first, sets, similarity), "edges1")

    # large regions that are still open: deeper, in more orders
    left = still_open(large.select(*region, "set"), region, edges, "first")
    deeper = grouped(fine_keys(sets.join(left.select("set").distinct(), "set", "left_semi"), DEEPER_TREES, DEEPER), ["key"], "deeper")
    second = scratch.put(likely(deeper.select(*pair("least", "set")), nodes, similarity).join(first, ["a", "b"], "left_anti"), "second")
    edges = scratch.put(edges.unionByName(similar(second, sets, similarity)), "edges2")
    left = still_open(deeper.select("key", "set"), ["key"], edges, "second")
    edges = scratch.put(edges.unionByName(compared(left, sets, similarity)), "edges3")

    labels = components(c.Scratch(spark, "forest-all"), edges).withColumnRenamed("node", "set")
    named = scratch.put(nodes.select("set", "low").join(labels, "set", "left").select("set", "low", F.coalesce("label", "set").alias("label")), "named")
    ids = scratch.put(named.join(named.groupBy("label").agg(F.min("low").alias("component_id")), "label").select("set", "component_id"), "ids")
    alone = own.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return own.filter("n > 0").join(ids, "set").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark, c.table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
