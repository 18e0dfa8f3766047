"""Sharding by a k-d tree over document metadata.

A node that stands for k shards is split along its widest dimension at the weighted median that leaves k // 2 shards'
worth of bytes below; a node of one shard is a leaf, with target bytes near total / shards. Dimensions are ranks: rows
are sorted along each metadata column once, ties by id and content, so every row has its own place, hot values can
be split, and widths compare across columns. Medians are found by histograms of ranks, some thousand bins a round,
over all nodes of a level at once; a round sends one row a node to the driver.

Native: DataFrame operations only. Rows carry no text: size and CRC-32 are taken in the scan.

Widths are measured in ranks, as source and language have no distance; at the root all dimensions are equally wide, and
the first is cut.

Nulls sort first along any dimension; a null text has no bytes. Very long texts count with all their bytes; a shard that
holds one may be larger than its share by that text. Ties along a dimension are told apart by id and content, and
repeated rows by their place; all are kept. Columns that aren't dimensions are ignored by `shard` and kept by `sharded`.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

SHARDS, OVERHEAD, BINS, CHUNK = 40, 16, 4096, 4096
DIMENSIONS = ("source", "lang", "n_chars")


def with_rank(scratch: c.Scratch, rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Adds each row's place, from 0, in the order of `by`. The sort is a range exchange; places add up partition counts."""
    ordered = scratch.put(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id()), f"sorted_{name}")
    part, place = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(part.alias("_p")).agg(F.count("*").alias("n"))  # a row a partition
    offsets = counts.select("_p", F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    return ordered.withColumn("_p", part).join(offsets, "_p").withColumn(name, F.col("_o") + place).drop("_m", "_p", "_o")


class Node:
    def __init__(self, shards: int, first: int):
        self.shards, self.first = shards, first
        self.dim = self.at = self.low = self.high = None

    def leaves(self) -> list[Node]:
        return [self] if self.dim is None else self.low.leaves() + self.high.leaves()

    def expr(self, value) -> Column:
        """`value(leaf)` of the leaf that a row is in, by its ranks."""
        if self.dim is None:
            return F.lit(value(self))
        return F.when(F.col(self.dim) < self.at, self.low.expr(value)).otherwise(self.high.expr(value))


def split(ranks: DataFrame, root: Node, nodes: list[Node], dims: list[str]) -> None:
    """Give each of the nodes its dimension, cut and children."""
    which = {n.first: n for n in nodes}
    node = root.expr(lambda n: n.first)
    rows = ranks.withColumn("node", node).filter(F.col("node").isin(list(which)))
    facts = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *[f(d).alias(f"{k}_{d}") for d in dims for k, f in (("lo", F.min), ("hi", F.max))]).collect()
    state = {}
    for r in facts:
        n = which[r["node"]]
        dim = max(dims, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"], -dims.index(d)))
        state[n.first] = {"dim": dim, "lo": r[f"lo_{dim}"], "span": r[f"hi_{dim}"] - r[f"lo_{dim}"] + 1, "before": 0, "goal": r["bytes"] * (n.shards // 2) / n.shards}
    found: dict[int, int] = {}
    while state:
        table = lambda f: F.element_at(F.create_map(*[F.lit(x) for k, s in state.items() for x in (k, f(s))]), F.col("node"))  # noqa: B023, E731
        place = F.coalesce(*[F.when(F.col("node").isin([k for k, s in state.items() if s["dim"] == d]), F.col(d)) for d in dims])
        width = {k: -(-s["span"] // BINS) for k, s in state.items()}
        binned = rows.filter(F.col("node").isin(list(state))).withColumn("off", place - table(lambda s: s["lo"]).cast("long"))
        binned = (
            binned.filter((F.col("off") >= 0) & (F.col("off") < table(lambda s: s["span"]).cast("long")))
            .withColumn("bin", F.floor(F.col("off") / F.element_at(F.create_map(*[F.lit(x) for p in width.items() for x in p]), F.col("node"))))
        )
        run = (
            binned.groupBy("node", "bin")
            .agg(F.sum("size").alias("b"))
            .withColumn("upto", F.sum("b").over(Window.partitionBy("node").orderBy("bin")) + table(lambda s: s["before"]).cast("long"))
        )
        hit = run.filter(F.col("upto") >= table(lambda s: float(s["goal"]))).groupBy("node").agg(F.min(F.struct("bin", "b", "upto")).alias("h")).collect()  # a row a node
        for r in hit:
            s, h, w = state[r["node"]], r["h"], width[r["node"]]
            s |= {"lo": s["lo"] + h["bin"] * w, "span": w, "before": h["upto"] - h["b"]}
            if w == 1:  # one row: the cut goes to the nearer side of it
                found[r["node"]] = s["lo"] + (1 if 2 * s["goal"] >= h["upto"] + s["before"] else 0)
        gone = set(state) - {r["node"] for r in hit}
        state_dims = {k: s["dim"] for k, s in state.items()}
        for k in [k for k in state if k in found or k in gone]:
            n = which[k]
            n.dim, n.at = state_dims[k], found.get(k, state[k]["lo"])
            del state[k]
    for n in nodes:
        if n.dim is None:  # no rows came this way
            n.dim, n.at = dims[0], 0
        half = n.shards // 2
        n.low, n.high = Node(half, n.first), Node(n.shards - half, n.first + half)


def shard(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, dimensions=DIMENSIONS, key: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the ranks; with a key, a column that tells rows apart, that too as _key."""
    scratch, dims = c.Scratch(spark, "kd"), [f"rank_{d}" for d in dimensions]
    text = F.coalesce("text", F.lit(""))
    more = [F.col(key).alias("_key")] if key else []
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        c.utf8_crc32(text).alias("text_crc32"), *[F.col(d).alias(f"_d{i}") for i, d in enumerate(dimensions)], *more,
    )
    more = ["_key"] if key else []
    rows = scratch.put(rows, "narrow")  # the sorts sample their input first; texts are read once
    for i, name in enumerate(dims):
        rows = with_rank(scratch, rows, [f"_d{i}", "doc_id", "text_crc32", "size", *more], name)
    rows = scratch.put(rows.select("doc_id", "size", "text_crc32", *dims, *more), "ranks")
    scratch.drop("narrow", *[f"sorted_{d}" for d in dims])
    root = Node(shards, 0)
    while wide := [n for n in root.leaves() if n.shards > 1]:
        split(rows, root, wide, dims)
    # slots count rows by chunks of the first rank, so no task numbers a whole shard
    placed = rows.withColumn("shard", root.expr(lambda n: n.first).cast("int")).withColumn("_c", F.floor(F.col(dims[0]) / CHUNK))
    before = (
        placed.groupBy("shard", "_c")
        .agg(F.count("*").alias("n"))
        .select(
            "shard", "_c",
            F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"),
        )
    )
    slot = F.col("_b") + F.row_number().over(Window.partitionBy("shard", "_c").orderBy(dims[0])) - 1
    return (
        placed.join(before, ["shard", "_c"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), *dims, *more,
        )
    )


def sharded(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, dimensions=DIMENSIONS) -> DataFrame:
    """All rows with all their columns, and shard and slot, whose names get underscores where docs has such columns.

    Rows get a number as they are stored; the tree works on numbers and metadata, and texts are moved once, to meet
    their shard."""
    scratch, names = c.Scratch(spark, "sharded"), {x.lower() for x in docs.columns}

    def free(name: str) -> str:
        while name in names:
            name += "_"
        return name

    mark, key = free("_number"), free("_key")
    stored = scratch.put(docs.withColumn(mark, F.monotonically_increasing_id()), "rows")
    placed = shard(spark, stored, shards, dimensions, mark)
    placed = scratch.put(placed.select(F.col("_key").alias(key), F.col("shard").alias(free("shard")), F.col("slot").alias(free("slot"))), "placed")
    return stored.join(placed.hint("merge"), stored[mark] == placed[key]).drop(mark, key)


def write_shards(rows: DataFrame, path: str) -> None:
    """Write `sharded` rows as Parquet, a folder for each shard, in the order of slots."""
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark, c.table(spark, sf_dir, "documents"))
