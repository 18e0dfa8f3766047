"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. A document's certain whole copies are taken first: the whole part of target over
source size. The rest of the target is a sample without replacement of fixed size, counted in words: a document's
inclusion probability grows with the square root of its size, so that the expected words are the rest. Documents whose
probability comes to 1 are taken for certain, and the scale of the others is fitted to what is then left. All others
are ranked by random odds divided by inclusion odds; the random odds come from a hash of id and content. The sample is
the ranking's prefix that is nearest to the rest.

Native: DataFrame operations only. Certain documents are found from one row for each distinct size of a source. The cut
in the ranking is found by histograms over ranges of the ranking value, so no source is ever sorted or summed by one
task: each round keeps the one range that holds the cut, until few rows are left there. All sums are of whole numbers,
so reruns agree.

Nulls: a null text has size 0 and nothing of it is taken; a null source is a source of its own, the last. Very long
texts are read whole. Rows that repeat with id and text have one place in the ranking; where the cut falls among them,
as many of them are taken as the target needs. Other columns are ignored by `mix` and kept by `mixed`. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

WEIGHTS = (3, 1, 2)
#: Share of all words that is taken, and the most that a source or a document gives, in its own sizes.
SHARE, MOST = 1.5, 2
BINS, SMALL = 4096, 20_000


def measured(docs: DataFrame) -> DataFrame:
    """docs with five more columns: _source; _size; _imp, a whole inclusion weight; _u, random in (0, 1); _tie, a digest of id and content."""
    size = F.when(docs["text"].isNull(), F.lit(0)).otherwise(F.size(F.array_remove(F.split(docs["text"], c.SPACE), ""))).cast("long")
    tie = F.md5(F.concat_ws("|", F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.md5(F.encode(F.coalesce(docs["text"], F.lit("")), "UTF-8"))).cast("binary"))
    out = docs.select("*", docs["source"].cast("string").alias("_source"), size.alias("_size"), tie.alias("_tie"))
    u = (F.conv(F.substring("_tie", 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return out.withColumns({"_u": u, "_imp": F.floor(1024 * F.sqrt("_size")).cast("long")})


def ranked(rows: DataFrame, per: DataFrame) -> DataFrame:
    """Measured rows with their source's figures and _q, the ranking value: 0 for certain rows, else in (0, 1], small random odds over inclusion odds first."""
    out = rows.join(per, rows["_source"].eqNullSafe(per["source_"])).drop("source_")
    pi = F.greatest(F.col("scale") * F.col("_imp"), F.lit(1e-300))
    odds = (F.col("_u") / (1 - F.col("_u"))) / (pi / (1 - pi))
    return out.withColumn("_q", F.when(pi >= 1, F.lit(0.0)).otherwise(odds / (1 + odds)))


def fitted(sizes: DataFrame) -> DataFrame:
    """(s, scale): per source the factor by which _imp is an inclusion probability. `sizes` has a row for each distinct
    _imp of a source, with words, their words, wide, the sum of _imp times words, and rest.

    With the rows of the largest _imp certain, the others share what is left; the fewest are certain for which no
    other's probability reaches 1."""
    by = Window.partitionBy("source_").orderBy(F.col("_imp").desc())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("rest") - F.coalesce(F.sum("words").over(before), F.lit(0))
    fit = sizes.withColumn("scale", left / F.sum("wide").over(after).cast("double"))
    good = F.min(F.when(F.col("scale") * F.col("_imp") < 1, F.struct(-F.col("_imp"), "scale")))
    # where all are certain, any factor that gives each 1 will do
    return fit.groupBy(F.col("source_").alias("s")).agg(F.coalesce(good["scale"], F.lit(1.0)).alias("scale"))


def targets(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Adds target, a double, to (source, source_size, ...), one row a source.

    Weight is shared out until each target is at most MOST times its source's size: sources are filled in the order in
    which a rising common level reaches their bounds."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    s = sources.withColumn("weight", w.cast("long")).withColumn("bound", MOST * F.col("source_size")).withColumn("level", F.col("bound") / F.col("weight"))
    by = Window.orderBy("level", F.col("source").asc_nulls_last())
    everyone = Window.partitionBy(F.lit(1))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("full", F.coalesce(F.sum("bound").over(before), F.lit(0))).withColumn("spent", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("open", (F.lit(SHARE) * F.sum("source_size").over(everyone) - F.col("full")) / (F.sum("weight").over(everyone) - F.col("spent")))
    # the first source that the level doesn't fill sets the level for it and all after
    s = s.withColumn("place", F.row_number().over(by))
    rest = F.min(F.when(F.col("open") <= F.col("level"), F.struct("place", "open"))).over(everyone)["open"]
    return (
        s.withColumn(
            "target",
            F.when(F.col("level") < F.coalesce(rest, F.col("level") + 1), F.col("bound").cast("double")).otherwise(rest * F.col("weight")),
        )
        .drop("weight", "bound", "level", "full", "spent", "open", "place")
    )


def shares(rows: DataFrame, scratch: c.Scratch, weights=WEIGHTS) -> DataFrame:
    """One row a source: source_, source_size, target, certain copies, the rest, the scale of inclusion, where its sample
    ends (lo, last), and how many rows tie there (tied) and are taken (ties)."""
    sums = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    whole = F.least(F.floor(F.col("target") / F.greatest(F.lit(1), "source_size")), F.lit(MOST)).cast("long")
    per = (
        targets(sums, weights)
        .withColumn("certain", whole)
        .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
        .withColumnRenamed("source", "source_")
    )
    per = scratch.put(per, "shares")
    wide = F.sum(F.col("_imp").cast("decimal(38,0)") * F.col("_size"))
    sizes = rows.filter("_size > 0").groupBy("_source", "_imp").agg(F.sum("_size").alias("words"), wide.alias("wide"))
    sizes = sizes.join(per.select("source_", "rest"), sizes["_source"].eqNullSafe(per["source_"])).filter("rest > 0")
    scale = fitted(sizes)
    per = scratch.put(per.join(scale, per["source_"].eqNullSafe(scale["s"]), "left").drop("s"), "sources")
    sampled = scratch.put(
        ranked(rows.select("_source", "_size", "_imp", "_u", "_tie"), per).filter("_size > 0 and rest > 0").select("_source", "_size", "_tie", "rest", "_q"),
        "ranked",
    )

    # per source the range [lo, lo + width) of _q that holds the cut, the words before it, and the rows in it
    cut = scratch.put(
        sampled.groupBy("_source").agg(F.max("rest").alias("goal"), F.count("*").alias("rows")).select("*", F.lit(0.0).alias("lo"), F.lit(1.0).alias("width"), F.lit(0).cast("long").alias("before")),
        "cut0",
    )

    def within(cut: DataFrame) -> DataFrame:
        edges = cut.withColumnRenamed("_source", "source_")
        return sampled.join(edges, sampled["_source"].eqNullSafe(edges["source_"])).drop("source_")

    for step in range(1, 5):
        if not cut.filter(F.col("rows") > SMALL).limit(1).count():
            break
        binned = within(cut).withColumn("bin", F.floor((F.col("_q") - F.col("lo")) / F.col("width") * BINS)).filter(F.col("bin").between(0, BINS - 1))
        counts = binned.groupBy("_source", "lo", "width", "before", "goal", "bin").agg(F.sum("_size").alias("words"), F.count("*").alias("n"))
        run = counts.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("_source").orderBy("bin")))
        all_ = F.struct("bin", "lo", "width", "words", "upto", "n", "goal")
        at = run.groupBy("_source").agg(F.coalesce(F.min(F.when(F.col("upto") >= F.col("goal"), all_)), F.max(all_)).alias("c"))
        cut = scratch.put(
            at.select("_source", "c.goal", F.col("c.n").alias("rows"), (F.col("c.lo") + F.col("c.bin") * F.col("c.width") / BINS).alias("lo"), (F.col("c.width") / BINS).alias("width"), (F.col("c.upto") - F.col("c.words")).alias("before")),
            f"cut{step}",
        )
    near = within(cut).filter((F.col("_q") >= F.col("lo")) & (F.col("_q") < F.col("lo") + F.col("width")))
    alike = near.groupBy("_source", "goal", "before", "_q", "_tie").agg(F.max("_size").alias("size"), F.count("*").alias("n"))
    order = Window.partitionBy("_source").orderBy("_q", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    run = alike.withColumn("start", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(order), F.lit(0)))
    # the prefix nearest to the goal: a row is in if the middle of its words lies before the goal
    fit = F.least(F.col("n"), F.floor((F.col("goal") - F.col("start")) / F.col("size") + 0.5)).cast("long")
    at = F.max(F.struct("_q", "_tie", fit.alias("ties"), F.col("n").alias("tied")))
    last = run.filter(fit > 0).groupBy(F.col("_source").alias("s")).agg(at.alias("e")).select("s", F.struct("e._q", "e._tie").alias("last"), "e.ties", "e.tied")
    ends = cut.select(F.col("_source").alias("s"), "lo").unionByName(last, allowMissingColumns=True)
    ends = ends.groupBy("s").agg(*[F.max(x).alias(x) for x in ("lo", "last", "ties", "tied")])
    return scratch.put(per.join(ends, per["source_"].eqNullSafe(ends["s"]), "left").drop("s"), "ends")


def copies(rows: DataFrame, per: DataFrame, scratch: c.Scratch) -> DataFrame:
    """Measured rows with _copies, how often each is taken. Of rows alike that the cut falls among, those that come first in
    the stored order are taken; they are numbered by the task that stored them, so they never meet in one."""
    at, before = F.struct("_q", "_tie") == F.col("last"), F.struct("_q", "_tie") < F.col("last")
    wanted = (F.col("rest") > 0) & (F.col("_size") > 0)
    split = wanted & at & (F.col("ties") < F.col("tied"))
    all_ = ranked(rows, per).withColumn("_split", F.coalesce(split, F.lit(False)))
    taken = wanted & ((F.col("_q") < F.col("lo")) | before | at)
    whole = lambda extra: F.when(F.col("_size") > 0, F.col("certain") + F.coalesce(extra, F.lit(False)).cast("long")).otherwise(F.lit(0)).cast("long")
    plain = all_.filter(~F.col("_split")).withColumn("_copies", whole(taken))
    if not per.filter("ties < tied").limit(1).count():
        return plain
    tied = scratch.put(all_.filter("_split").withColumn("_n", F.monotonically_increasing_id()), "tied")
    tied = tied.withColumn("_part", F.shiftright("_n", 33))
    parts = tied.groupBy(F.col("_source").alias("s"), F.col("_part").alias("p")).agg(F.count("*").alias("k"))
    upto = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    parts = parts.select("s", "p", F.coalesce(F.sum("k").over(upto), F.lit(0)).alias("_upto"))
    numbered = tied.withColumn("_i", F.row_number().over(Window.partitionBy("_source", "_part").orderBy("_n")))
    numbered = numbered.join(parts, numbered["_source"].eqNullSafe(parts["s"]) & (numbered["_part"] == parts["p"]))
    return plain.unionByName(numbered.withColumn("_copies", whole(F.col("_upto") + F.col("_i") <= F.col("ties"))).select(*plain.columns))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of each row."""
    scratch = c.Scratch(spark, "mixing")
    rows = scratch.put(measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")).drop("text"), "measured")
    return (
        copies(rows, shares(rows, scratch, weights), scratch)
        .select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken"))
    )


def mixed(spark: SparkSession, docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """The mixed documents: a row as often as it is taken, columns as they were. Texts aren't shuffled."""
    scratch = c.Scratch(spark, "mixing")
    rows = measured(docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row")))
    per = shares(scratch.put(rows.drop("doc_id", "source", "text", "_row"), "measured"), scratch, weights)
    taken = copies(rows, per, scratch).filter("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    return taken.select("_row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, c.table(spark, sf_dir, "documents"))
