"""Exact quantiles of groups of any size, by selection: no task holds a group's values.

A sketch brackets the rank in each group; only values within the bracket are counted, each distinct one once. Where that
still leaves very many in a group, histograms over the bracket narrow it, each keeping the bin that holds the rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.sources.scratch import staged

#: Ranks are bracketed to a few times a share of 1/ACCURACY; distinct values of a group that are sorted at last; bins of a histogram.
ACCURACY, LIMIT, BINS = 10_000, 1 << 18, 1024


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by keys, null with null; b's keys are dropped."""
    other = b.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return a.join(other, on, how).drop(*(f"_{k}" for k in keys))


def _bracketed(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _side, _v, _c): how often each value of the bracket is there, with side 0; what lies below (-1) and above (1) counts
    under the least of its values, one row each."""
    met = _join(rows, facts.select(*keys, "_low", "_high"), keys)
    side = F.when(F.col("_v") < F.col("_low"), -1).when(F.col("_v") > F.col("_high"), 1).otherwise(0)
    met = met.select(*keys, side.alias("_side"), "_v", "_c")
    return met.groupBy(*keys, "_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_x")).agg(F.min("_v").alias("_v"), F.sum("_c").alias("_c")).drop("_x")


def _narrowed(cells: DataFrame, facts: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """The bracket of each group cut to the bin of a histogram that holds its rank."""
    ends = cells.filter("_side = 0").groupBy(*keys).agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    at = F.when(F.col("_b") > F.col("_a"), F.least(F.floor((F.col("_v") - F.col("_a")) / (F.col("_b") - F.col("_a")) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    binned = _join(cells, ends, keys).withColumn("_bin", F.when(F.col("_side") == 0, at).otherwise(F.when(F.col("_side") < 0, -1).otherwise(bins)))
    hist = binned.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin"))  # bins + 2 rows a group
    return _join(hist.withColumn("_upto", upto), facts.select(*keys, "_rank"), keys).filter("_upto >= _rank AND _upto - _n < _rank").select(*keys, "_rank", "_low", "_high")


def exact_quantile(df: DataFrame, keys: list[str], value: str, share: float, name: str, limit: int = LIMIT, bins: int = BINS, accuracy: int = ACCURACY) -> DataFrame:
    """keys and `name`: the quantile of each group's non-null values, between ranks by their distance, as a double. Groups
    without a value have no row; null keys are a group. At least one key."""
    raw = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    rows = raw.withColumn("_c", F.lit(1).cast("long"))
    near = [max(0.0, share - 3 / accuracy), min(1.0, share + 3 / accuracy)]
    sketch = F.percentile_approx("_v", near, accuracy)
    facts = raw.groupBy(*keys).agg(F.count("_v").alias("_n"), sketch.alias("_s"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    place = F.lit(share) * (F.col("_n") - 1)
    facts = facts.withColumns({
        "_rank": F.floor(place) + 1, "_part": place - F.floor(place),
        # a small group is its own bracket
        "_low": F.when((F.col("_n") >= accuracy) & F.lit(near[0] > 0), F.col("_s")[0]).otherwise(F.col("_min")),
        "_high": F.when((F.col("_n") >= accuracy) & F.lit(near[1] < 1), F.col("_s")[1]).otherwise(F.col("_max")),
    }).drop("_s")
    facts = staged(facts, "quantile-facts")
    cells, bracket = _bracketed(rows, facts, keys), facts
    while True:
        cells = staged(cells, "quantile-cells")  # a round's values, which the next one reads again
        most = cells.filter("_side = 0").groupBy(*keys).agg(F.count("_v").alias("n")).agg(F.max("n")).first()[0]
        if not most or most <= limit:
            break
        bracket = staged(_narrowed(cells, bracket, keys, bins), "quantile-bracket")
        cells = _bracketed(cells, bracket, keys)
    order = Window.partitionBy(*keys).orderBy("_v")
    placed = cells.withColumns({"_upto": F.sum("_c").over(order), "_next": F.lead("_v").over(order)})
    ranked = _join(placed, facts.select(*keys, "_rank", "_part"), keys).filter("_upto >= _rank")
    found = ranked.groupBy(*keys).agg(F.min(F.struct("_v", "_next", "_upto", "_rank", "_part")).alias("_f")).select(*keys, "_f.*")
    part = F.when((F.col("_part") > 0) & (F.col("_upto") == F.col("_rank")), F.col("_part") * (F.col("_next") - F.col("_v")))
    return found.select(*keys, (F.col("_v") + F.coalesce(part, F.lit(0.0))).alias(name))
