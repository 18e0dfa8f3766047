import io
import random
from contextlib import redirect_stdout

from terrace.operators import quantiles


def test_no_row_is_shuffled_by_its_group_alone(spark):
    """What is exchanged by the group's key are counted values, so no task gets a group's rows."""
    df = spark.range(100_000).selectExpr("CAST(id % 2 AS STRING) AS k", "CAST(id AS DOUBLE) AS v")
    out = quantiles.exact_quantile(df, ["k"], "v", 0.5, "q")
    with redirect_stdout(io.StringIO()) as shown:
        out.explain()
    assert "Range (0, " not in shown.getvalue()  # the rows themselves aren't read again
    assert {r["k"]: r["q"] for r in out.collect()} == {"0": 49_999.0, "1": 50_000.0}


def test_next_value_beyond_the_bracket(spark):
    """The value after the rank's is taken from above the bracket, however often that is narrowed."""
    rng = random.Random(3)
    groups = {k: [rng.random() for _ in range(n)] + [1e9 + rng.random() for _ in range(n)] for k, n in (("even", 700), ("few", 3))}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(3)
    got = {r["k"]: r["q"] for r in quantiles.exact_quantile(df, ["k"], "v", 0.5, "q", limit=2, bins=4, accuracy=100).collect()}
    for k, vs in groups.items():
        vs = sorted(vs)
        assert got[k] == vs[len(vs) // 2 - 1] + 0.5 * (vs[len(vs) // 2] - vs[len(vs) // 2 - 1])
