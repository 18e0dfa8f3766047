import datetime
import json

import pytest
from pyspark.sql import functions as F

from terrace.operators import cdc, changes
from terrace.plans.graph import ExpectationFailed, Pipeline, interval


@pytest.fixture
def pipeline(spark, tmp_path):
    return Pipeline(spark, "p", f"file://{tmp_path}")


def test_fail_rules_are_counted_before_publishing(spark, pipeline, tmp_path):
    p, limit = pipeline, [100]

    @p.view(fail={"small": "id < 3", "there": "id IS NOT NULL"})
    def numbers(p):
        return spark.range(limit[0])

    @p.materialized_view("numbers")
    def doubled(p):
        return p.read("numbers").select((F.col("id") * 2).alias("id"))

    with pytest.raises(ExpectationFailed, match="small by 97 rows"):
        p.run()
    assert json.loads(p.events[-1][6])["flow_progress"]["failed"] == {"small": 97}
    assert not list(tmp_path.glob("doubled/v-*"))
    limit[0] = 3
    p.run()
    assert p.read("doubled").count() == 3
    assert p.expectations().count() == 0  # fail rules are told of only where they end an update
    limit[0] = 100
    with pytest.raises(Exception, match="expectation failed"):
        p.read("numbers").count()  # outside of an update the row ends it
    with pytest.raises(ExpectationFailed):
        p.run()
    assert p.read("doubled").count() == 3


def test_streams_count_views_once(spark, pipeline, tmp_path):
    p = pipeline
    spark.range(20).write.parquet(f"{tmp_path}/in")

    @p.view(drop={"even": "id % 2 = 0"})
    def even(p):
        return spark.readStream.schema("id long").parquet(f"{tmp_path}/in")

    @p.streaming_table("even", warn={"low": "id < 5"})
    def both(p):
        return p.read("even").unionByName(p.read_stream("even"))

    p.run()
    assert p.read("both").count() == 20
    got = {r["name"]: (r["passed_records"], r["failed_records"]) for r in p.expectations().collect()}
    assert got["low"] == (6, 14)
    assert got["even"][0] in (10, 20)  # Spark may read the source once or twice
    assert got["even"][0] == got["even"][1]


def test_history_from_a_stream(spark, pipeline, tmp_path):
    p, schema = pipeline, "k string, s int, op string"

    @p.scd2_table(name="history", keys=["k"], sequence="s", deletes="op = 'D'", drop={"known": "op IS NOT NULL"})
    def events(p):
        return spark.readStream.schema(schema).parquet(f"{tmp_path}/in")

    seen = []
    for rows in ([("a", 2, "U"), ("b", 1, "U"), ("c", 1, None)], [("a", 1, "U"), ("b", 3, "D")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        seen += [r for r in rows if r[2]]
        p.run()
        want = cdc.scd2(spark.createDataFrame(seen, schema), ["k"], "s", "op = 'D'")
        assert sorted(map(tuple, p.read("history").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert sum(r["failed_records"] for r in p.expectations().collect()) == 1


def test_retention(spark, pipeline, tmp_path):
    p = pipeline
    p.materialized_view(name="plain")(lambda p: spark.range(1))
    p.materialized_view(name="kept", properties={"retention": "interval 7 days", "change_feed": "id"})(lambda p: spark.range(len(list(tmp_path.glob("kept/v-*")))))
    for _ in range(4):
        p.run()
    assert p._versions("plain") == [2, 3]
    assert p._versions("kept") == [0, 1, 2, 3]
    feed = p.changes("kept", 0).groupBy("_commit_version", "_change_type").count()
    assert sorted(map(tuple, feed.collect())) == [(1, "insert", 1), (2, "insert", 1), (3, "insert", 1)]
    assert p.changes("kept", 0, 1).count() == 1
    now = datetime.datetime.now(datetime.timezone.utc)
    assert p.expire("kept", now + datetime.timedelta(days=6)) == []
    assert p.expire("kept", now + datetime.timedelta(days=8)) == [0, 1]
    assert p._versions("kept") == [2, 3]
    with pytest.raises(ValueError, match="isn't kept"):
        p.changes("kept", 0)
    with pytest.raises(ValueError, match="no change_feed"):
        p.changes("plain", 2)
    assert interval("INTERVAL 2 hours") == datetime.timedelta(hours=2)


def test_changes_between_versions(spark):
    """Repeated and null keys, columns that only one version has, rows that are the same."""
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n"), (4, "same"), (4, "same")], "id int, x string")
    new = spark.createDataFrame([(1, "a", 5), (2, "c", None), (None, "m", None), (3, "new", None), (4, "same", None), (4, "same", None)], "id int, x string, y int")
    got = sorted(map(tuple, changes.between(old, new, ["id"]).select("id", "x", "y", "_change_type").collect()), key=repr)
    want = [(1, "a", None, "update_preimage"), (1, "a", 5, "update_postimage"), (3, "new", None, "insert"), (None, "n", None, "update_preimage"), (None, "m", None, "update_postimage")]
    two = [x for x in got if x[0] == 2]
    assert [x for x in got if x[0] != 2] == sorted(want, key=repr)
    assert {x[3] for x in two} <= {"delete", "update_preimage", "update_postimage"}
    assert changes.between(old, old, ["id"]).count() == 0
