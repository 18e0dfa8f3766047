import random

import pytest
from pyspark.sql import functions as F

from terrace.operators import cdc
from terrace.streaming import flows
from terrace.streaming.flows import History

SCHEMA = "k string, s int, op string, v string"
KEYS, SEQUENCE, DELETES = ["k"], "s", "op = 'DELETE'"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "s", "op", "v", "__START_AT", "__END_AT").collect()), key=repr)


def size(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_batches_in_any_order(spark, tmp_path, monkeypatch):
    """Late events, deletes, ties and repeats over many batches, through folding and merging, equal one pass over all events."""
    monkeypatch.setattr(flows, "LEAST", 6)
    monkeypatch.setattr(flows, "BATCHES", 3)
    rng, seen = random.Random(2), []
    history = History(spark, f"file://{tmp_path}/h")
    for i in range(9):
        batch = [(f"k{rng.randint(0, 20)}", rng.randint(0, 30), rng.choice(["UPDATE", "UPDATE", "DELETE"]), rng.choice("xyz")) for _ in range(rng.choice([2, 3, 25]))]
        batch += [(None, 1, "UPDATE", "x"), ("k1", None, "UPDATE", "x")]
        df = spark.createDataFrame(batch, SCHEMA)
        history.apply(df, i, KEYS, SEQUENCE, DELETES, 4)
        history.apply(df, i, KEYS, SEQUENCE, DELETES, 4)  # run again: nothing more
        seen += batch
        assert rows_of(history.table()) == rows_of(cdc.scd2(spark.createDataFrame(seen, SCHEMA), KEYS, SEQUENCE, DELETES))
    assert len(history.states()) == 2
    state = history.load()
    assert state["base"]
    assert len(state["deltas"]) <= 4


def test_bucket_number_is_stored(spark, tmp_path):
    root = f"file://{tmp_path}/h"
    for i, buckets in enumerate((32, 64)):
        spark.range(500 + i).select(F.col("id").cast("string").alias("k"), F.lit(i).alias("s"), F.lit("UPDATE").alias("op"), F.lit("x").alias("v")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        flows.apply_changes(spark, spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), root, KEYS, SEQUENCE, DELETES, buckets)
    got = flows.latest(spark, root)
    assert got.filter("__END_AT IS NULL").count() == 501
    assert got.count() == 1001
    assert History(spark, root).load()["buckets"] == 32


def test_small_batch_rewrites_little(spark, tmp_path):
    """Ten keys of a million: under one per cent of the bytes is written, and the base isn't touched."""
    history = History(spark, f"file://{tmp_path}/h")
    made = lambda n, s: spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(s).alias("s"), F.lit("UPDATE").alias("op"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    history.apply(made(1_000_000, 1), 0, KEYS, SEQUENCE, DELETES, 16)
    before, files = size(tmp_path), set(tmp_path.rglob("*.parquet"))
    history.apply(made(10, 0).unionByName(made(1, 2)), 1, KEYS, SEQUENCE, DELETES, 16)
    new = sum(f.stat().st_size for f in set(tmp_path.rglob("*.parquet")) - files)
    assert new < 0.01 * before
    got = history.table()
    assert got.count() == 1_000_011
    assert sorted((r["__START_AT"], r["__END_AT"]) for r in got.filter("k = '0'").collect()) == [(0, 1), (1, 2), (2, None)]
    assert sorted((r["__START_AT"], r["__END_AT"]) for r in got.filter("k = '5'").collect()) == [(0, 1), (1, None)]


def test_a_batch_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    history = History(spark, f"file://{tmp_path}/h")
    row = lambda s: spark.createDataFrame([("a", s, "UPDATE", "x")], SCHEMA)
    history.apply(row(1), 0, KEYS, SEQUENCE, DELETES, 2)

    def broken(self, number, state):
        raise OSError

    with monkeypatch.context() as m:
        m.setattr(History, "_publish", broken)
        with pytest.raises(OSError):
            history.apply(row(2), 1, KEYS, SEQUENCE, DELETES, 2)
    assert history.table().count() == 1  # the state before
    history.apply(row(2), 1, KEYS, SEQUENCE, DELETES, 2)
    assert sorted((r["__START_AT"], r["__END_AT"]) for r in history.table().collect()) == [(1, 2), (2, None)]
    assert History(spark, f"file://{tmp_path}/none").load() == {}
    with pytest.raises(ValueError, match="no history"):
        History(spark, f"file://{tmp_path}/none").table()
