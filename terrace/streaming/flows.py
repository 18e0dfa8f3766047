"""Triggered streams: splitting orders in one pass, chunking documents, and applying change events batch by batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from terrace.operators import cdc
from terrace.operators.rules import RuleSet, classify

#: Folder and column that name a key's bucket.
BUCKET = "_bucket"


def run_available(df: DataFrame, each, checkpoint: str) -> StreamingQuery:
    """Run over what is there now; the query, which has ended."""
    query = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def split_orders(stream: DataFrame, rules: RuleSet, valid_path: str, quarantine_path: str, checkpoint: str) -> None:
    """Both sides of the quality gate from one classification. A batch that is run again overwrites its own folder."""

    def each(batch: DataFrame, number: int) -> None:
        marked = classify(batch, rules).persist()
        try:
            good, bad = marked.filter(F.size("violated_rules") == 0), marked.filter(F.size("violated_rules") > 0)
            good.drop("violated_rules").write.mode("overwrite").parquet(f"{valid_path}/batch={number}")
            bad.withColumn("resolution_status_at_quarantine_time", F.lit("PENDING")).write.mode("overwrite").parquet(f"{quarantine_path}/batch={number}")
        finally:
            marked.unpersist()

    run_available(stream, each, checkpoint)


def append(stream: DataFrame, path: str, checkpoint: str) -> None:
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: A bucket's events are folded into its history once they are so many, and that share of its rows; as many small batches are
#: merged into one.
LEAST, SHARE, BATCHES = 1000, 0.2, 16


class History:
    """Versions by key from change events that come in any order, kept in a folder.

    The base has the winning events of each key, deletes included, with their intervals, by bucket of the key and
    sorted by key. A batch only appends its events, by bucket; they are merged as they are read, for their keys alone. A bucket is
    folded into the base when its events have become a fair share of it, so an event is rewritten a few times
    in all, and no batch rewrites buckets that it hasn't filled. State N, a small file, says what there is after batch N;
    it is published last, so a reader sees whole batches, and a batch that is run again starts from the state before it.
    What the last two states don't name is removed. The number of buckets is chosen once and stored."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- states

    def states(self) -> list[int]:
        return sorted(int(n[:-5]) for n in _names(self.spark, f"{self.root}/state") if n.endswith(".json"))

    def load(self, number: int | None = None) -> dict:
        """A state, the last one by default; {} where there is none."""
        known = self.states()
        if not known:
            return {}
        rows = self.spark.read.text(f"{self.root}/state/{known[-1] if number is None else number}.json", wholetext=True).collect()  # one small file
        return json.loads(rows[0]["value"])

    def _publish(self, number: int, state: dict) -> None:
        """Write the state, whole or not at all, and remove what only older states than the one before name."""
        before = self.states()

        def write(fs, p):
            out = fs.create(p, True)
            out.write(bytearray(json.dumps(state).encode()))
            out.close()
            fs.rename(p, p.suffix(".json"))

        _fs(self.spark, f"{self.root}/state/{number}", write)
        kept = self._paths(state) | (self._paths(self.load(before[-1])) if before else set())
        for old in before[:-1]:
            for path in self._paths(self.load(old)) - kept:
                _fs(self.spark, path, lambda fs, p: fs.delete(p, True))
            _fs(self.spark, f"{self.root}/state/{old}.json", lambda fs, p: fs.delete(p, True))

    def _paths(self, state: dict) -> set[str]:
        base = {f"{self.root}/{v['in']}/{BUCKET}={b}" for b, v in state.get("base", {}).items()}
        return base | {f"{self.root}/{d['in']}/{BUCKET}={b}" for d in state.get("deltas", []) for b in d["rows"]}

    # -- reading

    def _read(self, schema: StructType, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _parts(self, state: dict, buckets: set[str]) -> tuple[DataFrame, DataFrame]:
        """(base, events that aren't in it yet) of these buckets."""
        events = StructType.fromJson(state["events"])
        base = StructType.fromJson(state["history"])
        at = [f"{self.root}/{v['in']}/{BUCKET}={b}" for b, v in state["base"].items() if b in buckets and v["rows"]]
        new = [f"{self.root}/{d['in']}/{BUCKET}={b}" for d in state["deltas"] for b in d["rows"] if b in buckets]
        return self._read(base, at), self._read(events, new)

    def table(self) -> DataFrame:
        """The history as of the last state."""
        state = self.load()
        if not state:
            raise ValueError(f"no history in {self.root}")
        columns = StructType.fromJson(state["events"]).names
        shown = [*columns, "__START_AT", "__END_AT"]
        touched = {b for d in state["deltas"] for b in d["rows"]}
        quiet = self._parts(state, set(state["base"]) - touched)[0].filter("NOT __DELETED").select(*shown)
        if not touched:
            return quiet
        base, new = self._parts(state, touched)
        keys = new.select(*state["keys"]).distinct()
        merged = base.join(keys, state["keys"], "left_semi").select(*columns).unionByName(new)
        anew = cdc.scd2(merged, state["keys"], state["sequence"], state["deletes"])
        return quiet.unionByName(base.join(keys, state["keys"], "left_anti").filter("NOT __DELETED").select(*shown)).unionByName(anew)

    # -- writing

    def _put(self, df: DataFrame, name: str, keys: list[str]) -> dict[str, int]:
        """Write rows by bucket; how many each bucket has. Large buckets are dealt to several tasks."""
        path = f"{self.root}/{name}"
        df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        if not any(n.startswith(BUCKET) for n in _names(self.spark, path)):
            return {}
        rows = self.spark.read.schema(df.select(BUCKET).schema).parquet(path).groupBy(BUCKET)
        return {str(r[BUCKET]): r["n"] for r in rows.agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a bucket

    def apply(self, batch: DataFrame, number: int, keys: list[str], sequence: str, deletes: str, buckets: int) -> None:
        """Batch `number`, which counts from 0. One that is published already does nothing."""
        state = self.load()
        if state and state["batch"] >= number:
            return
        if not state:
            state = {"buckets": buckets, "keys": keys, "sequence": sequence, "deletes": deletes, "base": {}, "deltas": []}
            state["events"] = batch.schema.jsonValue()
            state["history"] = cdc.winners(batch.limit(0), keys, sequence, deletes).schema.jsonValue()
        columns = StructType.fromJson(state["events"]).names
        keyed = lambda df: df.withColumn(BUCKET, F.pmod(F.xxhash64(*state["keys"]), F.lit(state["buckets"])).cast("int"))
        rows = self._put(keyed(batch.select(*columns)), f"delta/{number}", keys)
        state["batch"] = number
        if rows:
            state["deltas"].append({"in": f"delta/{number}", "rows": rows})
        waiting: dict[str, int] = {}
        for d in state["deltas"]:
            for b, n in d["rows"].items():
                waiting[b] = waiting.get(b, 0) + n
        full = {b for b, n in waiting.items() if n >= max(LEAST, SHARE * state["base"].get(b, {"rows": 0})["rows"])}
        if full:
            base, new = self._parts(state, full)
            events = base.select(*columns).unionByName(new)
            found = self._put(keyed(cdc.winners(events, state["keys"], state["sequence"], state["deletes"])), f"base/{number}", keys)
            for b in full:
                state["base"][b] = {"in": f"base/{number}", "rows": found.get(b, 0)}
            for d in state["deltas"]:
                d["rows"] = {b: n for b, n in d["rows"].items() if b not in full}
            state["deltas"] = [d for d in state["deltas"] if d["rows"]]
        if len(state["deltas"]) > BATCHES:
            left = {b for d in state["deltas"] for b in d["rows"]}
            state["deltas"] = [{"in": f"delta/{number}-merged", "rows": self._put(keyed(self._parts(state, left)[1]), f"delta/{number}-merged", keys)}]
        self._publish(number, state)


def apply_changes(spark: SparkSession, stream: DataFrame, root: str, keys: list[str], sequence: str, deletes: str, buckets: int = 32) -> StreamingQuery:
    """Take the stream's new change events into the History at `root`. `buckets` counts when the history is made; the stored
    number holds from then on."""
    history = History(spark, root)
    return run_available(stream, lambda batch, number: history.apply(batch, number, keys, sequence, deletes, buckets), f"{root}/checkpoint")


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The history at `root`."""
    return History(spark, root).table()


def _fs(spark: SparkSession, path: str, do):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return do(p.getFileSystem(spark._jsc.hadoopConfiguration()), p)


def _names(spark: SparkSession, path: str) -> list[str]:
    return _fs(spark, path, lambda fs, p: sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else [])
