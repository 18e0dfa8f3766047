"""A graph of datasets and a runner: views, materialized views, streaming tables and change-data targets with expectations.

Functions say what a dataset is; they take the pipeline and read others by name. A run goes through the graph in
dependency order and records events, with counts by expectation and of the rows of that update, taken as the plan runs.
A view is planned once for each dataset that reads it, however often, so its rows are counted once. An expectation whose
rows never reach the plan that ran has no counts; it is listed with nulls. A table is published as a new version, a folder that counts
once it is whole and no fail rule was broken by a row; a failed expectation ends the run and leaves the last version as it was.

Properties that do something: `retention` ("interval 7 days") keeps versions for so long after they were replaced, beside
the last two; `change_feed` names the key columns, comma-separated, by which changes() compares versions.
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.operators import cdc, changes
from terrace.operators.rules import RuleSet, drop, fail
from terrace.streaming import flows

def interval(text: str) -> timedelta:
    """"interval 7 days" as a length of time."""
    n, unit = text.lower().removeprefix("interval").split()
    return timedelta(**{unit.rstrip("s") + "s": float(n)})


EVENTS = "timestamp timestamp, event_type string, level string, message string, duration_ms bigint, origin struct<update_id:string,pipeline_name:string,flow_name:string>, details string"


class ExpectationFailed(Exception):
    """Rows broke fail rules: `failed` has how many, by rule."""

    def __init__(self, name: str, failed: dict[str, int]):
        super().__init__(f"expectation failed in {name}: " + ", ".join(f"{k} by {n} rows" for k, n in failed.items()))
        self.failed = failed


@dataclass
class Dataset:
    name: str
    kind: str  # view, materialized, streaming or scd2
    make: Callable[[Pipeline], DataFrame]
    inputs: tuple[str, ...]
    warn: dict[str, str] = field(default_factory=dict)
    drop: dict[str, str] = field(default_factory=dict)
    fail: dict[str, str] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)
    change: dict = field(default_factory=dict)


class Pipeline:
    def __init__(self, spark: SparkSession, name: str, root: str, parameters: dict[str, str] | None = None):
        """`parameters` are the pipeline's configuration, which functions ask for by name."""
        self.spark, self.name, self.root, self.parameters = spark, name, root.rstrip("/"), dict(parameters or {})
        self.datasets: dict[str, Dataset] = {}
        self.seen: list[tuple[str, str, Observation | str]] = []
        self.events: list[tuple] = []
        self.update_id = ""
        self.flow: str | None = None  # the dataset that is being brought up to date
        self.planned: dict[str, DataFrame] = {}  # views that it has read

    # -- declaration

    def _add(self, kind: str, name: str | None, inputs, **more):
        def register(f: Callable[[Pipeline], DataFrame]):
            d = Dataset(name or f.__name__, kind, f, tuple(inputs), **more)
            if d.name in self.datasets:
                raise ValueError(f"{d.name} is declared twice")
            self.datasets[d.name] = d
            return f

        return register

    def view(self, *inputs: str, name: str | None = None, **more):
        return self._add("view", name, inputs, **more)

    def materialized_view(self, *inputs: str, name: str | None = None, **more):
        return self._add("materialized", name, inputs, **more)

    def streaming_table(self, *inputs: str, name: str | None = None, **more):
        return self._add("streaming", name, inputs, **more)

    def scd2_table(self, *inputs: str, name: str, keys: list[str], sequence: str, deletes: str, **more):
        """A history table over a table of change events; the function gives the events."""
        return self._add("scd2", name, inputs, change={"keys": keys, "sequence": sequence, "deletes": deletes}, **more)

    # -- reading

    def parameter(self, name: str, default: str | None = None) -> str:
        value = self.parameters.get(name, self.spark.conf.get(name, default))
        if value is None:
            raise ValueError(f"no parameter {name}")
        return value

    def _versions(self, name: str) -> list[int]:
        """Versions of a table that are whole, in order."""
        p, fs = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return []
        parts = [x.getPath().getName() for x in fs.listStatus(p)]
        return sorted(int(x[2:]) for x in parts if x.startswith("v-") and fs.exists(self._fs(f"{self.root}/{name}/{x}/_SUCCESS")[0]))

    def path(self, name: str) -> str:
        """Where the table is: its last whole version; a streaming table grows in one folder."""
        done = self._versions(name)
        return f"{self.root}/{name}/v-{done[-1]}" if done else f"{self.root}/{name}"

    def _view(self, d: Dataset) -> DataFrame:
        if not self.flow:
            return self._expected(d, d.make(self))
        if d.name not in self.planned:
            self.planned[d.name] = self._expected(d, d.make(self))
        return self.planned[d.name]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A dataset, or a kept version of a table."""
        d = self.datasets.get(name)
        if d and d.kind == "view":
            return self._view(d)
        if version is not None:
            return self.spark.read.parquet(f"{self.root}/{name}/v-{version}")
        if flows.History(self.spark, f"{self.root}/{name}").states():
            return flows.latest(self.spark, f"{self.root}/{name}")
        return self.spark.read.parquet(self.path(name))

    def read_stream(self, name: str) -> DataFrame:
        d = self.datasets.get(name)
        if d and d.kind == "view":
            return self._view(d)
        schema, one = self.spark.read.parquet(self.path(name)).schema, f"{self.root}/{name}"
        # a stream keeps to one path; over a table of versions it reads each version's files
        return self.spark.readStream.schema(schema).parquet(f"{one}/v-*" if self._versions(name) else one)

    def changes(self, name: str, since: int, until: int | None = None) -> DataFrame:
        """What became of a table's rows from one version to the next, up to `until`: its columns, _change_type,
        _commit_version and _commit_timestamp. Versions are compared by the keys of its `change_feed`."""
        keys = [k.strip() for k in self.datasets[name].properties.get("change_feed", "").split(",") if k.strip()]
        if not keys:
            raise ValueError(f"{name} has no change_feed")
        kept = self._versions(name)
        last = kept[-1] if until is None else until
        for v in range(since, last + 1):
            if v not in kept:
                raise ValueError(f"version {v} of {name} isn't kept")
        parts = [changes.between(self.read(name, v - 1), self.read(name, v), keys).withColumns({"_commit_version": F.lit(v).cast("long"), "_commit_timestamp": F.lit(self._published(name, v))}) for v in range(since + 1, last + 1)]
        if not parts:
            raise ValueError(f"no version of {name} after {since}")
        return reduce(DataFrame.unionByName, parts)

    # -- running

    def order(self) -> list[Dataset]:
        """Inputs before what reads them."""
        done: list[str] = []
        open_: set[str] = set()

        def visit(name: str) -> None:
            if name in done or name not in self.datasets:
                return
            if name in open_:
                raise ValueError(f"{name} depends on itself")
            open_.add(name)
            for x in self.datasets[name].inputs:
                visit(x)
            done.append(name)

        for name in self.datasets:
            visit(name)
        return [self.datasets[n] for n in done]

    def _observe(self, df: DataFrame, kind: str, name: str, *counts) -> DataFrame:
        """Counts that the plan takes as it runs, in batches and streams alike."""
        label = f"{kind}-{name}-{uuid.uuid4().hex[:8]}"
        self.seen.append((kind, name, label if df.isStreaming else Observation(label)))
        return df.observe(self.seen[-1][2], *counts)

    def _expected(self, d: Dataset, df: DataFrame) -> DataFrame:
        """Violations of all rules are counted, and drop rules applied. Broken fail rules end an update before it is
        published; a stream, whose batches are published as they come, and a reader outside of an update are ended by the row."""
        if self.flow and (d.warn or d.drop or d.fail):
            rules = RuleSet(d.warn | d.drop | d.fail)
            df = self._observe(df, "expectations", d.name, F.count(F.lit(1)).alias("rows"), *(F.count_if(~rules.ok(n)).alias(n) for n in rules.rules))
        if d.fail and (df.isStreaming or not self.flow):
            df = fail(df, RuleSet(d.fail))
        return drop(df, RuleSet(d.drop)) if d.drop else df

    def _observed(self, at: Observation | str, progress: list) -> list[dict[str, int]]:
        """Metrics of one observation; none if its rows were in no plan that ran."""
        if isinstance(at, str):
            return [m[at].asDict() for m in progress if at in m]
        if at._jo is None or not at._jo.future().isCompleted():
            return []
        with contextlib.suppress(Exception):  # planned, but what it counts was found to be empty
            return [at.get]
        return []

    def _counts(self, query=None) -> dict[str, dict[str, dict[str, int]]]:
        """What was observed in the plans that have run, by kind and dataset; a stream's batches add up. Without counts: not run."""
        with contextlib.suppress(Exception):  # what listeners are told of plans that have ended
            self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        out: dict[str, dict[str, dict[str, int]]] = {}
        progress = [p.observedMetrics for p in query.recentProgress] if query else []
        for kind, name, at in self.seen:
            total = out.setdefault(kind, {}).setdefault(name, {})
            for row in self._observed(at, progress):
                for k, v in row.items():
                    total[k] = total.get(k, 0) + v
        return out

    def _event(self, flow: str | None, kind: str, level: str, message: str, ms: int | None = None, details: dict | None = None) -> None:
        self.events.append((datetime.now(timezone.utc).replace(tzinfo=None), kind, level, message, ms, (self.update_id, self.name, flow), json.dumps(details or {})))

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _published(self, name: str, version: int) -> datetime:
        p, fs = self._fs(f"{self.root}/{name}/v-{version}/_SUCCESS")
        return datetime.fromtimestamp(fs.getFileStatus(p).getModificationTime() / 1000, timezone.utc)

    def expire(self, name: str, now: datetime | None = None) -> list[int]:
        """Remove versions that were replaced longer ago than the table's retention, but never the last two; returns which."""
        days = self.datasets[name].properties.get("retention") if name in self.datasets else None
        kept, now = self._versions(name), now or datetime.now(timezone.utc)
        gone = []
        for v, next_ in zip(kept[:-2], kept[1:-1], strict=True):
            if days is None or self._published(name, next_) < now - interval(days):
                p, fs = self._fs(f"{self.root}/{name}/v-{v}")
                fs.delete(p, True)
                gone.append(v)
        return gone

    def publish(self, name: str, df: DataFrame, check: Callable[[], None] = lambda: None) -> None:
        """Write the next version beside the last one. Readers go on with theirs until the new one is whole and checked."""
        done = self._versions(name)
        number = done[-1] + 1 if done else 0
        path = f"{self.root}/{name}/v-{number}"
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").mode("overwrite").parquet(path)
        try:
            check()
        except ExpectationFailed:
            p, fs = self._fs(path)
            fs.delete(p, True)
            raise
        p, fs = self._fs(f"{path}/_SUCCESS")
        fs.create(p, True).close()
        self.expire(name)

    def _update(self, d: Dataset) -> dict:
        """Bring one table up to date; what was counted."""
        df = self._expected(d, d.make(self))
        if d.kind == "scd2" and df.isStreaming:
            df = self._observe(df, "written", d.name, F.count(F.lit(1)).alias("rows"))
            return self._counts(flows.apply_changes(self.spark, df, f"{self.root}/{d.name}", **d.change))
        if d.kind == "scd2":
            df = cdc.scd2(df, **d.change)
        df = self._observe(df, "written", d.name, F.count(F.lit(1)).alias("rows"))
        if d.kind == "streaming" and df.isStreaming:
            out = df.writeStream.format("parquet").option("path", f"{self.root}/{d.name}").option("checkpointLocation", f"{self.root}/_checkpoints/{d.name}")
            query = out.trigger(availableNow=True).start()
            query.awaitTermination()
            return self._counts(query)
        counts: dict = {}

        def check() -> None:
            counts.update(self._counts())
            for name, found in counts.get("expectations", {}).items():
                failed = {k: found[k] for k in self.datasets[name].fail if found.get(k)}
                if failed:
                    raise ExpectationFailed(name, failed)

        self.publish(d.name, df, check)
        return counts

    def run(self) -> str:
        """One update. Returns its id; events() has what happened."""
        self.update_id = uuid.uuid4().hex
        keep = "spark.sql.streaming.numRecentProgressUpdates"
        before = self.spark.conf.get(keep, "100")
        self.spark.conf.set(keep, "100000")  # a triggered stream may have many batches
        try:
            for d in self.order():
                if d.kind != "view":
                    self._run_one(d)
        finally:
            self.spark.conf.set(keep, before)
        return self.update_id

    def _run_one(self, d: Dataset) -> None:
        began = time.time()
        self.seen, self.planned, self.flow = [], {}, d.name
        spent = lambda: int(1000 * (time.time() - began))
        try:
            counts = self._update(d)
        except Exception as e:
            self._event(d.name, "flow_progress", "ERROR", str(e).splitlines()[0], spent(), {"flow_progress": {"failed": getattr(e, "failed", {})}})
            raise
        finally:
            self.flow, self.planned = None, {}
        rows = counts.get("written", {}).get(d.name, {}).get("rows", 0)
        expectations = []
        for n, found in counts.get("expectations", {}).items():
            of = self.datasets[n]
            for k in of.warn | of.drop:  # fail rules: no row broke them, or there is no such update
                expectations.append({"dataset": n, "name": k, "failed_records": found.get(k), "passed_records": found["rows"] - found[k] if found else None})
        self._event(d.name, "flow_progress", "INFO", "completed", spent(), {"flow_progress": {"metrics": {"num_output_rows": rows}, "data_quality": {"expectations": expectations}}})

    def expectations(self) -> DataFrame:
        """Each expectation's counts in each update: update_id, flow_name, dataset, name, passed_records, failed_records."""
        schema = "array<struct<dataset:string,name:string,failed_records:bigint,passed_records:bigint>>"
        found = F.from_json(F.get_json_object("details", "$.flow_progress.data_quality.expectations"), schema)
        return self.event_log().select("origin.update_id", "origin.flow_name", F.inline(found)).select("update_id", "flow_name", "dataset", "name", "passed_records", "failed_records")

    def event_log(self) -> DataFrame:
        return self.spark.createDataFrame(self.events, EVENTS)

    def register(self, name: str, table: str) -> None:
        """Put a table's last version into Spark's catalogue, under this name, with its properties as table properties."""
        quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) USING parquet LOCATION {quoted(self.path(name))}", args={"t": table})
        self.spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION {quoted(self.path(name))}", args={"t": table})
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in self.datasets[name].properties.items())
        if pairs:
            self.spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET TBLPROPERTIES ({pairs})", args={"t": table})
        self.spark.catalog.refreshTable(table)

    def properties(self) -> DataFrame:
        """What is declared: table_name, property, value."""
        rows = [(d.name, k, v) for d in self.datasets.values() for k, v in d.properties.items()]
        return self.spark.createDataFrame(rows, "table_name string, property string, value string")
