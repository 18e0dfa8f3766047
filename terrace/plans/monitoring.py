"""Alerts, dashboards and investigations over telemetry tables, as DataFrame plans.

Current date and time are parameters. Money and rates are rounded as the tables show them. An alert is one row whose
first column says how much is wrong; `evaluate` compares it with a threshold.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.quantiles import exact_quantile

OPERATORS = {
    "GREATER_THAN": operator.gt, "GREATER_THAN_OR_EQUAL": operator.ge, "LESS_THAN": operator.lt, "LESS_THAN_OR_EQUAL": operator.le,
    "EQUAL": operator.eq, "NOT_EQUAL": operator.ne,
}


def evaluate(alert: DataFrame, column: str, op: str = "GREATER_THAN", threshold: float = 0, empty: bool = False) -> bool:
    """Does the alert fire? It looks at the first row; without rows it is as `empty` says."""
    rows = alert.select(column).take(1)
    return empty if not rows else rows[0][0] is not None and OPERATORS[op](rows[0][0], threshold)


def minutes(a: Column | str, b: Column | str) -> Column:
    """Whole minutes from a to b."""
    return F.timestamp_diff("MINUTE", F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def since(column: str, now: Column, interval: str) -> Column:
    return F.col(column) > now - F.expr(f"INTERVAL {interval}")


def share(part: Column, whole: Column) -> Column:
    """Percent, null of nothing."""
    return part.cast("double") * 100 / F.nullif(whole, F.lit(0))


def n_rows() -> Column:
    return F.count(F.lit(1))


# ---- alerts ------------------------------------------------------------------------------------


def failed_tasks(tasks: DataFrame, now: Column) -> DataFrame:
    bad = tasks.filter((F.col("result_state") == "FAILED") & since("period_start_time", now, "1 DAY"))
    return bad.agg(
        n_rows().alias("failed_task_count"), F.max("period_start_time").alias("latest_failure_time"),
        F.max("job_id").alias("sample_job_id"), F.max("task_key").alias("sample_task_key"),
    )


def failed_updates(updates: DataFrame, now: Column, interval: str = "10 MINUTES") -> DataFrame:
    bad = updates.filter((F.col("result_state") == "FAILED") & since("period_start_time", now, interval))
    return bad.agg(
        n_rows().alias("failed_update_count"), F.max("period_start_time").alias("latest_failure_time"),
        F.max("pipeline_id").alias("sample_pipeline_id"),
    )


def stale_jobs(runs: DataFrame, now: Column, interval: str = "24 HOURS") -> DataFrame:
    """Jobs whose last success is long ago; one that never succeeded isn't seen."""
    last = runs.filter("result_state = 'SUCCESS'").groupBy("job_id").agg(F.max("period_start_time").alias("last"))
    return (
        last.filter(F.col("last") < now - F.expr(f"INTERVAL {interval}"))
        .agg(n_rows().alias("stale_job_count"), F.max("job_id").alias("sample_job_id"), F.min("last").alias("oldest_last_success_time"))
    )


def long_runs(runs: DataFrame, now: Column, most: int = 15) -> DataFrame:
    d = minutes("period_start_time", "period_end_time")
    slow = runs.filter(since("period_start_time", now, "1 DAY") & (d > most)).withColumn("d", d)
    return slow.agg(
        n_rows().alias("long_running_count"), F.max("job_id").alias("sample_job_id"), F.max("run_id").alias("sample_run_id"),
        F.max("d").alias("max_duration_minutes"),
    )


def slowdowns(updates: DataFrame, log: DataFrame, pipeline_id: str, factor: float = 1.5) -> DataFrame:
    """Updates whose duration grew more than `factor` times as much as their output did. The order is over one pipeline's updates."""
    took = (
        updates.filter((F.col("pipeline_id") == pipeline_id) & (F.col("result_state") == "COMPLETED"))
        .select("update_id", "pipeline_id", "period_start_time", minutes("period_start_time", "period_end_time").alias("took"))
    )
    rows = F.get_json_object("details", "$.flow_progress.metrics.num_output_rows").try_cast("bigint")
    made = log.filter("event_type = 'flow_progress'").groupBy(F.col("origin.update_id").alias("update_id")).agg(F.sum(rows).alias("made"))
    w = Window.partitionBy("pipeline_id").orderBy("period_start_time", "update_id")
    steps = took.join(made, "update_id").withColumn("took0", F.lag("took").over(w)).withColumn("made0", F.lag("made").over(w))
    odd = (
        steps.filter((F.col("took0") > 0) & (F.col("made0") > 0))
        .filter(F.col("took") / F.col("took0") > factor * F.greatest(F.col("made") / F.col("made0"), F.lit(0.01)))
    )
    return odd.agg(
        n_rows().alias("anomalous_update_count"), F.max("update_id").alias("sample_update_id"),
        F.max("took").alias("sample_duration_minutes"), F.max("made").alias("sample_output_rows"),
    )


def cost_change(usage: DataFrame, today: Column, percent: float = 20) -> DataFrame:
    """Today's usage against yesterday's, up or down."""
    total = lambda day, name: usage.filter(F.col("usage_date") == day).groupBy("usage_date").agg(F.sum("usage_quantity").alias(name)).select(name)
    both = total(today, "now").crossJoin(total(F.date_sub(today, 1), "before"))  # at most a row each
    growth = (F.col("now") - F.col("before")) / F.nullif("before", F.lit(0.0)) * 100
    out = both.withColumn("growth", growth).filter(F.abs("growth") > percent)
    return out.agg(
        n_rows().alias("spike_flag"), F.round(F.max("now"), 2).alias("today_usage"),
        F.round(F.max("before"), 2).alias("yesterday_usage"), F.round(F.max("growth"), 2).alias("growth_rate_pct"),
    )


def cost_change_by_warehouse(usage: DataFrame, warehouses: DataFrame, today: Column, percent: float = 50) -> DataFrame:
    of = lambda day: F.sum(F.when(F.col("usage_date") == day, F.col("usage_quantity")).otherwise(0.0))
    u = (
        usage.filter(F.col("usage_date") >= F.date_sub(today, 1))
        .select(
            "usage_date", "usage_quantity", F.col("usage_metadata.warehouse_id").alias("warehouse_id"),
            F.try_element_at("custom_tags", F.lit("project")).alias("project"),
        )
    )
    per = (
        u.join(warehouses, "warehouse_id", "left")
        .groupBy("warehouse_name", "project")
        .agg(of(today).alias("now"), of(F.date_sub(today, 1)).alias("before"))
        .filter("before > 0")
    )
    per = per.withColumn("growth", (F.col("now") - F.col("before")) / F.col("before") * 100).filter(F.col("growth") > percent)
    return per.agg(
        n_rows().alias("spike_entity_count"), F.max("warehouse_name").alias("sample_warehouse"),
        F.max("project").alias("sample_project"), F.round(F.max("growth"), 2).alias("max_growth_rate_pct"),
    )


def success_rate(runs: DataFrame, today: Column, least: float = 99) -> DataFrame:
    s = (
        runs.filter(F.col("period_start_time") >= F.date_sub(today, 7))
        .agg(n_rows().alias("total"), F.count_if(F.col("result_state") == "SUCCESS").alias("good"))
        .withColumn("rate", share(F.col("good"), F.col("total")))
    )
    return (
        s.filter(F.col("rate") < least)
        .agg(n_rows().alias("breach_flag"), F.max("total").alias("total_runs"), F.round(F.max("rate"), 2).alias("success_rate_pct"))
    )


def freshness(lineage: DataFrame, target: str, now: Column, most: int = 15) -> DataFrame:
    last = lineage.filter(F.col("target_table_full_name") == target).agg(F.max("event_time").alias("last")).withColumn("late", minutes("last", now))
    return (
        last.filter(F.col("late") > most)
        .agg(
            n_rows().alias("freshness_breach_flag"), F.max("last").alias("last_update_time"),
            F.round(F.max(F.col("late") / 60), 2).alias("freshness_delay_hours"),
        )
    )


def quarantine_rate(summary: DataFrame, percent: float = 1) -> DataFrame:
    s = summary.select("quarantine_count", "total_count").distinct().withColumn("rate", share(F.col("quarantine_count"), F.col("total_count")))
    return (
        s.filter(F.col("rate") > percent)
        .agg(
            n_rows().alias("breach_flag"), F.max("quarantine_count").alias("quarantine_count"),
            F.max("total_count").alias("total_count"), F.round(F.max("rate"), 2).alias("failure_rate_pct"),
        )
    )


def flapping(tasks: DataFrame, now: Column, attempts: int = 3, seconds: int = 60) -> DataFrame:
    w = Window.partitionBy("job_id", "task_key").orderBy("period_start_time")
    gaps = (
        tasks.filter(since("period_start_time", now, "1 DAY"))
        .withColumn("gap", F.timestamp_diff("SECOND", F.lag("period_start_time").over(w), F.col("period_start_time")))
    )
    per = (
        gaps.groupBy("job_id", "task_key")
        .agg(n_rows().alias("attempts"), F.min("gap").alias("gap"))
        .filter((F.col("attempts") > attempts) & (F.col("gap") < seconds))
    )
    return per.agg(
        n_rows().alias("flapping_task_count"), F.max("job_id").alias("sample_job_id"), F.max("task_key").alias("sample_task_key"),
        F.min("gap").alias("min_interval_sec"),
    )


# ---- dashboards --------------------------------------------------------------------------------


def query_health(history: DataFrame, now: Column) -> DataFrame:
    recent = history.filter(F.col("start_time") >= now - F.expr("INTERVAL 1 DAY"))
    middle = exact_quantile(recent, ["executed_by"], "total_duration_ms", 0.5, "median").withColumnRenamed("executed_by", "_by")
    out = recent.groupBy("executed_by").agg(
        F.round(F.avg("total_duration_ms") / 1000, 2).alias("avg_sec"), F.round(F.sum("read_bytes") / F.pow(F.lit(1024.0), F.lit(3.0)), 3).alias("gb_scanned"),
        F.count_if(F.col("execution_status") == "FAILED").alias("failed_count"), n_rows().alias("query_count"),
    )
    out = out.join(middle, F.col("executed_by").eqNullSafe(F.col("_by")), "left")
    out = out.select("executed_by", "avg_sec", F.round(F.col("median") / 1000, 2).alias("median_sec"), "gb_scanned", "failed_count", "query_count")
    return out.orderBy(F.col("avg_sec").desc(), "executed_by")


def cost_by_project(usage: DataFrame, today: Column) -> DataFrame:
    return (
        usage.filter(F.col("usage_date") >= F.date_sub(today, 30))
        .groupBy(F.try_element_at("custom_tags", F.lit("project")).alias("project_name"))
        .agg(F.round(F.sum("usage_quantity"), 2).alias("total_usage"))
        .orderBy(F.col("total_usage").desc())
    )


def time_by_user(history: DataFrame, today: Column) -> DataFrame:
    return (
        history.filter(F.col("start_time") >= F.date_sub(today, 7))
        .groupBy("executed_by")
        .agg(F.sum("total_duration_ms").alias("total_ms"))
        .orderBy(F.col("total_ms").desc(), "executed_by")
    )


def cost_by_warehouse(usage: DataFrame, warehouses: DataFrame, today: Column) -> DataFrame:
    u = usage.filter(F.col("usage_date") >= F.date_sub(today, 7)).select("usage_quantity", F.col("usage_metadata.warehouse_id").alias("warehouse_id"))
    return (
        u.join(warehouses, "warehouse_id", "left")
        .groupBy("warehouse_name", "auto_stop_minutes")
        .agg(F.round(F.sum("usage_quantity"), 2).alias("total_usage_7d"))
        .orderBy(F.col("total_usage_7d").desc())
    )


def cost_by_hour(usage: DataFrame, today: Column) -> DataFrame:
    return (
        usage.filter(F.col("usage_date") >= F.date_sub(today, 28))
        .groupBy(F.hour("usage_start_time").alias("hour"), F.dayofweek("usage_date").alias("dow"))
        .agg(F.round(F.sum("usage_quantity"), 2).alias("total_usage"))
        .orderBy("dow", "hour")
    )


def sla(runs: DataFrame, most: int = 15) -> DataFrame:
    met = F.sum(F.when(minutes("period_start_time", "period_end_time") <= most, 1).otherwise(0))
    return (
        runs.groupBy(F.date_trunc("day", "period_start_time").alias("run_date"))
        .agg(n_rows().alias("total_runs"), met.alias("sla_met"))
        .withColumn("sla_met_pct", F.round(share(F.col("sla_met"), F.col("total_runs")), 2))
        .orderBy(F.col("run_date").desc())
    )


def error_categories(*logs: DataFrame) -> DataFrame:
    rows = logs[0]
    for x in logs[1:]:
        rows = rows.unionAll(x)
    has = lambda s: F.col("message").contains(s)
    kind = F.when(has("RESOURCE_EXHAUSTED"), "capacity").when(has("permission"), "governance").when(has("Schema"), "data").otherwise("other")
    return (
        rows.filter("level = 'ERROR'")
        .groupBy(F.col("origin.pipeline_name").alias("pipeline_name"), kind.alias("error_category"))
        .agg(n_rows().alias("occurrences"))
        .orderBy(F.col("occurrences").desc())
    )


def recovery(runs: DataFrame) -> DataFrame:
    """Minutes from a failed run's end to the start of the run right after it, if that succeeded."""
    w = Window.partitionBy("job_id").orderBy("period_start_time", "run_id")
    after = runs.withColumn("state", F.lead("result_state").over(w)).withColumn("start", F.lead("period_start_time").over(w))
    return (
        after.filter("result_state = 'FAILED' AND state = 'SUCCESS'")
        .groupBy("job_id")
        .agg(F.round(F.avg(minutes("period_end_time", "start")), 2).alias("avg_mttr_minutes"))
    )


def new_readers(history: DataFrame, today: Column) -> DataFrame:
    """Reads of customer tables by users without a query in the 90 days before yesterday; a null user there hides all."""
    known = history.filter(F.col("start_time").between(F.date_sub(today, 90), F.date_sub(today, 1))).select(F.col("executed_by").alias("_u")).distinct()
    reads = history.filter((F.col("statement_type") == "SELECT") & F.lower("statement_text").like("%customer%"))
    # as NOT IN: a null user among the known hides all, and a null reader is new only if nobody is known; both are one row
    about = known.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_u").isNull()).alias("_nulls"))
    open_ = reads.crossJoin(F.broadcast(about)).filter((F.col("_nulls") == 0) & (F.col("executed_by").isNotNull() | (F.col("_n") == 0))).drop("_n", "_nulls")
    return open_.join(known, F.col("executed_by") == F.col("_u"), "left_anti").orderBy(F.col("start_time").desc())


def mutations(history: DataFrame) -> DataFrame:
    return history.filter(F.col("statement_type").isin("DELETE", "UPDATE", "DROP", "ALTER")).orderBy(F.col("start_time").desc())


def coverage(tables: DataFrame) -> DataFrame:
    rate = lambda c: F.round(share(F.count(c), n_rows()), 2)
    return (
        tables.filter("table_schema <> 'information_schema'")
        .agg(rate("comment").alias("comment_rate_pct"), rate("table_owner").alias("owner_rate_pct"), n_rows().alias("total_tables"))
    )


def unused_tables(tables: DataFrame, lineage: DataFrame, today: Column, days: int = 90) -> DataFrame:
    last = lineage.groupBy("target_table_full_name").agg(F.max("event_time").alias("last_access"))
    out = tables.join(last, F.concat_ws(".", "table_catalog", "table_schema", "table_name") == F.col("target_table_full_name"), "left")
    return out.filter((F.col("last_access") < F.date_sub(today, days)) | F.col("last_access").isNull()).select("table_schema", "table_name", "last_access")


def fan_out(lineage: DataFrame) -> DataFrame:
    return (
        lineage.groupBy("source_table_full_name")
        .agg(F.count_distinct("target_table_full_name").alias("downstream_count"))
        .orderBy(F.col("downstream_count").desc(), "source_table_full_name")
    )


# ---- investigations ----------------------------------------------------------------------------


def failures(log: DataFrame) -> DataFrame:
    return (
        log.filter("level = 'ERROR'")
        .select("timestamp", "event_type", "message", F.col("origin.flow_name").alias("flow_name"))
        .orderBy(F.col("timestamp").desc())
    )


def update_events(log: DataFrame, update_id: str) -> DataFrame:
    return log.filter(F.col("origin.update_id") == update_id).groupBy("event_type", "level").agg(n_rows().alias("event_count"))


def slow_flows(log: DataFrame) -> DataFrame:
    rows = F.get_json_object("details", "$.flow_progress.metrics.num_output_rows").try_cast("bigint")
    return (
        log.filter("event_type = 'flow_progress'")
        .groupBy(F.col("origin.flow_name").alias("flow_name"))
        .agg(F.round(F.avg("duration_ms") / 1000, 2).alias("avg_sec"), F.round(F.avg(rows), 4).alias("avg_output_rows"))
        .orderBy(F.col("avg_sec").desc())
    )


def errors_by_day(log: DataFrame, descending: bool = True) -> DataFrame:
    day = F.col("run_date").desc() if descending else F.col("run_date")
    return log.filter("level = 'ERROR'").groupBy(F.to_date("timestamp").alias("run_date")).agg(n_rows().alias("error_count")).orderBy(day)


def deploys(audit: DataFrame, email: str) -> DataFrame:
    return audit.filter(F.col("user_identity.email") == email).select("event_time", "service_name", "action_name").orderBy(F.col("event_time").desc())
