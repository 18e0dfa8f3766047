"""Deciding, correcting and requeueing quarantined orders, without a driver-side loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is done about each rule. A row is corrected only if all its rules can be.
CORRECTABLE = {"positive_amount": "sign of amount reversed", "order_date_not_future": "order_date set to the run date"}
UNCORRECTABLE = {
    "customer_id_not_null": "customer id is missing; ask the source system",
    "valid_currency": "currency code is invalid; ask the source system",
    "order_id_not_null": "order id is missing; ask the source system",
}
REQUEUED_FIELDS = (
    "order_id", "customer_id", "order_date", "amount", "currency", "status", "region", "unit_price", "discount_rate", "source_system", "ingestion_batch", "payment_card_last4", "payment_card_hash",
)


def resolution(violated: str = "violated_rules") -> Column:
    """CORRECTED or UNCORRECTABLE; an unknown rule, or an amount that isn't there to be reversed, can't be corrected."""
    can = F.forall(violated, lambda r: r.isin(*CORRECTABLE)) & ~(F.array_contains(violated, "positive_amount") & F.col("amount").isNull())
    return F.when(can, F.lit("CORRECTED")).otherwise(F.lit("UNCORRECTABLE"))


def note(violated: str = "violated_rules", status: str = "resolution_status") -> Column:
    """What was done, or what can't be."""
    text = lambda notes, r: F.element_at(F.create_map(*[F.lit(x) for p in notes.items() for x in p]), r)
    done = F.array_join(F.transform(F.filter(violated, lambda r: r.isin(*CORRECTABLE)), lambda r: text(CORRECTABLE, r)), "; ")
    open_ = F.transform(F.filter(violated, lambda r: r.isin(*UNCORRECTABLE)), lambda r: text(UNCORRECTABLE, r))
    unknown = F.concat(F.lit("no correction known for: "), F.array_join(violated, ", "))
    return F.when(F.col(status) == "CORRECTED", done).when(F.size(open_) > 0, F.array_join(open_, "; ")).otherwise(unknown)


def decided(quarantine: DataFrame) -> DataFrame:
    return quarantine.withColumn("resolution_status", resolution()).withColumn("correction_note", note())


def corrected(decisions: DataFrame, today: Column) -> DataFrame:
    """Rows that can be corrected, as they go back to ingestion."""
    out = decisions.filter("resolution_status = 'CORRECTED'")
    out = out.withColumn("amount", F.when(F.array_contains("violated_rules", "positive_amount"), F.abs("amount")).otherwise(F.col("amount")))
    out = out.withColumn("order_date", F.when(F.array_contains("violated_rules", "order_date_not_future"), today).otherwise(F.col("order_date")))
    have = [f for f in REQUEUED_FIELDS if f in out.columns]
    return out.select(*have, F.lit(True).alias("reprocessed_from_quarantine"))


def attempts(log: DataFrame) -> DataFrame:
    """_id, _tries, _last: how often each id was decided on, and when last."""
    last = F.max("resolved_at") if "resolved_at" in log.columns else F.lit(None).cast("timestamp")
    tries = F.max("reprocess_count") if "reprocess_count" in log.columns else F.lit(1)
    return log.groupBy(F.col("order_id").alias("_id")).agg(tries.alias("_tries"), last.alias("_last"))


def pending(quarantine: DataFrame, log: DataFrame) -> DataFrame:
    """Quarantined rows that the log doesn't have; null ids are matched as a value. A row that came to quarantine after
    the last decision on its id, as a requeued one that failed again does, is pending once more."""
    return _tried(quarantine, log).drop("_tries")


def _tried(quarantine: DataFrame, log: DataFrame) -> DataFrame:
    known = attempts(log)
    new = F.col("_tries").isNull()
    if "quarantined_at" in quarantine.columns:
        new = new | (F.col("quarantined_at") > F.col("_last"))
    return quarantine.join(known, F.col("order_id").eqNullSafe(F.col("_id")), "left").filter(new).drop("_id", "_last")


#: Parts in which rows without an id are numbered, as there may be very many of them.
PARTS = 64


def numbered(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """df with _number, from 1 within each key. Rows without a key are numbered in parts, so no task gets all of them."""
    part = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))).otherwise(F.lit(0))
    here = df.withColumn("_part", part)
    sizes = here.filter(F.col(key).isNull()).groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # PARTS rows at most
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order))
    out = here.withColumn("_number", own).join(F.broadcast(before.withColumnRenamed("_part", "_p")), F.col(key).isNull() & (F.col("_part") == F.col("_p")), "left")
    return out.withColumn("_number", F.col("_number") + F.coalesce("_before", F.lit(0))).drop("_part", "_p", "_before")


def reprocess(quarantine: DataFrame, log: DataFrame, today: Column, at: Column) -> tuple[DataFrame, DataFrame]:
    """(requeue, log rows). Write the requeue first: a log without it would hide rows that never went back. A log row is
    known by order_id and reprocess_count, the number of the attempt; rows of one id in one run get one number each, the
    first quarantined first."""
    rows = decided(_tried(quarantine, log))
    came = ["quarantined_at"] if "quarantined_at" in rows.columns else []
    counted = numbered(rows, "order_id", *came, F.xxhash64(*rows.columns))
    attempt = (F.coalesce("_tries", F.lit(0)) + F.col("_number")).cast("int").alias("reprocess_count")
    entries = counted.select("order_id", "violated_rules", "resolution_status", "correction_note", at.alias("resolved_at"), attempt)
    return corrected(rows, today), entries


def resolution_report(quarantine: DataFrame, log: DataFrame) -> DataFrame:
    """Each quarantined row once, with what was decided on it first after it came, the last quarantined first. A run's
    decisions on one id are told apart by their rules, and by the status that the row's own values lead to; decisions
    that agree in that say the same. Where rows don't tell when they came, the last decision counts. A row that no run
    has looked at yet has nulls."""
    same = F.array_sort("violated_rules")
    runs = log.groupBy(F.col("order_id").alias("_id")).agg(F.array_sort(F.collect_set("resolved_at")).alias("_runs"))  # a time a run
    said = log.groupBy(F.col("order_id").alias("_id"), F.col("resolved_at").alias("_at"), same.alias("_rules")).agg(
        F.map_from_entries(F.collect_set(F.struct("resolution_status", F.coalesce("correction_note", F.lit("")).alias("n")))).alias("_said"),
        F.min(F.struct("resolution_status", "correction_note")).alias("_one"),
    )
    came = F.col("quarantined_at") if "quarantined_at" in quarantine.columns else F.lit(None)
    rows = quarantine.join(runs, F.col("order_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    rows = rows.withColumn("_run", F.when(came.isNull(), F.element_at("_runs", -1)).otherwise(F.get(F.filter("_runs", lambda t: t >= came), F.lit(0))))
    out = rows.withColumn("_mine", same).join(said, F.col("order_id").eqNullSafe(F.col("_id")) & (F.col("_run") == F.col("_at")) & F.col("_mine").eqNullSafe(F.col("_rules")), "left")
    own = resolution() if "amount" in quarantine.columns else F.lit(None).cast("string")
    agreed = F.map_contains_key("_said", F.coalesce(own, F.lit("")))
    status = F.when(agreed, own).otherwise(F.col("_one.resolution_status"))
    note_ = F.when(agreed, F.nullif(F.col("_said")[own], F.lit(""))).otherwise(F.col("_one.correction_note"))
    out = out.select(*quarantine.columns, status.alias("resolution_status"), note_.alias("correction_note"), F.col("_at").alias("resolved_at"))
    return out.orderBy(F.col("quarantined_at" if "quarantined_at" in quarantine.columns else "resolved_at").desc())


def open_rows(quarantine: DataFrame, log: DataFrame) -> DataFrame:
    """Quarantined rows without a CORRECTED decision."""
    return pending(quarantine, log.filter("resolution_status = 'CORRECTED'"))
