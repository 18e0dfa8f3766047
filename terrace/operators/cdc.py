"""Applying change events: history of versions (type 2) and latest state (type 1).

Events may come late and in any order; what counts is their sequence within a key. Of events with equal key and
sequence a delete wins, then the row with the highest hash, so results don't depend on arrival. Events without key or
sequence are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ordered(events: DataFrame, keys: list[str], sequence: str, deletes: str) -> DataFrame:
    """Winning events with _next, the sequence of the event after each. One window, so one exchange by key."""
    known = events.filter(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in [*keys, sequence])))
    marked = known.withColumn("_delete", F.coalesce(F.expr(deletes), F.lit(False))).withColumn("_hash", F.xxhash64(*events.columns))
    w = Window.partitionBy(*keys).orderBy(F.col(sequence), F.col("_delete"), F.col("_hash"))
    return marked.withColumn("_next", F.lead(sequence).over(w)).filter(F.col("_next").isNull() | (F.col("_next") != F.col(sequence)))


def scd2(events: DataFrame, keys: list[str], sequence: str, deletes: str) -> DataFrame:
    """One version for each event that isn't a delete, valid from its sequence to the next event's."""
    out = _ordered(events, keys, sequence, deletes).filter("NOT _delete")
    return out.select(*events.columns, F.col(sequence).alias("__START_AT"), F.col("_next").alias("__END_AT"))


def winners(events: DataFrame, keys: list[str], sequence: str, deletes: str) -> DataFrame:
    """scd2 with the deletes kept, marked by __DELETED: what later events of the same keys need to be placed among."""
    return _ordered(events, keys, sequence, deletes).select(*events.columns, F.col(sequence).alias("__START_AT"), F.col("_next").alias("__END_AT"), F.col("_delete").alias("__DELETED"))


def scd1(events: DataFrame, keys: list[str], sequence: str, deletes: str) -> DataFrame:
    """The latest event of each key, unless it is a delete."""
    return _ordered(events, keys, sequence, deletes).filter("_next IS NULL AND NOT _delete").select(*events.columns)


def rebuild(existing: DataFrame, events: DataFrame, changed: DataFrame, keys: list[str], sequence: str, deletes: str) -> DataFrame:
    """History after a batch: only the keys in `changed` are made anew from all events, the rest is carried over.

    `events` holds all events so far, deletes included, so an event older than a known delete can't become current."""
    touched = changed.select(*keys).distinct()
    anew = scd2(events.join(touched, keys, "left_semi"), keys, sequence, deletes)
    return existing.join(touched, keys, "left_anti").unionByName(anew)
