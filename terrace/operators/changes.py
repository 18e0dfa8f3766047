"""What changed between two versions of a table, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _numbered(df: DataFrame, keys: list[str]) -> DataFrame:
    """One struct a row, with its keys and its place among the rows of the key, so that repeated keys pair up in order."""
    row = F.struct(*df.columns).alias("_row")
    hashed = F.sha2(F.to_json(F.struct(*df.columns)), 256).alias("_hash")
    own = df.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), row, hashed)
    return own.withColumn("_n", F.row_number().over(Window.partitionBy(*(f"_k{i}" for i in range(len(keys)))).orderBy("_hash")))


def between(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the change feed from one version to the next: the table's columns and _change_type, which is insert, delete,
    update_preimage or update_postimage. Versions meet by key in one join; rows that are the same in both are left out. A
    column that one version lacks is null there. Null keys are a key like any other."""
    names = [*new.columns, *(c for c in old.columns if c not in new.columns)]
    full = lambda df, other: df.select(*((F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType)).alias(c) for c in names))
    a, b = _numbered(full(old, new), keys), _numbered(full(new, old), keys)
    ids = [*(f"_k{i}" for i in range(len(keys))), "_n"]
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ids]
    met = a.alias("a").join(b.alias("b"), on, "full").filter(~F.col("a._hash").eqNullSafe(F.col("b._hash")))
    gone, came = F.col("b._hash").isNull(), F.col("a._hash").isNull()
    one = lambda side, kind: F.array(F.struct(F.col(f"{side}._row").alias("r"), F.lit(kind).alias("t")))
    both = F.concat(one("a", "update_preimage"), one("b", "update_postimage"))
    listed = met.select(F.inline(F.when(gone, one("a", "delete")).when(came, one("b", "insert")).otherwise(both)))
    return listed.select("r.*", F.col("t").alias("_change_type"))
