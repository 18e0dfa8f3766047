"""Named quality rules: warn, drop, fail, and a split that loses no row.

A rule passes only where its predicate is TRUE. With the null policy "strict", a predicate that is NULL counts as a
violation, so passing and quarantined rows add up to the input; "reference" leaves such rows on neither side unless
another rule is FALSE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RuleSet:
    def __init__(self, rules: dict[str, str], as_of: str | None = None, nulls: str = "strict"):
        """`as_of` stands in for current_date() in predicates."""
        self.rules = {k: v.replace("current_date()", f"DATE '{as_of}'") if as_of else v for k, v in rules.items()}
        self.nulls = nulls

    def names(self) -> list[str]:
        return list(self.rules)

    def ok(self, name: str) -> Column:
        return F.coalesce(F.expr(self.rules[name]), F.lit(False))

    def passes(self) -> Column:
        return reduce(lambda a, b: a & b, map(self.ok, self.rules), F.lit(True))

    def violated(self) -> Column:
        """Names of the violated rules, in rule order."""
        bad = (lambda n: ~self.ok(n)) if self.nulls == "strict" else (lambda n: F.coalesce(~F.expr(self.rules[n]), F.lit(False)))
        return F.filter(F.array(*(F.when(bad(n), F.lit(n)) for n in self.rules)), lambda x: x.isNotNull())


def classify(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Adds violated_rules, which both sides of the split are taken from."""
    return df.withColumn("violated_rules", rules.violated())


def valid(df: DataFrame, rules: RuleSet) -> DataFrame:
    return df.filter(rules.passes())


def quarantined(df: DataFrame, rules: RuleSet, at: Column | None = None) -> DataFrame:
    """Violating rows with their rules, when they were quarantined, and the status PENDING."""
    out = classify(df, rules).filter(F.size("violated_rules") > 0)
    return (
        out.withColumn("quarantined_at", at if at is not None else F.current_timestamp())
        .withColumn("resolution_status_at_quarantine_time", F.lit("PENDING"))
    )


def warn(df: DataFrame, rules: RuleSet, observation: Observation) -> DataFrame:
    """All rows; violations are counted by rule as the plan runs."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *(F.count_if(~rules.ok(n)).alias(n) for n in rules.rules))


def drop(df: DataFrame, rules: RuleSet) -> DataFrame:
    return df.filter(rules.passes())


def fail(df: DataFrame, rules: RuleSet) -> DataFrame:
    """All rows, or an error. The guard is a filter, which no pruning of columns removes."""
    for name in rules.rules:
        df = df.filter(F.when(rules.ok(name), F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation failed: {name}")).cast("boolean")))
    return df


# Rule sets of the pipelines.
ORDER_RULES = {
    "order_id_not_null": "order_id IS NOT NULL",
    "customer_id_not_null": "customer_id IS NOT NULL",
    "positive_amount": "amount IS NOT NULL AND amount > 0",
    "order_date_not_future": "order_date <= current_date()",
    "valid_currency": "currency IN ('JPY', 'USD')",
}
CUSTOMER_RULES = {
    "customer_id_not_null": "customer_id IS NOT NULL",
    "valid_operation": "operation IN ('INSERT', 'UPDATE', 'DELETE')",
    "updated_at_not_null": "updated_at IS NOT NULL",
    "valid_email_format": r"email IS NOT NULL AND email RLIKE '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'",
}
ORDER_GATE_RULES = {"no_duplicate_order_id": "dup_count = 1", "amount_still_positive": "amount > 0", "customer_id_still_present": "customer_id IS NOT NULL"}
BRONZE_ORDER_WARN_RULES = {"order_id_present": "order_id IS NOT NULL", "amount_present": "amount IS NOT NULL"}
BRONZE_CUSTOMER_WARN_RULES = {"customer_id_present": "customer_id IS NOT NULL", "email_looks_like_email": "email IS NULL OR email RLIKE '.+@.+'"}
CHUNK_DROP_RULES = {"chunk_text_not_empty": "chunk_text IS NOT NULL AND length(chunk_text) > 0"}
CHUNK_FAIL_RULES = {"chunk_key_complete": "doc_path IS NOT NULL AND chunk_method IS NOT NULL AND chunk_index IS NOT NULL"}
