"""Pseudonyms, masks and generalisations of personal data. All are native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALT_CONF = "terrace.pii.salt"


def salt(spark: SparkSession) -> str:
    """The hash salt of the session; it has no default, so data are never hashed without one."""
    value = spark.conf.get(SALT_CONF, None)
    if not value:
        raise ValueError(f"set {SALT_CONF}")
    return value


def hashed(value: Column | str, salt: str) -> Column:
    """SHA-256 of value and salt in hex; null stays null."""
    return F.sha2(F.concat(F.col(value) if isinstance(value, str) else value, F.lit(salt)), 256)


#: Runs of digits as long as a card number.
CARD = r"\d(?:[ -]?\d){11,18}"


def tokenized_card(df: DataFrame, salt: str, number: str = "payment_card_number") -> DataFrame:
    """Replace a raw card number by its last four digits and a salted hash; rows without one keep tokens they bring."""
    have = lambda n: F.col(n) if n in df.columns else F.lit(None).cast("string")
    raw = F.col(number).cast("string") if number in df.columns else F.lit(None).cast("string")
    rest = F.from_json("_rescued_data", "map<string,string>") if "_rescued_data" in df.columns else None
    if rest is not None:  # a number of another type than the column's was rescued
        raw = F.coalesce(raw, rest[number])
    out = df.withColumns({"payment_card_last4": F.coalesce(F.substring(raw, -4, 4), have("payment_card_last4")), "payment_card_hash": F.coalesce(hashed(raw, salt), have("payment_card_hash"))})
    if rest is not None:
        kept = F.transform_values(F.map_filter(rest, lambda k, v: k != number), lambda k, v: F.regexp_replace(v, CARD, "****"))
        out = out.withColumn("_rescued_data", F.when(F.size(kept) > 0, F.to_json(kept)))
    return out.drop(number)


def masked_phone(phone: Column | str) -> Column:
    """aaa-****-cccc for three dash-separated parts, else ****."""
    parts = F.split(phone, "-")
    return F.when(F.size(parts) == 3, F.concat_ws("-", parts[0], F.lit("****"), parts[2])).otherwise(F.lit("****"))


def birth_year(birth_date: Column | str) -> Column:
    return F.substring(birth_date, 1, 4)
