"""Licence scan by canonical digest lookup.

A text is put in canonical form: A-Z in lower case, copyright lines dropped, equivalent spellings made one, everything
but letters and digits turned into single spaces. The SHA-256 of the whole canonical text is hash-joined with the
digests of known licences, which go through the same form. A document matches only as a whole.

Nulls: a null text has no digest and no licence; an empty canonical form has a digest but no licence. Ids may be null
or repeat, and there are no ties: each row is judged alone. Very long texts are put in canonical form whole. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .licence_texts import LICENCES

#: Equivalent spellings: (pattern without groups, replacement), in the order applied, over text in lower case.
SPELLINGS = (
    ("licenc", "licens"), ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"), ("favour", "favor"), ("honour", "honor"), ("organisation", "organization"),
    ("noninfringement", "non infringement"), ("sub license", "sublicense"), ("judgement", "judgment"), ("whilst", "while"), ("copyright holder", "copyright owner"), ("https://", "http://"),
)
#: A line that names a copyright and nothing else; \n stands before each line.
COPYRIGHT = r"\n[ \t*#/;-]*(copyright[ \t]*(\(c\)|©|[0-9]|by )|\(c\)[ \t]*[0-9a-z]|©|all rights reserved)[^\n]*"
#: Up to so many licences (some 100 bytes each) the digests are broadcast; beyond it both sides are shuffled by digest.
BROADCAST_ROWS = 50_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def canonical(text: Column) -> Column:
    t = F.regexp_replace(F.concat(F.lit("\n"), c.ascii_lower(text)), COPYRIGHT, "")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, NOT_WORD, " "))


def known(spark: SparkSession, licences: dict[str, str] | DataFrame = LICENCES) -> tuple[DataFrame, int]:
    """(digest, license), the least name of those with one canonical form, and how many licences there are. `licences` is a
    table of license and text, or a mapping."""
    if isinstance(licences, dict):
        rows, n = spark.createDataFrame(list(licences.items()), "license string, text string"), len(licences)
    else:
        rows, n = licences.select("license", "text"), licences.count()
    rows = rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license")
    return rows.filter("digest is not null").groupBy("digest").agg(F.min("license").alias("license")), n


def scan(spark: SparkSession, docs: DataFrame, licences: dict[str, str] | DataFrame = LICENCES) -> DataFrame:
    """doc_id, canonical_chars, digest, license of each row."""
    form = canonical(F.col("text"))
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), form.alias("_form"))
        .select("doc_id", F.length("_form").cast("long").alias("canonical_chars"), F.sha2("_form", 256).alias("digest"))
    )
    digests, n = known(spark, licences)
    if n <= BROADCAST_ROWS:
        digests = F.broadcast(digests)
    return texts.join(digests, "digest", "left").select("doc_id", "canonical_chars", "digest", "license")


def planted(spark: SparkSession, licences: dict[str, str] = LICENCES) -> DataFrame:
    """doc_id, text: copies of each licence as they are found in the wild, with ids below zero: in capitals, in comment lines,
    below copyright lines, with other punctuation; and one with a word more, which is no copy."""
    known_ = spark.createDataFrame([(-10 * i, t) for i, t in enumerate(licences.values(), 1)], "n long, t string")
    t = F.col("t")
    lines = F.array_join(F.transform(F.split(t, "\n"), lambda x: F.concat(F.lit(" * "), x)), "\n")
    forms = [
        F.upper(t), lines, F.concat(F.lit("Copyright (c) 2020 Some Body\nAll rights reserved\n\n"), t),
        F.regexp_replace(t, "[,;]", " - "), F.concat(t, F.lit(" and more")),
    ]
    return known_.select(F.posexplode(F.array(*forms)).alias("i", "text"), "n").select((F.col("n") + F.col("i")).alias("doc_id"), "text")


def op5b_planted_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the documents and planted copies match, by licence."""
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(planted(spark))
    return scan(spark, docs).groupBy("license").agg(F.count("*").alias("n"), F.sum((F.col("doc_id") < 0).cast("int")).alias("n_planted"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, c.table(spark, sf_dir, "documents"))


def _sql() -> str:
    def form(x: str) -> str:
        t = f"regexp_replace(chr(10) || translate({x}, '{c.UPPER}', '{c.UPPER.lower()}'), '{COPYRIGHT}', '', 'g')"
        for a, b in SPELLINGS:
            t = f"replace({t}, '{a}', '{b}')"
        return f"trim(regexp_replace({t}, '{NOT_WORD}', ' ', 'g'))"

    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in LICENCES.items())
    return f"""
WITH k AS (SELECT sha256({form("t")}) AS digest, min(n) AS license FROM (VALUES {rows}) AS v(n, t) GROUP BY 1),
d AS (SELECT doc_id, {form("text")} AS f FROM documents)
SELECT doc_id, CAST(length(f) AS BIGINT) AS canonical_chars, sha256(f) AS digest, license FROM d LEFT JOIN k ON k.digest = sha256(f)
"""


SQL = _sql()
#: Each licence has four planted copies, and one text that isn't a copy.
PLANTED_SQL = f"""SELECT license, CAST(count(*) AS BIGINT) + any_value(p) AS n, any_value(p) AS n_planted FROM (SELECT license, CASE WHEN license IS NULL THEN {len(LICENCES)} ELSE 4 END::BIGINT AS p FROM ({SQL})) GROUP BY license
UNION ALL SELECT l, 4, 4 FROM (VALUES {", ".join(f"('{k}')" for k in LICENCES)}) v(l) WHERE l NOT IN (SELECT license FROM ({SQL}) WHERE license IS NOT NULL)"""
