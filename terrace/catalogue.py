"""All queries of the library and their SQL. Times come out as text, so both engines agree on their type."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.functions import pii
from terrace.functions.columns import col_or_null, document_attributes
from terrace.operators import cdc, documents, gold, governance, quarantine, rules, vector
from terrace.operators.quantiles import exact_quantile
from terrace.plans import monitoring as m
from terrace.plans.graph import Pipeline
from terrace.sources import files
from terrace.sources import testdata as t
from terrace.sources.scratch import workspace
from terrace.streaming import flows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ORDER_RULES = rules.RuleSet(rules.ORDER_RULES, as_of=t.ORDERS_AS_OF)
NOW, TODAY = f"TIMESTAMP '{t.NOW}'", f"DATE '{t.TODAY}'"
STAMP = "%Y-%m-%d %H:%M:%S"


def query(select: str, *names: str):
    """Register the function under its name, with its SQL over the named inputs."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = t.sql(select, *names) if names else select
        return f

    return add


def half_up(x: str, n: int) -> str:
    """SQL that rounds a double as Spark does: its decimal digits, half away from zero."""
    return f"CAST(round(CAST({x} AS DECIMAL(30, 8)), {n}) AS DOUBLE)"


def text(df: DataFrame) -> DataFrame:
    """Dates and times as text."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c, k in kinds.items() if k.startswith("timestamp")} | {c: F.col(c).cast("string") for c, k in kinds.items() if k == "date"})


def orders(spark: SparkSession, d: str) -> DataFrame:
    return t.bronze_orders(spark, d).drop("payment_card_number")


def good(spark: SparkSession, d: str) -> DataFrame:
    return rules.valid(orders(spark, d), ORDER_RULES)


def bad(spark: SparkSession, d: str) -> DataFrame:
    return rules.classify(orders(spark, d), ORDER_RULES).filter(F.size("violated_rules") > 0)


COLS = "order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, amount, currency, status, region, unit_price, discount_rate"
RULES_TEXT = "array_to_string(violated_rules, ',') AS violated_rules"

# ---- quality gate ------------------------------------------------------------------------------


@query(f"SELECT {COLS} FROM good", "good")
def silver_orders_valid(spark, d):
    return text(good(spark, d))


@query(f"SELECT {COLS}, {RULES_TEXT}, 'PENDING' AS resolution_status_at_quarantine_time FROM bad", "bad")
def silver_orders_quarantine(spark, d):
    return text(rules.quarantined(orders(spark, d), ORDER_RULES).drop("quarantined_at").withColumn("violated_rules", F.array_join("violated_rules", ",")))


@query("SELECT violated_rule, CAST(count(*) AS BIGINT) AS violation_count FROM (SELECT unnest(violated_rules) AS violated_rule FROM bad) GROUP BY 1", "bad")
def rule_violation_counts(spark, d):
    return gold.violation_counts(bad(spark, d))


SUMMARY = """SELECT violated_rule, violation_count, valid_count, quarantine_count, valid_count + quarantine_count AS total_count, round(valid_count / (valid_count + quarantine_count) * 100, 2) AS pass_rate_pct
FROM (SELECT violated_rule, count(*) AS violation_count FROM (SELECT unnest(violated_rules) AS violated_rule FROM bad) GROUP BY 1), (SELECT count(*) AS valid_count FROM good), (SELECT count(*) AS quarantine_count FROM bad)"""


@query(SUMMARY, "good", "bad")
def quality_summary(spark, d):
    return gold.quality_summary(rules.classify(orders(spark, d), ORDER_RULES), ORDER_RULES.names())


@query(
    "SELECT count(*) AS n_rows, count(*) FILTER (order_id IS NULL) AS order_id_present, "
    "count(*) FILTER (amount IS NULL) AS amount_present FROM bronze_orders",
    "bronze_orders",
)
def bronze_warn_metrics(spark, d):
    seen = Observation(f"warn-{uuid.uuid4().hex[:8]}")
    rules.warn(orders(spark, d), rules.RuleSet(rules.BRONZE_ORDER_WARN_RULES), seen).write.format("noop").mode("overwrite").save()
    got = seen.get
    return spark.createDataFrame([(got["rows"], got["order_id_present"], got["amount_present"])], "n_rows long, order_id_present long, amount_present long")


@query(
    "SELECT CAST(order_date AS VARCHAR) AS order_date, region, status, count(order_id) AS order_count, round(sum(amount), "
    f"2) AS total_amount, {half_up('sum(CAST(amount AS DECIMAL(18, 4))) / count(amount)', 2)} AS avg_amount, round(avg(discount_rate), "
    "4) AS avg_discount_rate FROM good GROUP BY order_date, region, status",
    "good",
)
def daily_sales_by_region(spark, d):
    return text(gold.daily_sales(good(spark, d)).withColumn("total_amount", F.round("total_amount", 2)))


def history(spark, d):
    return cdc.scd2(t.customers_cdc(spark, d), ["customer_id"], "updated_at", "operation = 'DELETE'")


@query("""SELECT c.customer_id, c.status, coalesce(order_count, 0) AS order_count, coalesce(total_spend, 0.0) AS total_spend, discount_rate, CAST(last_order_date AS VARCHAR) AS last_order_date FROM (SELECT * FROM scd2 WHERE __END_AT IS NULL) c
LEFT JOIN (SELECT customer_id, count(order_id) AS order_count, round(sum(amount), 2) AS total_spend, round(avg(discount_rate), 4) AS discount_rate, max(order_date) AS last_order_date FROM good GROUP BY 1) USING (customer_id)""", "scd2", "good")
def customer_summary(spark, d):
    return text(gold.customer_summary(history(spark, d), good(spark, d), ["status"]).withColumn("total_spend", F.round("total_spend", 2)))


LINES = "SELECT l_orderkey || '-' || l_linenumber AS order_id, CAST(l_suppkey AS VARCHAR) AS customer_id, l_extendedprice AS amount, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_count FROM lineitem"


def lines(spark, d):
    li = t.table(spark, d, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"), F.col("l_suppkey").cast("string").alias("customer_id"),
        F.col("l_extendedprice").alias("amount"),
    )


@query(LINES)
def order_quality_gate(spark, d):
    return gold.order_gate(lines(spark, d))


@query(
    "SELECT count(*) AS n_rows, count(*) FILTER (dup_count <> 1) AS no_duplicate_order_id, count(*) FILTER (NOT coalesce(amount > 0, "
    f"false)) AS amount_still_positive, count(*) FILTER (customer_id IS NULL) AS customer_id_still_present FROM ({LINES})",
)
def gate_violations(spark, d):
    gate = rules.RuleSet(rules.ORDER_GATE_RULES)
    return gold.order_gate(lines(spark, d)).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(~gate.ok(n)).alias(n) for n in gate.rules))


# ---- personal data -----------------------------------------------------------------------------


@query(
    "SELECT order_id, substring(payment_card_number, -4, 4) AS payment_card_last4, "
    f"sha256(payment_card_number || '{t.SALT}') AS payment_card_hash FROM bronze_orders",
    "bronze_orders",
)
def card_tokenize(spark, d):
    return pii.tokenized_card(t.bronze_orders(spark, d), t.SALT).select("order_id", "payment_card_last4", "payment_card_hash")


@query(f"""SELECT customer_id, sha256(email || '{t.SALT}') AS email_hash, CASE WHEN len(string_split(phone, '-')) = 3 THEN string_split(phone, '-')[1] || '-****-' || string_split(phone, '-')[3] ELSE '****' END AS phone_masked, substring(birth_date, 1, 4) AS birth_year, region AS address_region,
coalesce(email IS NOT NULL AND regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false) AS email_ok FROM people""", "people")
def pii_mask_customers(spark, d):
    valid_mail = F.coalesce(F.expr(rules.CUSTOMER_RULES["valid_email_format"]), F.lit(False))
    return (
        t.customers(spark, d)
        .select(
            "customer_id", pii.hashed("email", t.SALT).alias("email_hash"), pii.masked_phone("phone").alias("phone_masked"),
            pii.birth_year("birth_date").alias("birth_year"), F.col("region").alias("address_region"),
            valid_mail.alias("email_ok"),
        )
    )


# ---- change data -------------------------------------------------------------------------------

SCD = "SELECT customer_id, status, score, operation, updated_at, __START_AT, __END_AT FROM scd2"


@query(SCD, "scd2")
def scd2_history(spark, d):
    return history(spark, d)


@query(f"{SCD} WHERE __END_AT IS NULL", "scd2")
def scd2_current(spark, d):
    return history(spark, d).filter("__END_AT IS NULL")


@query(
    "SELECT customer_id, status, score, operation, updated_at FROM cdc QUALIFY row_number() OVER (PARTITION BY customer_id "
    "ORDER BY updated_at DESC) = 1 AND operation <> 'DELETE'",
    "cdc",
)
def scd1_current(spark, d):
    return cdc.scd1(t.customers_cdc(spark, d), ["customer_id"], "updated_at", "operation = 'DELETE'")


@query(SCD, "scd2")
def scd2_late_arrival(spark, d):
    """The later half of each customer's events comes first; history is rebuilt by key when the older half arrives."""
    e, key, seq, gone = t.customers_cdc(spark, d), ["customer_id"], "updated_at", "operation = 'DELETE'"
    late = e.filter(F.col("updated_at") < "2024-01-15")
    first = cdc.scd2(e.filter(F.col("updated_at") >= "2024-01-15"), key, seq, gone)
    return cdc.rebuild(first, e, late, key, seq, gone)


# ---- quarantine --------------------------------------------------------------------------------

CAN = "len(list_filter(violated_rules, lambda r: r NOT IN ('positive_amount', 'order_date_not_future'))) = 0 AND NOT (list_contains(violated_rules, 'positive_amount') AND amount IS NULL)"
NOTE = "CASE r WHEN 'positive_amount' THEN 'sign of amount reversed' WHEN 'order_date_not_future' THEN 'order_date set to the run date' END"
OPEN = "CASE r WHEN 'customer_id_not_null' THEN 'customer id is missing; ask the source system' WHEN 'valid_currency' THEN 'currency code is invalid; ask the source system' WHEN 'order_id_not_null' THEN 'order id is missing; ask the source system' END"
DECIDED = f"""SELECT *, CASE WHEN {CAN} THEN 'CORRECTED' ELSE 'UNCORRECTABLE' END AS resolution_status,
CASE WHEN {CAN} THEN array_to_string(list_transform(violated_rules, lambda r: {NOTE}), '; ')
WHEN len(list_filter(violated_rules, lambda r: r NOT IN ('positive_amount', 'order_date_not_future'))) > 0 THEN array_to_string(list_filter(list_transform(violated_rules, lambda r: {OPEN}), lambda x: x IS NOT NULL), '; ')
ELSE 'no correction known for: ' || array_to_string(violated_rules, ', ') END AS correction_note FROM bad"""


@query(f"SELECT order_id, {RULES_TEXT}, resolution_status, correction_note FROM ({DECIDED})", "bad")
def reprocess_decisions(spark, d):
    return (
        quarantine.decided(bad(spark, d))
        .select("order_id", F.array_join("violated_rules", ",").alias("violated_rules"), "resolution_status", "correction_note")
    )


@query(f"""SELECT order_id, customer_id, CAST(CASE WHEN list_contains(violated_rules, 'order_date_not_future') THEN DATE '{t.ORDERS_AS_OF}' ELSE order_date END AS VARCHAR) AS order_date, CASE WHEN list_contains(violated_rules, 'positive_amount') THEN abs(amount) ELSE amount END AS amount,
currency, status, region, unit_price, discount_rate, true AS reprocessed_from_quarantine FROM ({DECIDED}) WHERE resolution_status = 'CORRECTED'""", "bad")
def reprocess_corrected(spark, d):
    return text(quarantine.corrected(quarantine.decided(bad(spark, d)), F.lit(t.ORDERS_AS_OF).cast("date")))


@query(f"SELECT order_id, {RULES_TEXT}, CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN resolution_status END AS resolution_status FROM ({DECIDED})", "bad")
def quarantine_resolution_report(spark, d):
    q = bad(spark, d)
    log = quarantine.decided(q).filter(F.col("order_id").cast("long") % 2 == 0).withColumn("resolved_at", F.lit(t.NOW).cast("timestamp"))
    return quarantine.resolution_report(q, log).select("order_id", F.array_join("violated_rules", ",").alias("violated_rules"), "resolution_status")


@query(f"SELECT order_id, resolution_status, 1 AS reprocess_count FROM ({DECIDED}) WHERE CAST(order_id AS BIGINT) % 2 <> 0", "bad")
def reprocess_pending(spark, d):
    """Rows that an earlier run logged are left alone."""
    q = bad(spark, d)
    log = q.filter(F.col("order_id").cast("long") % 2 == 0).select("order_id")
    return quarantine.reprocess(q, log, F.lit(t.ORDERS_AS_OF).cast("date"), t.now())[1].select("order_id", "resolution_status", "reprocess_count")


# ---- documents ---------------------------------------------------------------------------------


def fixed(spark, d):
    return documents.search_chunks(documents.chunked(t.documents_silver(spark, d), documents.fixed_chunks("parsed_text"), "fixed_overlap"))


@query(
    "SELECT doc_path, regexp_extract(doc_path, '.*/raw_documents/([^/]+)/([^/]+)/[^/]+$', 1) AS department, regexp_extract(doc_path, "
    "'.*/raw_documents/([^/]+)/([^/]+)/[^/]+$', 2) AS classification, string_split(doc_path, '/')[-1] AS file_name, "
    "string_split(doc_path, '.')[-1] AS file_extension FROM silver",
    "silver",
)
def doc_path_attributes(spark, d):
    return t.documents_silver(spark, d).select("doc_path", *[v.alias(k) for k, v in document_attributes("doc_path").items()])


@query(
    "SELECT CASE WHEN lower(string_split(doc_path, '.')[-1]) IN ('txt', "
    "'md') THEN 'utf8_decode' ELSE 'ai_parse_document' END AS parse_method, count(*) AS n, "
    "CAST(sum(length(parsed_text)) AS BIGINT) AS n_chars FROM silver WHERE length(parsed_text) > 0 GROUP BY 1",
    "silver",
)
def parse_method_dispatch(spark, d):
    """Plain files are decoded; here the extractor of all others gives the decoded content's paragraphs as pages."""
    s = t.documents_silver(spark, d)
    files = s.select(
        F.col("doc_path").alias("path"), F.encode("parsed_text", "UTF-8").alias("content"),
        F.octet_length("parsed_text").cast("long").alias("length"), F.col("ingestion_time").alias("modificationTime"),
    )
    parsed = documents.parsed_documents(documents.bronze_documents(files, t.now()), lambda c: F.split(F.decode(c, "UTF-8"), "\n\n"))
    return parsed.groupBy("parse_method").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("parsed_text")).alias("n_chars"))


@query(
    r"""SELECT doc_id, CASE WHEN reason IS NULL THEN md5(array_to_string(list_transform(range(0, CAST(ceil(len(ls) / 40) AS BIGINT)), lambda i: array_to_string(ls[40 * i + 1:40 * i + 40], chr(10))), chr(10) || chr(10))) END AS digest, reason
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, text, CASE WHEN doc_id % 11 = 4 THEN 'unknown format' WHEN doc_id % 7 = 5 THEN 'no page' END AS reason FROM documents WHERE doc_id % 3 <> 0) WHERE reason IS NOT NULL OR length(text) > 0""",
)
def pdf_extraction(spark, d):
    """PDF files made of the documents' texts: their pages' text, or the reason why there is none."""
    bronze = documents.bronze_documents(t.pdf_files(spark, d), t.now()).filter("file_extension = 'pdf'")
    doc = F.regexp_extract("doc_path", "([0-9]+)", 1).cast("long").alias("doc_id")
    read = documents.parsed_documents(bronze, documents.pdf_pages).select(doc, F.md5("parsed_text").alias("digest"), F.lit(None).cast("string").alias("reason"))
    return read.unionByName(documents.unread_documents(bronze).select(doc, F.lit(None).cast("string").alias("digest"), "reason"))


@query("SELECT doc_path, CAST(chunk_index AS INTEGER) AS chunk_index, chunk_text, chunk_method FROM fixed", "fixed")
def fixed_overlap_chunks(spark, d):
    return (
        documents.chunked(t.documents_silver(spark, d), documents.fixed_chunks("parsed_text"), "fixed_overlap")
        .select("doc_path", "chunk_index", "chunk_text", "chunk_method")
    )


@query("SELECT chunk_id, doc_path, CAST(chunk_index AS INTEGER) AS chunk_index FROM chunks", "chunks")
def chunk_ids(spark, d):
    return fixed(spark, d).select("chunk_id", "doc_path", "chunk_index")


@query(
    "SELECT department, classification, count(DISTINCT doc_path) AS document_count, count(chunk_id) AS chunk_count, "
    "CAST(round(CAST(avg(chunk_length) AS DECIMAL(30, 8)), 1) AS DOUBLE) AS avg_chunk_length, strftime(max(ingestion_time), "
    "'%Y-%m-%d %H:%M:%S') AS last_ingested_at FROM chunks GROUP BY 1, 2",
    "chunks",
)
def chunk_metrics_by_department(spark, d):
    return text(documents.metrics_by_department(fixed(spark, d)))


@query(
    "SELECT chunk_method, count(DISTINCT doc_path) AS document_count, count(chunk_id) AS chunk_count, "
    "CAST(round(CAST(avg(chunk_length) AS DECIMAL(30, 8)), 1) AS DOUBLE) AS avg_chunk_length, round(stddev_samp(chunk_length), "
    "1) AS stddev_chunk_length FROM chunks GROUP BY 1",
    "chunks",
)
def chunk_metrics_by_method(spark, d):
    return documents.metrics_by_method(fixed(spark, d))


@query("SELECT count(*) AS chunks, count(DISTINCT chunk_id) AS ids FROM chunks", "chunks")
def chunk_id_uniqueness(spark, d):
    return fixed(spark, d).agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("chunk_id").alias("ids"))


@query(
    "SELECT chunk_id, strftime(ingestion_time, '%Y-%m-%d %H:%M:%S') AS ingestion_time FROM chunks "
    "ORDER BY chunks.ingestion_time DESC, chunk_id LIMIT 20",
    "chunks",
)
def newest_chunks(spark, d):
    return text(documents.newest_chunks(fixed(spark, d)).select("chunk_id", "ingestion_time"))


@query("SELECT chunk_method, department, classification, count(*) AS chunk_count FROM chunks GROUP BY ALL", "chunks")
def chunk_counts(spark, d):
    return documents.chunk_counts(fixed(spark, d))


#: The packing of paragraphs in SQL: a fold over a text in which a control character ends each chunk.
PACKED = """string_split(list_reduce(list_filter(regexp_split_to_array(parsed_text, '\\n\\s*\\n'), lambda p: length(trim(p, ' ')) > 0), lambda a, p:
CASE WHEN length(string_split(a, chr(1))[-1]) + length(p) + 2 <= 800 THEN a || chr(10) || chr(10) || p ELSE a || chr(1) || p END), chr(1))"""
UNION = f"""SELECT chunk_method, count(*) AS n_chunks, CAST(sum(length(chunk_text)) AS BIGINT) AS n_chars FROM (SELECT chunk_method, chunk_text FROM fixed UNION ALL
SELECT 'ai_prep_search', unnest({PACKED}) FROM silver WHERE length(trim(parsed_text)) > 0) WHERE length(chunk_text) > 0 GROUP BY 1"""


@query(UNION, "fixed")
def chunk_union(spark, d):
    """Both chunkers' chunks of all documents."""
    s = t.documents_silver(spark, d)
    both = documents.search_chunks(
        documents.chunked(s, documents.fixed_chunks("parsed_text"), "fixed_overlap"), documents.chunked(s, documents.paragraph_chunks("parsed_text"), "ai_prep_search")
    )
    return both.groupBy("chunk_method").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("chunk_length").alias("n_chars"))


#: Each line a paragraph, so that texts have many.
MANY = "SELECT doc_path, unnest({}) AS chunk_text FROM (SELECT doc_path, replace(parsed_text, chr(10), chr(10) || chr(10)) AS parsed_text FROM silver WHERE length(trim(parsed_text)) > 0)"


@query(
    "SELECT doc_path, count(*) AS n_chunks, md5(string_agg(chunk_text, '|' ORDER BY chunk_text)) AS digest "
    f"FROM ({MANY.format(PACKED)}) GROUP BY 1",
    "silver",
)
def paragraph_packing(spark, d):
    """Chunks of texts whose lines are paragraphs."""
    s = t.documents_silver(spark, d).withColumn("parsed_text", F.replace("parsed_text", F.lit("\n"), F.lit("\n\n")))
    chunks = documents.chunked(s, documents.paragraph_chunks("parsed_text"), "ai_prep_search")
    return (
        chunks.groupBy("doc_path")
        .agg(F.count(F.lit(1)).alias("n_chunks"), F.md5(F.array_join(F.array_sort(F.collect_list("chunk_text")), "|")).alias("digest"))
    )


@query("""SELECT chunk_id, CAST(length(chunk_text) + (CASE WHEN chunk_index % 3 = 0 THEN 4 ELSE 0 END) AS DOUBLE) AS n_chars, chunk_index % 3 = 0 OR chunk_index % 3 = 1 AS made_now
FROM chunks WHERE doc_path NOT LIKE '%7.txt'""", "chunks")
def vector_sync(spark, d):
    """A sync after a third of the chunks changed, a third came new, and some documents went; unchanged vectors are kept."""
    now = fixed(spark, d).select("chunk_id", "chunk_index", "doc_path", "chunk_text")
    embed = lambda made: lambda text: F.array(F.length(text).cast("double"), F.lit(made))
    index = vector.index_rows(now.filter("chunk_index % 3 <> 1"), embed(0.0))
    edited = F.when(F.col("chunk_index") % 3 == 0, F.concat("chunk_text", F.lit(" new"))).otherwise(F.col("chunk_text"))
    out = vector.sync(index, now.filter("doc_path NOT LIKE '%7.txt'").withColumn("chunk_text", edited), embed(1.0))
    return out.select("chunk_id", F.get("embedding", F.lit(0)).alias("n_chars"), (F.get("embedding", F.lit(1)) == 1).alias("made_now"))


@query(
    "SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings "
    "ORDER BY vec_id LIMIT 1)), 6) AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 5",
)
def vector_topk(spark, d):
    e = t.table(spark, d, "embeddings")
    return vector.top_k(e, e.orderBy("vec_id").limit(1)).select("vec_id", "score")


@query("""SELECT query_id, vec_id, score FROM (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, vec_id) AS n FROM (
SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0)) WHERE n <= 5""")
def vector_topk_all(spark, d):
    """Every row whose id is divisible by 100 against all rows."""
    e = t.table(spark, d, "embeddings")
    return vector.top_k(e, e.filter("vec_id % 100 = 0")).select("query_id", "vec_id", "score")


@query("SELECT count(*) AS n_queries, true AS found_most FROM embeddings WHERE vec_id % 100 = 0")
def vector_index_recall(spark, d):
    """The index's answers to every query row against the exact ones: is nine tenths of the five best rows found?"""
    e = t.table(spark, d, "embeddings").select("vec_id", "embedding")
    asked = e.filter("vec_id % 100 = 0")
    got = vector.Index.build(e, workspace(spark, "vectors")).search(asked).select("query_id", "vec_id", F.lit(1).alias("hit"))
    met = vector.top_k(e, asked).select("query_id", "vec_id").join(got, ["query_id", "vec_id"], "left")
    return met.agg(F.countDistinct("query_id").alias("n_queries"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("found_most"))


@query("SELECT vec_id, vec_id % 5 = 0 AS moved FROM embeddings WHERE vec_id % 7 <> 0 UNION ALL SELECT vec_id + 1000000, true FROM embeddings WHERE vec_id % 9 = 0")
def vector_index_sync(spark, d):
    """After a sync, changed vectors are found as themselves, rows that went are gone, and new ones are there."""
    e = t.table(spark, d, "embeddings").select("vec_id", "embedding", F.lit(False).alias("moved"))
    index = vector.Index.build(e, workspace(spark, "vectors"))
    turned = F.transform("embedding", lambda x: -x)
    changed = e.filter("vec_id % 5 = 0 AND vec_id % 7 <> 0").withColumn("embedding", turned)
    came = e.filter("vec_id % 9 = 0").withColumn("vec_id", F.col("vec_id") + 1000000)
    index.sync(changed.unionByName(came).withColumn("moved", F.lit(True)), e.filter("vec_id % 7 = 0"))
    return index.rows().select("vec_id", "moved")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_metric_path(spark, d):
    return t.table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("SELECT doc_path, md5(parsed_text || chr(10) || chr(10) || 'x') AS digest FROM silver", "silver")
def variant_page_text(spark, d):
    """Pages of a parsed document, joined by an empty line."""
    page = lambda c: F.struct(c.alias("content"))
    doc = F.to_variant_object(F.struct(F.struct(F.array(page(F.col("parsed_text")), page(F.lit("x"))).alias("pages")).alias("document")))
    pages = F.transform(F.variant_get(doc, "$.document.pages", "array<variant>"), lambda v: F.variant_get(v, "$.content", "string"))
    return t.documents_silver(spark, d).select("doc_path", F.md5(F.array_join(pages, "\n\n")).alias("digest"))


# ---- governance --------------------------------------------------------------------------------


def governed() -> governance.Governance:
    g = governance.Governance()
    g.define_tag("classification", {"public", "internal", "confidential", "restricted"})
    g.define_tag("role")
    g.set_row_filter("daily_sales", governance.regional_and_status, "region", "status")
    g.set_row_filter("customer_summary", governance.customer_status, "status")
    g.set_mask("customer_summary", "discount_rate", governance.discount_rate)
    g.tag_column("chunks", "classification", role="classification")
    g.tag_column("chunks", "department", role="department")
    g.create_policy("documents", governance.classification_department, ("role", "classification"), ("role", "department"))
    return g


SALES = "SELECT CAST(order_date AS VARCHAR) AS order_date, region, status, count(order_id) AS order_count FROM good {} GROUP BY order_date, region, status"


def _sales(spark, d, *groups):
    p = governance.Principal("x", frozenset(groups))
    return text(governed().secure_read(gold.daily_sales(good(spark, d)), "daily_sales", p).select("order_date", "region", "status", "order_count"))


@query(SALES.format(""), "good")
def secured_daily_sales_admin(spark, d):
    return _sales(spark, d, governance.ADMINS)


@query(SALES.format("WHERE region = 'ASIA' AND status <> 'DRAFT'"), "good")
def secured_daily_sales_regional(spark, d):
    return _sales(spark, d, "region-ASIA")


SECURED = """SELECT c.customer_id, c.status, {} AS discount_rate FROM (SELECT customer_id, CASE WHEN status = 'view' THEN 'CHURNED' ELSE status END AS status FROM scd2 WHERE __END_AT IS NULL) c
LEFT JOIN (SELECT customer_id, round(avg(discount_rate), 4) AS discount_rate FROM good GROUP BY 1) USING (customer_id) WHERE c.status <> 'CHURNED'"""


def _customers(spark, d, *groups):
    p = governance.Principal("x", frozenset(groups))
    summary = gold.customer_summary(
        history(spark, d).withColumn("status", F.when(F.col("status") == "view", "CHURNED").otherwise(F.col("status"))),
        good(spark, d), ["status"],
    )
    return governed().secure_read(summary, "customer_summary", p).select("customer_id", "status", "discount_rate")


@query(
    "SELECT v.*, CASE v.table_name WHEN 'chunks' THEN (SELECT count(*) FROM chunks) ELSE (SELECT count(*) FROM (SELECT DISTINCT order_date, region, status FROM good)) END AS n_rows "
    "FROM (VALUES ('chunks', 'classification', 'role', 'classification'), ('chunks', 'department', 'role', 'department'), "
    "('daily_sales', CAST(NULL AS VARCHAR), 'classification', 'internal')) v(table_name, column_name, tag, value)",
    "chunks",
    "good",
)
def governance_tags(spark, d):
    """The tags of the registered tables, with how many rows an administrator's SQL finds in each."""
    g = governed()
    g.register("chunks", lambda s: fixed(s, d))
    g.register("daily_sales", lambda s: gold.daily_sales(good(s, d)))
    g.tag_table("daily_sales", classification="internal")
    own = g.session(spark, governance.Principal("x", frozenset({governance.ADMINS})))
    g.tags(own).createOrReplaceTempView("tags")
    return own.sql(
        "SELECT t.*, n.n_rows FROM tags t JOIN (SELECT 'chunks' AS table_name, count(*) AS n_rows FROM chunks UNION ALL SELECT 'daily_sales', count(*) FROM daily_sales) n USING (table_name)"
    )


SQL_SALES = "SELECT status, CAST(sum(order_count) AS BIGINT) AS n_orders, count(DISTINCT region) AS n_regions FROM daily_sales GROUP BY status"


@query(SQL_SALES.replace("daily_sales", "(" + SALES.format("WHERE region = 'ASIA' AND status <> 'DRAFT'") + ")"), "good")
def secured_sql_regional(spark, d):
    """A principal's own SQL over a registered table sees what the row filter lets through."""
    g = governed()
    g.register("daily_sales", lambda s: gold.daily_sales(good(s, d)))
    return g.session(spark, governance.Principal("x", frozenset({"region-ASIA"}))).sql(SQL_SALES)


@query("SELECT department, count(*) AS n_chunks, count(DISTINCT doc_path) AS n_docs FROM chunks WHERE department = 'src1' AND classification <> 'restricted' GROUP BY 1", "chunks")
def secured_sql_tagged_later(spark, d):
    """A table that is tagged while a principal's session is open: its next SQL is filtered, without a new view or policy."""
    g = governed()
    g.register("chunks_copy", lambda s: fixed(s, d))
    own = g.session(spark, governance.Principal("x", frozenset({"dept-src1"})))
    for column in ("classification", "department"):
        g.tag_column("chunks_copy", column, role=column)
    return own.sql("SELECT department, count(*) AS n_chunks, count(DISTINCT doc_path) AS n_docs FROM chunks_copy GROUP BY department")


@query("SELECT doc_path, CAST(chunk_index AS INTEGER) AS chunk_index FROM chunks WHERE department = 'src1' AND classification <> 'restricted'", "chunks")
def policy_covers_later_tables(spark, d):
    """A policy by tags filters a table that is tagged after it was made."""
    g = governed()
    for column in ("classification", "department"):
        g.tag_column("chunks_copy", column, role=column)
    return g.secure_read(fixed(spark, d), "chunks_copy", governance.Principal("x", frozenset({"dept-src1"}))).select("doc_path", "chunk_index")


@query(
    "SELECT v.property, v.value, n.n_rows FROM (VALUES ('quality', 'bronze'), ('retention', 'interval 7 days'), ('source', '/in/orders')) v(property, value), (SELECT count(*) AS n_rows FROM bronze_orders) n",
    "bronze_orders",
)
def pipeline_properties(spark, d):
    """A published table in the catalogue: its declared properties as table properties, and its rows by SQL."""
    p = Pipeline(spark, "orders", workspace(spark, "properties"), {"raw_path": "/in/orders"})
    p.materialized_view(name="bronze", properties={"quality": "bronze", "source": p.parameter("raw_path"), "retention": "interval 7 days"})(lambda p: orders(spark, d))
    p.run()
    name = f"bronze_{uuid.uuid4().hex}"
    p.register("bronze", name)
    declared = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": name}).filter("key IN ('quality', 'retention', 'source')")
    return declared.select(F.col("key").alias("property"), "value").crossJoin(files.table_scan(spark, name).agg(F.count(F.lit(1)).alias("n_rows")))


#: Two versions of orders: some go, some come, some change.
FEED = """WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0),
new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 <> 0),
met AS (SELECT o.o_orderkey AS ok, n.o_orderkey AS nk, o.o_orderstatus AS os, n.o_orderstatus AS ns, o.o_totalprice AS op, n.o_totalprice AS np FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey)
SELECT ok AS o_orderkey, os AS o_orderstatus, op AS o_totalprice, CASE WHEN nk IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM met WHERE ok IS NOT NULL AND (nk IS NULL OR os <> ns)
UNION ALL SELECT nk, ns, np, CASE WHEN ok IS NULL THEN 'insert' ELSE 'update_postimage' END, 1 FROM met WHERE nk IS NOT NULL AND (ok IS NULL OR os <> ns)"""


@query(FEED)
def change_feed_orders(spark, d):
    """The change feed between two published versions of a table."""
    p = Pipeline(spark, "orders", workspace(spark, "feed"), {"run": "0"})

    @p.materialized_view(properties={"change_feed": "o_orderkey"})
    def kept(p):
        o, k = t.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), F.col("o_orderkey")
        if p.parameter("run") == "0":
            return o.filter(k % 7 != 0)
        return o.filter(k % 11 != 0).withColumn("o_orderstatus", F.when(k % 5 == 0, "X").otherwise(F.col("o_orderstatus")))

    p.run()
    p.parameters["run"] = "1"
    p.run()
    return p.changes("kept", 0).drop("_commit_timestamp")


@query(SECURED.format("discount_rate"), "scd2", "good")
def secured_customer_summary_pricing(spark, d):
    return _customers(spark, d, governance.PRICING)


@query(SECURED.format("CAST(NULL AS DOUBLE)").replace(" WHERE c.status <> 'CHURNED'", ""), "scd2", "good")
def secured_customer_summary_retention(spark, d):
    return _customers(spark, d, governance.RETENTION)


@query(SECURED.format("CAST(NULL AS DOUBLE)"), "scd2", "good")
def secured_customer_summary_none(spark, d):
    return _customers(spark, d)


@query("SELECT doc_path, CAST(chunk_index AS INTEGER) AS chunk_index FROM chunks WHERE classification <> 'restricted' AND department = 'src1'", "chunks")
def secured_chunks_dept(spark, d):
    return governed().secure_read(fixed(spark, d), "chunks", governance.Principal("x", frozenset({"dept-src1"}))).select("doc_path", "chunk_index")


# ---- ingestion and catalogued tables -----------------------------------------------------------


def ingested(spark, d, kind: str, runs, bronze):
    """Files that come before each run, each run taking the new ones into one table. A run's files: frames, each with its own columns."""
    root = workspace(spark, kind)
    store = files.SchemaStore(spark, f"{root}/schema.json")
    for i, batch in enumerate(runs):
        for k, part in enumerate(batch):
            getattr(part.write.option("header", True), kind)(f"{root}/in/b{i}/{k}")
        files.ingest(spark, f"{root}/in", kind, store, bronze, f"{root}/bronze", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/bronze")


@query(
    "SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, amount, region, substring(payment_card_number, -4, "
    "4) AS payment_card_last4, false AS reprocessed_from_quarantine FROM bronze_orders",
    "bronze_orders",
)
def ingest_json_orders(spark, d):
    """Orders as JSON lines; the second batch brings a column that the first lacks, so only that one has regions."""
    o = t.bronze_orders(spark, d)
    half = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    got = ingested(spark, d, "json", [[o.filter(half)], [o.filter(~half)]], lambda raw: files.bronze_orders(raw, t.SALT))
    return text(got.select("order_id", "customer_id", "order_date", "amount", "region", "payment_card_last4", "reprocessed_from_quarantine"))


@query(
    """SELECT order_id, CASE WHEN k <> 1 THEN amount END AS amount, CASE WHEN k = 2 THEN region END AS note,
    CASE WHEN k = 1 AND amount IS NOT NULL THEN '{"amount":"about ' || CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR) || '"}' END AS rescued FROM (SELECT *, CAST(order_id AS BIGINT) % 3 AS k FROM bronze_orders WHERE order_id IS NOT NULL)""",
    "bronze_orders",
)
def ingest_json_rescued(spark, d):
    """Amounts that come as text in the second run are rescued under their name; a column that the third run brings is added."""
    o = t.bronze_orders(spark, d).filter("order_id IS NOT NULL").withColumn("k", F.col("order_id").cast("long") % 3)
    first, third = o.filter("k = 0").select("order_id", "amount"), o.filter("k = 2").select("order_id", F.col("region").alias("note"), "amount")
    second = o.filter("k = 1").select("order_id", F.concat(F.lit("about "), F.floor("amount").cast("string")).alias("amount"))
    got = ingested(spark, d, "json", [[first], [second], [third]], lambda raw: raw.withColumn("note", col_or_null(raw, "note", "string")))
    return got.select("order_id", "amount", "note", F.col(files.RESCUED).alias("rescued"))


@query(
    f"SELECT order_id, substring(payment_card_number, -4, 4) AS payment_card_last4, sha256(payment_card_number || '{t.SALT}') AS payment_card_hash, 'half' || CAST(CAST(order_id AS BIGINT) % 2 AS VARCHAR) AS folder, true AS timed FROM bronze_orders",
    "bronze_orders",
)
def pipeline_parameters(spark, d):
    """A pipeline whose folder comes from its parameters and whose salt from the session, with each row's file and time of ingestion."""
    root, own = workspace(spark, "parameters"), spark.newSession()
    own.conf.set(pii.SALT_CONF, t.SALT)
    o = t.bronze_orders(spark, d)
    for k in (0, 1):
        o.filter(F.col("order_id").cast("long") % 2 == k).write.json(f"{root}/raw/half{k}")
    p = Pipeline(own, "orders", f"{root}/tables", {"raw_orders_path": f"{root}/raw"})

    @p.materialized_view(warn=rules.BRONZE_ORDER_WARN_RULES)
    def bronze(p):
        store = files.SchemaStore(own, f"{p.root}/orders.json")
        files.ingest(own, p.parameter("raw_orders_path"), "json", store, lambda raw: files.bronze_orders(raw, pii.salt(own)), f"{p.root}/ingested", f"{p.root}/ingested-checkpoint")
        return own.read.parquet(f"{p.root}/ingested").drop("batch")

    p.run()
    return p.read("bronze").select("order_id", "payment_card_last4", "payment_card_hash", F.regexp_extract("source_file", "/raw/([^/]+)/", 1).alias("folder"), F.col("ingestion_time").isNotNull().alias("timed"))


@query("SELECT customer_id, name, email, phone, birth_date, region, CAST(NULL AS VARCHAR) AS operation FROM people", "people")
def ingest_csv_customers(spark, d):
    c = t.customers(spark, d)
    half = F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0
    got = ingested(spark, d, "csv", [[c.filter(half)], [c.filter(~half)]], files.bronze_customers)
    return got.select("customer_id", "name", "email", "phone", "birth_date", "region", "operation")


@query(
    """SELECT customer_id, name, CASE WHEN k <> 2 THEN email END AS email, CASE WHEN k IN (1, 3) THEN phone END AS phone, CASE WHEN k >= 2 THEN region END AS region, CASE WHEN k = 3 THEN 'L' || customer_id END AS loyalty,
    CAST(NULL AS VARCHAR) AS rescued FROM (SELECT *, CAST(regexp_extract(customer_id, '[0-9]+') AS BIGINT) % 4 AS k FROM people)""",
    "people",
)
def ingest_csv_by_name(spark, d):
    """Files of four headers in two runs: other orders, fewer and more columns, another case. Values go by their column's name."""
    c = t.customers(spark, d).withColumn("k", F.regexp_extract("customer_id", "[0-9]+", 0).cast("long") % 4).withColumn("loyalty", F.concat(F.lit("L"), "customer_id"))
    part = lambda k, *names: c.filter(F.col("k") == k).select(*names)
    runs = [
        [part(0, "customer_id", "name", "email"), part(1, "customer_id", "email", "name", "phone")],
        [part(2, "region", F.col("name").alias("NAME"), "customer_id"), part(3, "loyalty", "phone", "region", "email", "name", "customer_id")],
    ]
    got = ingested(spark, d, "csv", runs, lambda raw: raw.select(*(col_or_null(raw, n, "string") for n in ("customer_id", "name", "email", "phone", "region", "loyalty")), files.RESCUED))
    return got.select("customer_id", "name", "email", "phone", "region", "loyalty", F.col(files.RESCUED).alias("rescued"))


@query("SELECT source AS department, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY 1")
def ingest_binary_documents(spark, d):
    """Whole files with their content, read as a stream and as a batch; both see the same bytes."""
    root = workspace(spark, "binary")
    docs = t.table(spark, d, "documents").select(F.concat(F.lit("raw_documents/"), "source").alias("folder"), "text")
    names = [r["folder"] for r in docs.select("folder").distinct().collect()]  # a row a source
    for n in names:
        docs.filter(F.col("folder") == n).select("text").write.text(f"{root}/{n}/public")
    files.append_available(documents.bronze_documents(files.binary_stream(spark, f"{root}/raw_documents", "part-*.txt")), f"{root}/bronze", f"{root}/checkpoint")
    size = lambda df: df.groupBy("department").agg(F.sum("file_size_bytes").alias("n_bytes"))
    batch = size(documents.bronze_documents(files.binary_files(spark, f"{root}/raw_documents", "part-*.txt")))
    return size(spark.read.parquet(f"{root}/bronze")).intersect(batch)


@query(f"""SELECT order_id, CAST(CASE WHEN list_contains(violated_rules, 'order_date_not_future') THEN DATE '{t.ORDERS_AS_OF}' ELSE order_date END AS VARCHAR) AS order_date,
CASE WHEN list_contains(violated_rules, 'positive_amount') THEN abs(amount) ELSE amount END AS amount, true AS reprocessed_from_quarantine FROM ({DECIDED}) WHERE resolution_status = 'CORRECTED'""", "bad")
def requeue_roundtrip(spark, d):
    """Corrected rows written as JSON lines into the ingestion folder, and taken in again."""
    root = workspace(spark, "requeue")
    fixed_rows = quarantine.corrected(quarantine.decided(bad(spark, d)), F.lit(t.ORDERS_AS_OF).cast("date"))
    files.requeue_json(fixed_rows, f"{root}/in/reprocessed")
    store = files.SchemaStore(spark, f"{root}/schema.json")
    files.ingest(spark, f"{root}/in", "json", store, lambda raw: files.bronze_orders(raw, t.SALT), f"{root}/bronze", f"{root}/checkpoint")
    return text(spark.read.parquet(f"{root}/bronze").select("order_id", "order_date", "amount", "reprocessed_from_quarantine"))


@query(f"SELECT order_id, {RULES_TEXT}, resolution_status, correction_note, CAST(n AS INTEGER) AS reprocess_count FROM ({DECIDED}), range(1, 3) r(n)", "bad")
def resolution_log_attempts(spark, d):
    """The catalogued log after two runs: the rows come to quarantine again after the first, so each has a second attempt."""
    name = f"log_{uuid.uuid4().hex}"
    files.create_log_table(spark, name, workspace(spark, "log"))
    q = bad(spark, d)
    for day in ("2024-01-01", "2024-01-03"):
        came = F.lit(day).cast("timestamp")
        log = files.table_scan(spark, name)
        entries = quarantine.reprocess(q.withColumn("quarantined_at", came), log, F.lit(t.ORDERS_AS_OF).cast("date"), F.lit(day).cast("timestamp") + F.expr("INTERVAL 1 DAY"))[1]
        files.append_table(entries, name)
    return (
        files.table_scan(spark, name)
        .select("order_id", F.array_join("violated_rules", ",").alias("violated_rules"), "resolution_status", "correction_note", "reprocess_count")
    )


#: Day of coming to quarantine and of the run that decides; the last rows wait for a run yet.
ATTEMPTS = "(VALUES (1, 1, 2), (2, 1, 2), (3, 3, 4), (4, 5, NULL)) v(n, came, ran)"


def attempted(spark, d) -> tuple[DataFrame, DataFrame]:
    """(quarantine, log): all rows come twice on day 1, every other one on day 3, every third on day 5; runs are on days 2 and 4."""
    q, day = bad(spark, d), lambda n: F.lit(f"2024-01-0{n}").cast("timestamp")
    k = F.col("order_id").cast("long")
    came = lambda df, n: df.withColumn("quarantined_at", day(n))
    first, second, third = came(q.unionByName(q), 1), came(q.filter(k % 2 == 0), 3), came(q.filter(k % 3 == 0), 5)
    name = f"log_{uuid.uuid4().hex}"
    files.create_log_table(spark, name, workspace(spark, "attempts"))
    for rows, ran in ((first, 2), (first.unionByName(second), 4)):
        files.append_table(quarantine.reprocess(rows, files.table_scan(spark, name), F.lit(t.ORDERS_AS_OF).cast("date"), day(ran))[1], name)
    return first.unionByName(second).unionByName(third), files.table_scan(spark, name)


@query(
    f"""SELECT order_id, {RULES_TEXT}, '2024-01-0' || came || ' 00:00:00' AS quarantined_at, CASE WHEN ran IS NOT NULL THEN resolution_status END AS resolution_status,
    CASE WHEN ran IS NOT NULL THEN correction_note END AS correction_note, '2024-01-0' || ran || ' 00:00:00' AS resolved_at FROM ({DECIDED}), {ATTEMPTS}
    WHERE n < 3 OR (n = 3 AND CAST(order_id AS BIGINT) % 2 = 0) OR (n = 4 AND CAST(order_id AS BIGINT) % 3 = 0)""",
    "bad",
)
def resolution_report_attempts(spark, d):
    """Several quarantined rows and attempts of one id: each row once, with the first decision after it came."""
    q, log = attempted(spark, d)
    out = quarantine.resolution_report(q, log).withColumn("violated_rules", F.array_join("violated_rules", ","))
    return text(out.select("order_id", "violated_rules", "quarantined_at", "resolution_status", "correction_note", "resolved_at"))


@query(f"SELECT order_id, CAST(n AS INTEGER) AS reprocess_count, count(*) AS n_rows FROM ({DECIDED}), {ATTEMPTS} WHERE n < 3 OR (n = 3 AND CAST(order_id AS BIGINT) % 2 = 0) GROUP BY 1, 2", "bad")
def resolution_log_repeated(spark, d):
    """An id's rows in one run get a number each, and the next run goes on from there."""
    return attempted(spark, d)[1].groupBy("order_id", "reprocess_count").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' OR c_name = 'it''s'")
def dynamic_sql(spark, d):
    """A statement put together as text, with quoted values, over a table whose name is a parameter."""
    name = f"customers_{uuid.uuid4().hex}"
    t.table(spark, d, "customer").createOrReplaceTempView(name)
    where = f"c_mktsegment = {files.literal('BUILDING')} OR c_name = {files.literal("it's")}"
    return spark.sql(f"SELECT c_custkey, c_name FROM IDENTIFIER(:name) WHERE {where}", args={"name": name})


EXPECTED = """SELECT 'bronze' AS flow_name, 'bronze' AS dataset, 'amount_present' AS name, count(amount) AS passed_records, count(*) - count(amount) AS failed_records FROM bronze_orders
UNION ALL SELECT 'bronze', 'bronze', 'order_id_present', count(order_id), count(*) - count(order_id) FROM bronze_orders
UNION ALL SELECT f, 'checked', 'positive', count(*) FILTER (coalesce(amount > 0, false)), count(*) FILTER (NOT coalesce(amount > 0, false)) FROM bronze_orders, (VALUES ('daily'), ('kept')) v(f) GROUP BY f
UNION ALL SELECT 'kept', 'kept', 'customer_known', count(customer_id), count(*) - count(customer_id) FROM bronze_orders WHERE coalesce(amount > 0, false)"""


@query(EXPECTED, "bronze_orders")
def graph_expectations(spark, d):
    """Counts by expectation in the event log: warnings on a table, drops in a view that a table and a stream read, warnings on a stream."""
    p = Pipeline(spark, "orders", workspace(spark, "graph"))

    @p.materialized_view(warn=rules.BRONZE_ORDER_WARN_RULES)
    def bronze(p):
        return orders(spark, d)

    @p.view("bronze", drop={"positive": "amount > 0"})
    def checked(p):
        return p.read("bronze")

    @p.materialized_view("checked", fail={"counted": "order_count > 0"})
    def daily(p):
        return gold.daily_sales(p.read("checked"))

    @p.view("bronze", name="checked_stream")
    def stream(p):
        return p.read_stream("bronze").select("order_id", "customer_id", "amount")

    @p.streaming_table("checked_stream", warn={"customer_known": "customer_id IS NOT NULL"})
    def kept(p):
        return p._expected(p.datasets["checked"], p.read_stream("checked_stream"))

    p.run()
    return p.expectations().drop("update_id")


@query(
    """SELECT 'by_day' AS flow_name, 'checked' AS dataset, 'positive' AS name, count(*) FILTER (coalesce(amount > 0, false)) AS passed_records, count(*) FILTER (NOT coalesce(amount > 0, false)) AS failed_records FROM bronze_orders
    UNION ALL SELECT 'emptied', 'checked', 'positive', NULL, NULL UNION ALL SELECT 'unread', 'checked', 'positive', NULL, NULL""",
    "bronze_orders",
)
def graph_expectation_states(spark, d):
    """A view that one dataset reads twice counts once; one whose rows reach no plan that runs has no counts, and nothing waits for them."""
    p = Pipeline(spark, "orders", workspace(spark, "states"))

    @p.view(drop={"positive": "amount > 0"})
    def checked(p):
        return orders(spark, d)

    @p.materialized_view("checked")
    def by_day(p):
        total = p.read("checked").groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
        return p.read("checked").groupBy("order_date").agg(F.max("amount").alias("most")).join(total, "order_date")

    @p.materialized_view("checked")
    def emptied(p):
        return p.read("checked").filter("false")

    @p.materialized_view("checked")
    def unread(p):
        return spark.range(3).select(F.lit(len(p.read("checked").columns)).alias("n"))

    p.run()
    return p.expectations().drop("update_id")


# ---- streams -----------------------------------------------------------------------------------


@query(
    "SELECT (len(violated_rules) = 0) AS ok, count(*) AS n "
    "FROM (SELECT list_filter([CASE WHEN o_totalprice <= 1500 THEN 'a' END, CASE WHEN o_orderstatus = 'P' THEN 'b' END], "
    "lambda x: x IS NOT NULL) AS violated_rules FROM orders) GROUP BY 1",
)
def stream_orders_split(spark, d):
    root = workspace(spark, "split")
    flows.split_orders(t.stream(spark, d, "orders"), rules.RuleSet({"a": "o_totalprice > 1500", "b": "o_orderstatus <> 'P'"}), f"{root}/valid", f"{root}/quarantine", f"{root}/checkpoint")
    side = lambda name, ok: spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(ok).alias("ok"), "n")
    return side("valid", True).unionByName(side("quarantine", False))


@query("SELECT CAST(conv_id AS VARCHAR) AS doc_path, count(*) AS n FROM (SELECT conv_id, unnest(range(0, length(text), 600)) FROM conversations) GROUP BY 1")
def stream_chunks(spark, d):
    root = workspace(spark, "chunks")
    docs = t.stream(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("doc_path"), F.col("role").alias("department"),
        F.lit("internal").alias("classification"), F.lit("x").alias("file_name"), F.current_timestamp().alias("ingestion_time"),
        "text",
    )
    chunks = documents.chunked(docs, documents.fixed_chunks("text"), "fixed_overlap")
    flows.append(chunks, f"{root}/chunks", f"{root}/checkpoint")
    return spark.read.schema(chunks.schema).parquet(f"{root}/chunks").groupBy("doc_path").agg(F.count(F.lit(1)).alias("n"))


@query(UNION, "fixed")
def stream_chunk_union(spark, d):
    """Both chunkers over a stream of documents, their union with its guards, appended batch by batch."""
    root = workspace(spark, "both")
    s = t.documents_silver(spark, d)
    s.write.parquet(f"{root}/silver")
    src = spark.readStream.schema(s.schema).parquet(f"{root}/silver")
    parts = [
        documents.chunked(src, documents.fixed_chunks("parsed_text"), "fixed_overlap"),
        documents.chunked(src, documents.paragraph_chunks("parsed_text"), "ai_prep_search"),
    ]
    flows.append(documents.search_chunks(*parts), f"{root}/chunks", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/chunks").groupBy("chunk_method").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("chunk_length").alias("n_chars"))


@query(SCD, "scd2")
def stream_scd2_incremental(spark, d):
    """Change events in two files, the later ones first; history is kept up batch by batch."""
    root = workspace(spark, "scd2")
    e = t.customers_cdc(spark, d)
    for i, part in enumerate((e.filter(F.col("updated_at") >= "2024-01-15"), e.filter(F.col("updated_at") < "2024-01-15"))):
        part.coalesce(1).write.mode("append").parquet(f"{root}/in/part={i}")
        stream = spark.readStream.schema(e.schema).parquet(f"{root}/in/part=*")
        flows.apply_changes(spark, stream.select(*e.columns), f"{root}/out", ["customer_id"], "updated_at", "operation = 'DELETE'")
    return flows.latest(spark, f"{root}/out")


# ---- alerts ------------------------------------------------------------------------------------


def stamp(c: str, name: str) -> str:
    return f"strftime({c}, '{STAMP}') AS {name}"


@query(
    f"SELECT count(*) AS failed_task_count, {stamp('max(period_start_time)', 'latest_failure_time')}, max(job_id) AS sample_job_id, "
    f"max(task_key) AS sample_task_key FROM runs WHERE result_state = 'FAILED' AND period_start_time > {NOW} - INTERVAL 1 DAY",
    "runs",
)
def alert_failed_tasks(spark, d):
    return text(m.failed_tasks(t.job_runs(spark, d), t.now()))


@query(
    f"SELECT count(*) AS failed_update_count, {stamp('max(period_start_time)', 'latest_failure_time')}, "
    "max(pipeline_id) AS sample_pipeline_id FROM updates "
    f"WHERE result_state = 'FAILED' AND period_start_time > {NOW} - INTERVAL 10 MINUTE",
    "updates",
)
def alert_failed_updates(spark, d):
    return text(m.failed_updates(t.pipeline_updates(spark, d), t.now()))


@query(
    f"SELECT count(*) AS stale_job_count, max(job_id) AS sample_job_id, {stamp('min(l)', 'oldest_last_success_time')} "
    "FROM (SELECT job_id, max(period_start_time) AS l FROM runs WHERE result_state = 'SUCCESS' GROUP BY 1) "
    f"WHERE l < {NOW} - INTERVAL 24 HOUR",
    "runs",
)
def alert_stale_jobs(spark, d):
    return text(m.stale_jobs(t.job_runs(spark, d), t.now()))


MIN = "date_sub('minute', period_start_time, period_end_time)"


@query(
    "SELECT count(*) AS long_running_count, max(job_id) AS sample_job_id, max(run_id) AS sample_run_id, "
    f"max({MIN}) AS max_duration_minutes FROM runs WHERE period_start_time > {NOW} - INTERVAL 1 DAY AND {MIN} > 15",
    "runs",
)
def alert_long_runs(spark, d):
    return m.long_runs(t.job_runs(spark, d), t.now())


@query(f"""SELECT count(*) AS anomalous_update_count, max(update_id) AS sample_update_id, max(took) AS sample_duration_minutes, CAST(max(made) AS BIGINT) AS sample_output_rows FROM (SELECT *, lag(took) OVER w AS took0, lag(made) OVER w AS made0 FROM
(SELECT update_id, period_start_time, {MIN} AS took FROM updates WHERE pipeline_id = 'pipe-3' AND result_state = 'COMPLETED') JOIN (SELECT update_id, sum(output_rows) AS made FROM log WHERE event_type = 'flow_progress' GROUP BY 1) USING (update_id) WINDOW w AS (ORDER BY period_start_time, update_id))
WHERE took0 > 0 AND made0 > 0 AND took / took0 > 1.5 * greatest(made / made0, 0.01)""", "updates", "log")
def alert_slowdowns(spark, d):
    return m.slowdowns(t.pipeline_updates(spark, d), t.event_log(spark, d), "pipe-3")


@query(f"""SELECT count(*) AS spike_flag, round(max(a), 2) AS today_usage, round(max(b), 2) AS yesterday_usage, round(max((a - b) / nullif(b, 0) * 100), 2) AS growth_rate_pct FROM (SELECT sum(usage_quantity) AS a FROM billing WHERE usage_date = {TODAY} HAVING count(*) > 0), (SELECT sum(usage_quantity) AS b FROM billing WHERE usage_date = {TODAY} - 1 HAVING count(*) > 0) WHERE abs((a - b) / nullif(b, 0) * 100) > 20""", "billing")
def alert_cost_change(spark, d):
    return m.cost_change(t.billing(spark, d), t.today())


@query(f"""SELECT count(*) AS spike_entity_count, max(warehouse_name) AS sample_warehouse, max(project) AS sample_project, round(max((a - b) / b * 100), 2) AS max_growth_rate_pct FROM (SELECT warehouse_name, project, sum(CASE WHEN usage_date = {TODAY} THEN usage_quantity ELSE 0 END) AS a, sum(CASE WHEN usage_date = {TODAY} - 1 THEN usage_quantity ELSE 0 END) AS b
FROM billing LEFT JOIN warehouses USING (warehouse_id) WHERE usage_date >= {TODAY} - 1 GROUP BY 1, 2) WHERE b > 0 AND (a - b) / b * 100 > 50""", "billing", "warehouses")
def alert_cost_by_warehouse(spark, d):
    return m.cost_change_by_warehouse(t.billing(spark, d), t.warehouses(spark, d), t.today())


@query(
    "SELECT count(*) AS breach_flag, max(n) AS total_runs, round(max(r), 2) AS success_rate_pct "
    "FROM (SELECT n, g * 100.0::DOUBLE / nullif(n, 0) AS r FROM (SELECT count(*) AS n, count(*) FILTER (result_state = 'SUCCESS') AS g "
    f"FROM runs WHERE period_start_time >= {TODAY} - 7)) WHERE r < 99",
    "runs",
)
def alert_success_rate(spark, d):
    return m.success_rate(t.job_runs(spark, d), t.today())


@query(
    f"SELECT count(*) AS freshness_breach_flag, {stamp('max(l)', 'last_update_time')}, round(max(date_sub('minute', l, {NOW}) / 60), "
    "2) AS freshness_delay_hours FROM (SELECT max(event_time) AS l FROM lineage WHERE target_table_full_name = 'main.sales.p7') "
    f"WHERE date_sub('minute', l, {NOW}) > 15",
    "lineage",
)
def alert_freshness(spark, d):
    return text(m.freshness(t.lineage(spark, d), "main.sales.p7", t.now()))


@query(
    "SELECT count(*) AS breach_flag, max(quarantine_count) AS quarantine_count, max(total_count) AS total_count, "
    "round(max(quarantine_count * 100.0::DOUBLE / nullif(total_count, 0)), 2) AS failure_rate_pct "
    f"FROM (SELECT DISTINCT quarantine_count, total_count FROM ({SUMMARY})) WHERE quarantine_count * 100.0 / nullif(total_count, 0) > 1",
    "good",
    "bad",
)
def alert_quarantine_rate(spark, d):
    return m.quarantine_rate(quality_summary(spark, d))


@query(f"""SELECT count(*) AS flapping_task_count, max(job_id) AS sample_job_id, max(task_key) AS sample_task_key, min(g) AS min_interval_sec FROM (SELECT job_id, task_key, count(*) AS n, min(gap) AS g FROM
(SELECT job_id, task_key, date_sub('second', lag(period_start_time) OVER (PARTITION BY job_id, task_key ORDER BY period_start_time), period_start_time) AS gap FROM runs WHERE period_start_time > {NOW} - INTERVAL 1 DAY) GROUP BY 1, 2) WHERE n > 3 AND g < 60""", "runs")
def alert_flapping(spark, d):
    return m.flapping(t.job_runs(spark, d), t.now())


# ---- dashboards --------------------------------------------------------------------------------


@query(
    f"SELECT executed_by, {half_up('avg(total_duration_ms) / 1000', 2)} AS avg_sec, "
    f"{half_up('quantile_cont(total_duration_ms, 0.5) / 1000', 2)} AS median_sec, round(sum(read_bytes) / power(1024, 3), "
    "3) AS gb_scanned, count(*) FILTER (execution_status = 'FAILED') AS failed_count, count(*) AS query_count FROM history "
    f"WHERE start_time >= {NOW} - INTERVAL 1 DAY GROUP BY 1",
    "history",
)
def dash_query_health(spark, d):
    return m.query_health(t.query_history(spark, d), t.now())


@query("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 4) AS high FROM lineitem GROUP BY 1")
def exact_high_price(spark, d):
    """A quantile of groups with nearly as many distinct values as rows."""
    return exact_quantile(t.table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.9, "high").withColumn("high", F.round("high", 4))


@query(f"SELECT project AS project_name, round(sum(usage_quantity), 2) AS total_usage FROM billing WHERE usage_date >= {TODAY} - 30 GROUP BY 1", "billing")
def dash_cost_by_project(spark, d):
    return m.cost_by_project(t.billing(spark, d), t.today())


@query(f"SELECT executed_by, CAST(sum(total_duration_ms) AS BIGINT) AS total_ms FROM history WHERE start_time >= {TODAY} - 7 GROUP BY 1", "history")
def dash_time_by_user(spark, d):
    return m.time_by_user(t.query_history(spark, d), t.today())


@query(
    "SELECT warehouse_name, auto_stop_minutes, round(sum(usage_quantity), 2) AS total_usage_7d FROM billing LEFT "
    f"JOIN warehouses USING (warehouse_id) WHERE usage_date >= {TODAY} - 7 GROUP BY 1, 2",
    "billing",
    "warehouses",
)
def dash_cost_by_warehouse(spark, d):
    return m.cost_by_warehouse(t.billing(spark, d), t.warehouses(spark, d), t.today())


@query(
    "SELECT CAST(hour(usage_start_time) AS INTEGER) AS hour, CAST(dayofweek(usage_date) + 1 AS INTEGER) AS dow, "
    f"round(sum(usage_quantity), 2) AS total_usage FROM billing WHERE usage_date >= {TODAY} - 28 GROUP BY 1, 2",
    "billing",
)
def dash_cost_by_hour(spark, d):
    return m.cost_by_hour(t.billing(spark, d), t.today())


DAY = "date_trunc('day', period_start_time)"


@query(
    f"SELECT {stamp(DAY, 'run_date')}, count(*) AS total_runs, CAST(count(*) FILTER ({MIN} <= 15) AS BIGINT) AS sla_met, "
    f"round(count(*) FILTER ({MIN} <= 15) * 100.0::DOUBLE / count(*), 2) AS sla_met_pct FROM runs GROUP BY 1",
    "runs",
)
def dash_sla(spark, d):
    return text(m.sla(t.job_runs(spark, d)))


@query(
    "SELECT pipeline_name, CASE WHEN message LIKE '%RESOURCE_EXHAUSTED%' THEN 'capacity' "
    "WHEN message LIKE '%permission%' THEN 'governance' WHEN message LIKE '%Schema%' THEN 'data' ELSE 'other' END AS error_category, "
    "count(*) AS occurrences FROM (SELECT * FROM log UNION ALL SELECT * FROM log WHERE pipeline_name = 'pipe-1') WHERE level = 'ERROR' "
    "GROUP BY 1, 2",
    "log",
)
def dash_error_categories(spark, d):
    log = t.event_log(spark, d)
    return m.error_categories(log, log.filter("origin.pipeline_name = 'pipe-1'"))


@query(
    "SELECT job_id, CAST(round(CAST(avg(date_sub('minute', period_end_time, s)) AS DECIMAL(30, 8)), 2) AS DOUBLE) AS avg_mttr_minutes "
    "FROM (SELECT *, lead(result_state) OVER w AS r, lead(period_start_time) OVER w AS s FROM runs WINDOW w AS (PARTITION BY job_id "
    "ORDER BY period_start_time, run_id)) WHERE result_state = 'FAILED' AND r = 'SUCCESS' GROUP BY 1",
    "runs",
)
def dash_recovery(spark, d):
    return m.recovery(t.job_runs(spark, d))


@query(
    "SELECT executed_by, event_id FROM history "
    "WHERE statement_type = 'SELECT' AND lower(statement_text) LIKE '%customer%' AND executed_by NOT IN (SELECT executed_by "
    "FROM history WHERE start_time BETWEEN DATE '2024-01-02' - 90 AND DATE '2024-01-02' - 1 + INTERVAL 1 DAY)",
    "history",
)
def dash_new_readers(spark, d):
    return m.new_readers(t.query_history(spark, d), F.lit("2024-01-03").cast("date")).select("executed_by", "event_id")


@query(f"SELECT executed_by, statement_type, event_id FROM history WHERE statement_type IN ('DELETE', 'UPDATE', 'DROP', 'ALTER')", "history")
def dash_mutations(spark, d):
    return m.mutations(t.query_history(spark, d)).select("executed_by", "statement_type", "event_id")


@query(
    "SELECT round(count(comment) * 100.0::DOUBLE / count(*), 2) AS comment_rate_pct, "
    "round(count(table_owner) * 100.0::DOUBLE / count(*), 2) AS owner_rate_pct, count(*) AS total_tables FROM metadata "
    "WHERE table_schema <> 'information_schema'",
    "metadata",
)
def dash_coverage(spark, d):
    return m.coverage(t.tables(spark, d))


@query(
    f"SELECT table_schema, table_name, {stamp('last_access', 'last_access')} FROM metadata LEFT "
    "JOIN (SELECT target_table_full_name AS f, max(event_time) AS last_access FROM lineage "
    "GROUP BY 1) ON f = table_catalog || '.' || table_schema || '.' || table_name "
    "WHERE last_access < DATE '2001-06-01' - 90 OR last_access IS NULL",
    "metadata",
    "lineage",
)
def dash_unused_tables(spark, d):
    return text(m.unused_tables(t.tables(spark, d), t.lineage(spark, d), F.lit("2001-06-01").cast("date")))


@query("SELECT source_table_full_name, count(DISTINCT target_table_full_name) AS downstream_count FROM lineage GROUP BY 1", "lineage")
def dash_fan_out(spark, d):
    return m.fan_out(t.lineage(spark, d))


# ---- investigations ----------------------------------------------------------------------------


@query(f"SELECT {stamp('ts', 'timestamp')}, event_type, message, flow_name FROM log WHERE level = 'ERROR'", "log")
def inv_failures(spark, d):
    return text(m.failures(t.event_log(spark, d)))


@query("SELECT event_type, level, count(*) AS event_count FROM log WHERE update_id = '000000007' GROUP BY 1, 2", "log")
def inv_update_events(spark, d):
    return m.update_events(t.event_log(spark, d), "000000007")


@query(
    f"SELECT flow_name, {half_up('avg(duration_ms) / 1000', 2)} AS avg_sec, {half_up('avg(output_rows)', 4)} AS avg_output_rows "
    "FROM log WHERE event_type = 'flow_progress' GROUP BY 1",
    "log",
)
def inv_slow_flows(spark, d):
    return m.slow_flows(t.event_log(spark, d))


ERRORS = "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_date, count(*) AS error_count FROM log WHERE level = 'ERROR' GROUP BY 1"


@query(ERRORS, "log")
def inv_errors_by_day(spark, d):
    return text(m.errors_by_day(t.event_log(spark, d)))


@query(ERRORS, "log")
def inv_error_trend(spark, d):
    return text(m.errors_by_day(t.event_log(spark, d), descending=False))


@query(f"SELECT {stamp('ts', 'event_time')}, 'jobs' AS service_name, event_type AS action_name FROM events WHERE user_id = 7")
def inv_deploys(spark, d):
    return text(m.deploys(t.audit(spark, d), "user7@mail.example"))
