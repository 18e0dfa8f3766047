"""The inputs of the library's queries, derived from the driver's tables: orders, change events, telemetry, documents.

Each has a twin in SQL (CTES), which the oracles are built from.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stand-ins for the current date and time, within the span of the data.
ORDERS_AS_OF = "2001-01-01"
NOW = "2024-01-30 12:00:00"
TODAY = "2024-01-30"
SALT = "pepper"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of files. Spark takes a file only where a pattern names it."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def now():
    return F.lit(NOW).cast("timestamp")


def today():
    return F.lit(TODAY).cast("date")


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n, r = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    k = F.col("o_orderkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        k.cast("string").alias("order_id"), F.when(k % 97 != 0, F.col("o_custkey").cast("string")).alias("customer_id"), F.to_date("o_orderdate").alias("order_date"),
        F.when(k % 53 == 0, -F.col("o_totalprice")).when(k % 89 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(k % 61 == 0, F.lit("EUR")).when(k % 67 == 0, F.lit(None)).when(k % 2 == 0, F.lit("USD")).otherwise(F.lit("JPY")).alias("currency"),
        F.when(F.col("o_orderstatus") == "P", F.lit("DRAFT")).otherwise(F.col("o_orderstatus")).alias("status"), F.col("r_name").alias("region"), F.col("o_totalprice").alias("unit_price"), ((k % 11) / 100).alias("discount_rate"),
        F.lpad(k.cast("string"), 16, "4").alias("payment_card_number"),
    )


def customers_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    return e.select(
        F.col("user_id").cast("string").alias("customer_id"), F.col("event_type").alias("status"),
        F.round("value", 2).alias("score"), op.alias("operation"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    mail = F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, F.concat(F.lit("user"), k)).otherwise(F.concat(F.lit("user"), k, F.lit("@mail.example")))
    phone = F.when(k % 7 == 0, F.concat(F.lit("090"), k)).otherwise(F.concat(F.lit("090-"), k, F.lit("-"), F.lpad(k.cast("string"), 4, "0")))
    return c.select(
        k.cast("string").alias("customer_id"), F.col("c_name").alias("name"), mail.alias("email"), phone.alias("phone"),
        F.concat((1950 + k % 50).cast("string"), F.lit("-04-12")).alias("birth_date"), F.col("c_mktsegment").alias("region"),
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("job-"), F.col("user_id") % 10).alias("job_id"), F.concat(F.lit("task-"), F.col("user_id") % 3).alias("task_key"), F.lpad(F.col("event_id").cast("string"), 9, "0").alias("run_id"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("result_state"), ts.alias("period_start_time"), F.timestamp_add("SECOND", F.floor(F.abs("value") * 10).cast("int"), ts).alias("period_end_time"),
    )


def pipeline_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = job_runs(spark, sf_dir)
    return r.select(
        F.concat(F.lit("pipe-"), F.substring("job_id", 5, 1)).alias("pipeline_id"), F.col("run_id").alias("update_id"),
        F.when(F.col("result_state") == "SUCCESS", "COMPLETED").otherwise("FAILED").alias("result_state"), "period_start_time",
        "period_end_time",
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    bad = F.col("event_type") == "error"
    message = (
        F.when(~bad, "ok")
        .when(F.col("event_id") % 4 == 0, "RESOURCE_EXHAUSTED: no capacity")
        .when(F.col("event_id") % 4 == 1, "no permission")
        .when(F.col("event_id") % 4 == 2, "Schema mismatch")
        .otherwise("other")
    )
    origin = F.struct(
        F.lpad(F.col("event_id").cast("string"), 9, "0").alias("update_id"),
        F.concat(F.lit("pipe-"), F.col("user_id") % 10).alias("pipeline_name"),
        F.concat(F.lit("flow-"), F.col("user_id") % 7).alias("flow_name"),
    )
    details = F.concat(F.lit('{"flow_progress": {"metrics": {"num_output_rows": '), (F.col("event_id") % 1000).cast("string"), F.lit("}}}"))
    return e.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "view", "user_action").otherwise("flow_progress").alias("event_type"),
        F.when(bad, "ERROR").otherwise("INFO").alias("level"), message.alias("message"),
        F.floor(F.abs("value") * 1000).cast("bigint").alias("duration_ms"), origin.alias("origin"), details.alias("details"),
    )


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    tags = F.when(F.col("event_type") != "view", F.create_map(F.lit("project"), F.col("event_type"))).otherwise(F.create_map(F.lit("team"), F.lit("x")))
    return e.select(
        F.to_date("ts").alias("usage_date"), F.col("ts").cast("timestamp").alias("usage_start_time"),
        F.round("value", 2).alias("usage_quantity"), tags.alias("custom_tags"),
        F.struct(F.concat(F.lit("wh-"), F.col("user_id") % 5).alias("warehouse_id")).alias("usage_metadata"),
    )


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spark.range(4)
        .select(
            F.concat(F.lit("wh-"), F.col("id")).alias("warehouse_id"),
            F.concat(F.lit("Warehouse "), F.col("id")).alias("warehouse_name"),
            (F.col("id") * 10).cast("int").alias("auto_stop_minutes"),
        )
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = (
        F.when(F.col("event_type") == "click", "SELECT")
        .when(F.col("event_type") == "error", "DELETE")
        .when(F.col("event_type") == "purchase", "UPDATE")
        .otherwise("SELECT")
    )
    text = F.when(F.col("event_id") % 3 == 0, F.lit("select * from CUSTOMERS")).otherwise(F.lit("select 1"))
    return e.select(
        F.concat(F.lit("user"), F.col("user_id")).alias("executed_by"),
        F.floor(F.abs("value") * 1000).cast("bigint").alias("total_duration_ms"),
        (F.col("event_id") * 1048576).alias("read_bytes"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("execution_status"),
        F.col("ts").cast("timestamp").alias("start_time"), kind.alias("statement_type"), text.alias("statement_text"), "event_id",
    )


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("main.sales.s"), F.col("l_suppkey")).alias("source_table_full_name"),
        F.concat(F.lit("main.sales.p"), F.col("l_partkey")).alias("target_table_full_name"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.lit("main").alias("table_catalog"), F.when(k % 50 == 0, "information_schema").otherwise("sales").alias("table_schema"),
        F.concat(F.when(k % 10 == 0, "x").otherwise("p"), k).alias("table_name"),
        F.when(k % 3 != 0, F.col("p_name")).alias("comment"), F.when(k % 7 != 0, F.lit("owner")).alias("table_owner"),
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").cast("timestamp").alias("event_time"), F.lit("jobs").alias("service_name"),
        F.col("event_type").alias("action_name"),
        F.struct(F.concat(F.lit("user"), F.col("user_id"), F.lit("@mail.example")).alias("email")).alias("user_identity"),
    )


def documents_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("/x/raw_documents/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 5 == 0, ".PDF").when(F.col("doc_id") % 5 == 1, ".Md").otherwise(".txt")).alias("doc_path"),
        F.col("source").alias("department"), F.col("lang").alias("classification"), F.col("doc_id").cast("string").alias("file_name"), F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("ingestion_time"), F.col("text").alias("parsed_text"),
    )


#: The same inputs in DuckDB SQL.
CTES = {
    "bronze_orders": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
      CASE WHEN o_orderkey % 53 = 0 THEN -o_totalprice WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice END AS amount,
      CASE WHEN o_orderkey % 61 = 0 THEN 'EUR' WHEN o_orderkey % 67 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'JPY' END AS currency,
      CASE WHEN o_orderstatus = 'P' THEN 'DRAFT' ELSE o_orderstatus END AS status, r_name AS region, o_totalprice AS unit_price, CAST(o_orderkey % 11 AS DOUBLE) / 100 AS discount_rate, lpad(CAST(o_orderkey AS VARCHAR), 16, '4') AS payment_card_number
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "classified": f"""SELECT *, list_filter([CASE WHEN order_id IS NULL THEN 'order_id_not_null' END, CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END, CASE WHEN NOT coalesce(amount > 0, false) THEN 'positive_amount' END,
      CASE WHEN NOT coalesce(order_date <= DATE '{ORDERS_AS_OF}', false) THEN 'order_date_not_future' END, CASE WHEN NOT coalesce(currency IN ('JPY', 'USD'), false) THEN 'valid_currency' END], lambda x: x IS NOT NULL) AS violated_rules FROM bronze_orders""",
    "good": "SELECT * FROM classified WHERE len(violated_rules) = 0",
    "bad": "SELECT * FROM classified WHERE len(violated_rules) > 0",
    "cdc": """SELECT CAST(user_id AS VARCHAR) AS customer_id, event_type AS status, round(value, 2) AS score, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS updated_at FROM events""",
    "scd2": "SELECT * FROM (SELECT *, updated_at AS __START_AT, lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS __END_AT FROM cdc) WHERE operation <> 'DELETE'",
    "people": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'user' || c_custkey ELSE 'user' || c_custkey || '@mail.example' END AS email,
      CASE WHEN c_custkey % 7 = 0 THEN '090' || c_custkey ELSE '090-' || c_custkey || '-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') END AS phone, CAST(1950 + c_custkey % 50 AS VARCHAR) || '-04-12' AS birth_date, c_mktsegment AS region FROM customer""",
    "runs": """SELECT 'job-' || (user_id % 10) AS job_id, 'task-' || (user_id % 3) AS task_key, lpad(CAST(event_id AS VARCHAR), 9, '0') AS run_id, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS result_state,
      ts AS period_start_time, ts + to_seconds(CAST(floor(abs(value) * 10) AS BIGINT)) AS period_end_time FROM events""",
    "updates": "SELECT 'pipe-' || substr(job_id, 5, 1) AS pipeline_id, run_id AS update_id, CASE WHEN result_state = 'SUCCESS' THEN 'COMPLETED' ELSE 'FAILED' END AS result_state, period_start_time, period_end_time FROM runs",
    "log": """SELECT ts, CASE WHEN event_type = 'view' THEN 'user_action' ELSE 'flow_progress' END AS event_type, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
      CASE WHEN event_type <> 'error' THEN 'ok' WHEN event_id % 4 = 0 THEN 'RESOURCE_EXHAUSTED: no capacity' WHEN event_id % 4 = 1 THEN 'no permission' WHEN event_id % 4 = 2 THEN 'Schema mismatch' ELSE 'other' END AS message,
      CAST(floor(abs(value) * 1000) AS BIGINT) AS duration_ms, lpad(CAST(event_id AS VARCHAR), 9, '0') AS update_id, 'pipe-' || (user_id % 10) AS pipeline_name, 'flow-' || (user_id % 7) AS flow_name, event_id % 1000 AS output_rows FROM events""",
    "billing": "SELECT CAST(ts AS DATE) AS usage_date, ts AS usage_start_time, round(value, 2) AS usage_quantity, CASE WHEN event_type <> 'view' THEN event_type END AS project, 'wh-' || (user_id % 5) AS warehouse_id FROM events",
    "warehouses": "SELECT 'wh-' || i AS warehouse_id, 'Warehouse ' || i AS warehouse_name, CAST(i * 10 AS INTEGER) AS auto_stop_minutes FROM range(4) t(i)",
    "history": """SELECT 'user' || user_id AS executed_by, CAST(floor(abs(value) * 1000) AS BIGINT) AS total_duration_ms, event_id * 1048576 AS read_bytes, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS execution_status, ts AS start_time,
      CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'purchase' THEN 'UPDATE' ELSE 'SELECT' END AS statement_type, CASE WHEN event_id % 3 = 0 THEN 'select * from CUSTOMERS' ELSE 'select 1' END AS statement_text, event_id FROM events""",
    "lineage": "SELECT 'main.sales.s' || l_suppkey AS source_table_full_name, 'main.sales.p' || l_partkey AS target_table_full_name, l_shipdate AS event_time FROM lineitem",
    "metadata": "SELECT 'main' AS table_catalog, CASE WHEN p_partkey % 50 = 0 THEN 'information_schema' ELSE 'sales' END AS table_schema, CASE WHEN p_partkey % 10 = 0 THEN 'x' ELSE 'p' END || p_partkey AS table_name, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS comment, CASE WHEN p_partkey % 7 <> 0 THEN 'owner' END AS table_owner FROM part",
    "silver": """SELECT '/x/raw_documents/' || source || '/' || lang || '/' || doc_id || CASE doc_id % 5 WHEN 0 THEN '.PDF' WHEN 1 THEN '.Md' ELSE '.txt' END AS doc_path, source AS department, lang AS classification, CAST(doc_id AS VARCHAR) AS file_name,
      to_timestamp(1704067200 + doc_id) AT TIME ZONE 'UTC' AS ingestion_time, text AS parsed_text FROM documents""",
    "fixed": "SELECT doc_path, department, classification, file_name, ingestion_time, s // 600 AS chunk_index, substring(parsed_text, s + 1, 800) AS chunk_text, 'fixed_overlap' AS chunk_method FROM (SELECT *, unnest(range(0, length(parsed_text), 600)) AS s FROM silver)",
    "chunks": "SELECT sha256(doc_path || '-' || chunk_method || '-' || chunk_index) AS chunk_id, *, length(chunk_text) AS chunk_length FROM fixed",
}
NEEDS = {
    "classified": ["bronze_orders"], "good": ["classified"], "bad": ["classified"], "scd2": ["cdc"], "updates": ["runs"],
    "fixed": ["silver"], "chunks": ["fixed"],
}


def sql(select: str, *names: str) -> str:
    """A statement over the named inputs and what they need."""
    order: list[str] = []

    def add(n: str) -> None:
        for x in NEEDS.get(n, ()):
            add(x)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + select


#: Lines of a page in planted PDF files.
PAGE_LINES = 40


def pdf_of(text: str, deflated: bool, mapped: bool, broken: bool = False) -> bytes:
    """A PDF file that shows the lines of a text, PAGE_LINES a page: plain or deflated, in Latin-1 or by a ToUnicode map."""
    lines = text.split("\n")
    parts = [lines[i : i + PAGE_LINES] for i in range(0, len(lines), PAGE_LINES)]

    def shown(line: str) -> bytes:
        if mapped:
            return b"<" + line.encode("utf-16-be", "surrogatepass").hex().encode() + b"> Tj"
        return b"(" + re.sub(rb"([\\()\r])", lambda m: b"\\r" if m[1] == b"\r" else b"\\" + m[1], line.encode("latin-1", "replace")) + b") Tj"

    def stream(data: bytes) -> bytes:
        data = zlib.compress(data) if deflated else data
        return b"<< /Length %d%s >>\nstream\n" % (len(data), b" /Filter /FlateDecode" * deflated) + data + b"\nendstream"

    kids = b" ".join(b"%d 0 R" % (10 + 2 * i) for i in range(len(parts)))
    cmap = b"begincodespacerange <0000> <FFFF> endcodespacerange beginbfrange <0000> <FFFF> <0000> endbfrange"
    font = b"<< /Type /Font /Subtype /Type0" + b" /ToUnicode 5 0 R" * mapped + b" >>"
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [" + kids + b"] /Resources << /Font << /F1 4 0 R >> >> >>", 4: font, 5: stream(cmap)}
    for i, part in enumerate(parts):
        objects[10 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (11 + 2 * i)
        objects[11 + 2 * i] = stream(b"BT /F1 12 Tf 0 700 Tm " + b" T* ".join(shown(x) for x in part) + b" ET")
    out = b"%PDF-1.7\n" + b"".join(b"%d 0 obj\n" % n + body + b"\nendobj\n" for n, body in objects.items()) + b"%%EOF"
    return out[:60] if broken else out


def pdf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files: a third each plain text, PDF in Latin-1 and deflated PDF with a map; some are cut off or of no known format."""

    def made(i, text):
        plain = (text or "").encode() if i % 11 != 4 else b"\x00\x01"
        return plain if i % 3 == 0 or i % 11 == 4 else pdf_of(text or "", i % 3 == 2, i % 3 == 2 or not (text or "").isascii(), i % 7 == 5)

    content = F.udf(made, "binary", useArrow=False)("doc_id", "text")  # by the hundred rows, as Arrow batches of files are large
    files = table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    kind = F.when(F.col("doc_id") % 3 == 0, "txt").otherwise("pdf")
    return files.select(
        F.concat(F.lit("raw_documents/general/public/"), F.col("doc_id"), F.lit("."), kind).alias("path"), "content", F.octet_length("content").cast("long").alias("length"), F.lit(NOW).cast("timestamp").alias("modificationTime"),
    )
