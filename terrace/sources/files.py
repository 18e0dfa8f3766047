"""Incremental file ingestion with evolving schemas, and file sinks. Streams are triggered: each run takes what is new."""

from __future__ import annotations

import csv
import json
import re
import shutil
from collections.abc import Callable
from functools import reduce
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from terrace.functions import pii
from terrace.functions.columns import col_or_null

BINARY = "path string, modificationTime timestamp, length bigint, content binary"
#: Column for what doesn't fit the schema, as JSON by name.
RESCUED = "_rescued_data"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


class SchemaStore:
    """The known schema of a source, kept beside its checkpoint in any file system Spark reaches. Columns are only added."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self) -> StructType | None:
        p, fs = _fs(self.spark, self.path)
        if not fs.exists(p):
            return None
        text = "\n".join(r.value for r in self.spark.read.text(self.path).collect())  # one small file
        return StructType.fromJson(json.loads(text))

    def evolve(self, found: StructType) -> StructType:
        """Add columns that `found` has; known ones keep their type. Names are the same whatever their case."""
        known = self.load() or StructType()
        names, new = {n.lower() for n in known.names}, []
        for f in found.fields:
            if f.name.lower() not in names:
                names.add(f.name.lower())
                new.append(f)
        merged = StructType([*known.fields, *(StructField(f.name, f.dataType, True) for f in new)])
        if new:
            p, fs = _fs(self.spark, self.path)
            out = fs.create(p, True)
            out.write(bytearray(json.dumps(merged.jsonValue()).encode()))
            out.close()
        return merged


def new_files(spark: SparkSession, path: str, at_once: int = 1000) -> DataFrame:
    """(path) of the files below a folder, as a stream that tells of each file once. No file's content is read."""
    source = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", True)
    return source.option("maxFilesPerTrigger", at_once).load(path).select("path")


#: Settings under which each file is read by a task of its own.
ALONE = {"spark.sql.files.openCostInBytes": str(1 << 40)}


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files of each header, which is a file's first line that isn't blank. Each task stops after it, if its file is
    alone there; where the session doesn't take that setting, tasks read their files to the end."""
    before = {k: spark.conf.get(k, None) for k in ALONE}

    def first(alone: bool):
        def run(batches):
            last = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                file, start = batch.column("file"), batch.column("start")
                ends = pc.run_end_encode(file).run_ends.to_pylist()
                begins = [x for x in [0, *ends[:-1]] if not (x == 0 and file[0].as_py() == last)]
                at = [x for x in begins if start[x].as_py() == 0]  # not where a later part of a file begins
                last = file[batch.num_rows - 1].as_py()
                if at:
                    yield batch.take(pa.array(at)).select(["file", "value"])
                if alone:
                    return

        return run

    try:
        for k, v in ALONE.items():
            spark.conf.set(k, v)
        alone = bool(ALONE) and all(spark.conf.get(k) == v for k, v in ALONE.items())
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("start"))
        found = lines.filter(F.trim("value") != "").mapInArrow(first(alone), "file string, value string").collect()  # a row a file of this trigger
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    out: dict[str, list[str]] = {}
    for r in found:
        out.setdefault(r["value"], []).append(r["file"])
    return out


def _names(header: str, separator: str = ",") -> list[str]:
    """Column names of a header line; repeated and empty ones are told apart by their place."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header.removeprefix("\ufeff")], delimiter=separator), [])):
        name = name.strip()
        names.append(name if name and name.lower() not in {x.lower() for x in names} else f"{name}_c{i}")
    return names


def _text_map(pairs: list[tuple[Column, Column]]) -> Column:
    """JSON of those (name, text) whose text isn't null; null without any."""
    entries = F.filter(F.array(*(F.struct(k.alias("key"), v.cast("string").alias("value")) for k, v in pairs)), lambda e: e["value"].isNotNull())
    return F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(entries)))


def read_csv(spark: SparkSession, paths: list[str], store: SchemaStore, evolve: bool = True) -> DataFrame:
    """Files with header lines, aligned by column name whatever their order; all columns are strings. Names that the store
    doesn't have are added to it, or, without `evolve`, their values are rescued. `_rescued_data` also has the text of a
    record with more or fewer fields than its file's header. Records end at the line; names match whatever their case."""
    groups = {header: (_names(header), found) for header, found in _headers(spark, paths).items()}
    found = StructType([StructField(n, StringType()) for names, _ in groups.values() for n in names])
    known = store.evolve(found) if evolve or not store.load() else store.load()
    parts = []
    for names, own in groups.values():
        at = {n.lower(): f"c{i}" for i, n in enumerate(names)}
        schema = StructType([*(StructField(f"c{i}", StringType()) for i in range(len(names))), StructField("_record", StringType())])
        rows = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", "_record").csv(own)
        lost = [n for n in names if n.lower() not in {k.lower() for k in known.names}]
        rescued = _text_map([(F.lit("_record"), F.col("_record")), *((F.lit(n), F.col(at[n.lower()])) for n in lost)])
        cols = [(F.col(at[k.lower()]) if k.lower() in at else F.lit(None).cast("string")).alias(k) for k in known.names]
        parts.append(rows.select(*cols, rescued.alias(RESCUED), F.col("_metadata.file_path").alias("source_file")))
    if not parts:  # files without a line
        fields = [*(StructField(n, StringType()) for n in known.names), StructField(RESCUED, StringType()), StructField("source_file", StringType())]
        return spark.createDataFrame([], StructType(fields))
    return reduce(DataFrame.unionByName, parts)


def _sql_types(schema: str) -> StructType:
    """The schema that variants of JSON objects have in common: decimals as doubles, values of several kinds as text."""
    kinds = re.sub(r"DECIMAL\(\d+,\d+\)", "DOUBLE", schema.replace("OBJECT<", "STRUCT<"))
    return StructType.fromDDL("o " + re.sub(r"\b(VOID|VARIANT)\b", "STRING", kinds))["o"].dataType


def read_json(spark: SparkSession, paths: list[str], store: SchemaStore, evolve: bool = True) -> DataFrame:
    """Lines of JSON objects. Columns that the store doesn't have are added to it with the type that these files give them, or,
    without `evolve`, their values are rescued. `_rescued_data` has the text of a value that isn't of its column's type, and
    of a line that is no object. Empty lines are left out."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source_file")).filter(F.trim("value") != "")
    lines = lines.withColumn("_keys", F.json_object_keys("value")).withColumn("_v", F.when(F.col("_keys").isNotNull(), F.try_parse_json("value")))
    known = store.load()
    if evolve or not known:
        found = lines.filter("_v IS NOT NULL").agg(F.schema_of_variant_agg("_v")).first()[0]
        kind = _sql_types(found) if found and found not in ("VOID", "OBJECT<>") else StructType()
        known = store.evolve(kind if isinstance(kind, StructType) else StructType())
    cols, texts = [], [(F.lit("_record"), F.when(F.col("_v").isNull(), F.col("value")))]
    for f in known.fields:
        path, kind = f"$['{f.name}']", f.dataType.simpleString()
        raw, value = F.try_variant_get("_v", path, "string"), F.try_variant_get("_v", path, kind)
        if isinstance(f.dataType, (LongType, IntegerType)):  # a fraction isn't cut off
            value = F.when(value == F.try_variant_get("_v", path, "double"), value)
        cols.append(value.alias(f.name))
        if not isinstance(f.dataType, StringType):
            texts.append((F.lit(f.name), F.when(value.isNull(), raw)))
    rescued = _text_map(texts)
    # names that aren't columns, if only for their case
    other = F.filter("_keys", lambda k: ~k.isin(*known.names))
    more = F.map_from_entries(F.transform(other, lambda k: F.struct(k, F.call_function("get_json_object", F.col("value"), F.concat(F.lit("$['"), k, F.lit("']"))))))
    kept = F.coalesce(F.from_json(rescued, "map<string,string>"), F.create_map().cast("map<string,string>"))
    rescued = F.when(F.size(other) > 0, F.to_json(F.map_concat(kept, more))).otherwise(rescued)
    return lines.select(*cols, rescued.alias(RESCUED), "source_file")


def ingest(spark: SparkSession, path: str, kind: str, store: SchemaStore, make: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, evolve: bool = True) -> None:
    """Take the files that came below `path` since the last run into a Parquet table, a folder a batch. The stream's own log
    knows which files are new, and only those are opened, for the schema too. A batch that is run again overwrites its folder."""
    read = {"csv": read_csv, "json": read_json}[kind]

    def each(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # no more than a trigger takes
        if paths:
            make(read(batch.sparkSession, paths, store, evolve)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    new_files(spark, path).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def binary_stream(spark: SparkSession, path: str, pattern: str = "*.*") -> DataFrame:
    return spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)


def binary_files(spark: SparkSession, path: str, pattern: str = "*.*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)


def table_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table that is appended to, as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def _provenance(raw: DataFrame) -> list[Column]:
    file = F.col("source_file") if "source_file" in raw.columns else F.col("_metadata.file_path").alias("source_file")
    return [file, F.current_timestamp().alias("ingestion_time")]


def _rescued(raw: DataFrame) -> list[str]:
    return [RESCUED] if RESCUED in raw.columns else []


def bronze_orders(raw: DataFrame, salt: str) -> DataFrame:
    """Typed orders. The raw card number leaves only its last digits and a salted hash, also where it was rescued."""
    text, number = [(n, "string") for n in ("currency", "status", "region")], [("unit_price", "double"), ("discount_rate", "double")]
    raw = raw.select("*", *_provenance(raw)) if "source_file" not in raw.columns else raw.withColumns({"ingestion_time": F.current_timestamp()})
    df = pii.tokenized_card(raw, salt)
    return df.select(
        col_or_null(df, "order_id", "string"), col_or_null(df, "customer_id", "string"), col_or_null(df, "order_date", "date"), col_or_null(df, "amount", "double"), *(col_or_null(df, n, t) for n, t in [*text, *number]),
        col_or_null(df, "source_system", "string"), col_or_null(df, "ingestion_batch", "string"), "payment_card_last4", "payment_card_hash",
        F.coalesce(col_or_null(df, "reprocessed_from_quarantine", "boolean"), F.lit(False)).alias("reprocessed_from_quarantine"), "source_file", "ingestion_time", *_rescued(df),
    )


def bronze_customers(raw: DataFrame) -> DataFrame:
    names = ("customer_id", "name", "email", "phone", "address", "birth_date", "region", "status", "operation")
    return raw.select(*(col_or_null(raw, n, "string") for n in names), col_or_null(raw, "updated_at", "timestamp"), col_or_null(raw, "source_system", "string"), *_provenance(raw), *_rescued(raw))


def cleaned_customers(validated: DataFrame, salt: str) -> DataFrame:
    """Customers without direct identifiers: hashed e-mail, masked phone, region for address, year for birth date."""
    return validated.select(
        "customer_id", "name", pii.hashed("email", salt).alias("email_hash"), pii.masked_phone("phone").alias("phone_masked"), F.col("region").alias("address_region"), pii.birth_year("birth_date").alias("birth_year"),
        "status", "operation", "updated_at", "source_system", "ingestion_time",
    )


def append_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what is there now and append it to a Parquet table."""
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def requeue_json(df: DataFrame, directory: str) -> None:
    """Corrected rows as JSON lines, in new files of the ingestion folder; dates are ISO strings."""
    df.withColumn("order_date", F.col("order_date").cast("string")).write.mode("append").json(directory)


LOG_SCHEMA = "order_id STRING, violated_rules ARRAY<STRING>, resolution_status STRING, correction_note STRING, resolved_at TIMESTAMP, reprocess_count INT"


def create_log_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The log of decisions, as a catalogued table; one that is there stays as it is."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LOG_SCHEMA}) USING parquet{at} COMMENT 'What became of quarantined orders'")


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalogued table, columns by name."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalogued table by name. The name is a parameter of the statement, never part of its text."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def literal(text: str) -> str:
    """A SQL string literal of any text, for statements that are put together as text."""
    return "concat_ws(chr(39), " + ", ".join("'" + part.replace("\\", "\\\\") + "'" for part in text.split("'")) + ")"


def seed(source: Path, target: Path, pattern: str = "**/*") -> list[Path]:
    """Copy a sample tree into an ingestion folder; files that are there stay as they are."""
    copied = []
    for f in sorted(source.glob(pattern)):
        to = target / f.relative_to(source)
        if f.is_file() and not to.exists():
            to.parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(f, to)
            copied.append(to)
    return copied
