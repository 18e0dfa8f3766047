from pyspark.sql import functions as F

from terrace.llm import common as c
from terrace.llm import op3_host_reputation as op3


def test_both_verdicts_occur(spark, sf_dir):
    """Unlabelled hosts of the bad domain go too, and hosts that are bad alone; others stay."""
    got = op3.op3b_planted_reputation(spark, sf_dir).filter("rule IS NULL").collect()
    assert {r["verdict"] for r in got} == {"block", "allow"}
    assert any(r["verdict"] == "block" and not r["n_labelled"] for r in got)
    assert all(r["verdict"] == "allow" for r in got if r["n_labelled"] and not r["n_bad"] and not r["host"].endswith(".example.com"))


def test_ports_and_addresses(spark):
    hosts = ["x.com:8080", "a.x.com", "10.0.0.1", "10.0.0.1:80", "[::1]:443", "a.b.co.uk", "co.uk", "com", ""]
    df = op3.domains(spark.createDataFrame([(h,) for h in hosts], "host string"))
    got = {r["host"]: (r["suffix"], r["domain"]) for r in df.collect()}
    assert got["x.com:8080"] == got["a.x.com"] == ("com", "x.com")
    assert got["10.0.0.1"] == got["10.0.0.1:80"] == (op3.ADDRESS, "10.0.0.1")
    assert got["[::1]:443"] == (op3.ADDRESS, "[::1]")
    assert got["a.b.co.uk"] == ("co.uk", "b.co.uk")
    assert got["co.uk"] == ("co.uk", "co.uk")
    assert got["com"] == ("com", "com")


def test_very_long_urls(spark):
    pages = spark.createDataFrame([(1, "http://h.example.org/" + "x" * 200_000), (2, "http://" + "h." * 50_000 + "org/fr/"), (3, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1)], "page_id long, bad int")
    got = {r["page_id"]: r for r in op3.judge(spark, pages, labels).collect()}
    assert len(got) == 3
    assert len(got[1]["path"]) == 200_001
    assert got[2]["rule"] == "org/fr/"


def test_half_of_all_rows_under_one_key(spark):
    """Rows of a hot key stay where they are; each row meets its key's row once, also with null keys, which meet nothing."""
    rows = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 1001 == 0, None).otherwise(F.col("id").cast("string")).alias("key")).repartition(8)
    few = rows.select("key").distinct().filter("key IS NOT NULL").withColumn("length", F.length("key"))
    out = c.met(rows, few, "key")
    counts = {(r["p"], r["hot"]): r["count"] for r in out.groupBy(F.spark_partition_id().alias("p"), (F.col("key") == "hot").alias("hot")).count().collect()}
    hot = sorted(n for (_, h), n in counts.items() if h)
    assert sum(hot) == 4000
    assert hot[-1] <= 2 * hot[len(hot) // 2]
    assert len(hot) >= 4
    assert sorted(map(tuple, out.select("id", "key", "length").collect())) == sorted(map(tuple, rows.join(few, "key").select("id", "key", "length").collect()))


def test_hot_host(spark):
    """Half of all pages on one host, a third of hosts under one domain."""
    pages = spark.createDataFrame([(i, f"http://{'big.example.org' if i % 2 else f'h{i}.hosting.com' if i % 3 else f'x{i}.net'}/p") for i in range(3000)], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(0, 3000, 3)], "page_id long, bad int")
    got = op3.judge(spark, pages, labels, rules={}).collect()
    assert len(got) == len({r["page_id"] for r in got}) == 3000
    assert {r["verdict"] for r in got if r["host"] == "big.example.org"} == {"block"}
    assert {r["verdict"] for r in got if r["host"] != "big.example.org"} == {"allow"}
