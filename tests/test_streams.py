import duckdb
from conftest import same

from terrace import catalogue

ORDERS = "CREATE VIEW orders AS SELECT * FROM '{}/orders.parquet/*.parquet'"
CONVERSATIONS = "CREATE VIEW conversations AS SELECT * FROM '{}/conversations.parquet/*.parquet'"


def test_streams_of_tables_that_are_folders_of_files(spark, sf_dir, tmp_path):
    for name in ("orders", "conversations"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    con.execute(ORDERS.format(tmp_path))
    con.execute(CONVERSATIONS.format(tmp_path))
    for name in ("stream_orders_split", "stream_chunks"):
        same(catalogue.QUERIES[name](spark, str(tmp_path)), con, catalogue.ORACLES[name])


def test_streams_of_texts_without_a_chunk(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", ""), (2, 0, "user", None)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert catalogue.QUERIES["stream_chunks"](spark, str(tmp_path)).count() == 0
