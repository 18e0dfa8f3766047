import pytest

from terrace.llm import op4_substring_dedup as op4


def test_ids_out_of_order_are_refused(spark, tmp_path):
    """A batch with smaller ids would make earlier results stale; one that begins with the last id is fine, and so is the next try."""
    index = op4.Index(spark, f"file://{tmp_path}/index", buckets=4)
    batch = lambda *ids: spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(20))) for i in ids], "doc_id long, text string")
    removed = lambda df: {r["doc_id"]: r["n_removed"] for r in df.collect()}
    assert removed(index.add(batch(5, 7))) == {5: 0, 7: 20}
    with pytest.raises(ValueError, match="doc_id 6 comes after 7"):
        index.add(batch(6, 9))
    assert removed(op4.Index(spark, f"file://{tmp_path}/index").add(batch(7, 8))) == {7: 20, 8: 20}
    assert removed(index.add(batch(None))) == {None: 20}
    with pytest.raises(ValueError, match="comes after"):
        index.add(batch(100))
    assert index.add(batch()).count() == 0
