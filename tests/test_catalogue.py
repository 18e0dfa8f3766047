import pytest
from conftest import same

from terrace import catalogue


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_matches_oracle(spark, sf_dir, duck, name):
    same(catalogue.QUERIES[name](spark, sf_dir), duck, catalogue.ORACLES[name])


def test_entry_point(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
