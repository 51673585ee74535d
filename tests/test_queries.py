import duckdb
import pytest

from tests.oracle import compare, connection
from tidewheel.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, sf_dir, name):
    query = catalogue.queries()[name]
    if name in SQL:
        compare(spark, connection(sf_dir), sf_dir, query, SQL[name])
    else:
        assert query(spark, sf_dir).count() > 0


def test_resolved_files_have_any_id(spark, sf_dir, tmp_path):
    c = duckdb.connect()
    for t, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):  # ids on both sides of 0 and of 1,000,000
        c.sql(f"copy (select * replace ({key} + s as {key}) from '{sf_dir}/{t}.parquet', (values (-750), (999250)) v(s)) to '{tmp_path}/{t}.parquet'")
        c.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    compare(spark, c, str(tmp_path), catalogue.queries()["ct7_resolve_files"], SQL["ct7_resolve_files"])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
