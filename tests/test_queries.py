"""Every registered query against its SQL twin, and the shape of the driver contract."""

import oracle
import pytest

import __spark_entry__ as entry
from talkloom.plans import evaluation, files, jobs, messages, records, tokens

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    wanted = oracle.duck_rows(duck, SQL[name])
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1]) > 0
    assert got[1] == wanted[1]


def test_entry(spark):
    assert entry.entry(spark).columns == ["example_id", "system", "user", "bot"]


def test_every_query_of_the_library_has_sql():
    own = [*records.QUERIES, *tokens.QUERIES, *evaluation.QUERIES, *messages.QUERIES, *files.QUERIES, *jobs.QUERIES]
    assert set(own) <= SQL.keys() <= QUERIES.keys()


def test_time_zone_does_not_matter(spark, sf_dir):
    query = QUERIES["throttle_schedule"]
    utc = oracle.spark_rows(query(spark, sf_dir))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert oracle.spark_rows(query(spark, sf_dir)) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
