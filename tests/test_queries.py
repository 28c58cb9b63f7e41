"""Every registered query against its SQL on the smallest given tables."""

import datetime
import decimal
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def table(columns, rows):
    order = sorted(columns)
    places = [columns.index(c) for c in order]
    return order, sorted((tuple(plain(r[i]) for i in places) for r in rows), key=repr)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in sorted(os.listdir(FOLDER)):
        connection.execute(f"CREATE VIEW {path.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    frame = contract.queries()[name](spark, FOLDER)
    got = table(frame.columns, frame.collect())
    result = database.execute(contract.oracle_sql()[name])
    assert got == table([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", ["kmeans_final", "project_2d"])
def test_query_without_sql_has_rows(spark, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert name not in contract.oracle_sql() and frame.count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["keyword", "growth", "mean_first", "mean_second"]
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["dedup_first", "hash_sample", "knn_filtered", "peak_month", "retrieve_samples", "template_rotate"])
def test_results_do_not_depend_on_partitions_or_zone(spark, name):
    def run(partitions, zone):
        old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            frame = contract.queries()[name](spark, FOLDER)
            return table(frame.columns, frame.collect())
        finally:
            for key, value in old.items():
                spark.conf.set(key, value)

    assert run("1", "UTC") == run("13", "Asia/Seoul")


@pytest.mark.parametrize("name", ["id_date_impute", "lenient_parse", "month_counts", "id_date_fit"])
def test_dates_do_not_depend_on_the_zone(spark, database, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_sql(spark, database, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
