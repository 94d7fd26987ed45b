import glob

import pytest

import __spark_entry__ as driver
from labelloom.catalog.queries import by_range
from oracle_check import compare, connect

# The optional training-data queries have tests of their own.
QUERIES, ORACLES = driver.QUERIES, driver.ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])


def test_entry(spark):
    assert driver.entry(spark).count() == 200


def test_parts_are_written_as_several_ordered_files(spark, sf_dir):
    driver.QUERIES["partial_records"](spark, sf_dir).collect()
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    files = sorted(glob.glob(f"{root}/**/*.part1.parquet/*.parquet", recursive=True))
    assert len({f.rsplit("/", 1)[0] for f in files}) < len(files)
    df = by_range(spark.range(100).selectExpr("id % 10 AS k"), "k")
    parts = [[r.k for r in p] for p in df.rdd.glom().collect() if p]
    assert len(parts) > 1 and sum(parts, []) == sorted(sum(parts, []))
    assert sum(len(set(p)) for p in parts) == 10
