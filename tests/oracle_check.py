"""Run queries against their SQL on the same tables; used by the tests and by hand."""

import glob
import os
import sys
import time

import duckdb


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda row: tuple(map(repr, row))
    )


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [item[0] for item in cursor.description]
    kinds = {item[0]: str(item[1]) for item in cursor.description}
    want = rows_of(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns), (df.columns, columns)
    spark_kinds = dict(df.dtypes)
    known = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean",
             "DOUBLE": "double"}
    for column in columns:
        assert known.get(kinds[column]) == spark_kinds[column], (column, kinds, spark_kinds)
    assert len(got) == len(want), (len(got), len(want))
    different = [(a, b) for a, b in zip(got, want) if a != b]
    assert not different, different[:2]
    return len(got)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        began = time.time()
        try:
            sql = entry.oracle_sql()[name]
            print("ok", name, compare(spark, con, sf_dir, entry.queries()[name], sql),
                  f"{time.time() - began:.1f}s", flush=True)
        except Exception as error:
            print("FAIL", name, type(error).__name__, str(error)[:700], flush=True)
