"""Every named query against its SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera import catalog


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in os.listdir(small):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{small}/{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, small, duck, name):
    frame = catalog.QUERIES[name](spark, small)
    columns = sorted(frame.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in frame.collect())
    answer = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    assert got == sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_run(spark, small, name):
    assert catalog.QUERIES[name](spark, small).count() > 0


def test_total_of_a_large_table(spark, tmp_path):
    """More rows behind the limit than any ceiling that the query once had."""
    high = F.when(F.col("id") % 5 == 0, "1-URGENT").otherwise("2-HIGH").alias("o_orderpriority")
    spark.range(300_000).select(F.col("id").alias("o_orderkey"), high).write.parquet(f"{tmp_path}/orders.parquet")
    sql = catalog.ORACLE_SQL["total_behind_limit"].replace("FROM orders", f"FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert [tuple(r) for r in catalog.QUERIES["total_behind_limit"](spark, str(tmp_path)).collect()] == duckdb.connect().execute(sql).fetchall() == [(240_000,)]


def test_two_hops_shuffle_no_pairs(spark, tmp_path):
    """Parts that most suppliers hold make millions of pairs; of these nothing is shuffled but counts."""
    spark.range(18_000).select((F.col("id") % 12).alias("l_partkey"), (F.xxhash64("id") % 2500).alias("l_suppkey"), F.col("id").alias("l_orderkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    lineitem = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    lineitem.select(F.col("l_suppkey").alias("s_suppkey"), F.lit("s").alias("s_name")).distinct().write.parquet(f"{tmp_path}/supplier.parquet")
    lineitem.select(F.col("l_partkey").alias("p_partkey"), F.lit("p").alias("p_name"), F.lit("b").alias("p_brand")).distinct().write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, "c", "m")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 1, "1-URGENT", "F")], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")

    def shuffled():
        every = spark.sparkContext._jsc.sc().statusStore().executorList(True)
        return sum(every.apply(i).totalShuffleWrite() for i in range(every.size()))

    before = shuffled()
    got = sorted(tuple(r) for r in catalog.QUERIES["two_hops_back"](spark, str(tmp_path)).select("s", "n").collect())
    assert shuffled() - before < 8_000_000
    sql = catalog.ORACLE_SQL["two_hops_back"].replace("FROM lineitem", f"FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == sorted(duckdb.connect().execute(sql).fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
