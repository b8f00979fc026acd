"""The flagship query: co-reported pairs above a floor, rolled up to a parent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def co_reported_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted once for each user, day and type; by region, with severity counts."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    once = read("events").select("user_id", F.to_date("ts").alias("day"), "event_type").dropDuplicates()
    placed = once.join(read("customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey"), "user_id").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    counted = placed.groupBy(F.col("r_name").alias("region"), "event_type").agg(F.count("*").alias("reports"), F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("serious"), F.countDistinct("user_id").alias("users"))
    return counted.filter("reports >= 3").orderBy(F.desc("reports"), "region", "event_type")


QUERIES = {"co_reported_pairs": co_reported_pairs}
ORACLE_SQL = {
    "co_reported_pairs": """
SELECT r_name AS region, event_type, count(*) AS reports, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS serious, count(DISTINCT user_id) AS users
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events) e
JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL HAVING count(*) >= 3
""",
}
