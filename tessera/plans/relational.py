"""Scans, projections, joins, aggregates, windows and sets over the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.text import first_filled
from tessera.operators import graph, incremental, transforms
from tessera.plans.registry import Plans

P = Plans()
query = P.query
_money = "decimal(18,2)"


def _sum(c):
    """An exact sum of money."""
    return F.sum(F.col(c).cast(_money)).cast("double")


@query("SELECT p_partkey, p_name, p_size FROM part WHERE contains(p_name, 'red') OR contains(p_name, 'anvil')")
def slice_predicate(read):
    """Rows whose name contains a term of a slice."""
    terms = F.array(F.lit("red"), F.lit("anvil"))
    return read("part").filter(F.exists(terms, lambda t: F.col("p_name").contains(t))).select("p_partkey", "p_name", "p_size")


@query("SELECT p_partkey, trim(p_name) AS name, coalesce(nullif(p_brand, ''), p_type) AS label FROM part WHERE p_size BETWEEN 5 AND 20 AND p_brand <> 'Brand#4'")
def projection_with_fallback(read):
    """Trimmed projection, fallback of an empty cell, filled rows only."""
    return read("part").filter("p_size between 5 and 20 and p_brand <> 'Brand#4'").select("p_partkey", F.trim("p_name").alias("name"), first_filled(F.col("p_brand"), F.col("p_type")).alias("label"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_name LIKE 'NATION_1%' AND n_regionkey IN (0, 1, 2) AND NOT regexp_matches(n_name, '5$') AND n_name IS NOT NULL")
def pattern_predicates(read):
    """P20: prefixes, membership, negated patterns, filled values."""
    return read("nation").filter(F.col("n_name").startswith("NATION_1") & F.col("n_regionkey").isin(0, 1, 2) & ~F.col("n_name").rlike("5$") & F.col("n_name").isNotNull()).select("n_nationkey", "n_name")


@query("SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name), '00012') ORDER BY c_custkey LIMIT 20")
def substring_search(read):
    """Substring search over a field, the first 20."""
    return read("customer").filter(F.lower("c_name").contains("00012")).orderBy("c_custkey").limit(20).select("c_custkey", "c_name")


@query("""SELECT r_name, n_name, p_brand, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE o_orderstatus = 'F' GROUP BY ALL""")
def star_join(read):
    """A star join on integer keys, aggregated."""
    lines = read("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    joined = lines.join(read("orders").filter("o_orderstatus = 'F'").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(read("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    placed = joined.join(read("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return placed.groupBy("r_name", "n_name", "p_brand").agg(F.count("*").alias("n_lines"), _sum("l_extendedprice").alias("revenue"))


@query("""SELECT o_orderkey, o_orderpriority, coalesce(n, 0) AS n_flags, coalesce(flags, '') AS flags FROM orders LEFT JOIN
(SELECT l_orderkey, count(*) AS n, string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def left_join_packed_list(read):
    """A left join with counts and packed lists."""
    out = transforms.with_list(read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), read("lineitem").select("l_orderkey", "l_returnflag"), ["l_orderkey"], "l_returnflag", "flags")
    return out.select(F.col("l_orderkey").alias("o_orderkey"), "o_orderpriority", "n_flags", "flags")


@query("SELECT l_orderkey, l_linenumber, p_name, p_retailprice FROM lineitem JOIN part ON l_partkey = p_partkey AND l_linenumber = p_size")
def composite_key_join(read):
    """A join on two columns."""
    part = read("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("l_linenumber"), "p_name", "p_retailprice")
    return read("lineitem").select("l_partkey", "l_linenumber", "l_orderkey").join(part, ["l_partkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "p_name", "p_retailprice")


@query("SELECT a.p_partkey AS part, b.p_partkey AS reference FROM part a JOIN (SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1) b ON a.p_name = b.p_name AND a.p_partkey <> b.p_partkey")
def self_join_to_reference(read):
    """Parts and the first part of their name."""
    part = read("part")
    first = part.groupBy("p_name").agg(F.min("p_partkey").alias("reference"))
    return part.join(first, "p_name").filter("p_partkey <> reference").select(F.col("p_partkey").alias("part"), "reference")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_lines(read):
    """What has no partner."""
    return read("orders").select("o_orderkey").join(read("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def customers_with_urgent_orders(read):
    """What has a partner, once."""
    urgent = read("orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return read("customer").join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT page_id, prefix FROM pages JOIN (VALUES ('https://blog.'), ('http://blog.'), ('https://the')) d(prefix) ON starts_with(url, prefix)")
def prefix_join(read):
    """Declared prefixes against what is read; the declared side is a constant."""
    pages = read("pages").select("page_id", "url")
    declared = F.broadcast(pages.sparkSession.createDataFrame([("https://blog.",), ("http://blog.",), ("https://the",)], "prefix string"))
    return pages.join(declared, F.col("url").startswith(F.col("prefix"))).select("page_id", "prefix")


@query("""SELECT c_custkey, count(o_orderkey) AS n_orders, coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') :: DATE AS last_day FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def optional_match(read):
    """An optional pattern keeps what does not match."""
    orders = read("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.max(F.to_date("o_orderdate")).alias("last_day"))
    return read("customer").select("c_custkey").join(orders, "c_custkey", "left").select("c_custkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.coalesce("last_day", F.lit("1900-01-01").cast("date")).alias("last_day"))


_PAIR_SQL = """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, max(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS high FROM events GROUP BY ALL)
SELECT a.event_type AS first_type, b.event_type AS second_type, count(*) AS n, CAST(sum(a.high) AS BIGINT) AS high FROM d a JOIN d b ON a.user_id = b.user_id AND a.day = b.day AND a.event_type < b.event_type GROUP BY 1, 2 HAVING count(*) >= 3"""


@query(_PAIR_SQL)
def pairs_inside_a_case(read):
    """Pairs inside a user's day, each day once, from a floor up."""
    days = read("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("types"), F.collect_set(F.when(F.col("value") > 20, F.col("event_type"))).alias("highs"))
    both = transforms.cross_inside(days.withColumn("first_type", F.col("types")).withColumn("second_type", F.col("types")), "first_type", "second_type").filter("first_type < second_type")
    return both.groupBy("first_type", "second_type").agg(F.count("*").alias("n"), F.sum(F.array_contains("highs", F.col("first_type")).cast("int")).alias("high")).filter("n >= 3")


@query("""SELECT user_id, event_type, count(*) AS n, CAST(sum(serious) AS BIGINT) AS serious FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_type, max(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS serious FROM events GROUP BY ALL) GROUP BY 1, 2 HAVING count(*) >= 3""")
def counts_once_per_case(read):
    """Reports counted once a case, with flags."""
    return transforms.cases(read("events").withColumn("day", F.to_date("ts")), "day", "user_id", "event_type", {"serious": F.col("value") > 20})


@query("""SELECT l_suppkey, l_partkey, l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1""")
def best_row_per_pair(read):
    """The row with the highest score of each pair, by partial aggregates."""
    rank = F.struct(F.col("l_extendedprice"), -F.col("l_orderkey"), -F.col("l_linenumber"))
    best = read("lineitem").groupBy("l_suppkey", "l_partkey").agg(F.max_by(F.struct("l_orderkey", "l_extendedprice"), rank).alias("w"))
    return best.select("l_suppkey", "l_partkey", "w.l_orderkey", "w.l_extendedprice")


@query("SELECT o_custkey, min(o_orderkey) AS first_order, count(*) AS n, list_sort(list(DISTINCT o_orderstatus)) AS states FROM orders GROUP BY 1")
def first_and_collected(read):
    """The first value and the set of values of a key."""
    return read("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"), F.count("*").alias("n"), F.array_sort(F.collect_set("o_orderstatus")).alias("states"))


@query("SELECT user_id, coalesce(max(event_id) FILTER (event_type = 'click'), -1) AS click, coalesce(max(event_id) FILTER (event_type = 'error'), -1) AS error, coalesce(max(event_id) FILTER (event_type = 'view'), -1) AS view FROM events GROUP BY 1")
def pivot_by_type(read):
    """A column for each attribute, with its last value."""
    return read("events").groupBy("user_id").pivot("event_type", ["click", "error", "view"]).agg(F.max("event_id")).na.fill(-1)


@query("""SELECT * FROM (SELECT 'event_type' AS facet, event_type AS value, count(*) AS n FROM events GROUP BY 2) UNION ALL SELECT * FROM (SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) AS n FROM events GROUP BY 2 ORDER BY n DESC, 2 LIMIT 1000)""")
def facet_counts(read):
    """Counts of several columns."""
    return transforms.facets(read("events"), ["event_type", "user_id"])


@query("""SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.88) AS p88, max(l_quantity) AS most FROM lineitem GROUP BY 1""")
def percentiles(read):
    """Exact percentiles with linear interpolation."""
    return read("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.percentile("l_quantity", F.lit(0.5)).alias("p50"), F.percentile("l_quantity", F.lit(0.88)).alias("p88"), F.max("l_quantity").alias("most"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 4) AS percent FROM orders GROUP BY 1, 2")
def shares_within_groups(read):
    """Distributions and percentages."""
    counted = read("orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("o_orderpriority"))
    return counted.withColumn("percent", F.round(100.0 * F.col("n") / total, 4))


@query("SELECT 'customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier")
def live_counts(read):
    """Rows of every table."""
    return graph.Graph({t: read(t) for t in ("customer", "orders", "part", "supplier")}, {}).counts()


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, count(*) - count(DISTINCT l_orderkey) AS n_repeated FROM lineitem")
def repeats_before_dedupe(read):
    """Rows that a dedupe would drop."""
    return read("lineitem").agg(F.count("*").alias("n_rows"), F.countDistinct("l_orderkey").alias("n_orders")).withColumn("n_repeated", F.col("n_rows") - F.col("n_orders"))


@query("SELECT conv_id, turn, role, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS offset_no FROM conversations")
def neighbours_and_offsets(read):
    """The neighbour before, and offsets in a group."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return read("conversations").select("conv_id", "turn", "role", F.coalesce(F.lag("role").over(w), F.lit("")).alias("before"), (F.row_number().over(w) - 1).cast("long").alias("offset_no"))


@query("""SELECT user_id, event_type, count(*) AS run, min(event_id) AS first_event FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS island FROM events) GROUP BY user_id, event_type, island HAVING count(*) >= 3""")
def runs_of_equal_types(read):
    """Runs of at least three equal values in a row."""
    island = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id"))
    return read("events").withColumn("island", island).groupBy("user_id", "event_type", "island").agg(F.count("*").alias("run"), F.min("event_id").alias("first_event")).filter("run >= 3").drop("island")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r <= 3")
def latest_of_each(read):
    """The last three of each group."""
    return incremental.keep_latest(read("orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 3)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def top_orders(read):
    """The top k with a total order."""
    return read("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15)


@query("""SELECT c_name, n, CAST(spent AS DOUBLE) AS spent FROM (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10) JOIN customer ON c_custkey = o_custkey""")
def aggregate_early(read):
    """The top of an aggregate before the join that expands it."""
    top = read("orders").groupBy("o_custkey").agg(F.count("*").alias("n"), _sum("o_totalprice").alias("spent")).orderBy(F.desc("n"), "o_custkey").limit(10)
    return read("customer").join(F.broadcast(top), F.col("c_custkey") == F.col("o_custkey")).select("c_name", "n", "spent")


@query("SELECT count(*) AS total FROM orders WHERE o_orderpriority = '2-HIGH'")
def total_behind_limit(read):
    """The true total of a limited result."""
    return graph.true_total(read("orders").filter("o_orderpriority = '2-HIGH'"))


@query("SELECT c_mktsegment AS value, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY n DESC, value LIMIT 30")
def breakdown_of_result(read):
    """The whole result by its skewed column."""
    return graph.breakdown(read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")), "c_mktsegment")


@query("SELECT p_type, p_partkey FROM (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY md5(CAST(p_partkey AS VARCHAR))) AS r FROM part) WHERE r <= 5")
def seeded_quota(read):
    """A fixed random quota of each stratum."""
    w = Window.partitionBy("p_type").orderBy(F.md5(F.col("p_partkey").cast("string")))
    return read("part").select("p_type", "p_partkey", F.row_number().over(w).alias("r")).filter("r <= 5").drop("r")


@query("""SELECT DISTINCT nation AS n FROM (SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier) WHERE nation IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)""")
def set_operations(read):
    """Union, intersection, difference."""
    keys = read("customer").select(F.col("c_nationkey").alias("n")).union(read("supplier").select("s_nationkey")).distinct()
    some = read("nation").filter("n_regionkey < 3").select("n_nationkey").subtract(read("supplier").filter("s_acctbal < 0").select("s_nationkey"))
    return keys.intersect(some)


@query("SELECT id, kind, coalesce(balance, 0) AS balance, coalesce(segment, '') AS segment FROM (SELECT c_custkey AS id, 'customer' AS kind, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL BY NAME SELECT s_suppkey AS id, 'supplier' AS kind, s_acctbal AS balance FROM supplier)")
def union_by_name(read):
    """Tables with different columns, by name."""
    c = read("customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = read("supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True).na.fill({"balance": 0.0, "segment": ""})


_OLD = "SELECT doc_id AS id, md5(text) AS tag FROM documents WHERE doc_id % 7 <> 0"
_NEW = "SELECT doc_id AS id, CASE WHEN doc_id % 11 = 0 THEN md5(text || 'x') WHEN doc_id % 13 = 0 THEN '' ELSE md5(text) END AS tag FROM documents WHERE doc_id % 5 <> 0"


@query(f"""SELECT coalesce(n.id, o.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN n.tag = '' OR n.tag <> o.tag THEN 'changed' ELSE 'same' END AS change
FROM ({_NEW}) n FULL JOIN ({_OLD}) o ON n.id = o.id""")
def changes_by_tag(read):
    """What was added, changed, removed between two listings."""
    docs = read("documents").select(F.col("doc_id").alias("id"), "text")
    old = docs.filter("id % 7 <> 0").select("id", F.md5("text").alias("tag"))
    new = docs.filter("id % 5 <> 0").select("id", F.when(F.col("id") % 11 == 0, F.md5(F.concat("text", F.lit("x")))).when(F.col("id") % 13 == 0, "").otherwise(F.md5("text")).alias("tag"))
    return incremental.changes(new, old, "id", "tag")


@query("""SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 10 <> 3 UNION ALL SELECT c_custkey, c_acctbal + 1 FROM customer WHERE c_custkey % 10 = 3""")
def upsert_by_key(read):
    """Replacement of rows by key."""
    old = read("customer").select("c_custkey", "c_acctbal")
    return incremental.upsert(old, old.filter("c_custkey % 10 = 3").withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])


@query("""SELECT o_orderkey AS key, CASE WHEN l.k IS NULL THEN 'missing' ELSE 'size' END AS problem FROM (SELECT o_orderkey, 4 AS want FROM orders) o LEFT JOIN (SELECT l_orderkey AS k, count(*) AS have FROM lineitem GROUP BY 1) l ON k = o_orderkey WHERE k IS NULL OR want <> have""")
def manifest_check(read):
    """Expected and actual sizes compared."""
    want = read("orders").select(F.col("o_orderkey").alias("key"), F.lit(4).cast("long").alias("size"))
    have = read("lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("size"))
    return incremental.verify(want, have, "key", "size")
