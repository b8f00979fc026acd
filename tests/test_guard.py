"""The guard decides on plans: words in names and texts don't matter, hidden commands and missing bounds do."""

import pytest

from tessera.operators import guard


@pytest.fixture(scope="module")
def tables(spark):
    spark.range(1000).selectExpr("id", "id % 7 as load", "cast(id as string) as `set`").createOrReplaceTempView("g_t")
    spark.range(500).selectExpr("id", "id % 5 as k").createOrReplaceTempView("g_u")


@pytest.mark.parametrize(
    "sql, rows",
    [
        ("select load, `set` from g_t", 300),
        ("select 'drop table x; delete' as s from g_t", 300),
        ("select id, (select count(*) from g_u) as c from g_t", 300),
        ("select count(*) from g_t", 1),
        ("select load, count(*) from g_t group by load having count(*) > 1 order by 2", 7),
        ("with a as (select * from g_t) select load, sum(id) from a group by load", 7),
        ("select * from (select * from g_t limit 400) x where id >= 0", 400),
        ("select id from g_t order by id limit 450", 450),
        ("select distinct id from g_t", 300),
        ("select g_t.id from g_t, g_u where g_t.id = g_u.id", 300),
        ("select id, m from g_t, (select max(k) as m from g_u)", 300),
        ("select id from g_t where exists (select 1 from g_u where g_u.id = g_t.id) union all select id from g_t", 300),
        ("with recursive r(n) max recursion level 10 as (select 1 union all select n + 1 from r where n < 5) select * from r", 5),
        ("with recursive r(n) as (select 1) select * from r", 1),
    ],
)
def test_what_may_run(spark, tables, sql, rows):
    assert guard.checked(spark, sql).count() == rows


@pytest.mark.parametrize(
    "sql, why",
    [
        ("drop table g_t", "DropTable"),
        ("insert into g_t select * from g_u", "InsertIntoStatement"),
        ("create table z as select count(*) from g_t", "CreateTable"),
        ("set spark.sql.ansi.enabled=false", "SetCommand"),
        ("cache table g_t", "CacheTable"),
        ("merge into g_t using g_u on g_t.id = g_u.id when matched then delete", "MergeIntoTable"),
        ("select transform(id) using 'cat' as (a) from g_t", "ScriptTransformation"),
        ("select * from g_t, g_u limit 5", "no condition"),
        ("select count(*) from g_t cross join g_u", "no condition"),
        ("with recursive r(n) as (select 1 union all select n + 1 from r where n < 5) select * from r limit 3", "RECURSION LEVEL"),
        ("select * from (with recursive r(n) as (select 1 union all select n + 1 from r) select * from r) limit 3", "RECURSION LEVEL"),
        ("select id in (select * from parquet.`/nowhere`) from g_t", "path"),
        ("select reflect('java.lang.System', 'getProperty', 'user.name')", "other code"),
        ("select id from g_t where id in (select java_method('java.lang.Math', 'abs', 1))", "other code"),
        ("selec 1", "can't be read"),
    ],
)
def test_what_may_not(spark, tables, sql, why):
    with pytest.raises(guard.Refused, match=why):
        guard.checked(spark, sql)
