"""Keyed streaming state: streams equal batches, also after a kill in the middle; timers."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tessera.streaming import events, state

START = datetime.datetime(2024, 1, 1)


def write(spark, rows, schema, folder, parts):
    """Parts in order, one file each."""
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def brute_runs(rows):
    out = []
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[2])
        for kind, group in itertools.groupby(own, key=lambda r: r[1]):
            group = list(group)
            out.append((key, kind, group[0][2], len(group)))
    return sorted(out)


def test_runs_after_a_kill(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(rnd.randrange(4), rnd.choice("ab"), i, at(i)) for i in range(200)]
    schema = "key bigint, kind string, ord bigint, ts timestamp"
    write(spark, rows, schema, f"{tmp_path}/in", 5)
    stream = events.read(spark, f"{tmp_path}/in", spark.createDataFrame([], schema), 1)
    out = state.runs(stream, idle=10**9)

    def part(df, i):
        if i == 2 and not (tmp_path / "killed").exists():
            (tmp_path / "killed").touch()
            raise RuntimeError("killed in the middle")
        df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={i}")

    with state.kept_state(spark):
        with pytest.raises(Exception, match="killed"):
            events.drain(out, f"{tmp_path}/c", part)
        assert len(list((tmp_path / "out").glob("batch=*"))) == 2
        events.drain(out, f"{tmp_path}/c", part)
    told = spark.read.parquet(f"{tmp_path}/out")
    last = told.groupBy("key", "kind", "first").agg(F.max("run").alias("run"), F.count_if("closed").alias("closed"))
    assert sorted(tuple(r)[:4] for r in last.collect()) == brute_runs(rows)
    # A run is closed once; the last one of each key stays open.
    assert sorted(r.closed for r in last.collect()) == [0] * 4 + [1] * (len(brute_runs(rows)) - 4)


def test_an_idle_run_is_closed_by_its_timer(spark, tmp_path):
    schema = "key bigint, kind string, ord bigint, ts timestamp"
    write(spark, [(1, "a", 0, at(0)), (1, "a", 1, at(1)), (2, "b", 2, at(500)), (2, "b", 3, at(501))], schema, f"{tmp_path}/in", 2)
    stream = events.read(spark, f"{tmp_path}/in", spark.createDataFrame([], schema), 1)
    found = state.drain_to(state.runs(stream, idle=3_600_000), f"{tmp_path}/c", f"{tmp_path}/out")
    assert sorted(tuple(r) for r in found.filter("closed").collect()) == [(1, "a", 0, 2, True)]


def test_cursors_go_on_after_a_restart(spark, tmp_path):
    schema = "key string, cursor bigint, rows bigint"
    (tmp_path / "in").mkdir()
    stream = events.read(spark, f"{tmp_path}/in", spark.createDataFrame([], schema), 1)
    write(spark, [("s", 1, 10), ("s", 2, 20), ("t", 5, 50)], schema, f"{tmp_path}/in", 1)
    state.drain_to(state.cursors(stream), f"{tmp_path}/c", f"{tmp_path}/out")
    write(spark, [("s", 2, 20), ("s", 3, 30), ("t", 4, 40), ("s", 3, 30), ("u", 1, 1)], schema, f"{tmp_path}/in", 1)
    found = state.drain_to(state.cursors(stream), f"{tmp_path}/c", f"{tmp_path}/out")
    assert sorted(tuple(r) for r in found.collect()) == [("s", 1, 10), ("s", 2, 20), ("s", 3, 30), ("t", 5, 50), ("u", 1, 1)]


def test_one_run_at_a_time(spark, tmp_path):
    schema = "key string, run string, what string, ts timestamp"
    (tmp_path / "in").mkdir()
    stream = events.read(spark, f"{tmp_path}/in", spark.createDataFrame([], schema), 1)
    first = [("j", "r1", "start", at(0)), ("j", "r2", "start", at(1)), ("k", "x", "start", at(1)), ("j", "r2", "end", at(2)), ("j", "r1", "end", at(3)), ("j", "r3", "start", at(4))]
    later = [("j", "r4", "start", at(30)), ("j", "r5", "start", at(65)), ("k", "x", "end", at(66))]
    for rows in (first, later, [("z", "n", "start", at(300))]):
        write(spark, rows, schema, f"{tmp_path}/in", 1)
        found = state.drain_to(state.one_run(stream, 3_600_000), f"{tmp_path}/c", f"{tmp_path}/out")
    verdicts = sorted((r.key, r.run, r.verdict) for r in found.collect())
    # r3 and x outlive their lease of an hour; r5 does too, by its timer, as z comes much later.
    assert verdicts == sorted([
        ("j", "r1", "started"), ("j", "r2", "refused"), ("j", "r2", "unknown"), ("j", "r1", "ended"), ("j", "r3", "started"), ("j", "r4", "refused"), ("j", "r3", "expired"), ("j", "r5", "started"),
        ("j", "r5", "expired"), ("k", "x", "started"), ("k", "x", "expired"), ("k", "x", "unknown"), ("z", "n", "started"),
    ])
