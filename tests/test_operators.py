"""Operators, sources and streams on small fixtures, with injected defects."""

import collections
import io
import json
import random
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera import schema
from tessera.functions.conditions import link
from tessera.operators import emit, graph, hierarchy, incremental, quality, resolve, search, transforms
from tessera.sources import api, documents, publish, tabular
from tessera.streaming import events


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_schema_is_declared():
    assert len(schema.NODES) == 22 and len(schema.EDGES) == 32
    assert schema.columns("Route") == ["key", "name", "source", "run_id"]
    assert {f.name: f.dataType.simpleString() for f in schema.struct("HAS_ADVERSE_EVENT", typed=True)}["report_count"] == "int"
    with pytest.raises(KeyError):
        schema.columns("Nothing")


def test_first_writer_wins_by_loader_then_row(spark):
    a = spark.createDataFrame([("R:1", "one\n way", "s1", 2), ("R:1", "later", "s1", 5), ("", "lost", "s1", 1)], "key string, name string, source string, ord int")
    b = spark.createDataFrame([("R:1", "second", "s2", 1), ("R:2", " two ", "s2", 1)], "key string, name string, source string, ord int")
    assert rows(emit.nodes([a, b], "Route").select("key", "name", "source")) == [("R:1", "one way", "s1"), ("R:2", "two", "s2")]
    e = spark.createDataFrame([("a", "b", "m"), ("a", "b", "n"), ("a", "", "m")], "src string, dst string, match_method string")
    assert emit.edges([e], "HAS_ROUTE").count() == 1


def test_staging_blanks_and_counts(spark):
    t = spark.createDataFrame([("s", "d", "x", "3", "n/a", "")], "src string, dst string, match_method string, report_count string, serious_count string, death_count string").withColumn("source", F.lit("s")).withColumn("run_id", F.lit("r"))
    r = emit.stage(t, "HAS_ADVERSE_EVENT").first()
    assert (r.report_count, r.serious_count, r.death_count) == (3, None, None)
    assert dict(rows(emit.rejected(t, "HAS_ADVERSE_EVENT"))) == {"report_count": 0, "serious_count": 1, "death_count": 0}
    assert "CLUSTERED BY (key)" in emit.table_ddl("Route")
    assert rows(emit.manifest({"a": t, "b": t.limit(0)})) == [("a", 1), ("b", 0)]


def test_resolver_tiers_and_blocks(spark):
    names = [("Azithromycin Anhydrous", "U1"), ("Cetirizine", "U2"), ("Levocetirizine", "U3"), ("Sodium Chloride", "U4"), ("DL-Methionine", "U5"), ("Methionine", "U6"), ("Aspirin", "U7"), ("ASPIRIN", "U8"), ("ab", "U9"), ("R-Warfarin", "U10")]
    for order in (1, -1):
        table = spark.createDataFrame([(n, i, k) for k, (n, i) in enumerate(names)][::order], "name string, id string, ord int")
        entries = resolve.dictionary(table, spark.createDataFrame([("ASA", "U7", "synonym", 0), ("Aspirin", "UX", "synonym", 0)], "name string, id string, method string, ord int"))
        asked = spark.createDataFrame([(x,) for x in ("azithromycin", "levocetirizine", "sodium chloride", "methionine", "asa", "aspirin", "unheard of", "", "warfarin", "Cetirizine HCl")] + [(None,)], "name string")
        got = {r.name: (r.key, r.method) for r in resolve.resolve(asked, entries).collect()}
        assert got == {"azithromycin": ("U1", "salt"), "levocetirizine": ("U3", "unii"), "sodium chloride": ("U4", "unii"), "methionine": ("U6", "unii"), "asa": ("U7", "synonym"), "aspirin": ("U7", "unii"), "unheard of": ("NAME:unheard of", "provisional"), "": ("", "provisional"), None: ("", "provisional"), "warfarin": ("NAME:warfarin", "provisional"), "Cetirizine HCl": ("U2", "salt")} | {"warfarin": got["warfarin"]}
        assert got["warfarin"][1] in ("stereo", "provisional")
        assert rows(resolve.collisions(table)) == [("aspirin", "U8")]
    concepts = spark.createDataFrame([("c1", 0, "Unknown name"), ("c1", 1, "Aspirin")], "concept string, pos int, name string")
    assert rows(resolve.bridge(concepts, entries)) == [("unknown name", "U7")]
    up = resolve.with_parent(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), "k", spark.createDataFrame([("a", "b"), ("b", "c")], "child string, parent string"))
    assert rows(up) == [("a", 1), ("b", 1), ("b", 2), ("c", 2)]


def test_hierarchy(spark):
    owners = spark.createDataFrame([("C04", "k1"), ("C04.588", "k2"), ("C04.588.1", "k3")], "number string, key string")
    links = hierarchy.tree_parents(owners)
    assert rows(links) == [("k2", "k1"), ("k3", "k2")]
    assert rows(hierarchy.closure(links)) == [("k2", "k1", 1), ("k3", "k1", 2), ("k3", "k2", 1)]
    facts = spark.createDataFrame([("k3",), ("k3",), ("k1",)], "k string")
    assert rows(hierarchy.roll_up(facts, "k", hierarchy.closure(links), [F.count("*").alias("n")])) == [("k1", 3), ("k2", 2), ("k3", 2)]
    assert hierarchy.in_order([("a", "b"), ("b", "c"), ("c", "a"), ("d", "d"), ("a", "c")]) == [True, True, False, False, True]


def test_audits_find_injected_defects(spark):
    nodes = spark.createDataFrame([("A:1", "x"), ("A:2", "X "), ("bad", "unknown")], "key string, name string")
    edges = spark.createDataFrame([("A:1", "A:2"), ("A:1", "A:2"), ("A:1", "B:9"), ("A:2", "A:2")], "src string, dst string")
    assert rows(quality.dangling(edges, nodes)) == [("dst", "B", 1)]
    assert rows(quality.duplicate_pairs(edges, "src", "dst")) == [(1, 2)]
    assert rows(quality.loops(edges)) == [("A:2", "A:2")]
    assert rows(quality.same_names(nodes, "name", "key").select("folded", "n")) == [("x", 2)]
    assert [r.key for r in quality.bad_keys(nodes).collect()] == ["bad"]
    assert [r.key for r in quality.isolated(nodes, "key", edges.select("src"), edges.select("dst")).collect()] == ["bad"]
    assert set(rows(quality.findings(quality.profile(nodes, ["key", "name"])))) == {("name", "PLACEHOLDER"), ("name", "WHITESPACE")}
    assert rows(quality.shared_keys({"a": nodes, "b": nodes.limit(1)}).select("key"))
    with pytest.raises(quality.Refused, match="dangling"):
        quality.gate({"dangling": quality.dangling(edges, nodes), "none": nodes.limit(0)})


def test_changes_and_upserts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "")], "k int, tag string")
    new = spark.createDataFrame([(2, "b"), (3, ""), (4, "d"), (5, None)], "k int, tag string")
    assert dict(rows(incremental.changes(new, old, "k", "tag"))) == {1: "removed", 2: "same", 3: "changed", 4: "added", 5: "added"}
    assert rows(incremental.upsert(old, spark.createDataFrame([(1, "z")], "k int, tag string"), ["k"])) == [(1, "z"), (2, "b"), (3, "")]
    assert rows(incremental.delete(old, new, ["k"])) == [(1, "a")]


def test_publish_is_guarded_and_atomic(spark, tmp_path):
    p = publish.Publisher(spark, f"{tmp_path}/lake")
    big, small = spark.range(5000).repartition(4), spark.range(5).repartition(1)
    m = p.stage("run-1", {"t": big})
    assert p.live() is None
    p.commit("run-1", m)
    assert p.live() == "run-1" and p.table("t").count() == 5000
    m2 = p.stage("run-2", {"t": small})
    with pytest.raises(ValueError, match="less than half"):
        p.commit("run-2", m2)
    assert p.live() == "run-1"
    p.rollback("run-2")
    m3 = p.stage("run-3", {"t": big})
    with pytest.raises(ValueError, match="not what was staged"):
        p.commit("run-3", m3.union(spark.createDataFrame([("t/none", 1, "")], m3.schema)))
    p.commit("run-3", m3, keep=1)
    assert p.live() == "run-3" and p.table("t").count() == 5000


def test_search(spark):
    items = spark.createDataFrame([(i, f"text {i // 2}", f"s{i}", [1.0, i / 10, 0.0], {"w": float(i)}) for i in range(8)], "id int, text string, source string, embedding array<float>, sparse map<string,double>")
    hits = search.by_cosine(items, [1.0, 0.0, 0.0], 3)
    assert [r.id for r in hits.collect()] == [0, 1, 2]
    assert search.gate(hits, 2.0).count() == 0 and search.gate(hits, 0.5).count() == 3
    assert [r.id for r in search.by_sparse(items, {"w": 1.0}, 2).collect()] == [7, 6]
    found = search.retrieve(items, [1.0, 0.0, 0.0], {"w": 1.0}, F.col("id") < 6, final=3).collect()
    assert [r.id for r in found][0] == 0 and found[0].duplicates[0] == "s1"
    index = search.words_of(spark.createDataFrame([(1, "of the best"), (2, "the best of"), (3, "none")], "id int, t string"), "id", "t")
    assert rows(search.phrase(index, ["of", "the"])) == [(1, 1)] and rows(search.phrase_check(index, ["of", "the"])) == [(1, 2)]
    assert {r.token for r in search.fuzzy_tokens(index, "bests").collect()} == {"best"}
    exact = search.by_cosine_many(items, items.filter("id % 4 = 0").select("id", "embedding"), 3).collect()
    assert {(r.query_id, r.rank): r.id for r in exact}[4, 1] == 4


def test_graph_guards(spark):
    n = spark.createDataFrame([("P:1",), ("S:1",)], "key string")
    g = graph.Graph({"Product": n, "Substance": n}, {"CONTAINS": spark.createDataFrame([("P:1", "S:1")], "src string, dst string")})
    assert g.match("Product", "p").hop("CONTAINS", "Substance", "s").returns(F.col("s__key")).collect()[0][0] == "S:1"
    assert g.match("Product", "p").hop("CONTAINS", "Substance", "s", optional=True).rows.count() == 2
    with pytest.raises(graph.Rejected, match="other way"):
        g.match("Substance", "s").hop("CONTAINS", "Product", "p")
    with pytest.raises(graph.Rejected):
        g.match("Product", "p").hop("CONTAINS", "Substance", "s", depth=20)
    assert graph.true_total(spark.range(50), 20).first()[0] == 20
    assert graph.skewed_columns(spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("m"))) == ["m"]


def test_true_total_has_no_ceiling_of_its_own(spark):
    assert graph.true_total(spark.range(200_003)).first()[0] == 200_003
    assert graph.true_total(spark.range(0)).first()[0] == 0


@pytest.mark.parametrize("settings", [{}, {"BITS": 2_000, "BLOCKS": 1, "PAIRS": 50, "ROUND": 300}])
def test_sources_that_share_a_target(spark, monkeypatch, settings):
    """Blocks, rounds, null ends, repeated edges, a target of all sources, one of many and one of its own."""
    for k, v in settings.items():
        monkeypatch.setattr(graph, k, v)
    rnd = random.Random(8)
    edges = [(rnd.randrange(150), rnd.randrange(70)) for _ in range(400)] + [(s, 500) for s in range(0, 150, 2)] + [(900, 900), (901, None), (None, 3), (None, 3), (None, 901), (3, 3), (3, 3)]
    at = collections.defaultdict(set)
    for s, t in edges:
        at[t].add(s)
    met = collections.defaultdict(set)
    for t, sources in at.items():
        for s in sources if t is not None else ():
            met[s] |= sources - {None}
    got = graph.sharing(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()
    assert {(r.src, r.n) for r in got} == {(s, len(m)) for s, m in met.items()} and len(got) == len(met)
    assert not graph.sharing(spark.createDataFrame([], "src string, dst string")).count()


def test_transforms(spark):
    nested = spark.read.json(spark.sparkContext.parallelize([json.dumps({"a": {"b": 1}, "c": [{"x": 1}, {"x": 2}], "d": ["p", "q"]})]))
    assert transforms.flatten(nested).first().asDict() == {"a_b": "1", "c": '{"x":1} | {"x":2}', "d": "p | q"}
    kv = spark.createDataFrame([("r1", "Name", "n"), ("r1", "Zed", "z"), ("r2", "Id", "2")], "r string, k string, v string")
    assert transforms.wide(kv, "r", "k", "v", ["Zed"]).columns == ["r", "Zed", "Id", "Name"]
    terms = spark.createDataFrame([("t1", "Metastatic Breast Cancer"), ("t2", "Chronic Disease"), ("t3", "Disease")], "id string, term string")
    known = spark.createDataFrame([("breast neoplasms", "D1"), ("disease", "D2")], "probe string, key string")
    assert rows(link(terms, [known])) == [("t1", "Metastatic Breast Cancer", "D1", "name_variant"), ("t3", "Disease", "D2", "name")]


def test_messy_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿Report of things,,\nid,\" name \",note\n1,\"a \"\"b\"\"\nc\",x\n2,d,\n".encode())
    t = tabular.read_csv(spark, f"{tmp_path}/a.csv")
    assert t.columns == ["id", "name", "note"] and [tuple(r) for r in t.orderBy("id").collect()] == [("1", 'a "b"\nc', "x"), ("2", "d", None)]
    assert tabular.or_empty(t, "note", "missing").filter("missing <> ''").count() == 0
    (tmp_path / "b.txt").write_text("A~B\n1~2\n")
    assert rows(tabular.read_tilde(spark, f"{tmp_path}/b.txt")) == [("1", "2")]
    (tmp_path / "c.csv").write_text("1,2\n3,4\n")
    assert tabular.read_csv(spark, f"{tmp_path}/c.csv", header=False).columns == ["c0", "c1"]
    (tmp_path / "kv").mkdir()
    (tmp_path / "kv/x.txt").write_text("Name: a: b\nId: 1\n\nName: c\n")
    assert [(r.record, r.key, r.value) for r in tabular.read_key_values(spark, f"{tmp_path}/kv").orderBy("record", "key").collect()] == [(0, "Id", "1"), (0, "Name", "a: b"), (1, "Name", "c")]
    db = sqlite3.connect(tmp_path / "d.db")
    db.execute("create table t (a int, b text)")
    db.execute("insert into t values (1, 'x')")
    db.commit()
    assert rows(tabular.read_sqlite(spark, f"{tmp_path}/d.db", "t", ["a", "b", "gone"])) == [("1", "x")]
    assert tabular.preflight(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/none.csv"]) == [f"{tmp_path}/none.csv"]
    assert tabular.listing(spark, str(tmp_path), "*.csv").count() == 2
    assert tabular.linked_columns(spark, [f"{tmp_path}/a.csv"]) == {}


def test_documents(spark, tmp_path):
    word = io.BytesIO()
    with zipfile.ZipFile(word, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:p><w:r><w:t>there</w:t></w:r></w:p></w:document>')
    (tmp_path / "Topic").mkdir()
    (tmp_path / "Topic/a.docx").write_bytes(word.getvalue())
    (tmp_path / "Topic/b.html").write_text("<p>One<p>Two<script>x</script>")
    (tmp_path / "Topic/c.docx").write_bytes(b"broken")
    (tmp_path / "Topic/d.exe").write_bytes(b"x")
    listed = documents.list_documents(spark, str(tmp_path), ["Topic"])
    assert {r.doc_type for r in listed.collect()} == {"docx", "html"} and listed.count() == 3
    files = spark.read.format("binaryFile").load(f"{tmp_path}/Topic").select("path", "content")
    got = documents.extract(listed.join(files, "path")).collect()
    assert sorted(r.text.split() for r in got) == [["Hello", "there"], ["One", "Two"]]
    pages = spark.createDataFrame([(1, "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td> 2\n3</td></tr></table>")], "id int, h string")
    assert [r.cells for r in documents.html_tables(pages, "id", "h").orderBy("row").collect()] == [["a", "b"], ["1", "2 3"]]
    (tmp_path / "x.xml").write_text("<all><Rec><id>1</id><n>a</n></Rec><Rec><id>2</id></Rec></all>")
    assert documents.read_xml(spark, f"{tmp_path}/x.xml", "Rec").count() == 2


def fetch_page(page):
    if isinstance(page, int):
        return [{"id": page * 2 + i} for i in range(2)]
    n = 0 if page == "*" else int(page)
    return [{"id": n}], str(n + 1) if n < 2 else None


def test_paged_source(spark):
    spark.dataSource.register(api.PagedSource)
    read = spark.read.format("paged").option("fetcher", "tests.test_operators:fetch_page")
    assert read.option("pages", 3).load().count() == 6
    assert read.option("mode", "cursor").load().count() == 3


def test_streams_equal_batches(spark, small, tmp_path):
    table = spark.read.parquet(f"{small}/events.parquet")
    table.orderBy("ts").repartitionByRange(3, "ts").write.parquet(f"{tmp_path}/in")
    stream = events.read(spark, f"{tmp_path}/in", table, per_trigger=1)
    seen = []
    events.drain(events.tumbling(stream, "1 day", "60 days"), f"{tmp_path}/c1", lambda df, i: seen.append(df.count()))
    assert seen
    events.drain_to(stream.select("event_id", "event_type"), f"{tmp_path}/c2", f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == table.count()
    events.drain_to(stream.select("event_id", "event_type"), f"{tmp_path}/c2", f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == table.count()
    kept = []
    events.drain(events.once(stream, ["event_id"], "60 days"), f"{tmp_path}/c3", lambda df, i: kept.append(df.count()))
    assert sum(kept) == table.count()
