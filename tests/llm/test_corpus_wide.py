"""The conversation trie, importance resampling and exact duplicates against brute force."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import exact, importance, queries, trie

TURNS = "conv_id bigint, turn int, role string, text string"


def brute_trie(rows, every=100, heads=6):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((-1 if turn is None else turn, role or "", text or ""))
    own = {c: [x[1:] for x in sorted(t, key=lambda x: x[0])] for c, t in own.items()}
    members = collections.defaultdict(list)
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        t = own.get(c - c % every, [])[:h] + t[h:]
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append((c, len(t)))
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        n = len(members[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + (n - 1) * (len(node[-1][1]) if node else 0)
    least = {node: min(c for c, _ in m) for node, m in members.items()}
    digest = lambda node: hashlib.sha256(",".join(map(str, sorted(c for c, n in members[node] if n == len(node)))).encode()).hexdigest()
    return sorted((least[v], len(v), least[v[:-1]] if v else None, len(members[v]), len(children[v]), leaves[v], saved[v], digest(v)) for v in members)


def rows_of(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r[c] for c in names) for r in frame.collect())


def conversations(n, rnd, words=2, longest=7):
    out = []
    for c in rnd.sample(range(20 * n), n):
        out += [(c, k, rnd.choice(["user", "assistant"]) if rnd.random() < 0.1 else "user", rnd.choice(["a", "bé", ""][:words])) for k in range(rnd.randrange(longest))]
    return out


@pytest.mark.parametrize("size", [(1 << 13, 1 << 16), (3, 1 << 16), (1, 1), (7, 9)])
def test_trie_equals_brute_force(spark, monkeypatch, size):
    """Nodes that span many blocks, and blocks of a single sequence."""
    monkeypatch.setattr(trie, "BLOCK_ROWS", size[0])
    monkeypatch.setattr(trie, "BLOCK_TURNS", size[1])
    rnd = random.Random(size[0])
    rows = conversations(120, rnd) + [(5_000, k, "user", "a") for k in range(40)] + [(5_001, k, "user", "a") for k in range(41)] + [(c, k, "user", "same") for c in range(6_000, 6_060) for k in range(3)]
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    assert rows_of(trie.rebuilt_nodes(frame)) == brute_trie(rows)


def test_trie_of_the_table(spark, small):
    frame = spark.read.parquet(f"{small}/conversations.parquet")
    assert rows_of(queries.op11_prefix_trie(spark, small)) == brute_trie([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def test_trie_of_awkward_rows(spark):
    """Nulls in every column, repeated rows, conversations left without a turn, other columns of clashing names."""
    rows = [(1, None, None, None), (1, 2, "user", "x"), (1, 2, "user", "x"), (2, 0, "", ""), (None, 0, "user", "x"), (3, 0, "user", "y" * 50_000), (100, None, "a", "b"), (100, 0, "a", "b"), (7, 5, "user", "z")]
    frame = spark.createDataFrame(rows, TURNS)
    for clash in ("block", "depth", "key", "id", "up_id"):
        frame = frame.withColumn(clash, F.lit(clash))
    assert rows_of(trie.rebuilt_nodes(frame)) == brute_trie(rows)
    assert rows_of(trie.rebuilt_nodes(frame.limit(0))) == []


def test_nearest_smaller_values():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 50):
        v = rnd.integers(0, 5, n)
        before, after = trie.smaller_values(v)
        for j in range(n):
            assert before[j] == max([k for k in range(j) if v[k] < v[j]], default=-1)
            assert after[j] == min([k for k in range(j + 1, n) if v[k] < v[j]], default=n)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, depth=2):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, depth + 1) for i in range(len(words) - k + 1)]


def brute_draw(docs, target, depth=2, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(bucket(f) for _, text in docs for f in features(text, depth)[1])
    t = collections.Counter(bucket(f) for text in target for f in features(text, depth)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in s}
    out = []
    for i, text in docs:
        n, own = features(text, depth)
        weight = math.floor(sum(gain[bucket(f)] for f in own) / len(own)) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(fit[: 25 * len(fit) // 100])}
    return sorted(((r[0], r[1], r[2], r[3], rank.get(id(r))) for r in out), key=repr)


def drawn(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in frame.collect()), key=repr)


def test_draw_of_the_table(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert drawn(queries.op12_importance(spark, small)) == brute_draw(docs, target)


def test_draw_of_awkward_rows(spark):
    rnd = random.Random(4)
    words = ["Ab", "ab", "é", "ÉTÉ", "x1", "-", "\n", "٣", "w" * 300, "the", "\x00", "日本"]
    docs = [(i, "".join(rnd.choice(words) + rnd.choice([" ", "", ",", "  "]) for _ in range(rnd.randrange(80)))) for i in range(60)]
    docs += [(None, None), (61, None), (62, ""), (63, " .!"), (64, "one"), (65, "word " * 60_000), (66, docs[3][1]), (None, docs[3][1]), (None, "the ab " * 15), (3, "the ab " * 15)]
    target = [None, "", "ab the x1 é", "the the ab"]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).withColumn("weight", F.lit("w")).withColumn("id", F.lit("i"))
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for depth in (1, 2, 4):
        assert drawn(importance.resample(frame, wanted, depth)) == brute_draw(docs, target, depth)
    assert drawn(importance.resample(frame, wanted.limit(0))) == brute_draw(docs, [])
    assert drawn(importance.resample(frame.limit(0), wanted)) == []


def test_runs_of_the_suffix_array():
    rnd = np.random.default_rng(2)
    ids, left = rnd.integers(0, 4, 60), np.concatenate([np.arange(25, 0, -1), np.arange(35, 0, -1)])
    order, lcp = importance.suffix_array(ids, left, 3)
    text = [tuple(ids[i : i + min(3, left[i])]) for i in range(60)]
    assert [text[i] for i in order] == sorted(text)
    for a, b, n in zip(order, order[1:], lcp[1:]):
        assert n == len(os.path.commonprefix([text[a], text[b]]))


def test_crc_of_joined_strings():
    crc, rnd = importance.Crc(), random.Random(1)
    for n in (0, 1, 5, 300, 70_000):
        a, b = rnd.randbytes(9), rnd.randbytes(n)
        c = crc.joined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([n]))
        assert int(c[0]) == zlib.crc32(a + b" " + b)


def brute_groups(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[norm(t)].append((-len(t or ""), math.inf if i is None else i, i))
    out = []
    for text, rows in groups.items():
        rows.sort(key=lambda r: r[:2])
        out += [(i, rows[0][2], len(rows), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, (_, _, i) in enumerate(rows)]
    return sorted(out, key=repr)


def grouped(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("limit", [16, 1])
def test_exact_groups_of_awkward_rows(spark, monkeypatch, limit):
    """A hot text in many cells, texts that begin alike, nulls, repeated rows, clashing columns."""
    monkeypatch.setattr(exact, "LEAST", limit)
    monkeypatch.setattr(exact, "SHARE", 40)
    rnd = random.Random(2)
    docs = [(i, "the same  text" + " " * rnd.randrange(3)) for i in range(300)] + [(i, "x" * 40 + str(i % 50)) for i in range(300, 500)]
    docs += [(500, None), (501, ""), (502, " \t\n\x0b\x0c\r"), (None, "a b"), (None, "ab"), (503, "a  b"), (504, "Ab"), (504, "Ab"), (505, "a b"), (506, "é"), (507, "w " * 100_000), (508, "w" * 100_000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    for clash in ("h", "keep_id", "norm", "place", "id"):
        frame = frame.withColumn(clash, F.lit(clash))
    assert grouped(exact.groups(frame)) == brute_groups(docs)
    assert grouped(exact.groups(frame.limit(0))) == []


def test_exact_groups_equal_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small}/documents.parquet')")
    assert grouped(queries.op13_exact_dedup(spark, small)) == sorted(con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact.oracle()})").fetchall(), key=repr)
