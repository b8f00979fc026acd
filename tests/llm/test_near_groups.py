"""Near-duplicate groups against all pairs, compared exactly."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.common import through_table


def _sets(rows, size=5):
    out = {}
    for i, text in rows:
        words = (text or "").lower().split()
        out[i] = {" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}
    return out


def _groups(rows):
    """The least id of each text's component, by all pairs."""
    sets = _sets(rows)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def _got(spark, rows, bucket):
    return {r.doc_id: r.component_id for r in simhash.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket=bucket).collect()}


@pytest.mark.parametrize("bucket, levels", [(3, 6), (3, 1), (1, 2)])
def test_every_link_of_a_skewed_table(spark, monkeypatch, bucket, levels):
    """Texts slide along a long one, so that most resemble their neighbours only, around one large group."""
    monkeypatch.setattr(simhash, "LEVELS", levels)
    rnd = random.Random(4)
    stream = [f"s{k}" for k in range(1200)]
    rows = [(k, " ".join(stream[6 * k : 6 * k + 100])) for k in range(150)]
    base = [f"b{k}" for k in range(120)]
    for k in range(150):
        words = list(base)
        for p in rnd.sample(range(120), rnd.randrange(5)):
            words[p] = f"e{rnd.randrange(10**6)}"
        rows.append((1000 + k, " ".join(words)))
    for k in range(60):
        n = rnd.randrange(1, 30)
        rows.append((2000 + k, " ".join(f"t{rnd.randrange(2)}" for _ in range(n)) if k % 3 else " ".join(f"r{p}" for p in range(n))))
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, rows[160][1])]
    rnd.shuffle(rows)
    assert _got(spark, rows, bucket) == _groups(rows)


def test_shared_passage_below_the_similarity_stays(spark):
    """Short and long texts that share a template but not 0.8 of their shingles are not linked; those at 0.8 are."""
    rows = []
    for k, (n, tail) in enumerate([(12, 2), (14, 2), (16, 2), (30, 4), (104, 18), (404, 60)]):
        base = [f"p{k}x{i}" for i in range(n)]
        for j in range(40):
            rows.append((1000 * k + j, " ".join(base[:-tail] + [f"own{k}y{j}z{i}" for i in range(tail)])))
    # 18 of 22 shingles shared, twice: 0.818; and 4 of 5: exactly 0.8.
    words = [f"q{i}" for i in range(24)]
    rows += [(9000, " ".join(words)), (9001, " ".join(words[:-2] + ["u", "v"])), (9010, "a b c d e f g h"), (9011, "a b c d e f g h i")]
    want = _groups(rows)
    assert want[1] == 1 and want[9001] == 9000 and want[9011] == 9010
    assert _got(spark, rows, 48) == want


def test_families_within_families(spark):
    """Copies of copies: each generation is like the one before it, not like the first; sizes differ; all share a passage."""
    rnd = random.Random(9)
    rows, fathers = [], [[f"b{k}" for k in range(90)]]
    for i in range(300):
        words = list(rnd.choice(fathers))
        for p in rnd.sample(range(len(words)), rnd.randrange(1, 6)):
            words[p] = f"e{rnd.randrange(10**6)}"
        if rnd.random() < 0.2:
            words = words[: -rnd.randrange(1, 25)] if rnd.random() < 0.5 else words + [f"x{rnd.randrange(50)}" for _ in range(20)]
        rows.append((i, " ".join(words)))
        if rnd.random() < 0.1:
            fathers.append(words)
    rows += [(1000 + i, " ".join([f"b{k}" for k in range(30)] + [f"o{i % 40}y{k}" for k in range(8 + i % 7)])) for i in range(200)]
    assert _got(spark, rows, 5) == _groups(rows)


def test_hot_shingles_of_few_open_sets_make_no_groups(spark, monkeypatch):
    """A shingle that unlike texts share by chance calls for no whole sets, even if a few texts have nothing else to meet on."""
    monkeypatch.setattr(simhash, "COMMON_TIMES", 10**9)
    common = [f"c{k}" for k in range(24)]
    own = lambda k, n: [f"o{k}w{i}" for i in range(n)]
    rows = [(k, " ".join(own(k, 20) + common[4 * (k % 5) : 4 * (k % 5) + 8] + own(k + 1000, 24))) for k in range(150)]
    rows += [(200 + k, " ".join([*common, f"z{k}"])) for k in range(3)]
    rows += [(300 + k, f"{rows[k][1]} e{k % 7}") for k in range(0, 20, 2)]
    members = []
    peeled = simhash._peeled
    monkeypatch.setattr(simhash, "_peeled", lambda rows, *a: members.append(rows.count()) or peeled(rows, *a))
    assert _got(spark, rows, 8) == _groups(rows)
    assert members == [0]


def test_written_tables_leave_no_shuffle_files(spark):
    """What stood behind a table that is written goes at once, not when the driver collects its garbage."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = files.getAllFiles().size()
    through_table(spark.range(100_000).repartition(7, "id").groupBy((F.col("id") % 1009).alias("k")).count(), "counts")
    for _ in range(100):
        if files.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert files.getAllFiles().size() <= before


def test_copies_of_a_text_are_not_sent_once_for_each_pair(spark, monkeypatch):
    """Forty near copies of each of thirty texts: sets are compared as often as there are sets, not pairs, and every group is found."""
    monkeypatch.setattr(simhash, "AT_ONCE", 400)
    rnd = random.Random(12)
    rows = []
    for k in range(30):
        words = [f"w{k}x{i}" for i in range(400)]
        for _ in range(40):
            copy = list(words)
            for p in rnd.sample(range(400), 3):
                copy[p] = f"e{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    compared, one = [], simhash._compared
    monkeypatch.setattr(simhash, "_compared", lambda pairs, n, *a: compared.append((n, pairs.count())) or one(pairs, n, *a))
    assert _got(spark, rows, 48) == _groups(rows)
    assert all(n == m for n, m in compared) and sum(n for n, _ in compared) < 3 * len(rows)
