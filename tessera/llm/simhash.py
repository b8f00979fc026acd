"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has a bit for each majority among the hashes of a text's word
shingles. Two fingerprints that differ in at most tau of all bits, cut into m
segments on a ring, have a segment from which every chain of l consecutive segments
differs in at most l * tau / m bits. Fingerprints meet on the first segment of such
a chain; the longer chains prune before the full Hamming check.

Equal fingerprints are one vertex, so copies make no pairs. A bucket of more than
``BUCKET`` fingerprints makes no pairs either: there, each fingerprint is sent under
all keys that differ from it in one bit outside the segment; two that differ in at
most two bits share a key, at most one per bit and itself. That is exact for tau = 2
and linear.

Null texts have no word: their fingerprint is zero and links like any other.
Repeated rows share a fingerprint and a component. An empty table gives no row. Only
the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import only, text_of, through_table
from tessera.llm.graph import components
from tessera.llm.ragged import U64, mix, slices, spread, take_ragged

#: Fingerprints that meet in pairs in a bucket, at most; beyond it, another way is taken.
BUCKET = 48
#: Distinct values at most of a broadcast of hot buckets' slots.
SLOTS = 1 << 18
#: Slots of common shingles, how often one stands among two million to be common, and how many slots are ordered at most.
COMMON_SLOTS = 1 << 20
COMMON_TIMES = 4
COMMON_MOST = 1 << 17
#: Shingles of a prefix beyond those that it needs: so many may be hot, and the others still find every similar set.
EXTRA = 2
#: Leaders that a hot shingle's sets are compared with, one within another, before what is left meets in pairs.
LEVELS = 6
#: Pairs that are compared in one go at least, sets' pairs on average beyond which forests go first, and forests at most.
AT_ONCE, FEW_PAIRS, FORESTS = 1 << 15, 2, 4
#: Words of the fingerprints of shingle sets; these prune pairs of sets of ``FEW`` shingles and more.
WORDS, FEW = 4, 24
PRINT = [f"f{k}" for k in range(WORDS)]
#: How many standard deviations beyond the expected count of differing bits a pair may lie.
DEVIATIONS = 6
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, first shingle of each text, words of each text)."""
    low = _LOWER[data]
    space = _SPACE[low]
    word = ~space
    begin = word.copy()
    begin[1:] &= space[:-1]
    heads = off[:-1][np.diff(off) > 0]
    begin[heads] = word[heads]
    start = np.flatnonzero(begin)
    # Words stand one after the other, each followed by one space.
    total = np.cumsum(word)
    length = np.diff(np.append(total[start] - 1, total[-1] if len(total) else 0))
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length + 1, out=at[1:])
    packed = np.full(at[-1], 32, np.uint8)
    keep = np.ones(at[-1], bool)
    keep[at[1:] - 1] = False
    packed[keep] = low[word]
    first = np.searchsorted(start, off)
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    run = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=run[1:])
    text = np.repeat(np.arange(len(n)), count)
    begin = np.arange(run[-1]) - run[:-1][text] + first[:-1][text]
    last = np.minimum(begin + size, first[1:][text])
    raw, digest = packed.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([digest(raw[a:b], 42) for a, b in zip(at[begin].tolist(), (at[last] - 1).tolist())], U64)
    return hashes, run, n


def majority(hashes: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For each run of hashes, the bits set in over half of them; 0 for an empty run."""
    out = np.zeros(len(run) - 1, U64)
    full = np.flatnonzero(np.diff(run))
    step = 1 << 16
    for lo in range(0, len(full), 4096):
        part = full[lo : lo + 4096]
        a, b = run[part[0]], run[part[-1] + 1]
        sums = np.zeros((len(part), 64), np.int64)
        heads = run[part]
        for c in range(a, b, step):
            d = min(b, c + step)
            bits = np.unpackbits(hashes[c:d].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, j = np.searchsorted(heads, c, "right") - 1, np.searchsorted(heads, d, "left")
            sums[i:j] += np.add.reduceat(bits, np.maximum(heads[i:j] - c, 0), axis=0, dtype=np.int32)
        wins = 2 * sums > np.diff(run)[part][:, None]
        out[part] = np.packbits(wins, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, size: int = 3, words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, f0, f1, ...): shingles, and the fingerprint in 64-bit words.

    The first word has the shingles' XXH64; further ones have independent mixes of it.
    """
    src = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, text_col):
            h, first, _ = shingle_hashes(data, off, size)
            codes = [majority(h if not k else mix(h + U64(k * 0x9E3779B97F4A7C15 % 2**64)), first) for k in range(words)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first)), *[pa.array(c.view(np.int64)) for c in codes]], names=[id_col, "n", *[f"f{k}" for k in range(words)]])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, n bigint, " + ", ".join(f"f{k} bigint" for k in range(words)))


def _segment(code: Column, lo: int, bits: int) -> Column:
    return F.shiftrightunsigned(code, lo).bitwiseAND(F.lit((1 << bits) - 1))


def _slot(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLOTS)).cast("int")


def links_within_two(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect all fingerprints (column f, distinct) at 2 or fewer differing bits."""
    tau, cuts = 2, [(0, 21), (21, 21), (42, 22)]
    part = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _segment(F.col("f"), lo, n).alias("s")) for i, (lo, n) in enumerate(cuts)]))
    rows = prints.select("f", part.alias("p")).select("f", "p.i", "p.s")
    hot = rows.groupBy("i", "s").count().filter(F.col("count") > bucket).select(_slot("i", "s").alias("slot")).distinct()
    hot = F.broadcast(through_table(hot, "hot"))
    placed = rows.withColumn("slot", _slot("i", "s"))
    cold = placed.join(hot, "slot", "left_anti").drop("slot")
    x, y = cold.alias("x"), cold.select(F.col("f").alias("g"), "i", "s").alias("y")
    apart = F.col("x.f").bitwiseXOR(F.col("y.g"))
    chains = F.lit(False)
    for i in range(3):
        second = cuts[(i + 1) % 3]
        chains |= (F.col("x.i") == i) & (F.bit_count(_segment(apart, *second)) <= (2 * tau) // 3)
    met = x.join(y, (F.col("x.i") == F.col("y.i")) & (F.col("x.s") == F.col("y.s")) & (F.col("x.f") < F.col("y.g")) & chains & (F.bit_count(apart) <= tau))
    pairs = met.select(F.col("y.g").alias("a"), F.col("x.f").alias("b"))
    within = placed.join(hot, "slot", "left_semi").drop("slot")
    outside = [F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in range(64) if not lo <= b < lo + n]) for lo, n in cuts]
    flips = F.when(F.col("i") == 0, outside[0]).when(F.col("i") == 1, outside[1]).otherwise(outside[2])
    keys = within.select("f", "i", F.explode(flips).alias("flip")).select("f", "i", F.col("f").bitwiseXOR(F.col("flip")).alias("k"))
    # At most one fingerprint per bit and the key itself share a key.
    stars = keys.groupBy("i", "k").agg(F.min("f").alias("b"), F.max("f").alias("most"), F.collect_list("f").alias("all")).filter("b <> most")
    near = stars.select(F.explode("all").alias("a"), "b").filter("a <> b")
    return pairs.union(near).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def groups_within_two(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every text."""
    prints = through_table(fingerprints(docs, size, 1, id_col, text_col), "prints")
    distinct = prints.groupBy(F.col("f0").alias("f")).agg(F.min(id_col).alias("least"))
    found = components(links_within_two(distinct.select("f")))
    rooted = distinct.join(found, F.col("f") == F.col("v"), "left").select("f", "least", F.coalesce("root", "f").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("f", "component_id")
    shown = F.lower(F.lpad(F.hex("f0"), 16, "0"))
    return prints.join(named, F.col("f0") == F.col("f")).select(id_col, shown.alias("fingerprint"), "component_id")


def _sets(batches: Iterator[pa.RecordBatch], text_col: str, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, distinct shingle hashes of each text in order, their offsets, a hash of each set)."""
    for rows, data, off in slices(batches, text_col):
        h, first, _ = shingle_hashes(data, off, size)
        h, text = h.view(np.int64), np.repeat(np.arange(len(first) - 1), np.diff(first))
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        h, at = h[keep], spread(np.bincount(text[keep], minlength=len(first) - 1))
        raw, ends = h.tobytes(), (8 * at).tolist()
        yield rows, h, at, np.array([xxhash.xxh64_intdigest(raw[a:b], 7) for a, b in zip(ends, ends[1:])], U64).view(np.int64)


def signatures(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k, v, n, f0..f3): a hash of the text, one of its shingle set, the set's size and fingerprint.

    Rows of n = -1 come besides: v is the slot of a shingle that many texts share,
    which serves only to order shingles.
    """
    src = docs.select(F.col(id_col), F.xxhash64(text_of(text_col)).alias("k"), F.col(text_col))
    kind = src.schema[id_col].dataType
    names = [id_col, "k", "v", "n", *PRINT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, seen = [], 0, np.zeros(COMMON_SLOTS, bool)

        def count() -> None:
            # By parts, so that a task holds little besides its slices.
            every = np.concatenate(held)
            for part in range(16):
                values, times = np.unique(every[(every >> 60 & 15) == part], return_counts=True)
                seen[values[times >= COMMON_TIMES] & (COMMON_SLOTS - 1)] = True

        id_type = None
        for rows, h, at, v in _sets(batches, text_col, size):
            id_type = rows.column(0).type
            held.append(h)
            total += len(h)
            if total > 1 << 21:
                count()
                held, total = [], 0
            codes = [majority(mix(h.view(U64) + U64(k * 0x9E3779B97F4A7C15 % 2**64)), at).view(np.int64) for k in range(WORDS)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(v), pa.array(np.diff(at).astype(np.int32)), *map(pa.array, codes)], names=names)
        if held:
            count()
        slots = np.flatnonzero(seen)
        if len(slots):
            zero = pa.array(np.zeros(len(slots), np.int64))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(slots), id_type), zero, pa.array(slots), pa.array(np.full(len(slots), -1, np.int32)), *[zero] * WORDS], names=names)

    return src.mapInArrow(run, f"`{id_col}` {kind.simpleString()}, k bigint, v bigint, n int, {', '.join(f'{f} bigint' for f in PRINT)}")


def _common(every: DataFrame) -> np.ndarray:
    """A level for each slot of shingles: 0, or how many binary digits the count of tasks has that found it common.

    Only the ``COMMON_MOST`` slots that most tasks found are marked, so that marks order
    shingles however many tasks there are. Any order would be right; this one makes common shingles last.
    """
    marks = every.filter("n < 0").groupBy("v").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "v").limit(COMMON_MOST)
    out = np.zeros(COMMON_SLOTS, np.uint8)
    for v, c in marks.collect():
        out[v] = int(c).bit_length()
    return out


def _in_order(text: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The order of shingles, each text's in order of their hashes, that puts common ones last."""
    return np.argsort(256 * text + level, kind="stable")


def _prefixes(docs: DataFrame, common: np.ndarray, num: int, den: int, size: int, text_col: str) -> DataFrame:
    """(key, v, n, pos, rare, late): the first shingles of each set, of which two similar sets share one.

    Common shingles stand last, the others by hash. Sets of similarity t = num / den
    share at least t * n shingles, so not all of them stand after the first
    n - ceil(t * n) + 1 of either, in any order; ``EXTRA`` more come, so that this holds without
    so many of them. rare: the set's share of shingles that aren't common; late: whether the key is.
    A set comes once from each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, h, at, v in _sets(batches, text_col, size):
            n = np.diff(at)
            text = np.repeat(np.arange(len(n)), n)
            level = common[h & (COMMON_SLOTS - 1)]
            rare = np.bincount(text, weights=level == 0, minlength=len(n)) / np.maximum(n, 1)
            order = _in_order(text, level)
            pos = np.arange(len(h)) - at[:-1][text]
            fresh = np.array([not (x in seen or seen.add(x)) for x in v.tolist()], bool)
            first = (pos < (n + (num * n // -den) + 1 + EXTRA)[text]) & fresh[text]
            text = text[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[order][first]), pa.array(v[text]), pa.array(n[text].astype(np.int32)), pa.array(pos[first].astype(np.int32)), pa.array(rare[text].astype(np.float32)), pa.array(level[order][first] > 0)],
                names=["key", "v", "n", "pos", "rare", "late"],
            )

    return only(docs, text_col).mapInArrow(run, "key bigint, v bigint, n int, pos int, rare float, late boolean")


def allowance(similarity: float) -> int:
    """Bits by which the fingerprints of two sets of this similarity may differ.

    Two sets of Jaccard similarity t have a cosine of at least 2t / (1 + t); each bit
    differs with the share of their angle in a half turn.
    """
    bits = 64 * WORDS
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(bits * share + DEVIATIONS * math.sqrt(bits * share * (1 - share)))


def within(tau: int) -> Column:
    """Whether the fingerprints of x and y differ in at most tau bits, by pigeonring.

    The words stand on a ring. If at most tau bits differ, from one of the words on
    every chain of l words differs in at most l * tau / WORDS; a chain beyond its
    budget is given up before the whole sum is taken.
    """
    apart = [F.bit_count(F.col(f"x.{f}").bitwiseXOR(F.col(f"y.{f}"))) for f in PRINT]
    found = F.lit(False)
    for i in range(WORDS):
        chain, total = F.lit(True), F.lit(0)
        for step in range(WORDS):
            total = total + apart[(i + step) % WORDS]
            chain &= total * F.lit(WORDS) <= F.lit((step + 1) * tau)
        found |= chain
    return found


def near_groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component_id): the components of all pairs whose shingle sets have the Jaccard similarity.

    Equal sets are one vertex. Sets meet on each shingle of their prefixes (see
    ``_prefixes``), which no pair of the similarity misses. Sizes, positions and the
    pigeonring filter over 256-bit fingerprints prune the pairs that meet. The
    fingerprints' allowance lies ``DEVIATIONS`` standard deviations beyond what the
    similarity leads to expect: a bound by chance, about one link in a billion; pairs with a
    set of under ``FEW`` shingles aren't pruned by it. What is left is compared by the
    whole sets: no estimate links.

    A shingle of over ``bucket`` sets is hot. Two sets with at most ``EXTRA`` hot ones in
    their prefixes meet on another one. A hot shingle with at most ``bucket`` of the others makes pairs of each
    of these with all its sets; with more, which are copies of one text that have
    little of their own, they meet leaders (``_peeled``). Texts without a word are a group of their own.
    """
    ratio = Fraction(str(similarity))
    num, den, tau = ratio.numerator, ratio.denominator, allowance(similarity)
    every = through_table(signatures(docs, size, id_col, text_col), "signatures")
    signed = every.filter("n >= 0")
    common = _common(every)
    met = _prefixes(docs, common, num, den, size, text_col)
    # Keys of one set go at once. A key that a task found common is spread, and goes when keys are counted.
    by_key = Window.partitionBy("key", "salt")
    met = met.withColumn("salt", F.when(F.col("late"), F.col("v"))).select("*", F.min("v").over(by_key).alias("lo"), F.max("v").over(by_key).alias("hi")).filter("late or lo <> hi")
    # A key's rows are in one place by now: the sets that several tasks sent go once, and are counted there.
    met = met.dropDuplicates(["key", "salt", "v"]).withColumn("c", F.when(~F.col("late"), F.count("*").over(by_key)))
    met = through_table(met.select("key", "v", "n", "pos", "rare", "c"), "met")
    late = met.filter("c is null").drop("c")
    late = late.join(late.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "key")
    prints = signed.select("v", *PRINT).distinct()
    rows = through_table(met.filter("c is not null").unionByName(late).join(prints, "v"), "rows")
    # Before the first shingle that two sets share and that isn't hot, they share at most EXTRA.
    places = (F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) + EXTRA) * F.lit(num + den) >= (F.col("x.n") + F.col("y.n")) * F.lit(num)
    pairs = _meet(rows.filter(F.col("c") <= bucket), ["key"], places & (F.col("x.v") < F.col("y.v")), num, den, tau)
    hot = rows.filter(F.col("c") > bucket)
    hot = hot.join(hot.groupBy("v").agg((F.count("*") <= EXTRA).alias("cov")), "v")
    hot = through_table(hot.join(hot.groupBy("key").agg(F.count_if(~F.col("cov")).alias("open")).filter("open > 0"), "key"), "hot")
    # Of a hot key, only sets without cov need all others; where they are few, they meet them, at most ``bucket`` for each set.
    direct = hot.filter(F.col("open") <= bucket)
    once = ~F.col("y.cov") & (F.col("x.cov") | (F.col("x.v") < F.col("y.v")))
    pairs = pairs.union(_meet(direct, ["key"], places & once, num, den, tau, direct.filter("not cov")))
    pairs = through_table(pairs.distinct(), "pairs")
    hot = hot.filter(F.col("open") > bucket)
    leaders = hot.filter("not cov").groupBy("key").agg(F.min_by("v", F.struct("rare", "v")).alias("lead"))
    for _ in range(2):
        # Any set may lead a key: a leader gives way to the one that leads most of its own keys, so copies of one text have one.
        own = hot.select("key", F.col("v").alias("lead")).join(leaders.select("lead").distinct(), "lead")
        votes = own.join(leaders.select("key", F.col("lead").alias("to")), "key").groupBy("lead", "to").count()
        leaders = leaders.join(votes.groupBy("lead").agg(F.max_by("to", F.struct("count", "to")).alias("to")), "lead").select("key", F.col("to").alias("lead"))
    members = through_table(hot.join(leaders, "key").select(F.array("lead").alias("g"), "v", "n", "rare", "cov", *PRINT).distinct(), "members")
    asked = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct()
    links = _alike(pairs, through_table(_held(docs, signed, asked, common, size, text_col), "asked_sets"), num, den)
    # Few sets are in groups; they are written, as every level reads them.
    few = through_table(_held(docs, signed, members.select("v").distinct(), common, size, text_col), "member_sets")
    found = components(_peeled(members, few, bucket, num, den, tau, links))
    distinct = signed.groupBy("v").agg(F.min(id_col).alias("least"))
    rooted = distinct.join(found, "v", "left").select("v", "least", F.coalesce("root", "v").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("v", "component_id")
    return signed.select(id_col, "v").join(named, "v").select(id_col, "component_id")


def _peeled(members: DataFrame, held: DataFrame, bucket: int, num: int, den: int, tau: int, links: DataFrame) -> DataFrame:
    """The links (a, b), and those that connect what members (g, v, n, rare, cov, f0..f3) of groups link.

    A group's members meet its leader, the last of g. Two that are both linked to it are
    connected. Of any others, similar ones share more than they can share inside the leaders so
    far, so they meet on a shingle outside of those, in a prefix of what is left of
    their sets. Or else both have enough inside: those, of unlike sizes to their leader, meet in pairs. A
    shingle of over ``bucket`` members without ``cov`` is a group with a leader of its own. What groups are
    left after ``LEVELS`` leaders meet in pairs. Two with ``cov`` have met elsewhere.
    """
    own = ["v", "n", "rare", "cov", *PRINT]
    now = members.withColumn("ins", F.lit(0))
    apart = F.col("x.ins").bitwiseAND(F.col("y.ins")) == 0
    once = (F.col("x.v") < F.col("y.v")) & apart & ~(F.col("x.cov") & F.col("y.cov"))
    ones = ~F.col("y.cov") & (F.col("x.cov") | (F.col("x.v") < F.col("y.v"))) & apart
    for level in range(LEVELS):
        # The leaders are few, and apart from the others.
        ids = through_table(now.select(F.explode("g").alias("v")).distinct(), "leader_ids")
        leads = through_table(held.join(ids, "v", "left_semi"), "leaders")
        got, rest = now.join(held.select("v", "set"), "v"), F.col("set")
        for i in range(level + 1):
            lead = leads.select(F.col("v").alias("lead"), F.col("n").alias("ln"), F.col("set").alias(f"s{i}"))
            got = got.drop("lead", "ln").withColumn("lead", F.get("g", F.lit(i))).join(lead, "lead")
            rest = F.array_except(rest, f"s{i}")
        linked = (F.col("v") == F.col("lead")) | (F.size(F.array_intersect("set", f"s{level}")) * F.lit(num + den) >= (F.col("n") + F.col("ln")) * F.lit(num))
        got = got.select("g", *own, "lead", "ins", linked.alias("linked"), rest.alias("rest"))
        got = got.withColumn("s", F.col("n") - F.size("rest")).withColumn("keys", F.slice("rest", F.lit(1), (F.col("n") - F.ceil(F.col("n") * num / den) + 1).cast("int"))).drop("rest")
        got = through_table(got.withColumn("ins", F.col("ins").bitwiseOR(F.when(F.col("linked"), 1 << level).otherwise(0))), "peeled")
        links = links.union(got.filter("linked and v <> lead").select(F.greatest("v", "lead").alias("a"), F.least("v", "lead").alias("b")))
        # Groups whose members are not all linked to one leader.
        open_ = got.groupBy("g").agg(F.bit_and("ins").alias("all"), F.bool_and("cov").alias("met")).filter("all = 0 and not met").select("g")
        got = got.join(open_, "g", "left_semi").drop("linked", "lead")
        enough = F.least("x.s", "y.s") * F.lit(num + den) >= (F.col("x.n") + F.col("y.n")) * F.lit(num)
        inside = _meet(got.filter(F.col("s") * den >= F.col("n") * num).drop("keys"), ["g"], once & enough, num, den, tau)
        keyed = _sifted(got).select("g", *own, "s", "ins", F.explode("keys").alias("key"))
        useful = keyed.groupBy("g", "key").agg(F.bit_and("ins").alias("all"), F.count("*").alias("c"), F.count_if(~F.col("cov")).alias("open"), F.min_by("v", F.struct("cov", "ins", "rare", "v")).alias("lead")).filter("c > 1 and all = 0 and open > 0").drop("all", "c")
        keyed = through_table(keyed.join(useful, ["g", "key"]), "keyed")
        last = level == LEVELS - 1
        few = keyed if last else keyed.filter(F.col("open") <= bucket)
        pairs = through_table(_meet(few, ["g", "key"], ones, num, den, tau, few.filter("not cov")).union(inside).distinct(), "pairs")
        links = links.union(_alike(pairs, held, num, den))
        more = keyed.filter(F.col("open") > bucket)
        if last or more.isEmpty():
            return links
        now = more.select(F.concat("g", F.array("lead")).alias("g"), *own, "ins").distinct()
    return links


#: Slots of the shingles that sets without ``cov`` ask for, a multiple of a bitmap's 32768 bits.
ASKED_SLOTS = 1 << 22


def _sifted(rows: DataFrame) -> DataFrame:
    """The rows (.., cov, keys) with only such keys as a row without ``cov`` may have; those alone need a partner.

    The slots of such keys come to the driver as half a megabyte of bits, whatever their number; where
    very many are set, more keys are left than needed, in proportion to the rows.
    """
    slots = rows.filter("not cov").select(F.explode("keys").alias("key")).select((F.pmod("key", F.lit(ASKED_SLOTS)) + 1).alias("slot"))
    marked = slots.groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    asked = np.zeros(ASKED_SLOTS // 8, np.uint8)
    for b, bits in marked.collect():
        asked[(b - 1) * 4096 : b * 4096] = np.frombuffer(bits, np.uint8)
    at = rows.columns.index("keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_ = np.unpackbits(asked, bitorder="little").astype(bool)
        for batch in batches:
            column = batch.column(at)
            keys = column.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
            keep = set_[keys & (ASKED_SLOTS - 1)]
            off = spread(np.bincount(owner[keep], minlength=batch.num_rows))
            kept = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(keys[keep]))
            yield pa.RecordBatch.from_arrays([kept if i == at else batch.column(i) for i in range(batch.num_columns)], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _meet(rows: DataFrame, keys: list[str], also: Column, num: int, den: int, tau: int, others: DataFrame | None = None) -> DataFrame:
    """(a, b), a > b: pairs of rows that agree on the keys, and whose sizes and fingerprints allow the similarity.

    also: what else holds of x and y; in prefixes, the bound on positions is that of the first shingle that both have.
    others: the rows that y is one of, if not of all.
    """
    x, y = rows.alias("x"), (rows if others is None else others).alias("y")
    nx, ny = F.col("x.n"), F.col("y.n")
    sizes = F.least(nx, ny) * F.lit(den) >= F.greatest(nx, ny) * F.lit(num)
    close = (F.least(nx, ny) < FEW) | within(tau)
    for key in keys:
        also = (F.col(f"x.{key}") == F.col(f"y.{key}")) & also
    met = x.join(y, also & sizes & close)
    return met.select(F.greatest("x.v", "y.v").alias("a"), F.least("x.v", "y.v").alias("b"))


def _held(docs: DataFrame, signed: DataFrame, asked: DataFrame, common: np.ndarray, size: int, text_col: str) -> DataFrame:
    """(v, n, set) of the sets that are asked for, made anew of one text of each; shingles in the order of ``_prefixes``."""
    # At most a million slots are broadcast, so few other texts are looked at.
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20)).cast("int").alias("slot")
    slots = F.broadcast(signed.groupBy("v").agg(F.min("k").alias("k")).join(asked, "v", "left_semi").select(slot("k")).distinct())
    texts = docs.select(text_of(text_col).alias("text")).withColumn("slot", slot(F.xxhash64("text"))).join(slots, "slot", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, h, at, v in _sets(batches, "text", size):
            h = h[_in_order(np.repeat(np.arange(len(v)), np.diff(at)), common[h & (COMMON_SLOTS - 1)])]
            # Equal sets of one task go once.
            one = np.array([i for i, x in enumerate(v.tolist()) if not (x in seen or seen.add(x))], np.int64)
            own, off = take_ragged(h, at[one], np.diff(at)[one])
            yield pa.RecordBatch.from_arrays([pa.array(v[one]), pa.array(np.diff(off).astype(np.int32)), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(own))], names=["v", "n", "set"])

    return texts.mapInArrow(run, "v bigint, n int, set array<bigint>").join(asked, "v", "left_semi").dropDuplicates(["v"])


def _alike(pairs: DataFrame, held: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b), a > b: links that connect what the pairs of the similarity connect; pairs are compared by whole sets.

    Where sets have many pairs, copies of one text mostly, each set is first compared with the least one that it
    met, a few times. Pairs that links connect by then need no comparison. So what is sent grows
    with the sets, not with the square of the copies.
    """
    sets, n, links = held.count(), pairs.count(), None
    for _ in range(FORESTS):
        if n <= max(FEW_PAIRS * sets, AT_ONCE):
            break
        forest = through_table(pairs.groupBy("a").agg(F.min("b").alias("b")), "forest")
        found = _compared(forest, forest.count(), held, sets, num, den)
        links = found if links is None else links.union(found)
        root = through_table(components(links), "roots")
        rest = pairs.join(forest, ["a", "b"], "left_anti")
        for end in "ab":
            rest = rest.join(root.select(F.col("v").alias(end), F.col("root").alias(f"r{end}")), end, "left")
        pairs = through_table(rest.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), "pairs")
        n = pairs.count()
    found = _compared(pairs, n, held, sets, num, den)
    return found if links is None else links.union(found)


def _compared(pairs: DataFrame, n: int, held: DataFrame, sets: int, num: int, den: int) -> DataFrame:
    """The n pairs whose sets have the similarity, a part of the sets with a part of the sets at a time."""
    parts = math.ceil(math.sqrt(max(1, n) / max(sets // 8, AT_ONCE)))
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    x = held.select(F.col("v").alias("a"), F.col("n").alias("xn"), F.col("set").alias("xs"))
    y = held.select(F.col("v").alias("b"), F.col("n").alias("yn"), F.col("set").alias("ys"))
    both = F.size(F.array_intersect("xs", "ys"))
    out = None
    for i in range(parts):
        for j in range(parts):
            some, u, w = pairs, x, y
            if parts > 1:
                some, u, w = pairs.filter((part("a") == i) & (part("b") == j)), x.filter(part("a") == i), y.filter(part("b") == j)
            met = some.join(u, "a").join(w, "b").filter(both * F.lit(num + den) >= (F.col("xn") + F.col("yn")) * F.lit(num)).select("a", "b")
            met = through_table(met, "links")
            out = met if out is None else out.union(met)
    return out
