"""Prefix trie of conversations: a Cartesian tree over the LCP array of the sorted conversations.

A conversation is the sequence of its turns' digests. Spark range-partitions and sorts the
sequences (ties by id, so copies of one conversation may span many partitions); each task
writes its stretch of the order as blocks. LCP(j) is how many turns sequence j shares with
the one before it.

Inside a block, all nearest smaller values of the LCP array give each position its
interval; positions with equal value and interval are one node, sequences that no interval
ends at are leaves of their own, and the depths between a node and its parent are nodes
with the same interval. Counts, leaf counts and code points are differences of prefix sums
over an interval, the smallest id is a range minimum.

Between blocks only the nodes on the path shared across an edge are open. Of each block its
last sequence's starts (the minima of the LCP seen from its end) and its two outer
sequences are read in order, which finds for each open node where it began: the nearest
block with a smaller minimum. Pieces of open nodes are summed by that beginning. What the driver holds
is one number for each turn of the shared path at each edge of a block, whatever the number
of conversations in a block.

Turns are ordered by their number, null first; turns of the same number by the digest of
role and text. A null role or text is empty. Rows without a conversation's id belong to none and are
left out. A row that is repeated is a turn of its own. An empty table gives no row, not even a
root. Two turns are equal if 128 bits of the SHA-256 of role and text (with the role's length) are.
The digests of one conversation, 16 bytes a turn, must fit in a task, and so must a block.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, text_of, through_table
from tessera.llm.ragged import spread

WIDTH = 16
#: A block has at most so many sequences and, beyond its first one, turns.
BLOCK_ROWS, BLOCK_TURNS = 1 << 13, 1 << 16


def sequences(turns: DataFrame) -> DataFrame:
    """(id, digests, sizes): for each conversation its turns' digests and code points, in order."""
    turns = only(turns, "conv_id", "turn", "role", "text").filter("conv_id is not null")
    role, text = text_of("role"), text_of("text")
    digest = F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256), 1, 2 * WIDTH)
    listed = turns.groupBy(F.col("conv_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("turn", digest.alias("d"), F.length(text).alias("n")))).alias("t"))
    return listed.select("id", F.col("t.d").alias("digests"), F.col("t.n").alias("sizes"))


def rebuilt(turns: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """(id, key, sizes): each conversation c with its first h turns taken from conversation c - c % every, h = crc32(c) % heads."""
    listed = through_table(sequences(turns), "sequences")
    base = listed.filter(F.col("id") % every == 0).select(F.col("id").alias("base"), F.slice("digests", 1, heads - 1).alias("bd"), F.slice("sizes", 1, heads - 1).alias("bs"))
    own = listed.withColumn("h", F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(heads)).cast("int")).withColumn("base", F.col("id") - F.col("id") % every)
    both = own.join(base, "base", "left")

    def mixed(head: str, tail: str, kind: str):
        start = F.slice(F.coalesce(head, F.array().cast(kind)), F.lit(1), F.col("h"))
        return F.concat(start, F.slice(tail, F.col("h") + 1, F.size(tail)))

    return both.select("id", F.unhex(F.array_join(mixed("bd", "digests", "array<string>"), "")).alias("key"), mixed("bs", "sizes", "array<int>").alias("sizes"))


def _common(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Turns that each sequence but the first shares with the one before it."""
    n = np.minimum(np.diff(off)[:-1], np.diff(off)[1:])
    cut = spread(n)
    at = np.arange(cut[-1]) - np.repeat(cut[:-1], n)
    alike = (raw[np.repeat(off[:-2], n) + at] == raw[np.repeat(off[1:-1], n) + at]).all(axis=1)
    # The first place that differs, or the shorter one's length.
    miss = np.flatnonzero(~alike)
    nearest = np.append(miss, cut[-1])[np.searchsorted(miss, cut[:-1])]
    return np.minimum(nearest - cut[:-1], n)


def smaller_values(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest one before it, and after it, with a smaller value; -1 and len(v) if there is none."""
    n = len(v)
    before, after = np.full(n, -1), np.full(n, n)
    held: list[int] = []
    value = v.tolist()
    for j, x in enumerate(value):
        while held and value[held[-1]] > x:
            after[held.pop()] = j
        # Of equal values the earlier ones stay in the stack: their right ends come later.
        before[j] = held[-1] if held else -1
        held.append(j)
    for j in range(n):
        k = before[j]
        if k >= 0 and value[k] == value[j]:
            before[j] = before[k]
    return before, after


class _Minima:
    """Minima of ranges, by tables of doubling widths."""

    def __init__(self, v: np.ndarray) -> None:
        self.levels = [v]
        while 2 << len(self.levels) - 1 <= len(v):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of v[lo : hi + 1]."""
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level).tolist():
            some = level == k
            out[some] = np.minimum(self.levels[k][lo[some]], self.levels[k][hi[some] + 1 - (1 << k)])
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted sequences as blocks; the outer keys and the last sequence's starts have columns of their own."""
    from pyspark import TaskContext

    part, seq = TaskContext.get().partitionId(), 0
    held: list[tuple[int, bytes, list[int]]] = []
    turns = 0

    def block() -> pa.RecordBatch:
        nonlocal seq, turns
        off = spread(np.array([len(k) // WIDTH for _, k, _ in held]))
        raw = np.frombuffer(b"".join(k for _, k, _ in held), np.uint8).reshape(-1, WIDTH)
        lcp, last = _common(raw, off), len(held[-1][1]) // WIDTH
        # Where the node of each depth of the last sequence starts; -1 if not after the block's first sequence.
        starts, depth = np.full(last, -1, np.int32), last
        for j in range(len(lcp) - 1, -1, -1):
            if lcp[j] < depth:
                starts[lcp[j] : depth] = j + 1
                depth = int(lcp[j])
                if not depth:
                    break
        row = [(part << 32) | seq, held[0][1], held[-1][1], starts.astype("<i4").tobytes(), np.array([i for i, _, _ in held], "<i8").tobytes(), off.astype("<i8").tobytes(), raw.tobytes(), np.array([x for _, _, s in held for x in s], "<i8").tobytes()]
        seq += 1
        held.clear()
        turns = 0
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if not i else pa.binary()) for i, x in enumerate(row)], names=["block", "first", "last", "starts", "ids", "off", "keys", "sizes"])

    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["key"]) // WIDTH
            if held and (len(held) == BLOCK_ROWS or turns + n > BLOCK_TURNS):
                yield block()
            held.append((row["id"], row["key"], row["sizes"]))
            turns += n
    if held:
        yield block()


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // WIDTH * WIDTH
    x, y = (np.frombuffer(s[:n], np.uint8).reshape(-1, WIDTH) for s in (a, b))
    unlike = np.flatnonzero((x != y).any(axis=1))
    return int(unlike[0]) if len(unlike) else n // WIDTH


def _edges(blocks: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """For each block: block and offset at which the nodes open at its left edge start, by depth, and the depth shared across its right edge.

    The root stands for the edges of the whole order: it starts at the first block, and depth 0 is open everywhere.
    """
    # In order; no two blocks are held at once.
    known = blocks.select("block", "first", "last", "starts").orderBy("block").toLocalIterator(prefetchPartitions=True)
    out: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
    before, open_block, open_at = None, np.zeros(1, np.int64), np.zeros(1, np.int64)
    for b in known:
        if before is None:
            open_block[0] = b.block
        else:
            n = _shared(before.last, b.first)
            starts = np.frombuffer(before.starts, "<i4")[:n].astype(np.int64)
            here = out[before.block]
            held = len(here[0]) - 1
            # A node that reaches the block before's first sequence is open there already, or starts with it.
            fresh = np.append(False, (starts >= 0) | (np.arange(1, n + 1) > held))
            index = np.minimum(np.arange(n + 1), held)
            open_block = np.where(fresh, before.block, here[0][index])
            open_at = np.where(fresh, np.append(0, np.maximum(starts, 0)), here[1][index])
            out[before.block] = (here[0], here[1], n)
        out[b.block] = (open_block, open_at, -1)
        before = b
    return out


def _ids(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def block_nodes(ids: np.ndarray, off: np.ndarray, keys: np.ndarray, sizes: np.ndarray, left: int, right: int) -> dict[str, np.ndarray]:
    """Nodes that have sequences of a block, with what of each lies in it.

    left, right: turns shared across the edges; right is -1 at the order's end. ``start``
    is -1 where a node is open at the left edge; ``open`` where it crosses either.
    """
    m, length = len(ids), np.diff(off)
    lcp = np.append(left, _common(keys, off))
    following = np.append(lcp[1:], right)
    before, after = smaller_values(lcp)
    # Equal values with one interval are one node; sequences that end no interval are leaves.
    place = np.stack([before, lcp], axis=1)
    inner, of = np.unique(place, axis=0, return_inverse=True)
    _, some = np.unique(of, return_index=True)
    alone = np.flatnonzero((lcp < length) & (np.append(lcp[1:], -1) < length))
    start = np.concatenate([inner[:, 0], alone])
    end = np.concatenate([after[some], alone + 1])
    depth = np.concatenate([inner[:, 1], length[alone]])
    bound = np.append(lcp, [-1, -1])  # at m: the right edge; at -1: the left one
    low, high = bound[start], bound[np.where(end == m, m, end)]
    floor = np.maximum(low, high)
    # A parent is the node of the larger value at the ends.
    holder = np.where(low >= high, start, end)
    parent = np.where(floor >= 0, of.ravel()[np.clip(holder, 0, m - 1)], -1)
    births = np.bincount(parent[(parent >= 0) & (start >= 0)], minlength=len(start))

    # The depths between a node and its parent are nodes too.
    n = depth - floor
    chain = np.repeat(np.arange(len(depth)), n)
    d = np.repeat(floor + 1, n) + np.arange(n.sum()) - np.repeat(spread(n)[:-1], n)
    s, e = start[chain], end[chain] - 1
    s0 = np.maximum(s, 0)
    size = spread(sizes)
    whole = size[off[1:]] - size[off[:-1]]
    turns_before = lambda j, k: size[off[j] + np.maximum(k, 0)] - size[off[j]]
    span = lambda v: (lambda t: t[e + 1] - t[s0])(spread(v))
    upto = turns_before(s0, d - 1)
    fresh = whole - turns_before(np.arange(m), lcp)
    members = e - s0 + 1
    distinct = span(fresh) + np.where(s >= 0, turns_before(s0, lcp[s0]) - upto, 0)
    # Members that end here come first; equal sequences follow each other.
    stops = np.append(np.flatnonzero((following < length) | (np.append(length[1:], -1) != length)), m - 1)
    ends = np.where(length[s0] == d, np.minimum(stops[np.searchsorted(stops, s0)], e) - s0 + 1, 0)
    bottom = d == depth[chain]
    return {
        "start": s, "depth": d, "conv_id": _Minima(ids).of(s0, e), "n_convs": members, "n_children": np.where(bottom, births[chain], (s >= 0).astype(np.int64)),
        "n_leaves": span(following < length), "saved": span(whole) - members * upto - distinct, "first_end": s0, "n_ends": ends,
        "open": (s < 0) | ((e == m - 1) & (d <= max(right, 0))), "up": np.where(d > floor[chain] + 1, s, np.where(parent[chain] >= 0, start[parent[chain]], -1)),
    }


KINDS = "s_block bigint, s_at bigint, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, ends binary, block bigint, u_block bigint, u_at bigint, up_id bigint"


def _nodes(blocks: DataFrame, edges: dict) -> DataFrame:
    """Whole nodes (``block`` null), and pieces of open ones with the ids that end there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                col = lambda c, kind: np.frombuffer(batch.column(batch.schema.get_field_index(c))[i].as_buffer(), kind)  # noqa: B023, E731
                block = batch.column(0)[i].as_py()
                ids, off = col("ids", "<i8"), col("off", "<i8")
                open_block, open_at, right = edges[block]
                t = block_nodes(ids, off, col("keys", np.uint8).reshape(-1, WIDTH), col("sizes", "<i8"), len(open_block) - 1, right)
                yield from _rows(block, ids, t, open_block, open_at)

    return blocks.select("block", "ids", "off", "keys", "sizes").mapInArrow(run, KINDS)


def _rows(block: int, ids: np.ndarray, t: dict[str, np.ndarray], open_block: np.ndarray, open_at: np.ndarray) -> Iterator[pa.RecordBatch]:
    def whence(start: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.clip(depth, 0, len(open_block) - 1)
        return np.where(start < 0, open_block[at], block), np.where(start < 0, open_at[at], start)

    s_block, s_at = whence(t["start"], t["depth"])
    u_block, u_at = whence(t["up"], t["depth"] - 1)
    opened = t["open"]
    # A parent that is whole lies in this block; it is found by its start and depth.
    code = t["start"] * (int(t["depth"].max()) + 2) + t["depth"]
    order = np.argsort(code)
    up = order[np.minimum(np.searchsorted(code[order], t["up"] * (int(t["depth"].max()) + 2) + t["depth"] - 1), len(order) - 1)]
    known = ~opened[up] & (t["up"] >= 0)
    nothing = hashlib.sha256(b"").hexdigest()
    for lo in range(0, len(opened), 1 << 14):
        r = slice(lo, lo + (1 << 14))
        listed = [_ids(ids[a : a + n]) if n else b"" for a, n in zip(t["first_end"][r].tolist(), t["n_ends"][r].tolist())]
        is_open = opened[r].tolist()
        digest = [None if o else hashlib.sha256(x).hexdigest() if x else nothing for x, o in zip(listed, is_open)]
        columns = [s_block[r], s_at[r], t["depth"][r], t["conv_id"][r], t["n_convs"][r], t["n_children"][r], t["n_leaves"][r], t["saved"][r]]
        rest = [pa.array(digest, pa.string()), pa.array([x if o else None for x, o in zip(listed, is_open)], pa.binary()), pa.array([block if o else None for o in is_open], pa.int64()), pa.array(u_block[r]), pa.array(u_at[r]), pa.array(t["conv_id"][up[r]], mask=~known[r])]
        yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64)) for c in columns], *rest], names=[x.split()[0] for x in KINDS.split(", ")])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s_block, s_at, depth, ends_sha256) of pieces in order of node and block: the ids run through the hash."""
    now, state, any_ = None, hashlib.sha256(), False

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in now], pa.array([state.hexdigest()])], names=["s_block", "s_at", "depth", "ends_sha256"])

    for batch in batches:
        for *node, ends in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if node != now:
                if now is not None:
                    yield done()
                now, state, any_ = node, hashlib.sha256(), False
            if ends:
                state.update(b"," + ends if any_ else ends)
                any_ = True
    if now is not None:
        yield done()


def nodes(rows: DataFrame) -> DataFrame:
    """One row a node of the trie of conversations (id, key, sizes): see the module's text.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    ordered = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    blocks = through_table(ordered.mapInArrow(_blocks, "block bigint, first binary, last binary, starts binary, ids binary, off binary, keys binary, sizes binary"), "blocks")
    found = through_table(_nodes(blocks, _edges(blocks)), "nodes")
    node = ["s_block", "s_at", "depth"]
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    pieces = found.filter("block is not null")
    # A node's parent is the same in all of its pieces.
    whole = pieces.groupBy(*node).agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums], F.min("u_block").alias("u_block"), F.min("u_at").alias("u_at"))
    ends = pieces.select(*node, "ends", "block").repartition(*node).sortWithinPartitions(*node, "block").select(*node, "ends").mapInArrow(_hashed, "s_block bigint, s_at bigint, depth bigint, ends_sha256 string")
    opened = through_table(whole.join(ends, node), "opened")
    upper = opened.select(F.col("s_block").alias("u_block"), F.col("s_at").alias("u_at"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))
    own = ["u_block", "u_at", "depth", "conv_id", *sums, "ends_sha256", "up_id"]
    every = found.filter("block is null").select(*own).unionByName(opened.withColumn("up_id", F.lit(None).cast("bigint")).select(*own))
    # Open nodes: at most one for each turn of the path shared across each edge of a block.
    linked = every.filter("up_id is null").join(F.broadcast(upper), ["u_block", "u_at", "depth"], "left").withColumn("up_id", F.col("above")).select(*own)
    out = every.filter("up_id is not null").unionByName(linked)
    return out.select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("up_id")).alias("parent_conv_id"), *sums, "ends_sha256")


def rebuilt_nodes(turns: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """The trie of rebuilt conversations."""
    return nodes(rebuilt(turns, every, heads))
