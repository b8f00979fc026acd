"""Removal of repeated byte strings by blockwise suffix sorting with difference covers.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else; matches never cross texts. Only suffixes to that depth matter:

1. Which suffixes to sort. D is a perfect difference set modulo v: of any two
   positions, some shift below v puts both on residues in D. Positions on such
   residues are compared, by hash, by their first length - v + 1 bytes. Two equal
   strings hold, at one shift, two equal sample strings; so a suffix that has no tied
   sample position within the next v bytes repeats nowhere. A slice of texts sends
   each different string once, as packed arrays of 32-bit codes; strings that repeat
   inside a slice tie there already. A false tie costs time only.
2. Blocks. Each remaining suffix belongs to the block of the smallest hash among the
   ``KEY``-byte strings of its first length bytes, so equal suffixes share a block, and
   neighbouring ones mostly do and are sent as one piece of text. Of equal pieces one
   is sorted. A few blocks at a time (``BLOCK_BYTES``) their suffixes are sorted
   (``equal_starts``): by the first bytes; ties by the ranks of a second, smaller
   difference cover, which were computed before, and the last bytes. All is compared
   by bytes.
3. Blocks that hold more than their share (at most ``HOT_SHARE`` of them a partition can
   exist) are dealt on by whole strings, each different string once a batch, so no
   task gathers a hot string's texts.

A task holds the pieces of one bucket of blocks, and there are four buckets a
partition; the sort's own arrays are bounded by the blocks sorted together.

Null texts are empty; texts below ``length`` bytes lose nothing; repeated rows are
documents of their own, so each loses what the other holds; an empty table gives no
row. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import through_table
from tessera.llm.ragged import U64, numbered, prefix_hash, slices, span_hash, spread

#: Distinct values at most of the broadcast that tells which texts can be concerned.
SLOTS = 1 << 20
#: Bytes of the strings whose smallest hash names a suffix's block.
KEY = 32
#: Blocks of more than 1 / HOT_SHARE of a partition's pieces, and of HOT_LEAST, are dealt on.
HOT_SHARE = 20
HOT_LEAST = 256
#: Bytes of text whose suffixes are sorted together; a larger block is sorted by itself.
BLOCK_BYTES = 1 << 19
_SLICE = 1 << 20


@functools.lru_cache(8)
def difference_set(most: int) -> tuple[int, np.ndarray]:
    """(v, D): the largest Singer difference set of prime order with v = q*q + q + 1 <= most."""
    q = max((q for q in range(2, most) if q * q + q + 1 <= most and all(q % i for i in range(2, q))), default=0)
    if not q:
        return 1, np.zeros(1, np.int64)
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                # Powers of x modulo x**3 = a*x*x + b*x + c: those on a line, up to scalars.
                cur, found = (1, 0, 0), []
                for i in range(v):
                    if cur[2] == 0:
                        found.append(i)
                    cur = (cur[2] * c % q, (cur[0] + cur[2] * b) % q, (cur[1] + cur[2] * a) % q)
                if len(found) == q + 1 and len({(x - y) % v for x in found for y in found}) == v:
                    return v, np.array(found, np.int64)
    raise AssertionError("a Singer set exists for every prime")


def cover_positions(length: int, v: int, cover: np.ndarray) -> Callable:
    """Sample positions of a slice whose first length - v + 1 bytes lie in their text."""
    on = np.zeros(v, bool)
    on[cover] = True
    depth = length - v + 1

    def select(rows: pa.RecordBatch, off: np.ndarray) -> np.ndarray:
        out = []
        n = np.diff(off)
        for size in np.flatnonzero(n >= length).tolist():
            out.append(np.flatnonzero(np.resize(on, n[size] - depth + 1)) + off[size])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    return select


def reach_positions(length: int, v: int) -> Callable:
    """Starts of whole strings that hold a tied sample position within v bytes."""

    def select(rows: pa.RecordBatch, off: np.ndarray) -> np.ndarray:
        ties = rows.column(rows.schema.get_field_index("at"))
        edge = np.zeros(int(off[-1]) + 1, np.int32)
        for i in range(rows.num_rows):
            at = np.frombuffer(ties[i].as_buffer(), "<u4").astype(np.int64)
            last = off[i + 1] - off[i] - length
            lo, hi = np.maximum(at - v + 1, 0), np.minimum(at, last) + 1
            lo, hi = lo[hi > lo] + off[i], hi[hi > lo] + off[i]
            np.add.at(edge, lo, 1)
            np.add.at(edge, hi, -1)
        return np.flatnonzero(np.cumsum(edge[:-1]) > 0)

    return select


def gather(group: pa.Table, runs: bool) -> pa.Table:
    """Positions of one slice, text by text; the slice's header row has its texts.

    runs: positions come and go as pairs of the first and how many follow each other.
    """
    head = next(i for i, x in enumerate(group.column("cut")) if x.is_valid)
    k1, k2 = (np.frombuffer(group.column(c)[head].as_buffer(), "<i8") for c in ("k1s", "k2s"))
    cut = np.frombuffer(group.column("cut")[head].as_buffer(), "<u4").astype(np.int64)
    edge = np.zeros(cut[-1] + 2, np.int32)
    for x in group.column("at"):
        at = np.frombuffer(x.as_buffer(), "<u4").astype(np.int64)
        first, n = (at[::2], at[1::2]) if runs else (at, 1)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + n, -1)
    at = np.flatnonzero(np.cumsum(edge) > 0)
    bound = np.searchsorted(at, cut)
    docs = np.flatnonzero(np.diff(bound))
    own = [at[bound[d] : bound[d + 1]] - cut[d] for d in docs.tolist()]
    return pa.table([pa.array(k1[docs]), pa.array(k2[docs]), pa.array([(as_runs(x) if runs else x).astype("<u4").tobytes() for x in own], pa.binary())], names=["k1", "k2", "at"])


def as_runs(at: np.ndarray) -> np.ndarray:
    """Pairs of the first and the count of positions that follow each other."""
    head = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    return np.stack([at[head], np.diff(np.append(head, len(at)))], axis=1).ravel()


def tied(texts: DataFrame, length: int, select: Callable, blocks: int) -> DataFrame:
    """(k1, k2, at): the selected positions of each text (little-endian uint32) whose string of ``length`` bytes stands elsewhere too.

    texts: k1, k2, text, and what ``select`` reads; in an order that a retried task
    finds again.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for rows, data, off in slices(batches, "text", _SLICE):
            pos = select(rows, off)
            if not len(pos):
                continue
            h = span_hash(prefix_hash(data), pos, pos + length)
            order = np.argsort(h)
            first = np.ones(len(h), bool)
            first[1:] = h[order[1:]] != h[order[:-1]]
            alone = first & np.append(first[1:], True)
            here = np.sort(pos[order[~alone]])
            reps = np.sort(order[first])
            to = (((h[reps] >> U64(32)) * U64(blocks)) >> U64(32)).astype(np.int64)
            by = np.argsort(to, kind="stable")
            reps, cut = reps[by], spread(np.bincount(to, minlength=blocks))
            at, code = pos[reps], h[reps]
            step = np.diff(at, prepend=0)
            full = np.flatnonzero(np.diff(cut))
            step[cut[full]] = at[cut[full]]
            code = (code & U64(0xFFFFFFFF)).astype("<u4")
            block = (part << 32) | seq
            seq += 1
            key = lambda c: rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            steps = [step[a:b] for a, b in zip(cut[full], cut[full + 1])]
            at_bytes = [here.astype("<u4").tobytes()] + [s.astype("<u2").tobytes() if s[1:].max(initial=0) < 1 << 16 and s[0] < 1 << 16 else s.astype("<u4").tobytes() for s in steps]
            codes = [None] + [code[a:b].tobytes() for a, b in zip(cut[full], cut[full + 1])]
            n = len(full) + 1
            none = [None] * (n - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(-1 - (31 * part + seq) % blocks, full), pa.int32()), pa.array(np.full(n, block, np.int64)), pa.array([key("k1"), *none], pa.binary()), pa.array([key("k2"), *none], pa.binary()), pa.array([off.astype("<u4").tobytes(), *none], pa.binary()), pa.array(at_bytes, pa.binary()), pa.array(codes, pa.binary())],
                names=["bucket", "block", "k1s", "k2s", "cut", "at", "code"],
            )

    def sort_block(group: pa.Table) -> pa.Table:
        if not group.num_rows or group.column("bucket")[0].as_py() < 0:
            return group.select(["block", "k1s", "k2s", "cut", "at"])
        codes = [np.frombuffer(x.as_buffer(), "<u4") for x in group.column("code")]
        size = np.array([len(c) for c in codes])
        every = np.concatenate(codes)
        order = np.argsort(every)
        same = every[order[1:]] == every[order[:-1]]
        tie = np.zeros(len(every), bool)
        tie[order[1:][same]] = True
        tie[order[:-1][same]] = True
        off, keep, found = spread(size), [], []
        for i, x in enumerate(group.column("at")):
            own = tie[off[i] : off[i + 1]]
            if own.any():
                raw = x.as_buffer()
                at = np.cumsum(np.frombuffer(raw, "<u2" if len(raw) == 2 * size[i] else "<u4"), dtype=np.int64)
                keep.append(i)
                found.append(at[own].astype("<u4").tobytes())
        none = pa.nulls(len(keep), pa.binary())
        return pa.table([group.column("block").take(pa.array(keep, pa.int64())), none, none, none, pa.array(found, pa.binary())], names=["block", "k1s", "k2s", "cut", "at"])

    sent = texts.mapInArrow(emit, "bucket int, block bigint, k1s binary, k2s binary, cut binary, at binary, code binary")
    met = sent.groupBy("bucket").applyInArrow(sort_block, "block bigint, k1s binary, k2s binary, cut binary, at binary")
    return met.groupBy("block").applyInArrow(lambda group: gather(group, False), "k1 bigint, k2 bigint, at binary").dropDuplicates(["k1", "k2"])


def smallest_in_window(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of h[i : i + width] for every i with a whole window."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    padded = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, U64)
    padded[: len(h)] = h
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def tied_in_blocks(texts: DataFrame, length: int, select: Callable, partitions: int) -> DataFrame:
    """As ``tied``, for positions that mostly follow each other: their texts are sent, in pieces, and ``at`` has runs."""
    key = min(KEY, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for rows, data, off in slices(batches, "text", _SLICE):
            pos = select(rows, off)
            if not len(pos):
                continue
            prefix = prefix_hash(data)
            every = np.arange(len(data) - key + 1)
            block_of = smallest_in_window(span_hash(prefix, every, every + key), length - key + 1)[pos]
            head = np.flatnonzero(np.concatenate([[True], (np.diff(pos) != 1) | (block_of[1:] != block_of[:-1])]))
            n = np.diff(np.append(head, len(pos)))
            begin, end = pos[head], pos[head] + n - 1 + length
            _, first, inverse, count = np.unique(span_hash(prefix, begin, end), return_index=True, return_inverse=True, return_counts=True)
            again = count[inverse] > 1
            block = (part << 32) | seq
            seq += 1
            first = np.sort(first)
            raw, size = data.tobytes(), len(first) + 1
            column = lambda c: rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            none = [None] * (size - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *block_of[head[first]].view(np.int64).tolist()], pa.int64()),
                    pa.array(np.full(size, block, np.int64)),
                    pa.array([0, *begin[first].tolist()], pa.int32()),
                    pa.array([None, *[raw[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]], pa.binary()),
                    *[pa.array([x, *none], pa.binary()) for x in (column("k1"), column("k2"), off.astype("<u4").tobytes(), np.stack([begin[again], n[again]], axis=1).astype("<u4").tobytes())],
                ],
                names=["m", "block", "pos", "piece", "k1s", "k2s", "cut", "at"],
            )

    def sort_block(group: pa.Table) -> pa.Table:
        slice_of, pos, name = (group.column(c).to_numpy() for c in ("block", "pos", "m"))
        raw = [x.as_buffer().to_pybytes() for x in group.column("piece")]
        known: dict[tuple[int, bytes], int] = {}
        which = np.array([known.setdefault(x, len(known)) for x in zip(name.tolist(), raw)])
        distinct, times = list(known), np.bincount(which)
        # Equal pieces repeat as a whole. A block's pieces are sorted if they are not all equal, or there is but one.
        of = np.array([x[0] for x in distinct])
        _, block, size = np.unique(of, return_inverse=True, return_counts=True)
        sort = np.flatnonzero((size[block] > 1) | (times == 1))
        sort = sort[np.argsort(block[sort], kind="stable")]
        found: list[np.ndarray | None] = [None] * len(distinct)
        lo = 0
        while lo < len(sort):
            hi, held = lo, 0
            while hi < len(sort) and (held < BLOCK_BYTES or block[sort[hi]] == block[sort[hi - 1]]):
                held += len(distinct[sort[hi]][1])
                hi += 1
            part = sort[lo:hi].tolist()
            off = spread(np.array([len(distinct[i][1]) for i in part]))
            ties = equal_starts(np.frombuffer(b"".join(distinct[i][1] for i in part), np.uint8), off, length)
            cut = spread(np.diff(off) - length + 1).tolist()
            for i, a, b in zip(part, cut, cut[1:]):
                found[i] = np.flatnonzero(ties[a:b])
            lo = hi
        ats = [np.arange(len(distinct[w][1]) - length + 1) if times[w] > 1 else found[w] for w in which.tolist()]
        count = np.array([len(x) for x in ats])
        return _by_block(np.repeat(slice_of, count), np.repeat(pos, count) + np.concatenate(ats)) if len(ats) else _by_block(slice_of, pos)

    def deal_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for lo in range(0, rows.num_rows, 2048):
                part = rows.slice(lo, 2048)
                raw = [x.as_buffer() for x in part.column(2)]
                off = spread(np.array([len(x) for x in raw], np.int64))
                n = np.diff(off) - length + 1
                owner = np.repeat(np.arange(len(raw)), n)
                start = off[:-1][owner] + np.arange(n.sum()) - np.repeat(spread(n)[:-1], n)
                text = np.frombuffer(b"".join(raw), np.uint8)
                at = part.column(1).to_numpy(zero_copy_only=False)[owner] + start - off[:-1][owner]
                block, prefix = part.column(0).to_numpy(zero_copy_only=False)[owner], prefix_hash(text)
                number, h = numbered(text, start, start + length, prefix), span_hash(prefix, start, start + length)
                _, first, inverse, count = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
                again = count[inverse] > 1
                to = (((h[first] >> U64(32)) * U64(2 * partitions)) >> U64(32)).astype(np.int64)
                by = first[np.argsort(to, kind="stable")]
                edge = spread(np.bincount(to, minlength=2 * partitions))
                full = np.flatnonzero(np.diff(edge))
                lists = [np.flatnonzero(again), *[by[edge[b] : edge[b + 1]] for b in full.tolist()]]
                strings = [b"", *[b"".join(text[a : a + length].tobytes() for a in start[x].tolist()) for x in lists[1:]]]
                yield pa.RecordBatch.from_arrays([pa.array([-1 - int(h[0] % U64(2 * partitions)), *full.tolist()], pa.int32()), *[pa.array([x[i].astype(kind).tobytes() for i in lists], pa.binary()) for x, kind in ((block, "<i8"), (at, "<u4"))], pa.array(strings, pa.binary())], names=["bucket", "blocks", "ats", "strings"])

    def sort_dealt(group: pa.Table) -> pa.Table:
        block, at = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(c)]) for c, kind in (("blocks", "<i8"), ("ats", "<u4")))
        if group.column("bucket")[0].as_py() >= 0:
            text = b"".join(x.as_buffer() for x in group.column("strings"))
            known: dict[bytes, int] = {}
            which = np.array([known.setdefault(text[a : a + length], len(known)) for a in range(0, len(text), length)])
            found = np.bincount(which)[which] > 1
            block, at = block[found], at[found]
        return _by_block(block, at)

    pieces = through_table(texts.mapInArrow(cut, "m bigint, block bigint, pos int, piece binary, k1s binary, k2s binary, cut binary, at binary"), "pieces")
    sent = pieces.filter("m is not null")
    share = max(HOT_LEAST, sent.count() // (HOT_SHARE * partitions))
    # At most HOT_SHARE names a partition.
    hot = F.broadcast(through_table(sent.groupBy("m").count().filter(F.col("count") > share).select("m"), "hot"))
    bucket = F.pmod(F.xxhash64("m"), F.lit(4 * partitions)).cast("int").alias("bucket")
    outcome = "block bigint, at binary"
    met = sent.join(hot, "m", "left_anti").select(bucket, "m", "block", "pos", "piece").groupBy("bucket").applyInArrow(sort_block, outcome)
    dealt = sent.join(hot, "m", "left_semi").select("block", "pos", "piece").mapInArrow(deal_on, "bucket int, blocks binary, ats binary, strings binary")
    met = met.union(dealt.groupBy("bucket").applyInArrow(sort_dealt, outcome))
    none = F.lit(None).cast("binary")
    every = met.select("block", none.alias("k1s"), none.alias("k2s"), none.alias("cut"), "at").union(pieces.filter("m is null").select("block", "k1s", "k2s", "cut", "at"))
    return every.groupBy("block").applyInArrow(lambda group: gather(group, True), "k1 bigint, k2 bigint, at binary").dropDuplicates(["k1", "k2"])


@functools.lru_cache(8)
def shifts(v: int) -> np.ndarray:
    """For two residues modulo v, the least shift that puts both on the difference set."""
    on = np.zeros(v, bool)
    on[difference_set(v)[1]] = True
    both = np.stack([np.roll(on, -d) for d in range(v)])
    return np.argmax(both[:, :, None] & both[:, None, :], axis=0)


def equal_starts(text: np.ndarray, off: np.ndarray, length: int) -> np.ndarray:
    """Which starts of strings of ``length`` bytes in the pieces (one after the other) have an equal one.

    The suffixes are sorted by their first v bytes. Sample positions, those on the
    residues of a difference cover modulo v, are ranked before by their first ``deep``
    bytes, by doubling in steps of v. Suffixes with equal first bytes are sorted by the
    ranks at the shift that puts both on the cover: three-way partitions around one
    suffix of each run, all runs at once. Equal ranks are followed by the bytes beyond
    ``deep``, so every comparison is that of the whole strings.
    """
    n = np.diff(off) - length + 1
    start = off[:-1].repeat(n) + np.arange(n.sum()) - spread(n)[:-1].repeat(n)
    out = np.zeros(len(start), bool)
    if len(start) < 2:
        return out
    v, cover = difference_set(max(1, length // 8))
    deep = (length - v + 1) // v * v
    padded = np.append(text, np.zeros(8, np.uint8)).astype(U64)
    word = padded[: len(text)].copy()
    for k in range(1, 8):
        word = (word << U64(8)) | padded[k : k + len(text)]

    def bytes_at(at: np.ndarray, size: int) -> list[np.ndarray]:
        """Keys, the first counts most, that compare as the ``size`` bytes from each place on."""
        if size < 8:
            return [word[at] >> U64(64 - 8 * size)]
        return [word[at + min(k, size - 8)] for k in range(0, size, 8)]

    def runs(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(order, number of its run of equal keys for each place in that order)."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for k in keys:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
        return order, np.cumsum(new)

    # Ranks of the cover sample.
    room = np.repeat(off[1:], np.diff(off)) - np.arange(len(text))
    on = np.zeros(v, bool)
    on[cover] = True
    at, depth = np.flatnonzero(np.resize(on, len(text)) & (room >= v)), v
    rank = np.zeros(len(text), np.int64)
    order, number = runs(bytes_at(at, v))
    rank[at[order]] = number
    while depth < deep:
        step = min(depth, deep - depth)
        at = at[room[at] >= depth + step]
        order, number = runs([rank[at], rank[at + step]])
        rank[at[order]] = number
        depth += step

    order, run = runs(bytes_at(start, v))
    place, shift = np.arange(len(start)), shifts(v)
    while True:
        head = np.flatnonzero(np.diff(run, prepend=-2))
        size = np.diff(np.append(head, len(run)))
        more = np.repeat(size > 1, size)
        place, run = place[more], run[more]
        if not len(place):
            break
        head, size = np.flatnonzero(np.diff(run, prepend=-2)), size[size > 1]
        own = start[order[place]]
        pivot = np.repeat(own[head + size // 2], size)
        by = shift[own % v, pivot % v]
        side = np.sign(rank[own + by] - rank[pivot + by])
        # Places of equal rank may differ beyond it: every comparison reaches the same depth.
        tie = np.flatnonzero(side == 0)
        for a, b in zip(bytes_at(own[tie] + deep, length - deep), bytes_at(pivot[tie] + deep, length - deep)) if length > deep else ():
            side[tie] = np.where(side[tie] != 0, side[tie], (a > b).astype(np.int64) - (a < b))
        each = np.repeat(np.arange(len(head)), size)
        to = np.argsort(3 * each + side, kind="stable")
        order[place] = order[place][to]
        side, each = side[to], each[to]
        even = side == 0
        # Suffixes equal to the one in the middle are done.
        equal = np.bincount(each, weights=even)[each] > 1
        out[order[place[even & equal]]] = True
        place, run = place[~even], (3 * each + side)[~even]
    return out


def _by_block(block: np.ndarray, at: np.ndarray) -> pa.Table:
    order = np.lexsort((at, block))
    block, at = block[order], at[order]
    head = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
    edge = np.append(head, len(block)).tolist()
    return pa.table([pa.array(block[head]), pa.array([as_runs(at[a:b]).astype("<u4").tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())], names=["block", "at"])


def spans_of(runs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what strings of this length cover that start in the runs (sorted pairs of first and count)."""
    first, end = runs[::2], runs[::2] + runs[1::2] - 1 + length
    if not len(first):
        return first, end
    head = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
    return first[head], end[np.append(head[1:] - 1, len(end) - 1)]


def repeated_starts(docs: DataFrame, length: int, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(texts with their keys and what they carry; keys and starts of repeated strings)."""
    src = docs.select(F.struct(F.col(id_col), *[F.col(c) for c in carry]).alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = src.select("row", "text", F.xxhash64("id", "text").alias("k1"), F.xxhash64("text", "id", F.lit(7)).alias("k2"))
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v, cover = difference_set(max(1, length * 46 // 100))
    sample = through_table(tied(keyed.select("k1", "k2", "text"), length - v + 1, cover_positions(length, v, cover), 2 * partitions), "cover")
    within = concerned(keyed, sample).select("k1", "k2", "text").join(sample, ["k1", "k2"]).sortWithinPartitions("k1", "k2")
    starts = through_table(tied_in_blocks(within, length, reach_positions(length, v), partitions), "starts")
    return keyed, starts


def slot():
    return F.pmod(F.col("k1"), F.lit(SLOTS)).cast("int")


def concerned(keyed: DataFrame, found: DataFrame, how: str = "left_semi") -> DataFrame:
    """Texts that share a slot with a found key (or not); at most ``SLOTS`` slots are broadcast."""
    slots = found.select(slot().alias("slot")).distinct()
    return keyed.withColumn("slot", slot()).join(F.broadcast(slots), "slot", how).drop("slot")


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", whole_characters: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, n_bytes, n_removed, n_spans, kept binary) of every text.

    whole_characters: a character whose bytes go only in part stays.
    """
    return _removed(docs, length, id_col, text_col, False, whole_characters, carry)


def repeat_digests(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, text) of every text; text: what is left, bytes cut out of characters as U+FFFD."""
    left = _removed(docs, length, id_col, text_col, False, False, ())
    return left.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def _removed(docs: DataFrame, length: int, id_col: str, text_col: str, digest: bool, whole: bool, carry: tuple[str, ...]) -> DataFrame:
    keyed, starts = repeated_starts(docs, length, id_col, text_col, carry)
    kind = keyed.schema["row"].dataType.simpleString()
    last = "kept_sha256 string" if digest else "kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, "text"):
            raw, n_removed, n_spans, kept = data.tobytes(), [], [], []
            tail = (data & 0xC0) == 0x80
            for i, x in enumerate(rows.column(2)):
                own = raw[off[i] : off[i + 1]]
                a, b = spans_of(np.frombuffer(x.as_buffer(), "<u4").astype(np.int64), length) if x.is_valid else (np.zeros(0, np.int64),) * 2
                if whole and len(a):
                    inner = np.append(tail[off[i] : off[i + 1]], False)
                    for _ in range(3):
                        a, b = a + inner[a], b - inner[b]
                    a, b = a[b > a], b[b > a]
                out = b"".join(own[p:q] for p, q in zip([0, *b.tolist()], [*a.tolist(), len(own)]))
                n_removed.append(len(own) - len(out))
                n_spans.append(len(a))
                kept.append(hashlib.sha256(out).hexdigest() if digest else out)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(off)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())], names=["row", "n_bytes", "n_removed", "n_spans", last.split()[0]])

    cut = concerned(keyed, starts).join(starts, ["k1", "k2"], "left").select("row", "text", "at").mapInArrow(run, f"row {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, {last}")
    raw = F.encode("text", "UTF-8")
    whole_text = (F.sha2(raw, 256) if digest else raw).alias(last.split()[0])
    rest = concerned(keyed, starts, "left_anti").select("row", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), whole_text)
    return cut.unionByName(rest).select("row.*", "n_bytes", "n_removed", "n_spans", last.split()[0])
