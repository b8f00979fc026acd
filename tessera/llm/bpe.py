"""Byte-level BPE over ragged arrays: pre-tokens, vocabularies and two encoders.

Pre-tokens are cut for a whole slice of texts at once from code point classes;
each different pre-token is encoded once per worker and remembered up to a
documented number of entries.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json

import numpy as np
import regex

from tessera.llm.ragged import U64, HashIndex, differing, mix, prefix_hash, span_hash, spread, take_ragged

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Pre-tokens that a worker remembers; beyond it, it starts anew.
CACHE_WORDS = 1_000_000
_NONE = np.int32(2**31 - 1)


@functools.lru_cache(1)
def code_point_classes() -> np.ndarray:
    """The class of every code point, as the pre-token pattern sees it."""
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            gap = lambda i: i if i < 0xD800 else i + 0x800
            table[gap(m.start()) : gap(m.end() - 1) + 1] = kind
    return table


def pre_tokens(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte positions at which the pre-tokens of the texts start, in order.

    The pattern is the public one: a contraction; an optional space with a run of
    letters, of numbers or of other characters; white space without its last
    character if more text follows; white space. No pre-token crosses a text.
    """
    n_bytes = len(data)
    if not n_bytes:
        return np.zeros(0, np.int64)
    text = data.tobytes().decode("utf-8")
    plain = len(text) == n_bytes
    cps = data if plain else np.frombuffer(text.encode("utf-32-le"), "<u4")
    at = None if plain else np.flatnonzero((data & 0xC0) != 0x80)
    n = len(cps)
    kind = code_point_classes()[cps]
    first = np.zeros(n + 3, bool)
    heads = off[:-1] if plain else np.searchsorted(at, off[:-1])
    first[heads] = True
    first[n:] = True
    run = np.ones(n, bool)
    run[1:] = (kind[1:] != kind[:-1]) | first[1:n]
    start = run.copy()
    last = np.flatnonzero((kind[:-1] == SPACE) & run[1:] & ~first[1:n])
    start[last] = True
    start[last[cps[last] == 32] + 1] = False
    ap = np.flatnonzero(cps == 39)
    ap = ap[start[ap]]
    ap = ap[~first[ap + 1]]
    if len(ap):
        more = np.concatenate([cps, np.zeros(2, cps.dtype)])
        a, b = more[ap + 1], np.where(first[ap + 2], 0, more[ap + 2])
        size = np.where(np.isin(a, [ord(c) for c in "stmd"]), 2, 0)
        size[(np.isin(a, [ord("r"), ord("v")]) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))] = 3
        ap, size = ap[size > 0], size[size > 0]
        start[ap + 1] = False
        end = ap + size
        end = end[end < n]
        start[end[kind[end] == LETTER]] = True
    out = np.flatnonzero(start)
    return out if plain else at[out]


@functools.lru_cache(1)
def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies show a byte as itself if printable, else as 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes by id, merge ranks of id pairs, and special strings."""

    def __init__(self, tokens: list[bytes | None], pairs: dict[tuple[int, int], tuple[int, int]] | None, special: dict[str, int], ranks: dict[bytes, int]):
        self.tokens, self.special, self.ranks = tokens, special, ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        lengths = np.array([len(t or b"") for t in tokens], np.int64)
        self.blob, self.blob_off = np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8), spread(lengths)
        if pairs is not None:
            left, right = np.array(list(pairs), np.int64).T
            rank, merged = np.array(list(pairs.values()), np.int64).T
            order = np.argsort(rank)
            self.merged = merged[order].astype(np.int32)
            self.pair_rank = HashIndex(17)
            self.pair_rank.insert(pair_key(left[order], right[order]), np.arange(len(order)))

    @staticmethod
    @functools.lru_cache(4)
    def from_json(path: str) -> Vocabulary:
        """A ``tokenizer.json`` of the byte-level kind, with its merges."""
        raw = json.load(open(path, encoding="utf-8"))
        model, chars = raw["model"], _byte_of_char()
        special = {t["content"]: t["id"] for t in raw.get("added_tokens", [])}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        tokens: list[bytes | None] = [None] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in vocab.items():
            tokens[i] = bytes(chars[c] for c in t)
        for t, i in special.items():
            tokens[i] = t.encode()
        pairs = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pairs[vocab[a], vocab[b]] = (r, vocab[a + b])
        return Vocabulary(tokens, pairs, special, {t: i for i, t in enumerate(tokens) if t is not None and i not in special.values()})

    @staticmethod
    @functools.lru_cache(4)
    def from_ranks(path: str) -> Vocabulary:
        """A ``.tiktoken`` file: a base64 token and its rank on each line."""
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb") if line.strip())}
        tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            tokens[i] = t
        return Vocabulary(tokens, None, {}, ranks)

    def ordered_merges(self) -> bool:
        """Whether every merge comes after those that make its two parts."""
        made = {int(m): r for r, m in enumerate(self.merged)}
        keys = self.pair_rank
        held = np.flatnonzero(keys.keys)
        pair = unmix(keys.keys[held])
        left, right, rank = (pair >> U64(32)).astype(np.int64), (pair & U64(0xFFFFFFFF)).astype(np.int64) - 1, keys.vals[held]
        return all(made.get(a, -1) < r and made.get(b, -1) < r for a, b, r in zip(left.tolist(), right.tolist(), rank.tolist()))


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix((left.astype(U64) << U64(32)) | (right.astype(U64) + U64(1)))


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    inv = [U64(pow(c, -1, 1 << 64)) for c in (0x94D049BB133111EB, 0xBF58476D1CE4E5B9)]
    x = x ^ (x >> U64(31)) ^ (x >> U64(62))
    x = x * inv[0]
    x = x ^ (x >> U64(27)) ^ (x >> U64(54))
    x = x * inv[1]
    return x ^ (x >> U64(30)) ^ (x >> U64(60))


def merge_in_step(vocab: Vocabulary, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of the words, by rank-synchronous merging.

    All words stand in one ragged array. In each round every word applies its own
    lowest-ranked pair at all its places at once; a run of overlapping places takes
    every second from the left. Words with no pair left drop out. As merges come
    after those that make their parts, this equals merging one place at a time.
    """
    n_words = len(off) - 1
    sym, length = vocab.byte_id[data], np.diff(off)
    word = np.repeat(np.arange(n_words, dtype=np.int64), length)
    rank = np.full(len(sym), _NONE, np.int32)
    same = np.flatnonzero(word[1:] == word[:-1]) if len(word) > 1 else np.zeros(0, np.int64)
    rank[same] = _pair_ranks(vocab, sym[same], sym[same + 1])
    out_sym, out_word = [], []
    while len(sym):
        head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.append(head, len(sym)))
        best = np.minimum.reduceat(rank, head)
        over = best == _NONE
        each = np.repeat(best, size)
        if over.any():
            gone = np.repeat(over, size)
            out_sym.append(sym[gone])
            out_word.append(word[gone])
            stay = ~gone
            sym, word, rank, each = sym[stay], word[stay], rank[stay], each[stay]
            if not len(sym):
                break
        pick = np.flatnonzero(rank == each)
        if len(pick) > 1:
            new_run = np.concatenate([[True], np.diff(pick) != 1])
            in_run = np.arange(len(pick)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
            pick = pick[(in_run & 1) == 0]
        sym[pick] = vocab.merged[rank[pick]]
        keep = np.ones(len(sym), bool)
        keep[pick + 1] = False
        moved = np.cumsum(keep) - 1
        sym, word, rank = sym[keep], word[keep], rank[keep]
        new = moved[pick]
        redo = np.concatenate([new[new < len(sym) - 1], new[new > 0] - 1])
        inside = word[redo] == word[redo + 1]
        rank[new] = _NONE
        rank[redo] = _NONE
        redo = redo[inside]
        rank[redo] = _pair_ranks(vocab, sym[redo], sym[redo + 1])
    if not out_sym:
        return np.zeros(0, np.int32), np.zeros(n_words + 1, np.int64)
    sym, word = np.concatenate(out_sym), np.concatenate(out_word)
    order = np.argsort(word, kind="stable")
    return sym[order], spread(np.bincount(word, minlength=n_words))


def _pair_ranks(vocab: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    found = vocab.pair_rank.lookup(pair_key(left, right))
    found[found < 0] = _NONE
    return found


def merge_by_heap(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """Ids of one word: a heap of candidate pairs over doubly linked pieces.

    The pair whose joined bytes have the lowest rank goes first, the leftmost of
    equals; entries of pieces that have changed since are skipped.
    """
    n = len(word)
    end = list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = after[i] if end[i] else n
        if j >= n or not end[i] or end[j] != e:
            continue
        end[i], end[j] = e, 0
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(word[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:e])) is not None:
            heapq.heappush(heap, (r, p, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


class MinimalPerfectHash:
    """n keys go to places 0..n-1, without one to spare: bit fields by level, and ranks.

    At each level the keys that are left are dealt to twice as many bits; those alone
    on theirs set it and stay, the others go on. A key's place is the number of bits
    set before its own. A handful of array operations build it.
    """

    def __init__(self, keys: np.ndarray) -> None:
        left, fields, self.begin = np.asarray(keys, U64), [], [0]
        while len(left):
            size = 2 * len(left) + 1
            slot = self._slot(left, len(fields), size)
            alone = np.bincount(slot, minlength=size) == 1
            fields.append(alone)
            self.begin.append(self.begin[-1] + size)
            left = left[~alone[slot]]
        self.bits = np.concatenate([*fields, np.zeros(1, bool)])
        self.rank = spread(self.bits)
        self.key, self.item = np.zeros(len(keys), U64), np.zeros(len(keys), np.int32)
        place = self._place(keys)
        self.key[place], self.item[place] = keys, np.arange(len(keys))

    def _slot(self, keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + U64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % U64(size)).astype(np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """The place that the first level with its bit set gives each key; 0 if there is none."""
        out, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for level, (a, b) in enumerate(zip(self.begin[:-1], self.begin[1:])):
            at = a + self._slot(keys[left], level, b - a)
            here = self.bits[at]
            out[left[here]] = self.rank[at[here]]
            left = left[~here]
        return out

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key among those given at first; -1 for a stranger."""
        if not len(self.key):
            return np.full(len(keys), -1, np.int32)
        place = self._place(np.asarray(keys, U64))
        return np.where(self.key[place] == keys, self.item[place], np.int32(-1))


class WordCache:
    """Ids of the different pre-tokens that a worker has met.

    ``encode(data, off)`` gives ids and offsets of words; at most ``CACHE_WORDS``
    words are held, then the cache starts anew. Words are found by hash, and their
    bytes compared: a word whose hash another one has is encoded by itself.
    """

    def __init__(self, encode, limit: int = CACHE_WORDS) -> None:
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index = HashIndex(16)
        self.ids, self.blob = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.uint8)
        self.off, self.blob_off = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.words = 0
        self.generation = getattr(self, "generation", -1) + 1

    def find(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The number of each pre-token's word; valid until the next call."""
        if self.words > self.limit:
            self.clear()
        size = np.diff(np.append(start, len(data)))
        h = span_hash(prefix_hash(data), start, start + size)
        found = self.index.lookup(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            keys, at, inverse = np.unique(h[new], return_index=True, return_inverse=True)
            number = self._add(data, start[new[at]], size[new[at]])
            self.index.insert(keys, number)
            found[new] = number[inverse]
        held = self.blob_off[found + 1] - self.blob_off[found]
        odd = differing(data, start, size, self.blob, self.blob_off[found], held)
        if len(odd):
            found[odd] = self._add(data, start[odd], size[odd])
        return found

    def _add(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of words that are now held."""
        words, cut = take_ragged(data, start, size)
        ids, off = self.encode(words, cut)
        first, base, blob = self.words, self.off[self.words], self.blob_off[self.words]
        self.words += len(start)
        self.off, self.blob_off = _grown(self.off, self.words + 1), _grown(self.blob_off, self.words + 1)
        self.off[first : self.words + 1] = base + off
        self.blob_off[first : self.words + 1] = blob + cut
        self.ids, self.blob = _grown(self.ids, base + len(ids)), _grown(self.blob, blob + len(words))
        self.ids[base : base + len(ids)] = ids
        self.blob[blob : blob + len(words)] = words
        return np.arange(first, self.words, dtype=np.int32)

    def sizes(self, words: np.ndarray) -> np.ndarray:
        return self.off[words + 1] - self.off[words]


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


def cut_special(data: np.ndarray, off: np.ndarray, special: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts without the places of a special string.

    Returns (bytes, offsets of the pieces between them, the text of each piece,
    whether the special token follows the piece).
    """
    raw = data.tobytes()
    n = len(off) - 1
    if special not in raw:
        return data, off, np.arange(n), np.zeros(n, bool)
    parts, text, after = [], [], []
    for i in range(n):
        own = raw[off[i] : off[i + 1]].split(special)
        parts += own
        text += [i] * len(own)
        after += [True] * (len(own) - 1) + [False]
    return np.frombuffer(b"".join(parts), np.uint8), spread(np.array([len(p) for p in parts], np.int64)), np.array(text), np.array(after)
