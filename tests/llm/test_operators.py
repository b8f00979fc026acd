"""Each operator against brute force, with nulls, empty, long and repeated texts, and clashing columns."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe, bpe_codec, extraction, fingerprints, graph, licenses, packing, quality, ragged, repeats, simhash, token_counts, warc

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark, small):
    """(rows, DataFrame): texts of the smallest table and awkward ones; a column has a name that operators use."""
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()][:60]
    rnd = random.Random(3)
    rows = [*base, (10_000, None), (10_001, ""), (10_002, base[3][1]), (None, base[5][1]), (10_003, "ab" * 900), (10_004, "é" * 700), (10_004, "é" * 700), (10_005, " \t\n "), (10_006, "A b"), (10_007, "a  B"), (10_008, "a<|endoftext|>  b\n<|endoftext|>"), (10_009, "  lead\t\tx 'll don't  "), (10_010, "word " * 30_000)]
    for k in range(15):
        a = rnd.choice(base)[1]
        s = rnd.randrange(max(1, len(a) - 600))
        noise = lambda: "".join(rnd.choice("xyz ") for _ in range(rnd.randrange(50)))
        rows.append((20_000 + k, noise() + a[s : s + rnd.randrange(300, 600)] + noise()))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for clash in ("n_tokens", "kept", "fingerprint", "k1", "part"):
        frame = frame.withColumn(clash, F.lit(clash))
    return rows, frame


@pytest.fixture(scope="module")
def none(docs):
    return docs[1].limit(0)


def test_pre_tokens_follow_the_pattern():
    pattern, rnd = regex.compile(public_tokenizers.PATTERN), random.Random(1)
    letters = list("ab 's\n\tlvretdm1'’é  \r五٣½")
    for _ in range(3000):
        s = "".join(rnd.choice(letters) for _ in range(rnd.randrange(14)))
        data = np.frombuffer(s.encode(), np.uint8)
        cut = [*bpe.pre_tokens(data, np.array([0, len(data)])).tolist(), len(data)]
        assert [data[a:b].tobytes().decode() for a, b in zip(cut, cut[1:])] == pattern.findall(s)


def test_merges_in_step_need_ordered_merges():
    assert bpe.Vocabulary.from_json(JSON).ordered_merges()


def test_minimal_perfect_hash_fills_every_slot():
    keys = ragged.mix(np.arange(1, 5001, dtype=np.uint64))
    table = bpe.MinimalPerfectHash(keys)
    assert np.array_equal(table.lookup(keys), np.arange(5000)) and (table.key != 0).all()
    assert (table.lookup(ragged.mix(np.arange(9001, 9500, dtype=np.uint64))) == -1).all()


def test_token_counts(docs, none):
    rows, frame = docs
    library = Tokenizer.from_file(JSON)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows]
    got = token_counts.count_tokens(frame, JSON, 1024)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert token_counts.count_tokens(none, JSON).count() == 0


def test_packing_round_trip(docs, none):
    rows, frame = docs
    library = Tokenizer.from_file(JSON)
    whole = collections.defaultdict(list)
    for i, t in rows:
        whole[i].append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces = packing.pack(frame, JSON, 2048, 1, with_ids=True).collect()
    places, parts = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert any(len(w) == p.doc_tokens and zlib.crc32(w[p.start : p.start + p.length].tobytes()) == p.ids_crc32 and w[p.start : p.start + p.length].tobytes() == bytes(p.ids) for w in whole[p.doc_id])
        places[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id].append(p.length)
    assert all(sum(parts[i]) == sum(map(len, w)) for i, w in whole.items())
    short = 0
    for runs in places.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= 2048
        short += at < 2048
    assert short <= 1 and sorted(places) == list(range(len(places)))
    full = packing.sequences(packing.pack(frame, JSON, 64, 1, with_ids=True), 64).collect()
    assert all(len(s.ids) == 256 or s.n_tokens & (s.n_tokens - 1) == 0 for s in full)
    assert packing.pack(none, JSON).count() == 0


def test_bpe_codec(docs, none):
    rows, frame = docs
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = [library.encode_ordinary(t or "") for _, t in rows]
    want = [(i, len(e), sha(",".join(map(str, e)).encode()), sha((t or "").encode())) for (i, t), e in zip(rows, ids)]
    assert collections.Counter(map(tuple, bpe_codec.round_trip_digests(frame, RANKS).collect())) == collections.Counter(want)
    encoded = bpe_codec.encode(frame, RANKS)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == collections.Counter((i, tuple(e)) for (i, _), e in zip(rows, ids))
    assert collections.Counter((r.doc_id, bytes(r.bytes).decode()) for r in bpe_codec.decode(encoded, RANKS).collect()) == collections.Counter((i, t or "") for i, t in rows)
    assert bpe_codec.round_trip_digests(none, RANKS).count() == 0


def _quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    cover = {}
    for n in range(5, 11):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = collections.Counter(grams)
        inside = {p for i, g in enumerate(grams) if count[g] > 1 for p in range(i, i + n)}
        cover[n] = (len(inside), sum(len(words[p]) for p in inside))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), cover


def test_quality_measures(docs, none):
    rows, frame = docs
    want = collections.Counter()
    for i, t in rows:
        n, chars, symbols, dup, cover = _quality(t)
        want[(i, n, chars, symbols, dup, cover[5][0], n < 10 or 100 * cover[5][0] > 20 * n, tuple(cover[k][1] for k in range(5, 11)))] += 1
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, tuple(r[f"cover_{k}"] for k in range(5, 11))) for r in quality.judge(frame).collect())
    assert got == want
    judged = quality.judge(frame).filter("kept").count()
    kept = quality.keep_good(frame)
    assert kept.count() == judged and kept.columns == frame.columns
    assert quality.judge(none).count() == 0 and quality.keep_good(none).count() == 0


def test_warc_round_trip(spark, tmp_path):
    inner = "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5
    rows = [(i, f"http://x/{i}", inner + str(i % 7) if i % 3 else "tiny") for i in range(60)]
    rows += [(100, None, None), (101, "a\nb\rc", ""), (5, "repeated", "x" * 200), (None, "null id", "x" * 200), (102, "z", "x" * 200), (103, "long", "y" * 3_000_000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("record_type", F.lit(1))
    groups = collections.defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    want = []
    for i, _, h in rows:
        raw, first = (h or "").encode(), min(x for x in groups[h or ""] if x is not None)
        again = len(raw) >= 100 and i != first
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert collections.Counter(map(tuple, warc.round_trip(frame).collect())) == collections.Counter(want)
    path = f"file://{tmp_path}/archive"
    warc.write(frame, path)
    plain = collections.Counter(r.record_id for r in warc.read(spark, path, payload=False).collect())
    import gzip
    import os

    os.makedirs(f"{tmp_path}/zipped")
    for k, name in enumerate(x for x in os.listdir(f"{tmp_path}/archive") if x.endswith(".txt")):
        with open(f"{tmp_path}/archive/{name}", "rb") as f, open(f"{tmp_path}/zipped/{k}.warc.gz", "wb") as g:
            for record in re.split(rb"(?<=\r\n\r\n)(?=WARC/1.1\r\nWARC-Type: \w+\r\nWARC-Record-ID)", f.read()):
                g.write(gzip.compress(record))
    assert collections.Counter(r.record_id for r in warc.read(spark, f"file://{tmp_path}/zipped", payload=False).collect()) == plain
    some = warc.read(spark, path).filter("record_type = 'revisit' and record_id in ('<urn:page:7>', '<urn:page:8>', '<urn:page:1>')")
    assert {r.record_id for r in some.collect()} == {f"<urn:page:{i}>" for i in (7, 8)} & {f"<urn:page:{w[0]}>" for w in want if w[3] == "revisit"}
    assert warc.read(spark, path, payload=False).filter("payload is not null").count() == 0
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_warc_reader_steps_over_unwanted_blocks(tmp_path):
    body = b"WARC/1.1\r\nWARC-Type: %s\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(body % b"warcinfo" + body % b"response")
    with open(tmp_path / "a.warc", "rb") as f:
        assert [r[0] for r in warc.parse(f, [("warc-type", frozenset(["response"]))])] == ["response"]
    with open(tmp_path / "a.warc", "rb") as f:
        assert [r[-1] for r in warc.parse(f)] == [b"abcde", b"abcde"]
    (tmp_path / "b.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort")
    with open(tmp_path / "b.warc", "rb") as f, pytest.raises(ValueError, match="cut short"):
        list(warc.parse(f))


def _chunks(raw: bytes) -> list[int]:
    out, start, gear = [], 0, fingerprints._gear().tolist()
    while start < len(raw):
        out.append(start)
        end = min(len(raw), start + fingerprints.MOST)
        for i in range(start + fingerprints.LEAST - 1, end):
            h = sum(gear[raw[i - k]] << k for k in range(fingerprints.WINDOW) if i >= k) & 0xFFFFFFFF
            size = i + 1 - start
            if size <= fingerprints.USUAL and not h & int(fingerprints.STRICT) or size >= fingerprints.USUAL and not h & int(fingerprints.LOOSE):
                end = i + 1
                break
        start = end
    return out


def test_fingerprints(docs, none, spark):
    rows, frame = docs
    for t in ("", "short", rows[0][1][:3000], "ab" * 700):
        raw = t.encode()
        assert fingerprints.chunks(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist() == _chunks(raw)
    ids = collections.Counter(i for i, _ in rows)
    single = frame.filter("doc_id is not null").dropDuplicates(["doc_id"])
    texts = sorted(((r.doc_id, r.text or "") for r in single.select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.edited_likeness(single).collect()}
    assert len(got) == len(texts)
    parts = lambda f: {f[i : i + 16] for i in range(0, len(f), 16)}
    weight = lambda s: sum(int(x[12:], 16) for x in s)
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        mine, new = parts(r.fingerprint), parts(r.edited_fingerprint)
        assert r.near_edited == pytest.approx(weight(mine & new) / weight(mine) if mine else float(not new))
        assert r.near_next == pytest.approx(weight(mine & parts(got[texts[(k + 1) % len(texts)][0]].fingerprint)) / weight(mine) if mine else float(not got[texts[(k + 1) % len(texts)][0]].fingerprint))
    same = collections.defaultdict(set)
    for i, t in texts:
        same[t].add(got[i].fingerprint)
    assert all(len(f) == 1 for f in same.values())
    named = single.withColumn("doc_id", F.concat(F.lit("d"), F.lpad("doc_id", 6, "0")))
    assert {(int(r.doc_id[1:]), r.edited_sha256) for r in fingerprints.edited_likeness(named).collect()} == {(i, r.edited_sha256) for i, r in got.items()}
    assert fingerprints.edited_likeness(frame).count() == sum(ids.values())
    assert {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(single).collect()} == {i: r.fingerprint for i, r in got.items()}
    assert fingerprints.edited_likeness(none).count() == 0


def test_licenses(spark, none):
    mit = dict(licenses.TEXTS)["MIT"]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (2, mit.replace(",", " ;").replace("\n\n", "\n")), (3, "words\nReleased under the MIT Licence\nAll rights reserved"), (4, None), (5, ""), (6, mit + " and more"), (7, "© 1999 x\n(c) y\nLICENSED UNDER CC BY-NC 4.0"), (7, "again " * 50_000)]
    rows += [(8, "MIT License\n\nCopyright (c) 2020 Someone\nAll rights reserved.\n\n" + mit)]
    got = {(r.doc_id, r.notices): (r.text_license, r.n_notice_lines) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("notices", F.lit(0))).collect()}
    assert got == {(1, ""): ("MIT", 0), (2, ""): ("MIT", 0), (3, "MIT,all-rights-reserved"): (None, 2), (4, ""): (None, 0), (5, ""): (None, 0), (6, ""): (None, 0), (7, "CC-BY-NC-4.0"): ("CC-BY-NC-4.0", 1), (7, ""): (None, 0), (8, "all-rights-reserved"): ("MIT", 1)}
    assert licenses.scan(none).count() == 0


def _simhash(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket", [48, 2])
def test_simhash_groups(spark, docs, none, bucket, monkeypatch):
    rnd = random.Random(5)
    long = docs[0][0][1].split() * 4
    rows = [(i, t) for i, t in docs[0] if i is not None]
    for k in range(80):
        words = list(long)
        for _ in range(2):
            words[rnd.randrange(len(words))] = f"zz{rnd.randrange(1000)}"
        rows.append((60_000 + k, " ".join(words)))
    prints = [_simhash(t, 3) for _, t in rows]
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    every = sorted(root)
    for k, a in enumerate(every):
        for b in every[:k]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for (i, _), f in zip(rows, prints):
        least[find(f)] = min(least.get(find(f), i), i)
    want = collections.Counter((i, f"{f:016x}", least[find(f)]) for (i, _), f in zip(rows, prints))
    links = simhash.links_within_two
    monkeypatch.setattr(simhash, "links_within_two", lambda p: links(p, bucket))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("f", F.lit(1))
    assert collections.Counter(map(tuple, simhash.groups_within_two(frame).collect())) == want
    assert simhash.groups_within_two(none).count() == 0


@pytest.mark.parametrize("bucket", [48, 3])
def test_near_groups_finds_near_copies(spark, docs, bucket):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=300))) for i in range(60)]
    for k in range(40):
        words = rows[k % 4][1].split()
        for p in rnd.sample(range(300), 3):
            words[p] = "changed"
        rows.append((1000 + k, " ".join(words)))
    got = {r.doc_id: r.component_id for r in simhash.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket=bucket).collect()}
    assert got == {i: i if i < 1000 else (i - 1000) % 4 for i, _ in rows}


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(200)] + [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)] + [(5, 5)]
    root = {v: v for p in pairs for v in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.v: r.root for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {v: find(v) for v in root if any(v in p and p[0] != p[1] for p in pairs)}


PAGE = """<html><body class="has-sidebar"><header><a href=/>Site</a></header><nav><ul><li><a href=x>One</a></li></ul></nav>
<div id="cookie-notice">We use cookies to improve your experience on this site. Accept them.</div><script>var a = "<p>no</p>";</script>
<article><h1>Title &amp; more</h1><p>First   paragraph with
a good many words in it, so that it looks like prose.<p>Second &lt;one&gt;, with <b>mark</b>up.<br>It ends.
<div class="ad">Buy this great thing now, it is the best thing in the world, really.</div><p>To.</p></article>
<div class="comments"><p>Great article! I loved reading every single word of this article, thanks.</p></div><form>Your mail: <input></form>
<footer>&copy; me</footer><a title="x>y" href=z"""


def test_longer_repeats_have_lower_limits():
    """A text whose repeated words stay below the base rule goes by its one long repeat."""
    filler = [f"w{i}" for i in range(168)]
    long = [f"p{i}" for i in range(16)]
    text = " ".join(long + filler[:100] + long + filler[100:])
    found = quality.measure(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    assert not found["base_failed"][0] and found["cover_5"][0] * 100 < 20 * found["word_chars"][0] and not found["kept"][0]


def test_cut_corrects_the_classifier():
    """Short lines between paragraphs stay, a sentence between links goes, though their scores say otherwise."""
    prose = "This paragraph has a good many words, as prose does, and it goes on for quite a while before it ends at last."
    page = f"<div><p>{prose}<p>Short one<p>{prose}</div><div>" + "".join(f"<p><a href=x>Link number {i}</a></p>" + ("<p>All of it is here for you to read.</p>" if i == 3 else "") for i in range(6)) + "</div>"
    found = extraction.blocks(page)
    alone = [extraction.score(*b) > 0 for b in found]
    cut = extraction.label(found)
    assert [b[0] for b, a, c in zip(found, alone, cut) if c and not a] == ["Short one"]
    assert [b[0] for b, a, c in zip(found, alone, cut) if a and not c] == ["All of it is here for you to read."]


def test_minimum_cut_against_all_labellings():
    import itertools

    rnd = random.Random(3)
    for _ in range(150):
        n = rnd.randrange(1, 10)
        scores, ties = [rnd.uniform(-3, 3) for _ in range(n)], [{} for _ in range(n)]
        for i in range(1, n):
            for j in {i - 1, rnd.randrange(i)}:
                ties[i][j] = ties[j][i] = rnd.uniform(0.1, 2.5)
        cost = lambda x: sum(abs(s) for s, side in zip(scores, x) if (s > 0) != side) + sum(w for i in range(n) for j, w in ties[i].items() if i < j and x[i] != x[j])  # noqa: B023, E731
        assert cost(extraction.minimum_cut(scores, ties)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_extraction(spark, small):
    assert extraction.main_text(PAGE) == "Title & more\n\nFirst paragraph with a good many words in it, so that it looks like prose.\n\nSecond <one>, with markup. It ends.\n\nTo."
    for odd in ("", "<", "<p", "<script>x", "<!-- x", "</p></div>", "<p>" * 3000, "<div>" * 3000 + "x", "<a title='" * 2000):
        extraction.main_text(odd)
    pages = spark.read.parquet(f"{small}/pages.parquet")
    whole = {r.page_id: r.html for r in pages.collect()}
    for r in extraction.extract(pages).collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", whole[r.page_id], re.S)[1]
        body = re.sub(r"<[a-zA-Z/][^>]*>?", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n\n", body)))
        import html

        assert r.text == "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in body.split("\n\n")) if x) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, "u", None), (1, None, ""), (None, "u", PAGE), (2, "v", "<p>" + "long text. " * 300_000)], "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    assert sorted(r.n_chars for r in extraction.extract(odd).collect())[:2] == [0, 0]
    assert extraction.extract(odd.limit(0)).count() == 0


def _without_repeats(rows, length):
    count = collections.Counter()
    for _, t in rows:
        raw = (t or "").encode()
        count.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        mark = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if count[raw[p : p + length]] > 1:
                mark[p : p + length] = b"\1" * length
        kept = bytes(b for b, m in zip(raw, mark) if not m)
        spans = sum(1 for p in range(len(mark)) if mark[p] and not (p and mark[p - 1]))
        out.append((i, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def test_difference_sets():
    for most in (1, 7, 20, 92, 184):
        v, cover = repeats.difference_set(most)
        assert v <= most and {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_suffix_sort_against_all_strings():
    rnd = random.Random(1)
    for length in (1, 2, 5, 20, 60, 200, 400):
        for letters in (b"a", b"ab", b"abcdefgh"):
            for _ in range(4):
                source = bytes(rnd.choice(letters) for _ in range(1500))
                pieces = []
                for _ in range(rnd.randrange(1, 8)):
                    a = rnd.randrange(700)
                    own = bytearray(source[a : a + rnd.randrange(length, length + 300)])
                    own[rnd.randrange(len(own))] = rnd.randrange(97, 105)
                    pieces.append(bytes(own))
                strings = [p[i : i + length] for p in pieces for i in range(len(p) - length + 1)]
                count = collections.Counter(strings)
                got = repeats.equal_starts(np.frombuffer(b"".join(pieces), np.uint8), ragged.spread(np.array([len(p) for p in pieces])), length)
                assert got.tolist() == [count[x] > 1 for x in strings]


def _thue_morse(n, a, b):
    bits = [0]
    while len(bits) < n:
        bits += [1 - x for x in bits]
    return "".join(b if x else a for x in bits[:n])


def test_words_and_lines_that_fool_hashes_modulo_a_power_of_two():
    one, two = _thue_morse(2048, "a", "b"), _thue_morse(2048, "b", "a")
    library = Tokenizer.from_file(JSON)
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    cache, words, _, _ = token_counts.encode_slice(JSON, data, np.array([0, len(data)]))
    ids, _ = ragged.take_ragged(cache.ids, cache.off[words], cache.sizes(words))
    assert ids.tolist() == library.encode(f"{one} {two}", add_special_tokens=False).ids
    lines = np.frombuffer(f"{one}\n{two}\n{one}".encode(), np.uint8)
    assert quality.measure(lines, np.array([0, len(lines)]))["n_dup_lines"].tolist() == [1]
    both = np.frombuffer((one + two).encode(), np.uint8)
    prefix = ragged.prefix_hash(both)
    assert len(set(ragged.span_hash(prefix, np.array([0, 2048]), np.array([2048, 4096])).tolist())) == 2


def test_equal_hashes_are_compared(monkeypatch):
    """With a hash that tells lengths only, words, lines and n-grams still come out right."""
    fake = lambda prefix, start, end: (np.asarray(end) - np.asarray(start)).astype(np.uint64) + np.uint64(1)
    for module in (ragged, quality, bpe):
        monkeypatch.setattr(module, "span_hash", fake)
    text = "aa bb aa cc dd bb aa cc dd ee\nff gg\ngg ff\nff gg"
    data, off = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    n, _, _, dup, cover = _quality(text)
    got = quality.measure(data, off)
    assert got["n_dup_lines"][0] == dup and got["n_repeat_words"][0] == cover[5][0] and [got[f"cover_{k}"][0] for k in range(5, 11)] == [cover[k][1] for k in range(5, 11)]
    cache = bpe.WordCache(lambda d, o: bpe.merge_in_step(bpe.Vocabulary.from_json(JSON), d, o))
    words = cache.find(data, bpe.pre_tokens(data, off))
    assert ragged.take_ragged(cache.ids, cache.off[words], cache.sizes(words))[0].tolist() == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("length", "hot"), [(400, False), (200, False), (400, True)])
def test_repeats(docs, none, length, hot, monkeypatch):
    rows, frame = docs
    if hot:
        monkeypatch.setattr(repeats, "HOT_LEAST", 3)
        monkeypatch.setattr(repeats, "HOT_SHARE", 10**6)
    got = repeats.repeat_digests(frame, length).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == _without_repeats(rows, length)
    assert all("\ufffd" in r.text or hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got)
    if not hot:
        assert repeats.repeat_digests(none, length).count() == 0


def test_repeats_keep_whole_characters(spark):
    a, b = "é" * 250, "è" * 250
    rows = [(1, "x" + a + "1"), (2, "y" + a + "2"), (3, b), (4, "plain")]
    got = {r.doc_id: (bytes(r.kept).decode(), r.lang) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("l")), 200, whole_characters=True, carry=("lang",)).collect()}
    assert got[1] == ("x1", "l") and got[2][0] == "y2" and got[4][0] == "plain"


def test_archives_behind_a_mount(spark, tmp_path):
    """A scheme that only Hadoop's configuration resolves; connectors' schemes get the library's names."""
    pages = spark.createDataFrame([(i, f"http://h/{i}", "<p>" + "x" * 200) for i in range(5)], "page_id bigint, url string, html string")
    warc.write(pages, f"{tmp_path}/a", 100)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.mounted.link./in", f"file://{tmp_path}/a")
    found = warc.read(spark, "viewfs://mounted/in")
    assert found.count() == 5 and found.filter("record_type = 'response'").count() == 1
    assert warc.readable(spark, f"{tmp_path}/none") == f"{tmp_path}/none" and {warc.SCHEMES[x] for x in ("s3a", "s3n")} == {"s3"}
