"""Queries without SQL against brute force on the smallest tables."""

import collections
import html
import re

import numpy as np

from tessera import catalog


def test_greedy_dedupe_by_label(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    unit = lambda v: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    x = {r.vec_id: unit(r.embedding) for r in rows}
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.label].append(r.vec_id)
    want = set()
    for label, ids in groups.items():
        kept = []
        for i in sorted(ids, key=lambda i: (-round(float(x[i] @ x[0]), 12), i)):
            near = next((k for k in kept if x[k[0]] @ x[i] >= 0.9), None)
            if near:
                near[1] += 1
            else:
                kept.append([i, 0])
        want |= {(label, i, n + 1, m) for n, (i, m) in enumerate(kept)}
    got = {(r.grp, r.id, r.rank, r.n_merged) for r in catalog.QUERIES["greedy_vector_dedupe"](spark, small).collect()}
    assert {g[:2] for g in got} == {w[:2] for w in want} and {(g[1], g[3]) for g in got} == {(w[1], w[3]) for w in want}


def test_condition_links(spark, small):
    """Each part's name, in the plural behind a qualifier, reaches the heading that has its words turned around."""
    parts = spark.read.parquet(f"{small}/part.parquet").collect()
    got = {(r.id, r.key, r.method) for r in catalog.QUERIES["condition_links"](spark, small).collect()}
    assert got == {(r.p_partkey, f"D:{r.p_name}", "name_variant") for r in parts}


def test_clean_pages(spark, small):
    table = {bytes([b]).decode("cp1252", "ignore") or chr(b): b for b in range(0x80, 0x100)}

    def clean(s):
        out, i = [], 0
        while i < len(s):
            lead = table.get(s[i], 0)
            n = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
            part = [table.get(c, 0) for c in s[i : i + n]]
            if n > 1 and len(part) == n and all(0x80 <= b < 0xC0 for b in part[1:]):
                out.append(bytes(part).decode("utf-8", "ignore") or s[i : i + n])
                i += n
            else:
                out.append(s[i])
                i += 1
        return html.unescape(re.sub(r"<[^>]{1,40}>", " ", "".join(out)))

    pages = {r.page_id: clean(r.html or "") for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert {r.page_id: r.text for r in catalog.QUERIES["clean_pages"](spark, small).collect()} == pages


def test_chunked_documents(spark, small):
    from tessera.functions import vectors
    from tessera.operators import chunk

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = collections.defaultdict(list)
    for r in catalog.QUERIES["chunked_documents"](spark, small).collect():
        got[r.doc_id].append((r.offset, r.text))
    squeeze = lambda s: re.sub(r"\s+", "", s)
    for i, text in docs.items():
        chunks = [t for _, t in sorted(got[i])]
        if chunk.layout_of([text]) == "semantic" and len([s for s in re.split(chunk.SENTENCE, text) if s.strip()]) >= 3:
            # Cuts by distance have no overlap: together they are the text.
            assert squeeze("".join(chunks)) == squeeze(text)
        else:
            assert chunks == [c.text for c in chunk.document_chunks([(1, text)], "", vectors.hashed)[1]]
