"""Chunk borders against a walk line by line; layouts; cuts by distance."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import vectors
from tessera.operators import chunk


def walk(blocks, layout, budget, overlap):
    """Line by line: what the borders must be."""
    out, buf, n, section, code = [], [], 0, "", ""
    page_from = page_to = blocks[0][0]

    def flush():
        nonlocal buf, n, page_from
        text = "\n".join(buf).strip()
        if text:
            out.append((text, section, code, page_from, page_to))
        buf, n, page_from = [], 0, page_to

    for page_to, text in blocks:
        for line in chunk.joined_headings(text.split("\n")):
            hit = chunk.FINDERS[layout](line)
            if hit and hit[1] != section and buf:
                flush()
            if hit:
                code, section = hit
            buf.append(line)
            n += chunk.tokens(line)
            if n >= budget:
                kept = list(buf)
                flush()
                for line_ in reversed(kept):
                    buf.insert(0, line_)
                    n += chunk.tokens(line_)
                    if n >= overlap:
                        break
    if buf:
        flush()
    return out


def walk_paragraphs(blocks, budget):
    out, buf, n = [], [], 0
    page_from = page_to = blocks[0][0]

    def flush():
        nonlocal buf, n, page_from
        text = "\n".join(buf).strip()
        if text:
            out.append((text, "", "", page_from, page_to))
        buf, n, page_from = [], 0, page_to

    for page_to, text in blocks:
        groups, now = [], []
        for line in [*text.split("\n"), ""]:
            if line.strip():
                now.append(line)
            elif now:
                groups.append(now)
                now = []
        for lines in groups:
            size = sum(map(chunk.tokens, lines))
            if size > budget:
                if buf:
                    flush()
                for line in lines:
                    buf.append(line)
                    n += chunk.tokens(line)
                    if n >= budget:
                        flush()
                continue
            if n + size > budget and buf:
                carried = buf[-2:]
                flush()
                buf, n = carried, sum(map(chunk.tokens, carried))
            buf += lines
            n += size
    if buf:
        flush()
    return out


LINES = ["4.1 Therapeutic indications", "4.2 Posology and method", "4.8", "Undesirable effects", "4.1 12 34 56", "12 Of a table", "", "  ", "short", "a longer line of plain text " * 3, "x" * 90, "4 Clinical particulars", "Warnings and precautions", "Possible side effects", "How to store this"]


@pytest.mark.parametrize("layout", ["spc", "pil", "heading"])
def test_section_borders(layout):
    rnd = random.Random(layout)
    for _ in range(300):
        blocks = [(p, "\n".join(rnd.choice(LINES) for _ in range(rnd.randrange(1, 25)))) for p in range(1, rnd.randrange(2, 5))]
        blocks = [b for b in blocks if b[1].strip()]
        if blocks:
            budget, overlap = rnd.choice([(20, 5), (60, 10), (40, 39), (10, 1)])
            assert [tuple(c) for c in chunk.section_chunks(blocks, layout, budget, overlap)] == walk(blocks, layout, budget, overlap)


def test_paragraph_borders():
    rnd = random.Random(3)
    for _ in range(300):
        blocks = [(p, "".join(rnd.choice(["word ", "line " * 12, "\n", "\n\n", "\n \n"]) for _ in range(rnd.randrange(1, 30)))) for p in range(1, rnd.randrange(2, 5))]
        blocks = [b for b in blocks if b[1].strip()]
        if blocks:
            budget = rnd.choice([10, 30, 60])
            assert [tuple(c) for c in chunk.paragraph_chunks(blocks, budget)] == walk_paragraphs(blocks, budget)


def test_borders_by_distance():
    rnd = random.Random(4)
    for _ in range(100):
        blocks = [(p, " ".join(rnd.choice(["One is.", "Two are here!", "Three?", "A much longer sentence stands here."]) for _ in range(rnd.randrange(1, 20)))) for p in (1, 2)]
        units = [s.strip() for s in re.split(chunk.SENTENCE, "\n".join(t for _, t in blocks)) if s.strip()]
        budget = rnd.choice([8, 20, 40])
        got = list(chunk.distance_chunks(blocks, vectors.hashed, budget))
        if len(units) < 3:
            assert got == list(chunk.paragraph_chunks(blocks, budget))
            continue
        x = vectors.hashed(units).astype(np.float32)
        x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
        far = 1 - (x[:-1] * x[1:]).sum(axis=1)
        cuts, want, held, n = set(np.flatnonzero(far >= np.percentile(far, 88)).tolist()), [], [], 0
        for i, u in enumerate(units):
            held.append(u)
            n += chunk.tokens(u)
            if i in cuts and n >= budget // 4 or n >= budget:
                want.append(" ".join(held))
                held, n = [], 0
        want += [" ".join(held)] if held else []
        assert [c.text for c in got] == want
        assert got[0].page_from == 1 and got[-1].page_to == 2


def test_layouts():
    spc, pil = "4.1 Therapeutic indications\ntext\n4.2 Posology and method", "1. What Zed is and what it is used for\n2. Possible side effects"
    head = "Dosage and administration\ntext\nOverdose"
    assert chunk.layout_of([spc]) == "spc" and chunk.layout_of([pil]) == "pil" and chunk.layout_of([head]) == "heading"
    assert chunk.layout_of(["just text"]) == "semantic" and chunk.layout_of(["just text"], cut=False) == "fixed"
    # Numbers alone don't make a summary; a kind without a template has headings at most.
    assert chunk.layout_of(["1. Name of it\n2. Content list"]) == "semantic"
    assert chunk.layout_of([pil], "PAR") == "semantic" and chunk.layout_of([spc], "epar") == chunk.layout_of([head], "par") == "heading" and chunk.layout_of(["x"], "pil") == "pil"
    # Only the first pages count.
    assert chunk.layout_of(["x"] * 6 + [spc]) == "semantic"


def test_documents(spark):
    spc = "4.1 Therapeutic indications\n" + "line of text here\n" * 200 + "4.2 Posology and method\nsome dose\n5.1\nPharmacodynamic properties\nmore"
    plain = "\n\n".join(f"paragraph {i} " + "word " * 60 for i in range(30))
    rows = [("a", 1, spc), ("b", 2, "last page"), ("b", 1, plain), ("c", 1, "  "), ("d", None, None)]
    blocks = spark.createDataFrame(rows, "doc_id string, page int, text string").withColumn("path", F.lit("clash"))
    got = sorted(chunk.chunk(blocks).collect(), key=lambda r: (r.doc_id, r.offset))
    assert {(r.doc_id, r.path) for r in got} == {("a", "spc"), ("b", "fixed")} and len({r.chunk_id for r in got}) == len(got)
    assert [(r.section_code, r.section) for r in got if r.doc_id == "a"][-2:] == [("4.2", "posology"), ("5.1", "pharmacodynamics")]
    assert [(r.text, r.page_from, r.page_to) for r in got if r.doc_id == "b"] == [(c[0], c[3], c[4]) for c in walk_paragraphs([(1, plain), (2, "last page")], 512)]
    single = chunk.chunk(blocks.filter("doc_id <> 'b'"), page=None, embed=vectors.hashed)
    assert [r.text for r in sorted(single.collect(), key=lambda r: r.offset)] == [r.text for r in got if r.doc_id == "a"]
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    assert not chunk.chunk(blocks.limit(0)).count()
