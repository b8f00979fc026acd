"""Chunking of documents by layout: numbered sections, leaflet sections, headings, paragraphs, or cuts by distance.

A document's lines become arrays: their tokens, pages and sections. Borders come from running sums
and binary search, a step a chunk, not a line: a chunk ends where the section changes, or where its
tokens reach the budget, and then the next one starts again with the last lines that reach the overlap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET, OVERLAP, HEAD_BLOCKS, PERCENTILE = 512, 64, 6, 88
#: Sections of product summaries by their numbers.
SUMMARY_SECTIONS = {
    "1": "name", "2": "composition", "3": "pharmaceutical_form", "4": "clinical_particulars", "4.1": "indications", "4.2": "posology", "4.3": "contraindications", "4.4": "warnings", "4.5": "interactions",
    "4.6": "pregnancy", "4.7": "driving", "4.8": "adverse_effects", "4.9": "overdose", "5": "pharmacological_properties", "5.1": "pharmacodynamics", "5.2": "pharmacokinetics", "5.3": "preclinical_safety",
    "6": "pharmaceutical_particulars", "6.1": "excipients", "6.2": "incompatibilities", "6.3": "shelf_life", "6.4": "storage", "6.5": "container", "6.6": "disposal",
    "7": "marketing_authorisation_holder", "8": "marketing_authorisation_number", "9": "date_of_authorisation", "10": "date_of_revision",
}
#: Headings of leaflets, and words of other headings, with the sections that they open.
LEAFLET_HEADINGS = [
    (r"(?i)what .{1,40} is and what it is used for", "indications"), (r"(?i)(before you take|before you use|what you need to know before)", "warnings"), (r"(?i)how to (take|use)\b", "posology"),
    (r"(?i)possible side effects", "adverse_effects"), (r"(?i)how to store", "storage"), (r"(?i)contents of the pack|further information", "composition"),
]
HEADING_WORDS = {
    "indication": "indications", "contraindication": "contraindications", "posology": "posology", "dosage": "posology", "administration": "posology", "adverse": "adverse_effects",
    "undesirable effect": "adverse_effects", "side effect": "adverse_effects", "warning": "warnings", "precaution": "warnings", "interaction": "interactions", "pharmacodynamic": "pharmacodynamics",
    "mechanism of action": "pharmacodynamics", "pharmacokinetic": "pharmacokinetics", "overdose": "overdose", "pregnancy": "pregnancy", "composition": "composition", "clinical trial": "clinical_trials", "efficacy": "efficacy",
}
NUMBERED, NUMBER_ALONE = r"^\s*(\d{1,2}(?:\.\d{1,2})?)[.)]?\s+(\S.{2,80})$", r"^\s*(\d{1,2}(?:\.\d{1,2})?)[.)]?\s*$"
HEADING, SENTENCE = r"^\s*([A-Z0-9][\w .()/-]{2,60})\s*$", r"(?<=[.!?。！？])\s+|\n{2,}"
TITLE_LENGTH, LEAFLET_LENGTH = 80, 120
#: Layouts of known kinds of documents; kinds without a template look for headings only.
KNOWN, UNTEMPLATED = {"spc", "pil"}, {"par", "epar"}

_BY_LENGTH = sorted(HEADING_WORDS, key=len, reverse=True)
Section = tuple[str, str]  # code, name


class Chunk(NamedTuple):
    text: str
    section: str
    section_code: str
    page_from: int
    page_to: int


def tokens(text: str) -> int:
    return max(1, len(text) // 3)


def summary_section(line: str) -> Section | None:
    """A known number and a short title that is mostly words; a row of a table is none."""
    m = re.match(NUMBERED, line)
    if not m or m[1] not in SUMMARY_SECTIONS:
        return None
    title = m[2].strip()
    digits = sum(c.isdigit() for c in title)
    return None if len(title) > TITLE_LENGTH or 3 * digits > len(title) else (m[1], SUMMARY_SECTIONS[m[1]])


def leaflet_section(line: str) -> Section | None:
    bare = line.strip()
    if not bare or len(bare) > LEAFLET_LENGTH:
        return None
    return next((("", name) for pattern, name in LEAFLET_HEADINGS if re.search(pattern, bare)), None)


def heading_section(line: str) -> Section | None:
    """Of a line that looks like a heading: the longest word of the list that stands in it."""
    if not re.match(HEADING, line):
        return None
    return next((("", HEADING_WORDS[w]) for w in _BY_LENGTH if w in line.lower()), None)


FINDERS: dict[str, Callable[[str], Section | None]] = {"spc": summary_section, "pil": leaflet_section, "heading": heading_section}


def joined_headings(lines: list[str]) -> list[str]:
    """A known section number that stands alone takes its title from the next filled line, if that is short."""
    out, skip = [], 0
    for i, line in enumerate(lines):
        if skip:
            skip -= 1
            continue
        m = re.match(NUMBER_ALONE, line)
        if m and m[1] in SUMMARY_SECTIONS:
            j = next((j for j in range(i + 1, len(lines)) if lines[j].strip()), None)
            if j is not None and len(lines[j].strip()) <= TITLE_LENGTH:
                out.append(f"{m[1]} {lines[j].strip()}")
                skip = j - i
                continue
        out.append(line)
    return out


def layout_of(pages: list[str], kind: str = "", cut: bool = True) -> str:
    """spc, pil, heading, or semantic (fixed where nothing can measure distances): by the kind, else by two different headings on the first pages.

    Leaflets come first, as they are numbered too; a summary shows by numbers with a dot.
    """
    kind = kind.lower()
    if kind in KNOWN:
        return kind
    lines = joined_headings([x.strip() for p in pages[:HEAD_BLOCKS] for x in p.split("\n")])
    found = {name: {s for x in lines if (s := find(x))} for name, find in FINDERS.items()}
    if kind not in UNTEMPLATED:
        if len(found["pil"]) >= 2:
            return "pil"
        if len({s for s in found["spc"] if "." in s[0]}) >= 2:
            return "spc"
    return "heading" if len(found["heading"]) >= 2 else "semantic" if cut else "fixed"


def budget_cuts(size: np.ndarray, budget: int, overlap: int) -> list[tuple[int, int, bool]]:
    """(first, last, full) of chunks of lines with these tokens: a scan that starts again behind each chunk, with its overlap.

    The last lines are a chunk even if the overlap is all of them.
    """
    total = np.concatenate([[0], np.cumsum(size)])
    out, start, fresh = [], 0, 0
    while start < len(size):
        end = max(int(np.searchsorted(total, total[start] + budget)) - 1, fresh)
        if end >= len(size):
            out.append((start, len(size) - 1, False))
            break
        out.append((start, end, True))
        # The shortest end of the chunk that reaches the overlap, at least a line, at most the chunk.
        start = max(start, min(end, int(np.searchsorted(total, total[end + 1] - overlap, "right")) - 1))
        fresh = end + 1
    return out


def section_chunks(blocks: list[tuple[int, str]], layout: str, budget: int = BUDGET, overlap: int = OVERLAP) -> Iterator[Chunk]:
    """By sections and budget. A chunk reaches to the page on which it was ended, and the next one starts there."""
    rows = [(page, line) for page, text in blocks for line in joined_headings(text.split("\n"))]
    size = np.array([tokens(x) for _, x in rows])
    found = [FINDERS[layout](x) for _, x in rows]
    at, now, opened = [0], ("", ""), [("", "")]
    for i, s in enumerate(found):
        if s and s[1] != now[1] and i:
            at.append(i)
            opened.append(s)
        elif s and not i:
            opened[0] = s
        now = s or now
    page_from = blocks[0][0]
    for a, b, section in zip(at, [*at[1:], len(rows)], opened):
        # A later heading of the same section may have another number.
        for first, last, full in budget_cuts(size[a:b], budget, overlap):
            text = "\n".join(x for _, x in rows[a + first : a + last + 1]).strip()
            page_to = rows[a + last][0] if full else rows[b][0] if b < len(rows) else blocks[-1][0]
            code = next((s[0] for s in reversed(found[a : a + last + 1]) if s), section[0])
            if text:
                yield Chunk(text, section[1], code, page_from, page_to)
            page_from = page_to


def paragraph_chunks(blocks: list[tuple[int, str]], budget: int = BUDGET, overlap: int = OVERLAP) -> Iterator[Chunk]:
    """Whole paragraphs up to the budget; one that alone exceeds it is cut at lines. The last two lines are carried on."""
    held: list[str] = []
    n, first = 0, blocks[0][0]

    def ended(page: int) -> Iterator[Chunk]:
        nonlocal held, n, first
        text = "\n".join(held).strip()
        if text:
            yield Chunk(text, "", "", first, page)
        held, n, first = [], 0, page

    for page, text in blocks:
        for paragraph in re.split(r"\n(?:[^\S\n]*\n)+", text):
            lines = [x for x in paragraph.split("\n") if x.strip()]
            size = [tokens(x) for x in lines]
            if not lines:
                continue
            if sum(size) > budget:
                if held:
                    yield from ended(page)
                for a, b in _without_overlap(np.array(size), budget):
                    held = lines[a : b + 1]
                    n = sum(size[a : b + 1])
                    if n >= budget:
                        yield from ended(page)
                continue
            if n + sum(size) > budget and held:
                carried = held[-2:] if overlap else []
                yield from ended(page)
                held, n = carried, sum(map(tokens, carried))
            held += lines
            n += sum(size)
    if held:
        yield from ended(blocks[-1][0])


def _without_overlap(size: np.ndarray, budget: int) -> list[tuple[int, int]]:
    total = np.concatenate([[0], np.cumsum(size)])
    out, start = [], 0
    while start < len(size):
        end = min(int(np.searchsorted(total, total[start] + budget)) - 1, len(size) - 1)
        out.append((start, end))
        start = end + 1
    return out


def distance_chunks(blocks: list[tuple[int, str]], embed: Callable[[list[str]], np.ndarray], budget: int = BUDGET, percentile: float = PERCENTILE) -> Iterator[Chunk]:
    """Cuts behind sentences whose next one is far (that percentile of the document's distances) once a quarter of the budget is full, and at the budget.

    A document of under three sentences is cut by paragraphs.
    """
    text, starts = "\n".join(t for _, t in blocks), np.cumsum([0] + [len(t) + 1 for _, t in blocks])[:-1]
    units, places, at = [], [], 0
    for unit in (s.strip() for s in re.split(SENTENCE, text)):
        if unit:
            at = text.index(unit, at)
            places.append(at)
            units.append(unit)
            at += len(unit)
    if len(units) < 3:
        yield from paragraph_chunks(blocks, budget)
        return
    x = np.asarray(embed(units), np.float32)
    x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)
    far = 1 - (x[:-1] * x[1:]).sum(axis=1)
    shift = np.append(np.flatnonzero(far >= np.percentile(far, percentile)), len(units))
    page = [blocks[i][0] for i in np.searchsorted(starts, places, "right") - 1]
    total = np.concatenate([[0], np.cumsum([tokens(u) for u in units])])
    start, page_from = 0, page[0]
    while start < len(units):
        full = int(np.searchsorted(total, total[start] + budget)) - 1
        quarter = int(np.searchsorted(total, total[start] + budget // 4)) - 1
        end = min(full, int(shift[np.searchsorted(shift, max(quarter, start))]), len(units) - 1)
        yield Chunk(" ".join(units[start : end + 1]).strip(), "", "", page_from, page[end])
        start, page_from = end + 1, page[end]


def document_chunks(blocks: list[tuple[int, str]], kind: str = "", embed: Callable[[list[str]], np.ndarray] | None = None, budget: int = BUDGET, overlap: int = OVERLAP) -> tuple[str, list[Chunk]]:
    """(layout, chunks) of the pages (page, text) of a document."""
    blocks = [(p, t) for p, t in blocks if t and t.strip()]
    if not blocks:
        return "", []
    layout = layout_of([t for _, t in blocks], kind, embed is not None)
    if layout in FINDERS:
        return layout, list(section_chunks(blocks, layout, budget, overlap))
    if layout == "semantic":
        return layout, list(distance_chunks(blocks, embed, budget))
    return layout, list(paragraph_chunks(blocks, budget, overlap))


COLUMNS = "offset int, chunk_id string, text string, section string, section_code string, page_from int, page_to int, n_tokens int, path string"


def chunk(blocks: DataFrame, doc: str = "doc_id", page: str | None = "page", text: str = "text", kind: str | None = None, embed: Callable[[list[str]], np.ndarray] | None = None, budget: int = BUDGET) -> DataFrame:
    """(doc, offset, chunk_id, text, section, section_code, page_from, page_to, n_tokens, path) of documents.

    page: the column that numbers a document's rows, whose texts then meet in one task; None where a row is a
    whole document, which is cut where it lies, without a shuffle. embed: what measures distances (``vectors.hashed``);
    without it, text that has no headings is cut by paragraphs.
    """
    name = blocks.schema[doc].dataType.simpleString()
    rows = blocks.select(F.col(doc).alias("doc"), (F.col(page).cast("int") if page else F.lit(1)).alias("page"), F.coalesce(F.col(text), F.lit("")).alias("text"), (F.coalesce(F.col(kind), F.lit("")) if kind else F.lit("")).alias("kind"))
    titles = ["doc", *[c.split()[0] for c in COLUMNS.split(", ")]]

    def made(document: object, pages: list[tuple[int, str]], known: str) -> list[tuple]:
        layout, found = document_chunks(pages, known, embed, budget)
        return [(document, i, hashlib.sha256(f"{document}:{i}".encode()).hexdigest()[:32], c.text, c.section, c.section_code, c.page_from, c.page_to, tokens(c.text), layout) for i, c in enumerate(found)]

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            # A hundred documents at a time.
            for lo in range(0, len(f), 100):
                part = f.iloc[lo : lo + 100]
                yield pd.DataFrame([r for d, p, t, k in part.itertuples(index=False) for r in made(d, [(p, t)], k)], columns=titles)

    def whole(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["page", "text"])
        return pd.DataFrame(made(f["doc"].iloc[0], list(zip(f["page"].tolist(), f["text"].tolist())), f["kind"].iloc[0]), columns=titles)

    out = f"doc {name}, {COLUMNS}"
    done = rows.groupBy("doc").applyInPandas(whole, out) if page else rows.mapInPandas(each, out)
    return done.withColumnRenamed("doc", doc)
