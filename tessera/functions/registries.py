"""Records that registries nest inside cells: bracket groups, JSON lists, sections of one wide row, phases told in titles."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tessera.functions.enums import norm_phase

#: Where the next section of an EU record has run into a field; columns of its repeated sections; its phase flags in order.
NEXT_SECTION = r"\s+[A-Z]\.[0-9](?:\.[0-9]+)*\s+[A-Z].*$"
EU_SPONSOR = r"(?i)^Sponsor\s+\d+\s*-\s*B\.1\.1\s+Name of Sponsor$"
EU_PRODUCT = r"(?i)^IMP\s+\d+\s*-\s*D\.(?:3\.1\s+Product name|3\.8\s+INN|2\.1\.1\.1\s+Trade name)"
EU_PHASES = ["E.7.1 Human pharmacology (Phase I)", "E.7.2 Therapeutic exploratory (Phase II)", "E.7.3 Therapeutic confirmatory (Phase III)", "E.7.4 Therapeutic use (Phase IV)"]
EU_CONDITION, EU_TERM = "E.1.1 Medical condition(s) being investigated", "E.1.2 Term"
#: The words that name a phase, and the characters from there on that may name a second one.
TITLE_PHASE, TITLE_WINDOW = r"(?i)\bphase\s*(?:i{1,3}v?|[0-4])\b", 24
#: The number and label before a condition in the Indian registry's JSON.
LISTED = r"(?i)^\s*(?:\(\d+\)\s*)?(?:ICD-?10 Condition:\s*\S+\s*)?"
LISTED_CODE = r"(?i)ICD-?10\s*Condition:\s*([A-Z]\d{2,3}(?:\.\d+)?)"
SOME_CODE = r"^[A-Z]\d{2,3}(?:\.\d+)?$"

_GROUPED = ArrayType(StructType([StructField("text", StringType()), StructField("notes", ArrayType(StringType()))]))


def bracket_groups(cell: str) -> list[tuple[str, list[str]]]:
    """(text, groups behind it) of each entry of a cell "text(group)(group),text(group)", in one pass over its brackets.

    A comma parts entries only behind a closed group that lies in no other; any other comma, and a group inside
    the text, belong to the text. Groups may hold groups. Where brackets don't balance, a comma
    behind any closed group parts entries, a group that isn't closed ends with its entry, and a bracket that closes nothing is left out at the end.
    """
    even, depth = True, 0
    for c in cell:
        depth += (c == "(") - (c == ")")
        even &= depth >= 0
    even &= not depth
    out: list[tuple[str, list[str]]] = []
    start, last, opened = 0, "", []
    pairs: dict[int, int] = {}

    def finish(end: int) -> None:
        # Groups that weren't closed reach to the entry's end.
        text, at, notes = cell[start:end], end, []
        for o in reversed(opened):
            pairs[end] = o
            text, at = cell[start:o], o
            notes.insert(0, cell[o + 1 : end].strip())
        opened.clear()
        while (text := text.rstrip()).endswith(")"):
            at = start + len(text) - 1
            if at not in pairs:
                text = text[:-1]
                continue
            o = pairs[at]
            notes.insert(0, cell[o + 1 : at].strip())
            text = cell[start:o]
        if text.strip():
            out.append((text.strip(), [n for n in notes if n]))

    for i, c in enumerate(cell):
        if c == "(":
            opened.append(i)
        elif c == ")" and opened:
            pairs[i] = opened.pop()
        elif c == "," and last == ")" and (not even or not opened):
            finish(i)
            start = i + 1
        if not c.isspace():
            last = c
    finish(len(cell))
    return out


def grouped(c: Column) -> Column:
    """``bracket_groups`` of a column, over Arrow batches; a null cell has none."""
    return F.pandas_udf(lambda cells: cells.map(lambda s: [{"text": t, "notes": n} for t, n in bracket_groups(s or "")]), _GROUPED)(c)


def korean_conditions(c: Column) -> Column:
    """Names of a cell whose entries end with a gloss and perhaps a code, "code- name" where there is one, in one cell again."""

    def one(x: Column) -> Column:
        code = F.get(F.filter(x["notes"], lambda n: n.rlike(SOME_CODE)), F.lit(0))
        return F.concat(F.coalesce(F.concat(code, F.lit("- ")), F.lit("")), x["text"])

    return F.array_join(F.transform(grouped(c), one), "; ")


def _listed(c: Column, field: str) -> Column:
    """The fields of a JSON list of objects; empty if it is none."""
    items = F.from_json(c, f"array<struct<{field}: string>>")
    return F.filter(F.transform(F.coalesce(items, F.array().cast(f"array<struct<{field}: string>>")), lambda x: F.trim(F.coalesce(x[field], F.lit("")))), lambda x: x != "")


def indian_conditions(c: Column) -> Column:
    """Phrases of a JSON list of conditions, "code- phrase" where a code is named; a cell that is no list stays as it is."""

    def one(x: Column) -> Column:
        code = F.upper(F.regexp_extract(x, LISTED_CODE, 1))
        marked = F.locate("||", x)
        phrase = F.trim(F.when(marked > 0, F.substring(x, marked + 2, F.length(x))).otherwise(x))
        phrase = F.trim(F.regexp_replace(phrase, LISTED, ""))
        return F.concat(F.when(code != "", F.concat(code, F.lit("- "))).otherwise(""), phrase)

    whole = F.trim(F.coalesce(c, F.lit("")))
    return F.when(whole.startswith("["), F.array_join(F.filter(F.transform(_listed(whole, "condition"), one), lambda x: x != ""), "; ")).otherwise(whole)


def indian_interventions(c: Column) -> Column:
    """Names of a JSON list of interventions; their details are prose and aren't read."""
    whole = F.trim(F.coalesce(c, F.lit("")))
    return F.when(whole.startswith("["), F.array_join(_listed(whole, "name"), "; ")).otherwise(whole)


def eu_field(c: Column) -> Column:
    """A field without the label of the section that has run into it."""
    return F.trim(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), NEXT_SECTION, ""))


def eu_phase(flags: list[Column]) -> Column:
    """The phase of four yes or no flags: one, two that follow each other, else the lowest."""
    on = [F.lower(eu_field(f)).startswith("yes") for f in flags]
    single = [F.when(x, F.lit(f"PHASE{i + 1}")) for i, x in enumerate(on)]
    count = sum((x.cast("int") for x in on), F.lit(0))
    pairs = [F.when((count == 2) & on[i] & on[i + 1], F.lit(f"PHASE{i + 1}_PHASE{i + 2}")) for i in range(3)]
    return F.coalesce(*pairs, *single, F.lit("NA"))


def eu_columns(names: list[str], pattern: str) -> list[Column]:
    """Columns of a repeated section, in the file's order."""
    return [F.col(f"`{n}`") for n in names if re.match(pattern, n.strip())]


def eu_sponsor(names: list[str]) -> Column:
    """The first sponsor that is named; later ones are co-sponsors."""
    own = [F.nullif(eu_field(c), F.lit("")) for c in eu_columns(names, EU_SPONSOR)]
    return F.coalesce(*own, F.lit(""))


def eu_products(names: list[str]) -> Column:
    """All product names, in one cell; one that differs by case alone is left out."""
    every = F.filter(F.array(*[eu_field(c) for c in eu_columns(names, EU_PRODUCT)], F.lit("")), lambda x: x != "")
    low = F.transform(every, F.lower)
    return F.array_join(F.filter(every, lambda x, i: F.array_position(low, F.lower(x)) == i + 1), "; ")


def eu_conditions(free: Column, term: Column) -> Column:
    """What the sponsor typed, and the coded term, which is English."""
    free, term = F.trim(F.coalesce(free, F.lit(""))), F.trim(F.coalesce(term, F.lit("")))
    both = F.when(free == "", term).otherwise(F.concat_ws("; ", free, term))
    return F.when((term == "") | (F.lower(term) == F.lower(free)), free).otherwise(both)


def title_phase(*titles: Column) -> Column:
    """The phase that the first title with one names; the characters after the word tell a combined one."""
    found = []
    for t in titles:
        at = F.regexp_instr(F.coalesce(t, F.lit("")), F.lit(TITLE_PHASE))
        found.append(F.when(at > 0, F.substring(t, at, F.lit(TITLE_WINDOW))))
    return norm_phase(F.coalesce(*found, F.lit("")))
