"""Rewritings of a free-text condition, from close to loose, and its linking.

``LADDER`` is a table: each row names a kind of rewriting, the pattern that it works
with, and the fewest characters that its result must have. ``variants`` turns the
table into one column expression, so nothing leaves the JVM; the order of the rows is
the order of trust.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import fold

#: Wording of qualifiers, rubrics, specifiers, manifestations, separators, and headings too general to link.
STAGES = "extensive[ -]stage|limited[ -]stage|stage [0-9ivx]+"
COURSE = "metastatic|advanced|recurrent|refractory|relapsed|unresectable|newly diagnosed|previously treated|untreated"
BEFORE = rf"(?i)^(?:(?:{COURSE}|locally advanced|early|late|acute|chronic|severe|mild|moderate|unspecified|adult|adults|paediatric|pediatric|childhood|primary|secondary|solid|malignant|{STAGES}) +)+"
AFTER = rf"(?i)(?: +(?:{COURSE}|{STAGES})){{1,2}}$"
RUBRIC = r"(?i)^(?:other specified|other|unspecified) +| *,? +(?:unspecified|nos|not elsewhere classified|nec|without complications?)$"
NEOPLASM_OF = r"(?i)^(?:malignant|benign|in situ|secondary|primary)? *neoplasms? +of +(?:the +)?(.+)$"
ORGAN_WORD = r"(?i) +(?:gland|region|structure)$"
CANCER = r"(?i)(?<![a-z])(?:cancers?|tumou?rs?|malignanc(?:y|ies))(?![a-z])"
SPECIFIER = r"(?i) +(?:with|without) +.+$| +(?:nyha|child[ -]pugh|gold|kdigo) +(?:class|stage) *[0-9ivx]*$"
BRACKET = r"[(\[]([^)\]]{2,60})[)\]]"
SEPARATOR = r"(?i) +and +| *&(?:amp;?)? *| */ *| +, +"
MANIFESTATION = r"(?i)(?: +(?:pneumonia|respiratory +infection|acute +respiratory +distress +syndrome|ards|vaccines?|vaccination|immunisation|immunization|disease|infection|infections|pneumonitis|sequelae|complications?|patients?|subjects?|participants?|males?|females?|men|women|boys|girls|children|adults?|adolescents?|infants?|neonates?|newborns?|elderly)){1,2}$"
TOO_GENERAL = sorted("disease diseases disorder disorders syndrome syndromes condition conditions illness illnesses symptom symptoms infection infections injury injuries complication complications patients healthy health".split())
#: Characters of a rewriting at least, of any kind; words of a phrase that is turned around.
SHORTEST, FEWEST_WORDS, MOST_WORDS = 4, 2, 8


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _one(c: Column) -> Column:
    return F.array(c)


def _cut(pattern: str) -> Callable[[Column], Column]:
    return lambda s: _one(F.regexp_replace(s, pattern, ""))


def _number(s: Column) -> Column:
    """The singular of a plural, the plural of anything else."""
    return _one(F.when(F.lower(F.right(s, F.lit(1))) == "s", F.left(s, F.length(s) - 1)).otherwise(F.concat(s, F.lit("s"))))


def _site(s: Column) -> Column:
    """"Neoplasm of the SITE gland": by the site, whole and without the organ's word."""
    bare = lambda site: F.array(site, F.regexp_replace(site, ORGAN_WORD, ""))
    sites = _let(F.regexp_replace(F.regexp_extract(s, NEOPLASM_OF, 1), "^[ ,]+|[ ,]+$", ""), bare)
    return F.transform(F.filter(sites, lambda x: F.length(x) >= 3), lambda x: F.concat(x, F.lit(" Neoplasms")))


def _renamed(s: Column) -> Column:
    return F.array(*[F.when(s.rlike(CANCER), F.regexp_replace(s, CANCER, word)) for word in ("Neoplasms", "Neoplasm")])


def _brackets(s: Column) -> Column:
    inner = F.transform(F.regexp_extract_all(s, F.lit(BRACKET), 1), lambda x: F.trim(x))
    return F.concat(inner, _one(F.regexp_replace(s, BRACKET, " ")))


def _at_comma(s: Column) -> Column:
    """"Carcinoma, Renal Cell" in natural order."""
    halves = F.transform(F.split(s, ","), lambda x: F.trim(x))
    turned = lambda h: F.when((F.size(h) == 2) & F.forall(h, lambda x: F.length(x) >= SHORTEST), F.array_join(F.reverse(h), " "))
    return _one(_let(halves, turned))


def _around_comma(s: Column) -> Column:
    """"Stress Urinary Incontinence" with its first or its last word on the other side of a comma."""

    def turned(words: Column) -> Column:
        n = F.size(words)
        join = lambda start, length: F.array_join(F.slice(words, start, length), " ")
        both = F.array(F.concat_ws(", ", join(F.lit(2), n - 1), join(F.lit(1), F.lit(1))), F.concat_ws(", ", join(n, F.lit(1)), join(F.lit(1), n - 1)))
        return F.when(n.between(FEWEST_WORDS, MOST_WORDS) & ~F.contains(s, F.lit(",")), both).otherwise(F.array().cast("array<string>"))

    return _let(F.split(s, " "), turned)


class Rung(NamedTuple):
    of: tuple[str, ...]  # the forms that it rewrites: "base", "rubric" (the base without a rubric's words)
    rewrite: Callable[[Column], Column]
    least: int = SHORTEST


LADDER = [
    Rung(("base",), _number),
    Rung(("base",), _cut(SPECIFIER), 5),
    Rung(("base",), _cut(AFTER), 5),
    Rung(("rubric",), _one, 5),
    Rung(("rubric",), _number),
    Rung(("base", "rubric"), _site),
    Rung(("base",), _cut(MANIFESTATION), 5),
    Rung(("base",), _renamed),
    Rung(("base",), _brackets),
    Rung(("base",), _at_comma),
    Rung(("base", "rubric"), _around_comma),
    Rung(("base",), lambda s: F.split(s, SEPARATOR)),
]


def variants(term: Column) -> Column:
    """The term, the term without leading qualifiers, and looser forms, each once; of a blank term none."""

    def forms(base: Column, rubric: Column) -> Column:
        held = {"base": base, "rubric": rubric}

        def step(rung: Rung, form: str) -> Column:
            return F.filter(F.transform(rung.rewrite(held[form]), _spaced), lambda x: F.length(x) >= rung.least)

        return F.concat(F.filter(_one(base), lambda x: x != ""), *[step(rung, form) for rung in LADDER for form in rung.of])

    def ladder(whole: Column) -> Column:
        without = lambda s: F.trim(F.regexp_replace(s, RUBRIC, ""))
        loose = _let(F.regexp_replace(whole, BEFORE, ""), lambda base: _let(without(without(base)), lambda rubric: forms(base, rubric)))
        every = F.concat(_one(whole), F.filter(loose, lambda x: ~F.lower(x).isin(TOO_GENERAL)))
        first = lambda all_: F.filter(all_, lambda x, i: F.array_position(F.transform(all_, F.lower), F.lower(x)) == i + 1)
        return F.when(whole == "", F.array().cast("array<string>")).otherwise(_let(every, first))

    return _let(_spaced(F.coalesce(term, F.lit(""))), ladder)


def parts(term: Column) -> Column:
    """The conditions named in one cell, if there are several."""
    cells = F.transform(F.split(_spaced(F.coalesce(term, F.lit(""))), SEPARATOR), lambda x: F.regexp_replace(x, r"^[ \t-]+|[ \t-]+$", ""))
    several = lambda found: F.when(F.size(found) > 1, found).otherwise(F.array().cast("array<string>"))
    return _let(F.filter(cells, lambda x: F.length(x) >= SHORTEST), several)


def link(terms: DataFrame, dictionaries: list[DataFrame], id_col: str = "id", term: str = "term") -> DataFrame:
    """(id, term, key, method): the first variant that any dictionary (probe, key) knows; earlier dictionaries first.

    A general heading counts only if it is the term itself.
    """
    looked = terms.select(term).distinct().select(term, F.posexplode(variants(F.col(term))).alias("v", "variant")).withColumn("probe", fold(F.col("variant")))
    ranked = [d.groupBy("probe").agg(F.min("key").alias("key")).withColumn("rank", F.lit(i)) for i, d in enumerate(dictionaries)]
    won = looked.join(reduce(DataFrame.unionByName, ranked), "probe").groupBy(term).agg(F.min_by(F.struct("key", "v", "rank", "probe"), F.struct("v", "rank")).alias("w")).select(term, "w.*")
    kept = won.filter((F.col("v") == 0) | ~F.col("probe").isin(TOO_GENERAL))
    method = F.when(F.col("rank") > 0, "vocab_alias").when(F.col("v") == 0, "name").otherwise("name_variant")
    return terms.join(kept.select(term, "key", method.alias("method")), term).select(id_col, term, "key", "method")
