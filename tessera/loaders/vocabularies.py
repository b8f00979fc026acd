"""What other vocabularies know of diseases and substances: aliases by bridges, supplements, curated exceptions, and one hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.conditions import variants
from tessera.loaders.build import Build
from tessera.operators import hierarchy, resolve
from tessera.scratch import written

#: Vocabularies in order of precedence; their column of codes, of names, and of lists of names with the separator.
CONCEPTS = {
    "ncit_concepts": ("code", ["preferred_name"], "synonyms", r"\|"),
    "neoplasm_core": ("Code", ["Preferred Term"], "Synonyms", r"\|"),
    "cdisc_sdtm": ("Code", ["NCI Preferred Term", "CDISC Submission Value"], "CDISC Synonym(s)", ";"),
    "cdisc_cdash": ("Code", ["NCI Preferred Term", "CDISC Submission Value"], "CDISC Synonym(s)", ";"),
    "cdisc_protocol": ("Code", ["NCI Preferred Term", "CDISC Submission Value"], "CDISC Synonym(s)", ";"),
}
#: Characters of an alias at least; of a title's part before a comma at least.
LEAST_ALIAS, LEAST_HEAD = 5, 5
#: registries' words for one heading, which the rules for aliases refuse otherwise.
CURATED = {
    "HIV Infections": ["hiv", "hiv 1", "hiv 2", "hiv 1 infection", "hiv 2 infection", "human immunodeficiency virus", "human immunodeficiency virus infection"],
}


def _names(b: Build, file: str, code: str, single: list[str], listed: str, separator: str) -> DataFrame:
    """(concept, pos, name): the names of each row of a vocabulary, its own first."""
    r = b.rows(file, code, *single, listed)
    names = F.concat(F.array(*[F.col(f"`{c}`") for c in single]), text.parts(F.col(f"`{listed}`"), separator))
    row = F.concat_ws("\t", F.col(f"`{code}`"), names)
    return r.select(row.alias("concept"), F.posexplode(names).alias("pos", "name")).filter("name <> ''")


def concept_aliases(b: Build) -> None:
    """If any name of a concept is a MeSH disease's, its other names are aliases of that disease."""
    every = None
    for rank, (file, columns) in enumerate(CONCEPTS.items()):
        if b.has(file):
            one = _names(b, file, *columns).withColumn("concept", F.concat(F.lit(f"{rank}\t"), "concept"))
            every = one if every is None else every.unionByName(one)
    if every is not None:
        found = resolve.bridge(every, b.dictionaries["mesh"].select("probe", F.col("key").alias("id")), b.dictionaries["mesh_any"], LEAST_ALIAS)
        _alias(b, found.select(F.col("name").alias("probe"), F.col("id").alias("key")))


def supplements(b: Build) -> None:
    """Names of supplementary records, for the first disease that each is mapped to; records of chemicals have none."""
    r = b.rows("mesh_scr", "ui", "name", "heading_mapped_to_uis", "synonyms")
    names = F.concat(F.array("name"), text.parts(F.col("synonyms"), ";"))
    r = r.select(F.concat_ws("\t", "ui", "name").alias("row"), names.alias("names"), text.parts(F.col("heading_mapped_to_uis"), ";").alias("to"))
    keys = b.dictionaries["mesh"].select("key").distinct()
    to = r.select("row", F.posexplode("to").alias("at", "ui")).select("row", "at", F.concat(F.lit("MESH:"), F.regexp_replace("ui", r"^\*+", "")).alias("key"))
    first = to.join(keys, "key").groupBy("row").agg(F.min_by("key", "at").alias("key"))
    probes = r.select("row", F.posexplode("names").alias("pos", "name")).join(first, "row").select("row", "pos", "key", text.fold(F.col("name")).alias("probe")).filter(F.length("probe") >= LEAST_ALIAS)
    taken = b.dictionaries["mesh"].select("probe").union(b.dictionaries["mesh_any"])
    _alias(b, probes.join(taken.distinct(), "probe", "left_anti").groupBy("probe").agg(F.min_by("key", F.struct("row", "pos")).alias("key")))


def curated(b: Build) -> None:
    """Exceptions for named headings; they overrule other aliases. A heading that isn't there is skipped."""
    rows = [(heading, name) for heading, names in CURATED.items() for name in names]
    mesh = b.dictionaries["mesh"]
    table = mesh.sparkSession.createDataFrame(rows, "heading string, name string")
    found = table.select(text.fold(F.col("heading")).alias("h"), text.fold(F.col("name")).alias("probe")).join(mesh.select(F.col("probe").alias("h"), "key"), "h").select("probe", "key")
    _alias(b, found, over=True)


def _alias(b: Build, rows: DataFrame, over: bool = False) -> None:
    """Adds aliases (probe, key); the first one of a probe stays, unless they overrule."""
    held = b.dictionaries.get("vocab_alias")
    if held is not None:
        late, soon = (held, rows) if over else (rows, held)
        rows = soon.unionByName(late.join(soon.select("probe"), "probe", "left_anti"))
    b.keep("vocab_alias", rows)


def antineoplastic(b: Build) -> None:
    """Names of a drug concept, for the substance that the first known one of them means."""
    names = _names(b, "antineoplastic", "NCIt Code", ["NCIt Preferred Name"], "Synonyms", r"\|\|").filter(text.usable_name(F.col("name")))
    asked = written(b.resolve(names, "name", provisional=True), "antineoplastic")
    known = asked.filter("match_method <> 'provisional'").groupBy("concept").agg(F.min_by("substance", F.struct("pos", "substance")).alias("id"))
    lacks = asked.filter("match_method = 'provisional'").join(known, "concept")
    b.aliases.append(written(lacks.groupBy("name").agg(F.min_by("id", F.struct("concept", "pos")).alias("id")).withColumn("method", F.lit("ncit_oncology")), "oncology"))


def cross_links(b: Build) -> None:
    """A title of another vocabulary that, rewritten, names a MeSH disease is a kind of it.

    A title's part before a comma is tried after the whole title. Headings that are a bare
    category word take no such link.
    """
    if not b.foreign:
        return
    titles = b.foreign[0]
    for more in b.foreign[1:]:
        titles = titles.unionByName(more)
    known = b.dictionaries["mesh"].select("probe", "key", F.lit(0).alias("rank"))
    if "vocab_alias" in b.dictionaries:
        known = known.unionByName(b.dictionaries["vocab_alias"].select("probe", "key", F.lit(1).alias("rank")))
    known = known.filter(F.col("key").startswith("MESH:")).withColumnRenamed("key", "parent")
    head = F.trim(F.substring_index("title", ",", 1))
    heads = F.when(F.col("title").contains(",") & (F.length(head) >= LEAST_HEAD), F.array("title", head)).otherwise(F.array("title"))
    looked = titles.distinct().select("key", F.posexplode(heads).alias("h", "head")).select("key", "h", F.posexplode(variants(F.col("head"))).alias("v", "variant")).select("key", "h", "v", text.fold(F.col("variant")).alias("probe"))
    won = looked.join(known, "probe").groupBy(F.col("key").alias("child")).agg(F.min_by("parent", F.struct("h", "v", "rank", "parent")).alias("parent"))
    general = b.dictionaries["mesh_general"].select(F.col("key").alias("parent"))
    b.propose(won.join(general, "parent", "left_anti").select("child", "parent"), "cross_vocab", "name_variant")


def one_hierarchy(b: Build) -> None:
    """SUBTYPE_OF over all vocabularies: links in the order of their loaders, less those that would close a cycle."""
    every = None
    for rank, (links, _, _) in enumerate(b.links):
        one = links.withColumn("ord", F.lit(rank))
        every = one if every is None else every.unionByName(one)
    if every is None:
        return
    # A link belongs to the first loader that proposed it.
    first = every.groupBy("child", "parent").agg(F.min("ord").alias("ord"))
    kept = written(hierarchy.accept(first).join(first, ["child", "parent"]), "hierarchy")
    for rank, (_, source, method) in enumerate(b.links):
        b.add("SUBTYPE_OF", kept.filter(F.col("ord") == rank), source, src="child", dst="parent", match_method=F.lit(method))
