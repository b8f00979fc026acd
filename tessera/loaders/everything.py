"""All loaders in their order of precedence, as far as a lake has their files."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tessera.loaders import biologics, crosswalks, diseases, events, places, substances, vocabularies
from tessera.loaders.build import Build, run

#: The files that each loader cannot do without.
NEEDS = {
    substances.atc: ["atc_classes"],
    substances.gsrs: ["gsrs"],
    substances.molecules: ["molecules"],
    substances.molecule_synonyms: ["molecules", "synonyms"],
    substances.structures: ["molecules", "structures"],
    substances.atc_substances: ["atc_subs"],
    substances.salts: ["molecules", "hierarchy"],
    substances.rxnorm: ["rxnorm"],
    substances.dailymed: ["dailymed"],
    substances.targets: ["targets", "uniprot_map"],
    substances.mechanisms: ["molecules", "targets", "mechanisms"],
    substances.mesh_actions: ["mesh_actions"],
    diseases.mesh: ["mesh"],
    diseases.icd11: ["icd11"],
    diseases.icd10: ["mesh", "icd10_codes"],
    diseases.indications: ["mesh", "molecules", "indications"],
    diseases.associations: ["targets", "hgnc", "ot_assoc"],
    substances.variants: ["targets", "hgnc", "clinvar"],
    crosswalks.concept_ids: ["targets", "uniprot_map", "ncit_swissprot"],
    crosswalks.dosage_forms: ["cdisc_sdtm"],
    vocabularies.supplements: ["mesh", "mesh_scr"],
    vocabularies.antineoplastic: ["gsrs", "antineoplastic"],
    # Exceptions overrule what other aliases say, so they come after them.
    vocabularies.curated: ["mesh"],
    substances.stand_ins: ["gsrs"],
    vocabularies.cross_links: ["mesh"],
    vocabularies.one_hierarchy: ["mesh"],
}

#: Products by licence, and histories; they come after the other products.
BIOLOGICS = {biologics.purplebook: ["pb"], biologics.biologic_patents: ["pb", "pb_patents"], biologics.canada_status: ["ca_drug", "ca_status"]}


def loaders(lake: Mapping[str, DataFrame]) -> list[Callable[[Build], None]]:
    out: list[Callable[[Build], None]] = [places.vocabulary]
    for f, files in NEEDS.items():
        if f is vocabularies.supplements and "mesh" in lake:
            out.append(vocabularies.concept_aliases)
        if all(x in lake for x in files):
            out.append(f)
    out += [f for file, f in events.PRODUCTS.items() if file in lake]
    out += [f for f, files in BIOLOGICS.items() if all(x in lake for x in files)]
    out += [(lambda b, file=file: events.trials(b, file)) for file in events.REGISTRIES if file in lake]
    out += [(lambda b, file=file: events.regulatory(b, file)) for file in events.EVENTS if file in lake]
    return out + [f for file, f in events.SAFETY.items() if file in lake]


def build(lake: Mapping[str, DataFrame], run_id: str = "run") -> Build:
    return run(lake, loaders(lake), run_id)
