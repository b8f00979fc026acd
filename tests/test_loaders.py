"""A small lake through all loaders: precedence, resolution, funnels, integrity."""

import pytest

from pyspark.sql import functions as F

from tessera import schema
from tessera.functions import terms
from tessera.loaders import events
from tessera.loaders.everything import build
from tessera.operators import quality


def frame(spark, rows):
    names = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([tuple(r.get(n, "") for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))


@pytest.fixture(scope="module")
def made(spark):
    reports = [{"safetyreportid": str(i), "drug_substance": "ATORVASTATIN;ASPIRIN", "drug_characterization": "1;2", "reaction": "Myalgia;Nausea", "serious": "1", "seriousnessdeath": "0"} for i in range(3)]
    lake = {
        "atc_classes": [{"atc_code": "C10", "name": "Lipid", "level": "2"}, {"atc_code": "C10AA", "name": "Statins", "level": "4", "parent_code": "C10"}],
        "gsrs": [{"unii": "A0JWA85V8F", "preferred_name": "Atorvastatin", "synonyms": "CI-981|Lipitor base", "cas_number": "134523-00-5"}, {"unii": "48A5M73Z4Q", "preferred_name": "Atorvastatin Calcium Trihydrate"}, {"unii": "R16CO5Y76E", "preferred_name": "Aspirin", "synonyms": "Acetylsalicylic acid"}],
        "molecules": [{"molregno": "1", "chembl_id": "CHEMBL1487", "pref_name": "ATORVASTATIN", "max_phase": "4", "molecule_type": "Small molecule"}, {"molregno": "2", "chembl_id": "CHEMBL9", "pref_name": "NEWDRUG", "max_phase": "-1", "molecule_type": "Unknown"}, {"molregno": "3", "chembl_id": "CHEMBL10", "pref_name": "NEWDRUG SALTFORM", "molecule_type": "Small molecule"}],
        "synonyms": [{"molregno": "1", "synonyms": "Sortis"}],
        "structures": [{"molregno": "1", "standard_inchi_key": "XUKUURHRXDUEBC"}],
        "hierarchy": [{"molregno": "3", "parent_molregno": "2"}, {"molregno": "2", "parent_molregno": "2"}],
        "atc_subs": [{"atc_code": "C10AA05", "name": "atorvastatin", "parent_code": "C10AA"}],
        "rxnorm": [{"rxcui": "83367", "name": "atorvastatin"}],
        "dailymed": [{"setid": "s-1", "rxstring": "Atorvastatin 10 MG Oral Tablet"}],
        "uniprot_map": [{"chembl_target_id": "CHEMBL402", "uniprot_accession": "P04035"}],
        "hgnc": [{"symbol": "HMGCR", "uniprot_ids": "P04035", "ensembl_gene_id": "ENSG00000113161"}],
        "targets": [{"tid": "11", "chembl_id": "CHEMBL402", "pref_name": "HMG-CoA reductase", "organism": "Homo sapiens", "target_type": "SINGLE PROTEIN"}],
        "mechanisms": [{"molregno": "1", "tid": "11", "mechanism_of_action": "HMG-CoA reductase inhibitor", "action_type": "INHIBITOR"}],
        "mesh": [{"descriptor_ui": "D1", "name": "Neoplasms", "tree_numbers": "C04"}, {"descriptor_ui": "D2", "name": "Breast Neoplasms", "tree_numbers": "C04.588", "synonyms": "Breast Cancer;Mammary Cancer"}, {"descriptor_ui": "D3", "name": "Not a disease", "tree_numbers": "A01"}, {"descriptor_ui": "D4", "name": "COVID-19", "tree_numbers": "C01.748"}, {"descriptor_ui": "D5", "name": "Ocular Hypertension", "tree_numbers": "C11"}, {"descriptor_ui": "D6", "name": "Glaucoma", "tree_numbers": "C11.525"}, {"descriptor_ui": "D7", "name": "HIV Infections", "tree_numbers": "C02"}, {"descriptor_ui": "D8", "name": "HIV", "tree_numbers": "B04"}, {"descriptor_ui": "D9", "name": "Anxiety", "tree_numbers": "F01"}, {"descriptor_ui": "D10", "name": "Anxiety Disorders", "tree_numbers": "F03"}, {"descriptor_ui": "D11", "name": "Syndrome", "tree_numbers": "C23", "synonyms": "Symptom Cluster"}],
        "icd10_chapters": [{"chapter_id": "II", "title": "Neoplasms of all sites"}, {"chapter_id": "V", "title": "Causes"}],
        "icd10_blocks": [{"block_id": "C50-C50", "title": "Malignant neoplasms of the breast", "chapter_id": "II"}],
        "icd10_codes": [{"code": "C50", "title": "Malignant neoplasm of breast", "block_id": "C50-C50"}, {"code": "V01", "title": "Accident"}, {"code": "H40", "title": "Glaucoma"}, {"code": "H40.0", "title": "Ocular hypertension", "parent_code": "H40"}, {"code": "H40.9", "title": "Symptom clusters", "parent_code": "H99"}],
        "icd11": [{"foundation_uri": "u/1", "title": "COVID-19, virus identified", "code": "RA01.0", "parent": "u/2"}, {"foundation_uri": "u/2", "title": "- Codes for special purposes", "class_kind": "chapter", "chapter_no": "25"}, {"foundation_uri": "u/3", "title": "Cystic duct", "code": "XA1", "parent": "u/2"}, {"foundation_uri": "u/4", "title": "Tumours of the mamma", "code": "2C6", "parent": "u/9"}],
        "ncit_concepts": [{"code": "C1", "preferred_name": "Breast Carcinoma Concept", "synonyms": "Mammary Cancer|Mamma Tumour|Tumours of the mamma|BC"}, {"code": "C2", "preferred_name": "Anxiety Disorders", "synonyms": "Anxiety|Anxious state"}, {"code": "C3", "preferred_name": "Unheard of", "synonyms": "Nothing"}],
        "cdisc_sdtm": [{"Code": "C9", "NCI Preferred Term": "Glaucoma", "CDISC Submission Value": "GLAUC", "CDISC Synonym(s)": "Anxious state; raised eye pressure"}],
        "mesh_scr": [{"ui": "C01", "name": "Rare mammary thing", "heading_mapped_to_uis": "D3;*D2", "synonyms": "RMT disease;Mamma Tumour"}, {"ui": "C02", "name": "bevonium", "heading_mapped_to_uis": "D999"}],
        "antineoplastic": [{"NCIt Code": "C7", "NCIt Preferred Name": "Compound Nine", "Synonyms": "Aspirin||ND-9 investigational"}],
        "indications": [{"molregno": "1", "efo_id": "MONDO_0001", "mesh_id": "D2", "mesh_heading": "Breast Neoplasms", "max_phase_for_ind": "1"}, {"molregno": "1", "efo_id": "EFO_1", "efo_term": "breast cancer", "max_phase_for_ind": "2"}, {"molregno": "1", "efo_id": "EFO_1", "efo_term": "breast cancer", "max_phase_for_ind": "3"}],
        "ot_assoc": [{"target_id": "ENSG00000113161", "disease_id": "EFO_77", "disease_name": "hyperlipidemia", "overall_score": s} for s in ("0.5", "0.75", "x")],
        "clinvar": [{"VariationID": "9", "Type": "SNV", "Name": "n", "GeneSymbol": "HMGCR", "ClinicalSignificance": "Pathogenic", "PhenotypeIDS": "MONDO:MONDO:0001,x"}, {"VariationID": "10", "GeneSymbol": "HMGCR", "ClinicalSignificance": "Benign"}],
        "ob": [{"Appl_No": "020702", "Product_No": "001", "Trade_Name": "LIPITOR", "Ingredient": "ATORVASTATIN CALCIUM", "Applicant_Full_Name": "Viatris Inc", "Dosage_Form_Route": "TABLET;ORAL", "Approval_Date": "Dec 17, 1996"}],
        "ob_patents": [{"Appl_No": "020702", "Product_No": "001", "Patent_No": "5273995"}],
        "ob_excl": [{"Appl_No": "020702", "Product_No": "001", "Exclusivity_Code": "NCE"}],
        "sfda": [{"registerNumber": "1", "tradeName": "X", "scientificName": "MYSTERY STUFF, ASPIRIN", "marketingStatus": '{"ID": 1, "NAMEEN": "Marketed"}', "administrationRoute": '{"id": 1, "nameEn": "Oral use"}'}],
        "ctgov": [{"nct_id": "NCT1", "brief_title": "t", "phases": "PHASE1 | PHASE2", "study_type": "INTERVENTIONAL", "conditions": "Metastatic Breast Cancer", "interventions": "Drug: Atorvastatin + Aspirin|Other: Placebo", "lead_sponsor": "Acme Ltd", "locations": "A Clinic (Phoenix, Arizona, United States); B (Seoul, Korea, Republic of) C (Paris, France)"}],
        "who": [{"TrialID": "NCT1", "Public_title": "later"}, {"TrialID": "JPRN-UMIN1", "Public_title": "u", "Condition": "Health Condition 1: C50.9- Something no dictionary knows", "Countries": "Viet Nam;UK;nowhere"}],
        "recalls": [{"recall_number": "Z-1", "generic_name": "ASPIRIN", "brand_name": "B", "classification": "Class II", "status": "Ongoing"}],
        "faers": [*reports, dict(reports[0])],
        "vigiaccess": [{"system_organ_class": "Musculoskeletal disorders", "adverse_reaction": "Myalgia"}],
        "europepmc": [{"pmid": "1", "title": "Atorvastatin in mammary cancer", "publication_date": "in 2021"}],
        "biorxiv": [{"doi": "10.1/ABC", "title": "Nothing known", "date": "2020-01-01"}],
    }
    return build({k: frame(spark, v) for k, v in lake.items()})


def rows(b, kind, *columns):
    return sorted(tuple(r) for r in b.table(kind).select(*columns).collect())


def test_substances(made):
    names = dict(rows(made, "Substance", "key", "name"))
    assert names["UNII:A0JWA85V8F"] == "Atorvastatin" and names["CHEMBL:CHEMBL9"] == "NEWDRUG" and names["NAME:mystery stuff"] == "MYSTERY STUFF"
    assert ("UNII:A0JWA85V8F", "ID:CHEMBL_ID:CHEMBL1487") in rows(made, "HAS_IDENTIFIER", "src", "dst")
    assert rows(made, "IS_SALT_OF", "src", "dst") == [("CHEMBL:CHEMBL10", "CHEMBL:CHEMBL9")]
    assert ("UNII:A0JWA85V8F", "UNIPROT:P04035") in rows(made, "TARGETS", "src", "dst")
    assert rows(made, "Modality", "name") == [("Small molecule",)]
    assert ("UNII:A0JWA85V8F", "ID:SPL_SETID:s-1") in rows(made, "HAS_IDENTIFIER", "src", "dst")


def test_diseases(made):
    # MeSH came first: the ICD's opposite view of glaucoma goes; a parent that is no row makes no link.
    assert rows(made, "SUBTYPE_OF", "src", "dst", "source", "match_method") == [
        ("ICD10:C50", "ICD10:C50-C50", "icd10", "structured"), ("ICD10:C50", "MESH:D2", "cross_vocab", "name_variant"), ("ICD10:C50-C50", "ICD10:II", "icd10", "structured"),
        ("ICD11:2C6", "MESH:D2", "cross_vocab", "name_variant"), ("ICD11:RA01.0", "ICD11:CH25", "icd11", "structured"), ("ICD11:RA01.0", "MESH:D4", "cross_vocab", "name_variant"),
        ("MESH:D2", "MESH:D1", "mesh", "structured"), ("MESH:D6", "MESH:D5", "mesh", "structured"),
    ]
    assert rows(made, "INDICATED_FOR", "src", "dst", "max_phase", "match_method") == [("UNII:A0JWA85V8F", "MESH:D2", "3", "name")]
    assert rows(made, "ASSOCIATED_WITH", "dst", "score") == [("EFO:77", "0.7500")]
    assert rows(made, "VARIANT_IN", "src") == [("CLINVAR:9",)] and rows(made, "IMPLICATED_IN", "dst") == [("MESH:D2",)]


def test_aliases(made):
    """Bridges, supplements and exceptions; a descriptor's own name, or a short one, is nobody's alias."""
    alias = dict(made.dictionaries["vocab_alias"].collect())
    assert alias == {
        "breast carcinoma concept": "MESH:D2", "mamma tumour": "MESH:D2", "tumours of the mamma": "MESH:D2", "rare mammary thing": "MESH:D2", "rmt disease": "MESH:D2", "anxious state": "MESH:D10",
        "glauc": "MESH:D6", "raised eye pressure": "MESH:D6",
        **dict.fromkeys(["hiv", "hiv 1", "hiv 2", "hiv 1 infection", "hiv 2 infection", "human immunodeficiency virus", "human immunodeficiency virus infection"], "MESH:D7"),
    }
    known = {r.probe: (r.id, r.method) for r in made.substances().filter("tier = 3").collect()}
    assert known["nd 9 investigational"] == known["compound nine"] == ("UNII:R16CO5Y76E", "ncit_oncology")


def test_products_trials_and_safety(made):
    contains = rows(made, "CONTAINS", "src", "dst", "match_method")
    assert ("FDA:020702-001", "UNII:48A5M73Z4Q", "salt") in contains or ("FDA:020702-001", "UNII:A0JWA85V8F", "salt") in contains
    assert ("SFDA:1", "NAME:mystery stuff", "provisional") in contains and rows(made, "Route", "name")[-1] == ("Oral use",)
    assert rows(made, "PROTECTED_BY", "src", "dst") == [("FDA:020702-001", "PATENT:US:5273995")]
    trials = {r[0]: r[1:] for r in rows(made, "ClinicalTrial", "key", "title", "phase")}
    assert trials == {"NCT:NCT1": ("t", "PHASE1_PHASE2"), "UMIN:UMIN1": ("u", "NA")}
    assert rows(made, "STUDIES", "src", "dst", "match_method") == [("NCT:NCT1", "MESH:D2", "name_variant"), ("UMIN:UMIN1", "ICD10:C50", "icd_code")]
    assert {r[0] for r in rows(made, "TESTED_IN", "src")} == {"UNII:A0JWA85V8F", "UNII:R16CO5Y76E"}
    assert rows(made, "HAS_ADVERSE_EVENT", "src", "dst", "report_count", "serious_count") == [("UNII:A0JWA85V8F", "AE:myalgia", "3", "3"), ("UNII:A0JWA85V8F", "AE:nausea", "3", "3")]
    assert rows(made, "RegulatoryEvent", "status") == [("Class II",)]
    assert rows(made, "IN_ORGAN_CLASS", "src", "dst") == [("AE:myalgia", "SOC:musculoskeletal disorders")]
    assert rows(made, "ABOUT", "src", "dst") == [("PMID:1", "MESH:D2")] and ("PMID:1", "UNII:A0JWA85V8F") in rows(made, "MENTIONS", "src", "dst")
    assert dict(rows(made, "Publication", "key", "year")) == {"PMID:1": "2021", "DOI:10.1/abc": "2020"}


def test_tables_are_declared_and_sound(made):
    for kind, table in made.tables().items():
        assert table.columns == schema.columns(kind)
    nodes = None
    for label in schema.NODES:
        if label in made.writers:
            one = made.table(label).select("key")
            nodes = one if nodes is None else nodes.union(one)
    nodes = nodes.distinct().persist()
    for kind in schema.EDGES:
        if kind in made.writers:
            lost = {(r.end, r.namespace) for r in quality.dangling(made.table(kind).select("src", "dst"), nodes).collect()}
            assert not lost, kind


def test_places(made):
    assert rows(made, "CONDUCTED_IN", "src", "dst") == [("NCT:NCT1", "COUNTRY:FR"), ("NCT:NCT1", "COUNTRY:US"), ("UMIN:UMIN1", "COUNTRY:GB"), ("UMIN:UMIN1", "COUNTRY:VN")]
    assert ("COUNTRY:SA", "REGION:mena gcc") in rows(made, "IN_REGION", "src", "dst") and ("COUNTRY:KR", "South Korea") in rows(made, "Country", "key", "name")
    assert ("FDA:020702-001", "AGENCY:FDA") in rows(made, "APPROVED_BY", "src", "dst") and ("FDA:020702-001", "REGION:north america") in rows(made, "APPROVED_IN", "src", "dst")
    assert len(rows(made, "RegulatoryAgency", "key")) == 11 and len(rows(made, "Region", "key")) == 9


def test_terms(spark):
    one = spark.createDataFrame([("Intervention1: Nab-paclitaxel 100 mg weekly|Drug: Cisplatin/Etoposide|Matching Placebo|Control group: Nil|Other: water", "Health Condition 1: C692- Malignant neoplasm of retina;Diabetes: type 2;10047079")], "i string, c string")
    got = one.select(terms.drug_names(F.col("i")).alias("d"), terms.condition_names(F.col("c")).alias("n"), terms.condition_codes(F.col("c")).alias("k")).first()
    assert got.d == ["Nab-paclitaxel", "paclitaxel", "Cisplatin", "Etoposide"] and got.n == ["Malignant neoplasm of retina", "Diabetes: type 2"] and got.k == ["C692"]


def test_same_studies(spark):
    from tessera.loaders.build import Build

    b = Build({"isrctn": frame(spark, [{"ISRCTN": "ISRCTN1", "EudraCT/CTIS number": "2004-000010-11", "ClinicalTrials.gov number": "N/A x"}])})
    events.same_studies(b, "isrctn", ["EudraCT/CTIS number", "ClinicalTrials.gov number"])
    assert rows(b, "SAME_STUDY_AS", "src", "dst") == [("ISRCTN:ISRCTN1", "EUCTR:2004-000010-11")]


def test_regulatory_events_and_stand_ins(spark):
    from tessera.loaders import substances
    from tessera.loaders.build import Build

    lake = {
        "gsrs": [{"unii": "U1", "preferred_name": "Acetaminophen"}, {"unii": "U2", "preferred_name": "Fluorouracil"}, {"unii": "U3", "preferred_name": "Albuterol"}, {"unii": "U4", "preferred_name": "Salbutamol"}],
        "ema_referrals": [{"reference_number": "R1", "category": "Human", "international_non_proprietary_name_inn_common_name": "Paracetamol; 5-FU;ab", "referral_name": "n"}, {"reference_number": "R2", "category": " Veterinary ", "referral_name": "v"}, {"reference_number": ""}],
        "ema_dhpc": [{"name_of_medicine": "Med One", "category": "", "dhpc_type": "Safety Signal", "active_substances": "unheard of"}],
        "ema_pip": [{"decision_number": "P/1", "active_substance": "folfox"}],
    }
    b = Build({k: frame(spark, v) for k, v in lake.items()})
    substances.gsrs(b)
    substances.stand_ins(b)
    for file in ("ema_referrals", "ema_dhpc", "ema_pip"):
        events.regulatory(b, file)
    assert rows(b, "RegulatoryEvent", "key", "type") == [("EVENT:DHPC:med one:safety signal", "dhpc"), ("EVENT:PIP:P/1", "paediatric_investigation_plan"), ("EVENT:REFERRAL:R1", "referral")]
    assert rows(b, "SUBJECT_OF", "src", "dst", "match_method") == [("NAME:unheard of", "EVENT:DHPC:med one:safety signal", "provisional"), ("UNII:U1", "EVENT:REFERRAL:R1", "inn_usan"), ("UNII:U2", "EVENT:PIP:P/1", "regimen"), ("UNII:U2", "EVENT:REFERRAL:R1", "abbrev")]
    # Both spellings of a pair are held: neither stands for the other.
    assert not b.aliases[-1].filter("name in ('albuterol', 'salbutamol')").count()
