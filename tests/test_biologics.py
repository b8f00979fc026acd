"""Biologics, their patents and originators, a history of status, ids of other vocabularies, spellings of forms."""

from tessera.loaders import biologics, crosswalks, events, substances
from tessera.loaders.build import Build
from tests.test_loaders import frame, rows


def test_biologics(spark):
    lake = {
        "gsrs": [{"unii": "U1", "preferred_name": "Adalimumab"}],
        "cdisc_sdtm": [{"Codelist Name": "Dosage Form", "CDISC Submission Value": "INJECTION, SOLUTION", "CDISC Synonym(s)": "Solution for Injection;Inj Soln"}, {"Codelist Name": "Dosage Form", "CDISC Submission Value": "FRM"}, {"Codelist Name": "Other", "CDISC Submission Value": "X"}],
        "pb": [
            {"bla_number": "100", "proper_name": "adalimumab", "proprietary_name": "Humira", "license_type": "351(a)", "approval_date": "2002-12-31", "dosage_form": "solution for injection", "orphan_exclusivity_exp_date": "2030", "patent_numbers": "111, 222", "resolved_reference_bla": "100"},
            {"bla_number": "200", "proper_name": "adalimumab-aaaa", "proprietary_name": "N/A", "license_type": "351(k)", "resolved_reference_bla": "100", "dosage_form": "Tablet (chewable)"},
            {"bla_number": "300", "proper_name": "adalimumab-bbbb", "proprietary_name": "Hadlima", "license_type": "351(k)", "ref_product_proprietary_name": "HUMIRA"},
            {"bla_number": "400", "proper_name": "stranger", "license_type": "351(k)", "resolved_reference_bla": "999", "ref_product_proprietary_name": "Nothing"},
        ],
        "pb_patents": [{"Reference Product BLA Number": "100", "Patent Number": "8,889,135", "Patent Expiration Date": "2034"}, {"Reference Product BLA Number": "900", "Patent Number": "1"}],
        "ca_drug": [{"DRUG_CODE": "7", "BRAND_NAME": "B"}],
        "ca_status": [{"DRUG_CODE": "7", "STATUS_EN": "MARKETED", "HISTORY_DATE": "2001-01-01"}, {"DRUG_CODE": "7", "STATUS_EN": "DORMANT", "HISTORY_DATE": "2005-01-01"}, {"DRUG_CODE": "8", "STATUS_EN": "MARKETED"}],
    }
    b = Build({k: frame(spark, v) for k, v in lake.items()})
    substances.gsrs(b)
    crosswalks.dosage_forms(b)
    for load in (biologics.purplebook, biologics.biologic_patents, biologics.canada_status):
        load(b)
    assert rows(b, "Product", "key", "name", "form")[:3] == [("FDA:BLA100", "Humira", "INJECTION, SOLUTION"), ("FDA:BLA200", "adalimumab-aaaa", "TABLET CHEWABLE"), ("FDA:BLA300", "Hadlima", "")]
    assert rows(b, "BIOSIMILAR_OF", "src", "dst", "match_method") == [("FDA:BLA200", "FDA:BLA100", "structured"), ("FDA:BLA300", "FDA:BLA100", "name")]
    assert rows(b, "PROTECTED_BY", "src", "dst") == [("FDA:BLA100", "PATENT:US:111"), ("FDA:BLA100", "PATENT:US:222"), ("FDA:BLA100", "PATENT:US:8889135")]
    assert rows(b, "Exclusivity", "code", "date", "definition") == [("ORPHAN", "2030", "ORPHAN DRUG EXCLUSIVITY")]
    assert [r for r in rows(b, "HAS_APPROVAL", "src", "dst") if r[0].startswith("CA:")] == [("CA:7", "APPROVAL:CA:7:dormant:2005 01 01"), ("CA:7", "APPROVAL:CA:7:marketed:2001 01 01")]


def test_ids_of_other_vocabularies(spark):
    lake = {
        "uniprot_map": [{"chembl_target_id": "T1", "uniprot_accession": "P1"}],
        "hgnc": [{"symbol": "AAA", "uniprot_ids": "P1", "hgnc_id": "HGNC:1"}],
        "targets": [{"tid": "1", "chembl_id": "T1", "pref_name": "n"}],
        "ncit_swissprot": [{"ncit_code": "C1", "swissprot_id": "P1"}, {"ncit_code": "C2", "swissprot_id": "P9"}],
        "ncit_hgnc": [{"ncit_code": "C77", "hgnc_id": "HGNC:1"}, {"ncit_code": "C78", "hgnc_id": "HGNC:9"}],
        "ncit_cui": [{"code": "C1", "cui": "CUI1"}, {"code": "C2", "cui": "CUI2"}],
    }
    b = Build({k: frame(spark, v) for k, v in lake.items()})
    substances.targets(b)
    crosswalks.concept_ids(b)
    assert rows(b, "HAS_IDENTIFIER", "src", "dst") == [("UNIPROT:P1", f"ID:{x}") for x in ("HGNC:HGNC:1", "NCIT:C1", "UMLS_CUI:CUI1", "UNIPROT:P1")]
    assert events.PRODUCTS


def test_saudi_events(spark):
    lake = {
        "gsrs": [{"unii": "U1", "preferred_name": "Aspirin"}, {"unii": "U2", "preferred_name": "Caffeine"}],
        "sfda_alert": [{"#": "3", "Title": "Recall of x", "Type of news": "Warning", "Date": "2020", "Link of news": "http://l"}, {"#": "4", "Title": ""}, {"Title": "No number"}],
        "sfda_short": [{"REGISTRATION_NO": "9", "SCIENTIFICNAME_EN": "ASPIRIN, CAFFEINE", "TRADENAME_EN": "T", "SHORTAGE_TYPE_EN": "Total"}, {"SCIENTIFICNAME_EN": "nobody"}],
    }
    b = Build({k: frame(spark, v) for k, v in lake.items()})
    substances.gsrs(b)
    events.alerts(b)
    events.regulatory(b, "sfda_short")
    assert rows(b, "RegulatoryEvent", "key", "type", "name", "status") == [("EVENT:SFDA_ALERT:3", "safety_alert", "Recall of x", ""), ("EVENT:SFDA_ALERT:no number", "safety_alert", "No number", ""), ("EVENT:SHORTAGE:SFDA:9", "shortage", "T", "Total")]
    assert rows(b, "SUBJECT_OF", "src", "dst") == [("UNII:U1", "EVENT:SHORTAGE:SFDA:9"), ("UNII:U2", "EVENT:SHORTAGE:SFDA:9")]
