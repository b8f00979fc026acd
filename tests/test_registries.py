"""Nested registry records against brute force, and through their loaders."""

import itertools
import re

from pyspark.sql import functions as F

from tessera.functions import registries
from tests.test_loaders import frame, rows


def brute(cell):
    """Entries of a cell whose brackets balance, by cutting out groups from the inside."""
    held, marked = [], cell
    while m := re.search(r"\(([^()]*)\)", marked):
        held.append(m[0])
        marked = marked[: m.start()] + f"\0{len(held) - 1}\1" + marked[m.end() :]

    def back(s):
        while m := re.search("\0(\\d+)\1", s):
            s = s[: m.start()] + held[int(m[1])] + s[m.end() :]
        return s

    out = []
    for part in re.split("(?<=\1)\\s*,", marked):
        notes, part = [], part.strip()
        while m := re.search("\\s*\0(\\d+)\1$", part):
            notes.insert(0, back(held[int(m[1])])[1:-1].strip())
            part = part[: m.start()].strip()
        if part:
            out.append((back(part), [n for n in notes if n]))
    return out


def test_all_nestings_of_samples():
    atoms = ["a", "b, c", "(g)", "((g)h)", "(x, y)", "(g),", " ", "()", ","]
    for n in range(1, 5):
        for parts in itertools.product(atoms, repeat=n):
            cell = "".join(parts)
            assert registries.bracket_groups(cell) == brute(cell), cell


def test_what_registries_write():
    groups = registries.bracket_groups
    assert groups("Hyperlipidemia, unspecified(상세불명의 고지혈증),Malignant neoplasm of breast(C50)(유방의 악성신생물)") == [("Hyperlipidemia, unspecified", ["상세불명의 고지혈증"]), ("Malignant neoplasm of breast", ["C50", "유방의 악성신생물"])]
    assert groups("Healthy Volunteers") == [("Healthy Volunteers", [])] and groups("") == [] and groups("  ") == []
    # Brackets that don't balance.
    assert groups("A(b,C(d),E") == [("A", ["b,C(d)"]), ("E", [])]
    assert groups("Pain)") == [("Pain", [])] and groups("Pain (chronic") == [("Pain", ["chronic"])]
    assert groups("(" * 3000 + ")" * 3000) == []


def test_cells(spark):
    one = spark.createDataFrame(
        [('[{"health_type": "Patients", "condition": "(1) ICD-10 Condition: O80||Encounter for delivery"}, {"condition": "(2) Anaemia"}, {"condition": null}, {"other": 1}]', '[{"type": "Intervention", "name": "Buccal misoprostol", "details": "with placebo"}, {"name": ""}]', "Flu(J10)(독감),Cold, common(감기)", "A phase 2/3 study of x")],
        "c string, i string, k string, t string",
    )
    got = one.select(registries.indian_conditions(F.col("c")), registries.indian_interventions(F.col("i")), registries.korean_conditions(F.col("k")), registries.title_phase(F.lit(None).cast("string"), F.col("t"))).first()
    assert tuple(got) == ("O80- Encounter for delivery; Anaemia", "Buccal misoprostol", "J10- Flu; Cold, common", "PHASE2_PHASE3")
    odd = spark.createDataFrame([("plain text",), ("[broken",), (None,), ("[]",)], "c string")
    assert [r[0] for r in odd.select(registries.indian_conditions(F.col("c"))).collect()] == ["plain text", "", "", ""]
    titles = spark.createDataFrame([("Phase I study",), ("Three phases of life",), ("PHASE 1/2, open",), (None,)], "t string")
    assert [r[0] for r in titles.select(registries.title_phase(F.col("t"))).collect()] == ["PHASE1", "NA", "PHASE1_PHASE2", "NA"]


def test_phases_of_flags(spark):
    every = list(itertools.product(["Yes E.7.5 Next part", "No", None], repeat=4))
    got = spark.createDataFrame(every, "a string, b string, c string, d string").select("*", registries.eu_phase([F.col(c) for c in "abcd"]).alias("p")).collect()
    for r in got:
        on = [i + 1 for i in range(4) if (r[i] or "").startswith("Yes")]
        pair = len(on) == 2 and on[1] == on[0] + 1
        assert r.p == (f"PHASE{on[0]}_PHASE{on[1]}" if pair else f"PHASE{on[0]}" if on else "NA")


def test_loaders_of_nested_records(spark):
    from tessera.loaders import diseases, events
    from tessera.loaders.build import Build

    lake = {
        "mesh": [{"descriptor_ui": "D1", "name": "Rheumatoid Arthritis", "tree_numbers": "C05"}, {"descriptor_ui": "D2", "name": "Influenza", "tree_numbers": "C01"}, {"descriptor_ui": "D3", "name": "Anemia", "tree_numbers": "C15"}],
        "icd10_codes": [{"code": "J10", "title": "Influenza due to identified virus"}],
        "euctr": [
            {
                "EudraCT Number": "2004-000010-11", "Trial Status": "Completed", "A.3 Full title of the trial": "A trial A.4.1 Sponsor code X", "A. Adequate renal function": "junk", "E.1.1 Medical condition(s) being investigated": "Rheuma",
                "E.1.2 Term": "Rheumatoid arthritis", "E.7.2 Therapeutic exploratory (Phase II)": "Yes", "E.7.3 Therapeutic confirmatory (Phase III)": "Yes E.7.4 Next", "Sponsor 1 - B.1.1 Name of Sponsor": "", "Sponsor 2 - B.1.1 Name of Sponsor": "Acme Ltd",
                "IMP 1 - D.3.1 Product name": "Aspirin", "IMP 1 - D.3.8 INN": "ASPIRIN", "IMP 2 - D.2.1.1.1 Trade name": "Other stuff",
            }
        ],
        "ctri": [{"ctri_number": "CTRI/2020/01/000001", "public_title_of_study": "t", "health_conditions": '[{"condition": "(1) ICD-10 Condition: D64||Anemia"}]', "interventions": '[{"name": "Aspirin", "details": "vs placebo"}]'}],
        "cris": [{"system_number": "KCT0000001", "research_title_en": "k", "cp_contents": "Nothing known(J10)(독감)"}],
        "jrct": [{"Trial ID": "jRCT1", "Public Title": "p", "Scientific Title": "A Phase III trial"}],
        "gsrs": [{"unii": "U1", "preferred_name": "Aspirin"}],
    }
    from tessera.loaders import substances

    b = Build({k: frame(spark, v) for k, v in lake.items()})
    substances.gsrs(b)
    diseases.mesh(b)
    diseases.icd10(b)
    for file in ("euctr", "ctri", "cris", "jrct"):
        events.trials(b, file)
    assert {(r[0], r[1]) for r in rows(b, "ClinicalTrial", "phase", "title")} == {("PHASE2_PHASE3", "A trial"), ("NA", "t"), ("NA", "k"), ("PHASE3", "p")}
    assert rows(b, "STUDIES", "src", "dst", "match_method") == [("CTRI:CTRI/2020/01/000001", "MESH:D3", "name"), ("EUCTR:2004-000010-11", "MESH:D1", "name"), ("KCT:KCT0000001", "ICD10:J10", "icd_code")]
    assert rows(b, "TESTED_IN", "src", "dst") == [("UNII:U1", "CTRI:CTRI/2020/01/000001"), ("UNII:U1", "EUCTR:2004-000010-11")] and rows(b, "Company", "key") == [("COMPANY:acme",)]
