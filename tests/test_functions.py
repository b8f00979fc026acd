"""Text functions and enums on the cases that matter."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import conditions, enums, text, vectors

CASES = [
    (text.fold, [("Béclométasone", "beclometasone"), ("Co-amoxiclav (250mg)", "co amoxiclav"), ("Insulin [human]", "insulin"), (None, ""), ("", "")]),
    (text.strip_salts, [("Metformin HCl", "metformin"), ("Sodium Chloride", "sodium chloride"), ("azithromycin anhydrous", "azithromycin")]),
    (text.strip_stereo, [("DL-Methionine", "methionine"), ("Dexamethasone", "dexamethasone"), ("levocetirizine", "levocetirizine")]),
    (text.norm_company, [("Novartis Pharmaceuticals Corporation", "novartis"), ("Pharmaceuticals Ltd", "pharmaceuticals ltd")]),
    (text.squash, [("SARS-CoV 2", "sarscov2"), ("Sars-CoV2", "sarscov2")]),
    (text.norm_form, [("TABLET (EXTENDED-RELEASE)", "TABLET EXTENDED RELEASE"), ("N/A", ""), ('{"ID": 1, "NAMEEN": "Film-coated tablet"}', "FILM COATED TABLET")]),
    (text.unwrap_lookup, [('{"id": 9016, "nameEn": "Oral use"}', "Oral use"), ("ORAL", "ORAL"), ('{"id": 1}', "")]),
    (text.is_placeholder, [("NIL", True), ("NA", False), ("  not   specified ", True)]),
    (text.usable_name, [("ab", False), ("123456", False), ("abc", True)]),
    (text.clean_cell, [(" a\n b\t c ", "a b c"), ("  a  b ", "a  b")]),
    (text.vocabulary_key, [("efo_0000_1", "EFO:0000_1"), ("MONDO:1", "MONDO:1")]),
    (text.as_integer, [("12.0", 12), ("x", None), (" 7 ", 7)]),
    (text.clean_text, [("VGX&#45;3100", "VGX-3100"), ("dose<br>daily", "dose daily"), ("café", "café"), ("â„¢", "™"), ("cafÃ© – naÃ¯ve é", "café – naïve é"), (None, "")]),
    (text.fold_any, [("ﬁne Ångström", "fine angstrom"), (None, "")]),
    (text.language_by_script, [("abc العربية", "ar"), ("中文", "zh"), ("カタカナ", "ja"), ("plain", "en")]),
    (enums.norm_phase, [("Phase I/II", "PHASE1_PHASE2"), ("0", "NA"), ("Phase 0", "PHASE0"), ("Phase 03", "NA"), ("", "NA"), (None, "NA"), ("PHASE1 | PHASE2", "PHASE1_PHASE2")]),
    (enums.norm_study_type, [("DrugAyurvedaPreventive", "INTERVENTIONAL"), ("symptoms study", "NA"), ("Cross-sectional", "OBSERVATIONAL"), ("PMS", "OBSERVATIONAL")]),
    (enums.norm_product_status, [("Disc*", "DISCONTINUED"), ("Y", "NA"), ("None (Tentative Approval)", "TENTATIVE_APPROVAL")]),
    (enums.norm_status, [("Active, not recruiting", "ACTIVE_NOT_RECRUITING"), ("Some New-thing", "SOME_NEW_THING"), ("", "")]),
    (enums.trial_key, [("NCT01045135", "NCT:NCT01045135"), ("CTIS2022-500000-12-00", "CTIS:2022-500000-12-00"), ("2004-000010-11", "EUCTR:2004-000010-11"), ("12605000001695", "ACTRN:ACTRN12605000001695"), ("", "")]),
]


@pytest.mark.parametrize(("function", "pairs"), CASES, ids=[f.__name__ if hasattr(f, "__name__") else str(i) for i, (f, _) in enumerate(CASES)])
def test_function(spark, function, pairs):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "i int, s string")
    got = {r.i: r.v for r in rows.select("i", function(F.col("s")).alias("v")).collect()}
    assert [got[i] for i in range(len(pairs))] == [b for _, b in pairs]


LADDERS = [
    ("Metastatic Breast Cancer", ["Metastatic Breast Cancer", "Breast Cancer", "Breast Cancers", "Breast Neoplasms", "Breast Neoplasm", "Cancer, Breast"]),
    ("Chronic Disease", ["Chronic Disease"]),
    ("Malignant neoplasm of thyroid gland", ["Malignant neoplasm of thyroid gland", "neoplasm of thyroid gland", "neoplasm of thyroid glands", "thyroid gland Neoplasms", "thyroid Neoplasms", "of thyroid gland, neoplasm", "gland, neoplasm of thyroid"]),
    ("Other rheumatoid arthritis", ["Other rheumatoid arthritis", "Other rheumatoid arthriti", "rheumatoid arthritis", "rheumatoid arthriti", "rheumatoid arthritis, Other", "arthritis, Other rheumatoid", "arthritis, rheumatoid"]),
    ("Carcinoma, Renal Cell", ["Carcinoma, Renal Cell", "Carcinoma, Renal Cells", "Renal Cell Carcinoma"]),
    ("Heart Failure With Ascites", ["Heart Failure With Ascites", "Heart Failure With Ascite", "Heart Failure", "Failure With Ascites, Heart", "Ascites, Heart Failure With"]),
    ("Lung Cancer Stage IV", ["Lung Cancer Stage IV", "Lung Cancer Stage IVs", "Lung Cancer", "Lung Neoplasms Stage IV", "Lung Neoplasm Stage IV", "Cancer Stage IV, Lung", "IV, Lung Cancer Stage"]),
    ("Coronavirus (COVID-19)", ["Coronavirus (COVID-19)", "Coronavirus (COVID-19)s", "COVID-19", "Coronavirus", "(COVID-19), Coronavirus"]),
    ("Overweight and Obesity", ["Overweight and Obesity", "Overweight and Obesitys", "and Obesity, Overweight", "Obesity, Overweight and", "Overweight", "Obesity"]),
    ("COVID-19 Vaccination Disease", ["COVID-19 Vaccination Disease", "COVID-19 Vaccination Diseases", "COVID-19", "Vaccination Disease, COVID-19", "Disease, COVID-19 Vaccination"]),
    ("", []),
    (None, []),
]


def test_condition_variants(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LADDERS)], "i int, t string")
    got = {r.i: r.v for r in rows.select("i", conditions.variants(F.col("t")).alias("v")).collect()}
    assert [got[i] for i in range(len(LADDERS))] == [v for _, v in LADDERS]
    cells = spark.createDataFrame([(0, "Overweight and Obesity"), (1, "Asthma"), (2, None), (3, "Asthma / COPD & a")], "i int, t string")
    assert [r.p for r in cells.select(conditions.parts(F.col("t")).alias("p"), "i").orderBy("i").collect()] == [["Overweight", "Obesity"], [], [], ["Asthma", "COPD"]]


def test_dates(spark):
    rows = spark.createDataFrame([("2020-02-03",), ("03/02/2020",), ("20200203",), ("February 3, 2020",), ("sometime in 2020",)], "s string")
    got = [str(r[0]) for r in rows.select(text.any_date(F.col("s"))).collect()]
    assert got == ["2020-02-03"] * 4 + ["None"]


def test_vectors(spark):
    row = spark.range(1).select(vectors.cosine(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(3.0), F.lit(4.0))).alias("one"), vectors.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("none"), vectors.normalise(F.array(F.lit(3.0), F.lit(4.0))).alias("unit")).first()
    assert row.one == pytest.approx(1) and row.none == 0 and row.unit == pytest.approx([0.6, 0.8])
    e = vectors.embedder(32)
    a, b = (r[0] for r in spark.createDataFrame([("the same text",), ("the same text",)], "t string").select(e("t")).collect())
    assert a == b and sum(x * x for x in a) == pytest.approx(1, rel=1e-5)
