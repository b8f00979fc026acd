"""Names that no rule connects: spellings of two committees, abbreviations, regimens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The international and the American name of a substance.
INN_USAN = [
    ("paracetamol", "acetaminophen"), ("adrenaline", "epinephrine"), ("noradrenaline", "norepinephrine"),
    ("salbutamol", "albuterol"), ("frusemide", "furosemide"), ("lignocaine", "lidocaine"), ("pethidine", "meperidine"),
    ("ciclosporin", "cyclosporine"), ("rifampicin", "rifampin"), ("glibenclamide", "glyburide"),
    ("amoxycillin", "amoxicillin"), ("oestradiol", "estradiol"), ("indometacin", "indomethacin"),
    ("beclometasone", "beclomethasone"), ("dothiepin", "dosulepin"), ("cephalexin", "cefalexin"),
    ("cephradine", "cefradine"), ("thiopentone", "thiopental"), ("phenobarbitone", "phenobarbital"),
    ("hyoscine", "scopolamine"), ("chlorphenamine", "chlorpheniramine"),
    ("trimethoprim sulfamethoxazole", "co-trimoxazole"), ("sodium valproate", "valproate sodium"),
    ("isoprenaline", "isoproterenol"), ("methylthioninium chloride", "methylene blue"),
]
#: Abbreviations that mean one substance.
ABBREVIATIONS = [
    ("5-fu", "fluorouracil"), ("5fu", "fluorouracil"), ("ara-c", "cytarabine"), ("6-mp", "mercaptopurine"),
    ("mtx", "methotrexate"), ("atra", "tretinoin"), ("tdf", "tenofovir disoproxil fumarate"),
    ("taf", "tenofovir alafenamide"), ("ftc", "emtricitabine"), ("3tc", "lamivudine"), ("azt", "zidovudine"),
    ("sof", "sofosbuvir"), ("rbv", "ribavirin"), ("dcv", "daclatasvir"), ("ldv", "ledipasvir"),
    ("cpa", "cyproterone acetate"), ("hctz", "hydrochlorothiazide"), ("asa", "acetylsalicylic acid"),
]
#: Regimens and their substances in order.
REGIMENS = [
    ("folfiri", "folinic acid|fluorouracil|irinotecan"), ("folfox", "folinic acid|fluorouracil|oxaliplatin"),
    ("folfirinox", "folinic acid|fluorouracil|irinotecan|oxaliplatin"), ("xelox", "capecitabine|oxaliplatin"),
    ("capox", "capecitabine|oxaliplatin"), ("chop", "cyclophosphamide|doxorubicin|vincristine|prednisone"),
    ("r-chop", "rituximab|cyclophosphamide|doxorubicin|vincristine|prednisone"),
    ("abvd", "doxorubicin|bleomycin|vinblastine|dacarbazine"), ("fec", "fluorouracil|epirubicin|cyclophosphamide"),
]


def rows() -> list[tuple[str, str, int, str]]:
    """(method, name, pos, target): a name stands for the first of its targets that is known."""
    both = [("inn_usan", a, 0, z) for pair in INN_USAN for a, z in (pair, pair[::-1])]
    short = [("abbrev", a, 0, z) for a, z in ABBREVIATIONS]
    return both + short + [("regimen", a, i, z) for a, parts in REGIMENS for i, z in enumerate(parts.split("|"))]


def table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), "method string, name string, pos int, target string")
