"""Closed vocabularies and registry keys, as ordered conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import is_placeholder, unwrap_lookup

#: Spellings that mean no phase; patterns of phases, the combined ones first.
NO_PHASE = ["na", "n/a", "n.a.", "not applicable", "not specified", "none", "unknown", "not available", "others", "other", "0", ""]
PHASES = [
    (r"\b(early[\s_-]*phase[\s_-]*1|early[\s_-]*phase[\s_-]*i)\b", "EARLY_PHASE1"),
    (r"(phase\s*1\s*[|/&+,-]\s*(phase\s*)?2|1\s*-\s*2\b|i\s*/\s*ii\b)", "PHASE1_PHASE2"),
    (r"(phase\s*2\s*[|/&+,-]\s*(phase\s*)?3|2\s*-\s*3\b|ii\s*/\s*iii\b)", "PHASE2_PHASE3"),
    (r"(phase\s*3\s*[|/&+,-]\s*(phase\s*)?4|3\s*-\s*4\b|iii\s*/\s*iv\b)", "PHASE3_PHASE4"),
    (r"(phase[\s_-]*4|phase[\s_-]*iv|therapeutic use)", "PHASE4"),
    (r"(phase[\s_-]*3|phase[\s_-]*iii|therapeutic confirmatory)", "PHASE3"),
    (r"(phase[\s_-]*2|phase[\s_-]*ii|therapeutic exploratory)", "PHASE2"),
    (r"(phase[\s_-]*1|phase[\s_-]*i\b|human pharmacology)", "PHASE1"),
    (r"phase[\s_-]*0(?![0-9])", "PHASE0"),
    (r"^\s*4\s*$", "PHASE4"),
    (r"^\s*3\s*$", "PHASE3"),
    (r"^\s*2\s*$", "PHASE2"),
    (r"^\s*1\s*$", "PHASE1"),
]
#: Lines of phases with yes or no against each; the yes decides.
PHASE_YES = [("PHASE4", r"(phase[\s_-]*4|phase[\s_-]*iv|therapeutic use)"), ("PHASE3", r"(phase[\s_-]*3|phase[\s_-]*iii|therapeutic confirmatory)"), ("PHASE2", r"(phase[\s_-]*2|phase[\s_-]*ii\b|therapeutic exploratory)"), ("PHASE1", r"(phase[\s_-]*1|phase[\s_-]*i\b|human pharmacology)")]
#: Trial states by spelling.
TRIAL_STATES = {
    "COMPLETED": ["completed", "complete", "ended", "finished", "trial now transitioned"],
    "RECRUITING": ["recruiting", "ongoing recruiting", "authorised recruiting", "open public recruiting"],
    "NOT_YET_RECRUITING": ["not yet recruiting", "pending", "authorised recruitment pending"],
    "ACTIVE_NOT_RECRUITING": ["not recruiting", "active not recruiting", "ongoing", "ongoing recruitment ended"],
    "ENROLLING_BY_INVITATION": ["enrolling by invitation"],
    "TERMINATED": ["terminated", "prematurely ended", "stopped", "stopped early"],
    "WITHDRAWN": ["withdrawn", "not authorised"],
    "SUSPENDED": ["suspended", "temporary halt", "temporarily halted", "deferred"],
    "": ["unknown", "withheld", "not available"],
}
#: Study types by spelling, designs that only observe, and what is administered.
STUDY_TYPES = {
    "INTERVENTIONAL": ["interventional", "intervention", "interventional study", "interventional clinical trial of medicinal product", "interventional trial"],
    "OBSERVATIONAL": ["observational", "observational study", "observational invasive", "observational non invasive"],
    "EXPANDED_ACCESS": ["expanded access"],
}
OBSERVING = ["cross sectional", "cohort study", "case control", "follow up study", "epidemilogical", "epidemiological", "cause relative factors", "prognosis study", "natural history", "post marketing surveillance", "registry study", "case series", "case report"]
OBSERVING_TOKENS = ["pms", "pmos", "rwe"]
ADMINISTERED = ["drug", "ayurveda", "homeopathy", "unani", "siddha", "yoga", "naturopathy", "dentistry", "physiotherapy", "surgical anesthesia", "medical device", "nutraceutical", "biological", "behavioral", "behavioural", "vaccine", "radiation therapy", "ba be", "bioequivalence", "preventive", "treatment study"]
#: Product states by spelling.
PRODUCT_STATES = {
    "MARKETED": ["marketed", "prescription", "over-the-counter", "over the counter", "rx", "otc", "active"],
    "APPROVED": ["approved", "authorised", "authorized"],
    "TENTATIVE_APPROVAL": ["none (tentative approval)", "tentative approval"],
    "DISCONTINUED": ["discontinued", "disc", "disc*", "inactive", "dormant", "medicine discontinued"],
    "WITHDRAWN": ["withdrawn", "application withdrawn", "withdrawn from rolling review", "revoked", "cancelled"],
    "REFUSED": ["refused", "negative"],
    "SUSPENDED": ["suspended"],
    "EXPIRED": ["expired", "lapsed"],
    "UNDER_REVIEW": ["opinion", "opinion under re-examination", "under evaluation", "procedure started"],
}
#: Registries with two names; prefixes of trial ids and their namespaces, in order.
REGISTRIES = {"clinical trials information system": "ctis", "eu clinical trials register": "eu_ctr", "eudract": "eu_ctr", "german clinical trials register": "drks", "nct": "clinicaltrials.gov"}
TRIAL_PREFIXES = "ISRCTN ACTRN CHICTR NCT CTRI JRCT UMIN IRCT PACTR DRKS NTR KCT TCTR RBR SLCTR RPCEC LBCTR ITMCTR CRIS".split()


def chain(pairs: list[tuple[Column, str | Column]], default: str | Column) -> Column:
    """The value of the first condition that holds."""
    out = F.when(*pairs[0])
    for condition, value in pairs[1:]:
        out = out.when(condition, value)
    return out.otherwise(default)


def _words(c: Column, kept: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), f"[^{kept}]+", " "))


def norm_phase(c: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    yes_no = low.contains("yes") & low.contains("phase")
    picked = [(yes_no & low.rlike(p + r"[^:]*:\s*yes"), tag) for tag, p in PHASE_YES]
    return chain([(low.isin(NO_PHASE), "NA"), *picked, *[(low.rlike(p), tag) for p, tag in PHASES]], "NA")


def norm_status(c: Column) -> Column:
    raw = F.trim(F.coalesce(c, F.lit("")))
    key = F.trim(F.regexp_replace(_words(raw, "a-z0-9 "), " +", " "))
    known = [(key.isin(names), tag) for tag, names in TRIAL_STATES.items()]
    return chain([(raw == "", ""), *known, (key.contains("no longer in eu"), "WITHDRAWN"), (key.contains("available"), "")], F.translate(F.upper(raw), " -", "__"))


def norm_study_type(c: Column) -> Column:
    key = _words(c, "a-z0-9")
    tokens = F.split(key, " ")
    return chain(
        [
            (key == "", "NA"),
            *[(key.isin(names), tag) for tag, names in STUDY_TYPES.items()],
            (key.contains("expanded access"), "EXPANDED_ACCESS"),
            (key.contains("observational") | key.rlike("|".join(OBSERVING)) | F.arrays_overlap(tokens, F.array(*map(F.lit, OBSERVING_TOKENS))), "OBSERVATIONAL"),
            (key.contains("intervention") | key.rlike(f"^({'|'.join(ADMINISTERED)})"), "INTERVENTIONAL"),
        ],
        "NA",
    )


def norm_product_status(c: Column) -> Column:
    low = F.lower(F.trim(F.regexp_replace(unwrap_lookup(c), r"\s+", " ")))
    return chain([(is_placeholder(low), "NA"), *[(low.isin(names), tag) for tag, names in PRODUCT_STATES.items()]], "NA")


def norm_registry(c: Column) -> Column:
    s = F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))
    return chain([(s == a, b) for a, b in REGISTRIES.items()], s)


def trial_key(c: Column) -> Column:
    """One key for a registry id, however a source writes it: NAMESPACE:ID."""
    s = F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"\s+", ""), "^JPRN-", "")
    four = F.regexp_extract(s, r"^(?:CTIS)?(\d{4}-\d{6}-\d{2}-\d{2})$", 1)
    three = F.regexp_extract(s, r"(\d{4}-\d{6}-\d{2})", 1)
    european = (s.startswith("EUCTR") | s.rlike(r"^\d{4}-\d{6}-\d{2}$") | s.rlike(r"^20\d{2}-\d{6}-\d{2}")) & (three != "")
    named = [(s.startswith(p), F.concat(F.lit(f"{p}:"), s)) for p in TRIAL_PREFIXES]
    bare = [(s.rlike(r"^\d{14}$"), F.concat(F.lit("ACTRN:ACTRN"), s)), (s.rlike(r"^NL-OMON\d+$"), F.concat(F.lit("NL-OMON:"), s)), (s.rlike(r"^PER-\d{3}-\d{2}(-[A-Z])?$"), F.concat(F.lit("REPEC:"), s))]
    return chain([(s == "", ""), (four != "", F.concat(F.lit("CTIS:"), four)), (european, F.concat(F.lit("EUCTR:"), three)), *named, (s.startswith("REBEC"), F.concat(F.lit("RBR:"), s)), *bare], F.concat(F.lit("TRIAL:"), s))
