"""Products, trials, safety reports and publications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import conditions, enums, places, registries, terms, text
from tessera.functions.conditions import link
from tessera.loaders.build import Build, folded_key
from tessera.loaders.places import conducted, region_key
from tessera.operators import resolve, transforms


def product(b: Build, rows: DataFrame, source: str, agency: str) -> None:
    """The product funnel. rows: key, name, ingredients, company, status, form, strength, route, date."""
    form = text.norm_form(F.col("form"))
    named = rows.withColumn("form", form)
    if "forms" in b.dictionaries:
        # A form that the codelist names gets its spelling.
        named = named.withColumn("form_key", text.form_key(F.col("form"))).join(b.dictionaries["forms"], "form_key", "left").withColumn("form", F.coalesce("standard", "form"))
    b.add("Product", named, source, key="key", name="name", agency=F.lit(agency), status=enums.norm_product_status(F.col("status")), status_raw="status", form="form", strength="strength")
    b.add("APPROVED_BY", rows, source, src="key", dst=F.lit(f"AGENCY:{agency}"), match_method=F.lit("structured"))
    b.add("APPROVED_IN", rows, source, src="key", dst=region_key(F.lit(places.agency_region(agency))), match_method=F.lit("derived"))
    parts = rows.select("key", F.explode(text.split_ingredients(F.col("ingredients"))).alias("ingredient"))
    found = b.resolve(parts, "ingredient", provisional=True)
    own = found.filter("match_method = 'provisional'")
    b.add("Substance", own, source, key="substance", name="ingredient", norm_name=text.fold(F.col("ingredient")), resolved_by=F.lit("provisional"))
    b.add("CONTAINS", found, source, src="key", dst="substance", match_method="match_method")
    made = rows.filter("company <> ''").withColumn("c", F.concat(F.lit("COMPANY:"), text.norm_company(F.col("company"))))
    b.add("Company", made, source, key="c", name="company", raw_names="company")
    b.add("DEVELOPS", made, source, src="c", dst="key", match_method=F.lit("structured"))
    ways = rows.select("key", F.explode(text.routes(text.unwrap_lookup(F.col("route")))).alias("way"))
    b.add("Route", ways, source, key=folded_key("ROUTE:", "way"), name="way")
    b.add("HAS_ROUTE", ways, source, src="key", dst=folded_key("ROUTE:", "way"), match_method=F.lit("structured"))
    dated = rows.filter("date <> ''").withColumn("a", F.concat(F.lit("APPROVAL:"), "key"))
    b.add("Approval", dated, source, key="a", date="date", status="status", agency=F.lit(agency))
    b.add("HAS_APPROVAL", dated, source, src="key", dst="a", match_method=F.lit("structured"))
    b.add("ISSUED_BY", dated, source, src="a", dst=F.lit(f"AGENCY:{agency}"), match_method=F.lit("derived"))


def _products(b: Build, file: str, source: str, agency: str, key: list[str], prefix: str, **columns: str) -> None:
    every = ("name", "ingredients", "company", "status", "form", "strength", "route", "date")
    r = b.rows(file, *key, *columns.values()).filter(" and ".join(f"`{k}` <> ''" for k in key))
    cells = [(F.col(f"`{columns[c]}`") if c in columns else F.lit("")).alias(c) for c in every]
    product(b, r.select(F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(f"`{k}`") for k in key])).alias("key"), *cells), source, agency)


def orangebook(b: Build) -> None:
    _products(b, "ob", "orangebook", "FDA", ["Appl_No", "Product_No"], "FDA:", name="Trade_Name", ingredients="Ingredient", company="Applicant_Full_Name", form="Dosage_Form_Route", strength="Strength", date="Approval_Date")


def mhra(b: Build) -> None:
    _products(b, "mhra", "mhra", "MHRA", ["pl_number"], "MHRA:", name="product_name", ingredients="substance_name", status="release_state")


def ema(b: Build) -> None:
    _products(b, "ema", "ema", "EMA", ["ema_product_number"], "EMA:", name="name_of_medicine", ingredients="active_substance", company="marketing_authorisation_developer_applicant_holder", status="medicine_status", date="marketing_authorisation_date")


def openfda(b: Build) -> None:
    _products(b, "openfda", "openfda", "FDA", ["application_number", "product_number"], "FDA:", name="brand_name", ingredients="active_ingredients", status="marketing_status", form="dosage_form")


def sfda(b: Build) -> None:
    _products(b, "sfda", "sfda", "SFDA", ["registerNumber"], "SFDA:", name="tradeName", ingredients="scientificName", company="company", status="marketingStatus", form="pharmaceuticalForm", strength="strength", route="administrationRoute")


def pmda(b: Build) -> None:
    _products(b, "pmda", "pmda", "PMDA", ["id"], "PMDA:", name="brand_name", ingredients="generic_name", date="approval_date")


def canada(b: Build) -> None:
    """A star around the drug code: ingredients, form, company, route."""
    packed = lambda file, column, name: b.rows(file, "DRUG_CODE", column).filter(f"`{column}` <> ''").groupBy("DRUG_CODE").agg(F.array_join(F.array_sort(F.collect_set(column)), ";").alias(name))
    r = b.rows("ca_drug", "DRUG_CODE", "BRAND_NAME", "STATUS_CATEGORY").filter("DRUG_CODE <> ''")
    r = r.join(packed("ca_ingred", "INGREDIENT_NAME", "ingredients"), "DRUG_CODE", "left").join(packed("ca_comp", "COMPANY_NAME", "company"), "DRUG_CODE", "left").join(packed("ca_route", "ROUTE_OF_ADMINISTRATION_EN", "route"), "DRUG_CODE", "left").join(packed("ca_form", "PHARMACEUTICAL_FORM_EN", "form"), "DRUG_CODE", "left")
    cell = lambda c: F.coalesce(c, F.lit("")).alias(c)
    product(b, r.select(F.concat(F.lit("CA:"), "DRUG_CODE").alias("key"), F.col("BRAND_NAME").alias("name"), cell("ingredients"), F.split_part(F.coalesce("company", F.lit("")), F.lit(";"), F.lit(1)).alias("company"), F.col("STATUS_CATEGORY").alias("status"), F.split_part(F.coalesce("form", F.lit("")), F.lit(";"), F.lit(1)).alias("form"), F.lit("").alias("strength"), F.replace(F.coalesce("route", F.lit("")), F.lit(";"), F.lit(",")).alias("route"), F.lit("").alias("date")), "canada", "HC")


def patents(b: Build) -> None:
    """Patents and exclusivities of products, on both parts of their number; one namespace for patents."""
    p = b.rows("ob_patents", "Appl_No", "Product_No", "Patent_No", "Patent_Expire_Date_Text", "Patent_Use_Code", "Drug_Substance_Flag", "Drug_Product_Flag").filter("Patent_No <> ''").withColumn("key", F.concat(F.lit("PATENT:US:"), "Patent_No"))
    b.add("Patent", p, "orangebook", key="key", patent_no="Patent_No", expire_date="Patent_Expire_Date_Text", use_code="Patent_Use_Code", drug_substance_flag="Drug_Substance_Flag", drug_product_flag="Drug_Product_Flag")
    b.add("PROTECTED_BY", p, "orangebook", src=F.concat(F.lit("FDA:"), F.concat_ws("-", "Appl_No", "Product_No")), dst="key", match_method=F.lit("structured"))
    x = b.rows("ob_excl", "Appl_No", "Product_No", "Exclusivity_Code", "Exclusivity_Date").filter("Exclusivity_Code <> ''").withColumn("key", F.concat(F.lit("EXCL:"), F.concat_ws("-", "Appl_No", "Product_No", "Exclusivity_Code")))
    b.add("Exclusivity", x, "orangebook", key="key", code="Exclusivity_Code", date="Exclusivity_Date")
    b.add("HAS_EXCLUSIVITY", x, "orangebook", src=F.concat(F.lit("FDA:"), F.concat_ws("-", "Appl_No", "Product_No")), dst="key", match_method=F.lit("structured"))


#: Columns of registries' files by what the trial funnel reads.
REGISTRIES = {
    "ctgov": ("clinicaltrials.gov", dict(id="nct_id", title="brief_title", status="overall_status", phase="phases", study_type="study_type", enrollment="enrollment", start="start_date", sponsor="lead_sponsor", conditions="conditions", interventions="interventions")),
    "chictr": ("chictr", dict(id="trial_id", title="public_title", status="recruitment_status", phase="phase", study_type="study_type", enrollment="target_size", start="date_enrolment", sponsor="primary_sponsor", conditions="hc_freetext", interventions="i_freetext")),
    "anzctr": ("anzctr", dict(id="ACTRN", title="STUDY TITLE", phase="PHASE", study_type="STUDY TYPE", start="ACTUAL START DATE", interventions="INTERVENTIONS")),
    "isrctn": ("isrctn", dict(id="ISRCTN", title="Title", status="Overall study status", phase="Phase", study_type="Study type(s)", start="Date of first enrolment", sponsor="Sponsor", conditions="Health condition(s) or problem(s) studied", interventions="Drug/device/biological/vaccine name(s)")),
    "ctis": ("ctis", dict(id="Trial number", title="Title of the trial", status="Overall trial status", phase="Trial phase", enrollment="Number of participants enrolled", start="Start date", sponsor="Sponsor/Co-Sponsors", conditions="Medical conditions", interventions="Product")),
    "jrct": ("jrct", dict(id="Trial ID", title="Public Title", status="Recruitment status", study_type="Study Type", start="Actual date of first enrollment", sponsor="Primary Sponsor", conditions="Health Condition(s) or Problem(s) Studied", interventions="Intervention(s)")),
    "ctri": ("ctri", dict(id="ctri_number", title="public_title_of_study", study_type="type_of_study", enrollment="target_sample_size", start="registration_date", sponsor="primary_sponsor_name", conditions="health_conditions", interventions="interventions")),
    "cris": ("cris", dict(id="system_number", title="research_title_en", phase="clinical_step", study_type="research_kind", start="study_start_date", sponsor="resrc_spp_en")),
    "euctr": ("eu_ctr", dict(id="EudraCT Number")),
    "who": ("who", dict(id="TrialID", title="Public_title", status="Recruitment_Status", phase="Phase", study_type="Study_type", enrollment="Target_size", start="Date_enrollement", sponsor="Primary_sponsor", conditions="Condition", interventions="Intervention")),
}


def _eu(b: Build) -> DataFrame:
    """The wide EU file: sections by their numbers, wherever their columns stand."""
    names = b.lake["euctr"].columns
    at = lambda c: F.col(f"`{c}`") if c in names else F.lit("")
    b.used.append("euctr")
    r = b.lake["euctr"]
    return r.select(
        F.trim(at("EudraCT Number")).alias("id"), registries.eu_field(at("A.3 Full title of the trial")).alias("title"), F.trim(at("Trial Status")).alias("status"), registries.eu_phase([at(c) for c in registries.EU_PHASES]).alias("phase"),
        F.lit("").alias("study_type"), F.lit("").alias("enrollment"), F.lit("").alias("start"), registries.eu_sponsor(names).alias("sponsor"),
        registries.eu_conditions(at(registries.EU_CONDITION), at(registries.EU_TERM)).alias("conditions"), registries.eu_products(names).alias("interventions"),
    )


#: Fields that are nested in a registry's cells, by the file: what reads them.
NESTED = {
    "ctri": {"conditions": lambda: registries.indian_conditions(F.col("health_conditions")), "interventions": lambda: registries.indian_interventions(F.col("interventions"))},
    "cris": {"conditions": lambda: registries.korean_conditions(F.col("cp_contents"))},
    "jrct": {"phase": lambda: registries.title_phase(F.col("Scientific Title"), F.col("Public Title"))},
}
#: Files whose phase is already one of the declared ones.
TOLD = {"euctr", "jrct"}
#: Columns that nested fields are read from.
ALSO = {"cris": ["cp_contents"], "jrct": ["Scientific Title"]}


def trials(b: Build, file: str) -> None:
    """The trial funnel: one key for every registry's id, sponsors, conditions through rewritings, drugs through the resolver."""
    registry, columns = REGISTRIES[file]
    fields = ("id", "title", "status", "phase", "study_type", "enrollment", "start", "sponsor", "conditions", "interventions")
    if file == "euctr":
        r = _eu(b)
    else:
        raw, nested = b.rows(file, *columns.values(), *ALSO.get(file, [])), NESTED.get(file, {})
        r = raw.select(*[(nested[c]() if c in nested else F.col(f"`{columns[c]}`") if c in columns else F.lit("")).alias(c) for c in fields])
    r = r.withColumn("key", enums.trial_key(F.col("id"))).filter("key <> ''")
    if file not in TOLD:
        r = r.withColumn("phase", enums.norm_phase(F.col("phase")))
    b.add("ClinicalTrial", r, file, key="key", registry=F.lit(registry), title="title", status=enums.norm_status(F.col("status")), phase="phase", study_type=enums.norm_study_type(F.col("study_type")), study_type_raw="study_type", enrollment="enrollment", start_date="start")
    b.identify(r.withColumn("value", F.upper(F.regexp_replace("id", r"\s+", ""))), file, "key", "TRIAL", "value")
    s = r.filter("sponsor <> ''").withColumn("c", F.concat(F.lit("COMPANY:"), text.norm_company(F.col("sponsor"))))
    b.add("Company", s, file, key="c", name="sponsor", raw_names="sponsor")
    b.add("SPONSORED_BY", s, file, src="key", dst="c", match_method=F.lit("structured"))
    studies(b, r, file)
    if file in COUNTRY_CELLS:
        column, names = COUNTRY_CELLS[file]
        cells = b.rows(file, columns["id"], column).select(enums.trial_key(F.col(f"`{columns['id']}`")).alias("key"), F.col(f"`{column}`").alias("c")).filter("key <> ''")
        conducted(b, cells, file, names(F.col("c")))
    drugs = r.select("key", F.explode(terms.drug_names(F.col("interventions"))).alias("drug"))
    b.add("TESTED_IN", b.resolve(drugs, "drug"), file, src="substance", dst="key", match_method="match_method")


#: The cells that name a trial's countries, and how.
COUNTRY_CELLS = {"ctgov": ("locations", places.in_brackets), "who": ("Countries", places.in_list), "isrctn": ("Country of recruitment", places.in_list), "ctri": ("countries_of_recruitment", places.in_list)}


def studies(b: Build, trials: DataFrame, source: str) -> None:
    """STUDIES edges of trials (key, conditions): by name, by the names of one cell, else by the registry's code.

    A code counts for a trial that no name links: it by itself, else its category of three characters.
    """
    if not b.diseases():
        return
    asked = trials.select(F.col("key").alias("id"), F.explode(terms.condition_names(F.col("conditions"))).alias("term"))
    whole = link(asked, b.diseases()).select("id", "key", "method")
    single = asked.select("id", F.explode(conditions.parts(F.col("term"))).alias("term"))
    # One name may be linked as a whole and as a part; the first writer of an edge wins.
    parts = link(single, b.diseases()).select("id", "key", F.lit("name_part").alias("method"))
    named = whole.unionByName(parts)
    b.add("STUDIES", whole, source, src="id", dst="key", match_method="method")
    b.add("STUDIES", parts, source, src="id", dst="key", match_method="method")
    if "icd" not in b.dictionaries:
        return
    codes = trials.select(F.col("key").alias("id"), F.posexplode(terms.condition_codes(F.col("conditions"))).alias("at", "code")).join(named.select("id").distinct(), "id", "left_anti")
    tries = codes.select("id", "at", F.posexplode(F.array_distinct(F.array("code", F.left("code", F.lit(3))))).alias("step", "code"))
    found = tries.join(b.dictionaries["icd"], "code").groupBy("id").agg(F.min_by("key", F.struct("at", "step")).alias("key"))
    b.add("STUDIES", found, source, src="id", dst="key", match_method=F.lit("icd_code"))


def same_studies(b: Build, file: str, cross: list[str]) -> None:
    """Ids of the same study in other registries: links, and stubs of the lowest precedence."""
    registry, columns = REGISTRIES[file]
    r = b.rows(file, columns["id"], *cross)
    pairs = r.select(enums.trial_key(F.col(f"`{columns['id']}`")).alias("a"), F.explode(F.array(*[enums.trial_key(F.col(f"`{c}`")) for c in cross])).alias("b")).filter("a <> '' and b <> '' and a <> b and not b like 'TRIAL:%'")
    b.add("SAME_STUDY_AS", pairs, file, src="a", dst="b", match_method=F.lit("structured"))
    b.add("ClinicalTrial", pairs, file, key="b", phase=F.lit("NA"), study_type=F.lit("NA"))


def recalls(b: Build) -> None:
    r = b.rows("recalls", "recall_number", "brand_name", "generic_name", "product_description", "status", "recall_initiation_date", "termination_date", "reason_for_recall", "classification").filter("recall_number <> ''").withColumn("key", F.concat(F.lit("EVENT:RECALL:"), "recall_number"))
    b.add("RegulatoryEvent", r, "recalls", key="key", type=F.lit("RECALL"), name=text.first_filled(F.col("brand_name"), F.col("product_description")), status=text.first_filled(F.col("classification"), F.col("status")), reason="reason_for_recall", start_date="recall_initiation_date", end_date="termination_date")
    drugs = r.select("key", F.explode(text.split_ingredients(F.col("generic_name"))).alias("drug"))
    b.add("SUBJECT_OF", b.resolve(drugs, "drug"), "recalls", src="substance", dst="key", match_method="match_method")


#: Files of regulatory events: type, start of the key, its cells, and whether animals' medicines are among them.
EVENTS = {
    "ema_referrals": ("referral", "EVENT:REFERRAL:", ["reference_number"], True, {"subjects": "international_non_proprietary_name_inn_common_name", "name": "referral_name", "status": "current_status", "start_date": "procedure_start_date", "end_date": "european_commission_decision_date", "url": "referral_url"}),
    "ema_shortages": ("shortage", "EVENT:SHORTAGE:EMA:", ["medicine_affected"], False, {"subjects": "international_non_proprietary_name_inn_or_common_name", "name": "medicine_affected", "status": "supply_shortage_status", "start_date": "start_of_shortage_date", "end_date": "expected_resolution_date", "url": "shortage_url"}),
    "ema_orphan": ("orphan_designation", "EVENT:ORPHAN:", ["eu_designation_number"], False, {"subjects": "active_substance", "name": "intended_use", "status": "status", "start_date": "date_of_designation_refusal", "url": "orphan_designation_url"}),
    "ema_dhpc": ("dhpc", "EVENT:DHPC:", ["name_of_medicine", "dhpc_type"], True, {"subjects": "active_substances", "name": "name_of_medicine", "reason": "dhpc_type", "status": "regulatory_outcome", "start_date": "dissemination_date", "url": "dhpc_url"}),
    "sfda_short": ("shortage", "EVENT:SHORTAGE:SFDA:", ["REGISTRATION_NO"], False, {"subjects": "SCIENTIFICNAME_EN", "name": "TRADENAME_EN", "status": "SHORTAGE_TYPE_EN", "reason": "SHORTAGE_REASON_EN", "start_date": "SHORTAGE_START_DATE"}),
    "ema_pip": ("paediatric_investigation_plan", "EVENT:PIP:", ["decision_number"], False, {"subjects": "active_substance", "name": "condition_indication", "status": "compliance_outcome", "start_date": "decision_date", "url": "pip_url"}),
}
#: What parts the names of a file's subjects, where it isn't a semicolon.
APART = {"sfda_short": ","}
#: Keys that are made of names, not of numbers.
NAMED = {"ema_shortages", "ema_dhpc"}


def regulatory(b: Build, file: str) -> None:
    """Events of one file, without those of animals' medicines, and the substances that they concern."""
    kind, start, ids, animals, columns = EVENTS[file]
    r = b.rows(file, *dict.fromkeys([*ids, *columns.values(), *(["category"] if animals else [])])).filter(F.col(ids[0]) != "")
    if animals:
        r = r.filter(F.lower("category") != "veterinary")
    cells = [text.fold(F.col(c)) if file in NAMED else F.col(c) for c in ids]
    r = r.withColumn("key", F.concat(F.lit(start), F.concat_ws(":", *cells)))
    b.add("RegulatoryEvent", r, file, key="key", type=F.lit(kind), **{k: v for k, v in columns.items() if k != "subjects"})
    names = r.select("key", F.explode(text.parts(F.col(columns["subjects"]), APART.get(file, ";"))).alias("subject")).filter(F.length("subject") >= 3)
    found = b.resolve(names, "subject", provisional=True)
    b.add("Substance", found.filter("match_method = 'provisional'"), file, key="substance", name="subject", norm_name=text.fold(F.col("subject")), resolved_by=F.lit("provisional"))
    b.add("SUBJECT_OF", found, file, src="substance", dst="key", match_method="match_method")


def alerts(b: Build) -> None:
    """Safety alerts of the Saudi authority; one without a number goes by its title."""
    r = b.rows("sfda_alert", "#", "Title", "Type of news", "Date", "Link of news").filter("Title <> ''")
    number = F.when(F.col("`#`") != "", F.col("`#`")).otherwise(text.fold(F.col("Title")))
    b.add("RegulatoryEvent", r, "sfda_alert", key=F.concat(F.lit("EVENT:SFDA_ALERT:"), number), type=F.lit("safety_alert"), name="Title", reason=F.col("`Type of news`"), start_date="Date", url=F.col("`Link of news`"))


def faers(b: Build) -> None:
    """Pairs of suspect drug and reaction, each report once, three reports at least; the salt's parent has the same counts."""
    r = b.rows("faers", "safetyreportid", "drug_substance", "drug_characterization", "reaction", "serious", "seriousnessdeath")
    drugs = transforms.suspects(F.col("drug_substance"), F.col("drug_characterization"))
    long = r.select("safetyreportid", "serious", "seriousnessdeath", F.explode(drugs).alias("drug"), "reaction").withColumn("reaction", F.explode(text.parts(F.col("reaction"), ";")))
    long = b.resolve(long, "drug").withColumn("ae", text.fold(F.col("reaction"))).filter(F.length("ae") >= 3)
    once = long.groupBy("safetyreportid", "substance", "ae").agg(F.min(F.struct("serious", "seriousnessdeath", "reaction", "match_method")).alias("w"))
    counted = once.groupBy("substance", "ae").agg(F.count("*").alias("n"), F.sum((F.col("w.serious") == "1").cast("int")).alias("serious"), F.sum((F.col("w.seriousnessdeath") == "1").cast("int")).alias("death"), F.min("w.reaction").alias("term"), F.min("w.match_method").alias("match_method")).filter("n >= 3")
    b.add("AdverseEvent", counted, "faers", key=F.concat(F.lit("AE:"), "ae"), term="term")
    up = resolve.with_parent(counted, "substance", b.dictionaries["salt_parent"]) if "salt_parent" in b.dictionaries else counted
    for rows in (counted, up):
        b.add("HAS_ADVERSE_EVENT", rows, "faers", src="substance", dst=F.concat(F.lit("AE:"), "ae"), match_method="match_method", report_count="n", serious_count="serious", death_count="death")


def organ_classes(b: Build) -> None:
    r = b.rows("vigiaccess", "system_organ_class", "adverse_reaction").filter("system_organ_class <> '' and adverse_reaction <> ''")
    b.add("OrganClass", r, "vigiaccess", key=folded_key("SOC:", "system_organ_class"), name="system_organ_class")
    b.add("IN_ORGAN_CLASS", r, "vigiaccess", src=folded_key("AE:", "adverse_reaction"), dst=folded_key("SOC:", "system_organ_class"), match_method=F.lit("structured"))


def publications(b: Build) -> None:
    """Publications by PubMed id, else DOI; diseases and substances named by up to four words of the title."""
    every = None
    for file in ("europepmc", "pubmed", "biorxiv", "medrxiv"):
        if b.has(file):
            r = b.rows(file, "pmid", "doi", "title", "journal_title", "publication_date", "first_publication_date", "date").withColumn("source_db", F.lit(file)).withColumn("preprint", F.lit("true" if file.endswith("rxiv") else "false"))
            every = r if every is None else every.unionByName(r)
    key = F.when(F.col("pmid") != "", F.concat(F.lit("PMID:"), "pmid")).when(F.col("doi") != "", F.concat(F.lit("DOI:"), F.lower("doi")))
    p = every.withColumn("key", key).filter("key is not null")
    b.add("Publication", p, "literature", key="key", title="title", year=text.year(F.col("publication_date"), F.col("first_publication_date"), F.col("date")), journal="journal_title", doi="doi", pmid="pmid", source_db="source_db", preprint="preprint")
    words = p.select("key", F.filter(F.split(text.fold(F.col("title")), " "), lambda w: w != "").alias("w")).filter(F.size("w") > 0)
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))).otherwise(F.array().cast("array<string>"))))
    found = words.select("key", F.explode(F.array_distinct(grams)).alias("probe"))
    if b.diseases():
        b.add("ABOUT", found.join(b.dictionaries["mesh"].withColumnRenamed("key", "disease"), "probe").distinct(), "literature", src="key", dst="disease", match_method=F.lit("title_ngram"))
    b.add("MENTIONS", b.resolve(found.withColumnRenamed("probe", "drug"), "drug").filter("match_method = 'unii'"), "literature", src="key", dst="substance", match_method="match_method")


PRODUCTS = {"ca_drug": canada, "mhra": mhra, "ema": ema, "ob": orangebook, "ob_patents": patents, "openfda": openfda, "sfda": sfda, "pmda": pmda}
SAFETY = {"recalls": recalls, "sfda_alert": alerts, "faers": faers, "vigiaccess": organ_classes, "europepmc": publications}
