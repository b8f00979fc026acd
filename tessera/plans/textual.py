"""Text functions, enums and keys on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import enums, terms, text
from tessera.operators import transforms
from tessera.plans.registry import Plans
from tessera.sources.documents import is_of_kind

P = Plans()
query = P.query
_SALTS = ", ".join(f"'{t}'" for t in text.SALTS)
_COMPANY = ", ".join(f"'{t}'" for t in text.COMPANY_TOKENS)


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(line), '[^\x00-\x7F]', '', 'g')), '\[.*?\]|\(.*?\)', ' ', 'g'), '[^a-z0-9_\s]+', ' ', 'g'), '\s+', ' ', 'g')) AS folded
FROM (SELECT doc_id, replace(replace(string_split(text, chr(10))[1], '|', ' '), 'ß', '') AS line FROM documents)""")
def fold_first_line(read):
    """letters without marks, lower case, no brackets, no punctuation."""
    line = F.replace(F.replace(F.element_at(F.split("text", "\n"), 1), F.lit("|"), F.lit(" ")), F.lit("ß"), F.lit(""))
    return read("documents").select("doc_id", text.fold(line).alias("folded"))


@query(f"""SELECT p_partkey, CASE WHEN len(kept) = 0 THEN name ELSE array_to_string(kept, ' ') END AS stripped FROM (SELECT p_partkey, name, list_filter(string_split(name, ' '), lambda t: t NOT IN ({_SALTS})) AS kept
FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' sodium' WHEN p_partkey % 3 = 1 THEN 'sodium chloride' ELSE p_name END AS name FROM part))""")
def strip_salts(read):
    """names without salt tokens, unless nothing is left."""
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" Sodium"))).when(F.col("p_partkey") % 3 == 1, "Sodium Chloride").otherwise(F.col("p_name"))
    return read("part").select("p_partkey", text.strip_salts(name).alias("stripped"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'es' || replace(p_name, ' ', '') END AS strict FROM part""")
def strip_stereo(read):
    """a separate stereo prefix goes, a joined one stays."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("DL-"), "p_name")).otherwise(F.concat(F.lit("es"), F.replace("p_name", F.lit(" "), F.lit(""))))
    return read("part").select("p_partkey", text.strip_stereo(name).alias("strict"))


@query(f"""SELECT s_suppkey, CASE WHEN len(kept) = 0 THEN name ELSE array_to_string(kept, ' ') END AS company FROM (SELECT s_suppkey, name, list_filter(string_split(name, ' '), lambda t: t NOT IN ({_COMPANY})) AS kept
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'pharmaceuticals ltd' ELSE 'supplier ' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || ' pharma gmbh' END AS name FROM supplier))""")
def company_keys(read):
    """company names without legal forms."""
    name = F.when(F.col("s_suppkey") % 4 == 0, "Pharmaceuticals, Ltd").otherwise(F.concat("s_name", F.lit(" Pharma GmbH")))
    return read("supplier").select("s_suppkey", text.norm_company(name).alias("company"))


@query("SELECT p_partkey, replace(p_name, ' ', '') AS squashed, list_filter(list_transform(string_split_regex(p_name || ' | ;a', '[|;]'), lambda x: trim(x)), lambda x: x <> '') AS synonyms FROM part")
def squash_and_split(read):
    """keys without spaces; packed synonyms."""
    return read("part").select("p_partkey", text.squash(F.col("p_name")).alias("squashed"), text.split_synonyms(F.concat("p_name", F.lit(" | ;a"))).alias("synonyms"))


@query("SELECT p_partkey, length(p_name) >= 3 AS usable, p_partkey % 5 = 0 AS placeholder FROM part")
def name_predicates(read):
    """Usable names and placeholders."""
    return read("part").select("p_partkey", text.usable_name(F.col("p_name")).alias("usable"), text.is_placeholder(F.when(F.col("p_partkey") % 5 == 0, " Not  Applicable ").otherwise(F.col("p_name"))).alias("placeholder"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS n_paragraphs, trim(regexp_replace(regexp_replace(html, '<[^>]{1,40}>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages")
def page_fields(read):
    """Titles, counts and plain text of markup by patterns."""
    h = F.col("html")
    return read("pages").select("page_id", F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all(h, F.lit("<p>"), 0)).alias("n_paragraphs"), F.trim(F.regexp_replace(F.regexp_replace(h, "<[^>]{1,40}>", " "), r"\s+", " ")).alias("plain"))


@query()
def clean_pages(read):
    """entities, tags and double encoding undone (Arrow)."""
    return read("pages").select("page_id", text.clean_text(F.col("html")).alias("text"))


@query(r"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'FILM COATED' ELSE event_type END AS name FROM events""")
def unwrap_lookup(read):
    """The English name inside a serialised row."""
    raw = F.when(F.col("event_id") % 2 == 0, '{"ID": 1, "NAMEAR": "x", "NAMEEN": "FILM COATED", "SORT": null}').otherwise(F.col("event_type"))
    return read("events").select("event_id", text.unwrap_lookup(raw).alias("name"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_type || ' EXTENDED RELEASE' WHEN p_partkey % 3 = 1 THEN '' ELSE upper(p_name) END AS form FROM part")
def dosage_forms(read):
    """one spelling of forms; placeholders are empty."""
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.initcap("p_type"), F.lit(" (Extended-Release)"))).when(F.col("p_partkey") % 3 == 1, "N/A").otherwise(F.col("p_name"))
    return read("part").select("p_partkey", text.norm_form(raw).alias("form"))


_PHASES = [("Phase I/II", "PHASE1_PHASE2"), ("PHASE2 | PHASE3", "PHASE2_PHASE3"), ("Phase 0", "PHASE0"), ("0", "NA"), ("early phase 1", "EARLY_PHASE1"), ("Human pharmacology (Phase I): yes", "PHASE1"), ("Therapeutic confirmatory", "PHASE3"), ("4", "PHASE4"), ("Treatment study", "NA"), ("Phase IV", "PHASE4")]


def _case_query(name: str, table: str, key: str, pairs: list[tuple[str, str]], function, doc: str) -> None:
    sql = f"SELECT {key}, CASE {key} % {len(pairs)} " + " ".join(f"WHEN {i} THEN '{b}'" for i, (_, b) in enumerate(pairs)) + f" END AS value FROM {table}"

    def run(read):
        raw = F.element_at(F.array(*[F.lit(a) for a, _ in pairs]), (F.col(key) % len(pairs) + 1).cast("int"))
        return read(table).select(key, function(raw).alias("value"))

    run.__name__, run.__doc__ = name, doc
    P.query(sql)(run)


_case_query("trial_phases", "orders", "o_orderkey", _PHASES, enums.norm_phase, "F14: phases of registries.")
_case_query("trial_states", "orders", "o_orderkey", [("Active, not recruiting", "ACTIVE_NOT_RECRUITING"), ("Ongoing, recruiting", "RECRUITING"), ("Prematurely Ended", "TERMINATED"), ("No longer in EU/EEA", "WITHDRAWN"), ("Available", ""), ("Some new-state", "SOME_NEW_STATE"), ("", "")], enums.norm_status, "F15: trial states.")
_case_query("study_types", "orders", "o_orderkey", [("DrugAyurvedaPreventive", "INTERVENTIONAL"), ("Observational study", "OBSERVATIONAL"), ("PMS", "OBSERVATIONAL"), ("symptoms study", "NA"), ("Expanded access", "EXPANDED_ACCESS"), ("Cohort study", "OBSERVATIONAL"), ("BA/BE", "INTERVENTIONAL")], enums.norm_study_type, "F16: study types.")
_case_query("product_states", "part", "p_partkey", [("Disc*", "DISCONTINUED"), ("Y", "NA"), ("None (Tentative Approval)", "TENTATIVE_APPROVAL"), ("Prescription", "MARKETED"), ("Lapsed", "EXPIRED"), ("nil", "NA")], enums.norm_product_status, "F13: product states.")
_case_query("registries", "part", "p_partkey", [("EudraCT", "eu_ctr"), ("German  Clinical Trials Register", "drks"), ("ChiCTR", "chictr"), ("NCT", "clinicaltrials.gov")], enums.norm_registry, "F17: registry names.")
_case_query("trial_keys", "orders", "o_orderkey", [("nct 01045135", "NCT:NCT01045135"), ("CTIS2022-500000-12-00", "CTIS:2022-500000-12-00"), ("EUCTR2004-000010-11-GB", "EUCTR:2004-000010-11"), ("12605000001695", "ACTRN:ACTRN12605000001695"), ("JPRN-UMIN000001", "UMIN:UMIN000001"), ("PER-002-99-A", "REPEC:PER-002-99-A"), ("xyz 1", "TRIAL:XYZ1"), ("", "")], enums.trial_key, "F18: one key for a registry id.")
_case_query("any_dates", "orders", "o_orderkey", [("2020-01-31", "2020-01-31"), ("31/01/2020", "2020-01-31"), ("20200131", "2020-01-31"), ("January 31, 2020", "2020-01-31"), ("31 January 2020", "2020-01-31")], lambda c: text.any_date(c).cast("string"), "F39: dates in the forms that sources write.")


_packed = lambda f: lambda c: F.array_join(f(c), "|")
_case_query("registry_drugs", "orders", "o_orderkey", [("Intervention1: Nab-paclitaxel 100 mg weekly|Drug: Cisplatin/Etoposide|Matching Placebo|Control group: Nil|Other: water", "Nab-paclitaxel|paclitaxel|Cisplatin|Etoposide"), ("Drug: Metformin 500 mg", "Metformin"), ("Standard of care", ""), ("Aspirin + Clopidogrel; sham surgery", "Aspirin|Clopidogrel"), ("Device: Stent<br/>usual care", "Stent"), ("", "")], _packed(terms.drug_names), "F10, P14: drugs of intervention cells.")
_case_query("registry_conditions", "orders", "o_orderkey", [("Health Condition 1: C692- Malignant neoplasm of retina;Diabetes: type 2;10047079", "Malignant neoplasm of retina|Diabetes: type 2"), ("Asthma<br/>COPD", "Asthma|COPD"), ("x", ""), ("", "")], _packed(terms.condition_names), "F10: conditions of registry cells.")
_case_query("registry_codes", "orders", "o_orderkey", [("Health Condition 1: C692- Malignant neoplasm of retina;Diabetes", "C692"), ("I10 - Hypertension | E11.9: Diabetes | I10 - again", "I10|E11.9"), ('{"ICD-10 Condition: k50.1"}', "K50.1"), ("Asthma", "")], _packed(terms.condition_codes), "F10, R17: codes in registry cells.")
_case_query("condition_titles", "part", "p_partkey", [("Other specified  disorders of ear", "false"), ("Asthma", "true"), ("Gout", "false"), ("Pain, Unspecified", "false"), ("Family history of asthma", "false"), ("Malignant neoplasm of breast", "true")], lambda c: text.names_condition(c).cast("string"), "P09: titles that name a condition.")


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN html LIKE 'PK%' ELSE true END AS sound FROM pages")
def file_magic(read):
    """Files that begin as their kind does."""
    pick = lambda *xs: F.element_at(F.array(*xs), (F.col("page_id") % 4 + 1).cast("int"))
    body = F.encode("html", "UTF-8")
    content = pick(F.concat(F.unhex(F.lit("25504446")), body), body, body, body)
    return read("pages").select("page_id", is_of_kind(content, pick(F.lit("PDF"), F.lit("doc"), F.lit("docx"), F.lit("html"))).alias("sound"))


@query("SELECT page_id, 'URL:' || upper(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS key, regexp_extract(url, '((?:19|20)[0-9][0-9])', 1) AS year FROM pages")
def url_keys(read):
    """namespaced keys and years from addresses."""
    return read("pages").select("page_id", F.concat(F.lit("URL:"), F.upper(F.regexp_extract("url", "^https?://([^/?#]+)", 1))).alias("key"), text.year(F.col("url")).alias("year"))


@query("SELECT doc_id, substr(sha256(doc_id || ':' || 3), 1, 32) AS chunk_id, md5(substr(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), 1, 600)) AS content, greatest(1, length(text) // 3) :: INTEGER AS tokens, CASE WHEN length(text) < 50 THEN 0 WHEN length(text) < 200 THEN 1 WHEN length(text) < 500 THEN 2 WHEN length(text) < 1000 THEN 3 WHEN length(text) < 2000 THEN 4 ELSE 5 END AS bucket FROM documents")
def document_keys(read):
    """Ids, content keys, token estimates, length buckets."""
    t = F.col("text")
    return read("documents").select("doc_id", text.chunk_id(F.col("doc_id"), F.lit(3)).alias("chunk_id"), text.content_key(t).alias("content"), text.token_estimate(t).alias("tokens"), text.length_bucket(t).alias("bucket"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ar' WHEN 1 THEN 'ja' WHEN 2 THEN 'zh' ELSE 'en' END AS language FROM documents")
def languages_by_script(read):
    """the language by the first letter of a script that tells."""
    mark = F.element_at(F.array(F.lit("اb"), F.lit("カ中"), F.lit("中カ"), F.lit("x")), (F.col("doc_id") % 4 + 1).cast("int"))
    return read("documents").select("doc_id", text.language_by_script(F.concat(mark, F.lit(" "), "text")).alias("language"))


@query("""SELECT doc_id, CAST(len(s) AS INTEGER) AS n, s[1] AS first FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, ' ' || chr(10) || chr(9) || chr(13))), lambda x: x <> '') AS s FROM documents)""")
def sentence_split(read):
    """sentences."""
    s = text.sentences(F.col("text"))
    return read("documents").select("doc_id", F.size(s).alias("n"), F.coalesce(F.get(s, 0), F.lit("")).alias("first"))


@query("SELECT event_id, list_sort([event_type, 'x', 'y'])[1:2] AS head, list_contains([event_type], 'click') AS has_click, list_has_any([event_type, 'a'], ['view', 'b']) AS overlaps, coalesce(event_type, 'none') AS label FROM events")
def array_functions(read):
    """Slices, membership, overlap."""
    t = F.col("event_type")
    return read("events").select("event_id", F.slice(F.array_sort(F.array(t, F.lit("x"), F.lit("y"))), 1, 2).alias("head"), F.array_contains(F.array(t), "click").alias("has_click"), F.arrays_overlap(F.array(t, F.lit("a")), F.array(F.lit("view"), F.lit("b"))).alias("overlaps"), F.coalesce(t, F.lit("none")).alias("label"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN [event_type] WHEN event_id % 3 = 1 THEN [event_type, 'other'] ELSE ['other'] END AS kept FROM events")
def parallel_lists(read):
    """The parts of a list whose parallel role is wanted; all where the lists differ in size."""
    drugs = F.concat(F.col("event_type"), F.lit("; other"))
    roles = F.element_at(F.array(F.lit("1;2"), F.lit("1"), F.lit("2; 1")), (F.col("event_id") % 3 + 1).cast("int"))
    return read("events").select("event_id", transforms.suspects(drugs, roles).alias("kept"))


@query("SELECT doc_id, array_to_string(string_split_regex(text, '\\s+'), ' ') AS body FROM documents WHERE text IS NOT NULL")
def text_from_inverted_index(read):
    """whole texts put together from words and their places."""
    words = read("documents").filter("text is not null").select("doc_id", F.posexplode(F.split("text", r"\s+")).alias("p", "w"))
    index = words.groupBy("doc_id", "w").agg(F.collect_list("p").alias("at")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "at"))).alias("index"))
    return index.select("doc_id", transforms.from_inverted_index(F.col("index")).alias("body"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS flag, CASE WHEN event_id % 2 = 0 THEN '' ELSE event_type END AS filled FROM events")
def strict_cells(read):
    """booleans and blanks of scraped cells."""
    raw = F.element_at(F.array(F.lit("Yes"), F.lit("n"), F.lit("maybe"), F.lit("")), (F.col("event_id") % 4 + 1).cast("int"))
    return read("events").select("event_id", transforms.strict_boolean(raw).alias("flag"), transforms.none_to_empty(F.when(F.col("event_id") % 2 == 0, " NaN ").otherwise(F.col("event_type"))).alias("filled"))


@query("SELECT url, min(page_id) AS origin, 'html' AS \"column\" FROM (SELECT page_id, unnest(regexp_extract_all(html || ' https://a.example/' || (page_id % 7) || '.pdf?x=1', '(https?://[^\\s\"''<>]+)', 1)) AS url FROM pages) WHERE regexp_matches(lower(url), '\\.(pdf|docx?|pptx?|xlsx?)([?#].*)?$') GROUP BY 1")
def linked_document_urls(read):
    """Links to documents in any column, the first place of each."""
    pages = read("pages").select("page_id", F.concat("html", F.lit(" https://a.example/"), (F.col("page_id") % 7).cast("string"), F.lit(".pdf?x=1")).alias("html"))
    return transforms.linked_documents(pages, ["html"], "page_id")
