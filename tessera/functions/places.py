"""Countries by the names that registries write, their regions, and the agencies.

Names come from the Java runtime's list of ISO 3166 countries; only what it does not
know, or writes otherwise, is listed here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import fold

#: Names that registries write besides the runtime's; the first of a code is the one that is shown.
OTHER_NAMES = {
    "BA": "Bosnia and Herzegovina", "BN": "Brunei|Brunei Darussalam", "CG": "Congo", "CI": "Cote d'Ivoire|Ivory Coast", "CV": "Cape Verde|Cabo Verde", "CZ": "Czechia|Czech Republic",
    "GB": "United Kingdom|UK|Great Britain|England|Scotland|Wales|Northern Ireland", "HK": "Hong Kong", "IR": "Iran|Iran, Islamic Republic of", "KP": "North Korea",
    "KR": "South Korea|Korea, South|Korea, Republic of|Republic of Korea|Korea", "LA": "Laos|Lao People's Democratic Republic", "MD": "Moldova|Republic of Moldova", "MK": "North Macedonia|Macedonia",
    "MM": "Myanmar|Burma", "MO": "Macao", "PS": "Palestine", "RU": "Russia|Russian Federation", "SY": "Syria|Syrian Arab Republic", "TR": "Turkey|Turkiye", "TT": "Trinidad and Tobago",
    "TZ": "Tanzania|United Republic of Tanzania", "AE": "United Arab Emirates|UAE", "US": "United States|United States of America|USA", "VN": "Vietnam|Viet Nam", "XK": "Kosovo", "EU": "European Union",
}
#: The region of each country, one only; the Gulf and its neighbours stand before the continents.
REGIONS = {
    "North America": "US CA BM GL PR",
    "Latin America": "MX GT BZ SV HN NI CR PA CU DO HT JM TT BB BS DM AW GP MQ CO VE EC PE BO BR PY UY AR CL GY SR",
    "Europe": "AL AD AT BY BE BA BG HR CY CZ DK EE FI FR DE GI GR HU IS IE IT XK LV LI LT LU MT MD MC ME NL MK NO PL PT RO RU RS SK SI ES SE CH UA GB EU TR",
    "MENA/GCC": "SA AE BH QA OM KW YE JO LB SY IQ IR IL PS EG LY TN DZ MA",
    "Sub-Saharan Africa": "AO BJ BW BF BI CM CV CF TD KM CG CI SZ ET GA GM GH GN GW KE LS LR MG MW ML MU MZ NA NE NG RW RE SN SC SL ZA SS TZ TG UG ZM ZW SO SD MR DJ",
    "Asia": "CN JP KR KP TW HK MO MN SG MY ID TH VN PH KH LA MM BN TL",
    "South Asia": "IN PK BD LK NP BT MV AF",
    "Central Asia": "KZ UZ KG TJ TM AZ AM GE",
    "Oceania": "AU NZ FJ PG NC GU",
}
#: Code, name, country and region of the agencies.
AGENCIES = [
    ("FDA", "US Food and Drug Administration", "US", "North America"),
    ("EMA", "European Medicines Agency", "EU", "Europe"),
    ("MHRA", "Medicines and Healthcare products Regulatory Agency", "GB", "Europe"),
    ("PMDA", "Pharmaceuticals and Medical Devices Agency", "JP", "Asia"),
    ("HC", "Health Canada", "CA", "North America"),
    ("SFDA", "Saudi Food and Drug Authority", "SA", "MENA/GCC"),
    ("NHRA", "National Health Regulatory Authority", "BH", "MENA/GCC"),
    ("DHA", "Dubai Health Authority", "AE", "MENA/GCC"),
    ("DOH", "Department of Health Abu Dhabi", "AE", "MENA/GCC"),
    ("MOH-OM", "Ministry of Health Oman", "OM", "MENA/GCC"),
    ("MOPH-QA", "Ministry of Public Health Qatar", "QA", "MENA/GCC"),
]


def agency_region(code: str) -> str:
    return next(region for own, _, _, region in AGENCIES if own == code)


def agencies(spark: SparkSession) -> DataFrame:
    """(code, name, country, region)."""
    return spark.createDataFrame(AGENCIES, "code string, name string, country string, region string")


def countries(spark: SparkSession) -> DataFrame:
    """(iso2, name, region, probes): each country of a region, and all its names, folded."""
    java = spark._jvm.java.util.Locale
    region = {iso: name for name, codes in REGIONS.items() for iso in codes.split()}
    own = {iso: java("", iso).getDisplayCountry(java.ENGLISH) for iso in java.getISOCountries()}
    rows = []
    for iso, area in sorted(region.items()):
        names = [*filter(None, OTHER_NAMES.get(iso, "").split("|")), *([own[iso]] if iso in own else [])]
        rows.append((iso, names[0], area, names))
    made = spark.createDataFrame(rows, "iso2 string, name string, region string, names array<string>")
    return made.select("iso2", "name", "region", F.array_distinct(F.transform("names", fold)).alias("probes"))


def named(rows: DataFrame, key: str, names: Column) -> DataFrame:
    """(key, iso2): the countries that an array of names names; each once a key."""
    known = countries(rows.sparkSession).select("iso2", F.explode("probes").alias("probe"))
    asked = rows.select(key, F.explode(names).alias("n")).select(key, fold(F.col("n")).alias("probe")).filter("probe <> ''").distinct()
    # The names of all countries: a few hundred rows.
    return asked.join(F.broadcast(known), "probe").select(key, "iso2").distinct()


def in_brackets(c: Column) -> Column:
    """The last part of each bracket: "Clinic (Phoenix, Arizona, United States)"."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\(([^()]{2,120})\)"), 1), lambda x: F.element_at(F.split(x, ","), -1))


def in_list(c: Column) -> Column:
    return F.split(F.coalesce(c, F.lit("")), "[;|,]")
