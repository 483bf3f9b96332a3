"""Reference registries as small tables. Everything here is data that a user may replace by their own.

A registry is a list of plain dicts (or a JSON file of one, see load()); the functions turn it into the
narrow tables that the operators join with.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from jobloom.functions.normalise import norm_ascii_fold, norm_unicode, norm_word, taxonomy_key

_TABLES: OrderedDict[tuple, DataFrame] = OrderedDict()


def remembered(make):
    """The same table for the same session and contents, so that operators fetch and send it once."""

    @wraps(make)
    def run(spark: SparkSession, *args: object, **more: object) -> DataFrame:
        key = (id(spark), spark.sparkContext.applicationId, make.__name__, json.dumps([args, sorted(more.items())], default=lambda x: getattr(x, "__name__", str(x)), sort_keys=True))
        if key not in _TABLES:
            _TABLES[key] = make(spark, *args, **more)
            while len(_TABLES) > 64:
                _TABLES.popitem(last=False)
        return _TABLES[key]

    return run


def small_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Rows that the driver holds as a table of known size: by its statistics Spark broadcasts it in joins while it
    is small, and shuffles it beyond spark.sql.autoBroadcastJoinThreshold."""
    struct = StructType.fromDDL(schema)
    held = pa.Table.from_pylist([dict(zip(struct.names, row, strict=True)) for row in rows], schema=to_arrow_schema(struct))
    return spark.createDataFrame(held, struct)


COUNTRIES = [
    {"iso2": "KE", "iso3": "KEN", "name": "Kenya", "region": "East Africa", "is_african": True, "aliases": ["Quenia", "كينيا"], "nationality_terms": ["kenyan", "kenyans"],
     "cities": [{"name": "Nairobi", "aliases": [], "lat": -1.2921, "lon": 36.8219}, {"name": "Mombasa", "aliases": [], "lat": -4.0435, "lon": 39.6682}], "admin_areas": [{"name": "Turkana County", "aliases": ["Turkana"]}]},
    {"iso2": "NG", "iso3": "NGA", "name": "Nigeria", "region": "West Africa", "is_african": True, "aliases": ["Nigéria"], "nationality_terms": ["nigerian", "nigerians"],
     "cities": [{"name": "Lagos", "aliases": [], "lat": 6.5244, "lon": 3.3792}, {"name": "Abuja", "aliases": [], "lat": 9.0765, "lon": 7.3986}], "admin_areas": [{"name": "Borno State", "aliases": ["Borno"]}]},
    {"iso2": "ZA", "iso3": "ZAF", "name": "South Africa", "region": "Southern Africa", "is_african": True, "aliases": ["RSA", "Afrique du Sud"], "nationality_terms": ["south african", "south africans"],
     "cities": [{"name": "Johannesburg", "aliases": ["Joburg"], "lat": -26.2041, "lon": 28.0473}, {"name": "Cape Town", "aliases": ["Le Cap"], "lat": -33.9249, "lon": 18.4241}], "admin_areas": [{"name": "Gauteng", "aliases": []}]},
    {"iso2": "SN", "iso3": "SEN", "name": "Senegal", "region": "West Africa", "is_african": True, "aliases": ["Sénégal"], "nationality_terms": ["senegalese"],
     "cities": [{"name": "Dakar", "aliases": [], "lat": 14.7167, "lon": -17.4677}], "admin_areas": []},
    {"iso2": "TZ", "iso3": "TZA", "name": "Tanzania", "region": "East Africa", "is_african": True, "aliases": ["Tanzanie"], "nationality_terms": ["tanzanian", "tanzanians"],
     "cities": [{"name": "Dar es Salaam", "aliases": ["Dar-es-Salaam"], "lat": -6.7924, "lon": 39.2083}, {"name": "Arusha", "aliases": [], "lat": -3.3869, "lon": 36.683}], "admin_areas": []},
    {"iso2": "EG", "iso3": "EGY", "name": "Egypt", "region": "North Africa", "is_african": True, "aliases": ["Égypte", "مصر"], "nationality_terms": ["egyptian", "egyptians"],
     "cities": [{"name": "Cairo", "aliases": ["Le Caire", "القاهرة"], "lat": 30.0444, "lon": 31.2357}], "admin_areas": []},
    {"iso2": "GB", "iso3": "GBR", "name": "United Kingdom", "region": "Non-Africa", "is_african": False, "aliases": ["Great Britain", "England"], "nationality_terms": ["british"], "cities": [], "admin_areas": []},
    {"iso2": "US", "iso3": "USA", "name": "United States", "region": "Non-Africa", "is_african": False, "aliases": ["United States of America"], "nationality_terms": ["american citizen"], "cities": [], "admin_areas": []},
    {"iso2": "UZ", "iso3": "UZB", "name": "Uzbekistan", "region": "Non-Africa", "is_african": False, "aliases": [], "nationality_terms": ["uzbek"], "cities": [], "admin_areas": []},
    {"iso2": "DE", "iso3": "DEU", "name": "Germany", "region": "Non-Africa", "is_african": False, "aliases": ["Deutschland"], "nationality_terms": ["german"], "cities": [], "admin_areas": []},
]
REGIONS = {
    "East Africa": ["Afrika Mashariki", "Afrique de l'Est"], "West Africa": ["Afrika Magharibi", "Afrique de l'Ouest"], "Central Africa": ["Afrique centrale"],
    "Southern Africa": ["Afrique australe"], "North Africa": ["Afrique du Nord"], "Sub-Saharan Africa": ["Sub Saharan Africa"], "Africa": ["Pan-African", "Afrique"],
}
ORGANISATIONS = [
    {"id": "harbour-fund", "name": "Harbour Growth Fund", "aliases": ["HGF"], "type": "private_equity", "source_pack": "dfi", "verified": True, "sector": None, "priority": True, "cities": []},
    {"id": "river-bank", "name": "River Development Bank", "aliases": ["RDB"], "type": "development_bank", "source_pack": "dfi", "verified": True, "sector": None, "priority": True, "cities": []},
    {"id": "open-relief", "name": "Open Relief", "aliases": ["Secours Ouvert"], "type": "ngo", "source_pack": "ngo", "verified": True, "sector": None, "priority": True, "cities": []},
    {"id": "children-agency", "name": "World Children Agency", "aliases": ["WCA"], "type": "un_agency", "source_pack": "ngo", "verified": True, "sector": None, "priority": False, "cities": []},
    {"id": "water-ministry", "name": "Ministry of Water", "aliases": [], "type": "government", "source_pack": "government", "verified": True, "sector": None, "priority": False, "cities": []},
    {"id": "lake-university", "name": "Lake University", "aliases": [], "type": "university", "source_pack": "public_institution", "verified": True, "sector": "education", "priority": False, "cities": []},
    {"id": "sky-telecom", "name": "Sky Telecom", "aliases": ["SkyTel"], "type": "multinational", "source_pack": "multinational", "verified": True, "sector": "telecom", "priority": True, "cities": ["Nairobi", "Lagos"]},
    {"id": "plain-foods", "name": "Plain Foods", "aliases": [], "type": "company", "source_pack": None, "verified": False, "sector": None, "priority": False, "cities": []},
]
SOURCES = [
    {"id": "boards", "name": "Hosted Boards", "domain": "boards.example.com", "kind": "employer_ats", "confidence": "official"},
    {"id": "relief", "name": "Relief Jobs", "domain": "relief.example.org", "kind": "institutional_aggregator", "confidence": "aggregated"},
    {"id": "market", "name": "Job Market", "domain": "example.net", "kind": "commercial_aggregator", "confidence": "aggregated"},
    {"id": "gazette", "name": "Public Gazette", "domain": "gazette.example.gov", "kind": "government_official", "confidence": "official"},
    {"id": "platform", "name": "Employer boards", "domain": None, "kind": "employer_ats", "confidence": "official"},
]
PLATFORM_DOMAINS = {"ats.example.io": "platform"}
TAXONOMY = {
    "industries": [("technology", "Technology", ["IT", "Software & Data"]), ("financial_services", "Financial Services", ["Banking"]), ("development_humanitarian", "Development", ["NGO sector"]), ("public_sector", "Public Sector", ["Government"])],
    "specialisations": [("data_analysis", "Data Analysis", "technology", ["Analytics"]), ("software_engineering", "Software Engineering", "technology", ["Backend Engineering"]), ("private_equity", "Private Equity", "financial_services", ["Buyouts"]), ("monitoring_evaluation", "Monitoring & Evaluation", "development_humanitarian", ["MEL"]), ("accounting", "Accounting", "financial_services", ["Bookkeeping"])],
    "skills": [("python", "Python", []), ("excel", "Excel", ["Spreadsheets"]), ("french", "French", ["Français"])],
    "source_aliases": [("boards", "1000 eng", "software_engineering"), ("*", "deals", "private_equity"), ("boards", "legacy", "no_such_id")],
    "ignored": [("*", "other"), ("relief", "misc")],
}
ROLES = {
    "specialisation_family": {"data_analysis": "analytics", "software_engineering": "engineering", "private_equity": "investment", "monitoring_evaluation": "programmes", "accounting": "retired_family"},
    "industry_family": {"technology": "engineering", "financial_services": "finance", "public_sector": "administration"},
    "families": ["analytics", "engineering", "investment", "programmes", "finance", "administration"],
    "themes": {"technology": ["digital"], "data_analysis": ["digital", "evidence"], "private_equity": ["capital"], "monitoring_evaluation": ["evidence", "governance"], "development_humanitarian": ["governance"]},
}
INVESTMENT = {
    "investment_types": ["private_equity", "venture_capital", "asset_manager", "investment_firm"], "dfi_types": ["dfi", "development_bank", "multilateral"], "finance_types": ["bank", "insurer"],
    "absolute_negatives": ["fund accountant", "payroll"], "hard_negatives": ["accountant", "human resources", "driver"], "support_titles": ["office manager", "procurement officer"], "generic_titles": ["investment officer", "investment manager"],
    "fallback_track": "investment_analysis", "non_investment_specialisations": ["accounting"],
    "tracks": [
        {"id": "private_equity", "classification": "core_investment", "canonical": "private_equity", "title": ["private equity", "private equity associate", "buyout"], "context": ["portfolio company", "deal execution"]},
        {"id": "venture_capital", "classification": "core_investment", "canonical": "venture_capital", "title": ["venture capital", "venture partner"], "context": ["seed stage", "startup portfolio"]},
        {"id": "investment_analysis", "classification": "core_investment", "canonical": "investment_analysis", "title": ["investment analyst", "equity analyst"], "context": ["financial modelling", "due diligence"]},
        {"id": "project_finance", "classification": "adjacent_finance", "canonical": "project_finance", "title": ["project finance"], "context": ["infrastructure lending"]},
    ],
}
NGO = {
    "ngo_types": ["ngo", "un_agency", "multilateral", "foundation", "consulting_firm"],
    "groups": {"un_agency": "un_agency", "multilateral": "regional_or_multilateral", "foundation": "foundation", "consulting_firm": "development_implementer", "ngo": "ngo"},
    "negatives": ["driver", "software engineer", "accountant"], "support_titles": ["office manager", "hr officer"],
    "tracks": [
        {"id": "monitoring_evaluation", "classification": "technical_programme", "canonical": "monitoring_evaluation", "title": ["monitoring and evaluation", "mel adviser"], "context": ["logframe", "impact evaluation"]},
        {"id": "humanitarian_response", "classification": "humanitarian_programme", "canonical": "humanitarian_response", "title": ["emergency coordinator", "humanitarian officer"], "context": ["emergency response", "displaced"]},
        {"id": "child_protection", "classification": "technical_programme", "canonical": "child_protection", "title": ["child protection", "child protection officer"], "context": ["safe spaces"]},
    ],
}
#: Units of a currency for one US dollar.
UNITS_PER_USD = {"KES": 129.0, "NGN": 1500.0, "EUR": 0.9, "GBP": 0.8, "ZAR": 18.0, "BAD": 0.0}


def load(path: str) -> dict | list:
    """A registry from a JSON file."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _ranked(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return small_table(spark, [(*row, i) for i, row in enumerate(rows)], f"{schema}, rank int")


@remembered
def location_terms(spark: SparkSession, countries: list[dict] = COUNTRIES, regions: dict[str, list[str]] = REGIONS) -> DataFrame:
    """(kind, term, alias, iso2, canonical, lat, lon, rank) of African places: country, city, admin and region terms."""
    rows: list[tuple] = []
    for c in countries:
        if not c["is_african"]:
            continue
        rows += [("country", a, c["iso2"], c["name"], None, None) for a in (c["name"], *c["aliases"])]
        rows += [("city", a, c["iso2"], x["name"], x.get("lat"), x.get("lon")) for x in c["cities"] for a in (x["name"], *x["aliases"])]
        rows += [("admin", a, c["iso2"], x["name"], None, None) for x in c["admin_areas"] for a in (x["name"], *x["aliases"])]
    rows += [("region", a, None, r, None, None) for r, aliases in regions.items() for a in (r, *aliases)]
    made = _ranked(spark, rows, "kind string, alias string, iso2 string, canonical string, lat double, lon double").withColumn("term", norm_unicode("alias"))
    return made.where(F.length("term") >= F.when(F.col("kind") == "country", 3).when(F.col("kind") == "region", 1).otherwise(2))


@remembered
def country_table(spark: SparkSession, countries: list[dict] = COUNTRIES) -> DataFrame:
    return small_table(spark, [(c["iso2"], c["iso3"], c["name"], c["region"], c["is_african"]) for c in countries], "iso2 string, iso3 string, name string, region string, is_african boolean")


@remembered
def country_terms(spark: SparkSession, countries: list[dict] = COUNTRIES) -> DataFrame:
    """(kind, term, iso2, rank) of all countries: names with aliases, and nationality terms."""
    rows = [("country", a, c["iso2"]) for c in countries for a in (c["name"], *c["aliases"])]
    rows += [("nationality", a, c["iso2"]) for c in countries for a in c["nationality_terms"]]
    return _ranked(spark, rows, "kind string, alias string, iso2 string").withColumn("term", norm_unicode("alias")).where("length(term) >= 4")


@remembered
def organisation_names(spark: SparkSession, organisations: list[dict] = ORGANISATIONS) -> DataFrame:
    """One row for each name or alias; of equal names the last organisation counts."""
    rows = [(n, o["id"], o["type"], o["source_pack"], o["verified"], o["sector"], o["priority"], o["cities"]) for o in organisations for n in (o["name"], *o["aliases"])]
    made = _ranked(spark, rows, "raw_name string, org_id string, org_type string, source_pack string, org_verified boolean, sector string, priority boolean, cities array<string>")
    named = made.withColumn("name_key", norm_ascii_fold("raw_name")).where("name_key != ''")
    last = named.groupBy("name_key").agg(F.max_by(F.struct(*[c for c in named.columns if c not in ("name_key", "raw_name", "rank")]), "rank").alias("o"))
    return last.select("name_key", "o.*")


@remembered
def source_table(spark: SparkSession, sources: list[dict] = SOURCES) -> DataFrame:
    rows = [(s["id"], s["name"], s["domain"], s["kind"], s["confidence"]) for s in sources]
    return _ranked(spark, rows, "source_id string, source_name string, domain string, source_kind string, source_confidence string")


@remembered
def alias_table(spark: SparkSession, kind: str, taxonomy: dict = TAXONOMY) -> DataFrame:
    """(key, target): every id, label and alias of industries, specialisations or skills."""
    rows = [(k, e[0]) for e in taxonomy[kind] for k in (e[0], e[1], *e[-1])]
    return small_table(spark, rows, "raw string, target string").select(taxonomy_key("raw").alias("key"), "target").distinct()


def vocabularies(organisations: list[dict] = ORGANISATIONS, taxonomy: dict = TAXONOMY, tracks: list[dict] = [*INVESTMENT["tracks"], *NGO["tracks"]]) -> dict[str, list[str]]:  # noqa: B006
    """What registries add to the vocabularies of row_rules()."""
    given = lambda field: sorted({o[field] for o in organisations if o[field] is not None})
    canonical = {s[0] for s in taxonomy["specialisations"]} | {t["canonical"] for t in tracks}
    return {"organisation_type": given("type"), "sector": given("sector"), "category": given("sector"), "specialisation": sorted(canonical)}


@remembered
def track_phrases(spark: SparkSession, taxonomy: dict, normaliser=norm_word) -> DataFrame:
    """(track, track_ord, classification, canonical, kind, phrase, ord) of title and context phrases."""
    rows = [(t["id"], i, t["classification"], t["canonical"], kind, p, j) for i, t in enumerate(taxonomy["tracks"]) for kind in ("title", "context") for j, p in enumerate(t[kind])]
    made = small_table(spark, rows, "track string, track_ord int, classification string, canonical string, kind string, raw string, ord int")
    return made.withColumn("phrase", normaliser("raw")).where("phrase != ''").drop("raw")


@remembered
def track_table(spark: SparkSession, taxonomy: dict) -> DataFrame:
    return small_table(spark, [(t["id"], i, t["classification"], t["canonical"]) for i, t in enumerate(taxonomy["tracks"])], "track string, track_ord int, classification string, canonical string")


@remembered
def map_table(spark: SparkSession, mapping: dict, key: str, value: str) -> DataFrame:
    return small_table(spark, [(k, v) for k, v in mapping.items()], f"{key} string, {value} {'array<string>' if isinstance(next(iter(mapping.values())), list) else 'string'}")


def fx_rates(spark: SparkSession, units_per_usd: dict[str, float] = UNITS_PER_USD) -> DataFrame:
    """US dollars for one unit, 8 decimals; rates that aren't positive are dropped, USD is 1."""
    given = small_table(spark, list(units_per_usd.items()), "currency string, units double")
    usd = small_table(spark, [("USD", 1.0)], "currency string, usd_per_unit double")
    return given.where("units > 0 and currency != 'USD'").select("currency", F.round(1 / F.col("units"), 8).alias("usd_per_unit")).union(usd)
