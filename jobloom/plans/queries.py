"""Registered queries over the given tables, and the SQL that states their results independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import registries as R
from jobloom.functions import extract as X
from jobloom.functions import normalise as N
from jobloom.operators import classify as C
from jobloom.operators import dedup as D
from jobloom.operators import matching as M
from jobloom.operators import predicates as P
from jobloom.operators import quality as V
from jobloom.operators import reports as A
from jobloom.operators import search as S
from jobloom.operators import snapshot as U
from jobloom.operators.lexicon import once
from jobloom.plans.cases import Case, joined
from jobloom.sources import landed as L
from jobloom.sources import pages as H
from jobloom.streaming import jobs as T

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        FOUND[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def case(name: str, inputs: dict[str, list], expected: dict[str, tuple[str, list]], run: Callable[[DataFrame], DataFrame], **vary: str) -> None:
    one = Case(inputs, expected, run, vary)
    FOUND[name], SQL[name] = one.query(), one.sql()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ text normalisers
_RAW = ["Café  Ltd.", "السلام عليكم", "Straße &amp; Co", "snake_case NAME", "Ünïcode—dash Inc", None, "plain"]
case("norm_unicode", {"t": _RAW}, {"o": ("string", ["café ltd", "السلام عليكم", "strasse amp co", "snake case name", "ünïcode dash inc", "", "plain"])}, lambda d: d.withColumn("o", N.norm_unicode("t")))
case("norm_ascii_fold", {"t": _RAW}, {"o": ("string", ["cafe ltd", "", "stra e amp co", "snake case name", "unicode dash inc", "", "plain"])}, lambda d: d.withColumn("o", N.norm_ascii_fold("t")))
case("norm_word", {"t": _RAW}, {"o": ("string", ["cafe ltd", "السلام عليكم", "strasse co", "snake_case name", "unicode dash inc", "", "plain"])}, lambda d: d.withColumn("o", N.norm_word("t")))
case("norm_ngo", {"t": _RAW}, {"o": ("string", ["cafe ltd", "", "strasse amp co", "snake case name", "unicode dash inc", "", "plain"])}, lambda d: d.withColumn("o", N.norm_ngo("t")))
case("norm_dedup", {"t": _RAW}, {"o": ("string", ["caf", "", "strasse amp", "snake case name", "n code dash", "", "plain"])}, lambda d: d.withColumn("o", N.norm_dedup("t")))
case("taxonomy_key", {"t": _RAW}, {"o": ("string", ["café ltd.", "السلام عليكم", "strasse & co", "snake_case name", "ünïcode—dash inc", "", "plain"])}, lambda d: d.withColumn("o", N.taxonomy_key("t")))

# ------------------------------------------------------------------ F: extraction
case(
    "f2_years_experience",
    {"t": ["5 to 8 years of experience", "at least 3 years and 10+ years", "Au moins 4 ans d'expérience", "mínimo de 6 anos", "خبرة لا تقل عن ٣ سنوات", "angalau miaka 2", "99 years experience", None, "3-5 years, minimum 2 years"]},
    {"years_min": ("int", [5, 3, 4, 6, 3, 2, None, None, 2]), "years_max": ("int", [8, None, None, None, None, None, None, None, 5]), "languages": ("string", ["en", "en", "fr", "pt", "ar", "sw", "en", "", "en"])},
    lambda d: d.withColumn("y", X.years_experience("t")).withColumns({"years_min": F.col("y.years_min"), "years_max": F.col("y.years_max"), "languages": joined("y.languages")}),
)
case(
    "f3_education",
    {"t": ["Master's degree in Economics, or MBA", "PhD required", "BSc in Computer Science required", "Diploma in Nursing; experience", "no school named", None]},
    {"level": ("string", ["masters", "phd", "bachelor", "diploma", None, None]), "fields": ("string", ["economics", "", "", "nursing", "", ""])},
    lambda d: d.withColumn("e", X.education("t")).withColumns({"level": F.col("e.level"), "fields": joined("e.fields")}),
)
case(
    "f4_languages_required",
    {"t": ["Fluent in French and English", "French government funded, no language required", "Kiswahili required", "Arabic an asset", "maîtrise du français obligatoire", None, "works with the French embassy daily"]},
    {"o": ("string", ["english|french", "", "swahili", "", "french", "", ""])},
    lambda d: d.withColumn("o", joined(X.languages_required("t"))),
)
case(
    "f5_contract_type",
    {"a": ["Volunteer nurse", "Engineer", "Consultant", "Juriste", "Advogado", "Mhasibu", None], "b": ["full-time", "12 month contract", "permanent", "CDI à Dakar", "contrato a termo", "mkataba wa muda maalum", None]},
    {"o": ("string", ["volunteer", "fixed_term", "consultant", "permanent", "fixed_term", "fixed_term", "unknown"]), "language": ("string", ["en", "en", "en", "fr", "pt", "sw", None])},
    lambda d: once(d, {"c": X.contract_type_with_language("a", "b")}).withColumns({"o": F.col("c.contract_type"), "language": F.col("c.language")}),
    a="word", b="word",
)
case(
    "f6_deadline",
    {"t": ["Closing date: 2026-08-31", "deadline 05/09/2026", "Date limite : 12 août 2026", "prazo 31/02/2026", "mwisho wa kutuma 3 Machi 2026", "no date", None, "Deadline: 31.02.2026 or deadline 01.03.26"]},
    {"o": ("timestamp", ["2026-08-31 23:59:59", "2026-09-05 23:59:59", "2026-08-12 23:59:59", None, "2026-03-03 23:59:59", None, None, "2026-03-01 23:59:59"])},
    lambda d: d.withColumn("o", X.deadline("t", 2026)),
)
case(
    "f7_eligibility_signals",
    {"t": ["Internal candidates only", "local hire", "must be a Kenyan citizen", "valid work permit needed", "international applicants welcome", "candidats internes uniquement", None]},
    {"o": ("string", ["internal_only", "local_only", "citizenship", "work_auth", "international", "internal_only", ""])},
    lambda d: d.withColumn("s", X.eligibility_signals("t")).withColumn("o", F.array_join(F.array_compact(F.array(*(F.when(F.col(f"s.{k}"), F.lit(k)) for k in X.ELIGIBILITY_SIGNALS))), "|")),
)
case("f8_detect_language", {"t": ["عقد عمل", "O candidato deve", "date limite demain", "mwisho wa kutuma kesho", "hello", None]}, {"o": ("string", ["ar", "pt", "fr", "sw", "en", "en"])}, lambda d: d.withColumn("o", X.detect_language("t", N.norm_unicode("t"))))
case("f9_seniority", {"t": ["Head of Finance", "Graduate Trainee Manager", "Senior Engineer", "Engineer", None, "VP Sales", "Associate Director"]}, {"o": ("string", ["leadership", "entry", "senior", None, None, "leadership", "entry"])}, lambda d: d.withColumn("o", X.seniority("t")))
case(
    "f10_work_mode",
    {"r": ["Remote - Kenya", "Remote", "Hybrid / remote Lagos", "Nairobi", "Remote West Africa", None], "h": [None, None, None, "On-site", None, "remote"], "c": ["KE", None, "NG", "KE", None, None], "g": [None, None, None, None, "West Africa", None]},
    {"o": ("string", ["remote_kenya", "remote_global", "hybrid", "onsite", "remote_regional", "remote_global"])},
    lambda d: d.withColumn("o", X.work_mode("r", N.norm_unicode("h"), "c", "g")),
)
case(
    "f13_timestamp",
    {"t": ["2026-07-06T07:30:06Z", "2026-07-06 07:30:06 UTC", "2026-07-06", "1783323006", "1783323006000", "Mon, 06 Jul 2026 07:30:06 GMT", "20260706", "never", None, "2026-07-06T10:30:06+03:00"]},
    {"o": ("timestamp", ["2026-07-06 07:30:06", "2026-07-06 07:30:06", "2026-07-06 00:00:00", "2026-07-06 07:30:06", "2026-07-06 07:30:06", "2026-07-06 07:30:06", "1970-08-23 11:58:26", None, None, "2026-07-06 07:30:06"])},
    lambda d: d.withColumn("o", X.timestamp("t")),
)
case("f17_first_integer", {"t": ["12 posts", "1,200 units", "none", None, "no. 7 of 9"]}, {"o": ("int", [12, 1200, None, None, 7])}, lambda d: d.withColumn("o", X.first_integer("t")))
case("f17_day_month_year", {"t": ["closes 31-12-2026", "1/2/2026", "2026", None]}, {"o": ("timestamp", ["2026-12-31 23:59:59", "2026-02-01 23:59:59", None, None])}, lambda d: d.withColumn("o", X.day_month_year("t")))
case("f19_opportunity_type", {"t": ["Summer Internship", "Research Fellow", "Tax Consultant", "Volunteer", "Clerk", None]}, {"o": ("string", ["internship", "fellowship", "job", "job", "job", "job"])}, lambda d: d.withColumn("o", X.opportunity_type("t")))
case("a20_industry", {"a": ["Backend developer", "Nurse", "Clerk", None, "Ongoing programme officer"], "b": ["python", "clinical work", "nothing", None, "livelihoods"]}, {"o": ("string", ["technology", "healthcare", None, None, "development_humanitarian"])}, lambda d: d.withColumn("o", X.industry("a", "b")))
case(
    "p6_p7_sponsorship",
    {"t": ["We will sponsor this role", "visa sponsorship available", "no visa sponsorship", None, "relocation support for the successful candidate"]},
    {"offers": ("boolean", [True, True, False, False, True]), "for_role": ("boolean", [True, False, False, False, True])},
    lambda d: d.withColumns({"offers": X.sponsorship("t"), "for_role": X.role_mobility("t")}),
)
case("p10_valid_title", {"t": ["Careers", "Data Analyst", "abc", "Plain Foods", None, "Work with us", "Driver"], "g": ["Plain Foods"] * 7}, {"o": ("boolean", [False, True, False, False, False, False, True])}, lambda d: d.withColumn("o", H.valid_title("t", "g")))
case("p11_choose_title", {"a": ["Analyst", "Careers", "Driver", None], "b": ["Analyst, Lagos office", "Data Clerk", "Jobs", "Careers"]}, {"o": ("string", ["Analyst, Lagos office", "Data Clerk", "Driver", None])}, lambda d: d.withColumn("o", H.choose_title("a", "b")))
case("p18_foreign_iso_token", {"t": ["Tashkent, UZ", "Nairobi, KE", "London, UK", None, "no codes"]}, {"o": ("boolean", [True, False, False, False, False])}, lambda d: d.withColumn("o", F.coalesce(P.foreign_iso_token("t", ["KE", "NG", "ZA", "SN", "TZ", "EG"]), F.lit(False))))

case(
    "f14_mixed_values",
    {"j": ['{"name":"A","label":"B"}', '{"id":7,"tags":["x",{"title":"Y &amp; Z"},"X"]}', '[true,1.5,null," a  b "]', '{"name":"","slug":"s","more":{"description":"d","name":["n","D"]}}', '"plain"', None, "[]", '{"value":{"text":"deep"},"name":null}']},
    {"o": ("string", ["A|B", "7|x|Y & Z", "True|1.5|a  b", "s|n|D", "plain", "", "", "deep"])},
    lambda d: d.withColumn("o", joined(L.mixed_terms("j"))),
)

# ------------------------------------------------------------------ J: matching
case(
    "j1_match_organisations",
    {"org_name": ["Harbour Growth Fund", "HGF Careers", "river development bank LTD", "Nobody", None, "Secours Ouvert"]},
    {"org_id": ("string", ["harbour-fund", "harbour-fund", "river-bank", None, None, "open-relief"]), "org_type": ("string", ["private_equity", "private_equity", "development_bank", None, None, "ngo"])},
    lambda d: M.match_organisations(d, R.organisation_names(d.sparkSession)),
    org_name="digits",
)
case(
    "j2_match_sources",
    {"source_url": ["https://x.boards.example.com/1", "https://shop.example.net", "https://nowhere.test", "https://acme.ats.example.io", None, "https://nowhere.test"], "source_label": [None, None, "Relief Jobs", None, None, "?"]},
    {"source_id": ("string", ["boards", "market", "relief", "platform", None, None])},
    lambda d: M.match_sources(d, R.source_table(d.sparkSession), R.PLATFORM_DOMAINS),
    source_url="path",
)
case("j3_map_industry", {"raw": ["IT", "Software &amp; Data", "banking", "unknown", None]}, {"industry": ("string", ["technology", "technology", "financial_services", None, None])}, lambda d: M.map_alias(d, R.alias_table(d.sparkSession, "industries"), "raw", "industry"))


def _taxonomy(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        R.alias_table(spark, "specialisations"),
        R.small_table(spark, R.TAXONOMY["source_aliases"], "source_key string, key string, target string"),
        R.small_table(spark, R.TAXONOMY["ignored"], "source_key string, key string"),
    )


_TERMS = [["Analytics", "MEL", "analytics"], ["1000 Eng", "other"], ["deals"], ["legacy", "Bookkeeping"], [], None, ["misc", "nonsense"]]
_FROM = ["boards", "boards", "relief", "boards", "boards", "boards", "relief"]
case("j4_map_specialisations", {"raw": _TERMS, "src": _FROM}, {"o": ("string", ["data_analysis|monitoring_evaluation", "software_engineering", "private_equity", "accounting", "", "", ""])}, lambda d: M.map_specialisations(d, *_taxonomy(d.sparkSession), "raw", "src").withColumn("o", joined("specialisations")), raw="element")
case("j5_map_skills", {"raw": [["Python", "Spreadsheets", "excel"], ["français"], ["?"], None]}, {"o": ("string", ["python|excel", "french", "", ""])}, lambda d: M.map_skills(d, R.alias_table(d.sparkSession, "skills"), "raw").withColumn("o", joined("skills")), raw="element")
case(
    "j7_first_parent",
    {"terms": [["data_analysis", "private_equity"], ["nothing", "accounting"], [], None]},
    {"parent": ("string", ["technology", "financial_services", None, None])},
    lambda d: M.first_parent(d, R.small_table(d.sparkSession, [(s[0], s[2]) for s in R.TAXONOMY["specialisations"]], "term string, parent string"), "terms", "parent"),
    terms="element",
)
case(
    "j8_infer_specialisations",
    {"a": ["Analytics lead", "Private Equity and analytics", "MEL", "Accountant", None], "b": ["backend engineering team", None, "bookkeeping office", "data analysis", None]},
    {"o": ("string", ["data_analysis|software_engineering", "private_equity|data_analysis", "accounting", "data_analysis", ""])},
    lambda d: M.infer_specialisations(d, R.alias_table(d.sparkSession, "specialisations"), "a", "b", "inferred").withColumn("o", joined("inferred")),
    a="word", b="word",
)
case(
    "j9_role_family",
    {"specialisations": [["data_analysis"], ["accounting"], [], ["no_such"], None], "industry": ["technology", "financial_services", "public_sector", None, "technology"]},
    {"role_family": ("string", ["analytics", None, "administration", None, "engineering"]), "role_subfamily": ("string", ["data_analysis", "accounting", None, "no_such", None])},
    lambda d: M.role_family(d, R.map_table(d.sparkSession, R.ROLES["specialisation_family"], "s", "f"), R.map_table(d.sparkSession, R.ROLES["industry_family"], "i", "f"), R.ROLES["families"]),
)
case(
    "j10_thematic_sectors",
    {"specialisations": [["data_analysis", "monitoring_evaluation"], ["private_equity"], [], None], "industry": ["technology", "none", "development_humanitarian", None]},
    {"o": ("string", ["digital|evidence|governance", "capital", "governance", ""])},
    lambda d: M.thematic_sectors(d, R.map_table(d.sparkSession, R.ROLES["themes"], "key", "themes")).withColumn("o", joined("thematic_sectors")),
    specialisations="element",
)
case("j11_confidence_for_domain", {"dom": ["example.net", "gazette.example.gov", "other.test", None]}, {"domain_confidence": ("string", ["aggregated", "official", "unverified", "unverified"])}, lambda d: M.confidence_for_domain(d, R.source_table(d.sparkSession), "dom"))
_PLACES = ["Nairobi, Kenya", "Lagos", "Turkana County", "West Africa", "Tashkent, UZ", "Cape Town, ZA", None, "القاهرة", "Johannesburg or Dakar", "Berlin"]
case(
    "j12_resolve_locations",
    {"location_raw": _PLACES, "location_country": [None] * 10},
    {
        "code": ("string", ["KE", "NG", "KE", None, None, "ZA", None, "EG", "ZA", None]),  # of two cities the longer name counts
        "city": ("string", ["Nairobi", "Lagos", None, None, None, "Cape Town", None, "Cairo", "Johannesburg", None]),
        "confidence": ("double", [1.0, 0.96, 0.86, 0.68, 0.0, 1.0, 0.0, 0.96, 0.96, 0.0]),
        "african": ("boolean", [True, True, True, True, False, True, False, True, True, False]),
    },
    lambda d: M.resolve_locations(d, R.location_terms(d.sparkSession), R.country_table(d.sparkSession)).withColumns({"code": F.col("loc.country_code"), "city": F.col("loc.city"), "confidence": F.col("loc.confidence"), "african": F.col("loc.is_african")}),
    location_raw="word",
)
case(
    "j13_global_country",
    {"raw": ["Tashkent, UZ", "Great Britain", "near Kenya", None, "none"], "code": [None, None, None, "DEU", None], "known": [None, None, None, None, "united states"]},
    {"o": ("string", ["UZ", "GB", "KE", "DE", "US"])},
    lambda d: M.global_country(d, R.country_terms(d.sparkSession), R.country_table(d.sparkSession), "raw", "code", "known").withColumn("o", F.col("world.iso2")),
    raw="word",
)
case("j14_nationality_codes", {"t": ["Kenyan or British nationals in Germany", "none", None, "South African citizens"]}, {"o": ("string", ["GB|KE|DE", "", "", "ZA"])}, lambda d: M.nationality_codes(d, R.country_terms(d.sparkSession), "t").withColumn("o", joined("nationalities")), t="word")
case(
    "j15_salaries_to_usd",
    {"lo": [1000.0, 50.0, 10.0, 1.0, None], "hi": [2000.0, None, 20.0, 2.0, None], "cur": ["EUR", "usd", "GBP", "XXX", "EUR"], "per": ["month", "hour", "day", "year", "year"]},
    {"salary_usd_min": ("double", [13333.33, 104000.0, 3250.0, None, None]), "salary_usd_max": ("double", [26666.67, None, 6500.0, None, None])},
    lambda d: M.salaries_to_usd(d, R.fx_rates(d.sparkSession), "lo", "hi", "cur", "per"),
)

# ------------------------------------------------------------------ C: classification
case(
    "c1_investment_profile",
    {
        "title": ["Private Equity Associate", "Fund Accountant, private equity", "Office Manager", "Investment Officer", "Analyst", "Driver", "Clerk"],
        "body": [None, None, None, None, "deal execution and portfolio company work", None, "seed stage"],
        "specialisations": [[], [], [], [], [], [], ["accounting"]],
        "org_type": ["private_equity", "private_equity", "development_bank", "company", "private_equity", "company", None],
    },
    {
        "classification": ("string", ["core_investment", "institutional_support", "institutional_support", "core_investment", "core_investment", "not_investment", "not_investment"]),
        "track": ("string", ["private_equity", None, None, "investment_analysis", "private_equity", None, None]),
        "confidence": ("double", [0.98, 0.88, 0.88, 0.82, 0.72, 0.92, 0.78]),  # "accountant" is a hard negative too
        "dfi": ("string", ["adjacent_experience", "none", "institutional_role", "adjacent_experience", "adjacent_experience", "none", "none"]),
    },
    lambda d: C.investment_profile(d, R.INVESTMENT).withColumns({"classification": F.col("investment_profile.classification"), "track": F.col("investment_profile.track"), "confidence": F.col("investment_profile.confidence"), "dfi": F.col("investment_profile.dfi_relevance")}),
    title="word", body="word",
)
case(
    "c2_ngo_profile",
    {
        "title": ["Child Protection Officer", "Software Engineer", "MEL Adviser", "Clerk", "Driver, emergency response"], "summary": [None, None, None, "emergency response for displaced people", None],
        "role_subfamily": [None] * 5, "industry": [None] * 5, "specialisations": [[], [], [], ["humanitarian_response"], []], "org_type": ["ngo", "un_agency", "company", "company", "ngo"],
    },
    {
        "classification": ("string", ["technical_programme", "institutional_support", "technical_programme", "humanitarian_programme", "institutional_support"]),
        "track": ("string", ["child_protection", None, "monitoring_evaluation", "humanitarian_response", None]),
        "confidence": ("double", [0.99, 0.82, 0.96, 0.99, 0.82]),
        "grp": ("string", ["ngo", "un_agency", "other", "other", "ngo"]),
    },
    lambda d: C.ngo_profile(d, R.NGO).withColumns({"classification": F.col("ngo_profile.classification"), "track": F.col("ngo_profile.track"), "confidence": F.col("ngo_profile.confidence"), "grp": F.col("ngo_profile.organisation_group")}),
    title="word", summary="word",
)
_ACCESS_IN = {
    "title": ["Nurse", "Advisor, Africa programme", "Clerk", "Remote engineer open to all African countries", "Regional lead for East Africa", "Remote worldwide role", "Engineer", "Cook"],
    "summary": ["national position", None, None, None, "international applicants are welcome", "internal candidates only", "must have valid work permit", "local hire"],
    "eligibility_notes": [None] * 8, "location_raw": ["Nairobi, Kenya", "London, UK, United Kingdom", "Tashkent, UZ", None, None, None, None, None], "location_scope": [None] * 8, "work_mode": [None] * 8,
    "location_country": [None] * 8, "is_remote_from_kenya": [False] * 8, "apply_is_official": [False, False, False, False, False, False, True, False], "apply_url": ["https://a.test/1"] * 7 + ["-"], "source_confidence": ["aggregated"] * 8, "source_kind": ["market"] * 8,
}


def _access(d: DataFrame) -> DataFrame:
    spark = d.sparkSession
    rows = M.resolve_locations(d, R.location_terms(spark), R.country_table(spark))
    rows = C.africa_relevance(rows, R.country_terms(spark), R.country_table(spark)).drop("world")
    rows = rows.withColumn("government_profile", F.lit(None).cast("struct<citizenship_required:boolean,eligible_nationalities:array<string>,internal_only:boolean>"))
    rows = C.applicant_access(rows, R.country_terms(spark), R.country_table(spark)).withColumn("eligibility", C.eligibility_from_access())
    return rows.withColumns({"relevance": F.col("africa_relevance.status"), "access": F.col("african_applicant_access.status"), "legacy": F.col("eligibility.status"), "codes": joined("african_applicant_access.eligible_nationalities")})


case(
    "c3_c4_c5_africa_access",
    _ACCESS_IN,
    {
        "relevance": ("string", ["africa_based_confirmed", "africa_remit_non_african_location", "non_african", "remote_confirmed_open_to_africa", "africa_regional", "global_access_unconfirmed", "official_location_pending", "unresolved"]),
        "access": ("string", ["confirmed_specific_african_nationality", "unknown", "unknown", "likely_open", "confirmed_international_recruitment", "internal_only", "work_authorisation_required", "local_only"]),
        "legacy": ("string", ["citizenship_restricted", "uncertain", "uncertain", "likely_eligible", "eligible", "internal_only", "uncertain", "local_only"]),
        "codes": ("string", ["KE", "", "", "", "", "", "", ""]),
    },
    _access,
    title="word", summary="word", location_raw="word",
)
case(
    "c6_eligibility_from_text",
    {"t": ["staff only", "must be a Kenyan citizen", "local hire", "required to hold: existing work authorization", "international applicants welcome", "", "", "", ""], "rem": [False] * 5 + [True, True, False, False], "m": [None] * 5 + ["remote_kenya", "remote_global", None, None], "c": [None] * 7 + ["KE", "NG"]},
    {"o": ("string", ["internal_only", "citizenship_restricted", "local_only", "uncertain", "likely_eligible", "likely_eligible", "likely_eligible", "likely_eligible", "uncertain"]), "confidence": ("double", [0.98, 0.9, 0.9, 0.82, 0.9, 0.92, 0.78, 0.86, 0.62])},
    lambda d: d.withColumn("e", C.eligibility_from_text(F.col("t"), F.col("rem"), F.col("m"), F.col("c"))).withColumns({"o": F.col("e.status"), "confidence": F.col("e.confidence")}),
    t="word",
)
case(
    "c7_to_c10_employer_profiles",
    {"org_name": ["River Development Bank", "Ministry of Water", "Lake University", "Sky Telecom", "Nobody"]},
    {"dfi": ("boolean", [True, False, False, False, False]), "public": ("boolean", [False, True, True, False, False]), "institution": ("boolean", [False, False, True, False, False]), "multi": ("boolean", [False, False, False, True, False]), "footprint": ("string", ["", "", "", "Nairobi|Lagos", ""])},
    lambda d: _profiles(d),
    org_name="digits",
)


def _profiles(d: DataFrame) -> DataFrame:
    rows = M.match_organisations(d, R.organisation_names(d.sparkSession))
    fields = "struct<advert_reference:string,public_service_grade:string,salary_scale:string,number_of_positions:int,citizenship_required:boolean,application_method:string,application_form_url:string,county_or_region_requirement:string,source_document_url:string,eligible_nationalities:array<string>,internal_only:boolean"
    rows = rows.withColumn("government_fields", F.lit(None).cast(fields + ">")).withColumn("government_profile", F.lit(None).cast(fields + ",is_government_or_public_service:boolean>"))
    rows = rows.withColumns({"a": C.institution_profile(F.col("org_type")), "b": C.government_profile(), "c": C.public_institution_profile(), "m": C.multinational_profile()})
    return rows.withColumns({"dfi": F.col("a.is_dfi_or_multilateral"), "public": F.col("b.is_government_or_public_service"), "institution": F.col("c.is_public_institution"), "multi": F.col("m.is_multinational"), "footprint": joined("m.african_city_footprint")})


# ------------------------------------------------------------------ D: identity
_WEB = "regexp_replace(regexp_replace(url, '#.*$', ''), '^https?://(www\\.)?', '')"


@query(f"""
WITH u AS (SELECT page_id, {_WEB} AS rest FROM pages),
p AS (SELECT page_id, split_part(rest, '?', 1) AS base, CASE WHEN contains(rest, '?') THEN substr(rest, strpos(rest, '?') + 1) ELSE '' END AS q FROM u),
f AS (SELECT page_id, base, list_sort([x for x in string_split(q, '&') if x <> '' AND NOT regexp_matches(x, '^(utm_source|utm_medium|utm_campaign|utm_content|utm_term|ref|source)=')]) AS params FROM p)
SELECT page_id, 'https://' || lower(split_part(base, '/', 1)) || regexp_replace(regexp_replace(substr(base, length(split_part(base, '/', 1)) + 1), '/+', '/', 'g'), '/$', '')
 || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url_key FROM f""")
def d1_canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", D.canonical_url("url").alias("url_key"))


@query("SELECT c_custkey AS k, 'emp-' || substr(sha256(c_name || '|' || c_mktsegment), 1, 16) AS stable FROM customer")
def f16_stable_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), X.stable_id("emp", "c_name", "c_mktsegment").alias("stable"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings from orders, customers and nations: employer, place, dates, source and pay by key arithmetic."""
    o, c, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    k = F.col("o_orderkey")
    pick = lambda values, by=k: F.element_at(F.array(*(F.lit(v) for v in values)), F.pmod(by, F.lit(len(values))).cast("int") + 1)
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.concat(F.lit("p-"), k.cast("string")).alias("id"), k.cast("long").alias("pos"), pick(TITLES).alias("title"), F.concat(F.lit("Employer "), (F.col("o_custkey") % 50).cast("string")).alias("org_name"), pick(CITIES, F.col("o_custkey")).alias("city"),
        F.lit("KE").alias("country_code"), F.lit("Kenya").alias("country"), F.col("n_name").alias("nation"), pick(["official", "aggregated", "community"]).alias("source_confidence"), pick(["employer_ats", "commercial_aggregator", "institutional_aggregator"]).alias("source_kind"),
        (F.pmod(k, F.lit(3)) == 0).alias("apply_is_official"), F.concat(F.lit("Source "), (F.pmod(k, F.lit(7))).cast("string")).alias("source_name"), F.col("o_orderdate").alias("posted_at"), (F.col("o_orderdate") + F.expr("interval 30 days")).alias("deadline"),
        pick(["onsite", "hybrid", "remote_global", None]).alias("work_mode"), pick(["entry", "senior", None]).alias("seniority"), F.col("c_mktsegment").alias("industry"), F.col("o_totalprice").alias("pay"), F.lit(None).cast("string").alias("summary"),
    )


TITLES = ["Data Analyst", "Nurse", "Driver", "Teacher", "Accountant"]
CITIES = ["Nairobi", "Mombasa"]


def _sql_pick(values: list, by: str) -> str:
    from jobloom.plans.cases import _quoted

    return f"CASE {by} % {len(values)} " + " ".join(f"WHEN {i} THEN {_quoted(v)}" for i, v in enumerate(values)) + " END"


POSTINGS = f"""
postings AS (SELECT 'p-' || CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS pos, {_sql_pick(TITLES, "o_orderkey")} AS title, 'Employer ' || CAST(o_custkey % 50 AS VARCHAR) AS org_name, {_sql_pick(CITIES, "o_custkey")} AS city,
 'KE' AS country_code, n_name AS nation, {_sql_pick(["official", "aggregated", "community"], "o_orderkey")} AS source_confidence, o_orderkey % 3 AS kind, o_orderkey % 3 = 0 AS apply_is_official, 'Source ' || CAST(o_orderkey % 7 AS VARCHAR) AS source_name,
 o_orderdate AS posted_at, {_sql_pick(["onsite", "hybrid", "remote_global", None], "o_orderkey")} AS work_mode, {_sql_pick(["entry", "senior", None], "o_orderkey")} AS seniority, c_mktsegment AS industry, o_totalprice AS pay
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _with_keys(rows: DataFrame) -> DataFrame:
    none = F.lit(None)
    rows = rows.withColumns({"apply_url": none.cast("string"), "raw_description_url": none.cast("string"), "org_id": none.cast("string"), "government": none.cast("struct<is_government:boolean,registry_id:string,advert_reference:string,grade:string>")})
    rows = rows.withColumns({"deadline": none.cast("string"), "org_verified": none.cast("boolean"), "years_experience_min": none.cast("int"), "education_required": none.cast("string"), "contract_type": none.cast("string"), "role_family": none.cast("string")})
    keyed = D.identity_keys(rows)
    return keyed.withColumn("precedence", D.precedence(keyed))


@query(f"WITH {POSTINGS} SELECT CAST(min(pos) AS BIGINT) AS first_pos, CAST(arg_max(pos, 1000000000000 * CASE kind WHEN 0 THEN 180 WHEN 1 THEN 20 ELSE 17 END - pos) AS BIGINT) AS pos, CAST(count(*) - 1 AS BIGINT) AS removed FROM postings GROUP BY org_name, title, city")
def d5_resolve_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One employer's equal titles in a city are one posting; each group's keys are disjoint, so the best of a
    group stays, the first of equal ones."""
    rows = _with_keys(postings(spark, sf_dir))
    kept, events = D.resolve_duplicates(rows)
    group = ["org_name", "title", "city"]
    removed = events.join(rows.select(F.col("pos").alias("removed_pos"), *group), "removed_pos").groupBy(*group).agg(F.count("*").alias("removed"))
    first = rows.groupBy(*group).agg(F.min("pos").alias("first_pos"))
    return kept.select("pos", *group).join(first, group).join(removed, group, "left").select("first_pos", "pos", F.coalesce("removed", F.lit(0)).cast("long").alias("removed"))


@query("WITH " + POSTINGS + ", g AS (SELECT count(*) AS n FROM postings GROUP BY org_name, title, city) SELECT CAST(sum(n) AS BIGINT) AS input_count, count(*) AS published_count, CAST(sum(n) - count(*) AS BIGINT) AS removed_count, CAST(0 AS DOUBLE) AS government_destructive_loss_percent FROM g")
def a18_dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_keys(postings(spark, sf_dir))
    kept, events = D.resolve_duplicates(rows)
    return D.dedup_report(rows, kept, events).select("input_count", "published_count", "removed_count", "government_destructive_loss_percent")


@query("SELECT CAST(min(event_id) AS BIGINT) AS event_id, user_id FROM events GROUP BY user_id")
def d7_first_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.first_by_id(table(spark, sf_dir, "events"), "user_id", "event_id").select(F.col("event_id").cast("long").alias("event_id"), "user_id")


# ------------------------------------------------------------------ A, W: reports
_DIMS = ["source_name", "work_mode", "seniority", "industry", "nation"]


@query("WITH " + POSTINGS + " " + " UNION ALL ".join(f"SELECT '{d}' AS dimension, coalesce({d}, 'unknown') AS value, count(*) AS count FROM postings GROUP BY ALL" for d in _DIMS))
def a1_coverage_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counters(postings(spark, sf_dir), {d: (F.col(d), "unknown") for d in _DIMS}).select("dimension", "value", "count")


@query("WITH d AS (SELECT source, unnest(list_distinct([lang, CASE WHEN n_chars > 1000 THEN 'long' ELSE 'short' END])) AS theme FROM documents) SELECT 'theme' AS dimension, theme AS value, count(*) AS count FROM d GROUP BY theme")
def a2_multi_valued_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    themes = F.array_distinct(F.array("lang", F.when(F.col("n_chars") > 1000, "long").otherwise("short")))
    return A.counters(table(spark, sf_dir, "documents"), {}, {"theme": themes}).select("dimension", "value", "count")


@query("SELECT CASE WHEN l_discount * 10 >= 0.9 THEN 'high_0.90_plus' WHEN l_discount * 10 >= 0.6 THEN 'medium_0.60_0.89' ELSE 'low_below_0.60' END AS value, count(*) AS count FROM lineitem GROUP BY 1")
def a3_confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("b", A.bucket(F.col("l_discount") * 10, *A.LOCATION_BUCKETS))
    return A.counters(rows, {"confidence": (F.col("b"), "unknown")}).select("value", "count")


@query("WITH " + POSTINGS + " SELECT 'work_mode' AS field, count(work_mode) AS count, round(100.0 * count(work_mode) / count(*), 1) AS percent FROM postings UNION ALL SELECT 'seniority', count(seniority), round(100.0 * count(seniority) / count(*), 1) FROM postings UNION ALL SELECT 'official', CAST(sum(apply_is_official::INT) AS BIGINT), round(100.0 * sum(apply_is_official::INT) / count(*), 1) FROM postings")
def a6_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.completeness(postings(spark, sf_dir), {"work_mode": F.col("work_mode").isNotNull(), "seniority": F.col("seniority").isNotNull(), "official": F.col("apply_is_official")})


@query("WITH " + POSTINGS + " SELECT count(*) AS opportunity_count, count(DISTINCT source_name) AS sources, count(DISTINCT org_name) AS organisations, count(DISTINCT city) AS cities, CAST(sum(apply_is_official::INT) AS BIGINT) AS official FROM postings")
def a7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.summary(postings(spark, sf_dir), {"sources": F.col("source_name"), "organisations": F.col("org_name"), "cities": F.col("city")}, {"official": F.col("apply_is_official")})


@query("WITH " + POSTINGS + " SELECT count(*) AS opportunity_count, count(DISTINCT source_name) AS source_count FROM postings")
def a19_feed_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.feed_meta(postings(spark, sf_dir))


@query("""WITH c AS (SELECT event_type AS source, count(*) AS n FROM events GROUP BY 1), conf AS (SELECT DISTINCT r_name AS source FROM region UNION SELECT DISTINCT event_type FROM events WHERE event_type < 'm')
SELECT coalesce(c.source, conf.source) AS source, CASE WHEN coalesce(n, 0) > 0 THEN 'ok' ELSE 'empty' END AS status, coalesce(n, 0) AS count, conf.source IS NOT NULL AS configured FROM c FULL JOIN conf ON c.source = conf.source""")
def a14_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    counts = events.groupBy(F.col("event_type").alias("source")).count()
    configured = table(spark, sf_dir, "region").select(F.col("r_name").alias("source")).union(events.where("event_type < 'm'").select("event_type")).distinct()
    return A.source_health(counts, spark.createDataFrame([], "source string, status string"), configured)


@query("SELECT r_name AS source, CAST(coalesce(n, 0) AS BIGINT) AS count FROM region LEFT JOIN (SELECT o_orderkey % 4 AS p, count(*) AS n FROM orders GROUP BY 1) ON r_regionkey = p")
def a16_counts_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.concat_ws("-", (F.col("o_orderkey") % 4).cast("string"), F.col("o_orderkey").cast("string")).alias("id"))
    specs = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("prefix"), F.col("r_name").alias("source"))
    return A.counts_by_prefix(rows, specs)


# ------------------------------------------------------------------ V, G: quality
@query("""SELECT rule, count(*) AS count FROM (SELECT unnest([x for x in [CASE WHEN o_orderkey % 11 = 0 THEN 'title.required' END, CASE WHEN o_orderkey % 5 = 0 THEN 'work_mode.vocabulary' END, CASE WHEN o_orderkey % 7 = 0 THEN 'location_confidence.range' END, CASE WHEN o_orderkey % 13 = 0 THEN 'deadline.before_posted' END, CASE WHEN o_orderkey % 17 = 0 THEN 'country_code.format' END] if x IS NOT NULL]) AS rule FROM orders) GROUP BY rule""")
def v1_row_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    on = lambda n: F.pmod(k, F.lit(n)) == 0
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("p-"), k.cast("string")).alias("id"), F.when(~on(11), F.lit("Clerk")).alias("title"), F.when(on(5), "beach").otherwise("onsite").alias("work_mode"), F.when(on(7), 1.5).otherwise(0.5).alias("location_confidence"),
        F.col("o_orderdate").alias("posted_at"), F.when(on(13), F.col("o_orderdate") - F.expr("interval 1 day")).otherwise(F.col("o_orderdate")).alias("deadline"), F.when(on(17), "ke").otherwise("KE").alias("country_code"),
    )
    return V.violations(rows).groupBy("rule").agg(F.count("*").alias("count"))


@query("SELECT user_id, event_type, count(*) AS count FROM events GROUP BY ALL HAVING count(*) > 1")
def v2_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.duplicate_keys(table(spark, sf_dir, "events"), "user_id", "event_type")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, lang AS term, 'warning' AS severity FROM documents WHERE lang NOT IN ('en', 'fr')")
def v4_unknown_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.unknown_terms(table(spark, sf_dir, "documents"), F.array("lang"), spark.createDataFrame([("en",), ("fr",)], "term string"), "doc_id")


@query("WITH " + POSTINGS + """, s AS (SELECT source_name, count(*) AS n FROM postings GROUP BY 1), t AS (SELECT count(*) AS total, sum(apply_is_official::INT) AS official FROM postings)
SELECT 'max_single_country_percent' AS gate, CAST(100.0 AS DOUBLE) AS value, CAST(60.0 AS DOUBLE) AS "limit", FALSE AS passed, 'error' AS severity
UNION ALL SELECT 'max_single_source_percent', CAST((SELECT max(n) FROM s) AS DOUBLE) * 100 / total, 40.0, (SELECT max(n) FROM s) * 100.0 / total <= 40, 'error' FROM t
UNION ALL SELECT 'minimum_official_apply_records', CAST(official AS DOUBLE), 10.0, official >= 10, 'error' FROM t
UNION ALL SELECT 'minimum_by_region.East Africa', CAST(total AS DOUBLE), 5.0, total >= 5, 'error' FROM t
UNION ALL SELECT 'minimum_by_region.West Africa', 0.0, 5.0, FALSE, 'error'""")
def g1_coverage_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = postings(spark, sf_dir).withColumns({c: none for c in ("location_scope", "location_raw", "source_label", "source_url", "apply_url", "raw_description_url")})
    rows = rows.withColumns({"region": F.lit("East Africa"), "eligibility_evidence": F.lit(None).cast("array<string>"), "org_verified": F.lit(True)})
    gates = {"max_single_country_percent": 60, "max_single_source_percent": 40, "minimum_official_apply_records": 10, "minimum_by_region": {"East Africa": 5, "West Africa": 5}}
    return V.coverage_gates(rows, gates)


# ------------------------------------------------------------------ Q: search
def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir)
    return S.slim(rows.withColumn("loc", F.struct("country", "country_code", "city")).withColumn("opportunity_type", F.lit("job")).withColumn("contract_type", F.lit("permanent"))).withColumn("pos", F.substring("id", 3, 20).cast("long"))


@query("WITH " + POSTINGS + " SELECT id FROM postings WHERE (contains(lower(title), 'analyst') OR contains(lower(org_name), 'analyst') OR contains(lower(industry), 'analyst')) AND city = 'Nairobi' AND seniority IN ('entry') AND work_mode IN ('remote_global')")
def q1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = S.SearchRequest(keyword=" Analyst ", location="nairobi", selected={"experience": ["entry"], "remote": ["remote"], "certification_scope": []})
    return S.search(_items(spark, sf_dir), request, F.lit("2026-01-01").cast("timestamp")).select("id")


@query("WITH " + POSTINGS + " SELECT id FROM postings WHERE posted_at >= TIMESTAMP '1997-06-30 00:00:00' - INTERVAL 30 DAY")
def q3_date_posted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search(_items(spark, sf_dir), S.SearchRequest(date_posted="month", selected={}), F.lit("1997-06-30").cast("timestamp")).select("id")


@query("WITH " + POSTINGS + """ SELECT 'industry' AS facet, industry AS value, count(*) AS count FROM postings GROUP BY ALL UNION ALL SELECT 'remote', CASE work_mode WHEN 'remote_global' THEN 'remote' ELSE work_mode END, count(*) FROM postings WHERE work_mode IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'city', city, count(*) FROM postings GROUP BY ALL UNION ALL SELECT 'job_type', 'full_time', count(*) FROM postings UNION ALL SELECT 'multinational', 'false', count(*) FROM postings""")
def q6_facet_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.facet_options(_items(spark, sf_dir)).where("facet in ('industry', 'remote', 'city', 'job_type', 'multinational')")


@query("WITH " + POSTINGS + " SELECT id FROM postings ORDER BY posted_at DESC, pos LIMIT 30 OFFSET 30")
def q7_recent_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.search(_items(spark, sf_dir), S.SearchRequest(selected={}, sort_by="recent"), F.lit("2026-01-01").cast("timestamp"))
    return S.page_of(found, 2).select("id")


@query("WITH " + POSTINGS + " SELECT id FROM postings ORDER BY posted_at DESC, pos LIMIT 30 OFFSET 60")
def q7_keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page, each by the cursor of the one before: nothing is counted or skipped."""
    request, as_of, items = S.SearchRequest(selected={}, sort_by="recent"), F.lit("2026-01-01").cast("timestamp"), _items(spark, sf_dir)
    page = S.page_after(items, request, as_of)
    for _ in range(2):
        page = S.page_after(items, request, as_of, S.cursor_of(page))
    return page.select("id")


@query("WITH " + POSTINGS + " SELECT count(*) AS rows, count(DISTINCT source_name) AS sources, CAST(0 AS BIGINT) AS families, CAST(1 AS BIGINT) AS countries, count(DISTINCT city) AS cities FROM postings")
def q8_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.headline(_items(spark, sf_dir))


@query("SELECT DISTINCT event_type AS value, CASE WHEN event_type = 'click' THEN 'Clicks' ELSE array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(replace(event_type, '_', ' '), ' ')], ' ') END AS label FROM events")
def q9_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.labels(table(spark, sf_dir, "events").select(F.col("event_type").alias("value")).distinct(), spark.createDataFrame([("click", "Clicks")], "id string, label string"))


# ------------------------------------------------------------------ U, T
@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 10 = 0 THEN 'missing' WHEN o_orderkey % 10 = 1 THEN 'changed' ELSE 'moved' END AS change FROM orders WHERE o_orderkey % 10 IN (0, 1, 2)")
def u2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    before = table(spark, sf_dir, "orders").select(k.cast("string").alias("id"), F.col("o_orderpriority").alias("title"), k.alias("pos"))
    last = F.pmod(F.col("pos"), F.lit(10))
    after = before.where(last != 0).withColumn("title", F.when(last == 1, "new").otherwise(F.col("title"))).withColumn("pos", F.when(last == 2, F.col("pos") + 1).otherwise(F.col("pos")))
    return U.changes(before, after)


@query("SELECT value, only_in FROM (SELECT DISTINCT c_mktsegment AS value, 'left' AS only_in FROM customer UNION ALL SELECT DISTINCT o_orderpriority, 'right' FROM orders)")
def u7_same_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.same_vocabulary(table(spark, sf_dir, "customer").select("c_mktsegment").distinct(), table(spark, sf_dir, "orders").select("o_orderpriority").distinct())


@query("SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type AS source, count(*) AS runs, CAST(sum((event_type LIKE 'e%')::INT) AS BIGINT) AS errors, CAST(sum(user_id) AS BIGINT) AS rows FROM events GROUP BY ALL")
def t2_health_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.when(F.col("event_type").startswith("e"), "error: x").otherwise("ok").alias("status"), F.col("user_id").alias("rows"), F.col("ts").alias("at"))
    return T.health_windows(runs)


@query("""WITH e AS (SELECT user_id % 40 AS source, ts, event_id % 11 = 0 AS bad FROM events), m AS (SELECT max(ts) AS t FROM events),
l AS (SELECT source, max(ts) FILTER (NOT bad) AS last_good FROM e GROUP BY 1)
SELECT CAST(source AS VARCHAR) AS source, last_good, CAST(1 + source % 3 AS INTEGER) AS freshness_hours FROM l, m WHERE last_good IS NULL OR date_diff('second', last_good, t) / 3600.0 > 1 + source % 3""")
def t3_stale_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    source = F.pmod("user_id", F.lit(40))
    runs = events.select(source.cast("string").alias("source"), F.when(F.col("event_id") % 11 == 0, "error: timeout").otherwise("ok").alias("status"), F.col("ts").alias("at"))
    fresh = events.select(source.cast("string").alias("source"), (1 + source % 3).cast("int").alias("freshness_hours")).distinct()
    return T.stale_sources(runs, fresh, F.lit(events.agg(F.max("ts")).first()[0]))


# ------------------------------------------------------------------ S, H: sources
def _landing(spark: SparkSession, sf_dir: str, key: str, envelope: str, item: str) -> DataFrame:
    """One payload for each customer: items are that customer's orders."""
    orders = table(spark, sf_dir, "orders")
    one = F.expr(f"to_json({item})")
    lists = orders.groupBy("o_custkey").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(one)), ","), F.lit("]")).alias("items"))
    body = F.col("items") if envelope == "" else F.concat(F.lit(f'{{"{envelope}":'), F.col("items"), F.lit("}"))
    return lists.select(F.lit(key).alias("source_key"), F.col("o_custkey").cast("string").alias("target_id"), F.lit(None).cast("timestamp").alias("fetched_at"), body.alias("payload"))


@query("""SELECT 'greenhouse-' || o_custkey || '-' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'Senior Nurse' ELSE 'Intern' END AS title, CASE WHEN o_orderkey % 2 = 0 THEN 'senior' ELSE 'entry' END AS seniority, CAST(o_orderkey % 9 + 1 AS INTEGER) AS years_experience_min, o_orderdate AS posted_at FROM orders""")
def s1_greenhouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = "named_struct('id', o_orderkey, 'title', if(o_orderkey % 2 = 0, 'Senior Nurse', 'Intern'), 'location', named_struct('name', 'Nairobi'), 'content', concat('<p>At least ', o_orderkey % 9 + 1, ' years</p>'), 'updated_at', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"))"
    return L.from_source("greenhouse", _landing(spark, sf_dir, "greenhouse", "jobs", item)).select("id", "title", "seniority", "years_experience_min", "posted_at")


@query("SELECT 'lever-' || o_custkey || '-' || o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'internship' ELSE 'job' END AS opportunity_type, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 1000 AS INTEGER) END AS low, 'https://l.test/' || o_orderkey || '/apply' AS apply_url FROM orders")
def s2_lever(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay = "if(o_orderkey % 2 = 0, named_struct('min', o_orderkey % 1000, 'max', 5000, 'currency', 'USD', 'interval', 'per-year-salary'), named_struct('min', 1, 'max', cast(null as bigint), 'currency', 'USD', 'interval', 'per-year-salary'))"
    item = f"named_struct('id', cast(o_orderkey as string), 'text', 'Engineer', 'categories', named_struct('location', 'Lagos', 'commitment', if(o_orderkey % 3 = 0, 'Intern', 'Full-time')), 'hostedUrl', concat('https://l.test/', o_orderkey), 'salaryRange', {pay})"
    return L.from_source("lever", _landing(spark, sf_dir, "lever", "", item)).select("id", "opportunity_type", F.col("compensation.min").alias("low"), "apply_url")


@query("SELECT 'ashby-' || o_custkey || '-' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN CAST(3 AS INTEGER) END AS low, CASE WHEN o_orderkey % 2 = 0 THEN CAST(9 AS INTEGER) END AS high FROM orders WHERE o_orderkey % 5 <> 0")
def s3_ashby(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = "array(named_struct('minValue', 5, 'maxValue', 9, 'currencyCode', 'USD'), named_struct('minValue', 3, 'maxValue', 7, 'currencyCode', if(o_orderkey % 2 = 0, 'USD', 'EUR')))"
    item = f"named_struct('id', cast(o_orderkey as string), 'title', 'Engineer', 'isListed', o_orderkey % 5 != 0, 'compensation', named_struct('compensationTiers', {tiers}))"
    return L.from_source("ashby", _landing(spark, sf_dir, "ashby", "jobs", item)).select("id", F.col("compensation.min").alias("low"), F.col("compensation.max").alias("high"))


@query("SELECT 'adzuna-' || o_orderkey AS id, CASE o_orderkey % 2 WHEN 0 THEN 'Cape Town, South Africa' ELSE 'Durban, South Africa' END AS location_raw, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(100 AS INTEGER) END AS low, CASE o_orderkey % 2 WHEN 0 THEN 'contract' ELSE 'part_time' END AS contract_type FROM orders")
def s8_adzuna(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = "named_struct('id', o_orderkey, 'title', 'Clerk', 'location', named_struct('display_name', if(o_orderkey % 2 = 0, 'Cape Town, South Africa', 'Durban'), 'area', array('South Africa', 'x')), 'salary_is_predicted', if(o_orderkey % 3 = 0, '1', '0'), 'salary_min', 100, 'salary_max', 200, 'contract_type', if(o_orderkey % 2 = 0, 'contract', cast(null as string)), 'contract_time', 'part_time')"
    return L.from_source("adzuna", _landing(spark, sf_dir, "adzuna", "results", item)).select("id", "location_raw", F.col("compensation.min").alias("low"), "contract_type")


@query("SELECT 'himalayas-' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'Remote - Worldwide' ELSE 'Remote - Kenya, Ghana' END AS location_raw, 'remote' AS mode_hint FROM orders")
def s9_himalayas(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = "named_struct('id', concat('https://h.test/jobs/', o_orderkey, '/'), 'title', 'Editor', 'locationRestrictions', if(o_orderkey % 2 = 0, array(), array('Kenya', 'Ghana')))"
    return L.from_source("himalayas", _landing(spark, sf_dir, "himalayas", "jobs", item)).select("id", "location_raw", "mode_hint")


@query("SELECT 'remoteok-' || o_orderkey AS id, 'b|a' AS terms, CAST(10 AS INTEGER) AS low, 'USD' AS currency FROM orders WHERE o_orderkey % 4 <> 0")
def s12_remoteok(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = "named_struct('id', o_orderkey, 'position', if(o_orderkey % 4 = 0, cast(null as string), 'Dev'), 'tags', array('b', 'a', 'B'), 'salary_min', 10, 'salary_max', 20)"
    return L.from_source("remoteok", _landing(spark, sf_dir, "remoteok", "", item)).select("id", joined("raw_terms").alias("terms"), F.col("compensation.min").alias("low"), F.col("compensation.currency").alias("currency"))


@query("SELECT 'workable-' || o_custkey || '-' || o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'Dakar' WHEN 1 THEN 'Lagos' ELSE 'Nairobi, Kenya' END AS location_raw FROM orders")
def s18_workable(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = """named_struct('shortcode', cast(o_orderkey as string), 'title', 'Cook', 'location', parse_json(case o_orderkey % 3 when 0 then '"Dakar"' when 1 then '{"name":"Lagos"}' else '["Nairobi","Kenya"]' end))"""
    return L.from_source("workable", _landing(spark, sf_dir, "workable", "results", item)).select("id", "location_raw")


@query("SELECT c_custkey AS k, 'PUB' || c_custkey AS ref, 'Engineer ' || c_custkey AS title, CAST(c_custkey % 6 + 1 AS INTEGER) AS positions, TIMESTAMP '2026-12-31 23:59:59' AS deadline, CASE WHEN c_custkey % 2 = 0 THEN 'https://gov.test/v/' || c_custkey ELSE 'https://gov.test/list' END AS apply_url FROM customer")
def s21_government_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    link = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("/v/"), k)).otherwise("javascript:__doPostBack()")
    row = F.concat(F.lit("<tr><td>PUB"), k, F.lit("</td><td><a href='"), link, F.lit("'>Engineer "), k, F.lit("</a></td><td>"), (F.col("c_custkey") % 6 + 1).cast("string"), F.lit("</td><td>31-12-2026</td></tr>"))
    head = "<table><tr><th>Advert Number</th><th>Position</th><th>Vacancies</th><th>Closing Date</th></tr>"
    pages = table(spark, sf_dir, "customer").select("c_custkey", k.alias("portal_id"), F.lit("Portal").alias("portal_name"), F.lit("https://gov.test/list").alias("url"), F.concat(F.lit(head), row, F.lit("</table>")).alias("html"), F.lit(None).cast("string").alias("form_url"), F.lit("Kenya").alias("country_name"), F.lit(True).alias("citizenship_required"), F.array(F.lit("KE")).alias("eligible_nationalities"))
    out = H.from_government_tables(pages)
    return out.select(F.col("portal_id").cast("long").alias("k"), F.col("government_fields.advert_reference").alias("ref"), "title", F.col("government_fields.number_of_positions").alias("positions"), "deadline", "apply_url")


@query("SELECT c_custkey AS k, CAST(n AS INTEGER) AS pos, CASE n WHEN 0 THEN 'Clerk' ELSE 'Registrar' END AS title, CASE n WHEN 0 THEN 'DOJ ' || c_custkey || '/1' ELSE 'DOJ ' || c_custkey || '/2' END AS ref, CASE n WHEN 0 THEN 'Pretoria' ELSE 'Durban' END AS place FROM customer, (VALUES (0), (1)) AS t(n)")
def s23_circular_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    text = F.concat(F.lit("CLOSING DATE: 2026-09-01\nPOST DOJ "), k, F.lit("/1 : Clerk\nSALARY : R1\nCENTRE : Pretoria\nREQUIREMENTS : 3 years\nPOST DOJ "), k, F.lit("/2 : Registrar\nSALARY : R2\nCENTRE : Durban\n"))
    docs = table(spark, sf_dir, "customer").select(k.alias("portal_id"), F.lit("Portal").alias("portal_name"), F.lit("https://gov.test/c.pdf").alias("url"), text.alias("text"), F.lit("South Africa").alias("country_name"), F.array(F.lit("ZA")).alias("eligible_nationalities"))
    out = H.from_circular_text(docs)
    return out.select(F.col("portal_id").cast("long").alias("k"), F.col("pos").cast("int").alias("pos"), "title", F.col("government_fields.advert_reference").alias("ref"), F.col("location_raw").alias("place"))


@query("WITH d AS (SELECT c_nationkey AS portal_id, c_custkey % 3 AS y, c_custkey % 5 AS n, c_custkey AS url FROM customer), m AS (SELECT portal_id, max(y * 10 + n) AS best FROM d GROUP BY 1), l AS (SELECT d.portal_id, url, row_number() OVER (PARTITION BY d.portal_id ORDER BY url) AS r FROM d JOIN m ON d.portal_id = m.portal_id AND y * 10 + n = best) SELECT portal_id, url FROM l WHERE r <= 2")
def s24_latest_circulars(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("portal_id"), (F.col("c_custkey") % 3).alias("year"), (F.col("c_custkey") % 5).alias("number"), F.col("c_custkey").alias("url"), F.col("c_custkey").alias("pos"))
    return H.latest_circulars(docs, 2).select("portal_id", "url")


@query("SELECT currency, CAST(usd_per_unit AS DOUBLE) AS usd_per_unit, n FROM (VALUES " + ", ".join(f"('{c}', {round(1 / u, 8)})" for c, u in R.UNITS_PER_USD.items() if u > 0) + ", ('USD', 1.0)) AS r(currency, usd_per_unit), (SELECT count(*) AS n FROM orders)")
def s26_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.fx_rates(spark).withColumn("n", F.lit(table(spark, sf_dir, "orders").count()))


@query("""WITH b AS (SELECT page_id, regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->|<!\\w[^>]*>|<\\?[^>]*>|</?[A-Za-z][^>]*>', '', 'g') AS t FROM pages),
u AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS t FROM b),
c AS (SELECT page_id, trim(regexp_replace(t, '\\s+', ' ', 'g'), ' ') AS t FROM u)
SELECT page_id, CASE WHEN length(t) > 300 THEN substr(t, 1, 300) || '...' WHEN t <> '' THEN t END AS summary FROM c""")
def f1_html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities are resolved as HTML5 does: these six names count without their semicolon too, as where a page is cut."""
    return table(spark, sf_dir, "pages").select("page_id", N.html_to_text("html").alias("summary"))


@query()
def h2_candidate_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.candidate_links(table(spark, sf_dir, "pages"), titles=False).select("page_id", "pos", "link", "text")


@query("SELECT c_custkey AS k, 'Analyst ' || c_custkey AS title, 'Nairobi, KE' AS location_raw, TIMESTAMP '2026-03-01 00:00:00' AS posted_at FROM customer")
def h1_s20_json_ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    body = F.concat(F.lit('<html><script type="application/ld+json">{"@graph":[{"@type":"WebPage"},{"@type":["JobPosting"],"title":"Analyst '), k, F.lit('","datePosted":"2026-03-01","jobLocation":{"address":{"addressLocality":"Nairobi","addressCountry":"KE"}}}]}</script></html>'))
    pages = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page_id"), F.concat(F.lit("https://o.test/"), k).alias("url"), body.alias("html"), k.alias("organisation_id"))
    return H.from_job_objects(H.json_ld_jobs(pages)).select(F.col("organisation_id").cast("long").alias("k"), "title", "location_raw", "posted_at")


def queries() -> dict[str, Query]:
    from jobloom.plans import coverage_queries, enriched_queries, table_queries

    return FOUND | enriched_queries.FOUND | table_queries.FOUND | coverage_queries.FOUND


def oracle_sql() -> dict[str, str]:
    from jobloom.plans import coverage_queries, enriched_queries, table_queries

    return SQL | enriched_queries.SQL | table_queries.SQL | coverage_queries.SQL
