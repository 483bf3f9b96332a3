"""Queries over postings that run through the whole enrichment chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.operators import predicates as P
from jobloom.operators import quality as V
from jobloom.operators import reports as A
from jobloom.operators import search as S
from jobloom.plans.cases import Case, joined, spread, varied
from jobloom.plans.enrich import enrich, refresh
from jobloom.registries import ORGANISATIONS

_IN = {
    "title": ["Private Equity Associate", "Child Protection Officer", "Water Engineer", "Lecturer", "Network Manager", "Clerk", "Remote editor", "Office Manager"],
    "org_name": ["Harbour Growth Fund", "Open Relief", "Ministry of Water", "Lake University", "Sky Telecom", "Plain Foods", "Nobody Ltd", "River Development Bank"],
    "location_raw": ["Nairobi, Kenya", "Dakar", "Nairobi", "Arusha", "Lagos, NG", "Tashkent, UZ", "Remote - Africa", None],
    "summary": ["deal execution", "international applicants are welcome", "national position", None, "must have valid work permit", None, "open to all African countries", None],
    "raw_terms": [["Analytics"], ["MEL"], [], [], ["1000 Eng"], [], [], []],
    "source_key": ["boards", "relief", "x", "x", "boards", "x", "x", "x"],
    "source_url": ["https://a.boards.example.com/1", "https://relief.example.org/2", "https://gazette.example.gov/3", None, None, "https://example.net/4", None, "https://k.ats.example.io/"],
    "apply_url": ["https://a.test/1"] * 8,
    "apply_is_official": [True, False, True, False, True, False, False, True],
}
_OUT = {
    "org_id": ("string", ["harbour-fund", "open-relief", "water-ministry", "lake-university", "sky-telecom", "plain-foods", None, "river-bank"]),
    "country_code": ("string", ["KE", "SN", "KE", "TZ", "NG", "UZ", None, None]),
    "role_family": ("string", ["investment", "programmes", None, None, "engineering", None, None, None]),
    "themes": ("string", ["digital|evidence|capital", "governance|evidence", "", "", "digital", "", "", ""]),
    "investment": ("string", ["core_investment", "not_investment", "not_investment", "not_investment", "not_investment", "not_investment", "not_investment", "institutional_support"]),
    "ngo": ("string", ["not_ngo_un", "technical_programme", "not_ngo_un", "not_ngo_un", "not_ngo_un", "not_ngo_un", "not_ngo_un", "not_ngo_un"]),
    "is_public": ("boolean", [False, False, True, True, False, False, False, False]),
    "multi": ("boolean", [False, False, False, False, True, False, False, False]),
    "source_id": ("string", ["boards", "relief", "gazette", None, None, "market", None, "platform"]),
    "relevance": ("string", ["africa_based_confirmed", "africa_based_confirmed", "africa_based_confirmed", "africa_based_confirmed", "africa_based_confirmed", "non_african", "africa_based_confirmed", "official_location_pending"]),
    "access": ("string", ["unknown", "confirmed_international_recruitment", "confirmed_specific_african_nationality", "unknown", "work_authorisation_required", "unknown", "likely_open", "unknown"]),
    "legacy": ("string", ["uncertain", "eligible", "citizenship_restricted", "uncertain", "uncertain", "uncertain", "likely_eligible", "uncertain"]),
    "certified": ("boolean", [False, True, True, False, True, False, True, False]),
}


def _flat(d: DataFrame) -> DataFrame:
    rows = enrich(d)
    return rows.withColumns({
        "country_code": F.col("loc.country_code"), "themes": joined("thematic_sectors"), "investment": F.col("investment_profile.classification"), "ngo": F.col("ngo_profile.classification"), "is_public": F.col("government_profile.is_government_or_public_service"),
        "multi": F.col("multinational_profile.is_multinational"), "relevance": F.col("africa_relevance.status"), "access": F.col("african_applicant_access.status"), "legacy": F.col("eligibility.status"), "certified": P.certified_default(),
    })


_VARY = {"title": "word", "org_name": "digits", "location_raw": "word", "summary": "word", "raw_terms": "element", "source_url": "path"}
CHAIN = Case(_IN, _OUT, _flat, _VARY)
FOUND = {"c13_enrichment": CHAIN.query()}
SQL = {"c13_enrichment": CHAIN.sql()}


def query(sql: str | None = None):
    def add(f):
        FOUND[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k")))
    from jobloom.plans.cases import _dealt

    row = F.pmod(F.col("k"), F.lit(CHAIN.n)).cast("int")
    dealt = keys.select("k", F.col("k").cast("long").alias("pos"), F.col("k").cast("string").alias("id"), *(varied(_dealt(v, row), _VARY.get(c)).alias(c) for c, v in _IN.items()))
    return enrich(dealt).withColumn("source_name", F.coalesce("source_id", F.lit("Unknown")))


_E = f"WITH e AS ({CHAIN.sql()})"


@query(_E + " SELECT 'classification' AS dimension, 'core_investment' AS value, count(*) AS count FROM e WHERE investment = 'core_investment' UNION ALL SELECT 'track', 'private_equity', count(*) FROM e WHERE investment = 'core_investment' UNION ALL SELECT 'country', 'KE', count(*) FROM e WHERE investment = 'core_investment' UNION ALL SELECT 'source', 'boards', count(*) FROM e WHERE investment = 'core_investment' UNION ALL SELECT 'confidence', 'high_0.85_plus', count(*) FROM e WHERE investment = 'core_investment'")
def a8_investment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.investment_report(enriched(spark, sf_dir)).select("dimension", "value", "count")


@query(_E + " SELECT 'institution' AS dimension, org_id AS value, count(*) AS count FROM e WHERE org_id IN ('harbour-fund', 'river-bank') GROUP BY ALL UNION ALL SELECT 'institution_type', CASE org_id WHEN 'river-bank' THEN 'development_bank' ELSE 'private_equity' END, count(*) FROM e WHERE org_id IN ('harbour-fund', 'river-bank') GROUP BY ALL UNION ALL SELECT 'source_pack', 'dfi', count(*) FROM e WHERE org_id IN ('harbour-fund', 'river-bank') UNION ALL SELECT 'relevance', CASE org_id WHEN 'river-bank' THEN 'institutional_role' ELSE 'adjacent_experience' END, count(*) FROM e WHERE org_id IN ('harbour-fund', 'river-bank') GROUP BY ALL")
def a9_dfi_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dfi_report(enriched(spark, sf_dir)).select("dimension", "value", "count")


@query(_E + " SELECT 'classification' AS dimension, 'technical_programme' AS value, count(*) AS count FROM e WHERE org_id = 'open-relief' UNION ALL SELECT 'track', 'child_protection', count(*) FROM e WHERE org_id = 'open-relief' UNION ALL SELECT 'group', 'ngo', count(*) FROM e WHERE org_id = 'open-relief'")
def a10_ngo_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.ngo_report(enriched(spark, sf_dir)).select("dimension", "value", "count")


@query(_E + ", g AS (SELECT * FROM e WHERE is_public) SELECT 'institution' AS dimension, org_id AS value, count(*) AS count FROM g GROUP BY ALL UNION ALL SELECT 'country', country_code, count(*) FROM g GROUP BY ALL UNION ALL SELECT 'grade', 'not_stated', count(*) FROM g UNION ALL SELECT 'citizenship', 'unknown', count(*) FROM g")
def a11_government_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.government_report(enriched(spark, sf_dir)).select("dimension", "value", "count")


@query(_E + " SELECT 'education' AS category, CAST(2 AS BIGINT) AS configured, CAST(1 AS BIGINT) AS enabled, count(*) AS postings FROM e WHERE org_id = 'lake-university' UNION ALL SELECT 'health', 1, 1, 0")
def a12_public_institution_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame([("education", True), ("education", False), ("health", True)], "category string, enabled boolean")
    return A.public_institution_report(enriched(spark, sf_dir), registry)


@query(_E + " SELECT 'sector' AS kind, 'telecom' AS value, CAST(1 AS BIGINT) AS configured, count(*) AS postings FROM e WHERE multi UNION ALL SELECT 'city', 'Lagos', 1, count(*) FROM e WHERE multi UNION ALL SELECT 'city', 'Nairobi', 1, 0")
def a13_multinational_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame([(o["id"], o["sector"], o["cities"]) for o in ORGANISATIONS if o["type"] == "multinational"], "id string, sector string, cities array<string>")
    return A.multinational_report(enriched(spark, sf_dir), registry)


@query(_E + " SELECT CASE WHEN country_code IS NULL AND relevance = 'official_location_pending' THEN 'official_location_pending' WHEN country_code IS NULL THEN 'location_neutral' ELSE 'physical_country' END AS value, count(*) AS count FROM e GROUP BY 1")
def a4_location_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = enriched(spark, sf_dir).withColumns({"country_code": F.col("loc.country_code"), "region": F.col("loc.region"), "eligibility_evidence": F.col("eligibility.evidence"), "source_label": none})
    return A.counters(rows, {"r": (P.location_resolution(), "unknown")}).select("value", "count")


@query(_E + " SELECT count(*) AS total, CAST(sum(certified::INT) AS BIGINT) AS certified, CAST(sum((relevance = 'africa_based_confirmed' AND access IN ('confirmed_international_recruitment', 'confirmed_specific_african_nationality', 'work_authorisation_required', 'likely_open'))::INT) AS BIGINT) AS counted, CAST(sum((access <> 'unknown' AND relevance = 'africa_based_confirmed')::INT) AS BIGINT) AS in_view FROM e")
def p15_p16_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).agg(F.count("*").alias("total"), F.count_if(P.certified_default()).alias("certified"), F.count_if(P.certified_count()).alias("counted"), F.count_if(P.certified_view()).alias("in_view"))


@query(_E + """, t AS (SELECT count(*) AS n, sum((relevance = 'non_african')::INT) AS f, sum((relevance = 'official_location_pending')::INT) AS p, sum(certified::INT) AS c FROM e)
SELECT gate, CAST(value AS DOUBLE) AS value, "limit", severity, passed FROM (SELECT 'missing_profiles' AS gate, 0 AS value, CAST(0 AS DOUBLE) AS "limit", 'error' AS severity, TRUE AS passed UNION ALL SELECT 'published_non_african', f, 0, 'error', f = 0 FROM t UNION ALL SELECT 'default_without_relevance', 0, 0, 'error', TRUE
UNION ALL SELECT 'weak_likely_open', 0, 0, 'error', TRUE UNION ALL SELECT 'citizenship_without_codes', 0, 0, 'error', TRUE UNION ALL SELECT 'destructive_government_loss_percent', 0, 5, 'error', TRUE
UNION ALL SELECT 'pending_percent', round(100.0 * p / n, 1), 10, 'warning', round(100.0 * p / n, 1) <= 10 FROM t UNION ALL SELECT 'unresolved_percent', 0, 2, 'warning', TRUE UNION ALL SELECT 'certified_rows', c, 1, 'error', c > 0 FROM t)""")
def g3_certification_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.certification_gates(enriched(spark, sf_dir))


@query(_E + " SELECT CAST(k AS VARCHAR) AS id FROM e WHERE certified")
def g4_certified_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.certified_subset(enriched(spark, sf_dir)).select("id")


@query(_E + " SELECT CAST(k AS VARCHAR) AS id, coalesce(org_id, 'x') AS org_id, CASE WHEN access <> 'unknown' AND relevance = 'africa_based_confirmed' THEN 'certified' WHEN relevance = 'africa_based_confirmed' THEN 'africa_unverified' ELSE 'broader_index' END AS scope FROM e")
def p4_q5_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.slim(enriched(spark, sf_dir)).select("id", F.coalesce("institution_registry_id", F.lit("x")).alias("org_id"), S.certification_scope().alias("scope"))


@query(_E + " SELECT CAST(sum((relevance <> 'non_african')::INT) AS BIGINT) AS kept, CAST(sum((relevance = 'non_african')::INT) AS BIGINT) AS rejected FROM e")
def p9_split_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both counts in one pass: each part of split_rejected would run the chain again."""
    rows = enriched(spark, sf_dir).select(P.rejection_reason().alias("reason"))
    return rows.agg(F.count_if(F.col("reason").isNull()).alias("kept"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))


@query("""WITH r AS (SELECT o_orderkey % 8 AS t, o_orderkey // 24 AS b FROM orders), g AS (SELECT DISTINCT t, b FROM r WHERE t <> 5)
SELECT (SELECT count(*) FROM g) AS kept, count(*) FILTER (t = 5) AS rejected, count(*) FILTER (t <> 5) - (SELECT count(*) FROM g) AS merged FROM r""")
def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain of a refresh: rows kept, rejected and merged. Up to three postings are one opening: they
    share the numbered title, the summary, the deadline and the address, and differ in their ids."""
    rows = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"))
    from jobloom.plans.cases import _dealt

    k = F.col("o_orderkey")
    row, opening = F.pmod(k, F.lit(CHAIN.n)).cast("int"), (k / 24).cast("long").cast("string")
    told = {c: _dealt(v, row) for c, v in _IN.items()}
    told |= {
        "title": F.concat_ws(" ", told["title"], opening),
        "summary": F.concat_ws(" ", told["summary"], F.repeat(F.lit("the notice goes on with wording of no consequence "), 3)),
        "apply_url": F.concat(F.lit("http://www.a.test//"), row.cast("string"), F.lit("/"), opening, F.lit("/?utm_source=x")),
        "deadline": F.timestamp_seconds(F.lit(1_800_000_000) + (k / 24).cast("long") * 86_400),
    }
    out = refresh(rows.select(k.cast("long").alias("pos"), k.cast("string").alias("id"), *(v.alias(c) for c, v in told.items())))
    return out["kept"].agg(F.count("*").alias("kept")).crossJoin(out["rejected"].agg(F.count("*").alias("rejected"))).crossJoin(out["events"].agg(F.count("*").alias("merged")))  # three single rows
