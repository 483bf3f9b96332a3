"""More queries over columns of the given tables, and the SQL that computes their results independently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import registries as R
from jobloom.functions import extract as X
from jobloom.functions import normalise as N
from jobloom.operators import matching as M
from jobloom.operators import predicates as P
from jobloom.operators import quality as V
from jobloom.operators import reports as A
from jobloom.operators import snapshot as U
from jobloom.plans import enriched_queries as E
from jobloom.plans.enrich import migrate_baseline, upgrade
from jobloom.plans.queries import _landing, table
from jobloom.sources import landed as L

FOUND: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        FOUND[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# ------------------------------------------------------------------ text of the given documents
_LOW = "lower(coalesce(text, ''))"


@query(f"""SELECT doc_id, md5(trim(regexp_replace(strip_accents({_LOW}), '[^a-z0-9]+', ' ', 'g'))) AS ascii_fold,
md5(trim(regexp_replace(strip_accents(replace({_LOW}, 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g'))) AS ngo, md5(trim(regexp_replace(replace({_LOW}, 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS plain FROM documents""")
def norm_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three normalisers over whole documents."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(N.norm_ascii_fold("text")).alias("ascii_fold"), F.md5(N.norm_ngo("text")).alias("ngo"), F.md5(N.norm_unicode("text")).alias("plain"))


def _marks(code: str) -> str:
    return f"regexp_matches(words, ' (?:{'|'.join(X.LANGUAGE_MARKS[code])}) ')"


@query(f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS raw, ' ' || trim(regexp_replace(replace({_LOW}, 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ' AS words FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(raw, '[\\x{{0600}}-\\x{{06ff}}]') THEN 'ar' WHEN {_marks("pt")} THEN 'pt' WHEN {_marks("fr")} THEN 'fr' WHEN {_marks("sw")} THEN 'sw' ELSE 'en' END AS language FROM d""")
def f8_language_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.detect_language("text", N.norm_unicode("text")).alias("language"))


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(coalesce(lang, '') || ' ' || left(coalesce(text, ''), 350)), '\\b(africa|global|emea|anywhere|worldwide|international)\\b') OR doc_id % 3 = 0 OR doc_id % 5 = 0 OR source IS NULL THEN true ELSE false END AS in_scope FROM documents")
def p8_scope_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").withColumns({"opted": F.col("doc_id") % 3 == 0, "african": F.when(F.col("doc_id") % 5 == 0, True)})
    return rows.select("doc_id", P.official_scope("opted", "african", "source", "lang", "text").alias("in_scope"))


# ------------------------------------------------------------------ sources: one payload for each customer, orders as items
_ORDER = "o_custkey || '-' || o_orderkey"


def _landed(spark: SparkSession, sf_dir: str, key: str, envelope: str, item: str, *fields: str) -> DataFrame:
    return L.from_source(key, _landing(spark, sf_dir, key, envelope, f"named_struct({item})")).select("id", *fields)


@query(f"SELECT 'pinpoint-' || {_ORDER} AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'Lagos' ELSE 'Abuja' END AS location_raw, 'Cook' AS title FROM orders")
def s4_pinpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "pinpoint", "data", "'id', o_orderkey, 'title', 'Cook', 'location', named_struct('name', if(o_orderkey % 2 = 0, 'Lagos', 'Abuja'))", "location_raw", "title")


@query(f"SELECT 'recruitee-' || {_ORDER} AS id, 'Dakar, Senegal' AS location_raw, o_orderpriority AS title FROM orders WHERE o_orderkey % 3 <> 0")
def s5_recruitee(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = "'id', o_orderkey, 'title', o_orderpriority, 'status', if(o_orderkey % 3 = 0, 'archived', 'published'), 'locations', array(named_struct('city', 'Dakar', 'country', 'Senegal'))"
    return _landed(spark, sf_dir, "recruitee", "offers", item, "location_raw", "title")


@query("SELECT 'reliefweb-' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'Nairobi, Kenya' ELSE 'Nairobi, Chad' END AS location_raw, 'Relief ' || (o_custkey % 5) AS org_name FROM orders")
def s6_reliefweb(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = "array(named_struct('name', 'Chad', 'primary', o_orderkey % 2 != 0), named_struct('name', 'Kenya', 'primary', o_orderkey % 2 = 0))"
    fields = f"named_struct('title', 'Nurse', 'body', 'x', 'country', {countries}, 'city', array(named_struct('name', 'Nairobi')), 'source', array(named_struct('name', concat('Relief ', o_custkey % 5))))"
    return _landed(spark, sf_dir, "reliefweb", "data", f"'id', cast(o_orderkey as string), 'fields', {fields}", "location_raw", "org_name")


@query("SELECT 'untalent-' || o_orderkey AS id, 'UN ' || (o_custkey % 3) AS org_name, 'a|b' AS terms FROM orders")
def s7_untalent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "untalent", "jobs", "'id', o_orderkey, 'title', 'Officer', 'organization', concat('UN ', o_custkey % 3), 'areas', array('a', 'b')", "org_name", F.array_join("raw_terms", "|").alias("terms"))


@query("SELECT 'remotive-' || o_orderkey AS id, 'remote' AS mode_hint, o_orderpriority AS terms FROM orders")
def s10_remotive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "remotive", "jobs", "'id', o_orderkey, 'title', 'Dev', 'candidate_required_location', 'Worldwide', 'category', o_orderpriority", "mode_hint", F.array_join("raw_terms", "|").alias("terms"))


@query("SELECT 'jobicy-' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'senior' ELSE 'entry' END AS seniority, 'A|B' AS terms FROM orders")
def s11_jobicy(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = "'id', o_orderkey, 'jobTitle', 'Dev', 'jobIndustry', array('A', 'B'), 'jobLevel', if(o_orderkey % 2 = 0, 'Senior', 'Junior')"
    return _landed(spark, sf_dir, "jobicy", "jobs", item, "seniority", F.array_join("raw_terms", "|").alias("terms"))


@query("SELECT 'arbeitnow-' || o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'part_time' ELSE 'unknown' END AS contract_type FROM orders")
def s13_arbeitnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = "'slug', cast(o_orderkey as string), 'title', 'Dev', 'remote', true, 'job_types', if(o_orderkey % 2 = 0, array('part time'), array(''))"
    return _landed(spark, sf_dir, "arbeitnow", "data", item, "contract_type")


@query(f"SELECT 'cornerstone-' || {_ORDER} AS id, 'Cook' AS title FROM orders")
def s14_cornerstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _landing(spark, sf_dir, "cornerstone", "requisitions", "named_struct('requisitionId', o_orderkey, 'displayJobTitle', 'Cook')")
    return L.from_source("cornerstone", landing.withColumn("payload", F.concat(F.lit('{"data":'), "payload", F.lit("}")))).select("id", "title")


@query(f"SELECT 'oracle-' || {_ORDER} AS id, o_orderpriority AS location_raw FROM orders")
def s15_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _landing(spark, sf_dir, "oracle", "requisitionList", "named_struct('Id', o_orderkey, 'Title', 'Clerk', 'PrimaryLocation', o_orderpriority)")
    return L.from_source("oracle", landing.withColumn("payload", F.concat(F.lit('{"items":['), "payload", F.lit("]}")))).select("id", "location_raw")


@query(f"SELECT 'workday-' || {_ORDER} AS id, 'Cairo' AS location_raw FROM orders")
def s16_workday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "workday", "jobPostings", "'title', 'Clerk', 'externalPath', concat('/job/', o_orderkey), 'locationsText', 'Cairo', 'bulletFields', array(cast(o_orderkey as string))", "location_raw")


@query(f"SELECT 'smartrecruiters-' || {_ORDER} AS id, 'Cairo, eg' AS location_raw FROM orders")
def s17_smartrecruiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "smartrecruiters", "content", "'id', cast(o_orderkey as string), 'name', 'Driver', 'location', named_struct('city', 'Cairo', 'country', 'eg')", "location_raw")


@query("SELECT source_order, source_key, count(*) AS n FROM (SELECT 0 AS source_order, 'workday' AS source_key FROM orders UNION ALL SELECT 1, 'remotive' FROM orders) GROUP BY ALL")
def u1_sources_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _landing(spark, sf_dir, "remotive", "jobs", "named_struct('id', o_orderkey, 'title', 'Dev')")
    two = _landing(spark, sf_dir, "workday", "jobPostings", "named_struct('title', 'Clerk', 'externalPath', concat('/job/', o_orderkey), 'bulletFields', array(cast(o_orderkey as string)))")
    return L.all_sources(one.union(two), order=["workday", "remotive"]).groupBy("source_order", "source_key").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ predicates
@query("SELECT c_custkey, (c_custkey % 4 = 0 OR c_custkey % 7 = 0 OR c_nationkey = 5) AS relevant FROM customer")
def p5_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").withColumns({"remote": F.col("c_custkey") % 4 == 0, "african": F.when(F.col("c_custkey") % 7 == 0, True), "code": F.when(F.col("c_nationkey") == 5, "KE").otherwise("DE")})
    return rows.select("c_custkey", P.relevant("remote", "african", "code", ["KE", "NG"], "c_name").alias("relevant"))


@query("SELECT count(*) AS still_open FROM orders WHERE o_orderkey % 9 = 0 OR o_orderdate >= TIMESTAMP '1995-06-01'")
def p12_still_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("deadline", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate").cast("timestamp")))
    return rows.where(P.still_open("deadline", F.lit("1995-06-01").cast("timestamp"))).agg(F.count("*").alias("still_open"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_name END AS place FROM customer")
def p17_merged_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").withColumn("given", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), "c_mktsegment")).when(F.col("c_custkey") % 3 == 1, "  "))
    return rows.select("c_custkey", P.merged_location("given", "c_name").alias("place"))


@query("SELECT id, title, opportunity_type FROM (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, o_orderstatus AS opportunity_type FROM orders)")
def p3_legacy_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("opportunity_type"), F.lit(1).alias("newer_field"), "o_totalprice")
    return U.legacy_projection(rows)


# ------------------------------------------------------------------ registries and references
@query("SELECT DISTINCT 'src' || (c_custkey % 3) AS source_key, lower(c_mktsegment) AS key FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def j6_unmapped_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.array("c_mktsegment").alias("terms"), F.concat(F.lit("src"), (F.col("c_custkey") % 3).cast("string")).alias("source"))
    aliases = spark.createDataFrame([("building", "construction")], "key string, target string")
    none = spark.createDataFrame([], "source_key string, key string, target string")
    ignored = spark.createDataFrame([("*", "machinery")], "source_key string, key string")
    return M.unmapped_terms(M.resolve_specialisations(rows, aliases, none, ignored, "terms", "source"))


@query("SELECT s_suppkey AS organisation_id, s_name AS name, 'b' || s_nationkey AS identifier FROM supplier WHERE s_suppkey % 2 = 0 AND s_nationkey % 3 <> 0")
def j16_adapter_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.struct(F.lit("lever").alias("adapter"), (F.col("s_nationkey") % 3 != 0).alias("enabled"), F.concat(F.lit("b"), "s_nationkey").alias("identifier"))
    other = F.struct(F.lit("ashby").alias("adapter"), F.lit(True).alias("enabled"), F.lit("x").alias("identifier"))
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 2 == 0).alias("enabled"), F.array(source, other).alias("sources"))
    return M.adapter_targets(rows, "lever")


@query("SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'inferred|' || lower(c_mktsegment) ELSE 'inferred|default|' || lower(c_mktsegment) END AS terms FROM customer")
def j17_source_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("org_id"), F.array(F.lit("default"), F.lower("c_mktsegment")).alias("specialisations"), F.array(F.lit("inferred")).alias("inferred"))
    defaults = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("org_id"), F.array(F.lit("default")).alias("defaults"))
    return M.repair_source_defaults(rows, defaults).select("c_custkey", F.array_join("specialisations", "|").alias("terms"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 4 = 0")
def j18_missing_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.missing_references(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0"), "c_custkey").select("o_orderkey", "o_custkey")


@query("""SELECT 'id.unique' AS rule, CAST(s_nationkey AS VARCHAR) AS key FROM supplier GROUP BY s_nationkey HAVING count(*) > 1 UNION ALL SELECT 'type.vocabulary', CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_suppkey % 7 = 0
UNION ALL SELECT 'country_code.reference', CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT 'disabled_reason.required', CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 2 = 0""")
def v5_registry_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.when(k % 7 == 0, "other").otherwise("ngo").alias("type"), (k % 3 != 0).alias("enabled"),
        F.when(k % 2 == 0, " ").otherwise("closed").alias("disabled_reason"), F.when(k % 5 == 0, "ZZ").otherwise("KE").alias("country_code"),
    )
    return V.registry_violations(rows, ["ngo"], R.country_table(spark))


@query("""SELECT 'source_id.unique' AS rule, CAST(s_nationkey AS VARCHAR) AS key FROM supplier GROUP BY s_nationkey HAVING count(*) > 1
UNION ALL SELECT 'confidence.vocabulary', CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_suppkey % 4 = 0""")
def v6_source_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("source_id"), F.col("s_name").alias("domain"), F.when(F.col("s_suppkey") % 4 == 0, "rumour").otherwise("official").alias("source_confidence"))
    return V.source_violations(rows)


# A rule, the divisor of the keys that break it, the column it is about, and its values where the key is so divided and elsewhere.
_BROKEN = [
    ("org_type.vocabulary", 3, "org_type", "'club'", "'ngo'"),
    ("location_scope.vocabulary", 4, "location_scope", "'village'", "'local'"),
    ("education_required.vocabulary", 6, "education_required", "'school'", "'none'"),
    ("source_confidence.vocabulary", 7, "source_confidence", "CAST(NULL AS STRING)", "'official'"),
    ("source_url.url", 8, "source_url", "'ftp://a.test'", "'https://a.test/x'"),
    ("apply_url.url", 9, "apply_url", "'http://'", "'HTTP://b.test'"),
    ("org_id.identifier", 10, "org_id", "'A b'", "'a-b_c'"),
    ("posted_at.iso", 11, "posted_at", "'May 4'", "'2024-05-04T10:00:00Z'"),
    ("flags.vocabulary", 12, "flags", "array('urgent', 'loud')", "array('urgent')"),
    ("years_experience_max.range", 13, "years_experience_max", "51", "50"),
    ("eligibility.status.vocabulary", 14, "eligibility", "named_struct('status', 'maybe', 'confidence', 0.5D)", "named_struct('status', 'eligible', 'confidence', 1D)"),
    ("africa_relevance.confidence.range", 15, "africa_relevance", "named_struct('confidence', CAST(NULL AS DOUBLE))", "CAST(NULL AS STRUCT<confidence: DOUBLE>)"),
    ("investment_profile.role_family", 16, "investment_profile", "named_struct('is_investment_role', true)", "named_struct('is_investment_role', false)"),
    ("ngo_profile.is_ngo_or_un.required", 17, "ngo_profile", "named_struct('is_ngo_or_un', CAST(NULL AS BOOLEAN))", "named_struct('is_ngo_or_un', true)"),
    ("government_profile.eligible_nationalities.strings", 18, "government_profile", "named_struct('eligible_nationalities', CAST(NULL AS ARRAY<STRING>))", "named_struct('eligible_nationalities', array('KE'))"),
    ("institution_profile.dfi_type", 19, "institution_profile", "named_struct('is_dfi_or_multilateral', true, 'institution_type', 'university')", "named_struct('is_dfi_or_multilateral', true, 'institution_type', 'dfi')"),
    ("public_institution_profile.country", 21, "public_institution_profile", "named_struct('is_public_institution', true, 'country_code', 'UG')", "named_struct('is_public_institution', true, 'country_code', 'KE')"),
]


@query(" UNION ALL ".join(f"SELECT CAST(o_orderkey AS VARCHAR) AS id, '{rule}' AS rule, 'error' AS severity FROM orders WHERE o_orderkey % {n} = 0" for rule, n, *_ in _BROKEN))
def v1_profile_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of places, sources and profiles over one posting for each order; a row breaks several."""
    told = [F.expr(f"IF(o_orderkey % {n} = 0, {bad}, {good})").alias(c) for _, n, c, bad, good in _BROKEN]
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.lit("banking_and_finance").alias("role_family"), *told)
    return V.violations(rows)


@query("""SELECT 'id.missing' AS "check", CAST(0 AS BIGINT) AS failures UNION ALL SELECT 'title.missing', count(*) FROM orders WHERE o_orderkey % 6 = 0 UNION ALL SELECT 'snapshot.stale', 1 UNION ALL SELECT 'snapshot.future', 0""")
def v7_publication_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).otherwise(" ").alias("title"))
    at = lambda s: F.lit(s).cast("timestamp")
    return V.publication_checks(rows, at("2026-01-01"), at("2026-01-03"), ["id", "title"])


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, unnest(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'meta.feed_version.required' END, CASE WHEN o_orderkey % 4 = 0 THEN 'meta.generated_at.iso' END, CASE WHEN o_orderkey % 5 = 0 THEN 'meta.ngo_classifier_version' END], lambda x: x IS NOT NULL)) AS rule, 'error' AS severity FROM orders""")
def v3_meta_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    fixed = F.create_map(F.lit("supported_languages"), F.lit("sw,ar,en,pt,fr"), F.lit("ngo_classifier_version"), F.when(k % 5 == 0, "2.0").otherwise("1.1"), F.lit("generated_at"), F.when(k % 4 == 0, "yesterday").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    meta = F.when(k % 3 == 0, fixed).otherwise(F.map_concat(fixed, F.create_map(F.lit("feed_version"), F.lit("9"))))
    return V.meta_violations(table(spark, sf_dir, "orders").select(k.alias("id"), meta.alias("meta")))


# ------------------------------------------------------------------ reports
@query("SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 1 ORDER BY count(*) DESC, min(o_orderkey) LIMIT 1")
def w4_most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.most_common(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


@query("SELECT event_type AS source, CASE WHEN event_type < 'm' THEN 'error: timeout' ELSE 'skipped: no key' END AS status FROM (SELECT DISTINCT event_type FROM events)")
def a15_source_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("source")).distinct()
    health = kinds.select("source", F.when(F.col("source") < "m", "error: timeout").otherwise("skipped: no key").alias("status")).union(kinds.select(F.upper("source"), F.lit("ok")))
    return A.source_errors(health)


_LEVELS = """CASE relevance WHEN 'africa_based_confirmed' THEN 'certified' WHEN 'non_african' THEN 'excluded' ELSE 'unverified' END AS relevance_level,
CASE WHEN access LIKE 'confirmed%' THEN 'certified' WHEN access IN ('work_authorisation_required', 'likely_open') THEN 'conditional' ELSE 'unverified' END AS access_level"""


@query(f"WITH e AS ({E.CHAIN.sql()}) SELECT {_LEVELS}, count(*) AS count FROM e GROUP BY ALL")
def a5_certification_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.certification_cross(E.enriched(spark, sf_dir))


_SHOWN = {"by_role_family": "coalesce(role_family, 'unknown')", "by_investment_classification": "investment", "by_ngo_classification": "ngo", "by_africa_relevance": "relevance", "by_african_applicant_access": "access", "by_source": "coalesce(source_id, 'Unknown')", "by_eligibility_status": "legacy"}


@query(f"WITH e AS ({E.CHAIN.sql()}) " + " UNION ALL ".join(f"SELECT '{name}' AS dimension, {value} AS value, count(*) AS count FROM e GROUP BY ALL" for name, value in _SHOWN.items()))
def a1_report_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimensions of the report are counted; the SQL states those that the chain's results name."""
    none = F.lit(None).cast("string")
    rows = E.enriched(spark, sf_dir).withColumns({"opportunity_type": none, "location_language": none, "org_priority": F.lit(None).cast("boolean")})
    return A.counters(rows, A.coverage_dimensions(), {"by_thematic_sector": F.col("thematic_sectors")}).where(F.col("dimension").isin(list(_SHOWN))).select("dimension", "value", "count")


@query(f"""WITH e AS ({E.CHAIN.sql()}) SELECT field, count, round(100.0 * count / total, 1) AS percent FROM (SELECT unnest(['country_code', 'role_family', 'organisation_registry_id', 'source_registry_id']) AS field,
unnest([count(country_code), count(role_family), count(org_id), count(source_id)]) AS count, count(*) AS total FROM e)""")
def a6_report_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.enriched(spark, sf_dir)
    return A.completeness(rows, A.completeness_fields(rows.columns)).where("field in ('country_code', 'role_family', 'organisation_registry_id', 'source_registry_id')")


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older snapshot of postings, each an opening of its own."""
    from jobloom.plans.cases import _dealt, spread

    k = F.col("o_orderkey")
    row = F.pmod(k, F.lit(E.CHAIN.n)).cast("int")
    told = {c: _dealt(v, row) for c, v in E._IN.items()}
    told |= {"title": F.concat_ws(" ", told["title"], k.cast("string")), "apply_url": F.concat(F.lit("https://a.test/"), k.cast("string")), "source_url": F.lit("https://boards.example.com/list")}
    return spread(table(spark, sf_dir, "orders").select("o_orderkey")).select(k.cast("long").alias("pos"), k.cast("string").alias("id"), *(v.alias(c) for c, v in told.items()))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Clerk ' || o_orderkey AS title, 'Plain Foods' AS organisation, 'Tashkent, UZ' AS location, 'known_non_african_without_africa_remit' AS reason FROM orders WHERE o_orderkey % 8 = 5")
def u3_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the upgrade of an older snapshot rejects, with the audit."""
    return upgrade(_snapshot(spark, sf_dir))["rejected"]


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 8 IN (5, 7) THEN 'rejected' ELSE 'kept' END AS outcome FROM orders")
def u5_migrate_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, rejected = migrate_baseline(_snapshot(spark, sf_dir))
    return kept.select("id", F.lit("kept").alias("outcome")).union(rejected.select("id", F.lit("rejected")))
