"""Validation of rows and tables into violations, gates on metrics, and the certified subset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.extract import percent
from jobloom.operators.predicates import CERTIFIED_RELEVANCE, certified_default, location_resolution
from jobloom.operators.row_rules import CONFIDENCES, blank, row_rules

def _not_in(c: str, allowed: list[str]) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(allowed)


def violations(rows: DataFrame, rules: dict[str, Column] | None = None, id_col: str = "id", severity: str = "error") -> DataFrame:
    """V1, V3: one row for each rule that a row violates: (id, rule, severity). Every violation counts, not just the first."""
    rules = row_rules(rows.schema) if rules is None else rules
    broken = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())))
    return rows.select(F.col(id_col).cast("string").alias("id"), F.explode(broken).alias("rule")).withColumn("severity", F.lit(severity))


#: Versions that a feed's meta data may name.
META_VERSIONS = {
    "location_registry_version": ["2.0"], "investment_taxonomy_version": ["1.0"], "investment_classifier_version": ["1.0"], "dfi_source_pack_version": ["1.0"], "enterprise_adapter_version": ["1.0", "1.1"],
    "ngo_source_pack_version": ["1.0"], "ngo_taxonomy_version": ["1.0"], "ngo_classifier_version": ["1.0", "1.1"], "official_vacancy_quality_version": ["1.0", "1.1"], "government_source_pack_version": ["1.0"],
    "government_schema_version": ["1.0"], "kenya_public_institutions_version": ["1.0"], "multinational_source_pack_version": ["1.0"], "africa_access_certification_version": ["1.0"],
    "government_deduplication_version": ["3.0"], "eligibility_evidence_version": ["2.0"],
}
EXTRACTION_LANGUAGES = ["ar", "en", "fr", "pt", "sw"]


def meta_violations(metas: DataFrame, meta: str = "meta", id_col: str = "id") -> DataFrame:
    """V3: (id, rule, severity) over feeds' meta data, a map of strings: required fields, ISO times, languages, versions.

    A key that isn't there breaks no rule but "required"; supported_languages is a list joined by commas.
    """
    at = lambda key: F.try_element_at(F.col(meta), F.lit(key))
    present = lambda key: F.array_contains(F.map_keys(meta), key)
    iso = lambda key: at(key).rlike(r"^\d{4}-\d\d-\d\d(T\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:\d\d)?)?$") & at(key).try_cast("timestamp").isNotNull()
    rules = {f"meta.{key}.required": ~present(key) for key in ("feed_version", "generated_at")}
    rules["meta.generated_at.iso"] = present("generated_at") & ~F.coalesce(iso("generated_at"), F.lit(False))
    rules["meta.next_expected_update.iso"] = at("next_expected_update").isNotNull() & ~F.coalesce(iso("next_expected_update"), F.lit(False))
    spoken = F.array_sort(F.array_distinct(F.split(F.coalesce(at("supported_languages"), F.lit("")), ",")))
    rules["meta.supported_languages"] = present("supported_languages") & (spoken != F.lit(EXTRACTION_LANGUAGES))
    rules |= {f"meta.{key}": present(key) & ~F.coalesce(at(key).isin(known), F.lit(False)) for key, known in META_VERSIONS.items()}
    return violations(metas, rules, id_col)


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """V2, U8: keys that are on more than one row, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("count")).where("count > 1")


def declared_count(rows: DataFrame, declared: DataFrame, column: str = "opportunity_count") -> DataFrame:
    """V2: (declared, actual, ok)."""
    return declared.select(F.col(column).alias("declared")).crossJoin(rows.agg(F.count("*").alias("actual"))).withColumn("ok", F.col("declared") == F.col("actual"))  # two single rows


def unknown_terms(rows: DataFrame, terms: str, vocabulary: DataFrame, id_col: str = "id") -> DataFrame:
    """V4: terms that aren't in the vocabulary, as warnings. vocabulary: (term)."""
    used = rows.select(F.col(id_col).cast("string").alias("id"), F.explode(terms).alias("term"))
    return used.join(vocabulary.select("term"), "term", "left_anti").withColumn("severity", F.lit("warning"))


def registry_violations(organisations: DataFrame, types: list[str], countries: DataFrame) -> DataFrame:
    """V5: (rule, key) over a registry (id, name, type, enabled, disabled_reason, country_code): unique ids and
    names, known types, known countries, a reason for what is disabled."""
    dup = lambda c: duplicate_keys(organisations, c).select(F.lit(f"{c}.unique").alias("rule"), F.col(c).alias("key"))
    kinds = organisations.where(_not_in("type", types)).select(F.lit("type.vocabulary"), "id")
    lands = organisations.where(F.col("country_code").isNotNull()).join(countries.select(F.col("iso2").alias("country_code")), "country_code", "left_anti").select(F.lit("country_code.reference"), "id")
    why = organisations.where(~F.col("enabled") & blank("disabled_reason")).select(F.lit("disabled_reason.required"), "id")
    return dup("id").union(dup("name")).union(kinds).union(lands).union(why)


def source_violations(sources: DataFrame) -> DataFrame:
    """V6: (rule, key) over the source registry: unique ids and domains, known confidence."""
    dup = lambda c: duplicate_keys(sources.where(F.col(c).isNotNull()), c).select(F.lit(f"{c}.unique").alias("rule"), F.col(c).alias("key"))
    return dup("source_id").union(dup("domain")).union(sources.where(_not_in("source_confidence", CONFIDENCES)).select(F.lit("confidence.vocabulary"), "source_id"))


def publication_checks(rows: DataFrame, generated_at: Column, as_of: Column, required: list[str], max_age_hours: int = 24) -> DataFrame:
    """V7: (check, failures): missing fields, and whether the snapshot is fresh (old, or over 5 minutes ahead)."""
    age = (F.unix_timestamp(as_of) - F.unix_timestamp(generated_at)) / 60
    fields = [F.count_if(blank(c)).alias(f"{c}.missing") for c in required]
    one = rows.agg(*fields, F.lit((age > 60 * max_age_hours).cast("long")).alias("snapshot.stale"), F.lit((age < -5).cast("long")).alias("snapshot.future"))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("failures")) for c in one.columns))).alias("x")).select("x.*")


def coverage_gates(postings: DataFrame, gates: dict, severity: str = "error") -> DataFrame:
    """(gate, value, limit, severity, passed). postings: as for location_resolution(), and region, source_name.

    gates: minimum_by_region {region: rows}, max_unresolved_location_percent, max_official_location_pending_percent,
    max_single_country_percent, max_single_source_percent, minimum_official_apply_records.
    """
    rows = postings.withColumn("state", location_resolution())
    one = rows.agg(F.count("*").alias("total"), F.count_if(F.col("state") == "unresolved").alias("unresolved"), F.count_if(F.col("state") == "official_location_pending").alias("pending"), F.count_if("apply_is_official").alias("official"))
    top = lambda c: rows.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("k")).count().agg(F.max("count").alias(f"top_{c}"))
    full = one.crossJoin(top("country_code")).crossJoin(top("source_name"))  # single rows
    share = lambda c: F.when(F.col("total") > 0, 100 * F.coalesce(c, F.lit(0)) / F.col("total")).otherwise(0.0)
    checks = {
        "max_unresolved_location_percent": (share("unresolved"), False), "max_official_location_pending_percent": (share("pending"), False), "max_single_country_percent": (share("top_country_code"), False),
        "max_single_source_percent": (share("top_source_name"), False), "minimum_official_apply_records": (F.col("official").cast("double"), True),
    }
    line = lambda name, value, limit, floor: F.struct(F.lit(name).alias("gate"), value.cast("double").alias("value"), F.lit(float(limit)).alias("limit"), (value >= limit if floor else value <= limit).alias("passed"))
    wanted = [line(name, value, gates[name], floor) for name, (value, floor) in checks.items() if name in gates]
    out = full.select(F.explode(F.array(*wanted)).alias("g")).select("g.*") if wanted else None
    floors = gates.get("minimum_by_region") or {}
    if floors:
        spark = postings.sparkSession
        need = spark.createDataFrame([(k, float(v)) for k, v in floors.items()], "region string, limit double")
        found = need.join(rows.groupBy("region").agg(F.count("*").cast("double").alias("n")), "region", "left").withColumn("n", F.coalesce("n", F.lit(0.0)))
        by_region = found.select(F.concat(F.lit("minimum_by_region."), "region").alias("gate"), F.col("n").alias("value"), "limit", (F.col("n") >= F.col("limit")).alias("passed"))
        out = by_region if out is None else out.union(by_region)
    return out.withColumn("severity", F.lit(severity))


def certification_gates(postings: DataFrame, destructive_loss_percent: Column | float = 0.0, live: bool = True) -> DataFrame:
    """(gate, value, limit, severity, passed) over enriched postings."""
    relevance, access, public = F.col("africa_relevance"), F.col("african_applicant_access"), F.col("government_profile")
    strong = ["explicit", "structured_source", "strong_inference"]
    one = postings.agg(
        F.count("*").alias("total"),
        F.count_if(relevance.isNull() | access.isNull()).alias("missing_profiles"),
        F.count_if(relevance["status"] == "non_african").alias("published_non_african"),
        F.count_if(certified_default() & ~relevance["status"].isin(CERTIFIED_RELEVANCE)).alias("default_without_relevance"),
        F.count_if((access["status"] == "likely_open") & ~F.coalesce(access["evidence_strength"], F.lit("none")).isin(strong)).alias("weak_likely_open"),
        F.count_if(public["citizenship_required"] & (F.size(F.coalesce(public["eligible_nationalities"], F.array().cast("array<string>"))) == 0)).alias("citizenship_without_codes"),
        F.count_if(relevance["status"] == "official_location_pending").alias("pending"),
        F.count_if(relevance["status"] == "unresolved").alias("unresolved"),
        F.count_if(certified_default()).alias("certified"),
    )
    loss = destructive_loss_percent if isinstance(destructive_loss_percent, Column) else F.lit(float(destructive_loss_percent))
    line = lambda name, value, limit, severity, ok=None: F.struct(F.lit(name).alias("gate"), value.cast("double").alias("value"), F.lit(float(limit)).alias("limit"), F.lit(severity).alias("severity"), (value <= limit if ok is None else ok).alias("passed"))
    zero = ["missing_profiles", "published_non_african", "default_without_relevance", "weak_likely_open", "citizenship_without_codes"]
    lines = [line(c, F.col(c), 0, "error") for c in zero] + [
        line("destructive_government_loss_percent", loss, 5, "error"), line("pending_percent", percent("pending", "total"), 10, "warning"), line("unresolved_percent", percent("unresolved", "total"), 2, "warning"),
        line("certified_rows", F.col("certified"), 1, "error" if live else "warning", (F.col("certified") > 0) | (F.col("total") == 0 if live else F.lit(False))),
    ]
    return one.select(F.explode(F.array(*lines)).alias("g")).select("g.*")


def certified_subset(postings: DataFrame) -> DataFrame:
    """The rows that are certified by default."""
    return postings.where(certified_default())
