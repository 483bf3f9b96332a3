"""Coverage reports: one pass that counts all dimensions, completeness, summaries and source health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.extract import percent
from jobloom.operators.lexicon import whole


def _label(value: Column, missing: str) -> Column:
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit(missing))


def bucket(value: Column, edges: list[tuple[float, str]], low: str) -> Column:
    """A3: the first label whose lower edge the value reaches; "unknown" if it is null."""
    out = F.when(value.isNull(), "unknown")
    for edge, name in edges:
        out = out.when(value >= edge, name)
    return out.otherwise(low)


LOCATION_BUCKETS = ([(0.9, "high_0.90_plus"), (0.6, "medium_0.60_0.89")], "low_below_0.60")
INVESTMENT_BUCKETS = ([(0.85, "high_0.85_plus"), (0.65, "medium_0.65_0.84")], "low_below_0.65")


def counters(postings: DataFrame, dimensions: dict[str, tuple[Column, str]], arrays: dict[str, Column] | None = None) -> DataFrame:
    """A1, A2: (dimension, value, count, rank), largest count first, then by value.

    dimensions: name -> (column, label for null and empty); arrays: name -> column of many values. All
    dimensions are counted in one pass: each row becomes one small row for each dimension, summed
    on the way into the shuffle.
    """
    from pyspark.sql import Window

    names = [*dimensions, *(arrays or {})]
    single = [F.array(*(_entry(i)(_label(value, missing)) for i, (value, missing) in enumerate(dimensions.values())))] if dimensions else []
    flat = [*single, *(F.transform(F.coalesce(value, F.array().cast("array<string>")), _entry(i)) for i, value in enumerate((arrays or {}).values(), len(dimensions)))]
    # Made before explode(), which would interpret how it is made; dimensions have numbers until they are counted.
    each = postings.select(whole(F.concat(*flat)).alias("all")).select(F.explode("all").alias("d"))
    counted = each.groupBy("d.nth", "d.value").agg(F.count("*").alias("count")).select(F.element_at(F.array(*map(F.lit, names)), F.col("nth") + 1).alias("dimension"), "value", "count")
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("count"), "value")))


def coverage_dimensions(resolution: Column | None = None) -> dict[str, tuple[Column, str]]:
    """A1: the 34 single-valued dimensions of the coverage report over enriched postings, and the label of what is missing.

    resolution is A4's location_resolution() where the table has its columns.
    """
    c = F.col
    word = lambda flag: F.when(F.coalesce(flag, F.lit(False)), "priority").otherwise("other")
    investment, institution, ngo = c("investment_profile"), c("institution_profile"), c("ngo_profile")
    multinational, relevance, access = c("multinational_profile"), c("africa_relevance"), c("african_applicant_access")
    level = lambda p: _label(p["certification_level"], "missing")
    found = {
        "by_source": (c("source_name"), "Unknown"), "by_source_confidence": (c("source_confidence"), "unknown"), "by_organisation_type": (c("org_type"), "unknown"),
        "by_opportunity_type": (c("opportunity_type"), "unknown"), "by_industry": (c("industry"), "unknown"), "by_country": (F.coalesce("loc.country", "location_country"), "unknown"),
        "by_location_scope": (c("location_scope"), "unknown"), "by_work_mode": (c("work_mode"), "unknown"), "by_role_family": (c("role_family"), "unknown"),
        "by_eligibility_status": (c("eligibility.status"), "unknown"), "by_city": (c("loc.city"), "unknown"), "by_region_canonical": (c("loc.region"), "unknown"),
        "by_location_language": (c("location_language"), "unknown"), "by_location_confidence": (bucket(c("loc.confidence"), *LOCATION_BUCKETS), "unknown"), "by_admin_area": (c("loc.admin_area"), "unknown"),
        "by_investment_classification": (investment["classification"], "unknown"), "by_investment_track": (investment["track"], "none"), "by_dfi_relevance": (investment["dfi_relevance"], "unknown"),
        "by_investment_confidence": (bucket(investment["confidence"], *INVESTMENT_BUCKETS), "unknown"), "by_institution_type": (institution["institution_type"], "unknown"),
        "by_institution_source_pack": (institution["source_pack"], "none"), "by_institution_priority": (word(institution["priority_institution"]), "other"),
        "by_ngo_classification": (ngo["classification"], "unknown"), "by_ngo_track": (ngo["track"], "none"), "by_ngo_organisation_group": (ngo["organisation_group"], "other"),
        "by_ngo_priority": (word((institution["source_pack"] == "ngo") & c("org_priority")), "other"), "by_public_institution_category": (c("public_institution_profile.category"), "none"),
        "by_multinational_sector": (multinational["sector"], "none"), "by_multinational_priority": (word(multinational["priority_employer"]), "other"),
        "by_africa_relevance": (relevance["status"], "missing"), "by_african_applicant_access": (access["status"], "missing"), "by_access_evidence_strength": (access["evidence_strength"], "missing"),
        "by_certification_level": (F.concat_ws("|", level(relevance), level(access)), "missing|missing"),
    }
    return found if resolution is None else found | {"by_location_resolution": (resolution, "unresolved")}


def certification_cross(postings: DataFrame) -> DataFrame:
    """A5: (relevance_level, access_level, count): the levels of both profiles against each other, "missing" for none."""
    level = lambda p: _label(F.col(f"{p}.certification_level"), "missing")
    return postings.groupBy(level("africa_relevance").alias("relevance_level"), level("african_applicant_access").alias("access_level")).agg(F.count("*").alias("count"))


def completeness_fields(columns: list[str]) -> dict[str, Column]:
    """The predicates of the completeness report, as far as the table has their columns."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    there = lambda c: F.col(c).isNotNull()
    tests = {
        "country": F.coalesce(given("loc.country"), F.lit(False)) | given("location_country"), "work_mode": given("work_mode"), "industry": given("industry"), "specialisations": some("specialisations"),
        "seniority": given("seniority"), "years_experience": there("years_experience_min"), "education_required": given("education_required"), "contract_type_known": given("contract_type") & (F.col("contract_type") != "unknown"),
        "deadline": there("deadline"), "skills_required": some("skills_required"), "compensation": there("compensation"), "eligibility_notes": given("eligibility_notes"), "official_apply_url": flag("apply_is_official"),
        "organisation_registry_id": given("org_id"), "country_code": given("loc.country_code"), "city": given("loc.city"), "role_family": given("role_family"), "thematic_sectors": some("thematic_sectors"),
        "eligibility_evidence": some("eligibility.evidence"), "meaningful_eligibility_evidence": F.coalesce(F.col("african_applicant_access.evidence_strength") != "none", F.lit(False)),
        "africa_relevance_profile": there("africa_relevance"), "african_applicant_access_profile": there("african_applicant_access"), "source_registry_id": given("source_id"), "country_iso3": given("loc.country_iso3"),
        "admin_area": given("loc.admin_area"), "coordinates": there("loc.lat") & there("loc.lon"), "location_evidence": some("loc.evidence"), "location_language": given("location_language"),
        "eligibility_language": given("eligibility_language"), "investment_profile": there("investment_profile"), "investment_evidence": some("investment_profile.evidence") | some("investment_profile.negative_evidence"),
        "institution_profile": there("institution_profile"), "institution_registry_id": given("institution_profile.registry_id"), "public_institution_profile": there("public_institution_profile"), "multinational_profile": there("multinational_profile"),
    }
    needs = {
        "country": "loc", "years_experience": "years_experience_min", "contract_type_known": "contract_type", "official_apply_url": "apply_is_official", "organisation_registry_id": "org_id", "country_code": "loc", "city": "loc",
        "eligibility_evidence": "eligibility", "meaningful_eligibility_evidence": "african_applicant_access", "africa_relevance_profile": "africa_relevance", "african_applicant_access_profile": "african_applicant_access",
        "source_registry_id": "source_id", "country_iso3": "loc", "admin_area": "loc", "coordinates": "loc", "location_evidence": "loc", "investment_evidence": "investment_profile", "institution_registry_id": "institution_profile",
    }
    return {name: test for name, test in tests.items() if needs.get(name, name) in columns}


def most_common(rows: DataFrame, column: str, order: str) -> DataFrame:
    """One row (value, count): the value on most rows; of equal ones the one that comes first in the given order. Nulls don't count."""
    counted = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"), F.min(order).alias("first"))
    return counted.orderBy(F.desc("count"), "first").limit(1).select("value", "count")


def _entry(nth: int):
    return lambda value: F.struct(F.lit(nth).alias("nth"), value.alias("value"))


def completeness(postings: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, count, percent) of rows for which a predicate holds, in one aggregation."""
    one = postings.agg(F.count("*").alias("total"), *(F.count_if(p).alias(f"f{i}") for i, p in enumerate(fields.values())))
    rows = one.select("total", F.explode(F.array(*(F.struct(F.lit(name).alias("field"), F.col(f"f{i}").alias("count")) for i, name in enumerate(fields)))).alias("x"))
    return rows.select("x.field", "x.count", percent("x.count", "total").alias("percent"))


def summary(postings: DataFrame, distinct: dict[str, Column], conditions: dict[str, Column]) -> DataFrame:
    """One row: total, distinct values (null and empty don't count), rows that meet conditions."""
    present = {name: F.nullif(value.cast("string"), F.lit("")) for name, value in distinct.items()}
    return postings.agg(F.count("*").alias("opportunity_count"), *(F.countDistinct(v).alias(n) for n, v in present.items()), *(F.count_if(c).alias(n) for n, c in conditions.items()))


def feed_meta(postings: DataFrame, source: str = "source_name") -> DataFrame:
    """opportunity_count and source_count."""
    return postings.agg(F.count("*").alias("opportunity_count"), F.countDistinct(source).alias("source_count"))


def _part(condition: Column, dimensions: dict[str, tuple[Column, str]]):
    def report(postings: DataFrame) -> DataFrame:
        return counters(postings.where(condition), dimensions)

    return report


def investment_report(postings: DataFrame) -> DataFrame:
    """Investment roles by class, track, country, source and confidence."""
    p = F.col("investment_profile")
    return _part(p["is_investment_role"], {"classification": (p["classification"], "unknown"), "track": (p["track"], "none"), "country": (F.col("loc.country_code"), "unknown"), "source": (F.col("source_name"), "Unknown"), "confidence": (bucket(p["confidence"], *INVESTMENT_BUCKETS), "unknown")})(postings)


def dfi_report(postings: DataFrame) -> DataFrame:
    """Rows of development banks, multilaterals and investors."""
    p = F.col("institution_profile")
    return _part(p["is_dfi_or_multilateral"], {"institution_type": (p["institution_type"], "unknown"), "institution": (p["registry_id"], "unregistered"), "source_pack": (p["source_pack"], "none"), "relevance": (F.col("investment_profile.dfi_relevance"), "unknown")})(postings)


def ngo_report(postings: DataFrame) -> DataFrame:
    """A10: rows of NGOs and UN agencies, and programme roles anywhere."""
    p = F.col("ngo_profile")
    return _part(p["is_ngo_or_un"] | p["is_programme_role"], {"classification": (p["classification"], "unknown"), "track": (p["track"], "none"), "group": (p["organisation_group"], "other")})(postings)


def government_report(postings: DataFrame) -> DataFrame:
    """Rows of governments and public services."""
    p = F.col("government_profile")
    return _part(p["is_government_or_public_service"], {"institution": (p["registry_id"], "unregistered"), "grade": (p["public_service_grade"], "not_stated"), "country": (F.col("loc.country_code"), "unknown"), "citizenship": (p["citizenship_required"].cast("string"), "unknown")})(postings)


def public_institution_report(postings: DataFrame, registry: DataFrame) -> DataFrame:
    """Per category: institutions configured and enabled, and postings. registry: (category, enabled)."""
    p = F.col("public_institution_profile")
    have = postings.where(p["is_public_institution"]).groupBy(_label(p["category"], "none").alias("category")).agg(F.count("*").alias("postings"))
    want = registry.groupBy("category").agg(F.count("*").alias("configured"), F.count_if("enabled").alias("enabled"))
    return want.join(have, "category", "full").select("category", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("configured", "enabled", "postings")))


def multinational_report(postings: DataFrame, registry: DataFrame) -> DataFrame:
    """(kind, value, configured, postings) by sector and by city of the registry. registry: (id, sector, cities)."""
    p = F.col("multinational_profile")
    ours = postings.where(p["is_multinational"])
    both = F.array(*(F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in (("sector", _label(p["sector"], "none")), ("city", F.col("loc.city")))))
    # Not a union of the rows' two counts: each part would plan and run the chain that made the rows.
    have = ours.select(F.explode(both).alias("x")).select("x.kind", "x.value").where("value is not null").groupBy("kind", "value").agg(F.count("*").alias("postings"))
    want = registry.select(F.lit("sector").alias("kind"), _label(F.col("sector"), "none").alias("value")).union(registry.select(F.lit("city"), F.explode("cities"))).groupBy("kind", "value").agg(F.count("*").alias("configured"))
    return want.join(have, ["kind", "value"], "full").select("kind", "value", F.coalesce("configured", F.lit(0)).alias("configured"), F.coalesce("postings", F.lit(0)).alias("postings"))


def source_health(counts: DataFrame, runs: DataFrame, configured: DataFrame) -> DataFrame:
    """(source, status, count, configured) over everything that was counted, run or configured; without
    a run the status follows from the count."""
    full = counts.select("source", F.col("count").alias("n")).join(runs.select("source", "status"), "source", "full").join(configured.select("source", F.lit(True).alias("configured")), "source", "full")
    n = F.coalesce("n", F.lit(0))
    return full.select("source", F.coalesce("status", F.when(n > 0, "ok").otherwise("empty")).alias("status"), n.alias("count"), F.coalesce("configured", F.lit(False)).alias("configured"))


def health_totals(health: DataFrame) -> DataFrame:
    """Sources and rows by the status's first word (ok, empty, skipped, error)."""
    return health.groupBy(F.substring_index("status", ":", 1).alias("status")).agg(F.count("*").alias("sources"), F.sum("count").alias("rows"))


def source_errors(health: DataFrame) -> DataFrame:
    """Sources that failed or were skipped."""
    return health.where(F.col("status").rlike("^(error|skipped)"))


def counts_by_prefix(postings: DataFrame, specs: DataFrame) -> DataFrame:
    """Rows of a snapshot by their id's first part, for every spec (prefix, source)."""
    counted = postings.groupBy(F.split("id", "-")[0].alias("prefix")).agg(F.count("*").alias("count"))
    return specs.join(counted, "prefix", "left").select("source", F.coalesce("count", F.lit(0)).alias("count"))


def registry_inventory(rows: DataFrame, flags: dict[str, Column], groupings: dict[str, Column], name: str = "registry") -> DataFrame:
    """(metric, value, count) over a registry in one pass of grouping sets: how many entries it has, how many of
    them each flag holds for, and how many there are of each value of each grouping ("none" for null).

    flags count rows where they are true. A grouping set for each grouping and one for all rows share one scan
    and one partial aggregation; values come back as rows, however many there are.
    """
    keys = [f"g{i}" for i in range(len(groupings))]
    told = rows.select(*(F.coalesce(c.cast("string"), F.lit("none")).alias(k) for k, c in zip(keys, groupings.values(), strict=True)), *(F.coalesce(c, F.lit(False)).alias(f"f{i}") for i, c in enumerate(flags.values())))
    counted = told.groupingSets([[], *([told[k]] for k in keys)], *(told[k] for k in keys)).agg(
        F.grouping_id().alias("sets"), F.count("*").alias("entries"), *(F.count_if(f"f{i}").alias(f"n{i}") for i in range(len(flags)))
    )
    whole = (1 << len(keys)) - 1
    line = lambda metric, value, count: F.struct(metric.alias("metric"), value.alias("value"), count.cast("long").alias("count"))
    totals = F.array(line(F.lit(name), F.lit("entries"), F.col("entries")), *(line(F.lit(name), F.lit(f), F.col(f"n{i}")) for i, f in enumerate(flags)))
    # In a set of one grouping only that grouping's bit is 0.
    of_group = [F.when(F.col("sets") == whole - (1 << (len(keys) - 1 - i)), F.array(line(F.lit(f"{name}.{g}"), F.col(k), F.col("entries")))) for i, (k, g) in enumerate(zip(keys, groupings, strict=True))]
    return counted.select(F.explode(F.when(F.col("sets") == whole, totals).otherwise(F.coalesce(*of_group)) if of_group else totals).alias("x")).select("x.*")
