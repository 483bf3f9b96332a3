"""Faceted search over a slim table: one conjunction of filters, facet counts, sorting and pages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.operators.predicates import certified_view
from jobloom.operators.reports import counters

PAGE = 30
SUMMARY = 260
KEYWORD_FIELDS = [
    "title", "org", "summary", "industry", "role_family", "role_subfamily", "org_type", "eligibility", "investment_track", "investment_classification", "dfi_relevance", "institution_type",
    "ngo_classification", "ngo_track", "ngo_organisation_group", "africa_relevance", "african_applicant_access",
]
LOCATION_FIELDS = ["loc_raw", "city", "country", "country_code"]
#: Contract -> type of job.
JOB_TYPES = {"permanent": "full_time", "fixed_term": "contract", "contract": "contract", "consultant": "contract", "part_time": "part_time", "volunteer": "volunteer"}
HOURS = {"24h": 24, "week": 24 * 7, "month": 24 * 30}


def slim(postings: DataFrame) -> DataFrame:
    """The flat columns that search needs; columns that the table lacks become null."""
    have = dict(postings.dtypes)

    def at(path: str) -> Column:
        return F.col(path) if path.split(".")[0] in have else F.lit(None)

    text = {
        "id": "id", "title": "title", "type": "opportunity_type", "org": "org_name", "org_type": "org_type", "country": "loc.country", "country_code": "loc.country_code", "city": "loc.city", "loc_raw": "location_raw", "scope": "location_scope",
        "work_mode": "work_mode", "seniority": "seniority", "industry": "industry", "role_family": "role_family", "role_subfamily": "role_subfamily", "eligibility": "eligibility.status", "africa_relevance": "africa_relevance.status",
        "africa_certification_level": "africa_relevance.certification_level", "african_applicant_access": "african_applicant_access.status", "african_access_evidence_strength": "african_applicant_access.evidence_strength",
        "african_access_certification_level": "african_applicant_access.certification_level", "investment_classification": "investment_profile.classification", "investment_track": "investment_profile.track", "dfi_relevance": "investment_profile.dfi_relevance",
        "institution_type": "institution_profile.institution_type", "institution_registry_id": "institution_profile.registry_id", "institution_source_pack": "institution_profile.source_pack", "ngo_organisation_group": "ngo_profile.organisation_group",
        "ngo_classification": "ngo_profile.classification", "ngo_track": "ngo_profile.track", "public_service_grade": "government_profile.public_service_grade", "salary_scale": "government_profile.salary_scale",
        "advert_reference": "government_profile.advert_reference", "application_method": "government_profile.application_method", "public_institution_category": "public_institution_profile.category", "multinational_sector": "multinational_profile.sector",
        "education": "education_required", "contract": "contract_type", "source": "source_name", "confidence": "source_confidence", "apply_url": "apply_url",
    }
    flags = {
        "org_verified": "org_verified", "africa_default_visible": "africa_relevance.default_visible", "is_investment_role": "investment_profile.is_investment_role", "is_dfi_or_multilateral": "institution_profile.is_dfi_or_multilateral",
        "is_ngo_or_un": "ngo_profile.is_ngo_or_un", "ngo_is_programme_role": "ngo_profile.is_programme_role", "is_government_or_public_service": "government_profile.is_government_or_public_service", "citizenship_required": "government_profile.citizenship_required",
        "is_public_institution": "public_institution_profile.is_public_institution", "is_multinational": "multinational_profile.is_multinational", "priority_employer": "multinational_profile.priority_employer",
    }
    lists = {"thematic_sectors": "thematic_sectors", "eligibility_evidence": "eligibility.evidence", "african_access_nationalities": "african_applicant_access.eligible_nationalities", "african_city_footprint": "multinational_profile.african_city_footprint"}
    numbers = {"eligibility_confidence": "eligibility.confidence", "africa_relevance_confidence": "africa_relevance.confidence", "african_access_confidence": "african_applicant_access.confidence", "investment_confidence": "investment_profile.confidence", "ngo_confidence": "ngo_profile.confidence", "years_min": "years_experience_min", "years_max": "years_experience_max", "number_of_positions": "government_profile.number_of_positions"}
    three_valued = {"org_verified", "citizenship_required"}
    certified = certified_view() if {"africa_relevance", "african_applicant_access"} <= set(have) else F.lit(False)
    return postings.select(
        *(at(p).cast("string").alias(n) for n, p in text.items()),
        *((at(p).cast("boolean") if n in three_valued else F.coalesce(at(p).cast("boolean"), F.lit(False))).alias(n) for n, p in flags.items()),
        *(F.coalesce(at(p).cast("array<string>"), F.array().cast("array<string>")).alias(n) for n, p in lists.items()),
        *(at(p).cast("double").alias(n) for n, p in numbers.items()),
        at("posted_at").cast("timestamp").alias("posted"), at("deadline").cast("timestamp").alias("deadline"), F.substring(F.coalesce(at("summary").cast("string"), F.lit("")), 1, SUMMARY).alias("summary"), certified.alias("certified_default_view"),
    )


def job_type() -> Column:
    kinds = F.create_map(*(F.lit(x) for item in JOB_TYPES.items() for x in item))
    return F.when(F.col("type").isNotNull() & (F.col("type") != "job"), F.col("type")).otherwise(F.try_element_at(kinds, F.col("contract")))


def remote_bucket() -> Column:
    return F.when(F.col("work_mode").isin("onsite", "hybrid"), F.col("work_mode")).when(F.col("work_mode").isNotNull(), "remote")


def certification_scope() -> Column:
    return F.when(F.col("certified_default_view"), "certified").when(F.col("africa_default_visible"), "africa_unverified").otherwise("broader_index")


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)).cast("string")


def facets() -> dict[str, Column]:
    """Q4, Q5: the 25 facets."""
    plain = {
        "experience": "seniority", "company": "org", "industry": "industry", "country": "country", "city": "city", "role_family": "role_family", "investment_class": "investment_classification", "investment_track": "investment_track", "dfi_relevance": "dfi_relevance",
        "ngo_track": "ngo_track", "government_grade": "public_service_grade", "public_institution_category": "public_institution_category", "multinational_sector": "multinational_sector", "africa_relevance": "africa_relevance", "african_access": "african_applicant_access", "org_type": "org_type", "eligibility": "eligibility",
    }
    yes_no = {"dfi_institution": "is_dfi_or_multilateral", "ngo_institution": "is_ngo_or_un", "government": "is_government_or_public_service", "public_institution": "is_public_institution", "multinational": "is_multinational"}
    return {n: F.col(c) for n, c in plain.items()} | {n: _flag(c) for n, c in yes_no.items()} | {"job_type": job_type(), "remote": remote_bucket(), "certification_scope": certification_scope()}


@dataclass
class SearchRequest:
    """A query; an empty selection of a facet means any value."""

    keyword: str = ""
    location: str = ""
    date_posted: str = ""
    selected: dict[str, list[str]] = field(default_factory=lambda: {"certification_scope": ["certified"]})
    sort_by: str = "relevance"
    page: int = 1


def _contains(fields: list[str], words: str, more: list[Column] | None = None) -> Column:
    parts = [F.nullif(F.col(c), F.lit("")) for c in fields] + (more or [])
    return F.lower(F.concat_ws(" ", *parts)).contains(words.strip().lower())


def matches(request: SearchRequest, as_of: Column) -> Column:
    """Q1 to Q5: one conjunction."""
    out = F.lit(True)
    if request.keyword.strip():
        out = out & _contains(KEYWORD_FIELDS, request.keyword, [F.array_join("thematic_sectors", " ")])
    if request.location.strip():
        out = out & _contains(LOCATION_FIELDS, request.location)
    if request.date_posted in HOURS:
        out = out & F.coalesce(F.col("posted") >= as_of - F.make_dt_interval(hours=F.lit(HOURS[request.date_posted])), F.lit(False))
    known = facets()
    for name, values in request.selected.items():
        if values:
            out = out & F.coalesce(known[name].isin(values), F.lit(False))
    return out


def search(items: DataFrame, request: SearchRequest, as_of: Column, order_col: str = "pos") -> DataFrame:
    """What matches, newest first (undated last) or in the table's own order."""
    found = items.where(matches(request, as_of))
    return found.orderBy(F.desc_nulls_last("posted"), order_col) if request.sort_by == "recent" else found.orderBy(order_col)


def page_of(found: DataFrame, page: int, size: int = PAGE) -> DataFrame:
    """One page of an ordered result; the page is clamped to those there are."""
    last = max(1, -(-found.count() // size))
    return found.offset((min(max(1, page), last) - 1) * size).limit(size)


@dataclass(frozen=True)
class Cursor:
    """The place of a row in the order of a search: what was posted at, and its number."""

    posted: object
    pos: int


def page_after(items: DataFrame, request: SearchRequest, as_of: Column, after: Cursor | None = None, size: int = PAGE, order_col: str = "pos") -> DataFrame:
    """W7 without counting or skipping: the next rows of a search after a cursor (the first page for None).

    The cursor is a comparison of columns, so it reaches the scan, and the page is a top-k: each task keeps
    `size` rows, whatever page it is. order_col must be unique.
    """
    found = items.where(matches(request, as_of))
    recent = request.sort_by == "recent"
    if after is not None:
        later = F.col(order_col) > after.pos
        if recent and after.posted is not None:
            at = F.lit(after.posted)
            found = found.where((F.col("posted") < at) | ((F.col("posted") == at) & later) | F.col("posted").isNull())
        elif recent:
            found = found.where(F.col("posted").isNull() & later)
        else:
            found = found.where(later)
    return found.orderBy(*([F.desc_nulls_last("posted")] if recent else []), order_col).limit(size)


def cursor_of(page: DataFrame, order_col: str = "pos") -> Cursor | None:
    """Where the next page goes on: after this page's last row; None if it is empty. A page is read, no more."""
    last = page.select("posted", order_col).tail(1)
    return Cursor(last[0][0], last[0][1]) if last else None


def facet_options(items: DataFrame, limit: int = 60, by_label: bool = False) -> DataFrame:
    """(facet, value, count) over the whole table: the largest counts, or the first labels."""
    from pyspark.sql import Window

    named = {n: (c, "") for n, c in facets().items()}
    counted = counters(items, named).where("value != ''")
    order = [F.col("value")] if by_label else [F.desc("count"), F.col("value")]
    return counted.withColumn("nth", F.row_number().over(Window.partitionBy("dimension").orderBy(*order))).where(F.col("nth") <= limit).select(F.col("dimension").alias("facet"), "value", "count")


def headline(items: DataFrame) -> DataFrame:
    """Q8: rows, and distinct sources, role families, countries and cities."""
    some = lambda c: F.countDistinct(F.nullif(F.col(c), F.lit("")))
    return items.agg(F.count("*").alias("rows"), some("source").alias("sources"), some("role_family").alias("families"), some("country").alias("countries"), some("city").alias("cities"))


def labels(values: DataFrame, vocabulary: DataFrame, value_col: str = "value") -> DataFrame:
    """Q9: the vocabulary's label, else the id with spaces and capitals. vocabulary: (id, label)."""
    joined = values.join(vocabulary.select(F.col("id").alias(value_col), F.col("label").alias("given")), value_col, "left")
    return joined.withColumn("label", F.coalesce("given", F.initcap(F.replace(F.col(value_col), F.lit("_"), F.lit(" "))))).drop("given")
