"""Landed payloads to postings.

The landing table holds (source_key, target_id, fetched_at, payload). A payload is read as a variant, so
a field may be a string, a list or an object without breaking its neighbours. What differs between
sources is data: where the items are, which paths lead to a field (the first that isn't empty counts),
and how ids are made; `project` then turns the common fields of all sources into postings.
Adding a source is adding a Source to SOURCES.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from jobloom.functions import extract as X
from jobloom.functions.normalise import html_to_text, norm_unicode
from jobloom.operators.dedup import first_by_id

FIELDS = [
    "native_id", "title", "location_raw", "description", "company", "employment_type", "mode_hint", "level", "posted_raw", "deadline_raw", "page_url", "apply_url",
    "salary_min", "salary_max", "salary_currency", "salary_interval", "status", "listed", "remote_flag", "predicted",
]


# ---- F14: mixed values. Keys that hold what an object is called, in this order.
PREFERRED = ["name", "label", "title", "value", "text", "description"]


def _leaves(value: object) -> Iterator[str]:
    """Texts of a JSON value from left to right; of an object what its preferred keys hold, else all it holds."""
    if isinstance(value, dict):
        named = [text for key in PREFERRED for text in _leaves(value.get(key))]
        yield from named or _leaves(list(value.values()))
    elif isinstance(value, list):
        for inner in value:
            yield from _leaves(inner)
    elif value is not None:
        text = (html.unescape(value) if isinstance(value, str) else str(value)).strip()
        if text:
            yield text


def flatten_mixed(value: object) -> list[str]:
    """texts of a string, number, boolean, list or object at any depth, in order; of those that are equal when
    case folded the first."""
    first: dict[str, str] = {}
    for text in _leaves(value):
        first.setdefault(text.casefold(), text)
    return list(first.values())


@F.pandas_udf(ArrayType(StringType()))
def mixed_terms(values: pd.Series) -> pd.Series:
    """F14 over the JSON text of a value."""
    return values.map(lambda x: [] if x is None else flatten_mixed(json.loads(x)))


@dataclass(frozen=True)
class Source:
    """How one kind of payload is read. Paths are JSON paths below an item; `terms` gather departments,
    categories and tags of any shape; `keep` filters items; `fix` adjusts the common fields."""

    key: str
    items: list[str]
    paths: dict[str, list[str]]
    terms: list[str] = field(default_factory=list)
    company_from_target: bool = False
    official: bool = False
    currency: str | None = None
    keep: Callable[[], Column] | None = None
    fix: Callable[[DataFrame], DataFrame] | None = None
    join_locations: str | None = None


def _inner_lists(outer: str, inner: str) -> Column:
    none = F.array().cast("array<variant>")
    return F.flatten(F.transform(F.try_variant_get("v", outer, "array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, f"${inner}", "array<variant>"), none)))


def _items(landing: DataFrame, paths: list[str]) -> DataFrame:
    """One row for each item; a path "$" is a payload that is itself a list, "$.a[*].b" a list in every item of a list."""
    parsed = landing.withColumn("v", F.try_parse_json("payload"))
    lists = []
    for path in paths:
        if "[*]" in path:
            lists.append(_inner_lists(*path.split("[*]")))
        else:
            lists.append(F.try_variant_get("v", path, "array<variant>"))
    lists = [F.when(F.size(x) > 0, x) for x in lists]
    return parsed.withColumn("pos_item", F.coalesce(*lists)).select("source_key", "target_id", "fetched_at", F.posexplode("pos_item").alias("pos", "item"))


def _path(path: str) -> Column:
    return F.nullif(F.trim(F.try_variant_get("item", path, "string")), F.lit(""))


def _field(paths: list[str]) -> Column:
    return F.coalesce(*map(_path, paths)) if paths else F.lit(None).cast("string")


def _bool(path: str) -> Column:
    return F.try_variant_get("item", path, "boolean")


def _read(landing: DataFrame, source: Source) -> DataFrame:
    items = _items(landing.where(F.col("source_key") == source.key), source.items)
    rows = items.select("*", *(_field(source.paths.get(f, [])).alias(f) for f in FIELDS))
    if source.keep is not None:
        rows = rows.where(source.keep())
    if source.join_locations:
        rows = rows.withColumn("location_raw", F.coalesce("location_raw", F.nullif(F.array_join(F.array_distinct(mixed_terms(F.to_json(F.try_variant_get("item", source.join_locations, "variant")))), ", "), F.lit(""))))
    texts = [mixed_terms(F.to_json(F.try_variant_get("item", p, "variant"))) for p in source.terms]
    rows = rows.withColumn("raw_terms", F.array_distinct(F.concat(*texts)) if texts else F.array().cast("array<string>"))
    if source.fix is not None:
        rows = source.fix(rows)
    return rows.where("native_id is not null and title is not null")


def project(rows: DataFrame, source: Source, targets: DataFrame | None = None, default_year: int = 2026) -> DataFrame:
    """Common fields to the posting's columns. targets: (source_key, target_id, company_name), for boards of one employer."""
    if targets is not None and source.company_from_target:
        rows = rows.join(targets.select("source_key", "target_id", F.col("company_name").alias("board_company")), ["source_key", "target_id"], "left").withColumn("company", F.coalesce("company", "board_company")).drop("board_company")
    text = F.coalesce("description", F.lit(""))
    years, school = X.years_experience(text), X.education(text)
    level = F.lower("level")
    levels = F.when(level.rlike("intern|junior|entry|graduate"), "entry").when(level.rlike("senior|principal|staff|lead"), "senior").when(level.rlike("director|vp|head"), "leadership").when(level.rlike("mid"), "mid")
    interval = F.lower("salary_interval")
    period = F.when(interval.contains("year") | interval.contains("annual"), "year").when(interval.contains("month"), "month").when(interval.contains("day"), "day").when(interval.contains("hour"), "hour")
    low, high = F.col("salary_min").try_cast("double").cast("int"), F.col("salary_max").try_cast("double").cast("int")
    currency = F.coalesce("salary_currency", F.lit(source.currency).cast("string"))
    paid = F.struct(low.alias("min"), high.alias("max"), currency.alias("currency"), period.alias("period"), F.lit(True).alias("disclosed"))
    posted = X.timestamp("posted_raw")
    closes = F.coalesce(X.timestamp("deadline_raw", end_of_day=True), X.deadline(text, default_year))
    settled = X.settle_deadline(posted, closes)
    prefix = F.concat_ws("-", F.lit(source.key), F.when(F.lit(source.company_from_target), F.col("target_id")), F.col("native_id"))
    hint = F.when(F.col("remote_flag") == "true", F.lit("remote")).otherwise(norm_unicode("mode_hint"))
    kind = F.lower(F.coalesce("employment_type", F.lit("")))
    out = rows.select(
        prefix.alias("id"), "title", F.when(kind.contains("intern"), "internship").when(kind.contains("fellow"), "fellowship").otherwise(X.opportunity_type("title")).alias("opportunity_type"),
        F.col("company").alias("org_name"), "location_raw", hint.alias("mode_hint"), F.coalesce(levels, X.seniority("title")).alias("seniority"), "raw_terms",
        X.industry("title", text).alias("industry"), posted.alias("posted_at"), settled["deadline"].alias("deadline"), settled["deadline_dropped"].alias("deadline_dropped"),
        years["years_min"].alias("years_experience_min"), years["years_max"].alias("years_experience_max"), school["level"].alias("education_required"), school["fields"].alias("education_field"),
        X.languages_required(text).alias("languages_required"), X.contract_type("title", F.concat_ws(" ", "employment_type", text)).alias("contract_type"),
        F.when(low.isNotNull() & high.isNotNull() & currency.isNotNull() & period.isNotNull(), paid).alias("compensation"),
        F.coalesce("apply_url", "page_url").alias("apply_url"), F.coalesce("page_url", "apply_url").alias("raw_description_url"), F.lit(source.official).alias("apply_is_official"),
        html_to_text(text).alias("summary"), "source_key", "target_id", F.col("fetched_at").alias("last_seen_at"), "pos",
    )
    return first_by_id(out)


def _lever(rows: DataFrame) -> DataFrame:
    """Salary only with all four parts; another location of the list where the first is missing."""
    all_locations = F.try_variant_get("item", "$.categories.allLocations", "array<string>")
    return rows.withColumn("location_raw", F.coalesce("location_raw", F.try_element_at(all_locations, F.lit(1)))).withColumn("apply_url", F.coalesce("apply_url", F.concat("page_url", F.lit("/apply"))))


def _ashby(rows: DataFrame) -> DataFrame:
    """Compensation of tiers in one currency: the least minimum, the largest maximum."""
    tiers = F.try_variant_get("item", "$.compensation.compensationTiers", "array<struct<minValue:double,maxValue:double,currencyCode:string>>")
    single = F.size(F.array_distinct(F.transform(tiers, lambda t: t["currencyCode"]))) == 1
    pick = lambda f: F.when(single, f)
    return (
        rows.withColumn("salary_min", pick(F.array_min(F.transform(tiers, lambda t: t["minValue"]))).cast("string"))
        .withColumn("salary_max", pick(F.array_max(F.transform(tiers, lambda t: t["maxValue"]))).cast("string"))
        .withColumn("salary_currency", pick(tiers[0]["currencyCode"])).withColumn("salary_interval", F.lit("year"))
    )


def _pinpoint(rows: DataFrame) -> DataFrame:
    text = F.concat_ws(" ", _path("$.description"), _path("$.key_responsibilities"), _path("$.skills_knowledge_expertise"))
    seen = F.coalesce(_bool("$.compensation.visible"), F.lit(False))
    return rows.withColumn("description", text).withColumn("salary_min", F.when(seen, F.col("salary_min"))).withColumn("salary_interval", F.coalesce("salary_interval", F.lit("year")))


def _reliefweb(rows: DataFrame) -> DataFrame:
    """The primary country, else the first; the first outside link of how_to_apply or the body."""
    countries = F.try_variant_get("item", "$.fields.country", "array<struct<name:string,iso3:string,primary:boolean>>")
    city = F.try_element_at(F.try_variant_get("item", "$.fields.city", "array<struct<name:string>>"), F.lit(1))["name"]
    main = F.coalesce(F.try_element_at(F.filter(countries, lambda c: F.coalesce(c["primary"], F.lit(False))), F.lit(1)), F.try_element_at(countries, F.lit(1)))["name"]
    links = F.regexp_extract_all(F.concat_ws(" ", _path("$.fields.how_to_apply"), _path("$.fields.body")), F.lit(r"(https?://[^\s\"'<>)]+)"), 1)
    outside = F.try_element_at(F.filter(links, lambda x: ~x.contains("reliefweb.int")), F.lit(1))
    return rows.withColumn("location_raw", F.concat_ws(", ", city, main)).withColumn("apply_url", F.coalesce(outside, "page_url")).withColumn("company", F.try_element_at(F.try_variant_get("item", "$.fields.source", "array<struct<name:string>>"), F.lit(1))["name"])


def _adzuna(rows: DataFrame) -> DataFrame:
    """area[0] names the country; predicted salaries are no salaries; (type, time) give the contract."""
    country = F.try_element_at(F.try_variant_get("item", "$.location.area", "array<string>"), F.lit(1))
    place = F.when(F.coalesce(F.lower("location_raw").contains(F.lower(country)), F.lit(False)), F.col("location_raw")).otherwise(F.concat_ws(", ", "location_raw", country))
    real = ~F.coalesce(F.col("predicted").isin("1", "true"), F.lit(False))
    kind = F.when(_path("$.contract_type") == "contract", "contract").when(_path("$.contract_time") == "part_time", "part-time").when(_path("$.contract_type") == "permanent", "permanent").when(_path("$.contract_time") == "full_time", "full-time")
    return rows.withColumn("location_raw", place).withColumn("salary_min", F.when(real, F.col("salary_min"))).withColumn("employment_type", kind).withColumn("salary_interval", F.lit("year"))


def _himalayas(rows: DataFrame) -> DataFrame:
    """No restriction means worldwide; the id is the tail of a URL."""
    where = F.try_variant_get("item", "$.locationRestrictions", "array<string>")
    place = F.when(F.size(F.coalesce(where, F.array().cast("array<string>"))) == 0, F.lit("Remote - Worldwide")).otherwise(F.concat(F.lit("Remote - "), F.array_join(where, ", ")))
    return rows.withColumn("location_raw", place).withColumn("native_id", F.element_at(F.split(F.regexp_replace("native_id", "/+$", ""), "/"), -1)).withColumn("mode_hint", F.lit("remote")).withColumn("salary_interval", F.lit("year"))


def _remote_board(rows: DataFrame) -> DataFrame:
    return rows.withColumn("mode_hint", F.lit("remote")).withColumn("salary_interval", F.lit("year"))


def _arbeitnow(rows: DataFrame) -> DataFrame:
    """A structured remote flag without a place is worldwide."""
    return rows.withColumn("location_raw", F.when((F.col("remote_flag") == "true") & F.col("location_raw").isNull(), F.lit("Remote - Worldwide")).otherwise(F.col("location_raw"))).withColumn("employment_type", F.concat_ws(" ", F.try_variant_get("item", "$.job_types", "array<string>")))


def _oracle(rows: DataFrame) -> DataFrame:
    return rows.withColumn("page_url", F.coalesce("page_url", F.concat("target_id", F.lit("/job/"), "native_id")))


def _workday(rows: DataFrame) -> DataFrame:
    return rows.withColumn("page_url", F.concat("target_id", F.regexp_extract("page_url", "(/.*|.+)", 0)))


def _workable(rows: DataFrame) -> DataFrame:
    return rows.withColumn("location_raw", F.nullif(F.array_join(mixed_terms(F.to_json(F.try_variant_get("item", "$.location", "variant"))), ", "), F.lit("")))


SOURCES: dict[str, Source] = {
    s.key: s
    for s in [
        Source("greenhouse", ["$.jobs"], {"native_id": ["$.id"], "title": ["$.title"], "location_raw": ["$.location.name"], "description": ["$.content"], "posted_raw": ["$.updated_at"], "page_url": ["$.absolute_url"]}, ["$.departments"], True, True),
        Source("lever", ["$"], {"native_id": ["$.id"], "title": ["$.text"], "location_raw": ["$.categories.location"], "description": ["$.descriptionPlain", "$.description"], "employment_type": ["$.categories.commitment"], "level": ["$.categories.level"], "mode_hint": ["$.workplaceType"], "posted_raw": ["$.createdAt"], "page_url": ["$.hostedUrl"], "apply_url": ["$.applyUrl"], "salary_min": ["$.salaryRange.min"], "salary_max": ["$.salaryRange.max"], "salary_currency": ["$.salaryRange.currency"], "salary_interval": ["$.salaryRange.interval"]}, ["$.categories.team", "$.categories.department"], True, True, fix=_lever),
        Source("ashby", ["$.jobs"], {"native_id": ["$.id", "$.jobUrl"], "title": ["$.title"], "location_raw": ["$.location"], "description": ["$.descriptionPlain", "$.descriptionHtml"], "employment_type": ["$.employmentType"], "mode_hint": ["$.workplaceType"], "remote_flag": ["$.isRemote"], "posted_raw": ["$.publishedAt"], "page_url": ["$.jobUrl"], "apply_url": ["$.applyUrl"]}, ["$.department"], True, True, keep=lambda: F.coalesce(_bool("$.isListed"), F.lit(True)), fix=_ashby),
        Source("pinpoint", ["$.data"], {"native_id": ["$.id"], "title": ["$.title"], "location_raw": ["$.location.name", "$.location"], "employment_type": ["$.employment_type"], "posted_raw": ["$.published_at"], "page_url": ["$.url"], "salary_min": ["$.compensation.min"], "salary_max": ["$.compensation.max"], "salary_currency": ["$.compensation.currency"]}, ["$.department"], True, True, fix=_pinpoint),
        Source("recruitee", ["$.offers", "$.jobs", "$.data", "$.results", "$"], {"native_id": ["$.id", "$.slug"], "title": ["$.title"], "description": ["$.description"], "employment_type": ["$.employment_type"], "mode_hint": ["$.workplace_type"], "posted_raw": ["$.published_at", "$.created_at"], "deadline_raw": ["$.close_at", "$.deadline"], "page_url": ["$.careers_url", "$.url"], "apply_url": ["$.apply_url", "$.careers_apply_url"]}, ["$.department", "$.tags"], True, True, keep=lambda: F.coalesce(F.lower(_path("$.status")).isin("published", "open", "active"), F.lit(True)), join_locations="$.locations"),
        Source("reliefweb", ["$.data"], {"native_id": ["$.id"], "title": ["$.fields.title"], "description": ["$.fields.body"], "posted_raw": ["$.fields.date.created"], "deadline_raw": ["$.fields.date.closing"], "page_url": ["$.fields.url", "$.href"]}, ["$.fields.career_categories"], fix=_reliefweb),
        Source("untalent", ["$.jobs", "$.items", "$.data"], {"native_id": ["$.id", "$.guid", "$.link"], "title": ["$.title"], "company": ["$.organization", "$.organisation"], "location_raw": ["$.location"], "description": ["$.description"], "employment_type": ["$.contract_type"], "posted_raw": ["$.published_at", "$.pubDate"], "deadline_raw": ["$.deadline"], "page_url": ["$.url", "$.link"], "apply_url": ["$.apply_url"]}, ["$.areas"]),
        Source("adzuna", ["$.results"], {"native_id": ["$.id"], "title": ["$.title"], "company": ["$.company.display_name"], "location_raw": ["$.location.display_name"], "description": ["$.description"], "posted_raw": ["$.created"], "page_url": ["$.redirect_url"], "salary_min": ["$.salary_min"], "salary_max": ["$.salary_max"], "predicted": ["$.salary_is_predicted"]}, ["$.category.label"], currency="ZAR", fix=_adzuna),
        Source("himalayas", ["$.jobs"], {"native_id": ["$.id", "$.guid", "$.applyUrl"], "title": ["$.title"], "company": ["$.companyName"], "description": ["$.description"], "employment_type": ["$.employmentType"], "posted_raw": ["$.publishedAt", "$.pubDate"], "page_url": ["$.applyUrl"], "salary_min": ["$.minSalary"], "salary_max": ["$.maxSalary"], "salary_currency": ["$.currency"]}, ["$.categories"], fix=_himalayas),
        Source("remotive", ["$.jobs"], {"native_id": ["$.id"], "title": ["$.title"], "company": ["$.company_name"], "location_raw": ["$.candidate_required_location"], "description": ["$.description"], "employment_type": ["$.job_type"], "posted_raw": ["$.publication_date"], "page_url": ["$.url"]}, ["$.category"], fix=_remote_board),
        Source("jobicy", ["$.jobs"], {"native_id": ["$.id"], "title": ["$.jobTitle"], "company": ["$.companyName"], "location_raw": ["$.jobGeo"], "description": ["$.jobDescription", "$.jobExcerpt"], "employment_type": ["$.jobType"], "level": ["$.jobLevel"], "posted_raw": ["$.pubDate"], "page_url": ["$.url"], "salary_min": ["$.annualSalaryMin"], "salary_max": ["$.annualSalaryMax"], "salary_currency": ["$.salaryCurrency"]}, ["$.jobIndustry"], fix=_remote_board),
        Source("remoteok", ["$"], {"native_id": ["$.id"], "title": ["$.position"], "company": ["$.company"], "location_raw": ["$.location"], "description": ["$.description"], "posted_raw": ["$.date"], "page_url": ["$.url"], "apply_url": ["$.apply_url"], "salary_min": ["$.salary_min"], "salary_max": ["$.salary_max"]}, ["$.tags"], currency="USD", fix=_remote_board),
        Source("arbeitnow", ["$.data"], {"native_id": ["$.slug"], "title": ["$.title"], "company": ["$.company_name"], "location_raw": ["$.location"], "description": ["$.description"], "remote_flag": ["$.remote"], "posted_raw": ["$.created_at"], "page_url": ["$.url"]}, ["$.tags"], fix=_arbeitnow),
        Source("cornerstone", ["$.data.requisitions"], {"native_id": ["$.requisitionId"], "title": ["$.displayJobTitle"], "description": ["$.externalDescription"], "posted_raw": ["$.postedDate", "$.postingEffectiveDate"], "deadline_raw": ["$.applicationDeadline", "$.postingExpirationDate"], "page_url": ["$.jobUrl"]}, [], True, True, join_locations="$.locations"),
        Source("oracle", ["$.items[*].requisitionList", "$.requisitionList", "$.items"], {"native_id": ["$.Id"], "title": ["$.Title"], "location_raw": ["$.PrimaryLocation"], "description": ["$.ExternalDescriptionStr", "$.ShortDescriptionStr"], "posted_raw": ["$.PostedDate"], "deadline_raw": ["$.PostingEndDate"], "page_url": ["$.ExternalURL"]}, [], True, True, fix=_oracle),
        Source("workday", ["$.jobPostings"], {"native_id": ["$.jobReqId", "$.id", "$.bulletFields[0]", "$.externalPath"], "title": ["$.title"], "location_raw": ["$.locationsText"], "employment_type": ["$.timeType"], "posted_raw": ["$.postedOn"], "page_url": ["$.externalPath"]}, [], True, True, fix=_workday),
        Source("smartrecruiters", ["$.content"], {"native_id": ["$.id", "$.refNumber"], "title": ["$.name"], "description": ["$.jobAd"], "employment_type": ["$.typeOfEmployment.label", "$.typeOfEmployment"], "posted_raw": ["$.releasedDate"], "page_url": ["$.ref"]}, ["$.department"], True, True, join_locations="$.location"),
        Source("workable", ["$.results"], {"native_id": ["$.shortcode", "$.code"], "title": ["$.title"], "description": ["$.description"], "employment_type": ["$.employment_type"], "posted_raw": ["$.published"], "page_url": ["$.url"]}, ["$.department"], True, True, fix=_workable),
    ]
}


def from_source(key: str, landing: DataFrame, targets: DataFrame | None = None, default_year: int = 2026) -> DataFrame:
    """Postings of one source's payloads; items without an id or a title drop, repeated ids keep the first."""
    source = SOURCES[key]
    return project(_read(landing, source), source, targets, default_year)


def all_sources(landing: DataFrame, targets: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """All sources in a fixed order of precedence, with (source_order, pos) to tell the order of rows."""
    frames = [from_source(key, landing, targets).withColumn("source_order", F.lit(i)) for i, key in enumerate(order or SOURCES)]
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out
