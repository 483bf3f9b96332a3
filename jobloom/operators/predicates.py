"""Predicates on enriched postings, and filters that keep an audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import extract as X
from jobloom.operators.matching import iso_tokens

# Wording of places that aren't places, evidence and states.
NEUTRAL_PLACE = r"\b(remote|remotely|worldwide|anywhere|global|emea|africa|afrique|áfrica|afrika|sub[ -]?saharan|pan[ -]?african|regional)\b"
NEUTRAL_EVIDENCE = ["remote_from_kenya", "remote_regional_or_africa", "remote_global_or_worldwide", "international_applicants_explicitly_welcome"]
CERTIFIED_RELEVANCE = ["africa_based_confirmed", "africa_regional", "remote_confirmed_open_to_africa", "africa_remit_non_african_location"]
CERTIFIED_ACCESS = ["confirmed_any_african_national", "confirmed_specific_african_nationality", "confirmed_international_recruitment", "likely_open", "work_authorisation_required", "local_only"]
CONTROLLED_KINDS = ["institution_official", "direct_or_official", "employer_official"]
CONTROLLED_NAMES = ["official career", "institutional board", "pageup", "cornerstone", "oracle candidate", "successfactors"]
LISTING_TITLES = ["career", "careers", "jobs", "vacancies", "current vacancies", "work with us"]


def _false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def relevant(is_remote_from_kenya: str, is_african: str, country_code: str, african_codes: list[str], description: str) -> Column:
    """P5: in Africa or open to it from afar, or an offer of mobility that is tied to the role."""
    return _false(F.col(is_remote_from_kenya)) | _false(F.col(is_african)) | _false(F.col(country_code).isin(african_codes)) | X.role_mobility(description)


def official_scope(opted_in: str, is_african: str, country_code: str, title: str, text: str) -> Column:
    """Opted in, African, of unknown country, or with a word of Africa in the title and the text's head."""
    head = F.concat_ws(" ", F.col(title), F.substring(F.coalesce(F.col(text), F.lit("")), 1, 350))
    return _false(F.col(opted_in)) | _false(F.col(is_african)) | F.col(country_code).isNull() | X.has(head, X.OPEN_REGION)


def rejection_reason() -> Column:
    """Why a row is rejected, or null: a known duty station outside Africa without a remit for it."""
    return F.when(F.col("africa_relevance.status") == "non_african", F.lit("known_non_african_without_africa_remit"))


def split_rejected(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected); known duty stations outside Africa without a remit for it are rejected with a reason."""
    return postings.where(rejection_reason().isNull()), postings.where(rejection_reason().isNotNull()).withColumn("reason", rejection_reason())


def still_open(deadline: str, as_of: Column) -> Column:
    """No deadline, or one that isn't past."""
    return F.col(deadline).isNull() | (F.col(deadline) >= as_of)


def location_neutral() -> Column:
    """Meant for no one country. Columns: country_code, location_scope, work_mode, location_raw, region, eligibility_evidence."""
    scope, mode = F.lower(F.coalesce("location_scope", F.lit(""))), F.lower(F.coalesce("work_mode", F.lit("")))
    told = F.arrays_overlap(F.coalesce("eligibility_evidence", F.array().cast("array<string>")), F.lit(NEUTRAL_EVIDENCE))
    remote = mode.isin("remote_global", "remote_regional", "remote_kenya") & (scope.isin("regional", "international", "national") | X.has("location_raw", NEUTRAL_PLACE))
    region = (F.coalesce("region", F.lit("")) != "") & scope.isin("regional", "international")
    return F.coalesce("country_code", F.lit("")).eqNullSafe("") & (_false(told) | region | remote)


def location_pending() -> Column:
    """A real official vacancy whose duty station isn't shown yet. Columns as for P13, and source_kind,
    source_label, source_confidence, source_url, title, apply_url, raw_description_url, apply_is_official, org_verified, summary."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    controlled = F.lower(text("source_kind")).isin(CONTROLLED_KINDS) | (text("source_confidence") == "official") | F.lower(text("source_label")).rlike("|".join(CONTROLLED_NAMES))
    detail = F.when(text("raw_description_url") != "", text("raw_description_url")).otherwise(text("apply_url"))
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    specific = (detail != "") & ((text("source_url") == "") | (bare(detail) != bare(text("source_url")))) & ~F.lower(text("title")).isin(LISTING_TITLES)
    return F.coalesce("country_code", F.lit("")).eqNullSafe("") & ~location_neutral() & _false(F.col("apply_is_official")) & _false(F.col("org_verified")) & controlled & specific & (F.length(text("title")) >= 4)


def location_resolution() -> Column:
    """A4: physical_country, location_neutral, official_location_pending, else unresolved."""
    return F.when(F.coalesce("country_code", F.lit("")) != "", "physical_country").when(location_neutral(), "location_neutral").when(location_pending(), "official_location_pending").otherwise("unresolved")


def certified_default() -> Column:
    """By the sets of states."""
    return _false(F.col("africa_relevance.status").isin(CERTIFIED_RELEVANCE) & F.col("african_applicant_access.status").isin(CERTIFIED_ACCESS))


def certified_count() -> Column:
    """Visible by default, with certified or conditional access."""
    return _false(F.col("africa_relevance.default_visible") & F.col("african_applicant_access.certification_level").isin("certified", "conditional"))


def certified_view() -> Column:
    """The same, less three states of access."""
    return certified_count() & ~_false(F.col("african_applicant_access.status").isin("not_open", "internal_only", "unknown"))


def merged_location(structured: str, parsed: str) -> Column:
    """A structured country wins over one that is parsed again."""
    return F.coalesce(F.nullif(F.trim(structured), F.lit("")), F.col(parsed))


def foreign_iso_token(raw: str, african_codes: list[str]) -> Column:
    """An upper-case code of two letters that is no African country's, EU and UK aside."""
    return F.size(F.array_except(iso_tokens(raw, 2), F.lit([*african_codes, "EU", "UK"]))) > 0
