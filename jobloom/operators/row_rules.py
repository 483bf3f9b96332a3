"""V1: the rules of a posting, as conditions on columns.

Postings come flat (country_code) or with a place as one struct (loc.country_code). A rule is made only for
columns that a table has. Rules inside a profile hold where the profile isn't null. Types need no rules: a
value of another type can't be in a Spark column. What must be there is told by "required".
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

# Vocabularies of a posting.
OPPORTUNITY_TYPES = ["job", "fellowship", "grant", "internship", "programme"]
ORGANISATION_TYPES = [
    "employer", "ngo", "multilateral", "private", "unverified", "dfi", "development_bank", "commercial_bank", "investment_firm", "asset_manager", "private_equity", "venture_capital",
    "multinational", "un_agency", "government", "regulator", "state_owned_enterprise", "university", "foundation", "consulting_firm",
]
WORK_MODES = ["onsite", "hybrid", "remote_kenya", "remote_regional", "remote_global"]
SENIORITIES = ["entry", "mid", "senior", "leadership"]
SCOPES = ["local", "national", "regional", "international"]
DEADLINE_CONFIDENCES = ["explicit", "inferred", "unknown"]
CONFIDENCES = ["official", "aggregated", "community", "unverified"]
FLAGS = ["urgent", "relocation_worthy", "ai_relevant", "hidden_gem", "eligibility_review", "sample"]
CONTRACTS = ["permanent", "contract", "fixed_term", "part_time", "consultant", "volunteer", "unknown"]
EDUCATION = ["none", "secondary", "diploma", "bachelor", "masters", "phd"]
ELIGIBILITY = ["eligible", "likely_eligible", "uncertain", "local_only", "citizenship_restricted", "internal_only", "ineligible"]
LANGUAGES = ["en", "fr", "pt", "ar", "sw"]
RELEVANCE = [
    "africa_based_confirmed", "africa_regional", "remote_confirmed_open_to_africa", "africa_remit_non_african_location", "official_location_pending", "global_access_unconfirmed",
    "non_african", "unresolved",
]
ACCESS = [
    "confirmed_any_african_national", "confirmed_specific_african_nationality", "confirmed_international_recruitment", "likely_open", "work_authorisation_required", "local_only",
    "internal_only", "unknown", "not_open",
]
CERTIFICATION = ["certified", "conditional", "unverified", "excluded"]
EVIDENCE = ["explicit", "structured_source", "strong_inference", "weak_inference", "none"]
DFI_INSTITUTIONS = ["dfi", "development_bank", "multilateral", "investment_firm", "asset_manager", "private_equity", "venture_capital"]
PUBLIC_CATEGORIES = [
    "central_bank", "revenue_authority", "capital_markets_regulator", "insurance_regulator", "pensions_regulator", "competition_authority", "investment_promotion_agency",
    "national_development_bank", "sovereign_infrastructure_fund", "public_university", "judicial_service", "parliamentary_service", "ports", "railways", "electricity_utility", "water_utility",
    "state_owned_enterprise",
]
SECTORS = [
    "automotive", "aviation", "banking", "consulting", "energy", "fintech", "fmcg", "hospitality", "industrials", "insurance", "logistics", "medical_devices", "payments", "pharmaceuticals",
    "professional_services", "technology", "telecommunications",
]
INVESTMENT_CLASSES = ["core_investment", "investment_adjacent", "institutional_support", "not_investment"]
DFI_RELEVANCE = ["direct_investment", "institutional_role", "adjacent_experience", "none"]
NGO_CLASSES = ["humanitarian", "development", "technical_programme", "institutional_support", "not_ngo_un"]
IDENTIFIER = "^[a-z0-9]+(?:[-_][a-z0-9]+)*$"

#: Columns whose value, if there is one, is of a vocabulary: its fixed values, and what `more` adds under its name.
_OPTIONAL = {
    "opportunity_type": ("opportunity_type", OPPORTUNITY_TYPES),
    "org_type": ("organisation_type", ORGANISATION_TYPES),
    "org_type_detail": ("organisation_type", ORGANISATION_TYPES),
    "deadline_confidence": ("deadline_confidence", DEADLINE_CONFIDENCES),
    "work_mode": ("work_mode", WORK_MODES),
    "seniority": ("seniority", SENIORITIES),
    "location_scope": ("location_scope", SCOPES),
    "location_language": ("language", LANGUAGES),
    "education_required": ("education", EDUCATION),
    "contract_type": ("contract_type", CONTRACTS),
    "public_institution_profile.category": ("category", PUBLIC_CATEGORIES),
    "multinational_profile.sector": ("sector", SECTORS),
    "eligibility.evidence_strength": ("evidence_strength", EVIDENCE),
    "eligibility.detected_language": ("language", LANGUAGES),
}
#: Columns that need a value of a vocabulary. Those without a profile need it in every row.
_NEEDED = {
    "source_confidence": ("source_confidence", CONFIDENCES),
    "institution_profile.institution_type": ("organisation_type", ORGANISATION_TYPES),
    "ngo_profile.classification": ("ngo_classification", NGO_CLASSES),
    "africa_relevance.status": ("relevance", RELEVANCE),
    "africa_relevance.certification_level": ("certification", CERTIFICATION),
    "african_applicant_access.status": ("access", ACCESS),
    "african_applicant_access.certification_level": ("certification", CERTIFICATION),
    "african_applicant_access.evidence_strength": ("evidence_strength", EVIDENCE),
    "investment_profile.classification": ("investment_classification", INVESTMENT_CLASSES),
    "investment_profile.dfi_relevance": ("dfi_relevance", DFI_RELEVANCE),
    "eligibility.status": ("eligibility", ELIGIBILITY),
}
#: Columns that are checked only where `more` names their vocabulary, since that lies in registries.
_REGISTERED = {
    "ngo_profile.track": "ngo_track",
    "ngo_profile.canonical_specialisation": "specialisation",
    "investment_profile.track": "investment_track",
    "investment_profile.canonical_specialisation": "specialisation",
    "role_family": "role_family",
    "role_subfamily": "specialisation",
}
_BOOLEANS = [
    "institution_profile.is_dfi_or_multilateral", "institution_profile.priority_institution", "ngo_profile.is_ngo_or_un", "ngo_profile.priority_organisation", "ngo_profile.is_programme_role",
    "government_profile.is_government_or_public_service", "government_profile.priority_portal", "government_profile.internal_only", "public_institution_profile.is_public_institution",
    "multinational_profile.is_multinational", "multinational_profile.priority_employer", "africa_relevance.default_visible", "investment_profile.is_investment_role",
]
#: Numbers from 0 to 1: optional ones, and those that a profile needs.
_SHARES = ["location_confidence", "loc.confidence"]
_NEEDED_SHARES = [
    "ngo_profile.confidence", "africa_relevance.confidence", "african_applicant_access.confidence", "investment_profile.confidence", "investment_profile.dfi_confidence", "eligibility.confidence",
]
#: Lists without null entries: optional ones, and those that a profile needs.
_LISTS = ["location_evidence", "loc.evidence", "investment_profile.evidence", "investment_profile.negative_evidence", "eligibility.evidence", "eligibility.eligible_nationalities", "flags"]
_NEEDED_LISTS = [
    "government_profile.eligible_nationalities", "multinational_profile.african_city_footprint", "africa_relevance.evidence", "african_applicant_access.evidence",
    "african_applicant_access.eligible_nationalities",
]
_IDENTIFIERS = ["org_id", "source_id", "institution_profile.registry_id"]
_DATES = ["posted_at", "deadline"]
#: A flag of priority, and the packs of sources that its rows may come from, by the names of the registry in use.
PACKS = {
    "institution_profile.priority_institution": ("institution_profile.source_pack", "dfi"),
    "ngo_profile.priority_organisation": ("ngo_profile.source_pack", "ngo"),
    "government_profile.priority_portal": ("government_profile.source_pack", "government"),
    "public_institution_profile.is_public_institution": ("public_institution_profile.source_pack", "public_institution"),
    "multinational_profile.priority_employer": ("multinational_profile.source_pack", "multinational"),
}


def _type_of(schema: StructType, path: str):
    """The type at a dotted path, or None."""
    kind = schema
    for part in path.split("."):
        if not isinstance(kind, StructType) or part not in kind.names:
            return None
        kind = kind[part].dataType
    return kind


def blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""


def url(c: str) -> Column:
    """Whether c is an http or https URL with a host; false for null."""
    return F.coalesce(F.col(c).rlike("^(?i:https?)://[^/?#]"), F.lit(False))


def row_rules(schema: StructType, more: Mapping[str, Iterable[str]] | None = None, packs: Mapping[str, tuple[str, str]] = PACKS) -> dict[str, Column]:
    """Rule -> condition under which a row violates it; never null.

    more: values of vocabularies besides the fixed ones (from registries), by the vocabulary's name.
    """
    rules: dict[str, Column] = {}
    more = dict(more or {})
    has = lambda *paths: all(_type_of(schema, p) is not None for p in paths)
    top = lambda path: path.rpartition(".")[0]
    inside = lambda path: F.col(top(path)).isNotNull() if top(path) else F.lit(True)

    def rule(name: str, bad: Column) -> None:
        rules[name] = F.coalesce(bad, F.lit(False))

    for c in ("id", "title", "opportunity_type", "org_name", "source_name"):
        if has(c):
            rule(f"{c}.required", blank(c))
    if has("id"):
        rule("id.characters", ~blank("id") & ~F.col("id").rlike(r"\A[a-zA-Z0-9_.-]+\z"))

    for path, (vocabulary, values) in _OPTIONAL.items():
        if has(path):
            rule(f"{path}.vocabulary", ~F.col(path).isin([*values, *more.get(vocabulary, [])]))
    for path, (vocabulary, values) in _NEEDED.items():
        if has(path):
            known = F.coalesce(F.col(path).isin([*values, *more.get(vocabulary, [])]), F.lit(False))
            rule(f"{path}.vocabulary", inside(path) & ~known)
    for path, vocabulary in _REGISTERED.items():
        if has(path) and vocabulary in more:
            rule(f"{path}.vocabulary", ~F.col(path).isin(list(more[vocabulary])))
    if has("flags"):
        rule("flags.vocabulary", F.exists("flags", lambda flag: ~flag.isin(FLAGS)))
    if has("thematic_sectors") and "theme" in more:
        rule("thematic_sectors.vocabulary", F.exists("thematic_sectors", lambda theme: ~theme.isin(list(more["theme"]))))

    for path in _BOOLEANS:
        if has(path):
            rule(f"{path}.required", inside(path) & F.col(path).isNull())
    for path in _SHARES:
        if has(path):
            rule("location_confidence.range", ~F.col(path).between(0, 1))
    for path in _NEEDED_SHARES:
        if has(path):
            rule(f"{path}.range", inside(path) & ~F.coalesce(F.col(path).between(0, 1), F.lit(False)))
    for path in (*_LISTS, *_NEEDED_LISTS):
        if isinstance(_type_of(schema, path), ArrayType):
            missing = inside(path) & F.col(path).isNull() if path in _NEEDED_LISTS else F.lit(False)
            rule(f"{path}.strings", missing | F.exists(path, lambda x: x.isNull()))
    for path in _IDENTIFIERS:
        if has(path):
            rule(f"{path}.identifier", ~F.col(path).rlike(IDENTIFIER))
    for c in _DATES:
        if isinstance(_type_of(schema, c), StringType):
            rule(f"{c}.iso", F.col(c).isNotNull() & (F.col(c).try_cast("timestamp").isNull() | ~F.col(c).rlike(r"^\d{4}-\d\d-\d\d")))

    for prefix in ("", "loc."):
        for name, form in (("country_code", "^[A-Z]{2}$"), ("country_iso3", "^[A-Z]{3}$")):
            if has(prefix + name):
                rule(f"{name}.format", ~F.col(prefix + name).rlike(form))
        if has(prefix + "lat", prefix + "lon"):
            lat, lon = F.col(prefix + "lat"), F.col(prefix + "lon")
            rule("lat.range", F.when(lat.isNull(), lon.isNotNull()).otherwise(~lat.between(-90, 90)))  # coordinates are there as a pair
            rule("lon.range", F.when(lon.isNull(), lat.isNotNull()).otherwise(~lon.between(-180, 180)))
    for c in ("years_experience_min", "years_experience_max"):
        if has(c):
            rule(f"{c}.range", ~F.col(c).between(0, 50))
    if has("years_experience_min", "years_experience_max"):
        rule("years_experience.order", F.col("years_experience_max") < F.col("years_experience_min"))
    if has(*_DATES):
        rule("deadline.before_posted", F.col("deadline").try_cast("timestamp") < F.col("posted_at").try_cast("timestamp"))
    if has("source_url"):
        rule("source_url.url", ~url("source_url"))
    if has("apply_url"):
        rule("apply_url.url", F.col("apply_url").isNotNull() & ~url("apply_url"))
    if has("government_profile.number_of_positions"):
        rule("number_of_positions.positive", F.col("government_profile.number_of_positions") < 1)

    if has("flags", "source_confidence"):
        rule("flags.sample_official", F.array_contains("flags", "sample") & (F.col("source_confidence") == "official"))
    if has("institution_profile.is_dfi_or_multilateral", "institution_profile.institution_type"):
        kind = F.coalesce(F.col("institution_profile.institution_type").isin(DFI_INSTITUTIONS), F.lit(False))
        rule("institution_profile.dfi_type", F.col("institution_profile.is_dfi_or_multilateral") & ~kind)
    for flag, (pack, name) in packs.items():
        if has(flag, pack):
            rule(f"{top(flag)}.source_pack", F.col(flag) & ~F.col(pack).eqNullSafe(name))
    if has("public_institution_profile.is_public_institution", "public_institution_profile.country_code"):
        rule("public_institution_profile.country", F.col("public_institution_profile.is_public_institution") & ~F.col("public_institution_profile.country_code").eqNullSafe("KE"))
    if has("investment_profile.is_investment_role", "role_family"):
        rule("investment_profile.role_family", F.col("investment_profile.is_investment_role") & ~F.col("role_family").eqNullSafe("investment"))
    return rules


def row_warnings(schema: StructType) -> dict[str, Column]:
    """What is worth a look but stops nothing: no link to apply, and contradictions that the rules leave alone."""
    found: dict[str, Column] = {}

    def look(name: str, bad: Column, *needs: str) -> None:
        if all(_type_of(schema, p) is not None for p in needs):
            found[name] = F.coalesce(bad, F.lit(False))

    col = F.col
    look("apply_url.missing", col("apply_url").isNull(), "apply_url")
    look("compensation.order", col("compensation.max") < col("compensation.min"), "compensation.min", "compensation.max")
    look("compensation.currency", ~col("compensation.currency").rlike("^[A-Z]{3}$"), "compensation.currency")
    look("citizenship.codes", col("government_profile.citizenship_required") & (F.size("government_profile.eligible_nationalities") < 1), "government_profile.citizenship_required", "government_profile.eligible_nationalities")
    look("investment.track", col("investment_profile.is_investment_role") & col("investment_profile.track").isNull(), "investment_profile.is_investment_role", "investment_profile.track")
    look("ngo.track", col("ngo_profile.is_programme_role") & col("ngo_profile.track").isNull(), "ngo_profile.is_programme_role", "ngo_profile.track")
    look("relevance.visible", (col("africa_relevance.status") == "non_african") & col("africa_relevance.default_visible"), "africa_relevance.status", "africa_relevance.default_visible")
    return found
