"""The chain from projected postings to enriched, scoped, de-duplicated and certified ones."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from jobloom import registries as R
from jobloom.functions import extract as X
from jobloom.functions.normalise import norm_ascii_fold, norm_unicode
from jobloom.operators import by_row as B
from jobloom.operators import classify as C
from jobloom.operators import dedup as D
from jobloom.operators import matching as M
from jobloom.operators import quality as V
from jobloom.operators.lexicon import held, normalised, once, together
from jobloom.operators.lineage import stored
from jobloom.operators.predicates import relevant, split_rejected
from jobloom.operators.row_rules import row_rules

_GOVERNMENT = "struct<advert_reference:string,public_service_grade:string,salary_scale:string,number_of_positions:int,citizenship_required:boolean,application_method:string,application_form_url:string,county_or_region_requirement:string,source_document_url:string,eligible_nationalities:array<string>,internal_only:boolean"
DEFAULTS = {
    "summary": "string", "eligibility_notes": "string", "location_raw": "string", "location_country": "string", "raw_terms": "array<string>", "source_key": "string", "source_url": "string", "source_label": "string", "mode_hint": "string", "industry": "string",
    "apply_url": "string", "apply_is_official": "boolean", "raw_description_url": "string", "deadline": "timestamp", "years_experience_min": "int", "education_required": "string", "contract_type": "string", "government_fields": f"{_GOVERNMENT}>", "government_profile": f"{_GOVERNMENT},is_government_or_public_service:boolean>",
}


@dataclass
class Registries:
    """The tables that enrichment joins with, all derived from registries of bounded size."""

    organisations: DataFrame
    sources: DataFrame
    platforms: dict[str, str]
    african_terms: DataFrame
    world_terms: DataFrame
    countries: DataFrame
    specialisations: DataFrame
    source_aliases: DataFrame
    ignored: DataFrame
    parents: DataFrame
    families: tuple[DataFrame, DataFrame, list[str]]
    themes: DataFrame
    investment: dict
    ngo: dict
    vocabularies: dict[str, list[str]] = field(default_factory=dict)  # what V1 allows besides its fixed values

    @classmethod
    def default(cls, spark: SparkSession) -> Registries:
        t, r = R.TAXONOMY, R.ROLES
        return cls(
            R.organisation_names(spark), R.source_table(spark), R.PLATFORM_DOMAINS, R.location_terms(spark), R.country_terms(spark), R.country_table(spark), R.alias_table(spark, "specialisations"),
            R.small_table(spark, t["source_aliases"], "source_key string, key string, target string"), R.small_table(spark, t["ignored"], "source_key string, key string"), R.small_table(spark, [(s[0], s[2]) for s in t["specialisations"]], "term string, parent string"),
            (R.map_table(spark, r["specialisation_family"], "s", "f"), R.map_table(spark, r["industry_family"], "i", "f"), r["families"]), R.map_table(spark, r["themes"], "key", "themes"), R.INVESTMENT, R.NGO, R.vocabularies(),
        )


#: What the organisation's profiles are made of; a posting's own columns of these names come back unchanged.
_EMPLOYER = ["source_pack", "sector", "priority", "cities"]


def _found_in_given_columns(given: DataFrame, g: Registries, missing: set[str]) -> DataFrame:
    """What the steps need of Python functions on given columns, together: one pass over batches, one worker for a task.
    Of a column that the postings don't have, all texts are empty."""
    rows = given
    for column, normaliser, prefix in (("org_name", norm_ascii_fold, "fold"), ("source_label", norm_ascii_fold, "fold"), ("location_country", norm_unicode, "norm"), ("mode_hint", norm_unicode, "norm")):
        rows = rows.withColumn(f"_{prefix}_{column}", F.lit("")) if column in missing else normalised(rows, column, normaliser, f"_{prefix}_{column}")
    rows = M.term_keys(rows, "raw_terms", "source_key")
    rows = M.place_hits(rows, g.african_terms, g.world_terms, "location_raw")
    return together(C.ngo_title_hits(C.investment_hits(rows, g.investment, "_body"), g.ngo), given)


def _whole(g: Registries, spark: SparkSession) -> dict[str, list[dict]] | None:
    """All registries of the chain as lists of entries; None if one of them is larger than may be sent to all tasks."""
    (titles, contexts), (ngo_titles, ngo_contexts) = C.investment_phrases(spark, g.investment), C.ngo_phrases(spark, g.ngo)
    tables = {
        "names": g.organisations, "sources": M.source_ways(g.sources, g.platforms), "terms": M.specialisation_ways(g.specialisations, g.source_aliases, g.ignored), "parents": g.parents, "african": g.african_terms,
        "world": M._country_names(g.world_terms), "nations": g.world_terms, "countries": g.countries, "families": M.family_keys(*g.families[:2]), "themes": g.themes.toDF("key", "themes"),
        "titles": titles, "contexts": contexts, "tracks": R.track_table(spark, g.investment), "ngo_titles": ngo_titles, "ngo_contexts": ngo_contexts, "ngo_tracks": R.track_table(spark, g.ngo),
    }
    found = {name: held(table) for name, table in tables.items()}
    return None if any(t is None for t in found.values()) else {name: t.to_pylist() for name, t in found.items()}


def _matched_by_row(given: DataFrame, g: Registries, w: dict[str, list[dict]]) -> DataFrame:
    """What depends on given columns, in one pass: organisation, location, terms, source and investment."""
    columns = StructType([f for f in g.organisations.schema.fields if f.name != "name_key"])
    found_source = StructType([f for f in g.sources.schema.fields if f.name in M.SOURCE_FIELDS])
    text = lambda c: F.col(c).cast("string")
    terms = (F.col("raw_terms").cast("array<string>"), text("source_key"))
    rows = given.withColumns({
        "_employer": B.employer_step(columns, w["names"], M.NAME_SUFFIXES)(text("org_name")),
        "_loc": B.place_step(StructType.fromDDL(B.LOC), w["african"], w["world"], w["countries"], M.EXPLICIT)(text("location_raw"), text("location_country")),
        "_terms": B.terms_step(StructType.fromDDL("specialisations array<string>, parent string"), w["terms"], w["parents"])(*terms),
        "_source": B.source_step(found_source, w["sources"])(M.host_of("source_url"), text("source_label")),
        "_investment": B.investment_step(StructType.fromDDL(B.INVESTMENT), g.investment, w["titles"], w["contexts"], w["tracks"], w["names"], M.NAME_SUFFIXES, w["terms"])(text("title"), text("_body"), text("org_name"), *terms),
        "_norm_mode_hint": norm_unicode("mode_hint"),
        "_named_industry": B.industry_step(StringType(), X.INDUSTRY_KEYWORDS)(F.when(F.col("industry").isNull(), X.industry_text("title", "summary"))),
    })
    return together(rows, given).withColumns({
        **{c: F.col("_employer")[c] for c in columns.names}, **{c: F.col("_source")[c] for c in M.SOURCE_FIELDS}, "loc": F.col("_loc"),
        "specialisations": F.col("_terms.specialisations"), "_parent_industry": F.col("_terms.parent"), "investment_profile": F.col("_investment"),
    })


def _matched_by_columns(given: DataFrame, g: Registries, missing: set[str]) -> DataFrame:
    """The same as _matched_by_row, but for the investment profile, by columns and joins."""
    rows = M.match_organisations(_found_in_given_columns(given, g, missing), g.organisations)
    rows = C.enrich_locations(rows, g.african_terms, g.world_terms, g.countries)
    rows = M.map_specialisations(rows, g.specialisations, g.source_aliases, g.ignored, "raw_terms", "source_key")
    rows = M.first_parent(M.match_sources(rows, g.sources, g.platforms), g.parents, "specialisations", "_parent_industry")
    untold = F.col("_parent_industry").isNull() & F.col("industry").isNull()
    rows = once(once(rows, {"_low": F.when(untold, X.industry_text("title", "summary"))}), {"_best_industry": F.when(untold, X.industry_found(F.col("_low")))})
    return once(rows, {"_named_industry": X.industry_named(F.col("_best_industry"))})


def _classified_by_row(rows: DataFrame, g: Registries, w: dict[str, list[dict]]) -> DataFrame:
    """What depends on the industry and the scope, in one pass: families and themes, NGO, and what relevance and access look up."""
    before = rows = once(once(rows, {"_all_text": C.access_text()}), {"_told": F.when(X.has("_all_text", C.NATIONALITY), F.col("_all_text"))})
    role, canonical = F.col("investment_profile.is_investment_role"), F.col("investment_profile.canonical_specialisation")
    subfamily = F.when(role & canonical.isNotNull(), canonical).otherwise(F.try_element_at("specialisations", F.lit(1)))
    family = StructType.fromDDL("role_family string, role_subfamily string, thematic_sectors array<string>")
    text = lambda c: F.col(c).cast("string")
    rows = rows.withColumns({
        "_family": B.family_step(family, w["families"], g.families[2], w["themes"])("specialisations", "industry", role, canonical),
        "_ngo": B.ngo_step(StructType.fromDDL(B.NGO), g.ngo, w["ngo_titles"], w["ngo_contexts"], w["ngo_tracks"])(text("title"), text("summary"), subfamily, "industry", "specialisations", "org_type"),
        "_known_world": B.world_step(StructType.fromDDL("iso2 string, name string, is_african boolean"), w["world"], w["countries"])(text("location_raw"), *C.known_country()),
        "_named": B.nations_step(ArrayType(StringType()), w["nations"])("_told"),
    })
    return together(rows, before).withColumns({**{c: F.col("_family")[c] for c in family.names}, "ngo_profile": F.col("_ngo")})


def _classified_by_columns(rows: DataFrame, g: Registries) -> DataFrame:
    """The same by columns and joins, and the investment profile."""
    rows = M.thematic_sectors(M.role_family(rows, *g.families), g.themes)
    rows = C.promote_role(C.investment_profile(rows, g.investment, "_body"), g.themes)
    return C.ngo_profile(C.hits_in_derived(rows, g.ngo, g.world_terms, place=True), g.ngo)


def enrich(postings: DataFrame, registries: Registries | None = None) -> DataFrame:
    """Organisation, location, role and investment, NGO, government, public institution, multinational,
    access, eligibility, source, in this order (an investment role's subfamily is read by the NGO classes).

    Registries are looked up inside of the rows (by_row.py), so the whole chain is one pass without a shuffle, a join
    or a key, whatever the postings hold: ids may repeat or be missing. If a registry is too large to be sent to
    all tasks, the chain goes by columns (lexicon.py), where that registry's step is a join on its distinct inputs.
    """
    g = registries or Registries.default(postings.sparkSession)
    own = {c: f"_given_{c}" for c in _EMPLOYER if c in postings.columns}
    missing = {c for c in DEFAULTS if c not in postings.columns}
    rows = postings.withColumnsRenamed(own).withColumns({c: F.lit(None).cast(DEFAULTS[c]) for c in sorted(missing)})
    # Inputs are computed before the pass, once, however the caller makes them.
    texts = [c for c in ("title", "summary", "org_name", "location_raw", "raw_terms", "source_key", "mode_hint", "source_label", "location_country") if c in postings.columns]
    rows = once(rows, {"_body": F.concat_ws(" ", "summary", "eligibility_notes")} | {c: F.col(c) for c in texts})
    whole = _whole(g, postings.sparkSession)
    rows = _matched_by_row(rows, g, whole) if whole else _matched_by_columns(rows, g, missing)

    code, region = F.col("loc.country_code"), F.col("loc.region")
    open_region = X.has("location_raw", X.OPEN_REGION)
    remote = X.has("location_raw", X.REMOTE) | open_region
    scope = F.when(code == "KE", "national").when(F.col("loc.is_african") & code.isNotNull(), "regional").when(code.isNotNull(), "international").when(remote & open_region, "international").when(region.isNotNull(), "regional")
    rows = once(rows, {
        "work_mode": X.work_mode("location_raw", F.col("_norm_mode_hint"), "loc.country_code", "loc.region"),
        "location_scope": scope,
        "is_remote_from_kenya": F.coalesce(remote & ((code == "KE") | (code.isNull() & (open_region | region.isNotNull()))), F.lit(False)),
        "industry": F.coalesce("_parent_industry", "industry", "_named_industry"),
    }).drop("_parent_industry", "_named_industry")
    rows = _classified_by_row(rows, g, whole) if whole else _classified_by_columns(rows, g)
    rows = once(rows, {"institution_profile": C.institution_profile(F.col("org_type")), "government_profile": C.government_profile(), "public_institution_profile": C.public_institution_profile(), "multinational_profile": C.multinational_profile()})
    rows = C.applicant_access(C.africa_relevance(rows, g.world_terms, g.countries), g.world_terms, g.countries)
    return rows.withColumn("eligibility", C.eligibility_from_access()).drop(*_EMPLOYER, *(c for c in rows.columns if c.startswith("_") and c not in own.values())).withColumnsRenamed({given: c for c, given in own.items()})


def _audit(rows: DataFrame, reason: str) -> DataFrame:
    return rows.select("id", "title", F.col("org_name").alias("organisation"), F.col("location_raw").alias("location"), F.lit(reason).alias("reason"))


def upgrade(postings: DataFrame, registries: Registries | None = None) -> dict[str, DataFrame]:
    """An older snapshot brought up to date: enriched again, known foreign duty stations rejected with an audit,
    duplicates resolved again, and counts of all of it. Returns published, rejected, stats."""
    out = refresh(postings, registries)
    rejected = _audit(out["rejected"], "known_non_african_without_africa_remit")
    one = out["kept"].agg(F.count("*").alias("published")).crossJoin(rejected.agg(F.count("*").alias("non_african_removed"))).crossJoin(out["events"].agg(F.count("*").alias("merged")))  # three single rows
    return {"published": out["kept"], "rejected": rejected, "stats": one.withColumn("input", F.col("published") + F.col("non_african_removed") + F.col("merged"))}


def migrate_baseline(postings: DataFrame, registries: Registries | None = None, is_sample: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with an audit) of a snapshot that must be clean afterwards.

    Rows stay if they are in Africa, open to it from afar, or offer mobility for the role (P5); samples all
    stay. Terms are mapped again by enrich(). If a kept row breaks a rule (V1) or repeats an id, nothing is
    migrated: an error says how many do.
    """
    g = registries or Registries.default(postings.sparkSession)
    african = M.african_codes(g.countries)
    rows = stored(enrich(postings, g).withColumns({"place_code": F.col("loc.country_code"), "in_africa": F.col("loc.is_african")}), "migrated")
    stays = F.lit(True) if is_sample else relevant("is_remote_from_kenya", "in_africa", "place_code", african, "summary")
    kept, gone = rows.where(stays).drop("place_code", "in_africa"), rows.where(~stays)
    bad = V.violations(kept, row_rules(kept.schema, g.vocabularies)).count() + V.duplicate_keys(kept, "id").count()
    if bad:
        raise ValueError(f"the migrated snapshot is not clean: {bad} errors")
    return kept, _audit(gone, "no verified African or global location, and no mobility tied to the role")


def refresh(postings: DataFrame, registries: Registries | None = None) -> dict[str, DataFrame]:
    """The full refresh after projection: enrich, reject what is out of scope, resolve duplicates.

    Returns kept, rejected and events; enriched rows are stored once, since many reports read them.
    """
    enriched = stored(enrich(postings, registries), "enriched")
    kept, rejected = split_rejected(enriched)
    public = F.struct(F.col("government_profile.is_government_or_public_service").alias("is_government"), F.col("government_profile.registry_id").alias("registry_id"), F.col("government_profile.advert_reference").alias("advert_reference"), F.col("government_profile.public_service_grade").alias("grade"))
    keyed = D.identity_keys(kept.withColumns({"country_code": F.col("loc.country_code"), "country": F.col("loc.country"), "city": F.col("loc.city"), "government": public}))
    winners, events = D.resolve_duplicates(keyed.withColumn("precedence", D.precedence(keyed)))
    return {"kept": winners, "rejected": rejected, "events": events}
