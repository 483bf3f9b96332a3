"""Classification of postings by phrase registries, and rules on who may apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.extract import eligibility_signals, has
from jobloom.functions.normalise import norm_ascii_fold, norm_ngo, norm_unicode, norm_word
from jobloom.operators.lexicon import derived, first, lookup, normalised, once, ordered, phrases_in, together, whole
from jobloom.operators.matching import african_codes, global_country, nationality_codes, resolve_locations
from jobloom.registries import remembered, small_table, track_phrases, track_table


def _none() -> Column:
    return F.array().cast("array<string>")


def _under(text: Column) -> Column:
    return F.regexp_replace(text, " ", "_")


@remembered
def _listed(spark, lists: dict[str, list[str]], taxonomy: dict, normaliser) -> DataFrame:
    """Phrases of titles in one registry: of tracks (kind title or context) and of lists (kind is the list's name)."""
    rows = small_table(spark, [(name, p, i) for name, words in lists.items() for i, p in enumerate(words)], "kind string, raw string, ord int")
    return track_phrases(spark, taxonomy, normaliser).unionByName(rows.withColumn("phrase", normaliser("raw")).drop("raw"), allowMissingColumns=True)


def _of_list(hits: str, name: str) -> Column:
    """Distinct phrases of a list in its order."""
    mine = F.filter(hits, lambda x: x["kind"] == name)
    return F.array_distinct(F.transform(ordered(mine, lambda x: x["ord"], phrase=lambda x: x["phrase"]), lambda x: x["phrase"]))


def _by_track(**hits: Column) -> Column:
    """One struct for each track that is hit, with a field for each kind of hit: its first entry's phrase.

    hits: arrays of structs (track_ord, track, classification, canonical, phrase), the deciding one first.
    """
    every = F.concat(*(F.transform(h, lambda x: F.struct(*(x[c].alias(c) for c in ("track_ord", "track", "classification", "canonical")))) for h in hits.values()))
    one = lambda h, t: first(F.filter(h, lambda x: x["track_ord"] == t["track_ord"]))["phrase"]
    return F.transform(F.array_distinct(every), lambda t: F.struct(t["track_ord"].alias("track_ord"), t["track"].alias("track"), t["classification"].alias("classification"), t["canonical"].alias("canonical"), *(one(h, t).alias(n) for n, h in hits.items())))


def _kind(hits: str, kind: str, *order) -> Column:
    fields = {c: (lambda x, c=c: x[c]) for c in ("track_ord", "track", "classification", "canonical", "phrase")}
    return ordered(F.filter(hits, lambda x: x["kind"] == kind), *order, **fields)


def _canonical(tracks: str) -> Column:
    fields = {c: (lambda x, c=c: x[c]) for c in ("track_ord", "track", "classification", "canonical")}
    return ordered(tracks, lambda x: x["track_ord"], phrase=lambda x: x["canonical"], **fields)


def _investment_lists(taxonomy: dict) -> dict[str, list[str]]:
    return {"absolute": taxonomy["absolute_negatives"], "hard": taxonomy["hard_negatives"], "support": taxonomy["support_titles"], "generic": taxonomy["generic_titles"]}


def _contexts(spark, taxonomy: dict, normaliser) -> DataFrame:
    return derived("contexts", lambda t: t.where("kind = 'context'"), track_phrases(spark, taxonomy, normaliser))


def investment_phrases(spark, taxonomy: dict) -> tuple[DataFrame, DataFrame]:
    """What investment_profile looks for in titles, and in the text beside them."""
    return _listed(spark, _investment_lists(taxonomy), taxonomy, norm_word), _contexts(spark, taxonomy, norm_word)


def ngo_phrases(spark, taxonomy: dict) -> tuple[DataFrame, DataFrame]:
    """What ngo_profile looks for in titles, and in the text beside them."""
    return _listed(spark, {"negatives": taxonomy["negatives"], "supports": taxonomy["support_titles"]}, taxonomy, norm_ngo), _contexts(spark, taxonomy, norm_ngo)


def investment_hits(postings: DataFrame, taxonomy: dict, body_col: str) -> DataFrame:
    """Adds what investment_profile finds in the title and the body, unless it is there already."""
    titles, contexts = investment_phrases(postings.sparkSession, taxonomy)
    return phrases_in(phrases_in(postings, "title", norm_word, titles, "phrase", "_investment_in_title"), body_col, norm_word, contexts, "phrase", f"_investment_in_{body_col}")


def ngo_title_hits(postings: DataFrame, taxonomy: dict) -> DataFrame:
    """Adds what ngo_profile finds in the title, unless it is there already."""
    return phrases_in(postings, "title", norm_ngo, ngo_phrases(postings.sparkSession, taxonomy)[0], "phrase", "_ngo_in_title")


def _set_aside(columns: list[str]) -> list[Column]:
    """Columns under names that a step's own don't clash with; not as one struct, which no reader could prune."""
    return [F.col(c).alias(f"_own_{c}") for c in columns]


def _back(columns: list[str]) -> list[Column]:
    return [F.col(f"_own_{c}").alias(c) for c in columns]


def investment_profile(postings: DataFrame, taxonomy: dict, body_col: str = "body") -> DataFrame:
    """Adds investment_profile. postings: title, body_col (text beside the title), specialisations, org_type.

    A track scores by canonical specialisation (.82), title phrase (.88 and up to .12 by length),
    context phrase in the title (.78) and in the body (.42). Title evidence outweighs negatives; an
    institution's own context only strengthens evidence that is there.
    """
    spark = postings.sparkSession
    own_columns = [c for c in postings.columns if c not in ("investment_profile", "_investment_in_title", f"_investment_in_{body_col}")]
    lists = _investment_lists(taxonomy)
    rows = investment_hits(postings, taxonomy, body_col)
    rows = once(rows, {"in_title": F.col("_investment_in_title"), "in_body": F.col(f"_investment_in_{body_col}"), "specs": F.coalesce("specialisations", _none()), "kind": F.coalesce("org_type", F.lit("unverified"))})
    rows = rows.select(*_set_aside(own_columns), "in_title", "in_body", "specs", F.col("kind").alias("org_type"))
    rows = lookup(rows, F.array_distinct("specs"), track_table(spark, taxonomy), "canonical", "in_specs")
    rows = once(rows, {
        "by_spec": _canonical("in_specs"), "by_title": _kind("in_title", "title", lambda x: -F.length(x["phrase"]), lambda x: x["ord"]),
        "by_context": _kind("in_title", "context", lambda x: x["ord"]), "by_body": _kind("in_body", "context", lambda x: x["ord"]),
    })
    rows = once(rows, {"tracks": _by_track(spec=F.col("by_spec"), title_phrase=F.col("by_title"), title_context=F.col("by_context"), body_context=F.col("by_body"))})

    def score(t: Column) -> Column:
        return (
            F.when(t["spec"].isNotNull(), 0.82).otherwise(0.0) + F.when(t["title_phrase"].isNotNull(), 0.88 + F.least(F.lit(0.12), F.length(t["title_phrase"]) / 250.0)).otherwise(0.0)
            + F.when(t["title_context"].isNotNull(), 0.78).otherwise(0.0) + F.when(t["body_context"].isNotNull(), 0.42).otherwise(0.0)
        )

    found = {c: (lambda x, c=c: x[c]) for c in ("track", "classification", "canonical", "spec", "title_phrase", "title_context", "body_context")}
    rows = once(rows, {"b": first(ordered("tracks", lambda t: -score(t), lambda t: t["track_ord"], score=score, **found))}).drop("by_spec", "by_title", "by_context", "by_body")
    rows = once(rows, {name: _of_list("in_title", name) for name in lists})
    fallback = next(t for t in taxonomy["tracks"] if t["id"] == taxonomy["fallback_track"])

    is_investment, is_dfi, is_finance = (F.col("org_type").isin(taxonomy[k]) for k in ("investment_types", "dfi_types", "finance_types"))
    some = lambda name: F.size(name) > 0
    top = lambda name: first(F.col(name))
    generic = some("generic") & (F.coalesce("b.score", F.lit(0.0)) < 0.75)
    prefixed = lambda prefix, col: F.when(F.col(col).isNotNull(), F.concat(F.lit(prefix), _under(F.col(col))))
    own = F.array_compact(F.array(F.when(F.col("b.spec").isNotNull(), F.concat(F.lit("canonical_specialisation:"), "b.spec")), prefixed("title_phrase:", "b.title_phrase"), prefixed("title_context:", "b.title_context"), prefixed("description_context:", "b.body_context")))
    rows = once(rows, {
        "track0": F.when(generic, F.lit(fallback["id"])).otherwise(F.col("b.track")),
        "class0": F.when(generic, F.lit(fallback["classification"])).otherwise(F.col("b.classification")),
        "canonical0": F.when(generic, F.lit(fallback["canonical"])).otherwise(F.col("b.canonical")),
        "score0": F.when(generic, F.lit(0.82)).otherwise(F.coalesce("b.score", F.lit(0.0))),
        "evidence0": F.when(generic, F.array(F.concat(F.lit("generic_investment_title:"), _under(top("generic"))))).otherwise(own),
        "by_title": (generic | F.col("b.title_phrase").isNotNull() | F.col("b.title_context").isNotNull()),
        "by_spec": (~generic & F.col("b.spec").isNotNull()),
    })
    dropped = some("absolute") | (some("hard") & ~F.col("by_title"))
    rows = once(rows, {"live": F.col("track0").isNotNull() & ~dropped})
    weak = ~F.col("by_title") & ~F.col("by_spec")
    institution = is_investment | is_dfi
    lifted = F.col("score0") + F.when(institution, F.when(weak, 0.30).otherwise(0.08)).when(is_finance, 0.04).otherwise(0.0)
    rows = once(rows, {"score1": lifted, "live": F.col("live") & ~(weak & (lifted < 0.55))})
    rows = once(rows, {"role": F.col("live") & (F.col("score1") >= 0.7)})
    role = F.col("role")
    context = F.when(institution, F.concat(F.lit("institution_context:"), "org_type")).when(is_finance, F.concat(F.lit("finance_institution_context:"), "org_type"))
    evidence = (
        F.when(role, F.array_distinct(F.concat(F.col("evidence0"), F.array_compact(F.array(context)))))
        .when(institution, F.array_compact(F.array(F.concat(F.lit("institution_context:"), "org_type"), F.when(some("support"), F.concat(F.lit("support_function:"), _under(top("support")))))))
        .otherwise(_none())
    )
    negative = F.concat(
        F.transform(F.concat("absolute", "hard"), lambda p: F.concat(F.lit("non_investment_title:"), _under(p))),
        F.array_compact(F.array(F.when(some("support") & ~role, F.concat(F.lit("support_function_title:"), _under(top("support")))), F.when(F.arrays_overlap("specs", F.lit(taxonomy["non_investment_specialisations"])) & ~role, F.lit("non_investment_finance_specialisation")))),
    )
    profile = F.struct(
        F.when(role, F.col("class0")).when(institution, "institutional_support").otherwise("not_investment").alias("classification"),
        F.when(role, F.col("track0")).alias("track"),
        F.when(role, F.col("canonical0")).alias("canonical_specialisation"),
        F.round(F.when(role, F.least(F.lit(0.98), "score1")).when(institution, F.when(some("support") | some("hard"), 0.88).otherwise(0.72)).otherwise(F.when(some("hard"), 0.92).otherwise(0.78)), 2).alias("confidence"),
        evidence.alias("evidence"),
        F.array_distinct(negative).alias("negative_evidence"),
        F.when(is_dfi & role, "direct_investment").when(is_dfi, "institutional_role").when(role, "adjacent_experience").otherwise("none").alias("dfi_relevance"),
        F.when(is_dfi & role, 0.96).when(is_dfi, 0.9).when(role, 0.76).otherwise(0.82).alias("dfi_confidence"),
        role.alias("is_investment_role"),
    )
    return rows.select(*_back(own_columns), whole(profile).alias("investment_profile"))


_CASE = "title string, summary string, organisation_type string, specialisations array<string>, expected_classification string, expected_track string, expected_programme_role boolean"


def corpus_report(spark, path: str, taxonomy: dict, kind: str) -> DataFrame:
    """Reviewed cases of a classifier (a JSON file {cases: [...]}) and whether it gets each exactly right.

    Columns: title, expected_classification, expected_track, classification, track, hit. kind is "investment" (C1) or
    "ngo" (C2, where being a programme role counts too). The hit rate is the mean of hit.
    """
    cases = spark.read.schema(f"cases array<struct<{', '.join(f.replace(' ', ':', 1) for f in _CASE.split(', '))}>>").json(path, multiLine=True).select(F.inline("cases"))
    rows = cases.withColumns({"body": F.col("summary"), "org_type": F.coalesce("organisation_type", F.lit("private")), "role_subfamily": F.lit(None).cast("string"), "industry": F.lit(None).cast("string")})
    if kind == "investment":
        judged, profile, also = investment_profile(rows, taxonomy), "investment_profile", F.lit(True)
    elif kind == "ngo":
        judged, profile = ngo_profile(rows, taxonomy), "ngo_profile"
        also = F.coalesce(F.col("expected_programme_role") == F.col("ngo_profile.is_programme_role"), F.lit(True))
    else:
        raise ValueError("kind is investment or ngo")
    judged = judged.withColumns({"classification": F.col(f"{profile}.classification"), "track": F.col(f"{profile}.track")})
    hit = F.col("classification").eqNullSafe(F.col("expected_classification")) & F.col("track").eqNullSafe(F.col("expected_track")) & also
    return judged.select("title", "expected_classification", "expected_track", "classification", "track", hit.alias("hit"))


def promote_role(postings: DataFrame, themes: DataFrame) -> DataFrame:
    """An investment role gets the family "investment", its canonical specialisation, and that one's themes."""
    role = F.col("investment_profile.is_investment_role")
    spec = F.col("investment_profile.canonical_specialisation")
    rows = lookup(postings, F.array(F.when(role, spec)), themes, "key", "_more")
    more = F.flatten(F.transform("_more", lambda x: x["themes"]))
    rows = once(rows, {"role_family": F.when(role, F.lit("investment")).otherwise(F.col("role_family")), "role_subfamily": F.when(role & spec.isNotNull(), spec).otherwise(F.col("role_subfamily"))})
    return once(rows, {"thematic_sectors": F.array_distinct(F.concat(F.coalesce("thematic_sectors", _none()), F.coalesce(more, _none())))}).drop("_more")


def ngo_profile(postings: DataFrame, taxonomy: dict) -> DataFrame:
    """Adds ngo_profile. postings: title, summary, role_subfamily, industry, specialisations, org_type.

    A title phrase lifts a track to .96 at least; only the first phrase in a list's order is evidence.
    """
    spark = postings.sparkSession
    own_columns = [c for c in postings.columns if c not in ("ngo_profile", "_ngo_in_title", "_ngo_in_context")]
    lists = {"negatives": taxonomy["negatives"], "supports": taxonomy["support_titles"]}
    rows = hits_in_derived(ngo_title_hits(postings, taxonomy), taxonomy)
    rows = once(rows, {"in_title": F.col("_ngo_in_title"), "in_context": F.col("_ngo_in_context"), "specs": F.coalesce("specialisations", _none()), "kind": F.coalesce("org_type", F.lit("unverified"))})
    rows = rows.select(*_set_aside(own_columns), "in_title", "in_context", "specs", F.col("kind").alias("org_type"))
    rows = lookup(rows, F.array_distinct("specs"), track_table(spark, taxonomy), "canonical", "in_specs")
    rows = once(rows, {"by_spec": _canonical("in_specs"), "by_title": _kind("in_title", "title", lambda x: x["ord"]), "by_context": _kind("in_context", "context", lambda x: x["ord"])})
    rows = once(rows, {"tracks": _by_track(spec=F.col("by_spec"), title_phrase=F.col("by_title"), context_phrase=F.col("by_context"))})

    def base(t: Column) -> Column:
        return F.when(t["title_phrase"].isNotNull(), F.lit(0.96)).when(t["spec"].isNotNull(), F.lit(0.82)).otherwise(F.lit(0.0))

    def uses_context(t: Column) -> Column:
        return (base(t) < 0.9) & t["context_phrase"].isNotNull()

    def score_of(t: Column) -> Column:
        return base(t) + F.when(uses_context(t), 0.24).otherwise(0.0)

    def evidence(t: Column) -> Column:
        return F.array_compact(F.array(
            F.when(t["spec"].isNotNull(), F.concat(F.lit("canonical_specialisation:"), t["spec"])), F.when(t["title_phrase"].isNotNull(), F.concat(F.lit("title_phrase:"), _under(t["title_phrase"]))),
            F.when(uses_context(t), F.concat(F.lit("context_phrase:"), _under(t["context_phrase"]))),
        ))

    found = {c: (lambda x, c=c: x[c]) for c in ("track", "classification", "canonical")}
    rows = once(rows, {"b": first(ordered("tracks", lambda t: -score_of(t), lambda t: t["track_ord"], score=score_of, evidence=evidence, **found))})
    rows = once(rows, {name: _of_list("in_title", name) for name in lists})

    is_ngo = F.col("org_type").isin(taxonomy["ngo_types"])
    score = F.coalesce("b.score", F.lit(0.0))
    joins_in = is_ngo & (score >= 0.45)
    rows = once(rows, {"s": F.when(joins_in, F.least(F.lit(0.99), score + 0.05)).otherwise(score)})
    rows = once(rows, {"s": F.when((F.size("negatives") > 0) & (F.col("s") < 0.9), F.greatest(F.lit(0.0), F.col("s") - 0.45)).otherwise(F.col("s"))})
    rows = once(rows, {"s": F.when((F.size("supports") > 0) & (F.col("s") < 0.9), F.greatest(F.lit(0.0), F.col("s") - 0.35)).otherwise(F.col("s"))})
    rows = once(rows, {"s": F.least(F.lit(0.99), F.greatest(F.lit(0.0), "s"))})
    programme = F.coalesce((F.col("s") >= 0.75) & F.col("b.track").isNotNull(), F.lit(False))
    groups = F.create_map(*(F.lit(x) for item in taxonomy["groups"].items() for x in item))
    warned = F.concat(F.transform("negatives", lambda p: F.concat(F.lit("title_phrase:"), _under(p))), F.transform("supports", lambda p: F.concat(F.lit("support_title:"), _under(p))))
    own = F.concat(F.col("b.evidence"), F.when(joins_in, F.array(F.lit("ngo_or_un_institution"))).otherwise(_none()))
    profile = F.struct(
        is_ngo.alias("is_ngo_or_un"),
        F.when(is_ngo, F.coalesce(F.try_element_at(groups, "org_type"), F.lit("ngo_or_development"))).otherwise("other").alias("organisation_group"),
        F.when(programme, F.col("b.classification")).when(is_ngo, "institutional_support").otherwise("not_ngo_un").alias("classification"),
        F.when(programme, F.col("b.track")).alias("track"),
        F.when(programme, F.col("b.canonical")).alias("canonical_specialisation"),
        F.round(F.when(programme, F.col("s")).when(is_ngo, F.when((F.size("negatives") > 0) | (F.size("supports") > 0), 0.82).otherwise(0.68)).otherwise(0.95), 2).alias("confidence"),
        F.when(programme, F.array_distinct(own)).when(is_ngo, F.array(F.lit("ngo_or_un_institution"))).otherwise(_none()).alias("evidence"),
        F.array_distinct(warned).alias("negative_evidence"),
        programme.alias("is_programme_role"),
    )
    return rows.select(*_back(own_columns), whole(profile).alias("ngo_profile"))


# ---- C3, C4. Wording of remit, scope and access.
AFRICA_REMIT = r"\b(?:africa|african|sub[- ]saharan|east africa|west africa|central africa|southern africa|north africa|pan[- ]african|afrique|africa ocidental|africa oriental|afrika mashariki|afrika magharibi)\b"
REMOTE_GLOBAL = r"\b(?:remote(?:ly)?|worldwide|global(?:ly)?|anywhere|location flexible|work from anywhere|emea|europe middle east and africa)\b"
AFRICA_ACCESS = r"\b(?:open to|applications? from|applicants? from|candidates? from|eligible applicants? from)\s+(?:all\s+)?(?:african countries|africa|the african continent|sub[- ]saharan africa)\b"
ANY_AFRICAN_NATIONAL = r"\b(?:citizens?|nationals?)\s+of\s+(?:any|all)\s+african\s+(?:country|countries|states?)\b|\bopen to african (?:citizens?|nationals?)\b"
INTERNATIONAL = r"\b(?:international applicants? (?:are )?(?:welcome|eligible|encouraged)|open to international applicants?|internationally recruited|global recruitment|visa sponsorship (?:is )?(?:available|provided)|relocation support (?:is )?provided)\b"
WORK_AUTHORISATION = r"\b(?:must|should|required to)\s+(?:already\s+)?(?:have|hold|possess)\s+(?:valid\s+)?(?:work authori[sz]ation|right to work|work permit)|\bno (?:visa|work permit) sponsorship\b|\bwithout sponsorship\b"
LOCAL_ONLY = r"\b(?:local candidates? only|local applicants? only|locally recruited|local hire|local contract)\b"
NATIONALITY = r"\b(?:national position|national officer|nationals? only|citizens? only|must be (?:a |an )?(?:[a-z -]+ )?(?:nationals?|citizens?)|only (?:[a-z -]+ )?(?:nationals?|citizens?)|restricted to (?:[a-z -]+ )?(?:nationals?|citizens?))\b"
INTERNAL = r"\b(?:internal candidates? only|internal applicants? only|staff only)\b"
NOT_OPEN = r"\b(?:not open to international applicants?|no international applicants?|applicants? must reside in|must be based in (?:the )?united states|us residents? only|canada residents? only)\b"
OFFICIAL_KINDS = ["employer_ats", "employer_official", "government_official", "institution_official"]

_RELEVANCE = "status string, confidence double, evidence array<string>, certification_level string, default_visible boolean, known_country_code string, known_country_name string"


def access_text() -> Column:
    return F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("title", "summary", "eligibility_notes", "location_raw", "location_scope", "work_mode")))


def known_country() -> tuple[Column, Column]:
    """The code and the name by which africa_relevance looks up a row's country."""
    return F.coalesce("loc.country_code", "loc.country_iso3"), F.coalesce("loc.country", "location_country")


def hits_in_derived(postings: DataFrame, ngo: dict | None = None, terms: DataFrame | None = None, place: bool = False) -> DataFrame:
    """Adds what ngo_profile finds beside the title (ngo), africa_relevance of the known country's name (place) and
    applicant_access of nationalities (terms), unless it is there already. Inputs come first and all texts are read in
    one pass. Only texts are searched for nationalities that say something of them."""
    inputs, text = {}, access_text()
    if ngo is not None and "_ngo_in_context" not in postings.columns:
        inputs["_context"] = F.concat_ws(" ", "title", "summary", "role_subfamily", "industry")
    if place and "_norm_known_name" not in postings.columns:
        inputs["_known_name"] = known_country()[1]
    if terms is not None and "_nations_in__told" not in postings.columns:
        inputs["_told"] = F.when(has(text, NATIONALITY), text)
    rows = once(postings, inputs) if inputs else postings
    if "_context" in inputs:
        rows = phrases_in(rows, "_context", norm_ngo, _contexts(rows.sparkSession, ngo, norm_ngo), "phrase", "_ngo_in_context")
    if "_known_name" in inputs:
        rows = normalised(rows, "_known_name", norm_unicode, "_norm_known_name")
    if "_told" in inputs:
        rows = phrases_in(rows, "_told", norm_unicode, terms, "term", "_nations_in__told")
    return together(rows.drop(*inputs), postings)


def africa_relevance(postings: DataFrame, terms: DataFrame, countries: DataFrame) -> DataFrame:
    """Adds africa_relevance, the first of eight states that holds.

    postings: id, title, summary, eligibility_notes, location_raw, location_scope, work_mode,
    loc (as resolve_locations gives it), location_country, is_remote_from_kenya, apply_is_official,
    apply_url, source_confidence, source_kind.
    """
    if "_known_world" in postings.columns:  # the chain by rows has found it, and made the text
        rows = postings.withColumns({"world": F.col("_known_world"), "all_text": F.col("_all_text")})
    else:
        code, name = known_country()
        rows = once(hits_in_derived(postings, place=True), {"known_code": code, "known_name": name, "all_text": access_text()})
        rows = global_country(rows, terms, countries, "location_raw", "known_code", "known_name", "world")
    text = F.col("all_text")
    african = F.coalesce(F.col("loc.is_african"), F.lit(False)) | F.coalesce(F.col("world.is_african"), F.lit(False))
    foreign = F.coalesce(~F.col("world.is_african"), F.lit(False))
    remit, access = has(text, AFRICA_REMIT), has(text, AFRICA_ACCESS)
    remote = has(text, REMOTE_GLOBAL) | F.coalesce("is_remote_from_kenya", F.lit(False))
    official = F.coalesce("apply_is_official", F.lit(False)) | F.coalesce(F.col("source_confidence") == "official", F.lit(False)) | F.coalesce(F.col("source_kind").isin(OFFICIAL_KINDS), F.lit(False))
    specific = (F.length(F.trim(F.coalesce("title", F.lit("")))) >= 4) & F.coalesce("apply_url", F.lit("")).rlike("^https?://")

    def state(status: str, confidence: float, evidence: list[str], level: str, visible: bool, named: bool) -> Column:
        code, name = (F.col("world.iso2"), F.col("world.name")) if named else (F.lit(None).cast("string"),) * 2
        return F.struct(F.lit(status).alias("status"), F.lit(confidence).alias("confidence"), F.array(*map(F.lit, evidence)).alias("evidence"), F.lit(level).alias("certification_level"), F.lit(visible).alias("default_visible"), code.alias("known_country_code"), name.alias("known_country_name"))

    profile = (
        F.when(african, state("africa_based_confirmed", 0.99, ["physical_duty_station_in_africa"], "certified", True, True))
        .when(foreign & remit, state("africa_remit_non_african_location", 0.9, ["known_non_african_duty_station", "explicit_africa_remit"], "conditional", True, True))
        .when(foreign, state("non_african", 0.99, ["known_non_african_duty_station"], "excluded", False, True))
        .when(remote & (access | (remit & F.lower(text).contains("remote"))), state("remote_confirmed_open_to_africa", 0.9, ["remote_or_global_role", "explicit_africa_access"], "certified", True, False))
        .when(remit, state("africa_regional", 0.84, ["explicit_africa_region_or_remit"], "conditional", True, False))
        .when(remote, state("global_access_unconfirmed", 0.64, ["global_or_remote_scope", "african_access_not_confirmed"], "unverified", False, False))
        .when(official & specific, state("official_location_pending", 0.55, ["verified_official_vacancy", "duty_station_not_confirmed"], "unverified", False, False))
        .otherwise(state("unresolved", 0.2, ["insufficient_geographic_evidence"], "unverified", False, False))
    )
    return rows.withColumn("africa_relevance", whole(profile)).drop("known_code", "known_name", "_norm_known_name", "world", "all_text")


def applicant_access(postings: DataFrame, terms: DataFrame, countries: DataFrame) -> DataFrame:
    """C4: adds african_applicant_access, the first of nine states that holds; structured government
    data come before wording. Needs africa_relevance and government_profile (may be null)."""
    african = african_codes(countries)
    if "_named" in postings.columns:  # the chain by rows has found them in _told, and made the text
        rows = postings.withColumns({"named": F.col("_named"), "all_text": F.col("_all_text")})
    else:
        rows = nationality_codes(once(hits_in_derived(postings, terms=terms), {"all_text": access_text()}), terms, "_told", "named")
    text = F.col("all_text")
    required = F.coalesce("government_profile.citizenship_required", F.lit(False))
    told = F.array_sort(F.array_distinct(F.transform(F.coalesce("government_profile.eligible_nationalities", _none()), F.upper)))
    known = F.col("africa_relevance.known_country_code")
    detected = F.when(F.size(F.coalesce("named", _none())) > 0, F.col("named")).when(known.isNotNull(), F.array(known)).otherwise(_none())
    of_africa = lambda xs: F.filter(xs, lambda c: c.isin(african))
    elsewhere = lambda xs: F.filter(xs, lambda c: ~c.isin(african))

    def state(status: str, confidence: float, evidence: str, strength: str, nationalities: Column, citizenship, permit, level: str) -> Column:
        boolean = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("boolean")
        return F.struct(F.lit(status).alias("status"), F.lit(confidence).alias("confidence"), F.array(F.lit(evidence)).alias("evidence"), F.lit(strength).alias("evidence_strength"), nationalities.alias("eligible_nationalities"), boolean(citizenship).alias("citizenship_required"), boolean(permit).alias("work_authorisation_required"), F.lit(level).alias("certification_level"))

    given = F.col("government_profile.citizenship_required")
    structured = required & (F.size(told) > 0)
    named = F.col("_told").isNotNull() if "_told" in postings.columns else has(text, NATIONALITY)
    profile = (
        F.when(F.coalesce("government_profile.internal_only", F.lit(False)) | has(text, INTERNAL), state("internal_only", 0.99, "structured_or_explicit_internal_only", "explicit", told, given, None, "excluded"))
        .when(structured & (F.size(of_africa(told)) > 0), state("confirmed_specific_african_nationality", 0.99, "structured_government_citizenship_requirement", "structured_source", of_africa(told), True, None, "certified"))
        .when(structured, state("not_open", 0.99, "structured_non_african_citizenship_requirement", "structured_source", told, True, None, "excluded"))
        .when(has(text, ANY_AFRICAN_NATIONAL), state("confirmed_any_african_national", 0.96, "explicit_any_african_nationality", "explicit", _none(), False, None, "certified"))
        .when(has(text, NOT_OPEN), state("not_open", 0.95, "explicit_not_open_to_international_or_african_applicants", "explicit", _none(), None, None, "excluded"))
        .when(has(text, WORK_AUTHORISATION), state("work_authorisation_required", 0.92, "explicit_existing_work_authorisation_required", "explicit", _none(), None, True, "conditional"))
        .when(named & (F.size(of_africa(detected)) > 0), state("confirmed_specific_african_nationality", 0.96, "explicit_african_nationality_requirement", "explicit", of_africa(detected), True, None, "certified"))
        .when(named & (F.size(elsewhere(detected)) > 0), state("not_open", 0.96, "explicit_non_african_nationality_requirement", "explicit", elsewhere(detected), True, None, "excluded"))
        .when(named, state("local_only", 0.88, "explicit_nationality_requirement_country_unresolved", "explicit", _none(), True, None, "conditional"))
        .when(has(text, LOCAL_ONLY), state("local_only", 0.9, "explicit_local_recruitment", "explicit", _none(), None, True, "conditional"))
        .when(has(text, INTERNATIONAL), state("confirmed_international_recruitment", 0.94, "explicit_international_recruitment", "explicit", _none(), False, None, "certified"))
        .when(has(text, AFRICA_ACCESS), state("likely_open", 0.88, "explicit_africa_applicant_access", "explicit", _none(), False, None, "conditional"))
        .when(F.col("africa_relevance.status") == "remote_confirmed_open_to_africa", state("likely_open", 0.82, "remote_confirmed_open_to_africa", "strong_inference", _none(), None, None, "conditional"))
        .otherwise(state("unknown", 0.25, "applicant_access_not_stated", "none", told, given, None, "unverified"))
    )
    return rows.withColumn("african_applicant_access", whole(profile)).drop("all_text", "named")


#: Access status -> legacy eligibility.
LEGACY_ELIGIBILITY = {
    "confirmed_any_african_national": "eligible", "confirmed_specific_african_nationality": "citizenship_restricted", "confirmed_international_recruitment": "eligible", "likely_open": "likely_eligible",
    "work_authorisation_required": "uncertain", "local_only": "local_only", "internal_only": "internal_only", "unknown": "uncertain", "not_open": "ineligible",
}


def eligibility_from_access() -> Column:
    """The legacy eligibility struct of african_applicant_access."""
    a = F.col("african_applicant_access")
    status = F.create_map(*(F.lit(x) for item in LEGACY_ELIGIBILITY.items() for x in item))
    same = ["confidence", "citizenship_required", "eligible_nationalities", "work_authorisation_required", "evidence", "evidence_strength"]
    return F.struct(F.try_element_at(status, a["status"]).alias("status"), *(a[c].alias(c) for c in same))


def eligibility_from_text(text: Column, remote_from_kenya: Column, work_mode: Column, country_code: Column) -> Column:
    """Eligibility where there is no registry of countries: struct (status, confidence, evidence)."""
    signals, plain = eligibility_signals(text), norm_ascii_fold(text)
    internal = signals["internal_only"] | has(plain, r"\b(internal candidates? only|internal applicants? only|staff only)\b")
    local = signals["local_only"] | has(plain, r"\b(local candidates? only|nationals? only|national position|local hire)\b")
    citizen = signals["citizenship"] | has(plain, r"\b(must be|only) (?:a |an )?[a-z ]+ (?:citizen|national)\b")
    permit = signals["work_auth"] | has(plain, r"\b(must have|require[sd]?) (?:existing |valid )?(?:work authori[sz]ation|right to work|work permit)\b")
    state = lambda status, confidence, *evidence: F.struct(F.lit(status).alias("status"), F.lit(confidence).alias("confidence"), F.array(*map(F.lit, evidence)).alias("evidence"))
    remote = F.coalesce(remote_from_kenya, F.lit(False))
    return (
        F.when(internal, state("internal_only", 0.98, "internal_candidate_only"))
        .when(citizen, state("citizenship_restricted", 0.9, "citizenship_or_local_recruitment_restriction"))
        .when(local, state("local_only", 0.9, "citizenship_or_local_recruitment_restriction"))
        .when(permit, state("uncertain", 0.82, "existing_work_authorisation_required"))
        .when(signals["international"], state("likely_eligible", 0.9, "international_applicants_explicitly_welcome"))
        .when(remote & (work_mode == "remote_kenya"), state("likely_eligible", 0.92, "remote_from_kenya"))
        .when(remote & ((work_mode == "remote_regional") | plain.contains("emea") | plain.contains("africa")), state("likely_eligible", 0.82, "remote_regional_or_africa"))
        .when(remote, state("likely_eligible", 0.78, "remote_global_or_worldwide"))
        .when(country_code == "KE", state("likely_eligible", 0.86, "duty_station_in_kenya"))
        .when(country_code.isNotNull(), state("uncertain", 0.62, "duty_station_in_africa", "work_authorisation_unknown"))
        .otherwise(state("uncertain", 0.35, "insufficient_eligibility_evidence"))
    )


# ---- C7 to C10: profiles of the employer, after match_organisations. Kinds of institutions.
DFI_TYPES = ["dfi", "development_bank", "multilateral", "investment_firm", "asset_manager", "private_equity", "venture_capital"]
GOVERNMENT_TYPES = ["government", "regulator", "state_owned_enterprise", "university"]
GOVERNMENT_FIELDS = ["advert_reference", "public_service_grade", "salary_scale", "number_of_positions", "citizenship_required", "application_method", "application_form_url", "county_or_region_requirement", "source_document_url"]


def institution_profile(org_type: Column) -> Column:
    kind = F.coalesce(org_type, F.lit("unverified"))
    pack = F.col("source_pack")
    return F.struct(kind.isin(DFI_TYPES).alias("is_dfi_or_multilateral"), kind.alias("institution_type"), F.col("org_id").alias("registry_id"), pack.alias("source_pack"), F.coalesce(pack == "dfi", F.lit(False)).alias("priority_institution"))


def government_profile(fields: str = "government_fields", before: str = "government_profile") -> Column:
    """Fields of the raw advert win over an existing profile as soon as the advert has fields at
    all (a null among them counts); nationalities win only if there are any."""
    raw, old = F.col(fields), F.col(before)
    kind, pack = F.coalesce("org_type", F.lit("unverified")), F.col("source_pack")
    either = lambda name: F.when(raw.isNotNull(), raw[name]).otherwise(old[name]).alias(name)
    told = lambda xs: F.when(F.size(F.coalesce(xs, _none())) > 0, xs)
    is_government = kind.isin(GOVERNMENT_TYPES) | F.coalesce(pack.isin("government", "public_institution"), F.lit(False)) | F.coalesce(old["is_government_or_public_service"], F.lit(False))
    return F.struct(
        is_government.alias("is_government_or_public_service"), kind.alias("institution_type"), F.col("org_id").alias("registry_id"), pack.alias("source_pack"), *map(either, GOVERNMENT_FIELDS),
        F.coalesce(told(raw["eligible_nationalities"]), told(old["eligible_nationalities"]), _none()).alias("eligible_nationalities"),
        F.coalesce(F.when(raw.isNotNull(), raw["internal_only"]).otherwise(old["internal_only"]), F.lit(False)).alias("internal_only"),
    )


def public_institution_profile() -> Column:
    ours = F.coalesce(F.col("source_pack") == "public_institution", F.lit(False))
    return F.struct(ours.alias("is_public_institution"), F.col("sector").alias("category"), F.col("org_id").alias("registry_id"), F.when(ours, F.lit("KE")).alias("country_code"))


def multinational_profile() -> Column:
    is_one = F.coalesce(F.col("org_type") == "multinational", F.lit(False)) | F.coalesce(F.col("source_pack") == "multinational", F.lit(False))
    return F.struct(is_one.alias("is_multinational"), F.col("sector").alias("sector"), F.col("org_id").alias("registry_id"), F.coalesce("priority", F.lit(False)).alias("priority_employer"), F.coalesce("cities", _none()).alias("african_city_footprint"))


def enrich_locations(postings: DataFrame, african_terms: DataFrame, world_terms: DataFrame, countries: DataFrame) -> DataFrame:
    """C11: resolve African places; where no country code is found, look among all countries."""
    rows = resolve_locations(postings, african_terms, countries).withColumn("no_code", F.lit(None).cast("string"))
    rows = global_country(rows, world_terms, countries, "location_raw", "no_code", "location_country", "world")
    use = F.col("loc.country_code").isNull() & F.col("world").isNotNull()
    rows = lookup(rows, F.array("world.iso2"), countries, "iso2", "_states").withColumn("w3", first(F.col("_states"))["iso3"])
    loc = (
        F.col("loc")
        .withField("country_code", F.when(use, F.col("world.iso2")).otherwise(F.col("loc.country_code")))
        .withField("country_iso3", F.when(use, F.col("w3")).otherwise(F.col("loc.country_iso3")))
        .withField("country", F.when(use, F.col("world.name")).otherwise(F.coalesce("loc.country", "location_country")))
        .withField("region", F.when(use & ~F.col("world.is_african"), F.lit("Non-Africa")).otherwise(F.col("loc.region")))
        .withField("is_african", F.when(use, F.col("world.is_african")).otherwise(F.col("loc.is_african")))
        .withField("known_non_african", use & ~F.coalesce("world.is_african", F.lit(True)))
        .withField("confidence", F.when(use, F.greatest(F.col("loc.confidence"), F.lit(0.96))).otherwise(F.col("loc.confidence")))
    )
    return rows.withColumn("loc", whole(loc)).drop("world", "no_code", "w3", "_states")
