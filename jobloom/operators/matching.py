"""Matching texts and names with registries: inside of rows while a registry is small, by hash joins beyond.

Steps add columns to the rows they are given and need no key of these: see lexicon.py.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.normalise import norm_ascii_fold, norm_unicode, taxonomy_key, taxonomy_keys
from jobloom.operators.lexicon import derived, first, grams, held, lookup, normalised, once, only, ordered, phrases_in, whole


def phrase_hits(rows: DataFrame, text: str, phrases: DataFrame, phrase: str = "phrase", most: int | None = None) -> DataFrame:
    """Every (row, phrase) for which the phrase is in the text; all columns of phrases, and "at", the first position.

    The long form: a row for each hit. most is the number of tokens of the longest phrase, looked up if not given.
    """
    if most is None:
        most = phrases.agg(F.max(F.size(F.split(phrase, " ")))).first()[0] or 1
    each = rows.withColumn("g", F.explode(grams(F.coalesce(text, F.lit("")), most))).withColumn(phrase, F.col("g.key")).withColumn("at", F.col("g.at")).drop("g", text)
    return each.join(phrases, phrase)


def _texts() -> Column:
    return F.array().cast("array<string>")


def _prefixed(prefix: str, values: Column) -> Column:
    return F.transform(values, lambda x: F.concat(F.lit(prefix), x))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


# ---- J1: organisations.
#: Endings of names that hosted boards add.
NAME_SUFFIXES = [" careers", " jobs", " plc", " limited", " ltd"]


def match_organisations(postings: DataFrame, names: DataFrame, name_col: str = "org_name") -> DataFrame:
    """The organisation of a name or alias, else of the name less one suffix; all columns of names are added."""
    rows = normalised(postings, name_col, norm_ascii_fold, f"_fold_{name_col}").withColumn("_name", F.col(f"_fold_{name_col}"))
    less = [F.when(F.col("_name").endswith(s), F.trim(F.expr(f"left(_name, length(_name) - {len(s)})"))) for s in NAME_SUFFIXES]
    keys = F.transform(F.array(F.col("_name"), *less), lambda k: F.when(k != "", k))
    kept = {c: (lambda x, c=c: x[c]) for c in names.columns if c != "name_key"}
    rows = once(lookup(rows, keys, names, "name_key", "_orgs"), {"_org": first(ordered("_orgs", lambda x: x["at"], **kept))})
    return only(rows.withColumns({c: F.col("_org")[c] for c in kept}), postings, *kept)


# ---- J2: sources.
SOURCE_FIELDS = ["source_id", "source_kind", "source_confidence"]


def source_ways(sources: DataFrame, platforms: dict[str, str]) -> DataFrame:
    """(key, stage, nth, fields) of every way to a source."""

    def ways(sources: DataFrame) -> DataFrame:
        made = [
            sources.where("domain is not null").select(F.concat(F.lit("d:"), F.lower("domain")).alias("key"), F.lit(0).alias("stage"), F.col("rank").alias("nth"), *SOURCE_FIELDS),
            sources.select(F.concat(F.lit("n:"), norm_ascii_fold("source_name")).alias("key"), F.lit(1).alias("stage"), (-F.col("rank")).alias("nth"), *SOURCE_FIELDS),
        ]
        if platforms:
            served = F.from_json(F.lit(json.dumps(platforms)), "map<string,string>")
            hosts = sources.select("*", F.explode(F.map_keys(F.map_filter(served, lambda _, v: v == F.col("source_id")))).alias("host"))
            made.append(hosts.select(F.concat(F.lit("p:"), "host").alias("key"), F.lit(2).alias("stage"), F.col("rank").alias("nth"), *SOURCE_FIELDS))
        return _union(made)

    return derived(f"sources {sorted(platforms.items())}", ways, sources)


def host_of(url_col: str) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url_col, F.lit("HOST")), F.lit("")))


def match_sources(postings: DataFrame, sources: DataFrame, platforms: dict[str, str], url_col: str = "source_url", name_col: str = "source_label") -> DataFrame:
    """By host or a parent domain (in the registry's order), else by name, else by the platform's domain."""
    fields = SOURCE_FIELDS
    rows = once(normalised(postings, name_col, norm_ascii_fold, f"_fold_{name_col}"), {"_parts": F.split(host_of(url_col), r"\."), "_label": F.col(f"_fold_{name_col}")})
    parents = F.filter(F.transform(F.sequence(F.lit(1), F.size("_parts")), lambda i: F.array_join(F.slice("_parts", i, F.size("_parts")), ".")), lambda d: d != "")
    rows = once(rows, {"_parents": parents})
    keys = F.concat(_prefixed("d:", F.col("_parents")), F.array(F.when(F.col("_label") != "", F.concat(F.lit("n:"), "_label"))), _prefixed("p:", F.col("_parents")))
    rows = lookup(rows, keys, source_ways(sources, platforms), "key", "_found")
    best = first(ordered("_found", lambda x: x["stage"], lambda x: x["nth"], **{c: (lambda x, c=c: x[c]) for c in fields}))
    return only(once(rows, {"_best": best}).withColumns({c: F.col("_best")[c] for c in fields}), postings, *fields)


# ---- J3 to J10: taxonomy.
def map_alias(postings: DataFrame, aliases: DataFrame, raw_col: str, out: str) -> DataFrame:
    """The target of a raw label; null if there is none. Of several targets the smallest."""
    rows = lookup(postings, F.array(taxonomy_key(raw_col)), aliases, "key", "_found")
    return rows.withColumn(out, F.array_min(F.transform("_found", lambda x: x["target"]))).drop("_found")


def _raw_terms(postings: DataFrame, raw_col: str, id_col: str, source_col: str | None = None) -> DataFrame:
    source = taxonomy_key(F.coalesce(source_col, F.lit("*"))) if source_col else F.lit("*")
    return postings.select(id_col, source.alias("source_key"), F.posexplode(raw_col).alias("pos", "raw")).where("raw is not null and raw != ''").withColumn("key", taxonomy_key("raw"))


def resolve_specialisations(postings: DataFrame, aliases: DataFrame, source_aliases: DataFrame, ignored: DataFrame, raw_col: str, source_col: str, id_col: str = "id") -> DataFrame:
    """One row for each raw term that isn't ignored: its target, or null if it is unmapped or the target unknown.

    The long form, for audits. source_aliases (source_key, key, target) and ignored (source_key, key) hold "*" for all sources.
    """
    terms = _raw_terms(postings, raw_col, id_col, source_col)
    everywhere = ignored.where("source_key = '*'").select("key")
    kept = terms.join(everywhere, "key", "left_anti").join(ignored, ["source_key", "key"], "left_anti")
    own = source_aliases.select("source_key", "key", F.col("target").alias("t1"))
    shared = source_aliases.where("source_key = '*'").select("key", F.col("target").alias("t2"))
    found = kept.join(own, ["source_key", "key"], "left").join(shared, "key", "left").join(aliases.select("key", F.col("target").alias("t3")), "key", "left")
    known = aliases.select(F.col("target").alias("mapped"), F.lit(True).alias("known")).distinct()
    return found.withColumn("mapped", F.coalesce("t1", "t2", "t3")).join(known, "mapped", "left").select(id_col, "source_key", "key", "raw", "pos", F.when(F.col("known"), F.col("mapped")).alias("target"))


def term_keys(postings: DataFrame, raw_col: str, source_col: str) -> DataFrame:
    """Adds the keys of raw terms and of the source ("*" for none), unless they are there already."""
    rows = normalised(postings, source_col, lambda c: taxonomy_key(F.coalesce(c, F.lit("*"))), f"_key_{source_col}")
    return normalised(rows, raw_col, lambda c: taxonomy_keys(F.filter(F.coalesce(c, _texts()), lambda x: x != "")), f"_keys_{raw_col}")


def specialisation_ways(aliases: DataFrame, source_aliases: DataFrame, ignored: DataFrame) -> DataFrame:
    """(probe, way, target) of what is ignored, of sources' aliases and of the taxonomy."""

    def ways(aliases: DataFrame, source_aliases: DataFrame, ignored: DataFrame) -> DataFrame:
        scoped = lambda kind: F.concat_ws("\x1f", F.lit(kind), "source_key", "key").alias("probe")
        known = aliases.select(F.col("target").alias("known")).distinct()
        return _union([
            ignored.select(scoped("ignored"), F.lit(0).alias("way"), F.lit(None).cast("string").alias("target")),
            source_aliases.join(known, F.col("target") == F.col("known"), "left").select(scoped("source"), F.lit(1).alias("way"), F.col("known").alias("target")),
            aliases.select(F.concat_ws("\x1f", F.lit("taxonomy"), "key").alias("probe"), F.lit(3).alias("way"), "target"),
        ])

    return derived("specialisations", ways, aliases, source_aliases, ignored)


def map_specialisations(postings: DataFrame, aliases: DataFrame, source_aliases: DataFrame, ignored: DataFrame, raw_col: str, source_col: str, out: str = "specialisations", limit: int = 3) -> DataFrame:
    """Distinct targets, the first `limit` in order. The source's own alias counts before a shared one, both
    before the taxonomy; an alias whose target isn't in the taxonomy maps to nothing."""
    rows = term_keys(postings, raw_col, source_col)
    rows = rows.withColumns({"_src": F.col(f"_key_{source_col}"), "_keys": F.col(f"_keys_{raw_col}")})
    probes = F.flatten(F.transform("_keys", lambda k: F.array(
        F.concat_ws("\x1f", F.lit("ignored"), F.lit("*"), k), F.concat_ws("\x1f", F.lit("ignored"), "_src", k), F.concat_ws("\x1f", F.lit("source"), "_src", k),
        F.concat_ws("\x1f", F.lit("source"), F.lit("*"), k), F.concat_ws("\x1f", F.lit("taxonomy"), k),
    )))
    rows = lookup(rows, probes, specialisation_ways(aliases, source_aliases, ignored), "probe", "_found")
    # Five probes for each term: its first entry decides, ignored ones before all.
    by_term = ordered("_found", lambda x: x["at"], term=lambda x: F.floor((x["at"] - 1) / 5), way=lambda x: x["way"], target=lambda x: x["target"])
    rows = once(rows, {"_found": by_term})
    told = F.transform(F.sequence(F.lit(0).cast("bigint"), F.size("_keys").cast("bigint")), lambda t: first(F.filter("_found", lambda x: x["term"] == t))["target"])
    return only(once(rows, {out: F.slice(F.array_distinct(F.array_compact(told)), 1, limit)}), postings, out)


def map_skills(postings: DataFrame, aliases: DataFrame, raw_col: str, out: str = "skills") -> DataFrame:
    """Distinct targets in order; unmapped terms drop."""
    keys = taxonomy_keys(F.filter(F.coalesce(raw_col, _texts()), lambda x: x != ""))
    rows = lookup(postings, keys, aliases, "key", "_found")
    return rows.withColumn(out, F.array_distinct(F.transform(ordered("_found", lambda x: x["at"], t=lambda x: x["target"]), lambda x: x["t"]))).drop("_found")


def unmapped_terms(resolved: DataFrame) -> DataFrame:
    """Each term without a target once for each source."""
    return resolved.where("target is null").select("source_key", "key").distinct()


def first_parent(postings: DataFrame, parents: DataFrame, terms_col: str, out: str) -> DataFrame:
    """Of the terms in order, the first one's parent that isn't null. parents: (term, parent)."""
    rows = lookup(postings, F.col(terms_col), parents, "term", "_found")
    some = F.filter("_found", lambda x: x["parent"].isNotNull())
    return once(rows, {out: first(ordered(some, lambda x: x["at"], p=lambda x: x["parent"]))["p"]}).drop("_found")


def infer_specialisations(postings: DataFrame, aliases: DataFrame, title_col: str, context_col: str, out: str, limit: int = 3) -> DataFrame:
    """Aliases of 4 or more characters in the title, of 8 or more in the context, between characters
    that aren't a-z or 0-9; title before context, longer before shorter, then by id.

    Candidates come from the alias's first run of letters and digits, a regular expression decides. The text
    stays in its row: only its distinct runs are looked up.
    """
    usable = {n: derived(f"heads {n}", lambda t, n=n: t.where(F.length("key") >= n).withColumn("head", F.regexp_extract("key", "([a-z0-9]+)", 1)).where("head != ''"), aliases) for n in (4, 8)}
    rows = once(postings, {"_title": taxonomy_key(title_col), "_context": taxonomy_key(context_col)})

    def sure(place: int, text: str) -> Column:
        quoted = lambda x: F.concat(F.lit(r"(?<![a-z0-9])\Q"), x["key"], F.lit(r"\E(?![a-z0-9])"))
        found = F.filter(f"_in{text}", lambda x: F.regexp_like(text, quoted(x)))
        return F.transform(found, lambda x: F.struct(F.lit(-place).alias("place"), (-F.length(x["key"])).alias("size"), x["target"].alias("target")))

    for text, shortest in (("_title", 4), ("_context", 8)):
        rows = lookup(rows, F.array_distinct(F.regexp_extract_all(text, F.lit("([a-z0-9]+)"), 1)), usable[shortest], "head", f"_in{text}")
    hits = [sure(2, "_title"), sure(1, "_context")]
    best = F.array_distinct(F.transform(F.array_sort(F.concat(*hits)), lambda x: x["target"]))
    return rows.withColumn(out, F.slice(best, 1, limit)).drop("_title", "_context", "_in_title", "_in_context")


def family_keys(by_specialisation: DataFrame, by_industry: DataFrame) -> DataFrame:
    """(key, family): specialisations' families under "s:", industries' under "i:"."""
    keys = lambda prefix, table: table.toDF("term", "family").withColumn("key", F.concat(F.lit(prefix), "term"))
    return derived("families", lambda s, i: _union([keys("s:", s), keys("i:", i)]), by_specialisation, by_industry)


def role_family(postings: DataFrame, by_specialisation: DataFrame, by_industry: DataFrame, families: list[str], spec_col: str = "specialisations", industry_col: str = "industry") -> DataFrame:
    """role_subfamily is the first specialisation; role_family follows from it, else from the industry, if it is a known family."""
    rows = once(postings, {"role_subfamily": F.try_element_at(F.col(spec_col), F.lit(1))})
    rows = lookup(rows, F.array(F.concat(F.lit("s:"), "role_subfamily"), F.concat(F.lit("i:"), industry_col)), family_keys(by_specialisation, by_industry), "key", "_found")
    family = first(ordered("_found", lambda x: x["at"], f=lambda x: x["family"]))["f"]
    return once(once(rows, {"role_family": family}), {"role_family": F.when(F.col("role_family").isin(families), F.col("role_family"))}).drop("_found")


def thematic_sectors(postings: DataFrame, themes: DataFrame, spec_col: str = "specialisations", industry_col: str = "industry", out: str = "thematic_sectors") -> DataFrame:
    """Distinct themes of the industry and the specialisations, in order. themes: (key, themes array)."""
    keys = F.concat(F.array(industry_col), F.coalesce(spec_col, _texts()))
    rows = lookup(postings, keys, themes, "key", "_found")
    terms = F.array_distinct(F.flatten(F.transform(ordered("_found", lambda x: x["at"], t=lambda x: x["themes"]), lambda x: x["t"])))
    return once(rows, {out: F.coalesce(terms, _texts())}).drop("_found")


def confidence_for_domain(postings: DataFrame, sources: DataFrame, domain_col: str, default: str = "unverified") -> DataFrame:
    """The first registered source of exactly this domain decides."""
    first = sources.where("domain is not null").groupBy("domain").agg(F.min_by("source_confidence", "rank").alias("domain_confidence"))
    joined = postings.join(first.withColumnRenamed("domain", "registered"), F.col(domain_col) == F.col("registered"), "left").drop("registered")
    return joined.withColumn("domain_confidence", F.coalesce("domain_confidence", F.lit(default)))


# ---- J12, F11, F12: African locations.
EXPLICIT = ["existing_country", "existing_iso2", "existing_iso3", "explicit_iso_code", "explicit_country_alias"]


def iso_tokens(raw: str, length: int, more: str = "") -> Column:
    """Upper-case tokens of a length between separators, in order."""
    return F.regexp_extract_all(F.coalesce(raw, F.lit("")), F.lit(rf"(?:^|[\s,;/()\[\]{more}-])([A-Z]{{{length}}})(?=$|[\s,;/()\[\]{more}-])"), 1)


def _codes(countries: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """(key, iso2, rank) of countries by their codes in these columns."""
    return _union([countries.select(F.concat(F.lit(prefix), c).alias("key"), "iso2", F.lit(0).alias("rank")) for c in columns])


def _names(terms: DataFrame) -> DataFrame:
    return terms.where("kind = 'country'").select(F.concat(F.lit("n:"), "term").alias("key"), "iso2", "rank")


def _country_names(terms: DataFrame) -> DataFrame:
    return derived("names", lambda t: t.where("kind = 'country'"), terms)


def place_hits(postings: DataFrame, african_terms: DataFrame, world_terms: DataFrame, raw_col: str) -> DataFrame:
    """Adds what resolve_locations and global_country find in a text, unless it is there already."""
    rows = phrases_in(postings, raw_col, norm_unicode, african_terms, "term", f"_places_in_{raw_col}")
    return phrases_in(rows, raw_col, norm_unicode, _country_names(world_terms), "term", f"_world_in_{raw_col}")


def resolve_locations(postings: DataFrame, terms: DataFrame, countries: DataFrame, raw_col: str = "location_raw", existing_col: str = "location_country") -> DataFrame:
    """Adds loc: country_code, country_iso3, country, city, admin_area, region, lat, lon, confidence, evidence, matched_alias, is_african.

    The longest term of a kind counts, ties by the registry's order. A city counts only in the country
    if one is known; a city or admin area found in one country only names the country itself. A city
    found in several countries is given without a country, with confidence 0.
    """
    african = derived("african", lambda c: c.where("is_african").select("iso2", "iso3", "name", "region"), countries)
    full = once(postings, {"_raw": F.trim(F.coalesce(raw_col, F.lit("")))})
    full = normalised(phrases_in(full, raw_col, norm_unicode, terms, "term", f"_places_in_{raw_col}"), existing_col, norm_unicode, f"_norm_{existing_col}")
    full = once(full, {"_hits": F.col(f"_places_in_{raw_col}"), "_existing": F.col(f"_norm_{existing_col}"), "_code": F.upper(F.trim(existing_col)), "_tokens": F.concat(iso_tokens("_raw", 3), iso_tokens("_raw", 2))})
    known = derived("african codes", lambda t, a: _union([_names(t), _codes(a, "2:", "iso2"), _codes(a, "3:", "iso3"), _codes(a, "c:", "iso3", "iso2")]), terms, african)
    own = F.array(F.when(F.col("_existing") != "", F.concat(F.lit("n:"), "_existing")), F.concat(F.lit("2:"), "_code"), F.concat(F.lit("3:"), "_code"))
    full = lookup(full, F.concat(own, _prefixed("c:", F.col("_tokens"))), known, "key", "_known")
    told = ordered("_known", lambda x: F.least(x["at"], F.lit(4)), lambda x: x["at"], lambda x: x["rank"], iso2=lambda x: x["iso2"], at=lambda x: F.least(x["at"], F.lit(4)))
    same = {c: (lambda x, c=c: x[c]) for c in ("kind", "term", "alias", "iso2", "canonical", "lat", "lon")}
    full = once(full, {"_told": told, "_found": F.array_distinct(ordered("_hits", lambda x: -F.length(x["term"]), lambda x: x["rank"], **same))})
    of = lambda kind: F.filter("_found", lambda x: x["kind"] == kind)
    how = F.create_map(*(F.lit(x) for item in enumerate(EXPLICIT[:4], 1) for x in item))
    full = once(once(full, {"_first": first(F.col("_told")), "_named": first(of("country"))}), {
        "_code0": F.coalesce("_first.iso2", "_named.iso2"),
        "_how0": F.coalesce(F.try_element_at(how, F.col("_first.at")), F.when(F.col("_named").isNotNull(), F.lit(EXPLICIT[4]))),
    })
    inside = lambda kind, code: F.filter("_found", lambda x: (x["kind"] == kind) & (F.col(code).isNull() | (x["iso2"] == F.col(code))))
    full = once(once(full, {"_cities": inside("city", "_code0")}), {"_city": first(F.col("_cities"))})
    alone = lambda xs, one: F.size(F.array_distinct(F.transform(F.filter(F.col(xs), lambda x: x["term"] == F.col(f"{one}.term")), lambda x: x["iso2"]))) == 1
    city_tells = F.col("_code0").isNull() & F.col("_city").isNotNull() & alone("_cities", "_city")
    full = once(full, {"_code1": F.when(city_tells, F.col("_city.iso2")).otherwise(F.col("_code0")), "_how1": F.when(city_tells, "country_inferred_from_unique_city").otherwise(F.col("_how0"))})
    full = once(once(full, {"_admins": inside("admin", "_code1")}), {"_admin": first(F.col("_admins"))})
    admin_tells = F.col("_code1").isNull() & F.col("_admin").isNotNull() & alone("_admins", "_admin")
    full = once(full, {
        "_code2": F.when(admin_tells, F.col("_admin.iso2")).otherwise(F.col("_code1")), "_how": F.when(admin_tells, "country_inferred_from_admin_area").otherwise(F.col("_how1")),
        "_region": first(of("region")),
    })
    full = once(lookup(full, F.array("_code2"), african, "iso2", "_states"), {"_state": first(F.col("_states"))})
    explicit = F.col("_how").isin(EXPLICIT)
    there = lambda c: F.col(c).isNotNull()
    confidence = (
        F.when(explicit & there("_city"), 1.0).when(there("_city") & (F.col("_how") == "country_inferred_from_unique_city"), 0.96).when(explicit, 0.93)
        .when(there("_admin") & there("_code2"), 0.86).when(there("_region"), 0.68).otherwise(0.0)
    )
    evidence = F.array_compact(F.array(F.col("_how"), F.when(there("_city"), F.lit("explicit_city_alias")), F.when(there("_admin"), F.lit("explicit_admin_area")), F.when(there("_region"), F.lit("explicit_region_alias"))))
    alias = F.coalesce("_city.alias", F.when(F.col("_how") == "explicit_country_alias", F.col("_named.alias")).when(F.col("_how") == "country_inferred_from_admin_area", F.col("_admin.alias")).when(F.col("_how") == "explicit_iso_code", F.col("_code2")))
    loc = F.struct(
        F.col("_code2").alias("country_code"), F.col("_state.iso3").alias("country_iso3"), F.col("_state.name").alias("country"), F.col("_city.canonical").alias("city"), F.col("_admin.canonical").alias("admin_area"),
        F.coalesce("_state.region", "_region.canonical").alias("region"), F.col("_city.lat").alias("lat"), F.col("_city.lon").alias("lon"), confidence.alias("confidence"), evidence.alias("evidence"), alias.alias("matched_alias"),
        (there("_code2") | there("_region")).alias("is_african"),
    )
    return only(once(full, {"loc": loc}), postings, "loc")


# ---- J13, J14: any country of the world.
def global_country(postings: DataFrame, terms: DataFrame, countries: DataFrame, raw_col: str, code_col: str, country_col: str, out: str = "world") -> DataFrame:
    """Struct (iso2, name, is_african) by an existing code, an exact name, an upper-case code in the text, or the longest name in it."""
    names = _country_names(terms)
    full = normalised(phrases_in(postings, raw_col, norm_unicode, names, "term", f"_world_in_{raw_col}"), country_col, norm_unicode, f"_norm_{country_col}")
    full = once(full, {"_raw": F.coalesce(raw_col, F.lit("")), "_code": F.upper(code_col), "_name": F.col(f"_norm_{country_col}"), "_hits": F.col(f"_world_in_{raw_col}")})
    known = derived("world codes", lambda t, c: _union([_codes(c, "c:", "iso2", "iso3"), _names(t)]), names, countries)
    keys = F.concat(F.array(F.concat(F.lit("c:"), "_code"), F.when(F.col("_name") != "", F.concat(F.lit("n:"), "_name"))), _prefixed("c:", iso_tokens("_raw", "2,3", "|")))
    full = lookup(full, keys, known, "key", "_known")
    by_text = first(ordered("_hits", lambda x: -F.length(x["term"]), lambda x: x["rank"], iso2=lambda x: x["iso2"]))["iso2"]
    by_key = first(ordered("_known", lambda x: x["at"], lambda x: x["rank"], iso2=lambda x: x["iso2"]))["iso2"]
    full = once(full, {"_iso2": F.coalesce(by_key, by_text)})
    full = lookup(full, F.array("_iso2"), countries, "iso2", "_states")
    state = first(F.transform("_states", lambda x: F.struct(x["iso2"].alias("iso2"), x["name"].alias("name"), x["is_african"].alias("is_african"))))
    return only(once(full, {out: state}), postings, out)


def nationality_codes(postings: DataFrame, terms: DataFrame, text_col: str, out: str = "nationalities") -> DataFrame:
    """Distinct country codes, those of nationality terms first, then of country names; longer terms first."""
    hits = f"_nations_in_{text_col}"
    rows = phrases_in(postings, text_col, norm_unicode, terms, "term", hits)
    by = ordered(hits, lambda x: (x["kind"] == "country"), lambda x: -F.length(x["term"]), lambda x: x["rank"], iso2=lambda x: x["iso2"])
    return once(rows, {out: F.array_distinct(F.transform(by, lambda x: x["iso2"]))}).drop(hits)


def african_codes(countries: DataFrame) -> list[str]:
    """Codes of African countries, taken once from the registry's table."""
    table = held(countries)
    if table is None:
        raise ValueError("the registry of countries is larger than any list of countries")
    return sorted(c for c, african in zip(table.column("iso2").to_pylist(), table.column("is_african").to_pylist(), strict=True) if african)


# ---- J15 to J18.
def salaries_to_usd(postings: DataFrame, rates: DataFrame, low: str, high: str, currency: str, period: str) -> DataFrame:
    """salary_usd_min and salary_usd_max a year; null for an unknown currency or period."""
    from jobloom.functions.extract import annual_usd

    joined = postings.withColumn("fx_key", F.upper(currency)).join(rates.select(F.col("currency").alias("fx_key"), "usd_per_unit"), "fx_key", "left")
    return joined.withColumn("salary_usd_min", annual_usd(low, "usd_per_unit", period)).withColumn("salary_usd_max", annual_usd(high, "usd_per_unit", period)).drop("fx_key", "usd_per_unit")


def adapter_targets(organisations: DataFrame, adapter: str, identifier: str = "identifier") -> DataFrame:
    """Targets of an adapter: sources of organisations, both enabled. organisations: (id, name, enabled, sources array of struct)."""
    flat = organisations.where("enabled").select(F.col("id").alias("organisation_id"), "name", F.explode("sources").alias("s"))
    return flat.where((F.col("s.adapter") == adapter) & F.col("s.enabled")).select("organisation_id", "name", F.col("s.identifier").alias(identifier))


def repair_source_defaults(postings: DataFrame, defaults: DataFrame, out: str = "specialisations", limit: int = 3) -> DataFrame:
    """Drop an institution's default terms from a role's, put inferred ones first, keep `limit`. defaults: (org_id, defaults array)."""
    empty = F.array().cast("array<string>")
    rows = postings.join(defaults, "org_id", "left")
    own = F.array_except(F.col(out), F.coalesce("defaults", empty))
    return rows.withColumn(out, F.slice(F.array_distinct(F.concat(F.coalesce("inferred", empty), own)), 1, limit)).drop("defaults")


def missing_references(rows: DataFrame, key: str, registry: DataFrame, registry_key: str) -> DataFrame:
    """Rows whose key is not in the registry (a null key refers to nothing)."""
    return rows.where(F.col(key).isNotNull()).join(registry.select(F.col(registry_key).alias(key)), key, "left_anti")
