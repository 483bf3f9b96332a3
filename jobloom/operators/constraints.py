"""V5 as data: what registries must satisfy, compiled into one scan of each table and one union of joins.

A constraint names a table and what breaks it. check() takes the tables and a list of constraints: row rules
of a table share one scan, unique keys are grouped counts, references and agreements are joins on the key, and
counts are one aggregate for each table. The result is long: (table, rule, key).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Row:
    """Broken by rows for which the expression is true; null is not broken."""

    table: str
    rule: str
    broken: str


@dataclass(frozen=True)
class Unique:
    """The expression names no two rows; null and empty keys are nobody's."""

    table: str
    rule: str
    key: str


@dataclass(frozen=True)
class Reference:
    """The expression is a key of another table, unless it is null; an array's elements are each one."""

    table: str
    rule: str
    key: str
    to: str
    to_key: str


@dataclass(frozen=True)
class Agrees:
    """What the row says of the other table's row (by key) is so: expressions of both sides are equal, nulls too."""

    table: str
    rule: str
    key: str
    to: str
    to_key: str
    here: str
    there: str


@dataclass(frozen=True)
class Count:
    """The rows for which the expression is true are at least low and at most high."""

    table: str
    rule: str
    where: str
    low: int
    high: int | None = None


Constraint = Row | Unique | Reference | Agrees | Count


def one_of(column: str, values: list[str]) -> str:
    """Text of a rule: broken unless the column has one of the values."""
    return f"coalesce({column} NOT IN ({', '.join(repr(v) for v in values)}), true)"


def given(column: str) -> str:
    """Text of a rule: broken if the column is null or blank."""
    return f"coalesce(trim({column}), '') = ''"


def check(tables: dict[str, DataFrame], constraints: list[Constraint], keys: dict[str, str]) -> DataFrame:
    """(table, rule, key) of every violation. keys: of each table the expression that names a row in reports.

    A violated Unique is named by the key itself, once; a violated Count by what was counted.
    """
    found: list[DataFrame] = []
    line = lambda table, rule, key: F.struct(F.lit(table).alias("table"), (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"), key.cast("string").alias("key"))
    name = lambda table: F.expr(keys[table])
    for table in dict.fromkeys(c.table for c in constraints):
        rows, own = tables[table], [c for c in constraints if c.table == table]
        rules = [c for c in own if isinstance(c, Row)]
        if rules:
            broken = F.array_compact(F.array(*(F.when(F.expr(c.broken), F.lit(c.rule)) for c in rules)))
            found.append(rows.select(name(table).alias("k"), F.explode(broken).alias("rule")).select(line(table, F.col("rule"), F.col("k")).alias("x")))
        for c in own:
            if isinstance(c, Unique):
                twice = rows.select(F.expr(c.key).cast("string").alias("k")).where("k != ''").groupBy("k").count().where("count > 1")
                found.append(twice.select(line(table, c.rule, F.col("k")).alias("x")))
            elif isinstance(c, Reference):
                kind = dict(rows.select(F.expr(c.key).alias("r")).dtypes)["r"]
                used = F.explode(F.array_distinct(F.expr(c.key))) if kind.startswith("array") else F.expr(c.key)
                asked = rows.select(name(table).alias("k"), used.alias("r")).where("r IS NOT NULL")
                known = tables[c.to].select(F.expr(c.to_key).alias("r")).distinct()
                found.append(asked.join(known, "r", "left_anti").select(line(table, c.rule, F.col("k")).alias("x")))
            elif isinstance(c, Agrees):
                here = rows.select(name(table).alias("k"), F.expr(c.key).alias("r"), F.expr(c.here).cast("string").alias("a"))
                there = tables[c.to].select(F.expr(c.to_key).alias("r"), F.expr(c.there).cast("string").alias("b"))
                found.append(here.join(there, "r").where(~F.col("a").eqNullSafe(F.col("b"))).select(line(table, c.rule, F.col("k")).alias("x")))
        counts = [c for c in own if isinstance(c, Count)]
        if counts:
            n = rows.agg(*(F.count_if(F.expr(c.where)).alias(f"n{i}") for i, c in enumerate(counts)))
            outside = lambda i, c: (F.col(f"n{i}") < c.low) | (F.lit(False) if c.high is None else F.col(f"n{i}") > c.high)
            found.append(n.select(F.explode(F.array_compact(F.array(*(F.when(outside(i, c), line(table, c.rule, F.col(f"n{i}"))) for i, c in enumerate(counts))))).alias("x")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("x.*")


#: Forms of ids, adapters and levels that registries use.
ID = "^[a-z0-9]+(?:-[a-z0-9]+)*$"
ROLE_ID = "^[a-z0-9]+(?:[-_][a-z0-9]+)*$"
ADAPTERS = ["greenhouse", "lever", "ashby", "pinpoint", "recruitee", "workday", "smartrecruiters", "workable", "cornerstone", "successfactors", "oracle_cx", "pageup", "official_html", "multinational_html", "public_institution_html"]
CONFIDENCES = ["official", "aggregated", "community", "unverified"]
MULTINATIONAL_ADAPTERS = ["workday", "smartrecruiters", "workable", "multinational_html"]


def unlike(column: str, pattern: str) -> str:
    return f"NOT coalesce({column}, '') RLIKE '{pattern}'"


def _code(table: str) -> list[Constraint]:
    return [Row(table, "iso2.form", "length(coalesce(iso2, '')) != 2"), Row(table, "iso3.form", "length(coalesce(iso3, '')) != 3"), Row(table, "name.required", given("name")), Unique(table, "iso2.unique", "upper(iso2)"), Unique(table, "iso3.unique", "upper(iso3)")]


def _tracks(table: str, types: list[str]) -> list[Constraint]:
    return [
        Row(table, "id.form", unlike("id", ROLE_ID)), Unique(table, "id.unique", "id"), Row(table, "label.required", given("label")), Row(table, "classification.vocabulary", one_of("classification", types)),
        Row(table, "title_phrases.required", "coalesce(size(title_phrases), 0) < 1"), Reference(table, "canonical.reference", "canonical", "specialisations", "id"), Unique(table, "canonical.unique", "canonical"),
    ]


def _employers(table: str, pack: str) -> list[Constraint]:
    return [
        Reference(table, "organisation.reference", "organisation_id", "organisations", "id"), Unique(table, "organisation.unique", "organisation_id"), Agrees(table, "pack.agrees", "organisation_id", "organisations", "id", f"'{pack}'", "source_pack"),
        Agrees(table, "sector.agrees", "organisation_id", "organisations", "id", "sector", "sector"), Row(table, "address.required_if_enabled", f"enabled AND {given('career_url')}"), Row(table, "reason.required_if_disabled", f"NOT enabled AND {given('disabled_reason')}"),
    ]


def registry_constraints(vocabularies: dict[str, list[str]]) -> list[Constraint]:
    """The rules of all registries as one list.

    vocabularies: organisation_type, investment_classification, ngo_classification, sector, category, portal_adapter.
    """
    v = vocabularies
    return [
        *_code("countries"), *_code("global_countries"), Unique("countries", "name.unique", "lower(trim(name))"), Row("countries", "region.required", given("region")), Row("countries", "cities.required", "coalesce(size(cities), 0) < 1"),
        Row("countries", "cities.unique", "size(array_distinct(cities)) < size(cities)"), Reference("countries", "african_flag.covers", "iso2", "african_flags", "iso2"), Reference("african_flags", "african_flag.extra", "iso2", "countries", "iso2"),
        Row("cities", "name.required", given("name")), Row("cities", "lat.range", "lat NOT BETWEEN -90 AND 90"), Row("cities", "lon.range", "lon NOT BETWEEN -180 AND 180"),
        Row("role_families", "id.form", unlike("id", ROLE_ID)), Unique("role_families", "id.unique", "id"), Row("role_families", "label.required", given("label")),
        Reference("role_mappings", "family.reference", "family", "role_families", "id"), Reference("role_mappings", "key.reference", "key", "specialisations", "id"), Reference("specialisations", "mapping.covers", "id", "role_mappings", "key"),
        *_tracks("investment_tracks", v["investment_classification"]), *_tracks("ngo_tracks", v["ngo_classification"]), Reference("ngo_tracks", "family.reference", "role_family", "role_families", "id"),
        Row("organisations", "id.form", unlike("id", ID)), Unique("organisations", "id.unique", "id"), Unique("organisations", "name.unique", "lower(trim(name))"), Row("organisations", "name.required", given("name")),
        Row("organisations", "type.vocabulary", one_of("organisation_type", v["organisation_type"])), Reference("organisations", "families.reference", "career_families", "role_families", "id"),
        Reference("organisations", "countries.reference", "countries", "countries", "iso2"), Reference("organisations", "sources.required", "id", "connections", "organisation_id"),
        Row("connections", "adapter.vocabulary", one_of("adapter", ADAPTERS)), Row("connections", "identifier.required", given("identifier")), Unique("connections", "connection.unique", "concat(adapter, ':', lower(trim(identifier)))"),
        Reference("connections", "defaults.reference", "default_specialisations", "specialisations", "id"),
        Row("sources", "id.form", unlike("id", ID)), Unique("sources", "id.unique", "id"), Row("sources", "confidence.vocabulary", one_of("default_confidence", CONFIDENCES)),
        Row("portals", "id.form", unlike("id", ID)), Unique("portals", "id.unique", "id"), Reference("portals", "country.reference", "country_code", "countries", "iso2"), Row("portals", "adapter.vocabulary", one_of("adapter", v["portal_adapter"])),
        Row("portals", "reason.required_if_disabled", f"NOT enabled AND {given('disabled_reason')}"), Row("portals", "listing.required_if_enabled", f"enabled AND {given('listing_url')}"), Count("portals", "enabled.at_least", "enabled", 3),
        *_employers("public_institutions", "public_institution"), Row("public_institutions", "category.vocabulary", one_of("sector", v["category"])),
        *_employers("multinationals", "multinational"), Row("multinationals", "sector.vocabulary", one_of("sector", v["sector"])), Row("multinationals", "adapter.vocabulary", one_of("adapter", MULTINATIONAL_ADAPTERS)),
        Row("multinationals", "cities.required", "coalesce(size(cities), 0) < 1"), Agrees("multinationals", "type.agrees", "organisation_id", "organisations", "id", "'multinational'", "organisation_type"), Count("multinationals", "enabled.at_least", "enabled", 35),
    ]


