"""Every registry constraint is kept by a clean set of registries and reported once when it alone is broken."""

from pyspark.sql import functions as F

from jobloom.operators import constraints as C

V = {"organisation_type": ["ngo", "multinational", "public"], "investment_classification": ["core"], "ngo_classification": ["technical"], "sector": ["telecom"], "category": ["ports"], "portal_adapter": ["tables"]}
KEYS = {t: "id" for t in ("role_families", "specialisations", "investment_tracks", "ngo_tracks", "organisations", "sources", "portals")} | {t: "iso2" for t in ("countries", "global_countries", "african_flags")}
KEYS |= {"cities": "name", "role_mappings": "key", "connections": "identifier", "public_institutions": "organisation_id", "multinationals": "organisation_id"}
TRACK = "id string, label string, classification string, canonical string, title_phrases array<string>, role_family string"
EMPLOYER = "organisation_id string, sector string, enabled boolean, career_url string, disabled_reason string, adapter string, cities array<string>"


def clean():
    return {
        "countries": ([("KE", "KEN", "Kenya", "East", ["Nairobi"])], "iso2 string, iso3 string, name string, region string, cities array<string>"),
        "global_countries": ([("KE", "KEN", "Kenya"), ("DE", "DEU", "Germany")], "iso2 string, iso3 string, name string"),
        "african_flags": ([("KE",)], "iso2 string"),
        "cities": ([("Nairobi", -1.3, 36.8), ("Lamu", None, None)], "name string, lat double, lon double"),
        "role_families": ([("f1", "One")], "id string, label string"),
        "specialisations": ([("s1",), ("s2",)], "id string"),
        "role_mappings": ([("s1", "f1"), ("s2", "f1")], "key string, family string"),
        "investment_tracks": ([("t1", "T", "core", "s1", ["x"], None)], TRACK),
        "ngo_tracks": ([("t1", "T", "technical", "s2", ["x"], "f1")], TRACK),
        "organisations": ([("o1", "One", "ngo", ["f1"], ["KE"], None, None), ("o2", "Two", "multinational", [], [], "multinational", "telecom"), ("o3", "Three", "public", [], [], "public_institution", "ports")], "id string, name string, organisation_type string, career_families array<string>, countries array<string>, source_pack string, sector string"),
        "connections": ([("o1", "lever", "a", ["s1"]), ("o2", "workday", "b", []), ("o3", "pageup", "c", None)], "organisation_id string, adapter string, identifier string, default_specialisations array<string>"),
        "sources": ([("x", "official")], "id string, default_confidence string"),
        "portals": ([(f"p{i}", "KE", "tables", True, "u", None) for i in range(3)] + [("off", "KE", "tables", False, None, "closed")], "id string, country_code string, adapter string, enabled boolean, listing_url string, disabled_reason string"),
        "public_institutions": ([("o3", "ports", True, "u", None, None, [])], EMPLOYER),
        "multinationals": ([("o2", "telecom", True, "u", None, "workday", ["Lagos"])], EMPLOYER),
    }


RULES = [c for c in C.registry_constraints(V) if not (isinstance(c, C.Count) and c.table == "multinationals")] + [C.Count("multinationals", "enabled.at_least", "enabled", 1)]
# Rule -> rows that replace or (with a plus) join the table's, and the keys then reported.
BROKEN = {
    ("countries", "iso3.form"): ([("KE", "KE", "Kenya", "East", ["Nairobi"])], ["KE"]),
    ("countries", "region.required"): ([("KE", "KEN", "Kenya", " ", ["Nairobi"])], ["KE"]),
    ("countries", "cities.required"): ([("KE", "KEN", "Kenya", "East", None)], ["KE"]),
    ("countries", "cities.unique"): ([("KE", "KEN", "Kenya", "East", ["A", "A"])], ["KE"]),
    ("global_countries", "name.required"): ([("KE", "KEN", None)], ["KE"]),
    ("global_countries", "iso3.unique"): ([("KE", "KEN", "Kenya"), ("KX", "ken", "Other")], ["KEN"]),
    ("african_flags", "african_flag.extra"): ([("KE",), ("NG",)], ["NG"]),
    ("cities", "lat.range"): ([("Nairobi", 91.0, 0.0)], ["Nairobi"]),
    ("cities", "lon.range"): ([("Nairobi", 1.0, -181.0)], ["Nairobi"]),
    ("role_families", "label.required"): ([("f1", "")], ["f1"]),
    ("role_families", "id.form"): ([("f1", "x"), ("F 2", "y")], ["F 2"]),
    ("role_mappings", "family.reference"): ([("s1", "f1"), ("s2", "nope")], ["s2"]),
    ("specialisations", "mapping.covers"): ([("s1",), ("s2",), ("s3",)], ["s3"]),
    ("investment_tracks", "classification.vocabulary"): ([("t1", "T", "odd", "s1", ["x"], None)], ["t1"]),
    ("investment_tracks", "title_phrases.required"): ([("t1", "T", "core", "s1", [], None)], ["t1"]),
    ("investment_tracks", "canonical.unique"): ([("t1", "T", "core", "s1", ["x"], None), ("t2", "T", "core", "s1", ["x"], None)], ["s1"]),
    ("ngo_tracks", "canonical.reference"): ([("t1", "T", "technical", "s9", ["x"], "f1")], ["t1"]),
    ("ngo_tracks", "family.reference"): ([("t1", "T", "technical", "s2", ["x"], "f9")], ["t1"]),
    ("connections", "adapter.vocabulary"): ([("o1", "fax", "a", []), ("o2", "workday", "b", []), ("o3", "pageup", "c", None)], ["a"]),
    ("connections", "connection.unique"): ([("o1", "lever", "a", []), ("o2", "lever", " A", []), ("o3", "pageup", "c", None)], ["lever:a"]),
    ("connections", "defaults.reference"): ([("o1", "lever", "a", ["s1", "s9"]), ("o2", "workday", "b", []), ("o3", "pageup", "c", None)], ["a"]),
    ("organisations", "sources.required"): None,
    ("sources", "confidence.vocabulary"): ([("x", None)], ["x"]),
    ("portals", "country.reference"): ([(f"p{i}", "KE", "tables", True, "u", None) for i in range(3)] + [("q", "ZZ", "tables", True, "u", None)], ["q"]),
    ("portals", "reason.required_if_disabled"): ([(f"p{i}", "KE", "tables", True, "u", None) for i in range(3)] + [("q", "KE", "tables", False, "u", " ")], ["q"]),
    ("portals", "listing.required_if_enabled"): ([(f"p{i}", "KE", "tables", True, "u", None) for i in range(3)] + [("q", "KE", "tables", True, None, None)], ["q"]),
    ("portals", "enabled.at_least"): ([(f"p{i}", "KE", "tables", True, "u", None) for i in range(2)], ["2"]),
    ("public_institutions", "organisation.reference"): ([("o9", "ports", True, "u", None, None, [])], ["o9"]),
    ("public_institutions", "sector.agrees"): ([("o3", None, True, "u", None, None, [])], ["o3"]),
    ("multinationals", "pack.agrees"): ([("o1", None, True, "u", None, "workday", ["x"])], ["o1"]),
    ("multinationals", "reason.required_if_disabled"): ([("o2", "telecom", False, None, None, "workday", ["x"])], ["o2"]),
    ("multinationals", "cities.required"): ([("o2", "telecom", True, "u", None, "workday", None)], ["o2"]),
}


def test_clean_registries_break_nothing(spark):
    tables = {n: spark.createDataFrame(rows, schema) for n, (rows, schema) in clean().items()}
    assert C.check(tables, RULES, KEYS).collect() == []
    assert {c.table for c in RULES} <= set(tables) and len(RULES) > 60


def test_each_broken_rule_is_reported(spark):
    seen = set()
    given = clean()
    for (table, rule), change in BROKEN.items():
        if change is None:
            table_rows = {**given, "connections": ([r for r in given["connections"][0] if r[0] != "o1"], given["connections"][1])}
            want = ["o1"]
        else:
            table_rows, want = {**given, table: (change[0], given[table][1])}, change[1]
        # Only the rules of this table, so that the test stays small.
        tables = {n: spark.createDataFrame(rows, schema).coalesce(1) for n, (rows, schema) in table_rows.items()}
        got = C.check(tables, [c for c in RULES if c.table == table and c.rule == rule], KEYS).collect()
        assert sorted(r.key for r in got) == want and {(r["table"], r.rule) for r in got} == {(table, rule)}, (table, rule, got)
        seen.add((table, rule))
    assert len(seen) == len(BROKEN) >= 30


def test_row_rules_share_one_scan(spark):
    tables = {n: spark.createDataFrame(rows, schema) for n, (rows, schema) in clean().items()}
    rules = [c for c in RULES if c.table == "portals" and isinstance(c, C.Row)]
    plan = C.check(tables, rules, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert len(rules) == 4 and plan.count("Generate") == 1 and "Union" not in plan
    assert C.check(tables, rules, KEYS).where(F.lit(True)).columns == ["table", "rule", "key"]
