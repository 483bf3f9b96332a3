"""Operators whose results SQL can't state, plan shapes, snapshots, streams and more sources."""

import json
import random

import pytest
from pyspark.sql import functions as F

from jobloom import registries as R
from jobloom.operators import dedup as D
from jobloom.operators import matching as M
from jobloom.operators import quality as V
from jobloom.operators import snapshot as U
from jobloom.operators.row_rules import row_rules, row_warnings
from jobloom.sources import landed as L
from jobloom.sources import pages as H
from jobloom.streaming import jobs as T


# ---- D5: the rule replayed per component is the rule over all rows
@pytest.mark.parametrize("seed", range(4))
def test_greedy_rule_by_components(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [f"id:{i}", *{f"url:{rng.randrange(60)}" for _ in range(rng.randrange(3))}], (rng.randrange(4), rng.randrange(3)), f"r{i}", rng.random() < 0.3) for i in range(150)]
    table = spark.createDataFrame([(p, k, {"score": s[0], "completeness": s[1]}, i, g) for p, k, s, i, g in rows], "pos long, keys array<string>, precedence struct<score:int,completeness:int>, id string, is_government boolean")
    kept, events = D.resolve_duplicates(table)
    slots, want = D.replay([(p, k, s) for p, k, s, _, _ in rows])
    assert {r.pos for r in kept.collect()} == {s[0] for s in slots}
    assert {(r.kept_pos, r.removed_pos, r.replaced_existing, tuple(r.matched_by)) for r in events.collect()} == {(a, b, c, tuple(k)) for a, b, c, k in want}


def test_greedy_rule_is_not_connected_components(spark):
    slots, events = D.replay([(0, ["a"], (0, 0)), (1, ["b"], (0, 0)), (2, ["a", "b"], (0, 0))])
    assert [s[0] for s in slots] == [0, 1] and events == [(0, 2, False, ["a", "b"])]


def test_one_component_of_many_rows(spark):
    """No limit on a component: rows stream through, the first of equal ones stays."""
    rows = spark.range(20_000).select(F.col("id").alias("pos"), F.array(F.lit("k"), F.concat(F.lit("j"), F.pmod("id", F.lit(7)))).alias("keys"), F.struct(F.lit(0).alias("score"), F.lit(0).alias("completeness")).alias("precedence"), F.col("id").cast("string").alias("id"), F.lit(False).alias("is_government"))
    kept, events = D.resolve_duplicates(rows)
    assert [r.pos for r in kept.collect()] == [0] and events.where("kept_pos = 0").count() == 19_999


def test_equal_and_missing_ids_keep_their_own_results(spark):
    from jobloom.operators import classify as C

    data = [("x", "Private Equity Associate", "Harbour Growth Fund", "Nairobi"), ("x", "Driver", "Open Relief", "Dakar"), (None, "Driver", "Open Relief", "Dakar"), (None, "Clerk", None, None), ("x", "Driver", "Open Relief", "Dakar")]
    rows = spark.createDataFrame(data, "id string, title string, org_name string, location_raw string").withColumn("location_country", F.lit(None).cast("string"))
    rows = M.match_organisations(rows, R.organisation_names(spark))
    rows = M.resolve_locations(rows, R.location_terms(spark), R.country_table(spark))
    got = C.investment_profile(rows.withColumns({"body": F.lit(""), "specialisations": F.array().cast("array<string>")}), R.INVESTMENT)
    found = sorted((r.title, r.org_id or "", r.loc.city or "", r.investment_profile.is_investment_role) for r in got.collect())
    assert found == sorted([("Private Equity Associate", "harbour-fund", "Nairobi", True), ("Clerk", "", "", False), *[("Driver", "open-relief", "Dakar", False)] * 3])


def test_identity_keys_of_government_rows(spark):
    rows = spark.createDataFrame(
        [("1", "Clerk", "Ministry", "KE", None, None, None, None, "https://x.test/a?utm_source=q#f", None, "government_official", None, (True, "m", "R1", None)), ("2", "Clerk", "Confidential", "KE", None, "Nairobi", None, None, "http://www.x.test//a/?b=2&a=1", None, "ats", None, None)],
        "id string, title string, org_name string, country_code string, country string, city string, deadline string, summary string, apply_url string, raw_description_url string, source_kind string, org_id string, government struct<is_government:boolean,registry_id:string,advert_reference:string,grade:string>",
    )
    keys = {r.id: r["keys"] for r in D.identity_keys(rows).collect()}
    assert keys["1"] == ["id:1", "government:ke|m|r1|clerk"]
    assert keys["2"] == ["id:2", "url:https://x.test/a?a=1&b=2"]


# ---- matching: plans and phrases
def test_phrase_hits_are_runs_of_tokens(spark):
    rng = random.Random(1)
    words = ["a", "b", "c", "d"]
    texts = [(i, " ".join(rng.choices(words, k=rng.randrange(7)))) for i in range(60)]
    phrases = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(25)})
    got = M.phrase_hits(spark.createDataFrame(texts, "id long, text string"), "text", spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    assert {(r.id, r.phrase) for r in got.collect()} == {(i, p) for i, t in texts for p in phrases if f" {p} " in f" {t} "}


def test_matching_has_no_nested_loops(spark):
    # Places that differ: with one constant place the optimiser knows the join's only key and needs no equality.
    rows = spark.range(10).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("Nairobi "), "id").alias("location_raw"), F.when(F.col("id") % 2 == 0, "Kenya").alias("location_country"))
    plan = M.resolve_locations(rows, R.location_terms(spark), R.country_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_registry_references(spark):
    rows = spark.createDataFrame([("a", "KE"), ("b", "XX"), ("c", None)], "id string, code string")
    assert [r.id for r in M.missing_references(rows, "code", R.country_table(spark), "iso2").collect()] == ["b"]
    orgs = spark.createDataFrame([("o1", "One", True, [("lever", True, "x"), ("ashby", False, "y")])], "id string, name string, enabled boolean, sources array<struct<adapter:string,enabled:boolean,identifier:string>>")
    assert [r.identifier for r in M.adapter_targets(orgs, "lever").collect()] == ["x"] and M.adapter_targets(orgs, "ashby").count() == 0
    fixed = M.repair_source_defaults(spark.createDataFrame([("o", ["d1", "x", "y"], ["i", "x"])], "org_id string, specialisations array<string>, inferred array<string>"), spark.createDataFrame([("o", ["d1"])], "org_id string, defaults array<string>"))
    assert fixed.first().specialisations == ["i", "x", "y"]


# ---- quality
def test_row_rules(spark):
    schema = "id string, title string, org_id string, posted_at string, deadline string, lat double, lon double, flags array<string>, source_confidence string, institution_profile struct<is_dfi_or_multilateral:boolean,institution_type:string,priority_institution:boolean,source_pack:string>"
    clean = ("a-1", "Clerk", None, "2024-05-01", "2024-05-02", 1.0, 2.0, [], "official", (True, "dfi", True, "dfi"))
    bare = ("b", "Clerk", None, None, None, None, None, None, "community", None)  # nulls break nothing but what is needed
    bad = ("c d", " ", "A", "soon", "2024", 91.0, None, ["sample", None], "official", (True, "ngo", None, None))
    late = ("", "Clerk", "a--b", "2024-05-02T00:00:00Z", "2024-05-01", -90.0, -180.5, ["urgent"], None, (None, None, True, "x"))
    rows = spark.createDataFrame([clean, bare, bad, late], schema)
    got = {}
    for r in V.violations(rows).collect():
        got.setdefault(r.id, set()).add(r.rule)
    assert got == {
        "c d": {"id.characters", "title.required", "org_id.identifier", "posted_at.iso", "deadline.iso", "lat.range", "lon.range", "flags.strings", "flags.sample_official", "institution_profile.dfi_type", "institution_profile.priority_institution.required"},
        "": {"id.required", "org_id.identifier", "lon.range", "deadline.before_posted", "source_confidence.vocabulary", "institution_profile.institution_type.vocabulary", "institution_profile.is_dfi_or_multilateral.required", "institution_profile.source_pack"},
    }
    assert V.violations(rows.limit(0)).count() == 0
    more = row_rules(rows.schema, {"organisation_type": ["club"]})["institution_profile.institution_type.vocabulary"]
    one = spark.createDataFrame([(("club",),), (("band",),)], "institution_profile struct<institution_type:string>")
    assert [r.bad for r in one.select(more.alias("bad")).collect()] == [False, True]
    link = spark.createDataFrame([(None,), ("https://a.test",)], "apply_url string")
    assert V.violations(link.withColumn("id", F.lit("x"))).count() == 0 and link.where(row_warnings(link.schema)["apply_url.missing"]).count() == 1


def test_registry_and_publication_checks(spark):
    orgs = spark.createDataFrame([("a", "N", "ngo", True, None, "KE"), ("a", "M", "bad", False, None, "XX")], "id string, name string, type string, enabled boolean, disabled_reason string, country_code string")
    assert {(r.rule, r.key) for r in V.registry_violations(orgs, ["ngo"], R.country_table(spark)).collect()} == {("id.unique", "a"), ("type.vocabulary", "a"), ("country_code.reference", "a"), ("disabled_reason.required", "a")}
    assert V.source_violations(R.source_table(spark)).count() == 0
    rows = spark.createDataFrame([("1", None), ("2", "t")], "id string, title string")
    at = lambda s: F.lit(s).cast("timestamp")
    found = {r.check: r.failures for r in V.publication_checks(rows, at("2026-01-01"), at("2026-01-03"), ["id", "title"]).collect()}
    assert found == {"id.missing": 0, "title.missing": 1, "snapshot.stale": 1, "snapshot.future": 0}
    assert V.declared_count(rows, spark.createDataFrame([(2,)], "opportunity_count long")).first().ok


# ---- snapshots
def test_publish_never_replaces_good_by_bad(spark, tmp_path):
    root = str(tmp_path / "feed")
    first = U.publish(spark.range(10).toDF("id"), root)
    assert U.current(spark, root) == first
    with pytest.raises(U.Rejected):
        U.publish(spark.range(0).toDF("id"), root)
    with pytest.raises(U.Rejected):
        U.publish(spark.range(3).toDF("id"), root)
    assert U.current(spark, root) == first
    second = U.publish(spark.range(8).toDF("id"), root)
    assert U.current(spark, root) == second != first


def test_feed_reader_and_upgrade(spark, tmp_path):
    path = tmp_path / "feed.json"
    path.write_text(json.dumps({"meta": {"feed_version": "1"}, "opportunities": [{"id": "b", "title": "x"}, {"id": "a"}]}))
    rows = U.read_feed(spark, str(path), "id:string,title:string,role_family:string")
    assert [(r.pos, r.id, r.role_family) for r in rows.orderBy("pos").collect()] == [(0, "b", None), (1, "a", None)]
    assert U.needs_upgrade(rows, "1", "2", []) and U.needs_upgrade(rows, "2", "2", ["role_family"]) and not U.needs_upgrade(rows, "2", "2", ["id"])


# ---- streams
def test_refresh_stream_equals_batch(spark, tmp_path):
    landing, kept = tmp_path / "landing", str(tmp_path / "kept")
    landing.mkdir()

    def project(batch):
        rows = batch.select(F.col("target_id").cast("long").alias("pos"), F.col("target_id").alias("id"), F.array("payload").alias("keys"))
        return rows.withColumn("precedence", F.struct(F.lit(0).alias("score"), F.lit(0).alias("completeness"))).withColumn("is_government", F.lit(False))

    def land(name, items):
        (landing / name).write_text("\n".join(json.dumps({"source_key": "s", "target_id": str(i), "payload": k}) for i, k in items))

    land("1.json", [(0, "a"), (1, "b"), (2, "a")])
    T.merge_refresh(T.landed_stream(spark, str(landing)), project, kept, str(tmp_path / "cp")).awaitTermination(120)
    land("2.json", [(0, "b"), (1, "c")])
    T.merge_refresh(T.landed_stream(spark, str(landing)), project, kept, str(tmp_path / "cp")).awaitTermination(120)
    schema = project(spark.createDataFrame([], T.LANDING)).schema
    assert sorted(r["keys"][0] for r in T.kept_rows(spark, kept, schema, 1).collect()) == ["a", "b", "c"]


# ---- sources
PAYLOADS = {
    "pinpoint": ({"data": [{"id": 1, "title": "Cook", "location": {"name": "Lagos"}, "department": {"name": "Food"}, "description": "<p>a</p>", "compensation": {"visible": True, "min": 1, "max": 2, "currency": "USD"}}]}, {"location_raw": "Lagos", "raw_terms": ["Food"], "summary": "a"}),
    "recruitee": ({"offers": [{"id": 2, "title": "Cook", "status": "published", "locations": [{"city": "Dakar", "country": "Senegal"}], "close_at": "2026-05-01", "published_at": "2026-01-01 10:00:00 UTC"}, {"id": 3, "title": "Old", "status": "archived"}]}, {"location_raw": "Dakar, Senegal", "id": "recruitee-t-2"}),
    "reliefweb": ({"data": [{"id": "9", "fields": {"title": "Nurse", "body": "x", "country": [{"name": "Chad"}, {"name": "Kenya", "primary": True}], "city": [{"name": "Nairobi"}], "source": [{"name": "Relief"}], "how_to_apply": "see https://apply.test/9", "url": "https://reliefweb.int/9"}}]}, {"location_raw": "Nairobi, Kenya", "apply_url": "https://apply.test/9", "org_name": "Relief"}),
    "untalent": ({"jobs": [{"id": 4, "title": "Officer", "organization": "UN", "areas": ["a", {"name": "b"}], "deadline": "2026-02-03"}]}, {"org_name": "UN", "raw_terms": ["a", "b"]}),
    "remotive": ({"jobs": [{"id": 5, "title": "Dev", "candidate_required_location": "Worldwide", "category": "Software"}]}, {"mode_hint": "remote", "raw_terms": ["Software"]}),
    "jobicy": ({"jobs": [{"id": 6, "jobTitle": "Dev", "jobIndustry": ["A", {"label": "B"}], "jobLevel": "Senior", "annualSalaryMin": "10", "annualSalaryMax": "x"}]}, {"seniority": "senior", "compensation": None, "raw_terms": ["A", "B"]}),
    "arbeitnow": ({"data": [{"slug": "s", "title": "Dev", "remote": True, "tags": [], "job_types": ["part time"], "created_at": 1783323006}]}, {"location_raw": "Remote - Worldwide", "contract_type": "part_time"}),
    "cornerstone": ({"data": {"requisitions": [{"requisitionId": 7, "displayJobTitle": "Cook", "locations": [{"city": "Accra", "country": "Ghana"}, {"city": "Accra", "country": "Ghana"}]}]}}, {"id": "cornerstone-t-7"}),
    "oracle": ({"items": [{"requisitionList": [{"Id": 8, "Title": "Clerk", "PrimaryLocation": "Dakar"}]}]}, {"location_raw": "Dakar", "id": "oracle-t-8"}),
    "workday": ({"jobPostings": [{"title": "Clerk", "externalPath": "/job/R1", "locationsText": "Cairo", "bulletFields": ["R1"]}]}, {"id": "workday-t-R1", "location_raw": "Cairo"}),
    "smartrecruiters": ({"content": [{"id": "s1", "name": "Driver", "location": {"city": "Cairo", "country": "eg"}, "releasedDate": "2026-01-02"}]}, {"location_raw": "Cairo, eg"}),
}


@pytest.mark.parametrize("key", PAYLOADS)
def test_sources(spark, key):
    payload, want = PAYLOADS[key]
    landing = spark.createDataFrame([(key, "t", None, json.dumps(payload)), (key, "t", None, "not json"), (key, "t", None, None)], "source_key string, target_id string, fetched_at timestamp, payload string")
    got = L.from_source(key, landing).collect()
    assert len(got) == 1 and {k: got[0][k] for k in want} == want


def test_union_of_sources_keeps_their_order(spark):
    landing = spark.createDataFrame([(k, "t", None, json.dumps(p)) for k, (p, _) in PAYLOADS.items()], "source_key string, target_id string, fetched_at timestamp, payload string")
    got = L.all_sources(landing, order=["workday", "remotive"]).orderBy("source_order", "pos").collect()
    assert [r.source_key for r in got] == ["workday", "remotive"]


def test_pages(spark):
    ld = '<script type="application/ld+json">{"@type":"JobPosting","title":"Data Analyst","validThrough":"2020-01-01"}</script>'
    pages = spark.createDataFrame(
        [(1, "https://o.test/jobs/analyst-123", "<h1>Senior Nurse</h1><p>Requirements: x. Duties: y. Location: Nairobi.</p>", "o", "Senior Nurse", ""), (2, "https://o.test/careers", "<h1>Careers</h1>", "o", "Careers", ""), (3, "https://o.test/3", ld, "o", "", "")],
        "page_id long, url string, html string, organisation_id string, listing_title string, context string",
    )
    got = H.from_pages(pages, F.lit("2026-01-01").cast("timestamp")).collect()
    assert [(r.title, r.location_raw) for r in got] == [("Senior Nurse", "Nairobi")]  # the landing page and the expired one drop


def test_swahili_advert_and_rss(spark):
    text = "TANGAZO\n1.0 MHASIBU DARAJA LA II - NAFASI 3\nTGS D miaka 2\n2.0 DEREVA - NAFASI 10\nTGS B\nLazima awe raia wa Tanzania. Mwisho wa kutuma 3 Machi 2026"
    docs = spark.createDataFrame([("p", "Portal", "https://g.test", text, "Tanzania", ["TZ"])], "portal_id string, portal_name string, url string, text string, country_name string, eligible_nationalities array<string>")
    got = H.from_advert_text(docs).orderBy("pos").collect()
    assert [(r.title, r.government_fields.number_of_positions, r.government_fields.citizenship_required) for r in got] == [("MHASIBU DARAJA LA II", 3, True), ("DEREVA", 10, True)]
    feed = spark.createDataFrame([("un", "t", "<rss><item><title><![CDATA[Officer]]></title><link>https://u.test/1</link><pubDate>Mon, 06 Jul 2026 07:30:06 GMT</pubDate></item></rss>")], "source_key string, target_id string, payload string")
    assert [(r.title, r.page_url) for r in H.from_rss(feed).collect()] == [("Officer", "https://u.test/1")]
