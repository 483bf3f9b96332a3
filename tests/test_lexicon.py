"""Registries inside of rows: the automaton against its definition, and the join beyond the limit against the rows' way."""

import random
from collections import Counter

from pyspark.sql import functions as F

from jobloom import registries as R
from jobloom.functions.normalise import norm_unicode
from jobloom.operators import lexicon as L
from jobloom.operators import matching as M
from jobloom.plans.enrich import enrich


def _made(spark):
    rng = random.Random(4)
    words = ["a", "b", "c", "d"]
    texts = [(i, " ".join(rng.choices(words, k=rng.randrange(9))) if i % 9 else None) for i in range(80)]
    phrases = [(" ".join(rng.choices(words, k=rng.randrange(1, 4))), i, i % 3 == 0, ["x", None][i % 2]) for i in range(30)] + [("", 90, True, "x"), (None, 91, True, "x"), ("a  b", 92, True, "x")]
    return texts, phrases, spark.createDataFrame(texts, "id long, text string").repartition(3), spark.createDataFrame(phrases, "phrase string, nth int, flag boolean, name string")


def _hits(rows):
    return {r.id: Counter((h.at, h.phrase, h.nth, h.flag, h["name"]) for h in r.found) for r in rows.collect()}


def test_phrases_by_definition_and_both_ways(spark):
    texts, phrases, df, registry = _made(spark)
    want = {}
    for i, text in texts:
        tokens = (text or "").split()
        want[i] = Counter((at + 1, p, n, flag, name) for p, n, flag, name in phrases if p and "  " not in p for at in range(len(tokens)) if tokens[at : at + len(p.split())] == p.split())
    assert sum(sum(c.values()) for c in want.values()) > 100
    assert _hits(L.phrases_in(df, "text", norm_unicode, registry, "phrase", "found")) == want
    assert _hits(L.phrases_in(df, "text", norm_unicode, registry, "phrase", "found", most=5)) == want
    plan = L.phrases_in(df, "text", norm_unicode, registry, "phrase", "found")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_lookups_both_ways(spark):
    _, _, df, registry = _made(spark)
    rows = df.withColumn("keys", F.when(F.col("id") % 7 != 0, F.concat(F.split("text", " "), F.array(F.lit(None).cast("string"), F.lit("a b")))))
    held, joined = (_hits(L.lookup(rows, F.col("keys"), registry, "phrase", "found", most=most)) for most in (L.HELD_ROWS, 5))
    assert held == joined and sum(sum(c.values()) for c in held.values()) > 50
    assert L.held(registry, 5) is None and L.held(registry).num_rows == 33


def test_enrichment_is_the_same_whatever_way_registries_go(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(f"p{i}", t, o, p, "deal execution", ["Analytics", f"x{i}"], "boards") for i, (t, o, p) in enumerate([("Private Equity Associate", "Harbour Growth Fund", "Nairobi, Kenya"), ("Child Protection Officer", "Open Relief careers", "Dakar"), ("Clerk", None, None), ("Driver", "Sky Telecom", "Tashkent, UZ")])],
        "id string, title string, org_name string, location_raw string, summary string, raw_terms array<string>, source_key string",
    )
    seen = ["id", "org_id", "org_type", "loc", "specialisations", "role_family", "thematic_sectors", "investment_profile", "ngo_profile", "africa_relevance", "african_applicant_access", "eligibility"]
    inside = sorted(map(str, enrich(rows).select(seen).collect()))
    rows = rows.withColumn("location_country", F.lit(None).cast("string"))
    shuffled = M.resolve_locations(rows, R.location_terms(spark), R.country_table(spark))
    monkeypatch.setattr(L, "held", lambda registry, most=0: None)
    monkeypatch.setattr(L, "_held", type(L._held)())
    assert sorted(map(str, M.resolve_locations(rows, R.location_terms(spark), R.country_table(spark)).select("id", "loc").collect())) == sorted(map(str, shuffled.select("id", "loc").collect()))
    assert "core_investment" in inside[0] and "KE" in inside[0]


def test_enrichment_keeps_columns_of_its_own_names(spark):
    rows = spark.createDataFrame([("a", "Clerk", None, "mine", 7, ["c"])], "id string, title string, org_name string, sector string, priority int, cities array<string>")
    out = enrich(rows)
    assert not [c for c in out.columns if c.startswith("_")]
    got = out.select("sector", "priority", "cities", "org_id").first()
    assert tuple(got) == ("mine", 7, ["c"], None)


def test_small_registries_are_looked_up_without_python(spark, monkeypatch):
    _, _, df, registry = _made(spark)
    rows = df.withColumn("keys", F.when(F.col("id") % 7 != 0, F.concat(F.split("text", " "), F.array(F.lit(None).cast("string"), F.lit("a b")))))
    native = L.lookup(rows, F.col("keys"), registry, "phrase", "found")
    monkeypatch.setattr(L, "NATIVE_ROWS", 0)
    inside = L.lookup(rows, F.col("keys"), registry, "phrase", "found")
    assert _hits(native) == _hits(inside) and native.schema == inside.schema
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" in plan(inside) and "EvalPython" not in plan(native) and "from_json" not in plan(native)


def test_enrichment_takes_two_python_passes_and_no_files(spark):
    rows = spark.createDataFrame([("a", "Clerk", "Open Relief", "Nairobi", "deal", ["x"], "boards")], "id string, title string, org_name string, location_raw string, summary string, raw_terms array<string>, source_key string")
    rows = enrich(rows.where("id is not null"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "ExistingRDD" not in plan.replace("Scan ExistingRDD[id", "")
    place = rows.select("loc")._jdf.queryExecution().executedPlan().toString()
    assert place.count("ArrowEvalPython") == 1 and len(place) < len(plan) / 2


def test_normalisers_of_ascii_and_of_long_texts(spark, monkeypatch):
    from jobloom.functions import normalise as N

    texts = ["".join(map(chr, range(128))), "Ab  C_d-9", "", "É" * 5, "x\u00a0Y\x1c\x85z &amp; ß"] * 3
    for plain in N.PLAIN.values():
        for t in texts:
            if t.isascii():  # the short way of ASCII gives what the long way gives: one more letter apart
                assert plain(t + " é").split(" ")[:-1] == plain(t).split(" ") or not plain(t)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string").coalesce(1)
    made = lambda: [tuple(r) for r in df.select("i", N.norm_unicode("t"), N.norm_ngo("t"), N.norm_word("t"), N.taxonomy_key("t")).orderBy("i").collect()]
    whole = made()
    monkeypatch.setattr(N, "SLICE", 1)
    assert made() == whole and whole[-1] == (99, "", "", "", "")


def test_refresh_stores_wide_rows_as_columns(spark):
    from jobloom.plans.enrich import refresh

    rows = spark.range(40).selectExpr("id AS pos", "CAST(id AS STRING) AS id", "concat('Clerk ', id) AS title", "'Open Relief' AS org_name", "'Nairobi' AS location_raw", "'deal' AS summary", "array('x') AS raw_terms", "'boards' AS source_key")
    out = refresh(rows)
    assert "FileScan parquet" in out["rejected"]._jdf.queryExecution().executedPlan().toString().replace("Scan parquet", "FileScan parquet")
    assert out["kept"].count() + out["rejected"].count() + out["events"].count() == 40


def test_split_is_counted_in_one_pass(spark, monkeypatch):
    from jobloom.plans import enriched_queries as Q

    given = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(F.struct(F.when(F.col("o_orderkey") % 3 == 0, "non_african").when(F.col("o_orderkey") % 3 == 1, "unresolved").alias("status")).alias("africa_relevance"))
    monkeypatch.setattr(Q, "enriched", lambda spark, sf_dir: given)
    counted = Q.p9_split_rejected(spark, "")
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    kept, rejected = Q.P.split_rejected(given)
    assert tuple(counted.first()) == (kept.count(), rejected.count()) and rejected.count() > 0


def test_rows_of_a_task_are_bounded(spark, monkeypatch):
    from jobloom.plans import cases

    monkeypatch.setattr(cases, "TASK_ROWS", 100)
    spread = cases.spread(spark.range(1_950).toDF("k"))
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 110 and sum(sizes) == 1_950
