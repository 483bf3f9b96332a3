"""Queries of operators that the others leave out: official pages, circulars, repair, inventories, identities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import registries as R
from jobloom.functions import extract as X
from jobloom.operators import dedup as D
from jobloom.operators import quality as V
from jobloom.operators import reports as A
from jobloom.operators import snapshot as U
from jobloom.sources import pages as H

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        FOUND[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- S19, H3, H4, H5: official pages. Every page gets a vacancy's sections, a landing page's or an expired one's.
_PLACED = ["<dl><dt>Location</dt><dd>Mombasa, Kenya</dd></dl>", "<p>Location: Dakar.</p>", "<span data-location='Lagos'></span>", "<p itemprop='jobLocation'>Arusha</p>"]


@query("""
SELECT 'Field Officer ' || page_id AS title, CASE page_id % 4 WHEN 0 THEN 'Mombasa, Kenya' WHEN 1 THEN 'Dakar' WHEN 2 THEN 'Lagos' ELSE 'Arusha' END AS location_raw,
 'official-o' || CAST(page_id % 7 AS VARCHAR) || '-' || substr(sha256('https://o.test/jobs/' || page_id), 1, 16) AS id, TIMESTAMP '2031-03-05 23:59:59' AS deadline
FROM pages WHERE page_id % 3 = 0""")
def s19_official_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id")
    place = F.element_at(F.array(*map(F.lit, _PLACED)), (F.pmod(key, F.lit(4)) + 1).cast("int"))
    head = F.concat(F.lit("<h1>Field Officer "), key.cast("string"), F.lit("</h1>"))
    vacancy = F.concat(head, place, F.lit("<p>Requirements: a diploma.</p><p>Duties: visits.</p><p>Closing date: 5 March 2031</p>"))
    expired = F.concat(head, place, F.lit("<p>Requirements: a diploma.</p><p>Duties: visits.</p><p>Closing date: 5 March 2001</p>"))
    landing = F.lit("<h1>Careers</h1><p>Requirements and duties of our vacancies are on their pages.</p>")
    kind = F.pmod(key, F.lit(3))
    made = F.when(kind == 0, vacancy).when(kind == 1, expired).otherwise(landing)
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("https://o.test/jobs/"), key.cast("string")).alias("url"), made.alias("html"), F.concat(F.lit("o"), F.pmod(key, F.lit(7)).cast("string")).alias("organisation_id"),
        F.when(kind == 2, "Careers").otherwise(F.concat(F.lit("Field Officer "), key.cast("string"))).alias("listing_title"), F.lit("").alias("context"),
    )
    return H.from_pages(pages, F.lit("2026-01-01").cast("timestamp")).select("title", "location_raw", "id", "deadline")


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Mombasa, Kenya|Kisumu' WHEN 1 THEN 'Dakar|Kisumu' WHEN 2 THEN 'Lagos|Kisumu' ELSE 'Arusha|Kisumu' END AS places FROM pages""")
def h3_location_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.element_at(F.array(*map(F.lit, _PLACED)), (F.pmod("page_id", F.lit(4)) + 1).cast("int"))
    pages = table(spark, sf_dir, "pages").withColumn("markup", F.concat(place, F.lit("<p>nothing more</p>")))
    return pages.select("page_id", F.array_join(H.location_candidates("markup", F.lit("card | Location: Kisumu | full time")), "|").alias("places"))


# ---- S22: numbered posts of an advert in Swahili.
@query("""WITH n AS (SELECT o_custkey, count(*) AS posts FROM orders GROUP BY 1), p AS (SELECT o_custkey, unnest(range(1, CAST(least(posts, 5) AS BIGINT) + 1)) AS i FROM n)
SELECT 'DEREVA ' || o_custkey || ' ' || i AS title, CAST(i * 3 AS INTEGER) AS positions, o_custkey % 2 = 0 AS citizenship_required FROM p""")
def s22_advert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.least(F.count("*"), F.lit(5)).alias("n"))
    post = F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.concat(i.cast("string"), F.lit(".0 DEREVA "), F.col("o_custkey").cast("string"), F.lit(" "), i.cast("string"), F.lit(" - NAFASI "), (i * 3).cast("string"), F.lit("\nTGS B miaka 2\n")))
    text = F.concat(F.lit("TANGAZO\n"), F.array_join(post, ""), F.when(F.col("o_custkey") % 2 == 0, "Lazima awe raia wa Tanzania. ").otherwise(""), F.lit("Mwisho wa kutuma 3 Machi 2031"))
    docs = sized.select(F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("portal_id"), F.lit("Portal").alias("portal_name"), F.lit("https://g.test").alias("url"), text.alias("text"), F.lit("Tanzania").alias("country_name"), F.array(F.lit("TZ")).alias("eligible_nationalities"))
    found = H.from_advert_text(docs)
    return found.select("title", F.col("government_fields.number_of_positions").alias("positions"), F.col("government_fields.citizenship_required").alias("citizenship_required"))


# ---- F15
@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 20 >= 5 OR o_orderkey % 9 = 0 THEN CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) + (o_orderkey % 20 - 5) * INTERVAL 1 DAY END END AS deadline,
 CASE WHEN o_orderkey % 20 < 5 AND o_orderkey % 9 <> 0 THEN 'before_posted_at' END AS dropped FROM orders""")
def f15_settled_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    posted = F.col("o_orderdate").cast("timestamp_ntz")
    closes = F.when(F.col("o_orderkey") % 9 != 0, posted + F.make_dt_interval((F.col("o_orderkey") % 20 - 5).cast("int")))
    return table(spark, sf_dir, "orders").withColumn("s", X.settle_deadline(posted, closes)).select("o_orderkey", F.col("s.deadline").alias("deadline"), F.col("s.deadline_dropped").alias("dropped"))


# ---- U4, U6
@query("""WITH r AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'generic_title' WHEN o_orderkey % 5 = 0 THEN 'foreign_place' WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 THEN 'out_of_scope' ELSE 'kept' END AS removed_for FROM orders)
SELECT removed_for, count(*) AS count FROM r GROUP BY 1""")
def u4_quality_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.when(k % 7 == 0, "Careers").otherwise(F.concat(F.lit("Field Officer "), k.cast("string"))).alias("title"), F.lit("Plain Foods").alias("org_name"), F.lit("plain-foods").alias("org_id"),
        F.array(F.lit("accounting"), F.lit("data_analysis")).alias("specialisations"), F.array(F.lit("software_engineering")).alias("inferred"),
        F.when(k % 5 == 0, "Tashkent, UZ").otherwise("Nairobi, KE").alias("location_raw"), F.lit(False).alias("opted_in"), (k % 3 != 0).alias("is_african"), F.lit("XX").alias("country_code"),
        F.when(k % 4 == 0, "across East Africa").otherwise("an office").alias("summary"),
    )
    defaults = R.small_table(spark, [("plain-foods", ["accounting"])], "org_id string, defaults array<string>")
    kept, removed = U.quality_repair(rows, defaults, ["KE", "NG", "ZA", "SN", "TZ", "EG"])
    # Institution defaults are gone from every row that stays.
    clean = kept.where(F.array_join("specialisations", "|") == "software_engineering|data_analysis")
    return removed.select("removed_for", "count").union(clean.agg(F.lit("kept").alias("removed_for"), F.count("*").alias("count")))


@query("""SELECT 'current' AS snapshot, FALSE AS needed UNION ALL SELECT 'old_version', TRUE UNION ALL SELECT 'no_profile', TRUE
UNION ALL SELECT 'null_profile', (SELECT count(*) > 0 FROM orders WHERE o_orderpriority = '1-URGENT')""")
def u6_needs_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    whole = orders.withColumn("a", F.struct("o_orderkey")).withColumn("b", F.struct("o_custkey"))
    told = [
        ("current", U.needs_upgrade(whole, "12.0", "12.0", ["a", "b"])), ("old_version", U.needs_upgrade(whole, "11.0", "12.0", ["a"])),
        ("no_profile", U.needs_upgrade(whole, "12.0", "12.0", ["a", "c"])),
        ("null_profile", U.needs_upgrade(whole.withColumn("b", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("b"))), "12.0", "12.0", ["a", "b"])),
    ]
    return spark.createDataFrame(told, "snapshot string, needed boolean")


# ---- G2
@query("""WITH s AS (SELECT o_orderpriority AS s, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT n_name AS c, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
r AS (SELECT r_name AS r, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1), t AS (SELECT count(*) AS n, sum((o_orderstatus = 'O')::INT) AS o FROM orders)
SELECT 'max_single_country_percent' AS gate, 100.0::DOUBLE * (SELECT max(n) FROM c) / n AS value, 4.0::DOUBLE AS "limit", 100.0 * (SELECT max(n) FROM c) / n <= 4 AS passed, 'warning' AS severity FROM t
UNION ALL SELECT 'max_single_source_percent', 100.0::DOUBLE * (SELECT max(n) FROM s) / n, 20.0, 100.0 * (SELECT max(n) FROM s) / n <= 20, 'warning' FROM t
UNION ALL SELECT 'minimum_official_apply_records', o::DOUBLE, 500.0, o >= 500, 'warning' FROM t
UNION ALL SELECT 'minimum_by_region.' || x.r, coalesce(r.n, 0)::DOUBLE, 3000.0, coalesce(r.n, 0) >= 3000, 'warning' FROM (VALUES ('AFRICA'), ('ASIA'), ('OCEANIA')) x(r) LEFT JOIN r ON r.r = x.r""")
def g2_stretch_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select(
        F.col("n_name").alias("country_code"), F.col("r_name").alias("region"), F.col("o_orderpriority").alias("source_name"), (F.col("o_orderstatus") == "O").alias("apply_is_official"), F.lit(True).alias("org_verified"),
        F.lit("Field Officer").alias("title"), F.lit(None).cast("array<string>").alias("eligibility_evidence"),
        *(none.alias(c) for c in ("location_scope", "location_raw", "source_label", "source_url", "apply_url", "raw_description_url", "work_mode", "source_kind", "source_confidence", "summary")),
    )
    gates = {"max_single_country_percent": 4, "max_single_source_percent": 20, "minimum_official_apply_records": 500, "minimum_by_region": {"AFRICA": 3000, "ASIA": 3000, "OCEANIA": 3000}}
    return V.coverage_gates(rows, gates, "warning")


# ---- A17
_METRICS = {
    "organisations": ("customer", {"priority": "c_mktsegment = 'BUILDING'", "in_debt": "c_acctbal < 0", "verified": "c_custkey % 3 = 0"}, {"type": "c_mktsegment", "nation": "c_nationkey"}),
    "connections": ("orders", {"enabled": "o_orderstatus = 'O'", "verified": "o_orderkey % 5 = 0", "recruitee": "o_orderpriority = '2-HIGH'", "workday": "o_orderpriority = '5-LOW'"}, {"adapter": "o_orderpriority", "status": "o_orderstatus"}),
    "portals": ("supplier", {"enabled": "s_acctbal > 0", "disabled": "NOT s_acctbal > 0"}, {"country": "s_nationkey"}),
    "tracks": ("part", {"investment": "p_size > 25", "ngo": "p_size <= 25"}, {"brand": "p_brand", "kind": "p_type"}),
    "countries": ("nation", {"african": "n_regionkey = 0"}, {"region": "n_regionkey"}),
    "events": ("events", {"error": "event_type LIKE 'e%'"}, {"type": "event_type"}),
}


def _inventory_sql() -> str:
    parts = []
    for name, (source, flags, groupings) in _METRICS.items():
        parts.append(f"SELECT '{name}' AS metric, 'entries' AS value, count(*) AS count FROM {source}")
        parts += [f"SELECT '{name}', '{flag}', count(*) FILTER ({rule}) FROM {source}" for flag, rule in flags.items()]
        parts += [f"SELECT '{name}.{g}', coalesce(CAST({column} AS VARCHAR), 'none'), count(*) FROM {source} GROUP BY {column}" for g, column in groupings.items()]
    return " UNION ALL ".join(parts)


@query(_inventory_sql())
def a17_registry_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, (source, flags, groupings) in _METRICS.items():
        one = A.registry_inventory(table(spark, sf_dir, source), {f: F.expr(rule) for f, rule in flags.items()}, {g: F.col(c) for g, c in groupings.items()}, name)
        out = one if out is None else out.union(one)
    return out


# ---- D1 to D6, W9 with addresses, summaries, deadlines and governments
@query("""WITH r AS (SELECT o_orderkey AS pos, o_orderkey // 4 AS g, o_orderkey // 4 % 4 AS kind, o_orderkey % 4 = 2 AS official FROM orders),
w AS (SELECT *, min(pos) OVER (PARTITION BY g) AS lead, max(CASE WHEN official THEN pos END) OVER (PARTITION BY g) AS best FROM r)
SELECT CAST(CASE WHEN official THEN pos WHEN best < pos THEN best ELSE lead END AS BIGINT) AS kept_pos, CAST(CASE WHEN official THEN lead ELSE pos END AS BIGINT) AS removed_pos, official AS replaced,
 CASE kind WHEN 0 THEN 'url|url' WHEN 1 THEN 'content' WHEN 2 THEN 'government' ELSE 'semantic' END AS matched, CASE WHEN kind = 2 THEN 'safe_identity_consolidation' END AS label FROM w WHERE pos <> lead""")
def d2_to_d6_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four postings are one opening: by address (two, in variants), by summary, by an advert's reference, or by
    employer, title, country and deadline. The official one replaces the first."""
    k = F.col("o_orderkey")
    group = F.floor(k / 4)
    kind, text = group % 4, lambda prefix, key: F.concat(F.lit(prefix), key.cast("string"))
    variant = F.element_at(F.array(*map(F.lit, ["http://www.a.test//jobs/{}/?utm_source=x", "https://a.test/jobs/{}", "https://a.test/jobs/{}/#top", "https://www.a.test/jobs/{}?ref=y&utm_term=z"])), (k % 4 + 1).cast("int"))
    notice = F.concat(F.lit("The notice of opening "), group.cast("string"), F.lit(" goes on with wording of no consequence"), F.repeat(F.lit(" for anyone who reads it"), 5))
    same = F.when(kind == 0, k).otherwise(group)  # postings that share an address differ in all else
    rows = table(spark, sf_dir, "orders").select(
        k.cast("long").alias("pos"), text("r", k).alias("id"), text("Field Officer ", same).alias("title"), text("Employer ", same).alias("org_name"), F.lit("KE").alias("country_code"), F.lit("Kenya").alias("country"),
        F.lit(None).cast("string").alias("city"), F.when(kind == 3, F.timestamp_seconds(1_800_000_000 + 86_400 * (group % 5))).alias("deadline"), F.when(kind == 1, notice).alias("summary"),
        F.when(kind == 0, F.replace(variant, F.lit("{}"), group.cast("string"))).alias("apply_url"), F.when(kind == 0, text("https://b.test/pdf/", group)).alias("raw_description_url"), F.lit(None).cast("string").alias("source_kind"),
        F.struct((kind == 2).alias("is_government"), F.when(kind == 2, F.lit("ministry")).alias("registry_id"), F.when(kind == 2, text("REF ", group)).alias("advert_reference"), F.lit(None).cast("string").alias("grade")).alias("government"),
        F.lit(None).cast("string").alias("org_id"), (k % 4 == 2).alias("apply_is_official"), F.lit("aggregated").alias("source_confidence"), F.lit(True).alias("org_verified"),
        F.lit(None).cast("int").alias("years_experience_min"), *(F.lit(None).cast("string").alias(c) for c in ("education_required", "contract_type", "role_family", "industry")),
    )
    keyed = D.identity_keys(rows)
    _, events = D.resolve_duplicates(keyed.withColumn("precedence", D.precedence(keyed)))
    kinds = F.array_join(F.transform("matched_by", lambda m: F.substring_index(m, ":", 1)), "|")
    return events.select("kept_pos", "removed_pos", F.col("replaced_existing").alias("replaced"), kinds.alias("matched"), F.col("government_duplicate_type").alias("label"))


# ---- V5: the constraints of organisations, their connections and portals, each broken by the rows of one remainder.
_V5 = {"organisation_type": ["ngo"], "investment_classification": ["core"], "ngo_classification": ["technical"], "sector": ["telecom"], "category": ["ports"], "portal_adapter": ["tables"]}


@query("""WITH o AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 1 THEN 'Bad Id ' ELSE 'org-' END || c_custkey AS id FROM customer), c AS (SELECT DISTINCT o_custkey FROM orders)
SELECT 'organisations' AS "table", 'id.form' AS rule, id AS key FROM o WHERE k % 11 = 1 UNION ALL SELECT 'organisations', 'name.required', id FROM o WHERE k % 11 = 2
UNION ALL SELECT 'organisations', 'type.vocabulary', id FROM o WHERE k % 11 = 3 UNION ALL SELECT 'organisations', 'families.reference', id FROM o WHERE k % 11 = 4
UNION ALL SELECT 'organisations', 'countries.reference', id FROM o WHERE k % 11 = 5 UNION ALL SELECT 'organisations', 'name.unique', 'same name' FROM o WHERE k % 11 = 6 HAVING count(*) > 1
UNION ALL SELECT 'organisations', 'sources.required', id FROM o WHERE k NOT IN (SELECT o_custkey FROM c)
UNION ALL SELECT 'connections', 'adapter.vocabulary', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 13 = 1 UNION ALL SELECT 'connections', 'identifier.required', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 13 = 2
UNION ALL SELECT 'connections', 'defaults.reference', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 13 = 3 UNION ALL SELECT 'connections', 'connection.unique', 'lever:same' FROM orders WHERE o_orderkey % 13 = 4 HAVING count(*) > 1
UNION ALL SELECT 'portals', 'adapter.vocabulary', 'p' || s_suppkey FROM supplier WHERE s_suppkey % 7 = 1 UNION ALL SELECT 'portals', 'reason.required_if_disabled', 'p' || s_suppkey FROM supplier WHERE s_suppkey % 7 = 2
UNION ALL SELECT 'portals', 'listing.required_if_enabled', 'p' || s_suppkey FROM supplier WHERE s_suppkey % 7 = 3 UNION ALL SELECT 'portals', 'country.reference', 'p' || s_suppkey FROM supplier WHERE s_suppkey % 7 = 4
UNION ALL SELECT 'portals', 'id.form', 'P ' || s_suppkey FROM supplier WHERE s_suppkey % 7 = 5""")
def v5_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobloom.operators import constraints as C

    k, o, s = F.col("c_custkey"), F.col("o_orderkey"), F.col("s_suppkey")
    org_id = lambda key: F.concat(F.when(key % 11 == 1, "Bad Id ").otherwise("org-"), key.cast("string"))
    some = lambda *values: F.array(*map(F.lit, values)).cast("array<string>")
    tables = {
        "organisations": table(spark, sf_dir, "customer").select(
            org_id(k).alias("id"), F.when(k % 11 == 2, " ").when(k % 11 == 6, "Same Name").otherwise(F.concat(F.lit("Employer "), k.cast("string"))).alias("name"), F.when(k % 11 == 3, "club").otherwise("ngo").alias("organisation_type"),
            F.when(k % 11 == 4, some("f1", "f9")).otherwise(some("f1")).alias("career_families"), F.when(k % 11 == 5, some("KE", "ZZ")).otherwise(some("KE")).alias("countries"),
        ),
        "connections": table(spark, sf_dir, "orders").select(
            "o_orderkey", org_id(F.col("o_custkey")).alias("organisation_id"), F.when(o % 13 == 1, "fax").otherwise("lever").alias("adapter"),
            F.when(o % 13 == 2, None).when(o % 13 == 4, "Same").otherwise(F.concat(F.lit("board "), o.cast("string"))).alias("identifier"), F.when(o % 13 == 3, some("s1", "s9")).otherwise(some("s1")).alias("default_specialisations"),
        ),
        "portals": table(spark, sf_dir, "supplier").select(
            F.concat(F.when(s % 7 == 5, "P ").otherwise("p"), s.cast("string")).alias("id"), F.when(s % 7 == 4, "ZZ").otherwise("KE").alias("country_code"), F.when(s % 7 == 1, "x").otherwise("tables").alias("adapter"),
            (s % 7 != 2).alias("enabled"), F.when(s % 7 != 3, "https://p.test").alias("listing_url"), F.lit(None).cast("string").alias("disabled_reason"),
        ),
        "countries": R.small_table(spark, [("KE",)], "iso2 string"), "role_families": R.small_table(spark, [("f1",)], "id string"), "specialisations": R.small_table(spark, [("s1",)], "id string"),
    }
    rules = [c for c in C.registry_constraints(_V5) if c.table in ("organisations", "connections", "portals")]
    return C.check(tables, rules, {"organisations": "id", "connections": "o_orderkey", "portals": "id"})


# ---- T1, S25, S27: what is kept in files. They are written to the shared folder and read back.
def _folder(spark: SparkSession, name: str) -> str:
    import uuid

    from jobloom.operators.lineage import settled

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        settled(spark.range(1))  # sets the folder of a local master, or says that a cluster needs one
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("""WITH r AS (SELECT o_orderkey AS id, o_orderkey // 5 AS opening, o_orderkey % 7 AS score, o_orderkey % 3 AS batch FROM orders)
SELECT opening, id FROM r QUALIFY row_number() OVER (PARTITION BY opening ORDER BY score DESC, batch, id) = 1""")
def t1_merged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of postings merged one after the other; up to five are one opening, the best one stays."""
    from jobloom.streaming import jobs as T

    k, root = F.col("o_orderkey"), _folder(spark, "refresh")
    rows = table(spark, sf_dir, "orders").select(
        k.alias("pos"), k.alias("id"), F.floor(k / 5).alias("opening"), F.array(F.concat(F.lit("semantic:"), F.floor(k / 5).cast("string"))).alias("keys"),
        F.struct((k % 7).alias("score"), F.lit(0).alias("completeness")).alias("precedence"), F.lit(False).alias("is_government"),
    )
    for number in range(3):
        batch = rows.where(k % 3 == number)
        T.merge_batch(batch, number, root, buckets=8)
    return T.kept_rows(spark, root, rows.schema, 2).select("opening", "id")


@query("SELECT o_orderstatus AS status, count(*) AS rows FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY 1")
def s27_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three results are published: the second is a tenth of the first and is refused, the third replaces the first."""
    orders, root = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), _folder(spark, "feed")
    U.publish(orders, root)
    try:
        U.publish(orders.where("o_orderkey % 10 = 0"), root)
        raise AssertionError("a tenth of the rows was published")
    except U.Rejected:
        pass
    U.publish(orders.where("o_orderkey % 10 <> 0"), root)
    return U.read_snapshot(spark, U.current(spark, root), orders.schema).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("rows"))


@query("SELECT o_orderkey AS id, o_orderstatus AS title, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS BOOLEAN) AS is_public FROM orders")
def s25_older_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of an older schema, read with today's: fields that it lacks are null, also inside of structs."""
    path = f"{_folder(spark, 'older')}/snapshot"
    table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("title"), F.struct(F.col("o_orderpriority").alias("country")).alias("loc")).write.parquet(path)
    today = "id long, title string, loc struct<country:string,region:string>, profile struct<is_public:boolean>"
    return U.read_snapshot(spark, path, today).select("id", "title", F.col("loc.region").alias("region"), F.col("profile.is_public").alias("is_public"))
