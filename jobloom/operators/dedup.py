"""Entity de-duplication across sources, faithful to the order of rows.

The rule is greedy: rows come in order, each brings a set of keys, and a row that hits a key of kept
rows goes to the kept row with the smallest index, where the better of the two stays; the keys of both
then point there. Other kept rows that were hit stay, so the result isn't one row for each connected
component. But rows in different components of the graph of rows and keys can't affect each other, so
the rule is replayed per component, in order, and only keys that are on two rows or more matter. A task
streams through the sorted rows of one component after the other and holds the present component's keys and
slots, never its rows, so there is no limit on the rows of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions.normalise import norm_dedup
from jobloom.operators.lineage import settled, stored

# Parameters that only track visitors, names that identify nobody, weights of sources.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "ref", "source"]
GENERIC_EMPLOYERS = ["unknown employer", "unknown organisation", "confidential", "confidential employer", "not disclosed", "undisclosed", "reliefweb listed organisation"]
CONFIDENCE_SCORE = {"official": 45, "aggregated": 20, "community": 5, "unverified": 0}
KIND_SCORE = {"employer_ats": 35, "employer_official": 35, "government_official": 35, "institution_official": 35, "institutional_aggregator": 12, "commercial_aggregator": 0}


def canonical_url(url: Column | str) -> Column:
    """Https, no www., single slashes and none at the end, tracking parameters dropped, the others sorted, no fragment."""
    u = F.col(url) if isinstance(url, str) else url
    u = F.when(u.rlike("^https?://"), u)
    rest = F.regexp_replace(F.regexp_replace(u, "^https?://", ""), "#.*$", "")
    before_query = F.regexp_extract(rest, r"^([^?]*)", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(before_query, "^([^/]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(before_query, r"^[^/]*(.*)$", 1), "/+", "/"), "/$", "")
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)
    pairs = F.transform(
        F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: p != ""),
        lambda p: F.struct(decode(F.substring_index(p, "=", 1)).alias("k"), F.when(p.contains("="), decode(F.regexp_extract(p, "=(.*)$", 1))).otherwise(F.lit("")).alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda x: ~F.lower(x["k"]).isin(TRACKING)))
    query = F.array_join(F.transform(kept, lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&")
    return F.concat(F.lit("https://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def content_hash(summary: Column | str) -> Column:
    """D3: 20 hex digits of the normalised summary's first 2,000 characters; null under 120 characters."""
    text = norm_dedup(summary)
    return F.when(F.length(text) >= 120, F.substring(F.sha2(F.substring(text, 1, 2000), 256), 1, 20))


def identity_keys(postings: DataFrame) -> DataFrame:
    """Adds keys. postings: id, title, org_name, country_code, country, city, deadline, summary, apply_url,
    raw_description_url, source_kind, government (struct is_government, registry_id, advert_reference, grade), org_id."""
    n = {c: norm_dedup(c) for c in ("title", "org_name", "city")} | {"deadline": norm_dedup(_as_text(postings, "deadline"))}
    rows = postings.withColumns({f"n_{c}": v for c, v in n.items()}).withColumn("n_country", norm_dedup(F.coalesce("country_code", "country"))).withColumn("n_content", content_hash("summary"))
    rows = rows.withColumn("n_registry", norm_dedup(F.coalesce("government.registry_id", "org_id", "org_name"))).withColumn("n_reference", norm_dedup("government.advert_reference")).withColumn("n_grade", norm_dedup("government.grade"))
    rows = rows.withColumn("is_government", F.coalesce("government.is_government", F.lit(False)) | F.coalesce(F.col("source_kind") == "government_official", F.lit(False)))
    some = lambda *names: sum_and(*(F.col(x) != "" for x in names))
    bar = lambda prefix, *names: F.concat(F.lit(prefix), F.concat_ws("|", *names))
    usable = some("n_org_name") & ~F.col("n_org_name").isin(GENERIC_EMPLOYERS)
    official = F.col("is_government") & some("n_country", "n_registry", "n_title")
    government = F.when(official & some("n_reference"), bar("government:", "n_country", "n_registry", "n_reference", "n_title")).when(official, bar("government:", "n_country", "n_registry", "n_title", "n_grade", "n_city"))
    placed = usable & some("n_title", "n_country")
    semantic = F.when(placed & some("n_city"), bar("semantic:", "n_org_name", "n_title", "n_country", "n_city")).when(placed & some("n_deadline"), bar("semantic:", "n_org_name", "n_title", "n_country", "n_deadline"))
    content = F.when(placed & F.col("n_content").isNotNull(), bar("content:", "n_org_name", "n_title", "n_country", "n_city", "n_content"))
    url = lambda c: F.concat(F.lit("url:"), canonical_url(c))
    own = F.concat(F.lit("id:"), F.coalesce(F.col("id").cast("string"), F.lit("None")))
    keys = F.when(government.isNotNull(), F.array(own, government)).otherwise(F.array(own, url("apply_url"), url("raw_description_url"), semantic, content))
    return rows.withColumn("keys", F.array_distinct(F.array_compact(keys))).drop(*(c for c in rows.columns if c.startswith("n_") and c not in postings.columns))


def _as_text(rows: DataFrame, column: str) -> Column:
    """A time as ISO text in UTC, a date as ISO text, other types as they are."""
    kind = dict(rows.dtypes)[column]
    if kind.startswith("timestamp"):
        at = F.to_utc_timestamp(column, F.current_timezone()) if kind == "timestamp" else F.col(column)
        return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.col(column).cast("string")


def sum_and(first: Column, *more: Column) -> Column:
    for x in more:
        first = first & x
    return first


def precedence(rows: DataFrame) -> Column:
    """Struct (score, completeness); the larger one stays. contract_type "unknown" counts as given, 0 years don't."""
    weight = lambda table, c: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for item in table.items() for x in item)), c), F.lit(0))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int")
    filled = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit("")) != "").cast("int") if dict(rows.dtypes)[c] != "int" else (F.coalesce(F.col(c), F.lit(0)) != 0).cast("int")
    score = 100 * yes("apply_is_official") + weight(CONFIDENCE_SCORE, "source_confidence") + weight(KIND_SCORE, "source_kind") + 8 * yes("org_verified")
    fields = ["deadline", "years_experience_min", "education_required", "contract_type", "role_family", "industry", "summary", "country_code", "city"]
    return F.struct(score.alias("score"), sum((filled(c) for c in fields[1:]), filled(fields[0])).alias("completeness"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(a, b) -> (node, component), the smallest id reachable; star contractions, checkpointed each round."""
    now = settled(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    seen = None
    for _ in range(rounds):
        around = now.union(now.select("v", "u"))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        roots = up.groupBy("u").agg(F.min("v").alias("m"))
        now = settled(up.join(roots, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(roots).distinct())
        state = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if state == seen:
            return now.union(now.select("v", "v").distinct()).toDF("node", "component")
        seen = state
    raise RuntimeError("components did not settle")


class Replay:
    """The greedy rule over the rows of one component, given in order."""

    def __init__(self) -> None:
        self.slots: dict[int, tuple] = {}  # the row that holds each slot, which is named by the first row's position
        self.points: dict[str, int] = {}
        self.told: dict[str, int] = {}  # what keys pointed to when the replay began

    def hold(self, slot: int, row: tuple, keys: list[str]) -> None:
        """A slot of an earlier replay, and those of the keys asked for that point to it."""
        self.slots[slot] = row
        self.points.update(dict.fromkeys(keys, slot))
        self.told.update(dict.fromkeys(keys, slot))

    def add(self, row: tuple) -> tuple | None:
        """row: (pos, keys, precedence, ...). An event (row that stays, row that goes, replaced, matched keys) if one is removed."""
        hit = [k for k in row[1] if k in self.points]
        if not hit:
            self.points.update(dict.fromkeys(row[1], row[0]))
            self.slots[row[0]] = row
            return None
        at = min(self.points[k] for k in hit)
        held = self.slots[at]
        better = row[2] > held[2]
        stays, goes = (row, held) if better else (held, row)
        self.slots[at] = stays
        self.points.update(dict.fromkeys((*stays[1], *goes[1]), at))
        return stays, goes, better, sorted(hit)[:8]


def replay(rows: list[tuple]) -> tuple[list, list[tuple]]:
    """Kept rows by slot, and the events as (kept pos, removed pos, replaced, matched keys)."""
    run = Replay()
    events = [e for row in rows if (e := run.add(row))]
    return list(run.slots.values()), [(stays[0], goes[0], better, hit) for stays, goes, better, hit in events]


_PLAYED = "kept long, stays long, goes long, replaced boolean, matched_by array<string>, kind string"


def _played(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (component, pos, keys, score, completeness, is_government), sorted by the first two, to _PLAYED."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.string()]
    names = ["kept", "stays", "goes", "replaced", "matched_by", "kind"]
    now, run, out = None, Replay(), []

    def give() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [()] * 6
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    for batch in batches:
        for component, pos, keys, score, completeness, public in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if component != now:
                out += [(row[0], row[0], None, None, None, None) for row in run.slots.values()]
                now, run = component, Replay()
            event = run.add((pos, keys, (score, completeness), public))
            if event:
                stays, goes, better, hit = event
                safe = stays[3] and any(k.startswith(("government:", "id:")) for k in hit)
                kind = None if not goes[3] else "safe_identity_consolidation" if safe else "destructive_or_unexplained_loss"
                out.append((None, stays[0], goes[0], better, hit, kind))
        yield give()
    out += [(row[0], row[0], None, None, None, None) for row in run.slots.values()]
    yield give()


def resolve_duplicates(postings: DataFrame, order_col: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(kept, events). postings: pos (unique, the order of input), keys, precedence, id, is_government.

    kept are the rows that hold a slot at the end. events (D6) name both rows, the keys that matched, and for a
    removed government row whether an identity key explains it.
    """
    light = stored(postings.select(F.col(order_col).alias("pos"), "keys", "precedence", "is_government"), "keys")
    keyed = light.select("pos", F.explode("keys").alias("key"))
    first = keyed.groupBy("key").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = settled(keyed.join(first, "key").select("pos", "key", "first"))
    labels = components(shared.select(F.col("first").alias("a"), F.col("pos").alias("b")))
    members = shared.groupBy("pos").agg(F.collect_set("key").alias("keys")).join(labels, F.col("pos") == F.col("node")).select("component", "pos", "keys")
    grouped = members.join(light.drop("keys"), "pos").select("component", "pos", "keys", "precedence.score", "precedence.completeness", "is_government")

    played = settled(grouped.repartition("component").sortWithinPartitions("component", "pos").mapInArrow(_played, _PLAYED))
    staying = played.where("kept is not null").select(F.col("kept").alias(order_col))
    touched = members.select(F.col("pos").alias(order_col)).distinct()
    kept = postings.join(touched, order_col, "left_anti").unionByName(postings.join(staying, order_col, "left_semi"))
    ids = postings.select(F.col(order_col).alias("p"), F.col("id").cast("string").alias("i"))
    events = (
        played.where("goes is not null")
        .join(ids.toDF("stays", "kept_id"), "stays").join(ids.toDF("goes", "removed_id"), "goes")
        .select("kept_id", "removed_id", F.col("stays").alias("kept_pos"), F.col("goes").alias("removed_pos"), F.col("replaced").alias("replaced_existing"), "matched_by", F.col("kind").alias("government_duplicate_type"))
    )
    return kept, events


def first_by_id(rows: DataFrame, id_col: str = "id", order_col: str = "pos") -> DataFrame:
    """Of rows with the same id the first."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(id_col).orderBy(order_col))).where("nth = 1").drop("nth")


def dedup_report(postings: DataFrame, kept: DataFrame, events: DataFrame) -> DataFrame:
    """One row of counts and percents."""
    from jobloom.functions.extract import percent

    before = postings.agg(F.count("*").alias("input_count"), F.count_if("is_government").alias("government_input_count"))
    after = kept.agg(F.count("*").alias("published_count"), F.count_if("is_government").alias("government_published_count"))
    of = events.agg(
        F.count_if("replaced_existing").alias("official_replacements"),
        F.count_if(F.col("government_duplicate_type") == "safe_identity_consolidation").alias("government_safe_duplicate_count"),
        F.count_if(F.col("government_duplicate_type") == "destructive_or_unexplained_loss").alias("government_destructive_loss_count"),
    )
    one = before.crossJoin(after).crossJoin(of)  # three single rows
    return one.withColumn("removed_count", F.col("input_count") - F.col("published_count")).withColumn("government_duplicate_consolidation_percent", percent("government_safe_duplicate_count", "government_input_count")).withColumn("government_destructive_loss_percent", percent("government_destructive_loss_count", "government_input_count"))
