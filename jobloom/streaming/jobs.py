"""Structured Streaming forms of what the batch jobs do on a schedule."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

LANDING = "source_key string, target_id string, fetched_at timestamp, payload string"


def landed_stream(spark: SparkSession, path: str) -> DataFrame:
    """Payloads as they land, as JSON lines."""
    return spark.readStream.schema(LANDING).json(path)


def merge_refresh(landed: DataFrame, project, kept_path: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Each batch of payloads is projected and merged with the kept rows, touching only what its keys touch.

    project: landing -> postings with pos, keys, precedence, is_government. The outcome is that of one
    de-duplication over all batches in their order; kept_rows() reads it.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(project(batch), number, kept_path, buckets)

    return landed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _manifest(spark: SparkSession, root: str, number: int) -> dict[tuple[str, int], int]:
    """Which version holds each bucket after batch `number`: as many entries as there are buckets, twice."""
    if number < 0:
        return {}
    found = spark.read.schema("kind string, bucket int, version long").parquet(f"{root}/manifest/v={number}")
    return {(r.kind, r.bucket): r.version for r in found.collect()}


def _bucketed(spark: SparkSession, root: str, kind: str, schema, manifest: dict, only: set[int] | None = None) -> DataFrame:
    paths = [f"{root}/{kind}/v={v}/bucket={b}" for (k, b), v in sorted(manifest.items()) if k == kind and (only is None or b in only)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def kept_rows(spark: SparkSession, root: str, schema, number: int) -> DataFrame:
    """The kept postings after batch `number`, with the slot that each holds."""
    return _bucketed(spark, root.rstrip("/"), "rows", _with_slot(schema), _manifest(spark, root.rstrip("/"), number))


def _with_slot(schema: StructType) -> StructType:
    return StructType([StructField("slot", LongType()), *schema.fields])


POINTS = "key string, slot long"
_RESUMED = "slot long, holder long, key string"


def _resumed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (component, pos, slot, keys, asked, score, completeness), sorted by the first two, to _RESUMED.

    Rows with a slot come from the kept table (their position is the slot's, before all new ones); asked are the
    batch's keys that point to it. Out come the holders of slots that changed or are new, and keys with their slots.
    """
    from jobloom.operators.dedup import Replay

    now, run, had, out = None, Replay(), {}, []

    def give() -> None:
        out.extend((slot, row[0], None) for slot, row in run.slots.items() if had.get(slot) != row[0])
        out.extend((slot, None, key) for key, slot in run.points.items() if run.told.get(key) != slot)

    for batch in batches:
        for component, pos, slot, keys, asked, score, completeness in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if component != now:
                give()
                now, run, had = component, Replay(), {}
            if slot is not None:
                run.hold(slot, (pos, keys, (score, completeness)), asked or [])
                had[slot] = pos
            else:
                run.add((pos, keys, (score, completeness)))
        if len(out) > 10_000:
            yield _batch(out)
            out.clear()
    give()
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["slot", "holder", "key"])


def merge_batch(fresh: DataFrame, number: int, root: str, buckets: int = 64) -> None:
    """One batch of merge_refresh: what D5 needs of the past is which slot each key points to, and who holds the slot.

    Kept rows lie in buckets of their slot, keys in buckets of their hash. Only keys of the batch are looked up,
    only slots that they point to are read, and only buckets with a changed slot or key are written, under the
    batch's number; the manifest that names each bucket's version is written last, so a batch counts as a whole
    or not at all, and a repeated one replaces itself. Files of other buckets stay as they are.
    """
    from jobloom.operators.dedup import components
    from jobloom.operators.lineage import settled

    spark, root = fresh.sparkSession, root.rstrip("/")
    manifest = _manifest(spark, root, number - 1)
    # Positions of later batches come after those of earlier ones.
    fresh = settled(fresh.withColumn("pos", F.col("pos").cast("long") + F.lit(number << 40)))
    schema = fresh.schema
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
    touched = lambda df, c: {r[0] for r in df.select(bucket(c)).distinct().collect()}  # noqa: E731  # as many as there are buckets

    keyed = fresh.select("pos", F.explode("keys").alias("key"))
    keys = settled(keyed.groupBy("key").agg(F.min("pos").alias("first")))
    points = _bucketed(spark, root, "points", POINTS, manifest, touched(keys, "key"))
    known = settled(keys.join(points, "key", "left").select("key", "first", "slot"))
    holders = known.where("slot IS NOT NULL").groupBy("slot").agg(F.collect_set("key").alias("asked"))
    rows = _bucketed(spark, root, "rows", _with_slot(schema), manifest, touched(known.where("slot IS NOT NULL"), "slot"))
    held = settled(holders.join(rows, "slot").select("slot", F.col("pos").alias("holder"), "keys", "asked", "precedence"))

    edges = keyed.join(known, "key").select(F.coalesce("slot", "first").alias("a"), F.col("pos").alias("b"))
    labels = components(edges)
    old = held.select("slot", F.col("slot").alias("node"), F.col("holder").alias("pos"), "keys", "asked", "precedence")
    new = fresh.select(F.lit(None).cast("long").alias("slot"), F.col("pos").alias("node"), "pos", "keys", F.lit(None).cast("array<string>").alias("asked"), "precedence")
    members = old.unionByName(new).join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ordered = members.repartition("component").sortWithinPartitions("component", "node")
    found = settled(ordered.select("component", "pos", "slot", "keys", "asked", "precedence.score", "precedence.completeness").mapInArrow(_resumed, _RESUMED))

    changed = found.where("holder IS NOT NULL").select("slot", F.col("holder").alias("pos"))
    winners = changed.join(fresh, "pos").select("slot", *schema.names)  # a slot changes to a row of the batch only
    pointed = found.where("key IS NOT NULL").select("key", "slot")
    for kind, news, by, kept_schema in (("rows", winners, "slot", _with_slot(schema)), ("points", pointed, "key", POINTS)):
        at = touched(news, by)
        before = _bucketed(spark, root, kind, kept_schema, manifest, at).join(news.select(by), by, "left_anti")
        both = before.unionByName(news).withColumn("bucket", bucket(by))
        both.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{kind}/v={number}")
        manifest |= {(kind, b): number for b in at}
    table = spark.createDataFrame([(k, b, v) for (k, b), v in manifest.items()], "kind string, bucket int, version long")
    table.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v={number}")


def health_windows(runs: DataFrame, window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Runs, failures and rows of each source in tumbling windows of event time; works on streams and tables.
    runs: (source, status, rows, at)."""
    timed = runs.withWatermark("at", late) if runs.isStreaming else runs
    return timed.groupBy(F.window("at", window).alias("w"), "source").agg(F.count("*").alias("runs"), F.count_if(F.col("status").startswith("error")).alias("errors"), F.sum("rows").alias("rows")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "source", "runs", "errors", "rows")


def stale_sources(runs: DataFrame, freshness: DataFrame, as_of) -> DataFrame:
    """Sources without a good run within their freshness_hours at as_of, or without any. freshness: (source, freshness_hours)."""
    last = runs.where(~F.col("status").startswith("error")).groupBy("source").agg(F.max("at").alias("last_good"))
    joined = freshness.join(last, "source", "left")
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("last_good")) / 3600
    return joined.where(F.col("last_good").isNull() | (age > F.col("freshness_hours"))).select("source", "last_good", "freshness_hours")


STALE = "source string, last_good timestamp, stale_since timestamp"
_SILENCE = "last_good timestamp, since timestamp, hours double, told boolean"


def _epoch_ms(at: pd.Timestamp) -> int:
    return int(at.value // 1_000_000)


def _watched(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One source: its last good run, and a timer at the end of its freshness. Runs of any age only move it forward."""
    last, since, hours, told = state.get if state.exists else (None, None, None, False)
    if state.hasTimedOut:
        told = True
        yield pd.DataFrame({"source": [key[0]], "last_good": [last], "stale_since": [since + pd.Timedelta(hours=hours)]})
        state.update((last, since, hours, told))
        return
    for batch in batches:
        good = batch.loc[~batch["status"].fillna("").str.startswith("error"), "at"].max()
        if pd.notna(good) and (last is None or pd.isna(last) or good > last):
            last, since, told = good, good, False
        if since is None:  # no good run yet: its freshness counts from the first run that was seen
            since = batch["at"].min()
        hours = float(batch["freshness_hours"].iloc[-1])
    ends = since + pd.Timedelta(hours=hours)
    if not told and _epoch_ms(ends) <= state.getCurrentWatermarkMs():
        told = True
        yield pd.DataFrame({"source": [key[0]], "last_good": [last], "stale_since": [ends]})
    state.update((last, since, hours, told))
    if not told:
        state.setTimeoutTimestamp(_epoch_ms(ends))


def watch_freshness(runs: DataFrame, late: str = "30 minutes") -> DataFrame:
    """T3 as a stream: a row for each source when event time passes its freshness_hours without a good run.

    runs: a stream of (source, status, at, freshness_hours). A source is named once for each silence; a good run
    ends the silence. Late runs count as long as they are newer than what is known. State is three values for each
    source, kept in the stream's checkpoint, so a restart goes on where it stopped.
    """
    timed = runs.withWatermark("at", late).where("source IS NOT NULL AND at IS NOT NULL AND freshness_hours IS NOT NULL")
    return timed.groupBy("source").applyInPandasWithState(_watched, STALE, _SILENCE, "append", GroupStateTimeout.EventTimeTimeout)
