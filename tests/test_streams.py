"""The incremental merge against one de-duplication over all batches."""

import json
import random
from pathlib import Path

from jobloom.operators import dedup as D
from jobloom.streaming import jobs as T

SCHEMA = "pos long, id string, keys array<string>, precedence struct<score:long,completeness:long>, is_government boolean"


def test_merged_batches_equal_one_replay(spark, tmp_path):
    rng = random.Random(8)
    root, every, schema = str(tmp_path / "kept"), [], None
    for number in range(7):
        rows = [(i, f"r{number}-{i}", sorted({f"k{rng.randrange(60)}" for _ in range(rng.randrange(4))}), (rng.randrange(3), rng.randrange(2)), False) for i in range(12)]
        if number == 4:
            rows = []
        every += [((number << 40) + i, keys, precedence) for i, _, keys, precedence, _ in rows]
        batch = spark.createDataFrame(rows, SCHEMA)
        schema = batch.schema
        T.merge_batch(batch, number, root, buckets=8)
        if number in (0, 3, 6):
            slots, _ = D.replay(every)
            assert sorted(r.pos for r in T.kept_rows(spark, root, schema, number).collect()) == sorted(s[0] for s in slots)
    want = sorted(r.pos for r in T.kept_rows(spark, root, schema, 6).collect())
    T.merge_batch(spark.createDataFrame(rows, SCHEMA), 6, root, buckets=8)  # a repeated batch replaces itself
    assert sorted(r.pos for r in T.kept_rows(spark, root, schema, 6).collect()) == want


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "kept")
    first = spark.createDataFrame([(i, f"a{i}", [f"k{i}"], (0, 0), False) for i in range(200)], SCHEMA)
    T.merge_batch(first, 0, root, buckets=16)
    files = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}
    T.merge_batch(spark.createDataFrame([(0, "b0", ["k7"], (5, 0), False), (1, "b1", ["k7", "new"], (0, 0), False)], SCHEMA), 1, root, buckets=16)
    assert {p: p.stat().st_mtime_ns for p in files} == files
    assert len({p.parent for p in Path(root, "rows", "v=1").rglob("*.parquet")}) == 1
    assert len({p.parent for p in Path(root, "points", "v=1").rglob("*.parquet")}) == 1  # k7 points where it did, "new" is new
    kept = {r.slot: r.id for r in T.kept_rows(spark, root, first.schema, 1).collect()}
    assert len(kept) == 200 and kept[7] == "b0"
    manifest = spark.read.parquet(f"{root}/manifest/v=1").where("kind = 'rows'")
    assert manifest.where("version = 1").count() == 1 and manifest.count() == 16


RUNS = "source string, status string, at timestamp, freshness_hours double, rows long"


def _land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("source", "status", "at", "freshness_hours", "rows"), r, strict=True))) for r in rows))


def _run(frame, out, checkpoint):
    frame.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination(120)


def test_sources_that_fall_silent_are_named_once(spark, tmp_path):
    landing, out, cp = tmp_path / "runs", str(tmp_path / "out"), str(tmp_path / "cp")
    stream = lambda: T.watch_freshness(spark.readStream.schema(RUNS).json(str(landing)))
    stale = lambda: sorted((r.source, str(r.last_good), str(r.stale_since)) for r in spark.read.schema(T.STALE).parquet(out).collect())
    _land(landing, "1.json", [("a", "ok", "2026-01-01T00:00:00Z", 2.0, 1), ("b", "ok", "2026-01-01T05:00:00Z", 2.0, 1), ("c", "error: x", "2026-01-01T00:30:00Z", 1.0, 0)])
    _run(stream(), out, cp)
    # Event time is 05:00 less half an hour: a is silent since 02:00, c had no good run at all.
    assert stale() == [("a", "2026-01-01 00:00:00", "2026-01-01 02:00:00"), ("c", "None", "2026-01-01 01:30:00")]
    # After a restart: b's later run is late but newer; a runs again and falls silent again; c stays as told.
    _land(landing, "2.json", [("b", "ok", "2026-01-01T06:00:00Z", 2.0, 1), ("a", "ok", "2026-01-01T06:00:00Z", 2.0, 1), ("b", "ok", "2026-01-01T04:00:00Z", 2.0, 1), ("b", "error", "2026-01-01T09:00:00Z", 2.0, 1)])
    _run(stream(), out, cp)
    assert stale()[:2] == [("a", "2026-01-01 00:00:00", "2026-01-01 02:00:00"), ("a", "2026-01-01 06:00:00", "2026-01-01 08:00:00")]
    assert [r[0] for r in stale()] == ["a", "a", "b", "c"]


def test_streamed_health_windows_drop_late_runs(spark, tmp_path):
    landing, out, cp = tmp_path / "runs", str(tmp_path / "out"), str(tmp_path / "cp")
    first = [("a", "ok", "2026-01-01T00:10:00Z", 1.0, 5), ("a", "error: x", "2026-01-01T00:20:00Z", 1.0, 0), ("b", "ok", "2026-01-01T03:00:00Z", 1.0, 2)]
    late, last = ("a", "ok", "2026-01-01T00:30:00Z", 1.0, 7), ("b", "ok", "2026-01-01T08:00:00Z", 1.0, 1)
    for name, rows in (("1.json", first), ("2.json", [late, last])):
        _land(landing, name, rows)
        _run(T.health_windows(spark.readStream.schema(RUNS).json(str(landing)), "1 hour", "30 minutes"), out, cp)
    got = sorted((str(r.window_start), r.source, r.runs, r.errors, r.rows) for r in spark.read.parquet(out).collect())
    (tmp_path / "kept").mkdir()
    on_time = T.health_windows(spark.read.schema(RUNS).json(spark.sparkContext.parallelize([json.dumps(dict(zip(("source", "status", "at", "freshness_hours", "rows"), r, strict=True))) for r in [*first, last]])))
    want = sorted((str(r.window_start), r.source, r.runs, r.errors, r.rows) for r in on_time.collect())
    assert got == [w for w in want if w[0] < "2026-01-01 07"]  # the last window is open still, the late run is in none
    assert ("2026-01-01 00:00:00", "a", 2, 1, 5) in got
