"""Pages by cursors, and publishing under contention."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobloom.operators import search as S
from jobloom.operators import snapshot as U


def test_pages_by_cursor_are_the_ordered_result(spark):
    rows = [(i, f"2026-01-{1 + i * 7 % 9:02d} 00:00:00" if i % 5 else None, f"t{i}") for i in range(47)]
    items = spark.createDataFrame(rows, "pos long, posted string, title string").withColumn("posted", F.col("posted").cast("timestamp"))
    items = items.withColumns({c: F.lit("") for c in S_COLUMNS if c not in items.columns})
    as_of = F.lit("2026-02-01").cast("timestamp")
    for by in ("recent", "relevance"):
        request = S.SearchRequest(selected={}, sort_by=by)
        want = [r.pos for r in S.search(items, request, as_of).collect()]
        got, cursor = [], None
        for _ in range(6):
            page = S.page_after(items, request, as_of, cursor, size=10)
            got += [r.pos for r in page.collect()]
            cursor = S.cursor_of(page) or cursor
        assert got == want and len(got) == 47
    plan = S.page_after(items, S.SearchRequest(selected={}, sort_by="recent"), as_of, S.Cursor(None, 3), size=10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


S_COLUMNS = ["title", "organisation", "country", "city", "location", "industry", "source", "status", "work_mode"]


def test_two_writers_cannot_publish_over_each_other(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "feed")
    assert U.current(spark, root) is None
    first = U.publish(spark.range(10).toDF("id"), root)
    assert U.current(spark, root) == first
    # A second writer takes number 2 while a third one, whose result is small, still checks against number 1.
    real, raced = U._claim, []

    def claim(session, at, number, path):
        if not raced:
            raced.append(U._latest(session, at)[0])
            assert real(session, at, number, big)
        return real(session, at, number, path)

    big = str(tmp_path / "big")
    spark.range(100).toDF("id").write.parquet(big)
    monkeypatch.setattr(U, "_claim", claim)
    with pytest.raises(U.Rejected):  # 8 rows were enough beside 10, they aren't beside the 100 published meanwhile
        U.publish(spark.range(8).toDF("id"), root)
    assert U.current(spark, root) == big and raced == [1]
    monkeypatch.setattr(U, "_claim", lambda *_: False)
    with pytest.raises(U.Overtaken):
        U.publish(spark.range(90).toDF("id"), root)
    monkeypatch.setattr(U, "_claim", real)
    with pytest.raises(U.Rejected):
        U.publish(spark.range(0).toDF("id"), root)
    assert U.current(spark, root) == big
    last = U.publish(spark.range(80).toDF("id"), root)
    assert U.current(spark, root) == last and sorted(p.name for p in Path(root, "versions").iterdir() if p.name.startswith("v")) == [f"v{i:012d}" for i in (1, 2, 3)]
    assert not real(spark, root, 3, "x") and not [p for p in Path(root, "versions").iterdir() if p.name.startswith("_")]
