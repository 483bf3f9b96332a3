"""Every registered query with SQL gives what DuckDB gives for it; the others give rows."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from jobloom.plans import enriched_queries

SF = "/root/testdata/sf0.001"
ALL, SQL = entry.queries(), entry.oracle_sql()
OWN = [n for n in ALL if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.fixture(scope="module", autouse=True)
def enriched_once():
    """The chain is the same for all queries over it: run it once for the module."""
    plain_way = enriched_queries.enriched
    kept = {}

    def once(spark, sf_dir):
        if sf_dir not in kept:
            kept[sf_dir] = plain_way(spark, sf_dir).checkpoint()
        return kept[sf_dir]

    enriched_queries.enriched = once
    yield
    enriched_queries.enriched = plain_way


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "~"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", OWN)
def test_against_sql(spark, duck, name):
    df = ALL[name](spark, SF)
    got = df.collect()
    assert got
    if name in SQL:
        cur = duck.execute(SQL[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == sorted(df.columns)
        order = sorted(names)
        mine = sorted(tuple(plain(r[c]) for c in order) for r in got)
        theirs = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall())
        assert mine == theirs


def test_entry_and_registration(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(ALL)


def test_entities_of_cut_pages_against_sql(spark, tmp_path):
    """A page that is cut inside of an entity: names that HTML5 knows without a semicolon count."""
    pages = [(1, "<p>Water &amp"), (2, "a &quot b &lt c &gt; &am"), (3, "&copy 2024 &middot x"), (4, "&amp;lt; &amplt; &amp;amp;"), (5, None)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.summary for r in ALL["f1_html_to_text"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == dict(c.execute(SQL["f1_html_to_text"]).fetchall())
    assert got[1] == "Water &" and got[4] == "&lt; &lt; &amp;"
