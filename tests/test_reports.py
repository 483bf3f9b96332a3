"""Reports over postings that a long chain made: what they count, and how often they run it."""

from jobloom.operators import reports as A


def test_multinationals_are_counted_in_one_pass(spark, tmp_path):
    rows = [(True, "telecom", "Lagos"), (True, None, "Lagos"), (True, "", None), (False, "telecom", "Lagos"), (None, "retail", "Accra")]
    made = spark.createDataFrame(rows, "is_multinational boolean, sector string, city string").selectExpr("struct(is_multinational, sector) AS multinational_profile", "struct(city) AS loc")
    made.write.parquet(str(tmp_path / "postings"))
    registry = spark.createDataFrame([("a", "telecom", ["Lagos", "Accra"]), ("b", None, None)], "id string, sector string, cities array<string>")
    report = A.multinational_report(spark.read.parquet(str(tmp_path / "postings")), registry)
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert sorted(map(tuple, report.collect())) == [("city", "Accra", 1, 0), ("city", "Lagos", 1, 2), ("sector", "none", 1, 2), ("sector", "telecom", 1, 1)]
