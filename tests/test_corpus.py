"""Hit rates of the classifiers over reviewed cases from a JSON file."""

import json

import pytest

from jobloom import registries as R
from jobloom.operators import classify as C


def test_hit_rates_of_reviewed_cases(spark, tmp_path):
    cases = [
        {"title": "Private Equity Associate", "organisation_type": "private_equity", "specialisations": [], "expected_classification": "core_investment", "expected_track": "private_equity"},
        {"title": "Driver", "organisation_type": "company", "expected_classification": "not_investment", "expected_track": None},
        {"title": "Driver", "expected_classification": "core_investment", "expected_track": "private_equity"},
    ]
    path = tmp_path / "investment.json"
    path.write_text(json.dumps({"corpus_version": "1", "case_count": 3, "cases": cases}))
    got = C.corpus_report(spark, str(path), R.INVESTMENT, "investment").collect()
    assert [r.hit for r in got] == [True, True, False] and got[2].classification == "not_investment"
    ngo = tmp_path / "ngo.json"
    ngo.write_text(json.dumps({"cases": [{"title": "Child Protection Officer", "organisation_type": "ngo", "expected_classification": "technical_programme", "expected_track": "child_protection", "expected_programme_role": True}, {"title": "Child Protection Officer", "organisation_type": "ngo", "expected_classification": "technical_programme", "expected_track": "child_protection", "expected_programme_role": False}]}))
    assert [r.hit for r in C.corpus_report(spark, str(ngo), R.NGO, "ngo").collect()] == [True, False]
    with pytest.raises(ValueError):
        C.corpus_report(spark, str(ngo), R.NGO, "other")
