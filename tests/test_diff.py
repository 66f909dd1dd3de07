from __future__ import annotations

import json

import pytest

from attestor.operators.diff import diff_claims

COLS = "entity_id string, ord int, field string, section string, value string, availability string, reporting_period string, note string, source string, observed string"


def claim(field, value, section="identity", state="available", period=None, note=None, source=None, entity="e", ord_=0, observed="t"):
    return (entity, ord_, field, section, value if value is None or isinstance(value, str) else json.dumps(value), state, period, note, source, observed)


def run(spark, prev, cur):
    return runs(spark, {"e": (prev, cur)})["e"]


def runs(spark, cases):
    """{name: changes}: every case is an entity of its own, all compared in one run."""
    as_entity = lambda side: [(name, *row[1:]) for name, pair in cases.items() for row in pair[side]]
    made = diff_claims(spark.createDataFrame(as_entity(0), COLS), spark.createDataFrame(as_entity(1), COLS)).collect()
    return {name: sorted((r.field, r.change_type, r.materiality) for r in made if r.entity_id == name) for name in cases}


BASE = [
    claim("legal_name", "Alpha AS"), claim("revenue", "10.0", "accounts", period="2023"), claim("reporting_period", {"from": "2023-01-01", "to": "2023-12-31"}, "accounts"),
    claim("job_posting", {"name": "cook", "source": "nav"}, "hiring", source="nav"), claim("active_job_count", "1", "hiring"), claim("role", {"name": "A B", "role": "chair"}, "leadership"),
]


def test_self_diff_is_empty_and_first_run_is_baseline(spark):
    assert run(spark, BASE, BASE) == []
    assert run(spark, [], BASE) == []


CASES = {
    "rename": ([claim("legal_name", "Alpha AS")], [claim("legal_name", "Beta AS")], [("legal_name", "changed_name", "material")]),
    "case and space are no change": ([claim("legal_name", "Alpha  AS")], [claim("legal_name", "ALPHA as")], []),
    "filing without revenue": ([claim("reporting_period", {"to": "2023-12-31"}, "accounts")], [claim("reporting_period", {"to": "2024-12-31"}, "accounts")], [("reporting_period", "new_filing", "material")]),
    "one filing, not three": (
        [claim("reporting_period", {"to": "2023-12-31"}, "accounts"), claim("accounts_filing_years", ["2023"], "accounts"), claim("revenue", "1.0", "accounts", period="2023")],
        [claim("reporting_period", {"to": "2024-12-31"}, "accounts"), claim("accounts_filing_years", ["2023", "2024"], "accounts"), claim("revenue", "2.0", "accounts", period="2024")],
        [("reporting_period", "new_filing", "material")],
    ),
    "corrected figure": ([claim("revenue", "1.0", "accounts", period="2023")], [claim("revenue", "2.0", "accounts", period="2023")], [("revenue", "changed_financials", "material")]),
    "closed job": (
        [claim("job_posting", {"name": "cook"}, "hiring", source="nav"), claim("job_posting", {"name": "smith"}, "hiring", source="nav")],
        [claim("job_posting", {"name": "cook"}, "hiring", source="nav_feed")],
        [("job_posting", "closed_job", "material")],
    ),
    "outage is no removal": (
        [claim("job_posting", {"name": "cook"}, "hiring", source="nav")],
        [claim("job_posting", {"name": "smith"}, "hiring", source="site")],
        [("job_posting", "new_job", "material")],
    ),
    "a count vouches for its feed": (
        [claim("job_posting", {"name": "cook"}, "hiring", source="nav")],
        [claim("job_posting", {"name": "smith"}, "hiring", source="site"), claim("active_job_count", "0", "hiring")],
        [("job_posting", "closed_job", "material"), ("job_posting", "new_job", "material")],
    ),
    "skipped step": ([claim("revenue", "1", "accounts")], [claim("revenue", None, "accounts", "not_available", note="not checked this run: late")], []),
    "lost": ([claim("revenue", "1", "accounts")], [claim("revenue", None, "accounts", "failed")], [("revenue", "availability_changed", "material")]),
    "gained": ([claim("founded", None, state="failed")], [claim("founded", "2001")], [("founded", "availability_changed", "minor")]),
    "new website": ([claim("legal_name", "A")], [claim("legal_name", "A"), claim("official_website", "https://a.no", "web")], [("official_website", "new_website", "material")]),
    "same website": ([claim("official_website", "http://www.a.no/", "web")], [claim("official_website", "https://a.no", "web")], []),
    "former name": ([claim("former_names", ["X"])], [claim("former_names", ["X", "Y"])], [("former_names", "changed_name", "material")]),
    "former name by rename": ([claim("legal_name", "X"), claim("former_names", [])], [claim("legal_name", "Y"), claim("former_names", ["X"])], [("legal_name", "changed_name", "material")]),
    "news never go": ([claim("news_item", {"url": "http://a/1"}, "activity")], [claim("news_item", {"url": "http://a/2"}, "activity")], [("news_item", "new_news", "minor")]),
}


@pytest.fixture(scope="module")
def changed(spark):
    return runs(spark, {name: (prev, cur) for name, (prev, cur, _) in CASES.items()})


@pytest.mark.parametrize("name", CASES)
def test_rule(name, changed):
    assert changed[name] == sorted(CASES[name][2])


def test_partitions_make_no_difference(spark):
    other = [*BASE[1:], claim("legal_name", "Gamma AS")]
    a, b = spark.createDataFrame(BASE, COLS), spark.createDataFrame(other, COLS)
    one = sorted(map(repr, diff_claims(a, b).collect()))
    assert one == sorted(map(repr, diff_claims(a.repartition(7), b.repartition(3)).collect()))
