"""The flat tables of pages, contributors, templates and texts hold every value of the records."""

import json

import pytest

from lexweave.plans.catalogue import queries

REVISIONS = [
    {"id": 1, "contributor": {"id": 7, "username": "Ann"}, "text": "one", "sections": [{"templates": [{"name": "inh", "count": 3}, {"name": "der"}]}, {"templates": []}]},
    {"id": "2", "contributor": {"id": None, "username": None, "ip": "10.0.0.1"}, "sections": [{"path": ["A"]}, {"templates": [{"count": 2}]}]},
    {"id": 3, "contributor": "deleted", "text": ""},
    {"id": 4, "contributor": {"id": "8", "username": "Bo", "ip": "10.0.0.2"}, "text": "four", "sections": None},
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pages"))
    pages = [(10, "ten", 0, None, json.dumps(REVISIONS[:2])), (10, "ten", 0, True, json.dumps(REVISIONS[2:3])), (11, None, 2, None, json.dumps(REVISIONS[3])), (12, "bare", 0, None, None), (13, "empty", 0, False, "")]
    spark.createDataFrame(pages + pages[:1], "id long, title string, ns int, partial boolean, revision string").write.parquet(f"{d}/json_page.parquet")
    return d


def got(folder, spark, name):
    return sorted((tuple(r) for r in queries()[name](spark, folder).collect()), key=str)


def test_pages(spark, folder):
    assert got(folder, spark, "p7_pages") == [(10, "ten", 0, True), (11, None, 2, False), (12, "bare", 0, False), (13, "empty", 0, False)]


def test_contributors(spark, folder):
    assert got(folder, spark, "p7_contributors") == [(10, 1, "7", "Ann", None), (10, 2, None, None, "10.0.0.1"), (11, 4, "8", "Bo", "10.0.0.2")]


def test_templates(spark, folder):
    assert got(folder, spark, "p7_templates") == [(10, 1, 1, 1, "inh", 3), (10, 1, 1, 2, "der", None), (10, 2, 2, 1, None, 2)]


def test_texts(spark, folder):
    assert got(folder, spark, "p7_texts") == [(10, 1, "one"), (10, 3, ""), (11, 4, "four")]
