"""Physical plans of all registered queries and of some key operators."""

import re

import pytest
from fixture import ROWS, SCHEMA, spec

from gleaner import Condition, Facet, Grouping, SearchIndex, search, where_all

SF = "/root/testdata/sf0.001"
STEMMED = {"postings_text", "analyze_by_lang", "stem_vocab", "excerpt", "highlight"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    from catalog import QUERIES

    return {name: plan(fn(spark, SF)) for name, fn in QUERIES.items()}


def test_no_query_crosses_rows(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_python_runs_for_stems_only(plans):
    assert {n for n, text in plans.items() if re.search(r"Python|Pandas", text)} == STEMMED


def test_broadcasts_are_bounded(plans):
    """Only Spark's own size-checked choice may broadcast: the library gives no hint."""
    import pathlib

    root = pathlib.Path(__file__).parent.parent
    files = [p for d in ("gleaner", "catalog") for p in (root / d).rglob("*.py") if "llm" not in p.parts]
    assert files and not [p for p in files if "broadcast(" in p.read_text()]


def test_windows_are_pruned_before_their_shuffle(plans):
    for name in ("group_limit", "facet_limit", "field_top_terms"):
        assert "WindowGroupLimit" in plans[name], name


def test_filters_and_columns_reach_the_scan(plans):
    scan = next(l for l in plans["filter_string_range"].splitlines() if "FileScan" in l)
    assert "GreaterThanOrEqual(o_orderpriority,2)" in scan
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>", scan)
    scan = next(l for l in plans["top_k"].splitlines() if "FileScan" in l)
    assert "EqualTo(o_orderstatus,F)" in scan
    assert "TakeOrderedAndProject" in plans["top_k"]


def test_text_work_adds_no_shuffle(spark):
    """Only the final counts are exchanged."""
    index = SearchIndex.build(spark.createDataFrame(ROWS, SCHEMA), spec("text_ws"))
    assert "Exchange" not in plan(index.postings())
    assert "Exchange" not in plan(search(index, keys="foo bar", scoring=None).hits)
    assert plan(search(index, keys="foo bar").total).count("Exchange") == 1
    # scores add the two collection counts, as subqueries; hits without a limit are sorted by score
    assert plan(search(index, keys="foo bar").hits).count("Exchange SinglePartition") == 2


def test_one_shuffle_serves_all_facets(spark):
    index = SearchIndex.build(spark.createDataFrame(ROWS, SCHEMA), spec("text_ws"))
    base = plan(index.docs).count("Exchange")
    facets = (Facet("type", limit=0), Facet("category", limit=0), Facet("keywords", limit=0, min_count=0))
    text = plan(search(index, facets=facets, where=where_all(Condition("id", 4, "<"))).facets)
    assert text.count("Exchange") == base + 1
    grouped = plan(search(index, grouping=Grouping(("type",))).groups)
    assert "WindowGroupLimit" in grouped
