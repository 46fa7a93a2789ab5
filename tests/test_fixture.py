"""The five-row fixture: boolean keywords, null-safe filters and facets."""

import pytest
from fixture import ROWS, SCHEMA, spec
from pyspark.sql import functions as F

from gleaner import (
    Condition, Facet, IndexStore, SearchIndex, every, none, not_every, search, some, where_all, where_any,
)
from gleaner.sources.index import delete_all, delete_index

@pytest.fixture(scope="module", params=["text", "text_ws", "stored"])
def index(spark, request, tmp_path_factory):
    """Stemmed and plain text analyzed on the fly, and an index read back from storage."""
    built = SearchIndex.build(spark.createDataFrame(ROWS, SCHEMA), spec(request.param.replace("stored", "text")))
    if request.param != "stored":
        return built
    store = IndexStore(spark, str(tmp_path_factory.mktemp("store")), built.spec)
    store.append(built.docs.withColumns({"version": F.lit(1), "op": F.lit("U")}))
    return store.index()


def ids(index, **options):
    options.setdefault("sorts", (("id", "asc"),))
    return [int(r.item_id) for r in search(index, **options).hits.collect()]


def facet(index, f, **options):
    rows = search(index, facets=(f,), **options).facets.collect()
    return {r.value: r["count"] for r in rows}


KEYWORDS = [
    ("test", None, [1, 2, 3, 4]),
    (some("foo", "test"), ("name",), [1, 2, 4]),
    (some("foo", "test"), None, [1, 2, 3, 4, 5]),
    (some("foo", "test", every("bar", "baz")), ("name",), [1, 2, 4, 5]),
    (some(every("foo", "test"), every("bar", "baz")), None, [1, 2, 4, 5]),
    (not_every("foo", "bar"), None, [3, 4]),
    (none("foo", "baz"), None, [3]),
    (every("test", not_every("foo", "bar")), None, [3, 4]),
    ("test foo", None, [1, 2, 4]),
    ("smileὠ1", None, [1]),
    (None, None, [1, 2, 3, 4, 5]),
    (every("foo baz"), None, [4]),
    (every("bar baz"), None, [1, 5]),
    (every("", "test"), None, [1, 2, 3, 4]),
]


@pytest.mark.parametrize("case", range(len(KEYWORDS)))
def test_keywords(index, case):
    keys, fields, expected = KEYWORDS[case]
    assert ids(index, keys=keys, fields=fields) == expected


C = Condition
FILTERS = [
    (where_any(C("id", 3), C("type", "article")), [3, 4, 5]),
    (where_any(C("keywords", "orange"), C("keywords", "apple")), [1, 2, 4, 5]),
    (
        where_all(
            where_any(C("keywords", "orange"), C("keywords", "strawberry")),
            where_any(C("keywords", "apple"), C("keywords", "grape")),
        ),
        [2, 4, 5],
    ),
    (
        where_any(
            where_all(C("keywords", "orange"), C("keywords", "apple")),
            where_all(C("keywords", "strawberry"), C("keywords", "grape")),
        ),
        [2, 4, 5],
    ),
    (C("category", None), [3]),
    (C("category", None, "<>"), [1, 2, 4, 5]),
    (C("keywords", None), [3]),
    (C("keywords", "grape", "<>"), [1, 3]),
    (C("category", "item_category", "<>"), [3, 4, 5]),
    (C("id", 3, "<"), [1, 2]),
    (C("id", 3, ">="), [3, 4, 5]),
    (C("type", " article "), [4, 5]),
    (C("type", ""), [1, 2, 3, 4, 5]),
    (C("body", "test case"), [1, 2]),
    (C("body", "test case", "<>"), [3, 4, 5]),
]


@pytest.mark.parametrize("case", range(len(FILTERS)))
def test_filters(index, case):
    where, expected = FILTERS[case]
    assert ids(index, where=where) == expected


def test_unknown_field(index):
    with pytest.raises(ValueError):
        search(index, where=C("nope", 1)).hits


def test_facets(index):
    f = Facet("category", limit=0, missing=True)
    assert facet(index, f) == {'"article_category"': 2, '"item_category"': 2, "!": 1}
    assert facet(index, Facet("category", limit=0)) == {'"article_category"': 2, '"item_category"': 2}
    zero = Facet("type", limit=0, min_count=0, missing=True)
    assert facet(index, zero, where=C("type", "article")) == {'"article"': 2, "!": 0, '"item"': 0}
    text = facet(index, Facet("body", limit=0), where=C("id", 5, "<>"))
    assert text == {'"test"': 4, '"case"': 3, '"bar"': 1, '"foobar"': 1}
    kw = facet(index, Facet("type", limit=0, missing=True), keys="test foo")
    assert kw == {'"item"': 2, '"article"': 1}


def test_count_only(index):
    result = search(index, keys=some("foo", "test"), limit=0)
    assert result.total.first().total == 5
    assert result.hits.collect() == []


def test_keys_and_their_negation_cover_everything(index):
    every_id = [1, 2, 3, 4, 5]
    assert sorted(ids(index, keys=every("foo", "bar")) + ids(index, keys=not_every("foo", "bar"))) == every_id


def test_clear_index(index):
    assert delete_index(index.docs, index.spec).count() == 0
    assert delete_all(index.docs).count() == 0
