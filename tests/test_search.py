"""Requests beyond the fixture's assertions: sorts, groups, similarity, suggestions, hooks."""

import math
from dataclasses import replace

import pytest
from fixture import ROWS, SCHEMA, spec
from pyspark.sql import functions as F

from gleaner import (
    Condition, Facet, FieldSpec, Group, Grouping, IndexSpec, SearchIndex, SearchRequest, Similar, every, register_type, search,
    some, where_all, where_any,
)
from gleaner.functions.analysis import Analyzer, Delimiter, accent_map
from gleaner.functions.distance import jaro_winkler
from gleaner.operators.facets import facet_counts
from gleaner.operators.grouping import top_n
from gleaner.operators.suggest import autocomplete, batch_candidates, candidates, did_you_mean, index_dictionary, spell_suggest
from gleaner.sources.index import combined


@pytest.fixture(scope="module")
def index(spark):
    return SearchIndex.build(spark.createDataFrame(ROWS, SCHEMA), spec("text_ws"))


def ids(df):
    return [int(r.item_id) for r in df.collect()]


# -- sorts ----------------------------------------------------------------
@pytest.fixture(scope="module")
def sortable(spark):
    rows = [(1, 5, " b", True), (2, None, "A", None), (3, 1, None, False), (4, 9, "c", True)]
    fields = (FieldSpec("n", "integer"), FieldSpec("s"), FieldSpec("b", "boolean"), FieldSpec("m", "long_missing_last", source="n"))
    return SearchIndex.build(spark.createDataFrame(rows, "id int, n int, s string, b boolean"), IndexSpec("s", "id", fields))


@pytest.mark.parametrize("sort,expected", [
    (("n", "asc"), [2, 3, 1, 4]), (("n", "desc"), [4, 1, 3, 2]),
    (("m", "asc"), [3, 1, 4, 2]), (("m", "desc"), [4, 1, 3, 2]),
    (("s", "asc"), [2, 1, 4, 3]), (("s", "desc"), [4, 1, 2, 3]),
    (("b", "asc"), [3, 1, 4, 2]), (("b", "desc"), [1, 4, 3, 2]),
    (("_id", "desc"), [4, 3, 2, 1]),
])
def test_sorts(sortable, sort, expected):
    assert ids(search(sortable, sorts=(sort,)).hits) == expected


def test_random_sort_repeats(sortable):
    first = ids(search(sortable, sorts=(("_random", "asc"),), seed=7).hits)
    again = ids(search(replace(sortable, docs=sortable.docs.repartition(3)), sorts=(("_random", "asc"),), seed=7).hits)
    other = [ids(search(sortable, sorts=(("_random", "asc"),), seed=s).hits) for s in range(8, 14)]
    assert first == again and any(o != first for o in other)


def test_pages(index):
    assert ids(search(index, sorts=(("id", "asc"),), offset=1, limit=2).hits) == [2, 3]


# -- scores ---------------------------------------------------------------
def test_tfidf_by_hand(index):
    """Without norms: sqrt(tf) * idf^2, the name field counts five times."""
    scores = {int(r.item_id): r.score for r in search(index, keys="test").hits.collect()}

    def idf2(df):
        return (1 + math.log(5 / (df + 1))) ** 2

    body = idf2(4)
    assert scores[1] == pytest.approx(body, abs=1e-6)
    assert scores[4] == pytest.approx(math.sqrt(2) * body, abs=1e-6)
    assert scores[2] == pytest.approx(max(5 * idf2(1), body), abs=1e-6)
    assert ids(search(index, keys="test", limit=2).hits) == [2, 4]
    boosted = {int(r.item_id): r.score for r in search(index, keys="test", boosts={"body": 10.0}).hits.collect()}
    assert boosted[1] == pytest.approx(10 * body, abs=1e-6)


def test_norms_switch(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a")], "id int, t string")
    flat = SearchIndex.build(docs, IndexSpec("i", "id", (FieldSpec("t", "text_ws"),)))
    normed = SearchIndex.build(docs, IndexSpec("i", "id", (FieldSpec("t", "text_ws", norms=True),)))
    assert len({r.score for r in search(flat, keys="a").hits.collect()}) == 1
    one = {r.item_id: r.score for r in search(normed, keys="a").hits.collect()}
    assert one["2"] == pytest.approx(2 * one["1"], abs=1e-5)


def test_external_rank_factor(spark, index):
    plain = {r.item_id: r.score for r in search(index, keys="test").hits.collect()}
    ranks = spark.createDataFrame([("local-fixture-1", 3.0)], "doc_key string, rank double")
    ranked = {r.item_id: r.score for r in search(index, keys="test", ranks=ranks).hits.collect()}
    assert ranked["1"] == pytest.approx(3 * plain["1"]) and ranked["4"] == plain["4"]


def test_elevation(spark, index):
    listed = spark.createDataFrame(
        [("Test ", "local-fixture-3", 0), ("test", "local-fixture-9", 1), ("other", "local-fixture-4", 0)],
        "query_text string, doc_key string, rank int")
    plain = ids(search(index, keys="test", limit=10).hits)
    raised = ids(search(index, keys="test", limit=10, elevation=listed).hits)
    assert raised == [3] + [i for i in plain if i != 3]


# -- facets and groups ----------------------------------------------------
def facet(index, *facets, **options):
    rows = search(index, facets=facets, **options).facets.collect()
    return {(r.facet, r.value): r["count"] for r in rows}


def test_or_facet_ignores_its_own_filter(spark):
    rows = [(1, "red", "s"), (2, "red", "m"), (3, "blue", "s"), (4, "blue", "l")]
    index = SearchIndex.build(
        spark.createDataFrame(rows, "id int, color string, size string"),
        IndexSpec("i", "id", (FieldSpec("color"), FieldSpec("size"))))
    where = where_all(where_any(Condition("color", "red"), tags=("facet:color",)))
    got = facet(index, Facet("color", operator="or"), Facet("size"), where=where)
    assert got == {("color", '"red"'): 2, ("color", '"blue"'): 2, ("size", '"s"'): 1, ("size", '"m"'): 1}
    assert ids(search(index, where=where, sorts=(("_id", "asc"),), facets=(Facet("color", operator="or"),)).hits) == [1, 2]
    # as an AND facet the tagged filter counts like any other
    assert facet(index, Facet("color"), where=where) == {("color", '"red"'): 2}


def test_facet_sums_equal_the_total(index):
    total = search(index, keys="test").total.first().total
    assert sum(facet(index, Facet("type", limit=0, missing=True), keys="test").values()) == total


def test_facet_limit_keeps_the_larger(index):
    assert facet(index, Facet("keywords", limit=2)) == {("keywords", '"grape"'): 3, ("keywords", '"orange"'): 3}


def test_two_facets_on_one_field_keep_their_names(spark, index):
    got = facet_counts(index.docs, [Facet("type", name="a", limit=1), Facet("type", name="b")], index.spec)
    assert sorted((r.facet, r.value, r["count"]) for r in got.collect()) == [
        ("a", '"item"', 3), ("b", '"article"', 2), ("b", '"item"', 3)]


def test_groups(index):
    result = search(index, grouping=Grouping(("type",), limit=2, sort=(("id", "desc"),)))
    rows = {(r.group_value, r["rank"], int(r.item_id)) for r in result.groups.collect()}
    assert rows == {("item", 1, 3), ("item", 2, 2), ("article", 1, 5), ("article", 2, 4)}
    assert [tuple(r) for r in result.group_total.collect()] == [("type", 2)]
    missing = search(index, grouping=Grouping(("category",)))
    assert missing.group_total.first().groups == 3  # rows without a category are one group


@pytest.mark.parametrize("field", ["name", "keywords"])
def test_no_grouping_by_text_or_lists(index, field):
    with pytest.raises(ValueError):
        search(index, grouping=Grouping((field,))).groups


def test_group_facets(index):
    assert facet(index, Facet("category"), grouping=Grouping(("type",), truncate=True)) == {
        ("category", '"item_category"'): 1, ("category", '"article_category"'): 1}
    assert facet(index, Facet("keywords"), grouping=Grouping(("type",), facet=True))[("keywords", '"grape"')] == 2


def test_top_n_above_the_pruning_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    got = top_n(df, ["k"], [F.col("id").desc()], 1500)
    assert got.groupBy("k").agg(F.min("id"), F.count("*")).orderBy("k").collect() == [(0, 2000, 1500), (1, 2001, 1500)]


# -- similarity -----------------------------------------------------------
def test_similar_never_returns_its_source(index):
    for i in range(1, 6):
        assert i not in ids(search(index, similar=Similar(str(i), ("name", "body"))).hits)


def test_similar_by_hand(index):
    rows = {int(r.item_id) for r in search(index, similar=Similar("3", ("name", "keywords"))).hits.collect()}
    assert rows == {1, 5}  # only "bar" in the name; row 3 has no keywords
    rows = {int(r.item_id) for r in search(index, similar=Similar("4", ("keywords",))).hits.collect()}
    assert rows == {2, 5}
    filtered = search(index, similar=Similar("4", ("keywords",)), where=Condition("type", "item"), keys="ignored")
    assert ids(filtered.hits) == [2]
    assert search(index, similar=Similar("4", ("keywords",))).total.first().total == 2


# -- suggestions ----------------------------------------------------------
def test_autocomplete(index):
    rows = autocomplete(index, "ba", SearchRequest(fields=("name", "body"))).collect()
    first = [(r.term, r.results, r.suffix) for r in rows if r["pass"] == 1]
    assert sorted(first) == [("bar", 3, "r"), ("baz", 3, "z")]
    typed = autocomplete(index, "ba", SearchRequest(keys="bar", fields=("name",)), suggest_words=False)
    assert {r.term for r in typed.collect()} == {"baz"}


def test_next_words(index):
    rows = autocomplete(index, "foo", SearchRequest(fields=("name",))).collect()
    # every document that matches the fragment holds it: too frequent to be offered
    assert {(r["pass"], r.term, r.suffix) for r in rows if r["pass"] == 2} == {
        (2, "bar", " bar"), (2, "baz", " baz"), (2, "test", " test"), (2, "smileὠ1", " smileὠ1")}


def test_correction_comes_first(index):
    rows = autocomplete(index, "smille", dictionary=index_dictionary(index).union(
        index_dictionary(index).selectExpr("'smile'", "1L").limit(1))).collect()
    assert [(r["pass"], r.term) for r in rows] == [(0, "smile")]


def test_spelling(spark):
    words = spark.createDataFrame(
        [("apple", 5), ("apply", 9), ("maple", 1), ("orange", 3), ("élan", 2)], "term string, df bigint")
    got = {(r.word, r.suggestion, r.distance) for r in spell_suggest(words, "appel orange zzzzzz").collect()}
    assert got == {("appel", "apply", 2)}  # "apple" is as near but less frequent
    best = spell_suggest(words, "appl").first()
    assert (best.suggestion, best.distance) == ("apply", 1)  # same distance, more frequent
    assert spell_suggest(words, "appl", threshold=0.5, documents=F.lit(10)).first().suggestion == "apply"
    assert spell_suggest(words, "maplle").first().suggestion == "maple"  # nearest
    assert spell_suggest(words, "maplle", by_frequency=True).first().suggestion == "apple"  # most frequent
    assert did_you_mean(spell_suggest(words, "An Appl"), "An Appl").first().user_input == "An apply"
    assert did_you_mean(spell_suggest(words, "orange"), "orange").count() == 0
    assert spell_suggest(words, "an xy").count() == 0  # shorter than any dictionary word


def test_candidates_miss_nothing(spark):
    """Against brute force: every pair of words within two edits is found."""
    import itertools

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    vocab = ["".join(p) for n in (3, 4, 5) for p in itertools.product("ab", repeat=n)]
    words = spark.createDataFrame([(w, 1) for w in vocab], "term string, df bigint")
    for typed in ("abab", "bbb", "cab"):
        got = {r.term for r in candidates(words, [typed]).collect()}
        assert got == {w for w in vocab if 1 <= distance(w, typed) <= 2}


def test_excerpts_of_a_page(spark):
    index = SearchIndex.build(
        spark.createDataFrame([(1, "Cats and dogs."), (2, "a cat"), (3, "birds")], "id int, t string"),
        IndexSpec("i", "id", (FieldSpec("t", "text"),)))
    rows = {r.item_id: r for r in search(index, keys="cat", limit=5).excerpts("t").collect()}
    assert {k: r.highlight for k, r in rows.items()} == {
        "1": "<strong>Cats</strong> and dogs.", "2": "a <strong>cat</strong>"}
    assert rows["1"].excerpt == "<strong>Cats</strong> and dogs"
    plain = {r.item_id: (r.excerpt, r.highlight) for r in search(index).excerpts("t").collect()}
    assert plain["3"] == (None, "birds")


def test_highlights_of_all_fields(spark):
    """Punctuated, mapped, split and pre-tokenized words, several values, nulls; each field keeps its shape."""
    accents = Analyzer(char_map=accent_map(), delimiter=Delimiter(), stopwords=("the",), stemmer="english")
    fields = (
        FieldSpec("a", "text_ws"), FieldSpec("b", "text_unstemmed", multi=True), FieldSpec("c", "text", analyzer=accents),
        FieldSpec("d", "tokens"), FieldSpec("e", "text_de"), FieldSpec("n", "integer"),
    )
    data = [
        (1, "the wi-fi router, Wi-Fi", ["a wi-fi card", "none", "WiFi"], "Wí-Fí straßen; the wifi", [("wi-fi", 2.0), ("fi", 1.0)], "der WiFi Router", 3),
        (2, None, None, "wi-fi", None, None, None), (3, "nothing", ["x"], "y", [("z", 1.0)], "w", 1),
    ]
    schema = "id int, a string, b array<string>, c string, d array<struct<value:string,score:double>>, e string, n int"
    index = SearchIndex.build(spark.createDataFrame(data, schema), IndexSpec("i", "id", fields))
    rows = {r.item_id: r for r in search(index, keys="wi-fi").excerpts().collect()}
    assert sorted(rows) == ["1", "2"]
    one = rows["1"]
    hit = "<strong>{}</strong>".format
    assert one.a == f"the {hit('wi-fi')} router, {hit('Wi-Fi')}"
    assert one.b[0] == f"a {hit('wi')}-{hit('fi')} card" and one.b[1] == "none"
    assert one.c.startswith(f"{hit('Wí-Fí')} straßen; the ")
    assert one.d == [hit("wi-fi"), "fi"]
    assert (rows["2"].a, rows["2"].b, rows["2"].c, rows["2"].d) == (None, None, hit("wi-fi"), None)
    assert one.excerpt.count("…") == 2 and rows["2"].excerpt == hit("wi-fi")
    strassen = search(index, keys="strassen", fields=("c",)).excerpts().collect()
    assert [r.c for r in strassen] == [f"Wí-Fí {hit('straßen')}; the wifi"]
    assert [r.excerpt for r in search(index, keys="fi", fields=("a",)).excerpts().collect()] == []
    everything = {r.item_id: r for r in search(index).excerpts().collect()}
    assert everything["1"].a == data[0][1] and everything["1"].excerpt is None


def test_excerpt_of_a_punctuated_word(spark):
    index = SearchIndex.build(
        spark.createDataFrame([(1, "x " * 60 + "my wi-fi, here " + "y " * 60)], "id int, t string"),
        IndexSpec("i", "id", (FieldSpec("t", "text_ws"),)))
    assert search(index, keys="wi-fi,").excerpts("t").first().excerpt.count("<strong>wi-fi,</strong>") == 1


# -- specs, flags and hooks -----------------------------------------------
def test_flags(spark):
    fields = (FieldSpec("a"), FieldSpec("b", "string_unindexed"), FieldSpec("c", "access", multi=True), FieldSpec("t", "text", indexed=False))
    index = SearchIndex.build(spark.createDataFrame([(1, "x", "y", [1], "z")], "id int, a string, b string, c array<int>, t string"), IndexSpec("i", "id", fields))
    shown = search(index, retrieve_all=True).hits.columns
    assert "a" in shown and "b" in shown and "c" not in shown and not any(c.startswith("sort__") for c in shown)
    with pytest.raises(ValueError):
        search(index, where=Condition("b", "y")).hits
    with pytest.raises(ValueError):
        search(index, keys="z", fields=("t",))
    with pytest.raises(ValueError):
        search(index, where=Condition("nope", 1)).hits
    with pytest.raises(ValueError):
        Condition("a", 1, "like")


def test_rebuild_detection():
    one = spec("text")
    louder = replace(one, fields=tuple(replace(f, boost=9.0) for f in one.fields))
    assert not one.needs_rebuild(louder)
    assert one.needs_rebuild(spec("text_ws"))
    assert one.needs_rebuild(replace(one, fields=one.fields[:-1]))
    with pytest.raises(ValueError):
        IndexSpec("i", "id", (FieldSpec("doc_key"),))
    assert replace(one, prefix="p_", index_prefix="q_").index_id == "p_q_fixture"


def test_hooks_and_types(spark):
    from pyspark.sql import types as T

    register_type("loud", T.StringType(), analyzer="text_ws")
    made = IndexSpec(
        "i", "id", (FieldSpec("t", "loud"),),
        on_documents=lambda docs, s: docs.withColumn("t", F.concat("t", F.lit(" added"))))
    index = SearchIndex.build(spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string"), made)
    assert sorted(ids(search(index, keys="added").hits)) == [1, 2]
    request = SearchRequest(
        keys="x", on_request=lambda r: replace(r, keys=some("x", "y")),
        on_hits=lambda hits: hits.withColumn("extra", F.lit(1)))
    rows = search(index, request).hits.collect()
    assert len(rows) == 2 and rows[0].extra == 1


def test_empty_trees(index):
    assert len(ids(search(index, keys=every("", every())).hits)) == 5
    assert len(ids(search(index, where=where_all(Condition("type", ""))).hits)) == 5
    assert ids(search(index, keys="0").hits) == []


# -- facets under grouping and similarity, several indexes, copies ----------
def test_or_facets_under_truncation_and_similarity(spark):
    data = [(1, "a b", "red", "x", 1), (2, "a", "red", "x", 2), (3, "a", "blue", "y", 3), (4, "a c", "blue", "x", 9), (5, "b", "green", "z", 4)]
    fields = (FieldSpec("t", "text_ws"), FieldSpec("color"), FieldSpec("shape"), FieldSpec("n", "integer"))
    index = SearchIndex.build(spark.createDataFrame(data, "id int, t string, color string, shape string, n int"), IndexSpec("i", "id", fields))
    tagged = Group((Condition("color", "red"),), tags=("facet:color",))
    facets = (Facet("color", operator="or"), Facet("shape"))

    def counts(request):
        return {(r["facet"], r["value"].strip('"')): r["count"] for r in search(index, request).facets.collect()}

    truncated = SearchRequest(keys="a", where=tagged, facets=facets, grouping=Grouping(("shape",), truncate=True, sort=(("n", "desc"),)))
    # heads of all colors: 4 (shape x) and 3 (shape y); of the red ones: 2
    assert counts(truncated) == {("color", "blue"): 2, ("shape", "x"): 1}
    alike = SearchRequest(similar=Similar("1", ("t",)), where=tagged, facets=facets)
    assert counts(alike) == {("color", "red"): 1, ("color", "blue"): 2, ("color", "green"): 1, ("shape", "x"): 1}
    assert search(index, alike).total.first().total == 1


def test_approximate_group_count(spark):
    data = [(i, f"g{i % 5000}" if i % 7 else None, i % 3) for i in range(20_000)]
    index = SearchIndex.build(
        spark.createDataFrame(data, "id int, g string, h int"), IndexSpec("i", "id", (FieldSpec("g"), FieldSpec("h", "integer"))))
    exact = {r[0]: r[1] for r in search(index, grouping=Grouping(("g", "h"))).group_total.collect()}
    near = {r[0]: r[1] for r in search(index, grouping=Grouping(("g", "h"), approximate=True)).group_total.collect()}
    assert exact == {"g": 5001, "h": 3} and near["h"] == 3 and abs(near["g"] - 5001) <= 0.03 * 5001
    nothing = search(index, where=Condition("h", 9), grouping=Grouping(("g",), approximate=True)).group_total.collect()
    assert [tuple(r) for r in nothing] == [("g", 0)]


def test_copies(spark):
    fields = (
        FieldSpec("all_text", "text", multi=True, copies=("names", "n_*")), FieldSpec("n_a"), FieldSpec("n_b", multi=True),
        FieldSpec("number", "integer"), FieldSpec("names", "text_ws", multi=True, copies=("n_a", "number")), FieldSpec("one", copies=("n_*",)),
    )
    spec_ = IndexSpec("i", "id", fields)
    data = [(1, "Red Cats", ["x", None], 7), (2, None, None, None)]
    index = SearchIndex.build(spark.createDataFrame(data, "id int, n_a string, n_b array<string>, number int"), spec_)
    rows = {r.item_id: r for r in index.docs.collect()}
    assert rows["1"].all_text == ["Red Cats", "x", "Red Cats", "7"] and rows["1"].names == ["Red Cats", "7"] and rows["1"].one == "Red Cats"
    assert rows["2"].all_text is None and rows["2"].one is None
    assert search(index, keys="cat", fields=("all_text",)).total.first().total == 1  # each target has a chain of its own
    assert search(index, keys="cat", fields=("names",)).total.first().total == 0
    assert spec_.needs_rebuild(IndexSpec("i", "id", (*fields[:5], FieldSpec("one"))))
    with pytest.raises(ValueError, match="circle"):
        IndexSpec("i", "id", (FieldSpec("a", copies=("b",)), FieldSpec("b", copies=("a",)))).copy_order()


def test_combined_indexes(spark):
    a = SearchIndex.build(spark.createDataFrame([(1, "x y", 1)], "id int, t string, n int"), IndexSpec("a", "id", (FieldSpec("t", "text_ws"), FieldSpec("n", "integer"))))
    b = SearchIndex.build(spark.createDataFrame([(1, "x", "q")], "id int, t string, s string"), IndexSpec("b", "id", (FieldSpec("t", "text_ws"), FieldSpec("s"))))
    both = combined([a, b])
    hits = search(both, keys="x", retrieve_all=True).hits.collect()
    assert sorted((r.index_id, r.item_id, r.n, r.s) for r in hits) == [("a", "1", 1, None), ("b", "1", None, "q")]
    assert search(both, keys="x", index_ids=("b",)).total.first().total == 1
    with pytest.raises(ValueError, match="kinds"):
        combined([a, SearchIndex.build(a.docs.select("item_id", "n"), IndexSpec("c", "item_id", (FieldSpec("n"),)))])


# -- corrections ------------------------------------------------------------
def test_deletion_keys_meet(spark):
    """All pairs within two edits, by keys, against the distance itself."""
    import itertools

    words = ["".join(w) for n in range(5) for w in itertools.product("abé", repeat=n)][:70]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    dictionary = frame.select(F.col("word").alias("term"), F.lit(1).alias("df"))
    want = frame.crossJoin(dictionary).where(F.levenshtein("word", "term").between(1, 2)).select("word", "term")
    got = batch_candidates(dictionary, frame.union(spark.createDataFrame([(None,), ("ab",)], "word string")))
    assert sorted(map(tuple, got.select("word", "term").collect())) == sorted(map(tuple, want.collect()))


def test_jaro_winkler(spark):
    pairs = [("martha", "marhta", 0.961111), ("dixon", "dicksonx", 0.813333), ("dwayne", "duane", 0.84), ("abc", "xyz", 0.0),
             ("", "", 1.0), ("a", "", 0.0), ("same", "same", 1.0), ("été", "étè", 0.822222), (None, "a", None)]
    rows = spark.createDataFrame([p[:2] for p in pairs], "x string, y string").select(F.round(jaro_winkler(F.col("x"), F.col("y")), 6).alias("s")).collect()
    assert [r.s for r in rows] == [p[2] for p in pairs]


def test_a_stemmer_registered_anew(spark):
    from gleaner.functions.stemming import STEMMERS, register_stemmer, stem_terms

    frame = spark.createDataFrame([(["walking"],)], "w array<string>")
    try:
        for cut in (3, 1):
            register_stemmer("cut", lambda w, n=cut: w[:-n])
            assert frame.select(stem_terms(F.col("w"), "cut").alias("s")).first().s == ["walking"[:-cut]]
    finally:
        STEMMERS.pop("cut")
