import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from gleaner import FieldSpec, IndexSpec, SearchIndex, every, search
from gleaner.functions.analysis import Analyzer, Delimiter, accent_map, analyzer, edge_ngrams, fold_chars, group_terms
from gleaner.functions.stemming import register_stemmer, stem_english, stem_german, stem_terms
from gleaner.sources.index import doc_frequency, field_statistics, top_terms, with_tokens

# Pairs from the published description of the algorithm.
STEMS = {
    "running": "run", "cats": "cat", "caresses": "caress", "ties": "tie", "cries": "cri", "gas": "gas",
    "this": "this", "gaps": "gap", "kiwis": "kiwi", "luxuriate": "luxuri", "hopping": "hop", "hoping": "hope",
    "happy": "happi", "by": "by", "say": "say", "enjoy": "enjoy", "consign": "consign", "consigned": "consign",
    "consigning": "consign", "consistency": "consist", "consolation": "consol", "consolatory": "consolatori",
    "knightly": "knight", "knots": "knot", "generously": "generous", "generate": "generat", "general": "general",
    "skies": "sky", "dying": "die", "early": "earli", "proceed": "proceed", "agreed": "agre", "feed": "feed",
    "relational": "relat", "rational": "ration", "controlling": "control", "communication": "communic",
    "arsenal": "arsenal", "possibly": "possibl", "goodness": "good", "adjustment": "adjust", "fishing": "fish",
}


@pytest.mark.parametrize("word", STEMS)
def test_english_stems(word):
    assert stem_english(word) == STEMS[word]


def test_german_stems():
    assert stem_german("häuser") == stem_german("haus") == "haus"
    assert stem_german("kinder") == stem_german("kindern") == "kind"


def terms(spark, chain, text):
    df = spark.createDataFrame([(text,)], "t string").select(chain.tokens(F.col("t")).alias("tok"))
    if chain.stemmer:
        df = df.select(chain.stemmed(F.col("tok")).alias("tok"))
    return [(x.term, x.pos) for x in df.first().tok]


def test_word_delimiter(spark):
    chain = analyzer("text_words")

    def words(text):
        return {t for t, _ in terms(spark, chain, text)}

    assert words("Wi-Fi") == {"wi-fi", "wi", "fi", "wifi"}
    assert words("500-42") == {"500-42", "500", "42", "50042"}
    assert words("SD500") == {"sd500", "sd", "500"}
    assert words("John's") == {"john's", "john"}
    assert words("a-b-1-2") == {"a-b-1-2", "ab", "12"}  # one-letter parts are too short
    assert words("&amp; --- x") == {"&amp;", "---"}
    assert words("(fish), 's 42;") == {"(fish),", "fish", "'s", "42;", "42"}
    assert words("smileὠ1") == {"smileὠ1", "smileὠ"}


def test_positions_after_a_split_token(spark):
    assert terms(spark, analyzer("text_words"), "new Wi-Fi card") == [
        ("new", 0), ("wi-fi", 1), ("wi", 1), ("fi", 2), ("wifi", 2), ("card", 3)]


def test_stop_words_leave_gaps(spark):
    chain = Analyzer(stopwords=("The",))
    assert terms(spark, chain, "the cat the dog") == [("cat", 1), ("dog", 3)]
    chain = Analyzer(stopwords=("the",), delimiter=Delimiter())
    assert terms(spark, chain, "The cat-dog THE end") == [
        ("cat-dog", 1), ("cat", 1), ("dog", 2), ("catdog", 2), ("end", 4)]


def test_case_split(spark):
    chain = Analyzer(delimiter=Delimiter(split_case=True))
    assert {t for t, _ in terms(spark, chain, "PowerShot")} == {"powershot", "power", "shot"}
    chain = Analyzer(delimiter=Delimiter())
    assert {t for t, _ in terms(spark, chain, "PowerShot")} == {"powershot"}


def test_stems_at_one_position_are_merged(spark):
    assert terms(spark, analyzer("text"), "Runner's cats") == [("runner", 0), ("cat", 1)]


def test_edge_ngrams(spark):
    df = spark.createDataFrame([("ABcd",), ("a",), ("ab",), ("x" * 30,)], "t string").select(
        edge_ngrams(F.col("t")).alias("g"))
    rows = [r.g for r in df.collect()]
    assert rows[:3] == [["ab", "abc", "abcd"], [], ["ab"]]
    assert [len(g) for g in rows[3]] == list(range(2, 26))


def test_value_gap(spark):
    spec = IndexSpec("i", "id", (FieldSpec("t", "text_ws", multi=True),))
    index = SearchIndex.build(spark.createDataFrame([(1, ["a b", "c"])], "id int, t array<string>"), spec)
    row = with_tokens(index.docs, spec, ["t"]).first()
    assert [(x.term, x.pos) for x in row._tok_t] == [("a", 0), ("b", 1), ("c", 102)]
    assert search(index, keys=every("a b")).hits.count() == 1
    assert search(index, keys=every("b c")).hits.count() == 0


@pytest.mark.parametrize("query,matches", [("wifi", True), ("wi fi", True), ("Wi-Fi", True), ("fi wi", False)])
def test_delimited_queries(spark, query, matches):
    spec = IndexSpec("i", "id", (FieldSpec("t", "text"),))
    index = SearchIndex.build(spark.createDataFrame([(1, "my Wi-Fi card")], "id int, t string"), spec)
    assert search(index, keys=every(query)).hits.count() == int(matches)


def test_synonyms_apply_to_queries_only(spark):
    chain = Analyzer(synonyms={"car": ("Auto",)})
    spec = IndexSpec("i", "id", (FieldSpec("t", "text_ws", analyzer=chain),))
    index = SearchIndex.build(
        spark.createDataFrame([(1, "a car"), (2, "an auto"), (3, "a bus")], "id int, t string"), spec)
    assert sorted(r.item_id for r in search(index, keys="car").hits.collect()) == ["1", "2"]
    assert [r.item_id for r in search(index, keys="auto").hits.collect()] == ["2"]


def test_key_of_stop_words_only_matches_nothing(spark):
    spec = IndexSpec("i", "id", (FieldSpec("t", "text_ws", analyzer=Analyzer(stopwords=("the",))),))
    index = SearchIndex.build(spark.createDataFrame([(1, "the end")], "id int, t string"), spec)
    assert search(index, keys="the").hits.count() == 0
    assert search(index, keys=every("end")).hits.count() == 1
    assert search(index, keys="the end").hits.count() == 1  # the empty key is ignored
    assert search(index, keys="the dog").hits.count() == 0


def test_accent_folding(spark):
    df = spark.createDataFrame([("Çà et là, Straße, œuvre, Łódź",)], "t string")
    assert df.select(fold_chars(F.col("t"), accent_map())).first()[0] == "Ca et la, Strasse, oeuvre, Lodz"


def test_group_terms_matches_brute_force(spark):
    text = "b a b c a b"
    df = spark.createDataFrame([(text,), ("",)], "t string")
    rows = df.select(group_terms(analyzer("text_ws").tokens(F.col("t"))).alias("g")).collect()
    words = text.split()
    expected = {w: [i for i, x in enumerate(words) if x == w] for w in words}
    assert {x.term: x.positions for x in rows[0].g} == expected
    assert rows[1].g == []


def test_plug_in_stemmer(spark):
    register_stemmer("first3", lambda w: w[:3])
    df = spark.createDataFrame([(["abcdef", None, "xy"],), (None,)], "t array<string>")
    out = [r[0] for r in df.select(stem_terms(F.col("t"), "first3")).collect()]
    assert out == [["abc", None, "xy"], []]


def test_statistics(spark):
    spec = IndexSpec("i", "id", (FieldSpec("t", "text_ws"), FieldSpec("u", "text_ws")))
    index = SearchIndex.build(
        spark.createDataFrame([(1, "a b a", "x"), (2, "a", None)], "id int, t string, u string"), spec)
    postings = index.postings()
    assert {(r.field, r.term, r.df) for r in doc_frequency(postings).collect()} == {
        ("t", "a", 2), ("t", "b", 1), ("u", "x", 1)}
    assert {(r.field, r.docs, r.terms) for r in field_statistics(postings).collect()} == {("t", 2, 2), ("u", 1, 1)}
    assert {(r.field, r.term) for r in top_terms(postings, 1).collect()} == {("t", "a"), ("u", "x")}


def test_documents_without_a_language_take_the_default_chain(spark, tmp_path):
    rows = [(1, "häuser", "de"), (2, "running", "en"), (3, "running", None)]
    spark.createDataFrame([(k, t, lang, "s", len(t)) for k, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    found = {(r.chain, r.term): r.df for r in queries()["analyze_by_lang"](spark, str(tmp_path)).where("field = 'text'").collect()}
    assert found == {("text_de", "haus"): 1, ("text", "run"): 2}


TRICKY = (
    "this", "th-is.", "THIS!", "this's", "th's-is x", "thís", "(th.i.s)", "t his", "'this", "thistle", "this-that", "abilities", "able",
    "abl", "ably", "hopping", "hope", "Hopes,", "wi-fi", "wi fi", "dying", "dies", "skies", "sky", "ski", "relational", "relate", "r2d2", "22-33", "2233",
)


@pytest.mark.parametrize("name", ["text", "text_words", "text_unstemmed", "text_de", "text_word"])
def test_a_text_with_a_term_may_hold_it(spark, name):
    """The cheap test of a chain holds for every text that has the term; the tokens left for counting keep the term."""

    from gleaner.sources.index import SearchIndex, build_documents

    chain = FieldSpec("t", name).chain
    spec = IndexSpec("t", "id", (FieldSpec("t", name),))
    docs = build_documents(spark.createDataFrame(list(enumerate(TRICKY)), "id int, t string"), spec)
    index = SearchIndex(spec, docs)
    terms = sorted({r.term for r in index.postings().collect()})
    has = {(r.doc_key, r.term) for r in index.postings().collect()}
    flags = docs.select("doc_key", F.array(*[F.when(chain.may_hold(F.col("t"), t), F.lit(t)) for t in terms]).alias("f")).collect()
    may = {(r.doc_key, t) for r in flags for t in r.f if t is not None}
    assert has <= may
    if chain.stemmer == "english":
        assert not {(k, t) for k, t in may if t == "this"} - {(f"local-t-{i}", "this") for i in range(11)}
        from gleaner.sources.index import Lookup

        wanted = ["this", "abl", "hop", "wifi", "sky", "ski", "die"]
        found = index.with_hits({"t": Lookup(wanted, {w: [[i]] for i, w in enumerate(wanted)})})
        hits = {(r.doc_key, w) for r in found.collect() for i, w in enumerate(wanted) if r[f"_tf_t_{i}"] > 0}
        assert hits == {(k, t) for k, t in has if t in wanted}


def test_a_word_holds_a_root_of_its_stem():
    """All endings of the steps, two in a row, behind heads of all kinds."""
    import itertools

    from gleaner.functions.stemming import _IRREGULAR, _STEP2, _STEP3, _STEP4, english_root, stem_english

    ends = ["", *_STEP2, *_STEP3, *_STEP4, "eed", "eedly", "ed", "edly", "ing", "ingly", "s", "es", "ies", "ied", "'s", "'", "y", "ly", "e", "bly", "ility"]
    heads = ["", "a", "b", "hab", "fea", "poss", "prob", "gener", "arsen", "cry", "say", "abl", "at", "iz", "hopp", "fall", "no", "'"]
    for word in [*_IRREGULAR, *(h + a + b for h, a, b in itertools.product(heads, ends, ends))]:
        assert any(root in word for root in english_root(stem_english(word))), word


def test_stemmed_documents_without_the_words_are_not_analyzed(spark):
    """Counts and hits of stemmed keywords analyze only documents that may hold them."""
    from gleaner import search
    from gleaner.sources.index import SearchIndex

    rows = spark.createDataFrame([(1, "from this"), (2, "other words"), (3, "th-is and from")], "id int, t string")
    hits = search(SearchIndex.build(rows, IndexSpec("t", "id", (FieldSpec("t", "text"),))), keys="from this").hits
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and plan.count("from") >= 2 and plan.count("Contains(") >= 2, plan
    assert {r.item_id for r in hits.collect()} == {"1", "3"}
