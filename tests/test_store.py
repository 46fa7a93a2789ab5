"""Stored indexes: upserts, deletes, compaction, streams; same answers as without storage."""

import pytest
from fixture import ROWS, SCHEMA, spec
from pyspark.sql import functions as F

from gleaner import (
    Condition, Facet, FieldSpec, Grouping, IndexSpec, IndexStore, SearchIndex, SearchRequest, Similar, build_documents,
    every, search, some,
)
from gleaner.operators.suggest import autocomplete
from gleaner.sources.index import doc_frequency, index_statistics, latest, remaining_items, tombstones
from gleaner.streaming.ingest import read_changes, upsert_stream


def versioned(df, version=1, op="U"):
    return df.withColumns({"version": F.lit(version).cast("bigint"), "op": F.lit(op)})


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    fixture = spec("text_ws")
    fixture = IndexSpec(fixture.name, fixture.key, tuple(
        FieldSpec(f.name, f.type, multi=f.multi, boost=f.boost, norms=True if f.is_text else None) for f in fixture.fields))
    index = SearchIndex.build(spark.createDataFrame(ROWS, SCHEMA), fixture)
    store = IndexStore(spark, str(tmp_path_factory.mktemp("store")), fixture)
    store.append(versioned(index.docs))
    return index, store.index()


@pytest.mark.parametrize("request_", [
    SearchRequest(keys="test foo"), SearchRequest(keys=some("foo", "bar baz")),
    SearchRequest(keys=some("foo", "test"), scoring="bm25"), SearchRequest(keys=every("test case"), fields=("body",)),
    SearchRequest(similar=Similar("1", ("name", "body", "keywords"))),
    SearchRequest(keys="test", where=Condition("body", "test case", "<>")),
])
def test_same_scores(both, request_):
    derived, stored = both
    assert rows(search(derived, request_).hits) == rows(search(stored, request_).hits)
    assert rows(search(derived, request_).total) == rows(search(stored, request_).total)


def test_same_facets_and_completions(both):
    derived, stored = both
    request = SearchRequest(keys="test", facets=(Facet("body", limit=0), Facet("type")))
    assert rows(search(derived, request).facets) == rows(search(stored, request).facets)
    assert rows(autocomplete(derived, "ba")) == rows(autocomplete(stored, "ba"))
    assert "terms" not in search(stored, retrieve_all=True).hits.columns


SMALL = IndexSpec("small", "id", (FieldSpec("t", "text_ws"), FieldSpec("n", "integer")))


SMALL_NORMED = IndexSpec("small", "id", (FieldSpec("t", "text_ws", norms=True), FieldSpec("n", "integer")))


def docs(spark, data, op="U"):
    df = spark.createDataFrame(data, "id int, version bigint, t string, n int").withColumn("op", F.lit(op))
    return build_documents(df, SMALL)


def found(store, keys):
    return sorted(int(r.item_id) for r in search(store.index(), keys=keys).hits.collect())


def test_upsert_delete_compact(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 1, "old text", 1), (2, 1, "stays", 2), (1, 3, "new text", 3)]), 0)
    assert (found(store, "new"), found(store, "old")) == ([1], [])
    store.append(docs(spark, [(1, 2, "late old version", 9), (3, 5, "new too", 1)]), 1)
    assert (found(store, "new"), found(store, "late")) == ([1, 3], [])
    ids = store.current().where("item_id = '1'").select("doc_key", "item_id", "index_id", "site")
    store.append(tombstones(ids, docs(spark, []).schema, F.lit(7)), 2)
    assert (found(store, "new"), found(store, "stays")) == ([3], [2])
    stats = index_statistics(store.log().select("index_id", "site", "doc_key", "version", "op")).first()
    assert (stats.log_rows, stats.deletes, stats.docs) == (5, 1, 2)
    done = store.compact(str(tmp_path / "b"))
    assert done.batches() == 1
    columns = ["doc_key", "version", "t", "n"]
    assert rows(done.current().select(columns)) == rows(store.current().select(columns))
    assert (found(done, "new"), found(done, "stays")) == ([3], [2])


def test_similarity_ignores_old_versions(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 1, "alpha beta", 1), (2, 1, "alpha gamma", 1), (3, 1, "beta", 1)]), 0)
    store.append(docs(spark, [(2, 2, "delta", 1)]), 1)
    request = SearchRequest(similar=Similar("1", ("t",)))
    assert [r.item_id for r in search(store.index(), request).hits.collect()] == ["3"]
    assert search(store.index(), request).total.first().total == 1
    fresh = SearchIndex.build(
        spark.createDataFrame([(1, "alpha beta", 1), (2, "delta", 1), (3, "beta", 1)], "id int, t string, n int"), SMALL)
    assert rows(search(fresh, request).hits) == rows(search(store.index(), request).hits)


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    for _ in range(2):
        store.append(docs(spark, [(1, 1, "x", 1)]), 0)
    assert store.log().count() == 1 and found(store, "x") == [1]


def test_renamed_columns(spark, tmp_path):
    renamed = IndexSpec("small", "id", SMALL.fields, renames={"n": "ns_number"})
    store = IndexStore(spark, str(tmp_path / "a"), renamed)
    store.append(docs(spark, [(1, 1, "x", 4)]), 0)
    assert "ns_number" in spark.read.parquet(f"{store.path}/docs").columns
    assert search(store.index(), where=Condition("n", 4)).hits.count() == 1


def test_latest_keeps_one_row_per_key(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "doc_key string, version int, v string")
    assert {r.doc_key: r.v for r in latest(log).collect()} == {"a": "z", "b": None}


def test_tracking(spark):
    """Bundles switched on and off, deletes, and a changed version."""
    source = spark.createDataFrame([("1", 1, "article"), ("2", 1, "article"), ("3", 1, "page")], "item_id string, version int, bundle string")
    empty = source.where("false")

    def remaining(src, indexed=empty):
        return remaining_items(src, indexed).count()

    assert remaining(source) == 3
    assert remaining(source.where(~F.col("bundle").isin("article", "page"))) == 0
    assert remaining(source.where("bundle = 'article'")) == 2
    assert remaining(source.where("bundle <> 'article'")) == 1
    assert remaining(source, source.where("bundle = 'page'")) == 2
    assert remaining(source.where("item_id <> '1'"), source) == 0
    assert remaining(source.withColumn("version", F.lit(2)), source) == 3


def test_stream(spark, tmp_path):
    """Changes in several files, an old version late, a delete, a restart."""
    source = tmp_path / "in"
    schema = "id int, version bigint, op string, t string, n int"

    def change(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(source / name))

    store = IndexStore(spark, str(tmp_path / "store"), SMALL)

    def run():
        stream = read_changes(spark, str(source), schema, files_per_trigger=1, recursiveFileLookup="true")
        upsert_stream(
            stream, store, lambda batch: build_documents(batch, SMALL), str(tmp_path / "checkpoint"), available_now=True,
        ).awaitTermination()

    change("a", [(1, 1, "U", "first", 1), (2, 1, "U", "second", 2), (1, 3, "U", "third", 3)])
    change("b", [(1, 2, "U", "late", 9)])
    run()
    assert (found(store, "third"), found(store, "late"), found(store, "second")) == ([1], [], [2])
    change("c", [(2, 4, "D", None, None), (3, 1, "U", "third", 1)])
    run()
    assert (found(store, "third"), found(store, "second")) == ([1, 3], [])
    assert store.log().where("indexed_at IS NULL").count() == 0
    run()
    assert store.log().count() == 5


def test_appends_do_not_overwrite(spark, tmp_path):
    """Two bulk loads, two streams and a new checkpoint all keep their batches."""
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 1, "x", 1)]))
    store.append(docs(spark, [(2, 1, "x", 1)]))
    store.append(docs(spark, [(3, 1, "x", 1)]), 0, writer="stream-a")
    store.append(docs(spark, [(4, 1, "x", 1)]), 0, writer="stream-b")
    assert found(store, "x") == [1, 2, 3, 4] and store.batches() == 4
    store.append(docs(spark, [(5, 1, "x", 1)]), 0, writer="stream-a")
    assert found(store, "x") == [1, 2, 4, 5] and store.batches() == 4


def test_same_version_sent_again(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 1, "red dog", 1), (2, 1, "blue cat", 2)]))
    store.append(docs(spark, [(1, 1, "red fox", 1), (2, 1, "blue cat", 2)]))
    assert (found(store, "dog"), found(store, "fox"), found(store, "cat")) == ([], [1], [2])
    df = {r.term: r.df for r in doc_frequency(store.index().postings()).collect()}
    assert df == {"red": 1, "fox": 1, "blue": 1, "cat": 1}


def test_an_unfinished_part_is_not_read(spark, tmp_path, monkeypatch):
    """A writer that dies before the summary leaves nothing that is read; the batch comes again."""
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 1, "x", 1)]))
    with monkeypatch.context() as patch:
        patch.setattr("gleaner.sources.store.summary", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.append(docs(spark, [(2, 1, "x", 1)]), 5, writer="w")
    assert found(store, "x") == [1] and store.batches() == 1
    store.append(docs(spark, [(2, 1, "x", 1)]), 5, writer="w")
    assert found(store, "x") == [1, 2] and store.remove_unused() == 0


def test_a_replaced_batch_revives_and_keeps_what_it_should(spark, tmp_path):
    """A batch that runs again without a document gives back the older one, unless a later batch beats both."""
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 1, "first", 1), (2, 1, "first", 1)]))
    store.append(docs(spark, [(1, 2, "second", 1), (2, 2, "second", 1)]), 7, writer="w")
    store.append(docs(spark, [(1, 3, "third", 1)]))
    store.append(docs(spark, [(3, 1, "second", 1)]), 7, writer="w")
    assert (found(store, "first"), found(store, "second"), found(store, "third")) == ([2], [3], [1])


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """One writes its whole batch while the other is at work: no part depends on another."""
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 1, "old", 1)]))
    layout, done = IndexStore._layout, []

    def slow(self, rows):
        if not done:
            done.append(1)
            store.append(docs(spark, [(1, 3, "newest", 1)]), writer="other")
        return layout(self, rows)

    monkeypatch.setattr(IndexStore, "_layout", slow)
    store.append(docs(spark, [(1, 2, "late", 1)]))
    assert (found(store, "newest"), found(store, "late"), found(store, "old")) == ([1], [], [])


def test_a_rerun_without_a_document_shows_the_next_best(spark, tmp_path):
    """Version 5 beat version 3 of another writer; its batch comes again without the document: version 3 is back."""
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(1, 5, "five", 1), (2, 1, "other", 1)]), 0, writer="b")
    store.append(docs(spark, [(1, 3, "three", 1)]), 0, writer="c")
    assert (found(store, "five"), found(store, "three")) == ([1], [])
    store.append(docs(spark, [(2, 1, "other", 1)]), 0, writer="b")
    assert (found(store, "five"), found(store, "three"), found(store, "other")) == ([], [1], [2])
    store.append(docs(spark, []), 0, writer="b")
    assert (found(store, "three"), found(store, "other")) == ([1], [])


def test_counts_of_parts_add_up(spark, tmp_path):
    """Scores of a store with rewritten and deleted rows are those of its live documents, for words and phrases."""
    store = IndexStore(spark, str(tmp_path / "a"), SMALL_NORMED)
    store.append(versioned(build_documents(spark.createDataFrame(
        [(1, "a b c", 1), (2, "a a", 1), (3, "b c d e", 2), (4, "a e", 2)], "id int, t string, n int"), SMALL_NORMED)))
    store.append(versioned(build_documents(spark.createDataFrame(
        [(2, "c c c", 1), (5, "a d", 9)], "id int, t string, n int"), SMALL_NORMED), 2))
    store.delete_where(F.col("n") == 2)
    fresh = SearchIndex.build(spark.createDataFrame(
        [(1, "a b c", 1), (2, "c c c", 1), (5, "a d", 9)], "id int, t string, n int"), SMALL_NORMED)
    for request in (
        SearchRequest(keys=some("a", "c", "zz")), SearchRequest(keys=some("a", "c"), scoring="bm25"), SearchRequest(keys=every("b c")),
    ):
        assert rows(search(store.index(), request).hits) == rows(search(fresh, request).hits)
    df = {r.term: r.df for r in store.index().document_frequency().collect()}
    assert df == {"a": 2, "b": 1, "c": 2, "d": 1}
    store.compact()
    assert {r.term: r.df for r in store.index().document_frequency().collect()} == df
    assert rows(search(store.index(), keys=some("a", "c")).hits) == rows(search(fresh, keys=some("a", "c")).hits)


def test_scores_of_a_compacted_store_count_no_documents(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "a"), SMALL_NORMED)
    store.append(docs(spark, [(1, 1, "a b", 1), (2, 1, "a", 2)]))
    for scoring in ("tfidf", "bm25"):
        plan = search(store.index(), keys="a", scoring=scoring).hits._jdf.queryExecution().optimizedPlan().toString()
        scans = [line for line in plan.splitlines() if "Relation [" in line]
        assert sum("item_id#" in line for line in scans) == 1, plan


def test_reads_are_pruned_to_the_index(spark, tmp_path):
    """Two indexes in one store: the request's index prunes the partitions of documents and postings."""
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    other = IndexSpec("other", "id", SMALL.fields)
    store.append(docs(spark, [(1, 1, "x", 1)]))
    store.append(versioned(build_documents(spark.createDataFrame([(1, "x", 7)], "id int, t string, n int"), other)))
    result = search(store.index(), keys="x")
    plan = result.hits._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all("index_id" in line.split("PartitionFilters")[1] for line in filters)
    assert [r.item_id for r in result.hits.collect()] == ["1"]
    assert search(store.index(), keys="x", index_ids=("small", "other")).total.first().total == 2


def test_statistics_and_pending(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    store.append(docs(spark, [(k, 1, "x", k) for k in range(6)]))
    store.delete(store.current().where("item_id = '1'").select("doc_key"))
    store.delete_where(F.col("n") >= 4)
    tracked = spark.createDataFrame([(str(k), 1) for k in range(8)], "item_id string, version long")
    s = store.statistics(tracked).first()
    assert (s.log_rows, s.deletes, s.deletes_by_id, s.deletes_by_condition, s.docs, s.pending) == (9, 3, 1, 2, 3, 5)


def test_deletes_and_compaction_in_place(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "a"), SMALL)
    for k in range(4):
        store.append(docs(spark, [(k, 1, "x", k), (k + 10, 1, "x", k)]))
    store.delete(store.current().where("item_id = '1'").select("doc_key"))
    store.delete_where(F.col("n") == 2)
    assert found(store, "x") == [0, 3, 10, 11, 13]
    stats = store.statistics().first()
    assert (stats.docs, stats.parts) == (5, 6) and stats.bytes > 0
    store.compact()
    assert store.batches() == 1 and found(store, "x") == [0, 3, 10, 11, 13] and store.remove_unused() > 0
    assert found(store, "x") == [0, 3, 10, 11, 13]
    store.append(docs(spark, [(1, 1, "x", 9)]))
    assert found(store, "x") == [0, 1, 3, 10, 11, 13]
    store.clear()
    assert store.current().count() == 0 and store.drop()
    assert not IndexStore(spark, store.path, IndexSpec("small", "id", SMALL.fields, read_only=True)).drop()


def test_hits_come_by_score_and_groups_in_pages(spark):
    rows_ = [(1, "a b c d", 1), (2, "a", 1), (3, "a a", 2), (4, "a b", 3)]
    spec_ = IndexSpec("small", "id", (FieldSpec("t", "text_ws", norms=True), FieldSpec("n", "integer")))
    index = SearchIndex.build(spark.createDataFrame(rows_, "id int, t string, n int"), spec_)
    scores = [r.score for r in search(index, keys="a").hits.collect()]
    assert scores == sorted(scores, reverse=True) and len(set(scores)) > 1
    by_score = search(index, keys="a", grouping=Grouping(("n",))).groups.collect()
    order = [r.group_value for r in sorted(by_score, key=lambda r: -r.score)]
    page = search(index, keys="a", grouping=Grouping(("n",)), offset=1, limit=1).groups.collect()
    assert [r.group_value for r in page] == order[1:2]


def test_odd_input_is_no_error(spark):
    from gleaner.functions.coerce import coerce_values
    from gleaner.operators.spatial import Spatial, merge_ranges

    df = spark.createDataFrame([(["0", "9223372036854775807", "1"],)], "v array<string>")
    assert [d.year for d in df.select(coerce_values(F.col("v"), "date").alias("d")).first().d] == [1970]
    place = Spatial("place", 0.0, 0.0)
    merged, rest = merge_ranges([place], Condition("place", 5, "<="))
    assert merged[0].radius == 5 and not rest.items
    with pytest.raises(ValueError, match="distance"):
        merge_ranges([place], Condition("place", 5, "<"))


def test_similar_by_key(spark):
    fields = (FieldSpec("t", "text_ws", norms=True),)
    data = [(1, "red", "a"), (1, "blue", "b"), (2, "red", "a"), (3, "blue", "b")]
    index = SearchIndex.build(spark.createDataFrame(data, "id int, t string, s string"), IndexSpec("small", "id", fields), site="s")
    request = SearchRequest(similar=Similar("1", ("t",), site="a"), all_sites=True)
    assert [(r.item_id, r.site) for r in search(index, request).hits.collect()] == [("a--2", "a")]


@pytest.mark.parametrize("files", [0, 3])
def test_a_table_streams_from_a_file_and_from_a_folder_of_files(spark, tmp_path, files):
    from catalog.base import table_changes

    (tmp_path / "table").mkdir()
    if files:
        spark.range(0, 20, 1, files).write.parquet(str(tmp_path / "table" / "things.parquet"))
    else:
        spark.range(20).toPandas().to_parquet(tmp_path / "table" / "things.parquet")
    seen = []
    table_changes(spark, str(tmp_path / "table"), "things").writeStream.foreachBatch(
        lambda batch, _: seen.extend(r.id for r in batch.collect())
    ).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == list(range(20))


@pytest.mark.parametrize("chain", ["text_ws", "text_word", "text"])
def test_stored_postings_are_those_of_the_texts(spark, tmp_path, chain):
    """Fields read off the text and fields with term vectors, short words, gaps, blanks, capitals, missing texts."""
    kind = IndexSpec("small", "id", (FieldSpec("t", chain, norms=True), FieldSpec("u", "text_ws", norms=False), FieldSpec("n", "integer")))
    data = [(1, " Foo  bar\tfoo ÄÖ a I\u0307 bar\n", "x x"), (2, "", None), (3, None, "b a"), (4, "a b a-b foo's", " "), (5, "zz " * 300, "a")]
    docs_ = versioned(build_documents(spark.createDataFrame([(*r, 1) for r in data], "id int, t string, u string, n int"), kind))
    store = IndexStore(spark, str(tmp_path / "a"), kind)
    store.append(docs_.repartition(2))
    columns = ["doc_key", "field", "term", "tf", "positions", "len", "weight"]
    want = rows(SearchIndex(kind, docs_).postings().select(columns))
    assert rows(store.index().postings().select(columns)) == want
    length = {(k, f): n for k, f, _, _, _, n, _ in want}
    assert {(r.doc_key, f): r[f"len__{f}"] for r in store.log().collect() for f in ("t", "u") if r[f"len__{f}"]} == length
    store.compact()
    assert rows(store.index().postings().select(columns)) == want


def test_writing_plain_texts_shuffles_no_postings(spark, tmp_path):
    """A batch is inverted where its documents are: no exchange and no sort of postings."""
    from gleaner.sources.inversion import block_postings

    rows_ = docs(spark, [(1, 1, "x y", 1)]).select("site", "doc_key", "t")
    text = block_postings(rows_, SMALL, ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text


def test_a_block_has_a_row_for_each_term(spark, tmp_path):
    """Postings of a term in a batch are one row for each site, with their counts; counting terms reads no posting."""
    from gleaner.sources.inversion import block_postings, unblocked
    from gleaner.sources.statistics import term_counts

    made = spark.createDataFrame(
        [("s1", "a", "x y x"), ("s1", "b", " x "), ("s2", "c", "x"), (None, "d", "y"), ("s1", "e", None)], "site string, doc_key string, t string")
    blocks = block_postings(made.coalesce(1), SMALL, ["t"])
    assert sorted((str(r.site), r.term, r.df, r.total) for r in blocks.collect()) == [
        ("None", "y", 1, 1), ("s1", "x", 2, 3), ("s1", "y", 1, 1), ("s2", "x", 1, 1)]
    assert sorted((r.doc_key, r.term, r.tf, r.positions) for r in unblocked(blocks).collect()) == [
        ("a", "x", 2, [0, 2]), ("a", "y", 1, [1]), ("b", "x", 1, [0]), ("c", "x", 1, [0]), ("d", "y", 1, [0])]
    blocks.selectExpr("'small' AS index_id", "*").write.parquet(str(tmp_path / "blocks"))
    plan = term_counts(spark.read.parquet(str(tmp_path / "blocks")))._jdf.queryExecution().executedPlan().toString()
    assert "postings" not in next(line for line in plan.splitlines() if "ReadSchema" in line)


def test_a_write_makes_no_table_of_terms(spark, tmp_path):
    """A term's counts stand in each of its blocks and are added up when read, so a write has nothing to shuffle for them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        store = IndexStore(spark, str(tmp_path / "s"), IndexSpec("i", "id", (FieldSpec("text", "text_ws", norms=True),)))
        texts = [(k, "same again " + " ".join(f"w{j}" for j in range(k % 3))) for k in range(9)]
        store.append(versioned(build_documents(spark.createDataFrame(texts, "id long, text string"), store.spec)), unique=True, partitions=2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["docs", "layout", "postings", "summary"]
    assert rows(store.index().document_frequency().select("term", "df")) == [("again", 9), ("same", 9), ("w0", 6), ("w1", 3)]


def test_words_are_counted_without_being_made():
    import pyarrow as pa

    from gleaner.sources import inversion

    texts = pa.array(["skipped", "", " ", "a", " a\tb \n", "x\x1cy\u00a0z é\x0bü\x0c", "", "last one"]).slice(1)
    assert inversion._cut_sizes(texts).tolist() == [0, 0, 1, 2, 3, 0, 2]
    assert inversion._cut_sizes(texts).tolist() == inversion._words(texts)[0].tolist()
    assert inversion._cut_sizes(texts.slice(0, 0)).tolist() == []


def test_five_digits_like_the_sql(spark):
    from catalog.stores import five_digits

    values = spark.createDataFrame([(1.120645,), (1.120655,), (2.0,)], "score double")
    assert [r[0] for r in values.select(five_digits(F.col("score"))).collect()] == [round(int(v * 1e5 + 0.5) / 1e5, 5) for v in (1.120645, 1.120655, 2.0)]
    assert values.select(five_digits(F.col("score"))).first()[0] == 1.12064
