"""Coercion, dates, places, markup and side files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner import Condition, FieldSpec, IndexSpec, SearchIndex, Spatial, search, where_all
from gleaner.functions.coerce import coerce_values, first_value
from gleaner.functions.dates import date_literal, date_math
from gleaner.functions.geo import EARTH_KM, bounding_box, geodist
from gleaner.functions.markup import clean_snippet, format_highlight, strip_html
from gleaner.operators.snippets import with_excerpts
from gleaner.operators.spatial import merge_ranges
from gleaner.sources.index import dictionary_from_lines, split_unknown, with_external_rank
from gleaner.sources.tables import (
    read_char_map, read_elevation, read_external_ranks, read_synonyms, read_word_list,
)


def coerced(spark, values, type_name):
    df = spark.createDataFrame([(values,)], "v array<string>")
    return df.select(
        coerce_values(F.col("v"), type_name).alias("all"), first_value(F.col("v"), type_name).alias("first")).first()


def test_coercion(spark):
    assert coerced(spark, ["1", "0", "", "x"], "boolean").all == [True, False, False, True]
    assert coerced(spark, ["12", "-3.9", "7 dwarfs", "abc", "9007199254740993"], "integer").all == [
        12, -3, 7, 0, 9007199254740993]
    assert coerced(spark, ["1.5", "2e3", ".5x", "no"], "decimal").all == [1.5, 2000.0, 0.5, 0.0]
    assert coerced(spark, ["a"], "string").first == "a"
    assert coerced(spark, None, "integer").all is None


def test_bad_date_ends_the_field(spark):
    row = coerced(spark, ["0", "bad", "1"], "date")
    assert row.all == [dt.datetime(1970, 1, 1)]
    assert row.first is None
    row = coerced(spark, ["2020-01-02T03:04:05.678Z", "86400"], "date")
    assert row.all == [dt.datetime(2020, 1, 2, 3, 4, 5), dt.datetime(1970, 1, 2)]
    assert row.first == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_reject_unknown(spark):
    spec = IndexSpec("i", "id", (FieldSpec("a"),))
    df = spark.createDataFrame([(1, {"a": ["x"]}), (2, {"a": ["x"], "b": ["y"]})], "id int, fields map<string,array<string>>")
    good, bad = split_unknown(df, spec)
    assert [r.id for r in good.collect()] == [1]
    assert [(r.id, r.unknown_fields) for r in bad.collect()] == [(2, ["b"])]


def test_date_math(spark):
    df = spark.sql("SELECT timestamp'2024-01-31 13:14:15.5' AS t")

    def at(expression):
        return df.select(date_math(F.col("t"), expression)).first()[0]

    assert at("NOW/DAY+6MONTHS+3DAYS") == dt.datetime(2024, 8, 3)
    assert at("/HOUR") == dt.datetime(2024, 1, 31, 13)
    assert at("-1DAY") == dt.datetime(2024, 1, 30, 13, 14, 15, 500000)
    assert at("/YEAR+2YEARS-1SECOND") == dt.datetime(2025, 12, 31, 23, 59, 59)
    assert at("+500MILLISECONDS") == dt.datetime(2024, 1, 31, 13, 14, 16)
    for bad in ("/FORTNIGHT", "+DAY", "NOW+1DAY!"):
        with pytest.raises(ValueError):
            at(bad)


def test_date_literals():
    assert date_literal("0") == date_literal(0) == dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    assert date_literal("2020-01-02T03:04:05Z").hour == 3
    with pytest.raises(ValueError):
        date_literal("someday")


PLACES = [(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 0.0), (4, 10.0, 10.0), (5, 0.0, 179.9), (6, 0.0, -179.9)]


@pytest.fixture(scope="module")
def places(spark):
    spec = IndexSpec("p", "id", (
        FieldSpec("place", "location", source="named_struct('lat', lat, 'lon', lon)"), FieldSpec("id", "integer")))
    return SearchIndex.build(spark.createDataFrame(PLACES, "id int, lat double, lon double"), spec)


def near(places, **options):
    where = options.pop("where", None)
    return [int(r.item_id) for r in search(
        places, spatial=(Spatial("place", **options),), where=where, sorts=(("place", "asc"), ("id", "asc"))).hits.collect()]


def test_distances(spark, places):
    row = spark.sql("SELECT 0.0D AS lat, 1.0D AS lon").select(geodist(F.col("lat"), F.col("lon"), 0, 0)).first()
    assert row[0] == pytest.approx(111.195, abs=1e-3)
    assert EARTH_KM == 6371.0087714
    assert near(places, lat=0, lon=0, radius=120) == [1, 2, 3]
    assert near(places, lat=0, lon=0, radius=120, inner=50) == [2, 3]
    assert near(places, lat=0, lon=180, radius=120) == [5, 6]
    assert near(places, lat=0, lon=0, radius=150, method="box") == [1, 2, 3]
    assert near(places, lat=0, lon=0) == [1, 2, 3, 4, 5, 6]


def test_range_conditions_tighten_the_radius(places):
    where = where_all(Condition("place", 120, "<="), Condition("place", 50, ">="), Condition("id", 3, "<"))
    assert near(places, lat=0, lon=0, radius=2000, where=where) == [2]
    merged, rest = merge_ranges([Spatial("place", 0, 0, radius=100.0)], where)
    assert (merged[0].radius, merged[0].inner) == (100.0, 50.0)
    assert [c.field for c in rest.items] == ["id"]


def test_box_crosses_the_date_line():
    south, north, west, east = bounding_box(0, 179.5, 200)
    assert west > east
    assert bounding_box(89.9, 0, 200)[2:] == (-180.0, 180.0)


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


def test_markup(spark):
    html = "<style>p{}</style><p>Fish &amp; <b>chips</b></p><script>x('</p>')</script> 1 &lt; 2"
    assert one(spark, html, strip_html) == "Fish & chips 1 < 2"
    assert one(spark, "a [HIGHLIGHT]b[/HIGHLIGHT] c", format_highlight) == "a <strong>b</strong> c"
    assert one(spark, ", href=x>say [HIGHLIGHT]yes[/HIGHLIGHT], ok. <a hr", clean_snippet) == "say <strong>yes</strong>, ok"


def test_excerpt_and_highlight(spark):
    text = "Start. " + "filler words here " * 10 + "the cats ran, " + "more words go on " * 10 + "a cat sat" + " end" * 30
    spec = FieldSpec("t", "text")
    df = spark.createDataFrame([(text,), ("nothing to see",)], "t string")
    rows = with_excerpts(df, spec, ["cat"]).collect()
    first, second = rows[0].excerpt.split(" … ")
    assert "<strong>cats</strong>" in first and "<strong>cat</strong>" in second
    assert len(first) < 70 + len("<strong></strong>") + 10
    assert rows[0].highlight.count("<strong>") == 2
    assert rows[0].highlight.replace("<strong>", "").replace("</strong>", "") == text
    assert rows[1].excerpt is None and rows[1].highlight == "nothing to see"


def test_close_hits_share_a_snippet_and_three_are_kept(spark):
    spec = FieldSpec("t", "text_ws")
    df = spark.createDataFrame([("one cat and two cat",), (("cat " + "x" * 20 + " ") + ("y " * 100 + "cat ") * 5,)], "t string")
    rows = with_excerpts(df, spec, ["cat"]).collect()
    assert rows[0].excerpt == "one <strong>cat</strong> and two <strong>cat</strong>"
    assert len(rows[1].excerpt.split(" … ")) == 3


def test_side_files(spark, tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert read_word_list(spark, write("stop.txt", "# comment\n\nthe\n of \n")) == ("the", "of")
    assert read_synonyms(spark, write("syn.txt", "car, auto\nTV => television\n")) == {
        "car": ("auto",), "auto": ("car",), "tv": ("television",)}
    assert read_char_map(spark, write("map.txt", '# x\n"é" => "e"\n"ß" => "ss"\n')) == {"é": "e", "ß": "ss"}
    xml = write("elevate.xml", '<elevate>\n<query text="example query">\n<doc id="b" />\n<doc id="a" />\n</query>\n</elevate>')
    assert [tuple(r) for r in read_elevation(spark, xml).orderBy("rank").collect()] == [
        ("example query", "b", 0), ("example query", "a", 1)]
    ranks = read_external_ranks(spark, write("ranks.txt", "a=2.5\nb=x=3\n"))
    assert {tuple(r) for r in ranks.collect()} == {("a", 2.5), ("b=x", 3.0)}
    docs = spark.createDataFrame([("a",), ("z",)], "doc_key string")
    assert {tuple(r) for r in with_external_rank(docs, ranks).collect()} == {("a", 2.5), ("z", 1.0)}
    words = dictionary_from_lines(spark.read.text(write("words.txt", "Apple\nbanana\napple\n")))
    assert {tuple(r) for r in words.collect()} == {("apple", 2), ("banana", 1)}
