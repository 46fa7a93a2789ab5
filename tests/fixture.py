"""The five rows most tests run on."""

from gleaner import FieldSpec, IndexSpec

ROWS = [
    (1, "foo bar baz smileὠ1", "test Case", "item", ["orange"], "item_category"),
    (2, "foo test", "bar test case", "item", ["orange", "apple", "grape"], "item_category"),
    (3, "bar", "test foobar Case", "item", None, None),
    (4, "foo baz", "test test", "article", ["apple", "strawberry", "grape"], "article_category"),
    (5, "bar baz", "foo", "article", ["orange", "strawberry", "grape", "banana"], "article_category"),
]
SCHEMA = "id bigint, name string, body string, type string, keywords array<string>, category string"


def spec(text_type="text", **options):
    return IndexSpec(
        "fixture", "id",
        (
            FieldSpec("id", "integer"), FieldSpec("name", text_type, boost=5.0), FieldSpec("body", text_type),
            FieldSpec("type"), FieldSpec("keywords", multi=True), FieldSpec("category"),
        ),
        **options,
    )
