"""Typed, null-safe conditions and condition groups.

On a multi-valued field a condition means "any value"; a missing value matches
nothing, so a negation lets it pass.  Positive leaves stay bare comparisons (null
is "no match" in a WHERE) so that they reach the file scan; negations spell out
the missing case.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.columns import all_of, any_of, is_array
from gleaner.functions.dates import date_literal
from gleaner.spec import IndexSpec

OPERATORS = ("=", "<>", "<", "<=", ">", ">=")


@dataclass(frozen=True)
class Condition:
    field: str
    value: object
    op: str = "="

    def __post_init__(self):
        if self.op not in OPERATORS:
            raise ValueError(f"unknown operator {self.op!r}")


@dataclass(frozen=True)
class Group:
    items: tuple = ()
    conjunction: str = "AND"
    tags: tuple[str, ...] = ()


def where_all(*items, tags: tuple[str, ...] = ()) -> Group:
    return Group(tuple(items), "AND", tags)


def where_any(*items, tags: tuple[str, ...] = ()) -> Group:
    return Group(tuple(items), "OR", tags)


def one_of(field: str, values) -> Group:
    return where_any(*[Condition(field, v) for v in values])


def between(field: str, low, high) -> Group:
    return where_all(Condition(field, low, ">="), Condition(field, high, "<="))


def literal(value, type_name: str):
    """Request value -> typed Python value; text is trimmed."""
    if isinstance(value, str):
        value = value.strip()
    if type_name == "boolean":
        return value not in (False, 0, "", "0", None)
    if type_name.startswith("date"):
        return date_literal(value)
    return value


def _any_value(docs: DataFrame, name: str, test: Callable[[Column], Column]) -> Column:
    column = F.col(name)
    return F.exists(column, test) if is_array(docs, name) else test(column)


def _no_value(docs: DataFrame, name: str, wanted: Column) -> Column:
    column = F.col(name)
    if is_array(docs, name):
        return ~F.coalesce(F.exists(column, lambda x: x == wanted), F.lit(False))
    return column.isNull() | (column != wanted)


def compile_condition(
    c: Condition, docs: DataFrame, spec: IndexSpec, phrase: Callable[[str, str], Column] | None = None
) -> Column | None:
    """Condition -> Column, or None for an empty text value, which drops it."""
    reserved = {"item_id", "site", "index_id"}
    if c.field not in reserved and not spec.has(c.field):
        raise ValueError(f"filter on unknown field {c.field!r}")
    f = spec[c.field] if spec.has(c.field) else None
    if f is not None and not f.is_indexed:
        raise ValueError(f"field {c.field!r} is not indexed")
    if c.value == "" and isinstance(c.value, str):
        return None
    if c.value is None:
        column = F.col(c.field)
        missing = (column.isNull() | (F.size(column) == 0)) if is_array(docs, c.field) else column.isNull()
        return missing if c.op == "=" else ~missing
    if f is not None and f.is_text:
        if c.op not in ("=", "<>"):
            raise ValueError(f"no range filter on text field {c.field!r}")
        hit = phrase(c.field, str(c.value).strip())
        return hit if c.op == "=" else ~hit
    value = literal(c.value, f.type if f else "string")
    target = f.field_type.spark_type if f else "string"
    wanted = F.lit(value).cast(target)
    if c.op == "=":
        return _any_value(docs, c.field, lambda x: x == wanted)
    if c.op == "<>":
        return _no_value(docs, c.field, wanted)
    tests = {
        "<": lambda x: x < wanted, "<=": lambda x: x <= wanted,
        ">": lambda x: x > wanted, ">=": lambda x: x >= wanted,
    }
    return _any_value(docs, c.field, tests[c.op])


def compile_group(
    g: Group | Condition, docs: DataFrame, spec: IndexSpec, phrase: Callable[[str, str], Column] | None = None
) -> Column | None:
    if isinstance(g, Condition):
        return compile_condition(g, docs, spec, phrase)
    parts = [p for p in (compile_group(i, docs, spec, phrase) for i in g.items) if p is not None]
    if not parts:
        return None
    return any_of(parts) if g.conjunction == "OR" else all_of(parts)


def text_phrases(g: Group | Condition | None, spec: IndexSpec) -> list[tuple[str, str]]:
    """(field, text) pairs a condition tree looks up in text fields."""
    if g is None:
        return []
    if isinstance(g, Condition):
        known = spec.has(g.field) and spec[g.field].is_text and g.value not in (None, "")
        return [(g.field, str(g.value).strip())] if known else []
    return [p for i in g.items for p in text_phrases(i, spec)]


def first_tags(g: Group | Condition | None) -> dict[str, list]:
    """Top-level tagged groups by their first tag; these can be left out by OR facets."""
    out: dict[str, list] = {}
    if isinstance(g, Group):
        if g.tags:
            out.setdefault(g.tags[0], []).append(g)
        elif g.conjunction == "AND":
            for i in g.items:
                for tag, groups in first_tags(i).items():
                    out.setdefault(tag, []).extend(groups)
    return out


def without_tagged(g: Group | Condition | None):
    """The tree without the groups that ``first_tags`` lists."""
    if not isinstance(g, Group):
        return g
    if g.tags:
        return None
    if g.conjunction != "AND":
        return g
    kept = [k for k in (without_tagged(i) for i in g.items) if k is not None]
    return Group(tuple(kept), "AND")


def granted(access: Column, grants: list[int]) -> Column:
    """Rows whose access list shares a grant with the user."""
    return F.arrays_overlap(access, F.array(*[F.lit(g) for g in grants]).cast("array<int>"))


def granted_by_table(docs: DataFrame, grants: DataFrame, access: str = "access") -> DataFrame:
    """As ``granted`` for a table of grants of any size, by semi join on the id."""
    allowed = docs.select("doc_key", F.explode(access).alias("grant")).join(grants, "grant", "left_semi")
    return docs.join(allowed.select("doc_key").distinct(), "doc_key", "left_semi")
