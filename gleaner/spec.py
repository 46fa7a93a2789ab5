"""Index definitions: typed fields, the type registry and its extension points."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from fnmatch import fnmatchcase

from pyspark.sql import types as T

from gleaner.functions.analysis import Analyzer, analyzer


@dataclass(frozen=True)
class FieldType:
    """Spark type and behaviour shared by all fields of one logical type."""

    name: str
    spark_type: T.DataType
    analyzer: str | Analyzer | None = None
    missing_last: bool = False  # sort position of rows without a value
    indexed: bool = True
    stored: bool = True

    @property
    def is_text(self) -> bool:
        return self.analyzer is not None


RESERVED = ("index_id", "site", "item_id", "doc_key", "version", "op", "score", "part", "written_at")

POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
TOKENS = T.ArrayType(
    T.StructType([T.StructField("value", T.StringType()), T.StructField("score", T.DoubleType())])
)

TYPES: dict[str, FieldType] = {}


def register_type(name: str, spark_type: T.DataType, **options) -> FieldType:
    """Add a logical type, or replace one."""
    TYPES[name] = FieldType(name, spark_type, **options)
    return TYPES[name]


for _name, _analyzer in {
    "text": "text", "text_words": "text_words", "text_unstemmed": "text_und",
    "text_ws": "text_ws", "text_word": "text_word", "text_edge": "edge", "text_de": "text_de",
}.items():
    register_type(_name, T.StringType(), analyzer=_analyzer)
register_type("tokens", TOKENS, analyzer="text_ws")
for _name in ("string", "uri", "geohash"):
    register_type(_name, T.StringType(), missing_last=True)
for _name in ("integer", "duration", "long"):
    register_type(_name, T.LongType())
register_type("int32", T.IntegerType())
register_type("decimal", T.DoubleType())
register_type("float", T.FloatType())
register_type("double", T.DoubleType())
register_type("date", T.TimestampType())
register_type("boolean", T.BooleanType(), missing_last=True)
for _name, _type in {
    "date_missing_last": T.TimestampType(), "long_missing_last": T.LongType(),
    "int32_missing_last": T.IntegerType(), "float_missing_last": T.FloatType(),
    "double_missing_last": T.DoubleType(),
}.items():
    register_type(_name, _type, missing_last=True)
register_type("location", POINT)
register_type("point", POINT)
register_type("access", T.IntegerType(), stored=False)
register_type("external_rank", T.DoubleType())
register_type("string_unindexed", T.StringType(), indexed=False)
register_type("binary", T.BinaryType(), indexed=False)


@dataclass(frozen=True)
class FieldSpec:
    """One field.  ``source`` is a column or SQL expression of the source rows."""

    name: str
    type: str = "string"
    source: str | None = None
    multi: bool = False
    boost: float = 1.0
    analyzer: str | Analyzer | None = None
    norms: bool | None = None
    indexed: bool | None = None
    stored: bool | None = None
    copy_to_spell: bool = True
    copies: tuple[str, ...] = ()  # patterns of other fields whose values this field takes, too

    @property
    def field_type(self) -> FieldType:
        if self.type not in TYPES:
            raise ValueError(f"unknown field type {self.type!r} of field {self.name!r}")
        return TYPES[self.type]

    @property
    def is_text(self) -> bool:
        return self.field_type.is_text

    @property
    def chain(self) -> Analyzer:
        chain = analyzer(self.analyzer or self.field_type.analyzer)
        return chain if self.norms is None else replace(chain, norms=self.norms)

    @property
    def is_indexed(self) -> bool:
        return self.field_type.indexed if self.indexed is None else self.indexed

    @property
    def is_stored(self) -> bool:
        return self.field_type.stored if self.stored is None else self.stored

    @property
    def first_column(self) -> str:
        return f"first__{self.name}" if self.multi else self.name

    @property
    def sort_column(self) -> str | None:
        """Column to order by, or None where ordering has no meaning."""
        if self.type in ("location", "point", "tokens", "binary"):
            return None
        if isinstance(self.field_type.spark_type, T.StringType):
            return f"sort__{self.name}"
        return self.first_column

    @property
    def spark_type(self) -> T.DataType:
        base = self.field_type.spark_type
        return T.ArrayType(base) if self.multi and self.type != "tokens" else base


@dataclass(frozen=True)
class IndexSpec:
    """A named set of fields over one source."""

    name: str
    key: str
    fields: tuple[FieldSpec, ...]
    site: str = "local"
    prefix: str = ""
    index_prefix: str = ""
    renames: dict[str, str] = field(default_factory=dict, hash=False)
    on_documents: Callable | None = None
    read_only: bool = False

    def __post_init__(self):
        taken = sorted({f.name for f in self.fields} & set(RESERVED))
        if taken:
            raise ValueError(f"reserved field names: {taken}")

    @property
    def index_id(self) -> str:
        return f"{self.prefix}{self.index_prefix}{self.name}"

    def __getitem__(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise ValueError(f"index {self.name!r} has no field {name!r}")

    def has(self, name: str) -> bool:
        return any(f.name == name for f in self.fields)

    def copied(self, target: FieldSpec) -> list[FieldSpec]:
        """The fields that a field copies, in the order of the spec."""
        return [f for f in self.fields if f.name != target.name and any(fnmatchcase(f.name, p) for p in target.copies)]

    def copy_order(self) -> list[FieldSpec]:
        """Fields that copy others, each after those it copies."""
        done = {f.name for f in self.fields if not f.copies}
        waiting, out = [f for f in self.fields if f.copies], []
        while waiting:
            ready = [f for f in waiting if all(s.name in done for s in self.copied(f))]
            if not ready:
                raise ValueError(f"fields copy each other in a circle: {[f.name for f in waiting]}")
            out += ready
            done |= {f.name for f in ready}
            waiting = [f for f in waiting if f.name not in done]
        return out

    @property
    def text_fields(self) -> tuple[FieldSpec, ...]:
        return tuple(f for f in self.fields if f.is_text and f.is_indexed)

    def layout(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])

    def needs_rebuild(self, other: "IndexSpec") -> bool:
        """True where the stored layout changes; a new boost alone applies at query time."""

        def shape(spec: IndexSpec):
            return spec.index_id, {
                f.name: (f.type, f.multi, f.source, f.is_indexed, f.is_stored, f.copies, f.chain if f.is_text else None)
                for f in spec.fields
            }, spec.renames

        return shape(self) != shape(other)
