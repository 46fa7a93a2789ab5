"""Full-text search and faceted analytics over Spark DataFrames."""

from gleaner.operators.facets import Facet
from gleaner.operators.filters import Condition, Group, between, one_of, where_all, where_any
from gleaner.operators.grouping import Grouping
from gleaner.operators.keys import Keys, every, none, not_every, some
from gleaner.operators.similar import Similar
from gleaner.operators.spatial import Spatial
from gleaner.plans.request import SearchRequest
from gleaner.plans.search import SearchResult, search
from gleaner.sources.index import SearchIndex, build_documents
from gleaner.sources.store import IndexStore
from gleaner.spec import FieldSpec, IndexSpec, register_type

__all__ = [
    "Condition", "Facet", "FieldSpec", "Group", "Grouping", "IndexSpec", "IndexStore", "Keys",
    "SearchIndex", "SearchRequest", "SearchResult", "Similar", "Spatial", "between",
    "build_documents", "every", "none", "not_every", "one_of", "register_type", "search", "some",
    "where_all", "where_any",
]
