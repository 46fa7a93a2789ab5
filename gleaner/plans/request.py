"""What a search asks for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from gleaner.operators.facets import Facet
from gleaner.operators.filters import Condition, Group
from gleaner.operators.grouping import Grouping
from gleaner.operators.keys import Keys
from gleaner.operators.similar import Similar
from gleaner.operators.spatial import Spatial


@dataclass(frozen=True)
class SearchRequest:
    keys: str | Keys | None = None
    fields: tuple[str, ...] | None = None  # text fields to search, default all
    where: Group | Condition | None = None
    sorts: tuple[tuple[str, str], ...] = ()
    offset: int = 0
    limit: int | None = None
    facets: tuple[Facet, ...] = ()
    grouping: Grouping | None = None
    spatial: tuple[Spatial, ...] = ()
    similar: Similar | None = None
    boosts: dict[str, float] = field(default_factory=dict, hash=False)
    scoring: str | None = "tfidf"  # or "bm25"; None: every hit scores 1
    retrieve_all: bool = False
    sites: tuple[str, ...] | None = None  # None: the site of the index
    all_sites: bool = False
    index_ids: tuple[str, ...] | None = None
    grants: tuple[int, ...] | None = None  # of the user; None: no check of access lists
    seed: int | str = 0
    elevation: DataFrame | None = field(default=None, hash=False)
    ranks: DataFrame | None = field(default=None, hash=False)  # external rank as a factor
    on_request: Callable | None = None
    on_hits: Callable | None = None
