"""Distance filters on a location field."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.geo import bounding_box, geodist, in_box
from gleaner.operators.filters import Condition, Group


@dataclass(frozen=True)
class Spatial:
    """Rows within ``radius`` km of a point; ``inner`` makes it a ring."""

    field: str
    lat: float
    lon: float
    radius: float | None = None
    inner: float | None = None
    method: str = "radius"  # radius | box

    @property
    def distance(self) -> Column:
        return geodist(F.col(self.field)["lat"], F.col(self.field)["lon"], self.lat, self.lon)

    def condition(self) -> Column | None:
        """A box on plain coordinates first (file statistics can prune it), then the distance."""
        parts = []
        if self.radius is not None:
            box = bounding_box(self.lat, self.lon, self.radius)
            parts.append(in_box(F.col(self.field)["lat"], F.col(self.field)["lon"], box))
        if self.inner is not None:
            parts.append(self.distance >= self.inner)
        if self.radius is not None and (self.method == "radius" or self.inner is not None):
            parts.append(self.distance <= self.radius)
        out = None
        for p in parts:
            out = p if out is None else out & p
        return out


def merge_ranges(spatials: list[Spatial], conditions) -> tuple[list[Spatial], object]:
    """Move top-level range conditions on a location field into its distances:
    the smallest upper bound and the largest lower bound win."""
    fields = {s.field for s in spatials}
    if isinstance(conditions, Condition) and conditions.field in fields:
        conditions = Group((conditions,), "AND")
    if not isinstance(conditions, Group) or conditions.conjunction != "AND":
        return spatials, conditions
    for c in conditions.items:
        if isinstance(c, Condition) and c.field in fields and c.op in ("<", ">"):
            raise ValueError(f"{c.field}: a distance takes <= or >=, not {c.op}")
    ranges = [
        c for c in conditions.items
        if isinstance(c, Condition) and c.field in fields and c.op in ("<=", ">=") and c.value is not None
    ]
    merged = []
    for s in spatials:
        upper = [float(c.value) for c in ranges if c.field == s.field and c.op == "<="]
        lower = [float(c.value) for c in ranges if c.field == s.field and c.op == ">="]
        bounds = upper + ([s.radius] if s.radius is not None else [])
        floors = lower + ([s.inner] if s.inner is not None else [])
        merged.append(replace(s, radius=min(bounds, default=None), inner=max(floors, default=None)))
    rest = tuple(c for c in conditions.items if c not in ranges)
    return merged, Group(rest, "AND", conditions.tags)
