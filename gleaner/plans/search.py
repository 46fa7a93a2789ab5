"""From a request to lazy DataFrames: matches, hits, counts, facets and groups.

The whole request becomes one logical plan per output.  Scope and plain filters
come first (they reach the scan), then term lookup inside the rows or in the
stored postings, then the keyword expression, then scores.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.columns import all_of, any_of, compute_once
from gleaner.operators.facets import Facet, distance_facet, facet_counts, stored_facets
from gleaner.operators.filters import (
    Condition, Group, compile_group, first_tags, granted, text_phrases, without_tagged,
)
from gleaner.operators.grouping import Grouping, group_counts, heads, top_n
from gleaner.operators.keys import Keys, as_keys
from gleaner.operators.scoring import Measure, collection_stats, elevation_rank, score
from gleaner.operators.similar import similar_scores
from gleaner.operators.snippets import with_excerpts, with_highlights
from gleaner.operators.sorting import BY_RELEVANCE, sort_columns
from gleaner.operators.spatial import Spatial, merge_ranges
from gleaner.plans.request import SearchRequest
from gleaner.sources.index import Lookup, SearchIndex, ranked_by


class SearchResult:
    """Lazy answers to one request; nothing runs before an action on them."""

    def __init__(self, index: SearchIndex, request: SearchRequest):
        if request.on_request:
            request = request.on_request(request)
        self.request = request
        self.spec = index.spec
        self._given = index
        sites = None if request.all_sites else (request.sites or (index.spec.site,))
        self.index = index.scoped(sites, request.index_ids)
        if request.grants is not None:
            # part of the scope, so that counts and facets obey it too
            lists = [F.col(f.name) for f in self.spec.fields if f.type == "access" and f.multi]
            allowed = [F.coalesce(granted(c, list(request.grants)), F.lit(False)) for c in lists]
            allowed_docs = self.index.docs.where(all_of(allowed) if allowed else F.lit(False))
            self.index = replace(self.index, docs=allowed_docs, counts=None)
        self.keys = as_keys(request.keys) if request.similar is None else as_keys(None)
        self.fields = [self.spec[f] for f in request.fields] if request.fields else list(self.spec.text_fields)
        for f in self.fields:
            if not f.is_text or not f.is_indexed:
                raise ValueError(f"field {f.name!r} cannot be searched for keywords")
        spatial, where = merge_ranges(list(request.spatial), request.where)
        self.spatial: list[Spatial] = spatial
        self.where: Group | Condition | None = where
        self._analyze()

    # -- term lookup -----------------------------------------------------
    def _analyze(self) -> None:
        """Analyze each phrase once per field; collect the terms to look up."""
        wanted: dict[str, list[str]] = {}
        for phrase in self.keys.phrases():
            for f in self.fields:
                wanted.setdefault(f.name, []).append(phrase)
        for name, text in text_phrases(self.where, self.spec):
            wanted.setdefault(name, []).append(text)
        self._lookups: dict[str, Lookup] = {}
        for name, phrases in wanted.items():
            phrases = list(dict.fromkeys(phrases))
            terms: list[str] = []
            slots_of = {}
            for phrase, slots in zip(phrases, self.spec[name].chain.query_slots(self.index.spark, phrases)):
                for slot in slots:
                    terms += [t for t in slot if t not in terms]
                slots_of[phrase] = [[terms.index(t) for t in slot] for slot in slots]
            # A key without any term left in a field (a stop word, say) cannot
            # match there; with no terms at all the field is not looked up.
            if terms:
                self._lookups[name] = Lookup(terms, slots_of)

    def _looked_up(self, docs: DataFrame, need_match: bool = False) -> DataFrame:
        """Documents plus one frequency column per field and phrase."""
        return replace(self.index, docs=docs).with_frequencies(self._lookups, need_match)

    def _tf(self, field: str, phrase: str) -> str | None:
        if field not in self._lookups:
            return None
        return f"_tf_{field}_{list(self._lookups[field].phrases).index(phrase)}"

    def _phrase_hit(self, field: str, phrase: str) -> Column:
        name = self._tf(field, phrase)
        return F.lit(False) if name is None else F.col(name) > 0

    def _is_empty(self, phrase: str) -> bool:
        """No term is left of this key in any field (stop words, punctuation): it is ignored."""
        return not any(
            f.name in self._lookups and any(self._lookups[f.name].phrases[phrase]) for f in self.fields
        )

    def _key_hit(self, phrase: str) -> Column | None:
        if self._is_empty(phrase):
            return None
        return any_of(self._phrase_hit(f.name, phrase) for f in self.fields)

    def _key_column(self, keys: Keys) -> Column | None:
        """The keyword expression; keys that are all empty match nothing."""
        column = keys.column(self._key_hit)
        return F.lit(False) if column is None and keys.phrases() else column

    def _may_hold(self, field: str, phrase: str) -> Column:
        """A cheap test on the text that every document with the phrase passes."""
        f = self.spec[field]
        if field not in self._lookups:
            return F.lit(False)
        if f.type == "tokens" or f.multi:
            return F.lit(True)
        lookup = self._lookups[field]
        return all_of(
            any_of(f.chain.may_hold(F.col(field), lookup.terms[i]) for i in slot)
            for slot in lookup.phrases[phrase] if slot
        )

    def _may_hold_key(self, phrase: str) -> Column | None:
        if self._is_empty(phrase):
            return None
        return any_of(self._may_hold(f.name, phrase) for f in self.fields)

    def _likely(self) -> Column | None:
        """The keyword expression on the raw text, true wherever the real one is.

        A substring search in compiled code is far cheaper than analysis, so only
        its survivors are analyzed.  Negations are left to the real test.
        """
        if self.index.stored_postings is not None:
            return None
        parts = [
            self._may_hold(i.field, str(i.value).strip()) for i in self._untagged
            if isinstance(i, Condition) and i.op == "=" and text_phrases(i, self.spec)
        ]
        keys = self.keys.evaluate(self._may_hold_key, all_of, any_of, lambda c: F.lit(True))
        if keys is not None:
            parts.append(keys)
        return all_of(parts) if parts else None

    # -- filters ---------------------------------------------------------
    @cached_property
    def _tagged(self) -> dict[str, list]:
        """Tagged groups some OR facet wants to leave out."""
        used = {f.tag for f in self.request.facets if f.operator == "or"}
        return {t: g for t, g in first_tags(self.where).items() if t in used}

    @cached_property
    def _untagged(self) -> list:
        """Top-level conditions outside the tagged groups."""
        rest = without_tagged(self.where) if self._tagged else self.where
        if rest is None:
            return []
        return list(rest.items) if isinstance(rest, Group) and rest.conjunction == "AND" else [rest]

    def _compiled(self, items: list) -> list[Column]:
        flags = [compile_group(i, self.index.docs, self.spec, self._phrase_hit) for i in items]
        return [f for f in flags if f is not None]

    @cached_property
    def _row_conditions(self) -> list[Column]:
        """Filters on plain columns: applied to the documents before any text work."""
        plain = [i for i in self._untagged if not text_phrases(i, self.spec)]
        return self._compiled(plain) + [c for c in (s.condition() for s in self.spatial) if c is not None]

    def _masks(self) -> dict[str, Column]:
        out = {}
        for tag, groups in self._tagged.items():
            flag = compile_group(Group(tuple(groups)), self.index.docs, self.spec, self._phrase_hit)
            if flag is not None:
                out[tag] = F.coalesce(flag, F.lit(False))
        if self._tagged:
            # tagged groups no facet leaves out stay ordinary filters
            others = [g for t, gs in first_tags(self.where).items() if t not in self._tagged for g in gs]
            if others:
                flag = compile_group(Group(tuple(others)), self.index.docs, self.spec, self._phrase_hit)
                out["_others"] = F.coalesce(flag, F.lit(False))
        return out

    def _text_conditions(self) -> list[Column]:
        """Phrase filters and the keyword expression, on looked-up rows."""
        out = self._compiled([i for i in self._untagged if text_phrases(i, self.spec)])
        matched = self._key_column(self.keys)
        return out if matched is None else [*out, matched]

    @cached_property
    def _need_match(self) -> bool:
        """Can rows without any looked-up term be dropped early?"""
        if text_phrases(self.where, self.spec) or not self.keys.phrases():
            return False
        return self.keys.needs_a_hit(self._is_empty)

    @cached_property
    def filtered_docs(self) -> DataFrame:
        """Documents passing the filters on plain columns."""
        docs = self.index.docs
        for c in self._row_conditions:
            docs = docs.where(c)
        return docs

    @cached_property
    def _candidates(self) -> DataFrame:
        """Rows passing everything but tagged groups."""
        docs = self.filtered_docs
        likely = self._likely()
        if likely is not None:
            docs = docs.where(likely)
        rows = self._looked_up(docs, self._need_match)
        for c in self._text_conditions():
            rows = rows.where(c)
        return rows

    def looked_up_for(self, keys: Keys) -> DataFrame:
        """Rows matching ``keys`` (part of this request's keys), flagged ``_also``
        where they match all of this request's keys."""
        docs = self.filtered_docs
        if self.index.stored_postings is None:
            likely = keys.evaluate(self._may_hold_key, all_of, any_of, lambda c: F.lit(True))
            docs = docs if likely is None else docs.where(likely)
        rows = self._looked_up(docs, bool(keys.phrases()) and self._need_match)
        for c in self._compiled([i for i in self._untagged if text_phrases(i, self.spec)]):
            rows = rows.where(c)
        for m in self._masks().values():
            rows = rows.where(m)
        wanted = self._key_column(keys)
        rows = rows if wanted is None else rows.where(wanted)
        return rows.withColumn("_also", self._key_column(self.keys))

    @cached_property
    def _measures(self) -> list[Measure]:
        scored = self.keys.phrases(positive_only=True)
        return [
            Measure(p, f.name, self._tf(f.name, p), f"_len_{f.name}",
                    self.request.boosts.get(f.name, f.boost), f.chain.norms,
                    self._tf(f.name, p).replace("_tf_", "_w_", 1) if f.type == "tokens" else None)
            for p in scored for f in self.fields
            if f.name in self._lookups
        ]

    def _scored(self, rows: DataFrame) -> DataFrame:
        measures = self._measures
        if self.request.similar is not None:
            scores = similar_scores(self.index, self.request.similar)
            return rows.join(scores, [c for c in scores.columns if c != "score"])
        if not measures or self.request.scoring is None:
            return rows.withColumn("score", F.lit(1.0))
        words = self._words_of(measures)
        if self.index.counts is not None and words is not None:
            # counted when the parts were written
            n = self.index.counts.documents()
            averaged = {m.field: m.norms and self.request.scoring == "bm25" for m in measures}
            return self._with_scores(rows, n, self.index.counts.collection(words, averaged))
        n = self.index.docs.agg(F.count("*").alias("n")).scalar()
        docs = self.index.docs
        if self.request.scoring != "bm25" and self.index.stored_postings is None:
            # only documents that may hold a scored phrase are analyzed for the counts
            flags = [self._may_hold_key(p) for p in dict.fromkeys(m.phrase for m in measures)]
            docs = docs.where(any_of(f for f in flags if f is not None))
        need_match = self.request.scoring != "bm25"
        if need_match and self.index.stored_postings is None:
            counted = replace(self.index, docs=docs).with_hits(self._lookups)
        else:
            counted = self._looked_up(docs, need_match)
        return self._with_scores(rows, n, collection_stats(counted, measures))

    def _with_scores(self, rows: DataFrame, n: Column, stats: Column) -> DataFrame:
        rows = compute_once(rows, {"_n": n, "_stats": stats})
        value = score(self._measures, F.col("_stats"), F.col("_n"), model=self.request.scoring)
        return rows.withColumn("score", value).drop("_n", "_stats")

    def _words_of(self, measures: list[Measure]) -> list[tuple[str, str]] | None:
        """(field, term) of each measure, if all of them are single words."""
        words = []
        for m in measures:
            lookup = self._lookups[m.field]
            slots = lookup.phrases[m.phrase]
            if len(slots) != 1 or len(slots[0]) != 1:
                return None
            words.append((m.field, lookup.terms[slots[0][0]]))
        return words

    @cached_property
    def _matching(self) -> DataFrame:
        """Documents passing all filters and keywords, not scored."""
        rows = self._candidates
        for m in self._masks().values():
            rows = rows.where(m)
        return rows

    @cached_property
    def matched(self) -> DataFrame:
        """All matching documents with their score."""
        rows = self._scored(self._matching)
        rows = rows.drop(*[c for c in rows.columns if c.startswith(("_len_", "_tf", "_w_"))])
        if self.request.ranks is not None:
            rows = ranked_by(rows, self.request.ranks)
        if self.request.elevation is not None:
            keys = self.request.keys if isinstance(self.request.keys, str) else " ".join(self.keys.phrases())
            rows = elevation_rank(rows, self.request.elevation, keys)
        return rows

    # -- outputs ---------------------------------------------------------
    def _order(self, sorts: tuple[tuple[str, str], ...]) -> list[Column]:
        points = {s.field: (s.lat, s.lon) for s in self.spatial}
        order = sort_columns(list(sorts or ((BY_RELEVANCE, "desc"),)), self.spec, self.request.seed, points)
        if self.request.elevation is not None:
            order = [F.col("elev_rank").asc_nulls_last(), *order]
        return order

    def _projected(self, rows: DataFrame) -> DataFrame:
        if self.request.retrieve_all:
            hidden = [f.name for f in self.spec.fields if not f.is_stored]
            hidden += [c for c in rows.columns if c in ("terms", "part", "written_at") or c.startswith(("first__", "sort__", "len__"))]
            rows = rows.drop(*hidden)
        else:
            extra = [f"distance__{s.field}" for s in self.spatial]
            place = ["elev_rank"] if self.request.elevation is not None else []
            site = ["site"] if self.request.all_sites else []
            rows = rows.select("item_id", "score", *site, *place, *[c for c in extra if c in rows.columns])
        if self.request.all_sites:
            rows = rows.withColumn("item_id", foreign_item_id(self.spec.site))
        return rows

    @cached_property
    def hits(self) -> DataFrame:
        """One page of hits in order."""
        rows = self.matched
        for s in self.spatial:
            rows = rows.withColumn(f"distance__{s.field}", F.round(s.distance, 6))
        paged = self.request.offset or self.request.limit is not None
        ranked = self.request.similar is not None or self.request.scoring is not None and self._measures
        if paged or ranked or self.request.sorts or self.request.elevation is not None:
            rows = rows.orderBy(*self._order(self.request.sorts))
        if self.request.offset:
            rows = rows.offset(self.request.offset)
        if self.request.limit is not None:
            rows = rows.limit(self.request.limit)
        rows = self._projected(rows)
        return self.request.on_hits(rows) if self.request.on_hits else rows

    def excerpts(self, field: str | None = None) -> DataFrame:
        """The page of hits with all stored columns and an ``excerpt``: of one text field, with its ``highlight``,
        or of all searched text fields, which are then highlighted in their own columns."""
        page = SearchResult(self._given, replace(self.request, retrieve_all=True, on_request=None)).hits
        if field is not None:
            return with_excerpts(page, self.spec[field], self._positive_terms(field))
        shown = [f for f in self.fields if f.is_stored]
        return with_highlights(page, {f: self._positive_terms(f.name) for f in shown})

    def _positive_terms(self, field: str) -> list[str]:
        lookup = self._lookups.get(field)
        terms: list[str] = []
        if lookup:
            for phrase in self.keys.phrases(positive_only=True):
                terms += [lookup.terms[i] for slot in lookup.phrases[phrase] for i in slot]
        return list(dict.fromkeys(terms))

    @cached_property
    def total(self) -> DataFrame:
        """Number of matching documents."""
        rows = self._matching
        if self.request.similar is not None:
            scores = similar_scores(self.index, self.request.similar).drop("score")
            rows = rows.join(scores, scores.columns, "left_semi")
        return rows.agg(F.count("*").alias("total"))

    @cached_property
    def facets(self) -> DataFrame:
        """``(facet, value, count)`` of all requested facets."""
        places = {s.field: s for s in self.spatial}
        plain = [f for f in self.request.facets if f.field not in places]
        parts = []
        if plain:
            parts.append(self._plain_facets(plain))
        for f in self.request.facets:
            if f.field in places:
                parts.append(self._distance_facet(f, places[f.field]))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _plain_facets(self, facets: list[Facet]) -> DataFrame:
        grouping = self.request.grouping
        group = None
        masks = dict(self._masks())
        if self._counts_suffice(facets):
            names = list(dict.fromkeys(f.field for f in facets))
            return stored_facets(self.index.document_frequency(names), facets)
        if grouping and grouping.truncate:
            return self._truncated_facets(facets, masks)
        if self.request.similar is not None:
            rows = self._scored(self._candidates)
        elif any(f.min_count == 0 for f in facets):
            # values without a hit must stay visible: flag rows instead of filtering
            rows = self._looked_up(self.index.docs)
            conditions = self._row_conditions + self._text_conditions()
            if conditions:
                masks[""] = F.coalesce(all_of(conditions), F.lit(False))
        else:
            rows = self._candidates
        if grouping and grouping.facet:
            group = grouping.fields[0]
        return facet_counts(rows, facets, self.spec, masks, group)

    def _counts_suffice(self, facets: list[Facet]) -> bool:
        """Facets of text fields over all documents of a stored index: its term counts are the answer."""
        unfiltered = not (self._row_conditions or self._text_conditions() or self._masks())
        plain = self.request.similar is None and self.request.grouping is None and self.index.counts is not None
        return plain and unfiltered and all(
            self.spec[f.field].is_text and self.spec[f.field].is_indexed and f.min_count > 0 and not f.missing for f in facets)

    def _truncated_facets(self, facets: list[Facet], masks: dict[str, Column]) -> DataFrame:
        """Facets over the head of each group.  The heads are chosen among the rows that pass the facet's filters,
        so an OR facet, which leaves one out, has heads of its own."""
        grouping = self.request.grouping
        scored = self._scored(self._candidates)
        parts: dict[str, list[Facet]] = {}
        for f in facets:
            parts.setdefault(f.tag if f.operator == "or" and f.tag in masks else "", []).append(f)
        out = None
        for left_out, own in parts.items():
            rows = scored.where(all_of(m for tag, m in masks.items() if tag != left_out))
            rows = heads(rows, grouping.fields[0], self._order(grouping.sort))
            counted = facet_counts(rows, own, self.spec, {}, grouping.fields[0] if grouping.facet else None)
            out = counted if out is None else out.unionByName(counted)
        return out

    def _distance_facet(self, facet: Facet, spatial: Spatial) -> DataFrame:
        return distance_facet(self._candidates, facet, spatial, all_of(self._masks().values()))

    @cached_property
    def groups(self) -> DataFrame:
        """``(group_field, group_value, rank, item_id, score)``: the best rows per group."""
        grouping = self._grouping()
        order = self._order(grouping.sort or self.request.sorts)
        out = None
        for name in grouping.fields:
            top = top_n(self._group_page(name, order), [name], order, grouping.limit).select(
                F.lit(name).alias("group_field"), F.col(name).cast("string").alias("group_value"),
                F.col("rank"), "item_id", "score",
            )
            out = top if out is None else out.unionByName(top)
        return out

    def _group_page(self, name: str, order: list) -> DataFrame:
        """The rows of one page of groups; groups stand in the order of their first rows."""
        if not self.request.offset and self.request.limit is None:
            return self.matched
        page = heads(self.matched, name, order).orderBy(*order)
        page = page.offset(self.request.offset) if self.request.offset else page
        page = page.limit(self.request.limit) if self.request.limit is not None else page
        wanted = page.select(F.col(name).alias("_group"))
        return self.matched.join(wanted, F.col(name).eqNullSafe(F.col("_group")), "left_semi")

    @cached_property
    def group_total(self) -> DataFrame:
        """``(group_field, groups)``: number of groups per field."""
        rows = self.matched if self.request.similar is not None else self._matching
        return group_counts(rows, self._grouping().fields, self._grouping().approximate)

    def _grouping(self) -> Grouping:
        grouping = self.request.grouping
        if grouping is None:
            raise ValueError("the request asks for no grouping")
        for name in grouping.fields:
            if self.spec[name].is_text or self.spec[name].multi:
                raise ValueError(f"cannot group by {name!r}: only single-valued fields that are not text")
        return grouping


def foreign_item_id(own_site: str) -> Column:
    """Items of other sites show their site in front of the id."""
    return F.when(F.col("site") != own_site, F.concat("site", F.lit("--"), "item_id")).otherwise(F.col("item_id"))


def search(index: SearchIndex, request: SearchRequest | None = None, **options) -> SearchResult:
    return SearchResult(index, request or SearchRequest(**options))
