"""Evidence-grounded facets: vocabulary terms found in allowed fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import Search, TermList, scan

#: Stands for what can't be told; a state, never a match.
SENTINEL = "other-unclear"


def term_lists(vocabulary: Sequence[tuple[str, str, tuple[str, ...]]], fields: Sequence[str], barred: Mapping[tuple[str, str], set[str]] = {}) -> dict[str, TermList]:
    """A term list for each vocabulary entry (axis, slug, terms), over the fields
    that may ground it: ``barred`` fields of an (axis, slug), or of (axis, ``*``),
    ground nothing."""
    out = {}
    for axis, slug, terms in vocabulary:
        no = barred.get((axis, "*"), set()) | barred.get((axis, slug), set())
        out[f"{axis}/{slug}"] = TermList(tuple(terms), tuple(f for f in fields if f not in no))
    return out


def found_array(lists: Sequence[str]) -> Column:
    """Array of (axis, slug, n_terms) of the entries that a scan found terms of."""
    every = F.array(*[F.struct(F.lit(x.split("/")[0]).alias("axis"), F.lit(x.split("/", 1)[1]).alias("slug"), F.col(f"`n_{x}`").alias("n_terms")) for x in lists])
    return F.filter(every, lambda e: e["n_terms"] > 0)


def evidence(items: DataFrame, key: str, fields: dict[str, str], vocabulary: Sequence[tuple[str, str, tuple[str, ...]]], barred: Mapping[tuple[str, str], set[str]] = {}) -> DataFrame:
    """(key, found) for each item: an array of (axis, slug, n_terms) of the entries
    it has evidence for, that is distinct terms that stand in some allowed field.
    One pass over the texts, whatever the size of the vocabulary; no shuffle."""
    lists = term_lists(vocabulary, list(fields), barred)
    return scan(items, Search(fields, (), lists), [key]).select(key, found_array(list(lists)).alias("found"))


def confidence(n_terms: Column) -> Column:
    return F.round(F.least(n_terms, F.lit(3)) / 3, 4)


def ranked(axis: str) -> Column:
    """The entries of ``found`` on one axis, most terms first, ties by slug."""
    own = F.filter("found", lambda e: e["axis"] == axis)
    return F.array_sort(F.transform(own, lambda e: F.struct((-e["n_terms"]).alias("o"), e["slug"].alias("slug"))))


def single(found: DataFrame, key: str, axis: str) -> DataFrame:
    """(key, slug, confidence, tie) of an axis with one value: most terms win; a tie
    at the top gives the sentinel. Items without evidence have no row."""
    r = found.select(key, ranked(axis).alias("r")).where(F.size("r") > 0)
    top = F.filter("r", lambda x: x["o"] == F.col("r")[0]["o"])
    tie = F.size(top) > 1
    return r.select(key, F.when(tie, F.lit(SENTINEL)).otherwise(F.col("r")[0]["slug"]).alias("slug"), confidence(-F.col("r")[0]["o"]).alias("confidence"), tie.alias("tie"))


def several(found: DataFrame, key: str, axis: str, most: int = 4) -> DataFrame:
    """(key, slugs, dropped) of an axis with several values: the ``most`` with the
    most terms, ties by slug; the names of the others are told."""
    r = found.select(key, F.transform(ranked(axis), lambda x: x["slug"]).alias("r")).where(F.size("r") > 0)
    return r.select(key, F.slice("r", 1, most).alias("slugs"), F.slice("r", F.lit(most + 1), F.greatest(F.size("r") - most, F.lit(0))).alias("dropped"))


def assign(found: DataFrame, key: str, applicable: Column, most: int = 4) -> DataFrame:
    """(key, industry, functions, use_cases, unresolved): all three axes of an item;
    ``unresolved`` tells, sorted, of axes without evidence, of an industry tie and of
    values beyond ``most``. Items to which facets don't apply (say, of an excluded
    topic) have nothing."""
    ind = ranked("industry")
    tie = (F.size(ind) > 1) & (F.get(ind, F.lit(1))["o"] == F.get(ind, F.lit(0))["o"])
    industry = F.when(F.size(ind) == 0, F.lit(None).cast("string")).when(tie, F.lit(SENTINEL)).otherwise(F.get(ind, F.lit(0))["slug"])
    pick = lambda axis: F.slice(F.transform(ranked(axis), lambda x: x["slug"]), 1, most)
    names = lambda r: F.array_join(F.transform(r, lambda x: x["slug"]), ", ")
    tied = F.filter(ind, lambda x: x["o"] == F.get(ind, F.lit(0))["o"])
    told = [F.when(F.size(ind) == 0, F.lit("industry: insufficient_evidence")).when(tie, F.concat(F.lit(f"industry: {SENTINEL}: equally supported: "), names(tied)))]
    for a in ("function", "use_case"):
        r = ranked(a)
        rest = F.slice(r, F.lit(most + 1), F.greatest(F.size(r) - most, F.lit(0)))
        told.append(F.when(F.size(r) == 0, F.lit(f"{a}: insufficient_evidence")).when(F.size(rest) > 0, F.concat(F.lit(f"{a}: {SENTINEL}: dropped: "), names(rest))))
    why = F.array_sort(F.array_compact(F.array(*told)))
    on = F.coalesce(applicable, F.lit(False))
    return found.select(key, *[F.when(on, c).alias(n) for n, c in (("industry", industry), ("functions", pick("function")), ("use_cases", pick("use_case")), ("unresolved", why))])


def applicability(record_type: Column, topic: Column, category: Column, forbidden: Sequence[str], gated: Sequence[tuple[str, str]], report_only: Sequence[tuple[str, str]] = ()) -> Column:
    """(applicable, gated, report_only) of a record: pointers and forbidden topics have
    no facets; gated cells are published only with resolved ones."""
    on = F.coalesce((record_type == "full") & ~topic.isin(*forbidden), F.lit(False))

    def among(cells: Sequence[tuple[str, str]]) -> Column:
        out = F.lit(False)
        for t, c in cells:
            out = out | (topic.eqNullSafe(F.lit(t)) & category.eqNullSafe(F.lit(c)))
        return on & out

    return F.struct(on.alias("applicable"), among(gated).alias("gated"), among(report_only).alias("report_only"))


def is_eligible(app: Column, resolved: Column) -> Column:
    """Whether facets let a record be published: not gated, or resolved."""
    return ~app["gated"] | F.coalesce(resolved, F.lit(False))


def is_resolved(industry_supported: Column, functions: Column, use_cases: Column) -> Column:
    """A known industry, not the sentinel, and a function or a use case."""
    return F.coalesce(industry_supported, F.lit(False)) & ((F.coalesce(F.size(functions), F.lit(0)) > 0) | (F.coalesce(F.size(use_cases), F.lit(0)) > 0))


STATES = ("unmapped_legacy_value", "not_enriched", "facet_complete", "facet_partial", "unresolved")


def tally(states: DataFrame, column: str) -> DataFrame:
    """(state, n) of all five states, those that nothing is in with 0; together they
    are the records to which facets apply."""
    counts = states.agg(F.array(*[F.struct(F.lit(s).alias("state"), F.count_if(F.col(column) == s).alias("n")) for s in STATES]).alias("x"))
    return counts.select(F.inline("x"))


def reporting_state(applicable: Column, enriched: Column, unmapped: Column, industry: Column, others: Column) -> Column:
    """Unmapped legacy value, not enriched, complete, partial or unresolved; null for
    records to which facets don't apply."""
    return (
        F.when(~applicable, F.lit(None).cast("string"))
        .when(unmapped, "unmapped_legacy_value")
        .when(~enriched, "not_enriched")
        .when(industry & (others > 0), "facet_complete")
        .when(industry | (others > 0), "facet_partial")
        .otherwise("unresolved")
    )
