"""What a run leaves: cells, topics, counts, conflicts, ledger observations, coverage
and the manifest, each derived from the rows beside it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls

RECORD_TYPES = ("full", "cross_reference")
NOT_CHECKED = "not_checked"


def record_counts(records: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals of a cell or topic: a pointer is counted, but isn't content."""
    kind = lambda k: F.count_if(F.col("record_type") == k)
    return records.groupBy(*by).agg(F.count("*").alias("total_records"), kind("full").alias("full_records"), kind("cross_reference").alias("cross_references"))


def cells(records: DataFrame, configured: DataFrame) -> DataFrame:
    """A row for each configured cell (cell_id, ...) with its counts, 0 where it has
    no record."""
    n = record_counts(records, ["cell_id"])
    return configured.join(n, "cell_id", "left").fillna(0, ["total_records", "full_records", "cross_references"])


def topic_records(records: DataFrame) -> DataFrame:
    """The fold of a topic's cells: of records with one identifier the first in the
    total order, ties by their content, stays."""
    w = Window.partitionBy("topic", "record_id").orderBy(F.coalesce("category", F.lit("")), F.to_json(F.struct(*sorted(records.columns))))
    return records.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def by_category(records: DataFrame) -> DataFrame:
    """(topic, by_category): full records of each category of a topic, as a map."""
    n = records.where(F.col("record_type") == "full").groupBy("topic", "category").agg(F.count("*").alias("n"))
    return n.groupBy("topic").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("by_category"))


def candidates_by_source(groups: DataFrame, source_ids: str = "source_ids") -> DataFrame:
    """(source_id, candidates, accepted): a candidate counts for each of its sources."""
    x = groups.select(F.explode(source_ids).alias("source_id"), "accepted")
    return x.groupBy("source_id").agg(F.count("*").alias("candidates"), F.count_if("accepted").alias("accepted"))


def unchecked(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(unchecked, total) over full records: pointers were never pages to fetch."""
    full = F.col("record_type") == "full"
    return records.groupBy(*by).agg(F.count_if(full & (F.col("access_status") == NOT_CHECKED)).alias("unchecked"), F.count_if(full).alias("total"))


def withheld_reason(access: Column, verification: Column, facets_gated: Column, resolved: Column) -> Column:
    """Why a full record isn't eligible; null for one that is."""
    return (
        F.when(access.isNull() | (access == NOT_CHECKED), "not_checked")
        .when(~access.isin("ok", "redirected"), F.concat(F.lit("access_"), access))
        .when(verification == "unverified", "unverified")
        .when(F.coalesce(facets_gated, F.lit(False)) & ~F.coalesce(resolved, F.lit(False)), "facets_unresolved")
    )


def eligibility(mode: str, cell_rows: DataFrame, records: DataFrame, fetch_owners: int) -> DataFrame:
    """(eligible, reason): one row. In their order: a run that isn't a harvest, one
    that fetched nothing, failed cells (named in order), full records that nobody
    checked. Fetches are needed and not enough."""
    failed = cell_rows.where(F.col("status").isin("infrastructure_error", "adapter_error")).select("cell_id").distinct()
    if mode != "harvest":
        reason = f"{mode} runs are tests"
    elif not fetch_owners:
        reason = "no target page was fetched"
    elif broken := sorted(r["cell_id"] for r in failed.collect()):  # as bounded as the configuration
        reason = f"failed: {', '.join(broken)}"
    else:
        n = unchecked(records).first()
        reason = f"{n['unchecked']} of {n['total']} records not checked" if n["unchecked"] else None
    return cell_rows.sparkSession.createDataFrame([(reason is None, reason)], "eligible boolean, reason string")


def alias_conflicts(conflicts: DataFrame, detected_at: str) -> DataFrame:
    """Rows of the conflicts' document: each contradiction once, with an identifier
    from its content, its explanation (the reason where none was given), unresolved."""
    c = conflicts.groupBy("reason", "identity_url", "proposed_alias").agg(F.min("detail").alias("detail"))
    return c.select(
        urls.conflict_id(F.col("reason"), F.col("identity_url"), F.col("proposed_alias")).alias("conflict_id"), "reason", "identity_url", "proposed_alias",
        F.coalesce(F.nullif("detail", F.lit("")), F.col("reason")).alias("detail"), F.lit("unresolved").alias("resolution"), F.lit(detected_at).alias("detected_at"),
    )


def conflict_problems(conflicts: DataFrame) -> DataFrame:
    """Conflicts without a reason or an identity, which can't be reported."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    return conflicts.where(blank("reason") | blank("identity_url"))


ALIAS_KINDS = ("permanent_redirect", "rel_canonical", "domain_migration")


def aliases(rows: DataFrame, identity: str, names: str) -> DataFrame:
    """``rows`` with the array of aliases (url, kind, evidence) validated: an alias
    without an address, of an unknown kind, or that is the identity itself is left
    out; others are distinct and sorted. ``alias_problems`` counts what was left out
    for a fault."""
    usable = F.filter(names, lambda a: urls.canonical(a["url"]).isNotNull() & a["kind"].isin(*ALIAS_KINDS))
    kept = F.filter(usable, lambda a: a["url"] != F.col(identity))
    return rows.withColumns({"alias_problems": F.size(names) - F.size(usable), names: F.array_sort(F.array_distinct(kept))})


def ledger_observations(verdicts: DataFrame, records: DataFrame, seen_at: str) -> DataFrame:
    """Observations of a run for the ledger: each verdict (cell_id, identity_url,
    accepted, rejection_reason, composite) with what its full record, if there is one,
    knows. Unknown stays null and never overwrites."""
    known = records.where(F.col("record_type") == "full").groupBy("cell_id", "identity_url").agg(*[F.max(c).alias(c) for c in ("record_id", "content_hash", "access_status")])
    outcome = F.when(F.col("accepted"), "accepted").when(F.col("rejection_reason").isNotNull(), "rejected").otherwise("pending")
    return verdicts.join(known, ["cell_id", "identity_url"], "left").select("cell_id", "identity_url", F.lit(seen_at).cast("timestamp").alias("seen_at"), outcome.alias("outcome"), "composite", "record_id", "content_hash", "access_status")


OBSERVED = ("cell_id", "identity_url", "seen_at", "outcome", "composite", "record_id", "content_hash", "access_status")
MERGE_OWNED = ("first_seen_at", "last_seen_at", "seen_count")
OUTCOMES = ("pending", "accepted", "rejected", "duplicate")


def observation_problems(observations: DataFrame) -> DataFrame:
    """(cell_id, identity_url, problem) of observations that a merge refuses: an
    outcome nobody knows, no identity, no time. Columns that the merge owns, or that
    it doesn't know, raise."""
    owned = sorted(set(observations.columns) & set(MERGE_OWNED))
    unknown = sorted(set(observations.columns) - set(OBSERVED) - set(MERGE_OWNED))
    if owned or unknown:
        raise ValueError(f"observations may not carry {owned + unknown}")
    problem = F.when(F.coalesce(F.trim("identity_url"), F.lit("")) == "", "no_identity").when(~F.coalesce(F.col("outcome").isin(*OUTCOMES), F.lit(False)), "unknown_outcome").when(F.col("seen_at").isNull(), "no_time")
    return observations.select("cell_id", "identity_url", problem.alias("problem")).where(F.col("problem").isNotNull())


def coverage_summary(records: DataFrame, axes: Mapping[str, Column], failed: Column, foreign: Column, thin: int) -> DataFrame:
    """(dimension, value, n, failed_pct, foreign_pct, thin): a report over each
    dimension and over all rows (dimension ``all``) by one pass of grouping sets;
    values with fewer than ``thin`` rows are thin."""
    names = list(axes)
    x = records.select(*[c.cast("string").alias(n) for n, c in axes.items()], failed.cast("int").alias("_f"), foreign.cast("int").alias("_x"))
    g = x.groupingSets([*[[F.col(n)] for n in names], []], *[F.col(n) for n in names]).agg(F.count("*").alias("n"), F.sum("_f").alias("_f"), F.sum("_x").alias("_x"), F.grouping_id().alias("_g"))
    dimension, value = F.lit("all"), F.lit(None).cast("string")
    full = (1 << len(names)) - 1
    for k, n in enumerate(names):
        own = F.col("_g") == full - (1 << (len(names) - 1 - k))
        dimension, value = F.when(own, n).otherwise(dimension), F.when(own, F.col(n)).otherwise(value)
    pct = lambda c: F.round(F.col(c) * 100 / F.col("n"), 2)
    return g.select(dimension.alias("dimension"), value.alias("value"), "n", pct("_f").alias("failed_pct"), pct("_x").alias("foreign_pct"), (F.col("n") < thin).alias("thin"))


def stage_costs(steps: DataFrame) -> DataFrame:
    """(stage, steps, seconds, cost) and a row of totals (stage null)."""
    return steps.rollup("stage").agg(F.count("*").alias("steps"), F.round(F.sum("seconds"), 3).alias("seconds"), F.round(F.sum("cost"), 6).alias("cost"))


def bounded_size(value: Column, kind: Column) -> Column:
    """A long value by its size alone: objects and lists as ``object(n)`` and
    ``array(n)``, other values as they are."""
    doc = F.try_parse_json(value)
    size = F.when(kind == "array", F.size(F.try_variant_get(doc, "$", "array<variant>"))).otherwise(F.size(F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>"))))
    return F.when(kind.isin("array", "object"), F.concat(kind, F.lit("("), F.coalesce(size, F.lit(0)).cast("string"), F.lit(")"))).otherwise(value)


def expected_names(cells: DataFrame) -> DataFrame:
    """(name): documents that a complete run has: one for each cell and each topic,
    coverage, conflicts, manifest."""
    c = cells.select(F.concat(F.lit("cells/"), F.col("cell_id"), F.lit(".json")).alias("name"))
    t = cells.select(F.concat(F.lit("topics/"), F.split_part("cell_id", F.lit("__"), F.lit(1)), F.lit(".json")).alias("name")).distinct()
    rest = cells.sparkSession.createDataFrame([(n,) for n in ("coverage.json", "alias_conflicts.json", "manifest.json")], "name string")
    return c.unionByName(t).unionByName(rest)
