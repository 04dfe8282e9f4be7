"""Fetch outcomes as rows: reasons and classes, evidence lines, what a budget leaves
out, snapshots with their owners, the pool's document, preflight rows, and the cache
of repository metadata. Nothing here fetches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from .links import FAILURES, access_status

ZERO_RESULT = ("no_items_in_window", "all_below_relevance_threshold", "all_rejected_quality", "all_duplicates_of_existing", "category_exclusion_applied", "no_links_matched_allowlist", "all_children_already_known")
ADAPTER_ERRORS = ("feed_parse_error", "unexpected_content_type", "empty_response", "schema_mapping_failed", "response_too_large", "index_parse_failed", "adapter_error")
INFRASTRUCTURE_ERRORS = ("robots_denied", "http_timeout", "http_4xx", "http_5xx", "dns_failure", "lease_timeout", "budget_exhausted", "circuit_open", "preflight_failed", "index_fetch_failed", "robots_denied_index")


def reason_class(reason: Column) -> Column:
    """Class of a reason. One that nobody knows is an adapter's error: the network
    can't make up reasons. Zero-result reasons are none; null stays null."""
    return F.when(reason.isNull() | reason.isin(*ZERO_RESULT), None).when(reason.isin(*INFRASTRUCTURE_ERRORS), "infrastructure_error").otherwise("adapter_error")


def failure(error_type: Column) -> Column:
    """(error_type, reason, result_class) of a failure; an unknown type is internal."""
    known = F.when(error_type.isin(*FAILURES), error_type).otherwise("internal_fetch_error")
    pick = lambda k: F.element_at(F.create_map(*[F.lit(x) for n, v in FAILURES.items() for x in (n, v[k])]), known)
    return F.when(error_type.isNotNull(), F.struct(known.alias("error_type"), pick(0).alias("reason"), pick(1).alias("result_class")))


def outcomes(fetches: DataFrame) -> DataFrame:
    """(requested_url, access_status, verification_status, verification_evidence,
    http_status, final_url, content_hash, error_class) of fetches (requested_url,
    http_status, error_type, message, final_url, redirects, permanent_redirect, body).

    A success says what came: status, final address, bytes, kind of redirect chain.
    A failure says its type, status and message. ``fetched`` means no more than that
    the fetch succeeded."""
    ok = F.col("error_type").isNull() & F.col("http_status").isNotNull()
    moved = F.coalesce("permanent_redirect", F.lit(False))
    size = F.coalesce(F.octet_length("body"), F.lit(0)).cast("string")
    status = F.concat(F.lit("http "), F.col("http_status").cast("string"))
    good = F.concat_ws("; ", status, F.concat(F.lit("final_url "), F.col("final_url")), F.concat(size, F.lit(" bytes")), F.when(moved, "permanent redirect").when(F.coalesce("redirects", F.lit(0)) > 0, "temporary or mixed redirect chain"))
    bad = F.concat_ws("; ", "error_type", status, F.nullif("message", F.lit("")))
    return fetches.select(
        "requested_url",
        access_status(F.col("http_status"), F.col("error_type"), moved).alias("access_status"),
        F.when(ok, "fetched").otherwise("unverified").alias("verification_status"),
        F.when(ok, good).otherwise(bad).alias("verification_evidence"),
        "http_status",
        F.when(ok, F.col("final_url")).alias("final_url"),
        F.when(ok, F.sha2(F.coalesce("body", F.lit(b"")), 256)).alias("content_hash"),
        F.col("error_type").alias("error_class"),
    )


def within_budget(items: DataFrame, by: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """``items`` with ``access_status``: ``not_checked`` for those that come after the
    first ``most`` of their group, null (to be fetched) for the others. Nothing is
    requested for what a budget leaves out, and nothing claimed."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return items.withColumn("access_status", F.when(n > most, "not_checked"))


def charged(requests: DataFrame, scopes: Mapping[str, tuple[str, int]], order: Sequence[str], charge: str = "charge") -> DataFrame:
    """``requests`` with ``granted`` and ``exhausted_scope`` under nested caps: a
    request is charged before it is made, to every scope or to none; the first scope
    (outermost first) whose running sum would pass its cap refuses it.

    ``scopes`` maps a name to (column that names the scope's instance, cap). A scope
    counts what the scopes before it granted and all it grants itself: within one
    scope requests of one size are refused from the first refusal on, which makes the
    caps running sums. Charges must be equal, as those of single requests are."""
    x = requests.withColumn("exhausted_scope", F.lit(None).cast("string"))
    for name, (column, cap) in sorted(scopes.items(), key=lambda s: -list(scopes).index(s[0])):
        # inner scopes first: what they refuse is never charged to the outer ones
        w = Window.partitionBy(column).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = F.sum(F.when(F.col("exhausted_scope").isNull(), F.col(charge)).otherwise(0)).over(w)
        x = x.withColumn("_run", run).withColumn("exhausted_scope", F.coalesce("exhausted_scope", F.when(F.col("_run") > cap, F.lit(name)))).drop("_run")
    return x.withColumn("granted", F.col("exhausted_scope").isNull())


def source_rows(results: DataFrame) -> DataFrame:
    """(source_id, adapter, result, reason, candidates, accepted, requests_made) of
    each source of a cell. A source that failed is a row like any other; counts that
    are unknown are 0 and a failure's class is its result."""
    cls = reason_class(F.col("reason"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return results.select("source_id", "adapter", F.coalesce(cls, F.when(F.coalesce("candidates", F.lit(0)) == 0, "zero_result").otherwise("ok")).alias("result"), "reason", zero("candidates"), zero("accepted"), zero("requests_made"))


def preflight_rows(catalog: DataFrame, probes: DataFrame, selection: Sequence[str] | None = None) -> DataFrame:
    """(source_id, url, result, reason, http_status) of each selected source, probed
    once. Sources that weren't probed are ``not_run``; the identifier is the
    configuration's. An unknown or repeated name in the selection is refused."""
    if selection is not None:
        if not selection or len(set(selection)) < len(selection):
            raise ValueError("a selection names at least one source, each of them once")
        known = {r["source_id"] for r in catalog.where(F.col("source_id").isin(*selection)).select("source_id").collect()}
        if unknown := sorted(set(selection) - known):
            raise ValueError(f"not configured: {', '.join(unknown)}")
        catalog = catalog.where(F.col("source_id").isin(*selection))
    first = probes.groupBy("url").agg(F.min(F.struct("probed_at", "http_status", "error_type")).alias("p"))
    f = failure(F.col("p.error_type"))
    result = F.when(F.col("p").isNull(), "not_run").when(F.col("p.error_type").isNull(), "ok").otherwise(f["result_class"])
    return catalog.join(first, "url", "left").select("source_id", "url", result.alias("result"), f["reason"].alias("reason"), F.col("p.http_status").alias("http_status"))


def snapshots(fetches: DataFrame) -> DataFrame:
    """One immutable view of each source in a run, from fetches (source_request_key,
    lane_id, round, http_status, fetched_at, body, attempts, retries, redirect_hops,
    conditional, reused).

    Only a 200 or a 304 establishes a view, the earliest one; later rounds reuse it.
    The owner is the smallest lane, not the one that came first. Attempts are those
    of the fetch that established the view."""
    usable = F.col("http_status").isin(200, 304)
    order = F.struct("fetched_at", "lane_id", "round")
    first = F.min_by(F.struct(F.col("http_status").cast("string").alias("established_by"), F.col("fetched_at").alias("established_at"), F.sha2(F.coalesce("body", F.lit(b"")), 256).alias("body_sha256"), "attempts", "retries", "redirect_hops", F.col("conditional").cast("int").alias("conditional_revalidations")), F.when(usable, order))
    per = fetches.groupBy("source_request_key").agg(
        first.alias("s"),
        F.array_sort(F.collect_set("lane_id")).alias("contributing_lanes"),
        F.array_sort(F.collect_set(F.when(F.col("reused"), F.col("round")))).alias("reused_in_rounds"),  # numbers, in their own order
    )
    return per.select("source_request_key", "s.*", F.array_min("contributing_lanes").alias("designated_owner_lane_id"), "contributing_lanes", "reused_in_rounds")


def pool_candidates(sightings: DataFrame) -> DataFrame:
    """Candidates of a run's pool from sightings (target_url, lane_id,
    source_request_key, fetched, extracted): one for each canonical identity, with all
    lanes that contributed and owners designated by name; an owner is null where the
    work wasn't done. Addresses without an identity are no candidates."""
    x = sightings.withColumn("canonical_key", urls.canonical(F.col("target_url"))).where(F.col("canonical_key").isNotNull())
    per = x.groupBy("canonical_key").agg(
        F.min("target_url").alias("target_url"),
        F.array_sort(F.collect_set("lane_id")).alias("contributing_lanes"),
        F.array_sort(F.collect_set("source_request_key")).alias("source_request_keys"),
        F.bool_or("fetched").alias("_f"),
        F.bool_or("extracted").alias("_e"),
    )
    lane = F.array_min("contributing_lanes")
    return per.select(
        urls.content_id(F.col("canonical_key")).alias("candidate_key"), "target_url", "canonical_key", lane.alias("primary_discovery_lane_id"), "contributing_lanes", "source_request_keys",
        F.when(F.col("_f"), lane).alias("designated_target_fetch_owner_lane_id"), F.when(F.col("_e"), lane).alias("designated_extraction_owner_lane_id"),
    )


def lanes_registered(registrations: DataFrame) -> DataFrame:
    """(lane_id, round, kind): each lane once, as it was first registered; what was
    said first counts, by round and kind, not by arrival."""
    first = F.min(F.struct("round", "kind"))
    return registrations.groupBy("lane_id").agg(first.alias("f")).select("lane_id", "f.round", "f.kind")


def repositories_to_ask(hits: DataFrame, url: str, cache: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """(repository, state, stars): each repository that the hits name, ``fresh`` from
    the cache if it was asked within ``days`` and found or surely not there, else
    ``fetch``."""
    named = hits.select(urls.repository_root(F.col(url)).alias("repository")).where(F.col("repository").isNotNull()).distinct()
    fresh = F.coalesce(F.col("status").isin("ok", "not_found") & F.datediff(today, "fetched_at").between(0, days), F.lit(False))
    newest = cache.groupBy(F.lower("repository").alias("repository")).agg(F.max_by(F.struct("fetched_at", "status", "stars"), F.struct("fetched_at", "status")).alias("c")).select("repository", "c.*")
    return named.join(newest, "repository", "left").select("repository", F.when(fresh, "fresh").otherwise("fetch").alias("state"), F.when(fresh, F.col("stars")).alias("stars"))


def repository_answer(status: Column, body: Column, remaining: Column) -> Column:
    """What an answer about a repository is: ``ok``, ``not_found``, ``rate_limited``,
    ``malformed`` or ``transient``."""
    doc = F.try_parse_json(body)
    named = F.try_variant_get(doc, "$.full_name", "string").isNotNull()
    return (
        F.when(status.isin(404, 410, 451), "not_found")
        .when((status == 429) | ((status == 403) & (F.coalesce(remaining, F.lit(1)) == 0)), "rate_limited")
        .when(status == 200, F.when(named, "ok").otherwise("malformed"))
        .otherwise("transient")
    )


def repository_facts(body: Column) -> Column:
    """The few fields of an answer that are kept."""
    doc = F.try_parse_json(body)
    get = lambda p, k: F.try_variant_get(doc, f"$.{p}", k)
    return F.struct(F.lower(get("full_name", "string")).alias("repository"), get("stargazers_count", "long").alias("stars"), get("pushed_at", "string").alias("pushed_at"), get("archived", "boolean").alias("archived"), get("topics", "array<string>").alias("topics"))


def accounting(outcomes: DataFrame, key: str) -> DataFrame:
    """One row of totals over fetches, each key counted once."""
    once = outcomes.groupBy(key).agg(*[F.max(c).alias(c) for c in ("attempts", "retries", "redirect_hops", "request_charges")])
    return once.agg(F.count("*").alias("fetches"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("attempts", "retries", "redirect_hops", "request_charges")])
