"""Editorial policies over rows: date windows, confidence bands, proposals, query
expansion, verification, backfill, tiers and vocabulary rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import ascii_key
from ..functions.urls import match_key


def date_window(day: Column, start: str, soft_start: str, end: str) -> Column:
    """``reject`` after the end or before the soft start, ``flag`` between the soft
    start and the start, ``accept`` within; an unknown date is ``context``."""
    return F.when(day.isNull(), "context").when((day > F.lit(end).cast("date")) | (day < F.lit(soft_start).cast("date")), "reject").when(day < F.lit(start).cast("date"), "flag").otherwise("accept")


def capped_confidence(confidence: Column, verdict: Column) -> Column:
    """A flagged date caps the confidence at .4."""
    return F.when(verdict == "flag", F.least(confidence, F.lit(0.4))).otherwise(confidence)


def band(confidence: Column) -> Column:
    return F.when(confidence >= 0.9, "very_high").when(confidence >= 0.7, "high").when(confidence >= 0.5, "medium").when(confidence >= 0.3, "low").otherwise("very_low")


def is_fresh(published: Column, today: Column, days: int) -> Column:
    """Published within the last ``days``; the future and the unknown aren't fresh."""
    age = F.datediff(today, published)
    return F.coalesce((age >= 0) & (age <= days), F.lit(False))


def proposals(evidence: DataFrame, known: DataFrame, label: str, source: str, least: int = 3) -> DataFrame:
    """(label, sources) of labels with evidence from at least ``least`` independent
    sources, unless the label is active or was rejected."""
    n = evidence.groupBy(label).agg(F.count_distinct(source).alias("sources")).where(F.col("sources") >= least)
    return n.join(known.where(F.col("status").isin("active", "rejected")).select(label).distinct(), label, "left_anti")


def new_queries(proposed: DataFrame, existing: DataFrame, query: str) -> DataFrame:
    """Proposed queries that aren't there yet, compared by key; the smallest of
    several that have one key."""
    have = existing.select(ascii_key(F.col(query)).alias("_k")).distinct()
    return proposed.groupBy(ascii_key(F.col(query)).alias("_k")).agg(F.min(query).alias(query)).join(have, "_k", "left_anti").select(query)


def stamped(queries: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Active queries with one more run and what it found added to their yield."""
    n = found.groupBy(key).agg(F.count("*").alias("_f"))
    active = F.col("status") == "active"
    return queries.join(n, key, "left").select(
        key, "status", F.when(active, F.col("run_count") + 1).otherwise(F.col("run_count")).alias("run_count"), F.when(active, F.col("yield_count") + F.coalesce("_f", F.lit(0))).otherwise(F.col("yield_count")).alias("yield_count")
    )


def verified(sources: DataFrame, key: str) -> DataFrame:
    """(key, verified): a source of tier A, a financial one of tier B, or two
    independent outlets."""
    ok = F.bool_or((F.col("tier") == "A") | ((F.col("tier") == "B") & (F.col("type") == "financial"))) | (F.count_distinct("outlet") >= 2)
    return sources.groupBy(key).agg(F.coalesce(ok, F.lit(False)).alias("verified"))


def index_of(vocabulary: DataFrame, rows: DataFrame, slug: str, key: str) -> DataFrame:
    """(slug, keys): every vocabulary entry with the sorted keys that carry it, none
    for entries that nothing carries."""
    have = rows.groupBy(slug).agg(F.array_sort(F.collect_set(key)).alias("keys"))
    return vocabulary.select(slug).distinct().join(have, slug, "left").select(slug, F.coalesce("keys", F.array().cast(have.schema["keys"].dataType)).alias("keys"))


def backfill_kind(items: DataFrame, hits: DataFrame, listed: DataFrame, url: str) -> DataFrame:
    """``items`` with ``kind``: where an address was found. Exact in the search hits,
    else by match key there, else in the lists, else unresolved."""
    exact = hits.select(F.col(url)).distinct().withColumn("_exact", F.lit(True))
    loose = hits.select(match_key(F.col(url)).alias("_k")).distinct().withColumn("_loose", F.lit(True))
    lists = listed.select(match_key(F.col(url)).alias("_k")).distinct().withColumn("_list", F.lit(True))
    x = items.join(exact, url, "left").withColumn("_k", match_key(F.col(url))).join(loose, "_k", "left").join(lists, "_k", "left")
    kind = F.when(F.col("_exact"), "exact_hit").when(F.col("_loose"), "normalized_hit").when(F.col("_list"), "listed").otherwise("unresolved")
    return x.withColumn("kind", kind).drop("_k", "_exact", "_loose", "_list")


def tiers(items: DataFrame, table: DataFrame, key: str, default: str = "evergreen") -> DataFrame:
    """``items`` with the tier that the table gives their key, or the default."""
    return items.join(table.select(key, "tier"), key, "left").withColumn("tier", F.coalesce("tier", F.lit(default)))


def target_minimum(entries: DataFrame, tier_defaults: DataFrame) -> DataFrame:
    """(slug, target): an entry's own override, else its tier's default."""
    return entries.join(tier_defaults, "tier", "left").select("slug", F.coalesce("override", "default_min").alias("target"))


def shared_slugs(vocabulary: DataFrame, axis: str, slug: str, sentinel: Sequence[str] = ()) -> DataFrame:
    """(slug, axes) of slugs that several axes have, which only sentinels may."""
    return vocabulary.where(~F.col(slug).isin(*sentinel)).groupBy(slug).agg(F.count_distinct(axis).alias("axes")).where("axes > 1")


def name_findings(names: DataFrame, name: str, longest: int = 120) -> DataFrame:
    """(name, finding) of matrix names that are empty, too long, hold a reserved
    character or stand twice whatever their case."""
    n = F.trim(F.col(name))
    one = F.array_compact(F.array(F.when(n == "", "empty"), F.when(F.length(n) > longest, "too_long"), F.when(n.rlike(r"[#_/\\|]"), "reserved")))
    single = names.select(name, F.explode(one).alias("finding"))
    twice = names.groupBy(F.lower(n).alias("_l")).agg(F.count("*").alias("_n"), F.min(name).alias(name)).where("_n > 1").select(name, F.lit("repeated").alias("finding"))
    return single.unionByName(twice)


def effective_interval(floor: Column, override: Column, crawl_delay: Column) -> Column:
    """Seconds between requests to a host: the strictest of what is known."""
    return F.greatest(floor, override, crawl_delay)


def concurrency(default: Column, override: Column) -> Column:
    return F.greatest(F.lit(1), F.least(default, override))
