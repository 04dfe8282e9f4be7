"""Deliveries into observations and observations into candidate groups.

Order comes from content: role, source, position, address. Nothing depends on the
order in which rows arrive, and no conflicting value is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ("role_rank", "source_id", "position", "target_url")


def role_rank(role: Column) -> Column:
    return F.when(role == "validation_seed", 0).when(role == "discovery", 1).otherwise(2)


def observations(deliveries: DataFrame, payload: list[str], keep: list[str] = []) -> DataFrame:
    """One row for each (source_id, position, target_url): the lanes that delivered
    it, sorted, and its payload. ``conflict`` tells that deliveries of one
    observation differ, which a caller should refuse."""
    one = F.struct(*payload)
    return (
        deliveries.groupBy("source_id", "position", "target_url")
        .agg(
            F.array_sort(F.collect_set("lane_id")).alias("lane_ids"),
            F.min(one).alias("_p"),
            (~F.min(one).eqNullSafe(F.max(one))).alias("conflict"),
            *[F.min(c).alias(c) for c in keep],
        )
        .select("source_id", "position", "target_url", "lane_ids", "conflict", *[F.col(f"_p.{c}").alias(c) for c in payload], *keep)
    )


def _present(c: str) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def groups(obs: DataFrame, key: str, display: list[str]) -> DataFrame:
    """One row for each candidate: count, sorted sources and lanes, the first
    non-blank value of each ``display`` column in the total order, and the first
    observation's address. Rows with a null key aren't candidates."""
    order = F.struct(*ORDER)
    own = obs.where(F.col(key).isNotNull())
    return own.groupBy(key).agg(
        F.count("*").alias("observation_count"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("lane_ids")))).alias("lane_ids"),
        F.min_by("target_url", order).alias("first_url"),
        *[F.min_by(c, F.when(_present(c), order)).alias(c) for c in display],
    )


def variants(obs: DataFrame, key: str, column: str) -> DataFrame:
    """(key, value, place, sources) of each distinct non-blank value of a column, in
    order of first appearance, with the sources that gave it."""
    first = (
        obs.where(F.col(key).isNotNull() & _present(column))
        .groupBy(key, F.col(column).alias("value"))
        .agg(F.min(F.struct(*ORDER)).alias("_o"), F.array_sort(F.collect_set("source_id")).alias("sources"))
    )
    per = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_o", "value", "sources"))).alias("_v"))
    return per.select(key, F.posexplode("_v").alias("n", "_e")).select(key, F.col("_e.value").alias("value"), (F.col("n") + 1).alias("place"), F.col("_e.sources").alias("sources"))


def contexts(obs: DataFrame, key: str) -> DataFrame:
    """(key, contexts): distinct (topic, category) in order of first appearance."""
    first = obs.where(F.col(key).isNotNull()).groupBy(key, "topic", "category").agg(F.min(F.struct(*ORDER)).alias("o"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "topic", "category"))), lambda x: F.struct(x["topic"].alias("topic"), x["category"].alias("category"))).alias("contexts"))


def sightings(obs: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Observations, unique candidates, repeats and unusable items; observations are
    the sum of unique and repeats."""
    usable = F.col(key).isNotNull()
    n, unique = F.count_if(usable), F.count_distinct(key)
    return obs.groupBy(*by).agg(n.alias("observations"), unique.alias("unique_candidates"), (n - unique).alias("repeats"), F.count_if(~usable).alias("unusable"))


def extraction_issues(items: DataFrame, fields: list[str], date: str, variants: dict[str, str] | None = None) -> DataFrame:
    """``items`` with ``issues``: sorted (field, kind) of what is missing, says
    unknown, is a date that can't be read, or has conflicting values: ``variants``
    names, for a field, the array column of the values that its sources gave."""
    from ..functions.cleaning import utc_time

    found = []
    for f in fields:
        blank, unknown = F.coalesce(F.trim(f) == "", F.lit(True)), F.coalesce(F.lower(F.trim(f)) == "unknown", F.lit(False))
        kind = F.when(blank, "missing").when(unknown, "unknown_sentinel")
        if f == date:
            kind = kind.when(utc_time(F.col(f)).isNull(), "unparseable_date")
        found.append(F.when(kind.isNotNull(), F.struct(F.lit(f).alias("field"), kind.alias("kind"))))
    for f, c in (variants or {}).items():
        several = F.size(F.array_distinct(F.filter(c, lambda v: F.trim(v) != ""))) > 1
        found.append(F.when(several, F.struct(F.lit(f).alias("field"), F.lit("conflicting_values").alias("kind"))))
    return items.withColumn("issues", F.array_sort(F.array_compact(F.array(*found))))
