"""Coverage against targets, gap ranking, calibration and staleness reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def observed(records: DataFrame, key: str, axes: Mapping[str, str]) -> DataFrame:
    """(axis, slug, observed): distinct records with each value; array columns count
    once for each element."""

    def named(axis: str):
        return lambda v: F.struct(F.lit(axis).alias("axis"), v.alias("slug"))

    parts = []
    for axis, c in axes.items():
        values = F.col(c) if records.schema[c].dataType.typeName() == "array" else F.array(F.col(c))
        parts.append(F.transform(values, named(axis)))
    return records.select(key, F.explode(F.concat(*parts)).alias("x")).where("x.slug is not null").groupBy("x.axis", "x.slug").agg(F.count_distinct(key).alias("observed"))


def against_targets(vocabulary: DataFrame, counts: DataFrame) -> DataFrame:
    """Every vocabulary entry (axis, slug, tier, target) with what was observed and
    the gap that is left; entries that nothing has stand with 0."""
    seen = F.coalesce("observed", F.lit(0).cast("long"))
    return vocabulary.join(counts, ["axis", "slug"], "left").select("axis", "slug", "tier", "target", seen.alias("observed"), F.greatest(F.col("target") - seen, F.lit(0).cast("long")).alias("gap"))


#: Weights of the factors; the two rates are penalties.
WEIGHTS = {"remaining_gap": 0.30, "configured_priority": 0.20, "acceptance_yield": 0.15, "duplicate_rate": -0.10, "quality_rejection_rate": -0.10, "credible_source_available": 0.10, "remaining_budget": 0.05}
#: Recorded and reported, never sought.
NEVER = ("cross-industry", "other-unclear")
_TIERS = {"priority": 1.0, "standard": 0.5}


def rank_gaps(gaps: DataFrame, stats: DataFrame, budget: float, never: tuple[str, ...] = NEVER, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """(axis, slug, gap, factors, score, lane_id, not_opened_reason) of open gaps; the
    order is that of :func:`best_first`. Record-only tiers, ``never`` slugs and closed
    gaps are left out altogether, gaps without a credible source are marked."""
    x = gaps.where((F.col("gap") > 0) & (F.col("tier") != "record_only") & ~F.col("slug").isin(*never)).join(stats, ["axis", "slug"], "left")
    tier = F.lit(0.0)
    for name, w in _TIERS.items():
        tier = F.when(F.col("tier") == name, w).otherwise(tier)
    source = F.coalesce("has_source", F.lit(False))
    factors = {
        "remaining_gap": F.least(F.lit(1.0), F.col("gap") / F.greatest(F.col("target"), F.lit(1))),
        "configured_priority": tier,
        "acceptance_yield": F.coalesce("acceptance_yield", F.lit(0.5)),
        "duplicate_rate": F.coalesce("duplicate_rate", F.lit(0.0)),
        "quality_rejection_rate": F.coalesce("quality_rejection_rate", F.lit(0.0)),
        "credible_source_available": source.cast("double"),
        "remaining_budget": F.lit(float(budget)),
    }
    score = F.lit(0.0)
    for name, f in factors.items():
        score = score + F.lit(weights.get(name, 0.0)) * f
    return x.select(
        "axis", "slug", "gap", F.struct(*[f.alias(n) for n, f in factors.items()]).alias("factors"), F.round(score, 6).alias("score"),
        F.concat(F.lit("gap__"), F.col("axis"), F.lit("__"), F.col("slug")).alias("lane_id"), F.when(~source, "no_credible_source").alias("not_opened_reason"),
    )


def best_first() -> list[Column]:
    return [F.desc("score"), F.asc("axis"), F.asc("slug")]


def histogram(values: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """(bin, n) with [low, high) bins between ``edges``, below and above included;
    bins that nothing falls into stand with 0."""
    names = [f"<{edges[0]:g}", *[f"{a:g}-{b:g}" for a, b in zip(edges, edges[1:])], f">={edges[-1]:g}"]
    bins = [F.count_if(F.col(column) < edges[0])]
    bins += [F.count_if((F.col(column) >= a) & (F.col(column) < b)) for a, b in zip(edges, edges[1:])]
    bins += [F.count_if(F.col(column) >= edges[-1])]
    one = values.agg(F.array(*[F.struct(F.lit(n).alias("bin"), b.alias("n")) for n, b in zip(names, bins)]).alias("x"))
    return one.select(F.inline("x"))


def headroom(values: DataFrame, by: str, column: str, threshold: float, cap: int) -> DataFrame:
    """How many pass the threshold for each place under the cap, and a verdict."""
    ratio = F.count_if(F.col(column) >= threshold) / F.lit(cap)
    out = values.groupBy(by).agg(F.count_if(F.col(column) >= threshold).alias("passing"), F.round(ratio, 4).alias("headroom"))
    return out.withColumn("verdict", F.when(F.col("headroom") >= 1.5, "OK").when(F.col("headroom") >= 1.0, "TIGHT").otherwise("LOW"))


def kth_largest(values: DataFrame, by: str, column: str, k: int) -> DataFrame:
    """(by, threshold): the k-th largest value, or the smallest where there are fewer."""
    w = Window.partitionBy(by).orderBy(F.desc(column))
    top = values.where(F.col(column).isNotNull()).withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)
    return top.groupBy(by).agg(F.min(column).alias("threshold"))


def shares(rows: DataFrame, by: str) -> DataFrame:
    """(value, n, share_pct) with whole percents rounded down."""
    n = rows.groupBy(F.col(by).alias("value")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select("value", "n", F.floor(F.col("n") * 100 / F.col("total")).alias("share_pct"))


def is_stale(last_run: Column, due: Column, as_of: Column, refresh_days: int, active: Column) -> Column:
    """Active, and run too long ago or due; without a due date never due."""
    old = F.datediff(as_of, last_run) >= refresh_days
    return active & (F.coalesce(old, F.lit(False)) | F.coalesce(F.to_date(due) <= F.to_date(as_of), F.lit(False)))


def lifecycle(status: Column, runs: Column, found: Column) -> Column:
    """A query that ran three times without a find is paused."""
    return F.when((status == "active") & (runs >= 3) & (found == 0), "paused").otherwise(status)
