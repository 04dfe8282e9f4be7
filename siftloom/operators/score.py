"""Scores of classified items and the gates that accept or reject them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    weights: Mapping[str, float] = field(default_factory=lambda: {"relevance": 0.40, "quality": 0.25, "audience_fit": 0.20, "freshness": 0.15})
    half_life_days: float = 90.0
    least_relevance: float = 0.35
    least_quality: float = 0.30
    least_audience: float = 0.20
    least_composite: float = 0.40


def rounded(x: Column) -> Column:
    """Four decimals as SQL engines round binary doubles: the product with 10,000 to a
    whole number, halves away from zero. ``round(x, 4)`` looks at the decimal rendering,
    which is a half more often (.55485 times 10,000 is below 5548.5)."""
    return F.round(x * 10000) / 10000


def relevance(required: Column, boost: Column, excluded: Column, has_required: Column, has_vocabulary: Column) -> Column:
    """0 if an excluded term hits or none of the configured required ones does;
    else up to .68 for three required terms and .32 for three boosting ones. .68
    without a vocabulary."""
    share = lambda n: F.least(n, F.lit(3)) / 3
    score = F.lit(0.68) * share(required) + F.lit(0.32) * share(boost)
    return rounded(F.when(~has_vocabulary, 0.68).when((excluded > 0) | (has_required & (required == 0)), 0.0).otherwise(score))


def quality(title: Column, summary: Column, publisher: Column, published: Column, sources: Column) -> Column:
    """:func:`quality_of` the texts themselves."""
    there = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return quality_of(there(title), F.when(there(summary), F.char_length(summary)), there(publisher), published.isNotNull(), sources)


def quality_of(title: Column, summary_length: Column, publisher: Column, dated: Column, sources: Column) -> Column:
    """Parts for a title, a summary (half if it is shorter than 200 characters; null
    if there is none), a publisher and a date, and .08 for each further source up to
    .24; 1 at most."""
    part = (
        F.when(title, 0.22).otherwise(0.0)
        + F.when(summary_length < 200, 0.17).when(summary_length >= 200, 0.34).otherwise(0.0)
        + F.when(publisher, 0.22).otherwise(0.0)
        + F.when(dated, 0.22).otherwise(0.0)
    )
    return rounded(F.least(part + F.least(F.lit(0.08) * F.greatest(sources - 1, F.lit(0)), F.lit(0.24)), F.lit(1.0)))


def freshness(published: Column, as_of: Column, half_life_days: float = 90.0) -> Column:
    """Half after each half-life; a future date counts as now; null without a date."""
    # greatest() skips nulls, so the missing date is told apart
    age = F.greatest((F.unix_timestamp(as_of) - F.unix_timestamp(published)) / 86400.0, F.lit(0.0))
    return F.when(published.isNotNull(), rounded(F.pow(F.lit(0.5), age / half_life_days)))


def composite(scores: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Mean of the known dimensions by weight; null where none is known."""
    total = F.lit(0.0)
    weight = F.lit(0.0)
    for name, w in weights.items():
        known = scores[name].isNotNull()
        total = total + F.when(known, scores[name] * w).otherwise(0.0)
        weight = weight + F.when(known, w).otherwise(0.0)
    return rounded(F.when(weight > 0, total / weight))


def audience(excluded: Column, developer_tool: Column) -> tuple[Column, Column]:
    """(audience_fit, developer_only): an excluded item fits nobody here; if the
    signal for developers' tools fires for it, developers are its only audience."""
    return F.when(excluded, 0.0).otherwise(1.0), excluded & F.coalesce(developer_tool, F.lit(False))


#: Reasons in the order of their gates.
REASONS = ("developer_only_audience", "category_exclusion_applied", "insufficient_evidence", "off_topic", "below_relevance_threshold", "below_quality_threshold")


def decide(scored: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """``scored`` (relevance, quality, audience_fit, composite, excluded,
    developer_only, title, summary, has_required, required_hits) with accepted,
    rejection_reason and detail, which names the number that failed and its limit.
    The first gate that fails decides. ``off_topic`` is for cells that have required
    terms of which none hit. Thresholds in columns ``min_relevance``, ``min_quality``,
    ``min_audience_fit`` and ``accept_composite`` go before the policy's."""
    limits = {"min_relevance": policy.least_relevance, "min_quality": policy.least_quality, "min_audience_fit": policy.least_audience, "accept_composite": policy.least_composite}
    bar = lambda n: F.coalesce(F.col(n), F.lit(limits[n])) if n in scored.columns else F.lit(limits[n])
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    four = lambda c: F.format_string("%.4f", c)
    gates = [(c, n, F.coalesce(F.col(c) < bar(n), F.lit(True))) for c, n in (("relevance", "min_relevance"), ("quality", "min_quality"), ("audience_fit", "min_audience_fit"), ("composite", "accept_composite"))]
    text = lambda c, n, sign: F.concat(F.lit(f"{c} "), F.when(F.col(c).isNotNull(), four(F.col(c))).otherwise("unknown"), F.lit(f" {sign} {n} "), four(bar(n)))
    off = F.col("has_required") & (F.col("required_hits") == 0)
    reason = (
        F.when(F.col("excluded") & F.col("developer_only"), REASONS[0])
        .when(F.col("excluded"), REASONS[1])
        .when(blank("title") & blank("summary"), REASONS[2])
        .when(off, REASONS[3])
        .when(gates[0][2], REASONS[4])
        .when(gates[1][2], REASONS[5])
        .when(gates[2][2] | gates[3][2], REASONS[2])
    )
    detail = F.when(F.col("excluded"), "excluded by its category").when(blank("title") & blank("summary"), "no title and no summary").when(off, "none of the required terms occurs")
    for c, n, fails in gates:
        detail = detail.when(fails, text(c, n, "<"))
    detail = detail.otherwise(text("composite", "accept_composite", ">="))
    return scored.withColumns({"rejection_reason": reason, "detail": detail}).withColumn("accepted", F.col("rejection_reason").isNull())
