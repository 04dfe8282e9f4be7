"""Migration of a legacy case registry into records: validation, reviewed decisions,
facets from the reviewed map, records and rejections, and the report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning, urls
from . import validate

FIELDS = ("case_id", "case_key", "source_url", "source_title", "source_domain", "publication_date", "verification_status", "company", "industry", "workflow_before", "workflow_after", "ai_system_or_tool", "measurable_kpi", "kpi_value", "evidence_quote", "transformation_date", "confidence", "corroboration_count", "first_seen_at")
SUMMARY = (("Before", "workflow_before"), ("After", "workflow_after"), ("AI system", "ai_system_or_tool"))
REASON = (("KPI", "measurable_kpi"), ("Reported", "kpi_value"), ("Evidence", "evidence_quote"))


def registry_problems(cases: DataFrame) -> DataFrame:
    """Fields that are missing; cases without identifier, key or address, with a date
    of discovery that can't be read, or with an identifier that stands twice."""
    spark = cases.sparkSession
    fields = validate.field_problems(spark, cases.columns, FIELDS, cases.columns)
    if any(c not in cases.columns for c in FIELDS):
        return fields
    there = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    one = validate.report(
        cases,
        F.coalesce(F.col("case_id"), F.lit("?")),
        [(c, "is empty", there(c)) for c in ("case_id", "case_key", "source_url")] + [("first_seen_at", "is no date", cleaning.utc_time(F.col("first_seen_at")).isNotNull())],
    )
    twice = cases.groupBy("case_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("case_id").alias("subject"), F.lit("case_id").alias("path"), F.lit("stands twice").alias("message"))
    return validate.united(fields, one, twice)


def check_count(cases: DataFrame, expected: int) -> None:
    n = cases.count()
    if n != expected:
        raise ValueError(f"the registry holds {n} cases, not {expected}")


def review_problems(reviews: DataFrame, cases: DataFrame) -> DataFrame:
    """Reviews (case_id, legacy_source_url, decision, matched_rule, reviewer,
    reviewed_at): of unknown cases, of another address than the case's exact one, with
    an unknown decision, second ones, unsigned ones, of addresses that the guard
    doesn't refuse or refuses by another rule."""
    own = cases.select("case_id", F.col("source_url").alias("_url"), urls.suspicion(F.col("source_url")).alias("_rule"))
    x = reviews.join(own, "case_id", "left")
    known = F.col("_url").isNotNull()
    one = validate.report(
        x,
        F.col("case_id"),
        [
            ("case_id", "is no case", known),
            ("legacy_source_url", "isn't the case's own", ~known | (F.col("legacy_source_url") == F.col("_url"))),
            ("decision", "is neither admit nor reject", F.col("decision").isin("admit", "reject")),
            ("matched_rule", "isn't the rule that refuses the address", ~known | F.col("matched_rule").eqNullSafe(F.col("_rule")) & F.col("_rule").isNotNull()),
            ("reviewer", "is missing", F.trim("reviewer") != ""),
            ("reviewed_at", "is no time", cleaning.clock_time(F.col("reviewed_at")).isNotNull()),
        ],
    )
    twice = reviews.groupBy("case_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("case_id").alias("subject"), F.lit("case_id").alias("path"), F.lit("is reviewed twice").alias("message"))
    return one.unionByName(twice)


def legacy_industry(rows: DataFrame, value: str, legacy: DataFrame) -> DataFrame:
    """``rows`` with ``mapped``: the industry that the reviewed map (legacy_value,
    industry) gives the folded value, null where it has none. The map is a bounded
    configuration; of several rows for one key the smallest counts."""
    m = legacy.groupBy(cleaning.folded(F.col("legacy_value")).alias("_key")).agg(F.min("industry").alias("mapped"))
    return rows.withColumn("_key", cleaning.folded(cleaning.known(F.col(value)))).join(m, "_key", "left").drop("_key")


def facets(cases: DataFrame, legacy: DataFrame, support: DataFrame) -> DataFrame:
    """``cases`` with ``facet_industry``, ``facet_confidence``, ``facet_state`` and
    ``facet_unresolved``. A value without a mapping is told, not guessed at. Industries
    in ``support`` (industry, term) are asserted only where the legacy value mentions
    one of their terms. Functions and use cases aren't inferred, so nothing resolves."""
    x = legacy_industry(cases, "industry", legacy)
    gate = support.groupBy(F.col("industry").alias("mapped")).agg(F.collect_set(F.lower("term")).alias("_terms"))
    x = x.join(gate, "mapped", "left")
    value = cleaning.known(F.col("industry"))
    grounded = F.col("_terms").isNull() | F.exists("_terms", lambda t: F.contains(F.lower(value), t))
    taken = F.col("mapped").isNotNull() & grounded
    why = F.when(value.isNull(), "industry: insufficient_evidence: no value").when(F.col("mapped").isNull(), F.concat(F.lit("industry: unmapped_legacy_value: "), value)).when(~grounded, F.concat(F.lit("industry: insufficient_evidence: "), value))
    told = F.array_compact(F.array(why, F.lit("function: insufficient_evidence"), F.lit("use_case: insufficient_evidence")))
    return x.withColumns({"facet_industry": F.when(taken, F.col("mapped")), "facet_confidence": F.when(taken, F.lit(1.0)), "facet_state": F.lit("unresolved"), "facet_unresolved": told}).drop("mapped", "_terms")


def migrate(cases: DataFrame, reviews: DataFrame, legacy: DataFrame, support: DataFrame, topic: str, category: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejections) of the cases. An address that the guard refuses is
    rejected unless a review admits it; nothing is rewritten. Identity follows from
    the canonical address; dates and texts that say nothing are null; nothing counts
    as fetched, a quote makes a snippet."""
    decision = reviews.groupBy("case_id").agg(F.min("decision").alias("_decision"))
    x = cases.join(decision, "case_id", "left").withColumns({"_rule": urls.suspicion(F.col("source_url")), "identity_url": urls.canonical(F.col("source_url"))})
    refused = F.col("_rule").isNotNull() & (F.coalesce("_decision", F.lit("none")) != "admit")
    quote = cleaning.known(F.col("evidence_quote"))
    known = lambda c: cleaning.known(F.col(c))
    r = facets(x.where(~refused), legacy, support)
    records = r.select(
        urls.record_id(F.lit(topic), F.col("identity_url")).alias("record_id"),
        urls.content_id(F.col("identity_url")).alias("content_id"),
        F.lit(f"{topic}__{category}").alias("cell_id"),
        "identity_url",
        F.col("source_url").alias("target_url"),
        known("source_title").alias("title"),
        F.nullif(cleaning.labelled(*[(n, known(c)) for n, c in SUMMARY]), F.lit("")).alias("summary"),
        F.nullif(cleaning.labelled(*[(n, known(c)) for n, c in REASON]), F.lit("")).alias("curation_reason"),
        known("source_domain").alias("publisher"),
        cleaning.utc_text(cleaning.utc_time(F.col("publication_date"))).alias("published_at"),
        cleaning.utc_text(cleaning.utc_time(F.col("first_seen_at"))).alias("discovered_at"),
        F.lit("not_checked").alias("access_status"),
        F.when(quote.isNotNull(), "snippet_only").otherwise("unverified").alias("verification_status"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(known("industry"), known("ai_system_or_tool"))))).alias("tags"),
        "facet_industry", "facet_confidence", "facet_state", "facet_unresolved",
        F.struct(F.col("case_id").alias("id"), F.col("case_key").alias("key")).alias("legacy_id"),
        F.col("_rule").isNotNull().alias("admitted"),
    )
    rejected = x.where(refused).select("identity_url", F.col("source_url").alias("target_url"), "case_id", F.lit("suspicious_url").alias("rejection_reason"), F.concat(F.lit("refused by "), F.col("_rule"), F.when(F.col("_decision") == "reject", "; a reviewer confirmed it").otherwise("")).alias("detail"))
    return records, rejected


def identity_problems(records: DataFrame) -> DataFrame:
    """Identities that two records share, which is a finding about the registry."""
    parts = []
    for c in ("identity_url", "content_id", "record_id"):
        n = records.groupBy(c).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(n.select(F.col(c).alias("subject"), F.lit(c).alias("path"), F.lit("is shared").alias("message")))
    return validate.united(*parts)


def summary(cases: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: source, accepted and rejected counts, refused cases by decision."""
    d = reviews.groupBy("case_id").agg(F.min("decision").alias("d"))
    x = cases.select("case_id", urls.suspicion(F.col("source_url")).isNotNull().alias("s")).join(d, "case_id", "left")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    s, admit = F.col("s"), F.col("d") == "admit"
    return x.agg(
        F.count("*").alias("source_count"), n(~s | admit).alias("accepted_count"), n(s & ~F.coalesce(admit, F.lit(False))).alias("rejected_count"), n(s & admit).alias("reviewed_admit_count"),
        n(s & (F.col("d") == "reject")).alias("reviewed_reject_count"), n(s & F.col("d").isNull()).alias("unresolved_rejection_count"),
    )


def manifest(counts: dict, cell_id: str, run: str, at: str) -> dict:
    """The manifest of a migration, which fetches nothing and so is never publishable."""
    n = counts["accepted_count"]
    why = "no accepted records" if not n else f"all {n} records carry no target evidence"
    row = {"cell_id": cell_id, "status": "ok", "candidates": counts["source_count"], "accepted": n, "rejected": counts["rejected_count"], "requests_made": 0}
    return {"schema_version": 1, "harvest_run_id": run, "mode": "migration", "started_at": at, "finished_at": at, "cells": [row], "publication_eligible": False, "publication_ineligible_reason": why}


def empty_reviews(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "case_id string, legacy_source_url string, decision string, matched_rule string, reviewer string, reviewed_at string")


def registry_shape(cases: DataFrame, expected: Sequence[str] = FIELDS) -> DataFrame:
    """(field, rows, filled): how many cases have each field filled."""
    n = [F.struct(F.lit(c).alias("field"), F.count("*").alias("rows"), F.count_if(F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))).alias("filled")) for c in expected if c in cases.columns]
    return cases.agg(F.array(*n).alias("x")).select(F.inline("x"))
