"""Records, pointers between cells, run accounting and the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning, urls


def full_records(items: DataFrame) -> DataFrame:
    """Accepted items as records of their owner's cell; a sink sorts by :func:`order`."""
    return items.where("accepted").select(
        urls.record_id(F.col("topic"), F.col("identity_url")).alias("record_id"),
        urls.content_id(F.col("identity_url")).alias("content_id"),
        F.lit("full").alias("record_type"),
        "topic",
        "category",
        "identity_url",
        "title",
    )


#: Optional fields of a record by what they hold; absent ones are null.
TEXTS = ("title", "summary", "curation_reason", "publisher", "author", "language", "verification_evidence")
TIMES = ("published_at", "updated_at", "discovered_at", "last_checked_at")
SCORES = ("relevance", "quality", "audience_fit", "freshness")


def make_full(items: DataFrame, run: str, discovered_at: str) -> DataFrame:
    """Whole records of items (topic, category, identity_url, target_url, source_id,
    adapter; optionally any of the texts, times and scores, tags, content_hash,
    access_status, http_status, verification_status, canonical_url, rule_id, rationale).

    Every field is there. Texts that are blank or say unknown are null, times are
    ISO 8601 in UTC, tags a sorted set. A canonical address defaults to the identity,
    a discovery to ``discovered_at``, an access status to not checked, and without a
    rule the record stands where it was found."""
    have = set(items.columns)
    get = lambda c, kind="string": F.col(c) if c in have else F.lit(None).cast(kind)
    time = lambda c: cleaning.utc_text(F.col(c) if dict(items.dtypes).get(c) == "timestamp" else cleaning.utc_time(get(c)))
    tags = F.array_sort(F.array_distinct(F.filter(F.coalesce(get("tags", "array<string>"), F.array().cast("array<string>")), lambda t: F.trim(t) != "")))
    out = {"schema_version": F.lit(1), "record_type": F.lit("full"), "record_id": urls.record_id(F.col("topic"), F.col("identity_url")), "content_id": urls.content_id(F.col("identity_url")), "topic": F.col("topic"), "primary_category": F.col("category"), "cell_id": cleaning.cell_id(F.col("topic"), F.col("category")), "tags": tags}
    out |= {c: cleaning.known(get(c)) for c in TEXTS}
    out |= {"source_url": get("source_url"), "target_url": F.col("target_url"), "identity_url": F.col("identity_url"), "canonical_url": F.coalesce(get("canonical_url"), F.col("identity_url"))}
    out |= {c: time(c) for c in TIMES}
    out["discovered_at"] = F.coalesce(out["discovered_at"], F.lit(discovered_at))
    out |= {"access_status": F.coalesce(get("access_status"), F.lit("not_checked")), "http_status": get("http_status", "int"), "verification_status": F.coalesce(get("verification_status"), F.lit("unverified")), "content_hash": get("content_hash"), "harvest_run_id": F.lit(run)}
    out |= {f"{c}_score": get(c, "double") for c in SCORES}
    rule, why = F.coalesce(get("rule_id"), F.lit("fallback")), F.coalesce(get("rationale"), F.lit("no rule fired; kept in the cell of its discovery"))
    out |= {"classification": F.struct(rule.alias("rule_id"), why.alias("rationale")), "provenance": F.struct(F.col("source_id"), F.col("adapter").alias("source_adapter"))}
    return items.select(*[v.alias(k) for k, v in out.items()])


def evidence_projection(evidence: str) -> Column:
    """What a record keeps of evidence: signal and matched text."""
    return F.transform(evidence, lambda e: F.struct(e["signal"].alias("signal"), e["matched"].alias("matched")))


def order() -> list[Column]:
    """The total order of records: topic, category and identifier, nulls first."""
    return [F.coalesce(c, F.lit("")) for c in ("topic", "category", "record_id")]


def cross_references(items: DataFrame) -> DataFrame:
    """A pointer in each other topic that a competing rule named, once for each cell."""
    x = items.where("accepted").select("identity_url", F.col("topic").alias("owner"), F.explode("competing").alias("c")).where("c.topic <> owner")
    return x.select(
        urls.record_id(F.col("c.topic"), F.col("identity_url")).alias("record_id"),
        F.lit("cross_reference").alias("record_type"),
        F.col("c.topic").alias("topic"),
        F.col("c.category").alias("category"),
        "identity_url",
        urls.record_id(F.col("owner"), F.col("identity_url")).alias("duplicate_of"),
    ).distinct()


def dominant_reason(outcomes: DataFrame, by: str, precedence: Sequence[str]) -> DataFrame:
    """(by, reason, n): the most frequent reason of each cell, ties by precedence;
    reasons that the precedence lacks come after, by name."""
    place = F.coalesce(*[F.when(F.col("reason") == r, F.lit(k)) for k, r in enumerate(precedence)], F.lit(len(precedence)))
    n = outcomes.where(F.col("reason").isNotNull()).groupBy(by, "reason").agg(F.count("*").alias("n"))
    best = F.min_by(F.struct("reason", "n"), F.struct(-F.col("n"), place, "reason"))
    return n.groupBy(by).agg(best.alias("b")).select(by, "b.reason", "b.n")


def cell_status(cells: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Manifest rows: every configured cell with its counts; infrastructure errors go
    before adapter errors before an empty result; a cell without outcome wasn't run."""
    agg = outcomes.groupBy("cell_id").agg(
        F.sum("candidates").alias("candidates"),
        F.sum("accepted").alias("accepted"),
        F.sum("rejected").alias("rejected"),
        F.bool_or(F.col("error_class") == "infrastructure_error").alias("infra"),
        F.bool_or(F.col("error_class") == "adapter_error").alias("adapter"),
    )
    status = (
        F.when(F.col("candidates").isNull(), "not_run")
        .when((F.col("accepted") == 0) & F.coalesce("infra", F.lit(False)), "infrastructure_error")
        .when((F.col("accepted") == 0) & F.coalesce("adapter", F.lit(False)), "adapter_error")
        .when(F.col("accepted") == 0, "zero_result")
        .otherwise("ok")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return cells.join(agg, "cell_id", "left").select("cell_id", status.alias("status"), zero("candidates"), zero("accepted"), zero("rejected"))


def request_totals(requests: DataFrame, key: str, by: str) -> DataFrame:
    """Each request counts once, for the lane of the smallest name that made it."""
    once = requests.groupBy(key).agg(F.min(by).alias(by), F.max("attempts").alias("attempts"), F.max("retries").alias("retries"))
    return once.groupBy(by).agg(F.count("*").alias("requests"), F.sum("attempts").alias("attempts"), F.sum("retries").alias("retries"))


def publication(metrics: DataFrame) -> DataFrame:
    """(cell_id, eligible, reason): the first obstacle in a fixed order."""
    reason = (
        F.when(F.col("status") == "not_run", "cell_not_run")
        .when(F.col("status").isin("infrastructure_error", "adapter_error"), "errors")
        .when(F.col("accepted") == 0, "no_records")
        .when(F.col("unchecked") > 0, "unchecked_links")
    )
    return metrics.select("cell_id", reason.isNull().alias("eligible"), reason.alias("reason"))


def outcome_fan_out(outcomes: DataFrame, owners: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One outcome of each identity (its smallest row) given to all its owners."""
    one = outcomes.groupBy(key).agg(F.min(F.struct(*fields)).alias("o")).select(key, *[F.col(f"o.{c}").alias(c) for c in fields])
    return owners.join(one, key)
