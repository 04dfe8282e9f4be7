"""Persistent ledgers: keyed merges whose result doesn't depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PENDING = "pending"


def merge_observations(existing: DataFrame, observed: DataFrame, key: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """Merge observations (key, seen_at, outcome, ``latest`` columns) into a ledger
    (key, first_seen_at, last_seen_at, seen_count, outcome, ``latest``).

    First seen never moves, each observation counts once, the newest known value of
    a ``latest`` column wins. An outcome goes from pending to its first terminal
    value and stays; ``outcome_conflict`` tells that another terminal value came, now
    or, if the ledger has the column, before.
    """
    zero = F.lit(0)
    old = existing.select(*key, F.lit(0).alias("side"), F.col("last_seen_at").alias("at"), F.col("first_seen_at").alias("a"), F.col("last_seen_at").alias("z"), F.col("seen_count").cast("long").alias("n"), "outcome", (F.coalesce("outcome_conflict", F.lit(False)) if "outcome_conflict" in existing.columns else F.lit(False)).alias("was"), *latest)
    new = observed.select(*key, F.lit(1).alias("side"), F.col("seen_at").alias("at"), F.col("seen_at").alias("a"), F.col("seen_at").alias("z"), F.lit(1).cast("long").alias("n"), F.coalesce("outcome", F.lit(PENDING)).alias("outcome"), F.lit(False).alias("was"), *latest)
    terminal = F.when(F.col("outcome") != PENDING, F.col("outcome"))
    seq = F.struct("side", "at", "outcome")
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("side", "at", F.col(c).cast("string")))).alias(c) for c in latest]
    return (
        old.unionByName(new)
        .groupBy(*key)
        .agg(
            F.coalesce(F.min(F.when(F.col("side") == zero, F.col("a"))), F.min("a")).alias("first_seen_at"),
            F.max("z").alias("last_seen_at"),
            F.sum("n").alias("seen_count"),
            F.coalesce(F.min_by(terminal, F.when(terminal.isNotNull(), seq)), F.lit(PENDING)).alias("outcome"),
            (F.bool_or("was") | F.coalesce(F.min(terminal) != F.max(terminal), F.lit(False))).alias("outcome_conflict"),
            *known,
        )
    )


def merge_shards(shards: DataFrame, key: str) -> DataFrame:
    """Union of ledger shards: largest count, earliest first, latest last time, flags
    or-ed, id sets united. A missing flag is false. Ids are told apart one by one
    before they are gathered, so that only each key's set stands in a row."""
    rest = shards.groupBy(key).agg(
        F.max("crawl_count").alias("crawl_count"),
        F.min("first_crawled_at").alias("first_crawled_at"),
        F.max("last_crawled_at").alias("last_crawled_at"),
        F.bool_or(F.coalesce("extracted", F.lit(False))).alias("extracted"),
    )
    ids = shards.select(key, F.explode("case_ids").alias("_i")).groupBy(key).agg(F.array_sort(F.collect_set("_i")).alias("case_ids"))
    none = F.array().cast(shards.schema["case_ids"].dataType)
    return rest.join(ids, key, "left").withColumn("case_ids", F.coalesce("case_ids", none))


def append_new(ledger: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of the ledger, and of ``incoming`` one for each key that it lacks: the
    smallest row where several have it."""
    row = lambda d, side: d.select(key, F.struct(F.lit(side).alias("side"), *[F.col(c) for c in ledger.columns]).alias("r"))
    return row(ledger, 0).unionByName(row(incoming, 1)).groupBy(key).agg(F.min("r").alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in ledger.columns])


def patch(ledger: DataFrame, patches: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``ledger`` with the non-null values of its patches laid over; of several
    patches for one key the last known value by ``order`` counts, so rows never
    multiply. A patch without a row is ignored."""
    cols = [c for c in patches.columns if c != key and c in ledger.columns]
    latest = patches.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_{c}") for c in cols])
    joined = ledger.join(latest, key, "left")
    return joined.select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in ledger.columns])


def unseen(items: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Items whose key the ledger lacks; a null key is never in it."""
    return items.join(ledger.select(key).distinct(), key, "left_anti")


def rejections(verdicts: DataFrame) -> DataFrame:
    """Rejected items, each with its first source; a sink sorts them by reason and
    address."""
    first = F.get(F.array_sort("source_ids"), F.lit(0))
    return verdicts.where(~F.col("accepted")).select("identity_url", first.alias("source_id"), "rejection_reason", "composite")


def link_history(checks: DataFrame, key: str) -> DataFrame:
    """Checks of each link in order of time, with the hash seen before;
    ``changed_materially`` only where both hashes are known and differ."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy("checked_at", "check_id")
    before = F.lag("content_hash").over(w)
    out = checks.withColumn("place", F.row_number().over(w)).withColumn("previous_hash", before)
    return out.withColumn("changed_materially", F.coalesce(F.col("previous_hash") != F.col("content_hash"), F.lit(False)))
