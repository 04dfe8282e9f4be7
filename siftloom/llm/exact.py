"""Exact dedup of an incoming batch against immutable snapshots.

A snapshot is written once: the distinct texts that a batch added, in buckets by
digest, and a static binary-fuse filter for each bucket beside them. Incoming
digests meet the filters of their bucket; only what a filter lets through joins
the snapshot's exact buckets, where bytes are compared. Duplicates within the new
batch are grouped separately.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fuse
from .common import positional, written
from .sharding import stable_key

FILTERS = "bucket int, filter binary"


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("\x00null"))))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("dg"), F.lit(buckets)).cast("int")


#: Suspect digests up to this many are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Digests that one bucket, and with it one filter, holds about.
BUCKET_ROWS = 2_000_000


@dataclass
class Snapshot:
    """``rows`` (bucket, dg, id, text) are the exact buckets, a row for each text;
    ``filters`` (bucket, filter)."""

    rows: DataFrame
    filters: DataFrame
    buckets: int


def build_filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One binary-fuse filter for each bucket of (dg) rows, of some ``BUCKET_ROWS`` each."""

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "filter": [fuse.build(pdf["k"].to_numpy(np.int64).view(np.uint64))]})

    keyed = digests.select(_bucket(buckets).alias("bucket"), F.xxhash64(F.lit(3), "dg").alias("k"))
    return keyed.groupBy("bucket").applyInPandas(make, FILTERS)


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Rows (dg, ...) of ``incoming`` that the snapshot's filters let through."""
    schema = incoming.schema

    def sift(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(rows), bool)
        for blob in filters["filter"]:
            hit |= fuse.contains(bytes(blob), rows["k"].to_numpy(np.int64).view(np.uint64))
        return rows.loc[hit, [f.name for f in schema]]

    left = incoming.select("*", _bucket(snapshot.buckets).alias("bucket"), F.xxhash64(F.lit(3), "dg").alias("k")).groupBy("bucket")
    return left.cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(sift, schema)


def dedup_batch(batch: DataFrame, snapshots: list[Snapshot]) -> tuple[DataFrame, DataFrame]:
    """((id, kept_id) for each row of ``batch`` (dg, id, text), (dg, id, text) of the
    texts that it adds). ``kept_id`` is the document that stands for the text, in the
    earliest snapshot that has it, else in the batch."""
    # only digests move at first; texts follow for digests met more than once
    own = batch.groupBy("dg").agg(F.count("*").alias("n"))
    inside = own.where(F.col("n") > 1).select("dg")
    passed = [screen(own.select("dg"), s) for s in snapshots]
    suspects, _ = written(reduce(lambda a, b: a.unionByName(b), passed, inside).distinct(), "exact-suspects")
    if suspects.count() <= BROADCAST_ROWS:
        suspects = F.broadcast(suspects)
    new = len(snapshots)
    everyone = reduce(
        lambda a, b: a.unionByName(b),
        [r.join(suspects, "dg", "left_semi").select("dg", "text", F.lit(k).alias("age"), "id") for k, r in enumerate([*(s.rows for s in snapshots), batch])],
    )
    # byte checks: one head for each text, not for each digest; copies are combined before they move
    first = F.min(F.struct("age", F.col("id").isNull().alias("none"), "id"))
    heads, _ = written(everyone.groupBy("dg", "text").agg(first.alias("first")), "exact-heads")
    several = heads.groupBy("dg").agg(F.count("*").alias("n"), F.min("first.id").alias("kept_id"))
    # rows find their head by the digest, by the text too where a digest has several texts
    one = several.where("n = 1").select("dg", "kept_id")
    if heads.count() <= BROADCAST_ROWS:
        one = F.broadcast(one)
    rows = batch.select("dg", "id")
    results = [rows.join(one, "dg").select("id", "kept_id"), rows.join(suspects, "dg", "left_anti").select("id", F.col("id").alias("kept_id"))]
    odd = several.where("n > 1").select("dg")
    if not odd.isEmpty():
        by_text = heads.join(odd, "dg", "left_semi").select("dg", F.col("text").alias("_t"), F.col("first.id").alias("kept_id"))
        results.append(batch.join(by_text, (batch["dg"] == by_text["dg"]) & batch["text"].eqNullSafe(by_text["_t"])).select("id", "kept_id"))
    alone = batch.join(suspects, "dg", "left_anti").select("dg", "id", "text")
    added = heads.where(F.col("first.age") == new).select("dg", "first.id", "text")
    return reduce(lambda a, b: a.unionByName(b), results), alone.unionByName(added)


def take_snapshot(added: DataFrame, buckets: int) -> Snapshot:
    """The snapshot of texts (dg, id, text) that a batch added, each of them once, so
    that buckets are even: written by bucket, and filters of what was written."""
    rows = added.select(_bucket(buckets).alias("bucket"), "dg", "id", "text")
    rows, _ = written(rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "dg"), "exact-snapshot")
    filters, _ = written(build_filters(rows.select("dg").distinct(), buckets), "exact-filters")
    return Snapshot(rows, filters, buckets)


def exact_dedup(docs: DataFrame, batches: int = 2, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept_id, duplicate) for each row of ``docs``.

    The table is taken in as ``batches`` successive batches (by a hash of the id).
    Each is deduplicated against immutable snapshots of what the earlier ones
    added. ``kept_id`` is the smallest id of the earliest batch that has the text;
    ``duplicate`` tells whether that is another document.

    Null texts equal each other and no other text; empty texts equal each other.
    A null id sorts after all others. Rows that repeat with one id are one
    document, not duplicates of it. Extra columns are not read; an empty table
    gives an empty result. Two rows of one id with different texts are both kept
    as that id's. ``buckets`` follows from the number of rows unless it is given.
    """
    spark = docs.sparkSession
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // BUCKET_ROWS))
    d, (i, t) = positional(docs, id_col, text_col)
    d = d.select(_digest(t).alias("dg"), F.col(i).alias("id"), F.col(t).alias("text"))
    results, snapshots = [], []
    for k in range(batches):
        part = d.where(F.pmod(stable_key(F.col("id")), F.lit(batches)) == k)
        found, added = dedup_batch(part, snapshots)
        results.append(found)
        if k < batches - 1:
            snapshots.append(take_snapshot(added, buckets))
    out = reduce(lambda a, b: a.unionByName(b), results)
    return out.select(F.col("id").alias("doc_id"), "kept_id", (~F.col("kept_id").eqNullSafe(F.col("id"))).alias("duplicate"))
