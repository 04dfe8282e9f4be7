"""Incremental forms of the ledger operators (an extension: the batch result
defines what is right)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ledger import merge_observations
from ..sinks.publish import Store


def weekly_yield(events: DataFrame, time: str, by: str, width: str = "7 days", late: str = "1 day") -> DataFrame:
    """(window start, by, n) over event time; rows later than ``late`` are dropped."""
    w = F.window(time, width)
    return events.withWatermark(time, late).groupBy(w, by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def first_sightings(items: DataFrame, key: str, time: str, within: str = "1 day") -> DataFrame:
    """Each key once, as long as its repeats come within the watermark."""
    return items.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


class LedgerSink:
    """A ledger kept below ``path`` in buckets by key. A micro-batch merges into the
    buckets that its keys fall into and writes these as version ``epoch + 1``; a small
    manifest says which version each bucket has, so the others aren't touched.
    Replaying a batch makes the same version again, so nothing counts twice.
    ``outcome_conflict`` stays set once a key had two different terminal outcomes.
    Versions that none of the last ``keep`` manifests names go.

    ``buckets`` is fixed for a ledger: some hundred megabytes in each is a good size."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], latest: Sequence[str] = (), keep: int = 3, buckets: int = 64):
        self.spark, self.store = spark, Store(spark, path)
        self.key, self.latest, self.keep, self.buckets = list(key), list(latest), max(2, keep), buckets
        self.schema = schema if "outcome_conflict" in schema else f"{schema}, outcome_conflict boolean"

    def manifest(self, n: int) -> dict[str, int]:
        """Bucket -> version, as of version ``n``."""
        if n < 1:
            return {}
        raw = self.store.read(f"manifest-{n:08d}.json")
        if raw is None:
            raise ValueError(f"the ledger has no version {n}")
        return json.loads(raw)

    def _read(self, places: dict[str, int]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.store.root}/v{v:08d}/_b={b}" for b, v in sorted(places.items())])

    def version(self, n: int) -> DataFrame:
        return self._read(self.manifest(n))

    def write(self, batch: DataFrame, epoch: int) -> None:
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets))
        batch = batch.persist()
        try:
            before = self.manifest(epoch)
            touched = [str(r[0]) for r in batch.select(bucket).distinct().collect()]
            merged = merge_observations(self._read({b: before[b] for b in touched if b in before}), batch, self.key, self.latest)
            merged.withColumn("_b", bucket).repartition("_b").write.partitionBy("_b").mode("overwrite").parquet(f"{self.store.root}/v{epoch + 1:08d}")
        finally:
            batch.unpersist()
        now = before | dict.fromkeys(touched, epoch + 1)
        self.store.write_document(f"manifest-{epoch + 1:08d}.json", now)
        kept = [now, *(self.manifest(n) for n in range(max(1, epoch + 2 - self.keep), epoch + 1))]
        named = {v for m in kept for v in m.values()}
        for v in set(before.values()) | (set(self.manifest(epoch + 1 - self.keep).values()) if epoch + 1 - self.keep >= 1 else set()):
            if v not in named:
                self.store.delete(f"v{v:08d}")
        self.store.delete(f"manifest-{epoch + 1 - self.keep:08d}.json")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
