"""Shards of registries and batches: split and derived shards, guards, attempted
addresses, backfill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split(registry: DataFrame, by: str, known: Sequence[str]) -> dict[str, DataFrame]:
    """A shard for each known value of ``by``. A row of any other value is an error,
    for it would be in no shard."""
    odd = registry.where(~F.coalesce(F.col(by).isin(*known), F.lit(False))).select(by).distinct().limit(5).collect()
    if odd:
        raise ValueError(f"no shard for {by} {sorted(str(r[0]) for r in odd)}")
    return {k: registry.where(F.col(by) == k) for k in known}


def derived_shard(shard: DataFrame | None, union: DataFrame, by: str, value: str) -> DataFrame:
    """The shard itself, or where it is missing the union's rows of its value."""
    return union.where(F.col(by) == value) if shard is None else shard


def guarded(batch: DataFrame, by: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the topic, rows of other topics): the latter are reported, not merged."""
    own = F.coalesce(F.col(by) == value, F.lit(False))
    return batch.where(own), batch.where(~own)


def stamped(batch: DataFrame, cell: Mapping[str, str]) -> DataFrame:
    """``batch`` with the cell's own topic and category, whatever the rows said."""
    return batch.withColumns({k: F.lit(v) for k, v in cell.items()})


#: Members of a batch and their kinds.
BATCH = {"candidates": "array", "visited_urls": "array", "notes": "string"}


def batch_problem(body: Column, members: Mapping[str, str] = BATCH, required: Sequence[str] = ("candidates",)) -> Column:
    """Why a batch isn't one: not JSON, not an object, a required member missing, a
    member of another kind; null for a batch that can be read."""
    doc = F.try_parse_json(body)
    kind = F.schema_of_variant(doc)
    out = F.when(doc.isNull(), "not_json").when(~kind.startswith("OBJECT"), "not_an_object")
    for n in required:
        out = out.when(F.try_variant_get(doc, f"$.{n}", "variant").isNull(), f"missing_{n}")
    for n, k in members.items():
        got = F.schema_of_variant(F.try_variant_get(doc, f"$.{n}", "variant"))
        out = out.when(got.isNotNull() & (got != "VOID") & ~got.startswith(k.upper()), f"{n}_is_not_{k}")
    return out


def attempted(former: DataFrame, batch: DataFrame, url: str) -> DataFrame:
    """Addresses that were tried so far, each once; a sink sorts them."""
    return former.select(url).unionByName(batch.select(url)).where(F.col(url).isNotNull()).distinct()


def check_growth(before: int, after: int, what: str) -> None:
    """A merge never shrinks what it merges into."""
    if after < before:
        raise ValueError(f"{what} would shrink from {before} to {after} rows")


def backfilled(registry: DataFrame, found: DataFrame, key: str, column: str) -> DataFrame:
    """``registry`` with ``column`` from ``found`` laid over where that knows it; of
    several values for a key the smallest. Keys that the registry lacks are ignored."""
    one = found.groupBy(key).agg(F.min(column).alias("_v"))
    return registry.join(one, key, "left").withColumn(column, F.coalesce("_v", column)).drop("_v").select(*registry.columns)


def without_patch(db: DataFrame) -> DataFrame:
    """A case database without the ledger patch that its batch carried."""
    return db.drop("ledger_patch")


def duplicate_groups(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, place) of keys that stand more than once, the largest group first."""
    from pyspark.sql import Window

    n = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    # groups are numbered within their size first, so no task sees more than one size's groups
    sizes = n.groupBy("n").agg(F.count("*").alias("_c"))
    before = sizes.select("n", (F.sum("_c").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1))).alias("_b"))
    own = F.row_number().over(Window.partitionBy("n").orderBy(key))
    return n.withColumn("_r", own).join(before, "n").select(key, "n", (F.coalesce("_b", F.lit(0)) + F.col("_r")).alias("place"))


def rounds_in_order(rounds: Column) -> Column:
    """Round numbers as a sorted set: 10 comes after 2."""
    return F.array_sort(F.array_distinct(F.transform(rounds, lambda r: r.cast("int"))))


def lane_summary(lanes: DataFrame, records: DataFrame, target: int) -> DataFrame:
    """(lane, verified, state) of each configured lane: ``done`` with enough verified
    records, ``short`` with some, ``empty`` with none."""
    n = records.groupBy("lane").agg(F.count_if("verified").alias("verified"))
    v = F.coalesce("verified", F.lit(0).cast("long"))
    return lanes.join(n, "lane", "left").select("lane", v.alias("verified"), F.when(v >= target, "done").when(v > 0, "short").otherwise("empty").alias("state"))


def refresh_due(updated: Column, days: int) -> Column:
    """The day on which a query or case is looked at again."""
    return F.date_add(F.to_date(updated), days)


def refresh_needed(queries: DataFrame, stale: Column) -> bool:
    """Whether anything is stale, so that a refresh has work to do."""
    return not queries.where(stale).isEmpty()
