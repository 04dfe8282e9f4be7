"""Caps, survivors and streaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def survivors(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order`` and then by everything in the row."""
    rest = [c for c in sorted(rows.columns) if c not in order]
    w = Window.partitionBy(key).orderBy(*order, *rest)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def accepted_prefix(rows: DataFrame, cell: str, order: Sequence[str], accepted: str, most: int) -> DataFrame:
    """Rows of each cell in order up to and including its ``most``-th accepted one.
    Rows that ``order`` leaves tied go by everything in them, so what is kept doesn't
    depend on how they arrive; unaccepted ones go first, as nothing says they are late."""
    rest = [c for c in (accepted, *sorted(rows.columns)) if c not in order]
    w = Window.partitionBy(cell).orderBy(*order, *dict.fromkeys(rest)).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col(accepted).cast("int")).over(w), F.lit(0))
    return rows.withColumn("_b", before).where(F.col("_b") < most).drop("_b")


def capped(rows: DataFrame, by: str, order: Sequence[str], most: int) -> DataFrame:
    """The first ``most`` rows of each ``by``, with their place."""
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def cap_report(rows: DataFrame, by: str, most: int) -> DataFrame:
    """(by, total, kept, dropped) under a cap."""
    n = F.count("*")
    return rows.groupBy(by).agg(n.alias("total"), F.least(n, F.lit(most)).alias("kept"), F.greatest(n - most, F.lit(0)).alias("dropped"))


def streaks(rounds: DataFrame, by: str, order: Sequence[str], progress: str) -> DataFrame:
    """``rounds`` with ``no_progress``: rounds without progress in a row so far."""
    w = Window.partitionBy(by).orderBy(*order)
    island = F.sum(F.col(progress).cast("int")).over(w)
    inner = Window.partitionBy(by, "_island").orderBy(*order)
    counted = F.sum((~F.col(progress)).cast("int")).over(inner)
    return rounds.withColumn("_island", island).withColumn("no_progress", counted).drop("_island")
