"""Adaptive rounds: the configured cells first, then lanes for open gaps until a
reason to stop holds. The loop runs on the driver over a few numbers of each round;
the data stays distributed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .coverage import best_first

#: Reasons to stop in the order in which they are asked after a round.
STOPS = ("budget_exhausted", "duplicate_rate", "no_progress", "all_targets_met", "max_rounds")


@dataclass
class Result:
    """What a round's work found. ``duplicate_rate`` is null where nothing came."""

    new_accepted: int = 0
    duplicate_rate: float | None = None
    budget_exhausted: bool = False


@dataclass
class Round:
    number: int
    lanes: list[str]
    new_accepted: int = 0
    duplicate_rate: float | None = None
    stop_reason: str | None = None
    thresholds: dict = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    def published(self) -> dict:
        """What a manifest holds of a round."""
        return {"round": self.number, "lanes": self.lanes, "new_accepted": self.new_accepted, "duplicate_rate": self.duplicate_rate, "stop_reason": self.stop_reason, "thresholds": dict(self.thresholds)}


def plan_lanes(ranked: DataFrame, most: int) -> tuple[list[str], list[str]]:
    """(lanes to open, gaps skipped for want of a source): the best gaps up to
    ``most``; a gap is skipped if it comes before the last lane that is opened, or
    nothing more could be opened. Both lists are as bounded as the vocabulary is."""
    opened, skipped = [], []
    for r in ranked.select("lane_id", "not_opened_reason", "score", "axis", "slug").orderBy(*best_first()).collect():
        if r["not_opened_reason"]:
            skipped.append(r["lane_id"])
        elif len(opened) < most:
            opened.append(r["lane_id"])
        else:
            break
    return opened, skipped


def run_rounds(
    cells: Sequence[str],
    gaps: Callable[[float], DataFrame],
    work: Callable[[int, list[str]], Result],
    budget: Callable[[int], float] = lambda n: 1.0,
    thresholds: Mapping[str, float] | None = None,
    most_rounds: int = 3,
    most_lanes: int = 2,
    least_progress: int = 1,
    most_duplicates: float = 0.8,
) -> list[Round]:
    """The rounds that were run. Round 1 takes the configured cells and nothing else;
    later ones take lanes for the gaps that ``gaps(budget left)`` ranks. Where no
    lane can be opened the last round says whether every target is met or no source
    is credible. Progress is asked from the second round on. Thresholds are the same
    in every round."""
    rounds: list[Round] = []
    for n in range(1, most_rounds + 1):
        left = budget(n)
        lanes, skipped = (list(cells), []) if n == 1 else plan_lanes(gaps(left), most_lanes)
        now = Round(n, lanes, thresholds=dict(thresholds or {}), skipped=skipped)
        rounds.append(now)
        if n > 1 and not lanes:
            now.stop_reason = "no_credible_source" if skipped else "all_targets_met"
            return rounds
        got = work(n, lanes)
        now.new_accepted, now.duplicate_rate = got.new_accepted, got.duplicate_rate
        holds = (
            lambda: got.budget_exhausted or left <= 0,
            lambda: got.duplicate_rate is not None and got.duplicate_rate > most_duplicates,
            lambda: n > 1 and got.new_accepted < least_progress,
            lambda: gaps(left).isEmpty(),
            lambda: n == most_rounds,
        )
        now.stop_reason = next((name for name, holds_now in zip(STOPS, holds) if holds_now()), None)
        if now.stop_reason:
            return rounds
    return rounds


def link_sample(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of the total order; ``n`` must be 1 to 25."""
    if not 1 <= n <= 25:
        raise ValueError("a link check takes 1 to 25 records")
    return records.orderBy(*[F.coalesce(c, F.lit("")) for c in ("topic", "category", "record_id")]).limit(n)
