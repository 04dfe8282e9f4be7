"""Rule classification: one cell for each item, by ordered rules over signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.signals import Composite, Rule, Signal
from .scan import Search, scan


def classify(items: DataFrame, fields: Mapping[str, str], signals: Sequence[Signal | Composite], rules: Sequence[Rule], contexts: str | None = None) -> DataFrame:
    """``items`` with rule_id, topic, category, evidence, competing, rationale,
    ambiguous, differs_from_discovery.

    The rule of lowest order that fires wins; the other rules that fire compete,
    sorted by identifier. Where none fires the first discovery context (column
    ``contexts``: an array of (topic, category)) is taken under the rule
    ``fallback`` and the other contexts compete. Evidence is the first hit of each
    simple signal that fires.
    """
    found = scan(items, Search(fields, signals), items.columns)
    out = apply_rules(found, rules, contexts)
    return out.drop(*[f"on_{s.name}" for s in signals])


def apply_rules(found: DataFrame, rules: Sequence[Rule], contexts: str | None = None) -> DataFrame:
    """The rules over the flags ``on_<signal>`` and ``evidence`` of a scan."""

    def holds(r: Rule) -> Column:
        terms = [F.col(f"on_{n}") for n in r.all_of] + [~F.col(f"on_{n}") for n in r.none_of]
        return reduce(Column.__and__, terms, F.lit(True))

    one = lambda r: F.struct(F.lit(r.order).alias("order"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.topic).alias("topic"), F.lit(r.category).alias("category"))
    ordered = sorted(rules, key=lambda r: r.order)
    with_fired = found.withColumn("_fired", F.array_compact(F.array(*[F.when(holds(r), one(r)) for r in ordered])))
    none = F.size("_fired") == 0
    trio = lambda s, rule: F.struct(rule.alias("rule_id"), s["topic"].alias("topic"), s["category"].alias("category"))
    rest = lambda a: F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))
    ctx = F.col(contexts) if contexts else F.lit(None).cast("array<struct<topic:string,category:string>>")
    ctx = F.coalesce(ctx, F.array().cast("array<struct<topic:string,category:string>>"))
    head, home = F.get("_fired", F.lit(0)), F.get(ctx, F.lit(0))
    topic, category = F.when(none, home["topic"]).otherwise(head["topic"]), F.when(none, home["category"]).otherwise(head["category"])
    lost = F.array_sort(F.transform(rest(F.col("_fired")), lambda s: trio(s, s["rule_id"])))
    other = F.array_sort(F.transform(rest(ctx), lambda s: trio(s, F.lit("fallback"))))
    out = with_fired.withColumns({"rule_id": F.when(none, F.lit("fallback")).otherwise(head["rule_id"]), "topic": topic, "category": category, "competing": F.when(none, other).otherwise(lost)})
    reason = F.array_join(F.transform("evidence", lambda e: F.concat(e["signal"], F.lit(" in "), e["field"], F.lit(": "), e["matched"])), "; ")
    out = out.withColumn("rationale", F.when(F.col("rule_id") == "fallback", F.concat(F.lit("no rule fired; kept in "), F.coalesce("topic", F.lit("none")), F.lit("/"), F.coalesce("category", F.lit("none")))).otherwise(reason))
    same = F.exists(ctx, lambda c: c["topic"].eqNullSafe(F.col("topic")) & c["category"].eqNullSafe(F.col("category")))
    return out.withColumns({"ambiguous": F.size("competing") > 0, "differs_from_discovery": ~same}).drop("_fired")
