"""Configuration is data: rules, signals, vocabularies, weights and thresholds are
JSON documents, read when a plan is made and compiled into what the operators take.
Frames of the same documents serve the validators and joins."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.signals import Composite, Rule, Signal
from .operators.score import Policy

#: Documents that come with the package.
DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")


class ConfigError(ValueError):
    """A document that isn't what an operator could take; names the place."""


def load(path: str) -> dict:
    """A document by its path, or by its name if it comes with the package."""
    place = path if os.path.dirname(path) else os.path.join(DATA, path)
    with open(place, encoding="utf-8") as f:
        try:
            return json.load(f)
        except ValueError as e:
            raise ConfigError(f"{path}: {e}") from e


def scan_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(file, document, error): the JSON files below ``path`` as variants; a file
    that can't be read as JSON has a null document and says so."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True).select(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file"), "value")
    return raw.select("file", F.try_parse_json("value").alias("document"), F.when(F.try_parse_json("value").isNull(), "not_json").alias("error"))


def signals(doc: Mapping) -> tuple[Signal | Composite, ...]:
    out: list[Signal | Composite] = []
    for name, s in doc["signals"].items():
        if "all_of_signals" in s:
            missing = [n for n in s["all_of_signals"] if n not in doc["signals"]]
            if missing:
                raise ConfigError(f"signals.{name}: unknown signals {missing}")
            out.append(Composite(name, tuple(s["all_of_signals"])))
        else:
            out.append(Signal(name, tuple(s.get("any_of_keywords", ())), tuple(s.get("any_of_patterns", ())), int(s.get("min_matches", 1))))
    return tuple(sorted(out, key=lambda s: isinstance(s, Composite)))


def rules(doc: Mapping) -> tuple[Rule, ...]:
    out, orders = [], set()
    for r in doc["rules"]:
        unknown = [n for n in (*r.get("all_of", ()), *r.get("none_of", ())) if n not in doc["signals"]]
        if unknown:
            raise ConfigError(f"rules.{r['rule_id']}: unknown signals {unknown}")
        if r["order"] in orders:
            raise ConfigError(f"rules.{r['rule_id']}: order {r['order']} is taken")
        orders.add(r["order"])
        to = r["assign"]
        out.append(Rule(r["rule_id"], r["order"], to["topic_slug"], to["category_slug"], tuple(r.get("all_of", ())), tuple(r.get("none_of", ()))))
    return tuple(sorted(out, key=lambda r: r.order))


def policy(doc: Mapping) -> Policy:
    s = doc["scoring"]
    t = s["thresholds"]
    if sum(s["weights"].values()) <= 0:
        raise ConfigError("scoring.weights sum to zero")
    return Policy(dict(s["weights"]), float(s["freshness_half_life_days"]), t["min_relevance"], t["min_quality"], t["min_audience_fit"], t["accept_composite"])


def thresholds(spark: SparkSession, doc: Mapping, cells: Sequence[str]) -> DataFrame:
    """(cell_id, min_relevance, min_quality, min_audience_fit, accept_composite):
    what each cell demands, its own overrides laid over the common thresholds."""
    common, own = doc["scoring"]["thresholds"], doc["scoring"].get("thresholds_by_cell") or {}
    names = ("min_relevance", "min_quality", "min_audience_fit", "accept_composite")
    rows = [(c, *[float({**common, **own.get(c, {})}[n]) for n in names]) for c in cells]
    return spark.createDataFrame(rows, "cell_id string, " + ", ".join(f"{n} double" for n in names))


def published_thresholds(doc: Mapping) -> dict[str, float]:
    """The thresholds that a run records, to prove that they never moved."""
    t = doc["scoring"]["thresholds"]
    return {n: t[n] for n in ("min_relevance", "min_quality", "accept_composite") if n in t}


def vocabulary(doc: Mapping, active: bool = False) -> list[tuple[str, str, tuple[str, ...]]]:
    """(axis, slug, terms) of every entry, or of those that aren't deprecated."""
    return [(a["axis"], e["slug"], tuple(e.get("terms", ()))) for a in doc["axes"] for e in a["entries"] if not (active and e.get("deprecated"))]


def barred(doc: Mapping) -> dict[tuple[str, str], set[str]]:
    return {(axis, "*"): set(fields) for axis, fields in doc.get("barred_fields", {}).items()}


def vocabulary_frame(spark: SparkSession, doc: Mapping) -> DataFrame:
    """(axis, slug, coverage_policy, deprecated, target): a target of its own goes
    before that of its policy."""
    t = doc.get("targets", {})
    rows = [
        (a["axis"], e["slug"], e.get("coverage_policy"), bool(e.get("deprecated", False)), t.get("overrides", {}).get(f"{a['axis']}/{e['slug']}", t.get("default_by_policy", {}).get(e.get("coverage_policy"))))
        for a in doc["axes"]
        for e in a["entries"]
    ]
    return spark.createDataFrame(rows, "axis string, slug string, coverage_policy string, deprecated boolean, target long")


def tier_counts(vocab: DataFrame) -> DataFrame:
    """(axis, coverage_policy, n) of the entries in use."""
    return vocab.where(~F.col("deprecated")).groupBy("axis", "coverage_policy").agg(F.count("*").alias("n"))


# Topic files: {topic, topic_slug, categories: [{category, category_slug, sources: [..]}]}

_SOURCE = "source_id: string, topic_slug: string, category_slug: string, adapter: string, url: string, role: string, max_candidates: int, max_requests: int, fixture_id: string"
TOPIC = f"topic string, topic_slug string, categories array<struct<category: string, category_slug: string, sources: array<struct<{_SOURCE}>>>>"


def cells(topics: DataFrame) -> DataFrame:
    """(cell_id, topic, topic_slug, category, category_slug, n_sources) of topic files."""
    c = topics.select("topic", "topic_slug", F.explode("categories").alias("c"))
    return c.select(F.concat_ws("__", "topic_slug", "c.category_slug").alias("cell_id"), "topic", "topic_slug", "c.category", "c.category_slug", F.coalesce(F.size("c.sources"), F.lit(0)).alias("n_sources"))


def lane_mismatches(configured: DataFrame, lanes: DataFrame) -> DataFrame:
    """(cell_id, finding): cells without a lane and lanes without a cell."""
    a, b = configured.select("cell_id").distinct(), lanes.select("cell_id").distinct()
    return a.join(b, "cell_id", "left_anti").withColumn("finding", F.lit("no_lane")).unionByName(b.join(a, "cell_id", "left_anti").withColumn("finding", F.lit("not_configured")))


def catalog(topics: DataFrame) -> DataFrame:
    """A row for each source of topic files, with its cell, its place and ``problem``:
    ``missing_url``, or ``duplicate_source_id`` where several have its identifier."""
    c = topics.select("topic_slug", F.explode("categories").alias("c"))
    s = c.select(F.concat_ws("__", "topic_slug", "c.category_slug").alias("cell_id"), F.posexplode("c.sources").alias("place", "s")).select("cell_id", "place", "s.*")
    n = s.groupBy("source_id").agg(F.count("*").alias("_n"))
    problem = F.when(F.coalesce(F.trim("url"), F.lit("")) == "", "missing_url").when(F.col("_n") > 1, "duplicate_source_id")
    return s.join(n, "source_id", "left").withColumn("problem", problem).drop("_n")


def run_config(versions: Mapping[str, int], bounds: Mapping[str, int | float], doc: Mapping) -> dict:
    """What a run states about its configuration: the versions read, the bounds that
    were enforced, and the thresholds in force."""
    return {"versions": dict(sorted(versions.items())), "bounds": dict(sorted(bounds.items())), "thresholds": published_thresholds(doc)}
