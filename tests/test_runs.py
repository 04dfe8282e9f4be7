"""Refusals and edges of configuration, scans, fetch rows, artifacts, shards, validators."""

import copy
import time

import pytest
from pyspark.sql import functions as F

from siftloom import config
from siftloom.functions.signals import Signal
from siftloom.operators import artifacts, facets, fetch, links, registry, score, shards, validate
from siftloom.operators.scan import Search, TermList, scan
from siftloom.plans.frames import CURATION
from siftloom.sources import adapters, readers


def test_configuration_is_refused_by_name():
    bad = copy.deepcopy(CURATION)
    bad["rules"][0]["all_of"] = ["nobody"]
    with pytest.raises(config.ConfigError, match="nobody"):
        config.rules(bad)
    bad = copy.deepcopy(CURATION)
    bad["rules"][0]["order"] = 2
    with pytest.raises(config.ConfigError, match="order 2"):
        config.rules(bad)
    bad = copy.deepcopy(CURATION)
    bad["signals"]["english_licence"]["all_of_signals"] = ["nobody"]
    with pytest.raises(config.ConfigError, match="nobody"):
        config.signals(bad)
    bad["scoring"]["weights"] = {"a": 0.0}
    with pytest.raises(config.ConfigError, match="zero"):
        config.policy(bad)


def test_scan(spark):
    d = spark.createDataFrame([(1, "The BIG-data, big  data!", "x"), (2, "bigger straße STRASSE", "The"), (3, None, None), (4, "", "data")], "id int, a string, b string")
    search = Search({"a": "a", "b": "b"}, [Signal("two", keywords=("the", "data"), least=2), Signal("case", patterns=("BIG", "x"), keywords=("the",))], {"phrase": TermList(("big data", "big data*", "bi* g", "big*", "%")), "only_b": TermList(("the", "data"), ("b",)), "sharp": TermList(("strasse",))})
    got = {r["id"]: r for r in scan(d, search, ["id"]).collect()}
    assert {k: (r["on_two"], r["on_case"], r["n_phrase"], r["n_only_b"], r["n_sharp"]) for k, r in got.items()} == {1: (True, True, 3, 0, 0), 2: (False, True, 1, 1, 1), 3: (False, False, 0, 0, 0), 4: (False, False, 0, 1, 0)}
    assert [tuple(e) for e in got[1]["evidence"]] == [("two", "a", "The"), ("case", "a", "BIG")] and [tuple(e) for e in got[2]["evidence"]] == [("case", "b", "The")]
    assert scan(d.limit(0), search, ["id"]).collect() == []


def test_a_plan_looks_at_a_text_once(spark):
    from conftest import DATA

    from siftloom.plans import registry as plans

    plan = plans.QUERIES["cross_references"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("regexp_substr") + plan.count("RLIKE") < 10


def test_every_gate(spark):
    cols = "id int, title string, summary string, excluded boolean, developer_only boolean, has_required boolean, required_hits int, relevance double, quality double, audience_fit double, composite double"
    ok = (0, "t", None, False, False, True, 1, 0.9, 0.9, 1.0, 0.9)
    at = lambda k, **kw: (k, *[kw.get(c.split()[0], v) for c, v in zip(cols.split(", ")[1:], ok[1:])])
    rows = [ok, at(1, excluded=True, developer_only=True), at(2, excluded=True), at(3, title=" "), at(4, required_hits=0), at(5, relevance=0.1), at(6, quality=0.1), at(7, audience_fit=0.1), at(8, composite=0.1), at(9, relevance=0.0, has_required=False, required_hits=0), at(10, composite=None)]
    got = {r["id"]: (r["rejection_reason"], r["detail"]) for r in score.decide(spark.createDataFrame(rows, cols)).collect()}
    assert {k: v[0] for k, v in got.items()} == {0: None, 1: "developer_only_audience", 2: "category_exclusion_applied", 3: "insufficient_evidence", 4: "off_topic", 5: "below_relevance_threshold", 6: "below_quality_threshold", 7: "insufficient_evidence", 8: "insufficient_evidence", 9: "below_relevance_threshold", 10: "insufficient_evidence"}
    assert got[0][1] == "composite 0.9000 >= accept_composite 0.4000" and got[6][1] == "quality 0.1000 < min_quality 0.3000" and got[10][1].startswith("composite unknown <")
    own = spark.createDataFrame([ok], cols).withColumn("min_quality", F.lit(0.95))
    assert score.decide(own).first()["rejection_reason"] == "below_quality_threshold"


def test_facets_of_excluded_topics_and_ties(spark):
    f = spark.createDataFrame([(1, [("industry", "a", 2), ("industry", "b", 2), ("function", "f", 1)]), (2, []), (3, [("industry", "a", 1), ("use_case", "u", 1)])], "id int, found array<struct<axis:string,slug:string,n_terms:int>>")
    got = {r["id"]: r for r in facets.assign(f, "id", F.col("id") < 3).collect()}
    assert got[1]["industry"] == facets.SENTINEL and got[1]["functions"] == ["f"] and any("equally supported: a, b" in u for u in got[1]["unresolved"])
    assert got[2]["industry"] is None and len(got[2]["unresolved"]) == 3 and got[3]["functions"] is None


def test_lookups_refuse(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    one = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert validate.looked_up(a, one, "k", "verdict").count() == 2
    for t in (one.where("k = 1"), one.union(one)):
        with pytest.raises(ValueError, match="verdict"):
            validate.looked_up(a, t, "k", "verdict")
    assert validate.lookup_problems(a.limit(0), one, "k", "v").count() == 0


def test_shards_refuse(spark):
    d = spark.createDataFrame([("a",), (None,)], "t string")
    with pytest.raises(ValueError, match="None"):
        shards.split(d, "t", ["a"])
    assert shards.split(d.limit(1), "t", ["a", "b"])["b"].count() == 0
    with pytest.raises(ValueError):
        shards.check_growth(2, 1, "x")
    kept, others = shards.guarded(d, "t", "a")
    assert (kept.count(), others.count()) == (1, 1)


def test_observations_refuse_what_the_merge_owns(spark):
    o = spark.createDataFrame([], "cell_id string, identity_url string, seen_at timestamp, outcome string, seen_count int, odd string")
    with pytest.raises(ValueError, match="seen_count.*odd|odd.*seen_count"):
        artifacts.observation_problems(o)
    assert artifacts.observation_problems(o.drop("seen_count", "odd")).count() == 0


def test_adapters_refuse_and_survive(spark):
    with pytest.raises(ValueError, match="no adapter"):
        adapters.adapter("crawler")
    assert readers.parsed_feed("<rss", "") is None and readers.parsed_feed("<rss><channel/></rss>", "") == []
    assert readers.recovered_json('x {"a": "]"} y') == '{"a": "]"}' and readers.recovered_json("{} []") is None and readers.recovered_json("[1] [2]") is None
    assert readers.recovered_json('{"a": [1, 2') is None and readers.recovered_json("{" * 200_000) is None


def test_unknown_failures_are_noticed(spark):
    x = spark.range(1).select(links.access_status(F.lit(None).cast("int"), F.lit("never_heard_of")).alias("s"), fetch.reason_class(F.lit("never_heard_of")).alias("c"), fetch.failure(F.lit(None).cast("string")).alias("f")).first()
    assert x["s"] is None and x["c"] == "adapter_error" and x["f"] is None


def test_preflight_selection(spark):
    c = spark.createDataFrame([("s1", "u")], "source_id string, url string")
    p = spark.createDataFrame([], "url string, probed_at int, http_status int, error_type string")
    assert fetch.preflight_rows(c, p).first()["result"] == "not_run"
    for chosen in ([], ["s1", "s1"], ["s2"]):
        with pytest.raises(ValueError):
            fetch.preflight_rows(c, p, chosen)


def test_merges_meet_what_is_held(spark):
    cols = "entity_key string, topic string, name string, seq int, description_source string, description string, maintainer_or_vendor string, freshness_signal string, target_url string, entity_type string, github_stars long, related_topics array<string>"
    reg = spark.createDataFrame([("k", "t", "n", 1, "snippet-only", "old", "unknown", "unknown", "unknown", "tool", 5, ["a"])], cols)
    batch = spark.createDataFrame([("k", "t", "n", 2, "verified", "new", "v", "f", "https://github.com/o/r", "library", 9, ["b"]), ("k", "t", "n", 3, "verified", "later", "w", "g", "https://github.com/o/r/issues", "tool", 11, None)], cols)
    r = registry.merged_entities(reg, batch).first()
    assert (r["description"], r["maintainer_or_vendor"], r["target_url"], r["entity_type"], r["github_stars"], r["related_topics"], r["corroboration_count"]) == ("new", "v", "https://github.com/o/r", "tool", 9, ["a", "b"], 3)
    assert [(c["field"], c["existing"], c["incoming"]) for c in r["conflicts"]] == [("entity_type", "tool", "library"), ("target_url", "https://github.com/o/r", "https://github.com/o/r/issues")]


def test_entities_of_one_long_history(spark):
    """An entity with 50,000 rows, each of another type: linear in them, with every conflict logged."""
    n = 50_000
    text = lambda *cs: [F.lit("x").alias(c) for c in cs]
    d = spark.range(n).select(
        F.col("id").alias("seq"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("entity_type"), F.when(F.col("id") == 40_000, "verified").alias("description_source"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("description"),
        F.lit("https://github.com/o/r").alias("target_url"), F.col("id").alias("github_stars"), F.array((F.col("id") % 3).cast("string")).alias("related_topics"), *text("entity_key", "topic", "name", "maintainer_or_vendor", "freshness_signal"),
    )
    t = time.monotonic()
    r = registry.merged_entities(d.limit(0), d.repartition(4)).select("entity_type", "description", "github_stars", "related_topics", "corroboration_count", F.size("conflicts")).first()
    assert tuple(r) == ("t0", "d40000", n - 1, ["0", "1", "2"], n, n - 1)
    assert time.monotonic() - t < 60


def test_validators_of_empty_tables(spark):
    e = spark.createDataFrame([], "axis string, slug string, coverage_policy string, status string, replaced_by string")
    got = {(r["subject"], r["message"]) for r in validate.vocabulary_problems(e, "s", {"a": 1}, {}).collect()}
    assert got == {("a", "aren't as many as approved"), ("a", "lack the sentinel")}
    assert validate.against_schema(spark.createDataFrame([("x", None)], "k string, d string"), F.col("k"), F.col("d"), {"type": "object"}).count() >= 1
