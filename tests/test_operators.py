"""Operators on small hand-made cases: ties, nulls, repeats, empty tables."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

from siftloom.functions.signals import Composite, Rule, Signal
from siftloom.operators import classify, compare, coverage, dedupe, facets, ledger, links, records, registry, schedule, score, windows
from siftloom.streaming.ledgers import LedgerSink, first_sightings, weekly_yield


def test_observations_conflict(spark):
    d = spark.createDataFrame([("s", 1, "u", "l1", "a"), ("s", 1, "u", "l0", "a"), ("s", 2, "u", "l1", "a"), ("s", 2, "u", "l2", "b")], "source_id string, position int, target_url string, lane_id string, title string")
    got = {r["position"]: (r["lane_ids"], r["conflict"]) for r in dedupe.observations(d, ["title"]).collect()}
    assert got == {1: (["l0", "l1"], False), 2: (["l1", "l2"], True)}


def test_classify_fallback_and_ties(spark):
    d = spark.createDataFrame([(1, "Alpha beta", [("t", "c"), ("x", "y")]), (2, "beta gamma", None), (3, None, [("t", "c")])], "id int, text string, ctx array<struct<topic:string,category:string>>")
    signals = [Signal("a", keywords=("alpha",)), Signal("b", keywords=("beta", "gamma"), least=2), Composite("ab", ("a", "b"))]
    rules = [Rule("r2", 2, "T", "two", ("a",)), Rule("r1", 1, "T", "one", ("b",), ("a",))]
    got = {r["id"]: (r["rule_id"], r["topic"], r["category"], [e["matched"] for e in r["evidence"]], r["ambiguous"]) for r in classify.classify(d, {"text": "text"}, signals, rules, "ctx").collect()}
    assert got == {1: ("r2", "T", "two", ["Alpha"], False), 2: ("r1", "T", "one", ["beta"], False), 3: ("fallback", "t", "c", [], False)}


def test_scores(spark):
    s = spark.range(1).select(
        score.freshness(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-03-31").cast("timestamp")).alias("half"),
        score.freshness(F.lit("2025-01-01").cast("timestamp"), F.lit("2024-03-31").cast("timestamp")).alias("future"),
        score.freshness(F.lit(None).cast("timestamp"), F.lit("2024-03-31").cast("timestamp")).alias("none"),
        score.composite({"a": F.lit(1.0), "b": F.lit(None).cast("double")}, {"a": 0.4, "b": 0.6}).alias("known"),
        score.composite({"a": F.lit(None).cast("double")}, {"a": 1.0}).alias("empty"),
        score.relevance(F.lit(3), F.lit(3), F.lit(0), F.lit(True), F.lit(True)).alias("full"),
        score.relevance(F.lit(0), F.lit(3), F.lit(0), F.lit(True), F.lit(True)).alias("off"),
        score.relevance(F.lit(0), F.lit(0), F.lit(0), F.lit(False), F.lit(False)).alias("no_vocabulary"),
    ).first()
    assert tuple(s) == (0.5, 1.0, None, 1.0, None, 1.0, 0.0, 0.68)


def test_scores_round_like_sql(spark):
    """Four decimals of numbers at a half, and of a composite that decimal rendering puts at one."""
    halves = spark.range(-3000, 10_000).select(((F.col("id") * 2 + 1) / 20_000.0).alias("x"), ((F.col("id") * 2 + 1) * 0.00005).alias("y"))
    got = halves.select("x", "y", score.rounded(F.col("x")).alias("rx"), score.rounded(F.col("y")).alias("ry")).toPandas()
    want = duckdb.sql("SELECT x, y, round(x, 4) AS rx, round(y, 4) AS ry FROM got").df()
    assert got.sort_values("x").values.tolist() == want.sort_values("x").values.tolist()
    scores = {"relevance": 0.0, "quality": 1.0, "audience_fit": 1.0, "freshness": 0.699}
    assert spark.range(1).select(score.composite({k: F.lit(v) for k, v in scores.items()}, score.Policy().weights)).first()[0] == 0.5548


def test_facet_ties(spark):
    d = spark.createDataFrame([(1, "red blue"), (2, "red crimson"), (3, None)], "id int, text string")
    ev = facets.evidence(d, "id", {"text": "text"}, [("c", "red", ("red", "crimson")), ("c", "blue", ("blue",))])
    got = {r["id"]: (r["slug"], r["tie"], r["confidence"]) for r in facets.single(ev, "id", "c").collect()}
    assert got == {1: (facets.SENTINEL, True, 0.3333), 2: ("red", False, 0.6667)}
    assert facets.several(ev, "id", "c", 1).where("id = 1").first()["dropped"] == ["red"]


def test_fold_meets_the_evolving_value(spark):
    how = registry.Fold("k", "seq", largest=["conf"], guarded=["d", "t"], backfill=["t"], united=["src"], latest=["stars"])
    cols = "k string, seq int, conf double, d string, t string, src array<string>, stars int"
    base = spark.createDataFrame([("a", 1, 0.5, "2020", None, ["x"], 1)], cols)
    batch = spark.createDataFrame([("a", 2, 0.9, "2021", "u", ["y"], None), ("a", 3, 0.1, "2020", "v", ["x"], 5), ("b", 1, 0.1, None, None, None, None), ("b", 2, None, "2022", "w", ["z"], 2), (None, 9, 1.0, "", "", [], 1)], cols)
    got = {r["k"]: r for r in registry.fold(base, batch, how).collect()}
    a, b = got["a"], got["b"]
    assert (a["conf"], a["d"], a["t"], a["src"], a["stars"], a["corroboration_count"]) == (0.9, "2020", "u", ["x", "y"], 5, 3)
    assert [tuple(x) for x in a["conflicts"]] == [(2, "d", "2020", "2021"), (3, "t", "u", "v")]
    assert (b["t"], b["d"], b["src"], b["corroboration_count"], b["conflicts"]) == ("w", None, ["z"], 2, [])
    assert set(got) == {"a", "b"}
    assert registry.fold(base.limit(0), batch.limit(0), how).count() == 0


def test_fold_of_one_long_history(spark):
    """A key with 50,000 conflicting rows: linear, where copying the log at each row took minutes."""
    n = 50_000
    d = spark.range(n).select(F.lit("a").alias("k"), F.col("id").alias("seq"), F.col("id").cast("string").alias("v"), F.when(F.col("id") == n // 2, "w").alias("w"))
    t = time.monotonic()
    r = registry.fold(d.limit(0), d.repartition(4), registry.Fold("k", "seq", guarded=["v"], latest=["w"])).select("v", "w", "corroboration_count", F.size("conflicts"), F.col("conflicts")[n - 2]).first()
    assert (*r[:4], tuple(r[4])) == ("0", "w", n, n - 1, (n - 1, "v", "0", str(n - 1)))
    assert time.monotonic() - t < 60


def test_fold_logs_against_the_moving_value(spark):
    d = spark.createDataFrame([("a", 1, None, 1), ("a", 2, "x", 5), ("a", 3, "y", 2), ("a", 4, None, 7), ("a", 5, "x", 7)], "k string, seq int, s string, n int")
    r = registry.fold(d.limit(0), d, registry.Fold("k", "seq", guarded=["s", "n"], latest=["s"], largest=["n"])).first()
    assert (r["s"], r["n"]) == ("x", 7)
    assert [tuple(c) for c in r["conflicts"]] == [(2, "n", "1", "5"), (3, "s", "x", "y"), (3, "n", "5", "2"), (4, "n", "5", "7"), (5, "s", "y", "x")]


def test_ranked_bundle(spark):
    how = registry.Fold("k", "seq", rank="r", ranked=["q"])
    rows = spark.createDataFrame([("a", 1, 1, "snippet"), ("a", 2, 1, "other"), ("a", 3, 2, "full"), ("a", 4, None, "none")], "k string, seq int, r int, q string")
    assert registry.fold(rows.limit(0), rows, how).first()["q"] == "full"


def test_ledger_lattice(spark):
    cols = "k string, seen_at timestamp, outcome string, h string"
    none = spark.createDataFrame([], "k string, first_seen_at timestamp, last_seen_at timestamp, seen_count long, outcome string, h string")
    one = spark.createDataFrame([("a", None, None, None)], cols).withColumn("seen_at", F.lit("2024-01-01").cast("timestamp"))
    led = ledger.merge_observations(none, one, ["k"], ["h"])
    two = spark.createDataFrame([("a", None, "accepted", "x"), ("a", None, "pending", None)], cols).withColumn("seen_at", F.lit("2024-01-02").cast("timestamp"))
    led = ledger.merge_observations(led, two, ["k"], ["h"])
    r = led.first()
    assert (r["seen_count"], r["outcome"], r["h"], r["outcome_conflict"], str(r["first_seen_at"])[:10]) == (3, "accepted", "x", False, "2024-01-01")
    three = spark.createDataFrame([("a", None, "rejected", None)], cols).withColumn("seen_at", F.lit("2024-01-03").cast("timestamp"))
    r = ledger.merge_observations(led, three, ["k"], ["h"]).first()
    assert (r["outcome"], r["outcome_conflict"], r["h"]) == ("accepted", True, "x")


def test_patches_never_multiply(spark):
    led = spark.createDataFrame([("u", 1, None), ("v", 2, "z")], "url string, n int, s string")
    p = spark.createDataFrame([("u", 5, None, 1), ("u", None, "a", 2), ("u", 7, None, 3), ("w", 1, "q", 1)], "url string, n int, s string, o int")
    assert sorted(map(tuple, ledger.patch(led, p, "url", ["o"]).collect())) == [("u", 7, "a"), ("v", 2, "z")]


def test_robots(spark):
    p = spark.createDataFrame([(1, "https://a.com/x/y.html"), (2, "https://a.com/x/z?q"), (3, "https://b.com/x"), (4, "https://a.com")], "id int, url string")
    r = spark.createDataFrame([("a.com", "*", "/", False), ("a.com", "bot", "/x/", False), ("a.com", "bot", "/x/*.html$", True), ("a.com", "bot", "", False)], "host string, agent string, pattern string, allow boolean")
    allowed = lambda agent: {x["id"]: x["allowed"] for x in links.robots_allowed(p, "url", r, agent).collect()}
    assert allowed("MyBot/2") == {1: True, 2: False, 3: True, 4: True}
    assert allowed("other") == {1: False, 2: False, 3: True, 4: False}


def test_redirect_loops(spark):
    h = spark.createDataFrame([("a", "b", 301), ("b", "a", 301), ("c", "d", 301), ("d", "e", 302), ("s", "s", 308)], "url string, target string, status int")
    got = {r["url"]: (r["final_url"], r["hops"], r["permanent"], r["loop"]) for r in links.redirect_facts(h).collect()}
    assert got["a"][3] and got["s"][3] and got["c"] == ("e", 2, False, False) and got["d"] == ("e", 1, False, False)


def test_windows(spark):
    d = spark.createDataFrame([("c", i, i % 2 == 0) for i in range(6)], "cell string, n int, ok boolean")
    assert [r["n"] for r in windows.accepted_prefix(d, "cell", ["n"], "ok", 2).orderBy("n").collect()] == [0, 1, 2]
    assert [r["no_progress"] for r in windows.streaks(d, "cell", ["n"], "ok").orderBy("n").collect()] == [0, 1, 0, 1, 0, 1]
    assert windows.survivors(d, "cell", ["ok"]).first()["n"] == 1


def test_accepted_prefix_of_tied_rows(spark):
    """What is kept of rows that the order leaves tied doesn't depend on how they arrive."""
    tied = [("c", 1, True, "x"), ("c", 1, True, "y"), ("c", 1, False, "z"), ("c", 1, False, "w"), ("c", 2, False, "v")]
    for arrived in (tied, tied[::-1], tied[2:] + tied[:2]):
        d = spark.createDataFrame(arrived, "cell string, n int, ok boolean, s string").coalesce(1)
        assert sorted(r["s"] for r in windows.accepted_prefix(d, "cell", ["n"], "ok", 1).collect()) == ["w", "x", "z"]


def test_comparisons(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "k int, name string, t int")
    b = spark.createDataFrame([(1, "z", 9), (3, "w", 3)], "k int, name string, t int")
    got = {(r["key"], r["path"]): (r["kind"], r["verdict"]) for r in compare.differences(a, b, "k", ["t"], ["name"], []).collect()}
    assert got[("1", "name")] == ("changed", "violation") and got[("1", "t")] == ("changed", "permitted") and got[("2", "t")] == ("removed", "permitted") and got[("3", "name")] == ("added", "violation")
    assert compare.differences(a, a, "k", [], [], []).count() == 0
    assert {tuple(r) for r in compare.violations(a, "k", {"small": F.col("t") < 2, "null": F.lit(None).cast("boolean")}).collect()} == {(1, "null"), (2, "null"), (2, "small")}
    assert compare.fields_refused(["a", "x"], ["a", "b"], ["c"]) == {"missing": ["b"], "unknown": ["x"]}


def test_rounds(spark):
    """Round 1 is the configured cells, whatever it finds; each reason to stop."""
    cols = "axis string, slug string, score double, lane_id string, not_opened_reason string"
    gaps = spark.createDataFrame([("a", "x", 0.9, "gap__a__x", None), ("a", "y", 0.8, "gap__a__y", "no_credible_source"), ("a", "z", 0.7, "gap__a__z", None), ("a", "w", 0.6, "gap__a__w", None)], cols)
    R = schedule.Result
    run = lambda work, g=gaps, **kw: schedule.run_rounds(["cell__1"], lambda left: g, work, thresholds={"m": 1.0}, **kw)
    got = run(lambda n, lanes: R(1, 0.0))
    assert [(r.number, r.lanes, r.stop_reason) for r in got] == [(1, ["cell__1"], None), (2, ["gap__a__x", "gap__a__z"], None), (3, ["gap__a__x", "gap__a__z"], "max_rounds")]
    assert got[1].skipped == ["gap__a__y"] and all(r.published()["thresholds"] == {"m": 1.0} for r in got)
    assert [r.stop_reason for r in run(lambda n, lanes: R(0, None))] == [None, "no_progress"]
    assert [r.stop_reason for r in run(lambda n, lanes: R(5, 0.9))] == ["duplicate_rate"]
    assert [r.stop_reason for r in run(lambda n, lanes: R(5, 0.9), budget=lambda n: 0.0)] == ["budget_exhausted"]
    assert [r.stop_reason for r in run(lambda n, lanes: R(1), gaps.limit(0))] == ["all_targets_met"]
    assert [r.stop_reason for r in run(lambda n, lanes: R(1), gaps.where("slug = 'y'"))] == [None, "no_credible_source"]
    with pytest.raises(ValueError):
        schedule.link_sample(gaps, 26)


def test_coverage_counts_zero(spark):
    v = spark.createDataFrame([("a", "x", "standard", 3), ("a", "y", "standard", 1)], "axis string, slug string, tier string, target long")
    r = spark.createDataFrame([(1, ["x", "x"]), (2, ["x"]), (3, None)], "id int, a array<string>")
    got = {x["slug"]: (x["observed"], x["gap"]) for x in coverage.against_targets(v, coverage.observed(r, "id", {"a": "a"})).collect()}
    assert got == {"x": (2, 1), "y": (0, 1)}
    assert [x["n"] for x in coverage.histogram(r.limit(0), "id", [1.0]).collect()] == [0, 0]


def test_records(spark):
    o = spark.createDataFrame([("c", "b"), ("c", "a"), ("c", None)], "cell string, reason string")
    assert records.dominant_reason(o, "cell", ["b"]).first()["reason"] == "b"
    m = spark.createDataFrame([("c", "ok", 0, 0), ("d", "ok", 2, 1), ("e", "ok", 1, 0)], "cell_id string, status string, accepted int, unchecked int")
    assert {r["cell_id"]: r["reason"] for r in records.publication(m).collect()} == {"c": "no_records", "d": "unchecked_links", "e": None}


def test_streaming_ledger(spark, tmp_path):
    schema = "k string, seen_at timestamp, outcome string"
    for n, rows in enumerate([[("a", "pending")], [("a", "accepted"), ("b", None)]]):
        spark.createDataFrame(rows, "k string, outcome string").select("k", F.lit(f"2024-01-0{n + 1}").cast("timestamp").alias("seen_at"), "outcome").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sink = LedgerSink(spark, str(tmp_path / "ledger"), "k string, first_seen_at timestamp, last_seen_at timestamp, seen_count long, outcome string", ["k"])
    sink.start(stream, str(tmp_path / "cp")).awaitTermination(120)
    got = {r["k"]: (r["seen_count"], r["outcome"]) for r in sink.version(2).collect()}
    assert got == {"a": (2, "accepted"), "b": (1, "pending")}
    assert sink.manifest(2).keys() > sink.manifest(1).keys() and set(sink.manifest(1).values()) == {1}
    more = spark.createDataFrame([("b", "rejected")], "k string, outcome string").select("k", F.lit("2024-01-05").cast("timestamp").alias("seen_at"), "outcome")
    for epoch in (2, 2, 3, 4, 5):  # replaying a batch changes nothing; only b's bucket is written
        sink.write(more, epoch)
    last = {r["k"]: (r["seen_count"], r["outcome"], r["outcome_conflict"]) for r in sink.version(6).collect()}
    assert last == {"a": (2, "accepted", False), "b": (5, "rejected", False)} and sorted(sink.manifest(6).values()) == [2, 6]
    assert sorted(p.name for p in (tmp_path / "ledger").iterdir() if p.name[0] == "v") == ["v00000002", "v00000004", "v00000005", "v00000006"]
    q = weekly_yield(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "seen_at", "k").writeStream.format("memory").queryName("weeks").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("SELECT sum(n) FROM weeks").first()[0] == 3
    assert first_sightings(stream, "k", "seen_at").isStreaming
