"""Queries over what a run leaves: counts, eligibility, conflicts, observations,
reports, shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import artifacts, ledger, schedule, shards
from .frames import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_RECORDS = """r AS (SELECT doc_id, 't' || doc_id % 3 AS topic, source AS category, 't' || doc_id % 3 || '__' || source AS cell_id, 'r' || doc_id // 2 AS record_id, CASE WHEN doc_id % 5 = 0 THEN 'cross_reference' ELSE 'full' END AS record_type,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE ['ok', 'not_checked', 'redirected', 'timeout'][1 + doc_id % 4] END AS access_status, CASE WHEN doc_id % 4 IN (0, 2) AND doc_id % 7 <> 0 THEN 'fetched' ELSE 'unverified' END AS verification_status, 'https://d.example.org/' || doc_id AS identity_url, sha256(text) AS content_hash FROM documents)"""


def _records(spark, sf_dir):
    n = F.col("doc_id")
    full = n % 5 != 0
    topic = F.concat(F.lit("t"), (n % 3).cast("string"))
    access = F.element_at(F.array(*[F.lit(x) for x in ("ok", "not_checked", "redirected", "timeout")]), (n % 4 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", topic.alias("topic"), F.col("source").alias("category"), F.concat(topic, F.lit("__"), F.col("source")).alias("cell_id"), F.concat(F.lit("r"), F.floor(n / 2).cast("string")).alias("record_id"),
        F.when(full, "full").otherwise("cross_reference").alias("record_type"), F.when(full, access).alias("access_status"), F.when((n % 4).isin(0, 2) & (n % 7 != 0), "fetched").otherwise("unverified").alias("verification_status"),
        F.concat(F.lit("https://d.example.org/"), n.cast("string")).alias("identity_url"), F.sha2("text", 256).alias("content_hash"),
    )


@query(
    f"""WITH {_RECORDS}, c AS (SELECT DISTINCT cell_id FROM r UNION SELECT 'none__' || r_name FROM region) SELECT c.cell_id, count(r.doc_id) AS total_records, count(*) FILTER (record_type = 'full') AS full_records, count(*) FILTER (record_type = 'cross_reference') AS cross_references FROM c LEFT JOIN r USING (cell_id) GROUP BY 1"""
)
def cell_artifacts(spark, sf_dir):
    r = _records(spark, sf_dir)
    cells = r.select("cell_id").distinct().unionByName(table(spark, sf_dir, "region").select(F.concat(F.lit("none__"), F.col("r_name")).alias("cell_id")))
    return artifacts.cells(r, cells)


@query(
    f"""WITH {_RECORDS}, s AS (SELECT *, row_number() OVER (PARTITION BY topic, record_id ORDER BY category, doc_id) AS n FROM r), k AS (SELECT topic, category, count(*) AS n FROM s WHERE n = 1 AND record_type = 'full' GROUP BY 1, 2)
SELECT topic, string_agg(category || '=' || n, ',' ORDER BY category) AS by_category FROM k GROUP BY topic"""
)
def topic_artifacts(spark, sf_dir):
    kept = artifacts.topic_records(_records(spark, sf_dir).select("topic", "category", "record_id", "record_type", F.format_string("%012d", "doc_id").alias("doc_id")))
    return artifacts.by_category(kept).select("topic", F.array_join(F.transform(F.map_entries("by_category"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("by_category"))


@query("SELECT 's' || k AS source_id, count(*) AS candidates, count(*) FILTER (doc_id % 2 = 0) AS accepted FROM (SELECT doc_id, unnest([doc_id % 3, 3 + doc_id % 4]) AS k FROM documents) GROUP BY 1")
def candidates_by_source(spark, sf_dir):
    n = F.col("doc_id")
    s = lambda x: F.concat(F.lit("s"), x.cast("string"))
    return artifacts.candidates_by_source(table(spark, sf_dir, "documents").select(F.array(s(n % 3), s(n % 4 + 3)).alias("source_ids"), (n % 2 == 0).alias("accepted")))


@query(f"WITH {_RECORDS} SELECT cell_id, count(*) FILTER (record_type = 'full' AND access_status = 'not_checked') AS unchecked, count(*) FILTER (record_type = 'full') AS total FROM r GROUP BY 1")
def unchecked_records(spark, sf_dir):
    return artifacts.unchecked(_records(spark, sf_dir), ["cell_id"])


@query(
    f"""WITH {_RECORDS} SELECT doc_id, CASE WHEN access_status = 'not_checked' THEN 'not_checked' WHEN access_status = 'timeout' THEN 'access_timeout' WHEN verification_status = 'unverified' THEN 'unverified' WHEN doc_id % 2 = 0 AND doc_id % 6 <> 0 THEN 'facets_unresolved' END AS reason FROM r WHERE record_type = 'full'"""
)
def withheld_reasons(spark, sf_dir):
    r = _records(spark, sf_dir).where("record_type = 'full'")
    return r.select("doc_id", artifacts.withheld_reason(F.col("access_status"), F.col("verification_status"), F.col("doc_id") % 2 == 0, F.col("doc_id") % 6 == 0).alias("reason"))


@query(
    f"""WITH {_RECORDS}, u AS (SELECT count(*) FILTER (record_type = 'full' AND access_status = 'not_checked') AS u, count(*) FILTER (record_type = 'full') AS t, string_agg(DISTINCT cell_id, ', ' ORDER BY cell_id) FILTER (category = (SELECT min(source) FROM documents)) AS b FROM r)
SELECT 'smoke' AS run, false AS eligible, 'smoke runs are tests' AS reason UNION ALL SELECT 'unfetched', false, 'no target page was fetched' UNION ALL SELECT 'broken', false, 'failed: ' || b FROM u UNION ALL SELECT 'unchecked', false, u || ' of ' || t || ' records not checked' FROM u UNION ALL SELECT 'good', true, NULL"""
)
def publication_eligibility(spark, sf_dir):
    r = _records(spark, sf_dir)
    first = r.agg(F.min("category")).first()[0]
    cells = r.select("cell_id", "category").distinct().select("cell_id", F.when(F.col("category") == first, "adapter_error").otherwise("ok").alias("status"))
    fine = cells.withColumn("status", F.lit("ok"))
    checked = r.withColumn("access_status", F.when(F.col("record_type") == "full", F.lit("ok")))
    runs = {"smoke": ("smoke", cells, r, 1), "unfetched": ("harvest", cells, r, 0), "broken": ("harvest", cells, r, 1), "unchecked": ("harvest", fine, r, 1), "good": ("harvest", fine, checked, 1)}
    out = None
    for name, args in runs.items():
        one = artifacts.eligibility(*args).select(F.lit(name).alias("run"), "eligible", "reason")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """WITH c AS (SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN 'canonical_cross_host' ELSE 'canonical_unusable' END AS reason, 'https://i.example.org/' || user_id AS identity_url, CASE WHEN event_id % 2 = 0 THEN 'https://p.example.org/' || user_id % 3 END AS proposed_alias FROM events)
SELECT sha256(reason || chr(31) || identity_url || chr(31) || coalesce(proposed_alias, ''))[1:16] AS conflict_id, reason, identity_url, proposed_alias, CASE WHEN reason = 'canonical_unusable' THEN 'canonical_unusable' ELSE 'other host' END AS detail, 'unresolved' AS resolution, '2024-03-01T00:00:00Z' AS detected_at FROM c"""
)
def alias_conflict_rows(spark, sf_dir):
    n, u = F.col("event_id"), F.col("user_id").cast("string")
    c = table(spark, sf_dir, "events").select(
        F.when(n % 2 == 0, "canonical_cross_host").otherwise("canonical_unusable").alias("reason"), F.concat(F.lit("https://i.example.org/"), u).alias("identity_url"),
        F.when(n % 2 == 0, F.concat(F.lit("https://p.example.org/"), (F.col("user_id") % 3).cast("string"))).alias("proposed_alias"), F.when(n % 2 == 0, "other host").otherwise("").alias("detail"),
    )
    assert_ok = artifacts.conflict_problems(c)
    return artifacts.alias_conflicts(c.join(assert_ok, ["reason", "identity_url"], "left_anti"), "2024-03-01T00:00:00Z")


@query(
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://a.example.org/1|https://a.example.org/' || page_id ELSE 'https://a.example.org/1' END AS aliases, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END AS problems FROM pages WHERE page_id > 1 UNION ALL SELECT page_id, 'https://a.example.org/1', CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END FROM pages WHERE page_id <= 1"""
)
def validated_aliases(spark, sf_dir):
    n = F.col("page_id")
    a = lambda url, kind: F.struct(url.alias("url"), F.lit(kind).alias("kind"), F.lit("e").alias("evidence"))
    own = F.concat(F.lit("https://a.example.org/"), F.greatest(n, F.lit(1)).cast("string"))
    listed = F.array_compact(F.array(
        F.when(n % 2 == 0, a(own, "rel_canonical")), a(F.lit("https://a.example.org/1"), "rel_canonical"), a(F.lit("https://a.example.org/1"), "rel_canonical"), a(F.lit("not an address"), "rel_canonical"),
        a(F.concat(F.lit("https://self.example.org/"), n.cast("string")), "permanent_redirect"), F.when(n % 3 == 0, a(F.lit("https://a.example.org/z"), "heard")),
    ))
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://self.example.org/"), n.cast("string")).alias("identity_url"), listed.alias("url_aliases"))
    x = artifacts.aliases(p, "identity_url", "url_aliases")
    return x.select("page_id", F.array_join(F.array_sort(F.transform("url_aliases", lambda v: v["url"])), "|").alias("aliases"), F.col("alias_problems").alias("problems"))


@query(
    f"""WITH {_RECORDS}, k AS (SELECT cell_id, identity_url, record_id, content_hash, access_status FROM r WHERE record_type = 'full') SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'accepted' WHEN doc_id % 3 = 1 THEN 'rejected' ELSE 'pending' END AS outcome, k.record_id, k.content_hash, k.access_status FROM r LEFT JOIN k USING (cell_id, identity_url)"""
)
def ledger_observations(spark, sf_dir):
    r = _records(spark, sf_dir)
    n = F.col("doc_id")
    v = r.select("cell_id", "identity_url", (n % 3 == 0).alias("accepted"), F.when(n % 3 == 1, "off_topic").alias("rejection_reason"), F.lit(0.5).alias("composite"))
    o = artifacts.ledger_observations(v, r, "2024-03-01 00:00:00")
    return o.select(F.substring_index("identity_url", "/", -1).cast("long").alias("doc_id"), "outcome", "record_id", "content_hash", "access_status")


@query(
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'no_identity' WHEN 1 THEN 'unknown_outcome' WHEN 2 THEN 'unknown_outcome' WHEN 3 THEN 'no_time' END AS problem FROM events WHERE event_id % 6 < 4"""
)
def observation_problems(spark, sf_dir):
    n, k = F.col("event_id"), F.col("event_id") % 6
    o = table(spark, sf_dir, "events").select(n.cast("string").alias("cell_id"), F.when(k == 0, " ").otherwise("u").alias("identity_url"), F.when(k != 3, F.lit("2024-01-01").cast("timestamp")).alias("seen_at"), F.when(k == 1, "maybe").when(k != 2, "accepted").alias("outcome"))
    return artifacts.observation_problems(o).select(F.col("cell_id").cast("long").alias("event_id"), "problem")


@query(
    """WITH o AS (SELECT o_orderpriority, o_orderstatus, CASE WHEN o_totalprice >= 200000 THEN 'high' ELSE 'low' END AS band, o_orderstatus = 'P' AS f, o_custkey % 3 = 0 AS x FROM orders),
g AS (SELECT CASE WHEN grouping(o_orderpriority) = 0 THEN 'pattern' WHEN grouping(o_orderstatus) = 0 THEN 'status' WHEN grouping(band) = 0 THEN 'band' ELSE 'all' END AS dimension, coalesce(o_orderpriority, o_orderstatus, band) AS value, count(*) AS n, round(count(*) FILTER (f) * 100 / count(*)::DOUBLE, 2) AS failed_pct, round(count(*) FILTER (x) * 100 / count(*)::DOUBLE, 2) AS foreign_pct FROM o GROUP BY GROUPING SETS ((o_orderpriority), (o_orderstatus), (band), ()))
SELECT *, n < 400 AS thin FROM g"""
)
def coverage_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    band = F.when(F.col("o_totalprice") >= 200000, "high").otherwise("low")
    return artifacts.coverage_summary(o, {"pattern": F.col("o_orderpriority"), "status": F.col("o_orderstatus"), "band": band}, F.col("o_orderstatus") == "P", F.col("o_custkey") % 3 == 0, 400)


@query("SELECT event_type AS stage, count(*) AS steps, round(sum((event_id % 100) / 8.0::DOUBLE), 3) AS seconds, round(sum((event_id % 10) / 16.0::DOUBLE), 6) AS cost FROM events GROUP BY ROLLUP (event_type)")
def stage_costs(spark, sf_dir):
    return artifacts.stage_costs(table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), (F.col("event_id") % 100 / 8.0).alias("seconds"), (F.col("event_id") % 10 / 16.0).alias("cost")))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'array(' || event_id % 4 || ')' WHEN 1 THEN 'object(2)' ELSE 'v' || event_id END AS shown FROM events")
def bounded_values(spark, sf_dir):
    n = F.col("event_id")
    listed = F.concat(F.lit("["), F.array_join(F.transform(F.slice(F.sequence(F.lit(1), F.lit(4)), F.lit(1), (n % 4).cast("int")), lambda i: i.cast("string")), ","), F.lit("]"))
    v = F.when(n % 3 == 0, listed).when(n % 3 == 1, F.lit('{"a":1,"b":{"c":2}}')).otherwise(F.concat(F.lit("v"), n.cast("string")))
    kind = F.when(n % 3 == 0, "array").when(n % 3 == 1, "object").otherwise("string")
    return table(spark, sf_dir, "events").select("event_id", artifacts.bounded_size(v, kind).alias("shown"))


@query("SELECT 'cells/' || n_regionkey || '__' || n_nationkey || '.json' AS name FROM nation UNION ALL SELECT DISTINCT 'topics/' || n_regionkey || '.json' FROM nation UNION ALL VALUES ('coverage.json'), ('alias_conflicts.json'), ('manifest.json')")
def expected_documents(spark, sf_dir):
    return artifacts.expected_names(table(spark, sf_dir, "nation").select(F.concat_ws("__", F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string")).alias("cell_id")))


@query("SELECT c_custkey, c_mktsegment AS shard, 'kept' AS fate FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey, c_mktsegment, 'reported' FROM customer WHERE c_mktsegment <> 'BUILDING'")
def topic_guard(spark, sf_dir):
    kept, others = shards.guarded(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("shard")), "shard", "BUILDING")
    return kept.withColumn("fate", F.lit("kept")).unionByName(others.withColumn("fate", F.lit("reported")))


@query("SELECT c_mktsegment AS shard, count(*) AS n, 'news' AS topic, 'ai' AS category FROM customer GROUP BY 1")
def shard_split(spark, sf_dir):
    """Each segment its own shard, the missing one derived from the union, all stamped with their cell."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.lit("x").alias("topic"))
    parts: dict = dict(shards.split(c, "c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD"]))
    parts["BUILDING"] = None
    out = None
    for k, p in parts.items():
        one = shards.stamped(shards.derived_shard(p, c, "c_mktsegment", k), {"topic": "news", "category": "ai"}).groupBy(F.col("c_mktsegment").alias("shard"), "topic", "category").agg(F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out.select("shard", "n", "topic", "category")


@query(
    """SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'not_json' WHEN 1 THEN 'not_an_object' WHEN 2 THEN 'missing_candidates' WHEN 3 THEN 'candidates_is_not_array' WHEN 4 THEN 'notes_is_not_string' END AS problem FROM events"""
)
def batch_shapes(spark, sf_dir):
    k = F.col("event_id") % 7
    body = (
        F.when(k == 0, "{oops").when(k == 1, "[1]").when(k == 2, '{"visited_urls":[]}').when(k == 3, '{"candidates":{}}').when(k == 4, '{"candidates":[],"notes":7}').when(k == 5, '{"candidates":[{"a":1}],"visited_urls":["u"],"notes":"n"}').otherwise('{"candidates":[]}')
    )
    return table(spark, sf_dir, "events").select("event_id", shards.batch_problem(body).alias("problem"))


@query("SELECT url FROM pages UNION SELECT url || '/x' FROM pages WHERE page_id % 2 = 0 UNION SELECT url FROM pages WHERE page_id % 3 = 0")
def attempted_addresses(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    batch = p.where("page_id % 2 = 0").select(F.concat("url", F.lit("/x")).alias("url")).unionByName(p.where("page_id % 3 = 0").select("url")).unionByName(p.limit(0).select(F.lit(None).cast("string").alias("url")))
    return shards.attempted(p, batch, "url")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'https://n.example.org/' || c_custkey ELSE c_name END AS url FROM customer")
def applied_backfill(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("url"))
    u = lambda x: F.concat(F.lit(x), F.col("c_custkey").cast("string"))
    found = c.where("c_custkey % 3 = 0").select("c_custkey", u("https://n.example.org/").alias("url"))
    found = found.unionByName(c.where("c_custkey % 3 = 0").select("c_custkey", u("https://z.example.org/").alias("url"))).unionByName(c.select((-F.col("c_custkey")).alias("c_custkey"), F.lit("lost").alias("url"))).unionByName(c.where("c_custkey % 3 = 1").select("c_custkey", F.lit(None).cast("string").alias("url")))
    return shards.backfilled(shards.without_patch(c.withColumn("ledger_patch", F.lit(1))), found, "c_custkey", "url")


@query("SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS place FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, sf_dir):
    return shards.duplicate_groups(table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_id % 13)), ',') AS rounds FROM events GROUP BY 1")
def rounds_in_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set((F.col("event_id") % 13).cast("string")).alias("rounds"))
    return e.select("user_id", F.array_join(F.transform(shards.rounds_in_order(F.col("rounds")), lambda r: r.cast("string")), ",").alias("rounds"))


@query("WITH n AS (SELECT c_nationkey AS lane, count(*) FILTER (c_acctbal > 7000) AS verified FROM customer GROUP BY 1) SELECT n_nationkey AS lane, coalesce(verified, 0) AS verified, CASE WHEN coalesce(verified, 0) >= 3 THEN 'done' WHEN coalesce(verified, 0) > 0 THEN 'short' ELSE 'empty' END AS state FROM (SELECT n_nationkey FROM nation UNION ALL SELECT 100 + r_regionkey FROM region) LEFT JOIN n ON lane = n_nationkey")
def lane_states(spark, sf_dir):
    lanes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("lane")).unionByName(table(spark, sf_dir, "region").select((F.col("r_regionkey") + 100).alias("lane")))
    return shards.lane_summary(lanes, table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("lane"), (F.col("c_acctbal") > 7000).alias("verified")), 3)


@query("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + INTERVAL 45 DAY, '%Y-%m-%d') AS due FROM orders")
def refresh_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", shards.refresh_due(F.col("o_orderdate"), 45).cast("string").alias("due"))


@query("WITH v AS (SELECT 'u' || user_id AS identity_url, 's' || min(event_id % 4) AS source_id, CASE WHEN user_id % 2 = 0 THEN 'off_topic' ELSE 'below_quality_threshold' END AS rejection_reason FROM events WHERE user_id % 3 <> 0 GROUP BY user_id) SELECT identity_url, source_id, rejection_reason FROM v")
def rejection_entries(spark, sf_dir):
    u = F.col("user_id")
    v = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string"))).alias("source_ids"))
    v = v.select(F.concat(F.lit("u"), u.cast("string")).alias("identity_url"), "source_ids", (u % 3 == 0).alias("accepted"), F.when(u % 2 == 0, "off_topic").otherwise("below_quality_threshold").alias("rejection_reason"), F.lit(0.1).alias("composite"))
    return ledger.rejections(v).drop("composite")


@query("SELECT row_number() OVER (ORDER BY gap DESC, slug) AS place, 'gap__nation__' || slug AS lane_id FROM (SELECT n_name AS slug, count(*) AS gap FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 4 <> 0 GROUP BY 1) ORDER BY 1 LIMIT 5")
def lane_plan(spark, sf_dir):
    """The lanes that a round opens: a top-k report over the gaps that have a source."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    g = c.groupBy(F.col("n_name").alias("slug"), "n_nationkey").agg(F.count("*").alias("score"))
    ranked = g.select(F.lit("nation").alias("axis"), "slug", F.col("score").cast("double").alias("score"), F.concat(F.lit("gap__nation__"), F.col("slug")).alias("lane_id"), F.when(F.col("n_nationkey") % 4 == 0, "no_credible_source").alias("not_opened_reason"))
    opened, _ = schedule.plan_lanes(ranked, 5)
    return spark.createDataFrame([(k + 1, lane) for k, lane in enumerate(opened)], "place long, lane_id string")
