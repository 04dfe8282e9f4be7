"""Queries over fetch outcomes, snapshots, budgets, preflight and the metadata cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fetch, links
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


def _at(values, n):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def _list(values):
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


_REASONS = ("robots_denied", "feed_parse_error", "no_items_in_window", "heard_nowhere", None, "lease_timeout", "empty_response")


@query(f"WITH r AS (SELECT event_id, {_list(_REASONS)}[1 + event_id % 7] AS reason FROM events) SELECT event_id, reason, CASE WHEN reason IN ('robots_denied', 'lease_timeout') THEN 'infrastructure_error' WHEN reason IN ('feed_parse_error', 'heard_nowhere', 'empty_response') THEN 'adapter_error' END AS result_class FROM r")
def reason_classes(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", _at(_REASONS, F.col("event_id")).alias("reason"))
    return e.withColumn("result_class", fetch.reason_class(F.col("reason")))


_TYPES = (*links.FAILURES, "boom")
_FAIL = "(VALUES " + ", ".join(f"('{k}', '{r}', '{c}')" for k, (r, c, _) in links.FAILURES.items()) + ") f(t, reason, result_class)"


@query(
    f"""WITH e AS (SELECT event_id, {_list(_TYPES)}[1 + event_id % {len(_TYPES)}] AS t FROM events) SELECT event_id, CASE WHEN e.t = 'boom' THEN 'internal_fetch_error' ELSE e.t END AS error_type, reason, result_class FROM e JOIN {_FAIL} ON f.t = CASE WHEN e.t = 'boom' THEN 'internal_fetch_error' ELSE e.t END"""
)
def failure_descriptors(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", fetch.failure(_at(_TYPES, F.col("event_id"))).alias("f"))
    return e.select("event_id", "f.*")


@query(
    """WITH p AS (SELECT page_id, url, html, page_id % 4 AS k FROM pages)
SELECT page_id, CASE k WHEN 0 THEN 'ok' WHEN 1 THEN 'redirected' WHEN 2 THEN CASE WHEN page_id % 8 = 2 THEN 'gone' ELSE 'not_found' END ELSE 'timeout' END AS access_status, CASE WHEN k < 2 THEN 'fetched' ELSE 'unverified' END AS verification_status,
  CASE WHEN k < 2 THEN 'http 200; final_url ' || url || '; ' || octet_length(encode(html)) || ' bytes' || CASE WHEN k = 1 THEN '; permanent redirect' WHEN page_id % 8 = 0 THEN '; temporary or mixed redirect chain' ELSE '' END
    WHEN k = 2 THEN 'http_4xx; http ' || CASE WHEN page_id % 8 = 2 THEN 410 ELSE 404 END || '; no such page' ELSE 'http_timeout' END AS verification_evidence,
  CASE WHEN k < 2 THEN sha256(html) END AS content_hash, CASE k WHEN 2 THEN 'http_4xx' WHEN 3 THEN 'http_timeout' END AS error_class FROM p"""
)
def fetch_outcomes(spark, sf_dir):
    n, k = F.col("page_id"), F.col("page_id") % 4
    p = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("r"), n.cast("string")).alias("requested_url"), F.when(k < 2, 200).when(k == 2, F.when(n % 8 == 2, 410).otherwise(404)).alias("http_status"),
        F.when(k == 2, "http_4xx").when(k == 3, "http_timeout").alias("error_type"), F.when(k == 2, "no such page").when(k == 3, "").alias("message"), F.col("url").alias("final_url"),
        F.when((k == 1) | (n % 8 == 0), 1).otherwise(0).alias("redirects"), (k == 1).alias("permanent_redirect"), F.col("html").cast("binary").alias("body"),
    )
    o = fetch.outcomes(p).select(F.substring("requested_url", 2, 20).cast("long").alias("page_id"), "access_status", "verification_status", "verification_evidence", "content_hash", "error_class")
    return o


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents) SELECT doc_id, CASE WHEN n > 25 THEN 'not_checked' END AS access_status FROM r")
def budget_skips(spark, sf_dir):
    return fetch.within_budget(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], ["doc_id"], 25).select("doc_id", "access_status")


@query(
    """WITH a AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS a FROM events), b AS (SELECT *, CASE WHEN a <= 5 THEN row_number() OVER (PARTITION BY user_id % 24, a <= 5 ORDER BY event_id) END AS b FROM a),
c AS (SELECT *, CASE WHEN b <= 4 THEN row_number() OVER (PARTITION BY user_id % 8, coalesce(b <= 4, false) ORDER BY event_id) END AS c FROM b)
SELECT event_id, CASE WHEN a > 5 THEN 'adapter' WHEN b > 4 THEN 'cell' WHEN c > 7 THEN 'run' END AS exhausted_scope, coalesce(a <= 5 AND b <= 4 AND c <= 7, false) AS granted FROM c"""
)
def nested_budgets(spark, sf_dir):
    u = F.col("user_id")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.lit(1).alias("charge"), (u % 8).alias("run"), (u % 24).alias("cell"))
    return fetch.charged(e, {"run": ("run", 7), "cell": ("cell", 4), "adapter": ("user_id", 5)}, ["event_id"]).select("event_id", "exhausted_scope", F.coalesce("granted", F.lit(False)).alias("granted"))


@query(
    """WITH s AS (SELECT s_suppkey, s_suppkey % 5 AS k FROM supplier) SELECT 's' || s_suppkey AS source_id, CASE k WHEN 0 THEN 'ok' WHEN 1 THEN 'zero_result' WHEN 2 THEN 'infrastructure_error' WHEN 3 THEN 'adapter_error' ELSE 'zero_result' END AS result,
  CASE k WHEN 1 THEN 'no_items_in_window' WHEN 2 THEN 'http_5xx' WHEN 3 THEN 'feed_parse_error' END AS reason, CASE WHEN k = 0 THEN 7 ELSE 0 END AS candidates, CASE WHEN k = 0 THEN 3 ELSE 0 END AS accepted FROM s"""
)
def source_outcomes(spark, sf_dir):
    k = F.col("s_suppkey") % 5
    s = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("source_id"), F.lit("feed").alias("adapter"), F.when(k == 1, "no_items_in_window").when(k == 2, "http_5xx").when(k == 3, "feed_parse_error").alias("reason"),
        F.when(k == 0, 7).alias("candidates"), F.when(k == 0, 3).alias("accepted"), F.lit(1).alias("requests_made"),
    )
    return fetch.source_rows(s).select("source_id", "result", "reason", "candidates", "accepted")


@query(
    """WITH p AS (SELECT page_id, 'u' || page_id % 40 AS url, page_id % 40 AS u, CASE WHEN page_id % 3 = 0 THEN 'dns_failure' WHEN page_id % 7 = 0 THEN 'empty_response' END AS er FROM pages), f AS (SELECT url, arg_min(er, page_id) AS er0, min(page_id) AS m FROM p GROUP BY url),
f2 AS (SELECT f.url, p.er FROM f JOIN p ON p.page_id = f.m)
SELECT 's' || s_suppkey AS source_id, CASE WHEN f2.url IS NULL THEN 'not_run' WHEN er IS NULL THEN 'ok' WHEN er = 'dns_failure' THEN 'infrastructure_error' ELSE 'adapter_error' END AS result, er AS reason FROM supplier LEFT JOIN f2 ON f2.url = 'u' || s_suppkey"""
)
def preflight(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("source_id"), F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("url"))
    n = F.col("page_id")
    p = table(spark, sf_dir, "pages").select(F.concat(F.lit("u"), (n % 40).cast("string")).alias("url"), n.alias("probed_at"), F.lit(200).alias("http_status"), F.when(n % 3 == 0, "dns_failure").when(n % 7 == 0, "empty_response").alias("error_type"))
    return fetch.preflight_rows(s, p).select("source_id", "result", "reason")


@query(
    """WITH f AS (SELECT event_id, user_id % 50 AS u, 'lane' || event_id % 4 AS lane, event_id % 11 + 1 AS round, CASE WHEN event_id % 5 = 0 THEN 500 WHEN event_id % 5 = 1 THEN 304 ELSE 200 END AS st, event_id % 3 + 1 AS att FROM events),
g AS (SELECT u, arg_min(st, event_id) FILTER (st <> 500) AS st, min(event_id) FILTER (st <> 500) AS first_at, arg_min(att, event_id) FILTER (st <> 500) AS att, min(lane) AS owner, string_agg(DISTINCT lane, ',' ORDER BY lane) AS lanes, list_sort(list(DISTINCT round) FILTER (event_id % 2 = 0)) AS rounds FROM f GROUP BY u)
SELECT 'k' || u AS source_request_key, CAST(st AS VARCHAR) AS established_by, first_at AS established_at, CASE WHEN first_at IS NOT NULL THEN sha256('b' || first_at) END AS body_sha256, CAST(att AS INTEGER) AS attempts, owner AS designated_owner_lane_id, lanes, array_to_string(coalesce(rounds, []), ',') AS rounds FROM g"""
)
def source_snapshots(spark, sf_dir):
    n = F.col("event_id")
    e = table(spark, sf_dir, "events").select(
        F.concat(F.lit("k"), (F.col("user_id") % 50).cast("string")).alias("source_request_key"), F.concat(F.lit("lane"), (n % 4).cast("string")).alias("lane_id"), (n % 11 + 1).alias("round"),
        F.when(n % 5 == 0, 500).when(n % 5 == 1, 304).otherwise(200).alias("http_status"), n.alias("fetched_at"), F.concat(F.lit("b"), n.cast("string")).cast("binary").alias("body"),
        (n % 3 + 1).cast("int").alias("attempts"), F.lit(0).alias("retries"), F.lit(0).alias("redirect_hops"), F.lit(False).alias("conditional"), (n % 2 == 0).alias("reused"),
    )
    s = fetch.snapshots(e)
    return s.select("source_request_key", "established_by", "established_at", "body_sha256", "attempts", "designated_owner_lane_id", F.array_join("contributing_lanes", ",").alias("lanes"), F.array_join(F.transform("reused_in_rounds", lambda r: r.cast("string")), ",").alias("rounds"))


@query(
    """WITH s AS (SELECT event_id, 'https://t.example.org/' || user_id % 60 AS c, 'https://T.example.org:443/' || user_id % 60 || CASE WHEN event_id % 2 = 0 THEN '?utm_source=x' ELSE '' END AS target_url, 'lane' || event_id % 6 AS lane, event_id % 7 = 0 AS f, event_id % 31 = 0 AS e FROM events)
SELECT sha256(c)[1:16] AS candidate_key, min(target_url) AS target_url, c AS canonical_key, min(lane) AS primary_discovery_lane_id, string_agg(DISTINCT lane, ',' ORDER BY lane) AS lanes, CASE WHEN bool_or(f) THEN min(lane) END AS fetch_owner, CASE WHEN bool_or(e) THEN min(lane) END AS extraction_owner FROM s GROUP BY c"""
)
def pool_candidates(spark, sf_dir):
    n = F.col("event_id")
    u = F.concat(F.lit("https://T.example.org:443/"), (F.col("user_id") % 60).cast("string"), F.when(n % 2 == 0, "?utm_source=x").otherwise(""))
    e = table(spark, sf_dir, "events").select(u.alias("target_url"), F.concat(F.lit("lane"), (n % 6).cast("string")).alias("lane_id"), F.lit("k").alias("source_request_key"), (n % 7 == 0).alias("fetched"), (n % 31 == 0).alias("extracted"))
    c = fetch.pool_candidates(e)
    return c.select("candidate_key", "target_url", "canonical_key", "primary_discovery_lane_id", F.array_join("contributing_lanes", ",").alias("lanes"), F.col("designated_target_fetch_owner_lane_id").alias("fetch_owner"), F.col("designated_extraction_owner_lane_id").alias("extraction_owner"))


@query("SELECT 'lane' || user_id % 30 AS lane_id, CAST(min(event_id % 3 + 1) AS INTEGER) AS round, arg_min(CASE WHEN event_id % 2 = 0 THEN 'gap' ELSE 'configured_cell' END, {'r': event_id % 3 + 1, 'k': CASE WHEN event_id % 2 = 0 THEN 'gap' ELSE 'configured_cell' END}) AS kind FROM events GROUP BY 1")
def lane_registry(spark, sf_dir):
    n = F.col("event_id")
    return fetch.lanes_registered(table(spark, sf_dir, "events").select(F.concat(F.lit("lane"), (F.col("user_id") % 30).cast("string")).alias("lane_id"), (n % 3 + 1).cast("int").alias("round"), F.when(n % 2 == 0, "gap").otherwise("configured_cell").alias("kind")))


@query(
    """WITH h AS (SELECT DISTINCT 'own/r' || c_custkey % 300 AS repository FROM customer), c AS (SELECT 'own/r' || o_custkey % 250 AS repository, max(o_orderdate) AS at, arg_max(['ok', 'not_found', 'transient'][1 + o_orderkey % 3], {'a': o_orderdate, 'b': ['ok', 'not_found', 'transient'][1 + o_orderkey % 3]}) AS status, max(o_orderkey) AS k FROM orders GROUP BY 1),
s AS (SELECT o.* FROM (SELECT 'own/r' || o_custkey % 250 AS repository, o_orderdate, ['ok', 'not_found', 'transient'][1 + o_orderkey % 3] AS status FROM orders) o),
j AS (SELECT h.repository, coalesce(c.status IN ('ok', 'not_found') AND date_diff('day', c.at, TIMESTAMP '1998-08-05') BETWEEN 0 AND 7, false) AS fresh FROM h LEFT JOIN c USING (repository))
SELECT repository, CASE WHEN fresh THEN 'fresh' ELSE 'fetch' END AS state FROM j"""
)
def metadata_cache(spark, sf_dir):
    hits = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://github.com/Own/R"), (F.col("c_custkey") % 300).cast("string"), F.lit(".git")).alias("url"))
    cache = table(spark, sf_dir, "orders").select(F.concat(F.lit("own/R"), (F.col("o_custkey") % 250).cast("string")).alias("repository"), F.col("o_orderdate").alias("fetched_at"), _at(("ok", "not_found", "transient"), F.col("o_orderkey")).alias("status"), F.lit(1).alias("stars"))
    return fetch.repositories_to_ask(hits, "url", cache, F.lit("1998-08-05").cast("timestamp")).select("repository", "state")


@query(
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'malformed' WHEN 2 THEN 'not_found' WHEN 3 THEN 'rate_limited' WHEN 4 THEN CASE WHEN event_id % 4 = 0 THEN 'rate_limited' ELSE 'transient' END ELSE 'transient' END AS answer, CASE WHEN event_id % 6 = 0 THEN 'own/r' || event_id END AS repository, CASE WHEN event_id % 6 = 0 THEN event_id * 2 END AS stars FROM events"""
)
def repository_answers(spark, sf_dir):
    n = F.col("event_id")
    st = _at((200, 200, 404, 429, 403, 502), n)
    body = F.when(n % 6 == 0, F.concat(F.lit('{"full_name":"Own/R'), n.cast("string"), F.lit('","stargazers_count":'), (n * 2).cast("string"), F.lit(',"archived":false,"topics":["a"],"owner":{"secret":1}}'))).otherwise("<html>")
    facts = fetch.repository_facts(body)
    return table(spark, sf_dir, "events").select("event_id", fetch.repository_answer(st, body, F.when(n % 4 == 0, 0).otherwise(9)).alias("answer"), facts["repository"].alias("repository"), facts["stars"].alias("stars"))


@query("WITH o AS (SELECT l_partkey, max(l_linenumber) AS a, max(l_linenumber - 1) AS r, max(l_suppkey % 3) AS h, max(l_linenumber) AS c FROM lineitem GROUP BY 1) SELECT count(*) AS fetches, CAST(sum(a) AS BIGINT) AS attempts, CAST(sum(r) AS BIGINT) AS retries, CAST(sum(h) AS BIGINT) AS redirect_hops, CAST(sum(c) AS BIGINT) AS request_charges FROM o")
def fetch_accounting(spark, sf_dir):
    n = F.col("l_linenumber")
    return fetch.accounting(table(spark, sf_dir, "lineitem").select("l_partkey", n.alias("attempts"), (n - 1).alias("retries"), (F.col("l_suppkey") % 3).alias("redirect_hops"), n.alias("request_charges")), "l_partkey")


@query("SELECT event_id, round(greatest(2.0::DOUBLE * pow(3.0::DOUBLE, event_id % 4) * (1 + (event_id % 3 - 1) * 0.1::DOUBLE), coalesce(CASE WHEN event_id % 5 = 0 THEN 20.0::DOUBLE END, 0)), 6) AS delay, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN NULL ELSE false END AS allowed FROM events")
def retry_and_robots_fallback(spark, sf_dir):
    n = F.col("event_id")
    d = links.retry_delay(n % 4 + 1, 2.0, 3.0, (n % 3 - 1) * F.lit(0.1), F.when(n % 5 == 0, 20.0))
    return table(spark, sf_dir, "events").select("event_id", F.round(d, 6).alias("delay"), links.robots_fallback(_at((404, 503, 200, None), n)).alias("allowed"))
