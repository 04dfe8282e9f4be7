"""Queries of coverage, calibration, staleness, comparison, validation and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import compare, coverage, links, records
from ..sources import readers
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


_VOCAB = [("lang", "en", "priority", 500), ("lang", "fr", "priority", 900), ("lang", "it", "standard", 40), ("source", "src0", "standard", 60), ("source", "src1", "record_only", 900), ("source", "src2", "standard", 900), ("source", "none", "priority", 10), ("source", "other-unclear", "priority", 10), ("lang", "cross-industry", "standard", 5)]
_VOCAB_SQL = "vocab(axis, slug, tier, target) AS (VALUES " + ", ".join(str(v) for v in _VOCAB) + "), seen AS (SELECT 'lang' AS axis, lang AS slug, count(DISTINCT doc_id) AS observed FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(DISTINCT doc_id) FROM documents GROUP BY 2), tgt AS (SELECT axis, slug, tier, CAST(target AS BIGINT) AS target, coalesce(observed, 0) AS observed, greatest(target - coalesce(observed, 0), 0) AS gap FROM vocab LEFT JOIN seen USING (axis, slug))"


def _targets(spark, sf_dir):
    v = spark.createDataFrame(_VOCAB, "axis string, slug string, tier string, target long")
    return coverage.against_targets(v, coverage.observed(table(spark, sf_dir, "documents"), "doc_id", {"lang": "lang", "source": "source"}))


@query(f"WITH {_VOCAB_SQL} SELECT * FROM tgt")
def coverage_targets(spark, sf_dir):
    return _targets(spark, sf_dir)


@query("SELECT d.lang, d.source, count(*) FILTER (l.toxic IS NOT DISTINCT FROM 0) AS eligible, count(*) FILTER (l.toxic IS DISTINCT FROM 0) AS withheld FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id) GROUP BY 1, 2")
def category_coverage(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ok = F.coalesce(F.col("toxic") == 0, F.lit(False))
    return table(spark, sf_dir, "documents").join(lab, "doc_id", "left").groupBy("lang", "source").agg(F.count_if(ok).alias("eligible"), F.count_if(~ok).alias("withheld"))


_STATS = [("lang", "fr", 0.8, 0.1, 0.2, True), ("source", "src2", 0.25, None, 0.5, False), ("lang", "it", None, 0.3, None, True), ("source", "other-unclear", 1.0, None, None, True)]


@query(
    f"""WITH {_VOCAB_SQL}, st(axis, slug, y, dup, rej, src) AS (VALUES ('lang', 'fr', 0.8, 0.1, 0.2, true), ('source', 'src2', 0.25, NULL, 0.5, false), ('lang', 'it', NULL, 0.3, NULL, true), ('source', 'other-unclear', 1.0, NULL, NULL, true)),
f AS (SELECT axis, slug, gap, least(1.0::DOUBLE, gap / greatest(target, 1)::DOUBLE) AS remaining_gap, CASE tier WHEN 'priority' THEN 1.0::DOUBLE WHEN 'standard' THEN 0.5::DOUBLE ELSE 0 END AS configured_priority, coalesce(y, 0.5)::DOUBLE AS acceptance_yield,
  coalesce(dup, 0)::DOUBLE AS duplicate_rate, coalesce(rej, 0)::DOUBLE AS quality_rejection_rate, CASE WHEN src THEN 1 ELSE 0 END::DOUBLE AS credible_source_available FROM tgt LEFT JOIN st USING (axis, slug) WHERE gap > 0 AND tier <> 'record_only' AND slug NOT IN ('other-unclear', 'cross-industry'))
SELECT axis, slug, gap, round(((((((0.3::DOUBLE * remaining_gap + 0.2::DOUBLE * configured_priority) + 0.15::DOUBLE * acceptance_yield) - 0.1::DOUBLE * duplicate_rate) - 0.1::DOUBLE * quality_rejection_rate) + 0.1::DOUBLE * credible_source_available) + 0.05::DOUBLE * 0.75::DOUBLE), 6) AS score,
  'gap__' || axis || '__' || slug AS lane_id, remaining_gap, acceptance_yield, CASE WHEN credible_source_available = 0 THEN 'no_credible_source' END AS not_opened_reason FROM f"""
)
def gap_rank(spark, sf_dir):
    stats = spark.createDataFrame(_STATS, "axis string, slug string, acceptance_yield double, duplicate_rate double, quality_rejection_rate double, has_source boolean")
    return coverage.rank_gaps(_targets(spark, sf_dir), stats, 0.75).select("axis", "slug", "gap", "score", "lane_id", "factors.remaining_gap", "factors.acceptance_yield", "not_opened_reason")


@query(
    """SELECT bin, count(l) AS n FROM (VALUES ('<0.02', -1e9, 0.02), ('0.02-0.04', 0.02, 0.04), ('0.04-0.06', 0.04, 0.06), ('0.06-0.08', 0.06, 0.08), ('>=0.08', 0.08, 1e9)) b(bin, lo, hi)
LEFT JOIN (SELECT l_discount AS l FROM lineitem) ON l >= lo::DOUBLE AND l < hi::DOUBLE GROUP BY bin"""
)
def confidence_histogram(spark, sf_dir):
    return coverage.histogram(table(spark, sf_dir, "lineitem"), "l_discount", [0.02, 0.04, 0.06, 0.08])


@query("WITH h AS (SELECT c_nationkey, count(*) FILTER (c_acctbal >= 5000) AS passing, round(count(*) FILTER (c_acctbal >= 5000) / 25::DOUBLE, 4) AS headroom FROM customer GROUP BY 1) SELECT *, CASE WHEN headroom >= 1.5 THEN 'OK' WHEN headroom >= 1.0 THEN 'TIGHT' ELSE 'LOW' END AS verdict FROM h")
def headroom(spark, sf_dir):
    return coverage.headroom(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", 5000.0, 25)


@query("SELECT c_nationkey, min(c_acctbal) AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS n FROM customer) WHERE n <= 18 GROUP BY 1")
def kth_threshold(spark, sf_dir):
    return coverage.kth_largest(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", 18)


@query("SELECT o_orderpriority AS value, count(*) AS n, CAST(floor(count(*) * 100 / (SELECT count(*) FROM orders)) AS BIGINT) AS share_pct FROM orders GROUP BY 1")
def pattern_shares(spark, sf_dir):
    return coverage.shares(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT event_type, count(*) AS runs, count(DISTINCT user_id) AS found, round(count(DISTINCT user_id) / count(*)::DOUBLE, 6) AS yield FROM events GROUP BY 1")
def yield_by_topic(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("runs"), F.count_distinct("user_id").alias("found"), F.round(F.count_distinct("user_id") / F.count("*"), 6).alias("yield"))


@query("WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT n AS corroborations, count(*) AS cases FROM c GROUP BY 1")
def corroboration_distribution(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("corroborations")).groupBy("corroborations").agg(F.count("*").alias("cases"))


@query("SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS verified, count(*) FILTER (o_orderstatus = 'P') AS caveat, count(*) FILTER (o_orderstatus = 'O') AS open FROM orders GROUP BY ROLLUP (o_orderpriority)")
def outcome_funnel(spark, sf_dir):
    n = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return table(spark, sf_dir, "orders").rollup("o_orderpriority").agg(F.count("*").alias("total"), n("F").alias("verified"), n("P").alias("caveat"), n("O").alias("open"))


@query(
    """WITH s AS (SELECT o_custkey, max(o_orderdate) AS last, count(*) AS runs, count(*) FILTER (o_orderstatus = 'F') AS found, max(CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 90 DAY END) AS due FROM orders GROUP BY 1),
t AS (SELECT *, CASE WHEN runs >= 3 AND found = 0 THEN 'paused' ELSE 'active' END AS status FROM s)
SELECT o_custkey, status, status = 'active' AND (date_diff('day', last, TIMESTAMP '1998-08-02') >= 180 OR coalesce(CAST(due AS DATE) <= DATE '1998-08-02', false)) AS stale FROM t"""
)
def staleness(spark, sf_dir):
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"), F.count("*").alias("runs"), F.count_if(F.col("o_orderstatus") == "F").alias("found"), F.max(F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS"))).alias("due"))
    s = s.withColumn("status", coverage.lifecycle(F.lit("active"), F.col("runs"), F.col("found")))
    return s.select("o_custkey", "status", coverage.is_stale(F.col("last"), F.col("due"), F.lit("1998-08-02").cast("timestamp"), 180, F.col("status") == "active").alias("stale"))


@query("SELECT lang, source, count(*) AS n, count(DISTINCT text) AS texts FROM documents GROUP BY ROLLUP (lang, source)")
def assessment_rollup(spark, sf_dir):
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.count_distinct("text").alias("texts"))


@query("SELECT sha256(text) AS digest, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_copies(spark, sf_dir):
    return compare.repeated(table(spark, sf_dir, "documents").select(urls.content_hash(F.col("text")).alias("digest")), "digest")


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*) > 1")
def repeated_ids(spark, sf_dir):
    return compare.repeated(table(spark, sf_dir, "conversations"), "conv_id")


@query("WITH p AS (SELECT lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages) SELECT host, count(*) AS pages FROM p GROUP BY 1 HAVING count(*) >= 2")
def shared_hosts(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count("*").alias("pages")).where("pages >= 2")


@query(
    """SELECT coalesce(a.k, b.k) AS key, coalesce(a.path, b.path) AS path, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS kind, a.v AS left_value, b.v AS right_value,
  CASE coalesce(a.path, b.path) WHEN 's_name' THEN 'violation' WHEN 'checked' THEN 'permitted' WHEN 's_nationkey' THEN 'content' ELSE 'violation' END AS verdict
FROM (SELECT CAST(s_suppkey AS VARCHAR) AS k, unnest(['s_name', 's_nationkey', 'checked']) AS path, unnest([s_name, CAST(s_nationkey AS VARCHAR), '1']) AS v FROM supplier WHERE s_suppkey % 10 <> 1) a
FULL JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS k, unnest(['s_name', 's_nationkey', 'checked']) AS path, unnest([CASE WHEN s_suppkey % 9 = 0 THEN s_name || '!' ELSE s_name END, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END, '2']) AS v FROM supplier WHERE s_suppkey % 10 <> 2) b
ON a.k = b.k AND a.path = b.path WHERE a.v IS DISTINCT FROM b.v OR a.k IS NULL OR b.k IS NULL"""
)
def compare_snapshots(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    a = s.where("s_suppkey % 10 <> 1").withColumn("checked", F.lit(1))
    b = s.where("s_suppkey % 10 <> 2").select("s_suppkey", F.when(F.col("s_suppkey") % 9 == 0, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name")).alias("s_name"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey")).alias("s_nationkey"), F.lit(2).alias("checked"))
    return compare.differences(a, b, "s_suppkey", ["checked"], ["s_name"], ["s_nationkey"])


@query("SELECT doc_id, 'missing' AS finding FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'unexpected' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def set_differences(spark, sf_dir):
    return compare.set_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)")
def gate_semi_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0"), "doc_id", "left_semi").select("doc_id")


@query(
    """SELECT doc_id, unnest(list_filter([CASE WHEN n_chars <> length(text) THEN 'n_chars' END, CASE WHEN lang NOT IN ('en', 'fr', 'de') THEN 'lang' END, CASE WHEN source NOT LIKE 'src%' THEN 'source' END, CASE WHEN length(text) < 20 THEN 'short' END], lambda x: x IS NOT NULL)) AS rule FROM documents"""
)
def record_violations(spark, sf_dir):
    rules = {"n_chars": F.col("n_chars") == F.char_length("text"), "lang": F.col("lang").isin("en", "fr", "de"), "source": F.col("source").startswith("src"), "short": F.char_length("text") >= 20}
    return compare.violations(table(spark, sf_dir, "documents"), "doc_id", rules)


@query("WITH d AS (SELECT o_orderkey AS k, o_orderkey % 5 AS declared FROM orders), a AS (SELECT l_orderkey AS k, count(*) AS actual FROM lineitem GROUP BY 1) SELECT coalesce(d.k, a.k) AS l_orderkey, declared, coalesce(actual, 0) AS actual FROM d FULL JOIN a ON d.k = a.k WHERE declared IS DISTINCT FROM coalesce(actual, 0)")
def count_findings(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 5).alias("n"))
    return compare.count_findings(d, table(spark, sf_dir, "lineitem"), "l_orderkey", "n")


_ROBOTS = [("*", "*", "/en/", False), ("*", "*", "/en/4", True), ("*", "*", "/*.html$", False), ("*", "*", "*ref=", False), ("*", "special", "/", False)]


@query(
    """WITH p AS (SELECT page_id, regexp_extract(url, '://[^/?#]*([^?#]*(\\?[^#]*)?)', 1) AS path FROM pages),
r(pat, rx, allow) AS (VALUES ('/en/', '^/en/', 0), ('/en/4', '^/en/4', 1), ('/*.html$', '^/.*\\.html$', 0), ('*ref=', '^.*ref=', 0)),
m AS (SELECT page_id, arg_max(allow, length(pat) * 2 + allow) AS allow FROM p JOIN r ON regexp_matches(path, rx) GROUP BY page_id)
SELECT page_id, coalesce(allow, 1) = 1 AS allowed FROM p LEFT JOIN m USING (page_id)"""
)
def robots_longest_match(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", urls.host(F.col("url")).alias("h"))
    rules = F.array(*[F.struct(F.lit(a).alias("agent"), F.lit(pat).alias("pattern"), F.lit(ok).alias("allow")) for _, a, pat, ok in _ROBOTS])
    r = p.select(F.col("h").alias("host")).distinct().select("host", F.inline(rules))
    return links.robots_allowed(p, "url", r, "siftbot/1.0").select("page_id", "allowed")


@query(
    """WITH RECURSIVE e AS (SELECT 'u' || n_nationkey AS url, 'u' || (CASE WHEN n_nationkey % 5 = 2 THEN 90 ELSE n_nationkey * 3 % 26 END) AS target, CASE WHEN n_nationkey % 4 = 0 THEN 302 ELSE 301 END AS status FROM nation),
w AS (SELECT url, target, 1 AS hops, status = 301 AS permanent, [url, target] AS seen, url = target AS loop FROM e
  UNION ALL SELECT w.url, e.target, hops + 1, permanent AND e.status = 301, list_append(seen, e.target), list_contains(seen, e.target) FROM w JOIN e ON w.target = e.url WHERE NOT loop AND hops <= 3)
SELECT url, arg_max(target, hops) AS final_url, CAST(max(hops) AS INTEGER) AS hops, arg_max(permanent, hops) AS permanent, arg_max(loop, hops) AS loop, max(hops) > 3 AS too_long FROM w GROUP BY url"""
)
def redirect_chain(spark, sf_dir):
    n = table(spark, sf_dir, "nation")  # some chains end outside the table
    u = lambda c: F.concat(F.lit("u"), c.cast("string"))
    return links.redirect_facts(n.select(u(F.col("n_nationkey")).alias("url"), u(F.when(F.col("n_nationkey") % 5 == 2, 90).otherwise(F.col("n_nationkey") * 3 % 26)).alias("target"), F.when(F.col("n_nationkey") % 4 == 0, 302).otherwise(301).alias("status")))


@query(
    """WITH s AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE [200, 301, 404, 403, 402, 410, 418, 503, 304, 401][1 + event_id % 10] END AS st, event_id % 3 = 0 AS perm,
  CASE WHEN event_id % 13 = 0 THEN ['http_timeout', 'robots_denied', 'dns_failure', 'http_4xx', 'http_5xx', 'response_too_large', 'budget_exhausted', 'never_heard_of'][1 + (event_id // 13) % 8] END AS er FROM events),
c AS (SELECT *, CASE WHEN st IN (401, 403) THEN 'auth_required' WHEN st = 402 THEN 'paywalled' WHEN st = 404 THEN 'not_found' WHEN st = 410 THEN 'gone' ELSE 'unreachable' END AS client FROM s)
SELECT event_id, CASE WHEN er = 'http_4xx' THEN client WHEN er = 'http_timeout' THEN 'timeout' WHEN er = 'robots_denied' THEN 'robots_denied' WHEN er IN ('dns_failure', 'response_too_large') THEN 'unreachable' WHEN er = 'http_5xx' THEN 'server_error'
  WHEN er = 'budget_exhausted' THEN 'not_checked' WHEN er IS NOT NULL THEN NULL WHEN st IS NULL THEN 'not_checked' WHEN st IN (200, 304) THEN CASE WHEN perm THEN 'redirected' ELSE 'ok' END
  WHEN st BETWEEN 400 AND 499 THEN client WHEN st >= 500 THEN 'server_error' ELSE 'unreachable' END AS access_status FROM c"""
)
def access_states(spark, sf_dir):
    at = lambda values, n: F.element_at(F.array(*[F.lit(x) for x in values]), (n + 1).cast("int"))
    e = F.col("event_id")
    st = F.when(e % 11 != 0, at((200, 301, 404, 403, 402, 410, 418, 503, 304, 401), e % 10))
    er = F.when(e % 13 == 0, at(("http_timeout", "robots_denied", "dns_failure", "http_4xx", "http_5xx", "response_too_large", "budget_exhausted", "never_heard_of"), F.floor(e / 13) % 8))
    return table(spark, sf_dir, "events").select("event_id", links.access_status(st, er, e % 3 == 0).alias("access_status"))


@query(
    """WITH o AS (SELECT user_id, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS reason FROM events), c AS (SELECT user_id, reason, count(*) AS n, CASE reason WHEN 'error' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS p FROM o WHERE reason IS NOT NULL GROUP BY 1, 2)
SELECT user_id, arg_min(reason, {'a': -n, 'b': p, 'c': reason}) AS reason, max(n) AS n FROM c GROUP BY 1"""
)
def dominant_reasons(spark, sf_dir):
    o = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("reason"))
    return records.dominant_reason(o, "user_id", ["error", "view"])


@query(
    """WITH c AS (SELECT 'n' || n_nationkey AS cell_id FROM nation UNION ALL SELECT 'r' || r_regionkey FROM region), o AS (SELECT 'n' || c_nationkey AS cell_id, count(*) AS candidates, count(*) FILTER (c_acctbal > 9800) AS accepted, count(*) FILTER (c_acctbal <= 9800) AS rejected,
  bool_or(c_custkey % 90 = 0) AS infra, bool_or(c_custkey % 40 = 1) AS adapter FROM customer GROUP BY 1)
SELECT cell_id, CASE WHEN candidates IS NULL THEN 'not_run' WHEN accepted > 0 THEN 'ok' WHEN infra THEN 'infrastructure_error' WHEN adapter THEN 'adapter_error' ELSE 'zero_result' END AS status, coalesce(candidates, 0) AS candidates, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected FROM c LEFT JOIN o USING (cell_id)"""
)
def cell_manifest(spark, sf_dir):
    cell = lambda c: F.concat(F.lit("n"), F.col(c).cast("string")).alias("cell_id")
    ok = F.col("c_acctbal") > 9800
    o = table(spark, sf_dir, "customer").select(cell("c_nationkey"), F.lit(1).cast("long").alias("candidates"), ok.cast("long").alias("accepted"), (~ok).cast("long").alias("rejected"), F.when(F.col("c_custkey") % 90 == 0, "infrastructure_error").when(F.col("c_custkey") % 40 == 1, "adapter_error").alias("error_class"))
    never_run = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("cell_id"))
    return records.cell_status(table(spark, sf_dir, "nation").select(cell("n_nationkey")).unionByName(never_run), o)


@query(
    """WITH r AS (SELECT l_partkey, min('lane' || (l_partkey + l_suppkey % 2) % 5) AS lane_id, max(l_linenumber) AS attempts, max(l_quantity) AS retries FROM lineitem GROUP BY 1)
SELECT lane_id, count(*) AS requests, CAST(sum(attempts) AS BIGINT) AS attempts, sum(retries) AS retries FROM r GROUP BY 1"""
)
def request_accounting(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").select("l_partkey", F.concat(F.lit("lane"), ((F.col("l_partkey") + F.col("l_suppkey") % 2) % 5).cast("string")).alias("lane_id"), F.col("l_linenumber").alias("attempts"), F.col("l_quantity").alias("retries"))
    return records.request_totals(r, "l_partkey", "lane_id")


# Sources.


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, 'v' || event_id AS nested, CAST(event_id AS VARCHAR) AS number, NULL AS flag, 'b' || event_id AS last, CASE WHEN event_id % 2 = 0 THEN 'zero' ELSE 'a' || event_id END AS digit, CAST(event_id % 7 AS VARCHAR) AS odd, NULL AS absent FROM events"""
)
def json_paths(spark, sf_dir):
    eid = F.col("event_id").cast("string")
    listed = F.concat(F.lit('["a'), eid, F.lit('","b'), eid, F.lit('"]'))
    body = F.concat(
        F.lit('{"a":{"b":"v'), eid, F.lit('"},"n":'), eid, F.lit(',"f":true,"l":'), F.when(F.col("event_id") % 2 == 0, F.lit('{"0":"zero"}')).otherwise(listed),
        F.lit(',"m":'), listed, F.lit(',"odd key-$":'), (F.col("event_id") % 7).cast("string"), F.lit("}"),
    )
    e = table(spark, sf_dir, "events").withColumns({"p": F.try_parse_json("props"), "d": F.try_parse_json(body)})
    at = lambda path: readers.json_value(F.col("d"), path)
    return e.select("event_id", readers.json_value(F.col("p"), "k").alias("k"), at("a.b").alias("nested"), at("n").alias("number"), at("f").alias("flag"), at("m.-1").alias("last"), at("l.0").alias("digit"), at("odd key-$").alias("odd"), at("m.-3").alias("absent"))


@query(
    r"""WITH p AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS site, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages),
a AS (SELECT page_id, site || unnest(hrefs) AS target_url, trim(regexp_replace(unnest(texts), '\s+', ' ', 'g')) AS anchor, unnest(range(len(hrefs))) AS n FROM p),
f AS (SELECT page_id, target_url, min(n) AS n, arg_min(anchor, n) AS anchor FROM a GROUP BY 1, 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS position, target_url, anchor FROM f"""
)
def html_links(spark, sf_dir):
    return readers.html_links(table(spark, sf_dir, "pages"), "page_id", "url", "html")


@query(
    r"""WITH p AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS site, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages),
a AS (SELECT page_id, site || unnest(hrefs) AS target_url, unnest(hrefs) AS path, unnest(range(len(hrefs))) AS n FROM p),
f AS (SELECT page_id, target_url, min(n) AS n FROM a WHERE starts_with(path, '/t') OR starts_with(path, '/e') GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS k FROM f)
SELECT page_id, CAST(k AS INTEGER) AS position, target_url FROM r WHERE k < 3"""
)
def index_children(spark, sf_dir):
    """Children of an index page under a path allowlist; anchors of another host are put in to be left out."""
    html = F.replace(F.col("html"), F.lit("<ul>"), F.lit('<ul><a href="https://elsewhere.example.net/tx">x</a><a href="mailto:t@e.example">y</a>'))
    p = table(spark, sf_dir, "pages").withColumn("html", html)
    return readers.index_children(p, "page_id", "url", "html", ("/t", "/e"), most=3).select("page_id", "position", "target_url")


@query(
    """WITH u AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) SELECT page_id, count(*) AS links FROM u GROUP BY 1"""
)
def html_link_counts(spark, sf_dir):
    hrefs = F.regexp_extract_all(F.col("html"), F.lit('<a href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.size(hrefs).cast("long").alias("links")).where("links > 0")


@query(
    """WITH p AS (SELECT page_id, 'https://a.example.com/p/' || page_id AS identity_url, page_id % 6 = 0 AS moved, page_id % 5 AS k, page_id % 7 <> 0 AS allowed FROM pages),
h AS (SELECT *, identity_url || CASE WHEN moved THEN '/new' ELSE '' END AS here, 'https://b.example.com/p/' || page_id AS near, 'https://other.example.org/p/' || page_id AS far FROM p),
d AS (SELECT *, CASE WHEN k = 0 OR (k = 1 AND NOT moved) THEN NULL WHEN k = 4 THEN 'canonical_conflicting' WHEN k = 1 THEN 'canonical_circular' WHEN k = 2 AND NOT allowed THEN 'canonical_not_permitted' WHEN k = 3 AND page_id % 2 = 0 THEN 'canonical_cross_host' END AS conflict FROM h)
SELECT page_id, conflict, CASE WHEN k IN (2, 3) AND conflict IS NULL THEN 'rel_canonical' WHEN moved THEN 'permanent_redirect' END AS alias_kind, CASE WHEN conflict IS NULL AND k = 2 THEN near WHEN conflict IS NULL AND k = 3 THEN far ELSE here END AS canonical_url FROM d"""
)
def alias_decisions(spark, sf_dir):
    """The pages' own HTML with canonical links put into its head."""
    pid, k = F.col("page_id").cast("string"), F.col("page_id") % 5
    here, odd = F.concat(F.lit("https://a.example.com/p/"), pid), F.col("page_id") % 2 == 1
    near, far = F.concat(F.lit("https://b.example.com/p/"), pid), F.concat(F.when(odd, "https://other.example.org/p/").otherwise("https://other.example.net/p/"), pid)
    link = lambda u: F.concat(F.lit('<head><link rel="canonical" href="'), u, F.lit('">'))
    head = F.when(k == 0, "<head>").when(k == 1, link(here)).when(k == 2, link(near)).when(k == 3, link(far)).otherwise(F.concat(link(here), F.lit('<link rel="canonical" href="https://x.example.com/">')))
    p = table(spark, sf_dir, "pages").select(
        "page_id",
        here.alias("identity_url"),
        F.when(F.col("page_id") % 3 == 0, F.concat(here, F.lit("/new"))).alias("final_url"),
        (F.col("page_id") % 6 == 0).alias("permanent_redirect"),
        readers.canonical_tags(F.replace(F.col("html"), F.lit("<head>"), head)).alias("canonical_tags"),
        (F.col("page_id") % 7 != 0).alias("robots_allowed"),
    )
    rules = spark.createDataFrame([("example.com", "example.org")], "from_host string, to_host string")
    return links.alias_decision(p, rules).select("page_id", "conflict", "alias_kind", "canonical_url")


@query(
    """SELECT page_id, k AS position, 'https://feeds.example.org/' || page_id || '/' || k AS target_url, 'T & ' || page_id || ' é–' || k AS title, CASE WHEN k = 0 THEN '2024-01-01' END AS published_at, CASE WHEN page_id % 3 = 2 THEN NULL ELSE '<b>s</b> ' || k END AS summary,
  CASE page_id % 3 WHEN 0 THEN 'The Channel' WHEN 1 THEN 'Ann' ELSE 'dc ' || page_id END AS publisher FROM pages, (VALUES (0), (1)) v(k)"""
)
def feed_items(spark, sf_dir):
    """RSS, Atom with a namespace, RDF with Dublin Core; a self link, a GUID, a relative address, an item without any."""
    pid = F.col("page_id").cast("string")

    def filled(*parts):
        return F.concat(*[pid if p is None else F.lit(p) for p in parts])

    rss = filled(
        '<?xml version="1.0" encoding="utf-8"?><rss><channel><title>The Channel</title><item><title>T &amp; ', None, " &#233;&#x2013;0</title><link>https://feeds.example.org/", None, "/0</link><pubDate>2024-01-01</pubDate><description>&lt;b&gt;s&lt;/b&gt; 0</description></item>",
        "<item><title>no address</title></item><item><title><![CDATA[T & ", None, " é–1]]></title><guid>https://feeds.example.org/", None, "/1</guid><description><![CDATA[<b>s</b> 1]]></description></item></channel></rss>",
    )
    atom = filled(
        '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:title>F</a:title><a:author><a:name>Ann</a:name></a:author><a:entry><a:title>T &amp; ', None, ' é–0</a:title><a:link rel="self" href="https://no.example/"/><a:link rel="alternate" href="/', None, '/0"/><a:updated>2024-01-01</a:updated><a:summary>&lt;b&gt;s&lt;/b&gt; 0</a:summary></a:entry>',
        '<a:entry><a:title>T &amp; ', None, ' é–1</a:title><a:link href="', None, '/1"/><a:content>&lt;b&gt;s&lt;/b&gt; 1</a:content></a:entry></a:feed>',
    )
    rdf = filled(
        '<r:RDF xmlns:r="r" xmlns:dc="dc"><item><title>T &amp; ', None, " é–0</title><link>https://feeds.example.org/", None, "/0</link><dc:date>2024-01-01</dc:date><dc:creator>dc ", None, "</dc:creator></item><item><title>T &amp; ", None, " é–1</title><link>https://feeds.example.org/", None, "/1</link><dc:creator>dc ", None, "</dc:creator></item></r:RDF>",
    )
    b = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, rss).when(F.col("page_id") % 3 == 1, atom).otherwise(rdf).alias("body"), F.lit("https://feeds.example.org/").alias("base"))
    return readers.feed_items(b, "body", base="base").drop("body", "base")
