"""Queries of ledgers, registry folds, shards and matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import ledger, registry, windows
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


CUT = "2024-01-15"


def observed_events(spark, sf_dir):
    """Events as observations of (user, type); purchases and sign-ups are terminal."""
    outcome = F.when(F.col("event_type") == "purchase", "accepted").when(F.col("event_type") == "error", F.when(F.col("value") > 50, "rejected").otherwise("accepted"))
    return table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("kind"), F.col("ts").alias("seen_at"), outcome.alias("outcome"), F.when(F.col("value") > 10, F.col("value")).alias("value"), "event_id")


_EVENTS = """e AS (SELECT user_id, event_type AS kind, ts, event_id, CASE WHEN value > 10 THEN value END AS value,
  CASE WHEN event_type = 'purchase' THEN 'accepted' WHEN event_type = 'error' THEN CASE WHEN value > 50 THEN 'rejected' ELSE 'accepted' END ELSE 'pending' END AS outcome FROM events)"""


@query(
    f"""WITH {_EVENTS} SELECT user_id, kind, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, count(*) AS seen_count,
  coalesce(arg_min(outcome, {{'a': ts, 'b': outcome}}) FILTER (outcome <> 'pending'), 'pending') AS outcome,
  coalesce(min(outcome) FILTER (outcome <> 'pending') <> max(outcome) FILTER (outcome <> 'pending'), false) AS outcome_conflict,
  arg_max(value, {{'a': ts, 'b': CAST(value AS VARCHAR)}}) FILTER (value IS NOT NULL) AS value FROM e GROUP BY user_id, kind"""
)
def ledger_merge(spark, sf_dir):
    o = observed_events(spark, sf_dir)
    none = spark.createDataFrame([], "user_id long, kind string, first_seen_at timestamp, last_seen_at timestamp, seen_count long, outcome string, value double")
    old = ledger.merge_observations(none, o.where(F.col("seen_at") < CUT), ["user_id", "kind"], ["value"])
    new = ledger.merge_observations(old, o.where(F.col("seen_at") >= CUT), ["user_id", "kind"], ["value"])
    # a conflict within the first batch shows in its own report; both are one here
    new = new.join(old.select("user_id", "kind", F.col("outcome_conflict").alias("_c")), ["user_id", "kind"], "left")
    t = lambda c, n: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n)
    return new.select("user_id", "kind", t("first_seen_at", "first_seen"), t("last_seen_at", "last_seen"), "seen_count", "outcome", (F.col("outcome_conflict") | F.coalesce("_c", F.lit(False))).alias("outcome_conflict"), "value")


@query(
    """WITH s AS (SELECT user_id, event_type, count(*) AS n, min(ts) AS a, max(ts) AS z, bool_or(event_type = 'purchase') AS x, list(DISTINCT event_id % 10) AS ids FROM events GROUP BY 1, 2)
SELECT user_id, max(n) AS crawl_count, strftime(min(a), '%Y-%m-%d %H:%M:%S') AS first_crawled, strftime(max(z), '%Y-%m-%d %H:%M:%S') AS last_crawled, bool_or(x) AS extracted,
  array_to_string(list_sort(list_distinct(flatten(list(ids)))), ',') AS case_ids FROM s GROUP BY user_id"""
)
def ledger_shard_union(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    shards = e.groupBy("user_id", "event_type").agg(
        F.count("*").alias("crawl_count"), F.min("ts").alias("first_crawled_at"), F.max("ts").alias("last_crawled_at"),
        F.when(F.bool_or(F.col("event_type") == "purchase"), True).alias("extracted"), F.collect_set(F.col("event_id") % 10).alias("case_ids"),
    )
    u = ledger.merge_shards(shards, "user_id")
    t = lambda c, n: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n)
    return u.select("user_id", "crawl_count", t("first_crawled_at", "first_crawled"), t("last_crawled_at", "last_crawled"), "extracted", F.array_join(F.transform("case_ids", lambda x: x.cast("string")), ",").alias("case_ids"))


@query(
    """WITH p AS (SELECT l_orderkey, arg_max(l_returnflag, {'a': l_linenumber, 'b': l_partkey, 'c': l_suppkey, 'd': l_extendedprice}) AS flag, arg_max(l_shipdate, {'a': l_linenumber, 'b': l_partkey, 'c': l_suppkey, 'd': l_extendedprice}) FILTER (l_quantity > 25) AS ship FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(flag, o_orderstatus) AS status, strftime(coalesce(ship, o_orderdate), '%Y-%m-%d') AS day FROM orders LEFT JOIN p ON l_orderkey = o_orderkey"""
)
def ledger_patch(spark, sf_dir):
    led = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("day"))
    p = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("status"), F.when(F.col("l_quantity") > 25, F.col("l_shipdate")).alias("day"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return ledger.patch(led, p, "o_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    f"""WITH old AS (SELECT user_id, min({{'e': event_id, 'v': value}}) AS r FROM events WHERE ts < TIMESTAMP '{CUT}' GROUP BY user_id),
new AS (SELECT user_id, min({{'e': event_id, 'v': value}}) AS r FROM events WHERE ts >= TIMESTAMP '{CUT}' AND user_id NOT IN (SELECT user_id FROM old) GROUP BY user_id)
SELECT user_id, r.e AS event_id, r.v AS value FROM (SELECT * FROM old UNION ALL SELECT * FROM new)"""
)
def ledger_append(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    old = ledger.append_new(e.where(F.col("ts") < CUT).drop("ts"), e.where(F.lit(False)).drop("ts"), "user_id")
    return ledger.append_new(old, e.where(F.col("ts") >= CUT).drop("ts"), "user_id")


@query(f"SELECT user_id, count(*) AS n FROM events e WHERE ts >= TIMESTAMP '{CUT}' AND NOT EXISTS (SELECT 1 FROM events o WHERE o.user_id = e.user_id AND o.ts < TIMESTAMP '{CUT}' AND o.event_type = 'purchase' AND o.value > 80) GROUP BY user_id")
def gate_unseen(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return ledger.unseen(e.where(F.col("ts") >= CUT), e.where((F.col("ts") < CUT) & (F.col("event_type") == "purchase") & (F.col("value") > 80)), "user_id").groupBy("user_id").agg(F.count("*").alias("n"))


@query(
    """WITH c AS (SELECT user_id, event_id, CASE WHEN event_id % 6 <> 0 THEN sha256(CAST(CAST(floor(value / 20) AS BIGINT) AS VARCHAR)) END AS h, ts FROM events)
SELECT event_id, CAST(row_number() OVER w AS INTEGER) AS place, coalesce(lag(h) OVER w <> h, false) AS changed_materially FROM c WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def link_history_append(spark, sf_dir):
    h = F.when(F.col("event_id") % 6 != 0, urls.content_hash(F.floor(F.col("value") / 20).cast("string")))
    c = table(spark, sf_dir, "events").select(F.col("user_id").alias("link"), F.col("event_id").alias("check_id"), F.col("ts").alias("checked_at"), h.alias("content_hash"))
    return ledger.link_history(c, "link").select(F.col("check_id").alias("event_id"), "place", "changed_materially")


# Ordered folds.


def _cases(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat_ws("|", F.col("o_custkey").cast("string"), F.col("o_orderpriority")).alias("case_key"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("confidence"),
        F.when(F.col("o_orderkey") % 3 != 0, F.date_format("o_orderdate", "yyyy-MM")).alias("month"),
        F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus")).alias("industry"),
        F.array(F.col("o_orderstatus")).alias("sources"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("date")).alias("fresh"),
        F.when(F.col("o_orderkey") % 3 == 0, "verified").when(F.col("o_orderkey") % 3 == 1, "snippet_only").otherwise("none").alias("status"),
    ).withColumn("rank", registry.status_rank(F.col("status")))


_CASES = """c AS (SELECT o_custkey || '|' || o_orderpriority AS case_key, o_orderkey AS seq, o_totalprice AS confidence, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m') END AS month,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS industry, o_orderstatus AS src, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS fresh,
  CASE o_orderkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'snippet_only' ELSE 'none' END AS status, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS rank, o_orderkey % 2 AS side FROM orders),
s AS (SELECT *, row_number() OVER (PARTITION BY case_key ORDER BY side, seq) AS n FROM c)"""


def _folded(spark, sf_dir, how):
    """The even orders as registry (one row a key: the first), folded with the rest."""
    c = _cases(spark, sf_dir)
    even = c.where("seq % 2 = 0")
    none = even.where(F.lit(False))
    return registry.fold(registry.fold(none, even, how).withColumn("seq", F.lit(0).cast("long")), c.where("seq % 2 = 1"), how), how


@query(
    f"""WITH {_CASES}, f AS (SELECT *, first_value(month) OVER (PARTITION BY case_key ORDER BY n) AS held FROM s)
SELECT case_key, max(confidence) AS confidence, min(held) AS month, string_agg(DISTINCT src, ',' ORDER BY src) AS sources, CAST(count(*) AS INTEGER) AS corroboration_count,
  arg_max(fresh, n) FILTER (fresh IS NOT NULL)::VARCHAR AS fresh, arg_min(industry, n) FILTER (industry IS NOT NULL) AS industry FROM f GROUP BY case_key"""
)
def registry_fold(spark, sf_dir):
    how = registry.Fold("case_key", "seq", largest=["confidence"], guarded=["month"], united=["sources"], latest=["fresh"], backfill=["industry"])
    f, _ = _folded(spark, sf_dir, how)
    return f.select("case_key", "confidence", "month", F.array_join("sources", ",").alias("sources"), "corroboration_count", F.col("fresh").cast("string").alias("fresh"), "industry")


@query(
    f"""WITH {_CASES}, f AS (SELECT *, first_value(month) OVER (PARTITION BY case_key ORDER BY n) AS held FROM s)
SELECT case_key, seq, held AS existing, month AS incoming FROM f WHERE month IS NOT NULL AND held IS NOT NULL AND month <> held"""
)
def conflict_log(spark, sf_dir):
    how = registry.Fold("case_key", "seq", guarded=["month"])
    c = _cases(spark, sf_dir)
    f = registry.fold(c.where("seq % 2 = 0").where(F.lit(False)), c.withColumn("seq", F.col("seq") + F.col("seq") % 2 * F.lit(1 << 40)), how)
    return f.select("case_key", F.explode("conflicts").alias("x")).select("case_key", (F.col("x.seq") % (1 << 40)).alias("seq"), "x.existing", "x.incoming")


@query(
    f"""WITH {_CASES}, b AS (SELECT case_key, max(rank) AS m FROM s GROUP BY 1)
SELECT case_key, arg_min(status, n) AS status, CAST(arg_min(confidence, n) AS DOUBLE) AS confidence FROM s JOIN b USING (case_key) WHERE rank = m GROUP BY case_key"""
)
def evidence_upgrade(spark, sf_dir):
    how = registry.Fold("case_key", "seq", rank="rank", ranked=["status", "confidence"])
    f, _ = _folded(spark, sf_dir, how)
    return f.select("case_key", "status", "confidence")


@query("SELECT 'c_mktsegment' AS dimension, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2")
def registry_counts(spark, sf_dir):
    return registry.counted(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey % 2 = 0 UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey % 2 <> 0 AND s_suppkey % 3 = 0")
def shard_union_preserve(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return registry.union_preserving(s.where("s_nationkey % 2 = 0").select("s_suppkey", "s_name"), s.where("s_suppkey % 3 = 0"), "s_suppkey")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey % 2 = 0 AND s_suppkey % 3 <> 0")
def shard_drift(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return registry.drift(s.where("s_nationkey % 2 = 0"), s.where("s_suppkey % 3 = 0"), "s_suppkey")


@query(
    """WITH c AS (SELECT r_name AS category, row_number() OVER (ORDER BY r_regionkey) - 1 AS i FROM region), t AS (SELECT topic, row_number() OVER (ORDER BY topic) - 1 AS j FROM (SELECT DISTINCT c_mktsegment AS topic FROM customer))
SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, category, topic, category || '#' || i || '_' || topic || '#' || j AS cell FROM c, t WHERE (i + j) % 2 = 0"""
)
def matrix_cells(spark, sf_dir):
    from pyspark.sql import Window

    c = table(spark, sf_dir, "region").select(F.col("r_name").alias("category"), (F.row_number().over(Window.orderBy("r_regionkey")) - 1).alias("i"))
    t = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("topic")).distinct()
    t = t.select("topic", (F.row_number().over(Window.orderBy("topic")) - 1).alias("j"))
    pairs = spark.range(100).select((F.col("id") / 10).cast("int").alias("i"), (F.col("id") % 10).cast("int").alias("j")).where("(i + j) % 2 = 0")
    return registry.matrix(c, t, pairs)


@query("SELECT o_custkey, o_orderpriority, arg_max(o_orderstatus, o_orderkey) AS status, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2")
def matrix_last_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("status", F.col("o_orderstatus"))
    return registry.last_wins(o, ["o_custkey", "o_orderpriority"], ["o_orderkey"], ["status", "o_orderkey"])


@query(
    """WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), ':.*$', '') AS host FROM pages),
o(domain, v, k) AS (VALUES ('example.com', 2, 1), ('m.example.com', 4, 2), ('example.org', 3, 1), ('blog.example.org', 1, 2)),
m AS (SELECT page_id, arg_max(v, length(domain)) AS concurrency FROM h JOIN o ON host = domain OR host LIKE '%.' || domain GROUP BY page_id)
SELECT page_id, host, CAST(coalesce(concurrency, 1) AS INTEGER) AS concurrency FROM h LEFT JOIN m USING (page_id)"""
)
def domain_overrides(spark, sf_dir):
    o = spark.createDataFrame([("example.com", 2), ("m.example.com", 4), ("example.org", 3), ("blog.example.org", 1)], "domain string, concurrency int")
    h = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"))
    return registry.suffix_lookup(h, "host", o, "concurrency").select("page_id", "host", F.coalesce("concurrency", F.lit(1)).alias("concurrency"))


# Caps.


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def survivors(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", (-F.col("l_extendedprice")).alias("p"), "l_linenumber", "l_partkey")
    return windows.survivors(li, "l_orderkey", ["p", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """SELECT l_orderkey, l_linenumber FROM (SELECT *, coalesce(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM lineitem) WHERE b < 2"""
)
def accepted_prefix_cap(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "N").alias("accepted"))
    return windows.accepted_prefix(li, "l_orderkey", ["l_linenumber", "l_partkey"], "accepted", 2).select("l_orderkey", "l_linenumber")


@query("SELECT * FROM (SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS place FROM documents) WHERE place <= 25")
def per_source_cap(spark, sf_dir):
    return windows.capped(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"], 25)


@query("SELECT source, count(*) AS total, least(count(*), 25) AS kept, greatest(count(*) - 25, 0) AS dropped FROM documents GROUP BY source")
def cap_report(spark, sf_dir):
    return windows.cap_report(table(spark, sf_dir, "documents"), "source", 25)


@query(
    """WITH i AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
SELECT event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS no_progress FROM i"""
)
def no_progress_streaks(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("progress", F.col("event_type") == "purchase")
    return windows.streaks(e, "user_id", ["ts", "event_id"], "progress").select("event_id", "no_progress")
