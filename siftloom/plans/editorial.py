"""Queries of editorial policies, lookups and fan-outs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import policies, records
from .frames import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d, round(o_totalprice / 500000::DOUBLE, 4) AS c FROM orders),
v AS (SELECT *, CASE WHEN d IS NULL THEN 'context' WHEN d > DATE '1997-12-31' OR d < DATE '1993-01-01' THEN 'reject' WHEN d < DATE '1994-01-01' THEN 'flag' ELSE 'accept' END AS verdict FROM o),
w AS (SELECT o_orderkey, verdict, CASE WHEN verdict = 'flag' THEN least(c, 0.4::DOUBLE) ELSE c END AS confidence FROM v)
SELECT *, CASE WHEN confidence >= 0.9 THEN 'very_high' WHEN confidence >= 0.7 THEN 'high' WHEN confidence >= 0.5 THEN 'medium' WHEN confidence >= 0.3 THEN 'low' ELSE 'very_low' END AS band FROM w"""
)
def date_window_policy(spark, sf_dir):
    d = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate").cast("date"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", policies.date_window(d, "1994-01-01", "1993-01-01", "1997-12-31").alias("verdict"), F.round(F.col("o_totalprice") / 500000, 4).alias("c"))
    o = o.select("o_orderkey", "verdict", policies.capped_confidence(F.col("c"), F.col("verdict")).alias("confidence"))
    return o.withColumn("band", policies.band(F.col("confidence")))


@query("SELECT event_id, coalesce(date_diff('day', CAST(ts AS DATE), DATE '2024-01-20') BETWEEN 0 AND 7, false) AS fresh FROM events")
def freshness_gate(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", policies.is_fresh(F.col("ts"), F.lit("2024-01-20").cast("date"), 7).alias("fresh"))


@query("SELECT p_brand, count(DISTINCT l_suppkey) AS sources FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_partkey % 97 = 0) GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= 3")
def category_proposals(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    ev = table(spark, sf_dir, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "l_suppkey")
    known = p.where("p_partkey % 97 = 0").select("p_brand", F.when(F.col("p_partkey") % 2 == 0, "active").otherwise("rejected").alias("status"))
    return policies.proposals(ev, known, "p_brand", "l_suppkey")


@query("SELECT min(p_name) AS p_name FROM part WHERE lower(p_name) NOT IN (SELECT lower(p_name) FROM part WHERE p_partkey % 50 = 0) GROUP BY lower(p_name)")
def query_expansion(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return policies.new_queries(p, p.where("p_partkey % 50 = 0").select(F.upper("p_name").alias("p_name")), "p_name")


@query(
    """WITH f AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'paused' END AS status, CAST(c_nationkey + CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS INTEGER) AS run_count, CASE WHEN c_acctbal > 0 THEN coalesce(n, 0) ELSE 0 END AS yield_count FROM customer LEFT JOIN f ON k = c_custkey"""
)
def yield_stamping(spark, sf_dir):
    q = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, "active").otherwise("paused").alias("status"), F.col("c_nationkey").alias("run_count"), F.lit(0).cast("long").alias("yield_count"))
    return policies.stamped(q, table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("SELECT l_orderkey, bool_or(l_returnflag = 'A' OR (l_returnflag = 'R' AND l_linestatus = 'F')) OR count(DISTINCT l_suppkey) >= 2 AS verified FROM lineitem GROUP BY 1")
def kpi_verified(spark, sf_dir):
    tier = F.when(F.col("l_returnflag") == "A", "A").when(F.col("l_returnflag") == "R", "B").otherwise("C")
    s = table(spark, sf_dir, "lineitem").select("l_orderkey", tier.alias("tier"), F.when(F.col("l_linestatus") == "F", "financial").otherwise("press").alias("type"), F.col("l_suppkey").alias("outlet"))
    return policies.verified(s, "l_orderkey")


@query("SELECT n_name, coalesce(string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey), '') AS keys FROM (SELECT n_name, n_nationkey FROM nation UNION ALL SELECT 'no ' || r_name, -1 FROM region) n LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def pattern_index(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "s_suppkey")
    unused = table(spark, sf_dir, "region").select(F.concat(F.lit("no "), F.col("r_name")).alias("n_name"))
    return policies.index_of(n.select("n_name").unionByName(unused), s, "n_name", "s_suppkey").select("n_name", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys"))


_MATCH = "regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://', '')), '^www\\.', ''), '/+$', '')"


@query(
    f"""WITH p AS (SELECT page_id, url, {_MATCH} AS k FROM pages), h AS (SELECT CASE WHEN page_id % 3 = 1 THEN url || '/' ELSE url END AS url FROM pages WHERE page_id % 3 < 2), hk AS (SELECT DISTINCT {_MATCH} AS k FROM h),
l AS (SELECT DISTINCT {_MATCH} AS k FROM pages WHERE page_id % 5 = 0)
SELECT page_id, CASE WHEN url IN (SELECT url FROM h) THEN 'exact_hit' WHEN k IN (SELECT k FROM hk) THEN 'normalized_hit' WHEN k IN (SELECT k FROM l) THEN 'listed' ELSE 'unresolved' END AS kind FROM p"""
)
def url_backfill(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    hits = p.where("page_id % 3 < 2").select(F.when(F.col("page_id") % 3 == 1, F.concat("url", F.lit("/"))).otherwise(F.col("url")).alias("url"))
    return policies.backfill_kind(p, hits, p.where("page_id % 5 = 0"), "url").select("page_id", "kind")


@query("SELECT source, CASE source WHEN 'src0' THEN 'hourly' WHEN 'src1' THEN 'daily' ELSE 'evergreen' END AS tier, count(*) AS n FROM documents GROUP BY 1, 2")
def tier_lookup(spark, sf_dir):
    t = spark.createDataFrame([("src0", "hourly"), ("src1", "daily")], "source string, tier string")
    return policies.tiers(table(spark, sf_dir, "documents").select("source"), t, "source").groupBy("source", "tier").agg(F.count("*").alias("n"))


@query("SELECT p_name AS slug, CAST(CASE WHEN p_partkey % 7 = 0 THEN p_size WHEN p_size > 30 THEN 10 WHEN p_size > 10 THEN 3 ELSE 0 END AS INTEGER) AS target FROM part")
def target_minimums(spark, sf_dir):
    tier = F.when(F.col("p_size") > 30, "priority").when(F.col("p_size") > 10, "standard").otherwise("record_only")
    e = table(spark, sf_dir, "part").select(F.col("p_name").alias("slug"), tier.alias("tier"), F.when(F.col("p_partkey") % 7 == 0, F.col("p_size")).alias("override"))
    return policies.target_minimum(e, spark.createDataFrame([("priority", 10), ("standard", 3), ("record_only", 0)], "tier string, default_min int"))


@query("SELECT source AS slug, count(DISTINCT lang) AS axes FROM documents WHERE source <> 'src0' GROUP BY 1 HAVING count(DISTINCT lang) > 1")
def vocabulary_overlap(spark, sf_dir):
    return policies.shared_slugs(table(spark, sf_dir, "documents").select("lang", F.col("source").alias("slug")), "lang", "slug", ["src0"])


@query("SELECT n_name AS name, 'reserved' AS finding FROM nation WHERE regexp_matches(n_name, '[#_/\\\\|]') UNION ALL SELECT min(p_brand), 'repeated' FROM part GROUP BY lower(p_brand) HAVING count(*) > 1 UNION ALL SELECT p_brand, 'reserved' FROM part WHERE regexp_matches(p_brand, '[#_/\\\\|]')")
def matrix_names(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).unionByName(table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")))
    return policies.name_findings(n, "name")


@query("WITH o AS (SELECT l_partkey, min({'f': l_returnflag, 's': l_suppkey}) AS r FROM lineitem GROUP BY 1) SELECT p_partkey, p_brand, r.f AS l_returnflag, r.s AS l_suppkey FROM part JOIN o ON l_partkey = p_partkey")
def outcome_fan_out(spark, sf_dir):
    owners = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return records.outcome_fan_out(table(spark, sf_dir, "lineitem"), owners, "l_partkey", ["l_returnflag", "l_suppkey"]).select(F.col("l_partkey").alias("p_partkey"), "p_brand", "l_returnflag", "l_suppkey")


@query("SELECT c_custkey, greatest(0.5, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey::DOUBLE END, CASE WHEN c_custkey % 5 = 0 THEN 2.5 END)::DOUBLE AS seconds, CAST(greatest(1, least(4, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END)) AS INTEGER) AS concurrency FROM customer")
def host_pacing(spark, sf_dir):
    own = F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", policies.effective_interval(F.lit(0.5), own.cast("double"), F.when(F.col("c_custkey") % 5 == 0, F.lit(2.5))).alias("seconds"), policies.concurrency(F.lit(4), own).alias("concurrency"))


@query("SELECT s_suppkey, CASE s_suppkey % 5 WHEN 1 THEN 'absent' WHEN 2 THEN 'new' WHEN 3 THEN 'empty' WHEN 4 THEN 'differs' ELSE 'identical' END AS s FROM supplier")
def publication_states(spark, sf_dir):
    from ..operators.compare import publication_state

    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 5
    left = s.where("s_suppkey % 5 <> 2").select("s_suppkey", F.sha2("s_name", 256).alias("digest"))
    right = s.where("s_suppkey % 5 <> 1").select("s_suppkey", F.when(k == 3, "").when(k == 4, F.sha2(F.concat("s_name", F.lit("x")), 256)).otherwise(F.sha2("s_name", 256)).alias("digest"))
    return publication_state(left, right, "s_suppkey", "digest").withColumnRenamed("state", "s")
