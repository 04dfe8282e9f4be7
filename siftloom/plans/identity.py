"""Queries over addresses: canonical form, keys, guards, groups of observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning, urls
from ..operators import dedupe
from .frames import DELIVERIES_SQL, TITLE, canonical_sql, deliveries, observed, split_sql, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_PAGES = f"x AS (SELECT *, {split_sql('url')} AS u FROM pages), c AS (SELECT *, {canonical_sql('u')} AS canonical_url FROM x)"


@query(f"WITH {_PAGES} SELECT page_id, canonical_url FROM c")
def url_canonical(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical(F.col("url")).alias("canonical_url"))


@query(
    f"""WITH {_PAGES} SELECT page_id, sha256(canonical_url)[1:16] AS content_id, sha256('news|' || canonical_url)[1:16] AS record_id, sha256(html) AS content_hash,
  sha256('moved' || chr(31) || canonical_url || chr(31) || url)[1:16] AS conflict_id FROM c"""
)
def content_identity(spark, sf_dir):
    c = urls.canonical(F.col("url"))
    p = table(spark, sf_dir, "pages").withColumn("c", c)
    return p.select("page_id", urls.content_id(F.col("c")).alias("content_id"), urls.record_id(F.lit("news"), F.col("c")).alias("record_id"), urls.content_hash(F.col("html")).alias("content_hash"), urls.conflict_id(F.lit("moved"), F.col("c"), F.col("url")).alias("conflict_id"))


@query(
    f"""WITH {_PAGES}, h AS (SELECT regexp_replace(regexp_replace(lower(u.n), '^.*@', ''), ':[^:\\]]*$', '') AS host FROM c)
SELECT array_to_string(string_split(host, '.')[-2:], '.') AS domain, count(*) AS pages, count(DISTINCT host) AS hosts FROM h GROUP BY 1"""
)
def registrable_hosts(spark, sf_dir):
    h = table(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("host"))
    return h.groupBy(urls.registrable(F.col("host")).alias("domain")).agg(F.count("*").alias("pages"), F.count_distinct("host").alias("hosts"))


@query(
    f"""WITH {_PAGES}, q AS (SELECT *, list_filter(string_split(ltrim(u.q, '?'), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_')) AS ps FROM c)
SELECT page_id, regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://', '')), '^www\\.', ''), '/+$', '') AS match_key,
  lower(u.s) || '://' || lower(u.n) || regexp_replace(u.p, '/+$', '') || CASE WHEN len(ps) = 0 THEN '' ELSE '?' || array_to_string(ps, '&') END AS visited_key,
  sha256(concat_ws('|', 'src' || page_id % 7, 'GET', canonical_url, CASE WHEN page_id % 2 = 0 THEN 'default' ELSE 'conditional' END, CASE WHEN page_id % 3 = 0 THEN 'accept:text/html,accept-language:en' ELSE 'accept:*/*' END, sha256('b' || page_id), 'preserve', '1')) AS request_key, array_to_string(list_sort(list_filter(string_split(ltrim(u.q, '?'), '&'), lambda p: p <> '')), '&') AS sorted_query FROM q"""
)
def url_keys(spark, sf_dir):
    u = F.col("url")
    n, v = F.col("page_id"), lambda *x: F.create_map(*[F.lit(y) for y in x])
    headers = F.when(n % 3 == 0, v("Accept-Language", "en", "ACCEPT", " text/html", "X-Trace", "7")).otherwise(v("accept", "*/*", "cookie", "k=1"))
    mode, source = F.when(n % 2 == 0, "default").otherwise("conditional"), F.concat(F.lit("src"), (n % 7).cast("string"))
    key = urls.request_key(source, u, mode, headers=headers, body=F.concat(F.lit("b"), n.cast("string")).cast("binary"))
    return table(spark, sf_dir, "pages").select("page_id", urls.match_key(u).alias("match_key"), urls.visited_key(u).alias("visited_key"), key.alias("request_key"), urls.stably_sorted_query(u).alias("sorted_query"))


@query(
    f"""WITH t AS (SELECT page_id, regexp_extract(html, '{TITLE}', 1) AS title FROM pages),
s AS (SELECT *, regexp_replace(regexp_replace(lower(strip_accents(replace(title, '&', ' and '))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS y FROM t)
SELECT page_id, nullif(regexp_replace(y[1:120], '-+$', ''), '') AS slug, translate(regexp_replace(trim(title), '\\s+', ' ', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS name_key FROM s"""
)
def slugs(spark, sf_dir):
    t = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", TITLE, 1).alias("title"))
    return t.select("page_id", cleaning.slug(F.col("title")).alias("slug"), cleaning.ascii_key(F.col("title")).alias("name_key"))


@query(
    f"""WITH x AS (SELECT *, {split_sql('url')} AS u FROM pages), y AS (SELECT *, list_filter(string_split(lower(u.p), '/'), lambda s: s <> '') AS seg,
  list_transform(list_filter(string_split(ltrim(u.q, '?'), '&'), lambda p: p <> ''), lambda p: lower(split_part(p, '=', 1))) AS ks, regexp_replace(regexp_replace(lower(u.n), '^.*@', ''), ':[^:\\]]*$', '') AS h FROM x)
SELECT page_id, CASE WHEN h IN ('search.example.com', 'duckduckgo.com', 'www.google.com', 'www.bing.com') OR split_part(h, '.', 1) = 'search' THEN 'search_host'
  WHEN coalesce(seg[-1], '') = 'search' OR list_has_any(ks, ['q', 'query', 's']) THEN 'search_path'
  WHEN coalesce(seg[-1], '') IN ('feed', 'rss', 'atom') OR regexp_matches(coalesce(seg[-1], ''), '\\.(rss|atom|xml)$') THEN 'feed'
  WHEN list_has_any(seg, ['category', 'categories', 'tag', 'tags']) OR regexp_matches(lower(u.p), '/awesome-|/page/[0-9]+(/|$)') OR regexp_matches(coalesce(seg[-1], ''), '^readme(\\.md)?$') THEN 'index' END AS suspicion FROM y"""
)
def suspicious_url_guard(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.suspicion(F.col("url")).alias("suspicion"))


@query(
    f"""WITH {DELIVERIES_SQL}
SELECT candidate_key, count(*) AS observation_count, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS source_ids, string_agg(DISTINCT lane_id, ',' ORDER BY lane_id) AS lane_ids,
  arg_min(target_url, o) AS first_url, arg_min(title, o) FILTER (trim(title) <> '') AS title FROM obs WHERE canonical_url IS NOT NULL GROUP BY candidate_key"""
)
def dedupe_groups(spark, sf_dir):
    g = dedupe.groups(observed(spark, sf_dir), "candidate_key", ["title"])
    return g.select("candidate_key", "observation_count", F.array_join("source_ids", ",").alias("source_ids"), F.array_join("lane_ids", ",").alias("lane_ids"), "first_url", "title")


@query(
    f"""WITH {DELIVERIES_SQL}, v AS (SELECT candidate_key, target_url AS value, min(o) AS o, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources FROM obs GROUP BY 1, 2)
SELECT candidate_key, value, CAST(row_number() OVER (PARTITION BY candidate_key ORDER BY o) AS INTEGER) AS place, sources FROM v"""
)
def dedupe_variants(spark, sf_dir):
    o = observed(spark, sf_dir).withColumn("address", F.col("target_url"))
    return dedupe.variants(o, "candidate_key", "address").withColumn("sources", F.array_join("sources", ","))


@query(
    f"""WITH {DELIVERIES_SQL}, v AS (SELECT candidate_key, topic, category, min(o) AS o FROM obs GROUP BY 1, 2, 3)
SELECT candidate_key, string_agg(topic || '/' || category, ',' ORDER BY o) AS contexts FROM v GROUP BY 1"""
)
def dedupe_contexts(spark, sf_dir):
    c = dedupe.contexts(observed(spark, sf_dir), "candidate_key")
    return c.select("candidate_key", F.array_join(F.transform("contexts", lambda x: F.concat_ws("/", x["topic"], x["category"])), ",").alias("contexts"))


@query(
    f"""WITH {DELIVERIES_SQL} SELECT topic, count(canonical_url) AS observations, count(DISTINCT candidate_key) AS unique_candidates, count(canonical_url) - count(DISTINCT candidate_key) AS repeats,
  count(*) - count(canonical_url) AS unusable FROM obs GROUP BY topic"""
)
def sighting_counts(spark, sf_dir):
    return dedupe.sightings(deliveries(spark, sf_dir), "candidate_key", ["topic"])


@query(
    f"""WITH {DELIVERIES_SQL}, x AS (SELECT *, CASE position % 5 WHEN 0 THEN '' WHEN 1 THEN 'Unknown' ELSE title END AS t, CASE position % 4 WHEN 0 THEN NULL WHEN 1 THEN 'someday' WHEN 2 THEN 'unknown' ELSE '2024-01-02T03:04:05Z' END AS d, position % 3 = 0 AS two FROM obs),
i AS (SELECT lane_id, unnest([CASE WHEN coalesce(trim(t), '') = '' THEN 'title:missing' WHEN lower(t) = 'unknown' THEN 'title:unknown_sentinel' END, CASE WHEN d IS NULL THEN 'published_at:missing' WHEN d = 'unknown' THEN 'published_at:unknown_sentinel' WHEN d = 'someday' THEN 'published_at:unparseable_date' END, CASE WHEN two THEN 'title:conflicting_values' END]) AS issue FROM x)
SELECT lane_id, issue, count(*) AS n FROM i WHERE issue IS NOT NULL GROUP BY 1, 2"""
)
def extraction_issues(spark, sf_dir):
    n = F.col("position")
    d = deliveries(spark, sf_dir).withColumns(
        {
            "title": F.when(n % 5 == 0, "").when(n % 5 == 1, "Unknown").otherwise(F.col("title")),
            "published_at": F.when(n % 4 == 1, "someday").when(n % 4 == 2, "unknown").when(n % 4 == 3, "2024-01-02T03:04:05Z"),
            "titles": F.when(n % 3 == 0, F.array(F.lit("a"), F.lit(" "), F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("a"), F.lit(""))),
        }
    )
    x = dedupe.extraction_issues(d, ["title", "published_at"], "published_at", {"title": "titles"})
    return x.select("lane_id", F.explode("issues").alias("i")).groupBy("lane_id", F.concat_ws(":", "i.field", "i.kind").alias("issue")).agg(F.count("*").alias("n"))
