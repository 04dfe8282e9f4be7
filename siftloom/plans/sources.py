"""Queries over adapters: candidates and results of stored bodies of every kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import adapters
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


def _sources(spark, sf_dir):
    """A source for each page: feeds, JSON and index pages, some of them broken, empty or not fetched."""
    n, k = F.col("page_id"), F.col("page_id") % 9
    pid = n.cast("string")
    item = lambda j: F.concat(F.lit(f"<item><title>t{j}</title><link>https://c.example.org/"), pid, F.lit(f"/{j}</link></item>"))
    obj = lambda j: F.concat(F.lit('{"t":"t'), F.lit(str(j)), F.lit('","u":"https://c.example.org/'), pid, F.lit(f'/{j}"}}'))
    a = lambda j: F.concat(F.lit('<a href="/ok/'), F.lit(str(j)), F.lit(f'">t{j}</a>'))
    body = (
        F.when(k == 0, F.concat(F.lit("<rss><channel>"), item(0), item(1), item(2), F.lit("</channel></rss>")))
        .when(k == 1, "<rss><channel>")
        .when(k == 2, "<rss><channel/></rss>")
        .when(k == 3, F.concat(F.lit('{"d":['), obj(0), F.lit(","), obj(1), F.lit("]}")))
        .when(k == 4, '{"d":1}')
        .when(k == 5, F.concat(a(0), a(1), a(0), a(2), F.lit('<a href="/no">n</a><a href="https://x.example.net/ok/1">x</a>')))
        .when(k == 6, '<a href="/no">n</a>')
    )
    kind = F.when(k.isin(0, 1, 2, 7), "feed").when(k.isin(3, 4), "json_api").otherwise("seed")
    return table(spark, sf_dir, "pages").select(
        pid.alias("source_id"), kind.alias("adapter"), F.lit("https://c.example.org/").alias("url"), body.alias("body"), F.when(k == 7, "robots_denied").when(k == 8, "http_timeout").alias("fetch_reason"), F.when(k == 0, 2).alias("max_candidates"),
        F.create_map(F.lit("items"), F.lit("d"), F.lit("target_url"), F.lit("u"), F.lit("title"), F.lit("t")).alias("mapping"), F.array(F.lit("/ok")).alias("prefixes"), F.lit(2).alias("max_children"),
    )


@query(
    """SELECT CAST(page_id AS VARCHAR) AS source_id, CASE page_id % 9 WHEN 0 THEN 'feed' WHEN 3 THEN 'json_api' ELSE 'seed' END AS adapter, k AS position, 'https://c.example.org/' || CASE WHEN page_id % 9 = 5 THEN 'ok' ELSE CAST(page_id AS VARCHAR) END || '/' || k AS target_url, 't' || k AS title FROM pages, (VALUES (0), (1)) v(k) WHERE page_id % 9 IN (0, 3, 5)"""
)
def adapter_candidates(spark, sf_dir):
    return adapters.discover(_sources(spark, sf_dir))[0].select("source_id", "adapter", "position", "target_url", "title")


@query(
    """SELECT CAST(page_id AS VARCHAR) AS source_id, ['feed', 'feed', 'feed', 'json_api', 'json_api', 'seed', 'seed', 'feed', 'seed'][1 + page_id % 9] AS adapter, ['ok', 'adapter_error', 'zero_result', 'ok', 'adapter_error', 'ok', 'zero_result', 'infrastructure_error', 'infrastructure_error'][1 + page_id % 9] AS result,
  [NULL, 'feed_parse_error', 'no_items_in_window', NULL, 'schema_mapping_failed', NULL, 'no_links_matched_allowlist', 'robots_denied', 'http_timeout'][1 + page_id % 9] AS reason, CASE WHEN page_id % 9 IN (0, 3, 5) THEN 2 ELSE 0 END AS candidates, CASE WHEN page_id % 9 = 0 THEN 1 ELSE 0 END AS dropped_over_cap FROM pages"""
)
def adapter_results(spark, sf_dir):
    return adapters.discover(_sources(spark, sf_dir))[1]
