"""Queries over addresses and names beyond identity: options of the canonical form,
repositories, references, legacy keys, lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning, urls
from ..sources import readers
from .frames import canonical_sql, split_sql, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_HOST = "regexp_replace(regexp_replace(lower(u.n), '^.*@', ''), ':[^:\\]]*$', '')"
_REG = "array_to_string(string_split(h, '.')[-2:], '.')"


@query(
    f"""WITH x AS (SELECT page_id, {split_sql("regexp_replace(url, '#.*$', '') || '#' || CASE page_id % 3 WHEN 0 THEN 'top' WHEN 1 THEN '!/a' ELSE '/b' END")} AS u FROM pages), y AS (SELECT *, {_HOST} AS h FROM x), z AS (SELECT *, {_REG} AS r FROM y),
d AS (SELECT *, page_id % 3 = 0 AND CASE WHEN ends_with(r, 'example.com') THEN true WHEN ends_with(r, 'example.org') THEN false ELSE false END OR (page_id % 3 = 0 AND page_id % 5 = 0) AS droppable FROM z)
SELECT page_id, droppable, CASE WHEN droppable THEN regexp_replace(c, '#.*$', '') ELSE c END AS canonical_url FROM (SELECT *, {canonical_sql("u")} AS c FROM d)"""
)
def fragment_rules(spark, sf_dir):
    f = F.when(F.col("page_id") % 3 == 0, "top").when(F.col("page_id") % 3 == 1, "!/a").otherwise("/b")
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#"), f).alias("url"), (F.col("page_id") % 5 == 0).alias("anchor"))
    rules = spark.createDataFrame([("example.com", True), ("example.org", False)], "host string, strip_fragment boolean")
    x = urls.fragment_droppable(p, "url", rules, "anchor")
    return x.select("page_id", F.col("drop_fragment").alias("droppable"), urls.canonical(F.col("url"), drop_fragment=F.col("drop_fragment")).alias("canonical_url"))


@query(
    """SELECT page_id, 'https://q.example.com/p?' || CASE WHEN page_id % 3 = 0 THEN 'a=1&b=' || page_id WHEN page_id % 3 = 1 THEN 'a=' || page_id || '&a=9&z=%C3%A9%20x' ELSE 'k=' END AS sorted_url FROM pages"""
)
def sorted_queries(spark, sf_dir):
    n = F.col("page_id").cast("string")
    q = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("b="), n, F.lit("&a=1&utm_source=x"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("z=%c3%a9+x&a="), n, F.lit("&a=9"))).otherwise("k&fbclid=1")
    # pairs of one key are sorted by their values too
    q = F.when((F.col("page_id") % 3 == 1) & (n > "9"), F.concat(F.lit("z=%c3%a9+x&a="), n, F.lit("&a=9"))).otherwise(q)
    u = urls.canonical(F.concat(F.lit("HTTPS://Q.example.com:443/p?"), q), sort_query=True)
    swapped = F.regexp_replace(u, r"\?a=9&a=(\d+)&", "?a=$1&a=9&")
    return table(spark, sf_dir, "pages").select("page_id", swapped.alias("sorted_url"))


@query(
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'own' || page_id || '/repo.x' WHEN 1 THEN 'own' || page_id || '/b' WHEN 2 THEN 'o_w/r-' || page_id END AS repository FROM pages"""
)
def repository_roots(spark, sf_dir):
    n = F.col("page_id").cast("string")
    k = F.col("page_id") % 6
    u = (
        F.when(k == 0, F.concat(F.lit("https://github.com/Own"), n, F.lit("/Repo.x")))
        .when(k == 1, F.concat(F.lit("HTTP://www.GitHub.com/own"), n, F.lit("/B.git?tab=readme")))
        .when(k == 2, F.concat(F.lit("https://github.com/o_w/r-"), n, F.lit("/#readme")))
        .when(k == 3, F.lit("https://github.com/topics/spark"))
        .when(k == 4, F.concat(F.lit("https://github.com/own/repo/issues/"), n))
        .otherwise("https://gitlab.com/own/repo")
    )
    return table(spark, sf_dir, "pages").select("page_id", urls.repository_root(u).alias("repository"))


@query(
    """SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'https://b.example.com/x/a' || page_id WHEN 1 THEN 'https://b.example.com/a' || page_id WHEN 2 THEN 'https://c.example.com/' WHEN 4 THEN 'https://b.example.com/x/y?q=' || page_id WHEN 5 THEN 'https://b.example.com/z' END AS target_url FROM pages"""
)
def resolved_references(spark, sf_dir):
    n, k = F.col("page_id").cast("string"), F.col("page_id") % 7
    ref = (
        F.when(k == 0, F.concat(F.lit("a"), n))
        .when(k == 1, F.concat(F.lit(" ../a"), n))
        .when(k == 2, "//c.example.com/")
        .when(k == 3, "mailto:x@y.example")
        .when(k == 4, F.concat(F.lit("?q="), n))
        .when(k == 5, "/x/../z")
    )
    return table(spark, sf_dir, "pages").select("page_id", readers.resolved(F.lit("https://b.example.com/x/y"), ref).alias("target_url"))


@query(
    """SELECT page_id, 'finance tech ' || page_id % 5 AS legacy_key, CASE WHEN page_id % 3 = 0 THEN 'a,b' WHEN page_id % 3 = 1 THEN '' END AS listed, CASE page_id % 4 WHEN 0 THEN 'empty_name' WHEN 1 THEN 'repeated_name' WHEN 2 THEN 'empty_selection' END AS refused,
  CASE WHEN page_id % 2 = 0 THEN 'news__ai.json' END AS artifact, 'a.example.com_' || page_id AS domain_slug, CASE page_id % 3 WHEN 0 THEN 'too_long' WHEN 1 THEN 'empty' END AS slug_problem,
  CASE WHEN page_id % 2 = 0 THEN '2024-05-01T00:00:00Z' END AS clock FROM pages"""
)
def names_and_lists(spark, sf_dir):
    n = F.col("page_id")
    listed = F.when(n % 3 == 0, " a, ,b,").when(n % 3 == 1, " , ")
    refused = F.when(n % 4 == 0, "a,,b").when(n % 4 == 1, "a, a").when(n % 4 == 2, "  ").otherwise("a, b")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        cleaning.folded(F.concat(F.lit("  Ｆinance  TECH "), (n % 5).cast("string"))).alias("legacy_key"),
        F.array_join(cleaning.listed(listed), ",").alias("listed"),
        cleaning.listed_problem(refused).alias("refused"),
        cleaning.artifact_name(F.when(n % 2 == 0, "news__ai").otherwise("news__ai__x")).alias("artifact"),
        cleaning.domain_slug(F.concat(F.lit(" A.example.com:"), n.cast("string"), F.lit("/ "))).alias("domain_slug"),
        cleaning.slug_problem(F.when(n % 3 == 0, F.repeat(F.lit("ab "), 60)).when(n % 3 == 1, "— !").otherwise("Fine & dandy")).alias("slug_problem"),
        cleaning.utc_text(cleaning.clock_time(F.when(n % 2 == 0, "2024-05-01T00:00:00Z").otherwise("2024-05-01"))).alias("clock"),
    )


@query(
    """SELECT page_id, CASE WHEN page_id % 5 = 4 THEN NULL ELSE 'ünï ' || page_id END AS text, CASE page_id % 5 WHEN 1 THEN 'iso-8859-1' WHEN 2 THEN 'utf-16' WHEN 3 THEN 'no-such' END AS charset, page_id % 2 = 0 AS html FROM pages"""
)
def decoded_bodies(spark, sf_dir):
    n, k = F.col("page_id"), F.col("page_id") % 5
    text = F.concat(F.lit("ünï "), n.cast("string"))
    ct = F.concat(F.when(n % 2 == 0, "text/HTML").otherwise("application/json"), F.when(k == 1, "; charset=ISO-8859-1").when(k == 2, '; Charset="utf-16"').when(k == 3, ";charset=no-such").otherwise(""))
    body = F.when(k == 1, F.encode(text, "ISO-8859-1")).when(k == 2, F.encode(text, "UTF-16")).when(k == 4, F.lit(None).cast("binary")).otherwise(F.encode(text, "UTF-8"))
    p = table(spark, sf_dir, "pages").select("page_id", ct.alias("ct"), body.alias("body"))
    return p.select("page_id", readers.decoded(F.col("body"), readers.charset_of(F.col("ct"))).alias("text"), readers.charset_of(F.col("ct")).alias("charset"), readers.is_html(F.col("ct")).alias("html"))


@query(
    """SELECT page_id, 0 AS n, 'https://l.example.org/' || page_id AS target_url FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT page_id, 1, 'https://m.example.org/' || page_id || '?a=b' FROM pages"""
)
def markdown_tables(spark, sf_dir):
    n = F.col("page_id").cast("string")
    text = F.concat(
        F.lit("# list\n[no](https://outside.example.org/)\n| name | link |\n|---|---|\n| "), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("[l](https://l.example.org/"), n, F.lit(")"))).otherwise("none"),
        F.lit(" | [m](https://m.example.org/"), n, F.lit("?a=b) |\n| [skip](https://github.com/x/awesome-y) | |\n"),
    )
    links = readers.markdown_links(table(spark, sf_dir, "pages").select("page_id", text.alias("body")), "body")
    return links.select("page_id", F.when(F.col("target_url").startswith("https://l."), 0).otherwise(1).alias("n"), "target_url")


@query(
    """SELECT page_id, CASE page_id % 5 WHEN 0 THEN '{"a": [1, {"b": "}"}], "id": ' || page_id || '}' WHEN 1 THEN '[' || page_id || ']' END AS found FROM pages"""
)
def json_in_prose(spark, sf_dir):
    n, k = F.col("page_id").cast("string"), F.col("page_id") % 5
    one = F.concat(F.lit('{"a": [1, {"b": "}"}], "id": '), n, F.lit("}"))
    text = (
        F.when(k == 0, F.concat(F.lit("Here it is (in {braces}):\n```json\n"), one, F.lit("\n```\nempty: {} []")))
        .when(k == 1, F.concat(F.lit('He said "go" and ['), n, F.lit("] came")))
        .when(k == 2, F.concat(one, F.lit(" and "), one))
        .when(k == 3, "nothing [but { brackets")
    )
    return table(spark, sf_dir, "pages").select("page_id", readers.json_in_text(text).alias("found"))


@query(
    """WITH i AS (SELECT page_id, unnest([0, 2]) AS position FROM pages WHERE page_id % 4 < 2)
SELECT page_id, position, 'https://api.example.org/' || page_id || '/' || position AS target_url, CASE WHEN position = 0 THEN 'T' || page_id END AS title, CAST(position + 7 AS VARCHAR) AS score FROM i"""
)
def json_api_items(spark, sf_dir):
    bodies = _api_bodies(spark, sf_dir)
    return readers.json_items(bodies, "body", "data.items", {"target_url": "links.0.href", "title": "title", "score": "score"}).drop("body")


def _api_bodies(spark, sf_dir):
    n, k = F.col("page_id").cast("string"), F.col("page_id") % 4
    item = lambda p, title: F.concat(F.lit('{"links":[{"href":"https://api.example.org/'), n, F.lit(f'/{p}"}}],"title":'), title, F.lit(f',"score":{p + 7}}}'))
    good = F.concat(F.lit('{"data":{"items":['), item(0, F.concat(F.lit('"T'), n, F.lit('"'))), F.lit(',{"title":"no address"},'), item(2, F.lit("true")), F.lit("]}}"))
    body = F.when(k < 2, good).when(k == 2, F.when(F.col("page_id") % 8 == 2, '{"data":{"items":7}}').otherwise('{"data":{}}')).otherwise(F.when(F.col("page_id") % 8 == 3, "not json").otherwise('{"data":{"items":[{"title":"x"}]}}'))
    return table(spark, sf_dir, "pages").select("page_id", body.alias("body"))


@query(
    """SELECT page_id, 'schema_mapping_failed' AS reason, CASE page_id % 8 WHEN 2 THEN 'items_path_not_a_list' WHEN 6 THEN 'items_path_missing' WHEN 3 THEN 'not_json' ELSE 'target_url_missing' END AS detail FROM pages WHERE page_id % 4 >= 2"""
)
def json_api_problems(spark, sf_dir):
    return readers.json_problems(_api_bodies(spark, sf_dir), "page_id", "body", "data.items", {"target_url": "links.0.href"})


@query(
    """WITH h AS (SELECT page_id, unnest([0, 1, 1]) AS r, unnest([0, 0, 1]) AS k FROM pages) SELECT page_id, r AS result, k AS hit, 'https://s.example.org/' || page_id || '/' || r || '/' || k AS url FROM h WHERE page_id % 3 <> 0 UNION ALL SELECT page_id, 0, 0, 'https://s.example.org/' || page_id || '/only' FROM pages WHERE page_id % 3 = 0"""
)
def search_hits(spark, sf_dir):
    n = F.col("page_id").cast("string")
    hit = lambda r, k: F.concat(F.lit('{"url":"https://s.example.org/'), n, F.lit(f'/{r}/{k}"}}'))
    body = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('{"results":[{"hits":[{"url":"https://s.example.org/'), n, F.lit('/only"},{"title":"no url"}]},{"error":"x"}]}'))).otherwise(F.concat(F.lit('{"results":[{"hits":['), hit(0, 0), F.lit("]},{\"hits\":["), hit(1, 0), F.lit(","), hit(1, 1), F.lit("]}]}")))
    return readers.search_hits(table(spark, sf_dir, "pages").select("page_id", body.alias("body")), "body").select("page_id", "result", "hit", "url")
