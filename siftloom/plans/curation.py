"""Queries of the curation core: signals, rules, scores, gates, facets, records."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import cleaning
from ..functions.signals import Signal
from ..operators import facets, records, score
from ..operators.scan import Search, scan
from .frames import CLASSIFIED_SQL, FACETS, RULES, SCORED_SQL, SIGNALS, SIGNALS_SQL, _term_sql, classified, judged, scanned, scored, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {SIGNALS_SQL} SELECT doc_id, {', '.join(f'on_{s.name} AS {s.name}' for s in SIGNALS)} FROM sig")
def signal_match(spark, sf_dir):
    return scanned(spark, sf_dir).select("doc_id", *[F.col(f"on_{s.name}").alias(s.name) for s in SIGNALS])


_first = " ".join(f"WHEN on_{s.name} THEN '{s.name}'" for s in SIGNALS if isinstance(s, Signal))


@query(f"WITH {CLASSIFIED_SQL} SELECT doc_id, rule_id, topic, category, array_to_string(others, ',') AS competing, len(others) > 0 AS ambiguous, CASE {_first} END AS first_signal, rule_id = 'fallback' AS undecided, rule_id <> 'fallback' AND NOT (topic IS NOT DISTINCT FROM lang AND category IS NOT DISTINCT FROM source) AS differs FROM cl")
def rule_classify(spark, sf_dir):
    c = classified(spark, sf_dir)
    return c.select("doc_id", "rule_id", "topic", "category", F.array_join(F.transform("competing", lambda x: x["rule_id"]), ",").alias("competing"), "ambiguous", F.get("evidence", F.lit(0))["signal"].alias("first_signal"), F.col("rationale").startswith("no rule fired").alias("undecided"), F.col("differs_from_discovery").alias("differs"))


@query(f"WITH {SCORED_SQL} SELECT doc_id, relevance, quality, audience_fit, freshness, composite FROM scored")
def score_composite(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "relevance", "quality", "audience_fit", "freshness", "composite")


@query(f"WITH {SCORED_SQL} SELECT doc_id, rejection_reason IS NULL AS accepted, rejection_reason, detail FROM scored")
def decide_gate(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "accepted", "rejection_reason", "detail")


@query(f"WITH {SCORED_SQL} SELECT rejection_reason, count(*) AS n, min(composite) AS lowest FROM scored WHERE rejection_reason IS NOT NULL GROUP BY 1")
def rejection_log(spark, sf_dir):
    return scored(spark, sf_dir).where("not accepted").groupBy("rejection_reason").agg(F.count("*").alias("n"), F.min("composite").alias("lowest"))


@query("SELECT o_orderkey, round(pow(0.5::DOUBLE, greatest((epoch(TIMESTAMP '1998-08-02') - epoch(o_orderdate)) / 86400.0::DOUBLE, 0.0::DOUBLE) / 365.0::DOUBLE), 4) AS freshness FROM orders")
def freshness_decay(spark, sf_dir):
    f = score.freshness(F.col("o_orderdate"), F.lit("1998-08-02").cast("timestamp"), 365.0)
    return table(spark, sf_dir, "orders").select("o_orderkey", f.alias("freshness"))


VOCABULARY = [(a, s, t) for a, s, t in config.vocabulary(FACETS, active=True) if t]


def _facet_evidence(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    return facets.evidence(d, "doc_id", {"text": "text", "publisher": "source"}, VOCABULARY, config.barred(FACETS))


_FOUND = (
    "d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), found AS ("
    + " UNION ALL ".join(f"SELECT doc_id, '{a}' AS axis, '{s}' AS slug, {' + '.join(f'{_term_sql(t)}::INT' for t in terms)} AS n FROM d" for a, s, terms in VOCABULARY)
    + "), ev AS (SELECT * FROM found WHERE n > 0)"
)


@query(
    f"""WITH {_FOUND}, r AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY n DESC) AS k, count(*) OVER (PARTITION BY doc_id, n) AS same FROM ev WHERE axis = 'industry')
SELECT doc_id, CASE WHEN max(same) > 1 THEN 'other-unclear' ELSE min(slug) END AS slug, round(least(max(n), 3) / 3::DOUBLE, 4) AS confidence, max(same) > 1 AS tie FROM r WHERE k = 1 GROUP BY doc_id"""
)
def facet_industry(spark, sf_dir):
    return facets.single(_facet_evidence(spark, sf_dir), "doc_id", "industry")


@query(
    f"""WITH {_FOUND}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, slug) AS k FROM ev WHERE axis = 'function')
SELECT doc_id, string_agg(CASE WHEN k <= 4 THEN slug END, ',' ORDER BY k) AS slugs, coalesce(string_agg(CASE WHEN k > 4 THEN slug END, ',' ORDER BY k), '') AS dropped FROM r GROUP BY doc_id"""
)
def facet_functions(spark, sf_dir):
    s = facets.several(_facet_evidence(spark, sf_dir), "doc_id", "function")
    return s.select("doc_id", F.array_join("slugs", ",").alias("slugs"), F.array_join("dropped", ",").alias("dropped"))


_STATE = f"""{_FOUND}, i AS (SELECT doc_id, max(n) AS m, count(*) FILTER (n = mx) AS tops FROM (SELECT *, max(n) OVER (PARTITION BY doc_id) AS mx FROM ev WHERE axis = 'industry') GROUP BY doc_id),
f AS (SELECT doc_id, count(*) AS fs FROM ev WHERE axis = 'function' GROUP BY doc_id),
s AS (SELECT documents.doc_id, CASE WHEN lang = 'es' THEN NULL WHEN documents.doc_id % 17 = 0 THEN 'unmapped_legacy_value' WHEN documents.doc_id % 13 = 0 THEN 'not_enriched' WHEN coalesce(tops, 0) = 1 AND coalesce(fs, 0) > 0 THEN 'facet_complete'
  WHEN coalesce(tops, 0) = 1 OR coalesce(fs, 0) > 0 THEN 'facet_partial' ELSE 'unresolved' END AS state FROM documents LEFT JOIN i USING (doc_id) LEFT JOIN f USING (doc_id))"""


def _states(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    lists = facets.term_lists(VOCABULARY, ["text"])
    ev = scan(d, Search({"text": "text"}, (), lists), ["doc_id", "lang"]).withColumn("found", facets.found_array(list(lists)))
    ind, fun = facets.ranked("industry"), facets.ranked("function")
    one = (F.size(ind) > 0) & ~F.coalesce(F.get(ind, F.lit(1))["o"] == F.get(ind, F.lit(0))["o"], F.lit(False))
    return ev.select("doc_id", facets.reporting_state(F.coalesce(F.col("lang") != "es", F.lit(True)), F.col("doc_id") % 13 != 0, F.col("doc_id") % 17 == 0, one, F.size(fun)).alias("state"))


@query(f"WITH {_STATE} SELECT doc_id, state FROM s")
def reporting_state(spark, sf_dir):
    return _states(spark, sf_dir)


@query(f"WITH {_STATE} SELECT v.state, count(s.state) AS n FROM (VALUES {', '.join(f"('{x}')" for x in facets.STATES)}) v(state) LEFT JOIN s USING (state) GROUP BY 1")
def reporting_states(spark, sf_dir):
    return facets.tally(_states(spark, sf_dir), "state")


_axis = "SELECT doc_id, list(slug ORDER BY n DESC, slug) AS slugs, count(*) FILTER (n = mx) AS tops FROM (SELECT *, max(n) OVER (PARTITION BY doc_id) AS mx FROM ev WHERE axis = '{}') GROUP BY doc_id"


@query(
    f"""WITH {_FOUND}, i AS ({_axis.format('industry')}), f AS ({_axis.format('function')}), u AS ({_axis.format('use_case')})
SELECT d.doc_id, CASE WHEN d.lang = 'es' THEN NULL WHEN i.tops > 1 THEN 'other-unclear' ELSE i.slugs[1] END AS industry, CASE WHEN d.lang = 'es' THEN NULL ELSE coalesce(array_to_string(f.slugs[1:4], ','), '') END AS functions,
  CASE WHEN d.lang = 'es' THEN NULL ELSE coalesce(array_to_string(u.slugs[1:4], ','), '') END AS use_cases,
  CASE WHEN d.lang = 'es' THEN NULL ELSE concat_ws('; ', CASE WHEN f.doc_id IS NULL THEN 'function: insufficient_evidence' WHEN len(f.slugs) > 4 THEN 'function: other-unclear: dropped: ' || array_to_string(f.slugs[5:], ', ') END,
    CASE WHEN i.doc_id IS NULL THEN 'industry: insufficient_evidence' WHEN i.tops > 1 THEN 'industry: other-unclear: equally supported: ' || array_to_string(i.slugs[1:i.tops], ', ') END, CASE WHEN u.doc_id IS NULL THEN 'use_case: insufficient_evidence' END) END AS unresolved,
  d.lang <> 'es' AND coalesce(i.tops, 0) = 1 AND (f.doc_id IS NOT NULL OR u.doc_id IS NOT NULL) AS resolved
FROM documents d LEFT JOIN i USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN u USING (doc_id)"""
)
def facet_assign(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    lists = facets.term_lists(VOCABULARY, ["text"])
    found = scan(d, Search({"text": "text"}, (), lists), ["doc_id", "lang"]).withColumn("found", facets.found_array(list(lists)))
    a = facets.assign(found, "doc_id", F.col("lang") != "es")
    known = F.col("industry").isNotNull() & (F.col("industry") != facets.SENTINEL)
    return a.select("doc_id", "industry", *[F.array_join(c, ",").alias(c) for c in ("functions", "use_cases")], F.array_join("unresolved", "; ").alias("unresolved"), facets.is_resolved(known, F.col("functions"), F.col("use_cases")).alias("resolved"))


def _items(spark, sf_dir):
    d = judged(spark, sf_dir).select("doc_id", "topic", "category", "competing", "accepted")
    return d.withColumns({"identity_url": F.concat(F.lit("https://docs.example.org/"), F.col("doc_id").cast("string")), "title": F.col("doc_id").cast("string")})


@query(
    f"""WITH {CLASSIFIED_SQL}, {SCORED_SQL.replace('d0 AS', 'd0x AS').replace('FROM d0)', 'FROM d0x)')} SELECT sha256(cl.topic || '|https://docs.example.org/' || cl.doc_id)[1:16] AS record_id, sha256('https://docs.example.org/' || cl.doc_id)[1:16] AS content_id, 'full' AS record_type,
  cl.topic, cl.category, 'https://docs.example.org/' || cl.doc_id AS identity_url, CAST(cl.doc_id AS VARCHAR) AS title FROM cl JOIN scored USING (doc_id) WHERE scored.rejection_reason IS NULL"""
)
def full_records(spark, sf_dir):
    return records.full_records(_items(spark, sf_dir))


_rules = ", ".join(f"('{r.rule_id}', '{r.topic}', '{r.category}')" for r in RULES)


@query(
    f"""WITH {CLASSIFIED_SQL}, {SCORED_SQL.replace('d0 AS', 'd0x AS').replace('FROM d0)', 'FROM d0x)')}, rl(rid, t, c) AS (VALUES {_rules}),
o AS (SELECT cl.doc_id, cl.topic, unnest(others) AS rid FROM cl JOIN scored USING (doc_id) WHERE scored.rejection_reason IS NULL)
SELECT DISTINCT sha256(t || '|https://docs.example.org/' || doc_id)[1:16] AS record_id, 'cross_reference' AS record_type, t AS topic, c AS category, 'https://docs.example.org/' || doc_id AS identity_url,
  sha256(topic || '|https://docs.example.org/' || doc_id)[1:16] AS duplicate_of FROM o JOIN rl USING (rid) WHERE t <> topic"""
)
def cross_references(spark, sf_dir):
    return records.cross_references(_items(spark, sf_dir))


_T = "(?s)<title>(.*?)</title>"


@query(
    f"""WITH t AS (SELECT page_id, regexp_extract(html, '{_T}', 1) AS title, CASE page_id % 4 WHEN 0 THEN ' Unknown ' WHEN 1 THEN '' WHEN 2 THEN ' x ' END AS v, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * page_id AS ts FROM pages)
SELECT page_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, CASE WHEN page_id % 4 = 2 THEN 'x' END AS known, strftime(CASE WHEN page_id % 5 = 4 THEN NULL WHEN page_id % 5 = 3 THEN date_trunc('day', ts) ELSE ts END, '%Y-%m-%dT%H:%M:%SZ') AS published,
  concat_ws(' | ', 'Id: ' || page_id, CASE WHEN page_id % 4 = 2 THEN 'Value: x' WHEN page_id % 4 = 0 THEN 'Value: Unknown' END) AS label FROM t"""
)
def clean_fields(spark, sf_dir):
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 3600)
    k = F.col("page_id") % 5
    text = (
        F.when(k == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 1, F.concat(F.date_format(ts, "EEE"), F.lit(", "), F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" +0000")))
        .when(k == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(k == 3, F.date_format(ts, "yyyy/MM/dd"))
        .otherwise("soon")
    )
    v = F.when(F.col("page_id") % 4 == 0, " Unknown ").when(F.col("page_id") % 4 == 1, "").when(F.col("page_id") % 4 == 2, " x ")
    p = table(spark, sf_dir, "pages")
    return p.select(
        "page_id",
        cleaning.collapsed(F.regexp_extract("html", _T, 1)).alias("title"),
        cleaning.known(v).alias("known"),
        cleaning.utc_text(cleaning.utc_time(text)).alias("published"),
        cleaning.labelled(("Id", F.col("page_id").cast("string")), ("Value", v)).alias("label"),
    )


@query("WITH d AS (SELECT doc_id, text, strpos(lower(text), 'licensed') AS pos FROM documents) SELECT doc_id, substr(text, greatest(pos - 56, 1), 120) AS quote FROM d WHERE pos > 0")
def quote_windows(spark, sf_dir):
    at = F.locate("licensed", F.lower("text"))
    d = table(spark, sf_dir, "documents").withColumn("at", at).where("at > 0")
    return d.select("doc_id", cleaning.quote(F.col("text"), F.col("at"), F.lit(8)).alias("quote"))


