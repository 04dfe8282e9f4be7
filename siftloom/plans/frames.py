"""Inputs of the registered queries: the tables, and deliveries, items and verdicts
derived from them, each with the SQL that derives the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import urls
from ..functions.signals import Composite, Signal
from ..operators import dedupe, score
from ..operators.classify import apply_rules
from ..operators.scan import Search, TermList, scan
from ..runtime import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


TITLE, LANG = r"(?s)<title>(.*?)</title>", r'<html lang="([a-z]+)"'


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page delivered by two lanes, the second with a tracking parameter."""
    p = table(spark, sf_dir, "pages").select(
        (F.col("page_id") % 7).alias("s"),
        F.col("page_id").alias("position"),
        "url",
        F.regexp_extract("html", TITLE, 1).alias("title"),
        F.regexp_extract("html", LANG, 1).alias("topic"),
        F.concat(F.lit("c"), (F.col("page_id") % 4).cast("string")).alias("category"),
    )
    first = p.select(F.concat(F.lit("src"), F.col("s").cast("string")).alias("source_id"), "position", F.col("url").alias("target_url"), "title", "topic", "category", F.lit("discovery").alias("role"), F.lit("lane0").alias("lane_id"))
    tracked = F.concat(F.regexp_replace("url", "#.*$", ""), F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_medium=mail"))
    second = p.select(F.concat(F.lit("alt"), F.col("s").cast("string")).alias("source_id"), "position", tracked.alias("target_url"), "title", "topic", "category", F.when(F.col("s") == 0, "validation_seed").otherwise("other").alias("role"), F.lit("lane1").alias("lane_id"))
    both = first.unionByName(second)
    return both.withColumns({"canonical_url": urls.canonical(F.col("target_url")), "role_rank": dedupe.role_rank(F.col("role"))}).withColumn("candidate_key", urls.content_id(F.col("canonical_url")))


_SPLIT = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
_DROP = ", ".join(f"'{t}'" for t in urls.TRACKING)


def canonical_sql(u: str) -> str:
    """Canonical form of a struct (s, n, p, q, f) of address parts."""
    segments = f"list_filter(string_split({u}.p, '/'), lambda s: s <> '' AND s <> '.')"
    pairs = f"list_transform(list_filter(string_split(ltrim({u}.q, '?'), '&'), lambda p: p <> '' AND NOT list_contains([{_DROP}], split_part(p, '=', 1))), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END)"
    return f"""CASE WHEN lower({u}.s) IN ('http', 'https') AND {u}.n <> '' THEN lower({u}.s) || '://' || regexp_replace(lower({u}.n), '^.*@', '')
      || '/' || array_to_string({segments}, '/') || CASE WHEN {u}.p LIKE '%/' AND len({segments}) > 0 THEN '/' ELSE '' END
      || CASE WHEN len({pairs}) > 0 THEN '?' || array_to_string({pairs}, '&') ELSE '' END || CASE WHEN {u}.f = '#' THEN '' ELSE {u}.f END END"""


def split_sql(url: str) -> str:
    return f"regexp_extract(trim({url}), '{_SPLIT}', ['s', 'n', 'p', 'q', 'f'])"


DELIVERIES_SQL = f"""
p AS (SELECT page_id % 7 AS s, page_id AS position, url, regexp_extract(html, '{TITLE}', 1) AS title, regexp_extract(html, '{LANG}', 1) AS topic, 'c' || (page_id % 4) AS category FROM pages),
raw AS (
  SELECT 'src' || s AS source_id, position, url AS target_url, title, topic, category, 'discovery' AS role, 'lane0' AS lane_id FROM p
  UNION ALL
  SELECT 'alt' || s, position, regexp_replace(url, '#.*$', '') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_medium=mail', title, topic, category,
    CASE WHEN s = 0 THEN 'validation_seed' ELSE 'other' END, 'lane1' FROM p),
split AS (SELECT *, {split_sql("target_url")} AS u FROM raw),
deliveries AS (SELECT * EXCLUDE (u), {canonical_sql("u")} AS canonical_url, CASE role WHEN 'validation_seed' THEN 0 WHEN 'discovery' THEN 1 ELSE 2 END AS role_rank FROM split),
obs AS (SELECT *, sha256(canonical_url)[1:16] AS candidate_key, row_number() OVER (ORDER BY role_rank, source_id, position, target_url) AS o FROM deliveries)"""


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.observations(deliveries(spark, sf_dir), ["title", "topic", "category", "role", "role_rank", "canonical_url"], ["candidate_key"])


CURATION, FACETS = config.load("curation.json"), config.load("facets.json")
SIGNALS, RULES = config.signals(CURATION), config.rules(CURATION)


def _term_sql(term: str) -> str:
    words = [w.strip("*") for w in term.split()]
    inner = r"[^\p{L}\p{N}_]+".join(words) + (r"[\p{L}\p{N}_]*" if term.endswith("*") else "")
    return rf"regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])({inner})($|[^\p{{L}}\p{{N}}_])')"


def _signal_sql(s: Signal | Composite) -> str:
    if isinstance(s, Composite):
        return "(" + " AND ".join(f"on_{n}" for n in s.all_of) + ")"
    terms = [f"{_term_sql(k)}::INT" for k in s.keywords] + [f"regexp_matches(text, '{p}')::INT" for p in s.patterns]
    return f"({' + '.join(terms)} >= {s.least})"


_simple = [s for s in SIGNALS if isinstance(s, Signal)]
_holds = {r.rule_id: " AND ".join([f"on_{n}" for n in r.all_of] + [f"NOT on_{n}" for n in r.none_of]) for r in RULES}
SIGNALS_SQL = f"""
d AS (SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents),
s1 AS (SELECT *, {", ".join(f"{_signal_sql(s)} AS on_{s.name}" for s in _simple)} FROM d),
sig AS (SELECT *, {", ".join(f"{_signal_sql(s)} AS on_{s.name}" for s in SIGNALS if isinstance(s, Composite))} FROM s1)"""
CLASSIFIED_SQL = (
    SIGNALS_SQL
    + f""",
ru AS (SELECT *, list_filter([{", ".join(f"CASE WHEN {_holds[r.rule_id]} THEN {{'rule_id': '{r.rule_id}', 'topic': '{r.topic}', 'category': '{r.category}'}} END" for r in sorted(RULES, key=lambda r: r.order))}], lambda x: x IS NOT NULL) AS fired FROM sig),
cl AS (SELECT * EXCLUDE (fired), CASE WHEN len(fired) = 0 THEN 'fallback' ELSE fired[1].rule_id END AS rule_id, CASE WHEN len(fired) = 0 THEN lang ELSE fired[1].topic END AS topic,
  CASE WHEN len(fired) = 0 THEN source ELSE fired[1].category END AS category, list_sort(list_transform(fired[2:], lambda x: x.rule_id)) AS others FROM ru)"""
)


#: As if all rows were judged at this moment.
AS_OF = "2024-03-01 00:00:00"
REQUIRED, BOOST, EXCLUDED = (tuple(CURATION["relevance"][n]) for n in ("require_any", "boost", "exclude"))


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their texts: flags of the signals, counts of the relevance
    terms, first hits, and what the scores need to know of a text. One pass."""
    d = table(spark, sf_dir, "documents")
    title, text = F.get(F.split("text", "\n", 2), F.lit(0)), F.coalesce("text", F.lit(""))
    d = d.select(
        "doc_id", "lang", "source", text.alias("text"),
        F.substring(title, 1, 200).alias("title"),
        F.coalesce(F.trim("text") == "", F.lit(True)).alias("blank"),
        (F.trim(title) != "").alias("has_title"),
        F.char_length(text).alias("length"),
        F.array(F.struct(F.col("lang").alias("topic"), F.col("source").alias("category"))).alias("contexts"),
    )
    terms = {"required": TermList(REQUIRED), "boost": TermList(BOOST), "excluded": TermList(EXCLUDED)}
    return scan(d, Search({"text": "text"}, SIGNALS, terms), [c for c in d.columns if c != "text"])


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(scanned(spark, sf_dir), RULES, "contexts")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents classified, scored and decided on; the date follows from the id."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    d = classified(spark, sf_dir).join(labels, "doc_id", "left")
    p = config.policy(CURATION)
    published = F.when(F.col("doc_id") % 5 != 0, F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") % 90) * 43200))
    d = d.withColumns({"excluded": F.col("n_excluded") > 0, "required_hits": F.col("n_required"), "has_required": F.lit(bool(REQUIRED)), "published": published, "summary": F.when(~F.col("blank"), "text")})
    fit, developers = score.audience(F.col("excluded"), F.col("toxic") == 1)
    d = d.withColumns({"audience_fit": fit, "developer_only": developers})
    d = d.withColumns(
        {
            "relevance": score.relevance(F.col("n_required"), F.col("n_boost"), F.col("n_excluded"), F.lit(bool(REQUIRED)), F.lit(bool(REQUIRED or BOOST))),
            "quality": score.quality_of(F.col("has_title"), F.when(~F.col("blank"), F.col("length")), F.coalesce(F.trim("source") != "", F.lit(False)), F.col("published").isNotNull(), F.col("doc_id") % 4 + 1),
            "freshness": score.freshness(F.col("published"), F.lit(AS_OF).cast("timestamp"), p.half_life_days),
        }
    )
    d = d.withColumn("composite", score.composite({k: F.col(k) for k in p.weights}, p.weights))
    return score.decide(d, p)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select("doc_id", "lang", "source", "published", "relevance", "quality", "audience_fit", "freshness", "composite", "accepted", "rejection_reason", "detail")


def _sum(terms: tuple[str, ...]) -> str:
    return " + ".join(f"{_term_sql(t)}::INT" for t in terms)


SCORED_SQL = f"""
lab AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id),
d0 AS (SELECT d.doc_id, coalesce(d.text, '') AS text, lang, source, toxic, {_sum(REQUIRED)} AS r, {_sum(BOOST)} AS b, {_sum(EXCLUDED)} AS x,
  CASE WHEN d.doc_id % 5 <> 0 THEN make_timestamp((1704067200 + (d.doc_id % 90) * 43200) * 1000000) END AS published FROM documents d LEFT JOIN lab USING (doc_id)),
d1 AS (SELECT *, CASE WHEN x > 0 OR r = 0 THEN 0.0::DOUBLE ELSE round(0.68::DOUBLE * (least(r, 3) / 3::DOUBLE) + 0.32::DOUBLE * (least(b, 3) / 3::DOUBLE), 4) END AS relevance,
  round(least((CASE WHEN trim(string_split(text, chr(10))[1]) <> '' THEN 0.22::DOUBLE ELSE 0 END) + (CASE WHEN trim(text) = '' THEN 0 WHEN length(text) < 200 THEN 0.17::DOUBLE ELSE 0.34::DOUBLE END)
    + (CASE WHEN trim(source) <> '' THEN 0.22::DOUBLE ELSE 0 END) + (CASE WHEN published IS NOT NULL THEN 0.22::DOUBLE ELSE 0 END) + least(0.08::DOUBLE * (doc_id % 4), 0.24::DOUBLE), 1.0::DOUBLE), 4) AS quality,
  CASE WHEN x > 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS audience_fit,
  CASE WHEN published IS NOT NULL THEN round(pow(0.5::DOUBLE, greatest((epoch(TIMESTAMP '{AS_OF}') - epoch(published)) / 86400.0::DOUBLE, 0.0::DOUBLE) / 90.0::DOUBLE), 4) END AS freshness FROM d0),
d2 AS (SELECT *, round((((0.40::DOUBLE * relevance + 0.25::DOUBLE * quality) + 0.20::DOUBLE * audience_fit) + coalesce(0.15::DOUBLE * freshness, 0)) / CASE WHEN freshness IS NULL THEN 0.85::DOUBLE ELSE 1.0::DOUBLE END, 4) AS composite FROM d1),
scored AS (SELECT *, CASE WHEN x > 0 AND toxic = 1 THEN 'developer_only_audience' WHEN x > 0 THEN 'category_exclusion_applied' WHEN trim(text) = '' THEN 'insufficient_evidence' WHEN r = 0 THEN 'off_topic'
  WHEN relevance < 0.35::DOUBLE THEN 'below_relevance_threshold' WHEN quality < 0.30::DOUBLE THEN 'below_quality_threshold' WHEN audience_fit < 0.20::DOUBLE OR composite < 0.40::DOUBLE THEN 'insufficient_evidence' END AS rejection_reason,
  CASE WHEN x > 0 THEN 'excluded by its category' WHEN trim(text) = '' THEN 'no title and no summary' WHEN r = 0 THEN 'none of the required terms occurs'
  WHEN relevance < 0.35::DOUBLE THEN printf('relevance %.4f < min_relevance 0.3500', relevance) WHEN quality < 0.30::DOUBLE THEN printf('quality %.4f < min_quality 0.3000', quality)
  WHEN audience_fit < 0.20::DOUBLE THEN printf('audience_fit %.4f < min_audience_fit 0.2000', audience_fit) WHEN composite < 0.40::DOUBLE THEN printf('composite %.4f < accept_composite 0.4000', composite)
  ELSE printf('composite %.4f >= accept_composite 0.4000', composite) END AS detail FROM d2)"""
