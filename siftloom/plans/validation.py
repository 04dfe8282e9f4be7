"""Queries of the validators and of the migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..operators import migrate, validate
from .frames import CURATION, FACETS, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _report(*parts: tuple[str, str, str, str]) -> str:
    """SQL of a report: (subject, path, message, where) over the relation x."""
    return " UNION ALL ".join(f"SELECT CAST({s} AS VARCHAR) AS subject, '{p}' AS path, '{m}' AS message FROM x WHERE {w}" for s, p, m, w in parts)


_SCHEMA = {
    "type": "object",
    "required": ["id", "kind", "tags"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "string", "pattern": "^r[0-9]+$", "maxLength": 6},
        "kind": {"$vocabulary": "kinds"},
        "score": {"type": ["number", "null"], "minimum": 0, "maximum": 1},
        "tags": {"type": "array", "items": {"type": "string"}, "uniqueItems": True},
    },
}


@query(
    "WITH x AS (SELECT event_id, event_id % 12 AS k FROM events) "
    + _report(
        ("event_id", "$", "is not JSON", "k = 0"),
        ("event_id", "$.id", "doesn''t fit its pattern", "k = 1"),
        ("event_id", "$.kind", "is none of the values", "k = 2"),
        ("event_id", "$.score", "is above 1", "k = 3"),
        ("event_id", "$.tags", "is missing", "k = 4"),
        ("event_id", "$", "has unknown members", "k = 5"),
        ("event_id", "$.tags[*]", "has an invalid element", "k = 6"),
        ("event_id", "$.tags", "repeats an element", "k = 7"),
        ("event_id", "$.score", "is not number or null", "k = 8"),
        ("event_id", "$.score", "is below 0", "k = 8"),
        ("event_id", "$.score", "is above 1", "k = 8"),
        ("event_id", "$", "is not object", "k = 9"),
        ("event_id", "$.id", "is too long", "k = 10"),
    )
)
def schema_violations(spark, sf_dir):
    k = F.col("event_id") % 12
    ok = '"id":"r1","kind":"full","score":0.5,"tags":["a","b"]'
    bodies = ["{oops", "{" + ok.replace('"r1"', '"x"') + "}", "{" + ok.replace('"full"', '"half"') + "}", "{" + ok.replace("0.5", "1.5") + "}", '{"id":"r1","kind":"full"}', "{" + ok + ',"z":1}', "{" + ok.replace('"b"', "7") + "}", "{" + ok.replace('"b"', '"a"') + "}", "{" + ok.replace("0.5", '"high"') + "}", "[1]", "{" + ok.replace('"r1"', '"r1234567"') + "}", "{" + ok.replace("0.5", "null") + "}"]
    body = F.element_at(F.array(*[F.lit(b) for b in bodies]), (k + 1).cast("int"))
    schema = validate.generated_schema(_SCHEMA, {"kinds": ["cross_reference", "full"]})
    e = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return validate.against_schema(e, F.col("event_id"), F.col("body"), schema)


def _topics(spark, sf_dir):
    """A topic file for each region with a category for each nation and a source for each supplier."""
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("n"),
        F.struct(
            F.when(F.col("s_suppkey") % 9 == 0, "same").otherwise(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))).alias("source_id"), F.concat(F.lit("r"), (F.col("s_nationkey") % 5).cast("string")).alias("topic_slug"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("category_slug"),
            F.lit("feed").alias("adapter"), F.when(F.col("s_suppkey") % 7 == 0, "ftp://x").otherwise("https://x.example.org/").alias("url"), F.when(F.col("s_suppkey") % 5 != 0, "discovery").alias("role"), F.lit(5).alias("max_candidates"), F.lit(3).alias("max_requests"), F.concat(F.lit("fx"), F.col("s_suppkey").cast("string")).alias("fixture_id"),
        ).alias("s"),
    ).groupBy("n").agg(F.array_sort(F.collect_list("s")).alias("sources"))
    n = table(spark, sf_dir, "nation").join(s, F.col("n") == F.col("n_nationkey"), "left")
    none = F.array().cast(s.schema["sources"].dataType)
    c = n.select((F.col("n_nationkey") % 5).alias("k"), F.struct(F.concat(F.lit("N "), F.col("n_nationkey").cast("string")).alias("category"), F.concat(F.lit("n-"), F.col("n_nationkey").cast("string")).alias("category_slug"), F.coalesce("sources", none).alias("sources")).alias("c"))
    c = c.withColumn("c", F.struct(F.col("c.category"), F.when(F.col("k") == 0, F.replace("c.category_slug", F.lit("-"), F.lit(""))).otherwise(F.col("c.category_slug")).alias("category_slug"), "c.sources"))
    t = c.groupBy("k").agg(F.array_sort(F.collect_list("c")).alias("categories"))
    return t.select(F.concat(F.lit("f"), F.col("k").cast("string")).alias("file"), F.concat(F.lit("R "), F.col("k").cast("string")).alias("topic"), F.concat(F.lit("r"), F.col("k").cast("string")).alias("topic_slug"), "categories")


_CATALOG = """c AS (SELECT n_nationkey AS n, n_nationkey % 5 AS k, CASE WHEN n_nationkey % 5 = 0 THEN 'n' ELSE 'n-' END || n_nationkey AS category_slug FROM nation),
s AS (SELECT CASE WHEN s_suppkey % 9 = 0 THEN 'same' ELSE 's' || s_suppkey END AS source_id, CASE WHEN s_suppkey % 7 = 0 THEN 'ftp://x' ELSE 'https://x.example.org/' END AS url, s_suppkey, s_nationkey, k, category_slug FROM supplier JOIN c ON n = s_nationkey)"""


@query(
    f"""WITH {_CATALOG} SELECT 'f' || k AS subject, 'topic_slug' AS path, 'is not the topic''s slug' AS message FROM (SELECT DISTINCT k FROM c)
UNION ALL SELECT 'f' || k || '/N ' || n, 'category_slug', 'is not the category''s slug' FROM c WHERE k = 0
UNION ALL SELECT source_id, 'role', 'is missing' FROM s WHERE s_suppkey % 5 = 0 UNION ALL SELECT source_id, 'category_slug', 'is not its category''s' FROM s WHERE k <> 0 UNION ALL SELECT source_id, 'url', 'is not absolute' FROM s WHERE s_suppkey % 7 = 0
UNION ALL SELECT source_id, 'source_id', 'is given twice' FROM s GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT 'r9__n-9', 'cell_id', 'is approved and missing' UNION ALL SELECT 'r' || k || '__' || category_slug, 'cell_id', 'is not approved' FROM c WHERE n <> 1"""
)
def config_violations(spark, sf_dir):
    return validate.config_problems(_topics(spark, sf_dir), ["r1__n-1", "r9__n-9"])


@query(f"WITH {_CATALOG} SELECT source_id, 'r' || k || '__' || category_slug AS cell_id, CASE WHEN count(*) OVER (PARTITION BY source_id) > 1 THEN 'duplicate_source_id' END AS problem FROM s")
def source_catalog(spark, sf_dir):
    return config.catalog(_topics(spark, sf_dir)).select("source_id", "cell_id", "problem")


@query(f"WITH {_CATALOG}, m AS (SELECT 'r' || k || '__' || category_slug AS cell_id FROM c) SELECT cell_id, 'no_lane' AS finding FROM m WHERE cell_id <> 'r1__n-1' UNION ALL SELECT 'r7__x', 'not_configured'")
def lane_mismatches(spark, sf_dir):
    lanes = spark.createDataFrame([("r1__n-1",), ("r7__x",)], "cell_id string")
    return config.lane_mismatches(config.cells(_topics(spark, sf_dir)), lanes)


_limits = CURATION["scoring"]["thresholds"]


@query(
    f"""SELECT 'r' || n_regionkey || '__n' || n_nationkey AS cell_id, CASE WHEN n_nationkey = 3 THEN 0.9::DOUBLE ELSE {_limits['min_relevance']}::DOUBLE END AS min_relevance, {_limits['min_quality']}::DOUBLE AS min_quality, {_limits['min_audience_fit']}::DOUBLE AS min_audience_fit, {_limits['accept_composite']}::DOUBLE AS accept_composite FROM nation"""
)
def cell_thresholds(spark, sf_dir):
    cells = [r[0] for r in table(spark, sf_dir, "nation").select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string"), F.lit("__n"), F.col("n_nationkey").cast("string"))).collect()]
    own = next(c for c in cells if c.endswith("__n3"))
    return config.thresholds(spark, {"scoring": {**CURATION["scoring"], "thresholds_by_cell": {own: {"min_relevance": 0.9}}}}, cells)


@query(
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{a['axis']}', '{e['slug']}', '{e['coverage_policy']}', {str(bool(e.get('deprecated'))).lower()}, {FACETS['targets']['overrides'].get(a['axis'] + '/' + e['slug'], FACETS['targets']['default_by_policy'][e['coverage_policy']])}::BIGINT)" for a in FACETS["axes"] for e in a["entries"])
    + ") v(axis, slug, coverage_policy, deprecated, target)"
)
def vocabulary_entries(spark, sf_dir):
    return config.vocabulary_frame(spark, FACETS)


@query("SELECT * FROM (VALUES ('industry', 'required', 2), ('industry', 'preferred', 1), ('industry', 'record_only', 1), ('function', 'required', 3), ('function', 'preferred', 2), ('function', 'record_only', 1), ('use_case', 'required', 1), ('use_case', 'preferred', 1), ('use_case', 'record_only', 1)) v(axis, coverage_policy, n)")
def vocabulary_tiers(spark, sf_dir):
    return config.tier_counts(config.vocabulary_frame(spark, FACETS))


_ENTRIES = """e AS (SELECT ['a', 'b', 'c'][1 + p_partkey % 3] AS axis, CASE WHEN p_partkey % 50 = 0 THEN 'Not A Slug' WHEN p_partkey % 41 = 0 THEN 'ops' WHEN p_partkey < 3 THEN 'other-unclear' ELSE 'p-' || p_partkey // 2 END AS slug, CASE WHEN p_partkey % 2 = 0 THEN 'priority' ELSE 'record_only' END AS coverage_policy,
  CASE WHEN p_partkey % 11 = 0 THEN 'deprecated' ELSE 'active' END AS status, CASE WHEN p_partkey % 22 = 0 OR p_partkey % 37 = 0 THEN 'x' END AS replaced_by FROM part)"""


def _entries(spark, sf_dir):
    k = F.col("p_partkey")
    slug = F.when(k % 50 == 0, "Not A Slug").when(k % 41 == 0, "ops").when(k < 3, "other-unclear").otherwise(F.concat(F.lit("p-"), F.floor(k / 2).cast("string")))
    return table(spark, sf_dir, "part").select(
        F.element_at(F.array(*[F.lit(a) for a in "abc"]), (k % 3 + 1).cast("int")).alias("axis"), slug.alias("slug"), F.when(k % 2 == 0, "priority").otherwise("record_only").alias("coverage_policy"),
        F.when(k % 11 == 0, "deprecated").otherwise("active").alias("status"), F.when((k % 22 == 0) | (k % 37 == 0), "x").alias("replaced_by"),
    )


@query(
    f"""WITH {_ENTRIES}, x AS (SELECT *, axis || '/' || slug AS s FROM e), n AS (SELECT axis, count(*) AS n, bool_or(slug = 'other-unclear') AS sentinel FROM e GROUP BY 1), t AS (SELECT axis, coverage_policy, count(*) AS n FROM e WHERE status = 'active' GROUP BY 1, 2),
w(axis, coverage_policy, n) AS (VALUES ('a', 'priority', 1), ('a', 'record_only', 2)) """
    + _report(("s", "slug", "is not a slug", "slug = 'Not A Slug'"), ("s", "slug", "is forbidden", "slug = 'ops'"), ("s", "replaced_by", "is missing for a deprecated entry", "status = 'deprecated' AND replaced_by IS NULL"), ("s", "replaced_by", "stands at an active entry", "status = 'active' AND replaced_by IS NOT NULL"), ("s", "coverage_policy", "must be record_only", "slug = 'p-2' AND coverage_policy <> 'record_only'"))
    + """ UNION ALL SELECT s, 'slug', 'stands twice' FROM x GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT slug, 'slug', 'belongs to several axes' FROM e WHERE slug <> 'other-unclear' GROUP BY 1 HAVING count(DISTINCT axis) > 1
UNION ALL SELECT axis, 'entries', 'aren''t as many as approved' FROM n WHERE axis <> 'a' OR n <> 60 UNION ALL SELECT axis, 'entries', 'lack the sentinel' FROM n WHERE NOT sentinel
UNION ALL SELECT coalesce(t.axis, w.axis) || '/' || coalesce(t.coverage_policy, w.coverage_policy), 'coverage_policy', 'isn''t split as approved' FROM t FULL JOIN w ON t.axis = w.axis AND t.coverage_policy = w.coverage_policy WHERE coalesce(t.n, 0) <> coalesce(w.n, 0)"""
)
def vocabulary_violations(spark, sf_dir):
    return validate.vocabulary_problems(_entries(spark, sf_dir), "other-unclear", {"a": 60, "b": 1, "c": 1}, {"a": {"priority": 1, "record_only": 2}}, ["ops"], ["p-2"])


@query(
    f"""WITH {_ENTRIES}, p AS (SELECT slug, min(coverage_policy) AS policy FROM e GROUP BY 1), o(slug, target) AS (VALUES ('p-3', 5), ('p-9', 7), ('nowhere', 1), ('other-unclear', 0))
SELECT 'standard' AS subject, 'tiers' AS path, 'has no minimum' AS message UNION ALL SELECT 'record_only', 'tiers', 'must be 0' UNION ALL SELECT 'cross-industry', 'scheduler', 'must never be planned for'
UNION ALL SELECT slug, 'overrides', 'is no entry' FROM o LEFT JOIN p USING (slug) WHERE policy IS NULL UNION ALL SELECT slug, 'overrides', 'raises a record-only entry' FROM o JOIN p USING (slug) WHERE policy = 'record_only' AND target > 0"""
)
def target_violations(spark, sf_dir):
    targets = {"tiers": {"priority": 10, "record_only": 2}, "overrides": {"p-3": 5, "p-9": 7, "nowhere": 1, "other-unclear": 0}, "scheduler": {"never_schedule_gap_lane_for": ["other-unclear"]}}
    return validate.target_problems(spark, targets, _entries(spark, sf_dir), ("other-unclear", "cross-industry"))


_LEGACY = """l AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'Upper ' || c_custkey WHEN c_custkey % 10 = 1 THEN 'twin' ELSE 'v' || c_custkey END AS legacy_value, CASE WHEN c_custkey % 7 = 0 THEN 'nowhere' WHEN c_custkey % 11 = 0 THEN 'other-unclear' ELSE 'health' END AS industry FROM customer)"""


@query(
    f"""WITH {_LEGACY} SELECT legacy_value AS subject, 'legacy_value' AS path, 'is not in its folded form' AS message FROM l WHERE legacy_value LIKE 'Upper%' UNION ALL SELECT legacy_value, 'industry', 'is no industry' FROM l WHERE industry = 'nowhere'
UNION ALL SELECT legacy_value, 'industry', 'is the sentinel' FROM l WHERE industry = 'other-unclear' UNION ALL SELECT 'twin', 'legacy_value', 'stands twice'"""
)
def legacy_map_violations(spark, sf_dir):
    k = F.col("c_custkey")
    legacy = table(spark, sf_dir, "customer").select(F.when(k % 10 == 0, F.concat(F.lit("Upper "), k.cast("string"))).when(k % 10 == 1, "twin").otherwise(F.concat(F.lit("v"), k.cast("string"))).alias("legacy_value"), F.when(k % 7 == 0, "nowhere").when(k % 11 == 0, "other-unclear").otherwise("health").alias("industry"))
    return validate.legacy_map_problems(legacy, config.vocabulary_frame(spark, FACETS), "other-unclear")


@query(
    "WITH x AS (SELECT event_id, event_id % 16 AS k FROM events) "
    + _report(
        ("event_id", "facets", "stand at a pointer", "k = 0"),
        ("event_id", "facets", "stand at a topic that may have none", "k = 1"),
        ("event_id", "facets", "are missing at a gated cell", "k = 2"),
        ("event_id", "facets.unresolved", "doesn''t tell the unmapped legacy value", "k = 3"),
        ("event_id", "facets.versions", "aren''t the loaded vocabularies''", "k = 4"),
        ("event_id", "facets.state", "isn''t what the values make it", "k = 5"),
        ("event_id", "facets.unresolved", "is empty for an unresolved record", "k = 6"),
        ("event_id", "industry/nowhere", "is no known value", "k = 7"),
        ("event_id", "industry/mining", "is deprecated", "k = 8"),
        ("event_id", "function/legal", "has no evidence", "k = 9"),
        ("event_id", "industry/health", "rests on a field that grounds no industry", "k = 10"),
        ("event_id", "industry/finance", "isn''t mentioned in its evidence", "k = 11"),
        ("event_id", "function/legal", "rests on an unmapped legacy value", "k = 12"),
    )
)
def facet_violations(spark, sf_dir):
    k = F.col("event_id") % 16
    ev = lambda field, term, quote: F.array(F.struct(F.lit(field).alias("field"), F.lit(term).alias("term"), F.lit(quote).alias("quote")))
    none = F.array().cast("array<struct<field:string,term:string,quote:string>>")
    value = lambda axis, slug, role, e: F.struct(F.lit(axis).alias("axis"), slug.alias("slug") if not isinstance(slug, str) else F.lit(slug).alias("slug"), F.lit(role).alias("role"), e.alias("evidence"))
    industry = value("industry", F.when(k == 7, "nowhere").when(k == 8, "mining").otherwise("health"), "primary", F.when(k == 10, ev("publisher", "nicht", "nicht")).otherwise(ev("title", "nicht", "nicht so")))
    function = value("function", "legal", "value", F.when(k == 9, none).when(k == 12, ev("title", "Odd Trade", "odd trade")).otherwise(ev("summary", "rights", "all rights")))
    second = value("industry", "finance", "secondary", ev("title", "que", "nothing of it"))
    asserted = F.when(k == 6, F.array(function)).when(k == 11, F.array(industry, function, second)).otherwise(F.array(industry, function))
    unresolved = F.when(k == 12, F.array(F.struct(F.lit("industry").alias("axis"), F.lit("unmapped_legacy_value").alias("state"), F.lit("odd trade").alias("term")))).otherwise(F.array().cast("array<struct<axis:string,state:string,term:string>>"))
    facets = F.struct(F.when(k == 4, "0").otherwise("1").alias("versions"), F.when((k == 5) | (k == 6), "unresolved").otherwise("resolved").alias("state"), asserted.alias("asserted"), F.when(k == 5, F.array(F.struct(F.lit("a").alias("axis"), F.lit("s").alias("state"), F.lit("t").alias("term")))).otherwise(unresolved).alias("unresolved"))
    r = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("record_id"), F.when(k.isin(0, 13), "cross_reference").otherwise("full").alias("record_type"), F.when(k.isin(1, 14), "discourse").otherwise("cases").alias("topic"), F.when(k == 2, "gated").otherwise("open").alias("category"),
        F.when(~k.isin(2, 13, 14, 15), facets).alias("facets"), F.when(k.isin(3, 12), "odd trade").alias("legacy_unmapped"),
    )
    v = config.vocabulary_frame(spark, FACETS)
    return validate.record_facet_problems(r, v.where("NOT deprecated"), v, "1", ["discourse"], [("cases", "gated")])


_RUN = """r AS (SELECT doc_id, 't' || doc_id % 2 AS topic, source AS category, 'https://d.example.org/' || doc_id AS u FROM documents),
x AS (SELECT doc_id, topic, category, u, CASE WHEN doc_id % 19 = 0 THEN 'wrong' ELSE sha256(topic || '|' || u)[1:16] END AS record_id, CASE WHEN doc_id % 23 = 0 THEN 'lost' ELSE topic || '__' || category END AS cell_id, CASE WHEN doc_id % 29 = 0 THEN 'run0' ELSE 'run1' END AS run FROM r)"""


@query(
    f"""WITH {_RUN}, c AS (SELECT cell_id, count(*) AS have FROM x GROUP BY 1), st AS (SELECT DISTINCT topic || '__' || category AS cell_id, category FROM x), k AS (SELECT cell_id, CASE WHEN category = (SELECT min(source) FROM documents) THEN 0 ELSE coalesce(have, 0) END AS n FROM st LEFT JOIN c USING (cell_id))
SELECT record_id AS subject, 'harvest_run_id' AS path, 'is of another run' AS message FROM x WHERE run = 'run0' UNION ALL SELECT record_id, 'cell_id', 'isn''t the record''s cell' FROM x WHERE cell_id = 'lost' UNION ALL SELECT record_id, 'record_id', 'doesn''t follow from topic and identity' FROM x WHERE record_id = 'wrong'
UNION ALL SELECT record_id, 'record_id', 'stands twice in its topic' FROM x GROUP BY topic, record_id HAVING count(*) > 1
UNION ALL SELECT coalesce(k.cell_id, c.cell_id), 'total_records', 'isn''t the number of records' FROM k FULL JOIN c ON k.cell_id = c.cell_id WHERE coalesce(n, -1) <> coalesce(have, 0)
UNION ALL SELECT cell_id, 'observations', 'aren''t unique ones and repeats together' FROM c WHERE cell_id LIKE 't1%' UNION ALL SELECT 'manifest.json', 'documents', 'is missing' UNION ALL SELECT 'stray.json', 'documents', 'is unexpected'"""
)
def run_violations(spark, sf_dir):
    from ..functions import urls

    n = F.col("doc_id")
    r = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("t"), (n % 2).cast("string")).alias("topic"), F.col("source").alias("category"), F.concat(F.lit("https://d.example.org/"), n.cast("string")).alias("identity_url"))
    r = r.withColumns({"record_id": F.when(n % 19 == 0, "wrong").otherwise(urls.record_id(F.col("topic"), F.col("identity_url"))), "cell_id": F.when(n % 23 == 0, "lost").otherwise(F.concat_ws("__", "topic", "category")), "harvest_run_id": F.when(n % 29 == 0, "run0").otherwise("run1"), "record_type": F.lit("full")})
    have = r.groupBy("cell_id").agg(F.count("*").alias("have"))
    first = table(spark, sf_dir, "documents").agg(F.min("source")).first()[0]
    cells = r.select(F.concat_ws("__", "topic", "category").alias("cell_id"), "category").distinct().join(have, "cell_id", "left").select("cell_id", F.when(F.col("category") == first, F.lit(0).cast("long")).otherwise(F.coalesce("have", F.lit(0))).alias("total_records"))
    seen = have.select("cell_id", (F.col("have") + F.when(F.col("cell_id").startswith("t1"), 1).otherwise(0)).alias("observations"), F.col("have").alias("unique_candidates"), F.lit(0).alias("repeats"))
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    return validate.run_problems(r, cells, seen, names("coverage.json", "stray.json"), names("coverage.json", "manifest.json"), "run1")


@query(
    """WITH f AS (SELECT page_id, 'f' || page_id || '.json' AS file, 'fx' || page_id AS fid FROM pages)
SELECT file AS subject, 'source_id' AS path, 'isn''t the configured one' AS message FROM f WHERE page_id % 9 = 1 UNION ALL SELECT file, 'url', 'isn''t the configured one' FROM f WHERE page_id % 9 = 2 UNION ALL SELECT file, 'body', 'is empty' FROM f WHERE page_id % 9 = 3
UNION ALL SELECT file, 'provenance', 'is neither synthetic nor recorded' FROM f WHERE page_id % 9 = 4 UNION ALL SELECT file, 'captured_at', 'doesn''t fit its provenance' FROM f WHERE page_id % 9 = 5 UNION ALL SELECT file, 'fixture_id', 'matches no configured source' FROM f WHERE page_id % 9 = 6
UNION ALL SELECT 's' || page_id, 'fixture_id', 'has no fixture' FROM f WHERE page_id % 9 = 6 UNION ALL SELECT 'h1.example.org', 'robots', 'has no robots fixture'
UNION ALL SELECT file, 'manifest', 'is listed but not there' FROM f WHERE page_id % 10 = 1 UNION ALL SELECT file, 'manifest', 'is there but not listed' FROM f WHERE page_id % 10 = 2 UNION ALL SELECT file, 'manifest', 'has other bytes' FROM f WHERE page_id % 10 = 3
UNION ALL SELECT '../' || file, 'manifest', 'is listed but not there' FROM f WHERE page_id % 10 = 4 UNION ALL SELECT '../' || file, 'manifest', 'escapes the tree' FROM f WHERE page_id % 10 = 4"""
)
def fixture_violations(spark, sf_dir):
    n, k = F.col("page_id"), F.col("page_id") % 9
    s = lambda p, suffix="": F.concat(F.lit(p), n.cast("string"), F.lit(suffix))
    p = table(spark, sf_dir, "pages")
    url = F.concat(F.lit("https://h"), (n % 2).cast("string"), F.lit(".example.org/"), n.cast("string"))
    fixtures = p.select(
        s("f", ".json").alias("file"), F.when(k == 6, s("zz")).otherwise(s("fx")).alias("fixture_id"), F.when(k == 1, "other").otherwise(s("s")).alias("source_id"), F.when(k == 2, "https://other.example.org/").otherwise(url).alias("url"), F.when(k != 3, "b").alias("body"),
        F.when(k == 4, "heard").when(n % 2 == 0, "synthetic").otherwise("recorded").alias("provenance"), F.when((n % 2 == 1) & (k != 5) | (n % 2 == 0) & (k == 5), "2024").alias("captured_at"), F.when(n % 2 == 0, "2024").alias("authored_at"),
    )
    sources = p.select(s("s").alias("source_id"), s("fx").alias("fixture_id"), url.alias("url"))
    files = p.where("page_id % 10 <> 1").select(s("f", ".json").alias("file"), F.lit(3).alias("bytes"), F.sha2(n.cast("string"), 256).alias("sha256"))
    listed = p.where("page_id % 10 <> 2").select(s("f", ".json").alias("file"), F.when(n % 10 == 3, 4).otherwise(3).alias("bytes"), F.sha2(n.cast("string"), 256).alias("sha256"))
    listed = listed.unionByName(p.where("page_id % 10 = 4").select(s("../f", ".json").alias("file"), F.lit(3).alias("bytes"), F.lit("x").alias("sha256")))
    return validate.fixture_problems(fixtures, sources, listed, files, spark.createDataFrame([("h0.example.org",)], "host string"))


@query("SELECT * FROM (VALUES ('c_extra', 'fields', 'is missing'), ('c_mktsegment', 'fields', 'is unknown')) v(subject, path, message)")
def registry_fields(spark, sf_dir):
    have = table(spark, sf_dir, "customer").columns
    return validate.field_problems(spark, have, ["c_custkey", "c_name", "c_extra"], [c for c in have if c not in ("c_mktsegment",)])


@query("""SELECT CAST(doc_id AS VARCHAR) AS subject, 'label' AS path, 'is missing' AS message FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id UNION ALL SELECT CAST(doc_id AS VARCHAR), 'label', 'stands several times' FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY doc_id HAVING count(*) > 1""")
def lookup_violations(spark, sf_dir):
    return validate.lookup_problems(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "label")


@query("SELECT lang AS value, count(*) AS n FROM documents GROUP BY 1")
def counted_values(spark, sf_dir):
    return validate.counted(table(spark, sf_dir, "documents"), "lang")


@query("SELECT page_id, regexp_matches(url, '^(?i:https?)://[^/?#\\s]+') AND page_id % 3 = 0 AS usable, '{\"a_id\":' || page_id || ',\"gap\":null,\"z\":\"x\"}' AS canonical FROM pages")
def canonical_rows(spark, sf_dir):
    u = F.when(F.col("page_id") % 3 == 0, F.col("url")).when(F.col("page_id") % 3 == 1, "ftp://x").otherwise("//x/y")
    p = table(spark, sf_dir, "pages").select("page_id", u.alias("u"), F.lit("x").alias("z"), F.lit(None).cast("string").alias("gap"), F.col("page_id").alias("a_id"))
    return p.select("page_id", validate.is_absolute_http(F.col("u")).alias("usable"), validate.canonical_row(["z", "gap", "a_id"]).alias("canonical"))


# -- migration

_CASES = """c AS (SELECT o_orderkey AS k, 'case' || o_orderkey AS case_id, 'key' || o_orderkey AS case_key, CASE WHEN o_orderkey % 10 = 0 THEN 'https://search.example.com/' || o_orderkey WHEN o_orderkey % 10 = 1 THEN 'https://News.example.org:443/tag/' || o_orderkey ELSE 'https://News.example.org:443/a/' || o_orderkey END AS source_url,
  ['Retail', ' Health  Care', 'unknown', 'Odd Trade', 'Tech'][1 + o_orderkey % 5] AS industry FROM orders),
s AS (SELECT *, CASE k % 10 WHEN 0 THEN 'search_host' WHEN 1 THEN 'index' END AS rule, CASE WHEN k % 40 IN (0, 1) THEN 'admit' WHEN k % 40 IN (10, 11) THEN 'reject' END AS d FROM c),
m AS (SELECT *, 'https://' || CASE WHEN k % 10 = 0 THEN 'search.example.com/' || k WHEN k % 10 = 1 THEN 'news.example.org/tag/' || k ELSE 'news.example.org/a/' || k END AS identity_url FROM s)"""


def _cases(spark, sf_dir):
    k = F.col("o_orderkey")
    s = lambda p: F.concat(F.lit(p), k.cast("string"))
    url = F.when(k % 10 == 0, s("https://search.example.com/")).when(k % 10 == 1, s("https://News.example.org:443/tag/")).otherwise(s("https://News.example.org:443/a/"))
    ind = F.element_at(F.array(*[F.lit(x) for x in ("Retail", " Health  Care", "unknown", "Odd Trade", "Tech")]), (k % 5 + 1).cast("int"))
    rest = {c: F.lit(None).cast("string") for c in migrate.FIELDS}
    rest |= {"case_id": s("case"), "case_key": s("key"), "source_url": url, "source_title": F.when(k % 3 == 0, "Unknown").otherwise(s("T")), "source_domain": F.lit("news.example.org"), "publication_date": F.when(k % 2 == 0, "2024-02-03"), "industry": ind, "workflow_before": F.when(k % 2 == 0, " by hand "), "ai_system_or_tool": s("tool"), "measurable_kpi": F.lit("unknown"), "evidence_quote": F.when(k % 3 == 1, "said so"), "first_seen_at": F.lit("2024-01-02T03:04:05Z")}
    return table(spark, sf_dir, "orders").select(*[c.alias(n) for n, c in rest.items()])


def _reviews(spark, sf_dir):
    k = F.col("o_orderkey")
    c = table(spark, sf_dir, "orders").where("o_orderkey % 40 IN (0, 1, 10, 11)")
    s = lambda p: F.concat(F.lit(p), k.cast("string"))
    url = F.when(k % 10 == 0, s("https://search.example.com/")).otherwise(s("https://News.example.org:443/tag/"))
    return c.select(s("case").alias("case_id"), url.alias("legacy_source_url"), F.when((k % 40).isin(0, 1), "admit").otherwise("reject").alias("decision"), F.when(k % 10 == 0, "search_host").otherwise("index").alias("matched_rule"), F.lit("r").alias("reviewer"), F.lit("2024-03-01T00:00:00Z").alias("reviewed_at"))


def _maps(spark):
    legacy = spark.createDataFrame([("retail", "retail-commerce"), ("health care", "health"), ("tech", "technology-software")], "legacy_value string, industry string")
    return legacy, spark.createDataFrame([("technology-software", "software"), ("retail-commerce", "retail")], "industry string, term string")


@query(
    f"""WITH {_CASES} SELECT sha256('cases|' || identity_url)[1:16] AS record_id, identity_url, source_url AS target_url, CASE WHEN k % 3 <> 0 THEN 'T' || k END AS title, CASE WHEN k % 2 = 0 THEN 'Before: by hand | ' ELSE '' END || 'AI system: tool' || k AS summary, CASE WHEN k % 3 = 1 THEN 'Evidence: said so' END AS curation_reason,
  CASE WHEN k % 2 = 0 THEN '2024-02-03T00:00:00Z' END AS published_at, CASE WHEN k % 3 = 1 THEN 'snippet_only' ELSE 'unverified' END AS verification_status, CASE k % 5 WHEN 0 THEN 'retail-commerce' WHEN 1 THEN 'health' END AS facet_industry,
  CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'industry: insufficient_evidence: no value; ' WHEN 3 THEN 'industry: unmapped_legacy_value: Odd Trade; ' ELSE 'industry: insufficient_evidence: Tech; ' END || 'function: insufficient_evidence; use_case: insufficient_evidence' AS unresolved, rule IS NOT NULL AS admitted
FROM m WHERE rule IS NULL OR d = 'admit'"""
)
def migrated_records(spark, sf_dir):
    records, _ = migrate.migrate(_cases(spark, sf_dir), _reviews(spark, sf_dir), *_maps(spark), "cases", "domain-applications")
    return records.select("record_id", "identity_url", "target_url", "title", "summary", "curation_reason", "published_at", "verification_status", "facet_industry", F.array_join("facet_unresolved", "; ").alias("unresolved"), "admitted")


@query(f"WITH {_CASES} SELECT case_id, identity_url, 'suspicious_url' AS rejection_reason, 'refused by ' || rule || CASE WHEN d = 'reject' THEN '; a reviewer confirmed it' ELSE '' END AS detail FROM m WHERE rule IS NOT NULL AND d IS DISTINCT FROM 'admit'")
def migration_rejections(spark, sf_dir):
    _, rejected = migrate.migrate(_cases(spark, sf_dir), _reviews(spark, sf_dir), *_maps(spark), "cases", "domain-applications")
    return rejected.select("case_id", "identity_url", "rejection_reason", "detail")


@query(
    f"""WITH {_CASES} SELECT count(*) AS source_count, count(*) FILTER (rule IS NULL OR d IS NOT DISTINCT FROM 'admit') AS accepted_count, count(*) FILTER (rule IS NOT NULL AND d IS DISTINCT FROM 'admit') AS rejected_count, count(*) FILTER (rule IS NOT NULL AND d = 'admit') AS reviewed_admit_count,
  count(*) FILTER (rule IS NOT NULL AND d = 'reject') AS reviewed_reject_count, count(*) FILTER (rule IS NOT NULL AND d IS NULL) AS unresolved_rejection_count FROM s"""
)
def migration_summary(spark, sf_dir):
    return migrate.summary(_cases(spark, sf_dir), _reviews(spark, sf_dir))


@query(
    """WITH c AS (SELECT o_orderkey AS k, 'case' || CASE WHEN o_orderkey % 200 = 7 THEN 'twin' ELSE CAST(o_orderkey AS VARCHAR) END AS case_id FROM orders)
SELECT case_id AS subject, 'source_url' AS path, 'is empty' AS message FROM c WHERE k % 100 = 3 UNION ALL SELECT case_id, 'first_seen_at', 'is no date' FROM c WHERE k % 100 = 5 UNION ALL SELECT case_id, 'case_id', 'stands twice' FROM c GROUP BY 1 HAVING count(*) > 1"""
)
def migration_input(spark, sf_dir):
    k = F.regexp_extract("case_id", r"(\d+)$", 1).cast("long")
    c = _cases(spark, sf_dir).withColumns({"source_url": F.when(k % 100 == 3, " ").otherwise(F.col("source_url")), "first_seen_at": F.when(k % 100 == 5, "some day").otherwise(F.col("first_seen_at"))}).withColumn("case_id", F.when(k % 200 == 7, "casetwin").otherwise(F.col("case_id")))
    return migrate.registry_problems(c)


@query(
    f"""WITH {_CASES}, r AS (SELECT * FROM s WHERE d IS NOT NULL) SELECT 'nobody' AS subject, 'case_id' AS path, 'is no case' AS message UNION ALL SELECT case_id, 'decision', 'is neither admit nor reject' FROM r WHERE k % 80 = 0
UNION ALL SELECT case_id, 'matched_rule', 'isn''t the rule that refuses the address' FROM r WHERE k % 80 = 1 UNION ALL SELECT case_id, 'legacy_source_url', 'isn''t the case''s own' FROM r WHERE k % 80 = 10 UNION ALL SELECT case_id, 'reviewed_at', 'is no time' FROM r WHERE k % 80 = 11"""
)
def migration_reviews(spark, sf_dir):
    k = F.regexp_extract("case_id", r"(\d+)$", 1).cast("long")
    r = _reviews(spark, sf_dir).withColumns({"decision": F.when(k % 80 == 0, "maybe").otherwise(F.col("decision")), "matched_rule": F.when(k % 80 == 1, "feed").otherwise(F.col("matched_rule")), "legacy_source_url": F.when(k % 80 == 10, F.concat("legacy_source_url", F.lit("/"))).otherwise(F.col("legacy_source_url")), "reviewed_at": F.when(k % 80 == 11, "2024-03-01").otherwise(F.col("reviewed_at"))})
    odd = spark.createDataFrame([("nobody", "u", "admit", "feed", "r", "2024-03-01T00:00:00Z")], r.schema)
    return migrate.review_problems(r.unionByName(odd), _cases(spark, sf_dir))


@query("SELECT 'https://a.example.org/' || k AS subject, 'identity_url' AS path, 'is shared' AS message FROM (SELECT o_custkey AS k FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT sha256('https://a.example.org/' || k)[1:16], 'content_id', 'is shared' FROM (SELECT o_custkey AS k FROM orders GROUP BY 1 HAVING count(*) > 1)")
def shared_identities(spark, sf_dir):
    from ..functions import urls

    u = F.concat(F.lit("https://a.example.org/"), F.col("o_custkey").cast("string"))
    r = table(spark, sf_dir, "orders").select(u.alias("identity_url"), urls.content_id(u).alias("content_id"), F.col("o_orderkey").cast("string").alias("record_id"))
    return migrate.identity_problems(r)
