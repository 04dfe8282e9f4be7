"""Queries over what runs on the driver: documents and tables written and read back,
rounds, guards, generated schemas; and the remaining reports of registries and records."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import config
from ..operators import compare, coverage, dedupe, facets, links, records, registry, schedule, shards, validate
from ..operators.scan import Search, scan
from ..runtime import shared_folder
from ..sinks.publish import Durations, PublishError, Store, narrowed, run_id, serialized
from .frames import CURATION, FACETS, SIGNALS, deliveries, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


RUN = "20240301T000000Z-7"


@query(
    """WITH c AS (SELECT o_orderpriority AS topic, count(*) AS n, sum(o_orderkey) AS s FROM orders GROUP BY 1)
SELECT 'cells/' || topic AS name, n AS rows, CAST(s AS BIGINT) AS checksum FROM c UNION ALL SELECT 'manifest', count(*), CAST(sum(n) AS BIGINT) FROM c UNION ALL SELECT 'pointer', 1, 1 UNION ALL SELECT 'refused', 5, 0"""
)
def published_run(spark, sf_dir):
    """A run's cells written by topic, its manifest and pointer, read back; five refusals that leave it as it is."""
    store = Store(spark, shared_folder(spark, "published"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("topic"), F.lit("all").alias("category"), F.col("o_orderkey").cast("string").alias("record_id"))
    bad = validate.report(o, F.col("record_id"), [("topic", "is missing", F.col("topic").isNotNull())])
    store.write_table(store.cells(RUN), o, bad, by=["topic"], sort=records.order())
    written = store.table(store.cells(RUN))
    n = [r.asDict() for r in written.groupBy("topic").agg(F.count("*").alias("n")).collect()]
    manifest = {"harvest_run_id": RUN, "finished_at": "2024-03-01T00:00:00Z", "cells": n}
    refused = 0
    attempts = [
        lambda: store.publish(RUN, manifest | {"finished_at": None}),
        lambda: store.publish(RUN, manifest | {"harvest_run_id": "other"}),
        lambda: store.publish(RUN, manifest, lambda d: ["invalid"]),
        lambda: (store.publish(RUN, manifest), store.publish(RUN, manifest)),
        lambda: store.write_table(store.cells(RUN), o),
    ]
    for attempt in attempts:
        try:
            attempt()
        except PublishError:
            refused += 1
    doc = json.loads(store.read(store.manifest(store.latest())))
    rest = [("manifest", len(doc["cells"]), sum(c["n"] for c in doc["cells"])), ("pointer", 1, int(store.latest() == RUN)), ("refused", refused, len(store.debris()))]
    cells = written.groupBy(F.concat(F.lit("cells/"), F.col("topic")).alias("name")).agg(F.count("*").alias("rows"), F.sum(F.col("record_id").cast("long")).alias("checksum"))
    return cells.unionByName(spark.createDataFrame(rest, "name string, rows long, checksum long"))


@query(
    """WITH d AS (SELECT n_name AS name, '{' || chr(10) || '  "id": ' || n_nationkey || ',' || chr(10) || '  "list": [' || chr(10) || '    "é",' || chr(10) || '    null' || chr(10) || '  ],' || chr(10) || '  "name": "' || n_name || '"' || chr(10) || '}' || chr(10) AS text FROM nation)
SELECT name || '.json' AS file, octet_length(encode(text)) AS bytes, sha256(text) AS sha256 FROM d"""
)
def migration_bundle(spark, sf_dir):
    """Documents staged, checked and renamed as one, then listed with their digests."""
    from ..sources import readers

    store = Store(spark, shared_folder(spark, "bundle"))
    docs = {f"{r['n_name']}.json": ({"name": r["n_name"], "id": r["n_nationkey"], "list": ["é", None]}, lambda d: ()) for r in table(spark, sf_dir, "nation").collect()}
    store.write_bundle("out", docs)
    return readers.file_manifest(spark, f"{store.root}/out")


@query("SELECT 'v' || k AS version, CAST(sum(CASE WHEN user_id % 3 < k THEN 1 ELSE 0 END) AS BIGINT) AS seen, count(DISTINCT CASE WHEN user_id % 3 < k THEN user_id END) AS keys FROM events, (VALUES (1), (2), (3)) t(k) GROUP BY 1")
def ledger_versions(spark, sf_dir):
    """A ledger loaded (empty at first), merged and written anew three times, never in place."""
    from ..operators.ledger import merge_observations

    store = Store(spark, shared_folder(spark, "ledgers"))
    schema = "cell_id string, identity_url string, first_seen_at timestamp, last_seen_at timestamp, seen_count long, outcome string, outcome_conflict boolean"
    e = table(spark, sf_dir, "events").select(F.lit("c").alias("cell_id"), F.col("user_id").cast("string").alias("identity_url"), F.col("ts").alias("seen_at"), F.lit("pending").alias("outcome"), (F.col("user_id") % 3).alias("k"))
    out = None
    for k in range(3):
        before = store.load_ledger(schema, ["c"])
        merged = merge_observations(before, e.where(F.col("k") == k).drop("k"), ["cell_id", "identity_url"])
        store.write_table("next", merged)
        now = store.table("next").agg(F.lit(f"v{k + 1}").alias("version"), F.sum("seen_count").alias("seen"), F.count("*").alias("keys")).collect()
        shards.check_growth(before.count(), now[0]["keys"], "the ledger")
        store.delete(store.ledger())
        store.write_table(store.ledger(), store.table("next"))
        store.delete("next")
        row = spark.createDataFrame([tuple(now[0])], "version string, seen long, keys long")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    """WITH g AS (SELECT n_name AS slug, n_nationkey AS k, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), r AS (SELECT 'gap__nation__' || slug AS lane, row_number() OVER (ORDER BY n DESC, slug) AS p FROM g WHERE k % 3 <> 0)
SELECT 1 AS round, 'cell__a,cell__b' AS lanes, 0 AS new_accepted, NULL AS stop_reason UNION ALL SELECT 2, string_agg(lane, ',' ORDER BY p), 3, NULL FROM r WHERE p <= 2 UNION ALL SELECT 3, string_agg(lane, ',' ORDER BY p), 0, 'no_progress' FROM r WHERE p IN (3, 4)"""
)
def adaptive_rounds(spark, sf_dir):
    """Cells, then the best gaps, then the next ones, which bring nothing."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    g = c.groupBy(F.col("n_name").alias("slug"), "n_nationkey").agg(F.count("*").cast("double").alias("score"))
    g = g.select(F.lit("nation").alias("axis"), "slug", "score", F.concat(F.lit("gap__nation__"), F.col("slug")).alias("lane_id"), F.when(F.col("n_nationkey") % 3 == 0, "no_credible_source").alias("not_opened_reason"))
    done: list[str] = []

    def work(n, lanes):
        done.extend(lanes)
        return schedule.Result(3 if n == 2 else 0, None)

    rounds = schedule.run_rounds(["cell__a", "cell__b"], lambda left: g.where(~F.col("lane_id").isin(*done)), work, thresholds=config.published_thresholds(CURATION))
    return spark.createDataFrame([(r.number, ",".join(r.lanes), r.new_accepted, r.stop_reason) for r in rounds], "round int, lanes string, new_accepted int, stop_reason string")


_T = CURATION["scoring"]["thresholds"]


@query(
    f"""SELECT * FROM (VALUES ('accept_composite', '{_T['accept_composite']}'), ('bound.requests', '12'), ('config', '{{"bounds":{{"cells":12}},"thresholds":{{"accept_composite":{_T['accept_composite']},"min_quality":{_T['min_quality']},"min_relevance":{_T['min_relevance']}}},"versions":{{"facets":1}}}}'), ('refused', 'requests may be at most 12, not 13'), ('run_id', '20240301T000000Z-7'), ('schema', 'content differs'), ('schema.again', 'same'), ('seconds', '1.235'), ('shrink', 'the registry would shrink from 3 to 2 rows'), ('stale', 'true')) v(name, value)"""
)
def driver_facts(spark, sf_dir):
    ticks = iter([1.0, 2.23456])
    d = Durations(lambda: next(ticks))
    d.begin("a")
    block = config.run_config({"facets": 1}, {"cells": 12}, CURATION)
    base, values = {"enum": {"$vocabulary": "k"}}, {"k": ["b", "a"]}

    def refusal(f):
        try:
            return str(f())
        except ValueError as e:
            return str(e)

    q = table(spark, sf_dir, "orders")
    facts = {
        "accept_composite": str(block["thresholds"]["accept_composite"]), "bound.requests": f"{narrowed(25, 12, 'requests'):g}", "config": json.dumps(block, sort_keys=True, separators=(",", ":")), "refused": refusal(lambda: narrowed(12, 13, "requests")), "run_id": run_id(1709251200, 7),
        "schema": validate.schema_drift(b"{}", base, values), "schema.again": validate.schema_drift(serialized(validate.generated_schema(base, values)), base, values) or "same", "seconds": str(d.end("a")), "shrink": refusal(lambda: shards.check_growth(3, 2, "the registry")),
        "stale": str(shards.refresh_needed(q, coverage.is_stale(F.col("o_orderdate"), F.lit(None).cast("timestamp"), F.lit("1999-01-01").cast("timestamp"), 30, F.lit(True)))).lower(),
    }
    return spark.createDataFrame(list(facts.items()), "name string, value string")


@query("SELECT CASE WHEN r_regionkey % 2 = 0 THEN 'f' || r_regionkey || '.json' ELSE 'bad' || r_regionkey || '.json' END AS file, CASE WHEN r_regionkey % 2 = 0 THEN r_name END AS topic, CASE WHEN r_regionkey % 2 = 1 THEN 'not_json' END AS error FROM region")
def configuration_scan(spark, sf_dir):
    """Topic files written, one in two broken, and scanned."""
    store = Store(spark, shared_folder(spark, "config"))
    for r in table(spark, sf_dir, "region").collect():
        if r["r_regionkey"] % 2 == 0:
            store.write_document(f"f{r['r_regionkey']}.json", {"topic": r["r_name"]})
        else:
            store._put(f"bad{r['r_regionkey']}.json", b'{"topic": ')
    return config.scan_documents(spark, store.root).select("file", F.try_variant_get("document", "$.topic", "string").alias("topic"), "error")


@query("SELECT r_name || '.json' AS file, 'https://f.example.org/' || (r_regionkey % 4) AS url, 'body ' || r_regionkey AS body, CASE WHEN r_regionkey IN (0, 4) THEN 'url_claimed_twice' WHEN r_regionkey = 2 THEN 'one_body_needed' END AS problem FROM region")
def fixture_scan(spark, sf_dir):
    import base64

    from ..sources import adapters

    store = Store(spark, shared_folder(spark, "fixtures"))
    for r in table(spark, sf_dir, "region").collect():
        k, text = r["r_regionkey"], f"body {r['r_regionkey']}"
        doc = {"fixture_id": r["r_name"], "url": f"https://f.example.org/{k % 4}", "status": 200}
        doc |= {"body": text} if k % 2 == 0 else {"body_b64": base64.b64encode(text.encode()).decode()}
        doc |= {"body_b64": "eA=="} if k == 2 else {}
        store.write_document(f"{r['r_name']}.json", doc)
    return adapters.stored_bodies(spark, store.root).select("file", "url", "body", "problem")


@query(
    """SELECT 'r' || o_orderkey AS record_id, row_number() OVER (ORDER BY o_orderpriority, o_clerkless, 'r' || o_orderkey) AS place FROM (SELECT *, o_orderstatus AS o_clerkless FROM orders) QUALIFY place <= 25"""
)
def link_sample(spark, sf_dir):
    """The feature is a sample of the first 25 in the total order."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("topic"), F.col("o_orderstatus").alias("category"), F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("record_id"))
    rows = schedule.link_sample(o, 25).collect()
    return spark.createDataFrame([(r["record_id"], k + 1) for k, r in enumerate(rows)], "record_id string, place long")


@query(
    """WITH r AS (SELECT doc_id, 'https://d.example.org/' || doc_id // 2 AS u, doc_id // 2 AS k FROM documents)
SELECT doc_id, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS checks, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 5 = 0 THEN 'not_checked' ELSE 'ok' END ELSE 'old' END AS access_status, CASE WHEN k % 3 = 0 AND k % 5 <> 0 THEN 'h' || (k % 2) ELSE 'h0' END AS content_hash, k % 3 = 0 AND k % 5 <> 0 AND k % 2 = 1 AS changed FROM r"""
)
def linkcheck(spark, sf_dir):
    k = F.floor(F.col("doc_id") / 2)
    u = F.concat(F.lit("https://d.example.org/"), k.cast("string"))
    first = F.struct(F.lit("2024-01-01T00:00:00Z").alias("checked_at"), F.lit("old").alias("access_status"), F.lit("h0").alias("content_hash"), F.lit(False).alias("changed_materially"))
    r = table(spark, sf_dir, "documents").select("doc_id", u.alias("identity_url"), k.alias("k"), F.array(first).alias("link_history"), F.lit("old").alias("access_status"), F.lit("h0").alias("content_hash"))
    fetches = r.where("k % 5 <> 0").select("identity_url", F.lit("ok").alias("access_status"), F.concat(F.lit("h"), (F.col("k") % 2).cast("string")).alias("content_hash"))
    x = links.check_run(r, r.where("k % 3 = 0"), fetches, "2024-03-01T00:00:00Z")
    return x.select("doc_id", F.size("link_history").alias("checks"), "access_status", "content_hash", F.element_at("link_history", -1)["changed_materially"].alias("changed"))


@query(
    """SELECT page_id, page_id % 3 <> 1 AS one, page_id % 4 = 0 AS site FROM pages"""
)
def equivalent_addresses(spark, sf_dir):
    n = F.col("page_id").cast("string")
    a = F.concat(F.lit("https://A.example.org/x/"), n)
    b = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("HTTPS://a.example.org:443/./x/"), n, F.lit("?utm_source=q"))).when(F.col("page_id") % 3 == 1, F.concat(a, F.lit("?q=1"))).otherwise(F.concat(F.lit("https://a.example.org//x/"), n))
    other = F.when(F.col("page_id") % 4 == 0, "https://z.example.org/").otherwise("https://example.net/")
    return table(spark, sf_dir, "pages").select("page_id", links.equivalent(a, b).alias("one"), links.same_site(a, other).alias("site"))


@query(
    """WITH h AS (SELECT DISTINCT n_nationkey AS k FROM nation) SELECT 'h' || k AS host, agent, pattern, allow, CASE WHEN agent = 'slowbot' OR agent = 'otherbot' THEN 2.5::DOUBLE END AS crawl_delay FROM h, (VALUES ('*', '/private', false), ('*', '/private/' , true), ('slowbot', '/x*y$', false), ('otherbot', '/x*y$', false), ('quiet', '', false)) v(agent, pattern, allow)"""
)
def robots_files(spark, sf_dir):
    body = "# a file\nSitemap: https://x/\nDisallow: /before-any-agent\nUser-agent: *\nDisallow: /private # no\nAllow: /private/\r\n\nUser-Agent: SlowBot\nuser-agent: OtherBot\nCrawl-delay: 2.5\nDisallow: /x*y$\n\nUser-agent: quiet\nDisallow:\nHost: x"
    f = table(spark, sf_dir, "nation").select(F.concat(F.lit("h"), F.col("n_nationkey").cast("string")).alias("host"), F.lit(body).alias("body"))
    return links.robots_rules(f, "host", "body")


@query(
    """SELECT doc_id, sha256('t|https://d.example.org/' || doc_id)[1:16] AS record_id, 't__' || source AS cell_id, 'a,b' AS tags, CASE WHEN doc_id % 3 <> 0 THEN 'T' || doc_id END AS title, 'https://d.example.org/' || doc_id AS canonical_url, CASE WHEN doc_id % 2 = 0 THEN '2024-02-03T00:00:00Z' END AS published_at, '2024-03-01T00:00:00Z' AS discovered_at,
  'not_checked' AS access_status, 0.5::DOUBLE AS relevance_score, CAST(NULL AS DOUBLE) AS freshness_score, 'fallback' AS rule_id, 's1' AS source FROM documents"""
)
def whole_records(spark, sf_dir):
    n = F.col("doc_id")
    u = F.concat(F.lit("https://d.example.org/"), n.cast("string"))
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.lit("t").alias("topic"), F.col("source").alias("category"), u.alias("identity_url"), u.alias("target_url"), F.lit("s1").alias("source_id"), F.lit("feed").alias("adapter"), F.array(F.lit("b"), F.lit("a"), F.lit(" "), F.lit("b")).alias("tags"),
        F.when(n % 3 == 0, " UNKNOWN").otherwise(F.concat(F.lit(" T"), n.cast("string"))).alias("title"), F.when(n % 2 == 0, "3 Feb 2024 00:00:00 +0000").otherwise("soon").alias("published_at"), F.lit(0.5).alias("relevance"),
    )
    r = records.make_full(d, RUN, "2024-03-01T00:00:00Z")
    return r.select(F.substring_index("identity_url", "/", -1).cast("long").alias("doc_id"), "record_id", "cell_id", F.array_join("tags", ",").alias("tags"), "title", "canonical_url", "published_at", "discovered_at", "access_status", "relevance_score", "freshness_score", "classification.rule_id", F.col("provenance.source_id").alias("source"))


@query(
    """SELECT doc_id, doc_id % 5 <> 0 AND lang <> 'es' AS applicable, doc_id % 5 <> 0 AND lang = 'en' AND source = (SELECT min(source) FROM documents) AS gated, doc_id % 5 <> 0 AND lang = 'de' AND source = (SELECT min(source) FROM documents) AS report_only,
  NOT (doc_id % 5 <> 0 AND lang = 'en' AND source = (SELECT min(source) FROM documents)) OR doc_id % 2 = 0 AS eligible FROM documents"""
)
def facet_applicability(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    first = d.agg(F.min("source")).first()[0]
    app = facets.applicability(F.when(F.col("doc_id") % 5 == 0, "cross_reference").otherwise("full"), F.col("lang"), F.col("source"), ["es"], [("en", first)], [("de", first)])
    x = d.select("doc_id", app.alias("a"))
    return x.select("doc_id", "a.*", facets.is_eligible(F.col("a"), F.col("doc_id") % 2 == 0).alias("eligible"))


_contact = SIGNALS[[s.name for s in SIGNALS].index("contact")].patterns


@query(
    f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract(text, '{_contact[0]}') AS a, regexp_extract(text, '{_contact[1]}') AS b FROM documents) SELECT doc_id, 'contact' AS signal, 'text' AS field, CASE WHEN a <> '' THEN a ELSE b END AS matched FROM d WHERE a <> '' OR b <> ''
UNION ALL SELECT doc_id, 'licence', 'text', CASE WHEN l <> '' THEN l WHEN c <> '' THEN c WHEN r <> '' THEN r ELSE e END FROM (SELECT doc_id, regexp_extract(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(licensed[^\\p{{L}}\\p{{N}}_]+under)($|[^\\p{{L}}\\p{{N}}_])', 2) AS l, regexp_extract(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(copyright)($|[^\\p{{L}}\\p{{N}}_])', 2) AS c,
  regexp_extract(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(all[^\\p{{L}}\\p{{N}}_]+rights[^\\p{{L}}\\p{{N}}_]+reserved)($|[^\\p{{L}}\\p{{N}}_])', 2) AS r, regexp_extract(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(released[^\\p{{L}}\\p{{N}}_]+under)($|[^\\p{{L}}\\p{{N}}_])', 2) AS e FROM d) WHERE l <> '' OR c <> '' OR r <> '' OR e <> ''"""
)
def first_hits(spark, sf_dir):
    """The first hit of two signals as it stands in the text."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = scan(d, Search({"text": "text"}, [s for s in SIGNALS if s.name in ("licence", "contact")]), ["doc_id"])
    kept = found.select("doc_id", F.explode("evidence").alias("e"))
    return kept.select("doc_id", "e.signal", "e.field", "e.matched")


@query("WITH x AS (SELECT doc_id, unnest(['en', 'de']) AS signal FROM documents) SELECT doc_id, string_agg(signal || '=' || doc_id, ',' ORDER BY signal DESC) AS evidence FROM x GROUP BY 1")
def evidence_projection(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    e = lambda s: F.struct(F.lit(s).alias("signal"), F.lit("text").alias("field"), n.alias("matched"), F.lit(3).alias("offset"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.array(e("en"), e("de")).alias("evidence"))
    return d.select("doc_id", F.array_join(F.transform(records.evidence_projection("evidence"), lambda x: F.concat(x["signal"], F.lit("="), x["matched"])), ",").alias("evidence"))


@query("SELECT p || page_id % 7 AS source_id, page_id AS position, page_id % 5 = 0 AS conflict FROM pages, (VALUES ('src'), ('alt')) v(p)")
def delivery_conflicts(spark, sf_dir):
    """A third lane delivers every observation again, each fifth time with another title."""
    d = deliveries(spark, sf_dir).select("source_id", "position", "target_url", "lane_id", "title")
    again = d.withColumns({"lane_id": F.lit("lane9"), "title": F.when(F.col("position") % 5 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title"))})
    return dedupe.observations(d.unionByName(again), ["title"]).select("source_id", "position", "conflict")


@query(
    """WITH d AS (SELECT n_nationkey AS k FROM nation) SELECT 'd' || k AS name, '$.at' AS path, 'changed' AS kind, '"l"' AS left_value, '"r"' AS right_value, 'permitted' AS verdict FROM d UNION ALL SELECT 'd' || k, '$.records[r1].title', 'changed', '"a"', '"b"', 'content' FROM d WHERE k % 2 = 0
UNION ALL SELECT 'd' || k, '$.records[r2].id', 'removed', '"r2"', NULL, 'violation' FROM d WHERE k % 3 = 0 UNION ALL SELECT 'd' || k, '$.records[r2]', 'removed', 'object(2)', NULL, 'violation' FROM d WHERE k % 3 = 0 UNION ALL SELECT 'd' || k, '$.records[r2].title', 'removed', '"a"', NULL, 'content' FROM d WHERE k % 3 = 0
UNION ALL SELECT 'd' || k, '$.records', 'changed', 'array(2)', 'array(1)', 'violation' FROM d WHERE k % 3 = 0"""
)
def document_walk(spark, sf_dir):
    k = F.col("n_nationkey")
    doc = lambda at, title, two: F.concat(F.lit(f'{{"at":"{at}","records":['), F.when(two, F.lit('{"id":"r2","title":"a"},')).otherwise(""), F.lit('{"title":"'), title, F.lit('","id":"r1"}]}'))
    n = table(spark, sf_dir, "nation").withColumn("name", F.concat(F.lit("d"), k.cast("string")))
    left = n.select("name", doc("l", F.lit("a"), F.lit(True)).alias("document"))
    right = n.select("name", doc("r", F.when(k % 2 == 0, "b").otherwise("a"), k % 3 != 0).alias("document"))
    return compare.document_differences(left, right, "name", "document", r"^\$\.at$", r"\.title$")


_ENT = """e AS (SELECT o_orderkey AS n, 't|name ' || o_custkey % 97 AS entity_key, CASE WHEN o_orderkey % 9 = 0 THEN 'verified' WHEN o_orderkey % 4 = 0 THEN 'snippet-only' END AS ds, 'd' || o_orderkey AS d, CASE WHEN o_orderkey % 5 = 0 THEN 'v' || o_orderkey ELSE 'unknown' END AS vendor,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'https://github.com/own/r' || o_custkey % 97 || CASE WHEN o_orderkey % 50 = 7 THEN '-fork' ELSE '' END END AS url, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS stars, 'k' || o_orderkey % 4 AS topic2 FROM orders),
x AS (SELECT *, CASE ds WHEN 'verified' THEN 2 WHEN 'snippet-only' THEN 1 ELSE 0 END AS r, CASE WHEN url IS NOT NULL THEN stars END AS st FROM e)"""


@query(
    f"""WITH {_ENT}, m AS (SELECT entity_key, max(r) AS mr, min(n) AS first_n FROM x GROUP BY 1), b AS (SELECT entity_key, arg_min(d, n) AS d FROM x JOIN m USING (entity_key) WHERE r = mr GROUP BY 1), f AS (SELECT entity_key, arg_min(url, n) FILTER (url IS NOT NULL) AS url, arg_min(vendor, n) FILTER (vendor <> 'unknown') AS vendor, arg_max(st, n) FILTER (st IS NOT NULL) AS stars, string_agg(DISTINCT topic2, ',' ORDER BY topic2) AS topics, count(*) AS c FROM x GROUP BY 1),
h AS (SELECT x.entity_key, count(*) AS conflicts FROM x JOIN f USING (entity_key) WHERE x.url IS NOT NULL AND x.url <> f.url GROUP BY 1)
SELECT entity_key, b.d AS description, f.url AS target_url, vendor AS maintainer_or_vendor, stars AS github_stars, topics, CAST(c AS INTEGER) AS corroboration_count, CAST(coalesce(conflicts, 0) AS INTEGER) AS conflicts FROM f JOIN b USING (entity_key) LEFT JOIN h USING (entity_key)"""
)
def entity_merge(spark, sf_dir):
    n, k = F.col("o_orderkey"), F.col("o_custkey") % 97
    s = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    o = table(spark, sf_dir, "orders").select(
        F.when(n % 2 == 0, s("t|name ", k)).alias("entity_key"), F.lit("t").alias("topic"), F.concat(F.lit(" NAME  "), k.cast("string")).alias("name"), n.alias("seq"), F.when(n % 9 == 0, "verified").when(n % 4 == 0, "snippet-only").alias("description_source"), s("d", n).alias("description"), F.when(n % 5 == 0, s("v", n)).otherwise("unknown").alias("maintainer_or_vendor"),
        F.lit("unknown").alias("freshness_signal"), F.when(n % 6 != 0, F.concat(s("https://github.com/own/r", k), F.when(n % 50 == 7, "-fork").otherwise(""))).alias("target_url"), F.lit("tool").alias("entity_type"), F.when(n % 3 == 0, n).alias("github_stars"), F.array(s("k", n % 4)).alias("related_topics"),
    )
    m = registry.merged_entities(o.limit(0), o)
    return m.select("entity_key", "description", "target_url", "maintainer_or_vendor", "github_stars", F.array_join("related_topics", ",").alias("topics"), "corroboration_count", F.size("conflicts").alias("conflicts"))


@query(
    """WITH e AS (SELECT o_orderkey AS n, 'co ' || o_custkey % 89 || '|tool|after' AS case_key, CASE WHEN o_orderkey % 8 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS r, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3 END AS kpi, CASE WHEN o_orderkey % 4 = 1 THEN 'i' || o_orderkey END AS industry, (o_orderkey % 10) / 10.0::DOUBLE AS conf FROM orders),
m AS (SELECT case_key, max(r) AS mr FROM e GROUP BY 1), b AS (SELECT case_key, arg_min('q' || n, n) AS q FROM e JOIN m USING (case_key) WHERE r = mr GROUP BY 1),
f AS (SELECT case_key, arg_min(kpi, n) AS held0, first(kpi ORDER BY n) AS held, arg_min(industry, n) FILTER (industry IS NOT NULL) AS industry, max(conf) AS confidence, CAST(count(*) AS INTEGER) AS c FROM e GROUP BY 1),
g AS (SELECT e.case_key, count(*) AS k FROM e JOIN f USING (case_key) WHERE kpi IS NOT NULL AND held IS NOT NULL AND kpi <> held GROUP BY 1)
SELECT case_key, q AS evidence_quote, CAST(held AS VARCHAR) AS kpi_value, industry, confidence, c AS corroboration_count, CAST(coalesce(k, 0) AS INTEGER) AS conflicts FROM f JOIN b USING (case_key) LEFT JOIN g USING (case_key)"""
)
def case_merge(spark, sf_dir):
    n = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    o = table(spark, sf_dir, "orders").select(
        none.alias("case_key"), F.concat(F.lit("Co "), (F.col("o_custkey") % 89).cast("string")).alias("company"), F.lit("Tool").alias("ai_system_or_tool"), F.lit(" after").alias("workflow_after"), n.alias("seq"), F.when(n % 8 == 0, "verified").when(n % 3 == 0, "snippet-only").otherwise("unknown").alias("verification_status"),
        F.concat(F.lit("q"), n.cast("string")).alias("evidence_quote"), none.alias("source_url"), none.alias("source_title"), none.alias("source_domain"), F.when(n % 7 != 0, (n % 3).cast("string")).alias("kpi_value"), F.when(n % 4 == 1, F.concat(F.lit("i"), n.cast("string"))).otherwise("Unknown").alias("industry"),
        none.alias("workflow_before"), none.alias("measurable_kpi"), none.alias("transformation_date"), none.alias("publication_date"), (n % 10 / 10.0).alias("confidence"),
    )
    m = registry.merged_cases(o.limit(0), o)
    return m.select("case_key", "evidence_quote", "kpi_value", "industry", "confidence", "corroboration_count", F.size("conflicts").alias("conflicts"))


@query(
    """WITH q AS (SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey % 3 = 0 THEN 'news' WHEN c_nationkey % 3 = 1 THEN 'evergreen' END AS tier, count(o_orderkey) AS y, count(*) FILTER (o_orderstatus = 'F') AS v FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT coalesce(tier, 'evergreen') AS tier, count(*) AS strategies, CAST(sum(y) AS BIGINT) AS yield, round(CAST(sum(v) AS DOUBLE) / sum(y), 6) AS verified_share FROM q GROUP BY 1"""
)
def tier_yield(spark, sf_dir):
    from ..operators import policies

    tiers = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 3 == 0, "news").when(F.col("n_nationkey") % 3 == 1, "evergreen").alias("tier"))
    y = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("y"), F.count_if(F.col("o_orderstatus") == "F").alias("v"))
    s = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(y, "c_custkey", "left")
    t = policies.tiers(s, tiers, "c_nationkey").groupBy("tier")
    return t.agg(F.count("*").alias("strategies"), F.coalesce(F.sum("y"), F.lit(0)).alias("yield"), F.round(F.sum("v") / F.sum("y"), 6).alias("verified_share"))


@query(
    """SELECT 'lang' AS dimension, count(*) AS rows, count(DISTINCT lang) AS "values", count(*) AS reconciled FROM documents UNION ALL SELECT 'source', count(*), count(DISTINCT source), count(*) FROM documents UNION ALL SELECT 'text', count(*), count(DISTINCT text), count(text) FROM documents"""
)
def assessment_reconciliation(spark, sf_dir):
    """For each dimension: rows, distinct values, and the sum of the counts by value, which must be the rows that have one."""
    d = table(spark, sf_dir, "documents")
    out = None
    for c in ("lang", "source", "text"):
        key = F.sha2(c, 256) if c == "text" else F.col(c)
        n = d.groupBy(key.alias("value")).agg(F.count("*").alias("n"))
        one = n.agg(F.lit(c).alias("dimension"), F.sum("n").alias("rows"), F.count("value").alias("values"), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("reconciled"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT 'clean' AS name, 0 AS findings UNION ALL SELECT 'unfinished', 1 UNION ALL SELECT 'coverage', (SELECT count(DISTINCT lang) FROM documents)")
def persisted_reports(spark, sf_dir):
    """A coverage report sorted, validated and written as a document, and read back; an invalid one is refused."""
    store = Store(spark, shared_folder(spark, "reports"))
    rows = [r.asDict() for r in validate.counted(table(spark, sf_dir, "documents"), "lang").orderBy("value").collect()]
    store.write_document("coverage.json", {"by_lang": rows})
    valid = lambda d: [] if d.get("by_lang") else ["by_lang is empty"]
    found = 0
    try:
        store.write_document("coverage.json", {"by_lang": []}, valid)
    except PublishError:
        found = 1
    read = json.loads(store.read("coverage.json"))
    return spark.createDataFrame([("clean", len(list(valid(read)))), ("unfinished", found), ("coverage", len(read["by_lang"]))], "name string, findings int")


@query("SELECT slug, axis, count(*) AS n FROM (VALUES ('other-unclear', 'industry'), ('other-unclear', 'use_case')) v(slug, axis) GROUP BY 1, 2")
def sentinel_entries(spark, sf_dir):
    v = config.vocabulary_frame(spark, FACETS)
    return v.where(F.col("slug") == facets.SENTINEL).groupBy("slug", "axis").agg(F.count("*").alias("n"))


@query("SELECT user_id, min(event_id) AS first_event, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS outcome_conflict FROM events GROUP BY user_id")
def ledger_conflicts(spark, sf_dir):
    """A contradiction of outcomes stays told, also after a merge that brings none."""
    from ..operators.ledger import merge_observations

    e = table(spark, sf_dir, "events")
    none = spark.createDataFrame([], "user_id long, first_seen_at timestamp, last_seen_at timestamp, seen_count long, outcome string, outcome_conflict boolean, event long")
    o = lambda outcome, at: e.groupBy("user_id").agg(F.min("event_id").alias("event")).select("user_id", F.lit(at).cast("timestamp").alias("seen_at"), outcome.alias("outcome"), "event")
    led = merge_observations(none, o(F.lit("accepted"), "2024-01-01"), ["user_id"], ["event"])
    led = merge_observations(led, o(F.when(F.col("user_id") % 2 == 0, "rejected").otherwise("accepted"), "2024-01-02"), ["user_id"], ["event"])
    led = merge_observations(led, o(F.lit("accepted"), "2024-01-03"), ["user_id"], ["event"])
    return led.select("user_id", F.col("event").alias("first_event"), F.col("outcome_conflict").cast("int").alias("outcome_conflict"))

