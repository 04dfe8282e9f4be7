"""Registered corpus queries: one for each operator, over its whole table."""

from __future__ import annotations

from . import bpe, decontaminate, exact, licenses, lines, neardup, quality, sharding, suffix, warc
from pyspark.sql import functions as F

from .common import table


def op1_quality_classifier(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, bpe.codec_for(docs)).select("doc_id", "ids", "n_tokens", "exact")


def op3_simhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_license_scans(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=64, appended=8)


def op7_suffix_array_dedup(spark, sf_dir):
    return suffix.repeated_spans(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    return lines.line_dedup(table(spark, sf_dir, "documents"), with_count=True).select("doc_id", "text", "lines_dropped")


def op9_exact_dedup(spark, sf_dir):
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    chunks = warc.pages_as_chunks(table(spark, sf_dir, "pages"), chunk_bytes=4096)
    return chunks.withColumn("payload", F.translate(F.base64("payload"), "\r\n", ""))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_bpe, op3_simhash_near_dedup, op4_benchmark_decontamination, op5_license_scans, op6_sharding, op7_suffix_array_dedup, op8_line_dedup, op9_exact_dedup,
    op10_warc,
)}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op6_sharding"] = """
WITH RECURSIVE sizes(n) AS (VALUES (64), (72)),
k AS (SELECT DISTINCT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16))::UBIGINT::HUGEINT AS key FROM documents),
j AS (
  SELECT doc_id, n, key, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j FROM k, sizes
  UNION ALL
  SELECT doc_id, n, nk, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / ((nk // 8589934592)::DOUBLE + 1.0::DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, n, j, ((key % 4294967296) * 2862933555777941757 + (((key // 4294967296) * 2862933555777941757) % 4294967296) * 4294967296 + 1) % 18446744073709551616 AS nk FROM j WHERE j < n)
),
s AS (SELECT doc_id, n, max(b) AS shard FROM j GROUP BY ALL)
SELECT d.doc_id, CAST(x.shard AS INTEGER) AS shard, CAST(y.shard AS INTEGER) AS shard_after, x.shard <> y.shard AS moved
FROM documents d JOIN s x ON x.doc_id IS NOT DISTINCT FROM d.doc_id AND x.n = 64 JOIN s y ON y.doc_id IS NOT DISTINCT FROM d.doc_id AND y.n = 72
"""

ORACLE_SQL["op8_line_dedup"] = r"""
WITH doc AS (SELECT DISTINCT {'a': doc_id IS NULL, 'b': doc_id, 'c': CASE WHEN doc_id IS NULL THEN md5(text) END} AS doc, doc_id, text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc, text, line, pos, lower(trim(regexp_replace(line, '[ \t\r\f\x0B]+', ' ', 'g'))) AS norm
  FROM (SELECT doc, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM doc)),
shared AS (SELECT norm, min(doc) AS home FROM l WHERE norm <> '' GROUP BY norm HAVING count(DISTINCT doc) > 50),
put AS (SELECT doc, text, coalesce(string_agg(CASE WHEN s.norm IS NULL OR s.home = l.doc THEN line END, chr(10) ORDER BY pos), '') AS clean,
    CAST(count(CASE WHEN s.home <> l.doc THEN 1 END) AS INTEGER) AS lines_dropped
  FROM l LEFT JOIN shared s USING (norm) GROUP BY doc, text)
SELECT d.doc_id, p.clean AS text, coalesce(p.lines_dropped, 0) AS lines_dropped
FROM documents d LEFT JOIN put p ON p.text = d.text AND p.doc.b IS NOT DISTINCT FROM d.doc_id
"""

ORACLE_SQL["op9_exact_dedup"] = """
WITH d AS (SELECT doc_id, text, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 16, 1))::UBIGINT % 2 AS INTEGER) AS batch FROM documents),
k AS (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text ORDER BY batch, doc_id NULLS LAST) AS kept_id FROM d)
SELECT doc_id, kept_id, doc_id IS DISTINCT FROM kept_id AS duplicate FROM k
"""

ORACLE_SQL["op10_warc"] = """
WITH p AS (SELECT page_id, regexp_replace(url, '[\\r\\n]', '', 'g') AS url, encode(html) AS body,
    md5(concat(coalesce(CAST(page_id AS VARCHAR), ''), chr(10), coalesce(regexp_replace(url, '[\\r\\n]', '', 'g'), ''), chr(10), md5(coalesce(html, '')))) AS m FROM pages),
c AS (SELECT *, octet_length(body) AS size, unnest(generate_series(0, greatest(octet_length(body) - 1, 0) // 4096)) AS no FROM p)
SELECT page_id, url, concat_ws('-', m[1:8], m[9:12], m[13:16], m[17:20], m[21:32]) AS record_id, CAST(no AS INTEGER) AS chunk_no,
  no * 4096 AS chunk_start, CAST(least(4096, size - no * 4096) AS INTEGER) AS n_bytes, sha256(body[1:least(size, (no + 1) * 4096)]) AS sha256,
  (no + 1) * 4096 >= size AS last, true AS intact, base64(body[no * 4096 + 1:(no + 1) * 4096]) AS payload
FROM c
"""
