"""Adapters: one contract for every kind of stored source body.

A source (source_id, adapter, url, max_candidates) and the body that was fetched for
it become candidates in document order, capped per source, and one result row that
says how it went. One bad body is a row, never a failed job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.fetch import reason_class
from . import readers

CANDIDATE = ("source_id", "adapter", "position", "target_url", "title", "published_at", "summary", "publisher")
def _none():
    return F.lit(None).cast("string")



def _feed(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    x = s.withColumn("_items", readers.feed_entries(F.col("body"), F.col("url")))
    found = x.select("source_id", F.posexplode("_items").alias("position", "_i")).select("source_id", "position", "_i.*")
    return found, x.where(F.col("body").isNotNull() & F.col("_items").isNull()).select("source_id", F.lit("feed_parse_error").alias("reason"))


def _json_api(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``items_path`` and the fields' paths come with each source (column ``mapping``:
    a map with ``items`` and the field names); sources of one mapping go together."""
    maps = [{e["key"]: e["value"] for e in r["m"]} for r in s.select(F.array_sort(F.map_entries("mapping")).alias("m")).distinct().collect()]  # a bounded configuration
    parts, odd = [], []
    for m in maps:
        own = s.where(reduce(lambda a, b: a & b, [F.col("mapping")[k].eqNullSafe(F.lit(v)) for k, v in m.items()]))
        fields = {k: v for k, v in m.items() if k != "items"}
        got = readers.json_items(own.select("source_id", "body"), "body", m.get("items", ""), fields).drop("body")
        parts.append(got.select("source_id", "position", *[F.col(c) if c in fields else _none().alias(c) for c in CANDIDATE[3:]]))
        odd.append(readers.json_problems(own, "source_id", "body", m.get("items", ""), fields).select("source_id", "reason"))
    if not parts:
        empty = s.limit(0)
        return empty.select("source_id", F.lit(0).alias("position"), *[_none().alias(c) for c in CANDIDATE[3:]]), empty.select("source_id", _none().alias("reason"))
    union = lambda a, b: a.unionByName(b)
    return reduce(union, parts), reduce(union, odd)


def _seed(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of an index page under the source's own prefixes (array ``prefixes``), on
    its host; the first ``max_children``. Without a prefix nothing qualifies."""
    own = s.select("source_id", F.col("prefixes").alias("_p"), F.col("max_children").alias("_m"), readers.urls.host(F.col("url")).alias("_h"))
    links = readers.html_links(s, "source_id", "url", "body").join(own, "source_id")
    path = F.when(readers.urls.part(F.col("target_url"), 3) == "", "/").otherwise(readers.urls.part(F.col("target_url"), 3))
    ok = F.exists(F.coalesce("_p", F.array().cast("array<string>")), lambda p: path.startswith(p)) & readers.urls.host(F.col("target_url")).eqNullSafe(F.col("_h"))
    place = F.row_number().over(Window.partitionBy("source_id").orderBy("position")) - 1
    kept = links.where(ok).withColumn("position", place).where(F.col("_m").isNull() | (F.col("position") < F.col("_m")))
    return kept.select("source_id", "position", "target_url", F.col("anchor").alias("title"), *[_none().alias(c) for c in CANDIDATE[5:]]), s.limit(0).select("source_id", _none().alias("reason"))


#: Adapters by name, each with the reason of an empty result.
ADAPTERS: dict[str, tuple[Callable[[DataFrame], tuple[DataFrame, DataFrame]], str]] = {"feed": (_feed, "no_items_in_window"), "json_api": (_json_api, "no_items_in_window"), "seed": (_seed, "no_links_matched_allowlist")}


def adapter(name: str):
    """An adapter by name; one that isn't there raises, it is never skipped."""
    if name not in ADAPTERS:
        raise ValueError(f"no adapter {name!r}; there are {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name]


def discover(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, results) of sources (source_id, adapter, url, body, fetch_reason,
    max_candidates, mapping, prefixes, max_children).

    Candidates are stamped with source, adapter and position and capped in document
    order. A result (source_id, adapter, result, reason, candidates,
    dropped_over_cap) is ok, zero_result, or the class of what went wrong: of the
    fetch (``fetch_reason``) or of the parsing."""
    kinds = [r["adapter"] for r in sources.select("adapter").distinct().collect()]
    for k in kinds:
        adapter(k)
    found, odd = [], []
    for k in kinds:
        c, o = adapter(k)[0](sources.where((F.col("adapter") == k) & F.col("fetch_reason").isNull()))
        found.append(c.select("source_id", F.lit(k).alias("adapter"), *CANDIDATE[2:]))
        odd.append(o)
    if not found:
        raise ValueError("no sources")
    union = lambda a, b: a.unionByName(b)
    cap = sources.select("source_id", "max_candidates")
    every = reduce(union, found).join(cap, "source_id")
    candidates = every.where(F.col("max_candidates").isNull() | (F.col("position") < F.col("max_candidates"))).select(*CANDIDATE)
    n = every.groupBy("source_id").agg(F.count("*").alias("_n"))
    empty = F.lit(None).cast("string")
    for k in kinds:
        empty = F.when(F.col("adapter") == k, F.lit(adapter(k)[1])).otherwise(empty)
    count = F.coalesce("_n", F.lit(0).cast("long"))
    x = sources.select("source_id", "adapter", "fetch_reason", "max_candidates").join(n, "source_id", "left").join(reduce(union, odd).withColumnRenamed("reason", "_odd"), "source_id", "left")
    reason = F.coalesce("fetch_reason", "_odd", F.when(count == 0, empty))
    kept = F.least(count, F.coalesce(F.col("max_candidates").cast("long"), count))
    return candidates, x.select("source_id", "adapter", F.coalesce(reason_class(reason), F.when(count == 0, "zero_result").otherwise("ok")).alias("result"), reason.alias("reason"), kept.alias("candidates"), (count - kept).alias("dropped_over_cap"))


def stored_bodies(spark, path: str) -> DataFrame:
    """Fixtures below ``path`` (JSON files with url, status, body or body_b64) as
    (file, fixture_id, source_id, url, status, body, problem): an address that two of
    them claim, or that has both bodies or none, is a problem."""
    form = "fixture_id string, source_id string, url string, status int, body string, body_b64 string"
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True).select(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file"), F.from_json("value", form).alias("f"))
    x = raw.select("file", "f.*")
    n = x.where("url is not null").groupBy("url").agg(F.count("*").alias("_n"))
    both = F.col("body").isNotNull() == F.col("body_b64").isNotNull()
    problem = F.when(F.col("url").isNull(), "no_url").when(F.col("_n") > 1, "url_claimed_twice").when(both, "one_body_needed")
    return x.join(n, "url", "left").select("file", "fixture_id", "source_id", "url", "status", F.coalesce("body", F.decode(F.unbase64("body_b64"), "UTF-8")).alias("body"), problem.alias("problem"))
