"""Validators as queries: each gives (subject, path, message) of what is wrong, in a
form that can be united and counted; an empty report means that all is well."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning, urls

REPORT = ("subject", "path", "message")


def report(rows: DataFrame, subject: Column, checks: Sequence[tuple[str | Column, str | Column, Column]]) -> DataFrame:
    """A row for each check (path, message, holds) that fails; a check that can't be
    decided fails."""
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.struct(text(p).alias("path"), text(m).alias("message"))) for p, m, ok in checks]
    return rows.select(subject.cast("string").alias("subject"), F.explode(F.array_compact(F.array(*broken))).alias("b")).select("subject", "b.path", "b.message")


def united(*reports: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)


# -- documents against a schema


#: JSON Schema keywords that are understood.
_KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",), "null": ("VOID",)}


def schema_checks(schema: Mapping, value: Column, path: str = "$") -> list[tuple[str, str, Column]]:
    """Checks of a variant against a JSON schema: type, required, properties,
    additionalProperties false, enum, const, pattern, lengths, bounds, items (type and
    enum of the elements). Absent properties pass unless they are required."""
    out: list[tuple[str, str, Column]] = []
    kind = F.schema_of_variant(value)
    absent = value.isNull()
    holds = lambda c: absent | F.coalesce(c, F.lit(False))
    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])
        out.append((path, f"is not {' or '.join(kinds)}", holds(_kind(kind, kinds))))
        if "null" in kinds:
            holds = lambda c: absent | (kind == "VOID") | F.coalesce(c, F.lit(False))
    text = F.try_variant_get(value, "$", "string")
    if "enum" in schema:
        out.append((path, "is none of the values", holds(text.isin(*[str(v) for v in schema["enum"] if v is not None]))))
    if "const" in schema:
        out.append((path, f"is not {schema['const']}", holds(text == str(schema["const"]))))
    if "pattern" in schema:
        out.append((path, "doesn't fit its pattern", holds(text.rlike(schema["pattern"]))))
    if "minLength" in schema:
        out.append((path, "is too short", holds(F.char_length(text) >= schema["minLength"])))
    if "maxLength" in schema:
        out.append((path, "is too long", holds(F.char_length(text) <= schema["maxLength"])))
    number = F.try_variant_get(value, "$", "double")
    if "minimum" in schema:
        out.append((path, f"is below {schema['minimum']}", holds(number >= schema["minimum"])))
    if "maximum" in schema:
        out.append((path, f"is above {schema['maximum']}", holds(number <= schema["maximum"])))
    for name in schema.get("required", ()):
        there = F.try_variant_get(value, f"$['{name}']", "variant").isNotNull()
        out.append((f"{path}.{name}", "is missing", absent | ~kind.startswith("OBJECT") | there))
    props = schema.get("properties", {})
    for name, sub in props.items():
        out += schema_checks(sub, F.try_variant_get(value, f"$['{name}']", "variant"), f"{path}.{name}")
    if schema.get("additionalProperties") is False:
        names = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        odd = F.array_except(names, F.array(*[F.lit(n) for n in props]).cast("array<string>"))
        out.append((path, "has unknown members", absent | ~kind.startswith("OBJECT") | F.coalesce(F.size(odd) == 0, F.lit(True))))
    if "items" in schema:
        each = F.try_variant_get(value, "$", "array<variant>")
        item = schema["items"]
        ok = lambda v: reduce(Column.__and__, [c for _, _, c in schema_checks(item, v)], F.lit(True))
        out.append((f"{path}[*]", "has an invalid element", absent | ~kind.startswith("ARRAY") | F.coalesce(F.forall(each, ok), F.lit(True))))
    if schema.get("uniqueItems"):
        each = F.try_variant_get(value, "$", "array<string>")
        out.append((path, "repeats an element", absent | ~kind.startswith("ARRAY") | F.coalesce(F.size(F.array_distinct(each)) == F.size(each), F.lit(True))))
    return out


def _kind(kind: Column, kinds: Sequence[str]) -> Column:
    ok = F.lit(False)
    for k in kinds:
        for prefix in _KINDS[k]:
            ok = ok | kind.startswith(prefix)
    return ok


def against_schema(rows: DataFrame, subject: Column, document: Column, schema: Mapping) -> DataFrame:
    """The report of JSON texts against a schema."""
    doc = F.try_parse_json(document)
    x = rows.select(subject.alias("_s"), doc.alias("_d"))
    return report(x, F.col("_s"), [("$", "is not JSON", F.col("_d").isNotNull()), *schema_checks(schema, F.col("_d"))])


def generated_schema(base: Mapping, enums: Mapping[str, Sequence[str]]) -> dict:
    """``base`` with the values of vocabularies put in where it says
    ``{"$vocabulary": name}``: sorted, so that equal vocabularies give equal bytes."""

    def fill(x):
        if isinstance(x, Mapping):
            if set(x) == {"$vocabulary"}:
                return {"type": "string", "enum": sorted(set(enums[x["$vocabulary"]]))}
            return {k: fill(v) for k, v in x.items()}
        return [fill(v) for v in x] if isinstance(x, list) else x

    return fill(dict(base))


def schema_drift(committed: bytes, base: Mapping, enums: Mapping[str, Sequence[str]]) -> str | None:
    """Why a committed schema isn't the generated one: not there, other bytes; null
    if it is."""
    from ..sinks.publish import serialized

    want = serialized(generated_schema(base, enums))
    if committed == want:
        return None
    try:
        return "order or layout differs" if json.loads(committed) == json.loads(want) else "content differs"
    except ValueError:
        return "not JSON"


# -- configuration


def config_problems(topics: DataFrame, approved: Sequence[str]) -> DataFrame:
    """Topic files (see ``config.TOPIC``; ``file`` names each): slugs that aren't the
    names', sources without a required field, under another cell, with an address
    that isn't absolute, names given twice, an index without an allowlist
    (``seed_prefixes``), and cells that are missing, repeated or not approved."""
    spark = topics.sparkSession
    t = topics.withColumn("_slug", cleaning.slug(F.col("topic")))
    c = topics.select("file", "topic_slug", F.explode("categories").alias("c")).select("file", "topic_slug", "c.*")
    s = c.select("file", F.col("topic_slug").alias("_t"), F.col("category_slug").alias("_c"), F.explode("sources").alias("s")).select("file", "_t", "_c", "s.*")
    filled = lambda n: F.coalesce(F.trim(F.col(n).cast("string")), F.lit("")) != ""
    subject = F.coalesce(F.col("source_id"), F.lit("?"))
    required = ["source_id", "topic_slug", "category_slug", "adapter", "url", "role", "max_candidates", "max_requests", "fixture_id"]
    checks = [(n, "is missing", filled(n)) for n in required]
    checks += [("topic_slug", "is not its file's", F.col("topic_slug").eqNullSafe(F.col("_t"))), ("category_slug", "is not its category's", F.col("category_slug").eqNullSafe(F.col("_c"))), ("url", "is not absolute", F.col("url").rlike("^https?://"))]
    if "seed_prefixes" in s.columns:
        checks.append(("seed_prefixes", "is empty, so nothing qualifies", (F.col("adapter") != "seed") | (F.size("seed_prefixes") > 0)))

    def twice(rows: DataFrame, column: str, what: str) -> DataFrame:
        n = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")).where("_n > 1")
        return n.select(F.col(column).cast("string").alias("subject"), F.lit(column).alias("path"), F.lit(what).alias("message"))

    cell = c.select(F.concat_ws("__", "topic_slug", "category_slug").alias("cell_id"))
    want = spark.createDataFrame([(a,) for a in approved], "cell_id string")
    lone = lambda a, b, m: a.distinct().join(b.distinct(), "cell_id", "left_anti").select(F.col("cell_id").alias("subject"), F.lit("cell_id").alias("path"), F.lit(m).alias("message"))
    return united(
        report(t, F.col("file"), [("topic_slug", "is not the topic's slug", F.col("_slug") == F.col("topic_slug"))]),
        report(c, F.concat_ws("/", "file", "category"), [("category_slug", "is not the category's slug", cleaning.slug(F.col("category")) == F.col("category_slug"))]),
        report(s, subject, checks),
        twice(s, "source_id", "is given twice"),
        twice(s, "fixture_id", "is given twice"),
        twice(cell, "cell_id", "is configured twice"),
        lone(want, cell, "is approved and missing"),
        lone(cell, want, "is not approved"),
    )


def vocabulary_problems(entries: DataFrame, sentinel: str, totals: Mapping[str, int], tiers: Mapping[str, Mapping[str, int]], forbidden: Sequence[str] = (), record_only: Sequence[str] = ()) -> DataFrame:
    """Vocabulary entries (axis, slug, coverage_policy, status, replaced_by): names
    that aren't slugs or stand twice, forbidden ones, deprecations without a
    successor and the reverse, axes that share more than the sentinel or lack it, and
    totals or tiers other than approved."""
    spark = entries.sparkSession
    e = entries.withColumn("_slug", cleaning.slug(F.col("slug")))
    one = report(
        e,
        F.concat_ws("/", "axis", "slug"),
        [
            ("slug", "is not a slug", F.col("_slug") == F.col("slug")),
            ("slug", "is forbidden", ~F.col("slug").isin(*forbidden) if forbidden else F.lit(True)),
            ("replaced_by", "is missing for a deprecated entry", (F.col("status") != "deprecated") | F.col("replaced_by").isNotNull()),
            ("replaced_by", "stands at an active entry", (F.col("status") != "active") | F.col("replaced_by").isNull()),
            ("coverage_policy", "must be record_only", ~F.col("slug").isin(*record_only) | (F.col("coverage_policy") == "record_only") if record_only else F.lit(True)),
        ],
    )
    row = lambda d, s, p, m: d.select(s.cast("string").alias("subject"), F.lit(p).alias("path"), F.lit(m).alias("message"))
    twice = row(entries.groupBy("axis", "slug").agg(F.count("*").alias("n")).where("n > 1"), F.concat_ws("/", "axis", "slug"), "slug", "stands twice")
    shared = row(entries.where(F.col("slug") != sentinel).groupBy("slug").agg(F.count_distinct("axis").alias("n")).where("n > 1"), F.col("slug"), "slug", "belongs to several axes")
    axes = spark.createDataFrame([(a, n) for a, n in totals.items()], "axis string, want long")
    have = entries.groupBy("axis").agg(F.count("*").alias("have"), F.bool_or(F.col("slug") == sentinel).alias("sentinel"))
    per = report(axes.join(have, "axis", "left"), F.col("axis"), [("entries", "aren't as many as approved", F.col("have") == F.col("want")), ("entries", "lack the sentinel", F.col("sentinel"))])
    split = spark.createDataFrame([(a, t, n) for a, own in tiers.items() for t, n in own.items()], "axis string, coverage_policy string, want long")
    active = entries.where("status = 'active'").groupBy("axis", "coverage_policy").agg(F.count("*").alias("have"))
    joined = split.join(active, ["axis", "coverage_policy"], "full_outer")
    tier = report(joined, F.concat_ws("/", "axis", "coverage_policy"), [("coverage_policy", "isn't split as approved", F.coalesce("want", F.lit(0)) == F.coalesce("have", F.lit(0)))])
    return united(one, twice, shared, per, tier)


def target_problems(spark: SparkSession, targets: Mapping, entries: DataFrame, never: Sequence[str]) -> DataFrame:
    """Coverage targets {tiers, overrides, scheduler}: tiers without a minimum, a
    record-only minimum that isn't 0, overrides of unknown entries or that raise a
    record-only one, and sentinels that a lane could be planned for."""
    rows = [("tiers", t, "has no minimum") for t in ("priority", "standard", "record_only") if t not in targets.get("tiers", {})]
    if targets.get("tiers", {}).get("record_only", 0) != 0:
        rows.append(("tiers", "record_only", "must be 0"))
    listed = set(targets.get("scheduler", {}).get("never_schedule_gap_lane_for", ()))
    rows += [("scheduler", n, "must never be planned for") for n in never if n not in listed]
    fixed = spark.createDataFrame([(s, p, m) for p, s, m in rows], "subject string, path string, message string")
    over = spark.createDataFrame([(k, int(v)) for k, v in targets.get("overrides", {}).items()], "slug string, target long")
    tier = entries.groupBy("slug").agg(F.min("coverage_policy").alias("policy"))
    x = over.join(tier, "slug", "left")
    return fixed.unionByName(report(x, F.col("slug"), [("overrides", "is no entry", F.col("policy").isNotNull()), ("overrides", "raises a record-only entry", F.col("policy").isNull() | (F.col("policy") != "record_only") | (F.col("target") <= 0))]))


def legacy_map_problems(legacy: DataFrame, entries: DataFrame, sentinel: str) -> DataFrame:
    """Reviewed legacy values (legacy_value, industry): keys that aren't in folded
    form, keys that stand twice, values that are no industry or the sentinel."""
    known = entries.where("axis = 'industry'").select(F.col("slug").alias("industry"), F.lit(True).alias("_known")).distinct()
    x = legacy.withColumn("_key", cleaning.folded(F.col("legacy_value"))).join(known, "industry", "left")
    one = report(x, F.col("legacy_value"), [("legacy_value", "is not in its folded form", F.col("_key") == F.col("legacy_value")), ("industry", "is no industry", F.col("_known")), ("industry", "is the sentinel", F.col("industry") != sentinel)])
    twice = x.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("_key").alias("subject"), F.lit("legacy_value").alias("path"), F.lit("stands twice").alias("message"))
    return one.unionByName(twice)


# -- records


def record_facet_problems(records: DataFrame, live: DataFrame, known: DataFrame, versions: str, forbidden_topics: Sequence[str], gated_cells: Sequence[tuple[str, str]], forbidden_fields: Sequence[str] = ("publisher",)) -> DataFrame:
    """What a schema can't say of the facets of records (record_id, record_type, topic,
    category, facets struct of versions, state, asserted array of (axis, slug, role,
    evidence array of (field, term, quote)) and unresolved array of (axis, state,
    term); legacy_unmapped: the unmapped legacy value, if the record has one).

    Pointers and forbidden topics have no facets, gated cells must. An unmapped legacy
    value must be told, and is evidence for nothing. Each asserted value is a known
    slug, a live one, with evidence that mentions it where support is required
    (secondary values), and no industry rests on a forbidden field. The state is what
    the values make it, and an unresolved one says why."""
    has = F.col("facets").isNotNull()
    full = F.col("record_type") == "full"
    gated = F.lit(False)
    for t, c in gated_cells:
        gated = gated | ((F.col("topic") == t) & (F.col("category") == c))
    forbidden = F.col("topic").isin(*forbidden_topics)
    told = F.exists(F.coalesce("facets.unresolved", F.array().cast(records.schema["facets"].dataType["unresolved"].dataType)), lambda u: u["state"] == "unmapped_legacy_value")
    first = report(
        records,
        F.col("record_id"),
        [
            ("facets", "stand at a pointer", full | ~has),
            ("facets", "stand at a topic that may have none", ~full | ~forbidden | ~has),
            ("facets", "are missing at a gated cell", ~full | ~gated | has),
            ("facets.unresolved", "doesn't tell the unmapped legacy value", ~full | F.col("legacy_unmapped").isNull() | told),
        ],
    )
    own = records.where(full & has & ~forbidden)
    industry = F.exists("facets.asserted", lambda a: (a["axis"] == "industry") & (a["role"] == "primary") & (a["slug"] != "other-unclear"))
    other = F.exists("facets.asserted", lambda a: a["axis"].isin("function", "use_case") & (a["slug"] != "other-unclear"))
    computed = F.when(industry & other, "resolved").otherwise("unresolved")
    second = report(
        own,
        F.col("record_id"),
        [
            ("facets.versions", "aren't the loaded vocabularies'", F.col("facets.versions") == versions),
            ("facets.state", "isn't what the values make it", F.col("facets.state") == computed),
            ("facets.unresolved", "is empty for an unresolved record", (F.col("facets.state") != "unresolved") | (F.size("facets.unresolved") > 0)),
        ],
    )
    unmapped = F.transform(F.filter("facets.unresolved", lambda u: u["state"] == "unmapped_legacy_value"), lambda u: F.lower(u["term"]))
    a = own.select("record_id", unmapped.alias("_un"), F.explode("facets.asserted").alias("a")).select("record_id", "_un", "a.*")
    a = a.join(known.select("axis", "slug", F.lit(True).alias("_known")).distinct(), ["axis", "slug"], "left").join(live.select("axis", "slug", F.lit(True).alias("_live")).distinct(), ["axis", "slug"], "left")
    mentioned = F.exists("evidence", lambda e: F.contains(F.lower(e["quote"]), F.lower(e["term"])))
    third = report(
        a,
        F.col("record_id"),
        [
            (F.concat_ws("/", "axis", "slug"), "is no known value", F.col("_known")),
            (F.concat_ws("/", "axis", "slug"), "is deprecated", F.col("_known").isNull() | F.col("_live")),
            (F.concat_ws("/", "axis", "slug"), "has no evidence", F.size("evidence") > 0),
            (F.concat_ws("/", "axis", "slug"), "rests on a field that grounds no industry", (F.col("axis") != "industry") | ~F.exists("evidence", lambda e: e["field"].isin(*forbidden_fields))),
            (F.concat_ws("/", "axis", "slug"), "isn't mentioned in its evidence", (F.col("role") != "secondary") | (F.size("evidence") == 0) | mentioned),
            (F.concat_ws("/", "axis", "slug"), "rests on an unmapped legacy value", ~F.exists("evidence", lambda e: F.coalesce(F.array_contains("_un", F.lower(e["term"])), F.lit(False)))),
        ],
    )
    return united(first, second, third)


# -- runs and fixtures


def run_problems(records: DataFrame, cells: DataFrame, sightings: DataFrame, documents: DataFrame, expected: DataFrame, run: str) -> DataFrame:
    """A finished run: documents missing or unexpected, records of another run or in a
    cell that isn't theirs, identifiers that stand twice in a topic, identities that
    don't belong to their identifier, stated counts (cells: cell_id, total_records)
    that aren't the rows', and sightings (cell_id, observations, unique_candidates,
    repeats) that don't add up."""
    lone = lambda a, b, m: a.select("name").distinct().join(b.select("name").distinct(), "name", "left_anti").select(F.col("name").alias("subject"), F.lit("documents").alias("path"), F.lit(m).alias("message"))
    n = records.groupBy("cell_id").agg(F.count("*").alias("_have"))
    stated = cells.join(n, "cell_id", "full_outer")
    ids = records.where("record_type = 'full'").groupBy("topic", "record_id").agg(F.count("*").alias("n")).where("n > 1")
    return united(
        lone(expected, documents, "is missing"),
        lone(documents, expected, "is unexpected"),
        report(
            records,
            F.col("record_id"),
            [
                ("harvest_run_id", "is of another run", F.col("harvest_run_id") == run),
                ("cell_id", "isn't the record's cell", F.col("cell_id") == F.concat_ws("__", "topic", "category")),
                ("record_id", "doesn't follow from topic and identity", F.col("record_id") == urls.record_id(F.col("topic"), F.col("identity_url"))),
            ],
        ),
        ids.select(F.col("record_id").alias("subject"), F.lit("record_id").alias("path"), F.lit("stands twice in its topic").alias("message")),
        report(stated, F.col("cell_id"), [("total_records", "isn't the number of records", F.coalesce("total_records", F.lit(-1)) == F.coalesce("_have", F.lit(0)))]),
        report(sightings, F.col("cell_id"), [("observations", "aren't unique ones and repeats together", F.col("observations") == F.col("unique_candidates") + F.col("repeats"))]),
    )


def fixture_problems(fixtures: DataFrame, sources: DataFrame, manifest: DataFrame, files: DataFrame, robots: DataFrame) -> DataFrame:
    """Stored bodies for tests: fixtures (file, fixture_id, source_id, url, body,
    provenance, captured_at, authored_at) against configured sources (source_id,
    fixture_id, url), robots (host), and the manifest against the files (file, bytes,
    sha256)."""
    s = sources.select(F.col("fixture_id"), F.col("source_id").alias("_source"), F.col("url").alias("_url"))
    f = fixtures.join(s, "fixture_id", "left")
    row = lambda d, c, p, m: d.select(F.col(c).cast("string").alias("subject"), F.lit(p).alias("path"), F.lit(m).alias("message"))
    twice = lambda d, c: d.groupBy(c).agg(F.count("*").alias("n")).where(f"n > 1 AND {c} IS NOT NULL")
    hosts = sources.select(urls.host(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    m = manifest.select("file", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"))
    listed = files.join(m, "file", "full_outer")
    synthetic = F.col("provenance") == "synthetic"
    return united(
        report(
            f,
            F.col("file"),
            [
                ("fixture_id", "matches no configured source", F.col("_source").isNotNull()),
                ("source_id", "isn't the configured one", F.col("_source").isNull() | (F.col("source_id") == F.col("_source"))),
                ("url", "isn't the configured one", F.col("_source").isNull() | (F.col("url") == F.col("_url"))),
                ("body", "is empty", F.coalesce(F.char_length("body"), F.lit(0)) > 0),
                ("provenance", "is neither synthetic nor recorded", F.col("provenance").isin("synthetic", "recorded")),
                ("captured_at", "doesn't fit its provenance", F.when(synthetic, F.col("captured_at").isNull() & F.col("authored_at").isNotNull()).when(F.col("provenance") == "recorded", F.col("captured_at").isNotNull()).otherwise(True)),
            ],
        ),
        row(twice(fixtures, "fixture_id"), "fixture_id", "fixture_id", "stands twice"),
        row(twice(sources, "fixture_id"), "fixture_id", "fixture_id", "is claimed by several sources"),
        row(sources.join(fixtures.select("fixture_id").distinct(), "fixture_id", "left_anti"), "source_id", "fixture_id", "has no fixture"),
        row(hosts.join(robots.select("host").distinct(), "host", "left_anti"), "host", "robots", "has no robots fixture"),
        report(
            listed,
            F.col("file"),
            [
                ("manifest", "is listed but not there", F.col("sha256").isNotNull()),
                ("manifest", "is there but not listed", F.col("_sha").isNotNull()),
                ("manifest", "has other bytes", F.col("sha256").isNull() | F.col("_sha").isNull() | ((F.col("sha256") == F.col("_sha")) & (F.col("bytes") == F.col("_bytes")))),
                ("manifest", "escapes the tree", ~F.col("file").rlike(r"^[/\\]|(^|/)\.\.(/|$)")),
            ],
        ),
    )


def field_problems(spark: SparkSession, have: Sequence[str], required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Fields of a registry that are required and absent, or that nobody knows."""
    rows = [(c, "fields", "is missing") for c in sorted(set(required) - set(have))] + [(c, "fields", "is unknown") for c in sorted(set(have) - set(required) - set(optional))]
    return spark.createDataFrame(rows, "subject string, path string, message string")


def is_absolute_http(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(?i:https?)://[^/?#\s]+"), F.lit(False))


def counted(rows: DataFrame, by: str) -> DataFrame:
    """(value, n) of a column, null among the values; a sink sorts by value."""
    return rows.groupBy(F.col(by).cast("string").alias("value")).agg(F.count("*").alias("n"))


def canonical_row(columns: Sequence[str]) -> Column:
    """A row as JSON with its fields in order of their names, null ones among them."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


# -- lookups that refuse


def looked_up(items: DataFrame, table: DataFrame, key: str, what: str) -> DataFrame:
    """``items`` joined with ``table`` on ``key``, which must have exactly one row for
    each of their keys: an item must not get lost, nor become several. The check is a
    job of its own over the keys."""
    keys = table.groupBy(key).agg(F.count("*").alias("_n"))
    bad = items.select(key).distinct().join(keys, key, "left").where(F.col("_n").isNull() | (F.col("_n") > 1)).select(key, "_n").limit(5).collect()
    if bad:
        raise ValueError(f"{what}: " + ", ".join(f"{r[key]!r} {'is missing' if r['_n'] is None else 'stands ' + str(r['_n']) + ' times'}" for r in bad))
    return items.join(table, key)


def lookup_problems(items: DataFrame, table: DataFrame, key: str, what: str) -> DataFrame:
    """The same as a report over all keys, for data too wrong to raise about."""
    keys = table.groupBy(key).agg(F.count("*").alias("_n"))
    x = items.select(key).distinct().join(keys, key, "left")
    return report(x, F.col(key), [(what, "is missing", F.col("_n").isNotNull()), (what, "stands several times", F.coalesce("_n", F.lit(1)) == 1)])
