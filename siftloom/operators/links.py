"""Rules about links: robots, redirects, access status and address aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls


def robots_regex(pattern: Column) -> Column:
    """A robots path pattern as an anchored regular expression: ``*`` is anything, a
    final ``$`` the end."""
    quoted = F.regexp_replace(F.regexp_replace(pattern, r"\$$", ""), r"([\\.\[\]{}()+?^$|])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(quoted, F.lit("*"), F.lit(".*")), F.when(pattern.endswith("$"), F.lit("$")).otherwise(F.lit("")))


def robots_allowed(pages: DataFrame, url: str, rules: DataFrame, agent: str) -> DataFrame:
    """``pages`` with ``allowed``: by the rules (host, agent, pattern, allow) of the
    group whose name is the longest part of the agent's, else of ``*``; the longest
    pattern that matches decides and Allow wins ties. No rule, no objection. Empty
    patterns say nothing."""
    mine = F.when(F.col("agent") == "*", 0).when(F.lit(agent.lower()).contains(F.lower("agent")), F.length("agent")).otherwise(-1)
    r = rules.withColumn("_m", mine).where("_m >= 0")
    best = r.groupBy("host").agg(F.max("_m").alias("_b"))
    r = r.join(best, "host").where("_m = _b").where(F.col("pattern") != "").select("host", F.length("pattern").alias("len"), robots_regex(F.col("pattern")).alias("rx"), "allow")
    groups = r.groupBy("host").agg(F.collect_set(F.struct("len", "allow", "rx")).alias("_rules"))
    path = F.concat(F.when(urls.part(F.col(url), 3) == "", "/").otherwise(urls.part(F.col(url), 3)), F.coalesce(urls.part(F.col(url), 4), F.lit("")))
    hit = F.array_max(F.transform(F.filter("_rules", lambda x: F.rlike(F.col("_path"), x["rx"])), lambda x: F.struct(x["len"].alias("len"), x["allow"].alias("allow"))))
    return (
        pages.withColumns({"_host": urls.host(F.col(url)), "_path": path})
        .join(groups.withColumnRenamed("host", "_host"), "_host", "left")
        .withColumn("allowed", F.coalesce(hit["allow"], F.lit(True)))
        .drop("_host", "_path", "_rules")
    )


def robots_fallback(status: Column) -> Column:
    """Without a readable file: a client error allows all, anything else nothing."""
    return F.when((status >= 400) & (status < 500), True).when(status.between(200, 299), F.lit(None).cast("boolean")).otherwise(False)


def redirect_facts(hops: DataFrame, most: int = 3) -> DataFrame:
    """(url, final_url, hops, permanent, loop, too_long) for each address that
    redirects, from edges (url, target, status). Chains are followed ``most`` + 1
    steps, each a join; permanent means that all hops are 301 or 308."""
    edges = hops.select(F.col("url").alias("_at"), F.col("target").alias("_to"), F.col("status").isin(301, 308).alias("_p"))
    state = hops.select("url", F.col("target").alias("final_url"), F.lit(1).alias("hops"), F.col("status").isin(301, 308).alias("permanent"), F.array("url", "target").alias("_seen"), (F.col("url") == F.col("target")).alias("loop"))
    for _ in range(most):
        j = state.join(edges, (F.col("final_url") == F.col("_at")) & ~F.col("loop"), "left")
        go = F.col("_to").isNotNull()
        state = j.select(
            "url",
            F.when(go, F.col("_to")).otherwise(F.col("final_url")).alias("final_url"),
            (F.col("hops") + go.cast("int")).alias("hops"),
            (F.col("permanent") & F.coalesce("_p", F.lit(True))).alias("permanent"),
            F.when(go, F.array_append("_seen", F.col("_to"))).otherwise(F.col("_seen")).alias("_seen"),
            (F.col("loop") | F.coalesce(F.array_contains("_seen", F.col("_to")), F.lit(False))).alias("loop"),
        )
    return state.select("url", "final_url", "hops", "permanent", "loop", (F.col("hops") > most).alias("too_long"))


#: Failure type -> (reason, class, access status). A client error's access status
#: follows from its HTTP status.
FAILURES = {
    "robots_denied": ("robots_denied", "infrastructure_error", "robots_denied"),
    "http_timeout": ("http_timeout", "infrastructure_error", "timeout"),
    "dns_failure": ("dns_failure", "infrastructure_error", "unreachable"),
    "http_4xx": ("http_4xx", "infrastructure_error", None),
    "http_5xx": ("http_5xx", "infrastructure_error", "server_error"),
    "lease_timeout": ("lease_timeout", "infrastructure_error", "unreachable"),
    "response_too_large": ("response_too_large", "adapter_error", "unreachable"),
    "unexpected_content_type": ("unexpected_content_type", "adapter_error", "unreachable"),
    "empty_response": ("empty_response", "adapter_error", "unreachable"),
    "http_error": ("http_5xx", "infrastructure_error", "unreachable"),
    "budget_exhausted": ("budget_exhausted", "infrastructure_error", "not_checked"),
    "internal_fetch_error": ("adapter_error", "adapter_error", "unreachable"),
}
CLIENT_STATUS = {401: "auth_required", 402: "paywalled", 403: "auth_required", 404: "not_found", 410: "gone"}


def _looked_up(key: Column, table: dict, default: str | None) -> Column:
    out = F.lit(default).cast("string")
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return F.when(key.isNotNull(), out)


def access_status(status: Column, error: Column, permanent: Column | None = None) -> Column:
    """What a fetch says about a page: a success is ``ok``, or ``redirected`` where
    the whole chain was permanent; a failure says it by its type, a client error by
    its status. Nothing fetched is ``not_checked``; an unknown type has no status, so
    that it is noticed rather than given a plausible one."""
    client = _looked_up(status, CLIENT_STATUS, "unreachable")
    kind = _looked_up(error, {k: v[2] for k, v in FAILURES.items() if v[2]}, None)
    moved = F.coalesce(permanent, F.lit(False)) if permanent is not None else F.lit(False)
    return (
        F.when(error == "http_4xx", F.coalesce(client, F.lit("unreachable")))
        .when(error.isNotNull(), kind)
        .when(status.isNull(), "not_checked")
        .when(status.between(200, 299) | (status == 304), F.when(moved, "redirected").otherwise("ok"))
        .when(status.between(400, 499), client)
        .when(status >= 500, "server_error")
        .otherwise("unreachable")
    )


def retry_delay(attempt: Column, base: float, multiplier: float, jitter: Column, retry_after: Column) -> Column:
    """Seconds before the next attempt: exponential with jitter in [-1, 1] shares,
    never less than the server asks for."""
    return F.greatest(F.lit(base) * F.pow(F.lit(multiplier), attempt - 1) * (1 + jitter), F.coalesce(retry_after, F.lit(0.0)))


def alias_decision(rows: DataFrame, migrations: DataFrame | None = None) -> DataFrame:
    """``rows`` (identity_url, final_url, permanent_redirect, canonical_tags array,
    robots_allowed) with canonical_url, alias_kind and conflict.

    A permanent redirect moves the address and leaves an alias; a temporary one does
    nothing. Then the page's canonical links: none or the address itself does
    nothing; several, a blank one or one that can't be used is a conflict; one that
    points back to where a redirect came from is circular. On the same registrable
    host it needs robots' consent, across hosts a migration rule (from_host, to_host).
    """
    moved = F.coalesce(F.col("permanent_redirect"), F.lit(False)) & F.col("final_url").isNotNull() & (F.col("final_url") != F.col("identity_url"))
    here = F.when(moved, F.col("final_url")).otherwise(F.col("identity_url"))
    tags = F.array_distinct(F.transform(F.coalesce("canonical_tags", F.array().cast("array<string>")), lambda t: F.coalesce(urls.canonical(t), F.lit(""))))
    x = rows.withColumns({"_moved": moved, "_here": here, "_tags": tags})
    x = x.withColumn("_tag", F.get("_tags", F.lit(0)))
    x = x.withColumns({"_from": urls.registrable(urls.host(F.col("_here"))), "_into": urls.registrable(urls.host(F.col("_tag")))})
    if migrations is not None:
        known = migrations.select(F.col("from_host").alias("_from"), F.col("to_host").alias("_into"), F.lit(True).alias("_rule")).distinct()
        x = x.join(known, ["_from", "_into"], "left")
    else:
        x = x.withColumn("_rule", F.lit(None).cast("boolean"))
    none = (F.size("_tags") == 0) | ((F.size("_tags") == 1) & (F.col("_tag") == F.col("_here")))
    same = F.col("_from") == F.col("_into")
    conflict = (
        F.when(none, F.lit(None).cast("string"))
        .when(F.array_contains("_tags", ""), "canonical_unusable")
        .when(F.size("_tags") > 1, "canonical_conflicting")
        .when(F.col("_moved") & (F.col("_tag") == F.col("identity_url")), "canonical_circular")
        .when(same & ~F.coalesce(F.col("robots_allowed"), F.lit(False)), "canonical_not_permitted")
        .when(~same & F.col("_rule").isNull(), "canonical_cross_host")
    )
    tagged = ~none & F.col("conflict").isNull()
    x = x.withColumn("conflict", conflict)
    return x.withColumns(
        {"canonical_url": F.when(tagged, F.col("_tag")).otherwise(F.col("_here")), "alias_kind": F.when(tagged, "rel_canonical").when(F.col("_moved"), "permanent_redirect")}
    ).drop("_moved", "_here", "_tags", "_tag", "_from", "_into", "_rule")


def equivalent(a: Column, b: Column) -> Column:
    """Whether two addresses are one under the canonical form; unusable ones never are."""
    return F.coalesce(urls.canonical(a) == urls.canonical(b), F.lit(False))


def same_site(a: Column, b: Column) -> Column:
    return F.coalesce(urls.registrable(urls.host(a)) == urls.registrable(urls.host(b)), F.lit(False))


def check_run(records: DataFrame, sample: DataFrame, fetches: DataFrame, checked_at: str) -> DataFrame:
    """``records`` after a link check: those whose identity is in the sample get one
    more entry in ``link_history`` (checked_at, access_status, content_hash,
    changed_materially) and the new status; the others stay. Each identity was fetched
    once, whatever number of records has it; without a fetch it is not checked."""
    one = fetches.groupBy("identity_url").agg(F.min(F.struct("access_status", "content_hash")).alias("_f"))
    taken = sample.select("identity_url", F.lit(True).alias("_in")).distinct()
    x = records.join(taken, "identity_url", "left").join(one, "identity_url", "left")
    status = F.coalesce("_f.access_status", F.lit("not_checked"))
    changed = F.coalesce(F.col("content_hash") != F.col("_f.content_hash"), F.lit(False))
    entry = F.struct(F.lit(checked_at).alias("checked_at"), status.alias("access_status"), F.col("_f.content_hash").alias("content_hash"), changed.alias("changed_materially"))
    history = F.when(F.col("_in"), F.array_append("link_history", entry)).otherwise(F.col("link_history"))
    on = F.coalesce("_in", F.lit(False))
    out = {"link_history": history, "access_status": F.when(on, status).otherwise(F.col("access_status")), "content_hash": F.when(on, F.coalesce("_f.content_hash", "content_hash")).otherwise(F.col("content_hash"))}
    return x.select(*[out[c].alias(c) if c in out else F.col(c) for c in records.columns])


def robots_rules(files: DataFrame, host: str, body: str) -> DataFrame:
    """(host, agent, pattern, allow, crawl_delay) of robots.txt texts. Lines of agents
    that follow each other share the rules after them; comments, blank lines and
    unknown fields say nothing; an empty pattern stays, it says nothing either."""
    lines = files.select(F.col(host).alias("host"), F.posexplode(F.split(body, r"\r?\n")).alias("n", "l"))
    clean = F.trim(F.regexp_replace("l", "#.*$", ""))
    x = lines.select("host", "n", F.lower(F.trim(F.split_part(clean, F.lit(":"), F.lit(1)))).alias("field"), F.trim(F.substring_index(F.regexp_replace(clean, "^[^:]*:", "\u0001"), "\u0001", -1)).alias("value")).where(F.col("field").isin("user-agent", "allow", "disallow", "crawl-delay"))
    w = Window.partitionBy("host").orderBy("n")
    agent = F.col("field") == "user-agent"
    begins = agent & ~F.coalesce(F.lag("field").over(w) == "user-agent", F.lit(False))
    x = x.withColumn("_g", F.sum(begins.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    agents = x.where(agent).select("host", "_g", F.lower("value").alias("agent")).distinct()
    rules = x.where(~agent & (F.col("_g") > 0)).select("host", "_g", "field", "value")
    delay = rules.where("field = 'crawl-delay'").groupBy("host", "_g").agg(F.max(F.col("value").try_cast("double")).alias("crawl_delay"))
    paths = rules.where("field <> 'crawl-delay'")
    j = agents.join(delay, ["host", "_g"], "left").join(paths, ["host", "_g"], "left")
    return j.select("host", "agent", F.coalesce("value", F.lit("")).alias("pattern"), (F.coalesce("field", F.lit("allow")) == "allow").alias("allow"), "crawl_delay").distinct()
