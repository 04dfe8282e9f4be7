"""URL identity as column expressions: splitting, canonical form, keys and guards.

Everything stays inside the JVM. URLs are split by one regular expression, because
the built-in URL parser rejects addresses that real feeds contain.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
#: Query parameters that only tell where a visitor came from.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "gclid", "fbclid", "mc_cid", "mc_eid")


def part(url: Column, n: int) -> Column:
    """Scheme, authority, path, query with ``?`` or fragment with ``#`` (1 to 5)."""
    return F.regexp_extract(F.trim(url), SPLIT, n)


def host(url: Column) -> Column:
    """Lower-case host without user and port; null where there is none."""
    h = F.regexp_replace(F.regexp_replace(F.lower(part(url, 2)), "^.*@", ""), ":[^:\\]]*$", "")
    return F.nullif(h, F.lit(""))


def registrable(h: Column) -> Column:
    """The last two labels of a host."""
    labels = F.split(h, "\\.")
    return F.when(F.size(labels) <= 2, h).otherwise(F.array_join(F.slice(labels, -2, 2), "."))


def percent_normalised(x: Column) -> Column:
    """Escapes in upper case, those of unreserved characters resolved."""

    def one(piece: Column, n: Column) -> Column:
        code = F.upper(F.substring(piece, 1, 2))
        char = F.char(F.conv(code, 16, 10).cast("int"))
        rest = F.substr(piece, F.lit(3))
        escaped = piece.rlike("^[0-9A-Fa-f]{2}")
        return (
            F.when(n == 0, piece)
            .when(escaped & code.rlike("^[0-7]") & char.rlike("^[A-Za-z0-9._~\\-]$"), F.concat(char, rest))
            .when(escaped, F.concat(F.lit("%"), code, rest))
            .otherwise(F.concat(F.lit("%"), piece))
        )

    return F.array_join(F.transform(F.split(x, "%"), one), "")


def without_dots(path: Column) -> Column:
    """Empty and ``.`` segments dropped, ``..`` resolved; a final slash stays."""
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        F.split(path, "/"),
        empty,
        lambda a, s: F.when((s == "") | (s == "."), a)
        .when(s == "..", F.when(F.size(a) <= 1, empty).otherwise(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))))
        .otherwise(F.array_append(a, s)),
    )
    slash = F.when(path.endswith("/") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), slash)


def _quoted(x: Column) -> Column:
    y = F.url_encode(x)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        y = F.replace(y, F.lit(a), F.lit(b))
    return y


def query_pairs(query: Column) -> Column:
    """Array of (k, v), decoded; blank values stay, empty pieces don't."""
    piece = F.filter(F.split(F.regexp_replace(query, r"^\?", ""), "&"), lambda p: p != "")
    plain = lambda x: F.coalesce(F.try_url_decode(x), x)

    def pair(p: Column) -> Column:
        at = F.locate("=", p)
        return F.struct(plain(F.when(at > 0, F.substr(p, F.lit(1), at - 1)).otherwise(p)).alias("k"), plain(F.when(at > 0, F.substr(p, at + 1)).otherwise(F.lit(""))).alias("v"))

    return F.transform(piece, pair)


#: A query of plain pairs only: nothing to decode, nothing to encode, one ``=`` each.
_PLAIN = r"^\?[A-Za-z0-9._~\-]+=[A-Za-z0-9._~\-]*(?:&[A-Za-z0-9._~\-]+=[A-Za-z0-9._~\-]*)*$"


def _clean_path(path: Column) -> Column:
    """The path normalised; most paths have nothing to normalise and stay as they
    are, without a function that the code generator can't compile."""
    odd = path.contains("%") | path.contains("//") | path.contains("/.")
    return F.when(path == "", F.lit("/")).when(odd, without_dots(percent_normalised(path))).otherwise(path)


def _clean_query(query: Column, tracking: tuple[str, ...], sort: bool) -> Column:
    pairs = F.filter(query_pairs(query), lambda p: ~p["k"].isin(*tracking))
    if sort:
        pairs = F.array_sort(pairs)
    joined = F.array_join(F.transform(pairs, lambda p: F.concat(_quoted(p["k"]), F.lit("="), _quoted(p["v"]))), "&")
    joined = F.when(joined == "", F.lit("")).otherwise(F.concat(F.lit("?"), joined))
    if sort:
        return F.when(query == "", query).otherwise(joined)
    listed = "|".join(re.escape(t) for t in tracking) or "(?!)"
    kept = F.regexp_replace(F.regexp_replace(query, rf"(?<=[?&])(?:{listed})=[^&]*(?:&|$)", ""), "[?&]$", "")
    return F.when(query == "", query).when(query.rlike(_PLAIN), kept).otherwise(joined)


def canonical(url: Column, tracking: Iterable[str] = TRACKING, drop_fragment: Column | None = None, sort_query: bool = False) -> Column:
    """Conservative canonical form; null for what isn't a usable http(s) address.

    Scheme and host in lower case, no user, no default port; path escapes and dot
    segments normalised; listed parameters dropped, the others re-encoded in their
    order (``sort_query``: sorted). A fragment stays unless ``drop_fragment`` holds
    and it isn't a route (``#!``, ``#/`` or ``#?``).
    """
    scheme = F.lower(part(url, 1))
    authority = F.regexp_replace(F.lower(part(url, 2)), "^.*@", "")
    port = F.regexp_extract(authority, ":([^:\\]]*)$", 1)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    name = F.regexp_replace(authority, ":[^:\\]]*$", "")
    site = F.concat(name, F.when(default, F.lit("")).otherwise(F.concat(F.lit(":"), port)))
    fragment = part(url, 5)
    if drop_fragment is not None:
        fragment = F.when(drop_fragment & ~fragment.rlike("^#[!/?]"), F.lit("")).otherwise(fragment)
    fragment = F.when(fragment == "#", F.lit("")).otherwise(fragment)
    good = scheme.isin("http", "https") & (name != "") & port.rlike("^[0-9]{0,5}$")
    good = good & (F.when(port == "", F.lit(0)).otherwise(port.try_cast("int")) <= 65535)
    return F.when(good, F.concat(scheme, F.lit("://"), site, _clean_path(part(url, 3)), _clean_query(part(url, 4), tuple(tracking), sort_query), fragment))


def is_route(fragment: Column) -> Column:
    """Fragments that choose a page: hash-bang, router and query fragments."""
    return fragment.rlike("^#?[!/?]")


def fragment_droppable(items: DataFrame, url: str, rules: DataFrame, anchors: str | None = None) -> DataFrame:
    """``items`` with ``drop_fragment``: whether a domain rule (host, strip_fragment)
    for the exact host, or else for its registrable part, or evidence that the
    fragment names an anchor in the page itself (boolean column ``anchors``) lets the
    fragment go. A route never goes. Rules are a bounded configuration."""
    h = host(F.col(url))
    exact = rules.select(F.col("host").alias("_h"), F.col("strip_fragment").alias("_exact")).distinct()
    parent = rules.select(F.col("host").alias("_r"), F.col("strip_fragment").alias("_parent")).distinct()
    x = items.withColumns({"_h": h, "_r": registrable(h)}).join(exact, "_h", "left").join(parent, "_r", "left")
    seen = F.coalesce(F.col(anchors), F.lit(False)) if anchors else F.lit(False)
    ok = (F.coalesce("_exact", "_parent", F.lit(False)) | seen) & ~is_route(part(F.col(url), 5))
    return x.withColumn("drop_fragment", ok).drop("_h", "_r", "_exact", "_parent")


def content_id(identity_url: Column) -> Column:
    """First 16 hex digits of the address's SHA-256."""
    return F.substring(F.sha2(identity_url, 256), 1, 16)


def record_id(topic: Column, identity_url: Column) -> Column:
    return content_id(F.concat(topic, F.lit("|"), identity_url))


def content_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def conflict_id(reason: Column, identity: Column, alias: Column) -> Column:
    sep = F.lit("\x1f")
    none = lambda c: F.coalesce(c, F.lit(""))
    return content_id(F.concat(none(reason), sep, none(identity), sep, none(alias)))


#: Request headers that change what is served; others don't enter a key.
KEY_HEADERS = ("accept", "accept-language")
CANONICALIZATION_VERSION = "1"


def request_key(source_id: Column, url: Column, adapter_mode: Column | None = None, method: str = "GET", headers: Column | None = None, body: Column | None = None, query_order: str = "preserve", version: str = CANONICALIZATION_VERSION) -> Column:
    """Digest of all that makes a request what it is: source, method, canonical
    address in the given query order, adapter mode, the listed headers (a map; names
    in any case), body digest, query order and canonicalisation version. An absent
    part counts as empty."""
    if query_order not in ("preserve", "sort-distinct-keys-stable"):
        raise ValueError(f"unknown query order {query_order!r}")
    c = canonical(url)
    if query_order != "preserve":
        q = stably_sorted_query(c)
        c = F.concat(F.regexp_replace(c, r"[?#].*$", ""), F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q)), part(c, 5))
    picked = F.lit("")
    if headers is not None:
        named = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("k"), F.trim(e["value"]).alias("v")))
        wanted = F.array_sort(F.filter(named, lambda e: e["k"].isin(*KEY_HEADERS)))
        picked = F.array_join(F.transform(wanted, lambda e: F.concat(e["k"], F.lit(":"), e["v"])), ",")
    none = F.lit("")
    parts = [source_id, F.lit(method), c, adapter_mode if adapter_mode is not None else F.lit("default"), picked, F.sha2(body, 256) if body is not None else none, F.lit(query_order), F.lit(version)]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, none) for p in parts]), 256)


def stably_sorted_query(url: Column) -> Column:
    """The query with its pairs in order of their keys; pairs of one key keep theirs."""
    pieces = F.filter(F.split(F.regexp_replace(part(url, 4), r"^\?", ""), "&"), lambda p: p != "")
    keyed = F.transform(pieces, lambda p, n: F.struct(F.substring_index(p, "=", 1).alias("k"), n.alias("n"), p.alias("p")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["p"]), "&")


def match_key(url: Column) -> Column:
    """Loose form for matching only: no scheme, ``www.``, fragment or final slash."""
    x = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.\\-]*://", "")
    return F.regexp_replace(F.regexp_replace(F.lower(x), "^www\\.", ""), "/+$", "")


def visited_key(url: Column) -> Column:
    """Ledger form: host in lower case, no ``utm_`` parameters, fragment or final slash."""
    query = F.array_join(F.filter(F.split(F.regexp_replace(part(url, 4), r"^\?", ""), "&"), lambda p: (p != "") & ~p.rlike("^utm_")), "&")
    base = F.concat(F.lower(part(url, 1)), F.lit("://"), F.lower(part(url, 2)), F.regexp_replace(part(url, 3), "/+$", ""))
    return F.concat(base, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


_NOT_OWNERS = ("orgs", "topics", "sponsors", "features", "marketplace", "about")


def repository_root(url: Column) -> Column:
    """``owner/name`` in lower case where the address is a repository on GitHub."""
    m = r"(?i)^https?://(?:www\.)?github\.com/([A-Za-z0-9_.\-]+)/([A-Za-z0-9_.\-]+?)(?:\.git)?/?(?:[?#].*)?$"
    owner = F.lower(F.regexp_extract(url, m, 1))
    return F.when((owner != "") & ~owner.isin(*_NOT_OWNERS), F.concat(owner, F.lit("/"), F.lower(F.regexp_extract(url, m, 2))))


#: Hosts of search pages, path ends of feeds, segments of index pages, query keys of searches.
SUSPICIOUS = {
    "search_hosts": ("search.example.com", "duckduckgo.com", "www.google.com", "www.bing.com"),
    "search_keys": ("q", "query", "s"),
    "feeds": ("feed", "rss", "atom"),
    "indexes": ("category", "categories", "tag", "tags"),
}


def suspicion(url: Column, known: Mapping[str, Sequence[str]] = SUSPICIOUS) -> Column:
    """Why an address can't be the page of an item, by the first rule that holds:
    search page, query page, feed or index; null if none does. Rules look at whole
    hosts, segments and keys; ``known`` is their data."""
    h = host(url)
    segments = F.filter(F.split(F.lower(part(url, 3)), "/"), lambda s: s != "")
    last = F.element_at(segments, F.when(F.size(segments) > 0, -1).otherwise(1))
    last = F.when(F.size(segments) > 0, last).otherwise(F.lit(""))
    keys = F.transform(query_pairs(part(url, 4)), lambda p: F.lower(p["k"]))
    index = F.exists(segments, lambda s: s.isin(*known["indexes"]) | s.startswith("awesome-")) | F.lower(part(url, 3)).rlike("/page/[0-9]+(/|$)") | last.rlike("^readme(\\.md)?$")
    return (
        F.when(h.isin(*known["search_hosts"]) | (F.substring_index(h, ".", 1) == "search"), "search_host")
        .when((last == "search") | F.arrays_overlap(keys, F.array(*[F.lit(k) for k in known["search_keys"]])), "search_path")
        .when(last.isin(*known["feeds"]) | last.rlike("\\.(rss|atom|xml)$"), "feed")
        .when(index, "index")
    )
