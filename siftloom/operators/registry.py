"""Registry merges as ordered folds.

Batch rows meet the registry one after another: a key that comes twice in a batch
corroborates twice, and conflicts are logged against the value held at that moment.
What a fold leaves follows from firsts, lasts and maxima by the sequence, so it is
computed by partial aggregation, in time linear in the rows whatever a key's share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fold:
    """How each field merges. ``largest`` keeps the maximum; ``backfill`` takes the
    first known value; ``guarded`` keeps what it has and logs what differs;
    ``latest`` takes the newest known value; ``united`` (arrays) becomes a sorted
    set; ``ranked`` fields are replaced together by a row of strictly higher rank."""

    key: str
    seq: str
    largest: Sequence[str] = ()
    backfill: Sequence[str] = ()
    guarded: Sequence[str] = ()
    latest: Sequence[str] = ()
    united: Sequence[str] = ()
    rank: str | None = None
    ranked: Sequence[str] = ()

    @property
    def fields(self) -> list[str]:
        return list(dict.fromkeys([*self.largest, *self.backfill, *self.guarded, *self.latest, *self.united, *([self.rank] if self.rank else []), *self.ranked]))


def fold(registry: DataFrame, batch: DataFrame, how: Fold) -> DataFrame:
    """The registry after the batch: key, fields, ``corroboration_count`` and the
    ``conflicts`` log (seq, field, existing, incoming), in order of ``seq``.

    A registry row may carry ``corroboration_count`` (1 if not); it comes before the
    batch rows of its key. Rows of one sequence go by their values. Rows without a key
    are left out. Both inputs are read up to three times, so a registry that has met
    many batches is better written between them.
    """
    f = how.fields
    cnt = F.col("corroboration_count") if "corroboration_count" in registry.columns else F.lit(1)
    pick = lambda d, side, n: d.where(F.col(how.key).isNotNull()).select(how.key, F.lit(side).alias("_side"), F.col(how.seq).alias("_seq"), n.cast("int").alias("_n"), *[F.col(c).alias(f"_f_{c}") for c in f])
    rows = pick(registry, 0, cnt).unionByName(pick(batch, 1, F.lit(1)))
    kind = registry.schema[how.seq].dataType.simpleString()
    log = f"array<struct<seq:{kind},field:string,existing:string,incoming:string>>"
    order = ["_side", "_seq", "_n", *[f"_f_{c}" for c in f]]
    kept = lambda c, over=lambda a: a: _kept(how, c, F.struct(*order), over)
    count = F.when(F.count("_n") == F.count("*"), F.sum("_n")).cast("int")
    state = rows.groupBy(how.key).agg(*[kept(c).alias(c) for c in f], count.alias("corroboration_count"))
    if not how.guarded:
        return state.withColumn("conflicts", F.array().cast(log))

    g = list(dict.fromkeys(how.guarded))
    either = lambda found: reduce(lambda a, b: a | b, found)
    if any(_moves(how, c) for c in g):
        before = Window.partitionBy(how.key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        met = rows.withColumns({f"_held_{c}": F.when(F.count("*").over(before) > 0, kept(c, lambda a: a.over(before))) for c in g})
    else:  # what is held is what the key ends with; the log is collected where the join has put its rows
        held = rows.groupBy(how.key).agg(*[kept(c).alias(f"_held_{c}") for c in g])
        known = rows.where(either([F.col(f"_f_{c}").isNotNull() for c in g]))
        met = known.select(how.key, "_side", "_seq", "_n", *[f"_f_{c}" for c in g]).repartition(how.key).join(held, how.key)
    clash = lambda c, r: r[f"_held_{c}"].isNotNull() & r[f"_f_{c}"].isNotNull() & (r[f"_held_{c}"] != r[f"_f_{c}"])
    met = met.select(how.key, F.struct("_side", "_seq", "_n", *[f"_f_{c}" for c in g], *[f"_held_{c}" for c in g]).alias("r"))
    met = met.where(either([clash(c, F.col("r")) for c in g]))
    logs = met.groupBy(how.key).agg(F.array_sort(F.collect_list("r")).alias("_log"))
    note = lambda c, r: F.when(clash(c, r), F.struct(r["_seq"].alias("seq"), F.lit(c).alias("field"), r[f"_held_{c}"].cast("string").alias("existing"), r[f"_f_{c}"].cast("string").alias("incoming")))
    notes = F.flatten(F.transform("_log", lambda r: F.array_compact(F.array(*[note(c, r) for c in g])))).cast(log)
    return state.join(logs, how.key, "left").select(how.key, *f, "corroboration_count", F.coalesce(notes, F.array().cast(log)).alias("conflicts"))


def _ranked(how: Fold, c: str) -> bool:
    return bool(how.rank) and c in (how.rank, *how.ranked)


def _moves(how: Fold, c: str) -> bool:
    """Whether a known value of the field may give way to another."""
    return _ranked(how, c) or (c not in how.backfill and c in (*how.latest, *how.united, *how.largest))


def _kept(how: Fold, c: str, order: Column, over: Callable[[Column], Column]) -> Column:
    """What a key's rows leave of a field, by an aggregate (``over`` them or a window).
    No row waits for the one before it, so a history is never gathered in one place."""
    v = F.col(f"_f_{c}")
    if _ranked(how, c):  # a rank must be exceeded, so the first row of the highest one
        return over(F.min_by(v, F.struct(-F.coalesce(F.col(f"_f_{how.rank}"), F.lit(0)), order)))
    if c in how.backfill:
        return over(F.min_by(v, F.when(v.isNotNull(), order)))
    if c in how.latest:
        return over(F.max_by(v, F.when(v.isNotNull(), order)))
    if c in how.united:
        return F.array_sort(F.array_distinct(F.flatten(over(F.collect_set(v)))))
    if c in how.largest:
        return over(F.max(v))
    return over(F.min_by(v, order))


#: Merge of entities: a description of a higher rank replaces the one that is there
#: with its source; vendor, freshness and address are filled once; type and address
#: that differ are logged; the newest measured stars count; topics are united.
ENTITIES = Fold("entity_key", "seq", rank="description_rank", ranked=("description", "description_source"), backfill=("maintainer_or_vendor", "freshness_signal", "target_url"), guarded=("entity_type", "target_url"), latest=("github_stars",), united=("related_topics",))
#: Merge of cases: evidence goes together and is replaced by a higher status; five
#: fields are filled once; a reported number that differs is logged, never replaced.
CASES = Fold("case_key", "seq", largest=("confidence",), rank="status_rank", ranked=("verification_status", "evidence_quote", "source_url", "source_title", "source_domain"), backfill=("industry", "workflow_before", "measurable_kpi", "transformation_date", "publication_date"), guarded=("kpi_value",))


def merged_entities(registry: DataFrame, batch: DataFrame) -> DataFrame:
    """The entity registry after a batch. Texts that say unknown are nothing; stars
    count only for addresses that are the root of a repository; the key is the given
    one, else topic and name."""
    from ..functions.cleaning import ascii_key, known
    from ..functions.urls import repository_root

    def ready(d: DataFrame, measured: bool) -> DataFrame:
        d = d.withColumns({c: known(F.col(c)) for c in ("maintainer_or_vendor", "freshness_signal", "target_url", "entity_type")})
        key = F.coalesce(F.col("entity_key"), F.concat_ws("|", F.coalesce("topic", F.lit("unknown")), ascii_key(F.coalesce("name", F.lit("unknown")))))
        stars = F.when(repository_root(F.col("target_url")).isNotNull() & ~F.col("target_url").rlike(r"[?#]"), F.col("github_stars")) if measured else F.col("github_stars")
        return d.withColumns({"entity_key": key, "github_stars": stars, "description_rank": status_rank(F.replace("description_source", F.lit("-"), F.lit("_")))})

    return fold(ready(registry, False), ready(batch, True), ENTITIES)


def merged_cases(registry: DataFrame, batch: DataFrame) -> DataFrame:
    """The case registry after a batch; the key is the given one, else company, tool
    and what the work became."""
    from ..functions.cleaning import ascii_key, known

    def ready(d: DataFrame) -> DataFrame:
        name = lambda c: ascii_key(F.coalesce(c, F.lit("unknown")))
        d = d.withColumns({c: known(F.col(c)) for c in CASES.backfill})
        return d.withColumns({"case_key": F.coalesce("case_key", F.concat_ws("|", name("company"), name("ai_system_or_tool"), name("workflow_after"))), "status_rank": status_rank(F.replace("verification_status", F.lit("-"), F.lit("_")))})

    return fold(ready(registry), ready(batch), CASES)


def status_rank(status: Column) -> Column:
    """Verified goes before a snippet, a snippet before anything else."""
    return F.when(status == "verified", 2).when(status == "snippet_only", 1).otherwise(0)


def case_key(company: Column, pattern: Column, transformed: Column, supplied: Column | None = None) -> Column:
    """Key of a case: company, pattern and month; a supplied key goes before it."""
    from ..functions.cleaning import ascii_key

    derived = F.concat_ws("|", ascii_key(company), ascii_key(pattern), F.date_format(transformed, "yyyy-MM"))
    return F.coalesce(supplied, derived) if supplied is not None else derived


def counted(registry: DataFrame, by: Sequence[str]) -> DataFrame:
    """(dimension, value, n) counts of each of ``by``, recomputed from the rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in by])
    return registry.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count("*").alias("n"))


# Shards and matrices.


def union_preserving(shards: DataFrame, union: DataFrame, key: str) -> DataFrame:
    """The shards' rows, and those of the former union that no shard carries."""
    return shards.unionByName(union.join(shards.select(key).distinct(), key, "left_anti").select(*shards.columns))


def drift(shard: DataFrame, union: DataFrame, key: str) -> DataFrame:
    """Keys of a shard that the union lacks."""
    return shard.select(key).distinct().join(union.select(key).distinct(), key, "left_anti")


def matrix(categories: DataFrame, topics: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Cells of every category (i, category) with every topic (j, topic), or of the
    listed pairs (i, j) alone."""
    cells = categories.crossJoin(topics)
    if pairs is not None:
        cells = cells.join(pairs, ["i", "j"], "left_semi")
    return cells.select("i", "j", "category", "topic", F.concat("category", F.lit("#"), F.col("i"), F.lit("_"), F.col("topic"), F.lit("#"), F.col("j")).alias("cell"))


def last_wins(rows: DataFrame, key: Sequence[str], seq: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row for each key: the last by ``seq``."""
    return rows.groupBy(*key).agg(F.max_by(F.struct(*keep), F.struct(*seq)).alias("r")).select(*key, *[F.col(f"r.{c}").alias(c) for c in keep])


def suffix_lookup(items: DataFrame, host: str, overrides: DataFrame, value: str) -> DataFrame:
    """``items`` with the override of the exact host or else of its nearest parent."""
    labels = F.split(F.col(host), "\\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.struct(k.alias("far"), F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("domain")))
    hosts = items.select(host).where(F.col(host).isNotNull()).distinct().select(host, F.inline(chain))
    near = hosts.join(overrides, "domain").groupBy(host).agg(F.min_by(value, "far").alias(value))
    return items.join(near, host, "left")
