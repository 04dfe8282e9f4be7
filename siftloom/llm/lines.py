"""Line dedup: lines that too many documents share are dropped.

Lines are exploded as 64-bit hashes of their normalised form, distinct documents
are counted per hash, and each document is put together again, by position, from
the lines that stay. Only hashes are exploded and counted; texts stay where they
are as long as the shared lines fit into a broadcast, and move once beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positional, written

#: Shared lines up to this many are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def normalised_line(line: Column) -> Column:
    """Lower case, runs of white space as one blank, no blanks at the ends."""
    return F.lower(F.trim(F.regexp_replace(line, "[ \\t\\r\\f\\x0B]+", " ")))


def line_hashes(text: Column) -> Column:
    """Hash of each line, null for a blank line."""
    return F.transform(
        F.split(text, "\n"),
        lambda x: F.when(normalised_line(x) != "", F.xxhash64(normalised_line(x))),
    )


def line_dedup(docs: DataFrame, max_docs: int = 50, id_col: str = "doc_id", text_col: str = "text", with_count: bool = False) -> DataFrame:
    """``docs`` with each line removed whose normalised form more than ``max_docs``
    distinct documents hold. The document with the smallest id keeps its
    occurrences, so nothing is lost from the corpus as a whole.

    A document is one id; rows without an id are one document per distinct text,
    after all that have an id. Blank lines never count and never go. A null text
    stays null, an empty one empty; a document that loses every line keeps its row
    with an empty text. Repeated rows stay repeated and are treated alike. Columns
    keep their names and order whatever they are; with ``with_count`` a column
    ``lines_dropped`` is appended.
    """
    d, (i, t) = positional(docs, id_col, text_col)
    # a document is its id, or, without one, its text's digest, after all that have an id
    own_id = F.col(i)
    digest = F.when(F.col(i).isNull(), F.conv(F.substring(F.md5(t), 1, 15), 16, 10).cast("long"))
    one = d.where(F.col(t).isNotNull()).select(own_id.alias("b"), digest.alias("c"), F.array_distinct(F.array_compact(line_hashes(F.col(t)))).alias("hs"))
    held = one.select("b", "c", F.explode("hs").alias("h")).distinct()
    shared = held.groupBy("h").agg(F.count("*").alias("n"), F.min("b").alias("hb"), F.min("c").alias("hc")).where(F.col("n") > max_docs)
    shared = shared.select("h", "hb", F.when(F.col("hb").isNull(), F.col("hc")).alias("hc"))
    shared, _ = written(shared, "shared-lines")
    keyed = d.withColumn("_c", digest)
    out = _dropped_by_map(keyed, t, i, shared) if shared.count() <= BROADCAST_ROWS else _dropped_by_join(keyed, t, i, held, shared)
    names = [*docs.columns, "lines_dropped"]
    return out.toDF(*names) if with_count else out.select(*d.columns).toDF(*docs.columns)


def _dropped_by_map(keyed: DataFrame, t: str, i: str, shared: DataFrame) -> DataFrame:
    """The documents without their shared lines, and how many these were: one pass
    with the shared lines at hand, in which no text moves."""
    m = shared.orderBy("h").toArrow()
    held = keyed.sparkSession.sparkContext.broadcast((m["h"].to_numpy(), m["hb"].combine_chunks(), m["hc"].combine_chunks()))
    cols = keyed.columns[:-1]
    at, own = cols.index(t), cols.index(i)
    width = len(cols)

    def same(a: pa.Array, b: pa.Array) -> np.ndarray:
        both = pc.and_(pc.is_null(a), pc.is_null(b))
        return pc.or_(pc.fill_null(pc.equal(a, b), False), both).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, hb, hc = held.value
        for b in batches:
            lists = b.column(width + 1)
            flat = lists.flatten()
            value = flat.fill_null(0).to_numpy(zero_copy_only=False)
            place = np.minimum(np.searchsorted(h, value), max(len(h) - 1, 0))
            hit = np.flatnonzero((h[place] == value) & flat.is_valid().to_numpy(zero_copy_only=False)) if len(h) else np.zeros(0, np.int64)
            row = pc.list_parent_indices(lists).to_numpy()[hit]
            r, p = pa.array(row), pa.array(place[hit])
            home = same(b.column(own).take(r), hb.take(p)) & same(b.column(width).take(r), hc.take(p))
            hit, row = hit[~home], row[~home]
            lost = np.bincount(row, minlength=b.num_rows).astype(np.int32)
            text = b.column(at)
            if len(row):
                first = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]
                new = text.to_pylist()
                for k in np.flatnonzero(lost):
                    gone = set((hit[np.searchsorted(row, k) : np.searchsorted(row, k, "right")] - first[k]).tolist())
                    new[k] = "\n".join(x for n, x in enumerate(new[k].split("\n")) if n not in gone)
                text = pa.array(new, text.type)
            yield pa.RecordBatch.from_arrays([*(text if k == at else b.column(k) for k in range(width)), pa.array(lost)], [*cols, "_n"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema.fields[:-1]), "_n int"])
    return keyed.withColumn("_hs", line_hashes(F.col(t))).mapInArrow(run, schema)


def _dropped_by_join(keyed: DataFrame, t: str, i: str, held: DataFrame, shared: DataFrame) -> DataFrame:
    """The same by shuffles, for more shared lines than a broadcast should hold."""
    home = F.col("b").eqNullSafe(F.col("hb")) & F.col("c").eqNullSafe(F.col("hc"))
    lost = held.join(shared, "h").where(~home).groupBy(F.col("b").alias("_lb"), F.col("c").alias("_lc")).agg(F.collect_set("h").alias("_lost")).withColumn("_lk", F.xxhash64("_lb", "_lc"))
    same = (F.xxhash64(i, "_c") == F.col("_lk")) & F.col(i).eqNullSafe(F.col("_lb")) & F.col("_c").eqNullSafe(F.col("_lc"))
    joined = keyed.join(lost, same, "left")
    lines, hashes = F.split(F.col(t), "\n"), line_hashes(F.col(t))
    goes = lambda h: F.coalesce(F.array_contains(F.col("_lost"), h), F.lit(False))
    kept = F.array_compact(F.zip_with(lines, hashes, lambda x, h: F.when(~goes(h), x)))
    stays = F.col("_lost").isNull() | F.col(t).isNull()
    text = F.when(stays, F.col(t)).otherwise(F.array_join(kept, "\n"))
    gone = F.when(stays, F.lit(0)).otherwise(F.size(F.filter(hashes, goes)))
    return joined.select(*[text.alias(c) if c == t else F.col(c) for c in keyed.columns[:-1]], gone.cast("int").alias("_n"))
