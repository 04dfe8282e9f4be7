"""SimHash near-dedup with Golay-code fuzzy hashing.

A text's fingerprint has eight segments of 23 bits. Each segment is decoded to the
nearby codewords of the Golay code, which gives it several 12-bit keys. Documents
whose fingerprints differ in few bits have few errors in most segments
(pigeonhole), so they share keys in at least two of them: with up to 20 differing
bits always, with 32 in more than nine cases of ten. Documents that share keys of
two segments are candidates; the whole fingerprints verify them, and the verified
pairs are joined into groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golay
from .common import positional, written
from .components import components
from .decontaminate import tokens
from .textkernel import mix, slices

SEGMENTS = 8
#: Fingerprints that differ in at most this many of their 184 bits are near duplicates.
MOST_BITS = 32
_WORDS = [f"f{k}" for k in range(SEGMENTS // 2)]
_NODES = 20_000
#: Bits of each byte value.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """SimHash over each text's set of words: rows of four int64, each holding two
    segments. Texts without words have the fingerprint 0."""
    w = tokens(texts)
    n = len(w.offsets) - 1
    out = np.zeros((n, SEGMENTS // 2), np.int64)
    if not len(w.start):
        return out
    doc = w.doc.astype(np.uint64) << np.uint64(40)
    word = np.sort(doc | (w.hash >> np.uint64(24)))
    word = word[np.r_[True, word[1:] != word[:-1]]]
    row = (word >> np.uint64(40)).astype(np.int64)
    seed = word & np.uint64((1 << 40) - 1)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    size = np.diff(np.r_[first, len(row)])
    dense = np.repeat(np.arange(len(first)), size) << 8
    h = np.stack([mix(seed + np.uint64((k + 1) << 48)) for k in range(3)], axis=1).view(np.uint8).reshape(-1, 24)
    # how often each byte value stands in each byte of the word hashes gives the votes of its eight bits
    votes = np.stack([np.bincount(dense | h[:, k], minlength=len(first) << 8).reshape(-1, 256) @ _BITS for k in range(SEGMENTS * golay.BITS // 8)], axis=1)
    on = votes.reshape(len(first), -1) * 2 > size[:, None]
    weight = 1 << np.arange(2 * golay.BITS, dtype=np.int64)
    out[row[first]] = on.reshape(len(first), SEGMENTS // 2, -1) @ weight
    return out


def segments(f: np.ndarray) -> np.ndarray:
    """(rows, SEGMENTS) 23-bit words of fingerprints."""
    mask = (1 << golay.BITS) - 1
    return np.stack([f & mask, f >> golay.BITS], axis=2).reshape(len(f), -1)


def _close(f: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(f[a] ^ f[b]).sum(axis=1) <= most


def _pairs(key: np.ndarray, row: np.ndarray, f: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs that connect the rows of equal key just as all verified pairs would."""
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(key)])
    for s in np.unique(size[(size > 1) & (size <= 24)]):
        x, y = np.triu_indices(s, 1)
        start = first[size == s]
        part = max(1, (1 << 20) // len(x))
        for lo in range(0, len(start), part):
            at = start[lo : lo + part, None]
            a, b = row[at + x].ravel(), row[at + y].ravel()
            ok = _close(f, a, b, most)
            yield a[ok], b[ok]
    for start, s in zip(first[size > 24], size[size > 24]):
        rest = row[start : start + s]  # breadth first: whoever is reached isn't compared again
        queue: list[int] = []
        while len(rest):
            if not queue:
                queue, rest = [int(rest[0])], rest[1:]
            at = queue.pop()
            ok = _close(f, np.full(len(rest), at), rest, most)
            found, rest = rest[ok], rest[~ok]
            queue.extend(found.tolist())
            yield np.full(len(found), at), found


def bucket_edges(bucket: np.ndarray, node: np.ndarray, f: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between near duplicates that share the key ``bucket`` (segment * 4096
    + index) and a key of a later segment."""
    seg = segments(f)
    place = np.unique(bucket, return_inverse=True)[1]
    own = bucket >> 12
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for j in range(1, SEGMENTS):
        rows = np.flatnonzero(own < j)
        r, k = golay.keys(seg[rows, j])
        r = rows[r]
        for a, b in _pairs(place[r] << 12 | k, r, f, most):
            us.append(node[a])
            vs.append(node[b])
    u, v = np.concatenate(us), np.concatenate(vs)
    if not len(u):
        return u, v
    both = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        f = np.stack([b.column(c).to_numpy() for c in range(1, 5)], axis=1)
        seg = segments(f)
        row, key = zip(*(golay.keys(seg[:, j]) for j in range(SEGMENTS)))
        r = np.concatenate(row)
        bucket = np.concatenate([k + (j << 12) for j, k in enumerate(key)])
        for lo in range(0, len(r), 1 << 16):
            part = pa.array(r[lo : lo + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(bucket[lo : lo + (1 << 16)].astype(np.int32)), *(b.column(c).take(part) for c in range(5))], ["bucket", "node", *_WORDS])


def _edges(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(parts: list[np.ndarray]) -> pa.RecordBatch:
            x = np.concatenate(parts)
            u, v = bucket_edges(x[:, 0], x[:, 1], np.ascontiguousarray(x[:, 2:]), most)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        held: list[np.ndarray] = []
        n = 0
        for b in batches:
            x = np.stack([b.column(c).to_numpy().astype(np.int64) for c in range(6)], axis=1)
            if not len(x):
                continue
            held.append(x)
            n += len(x)
            # rows come in order of bucket; the last bucket may go on in the next batch
            cut = int(np.searchsorted(x[:, 0], x[-1, 0]))
            if n >= _NODES and cut:
                yield made([*held[:-1], x[:cut]])
                held, n = [x[cut:]], len(x) - cut
        if held:
            yield made(held)

    return run


def near_duplicates(docs: DataFrame, most_bits: int = MOST_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept_id, duplicate) for each row of ``docs``: the smallest id of its
    group of near duplicates stands for all of them.

    Texts with the same set of words, whatever their case and punctuation, are
    always grouped; so are texts without any word, the empty one among them. A null
    text is nobody's duplicate. Null ids sort after all others; rows that repeat an
    id are one document, not duplicates of it (with different texts they may stand
    in several groups). Extra columns are not read; an empty table gives an empty
    result. Groups are transitive and don't depend on the order of rows.
    """
    own, roots = _grouped(docs, most_bits, id_col, text_col)
    member = own.join(roots, "node", "left").select("id", "null_text", F.coalesce("root", "node").alias("root"))
    # a null id sorts last: min() skips nulls
    kept = member.where(~F.col("null_text")).groupBy("root").agg(F.min("id").alias("kept"))
    out = member.where(~F.col("null_text")).join(kept, "root").select(F.col("id").alias("doc_id"), F.col("kept").alias("kept_id"))
    alone = member.where("null_text").select(F.col("id").alias("doc_id"), F.col("id").alias("kept_id"))
    return out.unionByName(alone).withColumn("duplicate", ~F.col("doc_id").eqNullSafe(F.col("kept_id")))


def _fingerprinted(d: DataFrame, i: str, t: str) -> DataFrame:
    """(id, h, null_text, node, f0..f3); ``h`` is a 64-bit hash of the text, the node
    one of the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, 1):
                part = b.slice(lo, hi - lo)
                f = fingerprints(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.compute.is_null(part.column(1)), *(pa.array(c) for c in f.T)], ["id", "h", "null_text", *_WORDS])

    kind = d.schema[i].dataType.simpleString()
    rows = d.select(F.col(i).alias("id"), F.col(t).alias("text"), F.xxhash64(t).alias("h"))
    f = rows.mapInArrow(run, f"id {kind}, h long, null_text boolean, " + ", ".join(f"{w} long" for w in _WORDS))
    return f.select("id", "h", "null_text", F.xxhash64(*_WORDS).alias("node"), *_WORDS)


def _grouped(docs: DataFrame, most_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    d, (i, t) = positional(docs, id_col, text_col)
    own, _ = written(_fingerprinted(d, i, t), "fingerprints")
    nodes = own.where(~F.col("null_text")).select("node", *_WORDS).distinct()
    keyed = nodes.mapInArrow(_buckets, "bucket int, node long, " + ", ".join(f"{w} long" for w in _WORDS))
    edges = keyed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_edges(most_bits), "u long, v long")
    return own.select("id", "h", "null_text", "node"), components(edges)


def near_dedup(docs: DataFrame, most_bits: int = MOST_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of :func:`near_duplicates`: the one
    with the smallest id. All columns stay; rows with null texts stay.

    Rows are told apart by id and text, so of an id with several texts those stay
    that no smaller id has a near duplicate of; rows that repeat the document which
    stays, with its id and a text of its group, are that document and stay. A group
    of rows without an id keeps one of them, the one of the smallest text hash; a
    group in which any row has an id keeps none of them."""
    d, (i, t) = positional(docs, id_col, text_col)
    own, roots = _grouped(d, most_bits, i, t)
    member = own.where(~F.col("null_text")).join(roots, "node", "left").select("id", "h", F.coalesce("root", "node").alias("root"))
    nameless = F.col("id").isNull()
    first = member.groupBy("root").agg(F.min(F.struct(nameless.alias("none"), F.col("id"), F.when(nameless, F.col("h")).alias("h"))).alias("first"))
    judged = member.join(first, "root").select("id", "h", (F.col("first.id").eqNullSafe(F.col("id")) & F.coalesce(F.col("first.h") == F.col("h"), ~nameless)).alias("stays"))
    gone = judged.where(~nameless & ~F.col("stays")).select(F.col("id").alias("_gone"), F.col("h").alias("_h")).distinct()
    h = F.xxhash64(t)
    named = d.where(F.col(i).isNotNull()).join(gone, (F.col(i) == F.col("_gone")) & (h == F.col("_h")), "left_anti")
    alone = judged.where(nameless & F.col("stays")).select(F.col("h").alias("_h")).distinct()
    without = d.where(F.col(i).isNull())
    # equal texts without an id: one row stands for them
    heads = without.where(F.col(t).isNotNull()).join(alone, h == F.col("_h")).groupBy("_h").agg(F.min_by(F.struct(*d.columns), F.xxhash64(*d.columns)).alias("row")).select("row.*")
    return named.unionByName(without.where(F.col(t).isNull())).unionByName(heads).toDF(*docs.columns)
