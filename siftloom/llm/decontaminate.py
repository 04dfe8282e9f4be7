"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet by shared seeds: hashed runs of ``min_match``
words. For each pair that met, the longest matches that don't overlap are marked
again and again (running Karp-Rabin over the same word hashes), which finds a
passage whose parts were put in another order. An item that is covered to
``threshold`` makes the document contaminated.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import positional
from .textkernel import WORDISH, Words, slices, utf8_buffer

#: Benchmarks up to this many bytes of text go to every task at once; larger ones are taken in parts.
BROADCAST_BYTES = 32 << 20


def tokens(col: pa.Array) -> Words:
    """Lower-case runs of word characters; punctuation and white space only separate."""
    col = pc.utf8_lower(col)
    data, off = utf8_buffer(col)
    n = len(data)
    kind = WORDISH[data]
    new = np.zeros(n + 1, bool)
    if n:
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:n])
        new[off] = True
    cut = np.flatnonzero(new[:n])
    stop = np.append(cut[1:], n)
    keep = kind[cut] if n else np.zeros(0, bool)
    return Words(data, off, cut[keep].astype(np.int64), stop[keep].astype(np.int64))


def tiles(doc: list, item: list, min_match: int, seeds: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token lists: (place in doc, place in item,
    length) of each tile, none shorter than ``min_match``; longest first, ties by
    place in the item, then in the document. ``seeds`` are all pairs of places
    where ``min_match`` tokens agree."""
    if seeds is None:
        at = defaultdict(list)
        for p in range(len(item) - min_match + 1):
            at[tuple(item[p : p + min_match])].append(p)
        seeds = [(d, p) for d in range(len(doc) - min_match + 1) for p in at.get(tuple(doc[d : d + min_match]), ())]
    # maximal runs along diagonals; a run of r seeds is a match of r + min_match - 1 tokens
    runs: list[tuple[int, int, int]] = []
    for p, d in sorted((p - d, d) for d, p in seeds):
        if runs and runs[-1][0] == p and runs[-1][1] + runs[-1][2] - min_match + 1 == d:
            runs[-1] = (p, runs[-1][1], runs[-1][2] + 1)
        else:
            runs.append((p, d, min_match))
    import heapq

    heap = [(-n, d + diag, d) for diag, d, n in runs]
    heapq.heapify(heap)
    seen_d, seen_p, out = set(), set(), []
    while heap:
        n, p, d = heapq.heappop(heap)
        n = -n
        free = [d + j not in seen_d and p + j not in seen_p for j in range(n)]
        if all(free):
            out.append((d, p, n))
            seen_d.update(range(d, d + n))
            seen_p.update(range(p, p + n))
            continue
        j = 0
        while j < n:  # what remains of a match that a longer one cut into
            if not free[j]:
                j += 1
                continue
            e = j
            while e < n and free[e]:
                e += 1
            if e - j >= min_match:
                heapq.heappush(heap, (-(e - j), p + j, d + j))
            j = e
    return out


class Items:
    """Benchmark items ready for matching, in flat arrays: their tokens' hashes and
    bytes, and the table of their seeds (hash, item, place), sorted by hash, for
    each length of seed."""

    def __init__(self, ids: list, texts: list[str | None], min_match: int):
        w = tokens(pa.array(texts, pa.string()))
        self.ids, self.min_match = ids, min_match
        self.hash, self.first, self.data, self.start, self.end = w.hash, w.first, w.data, w.start, w.end
        self.size = np.diff(w.first)
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        seed = np.minimum(min_match, self.size)
        for k in np.unique(seed[seed > 0]).tolist():
            at, h = w.grams(k)
            use = seed[w.doc[at]] == k
            at, h = at[use], h[use]
            order = np.argsort(h, kind="stable")
            at = at[order]
            self.seeds[k] = h[order], w.doc[at].astype(np.int32), (at - w.first[w.doc[at]]).astype(np.int32)
        # which low bits the seeds have: a table of 16 places a seed, at most 2^26 of them
        most = max([len(h) for h, *_ in self.seeds.values()], default=0)
        self.mask = np.uint64((1 << min(26, max(10, (16 * most).bit_length()))) - 1)
        self.maybe = {k: np.zeros(int(self.mask) + 1, bool) for k in self.seeds}
        for k, (h, *_) in self.seeds.items():
            self.maybe[k][h & self.mask] = True

    def _met(self, w: Words) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(row, item, places in the document, places in the item) of the seeds that
        each pair shares: the join of both seed tables by hash."""
        rows, items, at_doc, at_item = [], [], [], []
        for k, (h, item, place) in self.seeds.items():
            at, g = w.grams(k)
            if not len(h):
                continue
            # most seeds of a document are in no item: their low bits tell, without a search
            few = np.flatnonzero(self.maybe[k][g & self.mask])
            lo = np.searchsorted(h, g[few], "left")
            met = h[np.minimum(lo, len(h) - 1)] == g[few]
            hit, lo = few[met], lo[met]
            n = np.searchsorted(h, g[hit], "right") - lo
            j = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            a = np.repeat(at[hit], n)
            rows.append(w.doc[a])
            items.append(item[j])
            at_doc.append(a - w.first[w.doc[a]])
            at_item.append(place[j])
        if not rows:
            return
        row, item, d, p = (np.concatenate(x) for x in (rows, items, at_doc, at_item))
        order = np.lexsort((p, d, item, row))
        row, item, d, p = row[order], item[order], d[order], p[order]
        cut = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])]) if len(row) else np.zeros(0, np.int64)
        for a, b in zip(cut, np.append(cut[1:], len(row))):
            yield int(row[a]), int(item[a]), d[a:b], p[a:b]

    def _equal(self, w: Words, at: int, own: int, n: int) -> bool:
        """Whether ``n`` tokens of the batch from ``at`` are those of the items from ``own``."""
        return all(
            w.data[w.start[at + j] : w.end[at + j]].tobytes() == self.data[self.start[own + j] : self.end[own + j]].tobytes() for j in range(n)
        )

    def match(self, texts: pa.Array, threshold: float) -> Iterator[tuple[int, int, int, int]]:
        """(row, item number, tokens covered, tokens) of the pairs covered to the threshold."""
        w = tokens(texts)
        for row, n, at_doc, at_item in self._met(w):
            size = int(self.size[n])
            k = min(self.min_match, size)
            mark = np.zeros(size + 1, np.int64)
            np.add.at(mark, at_item, 1)
            np.add.at(mark, at_item + k, -1)
            if np.count_nonzero(np.cumsum(mark)[:size]) < threshold * size:  # too little even if all were marked
                continue
            a, b = int(w.first[row]), int(self.first[n])
            doc, want = w.hash[a : w.first[row + 1]], self.hash[b : b + size]
            found = tiles(doc, want, k, list(zip(at_doc.tolist(), at_item.tolist())))
            covered = sum(t[2] for t in found if self._equal(w, a + t[0], b + t[1], t[2]))
            if covered >= threshold * size:
                yield row, n, covered, size


def _size(bench: DataFrame, text: str) -> int:
    return int(bench.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def _parts(bench: DataFrame, i: str, t: str, limit: int) -> list[list]:
    """The benchmark in parts of about ``limit`` bytes, read one after another."""
    size = _size(bench, t)
    n = max(1, -(-size // limit))
    b = bench.select(F.col(i).alias("i"), F.col(t).alias("t"))
    if n == 1:
        return [b.collect()]
    return [b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect() for k in range(n)]


def _docs_and_items(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str):
    d, (i, t) = positional(docs, id_col, text_col)
    b, (bi, bt) = positional(benchmark, item_col, item_text_col)
    return d, i, t, b, bi, bt


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = 5,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, item_id, covered, item_tokens, coverage) of each document and item
    where tiles of at least ``min_match`` words cover ``threshold`` of the item.

    Case and punctuation don't matter. An item of fewer words than ``min_match``
    has to occur whole; an item without words never matches. Null and empty texts
    match nothing; null ids stay null; repeated rows give repeated results; extra
    columns are not read. A benchmark beyond ``broadcast_bytes`` is taken in parts
    of that size, each in a pass over the documents; the result is the same. Items
    that repeat an id are several items. Tiles found by hash are verified byte by byte.
    """
    d, i, t, b, bi, bt = _docs_and_items(docs, benchmark, id_col, text_col, item_col, item_text_col)
    d = d.select(F.col(i).alias("doc_id"), F.col(t).alias("text"))
    kinds = (d.schema["doc_id"].dataType.simpleString(), b.schema[bi].dataType.simpleString())
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, covered int, item_tokens int, coverage double"
    spark = docs.sparkSession
    out = None
    for part in _parts(b, bi, bt, broadcast_bytes):
        held = spark.sparkContext.broadcast(Items([r["i"] for r in part], [r["t"] for r in part], min_match))

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = held.value
            for batch in batches:
                for lo, hi in slices(batch, 1):
                    rows = list(items.match(batch.column(1).slice(lo, hi - lo), threshold))
                    if rows:
                        row, n, cov, size = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).slice(lo, hi - lo).take(pa.array(row, pa.int64())),
                                pa.array([items.ids[x] for x in n]),
                                pa.array(cov, pa.int32()),
                                pa.array(size, pa.int32()),
                                pa.array([c / s for c, s in zip(cov, size)], pa.float64()),
                            ],
                            ["doc_id", "item_id", "covered", "item_tokens", "coverage"],
                        )

        found = d.mapInArrow(scan, schema)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = 5,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` without the rows that :func:`contamination` would report; all
    columns and all other rows stay, those with null or empty texts among them."""
    d, i, t, b, bi, bt = _docs_and_items(docs, benchmark, id_col, text_col, item_col, item_text_col)
    spark = docs.sparkSession
    at = d.columns.index(t)
    for part in _parts(b, bi, bt, broadcast_bytes):
        held = spark.sparkContext.broadcast(Items([r["i"] for r in part], [r["t"] for r in part], min_match))

        def sift(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = held.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, hi in slices(batch, at):
                    for row, *_ in items.match(batch.column(at).slice(lo, hi - lo), threshold):
                        keep[lo + row] = False
                yield batch.filter(pa.array(keep))

        d = d.mapInArrow(sift, d.schema)
    return d.toDF(*docs.columns)
