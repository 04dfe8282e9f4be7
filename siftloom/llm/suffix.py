"""Repeated passages by a hash-compared suffix sort.

Suffixes are compared by their longest common extension, which binary search finds
with prefix polynomial hashes, so a comparison takes logarithmic time; mergesort
orders them, and neighbours that agree in ``min_words`` words, verified word by
word, are repeats.

To spread the sort over a cluster, every window of ``min_words`` words is given to
its anchor, the run of 8 words with the smallest hash in it. Equal windows have
equal anchors at equal places, so only suffixes of one anchor hash and place can
agree that far, and anchors that a single document has need no sorting at all. An
anchor that very many contexts have would be too much for one task to sort; its
windows are grouped by digest instead and compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import identity, positional, written
from .textkernel import Words, running, slice_hash, slices, split_words

#: Passages of at least this many words that several documents have are repeats.
MIN_WORDS = 50
SEED_WORDS = 8
#: Bytes of contexts that are sorted together, more only where one anchor has more.
_CHUNK_BYTES = 2 << 20
#: Anchors with more contexts than this aren't sorted by one task: see :func:`_of_hot_anchors`.
HOT_CONTEXTS = 50_000
#: Such anchors up to this many are broadcast; for more their contexts are joined.
HOT_SEEDS = 1_000_000


def anchors(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window, seed hash): which windows of ``size``
    words have which anchor, as word numbers of the batch."""
    n = len(w.start) - size + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, np.zeros(0, np.uint64)
    k = min(SEED_WORDS, size)
    run = running(w.hash)
    g = slice_hash(run, np.arange(len(w.start) - k + 1), np.arange(k, len(w.start) + 1)) * np.uint64(0x9E3779B97F4A7C15)
    g ^= g >> np.uint64(29)
    best = np.arange(len(g))
    span, width = size - k + 1, 1

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(g[a] <= g[b], a, b)

    while width * 2 <= span:
        best = lower(best[: len(best) - width], best[width:])
        width *= 2
    if width < span:
        best = lower(best[: len(best) - (span - width)], best[span - width :])
    p = np.flatnonzero(w.doc[:n] == w.doc[size - 1 :])
    a = best[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1 if len(p) else first
    return a[first], p[first], p[last], g[a[first]]


class Suffixes:
    """Comparison of suffixes of a word sequence up to ``size`` words."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size, self.run = words, size, running(words)

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return slice_hash(self.run, a, a + n) == slice_hash(self.run, b, b + n)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` have in common, ``size`` at most."""
        low = np.where(self.same(a, b, self.size), self.size, 0)
        todo = np.flatnonzero(low == 0)
        lo, hi = np.zeros(len(todo), np.int64), np.full(len(todo), self.size - 1)
        a, b = a[todo], b[todo]
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            ok = self.same(a, b, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        low[todo] = lo
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix a comes before b; words are ordered by their hashes."""
        out = np.full(len(a), or_equal)
        n = self.extension(a, b)
        differ = np.flatnonzero(n < self.size)
        a, b, n = a[differ], b[differ], n[differ]
        out[differ] = self.words[a + n] < self.words[b + n]
        return out

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes ``at`` within each (contiguous) group: a mergesort
        of all groups side by side. An item's new place in a merge is its place in
        its own run and the number of the other run's items that come before it."""
        order = np.arange(len(at))
        if not len(at):
            return order
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[begin, len(at)])
        base, room = np.repeat(begin, size), np.repeat(size, size)
        width = 1
        while width < size.max():
            use = np.flatnonzero(room > width)
            inside = use - base[use]
            left = (inside // width) % 2 == 0
            run = inside - inside % width
            lo = np.where(left, run + width, run - width)
            hi = np.minimum(lo + width, room[use])
            on = lo < room[use]
            use, inside, left, run, lo, hi = (x[on] for x in (use, inside, left, run, lo, hi))
            first, b = lo.copy(), base[use]
            own = at[order[use]]
            while len(todo := np.flatnonzero(lo < hi)):
                mid = (lo[todo] + hi[todo]) >> 1
                other = at[order[b[todo] + mid]]
                before = np.empty(len(todo), bool)
                for side in (True, False):
                    pick = left[todo] == side
                    # equal items of the left run come first
                    before[pick] = self.less(other[pick], own[todo[pick]], not side)
                lo[todo] = np.where(before, mid + 1, lo[todo])
                hi[todo] = np.where(before, hi[todo], mid)
            to = b + np.minimum(run, first) + (inside - run) + (lo - first)
            new = order.copy()
            new[to] = order[use]
            order, width = new, width * 2
        return order


def word_ids(w: Words) -> np.ndarray:
    """A number for each word, equal exactly for equal words: hashes verified by bytes."""
    order = np.argsort(w.hash, kind="stable")
    h = w.hash[order]
    same = np.flatnonzero(h[1:] == h[:-1])
    size = w.end - w.start
    odd = size[order[same]] != size[order[same + 1]]
    for lo in range(0, len(same), 1 << 15):
        part = same[lo : lo + (1 << 15)]
        a, b = order[part], order[part + 1]
        n = np.where(odd[lo : lo + (1 << 15)], 0, size[a])
        to = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(to, n)
        wrong = w.data[np.repeat(w.start[a], n) + step] != w.data[np.repeat(w.start[b], n) + step]
        if wrong.any():
            odd[lo + np.repeat(np.arange(len(n)), n)[wrong]] = True
    ids = np.empty(len(order), np.int64)
    new = np.ones(len(order), bool)
    new[same[~odd] + 1] = False
    ids[order] = np.cumsum(new)
    return ids


def repeats(w: Words, seed: np.ndarray, place: np.ndarray, owner: np.ndarray, rank: np.ndarray, size: int):
    """(context, first window, last window, kept, first owner's context): windows of
    the contexts ``w`` that several owners have. ``seed`` groups contexts, ``place``
    is the anchor's word in the context; ``rank`` orders the owners."""
    first, count = w.first[:-1], np.diff(w.first)
    n = np.maximum(count - size + 1, 0)
    context = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(context)) - np.repeat(np.cumsum(n) - n, n)
    seed = np.unique(seed, return_inverse=True)[1]
    far = place[context] - step
    group = seed[context] * (int(far.max(initial=0)) + 1) + far
    order = np.argsort(group, kind="stable")
    g = group[order]
    alone = np.ones(len(g), bool)
    alone[1:] &= g[1:] != g[:-1]
    alone[:-1] &= g[1:] != g[:-1]
    order, g = order[~alone], g[~alone]
    at = first[context[order]] + step[order]
    s = Suffixes(w.hash, size)
    sort = s.sort(at, g)
    order, at = order[sort], at[sort]
    equal = np.flatnonzero((g[1:] == g[:-1]) & (s.same(at[1:], at[:-1], size))) if len(at) else np.zeros(0, np.int64)
    if not len(equal):
        return (np.zeros(0, np.int64),) * 5
    views = np.lib.stride_tricks.sliding_window_view(word_ids(w), size)
    new = np.ones(len(at), bool)
    for lo in range(0, len(equal), 1 << 14):
        e = equal[lo : lo + (1 << 14)]
        new[e[(views[at[e]] == views[at[e + 1]]).all(axis=1)] + 1] = False
    begin = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    who = context[order]
    shared = np.minimum.reduceat(owner[who], begin) != np.maximum.reduceat(owner[who], begin)
    low = np.minimum.reduceat(rank[who], begin)
    holder = np.flatnonzero(rank[who] == low[run])
    head = np.zeros(len(begin), np.int64)
    head[run[holder[::-1]]] = who[holder[::-1]]
    ok = np.flatnonzero(shared[run])
    if not len(ok):  # owners that repeat nothing but themselves
        return (np.zeros(0, np.int64),) * 5
    c, p, f = who[ok], step[order[ok]], head[run[ok]]
    kept = rank[c] == low[run[ok]]
    back = np.lexsort((p, c))
    c, p, f, kept = c[back], p[back], f[back], kept[back]
    cut = np.ones(len(c), bool)
    cut[1:] = (c[1:] != c[:-1]) | (p[1:] != p[:-1] + 1) | (rank[f[1:]] != rank[f[:-1]])
    b = np.flatnonzero(cut)
    e = np.append(b[1:], len(c)) - 1
    return c[b], p[b], p[e], kept[b], f[b]


def _anchor_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, 1):
                w = split_words(b.column(1).slice(lo, hi - lo))
                a, p, q, seed = anchors(w, size)
                doc = w.doc[p]
                at = w.first[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed.view(np.int64)), b.column(0).slice(lo, hi - lo).take(pa.array(doc)), *(pa.array((x - at).astype(np.int32)) for x in (a, p, q))],
                    ["seed", "r", "a", "p", "q"],
                )

    return run


def _contexts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, 2):
                part = b.slice(lo, hi - lo)
                w = split_words(part.column(2))
                lists = part.column(3)
                row = pc.list_parent_indices(lists).to_numpy()
                flat = lists.flatten()
                seed, a, p, q = (flat.field(k) for k in range(4))
                a, p, q = (x.to_numpy().astype(np.int64) for x in (a, p, q))
                start, end = w.start[w.first[row] + p], w.end[w.first[row] + q + size - 1]
                for x in range(0, len(row), 1 << 14):
                    y = slice(x, x + (1 << 14))
                    n = end[y] - start[y]
                    to = np.cumsum(n) - n
                    data = w.data[np.repeat(start[y] - to, n) + np.arange(int(n.sum()))]
                    text = pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(np.r_[to, n.sum()].astype(np.int32)), pa.py_buffer(data)])
                    at = pa.array(row[y])
                    yield pa.RecordBatch.from_arrays(
                        [seed.take(pa.array(np.arange(len(flat))[y])), part.column(0).take(at), part.column(1).take(at), pa.array((a - p)[y].astype(np.int32)), pa.array(p[y].astype(np.int32)), text],
                        ["seed", "r", "id", "a", "p", "context"],
                    )

    return run


def _expanded(w: Words, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, word number) of every window in ranges of first windows."""
    n = last - first + 1
    row = np.repeat(np.arange(len(n)), n)
    return row, np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _words_of(w: Words, at: np.ndarray, size: int) -> pa.Array:
    """The words of windows, whatever white space stood between them."""
    raw = w.data.tobytes()
    words = [raw[a:e] for a, e in zip(w.start.tolist(), w.end.tolist())]
    return pa.array([b" ".join(words[a : a + size]) for a in at.tolist()], pa.binary())


def _windows_of_seeds(size: int, held):
    """Every window whose anchor is one of the (sorted) seeds, from the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = held.value
        for b in batches:
            for lo, hi in slices(b, 2, 1 << 17):
                part = b.slice(lo, hi - lo)
                w = split_words(part.column(2))
                _, p, q, seed = anchors(w, size)
                seed = seed.view(np.int64)
                hot = np.flatnonzero(seeds[np.minimum(np.searchsorted(seeds, seed), len(seeds) - 1)] == seed)
                if not len(hot):
                    continue
                _, at = _expanded(w, p[hot], q[hot])
                doc = w.doc[at]
                r = pa.array(doc)
                yield pa.RecordBatch.from_arrays([part.column(0).take(r), part.column(1).take(r), pa.array((at - w.first[doc]).astype(np.int32)), _words_of(w, at, size)], ["r", "id", "start", "words"])

    return run


def _windows(size: int):
    """Every window of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, 5, 1 << 17):
                part = b.slice(lo, hi - lo)
                w = split_words(part.column(5))
                row, at = _expanded(w, w.first[:-1], np.maximum(w.first[1:] - size, w.first[:-1] - 1))
                r = pa.array(row)
                start = part.column(4).take(r).to_numpy() + at - w.first[row]
                yield pa.RecordBatch.from_arrays([part.column(1).take(r), part.column(2).take(r), pa.array(start.astype(np.int32)), _words_of(w, at, size)], ["r", "id", "start", "words"])

    return run


def _of_hot_anchors(windows: DataFrame, size: int) -> DataFrame:
    """The same rows as :func:`_sorted` for anchors that too many contexts have for one
    task: their windows (r, id, start, words) are grouped by digest, combined before
    they move, and each group's words are compared; groups of one digest with
    different words are grouped by the words themselves."""
    w = windows.withColumn("k", F.md5("words"))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("r").alias("r"))

    def firsts(rows: DataFrame, *keys: str) -> DataFrame:
        shared = rows.groupBy(*keys).agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.min(order).alias("first"), F.min("words").alias("one"), F.max("words").alias("other"))
        return shared.where("lo <> hi")

    groups, _ = written(firsts(w, "k").select("k", "first", (F.col("one") == F.col("other")).alias("equal")), "hot-windows")
    rows = w.select("r", "id", "start", "k").join(groups.where("equal").select("k", "first"), "k")
    odd = groups.where("NOT equal").select("k")
    if not odd.isEmpty():
        mixed = w.join(odd, "k", "left_semi")
        rows = rows.unionByName(mixed.join(firsts(mixed, "k", "words").select("k", "words", "first"), ["k", "words"]).select("k", "r", "id", "start", "first"))
    kept = F.col("first.r") == F.col("r")
    return rows.select("r", "id", "start", (F.col("start") + size).alias("end"), kept.alias("kept"), F.col("first.id").alias("first"))


def _sorted(size: int):
    """Rows come in order of seed; whole seeds are taken together, in chunks."""

    def found(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        col = {n: t.column(n).chunk(0) if t.column(n).num_chunks else pa.array([], t.schema.field(n).type) for n in t.schema.names}
        w = split_words(col["context"])
        r = col["r"].to_numpy()
        # owners in order of id, then of text
        rank = pc.rank(col["id"], sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
        rank = np.unique(np.stack([rank, r], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
        c, p, q, kept, f = repeats(w, col["seed"].to_numpy(), col["a"].to_numpy().astype(np.int64), r, rank, size)
        at = col["p"].to_numpy()[c]
        c = pa.array(c, pa.int64())
        return pa.RecordBatch.from_arrays(
            [col["r"].take(c), col["id"].take(c), pa.array((at + p).astype(np.int32)), pa.array((at + q + size).astype(np.int32)), pa.array(kept.astype(bool)), col["id"].take(pa.array(f, pa.int64()))],
            ["r", "id", "start", "end", "kept", "first"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, nbytes = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            seed = b.column(0).to_numpy()
            held.append(b)
            nbytes += b.nbytes
            cut = int(np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]])[-1])
            over = bool(len(held) > 1 and held[-2].column(0)[-1].as_py() != seed[0])
            if nbytes >= _CHUNK_BYTES and (cut or over):
                yield found(pa.Table.from_batches([*held[:-1], b.slice(0, cut)]))
                held = [b.slice(cut)]
                nbytes = held[0].nbytes
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def _spans(docs: DataFrame, i: str, t: str, size: int) -> DataFrame:
    """(r, id, start, end, kept, first) of merged spans; r is the row's identity."""
    if size < 1:
        raise ValueError("min_words must be at least 1")
    kind = docs.schema[i].dataType.simpleString()
    d = docs.where(F.col(t).isNotNull()).select(F.xxhash64(identity(i, t), F.col(t)).alias("r"), F.col(i).alias("id"), F.col(t).alias("text"))
    rows = d.select("r", "text").mapInArrow(_anchor_rows(size), "seed long, r long, a int, p int, q int")
    by_seed = Window.partitionBy("seed")
    several = rows.withColumns({"lo": F.min("r").over(by_seed), "hi": F.max("r").over(by_seed), "n": F.count("*").over(by_seed)}).where("lo <> hi")
    several, _ = written(several.select("seed", "r", "a", "p", "q", (F.col("n") > HOT_CONTEXTS).alias("hot")), "anchors")

    def contexts(own: DataFrame) -> DataFrame:
        lists = own.groupBy("r").agg(F.collect_set(F.struct("seed", "a", "p", "q")).alias("list"))
        return d.join(lists, "r").select("r", "id", "text", "list").mapInArrow(_contexts(size), f"seed long, r long, id {kind}, a int, p int, context string")

    parts = contexts(several.where("NOT hot")).repartition("seed").sortWithinPartitions("seed").mapInArrow(_sorted(size), f"r long, id {kind}, start int, end int, kept boolean, first {kind}")
    hot = several.where("hot").select("seed").distinct()
    if n := hot.count():
        schema = f"r long, id {kind}, start int, words binary"
        if n <= HOT_SEEDS:  # the documents are read again, their texts don't move
            held = docs.sparkSession.sparkContext.broadcast(np.sort(hot.toArrow()["seed"].to_numpy()))
            windows = d.mapInArrow(_windows_of_seeds(size, held), schema)
        else:
            windows = contexts(several.where("hot")).mapInArrow(_windows(size), schema)
        parts = parts.unionByName(_of_hot_anchors(windows, size))
    own = Window.partitionBy("r", "kept").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("reach") >= F.col("start"), 0).otherwise(1)).over(own.rowsBetween(Window.unboundedPreceding, 0))
    return (
        parts.distinct()
        .withColumn("reach", reach)
        .withColumn("island", island)
        .groupBy("r", "kept", "island")
        .agg(F.min("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first"))
        .drop("island")
    )


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, n_words, kept, first_doc_id): the spans of each
    document that lie in passages of at least ``min_words`` words which another
    document has word for word. Words are what ASCII white space separates.

    ``kept`` spans are those that no document with a smaller id has; the others
    repeat what ``first_doc_id``, the smallest of the ids that hold their parts,
    keeps. Null, empty and shorter texts have no spans. Null ids sort last and stay
    null; rows that repeat id and text are one document; rows of one id with
    different texts, and rows without an id with different texts, are several.
    Extra columns are not read.
    """
    d, (i, t) = positional(docs, id_col, text_col)
    s = _spans(d, i, t, min_words)
    return s.select(F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"), (F.col("end") - F.col("start")).alias("n_words"), "kept", F.col("first").alias("first_doc_id"))


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span cut out that isn't kept in :func:`repeated_spans`;
    all rows and columns stay, a text may become empty."""
    d, (i, t) = positional(docs, id_col, text_col)
    names = d.columns
    at, width = names.index(t), len(names)
    cuts = _spans(d, i, t, min_words).where("not kept").groupBy("r").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    cuts, _ = written(cuts, "cuts")
    joined = d.withColumn("_r", F.xxhash64(identity(i, t), F.col(t))).join(cuts, F.col("_r") == F.col("r"), "left").select(*d.columns, "_cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(at), b.column(width)):
                if not spans.is_valid or not text.is_valid:
                    out.append(text.as_py())
                    continue
                w = split_words(pa.array([text.as_py()]))
                raw, keep, done = w.data.tobytes(), [], 0
                for x in spans.as_py():
                    keep.append(raw[done : w.start[x["start"]]])
                    done = w.start[x["end"]] if x["end"] < len(w.start) else len(raw)
                out.append((b"".join(keep) + raw[done:]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if k == at else b.column(k) for k in range(width)], names)

    return joined.mapInArrow(run, d.schema).toDF(*docs.columns)
