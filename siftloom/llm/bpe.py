"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The words (pieces before merging) of the whole corpus are counted; the frequent
ones are merged once and compiled, with their ids, into a minimal acyclic
transducer that every Python worker memory-maps. Encoding splits a batch of texts
into pieces, steps all distinct ones through the automaton together, and merges
exactly those that it doesn't have. What the lexicon holds changes the speed only.
"""

from __future__ import annotations

import base64
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashmap, transducer
from .common import expire, positional, remove, shared_dir, written
from .pretokens import pieces
from .textkernel import BYTE_TABLE, mix, running, slice_hash, slices, utf8_buffer

#: File of base64 tokens and ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Most words in the lexicon, those that occur most often; longer words than this many bytes are never in it.
LEXICON_WORDS = 1 << 17
LONGEST_WORD = 32
_NEVER = np.int32(2**31 - 1)
_SHIFT = 20
#: Pieces up to this many bytes are merged side by side in a matrix, longer ones one by one.
_MATRIX = 128


def read_vocabulary(path: str) -> list[bytes]:
    """Tokens by rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    return tokens


def tables(tokens: list[bytes]) -> dict[str, np.ndarray]:
    """What merging and decoding need: id of each byte, merged id of each pair of
    ids, and the tokens' bytes."""
    rank = {t: r for r, t in enumerate(tokens) if t}
    keys, merged = [], []
    for r, t in enumerate(tokens):
        for k in range(1, len(t)):
            a, b = rank.get(t[:k]), rank.get(t[k:])
            if a is not None and b is not None:
                keys.append(a << _SHIFT | b)
                merged.append(r)
    pair_keys, pair_ids = hashmap.build(np.array(keys, np.int64), np.array(merged, np.int32))
    return {
        "bytes": np.array([rank[bytes([k])] for k in range(256)], np.int32),
        "pair_keys": pair_keys,
        "pair_ids": pair_ids,
        "token_data": np.frombuffer(b"".join(tokens), np.uint8),
        "token_at": np.cumsum([0, *map(len, tokens)]),
    }


def _merged(t: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return hashmap.find((t["pair_keys"], t["pair_ids"]), left.astype(np.int64) << _SHIFT | right, _NEVER)


def _one_by_one(t: dict, ids: np.ndarray) -> np.ndarray:
    """Merges of one piece with a heap over linked neighbours: for vocabularies in
    which a merge may bring up a pair of a lower rank."""
    import heapq

    if "_ranks" not in t:
        used = t["pair_keys"] >= 0
        t["_ranks"] = dict(zip(t["pair_keys"][used].tolist(), t["pair_ids"][used].tolist()))
    rank = t["_ranks"].get
    n = len(ids)
    tok, nxt, prv = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(tok, tok[1:])) if (r := rank(a << _SHIFT | b)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = nxt[i] if tok[i] is not None else n
        if tok[i] != a or j >= n or tok[j] != b:
            continue
        tok[i], tok[j] = r, None
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            if (m := rank(r << _SHIFT | tok[k])) is not None:
                heapq.heappush(heap, (m, i, r, tok[k]))
        if (k := prv[i]) >= 0 and (m := rank(tok[k] << _SHIFT | r)) is not None:
            heapq.heappush(heap, (m, k, tok[k], r))
    return np.array([x for x in tok if x is not None], np.int32)


def merge_long(t: dict, ids: np.ndarray) -> np.ndarray:
    """Merges of one piece of any length, rank by rank: all places of the lowest
    rank are merged at once, of overlapping ones the leftmost, which is what one
    merge after another gives as long as merges only bring up higher ranks."""
    import heapq

    n = len(ids)
    tok = np.append(ids, -1).astype(np.int32)
    nxt, prv = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    rank = np.full(n + 1, _NEVER, np.int32)
    rank[: n - 1] = _merged(t, ids[:-1], ids[1:])
    there = np.ones(n, bool)
    places: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def put(at: np.ndarray) -> None:
        at = at[np.argsort(rank[at], kind="stable")]
        r = rank[at]
        cut = np.flatnonzero(r[1:] != r[:-1]) + 1
        for part in np.split(at, cut) if len(at) else []:
            own = int(rank[part[0]])
            if own not in places:
                places[own] = []
                heapq.heappush(heap, own)
            places[own].append(part)

    put(np.flatnonzero(rank != _NEVER).astype(np.int32))
    while heap:
        r = heapq.heappop(heap)
        at = np.unique(np.concatenate(places.pop(r)))
        at = at[rank[at] == r]
        if not len(at):
            continue
        chained = np.r_[False, nxt[at[:-1]] == at[1:]]
        run = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        tok[at], nxt[at], rank[gone], there[gone] = r, after, _NEVER, False
        prv[after] = at
        left = prv[at]
        touched = np.unique(np.r_[at, left[left >= 0]])
        right = nxt[touched]
        rank[touched] = _NEVER
        inside = right < n
        rank[touched[inside]] = _merged(t, tok[touched[inside]], tok[right[inside]])
        new = rank[touched]
        if (new < r).any():
            return _one_by_one(t, ids)
        put(touched[new != _NEVER])
    return tok[:n][there]


def merge(t: dict, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, ids of each piece): exact merges of slices of ``data``. Again and
    again the lowest-ranked pair of neighbours, the leftmost of several, is merged."""
    size = end - start
    count = np.zeros(len(start), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # (pieces, matrix of ids)
    low = 0
    for width in (4, 8, 12, 16, 24, 32, 64, _MATRIX):
        own = np.flatnonzero((size > low) & (size <= width))
        low = width
        part = (1 << 20) // width
        for lo in range(0, len(own), part):
            rows = own[lo : lo + part]
            at = start[rows, None] + np.arange(width)
            inside = np.arange(width) < size[rows, None]
            ids = np.where(inside, t["bytes"][data[np.where(inside, at, 0)]], -1).astype(np.int32)
            rank = np.full((len(rows), width), _NEVER, np.int32)
            y, x = np.nonzero(inside[:, 1:])
            rank[y, x] = _merged(t, ids[y, x], ids[y, x + 1])
            n = size[rows].copy()
            live = np.arange(len(rows))
            move = np.arange(width)
            while len(live):
                r = rank[live]
                best = r.argmin(axis=1)
                new = r[np.arange(len(live)), best]
                go = new != _NEVER
                live, best, new, r = live[go], best[go], new[go], r[go]
                if not len(live):
                    break
                pick = np.minimum(move + (move > best[:, None]), width - 1)
                i = np.take_along_axis(ids[live], pick, axis=1)
                # the pair that goes on from the merged id takes the place of the pair that was merged
                r = np.take_along_axis(r, np.minimum(move + (move >= best[:, None]), width - 1), axis=1)
                k = np.arange(len(live))
                i[k, best] = new
                n[live] -= 1
                i[move >= n[live, None]] = -1
                r[move >= n[live, None] - 1] = _NEVER
                for place in (best - 1, best):
                    ok = np.flatnonzero((place >= 0) & (place + 1 < n[live]))
                    p = place[ok]
                    r[ok, p] = _merged(t, i[ok, p], i[ok, p + 1])
                ids[live], rank[live] = i, r
            count[rows] = n
            parts.append((rows, ids))
    for row in np.flatnonzero(size > _MATRIX):
        ids = merge_long(t, t["bytes"][data[start[row] : end[row]]])
        count[row] = len(ids)
        parts.append((np.array([row]), ids[None, :]))
    first = np.cumsum(count) - count
    flat = np.zeros(int(count.sum()), np.int32)
    for rows, ids in parts:
        inside = np.arange(ids.shape[1]) < count[rows, None]
        flat[(first[rows, None] + np.arange(ids.shape[1]))[inside]] = ids[inside]
    return flat, count


def _spread(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[first : first + count] of each row, end to end."""
    to = np.cumsum(count) - count
    return flat[np.repeat(first - to, count) + np.arange(int(count.sum()))]


def distinct_pieces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of the distinct pieces, which of them each piece is, and where
    all pieces start. Pieces are equal if their 64-bit hashes and lengths are."""
    start, end = pieces(data, off)
    h = mix(slice_hash(running(BYTE_TABLE[data]), start, end) + (end - start).astype(np.uint64))
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    one = order[new]
    return start[one], end[one], which, start


def encode_batch(t: dict, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, where each text's ids begin, and the end)."""
    data, off = utf8_buffer(texts)
    start, end, which, all_start = distinct_pieces(data, off)
    place = transducer.look_up(t, data, start, end)
    known, rest = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
    merged, count = merge(t, data, start[rest], end[rest])
    size = np.zeros(len(start), np.int64)
    word_at = t["word_at"]
    size[known], size[rest] = word_at[place[known] + 1] - word_at[place[known]], count
    first = np.zeros(len(start), np.int64)
    first[known], first[rest] = word_at[place[known]], len(t["word_ids"]) + np.cumsum(count) - count
    flat = _spread(np.concatenate([t["word_ids"], merged]), first[which], size[which])
    total = np.r_[0, np.cumsum(size[which])]
    return flat, total[np.searchsorted(all_start, off)]


def decode_batch(t: dict, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each id's bytes begin, and the end)."""
    at = t["token_at"]
    if len(flat) and (flat.min() < 0 or flat.max() >= len(at) - 1):
        raise ValueError("an id is not in the vocabulary")
    size = at[flat + 1] - at[flat]
    return _spread(t["token_data"], at[flat], size), np.r_[0, np.cumsum(size)]


# The lexicon.


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, n) over all texts, words longer than ``LONGEST_WORD`` left out."""
    d, (t,) = positional(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, 0, 2 << 20):
                data, off = utf8_buffer(b.column(0).slice(lo, hi - lo))
                start, end, which, _ = distinct_pieces(data, off)
                n = np.bincount(which, minlength=len(start))
                own = end - start <= LONGEST_WORD
                start, size, n = start[own], (end - start)[own], n[own]
                words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.py_buffer(_spread(data, start, size))])
                yield pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])

    return d.select(t).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, size: int = LEXICON_WORDS, text_col: str = "text") -> list[bytes]:
    """The words that occur most often, of those that occur again: as many whole
    levels of their counts (sixteen to a doubling) as ``size`` words hold; sorted.

    The levels are counted first, so nothing but the chosen words reaches the driver.
    """
    counts, path = written(word_counts(docs, text_col).where("n > 1").withColumn("level", F.floor(F.log2("n") * 16).cast("int")), "word-counts")
    total, least = 0, None
    for r in counts.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        total += r["words"]
        if total > size:
            break
        least = r["level"]
    found = [] if least is None else sorted(bytes(r["word"]) for r in counts.where(F.col("level") >= least).select("word").collect())
    remove(docs.sparkSession, path)
    return found


@dataclass(frozen=True)
class Codec:
    """Name of the lexicon file that the session hands to all executors."""

    name: str


def build_codec(spark: SparkSession, words: list[bytes], vocabulary: str = VOCABULARY) -> Codec:
    """Merge and compile ``words``, and hand the file, written in the shared folder,
    to all executors."""
    t = tables(read_vocabulary(vocabulary))
    joined = np.frombuffer(b"".join(words), np.uint8)
    at = np.cumsum([0, *map(len, words)]).astype(np.int64)
    t["word_ids"], count = merge(t, joined, at[:-1], at[1:])
    t["word_at"] = np.r_[0, np.cumsum(count)]
    t |= transducer.compile_words(words)
    head, blob, place = {}, [], 0
    for name, a in t.items():
        if name[0] == "_":
            continue
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = [a.dtype.str, len(a), place]
        pad = -len(raw) % 64
        blob.append(raw + b"\0" * pad)
        place += len(raw) + pad
    top = json.dumps(head).encode()
    name = f"bpe-{uuid.uuid4().hex}.lexicon"
    path = f"{shared_dir(spark)}/{name}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(len(top).to_bytes(8, "little") + top + b" " * (-(8 + len(top)) % 64) + b"".join(blob)))
    out.close()
    expire(spark, path)  # executors that start later fetch it too
    spark.sparkContext.addFile(path)
    return Codec(name)


@lru_cache(maxsize=2)
def _mapped(path: str) -> dict[str, np.ndarray]:
    raw = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(raw[:8].tobytes(), "little")
    base = -(-(8 + size) // 64) * 64
    head = json.loads(raw[8 : 8 + size].tobytes())
    return {n: np.frombuffer(raw, kind, length, base + place) if length else np.zeros(0, kind) for n, (kind, length, place) in head.items()}


def load(codec: Codec) -> dict[str, np.ndarray]:
    from pyspark import SparkFiles

    return _mapped(os.path.realpath(SparkFiles.get(codec.name)))


def codec_for(docs: DataFrame, vocabulary: str = VOCABULARY, lexicon_words: int = LEXICON_WORDS, text_col: str = "text") -> Codec:
    """A codec whose lexicon holds the frequent words of ``docs``."""
    return build_codec(docs.sparkSession, frequent_words(docs, lexicon_words, text_col), vocabulary)


# Operators.


def encode(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` and the columns ``ids`` (array of int), ``n_tokens`` and ``exact``:
    whether decoding the ids gives the text again.

    A null text has null in all three; an empty one has no ids. Null ids, repeated
    rows and extra columns stay as they are; a column of ``docs`` that has one of
    the three names gives way to the new one.
    """
    d, (_, t) = positional(docs, id_col, text_col)
    at = d.columns.index(t)
    new = {"ids": "array<int>", "n_tokens": "int", "exact": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = load(codec)
        for b in batches:
            for lo, hi in slices(b, at):
                part = b.slice(lo, hi - lo)
                flat, begin, same = round_trip(lexicon, part.column(at))
                null = part.column(at).is_null().to_numpy(zero_copy_only=False)
                ids = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32), mask=np.r_[null, False]), pa.array(flat, pa.int32()))
                extra = [ids, pa.array(np.diff(begin).astype(np.int32), mask=null), pa.array(same, mask=null)]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*part.schema.names, *new])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in d.schema), *(f"{n} {k}" for n, k in new.items())])
    out = d.mapInArrow(run, schema)
    stay = [(w, n) for w, n in zip(d.columns, docs.columns) if n.lower() not in new]
    return out.select(*(w for w, _ in stay), *new).toDF(*(n for _, n in stay), *new)


def round_trip(lexicon: dict, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat ids, where each text's begin, whether they decode to the text). Pieces
    are told apart by hashes; a text that doesn't come back is merged piece by piece."""
    flat, begin = encode_batch(lexicon, texts)
    data, off = utf8_buffer(texts)
    back, byte_at = decode_batch(lexicon, flat)
    if len(back) == len(data) and (back == data).all() and (byte_at[begin] == off).all():
        return flat, begin, np.ones(len(texts), bool)
    parts, same = [], []
    for k in range(len(texts)):  # pragma: no cover - two pieces with one hash
        one = data[off[k] : off[k + 1]]
        ids, _ = merge(lexicon, one, *pieces(one, np.array([0, len(one)])))
        parts.append(ids)
        same.append(np.array_equal(decode_batch(lexicon, ids)[0], one))
    return np.concatenate(parts), np.cumsum([0, *map(len, parts)]), np.array(same)


def decode(encoded: DataFrame, codec: Codec, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` and the column ``text_col``: the text of the ids. Bytes that
    aren't UTF-8 become U+FFFD; null ids give null, an empty list the empty text;
    an id that the vocabulary lacks is an error."""
    d, (i,) = positional(encoded, ids_col)
    at = d.columns.index(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = load(codec)
        for b in batches:
            col = b.column(at)
            flat = col.flatten().to_numpy(zero_copy_only=False)
            size = pa.compute.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False)
            back, byte_at = decode_batch(lexicon, flat)
            cuts = byte_at[np.r_[0, np.cumsum(size)]]
            raw = back.tobytes()
            texts = [None if null else raw[x:y].decode("utf-8", "replace") for null, x, y in zip(col.is_null().to_pylist(), cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "_text"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in d.schema), "_text string"])
    return d.mapInArrow(run, schema).toDF(*encoded.columns, text_col)
