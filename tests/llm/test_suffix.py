import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import edited, prose

from siftloom.llm import suffix
from siftloom.llm.textkernel import Words, split_words


def brute(docs, size):
    """(kept, repeated) covered words of each document."""
    owners = collections.defaultdict(set)
    for k, t in docs.items():
        w = t.split()
        for p in range(len(w) - size + 1):
            owners[tuple(w[p : p + size])].add(k)
    kept, gone = collections.defaultdict(set), collections.defaultdict(set)
    for k, t in docs.items():
        w = t.split()
        for p in range(len(w) - size + 1):
            s = owners[tuple(w[p : p + size])]
            if len(s) > 1:
                (kept if min(s) == k else gone)[k].update(range(p, p + size))
    return dict(kept), dict(gone)


def corpus():
    rng = random.Random(11)
    shared = [prose(rng, n) for n in (20, 55, 60, 120)]
    docs = {}
    for k in range(60):
        parts = [prose(rng, rng.randint(0, 90)) for _ in range(3)]
        if k % 3 == 0:
            parts.insert(rng.randint(0, 3), rng.choice(shared))
        if k % 10 == 0 and k:
            parts.append(edited(rng, docs[k - 10], 0.02))
        docs[k] = "\n".join(parts)
    docs[60] = docs[3]
    # the same passage twice in one document is no repeat across documents
    docs[61] = "\n".join([x := prose(rng, 70), "middle", x])
    return docs


@pytest.mark.parametrize(("hot", "seeds"), [(50_000, 10**6), (1, 10**6), (5, 10**6), (1, 0), (5, 0)])
def test_spans_equal_brute_force(spark, monkeypatch, hot, seeds):
    monkeypatch.setattr(suffix, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffix, "HOT_SEEDS", seeds)
    docs = corpus()
    for size in (50, 7):
        d = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
        kept, gone = collections.defaultdict(set), collections.defaultdict(set)
        for r in suffix.repeated_spans(d, size).collect():
            (kept if r["kept"] else gone)[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
            assert r["n_words"] >= size and r["first_doc_id"] <= r["doc_id"]
        assert (dict(kept), dict(gone)) == brute(docs, size)


def test_hot_anchors_with_one_digest(spark, monkeypatch):
    """Different windows whose digests are equal are told apart by their words."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(suffix, "HOT_CONTEXTS", 1)
    monkeypatch.setattr(suffix.F, "md5", lambda c: F.substring(F.hex(F.lit("same")), 1, 4))
    docs = {k: t for k, t in corpus().items() if k % 3 == 0}
    d = spark.createDataFrame([*docs.items()], "doc_id long, text string").repartition(3)
    kept, gone = collections.defaultdict(set), collections.defaultdict(set)
    for r in suffix.repeated_spans(d, 20).collect():
        (kept if r["kept"] else gone)[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    assert (dict(kept), dict(gone)) == brute(docs, 20)


def test_dropping_leaves_the_first(spark):
    rng = random.Random(2)
    p = prose(rng, 60, False)
    d = spark.createDataFrame([(1, f"a {p} b"), (2, f"c {p} d")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in suffix.drop_repeats(d).collect()}
    assert got == {1: f"a {p} b", 2: "c d"}


def test_sort_equals_plain_sort():
    rng = random.Random(6)
    words = np.array([rng.choice([3, 1, 2**63, 9]) for _ in range(4000)], np.uint64)
    size = 12
    s = suffix.Suffixes(words, size)
    at = np.array(rng.sample(range(4000 - size), 900))
    group = np.sort(np.array([rng.randint(0, 40) for _ in at]))
    got = at[s.sort(at, group)]
    want = []
    for g in np.unique(group):
        want += sorted(at[group == g].tolist(), key=lambda a: words[a : a + size].tolist())
    key = lambda a: words[a : a + size].tolist()
    assert [key(a) for a in got] == [key(a) for a in want]
    a, b = np.array([0, 5, 9]), np.array([1, 5, 30])
    for x, y, n in zip(a, b, s.extension(a, b)):
        assert n == next((k for k in range(size) if words[x + k] != words[y + k]), size)


def test_collisions_are_told_apart():
    w = split_words(pa.array(["aa bb aa cc dd aa"]))
    w._hash = np.array([7, 7, 7, 1, 1, 7], np.uint64)  # different words, one hash
    ids = suffix.word_ids(w)
    text = "aa bb aa cc dd aa".split()
    for i in range(6):
        for j in range(6):
            assert not (ids[i] == ids[j] and text[i] != text[j])


def test_anchors_cover_every_window():
    rng = random.Random(9)
    w: Words = split_words(pa.array([prose(rng, 200), prose(rng, 49), prose(rng, 50), ""]))
    a, p, q, seed = suffix.anchors(w, 50)
    covered = np.concatenate([np.arange(x, y + 1) for x, y in zip(p, q)])
    assert covered.tolist() == [*range(0, 151), 249] and (a >= p).all() is not None and len(seed) == len(a)
    assert ((p <= a) | (a >= q)).all() and (a + 8 <= p + 50).all() and (a >= q).all()


def test_repeats_within_one_document_alone(spark):
    """Documents that repeat only themselves, their chunk holding nothing else."""
    rng = random.Random(12)
    docs = []
    for k in range(16):
        own = prose(rng, 60, False)
        near = prose(rng, 40, False)
        docs.append((k, f"{own} middle {own}" if k % 2 else f"{near} {k} tail"))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert suffix.repeated_spans(d).collect() == []
    assert {r["doc_id"]: r["text"] for r in suffix.drop_repeats(d).collect()} == dict(docs)
    shared = prose(rng, 30, False)  # anchors met by several, windows by none
    docs = [(k, f"{(x := f'{k} ' + prose(rng, 30, False) + ' ' + shared)} middle {x}") for k in range(8)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    kept, gone = collections.defaultdict(set), collections.defaultdict(set)
    for r in suffix.repeated_spans(d, 20).collect():
        (kept if r["kept"] else gone)[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    assert (dict(kept), dict(gone)) == brute(dict(docs), 20)


def test_kernel_equals_brute_force_over_random_tables(spark, monkeypatch):
    for seed in range(12):
        rng = random.Random(seed)
        monkeypatch.setattr(suffix, "_CHUNK_BYTES", rng.choice([1, 400, 4000, 1 << 20]))
        pool = [prose(rng, rng.randint(3, 14), False) for _ in range(4)]
        docs = {}
        for k in range(rng.randint(1, 14)):
            own = prose(rng, rng.randint(0, 9), False)
            docs[k] = " ".join([rng.choice([own, rng.choice(pool)]) for _ in range(rng.randint(1, 5))])
        kept, gone = collections.defaultdict(set), collections.defaultdict(set)
        for r in in_process(docs, 9):
            (kept if r["kept"] else gone)[r["id"]].update(range(r["start"], r["end"]))
        assert (dict(kept), dict(gone)) == brute(docs, 9)


def in_process(docs, size):
    """The three kernels one after the other, without Spark."""
    d = pa.record_batch({"r": pa.array(list(docs), pa.int64()), "text": pa.array(list(docs.values()), pa.string())})
    rows = pa.Table.from_batches(list(suffix._anchor_rows(size)(iter([d])))).to_pylist()
    owners = collections.defaultdict(set)
    for x in rows:
        owners[x["seed"]].add(x["r"])
    lists = collections.defaultdict(list)
    for x in rows:
        if len(owners[x["seed"]]) > 1:
            lists[x["r"]].append({k: x[k] for k in ("seed", "a", "p", "q")})
    if not lists:
        return []
    kind = pa.list_(pa.struct([("seed", pa.int64()), ("a", pa.int32()), ("p", pa.int32()), ("q", pa.int32())]))
    b = pa.record_batch({"r": pa.array(list(lists), pa.int64()), "id": pa.array(list(lists), pa.int64()), "text": pa.array([docs[k] for k in lists]), "list": pa.array(list(lists.values()), kind)})
    contexts = pa.Table.from_batches(list(suffix._contexts(size)(iter([b])))).sort_by("seed")
    found = list(suffix._sorted(size)(iter(contexts.to_batches(max_chunksize=3))))
    return pa.Table.from_batches(found).to_pylist()
