import random

import numpy as np
import pyarrow as pa
from helpers import edited, prose
from hypothesis import given
from hypothesis import strategies as st

from siftloom.llm import golay, neardup
from siftloom.llm.components import components


@given(st.integers(0, 2**23 - 1), st.sets(st.integers(0, 22), max_size=2))
def test_two_errors_share_a_key(word, errors):
    other = word
    for e in errors:
        other ^= 1 << e
    row, key = golay.keys(np.array([word, other]))
    assert set(key[row == 0]) & set(key[row == 1])


def test_the_code_is_perfect():
    words = np.arange(1 << 23)
    row, key = golay.keys(words[::4097])
    n = np.bincount(row)
    assert set(n) <= {1, 6} and key.max() < 4096
    row, key = golay.keys(words)
    assert len(np.unique(key)) == 4096


def texts():
    rng = random.Random(1)
    out = []
    for k in range(60):
        t = prose(rng, rng.randint(40, 300))
        out.append(t)
        for _ in range(k % 5):
            out.append(edited(rng, t, rng.choice([0.0, 0.02, 0.05, 0.08])))
    return out


def brute(f):
    root = list(range(len(f)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = []
    for a in range(len(f)):
        for b in range(a):
            if np.bitwise_count(f[a] ^ f[b]).sum() <= neardup.MOST_BITS:
                pairs.append((a, b))
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return pairs, [find(x) for x in range(len(f))]


def test_recall_against_brute_force(spark):
    t = texts()
    pairs, roots = brute(neardup.fingerprints(pa.array(t)))
    assert len(pairs) > 80
    d = spark.createDataFrame([(i, x) for i, x in enumerate(t)], "doc_id long, text string").repartition(3)
    kept = {r["doc_id"]: r["kept_id"] for r in neardup.near_duplicates(d).collect()}
    found = sum(kept[a] == kept[b] for a, b in pairs)
    assert found >= 0.9 * len(pairs)
    # nothing is joined that brute force keeps apart
    assert all(roots[i] == roots[k] for i, k in kept.items())


def test_guaranteed_distance():
    """Fingerprints at most 20 bits apart always share keys of two segments."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = rng.integers(0, 1 << 23, 8)
        b = a.copy()
        for e in rng.choice(184, 20, replace=False):
            b[e // 23] ^= 1 << (e % 23)
        shared = 0
        for x, y in zip(a, b):
            row, key = golay.keys(np.array([x, y]))
            shared += bool(set(key[row == 0]) & set(key[row == 1]))
        assert shared >= 2


def test_large_buckets_connect_like_small_ones():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 46, 4)
    f = np.stack([base ^ (1 << int(b)) for b in rng.integers(0, 46, 200)])
    f = np.unique(f, axis=0)
    node = np.arange(len(f))
    seg = neardup.segments(f)
    row, key = golay.keys(seg[:, 0])
    u, v = neardup.bucket_edges(key, node[row], f[row], 32)
    seen, todo = {0}, [0]
    while todo:
        x = todo.pop()
        for y in [*v[u == x], *u[v == x]]:
            if int(y) not in seen:
                seen.add(int(y))
                todo.append(int(y))
    assert len(seen) == len(f)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (1, 0), (500, 501)]
    c = components(spark.createDataFrame(edges, "u long, v long"))
    got = {r["node"]: r["root"] for r in c.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 500: 500, 501: 500}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
