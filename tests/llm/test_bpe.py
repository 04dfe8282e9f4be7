import base64
import random

import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from helpers import prose
from hypothesis import given, settings
from hypothesis import strategies as st

from siftloom.llm import bpe, hashmap, transducer
from siftloom.llm.pretokens import pieces

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def lexicon(words):
    t = bpe.tables(bpe.read_vocabulary(bpe.VOCABULARY))
    words = sorted(set(words))
    at = np.cumsum([0, *map(len, words)]).astype(np.int64)
    t["word_ids"], n = bpe.merge(t, np.frombuffer(b"".join(words), np.uint8), at[:-1], at[1:])
    t["word_at"] = np.r_[0, np.cumsum(n)]
    return t | transducer.compile_words(words)


@pytest.fixture(scope="module")
def small():
    return lexicon([b" the", b" tiger", b"the", b"house", "été".encode()])


text = st.text(st.sampled_from(list("absrevltmd' \n\t\r12é!?ß日　٣\U0001d4b3\U0001f600 ́'")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(text, max_size=5))
def test_pieces_equal_the_pattern(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    a, b = pieces(data, off)
    assert [data[x:y].tobytes().decode() for x, y in zip(a, b)] == [m for t in texts for m in regex.findall(PATTERN, t)]


@settings(max_examples=200, deadline=None)
@given(st.lists(text, min_size=1, max_size=5))
def test_ids_equal_the_library(library, small, texts):
    flat, at, same = bpe.round_trip(small, pa.array(texts))
    assert same.all() and [flat[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == [library.encode_ordinary(t) for t in texts]


def test_long_pieces(library, small):
    for t in ("a" * 400 + "é" * 99 + "xyz" * 300, "=-" * 700, "\n" * 500, "9" * 300):
        assert bpe.round_trip(small, pa.array([t]))[0].tolist() == library.encode_ordinary(t)


def test_very_long_pieces(library, small):
    import time

    rng = random.Random(5)
    t = "".join(rng.choice("etaoinshrdlu") for _ in range(60_000)) + "a" * 30_001 + "日本語の" * 5000
    began = time.perf_counter()
    flat = bpe.round_trip(small, pa.array([t]))[0]
    assert time.perf_counter() - began < 20
    assert bpe.decode_batch(small, flat)[0].tobytes().decode() == t
    for p in regex.findall(PATTERN, t):
        ids = bpe.merge_long(small, small["bytes"][np.frombuffer(p.encode(), np.uint8)])
        assert ids.tolist() == bpe._one_by_one(small, small["bytes"][np.frombuffer(p.encode(), np.uint8)]).tolist()
    for _ in range(200):
        p = "".join(rng.choice(["a", "aa", "b", "the", "er", "ing", "é"]) for _ in range(rng.randint(60, 200)))
        assert bpe.merge_long(small, small["bytes"][np.frombuffer(p.encode(), np.uint8)]).tolist() == library._encode_single_piece(p.encode())


def test_ranks_that_fall(small):
    """A vocabulary whose merges bring up lower ranks is merged one by one."""
    tokens = [bytes([k]) for k in range(256)] + [b"abc", b"ab", b"bc", b"abcd"]
    t = bpe.tables(tokens)
    rng = random.Random(1)
    ranks = {x: i for i, x in enumerate(tokens)}
    for _ in range(100):
        p = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 300))).encode()
        parts = [p[i : i + 1] for i in range(len(p))]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        assert bpe.merge_long(t, t["bytes"][np.frombuffer(p, np.uint8)]).tolist() == [ranks[x] for x in parts]


def test_transducer_is_minimal_and_complete():
    rng = random.Random(4)
    words = sorted({("".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) + rng.choice(["", "ing", "tion"])).encode() for _ in range(400)})
    a = transducer.compile_words(words)
    joined, at = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])
    assert transducer.look_up(a, joined, at[:-1], at[1:]).tolist() == list(range(len(words)))
    other = [b"abcabcabcabc", b"zz", b"abing" * 3]
    j, o = np.frombuffer(b"".join(other), np.uint8), np.cumsum([0, *map(len, other)])
    assert (transducer.look_up(a, j, o[:-1], o[1:]) == -1).all()
    # minimal: as many states as there are different sets of endings
    rest = {p: frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in {w[:k] for w in words for k in range(len(w) + 1)}}
    assert len(a["ends"]) == len(set(rest.values()))


def test_hash_map():
    keys = np.arange(0, 50_000, 7)
    t = hashmap.build(keys, (keys % 1000).astype(np.int32))
    got = hashmap.find(t, np.arange(50_000))
    assert (got[keys] == keys % 1000).all() and (np.delete(got, keys) == -1).all()


def test_lexicon_holds_the_frequent_words(spark):
    d = spark.createDataFrame([(1, "the the the tiger tiger ox"), (2, "the tiger"), (3, None)], "doc_id long, text string")
    assert bpe.frequent_words(d, 10) == [b" the", b" tiger", b"the"] or bpe.frequent_words(d, 10) == sorted([b" the", b" tiger", b"the"])
    assert bpe.frequent_words(d, 2) in ([b" the", b" tiger"], [b" the"], [b" tiger"], [b" the", b" tiger"][:1])
    counts = {bytes(r["word"]): r["n"] for r in bpe.word_counts(d).collect()}
    assert counts == {b"the": 2, b" the": 2, b" tiger": 3, b" ox": 1}


def test_query_over_the_cluster(spark, library):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60)) for i in range(30)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in bpe.encode(d, bpe.codec_for(d)).collect():
        assert r["ids"] == library.encode_ordinary(r["text"]) and r["exact"] and r["n_tokens"] == len(r["ids"])


def test_unknown_id_is_an_error(small):
    with pytest.raises(ValueError):
        bpe.decode_batch(small, np.array([10**6]))
