"""The pipeline stage by stage against plain Python over a small table, and the SQL
of the corpus queries."""

import glob
import math
import os

import duckdb
import pyarrow as pa
import pytest
from conftest import DATA

import corpus_pipeline
from siftloom.llm import bpe, decontaminate, licenses, neardup, quality, queries
from siftloom.llm.common import table

SF = f"{DATA}/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before), name
        if name == "quality classifier":
            # how well the model tells is tested on held-out labels; here each row's verdict
            model: dict = {0: {}, 1: {}}
            for r in quality.train(docs, table(spark, SF, "labels")).collect():
                model[r["head"]][r["bucket"]] = r["weight"]
            want = set()
            for d, t in before.items():
                x = set(quality.features(pa.array([t]), 20)[1].tolist()) | {1 << 20}
                p = [1 / (1 + math.exp(-sum(m.get(f, 0.0) for f in x))) if m else None for m in model.values()]
                if (p[0] is None or p[0] >= 0.4) and (p[1] is None or p[1] < 0.15):
                    want.add(d)
            assert set(after) == want
        if name == "line dedup":
            norm = lambda x: " ".join(x.split()).lower()
            held: dict = {}
            for d, t in before.items():
                for x in t.split("\n"):
                    held.setdefault(norm(x), set()).add(d)
            want = {d: "\n".join(x for x in t.split("\n") if not norm(x) or len(held[norm(x)]) <= 50 or min(held[norm(x)]) == d) for d, t in before.items()}
            assert {d: r["text"] for d, r in after.items()} == {d: t for d, t in want.items() if t.strip() or t == before[d]}
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name == "SimHash near-dedup":
            ids = sorted(before)
            f = dict(zip(ids, neardup.fingerprints(pa.array([before[d] for d in ids]))))
            near = lambda a, b: bin_distance(f[a], f[b]) <= neardup.MOST_BITS
            group: dict = {}
            for d in ids:
                joined = {g for g, m in group.items() if any(near(d, x) for x in m)}
                members = [d] + [x for g in joined for x in group.pop(g)]
                group[min(members)] = members
            assert set(after) == set(group)
        if name == "benchmark decontamination":
            items = [decontaminate.tokens(pa.array([r["text"]])) for r in table(spark, SF, "benchmark").collect()]
            items = [w.hash.tolist() for w in items]
            for d, t in before.items():
                w = decontaminate.tokens(pa.array([t])).hash.tolist()
                hit = any(sum(x[2] for x in decontaminate.tiles(w, i, min(5, len(i)))) >= 0.5 * len(i) for i in items if i)
                assert (d in after) != hit
        if name.startswith("BPE"):
            assert set(after) == set(before) and all(r["exact"] for r in after.values())
        else:
            assert out.columns == table(spark, SF, "documents").columns
            before = {d: r["text"] for d, r in after.items()}
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == len(after)


def bin_distance(a, b):
    return sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(a, b))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    a, b = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    cols = sorted(a.columns)
    key = lambda d: sorted(map(repr, d[cols].astype(object).itertuples(index=False, name=None)))
    assert cols == sorted(b.columns) and key(a) == key(b)


def rows(spark, name, *cols):
    return [tuple(r[c] for c in cols) for r in queries.QUERIES[name](spark, SF).collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}


def test_query_1(spark, documents):
    """Every row's scores are the plain dot products with the trained weights."""
    model: dict = {0: {}, 1: {}}
    for r in quality.train(table(spark, SF, "documents"), table(spark, SF, "labels")).collect():
        model[r["head"]][r["bucket"]] = r["weight"]
    got = rows(spark, "op1_quality_classifier", "doc_id", "p_quality", "p_toxic")
    assert len(got) == table(spark, SF, "documents").count() and model[0] and model[1]
    for d, *p in got:
        x = set(quality.features(pa.array([documents[d]]), 20)[1].tolist()) | {1 << 20}
        for k in range(2):
            assert math.isclose(p[k], 1 / (1 + math.exp(-sum(model[k].get(f, 0.0) for f in x))), abs_tol=1e-5)


def test_query_2(spark, documents):
    import base64

    import tiktoken
    from test_bpe import PATTERN

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d, ids, n, exact in rows(spark, "op2_bpe", "doc_id", "ids", "n_tokens", "exact"):
        assert exact and n == len(ids) and ids == library.encode_ordinary(documents[d])


def test_query_3(spark, documents):
    ids = sorted(documents)
    f = neardup.fingerprints(pa.array([documents[d] for d in ids]))
    near = {(ids[a], ids[b]) for a in range(len(ids)) for b in range(a) if bin_distance(f[a], f[b]) <= neardup.MOST_BITS}
    root = {d: d for d in ids}
    for _ in ids:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(rows(spark, "op3_simhash_near_dedup", "doc_id", "kept_id"))
    assert set(got) == set(ids) and all(root[d] == root[k] for d, k in got.items())
    assert sum(got[a] == got[b] for a, b in near) >= 0.9 * len(near) > 0


def test_query_4(spark, documents):
    items = [(r["item_id"], decontaminate.tokens(pa.array([r["text"]])).hash.tolist()) for r in table(spark, SF, "benchmark").collect()]
    want = set()
    for d, t in documents.items():
        w = decontaminate.tokens(pa.array([t])).hash.tolist()
        for i, v in items:
            covered = sum(x[2] for x in decontaminate.tiles(w, v, min(5, len(v)))) if v else 0
            if v and covered >= 0.5 * len(v):
                want.add((d, i, covered, len(v)))
    assert want and set(rows(spark, "op4_benchmark_decontamination", "doc_id", "item_id", "covered", "item_tokens")) == want


def test_query_5(spark, documents):
    from test_others import distance_within, edits_between

    folded = {d: licenses.fold(t) for d, t in documents.items()}
    got = rows(spark, "op5_license_scans", "doc_id", "notice", "start", "end", "edits", "matched")
    for d, n, a, b, e, matched in got:
        assert documents[d][a:b] == matched and e == edits_between(folded[d][a:b], licenses.fold(licenses.NOTICES[n][0])) <= licenses.NOTICES[n][1]
    short = [d for d in folded if len(folded[d]) < 1500]
    want = {(d, n) for d in short for n, (t, k) in licenses.NOTICES.items() if distance_within(folded[d], licenses.fold(t), k)}
    assert want and {(d, n) for d, n, *_ in got if d in set(short)} == want


def test_query_7(spark, documents):
    from test_suffix import brute

    kept, gone = {}, {}
    for d, a, b, k in rows(spark, "op7_suffix_array_dedup", "doc_id", "start_word", "end_word", "kept"):
        (kept if k else gone).setdefault(d, set()).update(range(a, b))
    assert (kept, gone) == brute(documents, 50) and gone
