"""Nulls in any column, empty and very long texts, ties and repeated rows, empty
tables and extra columns with clashing names, for every operator and stage."""

import random

import pytest
from helpers import prose
from pyspark.sql import functions as F

import corpus_pipeline
from siftloom.llm import bpe, decontaminate, exact, licenses, lines, neardup, quality, sharding, suffix, warc

COLS = "doc_id long, text string, lang string, source string, n_chars long"


def clash():
    return {"id": F.lit("x"), "r": F.lit(1), "seed": F.lit(2.0), "node": F.lit(None).cast("string"), "bucket": F.lit(3), "h": F.lit("y"), "_c0": F.lit(5), "dg": F.lit(6), "kept": F.lit(True), "N": F.lit(7)}



def rows():
    rng = random.Random(3)
    long = prose(rng, 30_000)
    same = prose(rng, 80)
    return [
        (1, same, "en", "a", 1), (2, same, "en", "a", 1), (2, same, "en", "a", 1), (3, None, None, None, None), (None, same, "en", "a", 1), (None, None, None, None, None),
        (4, "", "en", "a", 0), (5, "", "en", "a", 0), (6, long, "en", "b", len(long)), (7, "   \n\n\t", None, "b", 5), (8, "word", "en", None, 4), (None, "", None, None, 0), (9, "Ünï © \U0001F600　x", "de", "c", 9),
    ]


@pytest.fixture(scope="module")
def full(spark):
    return spark.createDataFrame(rows(), COLS).withColumns(clash())


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLS).withColumns(clash())


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (6, 0, 1), (None, 1, 1), (8, None, None), (9, 1, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "seven green moons and a lazy paper house of light"), (2, None), (None, ""), (3, "word")], "item_id long, text string")


def ran(spark, df):
    """All rows of a frame, which therefore was computed."""
    return [tuple(r) for r in df.collect()]


def test_quality(spark, full, empty, labels):
    got = quality.classify(full, labels).collect()
    assert len(got) == 13 and all(r["kept"] is not None for r in got)
    assert ran(spark, quality.classify(empty, labels)) == []
    blank = quality.classify(full, labels.limit(0)).collect()
    assert all(r["kept"] and r["p_quality"] is None for r in blank)
    kept = quality.quality_filter(full, labels)
    assert kept.columns == full.columns and kept.count() <= 13


def test_bpe(spark, full, empty):
    codec = bpe.codec_for(full)
    got = {(r["doc_id"], r["text"]): r for r in bpe.encode(full.drop("bucket").withColumn("IDS", F.lit(1)), codec).collect()}
    assert got[3, None]["ids"] is None and got[3, None]["exact"] is None and got[3, None]["n_tokens"] is None
    assert got[4, ""]["ids"] == [] and got[4, ""]["exact"] is True
    assert all(r["exact"] for (_, t), r in got.items() if t is not None)
    assert ran(spark, bpe.encode(empty, bpe.codec_for(empty))) == []
    back = bpe.decode(bpe.encode(full, codec), codec)
    assert back.where(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0


def test_near_duplicates(spark, full, empty):
    got = sorted(ran(spark, neardup.near_duplicates(full)), key=repr)
    assert len(got) == 13
    by = {}
    for d, k, dup in got:
        by.setdefault(d, []).append((k, dup))
    assert by[2] == [(1, True)] * 2 and by[1] == [(1, False)] and by[5] == [(4, True)] and by[7] == [(4, True)] and by[3] == [(3, False)] and by[6] == [(6, False)]
    assert sorted(by[None], key=repr) == [(1, True), (4, True), (None, False)]
    kept = neardup.near_dedup(full)
    assert kept.columns == full.columns
    assert sorted((r["doc_id"] or 0, r["text"] is None) for r in kept.collect()) == [(0, True), (1, False), (3, True), (4, False), (6, False), (8, False), (9, False)]
    assert ran(spark, neardup.near_duplicates(empty)) == [] and ran(spark, neardup.near_dedup(empty)) == []


def test_near_dedup_without_ids(spark):
    d = spark.createDataFrame([(None, "alpha beta gamma"), (None, "Alpha, beta gamma"), (None, None)], "doc_id long, text string")
    assert neardup.near_dedup(d).count() == 2
    d = spark.createDataFrame([(None, "alpha beta gamma", 1), (None, "alpha beta gamma", 2), (7, "delta epsilon", 3), (None, "delta epsilon", 4)], "doc_id long, text string, x int")
    assert [r["doc_id"] for r in neardup.near_dedup(d).collect() if r["text"][0] == "d"] == [7] and neardup.near_dedup(d).count() == 2


def test_near_dedup_of_one_id_with_several_texts(spark):
    rng = random.Random(8)
    a, b = prose(rng, 90), " ".join(f"other{k} words{k}" for k in range(60))
    d = spark.createDataFrame([(1, a), (5, a), (5, b), (5, b), (6, b + " more"), (2, a + " tail")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"] == a, r["text"] == b) for r in neardup.near_dedup(d).collect()) == [(1, True, False), (5, False, True), (5, False, True)]


def test_decontamination(spark, full, empty, bench):
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contamination(full, bench).collect()}
    assert (8, 3) in got and all(i is not None for _, i in got)
    kept = decontaminate.decontaminate(full, bench)
    assert kept.columns == full.columns and 8 not in {r["doc_id"] for r in kept.collect()}
    assert kept.where("text is null").count() == 2
    assert ran(spark, decontaminate.contamination(empty, bench)) == [] and decontaminate.decontaminate(full, bench.limit(0)).count() == 13


def test_licenses(spark, full, empty):
    assert ran(spark, licenses.license_scan(full)) == [] and ran(spark, licenses.license_scan(empty)) == []


def test_sharding(spark, full, empty):
    got = sharding.assign_shards(full, 8, 2).collect()
    assert len(got) == 13 and len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert ran(spark, sharding.assign_shards(empty, 8)) == []
    with pytest.raises(Exception):
        sharding.jump_hash(__import__("numpy").zeros(1, "uint64"), 0)


def test_suffix(spark, full, empty):
    got = {(r["doc_id"], r["start_word"], r["end_word"], r["kept"], r["first_doc_id"]) for r in suffix.repeated_spans(full).collect()}
    assert got == {(1, 0, 80, True, 1), (2, 0, 80, False, 1), (None, 0, 80, False, 1)}
    cut = suffix.drop_repeats(full)
    assert cut.columns == full.columns and cut.count() == 13
    assert {r["text"] for r in cut.where("doc_id = 2").collect()} == {""}
    assert ran(spark, suffix.repeated_spans(empty)) == [] and ran(spark, suffix.drop_repeats(empty)) == []


@pytest.mark.parametrize("most", [10**6, 0])
def test_lines(spark, full, empty, monkeypatch, most):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", most)
    got = lines.line_dedup(full, max_docs=1)
    assert got.columns == full.columns and got.count() == 13
    by = {r["doc_id"]: r["text"] for r in got.where("doc_id is not null").collect()}
    assert by[2] == "" and by[1] != "" and by[3] is None and by[4] == "" and by[7] == "   \n\n\t"
    assert ran(spark, lines.line_dedup(empty)) == []


def test_exact(spark, full, empty):
    got = ran(spark, exact.exact_dedup(full))
    assert len(got) == 13
    heads = {d: k for d, k, _ in got}
    assert heads[1] == heads[2] and heads[4] == heads[5] and heads[7] == 7 and heads[6] == 6
    assert ran(spark, exact.exact_dedup(empty)) == []


def test_warc(spark):
    p = spark.createDataFrame([(1, "https://a.com", "x" * 10_000), (1, "https://a.com", "x" * 10_000), (2, None, None), (None, "https://b.com\r\nX: y", ""), (3, "u", "ü")], "page_id long, url string, html string").withColumns({"record_id": F.lit(1), "chunk_no": F.lit("z")})
    got = warc.pages_as_chunks(p, 4096).collect()
    assert len(got) == 9 and all(r["intact"] for r in got)
    assert [r["payload"] for r in got if r["page_id"] == 2] == [None] and [bytes(r["payload"]) for r in got if r["page_id"] is None] == [b""]
    assert next(r["url"] for r in got if r["page_id"] is None) == "https://b.comX: y"
    assert ran(spark, warc.pages_as_chunks(p.limit(0))) == []


def test_stages(spark, full, empty, labels, bench, tmp_path):
    for name, t in (("labels", labels), ("benchmark", bench)):
        t.write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, full, str(tmp_path))
        assert out.columns[: len(full.columns)] == full.columns, name
        assert 0 < len(out.collect()) <= 13
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_the_chain_of_stages(spark, full, empty, labels, bench, tmp_path):
    """``run`` over nulls, empties, repeats and clashing names, and over nothing."""
    for name, t in (("labels", labels), ("benchmark", bench)):
        t.write.parquet(f"{tmp_path}/a/{name}.parquet")
        t.write.parquet(f"{tmp_path}/b/{name}.parquet")
    full.drop("bucket").write.parquet(f"{tmp_path}/a/documents.parquet")
    empty.drop("bucket").write.parquet(f"{tmp_path}/b/documents.parquet")
    docs = full.drop("bucket")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, f"{tmp_path}/a")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a")
    key = lambda r: repr((r["doc_id"], r["text"], r["n_tokens"]))
    assert sorted(map(key, got.collect())) == sorted(map(key, docs.collect())) and got.columns == docs.columns
    assert all(r["exact"] for r in got.collect() if r["text"] is not None)
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []
