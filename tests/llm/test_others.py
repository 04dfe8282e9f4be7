"""Classifier, decontamination, licences, sharding, lines, exact copies, WARC."""

import collections
import gzip
import hashlib
import io
import math
import random
import time

import numpy as np
import pytest
from conftest import DATA
from helpers import prose

from siftloom.llm import decontaminate, exact, fuse, licenses, lines, quality, sharding, warc
from siftloom.llm.common import table


def test_classifier_on_held_out_labels(spark):
    docs, labels = table(spark, f"{DATA}/sf0.1", "documents"), table(spark, f"{DATA}/sf0.1", "labels")
    train, held = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0").toPandas().drop_duplicates("doc_id").set_index("doc_id")
    got = quality.classify(docs, train).toPandas().set_index("doc_id").loc[held.index]
    clean = (held.quality == 1) & (held.toxic == 0)
    assert got.kept[clean].mean() > 0.99
    assert got.kept[held.toxic == 1].mean() < 0.05
    assert got.kept[held.quality == 0].mean() < 0.05


def slow_ftrl(rows, y, s):
    """One coordinate after another, as the update is published."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for x, label in zip(rows, y):
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(weight(i) for i in x)))))
            for i in x:
                w, g = weight(i), p - label
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha
                z[i] += g - sigma * w
                n[i] += g * g
    return {i: weight(i) for i in list(z)}


def test_ftrl_equals_plain_python():
    rng = random.Random(2)
    s = quality.Settings(bits=6, l1=0.3, epochs=3)
    rows, y = [], []
    for _ in range(120):
        label = rng.random() < 0.4
        x = {rng.randrange(20 if label else 10, 60) for _ in range(8)} | {64}
        rows.append(np.array(sorted(x)))
        y.append(float(label))
    got, want = quality.ftrl(rows, np.array(y), s), slow_ftrl([x.tolist() for x in rows], y, s)
    assert all(math.isclose(got[i], want.get(i, 0.0), abs_tol=1e-9) for i in range(65)) and sum(w != 0 for w in want.values()) > 15


def test_labels_of_one_class_only(spark):
    docs = spark.createDataFrame([(k, f"words of document {k} here") for k in range(30)], "doc_id long, text string")
    for good in (0, 1):
        labels = spark.createDataFrame([(k, good, 0) for k in range(20)], "doc_id long, quality int, toxic int")
        assert {r["kept"] for r in quality.classify(docs, labels).collect()} == {bool(good)}


def test_tiles_find_moved_parts():
    item = list("abcdefghijklmnop")
    doc = [*"xx", *item[8:], *"yy", *item[:8], "z"]
    assert sorted(decontaminate.tiles(doc, item, 4)) == [(2, 8, 8), (12, 0, 8)]
    assert decontaminate.tiles(list("abcabc"), list("abc"), 3) == [(0, 0, 3)]


def brute_tiles(doc, item, least):
    out, md, mi = [], set(), set()
    while True:
        best = None
        for p in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while p + n < len(item) and d + n < len(doc) and item[p + n] == doc[d + n] and p + n not in mi and d + n not in md:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (d, p, n)
        if best is None:
            return out
        out.append(best)
        md |= set(range(best[0], best[0] + best[2]))
        mi |= set(range(best[1], best[1] + best[2]))


def test_tiles_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        item, doc = [[rng.choice("abc") for _ in range(rng.randint(0, 14))] for _ in range(2)]
        assert sum(t[2] for t in decontaminate.tiles(doc, item, 3)) == sum(t[2] for t in brute_tiles(doc, item, 3))


def test_contamination_in_parts_is_the_same(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, 30)) for i in range(12)]
    docs = []
    for k in range(40):
        words = prose(rng, 60, False).split()
        if k % 4 == 0:
            w = items[k % 12][1].split()
            words[10:10] = w[15:] + ["between"] + w[:15]  # reordered
        docs.append((k, " ".join(words)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.contamination(d, b).collect()))
    assert {(r[0], r[1]) for r in one} >= {(k, k % 12) for k in range(0, 40, 4)}
    assert sorted(map(tuple, decontaminate.contamination(d, b, broadcast_bytes=300).collect())) == one
    assert {r["doc_id"] for r in decontaminate.decontaminate(d, b, broadcast_bytes=300).collect()} == {k for k, _ in docs} - {r[0] for r in one}


def test_contamination_equals_brute_force(spark):
    """Ties between equal tiles, two items of one id and repeated rows."""
    rng = random.Random(23)
    word = lambda: rng.choice("abcde")
    items = [(k % 7, " ".join(word() for _ in range(rng.randint(0, 14)))) for k in range(12)]
    docs = [(k % 45, " ".join(word() for _ in range(rng.randint(0, 40)))) for k in range(50)] + [(3, items[2][1]), (3, items[2][1])]
    want = []
    for k, t in docs:
        for i, x in items:
            w, v = t.split(), x.split()
            covered = sum(z[2] for z in brute_tiles(w, v, min(3, len(v)))) if v else 0
            if v and covered >= 0.6 * len(v):
                want.append((k, i, covered, len(v)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["item_id"], r["covered"], r["item_tokens"]) for r in decontaminate.contamination(d, b, 3, 0.6).collect()]
    assert sorted(got) == sorted(want) and len(want) > 30


def distance_within(text, notice, k):
    """Whether some substring is at most k edits from the notice."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(notice, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row) <= k


def test_licences_equal_edit_distance():
    rng = random.Random(7)
    table_ = tuple((n, t, k) for n, (t, k) in licenses.NOTICES.items())
    for _ in range(120):
        name, notice, k = rng.choice(table_)
        x = list(notice)
        for _ in range(rng.randint(0, k + 2)):
            at = rng.randrange(len(x))
            x[at : at + 1] = rng.choice([[], ["q"], [x[at], "q"]])
        text = "Some é text " + "".join(x).swapcase() + " end"
        found = {f[0] for f in licenses.find_notices(text, table_)}
        assert (name in found) == distance_within(licenses.fold(text), licenses.fold(notice), k)
        for n, a, b, e in licenses.find_notices(text, table_):
            assert e <= dict((m, q) for m, _, q in table_)[n] and 0 <= a < b <= len(text)


def edits_between(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, x in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != x)))
        row = new
    return row[-1]


def test_license_spans_through_the_cluster(spark):
    rng = random.Random(17)
    own = {"one": ("the quick brown notice", 3), "two": ("brown notice of rights", 2)}
    docs = []
    for k in range(60):
        text = prose(rng, rng.randint(0, 30), False)
        for _ in range(k % 3):
            notice, most = rng.choice(list(own.values()))
            x = list(notice)
            for _ in range(rng.randint(0, most + 1)):
                at = rng.randrange(len(x))
                x[at : at + 1] = rng.choice([[], ["q"], [x[at], "z"]])
            text += " é" + "".join(x).title() + " " + prose(rng, 3, False)
        docs.append((k, text))
    docs += [(100, "The quick brown notice of rights"), (100, "The quick brown notice of rights"), (None, "the quick brown notice the quick brown notice")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = licenses.license_scan(d, own).collect()
    texts = collections.defaultdict(set)
    for k, t in docs:
        texts[k].add(t)
    for r in got:
        notice, most = own[r["notice"]]
        assert any(t[r["start"] : r["end"]] == r["matched"] for t in texts[r["doc_id"]])
        assert r["edits"] == edits_between(licenses.fold(r["matched"]), notice) <= most
    have = {(r["doc_id"], r["notice"]) for r in got}
    want = {(k, n) for k, t in docs for n, (x, most) in own.items() if distance_within(licenses.fold(t), x, most)}
    assert have == want
    # notices that overlap are both found; rows that repeat are found again; two places are two rows
    assert sum(r["doc_id"] == 100 for r in got) == 4 and [(r["start"], r["end"]) for r in got if r["doc_id"] is None and r["notice"] == "one"] == [(0, 22), (23, 45)]


def slow_jump(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(0).integers(0, 2**63, 20_000, dtype=np.uint64)
    a, b = sharding.jump_hash(keys, 64), sharding.jump_hash(keys, 72)
    assert a[:200].tolist() == [slow_jump(int(k), 64) for k in keys[:200]]
    moved = a != b
    assert (b[moved] >= 64).all() and abs(moved.mean() - 8 / 72) < 0.01 and np.bincount(a).min() > 200


def test_fuse_filters():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 10, 5000):
        keys = rng.integers(0, 2**63, n, dtype=np.uint64)
        blob = fuse.build(keys)
        assert fuse.contains(blob, keys).all()
    other = rng.integers(0, 2**63, 100_000, dtype=np.uint64)
    assert fuse.contains(blob, other).mean() < 0.01


def test_exact_groups_and_order(spark):
    rng = random.Random(5)
    docs = [(k, prose(rng, 12) if k % 3 else f"same {k % 5}") for k in range(200)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for batches in (1, 3):
        got = {r["doc_id"]: r["kept_id"] for r in exact.exact_dedup(d, batches).collect()}
        text = dict(docs)
        assert all(text[i] == text[k] for i, k in got.items())
        assert len(set(got.values())) == len(set(text.values()))


def test_exact_tells_texts_of_one_digest_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact, "_digest", lambda text: F.unhex(F.concat(F.lit("0"), F.substring(F.md5(F.coalesce(F.col(text), F.lit("null"))), 1, 1))))
    docs = [(k, f"text {k % 40}" if k % 7 else None) for k in range(150)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for batches, rows in ((1, 10**6), (3, 10**6), (2, 0)):
        monkeypatch.setattr(exact, "BROADCAST_ROWS", rows)
        got = {r["doc_id"]: r["kept_id"] for r in exact.exact_dedup(d, batches).collect()}
        text = dict(docs)
        assert len(got) == 150 and all(text[i] == text[k] for i, k in got.items())
        assert len(set(got.values())) == len(set(text.values()))


@pytest.mark.parametrize("rows", [10**6, 0])
def test_lines_equal_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", rows)
    rng = random.Random(4)
    pool = [prose(rng, 4, False) for _ in range(12)]
    docs = {k: "\n".join(rng.choice(pool + ["", f"own {k}"]) for _ in range(6)) for k in range(60)}
    norm = lambda x: " ".join(x.split()).lower()
    held = collections.defaultdict(set)
    for k, t in docs.items():
        for x in t.split("\n"):
            if norm(x):
                held[norm(x)].add(k)
    want = {k: "\n".join(x for x in t.split("\n") if not norm(x) or len(held[norm(x)]) <= 20 or min(held[norm(x)]) == k) for k, t in docs.items()}
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = lines.line_dedup(d, 20, with_count=True).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert {r["doc_id"]: r["lines_dropped"] for r in got} == {k: docs[k].count("\n") - want[k].count("\n") if want[k] != "" or docs[k] == "" else sum(norm(x) != "" for x in docs[k].split("\n")) for k in docs}


def record(payload, head=b"", size=None):
    return b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:1>\r\n" + head + f"Content-Length: {len(payload) if size is None else size}\r\n\r\n".encode() + payload + b"\r\n\r\n"


def test_warc_records_are_streamed():
    big = bytes(range(256)) * 5000
    good = hashlib.sha256(big).hexdigest().encode()
    raw = gzip.compress(record(big, b"WARC-Block-Digest: sha256:" + good + b"\r\nX-Long: a\r\n  b\r\n")) + gzip.compress(record(b""))
    for data in (raw, gzip.decompress(raw)):
        rows = list(warc.records(io.BytesIO(data), 100_000))
        assert b"".join(r[10] for r in rows) == big and [r[4] for r in rows] == [*range(13), 0] and all(r[9] for r in rows)
        assert rows[3][7] == hashlib.sha256(big[:400_000]).hexdigest() and [r[8] for r in rows] == [False] * 12 + [True, True]


def test_warc_damage():
    assert [(r[6], r[8], r[9]) for r in warc.records(io.BytesIO(record(b"abcd12", size=10)[:-4]), 4)] == [(4, False, True), (2, True, False)]
    short = list(warc.records(io.BytesIO(record(b"abc", size=100)), 40))
    assert short[-1][8] and not short[-1][9]
    wrong = list(warc.records(io.BytesIO(record(b"abc", b"WARC-Block-Digest: sha256:00\r\n")), 40))
    assert not wrong[-1][9]
    assert [(r[0], r[8], r[9], r[10]) for r in warc.records(io.BytesIO(b"nonsense\r\nmore\r\n" + record(b"abc")), 40)] == [(None, True, False, None), ("1", True, True, b"abc")]


@pytest.mark.parametrize("length", [b"-5", b"x", b"", b"9" * 40])
def test_warc_lengths_that_are_no_numbers(length):
    bad = b"WARC/1.0\r\nWARC-Record-ID: <urn:uuid:9>\r\nContent-Length: " + length + b"\r\n\r\nsome\r\nbytes\r\n\r\n"
    for data in (bad + record(b"abc"), gzip.compress(bad) + gzip.compress(record(b"abc"))):
        assert [(r[0], r[6], r[8], r[9]) for r in warc.records(io.BytesIO(data), 40)] == [("9", 0, True, False), ("1", 3, True, True)]


def test_warc_members_that_break():
    whole = gzip.compress(record(b"abc"))
    for cut in (5, 30, 45):
        broken = bytearray(gzip.compress(record(bytes(np.random.default_rng(cut).integers(0, 256, 5000, dtype=np.uint8)))))
        broken[cut : cut + 8] = b"\xff" * 8
        rows = list(warc.records(io.BytesIO(whole + bytes(broken) + whole + whole), 1000))
        sound = [r for r in rows if r[8] and r[9]]
        assert [r[10] for r in sound] == [b"abc"] * 3 and sum(r[8] and not r[9] for r in rows) == 1, cut
    assert [r[9] for r in warc.records(io.BytesIO(whole + whole[:40]), 10)] == [True, False]


def test_warc_header_lines_that_are_too_long():
    rows = list(warc.records(io.BytesIO(record(b"abc", b"X: " + b"y" * 300_000 + b"\r\n") + record(b"de")), 10))
    assert [(r[9], r[10]) for r in rows] == [(False, b"abc"), (True, b"de")]


def test_warc_file_systems():
    from pyarrow import fs

    for uri in ("/a/b", "file:/a/b", "file:///a/b"):
        assert warc._filesystem(uri)[1] == "/a/b" and isinstance(warc._filesystem(uri)[0], fs.LocalFileSystem)


def left_below(path, seconds=20):
    """Files below ``path`` once no hidden one is left, or when the time is up: a worker
    notices that its task has failed a little after the driver does."""
    end = time.monotonic() + seconds
    while True:
        names = [f.name for f in path.iterdir()] if path.exists() else []
        if not any(n.startswith(".") for n in names) or time.monotonic() > end:
            return names
        time.sleep(0.1)


def test_failed_writers_leave_nothing(spark, tmp_path):
    p = spark.range(10).repartition(1).selectExpr("id page_id", "'u' url", "'x' html")
    (tmp_path / "w" / "part-000000.warc.gz" / "in the way").mkdir(parents=True)
    with pytest.raises(Exception):  # all records are written, the renaming fails
        warc.write_warc(p, str(tmp_path / "w")).collect()
    assert left_below(tmp_path / "w", 0) == ["part-000000.warc.gz"]


def test_failed_input_leaves_nothing(spark, tmp_path):
    p = spark.range(10).repartition(1).selectExpr("id page_id", "'u' url", "if(id = 7, raise_error('no'), 'x') html")
    with pytest.raises(Exception):  # before or after the writer has begun
        warc.write_warc(p, str(tmp_path / "w")).collect()
    assert left_below(tmp_path / "w") == []


def test_whole_records(spark, tmp_path):
    p = spark.createDataFrame([(1, "a", "x" * 9000), (2, "b", "y")], "page_id long, url string, html string")
    assert warc.write_warc(p.repartition(2), str(tmp_path / "w")).selectExpr("sum(records)").first()[0] == 2
    whole = warc.whole_records(warc.read_warc(spark, str(tmp_path / "w"), 1000))
    assert {r["source_id"]: len(r["payload"]) for r in whole.collect()} == {"1": 9000, "2": 1}
    some = warc.whole_records(warc.read_warc(spark, str(tmp_path / "w"), 1000), largest=100)
    assert {(r["source_id"], r["n_bytes"], r["whole"], r["payload"] is None) for r in some.collect()} == {("1", 9000, False, True), ("2", 1, True, False)}
