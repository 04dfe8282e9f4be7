"""Documents and tables of runs: refusals leave everything as it was."""

import json

import pytest
from pyspark.sql import functions as F

from siftloom.operators import records
from siftloom.sinks.publish import Durations, PublishError, Store, narrowed, run_id, serialized

RUN = "20240301T000000Z-7"


def test_rendering():
    assert serialized({"b": 1, "a": ["ü"]}) == '{\n  "a": [\n    "ü"\n  ],\n  "b": 1\n}\n'.encode()
    assert run_id(0, 5) == "19700101T000000Z-5"


def manifest(**kw):
    return {"harvest_run_id": RUN, "finished_at": "2024-03-01T00:00:00Z", **kw}


def test_publishing(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}")
    assert s.latest() is None and not s.finished(RUN)
    for bad in (manifest(finished_at=None), manifest(harvest_run_id="x")):
        with pytest.raises(PublishError):
            s.publish(RUN, bad)
    with pytest.raises(PublishError):
        s.publish(RUN, manifest(), lambda d: ["no"])
    with pytest.raises(PublishError):
        s.publish("run", manifest(harvest_run_id="run"))
    assert s.latest() is None and not s.finished(RUN)
    s.publish(RUN, manifest())
    assert s.latest() == RUN and s.finished(RUN)
    with pytest.raises(PublishError):
        s.publish(RUN, manifest())
    for broken in (b"{", json.dumps(manifest(harvest_run_id="y")).encode()):
        s._put(s.manifest(RUN), broken)
        with pytest.raises(PublishError):
            s.latest()
    s.delete(s.manifest(RUN))
    with pytest.raises(PublishError):
        s.latest()
    assert s.debris() == []
    (tmp_path / "runs" / ".tmp-1").write_bytes(b"")
    assert len(s.debris()) == 1


def test_tables(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}")
    t = spark.createDataFrame([("t", "b", "2"), ("t", "a", "1"), ("u", None, "3")], "topic string, category string, record_id string")
    with pytest.raises(PublishError):
        s.write_table(s.cells(RUN), t, t.where("category is null"))
    assert not s.exists(s.cells(RUN)) and s.debris() == []
    assert s.write_table(s.cells(RUN), t.coalesce(1), t.limit(0), by=["topic"], sort=records.order()) == 3
    assert [r["record_id"] for r in s.table(s.cells(RUN)).where("topic = 't'").collect()] == ["1", "2"]
    with pytest.raises(PublishError):
        s.write_table(s.cells(RUN), t)
    s.write_table(s.cells(RUN), t.limit(1), overwrite=True)
    assert s.table(s.cells(RUN)).count() == 1
    none = s.load_ledger("cell_id string, n int", ["a"])
    assert none.count() == 0
    s.write_table(s.ledger(), spark.createDataFrame([("a", 1)], "cell_id string, n int"))
    assert s.load_ledger("cell_id string, n int", ["a"]).count() == 1
    with pytest.raises(PublishError):
        s.load_ledger("cell_id string, n int", ["b"])


def test_bundles(spark, tmp_path):
    s, fine = Store(spark, f"file://{tmp_path}"), lambda d: ()
    with pytest.raises(PublishError):
        s.write_bundle("m", {"a.json": ({}, fine), "b.json": ({}, lambda d: ["bad"])})
    assert not s.exists("m")
    s.write_bundle("m", {"a.json": ({"x": 1}, fine), "b.json": ({}, fine)})
    assert json.loads(s.read("m/a.json")) == {"x": 1} and s.debris() == []
    with pytest.raises(PublishError):
        s.write_bundle("m", {"a.json": ({}, fine)})


def test_durations_and_bounds():
    ticks = iter([1.0, 2.23456, 5.0, 4.0])
    d = Durations(lambda: next(ticks))
    d.begin("a")
    assert d.end("a") == 1.235
    d.begin("b")
    with pytest.raises(ValueError):
        d.end("b")
    assert narrowed(10, None, "x") == 10 and narrowed(10, 3, "x") == 3
    for asked in (11, 0):
        with pytest.raises(ValueError):
            narrowed(10, asked, "x")
    assert F
