"""Commands on small tables: exit codes and what they leave."""

import json

from pyspark.sql import functions as F

from siftloom.cli import main
from siftloom.operators import migrate


def put(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    return f"{tmp_path}/{name}"


def test_usage(spark):
    assert main([], spark) == 2 and main(["nonsense"], spark) == 2 and main(["diff", "--left", "x"], spark) == 2


def test_preflight(spark, tmp_path, capsys):
    c = put(spark, tmp_path, "c", [("s1", "u1"), ("s2", "u2")], "source_id string, url string")
    p = put(spark, tmp_path, "p", [("u1", 1, 200, None), ("u2", 1, None, "dns_failure")], "url string, probed_at int, http_status int, error_type string")
    run = lambda *more: main(["preflight-sources", "--catalog", c, "--probes", p, *more], spark)
    assert run() == 1 and '"dns_failure"' in capsys.readouterr().out
    assert run("--sources", "s1") == 0 and run("--sources", "s1,s1") == 3 and run("--sources", "s9") == 3


def test_validate_and_compare(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text('{"id": 1}')
    (tmp_path / "s.json").write_text(json.dumps({"type": "object", "required": ["id"]}))
    v = ["validate", "--documents", f"{tmp_path}/docs", "--schema", f"{tmp_path}/s.json"]
    assert main(v, spark) == 0
    (tmp_path / "docs" / "b.json").write_text("{}")
    assert main(v, spark) == 1
    a = put(spark, tmp_path, "l", [("d", '{"generated_at": 1, "title": "a", "n": 1}')], "name string, document string")
    b = put(spark, tmp_path, "r", [("d", '{"generated_at": 2, "title": "b", "n": 1}')], "name string, document string")
    c = put(spark, tmp_path, "r2", [("d", '{"generated_at": 2, "title": "b", "n": 2}')], "name string, document string")
    assert main(["compare-runs", "--left", a, "--right", b], spark) == 0
    assert main(["compare-runs", "--left", a, "--right", c, "--out", f"{tmp_path}/o"], spark) == 1 and spark.read.parquet(f"{tmp_path}/o").count() == 3
    x = put(spark, tmp_path, "x", [("d", "1")], "name string, sha256 string")
    y = put(spark, tmp_path, "y", [("d", "2")], "name string, sha256 string")
    assert main(["diff", "--left", x, "--right", x], spark) == 0 and main(["diff", "--left", x, "--right", y], spark) == 1


def test_linkcheck(spark, tmp_path):
    h = "topic string, category string, record_id string, identity_url string, access_status string, content_hash string, link_history array<struct<checked_at:string,access_status:string,content_hash:string,changed_materially:boolean>>"
    r = put(spark, tmp_path, "r", [("t", "c", "1", "u1", "x", "h", []), ("t", "c", "2", "u2", "x", "h", [])], h)
    f = put(spark, tmp_path, "f", [("u1", "ok", "h2")], "identity_url string, access_status string, content_hash string")
    args = ["linkcheck", "--records", r, "--fetches", f, "--root", str(tmp_path), "--run", "after", "--at", "2024-03-01T00:00:00Z", "--sample"]
    assert main([*args, "26"], spark) == 3 and main([*args, "1"], spark) == 0 and main([*args, "1"], spark) == 3
    assert {x["record_id"]: (x["access_status"], len(x["link_history"])) for x in spark.read.parquet(f"{tmp_path}/after").collect()} == {"1": ("ok", 1), "2": ("x", 0)}


def test_migration_and_assessment(spark, tmp_path):
    row = dict.fromkeys(migrate.FIELDS, None) | {"case_id": "c1", "case_key": "k1", "source_url": "https://a.example.org/1", "industry": "Retail", "first_seen_at": "2024-01-01"}
    bad = row | {"case_id": "c2", "source_url": "https://search.example.com/2"}
    cols = ", ".join(f"{c} string" for c in migrate.FIELDS)
    reg = put(spark, tmp_path, "reg", [tuple(r[c] for c in migrate.FIELDS) for r in (row, bad)], cols)
    legacy = put(spark, tmp_path, "legacy", [("retail", "shops")], "legacy_value string, industry string")
    support = put(spark, tmp_path, "support", [("x", "y")], "industry string, term string")
    args = ["migrate-cases", "--registry", reg, "--root", str(tmp_path), "--run", "m1", "--at", "2024-03-01T00:00:00Z", "--legacy-map", legacy, "--support", support]
    assert main([*args, "--expect-count", "3"], spark) == 3
    assert main([*args, "--expect-count", "2", "--apply"], spark) == 1 and not (tmp_path / "m1").exists()
    assert main([*args, "--expect-count", "2", "--apply", "--allow-unmappable"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/m1/records").select("facet_industry").collect()[0][0] == "shops"
    assert json.loads((tmp_path / "m1" / "manifest.json").read_text())["publication_eligible"] is False
    assert main(["assess", "--registry", reg, "--by", "industry", "--key", "case_id"], spark) == 0
    assert main(["assess", "--registry", reg, "--by", "industry", "--key", "industry"], spark) == 1 and F
