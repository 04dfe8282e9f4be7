"""Every query over the reference's operators against its SQL, and under another
partitioning."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest
from conftest import DATA

from siftloom.plans import registry

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    v = v.item() if hasattr(v, "item") else v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v if isinstance(v, (int, bool)) else str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(map(plain, r)) for r in df[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    got = rows(registry.QUERIES[name](spark, SF).toPandas())
    want = rows(con.execute(registry.ORACLE_SQL[name]).df())
    assert got == want


@pytest.mark.parametrize("name", ["dedupe_groups", "dedupe_variants", "registry_fold", "conflict_log", "ledger_merge", "ledger_patch", "evidence_upgrade"])
def test_partitioning_does_not_matter(spark, tmp_path, name):
    for f in glob.glob(f"{SF}/*.parquet"):
        spark.read.parquet(f).repartition(5).write.parquet(f"{tmp_path}/{os.path.basename(f)}")
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(registry.QUERIES[name](spark, str(tmp_path)).toPandas())
