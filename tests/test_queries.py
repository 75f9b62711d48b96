"""Core queries against their SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from octoseg.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the test tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    return round(v, 7) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, sql, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = sql.sql(f"select {', '.join(cols)} from ({catalog.SQL[name]})")
    key = lambda r: repr(tuple(map(plain, r)))
    assert sorted(map(key, df.select(*cols).collect())) == sorted(map(key, rel.fetchall()))


def signature_scans(df):
    return sum("FileScan" in x and "kmer_signature" in x for x in df._jdf.queryExecution().executedPlan().toString().splitlines())


def test_orphans_export_reads_signatures_once(spark):
    assert signature_scans(catalog.QUERIES["orphans_export"](spark, SF)) == 1


def test_orphan_counts_export_reads_signatures_once(spark):
    assert signature_scans(catalog.QUERIES["orphan_counts_export"](spark, SF)) == 1
