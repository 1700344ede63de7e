"""Registered queries against their SQL counterparts on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from linkloom import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return list(v) if hasattr(v, "tolist") and getattr(v, "ndim", 0) else v


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(plain(x) for x in r) for r in frame.astype(object).where(frame.notna(), None).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), con.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["source1_entity_id", "matched_entity_ids"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.basename(entry.SMOKE_DIR) == "sf0.001"
