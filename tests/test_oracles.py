"""Registered queries against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from termtide.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = ["latest_fold", "trend_encoded", "keyframes_restated", "seat_changes", "live_resolution", "catalogue_diff", "flat_export", "drift_decisions", "digest_pull", "professor_ids", "code_links_applied", "rooms_free", "elective_credits", "result_cards", "terms_replaced", "requirement_figures", "stream_encoded", "stream_latest"]


def _plain(rows):
    return sorted(tuple("null" if v is None else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got = registry.QUERIES[name](spark, DIR)
    cols = sorted(got.columns)
    want = con.sql(registry.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    assert _plain(tuple(r) for r in got.select(*(f"`{c}`" for c in cols)).collect()) == _plain(want.select(*(f'"{c}"' for c in cols)).fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
