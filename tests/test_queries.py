"""A cross-section of the registered queries against their DuckDB oracles; tools/check.py runs all of them."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from adloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KEYS = [
    "html_tokens", "extract_links", "detail_links", "capture_filter", "json_deep_merge", "rec_location", "parse_address", "zip_enrich",
    "metro_from_point", "search_index", "upsert_refresh", "frontier_dedup", "run_stats", "stream_upsert", "pagination_stop", "crawl_rounds",
    "enrich_location", "validate_schema", "stream_run_stats", "json_source_priority", "photos_from_html", "rec_scraped_details", "rec_ad", "nearest_place", "upsert_ads", "extract_detail_pages",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def freeze(v):
    return tuple(map(freeze, v)) if isinstance(v, list) else round(v, 6) if isinstance(v, float) else v


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    want = duck.sql(entry.oracle_sql()[key])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    got = Counter(tuple(freeze(r[n]) for n in names) for r in df.collect())
    at = [want.columns.index(n) for n in names]
    assert got == Counter(tuple(freeze(r[i]) for i in at) for r in want.fetchall())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
