"""Driver contract: entry(), the registry, and a sample of oracle comparisons at sf0.001."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import _canon
from conftest import SF_SMALL
from tidemark.plans.inputs import ledger_chunks, raw_pages
from tidemark.plans.queries import _web_chunks
from tidemark.operators import diff as D
from tidemark.sources.tables import TABLES


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"start_url", "change_type", "chunk_id", "chunk_hash"} <= set(df.columns)


def test_every_core_query_has_an_oracle():
    from tidemark.plans.oracle import SQL
    from tidemark.plans.queries import REGISTRY

    assert set(SQL) == set(REGISTRY)
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["normalize_text", "page_markdown", "chunk_pages", "diff_chunks", "llms_full",
                                  "robots_rules", "links_first_seen", "enrich_parsed", "diff_ordered", "diff_unchanged",
                                  "index_apply_changes", "state_round_trip", "site_page_cap"])
def test_query_matches_oracle(spark, duck, name):
    s = queries()[name](spark, SF_SMALL).toPandas()
    d = duck.sql(oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert _canon(s) == _canon(d)


def test_diff_plan_shuffles_each_side_once_after_chunking(spark):
    prev = _web_chunks(spark, SF_SMALL, "prev")
    cur = _web_chunks(spark, SF_SMALL, "cur")
    plan = D.diff_chunks(prev, cur)._jdf.queryExecution().executedPlan().toString()
    # per side: the chunking window, the dedupe aggregate; the join adds none
    assert plan.count("Exchange hashpartitioning") == 4
    led = D.diff_chunks(ledger_chunks(spark, SF_SMALL, "prev"), ledger_chunks(spark, SF_SMALL, "cur"))
    p2 = led._jdf.queryExecution().executedPlan().toString()
    assert p2.count("Exchange hashpartitioning") == 2 and "partial_max_by" in p2
    assert raw_pages(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
