"""Registered queries against their SQL on the smallest data, and the plans they should have."""

import duckdb
import pytest

import __spark_entry__ as registry
from driftlens.queries import load
from driftlens.queries.fx import TABLES, Fx

FOLDER = "/root/testdata/sf0.001"
QUICK = ["q_seq5_sequence_stats", "q_seq10_stratified", "q_joi8_type_entries", "q_joi10_feed", "q_ren5_aliases", "q_joi12_member_findings", "q_joi18_overlaps",
         "q_dq5_bit_storage", "q_hsh4_layout_hash", "q_dic2_bitmaps", "q_dic4_decode", "q_agg13_layout_runs", "q_inc1_build_upsert", "q_inc5_streamed_merge", "q_src5_candidates"]


def cells(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple("NULL" if v is None or v != v else str(v) for v in row) for row in frame[names].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    assert cells(registry.queries()[name](spark, FOLDER).toPandas()) == cells(duck.execute(registry.oracle_sql()[name]).df())


def test_every_query_has_sql():
    known, oracles = load()
    assert set(known) == set(oracles)


def test_scan_reads_only_needed_columns(spark):
    plan = Fx(spark, FOLDER).builds().select("symbol_key", "machine")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


@pytest.mark.parametrize("name", ["q_joi12_member_findings", "q_dq12_one_rule"])
def test_views_read_several_times_are_built_once(spark, name):
    """What the query returns is read from written rows; the source table is not scanned and grouped again for each reader."""
    assert "l_orderkey" not in registry.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
