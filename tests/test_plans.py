"""Plan checks and the driver contract on the smallest fixture."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

STREAMING_OR_PIPELINE = {"stream_", "ingest_", "late_rows", "bronze_multiplex", "demux_topic", "upsert_stream",
                         "delete_requests", "propagate_deletes", "arrival_stamp", "clean_positive", "dedup_parity",
                         "tumbling_stats_stream", "medallion_daily", "country_daily", "author_counts", "books_sales",
                         "country_sales", "full_pipeline", "authors_stats"}


def _plan(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "order_date", "orders_count", "books_count"]
    assert df.count() > 0


def test_registry_has_oracles_for_batch_queries():
    from tidewell.plans import registry
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    registry.load_all()
    assert len(registry.QUERIES) >= 140 and set(registry.QUERIES) <= set(q)
    missing = [k for k in registry.QUERIES if k not in o]
    assert missing == [], missing


def test_no_python_udfs_and_pushdown(spark):
    q = E.queries()
    for name in ["merge_into", "scd2_upsert", "change_feed_history", "pivot_sum", "site_type", "array_filter",
                 "country_day_stats", "as_of_version", "latest_per_key"]:
        plan = _plan(q[name](spark, SF_SMALL))
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name
    fp = q["filter_predicates"](spark, SF_SMALL)
    text = _plan(fp)
    assert "PushedFilters: [IsNotNull(c_acctbal)" in text and "GreaterThanOrEqual(c_acctbal,100.0)" in text
    # column pruning: the name column is never read
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double,c_mktsegment:string>" in text


def test_lookup_is_broadcast(spark):
    df = E.queries()["broadcast_lookup"](spark, SF_SMALL)
    assert "BroadcastHashJoin" in _plan(df)


def test_stored_feed_prunes_versions(spark):
    assert "PartitionFilters: [isnotnull(_commit_version" in _plan(E.queries()["changes_between_stored"](spark, SF_SMALL))


def test_view_prunes_country_partitions(spark):
    from tidewell.plans.gold import countries_stats_vw, materialize_customers_orders
    path = materialize_customers_orders(spark, SF_SMALL)
    text = _plan(countries_stats_vw(spark, path, "NATION_6"))
    assert "PartitionFilters: [isnotnull(country" in text and "NATION_6" in text


BATCH_SAMPLE = ["country_day_stats", "merge_into", "merge_backfill", "cdc_apply", "change_feed",
                "change_feed_history", "as_of_version", "restore_changes", "scd2_upsert", "pivot_sum",
                "array_transform", "site_type", "letter_grade", "tumbling_stats", "validate_existing",
                "masked_view_sql", "set_except_all", "collect_sets", "epoch_ms", "commit_summary",
                "scd2_out_of_order", "merge_duplicate_source", "cdc_apply_late"]


@pytest.mark.parametrize("name", BATCH_SAMPLE)
def test_query_matches_oracle(spark, name):
    import duckdb
    from tools.check_oracle import TABLES, digest
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, srows)[0] == digest(rel.columns, orows)[0]
