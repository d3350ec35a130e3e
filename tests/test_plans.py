"""Physical-plan assertions for the flagship: what the scale design relies on."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def flagship_plan(spark):
    # AQE off so the static plan is inspected, not the runtime re-plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["features_onerow"](spark, SF)
        yield _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cross_join_no_python(flagship_plan):
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in flagship_plan


def test_period_filter_reaches_scan(flagship_plan):
    assert "GreaterThanOrEqual(l_shipdate,2000-01-01" in flagship_plan
    assert "LessThan(o_orderdate,2001-01-01" in flagship_plan


def test_partial_top_k_before_shuffle(flagship_plan):
    assert flagship_plan.count("WindowGroupLimit") >= 4      # partial + final, twice
    assert "Partial" in flagship_plan


def test_partial_aggregates(flagship_plan):
    assert "partial_count" in flagship_plan and "partial_sum" in flagship_plan


def test_assembly_adds_no_exchange(flagship_plan):
    """Every client_id exchange feeds one per-client reduction; the joins reuse them.

    Exchanges on client_id: clients, latest subscription, billing, support,
    usage totals, usage bands = 6, plus the final range exchange for ORDER BY.
    """
    assert flagship_plan.count("Exchange hashpartitioning(client_id") <= 6
    assert flagship_plan.count("Exchange rangepartitioning(client_id") == 1


def test_pruned_columns(flagship_plan):
    # lineitem is read with only the columns the query needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string,l_shipdate" \
        in flagship_plan


def test_script_variant_bands_use_partial_top_k(spark):
    """The script-rule trend needs only the six latest months: partial top-k,
    no range exchange and no checkpointed full ranking of the usage table."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(entry.queries()["features_script_variant"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "rangepartitioning" not in plan
    assert "ExistingRDD" not in plan          # no checkpointed input
    assert plan.count("WindowGroupLimit") >= 2


SQL_QUERIES = sorted(entry.oracle_sql())


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_every_query_plan_is_distributed(spark, name):
    """No Cartesian product, no nested-loop join, no Python evaluation in any
    registered query's plan (static plan, AQE off)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, (name, bad)
