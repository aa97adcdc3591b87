"""Plan-shape checks: what must hold at scale, read from the physical plan."""
import __spark_entry__ as E


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_transforms(spark):
    for name in ["migrate_customers", "migrate_orders", "profile_legacy_orders", "fk_orphans"]:
        p = plan(E.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_dedup_is_aggregate_not_window(spark):
    p = plan(E.queries()["migrate_customers"](spark, "/root/testdata/sf0.001"))
    assert "partial_min_by" in p
    assert "Window" not in p and "Join" not in p


def test_scan_is_pruned(spark):
    p = plan(E.queries()["norm_status_order"](spark, "/root/testdata/sf0.001"))
    # the orders view reads only the columns it uses
    assert "o_orderstatus" not in p


def test_dimension_joins_broadcast(spark):
    p = plan(E.queries()["dim_lookup"](spark, "/root/testdata/sf0.001"))
    assert "Broadcast" in p


def test_no_cartesian(spark):
    for name in ["reconcile_counts", "drift_issues", "run_summary", "quality_score"]:
        p = plan(E.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_one_computation_per_migration(spark):
    # each source once for the migration and once for its row count
    for name, most in (("reconcile_verdict", 10), ("run_summary", 10), ("drift_issues", 10), ("check_unique", 6), ("fk_orphans", 5)):
        assert scans(E.queries()[name](spark, "/root/testdata/sf0.001")) <= most, name


def test_no_python_in_the_library_plans(spark):
    names = ["value_pattern", "sampled_pattern", "sample_values", "mapping_enrich", "quality_score", "profile_documents", "row_level_log", "dedup_order_lines_rejects"]
    for name in names:
        p = plan(E.queries()[name](spark, "/root/testdata/sf0.001"))
        assert not any(x in p for x in ("MapInPandas", "MapInArrow", "BatchEvalPython", "ArrowEvalPython")), name
        assert "RoundRobin" not in p, name
