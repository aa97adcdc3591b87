"""Scoring arithmetic against the reference's committed per-severity rule
counts (golden), plus properties of the generated rules."""
import pytest
from pyspark.sql import functions as F

from tidyload.operators import quality as Q

# (table) -> {severity: (total, passed)}, and the committed score
GOLDEN = {
    "customers": ({"CRITICAL": (2, 1), "HIGH": (12, 1), "WARNING": (9, 5)}, 0.2564),
    "products": ({"CRITICAL": (3, 3), "HIGH": (9, 3), "WARNING": (4, 4)}, 0.6129),
    "orders": ({"CRITICAL": (4, 3), "HIGH": (9, 4), "WARNING": (6, 5)}, 0.6111),
    "order_lines": ({"CRITICAL": (4, 4), "HIGH": (4, 4), "WARNING": (3, 3)}, 1.0),
    "suppliers": ({"CRITICAL": (2, 2), "HIGH": (8, 2), "WARNING": (5, 5)}, 0.5556),
}
WEIGHTS = {"CRITICAL": 3.0, "HIGH": 2.0, "WARNING": 1.0}


def rule_rows(spark):
    rows = []
    for t, (detail, _) in GOLDEN.items():
        for sev, (total, passed) in detail.items():
            rows += [(t, sev, i < passed, WEIGHTS[sev]) for i in range(total)]
    return spark.createDataFrame(rows, "table_name string, severity string, passed boolean, weight double")


def test_golden_scores(spark):
    got = {r["table_name"]: (r["score"], r["approved"]) for r in Q.score(rule_rows(spark)).collect()}
    for t, (_, score) in GOLDEN.items():
        assert got[t][0] == pytest.approx(score, abs=1e-12)
        assert got[t][1] == (score >= 0.8)


def test_golden_severity_ratios(spark):
    got = {(r["table_name"], r["severity"]): (r["total"], r["passed"], r["score"])
           for r in Q.score_by_severity(rule_rows(spark)).collect()}
    assert got[("customers", "HIGH")] == (12, 1, 0.083)
    assert got[("orders", "WARNING")] == (6, 5, 0.833)
    assert got[("suppliers", "HIGH")] == (8, 2, 0.25)


def test_no_rules_scores_one(spark):
    empty = spark.createDataFrame([("t", "HIGH", True, 2.0)], "table_name string, severity string, passed boolean, weight double")
    assert Q.score(empty).first()["score"] == 1.0


def test_assessment_properties(spark):
    from tidyload.operators import profile as P
    from tidyload.sources.legacy import legacy_table
    df = legacy_table(spark, "/root/testdata/sf0.001", "customers")
    rules = Q.rule_results(Q.assess(df, "customers"))
    s = Q.score(rules).first()["score"]
    assert 0.0 <= s <= 1.0
    # every critical column gets exactly one not-null rule
    crit = rules.where(F.col("rule_type") == "expect_column_values_to_not_be_null").select("column_name")
    assert sorted(r[0] for r in crit.collect()) == ["cst_email", "cst_id"]
    # profile has one row per column
    assert P.profile(df, "customers").count() == len(df.columns)


def profiled(spark, rows, schema, **options):
    from tidyload.operators import profile as P
    return {r["column_name"]: r for r in P.profile(spark.createDataFrame(rows, schema), "t", **options).collect()}


def test_many_spellings_are_one_encoding(spark):
    from itertools import product
    words = ["".join(w) for w in product(*[(c, c.upper()) for c in "inactive"])]
    got = profiled(spark, [(w,) for w in words] + [(None,)], "v string")["v"]
    assert got["unique_count"] == 256 and got["bool_encoding"] == "INACTIVE" and got["status_encoding"] is None


def test_long_values_are_listed_as_they_are(spark):
    a, b = "a" * 300, "b" * 1000
    got = profiled(spark, [(a, "x"), (b, "x"), (a, "y"), (None, "y")], "v string, w string", with_rows=True)
    assert got["v"]["status_encoding"] == f"{a},{b}" and got["v"]["avg_length"] == 533.3 and got["v"]["dup_count"] == 1
    assert got["w"]["status_encoding"] == "x,y" and got["*"]["unique_count"] == 4


def test_signed_zero_and_nan(spark):
    got = profiled(spark, [(0.0, 1), (-0.0, 1), (float("nan"), 1), (None, 1)], "v double, k int", with_rows=True)
    assert (got["v"]["unique_count"], got["v"]["null_count"], got["v"]["dup_count"]) == (1, 2, 1)
    assert got["*"]["unique_count"] == 2 and got["k"]["mean"] == 1.0


def test_profile_of_no_rows(spark):
    got = profiled(spark, [], "v string, k int")
    assert (got["v"]["row_count"], got["v"]["null_rate"], got["k"]["unique_count"], got["k"]["mean"]) == (0, 0.0, 0, None)


def test_ratio_of_large_counts(spark):
    from tidyload.functions.numeric import ratio
    rows = [(10**15, 3 * 10**15), (10**18, 10**18), (1, 3), (0, 5), (5, 0), (9, 60000)]
    got = [r[0] for r in spark.createDataFrame(rows, "n long, d long").select(ratio("n", "d", 4)).collect()]
    assert got == [0.3333, 1.0, 0.3333, 0.0, 0.0, 0.0002]


def test_supplied_set_can_fail(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "state string")
    bad = Q.rule_results(Q.assess(df, "t", [], {"state": ["a", "c"]})).where("rule_id = 'state__valid_values'").collect()
    assert [(r.passed, r.observed, r.valid_set) for r in bad] == [(False, 2.0, "a,c")]
    good = Q.rule_results(Q.assess(df, "t", [], {"state": ["a", "b", "c", "d"]})).where("rule_id = 'state__valid_values'").collect()
    assert [(r.passed, r.observed) for r in good] == [(True, 0.0)]


def test_gate(spark, monkeypatch):
    scores = Q.score(rule_rows(spark))
    with pytest.raises(Q.QualityGateError, match="customers"):
        Q.enforce_gate(scores)
    assert Q.enforce_gate(scores, 0.2).count() == 5
    monkeypatch.setenv(Q.THRESHOLD_ENV, "0.6")
    assert {r.table_name for r in Q.score(rule_rows(spark)).where("approved").collect()} == {"products", "orders", "order_lines"}


def test_documents_for_tables_without_findings(spark, tmp_path):
    from tidyload.sources import sinks as K
    assessed = Q.assess(spark.createDataFrame([("a@x",), ("a@x",)], "email string"), "dirty", [])
    tables = spark.createDataFrame([("dirty",), ("clean",)], "table_name string")
    docs = {r["table"]: r for r in K.write_documents(Q.documents(assessed, tables), str(tmp_path / "d")).collect()}
    assert set(docs) == {"dirty", "clean"} and docs["clean"].anomalies == [] and docs["clean"].score == 1.0
    assert [a.anomaly_type for a in docs["dirty"].anomalies] == ["DUPLICATE_ROWS", "DUPLICATE_KEY"]
    none = K.write_documents(Q.documents(assessed.limit(0), tables.limit(0)), str(tmp_path / "none"))
    assert none.count() == 0
    assert {r.table_name for r in K.read_quality_reports(spark, str(tmp_path / "d")).collect()} == {"dirty", "clean"}
    assert K.read_quality_reports(spark, str(tmp_path / "missing")).count() == 0
    with pytest.raises(Exception, match="nosuchstore"):  # only a missing path means that there are no reports
        K.read_quality_reports(spark, "nosuchstore://x/y").count()


def test_rules_of_one_run_hold_in_the_next(spark, tmp_path):
    """G-3: a value that appears only in the second load fails; the third is judged by the second's sets."""
    first = spark.createDataFrame([(i, ["a", "b,c", " d "][i % 3], "x" * 300 if i % 2 else "y") for i in range(30)], "id int, kind string, note string")
    second = first.unionByName(spark.createDataFrame([(99, "new", "y"), (98, None, "y")], first.schema))
    path = str(tmp_path / "rules")
    sets = Q.supplied_sets(Q.learn_rules({"t": first}, path, "one"))
    assert sets == {"t": {"kind": [" d ", "a", "b,c"], "note": ["x" * 300, "y"]}}
    rows = Q.rule_results(Q.assess(second, "t", critical=[], valid_sets=sets["t"])).where("rule_type like '%in_set'").collect()
    assert {r.column_name: (r.passed, r.observed) for r in rows} == {"kind": (False, 1.0), "note": (True, 0.0)}
    again = Q.supplied_sets(Q.learn_rules({"t": second}, path, "two"))
    assert again["t"]["kind"] == [" d ", "a", "b,c", "new"]
    assert [r.run for r in Q.stored_rules(spark, path).collect()] == ["two"]


def test_profile_computes_its_table_once(spark):
    """Without status columns one look at the rows is all; with them a second one at these columns."""
    from tidyload.operators import profile as P
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(200, numPartitions=4).selectExpr("id", "cast(id % 7 as double) d", "concat('t', id) t").mapInArrow(count, "id long, d double, t string")
    got = {r.column_name: r for r in P.profile(df, "t", with_rows=True).collect()}
    assert seen.value == 200
    assert [got[c].unique_count for c in ("id", "d", "t", "*")] == [200, 7, 200, 200] and got["d"].mean == 2.97


def test_counts_take_shares_bounded_by_the_shuffle(spark):
    """However few tasks read the table, its values are counted by many: the rows are dealt out first."""
    from tidyload.operators import profile as P
    df = P.clean(spark.range(1000, numPartitions=1).selectExpr("id", "cast(id as string) t"))
    plan = P._fixed_counts(df, True, {})._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Exchange hashpartitioning")
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_each_kind_of_value_is_counted_by_a_narrow_key(spark):
    """no task holds all kinds of values at once, and a number's key holds no place for texts."""
    import re
    from tidyload.operators import profile as P
    df = P.clean(spark.range(100).selectExpr("id", "id % 7 k", "cast(id as double) d", "cast(id as string) t"))
    plan = P._fixed_counts(df, True, {})._jdf.queryExecution().executedPlan().toString()
    keys = sorted(len(k.split(",")) for k in re.findall(r"HashAggregate\(keys=\[([^\]]*)\], functions=\[partial_count", plan))
    assert keys == [2, 2, 2, 4] and "SortAggregate" not in plan


def test_figures_of_all_kinds_of_values(spark):
    from datetime import date
    from decimal import Decimal
    rows = [(True, 1.5, Decimal("2.50"), "2020-01-02", date(2020, 1, 2), "yes"), (True, 1.5, Decimal("2.50"), "02/01/2020", date(2020, 1, 2), "No"),
            (False, -2.0, Decimal("-1.00"), "01-02-2020", None, "YES"), (None, None, None, "20200102", None, None),
            (None, float("nan"), None, "2020-01-02\n", None, "yes"), (None, None, None, "2020/01-02", None, "n" * 300)]
    got = profiled(spark, rows, "b boolean, f double, m decimal(9,2), t string, y date, w string", with_rows=True,
                   valid_sets={"b": ["1"], "f": [1.5], "w": ["yes", "n" * 300]})
    assert [(got[c].row_count, got[c].null_count, got[c].unique_count, got[c].dup_count) for c in ("b", "f", "m", "t", "y", "w", "*")] == [
        (6, 3, 2, 1), (6, 3, 2, 1), (6, 3, 2, 1), (6, 0, 6, 0), (6, 4, 1, 1), (6, 1, 4, 1), (6, 0, 6, 0)]
    assert [(got[c].min, got[c].max, got[c]["mean"], got[c].negative_count) for c in ("b", "f", "m")] == [
        (0.0, 1.0, 0.67, 0), (-2.0, 1.5, 0.33, 1), (-1.0, 2.5, 1.33, 1)]
    t = got["t"]
    assert (t.date_iso, t.date_fr, t.date_us, t.date_compact, t.mixed_dates, t.avg_length) == (2, 1, 1, 1, True, 9.8)
    assert [got[c].invalid_count for c in ("b", "f", "w", "t")] == [1, 1, 2, None]
    assert got["w"].bool_encoding is None and got["w"].status_encoding == ",".join(["No", "YES", "n" * 300, "yes"])


def test_views_compile_to_methods_that_are_compiled_further(spark):
    """F7 to F9: a generated method over 8000 bytes is never compiled by the JVM (the orders' scan took
    35 microseconds a row)."""
    import contextlib
    import io
    import re
    from tidyload.operators import profile as P
    from tidyload.sources.legacy import LEGACY_TABLES, legacy_table
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for t in LEGACY_TABLES:
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                P._compact(P.clean(legacy_table(spark, "/root/testdata/sf0.001", t))).explain("codegen")
            assert all(int(n) < 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())), t
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
