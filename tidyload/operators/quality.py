"""Quality findings (Q-1 .. Q-8), generated rules (G-1 .. G-5), rule results
(G-6), weighted score (G-7), score by severity (G-8), gate (G-9), summary (G-10).

Everything here is computed from the profile rows (one row per column, and one for
whole rows), so after the profile's pass no further scan of the table is needed.
Findings and rules of a table are evaluated together in one pass over its profile
rows (``assess``); everything else filters or aggregates that one result.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyload.functions.numeric import ratio, round_half_up
from tidyload.operators import profile as P
from tidyload.plans.specs import CRITICAL_COLUMNS, QUALITY_THRESHOLD, SEVERITY_WEIGHTS
from tidyload.sources.documents import read_documents
from tidyload.sources.publish import current, publish, stage

# Thresholds and name keywords of the checks.
HIGH_NULL_RATE = 0.15
STATUS_FINDING_MIN_VALUES = 3
NULL_RATE_SLACK, NULL_RATE_CAP = 1.2, 0.30
UNIQUE_MIN_RATE, UNIQUE_MAX_NULL_RATE = 0.98, 0.01
DUP_KEY_WORDS = ["email", "ref", "mail"]
UNIQUE_WORDS = ["id", "ref", "email", "code"]

ANOMALY_COLS = ["table_name", "seq", "anomaly_type", "severity", "column_name", "metric"]
RULE_COLS = ["table_name", "seq", "rule_id", "column_name", "rule_type", "severity", "threshold",
             "min_value", "valid_set", "passed", "observed", "error", "weight"]
THRESHOLD_ENV = "QUALITY_SCORE_THRESHOLD"


class QualityGateError(RuntimeError):
    """G-9: tables whose score is below the threshold."""


def threshold(value: float | None = None) -> float:
    """The gate's threshold: the argument, else the environment's, else 0.80."""
    return float(os.environ.get(THRESHOLD_ENV, QUALITY_THRESHOLD)) if value is None else value


def _name_has(words) -> "F.Column":
    low = F.lower(F.col("column_name"))
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words])


def _critical(critical) -> "F.Column":
    return F.col("column_name").isin(list(critical)) if critical else F.lit(False)


def _result(cond, kind, seq, typ, sev, column, **values):
    """A finding or a rule as a (condition, struct) pair; both share one struct type."""
    def of(name, dt):
        return F.lit(values[name]).cast(dt).alias(name) if not hasattr(values.get(name), "cast") else values[name].cast(dt).alias(name)

    return cond, F.struct(
        F.lit(kind).alias("kind"), F.col("table_name"), seq.cast("bigint").alias("seq"), F.lit(typ).alias("type"),
        F.lit(sev).alias("severity"), column.alias("column_name"),
        *[of(n, dt) if n in values else F.lit(None).cast(dt).alias(n) for n, dt in (
            ("metric", "double"), ("rule_id", "string"), ("threshold", "double"), ("min_value", "double"),
            ("valid_set", "string"), ("passed", "boolean"), ("observed", "double"), ("error", "string"), ("weight", "double"))])


def _findings(critical):
    """Q-1..Q-8 in the reference's check order (``seq``)."""
    crit = _critical(critical)
    is_row = F.col("column_name") == P.ROW_PSEUDO_COLUMN
    o = F.col("ordinal").cast("bigint") * 10
    col = F.col("column_name")

    def finding(cond, k, typ, sev, metric):
        return _result(cond, "finding", o + k, typ, sev, col, metric=F.col(metric))

    return [
        finding(crit & (F.col("null_count") > 0), 1, "CRITICAL_NULLS", "HIGH", "null_count"),
        finding(~crit & (F.col("null_rate") > HIGH_NULL_RATE), 1, "HIGH_NULL_RATE", "MEDIUM", "null_rate"),
        finding(F.col("mixed_dates"), 2, "MIXED_DATE_FORMATS", "HIGH", "n_date_formats"),
        finding(F.col("bool_encoding").isNotNull(), 3, "BOOLEAN_ENCODING", "MEDIUM", "unique_count"),
        finding(F.col("status_encoding").isNotNull() & (F.col("unique_count") > STATUS_FINDING_MIN_VALUES),
                4, "STATUS_ENCODING", "HIGH", "unique_count"),
        finding(F.col("negative_count") > 0, 5, "NEGATIVE_VALUES", "MEDIUM", "negative_count"),
        finding(~is_row & _name_has(DUP_KEY_WORDS) & (F.col("dup_count") > 0), 100000, "DUPLICATE_KEY", "HIGH", "dup_count"),
        _result(is_row & (F.col("dup_count") > 0), "finding", F.lit(99999), "DUPLICATE_ROWS", "HIGH", F.lit("ALL"),
                metric=F.col("dup_count")),
    ]


def _rules(critical, valid_sets):
    """G-1..G-5 generated from the profile, with their results (G-6) from the same
    figures. A supplied valid set replaces the one that the data show (G-3)."""
    crit = _critical(critical)
    is_row = F.col("column_name") == P.ROW_PSEUDO_COLUMN
    o = F.col("ordinal").cast("bigint") * 10

    def rule(cond, k, suffix, typ, sev, **values):
        return _result(~is_row & cond, "rule", o + k, typ, sev, F.col("column_name"), weight=SEVERITY_WEIGHTS[sev],
                       rule_id=F.concat(F.col("column_name"), F.lit("__" + suffix)), **values)

    raw_rate = F.col("null_count") / F.when(F.col("row_count") > 0, F.col("row_count"))
    thr = round_half_up(F.least(F.col("null_rate") * NULL_RATE_SLACK, F.lit(NULL_RATE_CAP)), 3)
    comparable = F.col("is_numeric")
    supplied = F.col("column_name").isin(list(valid_sets)) if valid_sets else F.lit(False)
    out = [
        rule(crit, 1, "not_null", "expect_column_values_to_not_be_null", "CRITICAL", threshold=1.0,
             passed=F.col("null_count") == 0, observed=F.col("null_count")),
        rule(~crit & (F.col("null_rate") > 0), 1, "null_rate", "expect_column_values_null_rate_below", "WARNING",
             threshold=thr, passed=raw_rate <= thr, observed=raw_rate),
        rule(F.col("status_encoding").isNotNull() & ~supplied, 3, "valid_values", "expect_column_values_to_be_in_set", "HIGH",
             valid_set=F.col("status_encoding"), passed=True, observed=0.0),
        rule(~F.col("is_text") & ~crit, 4, "non_negative", "expect_column_values_to_be_between", "HIGH",
             min_value=0.0, passed=comparable & (F.col("negative_count") == 0),
             observed=F.when(comparable, F.col("negative_count")),
             error=F.when(~comparable, F.concat(F.lit("type error: cannot compare "), F.col("dtype"), F.lit(" with 0")))),
        rule((F.col("unique_rate") > UNIQUE_MIN_RATE) & (F.col("null_rate") < UNIQUE_MAX_NULL_RATE) & _name_has(UNIQUE_WORDS),
             5, "unique", "expect_column_values_to_be_unique", "HIGH", passed=F.col("dup_count") == 0, observed=F.col("dup_count")),
    ]
    for column, values in (valid_sets or {}).items():
        out.append(rule(F.col("column_name") == column, 3, "valid_values", "expect_column_values_to_be_in_set", "HIGH",
                        valid_set=",".join(sorted(map(str, values))), passed=F.col("invalid_count") == 0,
                        observed=F.col("invalid_count")))
    return out


def assess(df: DataFrame, table_name: str, critical=None, valid_sets: dict | None = None) -> DataFrame:
    """Findings and rule results of one table, from one pass over its profile rows
    (``critical`` defaults to the reference's list for its five tables;
    ``valid_sets``: column -> values that its rows must be in). ``kind`` tells
    findings from rules; see ``anomalies`` and ``rule_results``."""
    critical = CRITICAL_COLUMNS.get(table_name, []) if critical is None else critical
    prof = P.profile(df, table_name, with_rows=True, valid_sets=valid_sets)
    checks = F.array(*[F.when(cond, struct) for cond, struct in _findings(critical) + _rules(critical, valid_sets)])
    # one row per column from here on; the exchange keeps the profile's formulas from being inlined into every check
    return prof.repartition(1).select(F.explode(checks).alias("r")).where(F.col("r").isNotNull()).select("r.*")


RULE_DOC = T.StructType([
    T.StructField("table", T.StringType()), T.StructField("run", T.StringType()),
    T.StructField("sets", T.ArrayType(T.StructType([T.StructField("column", T.StringType()), T.StructField("values", T.ArrayType(T.StringType()))]))),
])


def learn_rules(frames: dict, path: str, run: str) -> DataFrame:
    """G-3: the valid sets that a run's tables show, one document per table, stored as
    the rules of the next run (the run before is replaced in one step)."""
    spark = next(iter(frames.values())).sparkSession
    sets = reduce(DataFrame.unionByName, [P.status_sets(df).select(F.lit(t).alias("table"), "*") for t, df in frames.items()])
    tables = spark.createDataFrame([(t,) for t in frames], "table string")
    by = sets.groupBy("table").agg(F.sort_array(F.collect_list(F.struct(F.col("column_name").alias("column"), "values"))).alias("sets"))
    docs = tables.join(by, "table", "left").select(
        "table", F.lit(run).alias("run"), F.coalesce("sets", F.array().cast(RULE_DOC["sets"].dataType)).alias("sets"))
    publish(spark, path, stage(docs, path, "json"))
    return stored_rules(spark, path)


def stored_rules(spark, path: str) -> DataFrame:
    """The rules that the last run left: (table, run, sets)."""
    return read_documents(spark, current(spark, path), RULE_DOC, ["table", "run", "sets"]).select(*RULE_DOC.names)


def supplied_sets(rules: DataFrame) -> dict[str, dict[str, list[str]]]:
    """Stored rules as ``valid_sets`` by table: a few values for each of a few columns,
    so they are brought to the driver."""
    return {r["table"]: {s["column"]: list(s["values"]) for s in r["sets"]} for r in rules.collect()}


def anomalies(assessed: DataFrame) -> DataFrame:
    """Q-1..Q-8 of assessed tables."""
    return assessed.where(F.col("kind") == "finding").withColumnRenamed("type", "anomaly_type").select(*ANOMALY_COLS)


def rule_results(assessed: DataFrame) -> DataFrame:
    """G-1..G-6 of assessed tables."""
    return assessed.where(F.col("kind") == "rule").withColumnRenamed("type", "rule_type").select(*RULE_COLS)


def _scored(checks: DataFrame) -> DataFrame:
    """Per table the sums that score, gate and summary need; rows that are no rules count as findings."""
    w, rule = F.col("weight"), F.col("weight").isNotNull()
    return checks.groupBy("table_name").agg(
        F.coalesce(F.sum(w), F.lit(0)).cast("long").alias("total_weight"),
        F.coalesce(F.sum(F.when(F.col("passed"), w)), F.lit(0)).cast("long").alias("passed_weight"),
        F.count_if(rule).alias("n_rules"), F.count_if(rule & F.col("passed")).alias("n_passed"),
        F.count_if(~rule).alias("n_anomalies"))


def score(rules: DataFrame, limit: float | None = None) -> DataFrame:
    """G-7 + G-9: weighted pass ratio per table (1.0 without rules) and the gate."""
    s = ratio("passed_weight", "total_weight", 4, empty=1.0)
    return _scored(rules).select("table_name", "n_rules", "n_passed", "total_weight", "passed_weight",
                                 s.alias("score"), (s >= threshold(limit)).alias("approved"))


def enforce_gate(scores: DataFrame, limit: float | None = None) -> DataFrame:
    """G-9 as a barrier: the scores, or ``QualityGateError`` naming the tables below
    the threshold (one row per table reaches the driver)."""
    limit = threshold(limit)
    blocked = scores.where(F.col("score") < limit).select("table_name", "score").orderBy("table_name").collect()
    if blocked:
        raise QualityGateError(", ".join(f"{r.table_name}: {r.score} < {limit}" for r in blocked))
    return scores


def score_by_severity(rules: DataFrame) -> DataFrame:
    """G-8: total, passed and pass ratio (3 digits) per table and severity."""
    return rules.groupBy("table_name", "severity").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("passed")).alias("passed")
    ).select("table_name", "severity", "total", "passed", ratio("passed", "total", 3).alias("score"))


def quality_summary(assessed: DataFrame, limit: float | None = None) -> DataFrame:
    """G-10: per table score / approved / number of findings, plus an ALL row."""
    s = ratio("passed_weight", "total_weight", 4, empty=1.0)
    per = _scored(assessed).select("table_name", s.alias("score"), (s >= threshold(limit)).alias("approved"), "n_anomalies")
    both = per.rollup("table_name").agg(
        F.max("score").alias("score"), F.bool_and("approved").alias("approved"),
        F.sum("n_anomalies").cast("long").alias("n_anomalies"), F.grouping("table_name").alias("all"))
    return both.select(F.when(F.col("all") == 1, F.lit("ALL")).otherwise(F.col("table_name")).alias("table_name"),
                       F.when(F.col("all") == 0, F.col("score")).alias("score"), "approved", "n_anomalies")


def documents(assessed: DataFrame, tables: DataFrame, limit: float | None = None) -> DataFrame:
    """K-5: one quality document per table of ``tables``, also without findings or
    rules: ``table, score, approved, anomalies, rule_results, score_detail``."""
    rule, finding = F.col("kind") == "rule", F.col("kind") == "finding"
    found = F.struct("seq", F.col("type").alias("anomaly_type"), "severity", "column_name", "metric")
    result = F.struct("seq", "rule_id", "column_name", F.col("type").alias("rule_type"), "severity", "threshold", "min_value",
                      "valid_set", "passed", "observed", "error")
    by = assessed.groupBy("table_name").agg(
        F.coalesce(F.sum("weight"), F.lit(0)).cast("long").alias("total_weight"),
        F.coalesce(F.sum(F.when(F.col("passed"), F.col("weight"))), F.lit(0)).cast("long").alias("passed_weight"),
        F.sort_array(F.collect_list(F.when(finding, found))).alias("anomalies"),
        F.sort_array(F.collect_list(F.when(rule, result))).alias("rule_results"),
        *[F.struct(F.count_if(rule & (F.col("severity") == v)).alias("total"),
                   F.count_if(rule & F.col("passed") & (F.col("severity") == v)).alias("passed")).alias(v) for v in SEVERITY_WEIGHTS])
    s = F.coalesce(ratio("passed_weight", "total_weight", 4, empty=1.0), F.lit(1.0))
    empty = lambda c, t: F.coalesce(F.col(c), F.array().cast(t))
    types = {f.name: f.dataType for f in by.schema.fields}
    detail = [F.struct(F.lit(v).alias("severity"), F.col(f"{v}.total").alias("total"), F.col(f"{v}.passed").alias("passed"),
                       ratio(f"{v}.passed", f"{v}.total", 3).alias("score")) for v in SEVERITY_WEIGHTS]
    return tables.join(by, "table_name", "left").select(
        F.col("table_name").alias("table"), s.alias("score"), (s >= threshold(limit)).alias("approved"),
        empty("anomalies", types["anomalies"]).alias("anomalies"), empty("rule_results", types["rule_results"]).alias("rule_results"),
        F.filter(F.array(*detail), lambda d: d["total"] > 0).alias("score_detail"))
