"""Load statistics (K-2), source/target reconciliation (R-2 .. R-5, J-4), drift
checks (R-6 .. R-8), migration status (R-8c), row-level log (R-9), run summary
(R-10) and the before/after census of a normalised column (R-11).

Counts come from global aggregates (partial per task, single-row final); row
pairing joins on the legacy key, which is unique and evenly spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyload.functions.numeric import exact_sum, ratio, round_half_up
from tidyload.operators import profile as P

# Fixed values of the checks.
KEY_WORDS = ["id", "ref", "email"]
MAX_COUNT_DIFF = 0.05
DATE_LOSS_MAX = 0.10
RETENTION_WARN, RETENTION_FAIL = 0.90, 0.80
NEGATIVE_CHECK_COLUMNS = ["unit_price", "subtotal_ht", "discount_pct"]
ISSUE_COLS = ["table_name", "seq", "issue_type", "column_name", "severity", "metric"]


def _side_counts(source: DataFrame, target: DataFrame):
    """Rows of both sides as one union of flags: one aggregate then counts
    both (the source side reads no columns at all)."""
    return (source.select(F.lit(1).alias("_s"), F.lit(0).alias("_t"))
            .unionByName(target.select(F.lit(0).alias("_s"), F.lit(1).alias("_t"))))


def _stats_columns(table_name: str):
    return [F.lit(table_name).alias("table_name"), "source_count", "target_count",
            (F.col("source_count") >= F.col("target_count")).alias("count_match"),
            (F.col("source_count") - F.col("target_count")).alias("count_diff"),
            ratio("target_count", "source_count", 4).alias("load_rate")]


def load_stats(source: DataFrame, target: DataFrame, table_name: str) -> DataFrame:
    """K-2 / R-2: source_count, target_count, count_match, count_diff,
    load_rate (4 digits): ONE global aggregate over both sides, no join."""
    one = _side_counts(source, target).agg(F.sum("_s").cast("bigint").alias("source_count"),
                                           F.sum("_t").cast("bigint").alias("target_count"))
    return one.select(*_stats_columns(table_name))


def numeric_checks(target: DataFrame, table_name: str) -> DataFrame:
    """R-3: min, max, mean (2 digits), null rate (4 digits) of every numeric
    column that has values; one aggregate pass."""
    target = P.clean(target)
    cols = [f.name for f in target.schema.fields if P.is_numeric(f.dataType)]
    if not cols:
        return target.sparkSession.createDataFrame(
            [], "table_name string, column_name string, target_min double, target_max double, "
                "target_mean double, null_rate double")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"_{i}_n"), F.min(v).alias(f"_{i}_min"), F.max(v).alias(f"_{i}_max"),
                 (exact_sum(v) / F.count(v)).alias(f"_{i}_avg")]
    one = target.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"_{i}_n").alias("n"), F.col(f"_{i}_min").alias("target_min"),
        F.col(f"_{i}_max").alias("target_max"), F.col(f"_{i}_avg").alias("avg"))
        for i, c in enumerate(cols)])
    return (one.select("_rows", F.explode(rows).alias("r")).where(F.col("r.n") > 0)
            .select(F.lit(table_name).alias("table_name"), "r.column_name", "r.target_min", "r.target_max",
                    round_half_up("r.avg", 2).alias("target_mean"),
                    ratio(F.col("_rows") - F.col("r.n"), F.col("_rows"), 4).alias("null_rate")))


def key_like_columns(df: DataFrame, exclude=()) -> list:
    return [c for c in df.columns if any(w in c.lower() for w in KEY_WORDS) and c not in exclude]


def key_checks(target: DataFrame, table_name: str, exclude=()) -> DataFrame:
    """R-4: duplicates among non-null values of key-like columns (name contains
    id/ref/email).  ``exclude`` drops foreign keys, which the reference counts."""
    cols = key_like_columns(target, exclude)
    d = P.dup_keys(target, table_name, cols)
    return d.select("table_name", "column_name", "duplicates",
                    (F.col("duplicates") == 0).alias("unique_ok"))


def verdict(source: dict, target: dict) -> DataFrame:
    """R-5: diff <= 5 % of source and no key duplicates, for all tables in one
    shuffle: each target is computed once and unpivoted to its key-like values
    (and one entry a row), each source is only counted."""
    parts, entry = [], "table_name string, column_name string, key string"
    for t, df in target.items():
        entries = [F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), k.cast("string").alias("key"))
                   for c, k in [("*", F.lit(None)), *((c, F.col(c)) for c in key_like_columns(df))]]
        parts.append(df.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
        parts.append(source[t].select(F.lit(t).alias("table_name"), F.lit("#").alias("column_name"), F.lit(None).cast("string").alias("key")))
    counted = reduce(DataFrame.unionByName, parts).groupBy(*[c.split()[0] for c in entry.split(", ")]).agg(F.count(F.lit(1)).alias("n"))
    own = lambda c: F.sum(F.when(F.col("column_name") == c, F.col("n")))
    per_column = counted.groupBy("table_name", "column_name").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("key").isNotNull(), F.col("n") - 1)).alias("dup"))
    by = per_column.groupBy("table_name").agg(
        F.coalesce(own("#"), F.lit(0)).alias("source_count"), F.coalesce(own("*"), F.lit(0)).alias("target_count"),
        F.count_if(F.col("dup") > 0).cast("bigint").alias("key_issues"))
    diff = F.col("source_count") - F.col("target_count")
    return by.select("table_name", diff.cast("bigint").alias("count_diff"), "key_issues",
                     ((diff <= F.col("source_count") * MAX_COUNT_DIFF) & (F.col("key_issues") == 0)).alias("overall_ok"))


def pair_rows(source: DataFrame, target: DataFrame, source_key: str, target_key: str,
              table_name: str) -> DataFrame:
    """J-4: row pairing on the legacy key (full outer join; both sides are
    pre-aggregated to one row per key, so a repeated key cannot blow up)."""
    s = source.groupBy(F.col(source_key).alias("k")).agg(F.count(F.lit(1)).alias("ns"))
    t = target.groupBy(F.col(target_key).alias("k")).agg(F.count(F.lit(1)).alias("nt"))
    j = s.join(t, "k", "full_outer")
    status = (F.when(F.col("ns").isNull(), F.lit("extra_in_target"))
              .when(F.col("nt").isNull(), F.lit("missing_in_target"))
              .otherwise(F.lit("matched")))
    return (j.groupBy(status.alias("status"))
            .agg(F.sum(F.coalesce("ns", "nt")).cast("bigint").alias("n_rows"),
                 F.count(F.lit(1)).alias("n_keys"))
            .select(F.lit(table_name).alias("table_name"), "status", "n_rows", "n_keys"))


def _date_like(name: str) -> bool:
    return "date" in name or name.split("_")[-1:] == ["at"]


def drift(target: DataFrame, table_name: str, source: DataFrame, valid_statuses=None) -> DataFrame:
    """K-2 and R-6 .. R-8b of one table: a row with ``source_count``,
    ``target_count`` and ``issues`` (array, in the reference's order ``seq``), from
    ONE aggregate over the migrated rows and the source row flags."""
    date_cols = [c for c in target.columns if _date_like(c)]
    has_status = valid_statuses is not None and "status" in target.columns
    neg_cols = [c for c in NEGATIVE_CHECK_COLUMNS if c in target.columns]
    used = list(dict.fromkeys(date_cols + (["status"] if has_status else []) + neg_cols))
    types = dict((f.name, f.dataType) for f in target.schema.fields)
    u = (target.select(*used, F.lit(1).alias("_t"))
         .unionByName(source.select(*[F.lit(None).cast(types[c]).alias(c) for c in used], F.lit(0).alias("_t"))))
    tgt_row = F.col("_t") == 1
    aggs = [F.count_if(tgt_row).alias("_rows"), F.count_if(~tgt_row).alias("_src")]
    for i, c in enumerate(date_cols):
        aggs.append(F.count_if(tgt_row & F.col(c).isNull()).alias(f"_d{i}"))
    if has_status:
        aggs.append(F.count_if(tgt_row & ~F.coalesce(F.col("status").isin(list(valid_statuses)), F.lit(False)))
                    .alias("_st"))
    for i, c in enumerate(neg_cols):
        aggs.append(F.count_if(F.col(c).cast("double") < 0).alias(f"_n{i}"))
    one = u.agg(*aggs)
    src, tgt = F.col("_src"), F.col("_rows")
    retention = F.when(src > 0, tgt / src).otherwise(F.lit(0.0))

    def issue(seq, typ, col, sev, metric, cond):
        return F.when(cond, F.struct(F.lit(seq).cast("bigint").alias("seq"), F.lit(typ).alias("issue_type"),
                                     F.lit(col).alias("column_name"), sev.alias("severity"),
                                     metric.cast("double").alias("metric")))

    cands = []
    for i, c in enumerate(date_cols):
        rate = F.col(f"_d{i}") / F.col("_rows")
        cands.append(issue(10 + i, "DATE_CONVERSION_LOSS", c, F.lit("MEDIUM"), rate,
                           (F.col("_rows") > 0) & (rate > DATE_LOSS_MAX)))
    if has_status:
        cands.append(issue(100, "INVALID_STATUS_POST_TRANSFORM", "status", F.lit("HIGH"), F.col("_st"),
                           F.col("_st") > 0))
    for i, c in enumerate(neg_cols):
        cands.append(issue(200 + i, "NEGATIVE_VALUE_POST_TRANSFORM", c, F.lit("HIGH"), F.col(f"_n{i}"),
                           F.col(f"_n{i}") > 0))
    cands.append(issue(300, "LOW_RETENTION_RATE", "ALL",
                       F.when(retention < RETENTION_FAIL, F.lit("HIGH")).otherwise(F.lit("MEDIUM")),
                       retention, retention < RETENTION_WARN))
    return one.select(F.lit(table_name).alias("table_name"), src.cast("bigint").alias("source_count"),
                      tgt.cast("bigint").alias("target_count"), F.filter(F.array(*cands), lambda i: i.isNotNull()).alias("issues"))


def drift_issues(drifts: DataFrame) -> DataFrame:
    """R-6 .. R-8b: the issues of ``drift`` rows."""
    return drifts.select("table_name", F.explode("issues").alias("i")).select("table_name", "i.*")


def _status() -> Column:
    return (F.when(F.exists("issues", lambda i: i["severity"] == "HIGH"), F.lit("failed"))
            .when(F.size("issues") > 0, F.lit("partial")).otherwise(F.lit("success")))


def migration_status(drifts: DataFrame) -> DataFrame:
    """R-8c: failed if any HIGH issue, partial if any issue, else success."""
    return drifts.select("table_name", _status().alias("status"), F.size("issues").cast("bigint").alias("n_drift"))


def run_summary(drifts: DataFrame) -> DataFrame:
    """R-10: per table status / source / target / rate / #drift, plus the total
    row (global retention, number of successful tables) via rollup."""
    j = drifts.select("table_name", "source_count", "target_count", _status().alias("status"),
                      F.size("issues").cast("bigint").alias("n_drift"))
    r = j.rollup("table_name").agg(
        F.first("status", ignorenulls=True).alias("_status"),
        F.sum("source_count").cast("bigint").alias("source_count"),
        F.sum("target_count").cast("bigint").alias("target_count"),
        F.sum("n_drift").cast("bigint").alias("n_drift"),
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.grouping("table_name").alias("_g"))
    return r.select(
        F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("table_name")).alias("table_name"),
        F.when(F.col("_g") == 1, F.lit(None).cast("string")).otherwise(F.col("_status")).alias("status"),
        "source_count", "target_count",
        ratio("target_count", "source_count", 4).alias("load_rate"),
        "n_drift", "n_success")


def run_documents(drifts: DataFrame, run_id: str) -> DataFrame:
    """K-5: one run-log document per table: load statistics, status and issues."""
    return drifts.select(F.lit(run_id).alias("run_id"), F.col("table_name").alias("table"), _status().alias("status"),
                         F.struct("source_count", "target_count", ratio("target_count", "source_count", 4).alias("load_rate")).alias("load_stats"),
                         F.col("issues").alias("drift_issues"))
