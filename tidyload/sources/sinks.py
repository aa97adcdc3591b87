"""Sinks and result documents: overwrite load with read-back (K-1, K-2),
migration audit append (K-3), CSV extract (K-4), nested result documents
(K-5), the quality-report source (S-7) and the preflight check (R-1).

Every write goes under the shared folder the session names in
``spark.checkpoint.dir`` (see ``tidyload.session``) or a caller-given shared
path, never to a machine-local folder; writes are whole-job commits through
the Hadoop output committer, so a lost executor's tasks are simply retried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyload.sources.csv import read_extract, write_extract
from tidyload.sources.documents import documents_or_none, write_documents  # noqa: F401 (write_documents is K-5's sink)
from tidyload.sources.publish import publish, read_current, stage


class EmptyLoadError(ValueError):
    """K-1: the reference refuses to load an empty frame ("DataFrame vide")."""


def overwrite_load(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> DataFrame:
    """K-1: replace the target with ``df`` and return the table read back.

    The frame is computed once: it is written beside the target's loads, looked at
    there, and published in one step (``sources.publish``), so readers see the old table
    or the new one, also after a crash; an empty load is refused and never seen."""
    spark = df.sparkSession
    load = stage(df, path, fmt, partition_by)
    if spark.read.schema(df.schema).format(fmt).load(f"{path}/loads/{load}").isEmpty():
        raise EmptyLoadError("load: empty DataFrame")
    publish(spark, path, load)
    return read_current(spark, path, df.schema, fmt)


AUDIT_SCHEMA = T.StructType([
    T.StructField("migration_run", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("source_count", T.LongType()), T.StructField("target_count", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("migrated_at", T.TimestampType()),
])


def _replaced(rows: DataFrame, path: str, by: list[str], schema: T.StructType) -> DataFrame:
    """Write rows to a log in which each value of ``by`` has one commit: what a rerun
    writes takes the place of what it wrote before. The whole log read back."""
    rows.select(*schema.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path).select(*schema.names)


def audit_append(stats: DataFrame, path: str, run_id: str, migrated_at, status: str = "success") -> DataFrame:
    """K-3: one audit row per table (from ``load_stats`` rows) in the migration log; the
    whole log read back. ``migrated_at`` is a run parameter (not ``now()``), and a run
    has one commit, so the same run twice gives the same log."""
    rows = stats.select(F.lit(run_id).alias("migration_run"), "table_name", "source_count", "target_count",
                        F.lit(status).alias("status"),
                        F.lit(migrated_at).cast("timestamp").alias("migrated_at"))
    return _replaced(rows, path, ["migration_run"], AUDIT_SCHEMA)


ROW_LOG_SCHEMA = T.StructType([
    T.StructField("migration_run", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("legacy_id", T.LongType()), T.StructField("target_id", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("error_message", T.StringType()),
])


def log_rows(rows: DataFrame, path: str) -> DataFrame:
    """R-9: the row-level log of a run's tables (``constraints.row_level_log``) into its
    table; a rerun of a run and table replaces what it logged. The whole log read back."""
    return _replaced(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ROW_LOG_SCHEMA.fields]), path,
                     ["migration_run", "table_name"], ROW_LOG_SCHEMA)


def csv_extract(df: DataFrame, path: str, schema: T.StructType | None = None) -> DataFrame:
    """K-4: header + UTF-8 CSV extract (``sources.csv``), read back with its types."""
    write_extract(df, path)
    return read_extract(df.sparkSession, path, schema or df.schema)


QUALITY_DOC = T.StructType([
    T.StructField("table", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("approved", T.BooleanType()),
])


def read_quality_reports(spark: SparkSession, path: str) -> DataFrame:
    """S-7: quality documents (``{table, score, approved, ...}``, any layout); a missing
    folder means no reports (the reference warns and goes on), any other fault, such
    as a corrupt document or one that is no report, is raised."""
    return documents_or_none(spark, path, QUALITY_DOC, ["table", "score", "approved"]).select(
        F.col("table").alias("table_name"), "score", "approved")


def preflight(tables: DataFrame, mapping_rows: DataFrame, schema_rows: DataFrame, quality: DataFrame) -> DataFrame:
    """R-1: readiness per table: mapping present, every mapped source column in
    the source schema (left-anti of mapping rows against schema rows), and the
    (advisory) quality figures."""
    n_map = mapping_rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_mappings"))
    missing = (mapping_rows.select("table_name", F.col("source_col").alias("column_name"))
               .join(schema_rows.select("table_name", "column_name"), ["table_name", "column_name"], "left_anti")
               .groupBy("table_name").agg(F.count(F.lit(1)).alias("missing_source_columns")))
    j = (tables.join(n_map, "table_name", "left").join(missing, "table_name", "left")
         .join(quality, "table_name", "left"))
    nm = F.coalesce(F.col("n_mappings"), F.lit(0)).cast("bigint")
    ms = F.coalesce(F.col("missing_source_columns"), F.lit(0)).cast("bigint")
    return j.select("table_name", nm.alias("n_mappings"), ms.alias("missing_source_columns"),
                    "score", "approved", ((nm > 0) & (ms == 0)).alias("ready"))
