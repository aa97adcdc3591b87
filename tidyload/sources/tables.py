"""Scans (S-1; CSV extracts: ``sources.csv``), schema introspection (S-2), row samples (S-4, S-5) and the
reference dimensions (S-8)."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEST_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """S-1: parquet scan; selecting ``columns`` here lets the scan prune them. How
    a scan is split is the session's matter (``spark.sql.files.maxPartitionBytes``)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, partitions: int, properties: dict | None = None) -> DataFrame:
    """S-1 for a database source: a range-partitioned parallel read."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions,
                           properties=properties or {})


def schema_rows(spark: SparkSession, df: DataFrame, table_name: str) -> DataFrame:
    """S-2: ordered (table_name, column_name, ordinal, data_type, nullable)."""
    rows = [(table_name, f.name, i, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    schema = "table_name string, column_name string, ordinal int, data_type string, nullable boolean"
    return spark.createDataFrame(rows, schema)


def first_rows(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """S-4: first ``n`` rows by ``key`` (a top-k: per-partition heaps, one merge)."""
    return df.orderBy(F.col(key)).limit(n)


def column_samples(df: DataFrame, order_by, k: int = 30, columns=None) -> DataFrame:
    """S-5: up to ``k`` non-null values per column, first by ``order_by`` (a column
    or a list; nulls last; add tie-breakers where it is not unique).

    A distributed top-k per column: each task keeps a heap of ``k`` rows and reads that
    column and the order's only, so no task sorts or holds its rows.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in order]
    by = [F.col(f"row_key.{o}").asc_nulls_last() for o in order]
    firsts = [df.select(F.lit(c).alias("column_name"), F.struct(*order).alias("row_key"), F.col(c).cast("string").alias("value"))
              .where(F.col("value").isNotNull()).orderBy(*by).limit(k) for c in columns]
    position = F.row_number().over(Window.partitionBy("column_name").orderBy(*by))
    return reduce(DataFrame.unionByName, firsts).select("column_name", "row_key", "value", position.alias("position"))


# S-8 reference dimensions (fixed values from the target DDL).
DIM_COUNTRY = [
    ("TN", "Tunisie", "Afrique du Nord"),
    ("FR", "France", "Europe de l'Ouest"),
    ("DZ", "Algérie", "Afrique du Nord"),
    ("MA", "Maroc", "Afrique du Nord"),
    ("DE", "Allemagne", "Europe de l'Ouest"),
    ("US", "États-Unis", "Amérique du Nord"),
    ("CN", "Chine", "Asie de l'Est"),
    ("IT", "Italie", "Europe de l'Ouest"),
    ("ES", "Espagne", "Europe de l'Ouest"),
    ("TR", "Turquie", "Moyen-Orient"),
]
DIM_CURRENCY = [
    ("TND", "Dinar Tunisien", "DT"),
    ("EUR", "Euro", "€"),
    ("USD", "Dollar Américain", "$"),
]
DIM_STATUS_CUSTOMER = [
    ("active", "Client actif"),
    ("inactive", "Client inactif"),
]
DIM_STATUS_ORDER = [
    ("pending", "En attente", False),
    ("confirmed", "Confirmée", False),
    ("shipped", "Expédiée", False),
    ("delivered", "Livrée", True),
    ("cancelled", "Annulée", True),
]

DIMENSIONS = {
    "dim_country": (DIM_COUNTRY, "country_code string, country_name string, region string"),
    "dim_currency": (DIM_CURRENCY, "currency_code string, currency_name string, symbol string"),
    "dim_status_customer": (DIM_STATUS_CUSTOMER, "status_code string, label string"),
    "dim_status_order": (DIM_STATUS_ORDER, "status_code string, label string, is_terminal boolean"),
}


def dimension(spark: SparkSession, name: str) -> DataFrame:
    """S-8: a literal dimension (2..10 rows, fixed by the DDL). Joins against it
    are always broadcast: its size is a constant, not a function of the data."""
    rows, schema = DIMENSIONS[name]
    return F.broadcast(spark.createDataFrame(rows, schema))
