"""Surrogate keys that stay (W-3): a registry of legacy key -> id.

``surrogate_keys`` numbers the rows of one load. Over several loads a key must keep
the id it got, so ids are kept in an append-only table, one folder per load. A load
meets the registry once; only keys it does not know get ids, the next ones in key order,
by offsets over range partitions, so no task ever sees all new keys and ids have no
gaps. A load has one commit: repeated under the same name it assigns nothing new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyload.operators.transform import surrogate_keys
from tidyload.session import written
from tidyload.sources.publish import NoLoadError, publish, read_current, stage

FOLDERS = T.StructType([T.StructField("value", T.StringType())])


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of the registered loads (one short line each)."""
    try:
        return [r.value for r in read_current(spark, path, FOLDERS, "text").collect()]
    except NoLoadError:
        return []


def known_keys(spark: SparkSession, path: str, key_type: T.DataType) -> DataFrame:
    """The registry: (legacy_key, id, load), empty before the first load."""
    schema = T.StructType([T.StructField("legacy_key", key_type), T.StructField("id", T.LongType()), T.StructField("load", T.StringType())])
    folders = _folders(spark, path)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def register(df: DataFrame, key: str, path: str, load: str) -> DataFrame:
    """Give every key of ``df`` that the registry at ``path`` does not know an id, and
    return the whole registry. Null keys get none; repeated keys get one.

    The new ids go to a folder of their own, then the list of folders is replaced in one
    step (``sources.publish``): a load that dies leaves the registry as it was, and one
    that is repeated finds its keys known. One load at a time may register."""
    spark = df.sparkSession
    key_type = df.schema[key].dataType
    seen = known_keys(spark, path, key_type)
    fresh = written(df.where(F.col(key).isNotNull()).select(F.col(key).alias("legacy_key")).distinct().join(
        seen.select("legacy_key"), "legacy_key", "left_anti"))
    if fresh.isEmpty():
        return seen
    top = seen.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("id")).first()["id"]
    numbered = surrogate_keys(fresh, "legacy_key", "place").select("legacy_key", (F.col("place") + top).alias("id"), F.lit(load).alias("load"))
    folder = f"{path}/keys/loads/{stage(numbered, f'{path}/keys')}"
    names = spark.createDataFrame([(f,) for f in [*_folders(spark, path), folder]], FOLDERS).coalesce(1)
    publish(spark, path, stage(names, path, "text"))
    return known_keys(spark, path, key_type)


def with_ids(df: DataFrame, key: str, registry: DataFrame, out: str) -> DataFrame:
    """The rows of ``df`` with the id of their key (null keys and unknown ones: null)."""
    known = registry.select(F.col("legacy_key").alias("_lk"), F.col("id").alias(out))
    return df.join(known, df[key] == known["_lk"], "left").drop("_lk")
