"""Targets that are replaced in one step (K-1).

A target is a folder with the loads ever written to it and a manifest: ``loads/<id>``
and ``manifest/<number>``, a small file that names one load. A load is written whole
first, then published by moving a finished manifest file to the next number, one rename
to a name that did not exist. Readers follow the greatest number. Whatever a
crash cuts off, readers find the old load whole or the new one; nothing is deleted
on the way. ``vacuum`` removes loads that no kept manifest names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DIGITS = 12


class NoLoadError(FileNotFoundError):
    """The target has no published load."""


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, fs = _files(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _named(spark: SparkSession, path: str, number: int) -> str:
    at, _ = _files(spark, f"{path}/manifest/{number:0{DIGITS}d}")
    return spark.read.text(at.toString()).first()[0]


def current(spark: SparkSession, path: str) -> str:
    """The folder of the load that readers see."""
    numbers = _numbers(spark, path)
    if not numbers:
        raise NoLoadError(path)
    return f"{path}/loads/{_named(spark, path, numbers[-1])}"


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(current(spark, path))


def stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> str:
    """Write a load beside the published ones; its id."""
    load = uuid.uuid4().hex
    writer = df.write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{path}/loads/{load}")
    return load


def publish(spark: SparkSession, path: str, load: str) -> int:
    """Make a staged load the one that readers see; its number. Of loads published at
    the same time each gets a number of its own, the last one is seen."""
    folder, fs = _files(spark, f"{path}/manifest")
    fs.mkdirs(folder)
    draft, _ = _files(spark, f"{path}/manifest/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(load.encode()))
    out.close()
    number = (_numbers(spark, path) or [0])[-1] + 1
    while True:
        final, _ = _files(spark, f"{path}/manifest/{number:0{DIGITS}d}")
        if not fs.exists(final) and fs.rename(draft, final):
            return number
        number += 1


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete loads that none of the last ``keep`` manifests names, and older manifests;
    the ids deleted. Staged loads that were never published go too."""
    numbers = _numbers(spark, path)
    kept = {_named(spark, path, n) for n in numbers[-keep:]}
    loads, fs = _files(spark, f"{path}/loads")
    gone = [s.getPath() for s in fs.listStatus(loads) if s.getPath().getName() not in kept]
    for n in numbers[:-keep]:
        fs.delete(_files(spark, f"{path}/manifest/{n:0{DIGITS}d}")[0], False)
    for p in gone:
        fs.delete(p, True)
    return [p.getName() for p in gone]
