"""Row-by-row reconciliation by value (J-4): which rows are equal, changed (and in which
columns), missing or extra.

Every row has a fingerprint (two 64-bit hashes of its compared columns), and rows are
summed, in any order, by a hash of their key: a tree whose root holds all keys and whose
node of ``LEVELS[i]`` bits holds a 2**-bits share. Both sides are compared at the first
level; only rows below nodes that differ are summed again at the next, and only rows
below the last level's differing nodes are fetched and paired by key. Equal tables
are one narrow aggregate each, and the rows paired grow with the differences. Each side
is computed once: its fingerprinted rows are written to the shared folder.

Keys that repeat are paired as groups: by their number of rows and the sum of their
fingerprints. Null keys are one group. Columns are compared by their text form, null
apart from any text; -0.0 is 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyload.session import written

LEVELS = (8, 16, 24)
WIDE = "decimal(38,0)"


def _text(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    return (c + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c).cast("string")


def fingerprinted(df: DataFrame, key: str) -> DataFrame:
    """(key, place, columns as texts, a, b) of every row."""
    texts = [_text(f).alias(f.name) for f in df.schema.fields if f.name != key]
    own = df.select(F.col(f"`{key}`").cast("string").alias("_key"), *texts)
    both = [F.xxhash64(F.lit(seed), "_key", *[x for f in df.schema.fields if f.name != key
                                             for x in (F.col(f"`{f.name}`"), F.col(f"`{f.name}`").isNull())]) for seed in (1, 2)]
    return own.select("*", F.xxhash64("_key").alias("_place"), both[0].alias("_a"), both[1].alias("_b"))


def _node(bits: int) -> Column:
    return F.shiftrightunsigned("_place", 64 - bits).alias("node")


def _sums(rows: DataFrame, bits: int) -> DataFrame:
    return rows.groupBy(_node(bits)).agg(F.count("*").alias("n"), F.sum(F.col("_a").cast(WIDE)).alias("a"), F.sum(F.col("_b").cast(WIDE)).alias("b"))


def differing(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """The tree's nodes of a level in which the sides differ (at most 2**bits rows)."""
    x, y = (_sums(side, bits).select("node", F.struct("n", "a", "b").alias(name)) for side, name in ((left, "x"), (right, "y")))
    return x.join(y, "node", "full").where(~F.col("x").eqNullSafe(F.col("y"))).select("node")


def compare_rows(expected: DataFrame, actual: DataFrame, key: str, levels=LEVELS) -> DataFrame:
    """(key, status, changed, n_expected, n_actual) of every key whose rows are not
    the same on both sides: ``changed`` (with the names of the columns, where the key
    has one row on each side), ``missing`` from ``actual`` or ``extra`` in it. Both
    frames have the same columns, in any order."""
    if sorted(expected.columns) != sorted(actual.columns):
        raise ValueError(f"columns differ: {sorted(set(expected.columns) ^ set(actual.columns))}")
    names = [c for c in expected.columns if c != key]
    # written once: each level and the pairing read them, and the sides may be dear to compute
    left, right = written(fingerprinted(expected, key)), written(fingerprinted(actual.select(*[f"`{c}`" for c in expected.columns]), key))
    for bits in levels:
        nodes = written(differing(left, right, bits))
        left, right = (side.join(F.broadcast(nodes), _node(bits) == nodes["node"], "left_semi") for side in (left, right))

    def grouped(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("_key").agg(F.struct(F.count("*").alias("n"), F.sum(F.col("_a").cast(WIDE)).alias("a"), F.sum(F.col("_b").cast(WIDE)).alias("b"),
                                                 F.struct(*[F.max(f"`{c}`").alias(c) for c in names]).alias("row")).alias(name))

    x, y = grouped(left, "x"), grouped(right, "y").withColumnRenamed("_key", "_other")
    met = x.join(y, F.col("_key").eqNullSafe(F.col("_other")), "full")
    same = (F.col("x.n") == F.col("y.n")) & (F.col("x.a") == F.col("y.a")) & (F.col("x.b") == F.col("y.b"))
    single = (F.col("x.n") == 1) & (F.col("y.n") == 1)
    columns = F.array_compact(F.array(*[F.when(~F.col(f"x.row.`{c}`").eqNullSafe(F.col(f"y.row.`{c}`")), F.lit(c)) for c in names]))
    status = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").otherwise("changed")
    return met.where(~F.coalesce(same, F.lit(False))).select(
        F.coalesce("_key", "_other").alias(key), status.alias("status"), F.when(single, columns).alias("changed"),
        F.coalesce("x.n", F.lit(0)).cast("long").alias("n_expected"), F.coalesce("y.n", F.lit(0)).cast("long").alias("n_actual"))


def summary(differences: DataFrame, expected: DataFrame, table_name: str) -> DataFrame:
    """Rows of ``expected`` that are matched, and keys changed, missing and extra, in
    one aggregate over the differences and a row count."""
    marks = differences.select("status", (-F.col("n_expected")).alias("n")).unionByName(
        expected.agg(F.count("*").alias("n")).select(F.lit(None).cast("string").alias("status"), "n"))
    return marks.agg(F.sum("n").cast("long").alias("matched"), *[F.count_if(F.col("status") == s).alias(s) for s in ("changed", "missing", "extra")]).select(
        F.lit(table_name).alias("table_name"), "matched", "changed", "missing", "extra")
