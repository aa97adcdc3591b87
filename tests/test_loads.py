"""Over several loads: keys that stay (W-3), rows compared by value (J-4)."""
import random

import pytest
from pyspark.sql import functions as F

from tidyload.operators import constraints, registry, row_reconcile


def test_keys_stay_over_loads(spark, tmp_path):
    path = str(tmp_path / "registry")
    rnd = random.Random(1)
    old, new = rnd.sample(range(-500, 5000), 900), rnd.sample(range(5000, 9000), 100)
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys + keys[:50] + [None]], "k long").repartition(5)
    first = {r.legacy_key: r.id for r in registry.register(frame(old), "k", path, "first").collect()}
    assert first == {k: i for i, k in enumerate(sorted(old), 1)}
    both = {r.legacy_key: (r.id, r.load) for r in registry.register(frame(old[100:] + new), "k", path, "second").collect()}
    assert both == {k: (i, "first") for k, i in first.items()} | {k: (901 + i, "second") for i, k in enumerate(sorted(new))}
    again = {r.legacy_key: (r.id, r.load) for r in registry.register(frame(new + old), "k", path, "third").collect()}
    assert again == both
    rows = registry.with_ids(frame([old[0], new[0], 10**6]), "k", registry.known_keys(spark, path, frame(old).schema["k"].dataType), "id")
    assert {(r.k, r.id) for r in rows.collect()} == {(old[0], both[old[0]][0]), (new[0], both[new[0]][0]), (10**6, None), (None, None)}


def test_a_load_that_dies_leaves_the_registry(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "registry")
    keys = lambda n: spark.createDataFrame([(f"k{i}",) for i in range(n)], "k string")
    registry.register(keys(5), "k", path, "first")

    def crash(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(registry, "publish", crash)
    with pytest.raises(KeyboardInterrupt):
        registry.register(keys(9), "k", path, "second")
    monkeypatch.undo()
    assert registry.known_keys(spark, path, keys(1).schema["k"].dataType).count() == 5
    assert sorted(r.id for r in registry.register(keys(9), "k", path, "second").collect()) == list(range(1, 10))


def rows(spark, n=400):
    return spark.range(n).select("id", (F.col("id") * 0.5).alias("x"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), "id")).alias("t"),
                                 F.to_date(F.lit("2024-01-01")).alias("d"))


def test_equal_tables_have_no_differences(spark):
    one = rows(spark)
    other = one.select("t", "d", "x", "id").repartition(7).withColumn("x", F.when(F.col("id") == 0, F.lit(-0.0)).otherwise(F.col("x")))
    assert row_reconcile.compare_rows(one, other, "id").collect() == []
    assert tuple(row_reconcile.summary(row_reconcile.compare_rows(one, other, "id"), one, "t").first()) == ("t", 400, 0, 0, 0)


def test_every_kind_of_difference(spark):
    one = rows(spark)
    k = F.col("id")
    other = (one.withColumn("x", F.when(k == 13, F.lit(6.500000000000001)).otherwise(F.col("x")))
             .withColumn("t", F.when(k == 14, F.lit("")).when(k.isin(13, 15), F.lit("z")).otherwise(F.col("t")))
             .where(k != 77).unionByName(one.where(k == 3).withColumn("id", F.lit(1000)))
             .unionByName(one.where(k == 5)))  # a row twice
    other = other.unionByName(one.where(k == 6).withColumn("id", F.lit(None).cast("long")))
    got = {r.id: (r.status, r.changed, r.n_expected, r.n_actual) for r in row_reconcile.compare_rows(one, other, "id").collect()}
    assert got == {"13": ("changed", ["x", "t"], 1, 1), "14": ("changed", ["t"], 1, 1), "15": ("changed", ["t"], 1, 1), "77": ("missing", None, 1, 0),
                   "1000": ("extra", None, 0, 1), "5": ("changed", None, 1, 2), None: ("extra", None, 0, 1)}
    with pytest.raises(ValueError, match="d"):
        row_reconcile.compare_rows(one, other.drop("d"), "id")


def test_only_differing_nodes_are_fetched(spark):
    one = rows(spark)
    other = one.withColumn("t", F.when(F.col("id") == 13, F.lit("z")).otherwise(F.col("t")))
    left, right = (row_reconcile.fingerprinted(x, "id") for x in (one, other))
    assert row_reconcile.differing(left, right, 8).count() == 1 and row_reconcile.differing(left, left, 8).count() == 0


@pytest.mark.parametrize("adaptive", ["false", "true"])
def test_a_frequent_foreign_key_is_spread(spark, adaptive):
    """A third of the rows hold one key, a third none, a parent is missing: right results, and no task gets a third (J-2)."""
    n = 30000
    child = spark.range(n, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("fk"))
    parent = spark.range(n - 100).select(F.col("id").alias("legacy"), (F.col("id") * 10).alias("sk"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = constraints.resolve_fk(child, "fk", parent, "legacy", "sk", "sk").withColumn("task", F.spark_partition_id())
        rows = got.toPandas()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == n and rows["task"].value_counts().max() < 2 * n / 8
    fk = rows["id"].map(lambda i: 7 if i % 3 == 0 else i if i % 3 == 1 else None)
    want = fk.map(lambda k: k * 10 if k is not None and k < n - 100 else None)
    assert ((rows["sk"] == want) | (rows["sk"].isna() & want.isna())).all()


def test_rows_compared_by_value_are_computed_once(spark):
    """J-4: every level and the pairing read the fingerprinted rows that were written, not the sides' plans."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    one = spark.range(100, numPartitions=2).selectExpr("id", "id % 7 as v").mapInArrow(count, "id long, v long")
    other = spark.range(100).selectExpr("id", "if(id = 3, -1, id % 7) as v")
    assert [(r.id, r.status) for r in row_reconcile.compare_rows(one, other, "id").collect()] == [("3", "changed")]
    assert seen.value == 100
