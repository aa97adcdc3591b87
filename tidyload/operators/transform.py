"""Table transforms (P-1 .. P-9), keep-first dedup (W-1, W-2), surrogate keys (W-3).

``migrate(df, spec)`` is the reference's per-table transform: one projection of
native Column expressions (a single codegen span, no shuffle), then keep-first
dedup on the normalised key, then the required-column filter, in that order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyload.plans.specs import SPECS, TableSpec, stages
from tidyload.session import written


def staged_select(df: DataFrame, items, passthrough=()) -> DataFrame:
    """Select ``items`` = [(alias, source column, transform name)] plus the
    ``passthrough`` columns, running multi-step transforms as one projection
    per step.  Catalyst does not inline an expensive alias that is used more
    than once, so every intermediate is computed once per row and each
    projection stays small enough for whole-stage codegen."""
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    plans = [(alias, src, stages(tr), types[src]) for alias, src, tr in items]
    depth = max([len(st) for _, _, st, _ in plans] + [1])
    keep = [F.col(c) for c in passthrough]
    cur = [F.col(src) for _, src, _, _ in plans]
    for step in range(depth):
        last = step == depth - 1
        cols = []
        for i, (alias, _, st, typ) in enumerate(plans):
            c = cur[i]
            # single-step transforms run in the last projection, with the rest
            offset = depth - len(st)
            if step >= offset:
                c = st[step - offset](c, typ)
            cols.append(c.alias(alias if last else f"_s{i}"))
        df = df.select(*cols, *keep)
        cur = [F.col(f"_s{i}") for i in range(len(plans))]
    return df


def project(df: DataFrame, spec: TableSpec, keep_key: bool = False, extra=None, columns=None) -> DataFrame:
    """P-1..P-8: rename-and-select with the spec's Column builders.

    With ``keep_key`` the source order key rides along as ``_src_key`` so that
    dedup can order rows even when the key is not a target column; ``extra``
    ({source column: output name}) passes further source columns through;
    ``columns`` restricts the target columns.
    """
    passthrough = []
    if keep_key:
        df = df.withColumn("_src_key", F.col(spec.key))
        passthrough.append("_src_key")
    for s, name in (extra or {}).items():
        df = df.withColumn(name, F.col(s))
        passthrough.append(name)
    return staged_select(df, [(name, s, t) for name, s, t in spec.columns if columns is None or name in columns], passthrough)


def _first(df: DataFrame, order_col: str) -> Column:
    """The order in which keep-first looks at rows: by ``order_col``, null last,
    then by all columns, so that repeated and null row keys are settled too."""
    return F.struct(F.col(order_col).isNull(), F.col(order_col), *[F.col(c) for c in df.columns])


def survivors(df: DataFrame, on, order_col: str) -> DataFrame:
    """One row per ``on`` group, the first by ``order_col`` (null keys form one
    group): the whole row as struct ``_row``.

    An aggregate with map-side partial aggregation: a hot key (even a third of all
    rows, e.g. all-null emails) collapses to one row per map task before the
    shuffle, so no task ever receives a whole hot group.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(c).alias(f"_k_{c}") for c in on]).agg(F.min_by(row, _first(df, order_col)).alias("_row"))


def dedup_keep_first(df: DataFrame, on, order_col: str, nulls: str = "collapse") -> DataFrame:
    """W-1: ``drop_duplicates(subset=on)`` keeping the first row by ``order_col``:
    exactly one row per key, one shuffle, no join and no second scan.

    ``nulls='collapse'`` (reference parity) keeps one row for all-null keys;
    ``nulls='keep'`` keeps every row whose key is null.
    """
    on = list(on)
    if nulls not in ("collapse", "keep"):
        raise ValueError("nulls must be 'collapse' or 'keep'")
    if nulls == "collapse":
        return survivors(df, on, order_col).select("_row.*")
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    return survivors(df.where(~any_null), on, order_col).select("_row.*").unionByName(df.where(any_null))


def dedup_marks(df: DataFrame, on, order_col: str) -> DataFrame:
    """Every row of ``df`` with ``_kept`` (it is the row that W-1 keeps) and
    ``_kept_key`` (the ``order_col`` of the row kept in its group).

    Rows meet their group in one shuffle, in which each group is looked at in order.
    Groups of more than a thousandth of the rows (``frequent_keys``, written once, since
    two filters ask for it) do not meet in one task: their survivors, at most some
    thousand rows, are broadcast, and equal rows are counted first, so that one of them is kept.
    """
    from tidyload.operators.constraints import frequent_keys
    on = list(on)
    hashed = df.withColumn("_group", F.xxhash64(*on))
    hot = F.broadcast(written(frequent_keys(hashed, "_group").select(F.col("_key").alias("_hot"))))
    of_hot = F.col("_group") == F.col("_hot")
    rows = hashed.join(hot, of_hot, "left_anti").drop("_group")
    order = Window.partitionBy(*on).orderBy(F.col(order_col).isNull(), *[F.col(c) for c in (order_col, *df.columns)])
    few = rows.select("*", (F.row_number().over(order) == 1).alias("_kept"),
                      F.first(order_col).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_kept_key"))
    large = hashed.join(hot, of_hot, "left_semi").drop("_group")
    keys = [F.col(c).alias(f"_on_{c}") for c in on]
    counted = large.select(F.struct(*df.columns).alias("_all"), *keys).groupBy("_all", *[f"_on_{c}" for c in on]).agg(F.count(F.lit(1)).alias("_n"))
    match = reduce(lambda a, b: a & b, [F.col(f"_on_{c}").eqNullSafe(F.col(f"_k_{c}")) for c in on])
    joined = counted.join(F.broadcast(survivors(large, on, order_col)), match).select(
        "_all", F.col("_all").eqNullSafe(F.col("_row")).alias("_same"), F.col(f"_row.{order_col}").alias("_kept_key"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i"))
    return few.unionByName(joined.select("_all.*", (F.col("_same") & (F.col("_i") == 1)).alias("_kept"), "_kept_key"))


def dedup_rejects(df: DataFrame, on, order_col: str) -> DataFrame:
    """W-2: rows W-1 drops, with the key of the row that survived in their place."""
    return dedup_marks(df, on, order_col).where(~F.col("_kept")).drop("_kept").withColumnRenamed(
        "_kept_key", "kept_" + order_col)


def keep_where(df: DataFrame, cond) -> DataFrame:
    """Filter evaluated IN the projection that computes its inputs.

    A plain ``where`` on a column produced by a multi-step transform is pushed
    below the staged projections with every alias inlined, so the whole
    normaliser chain is copied into the predicate (and computed twice).  Here
    each row is exploded against a one-element array when ``cond`` holds and
    an empty one otherwise: no Filter node exists to be pushed down, and the
    generator's pass-through columns can still be pruned by later consumers."""
    flag = F.explode(F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    return df.select("*", flag.alias("_kept")).drop("_kept")


def required_filter(df: DataFrame, required, computed=()) -> DataFrame:
    """P-9: ``dropna(subset=required)``.  Columns in ``computed`` (outputs of
    multi-step transforms) are checked by ``keep_where``; the others by an
    ordinary filter, which Catalyst pushes down to the scan."""
    plain = [c for c in required if c not in computed]
    heavy = [c for c in required if c in computed]
    if plain:
        df = df.dropna(subset=plain)
    if heavy:
        df = keep_where(df, reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in heavy]))
    return df


def migrate(df: DataFrame, spec: TableSpec | str, nulls: str = "collapse", columns=None) -> DataFrame:
    """The reference's table transform: project -> keep-first dedup -> dropna.
    ``columns`` computes these target columns only (with what dedup and the
    required filter look at), for checks that need a few of them."""
    if isinstance(spec, str):
        spec = SPECS[spec]
    needed = None if columns is None else [name for name, _, _ in spec.columns if name in {*columns, *spec.dedup_on, *spec.required}]
    source = df
    for name, s, tr in spec.columns:  # a null source gives a null target: let the scan drop such rows, if no dedup looks at them
        if name in spec.required and not spec.dedup_on and len(stages(tr)) > 1:
            source = source.where(F.col(s).isNotNull())
    out = project(source, spec, keep_key=bool(spec.dedup_on), columns=needed)
    if spec.dedup_on:
        out = dedup_keep_first(out, spec.dedup_on, "_src_key", nulls=nulls).drop("_src_key")
    computed = [name for name, _, tr in spec.columns if len(stages(tr)) > 1]
    out = required_filter(out, spec.required, computed)
    return out if columns is None else out.select(*columns)


def surrogate_keys(df: DataFrame, order_col, id_col: str = "target_id") -> DataFrame:
    """W-3: dense ``SERIAL``-style ids 1..n in ``order_col`` order (a column or a
    list, nulls last), without a single-partition window.

    The rows are range-partitioned, sorted and written once to the shared folder
    with their partition and their place in it; the counts per partition (one row
    per partition, read from that narrow column) give running offsets.
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    by = [F.col(c).asc_nulls_last() for c in order]
    ranked = (df.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_place", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ranked = written(ranked)
    counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return ranked.join(offsets, "_pid").withColumn(id_col, F.col("_off") + F.col("_place") + 1).drop("_pid", "_place", "_off")
