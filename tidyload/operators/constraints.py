"""Target constraints (C-1 .. C-8), foreign keys and lookups (J-1 .. J-3) and
the row-level migration log (R-9).

Constraint checks are one global aggregate per table (count of violating rows
per constraint, partial per task).  Keys and foreign keys of all tables are counted
in one shuffle each: every table is read once and unpivoted to (constraint, key)
entries, which map-side aggregation collapses, so a key holding a third of the rows
is one row per map task by the time it is shuffled.  Literal dimensions are
broadcast in lookups (their size is fixed by the DDL).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyload.functions.numeric import round_half_up
from tidyload.session import written
from tidyload.sources.tables import dimension

# The target DDL's constraints, per migrated table.
NOT_NULL = {
    "customers": ["status", "is_company"],
    "products": ["reference", "name", "currency_code", "stock_qty", "is_active"],
    "suppliers": ["name", "is_active"],
    "orders": ["order_reference", "customer_id", "order_date", "status"],
    "order_lines": ["order_id", "product_id", "quantity", "unit_price", "discount_pct"],
}
UNIQUE = {
    "customers": [["legacy_cst_id"], ["email"]],
    "products": [["legacy_prod_id"], ["reference"]],
    "suppliers": [["legacy_sup_id"]],
    "orders": [["legacy_ord_id"], ["order_reference"]],
    "order_lines": [["legacy_line_id"]],
}
# (name, column, low, high, low_inclusive) ; None = unbounded
RANGES = {
    "products": [("unit_price_ge_0", "unit_price", 0, None, True), ("stock_qty_ge_0", "stock_qty", 0, None, True)],
    "suppliers": [("rating_1_5", "rating", 1, 5, True)],
    "orders": [("subtotal_ht_ge_0", "subtotal_ht", 0, None, True), ("tva_rate_ge_0", "tva_rate", 0, None, True)],
    "order_lines": [("quantity_gt_0", "quantity", 0, None, False), ("unit_price_ge_0", "unit_price", 0, None, True),
                    ("discount_pct_0_100", "discount_pct", 0, 100, True)],
}
SETS = {
    "migration_log": [("status", ["success", "skipped", "error"])],
    "customers": [("segment", ["B2B", "B2C", "VIP"])],
    "orders": [("channel", ["WEB", "TEL", "STORE", "API"])],
}
# column -> (max characters) for VARCHAR(n)/CHAR(n)
LENGTHS = {
    "customers": {"first_name": 100, "last_name": 100, "company_name": 200, "email": 255, "phone": 30,
                  "country_code": 2, "city": 100, "segment": 20, "status": 10},
    "products": {"reference": 50, "name": 200, "category": 100, "currency_code": 3, "unit": 20},
    "suppliers": {"name": 200, "country_code": 2, "contact_name": 150, "email": 255, "phone": 30},
    "orders": {"order_reference": 30, "status": 20, "channel": 20},
}
# column -> (precision, scale) for NUMERIC(p,s)
PRECISION = {
    "products": {"unit_price": (12, 2)},
    "orders": {"subtotal_ht": (14, 2), "tva_rate": (5, 2)},
    "order_lines": {"unit_price": (12, 2), "discount_pct": (5, 2)},
}
DEFAULTS = {
    "customers": {"status": "active", "is_company": 0},
    "products": {"currency_code": "TND", "stock_qty": 0, "is_active": 1},
    "suppliers": {"is_active": 1},
    "orders": {"status": "pending"},
    "order_lines": {"discount_pct": 0.0},
}
# (child table, fk column, parent, parent key); parents named dim_* are literal dimensions
FOREIGN_KEYS = [
    ("customers", "country_code", "dim_country", "country_code"),
    ("customers", "status", "dim_status_customer", "status_code"),
    ("products", "currency_code", "dim_currency", "currency_code"),
    ("suppliers", "country_code", "dim_country", "country_code"),
    ("orders", "customer_id", "customers", "legacy_cst_id"),
    ("orders", "status", "dim_status_order", "status_code"),
    ("order_lines", "order_id", "orders", "legacy_ord_id"),
    ("order_lines", "product_id", "products", "legacy_prod_id"),
]

CHECK_COLS = ["table_name", "constraint_type", "constraint_name", "column_name", "violations"]


def _checks(df: DataFrame, table_name: str, checks) -> DataFrame:
    """checks: list of (type, name, column, violation-condition Column)."""
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "table_name string, constraint_type string, constraint_name string, column_name string, "
                "violations bigint")
    one = df.agg(*[F.count_if(cond).alias(f"_v{i}") for i, (_, _, _, cond) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(t).alias("constraint_type"), F.lit(n).alias("constraint_name"),
                              F.lit(c).alias("column_name"), F.col(f"_v{i}").cast("bigint").alias("violations"))
                     for i, (t, n, c, _) in enumerate(checks)])
    return one.select(F.explode(rows).alias("r")).select(F.lit(table_name).alias("table_name"), "r.*")


def check_not_null(df: DataFrame, table_name: str, columns=None) -> DataFrame:
    """C-1: rows with a null in a NOT NULL column."""
    columns = NOT_NULL.get(table_name, []) if columns is None else columns
    return _checks(df, table_name, [("not_null", f"{c}_not_null", c, F.col(c).isNull()) for c in columns])


def check_range(df: DataFrame, table_name: str, ranges=None) -> DataFrame:
    """C-3: CHECK ranges; null passes (SQL CHECK semantics)."""
    ranges = RANGES.get(table_name, []) if ranges is None else ranges
    checks = []
    for name, c, lo, hi, lo_inc in ranges:
        v = F.col(c)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | ((v < lo) if lo_inc else (v <= lo))
        if hi is not None:
            bad = bad | (v > hi)
        checks.append(("range", name, c, F.coalesce(bad, F.lit(False))))
    return _checks(df, table_name, checks)


def check_set(df: DataFrame, table_name: str, sets=None) -> DataFrame:
    """C-4: value outside its CHECK set (null passes)."""
    sets = SETS.get(table_name, []) if sets is None else sets
    return _checks(df, table_name, [("in_set", f"{c}_in_set", c,
                                     F.coalesce(~F.col(c).isin(list(vals)), F.lit(False))) for c, vals in sets])


def check_length(df: DataFrame, table_name: str) -> DataFrame:
    """C-5: VARCHAR(n)/CHAR(n) overflow and NUMERIC(p,s) overflow."""
    checks = [("length", f"{c}_len_{n}", c, F.coalesce(F.length(F.col(c)) > n, F.lit(False)))
              for c, n in LENGTHS.get(table_name, {}).items() if c in df.columns]
    for c, (p, s) in PRECISION.get(table_name, {}).items():
        if c in df.columns:
            checks.append(("precision", f"{c}_numeric_{p}_{s}", c,
                           F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()))
    return _checks(df, table_name, checks)


def check_unique(frames: dict, keys: dict | None = None) -> DataFrame:
    """C-2: duplicate (non-null) key tuples of several tables, ``frames`` by name,
    all in one shuffle: each table is read once."""
    keys = UNIQUE if keys is None else keys
    parts, listed = [], []
    for table_name, df in frames.items():
        own = keys.get(table_name, [])
        listed += [(table_name, "_".join(k) + "_unique", ",".join(k)) for k in own]
        entries = [F.struct(F.lit(table_name).alias("table_name"), F.lit("_".join(k) + "_unique").alias("constraint_name"),
                            F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in k]),
                                   F.to_json(F.struct(*k))).alias("key")) for k in own]
        parts.append(df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("key").isNotNull()))
    counted = reduce(DataFrame.unionByName, parts).groupBy("table_name", "constraint_name", "key").agg(F.count(F.lit(1)).alias("n"))
    by = counted.groupBy("table_name", "constraint_name").agg(F.sum(F.col("n") - 1).cast("bigint").alias("v"))
    names = next(iter(frames.values())).sparkSession.createDataFrame(listed, "table_name string, constraint_name string, column_name string")
    return names.join(by, ["table_name", "constraint_name"], "left").select(
        "table_name", F.lit("unique").alias("constraint_type"), "constraint_name", "column_name",
        F.coalesce("v", F.lit(0)).cast("bigint").alias("violations"))


def apply_defaults(df: DataFrame, table_name: str) -> DataFrame:
    """C-6: column defaults for nulls."""
    d = DEFAULTS.get(table_name, {})
    return df.select(*[F.coalesce(F.col(c), F.lit(d[c])).alias(c) if c in d else F.col(c) for c in df.columns])


def to_numeric(c, precision: int, scale: int) -> "F.Column":
    """A double stored as NUMERIC(p,s): rounded half-up at ``scale`` digits by an
    explicit formula first, so the decimal value does not depend on how an
    engine converts binary doubles."""
    return round_half_up(F.col(c) if isinstance(c, str) else c, scale).cast(f"decimal({precision},{scale})")


def total_ttc(subtotal, tva) -> "F.Column":
    """C-7: subtotal * (1 + tva/100) in NUMERIC(14,2), exact decimal arithmetic."""
    sub = to_numeric(subtotal, 14, 2)
    rate = to_numeric(tva, 5, 2)
    return (sub * (F.lit(100).cast("decimal(3,0)") + rate) * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(14,2)")


def line_total(qty, price, disc) -> "F.Column":
    """C-8: qty * price * (1 - disc/100) in NUMERIC(14,2), exact decimal arithmetic."""
    q = F.col(qty).cast("decimal(10,0)")
    p = to_numeric(price, 12, 2)
    d = to_numeric(disc, 5, 2)
    keep = (F.lit(100).cast("decimal(3,0)") - d) * F.lit(0.01).cast("decimal(3,2)")
    return (q * p * keep).cast("decimal(14,2)")


# ---- foreign keys / lookups --------------------------------------------------

def key_columns(table: str) -> list[str]:
    """The columns of a table that take part in a foreign key, on either side."""
    return list(dict.fromkeys([fk for child, fk, _, _ in FOREIGN_KEYS if child == table]
                              + [pk for _, _, parent, pk in FOREIGN_KEYS if parent == table]))


def all_fk_orphans(spark, migrated: dict, relations=None) -> DataFrame:
    """J-1: per relation, non-null child keys missing from the parent (orphan rows,
    orphan keys). Children and parents of all relations meet in one shuffle of
    (relation, key); each table is read once, for its key columns only."""
    relations = FOREIGN_KEYS if relations is None else relations
    used, entries = [], {}
    for child, fk, parent, pk in relations:
        if child not in migrated or not (parent.startswith("dim_") or parent in migrated):
            continue
        name = f"{child}.{fk}->{parent}.{pk}"
        used.append((name,))
        for table, column, is_child in ((child, fk, 1), (parent, pk, 0)):
            entries.setdefault(table, []).append(F.struct(
                F.lit(name).alias("relation"), F.col(column).cast("string").alias("key"), F.lit(is_child).alias("child")))
    parts = [(dimension(spark, t) if t.startswith("dim_") else migrated[t]).select(F.explode(F.array(*e)).alias("e")).select("e.*")
             for t, e in entries.items()]
    met = reduce(DataFrame.unionByName, parts).where(F.col("key").isNotNull()).groupBy("relation", "key").agg(
        F.sum("child").alias("n"), F.min("child").alias("orphan"))
    by = met.where(F.col("orphan") == 1).groupBy("relation").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"))
    return spark.createDataFrame(used, "relation string").join(by, "relation", "left").select(
        "relation", F.coalesce("rows", F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.coalesce("keys", F.lit(0)).cast("bigint").alias("orphan_keys"))


HEAVY = 1000
SPREAD = 64


def frequent_keys(df: DataFrame, key: str, most: int = HEAVY) -> DataFrame:
    """(key): at most ``most`` keys, among them all that hold more than a ``most``-th
    part of the rows, from one pass with a sketch of bounded size in each task. Keys that
    are not frequent may be among them."""
    top = df.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {most}, {100 * most})").alias("top"))
    return top.select(F.explode("top.item").alias("_key"))


def resolve_fk(child: DataFrame, fk: str, parent: DataFrame, legacy_key: str, surrogate: str,
               out: str) -> DataFrame:
    """J-2: replace a legacy foreign key by the parent's surrogate key (left
    join on the unique legacy key; unmatched rows keep a null, see J-1).

    Frequent keys do not meet in one task, whatever the join strategy: their parents,
    at most ``HEAVY`` rows, are broadcast and settle their children where they are; in the
    join of the rest, rows that are settled or have no key are spread over ``SPREAD``
    slices that no parent is in."""
    p = parent.select(F.col(legacy_key).alias("_lk"), F.col(surrogate).alias("_id"))
    hot = p.join(F.broadcast(frequent_keys(child, fk)), F.col("_lk") == F.col("_key"), "left_semi").select(
        F.col("_lk").alias("_hot"), F.col("_id").alias("_hot_id"))
    met = child.join(F.broadcast(hot), F.col(fk) == F.col("_hot"), "left")
    settled = F.col("_hot").isNotNull() | F.col(fk).isNull()
    met = met.withColumn("_rest", F.when(~settled, F.col(fk))).withColumn(
        "_slice", F.when(settled, 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in child.columns]), F.lit(SPREAD))).otherwise(F.lit(0)).cast("long"))
    # always 0, but not known to the optimiser, which would otherwise join on the key alone
    sliced = p.withColumn("_slot", F.pmod(F.xxhash64("_lk"), F.lit(1)).cast("long"))
    joined = met.join(sliced, (F.col("_rest") == F.col("_lk")) & (F.col("_slice") == F.col("_slot")), "left")
    kept = [F.col(f"`{c}`") for c in child.columns if c != out]
    return joined.select(*kept, F.coalesce("_hot_id", "_id").alias(out))


def dim_lookup(df: DataFrame, code_col: str, dim: DataFrame, dim_key: str, columns) -> DataFrame:
    """J-3: code -> label columns of a literal dimension (broadcast left join)."""
    d = dim.select(F.col(dim_key).alias("_dk"), *columns)
    return df.join(F.broadcast(d), df[code_col] == d["_dk"], "left").drop("_dk")


def row_level_log(source: DataFrame, spec, run_id: str) -> DataFrame:
    """R-9: one row per source row of a table: success with the target id it gets,
    or skipped with the reason.

    Target ids number the loaded rows in legacy-key order (W-3), as a load into a
    serial column does."""
    from tidyload.operators.transform import dedup_marks, project, surrogate_keys
    names = [spec.target_key, *spec.required, *spec.dedup_on]
    df = project(source, spec, keep_key=True, columns=names)
    if spec.dedup_on:
        df = dedup_marks(df, spec.dedup_on, "_src_key")
        dup = ~F.col("_kept")
    else:
        dup = F.lit(False)
    miss = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in spec.required])
    skipped = dup | (miss != "")
    message = (F.when(dup, F.concat(F.lit("duplicate on "), F.lit(",".join(spec.dedup_on))))
               .when(miss != "", F.concat(F.lit("missing required: "), miss)))
    ties = list(dict.fromkeys(names))
    # written once: filters on the status would otherwise be inlined over every normaliser, for each use again
    rows = written(df.select(F.col("_src_key").alias("legacy_id"), *[F.col(c).alias(f"_{c}") for c in ties],
                             F.when(skipped, F.lit("skipped")).otherwise(F.lit("success")).alias("status"), message.alias("error_message")))
    loaded = surrogate_keys(rows.where(F.col("status") == "success"), ["legacy_id", *[f"_{c}" for c in ties]], "target_id")
    out = [F.lit(run_id).alias("migration_run"), F.lit(spec.source).alias("table_name"), "legacy_id"]
    return loaded.select(*out, "target_id", "status", "error_message").unionByName(
        rows.where(F.col("status") != "success").select(*out, F.lit(None).cast("long").alias("target_id"), "status", "error_message"))
