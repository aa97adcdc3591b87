"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the given
test tables (or legacy views Spark derives from them), so its work grows with
the tables.  ``__spark_entry__`` exposes this catalog to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyload.functions import normalize as N
from tidyload.operators import transform as T
from tidyload.sources.legacy import legacy_table
from tidyload.plans.specs import SPECS

QUERIES = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _legacy(spark, sf_dir, table):
    return legacy_table(spark, sf_dir, table)


# ---- normalisers (N-*) ------------------------------------------------------

@register("norm_date_orders")
def norm_date_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _legacy(spark, sf_dir, "orders").withColumn("ord_date_raw", F.col("ord_date"))
    return T.staged_select(o, [("order_date", "ord_date", "normalize_date"),
                               ("expected_delivery", "ord_exp_deliver", "normalize_date"),
                               ("delivered_at", "ord_delivered", "normalize_date")],
                           ["ord_id", "ord_date_raw"]).withColumnRenamed("ord_date_raw", "ord_date")


def date_layout(c) -> "F.Column":
    """Label of the layout a raw date text is in (R-11 census key)."""
    s = N.strip(c)
    out = F.when(F.col(c).isNull(), F.lit("null"))
    for label, regex, _ in N.DATE_LAYOUTS:
        out = out.when(s.rlike(regex), F.lit(label))
    return out.otherwise(F.lit("other"))


@register("norm_date_loss")
def norm_date_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-11: source layout x converted-or-lost census of one normalised column."""
    o = _legacy(spark, sf_dir, "orders").withColumn("source_format", date_layout("ord_date"))
    d = T.staged_select(o, [("order_date", "ord_date", "normalize_date")], ["source_format"])
    return (d.select("source_format", F.col("order_date").isNull().alias("target_null"))
            .groupBy("source_format", "target_null").agg(F.count(F.lit(1)).alias("n_rows")))


@register("norm_status_customer")
def norm_status_customer(spark, sf_dir):
    c = _legacy(spark, sf_dir, "customers")
    return c.select("cst_id", "cst_status", N.normalize_status_customer("cst_status").alias("status"))


@register("norm_status_order")
def norm_status_order(spark, sf_dir):
    o = _legacy(spark, sf_dir, "orders")
    return o.select("ord_id", "ord_status", N.normalize_status_order("ord_status").alias("status"))


@register("norm_bool")
def norm_bool(spark, sf_dir):
    p = _legacy(spark, sf_dir, "products")
    return p.select("prod_id", "prod_active", N.normalize_bool("prod_active").alias("is_active"))


@register("norm_country")
def norm_country(spark, sf_dir):
    c = _legacy(spark, sf_dir, "customers")
    return c.select("cst_id", "cst_country", N.normalize_country("cst_country").alias("country_code"))


@register("norm_currency")
def norm_currency(spark, sf_dir):
    p = _legacy(spark, sf_dir, "products")
    return p.select("prod_id", "prod_currency", N.normalize_currency("prod_currency").alias("currency_code"))


@register("norm_phone")
def norm_phone(spark, sf_dir):
    c = _legacy(spark, sf_dir, "customers")
    return c.select("cst_id", "cst_phone", N.normalize_phone("cst_phone").alias("phone"))


@register("norm_strip_case")
def norm_strip_case(spark, sf_dir):
    """N-8 / N-12 / P-2: lower+strip email, upper+strip channel in its domain."""
    o = _legacy(spark, sf_dir, "orders")
    return o.select("ord_id", "ord_channel",
                    N.upper_strip("ord_channel").alias("channel_clean"),
                    N.domain_restrict(N.upper_strip("ord_channel"), N.CHANNELS).alias("channel"))


@register("clip_fill_cast")
def clip_fill_cast(spark, sf_dir):
    """P-3..P-7 on order lines (quantity, price, discount)."""
    li = _legacy(spark, sf_dir, "order_lines")
    return T.project(li, SPECS["order_lines"])


# ---- table transforms (P-1..P-9, W-1) --------------------------------------

def _migrate(table):
    def q(spark, sf_dir):
        return T.migrate(_legacy(spark, sf_dir, table), SPECS[table])
    q.__name__ = f"migrate_{table}"
    return q


for _t in ["customers", "products", "suppliers", "orders", "order_lines"]:
    register(f"migrate_{_t}")(_migrate(_t))


@register("dedup_keep_first")
def dedup_keep_first(spark, sf_dir):
    c = T.project(_legacy(spark, sf_dir, "customers"), SPECS["customers"], keep_key=True)
    return T.dedup_keep_first(c, ["email"], "_src_key").select("legacy_cst_id", "email")


@register("dedup_rejects")
def dedup_rejects(spark, sf_dir):
    c = T.project(_legacy(spark, sf_dir, "customers"), SPECS["customers"], keep_key=True)
    return (T.dedup_rejects(c.select("_src_key", "email"), ["email"], "_src_key")
            .select(F.col("_src_key").alias("legacy_cst_id"), "email",
                    F.col("kept__src_key").alias("kept_legacy_cst_id")))


@register("dedup_order_lines")
def dedup_order_lines(spark, sf_dir):
    """W-1 on a row key that repeats: order lines by legacy line id."""
    li = T.project(_legacy(spark, sf_dir, "order_lines"), SPECS["order_lines"], keep_key=True)
    return T.dedup_keep_first(li, ["legacy_line_id"], "_src_key").drop("_src_key")


@register("dedup_order_lines_rejects")
def dedup_order_lines_rejects(spark, sf_dir):
    """W-2 on a row key that repeats: every line but the one kept."""
    li = T.project(_legacy(spark, sf_dir, "order_lines"), SPECS["order_lines"], keep_key=True)
    return T.dedup_rejects(li, ["legacy_line_id"], "_src_key").drop("_src_key").withColumnRenamed("kept__src_key", "kept_legacy_line_id")


# ---- profile (A-*) and encoding detection (D-1..D-4) -------------------------

from tidyload.operators import profile as P  # noqa: E402
from tidyload.sources.tables import read_table  # noqa: E402

PROFILED_TEST_TABLES = ["customer", "part", "lineitem", "events", "documents"]


def _profile_test(table):
    def q(spark, sf_dir):
        return P.profile(read_table(spark, sf_dir, table), table)
    return q


def _profile_legacy(table):
    def q(spark, sf_dir):
        return P.profile(_legacy(spark, sf_dir, table), table)
    return q


for _t in PROFILED_TEST_TABLES:
    register(f"profile_{_t}")(_profile_test(_t))
for _t in ["customers", "products", "suppliers", "orders", "order_lines"]:
    register(f"profile_legacy_{_t}")(_profile_legacy(_t))


@register("date_census")
def date_census(spark, sf_dir):
    """D-1/D-2 over every text column of the legacy orders."""
    p = P.profile(_legacy(spark, sf_dir, "orders"), "orders")
    return p.where("is_text").select("column_name", "date_iso", "date_fr", "date_us", "date_compact",
                                     "n_date_formats", "mixed_dates")


@register("bool_encoding")
def bool_encoding(spark, sf_dir):
    """D-3 over the legacy products and suppliers."""
    a = P.profile(_legacy(spark, sf_dir, "products"), "products")
    b = P.profile(_legacy(spark, sf_dir, "suppliers"), "suppliers")
    return a.unionByName(b).where(F.col("bool_encoding").isNotNull()).select(
        "table_name", "column_name", "bool_encoding")


@register("status_encoding")
def status_encoding(spark, sf_dir):
    """D-4 / A-11 over the legacy customers and orders."""
    a = P.profile(_legacy(spark, sf_dir, "customers"), "customers")
    b = P.profile(_legacy(spark, sf_dir, "orders"), "orders")
    return a.unionByName(b).where(F.col("status_encoding").isNotNull()).select(
        "table_name", "column_name", "unique_count", "status_encoding")


@register("dup_rows_lineitem")
def dup_rows_lineitem(spark, sf_dir):
    return P.dup_rows(read_table(spark, sf_dir, "lineitem"), "lineitem")


@register("dup_rows_documents")
def dup_rows_documents(spark, sf_dir):
    return P.dup_rows(read_table(spark, sf_dir, "documents").drop("doc_id"), "documents")


@register("dup_keys")
def dup_keys(spark, sf_dir):
    """A-9 on documents text (exact copies) and legacy keys."""
    d = P.dup_keys(read_table(spark, sf_dir, "documents"), "documents", ["doc_id", "text"])
    c = P.dup_keys(_legacy(spark, sf_dir, "customers"), "customers", ["cst_id", "cst_email"])
    p = P.dup_keys(_legacy(spark, sf_dir, "products"), "products", ["prod_ref"])
    return d.unionByName(c).unionByName(p)


# ---- quality (Q-*, G-*) -------------------------------------------------------

from functools import reduce as _reduce  # noqa: E402

from pyspark.sql import DataFrame as _DF  # noqa: E402

from tidyload.operators import quality as Q  # noqa: E402

LEGACY_ORDER = ["customers", "products", "orders", "order_lines", "suppliers"]


def _assess(spark, sf_dir, table):
    return Q.assess(_legacy(spark, sf_dir, table), table)


def _anomalies(table):
    def q(spark, sf_dir):
        return Q.anomalies(_assess(spark, sf_dir, table))
    return q


def _rules(table):
    def q(spark, sf_dir):
        return Q.rule_results(_assess(spark, sf_dir, table))
    return q


for _t in LEGACY_ORDER:
    register(f"anomalies_{_t}")(_anomalies(_t))
    register(f"rule_results_{_t}")(_rules(_t))


def _assessed(spark, sf_dir, tables=LEGACY_ORDER):
    return _reduce(_DF.unionByName, [_assess(spark, sf_dir, t) for t in tables])


@register("quality_score")
def quality_score(spark, sf_dir):
    """G-7 + G-9 for the five legacy tables."""
    return Q.score(Q.rule_results(_assessed(spark, sf_dir)))


@register("score_by_severity")
def score_by_severity(spark, sf_dir):
    return Q.score_by_severity(Q.rule_results(_assessed(spark, sf_dir)))


@register("quality_summary")
def quality_summary(spark, sf_dir):
    """G-10: per-table score, gate and number of findings, plus the ALL row."""
    return Q.quality_summary(_assessed(spark, sf_dir))


# Yesterday's valid sets, which today's load no longer meets (G-3).
SUPPLIED_SETS = {
    "ord_status": ["P", "PEND", "pending", "C", "CONF", "confirmed", "S", "SHIP", "shipped", "D", "DELIV", "delivered"],
    "ord_channel": ["WEB", "tel", " Store ", "API", "FAX"],
    "ord_tva": [0.0, 7.0],
}


@register("rule_supplied_sets")
def rule_supplied_sets(spark, sf_dir):
    """G-3 with supplied sets: the legacy orders against other values than their own."""
    rules = Q.rule_results(Q.assess(_legacy(spark, sf_dir, "orders"), "orders", valid_sets=SUPPLIED_SETS))
    return rules.where(F.col("rule_type").endswith("_in_set") & F.col("column_name").isin(list(SUPPLIED_SETS))).select(
        "rule_id", "column_name", "valid_set", "passed", "observed")


def second_load(customers: DataFrame) -> DataFrame:
    """The legacy customers of a later load: segments and statuses that were not there before."""
    k = F.col("cst_id")
    return customers.withColumn("cst_segment", F.when(k % 40 == 7, F.lit("GOV, NGO")).otherwise(F.col("cst_segment"))).withColumn(
        "cst_status", F.when(k % 60 == 1, F.lit("blocked")).otherwise(F.col("cst_status")))


@register("rule_store")
def rule_store(spark, sf_dir):
    """G-3 over two runs: the valid sets that the first load of the customers shows are
    stored and hold for the second load, whose new values fail."""
    path = shared_path(spark, "rules")
    first = _legacy(spark, sf_dir, "customers").select("cst_id", "cst_segment", "cst_status", "cst_country")
    sets = Q.supplied_sets(Q.learn_rules({"customers": first}, path, "first"))["customers"]
    rules = Q.rule_results(Q.assess(second_load(first), "customers", valid_sets=sets))
    return rules.where(F.col("rule_type").endswith("_in_set") & F.col("column_name").isin(list(sets))).select(
        "rule_id", "column_name", "valid_set", "passed", "observed")


# ---- load stats, reconciliation, drift (K-2, R-*) ----------------------------

from tidyload.operators import constraints as C  # noqa: E402
from tidyload.operators import reconcile as R  # noqa: E402
from tidyload.operators import registry as KR  # noqa: E402
from tidyload.operators import row_reconcile as RR  # noqa: E402
from tidyload.plans.specs import VALID_STATUSES  # noqa: E402

MIGRATION_ORDER = ["customers", "products", "suppliers", "orders", "order_lines"]


def _frames(spark, sf_dir, tables=MIGRATION_ORDER, columns=None):
    """Source and migrated frames; ``columns`` (table -> target columns) computes these only."""
    src = {t: _legacy(spark, sf_dir, t) for t in tables}
    tgt = {t: T.migrate(src[t], SPECS[t], columns=(columns or {}).get(t)) for t in tables}
    return src, tgt


def _union(parts):
    return _reduce(_DF.unionByName, parts)


@register("reconcile_counts")
def reconcile_counts(spark, sf_dir):
    src, tgt = _frames(spark, sf_dir)
    return _union([R.load_stats(src[t], tgt[t], t) for t in MIGRATION_ORDER])


@register("reconcile_numeric")
def reconcile_numeric(spark, sf_dir):
    _, tgt = _frames(spark, sf_dir)
    return _union([R.numeric_checks(tgt[t], t) for t in MIGRATION_ORDER])


@register("reconcile_keys")
def reconcile_keys(spark, sf_dir):
    _, tgt = _frames(spark, sf_dir)
    return _union([R.key_checks(tgt[t], t) for t in MIGRATION_ORDER])


@register("reconcile_verdict")
def reconcile_verdict(spark, sf_dir):
    src, tgt = _frames(spark, sf_dir)
    return R.verdict(src, tgt)


@register("reconcile_rows")
def reconcile_rows(spark, sf_dir):
    src, tgt = _frames(spark, sf_dir)
    return _union([R.pair_rows(src[t], tgt[t], SPECS[t].key, SPECS[t].target_key, t) for t in MIGRATION_ORDER])


@register("reconcile_values")
def reconcile_values(spark, sf_dir):
    """J-4 by value: the migrated suppliers and orders against a target as a faulty load
    leaves it: lower-cased names, a lost date, a changed key."""
    _, tgt = _frames(spark, sf_dir, ["suppliers", "orders"])
    sup, ords = tgt["suppliers"], tgt["orders"]
    k, o = F.col("legacy_sup_id"), F.col("legacy_ord_id")
    bad_sup = sup.withColumn("name", F.when(k % 5 == 0, F.lower("name")).otherwise(F.col("name")))
    bad_ord = ords.withColumn("delivered_at", F.when(o % 97 == 0, F.lit(None)).otherwise(F.col("delivered_at"))).withColumn(
        "channel", F.when(o % 194 == 0, F.lit("FAX")).otherwise(F.col("channel"))).withColumn(
        "legacy_ord_id", F.when(o % 101 == 0, -o).otherwise(o))
    parts = [RR.compare_rows(a, b, key).select(F.lit(t).alias("table_name"), F.col(key).alias("key"), "status",
                                               F.array_join("changed", ",").alias("changed"))
             for t, key, a, b in (("suppliers", "legacy_sup_id", sup, bad_sup), ("orders", "legacy_ord_id", ords, bad_ord))]
    return _union(parts)


def _drifts(spark, sf_dir):
    src, tgt = _frames(spark, sf_dir)
    return _union([R.drift(tgt[t], t, src[t], VALID_STATUSES.get(t)) for t in MIGRATION_ORDER])


@register("drift_issues")
def drift_issues(spark, sf_dir):
    """R-6 .. R-8b for the five migrated tables."""
    return R.drift_issues(_drifts(spark, sf_dir))


def _table_list(spark):
    return spark.createDataFrame([(t,) for t in MIGRATION_ORDER], "table_name string")


@register("migration_status")
def migration_status(spark, sf_dir):
    return R.migration_status(_drifts(spark, sf_dir))


@register("run_summary")
def run_summary(spark, sf_dir):
    return R.run_summary(_drifts(spark, sf_dir))


# ---- constraints, foreign keys, lookups (C-*, J-*, W-3, R-9) -----------------

@register("check_not_null")
def check_not_null(spark, sf_dir):
    _, tgt = _frames(spark, sf_dir)
    return _union([C.check_not_null(tgt[t], t) for t in MIGRATION_ORDER])


@register("check_unique")
def check_unique(spark, sf_dir):
    """C-2 on the migrated tables and on lineitem's (l_orderkey, l_linenumber)."""
    keys = C.UNIQUE | {"lineitem": [["l_orderkey", "l_linenumber"]]}
    _, tgt = _frames(spark, sf_dir, columns={t: [c for k in keys[t] for c in k] for t in MIGRATION_ORDER})
    return C.check_unique(tgt | {"lineitem": read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])}, keys)


@register("check_range")
def check_range(spark, sf_dir):
    _, tgt = _frames(spark, sf_dir, ["products", "suppliers", "orders", "order_lines"])
    return _union([C.check_range(tgt[t], t) for t in ["products", "suppliers", "orders", "order_lines"]])


@register("check_set")
def check_set(spark, sf_dir):
    """C-4 on the migrated tables, on their sources (where it fails), and on the
    statuses of the row-level log."""
    src, tgt = _frames(spark, sf_dir, ["customers", "orders"])
    raw = {"customers": src["customers"].select(F.col("cst_segment").alias("segment")),
           "orders": src["orders"].select(F.col("ord_channel").alias("channel"))}
    log = C.row_level_log(src["customers"], SPECS["customers"], "run_sf")
    return _union([C.check_set(tgt[t], t) for t in tgt] + [C.check_set(raw[t], f"legacy_{t}", C.SETS[t]) for t in raw]
                  + [C.check_set(log, "migration_log")])


@register("check_length")
def check_length(spark, sf_dir):
    _, tgt = _frames(spark, sf_dir)
    return _union([C.check_length(tgt[t], t) for t in MIGRATION_ORDER])


@register("fk_orphans")
def fk_orphans(spark, sf_dir):
    """J-1: the eight relations of the target DDL over the migrated tables, whose
    key columns alone are computed."""
    _, tgt = _frames(spark, sf_dir, columns={t: C.key_columns(t) for t in MIGRATION_ORDER})
    return C.all_fk_orphans(spark, tgt)


@register("surrogate_keys")
def surrogate_keys(spark, sf_dir):
    """W-3: dense customer ids in legacy-id order."""
    _, tgt = _frames(spark, sf_dir, ["customers"])
    return T.surrogate_keys(tgt["customers"], "legacy_cst_id", "customer_id").select(
        "customer_id", "legacy_cst_id")


@register("key_registry")
def key_registry(spark, sf_dir):
    """W-3 over two loads: first the customers that have orders, then all of them. Keys
    keep the ids of the first load, the new ones go on from there."""
    _, tgt = _frames(spark, sf_dir, ["customers", "orders"])
    customers = tgt["customers"].select("legacy_cst_id")
    buyers = customers.join(tgt["orders"].select(F.col("customer_id").alias("legacy_cst_id")), "legacy_cst_id", "left_semi")
    path = shared_path(spark, "key_registry")
    KR.register(buyers, "legacy_cst_id", path, "first")
    return KR.register(customers, "legacy_cst_id", path, "second").select(F.col("legacy_key").alias("legacy_cst_id"), "id", "load")


@register("fk_resolve")
def fk_resolve(spark, sf_dir):
    """J-2: orders' legacy customer id -> the migrated customer's surrogate id."""
    _, tgt = _frames(spark, sf_dir, ["customers", "orders"])
    cust = T.surrogate_keys(tgt["customers"], "legacy_cst_id", "customer_id")
    o = tgt["orders"].select("legacy_ord_id", F.col("customer_id").alias("legacy_customer_id"))
    return C.resolve_fk(o, "legacy_customer_id", cust, "legacy_cst_id", "customer_id", "customer_id")


@register("dim_lookup")
def dim_lookup(spark, sf_dir):
    """J-3: order status -> label / is_terminal; country -> name / region."""
    from tidyload.sources.tables import dimension
    _, tgt = _frames(spark, sf_dir, ["customers", "orders"])
    o = C.dim_lookup(tgt["orders"].select("legacy_ord_id", "status"), "status",
                     dimension(spark, "dim_status_order"), "status_code", ["label", "is_terminal"])
    c = C.dim_lookup(tgt["customers"].select("legacy_cst_id", "country_code"), "country_code",
                     dimension(spark, "dim_country"), "country_code", ["country_name", "region"])
    return (o.select(F.lit("orders").alias("table_name"), F.col("legacy_ord_id").alias("legacy_id"),
                     F.col("status").alias("code"), F.col("label").alias("name"),
                     F.col("is_terminal").cast("string").alias("extra"))
            .unionByName(c.select(F.lit("customers").alias("table_name"), F.col("legacy_cst_id").alias("legacy_id"),
                                  F.col("country_code").alias("code"), F.col("country_name").alias("name"),
                                  F.col("region").alias("extra"))))


@register("total_ttc")
def total_ttc(spark, sf_dir):
    _, tgt = _frames(spark, sf_dir, ["orders"])
    return tgt["orders"].select("legacy_ord_id", C.total_ttc("subtotal_ht", "tva_rate").cast("double")
                                .alias("total_ttc"))


@register("line_total")
def line_total(spark, sf_dir):
    """C-8 and the source-vs-generated difference (the source ignores discount)."""
    src = _legacy(spark, sf_dir, "order_lines")
    proj = T.project(src, SPECS["order_lines"], extra={"line_total": "source_line_total"})
    lt = C.line_total("quantity", "unit_price", "discount_pct")
    return proj.select("legacy_line_id", lt.cast("double").alias("line_total"),
                       (C.to_numeric("source_line_total", 14, 2) - lt).cast("double")
                       .alias("source_minus_generated"))


@register("row_level_log")
def row_level_log(spark, sf_dir):
    """R-9: per source row of the five tables: success with its target id, or
    skipped (duplicate / missing), logged to the run's table and read back."""
    path = shared_path(spark, "row_log")
    for t in MIGRATION_ORDER:
        log = K.log_rows(C.row_level_log(_legacy(spark, sf_dir, t), SPECS[t], "run_sf"), path)
    return log


# ---- mapping (S-6, D-5 .. D-10, P-10 .. P-16) --------------------------------

from tidyload.operators import mapping as M  # noqa: E402
from tidyload.plans.mappings import RELABELLED  # noqa: E402
from tidyload.sources.legacy import ORDER_KEYS  # noqa: E402


def _patterns(spark, sf_dir, tables):
    parts = []
    for t in tables:
        df = _legacy(spark, sf_dir, t)
        parts.append(M.value_patterns(df, t, [c for c in df.columns if c != ORDER_KEYS[t]]))
    return _union(parts)


@register("sampled_pattern")
def sampled_pattern(spark, sf_dir):
    """D-5 by its sampling option, over the first 50 values (S-5) of the legacy orders."""
    return M.sampled_patterns(_legacy(spark, sf_dir, "orders"), "orders", "ord_id")


@register("value_pattern")
def value_pattern(spark, sf_dir):
    """D-5 over all values of the legacy tables."""
    return _patterns(spark, sf_dir, MIGRATION_ORDER)


def _enriched(spark, sf_dir):
    rows = M.mapping_rows(M.read_mapping_documents(spark, form="proposed"))
    return M.enrich(rows, _patterns(spark, sf_dir, MIGRATION_ORDER))


@register("mapping_enrich")
def mapping_enrich(spark, sf_dir):
    """D-6 .. D-8: type families/compatibility and data-driven upgrades."""
    return _enriched(spark, sf_dir).drop("migration_complexity")


@register("mapping_ambiguous")
def mapping_ambiguous(spark, sf_dir):
    return M.ambiguous(_enriched(spark, sf_dir)).select("table_name", "source_col", "target_col", "confidence")


@register("mapping_summary")
def mapping_summary(spark, sf_dir):
    return M.summary(_enriched(spark, sf_dir))


def _staging(table, as_written=False):
    def q(spark, sf_dir):
        rows = M.mapping_rows(M.read_mapping_documents(spark, form="proposed"))
        return M.staging_model(_legacy(spark, sf_dir, table), rows, table, as_written)
    return q


for _t in MIGRATION_ORDER:
    register(f"stg_{_t}")(_staging(_t))
register("stg_products_as_written")(_staging("products", as_written=True))


def _mapped(spark, sf_dir, table):
    rows = M.mapping_rows(M.read_mapping_documents(spark))
    return M.apply_mapping(_legacy(spark, sf_dir, table), rows, table, relabelled=RELABELLED.get(table))


def _mapping_projection(table):
    def q(spark, sf_dir):
        """P-14: the committed mapping's own transforms (the wrong label of a currency apart)."""
        return _mapped(spark, sf_dir, table)
    return q


for _t in MIGRATION_ORDER:
    register(f"mapping_projection_{_t}")(_mapping_projection(_t))


@register("defaults_filled")
def defaults_filled(spark, sf_dir):
    """C-6 on the mapped rows of all tables: nulls per defaulted column, before and after."""
    parts = []
    for t in MIGRATION_ORDER:
        mapped = _mapped(spark, sf_dir, t)
        cols = [c for c in C.DEFAULTS[t] if c in mapped.columns]
        filled = C.apply_defaults(mapped.select(*cols, *[F.col(c).alias(f"_raw_{c}") for c in cols]), t)
        one = filled.agg(*[F.count_if(F.col(p + c).isNull()).alias(p + c) for c in cols for p in ("", "_raw_")])
        parts.append(one.select(F.explode(F.array(*[F.struct(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"_raw_{c}").alias("nulls_before"),
            F.col(c).alias("nulls_after")) for c in cols])).alias("r")).select("r.*"))
    return _union(parts)


# ---- loads, sinks, result documents, preflight (K-*, S-1..S-7, R-1) ----------

from tidyload.session import shared_path, written  # noqa: E402
from tidyload.sources import sinks as K  # noqa: E402
from tidyload.sources.tables import column_samples, first_rows, schema_rows  # noqa: E402


@register("load_roundtrip")
def load_roundtrip(spark, sf_dir):
    """K-1: overwrite-load the migrated orders into the shared folder, read back."""
    _, tgt = _frames(spark, sf_dir, ["orders"])
    return K.overwrite_load(tgt["orders"], shared_path(spark, "target", "orders"))


@register("audit_append")
def audit_append(spark, sf_dir):
    """K-2 + K-3: load stats of the five tables by two runs in a fresh log; the first
    run is logged twice, which changes nothing."""
    src, tgt = _frames(spark, sf_dir)
    stats = written(_union([R.load_stats(src[t], tgt[t], t) for t in MIGRATION_ORDER]))
    path = shared_path(spark, "migration_log")
    for _ in range(2):
        K.audit_append(stats, path, "run_a", "2024-01-15 10:00:00")
    return K.audit_append(stats, path, "run_b", "2024-01-16 10:00:00").drop("migrated_at")


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """K-4: the migrated suppliers through a header CSV extract and back."""
    _, tgt = _frames(spark, sf_dir, ["suppliers"])
    return K.csv_extract(tgt["suppliers"], shared_path(spark, "csv", "suppliers"))


def dirty_notes(customers: DataFrame) -> DataFrame:
    """Legacy customers with notes that a careless extract loses: quotes, line feeds,
    separators, backslashes, the null marker, empty and blank texts."""
    k = F.col("cst_id") % 9
    note = F.when(k == 0, F.lit(None))
    for i, text in enumerate(["", " ", 'he said "yes"', "two\nlines", "a,b;c\td", "\\N", "\\", '"'], 1):
        note = note.when(k == i, F.lit(text))
    return customers.withColumn("note", note)


@register("csv_dirty_roundtrip")
def csv_dirty_roundtrip(spark, sf_dir):
    """K-4 on the dirty legacy customers: white space, nulls, empty texts, quotes and line
    feeds come back as they were."""
    return K.csv_extract(dirty_notes(_legacy(spark, sf_dir, "customers")), shared_path(spark, "csv", "legacy_customers"))


@register("json_results")
def json_results(spark, sf_dir):
    """K-5: one quality document per table, without findings too, read back."""
    docs = K.write_documents(Q.documents(_assessed(spark, sf_dir), _table_list(spark)), shared_path(spark, "quality_docs"))
    return docs.select(F.col("table").alias("table_name"), "score", "approved", F.size("anomalies").cast("bigint").alias("n_anomalies"),
                       F.get("anomalies", F.lit(0))["anomaly_type"].alias("first_anomaly"),
                       F.size("rule_results").cast("bigint").alias("n_rules"), F.size("score_detail").cast("bigint").alias("n_severities"))


@register("json_documents")
def json_documents(spark, sf_dir):
    """K-5: mapping documents and run-log documents, one per table, read back."""
    maps = K.write_documents(M.documents(_enriched(spark, sf_dir)), shared_path(spark, "mapping_docs"))
    runs = K.write_documents(R.run_documents(_drifts(spark, sf_dir), "run_sf"), shared_path(spark, "run_docs"))
    return maps.select(F.lit("mapping").alias("kind"), F.col("table").alias("table_name"), F.col("migration_complexity").alias("state"),
                       F.size("mappings").cast("bigint").alias("n_entries")).unionByName(
        runs.select(F.lit("run").alias("kind"), F.col("table").alias("table_name"), F.col("status").alias("state"),
                    F.size("drift_issues").cast("bigint").alias("n_entries")))


@register("mapping_reload_orders")
def mapping_reload_orders(spark, sf_dir):
    """K-5 -> S-6 -> P-14: mapping documents written indented, read back and applied to
    the orders."""
    path = shared_path(spark, "mapping_files")
    K.write_documents(M.documents(M.mapping_rows(M.read_mapping_documents(spark))), path, indent=True)
    rows = M.mapping_rows(M.read_mapping_documents(spark, path))
    return M.apply_mapping(_legacy(spark, sf_dir, "orders"), rows, "orders", relabelled=RELABELLED.get("orders"))


@register("quality_reload")
def quality_reload(spark, sf_dir):
    """K-5 -> S-7: the quality documents of the five tables written indented and read back as reports."""
    path = shared_path(spark, "quality_files")
    K.write_documents(Q.documents(_assessed(spark, sf_dir), _table_list(spark)), path, indent=True)
    return K.read_quality_reports(spark, path)


@register("preflight")
def preflight(spark, sf_dir):
    """R-1 (+S-2, S-6, S-7): mapping present, mapped columns exist, quality read
    from the reports. As a run might find it, the order lines lack a mapped column
    and the suppliers have no report."""
    rows = M.mapping_rows(M.read_mapping_documents(spark))
    views = {t: _legacy(spark, sf_dir, t) for t in MIGRATION_ORDER}
    views["order_lines"] = views["order_lines"].drop("line_discount")
    schemas = _union([schema_rows(spark, df, t) for t, df in views.items()])
    path = shared_path(spark, "reports")
    K.write_documents(Q.documents(_assessed(spark, sf_dir, LEGACY_ORDER[:-1]), _table_list(spark).where("table_name != 'suppliers'")), path)
    return K.preflight(_table_list(spark), rows, schemas, K.read_quality_reports(spark, path))


@register("sample_values")
def sample_values(spark, sf_dir):
    """A-7 / S-5: first five non-null values per text column of the legacy
    customers (a sampling operator: the limit is the feature)."""
    c = _legacy(spark, sf_dir, "customers")
    cols = [f.name for f in c.schema.fields if f.dataType.simpleString() == "string"]
    s = column_samples(c, "cst_id", k=5, columns=cols)
    return s.select("column_name", F.col("position").cast("bigint").alias("position"), "value")


@register("first_rows")
def first_rows_q(spark, sf_dir):
    """S-4: the first three legacy orders by key (a top-k)."""
    return first_rows(_legacy(spark, sf_dir, "orders"), "ord_id", 3)


@register("load_ready_orders")
def load_ready_orders(spark, sf_dir):
    """C-6 + C-7 + J-2 + W-3: migrated orders with defaults, generated total,
    resolved customer surrogate key and their own surrogate key."""
    _, tgt = _frames(spark, sf_dir, ["customers", "orders"])
    cust = T.surrogate_keys(tgt["customers"], "legacy_cst_id", "customer_sk")
    o = C.apply_defaults(tgt["orders"], "orders")
    o = C.resolve_fk(o, "customer_id", cust, "legacy_cst_id", "customer_sk", "customer_sk")
    o = T.surrogate_keys(o, "legacy_ord_id", "order_id")
    return o.select("order_id", "legacy_ord_id", "customer_sk", "status", "order_date",
                    C.total_ttc("subtotal_ht", "tva_rate").cast("double").alias("total_ttc"))


@register("drift_date_loss")
def drift_date_loss(spark, sf_dir):
    """R-6 detail: per date column of the migrated orders, target nulls, nulls
    already in the source, and values LOST by conversion (source present,
    target null) — one aggregate over the projection with the sources kept."""
    src = _legacy(spark, sf_dir, "orders")
    pairs = [("order_date", "ord_date"), ("expected_delivery", "ord_exp_deliver"), ("delivered_at", "ord_delivered")]
    proj = T.project(src, SPECS["orders"], extra={s: f"_src_{t}" for t, s in pairs})
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (t, _) in enumerate(pairs):
        aggs += [F.count_if(F.col(t).isNull()).alias(f"_tn{i}"),
                 F.count_if(F.col(f"_src_{t}").isNull()).alias(f"_sn{i}"),
                 F.count_if(F.col(f"_src_{t}").isNotNull() & F.col(t).isNull()).alias(f"_l{i}")]
    one = proj.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("column_name"), F.col(f"_tn{i}").alias("target_nulls"),
                              F.col(f"_sn{i}").alias("source_nulls"), F.col(f"_l{i}").alias("lost"),
                              F.col("_rows").alias("row_count")) for i, (t, _) in enumerate(pairs)])
    return one.select(F.explode(rows).alias("r")).select(
        F.lit("orders").alias("table_name"), "r.column_name", "r.target_nulls", "r.source_nulls", "r.lost",
        "r.row_count")
