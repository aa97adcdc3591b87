"""DuckDB oracle SQL per registered query key."""

from __future__ import annotations

from oracle import duck as D
from oracle import fixed as N
from tidyload.plans.specs import SPECS

SQL = {}


def _migrate_select(table: str) -> str:
    spec = SPECS[table]
    cols = ",\n  ".join(f"{D.SQL_TRANSFORMS[t](s)} AS {name}" for name, s, t in spec.columns)
    return cols


def _migrate_sql(table: str) -> str:
    spec = SPECS[table]
    proj = f"SELECT {_migrate_select(table)}, {spec.key} AS _src_key FROM legacy_{table}"
    req = " AND ".join(f"{c} IS NOT NULL" for c in spec.required)
    names = ", ".join(name for name, _, _ in spec.columns)
    if spec.dedup_on:
        part = ", ".join(spec.dedup_on)
        body = (f"SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY _src_key) AS rn "
                f"FROM ({proj})) WHERE rn = 1 AND {req}")
    else:
        body = f"SELECT {names} FROM ({proj}) WHERE {req}"
    return D.with_legacy(body, table)


for _t in SPECS:
    SQL[f"migrate_{_t}"] = _migrate_sql(_t)

SQL["norm_date_orders"] = D.with_legacy(
    f"SELECT ord_id, ord_date, {D.norm_date('ord_date')} AS order_date, "
    f"{D.norm_date('ord_exp_deliver')} AS expected_delivery, {D.norm_date('ord_delivered')} AS delivered_at "
    f"FROM legacy_orders", "orders")

_layout = "CASE WHEN ord_date IS NULL THEN 'null' " + " ".join(
    f"WHEN regexp_matches({D.strip('ord_date')}, '{rx}') THEN '{label}'" for label, rx in N.DATE_LAYOUTS
) + " ELSE 'other' END"
SQL["norm_date_loss"] = D.with_legacy(
    f"SELECT source_format, target_null, CAST(count(*) AS BIGINT) AS n_rows FROM ("
    f"SELECT {_layout} AS source_format, ({D.norm_date('ord_date')}) IS NULL AS target_null FROM legacy_orders) "
    f"GROUP BY source_format, target_null", "orders")

SQL["norm_status_customer"] = D.with_legacy(
    f"SELECT cst_id, cst_status, {D.norm_status_customer('cst_status')} AS status FROM legacy_customers", "customers")
SQL["norm_status_order"] = D.with_legacy(
    f"SELECT ord_id, ord_status, {D.norm_status_order('ord_status')} AS status FROM legacy_orders", "orders")
SQL["norm_bool"] = D.with_legacy(
    f"SELECT prod_id, prod_active, {D.norm_bool('prod_active')} AS is_active FROM legacy_products", "products")
SQL["norm_country"] = D.with_legacy(
    f"SELECT cst_id, cst_country, {D.norm_country('cst_country')} AS country_code FROM legacy_customers", "customers")
SQL["norm_currency"] = D.with_legacy(
    f"SELECT prod_id, prod_currency, {D.norm_currency('prod_currency')} AS currency_code FROM legacy_products",
    "products")
SQL["norm_phone"] = D.with_legacy(
    f"SELECT cst_id, cst_phone, {D.norm_phone('cst_phone')} AS phone FROM legacy_customers", "customers")
SQL["norm_strip_case"] = D.with_legacy(
    f"SELECT ord_id, ord_channel, {D.upper_strip('ord_channel')} AS channel_clean, "
    f"{D.SQL_TRANSFORMS['channel']('ord_channel')} AS channel FROM legacy_orders", "orders")
SQL["clip_fill_cast"] = D.with_legacy(
    f"SELECT {_migrate_select('order_lines')} FROM legacy_order_lines", "order_lines")

_cust_proj = (f"SELECT cst_id AS _src_key, {D.lower_strip('cst_email')} AS email FROM legacy_customers")
SQL["dedup_keep_first"] = D.with_legacy(
    f"SELECT _src_key AS legacy_cst_id, email FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY _src_key) AS rn "
    f"FROM ({_cust_proj})) WHERE rn = 1", "customers")
SQL["dedup_rejects"] = D.with_legacy(
    f"SELECT legacy_cst_id, email, kept_legacy_cst_id FROM (SELECT _src_key AS legacy_cst_id, email, "
    f"min(_src_key) OVER (PARTITION BY email) AS kept_legacy_cst_id, row_number() OVER (PARTITION BY email ORDER BY _src_key NULLS LAST) AS rn "
    f"FROM ({_cust_proj})) WHERE rn > 1", "customers")
_ol_names = [name for name, _, _ in SPECS["order_lines"].columns]
_ol = (f"SELECT *, row_number() OVER (PARTITION BY legacy_line_id ORDER BY _src_key NULLS LAST, {', '.join(f'{c} NULLS FIRST' for c in _ol_names)}) AS rn "
       f"FROM (SELECT {_migrate_select('order_lines')}, line_id AS _src_key FROM legacy_order_lines)")
SQL["dedup_order_lines"] = D.with_legacy(f"SELECT {', '.join(_ol_names)} FROM ({_ol}) WHERE rn = 1", "order_lines")
SQL["dedup_order_lines_rejects"] = D.with_legacy(
    f"SELECT {', '.join(_ol_names)}, legacy_line_id AS kept_legacy_line_id FROM ({_ol}) WHERE rn > 1", "order_lines")

# ---- profile ----------------------------------------------------------------
for _t in ["customer", "part", "lineitem", "events", "documents"]:
    SQL[f"profile_{_t}"] = D.profile_sql(_t, _t)
for _t in ["customers", "products", "suppliers", "orders", "order_lines"]:
    SQL[f"profile_legacy_{_t}"] = D.with_legacy(D.profile_sql(f"legacy_{_t}", _t), _t)

SQL["date_census"] = D.with_legacy(
    "SELECT column_name, date_iso, date_fr, date_us, date_compact, n_date_formats, mixed_dates FROM ("
    + D.profile_sql("legacy_orders", "orders") + ") WHERE is_text", "orders")
SQL["bool_encoding"] = D.with_legacy(
    "SELECT table_name, column_name, bool_encoding FROM (" + D.profile_sql("legacy_products", "products")
    + " UNION ALL " + D.profile_sql("legacy_suppliers", "suppliers") + ") WHERE bool_encoding IS NOT NULL",
    "products", "suppliers")
SQL["status_encoding"] = D.with_legacy(
    "SELECT table_name, column_name, unique_count, status_encoding FROM (" + D.profile_sql("legacy_customers", "customers")
    + " UNION ALL " + D.profile_sql("legacy_orders", "orders") + ") WHERE status_encoding IS NOT NULL",
    "customers", "orders")


def _dup_rows(rel, name, cols):
    c = ", ".join(cols)
    return (f"SELECT '{name}' AS table_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dup_rows, "
            f"CAST(count(*) AS BIGINT) AS distinct_rows FROM (SELECT {c}, count(*) AS n FROM {rel} GROUP BY ALL)")


SQL["dup_rows_lineitem"] = _dup_rows("lineitem", "lineitem", [c for c, _ in D.SCHEMAS["lineitem"]])
SQL["dup_rows_documents"] = _dup_rows("documents", "documents", ["text", "lang", "source", "n_chars"])


def _dup_keys(rel, name, cols):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, CAST(count({c}) - count(DISTINCT {c}) AS BIGINT) AS duplicates, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM {rel}" for c in cols)


SQL["dup_keys"] = D.with_legacy(
    _dup_keys("documents", "documents", ["doc_id", "text"]) + " UNION ALL "
    + _dup_keys("legacy_customers", "customers", ["cst_id", "cst_email"]) + " UNION ALL "
    + _dup_keys("legacy_products", "products", ["prod_ref"]), "customers", "products")

# ---- quality ------------------------------------------------------------------
from tidyload.plans.specs import CRITICAL_COLUMNS  # noqa: E402

_QT = ["customers", "products", "orders", "order_lines", "suppliers"]
for _t in _QT:
    SQL[f"anomalies_{_t}"] = D.with_ctes([_t], D.quality_ctes(_t, CRITICAL_COLUMNS[_t]), f"SELECT * FROM an_{_t}")
    SQL[f"rule_results_{_t}"] = D.with_ctes([_t], D.quality_ctes(_t, CRITICAL_COLUMNS[_t]), f"SELECT * FROM rr_{_t}")

_all_q = [c for t in _QT for c in D.quality_ctes(t, CRITICAL_COLUMNS[t])]
_rr_all = " UNION ALL ".join(f"SELECT * FROM rr_{t}" for t in _QT)
_an_all = " UNION ALL ".join(f"SELECT * FROM an_{t}" for t in _QT)
SQL["quality_score"] = D.with_ctes(_QT, _all_q + [("rr", _rr_all)], D.score_sql("rr"))
SQL["score_by_severity"] = D.with_ctes(_QT, _all_q + [("rr", _rr_all)], """
SELECT table_name, severity, CAST(count(*) AS BIGINT) AS total, CAST(count_if(passed) AS BIGINT) AS passed,
  ((2 * 1000 * count_if(passed) + count(*)) // (2 * count(*))) / 1000.0 AS score
FROM rr GROUP BY table_name, severity""")
SQL["quality_summary"] = D.with_ctes(_QT, _all_q + [("rr", _rr_all), ("an", _an_all), ("sc", D.score_sql("rr")),
    ("per", "SELECT sc.table_name, score, approved, CAST(coalesce(n, 0) AS BIGINT) AS n_anomalies FROM sc "
            "LEFT JOIN (SELECT table_name, count(*) AS n FROM an GROUP BY table_name) a ON sc.table_name = a.table_name")],
    "SELECT * FROM per UNION ALL SELECT 'ALL', CAST(NULL AS DOUBLE), bool_and(approved), CAST(sum(n_anomalies) AS BIGINT) FROM per")

_SETS = {"ord_status": ("VARCHAR", ["P", "PEND", "pending", "C", "CONF", "confirmed", "S", "SHIP", "shipped", "D", "DELIV", "delivered"],
                        "C,CONF,D,DELIV,P,PEND,S,SHIP,confirmed,delivered,pending,shipped"),
         "ord_channel": ("VARCHAR", ["WEB", "tel", " Store ", "API", "FAX"], " Store ,API,FAX,WEB,tel"),
         "ord_tva": ("DOUBLE", [0.0, 7.0], "0.0,7.0")}
SQL["rule_supplied_sets"] = D.with_legacy(" UNION ALL ".join(
    f"SELECT '{c}__valid_values' AS rule_id, '{c}' AS column_name, '{text}' AS valid_set, "
    f"count_if({c} IS NOT NULL AND {c} NOT IN {D.in_list(values)}) = 0 AS passed, "
    f"CAST(count_if({c} IS NOT NULL AND {c} NOT IN {D.in_list(values)}) AS DOUBLE) AS observed FROM legacy_orders"
    for c, (_, values, text) in _SETS.items()), "orders")

_NEW = {"cst_segment": "CASE WHEN cst_id % 40 = 7 THEN 'GOV, NGO' ELSE cst_segment END",
        "cst_status": "CASE WHEN cst_id % 60 = 1 THEN 'blocked' ELSE cst_status END", "cst_country": "cst_country"}
SQL["rule_store"] = D.with_legacy(" UNION ALL ".join(
    f"SELECT '{c}__valid_values' AS rule_id, '{c}' AS column_name, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM legacy_customers "
    f"WHERE {c} IS NOT NULL)) AS valid_set, count_if(bad) = 0 AS passed, CAST(count_if(bad) AS DOUBLE) AS observed FROM ("
    f"SELECT {e} IS NOT NULL AND {e} NOT IN (SELECT {c} FROM legacy_customers WHERE {c} IS NOT NULL) AS bad FROM legacy_customers)"
    for c, e in _NEW.items()), "customers")

# ---- migrated tables as CTEs ----------------------------------------------------
from tidyload.operators import constraints as CN  # noqa: E402
from tidyload.sources import tables as TB  # noqa: E402

MIG = ["customers", "products", "suppliers", "orders", "order_lines"]
MIG_SCHEMAS = {
    "customers": [("legacy_cst_id", "bigint"), ("first_name", "string"), ("last_name", "string"),
                  ("company_name", "string"), ("email", "string"), ("phone", "string"),
                  ("country_code", "string"), ("city", "string"), ("address", "string"),
                  ("segment", "string"), ("status", "string"), ("is_company", "int"),
                  ("created_at", "date"), ("notes", "string")],
    "products": [("legacy_prod_id", "bigint"), ("reference", "string"), ("name", "string"),
                 ("category", "string"), ("unit_price", "double"), ("currency_code", "string"),
                 ("stock_qty", "bigint"), ("unit", "string"), ("is_active", "int"), ("created_at", "date")],
    "suppliers": [("legacy_sup_id", "bigint"), ("name", "string"), ("country_code", "string"),
                  ("contact_name", "string"), ("email", "string"), ("phone", "string"), ("rating", "double"),
                  ("is_active", "int"), ("partner_since", "date")],
    "orders": [("legacy_ord_id", "bigint"), ("order_reference", "string"), ("customer_id", "bigint"),
               ("order_date", "date"), ("expected_delivery", "date"), ("delivered_at", "date"),
               ("status", "string"), ("subtotal_ht", "double"), ("tva_rate", "double"),
               ("channel", "string"), ("notes", "string")],
    "order_lines": [("legacy_line_id", "bigint"), ("order_id", "bigint"), ("product_id", "bigint"),
                    ("quantity", "bigint"), ("unit_price", "double"), ("discount_pct", "double")],
}


def mig_body(table: str) -> str:
    spec = SPECS[table]
    proj = f"SELECT {_migrate_select(table)}, {spec.key} AS _src_key FROM legacy_{table}"
    req = " AND ".join(f"{c} IS NOT NULL" for c in spec.required)
    names = ", ".join(name for name, _, _ in spec.columns)
    if spec.dedup_on:
        part = ", ".join(spec.dedup_on)
        return (f"SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY _src_key) AS rn "
                f"FROM ({proj})) WHERE rn = 1 AND {req}")
    return f"SELECT {names} FROM ({proj}) WHERE {req}"


def with_mig(body: str, tables=MIG) -> str:
    return D.with_ctes(tables, [(f"mig_{t}", mig_body(t)) for t in tables], body)


def _u(parts):
    return "\nUNION ALL\n".join(parts)


def _stats(t):
    return (f"SELECT '{t}' AS table_name, s.source_count, g.target_count, s.source_count >= g.target_count AS count_match, "
            f"s.source_count - g.target_count AS count_diff, {D.ratio('g.target_count', 's.source_count', 4)} AS load_rate "
            f"FROM (SELECT CAST(count(*) AS BIGINT) AS source_count FROM legacy_{t}) s, "
            f"(SELECT CAST(count(*) AS BIGINT) AS target_count FROM mig_{t}) g")


SQL["reconcile_counts"] = with_mig(_u([_stats(t) for t in MIG]))

_NUMT = ("int", "bigint", "double")


def _numeric(t):
    parts = []
    for c, ty in MIG_SCHEMAS[t]:
        if ty in _NUMT:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, min(CAST({c} AS DOUBLE)) AS target_min, "
                         f"max(CAST({c} AS DOUBLE)) AS target_max, {D.rhu(f'avg(CAST({c} AS DOUBLE))', 2)} AS target_mean, "
                         f"{D.ratio(f'count(*) - count({c})', 'count(*)', 4)} AS null_rate FROM mig_{t} HAVING count({c}) > 0")
    return parts


SQL["reconcile_numeric"] = with_mig(_u([p for t in MIG for p in _numeric(t)]))


def _keys(t):
    cols = [c for c, _ in MIG_SCHEMAS[t] if any(w in c.lower() for w in ("id", "ref", "email"))]
    return [f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count({c}) - count(DISTINCT {c}) AS BIGINT) AS duplicates, "
            f"count({c}) = count(DISTINCT {c}) AS unique_ok FROM mig_{t}" for c in cols]


SQL["reconcile_keys"] = with_mig(_u([p for t in MIG for p in _keys(t)]))
SQL["reconcile_verdict"] = with_mig(
    "SELECT s.table_name, s.count_diff, CAST(coalesce(k.key_issues, 0) AS BIGINT) AS key_issues, "
    "(s.count_diff <= s.source_count * 0.05) AND coalesce(k.key_issues, 0) = 0 AS overall_ok "
    f"FROM ({_u([_stats(t) for t in MIG])}) s LEFT JOIN (SELECT table_name, count_if(NOT unique_ok) AS key_issues "
    f"FROM ({_u([p for t in MIG for p in _keys(t)])}) GROUP BY table_name) k ON s.table_name = k.table_name")


def _pairs(t):
    sk, tk = SPECS[t].key, SPECS[t].target_key
    return (f"SELECT '{t}' AS table_name, status, CAST(sum(coalesce(ns, nt)) AS BIGINT) AS n_rows, "
            f"CAST(count(*) AS BIGINT) AS n_keys FROM (SELECT ns, nt, CASE WHEN ns IS NULL THEN 'extra_in_target' "
            f"WHEN nt IS NULL THEN 'missing_in_target' ELSE 'matched' END AS status FROM "
            f"(SELECT {sk} AS k, count(*) AS ns FROM legacy_{t} GROUP BY {sk}) a FULL OUTER JOIN "
            f"(SELECT {tk} AS k, count(*) AS nt FROM mig_{t} GROUP BY {tk}) b ON a.k = b.k) GROUP BY status")


SQL["reconcile_rows"] = with_mig(_u([_pairs(t) for t in MIG]))


def _drift(t):
    cols = [c for c, _ in MIG_SCHEMAS[t]]
    dates = [c for c in cols if "date" in c or c.split("_")[-1:] == ["at"]]
    parts = []
    agg = f"(SELECT count(*) AS _rows, {', '.join([f'count_if({c} IS NULL) AS _d{i}' for i, c in enumerate(dates)] + ['0 AS _z'])}"
    valid = {"customers": N.CUSTOMER_STATUSES, "orders": N.ORDER_STATUSES}.get(t)
    if valid:
        agg += f", count_if(NOT coalesce(status IN {D.in_list(valid)}, FALSE)) AS _st"
    negs = [c for c in ("unit_price", "subtotal_ht", "discount_pct") if c in cols]
    for i, c in enumerate(negs):
        agg += f", count_if(CAST({c} AS DOUBLE) < 0) AS _n{i}"
    agg += f" FROM mig_{t}) a, ({_stats(t)}) s"
    for i, c in enumerate(dates):
        parts.append(f"SELECT '{t}' AS table_name, CAST({10 + i} AS BIGINT) AS seq, 'DATE_CONVERSION_LOSS' AS issue_type, "
                     f"'{c}' AS column_name, 'MEDIUM' AS severity, CAST(_d{i} / _rows AS DOUBLE) AS metric FROM {agg} "
                     f"WHERE _rows > 0 AND _d{i} / _rows > 0.1")
    if valid:
        parts.append(f"SELECT '{t}', CAST(100 AS BIGINT), 'INVALID_STATUS_POST_TRANSFORM', 'status', 'HIGH', "
                     f"CAST(_st AS DOUBLE) FROM {agg} WHERE _st > 0")
    for i, c in enumerate(negs):
        parts.append(f"SELECT '{t}', CAST({200 + i} AS BIGINT), 'NEGATIVE_VALUE_POST_TRANSFORM', '{c}', 'HIGH', "
                     f"CAST(_n{i} AS DOUBLE) FROM {agg} WHERE _n{i} > 0")
    ret = "(CASE WHEN source_count > 0 THEN target_count / source_count ELSE 0.0 END)"
    parts.append(f"SELECT '{t}', CAST(300 AS BIGINT), 'LOW_RETENTION_RATE', 'ALL', "
                 f"CASE WHEN {ret} < 0.8 THEN 'HIGH' ELSE 'MEDIUM' END, CAST({ret} AS DOUBLE) FROM {agg} WHERE {ret} < 0.9")
    return parts


_DRIFT = _u([p for t in MIG for p in _drift(t)])
SQL["drift_issues"] = with_mig(_DRIFT)
_TABLES = "(VALUES " + ", ".join(f"('{t}')" for t in MIG) + ") tl(table_name)"
_STATUS = (f"SELECT tl.table_name, CASE WHEN w = 2 THEN 'failed' WHEN w = 1 THEN 'partial' ELSE 'success' END AS status, "
           f"CAST(coalesce(n_drift, 0) AS BIGINT) AS n_drift FROM {_TABLES} LEFT JOIN (SELECT table_name, "
           f"max(CASE WHEN severity = 'HIGH' THEN 2 ELSE 1 END) AS w, count(*) AS n_drift FROM ({_DRIFT}) GROUP BY table_name) d "
           f"ON tl.table_name = d.table_name")
SQL["migration_status"] = with_mig(_STATUS)
_PER = (f"SELECT s.table_name, st.status, s.source_count, s.target_count, st.n_drift FROM ({_u([_stats(t) for t in MIG])}) s "
        f"JOIN ({_STATUS}) st ON s.table_name = st.table_name")
SQL["run_summary"] = with_mig(
    f"SELECT table_name, status, source_count, target_count, {D.ratio('target_count', 'source_count', 4)} AS load_rate, "
    f"n_drift, CAST(CASE WHEN status = 'success' THEN 1 ELSE 0 END AS BIGINT) AS n_success FROM ({_PER}) "
    f"UNION ALL SELECT 'ALL', CAST(NULL AS VARCHAR), CAST(sum(source_count) AS BIGINT), CAST(sum(target_count) AS BIGINT), "
    f"{D.ratio('sum(target_count)', 'sum(source_count)', 4)}, CAST(sum(n_drift) AS BIGINT), "
    f"CAST(count_if(status = 'success') AS BIGINT) FROM ({_PER})")


# ---- constraints ----------------------------------------------------------------

def _check(t, typ, name, col, cond):
    return (f"SELECT '{t}' AS table_name, '{typ}' AS constraint_type, '{name}' AS constraint_name, '{col}' AS column_name, "
            f"CAST(count_if({cond}) AS BIGINT) AS violations FROM mig_{t}")


SQL["check_not_null"] = with_mig(_u([_check(t, "not_null", f"{c}_not_null", c, f"{c} IS NULL")
                                     for t in MIG for c in CN.NOT_NULL.get(t, [])]))


def _uniq(rel, t, cols):
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (f"SELECT '{t}' AS table_name, 'unique' AS constraint_type, '{'_'.join(cols)}_unique' AS constraint_name, "
            f"'{','.join(cols)}' AS column_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations FROM "
            f"(SELECT count(*) AS n FROM {rel} WHERE {nn} GROUP BY {', '.join(cols)})")


SQL["check_unique"] = with_mig(_u([_uniq(f"mig_{t}", t, cols) for t in MIG for cols in CN.UNIQUE.get(t, [])]
                                  + [_uniq("lineitem", "lineitem", ["l_orderkey", "l_linenumber"])]))


def _range(t):
    out = []
    for name, c, lo, hi, inc in CN.RANGES.get(t, []):
        conds = []
        if lo is not None:
            conds.append(f"{c} < {lo}" if inc else f"{c} <= {lo}")
        if hi is not None:
            conds.append(f"{c} > {hi}")
        out.append(_check(t, "range", name, c, f"coalesce({' OR '.join(conds)}, FALSE)"))
    return out


SQL["check_range"] = with_mig(_u([p for t in ["products", "suppliers", "orders", "order_lines"] for p in _range(t)]))
_LOG_STATUS = ("SELECT CASE WHEN row_number() OVER (PARTITION BY email ORDER BY _src_key) > 1 OR legacy_cst_id IS NULL THEN 'skipped' "
               f"ELSE 'success' END AS status FROM (SELECT {_migrate_select('customers')}, cst_id AS _src_key FROM legacy_customers)")


def _set(rel, t, c, v):
    return (f"SELECT '{t}' AS table_name, 'in_set' AS constraint_type, '{c}_in_set' AS constraint_name, '{c}' AS column_name, "
            f"CAST(count_if(coalesce(NOT ({c} IN {D.in_list(v)}), FALSE)) AS BIGINT) AS violations FROM {rel}")


SQL["check_set"] = with_mig(_u(
    [_set(f"mig_{t}", t, c, v) for t in ["customers", "orders"] for c, v in CN.SETS.get(t, [])]
    + [_set("(SELECT cst_segment AS segment FROM legacy_customers)", "legacy_customers", "segment", ["B2B", "B2C", "VIP"]),
       _set("(SELECT ord_channel AS channel FROM legacy_orders)", "legacy_orders", "channel", ["WEB", "TEL", "STORE", "API"]),
       _set(f"({_LOG_STATUS})", "migration_log", "status", ["success", "skipped", "error"])]), ["customers", "orders"])


def _length(t):
    out = [_check(t, "length", f"{c}_len_{n}", c, f"coalesce(length({c}) > {n}, FALSE)")
           for c, n in CN.LENGTHS.get(t, {}).items()]
    out += [_check(t, "precision", f"{c}_numeric_{p}_{s}", c, f"{c} IS NOT NULL AND abs({c}) >= {10.0 ** (p - s)}")
            for c, (p, s) in CN.PRECISION.get(t, {}).items()]
    return out


SQL["check_length"] = with_mig(_u([p for t in MIG for p in _length(t)]))


def _dim_values(name):
    rows, schema = TB.DIMENSIONS[name]
    cols = [c.split()[0] for c in schema.split(",")]
    vals = ", ".join("(" + ", ".join(D.q(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {vals}) v({', '.join(cols)}))"


def _fk(child, fk, parent, pk):
    par = _dim_values(parent) if parent.startswith("dim_") else f"mig_{parent}"
    return (f"SELECT '{child}.{fk}->{parent}.{pk}' AS relation, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows, "
            f"CAST(count(*) AS BIGINT) AS orphan_keys FROM (SELECT {fk} AS k, count(*) AS n FROM mig_{child} "
            f"WHERE {fk} IS NOT NULL GROUP BY {fk}) c WHERE k NOT IN (SELECT {pk} FROM {par} WHERE {pk} IS NOT NULL)")


SQL["fk_orphans"] = with_mig(_u([_fk(*r) for r in CN.FOREIGN_KEYS]))
_SK = "SELECT row_number() OVER (ORDER BY legacy_cst_id) AS customer_id, legacy_cst_id FROM mig_customers"
SQL["surrogate_keys"] = with_mig(_SK, ["customers"])
SQL["key_registry"] = with_mig(
    "SELECT * FROM (WITH b AS (SELECT legacy_cst_id, legacy_cst_id IN (SELECT customer_id FROM mig_orders WHERE customer_id IS NOT NULL) AS buys "
    "FROM (SELECT DISTINCT legacy_cst_id FROM mig_customers WHERE legacy_cst_id IS NOT NULL)) "
    "SELECT legacy_cst_id, row_number() OVER (ORDER BY buys DESC, legacy_cst_id) AS id, CASE WHEN buys THEN 'first' ELSE 'second' END AS load FROM b)",
    ["customers", "orders"])
SQL["fk_resolve"] = with_mig(
    f"SELECT o.legacy_ord_id, o.customer_id AS legacy_customer_id, c.customer_id FROM mig_orders o "
    f"LEFT JOIN ({_SK}) c ON o.customer_id = c.legacy_cst_id", ["customers", "orders"])
SQL["dim_lookup"] = with_mig(
    f"SELECT 'orders' AS table_name, o.legacy_ord_id AS legacy_id, o.status AS code, d.label AS name, "
    f"CAST(d.is_terminal AS VARCHAR) AS extra FROM mig_orders o LEFT JOIN {_dim_values('dim_status_order')} d "
    f"ON o.status = d.status_code UNION ALL SELECT 'customers', c.legacy_cst_id, c.country_code, d.country_name, d.region "
    f"FROM mig_customers c LEFT JOIN {_dim_values('dim_country')} d ON c.country_code = d.country_code",
    ["customers", "orders"])


def _num(c, p, s):
    return f"CAST({D.rhu(c, s)} AS DECIMAL({p},{s}))"


SQL["total_ttc"] = with_mig(
    f"SELECT legacy_ord_id, CAST(CAST({_num('subtotal_ht', 14, 2)} * (CAST(100 AS DECIMAL(3,0)) + "
    f"{_num('tva_rate', 5, 2)}) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS DOUBLE) AS total_ttc "
    "FROM mig_orders", ["orders"])
_LT = (f"CAST(CAST(quantity AS DECIMAL(10,0)) * {_num('unit_price', 12, 2)} * "
       f"((CAST(100 AS DECIMAL(3,0)) - {_num('discount_pct', 5, 2)}) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(14,2))")
SQL["line_total"] = D.with_legacy(
    f"SELECT legacy_line_id, CAST({_LT} AS DOUBLE) AS line_total, "
    f"CAST({_num('source_line_total', 14, 2)} - {_LT} AS DOUBLE) AS source_minus_generated FROM "
    f"(SELECT {_migrate_select('order_lines')}, line_total AS source_line_total FROM legacy_order_lines)", "order_lines")


def _log(t):
    spec = SPECS[t]
    names = list(dict.fromkeys([spec.target_key, *spec.required, *spec.dedup_on]))
    dup = f"row_number() OVER (PARTITION BY {', '.join(spec.dedup_on)} ORDER BY _src_key) > 1" if spec.dedup_on else "FALSE"
    miss = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in spec.required) + ")"
    rows = (f"SELECT _src_key AS legacy_id, {', '.join(names)}, {dup} AS dup, {miss} AS miss "
            f"FROM (SELECT {_migrate_select(t)}, {spec.key} AS _src_key FROM legacy_{t})")
    marked = f"SELECT *, dup OR miss <> '' AS skip FROM ({rows})"
    order = ", ".join(f"{c} NULLS LAST" for c in ["legacy_id", *names])
    return (f"SELECT 'run_sf' AS migration_run, '{t}' AS table_name, legacy_id, "
            f"CASE WHEN NOT skip THEN row_number() OVER (PARTITION BY skip ORDER BY {order}) END AS target_id, "
            f"CASE WHEN skip THEN 'skipped' ELSE 'success' END AS status, "
            f"CASE WHEN dup THEN 'duplicate on {','.join(spec.dedup_on)}' WHEN miss <> '' THEN 'missing required: ' || miss END AS error_message "
            f"FROM ({marked})")


SQL["reconcile_values"] = with_mig(
    "SELECT * FROM (WITH s AS (SELECT legacy_sup_id AS k, name AS x, CASE WHEN legacy_sup_id % 5 = 0 THEN lower(name) ELSE name END AS y FROM mig_suppliers), "
    "o AS (SELECT legacy_ord_id AS k, delivered_at AS d, channel AS c, CASE WHEN legacy_ord_id % 97 = 0 THEN NULL ELSE delivered_at END AS e, "
    "CASE WHEN legacy_ord_id % 194 = 0 THEN 'FAX' ELSE channel END AS f FROM mig_orders) "
    "SELECT 'suppliers' AS table_name, CAST(k AS VARCHAR) AS key, 'changed' AS status, 'name' AS changed FROM s WHERE x IS DISTINCT FROM y "
    "UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'missing', NULL FROM o WHERE k % 101 = 0 "
    "UNION ALL SELECT 'orders', CAST(-k AS VARCHAR), 'extra', NULL FROM o WHERE k % 101 = 0 "
    "UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'changed', concat_ws(',', CASE WHEN d IS DISTINCT FROM e THEN 'delivered_at' END, "
    "CASE WHEN c IS DISTINCT FROM f THEN 'channel' END) FROM o WHERE k % 101 <> 0 AND (d IS DISTINCT FROM e OR c IS DISTINCT FROM f))",
    ["suppliers", "orders"])
SQL["row_level_log"] = D.with_legacy(_u([_log(t) for t in MIG]), *MIG)

# ---- mapping ---------------------------------------------------------------------
from tidyload.operators import mapping as MP  # noqa: E402
from tidyload.plans import mappings as MD  # noqa: E402
from tidyload.sources.legacy import ORDER_KEYS  # noqa: E402

_MROWS = [(d["table_source"], i, m, d["migration_complexity"]) for d in MD.documents("proposed") for i, m in enumerate(d["mappings"])]
_CROWS = [(d["table_source"], i, m, d["migration_complexity"]) for d in MD.documents("committed") for i, m in enumerate(d["mappings"])]


def _pattern_sql(t, sample=None, key=True):
    cols = [c for c, _ in D.SCHEMAS[f"legacy_{t}"]]
    k = ORDER_KEYS[t]
    parts = []
    for c in cols:
        if c == k:
            continue
        first = lambda n, cond: f"bool_and(CASE WHEN pos <= {n} THEN {cond} ELSE TRUE END)" if sample else f"bool_and({cond})"
        dates = [first(20, f"regexp_matches(v, '{rx}')") for rx, _ in N.PATTERN_DATES]
        date_fmt = "CASE " + " ".join(f"WHEN {d} THEN '{lab}'" for d, (_, lab) in zip(dates, N.PATTERN_DATES)) + " END"
        phone = first(10, f"regexp_matches(v, '{N.PATTERN_PHONE}')")
        pattern = (f"CASE WHEN ({date_fmt}) IS NOT NULL THEN 'date' "
                   f"WHEN bool_and(v IN {D.in_list(N.PATTERN_BOOL)}) THEN 'boolean_encoded' "
                   f"WHEN bool_and(v IN {D.in_list(N.PATTERN_STATUS)}) OR (count(DISTINCT v) <= 8 AND count(DISTINCT v) > 1) "
                   f"THEN 'categorical' WHEN {phone} THEN 'phone' ELSE 'text' END")
        pos = f", row_number() OVER (ORDER BY {k}) AS pos" if sample else ""
        limit = f" QUALIFY pos <= {sample}" if sample else ""
        parts.append(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, {pattern} AS pattern, "
            f"CASE WHEN {pattern} = 'date' THEN {date_fmt} END AS date_format, "
            f"CAST(count(*) AS BIGINT) AS n_values, CAST(count(DISTINCT v) AS BIGINT) AS n_distinct, "
            f"CASE WHEN {pattern} = 'text' THEN {D.rhu('avg(length(v))', 1)} END AS avg_length "
            f"FROM (SELECT CAST({c} AS VARCHAR) AS v{pos} FROM legacy_{t} WHERE {c} IS NOT NULL{limit}) HAVING count(*) > 0")
    return parts


_PATTERNS = _u([p for t in MIG for p in _pattern_sql(t)])
SQL["value_pattern"] = D.with_ctes(MIG, [], _PATTERNS)
SQL["sampled_pattern"] = D.with_legacy(_u(_pattern_sql("orders", sample=50)), "orders")


def _family(x):
    clean = f"trim(regexp_replace(upper({x}), '\\(.*\\)', ''))"
    arms = " ".join("WHEN " + " OR ".join(f"contains({clean}, '{m}')" for m in members) + f" THEN '{fam}'"
                    for fam, members in MP.TYPE_FAMILIES)
    return f"(CASE {arms} ELSE 'other' END)"


_MAP_VALUES = "(VALUES " + ", ".join(
    "(" + ", ".join([D.q(t), str(i), D.q(m['source_col']), D.q(m['target_col']), D.q(m.get('source_type')),
                     D.q(m.get('target_type')), D.q(m.get('transform')), repr(float(m['confidence'])), D.q(cx)]) + ")"
    for t, i, m, cx in _MROWS) + (") mv(table_name, position, source_col, target_col, source_type, target_type, "
                                 "transform, confidence, migration_complexity)")
_sf, _tf = _family("coalesce(source_type, 'TEXT')"), _family("coalesce(target_type, 'TEXT')")
_compat = (f"(CASE WHEN {_sf} = {_tf} THEN TRUE WHEN {_sf} = 'int' AND {_tf} = 'numeric' THEN TRUE "
           f"WHEN {_sf} = 'text' AND {_tf} IN ('int','numeric','bool','date') THEN FALSE "
           f"WHEN {_sf} = 'int' AND {_tf} = 'bool' THEN TRUE ELSE FALSE END)")
_risk = (f"(CASE WHEN {_sf} = {_tf} THEN 'low' WHEN {_sf} = 'int' AND {_tf} = 'numeric' THEN 'low' "
         f"WHEN {_sf} = 'text' AND {_tf} IN ('int','numeric','bool','date') THEN 'high' "
         f"WHEN {_sf} = 'int' AND {_tf} = 'bool' THEN 'medium' ELSE 'medium' END)")
_conf1 = f"(CASE WHEN NOT {_compat} THEN least(coalesce(confidence, 0.8), 0.65) ELSE confidence END)"
_direct = "transform = 'direct'"
_ENRICH = (
    f"SELECT mv.table_name, CAST(position AS INTEGER) AS position, source_col, target_col, source_type, target_type, "
    f"{_sf} AS source_family, {_tf} AS target_family, {_compat} AS type_compatible, {_risk} AS type_risk, "
    f"p.pattern AS value_pattern, p.date_format, transform AS proposed_transform, "
    f"CASE WHEN {_direct} AND p.pattern = 'boolean_encoded' THEN 'normalize_bool' WHEN {_direct} AND p.pattern = 'date' "
    f"THEN 'normalize_date' WHEN {_direct} AND p.pattern = 'phone' THEN 'normalize_phone' ELSE transform END AS transform, "
    f"confidence AS proposed_confidence, CASE WHEN {_direct} AND p.pattern = 'boolean_encoded' THEN least({_conf1}, 0.75) "
    f"ELSE {_conf1} END AS confidence, concat_ws(' | ', CASE WHEN NOT {_compat} THEN 'type ' || {_sf} || ' to ' || {_tf} END, "
    f"CASE WHEN {_direct} AND p.pattern = 'boolean_encoded' THEN 'boolean codes seen' END, "
    f"CASE WHEN {_direct} AND p.pattern = 'date' THEN 'dates seen: ' || p.date_format END, "
    f"CASE WHEN {_direct} AND p.pattern = 'phone' THEN 'phone numbers seen' END) AS notes, migration_complexity "
    f"FROM {_MAP_VALUES} LEFT JOIN pat p ON mv.table_name = p.table_name AND mv.source_col = p.column_name")
SQL["mapping_enrich"] = D.with_ctes(MIG, [("pat", _PATTERNS)], f"SELECT * EXCLUDE (migration_complexity) FROM ({_ENRICH})")
SQL["mapping_ambiguous"] = D.with_ctes(MIG, [("pat", _PATTERNS)],
                                       f"SELECT table_name, source_col, target_col, confidence FROM ({_ENRICH}) "
                                       f"WHERE coalesce(confidence, 1.0) < 0.8")
SQL["mapping_summary"] = D.with_ctes(MIG, [("pat", _PATTERNS)], (
    "SELECT table_name, CAST(count(*) AS BIGINT) AS n_mappings, CAST(count_if(coalesce(confidence, 0) >= 0.9) AS BIGINT) AS n_high, "
    "CAST(count_if(coalesce(confidence, 0) >= 0.7 AND coalesce(confidence, 0) < 0.9) AS BIGINT) AS n_medium, "
    "CAST(count_if(coalesce(confidence, 0) < 0.7) AS BIGINT) AS n_low, "
    "CAST(count_if(coalesce(confidence, 1.0) < 0.8) AS BIGINT) AS n_ambiguous, first(migration_complexity) AS migration_complexity, "
    f"count_if(coalesce(confidence, 1.0) < 0.8) > 0 AS needs_review FROM ({_ENRICH}) GROUP BY table_name"))


def _stg_sql(t, as_written=False):
    cols = []
    for tt, _, m, _ in _MROWS:
        if tt == t:
            cast = m["transform"] not in ("direct", "normalize_phone") and m["staging"]
            e = N.STAGING_SQL["numeric" if m["transform"] == "cast_numeric" else m["staging"]].format(c=m["source_col"]) if cast else m["source_col"]
            cols.append(f"{e} AS {m['target_col']}")
    where = {"products": "WHERE (prod_price >= 0 OR prod_price IS NULL) AND (prod_stock >= 0 OR prod_stock IS NULL)",
             "order_lines": "WHERE line_qty > 0 OR line_qty IS NULL"}.get(t, "")
    if as_written:
        where = "WHERE 1=1 AND prod_price >= 0 OR prod_price IS NULL AND prod_stock >= 0 OR prod_stock IS NULL"
    return D.with_legacy(f"SELECT {', '.join(cols)} FROM legacy_{t} {where}", t)


for _t in MIG:
    SQL[f"stg_{_t}"] = _stg_sql(_t)
SQL["stg_products_as_written"] = _stg_sql("products", as_written=True)


def _mapped_sql(t):
    cols = []
    for tt, _, m, _ in _CROWS:
        if tt == t:
            tr = {"normalize_status": f"normalize_status_{t[:-1]}"}.get(m["transform"], m["transform"])
            tr = "normalize_currency" if m["target_col"] == "currency_code" else tr
            cols.append(f"{D.SQL_TRANSFORMS[tr](m['source_col'])} AS {m['target_col']}")
    return f"SELECT {', '.join(cols)} FROM legacy_{t}"


for _t in MIG:
    SQL[f"mapping_projection_{_t}"] = D.with_legacy(_mapped_sql(_t), _t)

_FILLED = {"customers": ["status"], "products": ["currency_code", "stock_qty", "is_active"], "suppliers": ["is_active"],
           "orders": ["status"], "order_lines": ["discount_pct"]}
SQL["defaults_filled"] = D.with_legacy(_u([
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls_before, CAST(0 AS BIGINT) AS nulls_after "
    f"FROM ({_mapped_sql(t)})" for t, cols in _FILLED.items() for c in cols]), *MIG)

# ---- loads / sinks / samples ---------------------------------------------------------
SQL["load_roundtrip"] = with_mig("SELECT * FROM mig_orders", ["orders"])
SQL["audit_append"] = with_mig(_u([
    f"SELECT '{r}' AS migration_run, table_name, source_count, target_count, 'success' AS status "
    f"FROM ({_u([_stats(t) for t in MIG])})" for r in ("run_a", "run_b")]))
SQL["csv_roundtrip"] = with_mig("SELECT * FROM mig_suppliers", ["suppliers"])
_NOTES = ["''", "' '", "'he said \"yes\"'", "'two' || chr(10) || 'lines'", "'a,b;c' || chr(9) || 'd'", "'\\N'", "'\\'", "'\"'"]
SQL["csv_dirty_roundtrip"] = D.with_legacy(
    "SELECT *, CASE cst_id % 9 " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(_NOTES, 1)) + " END AS note FROM legacy_customers", "customers")
SQL["mapping_reload_orders"] = SQL["mapping_projection_orders"]
SQL["quality_reload"] = D.with_ctes(_QT, _all_q + [("rr", _rr_all)], f"SELECT table_name, score, approved FROM ({D.score_sql('rr')})")
SQL["json_results"] = D.with_ctes(_QT, _all_q + [("rr", _rr_all), ("an", _an_all)], (
    f"SELECT tl.table_name, sc.score, sc.approved, CAST(coalesce(a.n, 0) AS BIGINT) AS n_anomalies, a.first_anomaly, "
    f"CAST(r.n AS BIGINT) AS n_rules, CAST(r.k AS BIGINT) AS n_severities FROM {_TABLES} LEFT JOIN ({D.score_sql('rr')}) sc "
    f"ON tl.table_name = sc.table_name LEFT JOIN (SELECT table_name, count(*) AS n, arg_min(anomaly_type, seq) AS first_anomaly FROM an "
    f"GROUP BY table_name) a ON tl.table_name = a.table_name LEFT JOIN (SELECT table_name, count(*) AS n, count(DISTINCT severity) AS k "
    f"FROM rr GROUP BY table_name) r ON tl.table_name = r.table_name"))
_NMAP = {t: sum(1 for tt, *_ in _CROWS if tt == t) for t in MIG}
SQL["json_documents"] = with_mig(
    _u([f"SELECT 'mapping' AS kind, '{t}' AS table_name, '{cx}' AS state, CAST({sum(1 for tt, *_ in _MROWS if tt == t)} AS BIGINT) AS n_entries"
        for t, cx in MD.COMPLEXITY.items()]) + f" UNION ALL SELECT 'run', table_name, status, n_drift FROM ({_STATUS})")
_HAVE = "(VALUES " + ", ".join(f"('{t}', '{c}')" for t in MIG for c, _ in D.SCHEMAS[f"legacy_{t}"] if c != "line_discount") + ") sr(table_name, column_name)"
_WANT = "(VALUES " + ", ".join(f"('{t}', '{m['source_col']}')" for t, _, m, _ in _CROWS) + ") mv(table_name, column_name)"
SQL["preflight"] = D.with_ctes(_QT, _all_q + [("rr", _rr_all)], (
    f"SELECT tl.table_name, w.n_mappings, w.missing AS missing_source_columns, sc.score, sc.approved, w.n_mappings > 0 AND w.missing = 0 AS ready "
    f"FROM {_TABLES} LEFT JOIN (SELECT mv.table_name, CAST(count(*) AS BIGINT) AS n_mappings, CAST(count_if(sr.column_name IS NULL) AS BIGINT) AS missing "
    f"FROM {_WANT} LEFT JOIN {_HAVE} ON mv.table_name = sr.table_name AND mv.column_name = sr.column_name GROUP BY mv.table_name) w "
    f"ON tl.table_name = w.table_name LEFT JOIN (SELECT * FROM ({D.score_sql('rr')}) WHERE table_name <> 'suppliers') sc ON tl.table_name = sc.table_name"))
_txt = [c for c, ty in D.SCHEMAS["legacy_customers"] if ty == "string"]
SQL["sample_values"] = D.with_legacy(_u([
    f"SELECT '{c}' AS column_name, pos AS position, v AS value FROM (SELECT CAST({c} AS VARCHAR) AS v, "
    f"row_number() OVER (ORDER BY cst_id) AS pos FROM legacy_customers WHERE {c} IS NOT NULL QUALIFY pos <= 5)"
    for c in _txt]), "customers")
SQL["first_rows"] = D.with_legacy("SELECT * FROM legacy_orders ORDER BY ord_id LIMIT 3", "orders")
SQL["load_ready_orders"] = with_mig(
    f"SELECT row_number() OVER (ORDER BY o.legacy_ord_id) AS order_id, o.legacy_ord_id, c.customer_sk, "
    f"coalesce(o.status, 'pending') AS status, o.order_date, "
    f"CAST(CAST({_num('o.subtotal_ht', 14, 2)} * (CAST(100 AS DECIMAL(3,0)) + {_num('o.tva_rate', 5, 2)}) "
    f"* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS DOUBLE) AS total_ttc FROM mig_orders o LEFT JOIN "
    f"(SELECT row_number() OVER (ORDER BY legacy_cst_id) AS customer_sk, legacy_cst_id FROM mig_customers) c "
    f"ON o.customer_id = c.legacy_cst_id", ["customers", "orders"])

_DPAIRS = [("order_date", "ord_date"), ("expected_delivery", "ord_exp_deliver"), ("delivered_at", "ord_delivered")]
SQL["drift_date_loss"] = D.with_legacy(_u([
    f"SELECT 'orders' AS table_name, '{t}' AS column_name, CAST(count_if(({D.norm_date(s)}) IS NULL) AS BIGINT) AS target_nulls, "
    f"CAST(count_if({s} IS NULL) AS BIGINT) AS source_nulls, "
    f"CAST(count_if({s} IS NOT NULL AND ({D.norm_date(s)}) IS NULL) AS BIGINT) AS lost, CAST(count(*) AS BIGINT) AS row_count "
    f"FROM legacy_orders" for t, s in _DPAIRS]), "orders")
