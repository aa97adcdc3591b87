"""DuckDB SQL for the correctness oracle: legacy views and normalisers.

Written independently of the Spark code path (plain SQL text over the parquet
views the driver registers), with the same fixed values.  Used only by
``oracle_sql()`` and the tests.
"""

from __future__ import annotations

from oracle import fixed as N

L = N


def q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(float(v)) if isinstance(v, float) else str(v)
    return "'" + str(v).replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


WS = q(N.WHITESPACE)


def pick(k: str, values) -> str:
    n = len(values)
    arms = " ".join(f"WHEN ({k}) % {n} = {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"CASE {arms} END"


def mixed_date(iso: str, sel: str) -> str:
    y, m, d = f"substr({iso}, 1, 4)", f"substr({iso}, 6, 2)", f"substr({iso}, 9, 2)"
    s = f"(({sel}) % 7)"
    return (f"CASE WHEN {s} <= 2 THEN {iso} "
            f"WHEN {s} = 3 THEN {d} || '/' || {m} || '/' || {y} "
            f"WHEN {s} = 4 THEN {m} || '-' || {d} || '-' || {y} "
            f"WHEN {s} = 5 THEN {d} || '-' || {m} || '-' || {y} "
            f"ELSE {y} || {m} || {d} END")


def phone(k: str) -> str:
    s = f"CAST(20000000 + (({k}) * 7919) % 80000000 AS VARCHAR)"
    sel = f"(({k}) % 5)"
    return (f"CASE WHEN {sel} = 0 THEN '+216 ' || substr({s},1,2) || ' ' || substr({s},3,3) || ' ' || substr({s},6,3) "
            f"WHEN {sel} = 1 THEN '00216' || {s} "
            f"WHEN {sel} = 2 THEN substr({s},1,2) || '-' || substr({s},3,3) || '-' || substr({s},6,3) "
            f"WHEN {sel} = 3 THEN {s} END")


def iso(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def days_after(base: str, k: str, span: int) -> str:
    return f"(DATE '{base}' + CAST(({k}) % {span} AS INTEGER))"


LEGACY_SQL = {
    "orders": f"""
SELECT o_orderkey AS ord_id,
  CASE WHEN o_orderkey % 97 <> 0 THEN 'ORD-' || substr({iso('o_orderdate')}, 1, 4) || '-' || CAST(o_orderkey AS VARCHAR) END AS ord_ref,
  o_custkey AS ord_cst_id,
  CASE WHEN o_orderkey % 33 <> 0 THEN {mixed_date(iso('o_orderdate'), 'o_orderkey')} END AS ord_date,
  CASE WHEN o_orderkey % 37 <> 0 THEN {mixed_date(iso('CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 + 1 AS INTEGER)'), 'o_orderkey + 1')} END AS ord_exp_deliver,
  CASE WHEN o_orderkey % 20 >= 3 THEN {mixed_date(iso('CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 + o_orderkey % 13 - 1 AS INTEGER)'), 'o_orderkey + 2')} END AS ord_delivered,
  CASE WHEN o_orderkey % 53 <> 0 THEN {pick('o_orderkey', L.ORDER_STATUS_RAW)} END AS ord_status,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN -o_totalprice ELSE o_totalprice END AS ord_total_ht,
  CAST({pick('o_orderkey', L.ORDER_TVA)} AS DOUBLE) AS ord_tva,
  {pick('o_orderkey', L.ORDER_CHANNEL)} AS ord_channel,
  CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority END AS ord_notes
FROM orders""",
    "customers": f"""
SELECT CASE WHEN c_custkey % 211 <> 0 THEN c_custkey END AS cst_id,
  CASE WHEN NOT (c_custkey % 5 < 2) THEN c_name END AS cst_fname,
  CASE WHEN NOT (c_custkey % 5 < 2) THEN c_mktsegment END AS cst_lname,
  CASE WHEN c_custkey % 5 < 2 THEN c_name || ' SARL' END AS cst_company,
  CASE WHEN c_custkey % 20 = 0 THEN NULL
       WHEN c_custkey % 33 = 1 THEN ' USER' || CAST(c_custkey - 1 AS VARCHAR) || '@X.COM '
       ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@x.com' END AS cst_email,
  {phone('c_custkey')} AS cst_phone,
  {pick('c_custkey', L.CUSTOMER_COUNTRY_RAW)} AS cst_country,
  'City-' || CAST(c_nationkey AS VARCHAR) AS cst_city,
  CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey AS VARCHAR) || ' Rue ' || CAST(c_nationkey AS VARCHAR) END AS cst_address,
  {pick('c_custkey', L.CUSTOMER_STATUS_RAW)} AS cst_status,
  {pick('c_custkey', L.CUSTOMER_SEGMENT_RAW)} AS cst_segment,
  CASE WHEN c_custkey % 31 <> 0 THEN {mixed_date(iso(days_after('2018-01-01', 'c_custkey', 2190)), 'c_custkey')} END AS cst_created_dt,
  CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS cst_notes
FROM customer""",
    "products": f"""
SELECT p_partkey AS prod_id,
  CASE WHEN p_partkey % 107 <> 0 THEN 'REF-' || CAST(CASE WHEN p_partkey % 61 = 0 THEN p_partkey - 1 ELSE p_partkey END AS VARCHAR) END AS prod_ref,
  CASE WHEN p_partkey % 103 <> 0 THEN p_name END AS prod_name,
  CASE WHEN p_partkey % 20 <> 0 THEN p_type END AS prod_category,
  CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN -p_retailprice ELSE p_retailprice END AS prod_price,
  {pick('p_partkey', L.PRODUCT_CURRENCY_RAW)} AS prod_currency,
  CASE WHEN p_partkey % 27 = 0 THEN NULL WHEN p_partkey % 25 = 0 THEN CAST(-1 AS BIGINT) ELSE p_partkey % 500 END AS prod_stock,
  {pick('p_partkey', L.PRODUCT_UNIT_RAW)} AS prod_unit,
  {pick('p_partkey', L.PRODUCT_ACTIVE_RAW)} AS prod_active,
  CASE WHEN p_partkey % 29 <> 0 THEN {mixed_date(iso(days_after('2017-01-01', 'p_partkey', 2000)), 'p_partkey')} END AS prod_created
FROM part""",
    "suppliers": f"""
SELECT s_suppkey AS sup_id,
  CASE WHEN s_suppkey % 19 <> 0 THEN s_name END AS sup_name,
  {pick('s_suppkey', L.SUPPLIER_COUNTRY_RAW)} AS sup_country,
  CASE WHEN s_suppkey % 10 <> 0 THEN 'Contact ' || CAST(s_suppkey AS VARCHAR) END AS sup_contact,
  CASE WHEN s_suppkey % 12 <> 0 THEN 'contact' || CAST(s_suppkey AS VARCHAR) || '@supplier.com' END AS sup_email,
  {phone('s_suppkey + 2')} AS sup_phone,
  {pick('s_suppkey', L.SUPPLIER_RATING_RAW)} AS sup_rating,
  {pick('s_suppkey', L.SUPPLIER_ACTIVE_RAW)} AS sup_active,
  CASE WHEN s_suppkey % 23 <> 0 THEN {mixed_date(iso(days_after('2010-01-01', 's_suppkey', 4000)), 's_suppkey')} END AS sup_since
FROM supplier""",
    "order_lines": """
SELECT l_orderkey * 10 + l_linenumber AS line_id, CASE WHEN m % 89 <> 0 THEN l_orderkey END AS line_ord_id,
  CASE WHEN m % 83 <> 0 THEN l_partkey END AS line_prod_id,
  CASE WHEN m % 50 = 0 THEN NULL WHEN m % 51 = 0 THEN 0.0 WHEN m % 53 = 0 THEN -3.0 WHEN m % 43 = 0 THEN 2.75 ELSE l_quantity END::DOUBLE AS line_qty,
  CASE WHEN m % 47 = 0 THEN NULL WHEN m % 59 = 0 THEN -(l_extendedprice / l_quantity) ELSE l_extendedprice / l_quantity END AS line_unit_price,
  CASE WHEN m % 20 = 0 THEN NULL WHEN m % 61 = 0 THEN 150.0 WHEN m % 67 = 0 THEN -5.0 ELSE l_discount * 100 END::DOUBLE AS line_discount,
  CASE WHEN m % 33 <> 0 THEN l_extendedprice END AS line_total
FROM (SELECT *, l_orderkey * 7 + l_linenumber * 13 AS m FROM lineitem)""",
}

LEGACY_VIEW_NAMES = {t: f"legacy_{t}" for t in LEGACY_SQL}


def with_legacy(body: str, *tables: str) -> str:
    """Prefix ``body`` with CTEs ``legacy_<t>`` for the given legacy tables."""
    ctes = ",\n".join(f"legacy_{t} AS ({LEGACY_SQL[t]})" for t in tables)
    return f"WITH {ctes}\n{body}"


# ---- normalisers ---------------------------------------------------------

def strip(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {WS})"


def norm_date(x: str) -> str:
    s = strip(x)
    arms = [
        (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", s),
        (r"[0-9]{2}/[0-9]{2}/[0-9]{4}", f"substr({s},7,4) || '-' || substr({s},4,2) || '-' || substr({s},1,2)"),
        (r"[0-9]{2}-[0-9]{2}-[0-9]{4}", f"substr({s},7,4) || '-' || substr({s},1,2) || '-' || substr({s},4,2)"),
        (r"[0-9]{8}", f"substr({s},1,4) || '-' || substr({s},5,2) || '-' || substr({s},7,2)"),
    ]
    body = " ".join(f"WHEN regexp_full_match({s}, '{rx}') THEN try_cast({iso_txt} AS DATE)"
                    for rx, iso_txt in arms)
    d = f"(CASE {body} END)"
    return f"(CASE WHEN year({d}) >= 1 THEN {d} END)"


def norm_status_customer(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN 'active' "
            f"WHEN lower({strip(x)}) IN {in_list(N.CUSTOMER_ACTIVE_VALUES)} THEN 'active' ELSE 'inactive' END)")


def norm_status_order(x: str) -> str:
    v = f"upper({strip(x)})"
    arms = " ".join(f"WHEN {v} IN {in_list(codes)} THEN '{st}'" for st, codes in N.ORDER_STATUS_CODES.items())
    return f"(CASE WHEN {x} IS NULL THEN 'pending' {arms} ELSE 'pending' END)"


def norm_bool(x: str) -> str:
    return f"(CASE WHEN upper({strip(x)}) IN {in_list(N.TRUE_VALUES)} THEN 1 ELSE 0 END)"


def norm_country(x: str) -> str:
    v = f"lower({strip(x)})"
    arms = " ".join(f"WHEN {v} IN {in_list(names)} THEN '{code}'" for code, names in N.COUNTRY_NAMES.items())
    return f"(CASE WHEN {x} IS NULL THEN 'TN' {arms} ELSE substr(upper(CAST({x} AS VARCHAR)), 1, 2) END)"


def norm_currency(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN 'TND' ELSE substr(upper({strip(x)}), 1, 3) END)"


def norm_phone(x: str) -> str:
    d = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9+]', '', 'g')"
    f = (f"(CASE WHEN starts_with({d}, '00216') THEN '+' || substr({d}, 3) "
         f"WHEN starts_with({d}, '216') AND length({d}) >= 11 THEN '+' || {d} "
         f"WHEN NOT starts_with({d}, '+') AND length({d}) = 8 THEN '+216' || {d} ELSE {d} END)")
    return f"(CASE WHEN length({f}) >= 8 THEN {f} END)"


def lower_strip(x: str) -> str:
    return strip(f"lower({x})")


def upper_strip(x: str) -> str:
    return strip(f"upper({x})")


def clip_lower(x: str, lo) -> str:
    return f"(CASE WHEN {x} < {lo} THEN {lo} ELSE {x} END)"


def clip(x: str, lo, hi) -> str:
    return f"(CASE WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END)"


def num(x: str) -> str:
    """NaN -> NULL for doubles (pandas treats NaN as missing)."""
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def text_num(x: str) -> str:
    """Numbers in text; anything else is null."""
    return f"(CASE WHEN regexp_full_match({x}, '\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*') THEN try_cast(trim({x}) AS DOUBLE) END)"


# target column -> SQL over the legacy view (same meaning as plans.specs.SPECS)
SQL_TRANSFORMS = {
    "direct": lambda c: c,
    "lowercase": lower_strip,
    "uppercase": upper_strip,
    "normalize_date": norm_date,
    "normalize_status_customer": norm_status_customer,
    "normalize_status_order": norm_status_order,
    "normalize_bool": norm_bool,
    "normalize_country": norm_country,
    "normalize_currency": norm_currency,
    "normalize_phone": norm_phone,
    "segment": lambda c: f"(CASE WHEN {c} IN {in_list(N.SEGMENTS)} THEN {c} END)",
    "channel": lambda c: f"(CASE WHEN {upper_strip(c)} IN {in_list(N.CHANNELS)} THEN {upper_strip(c)} END)",
    "presence_flag": lambda c: f"CAST({c} IS NOT NULL AS INTEGER)",
    "price": lambda c: clip_lower(num(c), "0.0"),
    "stock": lambda c: f"CAST({clip_lower(f'coalesce({c}, 0)', 0)} AS BIGINT)",
    "rating": lambda c: f"CAST({clip(f'coalesce({text_num(c)}, 0.0)', '0.0', '5.0')} AS DOUBLE)",
    "cast_numeric": lambda c: c if c == "prod_stock" else num(c),
    "tva": lambda c: f"CAST(coalesce({num(c)}, 19.0) AS DOUBLE)",
    "quantity": lambda c: f"CAST(trunc({clip_lower(f'coalesce({num(c)}, 1.0)', '1.0')}) AS BIGINT)",
    "discount": lambda c: f"CAST({clip(f'coalesce({num(c)}, 0.0)', '0.0', '100.0')} AS DOUBLE)",
}


# ---- schemas (Spark simple type names) of the profiled relations -----------

SCHEMAS = {
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "legacy_customers": [("cst_id", "bigint")] + [(c, "string") for c in (
        "cst_fname", "cst_lname", "cst_company", "cst_email", "cst_phone", "cst_country", "cst_city",
        "cst_address", "cst_status", "cst_segment", "cst_created_dt", "cst_notes")],
    "legacy_products": [("prod_id", "bigint"), ("prod_ref", "string"), ("prod_name", "string"),
                        ("prod_category", "string"), ("prod_price", "double"), ("prod_currency", "string"),
                        ("prod_stock", "bigint"), ("prod_unit", "string"), ("prod_active", "string"),
                        ("prod_created", "string")],
    "legacy_suppliers": [("sup_id", "bigint"), ("sup_name", "string"), ("sup_country", "string"),
                         ("sup_contact", "string"), ("sup_email", "string"), ("sup_phone", "string"),
                         ("sup_rating", "string"), ("sup_active", "string"), ("sup_since", "string")],
    "legacy_orders": [("ord_id", "bigint"), ("ord_ref", "string"), ("ord_cst_id", "bigint"),
                      ("ord_date", "string"), ("ord_exp_deliver", "string"), ("ord_delivered", "string"),
                      ("ord_status", "string"), ("ord_total_ht", "double"), ("ord_tva", "double"),
                      ("ord_channel", "string"), ("ord_notes", "string")],
    "legacy_order_lines": [("line_id", "bigint"), ("line_ord_id", "bigint"), ("line_prod_id", "bigint"),
                           ("line_qty", "double"), ("line_unit_price", "double"), ("line_discount", "double"),
                           ("line_total", "double")],
}

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
BOOL_VALUES = ["1", "0", "Y", "N", "YES", "NO", "TRUE", "FALSE", "A", "I", "ACTIVE", "INACTIVE"]


def ratio(n: str, d: str, k: int) -> str:
    sc = 10 ** k
    return f"(CASE WHEN ({d}) > 0 THEN ((2 * {sc} * ({n}) + ({d})) // (2 * ({d}))) / {float(sc)} ELSE 0.0 END)"


def rhu(x: str, k: int) -> str:
    sc = float(10 ** k)
    return f"(floor(({x}) * {sc} + 0.5) / {sc})"


def _clean(c: str, t: str) -> str:
    return f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)" if t in ("double", "float") else c


def profile_column_sql(rel: str, table_name: str, i: int, c: str, t: str) -> str:
    x = _clean(c, t)
    text = t == "string"
    numeric = t in NUMERIC_TYPES
    nn = f"count({x})"
    rows = "count(*)"
    uniq = f"count(DISTINCT {x})"
    dnull, bnull = "CAST(NULL AS DOUBLE)", "CAST(NULL AS BIGINT)"
    if numeric:
        v = f"CAST({x} AS DOUBLE)"
        mn, mx, mean, neg = (f"min({v})", f"max({v})", rhu(f"avg({v})", 2),
                             f"CAST(count_if({v} < 0) AS BIGINT)")
    else:
        mn = mx = mean = dnull
        neg = "CAST(0 AS BIGINT)"
    if text:
        avg_len = f"coalesce({rhu(f'avg(length({x}))', 1)}, 0.0)"
        cnt = [f"CAST(count_if(regexp_matches({x}, '{rx}')) AS BIGINT)" for _, rx in N.DATE_LAYOUTS]
        nfmt = " + ".join(f"CAST({cc} > 0 AS BIGINT)" for cc in cnt)
        mixed = f"({nfmt}) > 1"
        all_bool = f"(count({x}) > 0 AND bool_and(upper({x}) IN {in_list(BOOL_VALUES)}))"
        bool_enc = f"CASE WHEN {all_bool} THEN string_agg(DISTINCT upper({x}), ',' ORDER BY upper({x})) END"
        status_enc = (f"CASE WHEN NOT coalesce({all_bool}, FALSE) AND {uniq} BETWEEN 2 AND 15 "
                      f"THEN string_agg(DISTINCT {x}, ',' ORDER BY {x}) END")
        nfmt = f"({nfmt})"
    else:
        avg_len = dnull
        cnt = ["CAST(0 AS BIGINT)"] * 4
        nfmt = "CAST(0 AS BIGINT)"
        mixed = "FALSE"
        bool_enc = status_enc = "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{table_name}' AS table_name, '{c}' AS column_name, {i} AS ordinal, '{t}' AS dtype,
  {str(text).upper()} AS is_text, {str(numeric).upper()} AS is_numeric,
  CAST({rows} AS BIGINT) AS row_count, CAST({rows} - {nn} AS BIGINT) AS null_count,
  {ratio(f"{rows} - {nn}", rows, 4)} AS null_rate,
  CAST({uniq} AS BIGINT) AS unique_count,
  {ratio(uniq, rows, 4)} AS unique_rate,
  CAST({nn} - {uniq} AS BIGINT) AS dup_count,
  {mn} AS min, {mx} AS max, {mean} AS mean, {neg} AS negative_count, {avg_len} AS avg_length,
  {cnt[0]} AS date_iso, {cnt[1]} AS date_fr, {cnt[2]} AS date_us, {cnt[3]} AS date_compact,
  {nfmt} AS n_date_formats, {mixed} AS mixed_dates, {bool_enc} AS bool_encoding, {status_enc} AS status_encoding
FROM {rel}"""


def profile_sql(rel: str, table_name: str) -> str:
    parts = [profile_column_sql(rel, table_name, i, c, t) for i, (c, t) in enumerate(SCHEMAS[rel])]
    return "\nUNION ALL\n".join(parts)


# ---- quality (Q, G) over a profile relation p and a dup-rows relation dr ----

def _name_has(words) -> str:
    return "(" + " OR ".join(f"contains(lower(column_name), '{w}')" for w in words) + ")"


def _crit(critical) -> str:
    return f"column_name IN {in_list(critical)}" if critical else "FALSE"


def anomalies_sql(critical) -> str:
    crit = _crit(critical)
    o = "CAST(ordinal AS BIGINT) * 10"

    def f(cond, k, typ, sev, metric):
        return (f"SELECT table_name, {o} + {k} AS seq, '{typ}' AS anomaly_type, '{sev}' AS severity, column_name, "
                f"CAST({metric} AS DOUBLE) AS metric FROM p WHERE {cond}")
    parts = [
        f(f"{crit} AND null_count > 0", 1, "CRITICAL_NULLS", "HIGH", "null_count"),
        f(f"NOT ({crit}) AND null_rate > 0.15", 1, "HIGH_NULL_RATE", "MEDIUM", "null_rate"),
        f("mixed_dates", 2, "MIXED_DATE_FORMATS", "HIGH", "n_date_formats"),
        f("bool_encoding IS NOT NULL", 3, "BOOLEAN_ENCODING", "MEDIUM", "unique_count"),
        f("status_encoding IS NOT NULL AND unique_count > 3", 4, "STATUS_ENCODING", "HIGH", "unique_count"),
        f("negative_count > 0", 5, "NEGATIVE_VALUES", "MEDIUM", "negative_count"),
        f(f"{_name_has(['email', 'ref', 'mail'])} AND dup_count > 0", 100000, "DUPLICATE_KEY", "HIGH", "dup_count"),
        ("SELECT table_name, CAST(99999 AS BIGINT) AS seq, 'DUPLICATE_ROWS' AS anomaly_type, 'HIGH' AS severity, "
         "'ALL' AS column_name, CAST(dup_rows AS DOUBLE) AS metric FROM dr WHERE dup_rows > 0"),
    ]
    return "\nUNION ALL\n".join(parts)


def rules_sql(critical) -> str:
    crit = _crit(critical)
    o = "CAST(ordinal AS BIGINT) * 10"
    nd, ns = "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    thr = rhu("least(null_rate * 1.2, 0.3)", 3)

    def r(cond, k, suffix, typ, sev, w, threshold, min_value, valid_set, passed, observed, error=ns):
        return (f"SELECT table_name, {o} + {k} AS seq, column_name || '__{suffix}' AS rule_id, column_name, "
                f"'{typ}' AS rule_type, '{sev}' AS severity, CAST({threshold} AS DOUBLE) AS threshold, "
                f"CAST({min_value} AS DOUBLE) AS min_value, {valid_set} AS valid_set, {passed} AS passed, "
                f"CAST({observed} AS DOUBLE) AS observed, {error} AS error, {w} AS weight FROM p WHERE {cond}")
    parts = [
        r(crit, 1, "not_null", "expect_column_values_to_not_be_null", "CRITICAL", "3.0", "1.0", nd, ns,
          "null_count = 0", "null_count"),
        r(f"NOT ({crit}) AND null_rate > 0", 1, "null_rate", "expect_column_values_null_rate_below", "WARNING",
          "1.0", thr, nd, ns, f"null_count / row_count <= {thr}", "null_count / row_count"),
        r("status_encoding IS NOT NULL", 3, "valid_values", "expect_column_values_to_be_in_set", "HIGH", "2.0",
          nd, nd, "status_encoding", "TRUE", "0.0"),
        r(f"NOT is_text AND NOT ({crit})", 4, "non_negative", "expect_column_values_to_be_between", "HIGH", "2.0",
          nd, "0.0", ns, "is_numeric AND negative_count = 0", "CASE WHEN is_numeric THEN negative_count END",
          "CASE WHEN NOT is_numeric THEN 'type error: cannot compare ' || dtype || ' with 0' END"),
        r(f"unique_rate > 0.98 AND null_rate < 0.01 AND {_name_has(['id', 'ref', 'email', 'code'])}", 5,
          "unique", "expect_column_values_to_be_unique", "HIGH", "2.0", nd, nd, ns, "dup_count = 0", "dup_count"),
    ]
    return "\nUNION ALL\n".join(parts)


def dup_rows_sql(rel: str, name: str, cols) -> str:
    c = ", ".join(cols)
    return (f"SELECT '{name}' AS table_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dup_rows, "
            f"CAST(count(*) AS BIGINT) AS distinct_rows FROM (SELECT {c}, count(*) AS n FROM {rel} GROUP BY ALL)")


def score_sql(rr: str) -> str:
    tw, pw = "CAST(sum(weight) AS BIGINT)", "CAST(sum(CASE WHEN passed THEN weight ELSE 0.0 END) AS BIGINT)"
    s = f"(CASE WHEN total_weight > 0 THEN ((2 * 10000 * passed_weight + total_weight) // (2 * total_weight)) / 10000.0 ELSE 1.0 END)"
    return (f"SELECT table_name, n_rules, n_passed, total_weight, passed_weight, {s} AS score, {s} >= 0.8 AS approved "
            f"FROM (SELECT table_name, {tw} AS total_weight, {pw} AS passed_weight, CAST(count(*) AS BIGINT) AS n_rules, "
            f"CAST(count_if(passed) AS BIGINT) AS n_passed FROM {rr} GROUP BY table_name)")


def with_ctes(legacy_tables, ctes, body: str) -> str:
    """WITH legacy views + extra (name, sql) CTEs, then ``body``."""
    parts = [f"legacy_{t} AS ({LEGACY_SQL[t]})" for t in legacy_tables]
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def quality_ctes(table: str, critical):
    """CTEs p_<t>, dr_<t>, an_<t>, rr_<t> for one legacy table."""
    rel = f"legacy_{table}"
    cols = [c for c, _ in SCHEMAS[rel]]
    return [
        (f"p_{table}", profile_sql(rel, table)),
        (f"dr_{table}", dup_rows_sql(rel, table, cols)),
        (f"an_{table}", anomalies_sql(critical).replace(" FROM p ", f" FROM p_{table} ").replace(" FROM dr ", f" FROM dr_{table} ")),
        (f"rr_{table}", rules_sql(critical).replace(" FROM p ", f" FROM p_{table} ")),
    ]
