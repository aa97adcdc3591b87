"""The packaged mapping documents, as fixed values.

Two forms, as a mapping goes through a migration: ``PROPOSED`` has the types of
both sides and, where the staging models convert a column, the name of the staging
conversion; ``COMMITTED`` is the reviewed form that migrations read. Each line is
one column: source, target, [source type, target type,] transform, confidence[,
staging conversion].
"""

from __future__ import annotations

COMPLEXITY = {"customers": "high", "products": "medium", "orders": "high", "order_lines": "medium", "suppliers": "low"}

PROPOSED = {
    "customers": """
cst_id legacy_cst_id INTEGER INTEGER direct 0.99
cst_fname first_name TEXT VARCHAR direct 0.97
cst_lname last_name TEXT VARCHAR direct 0.97
cst_email email TEXT VARCHAR direct 0.95
cst_status status TEXT VARCHAR normalize_status 0.72 status_customer
cst_country country_code TEXT CHAR normalize_country 0.68
cst_phone phone TEXT VARCHAR normalize_phone 0.61
cst_created_dt created_at TEXT DATE normalize_date 0.78
""",
    "products": """
prod_id legacy_prod_id INTEGER INTEGER direct 0.99
prod_ref reference TEXT VARCHAR direct 0.97
prod_name name TEXT VARCHAR direct 0.97
prod_category category TEXT VARCHAR direct 0.93
prod_price unit_price REAL NUMERIC cast_numeric 0.88 numeric
prod_currency currency_code TEXT CHAR normalize_country 0.71 upper_trim
prod_stock stock_qty INTEGER INTEGER cast_numeric 0.75 numeric
prod_unit unit TEXT VARCHAR direct 0.90
prod_active is_active TEXT BOOLEAN normalize_bool 0.73 bool_product
prod_created created_at TEXT DATE normalize_date 0.69
""",
    "orders": """
ord_id legacy_ord_id INTEGER INTEGER direct 0.99
ord_ref order_reference TEXT VARCHAR direct 0.97
ord_cst_id customer_id INTEGER INTEGER direct 0.95
ord_date order_date TEXT DATE normalize_date 0.70
ord_exp_deliver expected_delivery TEXT DATE normalize_date 0.70
ord_delivered delivered_at TEXT DATE normalize_date 0.68
ord_status status TEXT VARCHAR normalize_status 0.65 status_order
ord_total_ht subtotal_ht REAL NUMERIC cast_numeric 0.88
ord_tva tva_rate REAL NUMERIC direct 0.90
ord_channel channel TEXT VARCHAR direct 0.93
ord_notes notes TEXT TEXT direct 0.97
""",
    "order_lines": """
line_id legacy_line_id INTEGER INTEGER direct 0.99
line_ord_id order_id INTEGER INTEGER direct 0.95
line_prod_id product_id INTEGER INTEGER direct 0.95
line_qty quantity INTEGER INTEGER cast_numeric 0.78 numeric
line_unit_price unit_price REAL NUMERIC cast_numeric 0.92
line_discount discount_pct REAL NUMERIC cast_numeric 0.85 numeric
""",
    "suppliers": """
sup_id legacy_sup_id INTEGER INTEGER direct 0.99
sup_name name TEXT VARCHAR direct 0.99
sup_country country_code TEXT CHAR normalize_country 0.88 upper_trim
sup_contact contact_name TEXT VARCHAR direct 0.97
sup_email email TEXT VARCHAR direct 0.95
sup_phone phone TEXT VARCHAR normalize_phone 0.77
sup_rating rating INTEGER SMALLINT direct 0.95
sup_active is_active TEXT BOOLEAN normalize_bool 0.80 bool_supplier
sup_since partner_since TEXT DATE normalize_date 0.75
""",
}

COMMITTED = {
    "customers": """
cst_id legacy_cst_id direct 0.99
cst_fname first_name direct 0.97
cst_lname last_name direct 0.97
cst_company company_name direct 0.95
cst_email email lowercase 0.95
cst_phone phone normalize_phone 0.61
cst_country country_code normalize_country 0.68
cst_city city direct 0.95
cst_address address direct 0.90
cst_status status normalize_status 0.72
cst_segment segment direct 0.90
cst_created_dt created_at normalize_date 0.65
cst_notes notes direct 0.97
""",
    "products": """
prod_id legacy_prod_id direct 0.99
prod_ref reference direct 0.97
prod_name name direct 0.97
prod_category category direct 0.93
prod_price unit_price cast_numeric 0.88
prod_currency currency_code normalize_country 0.71
prod_stock stock_qty cast_numeric 0.75
prod_unit unit direct 0.90
prod_active is_active normalize_bool 0.73
prod_created created_at normalize_date 0.69
""",
    "orders": """
ord_id legacy_ord_id direct 0.99
ord_ref order_reference direct 0.97
ord_cst_id customer_id direct 0.95
ord_date order_date normalize_date 0.70
ord_exp_deliver expected_delivery normalize_date 0.70
ord_delivered delivered_at normalize_date 0.68
ord_status status normalize_status 0.65
ord_total_ht subtotal_ht cast_numeric 0.88
ord_tva tva_rate direct 0.90
ord_channel channel uppercase 0.93
ord_notes notes direct 0.97
""",
    "order_lines": """
line_id legacy_line_id direct 0.99
line_ord_id order_id direct 0.95
line_prod_id product_id direct 0.95
line_qty quantity cast_numeric 0.78
line_unit_price unit_price cast_numeric 0.92
line_discount discount_pct cast_numeric 0.85
""",
    "suppliers": """
sup_id legacy_sup_id direct 0.99
sup_name name direct 0.99
sup_country country_code normalize_country 0.88
sup_contact contact_name direct 0.97
sup_email email direct 0.95
sup_phone phone normalize_phone 0.77
sup_rating rating direct 0.95
sup_active is_active normalize_bool 0.80
sup_since partner_since normalize_date 0.75
""",
}

# Committed labels that are wrong for their column, and the transform that is meant:
# a currency is labelled with the country normaliser.
RELABELLED = {"products": {"currency_code": "normalize_currency"}}


def documents(form: str) -> list[dict]:
    """The packaged documents of a form ("proposed" or "committed") as plain data."""
    out = []
    for table, text in {"proposed": PROPOSED, "committed": COMMITTED}[form].items():
        rows = []
        for line in text.split("\n"):
            if not line:
                continue
            words = line.split()
            source, target = words[:2]
            types, rest = (words[2:4], words[4:]) if form == "proposed" else ([None, None], words[2:])
            rows.append({"source_col": source, "target_col": target, "source_type": types[0], "target_type": types[1],
                         "transform": rest[0], "confidence": float(rest[1]), "notes": "",
                         "staging": rest[2] if len(rest) > 2 else None})
        out.append({"table_source": table, "table_target": table, "migration_complexity": COMPLEXITY[table], "mappings": rows})
    return out
