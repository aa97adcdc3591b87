"""Table specifications as data and the transform registry.

A spec lists, per target column, the source column and a named transform from
``TRANSFORMS``; plus the dedup key and the required columns. The same registry
serves the mapping-driven projection (P-14), so a mapping row's ``transform``
resolves to the same Column builder as the hard-coded presets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyload.functions import normalize as N


def _num(c, t):
    return N.to_number(c, t)


# name -> builder(col: Column, source_type: str) -> Column
TRANSFORMS = {
    "direct": lambda c, t: c,
    "lowercase": lambda c, t: N.lower_strip(c),
    "uppercase": lambda c, t: N.upper_strip(c),
    # staged: strip -> shape -> (y, m, d) -> date, one projection per step
    "normalize_date": [lambda c, t: N.strip(c), lambda c, t: N.date_shape(c),
                       lambda c, t: N.date_parts(c), lambda c, t: N.date_from_parts(c)],
    "normalize_status_customer": lambda c, t: N.normalize_status_customer(c),
    "normalize_status_order": lambda c, t: N.normalize_status_order(c),
    "normalize_bool": lambda c, t: N.normalize_bool(c),
    "normalize_country": lambda c, t: N.normalize_country(c),
    "normalize_currency": lambda c, t: N.normalize_currency(c),
    "normalize_phone": lambda c, t: N.normalize_phone(c),
    "cast_numeric": lambda c, t: _num(c, t),
    "segment": lambda c, t: N.domain_restrict(c, N.SEGMENTS),
    "channel": lambda c, t: N.domain_restrict(N.upper_strip(c), N.CHANNELS),
    "presence_flag": lambda c, t: c.isNotNull().cast("int"),
    # numeric recipes of the five transforms
    "price": lambda c, t: N.clip_lower(_num(c, t), 0),
    "stock": lambda c, t: N.to_int(N.clip_lower(N.fill(_num(c, t), 0), 0)),
    "rating": lambda c, t: N.clip(N.fill(_num(c, t), 0), 0, 5).cast("double"),
    "tva": lambda c, t: N.fill(_num(c, t), 19.0).cast("double"),
    "quantity": lambda c, t: N.to_int(N.clip_lower(N.fill(_num(c, t), 1), 1)),
    "discount": lambda c, t: N.clip(N.fill(_num(c, t), 0), 0, 100).cast("double"),
}


@dataclass(frozen=True)
class TableSpec:
    source: str
    target: str
    key: str                                   # source row-order key
    columns: list                              # (target_col, source_col, transform)
    required: list                             # dropna subset (target names)
    dedup_on: list = field(default_factory=list)

    @property
    def target_key(self) -> str:
        return self.columns[0][0]


SPECS = {
    "customers": TableSpec(
        "customers", "customers", "cst_id",
        [
            ("legacy_cst_id", "cst_id", "direct"),
            ("first_name", "cst_fname", "direct"),
            ("last_name", "cst_lname", "direct"),
            ("company_name", "cst_company", "direct"),
            ("email", "cst_email", "lowercase"),
            ("phone", "cst_phone", "normalize_phone"),
            ("country_code", "cst_country", "normalize_country"),
            ("city", "cst_city", "direct"),
            ("address", "cst_address", "direct"),
            ("segment", "cst_segment", "segment"),
            ("status", "cst_status", "normalize_status_customer"),
            ("is_company", "cst_company", "presence_flag"),
            ("created_at", "cst_created_dt", "normalize_date"),
            ("notes", "cst_notes", "direct"),
        ],
        required=["legacy_cst_id"],
        dedup_on=["email"],
    ),
    "products": TableSpec(
        "products", "products", "prod_id",
        [
            ("legacy_prod_id", "prod_id", "direct"),
            ("reference", "prod_ref", "direct"),
            ("name", "prod_name", "direct"),
            ("category", "prod_category", "direct"),
            ("unit_price", "prod_price", "price"),
            ("currency_code", "prod_currency", "normalize_currency"),
            ("stock_qty", "prod_stock", "stock"),
            ("unit", "prod_unit", "direct"),
            ("is_active", "prod_active", "normalize_bool"),
            ("created_at", "prod_created", "normalize_date"),
        ],
        required=["legacy_prod_id", "reference", "name"],
    ),
    "suppliers": TableSpec(
        "suppliers", "suppliers", "sup_id",
        [
            ("legacy_sup_id", "sup_id", "direct"),
            ("name", "sup_name", "direct"),
            ("country_code", "sup_country", "normalize_country"),
            ("contact_name", "sup_contact", "direct"),
            ("email", "sup_email", "direct"),
            ("phone", "sup_phone", "normalize_phone"),
            ("rating", "sup_rating", "rating"),
            ("is_active", "sup_active", "normalize_bool"),
            ("partner_since", "sup_since", "normalize_date"),
        ],
        required=["legacy_sup_id", "name"],
    ),
    "orders": TableSpec(
        "orders", "orders", "ord_id",
        [
            ("legacy_ord_id", "ord_id", "direct"),
            ("order_reference", "ord_ref", "direct"),
            ("customer_id", "ord_cst_id", "direct"),
            ("order_date", "ord_date", "normalize_date"),
            ("expected_delivery", "ord_exp_deliver", "normalize_date"),
            ("delivered_at", "ord_delivered", "normalize_date"),
            ("status", "ord_status", "normalize_status_order"),
            ("subtotal_ht", "ord_total_ht", "price"),
            ("tva_rate", "ord_tva", "tva"),
            ("channel", "ord_channel", "channel"),
            ("notes", "ord_notes", "direct"),
        ],
        required=["legacy_ord_id", "order_reference", "order_date"],
    ),
    "order_lines": TableSpec(
        "order_lines", "order_lines", "line_id",
        [
            ("legacy_line_id", "line_id", "direct"),
            ("order_id", "line_ord_id", "direct"),
            ("product_id", "line_prod_id", "direct"),
            ("quantity", "line_qty", "quantity"),
            ("unit_price", "line_unit_price", "price"),
            ("discount_pct", "line_discount", "discount"),
        ],
        required=["legacy_line_id", "order_id", "product_id", "unit_price"],
    ),
}

# Quality profile: columns whose nulls block the load (fixed values).
CRITICAL_COLUMNS = {
    "customers": ["cst_id", "cst_email"],
    "products": ["prod_id", "prod_ref", "prod_name"],
    "orders": ["ord_id", "ord_cst_id", "ord_date", "ord_status"],
    "order_lines": ["line_id", "line_ord_id", "line_prod_id", "line_unit_price"],
    "suppliers": ["sup_id", "sup_name"],
}

# Drift check: the status domain each migrated table must stay inside.
VALID_STATUSES = {
    "customers": N.CUSTOMER_STATUSES,
    "orders": N.ORDER_STATUSES,
}

QUALITY_THRESHOLD = 0.80
SEVERITY_WEIGHTS = {"CRITICAL": 3.0, "HIGH": 2.0, "WARNING": 1.0}


def stages(transform: str) -> list:
    """The transform as a list of steps (most transforms have one)."""
    try:
        fn = TRANSFORMS[transform]
    except KeyError as e:
        raise ValueError(f"unknown transform {transform!r}") from e
    return fn if isinstance(fn, list) else [fn]


def build_column(transform: str, col: Column, source_type: str) -> Column:
    """The whole transform as one expression (for ad hoc use)."""
    out = col
    for step in stages(transform):
        out = step(out, source_type)
    return out
