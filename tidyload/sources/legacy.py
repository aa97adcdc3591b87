"""Legacy-shaped views over the star-schema test tables (FIXTURES.md §4).

The given tables are clean; each view derives the legacy ERP table's dirty
columns with deterministic expressions of the row key ``k`` (``%``, CASE,
concat, substring only), so the same recipe can be written for DuckDB and the
work grows with the underlying table. All views are narrow projections over a
single parquet scan: no shuffle, filters and column pruning reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyload.sources.tables import read_table

# Fixed recipe values (FIXTURES.md §4 and the legacy generator's value sets).
ORDER_STATUS_RAW = [
    "P", "PEND", "pending", "0", "C", "CONF", "confirmed", "1", "S", "SHIP",
    "shipped", "2", "D", "DELIV", "delivered", "3", "X", "CANC", "cancelled", "9",
]
ORDER_TVA = [19.0, 7.0, 0.0, None]
ORDER_CHANNEL = ["WEB", "tel", " Store ", "API", "FAX", None]
CUSTOMER_STATUS_RAW = ["1", "0", "A", "I", "active", "inactive", None, " Y "]
CUSTOMER_COUNTRY_RAW = [
    "TN", "Tunisia", "Tunisie", "FR", "France", "DZ", "MA", "DE", "US", " maroc ", "Belgique", None,
]
CUSTOMER_SEGMENT_RAW = ["B2B", "B2C", "VIP", None, "b2b", "B2B"]
PRODUCT_CURRENCY_RAW = ["TND", "EUR", "USD", "tnd", " eur ", None]
PRODUCT_UNIT_RAW = ["pièce", "pcs", "unit", "box", "kg", None]
PRODUCT_ACTIVE_RAW = ["Y", "N", "1", "0", "yes", "no"]
SUPPLIER_COUNTRY_RAW = ["TN", "CN", "DE", "fr ", "IT", "Espagne", "US", "TR"]
SUPPLIER_RATING_RAW = ["1", "2", "3", "4", "5", None, "9", "-1", "n/a", " 4.5 "]
SUPPLIER_ACTIVE_RAW = ["Y", "N", "1", "0"]

LEGACY_TABLES = ["customers", "products", "suppliers", "orders", "order_lines"]


def pick(k: Column, values: list) -> Column:
    """``values[k % len(values)]``: a look into one literal array (null for a null or
    negative ``k``), so that views of many such columns stay small generated methods."""
    return F.get(F.array(*[F.lit(v) for v in values]), (k % F.lit(len(values))).cast("int"))


def iso_text(d: Column) -> Column:
    """ISO text of a date (the DATE -> STRING cast, no formatter object)."""
    return d.cast("date").cast("string")


def mixed_date(iso: Column, sel: Column) -> Column:
    """Legacy date text in one of five layouts chosen by ``sel % 7`` (the last one for a null ``sel``)."""
    y, m, d = F.substring(iso, 1, 4), F.substring(iso, 6, 2), F.substring(iso, 9, 2)
    texts = [iso, F.concat(d, F.lit("/"), m, F.lit("/"), y), F.concat(m, F.lit("-"), d, F.lit("-"), y),
             F.concat(d, F.lit("-"), m, F.lit("-"), y), F.concat(y, m, d)]
    return F.get(F.array(*texts), (F.greatest(F.coalesce(sel % F.lit(7), F.lit(6)), F.lit(2)) - 2).cast("int"))


def phone_text(k: Column) -> Column:
    """Legacy phone in four layouts plus null, chosen by ``k % 5``."""
    s = (F.lit(20000000) + (k * F.lit(7919)) % F.lit(80000000)).cast("string")
    sel = k % F.lit(5)
    return (
        F.when(sel == 0, F.concat(F.lit("+216 "), F.substring(s, 1, 2), F.lit(" "),
                                  F.substring(s, 3, 3), F.lit(" "), F.substring(s, 6, 3)))
        .when(sel == 1, F.concat(F.lit("00216"), s))
        .when(sel == 2, F.concat(F.substring(s, 1, 2), F.lit("-"), F.substring(s, 3, 3),
                                 F.lit("-"), F.substring(s, 6, 3)))
        .when(sel == 3, s)
    )


def _days_after(base: str, k: Column, span: int) -> Column:
    return F.date_add(F.lit(base).cast("date"), (k % F.lit(span)).cast("int"))


def legacy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    k = F.col("o_orderkey")
    day = F.to_date(F.col("o_orderdate"))
    o = o.withColumns({"iso": iso_text(day), "exp": iso_text(F.date_add(day, (k % 14 + 1).cast("int"))),
                       "dlv": iso_text(F.date_add(day, (k % 14 + k % 13 - 1).cast("int")))})
    iso, exp, dlv = F.col("iso"), F.col("exp"), F.col("dlv")
    return o.select(
        k.alias("ord_id"),
        F.when(k % 97 != 0, F.concat(F.lit("ORD-"), F.substring(iso, 1, 4), F.lit("-"),
                                     k.cast("string"))).alias("ord_ref"),
        F.col("o_custkey").alias("ord_cst_id"),
        F.when(k % 33 != 0, mixed_date(iso, k)).alias("ord_date"),
        F.when(k % 37 != 0, mixed_date(exp, k + 1)).alias("ord_exp_deliver"),
        F.when(k % 20 >= 3, mixed_date(dlv, k + 2)).alias("ord_delivered"),
        F.when(k % 53 != 0, pick(k, ORDER_STATUS_RAW)).alias("ord_status"),
        F.when(k % 101 == 0, F.lit(None).cast("double"))
        .when(k % 89 == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice")).alias("ord_total_ht"),
        pick(k, ORDER_TVA).cast("double").alias("ord_tva"),
        pick(k, ORDER_CHANNEL).alias("ord_channel"),
        F.when(k % 10 == 0, F.col("o_orderpriority")).alias("ord_notes"),
    )


def legacy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    k = F.col("c_custkey")
    company = k % 5 < 2
    c = c.withColumn("created", iso_text(_days_after("2018-01-01", k, 2190)))
    created = F.col("created")
    return c.select(
        F.when(k % 211 != 0, k).alias("cst_id"),
        F.when(~company, F.col("c_name")).alias("cst_fname"),
        F.when(~company, F.col("c_mktsegment")).alias("cst_lname"),
        F.when(company, F.concat(F.col("c_name"), F.lit(" SARL"))).alias("cst_company"),
        F.when(k % 20 == 0, F.lit(None).cast("string"))
        .when(k % 33 == 1, F.concat(F.lit(" USER"), (k - 1).cast("string"), F.lit("@X.COM ")))
        .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@x.com"))).alias("cst_email"),
        phone_text(k).alias("cst_phone"),
        pick(k, CUSTOMER_COUNTRY_RAW).alias("cst_country"),
        F.concat(F.lit("City-"), F.col("c_nationkey").cast("string")).alias("cst_city"),
        F.when(k % 10 != 0, F.concat(k.cast("string"), F.lit(" Rue "),
                                     F.col("c_nationkey").cast("string"))).alias("cst_address"),
        pick(k, CUSTOMER_STATUS_RAW).alias("cst_status"),
        pick(k, CUSTOMER_SEGMENT_RAW).alias("cst_segment"),
        F.when(k % 31 != 0, mixed_date(created, k)).alias("cst_created_dt"),
        F.when(k % 5 == 0, F.col("c_mktsegment")).alias("cst_notes"),
    )


def legacy_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])
    k = F.col("p_partkey")
    p = p.withColumn("created", iso_text(_days_after("2017-01-01", k, 2000)))
    created = F.col("created")
    return p.select(
        k.alias("prod_id"),
        F.when(k % 107 != 0, F.concat(F.lit("REF-"), F.when(k % 61 == 0, k - 1).otherwise(k).cast("string"))).alias("prod_ref"),
        F.when(k % 103 != 0, F.col("p_name")).alias("prod_name"),
        F.when(k % 20 != 0, F.col("p_type")).alias("prod_category"),
        F.when(k % 50 == 0, F.lit(None).cast("double"))
        .when(k % 41 == 0, -F.col("p_retailprice"))
        .otherwise(F.col("p_retailprice")).alias("prod_price"),
        pick(k, PRODUCT_CURRENCY_RAW).alias("prod_currency"),
        F.when(k % 27 == 0, F.lit(None).cast("long")).when(k % 25 == 0, F.lit(-1).cast("long"))
        .otherwise(k % 500).alias("prod_stock"),
        pick(k, PRODUCT_UNIT_RAW).alias("prod_unit"),
        pick(k, PRODUCT_ACTIVE_RAW).alias("prod_active"),
        F.when(k % 29 != 0, mixed_date(created, k)).alias("prod_created"),
    )


def legacy_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    k = F.col("s_suppkey")
    s = s.withColumn("since", iso_text(_days_after("2010-01-01", k, 4000)))
    since = F.col("since")
    return s.select(
        k.alias("sup_id"),
        F.when(k % 19 != 0, F.col("s_name")).alias("sup_name"),
        pick(k, SUPPLIER_COUNTRY_RAW).alias("sup_country"),
        F.when(k % 10 != 0, F.concat(F.lit("Contact "), k.cast("string"))).alias("sup_contact"),
        F.when(k % 12 != 0, F.concat(F.lit("contact"), k.cast("string"),
                                     F.lit("@supplier.com"))).alias("sup_email"),
        phone_text(k + 2).alias("sup_phone"),
        pick(k, SUPPLIER_RATING_RAW).alias("sup_rating"),
        pick(k, SUPPLIER_ACTIVE_RAW).alias("sup_active"),
        F.when(k % 23 != 0, mixed_date(since, k)).alias("sup_since"),
    )


def legacy_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"])
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    m = F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13  # takes every remainder, unlike k
    price = F.col("l_extendedprice") / F.col("l_quantity")
    none = F.lit(None).cast("double")
    return li.select(
        k.alias("line_id"),
        F.when(m % 89 != 0, F.col("l_orderkey")).alias("line_ord_id"),
        F.when(m % 83 != 0, F.col("l_partkey")).alias("line_prod_id"),
        F.when(m % 50 == 0, none).when(m % 51 == 0, F.lit(0.0)).when(m % 53 == 0, F.lit(-3.0)).when(m % 43 == 0, F.lit(2.75))
        .otherwise(F.col("l_quantity")).alias("line_qty"),
        F.when(m % 47 == 0, none).when(m % 59 == 0, -price).otherwise(price).alias("line_unit_price"),
        F.when(m % 20 == 0, none).when(m % 61 == 0, F.lit(150.0)).when(m % 67 == 0, F.lit(-5.0))
        .otherwise(F.col("l_discount") * 100).alias("line_discount"),
        F.when(m % 33 != 0, F.col("l_extendedprice")).alias("line_total"),
    )


BUILDERS = {
    "customers": legacy_customers,
    "products": legacy_products,
    "suppliers": legacy_suppliers,
    "orders": legacy_orders,
    "order_lines": legacy_order_lines,
}

# Row-order key of each legacy table (pandas keeps source order; Spark needs a key).
ORDER_KEYS = {
    "customers": "cst_id",
    "products": "prod_id",
    "suppliers": "sup_id",
    "orders": "ord_id",
    "order_lines": "line_id",
}


def legacy_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return BUILDERS[table](spark, sf_dir)
