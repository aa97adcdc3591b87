"""Mapping operators that run on metadata: type families and compatibility
(D-6, D-7), unmapped columns (P-16), staging filters (P-13a)."""
from pyspark.sql import functions as F

from tidyload.operators import mapping as M

FAMILY_CASES = [("VARCHAR(255)", "text"), ("TEXT", "text"), ("INTEGER", "int"), ("BIGINT", "int"),
                ("SERIAL", "int"), ("INTERVAL", "int"), ("NUMERIC(12,2)", "numeric"), ("REAL", "numeric"),
                ("DOUBLE PRECISION", "numeric"), ("BOOLEAN", "bool"), ("DATE", "date"),
                ("TIMESTAMPTZ", "date"), ("JSONB", "other"), ("smallint", "int")]

COMPAT_CASES = [("TEXT", "VARCHAR", True, "low"), ("INTEGER", "NUMERIC", True, "low"),
                ("TEXT", "DATE", False, "high"), ("TEXT", "BOOLEAN", False, "high"),
                ("INTEGER", "BOOLEAN", True, "medium"), ("REAL", "INTEGER", False, "medium"),
                ("DATE", "TEXT", False, "medium"), ("INTEGER", "SMALLINT", True, "low")]


def test_type_family(spark):
    df = spark.createDataFrame(FAMILY_CASES, "t string, want string")
    got = df.select("want", M.type_family(F.col("t")).alias("got")).collect()
    assert all(r["got"] == r["want"] for r in got), got


def test_type_compat(spark):
    df = spark.createDataFrame(COMPAT_CASES, "s string, t string, ok boolean, risk string")
    ok, risk, _, _ = M.type_compat(F.col("s"), F.col("t"))
    got = df.select("ok", "risk", ok.alias("gok"), risk.alias("grisk")).collect()
    assert all(r["ok"] == r["gok"] and r["risk"] == r["grisk"] for r in got), got


def test_unmapped(spark):
    rows = M.mapping_rows(M.read_mapping_documents(spark))
    schemas = {"order_lines": ["line_id", "line_ord_id", "line_prod_id", "line_qty", "line_unit_price",
                               "line_discount", "line_total"]}
    out = {(r["side"], r["column_name"]) for r in M.unmapped(spark, rows, schemas).collect()}
    assert ("source", "line_total") in out
    assert ("target", "line_id") in out and ("target", "migrated_at") in out and ("target", "line_total") in out


def test_products_filter_as_written(spark):
    df = spark.createDataFrame([(1, -1.0, 5), (2, None, -1), (3, 5.0, -1), (4, None, None)],
                               "i int, prod_price double, prod_stock int")
    intended = {r["i"] for r in df.where(M.staging_filter("products")).collect()}
    written = {r["i"] for r in df.where(M.staging_filter("products", as_written=True)).collect()}
    assert intended == {4}
    # as generated: price >= 0 OR (price IS NULL AND stock >= 0) OR stock IS NULL
    assert written == {3, 4}


def test_packaged_mapping_rows(spark):
    committed = M.mapping_rows(M.read_mapping_documents(spark))
    assert {r[0]: r[1] for r in committed.groupBy("table_name").count().collect()} == {
        "customers": 13, "products": 10, "orders": 11, "order_lines": 6, "suppliers": 9}
    assert {"lowercase", "uppercase"} <= {r[0] for r in committed.select("transform").distinct().collect()}
    assert M.mapping_rows(M.read_mapping_documents(spark, form="proposed")).count() == 44


def test_mapping_documents_from_shared_storage(spark, tmp_path):
    docs = M.read_mapping_documents(spark)
    docs.write.json(str(tmp_path / "docs"))
    assert M.mapping_rows(M.read_mapping_documents(spark, str(tmp_path / "docs"))).count() == 49


def test_projection_follows_the_rows(spark):
    from tidyload.plans.mappings import RELABELLED
    rows = M.mapping_rows(M.read_mapping_documents(spark))
    df = spark.createDataFrame([(1, "r", "n", "c", 2.0, " eur", 3, "u", "Y", "2024-01-02")],
                               "prod_id long, prod_ref string, prod_name string, prod_category string, prod_price double, prod_currency string, "
                               "prod_stock long, prod_unit string, prod_active string, prod_created string")
    assert M.apply_mapping(df, rows, "products").first().currency_code == " E"  # the row's label, taken at its word
    assert M.apply_mapping(df, rows, "products", relabelled=RELABELLED["products"]).first().currency_code == "EUR"


def test_patterns_look_at_all_values(spark):
    df = spark.createDataFrame([(i, "2024-01-%02d" % (1 + i % 28) if i < 60 else "soon") for i in range(61)], "k long, d string")
    assert M.value_patterns(df, "t", ["d"]).first().pattern == "text"
    assert M.sampled_patterns(df, "t", "k").first().pattern == "date"
