"""Mapping documents and what is done with them: the document source (S-6),
type families and compatibility (D-6, D-7), the value-pattern classifier
(D-5), mapping enrichment (D-8), review verdict (D-9), summary (D-10), the
ambiguous filter (P-10), unmapped columns (P-16) and the mapping-driven
projection (P-11 .. P-14).

Mapping rows are metadata (tens of rows per table): the packaged documents are
plain data on the driver, others are read from shared storage; they are joined
with per-column facts computed from the data.  Only ``apply_mapping`` brings them
to the driver, to build a projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyload.functions import normalize as N
from tidyload.functions.numeric import round_half_up
from tidyload.operators import profile as P
from tidyload.plans import mappings as packaged
from tidyload.sources.documents import read_documents
from tidyload.sources.tables import column_samples

MAPPING_ROW = T.StructType([
    T.StructField("source_col", T.StringType()), T.StructField("target_col", T.StringType()),
    T.StructField("source_type", T.StringType()), T.StructField("target_type", T.StringType()),
    T.StructField("transform", T.StringType()), T.StructField("confidence", T.DoubleType()),
    T.StructField("notes", T.StringType()), T.StructField("staging", T.StringType()),
])
MAPPING_DOC = T.StructType([
    T.StructField("table_source", T.StringType()), T.StructField("table_target", T.StringType()),
    T.StructField("migration_complexity", T.StringType()),
    T.StructField("mappings", T.ArrayType(MAPPING_ROW)),
])
# what a stored document may have: result documents name their table ``table``
STORED_DOC = T.StructType([T.StructField("table", T.StringType()), *MAPPING_DOC.fields])

# Type-family vocabularies (substring tests, in this order).
TYPE_FAMILIES = [
    ("text", ["TEXT", "VARCHAR", "CHAR", "STRING", "CLOB", "NVARCHAR"]),
    ("int", ["INTEGER", "INT", "BIGINT", "SMALLINT", "SERIAL", "TINYINT"]),
    ("numeric", ["NUMERIC", "DECIMAL", "FLOAT", "REAL", "DOUBLE", "NUMBER"]),
    ("bool", ["BOOLEAN", "BOOL", "BIT"]),
    ("date", ["DATE", "DATETIME", "TIMESTAMP", "TIMESTAMPTZ"]),
]
# Fixed values of the value-pattern classifier.
PATTERN_DATES = [
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "ISO date (YYYY-MM-DD)"),
    (r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "FR date (DD/MM/YYYY)"),
    (r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "date (DD-MM-YYYY)"),
    (r"^[0-9]{8}$", "compact date (YYYYMMDD)"),
]
PATTERN_BOOL = ["1", "0", "Y", "N", "yes", "no", "true", "false", "A", "I", "active", "inactive"]
PATTERN_STATUS = ["P", "C", "S", "D", "X", "PEND", "CONF", "SHIP", "DELIV", "CANC",
                  "pending", "confirmed", "shipped", "delivered", "cancelled"]
PATTERN_PHONE = r"^[+0-9\s\-()]{7,20}$"
SAMPLE_SIZE, DATE_PROBE, PHONE_PROBE, CATEGORICAL_MAX = 50, 20, 10, 8
AMBIGUOUS_BELOW = 0.80
INCOMPATIBLE_CAP, BOOL_CAP, DEFAULT_CONFIDENCE = 0.65, 0.75, 0.8

# Target columns per table (target DDL), for unmapped-column checks.
TARGET_COLUMNS = {
    "customers": ["customer_id", "legacy_cst_id", "first_name", "last_name", "company_name", "email", "phone",
                  "country_code", "city", "address", "segment", "status", "is_company", "created_at",
                  "migrated_at", "notes"],
    "products": ["product_id", "legacy_prod_id", "reference", "name", "category", "unit_price", "currency_code",
                 "stock_qty", "unit", "is_active", "created_at", "migrated_at"],
    "suppliers": ["supplier_id", "legacy_sup_id", "name", "country_code", "contact_name", "email", "phone",
                  "rating", "is_active", "partner_since", "migrated_at"],
    "orders": ["order_id", "legacy_ord_id", "order_reference", "customer_id", "order_date", "expected_delivery",
               "delivered_at", "status", "subtotal_ht", "tva_rate", "total_ttc", "channel", "notes", "migrated_at"],
    "order_lines": ["line_id", "legacy_line_id", "order_id", "product_id", "quantity", "unit_price",
                    "discount_pct", "line_total", "migrated_at"],
}


def read_mapping_documents(spark: SparkSession, path: str | None = None, form: str = "committed") -> DataFrame:
    """S-6: mapping documents with a fixed schema: the packaged ones of a form, or the
    JSON documents under a shared ``path`` (any layout; what ``documents`` writes too).
    A corrupt document, or one that is no mapping, fails with its file's name."""
    if path is not None:
        found = read_documents(spark, path, STORED_DOC, ["table_source|table", "mappings"])
        broken = F.exists("mappings", lambda m: m.isNull() | m["source_col"].isNull() | m["target_col"].isNull())
        rows = F.when(broken, F.raise_error(F.concat(F.lit("mapping without columns: "), "file"))).otherwise(F.col("mappings"))
        return found.select(F.coalesce("table_source", "table").alias("table_source"), "table_target", "migration_complexity",
                            rows.alias("mappings"))
    return spark.createDataFrame(packaged.documents(form), MAPPING_DOC)


def mapping_rows(docs: DataFrame) -> DataFrame:
    """Explode documents to one row per column mapping, keeping the position."""
    return docs.select(
        F.col("table_source").alias("table_name"), "table_target", "migration_complexity",
        F.posexplode("mappings").alias("position", "m"),
    ).select("table_name", "table_target", "migration_complexity", "position", "m.*")


def type_family(t: Column) -> Column:
    """D-6: strip '(...)', upper, then the first family whose member is a substring."""
    clean = F.trim(F.regexp_replace(F.upper(t), r"\(.*\)", ""))
    out = None
    for fam, members in TYPE_FAMILIES:
        cond = reduce(lambda a, b: a | b, [clean.contains(m) for m in members])
        out = (F.when if out is None else out.when)(cond, F.lit(fam))
    return out.otherwise(F.lit("other"))


def type_compat(src: Column, tgt: Column, families: bool = False):
    """D-7: (compatible, risk) of a source -> target SQL type pair; with
    ``families`` the inputs are already type families (D-6 outputs)."""
    s, t = (src, tgt) if families else (type_family(src), type_family(tgt))
    compatible = (F.when(s == t, True).when((s == "int") & (t == "numeric"), True)
                  .when((s == "text") & t.isin("int", "numeric", "bool", "date"), False)
                  .when((s == "int") & (t == "bool"), True).otherwise(False))
    risk = (F.when(s == t, "low").when((s == "int") & (t == "numeric"), "low")
            .when((s == "text") & t.isin("int", "numeric", "bool", "date"), "high")
            .when((s == "int") & (t == "bool"), "medium").otherwise("medium"))
    return compatible, risk, s, t


def _labelled(g: DataFrame, table_name: str) -> DataFrame:
    """The first rule that fits: date, boolean_encoded, categorical, phone, else text."""
    date_fmt = None
    for i, (_, label) in enumerate(PATTERN_DATES):
        date_fmt = (F.when if date_fmt is None else date_fmt.when)(F.col(f"date{i}"), F.lit(label))
    pattern = (F.when(date_fmt.isNotNull(), F.lit("date"))
               .when(F.col("all_bool"), F.lit("boolean_encoded"))
               .when(F.col("all_status") | ((F.col("n_distinct") <= CATEGORICAL_MAX) & (F.col("n_distinct") > 1)),
                     F.lit("categorical"))
               .when(F.col("phone"), F.lit("phone"))
               .otherwise(F.lit("text")))
    return g.select(F.lit(table_name).alias("table_name"), "column_name", pattern.alias("pattern"),
                    F.when(pattern == "date", date_fmt).alias("date_format"),
                    F.col("n").alias("n_values"), "n_distinct",
                    F.when(pattern == "text", round_half_up("avg_len", 1)).alias("avg_length"))


def value_patterns(df: DataFrame, table_name: str, columns=None) -> DataFrame:
    """D-5 over all values: each column with values is labelled by the first rule
    that all of them meet. One shuffle of value counts, as in the profile, so a
    rule looks at each distinct value once."""
    columns = list(columns or df.columns)
    counts = P.value_counts(P.clean(df.select(*columns))).where(P.known())
    v, n = P.as_string(), F.col("n")
    rule = lambda cond: F.bool_and(~F.col("long") & cond)
    aggs = [F.sum(n).alias("n"), F.count(F.lit(1)).alias("n_distinct"), rule(v.isin(PATTERN_BOOL)).alias("all_bool"),
            rule(v.isin(PATTERN_STATUS)).alias("all_status"), rule(v.rlike(PATTERN_PHONE)).alias("phone"),
            (F.sum(F.coalesce("len", F.length(v)) * n) / F.sum(n)).alias("avg_len")]
    aggs += [rule(v.rlike(rx)).alias(f"date{i}") for i, (rx, _) in enumerate(PATTERN_DATES)]
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "c int, column_name string")
    return _labelled(counts.groupBy("c").agg(*aggs).join(names, "c"), table_name)


def sampled_patterns(df: DataFrame, table_name: str, order_by, columns=None, sample: int = SAMPLE_SIZE) -> DataFrame:
    """D-5 as an option over S-5 samples: the first ``sample`` non-null values of
    each column by ``order_by`` (dates by the first 20 of them, phones by the first 10)."""
    v = F.col("value")
    first = lambda k, cond: F.bool_and(F.when(F.col("position") <= k, cond).otherwise(True))
    aggs = [F.count(F.lit(1)).alias("n"), F.count_distinct(v).alias("n_distinct"),
            F.bool_and(v.isin(PATTERN_BOOL)).alias("all_bool"), F.bool_and(v.isin(PATTERN_STATUS)).alias("all_status"),
            first(PHONE_PROBE, v.rlike(PATTERN_PHONE)).alias("phone"), F.avg(F.length(v)).alias("avg_len")]
    aggs += [first(DATE_PROBE, v.rlike(rx)).alias(f"date{i}") for i, (rx, _) in enumerate(PATTERN_DATES)]
    return _labelled(column_samples(df, order_by, k=sample, columns=columns).groupBy("column_name").agg(*aggs), table_name)


def enrich(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """D-8: type check lowers confidence of incompatible pairs to <= 0.65;
    a ``direct`` transform is upgraded by the observed pattern (boolean ->
    normalize_bool with confidence <= 0.75, date -> normalize_date, phone ->
    normalize_phone); each step extends ``notes``.  Patterns are joined on
    (table, column): one row each."""
    p = patterns.select(F.col("table_name").alias("_pt"), F.col("column_name").alias("_pc"), "pattern", "date_format")
    j = (rows.join(p, (rows["table_name"] == p["_pt"]) & (rows["source_col"] == p["_pc"]), "left")
         .withColumn("_sf", type_family(F.coalesce("source_type", F.lit("TEXT"))))
         .withColumn("_tf", type_family(F.coalesce("target_type", F.lit("TEXT")))))
    compatible, risk, sfam, tfam = type_compat(F.col("_sf"), F.col("_tf"), families=True)
    j = j.withColumn("_compat", compatible)
    compatible = F.col("_compat")
    conf0 = F.coalesce(F.col("confidence"), F.lit(DEFAULT_CONFIDENCE))
    conf1 = F.when(~compatible, F.least(conf0, F.lit(INCOMPATIBLE_CAP))).otherwise(F.col("confidence"))
    direct = F.col("transform") == "direct"
    seen = lambda what: direct & (F.col("pattern") == what)
    new_t = (F.when(seen("boolean_encoded"), F.lit("normalize_bool"))
             .when(seen("date"), F.lit("normalize_date"))
             .when(seen("phone"), F.lit("normalize_phone"))
             .otherwise(F.col("transform")))
    conf2 = F.when(seen("boolean_encoded"), F.least(conf1, F.lit(BOOL_CAP))).otherwise(conf1)
    notes = F.concat_ws(
        " | ", F.when(F.col("notes") != "", F.col("notes")),
        F.when(~compatible, F.concat(F.lit("type "), sfam, F.lit(" to "), tfam)),
        F.when(seen("boolean_encoded"), F.lit("boolean codes seen")),
        F.when(seen("date"), F.concat(F.lit("dates seen: "), F.col("date_format"))),
        F.when(seen("phone"), F.lit("phone numbers seen")))
    return j.select("table_name", "position", "source_col", "target_col", "source_type", "target_type",
                    sfam.alias("source_family"), tfam.alias("target_family"), compatible.alias("type_compatible"),
                    risk.alias("type_risk"), F.col("pattern").alias("value_pattern"), "date_format",
                    F.col("transform").alias("proposed_transform"), new_t.alias("transform"),
                    F.col("confidence").alias("proposed_confidence"), conf2.alias("confidence"), notes.alias("notes"),
                    "migration_complexity")


def documents(enriched: DataFrame) -> DataFrame:
    """K-5: one mapping document per table, its mappings in their order. Rows that are
    not enriched give documents too; ``read_mapping_documents`` takes either back."""
    stored = ["position", *MAPPING_ROW.names, "value_pattern"]
    row = F.struct(*[c for c in stored if c in enriched.columns])
    target = [F.any_value("table_target").alias("table_target")] if "table_target" in enriched.columns else []
    return enriched.groupBy(F.col("table_name").alias("table")).agg(
        *target, F.any_value("migration_complexity").alias("migration_complexity"), F.sort_array(F.collect_list(row)).alias("mappings"))


def ambiguous(enriched: DataFrame) -> DataFrame:
    """P-10: mappings whose confidence (missing = 1) is below 0.80."""
    from tidyload.operators.transform import keep_where
    return keep_where(enriched, F.coalesce(F.col("confidence"), F.lit(1.0)) < AMBIGUOUS_BELOW)


def summary(enriched: DataFrame, approved: bool = False) -> DataFrame:
    """D-9 / D-10: per table counts by confidence band, ambiguous count,
    complexity and whether a human review is needed."""
    c = F.coalesce(F.col("confidence"), F.lit(0.0))
    g = enriched.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_mappings"),
        F.count_if(c >= 0.9).alias("n_high"),
        F.count_if((c >= 0.7) & (c < 0.9)).alias("n_medium"),
        F.count_if(c < 0.7).alias("n_low"),
        F.count_if(F.coalesce(F.col("confidence"), F.lit(1.0)) < AMBIGUOUS_BELOW).alias("n_ambiguous"),
        F.first("migration_complexity").alias("migration_complexity"))
    return g.withColumn("needs_review", (F.col("n_ambiguous") > 0) & F.lit(not approved))


def unmapped(spark: SparkSession, rows: DataFrame, source_schemas: dict) -> DataFrame:
    """P-16: source columns without a mapping, target columns without a source
    (left-anti joins of schema rows against the mapping rows)."""
    src = spark.createDataFrame([(t, c) for t, cols in source_schemas.items() for c in cols],
                                "table_name string, column_name string")
    tgt = spark.createDataFrame([(t, c) for t, cols in TARGET_COLUMNS.items() if t in source_schemas for c in cols],
                                "table_name string, column_name string")
    ms = rows.select("table_name", F.col("source_col").alias("column_name"))
    mt = rows.select("table_name", F.col("target_col").alias("column_name"))
    a = src.join(ms, ["table_name", "column_name"], "left_anti").withColumn("side", F.lit("source"))
    b = tgt.join(mt, ["table_name", "column_name"], "left_anti").withColumn("side", F.lit("target"))
    return a.unionByName(b)


# ---- mapping-driven projection (P-14) and the staging presets --------------

STATUS_BY_TABLE = {"customers": "normalize_status_customer", "orders": "normalize_status_order"}

STAGING = {
    "status_customer": N.staging_status_customer,
    "status_order": N.staging_status_order,
    "bool_product": lambda c: N.staging_bool(c, N.STAGING_PRODUCT_TRUE),
    "bool_supplier": lambda c: N.staging_bool(c, N.STAGING_SUPPLIER_TRUE),
    "bool": lambda c: N.staging_bool(c, N.STAGING_TRUE),
    "country": N.staging_country,
    "upper_trim": N.staging_upper_trim,
    "numeric": lambda c: c.try_cast("double"),
    "date": lambda c: c.try_cast("date"),
}


def _staging_column(m) -> Column | None:
    """The staging generator's dispatch: ``skip`` drops; ``direct``, or no staging
    conversion, copies; dates and numbers are cast, phones copied, and anything
    else goes through the row's conversion."""
    src, tr, conversion = F.col(m["source_col"]), m["transform"] or "direct", m["staging"]
    if tr == "skip":
        return None
    if tr in ("direct", "normalize_phone") or not conversion:
        return src
    return STAGING[{"normalize_date": "date", "cast_numeric": "numeric"}.get(tr, conversion)](src)


def _registry_transform(m, table) -> str | None:
    tr = m["transform"] or "direct"
    if tr == "skip":
        return None
    if tr == "normalize_status":
        return STATUS_BY_TABLE.get(table, "normalize_status_customer")
    return tr


def apply_mapping(df: DataFrame, mapping: DataFrame, table: str, mode: str = "registry",
                  relabelled: dict | None = None) -> DataFrame:
    """P-14: compile the (few) mapping rows of ``table`` into a projection.

    ``mode='registry'`` resolves each row's transform to this library's Column
    builders (multi-step ones as staged projections); ``relabelled`` (target column
    -> transform) names the rows whose label is known to be wrong.
    ``mode='staging'`` follows the staging generator."""
    from tidyload.operators.transform import staged_select
    rows = [r.asDict() for r in mapping.where(F.col("table_name") == table).orderBy("position").collect()]
    if mode == "staging":
        cols = [(m["target_col"], _staging_column(m)) for m in rows]
        return df.select(*[c.alias(name) for name, c in cols if c is not None])
    items = [(m["target_col"], m["source_col"], (relabelled or {}).get(m["target_col"]) or _registry_transform(m, table)) for m in rows]
    return staged_select(df, [i for i in items if i[2] is not None])


def staging_filter(table: str, as_written: bool = False) -> Column | None:
    """The staging models' anti-corruption filters on source columns.

    products: intended ``(price >= 0 or null) and (stock >= 0 or null)``; with
    ``as_written`` the generated text's precedence
    ``price >= 0 OR (price IS NULL AND stock >= 0) OR stock IS NULL``.
    order_lines: ``qty > 0 OR qty IS NULL``."""
    if table == "products":
        p, s = F.col("prod_price"), F.col("prod_stock")
        if as_written:
            return F.coalesce(p >= 0, F.lit(False)) | (p.isNull() & F.coalesce(s >= 0, F.lit(False))) | s.isNull()
        return (F.coalesce(p >= 0, F.lit(False)) | p.isNull()) & (F.coalesce(s >= 0, F.lit(False)) | s.isNull())
    if table == "order_lines":
        q = F.col("line_qty")
        return F.coalesce(q > 0, F.lit(False)) | q.isNull()
    return None


def staging_model(df: DataFrame, mapping: DataFrame, table: str, as_written: bool = False) -> DataFrame:
    """P-11 .. P-13c: the generated staging model of a table (staging mode of
    P-14 plus the table's filter), expressed as one filtered projection."""
    cond = staging_filter(table, as_written)
    src = df.where(cond) if cond is not None else df
    return apply_mapping(src, mapping, table, mode="staging")
