"""Column profile (A-1 .. A-11) and encoding detection (D-1 .. D-4).

Plan shape, whatever the table width: the rows (long texts as digests) are dealt out
by all their columns, unpivoted to (column, value) pairs, nulls included, and counted
by value in one more shuffle of entries of a fixed width (partially aggregated, so hot
values collapse before the exchange), each kind of value (whole numbers, floating
numbers, texts, rows) by itself. Every figure of the profile comes from those
counts: nulls, distinct values, duplicates, minimum, maximum, mean, negatives, text
lengths, date layouts and encoding flags. The figures, a row per column, are written
once while the query is built; nothing is estimated.

Value lists are bounded by construction: boolean encodings hold words of a
vocabulary of twelve, status encodings are listed for columns whose exact distinct
count is 2 to 15. Texts longer than ``LONG_TEXT`` bytes are grouped by their
SHA-256, so whole documents never cross a shuffle. The values of the columns that D-4
lists come from a second look at the table that reads these columns only.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyload.functions import normalize as N
from tidyload.functions.numeric import exact_sum, ratio, round_half_up
from tidyload.session import written

# The boolean-encoding vocabulary (upper-cased) and the limits of D-4.
BOOL_VALUES = ["1", "0", "Y", "N", "YES", "NO", "TRUE", "FALSE", "A", "I", "ACTIVE", "INACTIVE"]
STATUS_MIN_VALUES, STATUS_MAX_VALUES = 2, 15

LONG_TEXT = 256
"""Bytes beyond which a text is grouped by its digest (the figures do not change)."""

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType, T.BooleanType)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
FLOATING = (T.FloatType, T.DoubleType)

ROW_PSEUDO_COLUMN = "*"
ROW_ORDINAL = -1
META_SCHEMA = "c int, column_name string, dtype string, is_text boolean, is_numeric boolean"


def is_text(dt) -> bool:
    return isinstance(dt, T.StringType)


def is_numeric(dt) -> bool:
    return isinstance(dt, NUMERIC)


def clean(df: DataFrame) -> DataFrame:
    """Floating columns: NaN is missing (pandas semantics), and -0.0 is 0.0."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, FLOATING):
            c = F.nanvl(c, F.lit(None).cast(f.dataType)) + F.lit(0.0).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _is_long(c: Column) -> Column:
    return F.coalesce(F.octet_length(c) > LONG_TEXT, F.lit(False))


def _entry(ordinal: int, c: Column, dt) -> Column:
    """One value of a row: its column's ordinal, and the value as text (or digest), double or long."""
    text = c if is_text(dt) else c.cast("string")
    long = _is_long(text) if is_text(dt) else F.lit(False)
    return F.struct(
        F.lit(ordinal).alias("c"),
        (F.lit(None).cast("string") if isinstance(dt, WHOLE + FLOATING) else F.when(long, F.sha2(text, 256)).otherwise(text)).alias("s"),
        (c.cast("double") if isinstance(dt, FLOATING + (T.DecimalType,)) else F.lit(None).cast("double")).alias("d"),
        (c.cast("int").cast("long") if isinstance(dt, T.BooleanType) else c.cast("long") if isinstance(dt, WHOLE)
         else F.lit(None).cast("long")).alias("l"),
        long.alias("long"),
        (F.length(text) if is_text(dt) else F.lit(None).cast("int")).alias("len"))


def value_counts(df: DataFrame) -> DataFrame:
    """(c, s, d, l, long, len, n): how often each value of each column occurs,
    nulls (no s, d or l) included. ``df`` is cleaned already."""
    entries = [_entry(i, F.col(f"`{f.name}`"), f.dataType) for i, f in enumerate(df.schema.fields)]
    return (df.select(F.explode(F.array(*entries)).alias("p"))
            .groupBy("p.c", "p.s", "p.d", "p.l", "p.long")
            .agg(F.max("p.len").alias("len"), F.count(F.lit(1)).alias("n")))


def known() -> Column:
    return F.col("s").isNotNull() | F.col("d").isNotNull() | F.col("l").isNotNull()


def as_string() -> Column:
    """A counted value as text (a long one as its digest)."""
    return F.coalesce("s", F.col("l").cast("string"), F.col("d").cast("string"))


def _compact(df: DataFrame) -> DataFrame:
    """The cleaned rows with short columns: ``v<i>`` is the value (a long text's
    digest, other types as numbers or texts), ``w<i>`` a long text's length (else null)."""
    cols = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if is_text(f.dataType):
            cols += [F.when(_is_long(c), F.sha2(c, 256)).otherwise(c).alias(f"v{i}"), F.when(_is_long(c), F.length(c)).alias(f"w{i}")]
        elif isinstance(f.dataType, T.BooleanType):
            cols.append(c.cast("int").cast("long").alias(f"v{i}"))
        else:
            cols.append(c.cast("long" if isinstance(f.dataType, WHOLE) else "double" if isinstance(f.dataType, FLOATING) else "string").alias(f"v{i}"))
    return df.select(*cols)


def _row_hashes(rows: DataFrame) -> list[Column]:
    """128 bits of hashes over a compact row (nulls by their place)."""
    parts = [x for c in rows.columns for x in ((F.col(c),) if c.startswith("w") else (F.col(c), F.col(c).isNull()))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


# What the figures need to know of a value beside the value, in one number: a bit per word
# of BOOL_VALUES, one per date layout, three flags, and the length.
WORD_BITS, DATE_SHIFT, INVALID, LONG, TEXTUAL, LENGTH_SHIFT = (1 << 12) - 1, 12, 1 << 16, 1 << 17, 1 << 18, 19


def _date_bits(s: Column) -> Column:
    """A bit for the layout of a date text. A separator's place tells the only layout that
    can match, so a value meets one regular expression at most."""
    matched = [F.when(s.rlike(regex), F.lit(1 << i)) for i, (_, regex, _) in enumerate(N.DATE_LAYOUTS)]
    third, fifth = F.substring(s, 3, 1), F.substring(s, 5, 1)
    begins = (F.octet_length(s) <= 12) & F.substring(s, 1, 1).between("0", "9")  # no other text has a date's layout
    return F.when(begins, F.when(fifth == "-", matched[0]).when(third == "/", matched[1]).when(third == "-", matched[2]).otherwise(matched[3]))


def _invalid(valid_sets: dict, value: Column, long: Column) -> Column:
    """INVALID for a value outside its column's set, else 0."""
    valid = None
    for ordinal, values in valid_sets.items():
        texts = [str(v) for v in values]
        digests = [sha256(t.encode()).hexdigest() for t in texts if len(t.encode()) > LONG_TEXT]
        among = F.when(long, value.isin(digests)).otherwise(value.isin(texts))
        valid = (F.when if valid is None else valid.when)(F.col("c") == ordinal, among)
    return F.lit(0) if valid is None else F.when(F.coalesce(~valid, F.lit(False)), F.lit(INVALID)).otherwise(F.lit(0))


def _facts(valid_sets: dict) -> Column:
    """``facts`` of an exploded text (s, w); they depend on its column and value only."""
    s, long = F.col("s"), F.col("w").isNotNull()
    words = F.create_map(*[F.lit(x) for i, w in enumerate(BOOL_VALUES) for x in (w, 1 << i)])
    word = F.when(F.octet_length(s) <= 32, F.try_element_at(words, F.upper(s)))
    facts = (F.coalesce(word, F.lit(0)) + F.coalesce(_date_bits(s), F.lit(0)) * (1 << DATE_SHIFT) + _invalid(valid_sets, s, long)
             + F.when(long, F.lit(LONG)).otherwise(F.lit(0)) + F.when(s.isNotNull(), F.lit(TEXTUAL)).otherwise(F.lit(0)))
    return facts.cast("long") + F.coalesce("w", F.length(s), F.lit(0)).cast("long") * (1 << LENGTH_SHIFT)


def _fixed_counts(df: DataFrame, with_rows: bool, valid_sets: dict) -> DataFrame:
    """(c, a, d, b, facts, n): how often each value of each column occurs, nulls (no
    ``a`` or ``d``) included. A number is itself (``a`` or ``d``), a text two 64-bit
    hashes (``a``, ``b``), so that keys and counts have a fixed width.

    The compact rows are dealt out by all their columns first: a task that counts gets
    a share that the shuffle partitions bound, whatever the files' splits are. Whole
    numbers, floating numbers, texts and rows are counted apart, from that one exchange:
    each kind has a key as narrow as it can be, and a task holds one kind at a time."""
    rows = _compact(df)
    rows = rows.repartition(*rows.columns)
    types = [f.dataType for f in df.schema.fields]
    n = F.count(F.lit(1)).alias("n")
    none = F.lit(None).cast("double")
    kinds = []
    for kind, column in ((WHOLE, "a"), (FLOATING, "d")):
        at = [i for i, t in enumerate(types) if isinstance(t, kind)]
        if at:
            found = rows.select(F.posexplode(F.array(*[F.col(f"v{i}").cast("long" if kind is WHOLE else "double") for i in at])).alias("at", column))
            counted = found.groupBy("at", column).agg(n).withColumn("c", F.get(F.array(*[F.lit(i) for i in at]), F.col("at")))
            value = F.col(column)
            kinds.append(counted.select("c", value if kind is WHOLE else F.lit(None).cast("long").alias("a"), none.alias("d") if kind is WHOLE else value,
                                        F.lit(0).cast("long").alias("b"), _invalid(valid_sets, value.cast("string"), F.lit(False)).cast("long").alias("facts"), "n"))
    at = [i for i, t in enumerate(types) if not isinstance(t, WHOLE + FLOATING)]
    if at:
        decimal = any(isinstance(types[i], T.DecimalType) for i in at)
        entries = F.array(*[F.struct(
            F.lit(i).alias("c"), F.col(f"v{i}").alias("s"), (F.col(f"w{i}") if is_text(types[i]) else F.lit(None).cast("int")).alias("w"),
            *([(F.col(f"v{i}").cast("double") if isinstance(types[i], T.DecimalType) else none).alias("d")] if decimal else [])) for i in at])
        hashed = [F.when(F.col("s").isNotNull(), F.xxhash64(F.lit(seed), "s", "w")) for seed in (3, 4)]
        numbers = ["d"] if decimal else []
        found = rows.select(F.explode(entries).alias("p")).select("p.*").select(
            "c", hashed[0].alias("a"), *numbers, F.coalesce(hashed[1], F.lit(0)).alias("b"), _facts(valid_sets).alias("facts"))
        kinds.append(found.groupBy("c", "a", *numbers, "b", "facts").agg(n).select("c", "a", *(numbers or [none.alias("d")]), "b", "facts", "n"))
    if with_rows:
        a, b = _row_hashes(rows)
        counted = rows.select(a.alias("a"), b.alias("b")).groupBy("a", "b").agg(n)
        kinds.append(counted.select(F.lit(ROW_ORDINAL).alias("c"), "a", none.alias("d"), "b", F.lit(TEXTUAL).cast("long").alias("facts"), "n"))
    return reduce(DataFrame.unionByName, kinds)


def _statistics(counts: DataFrame, valid_sets: dict) -> DataFrame:
    """One row per column ordinal, from the value counts."""
    n, facts = F.col("n"), F.col("facts")
    has = lambda bit: facts.bitwiseAND(F.lit(bit)) != 0
    known = F.col("a").isNotNull() | F.col("d").isNotNull()
    num = F.coalesce("d", F.when(~has(TEXTUAL), F.col("a").cast("double")))
    length = F.when(has(TEXTUAL), F.shiftright(facts, LENGTH_SHIFT))
    words = facts.bitwiseAND(F.lit(WORD_BITS))
    aggs = [F.sum(n).alias("row_count"), F.sum(F.when(~known, n)).alias("null_count"),
            F.count_if(known).alias("unique_count"), F.sum(F.when(known, n - 1)).alias("dup_count"),
            F.min(num).alias("min"), F.max(num).alias("max"),
            (exact_sum(num, n) / F.sum(F.when(num.isNotNull(), n))).alias("mean_raw"),
            F.sum(F.when(num < 0, n)).alias("negative_count"),
            (F.sum(length * n) / F.sum(F.when(length.isNotNull(), n))).alias("len_raw"),
            F.bool_and(F.when(known, words > 0)).alias("all_bool"), F.bit_or(words).alias("words")]
    for i, name in enumerate(("date_iso", "date_fr", "date_us", "date_compact")):
        aggs.append(F.sum(F.when(has(1 << (DATE_SHIFT + i)), n)).alias(name))
    if valid_sets:
        aggs.append(F.sum(F.when(has(INVALID), n)).alias("invalid_count"))
    found = F.array_sort(F.array_compact(F.array(*[F.when(F.col("words").bitwiseAND(F.lit(1 << i)) != 0, F.lit(w))
                                                  for i, w in enumerate(BOOL_VALUES)])))
    return counts.groupBy("c").agg(*aggs).withColumn("bool_words", found).drop("words")


def _by_column(df: DataFrame, meta_rows: list, with_rows: bool = False, valid_sets: dict | None = None) -> DataFrame:
    """The figures of every column: a row per column, written once, since the lists of
    status values are looked up by them."""
    figures = _statistics(_fixed_counts(df, with_rows, valid_sets or {}), valid_sets or {})
    meta = F.array(*[F.struct(*[F.lit(x) for x in row]) for row in meta_rows]).cast(f"array<struct<{META_SCHEMA.replace(' ', ':')}>>".replace(",:", ","))
    return written(df.sparkSession.range(1).select(F.inline(meta)).join(figures, "c", "left"))


def _status_lists(df: DataFrame, by_column: DataFrame) -> DataFrame:
    """(c, values): the sorted values of the columns that D-4 lists, at most 15 each,
    from a second look at these columns only."""
    chosen = [r["c"] for r in by_column.where(
        F.col("is_text") & ~F.coalesce("all_bool", F.lit(False))
        & F.col("unique_count").between(STATUS_MIN_VALUES, STATUS_MAX_VALUES)).select("c").collect()]
    if not chosen:
        return by_column.select("c", F.lit(None).cast("array<string>").alias("values")).where(F.lit(False))
    texts = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{df.columns[i]}`").alias("text")) for i in sorted(chosen)])
    return df.select(F.explode(texts).alias("p")).where(F.col("p.text").isNotNull()).groupBy("p.c", "p.text").agg(
        F.count(F.lit(1)).alias("n")).groupBy("c").agg(F.array_sort(F.collect_list("text")).alias("values"))


def profile(df: DataFrame, table_name: str, with_rows: bool = False, valid_sets: dict | None = None) -> DataFrame:
    """Long-format profile, one row per column (see module doc for the plan).

    With ``with_rows`` the row digest is counted as a pseudo-column ``*`` (ordinal
    -1): its ``dup_count`` is the whole-row duplicate count (A-8). ``valid_sets``
    (column -> supplied values) adds ``invalid_count``, the rows whose value lies
    outside (null for columns without a set)."""
    df = clean(df)
    fields = df.schema.fields
    ordinals = {f.name: i for i, f in enumerate(fields)}
    meta_rows = [(i, f.name, f.dataType.simpleString(), is_text(f.dataType), is_numeric(f.dataType))
                 for i, f in enumerate(fields)]
    if with_rows:
        meta_rows.append((ROW_ORDINAL, ROW_PSEUDO_COLUMN, "row", False, False))
    sets = {ordinals[c]: v for c, v in (valid_sets or {}).items()}
    by_column = _by_column(df, meta_rows, with_rows, sets)
    text = F.col("is_text")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    layouts = ("date_iso", "date_fr", "date_us", "date_compact")
    dates = {c: F.when(text, zero(c)).otherwise(F.lit(0)).cast("bigint") for c in layouts}
    n_formats = sum((dates[c] > 0).cast("bigint") for c in layouts)
    bool_enc = F.when(text & F.coalesce("all_bool", F.lit(False)), F.array_join("bool_words", ","))
    listed = by_column.join(_status_lists(df, by_column), "c", "left")
    number = F.when(F.col("is_numeric"), F.lit(True))
    return listed.select(
        F.lit(table_name).alias("table_name"),
        "column_name", F.col("c").alias("ordinal"), "dtype", "is_text", "is_numeric",
        zero("row_count").alias("row_count"), zero("null_count").alias("null_count"),
        ratio(zero("null_count"), zero("row_count"), 4).alias("null_rate"),
        zero("unique_count").alias("unique_count"),
        ratio(zero("unique_count"), zero("row_count"), 4).alias("unique_rate"),
        zero("dup_count").alias("dup_count"),
        F.when(number, F.col("min")).alias("min"), F.when(number, F.col("max")).alias("max"),
        F.when(number, round_half_up("mean_raw", 2)).alias("mean"),
        F.when(number, zero("negative_count")).otherwise(F.lit(0)).cast("bigint").alias("negative_count"),
        F.when(text, F.coalesce(round_half_up("len_raw", 1), F.lit(0.0))).alias("avg_length"),
        *[dates[c].alias(c) for c in layouts],
        n_formats.cast("bigint").alias("n_date_formats"),
        (n_formats > 1).alias("mixed_dates"),
        bool_enc.alias("bool_encoding"),
        F.array_join("values", ",").alias("status_encoding"),
        *([F.when(F.col("c").isin(list(sets)), zero("invalid_count")).alias("invalid_count")] if sets else []),
    )


def status_sets(df: DataFrame) -> DataFrame:
    """D-4 as lists: (column_name, values) of the text columns with few values, sorted."""
    df = clean(df)
    by_column = _by_column(df, [(i, f.name, f.dataType.simpleString(), is_text(f.dataType), is_numeric(f.dataType))
                                for i, f in enumerate(df.schema.fields)])
    return by_column.join(_status_lists(df, by_column), "c").select("column_name", "values")


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of the row's JSON form (field names, escaped values, nulls
    omitted per field): equal rows, nulls equal, give equal digests."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256)


def dup_rows(df: DataFrame, table_name: str) -> DataFrame:
    """A-8: rows after the first equal one (nulls equal).  Rows are grouped by
    their 32-byte digest, so the shuffle carries digests (partially
    aggregated map-side) rather than whole rows, however wide the texts."""
    c = clean(df)
    g = c.groupBy(row_digest(c).alias("_d")).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("dup_rows"),
                 F.count(F.lit(1)).alias("distinct_rows")).select(
        F.lit(table_name).alias("table_name"), "dup_rows", "distinct_rows")


def dup_keys(df: DataFrame, table_name: str, columns) -> DataFrame:
    """A-9 / C-2: duplicates among non-null values, per column."""
    columns = list(columns)
    g = value_counts(clean(df.select(*columns))).where(known()).groupBy("c").agg(
        F.sum(F.col("n") - 1).cast("bigint").alias("duplicates"), F.count(F.lit(1)).alias("distinct_values"))
    meta = df.sparkSession.createDataFrame(list(enumerate(columns)), "c int, column_name string")
    return meta.join(g, "c", "left").select(
        F.lit(table_name).alias("table_name"), "column_name", F.coalesce("duplicates", F.lit(0)).cast("bigint").alias("duplicates"),
        F.coalesce("distinct_values", F.lit(0)).cast("bigint").alias("distinct_values"))
