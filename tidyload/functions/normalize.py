"""Value normalisers (N-1 .. N-12) as pure ``Column -> Column`` builders.

Every builder returns a native Catalyst expression, so a whole table transform
stays inside one whole-stage-codegen span; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Date layouts tried in this order (regex is anchored; formats are disjoint).
DATE_LAYOUTS = [
    ("iso", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
    ("dd/mm/yyyy", r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "dd/MM/yyyy"),
    ("mm-dd-yyyy", r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "MM-dd-yyyy"),
    ("yyyymmdd", r"^[0-9]{8}$", "yyyyMMdd"),
]

CUSTOMER_ACTIVE_VALUES = ["1", "a", "active", "yes", "y"]

ORDER_STATUS_CODES = {
    "pending": ["P", "PEND", "PENDING", "0"],
    "confirmed": ["C", "CONF", "CONFIRMED", "1"],
    "shipped": ["S", "SHIP", "SHIPPED", "2"],
    "delivered": ["D", "DELIV", "DELIVERED", "3"],
    "cancelled": ["X", "CANC", "CANCELLED", "9"],
}

TRUE_VALUES = ["1", "Y", "YES", "TRUE", "A", "ACTIVE"]

COUNTRY_NAMES = {
    "TN": ["tunisia", "tunisie", "tn"],
    "FR": ["france", "fr"],
    "DZ": ["algerie", "algeria", "dz"],
    "MA": ["maroc", "morocco", "ma"],
    "DE": ["allemagne", "germany", "de"],
    "US": ["us", "usa", "united states"],
    "CN": ["cn", "china"],
    "IT": ["it", "italy", "italie"],
    "ES": ["es", "spain", "espagne"],
    "TR": ["tr", "turkey", "turquie"],
}

SEGMENTS = ["B2B", "B2C", "VIP"]
CHANNELS = ["WEB", "TEL", "STORE", "API"]
CUSTOMER_STATUSES = ["active", "inactive"]
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]

DEFAULT_COUNTRY = "TN"
DEFAULT_CURRENCY = "TND"
PHONE_COUNTRY_PREFIX = "216"

# Characters Python's str.strip() removes, derived by rule (str.isspace) rather
# than listed, so the set is exactly Python's.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c) -> Column:
    """Text view of any value (the reference calls ``str(val)`` first)."""
    return _col(c).cast("string")


def strip(c) -> Column:
    """N-12: Python ``str.strip()``; Spark ``trim`` only removes spaces."""
    return F.btrim(as_text(c), F.lit(WHITESPACE))


def lower_strip(c) -> Column:
    """N-8: ``lower`` then strip (email)."""
    return strip(F.lower(as_text(c)))


def upper_strip(c) -> Column:
    """N-8: ``upper`` then strip (channel)."""
    return strip(F.upper(as_text(c)))


# (regex label) -> 1-based (start, length) of year, month, day in the text.
DATE_PARTS = {
    "iso": ((1, 4), (6, 2), (9, 2)),
    "dd/mm/yyyy": ((7, 4), (4, 2), (1, 2)),
    "mm-dd-yyyy": ((7, 4), (1, 2), (4, 2)),
    "yyyymmdd": ((1, 4), (5, 2), (7, 2)),
}


def _days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return (F.when(m == 2, F.when(leap, 29).otherwise(28))
            .when(m.isin(4, 6, 9, 11), 30).otherwise(31))


DIGITS = "0123456789"


def date_shape(s: Column) -> Column:
    """N-1 step 2: struct(text, shape) of already-stripped text, its shape being the
    text with every digit as 0. A layout has one shape, so one pass over the text takes
    the place of a regular expression per layout."""
    return F.when(s.isNotNull(), F.struct(s.alias("text"), F.translate(s, DIGITS, "0" * len(DIGITS)).alias("shape")))


def _shape(label: str) -> str:
    """The shape of a layout, from its date format."""
    pattern = next(fmt for name, _, fmt in DATE_LAYOUTS if name == label)
    return "".join("0" if c.isalpha() else c for c in pattern)


def date_parts(p: Column) -> Column:
    """N-1 step 3: struct(y, m, d) from the layout of a ``date_shape`` (null when none
    matches)."""
    out = None
    for label, parts in DATE_PARTS.items():
        cut = F.struct(*[F.substring(p["text"], start, length).cast("int").alias(n) for n, (start, length) in zip("ymd", parts)])
        out = (F.when if out is None else out.when)(p["shape"] == _shape(label), cut)
    return out


def date_from_parts(p: Column) -> Column:
    """N-1 step 4: calendar check (leap years included) then ``make_date``,
    evaluated only on valid parts, so bad dates cost no parse exception."""
    y, m, d = p["y"], p["m"], p["d"]
    valid = (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= _days_in_month(y, m))
    return F.when(valid, F.make_date(y, m, d))


def normalize_date(c) -> Column:
    """N-1: mixed legacy date text -> DATE; no layout or invalid day -> null.

    ``dd-MM-yyyy`` is read as ``MM-dd-yyyy`` exactly like the reference, so a day
    above 12 becomes null and smaller days are swapped; year 0 is rejected
    (Python has none).  Table transforms run the four steps (strip, shape, parts,
    date) as staged projections so each is computed once per row; this
    single-expression form is for ad hoc use.
    """
    return date_from_parts(date_parts(date_shape(strip(c))))


def normalize_status_customer(c) -> Column:
    """N-2: null -> active; {1,a,active,yes,y} (strip+lower) -> active; else inactive."""
    v = F.lower(strip(c))
    return (
        F.when(_col(c).isNull(), F.lit("active"))
        .when(v.isin(CUSTOMER_ACTIVE_VALUES), F.lit("active"))
        .otherwise(F.lit("inactive"))
    )


def normalize_status_order(c) -> Column:
    """N-3: 20-code map after strip+upper; null or unknown -> pending."""
    v = F.upper(strip(c))
    out = None
    for state, codes in ORDER_STATUS_CODES.items():
        out = (F.when if out is None else out.when)(v.isin(codes), F.lit(state))
    return out.otherwise(F.lit("pending"))


def normalize_bool(c, as_int: bool = True) -> Column:
    """N-4: null -> 0; {1,Y,YES,TRUE,A,ACTIVE} after strip+upper -> 1; else 0."""
    flag = F.coalesce(F.upper(strip(c)).isin(TRUE_VALUES), F.lit(False))
    return flag.cast("int") if as_int else flag


def normalize_country(c) -> Column:
    """N-5: null -> TN; 28 names -> ISO-2; else first two letters of upper(raw)."""
    text = as_text(c)
    v = F.lower(strip(text))
    out = F.when(text.isNull(), F.lit(DEFAULT_COUNTRY))
    for code, names in COUNTRY_NAMES.items():
        out = out.when(v.isin(names), F.lit(code))
    return out.otherwise(F.substring(F.upper(text), 1, 2))


def normalize_currency(c) -> Column:
    """N-6: null -> TND; else first three letters of upper(strip)."""
    text = as_text(c)
    return F.when(text.isNull(), F.lit(DEFAULT_CURRENCY)).otherwise(
        F.substring(F.upper(strip(text)), 1, 3)
    )


def normalize_phone(c) -> Column:
    """N-7: keep digits and '+', then apply the +216 prefix rules; < 8 chars -> null."""
    d = F.regexp_replace(as_text(c), r"[^0-9+]", "")
    p = PHONE_COUNTRY_PREFIX
    fixed = (
        F.when(d.startswith("00" + p), F.concat(F.lit("+"), F.substring(d, 3, 1 << 30)))
        .when(d.startswith(p) & (F.length(d) >= 11), F.concat(F.lit("+"), d))
        .when(~d.startswith("+") & (F.length(d) == 8), F.concat(F.lit("+" + p), d))
        .otherwise(d)
    )
    return F.when(F.length(fixed) >= 8, fixed)


def domain_restrict(c, allowed) -> Column:
    """P-2: value if in the allowed set (exact), else null."""
    c = _col(c)
    return F.when(c.isin(list(allowed)), c)


# Numeric text as pandas.to_numeric accepts it (no NaN/inf, no trailing junk).
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(c, source_type: str = "string") -> Column:
    """P-3: ``pd.to_numeric(errors='coerce')``; bad text -> null, NaN -> null.

    ``source_type`` is the Spark simple type name of the input column; integral
    inputs stay integral, floating inputs have NaN mapped to null (pandas treats
    NaN as missing), text goes through a strict numeric pattern first because
    ``try_cast`` would accept '12d' and 'NaN'.
    """
    c = _col(c)
    if source_type in ("tinyint", "smallint", "int", "bigint", "byte", "short", "long", "integer"):
        return c
    if source_type in ("double", "float"):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    if source_type.startswith("decimal"):
        return c.cast("double")
    text = as_text(c)
    return F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))


def clip_lower(c, lower) -> Column:
    """P-4: ``clip(lower=x)``; null stays null (``greatest`` would not)."""
    c = _col(c)
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def clip(c, lower, upper) -> Column:
    """P-5: two-sided clip; null stays null."""
    c = _col(c)
    return F.when(c < F.lit(lower), F.lit(lower)).when(c > F.lit(upper), F.lit(upper)).otherwise(c)


def fill(c, default) -> Column:
    """P-6: default fill."""
    return F.coalesce(_col(c), F.lit(default))


def to_int(c) -> Column:
    """P-7: ``astype(int)`` after a fill: truncation toward zero; a value out of
    range becomes null instead of aborting the job."""
    return _col(c).try_cast("long")


# ---------------------------------------------------------------------------
# Staging variants (N-9 .. N-11), as the staging models spell them. They differ
# from N-2 .. N-6 on case, on 'yes'/'y' and on nulls.
# ---------------------------------------------------------------------------

# Fixed values of the staging variants.
STAGING_ACTIVE = ["1", "A", "active"]
STAGING_ORDER_STATUS = {
    "pending": ["P", "PEND", "pending", "0"],
    "confirmed": ["C", "CONF", "confirmed", "1"],
    "shipped": ["S", "SHIP", "shipped", "2"],
    "delivered": ["D", "DELIV", "delivered", "3"],
    "cancelled": ["X", "CANC", "cancelled", "9"],
}
STAGING_TRUE = ["1", "Y", "YES", "TRUE", "A", "ACTIVE"]
STAGING_PRODUCT_TRUE = ["Y", "1", "YES", "TRUE"]
STAGING_SUPPLIER_TRUE = ["Y", "1", "YES"]
STAGING_COUNTRIES = {
    "TN": ["TN", "TUNISIA", "TUNISIE"],
    "FR": ["FR", "FRANCE"],
    "DZ": ["DZ", "ALGERIE", "ALGERIA"],
}


def staging_status_customer(c) -> Column:
    """N-9 customers: case-sensitive, null is inactive."""
    return F.when(_col(c).isin(STAGING_ACTIVE), F.lit("active")).otherwise(F.lit("inactive"))


def staging_status_order(c) -> Column:
    """N-9 orders: case-sensitive codes, unknown and null are pending."""
    out = None
    for state, codes in STAGING_ORDER_STATUS.items():
        out = (F.when if out is None else out.when)(_col(c).isin(codes), F.lit(state))
    return out.otherwise(F.lit("pending"))


def staging_bool(c, true_values) -> Column:
    """N-10: upper-cased text in a set -> 1, all else -> 0."""
    return F.when(F.upper(as_text(c)).isin(list(true_values)), F.lit(1)).otherwise(F.lit(0))


def staging_country(c) -> Column:
    """N-11: three countries' spellings -> code, anything else unchanged."""
    u, out = F.upper(_col(c)), None
    for code, names in STAGING_COUNTRIES.items():
        out = (F.when if out is None else out.when)(u.isin(names), F.lit(code))
    return out.otherwise(_col(c))


def staging_upper_trim(c) -> Column:
    """N-10: upper and trim (spaces only)."""
    return F.upper(F.trim(as_text(c)))
