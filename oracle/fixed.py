"""Fixed values of the oracle, stated here apart from the library's own."""

# What Python's str.strip() removes.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")
DATE_LAYOUTS = [
    ("iso", "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("dd/mm/yyyy", "^[0-9]{2}/[0-9]{2}/[0-9]{4}$"),
    ("mm-dd-yyyy", "^[0-9]{2}-[0-9]{2}-[0-9]{4}$"),
    ("yyyymmdd", "^[0-9]{8}$"),
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

# Values of the legacy views.
ORDER_STATUS_RAW = [
    "P", "PEND", "pending", "0", "C", "CONF", "confirmed", "1", "S", "SHIP",
    "shipped", "2", "D", "DELIV", "delivered", "3", "X", "CANC", "cancelled", "9",
]
ORDER_TVA = [19.0, 7.0, 0.0, None]
ORDER_CHANNEL = ["WEB", "tel", " Store ", "API", "FAX", None]
CUSTOMER_STATUS_RAW = ["1", "0", "A", "I", "active", "inactive", None, " Y "]
CUSTOMER_COUNTRY_RAW = ["TN", "Tunisia", "Tunisie", "FR", "France", "DZ", "MA", "DE", "US", " maroc ", "Belgique", None]
CUSTOMER_SEGMENT_RAW = ["B2B", "B2C", "VIP", None, "b2b", "B2B"]
PRODUCT_CURRENCY_RAW = ["TND", "EUR", "USD", "tnd", " eur ", None]
PRODUCT_UNIT_RAW = ["pièce", "pcs", "unit", "box", "kg", None]
PRODUCT_ACTIVE_RAW = ["Y", "N", "1", "0", "yes", "no"]
SUPPLIER_COUNTRY_RAW = ["TN", "CN", "DE", "fr ", "IT", "Espagne", "US", "TR"]
SUPPLIER_RATING_RAW = ["1", "2", "3", "4", "5", None, "9", "-1", "n/a", " 4.5 "]
SUPPLIER_ACTIVE_RAW = ["Y", "N", "1", "0"]

# Value patterns.
PATTERN_DATES = [
    ("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "ISO date (YYYY-MM-DD)"),
    ("^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "FR date (DD/MM/YYYY)"),
    ("^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "date (DD-MM-YYYY)"),
    ("^[0-9]{8}$", "compact date (YYYYMMDD)"),
]
PATTERN_BOOL = ["1", "0", "Y", "N", "yes", "no", "true", "false", "A", "I", "active", "inactive"]
PATTERN_STATUS = ["P", "C", "S", "D", "X", "PEND", "CONF", "SHIP", "DELIV", "CANC",
                  "pending", "confirmed", "shipped", "delivered", "cancelled"]
PATTERN_PHONE = r"^[+0-9\s\-()]{7,20}$"

# Staging conversions, as SQL over {c}.
STAGING_SQL = {
    "status_customer": "CASE WHEN {c} IN ('1', 'A', 'active') THEN 'active' ELSE 'inactive' END",
    "status_order": ("CASE WHEN {c} IN ('P', 'PEND', 'pending', '0') THEN 'pending' "
                     "WHEN {c} IN ('C', 'CONF', 'confirmed', '1') THEN 'confirmed' WHEN {c} IN ('S', 'SHIP', 'shipped', '2') THEN 'shipped' "
                     "WHEN {c} IN ('D', 'DELIV', 'delivered', '3') THEN 'delivered' WHEN {c} IN ('X', 'CANC', 'cancelled', '9') THEN 'cancelled' "
                     "ELSE 'pending' END"),
    "bool_product": "CASE WHEN upper({c}) IN ('Y', '1', 'YES', 'TRUE') THEN 1 ELSE 0 END",
    "bool_supplier": "CASE WHEN upper({c}) IN ('Y', '1', 'YES') THEN 1 ELSE 0 END",
    "upper_trim": "upper(trim({c}))",
    "numeric": "try_cast({c} AS DOUBLE)",
}
