"""CSV extracts that give back what was written (K-4), and the reader of others' (S-1).

The extract's dialect: UTF-8, a header, every field quoted, quotes doubled, line feed
ends a record, line feeds and white space inside a field kept. A null is ``\\N``; a text
that begins with a backslash gets one more in front, so no text can look like a
null; an empty text is an empty field. Values that are no texts are written in Spark's text
form, from which a cast gives the same value. A quoted line feed makes a file one read task:
``rows_per_file`` bounds the size of each.

Other programs' extracts have minimal quotes as a rule: there an empty field
without quotes is null and one with quotes an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = "\\N"
UNMET = "\x01null\x01"  # stands for nothing: Spark's reader must have a text for null
DIALECT = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
           "ignoreTrailingWhiteSpace": False, "nullValue": UNMET, "emptyValue": ""}
ROWS_PER_FILE = 1_000_000
PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
         T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _encoded(f: T.StructField) -> Column:
    text = F.col(f"`{f.name}`").cast("string")
    if isinstance(f.dataType, T.StringType):
        text = F.when(text.startswith("\\"), F.concat(F.lit("\\"), text)).otherwise(text)
    return F.coalesce(text, F.lit(NULL)).alias(f.name)


def _decoded(f: T.StructField) -> Column:
    raw = F.col(f"`{f.name}`")
    text = F.when(raw == NULL, F.lit(None)).otherwise(raw)
    if isinstance(f.dataType, T.StringType):
        text = F.when(raw == NULL, F.lit(None)).when(raw.startswith("\\"), F.substr(raw, F.lit(2))).otherwise(raw)
    return text.cast(f.dataType).alias(f.name)


def write_extract(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """K-4: the frame as an extract. Columns of other than plain types are refused."""
    odd = [f.name for f in df.schema.fields if not isinstance(f.dataType, PLAIN)]
    if odd:
        raise TypeError(f"no CSV form for columns {', '.join(odd)}")
    df.select(*[_encoded(f) for f in df.schema.fields]).write.mode("overwrite").options(**DIALECT).option(
        "quoteAll", True).option("lineSep", "\n").option("maxRecordsPerFile", rows_per_file).csv(path)


def read_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An extract of this dialect, with the types it had; a value that is none fails the job."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(texts).options(**DIALECT).option("multiLine", True).option("lineSep", "\n").option(
        "mode", "FAILFAST").option("enforceSchema", False).csv(path)
    return raw.select(*[_decoded(f) for f in schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """S-1 for other programs' extracts: header row (its names are checked), explicit
    schema (no inference pass), line feeds and white space in fields kept. A record
    that does not fit fails the job unless ``mode`` says otherwise."""
    return spark.read.schema(schema).options(**DIALECT).option("multiLine", True).option("enforceSchema", False).option("mode", mode).csv(path)
