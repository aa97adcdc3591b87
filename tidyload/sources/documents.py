"""JSON documents (mapping documents S-6, quality reports S-7, result documents K-5).

A document is an object of its own file, indented or not, or one of several in a
file: one a line, or in an array. Documents are metadata, so a file is read as one
row; whatever its layout, its text is parsed as the elements of one array, which
leaves no rest unread. A file that does not parse, whose types differ, or that
lacks a required field fails the job with the file's name. Nothing is read as null in silence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _elements(text: Column) -> list[Column]:
    """The readings of a file's text, first one that parses counts: an array, objects
    one a line, a single object."""
    lines = F.array_join(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), ",\n")
    return [F.when(text.rlike(r"^\s*\["), text), F.concat(F.lit("["), text, F.lit("]")), F.concat(F.lit("["), lines, F.lit("]"))]


def read_documents(spark: SparkSession, path: str, schema: T.StructType, required: list[str]) -> DataFrame:
    """All documents under ``path`` (a file or a folder, partition folders included)
    with ``schema`` and the column ``file``; each must have the ``required`` fields
    (``a|b``: one of them)."""
    whole = T.StructType([T.StructField("documents", T.ArrayType(schema)), T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")
    readings = [F.from_json(F.concat(F.lit('{"documents":'), t, F.lit("}")), whole, options) for t in _elements(F.col("value"))]
    parsed = texts.select("file", F.array(*readings).alias("readings")).select(
        "file", F.get(F.filter("readings", lambda r: r[CORRUPT].isNull() & r["documents"].isNotNull()), F.lit(0))["documents"].alias("documents"))
    corrupt = F.raise_error(F.concat(F.lit("corrupt document: "), "file"))
    each = parsed.select("file", F.explode(F.when(F.col("documents").isNull(), corrupt).otherwise(F.col("documents"))).alias("d"))

    def has(d: Column) -> Column:
        out = d.isNotNull()
        for field in required:
            out &= reduce(lambda a, b: a | b, [d[f].isNotNull() for f in field.split("|")])
        return out

    foreign = F.raise_error(F.concat(F.lit(f"not a document with {', '.join(required)}: "), "file"))
    return each.select("file", F.when(has(F.col("d")), F.col("d")).otherwise(foreign).alias("d")).select("file", "d.*")


def documents_or_none(spark: SparkSession, path: str, schema: T.StructType, required: list[str]) -> DataFrame:
    """As ``read_documents``; a path that does not exist holds no documents."""
    try:
        return read_documents(spark, path, schema, required)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([T.StructField("file", T.StringType()), *schema.fields]))


def write_documents(docs: DataFrame, path: str, key: str = "table", indent: bool = False) -> DataFrame:
    """K-5: one JSON document per row, in a folder of its own by ``key``, indented or
    as a line; read back with the same schema (a frame without rows reads back as one)."""
    if indent:
        body = F.to_json(F.struct(*docs.columns), {"pretty": "true", "ignoreNullFields": "false"})
        docs.select(body.alias("value"), F.col(key).alias("document")).write.mode("overwrite").partitionBy("document").text(path)
    else:
        docs.withColumn("document", F.col(key)).write.mode("overwrite").partitionBy("document").json(path)
    return read_documents(docs.sparkSession, path, docs.schema, [key]).select(*docs.columns)
