"""The JSON landing zone: one object per line."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantry.schema import CORRUPT_RECORD, EXTRA_FIELDS, PARSED, TELEMETRY
from gantry.sources.scratch import stored

_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}
_DOC = "_doc"


def _parsed(lines: DataFrame) -> DataFrame:
    """Each line that is not blank (``value``) and what it says, as a variant; NULL if it is no JSON."""
    written = lines.where(F.trim(F.col("value")) != "")
    return written.select("value", F.try_parse_json("value").alias(_DOC))


def _may_hold_more(row: Column) -> Column:
    """False where a line surely has no fields but the known ones in ``row``.

    Every field has a quote and a colon after its name, with nothing between them unless the
    line has white space there; so if there are as many of these as known values, no other
    field is there. All other lines are looked into.
    """
    line = F.col("value")
    twice_the_names = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('":')))
    known = reduce(add, [row[name].isNotNull().cast("int") for name in TELEMETRY.fieldNames()])
    spaced = F.contains(line, F.lit('" ')) | F.contains(line, F.lit('"\t'))
    return row.isNull() | (twice_the_names != known * 2) | spaced


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines of JSON text (column ``value``) as rows of the fixed schema; blank lines are none.

    A field that cannot be read is NULL and the raw line is kept beside it. Fields the schema
    does not name are kept, as texts, in one JSON object. Only lines that may have any are
    parsed for them, into a variant; what a variant refuses (``NaN``, repeated names) is read
    leniently.
    """
    names = TELEMETRY.fieldNames()
    rows = lines.where(F.trim(F.col("value")) != "").select("value", F.from_json("value", PARSED, _OPTIONS).alias("row"))
    members = F.expr("try_cast(try_parse_json(value) AS MAP<STRING, VARIANT>)")
    texts = F.coalesce(F.transform_values(members, lambda _, v: v.cast("string")), F.from_json("value", "map<string,string>"))
    extra = F.when(_may_hold_more(F.col("row")), F.map_filter(texts, lambda name, _: ~name.isin(*names)))
    found = rows.select("row.*", extra.alias("extra"))
    return found.select(*PARSED.fieldNames(), F.when(F.size("extra") > 0, F.to_json("extra")).alias(EXTRA_FIELDS))


def _inferred(kind: T.DataType) -> T.DataType:
    """A column type from one that a variant's values have in common.

    Decimals are doubles, as JSON has one kind of number; what has no type, or several, is text.
    """
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _inferred(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_inferred(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def _read_inferred(lines: DataFrame) -> DataFrame:
    """Lines as rows whose names and types all lines together decide.

    The text is parsed once, into a stored table of variants; their schemas are merged by an
    aggregate that combines before the shuffle.
    """
    docs = stored(_parsed(lines))
    objects = F.when(F.expr(f"try_cast({_DOC} AS MAP<STRING, VARIANT>)").isNotNull(), F.col(_DOC))
    merged = docs.agg(F.schema_of_variant_agg(objects).alias("schema")).first().schema or ""
    if not merged.startswith("OBJECT<"):
        return docs.select(F.col("value").alias(CORRUPT_RECORD))
    found = T._parse_datatype_string(re.sub(r"\bOBJECT<", "STRUCT<", merged))
    row = F.try_variant_get(_DOC, "$", _inferred(found).simpleString())
    rows = docs.select(row.alias("row"), F.when(objects.isNull(), F.col("value")).alias(CORRUPT_RECORD))
    return rows.select("row.*", CORRUPT_RECORD)


def read_landing(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Landing files as rows.

    The fixed schema saves the extra pass that inference makes over all lines and
    keeps a stray text value from turning a measure into a string column.
    ``infer=True`` takes column names and types from the files instead; the column of
    raw malformed lines is there in either case.
    """
    lines = spark.read.text(path)
    return _read_inferred(lines) if infer else parse_lines(lines)


def write_landing(df: DataFrame, path: str) -> None:
    """Replace a landing folder. NULL fields are left out of the objects."""
    df.write.mode("overwrite").json(path)
