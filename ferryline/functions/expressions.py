"""The scalar functions used in extract expressions, as Spark columns.

Users write Spark SQL over the struct columns ``record``, ``state`` and
``response``. Most names they need are Spark built-ins already; the helpers
here cover the spellings Spark lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Strftime directive -> Spark pattern letters.
STRFTIME = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
}


def spark_pattern(strftime: str) -> str:
    """``%Y-%m-%dT%H:%M:%SZ`` -> ``yyyy-MM-dd'T'HH:mm:ss'Z'``."""
    out, i = "", 0
    while i < len(strftime):
        token = strftime[i:i + 2]
        if token in STRFTIME:
            out, i = out + STRFTIME[token], i + 2
        elif token.startswith("%"):
            raise ValueError(f"unsupported date directive {token!r}")
        else:
            ch = strftime[i]
            out, i = out + (f"'{ch}'" if ch.isalpha() else "''" if ch == "'" else ch), i + 1
    return out


def date_parse(value: Column, pattern: str | None = None) -> Column:
    """Text to timestamp; unreadable text gives null."""
    if pattern is None:
        return F.try_to_timestamp(value).cast("timestamp_ntz")
    fmt = F.lit(spark_pattern(pattern) if "%" in pattern else pattern)
    return F.try_to_timestamp(value, fmt).cast("timestamp_ntz")


def date_add(value: Column, amount: int, unit: str = "day") -> Column:
    return F.timestamp_add(unit.upper(), F.lit(int(amount)), value)


def date_format(value: Column, strftime: str) -> Column:
    return F.date_format(value, spark_pattern(strftime))


def is_null(value: Column) -> Column:
    return value.isNull()


def list_length(value: Column) -> Column:
    return F.size(value)


def require(value: Column, message: str) -> Column:
    """The value, or a failed task with ``message`` when it is null."""
    return F.when(value.isNull(), F.raise_error(F.lit(message))).otherwise(value)


def register_functions(spark: SparkSession) -> None:
    """Make ``date_parse``, ``is_null`` and ``require`` usable in SQL text.

    They are SQL functions: Catalyst inlines their bodies, nothing runs in Python.
    """
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION date_parse(x STRING) RETURNS TIMESTAMP_NTZ "
              "RETURN CAST(try_to_timestamp(x) AS TIMESTAMP_NTZ)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION is_null(x STRING) RETURNS BOOLEAN "
              "RETURN x IS NULL")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION require(x STRING, message STRING) "
              "RETURNS STRING RETURN CASE WHEN x IS NULL THEN raise_error(message) ELSE x END")
