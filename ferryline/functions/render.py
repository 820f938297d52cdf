"""Text contracts of query results, as column expressions.

JSON rows: decimals and booleans become text, dates and times ISO text ending in
``Z``; numbers stay numbers. CSV rows: every value is text, times are written
``yyyy-MM-dd HH:mm:ss +00``. Nested values are JSON text in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shape import column

TIMES = (T.TimestampType, T.TimestampNTZType)
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def _clock(value: Column, separator: str, zone: str) -> Column:
    """Seconds, then a fraction only when there is one."""
    seconds = F.date_format(value, f"yyyy-MM-dd{separator}HH:mm:ss")
    fraction = F.rtrim(F.date_format(value, "SSSSSS"), F.lit("0"))
    dotted = F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction))
    return F.concat(seconds, dotted, F.lit(zone))


def json_value(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DecimalType, T.BooleanType)):
        return value.cast("string")
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd'T'00:00:00'Z'")
    if isinstance(kind, TIMES):
        return _clock(value, "'T'", "Z")
    if isinstance(kind, NESTED):
        return F.to_json(value)
    return value


def csv_value(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, TIMES):
        return _clock(value, " ", " +00")
    if isinstance(kind, NESTED):
        return F.to_json(value)
    return value.cast("string")


def render_json(df: DataFrame) -> DataFrame:
    return df.select(*[json_value(column(f.name), f.dataType).alias(f.name)
                       for f in df.schema.fields])


def render_csv(df: DataFrame) -> DataFrame:
    return df.select(*[csv_value(column(f.name), f.dataType).alias(f.name)
                       for f in df.schema.fields])


def csv_lines(df: DataFrame, delimiter: str = ",", name: str = "line") -> DataFrame:
    """One quoted CSV line per row; values holding the delimiter, a quote or a
    line break are quoted and inner quotes doubled."""
    text = render_csv(df)
    special = f'[{chr(92)}{delimiter}"\\r\\n]'
    fields = []
    for c in text.columns:
        v = column(c)
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        fields.append(F.coalesce(F.when(v.rlike(special), quoted).otherwise(v), F.lit("")))
    return text.select(F.concat_ws(delimiter, *fields).alias(name))
