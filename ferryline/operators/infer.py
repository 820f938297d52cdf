"""Type inference for text columns: one aggregate over the whole input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shape import column, quoted, text_columns

# The text each type accepts. Leading zeros and plus signs keep a
# value text, and so do more digits than the type holds.
WHOLE = "^-?(0|[1-9][0-9]*)$"
FRACTION = "^-?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DOUBLE_DIGITS = 15
DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"

# Types in order of preference and the bit that stands for each.
BITS = {
    "boolean": 1,
    "bigint": 2,
    "double": 4,
    "date": 8,
    "timestamp_ntz": 16,
}


def fitting_types(name: str) -> str:
    """SQL for the bits of the types a text value can be read as (null for null).

    Cheap looks at length and single characters pick the one pattern worth
    matching. Numbers keep all their digits: whole ones too long for a bigint and
    fractions too long for a double fit no type, and whole ones too long for a
    double fit bigint only.
    """
    v = quoted(name)
    whole, double = BITS["bigint"] | BITS["double"], BITS["double"]
    fits = (f"length(regexp_replace(split({v}, '[eE]')[0], '[^0-9]', '')) <= {DOUBLE_DIGITS}")
    date, stamp = BITS["date"] | BITS["timestamp_ntz"], BITS["timestamp_ntz"]
    return f"""
        CASE WHEN {v} IS NULL THEN NULL
             WHEN length({v}) BETWEEN 10 AND 26 AND substr({v}, 5, 1) = '-' THEN
                  CASE WHEN length({v}) = 10 THEN
                            IF({v} RLIKE '{DATE}' AND try_cast({v} AS DATE) IS NOT NULL, {date}, 0)
                       WHEN {v} RLIKE '{TIMESTAMP}' AND try_cast({v} AS TIMESTAMP_NTZ) IS NOT NULL
                            THEN {stamp}
                       ELSE 0 END
             WHEN substr({v}, 1, 1) BETWEEN '+' AND '9' THEN
                  CASE WHEN {v} RLIKE '{WHOLE}' THEN
                            IF(try_cast({v} AS BIGINT) IS NULL, 0,
                               IF(length({v}) <= {DOUBLE_DIGITS}, {whole}, {whole - double}))
                       WHEN {v} RLIKE '{FRACTION}' AND {fits} THEN {double}
                       ELSE 0 END
             WHEN length({v}) IN (4, 5) AND lower({v}) IN ('true', 'false') THEN {BITS["boolean"]}
             ELSE 0 END"""


def inference_aggregates(names) -> list[Column]:
    """Per column, the bits every value shares: null when there is no value.

    A task sends one small row however many rows it read.
    """
    return [F.expr(f"bit_and({fitting_types(n)})").alias(n) for n in names]


def type_name(bits: int | None) -> str:
    """Boolean, whole, fractional, date, timestamp, else string; a column with
    no values is a string."""
    if bits is None:
        return "string"
    return next((name for name, bit in BITS.items() if bits & bit), "string")


def infer_types(df: DataFrame, names=None) -> DataFrame:
    """``(column_name, inferred_type)`` for every text column."""
    names = list(names or text_columns(df))
    found = df.agg(*inference_aggregates(names))
    cases = " ".join(f"WHEN bits & {bit} != 0 THEN '{name}'" for name, bit in BITS.items())
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), column(n).alias("bits"))
                      for n in names])
    return found.select(F.inline(pairs)).selectExpr(
        "column_name", f"CASE {cases} ELSE 'string' END AS inferred_type")


def apply_inferred(df: DataFrame, names=None) -> DataFrame:
    """Infer (one pass) and cast. Inference proved every value readable."""
    names = list(text_columns(df) if names is None else names)
    if not names:
        return df
    bits = df.agg(*inference_aggregates(names)).first()
    kinds = {n: type_name(bits[n]) for n in names}
    return df.select(*[
        column(c).cast(kinds[c]).alias(c) if kinds.get(c, "string") != "string" else quoted(c)
        for c in df.columns])
