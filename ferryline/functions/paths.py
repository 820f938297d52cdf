"""Record extraction by path from JSON text columns.

Supported paths: ``a.b``, ``a[]``, ``a[].b``, ``a[0]``, ``[]`` and the same with
a leading dot (``.a[]``). Anything else is an error.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = re.compile(r'(?:\.?([A-Za-z_][A-Za-z0-9_\-]*)|\."([^"]+)")|\[(\d*)\]')


def parse_path(text: str) -> list:
    """``.data.items[].id`` -> ['data', 'items', None, 'id']; None explodes a
    list and an integer picks one element."""
    body = text.strip()
    steps, at = [], 0
    if body == ".":
        return steps
    while at < len(body):
        found = STEP.match(body, at)
        if not found or found.end() == at:
            raise ValueError(f"unsupported record path {text!r}")
        name = found[1] or found[2]
        if name:
            steps.append(name)
        else:
            steps.append(int(found[3]) if found[3] else None)
        at = found.end()
    return steps


def json_path(steps) -> str:
    out = "$"
    for s in steps:
        out += f"[{s}]" if isinstance(s, int) else f"['{s}']"
    return out


def _segments(steps) -> list[list]:
    """Split the path at every list explosion."""
    parts, current = [], []
    for s in steps:
        if s is None:
            parts.append(current)
            current = []
        else:
            current.append(s)
    parts.append(current)
    return parts


def _no_place(lists: int) -> Column:
    return F.array().cast("array<int>") if lists > 1 else F.lit(0)


def _further(pos: str, index: Column, lists: int) -> Column:
    """The place one list further in."""
    return F.array_append(pos, index.cast("int")) if lists > 1 else index


def extract_variants(df: DataFrame, body: str, path: str, out: str = "record",
                     pos: str | None = "pos") -> DataFrame:
    """One row per record at ``path``; the record is a VARIANT column.

    Each ``[]`` is a lateral explode, so a large page streams its records. ``pos``
    is the place in the list, or with several ``[]`` the array of the places in
    each list from the outermost on, so it orders all records of a body and no
    two have the same.
    """
    *lists, last = _segments(parse_path(path))
    cursor = "__cursor"
    df = df.withColumn(cursor, F.try_parse_json(F.col(body)))
    if pos:
        df = df.withColumn(pos, _no_place(len(lists)))
    for steps in lists:
        source = F.col(cursor) if not steps else F.try_variant_get(
            F.col(cursor), json_path(steps), "variant")
        kept = [c for c in df.columns if c not in (cursor, pos)]
        spark = df.sparkSession
        found = df.withColumn("__list", source).lateralJoin(
            spark.tvf.variant_explode(F.col("__list").outer()).toDF("__pos", "__key", "__item"))
        picks = [F.col(c) for c in kept] + [F.col("__item").alias(cursor)]
        if pos:
            picks.append(_further(pos, F.col("__pos"), len(lists)).alias(pos))
        df = found.select(*picks)
    record = F.col(cursor) if not last else F.try_variant_get(
        F.col(cursor), json_path(last), "variant")
    return df.withColumn(out, record).drop(cursor).where(F.col(out).isNotNull())


_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def _wrapping(steps, kind: T.DataType) -> T.DataType:
    """The type of a body that holds ``kind`` at the path."""
    for s in reversed(steps):
        if s is None or isinstance(s, int):
            kind = T.ArrayType(kind)
        else:
            kind = T.StructType([T.StructField(s, kind)])
    return kind


def typed_records(df: DataFrame, body: str, path: str, schema: T.StructType,
                  out: str = "record", pos: str = "pos") -> DataFrame:
    """The same extraction when the record type is known: the wrapping type is
    built around it and one ``from_json`` parses straight into typed rows."""
    steps = parse_path(path)
    lists = steps.count(None)
    df = df.withColumn(out, F.from_json(F.col(body), _wrapping(steps, schema), _JSON))
    df = df.withColumn(pos, _no_place(lists))
    for s in steps:
        if s is None:
            kept = [F.col(c) for c in df.columns if c not in (out, pos)]
            df = df.select(*kept, pos, F.posexplode(F.col(out)).alias("__at", out)).select(
                *kept, _further(pos, F.col("__at"), lists).alias(pos), out)
        elif isinstance(s, int):
            df = df.withColumn(out, F.get(F.col(out), s))
        else:
            df = df.withColumn(out, F.col(out)[s])
    return df.where(F.col(out).isNotNull())


def record_count(body: Column, path: str, schema: T.StructType | None = None) -> Column:
    """How many records ``typed_records`` finds at ``path`` in one body, with records
    of any type where ``schema`` is not known. Unreadable bodies have none."""
    steps = parse_path(path)

    def count(value: Column, left: list) -> Column:
        if not left:
            return F.when(value.isNotNull(), 1).otherwise(0)
        if left[0] is None:
            return F.coalesce(F.aggregate(
                value, F.lit(0), lambda n, item: n + count(item, left[1:])), F.lit(0))
        return count(F.get(value, left[0]) if isinstance(left[0], int) else value[left[0]],
                     left[1:])

    return count(F.from_json(body, _wrapping(steps, schema or T.VariantType()), _JSON), steps)


def variant_fields(df: DataFrame, record: str, schema: T.StructType, keep=()) -> DataFrame:
    """Columns of a VARIANT record, by name and type; unreadable values are null."""
    fields = [F.try_variant_get(F.col(record), f"$['{f.name}']",
                                f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return df.select(*keep, *fields)


def record_schema(df: DataFrame, record: str) -> T.StructType:
    """Schema of all records of a VARIANT column (a distributed aggregate)."""
    text = df.agg(F.schema_of_variant_agg(F.col(record)).alias("s")).first()["s"]
    if not text or not text.upper().startswith("OBJECT<"):
        return T.StructType([])
    ddl = re.sub(r"\bOBJECT<", "struct<", text)
    return T.DataType.fromDDL(ddl)


def extract_records(df: DataFrame, body: str, path: str, schema: T.StructType | None = None,
                    keep=None) -> DataFrame:
    """Records at ``path`` as ordinary columns. Without ``schema`` the types are
    found first, over all records."""
    kept = [c for c in df.columns if c != body] if keep is None else list(keep)
    if schema is not None:
        rows = typed_records(df, body, path, schema)
        return rows.select(*kept, *[F.col("record")[f.name].alias(f.name) for f in schema.fields])
    found = extract_variants(df, body, path, pos=None)
    return variant_fields(found, "record", record_schema(found, "record"), kept)
