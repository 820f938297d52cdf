"""Schema conformity: adding columns, widening types, target typing rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shape import column, quoted, spark_type

# Number types from narrow to wide.
WHOLE = ["tinyint", "smallint", "int", "bigint"]


def _is(kind: T.DataType, *classes) -> bool:
    return isinstance(kind, classes)


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest type that holds both: whole -> decimal/double -> string."""
    if left == right:
        return left
    a, b = left.simpleString(), right.simpleString()
    if a == "void":
        return right
    if b == "void":
        return left
    if a in WHOLE and b in WHOLE:
        return left if WHOLE.index(a) > WHOLE.index(b) else right
    if _is(left, T.DecimalType) or _is(right, T.DecimalType):
        return _with_decimal(left, right)
    fractional = (T.FloatType, T.DoubleType)
    if (_is(left, *fractional) or a in WHOLE) and (_is(right, *fractional) or b in WHOLE):
        return T.DoubleType()
    dates = {"date", "timestamp", "timestamp_ntz"}
    if a in dates and b in dates:
        return T.TimestampType() if "timestamp" in (a, b) else T.TimestampNTZType()
    return T.StringType()


def _with_decimal(left: T.DataType, right: T.DataType) -> T.DataType:
    digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}

    def parts(kind):
        if isinstance(kind, T.DecimalType):
            return kind.precision - kind.scale, kind.scale
        whole = digits.get(kind.simpleString())
        return None if whole is None else (whole, 0)

    one, two = parts(left), parts(right)
    if one is None or two is None:
        floats = (T.FloatType, T.DoubleType)
        return T.DoubleType() if _is(left, *floats) or _is(right, *floats) else T.StringType()
    whole, scale = max(one[0], two[0]), max(one[1], two[1])
    if whole + scale > 38:
        return T.StringType()
    return T.DecimalType(whole + scale, scale)


def as_type(value, source: T.DataType, kind: T.DataType):
    if source == kind:
        return value
    if isinstance(kind, T.StringType) and isinstance(
            source, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(kind)


def conform(df: DataFrame, schema: T.StructType, add_new_columns: bool = False) -> DataFrame:
    """Give ``df`` the target's columns, order and types: absent columns become
    null, extra columns are an error unless the target may grow."""
    names = [f.name for f in schema.fields]
    extra = [c for c in df.columns if c not in names]
    if extra and not add_new_columns:
        raise ValueError(f"columns not in the target: {extra} (set add_new_columns)")
    fields = []
    for f in schema.fields:
        have = df.schema[f.name].dataType if f.name in df.columns else None
        if have == f.dataType:
            fields.append(quoted(f.name))
        elif have is not None:
            fields.append(as_type(column(f.name), have, f.dataType).alias(f.name))
        else:
            fields.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*fields, *[quoted(c) for c in extra])


def evolved_schema(target: T.StructType, source: T.StructType, add_new_columns: bool = False,
                   adjust_column_type: bool = False) -> T.StructType:
    """The target schema after a load, under the two evolution switches."""
    incoming = {f.name: f.dataType for f in source.fields}
    fields = []
    for f in target.fields:
        kind = f.dataType
        if adjust_column_type and f.name in incoming:
            kind = common_type(kind, incoming[f.name])
        fields.append(T.StructField(f.name, kind, True))
    if add_new_columns:
        have = {f.name for f in target.fields}
        fields += [T.StructField(f.name, f.dataType, True)
                   for f in source.fields if f.name not in have]
    return T.StructType(fields)


def union_evolving(target: DataFrame, source: DataFrame, add_new_columns: bool = True,
                   adjust_column_type: bool = True) -> DataFrame:
    """Target rows, then source rows, under the evolved schema."""
    schema = evolved_schema(target.schema, source.schema, add_new_columns, adjust_column_type)
    return conform(target, schema).unionByName(conform(source, schema))


def apply_typing(df: DataFrame, rules: dict) -> DataFrame:
    """Target typing: a rule per source type name, e.g. ``{"double": "decimal(18,2)"}``.

    ``decimal`` and ``string`` match every precision or length of that family.
    """
    wanted = {k.strip().lower(): v for k, v in rules.items()}
    casts = {}
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        rule = wanted.get(name, wanted.get(name.split("(")[0]))
        if rule:
            casts[f.name] = column(f.name).cast(spark_type(rule))
    return df.withColumns(casts) if casts else df
