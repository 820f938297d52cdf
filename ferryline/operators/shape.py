"""Projection, filter, cast, transform and renaming operators.

All of these are single projections or filters of built-in expressions, so they
stay in one code-generated stage with the scan and leave push-down to Catalyst.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import as_list, as_mapping
from ..functions.transforms import transform_column

FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_columns(df: DataFrame, select, ignore_unknown: bool = False, also=()) -> DataFrame:
    """Pick columns by name, ``*`` or ``expression as alias``.

    ``ignore_unknown`` drops names the input does not have (the rule for
    in-memory rows); selecting nothing but unknown names is an error. Columns
    in ``also`` are kept whether selected or not.
    """
    items = as_list(select) if not isinstance(select, str) else split_top_level(select)
    if not items:
        return df
    if ignore_unknown:
        known = [i for i in items if i in df.columns]
        if not known:
            raise ValueError(f"none of the selected columns exist: {items}")
        items = known
    if "*" not in items:
        items = items + [c for c in also if c not in items]
    return df.select(*[column(i) if i in df.columns else F.expr(i) for i in items])


def split_top_level(text: str) -> list[str]:
    """Split ``a, f(b, c) as d`` on the commas outside brackets and quotes."""
    parts, depth, quote, start = [], 0, None, 0
    for i, ch in enumerate(text):
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    parts.append(text[start:])
    return [p.strip() for p in parts if p.strip()]


def spark_type(name: str) -> str:
    """Configuration type name -> Spark SQL type name."""
    # Spellings users write for types Spark names otherwise.
    spellings = {
        "text": "string", "varchar": "string", "json": "string",
        "integer": "int", "int64": "bigint", "int32": "int", "long": "bigint",
        "number": "double", "float64": "double", "float": "double",
        "bool": "boolean", "datetime": "timestamp_ntz", "timestamp": "timestamp_ntz",
        "timestampz": "timestamp", "timestamptz": "timestamp",
    }
    base = name.strip().lower()
    return spellings.get(base, base)


def cast_columns(df: DataFrame, types, strict: bool = False) -> DataFrame:
    """Cast the named columns and keep all others.

    Values that cannot be read become null; ``strict`` raises instead.
    """
    wanted = as_mapping(types) or {}
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns to cast do not exist: {missing}")
    casts = {
        c: column(c).cast(spark_type(t)) if strict else column(c).try_cast(spark_type(t))
        for c, t in wanted.items()
    }
    return df.withColumns(casts) if casts else df


def cast_failures(df: DataFrame, types) -> Column:
    """Aggregate expression: how many values a lenient cast turns into null."""
    wanted = as_mapping(types) or {}
    bad = [
        (column(c).isNotNull() & column(c).try_cast(spark_type(t)).isNull()).cast("bigint")
        for c, t in wanted.items() if c in df.columns
    ]
    total = reduce(lambda a, b: a + b, bad) if bad else F.lit(0).cast("bigint")
    return F.coalesce(F.sum(total), F.lit(0))


def apply_transforms(df: DataFrame, transforms) -> DataFrame:
    """Apply transforms in order: a list covers every text column, a mapping
    names its columns (``*`` again meaning every text column)."""
    spec = as_mapping(transforms)
    if not spec:
        return df
    if isinstance(spec, list):
        plain = [t for t in spec if not isinstance(t, dict)]
        steps = [("*", plain)] if plain else []
        steps += [item for t in spec if isinstance(t, dict) for item in t.items()]
    else:
        steps = list(spec.items())
    for target, names in steps:
        columns = text_columns(df) if target == "*" else [target]
        for name in columns:
            for transform in as_list([names] if isinstance(names, str) else names):
                df = transform_column(df, name, transform)
    return df


#: Rows up to which a limited order is left to Spark's top-k, which one task ends.
TOP_ROWS = 10_000


def limit_offset(df: DataFrame, limit: int | None = None, offset: int | None = None,
                 order_by=None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the order of ``order_by``: names, each
    optionally followed by ``desc``. Without an order an offset follows the order of
    all columns, so that pages neither overlap nor leave gaps, and a limit takes any
    rows."""
    offset = int(offset or 0)
    if not offset and limit is None:
        return df if order_by is None else df.orderBy(*_order(df, order_by))
    if not offset and order_by is None:
        return df.limit(int(limit))
    order = _order(df, order_by)
    if limit is not None and offset + int(limit) <= TOP_ROWS:
        return df.orderBy(*order).offset(offset).limit(int(limit))
    return ordered_slice(df, order, offset, limit)


def _order(df: DataFrame, order_by) -> list[Column]:
    """The named order, then all other columns that can be ordered, so that only
    equal rows tie."""
    order, named = [], set()
    for part in as_list(order_by):
        name, _, way = part.rpartition(" ") if part.lower().endswith((" asc", " desc")) \
            else (part, "", "asc")
        named.add(name.strip())
        order.append(column(name.strip()).desc() if way.lower() == "desc" else column(name.strip()))
    return order + [column(f.name) for f in df.schema.fields if f.name not in named
                    and not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _place(counts, wanted: int) -> int | None:
    """The number that row ``wanted`` of the order got; None beyond the last row."""
    for row in counts:
        if wanted < row["n"]:
            return (row["r"] << 33) + wanted
        wanted -= row["n"]
    return None


def ordered_slice(df: DataFrame, order: list[Column], offset: int, limit: int | None) -> DataFrame:
    """A slice of an order, cut by many tasks. Rows are sorted by ranges and numbered
    within them; the ranges' counts, one row each, say where the slice begins and
    ends, and both are literals that the copy's row groups are skipped by."""
    from ..plans.targets import stage

    at = "__slice_at"
    placed = stage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn(at, F.monotonically_increasing_id()), "ordered")
    counts = placed.groupBy(F.shiftright(at, 33).alias("r")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("r").collect()
    first = _place(counts, offset)
    after = None if limit is None else _place(counts, offset + int(limit))
    if first is None:
        return placed.where(F.lit(False)).drop(at)
    kept = placed.where(F.col(at) >= first)
    return (kept if after is None else kept.where(F.col(at) < after)).drop(at)


def exec_limit(df: DataFrame, limit: int | None) -> DataFrame:
    """Query results: unset means 100 rows, 0 means all of them."""
    if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int) or limit < 0):
        raise ValueError(f"limit counts rows; {limit!r} is no such count")
    if limit == 0:
        return df
    return df.limit(100 if limit is None else limit)


def range_bounds(text: str) -> tuple[str, str]:
    start, sep, end = text.partition("..")
    if not sep or not start.strip() or not end.strip():
        raise ValueError(f"range must be written start..end, got {text!r}")
    return start.strip(), end.strip()


DATE_ONLY = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def range_filter(df: DataFrame, update_key: str, text: str) -> DataFrame:
    """Keep rows with ``update_key`` in ``start..end``, both ends included; an
    end given as a date covers that whole day. Both bounds are cast literals,
    so they reach the scan."""
    start, end = range_bounds(text)
    kind = df.schema[update_key].dataType
    key = column(update_key)
    lower = key >= F.lit(start).cast(kind)
    if DATE_ONLY.match(end) and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        next_day = F.date_add(F.lit(end).cast("date"), 1).cast(kind)
        return df.where(lower & (key < next_day))
    return df.where(lower & (key <= F.lit(end).cast(kind)))


# -- source parse options as expressions -----------------------------------


def null_if(df: DataFrame, value: str) -> DataFrame:
    return df.withColumns({c: F.nullif(column(c), F.lit(value)) for c in text_columns(df)})


def empty_as_null(df: DataFrame) -> DataFrame:
    return null_if(df, "")


def trim_space(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(column(c)) for c in text_columns(df)})


def skip_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every text column is null or blank."""
    blank = [F.coalesce(F.trim(column(c)) == "", F.lit(True)) if c in text_columns(df)
             else column(c).isNull() for c in df.columns]
    return df.where(~reduce(lambda a, b: a & b, blank))


def max_decimals(df: DataFrame, digits: int) -> DataFrame:
    rounded = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, FRACTIONAL):
            rounded[f.name] = F.round(column(f.name), int(digits)).cast(f.dataType)
    return df.withColumns(rounded) if rounded else df


def parse_datetimes(df: DataFrame, pattern: str, names) -> DataFrame:
    """Read the named text columns as timestamps written in ``pattern``."""
    fmt = F.lit(pattern)
    return df.withColumns({
        c: F.try_to_timestamp(column(c), fmt).cast("timestamp_ntz") for c in as_list(names)
    })


def flatten(df: DataFrame, separator: str = "__") -> DataFrame:
    """Structs become ``parent__child`` columns; arrays and maps become JSON text."""

    def leaves(kind, name, value):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from leaves(f.dataType, f"{name}{separator}{f.name}" if name else f.name,
                                  value[f.name] if value is not None else column(f.name))
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            yield F.to_json(value).alias(name)
        else:
            yield value.alias(name)

    flat = df.select(*leaves(df.schema, "", None))
    require_unique_names(flat.columns, "flatten")
    return flat


# -- column names ------------------------------------------------------------


def words(name: str) -> list[str]:
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name)
    spaced = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1 \2", spaced)
    return [w for w in re.split(r"[^A-Za-z0-9]+", spaced) if w]


def cased(name: str, casing: str) -> str:
    kind = casing.lower()
    if kind == "upper":
        return name.upper()
    if kind == "lower":
        return name.lower()
    if kind == "source":
        return name
    parts = [w.lower() for w in words(name)]
    if kind == "snake":
        return "_".join(parts)
    if kind == "camel":
        return "".join(p if i == 0 else p.capitalize() for i, p in enumerate(parts))
    raise ValueError(f"unknown column casing {casing!r}")


def require_unique_names(names, operation: str) -> None:
    doubles = sorted(n for n, c in Counter(n.lower() for n in names).items() if c > 1)
    if doubles:
        raise ValueError(f"{operation} gives several columns the same name: {doubles}")


def column_casing(df: DataFrame, casing: str) -> DataFrame:
    renamed = [cased(c, casing) for c in df.columns]
    require_unique_names(renamed, "column casing")
    return df.toDF(*renamed)


# -- metadata columns ----------------------------------------------------------


def with_stream_url(df: DataFrame, name: str = "_stream_url") -> DataFrame:
    """Add the file each row came from; valid directly on a file scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def with_loaded_at(df: DataFrame, loaded_at, name: str = "_loaded_at") -> DataFrame:
    """Add one literal run time, the same for every row of the run."""
    return df.withColumn(name, F.lit(str(loaded_at)).cast("timestamp_ntz"))
