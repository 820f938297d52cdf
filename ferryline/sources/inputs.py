"""In-memory input: lists of dicts, generators, pandas, Arrow and similar tables."""

from __future__ import annotations

import datetime
import decimal
import itertools
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.schema import conform
from ..session import scratch_path

CHUNK_ROWS = 100_000

# Inferred kind -> Spark type.
KINDS = {
    "bool": T.BooleanType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


def kind_of(value) -> str | None:
    """Kind of one value; None for nulls. Decimals, lists and dicts are text."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int" if -2**63 <= value < 2**63 else "string"
    if isinstance(value, float):
        return "float"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    if isinstance(value, datetime.date):
        return "date"
    return "string"


def widen(one: str | None, two: str | None) -> str | None:
    """The kind that holds both: int and float mix to float, dates and
    timestamps to timestamp, anything else to text."""
    if one is None or two is None or one == two:
        return one or two
    pair = {one, two}
    if pair == {"int", "float"}:
        return "float"
    if pair == {"date", "timestamp"}:
        return "timestamp"
    return "string"


def infer_kinds(rows: Iterable[dict], start: dict | None = None) -> dict[str, str | None]:
    """Kinds per column over all rows; later rows may widen or add columns."""
    kinds = dict(start or {})
    for row in rows:
        for name, value in row.items():
            kinds[name] = widen(kinds.get(name), kind_of(value))
    return kinds


def schema_of(kinds: dict) -> T.StructType:
    return T.StructType([T.StructField(n, KINDS[kinds[n] or "string"]) for n in sorted(kinds)])


def as_text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (list, dict, tuple)):
        return json.dumps(value, default=str)
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return str(value)


def _coerce(value, kind: str):
    if value is None:
        return None
    if kind == "string":
        return as_text(value)
    if kind == "float":
        return float(value)
    if kind == "timestamp":
        if not isinstance(value, datetime.datetime):
            return datetime.datetime(value.year, value.month, value.day)
        if value.tzinfo:
            return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def rows_to_frame(spark: SparkSession, rows: list[dict], kinds: dict | None = None) -> DataFrame:
    kinds = kinds or infer_kinds(rows)
    schema = schema_of(kinds)
    if not schema.fields:
        schema = T.StructType([T.StructField("column1", T.StringType())])
        return spark.createDataFrame([], schema)
    columns = {n: [_coerce(r.get(n), kinds[n] or "string") for r in rows] for n in schema.names}
    # Inferred kind -> Arrow type.
    arrow = {"bool": pa.bool_(), "int": pa.int64(), "float": pa.float64(),
             "timestamp": pa.timestamp("us"), "date": pa.date32(), "string": pa.string()}
    table = pa.table({n: pa.array(v, arrow[kinds[n] or "string"]) for n, v in columns.items()})
    return spark.createDataFrame(table, schema)


def iterator_to_frame(spark: SparkSession, rows: Iterator[dict]) -> DataFrame:
    """Drain an iterator in chunks. Past the first chunk, each chunk is written
    to the shared folder, so the driver never holds more than one."""
    first = list(itertools.islice(rows, CHUNK_ROWS))
    following = list(itertools.islice(rows, CHUNK_ROWS))
    if not following:
        return rows_to_frame(spark, first)
    root, kinds, parts = scratch_path(spark, "input"), {}, []
    chunks = itertools.chain([first, following], iter(
        lambda: list(itertools.islice(rows, CHUNK_ROWS)), []))
    for i, chunk in enumerate(chunks):
        own = infer_kinds(chunk)
        kinds = {n: widen(kinds.get(n), own.get(n)) for n in {**kinds, **own}}
        path = f"{root}/chunk={i}"
        rows_to_frame(spark, chunk, own).write.parquet(path)
        parts.append((path, own))
    schema = schema_of(kinds)
    # Chunks that inferred the same types are one scan; types differ rarely.
    groups: dict[tuple, list[str]] = {}
    for path, own in parts:
        groups.setdefault(tuple(sorted(own.items(), key=lambda p: p[0])), []).append(path)
    frames = [conform(spark.read.schema(schema_of(dict(own))).parquet(*paths), schema)
              for own, paths in groups.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def input_frame(spark: SparkSession, data, select=None) -> DataFrame:
    """Any accepted in-memory input as a DataFrame. Text ``\\N`` stands for null."""
    from ..operators.shape import null_if, select_columns

    if isinstance(data, DataFrame):
        df = data
    elif isinstance(data, pa.Table):
        df = spark.createDataFrame(data)
    elif hasattr(data, "to_arrow"):
        df = spark.createDataFrame(data.to_arrow())
    elif type(data).__module__.split(".")[0] == "pandas":
        df = spark.createDataFrame(pa.Table.from_pandas(data, preserve_index=False))
    elif isinstance(data, list):
        df = rows_to_frame(spark, data)
    elif isinstance(data, Iterable):
        df = iterator_to_frame(spark, iter(data))
    else:
        raise TypeError(f"cannot read input of type {type(data).__name__}")
    df = null_if(df, "\\N")
    return select_columns(df, select, ignore_unknown=True) if select else df


#: Keys that become columns; a table with more keeps the rest in one VARIANT column.
KEY_COLUMNS = 2_000
REST = "_rest"


def ragged_records(df: DataFrame, body: str, names, rest: bool = False) -> DataFrame:
    """JSON objects with differing keys -> the ``names`` among their keys as text
    columns, absent keys null. With ``rest`` all other keys of a record are one
    VARIANT object (null if there are none)."""
    kind = T.MapType(T.StringType(), T.StringType())
    parsed = df.withColumn("__map", F.from_json(F.col(body), kind))
    columns = [F.try_element_at("__map", F.lit(n)).alias(n) for n in names]
    if not rest:
        return parsed.select(*columns)
    own = F.split(F.lit("\x00".join(names)), "\x00")  # one literal, however many names
    others = F.map_filter("__map", lambda k, v: ~F.array_contains(own, k))
    left = F.when(F.size(others) > 0, F.try_parse_json(F.to_json(others)))
    return parsed.select(*columns, left.alias(REST))


def record_keys(df: DataFrame, body: str, most: int = KEY_COLUMNS) -> list[str]:
    """The keys of the records, or the ``most`` frequent of them; in their order."""
    return frequent_keys(df, body, most)[0]


def frequent_keys(df: DataFrame, body: str, most: int = KEY_COLUMNS) -> tuple[list[str], bool]:
    """The ``most`` frequent keys, and whether there are more. Keys are counted by
    Spark; no more than ``most`` and one of them reach the driver."""
    keys = df.select(F.explode(F.json_object_keys(F.col(body))).alias("k")).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"))
    found = [r["k"] for r in keys.orderBy(F.desc("n"), "k").limit(most + 1).collect()]
    return sorted(found[:most]), len(found) > most


def ragged_frame(df: DataFrame, body: str, most: int = KEY_COLUMNS) -> DataFrame:
    """All records of a text column as columns, whatever keys they have."""
    names, more = frequent_keys(df, body, most)
    return ragged_records(df, body, names, rest=more)
