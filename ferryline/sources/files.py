"""File readers: one entry point that maps source options to Spark readers.

Text sources are read as text columns first; the parse options are then plain
column expressions over the scan, and type inference is one aggregate pass.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SourceOptions, as_mapping
from ..enums import plain
from ..errors import UnsupportedError
from ..functions import delimited
from ..functions.paths import extract_records
from ..operators import shape
from ..operators.infer import apply_inferred
from ..sinks.files import compression_of, format_of
from . import archives
from .quoted import read_quoted


def read_files(spark: SparkSession, paths, options: SourceOptions | dict | None = None,
               infer: bool | None = None, on_malformed: str = "pad",
               schema=None, stream_url: bool = False, columns=None, untyped=(),
               multi_line: bool | None = None) -> DataFrame:
    """Read one path, glob or list of paths with the given source options.

    ``infer`` types the text columns of csv, xlsx and zip files (default on);
    columns named in ``columns`` are cast to the named type and not inspected,
    so naming all of them saves the pass; those in ``untyped`` stay text for the
    caller. ``on_malformed`` is ``pad`` (short rows padded, long rows cut),
    ``skip`` or ``fail``. ``multi_line`` says whether quoted csv values may hold
    line breaks; left out, one scan finds out.
    """
    options = SourceOptions.from_dict(options)
    paths = [paths] if isinstance(paths, str) else list(paths)
    fmt = plain(options.format) or format_of(paths[0])
    codec = compression_of(paths[0], options.compression)
    if fmt is None:
        fmt = "csv" if codec == "zip" else "parquet"
    named = as_mapping(columns if columns is not None else options.columns) or {}

    df, text = _scan(spark, paths, fmt, codec, options, on_malformed, schema, stream_url,
                     multi_line)
    if text:
        df = parse_text(df, options)
        if infer is not False and schema is None:
            open_names = [c for c in shape.text_columns(df)
                          if c not in named and c not in untyped and c != "_stream_url"]
            stamps = _stamped(df, options, open_names)
            if stamps:
                df = shape.parse_datetimes(df, options.datetime_format, stamps)
            df = apply_inferred(df, [c for c in open_names if c not in stamps])
    if options.flatten and not text:
        df = shape.flatten(df)
    if options.max_decimals is not None:
        df = shape.max_decimals(df, options.max_decimals)
    # A `columns` type for a text timestamp honours datetime_format.
    if named and options.datetime_format:
        stamped = [c for c, t in named.items()
                   if shape.spark_type(t).startswith("timestamp") and c in shape.text_columns(df)]
        df = shape.parse_datetimes(df, options.datetime_format, stamped) if stamped else df
    df = shape.cast_columns(df, {c: t for c, t in named.items() if c in df.columns})
    df = shape.apply_transforms(df, options.transforms)
    return shape.limit_offset(df, options.limit, options.offset)


def _stamped(df: DataFrame, options: SourceOptions, names) -> list[str]:
    """Text columns whose every value reads as ``datetime_format`` (one pass)."""
    if not options.datetime_format or not names:
        return []
    fmt = F.lit(options.datetime_format)
    fits = df.agg(*[
        (F.bool_and(shape.column(c).isNull()
                    | F.try_to_timestamp(shape.column(c), fmt).isNotNull())
         & (F.count(shape.column(c)) > 0)).alias(c) for c in names]).first()
    return [c for c in names if fits[c]]


def parse_text(df: DataFrame, options: SourceOptions) -> DataFrame:
    """The text-level parse options, in the order they act on a value."""
    if options.trim_space:
        df = shape.trim_space(df)
    if options.null_if is not None:
        df = shape.null_if(df, options.null_if)
    if options.empty_as_null:
        df = shape.empty_as_null(df)
    if options.skip_blank_lines:
        df = shape.skip_blank_rows(df)
    return df


def _scan(spark, paths, fmt, codec, options, on_malformed, schema, stream_url, multi_line):
    """(DataFrame, whether its columns are still raw text)."""
    reader = spark.read
    if codec == "zip" and fmt in ("csv", "json", "jsonlines", None):
        return archives.read_zip(
            spark, paths, fmt or "csv", options, stream_url), fmt == "csv"
    if fmt == "csv":
        return read_csv(spark, paths, options, on_malformed, schema, stream_url, multi_line), True
    if fmt == "xlsx":
        return archives.read_xlsx(spark, paths, options, stream_url), True
    if fmt == "arrow":
        return archives.read_arrow(spark, paths, schema, stream_url), False
    if fmt in ("json", "jsonlines"):
        df = _read_json(spark, paths, fmt, options, schema)
    elif fmt == "xml":
        reader = reader.format("xml").option("rowTag", "row")
        df = (reader.schema(schema) if schema else reader).load(paths)
    elif fmt == "parquet":
        df = (reader.schema(schema) if schema else reader).parquet(*paths)
    elif fmt == "raw":
        df = reader.format("binaryFile").load(paths)
    elif fmt == "avro":
        try:
            df = reader.format("avro").load(paths)
        except Exception as error:
            if "avro" in str(error).lower():
                raise UnsupportedError(
                    "reading avro needs the spark-avro module on the class path") from error
            raise
    else:
        raise UnsupportedError(f"no reader for {fmt!r} files")
    if stream_url:
        df = shape.with_stream_url(df)
    return df, False


# -- csv -------------------------------------------------------------------------


def file_heads(spark: SparkSession, paths, *extra) -> DataFrame:
    """``file, head`` (its first line that is not blank) and further aggregates per
    file: one scan, one small row per file and task."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        "value", place.alias("place"))
    head = F.min_by("value", F.when(F.trim("value") != "", F.col("place")))
    return lines.groupBy("file").agg(head.alias("head"), *extra).orderBy("file")


def file_pattern(uri: str) -> str:
    """A file's path as a reader takes it: decoded, wildcards taken literally."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def csv_layouts(spark: SparkSession, paths) -> list[tuple[str, bool, list[str]]]:
    """(header line, line breaks in quotes, files) of every kind of file.

    A quoted value with a line break leaves a physical line with an odd number of
    quotes. Such files are read by :mod:`.quoted`, all others as Spark splits them.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    kinds: dict[tuple[str, bool], list[str]] = {}
    for row in file_heads(spark, paths, F.max(quotes % 2 == 1).alias("broken")).collect():
        head = (row["head"] or "").removeprefix("\ufeff").rstrip("\r")
        kinds.setdefault((head, bool(row["broken"])), []).append(file_pattern(row["file"]))
    return [(head, broken, files) for (head, broken), files in kinds.items()]


def read_csv(spark: SparkSession, paths, options: SourceOptions, on_malformed: str = "pad",
             schema=None, stream_url: bool = False, multi_line: bool | None = None
             ) -> DataFrame:
    """Files with the same header are read together; different headers are united
    by name. With a ``schema`` or without headers, columns go by position."""
    header = options.header is not False
    by_name = header and schema is None and not options.fields_per_rec
    if multi_line is None:
        # Files whose quotes hold line breaks are told apart by their own header.
        parts = [(files, broken, head) for head, broken, files in csv_layouts(spark, paths)]
        if not by_name:
            plain_files = [f for files, broken, _ in parts if not broken for f in files]
            parts = [p for p in parts if p[1]]
            if plain_files:
                parts.insert(0, (plain_files, False, None))
        if len(parts) < 2:  # one kind of file: the paths as they were given
            parts = [(paths, *parts[0][1:])] if parts else [(paths, False, None)]
    else:
        parts = [(paths, multi_line, None)]
    frames = [_read_csv_files(spark, files, options, on_malformed, schema, stream_url, whole, head)
              for files, whole, head in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True) if by_name
                  else a.union(b), frames)


def _read_csv_files(spark, paths, options, on_malformed, schema, stream_url, multi_line,
                    head=None):
    header = options.header is not False
    if multi_line and head is not None:
        line = spark.createDataFrame([(head,)], "value string")
        names = line.select(delimited.fields(F.get(delimited.records(F.col("value")), F.lit(0)),
                                             options.delimiter or ",").alias("f")).first()["f"]
        names = [n if header and n else f"_c{i}" for i, n in enumerate(names)]
        width = options.fields_per_rec or len(names)
        names = [names[i] if i < len(names) else f"_c{i}" for i in range(width)]
        if len({n.lower() for n in names}) == len(names):
            return read_quoted(spark, paths, options, names, head if header else None,
                               on_malformed, schema, stream_url)
    mode = {"pad": "PERMISSIVE", "skip": "DROPMALFORMED", "fail": "FAILFAST"}[on_malformed]

    def reader():
        r = (spark.read.option("header", header).option("mode", mode)
             .option("escape", '"').option("emptyValue", "").option("multiLine", multi_line))
        if on_malformed != "pad":  # judge whole lines, whichever columns are used
            r = r.option("columnPruning", False)
        if options.delimiter:
            r = r.option("sep", options.delimiter)
        if options.null_if is not None:
            r = r.option("nullValue", options.null_if)
        return r

    if schema is None:
        names = reader().csv(paths).columns
        width = options.fields_per_rec or len(names)
        names = [names[i] if i < len(names) else f"_c{i}" for i in range(width)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = reader().schema(schema).option("enforceSchema", True).csv(paths)
    return shape.with_stream_url(df) if stream_url else df


def malformed_rows(spark: SparkSession, paths, options: SourceOptions | dict | None,
                   schema: T.StructType) -> DataFrame:
    """What ``on_malformed="skip"`` leaves out: the values that could be read and
    the raw line as ``_corrupt_record``."""
    options = SourceOptions.from_dict(options)
    bad = "_corrupt_record"
    full = T.StructType(schema.fields + [T.StructField(bad, T.StringType())])
    reader = (spark.read.schema(full).option("header", options.header is not False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
              .option("columnPruning", False)
              .option("escape", '"'))
    if options.delimiter:
        reader = reader.option("sep", options.delimiter)
    return reader.csv(paths).where(F.col(bad).isNotNull())


# -- json ------------------------------------------------------------------------


#: Blanks around a line.
_BLANK = " \t"

#: From this size on, files of one JSON value are looked at for a layout that splits.
SPLIT_FROM = 64 << 20


def json_documents(spark: SparkSession, paths) -> tuple[list[str], list[str], bool]:
    """(files of one JSON value each, files of a value per line, whether one of the
    first is large), told apart by each file's own first line that is not blank:
    whether it is a value by itself."""
    first = file_heads(spark, paths, F.max("size").alias("size"))
    line = F.trim("head")
    whole = line.startswith("[") | (
        line.startswith("{") & F.get_json_object("head", "$").isNull())
    found = first.select("file", "size", F.coalesce(whole, F.lit(False)).alias("whole")).collect()
    return ([file_pattern(r["file"]) for r in found if r["whole"]],
            [file_pattern(r["file"]) for r in found if not r["whole"]],
            any(r["whole"] and r["size"] > SPLIT_FROM for r in found))


def arrays_by_line(spark: SparkSession, paths) -> tuple[list[str], list[str]]:
    """(files of an array with brackets and every element, an object, on lines of
    their own, other files). Every line is judged, as JSON's reader would take it."""
    line = F.btrim("value", F.lit(_BLANK))
    comma = line.endswith(",")
    end = "__ferryline_end"  # is the second element only where the line holds one value
    pair = F.from_json(F.concat(F.lit("["), "value", F.when(comma, "").otherwise(","),
                                F.lit(f'{{"{end}":true}}]')), f"array<struct<`{end}`: boolean>>")
    lines = spark.read.text(paths).where(line != "").select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("id"),
        F.col("_metadata.file_block_start").alias("block"), line.isin("[", "]").alias("bracket"),
        (line == "[").alias("opens"), (line == "]").alias("closes"), comma.alias("comma"),
        F.when(line.startswith("{") & F.is_valid_utf8("value"), pair).alias("pair"))
    one = (F.size("pair") == 2) & F.get("pair", F.lit(1))[end]
    blocks = lines.groupBy("file", "block").agg(
        F.bool_and(F.col("bracket") | F.coalesce(one, F.lit(False))).alias("fits"),
        F.min_by("opens", "id").alias("opens"), F.max_by("closes", "id").alias("closes"),
        F.count_if("bracket").alias("brackets"),
        F.count_if(~F.col("bracket") & ~F.col("comma")).alias("bare"),
        F.max_by("comma", F.when(~F.col("bracket"), F.col("id"))).alias("comma"))
    fits = (F.bool_and("fits") & F.min_by("opens", "block") & F.max_by("closes", "block")
            & (F.sum("brackets") == 2) & (F.sum("bare") == 1)
            & ~F.max_by("comma", F.when(F.col("comma").isNotNull(), F.col("block"))))
    found = blocks.groupBy("file").agg(fits.alias("fits")).orderBy("file").collect()
    return ([file_pattern(r["file"]) for r in found if r["fits"]],
            [file_pattern(r["file"]) for r in found if not r["fits"]])


def _read_values(spark, paths, reader, schema, large: bool) -> DataFrame:
    """Files of one JSON value each. Spark reads such a file in one task; large
    arrays whose elements have lines of their own are split between them."""
    split, other = arrays_by_line(spark, paths) if large else ([], paths)
    if not split or "_corrupt_record" in str(schema):
        return reader(multiLine=True).json(paths)
    if schema is None:  # of lines: the brackets are malformed, a comma behind a value is not read
        schema = reader(mode="DROPMALFORMED").json(split).schema
        if other and reader(multiLine=True).json(other).schema != schema:
            schema = reader(multiLine=True).json(paths).schema
        if not schema.names:
            return reader(multiLine=True).json(paths)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad = "__ferryline_line"
    lines = (spark.read.schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())]))
             .option("columnNameOfCorruptRecord", bad).json(split))
    # A bracket has no values. Asking for one keeps the reader from being asked for no column.
    rows = lines.where(shape.column(schema.names[0]).isNotNull() | F.col(bad).isNull()
                       | ~F.btrim(bad, F.lit(_BLANK)).isin("[", "]")).drop(bad)
    return rows.union(spark.read.schema(schema).json(other, multiLine=True)) if other else rows


def _read_json(spark, paths, fmt, options, schema) -> DataFrame:
    """Files of one array or object give columns; JSON lines give one text column
    ``data``, unless the records are flattened, a record path is set, or other
    files of the load give columns."""
    if options.jmespath:
        body = spark.read.text(paths, wholetext=fmt == "json").withColumnRenamed("value", "data")
        return extract_records(body, "data", options.jmespath, keep=[])

    def reader(**with_options):
        made = spark.read.options(**with_options)
        return made.schema(schema) if schema else made

    if fmt == "json":
        whole, lines, large = json_documents(spark, paths)
        if whole:
            df = _read_values(spark, whole, reader, schema, large)
            return df.unionByName(reader().json(lines), allowMissingColumns=True) if lines else df
    if options.flatten or schema is not None:
        return reader().json(paths)
    return spark.read.text(paths).withColumnRenamed("value", "data")
