"""Delimited files with line breaks inside quotes, read by many tasks a file.

Spark cuts a file at byte ranges and a range at line ends. Whether a line end is
the end of a record depends on the number of quotes before it in the file: even,
and it is. So every range first counts its quotes; the counts of the ranges
before it, one small row each, tell a range whether it starts inside quotes.
Each range then puts its lines together to records. What it begins and does not
end, and what it ends and did not begin, are fragments, at most two per range,
which a join of neighbouring ranges puts together.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SourceOptions
from ..functions import delimited

_PLACE = ["file", "start"]
_PIECES = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("start", T.LongType()),
    # record: a whole one; head: the end of a record begun earlier; tail: the begin of one.
    T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())])


def _lines(spark: SparkSession, paths) -> DataFrame:
    """Lines with their file and byte range, in the order of the range. Carriage
    returns stay, as they may belong to a value."""
    return (spark.read.option("lineSep", "\n").text(paths)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("start"), "value"))


def range_quotes(lines: DataFrame) -> DataFrame:
    """``file, start, inside``: whether a byte range starts inside quotes. One row
    per range; a file's ranges are few (its bytes by the size of a split)."""
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'))))
    counts = lines.groupBy(*_PLACE).agg(quotes.alias("q"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*_PLACE, (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2 == 1)
                         .alias("inside"))


def _pieces(batches):
    """Lines of byte ranges, one range after the other, to records and fragments."""
    place, held, open_, kind, out = None, [], False, "record", []

    def emit():
        columns = [*zip(*out)] or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())],
            _PIECES.names)

    def left_open():
        # All of the range may lie inside one record: then it is neither head nor tail.
        return [(*place, "middle" if kind == "head" else "tail", "\n".join(held))]

    for batch in batches:
        for file, start, value, inside in zip(*[c.to_pylist() for c in batch.columns]):
            if (file, start) != place:
                if held:
                    out += left_open()
                place, held, open_ = (file, start), [], inside
                kind = "head" if inside else "record"
            held.append(value)
            open_ ^= value.count('"') % 2 == 1
            if not open_:
                out.append((*place, kind, "\n".join(held)))
                held, kind = [], "record"
            if len(out) >= 10_000:
                yield emit()
                out = []
    if held:
        out += left_open()
    yield emit()


def whole_records(spark: SparkSession, paths) -> DataFrame:
    """``file, start, text`` of every record, line ends inside quotes kept."""
    lines = _lines(spark, paths)
    inside = range_quotes(lines)
    # The ranges of all files: 1 row per split of the scan, so small enough to send.
    pieces = lines.join(F.broadcast(inside), _PLACE).select(*_PLACE, "value", "inside") \
        .mapInArrow(_pieces, _PIECES)
    from ..plans.targets import stage

    pieces = stage(pieces, "csv-pieces")
    fragments = pieces.where("kind != 'record'")
    so_far = Window.partitionBy("file").orderBy("start", F.col("kind") == "tail").rowsBetween(
        Window.unboundedPreceding, 0)
    joined = (fragments.withColumn("n", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0))
                                   .over(so_far))
              .groupBy("file", "n").agg(F.min("start").alias("start"), F.array_join(
                  F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))),
                              lambda p: p["text"]), "\n").alias("text")))
    return (pieces.where("kind = 'record'").select("file", "start", "text")
            .unionByName(joined.select("file", "start", "text")))


def read_quoted(spark: SparkSession, paths, options: SourceOptions, names: list[str],
                header: str | None, on_malformed: str = "pad", schema: T.StructType | None = None,
                stream_url: bool = False) -> DataFrame:
    """Columns ``names`` (or ``schema``) of the records. ``header``: the first line
    of the files, which is no record, or None."""
    kind = schema or T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = whole_records(spark, paths).withColumn("text", F.rtrim("text", F.lit("\r")))
    rows = rows.where(F.trim("text") != "")
    if header is not None:
        is_head = F.ltrim("text", F.lit("﻿")) == header
        rows = rows.where(~(is_head & (F.col("start") == 0)))
    delimiter = options.delimiter or ","
    record = F.get(delimited.records(F.col("text")), F.lit(0))
    fields = delimited.fields(record, delimiter)
    rows = rows.withColumn("fields", fields)
    if on_malformed == "skip":
        rows = rows.where(F.size("fields") == len(kind))
    elif on_malformed == "fail":
        rows = rows.withColumn("fields", F.when(F.size("fields") == len(kind), F.col("fields"))
                               .otherwise(F.raise_error(F.concat(F.lit("malformed record: "), "text"))))

    def value(i: int, of: T.StructField):
        text = F.nullif(F.get("fields", F.lit(i)), F.lit(""))  # as Spark's own reader has it
        if options.null_if is not None:
            text = F.nullif(text, F.lit(options.null_if))
        return text.try_cast(of.dataType).alias(of.name)

    url = [F.col("file").alias("_stream_url")] if stream_url else []
    return rows.select(*[value(i, f) for i, f in enumerate(kind)], *url)
