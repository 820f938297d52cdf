"""File sinks. A target path is a dataset folder with one file per partition.

Text formats go through Spark's own writers, so the commit protocol covers
retried and speculative tasks. Arrow and zip files are binary and have no
writer in Spark; there each task writes its own file and renames it into place.
"""

from __future__ import annotations

import io
import math
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TargetOptions
from ..enums import plain
from ..errors import UnsupportedError
from ..fs import ClusterFiles, aside
from ..operators.shape import column, max_decimals

# Compression names each text writer accepts.
TEXT_CODECS = {"none": "none", "gzip": "gzip", "snappy": "snappy"}
PARQUET_CODECS = {"none": "uncompressed", "gzip": "gzip", "snappy": "snappy", "zstd": "zstd"}

EXTENSIONS = {
    ".csv": "csv", ".tsv": "csv", ".txt": "csv",
    ".json": "json", ".jsonl": "jsonlines", ".ndjson": "jsonlines",
    ".xml": "xml", ".xlsx": "xlsx", ".parquet": "parquet",
    ".arrow": "arrow", ".ipc": "arrow", ".feather": "arrow",
    ".avro": "avro", ".sas7bdat": "sas7bdat",
}
COMPRESSED_SUFFIXES = {".gz": "gzip", ".snappy": "snappy", ".zst": "zstd", ".zip": "zip"}


def format_of(path: str, default: str | None = None) -> str | None:
    """Format named by a path's extension, looking through compression suffixes."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    for suffix in COMPRESSED_SUFFIXES:
        name = name.removesuffix(suffix)
    for ext, fmt in EXTENSIONS.items():
        if name.endswith(ext):
            return fmt
    return default


def compression_of(path: str, option) -> str:
    name = plain(option) or "auto"
    if name == "auto":
        for suffix, codec in COMPRESSED_SUFFIXES.items():
            if path.lower().rstrip("/").endswith(suffix):
                return codec
        return "auto"
    return name


def write_files(df: DataFrame, path: str, fmt: str, options: TargetOptions | None = None,
                mode: str = "overwrite", partition_by=()) -> None:
    """Write a dataset. Overwriting writes beside the old files and takes their
    place when all is written: a failed write leaves them, and they may be read
    for it."""
    options = options or TargetOptions()
    fmt = plain(fmt)
    codec = compression_of(path, options.compression)
    files = ClusterFiles(df.sparkSession)
    if mode != "overwrite" or not files.exists(path):
        return _write_files(df, path, fmt, codec, options, mode, partition_by)
    fresh = aside(path)
    try:
        _write_files(df, fresh, fmt, codec, options, mode, partition_by)
        files.swap(fresh, path)
    finally:
        files.remove(fresh)
    return None


def _write_files(df: DataFrame, path: str, fmt: str, codec: str, options: TargetOptions,
                 mode: str, partition_by) -> None:
    if partition_by and (fmt == "arrow" or codec == "zip"):
        raise UnsupportedError(f"{fmt} files are not partitioned by columns")
    df = shaped_for_write(df, options)
    if options.file_max_bytes:
        from .sized import can_be_sized, write_sized

        if (can_be_sized(fmt, codec) and not partition_by and (codec != "zip" or fmt == "csv")
                and opens_in_tasks(ClusterFiles(df.sparkSession).qualified(path))):
            write_sized(df, path, fmt, codec, options, mode)
            return None
        rows = rows_per_file(df, fmt, int(options.file_max_bytes))
        if options.file_max_rows:
            rows = min(rows, int(options.file_max_rows))
        options = options.overlay(TargetOptions(file_max_rows=rows))
    if fmt == "avro":
        return _write_avro(df, path, mode)
    if fmt in ("sas7bdat", "xlsx", "raw"):
        raise UnsupportedError(f"writing {fmt} files is not supported")
    if codec == "zip":
        if fmt != "csv":
            raise UnsupportedError("zip compression is supported for csv files only")
        write_zip_csv(df, path, options, mode)
        return None
    if fmt == "arrow":
        write_arrow(df, path, mode, options)
        return None
    if partition_by and not options.concurrency:
        # One value's rows meet in as many tasks as their size calls for: few
        # files per value, and a value holding much of the data is still split.
        df = df.hint("rebalance", *[column(c) for c in partition_by])
    writer = _writer(df, fmt, options, codec, mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "static").save(path)
    return None


def shaped_for_write(df: DataFrame, options: TargetOptions) -> DataFrame:
    if options.max_decimals is not None:
        df = max_decimals(df, options.max_decimals)
    if options.concurrency:
        df = df.repartition(int(options.concurrency))
    return df


def _writer(df: DataFrame, fmt: str, options: TargetOptions, codec: str, mode: str):
    if fmt == "json":
        # Rows become array elements inside the partition; the text writer then
        # saves exactly one file per partition, each a valid JSON array.
        lines = df.select(F.to_json(F.struct(*[column(c) for c in df.columns]), {
            "ignoreNullFields": "false",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        }).alias("value")).mapInArrow(_as_json_arrays(int(options.file_max_rows or 0)),
                                      "value string")
        most = int(options.file_max_rows or 0)
        writer = lines.write.format("text").option("maxRecordsPerFile", most + 2 if most else 0)
    else:
        native = {"jsonlines": "json"}.get(fmt, fmt)
        source = df.select(*[_text_safe(f) for f in df.schema.fields]) if fmt == "csv" else df
        writer = source.write.format(native)
        if options.file_max_rows:
            writer = writer.option("maxRecordsPerFile", int(options.file_max_rows))
    if fmt == "csv":
        # Spark's CSV writer trims values unless told not to.
        writer = (writer.option("header", options.header is not False).option("escape", '"')
                  .option("ignoreLeadingWhiteSpace", False)
                  .option("ignoreTrailingWhiteSpace", False)
                  .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                  .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS XXX"))
        if options.delimiter:
            writer = writer.option("sep", options.delimiter)
    if fmt == "jsonlines":
        writer = (writer.option("ignoreNullFields", False)
                  .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if fmt == "xml":
        writer = (writer.option("rowTag", "row").option("rootTag", "rows")
                  .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if options.datetime_format and fmt in ("csv", "jsonlines", "xml"):
        writer = (writer.option("timestampNTZFormat", options.datetime_format)
                  .option("timestampFormat", options.datetime_format))
    if codec != "auto":
        codecs = PARQUET_CODECS if fmt == "parquet" else TEXT_CODECS
        if codec not in codecs:
            raise UnsupportedError(f"{codec} compression is not available for {fmt} files")
        writer = writer.option("compression", codecs[codec])
    return writer.mode(mode)


def _text_safe(field: T.StructField):
    """CSV holds text only: nested values are written as JSON."""
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column(field.name)).alias(field.name)
    return column(field.name)


def _as_json_arrays(most: int):
    """Turn a partition of JSON texts into the lines of JSON arrays of ``most`` rows
    (0: one array). A full array has ``most`` + 2 lines, which the text writer
    makes a file."""
    def run(batches):
        held, count, begun = None, 0, False
        for batch in batches:
            lines = []
            for row in batch.column(0).to_pylist():
                if most and count == most:
                    lines += [held, "]"]
                    held, count = None, 0
                lines.append("[" if held is None else held + ",")
                held, count, begun = row, count + 1, True
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        tail = [held, "]"] if begun else ["[", "]"]
        yield pa.RecordBatch.from_arrays([pa.array(tail, pa.string())], ["value"])
    return run


def rows_per_file(df: DataFrame, fmt: str, max_bytes: int) -> int:
    """Rows that fit ``max_bytes`` whichever they are: by the largest rendered row of
    all. For formats whose own writers make the files; a smaller row wastes room."""
    rows = df.select(*[_text_safe(f) for f in df.schema.fields])
    fields = F.struct(*[column(c) for c in rows.columns])
    text = F.to_csv(fields) if fmt in ("csv", "parquet", "arrow") else F.to_json(fields)
    largest = rows.agg(F.max(F.octet_length(text) + 1).alias("n")).first()["n"]
    if not largest:
        return 1_000_000
    if fmt == "xml":  # every value stands between its name twice
        largest += sum(2 * len(c) + 16 for c in df.columns)
        max_bytes -= 256
    return max(1, math.floor(max_bytes / largest))


def _write_avro(df: DataFrame, path: str, mode: str) -> None:
    try:
        df.write.format("avro").mode(mode).save(path)
    except Exception as error:
        if "avro" in str(error).lower():
            raise UnsupportedError(
                "writing avro needs the spark-avro module on the class path") from error
        raise


# -- task-written binary files -------------------------------------------------


MANIFEST = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("rows", T.LongType()),
])


def local_or_remote(path: str):
    """(filesystem, path) inside a task, for local and remote schemes alike."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = path[len("file:"):]
        path = "/" + path.lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def opens_in_tasks(path: str) -> bool:
    """Whether a task can open the path by itself, without Spark's readers."""
    try:
        local_or_remote(path)
    except Exception:
        return False
    return True


def commit_file(folder: str, name: str, attempt: int, produce) -> str:
    """Write ``name`` through a per-attempt temporary file and rename it, so a
    retried or speculative task leaves one complete file."""
    filesystem, root = local_or_remote(folder)
    filesystem.create_dir(root, recursive=True)
    staged, final = f"{root}/_{name}.{attempt}", f"{root}/{name}"
    with filesystem.open_output_stream(staged, compression=None) as out:
        produce(out)
    filesystem.move(staged, final)
    return name


def task_ids() -> tuple[int, int]:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId(), context.taskAttemptId()


def _save_with_tasks(df: DataFrame, path: str, write_partition, mode: str) -> DataFrame:
    files = ClusterFiles(df.sparkSession)
    prefix = "part"
    if files.exists(path):
        if mode == "overwrite":
            files.remove(path)
        elif mode == "append":
            prefix = f"part-{len(files.names(path))}"
    done = df.mapInArrow(write_partition(files.qualified(path), prefix), MANIFEST).collect()
    return df.sparkSession.createDataFrame(done, MANIFEST)


def _in_files(batches, most: int):
    """The batches of a partition, grouped into files of ``most`` rows (0: one file)."""
    held, count = [], 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, most - count if most else batch.num_rows)
            held.append(part)
            start, count = start + part.num_rows, count + part.num_rows
            if most and count == most:
                yield held
                held, count = [], 0
    if held:
        yield held


def write_arrow(df: DataFrame, path: str, mode: str = "overwrite",
                options: TargetOptions | None = None) -> DataFrame:
    """Arrow IPC files, one per partition or ``file_max_rows`` rows; returns the
    (small) file manifest."""
    most = int(options.file_max_rows or 0) if options else 0

    def write_partition(folder, prefix):
        def run(batches):
            pid, attempt = task_ids()
            groups = _in_files(batches, most) if most else [batches]
            for part, group in enumerate(groups):
                total = 0

                def produce(out, group=group):
                    nonlocal total
                    with pa.ipc.new_file(out, empty) as writer:
                        for batch in group:
                            writer.write_batch(batch.cast(empty))
                            total += batch.num_rows

                name = commit_file(folder, f"{prefix}-{pid:05d}-{part}.arrow", attempt, produce)
                yield pa.RecordBatch.from_pydict({"file": [name], "rows": [total]},
                                                 schema=manifest)
        return run

    empty = arrow_schema(df.schema)
    manifest = arrow_schema(MANIFEST)
    return _save_with_tasks(df, path, write_partition, mode)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def write_zip_csv(df: DataFrame, path: str, options: TargetOptions | None = None,
                  mode: str = "overwrite") -> DataFrame:
    """One zip archive per partition, each holding one CSV file."""
    options = options or TargetOptions()
    sep = options.delimiter or ","
    header = sep.join(df.columns) if options.header is not False else None
    line = F.to_csv(F.struct(*[column(c) for c in df.columns]), {
        "sep": sep, "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    manifest = arrow_schema(MANIFEST)

    def write_partition(folder, prefix):
        def run(batches):
            pid, attempt = task_ids()
            most = int(options.file_max_rows or 0)
            for part, group in enumerate(_in_files(batches, most) if most else [batches]):
                total = 0

                def produce(out, group=group, part=part):
                    nonlocal total
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                        with archive.open(f"{prefix}-{pid:05d}-{part}.csv", "w") as member:
                            text = io.TextIOWrapper(member, encoding="utf-8", newline="\n")
                            if header is not None:
                                text.write(header + "\n")
                            for batch in group:
                                text.writelines(v + "\n" for v in batch.column(0).to_pylist())
                                total += batch.num_rows
                            text.flush()

                name = commit_file(folder, f"{prefix}-{pid:05d}-{part}.csv.zip", attempt, produce)
                yield pa.RecordBatch.from_pydict({"file": [name], "rows": [total]},
                                                 schema=manifest)
        return run

    return _save_with_tasks(df.select(line.alias("value")), path, write_partition, mode)
