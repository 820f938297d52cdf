"""One transfer: source -> shape -> load mode -> target, or rows back to Python."""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession

from ..config import (
    ReplicationStream, SourceOptions, TargetOptions, as_list, as_mapping, load_document)
from ..enums import Mode, plain
from ..errors import TransferError
from ..fs import ClusterFiles
from ..functions.paths import extract_records
from ..operators import shape
from ..operators.schema import apply_typing
from ..sinks.files import format_of
from ..sources.connections import (
    Connection, Location, execute_sql, jdbc_table, resolve, sql_frame)
from ..sources.files import read_files
from ..sources.inputs import input_frame
from .modes import LoadReport, LoadSpec, load
from .targets import CatalogTable, FileTarget, JdbcTable, VersionedDataset

SQL_TEXT = re.compile(r"^\s*(select|with)\b", re.IGNORECASE)
KEYED_MODES = {Mode.INCREMENTAL.value, Mode.BACKFILL.value, Mode.TRUNCATE.value,
               Mode.SNAPSHOT.value}


def is_path(text: str) -> bool:
    return "://" in text or text.startswith(("/", "file:", "./"))


def join_path(location: Location, name: str) -> str:
    if is_path(name) or not location.url:
        return name
    return f"{location.url.rstrip('/')}/{name.lstrip('/')}"


def local_form(path: str) -> str:
    return path.replace("file://", "file:", 1) if path.startswith("file://") else path


class Transfer:
    """Move data from a source to a target, or stream it back.

    The arguments are those of a single extract-load command; ``dataframe()``
    gives the shaped source as a lazy DataFrame for further Spark work.
    """

    def __init__(self, src_conn=None, src_stream: str | None = None, src_options=None,
                 tgt_conn=None, tgt_object: str | None = None, tgt_options=None,
                 select=None, where: str | None = None, transforms=None, columns=None,
                 streams=None, mode=None, limit: int | None = None, offset: int | None = None,
                 range: str | None = None, primary_key=None, update_key: str | None = None,
                 env=None, replication: str | None = None, pipeline: str | None = None,
                 config: str | None = None, debug: bool = False, trace: bool = False,
                 input: Any = None, files=None, strict_casts: bool = False,
                 order_by=None, on_malformed: str = "pad", spark: SparkSession | None = None):
        self.src_conn = src_conn.name if isinstance(src_conn, Connection) else src_conn
        self.src_stream = src_stream
        self.src_options = SourceOptions.from_dict(as_mapping(src_options))
        self.tgt_conn = tgt_conn.name if isinstance(tgt_conn, Connection) else tgt_conn
        self.tgt_object = tgt_object
        self.tgt_options = TargetOptions.from_dict(as_mapping(tgt_options))
        self.select = select
        self.where = where
        self.transforms = as_mapping(transforms)
        self.columns = as_mapping(columns)
        self.streams = streams
        self.mode = mode
        self.limit = limit
        self.offset = offset
        self.range = range
        self.primary_key = primary_key
        self.update_key = update_key
        self.env = as_mapping(env) or {}
        self.replication = replication
        self.pipeline = pipeline
        self.config = config
        self.debug = debug
        self.trace = trace
        self.input = input
        self.files = list(files or [])
        self.strict_casts = strict_casts
        self.order_by = order_by
        self.on_malformed = on_malformed
        self._spark = spark
        self.loaded_at: datetime.datetime | None = None
        self.before_merge = None
        self.after_merge = None
        if config:
            self._apply_config(config)

    def _apply_config(self, config) -> None:
        """The single-task document form: ``source``, ``target`` and ``mode``."""
        text = config if isinstance(config, str) else json.dumps(config)
        document = as_mapping(text) if ":" in text and "\n" in text or text.lstrip().startswith(
            "{") else load_document(text)
        source, target = document.get("source") or {}, document.get("target") or {}
        self.src_conn = self.src_conn or source.get("conn")
        self.src_stream = self.src_stream or source.get("stream")
        self.src_options = SourceOptions.from_dict(source.get("options")).overlay(self.src_options)
        self.primary_key = self.primary_key or source.get("primary_key")
        self.update_key = self.update_key or source.get("update_key")
        self.limit = self.limit if self.limit is not None else source.get("limit")
        self.tgt_conn = self.tgt_conn or target.get("conn")
        self.tgt_object = self.tgt_object or target.get("object")
        self.tgt_options = TargetOptions.from_dict(target.get("options")).overlay(self.tgt_options)
        self.mode = self.mode or document.get("mode")

    @property
    def spark(self) -> SparkSession:
        return self._spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    # -- source ----------------------------------------------------------------

    def _env_switch(self, name: str) -> bool:
        """Environment switches are matched on the end of their name."""
        return any(str(k).upper().endswith(name) and str(v).lower() in ("true", "1")
                   for k, v in self.env.items())

    def _scan(self) -> tuple[DataFrame, bool]:
        """The source before shaping, and whether its parse options are applied."""
        options = self.src_options
        if self.input is not None:
            return input_frame(self.spark, self.input), False
        conn, stream = self.src_conn, self.src_stream
        location = resolve(conn, self.env) if conn else None
        if location and location.kind == "file" and not stream and not self.files:
            stream = location.url
        if stream is None and not self.files:
            raise TransferError("no source stream, files or input given")
        if location is None:
            on_files = bool(self.files) or is_path(stream)
            location = Location("file" if on_files and not SQL_TEXT.match(stream or "") else
                                "spark")
        if location.kind == "file":
            paths = [local_form(join_path(location, p)) for p in self.files or [stream]]
            return self._scan_files(paths), True
        if SQL_TEXT.match(stream):
            return sql_frame(self.spark, location, stream, self._sql_args(stream)), False
        if location.kind == "jdbc":
            chunk = str(options.chunk_size) if options.chunk_size else ""
            key = self.update_key or (as_list(self.primary_key) or [None])[0]
            return jdbc_table(self.spark, location, stream, key,
                              int(chunk) if chunk.isdigit() else None), False
        return self.spark.table(stream), False

    def _sql_args(self, text: str) -> dict | None:
        used = {k: v for k, v in self.env.items() if re.search(rf":{re.escape(str(k))}\b", text)}
        return used or None

    def _scan_files(self, paths: list[str]) -> DataFrame:
        fmt = plain(self.src_options.format) or format_of(paths[0], "parquet")
        if fmt == "parquet":
            files = ClusterFiles(self.spark)
            datasets = [p for p in paths if files.exists(f"{p}/_commits")]
            if datasets:  # each path is a dataset or plain files; united by name
                frames = [VersionedDataset(self.spark, p).read() for p in datasets]
                rest = [p for p in paths if p not in datasets]
                if rest:
                    frames.append(read_files(self.spark, rest, {"format": "parquet"}))
                return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        options = self.src_options.overlay(SourceOptions())
        options.limit = options.offset = options.transforms = None
        # Columns cast after the select need no inference. Times in a format of
        # their own are the exception: the reader knows the format.
        own = self.columns or {}
        timed = {c: t for c, t in own.items() if options.datetime_format
                 and shape.spark_type(t).startswith("timestamp")}
        return read_files(self.spark, paths, options,
                          stream_url=self._env_switch("STREAM_URL_COLUMN"),
                          columns={**(options.columns or {}), **timed},
                          untyped=[c for c in own if c not in timed],
                          on_malformed=self.on_malformed)

    def dataframe(self, watch: Observation | None = None) -> DataFrame:
        """The shaped source: where, select, casts, transforms, metadata, limit.
        ``watch`` observes how many values the casts turn into null."""
        options = self.src_options
        df, parsed = self._scan()
        if not parsed:  # the file readers apply these while reading
            if options.jmespath and "data" in df.columns:
                df = extract_records(df, "data", options.jmespath)
            if options.flatten:
                df = shape.flatten(df)
            if options.trim_space:
                df = shape.trim_space(df)
            if options.null_if is not None:
                df = shape.null_if(df, options.null_if)
            if options.empty_as_null:
                df = shape.empty_as_null(df)
            if options.max_decimals is not None:
                df = shape.max_decimals(df, options.max_decimals)
        if self.where:
            df = df.where(self.where)
        if self.select:
            url = [c for c in df.columns if c == "_stream_url"]
            df = shape.select_columns(df, self.select, self.input is not None, also=url)
        types = {**(as_mapping(options.columns) or {}), **(self.columns or {})}
        types = {c: t for c, t in types.items() if c in df.columns or not options.columns}
        if watch is not None:
            df = df.observe(watch, shape.cast_failures(df, types).alias("cast_nulls"))
        df = shape.cast_columns(df, types, self.strict_casts)
        df = shape.apply_transforms(df, options.transforms)
        df = shape.apply_transforms(df, self.transforms)
        if self._env_switch("LOADED_AT_COLUMN") and plain(self.mode) != Mode.SNAPSHOT.value:
            df = shape.with_loaded_at(df, self._run_time())
        limit = self.limit if self.limit is not None else options.limit
        offset = self.offset if self.offset is not None else options.offset
        return shape.limit_offset(df, limit, offset, self.order_by)

    def _source_is_stored(self) -> bool:
        """Whether the source is one whole Parquet dataset or catalog table."""
        if self.input is not None or self.where or self.limit is not None or self.offset:
            return False
        options = self.src_options
        if options.limit is not None or options.offset or SQL_TEXT.match(self.src_stream or ""):
            return False
        location = resolve(self.src_conn, self.env) if self.src_conn else None
        name = (self.files or [self.src_stream or (location.url if location else "")])[0]
        if not name:
            return False
        if is_path(name) or (location and location.kind == "file"):
            return (plain(options.format) or format_of(name, "parquet")) == "parquet"
        if location and location.kind == "jdbc":
            return False
        return self.spark.catalog.getTable(name).tableType in ("MANAGED", "EXTERNAL")

    def _run_time(self) -> datetime.datetime:
        if self.loaded_at is None:
            now = datetime.datetime.now(datetime.timezone.utc)
            self.loaded_at = now.replace(tzinfo=None)
        return self.loaded_at

    # -- target ----------------------------------------------------------------

    def target(self):
        options, obj = self.tgt_options, self.tgt_object
        location = resolve(self.tgt_conn, self.env) if self.tgt_conn else None
        if location is None:
            location = Location("file" if obj and is_path(obj) else "spark")
        if location.kind == "jdbc":
            return JdbcTable(self.spark, location.url, obj, location.properties, options)
        if location.kind == "spark":
            return CatalogTable(self.spark, obj, options)
        path = local_form(join_path(location, obj or location.url))
        fmt = plain(options.format) or format_of(path, "parquet")
        keyed = plain(self.mode) in KEYED_MODES
        versioned = fmt == "parquet" and (keyed or ClusterFiles(self.spark).exists(
            f"{path}/_commits"))
        if versioned:
            keys = options.table_keys or {}
            return VersionedDataset(self.spark, path, as_list(keys.get("partition")), fmt, options,
                                    as_list(keys.get("bucket")), int(keys.get("buckets") or 0))
        return FileTarget(self.spark, path, fmt, options)

    def _sql_around(self, text: str | None) -> None:
        if text:
            location = resolve(self.tgt_conn, self.env)
            for statement in [s for s in text.split(";\n") if s.strip()]:
                execute_sql(self.spark, location, statement, self._sql_args(statement))

    def shaped_for_target(self, df: DataFrame) -> DataFrame:
        options = self.tgt_options
        if options.column_casing:
            df = shape.column_casing(df, options.column_casing)
        if options.column_typing:
            df = apply_typing(df, options.column_typing)
        if options.max_decimals is not None:
            df = shape.max_decimals(df, options.max_decimals)
        return df

    def run(self) -> LoadReport | DataFrame:
        """Load into the target. Replication and pipeline files run as a whole
        and return their report as a DataFrame."""
        if self.replication:
            from .replication import Replication

            return Replication(file_path=self.replication, env=self.env, spark=self._spark).run(
                streams=as_list(self.streams) or None, mode=self.mode, range=self.range)
        if self.pipeline:
            from .replication import Pipeline

            return Pipeline(file_path=self.pipeline, env=self.env, spark=self._spark).run()
        if not self.tgt_object and not (self.tgt_conn and is_path(self.tgt_conn)):
            raise TransferError("no target object: use stream() or dataframe() to get rows back")
        options = self.tgt_options
        target = self.target()
        spec = LoadSpec(
            mode=self.mode, primary_key=self.primary_key, update_key=self.update_key,
            range=self.range, strategy=options.merge_strategy,
            delete_missing=bool(options.delete_missing),
            ignore_existing=bool(options.ignore_existing),
            add_new_columns=bool(options.add_new_columns),
            adjust_column_type=bool(options.adjust_column_type),
            chunk_size=self.src_options.chunk_size, staging=options.table_tmp,
            source_is_stored=self._source_is_stored(), loaded_at=self._run_time(),
            before_merge=self.before_merge, after_merge=self.after_merge)
        self._sql_around(options.pre_sql)
        watched = bool(self.columns) and target.counts_rows and not spec.chunk_size
        watch = Observation() if watched else None
        report = load(self.shaped_for_target(self.dataframe(watch)), target, spec)
        if watched and report.status == "success" and report.rows_in is not None:
            report.detail["cast_nulls"] = watch.get["cast_nulls"]
        if self.on_malformed == "skip" and report.status == "success":
            report.detail["malformed"] = self._malformed()
        self._sql_around(options.post_sql)
        return report

    def _malformed(self) -> int:
        """Number of csv lines that were skipped."""
        location = resolve(self.src_conn, self.env) if self.src_conn else None
        paths = self.files or [self.src_stream or (location.url if location else "")]
        paths = [local_form(join_path(location, p) if location else p) for p in paths]
        if (plain(self.src_options.format) or format_of(paths[0], "parquet")) != "csv":
            return 0
        options = self.src_options.overlay(SourceOptions())
        options.limit = options.offset = options.transforms = options.columns = None
        kept, every = (read_files(self.spark, paths, options, infer=False, on_malformed=how).count()
                       for how in ("skip", "pad"))
        return every - kept

    # -- rows back to Python -----------------------------------------------------

    def _check_streamable(self) -> None:
        if self.input is not None:
            raise TransferError("in-memory input cannot be streamed back without a target")

    def stream(self) -> Iterator[dict]:
        """Rows as dicts, one partition at a time. With a target it runs the
        load and yields nothing."""
        if self.tgt_object:
            self.run()
            return iter(())
        self._check_streamable()
        rows = self.dataframe().toLocalIterator(prefetchPartitions=False)
        return (row.asDict(recursive=True) for row in rows)

    def stream_arrow(self, batch_rows: int = 10_000) -> pa.RecordBatchReader:
        """Arrow batches with native types. Stopping early or closing is safe:
        later partitions are then never computed."""
        if self.tgt_object:
            raise TransferError("stream_arrow() cannot have a target object; use run()")
        self._check_streamable()
        from ..sources.connections import utc_times

        return arrow_reader(utc_times(self.dataframe()), batch_rows)


def arrow_reader(df: DataFrame, batch_rows: int = 10_000) -> pa.RecordBatchReader:
    """Executors encode Arrow batches; the driver pulls one partition at a time."""
    from ..sinks.files import arrow_schema

    schema = arrow_schema(df.schema)

    def encode(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                piece = batch.slice(start, batch_rows)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, piece.schema) as writer:
                    writer.write_batch(piece)
                body = sink.getvalue().to_pybytes()
                yield pa.RecordBatch.from_pydict({"ipc": pa.array([body], pa.binary())})

    def batches():
        rows = df.mapInArrow(encode, "ipc binary").toLocalIterator(prefetchPartitions=False)
        for row in rows:
            for batch in pa.ipc.open_stream(pa.py_buffer(bytes(row["ipc"]))):
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(batch.columns, schema)], schema=schema)

    return pa.RecordBatchReader.from_batches(schema, batches())


def transfer_for(stream_name: str, config: ReplicationStream, source: str | None,
                 target: str | None, env: dict, spark: SparkSession) -> Transfer:
    """The transfer one replication stream stands for."""
    stream = config.sql or stream_name
    return Transfer(
        src_conn=source, src_stream=None if config.files else stream, files=config.files,
        src_options=config.source_options, tgt_conn=target, tgt_object=config.object,
        tgt_options=config.target_options, select=config.select, where=config.where,
        transforms=config.transforms, columns=config.columns, mode=config.mode,
        primary_key=config.primary_key, update_key=config.update_key, env=env, spark=spark)
