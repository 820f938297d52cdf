"""Load targets: versioned datasets, catalog tables, JDBC tables, plain files.

A target offers ``exists / read / replace / append / merge_in``; the load modes
are written once on top of these.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TargetOptions, as_list
from ..enums import plain
from ..errors import TransferError
from ..fs import ClusterFiles
from ..operators.joins import keyed_join
from ..operators.merge import any_null, key_rows
from ..operators.shape import quoted
from ..session import scratch_path
from ..sinks.files import write_files
from ..sources.database import Database, merge_statements

BUCKET = "_bucket"

#: State entries of streams start so; a batch load never drops them.
STREAM_STATE = "stream_batch"


def touched_partitions(target: DataFrame, source: DataFrame, keys, partition_by,
                       known=None) -> DataFrame | None:
    """Distinct partition values a merge changes: those of matching target rows and
    of the source rows. Only key and partition columns are read, and the target not
    at all when the key contains the partition columns (``known`` lists what the key
    determines). None means "all" (not partitioned)."""
    if not partition_by or any(p not in source.columns for p in partition_by):
        return None
    parts = [quoted(p) for p in partition_by]
    values = source.select(*parts)
    if not set(partition_by) <= set(known or keys):
        # A row may move between partitions, so find where its key is now.
        wanted = list(dict.fromkeys([*keys, *partition_by]))
        held = target.where(~any_null(keys)).select(*[quoted(c) for c in wanted])
        hit = keyed_join(held, key_rows(source, keys), keys, "left_semi")
        values = values.union(hit.select(*parts))
    return stage(values.distinct(), "touched")


def same_values(left: DataFrame, right: DataFrame, names):
    """Null-safe equality of the named columns."""
    return reduce(lambda a, b: a & b, [left[quoted(n)].eqNullSafe(right[quoted(n)])
                                       for n in names])


class VersionedDataset:
    """A file dataset that can be merged into while it is being read.

    Each load writes a new ``_version=N-id`` folder and then publishes a small
    commit file naming the folders that make up the table, the schema and the
    load state. Readers use the newest commit, so a failed load leaves the
    table as it was. Appends add a folder; a merge into a dataset partitioned
    by ``partition_by`` rewrites only the partitions it touches. A dataset without
    a natural partition can be spread over ``buckets`` folders by a hash of its
    key columns ``bucket_by``; a merge on those then rewrites the folders its
    source keys fall into, and finds them without reading the target.
    """

    counts_rows = True

    def __init__(self, spark: SparkSession, path: str, partition_by=(), fmt: str = "parquet",
                 options: TargetOptions | None = None, bucket_by=(), buckets: int = 0):
        self.spark = spark
        self.path = path.rstrip("/")
        self.format = plain(fmt)
        self.options = options or TargetOptions()
        self.files = ClusterFiles(spark)
        # Published versions never change, so what was read of them stays valid.
        self._commits: dict[int, dict] = {}
        self._frames: dict[int, DataFrame] = {}
        found = self.latest()
        self.partition_by = found["partition_by"] if found else list(partition_by)
        self.buckets = found["buckets"] if found else int(buckets)
        self.hash_by = found["hash_by"] if found else list(bucket_by) if buckets else []

    # -- commits --------------------------------------------------------------

    def versions(self) -> list[int]:
        names = self.files.names(f"{self.path}/_commits")
        return sorted(int(n.split(".")[0]) for n in names if n[0].isdigit())

    def latest(self) -> dict | None:
        numbers = self.versions()
        return self.commit_at(numbers[-1]) if numbers else None

    def commit_at(self, version: int) -> dict:
        if version not in self._commits:
            text = self.files.read_text(f"{self.path}/_commits/{version:020d}.json")
            self._commits[version] = json.loads(text)
        return self._commits[version]

    def state(self) -> dict:
        found = self.latest()
        return dict(found["state"]) if found else {}

    def exists(self) -> bool:
        return self.latest() is not None or bool(self._plain_files())

    def _plain_files(self) -> list[str]:
        return [n for n in self.files.names(self.path) if not n.startswith(("_", "."))]

    def read(self) -> DataFrame:
        found = self.latest()
        if found is None:
            if not self._plain_files():
                raise TransferError(f"nothing has been loaded at {self.path}")
            return self.spark.read.format(self.format).load(
                [f"{self.path}/{n}" for n in self._plain_files()])
        version = found["version"]
        if version not in self._frames:  # list the files of a version once
            self._frames = {version: self.read_commit(found)}
        return self._frames[version]

    def read_version(self, version: int) -> DataFrame:
        return self.read_commit(self.commit_at(version))

    def read_commit(self, found: dict) -> DataFrame:
        schema = T.StructType.fromJson(found["schema"])
        if not found["folders"]:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.format(self.format).schema(schema)
        if self.format == "csv":
            reader = reader.option("header", True)
        # The version folder is a partition column, so one scan spans versions.
        df = reader.option("basePath", self.path).load(
            [f"{self.path}/{folder}" for folder in found["folders"]])
        return df.select(*[quoted(f.name) for f in schema.fields])

    # -- writes ---------------------------------------------------------------

    @property
    def folders_by(self) -> list[str]:
        return self.partition_by + ([BUCKET] if self.hash_by else [])

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        """Add the bucket number. It is computed from the text of the key, so a
        source with another number type for it finds the same bucket."""
        if not self.hash_by or any(k not in df.columns for k in self.hash_by):
            return df
        texts = ", ".join(f"CAST({quoted(k)} AS STRING)" for k in self.hash_by)
        return df.withColumn(BUCKET, F.expr(f"CAST(pmod(xxhash64({texts}), {self.buckets}) AS INT)"))

    def _write_folder(self, df: DataFrame, version: int) -> list[str]:
        # The suffix keeps two loads that race for one version number apart: both
        # write, one publishes, the other raises with its files unreferenced.
        folder = f"_version={version}-{uuid.uuid4().hex[:8]}"
        write_files(self._with_bucket(df), f"{self.path}/{folder}", self.format, self.options,
                    partition_by=self.folders_by)
        if not self.folders_by:
            return [folder]
        depth = "/".join(["*=*"] * len(self.folders_by))
        root = f"{self.path}/{folder}/"
        leaves = self.files.glob(root + depth)
        return [leaf[leaf.index(f"/{folder}/") + 1:] for leaf in leaves]

    def _publish(self, version: int, folders: list[str], schema: T.StructType, state):
        """``state`` may be a function: it then runs once the rows are written,
        when the counts and maxima observed by that write are known."""
        commit = {
            "version": version,
            "folders": folders,
            "schema": schema.jsonValue(),
            "partition_by": self.partition_by,
            "hash_by": self.hash_by,
            "buckets": self.buckets,
            "state": state() if callable(state) else state,
        }
        path = f"{self.path}/_commits/{version:020d}.json"
        if not self.files.create_text(path, json.dumps(commit)):
            raise VersionTaken(f"another load published version {version} of {self.path}")

    def replace(self, df: DataFrame, state=None) -> None:
        """New contents, whatever was there: the load published last counts. Marks
        of the old contents go, the batch ids of streams stay."""
        self._replace_after(self.latest(), df, state)

    def _replace_after(self, found: dict | None, df: DataFrame, state) -> None:
        version = found["version"] + 1 if found else 1
        streams = {k: v for k, v in (found["state"] if found else {}).items()
                   if k.startswith(STREAM_STATE)}
        folders = self._write_folder(df, version)
        self._publish(version, folders, df.schema, lambda: {**streams, **_state(state)})

    def append(self, df: DataFrame, state=None) -> None:
        found = self.latest()
        if found is None:
            if self._plain_files():  # adopt a dataset written by something else
                df = self.read().unionByName(df, allowMissingColumns=True)
            return self._replace_after(None, df, state)
        folders = self._write_folder(df, found["version"] + 1)
        added = _state(state)
        while True:  # added rows fit behind whatever others have published meanwhile
            schema = T.StructType.fromJson(found["schema"])
            names = {f.name for f in schema.fields}
            schema = T.StructType(
                schema.fields + [f for f in df.schema.fields if f.name not in names])
            try:
                return self._publish(found["version"] + 1, found["folders"] + folders, schema,
                                     {**found["state"], **added})
            except VersionTaken:
                found = self.latest()

    def merge_in(self, source: DataFrame, keys, merged, state=None,
                 keep_state: bool = False, whole: bool = False) -> None:
        """Rewrite what ``merged(target_rows)`` changes and keep the rest.

        ``merged`` is the merge as a function of the target rows it may see.
        """
        # Pinned: the merge is published as the successor of the version it read,
        # or not at all if another load got there first.
        found = self.latest()
        old = found["state"] if found else {}
        new_state = old if keep_state else (lambda: {**old, **_state(state)})
        touched = None
        if not whole and found is not None:
            # The bucket follows from the key, so it counts as part of it.
            known = [*keys, BUCKET] if set(self.hash_by) <= set(keys) else keys
            touched = touched_partitions(self._with_bucket(self.read()), self._with_bucket(source),
                                         keys, self.folders_by, known=known)
        if touched is None:
            return self._replace_after(found, merged(self.read()), new_state)
        if touched.isEmpty():
            return None
        inside = self._folders_of(found, touched)
        outside = [f for f in found["folders"] if f not in inside]
        rows = self.read_commit({**found, "folders": sorted(inside)})
        result = merged(rows)
        folders = self._write_folder(result, found["version"] + 1)
        self._publish(found["version"] + 1, outside + folders, result.schema, new_state)
        return None

    def _folders_of(self, found: dict, touched: DataFrame) -> set[str]:
        """Folders of a commit that hold the touched values, compared as values:
        what their names say, read back as the columns' types."""
        rows = [(f, *_folder_values(f, len(self.folders_by))) for f in found["folders"]]
        names = [f"p{i}" for i in range(len(self.folders_by))]
        texts = self.spark.createDataFrame(
            rows, T.StructType([T.StructField(n, T.StringType()) for n in ["folder", *names]]))
        typed = texts.select("folder", *[
            F.col(n).cast(touched.schema[p].dataType).alias(p)
            for n, p in zip(names, self.folders_by)])
        hit = typed.join(touched, same_values(typed, touched, self.folders_by), "left_semi")
        return {r["folder"] for r in hit.select("folder").collect()}

    def compact(self) -> None:
        """Rewrite the rows of many small loads as one version."""
        self.replace(self.read(), self.state())

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete version folders no kept commit refers to."""
        numbers = self.versions()
        kept = numbers[-keep:]
        used = {f.split("/", 1)[0] for n in kept for f in self.commit_at(n)["folders"]}
        removed = []
        self._commits.clear()
        for name in self.files.names(self.path):
            if name.startswith("_version=") and name not in used:
                self.files.remove(f"{self.path}/{name}")
                removed.append(name)
        for n in numbers[:-keep]:
            self.files.remove(f"{self.path}/_commits/{n:020d}.json")
        return removed


class VersionTaken(TransferError):
    """Another load has published the version this one would have become."""


def _state(state) -> dict:
    return (state() if callable(state) else state) or {}


def _folder_values(folder: str, parts: int) -> list[str | None]:
    """Partition values a folder's name holds, as text; null has a name of its own."""
    values = [unquote(p.split("=", 1)[1]) for p in folder.split("/")[-parts:]]
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]


@contextmanager
def overwriting_partitions(spark: SparkSession, mode: str = "dynamic"):
    """Inserts that overwrite replace only the partitions they write (dynamic) or
    the whole table (static). This is a session setting: insertInto takes no
    writer option for it."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class CatalogTable:
    """A table of the session catalog in a built-in file format.

    Results that depend on the table itself are written to the shared scratch
    folder first, because a table cannot be overwritten while it is read.
    """

    counts_rows = True

    def __init__(self, spark: SparkSession, name: str, options: TargetOptions | None = None):
        self.spark = spark
        self.name = name
        self.options = options or TargetOptions()
        keys = self.options.table_keys or {}
        self.partition_by = as_list(keys.get("partition"))
        self.bucket_by = as_list(keys.get("bucket"))
        self.sort_by = as_list(keys.get("sort"))
        self.buckets = int(keys.get("buckets", 0) or 0)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def state(self) -> dict:
        return {}

    def replace(self, df: DataFrame, state=None) -> None:
        if self.options.table_ddl:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            self.spark.sql(self.options.table_ddl.replace("{table}", self.name))
            columns = self.read().columns
            df.select(*[quoted(c) for c in columns]).write.insertInto(self.name)
            return
        writer = df.write.mode("overwrite").format("parquet")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if self.bucket_by and self.buckets:
            writer = writer.bucketBy(self.buckets, *self.bucket_by)
            if self.sort_by:
                writer = writer.sortBy(*self.sort_by)
        writer.saveAsTable(self.name)

    def append(self, df: DataFrame, state=None) -> None:
        if not self.exists():
            return self.replace(df)
        missing = [c for c in df.columns if c not in self.read().columns]
        if missing:
            added = ", ".join(f"{quoted(c)} {df.schema[c].dataType.simpleString()}"
                              for c in missing)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({added})")
        columns = self.read().columns
        gaps = [c for c in columns if c not in df.columns]
        kinds = self.read().schema
        df = df.selectExpr("*", *[f"CAST(NULL AS {kinds[c].dataType.simpleString()}) AS {quoted(c)}"
                                  for c in gaps])
        df.select(*[quoted(c) for c in columns]).write.insertInto(self.name)
        return None

    def overwrite_rows(self, df: DataFrame) -> None:
        """New contents under the existing definition."""
        staged = stage(df, "table").select(*[quoted(c) for c in self.read().columns])
        with overwriting_partitions(self.spark, "static"):
            staged.write.insertInto(self.name, overwrite=True)

    def partitions(self) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]

    def merge_in(self, source, keys, merged, state=None, keep_state=False, whole=False) -> None:
        """Rewrite the touched partitions of a partitioned table, else the table."""
        parts = self.partitions()
        target = self.read()
        touched = None if whole else touched_partitions(target, source, keys, parts)
        if touched is not None:
            if not touched.isEmpty():
                self._rewrite_partitions(target, parts, touched, merged)
            return
        result = merged(target)
        if result.schema.names != target.columns or _kinds(result) != _kinds(target):
            self.replace(stage(result, "table"))
        else:
            self.overwrite_rows(result)

    def _rewrite_partitions(self, target: DataFrame, parts, touched, merged) -> None:
        inside = target.join(touched, same_values(target, touched, parts), "left_semi")
        result = merged(inside)
        missing = [f for f in result.schema if f.name not in target.columns]
        if missing:
            added = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({added})")
        columns = self.read().columns
        staged = stage(result, "table").select(*[quoted(c) for c in columns])
        with overwriting_partitions(self.spark):
            staged.write.insertInto(self.name, overwrite=True)
        # Dynamic overwrite leaves partitions the merge has emptied; drop those.
        filled = staged.select(*[quoted(p) for p in parts]).distinct()
        emptied = touched.join(filled, same_values(touched, filled, parts), "left_anti")
        texts = [F.col(quoted(p)).cast("string").alias(p) for p in parts]
        for row in emptied.select(*texts).collect():  # partitions, not rows
            spec = ", ".join(f"{quoted(p)} = {_sql_text(row[p])}" for p in parts)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")


def _sql_text(value: str | None) -> str:
    if value is None:
        return "null"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


class JdbcTable:
    """A database table reached over JDBC."""

    counts_rows = False  # the JDBC writer does not report observed metrics

    def __init__(self, spark: SparkSession, url: str, table: str, properties: dict | None = None,
                 options: TargetOptions | None = None):
        self.spark = spark
        self.url = url
        self.table = table
        self.properties = dict(properties or {})
        self.options = options or TargetOptions()

    def _reader(self):
        return self.spark.read.format("jdbc").option("url", self.url).options(**self.properties)

    @property
    def database(self) -> Database:
        return Database(self.spark, self.url, self.properties)

    def exists(self) -> bool:
        """From the database's catalog. A lost connection is an error: taken for an
        absent table it would overwrite one."""
        return self.database.has_table(self.table)

    def read(self) -> DataFrame:
        return self._reader().option("dbtable", self.table).load()

    def merge_by_statements(self, source: DataFrame, keys, strategy: str,
                            delete_missing: bool = False) -> None:
        """Write the source rows to a table of their own, by many tasks, and merge
        that table in one transaction: the target's other rows stay where they are."""
        staging = f"{self.table}_in_{uuid.uuid4().hex[:12]}"
        rows = JdbcTable(self.spark, self.url, staging, self.properties, self.options)
        rows.append(source)
        try:
            self.database.run_together(merge_statements(
                self.table, staging, keys, source.columns, strategy, delete_missing))
        finally:
            self.database.run_together([f"DROP TABLE {staging}"])

    def state(self) -> dict:
        return {}

    def _write(self, df: DataFrame, mode: str, truncate: bool = False) -> None:
        if self.options.concurrency:
            df = df.repartition(int(self.options.concurrency))
        writer = (df.write.format("jdbc").mode(mode).option("url", self.url)
                  .option("dbtable", self.table).options(**self.properties))
        if self.options.batch_limit:
            writer = writer.option("batchsize", int(self.options.batch_limit))
        elif self.options.use_bulk is False:
            writer = writer.option("batchsize", 1)
        if truncate:
            writer = writer.option("truncate", True)
        writer.save()

    def replace(self, df: DataFrame, state=None) -> None:
        self._write(df, "overwrite")

    def append(self, df: DataFrame, state=None) -> None:
        self._write(df, "append")

    def overwrite_rows(self, df: DataFrame) -> None:
        self._write(stage(df, "jdbc"), "overwrite", truncate=True)

    def merge_in(self, source, keys, merged, state=None, keep_state=False, whole=False) -> None:
        self.overwrite_rows(merged(self.read()))


class FileTarget:
    """A plain file dataset: whole loads and appends, no keyed merges."""

    counts_rows = True

    def __init__(self, spark: SparkSession, path: str, fmt: str,
                 options: TargetOptions | None = None):
        self.spark = spark
        self.path = path
        self.format = fmt
        self.options = options or TargetOptions()

    def exists(self) -> bool:
        return ClusterFiles(self.spark).exists(self.path)

    def read(self) -> DataFrame:
        from ..sources.files import read_files

        options = {"format": self.format, "header": self.options.header,
                   "delimiter": self.options.delimiter, "flatten": True}
        return read_files(self.spark, self.path, options, infer=True)

    def state(self) -> dict:
        return {}

    def replace(self, df: DataFrame, state=None) -> None:
        keys = self.options.table_keys or {}
        write_files(df, self.path, self.format, self.options,
                    partition_by=as_list(keys.get("partition")))

    def append(self, df: DataFrame, state=None) -> None:
        write_files(df, self.path, self.format, self.options, mode="append")

    def merge_in(self, source, keys, merged, state=None, keep_state=False, whole=False) -> None:
        raise TransferError(f"keyed loads need a parquet or table target, not {self.format} files")


def _kinds(df: DataFrame):
    return [f.dataType for f in df.schema.fields]


_copies: ContextVar[list[str] | None] = ContextVar("copies", default=None)


@contextmanager
def staged_for_now(spark: SparkSession):
    """Copies staged inside are removed at the end, whether it is reached or not.
    Named copies (``at``) are the caller's and stay."""
    copies: list[str] = []
    token = _copies.set(copies)
    try:
        yield
    finally:
        _copies.reset(token)
        for path in copies:
            ClusterFiles(spark).remove(path)


def stage(df: DataFrame, label: str, at: str | None = None) -> DataFrame:
    """Write once and read back: the source is extracted one time, the copy
    survives lost executors, and its size is known exactly to the join planner.

    The copy goes to the shared folder, or to the path or table ``at``.
    """
    spark = df.sparkSession
    if at and "/" not in at:
        df.write.mode("overwrite").saveAsTable(at)
        return spark.table(at)
    path = at or scratch_path(spark, label)
    copies = _copies.get()
    if copies is not None and not at:
        copies.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
