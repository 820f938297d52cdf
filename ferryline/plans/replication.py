"""Many streams from one source to one target, and ordered step lists."""

from __future__ import annotations

import copy
import threading
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import ReplicationStream, as_list, load_document, to_json, to_plain
from ..enums import Mode, plain
from ..errors import TransferError
from ..fs import ClusterFiles
from ..sinks.files import format_of
from ..sources.connections import Connection, resolve
from ..sources.database import Database
from .steps import HookMap, StepRunner, step_from, steps_to_dict
from .transfer import join_path, local_form, transfer_for

REPORT = T.StructType([
    T.StructField("stream", T.StringType()),
    T.StructField("object", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("error", T.StringType()),
])


def stream_names(stream: str) -> dict[str, str]:
    """Template values of a stream name: a table, or a file by its last folders."""
    path = stream.replace("file://", "").rstrip("/")
    if "/" in path or format_of(path):
        folder, _, name = path.rpartition("/")
        table = name.split(".")[0]
        schema = folder.rsplit("/", 1)[-1].replace(".", "_").replace("=", "_")
    else:
        schema, _, table = path.rpartition(".")
    return {"stream_name": stream, "stream_schema": schema, "stream_table": table}


def object_name(template: str, stream: str) -> str:
    """Fill ``{stream_schema}_{stream_table}`` style target names."""
    try:
        return template.format(**stream_names(stream))
    except KeyError as missing:
        raise ValueError(f"unknown name {missing} in object template {template!r}") from None


class Replication:
    """Streams of one source loaded into one target, with shared defaults."""

    def __init__(self, source=None, target=None, defaults=None, hooks=None, streams=None,
                 env: dict | None = None, debug: bool = False, file_path: str | None = None,
                 spark: SparkSession | None = None, concurrency: int | None = None):
        self._spark = spark
        self.concurrency = concurrency
        self._hooks = threading.Lock()
        if file_path:
            document = load_document(file_path, self.spark)
            source = source or document.get("source")
            target = target or document.get("target")
            defaults = defaults or document.get("defaults")
            hooks = hooks or document.get("hooks")
            streams = streams or document.get("streams")
            env = {**(document.get("env") or {}), **(env or {})}
        self.source = source.name if isinstance(source, Connection) else source
        self.target = target.name if isinstance(target, Connection) else target
        self.defaults = ReplicationStream.from_dict(defaults)
        self.hooks = HookMap.from_dict(hooks)
        self.streams = {n: ReplicationStream.from_dict(s) for n, s in (streams or {}).items()}
        self.env = dict(env or {})
        self.debug = debug
        self.file_path = file_path

    @property
    def spark(self) -> SparkSession:
        return self._spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    # -- configuration edits -----------------------------------------------------

    def add_streams(self, streams: dict[str, Any]) -> None:
        self.streams.update({n: ReplicationStream.from_dict(s) for n, s in streams.items()})

    def enable_streams(self, names) -> None:
        for name in names:
            if name in self.streams:
                self.streams[name].enable()

    def disable_streams(self, names) -> None:
        for name in names:
            if name in self.streams:
                self.streams[name].disable()

    def set_default_mode(self, mode) -> None:
        self.defaults.mode = mode

    def to_dict(self) -> dict:
        return {"source": self.source, "target": self.target, "defaults": to_plain(self.defaults),
                "streams": to_plain(self.streams), "hooks": to_plain(self.hooks),
                "env": copy.deepcopy(self.env)}

    def to_json(self) -> str:
        return to_json(self.to_dict())

    # -- planning ----------------------------------------------------------------

    def planned(self, streams=None, tags=None) -> dict[str, ReplicationStream]:
        """Streams to run: wildcards expanded, defaults overlaid, disabled ones
        and those outside the named subset or tags left out."""
        plan: dict[str, ReplicationStream] = {}
        for name, own in self.streams.items():
            config = self.defaults.overlay(own)
            if config.disabled:
                continue
            for stream in self.expand(name, config):
                plan[stream] = copy.deepcopy(config)
        # A stream named outright wins over a wildcard that also covers it.
        for name, own in self.streams.items():
            if "*" not in name:
                if own.disabled:
                    plan.pop(name, None)
                elif name in plan:
                    plan[name] = self.defaults.overlay(own)
        wanted, labels = as_list(streams), set(as_list(tags))
        return {n: c for n, c in plan.items()
                if (not wanted or n in wanted or c.id in wanted)
                and (not labels or labels & set(c.tags or []))}

    def expand(self, name: str, config: ReplicationStream) -> list[str]:
        if "*" not in name or config.sql or config.files:
            return [name]
        location = resolve(self.source, self.env)
        if location.kind == "spark" and "/" not in name:
            schema, _, pattern = name.rpartition(".")
            tables = self.spark.catalog.listTables(schema or None, pattern or "*")
            prefix = f"{schema}." if schema else ""
            return [f"{prefix}{t.name}" for t in sorted(tables, key=lambda t: t.name)
                    if not t.isTemporary or not schema]
        if location.kind == "jdbc":
            return Database(self.spark, location.url, location.properties).tables(name)
        return ClusterFiles(self.spark).glob(local_form(join_path(location, name)))

    # -- running -----------------------------------------------------------------

    def run(self, streams=None, mode=None, range: str | None = None, tags=None,
            env: dict | None = None, raise_on_error: bool = True,
            concurrency: int | None = None) -> DataFrame:
        """Load every planned stream and return the run report as a DataFrame, in the
        order of the plan. ``concurrency`` streams run at a time, each under a job
        group of its name; streams with one target run one after another. A failed
        stream does not stop the others; it is raised at the end."""
        env = {**self.env, **(env or {})}
        runner = StepRunner(self.spark, env)
        runner.run_all(self.hooks.start)
        plan = self.planned(streams, tags)
        queues: dict[str, list[tuple[str, ReplicationStream]]] = {}
        for name, config in plan.items():
            if mode is not None:
                config.mode = mode
            queues.setdefault(self._target_of(name, config), []).append((name, config))

        def run_queue(queue) -> list[tuple]:
            context, done = self.spark.sparkContext, []
            group = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
            before = [context.getLocalProperty(key) for key in group]
            try:
                for name, config in queue:
                    context.setJobGroup(name, f"stream {name}", interruptOnCancel=True)
                    done.append(self._run_stream(name, config, range, env, runner))
            finally:
                for key, value in zip(group, before):
                    context.setLocalProperty(key, value)
            return done

        workers = min(int(concurrency or self.concurrency or 1), max(1, len(queues)))
        if workers > 1:
            with ThreadPoolExecutor(workers) as pool:
                tasks = [pool.submit(inheritable_thread_target(self.spark)(run_queue), q)
                         for q in queues.values()]
                found = [row for task in tasks for row in task.result()]
        else:
            found = [row for queue in queues.values() for row in run_queue(queue)]
        place = {name: k for k, name in enumerate(plan)}
        rows = sorted(found, key=lambda row: place[row[0]])
        failures = [f"{row[0]}: {row[6]}" for row in rows if row[3] == "error"]
        runner.run_all(self.hooks.end)
        self.steps_report = runner.report()
        if failures and raise_on_error:
            raise TransferError("; ".join(failures))
        return self.spark.createDataFrame(rows, REPORT)

    @staticmethod
    def _target_of(name: str, config: ReplicationStream) -> str:
        try:
            return object_name(config.object or "{stream_table}", name)
        except ValueError:
            return name  # told when the stream runs

    def _run_stream(self, name, config, range_text, env, runner) -> tuple:
        def hook(steps):
            with self._hooks:  # steps of streams that run together take turns
                runner.run_all(steps)

        hooks = config.hooks or HookMap()
        obj = None
        mode = plain(config.mode) or Mode.FULL_REFRESH.value
        try:
            obj = object_name(config.object or "{stream_table}", name)
            config.object = obj
            transfer = transfer_for(name, config, self.source, self.target, env, self.spark)
            transfer.range = range_text
            transfer.before_merge = lambda: hook(hooks.pre_merge)
            transfer.after_merge = lambda: hook(hooks.post_merge)
            hook(hooks.pre)
            report = transfer.run()
            hook(hooks.post)
            return (name, obj, report.mode, report.status, report.rows_in, report.rows_out, None)
        except Exception as error:
            text = str(error).strip().splitlines()[0] if str(error) else type(error).__name__
            return (name, obj, mode, "error", None, None, text)


class Pipeline:
    """An ordered list of steps with shared variables."""

    def __init__(self, steps=None, env: dict | None = None, file_path: str | None = None,
                 spark: SparkSession | None = None):
        self._spark = spark
        if file_path:
            document = load_document(file_path, self.spark)
            steps = steps or document.get("steps")
            env = {**(document.get("env") or {}), **(env or {})}
        self.steps = [step_from(s) for s in steps or []]
        self.env = dict(env or {})
        self.file_path = file_path

    @property
    def spark(self) -> SparkSession:
        return self._spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    def to_dict(self) -> dict:
        return {"steps": steps_to_dict(self.steps), "env": copy.deepcopy(self.env)}

    def to_json(self) -> str:
        return to_json(self.to_dict())

    def run(self, env: dict | None = None) -> DataFrame:
        """Run the steps in order; returns one report row per step."""
        runner = StepRunner(self.spark, {**self.env, **(env or {})})
        runner.run_all(self.steps)
        return runner.report()
