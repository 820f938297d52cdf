"""Steps and hooks: small table actions before, between and after loads."""

from __future__ import annotations

import copy
import dataclasses
import logging
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..config import Config, SourceOptions, TargetOptions, as_list, to_plain
from ..errors import CheckFailed, TransferError, UnsupportedError
from ..sources.connections import execute_sql, resolve

log = logging.getLogger("ferryline")


@dataclass(kw_only=True)
class Step(Config):
    """Fields every step has; ``if`` and ``on_failure`` steer the run."""

    kind = ""
    document_keys = {"if_condition": "if"}

    id: str | None = None
    if_condition: str | None = None
    on_failure: str | None = None

    def to_dict(self) -> dict:
        return {"type": self.kind, **super().to_dict()}


@dataclass
class StepQuery(Step):
    kind = "query"
    connection: str
    query: str
    transient: bool | None = None
    into: str | None = None


@dataclass
class StepCheck(Step):
    kind = "check"
    check: str
    failure_message: str | None = None
    vars: dict | None = None


@dataclass
class StepCopy(Step):
    kind = "copy"
    document_keys = {**Step.document_keys, "from_": "from"}
    from_: str
    to: str
    recursive: bool | None = None

    def __post_init__(self):
        if not self.from_ or not self.to:
            raise ValueError("a copy step needs both from and to")


@dataclass
class StepInspect(Step):
    kind = "inspect"
    location: str | None = None
    connection: str | None = None
    path: str | None = None
    recursive: bool | None = None


@dataclass
class StepList(Step):
    kind = "list"
    location: str | None = None
    connection: str | None = None
    path: str | None = None
    recursive: bool | None = None
    only: str | None = None


@dataclass
class StepReplication(Step):
    kind = "replication"
    document_keys = {**Step.document_keys, "range_param": "range"}
    path: str
    working_dir: str | None = None
    range_param: str | None = None
    mode: Any = None
    streams: list | None = None
    env: dict | None = None


@dataclass
class StepGroup(Step):
    kind = "group"
    steps: list
    loop: Any = None
    env: dict | None = None

    def __post_init__(self):
        self.steps = [step_from(s) for s in self.steps or []]


@dataclass
class StepLog(Step):
    kind = "log"
    message: str
    level: str | None = None


@dataclass
class StepStore(Step):
    kind = "store"
    key: str
    value: Any = None
    delete: bool | None = None


@dataclass
class StepHTTP(Step):
    kind = "http"
    url: str
    method: str | None = None
    payload: str | None = None
    headers: dict | None = None


@dataclass
class StepCommand(Step):
    kind = "command"
    document_keys = {**Step.document_keys, "print_output": "print"}
    command: list
    print_output: bool | None = None
    capture: bool | None = None
    working_dir: str | None = None
    env: dict | None = None


@dataclass
class StepRead(Step):
    kind = "read"
    document_keys = {**Step.document_keys, "from_": "from"}
    from_: str
    into: str | None = None

    def __post_init__(self):
        if not self.from_:
            raise ValueError("a read step needs from")


@dataclass
class StepWrite(Step):
    kind = "write"
    to: str
    content: str


@dataclass
class StepDelete(Step):
    kind = "delete"
    location: str | None = None
    connection: str | None = None
    path: str | None = None
    recursive: bool | None = None


STEP_TYPES = {c.kind: c for c in (
    StepQuery, StepCheck, StepCopy, StepInspect, StepList, StepReplication, StepGroup, StepLog,
    StepStore, StepHTTP, StepCommand, StepRead, StepWrite, StepDelete)}


def step_from(value) -> Step:
    """A step object, or its document form."""
    if isinstance(value, Step):
        return copy.deepcopy(value)
    data = dict(value)
    kind = data.pop("type", None)
    if kind not in STEP_TYPES:
        raise ValueError(f"unknown step type {kind!r}")
    return STEP_TYPES[kind].from_dict(data)


def steps_to_dict(steps) -> list[dict]:
    return [to_plain(step_from(s)) for s in steps or []]


@dataclass
class HookMap(Config):
    """Steps at the points around a run (start, end) and a load."""

    start: list = field(default_factory=list)
    end: list = field(default_factory=list)
    pre: list = field(default_factory=list)
    post: list = field(default_factory=list)
    pre_merge: list = field(default_factory=list)
    post_merge: list = field(default_factory=list)

    def __post_init__(self):
        for spec in dataclasses.fields(self):
            setattr(self, spec.name, [step_from(s) for s in getattr(self, spec.name) or []])

    def to_dict(self) -> dict:
        return {k: v for k, v in super().to_dict().items() if v}


# -- table forms of single steps -------------------------------------------------


def run_checks(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Boolean aggregates over a table -> one ``(check_name, passed)`` row each,
    all from one scan."""
    results = df.agg(*[F.expr(text).cast("boolean").alias(name) for name, text in checks.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"),
                              F.coalesce(F.col(f"`{n}`"), F.lit(False)).alias("passed"))
                     for n in checks])
    return results.select(F.inline(rows))


def list_files(spark: SparkSession, path: str, recursive: bool = False, only: str | None = None
               ) -> DataFrame:
    """Files below ``path``: name, size and time; their content is not read.
    ``only`` is a file-name pattern."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", bool(recursive))
    if only and only not in ("files", "file"):
        reader = reader.option("pathGlobFilter", only)
    return reader.load(path).select("path", "length", "modificationTime")


def copy_dataset(spark: SparkSession, source: str, target: str, source_options=None,
                 target_options=None) -> DataFrame:
    """Copy a dataset, converting when the two paths name different formats."""
    from .transfer import Transfer

    src = SourceOptions.from_dict(source_options)
    if src.flatten is None:
        src.flatten = True
    Transfer(src_stream=source, src_options=src, tgt_object=target,
             tgt_options=TargetOptions.from_dict(target_options), spark=spark).run()
    return spark.createDataFrame([(source, target)], "source string, target string")


def loop_values(loop) -> list:
    """``[a, b]``, ``1..3`` or ``{"range": "1..3"}`` -> the values looped over."""
    if loop is None:
        return [None]
    if isinstance(loop, dict):
        loop = loop.get("range")
    if isinstance(loop, str):
        start, sep, end = loop.partition("..")
        if not sep:
            return as_list(loop)
        return list(range(int(start), int(end) + 1))
    return list(loop)


def fan_out(values, build, column_name: str = "loop_value") -> DataFrame:
    """One table step per value, the results stacked with the value as a column."""
    out = None
    for value in values:
        part = build(value).withColumn(column_name, F.lit(value))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to loop over")
    return out


# -- running steps ------------------------------------------------------------------

REPORT = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])

# on_failure words that let the run go on.
TOLERANT = {"warn", "continue", "skip", "quiet", "ignore"}


class StepRunner:
    """Runs steps in order and keeps one report row per step."""

    def __init__(self, spark: SparkSession, env: dict | None = None):
        self.spark = spark
        self.env = dict(env or {})
        self.store: dict[str, Any] = {}
        self.results: list[dict] = []
        self.last_view: str | None = None

    def report(self) -> DataFrame:
        return self.spark.createDataFrame(
            [[r[f] for f in REPORT.names] for r in self.results], REPORT)

    def run_all(self, steps) -> None:
        for step in steps:
            self.run(step_from(step))

    def run(self, step: Step) -> str:
        row = {"step": len(self.results) + 1, "id": step.id, "type": step.kind,
               "status": "success", "message": None}
        self.results.append(row)
        try:
            if step.if_condition and not self.holds(step.if_condition):
                row["status"] = "skipped"
            else:
                row["message"] = getattr(self, f"_run_{step.kind}")(step)
        except Exception as error:
            row["status"] = "error"
            row["message"] = str(error).strip().splitlines()[0] if str(error) else None
            if (step.on_failure or "abort") not in TOLERANT:
                raise
            log.warning("step %s failed: %s", step.id or step.kind, row["message"])
        return row["status"]

    def holds(self, condition: str) -> bool:
        """A condition is a Spark SQL expression over ``env``, ``store`` and the
        earlier ``steps`` (``steps.<id>.status``, ``steps.<id>.success``)."""
        text = re.sub(r"^\s*\$?\{\{?(.*?)\}?\}\s*$", r"\1", condition, flags=re.DOTALL)
        scope = self.spark.range(1).select(
            _literal_struct(self.env).alias("env"),
            _literal_struct(self.store).alias("store"),
            _literal_struct({r["id"]: {"status": r["status"], "success": r["status"] == "success"}
                             for r in self.results[:-1] if r["id"]}).alias("steps"))
        return bool(scope.select(F.expr(text).alias("ok")).first()["ok"])

    def _args(self, text: str, extra: dict | None = None) -> dict | None:
        known = {**self.env, **self.store, **(extra or {})}
        used = {k: v for k, v in known.items() if re.search(rf":{re.escape(str(k))}\b", text)}
        return used or None

    def _run_query(self, step: StepQuery):
        from .transfer import SQL_TEXT

        location = resolve(step.connection, self.env)
        if location.kind == "jdbc" and SQL_TEXT.match(step.query):
            from ..sources.connections import sql_frame

            result = sql_frame(self.spark, location, step.query)
        else:
            result = execute_sql(self.spark, location, step.query, self._args(step.query))
        if step.into:
            if result is None:
                raise TransferError("a statement without rows cannot fill a view")
            result.createOrReplaceTempView(step.into)
            self.last_view = step.into
        return None

    def _run_check(self, step: StepCheck):
        values = dict(step.vars or {})
        table = values.pop("table", None) or self.last_view
        args = self._args(step.check, values)
        if table is None:
            query = f"SELECT ({step.check}) AS passed"
        else:
            query = f"SELECT ({step.check}) AS passed FROM {table}"
        try:  # an aggregate check gives one row by itself
            passed = self.spark.sql(f"SELECT bool_and(({step.check})) AS passed FROM {table}"
                                    if table else query, args=args).first()["passed"]
        except AnalysisException:
            passed = self.spark.sql(query, args=args).first()["passed"]
        if not passed:
            raise CheckFailed(step.failure_message or f"check failed: {step.check}")

    def _files_of(self, step) -> str:
        from .transfer import join_path, local_form

        if step.location:
            return local_form(step.location)
        location = resolve(step.connection or "LOCAL", self.env)
        return local_form(join_path(location, step.path or ""))

    def _run_list(self, step: StepList):
        found = list_files(self.spark, self._files_of(step), bool(step.recursive), step.only)
        return self._keep(step, found)

    def _run_inspect(self, step: StepInspect):
        found = list_files(self.spark, self._files_of(step), True).agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("modified"))
        return self._keep(step, found)

    def _keep(self, step, df: DataFrame):
        if step.id:
            df.createOrReplaceTempView(step.id)
            self.last_view = step.id

    def _run_copy(self, step: StepCopy):
        copy_dataset(self.spark, step.from_, step.to)

    def _run_replication(self, step: StepReplication):
        from .replication import Replication

        path = f"{step.working_dir.rstrip('/')}/{step.path}" if step.working_dir else step.path
        Replication(file_path=path, env={**self.env, **(step.env or {})}, spark=self.spark).run(
            streams=step.streams, mode=step.mode, range=step.range_param)

    def _run_group(self, step: StepGroup):
        outer = self.env
        for value in loop_values(step.loop):
            self.env = {**outer, **(step.env or {})}
            if value is not None:
                self.env["loop_value"] = value
            try:
                self.run_all(step.steps)
            finally:
                self.env = outer

    def _run_log(self, step: StepLog):
        log.log(getattr(logging, (step.level or "info").upper(), logging.INFO), step.message)
        return step.message

    def _run_store(self, step: StepStore):
        if step.delete:
            self.store.pop(step.key, None)
        else:
            self.store[step.key] = step.value

    def _unsupported(self, step):
        raise UnsupportedError(f"{step.kind} steps have no Spark form and are not run")

    _run_http = _run_command = _run_read = _run_write = _run_delete = _unsupported


def _literal_struct(values: dict):
    if not values:
        return F.lit(None)
    parts = []
    for key, value in values.items():
        inner = _literal_struct(value) if isinstance(value, dict) else F.lit(
            value if isinstance(value, (str, int, float, bool, type(None))) else str(value))
        parts.append(inner.alias(str(key)))
    return F.struct(*parts)


# The same classes under their hook names.
Hook = Step
HookQuery = StepQuery
HookHTTP = StepHTTP
HookCheck = StepCheck
HookRead = StepRead
HookWrite = StepWrite
HookCopy = StepCopy
HookDelete = StepDelete
HookLog = StepLog
HookInspect = StepInspect
HookList = StepList
HookReplication = StepReplication
HookCommand = StepCommand
HookGroup = StepGroup
HookStore = StepStore
