"""A whole specification over landed responses.

Endpoints run in the order their queues and ``depends_on`` ask for. Responses are
rows ``(endpoint, page, status, body)``, with ``value`` where an endpoint iterates:
the value its request was made for. What an endpoint hands on is stored: its
records, the values of its queues, and the state it keeps for the next run, which
is published after the records were loaded.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import as_list
from ..enums import plain
from ..errors import TransferError
from ..fs import ClusterFiles
from ..functions.language import expression, rendered, rendered_state
from ..functions.paths import extract_variants, record_schema
from ..operators.joins import keyed_join
from ..session import one_row
from . import extract
from .apispec import ApiSpec, Endpoint, Iterate, Processor, Records, endpoint_stream
from .targets import stage
from .transfer import Transfer


class SyncStore:
    """State kept between runs: one small file per endpoint and run; the newest counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), ClusterFiles(spark)

    def _runs(self, endpoint: str) -> list[str]:
        return [n for n in self.files.names(f"{self.path}/{endpoint}") if n.endswith(".json")]

    def read(self, endpoint: str) -> dict:
        runs = self._runs(endpoint)
        if not runs:
            return {}
        kept = json.loads(self.files.read_text(f"{self.path}/{endpoint}/{runs[-1]}"))
        row = one_row(self.spark).select(*[F.lit(v["value"]).cast(v["type"]).alias(n)
                                         for n, v in kept.items()]).first()
        return row.asDict()

    def publish(self, endpoint: str, values: dict[str, tuple[str, str]]) -> None:
        """``values``: name -> (text, type). Fails where another run was quicker."""
        document = {n: {"value": v, "type": t} for n, (v, t) in values.items()}
        name = f"{self.path}/{endpoint}/{len(self._runs(endpoint)):08d}.json"
        if not self.files.create_text(name, json.dumps(document)):
            raise TransferError(f"another run published the state of {endpoint} first")


@dataclass
class EndpointRun:
    """What one endpoint gave."""

    name: str
    records: DataFrame
    pages: dict[str, int]                    # number of pages by what the rules said
    state: dict = field(default_factory=dict)
    collected: dict[str, DataFrame] = field(default_factory=dict)
    rows_loaded: int | None = None


class SpecRun:
    """One run of a specification.

    ``schemas``: record types by endpoint; where one is missing, JSON records are
    looked through for theirs. ``sync_path``: folder of the state kept between
    runs. ``target``: object name with ``{endpoint}`` to load each endpoint's
    records into, by its keys and overrides; without it they are only returned.
    """

    def __init__(self, responses: DataFrame, spec: ApiSpec, schemas: dict | None = None,
                 inputs: dict | None = None, sync_path: str | None = None,
                 target: str | None = None, target_conn: str | None = None):
        problems = spec.validate()
        if problems:
            raise TransferError("; ".join(problems))
        self.spark, self.responses, self.spec = responses.sparkSession, responses, spec
        self.schemas, self.inputs = schemas or {}, inputs or {}
        self.sync = SyncStore(self.spark, sync_path) if sync_path else None
        self.target, self.target_conn = target, target_conn
        self.queues: dict[str, DataFrame] = {}
        self.runs: dict[str, EndpointRun] = {}

    def run(self, endpoints: list[str] | None = None) -> dict[str, EndpointRun]:
        """Every enabled endpoint, or those named and what comes before them in
        queues; then the dynamic ones."""
        for name in self.spec.run_order():
            if endpoints is None or name in endpoints or self._feeds(name, endpoints):
                self.runs[name] = self._endpoint(name)
        if endpoints is None:
            for k in range(len(self.spec.dynamic_endpoints or [])):
                self.runs.update(self._dynamic(k))
        return self.runs

    def report(self) -> DataFrame:
        """``endpoint, action, pages``: what became of every landed page that was read."""
        rows = [(r.name, action, n) for r in self.runs.values() for action, n in r.pages.items()]
        return self.spark.createDataFrame(rows, "endpoint string, action string, pages long")

    # -- one endpoint ------------------------------------------------------------

    def _feeds(self, name: str, wanted: list[str]) -> bool:
        outputs = {p.output for p in self._processors(self.spec.effective(name))}
        return any(_over(self.spec.effective(w)) in outputs for w in wanted if w != name)

    @staticmethod
    def _processors(endpoint: Endpoint) -> list[Processor]:
        return (endpoint.response.processors if endpoint.response else None) or []

    def _state(self, endpoint: Endpoint, kept: dict) -> dict:
        sync = {**{n: None for n in endpoint.sync or []}, **kept}
        return rendered_state(self.spark, endpoint.state,
                              {"sync": sync, "inputs": self.inputs})

    def _endpoint(self, name: str) -> EndpointRun:
        endpoint = self.spec.effective(name)
        kept = self.sync.read(name) if self.sync and endpoint.sync else {}
        state = self._state(endpoint, kept)
        responses = self.responses.where(F.col("endpoint") == name)
        values, into = self._values(endpoint, state)
        return self._extract(endpoint, responses, state, values, into, kept)

    def _values(self, endpoint: Endpoint, state: dict) -> tuple[DataFrame | None, str | None]:
        """The values an endpoint iterates over, one ``value`` text per row."""
        over = _over(endpoint)
        if over is None:
            return None, None
        into = endpoint.iterate.into if isinstance(endpoint.iterate, Iterate) else None
        if isinstance(over, str) and over.startswith("queue."):
            queue = self.queues.get(over.removeprefix("queue."))
            if queue is None:
                return self.spark.createDataFrame([], "value string"), into
            return queue, into
        if isinstance(over, str) and over.startswith("state."):
            held = state.get(over.removeprefix("state."))
        else:
            held = rendered(self.spark, over, {"state": state, "inputs": self.inputs})
        listed = held if isinstance(held, (list, tuple)) else as_list(held)
        return self.spark.createDataFrame([(str(v),) for v in listed], "value string"), into

    def _record_type(self, endpoint: Endpoint, responses: DataFrame) -> T.StructType:
        schema = self.schemas.get(endpoint.name)
        if schema is not None:
            return schema
        response = endpoint.response
        if plain(response.format if response else None) not in (None, "", "json"):
            raise TransferError(f"the record type of endpoint {endpoint.name} must be given")
        records = (response.records if response else None) or Records()
        found = extract_variants(responses, "body", records.jmespath or records.jq or "[]")
        schema = record_schema(found, "record")
        # A field that no record has, but an expression or key names, is a null text.
        text = " ".join(f"{p.expression} {p.if_condition}" for p in self._processors(endpoint))
        named = re.findall(r"\brecord\.(\w+)", text) + (
            as_list(records.primary_key) if not records.casing and not records.select else [])
        made = [(p.output or "").removeprefix("record.") for p in self._processors(endpoint)
                if (p.output or "").startswith("record.")]
        for name in dict.fromkeys(named):
            if name not in schema.names and name not in made:
                schema = schema.add(name, T.StringType())
        return schema

    def _extract(self, endpoint: Endpoint, responses: DataFrame, state: dict,
                 values: DataFrame | None, into: str | None, kept: dict) -> EndpointRun:
        by, scope = ["endpoint"], extract.state_struct(state)
        if values is not None:
            by.append("value")
            distinct = values.select(F.col("value").cast("string")).where(
                "value IS NOT NULL").distinct()
            responses = keyed_join(responses.withColumn("value", F.col("value").cast("string")),
                                   distinct, ["value"], "inner")
            if into:
                own = F.col("value").alias(into.removeprefix("state."))
                fields = [F.lit(v).alias(k) for k, v in state.items()
                          if isinstance(v, (str, int, float, bool))
                          and k != into.removeprefix("state.")]
                scope = F.struct(*fields, own)
        schema = self._record_type(endpoint, responses)
        response = endpoint.response
        routed = stage(extract.apply_rules(responses, (response.rules if response else None) or []),
                       "routed")
        rows = extract.endpoint_rows(routed, endpoint, schema, by, scope)
        rows = stage(self._fresh(rows, endpoint, kept), "rows")
        run = EndpointRun(endpoint.name, rows, extract.action_counts(routed))
        self._outputs(endpoint, rows, run)
        names = rows.schema["record"].dataType.names
        records = (response.records if response else None) or Records()
        flat = rows.select("endpoint", "page", "pos", *[F.col("record")[n].alias(n) for n in names])
        run.records = stage(extract.shape_records(flat, records), "records")
        if self.target:
            run.rows_loaded = self._load(endpoint, run.records)
        if self.sync and endpoint.sync:
            self._publish(endpoint, rows, run, kept)
        return run

    def _fresh(self, rows: DataFrame, endpoint: Endpoint, kept: dict) -> DataFrame:
        """Less the records at or below the kept maximum: they were loaded before."""
        for p in self._processors(endpoint):
            name = (p.output or "").removeprefix("state.")
            if name in (endpoint.sync or []) and plain(p.aggregation) == "maximum" and \
                    kept.get(name) is not None:
                value = expression(rows, p.expression)
                rows = rows.where(value.isNull() | (value > F.lit(kept[name])))
        return rows

    def _outputs(self, endpoint: Endpoint, rows: DataFrame, run: EndpointRun) -> None:
        """Queue, state and collected outputs of the processors."""
        reducing, queued = [], {}
        for p in self._processors(endpoint):
            output = p.output or ""
            if output.startswith("queue."):
                values = extract.queue_values(rows, p).select(F.col("value").cast("string"))
                queued.setdefault(output.removeprefix("queue."), []).append(values)
            elif output.startswith("state."):
                if plain(p.aggregation) == "collect":
                    order = [c for c in ("page", "value", "pos") if c in rows.columns]
                    run.collected[output.removeprefix("state.")] = extract.collect_values(
                        rows, p, by=(), order=order)
                else:
                    reducing.append(p)
        for name, parts in queued.items():
            before = [self.queues[name]] if name in self.queues else []
            self.queues[name] = stage(reduce(DataFrame.union, before + parts), "queue")
        if reducing:
            row = extract.aggregate_state(rows, reducing, by=()).first()
            run.state = row.asDict()

    def _load(self, endpoint: Endpoint, records: DataFrame) -> int | None:
        stream = endpoint_stream(endpoint)
        done = Transfer(input=records, tgt_conn=self.target_conn,
                        tgt_object=(stream.object or self.target).replace(
                            "{endpoint}", endpoint.name),
                        mode=stream.mode or "full-refresh", primary_key=stream.primary_key,
                        update_key=None, spark=self.spark).run()
        return done.rows_in

    def _publish(self, endpoint: Endpoint, rows: DataFrame, run: EndpointRun, kept: dict) -> None:
        found = {}
        for p in self._processors(endpoint):
            name = (p.output or "").removeprefix("state.")
            if name in endpoint.sync and name in run.state:
                kind = rows.select(expression(rows, p.expression).alias("v")).schema["v"].dataType
                value = run.state[name] if run.state[name] is not None else kept.get(name)
                text = one_row(self.spark).select(
                    F.lit(value).cast(kind).cast("string")).first()[0]
                found[name] = (text, kind.simpleString())
        self.sync.publish(endpoint.name, found)

    # -- dynamic endpoints ---------------------------------------------------------

    def _dynamic(self, k: int) -> dict[str, EndpointRun]:
        """Endpoints made from the values that setup calls collect. The responses of
        call j of block k are landed as ``dynamic_endpoints[k].setup[j]``; those of
        the endpoints under the names their template gives. All of them run in one
        plan, with the value in the state of every record."""
        block = self.spec.dynamic_endpoints[k]
        state = rendered_state(self.spark, self.spec.defaults.state if self.spec.defaults else None,
                               {"sync": {}, "inputs": self.inputs})
        lists: dict[str, DataFrame] = {}
        for j, call in enumerate(block.setup or []):
            name = f"dynamic_endpoints[{k}].setup[{j}]"
            inner = Endpoint(name=name, response=call.response, pagination=call.pagination)
            values = lists.get((call.iterate or "").removeprefix("state."))
            responses = self.responses.where(F.col("endpoint") == name)
            run = self._extract(inner, responses, state, values, call.into, {})
            for listed, found in run.collected.items():
                lists[listed] = found.select(F.col(listed).cast("string").alias("value")) \
                    if not isinstance(found.schema[listed].dataType, T.StructType) else found
        values = lists.get((block.iterate or "").removeprefix("state."))
        if values is None:
            raise TransferError(f"dynamic_endpoints[{k}]: nothing collects {block.iterate}")
        endpoint = self.spec.defaults.overlay(block.endpoint) if self.spec.defaults else block.endpoint
        slot = (block.into or "state.value").removeprefix("state.")
        named = values.select("value").distinct().withColumn(
            "endpoint", _template(endpoint.name, slot, state))
        responses = self.responses.drop("value").join(named, "endpoint")
        endpoint = endpoint.overlay(Endpoint(name=f"dynamic_endpoints[{k}]"))
        run = self._extract(endpoint, responses, state, named.select("value"), f"state.{slot}", {})
        return {endpoint.name: run}


def _template(text: str, slot: str, state: dict) -> Column:
    """A name template over the ``value`` column; other parts come from the state."""
    for key, value in state.items():
        text = text.replace(f"{{state.{key}}}", str(value))
    before, mark, after = text.partition(f"{{state.{slot}}}")
    return F.concat(F.lit(before), F.col("value"), F.lit(after)) if mark else F.lit(text)


def _over(endpoint: Endpoint):
    return endpoint.iterate.over if isinstance(endpoint.iterate, Iterate) else endpoint.iterate


def run_spec(responses: DataFrame, spec: ApiSpec, **options) -> dict[str, EndpointRun]:
    """All endpoints of ``spec`` over ``responses``; options as for :class:`SpecRun`."""
    return SpecRun(responses, spec, **options).run()
