"""API extracts as Spark jobs over landed responses.

The input is a table ``(endpoint, page, status, body)`` with one row per HTTP
response; ``body`` is the response text. Fetching is not done here. Expressions
in rules and processors are written as :mod:`ferryline.functions.language` reads
them, over the struct columns ``record``, ``response`` and ``state``.

Nothing here gathers an endpoint's pages or records in one task: page cut-offs
are one aggregate per endpoint joined back, state values are mergeable
aggregates, and ``collect`` keeps one row per value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import as_list
from ..enums import plain
from ..errors import TransferError, UnsupportedError
from ..functions import delimited
from ..functions.language import expression
from ..functions.paths import extract_records, extract_variants, record_count, typed_records
from ..operators import shape
from ..operators.joins import keyed_join
from ..operators.merge import dedupe_latest, dedupe_records
from .apispec import Endpoint, Processor, Records, Rule
from .targets import stage

KEYS = ["endpoint", "page"]


# -- response rules ----------------------------------------------------------------


def rule_action(df: DataFrame, rules: list[Rule], status: str = "status") -> Column:
    """First rule whose condition holds; without one, continue below status 400
    and fail from there on."""
    chain = None
    for rule in rules or []:
        hit = expression(df, rule.condition)
        value = F.lit(plain(rule.action))
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    default = F.when(F.col(status) < 400, "continue").otherwise("fail")
    return default if chain is None else chain.otherwise(default)


def rule_message(df: DataFrame, rules: list[Rule]) -> Column:
    chain = F.lit(None).cast("string")
    for rule in reversed(rules or []):
        chain = F.when(expression(df, rule.condition), F.lit(rule.message)).otherwise(chain)
    return chain


def apply_rules(responses: DataFrame, rules: list[Rule]) -> DataFrame:
    """Responses with their ``action`` and ``message`` columns."""
    scoped = responses.withColumn("response", F.struct(
        F.col("status"), *[F.col(c) for c in responses.columns if c in ("body", "page")]))
    routed = scoped.withColumn("action", rule_action(scoped, rules)).withColumn(
        "message", rule_message(scoped, rules))
    return routed.drop("response")


def cut_pages(routed: DataFrame, at: Column, inclusive: bool, by=("endpoint",)) -> DataFrame:
    """Per endpoint (or per ``by``), drop the pages after the first where ``at`` holds.

    One partial aggregate finds the cut of every endpoint; the one-row-per-
    endpoint result joins back, so a large endpoint is never sorted or grouped
    in one task. The cuts are stored first: while their size is unknown, the
    join would shuffle the pages by endpoint, one task each, and where nothing
    is cut, no skew handling splits them again.
    """
    cuts = stage(routed.where(at).groupBy(*by).agg(F.min("page").alias("__cut")), "cuts")
    joined = keyed_join(routed, cuts, list(by), "left_outer")
    within = F.col("page") <= F.col("__cut") if inclusive else F.col("page") < F.col("__cut")
    return joined.where(F.col("__cut").isNull() | within).select(
        *[F.col(c) for c in routed.columns])


def kept_responses(routed: DataFrame, check: bool = True, by=("endpoint",)) -> DataFrame:
    """Responses whose records are loaded: ``continue`` only, up to the first
    ``stop`` or ``break`` of their endpoint. A ``fail`` before that raises. Pages
    to ``retry`` or ``skip`` are left out; :func:`action_counts` reports them."""
    live = cut_pages(routed, F.col("action").isin("stop", "break"), inclusive=False, by=by)
    if check:
        failed = live.where(F.col("action") == "fail").select(*KEYS, "status", "message").first()
        if failed:
            raise TransferError(
                f"response failed: endpoint {failed['endpoint']} page {failed['page']} "
                f"status {failed['status']} {failed['message'] or ''}".strip())
    return live.where(F.col("action") == "continue")


def action_counts(routed: DataFrame) -> dict[str, int]:
    """Number of pages per action: at most one row for each kind of action."""
    return {r["action"]: r["n"] for r in routed.groupBy("action").agg(
        F.count(F.lit(1)).alias("n")).collect()}


# -- pagination ----------------------------------------------------------------------


def stop_at_short_page(responses: DataFrame, path: str, limit: int,
                       schema: T.StructType | None = None) -> DataFrame:
    """Keep each endpoint's pages up to and with its first page of fewer than
    ``limit`` records, counted by the path that extracts them."""
    counted = responses.withColumn("__records", record_count(F.col("body"), path, schema))
    return cut_pages(counted, F.col("__records") < limit, inclusive=True).drop("__records")


def paginate(responses: DataFrame, endpoint: Endpoint, schema: T.StructType | None = None,
             by=("endpoint",), state: Column | None = None) -> DataFrame:
    """Keep the pages up to and with the first at which the specification's stop
    condition holds. ``length(response.records)`` counts records by the path that
    extracts them."""
    pagination = endpoint.pagination
    condition = pagination.stop_condition if pagination else None
    if not condition:
        return responses
    records = (endpoint.response.records if endpoint.response else None) or Records()
    response = [F.col(c) for c in ("status", "body", "page") if c in responses.columns]
    if "response.records" in condition:
        response.append(record_count(F.col("body"), records.jmespath or records.jq or "[]", schema)
                        .alias("record_count"))
    scoped = responses.withColumn("response", F.struct(*response))
    state = state_struct(endpoint.state) if state is None else state
    if state is not None:
        scoped = scoped.withColumn("state", state)
    kept = cut_pages(scoped, expression(scoped, condition), inclusive=True, by=by)
    return kept.select(*[F.col(c) for c in responses.columns])


def state_struct(state: dict | None) -> Column | None:
    """The plain values of an endpoint's state as a struct column."""
    values = {k: v for k, v in (state or {}).items() if isinstance(v, (str, int, float, bool))}
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()]) if values else None


# -- records ---------------------------------------------------------------------------


def response_records(responses: DataFrame, path: str, schema: T.StructType | None = None,
                     keep=("endpoint", "page")) -> DataFrame:
    """One row per record: the kept columns, ``pos`` and ``record``."""
    if schema is not None:
        found = typed_records(responses, "body", path, schema)
    else:
        found = extract_variants(responses, "body", path)
    return found.select(*[c for c in keep if c in found.columns], "pos", "record")


def body_records(responses: DataFrame, fmt, path: str | None, schema: T.StructType,
                 keep=("endpoint", "page")) -> DataFrame:
    """Records of any text body format as ``record`` structs."""
    kind = plain(fmt) or "json"
    keep = [c for c in keep if c in responses.columns]
    if kind == "json":
        return response_records(responses, path or "[]", schema, keep)
    if kind == "csv":  # every body has a header of its own
        cut = responses.select(*keep, delimited.records(F.col("body")).alias("lines"))
        rows = cut.select(*keep, delimited.fields(F.get("lines", F.lit(0))).alias("header"),
                          F.posexplode("lines").alias("pos", "line"))
        record = delimited.by_header(F.col("header"), F.col("values"), schema)
        return (rows.where((F.col("pos") > 0) & (F.col("line") != ""))
                .withColumn("values", delimited.fields(F.col("line")))
                .select(*keep, "pos", record.alias("record")))
    if kind in ("jsonlines", "text"):
        lines = F.split(F.col("body"), r"\r?\n")
        rows = responses.select(*keep, F.posexplode(lines).alias("pos", "line"))
        rows = rows.where(F.col("line") != "")
        if kind == "text":
            return rows.select(*keep, "pos", F.struct(F.col("line").alias("text")).alias("record"))
        return rows.select(*keep, "pos", F.from_json("line", schema).alias("record"))
    if kind == "xml":
        wrapped = T.StructType([T.StructField("row", T.ArrayType(schema))])
        parsed = F.from_xml(F.col("body"), wrapped)
        return responses.select(*keep, F.posexplode(parsed["row"]).alias("pos", "record"))
    raise UnsupportedError(f"{kind} responses are read as files, not from landed text")


def shape_records(df: DataFrame, records: Records) -> DataFrame:
    """Record columns under the record options: casing, select, keys, limit.

    Where an ``update_key`` is set the latest row per key is kept, else repeated
    keys are removed exactly, which satisfies any duplicate tolerance. ``limit``
    keeps the first of these records by page and position.
    """
    limited = records.limit is not None
    if limited:  # negative, so that of equal records the first one is the latest
        nested = isinstance(df.schema["pos"].dataType, T.ArrayType)
        back = F.transform("pos", lambda p: -p) if nested else -F.col("pos")
        df = df.withColumn("__at", F.struct((-F.col("page")).alias("page"), back.alias("pos")))
    df = df.drop("pos", *KEYS)
    if records.casing:
        df = shape.column_casing(df, records.casing)
    at = [df.columns[-1]] if limited else []
    if records.select:
        df = shape.select_columns(df, records.select, also=at)
    keys = as_list(records.primary_key)
    if keys:
        df = dedupe_latest(df, keys, records.update_key) if records.update_key else \
            dedupe_records(df, keys)
    if limited:
        df = df.orderBy(shape.column(at[0]).desc()).limit(int(records.limit)).drop(at[0])
    return df


# -- processors ------------------------------------------------------------------------


def _condition(df: DataFrame, processor: Processor) -> Column | None:
    return expression(df, processor.if_condition) if processor.if_condition else None


def add_record_field(df: DataFrame, processor: Processor) -> DataFrame:
    """``record.<name>`` outputs: set the field, where the condition holds."""
    name = processor.output.removeprefix("record.")
    value = expression(df, processor.expression)
    when = _condition(df, processor)
    known = name in df.schema["record"].dataType.names
    if when is not None:
        value = F.when(when, value).otherwise(F.col("record")[name] if known else F.lit(None))
    return df.withColumn("record", F.col("record").withField(name, value))


def queue_values(df: DataFrame, processor: Processor) -> DataFrame:
    """``queue.<name>`` outputs: one ``value`` row per record that qualifies."""
    when = _condition(df, processor)
    rows = df if when is None else df.where(when)
    return rows.select(expression(df, processor.expression).alias("value"))


def state_value(df: DataFrame, processor: Processor, order=("page", "pos")) -> Column:
    """Aggregate for a ``state.<name>`` output. ``first`` and ``last`` follow
    (page, position); all of them combine on the map side."""
    kind = plain(processor.aggregation) or "last"
    value = expression(df, processor.expression)
    when = _condition(df, processor)
    position = F.struct(*[F.col(c) for c in order])
    if when is not None:
        value = F.when(when, value)
        position = F.when(when, position)
    if kind == "maximum":
        return F.max(value)
    if kind == "minimum":
        return F.min(value)
    if kind == "first":
        return F.min_by(value, position)
    if kind == "last":
        return F.max_by(value, position)
    raise ValueError(f"{kind!r} does not reduce to one value; use collect_values")


def aggregate_state(df: DataFrame, processors: list[Processor], by=("endpoint",)) -> DataFrame:
    """All reducing state outputs of an endpoint in one pass."""
    order = [c for c in ("page", "value", "pos") if c in df.columns]
    values = [state_value(df, p, order).alias(p.output.removeprefix("state."))
              for p in processors]
    return df.groupBy(*by).agg(*values) if by else df.agg(*values)


def collect_values(df: DataFrame, processor: Processor, by=("endpoint",),
                   order=("page", "pos")) -> DataFrame:
    """The ``collect`` aggregation, kept distributed: one row per value with its
    group and (page, position), which is the order of the collected list."""
    when = _condition(df, processor)
    rows = df if when is None else df.where(when)
    name = processor.output.removeprefix("state.")
    return rows.select(*by, *order, expression(df, processor.expression).alias(name))


# -- state between runs, iteration, dynamic endpoints ----------------------------------


def since_last_sync(df: DataFrame, update_key: str, state: DataFrame | None, name: str,
                    default) -> DataFrame:
    """Records after ``coalesce(sync.<name>, default)``. The one stored value is
    read first, so the filter is a literal that reaches the scan."""
    row = state.select(F.col(name).cast("string").alias("v")).first() if state is not None else None
    kind = df.schema[update_key].dataType
    mark = row["v"] if row is not None and row["v"] is not None else default
    if mark is None:
        return df
    return df.where(shape.column(update_key) > F.lit(str(mark)).cast(kind))


def iterate_over(queue: DataFrame, responses: DataFrame, on: str, into: str) -> DataFrame:
    """Responses fetched for the values of a queue; the value becomes a column.
    Repeated queue values collapse before the join."""
    values = queue.select(F.col("value").alias(on)).where(F.col(on).isNotNull()).distinct()
    return keyed_join(responses, values, [on], "inner").withColumn(into, F.col(on))


def dynamic_extract(responses: DataFrame, value_column: str, path: str,
                    schema: T.StructType | None = None) -> DataFrame:
    """One extract per value of a setup query, all in one plan: the value is a
    column of the landed responses and stays with every record."""
    return response_records(responses, path, schema, keep=(value_column, "page"))


def run_endpoint(responses: DataFrame, endpoint: Endpoint, schema: T.StructType) -> DataFrame:
    """The records of one endpoint as they are loaded: rules, pagination, records,
    record processors and record options. Where the endpoint has a name that the
    landed responses hold, only its own are read. Records with a primary key are
    stored once before they are deduplicated, so bodies are parsed one time."""
    records = (endpoint.response.records if endpoint.response else None) or Records()
    rows = endpoint_rows(apply_rules(own_responses(responses, endpoint), (
        endpoint.response.rules if endpoint.response else None) or []), endpoint, schema)
    names = rows.schema["record"].dataType.names
    flat = rows.select(*KEYS, "pos", *[F.col("record")[n].alias(n) for n in names])
    if as_list(records.primary_key):
        flat = stage(flat, "records")
    return shape_records(flat, records)


def own_responses(responses: DataFrame, endpoint: Endpoint) -> DataFrame:
    """The responses landed under the endpoint's name."""
    return responses.where(F.col("endpoint") == endpoint.name) if endpoint.name else responses


def endpoint_rows(routed: DataFrame, endpoint: Endpoint, schema: T.StructType,
                  by=("endpoint",), state: Column | None = None) -> DataFrame:
    """``endpoint, page``, what else is in ``by``, ``pos``, ``record`` and ``state`` of
    every record that the rules and the stop condition let through, record
    processors applied. ``state`` is a column over ``by``."""
    response = endpoint.response
    records = (response.records if response else None) or Records()
    state = state_struct(endpoint.state) if state is None else state
    live = paginate(kept_responses(routed, by=by), endpoint, schema, by, state)
    rows = body_records(live, response.format if response else None,
                        records.jmespath or records.jq, schema, keep=dict.fromkeys([*KEYS, *by]))
    if state is not None:
        rows = rows.withColumn("state", state)
    for processor in (response.processors if response else None) or []:
        if (processor.output or "").startswith("record."):
            rows = add_record_field(rows, processor)
    return rows


def records_table(responses: DataFrame, path: str, schema: T.StructType | None = None) -> DataFrame:
    return extract_records(responses, "body", path, schema, keep=[])
