"""API extracts over landed responses derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions import expressions as E
from ferryline.operators.shape import cast_columns
from ferryline.plans import extract
from ferryline.plans.apispec import (
    ApiSpec, Endpoint, Pagination, Processor, Records, Response, Rule)
from ferryline.plans.targets import stage
from ferryline.session import scratch_path

from .base import read, scenario

EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
PAGE_KEYS = 500

# Status of a landed page, from the number of its records.
STATUS = """CASE WHEN n < 88 THEN 404 WHEN n < 92 THEN 429 WHEN n > 112 THEN 503 ELSE 200 END"""


def record_struct():
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.struct("event_id", clock.alias("ts"), "user_id", "event_type", "value", "props")


def landed(spark, sf_dir, body=None, keys=("endpoint", "page"), stored=False,
           mixed=False):
    """One response per event type and 500 event numbers: at most 500 records
    each, in event order. ``stored`` lands them as a table first, for extracts
    that read it more than once; ``mixed`` gives them different statuses."""
    events = read(spark, sf_dir, "events").withColumns({
        "endpoint": F.col("event_type"), "page": F.expr(f"event_id div {PAGE_KEYS}")})
    items = F.sort_array(F.collect_list(record_struct()))
    text = F.to_json(F.struct(items.alias("data"))) if body is None else body(items)
    responses = events.groupBy(*keys).agg(text.alias("body"), F.count(F.lit(1)).alias("n"))
    responses = responses.select(*keys, F.expr(STATUS if mixed else "200").alias("status"), "body")
    return stage(responses, "landed") if stored else responses


def records(spark, sf_dir):
    return extract.response_records(landed(spark, sf_dir), "data[]", EVENT)


EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
PAGED = f"""
WITH r AS (SELECT *, event_id // {PAGE_KEYS} AS page,
                  row_number() OVER (PARTITION BY event_type, event_id // {PAGE_KEYS}
                                     ORDER BY event_id) - 1 AS pos
           FROM events)
"""


@scenario("api_records_path", EVENTS)
def api_records_path(spark, sf_dir):
    """Untyped extraction: the record types are found over all records."""
    found = extract.records_table(landed(spark, sf_dir, stored=True), "data[]")
    return cast_columns(found, {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint",
                                "value": "double"}, strict=True)


@scenario("api_records_jq", PAGED + """
SELECT event_type AS endpoint, CAST(page AS BIGINT) AS page, CAST(pos AS INTEGER) AS pos,
       event_id, ts, value FROM r""")
def api_records_jq(spark, sf_dir):
    """Typed extraction with the records' page and position."""
    found = extract.response_records(landed(spark, sf_dir), ".data[]", EVENT)
    return found.select("endpoint", "page", "pos", "record.event_id", "record.ts", "record.value")


@scenario("api_records_shape", """
SELECT user_id, event_type, event_id AS latest_event_id, amount FROM (
  SELECT user_id, event_type, event_id, value AS amount,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def api_records_shape(spark, sf_dir):
    """Casing, select with an alias, and the latest record per key."""
    rows = records(spark, sf_dir).select(
        "endpoint", "page", "pos", F.col("record.user_id").alias("userId"),
        F.col("record.event_type").alias("eventType"), F.col("record.event_id").alias("eventId"),
        F.col("record.value").alias("Value"))
    return extract.shape_records(rows, Records(
        casing="snake", primary_key=["user_id", "event_type"], update_key="latest_event_id",
        select=["user_id", "event_type", "event_id as latest_event_id", "value as amount"]))


@scenario("api_format_csv", """
SELECT event_type AS endpoint, event_id, ts, value FROM events""")
def api_format_csv(spark, sf_dir):
    """CSV bodies: a header line, then one line per record."""
    def body(items):
        lines = F.transform(items, lambda r: F.concat_ws(
            ",", r["event_id"].cast("string"), r["ts"], r["value"].cast("string")))
        return F.concat_ws("\n", F.lit("event_id,ts,value"), lines)

    schema = T.StructType.fromDDL("event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE")
    found = extract.body_records(landed(spark, sf_dir, body), "csv", None, schema)
    return found.select("endpoint", "record.*")


@scenario("api_processor_record", """
SELECT event_id, upper(event_type) AS name_upper, value * 2 AS doubled FROM events""")
def api_processor_record(spark, sf_dir):
    rows = records(spark, sf_dir)
    for processor in (Processor("upper(record.event_type)", "record.name_upper"),
                      Processor("record.value * 2", "record.doubled")):
        rows = extract.add_record_field(rows, processor)
    return rows.select("record.event_id", "record.name_upper", "record.doubled")


@scenario("api_queue_output", "SELECT user_id AS value FROM events")
def api_queue_output(spark, sf_dir):
    return extract.queue_values(records(spark, sf_dir),
                                Processor("record.user_id", "queue.user_ids"))


@scenario("api_processor_if", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS paid FROM events""")
def api_processor_if(spark, sf_dir):
    rows = extract.add_record_field(records(spark, sf_dir), Processor(
        "record.value", "record.paid", if_condition='record.event_type == "purchase"'))
    return rows.select("record.event_id", "record.paid")


def aggregated(spark, sf_dir, kind, name):
    found = extract.aggregate_state(records(spark, sf_dir), [Processor(
        "record.value", f"state.{name}", kind, "!isnull(record.value)")])
    return found.select("endpoint", name)


@scenario("api_agg_maximum",
          "SELECT event_type AS endpoint, max(value) AS top FROM events GROUP BY event_type")
def api_agg_maximum(spark, sf_dir):
    return aggregated(spark, sf_dir, "maximum", "top")


@scenario("api_agg_minimum",
          "SELECT event_type AS endpoint, min(value) AS least FROM events GROUP BY event_type")
def api_agg_minimum(spark, sf_dir):
    return aggregated(spark, sf_dir, "minimum", "least")


@scenario("api_agg_first", """
SELECT event_type AS endpoint, arg_min(value, event_id) AS opening FROM events
GROUP BY event_type""")
def api_agg_first(spark, sf_dir):
    return aggregated(spark, sf_dir, "first", "opening")


@scenario("api_agg_last", """
SELECT event_type AS endpoint, arg_max(value, event_id) AS closing FROM events
GROUP BY event_type""")
def api_agg_last(spark, sf_dir):
    return aggregated(spark, sf_dir, "last", "closing")


@scenario("api_agg_collect", PAGED + """
SELECT event_type AS endpoint, CAST(page AS BIGINT) AS page, CAST(pos AS INTEGER) AS pos,
       user_id AS all_users FROM r""")
def api_agg_collect(spark, sf_dir):
    """The collected list stays a table ordered by page and position."""
    return extract.collect_values(records(spark, sf_dir), Processor(
        "record.user_id", "state.all_users", "collect"))


RULES = [
    Rule("retry", "response.status == 429", message="rate limited"),
    Rule("skip", "response.status == 404", message="not found"),
    Rule("stop", "response.status >= 500 and page > 12", message="server down"),
    Rule("continue", "response.status == 503"),
]
PAGES = f"""
WITH p AS (SELECT event_type AS endpoint, CAST(event_id // {PAGE_KEYS} AS BIGINT) AS page,
                  count(*) AS n
           FROM events GROUP BY ALL),
     s AS (SELECT endpoint, page, CAST({STATUS} AS INTEGER) AS status FROM p)
"""
ACTION = """CASE WHEN status = 429 THEN 'retry' WHEN status = 404 THEN 'skip'
                 WHEN status >= 500 AND page > 12 THEN 'stop' WHEN status = 503 THEN 'continue'
                 WHEN status < 400 THEN 'continue' ELSE 'fail' END"""


@scenario("api_rules_route", PAGES + f"""
SELECT endpoint, page, status, {ACTION} AS action,
       CASE WHEN status = 429 THEN 'rate limited' WHEN status = 404 THEN 'not found'
            WHEN status >= 500 AND page > 12 THEN 'server down' END AS message
FROM s""")
def api_rules_route(spark, sf_dir):
    routed = extract.apply_rules(landed(spark, sf_dir, mixed=True), RULES)
    return routed.select("endpoint", "page", "status", "action", "message")


@scenario("api_rules_kept", PAGES + f""",
     a AS (SELECT *, {ACTION} AS action FROM s),
     cut AS (SELECT endpoint, min(page) AS at FROM a WHERE action = 'stop' GROUP BY endpoint)
SELECT a.endpoint, a.page, a.status FROM a LEFT JOIN cut ON a.endpoint = cut.endpoint
WHERE a.action = 'continue' AND (cut.at IS NULL OR a.page < cut.at)""")
def api_rules_kept(spark, sf_dir):
    """Pages loaded: everything before the first stop, less skips and retries."""
    routed = extract.apply_rules(landed(spark, sf_dir, stored=True, mixed=True), RULES)
    return extract.kept_responses(routed).select("endpoint", "page", "status")


@scenario("api_rules_modifiers", PAGES + """
SELECT endpoint, page, status,
       CASE WHEN status = 404 THEN 'skip' WHEN status = 429 THEN 'retry'
            WHEN status = 503 THEN 'break' WHEN status < 400 THEN 'continue' ELSE 'fail' END AS action
FROM s""")
def api_rules_modifiers(spark, sf_dir):
    """``+rules`` are tried before the default rules, ``rules+`` after them."""
    spec = ApiSpec(name="events", defaults=Endpoint(response=Response(rules=[
        Rule("retry", "response.status == 429"), Rule("continue", "response.status == 404")])),
        endpoints={"fragile": Endpoint(response=Response(
            prepend_rules=[Rule("skip", "response.status == 404")],
            append_rules=[Rule("break", "response.status == 503"),
                          Rule("fail", "response.status == 429")]))})
    rules = spec.effective("fragile").response.rules
    return extract.apply_rules(landed(spark, sf_dir, mixed=True), rules).select(
        "endpoint", "page", "status", "action")


@scenario("api_sync_state", """
SELECT event_id, ts, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')""")
def api_sync_state(spark, sf_dir):
    """The maximum of the last run is stored, and the next run starts after it."""
    rows = records(spark, sf_dir).withColumn("ts", F.col("record.ts"))
    before = rows.where("ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    state = extract.aggregate_state(before, [Processor(
        "record.ts", "state.last_ts", "maximum")], by=())
    stored = scratch_path(spark, "sync")
    state.write.parquet(stored)
    fresh = extract.since_last_sync(rows, "ts", spark.read.parquet(stored), "last_ts",
                                    default="2023-01-01")
    return fresh.select("record.event_id", "ts", "record.value")


@scenario("api_iterate_queue", """
SELECT user_id, event_id, value FROM events
WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60)""")
def api_iterate_queue(spark, sf_dir):
    """Responses fetched per user, joined to the queue of users."""
    queue = extract.queue_values(records(spark, sf_dir), Processor(
        "record.user_id", "queue.user_ids",
        if_condition="record.event_type == 'purchase' and record.value > 60"))
    per_user = landed(spark, sf_dir, keys=("user_id", "page"))
    found = extract.iterate_over(queue, per_user, on="user_id", into="for_user")
    rows = extract.response_records(found, "data[]", EVENT, keep=("for_user",))
    return rows.select(F.col("for_user").alias("user_id"), "record.event_id", "record.value")


PAGE_LIMIT = 88


@scenario("api_pagination_stop", PAGED + f""",
     sizes AS (SELECT event_type, page, count(*) AS n FROM r GROUP BY event_type, page),
     cut AS (SELECT event_type, min(page) AS at FROM sizes WHERE n < {PAGE_LIMIT}
             GROUP BY event_type)
SELECT sizes.event_type AS endpoint, CAST(sizes.page AS BIGINT) AS page, CAST(n AS INTEGER) AS n
FROM sizes LEFT JOIN cut ON sizes.event_type = cut.event_type
WHERE cut.at IS NULL OR sizes.page <= cut.at""")
def api_pagination_stop(spark, sf_dir):
    """Pages up to and with the first one that is not full."""
    endpoint = Endpoint(
        state={"limit": PAGE_LIMIT}, response=Response(records=Records(jmespath="data[]")),
        pagination=Pagination(stop_condition="length(response.records) < state.limit"))
    kept = extract.paginate(landed(spark, sf_dir, stored=True), endpoint)
    size = F.json_array_length(F.get_json_object("body", "$.data"))
    return kept.select("endpoint", "page", size.alias("n"))


@scenario("api_dynamic_endpoints", """
SELECT event_type AS table_name, event_id, user_id FROM events""")
def api_dynamic_endpoints(spark, sf_dir):
    """One endpoint per event type, all in one plan."""
    responses = landed(spark, sf_dir).withColumnRenamed("endpoint", "table_name")
    rows = extract.dynamic_extract(responses, "table_name", "data[]", EVENT)
    return rows.select("table_name", "record.event_id", "record.user_id")


@scenario("api_expr_functions", """
SELECT event_id, coalesce(nullif(event_type, 'error'), 'none') AS kind,
       ts + INTERVAL 30 DAY AS due, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp,
       ts AS parsed, value IS NULL AS missing, upper(event_type) AS loud, user_id AS needed,
       CAST(2 AS INTEGER) AS n_parts
FROM events""")
def api_expr_functions(spark, sf_dir):
    """The functions expressions use, over the record struct."""
    E.register_functions(spark)
    record = F.col("record")
    text = F.date_format(record["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return records(spark, sf_dir).withColumn("stamp_text", text).select(
        "record.event_id",
        F.expr("coalesce(nullif(record.event_type, 'error'), 'none')").alias("kind"),
        E.date_add(record["ts"], 30, "day").alias("due"),
        E.date_format(record["ts"], "%Y-%m-%dT%H:%M:%SZ").alias("stamp"),
        F.expr("date_parse(stamp_text)").alias("parsed"),
        E.is_null(record["value"]).alias("missing"),
        F.expr("upper(record.event_type)").alias("loud"),
        E.require(record["user_id"], "user_id required").alias("needed"),
        E.list_length(F.split(record["props"], ":")).alias("n_parts"))


@scenario("api_endpoint_extract", PAGES + f"""
SELECT event_id, ts, user_id, upper(event_type) AS event_type, value, props,
       CASE WHEN value > 50 THEN 'large' END AS size_class
FROM events JOIN s ON endpoint = event_type AND page = event_id // {PAGE_KEYS}
WHERE status = 200""")
def api_endpoint_extract(spark, sf_dir):
    """The whole path from landed responses to records, as one specification."""
    spec = ApiSpec(name="events", endpoints={"events": Endpoint(response=Response(
        records=Records(jmespath="data[]", primary_key=["event_id"]),
        rules=[Rule("skip", "response.status in (404, 429, 503)")],
        processors=[Processor("upper(record.event_type)", "record.event_type"),
                    Processor("'large'", "record.size_class", if_condition="record.value > 50")]))})
    responses = landed(spark, sf_dir, stored=True, mixed=True)
    responses = responses.withColumn("endpoint", F.lit("events")).unionByName(
        responses.withColumn("endpoint", F.lit("another")))
    return extract.run_endpoint(responses, spec.effective("events"), EVENT)
