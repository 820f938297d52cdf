"""Whole specifications over landed responses, and what their endpoints need."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.language import expression
from ferryline.plans import extract
from ferryline.plans.apirun import SpecRun
from ferryline.plans.apispec import ApiSpec, Processor
from ferryline.plans.targets import stage
from ferryline.session import scratch_path

from .base import read, scenario
from .extracts import EVENT, landed, record_struct, records

SPEC = """
name: Shop
queues: [user_ids]
defaults:
  state: {limit: 5000}
  response:
    records: {jmespath: "data[]", primary_key: [event_id]}
  pagination: {stop_condition: "length(response.records) > state.limit"}
endpoints:
  user_events:
    iterate: {over: queue.user_ids, into: state.user}
    response:
      processors:
      - {expression: state.user, output: record.for_user}
  events:
    sync: [last_ts]
    response:
      rules:
      - {action: skip, condition: "response.status == 404 && !is_null(response.body)"}
      processors:
      - {expression: record.ts, output: state.last_ts, aggregation: maximum, if: "!is_null(record.ts)"}
      - {expression: record.user_id, output: queue.user_ids,
         if: 'record.event_type == "purchase" && record.value > 60'}
"""
SPLIT = "2024-01-20 00:00:00"


def api_landed(spark, sf_dir):
    """Pages of all events, and pages of each user's events."""
    one = F.lit(None).cast("string").alias("value")
    pages = landed(spark, sf_dir).select(F.lit("events").alias("endpoint"), one, "page", "status",
                                         "body", F.col("endpoint").alias("kind"))
    users = landed(spark, sf_dir, keys=("user_id", "page")).select(
        F.lit("user_events").alias("endpoint"), F.col("user_id").cast("string").alias("value"),
        "page", "status", "body", F.lit(None).cast("string").alias("kind"))
    return stage(pages.unionByName(users), "api")


@scenario("api_spec_run", f"""
WITH old AS (SELECT * FROM events WHERE ts < TIMESTAMP '{SPLIT}'),
fresh AS (SELECT * FROM events WHERE ts > (SELECT max(ts) FROM old)),
q1 AS (SELECT user_id FROM old WHERE event_type = 'purchase' AND value > 60),
q2 AS (SELECT user_id FROM fresh WHERE event_type = 'purchase' AND value > 60)
SELECT 1 AS run, 'user_events' AS endpoint, event_id, CAST(user_id AS VARCHAR) AS for_user
FROM events WHERE user_id IN (SELECT user_id FROM q1)
UNION ALL SELECT 2, 'events', event_id, NULL FROM fresh
UNION ALL SELECT 2, 'user_events', event_id, CAST(user_id AS VARCHAR)
FROM events WHERE user_id IN (SELECT user_id FROM q2)""")
def api_spec_run(spark, sf_dir):
    """Two endpoints joined by a queue. The first run sees the early events; the
    second sees all and starts from the state the first one kept."""
    spec, sync = ApiSpec.parse(SPEC), scratch_path(spark, "sync")
    schemas = {"events": EVENT, "user_events": EVENT}
    responses = api_landed(spark, sf_dir)
    early = read(spark, sf_dir, "events").where(f"ts < TIMESTAMP_NTZ '{SPLIT}'")
    items = F.sort_array(F.collect_list(record_struct()))
    first = (early.groupBy(F.expr("event_id div 500").alias("page"))
             .agg(F.to_json(F.struct(items.alias("data"))).alias("body"))
             .select(F.lit("events").alias("endpoint"), F.lit(None).cast("string").alias("value"),
                     "page", F.lit(200).alias("status"), "body",
                     F.lit(None).cast("string").alias("kind")))
    one = SpecRun(first.unionByName(responses.where("endpoint = 'user_events'")), spec,
                  schemas=schemas, sync_path=sync).run()
    two = SpecRun(responses, spec, schemas=schemas, sync_path=sync).run()
    nobody = F.lit(None).cast("string").alias("for_user")

    def part(run, found, who):
        return found.records.select(F.lit(run).alias("run"), F.lit(found.name).alias("endpoint"),
                                    "event_id", who)

    return (part(1, one["user_events"], "for_user").union(part(2, two["events"], nobody))
            .union(part(2, two["user_events"], "for_user")))


DYNAMIC = """
name: Tables
defaults:
  state: {prefix: table}
dynamic_endpoints:
- setup:
  - response:
      records: {jmespath: "tables[]"}
      processors:
      - {expression: record.name, output: state.table_names, aggregation: collect}
  iterate: state.table_names
  into: state.table_name
  endpoint:
    name: "{state.prefix}/{state.table_name}"
    response:
      records: {jmespath: "data[]", primary_key: [event_id]}
      processors:
      - {expression: state.table_name, output: record.table_name}
"""


@scenario("api_dynamic_spec", """
SELECT event_type AS table_name, event_id, user_id FROM events
WHERE event_type IN (SELECT event_type FROM events GROUP BY event_type
                     HAVING avg(value) < (SELECT avg(value) FROM events))""")
def api_dynamic_spec(spark, sf_dir):
    """A setup call lists tables; one endpoint per listed table, all in one plan."""
    events = read(spark, sf_dir, "events")
    low = events.groupBy("event_type").agg(F.avg("value").alias("v")).join(
        events.agg(F.avg("value").alias("mean")), F.col("v") < F.col("mean"))
    tables = low.agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("event_type").alias("name")))
                                        .alias("tables"))).alias("body"))
    setup = tables.select(F.lit("dynamic_endpoints[0].setup[0]").alias("endpoint"),
                          F.lit(0).cast("long").alias("page"), F.lit(200).alias("status"), "body")
    pages = landed(spark, sf_dir).withColumn("endpoint", F.concat(F.lit("table/"), "endpoint"))
    name = T.StructType([T.StructField("name", T.StringType())])
    run = SpecRun(stage(setup.unionByName(pages), "api"), ApiSpec.parse(DYNAMIC), schemas={
        "dynamic_endpoints[0].setup[0]": name, "dynamic_endpoints[0]": EVENT}).run()
    return run["dynamic_endpoints[0]"].records.select("table_name", "event_id", "user_id")


NESTED = """
WITH placed AS (
  SELECT event_type AS endpoint, CAST(event_id // 500 AS BIGINT) AS page, event_id % 7 AS g,
         event_id, value FROM events),
numbered AS (
  SELECT *, dense_rank() OVER (PARTITION BY endpoint, page ORDER BY g) - 1 AS outer_pos,
         row_number() OVER (PARTITION BY endpoint, page, g ORDER BY event_id) - 1 AS inner_pos
  FROM placed)
"""


def nested(spark, sf_dir):
    """Pages whose records lie in lists of lists."""
    rows = read(spark, sf_dir, "events").withColumns({
        "endpoint": F.col("event_type"), "page": F.expr("event_id div 500"),
        "g": F.expr("event_id % 7")})
    groups = rows.groupBy("endpoint", "page", "g").agg(
        F.sort_array(F.collect_list(record_struct())).alias("items"))
    bodies = groups.groupBy("endpoint", "page").agg(
        F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("g", "items"))),
                                       lambda x: F.struct(x["items"].alias("items")))
                           .alias("groups"))).alias("body"))
    return extract.response_records(bodies.withColumn("status", F.lit(200)), "groups[].items[]", EVENT)


@scenario("api_nested_pages", NESTED + """
SELECT endpoint, page, CAST(outer_pos AS INTEGER) AS outer_pos,
       CAST(inner_pos AS INTEGER) AS inner_pos, event_id FROM numbered""")
def api_nested_pages(spark, sf_dir):
    """A nested record's position is the vector of its places in every list."""
    return nested(spark, sf_dir).select("endpoint", "page", F.get("pos", F.lit(0)).alias("outer_pos"),
                                        F.get("pos", F.lit(1)).alias("inner_pos"), "record.event_id")


@scenario("api_nested_first_last", NESTED + """
SELECT endpoint, arg_min(value, (page, outer_pos, inner_pos)) AS opening,
       arg_max(value, (page, outer_pos, inner_pos)) AS closing FROM numbered GROUP BY endpoint""")
def api_nested_first_last(spark, sf_dir):
    return extract.aggregate_state(nested(spark, sf_dir), [
        Processor("record.value", "state.opening", "first"),
        Processor("record.value", "state.closing", "last")])


@scenario("api_text_functions", """
SELECT event_id, ts - INTERVAL 30 DAY AS since, ts + INTERVAL 2 MONTH AS until,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp, CAST(2 AS INTEGER) AS n_parts,
       CAST(length(event_type) AS INTEGER) AS n_chars, value * 2 AS twice, user_id AS needed,
       value IS NOT NULL AND value > 50 AS large, event_type = 'error' AS failed,
       date_trunc('day', ts) AS day
FROM events""")
def api_text_functions(spark, sf_dir):
    """Expressions as a specification writes them."""
    rows = records(spark, sf_dir)
    texts = {
        "since": 'date_add(record.ts, -30, "day")',
        "until": "date_add(record.ts, 2, 'months')",
        "stamp": 'date_format(record.ts, "%Y-%m-%dT%H:%M:%SZ")',
        "n_parts": "length(split(record.props, ':'))",
        "n_chars": "length(record.event_type)",
        "twice": 'require(record.value, "value \\"required\\"") * 2',
        "needed": "require(record.user_id, 'user required')",
        "large": "!is_null(record.value) && record.value > 50",
        "failed": 'record.event_type == "error"',
        "day": 'date_parse(date_format(record.ts, "%Y-%m-%d"), "%Y-%m-%d")',
    }
    return rows.select("record.event_id", *[expression(rows, t).alias(n) for n, t in texts.items()])


@scenario("api_format_csv_quoted", """
SELECT event_type AS endpoint, event_id, ts, CASE WHEN event_id % 5 > 0 THEN value END AS value,
       'say "' || event_type || '",' || chr(10) || 'then ' || chr(13) || chr(10) || props AS note,
       CASE WHEN event_id % 3 = 0 THEN '' END AS empty
FROM events""")
def api_format_csv_quoted(spark, sf_dir):
    """CSV bodies with quotes, delimiters and line ends in their fields, and with
    headers in a different order from page to page."""
    def quoted(text):
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    def body(items):
        def cells(r):
            note = quoted(F.concat(F.lit('say "'), r["event_type"], F.lit('",\nthen \r\n'), r["props"]))
            value = F.when(r["event_id"] % 5 > 0, r["value"].cast("string")).otherwise("")
            empty = F.when(r["event_id"] % 3 == 0, F.lit('""')).otherwise("")
            return {"event_id": r["event_id"].cast("string"), "ts": r["ts"], "note": note,
                    "value": value, "empty": empty, "more": F.lit("x")}

        def lines(names):
            return F.concat_ws("\r\n", F.lit(",".join(names)), F.transform(
                items, lambda r: F.concat_ws(",", *[cells(r)[n] for n in names])))

        one = ["event_id", "ts", "note", "value", "empty"]
        two = ["more", "empty", "value", "note", "event_id", "ts"]
        return F.when(F.get(items, F.lit(0))["event_id"] % 2 == 0, lines(one)).otherwise(lines(two))

    schema = T.StructType.fromDDL(
        "event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE, note STRING, empty STRING")
    found = extract.body_records(landed(spark, sf_dir, body), "csv", None, schema)
    return found.select("endpoint", "record.*")
