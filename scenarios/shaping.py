"""Projections, filters, casts, transforms, parse options and schema changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline import Connection, SourceOptions, TargetOptions, Transfer
from ferryline.operators import shape
from ferryline.operators.infer import infer_types
from ferryline.operators.schema import apply_typing, union_evolving
from ferryline.session import scratch_path
from ferryline.sinks.files import write_files
from ferryline.sources.files import read_files
from ferryline.sources.inputs import ragged_frame

from .base import path, read, scenario


def shaped(spark, sf_dir, table, **arguments):
    """The source side of a transfer over one of the tables."""
    return Transfer(src_stream=path(sf_dir, table), spark=spark, **arguments).dataframe()


@scenario("select_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def select_columns(spark, sf_dir):
    return shaped(spark, sf_dir, "orders", select="o_orderkey, o_totalprice")


@scenario("select_alias", "SELECT *, c_name AS name, upper(c_mktsegment) AS segment FROM customer")
def select_alias(spark, sf_dir):
    return shaped(spark, sf_dir, "customer",
                  select=["*", "c_name as name", "upper(c_mktsegment) as segment"])


@scenario("cast_columns", """
SELECT c_custkey, TRY_CAST(regexp_replace(c_name, 'Customer#', '') AS INTEGER) AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
       TRY_CAST(c_mktsegment AS BIGINT) AS c_mktsegment
FROM customer""")
def cast_columns(spark, sf_dir):
    """Named columns are cast and all others kept; unreadable text becomes null."""
    return shaped(spark, sf_dir, "customer", src_options={"columns": {}},
                  select=["c_custkey", "regexp_replace(c_name, 'Customer#', '') as c_name",
                          "c_nationkey", "c_acctbal", "c_mktsegment"],
                  columns={"c_name": "integer", "c_nationkey": "text",
                           "c_acctbal": "decimal(18,2)", "c_mktsegment": "bigint"})


@scenario("select_and_cast", """
SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
       CAST(o_totalprice AS DECIMAL(12,1)) AS o_totalprice
FROM orders""")
def select_and_cast(spark, sf_dir):
    return shaped(spark, sf_dir, "orders", select=["o_orderkey", "o_orderdate", "o_totalprice"],
                  columns='{"o_orderdate": "string", "o_totalprice": "decimal(12,1)"}')


@scenario("transforms_column", """
SELECT c_custkey, lower(c_name) AS c_name, c_nationkey,
       sha256(c_mktsegment) AS c_mktsegment, c_acctbal * 2 + c_nationkey AS c_acctbal
FROM customer""")
def transforms_column(spark, sf_dir):
    return shaped(spark, sf_dir, "customer", transforms={
        "c_name": ["trim", "lower"], "c_mktsegment": ["hash_sha256"],
        "c_acctbal": ["value * 2 + c_nationkey"]})


@scenario("transforms_all", """
SELECT event_id, ts, user_id, upper(md5(event_type)) AS event_type, value,
       upper(md5(props)) AS props FROM events""")
def transforms_all(spark, sf_dir):
    """A list applies to every text column, in order."""
    return shaped(spark, sf_dir, "events", transforms=["hash_md5", "upper"])


@scenario("filter_where", """
SELECT * FROM lineitem WHERE l_quantity > 45 AND l_shipdate >= TIMESTAMP '1998-01-01'""")
def filter_where(spark, sf_dir):
    return shaped(spark, sf_dir, "lineitem",
                  where="l_quantity > 45 and l_shipdate >= timestamp_ntz'1998-01-01'")


@scenario("limit_rows", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def limit_rows(spark, sf_dir):
    return shaped(spark, sf_dir, "orders", limit=50, order_by="o_totalprice desc, o_orderkey")


@scenario("limit_offset", """
SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30 OFFSET 20""")
def limit_offset(spark, sf_dir):
    return shaped(spark, sf_dir, "orders", limit=30, offset=20,
                  order_by=["o_totalprice desc", "o_orderkey"])


@scenario("limit_offset_deep", """
SELECT * FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber
LIMIT 12000 OFFSET 20000""")
def limit_offset_deep(spark, sf_dir):
    """A slice beyond what one task should order: cut by ranges."""
    return shaped(spark, sf_dir, "lineitem", limit=12_000, offset=20_000,
                  order_by="l_extendedprice desc, l_orderkey, l_linenumber")


@scenario("opt_limit_offset", """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_custkey LIMIT 25 OFFSET 100""")
def opt_limit_offset(spark, sf_dir):
    return shaped(spark, sf_dir, "customer", select="c_custkey, c_acctbal",
                  src_options=SourceOptions(limit=25, offset=100), order_by="c_custkey")


def query_view(spark, sf_dir, table):
    name = f"{table}_rows"
    read(spark, sf_dir, table).createOrReplaceTempView(name)
    return name


@scenario("exec_default_limit", """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey
ORDER BY n DESC, o_custkey LIMIT 100""")
def exec_default_limit(spark, sf_dir):
    view = query_view(spark, sf_dir, "orders")
    return Connection("SPARK", spark).query(
        f"SELECT o_custkey, count(*) AS n FROM {view} GROUP BY o_custkey "
        "ORDER BY n DESC, o_custkey", limit=None)


@scenario("exec_unlimited", """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey""")
def exec_unlimited(spark, sf_dir):
    view = query_view(spark, sf_dir, "orders")
    return Connection("SPARK", spark).query(
        f"SELECT o_custkey, count(*) AS n FROM {view} GROUP BY o_custkey", limit=0)


@scenario("meta_stream_url", """
SELECT 'orders.parquet' AS file_name, CAST(count(*) AS BIGINT) AS n_rows FROM orders""")
def meta_stream_url(spark, sf_dir):
    rows = shaped(spark, sf_dir, "orders", select="o_orderkey", env={"STREAM_URL_COLUMN": "true"})
    name = F.element_at(F.split("_stream_url", "/"), -1)
    return rows.groupBy(name.alias("file_name")).agg(F.count("o_orderkey").alias("n_rows"))


@scenario("meta_loaded_at", """
SELECT *, TIMESTAMP '2024-06-01 12:00:00' AS _loaded_at FROM supplier""")
def meta_loaded_at(spark, sf_dir):
    return shape.with_loaded_at(read(spark, sf_dir, "supplier"), "2024-06-01 12:00:00")


@scenario("column_casing_snake", """
SELECT o_orderkey AS order_key, o_custkey AS cust_id, o_totalprice AS total_price_usd FROM orders""")
def column_casing_snake(spark, sf_dir):
    renamed = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_custkey").alias("custID"),
        F.col("o_totalprice").alias("Total Price-USD"))
    return shape.column_casing(renamed, "snake")


# -- parse options on text files ---------------------------------------------------

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
# Whole numbers read back from text are typed bigint.
CUSTOMER_TEXT = CUSTOMER.replace("c_nationkey,", "CAST(c_nationkey AS BIGINT) AS c_nationkey,")


def csv_of(spark, df, label, **options):
    target = scratch_path(spark, label)
    write_files(df, target, "csv", TargetOptions(**options))
    return target


def lines_of(spark, df, label):
    target = scratch_path(spark, label)
    df.write.text(target)
    return target


@scenario("opt_header", """
SELECT c_custkey AS _c0, c_name AS _c1, CAST(c_nationkey AS BIGINT) AS _c2, c_acctbal AS _c3,
       c_mktsegment AS _c4 FROM customer""")
def opt_header(spark, sf_dir):
    files = csv_of(spark, read(spark, sf_dir, "customer"), "noheader", header=False)
    return read_files(spark, files, {"format": "csv", "header": False})


@scenario("opt_delimiter", CUSTOMER_TEXT)
def opt_delimiter(spark, sf_dir):
    files = csv_of(spark, read(spark, sf_dir, "customer"), "delimiter", delimiter="|")
    return read_files(spark, files, {"format": "csv", "delimiter": "|"})


@scenario("opt_null_if", CUSTOMER_TEXT.replace(
    "c_mktsegment", "nullif(c_mktsegment, 'BUILDING') AS c_mktsegment"))
def opt_null_if(spark, sf_dir):
    files = csv_of(spark, read(spark, sf_dir, "customer"), "nullif")
    return read_files(spark, files, {"format": "csv", "null_if": "BUILDING"})


@scenario("opt_empty_as_null", CUSTOMER_TEXT.replace(
    "c_mktsegment", "nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment"))
def opt_empty_as_null(spark, sf_dir):
    """Quoted empty text becomes null."""
    customers = read(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.expr("if(c_mktsegment = 'MACHINERY', '', c_mktsegment)"))
    files = csv_of(spark, customers, "empty")
    return read_files(spark, files, {"format": "csv", "empty_as_null": True})


@scenario("opt_trim_space", CUSTOMER_TEXT)
def opt_trim_space(spark, sf_dir):
    padded = read(spark, sf_dir, "customer").withColumn(
        "c_name", F.expr("concat('  ', c_name, ' ')"))
    files = csv_of(spark, padded, "trim")
    return read_files(spark, files, {"format": "csv", "trim_space": True})


@scenario("opt_skip_blank_lines", """
SELECT c_custkey AS _c0, c_name AS _c1, c_mktsegment AS _c2 FROM customer""")
def opt_skip_blank_lines(spark, sf_dir):
    """Every record is followed by an empty line and a line of empty fields."""
    record = F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment")
    lines = read(spark, sf_dir, "customer").select(
        F.explode(F.array(record, F.lit(""), F.lit(" , ,"))).alias("value"))
    return read_files(spark, lines_of(spark, lines, "blank"),
                      {"format": "csv", "header": False, "skip_blank_lines": True,
                       "fields_per_rec": 3})


def ragged_lines(spark, sf_dir):
    """Records with a field missing (negative balance) or one too many."""
    customers = read(spark, sf_dir, "customer")
    line = F.expr("""
        CASE WHEN c_acctbal < 0 THEN concat_ws(',', c_custkey, c_name)
             WHEN c_mktsegment = 'BUILDING' THEN concat_ws(',', c_custkey, c_name, c_mktsegment, 'x')
             ELSE concat_ws(',', c_custkey, c_name, c_mktsegment) END""")
    return lines_of(spark, customers.select(line.alias("value")), "ragged")


@scenario("opt_fields_per_rec", """
SELECT c_custkey AS _c0, c_name AS _c1,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS _c2 FROM customer""")
def opt_fields_per_rec(spark, sf_dir):
    """Short records are padded with nulls, long ones cut."""
    return read_files(spark, ragged_lines(spark, sf_dir),
                      {"format": "csv", "header": False, "fields_per_rec": 3})


@scenario("opt_malformed_skip", """
SELECT c_custkey AS _c0, c_name AS _c1, c_mktsegment AS _c2 FROM customer
WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'""")
def opt_malformed_skip(spark, sf_dir):
    return read_files(spark, ragged_lines(spark, sf_dir),
                      {"format": "csv", "header": False, "fields_per_rec": 3},
                      on_malformed="skip")


@scenario("opt_datetime_format", "SELECT o_orderkey, o_orderdate FROM orders")
def opt_datetime_format(spark, sf_dir):
    pattern = "dd/MM/yyyy HH:mm"
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    files = csv_of(spark, orders, "dates", datetime_format=pattern)
    return read_files(spark, files, {"format": "csv", "datetime_format": pattern,
                                     "columns": {"o_orderkey": "bigint",
                                                 "o_orderdate": "timestamp"}})


@scenario("opt_max_decimals", """
SELECT event_id, user_id,
       CAST(round(CAST(value AS DECIMAL(18,2)), 1) AS DOUBLE) AS value FROM events""")
def opt_max_decimals(spark, sf_dir):
    return read_files(spark, path(sf_dir, "events"), {"max_decimals": 1}).select(
        "event_id", "user_id", "value")


@scenario("opt_flatten", """
SELECT doc_id, lang AS meta__lang, source AS meta__origin__source,
       n_chars AS meta__origin__n_chars, '["' || lang || '","' || source || '"]' AS tags, text
FROM documents""")
def opt_flatten(spark, sf_dir):
    nested = read(spark, sf_dir, "documents").select(
        "doc_id", "text", F.array("lang", "source").alias("tags"),
        F.struct("lang", F.struct("source", "n_chars").alias("origin")).alias("meta"))
    files = scratch_path(spark, "nested")
    write_files(nested, files, "parquet")
    return read_files(spark, files, {"format": "parquet", "flatten": True})


@scenario("opt_json_path", """
SELECT event_id, event_type, user_id, value FROM events""")
def opt_json_path(spark, sf_dir):
    """Records below ``data.items[]`` of JSON lines files."""
    record = F.struct("event_id", "event_type", "user_id", "value")
    pages = (read(spark, sf_dir, "events").groupBy(F.expr("event_id div 100").alias("page"))
             .agg(F.collect_list(record).alias("items"))
             .select("page", F.struct("items").alias("data")))
    files = scratch_path(spark, "paths")
    write_files(pages, files, "jsonlines")
    found = read_files(spark, files, {"format": "jsonlines", "jmespath": "data.items[]"})
    return shape.cast_columns(found, {"event_id": "bigint", "user_id": "bigint",
                                      "value": "double"})


@scenario("infer_types", """
SELECT * FROM (
  SELECT 'o_orderkey' AS column_name, CASE WHEN count(TRY_CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT)) = count(*) THEN 'bigint' ELSE 'string' END AS inferred_type FROM orders
  UNION ALL SELECT 'o_orderstatus', CASE WHEN count(TRY_CAST(o_orderstatus AS BIGINT)) = count(*) THEN 'bigint' ELSE 'string' END FROM orders
  UNION ALL SELECT 'o_totalprice', CASE WHEN count(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE)) = count(*) THEN 'double' ELSE 'string' END FROM orders
  UNION ALL SELECT 'o_orderdate', CASE WHEN count(TRY_CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP)) = count(*) THEN 'timestamp_ntz' ELSE 'string' END FROM orders
  UNION ALL SELECT 'order_day', CASE WHEN count(TRY_CAST(CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS DATE)) = count(*) THEN 'date' ELSE 'string' END FROM orders
  UNION ALL SELECT 'is_open', CASE WHEN count(TRY_CAST(CAST(o_orderstatus = 'O' AS VARCHAR) AS BOOLEAN)) = count(*) THEN 'boolean' ELSE 'string' END FROM orders
  UNION ALL SELECT 'no_value', CASE WHEN count(CASE WHEN o_totalprice < 0 THEN 'x' END) = 0 THEN 'string' END FROM orders
)""")
def types_of_text(spark, sf_dir):
    text = read(spark, sf_dir, "orders").selectExpr(
        "string(o_orderkey) AS o_orderkey", "o_orderstatus", "string(o_totalprice) AS o_totalprice",
        "string(o_orderdate) AS o_orderdate", "string(date(o_orderdate)) AS order_day",
        "string(o_orderstatus = 'O') AS is_open", "if(o_totalprice < 0, 'x', null) AS no_value")
    return infer_types(text)


@scenario("ragged_records", """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) END AS value,
       CASE WHEN event_type <> 'purchase' THEN CAST(user_id AS VARCHAR) END AS user_id
FROM events""")
def ragged_records(spark, sf_dir):
    """Records with different keys give the union of the keys."""
    bodies = read(spark, sf_dir, "events").select(F.expr("""
        if(event_type = 'purchase', to_json(named_struct('event_id', event_id, 'value', value)),
           to_json(named_struct('event_id', event_id, 'user_id', user_id)))""").alias("data"))
    return ragged_frame(bodies, "data")


# -- schema changes ------------------------------------------------------------------


@scenario("column_typing", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(14,2)) AS c_acctbal, c_mktsegment FROM customer""")
def column_typing(spark, sf_dir):
    return apply_typing(read(spark, sf_dir, "customer"),
                        {"double": "decimal(14,2)", "int": "bigint"})


@scenario("schema_add_columns", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS tier
FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT c_custkey, c_name, NULL, c_acctbal, c_mktsegment, 'positive' FROM customer
WHERE c_acctbal >= 0""")
def schema_add_columns(spark, sf_dir):
    customers = read(spark, sf_dir, "customer")
    source = customers.where("c_acctbal >= 0").drop("c_nationkey").withColumn(
        "tier", F.lit("positive"))
    return union_evolving(customers.where("c_acctbal < 0"), source)


@scenario("schema_widen_types", """
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS measure, CAST(c_nationkey AS VARCHAR) AS code
FROM customer
UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer""")
def schema_widen_types(spark, sf_dir):
    """int meets double -> double; int meets text -> text."""
    customers = read(spark, sf_dir, "customer")
    target = customers.select("c_custkey", F.col("c_nationkey").alias("measure"),
                              F.col("c_nationkey").alias("code"))
    source = customers.select("c_custkey", F.col("c_acctbal").alias("measure"),
                              F.col("c_mktsegment").alias("code"))
    return union_evolving(target, source)
