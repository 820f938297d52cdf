"""Sources and sinks: what is written reads back as the same rows."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import functions as F

from ferryline import (
    CatalogTable, LoadSpec, Replication, Source, TargetOptions, Transfer, VersionedDataset, load)
from ferryline.fs import ClusterFiles
from ferryline.session import scratch_path
from ferryline.sinks.files import commit_file, task_ids, write_files
from ferryline.sources.files import read_files

from .base import create_database, path, read, scenario

ORDERS = "SELECT * FROM orders"
CUSTOMER_TEXT = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer"""


def written(spark, df, label, fmt, **options):
    target = scratch_path(spark, label)
    write_files(df, target, fmt, TargetOptions(**options))
    return target


@scenario("scan_parquet", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
WHERE l_discount > 0.05""")
def scan_parquet(spark, sf_dir):
    """Column selection and filter reach the scan."""
    return Transfer(src_stream=path(sf_dir, "lineitem"), where="l_discount > 0.05", spark=spark,
                    select="l_orderkey,l_linenumber,l_extendedprice,l_shipdate").dataframe()


@scenario("scan_csv", ORDERS)
def scan_csv(spark, sf_dir):
    """Types are found over the whole input."""
    files = written(spark, read(spark, sf_dir, "orders"), "csv", "csv")
    return read_files(spark, files, {"format": "csv"})


@scenario("scan_json", ORDERS)
def scan_json(spark, sf_dir):
    files = written(spark, read(spark, sf_dir, "orders"), "json", "json")
    return read_files(spark, files, {"format": "json", "columns": {"o_orderdate": "timestamp"}})


@scenario("scan_jsonlines_raw", """
SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
       || ',"c_acctbal":' || c_acctbal || ',"c_mktsegment":"' || c_mktsegment || '"}' AS data
FROM customer""")
def scan_jsonlines_raw(spark, sf_dir):
    files = written(spark, read(spark, sf_dir, "customer"), "jsonl", "jsonlines")
    return read_files(spark, files, {"format": "jsonlines"})


@scenario("scan_jsonlines_flat", """
SELECT event_id, value, user_id AS actor__user_id, event_type AS actor__kind__event_type,
       CAST(regexp_extract(props, ':\\s*(\\d+)', 1) AS BIGINT) AS props__k
FROM events""")
def scan_jsonlines_flat(spark, sf_dir):
    nested = read(spark, sf_dir, "events").select(
        "event_id", "value",
        F.struct("user_id", F.struct("event_type").alias("kind")).alias("actor"),
        F.from_json("props", "k bigint").alias("props"))
    files = written(spark, nested, "nested", "jsonlines")
    return read_files(spark, files, {"format": "jsonlines", "flatten": True})


@scenario("scan_xml", CUSTOMER_TEXT)
def scan_xml(spark, sf_dir):
    files = written(spark, read(spark, sf_dir, "customer"), "xml", "xml")
    return read_files(spark, files, {"format": "xml"})


@scenario("scan_arrow", ORDERS)
def scan_arrow(spark, sf_dir):
    files = written(spark, read(spark, sf_dir, "orders"), "arrow", "arrow")
    return read_files(spark, files, {"format": "arrow"})


# -- workbooks: a minimal writer for the fixture -------------------------------------


def workbook(rows) -> bytes:
    """A workbook with an empty first sheet and the rows on sheet ``data``,
    starting at cell B2."""
    def cell(column, number, value):
        ref = f"{chr(66 + column)}{number}"
        if isinstance(value, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f'<c r="{ref}"><v>{value}</v></c>'

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    body = "".join(
        f'<row r="{n}">' + "".join(cell(i, n, v) for i, v in enumerate(values)) + "</row>"
        for n, values in enumerate(rows, start=2))
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>'
                           '<sheet name="notes" sheetId="1" r:id="rId1"/>'
                           '<sheet name="data" sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": "<Relationships>"
                                      '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
                                      '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/>'
                                      "</Relationships>",
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData/></worksheet>',
        "xl/worksheets/sheet2.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData>'
                                    "</worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return out.getvalue()


def customer_workbooks(spark, sf_dir):
    """One workbook per 500 customer keys, written by the tasks."""
    folder = ClusterFiles(spark).qualified(scratch_path(spark, "xlsx"))
    names = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

    def save(group):
        import pandas as pd

        rows = [names] + group[names].values.tolist()
        content = workbook(rows)
        name = f"book-{int(group['book'].iloc[0]):06d}.xlsx"
        commit_file(folder, name, task_ids()[1], lambda out: out.write(content))
        return pd.DataFrame({"file": [name], "n_rows": [len(group)]})

    books = read(spark, sf_dir, "customer").withColumn("book", F.expr("c_custkey div 500"))
    books.groupBy("book").applyInPandas(save, "file string, n_rows bigint").collect()
    return folder


@scenario("scan_xlsx", CUSTOMER_TEXT.replace(", c_mktsegment", ""))
def scan_xlsx(spark, sf_dir):
    """A named sheet and a cell range that leaves the last column out."""
    return read_files(spark, customer_workbooks(spark, sf_dir),
                      {"format": "xlsx", "sheet": "data", "range": "B2:E10000"})


@scenario("scan_raw", """
SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes, CAST(count(*) AS BIGINT) AS n_documents
FROM documents""")
def scan_raw(spark, sf_dir):
    """Raw files: the bytes written are the bytes found."""
    files = scratch_path(spark, "raw")
    (read(spark, sf_dir, "documents").select("text").write
     .option("maxRecordsPerFile", 5000).text(files, lineSep="\x1e"))
    content = F.col("content").cast("string")
    return read_files(spark, files, {"format": "raw"}).agg(
        F.sum("length").alias("n_bytes"),
        F.sum(F.size(F.split(content, "\x1e")) - 1).alias("n_documents"))


@scenario("scan_compressed", """
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice, codec
FROM part CROSS JOIN (VALUES ('gzip'), ('snappy'), ('zstd')) AS c(codec)""")
def scan_compressed(spark, sf_dir):
    """Compression is seen from the file names (csv) or the files (parquet)."""
    part = read(spark, sf_dir, "part")
    out = None
    for fmt, codec in (("csv", "gzip"), ("jsonlines", "snappy"), ("parquet", "zstd")):
        files = written(spark, part, codec, fmt, compression=codec)
        found = read_files(spark, files, {"format": fmt, "flatten": True})
        found = found.withColumns({"p_size": F.col("p_size").cast("bigint"),
                                   "codec": F.lit(codec)})
        out = found if out is None else out.unionByName(found)
    return out


@scenario("scan_zip", CUSTOMER_TEXT)
def scan_zip(spark, sf_dir):
    files = written(spark, read(spark, sf_dir, "customer"), "zip", "csv", compression="zip")
    return read_files(spark, files, {"format": "csv", "compression": "zip"})


@scenario("scan_files_list", ORDERS)
def scan_files_list(spark, sf_dir):
    """An explicit list of folders, one per year, as one source."""
    folder = scratch_path(spark, "list")
    orders = read(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    write_files(orders, folder, "parquet", partition_by=["o_year"])
    files = ClusterFiles(spark).glob(f"{folder}/o_year=*")
    return Transfer(files=files, src_options={"format": "parquet"}, spark=spark).dataframe()


@scenario("scan_wildcard", """
SELECT 'customer' AS table_name, 'success' AS status, CAST(count(*) AS BIGINT) AS rows_in FROM customer
UNION ALL SELECT 'nation', 'success', CAST(count(*) AS BIGINT) FROM nation
UNION ALL SELECT 'supplier', 'success', CAST(count(*) AS BIGINT) FROM supplier""")
def scan_wildcard(spark, sf_dir):
    """``schema.*`` becomes one stream per table."""
    source, target = create_database(spark, "wild"), create_database(spark, "tame")
    for table in ("customer", "nation", "supplier"):
        read(spark, sf_dir, table).write.saveAsTable(f"{source}.{table}")
    report = Replication(source="SPARK", target="SPARK", spark=spark,
                         defaults={"object": target + ".{stream_table}"},
                         streams={f"{source}.*": {}}).run()
    return report.select(F.element_at(F.split("stream", "\\."), -1).alias("table_name"),
                         "status", "rows_in")


@scenario("scan_table", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def scan_table(spark, sf_dir):
    name = f"{create_database(spark, 'scan')}.customer"
    read(spark, sf_dir, "customer").write.saveAsTable(name)
    source = Source(conn="SPARK", stream=name)
    return Transfer(src_conn=source.conn, src_stream=source.stream, spark=spark,
                    select="c_custkey,c_acctbal", where="c_acctbal > 0").dataframe()


@scenario("scan_custom_sql", """
SELECT n_name, CAST(count(*) AS BIGINT) AS n_customers,
       sum(CAST(c_acctbal AS DECIMAL(18,2))) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def scan_custom_sql(spark, sf_dir):
    for table in ("customer", "nation"):
        read(spark, sf_dir, table).createOrReplaceTempView(f"{table}_rows")
    return Transfer(src_conn="SPARK", spark=spark, src_stream="""
        SELECT n_name, count(*) AS n_customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS balance
        FROM customer_rows JOIN nation_rows ON c_nationkey = n_nationkey
        GROUP BY n_name""").dataframe()


@scenario("chunked_extract", ORDERS)
def chunked_extract(spark, sf_dir):
    """Extract in ranges of the key, one commit per chunk."""
    orders = read(spark, sf_dir, "orders")
    span = orders.agg(F.max("o_orderkey") - F.min("o_orderkey") + 1).first()[0]
    target = scratch_path(spark, "chunks")
    VersionedDataset(spark, target).replace(orders.limit(0))
    done = Transfer(src_stream=path(sf_dir, "orders"), tgt_object=target, spark=spark,
                    primary_key="o_orderkey",
                    src_options={"chunk_size": -(-span // 4)}).run()
    assert done.detail["chunks"] > 4
    return VersionedDataset(spark, target).read()


@scenario("empty_input", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, 6 AS n_columns FROM orders WHERE o_totalprice < 0""")
def empty_input(spark, sf_dir):
    """No rows still gives the target, with its schema."""
    target = VersionedDataset(spark, scratch_path(spark, "none"))
    load(read(spark, sf_dir, "orders").where("o_totalprice < 0"), target, LoadSpec())
    found = target.read()
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(found.columns)).alias("n_columns"))


# -- sinks --------------------------------------------------------------------------


@scenario("sink_csv", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def sink_csv(spark, sf_dir):
    """Values holding quotes and commas survive; microseconds are kept."""
    target = scratch_path(spark, "sink") + ".csv"
    Transfer(input=read(spark, sf_dir, "events"), tgt_object=target, spark=spark).run()
    return Transfer(src_stream=target, spark=spark).dataframe()


@scenario("sink_json", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_json(spark, sf_dir):
    """One JSON array per partition, read back whole."""
    target = scratch_path(spark, "sink") + ".json"
    Transfer(input=read(spark, sf_dir, "documents"), tgt_object=target, spark=spark).run()
    return Transfer(src_stream=target, spark=spark).dataframe()


@scenario("sink_jsonlines", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_jsonlines(spark, sf_dir):
    target = scratch_path(spark, "sink")
    Transfer(input=read(spark, sf_dir, "documents"), tgt_object=target, spark=spark,
             tgt_options={"format": "jsonlines"}).run()
    return Transfer(src_stream=target, src_options={"format": "jsonlines", "flatten": True},
                    spark=spark).dataframe()


@scenario("sink_parquet", "SELECT * FROM lineitem")
def sink_parquet(spark, sf_dir):
    target = scratch_path(spark, "sink") + ".parquet"
    Transfer(src_stream=path(sf_dir, "lineitem"), tgt_object=target, spark=spark).run()
    return Transfer(src_stream=target, spark=spark).dataframe()


@scenario("sink_arrow", "SELECT * FROM events")
def sink_arrow(spark, sf_dir):
    target = scratch_path(spark, "sink") + ".arrow"
    Transfer(src_stream=path(sf_dir, "events"), tgt_object=target, spark=spark).run()
    return Transfer(src_stream=target, spark=spark).dataframe()


@scenario("sink_xml", """
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier""")
def sink_xml(spark, sf_dir):
    target = scratch_path(spark, "sink") + ".xml"
    Transfer(src_stream=path(sf_dir, "supplier"), tgt_object=target, spark=spark).run()
    return Transfer(src_stream=target, spark=spark).dataframe()


@scenario("sink_table", "SELECT * FROM part")
def sink_table(spark, sf_dir):
    name = f"{create_database(spark, 'sink')}.part"
    Transfer(src_stream=path(sf_dir, "part"), tgt_conn="SPARK", tgt_object=name, spark=spark).run()
    return Transfer(src_conn="SPARK", src_stream=name, spark=spark).dataframe()


@scenario("sink_csv_options", """
SELECT o_orderkey || ';' || o_orderstatus || ';' || strftime(o_orderdate, '%Y/%m/%d') AS value
FROM orders""")
def sink_csv_options(spark, sf_dir):
    """No header, another delimiter, another time format: the raw lines."""
    target = scratch_path(spark, "sink")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    write_files(orders, target, "csv", TargetOptions(header=False, delimiter=";",
                                                     datetime_format="yyyy/MM/dd"))
    return spark.read.text(target)


@scenario("sink_compressed", "SELECT 'gz' AS suffix, CAST(count(*) AS BIGINT) AS n_rows FROM orders")
def sink_compressed(spark, sf_dir):
    target = scratch_path(spark, "sink")
    write_files(read(spark, sf_dir, "orders"), target, "csv", TargetOptions(compression="gzip"))
    lines = spark.read.option("header", True).csv(target)
    suffix = F.element_at(F.split(F.col("_metadata.file_name"), "\\."), -1)
    return lines.groupBy(suffix.alias("suffix")).agg(F.count(F.lit(1)).alias("n_rows"))


@scenario("sink_file_max_rows", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, TRUE AS within_limit FROM orders""")
def sink_file_max_rows(spark, sf_dir):
    target = scratch_path(spark, "sink")
    write_files(read(spark, sf_dir, "orders"), target, "parquet", TargetOptions(file_max_rows=400))
    sizes = spark.read.parquet(target).groupBy(F.col("_metadata.file_name")).count()
    return sizes.agg(F.sum("count").alias("n_rows"),
                     F.bool_and(F.col("count") <= 400).alias("within_limit"))


@scenario("sink_file_max_bytes", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, TRUE AS near_limit FROM orders""")
def sink_file_max_bytes(spark, sf_dir):
    """The size is a target: files stay within a tenth of it."""
    target = scratch_path(spark, "sink")
    write_files(read(spark, sf_dir, "orders"), target, "csv", TargetOptions(file_max_bytes=50_000))
    files = spark.read.format("binaryFile").load(target).agg(
        F.bool_and(F.col("length") <= 55_000).alias("near_limit"))
    rows = spark.read.option("header", True).csv(target).agg(F.count("o_orderkey").alias("n_rows"))
    return rows.withColumn("near_limit", F.lit(bool(files.first()["near_limit"])))


@scenario("table_keys_partition", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def table_keys_partition(spark, sf_dir):
    """A partitioned and bucketed table; the filter prunes its partitions."""
    name = f"{create_database(spark, 'keys')}.orders"
    target = CatalogTable(spark, name, TargetOptions(table_keys={
        "partition": ["o_orderstatus"], "bucket": ["o_orderkey"], "buckets": 4,
        "sort": ["o_orderkey"]}))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    load(orders, target, LoadSpec())
    return target.read().where("o_orderstatus = 'F'")


@scenario("table_ddl", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal
FROM customer""")
def table_ddl(spark, sf_dir):
    """The target is created from the given statement, then filled."""
    name = f"{create_database(spark, 'ddl')}.customer"
    Transfer(src_stream=path(sf_dir, "customer"), tgt_conn="SPARK", tgt_object=name, spark=spark,
             tgt_options={"table_ddl": "CREATE TABLE {table} (c_custkey STRING, c_name STRING, "
                                       "c_acctbal DECIMAL(12,2)) USING parquet"}).run()
    return spark.table(name)


@scenario("pre_post_sql", """
SELECT 'before' AS moment, CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 'after', CAST(count(*) AS BIGINT) FROM nation""")
def pre_post_sql(spark, sf_dir):
    database = create_database(spark, "sql")
    spark.sql(f"CREATE TABLE {database}.nation USING parquet AS "
              f"SELECT * FROM parquet.`{path(sf_dir, 'nation')}` WHERE n_nationkey < 0")
    count = "INSERT INTO {0}.counts SELECT '{1}', count(*) FROM {0}.nation"
    Transfer(src_stream=path(sf_dir, "nation"), tgt_conn="SPARK", tgt_object=f"{database}.nation",
             spark=spark, tgt_options={
                 "pre_sql": f"CREATE TABLE {database}.counts (moment STRING, n_rows BIGINT) "
                            "USING parquet;\n" + count.format(database, "before"),
                 "post_sql": count.format(database, "after")}).run()
    return spark.table(f"{database}.counts")
