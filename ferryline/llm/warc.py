"""WARC archives with a two-level capture index.

Pages become gzip-compressed WARC records in archive files of the shared store.
The index sorts the captures by URL key (reversed host, then path) into
compressed blocks; a sparse directory keeps the first and last key of every
block of a shard, and a list of shards stands above it. A look-up bisects the
shards, bisects one directory, and then reads ranges only: the block, and from
there the records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.fs import ClusterFiles
from ferryline.operators.joins import keyed_join
from ferryline.session import scratch_path
from ferryline.sinks.files import local_or_remote, commit_file, task_ids

from .shared import query, stage, table, text_of

BLOCK_LINES = 500
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
BLOCK = T.StructType([
    T.StructField("shard", T.StringType()), T.StructField("first_key", T.StringType()),
    T.StructField("last_key", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("lines", T.LongType())])


def url_key(url: str | Column) -> Column:
    """``com,example,www)/path?query`` of a URL: host lower-cased and reversed,
    user and port removed, fragment dropped. Null gives the empty key; a URL
    without scheme and host is its own path."""
    url = text_of(url)
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    rest = F.regexp_replace(
        F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", ""), r"#.*$", "")
    return F.when(url == "", F.lit("")).otherwise(F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


# -- records ---------------------------------------------------------------------


def record_bytes(fields: dict[str, str | None], payload: bytes, digest: str,
                 revisit: bool) -> bytes:
    """One compressed WARC record; a revisit holds the HTTP head without payload."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    head = {"WARC-Type": "revisit" if revisit else "response",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE,
            "WARC-Payload-Digest": f"sha1:{digest}",
            "Content-Type": "application/http; msgtype=response",
            "WARC-Profile": PROFILE if revisit else None, **fields,
            "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in head.items() if v is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") \
        + packer.flush()


def _one_line(value: str) -> str:
    """A header value: its backslashes and control characters escaped."""
    return "".join(c if c >= " " and c not in "\\\x7f" else f"\\x{ord(c):02x}" for c in value)


def _plain(value: str | None) -> str | None:
    if value is None or "\\" not in value:
        return value
    parts = value.split("\\x")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def parse_record(raw: bytes) -> tuple[dict[str, str], int, bytes | None]:
    """Header fields, payload length and payload (None for a revisit) of a
    compressed record; its payload must match its digest."""
    record = zlib.decompress(raw, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    if fields["WARC-Type"] == "revisit":
        return fields, size, None
    if fields["WARC-Payload-Digest"] != f"sha1:{payload_digest(payload)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, size, payload


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- archives --------------------------------------------------------------------


def write_archives(pages: DataFrame, folder: str, id_column: str, url: str, html: str,
                   min_bytes: int) -> DataFrame:
    """Write a record per row to archive files; returns their captures.

    A file is named after the attempt that wrote it, and only the captures of
    committed tasks are kept, so captures always match the file they name.
    """
    spark = pages.sparkSession
    folder = ClusterFiles(spark).qualified(folder)
    body = text_of(html)
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).cast("string").alias("url"),
                        url_key(url).alias("key"), body.alias("html"),
                        F.unhex(F.sha1(body)).alias("sha"))
    first = (pages.select(F.col(id_column).alias("id"), F.unhex(F.sha1(body)).alias("sha"))
             .groupBy("sha").agg(F.min("id").alias("first")))
    judged = keyed_join(rows, first, ["sha"], "left").select(
        F.col("id").cast("string"), "url", "key", "html",
        F.when((F.octet_length("html") >= min_bytes) & ~F.coalesce(
            F.col("id") == F.col("first"), F.col("first").isNull()), F.col("first"))
        .cast("string").alias("first"))

    def run(batches):
        part, attempt = task_ids()
        name = f"pages-{part:05d}-{attempt}.warc.gz"
        keys, offsets, lengths = [], [], []

        def produce(out):
            at = 0
            for batch in batches:
                for page, link, key, text, refers in zip(*[c.to_pylist() for c in batch.columns]):
                    payload = text.encode()
                    raw = record_bytes(
                        {"WARC-Target-URI": link, "Page-ID": page, "Refers-To-Page-ID": refers},
                        payload, payload_digest(payload), refers is not None)
                    out.write(raw)
                    keys.append(key)
                    offsets.append(at)
                    lengths.append(len(raw))
                    at += len(raw)

        commit_file(folder, name, attempt, produce)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([name] * len(keys), pa.string()),
             pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], CAPTURE.names)

    return stage(judged.mapInArrow(run, CAPTURE), "llm-captures")


# -- index -----------------------------------------------------------------------


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures into compressed blocks and write each shard's directory.

    The range partitioning sorts by key, file and offset, so a key with much of
    all captures is spread over shards and blocks as any other keys are.
    """
    spark = captures.sparkSession
    folder = ClusterFiles(spark).qualified(folder)
    order = ["key", "file", "offset"]

    def run(batches):
        part, attempt = task_ids()
        name = f"index-{part:05d}-{attempt}"
        entries: list[tuple] = []

        def produce(out):
            at, held = 0, []

            def flush():
                nonlocal at, held
                raw = zlib.compress("\n".join(x[1] for x in held).encode())
                out.write(raw)
                entries.append((name, held[0][0], held[-1][0], at, len(raw), len(held)))
                at, held = at + len(raw), []

            for batch in batches:
                for key, *place in zip(*[c.to_pylist() for c in batch.columns]):
                    held.append((key, json.dumps([key, *place])))
                    if len(held) == block_lines:
                        flush()
            if held:
                flush()

        commit_file(folder, name, attempt, produce)
        if entries:
            commit_file(folder, f"{name}.dir", attempt,
                        lambda out: out.write(json.dumps([e[1:] for e in entries]).encode()))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(BLOCK.names, e)) for e in entries],
            schema=pa.schema([(f.name, pa.string() if f.dataType == T.StringType()
                               else pa.int64()) for f in BLOCK.fields]))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stage(ordered.select(CAPTURE.names).mapInArrow(run, BLOCK), "llm-index-blocks")


def _read_range(folder: str, name: str, offset: int, length: int, cache: dict) -> bytes:
    """Bytes of a file of the store; ``cache`` holds the file last opened."""
    if cache.get("name") != name:
        if "file" in cache:
            cache["file"].close()
        filesystem, root = local_or_remote(folder)
        cache.update(name=name, file=filesystem.open_input_file(f"{root}/{name}"))
    file = cache["file"]
    if length < 0:
        length = file.size()
    return file.read_at(length, offset)


def find_blocks(keys: DataFrame, blocks: DataFrame, folder: str) -> DataFrame:
    """``shard, offset, length, key`` of every block that may hold a key, by two
    bisections. The list of shards has one row per index task (at most
    ``spark.sql.shuffle.partitions``); directories are read where needed."""
    shards = sorted((r["first"], r["last"], r["shard"]) for r in blocks.groupBy("shard").agg(
        F.min("first_key").alias("first"), F.max("last_key").alias("last")).collect())
    firsts, lasts = [s[0] for s in shards], [s[1] for s in shards]
    folder = ClusterFiles(keys.sparkSession).qualified(folder)
    schema = T.StructType([BLOCK["shard"], BLOCK["offset"], BLOCK["length"], CAPTURE["key"]])

    def run(batches):
        opened, held = {}, (None, [], [], [])
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                for shard in shards[bisect_left(lasts, key):bisect_right(firsts, key)]:
                    if held[0] != shard[2]:
                        entries = json.loads(_read_range(folder, f"{shard[2]}.dir", 0, -1, opened))
                        held = (shard[2], entries, [e[0] for e in entries],
                                [e[1] for e in entries])
                    _, entries, begin, end = held
                    for e in entries[bisect_left(end, key):bisect_right(begin, key)]:
                        found.append((shard[2], e[2], e[3], key))
            columns = zip(*found) if found else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k in (1, 2) else pa.string())
                 for k, c in enumerate(columns)], schema.names)

    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = keys.select("key").distinct()
    return (distinct.repartitionByRange(n, "key").sortWithinPartitions("key")
            .mapInArrow(run, schema))


def read_captures(found: DataFrame, folder: str, archives: str, id_type: T.DataType,
                  with_payload: bool) -> DataFrame:
    """Records of the keys found: each block is read and bisected once, then the
    records are read by range in the order of their files."""
    spark = found.sparkSession
    folder = ClusterFiles(spark).qualified(folder)
    archives = ClusterFiles(spark).qualified(archives)
    schema = T.StructType([
        T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.StringType()), T.StructField("payload", T.BinaryType())])
    arrow = pa.schema([(f.name, {"payload_bytes": pa.int64(), "payload": pa.binary()}.get(
        f.name, pa.string())) for f in schema.fields])

    def records(places) -> Iterator[pa.RecordBatch]:
        rows, held, opened = [], 0, {}
        for file, offset, length in sorted(places):
            fields, size, payload = parse_record(
                _read_range(archives, file, offset, length, opened))
            rows.append((fields.get("Page-ID"), fields.get("WARC-Target-URI"), size,
                         fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                         fields["WARC-Type"], fields.get("Refers-To-Page-ID"),
                         payload if with_payload else None))
            held += size if with_payload else 0
            if held > 8 << 20:
                yield _batch(rows, arrow)
                rows, held = [], 0
        if rows:
            yield _batch(rows, arrow)

    def run(batches):
        block, keys, opened = None, [], {}

        def captures():
            raw = zlib.decompress(_read_range(folder, *block, opened)).decode()
            entries = [json.loads(x) for x in raw.split("\n")]
            order = [e[0] for e in entries]
            for key in keys:
                for e in entries[bisect_left(order, key):bisect_right(order, key)]:
                    yield tuple(e[1:])

        for batch in batches:
            for shard, offset, length, key in zip(*[c.to_pylist() for c in batch.columns]):
                if block != (shard, offset, length):
                    if block:
                        yield from records(captures())
                    block, keys = (shard, offset, length), []
                keys.append(key)
        if block:
            yield from records(captures())

    # A fixed number of tasks: the keys are small, what is read for them is not.
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = found.repartition(tasks, "shard", "offset").sortWithinPartitions("shard", "offset")
    return (grouped.mapInArrow(run, schema)
            .withColumn("page_id", F.col("page_id").cast(id_type))
            .withColumn("refers_to", F.col("refers_to").cast(id_type)))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)]
    for k in (0, 1, 5):
        columns[k] = [_plain(v) for v in columns[k]]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class WarcStore:
    """Archives and index in one folder of the shared store."""

    def __init__(self, spark: SparkSession, folder: str, id_type: T.DataType, blocks: DataFrame):
        self.spark, self.folder, self.id_type, self.blocks = spark, folder, id_type, blocks

    @classmethod
    def write(cls, pages: DataFrame, folder: str | None = None, id_column: str = "page_id",
              url: str = "url", html: str = "html", min_bytes: int = 0,
              block_lines: int = BLOCK_LINES) -> WarcStore:
        """Write a record per row, then the index.

        Of rows with equal payloads of at least ``min_bytes`` the one with the
        smallest id is a response (all of them where it is repeated, or where no
        row has an id) and the others revisit it. Null html is the empty
        payload; null ids and URLs stay null; any text is allowed in a URL.
        Other columns are not read. Empty tables give an empty store.
        """
        spark = pages.sparkSession
        folder = folder or scratch_path(spark, "llm-warc")
        captures = write_archives(pages, f"{folder}/archive", id_column, url, html, min_bytes)
        blocks = write_index(captures, f"{folder}/index", block_lines)
        return cls(spark, folder, pages.schema[id_column].dataType, blocks)

    def look_up(self, urls: DataFrame, url: str = "url", with_payload: bool = True) -> DataFrame:
        """Every record of every URL of ``urls``: ``page_id, url, payload_bytes,
        payload_digest, record_type, refers_to, payload`` (null for revisits).
        URLs that differ in scheme, port or fragment share a key."""
        keys = urls.select(url_key(url).alias("key"))
        found = find_blocks(keys, self.blocks, f"{self.folder}/index")
        return read_captures(found, f"{self.folder}/index", f"{self.folder}/archive",
                             self.id_type, with_payload)


OP7_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(
           [CAST(bits[5 * k + j] AS INTEGER) << (5 - j) FOR j IN range(1, 6)])::BIGINT, 1)
         FOR k IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN firsts USING (html)
"""


@query("op7_warc", OP7_SQL)
def op7(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return WarcStore.write(pages).look_up(pages, with_payload=False).drop("url", "payload")
