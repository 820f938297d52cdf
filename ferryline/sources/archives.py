"""Readers for container formats Spark has no source for: Arrow IPC, zip, Excel.

Spark lists the files (``binaryFile``) and spreads them over tasks; each task
decodes what it was given and streams rows out in batches. Arrow files are read by
ranges of record batches. A zip archive or workbook is held by one task, and
binaryFile limits it to 2 GiB.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SourceOptions
from ..operators.schema import common_type
from ..sinks.files import arrow_schema, local_or_remote, opens_in_tasks

BATCH_ROWS = 10_000


def _files(spark: SparkSession, paths, pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths).select("path", "content")


# -- Arrow -------------------------------------------------------------------------


def _open_ipc(content: bytes):
    buffer = pa.py_buffer(content)
    if content[:6] == b"ARROW1":
        reader = pa.ipc.open_file(buffer)
        return reader.schema, (reader.get_batch(i) for i in range(reader.num_record_batches))
    stream = pa.ipc.open_stream(buffer)
    return stream.schema, iter(stream)


def arrow_file_schema(files: DataFrame) -> T.StructType:
    """Union of the files' schemas, by name. The schemas are read inside tasks;
    only the distinct ones come back."""
    def describe(batches):
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            for content in batch.column(0):
                schema, _ = _open_ipc(content.as_py())
                text = from_arrow_schema(schema, prefer_timestamp_ntz=True).json()
                yield pa.RecordBatch.from_pydict({"schema": [text]})

    rows = (files.select("content").mapInArrow(describe, "schema string").groupBy("schema")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "schema").collect())
    if not rows:
        raise ValueError("no Arrow files to read")
    return _united([r["schema"] for r in rows])


def _united(schemas: list[str]) -> T.StructType:
    """Fields of all schemas (as JSON), by name, with types that hold them all."""
    fields: dict[str, T.DataType] = {}
    for text in schemas:
        for field in T.StructType.fromJson(json.loads(text)):
            held = fields.get(field.name)
            fields[field.name] = field.dataType if held is None else common_type(
                held, field.dataType)
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def read_arrow(spark: SparkSession, paths, schema: T.StructType | None = None,
               stream_url: bool = False) -> DataFrame:
    """Arrow files, united by name. Where tasks can open the paths by themselves, a
    file's record batches are dealt out and read by range, by as many tasks as there
    are; elsewhere, and for Arrow streams, which have no directory, one task reads
    a file."""
    files = _files(spark, paths)
    url = [T.StructField("_stream_url", T.StringType())] if stream_url else []
    ranged = _in_ranges(files)
    if ranged is None:
        schema = schema or arrow_file_schema(files)
    else:
        dealt, found = ranged
        schema = schema or found
    wanted, out = arrow_schema(schema), T.StructType(schema.fields + url)
    kind = arrow_schema(out)

    def rows_of(path: str, found) -> Iterator[pa.RecordBatch]:
        for rows in found:
            for start in range(0, rows.num_rows, BATCH_ROWS):
                part = rows.slice(start, BATCH_ROWS)
                columns = [part.column(f.name).cast(f.type) if f.name in part.schema.names
                           else pa.nulls(part.num_rows, f.type) for f in wanted]
                if stream_url:
                    columns.append(pa.array([path] * part.num_rows, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=kind)

    def whole(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield from rows_of(path.as_py(), _open_ipc(content.as_py())[1])

    def by_range(batches):
        for batch in batches:
            for path, first, last in zip(*[c.to_pylist() for c in batch.columns]):
                with _open_path(path) as source:
                    if first is None:
                        yield from rows_of(path, pa.ipc.open_stream(source))
                    else:
                        reader = pa.ipc.open_file(source)
                        yield from rows_of(path, map(reader.get_batch, range(first, last)))

    if ranged is None:
        return files.mapInArrow(whole, out)
    return dealt.mapInArrow(by_range, out)


#: Bytes of an Arrow file that one task reads, unless a record batch is larger.
RANGE_BYTES = 64 << 20


def _open_path(path: str):
    filesystem, inner = local_or_remote(path)
    return filesystem.open_input_file(inner)


def _in_ranges(files: DataFrame) -> tuple[DataFrame, T.StructType] | None:
    """``path, first, last`` of ranges of record batches, spread over tasks, and the
    files' schema; None where tasks cannot open the paths. Only the footers of the
    files are read for it, by tasks."""
    paths = files.select("path")
    one = paths.first()
    if one is None:
        raise ValueError("no Arrow files to read")
    if not opens_in_tasks(one["path"]):
        return None

    def ranges(batches):
        from pyspark.sql.pandas.types import from_arrow_schema

        def described(path: str):
            with _open_path(path) as source:
                if source.read(6) != b"ARROW1":
                    source.seek(0)
                    schema, parts = pa.ipc.open_stream(source).schema, [(None, None)]
                else:
                    size = source.size()
                    source.seek(0)
                    reader = pa.ipc.open_file(source)
                    n = reader.num_record_batches
                    schema, step = reader.schema, max(1, n // max(1, -(-size // RANGE_BYTES)))
                    parts = [(a, min(a + step, n)) for a in range(0, n, step)] or [(0, 0)]
                text = from_arrow_schema(schema, prefer_timestamp_ntz=True).json()
                return [(path, a, b, text) for a, b in parts]

        for batch in batches:
            for path in batch.column(0).to_pylist():
                columns = [*zip(*described(path))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                    ["path", "first", "last", "schema"])

    from ..plans.targets import stage

    found = stage(paths.mapInArrow(ranges, "path string, first long, last long, schema string"),
                  "arrow-ranges")
    kinds = found.groupBy("schema").agg(F.min("path").alias("path")).orderBy("path").collect()
    n = found.count()
    spread = found.select("path", "first", "last").repartition(max(1, min(n, 10_000)))
    return spread, _united([r["schema"] for r in kinds])


# -- rows of text fields -> named columns --------------------------------------------

#: Decoded members: where they are, and their rows as lists of text.
Members = Iterator[tuple[str, Iterator[list]]]


def _text_rows(files: DataFrame, members, options: SourceOptions, stream_url: bool) -> DataFrame:
    """Columns of the rows that ``members(path, content)`` finds, each member under
    its own first row; members are united by name, in the order of the members that
    bring a name first. Without headers, or with ``fields_per_rec``, fields go by
    position and the widest first row counts."""
    header = options.header is not False
    by_name = header and not options.fields_per_rec

    def heads(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                found = [(name, next(rows, [])) for name, rows in
                         members(path.as_py(), content.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in found], pa.string()),
                     pa.array([[None if v is None else str(v) for v in r] for _, r in found],
                              pa.list_(pa.string()))], ["file", "fields"])

    first = (files.mapInArrow(heads, "file string, fields array<string>")
             .where(F.size("fields") > 0).groupBy("fields").agg(F.min("file").alias("file")))
    kinds = [_names(r["fields"]) for r in first.orderBy("file").collect()]  # kinds, not files
    if by_name:
        names = list(dict.fromkeys(n for kind in kinds for n in kind))
    else:
        width = options.fields_per_rec or max(map(len, kinds), default=0)
        own = kinds[0] if header and kinds else []
        names = [own[i] if i < len(own) else f"_c{i}" for i in range(width)]
    url = ["_stream_url"] if stream_url else []
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names + url])
    kind = arrow_schema(schema)

    def placed():
        """Rows as tuples in the order of ``names``."""
        def of(file, rows):
            places = None
            if header:
                found = {n: i for i, n in reversed([*enumerate(_names(next(rows, [])))])}
                places = [found.get(n) for n in names] if by_name else None
            for row in rows:
                at = range(len(names)) if places is None else places
                values = [row[i] if i is not None and i < len(row) else None for i in at]
                yield values + [file] if stream_url else values
        return of

    def unpack(batches):
        of, held = placed(), []

        def flushed():
            columns = [*zip(*held)] or [()] * len(kind)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], schema=kind)

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                for file, rows in members(path.as_py(), content.as_py()):
                    for values in of(file, rows):
                        held.append(values)
                        if len(held) >= BATCH_ROWS:
                            yield flushed()
                            held = []
        yield flushed()

    return files.mapInArrow(unpack, schema)


def _names(fields) -> list[str]:
    return [str(v) if v else f"_c{i}" for i, v in enumerate(fields)]


# -- zip -----------------------------------------------------------------------------


def _zip_members(fmt: str, delimiter: str):
    def members(path: str, content: bytes) -> Members:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for name in archive.namelist():
                if name.endswith("/"):
                    continue
                with archive.open(name) as member:
                    text = io.TextIOWrapper(member, encoding="utf-8-sig", newline="")
                    lines = (csv.reader(text, delimiter=delimiter) if fmt == "csv"
                             else ([line.rstrip("\r\n")] for line in text))
                    yield f"{path}#{name}", ([v if v != "" else None for v in r]
                                             for r in lines if r)
    return members


def read_zip(spark: SparkSession, paths, fmt: str, options: SourceOptions,
             stream_url: bool = False) -> DataFrame:
    """Text files inside zip archives: csv gives columns, json lines a ``data`` column."""
    members = _zip_members(fmt, options.delimiter or ",")
    if fmt == "csv":
        return _text_rows(_files(spark, paths), members, options, stream_url)
    lines = SourceOptions(header=False, fields_per_rec=1)
    return _text_rows(_files(spark, paths), members, lines, stream_url).withColumnRenamed(
        "_c0", "data")


# -- Excel ---------------------------------------------------------------------------

CELL = re.compile(r"^\$?([A-Z]+)\$?(\d+)?$")


def column_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + ord(ch) - 64
    return n


def cell_range(text: str | None) -> tuple[int, int, float, float]:
    """``A1:D100``, ``B:D`` or empty -> (first col, first row, last col, last row)."""
    if not text:
        return 1, 1, float("inf"), float("inf")
    left, _, right = text.upper().partition(":")
    one, two = CELL.match(left), CELL.match(right or left)
    if not one or not two:
        raise ValueError(f"cannot read the cell range {text!r}")
    return (column_number(one[1]), int(one[2] or 1), column_number(two[1]),
            int(two[2]) if two[2] else float("inf"))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter() if _local(t.tag) == "t")


def sheet_part(archive: zipfile.ZipFile, sheet: str | None) -> str:
    """Archive member of the named (or first) sheet."""
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in links}
    for node in (n for n in book.iter() if _local(n.tag) == "sheet"):
        if sheet is None or node.get("name") == sheet:
            link = next(v for k, v in node.attrib.items() if _local(k) == "id")
            target = targets[link]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"workbook has no sheet {sheet!r}")


def sheet_rows(content: bytes, sheet: str | None, cells: str | None):
    """Rows of one worksheet as lists of text, parsed incrementally."""
    left, top, right, bottom = cell_range(cells)
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared = []
        if "xl/sharedStrings.xml" in archive.namelist():
            root = ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in root if _local(si.tag) == "si"]
        with archive.open(sheet_part(archive, sheet)) as part:
            number = 0
            for _, node in ElementTree.iterparse(part):
                if _local(node.tag) != "row":
                    continue
                number = int(node.get("r") or number + 1)
                if top <= number <= bottom:
                    yield _row_fields(node, shared, left, right)
                node.clear()


def _row_fields(node, shared, left, right) -> list:
    values, position = {}, 0
    for cell in node:
        ref = CELL.match(cell.get("r") or "")
        position = column_number(ref[1]) if ref else position + 1
        kind = cell.get("t")
        if kind == "inlineStr":
            value = _text(cell)
        else:
            value = next((c.text for c in cell if _local(c.tag) == "v"), None)
            if value is not None and kind == "s":
                value = shared[int(value)]
            elif value is not None and kind == "b":
                value = "true" if value == "1" else "false"
        if left <= position <= right:
            values[position] = value
    last = max(values, default=left - 1)
    return [values.get(i) for i in range(left, last + 1)]


def read_xlsx(spark: SparkSession, paths, options: SourceOptions,
              stream_url: bool = False) -> DataFrame:
    """One sheet of every workbook. A sheet has at most 1,048,576 rows, so the
    work of a task is bounded by the format."""
    sheet, cells = options.sheet, options.range

    def members(path: str, content: bytes) -> Members:
        yield path, sheet_rows(content, sheet, cells)

    return _text_rows(_files(spark, paths, "*.xlsx"), members, options, stream_url)
