"""Files that stay within a number of bytes.

Each task renders its rows, counts what it writes and begins another file before
one would grow beyond the limit. A row larger than the limit is a file of its own.
Sizes are those of the text or Arrow bytes; compression only makes files smaller.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TargetOptions
from ..operators.shape import column
from .files import (
    MANIFEST, _save_with_tasks, _text_safe, arrow_schema, commit_file, task_ids)

#: What each text format writes around its rows: opening, between two rows, closing.
_AROUND = {"csv": ("", "\n", "\n"), "jsonlines": ("", "\n", "\n"), "json": ("[\n", ",\n", "\n]\n")}


def can_be_sized(fmt: str, codec: str) -> bool:
    return fmt in ("csv", "jsonlines", "json", "arrow") and codec in ("auto", "none", "gzip", "zip")


class _Ahead:
    """An iterator whose next item can be looked at."""

    def __init__(self, items: Iterator):
        self.items, self.held = items, []

    def peek(self):
        if not self.held:
            item = next(self.items, None)
            if item is None:
                return None
            self.held.append(item)
        return self.held[0]

    def take(self):
        item = self.peek()
        self.held.clear()
        return item


def _lines(df: DataFrame, fmt: str, options: TargetOptions) -> DataFrame:
    """Every row as one text."""
    names = [column(c) for c in df.columns]
    if fmt == "csv":
        rows = df.select(*[_text_safe(f) for f in df.schema.fields])
        settings = {"escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
                    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS XXX",
                    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        if options.delimiter:
            settings["sep"] = options.delimiter
        stamp = options.datetime_format
    else:
        rows, stamp = df, options.datetime_format
        settings = {"ignoreNullFields": "false",
                    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    if stamp:
        settings |= {"timestampNTZFormat": stamp, "timestampFormat": stamp}
    fields = F.struct(*names)
    text = F.to_csv(fields, settings) if fmt == "csv" else F.to_json(fields, settings)
    return rows.select(text.alias("value"))


def write_sized(df: DataFrame, path: str, fmt: str, codec: str, options: TargetOptions,
                mode: str) -> DataFrame:
    """Write ``df`` in files of at most ``file_max_bytes`` bytes (and ``file_max_rows``
    rows); returns the manifest. Of tasks without rows only the first writes a file,
    so an empty table is one empty file."""
    if not df.take(1):
        df = df.sparkSession.createDataFrame([], df.schema).coalesce(1)
    limit, most = int(options.file_max_bytes), int(options.file_max_rows or 0)
    if fmt == "arrow":
        return _save_with_tasks(df, path, _arrow_files(df, limit, most), mode)
    header = None
    if fmt == "csv" and options.header is not False:
        header = df.sparkSession.range(1).select(F.to_csv(
            F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)]),
            {"escape": '"', "sep": options.delimiter or ","}).alias("h")).first()["h"]
    return _save_with_tasks(_lines(df, fmt, options), path,
                            _text_files(fmt, codec, header, limit, most), mode)


def _text_files(fmt: str, codec: str, header: str | None, limit: int, most: int):
    opening, between, closing = (x.encode() for x in _AROUND[fmt])
    opening += (header + "\n").encode() if header is not None else b""
    suffix = {"jsonlines": "jsonl"}.get(fmt, fmt)
    ending = {"gzip": ".gz", "zip": ".zip"}.get(codec, "")
    manifest = arrow_schema(MANIFEST)

    def write_partition(folder, prefix):
        def run(batches):
            pid, attempt = task_ids()
            rows = _Ahead(v.encode() for b in batches for v in b.column(0).to_pylist())
            part = 0
            while rows.peek() is not None or (part == 0 and pid == 0):
                count = 0

                def fill(out):
                    nonlocal count
                    out.write(opening)
                    size = len(opening) + len(closing)
                    while (row := rows.peek()) is not None:
                        grown = size + len(row) + (len(between) if count else 0)
                        if count and (grown > limit or count == most):
                            break
                        out.write(between + row if count else row)
                        size, count = grown, count + 1
                        rows.take()
                    if count or fmt == "json":
                        out.write(closing)

                name = f"{prefix}-{pid:05d}-{part}.{suffix}"

                def produce(out):
                    if codec == "zip":
                        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                            with archive.open(name, "w") as member:
                                fill(member)
                    elif codec == "gzip":
                        with pa.CompressedOutputStream(out, "gzip") as packed:
                            fill(packed)
                    else:
                        fill(out)

                done = commit_file(folder, name + ending, attempt, produce)
                part += 1
                yield pa.RecordBatch.from_pydict({"file": [done], "rows": [count]},
                                                 schema=manifest)
        return run

    return write_partition


def _ipc_size(batch: pa.RecordBatch) -> int:
    """Bytes of a batch in an Arrow file, with its entry in the footer."""
    return pa.ipc.get_record_batch_size(batch) + 64


def _pieces(batches, kind: pa.Schema, limit: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches halved until each fits by itself."""
    waiting = []
    for batch in batches:
        waiting.append(batch.cast(kind))
        while waiting:
            piece = waiting.pop()
            if piece.num_rows > 1 and (_ipc_size(piece) > limit or most and piece.num_rows > most):
                half = piece.num_rows // 2
                waiting += [piece.slice(half), piece.slice(0, half)]
            elif piece.num_rows:
                # A slice keeps its parent's buffers; only what it shows is to be written.
                yield pa.Table.from_batches([piece]).take(
                    pa.array(range(piece.num_rows))).to_batches()[0]


def _arrow_files(df: DataFrame, limit: int, most: int):
    kind, manifest = arrow_schema(df.schema), arrow_schema(MANIFEST)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, kind):
        pass
    empty = sink.getvalue().size

    def write_partition(folder, prefix):
        def run(batches):
            pid, attempt = task_ids()
            # A sixteenth of a file at a time, so that files are filled well.
            pieces = _Ahead(_pieces(batches, kind, max(1, (limit - empty) // 16), most))
            part = 0
            while pieces.peek() is not None or (part == 0 and pid == 0):
                count = 0

                def produce(out):
                    nonlocal count
                    size = empty
                    with pa.ipc.new_file(out, kind) as writer:
                        while (piece := pieces.peek()) is not None:
                            grown = size + _ipc_size(piece)
                            if count and (grown > limit or most and count + piece.num_rows > most):
                                break
                            writer.write_batch(piece)
                            size, count = grown, count + piece.num_rows
                            pieces.take()

                done = commit_file(folder, f"{prefix}-{pid:05d}-{part}.arrow", attempt, produce)
                part += 1
                yield pa.RecordBatch.from_pydict({"file": [done], "rows": [count]},
                                                 schema=manifest)
        return run

    return write_partition
