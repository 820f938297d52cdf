"""Delimited text inside a column, by SQL functions alone.

A text is cut at its quotes: what lies at even places is outside of them. There
line ends and delimiters are what they seem; inside they are written as escapes
until the text has been cut into records and fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The escape character, and what follows it for each escaped text.
ESCAPE = "\x1e"
ESCAPED = {"\n": "1", "\r": "2"}


def _by_quotes(text: Column, outside, inside) -> Column:
    parts = F.split(text, '"')
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 0, outside(p))
                                    .otherwise(inside(p))), '"')


def _hidden(part: Column) -> Column:
    for plain, mark in ESCAPED.items():
        part = F.replace(part, F.lit(plain), F.lit(ESCAPE + mark))
    return part


def _shown(text: Column) -> Column:
    for plain, mark in ESCAPED.items():
        text = F.replace(text, F.lit(ESCAPE + mark), F.lit(plain))
    return F.replace(text, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def records(text: Column) -> Column:
    """The records of a delimited text, line ends inside quotes still escaped."""
    safe = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    return F.split(_by_quotes(safe, lambda p: p, _hidden), "\r?\n")


def fields(record: Column, delimiter: str = ",") -> Column:
    """The fields of one of :func:`records`. Empty fields are null, quoted empty
    ones are empty texts; doubled quotes stand for one."""
    cut = ESCAPE + "3"
    apart = F.split(_by_quotes(record, lambda p: F.replace(p, F.lit(delimiter), F.lit(cut)),
                               lambda p: p), cut)

    def value(raw: Column) -> Column:
        bare = F.trim(raw)
        quoted = bare.startswith('"') & bare.endswith('"') & (F.length(bare) > 1)
        inner = F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))
        return _shown(F.when(quoted, inner).when(raw != "", raw))

    return F.transform(apart, value)


def by_header(header: Column, values: Column, schema: T.StructType) -> Column:
    """A struct of ``schema``: each field from the place its name has in
    ``header``. Absent names and unreadable values are null."""
    return F.struct(*[
        F.get(values, F.nullif(F.array_position(header, F.lit(f.name)), F.lit(0)).cast("int") - 1)
        .try_cast(f.dataType).alias(f.name) for f in schema.fields])
