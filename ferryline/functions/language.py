"""Expressions as a specification writes them, rewritten to Spark SQL.

Operators, literals and most function names are Spark's own already. What differs
is rewritten call by call: ``date_add(t, n, "day")``, ``%`` patterns in
``date_format`` and ``date_parse``, ``length`` of a list, ``is_null``, ``require``
for a value of any type, ``!x``, ``&&`` and double-quoted text. Names are
``record.a``, ``state.b``, ``response.c``, ``sync.d`` and whatever else the
DataFrame at hand has as a struct column.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import one_row
from .expressions import spark_pattern

_TOKEN = re.compile(
    r"""(?P<space>\s+)|(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
    r"""|(?P<name>[A-Za-z_]\w*(?:\.[A-Za-z_]\w*|\.`[^`]+`)*)|(?P<number>\d+(?:\.\d+)?)"""
    r"""|(?P<mark>&&|!=|==|<=|>=|<=>|[()\[\],!]|[^\s])""", re.DOTALL)


@dataclass
class Call:
    name: str
    arguments: list[list]


@dataclass
class Group:
    items: list


def _tokens(text: str) -> list[tuple[str, str]]:
    return [(m.lastgroup, m[0]) for m in _TOKEN.finditer(text)]


def _read(tokens: list, at: int, closing: str | None) -> tuple[list[list], int]:
    """Comma separated item lists up to ``closing``."""
    parts: list[list] = [[]]
    while at < len(tokens):
        kind, text = tokens[at]
        if text == closing and kind == "mark":
            return parts, at + 1
        if kind == "mark" and text == ",":
            parts.append([])
        elif kind == "mark" and text == "(":
            inner, after = _read(tokens, at + 1, ")")
            before = parts[-1][-1] if parts[-1] else None
            if isinstance(before, tuple) and before[0] == "name" and before[1].upper() not in (
                    "AND", "OR", "NOT", "IN"):
                parts[-1][-1] = Call(before[1], inner if inner != [[]] else [])
            else:
                parts[-1].append(Group([x for k, p in enumerate(inner)
                                        for x in ([("mark", ",")] if k else []) + p]))
            at = after
            continue
        elif kind == "mark" and text in (")", "]") and text != closing:
            parts[-1].append((kind, text))
        elif kind != "space":
            parts[-1].append((kind, text))
        at += 1
    if closing:
        raise ValueError(f"{closing!r} is missing in an expression")
    return parts, at


def _quoted(token: str) -> str:
    if token.startswith("'"):
        return token
    inner = re.sub(r'\\(.)', lambda m: m[1] if m[1] in '"' else m[0], token[1:-1])
    return "'" + inner.replace("'", "\\'") + "'"


def _plain(sql: str, what: str) -> str:
    if not (len(sql) > 1 and sql[0] == sql[-1] == "'"):
        raise ValueError(f"{what} must be a text, not {sql}")
    return sql[1:-1]


class _Writer:
    """Writes items as Spark SQL; ``kind`` tells the type of a piece of SQL."""

    def __init__(self, kind: Callable[[str], T.DataType]):
        self.kind = kind

    def items(self, items: list) -> str:
        out, k = [], 0
        while k < len(items):
            item = items[k]
            if item == ("mark", "!"):
                if k + 1 == len(items):
                    raise ValueError("nothing follows '!'")
                end = k + 1
                while items[end] == ("mark", "!"):
                    end += 1
                out.append(f"(NOT {self.items(items[k + 1:end + 1])})")
                k = end + 1
                continue
            out.append(self.item(item))
            k += 1
        return " ".join(out)

    def item(self, item) -> str:
        if isinstance(item, Group):
            return f"({self.items(item.items)})"
        if isinstance(item, Call):
            return self.call(item.name.lower(), item.name, [self.items(a) for a in item.arguments])
        kind, text = item
        if kind == "text":
            return _quoted(text)
        return "AND" if text == "&&" else text

    def time(self, sql: str) -> str:
        """Text given where a time is meant is read as one."""
        return f"try_to_timestamp({sql})" if isinstance(self.kind(sql), T.StringType) else sql

    def call(self, name: str, written: str, args: list[str]) -> str:
        if name == "date_add" and len(args) == 3:
            unit = _plain(args[2], "a unit").upper().rstrip("S")
            return f"timestampadd({unit}, CAST({args[1]} AS INT), {self.time(args[0])})"
        if name == "date_format" and len(args) == 2 and "%" in args[1]:
            pattern = spark_pattern(_plain(args[1], "a pattern")).replace("'", "\\'")
            return f"date_format({self.time(args[0])}, '{pattern}')"
        if name == "date_parse" and args:
            pattern = ""
            if len(args) > 1:
                own = _plain(args[1], "a pattern")
                pattern = ", '" + (spark_pattern(own) if "%" in own else own).replace(
                    "'", "\\'") + "'"
            return f"CAST(try_to_timestamp({args[0]}{pattern}) AS TIMESTAMP_NTZ)"
        if name == "is_null" and len(args) == 1:
            return f"({args[0]} IS NULL)"
        if name == "require" and len(args) == 2:
            return f"coalesce({args[0]}, raise_error({args[1]}))"
        if name == "length" and args == ["response.records"]:
            return "response.record_count"
        if name == "length" and len(args) == 1:
            listed = isinstance(self.kind(args[0]), (T.ArrayType, T.MapType))
            return f"size({args[0]})" if listed else f"length({args[0]})"
        return f"{written}({', '.join(args)})"


def spark_sql(text: str, kind: Callable[[str], T.DataType]) -> str:
    """``text`` as Spark SQL."""
    parts, _ = _read(_tokens(text), 0, None)
    if len(parts) != 1:
        raise ValueError(f"a comma outside of a call: {text}")
    return _Writer(kind).items(parts[0])


def expression(df: DataFrame, text: str) -> Column:
    """``text`` as a column over ``df``, whose schema settles what depends on types."""
    return F.expr(spark_sql(text, lambda sql: df.select(F.expr(sql)).schema[0].dataType))


# -- values of a specification -------------------------------------------------------

_BRACES = re.compile(r"\{((?:[^{}'\"]|'[^']*'|\"[^\"]*\")*)\}")


def scope_columns(scope: dict[str, dict]) -> list[Column]:
    """One struct column per name space; what cannot be a literal is left out."""
    columns = []
    for space, values in scope.items():
        fields = []
        for name, value in values.items():
            if value is None:
                fields.append(F.lit(None).cast("string").alias(name))
            elif isinstance(value, (list, tuple)) and not any(
                    isinstance(v, (dict, list)) for v in value):
                fields.append(F.array(*[F.lit(v) for v in value]).alias(name))
            elif not isinstance(value, (dict, list, tuple)):
                fields.append(F.lit(value).alias(name))
        columns.append((F.struct(*fields) if fields else F.struct(F.lit(None).alias("_"))).alias(space))
    return columns


def rendered(spark: SparkSession, value, scope: dict[str, dict]):
    """A value with its ``{...}`` parts evaluated. A text that is one such part
    keeps the type of its expression; others become text."""
    if not isinstance(value, str) or "{" not in value:
        return value
    one = one_row(spark).select(*scope_columns(scope))

    def evaluate(inner: str):
        return one.select(expression(one, inner).alias("v")).first()["v"]

    whole = _BRACES.fullmatch(value.strip())
    if whole:
        return evaluate(whole[1])
    return _BRACES.sub(lambda m: str(evaluate(m[1])), value)


def rendered_state(spark: SparkSession, state: dict | None, scope: dict[str, dict]) -> dict:
    """The values of a state, each evaluated over those before it and ``scope``."""
    done: dict = {}
    for name, value in (state or {}).items():
        done[name] = rendered(spark, value, {**scope, "state": done})
    return done
