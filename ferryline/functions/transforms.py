"""Named value transforms, each a Spark built-in; anything else is a SQL
expression in which ``value`` stands for the column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Transform names and the built-in each one stands for.
NAMED = {
    "trim": F.trim,
    "trim_space": F.trim,
    "upper": F.upper,
    "lower": F.lower,
    "nullif_empty": lambda c: F.nullif(c, F.lit("")),
    "empty_as_null": lambda c: F.nullif(c, F.lit("")),
    "hash_md5": lambda c: F.md5(c.cast("string")),
    "hash_sha256": lambda c: F.sha2(c.cast("string"), 256),
    "parse_json": F.try_parse_json,
}


def named_transform(name: str, value: Column) -> Column | None:
    build = NAMED.get(name.strip().lower())
    return build(value) if build else None


def transform_column(df: DataFrame, name: str, transform: str) -> DataFrame:
    if name not in df.columns:
        raise ValueError(f"transform on unknown column {name!r}")
    built = named_transform(transform, F.col("`" + name.replace("`", "``") + "`"))
    if built is not None:
        return df.withColumn(name, built)
    if name == "value":
        return df.withColumn(name, F.expr(transform))
    # A column really called "value" steps aside while the expression is bound.
    order = df.columns
    aside = "__other_value"
    held = df.withColumnRenamed("value", aside) if "value" in order else df
    done = held.withColumn("value", F.col("`" + name.replace("`", "``") + "`"))
    done = done.withColumn(name, F.expr(transform)).drop("value")
    if "value" in order:
        done = done.withColumnRenamed(aside, "value")
    return done.select(*["`" + c.replace("`", "``") + "`" for c in order])
