"""Quality rules with host verdicts (SQL functions only).

Each text is measured on its own, inside its row. Rule failures are then summed
per host, every host's failure rates are shrunk towards a beta prior fitted to
all hosts by moments, and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.operators.joins import keyed_join

from .shared import query, stage, table, text_of

WORD = r"[^\x20\x09-\x0D]+"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityLimits:
    """Limits of the rules. A host may reach a shrunk rate of ``host_rate`` at most,
    and of ``host_excess`` times the rate of all documents, which from ``host_floor``
    on counts as excess."""
    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    dup_line_percent: int = 10
    host_rate: float = 0.5
    host_excess: float = 3.0
    host_floor: float = 0.2
    rules: tuple[str, ...] = field(
        default=("short", "repetitive", "symbols", "dup_lines"))


def measure(text: Column) -> dict[str, Column]:
    """Measures that need no word list; ``text`` must not be null."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "word_chars": F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "__lines": lines,
    }


def repeated_words(words: str) -> dict[str, Column]:
    """Columns, in order, that count the words inside repeated 3-word windows.

    The windows are sorted by their hash with their position, so equal windows
    become neighbours: n log n in the words of a text, whatever it repeats.
    """
    n = F.size(words)
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
            i.alias("p"))))
    sorted_windows = F.col("__windows")
    repeated = F.filter(
        sorted_windows,
        lambda w, i: F.coalesce(
            (F.get(sorted_windows, i - 1)["h"] == w["h"])
            | (F.get(sorted_windows, i + 1)["h"] == w["h"]),
            F.get(sorted_windows, i - 1)["h"] == w["h"],
            F.get(sorted_windows, i + 1)["h"] == w["h"],
            F.lit(False)))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        F.sort_array(F.transform("__repeated", lambda w: w["p"])), start,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"),
                              p.alias("last")),
        lambda a: a["n"])
    return {
        "__windows": F.sort_array(windows),
        "__repeated": repeated,
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
    }


def document_measures(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` plus the measures of each row's whole text; a null text has no words."""
    body = text_of(text)
    first = docs.select(*keep, F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("__words"),
                        *[c.alias(k) for k, c in measure(body).items()])
    names = [c for c in first.columns if c not in ("__words", "__lines")]
    counted = first.select(
        *names, "__words", F.size("__words").cast("long").alias("n_words"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")
        .alias("n_dup_lines"), F.size("__lines").cast("long").alias("n_lines"))
    for name, column in repeated_words("__words").items():
        counted = counted.withColumn(name, column)
    return counted.drop("__words", "__windows", "__repeated")


def rule_failures(limits: QualityLimits) -> dict[str, Column]:
    """Every rule as a boolean over the measures."""
    n = F.col("n_words")
    return {
        "short": n < limits.min_words,
        "repetitive": 100 * F.col("n_repeat_words") > limits.repeat_percent * n,
        "symbols": 100 * F.col("n_symbols") > limits.symbol_percent * n,
        "dup_lines": 100 * F.col("n_dup_lines") > limits.dup_line_percent * F.col("n_lines"),
    }


def beta_prior(n_hosts: int, docs: int, failures: int, docs_squared: float,
               weighted: float) -> tuple[float, float]:
    """Moment estimate of the beta prior over host rates.

    With each host weighted by its documents, the spread of the rates beyond
    what sampling explains gives the correlation g = 1 / (a + b + 1).
    """
    if not docs or not n_hosts:
        return 1.0, 1.0
    p = failures / docs
    if p in (0.0, 1.0):
        return p + 1e-6, 1 - p + 1e-6
    spread = (weighted - failures * failures / docs) / (p * (1 - p))
    room = docs - docs_squared / docs - (n_hosts - 1)
    g = (spread - (n_hosts - 1)) / room if room > 0 else 0.0
    g = min(max(g, 1e-4), 0.999)
    size = 1 / g - 1
    return p * size, (1 - p) * size


def host_rates(measured: DataFrame, host: str, limits: QualityLimits) -> DataFrame:
    """Per host: documents, failures and the shrunk failure rate of every rule,
    and ``host_ok``. Rows without a host belong to none."""
    fails = rule_failures(limits)
    hosts = stage(
        measured.where(F.col(host).isNotNull()).groupBy(host).agg(
            F.count(F.lit(1)).alias("host_docs"),
            *[F.count_if(fails[r]).alias(f"{r}_failures") for r in limits.rules]),
        "llm-hosts")
    n = F.col("host_docs").cast("double")
    totals = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("host_docs").alias("docs"),
        F.sum(n * n).alias("squared"),
        *[F.sum(f"{r}_failures").alias(f"{r}_k") for r in limits.rules],
        *[F.sum(F.col(f"{r}_failures") * F.col(f"{r}_failures") / n).alias(f"{r}_w")
          for r in limits.rules]).first()  # one row: the prior's sufficient statistics
    ok = F.lit(True)
    for r in limits.rules:
        a, b = beta_prior(totals["hosts"], totals["docs"] or 0, totals[f"{r}_k"] or 0,
                          totals["squared"] or 0.0, totals[f"{r}_w"] or 0.0)
        hosts = hosts.withColumn(f"{r}_rate", (F.col(f"{r}_failures") + a) / (n + (a + b)))
        overall = (totals[f"{r}_k"] or 0) / (totals["docs"] or 1)
        most = min(limits.host_rate, max(limits.host_excess * overall, limits.host_floor))
        ok = ok & (F.col(f"{r}_rate") <= most)
    return hosts.withColumn("host_ok", ok)


def quality_rules(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                  host: str = "source", limits: QualityLimits | None = None) -> DataFrame:
    """One row per input row: its id, measures, ``base_failed``, ``host_ok`` and ``kept``.

    Null or empty text: no words, so ``base_failed``. Null host: kept by the
    base rules alone, as in the SQL; symbol and duplicate-line rules only count in
    the rates of a host. Repeated rows each count and each get a row. Other columns
    of ``docs`` are not read. An empty table gives an empty result. The longest
    text stays within its row; hosts of any size only meet as partial sums, and
    the verdict joins back on host and hash so that a hot host can be split.
    """
    limits = limits or QualityLimits()
    measured = stage(document_measures(
        docs, [F.col(id_column).alias("__id"), F.col(host).cast("string").alias("__host")], text),
        "llm-measures")
    rates = host_rates(measured, "__host", limits).select("__host", "host_ok")
    fails = rule_failures(limits)
    judged = keyed_join(measured, rates, ["__host"], "left")
    failed = fails["short"] | fails["repetitive"]
    return judged.select(
        F.col("__id").alias(id_column), *MEASURES, failed.alias("base_failed"),
        (~failed & F.coalesce("host_ok", F.lit(True))).alias("kept"),
        F.coalesce("host_ok", F.lit(True)).alias("host_ok"))


def _rule_sql(rule: str) -> str:
    return f"""
      SELECT '{rule}' AS rule, source, count(*) AS n, sum(CASE WHEN {rule} THEN 1 ELSE 0 END) AS k
      FROM judged WHERE source IS NOT NULL GROUP BY source"""


OP1_SQL = f"""
WITH words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS w
  FROM documents),
measured AS (
  SELECT r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, w,
         CAST(length(regexp_replace(body, '[ \\t\\n\\x0B\\f\\r]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         [x FOR x IN string_split(body, chr(10))
          IF regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')] AS lines
  FROM words),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM measured, unnest(range(1, n_words - 1)) AS t(i)),
repeated AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM windows)
             WHERE c > 1),
covered AS (
  SELECT r, sum(least(3, i - coalesce(prev, -3))) AS n_repeat_words
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS prev FROM repeated) GROUP BY r),
judged AS (
  SELECT m.*, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 50 AS short,
         100 * coalesce(n_repeat_words, 0) > 50 * n_words AS repetitive,
         100 * n_symbols > 10 * n_words AS symbols,
         100 * (len(lines) - len(list_distinct(lines))) > 10 * len(lines) AS dup_lines
  FROM measured m LEFT JOIN covered c USING (r)),
failures AS ({" UNION ALL ".join(_rule_sql(r) for r in QualityLimits().rules)}),
totals AS (
  SELECT rule, count(*) AS h, CAST(sum(n) AS DOUBLE) AS d, CAST(sum(k) AS DOUBLE) AS f,
         sum(CAST(n AS DOUBLE) * n) AS sq, sum(CAST(k AS DOUBLE) * k / n) AS wt
  FROM failures GROUP BY rule),
spread AS (
  SELECT *, f / d AS p,
         CASE WHEN f = 0 OR f = d OR d - sq / d - (h - 1) <= 0 THEN 0
              ELSE ((wt - f * f / d) / ((f / d) * (1 - f / d)) - (h - 1))
                   / (d - sq / d - (h - 1)) END AS g FROM totals),
priors AS (
  SELECT rule, least(0.5, greatest(3.0 * p, 0.2)) AS most,
         CASE WHEN p IN (0, 1) THEN p + 1e-6 ELSE p * (1 / least(greatest(g, 1e-4), 0.999) - 1) END AS a,
         CASE WHEN p IN (0, 1) THEN 1 - p + 1e-6
              ELSE (1 - p) * (1 / least(greatest(g, 1e-4), 0.999) - 1) END AS b FROM spread),
verdicts AS (
  SELECT source, bool_and((k + a) / (n + (a + b)) <= most) AS ok
  FROM failures JOIN priors USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       short OR repetitive AS base_failed,
       NOT (short OR repetitive) AND coalesce(ok, true) AS kept, coalesce(ok, true) AS host_ok
FROM judged LEFT JOIN verdicts USING (source)
"""


@query("op1_quality_rules", OP1_SQL)
def op1(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))
