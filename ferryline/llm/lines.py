"""Near-duplicate lines by a deletion-neighbourhood join (SQL functions only).

Two lines are within one edit exactly when deleting one character from one of
them (or from both, at the same place) makes them equal. Every line emits its
deletion variants as hashed keys, equal keys meet in one aggregate, the edit
distance of each line to the earliest line it met is verified, and only lines
without an earlier neighbour stay.

A line of n characters has n variants, so lines first pass a coarser form of
the same test: an edit spares all but one stretch of the line, hence
neighbours agree on the text around some stretch. Lines that agree with no
other line on any such frame have no neighbour and emit no variants; the
others emit only the variants of the stretches where they agree. The test runs
twice, with stretches of a half and then of a sixteenth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import digest_pair, query, stage, table, text_of

MIN_CHARS = 20
WORD = r"[^\x20\x09-\x0D]"

_LINE = ["__k1", "__k2"]


def _row_key(id_column: str, text: str) -> dict[str, Column]:
    """What orders documents (nulls last) and tells rows with one id apart."""
    return {"nul": F.col(id_column).isNull(), "doc": F.col(id_column),
            "row": F.xxhash64(F.col(id_column), F.col(text))}


def _compared(line: Column, min_chars: int) -> Column:
    """Whether a line takes part: by its length or by a word."""
    return (F.length(line) >= min_chars) | line.rlike(WORD)


def document_lines(docs: DataFrame, id_column: str, text: str, min_chars: int) -> DataFrame:
    """Lines that are compared: ``ord`` (nul, doc, row, line), ``line``, ``n``."""
    key = [c.alias(n) for n, c in _row_key(id_column, text).items()]
    return (docs.select(*key, F.posexplode(F.split(text_of(text), "\n")).alias("at", "line"))
            .withColumn("n", F.length("line")).where(_compared(F.col("line"), min_chars))
            .select(F.struct("nul", "doc", "row", "at").alias("ord"), "line", "n"))


def _cut(core: Column, part: Column, parts: int) -> Column:
    return F.floor(core * part / F.lit(parts)).cast("int")


def _frame(line: Column, core: Column, part: Column, parts: int) -> Column:
    """Hash of what surrounds stretch ``part`` of a core of ``core`` characters."""
    before = F.substring(line, F.lit(1), _cut(core, part, parts))
    after = core - _cut(core, part + 1, parts)
    return F.xxhash64(core, part, before, F.right(line, after))


def shared_frames(frames: DataFrame) -> DataFrame:
    """Frames (``f``) on which two different lines agree, with the roles present.

    ``own``: the core is the line itself; otherwise the line less one character.
    """
    return (frames.groupBy("f").agg(
        F.min("__k1").alias("a"), F.max("__k1").alias("b"), F.min("__k2").alias("c"),
        F.max("__k2").alias("d"), F.max("own").alias("any_own"),
        F.min("own").alias("all_own"))
        .where((F.col("a") != F.col("b")) | (F.col("c") != F.col("d")))
        .where(~F.col("all_own")).select("f", "any_own"))


def _core(own: Column) -> Column:
    return F.when(own, F.col("n")).otherwise(F.col("n") - 1)


def suspect_frames(lines: DataFrame, distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The suspected lines with their text, and, one row each, the sixteenths
    around which they agree with another line (``own, part, f, any_own``)."""
    halves = stage(shared_frames(
        distinct.select(*_LINE, F.explode(F.array(*[
            F.struct(F.lit(own).alias("own"), F.col(f"h{int(own)}{p}").alias("f"))
            for own in (True, False) for p in (0, 1)])).alias("r"))
        .select(*_LINE, "r.own", "r.f")), "llm-line-halves")
    agreed = (distinct.select(*_LINE, "ord", F.explode(F.array(*[
        F.struct(F.lit(own).alias("own"), F.lit(p).alias("half"),
                 F.col(f"h{int(own)}{p}").alias("f"))
        for own in (True, False) for p in (0, 1)])).alias("r"))
        .select(*_LINE, "ord", "r.own", "r.half", "r.f")
        .join(halves.select("f"), "f").drop("f"))
    # One text per suspected line: the line at its first place.
    first = lines.select(*digest_pair(F.col("line")), "ord", "line", "n")
    texts = stage(
        agreed.groupBy(*_LINE, "ord").agg(
            F.collect_set(F.struct("own", "half")).alias("halves"))
        .join(first, [*_LINE, "ord"]).dropDuplicates(_LINE), "llm-line-suspects")
    sixteenths = texts.select("*", F.explode("halves").alias("s")).select(
        *texts.columns, F.explode(F.sequence(
            F.col("s.half") * 8, F.col("s.half") * 8 + 7)).alias("part"),
        F.col("s.own").alias("own"))
    framed = sixteenths.withColumn(
        "f", _frame(F.col("line"), _core(F.col("own")), F.col("part"), 16))
    shared = stage(shared_frames(framed.select(*_LINE, "own", "f")), "llm-line-frames")
    return texts, framed.drop("halves").join(shared, "f")


def variants(framed: DataFrame) -> DataFrame:
    """``__k1, __k2, ord, role, v``: hashed deletion variants of the framed stretches.

    Role S meets lines that differ at the same place, role D meets the line
    that equals the variant (role Z).
    """
    core, line, part = _core(F.col("own")), F.col("line"), F.col("part")
    start, end = _cut(core, part, 16), _cut(core, part + 1, 16)
    last = F.when(part == 15, end).otherwise(end - 1)
    own = framed.where("own").select(
        *_LINE, "ord", F.lit("Z").alias("role"),
        F.xxhash64("f", F.substring(line, start + 1, end - start)).alias("v"))
    cut = (framed.where(~F.col("own")).where(last >= start)
           .select(*_LINE, "ord", "f", "any_own", start.alias("a"),
                   F.substring(line, start + 1, end - start + 1).alias("mid"),
                   F.explode(F.sequence(start, last)).alias("i")))
    at = F.col("i") - F.col("a")
    core_hash = F.xxhash64("f", F.concat(F.substring("mid", F.lit(1), at),
                                         F.substring("mid", at + 2, F.length("mid"))))
    keys = F.explode(F.array_compact(F.array(
        F.struct(F.lit("S").alias("role"), F.xxhash64("h", "i").alias("v")),
        F.when(F.col("any_own"), F.struct(F.lit("D").alias("role"), F.col("h").alias("v")))
    ))).alias("x")
    deleted = (cut.select(*_LINE, "ord", "any_own", "i", core_hash.alias("h"))
               .select(*_LINE, "ord", keys).select(*_LINE, "ord", "x.role", "x.v"))
    return own.union(deleted)


def earlier_neighbours(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """Lines (``__k1, __k2``) with an earlier line within one edit, verified."""
    texts, framed = suspect_frames(lines, distinct)
    keyed = stage(variants(framed), "llm-line-variants")
    witness = F.struct("ord", *_LINE)
    z, d, s = (F.min(F.when(F.col("role") == r, witness)).alias(r) for r in "ZDS")
    met = keyed.groupBy("v").agg(z, d, s, F.count(F.lit(1)).alias("members"))
    met = met.where("members > 1").drop("members")
    other = (F.when(F.col("role") == "Z", F.col("D")).when(F.col("role") == "D", F.col("Z"))
             .otherwise(F.col("S")))
    found = (keyed.join(met, "v").withColumn("other", other)
             .where(F.col("other.ord") < F.col("ord"))
             .groupBy(*_LINE).agg(F.min("other").alias("other"))
             .select(*_LINE, F.col("other.__k1").alias("o1"), F.col("other.__k2").alias("o2")))
    mine = texts.select(*_LINE, F.col("line").alias("mine"))
    theirs = texts.select(F.col("__k1").alias("o1"), F.col("__k2").alias("o2"),
                          F.col("line").alias("theirs"))
    return (found.join(mine, _LINE).join(theirs, ["o1", "o2"])
            .where(F.levenshtein("mine", "theirs", 1).between(0, 1)).select(*_LINE))


def kept_places(docs: DataFrame, id_column: str, text: str, max_edits: int,
                min_chars: int) -> DataFrame:
    """Per document (nul, doc, row) the numbers of the compared lines that stay."""
    lines = document_lines(docs, id_column, text, min_chars)
    wanted = [_frame(F.col("line"), _core(F.lit(own)), F.lit(p), 2).alias(f"h{int(own)}{p}")
              for own in (True, False) for p in (0, 1)] if max_edits else []
    hashed = lines.select(*digest_pair(F.col("line")), "ord", "n", *wanted)
    distinct = stage(hashed.groupBy(*_LINE).agg(
        F.min("ord").alias("ord"), *[F.min(h).alias(h) for h in hashed.columns[3:]]),
        "llm-lines")
    kept = distinct
    if max_edits:
        # Short lines are held against equal ones alone.
        long = F.col("n") >= min_chars
        near = earlier_neighbours(lines.where(long), distinct.where(long))
        kept = distinct.join(near, _LINE, "left_anti")
    return kept.select("ord.*").groupBy("nul", "doc", "row").agg(
        F.collect_set("at").alias("kept"))


def dedupe_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                 max_edits: int = 1, min_chars: int = MIN_CHARS) -> DataFrame:
    """``row`` (the input row), ``__lines``, ``n_lines``, ``n_dropped`` and ``text_kept``.

    Every line with a word is compared, and every line of ``min_chars`` characters;
    shorter ones for equality alone, as one edit makes other words of them. Lines
    without a word stay below ``min_chars``. Of equal lines the earliest stays (by id, nulls last,
    then line number), and of longer lines within ``max_edits`` (0 or 1)
    edits of an earlier one none does. Null or empty text gives the empty text with one
    blank line. Rows that repeat id and text count as one document and get the
    same result; rows that share an id alone are ordered by a hash. Other
    columns are carried in ``row``. An empty table gives an empty result.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits must be 0 or 1")
    kept = kept_places(docs, id_column, text, max_edits, min_chars)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       *[c.alias(f"__{n}") for n, c in _row_key(id_column, text).items()])
    places = kept.select(F.col("nul").alias("__nul"), F.col("row").alias("__row"), "kept")
    joined = rows.join(places, ["__nul", "__row"], "left").withColumn(
        "__lines", F.split(text_of(F.col("row")[text]), "\n"))
    compared = F.filter(F.sequence(F.lit(0), F.size("__lines") - 1),
                        lambda i: _compared(F.get("__lines", i), min_chars))
    dropped = F.array_except(compared, F.coalesce("kept", F.array().cast("array<int>")))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    return (joined.withColumn("__dropped", dropped).select(
        "row", "__lines", F.size("__lines").cast("long").alias("n_lines"),
        F.size("__dropped").cast("long").alias("n_dropped"),
        F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n").alias("text_kept")))


def remove_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                          length: str | None = "n_chars", **options) -> DataFrame:
    """The input rows with repeated lines taken out of ``text`` and its new number
    of characters in ``length``. Rows that lose their last line with a word go;
    rows that lose no line, empty ones too, stay as they are."""
    found = dedupe_lines(docs, id_column, text, **options)
    lost = F.col("n_dropped") > 0
    row = F.col("row")
    changed = row.withField(text, F.col("text_kept"))
    if length is not None and length in docs.columns:
        changed = changed.withField(
            length, F.length("text_kept").cast(docs.schema[length].dataType))
    return (found.where(~lost | F.col("text_kept").rlike(WORD))
            .select(F.when(lost, changed).otherwise(row).alias("row")).select("row.*"))


_COMPARED = f"length(line) >= {MIN_CHARS} OR regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')"

OP6_SQL = f"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, i, len(l) AS n_lines, l[i] AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
       unnest(range(1, len(l) + 1)) AS t(i)),
firsts AS MATERIALIZED (
  SELECT line, length(line) AS n, min((doc_id, i)) AS ord
  FROM lines WHERE {_COMPARED} GROUP BY line),
sides AS MATERIALIZED (
  SELECT line, n, ord, core, side,
         CASE side WHEN 0 THEN left(line, core // 2) ELSE right(line, core - core // 2) END AS part
  FROM firsts, unnest([n - 1, n]) AS t(core), unnest([0, 1]) AS u(side)
  WHERE n >= {MIN_CHARS}),
near AS (
  SELECT DISTINCT a.line FROM sides a JOIN sides b USING (core, side, part)
  WHERE b.ord < a.ord AND abs(a.n - b.n) <= 1 AND levenshtein(a.line, b.line) <= 1),
kept AS (SELECT ord FROM firsts WHERE line NOT IN (SELECT line FROM near)),
judged AS (
  SELECT doc_id, i, n_lines, line,
         ({_COMPARED}) AND (doc_id, i) NOT IN (SELECT ord FROM kept) AS dropped
  FROM lines)
SELECT doc_id, CAST(max(n_lines) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS text
FROM judged GROUP BY doc_id
"""


@query("op6_line_dedup", OP6_SQL)
def op6(spark, sf_dir):
    found = dedupe_lines(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.col("text_kept").alias("text"))
