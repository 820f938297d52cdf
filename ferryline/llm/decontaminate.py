"""Benchmark decontamination as a prefix-filtered set join (SQL functions only).

Items are cut into windows. A document can hold a window only where it holds
all its words, so each window is joined on its rarest word alone (the prefix a
full containment needs), the position of that word bounds where the window may
start, and the words there are then compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, digest_pair, query, stage, table, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13

#: A prefix table is broadcast up to so many rows and bytes, else shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20

_KEY = ["__k1", "__k2"]


def words_of(text: str | Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text_of(text)), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``item``, ``w`` (the window's words, space-joined) and ``len``; distinct."""
    words = items.select(F.col(item_id).cast("string").alias("item"),
                         words_of(text).alias("words")).where(F.size("words") > 0)
    cut = F.least(F.size("words"), F.lit(window))
    return (words.withColumn("len", cut)
            .select("item", "len", "words", F.explode(
                F.sequence(F.lit(1), F.size("words") - F.col("len") + 1)).alias("at"))
            .select("item", F.array_join(F.slice("words", F.col("at"), F.col("len")), " ")
                    .alias("w"), "len").distinct())


def _bounded(df: DataFrame, text_column: str, rows: int) -> bool:
    """Whether ``df`` is proven small enough to broadcast."""
    size = df.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.octet_length(text_column) + 64).alias("b")).first()
    return size["n"] <= rows and (size["b"] or 0) <= BROADCAST_BYTES


def prefix_table(docs: DataFrame, windows: DataFrame, text: str, broadcast_rows: int) -> DataFrame:
    """One row per distinct window that may occur: its rarest word and where that
    word stands in it. Rarity is the word's count over all documents; a window
    with a word no document has is left out."""
    places = (windows.select("w", "len").distinct()
              .select("w", "len", F.posexplode(F.split("w", " ")).alias("off", "word")))
    words = stage(places.select("word").distinct(), "llm-window-words")
    known = F.broadcast(words) if _bounded(words, "word", broadcast_rows) else words
    counts = (docs.select(F.explode(words_of(text)).alias("word")).join(known, "word")
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    rarest = (places.join(counts, "word", "left")
              .groupBy("w", "len").agg(F.min(F.struct(
                  F.coalesce("n", F.lit(0)).alias("n"), "word", "off")).alias("first")))
    return stage(rarest.where("first.n > 0").select("w", "len", "first.word", "first.off"),
                 "llm-window-prefixes")


def window_hits(docs: DataFrame, prefixes: DataFrame, text: str,
                broadcast_rows: int) -> DataFrame:
    """``__k1, __k2, start, len, w`` of every window found in a document
    (word positions from 0). ``docs`` carries the key columns."""
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.size("words"))
    same = F.array_join(F.slice("words", F.col("start") + 1, F.col("len")), " ") == F.col("w")
    worded = docs.select(*_KEY, words_of(text).alias("words"))
    start = (F.col("pos") - F.col("off")).alias("start")
    if _bounded(prefixes, "w", broadcast_rows):
        # The words travel only inside one generated loop: explode, probe, compare.
        return (worded.select(*_KEY, "words", F.posexplode("words").alias("pos", "word"))
                .join(F.broadcast(prefixes), "word")
                .select(*_KEY, "words", start, "len", "w")
                .where(fits).where(same).select(*_KEY, "start", "len", "w"))
    size = F.size("words").alias("size")
    candidates = (worded.select(*_KEY, size, F.posexplode("words").alias("pos", "word"))
                  .join(prefixes, "word")
                  .select(*_KEY, start, "len", "w", "size")
                  .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("size")))
                  .drop("size"))
    return (candidates.join(worded.dropDuplicates(_KEY), _KEY)
            .where(same).select(*_KEY, "start", "len", "w"))


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, percent: int = 5, keep_row: bool = False,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit``, ``n_items``, ``items``
    (sorted ids), and ``contaminated``: some word hit and hits of at least
    ``percent`` per cent of the words. ``keep_row`` adds the input row as ``row``.

    Null or empty documents have no words and are clean; null or empty items
    have no windows. An item without an id marks words but is not listed. Rows
    that repeat id and text share one search and each get its result. Other
    columns are not read. An empty table on either side gives no hits.
    """
    keyed = docs.select(
        F.col(id_column).alias("__id"), F.col(text).alias("__text"),
        *digest_pair(F.col(id_column), F.col(text)),
        *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if keep_row else []))
    windows = stage(item_windows(items, item_id, item_text, window), "llm-windows")
    prefixes = prefix_table(keyed.select("__text"), windows, "__text", broadcast_rows)
    hits = stage(window_hits(keyed, prefixes, "__text", broadcast_rows), "llm-window-hits")
    stretch = F.struct(F.col("start").alias("a"), (F.col("start") + F.col("len")).alias("b"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    covered = F.aggregate(
        F.sort_array(F.collect_set(stretch)), zero,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["reach"]))).alias("n"),
            F.greatest(s["reach"], x["b"]).alias("reach")),
        lambda s: s["n"].cast("long"))
    hit_words = hits.groupBy(*_KEY).agg(covered.alias("n_hit"))
    found = (hits.select(*_KEY, "w").distinct().join(windows.select("item", "w"), "w")
             .groupBy(*_KEY).agg(F.sort_array(F.collect_set("item")).alias("items")))
    n_words = F.regexp_count(ascii_lower(text_of("__text")), F.lit(WORD)).cast("long")
    rows = keyed.withColumn("n_words", n_words).drop("__text")
    nothing = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (rows.join(hit_words, _KEY, "left").join(found, _KEY, "left").select(
        F.col("__id").alias(id_column), "n_words", n_hit.alias("n_hit"),
        F.size(F.coalesce("items", nothing)).cast("long").alias("n_items"),
        F.coalesce("items", nothing).alias("items"),
        ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"),
        *(["row"] if keep_row else [])))


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The input rows, unchanged and with all their columns, that are not contaminated.
    Null and wordless texts stay; see :func:`contamination` for the rest."""
    found = contamination(docs, items, keep_row=True, **options)
    return found.where(~F.col("contaminated")).select("row.*")


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

OP5_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS g
  FROM i, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS t(s) WHERE len(w) > 0),
places AS (
  SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM windows) AS l, unnest(range(1, len(w) - n + 2)) AS t(s)),
hits AS MATERIALIZED (
  SELECT r, s, p.n, item_id FROM places p JOIN windows v ON p.n = v.n AND p.g = v.g),
hit_words AS (
  SELECT r, count(DISTINCT s + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


@query("op5_decontamination", OP5_SQL)
def op5(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")
