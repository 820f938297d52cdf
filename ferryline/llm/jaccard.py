"""Similarity join of texts by the Jaccard similarity of their word shingles.

Texts that share a band of MinHash values are candidates. A pair's MinHash
values are compared in steps; after each, the pair is dropped when the posterior
probability that it reaches the threshold is below a tolerance. What is left is
verified on the shingle sets.

Pairs are never rows. Candidates that hang together form a group, a group is cut
into blocks of bounded size, and every two blocks of a group meet in one place,
which returns one row per text: its number of links there and the smallest text
it is tied to.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.joins import keyed_join

from .components import connected_components
from .shared import query, stage, table, text_of

#: Word hashes a task keeps; at the bound they are forgotten.
CACHED_WORDS = 500_000


@dataclass(frozen=True)
class JaccardOptions:
    """``bands`` x ``rows`` MinHash values; ``tolerance``: posterior below which a
    pair is dropped; ``step``: values compared at a time; ``block``: texts of a
    group that meet at a time, on average."""
    shingle: int = 5
    threshold: float = 0.8
    bands: int = 32
    rows: int = 4
    tolerance: float = 1e-6
    step: int = 16
    block: int = 256
    seed: int = 5

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def fewest_matches(options: JaccardOptions) -> list[tuple[int, int]]:
    """(values compared, matches needed) after every step.

    With a uniform prior the similarity, given m matches of n, is Beta(m + 1,
    n - m + 1), and it reaches t with the probability that a binomial of n + 1
    draws with chance t is at most m.
    """
    t, out = options.threshold, []
    for n in range(options.step, options.hashes + 1, options.step):
        below, m = 0.0, -1
        while m < n:
            m += 1
            below += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if below >= options.tolerance:
                break
        out.append((n, m))
    return out


class WordHashes(dict):
    """Word -> 64-bit hash, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def shingle_set(text: str, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words (A-Z lower-cased); a
    shorter text is one shingle, a text without words has none."""
    words = text.encode().lower().split()
    if len(hashes) > CACHED_WORDS:
        hashes.clear()
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(values) - size + 1) if len(values) else 0
    if not n:
        return values
    mixed = np.full(n, len(values) if len(values) < size else size, np.uint64)
    for k in range(min(size, len(values))):
        mixed = (mixed ^ values[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


class MinHash:
    def __init__(self, options: JaccardOptions):
        rng = np.random.default_rng(options.seed)
        self.times = rng.integers(1, 2 ** 32, options.hashes, np.uint32) | np.uint32(1)
        self.plus = rng.integers(0, 2 ** 32, options.hashes, np.uint32)
        self.options = options

    def values(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(self.options.hashes, 2 ** 32 - 1, np.uint32)
        short = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        for k in range(0, len(short), 512):
            mixed = short[k:k + 512, None] * self.times + self.plus
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            np.minimum(low, mixed.min(0), out=low)
        return low

    def band_keys(self, values: np.ndarray) -> np.ndarray:
        keys = np.arange(1, self.options.bands + 1, dtype=np.uint64)
        for column in values.reshape(self.options.bands, self.options.rows).T:
            keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
        return keys.view(np.int64)


# -- one place where two blocks meet ---------------------------------------------------


@dataclass
class Members:
    nodes: list[bytes]
    weights: np.ndarray  # different texts with this shingle set
    values: np.ndarray  # MinHash values, a row each
    sets: list[np.ndarray]


def likely_pairs(a: np.ndarray, b: np.ndarray, same: bool,
                 needed: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of a, j of b; i < j within one block) that no step drops."""
    i, j = np.triu_indices(len(a), 1) if same else (
        x.ravel() for x in np.indices((len(a), len(b))))
    matches, done = np.zeros(len(i), np.int32), 0
    for n, least in needed:
        for k in range(done, n):
            matches += a[i, k] == b[j, k]
        keep = matches >= least
        i, j, matches, done = i[keep], j[keep], matches[keep], n
    return i, j


def shared_shingles(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray,
                    j: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs."""
    out = np.empty(len(i), np.int64)
    if len(i) * 8 < len(a) * len(b):
        for k, (x, y) in enumerate(zip(i, j)):
            x, y = a[x], b[y]
            at = np.searchsorted(x, y)
            out[k] = (x[np.minimum(at, len(x) - 1)] == y).sum()
        return out
    # Many pairs left: count the shingles both sides hold, some columns at a time.
    common = np.intersect1d(np.concatenate(a), np.concatenate(b))
    total = np.zeros((len(a), len(b)), np.float32)
    for k in range(0, len(common), 8192):
        part = common[k:k + 8192]
        sides = []
        for sets in (a, b):
            held = np.zeros((len(sets), len(part)), np.float32)
            for row, own in enumerate(sets):
                cut = own[np.searchsorted(own, part[0]):np.searchsorted(own, part[-1], "right")]
                at = np.searchsorted(part, cut)
                held[row, at[part[at] == cut]] = 1
            sides.append(held)
        total += sides[0] @ sides[1].T
    return total[i, j].astype(np.int64)


def meet(a: Members, b: Members | None, options: JaccardOptions,
         needed: list[tuple[int, int]]) -> list[tuple[bytes, int, bytes]]:
    """(node, linked texts, smallest node tied to it) for the members of both
    blocks, or of one block with itself."""
    other = b or a
    i, j = likely_pairs(a.values, other.values, b is None, needed)
    shared = shared_shingles(a.sets, other.sets, i, j)
    size_a = np.array([len(s) for s in a.sets])
    size_b = np.array([len(s) for s in other.sets])
    t = Fraction(str(options.threshold))
    linked = shared * t.denominator >= t.numerator * (size_a[i] + size_b[j] - shared)
    i, j = i[linked], j[linked]
    nodes = a.nodes + b.nodes if b else a.nodes
    if b:
        j = j + len(a.nodes)
    weights = np.concatenate([a.weights, b.weights]) if b else a.weights
    links = np.bincount(i, weights[j], len(nodes)) + np.bincount(j, weights[i], len(nodes))
    order = np.argsort(np.array([n.hex() for n in nodes]))
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    root = rank.copy()  # smallest rank each member is known to be tied to
    while True:
        before = root.copy()
        np.minimum.at(root, i, before[j])
        np.minimum.at(root, j, before[i])
        root = root[order[root]] if len(root) else root
        if (root == before).all():
            break
    return [(n, int(links[k]), nodes[order[root[k]]]) for k, n in enumerate(nodes)]


# -- on tables ---------------------------------------------------------------------------


SKETCH = T.StructType([
    T.StructField("text_key", T.BinaryType()), T.StructField("node", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType()))])


def sketches(docs: DataFrame, id_column: str, text: str, options: JaccardOptions) -> DataFrame:
    """``__id, text_key, node, bands``: ``node`` names the shingle set (of a text
    without words, the text), ``bands`` are its MinHash band keys."""
    rows = docs.select(F.col(id_column).alias("__id"), text_of(text).alias("__text"))
    schema = T.StructType([rows.schema["__id"], *SKETCH])

    def run(batches):
        hashes, minhash = WordHashes(), MinHash(options)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a in range(0, len(texts), 1_000):
                keys, nodes, bands = [], [], []
                for body in texts[a:a + 1_000]:
                    keys.append(hashlib.blake2b(body.encode(), digest_size=16).digest())
                    own = shingle_set(body, hashes, options.shingle)
                    if len(own):
                        nodes.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                        bands.append(minhash.band_keys(minhash.values(own)))
                    else:
                        nodes.append(keys[-1])
                        bands.append(np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(keys)), pa.array(keys, pa.binary()),
                     pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    schema.names)

    return stage(rows.mapInArrow(run, schema), "llm-sketches")


def candidate_edges(rows: DataFrame) -> DataFrame:
    """``u, v``: every set of a band's bucket against the smallest set there."""
    held = rows.select("node", F.posexplode("bands").alias("band", "key"))
    tag = F.xxhash64("node")
    crowded = stage(held.groupBy("band", "key").agg(F.min(tag).alias("a"), F.max(tag).alias("b"))
                    .where("a != b").select("band", "key"), "llm-buckets")
    members = stage(keyed_join(held, crowded, ["band", "key"], "left_semi").distinct(),
                    "llm-bucket-members")
    hubs = members.groupBy("band", "key").agg(F.min("node").alias("v"))
    return (keyed_join(members, hubs, ["band", "key"], "inner")
            .select(F.col("node").alias("u"), "v"))


def block_rows(docs: DataFrame, rows: DataFrame, grouped: DataFrame, id_column: str, text: str,
               options: JaccardOptions) -> DataFrame:
    """One row per set and block it meets: ``label, a, b, mine, node, n_texts``,
    MinHash ``values`` and shingle ``set``. Blocks go by a hash of the set."""
    sizes = grouped.groupBy("label").agg(
        F.ceil(F.count(F.lit(1)) / options.block).cast("int").alias("blocks"))
    placed = keyed_join(grouped, sizes, ["label"], "inner").withColumn(
        "mine", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    # One text stands for a set: the first of its texts, at the first of its ids.
    texts = (rows.groupBy("node", "text_key").agg(F.min("__id").alias("__id"))
             .groupBy("node").agg(F.min(F.struct("text_key", "__id")).alias("first"),
                                  F.count(F.lit(1)).alias("n_texts")))
    placed = placed.join(texts, "node").select(
        "label", "blocks", "mine", "node", "n_texts", F.xxhash64("first.__id").alias("__h"),
        F.col("first.__id").alias("__i"), F.col("first.text_key").alias("__t"))
    placed = stage(placed, "llm-placed")
    body = docs.select(F.xxhash64(F.col(id_column)).alias("__h"),
                       F.col(id_column).alias("__i"), text_of(text).alias("__text"))
    chosen = keyed_join(body, placed, ["__h"], "inner").where(
        body["__i"].eqNullSafe(placed["__i"])).drop(body["__i"])
    kept = ["label", "blocks", "mine", "node", "n_texts"]
    schema = T.StructType([*[placed.schema[c] for c in kept],
                           T.StructField("values", T.BinaryType()),
                           T.StructField("set", T.BinaryType())])

    def run(batches):
        hashes, minhash = WordHashes(), MinHash(options)
        for batch in batches:
            body, key = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a in range(0, len(body), 500):
                take, values, sets = [], [], []
                for k in range(a, min(a + 500, len(body))):
                    # Other texts under the same id are not the one chosen.
                    if hashlib.blake2b(body[k].encode(), digest_size=16).digest() == key[k]:
                        own = shingle_set(body[k], hashes, options.shingle)
                        take.append(k)
                        values.append(minhash.values(own).tobytes())
                        sets.append(own.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(pa.array(take, pa.int64())) for c in batch.columns[2:]],
                     pa.array(values, pa.binary()), pa.array(sets, pa.binary())], schema.names)

    made = chosen.select("__text", "__t", *kept).mapInArrow(run, schema)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return made.select("*", other).select(
        "label", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
        "mine", "node", "n_texts", "values", "set")


MEETING = "node binary, links long, root binary"


def meetings(blocks: DataFrame, options: JaccardOptions) -> DataFrame:
    """``node, links, root`` of every set in every meeting of two blocks."""
    needed = fewest_matches(options)

    def members(rows: dict) -> Members:
        rows = [rows[n] for n in sorted(rows)]
        return Members([r[0] for r in rows], np.array([r[1] for r in rows], float),
                       np.array([np.frombuffer(r[2], np.uint32) for r in rows]),
                       [np.frombuffer(r[3], np.uint64) for r in rows])

    def close(place, sides):
        _, a, b = place
        parts = [members(sides[x]) for x in dict.fromkeys((a, b)) if sides.get(x)]
        if len(parts) == 2 or (parts and a == b):
            return meet(parts[0], parts[1] if len(parts) == 2 else None, options, needed)
        return []

    def run(batches):
        place, sides, out = None, {}, []
        for batch in batches:
            for label, a, b, mine, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if place != (label, a, b):
                    if place:
                        out += close(place, sides)
                    place, sides = (label, a, b), {}
                sides.setdefault(mine, {})[row[0]] = row  # a repeated row counts once
            if len(out) > 20_000:
                yield _meeting(out)
                out = []
        if place:
            out += close(place, sides)
        yield _meeting(out)

    return (blocks.repartition("label", "a", "b").sortWithinPartitions("label", "a", "b")
            .mapInArrow(run, MEETING))


def _meeting(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()),
         pa.array(columns[2], pa.binary())], ["node", "links", "root"])


def jaccard_links(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                  options: JaccardOptions | None = None) -> DataFrame:
    """One row per input row: id, ``text_key``, ``class_id`` (smallest id of the
    rows its text is tied to, directly or through others), ``n_copies`` (other
    rows with the same text) and ``n_links`` (other texts at the threshold).

    Null text is the empty text. Texts without words have no shingles and no
    links; their copies share a class. Shorter texts than a shingle are one
    shingle. Texts with equal shingle sets are linked without being compared.
    Repeated rows are copies. Null ids are never a class id while another row of
    the class has one. Other columns are not read. An empty table gives an empty
    result. A pair at the threshold is missed with a probability below 1e-5 (by
    the bands 5e-8, by the tolerance 1e-6 a step); no bucket or group is cut off.
    """
    options = options or JaccardOptions()
    rows = sketches(docs, id_column, text, options)
    grouped = connected_components(candidate_edges(rows))
    met = stage(meetings(block_rows(docs, rows, grouped, id_column, text, options), options),
                "llm-meetings")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    tied = connected_components(met.select(F.col("node").alias("u"), F.col("root").alias("v")))
    copies = rows.groupBy("node", "text_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("__id").alias("least"))
    sets = (copies.groupBy("node").agg(F.count(F.lit(1)).alias("n_texts"),
                                       F.min("least").alias("least"))
            .join(tied, "node", "left").join(links, "node", "left")
            .withColumn("label", F.coalesce("label", "node")))
    sets = stage(sets, "llm-sets")
    least = sets.groupBy("label").agg(F.min("least").alias("class_id"))
    known = keyed_join(sets, least, ["label"], "inner").select(
        "node", "class_id", (F.col("n_texts") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    by_text = keyed_join(copies.select("node", "text_key", "n"), known, ["node"], "inner")
    return keyed_join(rows.select("__id", "text_key"), by_text, ["text_key"], "inner").select(
        F.col("__id").alias(id_column), "text_key", "class_id", (F.col("n") - 1).alias("n_copies"),
        F.col("n_links").cast("long").alias("n_links"))


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                     options: JaccardOptions | None = None) -> DataFrame:
    """The input rows whose id is the class id, unchanged; rows that repeat that
    id stay together, and a class of null ids stays whole."""
    found = jaccard_links(docs, id_column, text, options)
    keep = (found.where(F.col(id_column).eqNullSafe(F.col("class_id")))
            .select(F.col(id_column).alias("__id")).distinct())
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.col(id_column).alias("__id"))
    return rows.join(keep, rows["__id"].eqNullSafe(keep["__id"]), "left_semi").select("row.*")


OP2_SQL = """
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY t) AS k, t, n, least_id,
         [w FOR w IN regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+') IF w <> ''] AS w
  FROM (SELECT coalesce(text, '') AS t, count(*) AS n, min(doc_id) AS least_id
        FROM documents GROUP BY 1)),
shingles AS MATERIALIZED (
  SELECT DISTINCT k, array_to_string(w[s : s + 4], ' ') AS g
  FROM texts, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT k, count(*) AS n FROM shingles GROUP BY k),
shared AS (SELECT a.k AS a, b.k AS b, count(*) AS n
           FROM shingles a JOIN shingles b ON a.g = b.g AND a.k <> b.k GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.k = a JOIN sizes y ON y.k = b
  WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
reach AS (SELECT k AS a, k AS b FROM texts UNION
          SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
classes AS (SELECT reach.a AS k, min(least_id) AS class_id
            FROM reach JOIN texts ON texts.k = reach.b GROUP BY 1)
SELECT doc_id, class_id, texts.n - 1 AS n_copies,
       CAST((SELECT count(*) FROM links WHERE links.a = texts.k) AS BIGINT) AS n_links
FROM documents JOIN texts ON texts.t = coalesce(text, '') JOIN classes USING (k)
"""


@query("op2_jaccard_join", OP2_SQL)
def op2(spark, sf_dir):
    found = jaccard_links(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_copies", "n_links")
