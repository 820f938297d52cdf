"""SimHash fingerprints linked by covering locality-sensitive hashing.

Give every bit of a fingerprint a nonzero vector of radius + 1 bits, and make a
mask for every nonzero vector v of the bits whose vector has an odd product with
v. Up to ``radius`` bits leave some v whose product with all their vectors is
even, so the mask of v keeps none of these bits: two fingerprints that differ in
them agree under that mask. With radius 3 these are 15 tables, and each compares
some 34 of the 64 bits.

Fingerprints that share a bucket are compared; a bucket emits a forest that
connects what is linked in it, not its pairs. Members of a bucket too large to
compare are linked through their neighbourhoods instead: fingerprints within
``radius`` of each other meet at a value within half of it from one and the
other half from the other, so each sends its neighbouring values to a join,
which grows with the number of fingerprints, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.joins import keyed_join

from .components import connected_components
from .shared import query, stage, table, text_of

BITS = 64


@dataclass(frozen=True)
class SimHashOptions:
    """Shingles in words, bits that linked fingerprints may differ in, and the
    number of fingerprints in a bucket that one task compares."""

    shingle: int = 3
    radius: int = 3
    bucket: int = 4096
    segment: int = 1 << 20      # bytes of a text that are split at a time


def word_segments(raw: bytes, step: int) -> Iterator[list[bytes]]:
    """The words of a text, in segments of about ``step`` bytes."""
    a = 0
    while a < len(raw):
        b = len(raw)
        if b - a > step:
            b = raw.rfind(b" ", a, a + step) + 1
            if b <= a:  # a word longer than the step
                b = raw.find(b" ", a) + 1 or len(raw)
        # lower() of bytes touches A-Z alone; split() takes \x20 and \x09 to \x0D.
        yield raw[a:b].lower().split()
        a = b


def fingerprint(raw: bytes, options: SimHashOptions) -> int:
    """The fingerprint as a signed 64-bit number; a text without a word gives 0."""
    ones, n, held = np.zeros(BITS, np.int64), 0, []
    size, digest = options.shingle, xxhash.xxh64_intdigest

    def count(shingles: list[bytes]) -> None:
        h = np.array([digest(s, 42) for s in shingles], np.uint64)
        ones[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little").sum(0, dtype=np.int64)

    for words in word_segments(raw, options.segment):
        words = held + words
        if len(words) >= size:
            count([*map(b" ".join, zip(*[words[k:] for k in range(size)]))])
            n += len(words) - size + 1
            held = words[len(words) - size + 1:]
        else:
            held = words
    if n == 0 and held:
        count([b" ".join(held)])
        n = 1
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_column: str, text: str,
                 options: SimHashOptions) -> DataFrame:
    """``id, fp`` of every row, over its whole text."""
    rows = docs.select(F.col(id_column).alias("id"), text_of(text).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), options) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())],
                                             schema.names)

    return stage(rows.mapInArrow(run, schema), "llm-fingerprints")


def covering_masks(radius: int) -> list[int]:
    """One mask per nonzero vector of ``radius + 1`` bits, as signed numbers."""
    top = (1 << radius + 1) - 1
    vectors = [1 + i % top for i in range(BITS)]
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
             for v in range(1, top + 1)]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]


_EDGE = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def linked_forest(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what links connect among different fingerprints, one
    fewer than each connected part has members."""
    left = np.array(values, np.int64)
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= radius
            if near.any():
                found, left = left[near], left[~near]
                front.extend(found)
                yield from ((int(u), int(x)) for u in found)


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())],
                                      _EDGE.names)


def bucket_links(members: DataFrame, options: SimHashOptions) -> DataFrame:
    """Forests of all buckets (``tab, key, fp``) that one task can compare."""
    radius = options.radius

    def run(batches):
        place, held, out = None, [], []
        for batch in batches:
            for tab, key, fp in zip(*[c.to_pylist() for c in batch.columns]):
                if (tab, key) != place:
                    out.extend(linked_forest(held, radius) if len(held) > 1 else ())
                    place, held = (tab, key), []
                held.append(fp)
            yield _edges(out)
            out = []
        yield _edges([*linked_forest(held, radius)])

    return (members.repartition("tab", "key").sortWithinPartitions("tab", "key", "fp")
            .select("tab", "key", "fp").mapInArrow(run, _EDGE))


def ball(radius: int) -> np.ndarray:
    """All patterns of up to ``radius`` bits."""
    patterns = [sum(1 << i for i in bits) for n in range(radius + 1)
                for bits in combinations(range(BITS), n)]
    return np.array(patterns, np.uint64).view(np.int64)


def neighbourhood_links(values: DataFrame, radius: int) -> DataFrame:
    """Links (``u, v``) that connect all of ``fp`` within ``radius``, by the values
    around them: whatever lies within the larger half of the radius around z is
    linked to the smallest fingerprint within the smaller half."""
    def around(r: int) -> DataFrame:
        schema = T.StructType([T.StructField("fp", T.LongType()), T.StructField("z", T.LongType())])

        def run(batches):
            patterns = ball(r)
            step = max(1, (1 << 18) // len(patterns))
            for batch in batches:
                fp = batch.column(0).to_numpy()
                for a in range(0, len(fp), step):
                    z = fp[a:a + step, None] ^ patterns[None, :]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(fp[a:a + step], len(patterns))), pa.array(z.ravel())],
                        schema.names)

        return values.select("fp").mapInArrow(run, schema)

    hubs = around(radius // 2).groupBy("z").agg(F.min("fp").alias("v"))
    return (keyed_join(around(radius - radius // 2), hubs, ["z"], "inner")
            .where("fp != v").select(F.col("fp").alias("u"), "v").distinct())


def fingerprint_links(values: DataFrame, options: SimHashOptions) -> DataFrame:
    """``u, v``: links between the distinct fingerprints ``fp`` that connect all
    that are within the radius of one another."""
    masks = covering_masks(options.radius)
    keyed = values.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("tab", "key"))
    shared = stage(keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n"))
                   .where("n > 1"), "llm-buckets")
    members = stage(keyed_join(keyed, shared, ["tab", "key"], "inner"), "llm-bucket-members")
    small = bucket_links(members.where(F.col("n") <= options.bucket), options)
    large = members.where(F.col("n") > options.bucket).select("fp").distinct()
    return small.unionByName(neighbourhood_links(large, options.radius))


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                   options: SimHashOptions | None = None) -> DataFrame:
    """One row per input row: its id, ``fp``, ``component_id``: the smallest id that
    links reach, its own included.

    Null, empty and wordless texts have fingerprint 0 and link like others. A text
    of fewer words than a shingle is one shingle. Repeated rows share a fingerprint
    and each get their row; rows without an id link, but name no component unless
    all in it lack one (null). Other columns are not read. Texts of any length are
    split in segments. An empty table gives an empty result.
    """
    options = options or SimHashOptions()
    rows = fingerprints(docs, id_column, text, options)
    values = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "llm-values")
    labels = connected_components(fingerprint_links(values, options))
    placed = (values.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("label", F.coalesce("label", "fp")))
    placed = stage(placed, "llm-placed")
    least = placed.groupBy("label").agg(F.min("first").alias("component_id"))
    found = keyed_join(placed.select("fp", "label"), least, ["label"], "inner")
    return keyed_join(rows, found.select("fp", "component_id"), ["fp"], "inner").select(
        F.col("id").alias(id_column), "fp", "component_id")


@query("op12_simhash")
def op12(spark, sf_dir):
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
