"""SimHash groups against brute force."""

import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import types as T

import __spark_entry__
from ferryline.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("label", T.IntegerType())])


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids_and_prints):
    ids_and_prints = list(ids_and_prints)
    prints = sorted({p for _, p in ids_and_prints})
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(a)] = find(b)
    least = {}
    for i, p in ids_and_prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return {p: least.get(find(p)) for p in prints}


def texts():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeÜ") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (400, 90, 20_000)]
    out = [None, "", " \n\x0b", "one", "One two", "one\ttwo", "a b c", "x y\x1cz w", "long" * 400_000]
    out += base + [base[0].upper(), base[0] + " end", base[2] + " end"]
    for k in range(120):
        words = base[0].split(" ")
        words[rng.randrange(400)] = "changed"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("bucket", [4096, 3])
def test_simhash_groups(spark, bucket):
    """With a bucket of 3, nearly all links come through neighbourhoods."""
    rows = [(k if k % 9 else None, t, "x", 1) for k, t in enumerate(texts())]
    rows += rows[-3:]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    options = simhash.SimHashOptions(bucket=bucket, segment=1000)
    found = simhash.simhash_groups(df, options=options).collect()
    prints = [(i, brute_fingerprint(t)) for i, t, *_ in rows]
    group = brute_groups(prints)
    assert sorted((r["doc_id"] or -1, r["fp"] % (1 << 64), r["component_id"] or -1)
                  for r in found) == sorted((i or -1, p, group[p] or -1) for i, p in prints)
    assert len({p for _, p in prints}) > len({*group.values()}) > 5
    assert simhash.simhash_groups(df.limit(0), options=options).collect() == []


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in combinations(range(64), radius):
        difference = sum(1 << b for b in bits)
        assert any(difference & m == 0 for m in masks)


def test_forest_connects_what_links_connect():
    rng = random.Random(4)
    values = {0, 7, -1}
    for _ in range(300):
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(12)))
    edges = [*simhash.linked_forest(sorted(values), 3)]
    assert all(((u ^ v) % (1 << 64)).bit_count() <= 3 for u, v in edges)
    group = brute_groups((v, v % (1 << 64)) for v in values)
    assert len(edges) == len(values) - len({*group.values()})


def test_registered_query_agrees_with_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs}
    group = brute_groups(prints.items())
    found = __spark_entry__.queries()["op12_simhash"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in found) == sorted(
        (i, f"{p:016x}", group[p]) for i, p in prints.items())
