"""The conversation trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Extra columns carry names the operator uses inside.
TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("conv", T.StringType()), T.StructField("pos", T.StringType()),
    T.StructField("depth", T.IntegerType())])


def conversations():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 70), 101, 119, 203, -7, -20]:
        if c % 20 == 0 and c >= 60:
            continue  # no donor for 61 to 69, 101 and 119
        for k in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, k, rng.choice(["user", "bot"]), rng.choice(["a b", "a  b\tc", "", "d"])))
    rows += [(40, None, None, None), (40, None, "user", "early"), (41, 3, "user", "tie"),
             (41, 3, "bot", "tie"), (41, 3, "bot", "tie"), (None, 0, "user", "nobody's")]
    rows += [(5, k, "user", "long " * (k % 3)) for k in range(10, 400)]
    rows += [(300 + k, t, "user", f"turn {t}") for k in range(20) for t in range(3)]
    rng.shuffle(rows)
    return rows


def brute_force(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    result = set()
    for prefix, inside in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(q[:-1] == p for q in below if q)]
        saved = sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in inside if rebuilt[c] == prefix)))
        result.add((min(inside), len(prefix), min(members[prefix[:-1]]) if prefix else None,
                    len(inside), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return result


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def trie(df, **options):
    conv = F.col("conv")
    return prefix_trie.conversation_trie(
        df, longest_head=3, head=F.crc32(conv.cast("string").cast("binary")) % 4,
        donor=conv - conv % 20, **options)


def test_conversation_trie(spark, monkeypatch):
    rows = conversations()
    # Long conversations and large families over many windows, ranges and tasks.
    monkeypatch.setattr(prefix_trie, "WINDOW_TURNS", 64)
    monkeypatch.setattr(prefix_trie, "SIBLING_BITS", 2)
    df = spark.createDataFrame([(*r, "x", None, 1) for r in rows], TURNS).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = trie(df, task_arcs=100).select(*COLUMNS).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == brute_force(rows)
    assert trie(df.limit(0)).collect() == []


@pytest.mark.parametrize("task_arcs", [1 << 16, 50])
def test_list_ranks_whatever_the_order(spark, task_arcs):
    """Ids in random order leave ranges nothing to join, so neighbours are spliced."""
    n = 1000
    ids = random.Random(2).sample(range(10 * n), n)
    arcs = [(ids[k], ids[k + 1] if k + 1 < n else None, k % 3, k) for k in range(n)]
    df = spark.createDataFrame(arcs, "id long, next long, leaf long, saved long").repartition(5)
    found = {r["id"]: (r["leaf"], r["saved"])
             for r in prefix_trie.list_ranks(df, task_arcs).collect()}
    leaf = saved = 0
    for a in arcs:
        assert found[a[0]] == (leaf, saved)
        leaf, saved = leaf + a[2], saved + a[3]
    assert len(found) == n
