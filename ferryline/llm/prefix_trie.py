"""Prefix trie of conversations, measured through an Euler tour of its nodes.

Every distinct sequence of first turns is a node. A node's key is the XOR of
hashes of (position, turn) over its turns, so keys are running XORs and need no
look at the text of earlier turns. Each node then gets an enter and an exit arc;
an arc's successor follows from first child, next sibling and parent. Ranking
that list gives every arc the sum of what lies before it, and a node's subtree
is what lies between its two arcs.

The list is ranked by contraction: arcs are dealt out by ranges of their ids, a
task joins the arcs that follow one another within it to stretches, the list of
stretches is ranked in the same way, and its sums are handed back down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.joins import keyed_join

from .shared import query, stage, table, text_of

WORD = r"[^\x20\x09-\x0D]+"

#: Arcs that one task contracts, and turns of a conversation that one window sums.
TASK_ARCS, WINDOW_TURNS = 1 << 16, 1 << 14
#: Siblings whose order one window finds, as a power of two of node numbers.
SIBLING_BITS = 12

_NODE = ["depth", "k1", "k2"]


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, r1, r2, words``: a row per turn, numbered from 0 in its conversation.

    Turns are ordered by ``turn`` (null first), then role and text; null role or
    text is empty. Repeated rows are turns of their own. Rows without a
    conversation are left out. A conversation of any length is sorted by many
    tasks: ranges of (conversation, turn) give each turn a place in its range,
    and only conversations that cross a border between ranges, fewer than there
    are ranges, need a sum over them.
    """
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        text_of(role).alias("role"), text_of(text).alias("text"),
        F.monotonically_increasing_id().alias("tie"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    turn_key = [F.xxhash64(*salt, "role", "text").alias(f"r{k}")
                for k, salt in ((1, ()), (2, (F.lit("second"),)))]
    placed = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", *turn_key, F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
                F.monotonically_increasing_id().alias("at"))
        .withColumn("range", F.shiftright("at", 33)), "llm-turns")
    crossing = (placed.groupBy("conv").agg(F.min("range").alias("a"), F.max("range").alias("b"))
                .where("a < b").select("conv"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = (placed.join(F.broadcast(crossing), "conv").groupBy("conv", "range")
               .agg(F.count(F.lit(1)).alias("n"))
               .select("conv", "range", F.coalesce(F.sum("n").over(before), F.lit(0))
                       .alias("earlier")))
    own = F.row_number().over(Window.partitionBy("conv", "range").orderBy("at"))
    return (placed.withColumn("own", own)
            .join(F.broadcast(earlier), ["conv", "range"], "left")
            .select("conv", (F.col("own") - 1 + F.coalesce("earlier", F.lit(0))).cast("long")
                    .alias("pos"), "r1", "r2", "words"))


def rebuilt_turns(turns: DataFrame, conversations: DataFrame, head: Column,
                  donor: Column, longest_head: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one.

    ``turns`` come from :func:`numbered_turns`, ``conversations`` has ``conv`` and
    its number of turns ``n``. Conversation c becomes the first ``head`` turns of
    conversation ``donor`` (all if it has fewer, none if there is no such one),
    then its own turns after its first ``head``. Returns turns and conversations
    in the form they came in.
    """
    plan = conversations.select("conv", "n", head.cast("long").alias("head"),
                                donor.cast("long").alias("donor"))
    donors = conversations.select(F.col("conv").alias("donor"), F.col("n").alias("has"))
    plan = stage(plan.join(donors, "donor", "left").select(
        "conv", "n", "head", "donor",
        F.least("head", F.coalesce("has", F.lit(0).cast("long"))).alias("taken")), "llm-plan")
    given = (plan.where("taken > 0").select(F.col("conv").alias("c"), "taken",
                                            F.col("donor").alias("conv"))
             .join(turns.where(F.col("pos") < longest_head), "conv").where("pos < taken")
             .select(F.col("c").alias("conv"), "pos", "r1", "r2", "words"))
    own = (keyed_join(turns, plan.select("conv", "head", "taken"), ["conv"], "inner")
           .where("pos >= head")
           .select("conv", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"),
                   "r1", "r2", "words"))
    lengths = plan.select("conv", (F.col("taken") + F.greatest(
        F.col("n") - F.col("head"), F.lit(0))).alias("n"))
    return given.unionByName(own), lengths


def prefix_keys(turns: DataFrame) -> DataFrame:
    """``conv, depth, k1, k2, p1, p2, words``: the keys of the node each turn leads
    to and of that node's parent. Long conversations are summed in windows of
    WINDOW_TURNS turns, and the sums of a conversation's windows once more."""
    placed = turns.select(
        "conv", (F.col("pos") + 1).alias("depth"), "words",
        F.shiftright("pos", WINDOW_TURNS.bit_length() - 1).alias("part"),
        F.xxhash64("pos", "r1", "r2").alias("x1"),
        F.xxhash64("r2", "r1", "pos").alias("x2"))
    within = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0)
    parts = placed.where(F.col("part") > 0).select("conv").distinct()
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (placed.join(parts, "conv").groupBy("conv", "part")
               .agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
               .select("conv", "part", F.bit_xor("y1").over(before).alias("y1"),
                       F.bit_xor("y2").over(before).alias("y2")))
    summed = placed.withColumns({f"s{k}": F.bit_xor(f"x{k}").over(within) for k in (1, 2)})
    zero = F.lit(0).cast("long")
    key = [F.col(f"s{k}").bitwiseXOR(F.coalesce(f"y{k}", zero)) for k in (1, 2)]
    return (keyed_join(summed, earlier, ["conv", "part"], "left")
            .select("conv", "depth", *[key[k - 1].alias(f"k{k}") for k in (1, 2)],
                    *[key[k - 1].bitwiseXOR(F.col(f"x{k}")).alias(f"p{k}") for k in (1, 2)],
                    "words"))


def trie_nodes(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per node: key, parent's key, ``conv_id`` (smallest member), ``n_convs``,
    ``words`` of the last turn, and its number ``node``.

    Nodes are numbered in the order of (conv_id, depth), by ranges, so that the
    nodes of a conversation, and of those near it, mostly share a range.
    """
    none = F.lit(None).cast("long")
    roots = lengths.select("conv", F.lit(0).cast("long").alias("depth"),
                           F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
                           none.alias("p1"), none.alias("p2"),
                           F.lit(0).cast("long").alias("words"))
    nodes = prefixes.unionByName(roots).groupBy(*_NODE).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    return (nodes.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
            .withColumn("node", F.monotonically_increasing_id()))


def _linked(nodes: DataFrame) -> DataFrame:
    """``nodes`` with parent's number and conv_id, ``first`` child, next ``sibling``
    and ``n_children``. A parent of any number of children is split: siblings are
    ordered within ranges of node numbers, then the ranges of a parent among
    themselves."""
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"),
                           F.col("k2").alias("p2"), F.col("node").alias("parent"),
                           F.col("conv_id").alias("parent_conv_id"))
    found = stage(keyed_join(nodes, parents, ["depth", "p1", "p2"], "left")
                  .withColumn("part", F.shiftright("node", SIBLING_BITS)), "llm-trie-parents")
    children = found.where(F.col("parent").isNotNull())
    parts = children.groupBy("parent", "part").agg(F.min("node").alias("first"),
                                                   F.count(F.lit(1)).alias("n"))
    following = parts.select("parent", "part", F.lead("first").over(
        Window.partitionBy("parent").orderBy("part")).alias("after"))
    nearest = F.lead("node").over(Window.partitionBy("parent", "part").orderBy("node"))
    siblings = children.select("node", "parent", "part", nearest.alias("near"))
    siblings = keyed_join(siblings, following, ["parent", "part"], "left").select(
        "node", F.coalesce("near", "after").alias("sibling"))
    families = parts.groupBy(F.col("parent").alias("node")).agg(
        F.min("first").alias("first"), F.sum("n").alias("n_children"))
    return (found.join(siblings, "node", "left").join(families, "node", "left")
            .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))


def tour(linked: DataFrame) -> DataFrame:
    """``id, next, leaf, saved``: the arcs of the Euler tour. Arc 2v enters node v
    and carries its weights, arc 2v + 1 leaves it; the root's last arc has no next."""
    enter = F.struct((F.col("node") * 2).alias("id"),
                     F.coalesce(F.col("first") * 2, F.col("node") * 2 + 1).alias("next"),
                     F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
                     ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    leave = F.struct((F.col("node") * 2 + 1).alias("id"),
                     F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next"),
                     F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"))
    return linked.select(F.explode(F.array(enter, leave)).alias("a")).select("a.*")


_STRETCH = T.StructType([T.StructField(c, T.LongType()) for c in (
    "id", "head", "leaf", "saved", "next", "own_leaf", "own_saved")]
    + [T.StructField("tail", T.BooleanType())])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arcs of one task, each with the first arc of its stretch, the weights
    between that arc and itself, and whether the stretch ends here."""
    got = pa.Table.from_batches(list(batches)) if (batches := [*batches]) else None
    if got is None or got.num_rows == 0:
        return
    got = got.sort_by("id")
    ids = got["id"].to_numpy()
    follows = got["next"].fill_null(-1).to_numpy()
    weights = np.stack([got["leaf"].to_numpy(), got["saved"].to_numpy()])
    n = len(ids)
    at = np.minimum(np.searchsorted(ids, follows), n - 1)
    here = ids[at] == follows
    back = np.arange(n)
    back[at[here]] = np.flatnonzero(here)
    sums = np.where(back == np.arange(n), 0, weights[:, back])
    while True:  # doubling: the way back to the stretch's first arc, with its weights
        further = back[back]
        if np.array_equal(further, back):
            break
        sums = sums + sums[:, back]
        back = further
    columns = [ids, ids[back], *sums, follows, *weights]
    arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(~here)]
    arrays[4] = pa.array(follows, pa.int64(), mask=follows < 0)
    yield from pa.Table.from_arrays(arrays, _STRETCH.names).to_batches(1 << 16)


def _splice(arcs: DataFrame, round_no: int) -> tuple[DataFrame, DataFrame]:
    """Every arc whose coin shows tails, after one that shows heads, is taken into
    the latter: the shorter list, and where the others went."""
    coin = (F.xxhash64("id", F.lit(round_no)) % 2) == 0
    tossed = stage(arcs.withColumn("heads", coin), "llm-coins")
    tails = tossed.where(~F.col("heads")).select(
        F.col("id").alias("next"), F.col("next").alias("beyond"), F.col("leaf").alias("l2"),
        F.col("saved").alias("s2"), F.lit(True).alias("met"))
    heads = stage(tossed.where("heads").join(tails, "next", "left"), "llm-spliced")
    taken = heads.where("met").select(F.col("next").alias("id"), F.col("id").alias("into"),
                                      F.col("leaf").alias("l1"), F.col("saved").alias("s1"))
    zero = F.lit(0).cast("long")
    kept = heads.select(
        "id", F.when(F.col("met"), F.col("beyond")).otherwise(F.col("next")).alias("next"),
        (F.col("leaf") + F.coalesce("l2", zero)).alias("leaf"),
        (F.col("saved") + F.coalesce("s2", zero)).alias("saved"))
    rest = (tossed.where(~F.col("heads")).join(taken.select("id"), "id", "left_anti")
            .select("id", "next", "leaf", "saved"))
    return kept.unionByName(rest), taken


def list_ranks(arcs: DataFrame, task_arcs: int = TASK_ARCS, depth: int = 0) -> DataFrame:
    """``id, leaf, saved``: the weights of all arcs before each arc of the list
    ``id, next, leaf, saved`` (one list, the last ``next`` null).

    A list of ``task_arcs`` arcs or fewer is ranked by one task. A longer one is
    contracted range by range. If that leaves more than half of it, as with ids
    that say nothing about the order, random neighbours are joined first, which
    takes a quarter away whatever the order.
    """
    n = arcs.count()
    tasks = -(-n // task_arcs)
    dealt = arcs.repartitionByRange(tasks, "id") if tasks > 1 else arcs.coalesce(1)
    local = stage(dealt.mapInArrow(_contract, _STRETCH), "llm-stretches")
    if tasks <= 1:
        return local.select("id", "leaf", "saved")
    stretches = local.where("tail").select(
        F.col("head").alias("id"), "next", (F.col("leaf") + F.col("own_leaf")).alias("leaf"),
        (F.col("saved") + F.col("own_saved")).alias("saved"))
    if 2 * stretches.count() > n:
        shorter, taken = _splice(stretches, depth)
        ranks = list_ranks(stage(shorter, "llm-shorter"), task_arcs, depth + 1)
        upper = ranks.unionByName(
            taken.join(ranks.withColumnRenamed("id", "into"), "into")
            .select("id", (F.col("leaf") + F.col("l1")).alias("leaf"),
                    (F.col("saved") + F.col("s1")).alias("saved")))
    else:
        upper = list_ranks(stage(stretches, "llm-shorter"), task_arcs, depth + 1)
    upper = upper.select(F.col("id").alias("head"), F.col("leaf").alias("l"),
                         F.col("saved").alias("s"))
    return local.join(upper, "head").select(
        "id", (F.col("leaf") + F.col("l")).alias("leaf"),
        (F.col("saved") + F.col("s")).alias("saved"))


_DIGESTS = T.StructType([T.StructField(c, T.LongType()) for c in _NODE]
                        + [T.StructField("ends_sha256", T.StringType())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its blocks, which come in order."""
    node, digest, done = None, None, []

    def flushed():
        columns = [*zip(*done)]
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])],
            _DIGESTS.names)

    for batch in batches:
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*_NODE, "ids")]):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        if len(done) > 10_000:
            yield flushed()
    if node is not None:
        done.append((*node, digest.hexdigest()))
        yield flushed()


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ending conversations (``depth, k1, k2, conv``).

    A node where any share of all conversations ends is sorted by many tasks,
    each of which joins its ids to one block; a task then only streams the
    node's blocks through the digest."""
    blocks = (ends.repartitionByRange(*_NODE, "conv")
              .withColumn("block", F.spark_partition_id()).groupBy(*_NODE, "block")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")),
                                            lambda c: c.cast("string")), ",").alias("ids")))
    return (blocks.repartition(*_NODE).sortWithinPartitions(*_NODE, "block")
            .select(*_NODE, "ids").mapInArrow(_digest, _DIGESTS))


def prefix_trie(turns: DataFrame, conversations: DataFrame,
                task_arcs: int = TASK_ARCS) -> DataFrame:
    """One row per trie node over ``turns`` (``conv, pos, r1, r2, words``, positions
    from 0 without gaps) and ``conversations`` (``conv, n``; those without turns end
    at the root).

    ``conv_id`` (smallest member) and ``depth`` name a node: its last turn is turn
    ``depth`` of that conversation. Further columns: ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. No conversations,
    no nodes. Node keys are 128-bit hashes of the turns and their places.
    """
    prefixes = stage(prefix_keys(turns), "llm-prefixes")
    nodes = stage(trie_nodes(prefixes, conversations), "llm-trie-nodes")
    linked = stage(_linked(nodes), "llm-trie-links")
    ranks = list_ranks(tour(linked), task_arcs)
    # A node's subtree lies between its two arcs.
    side = F.when(F.col("id") % 2 == 1, 1).otherwise(-1)
    sums = ranks.groupBy(F.shiftright("id", 1).alias("node")).agg(
        F.sum(side * F.col("leaf")).alias("n_leaves"),
        F.sum(side * F.col("saved")).alias("saved_tokens"))
    last = conversations.select("conv", F.col("n").alias("depth"))
    zero = F.lit(0).cast("long")
    ends = (prefixes.select("conv", *_NODE).join(last, ["conv", "depth"]).select(*_NODE, "conv")
            .unionByName(last.where("depth = 0").select(
                "depth", zero.alias("k1"), zero.alias("k2"), "conv")))
    digests = end_digests(stage(ends, "llm-trie-ends"))
    return (linked.join(sums, "node").join(digests, _NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
        .alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, head: Column, donor: Column,
                      longest_head: int, **options) -> DataFrame:
    """The prefix trie of conversations after :func:`rebuilt_turns`; ``head`` and
    ``donor`` are columns over ``conv``. Further columns of the input are not read."""
    turns = stage(numbered_turns(conversations), "llm-numbered")
    lengths = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    turns, lengths = rebuilt_turns(turns, lengths, head, donor, longest_head)
    return prefix_trie(stage(turns, "llm-rebuilt"), stage(lengths, "llm-lengths"), **options)


OP11_SQL = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            coalesce(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, count(*) AS n,
         xor(list_reduce(list_prepend(4294967295, list_transform(
               string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
               lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)),
           4294967295) % 4 AS h
  FROM t GROUP BY c),
plan AS (
  SELECT i.c, i.n, i.h, i.c - i.c % 20 AS donor, least(i.h, coalesce(d.n, 0)) AS taken
  FROM ids i LEFT JOIN ids d ON d.c = i.c - i.c % 20),
turns AS (
  SELECT p.c, t.p, t.role, t.body FROM plan p JOIN t ON t.c = p.donor WHERE t.p < p.taken
  UNION ALL
  SELECT p.c, t.p - p.h + p.taken, t.role, t.body FROM plan p JOIN t ON t.c = p.c WHERE t.p >= p.h),
whole AS MATERIALIZED (
  SELECT plan.c, coalesce(list({'r': role, 'b': body} ORDER BY p) FILTER (role IS NOT NULL), []) AS s
  FROM plan LEFT JOIN turns ON turns.c = plan.c GROUP BY plan.c),
nodes AS MATERIALIZED (
  SELECT d AS depth, s[1:d] AS s, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '') AS ends
  FROM whole, unnest(range(0, len(s) + 1)) AS u(d) GROUP BY ALL),
families AS (SELECT depth - 1 AS depth, s[1:depth - 1] AS s, count(*) AS n_children
             FROM nodes WHERE depth > 0 GROUP BY ALL),
weighed AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(
           s[n.depth].b, '[^ \\t\\n\\x0B\\f\\r]+')) END AS saved
  FROM nodes n LEFT JOIN families f USING (depth, s)),
subtrees AS (
  SELECT d AS depth, s[1:d] AS s, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved
  FROM weighed, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, t.n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM weighed w JOIN subtrees t USING (depth, s)
LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.s = w.s[1:w.depth - 1]
"""


@query("op11_prefix_trie", OP11_SQL)
def op11(spark, sf_dir):
    conv = F.col("conv")
    return conversation_trie(
        table(spark, sf_dir, "conversations"), longest_head=3,
        head=F.crc32(conv.cast("string").cast("binary")) % 4, donor=conv - conv % 20)
