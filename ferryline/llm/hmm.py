"""Language-model scores from a hidden Markov model over word classes.

Latent states emit word classes and a class emits its words: the most frequent
words are a class each, all others share hashed classes by their first and last
letters. Baum-Welch trains the states: every task runs the scaled forward and
backward recursions over its documents, the expected counts are summed by class
across partitions, and the driver normalises a model of fixed size. The exact
likelihood of a text follows from one more forward recursion and from the
corpus counts of its words.

Word counts are a table that grows with the corpus. Counts of a bounded number
of frequent words are broadcast, which spares the join its hot keys; all other
words are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.joins import keyed_join

from .shared import digest_pair, query, stage, table, text_of

#: The end of a text, as a word; no real word is empty.
END = ""

#: Distinct words a task counts before it hands its counts on.
COUNTED_WORDS = 400_000

_KEY = ["__k1", "__k2"]


@dataclass(frozen=True)
class HmmOptions:
    """``lexicon``: words with a class of their own; ``shared``: hashed classes;
    ``frequent``: words whose counts are broadcast, each of at most
    ``word_bytes``; ``tokens``: tokens of one recursion."""
    states: int = 8
    lexicon: int = 4_095
    shared: int = 4_096
    frequent: int = 1 << 18
    word_bytes: int = 64
    iterations: int = 4
    tokens: int = 400_000
    pseudo: float = 0.02
    seed: int = 11

    @property
    def classes(self) -> int:
        return self.lexicon + self.shared


def words_of(text: str) -> list[bytes]:
    """White-space separated words, A-Z lower-cased, and the end."""
    return [*text.encode().lower().split(), b""]


def hashed_class(word: bytes, shared: int) -> int:
    """Class, among the shared ones, of a word: by its first and last two letters."""
    text = word.decode()
    return zlib.crc32((text[:2] + text[-2:]).encode()) % shared


def _hashed_column(word: str, shared: int) -> Column:
    ends = F.concat(F.left(F.col(word), F.lit(2)), F.right(F.col(word), F.lit(2)))
    return (F.crc32(ends.cast("binary")) % shared).cast("int")


class Lexicon(dict):
    """Word -> number: frequent words by rank, others minus their class minus 1."""

    def __init__(self, words: list[bytes], shared: int):
        super().__init__(zip(words, range(len(words))))
        self.shared = shared

    def __missing__(self, word: bytes) -> int:
        return -1 - hashed_class(word, self.shared)


# -- the recursions ----------------------------------------------------------------


@dataclass
class Hmm:
    """start (K), move (K x K) and emit (classes x K) probabilities."""
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def initial(cls, options: HmmOptions, counts: np.ndarray) -> Hmm:
        """States that share the corpus' class frequencies, each a little off."""
        rng = np.random.default_rng(options.seed)
        k = options.states
        base = (counts + options.pseudo) / (counts + options.pseudo).sum()
        emit = base[:, None] * rng.gamma(1.0, 1.0, (len(counts), k))
        move = np.full((k, k), 0.1 / k) + 0.9 * np.eye(k)
        return cls(np.full(k, 1 / k), move, emit / emit.sum(0))

    @classmethod
    def from_counts(cls, start, move, emit, pseudo: float) -> Hmm:
        start, move, emit = start + pseudo, move + pseudo, emit + pseudo
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def time_major(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequences, longest first, laid out step by step.

    Returns the classes, the sequence of each, how many run at each step, and
    where each step begins.
    """
    sizes = np.array([len(s) for s in sequences])
    running = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes[0]), "right")
    begin = np.concatenate([[0], np.cumsum(running)])
    step = np.concatenate([np.arange(n) for n in sizes])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = begin[step] + owner
    classes, owners = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    classes[place], owners[place] = np.concatenate(sequences), owner
    return classes, owners, running, begin


def forward(model: Hmm, emitted: np.ndarray, running: np.ndarray,
            begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward probabilities and the scale of every token."""
    alpha, scale = np.empty_like(emitted), np.empty(len(emitted))
    held = np.broadcast_to(model.start, (running[0], len(model.start))) @ np.eye(len(model.start))
    for t, n in enumerate(running):
        a = begin[t]
        if t:
            held = held[:n] @ model.move
        held = held * emitted[a:a + n]
        total = held.sum(1)
        held /= total[:, None]
        alpha[a:a + n], scale[a:a + n] = held, total
    return alpha, scale


def expected_counts(model: Hmm, sequences: list[np.ndarray], start: np.ndarray, move: np.ndarray,
                    emit: np.ndarray) -> None:
    """Add the expected counts of the sequences (longest first) to the totals."""
    classes, _, running, begin = time_major(sequences)
    emitted = model.emit[classes]
    alpha, scale = forward(model, emitted, running, begin)
    beta = np.ones_like(alpha)
    moved = np.zeros_like(move)
    for t in range(len(running) - 2, -1, -1):
        a, b, n = begin[t], begin[t + 1], running[t + 1]
        ahead = emitted[b:b + n] * beta[b:b + n]
        ahead /= scale[b:b + n, None]
        beta[a:a + n] = ahead @ model.move.T
        moved += alpha[a:a + n].T @ ahead
    move += moved * model.move
    alpha *= beta
    start += alpha[:running[0]].sum(0)
    for k in range(emit.shape[1]):
        emit[:, k] += np.bincount(classes, alpha[:, k], len(emit))


def log_likelihoods(model: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each class sequence (longest first)."""
    classes, owners, running, begin = time_major(sequences)
    _, scale = forward(model, model.emit[classes], running, begin)
    return np.bincount(owners, np.log10(scale), len(sequences))


def groups(sequences: list[np.ndarray], tokens: int) -> list[np.ndarray]:
    """Indices of the sequences, longest first, in groups of about ``tokens``."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    cuts, held = [0], 0
    for k, i in enumerate(order):
        if held and held + len(sequences[i]) > tokens:
            cuts.append(k)
            held = 0
        held += len(sequences[i])
    return [order[a:b] for a, b in zip(cuts, [*cuts[1:], len(order)]) if b > a]


# -- on tables -----------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all rows of ``__text``, the end of each text included.

    A task hands its counts on whenever it holds ``COUNTED_WORDS`` words.
    """
    def run(batches):
        held: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()),
                 pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(words_of(text))
                if len(held) >= COUNTED_WORDS:
                    yield flush()
        yield flush()

    counted = texts.select("__text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


def _frequent(vocabulary: DataFrame, most: int) -> list:
    """The words from a count on, at most ``most``, most frequent first.

    The count comes from a histogram in steps of a 64th of a power of two, so
    no task and no driver has to sort the vocabulary.
    """
    step = F.floor(F.log2("c") * 64).alias("step")
    bins = vocabulary.groupBy(step).agg(F.count(F.lit(1)).alias("n")).collect()
    lowest, held = None, 0
    for r in sorted(bins, key=lambda r: -r["step"]):
        held += r["n"]
        if held > most:
            break
        lowest = r["step"]
    if lowest is None:
        return []
    found = vocabulary.where(F.floor(F.log2("c") * 64) >= lowest).collect()
    return sorted(found, key=lambda r: (-r["c"], r["word"]))


@dataclass
class CorpusCounts:
    """The bounded part of the corpus counts, as the driver holds it."""
    tokens: int
    words: int
    frequent: list[bytes]
    logs: np.ndarray  # log10(c + 1) of the frequent words
    kinds: np.ndarray  # class of the frequent words
    class_tokens: np.ndarray  # per class
    shared_room: np.ndarray  # log10(N + V + 1) of each shared class

    @classmethod
    def of(cls, vocabulary: DataFrame, options: HmmOptions) -> CorpusCounts:
        total = vocabulary.agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
        top = _frequent(vocabulary.where(F.octet_length("word") <= options.word_bytes),
                        options.frequent)
        own = {r["word"] for r in top[:options.lexicon]}
        counts = np.zeros(options.classes)
        counts[:len(own)] = [r["c"] for r in top[:options.lexicon]]
        tokens, words = np.zeros(options.shared), np.zeros(options.shared)
        for r in (vocabulary.groupBy(_hashed_column("word", options.shared).alias("b"))
                  .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()):
            tokens[r["b"]], words[r["b"]] = r["n"], r["v"]
        for r in top[:options.lexicon]:
            b = hashed_class(r["word"].encode(), options.shared)
            tokens[b] -= r["c"]
            words[b] -= 1
        counts[options.lexicon:] = tokens
        frequent = [r["word"].encode() for r in top]
        kinds = [k if k < options.lexicon else
                 options.lexicon + hashed_class(w, options.shared) for k, w in enumerate(frequent)]
        return cls(total["n"] or 0, total["v"], frequent,
                   np.log10(np.array([r["c"] for r in top], float) + 1),
                   np.array(kinds, np.int64), counts, np.log10(tokens + words + 1))


SEQUENCES = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_frequent", T.LongType()),
    T.StructField("log_frequent", T.DoubleType()), T.StructField("log_own", T.DoubleType()),
    T.StructField("log_room", T.DoubleType()), T.StructField("classes", T.BinaryType())])


def class_sequences(rows: DataFrame, counts: CorpusCounts, options: HmmOptions) -> DataFrame:
    """``rows`` (last column ``__text``) with the text replaced by its class
    sequence and the sums that need frequent words only."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    kept = rows.schema.fields[:-1]
    schema = T.StructType([*kept, *SEQUENCES])

    def run(batches):
        counts = shared.value
        lexicon = Lexicon(counts.frequent, options.shared)
        own = min(options.lexicon, len(counts.frequent))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a in range(0, len(texts), 1_000):
                out = []
                for text in texts[a:a + 1_000]:
                    words = words_of(text)
                    ids = np.fromiter(map(lexicon.__getitem__, words), np.int64, len(words))
                    frequent = ids[ids >= 0]
                    kind = options.lexicon - 1 - ids
                    kind[ids >= 0] = counts.kinds[frequent]
                    room = counts.shared_room[kind[kind >= options.lexicon] - options.lexicon]
                    out.append((len(ids), len(frequent), float(counts.logs[frequent].sum()),
                                float(counts.logs[frequent[frequent < own]].sum()),
                                float(room.sum()), kind.astype("<u2").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(a, len(out)) for c in batch.columns[:-1]],
                     *[pa.array(c, t) for c, t in zip(zip(*out), (
                         pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(),
                         pa.binary()))]], schema.names)

    return rows.mapInArrow(run, schema)


def _sequences(column) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in column.to_pylist()]


def baum_welch(sequences: DataFrame, counts: CorpusCounts, options: HmmOptions) -> Hmm:
    """Train on every row's ``classes``. Tasks emit one row per class with its
    expected counts by state; the sums, one row per class, meet on the driver."""
    model = Hmm.initial(options, counts.class_tokens)
    k, c = options.states, options.classes
    columns = [f"s{i}" for i in range(k)]
    for _ in range(options.iterations):
        shared = sequences.sparkSession.sparkContext.broadcast(model)

        def run(batches, shared=shared):
            start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((c, k))
            for batch in batches:
                own = _sequences(batch.column(0))
                for group in groups(own, options.tokens):
                    expected_counts(shared.value, [own[i] for i in group], start, move, emit)
            cells = np.vstack([emit, move, start[None]])
            used = np.flatnonzero(cells.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), *[pa.array(cells[used, i]) for i in range(k)]],
                ["cell", *columns])

        summed = (sequences.select("classes")
                  .mapInArrow(run, "cell long, " + ", ".join(f"{x} double" for x in columns))
                  .groupBy("cell").agg(*[F.sum(x).alias(x) for x in columns]).collect())
        cells = np.zeros((c + k + 1, k))
        for r in summed:
            cells[r["cell"]] = r[1:]
        model = Hmm.from_counts(cells[-1], cells[c:c + k], cells[:c], options.pseudo)
        shared.unpersist()
    return model


def rare_words(rows: DataFrame, counts: CorpusCounts, options: HmmOptions) -> DataFrame:
    """``__k1, __k2, word, n`` for the words of each text that are not frequent."""
    shared = rows.sparkSession.sparkContext.broadcast(counts.frequent)

    def run(batches):
        frequent = set(shared.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a in range(0, len(texts), 1_000):
                at, words, times = [], [], []
                for i, text in enumerate(texts[a:a + 1_000]):
                    rare = Counter(w for w in words_of(text) if w not in frequent)
                    at += [a + i] * len(rare)
                    words += rare
                    times += rare.values()
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(words, pa.binary()).cast(pa.string()),
                     pa.array(times, pa.int64())], [*_KEY, "word", "n"])

    return rows.select(*_KEY, "__text").mapInArrow(
        run, "__k1 long, __k2 long, word string, n long")


def lm_scores(docs: DataFrame, learn: Column, id_column: str = "doc_id", text: str = "text",
              options: HmmOptions | None = None) -> DataFrame:
    """One row per input row: id, ``learned``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (log10, smoothed word frequencies) and
    ``score`` (log10 likelihood of the whole text under the trained model).

    Rows for which ``learn`` holds train the counts and the model. Null text is
    the empty text, whose only token is its end. Texts are scored whole, in one
    recursion however long. Scores depend on the text alone: the sums of equal
    texts meet under one key and are divided by their number. Other columns are
    not read. Nothing to learn from leaves uniform states; an empty table gives
    an empty result.
    """
    options = options or HmmOptions()
    rows = docs.select(F.col(id_column).alias("__id"), F.coalesce(learn, F.lit(False))
                       .alias("learned"), *digest_pair(text_of(text)),
                       text_of(text).alias("__text"))
    vocabulary = stage(word_counts(rows.where("learned")), "llm-vocabulary")
    counts = CorpusCounts.of(vocabulary, options)
    sequences = stage(class_sequences(rows, counts, options), "llm-classes")
    model = sequences.sparkSession.sparkContext.broadcast(
        baum_welch(sequences.where("learned"), counts, options))
    rare = rare_words(rows, counts, options)
    summed = (keyed_join(rare, vocabulary, ["word"], "left").groupBy(*_KEY).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("log_rare"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_rare_known"),
        F.sum("n").alias("n_rare")))
    kept = [f for f in sequences.schema.fields if f.name != "classes"]
    schema = T.StructType([*kept, T.StructField("log_classes", T.DoubleType())])

    def run(batches):
        for batch in batches:
            own = _sequences(batch.column(batch.num_columns - 1))
            found = np.zeros(len(own))
            for group in groups(own, options.tokens):
                found[group] = log_likelihoods(model.value, [own[i] for i in group])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], schema.names)

    scored = keyed_join(sequences.mapInArrow(run, schema), summed, _KEY, "left")
    copies = F.col("n_rare") / (F.col("n_tokens") - F.col("n_frequent"))
    log_rare = F.coalesce(F.col("log_rare") / copies, F.lit(0.0))
    known = F.coalesce(F.round(F.col("n_rare_known") / copies).cast("long"), F.lit(0).cast("long"))
    room = float(np.log10(counts.tokens + counts.words + 1))
    return scored.select(
        F.col("__id").alias(id_column), "learned", "n_tokens",
        (F.col("n_frequent") + known).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("log_frequent") + log_rare - F.col("n_tokens") * room).alias("base_score"),
        (F.col("log_classes") + F.col("log_frequent") - F.col("log_own") + log_rare
         - F.col("log_room")).alias("score"))


@query("op3_lm_score")
def op3(spark, sf_dir):
    kept_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = lm_scores(table(spark, sf_dir, "documents"), ~F.coalesce(kept_out, F.lit(False)))
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")
