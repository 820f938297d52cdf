"""Toxicity from subword-bag embeddings.

A word is the bag of its character n-grams, hashed into buckets with an
embedding each. A passage is the average of its words, a linear softmax turns
the average into a probability, and a document scores as its worst passage.
Embeddings and softmax are trained jointly in numpy. A misspelling shares most
n-grams with the word it hides, so it scores alike though it was never seen.

The worst of many passages looks bad by chance alone. The odds of a passage are
therefore divided by how many times more passages were looked at than in the
median text of the sample, and a text's length does not make it toxic. The log
odds are at last shifted so that even odds lie midway between the labels.

Training runs on a bounded sample of labelled rows; scoring covers all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import query, table, text_of

THRESHOLD = 0.7

#: Log odds above the clean texts of the sample beyond which no doubt is left.
MARGIN = 10.0

#: Words whose score a task keeps; at the bound they are forgotten.
CACHED_WORDS = 200_000
#: Texts that are split into words at a time.
TEXTS = 500


@dataclass(frozen=True)
class ToxicityOptions:
    """``sample_rows``: labelled rows trained on at most, half of each label, and
    ``sample_bytes``: of text in all; ``passage``: words averaged together.
    Training takes at least ``epochs`` and, within ``most_epochs``, ``steps``
    batches; up to step ``whole_steps`` on whole texts, up to ``wide_steps`` on
    passages four times as long."""
    sample_rows: int = 6_000
    sample_bytes: int = 48 << 20
    buckets: int = 1 << 18
    dimensions: int = 8
    shortest: int = 3
    longest: int = 6
    passage: int = 2
    epochs: int = 20
    steps: int = 1_200
    most_epochs: int = 100
    whole_steps: int = 150
    wide_steps: int = 320
    batch: int = 64
    rate: float = 0.3
    decay: float = 1e-4
    seed: int = 7


def words_of(text: str) -> list[bytes]:
    """White-space separated words, A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split()


def subwords(words: list[bytes], options: ToxicityOptions) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``<word>``, word after word, and where each begins."""
    found, starts, done = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    for k in range(0, len(words), 10_000):
        grams, begin = _subwords(words[k:k + 10_000], options)
        found.append(grams)
        starts.append(begin + done)
        done += len(grams)
    return np.concatenate(found), np.concatenate(starts)


def _subwords(words: list[bytes], options: ToxicityOptions) -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer(b"".join([b"<" + w + b">" for w in words]), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))  # bytes to the word's end
    rolled = np.zeros(len(joined), np.uint64)
    owners, found = [], []
    for n in range(1, min(options.longest, len(joined)) + 1):
        ahead = np.zeros(len(joined), np.uint64)
        ahead[:len(joined) - n + 1] = joined[n - 1:]
        rolled = rolled * np.uint64(0x100000001B3) + ahead + np.uint64(1)
        if n >= options.shortest:
            at = np.flatnonzero(left >= n)
            mixed = (rolled[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(24)) % np.uint64(options.buckets))
            owners.append(owner[at])
    # Each word also is a feature of its own: the hash of all its bytes.
    weights = np.power(np.uint64(0x100000001B3), left.astype(np.uint64), dtype=np.uint64)
    starts = np.cumsum(sizes) - sizes
    whole = np.add.reduceat((joined + np.uint64(1)) * weights, starts)
    found.append(((whole * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24))
                 % np.uint64(options.buckets))
    owners.append(np.arange(len(words)))
    owner, found = np.concatenate(owners), np.concatenate(found).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(words)))


def passages(n_words: int, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of overlapping passages that cover all words."""
    if n_words <= passage:
        return np.zeros(1, np.int64), np.array([n_words])
    starts = np.arange(0, n_words - passage + passage // 2, passage // 2)
    starts = np.minimum(starts, n_words - passage)
    return starts, starts + passage


@dataclass
class ToxicityModel:
    """What scoring needs: a weight per bucket (embedding times softmax
    difference), the softmax bias, the options, the number of passages up to
    which no odds are divided, and the shift of log odds."""
    weights: np.ndarray
    bias: float
    options: ToxicityOptions
    usual: float = 1.0
    shift: float = 0.0

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        found, starts = subwords(words, self.options)
        if not len(starts):
            return np.zeros(0)
        counts = np.diff(np.append(starts, len(found)))
        return np.add.reduceat(self.weights[found], starts) / counts

    def score(self, scores: np.ndarray) -> float:
        """Probability of the worst passage of a document's word scores."""
        return float(1 / (1 + np.exp(-self.judged(scores)[0])))

    def judged(self, scores: np.ndarray) -> tuple[float, int, int]:
        """The worst passage, its odds divided by the surplus of passages and shifted."""
        odds, a, b = self.worst(scores)
        looked_at = len(passages(len(scores), self.options.passage)[0])
        odds -= float(np.log(max(1.0, looked_at / self.usual)))
        return odds + float(self.shift), a, b

    def worst(self, scores: np.ndarray, width: int | None = None) -> tuple[float, int, int]:
        """Log odds and word range of the passage (of ``width`` words) that scores highest."""
        if not len(scores):
            return self.bias, 0, 0
        total = np.concatenate([[0.0], np.cumsum(scores)])
        a, b = passages(len(scores), width or self.options.passage)
        means = (total[b] - total[a]) / (b - a)
        k = int(np.argmax(means))
        return float(means[k] + self.bias), int(a[k]), int(b[k])


def train(texts: list[str], labels: list[int], options: ToxicityOptions) -> ToxicityModel:
    """Train, then put even odds midway between the labels: between the odds that
    nine in ten texts of label 0 stay below and nine in ten of label 1 exceed.
    A model that tells its sample apart leaves a wide gap there, and an unseen
    clean text lies higher in it than the texts trained on; MARGIN above 99 in a
    hundred of label 0 is enough, however wide the gap."""
    model = train_on(texts, labels, options)
    y = np.array(labels)
    if len({*labels}) == 2:
        odds = np.array([model.judged(model.word_scores(words_of(t)))[0] for t in texts])
        clean, toxic = odds[y == 0], odds[y == 1]
        model.shift = -min((np.quantile(clean, 0.9) + np.quantile(toxic, 0.1)) / 2,
                           np.quantile(clean, 0.99) + MARGIN)
    return model


def train_on(texts: list[str], labels: list[int], options: ToxicityOptions) -> ToxicityModel:
    """Fit embeddings and softmax by Adagrad: first on whole texts, which only
    words common to many of them can tell apart, then on the worst long and at
    last the worst short passage of each text, chosen anew every epoch.

    Without rows of both labels the score is the smoothed share of label 1.
    """
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 1 / 3
        return ToxicityModel(np.zeros(options.buckets), float(np.log(share / (1 - share))), options)
    rng = np.random.default_rng(options.seed)
    index: dict[bytes, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int32)
            for t in texts]
    found, starts = subwords(list(index), options)
    del index
    ends = np.append(starts[1:], len(found))
    by_word = np.zeros(len(starts), np.float32)
    embed = rng.uniform(-1, 1, (options.buckets, options.dimensions)) / options.dimensions
    soft = rng.uniform(-1, 1, (options.dimensions, 2)) / options.dimensions
    bias = np.zeros(2)
    squares = [np.full(x.shape, 1e-6) for x in (embed, soft, bias)]
    # The rarer label weighs more; few rows are gone over more often.
    weight = np.sqrt(np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))))
    epochs = max(options.epochs, min(options.most_epochs,
                                     options.steps * options.batch // max(1, len(y))))
    for epoch in range(epochs):
        done = epoch * -(-len(y) // options.batch)
        width = None if done < options.whole_steps else options.passage * (
            4 if done < options.wide_steps else 1)
        model = ToxicityModel(embed @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]), options)
        for k in range(0, len(starts), 50_000):  # some words at a time
            own = slice(starts[k], ends[min(k + 50_000, len(ends)) - 1])
            begin = starts[k:k + 50_000]
            by_word[k:k + 50_000] = np.add.reduceat(
                model.weights[found[own]], begin - begin[0]) / (ends[k:k + 50_000] - begin)
        rate = options.rate * (1 - epoch / epochs)
        order = rng.permutation(len(docs))
        for k in range(0, len(order), options.batch):
            batch = order[k:k + options.batch]
            spans = []
            for d in batch:
                if width is None:
                    spans.append(docs[d])
                else:
                    _, a, b = model.worst(by_word[docs[d]], width)
                    spans.append(docs[d][a:b])
            words = np.concatenate(spans)
            if not len(words):
                continue
            row = np.repeat(np.arange(len(batch)), [len(s) for s in spans])
            used, at = np.unique(words, return_inverse=True)
            counts = ends[used] - starts[used]
            grams = np.concatenate([found[starts[w]:ends[w]] for w in used])
            gram_word = np.repeat(np.arange(len(used)), counts)
            vectors = np.zeros((len(used), options.dimensions))
            for j in range(options.dimensions):
                vectors[:, j] = np.bincount(gram_word, embed[grams, j], len(used)) / counts
            sizes = np.maximum(1, np.bincount(row, minlength=len(batch)))
            hidden = np.stack([np.bincount(row, vectors[at, j], len(batch))
                               for j in range(options.dimensions)], 1) / sizes[:, None]
            logits = hidden @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            error = (p - np.stack([1 - y[batch], y[batch]], 1)) * (weight[batch] / len(batch))[:, None]
            d_hidden = error @ soft.T / sizes[:, None]
            share = np.stack([np.bincount(at, d_hidden[row, j], len(used))
                              for j in range(options.dimensions)], 1) / counts[:, None]
            touched, where = np.unique(grams, return_inverse=True)
            d_embed = np.stack([np.bincount(where, share[gram_word, j], len(touched))
                                for j in range(options.dimensions)], 1)
            d_embed += options.decay * embed[touched] / len(batch)
            steps = ((embed, touched, d_embed, squares[0]), (soft, slice(None), hidden.T @ error,
                     squares[1]), (bias, slice(None), error.sum(0), squares[2]))
            for value, rows, gradient, square in steps:
                square[rows] += gradient ** 2
                value[rows] -= rate * gradient / np.sqrt(square[rows])
    usual = float(np.median([len(passages(len(d), options.passage)[0]) for d in docs]))
    return ToxicityModel(embed @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]), options, usual)


# -- on tables ---------------------------------------------------------------------


def fitting(rows: list[tuple], room: int) -> list[tuple]:
    """Of ``(id, label, hash, bytes)`` in hash order the first that fit in ``room``
    bytes, less the bytes. The shortest text of each label goes first."""
    shortest = {}
    for k, r in enumerate(rows):
        if r[1] not in shortest or r[3] < rows[shortest[r[1]]][3]:
            shortest[r[1]] = k
    kept = set(shortest.values())
    room -= sum(rows[k][3] for k in kept)
    for k, r in enumerate(rows):
        if k not in kept and r[3] <= room:
            kept.add(k)
            room -= r[3]
    return [rows[k][:3] for k in sorted(kept)]


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id",
                 text: str = "text", label: str = "toxic",
                 options: ToxicityOptions | None = None) -> ToxicityModel:
    """Fit on a sample of the labelled rows for which ``learn`` (over ``labels``) holds.

    The sample is the first rows by a hash of their ids, bounded in rows and
    bytes by ``options``; only it reaches the driver. A text that does not fit is
    passed over, and the shortest of each label is always in. Null labels and labels
    without a document teach nothing; where ids repeat, the highest label and
    the smallest text count.
    """
    options = options or ToxicityOptions()
    known = (labels.where(learn).where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).alias("__id")).agg(F.max(label).cast("int").alias("__y"))
             .withColumn("__h", F.xxhash64(F.lit("sample"), "__id")))
    half = options.sample_rows // 2
    ids = [r for y in (0, 1) for r in known.where(F.col("__y") == y)
           .orderBy("__h").limit(half).collect()]
    spark = docs.sparkSession
    chosen = spark.createDataFrame(ids, known.schema)
    body = text_of(text)

    def sampled(rows: DataFrame) -> DataFrame:
        return (docs.select(F.col(id_column).alias("__id"), body.alias("__text"))
                .join(F.broadcast(rows), "__id").groupBy("__id", "__y", "__h"))

    sizes = sorted(sampled(chosen).agg(F.min(F.octet_length("__text")).alias("n")).collect(),
                   key=lambda r: r["__h"])
    kept = fitting([(r["__id"], r["__y"], r["__h"], r["n"]) for r in sizes], options.sample_bytes)
    rows = sorted(sampled(spark.createDataFrame(kept, known.schema))
                  .agg(F.min("__text").alias("t")).collect(), key=lambda r: r["__h"])
    texts, y = [r["t"] for r in rows], [r["__y"] for r in rows]
    del rows
    return train(texts, y, options)


SCORES = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    T.StructField("worst_from", T.IntegerType()), T.StructField("worst_to", T.IntegerType())])


def _scorer(model: ToxicityModel, words: dict[bytes, float], threshold: float):
    def scored(texts: list[str]) -> list[pa.Array]:
        split = [words_of(t) for t in texts]
        new = list({w for own in split for w in own if w not in words})
        if len(words) + len(new) > CACHED_WORDS:
            words.clear()
            new = list({w for own in split for w in own})
        words.update(zip(new, model.word_scores(new).tolist()))
        worst = [model.judged(np.fromiter(map(words.__getitem__, own), float, len(own)))
                 for own in split]
        score = 1 / (1 + np.exp(-np.array([w[0] for w in worst])))
        return [pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                pa.array([w[1] for w in worst], pa.int32()),
                pa.array([w[2] for w in worst], pa.int32())]
    return scored


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text: str = "text",
                    threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its columns ``keep``), ``score`` (0 to 1),
    ``predicted`` (1 from ``threshold`` on) and the word range of the worst passage.

    Every whole text is scored; null and empty texts get the model's base rate.
    Only the text is an input, so repeated rows score alike. The model is one
    weight per bucket, of fixed size, and is broadcast. An empty table gives an
    empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = list(keep or docs.columns)
    # Where the row holds its text, the text is sent once.
    inside = kept.count(text) == 1 and isinstance(docs.schema[text].dataType, T.StringType)
    rows = docs.select(F.struct(*[F.col(c) for c in kept]).alias("row"),
                       *([] if inside else [text_of(text).alias("__text")]))
    schema = T.StructType([rows.schema["row"], *SCORES])

    def run(batches):
        scored = _scorer(shared.value, {}, threshold)
        for batch in batches:
            texts = batch.column(0).field(text) if inside else batch.column(1)
            for a in range(0, len(texts), TEXTS):
                columns = scored([t or "" for t in texts.slice(a, TEXTS).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, TEXTS), *columns], schema.names)

    return rows.mapInArrow(run, schema)


def held_out(column: str = "doc_id") -> Column:
    """Rows that must not be learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def remove_toxic(docs: DataFrame, labels: DataFrame, learn: Column, **options) -> DataFrame:
    """The input rows, unchanged and with all their columns, that the fitted model
    does not reject. Null and empty texts have the model's base rate; see
    :func:`toxicity_scores` and :func:`fit_toxicity` for the rest."""
    model = fit_toxicity(docs, labels, learn, **options)
    return toxicity_scores(docs, model).where(F.col("predicted") == 0).select("row.*")


@query("op8_toxicity")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out())
    scores = toxicity_scores(docs, model, keep=["doc_id"])
    return scores.select("row.doc_id", held_out("row.doc_id").alias("held_out"),
                         "score", "predicted")
