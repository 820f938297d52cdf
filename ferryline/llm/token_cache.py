"""Token counts through a digest cache.

A count is stored under the digest of the normalised text and the digest of the
tokenizer's version. Documents are joined to the stored counts; only distinct
texts without one are encoded, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.fs import ClusterFiles
from ferryline.operators.joins import keyed_join
from ferryline.session import scratch_path

from .bpe import slices
from .shared import query, stage, table, text_of

CACHE = T.StructType([T.StructField("digest", T.BinaryType()),
                      T.StructField("n_tokens", T.LongType())])

#: Characters of text encoded in one call.
SLICE_CHARS = 400_000


def tokenizer_version(path: str, content: bytes) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    label = f"{library.__name__} {library.__version__}"
    return hashlib.sha256(label.encode() + hashlib.sha256(content).digest()).hexdigest()[:32]


def _counter(path: str, content: bytes):
    """A function from texts to token counts, made once per task."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(content.decode())
    library.no_truncation()
    library.no_padding()
    return lambda texts: [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def count_texts(texts: DataFrame, vocabulary: str) -> DataFrame:
    """``digest, n_tokens`` of rows ``digest, text``, encoding each text once."""
    with open(vocabulary, "rb") as file:
        content = texts.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        count = _counter(vocabulary, content.value)
        for batch in batches:
            body = batch.column(1).to_pylist()
            for a, b in slices(body, SLICE_CHARS):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(count(body[a:b]), pa.int64())],
                    ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, CACHE)


def token_counts(docs: DataFrame, vocabulary: str, cache: str | None = None,
                 id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``vocabulary`` is a tokenizer file the driver can read (``.model`` or
    ``.json``); it is broadcast, a few MB whatever the data. ``cache`` is a
    folder in the shared store that later calls may name again; without one a
    fresh folder is used. Normalising a text turns null into the empty text and
    nothing else, since any other change could change the count. Two loads that
    append the same digest at once leave two equal rows, of which one is read.
    Repeated texts, in whatever number, are encoded once; a digest with much of
    the rows is summed before its shuffle and split in its join. Other columns
    are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        version = tokenizer_version(vocabulary, file.read())
    folder = f"{(cache or scratch_path(spark, 'llm-token-cache')).rstrip('/')}/{version}"
    body = text_of(text)
    digest = F.unhex(F.sha2(body, 256)).alias("digest")
    rows = stage(docs.select(F.col(id_column).alias("__id"), digest,
                             F.octet_length(body).cast("long").alias("n_bytes")),
                 "llm-digests")
    texts = docs.select(digest, body.alias("text"))
    if ClusterFiles(spark).exists(folder):
        known = spark.read.schema(CACHE).parquet(folder)
        missing = rows.select("digest").distinct().join(known, "digest", "left_anti")
        texts = keyed_join(texts, stage(missing, "llm-missing-digests"), ["digest"], "left_semi")
    # Equal digests mean equal texts, so whichever comes first will do.
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
    count_texts(distinct, vocabulary).write.mode("append").parquet(folder)
    counts = (spark.read.schema(CACHE).parquet(folder)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return keyed_join(rows, counts, ["digest"], "left").select(
        F.col("__id").alias(id_column), "n_bytes", "n_tokens")


@query("op9_token_counts")
def op9(spark, sf_dir):
    import public_tokenizers

    found = token_counts(table(spark, sf_dir, "documents"),
                         public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumn("over_limit", F.col("n_tokens") > 4096)
