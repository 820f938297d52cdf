"""Word BPE by depth-first traversal of a trie of the distinct words.

The BPE encoding of a text, less its last token, is the encoding of the text
before that token. So one token per prefix, the last of its encoding, describes
the encodings of all prefixes: it is the only token that ends the prefix and
that the merges would leave standing beside the last token of what comes before
it. A depth-first walk over a trie of words computes that token once for every
distinct prefix, and a word's ids are read off by stepping back.

Each task walks the words its texts add; nothing is shuffled.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import query, table, text_of

#: Entries of the caches of a task; at the bound they are emptied.
CACHED_CHUNKS, CACHED_PAIRS = 350_000, 250_000
#: Words in one trie, and characters of text encoded at a time.
TRIE_WORDS, SLICE_CHARS = 20_000, 1_000_000

END = "</w>"

# The white space of the vocabulary's library, and the pattern of the file.
_SPACE = ("\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _SPACE + r"\p{L}\p{N}]+")

#: Texts without these characters are split here; for others the library's own
#: normaliser and splitter are asked, whose Unicode tables may differ.
_UNUSUAL = re.compile("[\x1c-\x1f\u0130\u0250-\U0010ffff]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return [letters[b] for b in range(256)]


class TrieBpe:
    """Encodes words (in byte letters) of one vocabulary; ids from its merges."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.names = {i: t for t, i in vocab.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b])
                       for rank, (a, b) in enumerate(pairs)}
        self.letters: dict[int, list[int]] = {}  # token -> ids of its single letters
        self.inner: dict[str, int] = {}  # text -> token that ends within a word
        self.final: dict[str, int] = {}  # text -> token that ends a word
        for token, i in vocab.items():
            last = token.endswith(END) and len(token) > len(END)
            text = token[: -len(END)] if last else token
            try:
                self.letters[i] = [vocab[c] for c in text[:-1]] + [vocab[text[-1] + END * last]]
            except KeyError:
                continue
            if self.merged(self.letters[i]) == [i]:
                (self.final if last else self.inner)[text] = i
        self.size = {i: len(x) for i, x in self.letters.items()}
        self.longest = max(self.size.values(), default=1)
        self.reach: dict[str, int] = {}  # last three letters -> longest token that ends so
        for text in sorted([*self.inner, *self.final], key=len):
            self.reach[text[-3:]] = len(text)
        self.pairs: dict[int, bool] = {}

    def merged(self, ids: list[int]) -> list[int]:
        """Apply the merges one by one, lowest rank first, leftmost first."""
        ids = list(ids)
        while len(ids) > 1:
            rank, at, new = min(((*self.merges[p], k) for k, p in enumerate(zip(ids, ids[1:]))
                                 if p in self.merges), key=lambda x: (x[0], x[2]),
                                default=(None, 0, 0))
            if rank is None:
                break
            ids[new:new + 2] = [at]
        return ids

    def stands(self, a: int, b: int) -> bool:
        """Whether the merges leave token ``b`` after token ``a`` as they are."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        fits = (a, b) not in self.merges and \
            self.merged(self.letters[a] + self.letters[b]) == [a, b]
        self.pairs[a << 32 | b] = fits
        return fits

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids (little-endian, 32 bits) of each word, through one trie of all.

        Sorted words with the prefix each shares with the one before it are the
        trie in depth-first order: a word enters at its shared prefix, whose
        tokens are known, and only the nodes below are visited.
        """
        words = sorted(words)
        found: dict[str, bytes] = {}
        inner, final, pairs, reach = self.inner, self.final, self.pairs, self.reach
        size, stands = self.size, self.stands
        last = [0] * (max(map(len, words), default=0) + 1)  # by depth, of the current path
        known = 0
        for word, shared in zip(words, shared_prefixes(words)):
            n = len(word)
            depth = min(shared, known)
            while depth < n:
                depth += 1
                tokens = inner if depth < n else final
                length = min(depth, reach.get(word[max(0, depth - 3):depth], 2))
                while True:
                    token = tokens.get(word[depth - length:depth])
                    if token is not None:
                        if length == depth:
                            break
                        before = last[depth - length]
                        fits = pairs.get(before << 32 | token)
                        if fits or (fits is None and stands(before, token)):
                            break
                    length -= 1
                    if not length:
                        raise ValueError(f"no token ends {word[:depth]!r}")
                last[depth] = token
            known = n - 1  # the last letter ended a word, so its token is not a prefix's
            ids, at = [], n
            while at:
                ids.append(last[at])
                at -= size[last[at]]
            ids.reverse()
            found[word] = array("I", ids).tobytes()
        return found


def shared_prefixes(words: list[str], wide: int = 48) -> list[int]:
    """Length of the prefix each word shares with the word before it."""
    if not words:
        return []
    head = np.array([w[:wide] for w in words], f"U{wide}").view(np.uint32).reshape(len(words), wide)
    differ = head[1:] != head[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), wide)
    out = [0, *np.minimum(shared, [len(w) for w in words[:-1]]).tolist()]
    for k in np.flatnonzero(shared == wide) + 1:  # long words that agree so far
        a, b = words[k - 1], words[k]
        out[k] = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return out


class WordTokenizer:
    """Texts to ids and back for a lower-case word vocabulary file (JSON)."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        self.content = content
        self.trie = TrieBpe(spec["model"]["vocab"], spec["model"]["merges"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = np.empty(1 + max([*self.trie.names, *self.special.values()]), object)
        for i, name in [*self.trie.names.items(), *((i, t) for t, i in self.special.items())]:
            self.names[i] = name
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.chunks: dict[str, bytes] = {}  # stretch without white space -> its ids

    @cached_property
    def library(self):
        """The library's own tokenizer, asked only about unusual texts."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.content.decode())

    def _split(self, text: str) -> tuple[list[str], bool]:
        """Chunks of an ordinary text, and whether they are byte letters already."""
        if _UNUSUAL.search(text) is None:
            return text.lower().split(), False
        normal = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)], True

    def _add(self, chunks: set[str]) -> None:
        """Encode chunks that are not cached, words through tries of bounded size."""
        if len(self.chunks) + len(chunks) > CACHED_CHUNKS:
            self.chunks.clear()
        whole = {c for c in chunks if c.isascii() and c.isalpha()}
        pieces = {c: [p.encode().decode("latin-1").translate(self.letters)
                      for p in _PIECES.findall(c)] for c in chunks - whole}
        words = sorted(whole.union(*pieces.values()))
        ids: dict[str, bytes] = {}
        for k in range(0, len(words), TRIE_WORDS):
            ids.update(self.trie.encode_words(words[k:k + TRIE_WORDS]))
        self.chunks.update((c, ids[c]) for c in whole)
        for chunk, own in pieces.items():
            self.chunks[chunk] = b"".join([ids[w] for w in own])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split, wanted, lettered = [], set(), set()
        for text in texts:
            parts = []
            for k, part in enumerate(self.cut.split(text) if "<|" in text else [text]):
                if k % 2:
                    parts.append(np.array([self.special[part]], "<u4").tobytes())
                elif part:
                    chunks, ready = self._split(part)
                    if ready:
                        lettered.update(chunks)
                    else:
                        wanted.update(chunks)
                    parts.append((chunks, ready))
            split.append(parts)
        wanted = {c for c in wanted if c not in self.chunks}
        if len(self.chunks) + len(wanted) > CACHED_CHUNKS:
            self.chunks.clear()
            wanted = {c for parts in split for p in parts if isinstance(p, tuple) and not p[1]
                      for c in p[0]}
        self._add(wanted)
        rare = self.trie.encode_words(lettered)
        return [b"".join([p if isinstance(p, bytes) else
                          b"".join(map((rare if p[1] else self.chunks).__getitem__, p[0]))
                          for p in parts]) for parts in split]

    def decode(self, ids: bytes) -> str:
        """The vocabulary has no decoder: its tokens joined by spaces."""
        return " ".join(self.names[np.frombuffer(ids, "<u4")])


_READY: dict[int, WordTokenizer] = {}


def _tokenizer(content: bytes) -> WordTokenizer:
    """One tokenizer for each vocabulary in a worker, with its caches."""
    key = hash(content)
    if key not in _READY:
        _READY.clear()
        _READY[key] = WordTokenizer(content)
    return _READY[key]


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``chars`` characters, or of one longer text."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield start, k
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def bpe_encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id",
               text: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids`` (little-endian unsigned
    32-bit integers) and ``decoded``.

    ``vocabulary`` is the path of a word BPE file (JSON) the driver can read; the
    file, of a few MB whatever the data, is broadcast. Special tokens written in
    a text are those tokens. Null and empty texts have no tokens and decode to
    the empty text. Texts of any length are encoded whole; rows are independent,
    so repeated rows each get their result. Other columns are not read. An empty
    table gives an empty result.
    """
    with open(vocabulary, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column), text_of(text).alias("__text"))
    schema = T.StructType([docs.schema[id_column], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.StringType())])

    def run(batches):
        tokenizer = _tokenizer(content.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids = tokenizer.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(x) // 4 for x in ids]),
                     pa.array(ids, pa.binary()), pa.array(map(tokenizer.decode, ids), pa.string())],
                    [id_column, "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(run, schema)


@query("op4_bpe")
def op4(spark, sf_dir):
    import public_tokenizers

    found = bpe_encode(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
