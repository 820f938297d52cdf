"""Phrases whose words stand together more often than their parts would.

Phrases are counted length by length. A task counts in a HAT-trie: below a
shallow trie of word ids lie hash containers, which burst into a trie node once
they hold too much. When the trie outgrows the task's budget, its largest
subtrees leave it whole, as sorted runs. A run is cut by prefix (a hash of the
first two words, so that a word which stands before very many others is merged by
many tasks), and the runs of a prefix partition are merged into sums.

A phrase cannot be frequent if a part of it is not, and most phrases of a corpus
are rare. Before phrases are counted, three passes add up hashes alone: of words,
of pairs of words that may be frequent, and of longer phrases all whose pairs may
be. What reaches the threshold is told to the next pass by a Bloom filter of fixed
size. Hashes that meet and bits that are set by chance let a rare phrase through;
it is then counted as it is, and falls to the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.joins import keyed_join

from .shared import query, stage, table, text_of

#: An id takes 21 bits, so the three words after the first fit in one key.
ID_BITS = 21
_ID = (1 << ID_BITS) - 1
_TOP = 2 * ID_BITS

#: Marks the end of a piece among words; no UTF-8 text holds this byte.
_BREAK = b"\xff"
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TO_LINES = bytes.maketrans(_SEPARATORS, b"\n" * len(_SEPARATORS))


@dataclass(frozen=True)
class CollocationOptions:
    """What counts as a phrase, and what a task may hold."""

    min_count: int = 30
    per_lang: int = 2000
    inside_percent: int = 80
    longest: int = 4
    filter_bits: int = 26       # of a Bloom filter, as a power of two: 8 MB
    hash_prefixes: int = 14     # partitions of hashes, as a power of two
    burst: int = 4096           # entries of a container that bursts
    prefixes: int = 12          # prefix partitions, as a power of two
    entries: int = 800_000      # of all tries of a task, before subtrees leave
    words: int = 250_000        # of a task's dictionaries, before they start anew
    hashes: int = 1 << 19       # of phrases that a task adds up at a time
    batch: int = 1 << 18        # words that are entered together
    segment: int = 1 << 20      # bytes of a text that are split at a time


class Container(dict):
    """Counts by the packed ids of the words that follow."""


class Branch(dict):
    """Trie node: next word's id (0: the phrase ends here) -> Container or Branch."""


class HatTrie:
    """Counts of phrases as word ids; keys hold the ids after the first, the next
    one uppermost, zero where the phrase has ended."""

    def __init__(self, burst: int, longest: int):
        self.root, self.burst, self.longest, self.size = Branch(), burst, longest, 0
        self.sizes: dict[int, int] = {}
        self.ends = np.zeros(0, np.int64)

    def add_words(self, ids: np.ndarray) -> None:
        """Phrases of one word end at the root, which counts them in an array by id."""
        times = np.bincount(ids, minlength=len(self.ends))
        times[:len(self.ends)] += self.ends
        self.ends = times

    def add(self, first: np.ndarray, keys: np.ndarray) -> None:
        if not len(first):
            return
        order = np.lexsort((keys, first))
        first, keys = first[order], keys[order]
        new = np.r_[True, (first[1:] != first[:-1]) | (keys[1:] != keys[:-1])]
        at = np.flatnonzero(new)
        counts = np.diff(np.r_[at, len(first)])
        first, keys = first[at], keys[at].tolist()
        starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]).tolist()
        counts = counts.tolist()
        for a, b in zip(starts, [*starts[1:], len(keys)]):
            before, word = self.size, int(first[a])
            self._add(self.root, word, keys[a:b], counts[a:b], 1)
            self.sizes[word] = self.sizes.get(word, 0) + self.size - before

    def _add(self, parent: Branch, word: int, keys: list[int], counts: list[int],
             depth: int) -> None:
        node = parent.get(word)
        if node is None:
            node = parent[word] = Container()
        if type(node) is Branch:
            a = 0
            while a < len(keys):  # keys are sorted: those of one next word stand together
                b, nxt = a + 1, keys[a] >> _TOP
                while b < len(keys) and keys[b] >> _TOP == nxt:
                    b += 1
                self._add(node, nxt, [(k << ID_BITS) & ((1 << 3 * ID_BITS) - 1)
                                      for k in keys[a:b]], counts[a:b], depth + 1)
                a = b
            return
        before, get = len(node), node.get
        for k, n in zip(keys, counts):
            node[k] = get(k, 0) + n
        self.size += len(node) - before
        if len(node) > self.burst and self.longest - depth > 1:  # else one word is left
            parent[word] = self._burst(node)

    @staticmethod
    def _burst(full: Container) -> Branch:
        branch = Branch()
        for key, n in full.items():
            child = branch.setdefault(key >> _TOP, Container())
            child[(key << ID_BITS) & ((1 << 3 * ID_BITS) - 1)] = n
        return branch

    def _gather(self, node: dict, keys: list[int], counts: list[int]) -> None:
        if type(node) is Branch:
            for word, child in node.items():
                below: list[int] = []
                self._gather(child, below, counts)
                keys.extend([word << _TOP | k >> ID_BITS for k in below])
        else:
            keys.extend(node.keys())
            counts.extend(node.values())

    def take(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Removes the largest subtrees until ``keep`` entries are left: the first
        ids, keys and counts they held. With none left, the root's own counts go too."""
        words, lengths, keys, counts = [], [], [], []
        if not keep:
            words = np.flatnonzero(self.ends).tolist()
            lengths, keys, counts = [1] * len(words), [0] * len(words), self.ends[words].tolist()
            self.ends = np.zeros(0, np.int64)
        for word in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.size <= keep:
                break
            before = len(keys)
            self._gather(self.root.pop(word), keys, counts)
            words.append(word)
            lengths.append(len(keys) - before)
            self.size -= self.sizes.pop(word)
        return (np.repeat(np.array(words, np.int64), np.array(lengths, np.int64)),
                np.array(keys, np.int64), np.array(counts, np.int64))


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 42)


def _pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two word hashes each; wraps at 64 bits."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_ODD = 0xD6E8FEB86659FD93


class Bloom:
    """Bits of fixed number; three places per hash, of which the upper bits count
    that are left after dropping ``drop``."""

    def __init__(self, bits: np.ndarray, drop: int):
        self.bits, self.drop, self.mask = bits, drop, np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def places(short: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
        x = (short + np.uint64(1)) * np.uint64(_ODD)
        x ^= x >> np.uint64(32)
        step = (x >> np.uint64(40)) | np.uint64(1)
        return [(x + np.uint64(i) * step) & mask for i in range(3)]

    def has_all(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for p in self.places(h >> np.uint64(self.drop), self.mask):
            found &= (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1) > 0
        return found


_BITS = T.StructType([T.StructField("at", T.LongType()), T.StructField("bits", T.LongType())])


def bloom_filter(hashes: DataFrame, options: CollocationOptions) -> Bloom:
    """A filter of the shortened hashes ``h``, set by many tasks; 2 ** ``filter_bits``
    bits reach the driver, however many hashes there are."""
    size = 1 << options.filter_bits

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            bits_at = np.concatenate(Bloom.places(h, np.uint64(size - 1)))
            places, which = np.unique(bits_at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(places), np.uint64)
            np.bitwise_or.at(bits, which, np.uint64(1) << (bits_at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places.astype(np.int64)), pa.array(bits.view(np.int64))], _BITS.names)

    found = (hashes.select("h").mapInArrow(run, _BITS)
             .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    bits = np.zeros(size // 64, np.int64)
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    return Bloom(bits.view(np.uint8), 32 - options.hash_prefixes)


class _Words(dict):
    """Word -> id; breaks have 0. Which words the filter knows is found out for all
    new ones together."""

    def __init__(self, lang: str, known: Bloom | None):
        super().__init__({_BREAK: 0})
        self.seed, self.known = lang_seed(lang), known
        self.names, self.hashes = [b""], [0]
        self._hashed, self._kept = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def hashed(self) -> np.ndarray:
        """The words' hashes by id; new ones are taken over from the list."""
        if len(self._hashed) < len(self.hashes):
            new = np.array(self.hashes[len(self._hashed):], np.uint64)
            own = np.arange(len(self._hashed), len(self.hashes))
            if self.known is not None:
                own[~self.known.has_all(new)] = 0
            self._hashed = np.concatenate([self._hashed, new])
            self._kept = np.concatenate([self._kept, own])
        return self._hashed

    def kept(self, ids: np.ndarray) -> np.ndarray:
        """The ids, 0 for words that the filter does not know."""
        self.hashed()
        return self._kept[ids]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return n


class _LangText:
    """One language's dictionary and the words that wait to be gone through.
    ``filters``: of words, of pairs, of longer phrases; None before they are known."""

    def __init__(self, lang: str, filters: list[Bloom | None], options: CollocationOptions):
        self.lang, self.options, self.filters = lang, options, filters
        self.words, self.total = _Words(lang, filters[0]), 0
        self.waiting, self.n_waiting = [], 0
        self.start()

    def text(self, raw: bytes) -> Iterator[None]:
        """Takes in a text; pauses after each segment."""
        step, a = self.options.segment, 0
        while a < len(raw):
            b = len(raw) if len(raw) - a <= step else raw.rfind(b" ", a, a + step) + 1
            if b <= a:  # a word longer than the step
                b = raw.find(b" ", a) + 1 or len(raw)
            lines = raw[a:b].lower().translate(_TO_LINES)
            split = lines.replace(b"\n", b" \xff ").split()
            self.total += len(split) - lines.count(b"\n")
            self._wait(np.fromiter(map(self.words.__getitem__, split), np.int64, len(split)))
            a = b
            yield
        self._wait(np.zeros(3, np.int64))

    def _wait(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting > self.options.batch:
            self.enter()

    def enter(self) -> None:
        """Goes through the phrases that start before the last three waiting words."""
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.int64)
        self.waiting, self.n_waiting = [ids[-3:]], len(ids[-3:])
        if len(ids) > 3:
            self.phrases(self.words.kept(ids))

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, starts and hashes of the phrases that the filters do not rule out."""
        n = len(ids) - 3
        h = self.words.hashed()[ids]
        at = np.flatnonzero(ids[:n] > 0)
        yield 1, at, h[at]
        _, pairs, longer = self.filters
        whole = (ids[:-1] > 0) & (ids[1:] > 0)
        start = np.flatnonzero(whole)
        hashes = _pair_hashes(h[start], h[start + 1])
        if pairs is not None:
            fits = pairs.has_all(hashes)
            whole[start[~fits]] = False
            start, hashes = start[fits], hashes[fits]
        inside = start < n
        start, hashes = start[inside], hashes[inside]
        yield 2, start, hashes
        for size in range(3, self.options.longest + 1) if pairs is not None else ():
            fits = whole[start + size - 2]
            start, hashes = start[fits], _pair_hashes(hashes[fits], h[start[fits] + size - 1])
            if longer is not None:
                fits = longer.has_all(hashes)
                start, hashes = start[fits], hashes[fits]
            yield size, start, hashes

    def start_anew(self) -> Iterator[pa.RecordBatch]:
        """Everything leaves, and the dictionary with it; the last three words stay."""
        self.enter()
        yield from self.leave(0)
        names = self.words.names
        last = [names[i] for ids in self.waiting for i in ids.tolist()]
        self.words = _Words(self.lang, self.filters[0])
        self.waiting = [np.array([self.words[w] if w else 0 for w in last], np.int64)]


HASHES = T.StructType([
    T.StructField("prefix", T.IntegerType()), T.StructField("low", T.BinaryType()),
    T.StructField("counts", T.BinaryType())])


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between each two bounds, as one binary value each."""
    offsets = pa.array((bounds * values.itemsize).astype(np.int32)).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


class _Hashes(_LangText):
    """Adds up the hashes of the phrases of one level: words, pairs or longer ones,
    whichever the filters do not know yet. Of a hash the upper bits are kept: a
    prefix, which names its partition, and 32 more."""

    schema = HASHES

    def start(self) -> None:
        self.level = [f is not None for f in self.filters].index(False)
        self.held, self.size = [], 0

    def phrases(self, ids: np.ndarray) -> None:
        if not self.level:  # words are counted by id
            self._count(ids[:-3])
            return
        for size, _, hashes in self.candidates(ids):
            if min(size, 3) == self.level + 1:
                self.held.append(hashes)
                self.size += len(hashes)

    def _count(self, ids: np.ndarray) -> None:
        times = np.bincount(ids)
        times[:1] = 0
        which = np.flatnonzero(times)
        self.held.append((self.words.hashed()[which], times[which]))
        self.size += len(which)

    def _added(self) -> tuple[np.ndarray, np.ndarray]:
        """The shortened hashes held and how often each stood there."""
        drop = np.uint64(32 - self.options.hash_prefixes)
        if self.level:
            return np.unique(np.concatenate(self.held) >> drop, return_counts=True)
        short, at = np.unique(np.concatenate([h for h, _ in self.held]) >> drop,
                              return_inverse=True)
        return short, np.bincount(at, np.concatenate([n for _, n in self.held]), len(short))

    @staticmethod
    def full(size: int, options: CollocationOptions) -> bool:
        return size > options.hashes

    def leave(self, keep: int) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        short, n = self._added()
        self.held, self.size = [], 0
        prefix = (short >> np.uint64(32)).astype(np.int32)
        starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        bounds = np.append(starts, len(prefix))
        counts = np.minimum(n, self.options.min_count).astype(_count_type(self.options))
        yield pa.RecordBatch.from_arrays(
            [pa.array(prefix[starts]), _packed(short.astype(np.uint32), bounds),
             _packed(counts, bounds)], HASHES.names)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.leave(0)


def _count_type(options: CollocationOptions):
    return np.uint8 if options.min_count < 256 else np.uint32


#: Hashes of one prefix that are held before equal ones are added up.
_HELD = 1 << 19


def _often(options: CollocationOptions):
    """The shortened hashes that reach ``min_count``; those of a prefix come one
    after another."""
    kind = _count_type(options)

    def added(low: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
        values, at = np.unique(np.concatenate(low), return_inverse=True)
        sums = np.bincount(at, np.concatenate(counts), len(values))
        return values, np.minimum(sums, options.min_count)

    def run(batches):
        place, low, counts, held = None, [], [], 0

        def done():
            values, sums = added(low, counts)
            often = values[sums >= options.min_count].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(often | place << 32, pa.int64())], ["h"])

        for batch in batches:
            for prefix, more, n in zip(*batch.columns):
                if prefix.as_py() != place:
                    if place is not None:
                        yield done()
                    place, low, counts, held = prefix.as_py(), [], [], 0
                low.append(np.frombuffer(more.as_buffer(), np.uint32))
                counts.append(np.frombuffer(n.as_buffer(), kind))
                held += len(low[-1])
                if held > _HELD:
                    values, sums = added(low, counts)
                    low, counts, held = [values], [sums], 0
        if place is not None:
            yield done()

    return run


RUNS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("prefix", T.IntegerType()),
    T.StructField("phrases", T.BinaryType()), T.StructField("counts", T.ArrayType(T.LongType()))])


class _Counts(_LangText):
    """Counts the phrases that no filter rules out in a HAT-trie."""

    schema = RUNS

    def start(self) -> None:
        self.trie = HatTrie(self.options.burst, self.options.longest)

    @property
    def size(self) -> int:
        return self.trie.size

    @staticmethod
    def full(size: int, options: CollocationOptions) -> bool:
        return size > options.entries

    def phrases(self, ids: np.ndarray) -> None:
        first, keys = [], []
        for size, start, _ in self.candidates(ids):
            if size == 1:
                self.trie.add_words(ids[start])
                continue
            key = np.zeros(len(start), np.int64)
            for k in range(1, size):
                key |= ids[start + k] << (_TOP - (k - 1) * ID_BITS)
            first.append(ids[start])
            keys.append(key)
        self.trie.add(np.concatenate(first), np.concatenate(keys))

    def leave(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Subtrees that leave: a run per prefix, in the order of its words. No word
        holds a line end, so line ends part the phrases of a run."""
        first, keys, counts = self.trie.take(keep)
        if not len(first):
            return
        names, h = self.words.names, self.words.hashed()
        rank = np.zeros(len(names), np.int64)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        ids = [first, keys >> _TOP, keys >> ID_BITS & _ID, keys & _ID]
        prefix = (_pair_hashes(h[ids[0]], h[ids[1]])
                  >> np.uint64(64 - self.options.prefixes)).astype(np.int32)
        order = np.lexsort([*[rank[i] for i in reversed(ids)], prefix])
        words, prefix = pa.array([None, *names[1:]], pa.binary()), prefix[order]
        starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        bounds = np.append(starts, len(order))
        for a in range(0, len(starts), 512):
            own = bounds[a:a + 513]
            at = order[own[0]:own[-1]]
            parts = [words.take(pa.array(i[at])) for i in ids]
            phrases = pc.binary_join_element_wise(*parts, b" ", null_handling="skip")
            offsets = pa.array(own - own[0], pa.int32())
            yield self._rows(
                prefix[own[:-1]],
                pc.binary_join(pa.ListArray.from_arrays(offsets, phrases), b"\n"),
                pa.ListArray.from_arrays(offsets, pa.array(counts[at], pa.int64())))

    def _rows(self, prefix, phrases: pa.Array, counts: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([self.lang] * len(phrases)), pa.array(prefix, pa.int32()), phrases, counts],
            RUNS.names)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.leave(0)
        yield self._rows([-1], pa.array([None], pa.binary()),
                         pa.array([[self.total]], pa.list_(pa.int64())))


FOUND = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.BinaryType()),
                      T.StructField("f", T.LongType())])


def _merged(min_count: int):
    """The runs of each prefix partition, which come one after another, as sums;
    a null phrase stands for the number of words."""
    def rows(lang: str, sums: dict[bytes | None, int]) -> pa.RecordBatch:
        kept = [(p, n) for p, n in sums.items() if n >= min_count or p is None]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(kept), pa.string()), pa.array([p for p, _ in kept], pa.binary()),
             pa.array([n for _, n in kept], pa.int64())], FOUND.names)

    def run(batches):
        place, sums = None, {}
        for batch in batches:
            for lang, prefix, phrases, counts in zip(*[batch.column(c) for c in RUNS.names]):
                here = (lang.as_py(), prefix.as_py())
                if here != place:
                    if place is not None:
                        yield rows(place[0], sums)
                    place, sums = here, {}
                raw = phrases.as_py()
                for phrase, n in zip([None] if raw is None else raw.split(b"\n"),
                                     counts.values.to_pylist()):
                    sums[phrase] = sums.get(phrase, 0) + n
        if place is not None:
            yield rows(place[0], sums)

    return run


def _gone_through(texts: DataFrame, kind: type[_LangText], filters: list[Bloom | None],
                  options: CollocationOptions) -> DataFrame:
    """What ``kind`` emits over all of ``lang, text``."""
    share = texts.sparkSession.sparkContext.broadcast
    shared = [f and share(f) for f in filters]

    def run(batches):
        known = [f and f.value for f in shared]
        by_lang: dict[str, _LangText] = {}
        for batch in batches:
            for lang, raw in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                if lang not in by_lang:
                    by_lang[lang] = kind(lang, known, options)
                for _ in by_lang[lang].text(raw.as_py()):
                    if sum(len(c.words) for c in by_lang.values()) > options.words:
                        yield from max(by_lang.values(), key=lambda c: len(c.words)).start_anew()
                    if kind.full(sum(c.size for c in by_lang.values()), options):
                        largest = max(by_lang.values(), key=lambda c: c.size)
                        yield from largest.leave(largest.size // 2)
        for own in by_lang.values():
            own.enter()
            yield from own.end()

    return texts.mapInArrow(run, kind.schema)


def likely(texts: DataFrame, filters: list[Bloom | None], options: CollocationOptions) -> Bloom:
    """The filter of the next level: hashes that stand in ``min_count`` places."""
    found = _gone_through(texts, _Hashes, filters, options)
    return bloom_filter(found.repartition("prefix").sortWithinPartitions("prefix")
                        .mapInArrow(_often(options), "h long"), options)


def frequent_phrases(docs: DataFrame, lang: str, text: str,
                     options: CollocationOptions) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, f`` of all phrases in ``min_count`` places or more, and
    ``lang, n``: the number of words of each language."""
    if options.longest not in (2, 3, 4):
        raise ValueError("phrases have 2 to 4 words")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                        text_of(text).cast("binary").alias("text"))
    filters: list[Bloom | None] = [None, None, None]
    for level in range(min(options.longest, 3)):
        filters[level] = likely(texts, filters, options)
    runs = _gone_through(texts, _Counts, filters, options)
    found = stage(runs.repartition("prefix").sortWithinPartitions("prefix", "lang")
                  .mapInArrow(_merged(options.min_count), FOUND), "llm-frequent")
    phrases = found.where("phrase IS NOT NULL").select(
        "lang", F.col("phrase").cast("string").alias("phrase"), "f")
    return (phrases.withColumn("size", F.size(F.split("phrase", " "))),
            found.where("phrase IS NULL").select("lang", F.col("f").alias("n")))


def _part(start, n) -> F.Column:
    return F.array_join(F.slice("words", start, n), " ")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text",
                 options: CollocationOptions | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases.

    Null or empty text has no words, null language is ``und``; repeated rows count
    each time; other columns are not read; an empty table gives an empty result.
    Texts of any length are split piece by piece. Ties of score and count go by
    the phrase's bytes. Scores are decimals of 38 digits divided to whole numbers.
    """
    options = options or CollocationOptions()
    frequent, totals = frequent_phrases(docs, lang, text, options)
    phrases = frequent.where("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    counts = frequent.select("lang", "phrase", "f")

    def joined(df: DataFrame, key: str, name: str) -> DataFrame:
        part = counts.select("lang", F.col("phrase").alias(key), F.col("f").alias(name))
        return keyed_join(df, part, ["lang", key], "inner")

    cuts = phrases.select("lang", "phrase", "a", "words", "size", F.explode(
        F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"),
                       _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    score = F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) div "
                   "(CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    scored = (joined(joined(cuts, "left", "l"), "right", "r")
              .groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))
    inner = phrases.where("size > 2").select("lang", F.col("a").alias("f"), "words", "size", F.explode(
        F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = inner.select("lang", "f", "words", "m", F.explode(
        F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    most = (inner.select("lang", "f", _part(F.col("at"), F.col("m")).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("f").alias("outer")))
    wide = "CAST({} AS DECIMAL(19, 0)) * {}"
    left = keyed_join(scored, most, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | F.expr(
            f"{wide.format('outer', 100)} < {wide.format('a', options.inside_percent)}"))
    best = Window.partitionBy("lang").orderBy(
        F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = (left.withColumn("rank", F.row_number().over(best).cast("long"))
              .where(F.col("rank") <= options.per_lang))
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


_GRAMS = " UNION ALL ".join(
    f"SELECT lang, array_to_string(w[i : i + {m - 1}], ' ') AS phrase, {m} AS size "
    f"FROM pieces, unnest(range(1, len(w) - {m - 2})) AS t(i) WHERE len(w) >= {m}"
    for m in (1, 2, 3, 4))

OP13_SQL = f"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents)),
grams AS ({_GRAMS}),
f AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w
  FROM f WHERE size > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
         CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS score
  FROM candidates c, unnest(range(1, size)) AS t(k)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
scored AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS outer_a
  FROM candidates, unnest(range(2, size)) AS t(m), unnest(range(1, size - m + 2)) AS u(i)
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase)
  WHERE outer_a IS NULL OR CAST(100 AS HUGEINT) * outer_a < CAST(80 AS HUGEINT) * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query("op13_collocations", OP13_SQL)
def op13(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
