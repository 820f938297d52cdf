"""Phrase counting and collocations against brute force."""

import random
import re
from collections import Counter, defaultdict
from functools import cmp_to_key

import numpy as np
from pyspark.sql import types as T

from ferryline.llm import collocations as c

# Extra columns carry names the operator uses inside.
DOCS = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("phrase", T.StringType()), T.StructField("words", T.IntegerType())])

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(25)] + ["Ü", "\x00", "日本", "x y", "\x1c"]
    out = [(None, "en"), ("", None), (" \t", "en"), ("Wholly new york city. new york city", None)]
    for k in range(300):
        words = [rng.choice(vocabulary[:rng.choice([4, 30])]) for _ in range(rng.randint(1, 60))]
        words[rng.randrange(len(words)):0] = ["New", "York", rng.choice(["City", "city", "x,"])]
        out.append((rng.choice([" ", "  ", "\t"]).join(words) + rng.choice([".", "\r\n", ""]),
                    rng.choice(["en", "en", "de", None])))
    out.append(("alpha beta gamma delta " * 3000, "de"))
    return out + [out[-2]] * 40


def brute_counts(rows):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    f[lang or "und"][tuple(words[i:i + n])] += 1
    return f


def brute_force(rows, top):
    result = []
    for lang, f in brute_counts(rows).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: v for p, v in f.items() if len(p) > 1 and v >= 30}
        found = []
        for p, a in candidates.items():
            if any(100 * v >= 80 * a and len(q) > len(p) and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, v in candidates.items()):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((" ".join(p), a, f[p[:k]], f[p[k:]], n, score))
        found.sort(key=cmp_to_key(lambda x, y: (y[5] - x[5]) or (y[1] - x[1]) or
                                  (1 if x[0].encode() > y[0].encode() else -1)))
        result += [(lang, i + 1, *row) for i, row in enumerate(found[:top])]
    return sorted(result)


def frame(spark, rows):
    return spark.createDataFrame([(t, lang, "z", None) for t, lang in rows], DOCS).repartition(3)


def test_collocations(spark):
    rows = texts()
    # Small budgets: containers burst, subtrees leave, dictionaries start anew.
    for options in (c.CollocationOptions(filter_bits=16),
                    c.CollocationOptions(filter_bits=6, hash_prefixes=4, prefixes=3, burst=4, entries=50, words=20, hashes=30, batch=64,
                                         segment=500, per_lang=7)):
        found = c.collocations(frame(spark, rows), options=options).collect()
        assert sorted(tuple(r) for r in found) == brute_force(rows, options.per_lang)


def test_collocations_of_nothing(spark):
    assert c.collocations(frame(spark, texts()).limit(0)).collect() == []
    assert c.collocations(frame(spark, [(None, "en"), ("", None)])).collect() == []


def test_trie_keeps_what_it_is_given():
    rng = np.random.default_rng(1)
    trie, expected = c.HatTrie(8, 4), Counter()
    given = Counter()

    def leave(keep):
        for first, key, n in zip(*[x.tolist() for x in trie.take(keep)]):
            ids = (first, key >> c._TOP, key >> c.ID_BITS & c._ID, key & c._ID)
            given[tuple(i for i in ids if i)] += n

    for _ in range(20):
        ids = rng.integers(1, 6, (200, 4))
        ends = rng.integers(2, 5, 200)
        ids[np.arange(4) >= ends[:, None]] = 0
        keys = ids[:, 1] << c._TOP | ids[:, 2] << c.ID_BITS | ids[:, 3]
        trie.add(ids[:, 0], keys)
        expected.update(tuple(i for i in row if i) for row in ids.tolist())
        leave(trie.size // 2)
    assert any(type(n) is c.Branch for n in trie.root.values())
    leave(0)
    assert given == expected and trie.size == 0


def test_words_are_counted_at_the_root_and_known_ones_found_together():
    """Single words are entries of no subtree; the filter is asked once for many
    new words; whatever leaves in between, the sums stay."""
    filter_bits, trie, expected = 12, c.HatTrie(8, 4), Counter()
    for ids in (np.array([5, 1, 5, 3]), np.zeros(0, np.int64), np.array([9, 5])):
        trie.add_words(ids)
        expected.update(ids.tolist())
    assert trie.size == 0 and not len(trie.take(1)[0])
    first, keys, counts = trie.take(0)
    assert dict(zip(first.tolist(), counts.tolist())) == expected and not keys.any()
    assert not len(trie.take(0)[0])

    names = [b"w%d" % i for i in range(200)]
    words = c._Words("en", None)
    hashes = np.array([(words[w], words.hashes[-1])[1] for w in names], np.uint64)
    bits = np.zeros((1 << filter_bits) // 8, np.uint8)
    for places in c.Bloom.places(hashes[::2] >> np.uint64(18), np.uint64((1 << filter_bits) - 1)):
        np.bitwise_or.at(bits, places >> np.uint64(3),
                         np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
    known = c.Bloom(bits, 18)
    words, found = c._Words("en", known), []
    for part in (names[:70], names[70:]):
        found.extend(words.kept(np.array([words[w] for w in part])).tolist())
    fits = known.has_all(hashes)
    assert fits[::2].all() and not fits.all()
    assert [i > 0 for i in found] == fits.tolist()
    assert words.kept(np.array([words[c._BREAK]])).tolist() == [0]
