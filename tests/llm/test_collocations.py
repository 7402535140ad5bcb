"""Collocations: the index and the query against counting by hand."""
import collections
import re

import numpy as np
import pytest

from featurejudge.llm import collocations, queries
from featurejudge.llm.common import load

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, limit, depth=5, top=2_000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, depth + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, grams in f.items():
        often = {g: c for g, c in grams.items() if len(g) > 1 and c >= limit}
        gone = {q[i:i + m] for q, c in often.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if 100 * c >= 100 * grams[q[i:i + m]]}
        scored = []
        for g, a in often.items():
            if g not in gone:
                score, _, left, right = min((1000 * a * n[lang] // (grams[g[:k]] * grams[g[k:]]), k, grams[g[:k]], grams[g[k:]])
                                            for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("size,symbols", [(1, 1), (2, 1), (3, 2), (60, 3), (3_000, 4), (3_000, 40)])
@pytest.mark.parametrize("depth", [2, 3, 5, 7])
def test_index_lists_every_ngram_once(size, symbols, depth):
    text = np.random.default_rng(size).integers(0, symbols, size).astype(np.int32)
    text[0] = text[-1] = 0
    got = [(tuple(g), c) for grams, numbers in collocations.Index(text, depth).ngrams() for g, c in zip(grams.tolist(), numbers.tolist())]
    want = collections.Counter(tuple(text[i:i + k].tolist()) for k in range(2, depth + 1) for i in range(size - k + 1) if (text[i:i + k] > 0).all())
    assert len(got) == len(want) and dict(got) == want


def test_halves_agree():
    """Intervals are those of a plain search, and extensions of both sides count what stands there."""
    text = np.random.default_rng(7).integers(0, 5, 800).astype(np.int32)
    text[0] = text[-1] = 0
    index = collocations.Index(text, 4)
    tuples = [tuple(np.append(text[p:p + 4], np.zeros(4, np.int32))[:4].tolist()) for p in index.forward.order]
    assert tuples == sorted(tuples)
    numbers = np.bincount(text)
    c = np.cumsum(numbers) - numbers
    words = np.arange(1, 5)
    by, symbol, ahead, back, size = index.forward.extend(c[words], c[words], numbers[words])
    for o, s, lo, other, n in zip(by, symbol, ahead, back, size):
        assert [t[:2] for t in tuples].index((s, words[o])) == lo and [t[:2] for t in tuples].count((s, words[o])) == n
        mirrored = sorted(tuple(np.append(text[::-1][p:p + 4], np.zeros(4, np.int32))[:2].tolist()) for p in range(800))
        assert mirrored.index((words[o], s)) == other


@pytest.mark.parametrize("bits,shard_words", [(24, 1_500_000), (12, 700), (4, 5_000)])
def test_any_table_and_shard_size(spark, bits, shard_words):
    """A crowded table of counters and many shards change nothing."""
    docs = load(spark, SF, "documents", "text", "lang").where("doc_id % 4 = 1").repartition(3)
    want = by_hand([(r["lang"], r["text"]) for r in docs.collect()], 12)
    assert len(want) > 50
    assert rows_of(collocations.phrases(docs, 12, bits=bits, shard_words=shard_words)) == want


def test_given_documents(spark):
    docs = load(spark, SF, "documents", "text", "lang")
    want = by_hand([(r["lang"], r["text"]) for r in docs.collect()], 100)
    assert rows_of(queries.QUERIES["op13_collocations"](spark, SF)) == want


def test_odd_rows(spark, odd_docs):
    extra = spark.createDataFrame([("a\tb  a b.a b,a B\na b c;c c c c c c", None), ("É é a\x85b a\x85b \U0001F600 x \U0001F600 x", "und"), ("x" * 100_000, "en")],
                                  "text string, lang string")
    frame = odd_docs.select("text", "lang", "score", "words", "label").unionByName(extra, allowMissingColumns=True)
    want = by_hand([(r["lang"], r["text"]) for r in frame.collect()], 2, top=7)
    assert rows_of(collocations.phrases(frame, 2, top=7)) == want
    assert collocations.phrases(frame.where("false")).count() == 0
    assert collocations.phrases(frame.where("text = ''"), 1).count() == 0


def test_products_beyond_64_bits(spark):
    """Scores of counts of whole corpora, as the query computes them."""
    row = spark.range(1).selectExpr("cast(4000000000000 as long) a", "cast(90000000000000 as long) n", "cast(4000000000001 as long) l", "cast(5000000000003 as long) r")
    got = row.select(collocations.score_column().alias("s")).first()["s"]
    assert got == 1000 * 4_000_000_000_000 * 90_000_000_000_000 // (4_000_000_000_001 * 5_000_000_000_003)
