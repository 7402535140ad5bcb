"""Collocations by FM-indexes over word ids (operator 13).

Tasks read documents into shards, one a language and about ``SHARD_WORDS``
words.  Three passes over the text:

1. ``sketch``: counts of words and word pairs, hashed into one fixed table of
   counters that stop at the least count asked for.  A counter is never below
   the count of what falls into it, so whatever lies in a counter under the
   limit is surely too rare.  Nothing else is decided by it: at any table size
   the result is the same, only more n-grams travel if the table is crowded
   (beyond about ``limit * 2**SKETCH_BITS`` words; at worst one row an n-gram
   length and word).
2. The same for runs of three words whose pairs may be frequent.
3. ``counts``: of what is left each shard builds a bidirectional FM-index
   (``Index``), enumerates its n-grams of up to ``DEPTH`` words by interval
   extension, to the right and to the left in turn, and returns them with
   their counts, packed into a row a hash bucket.  The counts are summed over
   the shards, exactly, by tasks that each hold some buckets.

``phrases`` scores them.  An extension of a phrase by one word to the left or
right is itself an n-gram, so the extensions' counts over all shards come from
the same table.

Nulls: a null text has no words, a null language is ``und``; ids are not used.
Repeated rows count as often as they come.  Texts of any length are read whole.
Ties in rank are told apart by phrase.  An empty table gives an empty table.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurejudge.llm.common import cut_lineage

DEPTH = 5                 # words of the longest phrase
MIN_COUNT = 100
TOP = 2_000               # phrases a language
DROP_PERCENT = 100        # a phrase goes if a longer one has this share of its count
SHARD_WORDS = 1_500_000   # words after which a task closes its shards
SKETCH_BITS = 24
BLOCK = 4_096             # counters that travel in a row
ROWS = 50_000             # rows of an Arrow batch
SALTS = 16                # tasks among which a language's ranking is split
UNKNOWN = "und"

_CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A-Z lower-cased, every cut a full stop, tab a space; bytes of longer UTF-8 characters are above 0x7F.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _CUTS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + b"." * len(_CUTS) + b" ")


class Shard:
    """Words of one language as ids; 0 stands between pieces and documents."""

    def __init__(self):
        self.ids: dict[bytes, int] = defaultdict(count().__next__)
        self.ids[b"."]
        self.parts: list[np.ndarray] = [np.zeros(1, np.int32)]

    def add(self, text: str) -> int:
        tokens = text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(b".", b" . ").split()
        self.parts.append(np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens)))
        self.parts.append(self.parts[0])
        return len(tokens)

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the whole shard, words by id)."""
        return np.concatenate(self.parts), np.array(list(self.ids), object)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(language, ids, words) of the shards of a task; columns are language and text."""
    shards: dict[str, Shard] = defaultdict(Shard)
    held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held += shards[lang].add(text)
                if held >= size:
                    for name, shard in shards.items():
                        yield (name, *shard.close())
                    shards, held = defaultdict(Shard), 0
    for name, shard in shards.items():
        yield (name, *shard.close())


def _word_hashes(lang: str, words: np.ndarray) -> np.ndarray:
    seed = zlib.crc32(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _slots(hashes: np.ndarray, symbols: np.ndarray, bits: int) -> np.ndarray:
    """Counter of each n-gram (rows of word ids), alike in all shards."""
    mixed = np.zeros(len(symbols), np.uint64)
    for column in symbols.T:
        mixed = (mixed ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype(np.int64)


def _runs(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n words from each place on, as rows."""
    return ids[at[:, None] + np.arange(n)]


def _counter_type(limit: int) -> type:
    return np.uint8 if limit < 2 ** 8 else np.uint32


def _add(table: np.ndarray, slots: np.ndarray, numbers: np.ndarray, limit: int) -> None:
    """Adds to distinct slots; counters stop at ``limit``."""
    table[slots] = np.minimum(table[slots].astype(np.int64) + numbers, limit)


def _by_slot(slots: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(slots, kind="stable")
    slots, numbers = slots[order], numbers[order]
    first = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1]))) if len(slots) else np.empty(0, np.int64)
    return slots[first], np.add.reduceat(numbers, first) if len(first) else numbers


def sketch(texts: DataFrame, limit: int, bits: int, shard_words: int, pairs=None) -> bytes:
    """Counters of all words and word pairs of (lang, text); with ``pairs`` (a
    broadcast table of those) counters of the runs of three words whose pairs
    may be frequent.  Every task sends its blocks that are not zero; the sums
    are ``2**bits`` counters."""
    kind = _counter_type(limit)

    def run(batches):
        table = np.zeros(1 << bits, kind)

        def count_runs(hashes, ids, at, n):
            slots = _slots(hashes, _runs(ids, at, n), bits)
            _add(table, *_by_slot(slots, np.ones(len(slots), np.int64)), limit)
        for lang, ids, words in _shards(batches, shard_words):
            hashes = _word_hashes(lang, words)
            if pairs is None:
                numbers = np.bincount(ids, minlength=len(words))[1:]
                _add(table, *_by_slot(_slots(hashes, np.arange(1, len(words))[:, None], bits), numbers), limit)
                count_runs(hashes, ids, np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0)), 2)
            else:
                _, at = _alive_pairs(ids, hashes, np.frombuffer(pairs.value, kind), limit, bits)
                count_runs(hashes, ids, at[:-1][at[1:] == at[:-1] + 1], 3)
        blocks = table.reshape(-1, min(BLOCK, 1 << bits))
        some = np.flatnonzero(blocks.any(axis=1))
        for at in range(0, len(some), 1_000):
            part = some[at:at + 1_000]
            yield pa.record_batch([pa.array(part, pa.int32()), pa.array([blocks[b].tobytes() for b in part], pa.binary())],
                                  names=["block", "counters"])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counters in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(counters, kind).astype(np.int64)
                held[block] = np.minimum(held[block] + more, limit).astype(kind) if block in held else more.astype(kind)
        if held:
            yield pa.record_batch([pa.array(list(held), pa.int32()), pa.array([c.tobytes() for c in held.values()], pa.binary())],
                                  names=["block", "counters"])
    schema = "block int, counters binary"
    width = min(BLOCK, 1 << bits)
    table = np.zeros(((1 << bits) // width, width), kind)
    # bounded: 2**bits counters in all
    for row in texts.mapInArrow(run, schema).repartition("block").mapInArrow(merge, schema).toLocalIterator():
        table[row["block"]] = np.frombuffer(row["counters"], kind)
    return table.tobytes()


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 0 of an array's values, equal ones alike."""
    order = np.argsort(key, kind="stable")
    there = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(there[1:] != there[:-1]))) if len(key) else there
    return rank


def suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a text sorted by their next ``depth`` symbols (0 beyond the
    end), ties by position: prefix doubling, then the rest."""
    def then(rank: np.ndarray, more: np.ndarray, by: int) -> np.ndarray:
        ahead = np.zeros(len(text), np.int64)
        ahead[:max(len(text) - by, 0)] = more[by:] + 1
        return rank * (int(ahead.max(initial=0)) + 1) + ahead
    ranks, width = {1: text.astype(np.int64)}, 1
    while 2 * width <= depth:
        ranks[2 * width] = _dense(then(ranks[width], ranks[width], width))
        width *= 2
    key, done = ranks[width], width
    while done < depth:
        width = max(w for w in ranks if w <= depth - done)
        key, done = _dense(then(key, ranks[width], done)), done + width
    return np.argsort(key, kind="stable")


class Half:
    """BWT of one reading direction, ordered by ``depth`` symbols: enough for
    patterns of that length."""

    def __init__(self, text: np.ndarray, depth: int):
        self.order = suffixes(text, depth)
        self.bwt = text[self.order - 1]                   # before position 0 stands the last symbol, a 0
        self.to_first = np.empty(len(text), np.int64)     # LF: C[symbol] + occurrences before
        self.to_first[np.argsort(self.bwt, kind="stable")] = np.arange(len(text))

    def extend(self, here: np.ndarray, there: np.ndarray, size: np.ndarray):
        """All extensions of the intervals by a symbol other than 0: (owner,
        symbol, interval in this half, interval in the other half, size)."""
        owner = np.repeat(np.arange(len(here)), size)
        starts = np.cumsum(size) - size
        at = np.arange(len(owner)) - np.repeat(starts - here, size)
        symbol = self.bwt[at].astype(np.int64)
        order = np.argsort(owner * (int(symbol.max(initial=0)) + 1) + symbol, kind="stable")
        by, what = owner[order], symbol[order]
        first = np.flatnonzero(np.concatenate(([True], (by[1:] != by[:-1]) | (what[1:] != what[:-1])))) if len(by) else np.empty(0, np.int64)
        number = np.diff(np.append(first, len(by)))
        by, what = by[first], what[first]
        # in the other half the extensions of an interval lie in the order of their symbols
        other = there[by] + first - starts[by]
        real = what > 0
        return by[real], what[real], self.to_first[at[order[first]]][real], other[real], number[real]


class Index:
    """Bidirectional FM-index of a text of symbols from 0 (a break; first and
    last symbol of the text): two halves with synchronised intervals."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth
        self.forward = Half(text, depth)                  # its BWT holds what stands before: extensions to the left
        self.backward = Half(text[::-1], depth)           # extensions to the right

    def ngrams(self, may=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 2, 3 ... words: (symbols of each n-gram, counts), each n-gram
        once.  ``may``: of n-grams (rows of symbols), which are of interest;
        others are neither listed nor extended."""
        numbers = np.bincount(self.text)
        c = np.cumsum(numbers) - numbers
        there = np.flatnonzero(numbers[1:]) + 1
        ahead, back, size = c[there], c[there], numbers[there]
        for n in range(2, self.depth + 1):
            if n % 2 == 0:
                _, _, back, ahead, size = self.backward.extend(back, ahead, size)
            else:
                _, _, ahead, back, size = self.forward.extend(ahead, back, size)
            symbols = self.text[self.forward.order[ahead][:, None] + np.arange(n)]
            if may is not None:
                ok = may(symbols)
                symbols, ahead, back, size = symbols[ok], ahead[ok], back[ok], size[ok]
            if not len(size):
                return
            yield symbols, size


def _alive_pairs(ids: np.ndarray, hashes: np.ndarray, table: np.ndarray, limit: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(words that may be frequent, places of pairs that may be)."""
    frequent = table[_slots(hashes, np.arange(len(hashes))[:, None], bits)] >= limit
    frequent[0] = False
    at = np.flatnonzero(frequent[ids[:-1]] & frequent[ids[1:]])
    return frequent, at[table[_slots(hashes, _runs(ids, at, 2), bits)] >= limit]


def _alive(ids: np.ndarray, hashes: np.ndarray, table: np.ndarray, limit: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(words that may be frequent, text of the word pairs that may be: runs of
    words with a 0 wherever a pair is surely too rare)."""
    frequent, at = _alive_pairs(ids, hashes, table, limit, bits)
    if not len(at):
        return frequent, np.zeros(1, ids.dtype)
    # words of kept pairs in order; a word that ends one pair and starts the next comes once
    ends = np.flatnonzero(np.append(at[1:] != at[:-1] + 1, True))
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - starts + 3                           # pairs + 1 words and a 0
    out = np.zeros(int(lengths.sum()) + 1, ids.dtype)
    run = np.cumsum(lengths) - lengths + 1                # after a leading 0
    shift = np.repeat(run - at[starts], ends - starts + 1)
    out[at + shift] = ids[at]
    out[at + shift + 1] = ids[at + 1]
    return frequent, out


def counts(docs: DataFrame, limit: int = MIN_COUNT, depth: int = DEPTH, bits: int = SKETCH_BITS, shard_words: int = SHARD_WORDS,
           text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, words, f): all word sequences of at most ``depth`` words
    that occur ``limit`` times or more in a language, and a row of 0 words with
    the number of all its words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # two tables of 2**bits counters
    pairs = spark.sparkContext.broadcast(sketch(texts, limit, bits, shard_words))
    triples = spark.sparkContext.broadcast(sketch(texts, limit, bits, shard_words, pairs))
    n_buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        of_pairs, of_triples = (np.frombuffer(t.value, _counter_type(limit)) for t in (pairs, triples))
        for name, ids, words in _shards(batches, shard_words):
            hashes = _word_hashes(name, words)
            single = np.bincount(ids, minlength=len(words))
            frequent, kept = _alive(ids, hashes, of_pairs, limit, bits)

            def may(symbols, hashes=hashes):
                """No three words of it are surely too rare."""
                ok = np.ones(len(symbols), bool)
                for k in range(symbols.shape[1] - 2):
                    ok &= of_triples[_slots(hashes, symbols[:, k:k + 3], bits)] >= limit
                return ok
            yield _packed(name, 0, np.zeros(1, np.int64), [b""], np.array([single[1:].sum()]))
            there = np.flatnonzero(frequent)
            if len(there):
                yield _packed(name, 1, _buckets(hashes, there[:, None], n_buckets), words[there].tolist(), single[there])
            for symbols, size in Index(kept, depth).ngrams(may):
                yield _packed(name, symbols.shape[1], _buckets(hashes, symbols, n_buckets), [b" ".join(g) for g in words[symbols].tolist()], size)

    def merge(batches):
        keys, held, fresh = ["lang", "words", "phrase"], None, 0
        for batch in batches:
            parent = pc.list_parent_indices(batch.column(3))
            rows = pa.table([batch.column(0).take(parent), batch.column(1).take(parent), batch.column(3).flatten(), batch.column(4).flatten()],
                            names=[*keys, "f"])
            held = rows if held is None else pa.concat_tables([held, rows])
            fresh += rows.num_rows
            if fresh > ROWS * 20:
                held, fresh = _summed(held, keys), 0
        if held is not None:
            held = _summed(held, keys)
            keep = pc.or_(pc.greater_equal(held["f"], limit), pc.equal(held["words"], 0))
            yield from held.filter(keep).to_batches(max_chunksize=ROWS)
    packed = texts.mapInArrow(run, "lang string, words int, bucket int, phrases array<string>, f array<long>")
    return packed.repartition("bucket").mapInArrow(merge, "lang string, words int, phrase string, f long")


def _buckets(hashes: np.ndarray, symbols: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each n-gram, alike in all shards."""
    return _slots(hashes, symbols, 62) % n


def _packed(lang: str, length: int, buckets: np.ndarray, phrases: list[bytes], numbers: np.ndarray) -> pa.RecordBatch:
    """One row a bucket with its phrases and counts."""
    order = np.argsort(buckets, kind="stable")
    there = buckets[order]
    first = np.flatnonzero(np.concatenate(([True], there[1:] != there[:-1])))
    offsets = pa.array(np.append(first, len(there)).astype(np.int32))
    texts = pa.array(phrases, pa.binary()).cast(pa.string()).take(pa.array(order))
    k = len(first)
    return pa.record_batch([pa.array([lang] * k, pa.string()), pa.array([length] * k, pa.int32()), pa.array(there[first].astype(np.int32)),
                            pa.ListArray.from_arrays(offsets, texts), pa.ListArray.from_arrays(offsets, pa.array(numbers[order].astype(np.int64)))],
                           names=["lang", "words", "bucket", "phrases", "f"])


def _summed(table: pa.Table, keys: list[str]) -> pa.Table:
    out = table.group_by(keys).aggregate([("f", "sum")])
    return out.select([*keys, "f_sum"]).rename_columns([*keys, "f"])


def _span(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def score_column() -> Column:
    """floor(1000 * a * n / (l * r)), exact: products of decimals, integral division."""
    a, n, left, right = ((F.col(c).cast("decimal(19,0)")) for c in ("a", "n", "l", "r"))
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a * n, left * right)


def phrases(docs: DataFrame, limit: int = MIN_COUNT, depth: int = DEPTH, top: int = TOP, drop_percent: int = DROP_PERCENT,
            bits: int = SKETCH_BITS, shard_words: int = SHARD_WORDS, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of
    2 to ``depth`` words."""
    table = cut_lineage(counts(docs, limit, depth, bits, shard_words, text, lang))
    total = table.where("words = 0").select("lang", F.col("f").alias("n"))
    known = table.where("words > 0").select("lang", "phrase", "f")
    found = table.where("words > 1").withColumn("w", F.split("phrase", " "))
    # n-grams one word longer are enough: a still longer one with as many occurrences holds one of those
    parts = found.where("words > 2").select(
        "lang", F.explode(F.array(_span(F.col("w"), F.lit(1), F.col("words") - 1), _span(F.col("w"), F.lit(2), F.col("words") - 1))).alias("phrase"), "f")
    longer = parts.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    kept = (found.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longest").isNull() | (100 * F.col("longest") < drop_percent * F.col("f"))))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _span(F.col("w"), F.lit(1), F.col("k")).alias("first"),
                       _span(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(total, "lang")
              .withColumn("score", score_column())
              .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    # at most ``top`` rows a salt reach the last window
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    first = scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top).drop("rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_NGRAMS = f"""
WITH p AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {DEPTH + 1})) AS k))),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
"""
ORACLE = _NGRAMS + f"""
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inner_of AS (SELECT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, max(c.a) AS longest
      FROM c, (SELECT unnest(range(2, {DEPTH})) AS m) AS ms, (SELECT unnest(range(1, {DEPTH})) AS i) AS s
      WHERE m < c.k AND i + m - 1 <= c.k GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN inner_of USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < {DROP_PERCENT} * a),
cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM kept),
s AS (SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, n, cut,
             (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
      FROM cuts JOIN total USING (lang)
      JOIN f AS x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:cut], ' ')
      JOIN f AS y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o WHERE rank <= {TOP}
"""
