"""Toxicity by noisy-channel deobfuscation (operator 6).

A word that looks disguised (digits or signs among letters, a letter three or
more times in a row, letters set apart) is a lattice: every character may stand
for itself or for the letters it imitates, repeats may collapse, separators may
be dropped.  A Viterbi pass under a character trigram model, counted over all
documents, picks the restored spelling.  Whole texts are then scored on their
words, plain and restored: the score is that of the strongest word, a word
being as toxic as the smoothed share of toxic labels among the labelled
documents with that word, its first four or its first five characters (0 for
features seen in few toxic documents).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from featurejudge.llm.common import Memo, cut_lineage, labelled_rows

LEXICON = 200_000         # most features kept, the most toxic ones first
MIN_TOXIC = 3             # labelled toxic documents that a feature must have been seen in
MIN_WEIGHT = 0.3          # smoothed toxic share that a feature must have
PREFIXES = (4, 5, 6)
LONG = 40
PRIOR_ROWS = 3.0          # labelled documents that the prior counts as
ALPHABET_BITS = 7         # character classes of the language model: 128
SKETCH = 64               # minima that copies among the learning rows are told by
BAND = 4                  # minima that must agree before two rows are compared
COPY = 0.8                # share of the minima that copies have in common
CHANNEL = 1.5             # nats that reading a character as another one costs
MEMO_WORDS = 20_000       # words of a generation of a worker's memory, which holds two

#: Letters that a sign or digit imitates.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
_SEPARATORS = ".-_*~·'’"
_TRIM = ".,;:?!\"'()[]{}<>«»„“”¡¿…-_*#%&$~|+"
_TRIM_SOFT = _TRIM.replace("$", "")
_DISGUISED = re.compile(r"[0-9@$!|+(€£.\-_*~·'’]|(.)\1\1", re.S)
_EDGE_LETTERS = re.compile(r"(?:^([$@])\1?(?=[^\W_]))|(?:(?<=[^\W_])([$@])\2?$)")
#: Three or more characters set apart by white space, with punctuation before the first and behind the last.
_SPACED = re.compile(rf"(?<!\S)[{re.escape(_TRIM)}]*(\S(?:\s++\S(?=\s))+\s++\S)[{re.escape(_TRIM)}]*+(?!\S)")
_RUN = re.compile(r"(.)\1\1", re.S)


def classes(word: str) -> np.ndarray:
    """Character classes of the language model: a-z are 1-26, any other
    letter one of 27-127 by code point, the word's edge (NUL) 0."""
    points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where((points >= 97) & (points <= 122), points - 96, np.where(points == 0, 0, 27 + points % 101))


def class_of(ch: str) -> int:
    point = ord(ch)
    return point - 96 if 97 <= point <= 122 else 27 + point % 101 if point else 0


def trigram_counts(words: list[str], times: np.ndarray) -> np.ndarray:
    """Counts of (class, class, class) over words with two leading edges and one trailing."""
    if not words:
        return np.zeros(1 << (3 * ALPHABET_BITS), np.int64)
    c = classes("\0\0" + "\0\0".join(words) + "\0\0")
    grams = (c[:-2] << (2 * ALPHABET_BITS)) | (c[1:-1] << ALPHABET_BITS) | c[2:]
    weight = np.repeat(times, np.fromiter(map(len, words), np.int64, len(words)) + 2)
    weight[(c[1:-1] == 0) & (c[2:] == 0)] = 0               # between two words
    return np.bincount(grams, weight, 1 << (3 * ALPHABET_BITS)).astype(np.int64)


@dataclass
class CharModel:
    """Interpolated trigram model, kept as three sparse levels."""
    three: dict
    two: dict
    one: np.ndarray
    after_two: dict
    after_one: dict
    memo: dict = field(default_factory=dict)

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray) -> "CharModel":
        mask = (1 << ALPHABET_BITS) - 1
        b, c = (keys >> ALPHABET_BITS) & mask, keys & mask
        two, one, after_two, after_one = {}, np.zeros(mask + 1), {}, {}
        np.add.at(one, c, counts)
        for k, y, z, n in zip(keys.tolist(), b.tolist(), c.tolist(), counts.tolist()):
            two[y << ALPHABET_BITS | z] = two.get(y << ALPHABET_BITS | z, 0) + n
            after_two[k >> ALPHABET_BITS] = after_two.get(k >> ALPHABET_BITS, 0) + n
            after_one[y] = after_one.get(y, 0) + n
        return CharModel(dict(zip(keys.tolist(), counts.tolist())), two, (one + 0.1) / (one.sum() + 0.1 * len(one)),
                         after_two, after_one)

    def log_p(self, x: int, y: int, z: int) -> float:
        k = (x << ALPHABET_BITS | y) << ALPHABET_BITS | z
        if k not in self.memo:
            self.memo[k] = self._log_p(x, y, z)          # at most 2 ** 21 of them
        return self.memo[k]

    def _log_p(self, x: int, y: int, z: int) -> float:
        p = float(self.one[z])
        n = self.after_one.get(y, 0)
        p = (self.two.get(y << ALPHABET_BITS | z, 0) + 5 * p) / (n + 5)
        n = self.after_two.get(x << ALPHABET_BITS | y, 0)
        p = (self.three.get((x << ALPHABET_BITS | y) << ALPHABET_BITS | z, 0) + 5 * p) / (n + 5)
        return math.log(p)


def lattice(token: str) -> list[tuple[list[str], float]]:
    """One slot a run of equal characters: the strings it may stand for, and
    the cost of any reading but the first."""
    slots = []
    for run in re.finditer(r"(.)\1*", token, re.S):
        ch, n = run[1], len(run[0])
        if ch in _SEPARATORS or ch.isspace():
            slots.append([("", 0.0), (" ", 2 * CHANNEL)])
            continue
        reads = [(x, CHANNEL) for x in LEET.get(ch, "")]
        if ch.isalpha():
            reads.append((ch, 0.0))
            if n == 2:
                reads.append((ch * 2, 0.0))
            elif n > 2:
                reads.append((ch * 2, CHANNEL))
        else:
            if n >= 2:
                reads += [(x * 2, CHANNEL) for x in LEET.get(ch, "")]
            if not reads or ch in "!|+(":
                reads.append(("", CHANNEL))     # a sign that stands for nothing
        slots.append(reads)
    return slots


def restore(token: str, model: CharModel) -> str:
    """Viterbi decoding of the lattice under the trigram model (exact: a state
    is the last two classes).  Time and memory are linear in the token."""
    log_p = model.log_p
    states = {(0, 0): (0.0, None)}            # last two classes -> (score, back pointer)
    for slot in lattice(token):
        after: dict = {}
        for (x, y), (score, back) in states.items():
            for read, cost in slot:
                s, a, b = score - cost, x, y
                if read == " ":
                    if b == 0:
                        continue
                    s += log_p(a, b, 0)
                    a = b = 0
                else:
                    for z in map(class_of, read):
                        s += log_p(a, b, z)
                        a, b = b, z
                if (a, b) not in after or s > after[a, b][0]:
                    after[a, b] = (s, (read, back))
        states = after or states
    if not states:
        return ""
    best = max(((s + log_p(x, y, 0), back) for (x, y), (s, back) in states.items()), key=lambda v: v[0])
    out, back = [], best[1]
    while back:
        out.append(back[0])
        back = back[1]
    return "".join(reversed(out))


def tokens(text: str | None) -> set[str]:
    """Distinct lower-case white-space tokens of a whole text, and its runs of
    three or more one-character tokens (any white space between them, as one
    space; without punctuation at either end)."""
    low = (text or "").lower()
    return {*low.split(), *(" ".join(run[1].split()) for run in _SPACED.finditer(low))}


def features(word: str) -> list[str]:
    """The word and its prefixes; what is longer than ``LONG`` characters is named by a hash."""
    whole = word if len(word) <= LONG else f"{xxhash.xxh64_hexdigest(word.encode('utf-8', 'surrogatepass'))}#{len(word)}"
    out, length = [whole], len(word)
    for n in PREFIXES:
        if length > n:
            out.append(word[:n] + "*")
    return out


def specific(lexicon: dict[str, tuple[int, float]], share: float = 0.9) -> dict[str, float]:
    """feature -> weight, without the prefixes whose toxic documents one longer
    prefix or word accounts for (``lose*`` beside ``loser``)."""
    longest: dict[str, int] = {}
    for f, (toxic, _) in lexicon.items():
        stem = f.rstrip("*")
        for n in PREFIXES:
            if len(stem) > n:
                longest[stem[:n] + "*"] = max(longest.get(stem[:n] + "*", 0), toxic)
    return {f: w for f, (toxic, w) in lexicon.items() if longest.get(f, 0) < share * toxic}


class Restorer:
    """Features of a text's words, plain and restored, with a bounded memo
    by white-space token (and by run of letters set apart)."""

    def __init__(self, model: CharModel):
        self.model, self.memo = model, Memo(self.keys, MEMO_WORDS)

    def restored(self, token: str) -> list[str]:
        return [w for w in restore(token, self.model).split() if w]

    def words(self, token: str) -> set[str]:
        """Words that one lower-case token, or run of set-apart letters, may be."""
        if token.isalpha() and not _RUN.search(token):
            return {token}
        if any(map(str.isspace, token)):
            return set(self.restored(token))
        core = token.strip(_TRIM)
        out = {core}
        # signs at the edge are mostly signs; only $ and @, once or twice, may be letters (a$$, @ss)
        wide = token.strip(_TRIM_SOFT)
        for x in {core, wide} if _EDGE_LETTERS.search(wide) else {core}:
            if not x.isalpha() or _RUN.search(x):
                if _DISGUISED.search(x) and any(map(str.isalpha, x)):
                    out.update(self.restored(x))
        out.discard("")
        return out

    def keys(self, token: str) -> tuple:
        words = self.words(token)
        return tuple(features(*words) if len(words) == 1 else {f for w in words for f in features(w)})

    def text(self, text: str | None) -> set[str]:
        return set(chain.from_iterable(map(self.memo.__getitem__, tokens(text))))


@dataclass
class Model:
    chars: CharModel
    weight: dict              # feature key -> smoothed share of toxic labels
    base: float               # share of toxic labels among all learning rows


def fit_chars(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Character trigrams of every purely alphabetic word of every text."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        total = np.zeros(1 << (3 * ALPHABET_BITS), np.int64)

        def flush():
            nonlocal total
            pairs = [(w, n) for t, n in seen.items() if (w := t.strip(_TRIM)).isalpha()]
            total += trigram_counts([w for w, _ in pairs], np.array([n for _, n in pairs], np.int64))
            seen.clear()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(text.lower().split())
                if len(seen) > MEMO_WORDS:
                    flush()
        flush()
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    # at most 2 ** 21 rows, far fewer in practice
    got = rows.mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas().sort_values("gram")
    return CharModel.of(got["gram"].to_numpy(np.int64), got["n"].to_numpy(np.int64))


#: Odd multipliers, one a minimum.
_ODD = np.random.default_rng(6).integers(0, 2 ** 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(text: str | None, keys: int = SKETCH) -> list[int]:
    """Minima of ``keys`` hashes over the text's two-word shingles; equal
    sketches element by element are as likely as the shingles are shared."""
    words = (text or "").lower().split()
    if len(words) < 2:
        return [xxhash.xxh32_intdigest(f"{k} {' '.join(words)}".encode("utf-8", "surrogatepass")) for k in range(keys)]
    h = np.fromiter((xxhash.xxh32_intdigest(f"{a} {b}".encode("utf-8", "surrogatepass")) for a, b in zip(words, words[1:])),
                    np.uint64, len(words) - 1)
    return [int((h * m).min().view(np.int64)) for m in _ODD[:keys]]


def one_of_copies(rows: DataFrame) -> DataFrame:
    """``row`` of one learning row of each group of copies of one label: what
    stands beside a toxic word in a thousand copies is then seen about once.
    Rows that agree in a band of minima are compared with the first of them,
    and left out if they share ``COPY`` of the whole sketch with it, an estimate
    of the shingles' Jaccard similarity."""
    sketched = pandas_udf(lambda texts: pd.Series([sketch(t) for t in texts]), "array<long>")
    sketches = cut_lineage(rows.select("label", F.struct("doc_id", "row").alias("at"), sketched("text").alias("s")))
    bands = sketches.select("label", "at", F.posexplode(F.array(
        *[F.xxhash64(F.slice("s", k + 1, BAND)) for k in range(0, SKETCH, BAND)])).alias("band", "h"))
    first = bands.groupBy("label", "band", "h").agg(F.min("at").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = bands.join(first, ["label", "band", "h"]).where(F.col("at") > F.col("kept")).select("at.row", "kept").distinct()
    mine, other = (sketches.select(F.col("at.row").alias(row), F.col("s").alias(s)) for row, s in (("row", "s"), ("kept_row", "kept_s")))
    alike = F.aggregate(F.zip_with("s", "kept_s", lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x)
    copies = (met.select("row", F.col("kept.row").alias("kept_row")).join(mine, "row").join(other, "kept_row")
              .where(alike >= COPY * SKETCH).select("row").distinct())
    return mine.select("row").join(copies, "row", "left_anti")


def fit(docs: DataFrame, labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> Model:
    """``docs``: all documents, for the character model; ``labelled``: a bounded
    table of learning rows (doc_id, text, 0/1 label, weight, one for each label;
    rows without an id or a label are ignored), of which near duplicates count
    once.  Without learning rows every score is 0."""
    spark = docs.sparkSession
    chars = fit_chars(docs, text_col)
    shared = spark.sparkContext.broadcast(chars)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, seen, rows = Restorer(shared.value), ({}, {}), [0, 0]

        def flush():
            for label in (0, 1):
                if seen[label]:
                    yield pd.DataFrame({"label": label, "feature": list(seen[label]),
                                        "n": np.fromiter(seen[label].values(), np.int64, len(seen[label]))})
                seen[label].clear()
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"]):
                rows[label] += 1
                mine = seen[label]
                for k in restorer.text(text):
                    mine[k] = mine.get(k, 0) + 1
                if len(mine) > MEMO_WORDS:
                    yield from flush()
        yield from flush()
        yield pd.DataFrame({"label": [0, 1], "feature": ["", ""], "n": rows})     # counts the rows

    rows = cut_lineage(labelled.where(F.col(label_col).isin(0, 1))
                       .select("doc_id", F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), "weight")
                       .withColumn("row", F.monotonically_increasing_id()))
    weighs = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.max("weight").alias("w")).collect()}
    rows = rows.join(F.broadcast(cut_lineage(one_of_copies(rows))), "row")       # as bounded as the learning rows
    rows = rows.select("doc_id", "text", "label")
    counted = cut_lineage(rows.mapInPandas(count, "label int, feature string, n long").groupBy("feature")
                          .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum("n").alias("n")))
    # the rows were counted; a row weighs what its label's sampling asks for
    toxic = F.col("toxic") * F.lit(float(weighs.get(1, 1.0)))
    n = toxic + (F.col("n") - F.col("toxic")) * F.lit(float(weighs.get(0, 1.0)))
    whole = counted.where("feature = ''").select(toxic.alias("toxic"), n.alias("n")).first()
    base = whole["toxic"] / whole["n"] if whole and whole["n"] else 0.0
    weight = (toxic + PRIOR_ROWS * base) / (n + PRIOR_ROWS)
    # at most LEXICON rows reach the driver, in order of strength
    top = (counted.where("feature != ''").withColumn("w", weight).where((F.col("toxic") >= MIN_TOXIC) & (F.col("w") >= MIN_WEIGHT))
           .orderBy(F.desc("w"), F.desc("n"), "feature").limit(LEXICON).select("feature", "toxic", "w").collect())
    return Model(chars, specific({r["feature"]: (r["toxic"], r["w"]) for r in top}), base)


class Scorer:
    def __init__(self, model: Model):
        self.weight, self.restorer, self.memo = model.weight, Restorer(model.chars), Memo(self.token, MEMO_WORDS)
        self.starts = {f[:PREFIXES[0]] for f in self.weight}

    def word(self, word: str) -> float:
        # a feature of a word begins like the word, unless it is named by a hash
        if word[:PREFIXES[0]] not in self.starts and len(word) <= LONG:
            return 0.0
        best, get = 0.0, self.weight.get
        for f in features(word):
            weight = get(f, 0.0)
            if weight > best:
                best = weight
        return best

    def token(self, token: str) -> float:
        if token[:PREFIXES[0]] not in self.starts and len(token) <= LONG and token.isalpha() and not _RUN.search(token):
            return 0.0
        return max(map(self.word, self.restorer.words(token)), default=0.0)

    def text(self, text: str | None) -> float:
        return max(map(self.memo.__getitem__, tokens(text)), default=0.0)


def score_column(spark, model: Model):
    """Column function text -> score; null and empty texts score 0."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.text(t) for t in texts], dtype="float64")
    return toxicity


def score(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text),
    learned from ``labels`` (doc_id, toxic) of the documents for which ``learn``
    holds.  Null and empty texts score 0; null ids are kept and never learned
    from; repeated rows score alike; other columns are never read."""
    model = fit(docs, labelled_rows(docs, labels, "toxic", learn))
    toxicity = score_column(docs.sparkSession, model)
    return (docs.select("doc_id", toxicity("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
