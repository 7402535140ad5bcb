"""Language identification by error-correcting output codes (operator 5).

Every language has a codeword; every bit of the codewords is one binary
classifier over hashed byte n-grams (log-odds of the n-gram on the two sides
of the bit).  A text is decoded to the codeword with the smallest weighted
loss, weights being how often each bit was right for each language on the
learning rows.  All learning rows are counted, in two distributed passes; only
tables of (languages x buckets) and (languages x bits) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BUCKET_BITS = 14          # 16,384 n-gram buckets
MAX_LANGS = 200           # more distinct languages than this is refused
SMOOTH = 0.5              # added to every bucket of every language
PIECE = 1 << 18           # characters hashed at once
ROWS = 32                 # rows whose n-gram counts are held at once
AMBIGUITY = 0.02          # gap between the two best losses under which a row is flagged
SHARPNESS = 12.0          # of the score
UNKNOWN = "und"

_BLANK = np.full(256, 0x20, np.uint32)
_BLANK[0x61:0x7B] = np.arange(0x61, 0x7B)      # a-z
_BLANK[0x80:] = np.arange(0x80, 0x100)         # bytes of other characters


def _pieces(text: str) -> Iterator[str]:
    for at in range(0, len(text), PIECE):
        yield text[max(0, at - 2):at + PIECE]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngrams(text: str, bucket_bits: int = BUCKET_BITS) -> np.ndarray:
    """Counts of the text's hashed byte bigrams and trigrams (letters kept in
    lower case, every other ASCII character read as a blank, blank-only
    n-grams left out).  Whole text, in pieces of bounded size."""
    out = np.zeros(1 << bucket_bits, np.int64)
    shift = np.uint32(32 - bucket_bits)
    for piece in _pieces(text):
        b = _BLANK[np.frombuffer((" " + piece.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)]
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        three = three[three != 0x202020]
        two = two[two != 0x2020]
        out += np.bincount((three * np.uint32(2654435761)) >> shift, minlength=len(out))
        out += np.bincount(((two + np.uint32(0x51000000)) * np.uint32(2246822519)) >> shift, minlength=len(out))
    return out


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """(n, bits) of +1/-1.  Up to seven classes: every way to split them in
    two; above: random columns, 15 bits a doubling, no two rows alike."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        cols = np.arange(1, 1 << (n - 1))
        return np.where((cols[None, :] >> np.arange(n)[:, None]) & 1, -1.0, 1.0)
    rng, bits = np.random.default_rng(seed), 15 * int(np.ceil(np.log2(n)))
    best, far = None, 0
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]           # a column must have both sides
        gap = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if gap > far:
            best, far = code, gap
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray          # (langs, bits)
    weights: np.ndarray       # (buckets, bits) log-odds, scaled so the weakest language has margin 1
    trust: np.ndarray         # (langs, bits) share of learning rows on the right side, each row sums to 1
    bucket_bits: int

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Mean log-odds of each bit for rows of n-gram counts."""
        return (counts @ self.weights) / np.maximum(counts.sum(axis=1, keepdims=True), 1)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """(rows, langs): weighted logistic loss of each codeword."""
        loss = np.log1p(np.exp(np.clip(-self.code[None] * margins[:, None, :], -30, 30)))
        return (loss * self.trust[None]).sum(axis=2)

    def predict(self, texts: list) -> pd.DataFrame:
        lang, score, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        rows = [i for i, t in enumerate(texts) if has_letter(t)]
        for at in range(0, len(rows) if self.langs else 0, ROWS):
            some = rows[at:at + ROWS]
            counts = np.stack([ngrams(texts[i], self.bucket_bits) for i in some]).astype(np.float32)
            loss = self.losses(self.margins(counts).astype(np.float64))
            p = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
            p /= p.sum(axis=1, keepdims=True)
            ranked = np.sort(loss, axis=1)
            for k, i in enumerate(some):
                best = int(loss[k].argmin())
                lang[i], score[i] = self.langs[best], p[k, best]
                unsure[i] = len(self.langs) > 1 and ranked[k, 1] - ranked[k, 0] < AMBIGUITY
        return pd.DataFrame({"lang": lang, "score": score, "ambiguous": unsure})


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", bucket_bits: int = BUCKET_BITS) -> Model:
    """Learn from all ``rows`` with a text and a language.  No such row gives a
    model that answers `und`; a single language is always the answer."""
    spark = rows.sparkSession
    rows = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                sums[lang] = sums.get(lang, 0) + ngrams(text, bucket_bits)
                if len(sums) > MAX_LANGS:
                    raise ValueError(f"more than {MAX_LANGS} languages")
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": n[at]})

    counted = (rows.mapInPandas(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counted["lang"].unique())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"{len(langs)} languages; at most {MAX_LANGS}")
    code = codewords(len(langs))
    if len(langs) < 2:
        return Model(langs, code, np.zeros((1 << bucket_bits, 0), np.float32), np.zeros((len(langs), 0)), bucket_bits)
    n = np.zeros((len(langs), 1 << bucket_bits))
    n[counted["lang"].map({v: k for k, v in enumerate(langs)}), counted["bucket"]] = counted["n"]
    p = (n + SMOOTH) / (n + SMOOTH).sum(axis=1, keepdims=True)
    weights = np.empty((1 << bucket_bits, code.shape[1]))
    for b in range(code.shape[1]):
        up = code[:, b] > 0
        weights[:, b] = np.log(p[up].mean(axis=0)) - np.log(p[~up].mean(axis=0))
    weights /= np.maximum((p @ weights * code).min(axis=0), 1e-3)
    model = Model(langs, code, weights.astype(np.float32), np.ones(code.shape) / code.shape[1], bucket_bits)
    shared = spark.sparkContext.broadcast(model)        # at most buckets x bits floats

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, number = shared.value, {v: k for k, v in enumerate(langs)}
        right, rows_of = np.zeros(m.code.shape), np.zeros(len(langs))
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                part = pdf.iloc[at:at + ROWS]
                margins = m.margins(np.stack([ngrams(t, m.bucket_bits) for t in part["text"]]).astype(np.float32))
                k = part["lang"].map(number).to_numpy()
                np.add.at(right, k, margins * m.code[k] > 0)
                np.add.at(rows_of, k, 1)
        yield pd.DataFrame([(x, b, right[k, b], rows_of[k]) for k, x in enumerate(langs) for b in range(m.code.shape[1])],
                           columns=["lang", "bit", "right", "n"])

    seen = (rows.mapInPandas(judge, "lang string, bit int, right double, n double")
            .groupBy("lang", "bit").agg(F.sum("right").alias("right"), F.sum("n").alias("n")).toPandas())
    trust = np.zeros(code.shape)
    trust[seen["lang"].map({v: k for k, v in enumerate(langs)}), seen["bit"]] = (seen["right"] + 1) / (seen["n"] + 2)
    return Model(langs, code, model.weights, trust / trust.sum(axis=1, keepdims=True), bucket_bits)


def predict_column(spark, model: Model):
    """Column function text -> struct(lang, score, ambiguous).  Null texts and
    texts without a letter are `und` with score 0, not ambiguous."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double, ambiguous boolean")
    def language(texts: pd.Series) -> pd.DataFrame:
        return shared.value.predict(texts.where(texts.notna(), None).tolist())
    return language


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) for every row of ``docs``, learned
    from the rows where ``learn`` holds.  Repeated rows get equal answers; null
    ids are kept; columns beside the three named are never read."""
    model = fit(docs.where(learn), text_col, lang_col, bucket_bits)
    language = predict_column(docs.sparkSession, model)
    return (docs.select(F.col(id_col).alias("doc_id"), language(F.col(text_col)).alias("p"))
            .select("doc_id", F.col("p.lang").alias("lang_pred"), "p.score", "p.ambiguous"))
