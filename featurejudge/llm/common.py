"""Shared helpers of the llm operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurejudge.session import cut_lineage, scratch_folder  # noqa: F401

#: Java/Spark character class of the six ASCII white-space characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"


class Memo(dict):
    """Values of a function of a text, made when first asked for and kept in
    two generations of ``size``: what was not asked for while a whole
    generation filled is forgotten.  Texts above ``longest`` characters are not
    kept.  It only saves time."""

    def __init__(self, make, size: int, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.older = make, size, longest, {}

    def __missing__(self, text: str):
        known = self.older.get(text)
        if known is None:
            known = self.make(text)
        if len(text) <= self.longest:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[text] = known
        return known


def load(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Table ``name`` under ``sf_dir`` (any path Spark reads), pruned to ``cols``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def words(text: Column) -> Column:
    """Maximal runs of characters other than the six ASCII white-space ones
    (null text: no word)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row (array functions are not
    covered by Spark's elimination of common subexpressions)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(hashes: Column, width: int) -> Column:
    """64-bit hash of every window of ``width`` consecutive elements of an
    array of longs; ``width`` must be a power of two.  Windows of 2, 4, 8 ...
    elements are hashed from two halves each, so a window costs log2(width)
    hashes.  Arrays shorter than ``width`` give an empty array."""
    if width < 1 or width & (width - 1):
        raise ValueError("width must be a power of two")

    def doubled(step):
        def body(h):
            n = F.greatest(F.size(h) - step, F.lit(0))
            return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))
        return body
    out, step = hashes, 1
    while step < width:
        out, step = let(out, doubled(step)), 2 * step
    return out


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``, equals ``remainder``
    (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


LEARN_ROWS = 40_000       # labelled documents of each label from which classifiers learn


def labelled_ids(labels: DataFrame, label_col: str, learn: Column | None = None, rows: int = LEARN_ROWS) -> DataFrame:
    """(__id, label, weight) of at most ``rows`` documents a label for which
    ``learn`` (a condition on doc_id) holds: those with the smallest hashes of
    the id, the same for the same input.  ``weight`` undoes the sampling: weighted, the
    labels have the shares that they have among all labelled documents, and the
    mean weight is 1, so a sample claims no more evidence than it has rows.
    Null labels and ids are ignored, repeated label rows count once, a document
    with both labels counts under both."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & (F.lit(True) if learn is None else learn))
             .select(F.col("doc_id").alias("__id"), F.col(label_col).cast("int").alias("label")).distinct())
    picked = known.where("false")
    held = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    for label, n in sorted(held.items()):
        mine, h = known.where(F.col("label") == label), F.xxhash64("__id", F.lit(5))
        if n > rows:
            # the bound leaves a few more than are wanted; of those the smallest hashes are taken, whatever the order of arrival
            bound = min(2 ** 63 - 1, -(2 ** 63) + int(min(1.0, (rows + 8 * rows ** 0.5 + 8) / n) * 2 ** 64))
            mine = mine.where(h <= F.lit(bound)).orderBy(h, "__id").limit(rows)
        picked = picked.unionByName(mine)
    picked = cut_lineage(picked)
    taken = {r["label"]: r["count"] for r in picked.groupBy("label").count().collect()}
    weight = F.lit(1.0)
    if taken != held:
        for label, n in taken.items():
            share = held[label] / sum(held[x] for x in taken)
            weight = F.when(F.col("label") == label, share * sum(taken.values()) / n).otherwise(weight)
    return picked.withColumn("weight", weight)


def labelled_rows(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column | None = None,
                  rows: int = LEARN_ROWS) -> DataFrame:
    """(doc_id, text, label, weight) of the ``labelled_ids``.  Only this bounded list of
    ids is broadcast, so no text is shuffled."""
    picked = labelled_ids(labels, label_col, learn, rows)
    return docs.join(F.broadcast(picked), docs["doc_id"] == picked["__id"]).select(
        docs["doc_id"], docs["text"], picked["label"], picked["weight"])
