"""SimHash near-duplicates through vantage-point trees (operator 3).

1. ``fingerprints``: one 64-bit SimHash a document, from whole texts.
2. ``links``: all pairs of *distinct* fingerprints within ``max_bits`` are found
   by vantage-point trees.  Two fingerprints that differ in at most ``max_bits``
   bits differ in at most ``max_bits // segments`` bits in one of ``segments``
   slices (pigeonhole), so there is one tree a slice: its nodes compare the
   slice's Hamming distance to a vantage point with a boundary, and a query
   visits every side that the triangle bound leaves open.  The upper levels,
   grown on the driver from a bounded sample, cut the fingerprints into
   shards; each fingerprint lives in one shard and is sent as a query to every
   other shard that its ball overlaps.  Shards that are too large are cut again
   by tasks, from samples of their own.  Inside a shard a task grows the rest of
   the tree over all its fingerprints.  The samples only shape the shards: the
   result is exact for any sample.
3. Every shard returns a spanning forest of its links, never all pairs, and
   ``components.components`` joins the forests.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from featurejudge.llm.common import cut_lineage
from featurejudge.llm.components import components

SEED = 42                # of XXH64
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SHINGLE = 4
MAX_BITS = 4
SEGMENTS = 3
SHARD_ROWS = 4_096       # fingerprints a shard should hold
SAMPLE_ROWS = 65_536     # most fingerprints from which the upper levels are grown
LEVEL_ROWS = 16_384      # living rows from which a too large shard is cut again, about
LEAF_ROWS = 48           # a node of a shard's tree with fewer rows is a leaf
CHUNK = 1 << 15          # shingles counted at once

_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + SPACES, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(SPACES))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one whole text; 0 for null or no word.
    Memory is bounded by the text and ``CHUNK`` shingles."""
    if not text:
        return 0
    # every byte of a multi-byte UTF-8 character is above 0x7F, so bytes can be translated
    tokens = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= shingle:
        total = 1
        ones = np.unpackbits(np.array([xxhash.xxh64_intdigest(joined, seed)], dtype="<u8").view(np.uint8)).astype(np.int64)
    else:
        total = len(tokens) - shingle + 1
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:total].tolist()
        ends = ends[shingle - 1:].tolist()
        ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
        for at in range(0, total, CHUNK):
            h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], dtype="<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(bits).view("<u8")[0])


def fingerprint_column(shingle: int = SHINGLE, seed: int = SEED):
    """Column function text -> fingerprint as a signed long (Arrow batches)."""
    @pandas_udf(LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        out = np.fromiter((fingerprint(t, shingle, seed) for t in texts), np.uint64, len(texts))
        return pd.Series(out.view(np.int64))
    return simhash


def masks(segments: int) -> list[int]:
    """Masks of ``segments`` disjoint slices that cover the 64 bits."""
    cuts = [64 * k // segments for k in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def distances(fps: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((fps ^ np.uint64(vantage)) & np.uint64(mask))


def _split(points: np.ndarray, mask: int, radius: int, max_bits: int, rng) -> tuple | None:
    """(vantage, mask, radius, boundary) that leaves the fewest visits, over a
    few vantage points and both the slice and the whole fingerprint; None if
    no split spares anything.  Left holds distance <= boundary."""
    best, cost_of_best = None, 0.9 * len(points)
    for vantage in points[rng.integers(0, len(points), 3)].tolist():
        for m, r in ((mask, radius), ((1 << 64) - 1, max_bits)):
            d = np.bincount(distances(points, vantage, m), minlength=65).cumsum()
            n = d[-1]
            for boundary in range(64):
                left = d[boundary]
                if 0 < left < n:
                    to_left = d[min(boundary + r, 64)]
                    to_right = n - (d[boundary - r] if boundary >= r else 0)
                    # rows a query is compared with, on average, if both sides are scanned
                    cost = (to_left * left + to_right * (n - left)) / n
                    if cost < cost_of_best:
                        best, cost_of_best = (vantage, m, r, boundary), cost
    return best


def grow(sample: np.ndarray, mask: int, radius: int, max_bits: int, leaf_rows: int, rng, numbers=None) -> list:
    """Upper levels of one tree: nested [vantage, mask, radius, boundary, left, right]; a leaf is [number]."""
    numbers = itertools.count() if numbers is None else numbers
    split = _split(sample, mask, radius, max_bits, rng) if len(sample) > leaf_rows else None
    if split is None:
        return [next(numbers)]
    vantage, m, _, boundary = split
    left = distances(sample, vantage, m) <= boundary
    return [*split, grow(sample[left], mask, radius, max_bits, leaf_rows, rng, numbers),
            grow(sample[~left], mask, radius, max_bits, leaf_rows, rng, numbers)]


def route(tree: list, fps: np.ndarray, lives: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, row numbers, whether each row lives there) for every leaf; a row
    lives in one leaf and visits those that its ball overlaps.  ``lives``: rows
    that live in the tree at all (default: all)."""
    todo = [(tree, np.arange(len(fps)), np.ones(len(fps), bool) if lives is None else lives)]
    while todo:
        node, rows, home = todo.pop()
        if not len(rows):
            continue
        if len(node) == 1:
            yield node[0], rows, home
            continue
        vantage, mask, radius, boundary, left, right = node
        d = distances(fps[rows], vantage, mask).astype(np.int64)
        to_left, to_right = d <= boundary + radius, d > boundary - radius
        todo.append((left, rows[to_left], (home & (d <= boundary))[to_left]))
        todo.append((right, rows[to_right], (home & (d > boundary))[to_right]))


class Forest:
    """Union-find over row numbers; roots are the smallest rows."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Merge pairs by repeated minima (no Python loop over pairs)."""
        parent = self.parent
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))

    def roots(self, rows: np.ndarray) -> np.ndarray:
        parent, out = self.parent, rows
        while True:
            up = parent[out]
            if np.array_equal(up, out):
                parent[rows] = out
                return out
            out = up


def shard_forest(fps: np.ndarray, home: np.ndarray, mask: int, max_bits: int, segments: int,
                 leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (row, root) of all links between a row that lives in the
    shard and any row of the shard, by a vantage-point tree over the living
    rows.  Leaves that cannot be split are compared block by block."""
    forest, rng, radius = Forest(len(fps)), np.random.default_rng(0), max_bits // segments
    todo = [(np.flatnonzero(home), np.arange(len(fps)))]
    block = 1 << 11
    while todo:
        points, queries = todo.pop()
        if not len(points) or len(queries) < 2:
            continue
        split = _split(fps[points], mask, radius, max_bits, rng) if len(points) > leaf_rows else None
        if split is None:
            for p in range(0, len(points), block):
                some = points[p:p + block]
                for q in range(0, len(queries), block):
                    other = queries[q:q + block]
                    i, j = np.nonzero(np.bitwise_count(fps[some][:, None] ^ fps[other][None, :]) <= max_bits)
                    i, j = some[i], other[j]
                    forest.union(i[i != j], j[i != j])
            continue
        vantage, m, r, boundary = split
        dp, dq = distances(fps[points], vantage, m), distances(fps[queries], vantage, m).astype(np.int64)
        todo.append((points[dp <= boundary], queries[dq <= boundary + r]))
        todo.append((points[dp > boundary], queries[dq > boundary - r]))
    rows = np.arange(len(fps))
    roots = forest.roots(rows)
    linked = roots != rows
    return rows[linked], roots[linked]


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          shard_rows: int = SHARD_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Links (a, b) whose connected components are those of the graph of all
    pairs within ``max_bits`` bits.  ``distinct_fps``: one long column ``fp``
    without repeats (a written table; it is read twice)."""
    spark, n = distinct_fps.sparkSession, distinct_fps.count()
    # a bounded sample by hash order: the same rows for the same input
    fraction = min(1.0, sample_rows / max(n, 1))
    bound = int(-(2 ** 63) + fraction * (2 ** 64 - 1))
    picked = distinct_fps.where(F.xxhash64("fp", F.lit(7)) <= F.lit(min(bound, 2 ** 63 - 1))).limit(2 * sample_rows).toPandas()
    sample = np.sort(picked["fp"].to_numpy(np.int64)).view(np.uint64)
    leaf = max(64, int(shard_rows * len(sample) / max(n, 1)))
    slices = masks(segments)
    trees = [grow(sample, m, max_bits // segments, max_bits, leaf, np.random.default_rng(k)) for k, m in enumerate(slices)]
    shared = spark.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for k, tree in enumerate(shared.value):
                for shard, rows, home in route(tree, fps):
                    yield _dealt(k, str(shard), fps[rows], home)

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        rows, roots = shard_forest(fps, pdf["home"].to_numpy(bool), slices[int(key[0])], max_bits, segments)
        return pd.DataFrame({"a": fps[rows].view(np.int64), "b": fps[roots].view(np.int64)})

    dealt = distinct_fps.mapInArrow(deal, DEALT)
    # a leaf of the sample stands for more fingerprints than a shard should hold
    if shard_rows * len(sample) < leaf * n:
        dealt = refined(dealt, slices, max_bits, segments, shard_rows)
    return dealt.groupBy("tree", "shard").applyInPandas(solve, "a long, b long")


DEALT = "tree int, shard string, fp long, home boolean"


def _dealt(tree: int, shard: str, fps: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), tree, np.int32)), pa.array([shard] * len(fps), pa.string()),
                                       pa.array(fps.view(np.int64)), pa.array(home)], ["tree", "shard", "fp", "home"])


def refined(dealt: DataFrame, slices: list[int], max_bits: int, segments: int, shard_rows: int) -> DataFrame:
    """``dealt`` with shards of more than ``4 * shard_rows`` living rows cut
    again, until none is left that can be cut: so shards do not grow with the
    corpus.  A task grows the next levels of a shard's tree from a bounded
    sample of its living rows (by hash); they travel to the shard's rows by a
    join, not through the driver."""
    radius, done = max_bits // segments, None

    def next_levels(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
        leaf = max(64, int(shard_rows * len(fps) / int(pdf["n"].iloc[0])))
        tree = grow(fps, slices[int(key[0])], radius, max_bits, min(leaf, len(fps) - 1), np.random.default_rng(len(fps)))
        return pd.DataFrame({"t": [key[0]], "s": [key[1]], "levels": [None if len(tree) == 1 else pickle.dumps(tree)]})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            for (k, shard), part in pdf.groupby(["tree", "shard"], sort=False):
                fps = part["fp"].to_numpy(np.int64).view(np.uint64)
                for leaf, rows, home in route(pickle.loads(part["levels"].iloc[0]), fps, part["home"].to_numpy(bool)):
                    yield _dealt(int(k), f"{shard}.{leaf}", fps[rows], home)
    while True:
        dealt = cut_lineage(dealt)
        big = cut_lineage(dealt.where("home").groupBy(F.col("tree").alias("t"), F.col("shard").alias("s")).count()
                          .where(F.col("count") > 4 * shard_rows))
        here = (F.col("tree") == F.col("t")) & (F.col("shard") == F.col("s"))
        # about LEVEL_ROWS rows of each shard
        share = F.lit(float(LEVEL_ROWS)) / F.col("count")
        sampled = dealt.where("home").join(big, here).where(F.pmod(F.xxhash64("fp", F.lit(11)), F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
        levels = cut_lineage(sampled.select("tree", "shard", "fp", F.col("count").alias("n")).groupBy("tree", "shard")
                             .applyInPandas(next_levels, "t int, s string, levels binary").where("levels IS NOT NULL"))
        if levels.isEmpty():
            return dealt if done is None else done.unionByName(dealt)
        small = dealt.join(levels.select("t", "s"), here, "left_anti")
        done = small if done is None else done.unionByName(small)
        dealt = dealt.join(levels, here).select("tree", "shard", "fp", "home", "levels").mapInArrow(deal, DEALT)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, segments: int = SEGMENTS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Null or empty texts, and texts without a word, have fingerprint zero and
    are linked like any other.  A repeated row is linked to its twin.  A null
    id keeps its row and its links; ``component_id`` is the smallest non-null
    id of the component (null if there is none).  Other columns are ignored."""
    fps = cut_lineage(docs.select(F.col(id_col).alias("doc_id"),
                                  fingerprint_column(shingle)(F.col(text_col)).alias("fp")))
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    nodes = cut_lineage(components(links(distinct.select("fp"), max_bits, segments, shard_rows)))
    members = nodes.join(distinct, nodes["node"] == distinct["fp"])
    roots = cut_lineage(members.groupBy("root").agg(F.min("first_id").alias("root_id")))
    linked = nodes.join(roots, "root").select(F.col("node").alias("fp"), "root_id")
    classes = cut_lineage(distinct.join(linked, "fp", "left")
                          .select("fp", F.coalesce("root_id", "first_id").alias("component_id")))
    return (fps.join(classes, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with all their columns, one document of each group: the row
    whose id is the group's smallest.  Of several rows that repeat this id one
    stays.  Rows without an id stay."""
    groups = near_duplicates(docs, id_col, text_col, **params)
    gone = cut_lineage(groups.where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct())
    kept = docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
    twice = cut_lineage(kept.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).count().where("count > 1")
                        .select("__id"))
    single = kept.join(twice, kept[id_col] == twice["__id"], "left_anti")
    repeated = kept.join(twice, kept[id_col] == twice["__id"], "left_semi").dropDuplicates([id_col])
    return single.unionByName(repeated)
