"""Temperature mixing of sources (operator 10).

Source s with token share p_s gets weight w_s proportional to p_s ** e.  The
exponent e is bisected on a grid of 1e-6: it is the largest e in [0, 1] whose
weights reach the target entropy and ask of no source more than
``max_repeat`` passes (a smaller exponent is flatter, so it raises entropy but
also the repetition of small sources; where the two targets disagree the
repetition limit wins).  The weights then become integer token budgets, and
each source fills its budget with whole passes over a permutation of its
documents and one partial pass that takes permuted blocks until the budget is
used.

A pass is a permutation of blocks: a document's hash names its block, every
pass puts the blocks of a source in another order (a bijection of block
numbers chosen by source and pass) and the documents of a block in another
order (a hash of id and pass).  The partial pass is the beginning of its
permutation.  Running totals are over (source, pass, block) sums, by ranges of
the order, so no task holds all blocks of a source; rows are only ordered
inside their block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurejudge.llm.common import SPACE_CLASS, cut_lineage
from featurejudge.operators.cumulative import exact_rank, running_total

GRID = 1_000_000
MAX_REPEAT = 4.0
TARGET_ENTROPY = 0.98     # of log(number of sources)
MAX_SOURCES = 10_000      # more distinct sources than this are planned by Spark jobs, not by the driver
BLOCK_ROWS = 2_000        # documents a block should hold


def token_count(text: Column) -> Column:
    """Words of a whole text (null: 0), without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS[1:-1]}]+")), F.lit(0)).cast("long")


def weights(tokens: dict, exponent: float) -> dict:
    """Normalised p ** exponent of the sources that have a token."""
    total = sum(tokens.values())
    raw = {s: (n / total) ** exponent for s, n in sorted(tokens.items(), key=lambda x: str(x[0])) if n > 0}
    whole = math.fsum(raw.values())
    return {s: x / whole for s, x in raw.items()}


def entropy(w: dict) -> float:
    return -math.fsum(x * math.log(x) for x in w.values() if x > 0)


def exponent_for(tokens: dict, budget: int, target_entropy: float = TARGET_ENTROPY,
                 max_repeat: float = MAX_REPEAT) -> float:
    """Bisect on k / GRID.  Entropy falls and repetition of the smallest source
    falls as the exponent grows, so each target is one boundary."""
    n_sources = sum(1 for n in tokens.values() if n > 0)
    if n_sources < 2 or budget <= 0:
        return 1.0

    def flat_enough(k):
        return entropy(weights(tokens, k / GRID)) >= target_entropy * math.log(n_sources) - 1e-12

    def repeats(k):
        return max(w * budget / tokens[s] for s, w in weights(tokens, k / GRID).items())
    return bisected(flat_enough, repeats, max_repeat) / GRID


def bisected(flat_enough, repeats, max_repeat: float) -> int:
    """The largest k of 0 .. GRID that is flat enough, or the smallest above it
    that keeps the repetition limit."""
    low, high = 0, GRID                   # 0 always is flat enough
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if flat_enough(mid) else (low, mid - 1)
    flat, high = low, GRID                # GRID if none keeps the limit
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if repeats(mid) <= max_repeat + 1e-12 else (mid + 1, high)
    return max(flat, low)


def budgets(tokens: dict, budget: int, target_entropy: float, max_repeat: float) -> dict:
    """source -> (weight, token budget).  Budgets are floors, the tokens left
    over go one by one to the largest remainders (ties: by name)."""
    w = weights(tokens, exponent_for(tokens, budget, target_entropy, max_repeat))
    exact = {s: round(x * budget, 6) for s, x in w.items()}
    out = {s: int(x) for s, x in exact.items()}
    rest = budget - sum(out.values())
    for s in sorted(exact, key=lambda s: (out[s] - exact[s], str(s)))[:max(rest, 0)]:
        out[s] += 1
    return {s: (w[s], out[s]) for s in out}


def source_plan(sums: DataFrame, share: float, target_entropy: float, max_repeat: float, max_sources: int = MAX_SOURCES) -> DataFrame:
    """(source, n, tokens, source_weight, budget) of the sources that have a
    token, from (source, n, tokens).  The driver plans up to ``max_sources``;
    beyond, the same bisection and the same rounding run as aggregates over
    the table of sources."""
    spark = sums.sparkSession
    schema = "source string, n long, tokens long, source_weight double, budget long"
    sums = sums.where("tokens > 0")
    rows = sums.limit(max_sources + 1).collect()
    if len(rows) <= max_sources:
        tokens = {r["source"]: r["tokens"] for r in rows}
        plan = budgets(tokens, int(sum(tokens.values()) * share), target_entropy, max_repeat) if tokens else {}
        return spark.createDataFrame([(r["source"], r["n"], r["tokens"], *map(float, plan[r["source"]][:1]), plan[r["source"]][1]) for r in rows], schema)
    sums = cut_lineage(sums)
    whole = sums.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("k")).first()
    budget, k_sources = int(whole["t"] * share), whole["k"]
    p = F.col("tokens") / F.lit(float(whole["t"]))

    def weighted(k: int) -> tuple[Column, float]:
        raw = F.pow(p, F.lit(k / GRID))
        return raw, sums.agg(F.sum(raw).alias("s")).first()["s"]

    def flat_enough(k):
        raw, total = weighted(k)
        w = raw / F.lit(total)
        return -sums.agg(F.sum(w * F.log(w)).alias("e")).first()["e"] >= target_entropy * math.log(k_sources) - 1e-12

    def repeats(k):
        raw, total = weighted(k)
        return sums.agg(F.max(raw / F.lit(total) * F.lit(float(budget)) / F.col("tokens")).alias("r")).first()["r"]
    k = GRID if budget <= 0 else bisected(flat_enough, repeats, max_repeat)
    raw, total = weighted(k)
    exact = F.round(F.col("source_weight") * F.lit(float(budget)), 6)
    plan = cut_lineage(sums.withColumn("source_weight", raw / F.lit(total)).withColumn("exact", exact)
                       .withColumn("floor", F.floor("exact").cast("long")).withColumn("behind", F.col("floor") - F.col("exact"))
                       .withColumn("name", F.coalesce("source", F.lit("None"))))
    rest = budget - plan.agg(F.sum("floor").alias("f")).first()["f"]
    ranked = exact_rank(plan, ["behind", "name"])
    return ranked.select("source", "n", "tokens", "source_weight", (F.col("floor") + (F.col("_rank") <= rest).cast("long")).alias("budget"))


def permuted(block: Column, blocks: Column, sid: Column, repeat: Column, seed: int) -> Column:
    """The place of a block in a pass: a bijection of 0 .. blocks - 1, a power
    of two, chosen by source and pass: three times a mask, an odd factor, a
    shift, and the upper half of the bits over the lower one."""
    half = F.greatest(F.ceil(F.log2(blocks.cast("double")) / 2).cast("int"), F.lit(1))
    small = F.lit((1 << 20) - 1)
    for i in range(3):
        mask, factor, shift = (F.xxhash64(sid, repeat, F.lit(seed), F.lit(3 * i + j)) for j in range(3))
        block = F.pmod((block.bitwiseXOR(F.pmod(mask, blocks))) * (factor.bitwiseAND(small).bitwiseOR(F.lit(1))) + shift.bitwiseAND(small), blocks)
        block = block.bitwiseXOR(F.call_function("shiftright", block, half))
    return block


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        budget_share: float = 1.0, target_entropy: float = TARGET_ENTROPY, max_repeat: float = MAX_REPEAT,
        block_rows: int = BLOCK_ROWS, seed: int = 0, max_sources: int = MAX_SOURCES) -> DataFrame:
    """(doc_id, source, n_tokens, repeat, block, position, source_weight): one
    row for each time a document is used; ``repeat`` counts the passes from 0,
    ``block`` is the place of its block in that pass, ``position`` (from 0) its
    own place in it.  The positions of a pass are 0, 1, 2 ... without a gap.

    The budget is ``budget_share`` of all tokens.  A null source is a source of
    its own.  Documents without a word (null, empty) have no token: they come with each whole
    pass of their source, and in a partial pass where they stand before its end
    (a source without any token gives none).  Repeated rows count each; ties of
    the hash are ordered by id, then by row.  The budget is never exceeded: a
    document that would pass its end is left out, as is all behind it.  Texts
    of any length count whole.  An empty table gives an empty result.  Other
    columns are ignored."""
    base = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                   token_count(F.col(text_col)).alias("n_tokens"))
                       .withColumn("row", F.monotonically_increasing_id()))
    plan = source_plan(base.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")), budget_share, target_entropy,
                       max_repeat, max_sources)
    doublings = F.ceil(F.log2(F.greatest(F.col("n") / F.lit(float(block_rows)), F.lit(1.0))))
    sources = cut_lineage(plan.select(
        F.monotonically_increasing_id().alias("sid"), F.col("source").alias("s"), "source_weight", F.floor(F.col("budget") / F.col("tokens")).alias("passes"),
        (F.col("budget") % F.col("tokens")).alias("part"), F.pow(F.lit(2.0), doublings).cast("long").alias("blocks")))
    # rows that share an id beyond a block's size (null ids, copies) are dealt by row
    heavy = base.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > block_rows).select(F.col("doc_id").alias("id"), F.lit(True).alias("heavy"))
    rows = (base.join(sources, F.col("source").eqNullSafe(F.col("s"))).join(heavy, F.col("doc_id").eqNullSafe(F.col("id")), "left")
            .withColumn("deal", F.when(F.col("heavy"), F.xxhash64("doc_id", F.lit(seed), "row")).otherwise(F.xxhash64("doc_id", F.lit(seed))))
            .withColumn("b", F.pmod(F.col("deal"), F.col("blocks"))))
    rows = cut_lineage(rows.select("doc_id", "source", "n_tokens", "row", "sid", "b", "source_weight"))

    # every pass of a source; the last one may end at a part of its tokens
    passes = sources.withColumn("last", F.col("passes") - F.when(F.col("part") > 0, 0).otherwise(1)).where("last >= 0").select(
        "sid", "blocks", "passes", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("repeat"))
    sums = rows.groupBy("sid", "b").agg(F.sum("n_tokens").alias("in_block"), F.count("*").alias("n_rows"))
    placed = sums.join(passes, "sid").withColumn("block", permuted(F.col("b"), F.col("blocks"), F.col("sid"), F.col("repeat"), seed))
    placed = running_total(placed, "block", ["in_block", "n_rows"], ["sid", "repeat"])
    placed = placed.withColumn("upto", F.when(F.col("repeat") == F.col("passes"), F.col("part"))).withColumn(
        "before", F.col("cum_in_block") - F.col("in_block")).where(F.col("upto").isNull() | (F.col("before") < F.col("upto")))
    placed = placed.select("sid", "b", "repeat", "block", "before", (F.col("cum_n_rows") - F.col("n_rows")).alias("ahead"), "upto")

    in_order = (Window.partitionBy("sid", "b", "repeat").orderBy(F.xxhash64("doc_id", "repeat", F.lit(seed)), F.col("doc_id").asc_nulls_first(), "row")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    used = rows.join(placed, ["sid", "b"]).withColumns({
        "position": F.col("ahead") + F.count(F.lit(1)).over(in_order) - 1, "so_far": F.col("before") + F.sum("n_tokens").over(in_order)})
    return used.where(F.col("upto").isNull() | (F.col("so_far") <= F.col("upto"))).select(
        "doc_id", "source", "n_tokens", "repeat", "block", "position", "source_weight")
