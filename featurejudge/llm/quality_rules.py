"""Quality rules by cross-document line frequency (operator 7).

Lines are normalised and hashed; for each host the documents that hold a line
are counted; lines in more documents than a limit are taken out, and a
document that has too little left is rejected.  DataFrame functions only.

A line goes if it is over any of two limits: a low number of documents, which
does not grow with the host, or a share of the host's documents, which is the
lower one for small hosts.  Exact copies of a text are one document here: they
are the business of a deduplication, and their lines are not boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurejudge.llm.common import cut_lineage, let, window_hashes, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
LONG_LINE = 10            # words of a line that is unlikely to come twice by chance
MAX_DOCS_LONG = 3         # distinct documents of a host that may hold such a line
MAX_DOCS = 10             # and a shorter one
MAX_SHARE = 0.05          # of a host's documents that may hold any line (one document may always)
MIN_LEFT = 0.3            # of a document's words that must be left
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


def repeated_words(hashes: Column, width: int = WINDOW) -> Column:
    """Number of words that lie in a window of ``width`` words found twice or
    more in the array (of word hashes).  Only arrays with an equal pair of
    windows are sorted."""
    def covered(w):
        def by_neighbours(s):
            at = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda k: F.coalesce((F.get(s, k)["h"] == F.get(s, k + 1)["h"]), F.lit(False))
                          | (F.when(k > 0, F.get(s, k)["h"] == F.get(s, k - 1)["h"]).otherwise(F.lit(False))))
            return F.array_sort(F.transform(at, lambda k: F.get(s, k)["i"]))
        starts = let(F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), by_neighbours)
        gaps = let(starts, lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
                                                lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)
    return let(window_hashes(hashes, width),
               lambda w: F.when(F.size(w) == F.size(F.array_distinct(w)), F.lit(0).cast("long")).otherwise(covered(w)))


def base_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, host, who, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, lines) a row of ``docs`` (doc_id, source,
    text); ``who``: hash of the text; ``lines``: hash and words of every line
    that has a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)

    def line(x):
        return let(words(F.lower(x)), lambda w: F.struct(F.xxhash64(F.array_join(w, " ")).alias("h"), F.size(w).alias("n")))
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("host"), F.xxhash64(text).alias("who"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("hashes"),
        F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("raw_lines"))
    rows = rows.select("doc_id", "host", "who", F.size("hashes").cast("long").alias("n_words"), "word_chars", "n_symbols",
                       (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"),
                       repeated_words(F.col("hashes")).alias("n_repeat_words"), F.transform("raw_lines", line).alias("lines"))
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def judge(docs: DataFrame, max_docs: int = MAX_DOCS, max_docs_long: int = MAX_DOCS_LONG, max_share: float = MAX_SHARE,
          min_left: float = MIN_LEFT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_removed, kept), one row a row of ``docs`` (doc_id, source,
    text; other columns are ignored).

    A line's documents are those of a host with distinct texts (so rows without
    an id count, repeated rows and exact copies count once).  A line in more
    than ``max_docs`` of them (``max_docs_long`` if it has ``LONG_LINE`` words),
    or in at least two and more than ``max_share`` of all, is removed from
    every document of the host.  ``n_removed`` counts the words so lost.  A document is kept if
    it passes the base rules and has ``min_left`` of its words left.  Null and
    empty texts have no words and fail the base rules; a null source is a host
    of its own."""
    base = cut_lineage(base_rules(docs).withColumn("row", F.monotonically_increasing_id()))
    lines = base.select("row", "host", "who", F.explode("lines").alias("line")).select("row", "host", "who", "line.h", "line.n")
    held = (lines.groupBy("host", "h").agg(F.count_distinct("who").alias("n_docs"), F.min("n").alias("n"))
            .where(F.col("n_docs") > 1))
    hosts = base.groupBy("host").agg(F.count_distinct("who").alias("host_docs")).withColumnRenamed("host", "of")
    over = cut_lineage(held.join(hosts, F.col("host").eqNullSafe(F.col("of")))
                       .where((F.col("n_docs") > F.when(F.col("n") >= LONG_LINE, max_docs_long).otherwise(max_docs))
                              | (F.col("n_docs") > F.col("host_docs") * max_share))
                       .select(F.col("host").alias("of"), F.col("h").alias("common")))
    removed = (lines.join(over, F.col("host").eqNullSafe(F.col("of")) & (F.col("h") == F.col("common")))
               .groupBy("row").agg(F.sum("n").alias("n_removed")))
    out = base.join(cut_lineage(removed), "row", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("long"))
    kept = ~F.col("base_failed") & ((F.col("n_words") - F.col("n_removed")) >= F.col("n_words") * min_left)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed",
                      kept.alias("kept"))


#: DuckDB SQL of ``judge`` over documents, with the columns of the query.
ORACLE = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM d),
win AS (SELECT doc_id, i, list_slice(ws, i, i + {WINDOW - 1}) AS x FROM (
        SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM w WHERE len(ws) >= {WINDOW})),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (
        SELECT doc_id, i, unnest(range({WINDOW})) AS k FROM twice WHERE n > 1) GROUP BY doc_id),
ln AS (SELECT doc_id, source, line, regexp_extract_all(lower(line), '[^ \\t\\n\\x0B\\f\\r]+') AS lw
       FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)),
lines AS (SELECT doc_id, source, line, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM ln WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
held AS (SELECT l.source, l.norm, l.n, count(DISTINCT d.text) AS nd FROM (SELECT DISTINCT doc_id, source, norm, n FROM lines) l
         JOIN d USING (doc_id) GROUP BY l.source, l.norm, l.n HAVING count(DISTINCT d.text) > 1),
over AS (SELECT o.source, o.norm FROM held o JOIN (SELECT source, count(DISTINCT text) AS nd FROM d GROUP BY source) h
         ON o.source IS NOT DISTINCT FROM h.source
         WHERE o.nd > CASE WHEN o.n >= {LONG_LINE} THEN {MAX_DOCS_LONG} ELSE {MAX_DOCS} END OR o.nd > h.nd * {MAX_SHARE}),
gone AS (SELECT l.doc_id, sum(l.n) AS n FROM lines l JOIN over o ON l.source IS NOT DISTINCT FROM o.source AND l.norm = o.norm
         GROUP BY l.doc_id),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed
      FROM w LEFT JOIN dup ON w.doc_id = dup.doc_id LEFT JOIN rep ON w.doc_id = rep.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed,
  NOT base_failed AND n_words - n_removed >= n_words * {MIN_LEFT} AS kept FROM f
"""
