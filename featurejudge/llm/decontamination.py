"""Benchmark decontamination by template windows (operator 2).

Numbers, units and names become typed placeholders, so a question with other
values has the same template.  Every run of ``width`` template words is hashed;
windows of documents are joined to windows of benchmark items by hash.  A match
fixes a diagonal (document position minus item position), on which the whole
item is compared with the document word by word: a candidate passage.  It counts
if its slots agree: equal values of the item must stand against equal values in
the document.  An item is found in a document if the passages that count cover
enough of its windows.  Short items have shorter windows, so that one changed
word leaves half of them; an item without a window to join by (under 8 words, or
nearly nothing but placeholders) is found where all its words and values stand.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurejudge.llm.common import SPACE_CLASS, cut_lineage, let, window_hashes

WIDTH = 8                       # template words in a window; a power of two
MIN_SHARE = 0.5                 # of an item's windows that must be matched
MIN_LITERALS = 3                # words that are no placeholder in an item's window that is joined by
SHORT = ((11, 4), (8, 3))       # (item's words, window) of items under 3 * WIDTH - 1 words
MIN_WORDS, MIN_CHARS = 4, 20    # an item with fewer words and fewer characters is not judged
SIEVE = 1 << 16                 # residues of item hashes that are told apart before the join
BROADCAST_BYTES = 32 << 20      # most bytes of item windows that are broadcast

#: Private-use characters that mark a placeholder; the value stands behind them.
NUMBER, UNIT, NAME, PAST = "", "", "", ""
#: Units recognised after a number.
UNITS = ("%", "€", "$", "£", "°", "°c", "°f", "mm", "cm", "dm", "m", "km", "inch", "inches", "ft", "feet", "foot", "yards", "yard",
         "yd", "miles", "mile", "mi", "mg", "kg", "g", "tons", "ton", "t", "oz", "lbs", "lb", "pounds", "pound", "ml", "cl",
         "liters", "liter", "litres", "litre", "l", "gallons", "gallon", "seconds", "second", "sec", "s", "minutes", "minute", "min",
         "hours", "hour", "h", "days", "day", "weeks", "week", "months", "month", "years", "year", "meters", "meter", "metres",
         "metre", "kilometers", "kilometer", "grams", "gram", "kilograms", "kilogram", "dollars", "dollar", "euros", "euro", "cents",
         "cent", "percent", "degrees", "degree", "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "kw", "w")

_EDGE = r"[\p{P}\p{S}&&[^%€$£°]]"
_UNIT = "(?:" + "|".join(sorted((u.replace("$", r"\$") for u in UNITS), key=len, reverse=True)) + ")"


def template(text: Column) -> Column:
    """Template words of a whole text: white-space words in lower case without
    punctuation at their edges (words of nothing else are dropped).  A number,
    a unit behind a number, and a name (a capitalised word behind a word that
    ends no sentence) get the mark of their type in front of their value.
    Null and empty texts: an empty array."""
    out = F.concat(F.lit(" "), F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "), F.lit(" "))
    out = F.regexp_replace(out, rf"(?i) {_EDGE}*+([$€£]?[+-]?\d[\d.,:/]*+{_UNIT}?){_EDGE}*+(?= )", f" {NUMBER}$1")
    out = F.regexp_replace(out, rf"(?i) ({NUMBER}[^ ]*+) ({_UNIT}){_EDGE}*+(?= )", f" $1 {UNIT}$2")
    out = F.regexp_replace(out, r"(?<=[\p{L},;]) +(\p{Lu}[\p{Ll}'’-]++)", f" {NAME}$1")
    out = F.regexp_replace(F.regexp_replace(out, rf"{_EDGE}++(?= )", ""), rf"(?<= ){_EDGE}++", "")
    return F.array_remove(F.split(F.lower(out), " "), "")


def is_slot(word: Column) -> Column:
    return (word >= NUMBER) & (word < PAST)


def word_hashes(words: Column) -> Column:
    """Hash of every template word; a placeholder is hashed without its value."""
    return F.transform(words, lambda w: F.xxhash64(F.when(is_slot(w), F.substring(w, 1, 1)).otherwise(w)))


def value(word: Column) -> Column:
    """The word without the mark of a placeholder."""
    return F.when(is_slot(word), F.substring(word, 2, 1 << 30)).otherwise(word)


def runs(hashes: Column, width: int) -> Column:
    """Hash of every run of ``width`` elements, any width: of the two runs of a
    power of two that cover it."""
    half = 1 << (width.bit_length() - 1)
    if half == width:
        return window_hashes(hashes, width)

    def both(h):
        n = F.greatest(F.size(h) - (width - half), F.lit(0))
        return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(width - half + 1), n), lambda a, b: F.xxhash64(a, b))
    return let(window_hashes(hashes, half), both)


def value_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(value(w)))


def hashed(table: DataFrame, text_col: str, kinds: list[tuple[bool, int]]) -> DataFrame:
    """The columns of ``table`` but the text, with words and hashes: template
    words of whole texts, and the hashes of their runs, one kind (by value or
    not, width) behind the other."""
    def all_runs(by_value):
        widths = [w for exact, w in kinds if exact == by_value]
        hashes = value_hashes(F.col("words")) if by_value else word_hashes(F.col("words"))
        return [let(hashes, lambda h: F.concat(*[runs(h, w) for w in widths]))] if widths else []
    parts, rest = all_runs(False) + all_runs(True), [c for c in table.columns if c != text_col]
    return (table.select(*rest, template(F.col(text_col)).alias("words"))
            .select(*rest, "words", (F.concat(*parts) if parts else F.array().cast("array<long>")).alias("hashes")))


def judgeable(item_words: Column) -> Column:
    """An item that says enough: found by chance, a shorter one proves nothing."""
    return (F.size(item_words) >= MIN_WORDS) | (F.length(F.array_join(item_words, " ")) >= MIN_CHARS)


def unjudged_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, n_words): items that are not looked for: under ``MIN_WORDS``
    words and ``MIN_CHARS`` characters (also null and empty ones)."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), template(F.col(text_col)).alias("w"))
    return rows.where(~judgeable(F.col("w"))).select("item_id", F.size("w").alias("n_words"))


def item_table(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(item, item_id, item_words, w), one row a judgeable item with an id."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), template(F.col(text_col)).alias("item_words"))
    n, w = F.size("item_words"), F.lit(width)
    for least, short in reversed(SHORT):
        if short < width:
            w = F.when((n >= least) & (n < 3 * width - 1), short).otherwise(w)
    return (rows.where((n > 0) & judgeable(F.col("item_words")) & F.col("item_id").isNotNull()).distinct()
            .withColumn("w", w).withColumn("item", F.monotonically_increasing_id()))


def item_windows(items: DataFrame, width: int = WIDTH, min_literals: int = MIN_LITERALS) -> DataFrame:
    """(item, by_value, size, item_pos, h, prev): windows by which items are
    joined, of ``width`` and of the item's own width, without those of few
    plain words.  ``prev`` is the hash of the window before, if it is one too.
    The first word of an item may be read as a name inside a document, so the
    first window is also hashed that way."""
    def rich(words):
        return F.size(F.filter(words, lambda x: ~is_slot(x))) >= min_literals
    parts = []
    for size in sorted({width, *(short for _, short in SHORT if short < width)}):
        rows = items.where((F.size("item_words") >= size) & (F.lit(size == width) | (F.col("w") == size)))
        rows = rows.select("item", "item_words", runs(word_hashes(F.col("item_words")), size).alias("hs"))
        rows = rows.select("item", "item_words", "hs", F.posexplode("hs").alias("item_pos", "h"))
        rows = rows.withColumn("words", F.slice("item_words", F.col("item_pos") + 1, F.lit(size)))
        before = F.slice("item_words", F.greatest(F.col("item_pos"), F.lit(1)), F.lit(size))
        rows = rows.withColumn("prev", F.when((F.col("item_pos") > 1) & rich(before), F.get("hs", F.col("item_pos") - 1)))
        first = F.get("words", F.lit(0))
        as_name = (rows.where((F.col("item_pos") == 0) & ~is_slot(first))
                   .withColumn("words", F.concat(F.array(F.concat(F.lit(NAME), first)), F.slice("words", 2, size)))
                   .withColumn("h", F.get(runs(word_hashes(F.col("words")), size), F.lit(0))))
        parts.append(rows.unionByName(as_name).where(rich(F.col("words")))
                     .select("item", F.lit(False).alias("by_value"), F.lit(size).alias("size"), "item_pos", "h", "prev"))
    windows = parts[0]
    for part in parts[1:]:
        windows = windows.unionByName(part)
    windows = cut_lineage(windows)
    bare = items.join(windows.select("item").distinct(), "item", "left_anti")
    for size in range(1, width + 1):          # by the values of their first words
        rows = bare.where(F.least(F.size("item_words"), F.lit(width)) == size)
        windows = windows.unionByName(rows.select(
            "item", F.lit(True).alias("by_value"), F.lit(size).alias("size"), F.lit(0).alias("item_pos"),
            F.get(runs(value_hashes(F.col("item_words")), size), F.lit(0)).alias("h"), F.lit(None).cast("long").alias("prev")))
    return windows


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          width: int = WIDTH, min_share: float = MIN_SHARE, min_literals: int = MIN_LITERALS,
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, share, n_slots, n_changed),
    one row for each benchmark item (item_id, text) found in a document.

    ``share`` is the part of the item's windows that the document matches,
    ``n_slots`` the item's values in them and ``n_changed`` how many of these
    have another value in the document.  An item without a window to join by
    counts as one window, matched by equal words and values.  Null and wordless
    texts match nothing.  Items without an id and those of ``unjudged_items`` are left out; documents without
    an id are reported together under a null id.  Repeated rows count once;
    other columns are never read; an empty side gives an empty result.

    Items are broadcast if they hold at most ``broadcast_bytes``; otherwise the
    same joins are made by shuffles.  Windows travel without the document; its
    words are built again for documents with a match alone, once for all items."""
    items = cut_lineage(item_table(benchmark, width=width))
    windows = cut_lineage(item_windows(items, width, min_literals))
    kinds = sorted((r["by_value"], r["size"]) for r in windows.select("by_value", "size").distinct().collect())
    bare = windows.where("by_value").select("item").distinct().withColumn("exact", F.lit(True))
    items = cut_lineage(items.join(bare, "item", "left").select(
        "item", "item_id", "item_words", F.coalesce("exact", F.lit(False)).alias("exact"),
        F.when(F.col("exact"), F.size("item_words")).otherwise(F.col("w")).alias("w")))
    held = ((items.agg(F.sum(F.octet_length(F.array_join("item_words", " ")) + 64).alias("b")).first()["b"] or 0)
            + 64 * windows.count())
    # windows whose last bits no item has are dropped before they become rows
    bits = bytearray(SIEVE)
    for r in windows.select(F.col("h").bitwiseAND(F.lit(SIEVE - 1)).cast("int").alias("bit")).distinct().collect():
        bits[r["bit"]] = 1
    sieve = F.lit(bytes(bits))
    # a document is named by two hashes of id and text: rows that share both are repeats
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id", "text", F.xxhash64("text").alias("k1"), F.xxhash64("id", F.lit(7), "text").alias("k2"))
    texts = hashed(keyed.drop("id"), "text", kinds)

    def spots(hs):
        at = F.filter(F.sequence(F.lit(0), F.size(hs) - 1), lambda k: F.substring(
            sieve, F.get(hs, k).bitwiseAND(F.lit(SIEVE - 1)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01"))
        return F.transform(at, lambda k: F.struct(k.alias("k"), F.get(hs, k).alias("h"), F.get(hs, k - 1).alias("behind")))
    # explode_outer: for explode, Spark infers a filter that would evaluate the template once more
    own = (texts.select("k1", "k2", F.size("words").alias("n"), F.explode_outer(let(F.col("hashes"), spots)).alias("s"))
           .select("k1", "k2", "n", "s.k", "s.h", "s.behind").where("h IS NOT NULL"))
    # where the runs of a kind begin among a document's hashes
    begin, starts = F.lit(0), F.lit(0)
    for exact, size in kinds:
        starts = F.when((F.col("by_value") == exact) & (F.col("size") == size), begin).otherwise(starts)
        begin = begin + F.greatest(F.col("n") - size + 1, F.lit(0))
    small = held <= broadcast_bytes
    # of consecutive matches on a diagonal the first is enough
    met = (own.join(F.broadcast(windows) if small else windows, "h").where(~F.coalesce(F.col("behind") == F.col("prev"), F.lit(False)))
           .select("k1", "k2", "item", (F.col("k") - starts - F.col("item_pos")).alias("start")).distinct())
    # the words are taken back once a document that has a match, and a passage is as long as its item
    lengths = items.select("item", F.size("item_words").alias("len"))
    met = cut_lineage(met).join(F.broadcast(lengths) if small else lengths, "item")
    met = met.groupBy("k1", "k2").agg(F.collect_list(F.struct("item", "start", "len")).alias("c"))

    def passages_in(w):
        return F.transform("c", lambda x: F.struct(x["item"].alias("item"), x["start"].alias("start"), F.transform(
            F.sequence(F.lit(0), x["len"] - 1), lambda j: F.get(w, x["start"] + j)).alias("span")))
    met = keyed.join(met, ["k1", "k2"]).select("id", F.explode(let(template(F.col("text")), passages_in)).alias("p"))
    met = met.select(F.col("id").alias("doc_id"), "p.item", "p.start", "p.span").join(F.broadcast(items) if small else items, "item")
    met = met.select("doc_id", "item", "item_id", "start", "exact", "w",
                     F.zip_with("item_words", "span", lambda a, b: F.struct(a.alias("item"), b.alias("doc"))).alias("pairs"))

    def mark(word):
        return F.when(is_slot(word), F.substring(word, 1, 1)).otherwise(word)
    same = F.transform("pairs", lambda p: F.coalesce(
        (value(p["item"]) == value(p["doc"])) | (~F.col("exact") & (mark(p["item"]) == mark(p["doc"]))), F.lit(False)))
    met = met.distinct().withColumn("same", same).withColumn("item_count", F.size("pairs") - F.col("w") + 1)
    met = met.withColumn("at", F.filter(F.sequence(F.lit(0), F.col("item_count") - 1),
                                        lambda i: F.forall(F.slice("same", i + 1, F.col("w")), lambda x: x)))
    slots = F.array_distinct(F.filter(F.flatten(F.transform("at", lambda i: F.slice("pairs", i + 1, F.col("w")))),
                                      lambda p: is_slot(p["item"]) & is_slot(p["doc"])))
    passages = (met.where(F.size("at") > 0).withColumn("slots", slots)
                .where(F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda p: p["item"])))))
    found = (passages.groupBy("doc_id", "item", "item_id", "item_count")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_set("at")))).cast("long").alias("n_windows"),
                  F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
             .withColumn("share", F.round(F.col("n_windows") / F.col("item_count"), 6))
             .where(F.col("share") >= min_share)
             .select("doc_id", "item_id", F.struct(
                 "share", "n_windows", F.col("item_count").cast("long").alias("item_windows"),
                 F.size("slots").cast("long").alias("n_slots"),
                 F.size(F.filter("slots", lambda p: p["item"] != p["doc"])).cast("long").alias("n_changed")).alias("best")))
    return (found.groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))     # texts that share an id
            .select("doc_id", "item_id", "best.n_windows", "best.item_windows", "best.share", "best.n_slots", "best.n_changed"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` with all their columns, without the documents in which an item
    is found.  Rows with a null id, null, empty and wordless texts are kept;
    repeated rows go or stay together; texts of any length are read whole; an
    empty table gives an empty one; columns with any names pass unchanged."""
    found = cut_lineage(leaks(docs, benchmark, **params).select(F.col("doc_id").alias("__leaked")).distinct())
    return docs.join(found, docs[params.get("id_col", "doc_id")] == found["__leaked"], "left_anti")
