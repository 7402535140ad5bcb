from pyspark.sql import functions as F

from featurejudge.functions import text as tx

NAMES = ["Siege of X", "SIEGE", None, "", "Herring Cape", "Newport", "October Line", "Battle of the Y",
         "Fortress Strand"]


def flags(spark, terms, word=False):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "i int, name string")
    rows = df.select("i", tx.keyword_flag("name", terms, word).alias("f")).orderBy("i").collect()
    return [r["f"] for r in rows]


def test_supply_v2_substring_semantics(spark):
    # siege hits twice (any case); null and empty are 0; "ring" hits inside "Herring";
    # "fortress" hits on Fortress
    assert flags(spark, tx.SUPPLY_V2) == [1, 1, 0, 0, 1, 0, 0, 0, 1]


def test_word_boundaries_opt_in(spark):
    assert flags(spark, tx.SUPPLY_V2, word=True) == [1, 1, 0, 0, 0, 0, 0, 0, 1]


def test_naval_vocabularies(spark):
    assert flags(spark, tx.NAVAL_V2)[5] == 1          # "port" in Newport
    assert flags(spark, tx.NAVAL_THEORY)[7] == 1      # "battle of the"
    assert flags(spark, tx.SUPPLY_THEORY)[6] == 1     # "tob" in October


def test_caller_pattern_and_literal_paths_agree(spark):
    lit = flags(spark, tx.SUPPLY_THEORY)
    rx = flags(spark, tx.keyword_pattern(tx.SUPPLY_THEORY))
    assert lit == rx


def test_vocabulary_sizes():
    sizes = {(v, k): len(t) for v, ks in tx.VOCABULARIES.items() for k, t in ks.items()}
    assert sizes == {("v2", "supply"): 26, ("v2", "naval"): 35, ("theory", "supply"): 26,
                     ("theory", "naval"): 35, ("narrow", "supply"): 23, ("narrow", "naval"): 26,
                     ("final", "supply"): 16, ("final", "naval"): 16}


def test_first_token_and_labels(spark):
    df = spark.createDataFrame([("A, B",), ("  Solo ",), (None,)], "c string")
    out = df.select(tx.first_token("c").alias("t"), tx.text_or_default("c", "Unknown").alias("d")).collect()
    assert [r["t"] for r in out] == ["A", "Solo", None]
    assert out[2]["d"] == "Unknown"
    lab = spark.createDataFrame([("supply_cut",)], "f string").select(tx.display_label("f")).first()[0]
    assert lab == "Supply Cut"
    pct = spark.createDataFrame([(0.4,), (0.0625,)], "x double").select(tx.percent_text("x")).collect()
    assert [r[0] for r in pct] == ["40.0%", "6.3%"]


def test_top_texts_read_the_text_once_for_one_row_each(spark):
    import collections
    import random
    from featurejudge.operators import encode
    pick = random.Random(4)
    values = ["a", "ab", "abc" + "x" * 100, "abc" + "x" * 101, "abc" + "x" * 99 + "a", "", "é", None]
    rows = [(i, pick.choice(values)) for i in range(400)] + [(1000 + i, f"abc{'x' * 90}{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, t string")
    counts = collections.Counter(t for _, t in rows if t is not None)
    for k in (1, 3, 7, 12, 100):
        want = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]
        kept, top = encode.top_k_texts(df, "id", "t", k, prefix_chars=2)
        assert [(r["t"], r["n"], r["rank"]) for r in top.orderBy("rank").collect()] == [(t, n, i + 1) for i, (t, n) in enumerate(want)]
        assert kept.join(top, "_h").count() == sum(n for _, n in want)
