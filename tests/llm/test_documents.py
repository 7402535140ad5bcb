"""Operators on documents: contracts, brute force, odd rows, empty tables."""
import collections
import itertools
import math
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from featurejudge.llm import (components, decontamination, language, mixing, quality_classifier, quality_rules, queries, simhash,
                              toxicity)
from featurejudge.llm.common import held_out, labelled_rows, load

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return load(spark, SF, "documents").toPandas()


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) > 4 else [" ".join(words)] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components_by_hand(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i:] ^ fps[i]) <= bits):
            a, b = find(i), find(i + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_by_hand(documents):
    for text in [*documents["text"][:60], None, "", " \n", "one", "A b C d", "a b c d e", "é\xa0x ÀB c d e f", "\x85 y z w v"]:
        assert simhash.fingerprint(text) == by_hand(text)


def test_large_shards_are_cut_again(spark, monkeypatch):
    """With a sample far too small for the corpus the shards stay small, and no link is lost."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 1_500, dtype=np.uint64)
    near = [base]
    for bits in (1, 3, 4, 5):
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in range(1_500)], dtype=np.uint64)
        near.append(base ^ flips)
    fps = np.unique(np.concatenate(near))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    monkeypatch.setattr(simhash, "LEVEL_ROWS", 400)
    sizes = []
    real = simhash.refined

    def spied(*args):
        out = real(*args)
        sizes.append(out.where("home").groupBy("tree", "shard").count().agg(F.max("count"), F.sum("count")).first())
        return out
    monkeypatch.setattr(simhash, "refined", spied)
    pairs = simhash.links(table, 4, 3, shard_rows=60, sample_rows=128).collect()
    # every fingerprint lives in one shard a tree
    assert sizes[0][0] <= 400 and sizes[0][1] == 3 * len(fps)
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in pairs:
        assert int(fps[place[r["a"]]] ^ fps[place[r["b"]]]).bit_count() <= 64
        a, b = find(place[r["a"]]), find(place[r["b"]])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == components_by_hand(fps, 4)


def test_simhash_components_by_brute_force(spark, documents):
    got = queries.QUERIES["op3_simhash"](spark, SF).toPandas().sort_values("doc_id")
    fps = np.array([int(x, 16) for x in got["fingerprint"]], np.uint64)
    ids = got["doc_id"].to_numpy()
    assert [simhash.fingerprint(t) for t in documents.sort_values("doc_id")["text"]] == fps.tolist()
    assert ids[components_by_hand(fps, 4)].tolist() == got["component_id"].tolist()


@pytest.mark.parametrize("segments,shard_rows", [(1, 40), (2, 64), (3, 30), (4, 10_000)])
def test_links_are_exact_in_dense_balls(spark, segments, shard_rows):
    rng = np.random.default_rng(segments)
    centres = rng.integers(0, 2 ** 64, 25, dtype=np.uint64)
    fps = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for c in centres for k in (0, 1, 2, 3, 4, 4, 5, 7, 8, 12)
           for _ in range(4)]
    fps = np.unique(np.array(fps, np.uint64))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r["node"]: r["root"] for r in components.components(simhash.links(table, 4, segments, shard_rows)).collect()}
    want = components_by_hand(fps, 4)
    groups, mine = collections.defaultdict(set), collections.defaultdict(set)
    for k, x in enumerate(fps.view(np.int64).tolist()):
        groups[want[k]].add(x)
        mine[got.get(x, x)].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_chain_and_ties(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_simhash_odd_rows(spark, odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    zero = {r["component_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert zero == {2}                      # null, empty and blank texts are one class
    assert {r["component_id"] for r in got if r["doc_id"] == 6} == {5}
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 2, 5, 7, 8]
    assert simhash.near_duplicates(odd_docs.where("false")).count() == 0


def test_language_held_out_accuracy(spark, documents):
    got = queries.QUERIES["op5_language"](spark, SF).toPandas().merge(documents, on="doc_id")
    out = got[got["held_out"]]
    assert len(got) == len(documents) and (out["lang"] == out["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_language_codes_and_odd_rows(spark, odd_docs):
    for n in (2, 3, 4, 7, 8, 20):
        code = language.codewords(n)
        assert len({tuple(r) for r in code}) == n and all(abs(c.sum()) < n for c in code.T)
    got = language.identify(odd_docs, F.lit(True)).collect()
    assert len(got) == odd_docs.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 4, 7)} == {"und"}
    assert [r["lang_pred"] for r in got if r["doc_id"] == 8] == ["de"]
    one = language.identify(odd_docs.where("doc_id = 1"), F.lit(True)).collect()
    assert {r["lang_pred"] for r in one} == {"en"}
    assert {r["lang_pred"] for r in language.identify(odd_docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(odd_docs.where("false"), F.lit(True)).count() == 0
    half = language.ngrams("abc " * 10)
    assert (language.ngrams("ABC," * 10) == half).all()


def test_ngrams_in_pieces(monkeypatch):
    text = "Grüße aus der Stadt, " * 50
    whole = language.ngrams(text)
    monkeypatch.setattr(language, "PIECE", 100)
    assert abs(int(language.ngrams(text).sum()) - int(whole.sum())) < 0.1 * whole.sum()


def test_toxicity_held_out(spark, documents):
    labels = load(spark, SF, "labels").toPandas()
    got = queries.QUERIES["op6_toxicity"](spark, SF).toPandas().merge(labels, on="doc_id")
    assert not ((got["predicted"] == 1) & (got["toxic"] == 0)).any()
    assert (got["predicted"] == got["toxic"]).mean() > 0.9


def test_restoring_disguised_words():
    words = ["stupid", "idiot", "moron", "trash", "pathetic", "loser", "the", "and", "people", "river", "letter", "tall"] * 5
    counts = toxicity.trigram_counts(words, np.full(len(words), 100))
    at = np.flatnonzero(counts)
    model = toxicity.CharModel.of(at, counts[at])
    for disguised, plain in {"m0r0n": "moron", "1d10t": "idiot", "stuuupid": "stupid", "tr@sh": "trash", "l0$er": "loser",
                             "s t u p i d": "stupid", "s.t.u.p.i.d": "stupid", "m-o-r-o-n": "moron", "letter": "letter"}.items():
        assert toxicity.restore(disguised, model) == plain
    scorer = toxicity.Scorer(toxicity.Model(model, {"moron": 0.9, "idiot": 0.8}, 0.1))
    assert scorer.text("you M0R0N!!") == scorer.text("what m o r o n today") == 0.9
    for spaced in ("m o r o n.", "(m o r o n)", "m  o  r  o  n", "so m\to\n r o   n, ok", "\"m o r o n!\"", "m 0 r 0 n?"):
        assert scorer.text(spaced) == 0.9, spaced
    assert toxicity.tokens("a b of c d") == {"a", "b", "of", "c", "d"} and scorer.text("- m o r o n -") == 0.9
    assert scorer.text("1d10t") == 0.8 and scorer.text("the river 2024 ### &&&") == 0.0 and scorer.text(None) == 0.0
    assert math.isfinite(scorer.text("a0" * 20_000))


def test_viterbi_by_all_paths_of_the_lattice():
    """The restored spelling is the best of all readings of the lattice."""
    words = ["stupid", "idiot", "moron", "trash", "all", "the", "tall", "a", "i", "see"]
    counts = toxicity.trigram_counts(words, np.arange(len(words)) * 7 + 3)
    at = np.flatnonzero(counts)
    model = toxicity.CharModel.of(at, counts[at])

    def cost(reads):
        total, x, y = 0.0, 0, 0
        for read, price in reads:
            total -= price
            if read == " ":
                if y == 0:
                    return None
                total += model.log_p(x, y, 0)
                x = y = 0
            else:
                for z in map(toxicity.class_of, read):
                    total += model.log_p(x, y, z)
                    x, y = y, z
        return total + model.log_p(x, y, 0)
    for token in ["m0r0n", "1d10t", "stuuupid", "tr@sh", "s.t.u", "a11", "t4ll", "i d i", "!!!", "5ee", "$$a", "7ra5h", "a..b", "l0$er"]:
        paths = itertools.product(*toxicity.lattice(token))
        best = max(c for c in map(cost, paths) if c is not None)
        reading = toxicity.restore(token, model)
        same = [c for p in itertools.product(*toxicity.lattice(token)) if "".join(r for r, _ in p) == reading for c in [cost(p)] if c is not None]
        assert max(same) == pytest.approx(best, abs=1e-9), token


def test_prefixes_give_way_to_words():
    assert toxicity.specific({"loser": (340, 0.9), "lose*": (342, 0.8), "lowei*": (900, 0.9), "loweia": (50, 0.9)}).keys() \
        == {"loser", "lowei*", "loweia"}


def test_toxicity_looks_up_only_words_that_begin_like_a_feature(monkeypatch):
    words = ["banana", "table", "loser", "losers", "moronic", "abc", "abcd", "l" + "o" * 60]
    counts = toxicity.trigram_counts(words, np.full(len(words), 100))
    at = np.flatnonzero(counts)
    weight = {"lose*": 0.9, "abc": 0.5, "moroni*": 0.7, **{f: 0.8 for f in toxicity.features("x" * 20 + "y" * 40)[:1]}}
    scorer = toxicity.Scorer(toxicity.Model(toxicity.CharModel.of(at, counts[at]), weight, 0.1))
    texts = [*words, "l0sers", "m0ronic", "a b c", "xyxy" * 15, "x" * 20 + "y" * 40, "banana table", "losing", ""]
    want = [max((weight.get(f, 0.0) for t in toxicity.tokens(x) for w in scorer.restorer.words(t) for f in toxicity.features(w)), default=0.0) for x in texts]
    asked, named = [], toxicity.features
    monkeypatch.setattr(toxicity, "features", lambda word: (asked.append(word), named(word))[1])
    assert [scorer.text(x) for x in texts] == want and max(want) == 0.9 and 0.8 in want
    assert not {"banana", "table", "losing", "abcd"} & set(asked) and {"losers", "abc", "moronic"} <= set(asked)


def test_toxicity_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (8, 0), (5, 0), (None, 1), (6, None), (99, 1), (4, 0)], "doc_id long, toxic int")
    got = toxicity.score(odd_docs, labels, F.lit(True)).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (2, 3, 4)} == {0.0}
    assert toxicity.score(odd_docs, labels.where("false"), F.lit(True)).count() == odd_docs.count()
    assert toxicity.score(odd_docs.where("false"), labels, F.lit(True)).count() == 0


def test_labelled_rows_are_bounded(spark):
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)] * 2, "doc_id long, toxic int")
    got = labelled_rows(docs, labels, "toxic", rows=40).groupBy("label").count().collect()
    assert all(r["count"] == 40 for r in got) and len(got) == 2
    picked = [{r["doc_id"] for r in labelled_rows(docs, some, "toxic", rows=40).collect()} for some in (labels, labels.repartition(7), labels.orderBy(F.desc("doc_id")))]
    assert picked[0] == picked[1] == picked[2]
    assert labelled_rows(docs, labels, "toxic", rows=1000).count() == 300


def test_leaks_by_brute_force(spark, documents):
    bench = load(spark, SF, "benchmark").toPandas()
    want = {(d, i) for d, text in zip(documents["doc_id"], documents["text"]) for i, item in zip(bench["item_id"], bench["text"])
            if " ".join(item.split()) in " ".join(text.split())}
    got = queries.QUERIES["op2_decontamination"](spark, SF)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    shuffled = decontamination.leaks(load(spark, SF, "documents"), load(spark, SF, "benchmark"), broadcast_bytes=0)
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, got.collect()))


def test_reparameterised_questions(spark, odd_docs):
    item = "A train leaves Boston at 60 km and another train follows at 60 km from Chicago after 3 hours of waiting"
    other = item.replace("60", "75").replace("3 hours", "4 days").replace("Chicago", "Denver")
    broken = item.replace("at 60 km and", "at 75 km and").replace("at 60 km from", "at 80 km from")
    docs = spark.createDataFrame([(1, f"Intro text, {other}."), (2, f"Noise here. {broken} end"), (3, item), (3, item), (4, None), (5, ""),
                                  (6, "numbers 1 2 3 4 5 6 7 8 9 10 11 12"), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (10, item), (11, None), (12, "too short"), (None, item)], "item_id long, text string")
    for limit in (0, 1 << 20):
        got = {r["doc_id"]: r for r in decontamination.leaks(docs, bench, broadcast_bytes=limit).collect()}
        assert set(got) == {1, 3, None}      # 60 stands against 75 and 80 in document 2
        assert got[1]["n_changed"] >= 3 and got[3]["n_changed"] == 0 and got[3]["share"] == 1.0
    kept = decontamination.decontaminate(docs, bench)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2, 4, 5, 6] and kept.columns == docs.columns
    assert decontamination.leaks(odd_docs, bench).count() == 0
    assert decontamination.leaks(docs.where("false"), bench).count() == decontamination.leaks(docs, bench.where("false")).count() == 0


def rules_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    spots = collections.defaultdict(list)
    for i in range(len(words) - 7):
        spots[tuple(words[i:i + 8])].append(i)
    covered = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_base_rules_by_hand(spark, documents):
    texts = [*documents["text"], None, "", " ", "a " * 9, "x y " * 30 + "end\nend\n end", "#* %\n\n#* %\r\n", "w" * 70_000]
    table = spark.createDataFrame([(k, "s", t) for k, t in enumerate(texts)], "doc_id long, source string, text string")
    for r in quality_rules.judge(table).collect():
        mine = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert mine == rules_by_hand(texts[r["doc_id"]]), r["doc_id"]
        assert r["base_failed"] == (mine[0] < 20 or 100 * mine[4] > 30 * mine[0])


def lines_by_hand(rows, max_docs, max_docs_long, max_share):
    """Words removed from each (doc_id, source, text)."""
    norm = lambda line: " ".join(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
    texts, held = collections.defaultdict(set), collections.defaultdict(set)
    for _, source, text in rows:
        texts[source].add(text)
        for line in (text or "").split("\n"):
            held[source, norm(line)].add(text)
    out = collections.defaultdict(list)
    for doc_id, source, text in rows:
        gone = 0
        for line in map(norm, (text or "").split("\n")):
            n, words = len(held[source, line]), len(line.split())
            if n > 1 and (n > (max_docs_long if words >= quality_rules.LONG_LINE else max_docs) or n > max_share * len(texts[source])):
                gone += words
        out[doc_id].append(gone)
    return {k: sorted(v) for k, v in out.items()}


def test_common_lines_deplete(spark, odd_docs):
    own = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(40)]
    menu = " ".join(f"Menu{j}" for j in range(30))
    rows = [(k, "a", f"{own[k]}\n{menu.upper()}") for k in range(20)] + [(100 + k, "a", f"{menu}\nx{k} y\n{menu}  ") for k in range(5)] \
        + [(200 + k, "b", f"{menu}\n{own[k]}") for k in range(10)] + [(0, "a", f"{own[0]}\n{menu.upper()}")] \
        + [(300 + k, "c", f"{menu}\n{own[0]}") for k in range(30)] + [(400, "c", own[1])]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r["doc_id"]: r for r in quality_rules.judge(table).collect()}
    assert all(got[k]["n_removed"] == 30 and got[k]["kept"] for k in range(20))
    assert all(got[100 + k]["n_removed"] == 60 and not got[100 + k]["kept"] for k in range(5))
    assert all(got[200 + k]["n_removed"] == 30 and got[200 + k]["kept"] for k in range(10))
    assert all(got[300 + k]["n_removed"] == 0 and got[300 + k]["kept"] for k in range(30))     # exact copies are one document
    odd = quality_rules.judge(odd_docs)
    assert odd.count() == odd_docs.count() and quality_rules.judge(odd_docs.where("false")).count() == 0


def test_limits_do_not_grow_with_a_hot_host(spark):
    """A banner in 1 % of a large host goes, in any host; so does a short line
    in 11 documents, or in over 5 % of a small host."""
    banner, short = " ".join(f"b{j}" for j in range(60)), "read on here"
    rows = [(k, "hot", f"text {k}" + (f"\n{banner}" if k % 100 == 0 else "") + (f"\n{short}" if k % 300 == 1 else "")) for k in range(2_000)]
    rows += [(3_000 + k, "small", f"word {k}" + (f"\n{short}" if k < 3 else "")) for k in range(50)]
    rows += [(4_000 + k, "small", f"word {k + 50}\nrare line") for k in range(2)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r["doc_id"]: r["n_removed"] for r in quality_rules.judge(table).collect()}
    want = lines_by_hand(rows, quality_rules.MAX_DOCS, quality_rules.MAX_DOCS_LONG, quality_rules.MAX_SHARE)
    assert got == {k: v[0] for k, v in want.items()}
    assert got[0] == 60 and got[1] == 0 and got[3_000] == 3 and got[4_000] == 0


def test_some_documents_are_depleted(spark, documents):
    got = queries.QUERIES["op7_quality_rules"](spark, SF).toPandas().set_index("doc_id")
    want = lines_by_hand([(r.doc_id, r.source, r.text) for r in documents.itertuples()], quality_rules.MAX_DOCS, quality_rules.MAX_DOCS_LONG,
                         quality_rules.MAX_SHARE)
    assert got["n_removed"].to_dict() == {k: v[0] for k, v in want.items()}
    assert got["n_removed"].sum() > 1_000
    large = queries.QUERIES["op7_quality_rules"](spark, "/root/testdata/sf0.1")
    depleted = large.where("NOT base_failed AND NOT kept").collect()
    assert len(depleted) > 5 and all(r["n_words"] - r["n_removed"] < quality_rules.MIN_LEFT * r["n_words"] for r in depleted)


def test_quality_held_out(spark):
    labels = load(spark, SF, "labels").toPandas()
    got = queries.QUERIES["op9_quality_classifier"](spark, SF).toPandas().merge(labels, on="doc_id")
    out = got[got["held_out"]]
    assert (out["predicted"] == out["quality"]).mean() > 0.95 and got["score"].between(0, 1).all()


def test_quality_rules_compile_and_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (8, 1), (5, 0), (None, 1), (4, 0), (99, 1), (6, None)], "doc_id long, quality int")
    for some in (labels, labels.where("quality = 1"), labels.where("false")):
        got = quality_classifier.score(odd_docs, some, F.lit(True)).collect()
        assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality_classifier.score(odd_docs.where("false"), labels, F.lit(True)).count() == 0
    rule = quality_classifier.Rule((("words", "<=", 2.0), ("upper", ">", 0.5)), 3.0)
    both = quality_classifier.Ensemble((rule,), -1.0)
    row = spark.createDataFrame([(1.0, 0.6), (3.0, 0.6)], "words double, upper double").select(both.score().alias("s")).collect()
    assert [round(r["s"], 6) for r in row] == [round(1 / (1 + math.exp(-x)), 6) for x in (2.0, -1.0)]


@pytest.mark.parametrize("entropy,repeat,share", [(0.98, 4.0, 1.0), (1.0, 1.2, 1.0), (0.9, 8.0, 0.5), (0.999, 3.0, 2.5)])
def test_mixing_keeps_budgets(spark, entropy, repeat, share):
    rows = [(k, "w " * (1 + k % 7), "big" if k % 3 else f"s{k % 5}") for k in range(1500)] + [(9000, "a b", None), (9001, None, "big"), (9002, "", "void")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sums = collections.Counter()
    for _, t, s in rows:
        sums[s] += len((t or "").split())
    total = int(sum(sums.values()) * share)
    plan = mixing.budgets(dict(sums), total, entropy, repeat)
    assert sum(b for _, b in plan.values()) == total and "void" not in plan
    got = mixing.mix(docs, budget_share=share, target_entropy=entropy, max_repeat=repeat, block_rows=50).toPandas()
    used = got.groupby(got["source"].fillna("-"))["n_tokens"].sum()
    copies = got.groupby("doc_id").size()
    for s, (w, budget) in plan.items():
        mine = used.get(s or "-", 0)
        assert budget - 14 < mine <= budget, s                 # within two documents
        ids = [k for k, t, x in rows if x == s and t]
        seen = copies.reindex(ids, fill_value=0)
        assert seen.max() - seen.min() <= 1                    # whole passes and one partial
    assert not got.duplicated(["doc_id", "repeat"]).any()
    if repeat * sum(sums.values()) > total * 1.01:
        assert max(b / sums[s] for s, (_, b) in plan.items()) <= repeat + 1


def test_passes_are_permutations(spark):
    """Positions have no gap, passes differ in blocks and in documents, and the
    partial pass is the beginning of the permutation that a larger budget shows whole."""
    rows = [(k if k % 9 else None, "w " * (1 + k % 7), "big" if k % 3 else f"s{k % 5}") for k in range(1500)] + [(77, "a b", "big")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def order(share):
        got = mixing.mix(docs, budget_share=share, target_entropy=0.0, max_repeat=9.0, block_rows=20).toPandas()
        out = {}
        for (s, r), part in got.groupby(["source", "repeat"]):
            part = part.sort_values("position")
            assert part["position"].tolist() == list(range(len(part)))
            assert part["block"].is_monotonic_increasing and part["block"].value_counts().max() < 120
            out[s, r] = part["doc_id"].fillna(-1).tolist()
        return out
    some, more = order(2.4), order(3.0)
    assert {r for _, r in some} == {0, 1, 2} and len(more["big", 2]) == sum(s == "big" for _, _, s in rows)
    for (s, r), ids in some.items():
        assert ids == more[s, r][:len(ids)] and (r < 2) == (len(ids) == len(more[s, r]))
    assert more["big", 0] != more["big", 1] != more["big", 2] and sorted(more["big", 0]) == sorted(more["big", 1])
    at = [{d: i for i, d in enumerate(more["big", r])} for r in (0, 1)]
    unique = [d for d in at[0] if d not in (-1, 77)]
    assert abs(np.corrcoef([at[0][d] for d in unique], [at[1][d] for d in unique])[0, 1]) < 0.2


def test_block_places_are_bijections(spark):
    for k in range(6):
        blocks = 1 << k
        got = spark.range(blocks).select(mixing.permuted(F.col("id"), F.lit(blocks).cast("long"), F.lit(3), F.lit(1).cast("long"), 5).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(blocks))


@pytest.mark.parametrize("share,entropy,repeat", [(1.0, 0.9, 4.0), (0.3, 0.99, 2.0), (2.0, 1.0, 1.5), (1.0, 0.0, 4.0)])
def test_many_sources_are_planned_alike(spark, share, entropy, repeat):
    rows = [(f"s{k}" if k else None, 1 + k % 5, (k * k * 37) % 5_000 + (k > 0)) for k in range(60)]
    sums = spark.createDataFrame(rows, "source string, n long, tokens long")
    here, there = (sorted(((r["source"] or ""), r["n"], r["tokens"], round(r["source_weight"], 12), r["budget"])
                          for r in mixing.source_plan(sums, share, entropy, repeat, limit).collect()) for limit in (100, 5))
    assert here == there


def test_exponent_by_trying_all(monkeypatch):
    """The bisected exponent is the one that a scan of the whole grid finds."""
    monkeypatch.setattr(mixing, "GRID", 400)
    rng = np.random.default_rng(3)
    for _ in range(40):
        tokens = {f"s{k}": int(n) for k, n in enumerate(rng.integers(0, 10_000, rng.integers(2, 9)))}
        tokens["x"], budget, target, limit = 1, int(sum(tokens.values()) * rng.choice([0.5, 1, 3])), float(rng.choice([0.5, 0.9, 1.0])), float(rng.choice([1.2, 3, 50]))
        n = sum(v > 0 for v in tokens.values())
        flat = max(k for k in range(401) if mixing.entropy(mixing.weights(tokens, k / 400)) >= target * math.log(n) - 1e-12)
        within = [k for k in range(flat, 401) if max(w * budget / tokens[s] for s, w in mixing.weights(tokens, k / 400).items()) <= limit + 1e-12]
        assert mixing.exponent_for(tokens, budget, target, limit) == (min(within) if within else 400) / 400


def test_mixing_odd_rows(spark, odd_docs):
    got = mixing.mix(odd_docs)
    assert set(got.columns) == {"doc_id", "source", "n_tokens", "repeat", "block", "position", "source_weight"} and got.count() > 0
    assert mixing.mix(odd_docs.where("false")).count() == 0 and mixing.mix(odd_docs.where("doc_id = 2")).count() == 0
    flat = mixing.exponent_for({"a": 1000, "b": 10}, 1010, 1.0, 1e9)
    assert flat == 0.0 and mixing.exponent_for({"a": 1000, "b": 10}, 1010, 0.0, 4.0) == 1.0


def test_pipeline_stages(spark, odd_docs):
    docs = load(spark, SF, "documents")
    before = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "mixing":
            assert after.columns == docs.columns
        after = after.cache()
        ids = {r["doc_id"] for r in after.collect()}
        assert ids <= before
        if name == "simhash_dedup":
            groups = simhash.near_duplicates(docs).toPandas()
            assert ids == set(groups["component_id"])
        if name == "decontamination":
            leaked = decontamination.leaks(docs, load(spark, SF, "benchmark")).toPandas()["doc_id"]
            assert ids == before - set(leaked)
        if name == "toxicity":
            toxic = {r["doc_id"] for r in load(spark, SF, "labels").where("toxic = 0").collect()} & before
            assert toxic <= ids                                 # no clean document goes
        before, docs = ids, after
    odd = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, SF)
        assert odd.count() >= 0
    empty = odd_docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_held_out_is_crc(spark):
    import zlib
    got = spark.range(200).select("id", held_out(F.col("id"), 5, 0).alias("o")).collect()
    assert all(r["o"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def rare_worded(spark, clean=1600, toxic=200):
    """Documents of mostly rare words; every toxic one has one of three words that no clean one has."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(6000)]
    rows = [(k, " ".join(rng.choice(vocabulary, 40)) + (f" {['grobian', 'schuft', 'lump'][k % 3]}" if k < toxic else ""), int(k < toxic))
            for k in range(clean + toxic)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()


def test_capped_labels_keep_their_shares(spark):
    table = rare_worded(spark)
    got = labelled_rows(table, table, "toxic", rows=200).groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    n, w = {r["label"]: r["n"] for r in got}, {r["label"]: r["w"] for r in got}
    assert abs(w[1] / (w[0] + w[1]) - 200 / 1800) < 1e-9 and abs(w[0] + w[1] - n[0] - n[1]) < 1e-6
    assert {r["weight"] for r in labelled_rows(table, table, "toxic").collect()} == {1.0}
    flagged = {}
    for rows in (200, 10_000):
        model = toxicity.fit(table, labelled_rows(table, table, "toxic", rows=rows))
        scores = table.select("toxic", toxicity.score_column(spark, model)("text").alias("score"))
        flagged[rows] = {r["toxic"]: r["n"] for r in scores.where("score >= 0.7").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    assert flagged[10_000].get(0, 0) <= 5 and flagged[200].get(0, 0) <= 5, flagged
    assert flagged[200].get(1, 0) >= 0.9 * flagged[10_000][1] > 150


def test_only_copies_of_one_label_count_once(spark):
    rng = np.random.default_rng(4)
    rare = [[f"w{x}" for x in rng.integers(0, 10 ** 6, 120)] for _ in range(40)]
    texts = [" ".join(["it is in the town"] * 3 + words) for words in rare]            # common shingles, other texts
    near = " ".join([*texts[0].split()[:-3], "other", "last", "words"])
    rows = [(k, k % 2, t) for k, t in enumerate(texts)] + [(40, 0, near), (41, 0, texts[0]), (42, 1, texts[0]), (43, 1, "one"), (44, 1, "one")]
    table = spark.createDataFrame(rows, "row long, label int, text string")
    kept = {r["row"] for r in toxicity.one_of_copies(table.withColumn("doc_id", F.col("row"))).collect()}
    assert kept == {*range(40), 42, 43}


def test_slot_heavy_short_and_edited_items(spark):
    heavy = "Compute 3, 5, 8, 13, 21, 34, 55, 89, 144, 233 and give the sum of the list"
    edited = "the old miller walked along a narrow path beside green water until evening came down"
    bench = spark.createDataFrame([(1, heavy), (2, "Name the capital of Peru"), (3, edited), (4, "1 2 3 4 5 6 7 8 9 10")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([
        (1, f"Homework: {heavy}."), (2, "He said, Name the capital of Peru today"), (3, "Name the capital of Chile"),
        (4, "so " + edited.replace("path", "road") + " again"), (5, "x 1 2 3 4 5 6 7 8 9 10 y"), (6, "x 1 2 3 4 5 6 7 8 9 11 y"),
        (7, "the next 7, 9 and give the sum of the list")], "doc_id long, text string")
    for limit in (0, 1 << 20):
        got = decontamination.leaks(docs, bench, broadcast_bytes=limit).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (2, 2), (4, 3), (5, 4)}
        assert [r["share"] for r in got if r["doc_id"] == 1] == [1.0]


def test_a_dump_of_items_costs_its_length(spark):
    """Many items in one document: all are found, and the document is not copied for each."""
    def item(k):
        return " ".join(f"w{(k * 31 + j * j) % 997}x{j}" for j in range(20))

    def seconds(n):
        bench = spark.createDataFrame([(k, item(k)) for k in range(n)], "item_id long, text string")
        docs = spark.createDataFrame([(1, " and then ".join(item(k) for k in range(n)))], "doc_id long, text string")
        began = time.perf_counter()
        assert sorted(r["item_id"] for r in decontamination.leaks(docs, bench).collect()) == list(range(n))
        return time.perf_counter() - began
    seconds(20)
    few = seconds(50)
    assert seconds(400) < 2 * few + 1


def test_tiny_items_are_listed_not_found(spark):
    bench = spark.createDataFrame([(1, "the"), (2, "a b c"), (3, "one two three four"), (4, "electroencephalography machinery"), (5, None), (6, "")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "the a b c d"), (2, "say one two three four five"), (3, "an electroencephalography machinery here")],
                                 "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()} == {(2, 3), (3, 4)}
    assert {r["item_id"]: r["n_words"] for r in decontamination.unjudged_items(bench).collect()} == {1: 1, 2: 3, 5: 0, 6: 0}
