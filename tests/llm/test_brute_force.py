"""Learned operators against plain Python on the same model."""
import collections
import math
import statistics
import zlib

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from featurejudge.llm import language, quality_classifier, url_filter
from featurejudge.llm.common import load

SF = "/root/testdata/sf0.01"


def plain_ngrams(text, bits):
    """Hashed byte bigrams and trigrams of a text, counted one by one."""
    raw = (" " + text.lower() + " ").encode("utf-8")
    b = [c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in raw]
    out = collections.Counter()
    for i in range(len(b) - 1):
        if b[i:i + 2] != [0x20, 0x20]:
            out[((b[i] << 8 | b[i + 1]) + 0x51000000) * 2246822519 % 2 ** 32 >> 32 - bits] += 1
    for i in range(len(b) - 2):
        if b[i:i + 3] != [0x20] * 3:
            out[(b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 % 2 ** 32 >> 32 - bits] += 1
    return out


def test_language_by_a_plain_decoder(spark):
    docs = load(spark, SF, "documents", "doc_id", "text", "lang")
    model = language.fit(docs.where("doc_id % 2 = 0"))
    texts = [r["text"] for r in docs.where("doc_id % 25 = 1 AND length(text) < 4000").collect()]
    texts += ["a", "der the", "el la der the le", "zzz qqq", "É", "x" * 50]
    got = model.predict(texts)
    weights, trust = model.weights.astype(float), model.trust
    for text, lang, score, unsure in zip(texts, got["lang"], got["score"], got["ambiguous"]):
        grams = plain_ngrams(text, model.bucket_bits)
        total = sum(grams.values())
        losses = []
        for k in range(len(model.langs)):
            loss = 0.0
            for bit in range(model.code.shape[1]):
                margin = sum(n * weights[g, bit] for g, n in grams.items()) / max(total, 1)
                loss += trust[k, bit] * math.log1p(math.exp(min(max(-model.code[k, bit] * margin, -30), 30)))
            losses.append(loss)
        order = sorted(losses)
        assert losses[model.langs.index(lang)] == pytest.approx(order[0], abs=1e-4)
        p = [math.exp(-language.SHARPNESS * (x - order[0])) for x in losses]
        assert score == pytest.approx(max(p) / sum(p), abs=2e-3)
        if abs(order[1] - order[0] - language.AMBIGUITY) > 1e-4:
            assert unsure == (order[1] - order[0] < language.AMBIGUITY)


def plain_urls(rows):
    """(score, verdict) of each (page_id, host, path, ruled) by models in dictionaries."""
    order = url_filter.ORDER

    def chars(host, path):
        return "^" * order + (host + path.lower()).translate(str.maketrans("123456789", "0" * 9)) + "$"

    def fold(page, ruled):
        return "new" if ruled is None else "calibrate" if page is not None and zlib.crc32(str(page).encode()) % 5 == 0 else "learn"
    counts = {x: collections.Counter() for x in ("allow", "block")}
    for page, host, path, ruled in rows:
        if fold(page, ruled) == "learn":
            t = chars(host, path)
            for i in range(order, len(t)):
                for k in range(order + 1):
                    counts[ruled][t[i - k:i + 1]] += 1
    behind = {x: collections.defaultdict(list) for x in counts}
    for x, c in counts.items():
        for g, n in c.items():
            behind[x][g[:-1], len(g)].append(n)

    def p(x, g):
        if not g:
            return 1 / url_filter.ALPHABET
        same = behind[x].get((g[:-1], len(g)), [])
        mass = sum(same) + len(same)
        return (counts[x][g] + len(same) * p(x, g[1:])) / mass if mass else p(x, g[1:])

    def score(host, path):
        t = chars(host, path)
        diffs = [math.log(p("allow", t[i - order:i + 1])) - math.log(p("block", t[i - order:i + 1])) for i in range(order, len(t))]
        return sum(diffs) / len(diffs)
    scores = [score(host, path) for _, host, path, _ in rows]
    limit = None
    for folds in (("calibrate",), ("calibrate", "learn")):
        side = {x: [s for s, (page, _, _, ruled) in zip(scores, rows) if ruled == x and fold(page, ruled) in folds] for x in counts}
        if all(side.values()):
            (a, da), (b, db) = ((statistics.fmean(side[x]), max(statistics.pstdev(side[x]), 1e-6)) for x in ("allow", "block"))
            limit = (a * db + b * da) / (da + db)
            break
    return [(s, ruled or ("allow" if limit is None or s >= limit else "block")) for s, (_, _, _, ruled) in zip(scores, rows)], limit


@pytest.mark.parametrize("where", ["page_id % 3 > 0", "page_id % 60 = 5"])
def test_url_scores_threshold_and_verdicts(spark, where):
    pages = load(spark, SF, "pages", "page_id", "url").where(where)
    pages = pages.unionByName(pages.where("page_id % 5 = 0"))
    got = url_filter.judge(pages).collect()
    verdicts = {rule: v for v, rule in url_filter.RULES}
    rows = [(r["page_id"], r["host"], r["path"], verdicts.get(r["rule"])) for r in got]
    want, limit = plain_urls(rows)
    for r, (score, verdict) in zip(got, want):
        assert r["score"] == pytest.approx(score, abs=2e-6)
        if r["rule"] or limit is None or abs(score - limit) > 1e-9:
            assert r["verdict"] == verdict
    assert any(r["rule"] is None for r in got)


def holds(terms, row):
    return all(row[f] <= v if sign == "<=" else row[f] > v for f, sign, v in terms)


def test_rules_are_the_paths_of_the_trees(spark):
    """A path's conditions hold for just the rows that the tree sends that way,
    and the leaves' paths give the trees' own predictions."""
    table = quality_classifier.with_statistics(load(spark, SF, "documents", "doc_id", "text").where("doc_id % 3 = 0"))
    labels = load(spark, SF, "labels", "doc_id", "quality")
    data = table.join(labels, "doc_id").select("doc_id", F.col("quality").cast("double").alias("label"), *quality_classifier.FEATURES,
                                               array_to_vector(F.array(*quality_classifier.FEATURES)).alias("x")).cache()
    model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=5, maxDepth=3, seed=1, minInstancesPerNode=3).fit(data)
    rows = [r.asDict() for r in data.drop("x").collect()]

    def walk(node, row, seen):
        if node.subtreeDepth() == 0:
            return node.prediction()
        split = node.split()
        f, v = quality_classifier.FEATURES[split.featureIndex()], split.threshold()
        left = row[f] <= v
        seen.append((f, "<=" if left else ">", v))
        return walk(node.leftChild() if left else node.rightChild(), row, seen)
    raw = {r["doc_id"]: r["rawPrediction"][1] for r in model.transform(data).select("doc_id", "rawPrediction").collect()}
    trees = list(model._java_obj.trees())
    found = [quality_classifier.paths(t.rootNode()) for t in trees]
    assert any(found)
    for row in rows[:60]:
        total = 0.0
        for tree, rules, weight in zip(trees, found, model.treeWeights):
            way: list = []
            total += weight * walk(tree.rootNode(), row, way)
            met = {r for r in rules if holds(r, row)}
            # every node on the way has its rule, and no other node's rule holds
            prefixes = set()
            for k in range(1, len(way) + 1):
                strict: dict = {}
                for f, sign, v in way[:k]:
                    strict[f, sign] = v if (f, sign) not in strict else (min if sign == "<=" else max)(strict[f, sign], v)
                prefixes.add(tuple(sorted((f, s, v) for (f, s), v in strict.items())))
            assert met == prefixes
        assert raw[row["doc_id"]] == pytest.approx(total, abs=1e-9)


def test_rule_scores_by_plain_evaluation(spark, monkeypatch):
    """The compiled column expression gives what the rules say, row by row (a weak lasso leaves many)."""
    monkeypatch.setattr(quality_classifier, "LASSO", 1e-7)
    table = quality_classifier.with_statistics(load(spark, SF, "documents", "doc_id", "text"))
    labels = load(spark, SF, "labels", "doc_id", "quality").withColumnRenamed("doc_id", "id")
    learning = table.join(labels, F.col("doc_id") == F.col("id")).select(F.col("quality").alias("label"), F.lit(1.0).alias("weight"), *quality_classifier.FEATURES)
    model = quality_classifier.fit(learning)
    assert len(model.rules) > 1 and all(r.weight for r in model.rules)
    got = table.withColumn("score", model.score()).collect()
    assert len(got) == 1000
    for r in got:
        total = model.intercept + math.fsum(rule.weight for rule in model.rules if holds(rule.terms, r.asDict()))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
    assert np.ptp([r["score"] for r in got]) > 0.3
