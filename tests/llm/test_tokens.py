"""SentencePiece encoding: against the library, and its own merging."""
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from featurejudge.llm import queries, tokens
from featurejudge.llm.common import load

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return tokens.read_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def test_encodes_like_the_library(model, library, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 50)        # the memories run over and are refilled
    monkeypatch.setattr(tokens, "MEMO_PAIRS", 300)
    encoder, pick = tokens.Encoder(model), random.Random(3)
    parts = ["a", "the", " ", "   ", " " * 17, "\n", "\t", "\r", "é", "ß", "日本", "😀", "00", "<s>", "</s>", "<0x0A>", tokens.SPACE, "\0",
             "ing", "ation", "　", "﻿", "==", "...", "\x85"]
    pieces = list(encoder.ids)
    texts = ["".join(pick.choice(parts if pick.random() < 0.6 else pieces) for _ in range(pick.randint(0, 14))) for _ in range(5_000)]
    texts += [" " * n + end for n in range(70) for end in ("", "x", "\n")] + ["", " ", "\n\n", "a" * 5_000, "ab" * 5_000, "é" * 300]
    for text in texts:
        assert encoder.encode(text) == library.encode(text), repr(text)


def test_backtracking_is_merging(model):
    encoder, pick = tokens.Encoder(model), random.Random(5)
    for _ in range(2_000):
        text = "".join(pick.choice("aabehinorst") for _ in range(pick.randint(1, 30)))
        assert encoder.pieces(text) == encoder.merge(text)


def test_pairs_by_merging_them(model):
    """The check at the border says what merging both texts says, also where scores are equal."""
    encoder, pick = tokens.Encoder(model), random.Random(6)
    pieces = list(encoder.ids)
    spaces = [p for p in pieces if not p.strip(tokens.SPACE)]
    pairs = [(pick.choice(pieces), pick.choice(pieces)) for _ in range(20_000)] + [(a, b) for a in spaces for b in spaces + pieces[300:400]]
    pairs += [(a, b) for p in pick.sample(pieces, 3_000) for k in range(1, len(p)) for a, b in [(p[:k], p[k:])] if a in encoder.ids and b in encoder.ids]
    for a, b in pairs:
        assert encoder.apart(a, b) == (encoder.merge(a + b) == [a, b]), (a, b)


def test_given_documents(spark, library):
    texts = load(spark, SF, "documents", "doc_id", "text").toPandas().set_index("doc_id")["text"]
    got = queries.QUERIES["op11_sentencepiece"](spark, SF).toPandas()
    assert sorted(got["doc_id"]) == sorted(texts.index)
    for row in got.itertuples():
        ids = library.encode(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark, odd_docs, model, library):
    got = tokens.encode(odd_docs, model)
    rows = got.select("doc_id", "ids", tokens.decode(got["ids"], model).alias("text")).collect()
    want = [(r["doc_id"], library.encode(r["text"] or ""), r["text"] or "") for r in odd_docs.collect()]
    assert sorted(map(repr, [(r["doc_id"], list(r["ids"]), r["text"]) for r in rows])) == sorted(map(repr, want))
    assert tokens.encode(odd_docs.where("false"), model).count() == 0


def test_other_normalisers_are_refused(model):
    with pytest.raises((ValueError, RuntimeError)):
        tokens.Encoder(model[:1000])
