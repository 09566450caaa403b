"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from threatframe.llm import piece_bpe, queries
from threatframe.llm.common import Memory, table

MODEL, SF = public_tokenizers.path("piece_bpe_32k.model"), "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return piece_bpe.PieceBpe.of(MODEL)


def test_query(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op11_sentencepiece"](spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert tuple(got[r.doc_id])[1:] == want


def test_odd_texts(coder, library):
    r, known = random.Random(1), Memory(coder.code, limit=20_000)
    parts = [*"abcdefgh THE'sé ñ漢字🙂 \n\t0123.,!-_▁\0\r", "  ", "   ", "́", "ﬁ", "ا", "", "﻿", " ", "ing", "the", "▁▁▁"]
    for _ in range(1500):
        text = "".join(r.choices(parts, k=r.randint(0, 200)))
        ids = library.encode(text)
        assert np.frombuffer(coder.encode(text, known), "<i4").tolist() == ids
        assert coder.decode(ids) == library.decode(ids)


def test_any_ids_decode_like_the_library(coder, library):
    r = random.Random(2)
    for _ in range(1500):
        ids = [r.randrange(32_000) if r.random() < 0.5 else r.randrange(270) for _ in range(r.randint(0, 30))]
        assert coder.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 100_000, "ab" * 50_000, " " * 50_000, "z9" * 50_000, "x" * 400_000, "é\n" * 30_000])
def test_long_words(coder, library, text):
    assert np.frombuffer(coder.encode(text, Memory(coder.code)), "<i4").tolist() == library.encode(text)


def test_search_steps_back():
    """Merges b c before a b, so the longest piece at the start fails: the search takes it back."""
    coder = object.__new__(piece_bpe.PieceBpe)
    coder.ranks = {"bc": 0, "ab": 1, "abd": 2, "a": 3, "b": 4, "c": 5, "d": 6}
    coder.texts = [p for p in coder.ranks if piece_bpe.merged(p, coder.ranks) == [p]]
    number = {p: t for t, p in enumerate(coder.texts)}
    coder.size, coder.pairs = [len(p) for p in coder.texts], {}
    coder.shorter = [next((number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in number), -1) for p in coder.texts]
    coder.matches = piece_bpe.ahocorasick.Automaton()
    coder.single = {p: t for p, t in number.items() if len(p) == 1}
    for p, t in number.items():
        if len(p) > 1:
            coder.matches.add_word(p, t)
    coder.matches.make_automaton()
    r = random.Random(3)
    for text in ["abc", "abd", "abcabd", *("".join(r.choices("abcd", k=r.randint(1, 12))) for _ in range(500))]:
        assert [coder.texts[t] for t in coder.search(text)] == piece_bpe.merged(text, coder.ranks)


def test_cases(spark, library):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (4, "one two"), (None, "n  n"), (5, "word " * 500_000), (6, "▁a b")]
    docs = spark.createDataFrame([(d, t, [1], "x") for d, t in rows], "doc_id int, text string, ids array<int>, plain string")
    got = piece_bpe.decode(piece_bpe.encode(docs, MODEL), MODEL).collect()
    assert sorted((str(r.doc_id), list(r.ids), r.text) for r in got) == sorted((str(d), library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in rows)
    assert piece_bpe.decode(piece_bpe.encode(docs.limit(0), MODEL), MODEL).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in piece_bpe.decode(none, MODEL).collect()} == {1: None, 2: ""}
    assert docs.select(F.max("doc_id")).first()[0] == 6
