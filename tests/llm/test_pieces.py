"""op12 against the sentencepiece library, which it reproduces."""

import hashlib
import random

import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from llm.llm_tools import duck
from panelcast.llm import q_pieces
from panelcast.llm.sentence_pieces import PieceModel, _per_text, decode, encode, piece_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(model, library, texts):
    for text, ids in zip(texts, _per_text(model, texts)):
        want = library.encode(text)
        assert ids.tolist() == want, text
        assert model.decode(ids) == library.decode(want), text


FIXED = ["", " ", "   ", "▁", "a▁b", " ▁ a", "x\0y", "a\nb\r\n\tc", "<s> a </s><unk><0x41>", "😀 é 日本語", " ﻿", "7" * 50, "ab" * 60]


def test_fixed_texts(model, library):
    same(model, library, FIXED)


@pytest.mark.parametrize("long", [8, 2048])
def test_random_texts(model, library, monkeypatch, long):
    monkeypatch.setattr("panelcast.llm.sentence_pieces.LONG", long)
    rng = random.Random(5)
    alphabets = ["ab c\n", "▁ a", "aeiounst ", "0123456789abcdef", "日本語の文 中", "é́ñ ", '<s></s>|[]{}  "\t', "".join(map(chr, range(0x20, 0x3000, 7)))]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(300, 32000)]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 90))) for _ in range(400)]
    for a in alphabets:
        texts += ["".join(rng.choice(a) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    same(model, library, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=6))
def test_any_text(texts):
    m, lib = PieceModelOnce.get()
    same(m, lib, texts)


class PieceModelOnce:
    held = None

    @classmethod
    def get(cls):
        cls.held = cls.held or (PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH))
        return cls.held


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31999) | st.integers(0, 260), max_size=8))
def test_any_ids_decode_as_the_library_does(ids):
    m, lib = PieceModelOnce.get()
    assert m.decode(ids) == lib.decode(ids)
    with pytest.raises(ValueError):
        m.decode([32000])


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "abcdefghijklm" * 20_000, "zq" + "é" * 100_000])
def test_very_long_words(model, library, text):
    same(model, library, [text])


def test_long_random_letters(model, library):
    rng = random.Random(2)
    same(model, library, ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(150_000))])


def test_query_rows(spark, make_docs, sf, library):
    texts = [None, "", "plain words here", "plain words here", "  spaces \n and\ttabs ", "<|im_end|></s>", "日本"]
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (2, "plain words here")]).selectExpr("*", "1 AS ids", "'x' AS n_tokens", "2 AS decoded_sha256")
    got = q_pieces.op12(spark, sf(documents=docs)).collect()
    want = []
    for d, t in [*enumerate(texts), (None, "no id"), (2, "plain words here")]:
        ids = library.encode(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert piece_digests(docs.limit(0), PATH).count() == 0


def test_whole_table(spark, library):
    got = {r["doc_id"]: r for r in q_pieces.op12(spark, "/root/testdata/sf0.01").collect()}
    rows = duck("SELECT doc_id, coalesce(text, '') AS text FROM documents", "/root/testdata/sf0.01")
    assert len(rows) == len(got)
    for d, t in rows.itertuples(index=False):
        ids = library.encode(t)
        assert got[d]["n_tokens"] == len(ids)
        assert got[d]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_encode_and_decode_tables(spark, make_docs):
    texts = ["some text", None, " two  spaces", "é\n"]
    ids = encode(make_docs(list(enumerate(texts))), PATH)
    back = {r["doc_id"]: r["text"] for r in decode(ids, PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).collect()[0]["text"] is None
