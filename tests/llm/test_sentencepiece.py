"""Merges against a plain search for the best pair, and whole texts against the library."""

import itertools
import random

import public_tokenizers
import pytest
import sentencepiece
from tests.llm.helpers import documents, frame
from pyspark.sql import functions as F

from crashlake.llm import op11_sentencepiece as sp

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  two  spaces ", "\x00 <0x0A> <s> </s> <unk> ▁x▁ ▁▁▁", "日本語 е́ 🙂\U0010ffff", "\n\n\t\r", "a" * 3000, " " * 70 + "b", "12345 67.8%", "ﬁ ½ Å"]


def plain(symbols, cost):
    """Merges the best adjacent pair, the leftmost first, until none is a piece."""
    symbols = list(symbols)
    while True:
        found = [(cost(a + b), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if cost(a + b) is not None]
        if not found:
            return symbols
        i = min(found)[1]
        symbols[i:i + 2] = ["".join(symbols[i:i + 2])]


def test_agenda_merges_the_best_pair_first():
    rng = random.Random(3)
    for _ in range(300):
        vocabulary = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))): rng.randint(0, 3) for _ in range(12)}
        text = [rng.choice("abc") for _ in range(rng.randint(0, 25))]
        assert sp.agenda(list(text), vocabulary.get) == plain(text, vocabulary.get)


@pytest.mark.parametrize("known", [1 << 18, 3])
def test_texts_as_the_library(monkeypatch, known):
    monkeypatch.setattr(sp, "KNOWN", known)
    encoder = sp.Encoder(open(MODEL, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab ▁é\n1日") for _ in range(rng.randint(1, 200))) for _ in range(100)]
    assert encoder.encode(texts) == library.encode(texts, add_eos=True)
    assert encoder.encode(texts[::-1]) == library.encode(texts[::-1], add_eos=True)
    assert len(encoder) <= known


def test_rows_of_a_table(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = documents()
    docs = frame(spark, rows)
    got = docs.select("doc_id", F.col("text").alias("t"), sp.encode_decode(F.col("text"), MODEL, spark).alias("x")).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.t or "", add_eos=True)
        assert r.x.ids == ids and r.x.text == library.decode(ids)
    assert docs.where("false").select(sp.encode_decode("text", MODEL, spark).alias("x")).collect() == []


def test_all_given_documents(spark):
    """Every text of the small tables, whole, against the library."""
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in docs.select(F.col("text").alias("t"), sp.encode_decode("text", MODEL, spark).alias("x")).collect():
        assert r.x.ids == library.encode(r.t or "", add_eos=True)


def test_a_difference_from_the_library_is_an_error(monkeypatch):
    monkeypatch.setattr(sp, "agenda", lambda symbols, cost: symbols)
    encoder = sp.Encoder(open(MODEL, "rb").read())
    with pytest.raises(ValueError):
        encoder.encode(["a thing"])


def test_a_word_is_worked_out_once_whatever_signs_follow_it(monkeypatch):
    encoder = sp.Encoder(open(MODEL, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    worked, agenda = [], sp.agenda
    monkeypatch.setattr(sp, "agenda", lambda symbols, cost: worked.append("".join(symbols)) or agenda(symbols, cost))
    words = ["".join(w) for w in itertools.product("stb", "aeo", "rnl", "tk")]
    texts = [w + sign for w in words for sign in [".", ",", ";\n", "!?", ".\nAnd", "\n\n", ")", " (", "日"]]
    assert encoder.encode(texts) == library.encode(texts, add_eos=True)
    assert sorted(x for x in worked if x[1:] in words) == sorted(sp.SPACE + w for w in words)
    assert len(worked) == len(set(worked)) < len(words) + 20


def test_no_piece_reaches_across_a_cut():
    """Pieces of all scripts, in any order and with signs between them."""
    encoder = sp.Encoder(open(MODEL, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for piece in encoder.ids:
        assert len(encoder.parts.findall(piece)) == 1
    rng, pieces = random.Random(7), list(encoder.ids)
    texts = ["".join(rng.choice(pieces) + rng.choice(["", "", ".", "\n", " ", "\x00", "e\u0301"]) for _ in range(40)) for _ in range(1500)]
    assert encoder.encode(texts) == library.encode(texts, add_eos=True)


def test_characters_linked_by_pieces():
    assert sp.linked(["ab", "c", "bd", "ee", "xy", ""]) == [{"a", "b", "d"}, {"x", "y"}, {"e"}]


def test_a_difference_in_a_part_without_a_space_is_an_error(monkeypatch):
    encoder = sp.Encoder(open(MODEL, "rb").read())
    agenda = sp.agenda
    monkeypatch.setattr(sp, "agenda", lambda symbols, cost: symbols if "." in symbols else agenda(symbols, cost))
    with pytest.raises(ValueError):
        encoder.encode(["a thing..."])
