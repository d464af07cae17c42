import random
import time

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from quotelane.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(MODEL)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), np.int32).tolist()


def test_random_texts_encode_as_the_library_does(encoder):
    rng = random.Random(9)
    letters = " \n\t▁aeinorstlhdABC.,;:-_=()[]<>/\\\"'012789éèßüñ中文字日本語한국🙂\x00​﻿\r"
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert ids(encoder, text) == LIBRARY.encode(text), repr(text)


@pytest.mark.parametrize("text", ["", " ", "   a", "</s><s>", "<0x41>", "a" * 3000, " " * 3000, "ab" * 999, "\n\n", "x́"])
def test_awkward_texts(encoder, text):
    assert ids(encoder, text) == LIBRARY.encode(text)


@pytest.mark.parametrize("letters", ["a", "ab", " ", "abcdefghijklmnopqrstuvwxyzäé中"])
def test_unbroken_texts_take_linear_time(encoder, letters):
    rng = random.Random(3)
    text = "".join(rng.choice(letters) for _ in range(1_000_000))
    started = time.monotonic()
    found = ids(encoder, text)
    assert time.monotonic() - started < 20
    assert found == LIBRARY.encode(text)


def test_steps_back_where_a_longest_piece_leads_nowhere(encoder):
    words = ["▁unbelievably", "▁Einundzwanzig", "▁aaaaaaab", "▁thththe"]
    for word in words:
        out = encoder.split(word)
        assert "".join(out) == word == "".join(encoder.merged(word)) and out == encoder.merged(word)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    small = pieces.Encoder(MODEL)
    text = "one two three, four. five two one six seven? one, two. " * 3
    assert ids(small, text) == LIBRARY.encode(text)


def test_columns(spark):
    rows = [(1, None), (2, ""), (3, "Hé  llo\nworld 🙂"), (3, "Hé  llo\nworld 🙂"), (None, "x " * 30_000)]
    docs = spark.createDataFrame([(i, t, "extra") for i, t in rows], "doc_id long, text string, ids string")
    out = docs.select("text", pieces.encoded(docs["text"], MODEL).alias("found"))
    out = out.select(
        "text", "found", pieces.decoded(F.col("found"), MODEL).alias("back"),
        pieces.coded(F.col("text"), MODEL).alias("both"))
    for r in out.collect():
        assert r["found"] == LIBRARY.encode(r["text"] or "")
        assert (r["both"]["ids"], r["both"]["decoded"]) == (r["found"], r["back"])
        assert r["back"] == LIBRARY.decode(r["found"]) == (r["text"] or "")
    assert out.where("false").collect() == []
