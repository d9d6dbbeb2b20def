"""Encoding against the public library, round trips and defined edge cases."""

import random
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vacantia.llm import encoding
from vacantia.llm.bpe import StreamDecoder, Transducer

FILE = Path(encoding.VOCABULARY)
pytestmark = pytest.mark.skipif(not FILE.exists(), reason="no vocabulary here")


@pytest.fixture(scope="module")
def own():
    return Transducer(FILE.read_bytes(), max_states=500, max_words=50)


@pytest.fixture(scope="module")
def public():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(str(FILE))
    t.encode_special_tokens = True
    return t


def texts():
    rng = random.Random(4)
    out = ["", " ", "a" * 3000, "=-" * 1500 + "x" * 1500, "<|endoftext|> hi", "naïve Zürich 東京 🚀🚀", "it's we'll I'M", "\x00\x1c\x85 ﻿", "  a  b\n\n c\t"]
    for n in range(600):
        kind = n % 3
        k = rng.randint(1, 50)
        if kind == 0:
            out.append("".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(k)))
        elif kind == 1:
            out.append("".join(rng.choice("etaoin shr  \n") for _ in range(k)))
        else:
            out.append("".join(rng.choice(["aaa", "aa", "ab", "the", "ing", " ", "ss", "====", "=="]) for _ in range(k)))
    return out


def test_equals_the_public_library(own, public):
    for t, e in zip(texts(), public.encode_batch(texts(), add_special_tokens=False)):
        assert own.encode(t) == e.ids, t


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_round_trip(own, t):
    try:
        t.encode()
    except UnicodeEncodeError:
        return
    assert StreamDecoder(own.bytes_of).decode(own.encode(t)) == t


def test_streaming_decoder_holds_back_unfinished_characters(own):
    ids = own.encode("日本🚀")
    d = StreamDecoder(own.bytes_of)
    pieces = [d.feed(i) for i in ids]
    assert "".join(pieces) == "日本🚀" and "�" not in "".join(pieces) and d.end() == ""
    by_byte = {w[0]: i for i, w in own.bytes_of.items() if len(w) == 1}
    for raw in (b"\xff", b"\xe6\x97", b"\xe6a", b"\xf0\x9f\x9a\x80\xc3", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf5ab"):
        assert StreamDecoder(own.bytes_of).decode([by_byte[b] for b in raw]) == raw.decode("utf-8", "replace")


def test_spark(spark, own):
    rows = [(1, "hello", "x", 1), (2, None, "x", 1), (3, "", "x", 1), (4, "lang " * 20_000, "x", 1), (4, "hello", "x", 1), (None, "a", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, k int")
    got = sorted(((r["doc_id"], r["ids"]) for r in encoding.encode(df).collect()), key=str)
    assert got == sorted(((i, own.encode(t)) for i, t, *_ in rows), key=str)
    sizes = sorted(((r["doc_id"], r["n_tokens"]) for r in encoding.token_counts(df).collect()), key=str)
    assert sizes == sorted(((i, len(own.encode(t))) for i, t, *_ in rows), key=str)
    back = encoding.decode(encoding.encode(df)).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t, *_ in rows)
    assert encoding.encode(df.limit(0)).count() == 0
