from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a b c's <|endoftext|>x<|startoftext|> don't'll é é İİ ΑΣ \x1c\x1dq 12३4 " + "x" * 3000 + " é" * 900,
    "\n\n", "", " a", "a ", "<|endof text|>", "日本語テキスト" * 200, "𝔘𝔫𝔦 ﬁ ǅ ẞ" * 100, "​﻿ \u0085 a\u0085b   c",
    "Straße, STRASSE. naïve! word? x́, <|ENDOFTEXT|>, ſ ŉ µ ª º İ, a.. b.,",
]


def random_texts(count, seed):
    random.seed(seed)
    pool = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x300, 0x301, 0x3A3, 0x130, 0x1100, 0x1161, 0x11A8, 0xAC00, 0x2003, 0x3000, 0xE9, 0xDF]]
    pool += [*"aAbB'slLtT12<|endoftext|>.,;:!?", "<|endoftext|>", "the ", "Ünder, "]
    return ["".join(random.choices(pool, k=random.randint(1, 300))) for _ in range(count)]


@pytest.mark.parametrize("chunk_bytes", [4, 64, 512])
def test_ids_equal_the_tokenizers(chunk_bytes):
    own, plain = bpe.Encoder(PATH, chunk_bytes), Tokenizer.from_file(PATH)
    texts = ODD + random_texts(800, chunk_bytes)
    for _ in range(2):
        # The second time from the caches.
        for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
            want = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert own.decode(ids) == plain.decode(want, skip_special_tokens=False)


def test_chunks_of_a_shared_passage_are_encoded_once():
    own = bpe.Encoder(PATH, 64)
    passage = " ".join(random_texts(40, 1)).encode()
    own.encode([b"first " + passage])
    known = len(own.chunks)
    own.encode([b"another beginning of some other length " + passage + b" end"])
    assert len(own.chunks) - known < 8 < known


def test_cuts_depend_on_content_alone():
    data = np.frombuffer("".join(random_texts(100, 2)).encode(), np.uint8)
    whole, part = bpe.chunk_cuts(data, 64), bpe.chunk_cuts(data[1000:], 64)
    assert set(part + 1000) >= {c for c in whole if c > 1000 + bpe.WINDOW}
    assert all(data[c] & 0xC0 != 0x80 for c in whole)


def test_caches_are_bounded_and_keep_what_is_used():
    made = []
    cache = bpe.TwoGenerations(lambda key: made.append(key) or key, 10)
    for i in range(1000):
        assert cache[i] == i and cache[5] == 5
        assert len(cache) + len(cache.old) <= 20
    assert made.count(5) == 1 and len(made) == 1000


def test_a_tokenizer_that_keeps_white_space_is_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_rows(spark):
    plain = Tokenizer.from_file(PATH)
    rows = [(1, "a b", "x"), (1, "a b", "y"), (None, None, "z"), (2, "", "q"), (3, ODD[0] * 30, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.encoded(spark, docs, PATH, with_ids=True).collect()
    want = []
    for doc, text, _ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        data = np.array(ids, "<u4").tobytes()
        decoded = plain.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert bpe.encoded(spark, docs.limit(0), PATH).collect() == []


def test_words_with_closing_symbols_get_the_ids_of_the_library():
    own = bpe.Encoder(PATH)
    assert own.closed
    symbols = ["!!", "$$$", ".%%%", "'", "'s", "'s.", "<|endoftext|>", "…", "̸", "9.", "-"]
    for head in ("word", "Réenre", "équeèê", "don't", "ß", "слово", "İ", "a9", "<|endoftext", "À̈", ""):
        for tail in symbols:
            for more in ("", *symbols):
                word = head + tail + more
                assert own.words[word.encode()] == own._library(word), word
