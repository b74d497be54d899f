"""BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the last bytes cuts texts into chunks where the content says so, so a
passage that documents share gives the same chunks in each of them. A chunk is encoded
once per worker (two generations of bounded size); other documents reuse its ids. A cut
can split a word, and then the chunk's first and last ids are not those of the whole text.
Such a join is repaired: the text from the last white space left of the cut to the first
one right of it (over several chunks if need be) is encoded again; at white space the
encoding of a part agrees exactly with that of the whole. `Encoder` refuses a tokenizer for
which this does not hold.

A null text counts as empty and has no ids; texts may be of any length and repeat; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.storage import importable, keeping, tidy, utf8
from tributary.llm.text import mix, powers, prefix_hash

# Bytes that decide about a cut, and the mean length of a chunk.
WINDOW = 16
CHUNK_BYTES = 512
# Entries of one generation of a worker's two caches.
CHUNKS_KEPT = 8_000
WORDS_KEPT = 200_000
BLANKS = b" \t\n\r\x0b\x0c"

# How byte-level BPE writes the bytes that are not printable Latin-1 characters: from 256 on, in order.
BYTE_CHARACTERS = {
    b: 256 + i for i, b in enumerate(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE))
}

# ASCII characters that are neither letters nor digits nor blanks.
SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def chunk_cuts(data: np.ndarray, mean: int = CHUNK_BYTES) -> np.ndarray:
    """Places at which the data is cut: they depend on the WINDOW bytes before them alone."""
    if len(data) <= WINDOW:
        return np.zeros(0, np.int64)
    sums = prefix_hash(data)
    _, down = powers(len(data))
    rolling = mix((sums[WINDOW:] - sums[:-WINDOW]) * down[: len(sums) - WINDOW])
    cuts = np.flatnonzero((rolling & np.uint64(mean - 1)) == 0) + WINDOW
    cuts = cuts[cuts < len(data)]
    # Never within a character.
    return cuts[(data[cuts] & 0xC0) != 0x80]


class TwoGenerations(dict):
    """Values made on demand, kept in two generations of bounded size.

    What is used while one generation fills survives it. `cache[key]` is a plain lookup for
    keys of the young generation.
    """

    def __init__(self, make: Callable, kept: int) -> None:
        super().__init__()
        self.make, self.kept, self.old = make, kept, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.kept:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Token ids of whole texts as little-endian 32-bit integers."""

    def __init__(self, path: str, chunk_bytes: int = CHUNK_BYTES, words_kept: int = WORDS_KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.packed = self.tokenizer.model, struct.Struct("<I").pack
        probe = ["one", "two's", "3a", ",."]
        apart = b"".join(map(self._library, probe))
        if any(self._library(blank.join(probe)) != apart for blank in (" ", "\n \t")):
            raise ValueError("the tokenizer does not drop white space between words")
        # Shorter ways for plain words, each only if it gives what the library gives.
        plain = [w for w in ("the", "Largest", "naïve", "ÜNDER", "øre", "A", "é", "straße") if self._plain(w.encode()) is not None]
        self.direct = all(self._plain(w.encode()) == self._library(w) for w in plain)
        self.marks = {m.encode(): self._library(m) for m in ".,;:!?" if self._library(f"word{m}") == self._library("word") + self._library(m)}
        self.closed = self.direct and self._closes()
        self.chunk_bytes = chunk_bytes
        self.words = TwoGenerations(self._word, words_kept)
        self.chunks = TwoGenerations(self._chunk, CHUNKS_KEPT)

    def _library(self, text: str) -> bytes:
        return b"".join(map(self.packed, self.tokenizer.encode(text, add_special_tokens=False).ids))

    def _closes(self) -> bool:
        """Whether symbols behind a word of Latin letters never change its ids, nor it theirs."""
        symbols = SYMBOLS.decode()
        for token in self.tokenizer.get_added_tokens_decoder().values():
            head = token.content.strip().rstrip(symbols)
            if not head or head.isalpha():
                return False
        tails = [*symbols, *(a + b for a in symbols for b in symbols)]
        apart = {tail: self._library(tail) for tail in tails}
        return all(self._library(w + tail) == self._library(w) + ids for w in ("word", "Öé") for tail, ids in apart.items())

    def _plain(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters, from the library's BPE model; None for any other word.

        The lower case of such letters is a letter each and composed already, and byte-level
        BPE reads their UTF-8 bytes as characters.
        """
        text = word.decode().lower()
        if not text.isalpha():
            return None
        if not text.isascii():
            if max(text) >= "\u0250":
                return None
            text = text.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        return b"".join([self.packed(t.id) for t in self.model.tokenize(text)])

    def _word(self, word: bytes) -> bytes:
        """Ids of a word (a run without blanks)."""
        # Closing symbols first, so that letters are known with and without them.
        if self.closed:
            letters = word.rstrip(SYMBOLS)
            if 0 < len(letters) < len(word):
                text = letters.decode().lower()
                if text.isalpha() and (text.isascii() or max(text) < "\u0250"):
                    return self.words[letters] + self.words[word[len(letters) :]]
        # A closing mark behind other words, likewise.
        mark = self.marks.get(word[-1:])
        if mark and len(word) > 1 and word[-2:-1].isalpha():
            return self.words[word[:-1]] + mark
        ids = self._plain(word) if self.direct else None
        return self._library(word.decode()) if ids is None else ids

    def _chunk(self, chunk: bytes) -> tuple[bytes | None, bytes, bytes]:
        """The text before the first blank, the ids between blanks, the text after the last.

        A chunk without a blank is a part of one word: None.
        """
        words = chunk.split()
        head = tail = b""
        if words and chunk[0] not in BLANKS:
            head = words.pop(0)
            if len(head) == len(chunk):
                return None, b"", b""
        if words and chunk[-1] not in BLANKS:
            tail = words.pop()
        return head, b"".join(map(self.words.__getitem__, words)), tail

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, exactly as the tokenizer gives them for the whole text."""
        out = []
        for begin, end in slices(texts, 1 << 20):
            part = texts[begin:end]
            joined = b"".join(part)
            cuts = chunk_cuts(np.frombuffer(joined, np.uint8), self.chunk_bytes)
            ends = np.cumsum([len(t) for t in part])
            first = np.searchsorted(cuts, np.concatenate(([0], ends[:-1])) + WINDOW)
            last = np.searchsorted(cuts, ends)
            cuts, at = cuts.tolist(), 0
            for i, j, stop in zip(first.tolist(), last.tolist(), ends.tolist()):
                ids, across = [], b""
                for cut in [*cuts[i:j], stop]:
                    chunk = joined[at:cut]
                    at = cut
                    head, inner, tail = self.chunks[chunk]
                    if head is None:
                        across += chunk
                        continue
                    # The join: from the last blank so far to the first one in this chunk.
                    if across or head:
                        ids.append(self.words[across + head])
                    ids.append(inner)
                    across = tail
                if across:
                    ids.append(self.words[across])
                out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


KEEPER = "bpe"


@lru_cache(maxsize=2)
def encoder(path: str, words_kept: int = WORDS_KEPT) -> Encoder:
    """One encoder per worker process and tokenizer, so that tasks share its caches."""
    keeping(KEEPER, encoder.cache_clear)
    return Encoder(path, words_kept=words_kept)


def slices(texts: list[bytes], limit: int = 4 << 20):
    """Runs of texts of a few megabytes, so that a batch is not held several times over."""
    begin = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def encoded(spark: SparkSession, docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """doc_id, number and digest of the ids, digest of the decoded text, and the ids on demand."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)

    def encode(batches):
        own = encoder(tokenizer)
        for batch in batches:
            numbers, texts = batch.column(0), utf8(batch.column(1))
            for begin, end in slices(texts):
                ids = own.encode(texts[begin:end])
                columns = [
                    numbers.slice(begin, end - begin),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                    pa.array([hashlib.sha256(own.decode(i).encode()).hexdigest() for i in ids]),
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i in ids], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    importable(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(tidy(encode, KEEPER), ENCODED + ", ids array<long>" * with_ids)
