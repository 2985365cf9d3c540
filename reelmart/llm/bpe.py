"""Byte-pair encoding and decoding of whole texts.

``Backtracker`` encodes one pre-token exactly as rank-ordered merging would, in time linear
in its length: an Aho-Corasick automaton finds the longest vocabulary token at each place,
and a token may follow another only if merging the two texts together would keep exactly
these two tokens (the pair-compatibility table, filled as pairs turn up). Where no
compatible token fits, the last one is taken back and shortened. Decoding looks bytes up
in one blob by an offset table.

Pre-tokens are few against the words of a text, so each worker keeps their ids in a table
that starts over at a fixed size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from reelmart.llm.common import BoundedCache, worker_once

# Letters, numbers and white space up to U+024F, where all Unicode versions agree; beyond it the properties are used.
LATIN_LETTER, LATIN_NUMBER, LATIN_SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
BEYOND_LATIN = re.compile("[^\x00-ɏ]")
BYTE_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
BYTE_LATIN = re.compile(BYTE_PATTERN.format(L=LATIN_LETTER, N=LATIN_NUMBER, S=LATIN_SPACE))
BYTE_ANY = regex.compile(BYTE_PATTERN.format(L=r"\p{L}", N=r"\p{N}", S=r"\p{White_Space}"))


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: letter to byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Backtracker:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        as_bytes = {t: bytes(letters[c] for c in t) for t in vocab}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for token, number in vocab.items():
            texts[number] = as_bytes[token]
        for token, number in self.special.items():
            texts[number] = token.encode()
        self.rank, self.halves, self.pairs = [-1] * size, [(-1, -1)] * size, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            merged = vocab[pair[0] + pair[1] if isinstance(pair, list) else pair.replace(" ", "")]
            self.rank[merged], self.halves[merged], self.pairs[left, right] = rank, (left, right), rank
        self.length = [len(t) for t in texts]
        self.automaton = ahocorasick.Automaton()
        numbers = {}
        for token, number in vocab.items():
            numbers[as_bytes[token]] = number
            self.automaton.add_word(as_bytes[token].decode("latin-1"), number)
        self.automaton.make_automaton()
        self.shorter = [-1] * size
        for text, number in numbers.items():
            for cut in range(len(text) - 1, 0, -1):
                if text[:cut] in numbers:
                    self.shorter[number] = numbers[text[:cut]]
                    break
        self.fits = BoundedCache(self.compatible, 1_000_000)  # by first << 32 | second
        self.blob = np.frombuffer(b"".join(texts), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.known = BoundedCache(lambda word: np.array(self.encode_word(word), "<u4").tobytes())
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def compatible(self, pair: int) -> bool:
        """Whether merging the concatenated texts of two tokens ends in exactly these two.

        Both are taken apart from their last merge backwards. At any time only the right
        edge of the first and the left edge of the second can merge across the border;
        they must not do so before the merge that swallowed one of them. On equal ranks the
        left one comes first.
        """
        left, right, rank = pair >> 32, pair & 0xFFFFFFFF, self.rank
        by_left, by_right = 1 << 60, 1 << 60  # ranks at which the edges get swallowed by their own token
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < by_left and across <= by_right:
                # an equal rank on the right happens later, as merges of one rank run from left to right
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] >= rank[right]:
                by_left, left = rank[left], self.halves[left][1]
            else:
                by_right, right = rank[right], self.halves[right][0]

    def encode_word(self, word: str) -> list[int]:
        text = word.encode()
        longest = [-1] * len(text)
        length, fits, shorter = self.length, self.fits, self.shorter
        for end, token in self.automaton.iter(text.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # matches come by their end, so the longest is the last
        out: list[int] = []
        dead = bytearray(len(text) + 1)
        at, token = 0, longest[0]
        while at < len(text):
            last = out[-1] if out else -1
            while token >= 0 and (dead[at + length[token]] or (last >= 0 and not fits[last << 32 | token])):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at] if at < len(text) else -1
            else:  # nothing can follow here: this place is no border, shorten the token before it
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = self.splitter.split(text) if self.splitter and any(s in text for s in self.special) else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                words = (BYTE_ANY if BEYOND_LATIN.search(part) else BYTE_LATIN).findall(part)
                out.extend(map(self.known.__getitem__, words))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        start, stop = self.offset[numbers], self.offset[numbers + 1]
        width = stop - start
        ends = np.cumsum(width)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + width, width)
        return self.blob[place].tobytes().decode("utf-8", errors="replace")


def encoded_documents(docs: DataFrame, vocabulary: str, key: str = "doc_id") -> DataFrame:
    """``key, ids, decoded``: the ids of each whole text (binary, 4 bytes each) and the text decoded from them.

    NULL text is the empty text and has no ids. Strings of special tokens inside a text
    become their ids, as the library does by default. Rows stay one to one, repeated ones
    included; other columns are not read; an empty table gives no rows.
    """
    source = docs.select(key, "text")
    schema = f"{key} {dict(source.dtypes)[key]}, ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_once(("bpe", vocabulary), lambda: Backtracker(vocabulary))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                ids = [coder.encode(t.as_py() or "") for t in piece.column(1)]
                decoded = [coder.decode(i) for i in ids]
                yield pa.record_batch([piece.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], [key, "ids", "decoded"])

    return source.mapInArrow(run, schema)
