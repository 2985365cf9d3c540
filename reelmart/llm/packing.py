"""Packing tokenised documents into fixed-length sequences: first-fit decreasing per randomised group."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from reelmart.llm.bpe import BEYOND_LATIN, LATIN_LETTER, LATIN_NUMBER, LATIN_SPACE, byte_letters
from reelmart.llm.common import worker_once
from reelmart.session import cut_lineage

WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTER}]+|[{LATIN_NUMBER}]|[^{LATIN_SPACE}{LATIN_LETTER}{LATIN_NUMBER}]+")

BYTE_LETTERS = {b: letter for letter, b in byte_letters().items()}


class WordEncoder:
    """Ids of whole texts by the library, with its ids of single words kept.

    The vocabulary splits lower-cased text into words that are encoded on their own, as their
    UTF-8 bytes. So new words go straight to the library's model; composed letters up to U+024F
    stay as they are in normalisation. Texts with letters beyond or with strings of special
    tokens go to the library whole.

    Words beyond ``limit`` bytes push out the later half of those kept: common words are
    met early, most of the later ones occur once.
    """

    def __init__(self, path: str, limit: int = 80 << 20):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.held, self.limit = 0, limit  # bytes, about

    def library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    @staticmethod
    def cost(words: Iterable[str]) -> int:
        """Bytes that words take with their ids: two objects, a place in the table, and what they hold."""
        return sum(200 + 6 * len(w) for w in words)

    def learn(self, words: set[str]) -> None:
        if self.held + self.cost(words) > self.limit:
            self.known = dict(islice(self.known.items(), len(self.known) // 2))
            self.held = self.cost(self.known)
        if self.held + self.cost(words) > self.limit:
            self.known, self.held = {}, 0
        fresh = [w for w in words if w not in self.known]
        self.held += self.cost(fresh)
        tokens = [[t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(BYTE_LETTERS))] for w in fresh]
        ids = np.fromiter(chain.from_iterable(tokens), "<u4").tobytes()
        start = 0
        for word, own in zip(fresh, tokens):
            self.known[word] = ids[start : start + 4 * len(own)]
            start += 4 * len(own)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        lowered = [t.lower() for t in texts]
        whole = [bool(BEYOND_LATIN.search(t)) or any(s in t for s in self.special) for t in lowered]
        words = [[] if w else WORDS.findall(t) for t, w in zip(lowered, whole)]
        fresh = set().union(*words).difference(self.known)
        if fresh:
            self.learn(set().union(*words) if self.held + self.cost(fresh) > self.limit else fresh)
        known = self.known.__getitem__
        return [self.library(t).tobytes() if w else b"".join(map(known, ws)) for t, w, ws in zip(texts, whole, words)]


def token_pieces(docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens``: each document's ids, then ``end_id``, cut at ``length``.

    NULL text is empty, so its only id is ``end_id``. Repeated rows are separate documents.
    """
    source = docs.select("doc_id", "text")
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, start long, length long, ids binary, doc_tokens long"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_once(("words", vocabulary), lambda: WordEncoder(vocabulary))
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), coder.encode_all(texts)):
                    ids += end
                    tokens = len(ids) // 4
                    rows += [(doc, s, min(length, tokens - s), ids[4 * s : 4 * (s + length)], tokens) for s in range(0, tokens, length)]
                columns = list(zip(*rows))
                types = [part.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                names = ["doc_id", "start", "length", "ids", "doc_tokens"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    return source.mapInArrow(run, schema)


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The first bin each size fits into, in the order given.

    A complete binary tree holds the free room of the bins as its leaves and the larger
    child in each inner node; the leftmost leaf with room is found on one way down.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins.append(node - leaves)
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins


def packed(pieces: DataFrame, capacity: int = 2048, group_pieces: int = 2048, seed: int = 11) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every piece must have 1 to ``capacity`` tokens.

    Pieces are dealt to groups of about ``group_pieces`` at random (by a hash of their place
    in the written input, so copies of one document spread too) and each group is packed on
    its own, largest first. Sequences are numbered by group; offsets run from 0 without gaps.
    """
    placed = cut_lineage(pieces.withColumn("_place", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-placed.count() // group_pieces))
    dealt = placed.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), "_place"), F.lit(groups)))
    out = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "_place"], ascending=[False, True], kind="stable")
        sequence = np.array(first_fit(group["length"].tolist(), capacity), np.int64)
        group["sequence_id"] = group["_group"].to_numpy() * 2**32 + sequence
        group["offset"] = group.groupby(sequence)["length"].cumsum() - group["length"]
        return group[out.names]

    return dealt.groupBy("_group").applyInPandas(pack, out)
