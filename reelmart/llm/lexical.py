"""Ranked lexical search over bit-sliced Bloom signatures, exact.

Each document has a Bloom filter of its terms, and of every term again for each doubling of
its count. Filters of one width are kept sliced: bit b of all documents of a block is one bitmap.
The bitmaps of a term's bits, combined, overestimate in which documents it stands and how often;
weighted sums of them are upper bounds of the scores. The best bounds are scored first, which
gives each item a score that ten documents reach; every document whose bound is not below it is
scored from its whole text. Nothing else is left out.

The index is written once and holds a filter of 10 to 20 bits per distinct term, the documents' lengths, and
counts of documents per term. Items are searched in blocks of a bounded number of terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.common import null_safe
from reelmart.session import cut_lineage

BITS_PER_TERM, HASHES = 10, 4
BLOCK_DOCS = 512
BLOCK_BITS = 1 << 22  # of a block's slices; wide filters come in blocks of fewer documents
VOCABULARY = 200_000  # distinct terms counted at once in a task, and hashes kept
SHORT = 48  # bytes of a term that is kept between documents
ITEM_TERMS = 20_000  # terms of the items searched together

# Fixed values of the score: scale, saturation and length normalisation.
SCALE, K, K_LENGTH, LENGTH_SHARE = 1_000_000_000, 1000, 8, 90

# Fixed value: bytes that end a term become blanks, A-Z become small letters; all of UTF-8 beyond ASCII stays.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX = "term binary, df long, width int, n_docs long, n_terms long, doc_ids array<long>, sizes array<long>, slices binary"


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLDED).split() if text else []


class TermHashes(dict):
    """64-bit hashes of terms; short ones are kept, a bounded number of them."""

    def __missing__(self, term: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(term)
        if len(term) <= SHORT:
            if len(self) >= VOCABULARY:
                self.clear()
            self[term] = value
        return value


def at_level(hashes: np.ndarray, level: int) -> np.ndarray:
    """Other hashes of the same terms for "stands at least 2^level times"."""
    with np.errstate(over="ignore"):
        mixed = hashes + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
        return mixed ^ mixed >> np.uint64(32)


def positions(hashes: np.ndarray, width: int) -> np.ndarray:
    """The filter bits (hash function by term) of hashed terms."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([((hashes + np.uint64(k) * step) & np.uint64(width - 1)).astype(np.int64) for k in range(HASHES)])


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term gives a document per unit of weight; never falls with the term's count."""
    return SCALE * tf // (K * tf + K_LENGTH * m)


@dataclass
class Corpus:
    docs: int
    terms: int

    def norm(self, size: np.ndarray | int) -> np.ndarray | int:
        return 100 - LENGTH_SHARE + LENGTH_SHARE * size * self.docs // self.terms


def signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sliced filters, and counts of documents per term, of the texts of a task."""
    hashed, seen, open_blocks = TermHashes(), Counter(), {}
    schema = pa.schema([("term", pa.binary()), ("df", pa.int64()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("slices", pa.binary())])

    def counts(found: Counter | dict) -> pa.RecordBatch:
        none = [None] * len(found)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip([list(found), list(found.values()), *[none] * 6], schema)], schema=schema)

    def block(width: int) -> pa.RecordBatch:
        docs = open_blocks.pop(width)
        bits = np.zeros((width, -(-len(docs) // 8) * 8), bool)
        for k, (_, _, at) in enumerate(docs):
            bits[at, k] = True
        ids, sizes = [d[0] for d in docs], [d[1] for d in docs]
        values = [None, None, width, len(docs), sum(sizes), ids, sizes, np.packbits(bits, axis=1).tobytes()]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = Counter(terms_of(text.as_py()))
            if not found:
                continue
            long = {t: 1 for t in found if len(t) > SHORT}
            seen.update(found.keys() - long.keys() if long else found.keys())
            if long:
                yield counts(long)
            if len(seen) >= VOCABULARY:
                yield counts(seen)
                seen.clear()
            hashes = np.fromiter((hashed[t] for t in found), np.uint64, len(found))
            times = np.fromiter(found.values(), np.int64, len(found))
            levels = [at_level(hashes[times >= 1 << j], j) for j in range(int(times.max()).bit_length())]
            keyed = np.concatenate(levels)
            width = 1 << max(6, (BITS_PER_TERM * len(keyed) - 1).bit_length())
            open_blocks.setdefault(width, []).append((doc_id, int(times.sum()), positions(keyed, width).ravel()))
            if len(open_blocks[width]) >= max(8, min(BLOCK_DOCS, BLOCK_BITS // width)):
                yield block(width)
    for width in list(open_blocks):
        yield block(width)
    if seen:
        yield counts(seen)


def indexed(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to the shared folder.

    Documents without a term are not in it. NULL and repeated ids are documents of their own;
    other columns are not read.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut_lineage(narrow.mapInArrow(signature_rows, INDEX), "signatures")


@dataclass
class Queries:
    """A block of items: weights of the terms of each, as sent to the tasks."""

    terms: list[bytes]
    items: list[int]
    parts: list[tuple[np.ndarray, np.ndarray]]  # per item the numbers and weights of its terms

    @staticmethod
    def of(rows: list) -> Queries:
        number: dict[bytes, int] = {}
        per: dict[int, list] = {}
        for r in rows:
            per.setdefault(r["item"], []).append((number.setdefault(bytes(r["term"]), len(number)), r["weight"]))
        parts = [(np.array([n for n, _ in p]), np.array([w for _, w in p], np.float64)) for p in per.values()]
        return Queries(list(number), list(per), parts)

    def hashes(self) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(t) for t in self.terms], np.uint64)


def upper_bounds(queries: Queries, hashes: np.ndarray, corpus: Corpus, width: int, sizes: np.ndarray, slices: bytes) -> np.ndarray:
    """No score of an item (row) with a document (column) of the block is above its bound."""
    docs = len(sizes)
    table = np.frombuffer(slices, np.uint8).reshape(width, -1)
    m = corpus.norm(sizes)
    bounds = np.zeros((len(queries.items), docs), np.int64)
    active, before, given, level = np.arange(len(hashes)), None, np.zeros(docs, np.int64), 0
    while len(active):
        at = positions(at_level(hashes[active], level), width)
        present = table[at[0]]
        for k in range(1, HASHES):
            present &= table[at[k]]
        if before is not None:
            present &= before
        some = present.any(1)
        active, before = active[some], present[some]
        if not len(active):
            break
        bits = np.zeros((len(hashes), docs), np.float64 if level == 0 else np.float32)
        bits[active] = np.unpackbits(before, axis=1, count=docs)
        is_active = np.zeros(len(hashes), bool)
        is_active[active] = True
        # so often at most, unless the next level is present too
        most = share(np.minimum((2 << level) - 1, sizes), m)
        for row, (numbers, weights) in enumerate(queries.parts):
            here = is_active[numbers]
            if here.any():
                bounds[row] += (most - given) * np.rint(weights[here] @ bits[numbers[here]]).astype(np.int64)
        given, level = most, level + 1
    return bounds


def over_blocks(blocks: DataFrame, queries: Queries, corpus: Corpus, per_item: int, reached: dict[int, int] | None) -> DataFrame:
    """``item, doc_id, bound``: the ``per_item`` best bounds of each task, or, given ``reached``, all not below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = queries.hashes()
        floor = np.array([1 if reached is None else max(1, reached.get(i, 1)) for i in queries.items], np.int64)
        best: list[list[tuple[int, int | None]]] = [[] for _ in queries.items]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = pa.int64(), pa.int64(), pa.int64()
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["item", "doc_id", "bound"])

        for batch in batches:
            for width, ids, sizes, slices in zip(*(batch.column(c) for c in ("width", "doc_ids", "sizes", "slices"))):
                ids, sizes = ids.as_py(), np.array(sizes.as_py(), np.int64)
                bounds = upper_bounds(queries, hashes, corpus, width.as_py(), sizes, slices.as_buffer())
                rows, columns = np.nonzero(bounds >= floor[:, None])
                found = [(queries.items[r], ids[c], b) for r, c, b in zip(rows.tolist(), columns.tolist(), bounds[rows, columns].tolist())]
                if reached is not None:
                    if found:
                        yield out(found)
                    continue
                for row in np.unique(rows).tolist():
                    own = bounds[row]
                    top = np.argsort(-own, kind="stable")[:per_item]
                    best[row] = sorted(best[row] + [(int(own[c]), ids[c]) for c in top.tolist() if own[c] > 0], key=lambda x: -x[0])[:per_item]
                    if len(best[row]) == per_item:
                        floor[row] = best[row][-1][0] + 1
        rows = [(i, d, b) for i, kept in zip(queries.items, best) for b, d in kept]
        if rows:
            yield out(rows)

    return blocks.mapInArrow(run, "item long, doc_id long, bound long")


def scored(docs: DataFrame, candidates: DataFrame, queries: Queries, corpus: Corpus) -> DataFrame:
    """``item, doc_id, score`` of the candidates, counted in their whole texts.

    The candidates' ids are broadcast while they are few, so no text is shuffled; else they
    are joined, where adaptive execution splits a busy id.
    """
    wanted = cut_lineage(candidates.groupBy("doc_id").agg(F.collect_set("item").alias("items")), "candidates")
    few = wanted.count() <= 100_000
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = null_safe(narrow, F.broadcast(wanted) if few else wanted, ["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of = {item: k for k, item in enumerate(queries.items)}
        for batch in batches:
            rows = []
            for doc_id, text, items in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("items").to_pylist()):
                found = Counter(terms_of(text.as_py()))
                m = corpus.norm(found.total())
                for item in items:
                    numbers, weights = queries.parts[row_of[item]]
                    score = 0
                    for n, w in zip(numbers.tolist(), weights.tolist()):
                        if tf := found.get(queries.terms[n]):
                            score += int(w) * (SCALE * tf // (K * tf + K_LENGTH * m))
                    if score:
                        rows.append((item, doc_id, score))
            if rows:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], ["item", "doc_id", "score"])

    return met.select("doc_id", "text", "items").mapInArrow(run, "item long, doc_id long, score long")


def best_of(rows: DataFrame, k: int, score: str) -> DataFrame:
    """The k highest of each item, equal ones by ascending id (NULL last), as ``rank``."""
    order = Window.partitionBy("item").orderBy(F.desc(score), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def item_terms(items: DataFrame) -> DataFrame:
    """``item, term``: the distinct terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if found := list(dict.fromkeys(terms_of(text.as_py()))):
                    yield pa.record_batch([pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())], ["item", "term"])

    return items.select("item", "text").mapInArrow(run, "item long, term binary")


def ranked(docs: DataFrame, index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents that score highest for each item, as a full scan would give them.

    ``index`` is that of ``docs``. Each row of ``items`` (item_id, text) is an item of its own,
    also with a repeated or NULL id. Items without a term that any document holds, and empty
    tables, give no rows; items NULL in text have no term. Documents with a score of 0 are left out.
    """
    spark = docs.sparkSession
    blocks = index.filter("width IS NOT NULL")
    total = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    corpus = Corpus(total[0] or 0, total[1] or 0)
    named = cut_lineage(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    terms = cut_lineage(item_terms(named), "terms")
    n_terms = terms.count()
    wanted = terms.select("term").distinct()
    if n_terms <= 1_000_000:
        wanted = F.broadcast(wanted)
    held = index.filter("term IS NOT NULL").select("term", "df").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * corpus.docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    count = max(1, math.ceil(n_terms / ITEM_TERMS))
    weighted = terms.join(held, "term").select("item", "term", weight.alias("weight"), F.pmod(F.xxhash64("item"), F.lit(count)).alias("block"))
    weighted = cut_lineage(weighted.filter("weight > 0"), "weights")
    narrow = blocks.select("width", "doc_ids", "sizes", "slices")
    found = []
    for b in range(count):
        queries = Queries.of(weighted.filter(F.col("block") == b).select("item", "term", "weight").collect())
        if not queries.items:
            continue
        first = best_of(over_blocks(narrow, queries, corpus, k, None), k, "bound")
        exact = best_of(scored(docs, first.select("item", "doc_id"), queries, corpus), k, "score")
        reached = {r["item"]: r["score"] for r in exact.filter(F.col("rank") == k).collect()}
        rest = over_blocks(narrow, queries, corpus, k, reached)
        found.append(cut_lineage(best_of(scored(docs, rest.select("item", "doc_id"), queries, corpus), k, "score"), "ranked"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
