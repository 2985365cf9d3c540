"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, exactly.

Documents are put in bands by set size; partners lie in the same band or a neighbour, and a
document enters each band in which it can have one. In a band, two sets that fit differ in
at most d shingles, so if shingles are dealt by hash to more than d parts, one part is the
same in both. (band, part, contents) names a tile; only members of a tile are compared:
first by hashed parity bitmaps, whose differing bits bound the overlap from above, then by
exact intersection of the sorted shingle arrays. Sketches, bitmaps folded to half their
width, give a weaker bound; tiles are compared by them, so that passages which many
documents share move little, and only pairs they leave open move bitmaps and sets.

The first pass compares each member of a tile with its least member, the second with the
one that shares the most tiles with others. What is linked by then forms components; only
members of one tile in different components are compared in full, so a huge group of
copies costs its size and not the square of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.common import fresh, null_safe, spread_blocks, whole_groups
from reelmart.llm.components import components, extended
from reelmart.session import cut_lineage

LEAST_BITS = 256  # of a bitmap
# Members of a large tile compared with as many others at once: each moves its sketch to as many tiles as there are
# blocks, so small blocks move more than the tile holds. Two blocks of wide sketches are some tens of megabytes.
TILE_BLOCK = 2048
STRIP = 64  # members compared with their whole tile at once
TAG = (1 << 48) - 1  # bits kept of names that are shuffled in numbers
BAND_GROWTH = 1.5  # upper over lower end of a band
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


@dataclass
class Law:
    """``parts * intersection >= percent * union`` over shingles of ``words`` words."""

    words: int = 3
    percent: int = 90
    bands: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    cuts: dict[int, np.ndarray] = field(default_factory=dict)

    def band(self, number: int) -> tuple[int, int]:
        """Least and largest set size of a band."""
        while len(self.bands) <= number:
            low = self.bands[-1][1] + 1
            self.bands.append((low, max(low, int(low * BAND_GROWTH))))
        return self.bands[number]

    def differing(self, number: int) -> int:
        """Most shingles in which two linked sets of a band can differ."""
        return 2 * self.band(number)[1] * (100 - self.percent) // (100 + self.percent)

    def parts(self, number: int) -> int:
        """Parts of a band: more than can differ, and some to spare so that empty ones need not count."""
        d = self.differing(number)
        return d + 1 + (d + 19) // 20

    def bands_of(self, size: int) -> list[int]:
        number = 1
        while self.band(number)[1] < size:
            number += 1
        out = [number]
        while 100 * size >= self.percent * self.band(number + 1)[0]:
            number += 1
            out.append(number)
        return out

    def borders(self, count: int) -> np.ndarray:
        if count not in self.cuts:
            self.cuts[count] = np.array([(k << 64) // count for k in range(1, count)], np.uint64)
        return self.cuts[count]

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Tile names of a sorted set: one per band and part.

        If more than d parts of this set hold shingles, one of them must be equal in any
        partner, so empty parts name no tile; else they do.
        """
        sums = np.concatenate([[np.uint64(0)], np.cumsum(scrambled(shingles + np.uint64(1)))])
        out = []
        for number in self.bands_of(len(shingles)):
            d, count = self.differing(number), self.parts(number)
            if d == 0:
                continue  # only equal sets link here, and those are one class already
            place = np.concatenate([[0], np.searchsorted(shingles, self.borders(count)), [len(shingles)]])
            content = sums[place[1:]] - sums[place[:-1]]
            name = np.arange(count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number * 0x100000001B3)
            filled = place[1:] > place[:-1]
            name = scrambled(scrambled(content) + name)
            out.append(name[filled] if filled.sum() > d else name)
        return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)

    def enough(self, shared: np.ndarray | Column, total: np.ndarray | Column):
        """Whether ``shared`` of ``total`` (sum of both sizes) shingles make a link."""
        return 100 * shared >= self.percent * (total - shared)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text, ASCII letters lower-cased.

    Fewer than ``words`` words make one shingle of all of them; no word makes none. Words are
    hashed each time: that takes half as long as to look them up, and keeps nothing in the worker.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    count = len(found) - width + 1
    whole = np.full(count, width, np.uint64)
    for k in range(width):
        whole = whole + scrambled(hashes[k : k + count]) * np.uint64(MULTIPLIERS[k % len(MULTIPLIERS)] + 2 * (k // len(MULTIPLIERS)))
    return np.unique(scrambled(whole))


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bit b tells whether an odd number of shingles hash to b; as 64-bit words.

    Between two and four bits per shingle, a power of two, so that the bound stays tight for
    long texts. Halves laid over each other by exclusive or give the bitmap of half the width.
    """
    width = max(LEAST_BITS, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else LEAST_BITS
    odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """The bitmap at a smaller width; the lower bits of a hash name its place at any width."""
    while len(bitmap) > words:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def sketch(bitmap: np.ndarray) -> np.ndarray:
    """Half the bitmap's width: one to two bits per shingle.

    With fewer, sets that share little differ in hardly more bits than linked ones may, and a
    part of all pairs of a tile, whose number is the square of its size, would stay possible.
    """
    return folded(bitmap, max(LEAST_BITS // 64, len(bitmap) // 2))


def text_hash() -> Column:
    """Tells rows with the same id apart."""
    return F.xxhash64("text").alias("text_hash")


def signatures(docs: DataFrame, law: Law) -> DataFrame:
    """``doc_id, text_hash, n_shingles, digest_a, digest_b, bitmap, sketch`` of each row."""
    source = docs.select("doc_id", "text", text_hash())
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, text_hash long, n_shingles long, digest_a long, digest_b long, bitmap array<long>, sketch array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingle_set(t.as_py(), law.words) for t in part.column(1)]
                digests, bitmaps = [digest(s) for s in sets], [parity_bitmap(s) for s in sets]
                columns = [
                    part.column(0),
                    part.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array(bitmaps, pa.list_(pa.int64())),
                    pa.array([sketch(b) for b in bitmaps], pa.list_(pa.int64())),
                ]
                yield pa.record_batch(columns, ["doc_id", "text_hash", "n_shingles", "digest_a", "digest_b", "bitmap", "sketch"])

    return source.mapInArrow(run, schema)


def tile_slots(docs: DataFrame, law: Law) -> DataFrame:
    """``key, tag``: the tiles of each set, which its tag names. Each task names a set once.

    Sets are made again from the texts: cheaper than to keep the keys, a fifth to two fifths
    as many as shingles, on disk. Both columns are cut to 48 bits to shuffle less; two keys
    that fall together only add candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                tags, keys = [], []
                for text in batch.column(0).slice(at, 1000):
                    shingles = shingle_set(text.as_py(), law.words)
                    name = digest(shingles)
                    if len(shingles) and name not in seen:
                        seen.add(name)
                        tags.append(name[0] & TAG)
                        keys.append(law.keys(shingles) & TAG)
                yield pa.record_batch([pa.array(tags, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["tag", "keys"])

    return docs.select("text").mapInArrow(run, "tag long, keys array<long>").select(F.explode("keys").alias("key"), "tag")


def possibly_in(df: DataFrame, column: Column, wanted: DataFrame, wanted_column: Column) -> DataFrame:
    """``df`` with ``_perhaps``: false only if the row's value is not among those of ``wanted``.

    A bit table of the values' hashes is broadcast. It has eight bits per value, up to 2^26
    bits in all, so it is 16 MB at most; beyond that it says "perhaps" more often.
    """
    size = 1 << max(10, min(26, (8 * wanted.count()).bit_length()))
    place = lambda value: F.pmod(F.xxhash64(value), F.lit(size))
    bits = wanted.select(place(wanted_column).alias("_bit")).groupBy(F.shiftright("_bit", 5).alias("_word"))
    table = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 32 as int))")).alias("_bits"))
    marked = df.withColumn("_bit", place(column)).withColumn("_word", F.shiftright("_bit", 5))
    found = marked.join(F.broadcast(table), "_word", "left")
    test = F.coalesce(F.expr("(shiftright(_bits, cast(_bit % 32 as int)) & 1) = 1"), F.lit(False))
    return found.withColumn("_perhaps", test).drop("_word", "_bit", "_bits")


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    value = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(value[:8], "little", signed=True), int.from_bytes(value[8:], "little", signed=True)


def candidate_sets(docs: DataFrame, wanted: DataFrame, law: Law) -> DataFrame:
    """``cid, shingles``: the sorted set of each wanted class, made again from its least document.

    ``wanted`` has ``cid, doc_id, digest_a, digest_b``; of rows that share an id only one
    with the right digest counts.
    """
    few = possibly_in(docs.select("doc_id", "text"), F.col("doc_id"), wanted, F.col("doc_id")).filter("_perhaps").drop("_perhaps")
    source = null_safe(few, wanted, ["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                shingles = shingle_set(row["text"], law.words)
                if digest(shingles) == (row["digest_a"], row["digest_b"]):
                    out.append((row["cid"], shingles.tobytes()))
            columns = list(zip(*out)) or [[], []]
            yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], ["cid", "shingles"])

    return source.mapInArrow(run, "cid long, shingles binary").dropDuplicates(["cid"])


def verified(pairs: DataFrame, sets: DataFrame, law: Law) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sorted shingle arrays intersect enough."""
    first = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(law.enough(shared, len(x) + len(y))))
            kept = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def overlap_bound(left: str, right: str) -> Column:
    """Largest possible intersection by the bitmaps (or sketches): bits that differ are shingles of one side only.

    Of two widths the wider one is folded until both are equal.
    """
    x, y = F.col(f"{left}_bitmap"), F.col(f"{right}_bitmap")
    words = F.least(F.size(x), F.size(y))
    folds = lambda bits: F.sequence(F.lit(1), (F.size(bits) / words).cast("int") - 1)
    whole = lambda bits, i: F.aggregate(folds(bits), F.get(bits, i), lambda s, j: s.bitwiseXOR(F.get(bits, i + j * words)))
    at = lambda bits, i: F.when(F.size(bits) > words, whole(bits, i)).otherwise(F.get(bits, i))
    count = lambda s, i: s + F.bit_count(at(x, i).bitwiseXOR(at(y, i)))
    differing = F.aggregate(F.sequence(F.lit(0), words - 1), F.lit(0), count)
    both = F.least(f"{left}_n", f"{right}_n")
    return F.least(both, F.floor((F.col(f"{left}_n") + F.col(f"{right}_n") - differing) / 2))


def bounded(pairs: DataFrame, classes: DataFrame, law: Law) -> DataFrame:
    """Those of ``pairs`` (a, b) that sizes and bitmaps leave possible.

    Sizes rule out much of what cannot fit before any bits are moved, sketches most of the
    rest before whole bitmaps are.
    """
    sizes = classes.select("cid", F.col("n_shingles").alias("n"))
    sized = pairs.join(sizes.withColumnsRenamed({"cid": "a", "n": "an"}), "a").join(sizes.withColumnsRenamed({"cid": "b", "n": "bn"}), "b")
    pairs = sized.filter(law.enough(F.least("an", "bn"), F.col("an") + F.col("bn"))).select("a", "b")
    for bits in ("sketch", "bitmap"):
        for end in ("a", "b"):
            pairs = pairs.join(classes.select(F.col("cid").alias(end), F.col("n_shingles").alias(f"{end}_n"), F.col(bits).alias(f"{end}_bitmap")), end)
        pairs = pairs.filter(law.enough(overlap_bound("a", "b"), F.col("a_n") + F.col("b_n"))).select("a", "b")
    return pairs


def tile_survivors(columns: dict[str, np.ndarray], start: int, stop: int, law: Law) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one tile in different components that sizes and sketches leave possible."""
    own = slice(start, stop)
    cid, size, root, side = (columns[c][own] for c in ("cid", "n_shingles", "root", "_side"))
    maps = columns["sketch"][start:stop]
    words = min(len(m) for m in maps)
    bitmap = np.array([folded(m, words) for m in maps])
    split = columns["_i"][start] != columns["_j"][start]
    left, right = [], []
    for at in range(0, len(cid), STRIP):
        row = slice(at, at + STRIP)
        total = size[row, None] + size[None, :]
        differing = np.zeros(total.shape, np.int32)
        for word in range(words):
            differing += np.bitwise_count(bitmap[row, None, word] ^ bitmap[None, :, word])
        shared = np.minimum(np.minimum(size[row, None], size[None, :]), (total - differing) // 2)
        possible = law.enough(shared, total) & (root[row, None] != root[None, :]) & (cid[row, None] < cid[None, :])
        if split:
            possible &= side[row, None] != side[None, :]
        a, b = np.nonzero(possible)
        left.append(cid[row][a])
        right.append(cid[b])
    return np.concatenate(left), np.concatenate(right)


def cross_component_pairs(members: DataFrame, classes: DataFrame, law: Law, block: int = TILE_BLOCK) -> DataFrame:
    """Distinct pairs within tiles of several components; ``members`` has ``key, size, cid, root``."""
    order = ["key", "_i", "_j"]
    tiles = spread_blocks(members, "key", "size", "cid", block).join(classes.select("cid", "n_shingles", "sketch"), "cid")
    tiles = tiles.select(*order, "_side", "cid", "root", "n_shingles", "sketch").repartition(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, borders in whole_groups(batches, len(order)):
            columns = {c: rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in rows.schema.names if c != "sketch"}
            maps = rows.column("sketch").combine_chunks()
            cuts = np.concatenate([[0], np.cumsum(maps.value_lengths().to_numpy())])
            flat = maps.flatten().to_numpy()
            columns["sketch"] = [flat[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            for start, stop in zip(borders[:-1].tolist(), borders[1:].tolist()):
                if stop - start > 1:
                    a, b = tile_survivors(columns, start, stop, law)
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return tiles.mapInArrow(run, "a long, b long").distinct()


def similar_documents(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs``.

    Linked are rows with 100 * intersection >= percent * union of their shingle sets. Rows
    with equal sets are one class. NULL and blank texts have an empty set and link with
    nothing. Rows with the same or a NULL id are separate documents; ``component_id`` is the
    least id reachable, its own where none is known. Other columns are not read; an empty
    table gives no rows.
    """
    return grouped_documents(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` less all but one of each group of similar documents.

    The one with the least id stays (NULL ids first). Rows without a word are no copies of
    each other and all stay. All columns are kept.
    """
    groups = cut_lineage(grouped_documents(docs, words, percent).filter("root IS NOT NULL").drop("n_shingles", "component_id"), "groups")
    names = ["doc_id", "text_hash"]
    first = groups.groupBy("root").agg(F.min(F.struct(*names)).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # Every row of a group of several is looked at; all others stay without being moved.
    several = groups.join(first, "root").select(*names, (F.struct(*names) == F.col("first")).alias("stays")).distinct()
    several = cut_lineage(several, "several")
    mark, stays = fresh(docs, "_hash"), fresh(docs, "_stays")
    split = possibly_in(docs.withColumn(mark, text_hash()), F.struct("doc_id", mark), several, F.struct(*names))
    alone = split.filter("NOT _perhaps")
    judged = null_safe(
        split.filter("_perhaps"), several.withColumnsRenamed({"text_hash": mark, "stays": stays}), ["doc_id", mark], "left"
    )
    single = judged.filter(F.col(stays).isNull()).drop(stays)
    chosen = judged.filter(F.col(stays)).drop(stays).dropDuplicates(["doc_id", mark])
    return alone.unionByName(single).unionByName(chosen).drop(mark, "_perhaps")


def mixed_tiles(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (key, cid) of tiles that hold several components, with ``root`` and the tile's ``size``.

    Of tiles with the same members, told by 128 bits, one is enough.
    """
    rooted = members.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    names = [F.bit_xor(F.xxhash64(F.lit(salt), "cid")).alias(name) for salt, name in ((11, "name_a"), (12, "name_b"))]
    tiles = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"), *names)
    tiles = tiles.filter("low <> high AND size > 2").groupBy("size", "name_a", "name_b").agg(F.min("key").alias("key"))
    return rooted.join(tiles.select("key", "size"), "key")


def grouped_documents(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, root`` of each row; root names its group, NULL without a word."""
    law = Law(words, percent)
    signed = cut_lineage(signatures(docs, law), "signatures")
    digests = ["digest_a", "digest_b", "n_shingles"]
    filled = signed.filter("n_shingles > 0")
    classes = filled.groupBy(*digests).agg(F.min("doc_id").alias("doc_id"), F.any_value("bitmap").alias("bitmap"), F.any_value("sketch").alias("sketch"))
    classes = classes.withColumns({"cid": F.monotonically_increasing_id(), "tag": F.col("digest_a").bitwiseAND(F.lit(TAG))})
    classes = cut_lineage(classes, "classes")
    least = F.min("tag").over(Window.partitionBy("key").orderBy("tag"))
    # Sorted by key, the least member comes first: rows stream by, no tile is gathered.
    stars = cut_lineage(tile_slots(docs, law).withColumn("first", least).filter("tag <> first").distinct(), "stars")
    named = lambda name: classes.select(F.col("tag").alias(f"{name}_tag"), F.col("cid").alias(name))
    spokes = stars.select(F.col("first").alias("a_tag"), F.col("tag").alias("b_tag")).distinct()
    spokes = cut_lineage(spokes.join(named("a"), "a_tag").join(named("b"), "b_tag"), "spokes")
    ids = classes.select("cid", "doc_id", "digest_a", "digest_b")
    tested: list[DataFrame] = []
    sets: list[DataFrame] = []

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among ``pairs`` (a, b) that have not been tested before."""
        for before in tested:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        tested.append(cut_lineage(pairs.distinct(), "pairs"))
        possible = cut_lineage(bounded(tested[-1], classes, law), "possible")
        wanted = possible.select(F.col("a").alias("cid")).union(possible.select("b")).distinct()
        for known in sets:
            wanted = wanted.join(known.select("cid"), "cid", "left_anti")
        sets.append(cut_lineage(candidate_sets(docs, wanted.join(ids, "cid"), law), "sets"))
        return cut_lineage(verified(possible, reduce(DataFrame.unionByName, sets), law), "links")

    roots = components(confirmed(spokes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))), "a", "b")
    rooted = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    apart = spokes.join(rooted("a"), "a", "left").join(rooted("b"), "b", "left")
    apart = apart.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select(F.col("a_tag").alias("first"), F.col("b_tag").alias("tag"))
    open_keys = stars.join(apart, ["first", "tag"], "left_semi").select("key").distinct()
    inside = stars.join(open_keys, "key", "left_semi")
    members = inside.select("key", "tag").union(inside.select("key", "first")).distinct()
    members = cut_lineage(members.join(classes.select("tag", "cid"), "tag").drop("tag"), "members")

    # Copies of one text may each be close to it and not to each other. The text itself shares most with the others.
    inside = mixed_tiles(members, roots)
    shared = inside.groupBy("cid").agg(F.sum("size").alias("shared"))
    inside = cut_lineage(inside.join(shared, "cid"), "mixed")
    middle = inside.groupBy("key").agg(F.max(F.struct("shared", "cid", "root")).alias("middle"))
    around = inside.join(middle, "key").filter("root <> middle.root")
    more = confirmed(around.select(F.least("cid", "middle.cid").alias("a"), F.greatest("cid", "middle.cid").alias("b")))
    if not more.isEmpty():
        roots = extended(roots, more, "a", "b")

    # What is still in several components is compared in full.
    rest = cut_lineage(cross_component_pairs(mixed_tiles(members, roots), classes, law), "rest")
    if not rest.isEmpty():
        last = confirmed(rest)
        if not last.isEmpty():
            roots = extended(roots, last, "a", "b")
    joined = classes.select("cid", *digests, "doc_id").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cid"))
    least_id = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = joined.join(least_id, "root").select(*digests, "component_id", "root")
    out = signed.select("doc_id", "text_hash", *digests).join(known, digests, "left")
    return out.select("doc_id", "text_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "root")
