"""Sharding by a keyed permutation of global row numbers (native: built-in functions only).

Rows get dense global numbers in the order of id, size, checksum. A Feistel network over a
rectangle of at least as many cells permutes them; numbers that land outside walk on along
their cycle until they are inside. Shard and slot are the remainder and quotient of the
permuted number, so both can be computed from the number alone, for any row, in either
direction, and shard sizes differ by one row at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.session import cut_lineage

PRIME = 2_147_483_647  # of the field in which round functions are computed
ROUNDS = 6


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Multiplier and addend of each round, from a congruential generator started at ``seed``."""
    keys, state = [], seed % PRIME
    for _ in range(rounds):
        pair = []
        for _ in range(2):
            state = (state * 48_271 + 12_345) % PRIME
            pair.append(1 + state % (PRIME - 1))
        keys.append((pair[0], pair[1]))
    return keys


def rectangle(rows: int) -> tuple[int, int]:
    """Sides whose product is at least ``rows`` and exceeds it by less than one side."""
    height = max(1, math.isqrt(max(rows, 1)))
    return height, max(1, -(-rows // height))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: nesting plain columns would double the expression each round."""
    return F.element_at(F.transform(F.array(value), use), 1)


def mixed(half: Column, times: Column, plus: Column) -> Column:
    """A cubic over the prime field of one half and a round's keys."""
    linear = (F.pmod(half, F.lit(PRIME)) * times + plus) % F.lit(PRIME)
    return bound(linear, lambda t: (t * t) % F.lit(PRIME) * t % F.lit(PRIME))


def permuted_once(df: DataFrame, column: str, sides: tuple[int, int], seed: int, keep_below: int | None = None) -> DataFrame:
    """One pass of ``column`` through the network; values below ``keep_below`` stay as they are.

    Each round adds a function of one coordinate to the other, modulo that one's side.
    """
    height, width = (F.lit(side).cast("long") for side in sides)
    keys = F.array(*[F.struct(F.lit(t).alias("times"), F.lit(p).alias("plus")) for t, p in round_keys(seed)])
    start = F.struct(
        F.expr(f"{column} div {sides[1]}").alias("high"),
        (F.col(column) % width).alias("low"),
        F.lit(True).alias("on_high"),
    )

    def one_round(state: Column, key: Column) -> Column:
        source = F.when(state["on_high"], state["low"]).otherwise(state["high"])
        step = lambda m: F.struct(
            F.when(state["on_high"], (state["high"] + m) % height).otherwise(state["high"]).alias("high"),
            F.when(state["on_high"], state["low"]).otherwise((state["low"] + m) % width).alias("low"),
            (~state["on_high"]).alias("on_high"),
        )
        return bound(mixed(source, key["times"], key["plus"]), step)

    moved = F.aggregate(keys, start, one_round, lambda state: state["high"] * width + state["low"])
    if keep_below is not None:
        moved = F.when(F.col(column) < F.lit(keep_below), F.col(column)).otherwise(moved)
    return df.withColumn(column, moved)


def longest_walk(df: DataFrame, rows: int, seed: int) -> int:
    """Passes after which every number below ``rows`` is back inside.

    Only numbers outside can prolong a walk, and there are fewer of them than one side of
    the rectangle (about the square root of the rows), so they are followed themselves.
    """
    sides = rectangle(rows)
    spark, passes = df.sparkSession, 1
    outside = spark.range(rows, sides[0] * sides[1]).select(F.col("id").alias("at"))
    while not outside.isEmpty():
        outside = permuted_once(outside, "at", sides, seed).filter(F.col("at") >= rows)
        passes += 1
    return passes


def permuted(df: DataFrame, column: str, rows: int, seed: int) -> DataFrame:
    """``column`` (0 .. rows - 1) replaced by its image under the seed's permutation."""
    sides = rectangle(rows)
    passes = longest_walk(df, rows, seed)
    df = permuted_once(df, column, sides, seed)
    for _ in range(passes - 1):
        df = permuted_once(df, column, sides, seed, keep_below=rows)
    return df


def global_numbers(df: DataFrame, order: list[str], number: str = "row_no") -> tuple[DataFrame, int]:
    """Dense numbers from 0 in the order given, and how many there are.

    Sorted slices are written once, so that numbers survive a recomputation. Rows alike in
    all of ``order`` are dealt by their place in the input and split over slices too. What
    the driver gets is one count per slice.
    """
    placed = cut_lineage(df.withColumn("_place", F.monotonically_increasing_id()), "placed")
    keys = [*order, "_place"]
    sliced = (
        placed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_place")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumns({"_slice": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
        .drop("_id")
    )
    sliced = cut_lineage(sliced, "numbered")
    counts = sorted(tuple(r) for r in sliced.groupBy("_slice").count().collect())
    shifts, total = [], 0
    for piece, count in counts:
        shifts.append((piece, total))
        total += count
    shift = df.sparkSession.createDataFrame(shifts, "_slice long, _shift long")
    numbered = sliced.join(F.broadcast(shift), "_slice").withColumn(number, F.col("_shift") + F.col("_at"))
    return numbered.drop("_slice", "_shift", "_at"), total


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one for the separator; no text counts one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def shuffled_shards(docs: DataFrame, shards: int = 8, seed: int = 20_240_601) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``.

    The law is ``rows``: shard sizes differ by one at most, slots run from 0 without gaps.
    NULL text has size 1 and the checksum of the empty text; NULL and repeated ids are
    ordinary rows; an empty table gives no rows. Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", text_size(text).alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    numbered, rows = global_numbers(narrow, ["doc_id", "size", "text_crc32"])
    spread = permuted(numbered, "row_no", rows, seed) if rows else numbered
    return spread.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("row_no") % shards).cast("int").alias("shard"),
        F.expr(f"row_no div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
