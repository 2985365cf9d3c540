"""Helpers shared by the operators: tables, columns, one model per worker process."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of whole texts that go to a Python worker at once. A batch is held by the JVM and by the worker, by each
# running task, and neither gives all of it back afterwards.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand at most ``BATCH_ROWS`` rows at once to Python in what ``spark`` runs from now on; a lower setting stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    return spark


def worker_once(key: Any, build: Callable[[], Any]) -> Any:
    """``build()``, kept for the life of the Python worker process.

    Functions sent by value come with fresh globals in each task, so what is costly to
    build (vocabularies) hangs on a module of the process instead. Spark uses a process for
    one stage after the other: what an earlier one built goes when another needs room.
    """
    state = sys.modules.setdefault("reelmart_worker_state", types.ModuleType("reelmart_worker_state"))
    kept = state.__dict__.setdefault("kept", {})
    if key not in kept:
        kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        kept[key] = build()
    return kept[key]


class BoundedCache(dict):
    """A dict that fills itself by ``make`` and starts over when it holds ``limit`` entries."""

    def __init__(self, make: Callable[[Any], Any], limit: int = 800_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: Any) -> Any:
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.make(key)
        return value


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet NULL keys; the right side's keys are dropped."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return left.join(other, condition, how).drop(*[f"_r_{k}" for k in keys])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by their first ``keys`` integer columns as tables of whole groups, with group borders.

    The last group of a batch waits for the next one, so at most a batch and a group are held.
    """
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        borders = group_borders(rows, keys)
        last = int(borders[-2]) if len(borders) > 1 else 0
        if last:
            yield rows.slice(0, last), borders[:-1]
        rest = rows.slice(last)
    if rest is not None and rest.num_rows:
        yield rest, group_borders(rest, keys)


def group_borders(rows: pa.Table, keys: int) -> np.ndarray:
    """Where groups start, and the number of rows."""
    n = rows.num_rows
    change = np.ones(n, bool)
    if n:
        change[1:] = False
        for k in range(keys):
            values = rows.column(k).combine_chunks().to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), n)


def spread_blocks(members: DataFrame, key: str, count: str, member: str, block: int) -> DataFrame:
    """``members`` of large groups dealt to pairs of blocks, so that every two meet in exactly one tile.

    Adds ``_i``, ``_j`` (tile) and ``_side`` (0 the first block, 1 the second). A group of up
    to ``block`` members is one tile; tiles hold about two blocks, whatever the group's size.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col(count) / F.lit(block))).cast("long")
    own = F.pmod(F.xxhash64(F.lit(77), member), F.col("_blocks"))
    dealt = members.withColumn("_blocks", blocks).withColumn("_own", own)
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    tile = {"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other"), "_side": F.when(F.col("_own") > F.col("_other"), 1).otherwise(0)}
    return dealt.withColumns(tile).drop("_blocks", "_own", "_other")
