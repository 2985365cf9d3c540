"""Embedding near-dedup by Euclidean p-stable hashing and exact cosine checks.

Each unit vector is projected on Gaussian directions, shifted and cut into steps; a table's
bucket is what ``hashes`` such steps say together. Vectors that share a bucket in one of the
tables are compared exactly. A pair that shares several buckets counts in the first one
only, so no list of pairs is needed to count links.

For two vectors at distance c one hash agrees with probability
1 - 2 N(-w/c) - sqrt(2/pi) c/w (1 - exp(-w^2 / 2c^2)); with the defaults a pair at cosine 0.93 is
found with probability 0.97, one at 0.96 with 0.999, one of unrelated vectors meets in a
table with 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import spread_blocks, whole_groups
from reelmart.llm.components import components
from reelmart.session import cut_lineage

TABLES, HASHES, STEP, SEED = 48, 16, 2.0, 424_242
BLOCK = 1024  # vectors of a large bucket compared with as many others in one tile


class Projections:
    """The hash functions, made anew for each dimension from the seed."""

    def __init__(self, tables: int, hashes: int, step: float, seed: int):
        self.tables, self.hashes, self.step, self.seed, self.made = tables, hashes, step, seed, {}

    def keys(self, units: np.ndarray) -> np.ndarray:
        """Bucket numbers (vector by table) of unit vectors of one dimension."""
        dimension = units.shape[1]
        if dimension not in self.made:
            rng = np.random.default_rng([self.seed, dimension])
            count = self.tables * self.hashes
            odd = rng.integers(0, 2**63, count, dtype=np.int64) * 2 + 1
            self.made[dimension] = rng.standard_normal((dimension, count)), rng.uniform(0, self.step, count), odd
        directions, shift, odd = self.made[dimension]
        cells = np.floor((units @ directions + shift) / self.step).astype(np.int64)
        with np.errstate(over="ignore"):
            mixed = (cells * odd).reshape(len(units), self.tables, self.hashes).sum(2)
            return mixed ^ (mixed >> 29) * 7 + np.arange(self.tables) * 1_000_003 + dimension


def usable(vector: str = "embedding") -> Column:
    """Vectors that can have a cosine: all components finite, not all zero."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def bucket_keys(classes: DataFrame, projections: Projections) -> DataFrame:
    """``cid, label, weight, unit, keys`` of each class of identical vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("embedding"))
            widths = np.diff(lists.offsets.to_numpy())
            for width in np.unique(widths).tolist():
                part = pa.Table.from_batches([batch]).filter(pa.array(widths == width)).combine_chunks()
                flat = part.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                x = flat.reshape(-1, width).astype(np.float64)
                x = x / np.abs(x).max(1, keepdims=True)
                x = x / np.sqrt((x * x).sum(1, keepdims=True))
                label = part.column("label").to_numpy().astype(np.int64)
                keys = projections.keys(x) + (label * 0x9E3779B97F4A7C)[:, None]
                columns = [part.column("cid").combine_chunks(), part.column("label").combine_chunks().cast(pa.int64()), part.column("weight").combine_chunks()]
                columns.append(pa.array([r.tobytes() for r in x], pa.binary()))
                columns.append(pa.array(list(keys), pa.list_(pa.int64())))
                yield pa.record_batch(columns, ["cid", "label", "weight", "unit", "keys"])

    return classes.mapInArrow(run, "cid long, label long, weight long, unit binary, keys array<long>")


def star_labels(linked: np.ndarray) -> np.ndarray:
    """The least index reachable in a symmetric link matrix, for each index."""
    label, size = np.arange(len(linked)), len(linked)
    while True:
        reach = np.where(linked, label[None, :], size).min(1)
        new = np.minimum(label, reach)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def tile_links(rows: pa.Table, start: int, stop: int, cosine: float, columns: dict[str, np.ndarray]) -> tuple | None:
    """Links of one tile: ids, weighted links counted here, and the least id each is tied to."""
    own = slice(start, stop)
    units = np.frombuffer(b"".join(rows.column("unit").slice(start, stop - start).to_pylist()))
    units = units.reshape(stop - start, -1)
    cid, side, weight, keys = columns["cid"][own], columns["_side"][own], columns["weight"][own], columns["keys"][own]
    close = units @ units.T >= cosine
    np.fill_diagonal(close, False)
    close &= columns["label"][own][:, None] == columns["label"][own][None, :]
    if columns["_i"][start] != columns["_j"][start]:
        close &= side[:, None] != side[None, :]
    if not close.any():
        return None
    counted = np.zeros(len(cid), np.int64)
    table = int(columns["table"][start])
    for i in np.flatnonzero(close.any(1)):
        with_ = np.flatnonzero(close[i])
        first = ~(keys[i, :table] == keys[with_, :table]).any(1)
        counted[i] = weight[with_[first]].sum()
    linked = close.any(1)
    root = star_labels(close)
    return cid[linked], counted[linked], cid[root[linked]]


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, tables: int = TABLES, hashes: int = HASHES, step: float = STEP, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors`` (vec_id, embedding, label).

    Only rows with the same label that is not NULL are compared, in double precision.
    Vectors that are NULL, empty or zero, or hold a NULL or non-finite component link with
    nothing, as do vectors of different lengths. Identical vectors are one class with a
    weight, so a thousand copies cost as much as one. Repeated ids are separate vectors. An
    empty table gives no rows; columns other than the three are not read.
    """
    source = vectors.select("vec_id", "label", "embedding")
    fit = F.col("label").isNotNull() & usable()
    classes = source.filter(fit).groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least_id"))
    classes = cut_lineage(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    hashed = cut_lineage(bucket_keys(classes.select("cid", "label", "weight", "embedding"), Projections(tables, hashes, step, seed)), "hashed")
    slots = hashed.select("cid", F.posexplode("keys").alias("table", "key"))
    shared = slots.groupBy("table", "key").agg(F.count("*").alias("size")).filter("size > 1")
    members = cut_lineage(slots.join(shared, ["table", "key"]), "buckets")
    tiles = spread_blocks(members, "key", "size", "cid", block).join(hashed, "cid")
    order = ["table", "key", "_i", "_j"]
    tiles = tiles.select(*order, "_side", "cid", "label", "weight", "unit", "keys")
    sorted_tiles = tiles.repartition(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, borders in whole_groups(batches, len(order)):
            columns = {c: rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in rows.schema.names if c not in ("unit", "keys")}
            columns["keys"] = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                if b - a > 1 and (found := tile_links(rows, a, b, cosine, columns)):
                    yield pa.record_batch([pa.array(f) for f in found], ["cid", "links", "root"])

    found = cut_lineage(sorted_tiles.mapInArrow(run, "cid long, links long, root long"), "links")
    degrees = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.filter("cid != root"), "cid", "root").withColumnRenamed("node", "cid")
    joined = classes.join(degrees, "cid", "left").join(roots, "cid", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cid"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    totals = (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    known = joined.join(least, "root").select("label", "embedding", totals, "component_id")
    out = source.withColumn("_fit", fit).join(known.withColumn("_fit", F.lit(True)), ["label", "embedding", "_fit"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
