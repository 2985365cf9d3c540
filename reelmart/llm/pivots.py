"""Exact top-k search by inner product with a table of distances to pivots.

The pivots are some vectors of the table. For a query q and a vector x every pivot p gives
|q - x| >= |d(q, p) - d(x, p)|; the largest of these bounds the inner product from above by
(|q|^2 + |x|^2 - bound^2) / 2. A query looks at vectors in the order of that bound and stops
when its k-th best score is above what is left.

Vectors live in cells named by their nearest pivots; the ranges of a cell's distances and norms
bound all its vectors at once. Each query looks into its most promising cells first. The k-th
score found there decides which cells it must see. Large cells are cut into tiles and many
queries of one cell into batches, so that a task holds one tile and one batch.

Equal vectors are one class, which keeps the ids a result can need and is searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.common import whole_groups
from reelmart.session import cut_lineage

SCALE = 64
PIVOTS, SAMPLE = 32, 1_000  # pivots are chosen from so many vectors
TILE, BATCH = 4096, 1024  # vectors of a tile, queries that meet it together
FIRST = 256  # vectors a query's first cells hold together
EXACT = float(1 << 52)  # products of norms below this have exact scores in double precision
SLACK = 2e-7  # relative error of a stored distance, generously
SLACK_32 = 4e-7  # the same with the rounding of sums in single precision
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

POINT = "cid long, least_id long, dim int, vector binary, norm double, near int, distances binary"


def whole_components(vector: str = "embedding") -> Column:
    """floor(64 x) of every component, cut to 64 bits; NULL for a vector that takes no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def classes_of(rows: DataFrame, keep: int) -> DataFrame:
    """``cid, v, ids`` of each distinct vector; ``ids`` are its ``keep`` smallest (NULL last).

    Limited before the shuffle, so copies of one vector reach their reducer as ``keep`` rows a task.
    """
    least = Window.partitionBy("v").orderBy(F.asc_nulls_last("vec_id"))
    few = rows.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= keep)
    ids = F.array_sort(F.collect_list(F.struct("place", "vec_id")))["vec_id"].alias("ids")
    return cut_lineage(few.groupBy("v").agg(ids).withColumn("cid", F.monotonically_increasing_id()), "classes")


def chosen_pivots(classes: DataFrame, count: int, sample: int) -> np.ndarray:
    """Vectors far from each other among about ``sample`` of the table: each the farthest from those before it.

    Only speed depends on the choice. At most 2 * ``sample`` vectors come to the driver.
    """
    every = max(1, classes.count() // sample)
    drawn = classes.filter(F.pmod(F.xxhash64("cid"), F.lit(every)) == 0).select("v").limit(2 * sample).collect() or classes.select("v").limit(sample).collect()
    width = max((len(r["v"]) for r in drawn), default=0)
    x = np.zeros((len(drawn), width))
    for k, r in enumerate(drawn):
        x[k, : len(r["v"])] = r["v"]
    taken, gap = [0], np.full(len(x), np.inf)
    for _ in range(min(count, len(x)) - 1):
        gap = np.minimum(gap, ((x - x[taken[-1]]) ** 2).sum(1))
        taken.append(int(gap.argmax()))
    return x[taken]


def packed_integers(x: np.ndarray) -> list[bytes]:
    """Rows of integers in as few bytes each as the largest needs."""
    size = next(s for s in (1, 2, 4, 8) if s == 8 or not x.size or (x.min() >= -(1 << 8 * s - 1) and x.max() < 1 << 8 * s - 1))
    return [r.tobytes() for r in x.astype(f"i{size}")]


def pivot_table(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with their distances to all pivots and the numbers of the two nearest (``near``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("v"))
            widths = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(widths).tolist():
                part = pa.Table.from_batches([batch]).filter(pa.array(widths == dim)).combine_chunks()
                exact = part.column("v").combine_chunks().flatten().to_numpy().reshape(part.num_rows, dim)
                x = np.zeros((len(exact), max(dim, pivots.shape[1])))
                x[:, :dim] = exact
                distances = np.empty((len(x), len(pivots)), np.float32)
                with np.errstate(over="ignore", invalid="ignore"):
                    for k, p in enumerate(pivots):
                        gap = x.copy()
                        gap[:, : len(p)] -= p
                        distances[:, k] = np.sqrt((gap * gap).sum(1))
                    norm = (x * x).sum(1)
                order = np.argsort(distances, axis=1, kind="stable")
                near = order[:, 0] * len(pivots) + order[:, min(1, len(pivots) - 1)]
                ids = part.column("cid").combine_chunks(), part.column("least_id").combine_chunks()
                columns = [*ids, pa.array(np.full(len(x), dim, np.int32)), pa.array(packed_integers(exact), pa.binary()), pa.array(norm)]
                columns += [pa.array(near.astype(np.int32)), pa.array([d.tobytes() for d in distances], pa.binary())]
                yield pa.record_batch(columns, ["cid", "least_id", "dim", "vector", "norm", "near", "distances"])

    source = classes.select("cid", F.col("ids")[0].alias("least_id"), "v")
    return cut_lineage(source.mapInArrow(run, POINT), "pivot-table")


def distances_of(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("distances").to_pylist()), np.float32).reshape(rows.num_rows, -1)


@dataclass
class Cells:
    """All cells, at most the square of the number of pivots: which vectors, how many, and their ranges."""

    of_near: np.ndarray
    sizes: np.ndarray
    low: np.ndarray
    high: np.ndarray
    norms: np.ndarray

    def bounds(self, norm: np.ndarray, distances: np.ndarray) -> np.ndarray:
        """No vector of a cell (column) has a higher score with a query (row)."""
        gap = np.zeros((len(norm), len(self.sizes)))
        for k in range(distances.shape[1]):
            d = distances[:, k, None].astype(np.float64)
            outside = np.maximum(self.low[None, :, k] * (1 - SLACK) - d * (1 + SLACK), d * (1 - SLACK) - self.high[None, :, k] * (1 + SLACK))
            np.fmax(gap, outside, out=gap)
        return score_bounds(norm[:, None], self.norms[None, :], gap)


def score_bounds(q: np.ndarray, x: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Upper bounds of scores from squared norms and a lower bound of the distance; too high by what rounding may cost."""
    with np.errstate(over="ignore", invalid="ignore"):
        both = q + x
        bound = (both - gap * gap) / 2 + 1e-9 * both + 0.5
    return np.maximum(np.where(np.isnan(bound), np.inf, bound), float(LOWEST))


def cells_of(points: DataFrame, pivots: int, tile: int) -> Cells:
    """The cells of the pivot table: by nearest pivot, by the second too where that one has many vectors."""
    schema = "near int, size long, low array<float>, high array<float>, norm double"

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            near, norm = batch.column("near").to_numpy(), batch.column("norm").to_numpy()
            if "distances" in batch.schema.names:
                low = high = distances_of(batch)
                size = np.ones(len(near), np.int64)
            else:
                low, high = (np.array(batch.column(c).to_pylist(), np.float32) for c in ("low", "high"))
                size = batch.column("size").to_numpy()
            for n in np.unique(near).tolist():
                own = near == n
                new = [int(size[own].sum()), low[own].min(0), high[own].max(0), float(norm[own].max())]
                old = held.get(n)
                held[n] = new if old is None else [old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2]), max(old[3], new[3])]
        if held:
            size, low, high, norm = zip(*held.values())
            columns = pa.array(list(held), pa.int32()), pa.array(size, pa.int64()), pa.array([x.tolist() for x in low], pa.list_(pa.float32()))
            yield pa.record_batch([*columns, pa.array([x.tolist() for x in high], pa.list_(pa.float32())), pa.array(norm)], ["near", "size", "low", "high", "norm"])

    partial = points.select("near", "norm", "distances").mapInArrow(ranges, schema)
    rows = partial.repartition("near").mapInArrow(ranges, schema).collect()
    total = np.zeros(pivots, np.int64)
    for r in rows:
        total[r["near"] // pivots] += r["size"]
    of_near, groups = np.full(pivots * pivots, -1, np.int32), {}
    for r in rows:
        first, alone = r["near"] // pivots, r["size"] >= tile // 2
        key = (first, r["near"]) if total[first] > tile and alone else (first, -1)
        groups.setdefault(key, []).append(r)
        of_near[r["near"]] = list(groups).index(key)
    whole = list(groups.values())
    low, high = ([extreme([np.array(r[c]) for r in g], axis=0) for g in whole] for c, extreme in (("low", np.min), ("high", np.max)))
    return Cells(of_near, np.array([sum(r["size"] for r in g) for g in whole]), np.array(low, np.float64), np.array(high, np.float64), np.array([max(r["norm"] for r in g) for g in whole]))


def visits(queries: DataFrame, cells: Cells, first_only: bool) -> DataFrame:
    """``queries`` once for each cell they look into: the most promising few, or all that may hold a result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm, distances = batch.column("norm").to_numpy(), distances_of(batch)
            floor = batch.column("reached").to_numpy(zero_copy_only=False).astype(np.float64)
            for a in range(0, len(norm), 256):
                bounds = cells.bounds(norm[a : a + 256], distances[a : a + 256])
                if first_only:
                    order = np.argsort(-bounds, axis=1, kind="stable")
                    before = np.cumsum(cells.sizes[order], axis=1) - cells.sizes[order]
                    row, place = np.nonzero(before < FIRST)
                    cell = order[row, place]
                else:
                    row, cell = np.nonzero(~(bounds < floor[a : a + 256, None]))
                told = batch.take(pa.array(row + a))
                yield pa.record_batch([*told.columns, pa.array(cell.astype(np.int32))], [*told.schema.names, "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema) + ", cell int"
    return queries.mapInArrow(run, schema)


def vectors_of(rows: pa.Table) -> np.ndarray:
    """The integer vectors of some rows, filled up with zeros to the longest."""
    dims, data = rows.column("dim").to_pylist(), rows.column("vector").to_pylist()
    out = np.zeros((len(dims), max(dims, default=0)), np.int64)
    for k, (dim, raw) in enumerate(zip(dims, data)):
        if dim:
            out[k, :dim] = np.frombuffer(raw, f"i{len(raw) // dim}")
    return out


def inner_products(x: np.ndarray, exact: np.ndarray, q: np.ndarray, small: bool) -> np.ndarray:
    """Integer scores, cut to 64 bits; ``x`` holds ``exact`` in double precision."""
    if small:
        return np.rint(x @ q).astype(np.int64)
    return np.array([min(HIGHEST, max(LOWEST, sum(int(a) * int(b) for a, b in zip(row, q)))) for row in exact], np.int64)


def shrunk_and_grown(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances less and plus their error, in single precision; such as say nothing (not finite) bound nothing."""
    finite = np.isfinite(distances)
    with np.errstate(over="ignore", invalid="ignore"):
        less, more = distances * np.float32(1 - SLACK_32), distances * np.float32(1 + SLACK_32)
    return np.where(finite, less, np.float32(-np.inf)), np.where(finite, more, np.float32(np.inf))


def least_gaps(queries: tuple[np.ndarray, np.ndarray], points: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Lower bounds of the distances of queries (row) and points (column), both as ``shrunk_and_grown`` by pivot (row).

    Two differences and two maxima for each pivot, in two buffers: all pairs of a tile come by here.
    """
    (q_less, q_more), (less, more) = queries, points
    gap, work = np.zeros((2, q_less.shape[1], less.shape[1]), np.float32)
    with np.errstate(over="ignore"):
        for k in range(len(less)):
            np.maximum(gap, np.subtract(q_less[k, :, None], more[k], out=work), out=gap)
            np.maximum(gap, np.subtract(less[k], q_more[k, :, None], out=work), out=gap)
    return gap


def tile_results(points: pa.Table, queries: pa.Table, keep: int) -> tuple[list, list, list, list]:
    """``qid, cid, least_id, score`` of the ``keep`` best vectors of a tile for each query, as far as they may count."""
    exact, asked = vectors_of(points), vectors_of(queries)
    width = min(exact.shape[1], asked.shape[1])
    exact, asked = exact[:, :width], asked[:, :width]
    x = exact.astype(np.float64)
    norms, q_norms = (t.column("norm").to_numpy() for t in (points, queries))
    sides, q_sides = (shrunk_and_grown(np.ascontiguousarray(distances_of(t).T)) for t in (points, queries))
    cids, least = (points.column(c).to_pylist() for c in ("cid", "least_id"))
    tie = np.array([HIGHEST if v is None else v for v in least], np.int64)
    floors = queries.column("reached").to_numpy(zero_copy_only=False).astype(np.float64)
    out: tuple[list, list, list, list] = [], [], [], []
    for a in range(0, queries.num_rows, 64):
        some = slice(a, a + 64)
        gap = least_gaps(tuple(side[:, some] for side in q_sides), sides).astype(np.float64)
        bounds = score_bounds(q_norms[some, None], norms[None, :], gap)
        for k in range(len(bounds)):
            own, floor = bounds[k], floors[a + k]
            alive = np.arange(len(own)) if np.isnan(floor) else np.flatnonzero(own >= floor)
            alive = alive[np.argsort(-own[alive], kind="stable")]
            small = bool(np.sqrt(q_norms[a + k]) * np.sqrt(norms.max()) < EXACT)
            q = asked[a + k].astype(np.float64) if small else asked[a + k]
            best, scores, whole, start, size = np.empty(0, np.int64), np.empty(0, np.int64), None, 0, 4 * keep
            while start < len(alive) and (len(best) < keep or own[alive[start]] >= scores[-1]):
                part = alive[start : start + size]
                if small and whole is None and 8 * (start + size) > len(x):
                    whole = inner_products(x, exact, q, small)  # costs less than picking so many rows
                if whole is not None:
                    new = whole[part]
                else:
                    new = inner_products(x[part], exact if small else exact[part], q, small)
                best, scores = np.append(best, part), np.append(scores, new)
                if len(best) > keep:
                    high = scores >= np.partition(scores, -keep)[-keep]
                    best, scores = best[high], scores[high]
                # the order of scores may not overflow: ~s falls as s rises
                order = np.lexsort((tie[best], ~scores))[:keep]
                best, scores = best[order], scores[order]
                start, size = start + size, size * 2
            qid = queries.column("cid")[a + k].as_py()
            out[0].extend([qid] * len(best))
            out[1].extend(cids[i] for i in best)
            out[2].extend(least[i] for i in best)
            out[3].extend(scores.tolist())
    return out


def searched(points: DataFrame, visiting: DataFrame, cells: Cells, keep: int, tile: int, batch: int, first_tile: bool) -> DataFrame:
    """``qid, cid, least_id, score, place``: the ``keep`` best classes of each query in the cells it visits."""
    spark = points.sparkSession
    asked = {r["cell"]: r["n"] for r in visiting.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = [(c, -(-int(cells.sizes[c]) // tile), -(-n // batch)) for c, n in asked.items()]
    plan = F.broadcast(spark.createDataFrame(plan, "cell int, tiles long, batches long"))  # a row per cell at most
    near = F.broadcast(spark.createDataFrame([(n, int(c)) for n, c in enumerate(cells.of_near) if c >= 0], "near int, cell int"))
    own_tile = F.pmod(F.xxhash64("cid"), F.col("tiles")).alias("tile")
    own_batch = F.pmod(F.xxhash64(F.lit(1), "cid"), F.col("batches")).alias("batch")
    last = F.lit(0).cast("long") if first_tile else F.col("tiles") - 1
    point = ["cid", "least_id", "dim", "vector", "norm", "distances"]
    sides = [
        points.join(near, "near").join(plan, "cell").select(*point, F.lit(None).cast("long").alias("reached"), "cell", own_tile, F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches") - 1)).alias("batch"), F.lit(0).cast("long").alias("side")),
        visiting.join(plan, "cell").select(*point, "reached", "cell", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("tile"), own_batch, F.lit(1).cast("long").alias("side")),
    ]
    if first_tile:
        sides[0] = sides[0].filter("tile = 0")
    order = ["cell", "tile", "batch"]
    dealt = sides[0].unionByName(sides[1]).select(*order, "side", *point, "reached").repartition(*order).sortWithinPartitions(*order, "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, borders in whole_groups(batches, len(order)):
            side = rows.column("side").combine_chunks().to_numpy()
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                middle = a + int(np.searchsorted(side[a:b], 1))
                if a < middle < b:
                    found = tile_results(rows.slice(a, middle - a), rows.slice(middle, b - middle), keep)
                    yield pa.record_batch([pa.array(f, pa.int64()) for f in found], ["qid", "cid", "least_id", "score"])

    best = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc_nulls_last("least_id"))
    found = dealt.mapInArrow(run, "qid long, cid long, least_id long, score long")
    return cut_lineage(found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep), "found")


def top_matches(vectors: DataFrame, k: int = 20, every: int = 20, pivots: int = PIVOTS, sample: int = SAMPLE, tile: int = TILE, batch: int = BATCH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the highest scores for each row whose id ``every`` divides.

    ``vectors`` has ``vec_id, embedding``; other columns are not read. The score is the inner
    product of the vectors' ``whole_components``; vectors that are NULL or hold a NULL or
    non-finite component take no part. Of vectors of different lengths the shorter one counts as
    filled up with zeros, an empty one as zero. Components and scores beyond 64 bits count as
    the nearest number of 64 bits. A row is not matched with itself; rows that repeat its id or
    vector are. Rows without an id are matched, after equal scores with one, but ask nothing.
    Ties go to the smaller id. An empty table gives no rows.
    """
    keep = k + 1  # one of them may be the query's own row
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_components().alias("v")).filter("v IS NOT NULL")
    classes = classes_of(rows, keep)
    asking = rows.filter(F.col("vec_id") % every == 0).join(classes.select("v", "cid"), "v").select(F.col("vec_id").alias("query_id"), F.col("cid").alias("qid"))
    asking = cut_lineage(asking, "asking")
    chosen = chosen_pivots(classes, pivots, sample) if not classes.isEmpty() else np.zeros((1, 0))
    points = pivot_table(classes, chosen)
    cells = cells_of(points, len(chosen), tile)
    queries = points.join(asking.select(F.col("qid").alias("cid")).distinct(), "cid").drop("near")
    queries = cut_lineage(queries.withColumn("reached", F.lit(None).cast("long")), "queries")
    first = searched(points, cut_lineage(visits(queries, cells, True), "visits"), cells, keep, tile, batch, True)
    reached = first.filter(F.col("place") == keep).select(F.col("qid").alias("cid"), F.col("score").alias("reached"))
    known = queries.drop("reached").join(reached, "cid", "left")
    found = searched(points, cut_lineage(visits(known, cells, False), "visits"), cells, keep, tile, batch, False)
    members = found.select("qid", "cid", "score").join(classes.select("cid", F.explode("ids").alias("vec_id")), "cid")
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), (F.col("cid") != F.col("qid")))
    listed = members.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    match = F.struct("place", "vec_id", "score", (F.col("cid") == F.col("qid")).alias("own"))
    lists = listed.groupBy("qid").agg(F.array_sort(F.collect_list(match)).alias("matches"))
    met = asking.join(lists, "qid")
    itself = F.array_position(F.transform("matches", lambda m: F.coalesce(m["own"] & (m["vec_id"] == F.col("query_id")), F.lit(False))), True)
    told = met.select("query_id", itself.alias("itself"), F.explode("matches").alias("m")).filter("m.place <> itself")
    rank = F.col("m.place") - F.when((F.col("itself") > 0) & (F.col("m.place") > F.col("itself")), 1).otherwise(0)
    return told.select("query_id", rank.cast("int").alias("rank"), "m.vec_id", "m.score").filter(F.col("rank") <= k)
