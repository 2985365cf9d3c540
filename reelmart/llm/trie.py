"""Prefix trie of conversations by van Emde Boas recursion over their depth.

A stretch of 2^k turns is cut at half its depth: the upper half is a trie of its own, and each
distinct prefix at the cut becomes the root of a trie of what follows. All stretches of one size
are handled by the same job, so a trie of depth D takes log2(D) rounds each way:

1. names of stretches, upward: two neighbours of 2^k turns give the name of one of 2^(k+1);
2. roots, downward: the upper half keeps the root of its stretch, the lower half gets the root
   named after (root, name of the upper half), until every position of every conversation knows
   the name of the prefix before it;
3. totals, upward again: what a lower trie holds is grafted on the prefix it hangs from and on
   that prefix's ancestors within the upper half.

Rows stay (conversation, position): no conversation and no group of copies meets in one task.
Names are 16 bytes of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.operators.paging import number_within
from reelmart.session import cut_lineage

ROOT = b""
WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 18  # characters of a list of ids that are hashed at a time


def name_of(*parts: Column) -> Column:
    """A name of 16 bytes for some binary parts whose lengths are known or written in front."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn_name, words``: the turns of each conversation, numbered from 1.

    NULL role and text are empty. Turns are ordered by ``turn`` (NULL first), equal ones by
    role and SHA-256 of the text, so repeated rows are turns of their own. Rows without a
    conversation id belong to none. Other columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    split = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("said"),
        name_of(split).alias("turn_name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    numbered = number_within(rows, "conv_id", ["turn", "role", "said"])
    return numbered.select("conv_id", F.col("row_no").alias("pos"), "turn_name", "words")


def shared_openings(turns: DataFrame, family: int = 20, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the opening of their family's first one: turns, and all ids.

    The first h turns of conversation c are replaced by those of c - c % ``family`` (fewer, if
    it has fewer; none, if it is absent); h is the CRC-32 of the decimal id modulo ``longest``.
    """
    ids = turns.select("conv_id").distinct()
    base = F.col("conv_id") - F.col("conv_id") % family
    h = F.when(F.col("conv_id") == base, 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % longest)
    heads = turns.filter((F.col("conv_id") == base) & (F.col("pos") < longest)).withColumnRenamed("conv_id", "base")
    taken = ids.select("conv_id", base.alias("base"), h.alias("h")).join(heads, "base").filter("pos <= h")
    given = heads.groupBy("base").agg(F.max("pos").alias("given"))
    own = turns.withColumns({"base": base, "h": h}).filter("pos > h").join(given, "base", "left")
    depth = F.col("pos") - F.col("h") + F.least("h", F.coalesce("given", F.lit(0)))
    columns = ["conv_id", "depth", "turn_name", "words"]
    rebuilt = taken.withColumnRenamed("pos", "depth").select(columns).unionByName(own.withColumn("depth", depth).select(columns))
    return rebuilt, ids


def stretch_names(turns: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k: ``conv_id, block, name`` of each whole stretch of 2^k turns that starts at block * 2^k."""
    named = [turns.select("conv_id", (F.col("depth") - 1).alias("block"), F.col("turn_name").alias("name"))]
    for _ in range(1, levels):
        odd = F.col("block") % 2 == 1
        pair = named[-1].groupBy("conv_id", F.shiftright("block", 1).alias("above")).agg(
            F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right"))
        both = pair.filter("left IS NOT NULL AND right IS NOT NULL")
        whole = both.select("conv_id", F.col("above").alias("block"), name_of(F.col("left"), F.col("right")).alias("name"))
        named.append(cut_lineage(whole, "stretches"))
    return named


def prefix_places(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, depth, node, n_turns``: the name of every prefix of every conversation, the empty one included."""
    lengths = ids.join(turns.groupBy("conv_id").agg(F.max("depth").alias("n_turns")), "conv_id", "left")
    lengths = cut_lineage(lengths.withColumn("n_turns", F.coalesce("n_turns", F.lit(0)).cast("long")), "lengths")
    longest = lengths.agg(F.max("n_turns")).first()[0] or 0
    levels = int(longest).bit_length()
    names = stretch_names(turns, levels)
    roots = lengths.select("conv_id", "n_turns", F.lit(0).cast("long").alias("block"), F.lit(ROOT).alias("node"))
    for k in reversed(range(levels)):
        halves = roots.withColumn("block", F.col("block") * 2)
        lower = halves.filter(F.shiftleft(F.col("block") + 1, k) <= F.col("n_turns")).join(names[k], ["conv_id", "block"])
        lower = lower.select("conv_id", "n_turns", (F.col("block") + 1).alias("block"), name_of("node", "name").alias("node"))
        roots = cut_lineage(halves.unionByName(lower), "roots")
    return roots.withColumnRenamed("block", "depth")


def grafted(nodes: DataFrame, places: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` with each of ``values`` replaced by its sum over the node's subtree.

    ``nodes`` holds ``node, parent, depth, conv_id`` (a member). Merging stretches of 2^k turns,
    the sum over a lower trie goes to the prefix it hangs from and to that prefix's ancestors in
    the upper half, which any conversation through it names.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = [F.sum(v).alias(v) for v in values]

    def with_lower(state: DataFrame, add: DataFrame) -> DataFrame:
        added = add.select("node", *[F.col(v).alias(f"_{v}") for v in values])
        plus = {v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values}
        return state.join(added, "node", "left").withColumns(plus).drop(*[f"_{v}" for v in values])

    state = nodes
    for k in range(max(0, int(deepest - 1)).bit_length()):
        tops = state.filter((F.col("depth") > 0) & ((F.col("depth") - 1) % (2 << k) == 1 << k))
        hung = tops.groupBy(F.col("parent").alias("node")).agg(
            F.min("conv_id").alias("conv_id"), F.shiftright(F.min("depth") - 2, k).alias("stretch"), *sums)
        if k:
            inside = places.filter("depth > 0").select("conv_id", F.shiftright(F.col("depth") - 1, k).alias("stretch"), "node")
            hung = hung.drop("node").join(inside, ["conv_id", "stretch"]).groupBy("node").agg(*sums)
        state = cut_lineage(with_lower(state, hung), "grafted")
    return with_lower(state, state.filter("depth = 1").groupBy(F.lit(ROOT).alias("node")).agg(*sums))


def prefix_nodes(turns: DataFrame, places: DataFrame) -> DataFrame:
    """One row per distinct prefix: ``node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``.

    ``conv_id`` is the smallest member. Without conversations there is no node.
    """
    found = cut_lineage(places.groupBy("node", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "nodes")
    above = places.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    told = found.join(above, ["conv_id", "depth"], "left").join(turns.select("conv_id", "depth", "words"), ["conv_id", "depth"], "left")
    told = cut_lineage(told, "nodes")
    children = told.filter("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = told.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    counted = counted.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0)),
    })
    whole = cut_lineage(grafted(cut_lineage(counted.drop("words"), "counted"), places, ["n_leaves", "saved_tokens"]), "totals")
    # the children of the root, often most nodes, need no join; a busy node further down is split by adaptive execution
    least = whole.filter("depth = 0").first()
    least = least["conv_id"] if least else None
    first = whole.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(least)).cast("long"))
    named = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return first.unionByName(whole.filter("depth > 1").join(named, "parent"))


def id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node as comma-joined text, a bounded piece at a time."""
    node, first, held, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.record_batch([pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(held)])], ["node", "first", "ids"])

    for batch in batches:
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (n != node or size >= CHUNK):
                yield piece()
                held, size = [], 0
            if not held:
                node, first = n, c
            held.append(str(c))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def id_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's text, fed piece by piece in order."""
    node, digest = None, None

    def line() -> pa.RecordBatch:
        return pa.record_batch([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    for batch in batches:
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if digest is None or n != node:
                if digest is not None:
                    yield line()
                node, digest = n, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if digest is not None:
        yield line()


def end_digests(places: DataFrame) -> DataFrame:
    """``node, ends_sha256``: SHA-256 of the ids of the conversations that end at a node.

    Ids are ascending, comma-joined. Sorted slices make the text in parallel; a node with very
    many ends gives its task only a row per piece, and no list is held.
    """
    ends = places.filter(F.col("depth") == F.col("n_turns")).select("node", "conv_id")
    sliced = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = sliced.mapInArrow(id_chunks, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(id_hashes, "node binary, ends_sha256 string")


def conversation_trie(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of numbered turns, and which conversation has which prefix.

    ``turns`` holds ``conv_id, depth (from 1, gapless), turn_name, words``; conversations of
    ``ids`` without turns are members of the root only.
    """
    turns = cut_lineage(turns, "turns")
    places = prefix_places(turns, ids)
    return prefix_nodes(turns, places), places


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations (``shared_openings``) with a digest of the ends of each node."""
    turns = cut_lineage(numbered_turns(conversations), "numbered")
    nodes, places = conversation_trie(*shared_openings(turns))
    none = F.sha2(F.lit(b""), 256)
    told = nodes.join(end_digests(places), "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    return told.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
