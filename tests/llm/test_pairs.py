"""Operators on pairs, against brute force on small fixtures."""

import collections

import numpy as np
import pytest

from reelmart.llm import common, components, embeddings, ngrams


def components_by_hand(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(0)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = components_by_hand({x for link in links for x in link}, links)
    assert got == {n: r for n, r in want.items() if n in got}
    assert {n for n, r in want.items() if r != n} <= set(got)


def test_few_edges_and_many_give_the_same_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1050)]
    frame = spark.createDataFrame(links, "a long, b long")
    few, many = (sorted(map(tuple, components.components(frame, "a", "b", limit).collect())) for limit in (1000, 0))
    assert few == many
    edges = spark.createDataFrame([(b, a) for a, b in links if a < b], "node long, other long").coalesce(1)
    assert "Exchange" not in components.one_round(edges, few=True)._jdf.queryExecution().executedPlan().toString()


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_components_after_more_links(spark):
    rng = np.random.default_rng(1)
    first = [(int(a), int(b)) for a, b in rng.integers(0, 400, (150, 2))]
    more = [(int(a), int(b)) for a, b in rng.integers(0, 600, (120, 2))] + [(700, 700), (5, 5)]
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    rows = components.extended(components.components(frame(first), "a", "b"), frame(more), "a", "b").collect()
    got = {r.node: r.root for r in rows}
    want = components_by_hand({x for link in first + more for x in link}, first + more)
    assert len(got) == len(rows)
    assert got == {n: r for n, r in want.items() if n in got}
    assert {n for n, r in want.items() if r != n} <= set(got)


def test_pairs_of_a_tile_that_share_little_are_ruled_out():
    # Documents of 480 shingles with a third in common: bitmaps of 1,024 bits.
    rng = np.random.default_rng(2)
    common = rng.integers(0, 2**64, 160, np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(0, 2**64, 320, np.uint64)])) for _ in range(300)]
    sets[1] = np.sort(np.concatenate([sets[0][:-20], rng.integers(0, 2**64, 20, np.uint64)]))
    ids = np.arange(300)
    columns = {"cid": ids, "root": ids, "n_shingles": np.array([len(s) for s in sets]), "sketch": [ngrams.sketch(ngrams.parity_bitmap(s)) for s in sets]}
    columns |= {c: np.zeros(300, np.int64) for c in ("_i", "_j", "_side")}
    a, b = ngrams.tile_survivors(columns, 0, 300, ngrams.Law(5, 80))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 1)]


def sets_of(rows, words):
    out = []
    for _, text in rows:
        found = (text or "").encode().lower().split()
        width = min(words, len(found))
        out.append({tuple(found[k : k + width]) for k in range(len(found) - width + 1)} if found else set())
    return out


def linked_documents(rows, words, percent):
    sets = sets_of(rows, words)
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return sets, components_by_hand(range(len(rows)), links)


def texts(rng, count):
    """Unrelated texts, chains of near copies and exact copies, of many lengths."""
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    while len(out) < count:
        text = list(rng.choice(vocabulary, int(rng.integers(1, 160))))
        for _ in range(int(rng.integers(1, 6))):
            out.append(" ".join(text))
            text = list(text)
            for _ in range(int(rng.integers(0, 1 + len(text) // 40 + 1))):
                text[int(rng.integers(0, len(text)))] = str(rng.choice(vocabulary))
    return out[:count]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_similar_documents(spark, words, percent):
    rows = list(enumerate(texts(np.random.default_rng(words), 400)))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "a\x1fb"), (1007, "É é")]
    sets, group = linked_documents(rows, words, percent)
    least = {i: rows[g][0] for i, g in group.items()}
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngrams.similar_documents(docs, words, percent).collect()}
    assert got == {doc: (len(sets[i]), least[i]) for i, (doc, _) in enumerate(rows)}


def test_similar_documents_with_repeated_and_missing_ids(spark):
    same = " ".join(f"a{k}" for k in range(30))
    rows = [(1, same), (1, same), (1, "quite another text of its own"), (None, same + " more"), (None, None)]
    got = ngrams.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert len(got) == 5 and {r.component_id for r in got if r.n_shingles in (28, 29)} == {1}
    one = ngrams.one_of_each(spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, _hash string, root int"), 3, 90)
    assert sorted((r.doc_id or 0, r.text or "") for r in one.collect()) == [(0, ""), (0, same + " more"), (1, rows[2][1])]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngrams.similar_documents(empty).count() == 0 and ngrams.one_of_each(empty).count() == 0


def test_a_large_tile_is_split(spark, monkeypatch):
    """Members of one tile that only a chain holds together, with blocks smaller than the tile."""
    base = [f"b{k}" for k in range(200)]
    rows = []
    for k in range(40):
        rows.append((k, " ".join(base)))
        base[5 * k % 200] = f"new{k}"
    sets, group = linked_documents(rows, 3, 90)
    monkeypatch.setattr(ngrams.cross_component_pairs, "__defaults__", (4,))
    got = {r.doc_id: r.component_id for r in ngrams.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: rows[g][0] for i, g in group.items()}


def test_parts_keep_the_promise():
    """Two sets that link share a tile name: the pigeonhole of the parts, on random sets."""
    rng = np.random.default_rng(2)
    for words, percent in ((3, 90), (5, 80)):
        law = ngrams.Law(words, percent)
        for size in (5, 9, 10, 11, 30, 100, 700):
            for _ in range(30):
                a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
                gone = int(rng.integers(0, size // 5 + 1))
                b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, int(rng.integers(0, size // 5 + 1)), dtype=np.uint64)]))
                shared = len(np.intersect1d(a, b))
                if law.enough(shared, len(a) + len(b)) and shared < len(a) + len(b) - shared:
                    assert set(law.keys(a).tolist()) & set(law.keys(b).tolist())


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 16))
    near = base[:20].repeat(5, 0) + 0.05 * rng.standard_normal((100, 16))
    vectors = [*base.tolist(), *near.tolist(), *base[:5].tolist(), (3 * base[0]).tolist()]
    labels = [k % 2 for k in range(60)] + [k // 5 % 2 for k in range(100)] + [0, 1, 0, 1, 0] + [0]
    rows = [(k, [float(np.float32(x)) for x in v], label) for k, (v, label) in enumerate(zip(vectors, labels))]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array(labels)
    close = (x @ x.T >= 0.93) & (y[:, None] == y[None, :])
    np.fill_diagonal(close, False)
    group = components_by_hand(range(len(rows)), zip(*np.nonzero(close)))
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [None] * 16, 0), (904, [float("inf")] + [0.0] * 15, 0), (905, [], 0)]
    odd += [(906, rows[0][1], None), (907, [1.0, 2.0], 0), (908, [1.0, 2.0], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame, block=16).collect()}
    want = {k: (int(close[k].sum()), group[k], group[k] == k) for k in range(len(rows))}
    want |= {k: (0, k, True) for k in range(900, 908)} | {907: (1, 907, True), 908: (1, 907, False)}
    assert got == want


def test_no_embeddings(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_tiles_meet_once(spark):
    from pyspark.sql import functions as F

    from reelmart.llm.common import spread_blocks

    members = spark.range(50).select(F.lit(1).alias("key"), F.lit(50).alias("size"), F.col("id").alias("cid"))
    tiles = collections.defaultdict(list)
    for r in spread_blocks(members, "key", "size", "cid", 8).collect():
        tiles[r._i, r._j].append((r._side, r.cid))
    met = collections.Counter()
    for (i, j), inside in tiles.items():
        for k, (side, a) in enumerate(inside):
            for other, b in inside[:k]:
                if i == j or side != other:
                    met[frozenset((a, b))] += 1
    assert len(met) == 50 * 49 // 2 and set(met.values()) == {1}


def test_bitmaps_of_widths_that_differ_by_more_than_two_are_folded_in_full(spark):
    wide = [3, 5, 0, 1, 8, 0, 0, 2]
    rows = [(9, wide, 9, ngrams.folded(np.array(wide), w).tolist()) for w in (1, 2, 4, 8)]
    frame = spark.createDataFrame(rows, "a_n long, a_bitmap array<long>, b_n long, b_bitmap array<long>")
    bounds = frame.select(ngrams.overlap_bound("a", "b"), ngrams.overlap_bound("b", "a")).collect()
    assert [tuple(r) for r in bounds] == [(9, 9)] * 4


def test_sketches_and_bitmaps_never_bound_too_low(spark):
    """The bound on the intersection holds at both widths, also between sets of different widths."""
    rng = np.random.default_rng(7)
    rows = []
    for size in (3, 60, 300, 2_000):
        for other in (size, size + size // 4, 2 * size):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 2**63, other - size // 2, dtype=np.uint64)]))
            bits = [ngrams.parity_bitmap(s) for s in (a, b)]
            for p, q in (bits, map(ngrams.sketch, bits)):
                rows.append((len(a), len(b), p.tolist(), q.tolist(), len(np.intersect1d(a, b))))
    frame = spark.createDataFrame(rows, "a_n long, b_n long, a_bitmap array<long>, b_bitmap array<long>, shared long")
    got = frame.select("shared", ngrams.overlap_bound("a", "b").alias("most")).collect()
    assert len(got) == 24 and all(r.shared <= r.most for r in got)


def test_tiles_of_the_same_members_are_compared_once(spark):
    members = [(key, cid) for key, own in ((1, (1, 2, 3)), (2, (3, 2, 1)), (3, (1, 2, 4)), (4, (1, 2)), (5, (5, 6, 7))) for cid in own]
    roots = spark.createDataFrame([(5, 5), (6, 5), (7, 5)], "node long, root long")
    got = ngrams.mixed_tiles(spark.createDataFrame(members, "key long, cid long"), roots).collect()
    assert sorted((r.key, r.cid, r["size"]) for r in got) == [(k, c, 3) for k, own in ((1, (1, 2, 3)), (3, (1, 2, 4))) for c in own]


def test_sketches_of_a_tile_of_two_thousand_move_once(spark):
    members = spark.range(2_000).selectExpr("7L AS key", "2000L AS size", "id AS cid")
    assert common.spread_blocks(members, "key", "size", "cid", ngrams.TILE_BLOCK).count() == 2_000
