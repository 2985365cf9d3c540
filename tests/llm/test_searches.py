"""Prefix trie, ranked search and top matches against brute force on small fixtures."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np

from reelmart.llm import lexical, pivots, trie


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = text or ""
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256(said.encode()).digest(), said))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = collections.defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * words
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(paths[c]) == len(p)))
        above = min(members[p[:-1]]) if p else None
        out.append((min(who), len(p), above, len(who), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


CONVERSATION = "conv_id long, turn long, role string, text string"


def test_trie(spark):
    rng = random.Random(1)
    rows = []
    for c in [*range(-25, 70), 1000]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 4, 5, 9])):
            rows.append((c, rng.choice([None, t, t]), rng.choice(["user", "assistant", None]), rng.choice(["a b c", "", "x  y\tz\x0b", None])))
    rows += [(None, 0, "user", "of no conversation"), rows[0], rows[0]]
    rows += [(1000, t, "user", "again") for t in range(40)]
    rows += [(c, t, "user", "copied turn") for c in range(2000, 2300) for t in range(6)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], f"{CONVERSATION}, node string")
    assert rows_of(trie.shared_prefixes(df)) == trie_by_hand(rows)


def test_trie_where_openings_take_all_turns(spark):
    rows = [(c, 0, "user", "only turn") for c in range(21, 60)]
    assert rows_of(trie.shared_prefixes(spark.createDataFrame(rows, CONVERSATION))) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    assert trie.shared_prefixes(spark.createDataFrame([], CONVERSATION)).count() == 0


def test_lists_of_ids_are_hashed_in_pieces(spark, monkeypatch):
    ids = list(range(5000))
    places = spark.createDataFrame([(b"n", i, 1, 1) for i in ids] + [(b"m", 7, 2, 2), (b"m", 8, 2, 3)], "node binary, conv_id long, depth long, n_turns long")
    monkeypatch.setattr(trie, "CHUNK", 1000)
    want = {b"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m": hashlib.sha256(b"7").hexdigest()}
    assert {bytes(r.node): r.ends_sha256 for r in trie.end_digests(places).collect()} == want


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def small_letters(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def ranked_by_hand(docs, items, k):
    counted = [(d, collections.Counter(TERM.findall(small_letters(x)))) for d, x in docs]
    n_docs, n_terms = sum(1 for _, c in counted if c), sum(c.total() for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(TERM.findall(small_letters(text)))}
        scores = []
        for d, c in counted:
            m = 10 + 90 * c.total() * n_docs // n_terms if n_terms else 0
            s = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if s:
                scores.append((-s, d is None, d or 0))
        out += [(item, rank + 1, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def documents_and_items(rng):
    words = [f"w{n}" for n in range(300)] + ["Ünïcode", "ÄB", "x" * 60, "日本語", "MiXed"]
    odds = [1 / (n + 1) for n in range(len(words))]
    docs = [(n, rng.choice([" ", "-", "\n"]).join(rng.choices(words, odds, k=rng.choice([1, 5, 40, 300])))) for n in range(150)]
    docs += [(150, None), (151, ""), (152, " .,; "), (None, docs[0][1]), (None, "w250 w251"), (3, "w260 w261 w261"), (3, docs[5][1])]
    docs += [(n, docs[7][1]) for n in range(160, 200)] + [(200, "w1 " * 20_000 + "w299"), (201, " ".join(f"u{n}" for n in range(9_000)))]
    items = [(n, " ".join(rng.choices(words, k=12))) for n in range(25)]
    items += [(25, None), (26, ""), (27, "unheard of"), (3, "w250 W251 w251"), (None, "w260"), (30, docs[7][1]), (31, " ".join(words))]
    return docs, items


def test_ranked_search(spark):
    docs, items = documents_and_items(random.Random(2))
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item long").repartition(3)
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    index = lexical.indexed(d)
    assert rows_of(lexical.ranked(d, index, i)) == ranked_by_hand(docs, items, 10)
    assert rows_of(lexical.ranked(d, index, i, k=3)) == ranked_by_hand(docs, items, 3)


def test_ranked_search_of_items_in_blocks(spark, monkeypatch):
    docs, items = documents_and_items(random.Random(3))
    d, i = spark.createDataFrame(docs[:80], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "ITEM_TERMS", 200)
    assert rows_of(lexical.ranked(d, lexical.indexed(d), i)) == ranked_by_hand(docs[:80], items, 10)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked(docs, lexical.indexed(docs), items).count() == 0
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert lexical.ranked(some, lexical.indexed(some), items.limit(0)).count() == 0


def test_bounds_are_never_below_scores():
    rng = random.Random(4)
    docs, items = documents_and_items(rng)
    counted = [collections.Counter(lexical.terms_of(x)) for _, x in docs]
    corpus = lexical.Corpus(sum(1 for c in counted if c), sum(c.total() for c in counted))
    rows = [{"item": n, "term": t, "weight": rng.randrange(1, 9000)} for n, (_, x) in enumerate(items) for t in dict.fromkeys(lexical.terms_of(x))]
    queries = lexical.Queries.of(rows)
    batch = lexical.pa.record_batch([lexical.pa.array([d for d, _ in docs], lexical.pa.int64()), lexical.pa.array([x for _, x in docs])], ["doc_id", "text"])
    near = total = 0
    for block in lexical.signature_rows(iter([batch])):
        for width, ids, sizes, slices in zip(*(block.column(c).to_pylist() for c in ("width", "doc_ids", "sizes", "slices"))):
            if width is None:
                continue
            bounds = lexical.upper_bounds(queries, queries.hashes(), corpus, width, np.array(sizes), slices)
            for column, (doc_id, size) in enumerate(zip(ids, sizes)):
                same = [c for (d, _), c in zip(docs, counted) if d == doc_id and c.total() == size]
                for row, (numbers, weights) in enumerate(queries.parts):
                    m = corpus.norm(size)
                    least = min(sum(int(w) * (10**9 * c[queries.terms[n]] // (1000 * c[queries.terms[n]] + 8 * m)) for n, w in zip(numbers, weights)) for c in same)
                    assert bounds[row, column] >= least
                    total += 1
                    near += bounds[row, column] <= 1.3 * least + 1
    assert near > 0.8 * total


def cut(x):
    return max(-(2**63), min(2**63 - 1, x))


def matches_by_hand(rows, k, every):
    fit = []
    for r, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.append((r, i, [cut(math.floor(64 * float(x))) for x in v]))
    out = []
    for r, i, q in fit:
        if i is not None and i % every == 0:
            found = sorted((-cut(sum(a * b for a, b in zip(q, v))), j is None, j or 0) for o, j, v in fit if o != r)
            out += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


def test_top_matches(spark):
    rng = random.Random(5)

    def vector(n=8):
        return [rng.gauss(0, 1) for _ in range(n)]

    common = [vector() for _ in range(20)]
    rows = [(i, vector()) for i in range(200)] + [(i, rng.choice(common)) for i in range(200, 500)] + [(i, common[0]) for i in range(500, 800)]
    rows += [(40, vector()), (40, common[0]), (60, common[0]), (60, common[0]), (None, common[0]), (None, vector())]
    rows += [(1000, None), (1020, [1.0, None]), (1040, [math.nan] * 8), (1060, []), (1080, [1.0]), (1100, vector(20)), (1120, [0.0] * 8)]
    rows += [(1140, [1e17] * 8), (1160, [-1e30] + [1e12] * 7), (1161, [3e17] * 8), (1180, [math.inf] * 8)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, cid int, cell string")
    got = pivots.top_matches(df, pivots=6, tile=64, batch=8)
    assert rows_of(got) == matches_by_hand(rows, 20, 20)


def test_top_matches_with_fewer_rows_than_asked(spark):
    rows = [(20 * n, [1.0 * n]) for n in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert rows_of(pivots.top_matches(df)) == matches_by_hand(rows, 20, 20)
    assert pivots.top_matches(df.filter("vec_id = 20")).count() == 0
    assert pivots.top_matches(df.limit(0)).count() == 0


def test_bounds_hold_and_stop_the_search():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(5, 16)) * 40
    x = np.floor(centres[rng.integers(0, 5, 500)] + rng.normal(size=(500, 16)) * 3)
    pivot = x[:12]
    to = np.sqrt(((x[:, None] - pivot[None]) ** 2).sum(2)).astype(np.float32).astype(float)
    norm = (x * x).sum(1)
    gap = np.abs(to[:, None] - to[None]).max(2)
    bounds = pivots.score_bounds(norm[:, None], norm[None], np.maximum(gap - 2 * pivots.SLACK * to.max(), 0))
    scores = x @ x.T
    assert (bounds >= scores).all()
    kth = np.sort(scores, axis=1)[:, -20]
    assert ((bounds >= kth[:, None]).sum() / bounds.size) < 0.5


def test_least_gaps_never_exceed_distances_and_ignore_those_beyond_floats():
    """In single precision with its rounding; a distance that overflowed says nothing, also beside one that did not."""
    rng = np.random.default_rng(5)
    x, q, to = (rng.normal(0, s, (n, 16)) for s, n in ((40, 300), (40, 50), (40, 8)))
    x[:9] = q[:9] * (1 + 1e-9)
    one, two = (np.sqrt(((v[:, None] - to[None]) ** 2).sum(2)).astype(np.float32) for v in (q, x))
    one[20, 3], two[30, 4], two[31], one[21, 5], two[32, 5] = np.inf, np.nan, np.inf, np.inf, np.inf
    gap = pivots.least_gaps(*(pivots.shrunk_and_grown(np.ascontiguousarray(d.T)) for d in (one, two)))
    real = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    assert np.isfinite(gap).all() and (gap <= real).all() and (gap[:, 31] == 0).all()
    pairs = np.abs(one[:20, None].astype(float) - two[None, :30]).max(2)
    assert (gap[:20, :30] >= pairs * (1 - 1e-4) - 1e-2).all()


def test_a_tile_gives_the_best_of_all_its_vectors(spark):
    """Queries without a known score look at the whole tile, in products of some rows first, then of all; many ties."""
    rng = np.random.default_rng(6)
    vectors = rng.integers(-2, 3, (1500, 6)) / 64
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(pivots.top_matches(df, pivots=4, tile=4096)) == matches_by_hand(rows, 20, 20)
