"""Operators without SQL, written once more as plain loops over small inputs."""

import math
from collections import Counter

import pytest
import public_tokenizers

import corpus_pipeline
from reelmart.llm import common, language, packing, quality, sharding


def permuted_by_hand(number, rows, seed):
    """One number through the network until it is inside again."""
    prime, state, keys = 2_147_483_647, seed % 2_147_483_647, []
    for _ in range(6):
        pair = []
        for _ in range(2):
            state = (state * 48_271 + 12_345) % prime
            pair.append(1 + state % (prime - 1))
        keys.append(pair)
    height = max(1, math.isqrt(rows))
    width = -(-rows // height)
    while True:
        high, low = divmod(number, width)
        for k, (times, plus) in enumerate(keys):
            if k % 2 == 0:
                high = (high + pow((low * times + plus) % prime, 3, prime)) % height
            else:
                low = (low + pow((high * times + plus) % prime, 3, prime)) % width
        number = high * width + low
        if number < rows:
            return number


@pytest.mark.parametrize("rows", [1, 2, 7, 100, 1013])
def test_feistel_walk(spark, rows):
    frame = spark.range(rows).selectExpr("id AS number", "id AS n")
    got = {r.number: r.n for r in sharding.permuted(frame, "n", rows, 20_240_601).collect()}
    assert got == {k: permuted_by_hand(k, rows, 20_240_601) for k in range(rows)}
    assert sorted(got.values()) == list(range(rows))


def test_shards_follow_the_walk(spark):
    texts = ["a", None, "é", "", "bb", "a", "a"] * 9
    docs = spark.createDataFrame([(n // 2, t) for n, t in enumerate(texts)], "doc_id long, text string")
    rows = sharding.shuffled_shards(docs, shards=8).collect()
    numbered = sorted((r.doc_id, r.size, r.text_crc32) for r in rows)
    want = Counter()
    for number, row in enumerate(numbered):
        place = permuted_by_hand(number, len(rows), 20_240_601)
        want[(*row, place % 8, place // 8)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows) == want


def test_nearest_centroid(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").limit(60).cache()
    model = language.fitted_languages(docs)
    blanks = language.letters_only()
    found = {r.doc_id: r for r in language.identified(docs, model).collect()}
    for row in docs.collect():
        letters = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in row.text.lower().encode())
        data, grams = b" " + letters + b" ", Counter()
        for k in range(len(data) - 2):
            if data[k + 1] != 32:
                code = data[k] << 16 | data[k + 1] << 8 | data[k + 2]
                grams[(code * 2_654_435_761 & 0xFFFFFFFF) >> 20] += 1
        assert dict(grams) == {k: n for k, n in enumerate(language.gram_counts(row.text, blanks)) if n}
        vector = {k: math.log1p(n) * float(model.idf[k]) for k, n in grams.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(float(c[k]) * v for k, v in vector.items()) / norm for c in model.centroids]
        best = max(cosines)
        own = found[row.doc_id]
        assert own.score == pytest.approx(min(1.0, max(0.0, best)), abs=1e-4)
        near = {model.names[model.of[k]] for k, c in enumerate(cosines) if c > best - 1e-4}
        assert own.lang_pred in near


def test_words_are_forgotten_by_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, small = packing.WordEncoder(path), packing.WordEncoder(path, limit=3_000)
    texts = [f"word{n} other{n * n} " + "x" * n for n in range(60)]
    for at in range(0, 60, 10):
        assert small.encode_all(texts[at : at + 10]) == whole.encode_all(texts[at : at + 10])
        assert small.held <= 3_000 + small.cost({w for t in texts[at : at + 10] for w in t.split()} | set("0123456789"))
    assert whole.encode_all(texts) == [whole.library(t).tobytes() for t in texts]


def test_common_words_outlast_rare_ones():
    coder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), limit=10_000)
    common = "the of and to in a"
    coder.encode_all([common])
    kept = []
    for n in range(40):
        text = f"{common} rare{'xyz'[n % 3] * (n // 3 + 1)} once{'abc'[n % 3] * (n // 3 + 1)}"
        assert coder.encode_all([text]) == [coder.library(text).tobytes()]
        kept.append(len(coder.known))
    assert any(b < a for a, b in zip(kept, kept[1:])), "the limit was met"
    assert min(kept[5:]) > len(common.split()) + 3, "and not all words went"


def test_words_of_all_latin_bytes_are_the_librarys():
    coder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    signs = [chr(c) for c in range(1, 0x250)]
    texts = ["".join(signs), " ".join(signs), " ".join(f"ab{s}cd {s}{s} don't{s}" for s in signs)]
    assert coder.encode_all(texts) == [coder.library(t).tobytes() for t in texts]


def test_a_worker_keeps_only_what_its_stage_needs():
    first = common.worker_once("first of two", list)
    assert common.worker_once("first of two", list) is first
    common.worker_once("second of two", list)
    assert common.worker_once("first of two", list) is not first


def test_labels_of_both_kinds_and_repeated_ids_do_not_decide_the_draw(spark):
    docs = [(n, f"line {n} of text\nanother line here") for n in range(20)] + [(3, "shorter text"), (None, "no id")]
    labels = [(n, n % 2) for n in range(20)] + [(5, 0), (None, 1), (7, None)]
    d, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    first, again = (quality.labelled_lines(x, known.repartition(n), 12, 5) for x, n in ((d.repartition(5), 3), (d.repartition(2), 1)))
    assert [(x.tolist(), y.tolist()) for x, y in first] == [(x.tolist(), y.tolist()) for x, y in again]


STAGES = corpus_pipeline.STAGES


@pytest.mark.parametrize("name,stage", STAGES, ids=[s[0] for s in STAGES])
def test_stages_on_odd_rows(spark, sf_dir, name, stage):
    good = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(40)
    text = good.first()["text"]
    odd = [(None, None, None, None, None), (900, None, "en", "s", 0), (901, "", None, "s", 0), (902, " \n ", "en", None, 0), (903, text, "en", "s", 5),
           (903, text, "en", "s", 5), (903, "x" * 300_000, "en", "s", 5), (None, text, "en", "s", 5)]
    rows = spark.createDataFrame(odd, good.schema)
    docs = good.unionByName(rows).selectExpr("*", "1 AS kept", "'c' AS _kept", "0 AS root", "'l' AS label")
    out = stage(spark, docs, sf_dir)
    found = out.collect()
    nothing = stage(spark, docs.limit(0), sf_dir)
    assert nothing.columns == out.columns and nothing.count() == 0
    if name == "packing":
        assert sum(r.length for r in found if r.doc_tokens == 1) == 4  # no word, but the end token
        return
    assert out.columns == docs.columns
    blank = [r for r in found if not (r.text or "").strip()]
    assert len(blank) == (0 if name in ("quality", "language") else 4)
    copies = sum(r.doc_id == 903 and r.text == text for r in found)
    assert copies in ((0,) if name == "near_duplicates" else (0, 2)), "rows alike are judged alike; of copies one stays"
