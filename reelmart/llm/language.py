"""Language identification: nearest centroid of TF-IDF byte n-grams, several centroids per language.

Texts become hashed counts of byte trigrams over their letters. Document frequencies cover
all learning rows; centroids come from a bounded sample by spherical k-means per language.
A text gets the language of the most similar centroid, and is rejected when its distance
leaves less than half the similarity of the farthest text the language was learnt from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.session import cut_lineage, small_side

BUCKETS = 4096
CHUNK = 1 << 20  # code points of a text turned into bytes at a time
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def letters_only() -> bytes:
    """A byte map that blanks ASCII signs and digits; bytes of other letters stay."""
    keep = {*range(65, 91), *range(97, 123), *range(128, 256)}
    return bytes(b if b in keep else 32 for b in range(256))


def gram_counts(text: str, blanks: bytes) -> np.ndarray:
    """Counts of the byte trigrams of the lower-cased letters of a whole text, by hash bucket."""
    counts, tail = np.zeros(BUCKETS, np.int64), b" "
    for at in range(0, len(text), CHUNK):
        data = tail + text[at : at + CHUNK].lower().encode("utf-8", "replace").translate(blanks)
        if at + CHUNK >= len(text):
            data += b" "
        raw = np.frombuffer(data, np.uint8).astype(np.uint32)
        code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        code = code[(raw[1:-1] != 32)]
        counts += np.bincount((code * np.uint32(2_654_435_761)) >> np.uint32(20), minlength=BUCKETS)
        tail = data[-2:]
    return counts


@dataclass
class Languages:
    """Centroids (rows of unit length), the language of each, and how far its own texts lay."""

    names: list[str]
    of: np.ndarray
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        weighted = np.log1p(counts).astype(np.float32) * self.idf
        norm = float(np.sqrt(weighted @ weighted))
        return weighted / norm if norm else weighted

    def predict(self, text: str | None, blanks: bytes) -> tuple[str, float, bool]:
        """Language, cosine in 0..1, rejected. A text without a letter is ``und``, score 0, rejected."""
        if not text or not self.names or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        cosine = self.centroids @ self.vector(gram_counts(text, blanks))
        best = int(cosine.argmax())
        score = float(min(1.0, max(0.0, cosine[best])))
        return self.names[self.of[best]], score, bool(1.0 - score > self.radius[best])


def in_fold(doc_id: Column) -> Column:
    """Rows held out of learning: crc32 of the id as text, modulo 4, is 2. A NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_fold(F.col("doc_id")))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of ``rows`` each bucket occurs, and the number of rows: ``BUCKETS`` + 1 sums over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blanks, seen, count = letters_only(), np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                seen[:-1] += gram_counts(text.as_py(), blanks) > 0
                count += 1
        seen[-1] = count
        hit = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(hit), pa.array(seen[hit])], ["bucket", "n"])

    sums = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(BUCKETS + 1, np.int64)
    for row in sums:
        seen[row["bucket"]] = row["n"]
    return seen[:-1], int(seen[-1])


def sample_counts(rows: DataFrame, per_language: int) -> DataFrame:
    """``lang, counts`` of at most ``per_language`` texts of each language; copies under one id count once."""
    place = F.xxhash64("doc_id", "text")
    places = cut_lineage(rows.select("lang", place.alias("place")).distinct(), "places")
    sizes = places.groupBy("lang").agg(F.count("*").alias("size"))
    # A hash threshold leaves about twice as many of each language, so that no language is gathered to be ranked.
    near = places.join(small_side(sizes), "lang").filter(F.pmod("place", F.lit(1 << 30)) < (2 * per_language << 30) / F.col("size"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    chosen = near.select("lang", "place").withColumn("rank", rank).filter(F.col("rank") <= per_language).drop("rank")
    drawn = rows.withColumn("place", place).join(small_side(cut_lineage(chosen, "chosen")), ["lang", "place"])
    texts = drawn.groupBy("lang", "place").agg(F.min("text").alias("text")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blanks = letters_only()
        for batch in batches:
            counts = [gram_counts(t.as_py(), blanks).clip(0, 65_535).astype("<u2").tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.binary())], ["lang", "counts"])

    return texts.mapInArrow(run, "lang string, counts binary")


def clustered(vectors: np.ndarray, clusters: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids and each vector's centroid. Starts from spread-out members."""
    centroids = vectors[:1]
    while len(centroids) < min(clusters, len(vectors)):
        nearest = (vectors @ centroids.T).max(1)
        centroids = np.vstack([centroids, vectors[nearest.argmin()]])
    member = np.zeros(len(vectors), int)
    for _ in range(rounds):
        member = (vectors @ centroids.T).argmax(1)
        for k in range(len(centroids)):
            if (member == k).any():
                mean = vectors[member == k].sum(0)
                centroids[k] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centroids, (vectors @ centroids.T).argmax(1)


def fitted_languages(docs: DataFrame, clusters: int = 4, per_language: int = 400) -> Languages:
    """The model of all languages of the learning rows of ``docs``; the texts for the centroids are bounded per language."""
    rows = learning_rows(docs)
    seen, count = document_frequencies(rows)
    idf = np.log((1.0 + count) / (1.0 + seen)).astype(np.float32) + 1.0
    model = Languages([], np.zeros(0, int), np.zeros((0, BUCKETS), np.float32), np.zeros(0), idf)

    def fit(key: tuple[pa.Scalar, ...], texts: pa.Table) -> pa.Table:
        vectors = [model.vector(np.frombuffer(c, "<u2")) for c in sorted(texts.column("counts").to_pylist())]
        stacked = np.array([v for v in vectors if v.any()], np.float32).reshape(-1, BUCKETS)
        middle, far = stacked, 0.0
        if len(stacked):
            middle, member = clustered(stacked, clusters)
            far = float((1.0 - (stacked * middle[member]).sum(1)).max())
        kept = pa.array([m.astype("<f4").tobytes() for m in middle], pa.binary())
        # Short texts lie far from any centroid; half the least similarity of the language's own texts is the limit.
        radius = pa.array([1.0 - (1.0 - far) / 2] * len(middle), pa.float64())
        return pa.table([pa.array([key[0].as_py()] * len(middle), pa.string()), pa.array(range(len(middle)), pa.int64()), kept, radius], ["lang", "k", "centroid", "radius"])

    groups = sample_counts(rows, per_language).groupBy("lang")
    found = sorted(groups.applyInArrow(fit, "lang string, k long, centroid binary, radius double").collect(), key=lambda r: (r["lang"], r["k"]))
    model.names = sorted({r["lang"] for r in found})
    number = {name: k for k, name in enumerate(model.names)}
    model.of, model.radius = np.array([number[r["lang"]] for r in found], int), np.array([r["radius"] for r in found])
    model.centroids = np.array([np.frombuffer(r["centroid"], "<f4") for r in found], np.float32).reshape(len(found), BUCKETS)
    return model


def foreign_text(model: Languages) -> Callable[[str], Column]:
    """The rejection of ``identified`` on a text column; no other column goes to Python."""

    @F.arrow_udf("boolean")
    def rejected(texts: pa.Array) -> pa.Array:
        blanks = letters_only()
        return pa.array([model.predict(t.as_py(), blanks)[2] for t in texts], pa.bool_())

    return rejected


def identified(docs: DataFrame, model: Languages) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row, from its whole text alone.

    NULL text, empty text and text without a letter give ``und``, score 0, rejected. With no
    learning rows every text does. Equal similarities go to the first language by name. Other
    columns are not read.
    """
    source = docs.select("doc_id", "text")
    kind = dict(source.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blanks = letters_only()
        for batch in batches:
            found = [model.predict(t.as_py(), blanks) for t in batch.column(1)]
            name, score, rejected = zip(*found) if found else ((), (), ())
            made = [pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.record_batch([batch.column(0), *made], ["doc_id", "lang_pred", "score", "rejected"])

    out = source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
