"""Quality rules: exact counts, and a chain of line labels whose content share decides.

Each line with a word gets features of its own and of its neighbours; a linear-chain
conditional random field marks it content or boilerplate, and a document is kept if
enough of its words stand in content lines. Lines have no labels of their own, so the
field learns from lines of labelled documents, each with its document's label.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm import crf

WINDOW = 8  # words of a repeated passage
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
SYMBOLS = b"#*$%&|<>"
BLANKS = b"\t\n\x0b\x0c\r "
CLASS_NAMES = ("blank", "symbol", "continuation", "lower", "upper", "digit", "stop", "shout")


def byte_classes() -> np.ndarray:
    """A row of flags for each byte value, in the order of ``CLASS_NAMES``."""
    sets = [BLANKS, SYMBOLS, range(0x80, 0xC0), range(97, 123), range(65, 91), range(48, 58), b".,;:", b"!?"]
    flags = np.zeros((256, len(sets)), np.int64)
    for k, members in enumerate(sets):
        flags[list(members), k] = 1
    return flags


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more, the first included.

    Windows get exact numbers by doubling: pairs of numbered pieces are numbered in turn.
    """
    count = len(words) - window + 1
    if count < 2:
        return 0
    ids: dict[bytes, int] = {}
    piece = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    step = 1
    while step < window:
        both = piece[:-step] * len(words) + piece[step:]
        piece = np.unique(both, return_inverse=True)[1]
        step *= 2
    twice = np.bincount(piece)[piece] > 1
    if not twice.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def line_features(lines: list[bytes], words: list[list[bytes]], flags: np.ndarray) -> np.ndarray:
    """One row of features per line; ``lines`` all have a word."""
    seen: Counter[bytes] = Counter()
    rows = []
    for line, own in zip(lines, words):
        counts = flags[np.frombuffer(line, np.uint8)].sum(0)
        blank, symbol, continuation, lower, upper, digit, stop, shout = counts.tolist()
        letters = max(1, len(line) - blank - continuation)
        kinds = Counter(own)
        n = len(own)
        rows.append(
            (
                min(np.log1p(n), 6.0) / 6.0,
                min(letters / n, 20.0) / 20.0,
                10.0 * symbol / letters if symbol < letters else 10.0,
                upper / letters,
                digit / letters,
                stop / letters,
                min(1.0, 10.0 * shout / letters),
                min(1.0, symbol / n),
                min(1.0, shout / n),
                1.0 - len(kinds) / n if n >= 5 else 0.0,
                max(kinds.values()) / n if n >= 5 else 0.0,
                float(seen[line] > 0),
                float(n < 4),
            )
        )
        seen[line] += 1
    own = np.clip(np.array(rows), 0.0, 10.0)
    before, after = np.vstack([own[:1], own[:-1]]), np.vstack([own[1:], own[-1:]])
    return np.hstack([own, (before + after) / 2])


def lines_of(data: bytes) -> tuple[list[bytes], list[list[bytes]]]:
    """Lines with a word, and their words."""
    found = [(line, words) for line in data.split(b"\n") if (words := line.split())]
    return [f[0] for f in found], [f[1] for f in found]


def measures(text: str | None, flags: np.ndarray, model: crf.Chain, share: float) -> tuple:
    """The base counts of one text, the two verdicts and the content share."""
    data = (text or "").encode("utf-8", "surrogatepass")
    lines, line_words = lines_of(data)
    words = [w for ws in line_words for w in ws]
    if not words:
        return 0, 0, count_symbols(data), 0, 0, True, False, 0.0
    raw = np.frombuffer(data, np.uint8)
    n = np.bincount(raw, minlength=256) @ flags
    chars = len(data) - int(n[0]) - int(n[2])
    dup = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    good = model.decode(line_features(lines, line_words, flags))
    content = sum(len(ws) for ws, g in zip(line_words, good) if g) / len(words)
    return len(words), chars, int(n[1]), dup, repeated, failed, (not failed and content >= share), content


def count_symbols(data: bytes) -> int:
    return sum(data.count(bytes([s])) for s in SYMBOLS)


def labelled_lines(docs: DataFrame, labels: DataFrame, documents: int, lines: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences of at most ``documents`` labelled documents, ``lines`` lines each.

    Documents with labels of both kinds teach nothing; of rows that share an id the least text
    counts, so that every run draws the same.
    """
    known = labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    chosen = chosen.filter("quality = other").drop("other").orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter("text IS NOT NULL")
    texts = met.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = byte_classes()
        for batch in batches:
            out = []
            for text, quality in zip(batch.column("text"), batch.column("quality").to_pylist()):
                found = lines_of(text.as_py().encode("utf-8", "surrogatepass"))
                if found[0]:
                    features = line_features(*found, flags)[:lines]
                    out.append((features.astype("<f4").tobytes(), len(features), quality))
            columns = list(zip(*out)) or [[], [], []]
            yield pa.record_batch([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())], ["x", "n", "y"])

    rows = texts.mapInArrow(run, "x binary, n long, y int").collect()
    rows.sort(key=lambda r: (r["y"], bytes(r["x"])))
    return [(np.frombuffer(r["x"], "<f4").reshape(r["n"], -1).astype(float), np.full(r["n"], r["y"])) for r in rows]


def spliced(sequences: list[tuple[np.ndarray, np.ndarray]], together: int = 4, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Documents joined a few at a time in random order, so that changes of label are seen too."""
    order = np.random.default_rng(seed).permutation(len(sequences))
    groups = [[sequences[k] for k in order[at : at + together]] for at in range(0, len(order), together)]
    return [(np.vstack([x for x, _ in g]), np.concatenate([y for _, y in g])) for g in groups]


def fitted_lines(docs: DataFrame, labels: DataFrame, documents: int = 2_000, lines: int = 40) -> crf.Chain:
    """The line model, fitted on a bounded sample: ``documents`` labelled documents, ``lines`` lines of each.

    Without labels of both kinds every line counts as content, so only the base rules decide.
    """
    sequences = labelled_lines(docs, labels, documents, lines)
    if len({int(y[0]) for _, y in sequences}) < 2:
        width = line_features([b"a"], [[b"a"]], byte_classes()).shape[1]
        return crf.Chain(np.zeros(width), 1.0, np.zeros((2, 2)))
    return crf.fit(spliced(sequences))


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)


def good_text(model: crf.Chain, share: float = 0.5) -> Callable[[str], Column]:
    """The verdict of ``judged_documents`` on a text column; no other column goes to Python."""

    @F.arrow_udf("boolean")
    def verdict(texts: pa.Array) -> pa.Array:
        flags = byte_classes()
        return pa.array([measures(t.as_py(), flags, model, share)[6] for t in texts], pa.bool_())

    return verdict


def judged_documents(docs: DataFrame, model: crf.Chain, share: float = 0.5) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``content_share`` of every row.

    Counts cover whole texts. NULL, empty and blank texts have no words and fail the base
    rules. Repeated rows are judged alike; an empty table gives no rows. Other columns are not read.
    """
    source = docs.select("doc_id", "text")
    names = [s.split()[0] for s in SCHEMA.split(", ")]
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, {SCHEMA}"
    types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = byte_classes()
        for batch in batches:
            found = [measures(t.as_py(), flags, model, share) for t in batch.column(1)]
            made = [pa.array(c, t) for c, t in zip(list(zip(*found)) or [[]] * len(names), types)]
            yield pa.record_batch([batch.column(0), *made], ["doc_id", *names])

    return source.mapInArrow(run, schema)
