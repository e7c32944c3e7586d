"""Ordinal quality model: one hashed linear score, ordered thresholds between the grades.

P(grade > j) = sigmoid(score - threshold_j), with thresholds in ascending order (cumulative link).
The score of a text is the mean of its words' weights, so a text's length does not move it, plus the
weights of two features of the whole text (repeated and distinct words). A word's weight is the sum
of the weights of its hashed features (word, beginnings, marks and case).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import blobs, worker_state

DIMENSIONS = 1 << 18
MAX_LABELS = 5_000
SCALE = 10.0  # texts have a few telling words among hundreds; this brings their share near one
CACHED_WORDS = 200_000
LEAST_DOCUMENTS = 3
SHORT = 30  # shares of a shorter text are taken of this many words, as a few words tell little
WHOLE = 0.1  # the share that stands for a feature of the whole text
LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")
LETTER_BYTES = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of one word as it stands in the text."""
    found = LETTERS.search(word)
    core = found.group().lower() if found else b""
    marks = zlib.crc32(word.translate(None, LETTER_BYTES)[:3], 7 + (len(word) > 1 and word.isupper()))
    names = (zlib.crc32(core, 1), zlib.crc32(core[:4], 4), zlib.crc32(core[:5], 5), zlib.crc32(core[:6], 6), marks)
    return tuple(name % DIMENSIONS for name in names)


def text_features(words: list[bytes]) -> tuple[int, int]:
    """Hashed features of a whole text: how many words repeat the one before, and how many are distinct."""
    n = len(words)
    repeated = 10 * sum(map(eq, words, words[1:])) // n
    distinct = 10 * len(set(words)) // n if n >= SHORT else 11
    return zlib.crc32(b"r%d" % repeated) % DIMENSIONS, zlib.crc32(b"d%d" % distinct) % DIMENSIONS


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text, ascending, and their shares of its words."""
    counts: dict[bytes, int] = {}
    words = text.split()
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    ids = np.array([word_features(word) for word in counts])
    shares = np.repeat(np.fromiter(counts.values(), np.float64), ids.shape[1]) / max(len(words), SHORT)
    whole = text_features(words)
    found, place = np.unique(np.r_[ids.ravel(), whole], return_inverse=True)
    return found.astype(np.int32), np.bincount(place, np.r_[shares, [WHOLE] * len(whole)]).astype(np.float32)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray  # one for each hashed feature
    thresholds: np.ndarray  # ascending, one less than there are grades

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) for every score and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, rounds: int = 150, penalty: float = 1e-5) -> OrdinalModel:
    """Maximum likelihood by Adam on all rows at once, with an L2 penalty.

    Features of fewer than `LEAST_DOCUMENTS` rows tell nothing about other texts and keep weight 0.

    With fewer than two grades among the rows the thresholds part them all the same, since absent
    grades get no probability mass beyond the start values.
    """
    lengths = np.array([len(ids) for ids, _ in rows], np.int64)
    ids = np.concatenate([ids for ids, _ in rows]) if rows else np.zeros(0, np.int32)
    values = np.concatenate([v for _, v in rows]) if rows else np.zeros(0, np.float32)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
    common = np.bincount(ids, minlength=DIMENSIONS)[ids] >= LEAST_DOCUMENTS
    used, ids = np.unique(ids[common], return_inverse=True)
    ids, values, row = ids.astype(np.int32), np.float32(SCALE) * values[common], row[common]
    weights = np.zeros(len(used))
    first, gaps = -1.0, np.zeros(n_grades - 2)  # thresholds: first, first + exp(gap), …
    parameters = np.concatenate([weights, [first], gaps])
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    n = max(len(rows), 1)
    for t in range(1, rounds + 1 if len(rows) else 1):
        weights, gaps = parameters[: len(used)], parameters[len(used) + 1 :]
        thresholds = parameters[len(used)] + np.r_[0, np.cumsum(np.exp(gaps))]
        scores = np.bincount(row, values * weights[ids], len(rows))
        tails = 1 / (1 + np.exp(np.clip(thresholds[None, :] - scores[:, None], -50, 50)))
        upper = np.c_[np.ones(len(rows)), tails]
        lower = np.c_[tails, np.zeros(len(rows))]
        pick = (np.arange(len(rows)), grades)
        mass = np.maximum((upper - lower)[pick], 1e-12)
        slope_upper, slope_lower = (upper * (1 - upper))[pick], (lower * (1 - lower))[pick]
        by_score = -(slope_upper - slope_lower) / mass / n
        by_threshold = np.zeros(n_grades + 1)
        np.add.at(by_threshold, grades, slope_upper / mass / n)
        np.add.at(by_threshold, grades + 1, -slope_lower / mass / n)
        by_threshold = by_threshold[1:n_grades]
        by_gap = np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(gaps)
        gradient = np.concatenate(
            [np.bincount(ids, values * by_score[row], len(used)) + penalty * weights, [by_threshold.sum()], by_gap]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        parameters = parameters - 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
    full = np.zeros(DIMENSIONS)
    full[used] = parameters[: len(used)]
    return OrdinalModel(full, parameters[len(used)] + np.r_[0, np.cumsum(np.exp(parameters[len(used) + 1 :]))])


def train(docs: DataFrame, graded: DataFrame, n_grades: int, max_labels: int = MAX_LABELS) -> OrdinalModel:
    """Fit on at most about `max_labels` graded documents: `graded` has (doc_id, grade).

    The sample holds the ids with the smallest hashes, so it depends on the ids alone. Only its
    bounded sparse features reach the driver. Null ids and grades are left out; of several grades of
    a document the lowest counts.
    """
    graded = graded.dropna().groupBy("doc_id").agg(F.min("grade").alias("grade"))
    total = graded.count()
    if total > max_labels:
        share = max_labels / total
        graded = graded.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = docs.select("doc_id", "text").join(F.broadcast(graded), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text) for text in blobs(batch.column("text"))]
            columns = [pa.array([c.tobytes() for c in column], pa.binary()) for column in zip(*rows)] or [pa.array([], pa.binary())] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), *columns], ["doc_id", "grade", "ids", "shares"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    table = sample.withColumn("grade", F.col("grade").cast("int")).mapInArrow(run, f"doc_id {id_type}, grade int, ids binary, shares binary")
    found = table.toPandas().sort_values(["doc_id", "ids"])
    rows = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for i, v in zip(found["ids"], found["shares"])]
    return fit(rows, found["grade"].to_numpy(np.int64), n_grades)


class _WordScores(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights.tolist()

    def __missing__(self, word: bytes) -> float:
        score = sum(map(self.weights.__getitem__, word_features(word)))
        if len(word) <= 40:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = score
        return score


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Add `expected_grade` and `tail_1`, `tail_2`, …: P(grade >= j); all columns of `docs` stay.

    Columns of these names in `docs` are replaced. A text without words, or null, has the score 0.
    """
    names = [f"tail_{j + 1}" for j in range(len(model.thresholds))]
    docs = docs.drop("expected_grade", *names)
    columns = docs.columns
    weights, thresholds = model.weights.astype(np.float32), model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = OrdinalModel(weights, thresholds), _WordScores(weights)
        worker_state("quality")  # what other operators kept is not needed now
        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, max(whole.num_rows, 1), 1000)):
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(blobs(batch.column("text"))):
                found = text.split()
                if found:
                    whole = sum(map(words.weights.__getitem__, text_features(found)))
                    scores[i] = SCALE * (sum(map(words.__getitem__, found)) / max(len(found), SHORT) + WHOLE * whole)
            tails = own.tails(scores)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(1)), *map(pa.array, tails.T.copy())], [*columns, "expected_grade", *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, ", ".join([schema, "expected_grade double", *(f"{name} double" for name in names)]))


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Grades from two flags: 0 toxic, 1 of low quality, 2 neither. A null flag leaves no grade."""
    grade = F.when(F.col("toxic") > 0, 0).otherwise(F.when(F.col("quality") > 0, 2).otherwise(1))
    return labels.dropna(subset=["doc_id", "quality", "toxic"]).select("doc_id", grade.alias("grade"))


def select(docs: DataFrame, labels: DataFrame, least_tail: float = 0.5) -> DataFrame:
    """Documents that are more likely than not of the top grade, with their grade and tails."""
    return score(docs, train(docs, grades_of_labels(labels), 3)).filter(F.col("tail_2") >= least_tail)
