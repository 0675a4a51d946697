"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class gets a mean and a covariance, shrunk towards the pooled covariance and that towards
its diagonal. A document's score is the logistic of the difference of the two classes'
log densities, each from a Mahalanobis distance by the cached Cholesky factor of its class.
Means and covariances come from sums of the statistics and of their products, which Spark
aggregates; the driver sees only these sums, whose size depends on the number of statistics.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import lean, record, text_blocks, unpack, whole_text

#: Rows with labels that a fit uses, about (a sample by hash of the id); 16 bytes each are broadcast.
MAX_LABELS = 100_000
#: Shrinkage of a class's covariance to the pooled one, and of the pooled one to its diagonal.
TO_POOLED, TO_DIAGONAL = 0.2, 0.1
THRESHOLD = 0.3
#: The share of learning rows that a class is taken to have at least.
LEAST_PRIOR = 0.05

STATISTICS = ("log_words", "log_letters_per_word", "log_types_per_word", "odds_upper", "odds_digits", "odds_signs",
              "odds_bars", "odds_marked_words", "odds_repeated_words", "odds_repeated_triples", "odds_repeated_lines",
              "relative_entropy")

_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGITS = np.arange(48, 58)
#: ASCII signs other than the full stop, comma, apostrophe, hyphen, colon, semicolon, quotes and brackets.
_SIGNS = np.array([b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-:;\"()"])
_ENDS = bytes(_SIGNS.tolist())
#: Bytes of a text whose words are read at a time.
BLOCK_BYTES = 1_000_000
_WORD_REST, _LINE_REST = re.compile(rb"\S*"), re.compile(rb"[^\n]*")
_MIX = np.array([0x2545F4914F6CDD1D, 0x5851F42D4C957F2D], np.int64)


def _odds(part: float, whole: float, usual: float, weight: float = 20) -> float:
    """Log odds of a share, drawn to a ``usual`` share by ``weight`` counts: short texts prove little."""
    return math.log((part + weight * usual) / (max(whole - part, 0) + weight * (1 - usual)))


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text (all finite, empty texts included).

    Words and lines are read a block at a time and told apart by 64-bit hashes, so a long text takes
    some 8 bytes per word and line besides itself.
    """
    raw = text.encode()
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(len(raw), 1)
    words, marked = [np.zeros(0, np.int64)], 0
    for a, b in text_blocks(raw, BLOCK_BYTES, _WORD_REST):
        part = raw[a:b].split()
        words.append(np.fromiter(map(hash, part), np.int64, len(part)))
        marked += sum(w[-1] in _ENDS for w in part)
    words = np.concatenate(words)
    lines = [np.zeros(0, np.int64)]
    for a, b in text_blocks(raw, BLOCK_BYTES, _LINE_REST):
        part = [line for line in raw[a:b].split(b"\n") if line]
        lines.append(np.fromiter(map(hash, part), np.int64, len(part)))
    lines = np.concatenate(lines)
    total = len(words)
    letters = int(n[_UPPER].sum() + n[_LOWER].sum() + n[0xC0:].sum())  # a lead byte is a letter beyond ASCII
    triples = (words[:-2] * _MIX[0] + words[1:-1]) * _MIX[1] + words[2:]
    repeats = int((words[1:] == words[:-1]).sum())
    share = n[n > 0] / size
    even = math.log(min(size, 30) + 1)  # the entropy that so short a text can have
    return [math.log1p(total), math.log1p((letters + 80) / (total + 20)), math.log((_distinct(words) + 20) / (total + 20)),
            _odds(int(n[_UPPER].sum()), letters, 0.03, 60), _odds(int(n[_DIGITS].sum()), size, 0.01),
            _odds(int(n[_SIGNS].sum()), size, 0.01), _odds(int(n[124]), size, 0.002), _odds(marked, total, 0.02),
            _odds(repeats, total, 0.03), _odds(max(total - 2, 0) - _distinct(triples), total, 0.03),
            _odds(len(lines) - _distinct(lines), len(lines), 0.05), float(-(share * np.log(share)).sum()) / even]


def _distinct(hashes: np.ndarray) -> int:
    hashes = np.sort(hashes)
    return int(len(hashes) > 0) + int((hashes[1:] != hashes[:-1]).sum())


def _rows_of(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(record(docs), whole_text(text_col).alias("text"))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``rec`` (all columns) and ``x``, the statistics; one pass, no shuffle."""
    columns = _rows_of(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            x = [statistics(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["rec", "x"])

    schema = columns.select("rec", F.array(F.lit(0.0)).alias("x")).schema
    return columns.mapInArrow(run, schema)


@dataclass
class ClassDensity:
    log_prior: float
    mean: np.ndarray
    factor: np.ndarray  # inverse of the Cholesky factor of the covariance
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.factor.T
        return self.log_prior - 0.5 * (self.log_det + (z * z).sum(1))


@dataclass
class Discriminant:
    """Two class densities on standardised statistics; without both classes every score is ``prior``."""

    shift: np.ndarray
    scale: np.ndarray
    classes: dict[int, ClassDensity]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(self.classes) < 2:
            return np.full(len(x), self.prior)
        # statistics far outside of what was learnt say no more than those at five deviations
        z = np.clip((x - self.shift) / self.scale, -5, 5)
        d = self.classes[1].log_density(z) - self.classes[0].log_density(z)
        return 1 / (1 + np.exp(-np.clip(d, -500, 500)))


def fit(sums: dict[int, tuple[int, np.ndarray, np.ndarray]], to_pooled: float = TO_POOLED,
        to_diagonal: float = TO_DIAGONAL) -> Discriminant:
    """From {class: (rows, sums, sums of products)} of the statistics."""
    k = len(STATISTICS)
    total = sum(n for n, _, _ in sums.values())
    if not total:
        return Discriminant(np.zeros(k), np.ones(k), {}, 0.5)
    shift = sum(s for _, s, _ in sums.values()) / total
    scale = np.sqrt(np.maximum(np.diag(sum(p for _, _, p in sums.values())) / total - shift**2, 0))
    scale[scale < 1e-9] = 1
    prior = sums[1][0] / total if 1 in sums else 0.0
    means, within = {}, {}
    for c, (n, s, p) in sums.items():
        m = s / n
        means[c] = (m - shift) / scale
        within[c] = (p - n * np.outer(m, m)) / np.outer(scale, scale)
    pooled = sum(within.values()) / total
    pooled = (1 - to_diagonal) * pooled + to_diagonal * np.diag(np.diag(pooled)) + 1e-3 * np.eye(k)
    classes = {}
    for c, (n, _, _) in sums.items():
        own = (1 - to_pooled) * within[c] / n + to_pooled * pooled + 1e-3 * np.eye(k)
        low = np.linalg.cholesky(own)
        share = min(max(n / total, LEAST_PRIOR), 1 - LEAST_PRIOR)
        classes[c] = ClassDensity(math.log(share), means[c], np.linalg.inv(low), 2 * np.log(np.diag(low)).sum())
    return Discriminant(shift, scale, classes, prior)


def learn(docs: DataFrame, labels: DataFrame, learning: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", max_labels: int = MAX_LABELS) -> Discriminant:
    """Fit on the documents that have a label 0 or 1 and for which ``learning`` (of the id) holds.

    Labels and documents with null ids are not learnt from; a repeated label row counts again.
    Beyond ``max_labels`` pairs of id and label a sample of about that many by hash of the id is used.
    """
    given = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    given = given.where("doc_id is not null and label in (0, 1)")
    given = given if learning is None else given.where(learning)
    # a row per id and label, however often it is repeated
    given = given.groupBy("doc_id", "label").agg(F.count(F.lit(1)).cast("double").alias("times"))
    number = given.count()
    if number > max_labels:
        share = int(2**32 * max_labels / number)
        given = given.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("labels")), 32) < share)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # at most about max_labels rows of 20 bytes: proven small enough to broadcast
    x = with_statistics(rows.join(F.broadcast(given), "doc_id"))
    k = len(STATISTICS)
    at = lambda i: F.col("x")[i]
    times = F.col("rec.times")
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    got = x.groupBy(F.col("rec.label").alias("label")).agg(
        F.sum(times), *[F.sum(times * at(i)) for i in range(k)], *[F.sum(times * at(i) * at(j)) for i, j in upper])
    sums = {}
    for label, n, *values in got.collect():  # two rows
        p = np.zeros((k, k))
        for (i, j), v in zip(upper, values[k:]):
            p[i, j] = p[j, i] = v
        sums[label] = (n, np.array(values[:k]), p)
    return fit(sums)


def with_score(docs: DataFrame, model: Discriminant, text_col: str = "text") -> DataFrame:
    """``rec`` (all columns) and ``score`` of every document, null and empty texts included."""
    columns = _rows_of(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            x = np.array([statistics(t.as_py()) for t in b.column(1)], float).reshape(b.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], ["rec", "score"])

    return columns.mapInArrow(run, columns.select("rec", F.lit(0.0).cast("double").alias("score")).schema)


def learning_rows(id_col: str = "doc_id", folds: int = 5, held: int = 0) -> Column:
    """Whether an id is learnt from: crc32 of the id as text, modulo ``folds``, is not ``held``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != held


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if >= ``threshold``).

    Only statistics of the text enter a score. Null texts count as empty and get a score as
    well; a null id is not held out; repeated rows get equal scores; an empty table gives no
    rows. Without labels of both classes the score is the share of label 1 (0.5 without any).
    """
    model = learn(docs, labels, learning_rows(), id_col, text_col)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = with_score(slim, model).select(F.col("rec.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", F.coalesce(~learning_rows(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns (see ``score_quality``).

    Null and empty texts are judged as empty texts; repeated rows stay or go together; columns may
    have any names; an empty table gives no rows.
    """
    model = learn(docs, labels, learning_rows(), id_col, text_col)
    return unpack(with_score(docs, model, text_col).where(F.col("score") >= threshold), docs.columns)
