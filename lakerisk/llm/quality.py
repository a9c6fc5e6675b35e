"""Operator 1, quality classifier: a regularised quadratic discriminant on document statistics.

Class means and covariances come from sums over all labelled training rows, added up by
Spark. Each covariance is shrunk towards the pooled one and its diagonal; the Cholesky factor
is inverted once on the driver and reused by every task. The score is the posterior from the
Mahalanobis log-density difference.

Defined cases: a null or empty text has zero shares and is scored like any other; null labels
and labels without document are ignored; repeated rows count as often as they occur; without
rows of both classes every score is the share of label 1 (0.5 without labels); an empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm import rows, text

STATISTICS = [
    "words", "word_length", "symbols", "bangs", "upper", "digits", "stops", "bars",
    "same_as_before", "distinct", "repeated_lines", "marked_words", "word_entropy",
]
SHRINK_TO_POOLED = 0.1
SHRINK_TO_DIAGONAL = 0.1
RIDGE = 1e-3
CUT = 0.3
_FLOOR = 0.01


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_SYMBOL, _BANG, _DIGIT, _STOP, _BAR = map(_flags, (b"#*$%&<>|", b"!?", b"0123456789", b".,;:", b"|"))
_UPPER = _flags(bytes(range(65, 91)))
_END = _flags(b"#*$%&<>|!?")


def statistics(batch: pa.RecordBatch) -> np.ndarray:
    """One row of transformed statistics per text, over the whole text."""
    data, offsets = text.buffers(batch.column("text"))
    hashes, starts, ends, places = text.word_hashes(data, offsets)
    texts, words = len(offsets) - 1, np.diff(places)
    per_word = np.maximum(words, 1)

    def counted(mask: np.ndarray, cuts: np.ndarray = offsets) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(total[cuts])

    lengths = counted(ends - starts, places)
    per_byte = np.maximum(lengths, 1)
    accented = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[places[:-1][words > 0]] = False
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))[: len(line_starts)]
    lines = text.span_hashes(data, line_starts, line_ends - (data[line_ends - 1] == 10))
    line_places = np.searchsorted(line_starts, offsets)
    distinct, entropy, copied = np.zeros(texts), np.zeros(texts), np.zeros(texts)
    for i in range(texts):
        if words[i]:
            _, times = np.unique(hashes[places[i] : places[i + 1]], return_counts=True)
            distinct[i] = np.log1p(len(times)) / np.log1p(words[i])
            entropy[i] = 1.0 - (times * np.log(times)).sum() / (words[i] * np.log(words[i] + 1.0))
        here = line_places[i + 1] - line_places[i]
        if here > 1:
            copied[i] = 1 - len(np.unique(lines[line_places[i] : line_places[i + 1]])) / here
    share = lambda part, whole: np.log(part / whole + _FLOOR)
    return np.column_stack([
        np.log1p(words), np.log1p(lengths / per_word), share(counted(_SYMBOL[data]), per_byte), share(counted(_BANG[data]), per_byte),
        share(counted(_UPPER[data] | accented), per_byte), share(counted(_DIGIT[data]), per_byte), share(counted(_STOP[data]), per_byte),
        share(counted(_BAR[data]), per_byte), share(counted(again, places), per_word), distinct, np.log(copied + _FLOOR),
        share(counted(_END[data[ends - 1]], places), per_word), entropy,
    ])


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log constants of both classes; None when one class is missing."""

    share: float
    parts: tuple[tuple[np.ndarray, np.ndarray, float], ...] | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.parts is None:
            return np.full(len(x), self.share)
        density = []
        for mean, inverse, constant in self.parts:
            z = (x - mean) @ inverse.T
            density.append(constant - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(docs: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from every row of `docs` (doc_id, text) that has a label (doc_id, label)."""
    size = len(STATISTICS)
    names = [f"s{i}" for i in range(size)]
    kinds = {n: T.DoubleType() for n in names}
    measured = rows.with_columns(docs.select("doc_id", "text"), kinds, lambda b: list(statistics(b).T)).drop("text")
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = measured.join(labels, "doc_id").groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(n).alias(n) for n in names],
        *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs],
    ).collect()  # two rows
    held = {r["label"]: r for r in sums}
    total = sum(r["n"] for r in sums)
    share = held[1]["n"] / total if 1 in held else 0.0 if total else 0.5
    if len(held) < 2 or min(r["n"] for r in sums) < 2:
        return Discriminant(share, None)
    means, covariances = {}, {}
    for label, r in held.items():
        mean = np.array([r[n] for n in names]) / r["n"]
        square = np.zeros((size, size))
        for i, j in pairs:
            square[i, j] = square[j, i] = r[f"p{i}_{j}"] / r["n"]
        means[label], covariances[label] = mean, square - np.outer(mean, mean)
    pooled = sum(held[k]["n"] * covariances[k] for k in held) / total
    parts = []
    for label in (0, 1):
        mixed = (1 - SHRINK_TO_POOLED) * covariances[label] + SHRINK_TO_POOLED * pooled
        mixed = (1 - SHRINK_TO_DIAGONAL) * mixed + SHRINK_TO_DIAGONAL * np.diag(np.diag(mixed)) + RIDGE * np.eye(size)
        factor = np.linalg.cholesky(mixed)
        constant = np.log(held[label]["n"] / total) - np.log(np.diag(factor)).sum()
        parts.append((means[label], np.linalg.inv(factor), constant))
    return Discriminant(share, tuple(parts))


def score(docs: DataFrame, model: Discriminant) -> DataFrame:
    """`docs` with its columns and `score`, the probability of label 1."""
    return rows.with_columns(docs, {"score": T.DoubleType()}, lambda b: [model.score(statistics(b))])


def training_model(spark: SparkSession, sf_dir: str) -> Discriminant:
    """The model of the training fold: documents whose crc32 remainder by 5 is not 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(rows.remainder(5) != 0)
    return fit(docs, rows.labelled(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, training_model(spark, sf_dir))
    return scored.select("doc_id", (rows.remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
