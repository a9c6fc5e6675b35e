"""Operator 2, language identification: nearest centroid on TF-IDF character n-grams.

A text becomes a unit vector of hashed byte trigrams: the logarithm of the count times the
inverse document frequency over all training texts. Several centroids per language come from
spherical k-means on at most `SAMPLE_ROWS` training texts of that language (those with the smallest
hash). The language of the closest centroid by cosine wins; a text further from it than
almost all of its own members is marked as rejected.

Defined cases: a null text or one without a letter is `und` with score 0; null languages are
not learned; repeated rows count as often as they occur; without any training language
everything is `und`; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm import rows, text

DIMENSIONS = 4096
CENTROIDS = 4
ROUNDS = 10
SAMPLE_ROWS = 1_000
RANGE_BITS = 12
# A text is rejected below this share of the cosine that 99 of 100 members reach.
SLACK = 0.8
UNKNOWN = "und"

# Bytes as read: ASCII letters lowered, other ASCII a space, the accented capitals of Latin-1 lowered.
_READ = np.arange(256, dtype=np.uint8)
_READ[:128] = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)]


def counts(batch: pa.RecordBatch) -> np.ndarray:
    """Trigram counts of every whole text, one row per text."""
    data, offsets = text.buffers(batch.column("text"))
    texts = len(offsets) - 1
    out = np.zeros((texts, DIMENSIONS), dtype=np.float32)
    read = _READ[data]
    if len(data) > 1:
        raised = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        read[raised] += 32
    if len(data) < 3:
        return out
    wide = read.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    cell = ((code * np.uint32(2654435761)) >> np.uint32(32 - 12)).astype(np.int64)
    blank = (read[:-2] == 32) & (read[1:-1] == 32) | (read[1:-1] == 32) & (read[2:] == 32)
    for i in range(texts):
        a, b = offsets[i], max(offsets[i], offsets[i + 1] - 2)
        if b > a:
            out[i] = np.bincount(cell[a:b][~blank[a:b]], minlength=DIMENSIONS)
    return out


def _unit(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(tf) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Centroids:
    """Inverse document frequencies; one centroid, language and smallest usual cosine per row."""

    idf: np.ndarray
    languages: list[str]
    vectors: np.ndarray
    radius: np.ndarray


def _frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Document frequency of every hashed trigram over all of `docs`, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for whole in batches:
            for batch in text.groups(whole):
                held += (counts(batch) > 0).sum(axis=0)
                texts += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1)), pa.array(np.append(held, texts))], names=["cell", "n"])

    total = docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in total:
        out[r["cell"]] = r["n"]
    return out[:-1], int(out[-1])


def _cluster(idf: np.ndarray):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["order", "doc_id"])
        x = _unit(counts(pa.RecordBatch.from_pandas(group[["text"]], preserve_index=False)), idf)
        x = x[x.any(axis=1)]
        if not len(x):
            return pd.DataFrame({"lang": [], "vector": [], "radius": []}, dtype=object)
        centres = x[[0]]
        while len(centres) < min(CENTROIDS, len(x)):  # the text furthest from all centres so far
            centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(axis=1))]])
        for _ in range(ROUNDS):
            nearest = (x @ centres.T).argmax(axis=1)
            sums = np.stack([x[nearest == k].sum(axis=0) for k in range(len(centres))])
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
        close = x @ centres.T
        nearest = close.argmax(axis=1)
        radius = [float(np.quantile(close[nearest == k, k], 0.01)) if (nearest == k).any() else 0.0 for k in range(len(centres))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "vector": [c.astype(float).tolist() for c in centres], "radius": radius})

    return run


def _order() -> Column:
    return F.xxhash64("doc_id", "text")


def _chosen(known: DataFrame, most: int) -> DataFrame:
    """(doc_id, lang, order) of the `most` rows of each language with the smallest hash.

    Counts per range of the hash tell up to which range rows are needed, so a language with very
    many rows sends few of them to the task that numbers its rows.
    """
    keyed = known.select("doc_id", "lang", _order().alias("order")).withColumn("range", F.shiftright("order", 64 - RANGE_BITS))
    counted = keyed.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("range")) - F.col("n")
    last = counted.withColumn("before", before).filter(F.col("before") < most).groupBy("lang").agg(F.max("range").alias("last"))
    # One row per language, as many as the model holds centroids for.
    near = keyed.join(F.broadcast(last), "lang").filter(F.col("range") <= F.col("last"))
    first = Window.partitionBy("lang").orderBy("order", "doc_id")
    return near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= most).select("doc_id", "lang", "order")


def fit(docs: DataFrame, most: int = SAMPLE_ROWS) -> Centroids:
    """Learn from the rows of `docs` (doc_id, text, lang) that have a language."""
    known = docs.filter("lang is not null").select("doc_id", "text", "lang")
    frequency, texts = _frequencies(known)
    idf = np.log((1 + texts) / (1 + frequency)).astype(np.float32) + np.float32(0.1)
    # At most `most` pairs of numbers a language: a bounded broadcast.
    chosen = F.broadcast(_chosen(known, most).select("doc_id", "order").distinct())
    sample = known.withColumn("order", _order()).join(chosen, ["doc_id", "order"])
    found = sample.groupBy("lang").applyInPandas(_cluster(idf), "lang string, vector array<double>, radius double")
    held = sorted(found.collect(), key=lambda r: (r["lang"], r["vector"]))  # a few rows per language
    vectors = np.array([r["vector"] for r in held], dtype=np.float32).reshape(-1, DIMENSIONS)
    return Centroids(idf, [r["lang"] for r in held], vectors, np.array([r["radius"] for r in held]))


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """`docs` with its columns and lang_pred, score (the cosine, 0 to 1) and rejected."""

    def compute(batch: pa.RecordBatch) -> list[np.ndarray]:
        has_letter = pc.match_substring_regex(pc.fill_null(batch.column("text"), ""), r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
        if not model.languages:
            return [np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows), np.ones(batch.num_rows, dtype=bool)]
        close = _unit(counts(batch), model.idf) @ model.vectors.T
        best = close.argmax(axis=1)
        cosine = np.clip(close[np.arange(len(best)), best].astype(float), 0, 1)
        named = np.array(model.languages, dtype=object)[best]
        named[~has_letter], cosine[~has_letter] = UNKNOWN, 0.0
        return [named, cosine, ~has_letter | (cosine < SLACK * model.radius[best])]

    return rows.with_columns(docs, {"lang_pred": T.StringType(), "score": T.DoubleType(), "rejected": T.BooleanType()}, compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.drop("lang"), fit(docs.filter(rows.remainder(3) != 1)))
    return found.select("doc_id", (rows.remainder(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")
