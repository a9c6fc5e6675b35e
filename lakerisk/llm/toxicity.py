"""Operator 9, toxicity: a learned weighted lexicon matched by Aho-Corasick on folded text.

Folding lowers case, maps look-alike letters of other scripts and digit or sign substitutions
to plain letters, and turns the rest into spaces. A term is a beginning of a word; it matches
at the start of words and the longest match counts. Weights are log ratios of document
frequencies in toxic and clean training texts. A match inside an exception phrase (two words
seen only in clean texts) does not count. The sum of weights is normalised by length and
calibrated by a logistic curve.

The lexicon, the exceptions and the curve are fitted on at most `SAMPLE_ROWS` labelled rows
(those with the smallest hash); everything is scored. Defined cases: null and empty texts have
no match and get the score of a text of no words; null labels are ignored; repeated rows count
as often as they occur; without rows of both classes every score is the share of label 1 (0
without labels); an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm import rows, text

SAMPLE_ROWS = 20_000
TERM_LETTERS = range(4, 11)
LEAST_TOXIC_TEXTS = 4
LEAST_LOG_RATIO = 2.0
MOST_TERMS = 5_000
LEAST_CLEAN_PHRASES = 3
CUT = 0.3

# Look-alike letters and substitutions, each pair is (as written, as read).
LOOK_ALIKES = ("аеорсухіјѕԁһɡαεικνορτυχ", "aeopcyxijsdhgaeiknoptux")
SUBSTITUTES = ("013457@$!", "oieastasi")


class _Fold(dict):
    """Character table that fills itself: letters lowered, look-alikes mapped, others a space."""

    def __missing__(self, code: int) -> str:
        letter = chr(code)
        if 0xFF01 <= code <= 0xFF5E:  # full-width forms
            letter = chr(code - 0xFEE0)
        if 0x300 <= code <= 0x36F or 0x200B <= code <= 0x200D:  # combining marks, zero width
            self[code] = ""
            return ""
        low = letter.lower()
        for written, read in (LOOK_ALIKES, SUBSTITUTES):
            if low in written:
                low = read[written.index(low)]
        self[code] = low if len(low) == 1 and low.isalpha() else " "
        return self[code]


_FOLD = _Fold()


def fold(value: str | None) -> str:
    """Folded text between two spaces; substitutes at the end of a word are dropped."""
    plain = re.sub(r"[$!@\d]+(?=[\s.,;:?*#%&|)]|$)", " ", value or "")
    return f" {' '.join(plain.translate(_FOLD).split())} "


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, exception phrases and the curve; a constant when there is no curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    constant: float = 0.0

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(f" {term}", (len(term) + 1, weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(machine):
            machine.make_automaton()
        return machine


def matches(folded: str, machine: ahocorasick.Automaton) -> dict[int, float]:
    """Start -> weight of the longest term at each word start outside exception phrases."""
    found: dict[int, tuple[int, float]] = {}
    excepted: list[tuple[int, int]] = []
    for end, (size, weight) in machine.iter(folded) if len(machine) else ():
        start = end - size + 1
        if weight is None:
            excepted.append((start, end))
        else:
            found[start] = (size, weight)  # longer terms at the same start end later
    covered = {s for a, b in excepted for s in range(a, b)}
    return {s: m[1] for s, m in found.items() if s not in covered}


def _features(value: str | None, machine: ahocorasick.Automaton) -> tuple[float, float, float]:
    folded = fold(value)
    words, weight = max(folded.count(" ") - 1, 0), sum(matches(folded, machine).values())
    return weight / np.sqrt(words + 10), 100 * weight / (words + 20), np.log1p(weight)


def _terms(folded: str) -> set[str]:
    return {w[:n] for w in set(folded.split()) for n in TERM_LETTERS if len(w) >= n}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for value, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            (toxic if label else clean).update(_terms(fold(value)))
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), "toxic": pa.array([toxic[n] for n in names], pa.int64()), "clean": pa.array([clean[n] for n in names], pa.int64())})


def _choose_terms(counted: list, toxic_texts: int, clean_texts: int) -> dict[str, float]:
    """Weights of the terms that mark toxic texts; an extension must beat its beginning."""
    weights: dict[str, float] = {}
    for term, toxic, clean in sorted(counted, key=lambda r: (len(r[0]), r[0])):
        weight = float(np.log((toxic + 0.5) / (toxic_texts + 1)) - np.log((clean + 0.5) / (clean_texts + 1)))
        shorter = max((weights[term[:n]] for n in TERM_LETTERS if n < len(term) and term[:n] in weights), default=None)
        if weight >= LEAST_LOG_RATIO and (shorter is None or weight > shorter + 1.0):
            weights[term] = weight
    return weights


def _phrases(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for value, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                folded, seen = fold(value), set()
                for start in matches(folded, machine):
                    after = folded[start + 1 :].split(" ", 2)
                    before = folded[max(0, start - 40) : start].split()
                    seen |= {f"{after[0]} {after[1]}"} if len(after) > 1 and after[1] else set()
                    seen |= {f"{before[-1]} {after[0]}"} if before else set()
                (toxic if label else clean).update(seen)
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), "toxic": pa.array([toxic[n] for n in names], pa.int64()), "clean": pa.array([clean[n] for n in names], pa.int64())})

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    wide = np.column_stack([x, np.ones(len(x))])
    weights, penalty = np.zeros(wide.shape[1]), ridge * np.eye(wide.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(wide @ weights, -30, 30)))
        step = np.linalg.solve((wide * (p * (1 - p))[:, None]).T @ wide + penalty, wide.T @ (y - p) - penalty @ weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Lexicon:
    """Learn from `docs` (doc_id, text) and `labels` (doc_id, label), at most `most` labelled ids."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most `most` rows of two numbers: a bounded broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label").repartition(24)
    sample = sample.persist()
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        sample.unpersist()
        return Lexicon(constant=1.0 if toxic else 0.0)
    kind = "term string, toxic long, clean long"
    totals = lambda part: part.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    terms = totals(sample.mapInArrow(_count, kind)).filter((F.col("toxic") >= LEAST_TOXIC_TEXTS) & (ratio >= float(np.exp(LEAST_LOG_RATIO))))
    strongest = terms.orderBy(F.desc(F.col("toxic") * F.log(ratio)), "term").limit(MOST_TERMS).collect()
    lexicon = Lexicon(_choose_terms(strongest, toxic, clean))
    phrases = totals(sample.mapInArrow(_phrases(lexicon), kind)).filter((F.col("toxic") == 0) & (F.col("clean") >= LEAST_CLEAN_PHRASES))
    exceptions = frozenset(r["term"] for r in phrases.orderBy(F.desc("clean"), "term").limit(MOST_TERMS).collect())
    lexicon = Lexicon(lexicon.weights, exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            values = np.array([_features(t, machine) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(list(values)), batch.column("label")], names=["x", "y"])

    measured = sample.mapInArrow(measure, "x array<double>, y int").toPandas()  # at most `most` rows
    sample.unpersist()
    x, y = np.stack(measured["x"].to_numpy()), measured["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # so that the sum does not depend on the order of rows
    x, y = x[order], y[order]
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Lexicon(lexicon.weights, exceptions, (centre, spread, _logistic((x - centre) / spread, y)))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """`docs` with its columns and `score`, the probability of label 1."""
    held: list[ahocorasick.Automaton] = []

    def compute(batch: pa.RecordBatch) -> list[np.ndarray]:
        if lexicon.curve is None:
            return [np.full(batch.num_rows, lexicon.constant)]
        if not held:
            held.append(lexicon.automaton())
        centre, spread, weights = lexicon.curve
        x = (np.array([_features(t, held[0]) for t in batch.column("text").to_pylist()]).reshape(-1, 3) - centre) / spread
        return [1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -500, 500)))]

    return rows.with_columns(docs, {"score": T.DoubleType()}, compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: toxicity score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = rows.labelled(spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic").filter(rows.remainder(4) != 2)
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (rows.remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
