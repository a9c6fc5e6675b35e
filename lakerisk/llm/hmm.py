"""Operator 6, language model scoring: a hidden Markov model trained by Baum-Welch.

A token (A-Z lowered word, or the end of a text) is read as one of `SYMBOLS` symbols: a
frequent token is a symbol of its own, any other falls into a class by its last letters. A
state emits a symbol, and a class emits a token by its add-one share of the class's training
count. Token counts cover all training texts. Each Baum-Welch round runs over all training
texts; tasks emit expected counts that Spark sums. The start values come from a bounded sample.
The scaled forward recursion gives the exact probability of a text.

Counts of the `FREQUENT` most frequent tokens travel with the tasks (a bounded table); all other
tokens of a text are looked up by a join with the full table of counts.

Defined cases: null and empty texts are one end token; repeated rows count and are scored as
often as they occur; with no training text the model is uniform and every count is 0; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import rows, text
from lakerisk.session import stage_table

STATES = 8
OWN_SYMBOLS = 2048
CLASSES = 2048
SYMBOLS = OWN_SYMBOLS + CLASSES
ROUNDS = 3
START_TEXTS = 400
START_WORDS = 2_000
START_ROUNDS = 25
FREQUENT = 200_000
GROUP_TOKENS = 300_000
END = np.uint64(0xE4D0FDEAD5EEDE4D)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of every text with its end, their classes, and the place of each text."""
    data, offsets = text.buffers(batch.column("text"))
    data = text.lower(data)
    words, starts, ends, places = text.word_hashes(data, offsets)
    wide = data.astype(np.uint32)
    last = wide[ends - 1]
    for back in (2, 3):
        last = last | np.where(ends - starts >= back, wide[np.maximum(ends - back, 0)], 0).astype(np.uint32) << np.uint32(8 * (back - 1))
    group = ((last * np.uint32(2654435761)) >> np.uint32(32 - 11)).astype(np.int64)
    return np.insert(words, places[1:], END), np.insert(group, places[1:], 0), places + np.arange(len(places))


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, class, n): how often each token stands in `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text.groups(whole):
                found, group, _ = tokens(batch)
                names, at, n = np.unique(found, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(group[at]), pa.array(n)], names=["token", "class", "n"])

    return docs.select("text").mapInArrow(run, "token long, class long, n long").groupBy("token").agg(F.min("class").alias("class"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Totals over all training tokens, the own symbols, class totals, and the frequent tokens' counts."""

    total: int
    distinct: int
    own: np.ndarray
    own_symbol: np.ndarray
    class_total: np.ndarray
    frequent: np.ndarray
    frequent_count: np.ndarray

    @property
    def base(self) -> float:
        return float(self.total + self.distinct + 1)

    def symbols(self, found: np.ndarray, group: np.ndarray) -> np.ndarray:
        out = OWN_SYMBOLS + group
        if len(self.own):
            slot = np.minimum(np.searchsorted(self.own, found), len(self.own) - 1)
            out = np.where(self.own[slot] == found, self.own_symbol[slot], out)
        return out


def vocabulary(counted: DataFrame) -> Vocabulary:
    """Bounded parts of the stored table of counts."""
    sums = counted.agg(F.sum("n"), F.count(F.lit(1))).first()
    # The least count to send is read from a histogram of at most some thousand steps, so that no
    # task sends rows that a limit would drop again.
    step = F.floor(F.log2("n") * 64)
    lowest, sent = None, 0
    for r in sorted(counted.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        sent += r["count"]
        if sent > FREQUENT:
            break
        lowest = r["step"]
    top = counted.filter(step >= lowest) if lowest is not None else counted.limit(0)
    held = top.select("token", "class", "n").toPandas().sort_values(["n", "token"], ascending=[False, True])  # at most FREQUENT rows
    names, n = held["token"].to_numpy(np.int64).view(np.uint64), held["n"].to_numpy(np.int64)
    own, own_class = names[:OWN_SYMBOLS], held["class"].to_numpy(np.int64)[:OWN_SYMBOLS]
    own_order, order = np.argsort(own), np.argsort(names)
    mass = np.ones(CLASSES)
    for r in counted.groupBy("class").agg(F.sum(F.col("n") + 1).alias("mass")).collect():  # one row per class
        mass[r["class"]] += r["mass"]
    np.subtract.at(mass, own_class, n[:OWN_SYMBOLS] + 1)  # these have a symbol of their own
    return Vocabulary(sums[0] or 0, sums[1], own[own_order], own_order, mass, names[order], n[order])


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _lanes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Time-major places: texts by falling length, all first tokens, then all second ones, and so on."""
    rank = np.argsort(np.argsort(-lengths, kind="stable"), kind="stable")
    active = np.bincount(lengths, minlength=lengths.max() + 1)[::-1].cumsum()[::-1][1:]
    begins = np.concatenate([[0], np.cumsum(active)])
    step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return begins[step] + np.repeat(rank, lengths), begins, rank


def forward(found: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, ...]:
    """Scaled forward variables, scales and emissions in time-major order, with the lanes."""
    place, begins, rank = _lanes(lengths)
    ordered = np.empty(len(found), dtype=np.int64)
    ordered[place] = found
    emitted = model.emit.T[ordered]
    alpha, scale = np.empty_like(emitted), np.empty(len(found))
    now = model.start[None, :]
    for t in range(len(begins) - 1):
        a, b = begins[t], begins[t + 1]
        now = (now if t == 0 else now[: b - a] @ model.move) * emitted[a:b]
        sums = now.sum(axis=1)
        now = now / sums[:, None]
        alpha[a:b], scale[a:b] = now, sums
    return ordered, emitted, alpha, scale, place, begins, rank


def log10_likelihood(found: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """log10 of the probability of each symbol sequence."""
    _, _, _, scale, place, _, _ = forward(found, lengths, model)
    logs = np.log10(scale)[place]
    return np.add.reduceat(logs, np.cumsum(lengths) - lengths)


def expected(found: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Expected starts, moves and emissions of the sequences, flattened."""
    ordered, emitted, alpha, scale, _, begins, _ = forward(found, lengths, model)
    beta = np.ones_like(alpha)
    for t in range(len(begins) - 3, -1, -1):
        a, b, c = begins[t], begins[t + 1], begins[t + 2]
        beta[a : a + c - b] = (emitted[b:c] * beta[b:c] / scale[b:c, None]) @ model.move.T
    later = np.arange(begins[1], len(ordered))
    widths = np.diff(begins)
    before = later - np.repeat(widths[:-1], widths[1:])
    ahead = emitted[later] * beta[later] / scale[later, None]
    moves = model.move * (alpha[before].T @ ahead)
    gamma = alpha * beta
    emissions = np.stack([np.bincount(ordered, weights=g, minlength=SYMBOLS) for g in gamma.T])
    return np.concatenate([gamma[: begins[1]].sum(axis=0), moves.ravel(), emissions.ravel()])


def maximise(counts: np.ndarray) -> Model:
    """The model of expected counts; small constants keep every event possible."""
    start, move, emit = np.split(counts, [STATES, STATES + STATES**2])
    start, move, emit = start + 0.1, move.reshape(STATES, STATES) + 0.1, emit.reshape(STATES, SYMBOLS) + 0.01
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _start(sequences: DataFrame) -> Model:
    """Baum-Welch on a bounded sample, from whole texts dealt to states."""
    sample = sequences.filter(F.col("n") <= START_WORDS).orderBy(F.xxhash64("symbols")).limit(START_TEXTS).select("symbols").collect()
    held = sorted(bytes(r["symbols"]) for r in sample)
    if not held:
        return maximise(np.zeros(STATES + STATES**2 + STATES * SYMBOLS))
    parts = [np.frombuffer(s, np.uint16).astype(np.int64) for s in held]
    draw = np.random.default_rng(7)
    emit = 0.2 + draw.random((STATES, SYMBOLS))
    for part in parts:
        np.add.at(emit[draw.integers(STATES)], part, 1.0)
    model = Model(np.full(STATES, 1 / STATES), np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES), emit / emit.sum(axis=1, keepdims=True))
    joined, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
    for _ in range(START_ROUNDS):
        model = maximise(expected(joined, lengths, model))
    return model


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Joined symbols and lengths of runs of sequences of bounded size; no sequence is cut.

    Sequences go by length, so a run takes few steps unless its sequences are long.
    """
    run, size = [], 0
    for held in sorted(column.to_pylist(), key=len):
        part = np.frombuffer(held, np.uint16)
        if run and size + len(part) > GROUP_TOKENS:
            yield np.concatenate(run).astype(np.int64), np.array([len(p) for p in run])
            run, size = [], 0
        run.append(part)
        size += len(part)
    if run:
        yield np.concatenate(run).astype(np.int64), np.array([len(p) for p in run])


def _sequences(docs: DataFrame, words: Vocabulary) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text.groups(whole):
                found, group, places = tokens(batch)
                symbols = words.symbols(found, group).astype(np.uint16)
                held = [symbols[a:b].tobytes() for a, b in zip(places[:-1], places[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), pa.array(np.diff(places))], names=["symbols", "n"])

    return docs.select("text").mapInArrow(run, "symbols binary, n long")


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over every row of `docs` (text)."""
    sequences = stage_table(_sequences(docs, _without_counts(words)), "sequences")
    model = _start(sequences)
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(STATES + STATES**2 + STATES * SYMBOLS)
            for batch in batches:
                for found, lengths in _pieces(batch.column("symbols")):
                    total += expected(found, lengths, model)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["cell", "value"])

        summed = sequences.select("symbols").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
        counts = np.zeros(STATES + STATES**2 + STATES * SYMBOLS)  # as many cells at most
        counts[summed["cell"].to_numpy(np.int64)] = summed["value"].to_numpy(float)
        model = maximise(counts)
    return model


def _without_counts(words: Vocabulary) -> Vocabulary:
    return Vocabulary(words.total, words.distinct, words.own, words.own_symbol, words.class_total, words.frequent[:0], words.frequent_count[:0])


def score(docs: DataFrame, counted: DataFrame, words: Vocabulary, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of `docs` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast((words, model))  # bounded by FREQUENT and SYMBOLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = sent.value
        for whole in batches:
            for batch in text.groups(whole):
                found, group, places = tokens(batch)
                firsts, lengths = places[:-1], np.diff(places)
                symbols = words.symbols(found, group)
                names, at, times_at = np.unique(found, return_index=True, return_inverse=True)
                n = np.zeros(len(names), dtype=np.int64)
                if len(words.frequent):
                    slot = np.minimum(np.searchsorted(words.frequent, names), len(words.frequent) - 1)
                    n = np.where(words.frequent[slot] == names, words.frequent_count[slot], 0)
                settled = (n > 0) if words.distinct > len(words.frequent) else np.ones(len(n), dtype=bool)
                shared = symbols[at] < OWN_SYMBOLS
                inside = np.where(shared, 0.0, np.log10((n + 1) / words.class_total[group[at]]))
                base = np.log10((n + 1) / words.base)
                add = lambda v: np.add.reduceat(np.where(settled, v, 0)[times_at], firsts)  # noqa: B023, E731
                rare, rare_class = [], []
                open_ = ~settled[times_at]
                for a, b in zip(places[:-1], places[1:]):
                    mask = open_[a:b]
                    rare.append(found[a:b][mask].view(np.int64) if mask.any() else [])
                    rare_class.append(group[a:b][mask] if mask.any() else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(lengths), pa.array(add(n > 0).astype(np.int64)), pa.array(add(base)),
                     pa.array(add(inside) + log10_likelihood(symbols, lengths, model)), pa.array(rare, pa.list_(pa.int64())), pa.array(rare_class, pa.list_(pa.int64()))],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score", "rare", "class"],
                )

    kind = "doc_id long, n_tokens long, n_known long, base_score double, score double, rare array<long>, class array<long>"
    # The row number is stored with the rows, so it stays fixed.
    part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kind)
    held = stage_table(part.withColumn("row", F.monotonically_increasing_id()), "partly-scored")
    rare = held.select("row", F.explode(F.arrays_zip("rare", "class")).alias("t")).select("row", F.col("t.rare").alias("token"), F.col("t.class").alias("class"))
    mass = F.element_at(F.array(*map(F.lit, words.class_total.tolist())), (F.col("class") + 1).cast("int"))
    looked = rare.groupBy("row", "token", "class").agg(F.count(F.lit(1)).alias("times")).join(counted.select("token", "n"), "token", "left")
    n = F.coalesce("n", F.lit(0))
    rest = looked.groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((n + 1) / words.base)).alias("base"),
        F.sum(F.col("times") * F.log10((n + 1) / mass)).alias("inside"),
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    joined = held.drop("rare", "class").join(rest, "row", "left")
    return joined.select("doc_id", "n_tokens", plus("n_known", "known"), plus("base_score", "base"), plus("score", "inside"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: likelihood of every document under the hidden Markov model."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    training = docs.filter(rows.remainder(7) != 2)
    counted = stage_table(token_counts(training), "token-counts")
    words = vocabulary(counted)
    scored = score(docs, counted, words, train(training, words))
    return scored.select(
        "doc_id", (rows.remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
