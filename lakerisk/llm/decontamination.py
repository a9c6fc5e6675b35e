"""Operator 3, benchmark decontamination: q-gram lemma filtering, then banded alignment.

Texts and benchmark items are compared on lower-case letters and digits with single spaces. A passage
within k edits of an item of m characters shares at least m + 1 - q(k + 1) q-grams with it on
nearby diagonals. So the shared q-grams of every whole text are counted in diagonal bands that
overlap by half; bands that reach the bound are verified by a banded alignment that gives
the passage and its edits. The item index is built per block of at most `BLOCK_CHARACTERS`
of benchmark text and sent with the tasks; a larger benchmark takes more passes over the texts.

Defined cases: null and empty texts hold no passage; items that are null or shorter than
`LEAST_CHARACTERS` after normalising are too short to identify and are ignored; equal items are all
reported; repeated rows are reported alike; empty tables give an empty result or keep every
row; extra columns pass through `decontaminate` and are ignored by `passages`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import text

Q = 12
EDIT_RATE = 0.07
LEAST_CHARACTERS = 40
BLOCK_CHARACTERS = 1_000_000
_FILTER_BITS = 22
_ONE = np.int64(1) << 32
_FAR = np.int64(1) << 52

_SOLID = np.zeros(256, dtype=bool)
_SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, the place of each in `data`, and the offsets of the normalised texts."""
    solid = _SOLID[data]
    gap = ~solid
    gap[1:] &= solid[:-1]
    gap[offsets[:-1][offsets[:-1] < len(data)]] = False
    chosen = np.flatnonzero(solid | gap)
    out = text.lower(data[chosen])
    out[~solid[chosen]] = 32
    if len(out) > 1:  # accented capitals of Latin-1
        out[1:][(out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E)] += 32
    return out, chosen, np.searchsorted(chosen, offsets)


def qgrams(data: np.ndarray) -> np.ndarray:
    """Hash of the 12 bytes from every place, from runs of 1, 2, 4 and 8."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    run, four = data.astype(np.uint64) + np.uint64(1), None
    for length in (1, 2, 4):
        run = run[:-length] * np.uint64(pow(base, length, 1 << 64)) + run[length:]
        four = run if length == 2 else four
    return (run[: len(data) - Q + 1] * np.uint64(pow(base, 4, 1 << 64)) + four[8 : 8 + len(data) - Q + 1]) * np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Index:
    """One block of items: their texts and edit budgets, and where each q-gram stands."""

    ids: list[int]
    texts: list[np.ndarray]
    budget: np.ndarray
    needed: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @property
    def step(self) -> int:
        return int(self.budget.max()) + 1


def build_index(items: list[tuple[int, str]]) -> Index | None:
    """Index of (id, text) items; None if none is long enough."""
    ids, texts = [], []
    for key, value in items:
        raw = np.frombuffer((value or "").encode(), np.uint8)
        plain = normalise(raw, np.array([0, len(raw)]))[0]
        plain = plain[:-1] if len(plain) and plain[-1] == 32 else plain
        if len(plain) >= LEAST_CHARACTERS:
            ids.append(key)
            texts.append(plain)
    if not ids:
        return None
    lengths = np.array([len(t) for t in texts])
    # The budget never takes the bound below one shared q-gram.
    budget = np.minimum((lengths * EDIT_RATE).astype(int), (lengths + 1 - 1) // Q - 1)
    grams = np.concatenate([qgrams(t) for t in texts])
    item = np.repeat(np.arange(len(texts)), lengths - Q + 1)
    place = np.concatenate([np.arange(n - Q + 1) for n in lengths])
    order = np.argsort(grams, kind="stable")
    unique, first = np.unique(grams[order], return_index=True)
    return Index(ids, texts, budget, lengths + 1 - Q * (budget + 1), unique, np.append(first, len(grams)), item[order], place[order])


def _filter(index: Index) -> np.ndarray:
    table = np.zeros(1 << _FILTER_BITS, dtype=bool)
    table[(index.grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return table


def _candidates(plain: np.ndarray, offsets: np.ndarray, index: Index, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, band) wherever the count of shared q-grams reaches the item's bound."""
    grams = qgrams(plain)
    at = np.flatnonzero(table[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(index.grams, grams[at]), len(index.grams) - 1)
    real = index.grams[slot] == grams[at]
    at, slot = at[real], slot[real]
    owner = np.searchsorted(offsets, at, "right") - 1
    inside = at + Q <= offsets[owner + 1]
    at, slot, owner = at[inside], slot[inside], owner[inside]
    times = index.first[slot + 1] - index.first[slot]
    entry = np.repeat(index.first[slot] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(slot) else slot
    owner, local = np.repeat(owner, times), np.repeat(at - offsets[owner], times)
    item, diagonal = index.item[entry], local - index.place[entry]
    band = diagonal // index.step + (1 << 26)
    key = (owner.astype(np.int64) << 47) | (item.astype(np.int64) << 27)
    keys, hits = np.unique(np.concatenate([key | band, key | (band - 1)]), return_counts=True)
    item = (keys >> 27) & 0xFFFFF
    kept = hits >= index.needed[item]
    keys, item = keys[kept], item[kept]
    return keys >> 47, item, (keys & 0x7FFFFFF) - (1 << 26)


def align(patterns: list[np.ndarray], windows: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits of each pattern against any piece of its window, within the band; with start and end.

    Column j of the band holds the cost of the first i characters against a piece that ends at base + i
    + j. Cost and start travel in one number, so the smaller cost and then the earlier start win.
    """
    lengths = np.array([len(p) for p in patterns])
    width = windows.shape[1] - lengths.max()
    padded = np.zeros((len(patterns), lengths.max()), dtype=np.uint8)
    for row, pattern in zip(padded, patterns):
        row[: len(pattern)] = pattern
    lane = np.arange(width, dtype=np.int64)
    shift = lane * _ONE
    state = np.broadcast_to(lane, (len(patterns), width)).copy()
    best = np.full((len(patterns), 2), _FAR, dtype=np.int64)
    for i in range(lengths.max()):
        step = state + (windows[:, i : i + width] != padded[:, i : i + 1]) * _ONE
        step[:, :-1] = np.minimum(step[:, :-1], state[:, 1:] + _ONE)
        state = np.minimum.accumulate(step - shift, axis=1) + shift
        done = np.flatnonzero(lengths == i + 1)
        if len(done):
            column = state[done].argmin(axis=1)
            best[done] = np.column_stack([state[done, column], column])
    return best[:, 0] >> 32, base + (best[:, 0] & 0xFFFFFFFF), base + lengths + best[:, 1]


def find(batch: pa.RecordBatch, index: Index, table: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item number, start, end, edits) of each passage, in characters of the text."""
    data, offsets = text.buffers(batch.column("text"))
    plain, where, cuts = normalise(data, offsets)
    if not len(plain):
        return []
    owner, item, band = _candidates(plain, cuts, index, table)
    out: dict[tuple[int, int], list] = {}
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    for part in range(0, len(owner), 256):
        o, n, b = owner[part : part + 256], item[part : part + 256], band[part : part + 256]
        patterns, slack = [index.texts[i] for i in n], int(index.budget.max())
        base = b * index.step - slack
        longest, width = max(map(len, patterns)), 2 * index.step + 2 * slack
        spots = cuts[o][:, None] + base[:, None] + np.arange(longest + width)[None, :]
        inside = (spots >= cuts[o][:, None]) & (spots < cuts[o + 1][:, None])
        windows = np.where(inside, plain[np.clip(spots, 0, len(plain) - 1)], 0)
        edits, start, end = align(patterns, windows, base)
        for k in np.flatnonzero(edits <= index.budget[n]):
            first, last = cuts[o[k]] + max(0, start[k]), min(cuts[o[k]] + end[k], cuts[o[k] + 1]) - 1
            if last < first:
                continue
            origin = letters[offsets[o[k]]]
            found = (int(letters[where[first]] - origin), int(letters[where[last]] - origin + 1), int(edits[k]))
            out.setdefault((int(o[k]), int(n[k])), []).append(found)
    passages = []
    for (row, number), spans in out.items():
        for start, end, edits in sorted(spans, key=lambda s: (s[2], s[0])):  # the best of overlapping ones
            if all(end <= p[2] or start >= p[3] for p in passages if p[:2] == (row, number)):
                passages.append((row, number, start, end, edits))
    return passages


def blocks(benchmark: DataFrame, size: int = BLOCK_CHARACTERS) -> Iterator[Index]:
    """Indexes of the items in id order, a bounded block at a time."""
    held, used = [], 0
    for r in benchmark.filter("text is not null").select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        if held and used + len(r["text"]) > size:
            if (index := build_index(held)) is not None:
                yield index
            held, used = [], 0
        held.append((r["item_id"], r["text"]))
        used += len(r["text"])
    if (index := build_index(held)) is not None:
        yield index


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits) of every benchmark passage in `docs`, in characters."""
    schema = "doc_id long, item_id long, start long, end long, edits long"
    parts = []
    for index in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            table = _filter(index)
            for whole in batches:
                for batch in text.groups(whole):
                    found = find(batch, index, table)
                    ids = batch.column("doc_id").to_pylist() if found else []
                    rows = [(ids[r], index.ids[n], s, e, k) for r, n, s, e, k in found]
                    columns = zip(*rows) if rows else [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "start", "end", "edits"])

        parts.append(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark passage, with all their columns."""
    kept = docs
    for index in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            table = _filter(index)
            for whole in batches:
                for batch in text.groups(whole):
                    clean = np.ones(batch.num_rows, dtype=bool)
                    clean[[p[0] for p in find(batch, index, table)]] = False
                    yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every benchmark passage in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
