"""Operator 11, phrase collocation mining: best-first branch and bound over phrase prefixes.

A phrase is grown word by word from its prefix. What counts are known of a prefix p = w1..wj bound
the score of everything grown from it: a longer phrase has a <= f(p), its first part at a cut k is
w1..wk, whose count is known, and the rest occurs at least a times, so its score is at most
2000000 * f(p) / (f(w1..wk) + f(p)) for every k <= j. Words and pairs are counted first. Then a limit
is set per language, all prefixes whose bound reaches it are expanded (and the neighbours on both
sides of every phrase whose score reaches it, since a longer phrase may drop it), and the limit is
lowered until 2000 phrases with their fate known reach it, or nothing is left below. Whatever
is not expanded is bounded below the limit, so the result is exact, ties included.

Each expansion counts in one pass over the texts. Tasks combine their counts in bounded tables, Spark
sums them per phrase. The set of prefixes to expand travels as a Bloom filter of bounded size
(at most 2**MOST_BITS bits); a false hit only counts a phrase that is not needed. Phrases are
told apart by 64-bit hashes built from their two halves.

Defined cases: a null text is empty, a null lang is `und`, repeated rows count again, a text of any
length is counted whole (a long one in runs of whole pieces), extra columns are ignored, an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakerisk.llm import text
from lakerisk.operators.ordering import with_rank
from lakerisk.session import drop_staged, stage_table

TOP = 2000
LEAST_COUNT = 30
SCALE = 2_000_000
DROP_PERCENT = 80
# The first limit is the score of the pair of this rank times TOP; each round goes down this much further.
START_RANKS, MORE_RANKS = 4, 8
MOST_BITS = 27
# A task hands its counts on when this many different phrases are held.
HELD = 250_000
LIMIT_STEP = 500

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[ord(c) for c in ".,;:!?\x0b\x0c\r"]] = 10
_HEAD, _TAIL = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of a phrase from the names of its prefix and its suffix (each one word shorter)."""
    return text.mix(left * _HEAD + right * _TAIL)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """(folded bytes, offsets, language hash of each text, languages) in runs of bounded size.

    Piece ends become line feeds, so one table of breaks serves words and pieces. A long text
    is cut at piece ends, which no phrase crosses.
    """
    for part in text.groups(batch):
        data, offsets = text.buffers(part.column("text"))
        data = _FOLD[data]
        langs = part.column("lang").to_pylist()
        marks, places = text.buffers(part.column("lang"))
        salt = text.span_hashes(marks, places[:-1], places[1:])
        if len(data) <= 2 * text.GROUP_BYTES:
            yield data, offsets, salt, langs
            continue
        start, ends = 0, np.flatnonzero(data == 10)
        while start < len(data):
            at = np.searchsorted(ends, start + text.GROUP_BYTES)
            end = int(ends[at]) + 1 if at < len(ends) else len(data)
            inside = offsets[(offsets > start) & (offsets < end)]
            owner = np.searchsorted(offsets, start, "right") - 1
            cut = np.concatenate([[start], inside, [end]]) - start
            rows = slice(owner, owner + len(cut) - 1)
            yield data[start:end], cut, salt[rows], langs[rows]
            start = end


def _words(data: np.ndarray, offsets: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, ...]:
    """(name, piece, text, start, end) of every word; equal words of two languages differ in name."""
    starts, ends, places = text.word_bounds(data, offsets)
    owner = np.repeat(np.arange(len(places) - 1), np.diff(places))
    names = text.mix(text.span_hashes(data, starts, ends) + salt[owner] * _TAIL)
    return names, np.cumsum(data == 10)[starts] + owner, owner, starts, ends


class _Counts:
    """A task's counts: sorted arrays, merged when many have come, handed on when they stay many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, name: np.ndarray, *other: np.ndarray) -> None:
        found, first, n = np.unique(name, return_index=True, return_counts=True)
        self.parts.append((found, n.astype(np.int64), *(c[first] for c in other)))
        self.rows += len(found)

    def full(self) -> bool:
        """Merge once twice the bound is held; true if that did not get below the bound."""
        if self.rows < 2 * HELD:
            return False
        self.parts = [self.merged()]
        self.rows = len(self.parts[0][0])
        return self.rows >= HELD

    def merged(self) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        found, first, place = np.unique(columns[0], return_index=True, return_inverse=True)
        n = np.bincount(place, weights=columns[1], minlength=len(found)).astype(np.int64)
        return found, n, *(c[first] for c in columns[2:])

    def drain(self) -> tuple[np.ndarray, ...]:
        out = self.merged()
        self.parts, self.rows = [], 0
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, id, f) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()

        def out() -> pa.RecordBatch:
            name, n, lang, word = held.drain()
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array([w.decode() for w in word], pa.string()), pa.array(name.view(np.int64)), pa.array(n)],
                names=["lang", "phrase", "id", "f"],
            )

        for batch in batches:
            for data, offsets, salt, langs in _runs(batch):
                names, _, owner, starts, ends = _words(data, offsets, salt)
                found, first, n = np.unique(names, return_index=True, return_counts=True)
                word = np.empty(len(found), dtype=object)
                word[:] = [data[a:b].tobytes() for a, b in zip(starts[first], ends[first])]
                held.parts.append((found, n.astype(np.int64), np.array(langs, dtype=object)[owner[first]], word))
                held.rows += len(found)
                if held.full():
                    yield out()
        if held.parts:
            yield out()

    counted = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, "lang string, phrase string, id long, f long")
    return counted.groupBy("lang", "phrase", "id").agg(F.sum("f").alias("f"))


def _probes(bits: int) -> tuple[int, int, int]:
    return 0, (64 - bits) // 2, 64 - bits


def _bloom(names: DataFrame, column: str = "id") -> np.ndarray | None:
    """Bit set of the names, of a size that follows their number up to 2**MOST_BITS bits; None for no name.

    The bits are made by Spark; the driver gets at most 2**(MOST_BITS - 6) words of it.
    """
    count = names.count()
    if not count:
        return None
    bits = max(14, min(MOST_BITS, math.ceil(math.log2(count * 12))))
    spots = F.explode(F.array(*[F.shiftrightunsigned(column, s).bitwiseAND((1 << bits) - 1) for s in _probes(bits)]))
    words = (
        names.select(spots.alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("word"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words["at"].to_numpy()] = words["word"].to_numpy()
    return out.view(np.uint64)


def _hits(bits: np.ndarray | None, names: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(names), dtype=bool)
    size = len(bits).bit_length() + 5
    hit = np.ones(len(names), dtype=bool)
    for shift in _probes(size):
        spot = (names >> np.uint64(shift)) & np.uint64((1 << size) - 1)
        hit &= (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) > 0
    return hit


def count_phrases(docs: DataFrame, size: int, prefixes=None, suffixes=None, own=None, both=None, least: int = LEAST_COUNT) -> DataFrame:
    """(id, prefix, suffix, f) of the phrases of `size` words with at least `least` occurrences.

    Counted are those whose prefix, suffix or own name is in the Bloom filter of that name, or whose
    prefix and suffix are both in `both`. All occurrences of a counted phrase count.
    """
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((prefixes, suffixes, own, both))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (before, after, self_, ends) = _Counts(), sent.value

        def out() -> pa.RecordBatch:
            _, n, prefix, suffix = held.drain()
            return pa.RecordBatch.from_arrays([pa.array(prefix.view(np.int64)), pa.array(suffix.view(np.int64)), pa.array(n)], names=["prefix", "suffix", "f"])

        for batch in batches:
            for data, offsets, salt, _ in _runs(batch):
                names, piece, *_ = _words(data, offsets, salt)
                for _ in range(size - 2):
                    names = _joined(names[:-1], names[1:])
                prefix, suffix = names[:-1], names[1:]
                whole = np.flatnonzero(piece[: len(prefix)] == piece[size - 1 :]) if len(prefix) else np.zeros(0, int)
                prefix, suffix = prefix[whole], suffix[whole]
                name = _joined(prefix, suffix)
                wanted = _hits(before, prefix) | _hits(after, suffix) | _hits(self_, name)
                if ends is not None:
                    wanted |= _hits(ends, prefix) & _hits(ends, suffix)
                held.add(name[wanted], prefix[wanted], suffix[wanted])
                if held.full():
                    yield out()
        if held.parts:
            yield out()

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, suffix = (batch.column(c).to_numpy().view(np.uint64) for c in ("prefix", "suffix"))
            yield pa.RecordBatch.from_arrays([pa.array(_joined(prefix, suffix).view(np.int64)), *batch.columns], names=["id", "prefix", "suffix", "f"])

    counted = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, "prefix long, suffix long, f long")
    frequent = counted.groupBy("prefix", "suffix").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return frequent.mapInArrow(named, "id long, prefix long, suffix long, f long")


def _ratio(part: Column, whole: Column) -> Column:
    """floor(SCALE * part / whole), exact beyond 64 bits."""
    return F.call_function("div", part.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)"), whole)


def _decimal(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def _scored(counted: DataFrame, shorter: DataFrame, size: int) -> DataFrame:
    """Phrases with the counts of all their parts, their lowest cut, and the bound of what grows from them.

    `heads` are the counts of w1, w1 w2, ... and `tails` those of the last word, the last two, ...
    """
    kept = ["lang", "phrase", "last", "f", "heads", "tails"]
    before = shorter.select(F.col("id").alias("prefix"), *[F.col(c).alias(f"p_{c}") for c in ("lang", "phrase", "f", "heads")])
    after = shorter.select(F.col("id").alias("suffix"), *[F.col(c).alias(f"s_{c}") for c in ("last", "f", "tails")])
    grown = counted.join(before, "prefix").join(after, "suffix").select(
        "id", "prefix", "suffix", "f", F.col("p_lang").alias("lang"), F.concat_ws(" ", "p_phrase", "s_last").alias("phrase"), F.col("s_last").alias("last"),
        F.concat("p_heads", F.array("p_f")).alias("heads"), F.concat("s_tails", F.array("s_f")).alias("tails"),
    )
    part = lambda k, name: F.get(F.col(name), F.lit(k))
    cuts = [
        F.struct(
            _ratio(F.col("f"), part(k - 1, "heads").cast("decimal(20,0)") + part(size - k - 1, "tails").cast("decimal(20,0)")).alias("score"),
            F.lit(k).alias("k"), part(k - 1, "heads").alias("l"), part(size - k - 1, "tails").alias("r"),
        )
        for k in range(1, size)
    ]
    bounds = [_ratio(F.col("f"), part(k - 1, "heads").cast("decimal(20,0)") + _decimal("f")) for k in range(1, size)]
    lowest = cuts[0] if size == 2 else F.least(*cuts)
    return grown.withColumns({"cut": lowest, "bound": bounds[0] if size == 2 else F.least(*bounds)}).select(
        "id", "prefix", "suffix", *kept, "cut.score", "cut.l", "cut.r", "bound"
    )


def _limits(pairs: DataFrame, ranks: int) -> DataFrame:
    """(lang, new): about the score of the pair of that rank in its language, 0 where there are fewer.

    Scores go into steps first, so a window holds a bounded number of rows per language.
    """
    steps = pairs.groupBy("lang", (F.floor(F.col("score") / LIMIT_STEP) * LIMIT_STEP).alias("at")).count()
    upto = Window.partitionBy("lang").orderBy(F.desc("at"))
    reached = steps.withColumn("n", F.sum("count").over(upto))
    return reached.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("n") >= ranks, F.col("at"))), F.lit(0)).cast("long").alias("new"))


def _newly(phrases: DataFrame, limits: DataFrame, measure: str) -> DataFrame:
    """Phrases whose bound or score reaches the new limit of their language and did not reach the old one."""
    return phrases.join(limits, "lang").filter((F.col(measure) >= F.col("new")) & (F.col(measure) < F.col("old")))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST_COUNT, start: int = START_RANKS, more: int = MORE_RANKS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to 4 words."""
    spoken = stage_table(count_words(docs), "words")
    totals = spoken.groupBy("lang").agg(F.sum("f").alias("n"))
    none = F.array().cast("array<bigint>")
    words = stage_table(spoken.filter(F.col("f") >= least).select("id", "lang", "phrase", F.col("phrase").alias("last"), "f", none.alias("heads"), none.alias("tails")), "level")
    pairs = stage_table(_scored(count_phrases(docs, 2, both=_bloom(words), least=least), words, 2), "level")
    limits = stage_table(_limits(pairs, start * top).withColumn("old", F.lit(SCALE).cast("long")), "limits")
    ranks, counted3, counted4 = start, None, None
    while True:
        # Three words: all that grow from a pair within bounds, and both neighbours of a pair that may rank.
        new3 = count_phrases(docs, 3, _bloom(_newly(pairs, limits, "bound")), _bloom(_newly(pairs, limits, "score")), least=least)
        counted3 = _union(counted3, new3)
        threes = stage_table(_scored(counted3, pairs, 3), "level")
        new4 = count_phrases(docs, 4, _bloom(_newly(threes, limits, "bound")), _bloom(_newly(threes, limits, "score")), least=least)
        counted4 = _union(counted4, new4)
        # Of four words, what may rank by its known parts needs the count of its last three.
        open4 = counted4.join(threes.select(F.col("id").alias("prefix"), F.col("lang"), F.col("f").alias("_f"), "heads", "bound"), "prefix").join(limits, "lang")
        open4 = open4.filter((F.col("bound") >= F.col("new")) & (_ratio(F.col("f"), F.get("heads", F.lit(0)).cast("decimal(20,0)") + _decimal("f")) >= F.col("new")))
        unknown = open4.join(counted3.select(F.col("id").alias("suffix")), "suffix", "left_anti").select("suffix").distinct()
        if (wanted := _bloom(unknown, "suffix")) is not None:
            counted3 = _union(counted3, count_phrases(docs, 3, own=wanted, least=least))
            drop_staged(threes)
            threes = stage_table(_scored(counted3, pairs, 3), "level")
        fours = _scored(counted4, threes, 4)
        ranked = stage_table(_survivors(pairs, threes, fours, counted3, counted4, limits), "ranked")
        reached = ranked.groupBy("lang").count()
        state = limits.join(reached, "lang", "left").withColumn("settled", (F.coalesce("count", F.lit(0)) >= top) | (F.col("new") == 0))
        if not state.filter(~F.col("settled")).isEmpty():
            ranks *= more
            lower = _limits(pairs, ranks * top).withColumnRenamed("new", "lower")
            limits = stage_table(
                state.join(lower, "lang").select("lang", F.col("new").alias("old"), F.when(F.col("settled"), F.col("new")).otherwise(F.least("new", "lower")).alias("new")), "limits"
            )
            drop_staged(threes, ranked)
            continue
        placed = with_rank(ranked, [F.desc("score"), F.desc("f"), F.col("phrase")], ["lang"])
        return placed.filter(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def _union(held: DataFrame | None, new: DataFrame) -> DataFrame:
    """Counts found so far; a phrase counted in two rounds has the same count twice."""
    return stage_table(new if held is None else held.unionByName(new).dropDuplicates(["id"]), "counted")


def _survivors(pairs: DataFrame, threes: DataFrame, fours: DataFrame, counted3: DataFrame, counted4: DataFrame, limits: DataFrame) -> DataFrame:
    """Phrases that reach the limit and that no longer phrase drops.

    A longer phrase has no more occurrences than the one-word extension inside it, so
    extensions by one word decide.
    """
    out = []
    for level, longer in ((pairs, counted3), (threes, counted4), (fours, None)):
        reached = level.join(limits, "lang").filter(F.col("score") >= F.col("new"))
        if longer is not None:
            wider = longer.select(F.col("prefix").alias("id"), F.col("f").alias("wide")).unionByName(longer.select(F.col("suffix").alias("id"), F.col("f").alias("wide")))
            most = wider.groupBy("id").agg(F.max("wide").alias("wide"))
            kept = F.coalesce(_decimal("wide"), F.lit(0).cast("decimal(20,0)")) * 100 < _decimal("f") * DROP_PERCENT
            reached = reached.join(most, "id", "left").filter(kept)
        out.append(reached.select("lang", "phrase", "f", "l", "r", "score"))
    return out[0].unionByName(out[1]).unionByName(out[2])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the collocations of every language of `documents`."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM lists, range(1, 5) s(size) WHERE len(w) >= size)
  GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}
), cuts AS (
  SELECT g.lang, g.size, g.phrase, g.f, k, array_to_string(string_split(g.phrase, ' ')[:k], ' ') AS head, array_to_string(string_split(g.phrase, ' ')[k + 1:], ' ') AS tail
  FROM grams g, range(1, 4) c(k) WHERE k < g.size
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.f AS a, arg_min((h.f, t.f), ({SCALE}::HUGEINT * c.f // (h.f + t.f), k)) AS parts,
         min({SCALE}::HUGEINT * c.f // (h.f + t.f))::BIGINT AS score
  FROM cuts c JOIN grams h ON h.lang = c.lang AND h.phrase = c.head AND h.size = c.k JOIN grams t ON t.lang = c.lang AND t.phrase = c.tail AND t.size = c.size - c.k
  GROUP BY ALL
), inner_parts AS (
  SELECT g.lang, array_to_string(string_split(g.phrase, ' ')[i:i + m - 1], ' ') AS phrase, m AS size, max(g.f) AS wide
  FROM grams g, range(2, 4) s(m), range(1, 4) p(i) WHERE m < g.size AND i + m - 1 <= g.size GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN inner_parts w ON w.lang = s.lang AND w.phrase = s.phrase AND w.size = s.size
  WHERE w.wide IS NULL OR 100 * w.wide::HUGEINT < {DROP_PERCENT} * s.a::HUGEINT
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, parts[1] AS l, parts[2] AS r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
