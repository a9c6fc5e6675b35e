"""Operator 4, mixing sources to target weights: balanced sampling by the cube method.

Sources get targets by weight; a source's rate (target over size) is a whole number of copies
plus a fraction, the inclusion probability of one more copy. The flight phase moves these
probabilities through the null space of two constraints, words and documents, until they are 0 or
1: first inside chunks of bounded size in parallel, then on what the chunks leave open (two
documents each), level by level, until one chunk per source is left, where the landing phase
rounds the last two documents.

Defined cases: a null text has size 0; sources are ordered by code point with null last; a
source without words has target 0; repeated rows are documents of their own; the draws depend
only on ids and sizes, so reruns agree; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm.text import WORD_PATTERN
from lakerisk.operators.ordering import with_rank
from lakerisk.session import stage_table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
CHUNK = 4096
_OPEN = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """(host, source_size, documents, target) of every source of `sizes` (host, size).

    The common level of the sources below their limit rises until none is above it; every
    round is one small aggregate over the sources.
    """
    totals = sizes.groupBy("host").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    ranked = with_rank(totals, [F.col("host").startswith("n"), F.col("host")])
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    weighed = stage_table(ranked.withColumn("weight", weight), "sources")
    limit, level = most * F.col("source_size"), 0.0
    while True:
        full = F.col("weight") * level > limit
        row = weighed.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, limit)).alias("spent"), F.sum(F.when(~full, F.col("weight"))).alias("open")
        ).first()
        if not row["open"]:
            break
        rises = (share * row["all"] - (row["spent"] or 0.0)) / row["open"]
        if rises <= level:
            break
        level = rises
    return weighed.select("host", "source_size", "documents", F.least(limit, F.col("weight") * level).alias("target"))


def _flight(share: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Move inclusion probabilities with the sums of `share` and `share * size` fixed; at most two stay open."""
    share, open_ = share.copy(), []
    for i in np.flatnonzero((share > _OPEN) & (share < 1 - _OPEN)):
        open_.append(i)
        if len(open_) < 3:
            continue
        a, b, c = size[open_]
        step = np.array([b - c, c - a, a - b])
        if not step.any():
            step = np.array([1.0, -1.0, 0.0])
        now, moves = share[open_], step != 0
        up = np.where(step > 0, (1 - now), now)[moves] / np.abs(step[moves])
        down = np.where(step > 0, now, 1 - now)[moves] / np.abs(step[moves])
        ahead, back = up.min(), down.min()
        now = now + step * (ahead if draw.random() * (ahead + back) < back else -back)
        now[now <= _OPEN], now[now >= 1 - _OPEN] = 0.0, 1.0
        share[open_] = now
        open_ = [k for k, p in zip(open_, now) if 0 < p < 1]
    return share


def _land(share: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the last open documents so that words, then documents, come nearest.

    A very large document among the last two can leave the words off by a part of its size; then up
    to three single exchanges inside the chunk bring them nearer.
    """
    open_ = np.flatnonzero((share > _OPEN) & (share < 1 - _OPEN))
    best = min(
        product((0.0, 1.0), repeat=len(open_)),
        key=lambda x: (abs(((np.array(x) - share[open_]) * size[open_]).sum()), abs((np.array(x) - share[open_]).sum()), x),
    )
    landed = share.copy()
    landed[open_] = best
    landed = landed.round()
    wanted = (share * size).sum()
    for _ in range(3 if len(open_) else 0):
        off = (landed * size).sum() - wanted
        after = np.abs(off + np.where(landed > 0, -size, size))
        i = int(after.argmin())
        if after[i] >= abs(off):
            break
        landed[i] = 1 - landed[i]
    return landed


def _draw(level: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # Large documents first: what stays open for the landing is small, so its rounding is too.
        group = group.sort_values(["size", "order", "doc_id", "share"], ascending=[False, True, True, True], na_position="last").reset_index(drop=True)
        seed = [level, int(group["order"].iloc[0]) & 0x7FFFFFFFFFFFFFFF, int(group["chunk"].iloc[0])]
        size = group["size"].to_numpy(float)
        share = _flight(group["share"].to_numpy(float), size, np.random.default_rng(seed))
        return group.assign(share=_land(share, size) if group["chunks"].iloc[0] == 1 else share)

    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """(doc_id, size, source_size, target, copies) of every row of `docs` (doc_id, text, source)."""
    sized = stage_table(
        docs.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("a"), "source"), F.lit("n")).alias("host"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN)).cast("long").alias("size"),
        ),
        "sized",
    )
    targets = stage_table(source_targets(sized, weights, share, most), "targets")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    rated = sized.join(targets.withColumn("rate", rate), "host").select(
        "doc_id", "host", "size", "source_size", "target", F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("share"),
        F.xxhash64("doc_id", "size").alias("order"), F.ceil(F.col("documents") / CHUNK).alias("chunks"),
    )
    done, left, level = [], rated, 0
    while True:
        chunked = left.withColumn("chunk", F.pmod(F.xxhash64("order", F.lit(level)), F.col("chunks")))
        drawn = stage_table(chunked.groupBy("host", "chunk").applyInPandas(_draw(level), chunked.schema), "drawn")
        is_open = (F.col("share") > _OPEN) & (F.col("share") < 1 - _OPEN)
        done.append(drawn.filter(~is_open))
        rest = drawn.filter(is_open)
        if rest.isEmpty():
            break
        level += 1
        counts = stage_table(rest.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")), "counts")
        left = rest.drop("chunks", "chunk").join(counts, "host").select(rated.columns)
    every = done[0]
    for part in done[1:]:
        every = every.union(part)
    copies = (F.col("whole") + F.round("share")).cast("long")
    return every.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"))


def mixture(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of `docs` as the mix takes them, repeated as often as it says; ids must be unique."""
    plan = mixed.filter("copies > 0").select(F.col("doc_id").alias("_id"), "copies")
    taken = docs.join(plan, docs["doc_id"].eqNullSafe(plan["_id"]))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: what the mix takes of every document."""
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
