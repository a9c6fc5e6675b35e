"""Operator 5, n-gram Jaccard join: MinHash banding, then verification on full n-gram sets.

Texts with equal n-gram sets form a class first, so copies never meet each other. One
representative of each class is banded; rows that share a band hash form a candidate
component. Inside a component every pair of representatives is verified on the full sets in
blocks of bounded size, and only counts and a spanning forest leave a task, never pairs.

Defined cases: a null, empty or blank text has no n-gram, links to nothing and is its own
class. A text of fewer words than the n-gram size is one n-gram of all its words. A repeated
row is a copy like any other. A row without id goes by a negative hash of its text. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import text
from lakerisk.llm.graph import components
from lakerisk.session import drop_staged, stage_table

N_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 96
# Bounds of one verification block: rows, and n-grams over all its sets.
BLOCK_ROWS = 2048
BLOCK_GRAMS = 1_000_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows a band): the longest bands that find a pair at the threshold with that
    probability, for at most `most` hashes. Longer bands mean fewer false candidates."""
    found = (1, 1)
    for rows in range(1, most + 1):
        missed = 1 - threshold**rows
        bands = 1 if missed <= 0 else math.ceil(math.log(1 - recall) / math.log(missed))
        if bands * rows > most:
            break
        found = (bands, rows)
    return found


def row_key() -> Column:
    """doc_id, or for a row without one a negative number from its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-1) - F.abs(F.xxhash64("text") % F.lit(1 << 62)))


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    data, offsets = text.buffers(batch.column("text"))
    words, _, _, places = text.word_hashes(text.lower(data), offsets)
    for a, b in zip(places[:-1], places[1:]):
        yield text.gram_set(words[a:b], size)


def _set_key(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of n-grams, whatever their order."""
    high = np.bitwise_xor.reduce(text.mix(grams + np.uint64(0x5851F42D4C957F2D))) if len(grams) else np.uint64(0)
    low = grams.sum(dtype=np.uint64)
    return int(np.uint64(high).view(np.int64)), int(np.uint64(low).view(np.int64))


def _signature(grams: np.ndarray, seeds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    lowest = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(grams), 4096):
        part = grams[start : start + 4096, None] * seeds[None, :]
        np.minimum(lowest, part.min(axis=0), out=lowest)
    order = np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    banded = (lowest.reshape(bands, rows) * order[None, :]).sum(axis=1, dtype=np.uint64)
    return text.mix(banded + np.arange(bands, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)).view(np.int64)


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(id, high, low, n_grams, bands): the class key and the band hashes of every text."""
    seeds = text.mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text.groups(whole):
                keys, counts, marks = [], [], []
                for grams in _sets(batch, size):
                    keys.append(_set_key(grams))
                    counts.append(len(grams))
                    marks.append(_signature(grams, seeds, bands, rows) if len(grams) else [])
                high, low = zip(*keys)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(counts, pa.int64()), pa.array(marks, pa.list_(pa.int64()))],
                    names=["id", "high", "low", "n_grams", "bands"],
                )

    return docs.select(row_key().alias("id"), "text").mapInArrow(run, "id long, high long, low long, n_grams long, bands array<long>")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set.

    N-grams held by the same rows are one column with a weight, so a group of near copies
    needs few columns; the product runs over bounded runs of columns.
    """
    sets = left + right
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    rows, column = rows[shared], column[shared]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not len(rows):
        return out
    tags = text.mix(np.arange(1, len(sets) + 1, dtype=np.uint64))
    pattern = np.zeros(len(held), dtype=np.uint64)
    np.add.at(pattern, column, tags[rows])
    _, member, kind, weight = np.unique(pattern[np.unique(column)], return_index=True, return_inverse=True, return_counts=True)
    names = np.unique(column)
    kind_of = np.full(len(held), -1)
    kind_of[names] = kind
    chosen = np.zeros(len(held), dtype=bool)
    chosen[names[member]] = True
    keep = chosen[column]
    rows, kinds = rows[keep], kind_of[column[keep]]
    order = np.argsort(kinds, kind="stable")
    rows, kinds = rows[order], kinds[order]
    for start in range(0, len(weight), 2048):
        a, b = np.searchsorted(kinds, [start, start + 2048])
        used, at = np.unique(rows[a:b], return_inverse=True)
        wide = np.zeros((len(used), min(2048, len(weight) - start)), dtype=np.float32)
        wide[at, kinds[a:b] - start] = 1
        is_left = used < len(left)
        part = (wide[is_left] * weight[start : start + 2048].astype(np.float32)) @ wide[~is_left].T
        out[np.ix_(used[is_left], used[~is_left] - len(left))] += part
    return out


def _links(ids: np.ndarray, sets: list[np.ndarray], copies: np.ndarray, block: np.ndarray, pair: tuple[int, int], threshold: float):
    """Linked documents and the smallest linked id of each row of one pair of blocks."""
    one, two = np.flatnonzero(block == pair[0]), np.flatnonzero(block == pair[1])
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    shared = _overlaps([sets[i] for i in one], [sets[i] for i in two]).astype(np.float64)
    near = shared >= threshold * (sizes[one][:, None] + sizes[two][None, :] - shared) - 1e-9
    same = pair[0] == pair[1]
    if same:
        np.fill_diagonal(near, False)
    root = ids.copy()
    while True:
        before = root.copy()
        low = np.where(near, root[two][None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        root[one] = np.minimum(root[one], low)
        if not same:
            low = np.where(near, root[one][:, None], np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max)
            root[two] = np.minimum(root[two], low)
        if (root == before).all():
            break
    links = np.zeros(len(ids), dtype=np.int64)
    links[one] += near @ copies[two]
    if not same:
        links[two] += near.T @ copies[one]
    return links, root


def _compare(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby("component", sort=False):
            part = part.drop_duplicates("id")
            if len(part) < 2:
                continue
            ids, copies, block = (part[c].to_numpy(np.int64) for c in ("id", "copies", "block"))
            sets = [np.frombuffer(s, np.uint64) for s in part["grams"]]
            pair = (int(part["first"].iloc[0]), int(part["second"].iloc[0]))
            links, root = _links(ids, sets, copies, block, pair, threshold)
            out.append(pd.DataFrame({"id": ids, "links": links, "root": root})[links > 0])
        return pd.concat(out) if out else pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")

    return run


def _candidate_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The n-gram sets of the wanted representatives, read again from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text.groups(whole):
                sets = list(_sets(batch, size))
                keys = np.array([_set_key(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                fits = (keys[:, 0] == batch.column("high").to_numpy()) & (keys[:, 1] == batch.column("low").to_numpy())
                grams = pa.array([s.tobytes() for s in sets], pa.binary())
                named = {c: batch.column(c) for c in ("id", "component", "copies", "blocks", "pack")}
                yield pa.RecordBatch.from_pydict({**named, "grams": grams}).filter(pa.array(fits))

    # The merge hint keeps one plan at every size; a skewed id is split by AQE.
    return docs.select(row_key().alias("id"), "text").join(wanted.hint("merge"), "id").mapInArrow(
        run, "id long, component long, copies long, blocks long, pack long, grams binary"
    )


def jaccard_join(docs: DataFrame, size: int = N_WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, class_id, n_links) of every row of `docs` (doc_id, text).

    n_links counts the other rows whose n-gram Jaccard similarity is at least the threshold,
    copies included; class_id is the smallest id of the row's component under those links.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = stage_table(signatures(docs, size, bands, rows), "signatures")
    classes = stage_table(
        signed.filter("n_grams > 0").groupBy("high", "low").agg(
            F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    banded = classes.select("id", F.explode("bands").alias("band"))
    buckets = stage_table(
        banded.groupBy("band").agg(F.min("id").alias("low_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "low_id"), "buckets"
    )
    shared = banded.join(buckets, "band").filter("id <> low_id").select(F.col("id").alias("a"), F.col("low_id").alias("b"))
    candidates = stage_table(
        components(shared).join(classes.drop("bands"), F.col("node") == F.col("id")).select("id", "high", "low", "copies", "n_grams", "component"), "candidates"
    )
    drop_staged(buckets)
    sizes = candidates.groupBy("component").agg(F.sum("n_grams").alias("grams"), F.count(F.lit(1)).alias("n")).select(
        "component", F.greatest(F.ceil(F.col("grams") / BLOCK_GRAMS), F.ceil(F.col("n") / BLOCK_ROWS)).alias("blocks")
    )
    total = candidates.agg(F.sum("n_grams")).first()[0] or 0
    packs = max(1, math.ceil(2 * total / BLOCK_GRAMS))
    # Components of one block share packs of bounded size; a larger one is a pack of its own.
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(packs)) - packs).otherwise(F.col("component"))
    sized = stage_table(sizes, "sizes")
    wanted = stage_table(
        candidates.join(sized, "component").select("id", "high", "low", "copies", "component", "blocks", pack.alias("pack")), "wanted"
    )
    drop_staged(candidates, sized)
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    blocked = _candidate_sets(docs, wanted, size).withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    paired = blocked.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other")
    verified = stage_table(
        paired.groupBy("pack", "first", "second").applyInPandas(_compare(threshold), "id long, links long, root long"), "verified"
    )
    drop_staged(wanted)
    counted = stage_table(verified.groupBy("id").agg(F.sum("links").alias("links")), "links")
    rooted = stage_table(components(verified.select(F.col("id").alias("a"), F.col("root").alias("b"))), "rooted")
    drop_staged(verified)
    found = stage_table(
        classes.select("high", "low", "id", "copies")
        .join(rooted.withColumnRenamed("node", "id"), "id", "left")
        .join(counted, "id", "left")
        .select("high", "low", F.coalesce("component", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "found",
    )
    drop_staged(classes, rooted, counted)
    linked = signed.filter("n_grams > 0").select("id", "high", "low").join(found, ["high", "low"]).select("id", "class_id", "n_links")
    return linked.union(signed.filter("n_grams = 0").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long")))


def keep_one(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows of `docs` that stay: one of each class (the smallest id), all columns kept.

    Rows without any word stay, since they are nobody's copy. Where an id repeats inside a class,
    one of its equal rows stays.
    """
    kept = stage_table(joined.filter("id = class_id").groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_rows")), "kept")
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(text.WORD_PATTERN)
    chosen = docs.withColumn("_id", row_key()).join(kept.hint("merge"), "_id")
    single = chosen.filter((F.col("_rows") == 1) | blank)
    repeated = chosen.filter((F.col("_rows") > 1) & ~blank).dropDuplicates(["_id"])
    return single.union(repeated).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: class and number of links of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_join(docs).select(F.col("id").alias("doc_id"), "class_id", "n_links")


# All pairs on full 5-word sets; a shorter text is one gram of all its words.
SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM words WHERE len(w) > 0
), grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM pairs WHERE shared >= 0.8 * (na + nb - shared) - 1e-9),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS class_id,
       (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links
FROM documents d
"""
