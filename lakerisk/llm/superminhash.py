"""Operator 13, MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find groups.

SuperMinHash gives every shingle a random permutation of the slots and the ranks 0, 1, 2, ... along it;
a slot keeps its lowest rank plus fraction. Ranks of one shingle never meet in a slot, which
lowers the variance against independent hashes, and ranks are drawn only until no slot can get
lower, after which a text stops: mostly after one or two ranks for a text of many shingles.

Texts with equal shingle sets form a class first. One text of a class is banded; classes that
share a band hash form a candidate group. A group within the bounds of one block is verified in one
task with a union-find: a row is compared with all rows at once, and rows that are already connected
are not compared again, so a group of near copies costs about one comparison per row. A larger group
first compares every row with the first row of its bands only, in a join; what is connected then needs no
more work, and just the bands that still hold unconnected rows are verified in pairs of blocks. Only
links of a spanning forest leave a task. All links are confirmed on full sets, in whole numbers.

Defined cases: a null, empty or blank text has no shingle, links to nothing and stays. Fewer words than
a shingle are one shingle of all words. A repeated row is a copy like any other; rows that share an id but not
a text stay apart. A row without id can't name a component: the component is the smallest id of
its group, null (and all rows kept) where no row has one. Extra columns are ignored, an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import text
from lakerisk.llm.graph import components
from lakerisk.llm.ngram_join import choose_bands, row_key
from lakerisk.session import drop_staged, stage_table

N_WORDS = 4
PERCENT = 80
RECALL = 0.9995
MAX_HASHES = 128
# Bounds of one verification block: rows, and shingles over all its sets.
BLOCK_ROWS = 2048
BLOCK_GRAMS = 1_000_000
# Edges a task of the component search.
GRAPH_ROWS = 50_000
_RANK_BITS = np.uint64(56)
_TOP = np.iinfo(np.uint64).max


def super_minhash(shingles: np.ndarray, owner: np.ndarray, count: int, slots: int) -> np.ndarray:
    """(count, slots) signatures of the shingle sets; `owner` is the set of each (distinct) shingle.

    Rank by rank for all shingles at once: the rank is the top byte of a value, a random fraction
    the rest. A set leaves as soon as its highest slot is below the next rank.
    """
    lowest = np.full((count, slots), _TOP, dtype=np.uint64)
    flat, order = lowest.reshape(-1), None
    for rank in range(slots):
        draw = text.mix(shingles + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = rank + ((draw >> np.uint64(32)) * np.uint64(slots - rank) >> np.uint64(32)).astype(np.int64)
        value = (np.uint64(rank) << _RANK_BITS) | (text.mix(draw) >> np.uint64(8))
        if order is None:
            spot = pick
        else:
            rows = np.arange(len(shingles))
            spot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
        np.minimum.at(flat, owner * slots + spot, value)
        going = (lowest.max(axis=1) >> _RANK_BITS > rank)[owner]
        if not going.any():
            break
        shingles, owner = shingles[going], owner[going]
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(shingles), 1))
            order[np.arange(len(shingles)), pick[going]] = 0
        else:
            order = order[going]
    return lowest


def _sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    data, offsets = text.buffers(batch.column("text"))
    words, _, _, places = text.word_hashes(text.lower(data), offsets)
    return [text.gram_set(words[a:b], size) for a, b in zip(places[:-1], places[1:])]


def _name(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingles, whatever their order."""
    high = np.bitwise_xor.reduce(text.mix(shingles ^ np.uint64(0xA0761D6478BD642F)), initial=np.uint64(0))
    return int(high).to_bytes(8, "big") + int(shingles.sum(dtype=np.uint64)).to_bytes(8, "big")


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(key, id, node, n, bands) of every row: the name of its shingle set, its size and its band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = text.mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        marks = text.mix(np.arange(bands, dtype=np.uint64) + np.uint64(1 << 32))
        for whole in batches:
            for batch in text.groups(whole):
                sets = _sets(batch, size)
                sizes = np.array([len(s) for s in sets])
                lowest = super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets), bands * rows)
                banded = text.mix((text.mix(lowest).reshape(-1, bands, rows) * weights).sum(axis=2, dtype=np.uint64) + marks).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"), batch.column("id"), pa.array([_name(s) for s in sets], pa.binary()), pa.array(sizes, pa.int64()),
                        pa.array([b if n else [] for b, n in zip(banded, sizes)], pa.list_(pa.int64())),
                    ],
                    names=["key", "id", "node", "n", "bands"],
                )

    return _keyed(docs).mapInArrow(run, "key long, id long, node binary, n long, bands array<long>")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("id"), "text")


def _with_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """`wanted` (key, node, ...) with the shingle sets, made again from the texts of those keys."""
    named = [f for f in wanted.schema.fields if f.name != "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text.groups(whole):
                sets = _sets(batch, size)
                fits = [_name(s) == n for s, n in zip(sets, batch.column("node").to_pylist())]
                columns = {f.name: batch.column(f.name) for f in named} | {"shingles": pa.array([s.tobytes() for s in sets], pa.binary())}
                yield pa.RecordBatch.from_pydict(columns).filter(pa.array(fits, pa.bool_()))

    # The merge hint keeps one plan at every size; a skewed key is split by AQE.
    joined = _keyed(docs).drop("id").join(wanted.hint("merge"), "key").drop("key").select("text", *[f.name for f in named])
    return joined.mapInArrow(run, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in named] + ["shingles binary"]))


def _near(shared, one, two, percent: int):
    return 100 * shared >= percent * (one + two - shared)


def _forest(sets: list[np.ndarray], groups: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (pairs of rows) that connect what is not connected yet.

    `groups` names the connected parts known so far. Where `side` holds both 0 and 1, only pairs
    across the sides count. A row is compared with all others in one count over the shingles it shares;
    that is done for rows outside the largest part until every pair across parts is settled.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    names, place = np.unique(np.concatenate(sets), return_inverse=True)
    holders = owner[np.argsort(place, kind="stable")]
    count = np.bincount(place, minlength=len(names))
    first = np.cumsum(count) - count
    begins = np.cumsum(sizes) - sizes
    part = np.unique(groups, return_inverse=True)[1]
    settled = np.zeros(len(sets), dtype=bool)
    across = side.any() and not side.all()
    links = []
    while True:
        weight = np.bincount(part)
        left = np.flatnonzero(~settled & (part != weight.argmax()))
        if not len(left):
            return links
        row = left[0]
        settled[row] = True
        own = place[begins[row] : begins[row] + sizes[row]]
        own = own[count[own] > 1]
        spread = np.repeat(first[own] - np.concatenate([[0], np.cumsum(count[own])[:-1]]), count[own]) if len(own) else np.zeros(0, int)
        shared = np.bincount(holders[spread + np.arange(len(spread))], minlength=len(sets))
        near = _near(shared, sizes[row], sizes, percent) & (part != part[row])
        if across:
            near &= side != side[row]
        for other in np.flatnonzero(near):
            if part[other] != part[row]:
                links.append((int(row), int(other)))
                part[part == part[other]] = part[row]


def _verify(percent: int):
    def run(pack: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in pack.groupby("component", sort=False):
            rows = rows.drop_duplicates("node")
            if len(rows) < 2:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
            side = (rows["block"] != rows["first"]).to_numpy()
            nodes = rows["node"].to_numpy()
            groups = np.unique([bytes(g).ljust(16) for g in rows["part"]], return_inverse=True)[1]
            out += [(nodes[a], nodes[b]) for a, b in _forest(sets, groups, side, percent)]
        return pd.DataFrame(out, columns=["a", "b"], dtype=object)

    return run


def _stars(banded: DataFrame, label: str) -> DataFrame:
    """(a, b): every node of a shared band with the smallest node of that band."""
    buckets = stage_table(banded.groupBy("band").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "low"), label)
    edges = banded.join(buckets, "band").filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    return stage_table(edges, "stars")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) that hold on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holds = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                one, two = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
                shared = len(np.intersect1d(one, two, assume_unique=True))
                holds.append(bool(_near(shared, len(one), len(two), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(holds, pa.bool_()))

    left, right = (sets.select(F.col("node").alias(n), F.col("shingles").alias(s)) for n, s in (("a", "left"), ("b", "right")))
    return edges.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def _sized(candidates: DataFrame) -> DataFrame:
    """(component, blocks, n): how many blocks of bounded size a candidate group needs."""
    return candidates.groupBy("component").agg(F.sum("n").alias("grams"), F.count(F.lit(1)).alias("rows")).select(
        "component", F.greatest(F.ceil(F.col("grams") / BLOCK_GRAMS), F.ceil(F.col("rows") / BLOCK_ROWS)).alias("blocks")
    )


def _blockwise(docs: DataFrame, wanted: DataFrame, size: int, percent: int) -> DataFrame:
    """Forest links (a, b) inside each candidate group of `wanted` (key, node, n, part, component, blocks).

    Groups of one block share packs of bounded size; a larger one goes in pairs of its blocks.
    """
    grams = wanted.agg(F.sum("n")).first()[0] or 0
    packs = max(1, math.ceil(2 * grams / BLOCK_GRAMS))
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(packs)) - packs).otherwise(F.pmod(F.xxhash64("component"), F.lit(1 << 62)))
    held = _with_sets(docs, wanted.withColumn("pack", pack).drop("n"), size)
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))
    spread = held.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = spread.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other")
    return paired.groupBy("pack", "first", "second").applyInPandas(_verify(percent), "a binary, b binary")


def near_duplicates(docs: DataFrame, size: int = N_WORDS, percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs` (doc_id, text)."""
    bands, rows = choose_bands(percent / 100, recall, MAX_HASHES)
    marks = stage_table(signed(docs, size, bands, rows), "signed")
    classes = stage_table(
        marks.filter("n > 0").groupBy("node").agg(F.min("key").alias("key"), F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes"
    )
    banded = classes.select("node", F.explode("bands").alias("band"))
    stars = _stars(banded, "buckets")
    named = components(stars, GRAPH_ROWS)
    candidates = stage_table(named.join(classes.select("node", "key", "n"), "node"), "candidates")
    sized = stage_table(_sized(candidates), "sizes")
    wanted = stage_table(candidates.join(sized, "component"), "wanted")
    drop_staged(candidates)
    small = wanted.filter("blocks = 1").withColumn("part", F.col("node"))
    large = wanted.filter("blocks > 1")
    links = stage_table(_blockwise(docs, small, size, percent), "links")
    near = None if large.isEmpty() else _near_stars(docs, large, stars, size, percent)
    rooted = stage_table(components(links if near is None else links.unionByName(near), GRAPH_ROWS), "rooted")
    drop_staged(stars, sized, links)
    grouped = classes.select("node", "id").join(rooted, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    if near is not None:
        higher = _open_bands(docs, large, rooted, banded, size, percent).withColumnRenamed("component", "higher")
        grouped = grouped.join(higher, grouped["component"] == higher["node"], "left").select(grouped["node"], "id", F.coalesce("higher", "component").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    found = grouped.select("node", "component").join(smallest, "component").select("node", "component_id")
    linked = marks.filter("n > 0").select("id", "n", "node").join(stage_table(found, "found"), "node").select("id", "n", "component_id")
    every = linked.unionByName(marks.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))
    kept = F.col("component_id").isNull() | F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return every.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def _near_stars(docs: DataFrame, large: DataFrame, stars: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the rows of large candidate groups and the first rows of their bands."""
    sets = stage_table(_with_sets(docs, large.select("key", "node"), size).dropDuplicates(["node"]), "sets")
    edges = stars.join(large.select(F.col("node").alias("a")), "a", "left_semi")
    near = stage_table(_confirmed(edges, sets, percent), "near")
    drop_staged(sets)
    return near


def _open_bands(docs: DataFrame, large: DataFrame, rooted: DataFrame, banded: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component): which components of `rooted` further links of large groups connect.

    A band whose rows are all connected is settled; only the rows of other bands are compared, in
    blocks, and just across the components they are in.
    """
    parts = rooted.withColumnRenamed("component", "part")
    parted = stage_table(large.drop("blocks").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node")), "parted")
    held = banded.join(parted.select("node", "part"), "node")
    mixed = held.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select("band")
    left = stage_table(parted.join(held.join(mixed, "band").select("node").distinct(), "node"), "open")
    wanted = stage_table(left.join(_sized(left), "component"), "wanted")
    more = stage_table(_blockwise(docs, wanted, size, percent), "links")
    ends = parted.select(F.col("node").alias("_node"), "part")
    for end in ("a", "b"):
        more = more.join(ends, F.col(end) == F.col("_node")).drop(end, "_node").withColumnRenamed("part", end)
    return components(more, GRAPH_ROWS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: near-duplicate group of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# All pairs on full sets of 4-word shingles.
SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g
  FROM words
), grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n - count(*) AS whole, count(*) AS shared
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
), links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * whole),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN found USING (doc_id)
"""
