"""Operator 8, quality rules on cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, white space runs to one space) and hashed. For each host (the
document's source) the distinct documents that hold a line are counted; copies of one text are
one document there, since they say nothing about a site's boilerplate. A line above the
host's limit is removed, and a document that loses more than `MOST_REMOVED` percent of its words is
rejected. Per-document rules on length and repeated windows come first.

Defined cases: a null text has no words, so it fails the base rule; a null source is a host of
its own; lines without a word are ignored; a line that repeats in a text is removed everywhere
and counts once; repeated rows get the same verdict; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm.text import WORD_PATTERN
from lakerisk.session import stage_table

WINDOW = 8  # a power of two
LEAST_WORDS = 20
MOST_REPEATED = 30
LIMIT_DOCUMENTS = 10
LIMIT_PERCENT = 5
MOST_REMOVED = 70
_SPACES = " \t\n\x0b\x0c\r"


def _words(value: Column) -> Column:
    """The words of a text; a split of the trimmed text costs half of a search for matches."""
    inner = F.btrim(value, F.lit(_SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def _joined(grams: str, apart: int) -> Column:
    """Hashes of runs twice as long: every gram with the one `apart` places on."""
    size = F.greatest(F.size(grams) - apart, F.lit(0))
    return F.zip_with(F.slice(grams, F.lit(1), size), F.slice(grams, F.lit(apart + 1), size), lambda a, b: F.xxhash64(a, b))


def measures(docs: DataFrame) -> DataFrame:
    """One narrow row per document: id, host, text key, base measures, and its lines as (hash, words)."""
    body = docs.select("doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_PATTERN))
    split = body.withColumns({"words": _words(F.col("text")), "lines": lines})
    # Windows of 8 words from runs of 1, 2 and 4, so a word is hashed once.
    single = split.withColumn("single", F.transform("words", lambda w: F.xxhash64(w)))
    double = single.withColumn("double", _joined("single", 1))
    four = double.withColumn("four", _joined("double", 2))
    hashed = four.withColumn("windows", _joined("four", 4)).drop("single", "double", "four")
    # Only a text with a repeated window is sorted; equal hashes then stand side by side.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn(
        "ordered",
        F.when(repeats, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    twice = F.transform(
        "ordered",
        lambda s, j: F.when((s["h"] == F.get("ordered", j - 1)["h"]) | (s["h"] == F.get("ordered", j + 1)["h"]), s["i"]),
    )
    placed = ordered.withColumn("places", F.array_sort(F.filter(twice, lambda i: i.isNotNull())))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return placed.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.length("text").alias("text_length"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all("text", F.lit(r"([#*$%&|<>])"))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.transform(
            F.transform("lines", lambda x: _words(F.lower(x))), lambda w: F.struct(F.xxhash64(w).alias("line"), F.size(w).alias("n"))
        ).alias("lines"),
    )


def removed_words(measured: DataFrame) -> DataFrame:
    """(host, text_hash, text_length, removed): words on lines above the host's limit."""
    text_key = ["host", "text_hash", "text_length"]
    once = measured.groupBy(*text_key).agg(F.first("lines").alias("lines"))
    lines = stage_table(
        once.select(*text_key, F.explode("lines").alias("l")).groupBy(*text_key, F.col("l.line").alias("line")).agg(F.sum("l.n").alias("n")), "lines"
    )
    # Copies are one document, so every text is counted once per host; counts combine before the shuffle.
    documents = measured.select(*text_key).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    held = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("held"))
    above = held.join(stage_table(documents, "hosts"), "host").filter(
        (F.col("held") > LIMIT_DOCUMENTS) & (F.col("held") * 100 > F.col("documents") * LIMIT_PERCENT)
    )
    common = stage_table(above.select("host", "line"), "common-lines")
    return lines.join(common, ["host", "line"]).groupBy(*text_key).agg(F.sum("n").alias("removed"))


def line_rules(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every row of `docs` (doc_id, text, source)."""
    measured = stage_table(measures(docs), "measured")
    removed = stage_table(removed_words(measured), "removed")
    joined = measured.drop("lines").join(removed, ["host", "text_hash", "text_length"], "left")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    lost = F.coalesce(F.col("removed"), F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (lost * 100 <= F.col("n_words") * MOST_REMOVED)).alias("kept"), lost.alias("removed_words"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: quality rules for every document."""
    return line_rules(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM docs
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM parts WHERE len(w) >= 8)
), twice AS (
  SELECT r, i FROM windows JOIN (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1) USING (r, g)
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(8) t(k) GROUP BY r
), lines AS (
  SELECT r, source, text, lower_line AS line, len(regexp_extract_all(lower_line, '[^\x20\x09-\x0D]+')) AS n FROM (
    SELECT r, source, text, array_to_string(regexp_extract_all(lower(unnest(l)), '[^\x20\x09-\x0D]+'), ' ') AS lower_line
    FROM parts)
), hosts AS (SELECT source, count(DISTINCT text) AS documents FROM docs GROUP BY source),
common AS (
  SELECT l.source, l.line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.line, h.documents
  HAVING count(DISTINCT l.text) > 10 AND count(DISTINCT l.text) * 100 > h.documents * 5
), removed AS (
  SELECT l.r, sum(l.n) AS n FROM lines l JOIN common c ON l.line = c.line AND l.source IS NOT DISTINCT FROM c.source GROUP BY l.r
), measured AS (
  SELECT p.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(d.n, 0)::BIGINT AS removed_words
  FROM parts p LEFT JOIN covered c USING (r) LEFT JOIN removed d USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND removed_words * 100 <= n_words * 70 AS kept,
       removed_words
FROM measured
"""
