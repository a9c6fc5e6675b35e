"""Ranking metrics as Spark tables: one ordered pass, then two aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.functions.regions import in_capital
from lakerisk.functions.text import strip_space
from lakerisk.operators.ordering import WINDOW_ROWS, with_running_totals
from lakerisk.session import stage_table

# Cut-offs, segment names and the size below which a segment is frail.
ABSOLUTE_KS = (100, 500)
RELATIVE_KS = {"0_1pct": 0.001, "1pct": 0.01, "5pct": 0.05}
CAPITAL, REST = "LIMA", "RESTO"
CONTRACTORS, NON_CONTRACTORS = "CONTRATISTAS", "NO_CONTRATISTAS"
FEW_POSITIVES = 30
RUN = ("run_id", "split")


def check_predictions(preds: DataFrame, ks: Sequence[int] = ABSOLUTE_KS, diagnostic: bool = False) -> DataFrame:
    """The rows to score: test only, unless the frame has no split column.

    Raises on missing columns, no rows, train rows (outside diagnostic mode), no test
    rows, or an absolute cut-off above the number of rows.
    """
    missing = [c for c in ("score", "label") if c not in preds.columns]
    if missing:
        raise ValueError(f"predictions lack {missing}")
    part = F.lower(F.col("split").cast("string")) if "split" in preds.columns else F.lit("test")
    seen = preds.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(part == "train").alias("train"), F.count_if(part == "test").alias("test")
    ).first()
    if seen["n"] == 0:
        raise ValueError("no predictions")
    if seen["train"] and not diagnostic:
        raise ValueError("train rows among the predictions; official metrics use test rows only")
    if not seen["test"] and not diagnostic:
        raise ValueError("no test rows among the predictions")
    rows = seen["test"] or seen["n"]
    too_big = [k for k in ks if k > rows]
    if too_big:
        raise ValueError(f"cut-offs {too_big} exceed the {rows} rows")
    return preds.filter(part == "test") if seen["test"] else preds


def walk(preds: DataFrame, groups: Sequence[str] = RUN) -> DataFrame:
    """Rows with rank, positives so far, and the totals of the group (score desc, id asc)."""
    narrow = preds.select(*groups, "id", F.col("score").cast("double").alias("score"), F.col("label").cast("int").alias("label"))
    return with_running_totals(
        narrow,
        [F.col("score").desc(), F.col("id")],
        {"rank": F.lit(1), "hits": F.col("label")},
        groups,
    )


def score_ladder(preds: DataFrame, groups: Sequence[str] = RUN) -> DataFrame:
    """One row per distinct score: its rows and positives, those so far, and the totals.

    Tied scores are merged before anything is ordered.
    """
    steps = preds.groupBy(*groups, F.col("score").cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("int")).alias("p")
    )
    return with_running_totals(
        steps, [F.col("score").desc()], {"n_upto": F.col("n"), "p_upto": F.col("p")}, groups
    )


def _average_precision(p: Column, p_upto: Column, n_upto: Column, p_all: Column, n_all: Column) -> Column:
    """Sum of precision times recall gain over distinct scores.

    Null without positives (the callers turn it into 0), exactly 1 with positives only.
    """
    area = F.sum(p / F.nullif(p_all, F.lit(0)) * p_upto / F.nullif(n_upto, F.lit(0)))
    return F.when(F.max(p_all) == F.max(n_all), F.when(F.max(p_all) > 0, F.lit(1.0))).otherwise(area)


def _roc_area(n: Column, p: Column, p_upto: Column, n_all: Column, p_all: Column) -> Column:
    """Chance that a positive outranks a negative, ties half; null with one class only."""
    beaten = (n - p) * (p_upto - p + p / 2.0)
    return F.sum(beaten / F.nullif(p_all * (n_all - p_all), F.lit(0)))


def rank_areas(preds: DataFrame, groups: Sequence[str] = RUN) -> DataFrame:
    """Average precision, ROC area and tie-neutral recall in the top 1 %, per group."""
    ladder = score_ladder(preds, groups)
    n, p, n_upto, p_upto = (F.col(c) for c in ("n", "p", "n_upto", "p_upto"))
    n_all, p_all = F.col("n_upto_all"), F.col("p_upto_all")
    k = F.ceil(F.lit(0.01) * n_all)
    above = n_upto - n
    share = F.when(n_upto <= k, p).when(above < k, p * (k - above) / n).otherwise(F.lit(0))
    return ladder.groupBy(*groups).agg(
        F.max(n_all).alias("n"),
        F.max(p_all).alias("n_positives"),
        F.coalesce(_average_precision(p, p_upto, n_upto, p_all, n_all), F.lit(0.0)).alias("pr_auc"),
        _roc_area(n, p, p_upto, n_all, p_all).alias("roc_auc"),
        F.coalesce(F.sum(share / F.nullif(p_all, F.lit(0))), F.lit(0.0)).alias("expected_recall_1pct"),
    )


def _cutoffs(ks: Sequence[int], size: Column) -> dict[str, Column]:
    """Rows each cut-off takes; null for an absolute one above the number of rows."""
    fixed = {str(k): F.when(size >= k, F.lit(k).cast("long")) for k in ks}
    part = {name: F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(x) * size)) for name, x in RELATIVE_KS.items()}
    return fixed | part


def _positives_at(preds: DataFrame, ladder: DataFrame, groups: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """Positives among the rows each cut-off takes: one row per group, `tp_<cut-off>` each.

    The ladder says which score a cut-off falls on and what lies above. Rows are looked up again and put in the order
    of their ids only where a cut-off parts tied rows of both labels: by a window while no such tie has more than
    `WINDOW_ROWS` rows, and spread over slices beyond.
    """
    above = F.col("n_upto") - F.col("n")
    cuts = F.array(*[F.struct(F.lit(c).alias("cut"), k.cast("long").alias("k")) for c, k in _cutoffs(ks, F.col("n_upto_all")).items()])
    hits = F.coalesce("p", F.lit(0))
    steps = ladder.select(*groups, "score", "n", hits.alias("p"), (F.col("p_upto") - hits).alias("p_above"), above.alias("above"), F.inline(cuts))
    ends = stage_table(
        steps.filter((F.col("k") > F.col("above")) & (F.col("k") <= F.col("above") + F.col("n"))).withColumn("nth", F.col("k") - F.col("above")),
        "cuts",
    )
    mixed = (F.col("nth") < F.col("n")) & (F.col("p") > 0) & (F.col("p") < F.col("n"))
    parted, keys = ends.filter(mixed), [*groups, "score"]
    most = parted.agg(F.max("n")).first()[0]
    some = F.when(F.col("nth") == F.col("n"), F.col("p")).when(F.col("p") > 0, F.col("nth")).otherwise(F.lit(0))
    if most is None:
        counted = ends.withColumn("tp", F.col("p_above") + some)
    else:
        renamed = lambda df: df.withColumnsRenamed({c: f"_{c}" for c in keys})
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
        rows = preds.select(*groups, "id", F.col("score").cast("double").alias("score"), F.col("label").cast("int").alias("label"))
        tied = rows.join(renamed(parted.select(*keys).distinct()), same, "left_semi")
        if most <= WINDOW_ROWS:
            upto = Window.partitionBy(*keys).orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            walked = tied.withColumns({"turn": F.count(F.lit(1)).over(upto), "hits": F.coalesce(F.sum("label").over(upto), F.lit(0))})
        else:
            walked = with_running_totals(tied, [F.col("id")], {"turn": F.lit(1), "hits": F.col("label")}, keys)
        met = renamed(walked.select(*keys, "turn", "hits"))
        counted = ends.join(met, [*same, F.col("nth") == F.col("turn"), mixed], "left").withColumn(
            "tp", F.col("p_above") + F.when(mixed, F.col("hits")).otherwise(some)
        )
    return counted.groupBy(*groups).agg(*[F.max(F.when(F.col("cut") == c, F.col("tp"))).alias(f"tp_{c}") for c in _cutoffs(ks, F.lit(0))])


def ranking_metrics(preds: DataFrame, groups: Sequence[str] = RUN, ks: Sequence[int] = ABSOLUTE_KS, stored: bool = False) -> DataFrame:
    """One row per group: sizes, areas, Brier score, metrics at K, confusion counts.

    Tied scores are merged before anything is ordered; areas, sizes and the rows a cut-off takes come from this
    ladder, and only rows that tie at a cut-off are looked at singly. Metrics at an absolute K above the rows of a
    group are null. The four columns needed are stored once; `stored` says that `preds` is a plain table already.
    """
    if not stored:
        preds = stage_table(preds.select(*groups, "id", "score", "label"), "preds")
    ladder = stage_table(score_ladder(preds, groups), "ladder")
    n, p, n_upto, p_upto, n_all, p_all = (F.col(c) for c in ("n", "p", "n_upto", "p_upto", "n_upto_all", "p_upto_all"))
    score = F.col("score")
    squared = (n - p) * score * score + p * (score - 1.0) * (score - 1.0)
    summed = ladder.groupBy(*groups).agg(
        F.max(n_all).alias("n"),
        F.max(p_all).alias("n_positives"),
        F.coalesce(_average_precision(p, p_upto, n_upto, p_all, n_all), F.lit(0.0)).alias("pr_auc"),
        _roc_area(n, p, p_upto, n_all, p_all).alias("roc_auc"),
        F.sum(squared).alias("_squared"),
    )
    at = _positives_at(preds, ladder, groups, ks).withColumnsRenamed({g: f"_{g}" for g in groups})
    summed = summed.join(at, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups])
    size, positives = F.col("n"), F.col("n_positives")
    final = _cutoffs(ks, size)
    out = [*groups, "n", "n_positives", (positives / size).alias("prevalence"), "pr_auc", "roc_auc",
           (F.col("_squared") / size).alias("brier")]
    for c, k in final.items():
        tp = F.col(f"tp_{c}")
        out += [
            (tp / k).alias(f"precision_{c}"),
            F.when(k.isNotNull(), F.coalesce(tp / F.nullif(positives, F.lit(0)), F.lit(0.0))).alias(f"recall_{c}"),
            F.when(k.isNotNull(), F.coalesce((tp / k) / (F.nullif(positives, F.lit(0)) / size), F.lit(1.0))).alias(f"lift_{c}"),
        ]
    for c in RELATIVE_KS:
        tp, k = F.col(f"tp_{c}"), final[c]
        out += [f"tp_{c}", (k - tp).alias(f"fp_{c}"), (positives - tp).alias(f"fn_{c}"),
                (size - k - positives + tp).alias(f"tn_{c}")]
    return summed.select(*out)


def with_segments(preds: DataFrame) -> DataFrame:
    """Every row once per segment it belongs to: capital or rest, region, contractor or not."""
    key = strip_space(F.upper("region"))
    area = F.when(in_capital(F.col("region")), F.lit(CAPITAL)).otherwise(F.lit(REST))
    own = F.when(~key.isin(CAPITAL, REST), key)
    parts = [area, own]
    if "has_contracts" in preds.columns:
        is_contractor = F.coalesce(F.col("has_contracts").cast("int"), F.lit(0)) == 1
        parts.append(F.when(is_contractor, F.lit(CONTRACTORS)).otherwise(F.lit(NON_CONTRACTORS)))
    return preds.withColumn("segment", F.explode(F.array_compact(F.array(*parts))))


def segment_metrics(preds: DataFrame, groups: Sequence[str] = RUN) -> DataFrame:
    """Metrics inside each segment; all null where a segment has no positives.

    Rates at 1 % and the few-positives mark belong to the contractor segments only.
    """
    scored = ranking_metrics(with_segments(preds), [*groups, "segment"], ks=())
    some = F.col("n_positives") > 0
    by_contract = F.col("segment").isin(CONTRACTORS, NON_CONTRACTORS)
    return scored.select(
        *groups,
        "segment",
        "n",
        "n_positives",
        F.when(some, F.col("prevalence")).alias("prevalence"),
        F.when(some, F.col("pr_auc")).alias("pr_auc"),
        F.when(some, F.col("recall_5pct")).alias("recall_5pct"),
        F.when(some & by_contract, F.col("recall_1pct")).alias("recall_1pct"),
        F.when(some & by_contract, F.col("lift_1pct")).alias("lift_1pct"),
        F.when(some & by_contract, F.col("n_positives") < FEW_POSITIVES).alias("few_positives"),
    )


def _packed(steps: DataFrame, groups: Sequence[str], replicates: int, most: int) -> DataFrame:
    """The ordered steps in runs of at most `most` of one group, with every replicate's totals over the run.

    Columns: groups, place (runs of a group in order), seeds, p, q (arrays over the steps), p_sum, n_sum (arrays
    over the replicates). The sort is the only exchange of the steps.
    """
    ordered = steps.orderBy(*groups, "step")
    columns = [*groups, "seed", "p", "q"]
    fields = [steps.schema[g] for g in groups]
    schema = T.StructType(
        [*fields, T.StructField("place", T.LongType())]
        + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("seeds", "p", "q", "p_sum", "n_sum")]
    )
    weights = _weights(replicates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held, key = TaskContext.get().partitionId() << 33, [], None

        def out() -> pd.DataFrame:
            rows = pd.concat(held)
            totals = np.zeros((2, replicates), dtype=np.int64)
            for p, q in weights(*(rows[c].to_numpy() for c in ("seed", "p", "q"))):
                totals += [p.sum(axis=0), (p + q).sum(axis=0)]
            one = dict(zip(groups, key)) | {"place": place} | {n: rows[c].tolist() for n, c in (("seeds", "seed"), ("p", "p"), ("q", "q"))}
            return pd.DataFrame([one | {"p_sum": totals[0].tolist(), "n_sum": totals[1].tolist()}])[schema.names]

        for batch in batches:
            for at, rows in batch.groupby(list(groups), sort=False, dropna=False):
                for start in range(0, len(rows), most):
                    part = rows.iloc[start : start + most]
                    if held and (at != key or sum(map(len, held)) + len(part) > most):
                        yield out()
                        place, held[:] = place + 1, []
                    key = at
                    held.append(part)
        if held:
            yield out()

    return stage_table(ordered.select(*columns).mapInPandas(run, schema), "packed")


def _weights(replicates: int):
    """Function of (seeds, p, q) that yields Poisson weights of positives and negatives in blocks of steps x replicates.

    A step's weights come from a generator of its own seed, so a re-run task and both passes repeat them.
    """

    def draw(seeds: np.ndarray, p: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = max(1, 500_000 // replicates)
        for start in range(0, len(seeds), size):
            block = slice(start, start + size)
            both = np.zeros((2, len(seeds[block]), replicates), dtype=np.int64)
            for i, (seed, hits, others) in enumerate(zip(seeds[block].view(np.uint64), p[block], q[block])):
                source = np.random.Generator(np.random.PCG64(int(seed)))
                both[0, i] = source.poisson(hits, replicates)
                both[1, i] = source.poisson(others, replicates)
            yield both[0], both[1]

    return draw


def _offsets(groups: Sequence[str]):
    """Totals of every replicate before each run of a group."""

    def run(runs: pd.DataFrame) -> pd.DataFrame:
        runs = runs.sort_values("place", ignore_index=True)
        out = runs[[*groups, "place"]].copy()
        for c in ("p_sum", "n_sum"):
            upto = np.cumsum(np.stack(runs[c]), axis=0)
            out[f"{c}_before"] = list(np.vstack([np.zeros((1, upto.shape[1]), np.int64), upto[:-1]]))
        return out

    return run


def bootstrap_interval(
    preds: DataFrame, groups: Sequence[str] = RUN, replicates: int = 1000, seed: int = 42, alpha: float = 0.05, most: int = 65_536
) -> DataFrame:
    """Percentile interval of the average precision, per group.

    Average precision only changes at scores with positives, so the ladder is first merged to one row
    per such score. Every replicate redraws the positives and the negatives of each row with Poisson weights
    (the limit of resampling rows). The steps are sorted once and packed in runs of at most `most`; a run
    holds the totals of all replicates as one array, the arrays are summed up over the runs of a
    group, and each run then adds its part of the average precision of every replicate. Steps x replicates
    exist in bounded blocks inside a task only. Replicates without positives are dropped.
    """
    ladder = score_ladder(preds, groups)
    steps = ladder.groupBy(*groups, (F.col("p_upto") - F.col("p")).alias("step")).agg(
        F.sum("p").alias("p"), F.sum(F.col("n") - F.col("p")).alias("q")
    )
    packed = _packed(steps.withColumn("seed", F.xxhash64(*groups, "step", F.lit(seed))), groups, replicates, most)
    keys = T.StructType([packed.schema[g] for g in groups] + [packed.schema["place"]])
    wide = T.StructType([*keys, *[T.StructField(f"{c}_before", T.ArrayType(T.LongType())) for c in ("p_sum", "n_sum")]])
    before = packed.select(*groups, "place", "p_sum", "n_sum").groupBy(*groups).applyInPandas(_offsets(groups), wide).drop(*groups)
    weights = _weights(replicates)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                p_upto, n_upto = row["p_sum_before"].copy(), row["n_sum_before"].copy()
                area = np.zeros(replicates)
                for p, q in weights(*(np.asarray(row[c], dtype=np.int64) for c in ("seeds", "p", "q"))):
                    p_all, n_all = p_upto + np.cumsum(p, axis=0), n_upto + np.cumsum(p + q, axis=0)
                    area += (p * (p_all / np.maximum(n_all, 1))).sum(axis=0)
                    p_upto, n_upto = p_all[-1], n_all[-1]
                yield pd.DataFrame([{g: row[g] for g in groups} | {"area": area, "p_sum": row["p_sum"], "n_sum": row["n_sum"]}])

    shares = T.StructType([*[packed.schema[g] for g in groups], T.StructField("area", T.ArrayType(T.DoubleType())), packed.schema["p_sum"], packed.schema["n_sum"]])
    shared = packed.join(before, "place").mapInPandas(parts, shares)
    spread = shared.select(*groups, F.posexplode(F.arrays_zip("area", "p_sum", "n_sum")).alias("replicate", "part"))
    summed = spread.groupBy(*groups, "replicate").agg(*[F.sum(f"part.{c}").alias(c) for c in ("area", "p_sum", "n_sum")])
    area = F.when(F.col("p_sum") == F.col("n_sum"), F.lit(1.0)).otherwise(F.col("area") / F.col("p_sum"))
    per_replicate = summed.select(*groups, F.when(F.col("p_sum") > 0, area).alias("pr_auc"))
    edge = lambda x: F.coalesce(F.percentile("pr_auc", F.lit(x)), F.lit(0.0))
    return per_replicate.groupBy(*groups).agg(
        edge(alpha / 2).alias("pr_auc_low"), edge(1 - alpha / 2).alias("pr_auc_high"), F.count("pr_auc").alias("replicates")
    )


def flat_metrics(preds: DataFrame, groups: Sequence[str] = RUN, ks: Sequence[int] = ABSOLUTE_KS, replicates: int = 0) -> DataFrame:
    """The flat metric row of every group, with segment columns and (optionally) the interval.

    Fields of the training infrastructure are present and null.
    """
    segments = segment_metrics(preds, groups)
    pick = lambda name, column: F.max(F.when(F.col("segment") == name, F.col(column)))
    by_segment = segments.groupBy(*groups).agg(
        pick(CAPITAL, "recall_5pct").alias("recall_capital"),
        pick(REST, "recall_5pct").alias("recall_rest"),
        pick(CONTRACTORS, "n").alias("n_contractors"),
        pick(CONTRACTORS, "n_positives").alias("n_positives_contractors"),
        pick(CONTRACTORS, "pr_auc").alias("pr_auc_contractors"),
        pick(CONTRACTORS, "recall_1pct").alias("recall_1pct_contractors"),
    )
    flat = ranking_metrics(preds, groups, ks).withColumn("pr_auc_baseline", F.col("prevalence"))
    flat = flat.join(by_segment, list(groups), "left")
    if replicates:
        edges = bootstrap_interval(preds, groups, replicates).drop("replicates")
        flat = flat.join(edges, list(groups), "left")
    else:
        flat = flat.withColumn("pr_auc_low", F.col("pr_auc")).withColumn("pr_auc_high", F.col("pr_auc"))
    infra = {"job_name": "string", "instance": "string", "billable_seconds": "double", "cost_usd": "double"}
    return flat.withColumns({c: F.lit(None).cast(kind) for c, kind in infra.items()})
