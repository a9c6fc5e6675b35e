"""Feature rows: one per entity and cut-off, using only facts known at the cut-off."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.functions.dates import age_days, month_end, month_index, year_month
from lakerisk.functions.ids import id_prefix, id_sequence
from lakerisk.functions.numbers import amount_per_worker, flag
from lakerisk.functions.text import filled, text_or
from lakerisk.operators.ordering import WINDOW_ROWS
from lakerisk.operators.selection import values_at
from lakerisk.session import stage_table
from lakerisk.sources.small import existing

# Month and date; facts without a date are known only where the date is None, which stands for everything.
Cutoff = tuple[str, str | None]

# Texts of the source data that decide a rule.
ANNULLED = "anulada"
LOCAL_CURRENCY = "nuevos soles"
UNKNOWN = "DESCONOCIDO"
UNKNOWN_BUYER = "ENTIDAD_DESCONOCIDA"
DEFAULT_MONTH = "202506"
VOUCHER_FLAGS = {
    "aff_invoice_portal": "factura portal",
    "aff_receipt_portal": "boleta portal",
    "aff_own_system": "sistemas del contribuyente",
}
FEE_VOUCHER = "honorarios"
AFFILIATION_ZEROS = [*VOUCHER_FLAGS, "aff_fees_only", "affiliated", "aff_n_types"]

# Facts a task takes on when they go to their entities.
TASK_FACTS = 500_000


def _first_column(df: DataFrame, names: list[str], default: Column) -> Column:
    """The first of several alternative columns that exists, else `default`."""
    return next((F.col(n) for n in names if n in df.columns), default)


def order_facts(orders: DataFrame, cutoff: str | None = None) -> DataFrame:
    """Entity, buyer, countable amount, annulled mark and date of every order up to the cut-off.

    The amount counts only if the order is not annulled and is in local currency (a
    null currency is local, a null amount is 0); other orders carry a null amount.
    """
    status = _first_column(orders, ["order_status", "status"], F.lit(""))
    annulled = F.lower(F.coalesce(status, F.lit(""))) == ANNULLED
    local = (
        F.coalesce(F.lower("currency"), F.lit(LOCAL_CURRENCY)) == LOCAL_CURRENCY
        if "currency" in orders.columns
        else F.lit(True)
    )
    name = _first_column(orders, ["buyer_name"], F.lit(None).cast("string"))
    dated = orders if cutoff is None else orders.filter(F.col("issue_date") <= F.lit(cutoff).cast("date"))
    facts = dated.select(
        F.col("contractor_id").try_cast("long").alias("entity_id"),
        F.coalesce(F.col("buyer_id").cast("string"), name, F.lit(UNKNOWN_BUYER)).alias("buyer"),
        F.when(~annulled & local, F.coalesce(F.col("amount"), F.lit(0.0)))
        .cast("decimal(18,2)")
        .alias("amount"),
        annulled.cast("int").alias("annulled"),
        F.col("issue_date").cast("date").alias("issue_date"),
    )
    return facts.filter(F.col("entity_id").isNotNull())


def _latest(cutoffs: list[Cutoff]) -> str | None:
    dates = [date for _, date in cutoffs]
    return None if None in dates else max(dates)


def _per_cutoff(df: DataFrame, column: str, cutoffs: list[Cutoff]) -> DataFrame:
    """Repeat each row for every cut-off it is known at, as `ref_month` and `_at`.

    One scan serves all cut-offs; the latest date is filtered first and reaches it.
    """
    day = F.col(column)
    upto = lambda date: F.lit(True) if date is None else day <= F.lit(date).cast("date")
    known = [
        F.when(upto(date), F.struct(F.lit(month).alias("ref_month"), F.lit(date).cast("date").alias("_at")))
        for month, date in cutoffs
    ]
    return df.filter(upto(_latest(cutoffs))).select("*", F.inline(F.array_compact(F.array(*known))))


def contract_profile(orders: DataFrame, cutoff: str | None = None, most: int = WINDOW_ROWS) -> DataFrame:
    """Contract profile per entity at one cut-off date (or over everything)."""
    return contract_profiles(orders, [(DEFAULT_MONTH, cutoff)], most=most).drop("ref_month")


def contract_profiles(orders: DataFrame, cutoffs: list[Cutoff], most: int = WINDOW_ROWS) -> DataFrame:
    """Contract profile per entity and cut-off month, from one scan of the orders.

    The facts are stored, so the feed behind them is read once, and go to the task of their entity in one
    exchange, before they are repeated per cut-off: every aggregate is taken there. Entities with more than
    `most` facts, counted beforehand, are spread over their buyers in place of that, and their medians are searched
    with histograms. Both ways are exact and give the same values: `most` only decides where the work is done.
    """
    keys = ["entity_id", "ref_month"]
    stored = stage_table(order_facts(orders, _latest(cutoffs)), "facts")
    sizes = stored.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    seen = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    tasks, some = seen["rows"] // TASK_FACTS + 1, seen["most"] > most
    large = stage_table(sizes.filter(F.col("n") > most).select("entity_id"), "large") if some else None
    usual = stored.join(large, "entity_id", "left_anti") if some else stored
    near = _per_cutoff(usual.repartition(tasks, "entity_id"), "issue_date", cutoffs)
    # The median is the row in the middle of those with an amount, so no sketch is filled row by row.
    by_value = Window.partitionBy(*keys).orderBy(F.col("amount").asc_nulls_last())
    every = by_value.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = near.withColumns({"_nth": F.row_number().over(by_value), "_of": F.count("amount").over(every)})
    middle = F.when((F.col("_nth") * 2 - F.col("_of")).between(0, 1), F.col("amount"))
    found = _per_entity(held, keys, F.max(middle).cast("double").alias("median_amount"))
    if some:
        spread = _per_cutoff(stored.join(large, "entity_id", "left_semi"), "issue_date", cutoffs)
        medians = values_at(spread, F.col("amount"), {"median_amount": F.floor((F.col("n") - 1) / 2)}, keys).drop("n")
        found = found.unionByName(_per_entity(spread, keys).join(medians, keys, "left"))
    return _with_shares(found)


def _with_shares(found: DataFrame) -> DataFrame:
    share = F.when(F.col("total_amount") > 0, F.col("_top_buyer") / F.col("total_amount"))
    return (
        found.withColumn("top_buyer_share", F.when(F.col("total_amount") <= 0, F.lit(0.0)).otherwise(share))
        .withColumn("total_contracted", F.col("total_amount"))
        .withColumn("contract_count", F.col("n_orders"))
        .drop("_top_buyer")
    )


def _per_entity(facts: DataFrame, keys: list[str], *held: Column) -> DataFrame:
    """One two-level aggregate (entity and buyer, then entity), which needs no distinct count.

    `held` are named greatest values per buyer, of which the greatest is carried on."""
    per_buyer = facts.groupBy(*keys, "buyer").agg(
        F.sum("amount").alias("amount"),
        F.max("amount").alias("largest"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("annulled").alias("annulled"),
        F.min("issue_date").alias("first_date"),
        *held,
    )
    carried = [c for c in per_buyer.columns if c not in {*keys, "buyer", "amount", "largest", "orders", "annulled", "first_date"}]
    return per_buyer.groupBy(*keys).agg(
        F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("total_amount"),
        F.sum("orders").alias("n_orders"),
        F.max("largest").cast("double").alias("max_amount"),
        F.count(F.lit(1)).alias("n_buyers"),
        (F.sum("annulled") / F.sum("orders")).alias("annulled_share"),
        F.min("first_date").alias("first_order_date"),
        F.max("amount").cast("double").alias("_top_buyer"),
        *[F.max(c).alias(c) for c in carried],
    )


def with_ref_month(registry: DataFrame) -> DataFrame:
    """Reference month yyyymm: kept, made from year and month, or the default."""
    if "ref_month" in registry.columns:
        return registry
    if {"year", "month"} <= set(registry.columns):
        return registry.withColumn("ref_month", year_month(F.col("year"), F.col("month")))
    return registry.withColumn("ref_month", F.lit(DEFAULT_MONTH))


def _month_number(df: DataFrame) -> Column:
    """Months since year zero, straight from year and month where the frame has them."""
    if "ref_month" not in df.columns and {"year", "month"} <= set(df.columns):
        return F.col("year").cast("int") * 12 + F.col("month").cast("int")
    return month_index(F.col("ref_month") if "ref_month" in df.columns else F.lit(DEFAULT_MONTH))


def registry_history(snapshots: DataFrame, month: str) -> DataFrame:
    """Months seen, gaps, newness and changes per entity, up to `month`."""
    return registry_histories(snapshots, [month]).drop("ref_month")


def registry_histories(snapshots: DataFrame, months: list[str]) -> DataFrame:
    """History per entity and reference month; a month only sees earlier snapshots.

    A tracked text has changed when the least and greatest hashes of its trimmed values differ, so
    no distinct count is needed; numbers, unlike texts, are aggregated without sorting the rows (two
    64-bit hashes agree by chance once in 2**64). Snapshots are first reduced to entity and month, then
    repeated per reference month. The first month of the whole feed is a scalar
    subquery of the same plan.
    """
    tracked = {"billing_mode": "billing_changed", "status": "status_changed"}
    tracked = {c: name for c, name in tracked.items() if c in snapshots.columns}
    index = lambda m: int(m[:4]) * 12 + int(m[4:])
    at = _month_number(snapshots)
    # On a partitioned table this only reads the partitions up to the last month.
    facts = snapshots.filter(at <= index(max(months))).select(
        F.col("entity_id").cast("long").alias("entity_id"),
        at.alias("at"),
        *[F.when(F.col(c).isNotNull(), F.xxhash64(F.trim(c))).alias(c) for c in tracked],
    )
    monthly = facts.groupBy("entity_id", "at").agg(
        *[F.min(c).alias(f"{c}_low") for c in tracked], *[F.max(c).alias(f"{c}_high") for c in tracked]
    )
    seen_by = [F.when(F.col("at") <= index(m), F.lit(m)) for m in months]
    repeated = monthly.withColumn("ref_month", F.explode(F.array_compact(F.array(*seen_by))))
    changed = [
        F.coalesce(F.min(f"{c}_low") != F.max(f"{c}_high"), F.lit(False)).cast("int").alias(name)
        for c, name in tracked.items()
    ]
    summary = repeated.groupBy("entity_id", "ref_month").agg(
        F.count(F.lit(1)).alias("months_seen"), F.min("at").alias("_first"), F.max("at").alias("_last"), *changed
    )
    start = facts.select(F.min("at").alias("start")).scalar()
    return (
        summary.withColumn("new_in_period", (F.col("_first") > start).cast("int"))
        .withColumn("months_gap", F.col("_last") - F.col("_first") + 1 - F.col("months_seen"))
        .drop("_first", "_last")
    )


def affiliation_features(affiliations: DataFrame, cutoff: str) -> DataFrame:
    """Affiliations in force at the cut-off, one row per entity."""
    return affiliation_histories(affiliations, [(DEFAULT_MONTH, cutoff)]).drop("ref_month")


def affiliation_histories(affiliations: DataFrame, cutoffs: list[Cutoff]) -> DataFrame:
    """Affiliations in force, one row per entity and cut-off month.

    Level one (entity and voucher type, first start) removes repeats before the
    shuffle and does not depend on the cut-off; level two counts types and takes flags.
    """
    started = affiliations.filter(F.col("start_date").isNotNull())
    per_type = started.groupBy(F.col("entity_id").cast("long").alias("entity_id"), "voucher_type").agg(
        F.min("start_date").alias("start_date")
    )
    has = lambda text: F.col("voucher_type").contains(text).cast("int")
    return (
        _per_cutoff(per_type, "start_date", cutoffs)
        .groupBy("entity_id", "ref_month")
        .agg(
            F.max(F.datediff("_at", "start_date")).alias("aff_age_days"),
            F.count("voucher_type").alias("aff_n_types"),
            *[F.max(has(text)).alias(name) for name, text in VOUCHER_FLAGS.items()],
            F.min(has(FEE_VOUCHER)).alias("aff_fees_only"),
        )
        .withColumn("affiliated", F.lit(1))
    )


def _shared_keys(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in ("entity_id", "ref_month") if c in left.columns and c in right.columns]


def attach_affiliations(features: DataFrame, affiliated: DataFrame) -> DataFrame:
    """Entities without an affiliation get zero flags; the age stays null."""
    return features.join(affiliated, _shared_keys(features, affiliated), "left").fillna(dict.fromkeys(AFFILIATION_ZEROS, 0))


def registry_features(registry: DataFrame, *months: str) -> DataFrame:
    """Capacity and registration features of the given snapshots (or of all)."""
    activity = _first_column(registry, ["activity"], F.lit("OTROS"))
    secondary = _first_column(registry, ["activity_secondary"], F.lit(None).cast("string"))
    workers = _first_column(registry, ["workers_text", "workers"], F.lit(None).cast("string")).try_cast("double")
    dated = with_ref_month(registry)
    if months:
        dated = dated.filter(F.col("ref_month").isin(*months))
    entity = F.col("entity_id").cast("long")
    derived = {
        "entity_id": entity,
        "main_activity": activity,
        "activity": activity,
        "entity_type": text_or(_first_column(registry, ["entity_type"], F.lit(UNKNOWN)), UNKNOWN),
        "region": text_or(_first_column(registry, ["region"], F.lit(UNKNOWN)), UNKNOWN),
        "workers": workers,
        # "Not available" is not zero workers: only a declared count raises the flag.
        "workers_known": flag(workers.isNotNull()),
        "no_workers": flag(workers <= 0),
        "id_prefix": id_prefix(entity),
        "id_sequence": id_sequence(entity),
        "n_activities": F.when(filled(secondary), 2).otherwise(1),
    }
    for mode in ("billing_mode", "accounting_mode"):
        if mode in registry.columns:
            derived[mode] = F.trim(mode)
    wanted = [
        "entity_id", "main_activity", "activity", "status", "condition", "entity_type", "region",
        "workers", "workers_known", "no_workers", "n_activities", "billing_mode", "accounting_mode",
        "id_prefix", "id_sequence", "ref_month",
    ]
    return existing(dated.withColumns(derived), wanted)


def exclusion_flag(exclusions: DataFrame) -> DataFrame:
    return exclusions.select("entity_id").distinct().withColumn("excluded", F.lit(True))


def regional_rate(summary: DataFrame) -> DataFrame:
    """(region, rate) pairs; raises when a region has two rates, which would repeat rows."""
    named = summary.filter(F.col("region").isNotNull())
    rates = named.select("region", F.col("informal_pct").alias("regional_informal_pct")).distinct()
    twice = rates.groupBy("region").count().filter(F.col("count") > 1).limit(5).collect()
    if twice:
        raise ValueError(f"regional summary has several rates for {[r['region'] for r in twice]}")
    return rates


def attach_regional(features: DataFrame, rates: DataFrame) -> DataFrame:
    return features.drop("regional_informal_pct").join(rates, "region", "left")


def combine_features(registry: DataFrame, contracts: DataFrame, excluded: DataFrame) -> DataFrame:
    """Registry with contract profile and exclusion flag.

    No orders means zero orders, amount, buyers and annulled share; median, maximum
    and top share stay null because there is nothing to take them from.
    """
    joined = registry.join(contracts, _shared_keys(registry, contracts), "left").join(excluded, "entity_id", "left")
    zeros = [c for c in ("n_orders", "total_amount", "n_buyers") if c in joined.columns]
    some = F.col("n_orders") > 0
    return (
        joined.fillna(dict.fromkeys(zeros, 0))
        .withColumns(
            {
                "contract_age_days": age_days(month_end(F.col("ref_month")), F.col("first_order_date")),
                "excluded": F.coalesce("excluded", F.lit(False)),
                "has_contracts": flag(some),
                "amount_per_worker": amount_per_worker(F.col("total_amount"), F.col("workers")),
                "total_contracted": F.coalesce("total_amount", F.lit(0.0)),
                "contract_count": F.coalesce("n_orders", F.lit(0)).cast("long"),
                "annulled_share": F.when(some, F.col("annulled_share")).otherwise(F.lit(0.0)),
            }
        )
        .drop("first_order_date")
    )


def feature_table(
    registry: DataFrame,
    snapshots: DataFrame,
    orders: DataFrame,
    exclusions: DataFrame,
    affiliations: DataFrame,
    cutoffs: list[Cutoff],
    rates: DataFrame | None = None,
) -> DataFrame:
    """Feature rows for every cut-off (month, date).

    All cut-offs share one scan of each source: rows are repeated per cut-off inside
    the aggregates and joined by entity and month, in place of a union of one plan per
    cut-off.
    """
    months = [month for month, _ in cutoffs]
    base = registry_features(registry, *months).join(
        registry_histories(snapshots, months), ["entity_id", "ref_month"], "left"
    )
    combined = combine_features(base, contract_profiles(orders, cutoffs), exclusion_flag(exclusions))
    features = attach_affiliations(combined, affiliation_histories(affiliations, cutoffs))
    if rates is not None:
        return attach_regional(features, rates)
    return features.withColumn("regional_informal_pct", F.lit(None).cast("double"))
