"""Rates, budgets, costs, retention and purges."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.ranking import STRETCH, matched, position_in_group, stretches

# Requests per window, alert thresholds, delete batch, retention by
# key prefix in days, and list prices per unit by (extractor, modality).
RATE_LIMIT = 2000
RATE_MINUTES = 5
BUDGET_THRESHOLDS = (50.0, 90.0)
FORECAST_THRESHOLD = 100.0
DELETE_BATCH = 1000
RETENTION_DAYS = {"uploads/": 1, "bda-output/": 1}
PRICES = {
    ("vision", "image"): 0.001,
    ("bda", "document"): 0.010,
    ("bda", "audio"): 0.006,
    ("bda", "video"): 0.050,
    ("textract", "document"): 0.050,
    ("textract", "image"): 0.050,
}
TABLES_SURCHARGE = 0.015


def rate_limit(requests: DataFrame, n: int = RATE_LIMIT, minutes: int = RATE_MINUTES) -> DataFrame:
    """Requests whose key made more than ``n`` in the trailing window.

    Adds ``in_window``; both ends of the window count. Requests are first summed
    to (key, instant) before any shuffle, and only instants in or right before a
    stretch of ``minutes`` that can hold a flagged request go on. A window's
    count is the difference of two running counts, each put together from those
    of the second, the hour and the key, so no task holds more of a key than the
    instants of a second, the seconds of an hour or its hours. Requests without
    a key are one group; those without a time are never flagged.
    """
    width = minutes * 60 * 1_000_000
    stamped = requests.withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    ticks = (
        stamped.filter(F.col("_us").isNotNull())
        .groupBy("key", "_us")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.floor(F.col("_us") / width))
    )
    near = lambda first, last: F.explode(
        F.sequence(F.col("_bucket") + first, F.col("_bucket") + last)
    ).alias("_bucket")
    busy = (
        ticks.groupBy("key", "_bucket")
        .agg(F.sum("_n").alias("_n"))
        .select("key", near(0, 1), "_n")
        .groupBy("key", "_bucket")
        .agg(F.sum("_n").alias("_n"))
        .filter(F.col("_n") > n)
        .select("key", near(-1, 0))
        .distinct()
    )
    # One event adds the requests of an instant, the other asks for the count
    # before the instant's window; at the same time it comes first.
    begin, own = F.struct((F.col("_us") - width).alias("at"), F.lit(False).alias("own")), F.struct(
        F.col("_us").alias("at"), F.lit(True).alias("own")
    )
    events = (
        matched(ticks, busy, ["key", "_bucket"])
        .select("key", "_us", "_n", F.explode(F.array(begin, own)).alias("_e"))
        .select(
            "key", "_us", "_e.at", "_e.own",
            F.when(F.col("_e.own"), F.col("_n")).otherwise(0).alias("_n"),
            F.floor(F.col("_e.at") / 1_000_000).alias("_second"),
        )
        .withColumn("_hour", F.floor(F.col("_second") / 3600))
    )
    seconds = events.groupBy("key", "_hour", "_second").agg(F.sum("_n").alias("_n"))
    hours = seconds.groupBy("key", "_hour").agg(F.sum("_n").alias("_n"))
    earlier = lambda keys, order: F.coalesce(
        F.sum("_n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    before_hour = hours.select("key", "_hour", earlier(["key"], "_hour").alias("_to_hour"))
    before_second = matched(
        seconds.select("key", "_hour", "_second", earlier(["key", "_hour"], "_second").alias("_to_second")),
        before_hour,
        ["key", "_hour"],
    ).select("key", "_second", (F.col("_to_second") + F.col("_to_hour")).alias("_before"))
    inside = Window.partitionBy("key", "_second").orderBy("at", "own").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = matched(events, before_second, ["key", "_second"]).withColumn("_upto", F.sum("_n").over(inside) + F.col("_before"))
    flagged = (
        running.groupBy("key", "_us")
        .agg(F.sum(F.when(F.col("own"), F.col("_upto")).otherwise(-F.col("_upto"))).alias("in_window"))
        .filter(F.col("in_window") > n)
    )
    return matched(stamped, flagged, ["key", "_us"]).drop("_us")


def budget_alerts(spend: DataFrame, limit: float) -> DataFrame:
    """(month, alert, threshold, day, amount): first days over each threshold.

    Actual alerts on spend to date, and a forecast alert on spend to date times
    days in the month over days passed. Spend is summed to days before any
    window, so a month is at most 31 rows however much was spent in it.
    """
    days = (
        spend.groupBy(F.to_date("day").alias("day"))
        .agg(F.sum("amount").alias("amount"))
        .withColumn("month", F.trunc("day", "month"))
    )
    to_date = Window.partitionBy("month").orderBy("day")
    running = days.withColumn("spent", F.sum("amount").over(to_date)).withColumn(
        "forecast", F.col("spent") * F.dayofmonth(F.last_day("day")) / F.dayofmonth("day")
    )
    checks = [("ACTUAL", t, F.col("spent")) for t in BUDGET_THRESHOLDS]
    checks.append(("FORECASTED", FORECAST_THRESHOLD, F.col("forecast")))
    tests = F.array(
        *[
            F.when(
                amount > limit * threshold / 100,
                F.struct(
                    F.lit(kind).alias("alert"), F.lit(threshold).alias("threshold"), amount.alias("amount")
                ),
            )
            for kind, threshold, amount in checks
        ]
    )
    return (
        running.select("month", "day", F.explode(F.array_compact(tests)).alias("a"))
        .groupBy("month", "a.alert", "a.threshold")
        .agg(F.min("day").alias("first_day"), F.min_by("a.amount", "day").alias("amount"))
    )


def price_per_unit(prices: dict[tuple[str, str], float] = PRICES, tables: bool = False) -> Column:
    """List price by extractor and modality; what is read locally is free."""
    price: Column = F.lit(0.0)
    for (extractor, modality), amount in prices.items():
        if tables and extractor == "textract":
            amount += TABLES_SURCHARGE
        test = (F.col("extractor") == extractor) & (F.col("modality") == modality)
        price = F.when(test, F.lit(amount)).otherwise(price)
    return price


def document_costs(documents: DataFrame, tables: bool = False) -> DataFrame:
    """Adds ``cost`` from ``units`` (pages, images, minutes); hits are free."""
    cost = F.col("units") * price_per_unit(tables=tables)
    if "from_cache" in documents.columns:
        cost = F.when(F.coalesce(F.col("from_cache"), F.lit(False)), F.lit(0.0)).otherwise(cost)
    return documents.withColumn("cost", cost)


def extraction_cost(documents: DataFrame, tables: bool = False) -> DataFrame:
    """Documents, units and cost by extractor and modality, with subtotals."""
    return (
        document_costs(documents, tables)
        .rollup("extractor", "modality")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.sum("units").alias("units"),
            F.sum("cost").alias("cost"),
        )
    )


def retention_plan(
    objects: DataFrame, now: Column, rules: dict[str, int] = RETENTION_DAYS
) -> DataFrame:
    """Objects of (key, last_modified) older than their prefix allows.

    The longest prefix decides; without one the object is kept. The rules are
    a short literal chain, so an object list is only filtered.
    """
    days = F.lit(None).cast("int")
    for prefix in sorted(rules, key=len):
        days = F.when(F.col("key").startswith(prefix), F.lit(rules[prefix])).otherwise(days)
    return objects.withColumn("days_kept", days).filter(
        F.col("days_kept").isNotNull()
        & (F.col("last_modified") < now - F.make_dt_interval(F.col("days_kept")))
    )


def purge_plan(objects: DataFrame, prefixes: DataFrame, batch: int = DELETE_BATCH) -> DataFrame:
    """(prefix, batch_no, key): what to delete, ``batch`` keys at a time.

    A key is under a prefix if it starts with it, whatever the prefix ends in and
    however long it is. Keys meet prefixes by an equi-join on their beginnings, one
    for each length that a prefix has. Batches fill in the order of the key's hash.
    Keys are joined once and dealt in even ranges of (prefix, hash), so a prefix that
    holds nearly all keys is spread over all tasks.
    """
    wanted = prefixes.filter(F.col("prefix").isNotNull()).select("prefix").distinct()
    lengths = sorted(row[0] for row in wanted.select(F.length("prefix")).distinct().collect())
    beginnings = F.array_compact(
        F.array(*[F.when(F.length("key") >= n, F.substring("key", 1, n)) for n in lengths or [1]])
    )
    inside = objects.select("key", F.explode(beginnings).alias("prefix")).join(wanted, "prefix")
    hashed = inside.withColumn("_h", F.md5("key"))
    order = [F.col("_h"), F.col("key")]
    placed = position_in_group(stretches(hashed, ["prefix"], order), ["prefix"], order, F.col(STRETCH))
    return placed.select(
        "prefix", F.floor((F.col("position") - 1) / batch).cast("bigint").alias("batch_no"), "key"
    )
