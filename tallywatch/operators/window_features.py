"""Per-user measures over sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.config import WindowConfig
from tallywatch.functions.moments import sample_stddev, squared_deviation
from tallywatch.functions.sketches import distinct_estimate, distinct_sketch, merged_distincts
from tallywatch.functions.times import interval, micros_of

FEATURE_COLUMNS = (
    "window_start",
    "window_end",
    "user_id",
    "txn_count_1h",
    "total_amount_1h",
    "avg_amount_1h",
    "stddev_amount_1h",
    "max_amount_1h",
    "country_count_1h",
)


def direct_window_features(
    transactions: DataFrame, cfg: WindowConfig = WindowConfig(), approximate: bool = False
) -> DataFrame:
    """One grouped aggregate over ``window``; the form a stream can run.

    Distinct countries are kept as a set, which a stream accepts and which is
    bounded by the number of countries. ``approximate`` keeps a sketch in its
    place, whose size is bounded whatever the values are.
    """
    exact = F.size(F.collect_set("merchant_country")).cast("long")
    sketched = distinct_estimate(distinct_sketch(F.col("merchant_country")))
    grouped = transactions.groupBy(
        F.window("event_time", cfg.length, cfg.slide).alias("w"), "user_id"
    ).agg(
        F.count("transaction_id").alias("txn_count_1h"),
        F.sum("amount").alias("total_amount_1h"),
        F.avg("amount").alias("avg_amount_1h"),
        F.stddev_samp("amount").alias("stddev_amount_1h"),
        F.max("amount").alias("max_amount_1h"),
        (sketched if approximate else exact).alias("country_count_1h"),
    )
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *FEATURE_COLUMNS[2:]
    )


def window_features(
    transactions: DataFrame, cfg: WindowConfig = WindowConfig(), approximate: bool = False
) -> DataFrame:
    """The same measures for stored tables, without copying rows per window.

    Rows are first reduced to panes of one slide per user and country, and
    only panes are copied to the windows they belong to. Panes are then placed
    by user, so nothing after needs an exchange; a user's panes are bounded by
    the time span and the countries, however many rows the user has.

    A window's spread is that of its panes around the window mean, so the mean
    is attached to the panes before they are added up.

    With ``approximate`` a pane holds a sketch of its countries instead of a
    row for each; windows merge the sketches of their panes.
    """
    length, slide = micros_of(cfg.length), micros_of(cfg.slide)
    if length % slide:
        return direct_window_features(transactions, cfg, approximate)

    if approximate:
        keys, countries, order = ["user_id"], [distinct_sketch(F.col("merchant_country")).alias("countries")], "pane"
    else:
        keys, countries, order = ["user_id", "merchant_country"], [], "merchant_country"
    panes = (
        transactions.groupBy(F.window("event_time", cfg.slide).alias("w"), *keys)
        .agg(
            *countries,
            F.count("transaction_id").alias("rows"),
            F.count("amount").alias("n"),
            F.sum("amount").alias("s"),
            squared_deviation(F.col("amount")).alias("m2"),
            F.min("amount").alias("low"),
            F.max("amount").alias("high"),
        )
        .select(*keys, *(["countries"] if approximate else []), F.col("w.start").alias("pane"), "rows", "n", "s", "m2", "low", "high")
        .repartition("user_id")
    )
    first = F.col("pane") - interval(cfg.slide) * (length // slide - 1)
    copies = panes.withColumn("window_start", F.explode(F.sequence(first, "pane", interval(cfg.slide))))

    # One sort serves all that follows; of a window only its own panes are held, and no table of windows.
    in_order = Window.partitionBy("user_id", "window_start").orderBy(order)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if approximate:
        distinct = distinct_estimate(merged_distincts(F.col("countries")).over(whole))
    else:
        other = ~F.col("merchant_country").eqNullSafe(F.lag("merchant_country").over(in_order))
        copies = copies.withColumn("new_country", other & F.col("merchant_country").isNotNull())
        distinct = F.sum(F.col("new_country").cast("long")).over(whole)
    gap = F.try_divide(F.col("s"), F.col("n")) - F.col("mean")
    spread = (
        copies.withColumn("mean", F.try_divide(F.sum("s").over(whole), F.sum("n").over(whole)))
        .withColumn("m2", F.when(F.col("n") > 0, F.col("m2") + F.col("n") * gap * gap))
        .select(
            "user_id",
            "window_start",
            F.sum("rows").over(whole).alias("txn_count_1h"),
            F.sum("n").over(whole).alias("n"),
            F.sum("s").over(whole).alias("total_amount_1h"),
            F.sum("m2").over(whole).alias("m2"),
            F.min("low").over(whole).alias("low"),
            F.max("high").over(whole).alias("max_amount_1h"),
            distinct.alias("country_count_1h"),
            F.row_number().over(in_order).alias("place"),
        )
        .filter("place = 1")
    )
    # Equal amounts have no spread at all, not even a rounding error's worth.
    stddev = sample_stddev(F.col("n"), F.when(F.col("low") == F.col("max_amount_1h"), 0.0).otherwise(F.col("m2")))
    return spread.withColumns(
        {
            "window_end": F.col("window_start") + interval(cfg.length),
            "avg_amount_1h": F.try_divide(F.col("total_amount_1h"), F.col("n")),
            "stddev_amount_1h": stddev,
        }
    ).select(*FEATURE_COLUMNS)


def non_overlapping(windows: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """Only windows that start on a multiple of their length.

    Sliding windows count each transaction several times; totals over the
    kept windows count it once.
    """
    aligned = F.window("window_start", cfg.length)["start"]
    return windows.filter(F.col("window_start") == aligned)
