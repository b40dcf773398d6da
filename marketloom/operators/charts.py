"""The tables behind the report's charts; drawing is left to the reader."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators import groups as G
from marketloom.operators.lookup import lookup_join, settled
from marketloom.operators.ranks import quantile_table, usable

KDE_BINS = 512
KDE_GRID = 100


def _binned(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the highest value belongs to the last bin, a constant column to the first."""
    width = (high - low) / bins
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1))
    return F.when(high > low, place).otherwise(F.lit(0)).cast("int")


def histogram(df: DataFrame, value: Column | str = "price_min", bins: int = 40) -> DataFrame:
    """Counts in equal-width bins between the extremes, empty bins included; one bin for a constant column."""
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(value.cast("double").alias("v")).where(usable(F.col("v")))
    ends = rows.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    low, high = ends["low"], ends["high"]
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    used = bins if high > low else 1
    counted = rows.groupBy(_binned(F.col("v"), F.lit(low), F.lit(high), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    edge = lambda i: F.lit(low) + i * (F.lit(high) - F.lit(low)) / bins
    frame = df.sparkSession.range(used).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counted), "bin", "left").select(  # at most one row per bin
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def box_stats(df: DataFrame, value: str = "price_min", group: str = "category") -> DataFrame:
    """Quartiles, whiskers (extremes within 1.5 quartile ranges), mean, deviation and outliers per group."""
    rows = df.select(group, F.col(value).cast("double").alias("v"))
    rows = rows.where(usable(F.col("v")) & F.col(group).isNotNull())
    quartiles = settled(quantile_table(rows, "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group]).drop("n"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    boxes = (
        lookup_join(rows, quartiles, [group])
        .groupBy(group)
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return lookup_join(boxes, quartiles, [group])


def violin_density(
    df: DataFrame, value: str = "price_min", group: str = "category", bins: int = KDE_BINS, grid: int = KDE_GRID
) -> DataFrame:
    """Gaussian density per group on an even grid from its minimum to its maximum, Scott's bandwidth.

    Rows collapse to counts in ``bins`` bins first, so a grid point meets bins, not rows. Constant groups drop out.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    rows = rows.where(usable(F.col("v")) & F.col("g").isNotNull())
    spans = settled(
        rows.groupBy("g")
        .agg(
            F.min("v").alias("low"),
            F.max("v").alias("high"),
            F.count(F.lit(1)).cast("double").alias("n"),
            F.stddev_samp("v").alias("sd"),
        )
        .where(F.col("high") > F.col("low"))
    )
    counted = (
        lookup_join(rows, spans, ["g"], "inner")
        .withColumn("bin", _binned(F.col("v"), F.col("low"), F.col("high"), bins))
        .groupBy("g", "bin")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    points = spans.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    bandwidth = F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))
    at = F.col("low") + F.col("point") * (F.col("high") - F.col("low")) / (grid - 1)
    centre = F.col("low") + (F.col("bin") + 0.5) * (F.col("high") - F.col("low")) / bins
    z = (at - centre) / bandwidth
    kernel = F.exp(-z * z / 2) / (math.sqrt(2 * math.pi) * bandwidth)
    return (
        points.join(counted, "g")
        .groupBy("g", "point")
        .agg(F.max(at).alias("x"), F.sum(F.col("size") * kernel / F.col("n")).alias("density"))
        .withColumnRenamed("g", group)
    )


def _panel(df: DataFrame, panel: str, item: Column | str, value: Column | str) -> DataFrame:
    item = F.col(item) if isinstance(item, str) else item
    value = F.col(value) if isinstance(value, str) else value
    return df.select(F.lit(panel).alias("panel"), item.cast("string").alias("item"), value.cast("double").alias("value"))


def _verification(df: DataFrame) -> DataFrame:
    flag = F.when(F.col("supplier_verified"), "Verified").otherwise("Unverified")
    return G.value_counts(df.withColumn("flag", flag), "flag")


def _boxes(df: DataFrame, panel: str, k: int) -> DataFrame:
    """Five numbers per category, for the first k categories by name."""
    chosen = df.where(F.col("category").isNotNull()).select("category").distinct().orderBy("category").limit(k)
    # At most k names.
    boxes = box_stats(df.join(F.broadcast(chosen), "category", "left_semi"))
    names = ("whisker_low", "q1", "median", "q3", "whisker_high")
    long = boxes.unpivot(["category"], list(names), "part", "value")
    return _panel(long, panel, F.concat_ws("/", "category", "part"), "value")


def executive_dashboard(df: DataFrame) -> DataFrame:
    return G.union_batches(
        [
            _panel(histogram(df, "price_min", 30), "price_distribution", "bin", "count"),
            _panel(G.topk_by_count(df, "category", 6), "top_categories", "category", "count"),
            _panel(G.topk_by_count(df, "city", 8), "top_cities", "city", "count"),
            _boxes(df, "category_boxes", 5),
            _panel(_verification(df), "verification", "flag", "count"),
            _panel(G.topk_by_mean(df, "category", 8), "avg_price", "category", "avg_price"),
        ]
    )


def category_panels(df: DataFrame) -> DataFrame:
    dive = G.category_deep_dive(df, 10)
    return G.union_batches(
        [
            _panel(dive, "count", "category", "count"),
            _panel(dive, "avg_price", "category", "avg_min"),
            _panel(dive, "price_range", "category", "range"),
            _panel(dive, "volatility", "category", "std"),
        ]
    )


def summary_grid(df: DataFrame) -> DataFrame:
    scatter = G.price_scatter(df, 300)
    return G.union_batches(
        [
            _panel(histogram(df, "price_min", 35), "price_distribution", "bin", "count"),
            _panel(G.topk_by_count(df, "category", 10), "top_categories", "category", "count"),
            _panel(G.topk_by_count(df, "city", 10), "top_cities", "city", "count"),
            _panel(_verification(df), "verification", "flag", "count"),
            _boxes(df, "price_by_category", 8),
            _panel(scatter, "scatter_min", "id", "price_min"),
            _panel(scatter, "scatter_max", "id", "price_max"),
            _panel(histogram(df, F.log10(F.col("price_min") + 1), 35), "log_price", "bin", "count"),
            _panel(G.topk_by_mean(df, "category", 10), "avg_price", "category", "avg_price"),
            _panel(G.percentile_bars(df, "price_min", (10, 25, 50, 75, 90, 95)), "percentiles", "percentile", "value"),
        ]
    )


def deep_dive_panels(df: DataFrame) -> DataFrame:
    volume = G.volume_vs_price(df)
    density = violin_density(df)
    return G.union_batches(
        [
            _panel(density, "violin", F.concat_ws("/", "category", "point"), "density"),
            _panel(volume, "volume", "category", "count"),
            _panel(volume, "volume_price", "category", "avg_price"),
            _panel(G.category_spread(df), "spread", "category", "avg_spread"),
            _panel(G.category_volatility(df), "volatility", "category", "price_std"),
        ]
    )


def dashboard_panels(df: DataFrame, names: Sequence[str] = ("executive", "category")) -> DataFrame:
    """The chosen composites in one table (dashboard, panel, item, value)."""
    builders = {
        "executive": executive_dashboard,
        "category": category_panels,
        "summary": summary_grid,
        "deep_dive": deep_dive_panels,
    }
    return G.union_batches([builders[n](df).withColumn("dashboard", F.lit(n)) for n in names])
