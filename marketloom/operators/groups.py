"""Grouped reports, rankings and set operations over listings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import listing as L
from marketloom.operators.lookup import lookup_join, settled
from marketloom.operators.ranks import average_rank, exact_quantiles, value_ladder


def _share(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int"))


# --- per-category and per-supplier reports -----------------------------------------------------------------------


def category_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg("price_min"), 2).alias("avg_price"),
        F.min("price_min").alias("min_price"),
        F.max("price_max").alias("max_price"),
    )


def category_report(df: DataFrame) -> DataFrame:
    """Report table; its upper price is the highest *minimum* price, and is named so."""
    return (
        df.groupBy("category")
        .agg(
            F.count("product_name").alias("count"),
            F.avg("price_min").alias("avg_price"),
            F.min("price_min").alias("min_price"),
            F.max("price_min").alias("max_of_price_min"),
            _share("supplier_verified").alias("verified_share"),
        )
        .withColumn("badge", F.when(F.col("verified_share") > 0.5, "success").otherwise("warning"))
    )


def kpi_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Headline numbers; ``approximate`` swaps exact distinct counts for sketches."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    quality = F.avg("quality_score") * 100 if "quality_score" in df.columns else F.lit(95.0)
    return df.agg(
        F.count(F.lit(1)).alias("products"),
        distinct("category").alias("categories"),
        distinct("supplier_name").alias("suppliers"),
        distinct("city").alias("cities"),
        F.avg("price_min").alias("avg_price"),
        quality.alias("avg_quality_pct"),
    ).withColumn("avg_price_label", L.price_label(F.col("avg_price")))


def supplier_profile(df: DataFrame) -> DataFrame:
    """Per supplier: size, prices, rating, verified if any listing is, and its cities and categories.

    Rows are combined per (supplier, city, category) first, so the sets are collected from distinct names only.
    """
    cube = df.groupBy("supplier_name", "city", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price_min").alias("price_sum"),
        F.count("price_min").alias("price_n"),
        F.sum("supplier_rating").alias("rating_sum"),
        F.count("supplier_rating").alias("rating_n"),
        F.bool_or("supplier_verified").alias("verified"),
    )
    return cube.groupBy("supplier_name").agg(
        F.sum("n").alias("total_listings"),
        (F.sum("price_sum") / F.sum("price_n")).alias("avg_price"),
        F.array_sort(F.collect_set("city")).alias("cities"),
        F.array_sort(F.collect_set("category")).alias("categories"),
        F.bool_or("verified").alias("verified"),
        (F.sum("rating_sum") / F.sum("rating_n")).alias("avg_rating"),
    )


def _top_names(df: DataFrame, column: str, k: int, name: str) -> DataFrame:
    top = topk_per_group(df, "category", column, k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col("item"))))
    return top.groupBy("category").agg(F.transform(ordered, lambda s: s["item"]).alias(name))


def category_profile(df: DataFrame, k: int = 5) -> DataFrame:
    base = df.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_products"),
        F.avg("price_min").alias("avg_price"),
        F.min("price_min").alias("min_price"),
        F.max("price_max").alias("max_price"),
        F.stddev_samp("price_min").alias("price_std"),
    )
    return base.join(_top_names(df, "city", k, "top_cities"), "category", "left").join(
        _top_names(df, "supplier_name", k, "top_suppliers"), "category", "left"
    )


def analysis_summary(df: DataFrame) -> DataFrame:
    median = exact_quantiles(df, "price_min", [0.5]).select("quantile")
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("category").alias("categories_analyzed"),
        F.avg("price_min").alias("overall_avg_price"),
        F.min("price_min").alias("lowest_price"),
        F.max("price_max").alias("highest_price"),
        F.avg("quality_score").alias("avg_quality_score"),
        (_share("is_complete") * 100).alias("complete_records_pct"),
    ).withColumn("overall_median_price", median.scalar())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, first: str, second: str) -> DataFrame:
    """Contingency counts in long form; pairs with a missing side are left out."""
    return (
        df.where(F.col(first).isNotNull() & F.col(second).isNotNull())
        .groupBy(first, second)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def category_spread(df: DataFrame, k: int = 10) -> DataFrame:
    means = df.groupBy("category").agg(F.avg(F.col("price_max") - F.col("price_min")).alias("avg_spread"))
    return _top(means, "avg_spread", "category", k)


def category_volatility(df: DataFrame, k: int = 10) -> DataFrame:
    spread = df.groupBy("category").agg(F.stddev_samp("price_min").alias("price_std"))
    return _top(spread, "price_std", "category", k)


def category_deep_dive(df: DataFrame, k: int = 10) -> DataFrame:
    grouped = df.groupBy("category").agg(
        F.count("product_name").alias("count"),
        F.avg("price_min").alias("avg_min"),
        F.stddev_samp("price_min").alias("std"),
        F.avg("price_max").alias("avg_max"),
    )
    return _top(grouped.withColumn("range", F.col("avg_max") - F.col("avg_min")), "count", "category", k)


def volume_vs_price(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(
        F.count("product_name").alias("count"), F.avg("price_min").alias("avg_price")
    )


def market_hierarchy(df: DataFrame) -> DataFrame:
    """Category and city counts with their parents; the parent price is the mean over all its listings."""
    return (
        df.rollup("category", "city")
        .agg(
            F.count("product_name").alias("count"),
            F.avg("price_min").alias("avg_price"),
            F.grouping_id().cast("int").alias("gid"),
        )
        .select(
            "category",
            "city",
            F.when(F.col("gid") == 0, "city").when(F.col("gid") == 1, "category").otherwise("total").alias("level"),
            "count",
            "avg_price",
        )
    )


# --- rankings ------------------------------------------------------------------------------------------------------


def _top(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), F.asc(key)).limit(k)


def topk_by_count(df: DataFrame, column: str, k: int) -> DataFrame:
    """Most frequent values; ties in alphabetical order."""
    return _top(value_counts(df, column), "count", column, k)


def topk_by_mean(df: DataFrame, column: str, k: int | None, measure: str = "price_min") -> DataFrame:
    means = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.avg(measure).alias("avg_price"))
        .withColumn("label", L.bar_label(F.col("avg_price")))
    )
    return means if k is None else _top(means, "avg_price", column, k)


def topk_per_group(df: DataFrame, group: str, column: str, k: int = 3) -> DataFrame:
    """The k most frequent values inside each group, ranked over the counts rather than the rows."""
    counts = crosstab(df, group, column)
    ranked = Window.partitionBy(group).orderBy(F.desc("count"), F.asc(column))
    return (
        counts.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select(group, F.col(column).alias("item"), "count", "rank")
    )


def category_funnel(df: DataFrame, k: int = 8) -> DataFrame:
    top = topk_by_count(df, "category", k)
    # The window covers at most k rows.
    return top.withColumn("pct_of_first", F.col("count") * 100 / F.max("count").over(Window.partitionBy(F.lit(0))))


def price_waterfall(df: DataFrame, k: int = 8) -> DataFrame:
    """Mean price of the k dearest categories above the cheapest of them, and the running total."""
    top = topk_by_mean(df, "category", k).drop("label")
    # Both windows cover at most k rows.
    whole = Window.partitionBy(F.lit(0))
    running = whole.orderBy(F.desc("avg_price"), F.asc("category")).rowsBetween(Window.unboundedPreceding, 0)
    steps = top.withColumn("step", F.col("avg_price") - F.min("avg_price").over(whole))
    return steps.withColumn("running_total", F.sum("step").over(running))


def sample_rows(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """A repeatable sample of n rows: the rows with the lowest digests of their keys, the same in any engine."""
    return df.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(n)


def price_scatter(df: DataFrame, n: int = 600) -> DataFrame:
    """Sampled price pairs and the end point of the y = x reference line."""
    priced = df.where(F.col("price_min").isNotNull() & F.col("price_max").isNotNull())
    sample = sample_rows(priced, n).select("id", "price_min", "price_max")
    # The window covers the n sampled rows.
    top = F.max(F.greatest("price_min", "price_max")).over(Window.partitionBy(F.lit(0)))
    return sample.withColumn("reference_max", top)


# --- count bars and shares -------------------------------------------------------------------------------------------


def count_bars(df: DataFrame) -> DataFrame:
    """Bars and pies in one table (chart, item, count, share of all counted rows)."""

    def bars(chart: str, column: str, k: int | None) -> DataFrame:
        counts = value_counts(df, column).select(F.col(column).cast("string").alias("item"), "count")
        total = counts.agg(F.sum("count")).scalar()
        kept = counts if k is None else _top(counts, "count", "item", k)
        return kept.select(F.lit(chart).alias("chart"), "item", "count", (F.col("count") / total).alias("share"))

    df = df.withColumn("verification", F.when(F.col("supplier_verified"), "Verified").otherwise("Unverified"))
    return union_batches(
        [
            bars("categories", "category", 12),
            bars("cities", "city", 15),
            bars("suppliers", "supplier_name", 15),
            bars("verification", "verification", None),
        ]
    )


# --- lookups that stand in for joins -----------------------------------------------------------------------------------


def frequency_encode(df: DataFrame, columns: Sequence[str] = ("category", "city")) -> DataFrame:
    """Add ``<column>_frequency``: how often the row's value occurs."""
    for column in columns:
        counts = value_counts(df, column).withColumnRenamed("count", f"{column}_frequency")
        df = lookup_join(df, counts, [column])
    return df


def category_price_rank(df: DataFrame) -> DataFrame:
    """Average-tie rank of each category's mean price, ascending. The ladder runs over the category means."""
    means = settled(
        df.where(F.col("category").isNotNull()).groupBy("category").agg(F.avg("price_min").alias("avg_price"))
    )
    ladder = value_ladder(means, "avg_price").select(
        F.col("value").alias("avg_price"), average_rank().alias("category_price_rank")
    )
    return means.join(ladder, "avg_price", "left").select("category", "avg_price", "category_price_rank")


def supplier_flags(df: DataFrame) -> DataFrame:
    """First known verified flag per supplier, in key order; unknown counts as False."""
    first = F.min_by("supplier_verified", F.when(F.col("supplier_verified").isNotNull(), F.col("id")))
    return (
        df.where(F.col("supplier_name").isNotNull())
        .groupBy("supplier_name")
        .agg(F.coalesce(first, F.lit(False)).alias("verified"))
    )


def supplier_flag_lookup(df: DataFrame, k: int = 15) -> DataFrame:
    """Top suppliers by listings with their verified flag."""
    top = topk_by_count(df, "supplier_name", k)
    return lookup_join(top, supplier_flags(df).join(top.select("supplier_name"), "supplier_name"), ["supplier_name"])


# --- ranks -------------------------------------------------------------------------------------------------------------


def price_percentile(df: DataFrame, key: str = "id") -> DataFrame:
    """Average-tie rank of the price inside its category, over the category's priced rows."""
    ladder = value_ladder(df, "price_min", ["category"]).select(
        "category",
        F.col("value").alias("price_min"),
        (average_rank() / F.col("total")).alias("price_percentile"),
    )
    return df.join(ladder, ["category", "price_min"], "left")


# --- set operations and shape ----------------------------------------------------------------------------------------


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, batches)


def drop_nested(df: DataFrame) -> DataFrame:
    """Drop list, map and struct columns, by schema."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.drop(*[f.name for f in df.schema if isinstance(f.dataType, nested)])


def dedup_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and duplicates; missing values compare equal.

    Rows are grouped by a 256-bit digest, so long texts are not shuffled.
    """
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    copies = df.groupBy(F.sha2(row, 256)).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def percentile_bars(
    df: DataFrame, column: str = "price_min", percentiles: Sequence[int] = (5, 10, 25, 50, 75, 90, 95, 99)
) -> DataFrame:
    bars = exact_quantiles(df, column, [p / 100 for p in percentiles])
    return bars.select(
        F.concat(F.lit("P"), F.round(F.col("p") * 100).cast("int").cast("string")).alias("percentile"),
        F.col("quantile").alias("value"),
        L.bar_label(F.col("quantile")).alias("label"),
    )
