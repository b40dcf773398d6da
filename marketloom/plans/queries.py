"""Registered queries: every operator over the whole given tables.

Aggregates whose last digits depend on summation order are rounded here, for comparison with another engine; operators
themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import listing as L
from marketloom.operators import (
    charts,
    cluster,
    corr,
    density,
    dist,
    features,
    groups,
    hypo,
    ingest,
    insights,
    mixtures,
    outliers,
    profile,
    ranks,
    text,
)
from marketloom.operators.lookup import bounded_local
from marketloom.schema import FEATURE_COLUMNS, NUMERIC_COLUMNS
from marketloom.session import cut_lineage
from marketloom.sources import pages, store
from marketloom.sources.driver_tables import document_listings, listing_index, listings, table

Query = Callable[[SparkSession, str], DataFrame]
STAMP = "yyyy-MM-dd HH:mm:ss"
QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _register(name: str, build: Query) -> None:
    QUERIES[name] = build


def on_listings(name: str, build: Callable[[DataFrame], DataFrame], **digits: int) -> None:
    _register(name, lambda spark, sf: rounded(build(listings(spark, sf)), **digits))


def on_ranks(name: str, build: Callable[[DataFrame, DataFrame], DataFrame], **digits: int) -> None:
    """A query on the listings and the stored order statistics of their numeric columns."""
    _register(name, lambda spark, sf: rounded(build(listings(spark, sf), listing_index(spark, sf)), **digits))


def on_table(name: str, source: str, build: Callable[[DataFrame], DataFrame], **digits: int) -> None:
    _register(name, lambda spark, sf: rounded(build(table(spark, sf, source)), **digits))


def labelled(df: DataFrame) -> DataFrame:
    """Listings with a fixed ``cluster``: the price in thousands, at most 9; very high prices are noise."""
    bucket = F.least(F.floor(F.col("price_min") / 1000), F.lit(9))
    return df.withColumn("cluster", F.when(F.col("price_min") > 50000, -1).otherwise(bucket).cast("long"))


def matrix(df: DataFrame) -> DataFrame:
    return cut_lineage(features.feature_matrix(df))


def embedding_matrix(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Embedding elements as columns."""
    width = 64
    names = [f"e{i}" for i in range(width)]
    wide = df.select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return wide, names


# --- sources, ingestion ------------------------------------------------------------------------------------------------

on_listings(
    "scan_listings",
    lambda df: store.scan_listings(df).withColumns(
        {"n_tags": F.size("tags"), "tags": L.tags_text(F.col("tags")), "scraped_at": F.date_format("scraped_at", STAMP)}
    ),
)
on_listings(
    "listings_by_category",
    lambda df: store.listings_by_category(df, "PROMO").select("id", "product_name", "category", "price_min"),
)
_register("ingest_audit", lambda spark, sf: ingest.ingest_audit(document_listings(spark, sf), "category"))
on_listings(
    "normalize_raw_csv",
    lambda df: ingest.normalize_raw(
        df.select(
            "product_name",
            F.col("price_raw").alias("price_info"),
            "supplier_name",
            F.col("city").alias("location"),
            "source_url",
            F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )
    )
    .drop("category")
    .withColumn("scraped_at", F.date_format("scraped_at", STAMP)),
)
on_table("extract_page_fields", "pages", pages.extract_page_fields)
on_table("drop_nested", "embeddings", groups.drop_nested)


def _union_batches(df: DataFrame) -> DataFrame:
    rows = df.select("id", "category", "price_min")
    flag = F.coalesce(F.col("category") == "PROMO", F.lit(False))
    return groups.union_batches([rows.where(flag), rows.where(~flag)])


on_listings("union_batches", _union_batches)


def _stored_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Append all listings to a new partitioned table in the shared folder and read one category back from it."""
    from uuid import uuid4

    from marketloom.session import shared_folder

    path = f"{shared_folder(spark)}/store-{uuid4().hex}"
    store.append_listings(listings(spark, sf), path)
    stored = store.scan_listings(store.read_table(spark, path))
    return stored.groupBy("category").agg(
        F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id"), F.max(F.size("tags")).alias("most_tags")
    )


_register("append_listings", _stored_round_trip)


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Listings as CSV, read back, a table replaced by them twice, one category appended again, and the table read."""
    from uuid import uuid4

    from marketloom.session import shared_folder

    folder = f"{shared_folder(spark)}/csv-{uuid4().hex}"
    store.write_csv(listings(spark, sf), f"{folder}/csv")
    read = store.read_csv(spark, f"{folder}/csv")
    store.replace_listings(read.where("category = 'PROMO'"), f"{folder}/table")
    store.replace_listings(read, f"{folder}/table")
    store.append_listings(read.where("category = 'PROMO'"), f"{folder}/table")
    stored = store.load_listings(spark, f"{folder}/table", f"{folder}/csv")
    return stored.groupBy("category").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("description").alias("described"),
        F.min("product_name").alias("first_name"),
        F.round(F.sum("price_min"), 2).alias("total_min"),
    )


_register("csv_round_trip", _csv_round_trip)

# --- fields, validation ----------------------------------------------------------------------------------------------------

on_table("clean_name", "documents", lambda df: df.select("doc_id", L.clean_name(F.col("text")).alias("name")))
on_listings(
    "parse_price_range", lambda df: df.select("id", L.price_bounds(F.col("price_raw")).alias("p")).select("id", "p.*")
)
_register(
    "validate_listings",
    lambda spark, sf: ingest.validate_listings(ingest.with_defaults(document_listings(spark, sf))).select(
        "id", "is_valid", F.concat_ws(",", "reject_reasons").alias("reject_reasons")
    ),
)
on_listings("quality_score", lambda df: df.select("id", L.quality_score().alias("quality_score")))
on_listings("is_complete", lambda df: df.select("id", L.is_complete().alias("is_complete")))
on_listings(
    "category_label",
    lambda df: df.select(
        "id", L.category_label(F.lower(F.concat_ws("-", "category", "product_name"))).alias("label")
    ),
)
on_listings(
    "coerce_types",
    lambda df: ingest.coerce_types(
        df.select(
            "id",
            F.col("price_min").cast("string").alias("price_min"),
            F.col("price_raw").alias("price_max"),
            "quality_score",
            "supplier_rating",
            F.when(F.col("supplier_verified"), "true").alias("supplier_verified"),
        )
    ),
)


def _city_state(spark: SparkSession, sf: str) -> DataFrame:
    """Cities of one region are left out of the dictionary and get the default state."""
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    known = nations.where(F.col("r_name") != "ASIA").select("n_name", "r_name")
    df = ingest.city_state_lookup(listings(spark, sf), known)
    return df.select("id", "city", "looked_up_state")


_register("city_state_lookup", _city_state)
on_listings(
    "price_label",
    lambda df: df.groupBy("supplier_name")
    .agg(F.avg("price_min").alias("p"))
    .select("supplier_name", L.price_label(F.col("p")).alias("label"), L.bar_label(F.col("p")).alias("bar_label")),
)

# --- lookups -----------------------------------------------------------------------------------------------------------------

on_listings(
    "frequency_encode",
    lambda df: groups.frequency_encode(df).select("id", "category_frequency", "city_frequency"),
)
on_listings(
    "segment_names_join", lambda df: cluster.segment_names_join(labelled(df)).select("id", "cluster", "segment_name")
)
on_listings("supplier_flag_lookup", groups.supplier_flag_lookup)

# --- aggregations ------------------------------------------------------------------------------------------------------------

on_listings("category_stats", groups.category_stats)
on_listings("category_report", groups.category_report, avg_price=4, verified_share=6)
on_listings("kpi_summary", groups.kpi_summary, avg_price=4, avg_quality_pct=6)
on_listings(
    "supplier_profile",
    lambda df: groups.supplier_profile(df).withColumns(
        {c: F.concat_ws(",", c) for c in ("cities", "categories")}
    ),
    avg_price=4,
    avg_rating=6,
)
on_listings(
    "category_profile",
    lambda df: groups.category_profile(df).withColumns(
        {c: F.concat_ws(",", c) for c in ("top_cities", "top_suppliers")}
    ),
    avg_price=4,
    price_std=4,
)
on_listings(
    "analysis_summary",
    groups.analysis_summary,
    overall_avg_price=4,
    overall_median_price=6,
    avg_quality_score=6,
    complete_records_pct=6,
)
on_listings("dataset_profile", profile.dataset_profile)
on_ranks(
    "central_tendency",
    lambda df, index: profile.central_tendency(df, NUMERIC_COLUMNS, index=index).drop("n"),
    mean=4,
    median=6,
    trimmed_mean_10=4,
    trimmed_mean_20=4,
    geometric_mean=4,
    harmonic_mean=4,
    weighted_mean=4,
)
on_ranks(
    "dispersion",
    lambda df, index: profile.dispersion(df, NUMERIC_COLUMNS, index=index),
    variance=2,
    std_dev=4,
    std_error=6,
    range=6,
    iqr=6,
    mad=6,
    coefficient_of_variation=4,
    quartile_deviation=6,
    range_to_mean_ratio=6,
)
on_ranks("shape", lambda df, index: profile.shape(df, NUMERIC_COLUMNS, index=index), skewness=6, kurtosis=5, bowley_skewness=6)
on_ranks(
    "position",
    lambda df, index: profile.position(df, NUMERIC_COLUMNS, index=index),
    **{f"p{p}": 6 for p in (1, 5, 10, 25, 50, 75, 90, 95, 99)},
    **{f"d{d}": 6 for d in range(1, 10)},
)
on_listings("value_counts", lambda df: groups.value_counts(df, "city"))
on_listings("crosstab_verified", lambda df: groups.crosstab(df, "category", "supplier_verified"))
on_listings("category_spread", groups.category_spread, avg_spread=4)
on_listings("category_volatility", groups.category_volatility, price_std=4)
on_listings("category_deep_dive", groups.category_deep_dive, avg_min=4, std=4, avg_max=4, range=4)

# --- ranks, top-k, sets ------------------------------------------------------------------------------------------------------

on_ranks(
    "global_rank",
    lambda df, index: ranks.column_ladder(df, ["price_min"], index).select("value", "ties", ranks.average_rank().alias("avg_rank")),
)
on_listings("price_percentile", lambda df: groups.price_percentile(df).select("id", "category", "price_percentile"))
on_listings("category_price_rank", groups.category_price_rank, avg_price=4)
on_listings("price_waterfall", groups.price_waterfall, avg_price=4, step=4, running_total=4)
on_listings("topk_by_count", lambda df: groups.topk_by_count(df, "city", 15))
on_listings("topk_by_mean", lambda df: groups.topk_by_mean(df, "city", 15).drop("label"), avg_price=4)
on_listings("sample_rows", lambda df: groups.sample_rows(df, 1000).select("id", "price_min", "price_max"))
on_listings("topk_per_group", lambda df: groups.topk_per_group(labelled(df), "cluster", "category", 3))
on_table("dedup_count", "documents", lambda df: groups.dedup_count(df.select("text", "lang")))

# --- distributions -------------------------------------------------------------------------------------------------------------

on_table(
    "normality_shapiro",
    "supplier",
    lambda df: dist.normality_shapiro(df, ["s_acctbal"]).select("column", "test", "statistic"),
    statistic=6,
)
on_listings("normality_dagostino", lambda df: dist.normality_dagostino(df, NUMERIC_COLUMNS), statistic=2, p_value=6)
on_listings("normality_jarque_bera", lambda df: dist.normality_jarque_bera(df, NUMERIC_COLUMNS), statistic=2, p_value=6)
on_ranks(
    "normality_ks",
    lambda df, index: dist.normality_ks(df, NUMERIC_COLUMNS, index=index),
    statistic=6,
    p_value=6,
)
on_table("normality_ks_exact", "supplier", lambda df: dist.normality_ks(df, ["s_acctbal"]), statistic=6, p_value=6)
on_ranks(
    "normality_anderson",
    lambda df, index: dist.normality_anderson(df, NUMERIC_COLUMNS, index=index).select("column", "test", "statistic", "is_normal"),
    statistic=2,
)
on_ranks("normality_verdict", lambda df, index: dist.normality_verdict(df, ["price_min", "price_max"], index=index))
on_listings(
    "fit_distributions",
    lambda df: dist.fit_distributions(df, names=("norm", "lognorm", "expon"), free=False).select(
        "distribution", "n_params", "log_likelihood", "aic", "bic", "ks_statistic", "is_best"
    ),
    log_likelihood=2,
    aic=2,
    bic=2,
    ks_statistic=6,
)
on_listings(
    "fit_free_location",
    lambda df: dist.fit_distributions(df, names=("norm", "lognorm", "expon", "gamma", "weibull_min")).select(
        "distribution", "n_params", "log_likelihood", "aic", "bic", "is_best"
    ),
    log_likelihood=2,
    aic=2,
    bic=2,
)
on_listings("fit_all_distributions", dist.fit_distributions)
on_ranks("qq_correlation", lambda df, index: dist.qq_correlation(df, NUMERIC_COLUMNS, index=index), qq_correlation=6)

# --- correlation ---------------------------------------------------------------------------------------------------------------

on_listings("pearson_matrix", lambda df: corr.pearson_matrix(df, NUMERIC_COLUMNS), r=6, p_value=6)
on_listings("spearman_matrix", lambda df: corr.spearman_matrix(df, NUMERIC_COLUMNS), rho=6)
on_listings("kendall_matrix", lambda df: corr.kendall_pairs(df, ["supplier_rating", "quality_score"]), tau=6)
on_listings("kendall_sampled", lambda df: corr.kendall_matrix(groups.sample_rows(df, 1000), NUMERIC_COLUMNS), tau=6)
on_table("kendall_customers", "customer", lambda df: corr.kendall_pairs(df, ["c_acctbal", "c_nationkey", "c_custkey"]), tau=9)
on_listings("partial_correlation", lambda df: corr.partial_correlation(df, NUMERIC_COLUMNS), partial_r=6)
on_listings("strong_correlations", lambda df: corr.strong_correlations(df, NUMERIC_COLUMNS), r=6)

# --- tests across groups ---------------------------------------------------------------------------------------------------------

on_listings(
    "anova",
    hypo.anova,
    f_statistic=4,
    p_value=6,
    eta_squared=8,
    omega_squared=8,
)
on_listings("kruskal", hypo.kruskal, h_statistic=4, p_value=6)
on_listings("mann_whitney_pairs", lambda df: hypo.mann_whitney_pairs(df).drop("is_significant"), p_value=6)
on_table(
    "mann_whitney_small",
    "supplier",
    lambda df: hypo.mann_whitney_pairs(
        df.withColumn("nation", F.col("s_nationkey").cast("string")), "s_acctbal", "nation"
    ).drop("is_significant"),
    p_value=6,
)
on_listings("levene", hypo.levene, statistic=4, p_value=6)
on_listings("bartlett", hypo.bartlett, statistic=4, p_value=6)
on_listings("fligner", hypo.fligner, statistic=4, p_value=6)
on_listings(
    "chi_square",
    hypo.chi_square,
    chi2_statistic=6,
    p_value=6,
    cramers_v=8,
)

# --- outliers --------------------------------------------------------------------------------------------------------------------

on_listings(
    "outliers_iqr",
    outliers.outliers_iqr,
    q1=6,
    q3=6,
    iqr=6,
    lower_bound=6,
    upper_bound=6,
    outlier_percentage=6,
)
on_listings("outliers_zscore", outliers.outliers_zscore, percentage_2sigma=6, percentage_3sigma=6)
on_listings("outliers_mad", outliers.outliers_mad, median=6, mad=6, outlier_percentage=6)
on_listings("outliers_iforest", outliers.outliers_iforest)
on_listings("outliers_iforest_2d", lambda df: outliers.outliers_iforest(df, ("price_min", "price_max")))
on_listings("outliers_lof", outliers.outliers_lof)
on_table("lof_balances", "supplier", lambda df: outliers.lof_factors(df, "s_acctbal"), lof=6)
on_listings("outliers_elliptic", outliers.outliers_elliptic)
on_listings("robust_reweighting", lambda df: outliers.robust_reweighting(df).withColumn("value", F.round(F.col("value"), 3)))
on_listings("outlier_comparison", outliers.outlier_comparison, average_outliers=4)
on_listings("anomaly_flags", outliers.anomaly_flags)

# --- features, clustering ----------------------------------------------------------------------------------------------------------

on_listings(
    "engineer_features",
    lambda df: features.engineer_features(df).select("id", *FEATURE_COLUMNS),
    log_price_min=8,
    log_price_max=8,
)


def _imputed(df: DataFrame) -> DataFrame:
    gapped = df.select(
        "id",
        F.when(F.col("supplier_rating") > 0, F.col("price_min")).alias("price_min"),
        F.when(F.col("description").isNotNull(), F.col("price_max")).alias("price_max"),
    )
    return features.impute_median(gapped, ("price_min", "price_max"))


on_listings("impute_median", _imputed)


def _scaled(df: DataFrame) -> DataFrame:
    columns = ("price_min", "supplier_rating")
    parts = [
        features.scale_features(df, columns, method).withColumn("method", F.lit(method))
        for method in ("standard", "minmax", "robust")
    ]
    return groups.union_batches(parts)


on_listings("scale_features", _scaled, price_min=6, supplier_rating=6)
on_listings("kmeans_select_k", lambda df: cluster.kmeans_select_k(matrix(df), FEATURE_COLUMNS))
on_listings("kmeans_fit", lambda df: cluster.kmeans_fit(matrix(df), FEATURE_COLUMNS))


def _kmeans_embeddings(df: DataFrame) -> DataFrame:
    wide, names = embedding_matrix(df)
    return cluster.kmeans_fit(wide, names, 5)


def _scaled_prices(df: DataFrame) -> DataFrame:
    """Both prices, scaled, with the place of the row's category in name order."""
    scaled = cut_lineage(features.scale_features(df, ("price_min", "price_max")))
    names = [r["category"] for r in df.select("category").distinct().orderBy("category").collect()]  # six
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("category")).cast("int")
    return cut_lineage(scaled.join(df.select("id", place.alias("place")), "id"))


on_listings(
    "kmeans_rounds",
    lambda df: cluster.kmeans_rounds(_scaled_prices(df), ["price_min", "price_max"]),
    cost=4,
    price_min=6,
    price_max=6,
)
on_listings(
    "mixture_scores",
    lambda df: mixtures.from_labels(_scaled_prices(df), ["price_min", "price_max"], "place"),
    log_likelihood=2,
    bic=2,
    aic=2,
)
on_table("kmeans_embeddings", "embeddings", _kmeans_embeddings)
on_listings(
    "cluster_metrics",
    lambda df: cluster.cluster_metrics(
        labelled(df).select("price_min", "price_max", "cluster"), ["price_min", "price_max"], "cluster"
    ).withColumn("inertia", F.col("inertia") / 1e6),
    inertia=2,
    silhouette=6,
    calinski_harabasz=3,
    davies_bouldin=6,
)
on_listings("kdistance_eps", lambda df: density.kdistance_eps(matrix(df), FEATURE_COLUMNS))
on_listings("dbscan", lambda df: density.dbscan(matrix(df), FEATURE_COLUMNS))
on_table(
    "dbscan_balances",
    "customer",
    # Balances are in cents; half a cent keeps distances off the limit.
    lambda df: density.dbscan_labels(df.withColumnRenamed("c_custkey", "id"), ["c_acctbal"], 5.005),
)
on_table(
    "kdistance_customers",
    "customer",
    lambda df: density.kdistance_eps(df.select("c_custkey", "c_acctbal", "c_nationkey"), ["c_acctbal", "c_nationkey"], key="c_custkey"),
    optimal_eps=6,
)
on_table(
    "kdistance_balances",
    "supplier",
    lambda df: density.kdistance_eps(df.withColumnRenamed("s_suppkey", "id"), ["s_acctbal"]),
    optimal_eps=6,
)
on_listings("hierarchical_cluster", lambda df: cluster.hierarchical_cluster(matrix(df), FEATURE_COLUMNS))
on_listings("gmm_select", lambda df: cluster.gmm_select(matrix(df), FEATURE_COLUMNS))
on_listings("gmm_fit", lambda df: cluster.gmm_fit(matrix(df), FEATURE_COLUMNS))
on_listings(
    "pca",
    lambda df: cluster.pca(
        features.scale_features(df, ("price_min", "price_max")), ("price_min", "price_max")
    ),
    explained_variance=6,
    cumulative_variance=6,
)
on_listings("pca_features", lambda df: cluster.pca(matrix(df), FEATURE_COLUMNS))
on_listings(
    "cluster_profile_numeric",
    lambda df: cluster.cluster_profile_numeric(labelled(df)),
    percentage=6,
    mean=4,
    median=6,
    std=4,
)
on_listings(
    "cluster_profile_categorical",
    lambda df: cluster.cluster_profile_categorical(labelled(df)),
    verified_percentage=6,
)
on_listings("segment_names", lambda df: cluster.segment_names(labelled(df)), avg_price=4)

# --- text ------------------------------------------------------------------------------------------------------------------------------

on_table("tfidf_keywords", "documents", lambda df: text.tfidf_keywords(df, "text", "doc_id"), score=8)
on_listings("tfidf_titles", text.tfidf_keywords, score=8)
on_listings("name_patterns", text.name_patterns, avg_name_length=6)
on_table("quality_word_counts", "documents", lambda df: text.quality_word_counts(df, "text"), hits_pct=6)
on_table("word_frequencies", "documents", lambda df: text.word_frequencies(df, "text"), weight=8)

on_table("word_cloud", "documents", lambda df: text.word_cloud(df, "text"), weight=8)
on_listings("word_cloud_titles", text.word_cloud, weight=8)

# --- chart tables ----------------------------------------------------------------------------------------------------------------------

on_listings("histogram", charts.histogram)
on_listings("histogram_log", lambda df: charts.histogram(df, L.log10_price(F.col("price_min"))).select("bin", "count"))
on_listings("histogram_spread", lambda df: charts.histogram(df, F.col("price_max") - F.col("price_min")))
on_listings("histogram_quality", lambda df: charts.histogram(df, "quality_score", 30))
on_listings("percentile_bars", lambda df: groups.percentile_bars(df).drop("label"), value=6)
on_listings("price_scatter", groups.price_scatter)
on_listings("box_stats", charts.box_stats, q1=6, median=6, q3=6, mean=4, std=4)
on_listings(
    "violin_density",
    lambda df: charts.violin_density(df).withColumn("density", F.col("density") * 1e9),
    x=6,
    density=3,
)
on_listings("count_bars", groups.count_bars, share=8)
on_listings("market_hierarchy", groups.market_hierarchy, avg_price=4)
on_listings("category_funnel", groups.category_funnel, pct_of_first=6)
on_listings("correlation_heatmap", lambda df: corr.correlation_heatmap(df, NUMERIC_COLUMNS))
on_listings("dashboard_panels", lambda df: charts.dashboard_panels(df, ("executive", "category")), value=6)
on_listings("dashboard_summary", lambda df: charts.dashboard_panels(df, ("summary", "deep_dive")))
on_listings("volume_vs_price", groups.volume_vs_price, avg_price=4)
on_listings("insights", insights.insights)
on_listings("insights_patterns", lambda df: insights.insights(df, ("correlation", "patterns")), value=6)
