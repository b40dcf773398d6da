"""Analyze: every result table of the report, and the listings with their cluster columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators import charts, cluster, corr, density, dist, features, groups, hypo, insights, outliers, profile, text
from marketloom.operators.ranks import column_ladder
from marketloom.schema import FEATURE_COLUMNS, NUMERIC_COLUMNS
from marketloom.session import cut_lineage


def statistics(df: DataFrame, columns: tuple[str, ...] = NUMERIC_COLUMNS) -> dict[str, DataFrame]:
    index = cut_lineage(column_ladder(df, columns))  # ordered once for all of them
    return {
        "dataset_profile": profile.dataset_profile(df),
        "central_tendency": profile.central_tendency(df, columns, index=index),
        "dispersion": profile.dispersion(df, columns, index),
        "shape": profile.shape(df, columns, index),
        "position": profile.position(df, columns, index),
        "normality": dist.normality_tests(df, columns, index),
        "normality_verdict": dist.normality_verdict(df, columns, index),
        "distribution_fitting": dist.fit_distributions(df),
        "qq_statistics": dist.qq_correlation(df, columns, index),
        "pearson": corr.pearson_matrix(df, columns),
        "spearman": corr.spearman_matrix(df, columns),
        "kendall": corr.kendall_matrix(df, columns),
        "partial_correlations": corr.partial_correlation(df, columns),
        "strong_correlations": corr.strong_correlations(df, columns),
        "anova": hypo.anova(df),
        "kruskal_wallis": hypo.kruskal(df),
        "mann_whitney_pairwise": hypo.mann_whitney_pairs(df),
        "levene": hypo.levene(df),
        "bartlett": hypo.bartlett(df),
        "fligner_killeen": hypo.fligner(df),
        "chi_square": hypo.chi_square(df),
        "outliers_iqr": outliers.outliers_iqr(df),
        "outliers_zscore": outliers.outliers_zscore(df),
        "outliers_mad": outliers.outliers_mad(df),
        "outliers_iforest": outliers.outliers_iforest(df),
        "outliers_lof": outliers.outliers_lof(df),
        "outliers_elliptic": outliers.outliers_elliptic(df),
    }


def clustered(df: DataFrame, key: str = "id") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Listings with features, four cluster labels, anomaly flag, PCA coordinates and segment, and the result tables."""
    names = list(FEATURE_COLUMNS)
    engineered = features.impute_median(features.engineer_features(df))
    matrix = cut_lineage(features.scale_features(engineered, names, key=key))
    choice = cluster.kmeans_select_k(matrix, names)
    k = choice.where("is_chosen").first()["k"]
    mixtures = cluster.gmm_select(matrix, names)
    parts = [
        cluster.kmeans_labels(matrix, names, k).select(key, F.col("cluster").alias("kmeans_cluster")),
        density.dbscan_labels(matrix, names, key=key),
        cluster.hierarchical_labels(matrix, names).select(key, "hier_cluster"),
        cluster.gmm_labels(matrix, names, mixtures.where("optimal_bic").first()["n_components"]).select(
            key, "gmm_cluster"
        ),
        cluster.pca_scores(matrix, names, 2)[0].select(key, "pca_1", "pca_2"),
    ]
    out = engineered
    for part in parts:
        out = out.join(part, key)
    out = cut_lineage(cluster.segment_names_join(out, "kmeans_cluster").withColumnRenamed("segment_name", "price_segment"))
    tables = {
        "kmeans_selection": choice,
        "gmm_selection": mixtures,
        "pca": cluster.pca(matrix, names, 2),
        "profile_numeric": cluster.cluster_profile_numeric(out, "kmeans_cluster"),
        "profile_categorical": cluster.cluster_profile_categorical(out, "kmeans_cluster"),
        "segments": cluster.segment_names(out, "kmeans_cluster"),
    }
    return out, tables


def report(df: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the report page."""
    return {
        "kpis": groups.kpi_summary(df),
        "category_report": groups.category_report(df),
        "count_bars": groups.count_bars(df),
        "hierarchy": groups.market_hierarchy(df),
        "dashboards": charts.dashboard_panels(df, ("executive", "category", "summary", "deep_dive")),
        "keywords": text.tfidf_keywords(df),
        "word_cloud": text.word_cloud(df),
        "insights": insights.insights(df),
    }


def status(df: DataFrame) -> DataFrame:
    """Totals and the per-category statistics of the store."""
    return groups.category_stats(df).withColumn("total_products", df.agg(F.count(F.lit(1))).scalar())
