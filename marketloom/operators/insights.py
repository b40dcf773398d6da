"""Sentences drawn from the result tables, as rows (rule, severity, metric, value, text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators import cluster, corr, density, dist, features, hypo, mixtures, outliers, text
from marketloom.operators.groups import union_batches
from marketloom.schema import FEATURE_COLUMNS, NUMERIC_COLUMNS
from marketloom.session import cut_lineage


def insight(df: DataFrame, rule: str, severity: str, metric: Column, value: Column, sentence: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        metric.alias("metric"),
        value.cast("double").alias("value"),
        sentence.alias("text"),
    )


def normality_insight(df: DataFrame) -> DataFrame:
    verdict = dist.normality_verdict(df, ["price_min"]).where(~F.col("is_likely_normal"))
    sentence = F.lit("Price distribution fails normality tests - consider log transformation")
    return insight(verdict, "normality", "warning", F.col("column"), F.col("tests_passed"), sentence)


def best_fit_insight(df: DataFrame) -> DataFrame:
    best = dist.fit_distributions(df).where("is_best")
    sentence = F.format_string("Best fitting distribution: %s (AIC: %.2f)", "distribution", "aic")
    return insight(best, "best_fit", "info", F.col("distribution"), F.col("aic"), sentence)


def correlation_insights(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    pairs = corr.strong_correlations(df, columns)
    sentence = F.format_string("Strong %s correlation (%.2f) between %s and %s", "direction", "r", "column_a", "column_b")
    return insight(
        pairs, "strong_correlation", "info", F.concat_ws("/", "column_a", "column_b"), F.col("r"), sentence
    )


def anova_insight(df: DataFrame) -> DataFrame:
    significant = hypo.anova(df).where("is_significant")
    sentence = F.format_string(
        "ANOVA: Significant price differences across categories (F=%.2f, p<0.05, eta^2=%.3f)",
        "f_statistic",
        "eta_squared",
    )
    return insight(significant, "anova", "warning", F.lit("f_statistic"), F.col("f_statistic"), sentence)


def iforest_insight(df: DataFrame) -> DataFrame:
    found = outliers.outliers_iforest(df, contaminations=(0.10,))
    sentence = F.format_string("Isolation Forest (10%% contamination) detected %d outliers", "outlier_count")
    return insight(found, "isolation_forest", "warning", F.lit("outlier_count"), F.col("outlier_count"), sentence)


def keyword_insight(df: DataFrame) -> DataFrame:
    top = text.tfidf_keywords(df, k=5)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("term"))))
    named = top.agg(F.count(F.lit(1)).alias("n"), ordered.alias("terms")).where("n > 0")
    names = F.concat_ws(", ", F.transform("terms", lambda t: t["term"]))
    return insight(named, "keywords", "info", F.lit("terms"), F.col("n"), F.concat(F.lit("Top keywords: "), names))


def pattern_insights(df: DataFrame) -> DataFrame:
    """Dominant category, mean name length and quality words."""
    p = text.name_patterns(df)
    dominant = F.format_string("Dominant category: %s (%d products)", "dominant_category", "dominant_count")
    length = F.format_string("Average product name length: %.0f characters", "avg_name_length")
    words = text.quality_word_counts(df).where("word_set = 'quality'")
    quality = F.format_string("Quality-indicator products: %d (%.1f%%)", "hits", "hits_pct")
    return union_batches(
        [
            insight(p, "dominant_category", "info", F.col("dominant_category"), F.col("dominant_count"), dominant),
            insight(p, "name_length", "info", F.lit("avg_name_length"), F.col("avg_name_length"), length),
            insight(words, "quality_words", "info", F.lit("hits"), F.col("hits"), quality),
        ]
    )


def segment_insights(named: DataFrame) -> DataFrame:
    """From segment sizes (segment_name, size, share in percent)."""
    sentence = F.format_string("Segment '%s': %d products (%.1f%%)", "segment_name", "size", "percentage")
    return insight(named, "segment", "info", F.col("segment_name"), F.col("size"), sentence)


def _priced_matrix(df: DataFrame, key: str) -> DataFrame:
    """The scaled features of every listing, next to its key and its imputed price (``price``)."""
    engineered = features.impute_median(features.engineer_features(df))
    whole = engineered.withColumn("_row", F.struct(F.col(key).alias("key"), F.col("price_min").alias("price")))
    scaled = features.scale_features(whole, FEATURE_COLUMNS, key="_row")
    return cut_lineage(scaled.select(F.col("_row.key").alias(key), F.col("_row.price").alias("price"), *FEATURE_COLUMNS))


def kmeans_insights(matrix: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(the chosen k and the score of its clustering, the segments of its clusters), all from one selection."""
    scores, centres = cluster.kmeans_selection(matrix, columns)
    voted = lambda flag: F.max(F.when(F.col(flag), F.col("k")))
    choice = scores.agg(
        voted("is_chosen").alias("k"), voted("is_elbow").alias("elbow"), voted("is_best_silhouette").alias("silhouette"),
        voted("is_best_davies_bouldin").alias("davies"),
    )
    best = scores.where("is_chosen")
    k = best.first()["k"]
    optimal = F.format_string("Optimal clusters: %d (Elbow: %d, Silhouette: %d, DB: %d)", "k", "elbow", "silhouette", "davies")
    scored = F.format_string("K-Means clustering: %d clusters with silhouette score %.3f", "k", "silhouette")
    labelled = cluster.with_cluster(matrix, columns, centres[k], "cluster").select(F.col("price").alias("price_min"), "cluster")
    named = cut_lineage(cluster.segment_names(labelled).where(F.col("segment_name").isNotNull()))
    percentage = F.col("size") * 100 / F.lit(matrix.count())
    found = [
        insight(choice, "optimal_clusters", "info", F.lit("k"), F.col("k"), optimal),
        insight(best.where(F.col("silhouette").isNotNull()), "kmeans", "info", F.lit("silhouette"), F.col("silhouette"), scored),
    ]
    return union_batches(found), segment_insights(named.withColumn("percentage", percentage).orderBy("cluster"))


def dbscan_insight(matrix: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    counts = density.label_counts(density.dbscan_labels(matrix, columns, key=key))
    sentence = F.format_string("DBSCAN: %d clusters, %d noise points (%.1f%%)", "clusters", "noise", F.col("noise") * 100 / F.col("n"))
    return insight(counts, "dbscan", "info", F.lit("n_noise_points"), F.col("noise"), sentence)


def hierarchical_insight(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    scored = cluster.hierarchical_cluster(matrix, columns).where(F.col("silhouette").isNotNull())
    sentence = F.format_string("Hierarchical clustering: %d clusters, silhouette %.3f", "n_clusters", "silhouette")
    return insight(scored, "hierarchical", "info", F.lit("silhouette"), F.col("silhouette"), sentence)


def gmm_insight(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mean confidence under the mixture of lowest BIC, as it was fitted for the selection."""
    scores, fits = cluster.gmm_selection(matrix, columns)
    best = scores.where("optimal_bic")
    chosen = best.first()
    labelled = mixtures.labelled(matrix.select(*columns), columns, fits, chosen["n_components"] if chosen else 0)
    confidence = best.crossJoin(F.broadcast(labelled.agg(F.avg("confidence").alias("confidence"))))
    sentence = F.format_string("GMM: %d components, avg confidence %.3f", "n_components", "confidence")
    return insight(confidence, "gmm", "info", F.lit("avg_confidence"), F.col("confidence"), sentence)


def pca_insight(matrix: DataFrame, columns: Sequence[str], k: int = 2) -> DataFrame:
    """The variance of the first ``k`` components, and how many of all components reach 95 %."""
    kept = cluster.pca(matrix, columns, len(columns)).where(F.col("component") == k)
    sentence = F.format_string(
        "PCA: %d components explain 95%% variance, %d explain %.1f%%",
        "components_for_95_pct", "component", F.col("cumulative_variance") * 100,
    )
    return insight(kept, "pca", "info", F.lit("components_for_95_pct"), F.col("components_for_95_pct"), sentence)


def clustering_insights(df: DataFrame, key: str = "id") -> DataFrame:
    """What every clustering of the listings' features found, and their principal components; the features are made once."""
    matrix, names = _priced_matrix(df, key), list(FEATURE_COLUMNS)
    if matrix.isEmpty():
        return insight(df.limit(0), "clustering", "info", F.lit(""), F.lit(0), F.lit(""))
    clusters, segments = kmeans_insights(matrix, names)
    return union_batches(
        [
            clusters,
            dbscan_insight(matrix, names, key),
            hierarchical_insight(matrix, names),
            gmm_insight(matrix, names),
            pca_insight(matrix, names),
            segments,
        ]
    )


PRODUCERS = {
    "normality": normality_insight,
    "best_fit": best_fit_insight,
    "correlation": correlation_insights,
    "anova": anova_insight,
    "isolation_forest": iforest_insight,
    "clustering": clustering_insights,
    "keywords": keyword_insight,
    "patterns": pattern_insights,
}


def insights(df: DataFrame, names: Sequence[str] = tuple(PRODUCERS)) -> DataFrame:
    return union_batches([PRODUCERS[name](df) for name in names])
