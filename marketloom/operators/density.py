"""Density clustering: neighbour distances, and DBSCAN on a grid."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.cluster import cluster_metrics
from marketloom.operators.components import connected_components
from marketloom.operators.lookup import lookup_join, spread
from marketloom.operators.neighbours import k_distances, knee
from marketloom.operators.ranks import row_positions
from marketloom.session import cut_lineage


def find_eps(matrix: DataFrame, columns: Sequence[str], k: int = 5, key: str = "id") -> float:
    return knee(k_distances(matrix, columns, k, key))[0]


def kdistance_eps(matrix: DataFrame, columns: Sequence[str], k: int = 5, key: str = "id") -> DataFrame:
    eps, at = knee(k_distances(matrix, columns, k, key))
    return matrix.sparkSession.createDataFrame(
        [(k, eps, at)], "k_neighbors int, optimal_eps double, knee_index int"
    )


# --- DBSCAN --------------------------------------------------------------------------------------------------------------
#
# The space is cut into cells whose diagonal is eps, so all points of a cell are neighbours. A cell with min_samples
# points therefore needs no pair of points to be compared: all of them are core points of one cluster. Points are looked
# at singly only in thinly filled cells, and cells are compared by their bounding boxes and one representative before
# any of their points are.

COARSE_DIMS = 3


def _square(parts) -> Column:
    return reduce(Column.__add__, [p * p for p in parts])


def _box_gap(a: str, b: str, d: int) -> Column:
    """Squared smallest distance between the boxes a and b (a point is a box with lo = hi)."""
    lo, hi = (lambda s, j: F.col(f"{s}lo{j}")), (lambda s, j: F.col(f"{s}hi{j}"))
    return _square(F.greatest(lo(b, j) - hi(a, j), lo(a, j) - hi(b, j), F.lit(0.0)) for j in range(d))


def _box_reach(a: str, b: str, d: int) -> Column:
    """Squared largest distance between points of the boxes a and b."""
    lo, hi = (lambda s, j: F.col(f"{s}lo{j}")), (lambda s, j: F.col(f"{s}hi{j}"))
    return _square(F.greatest(hi(b, j) - lo(a, j), hi(a, j) - lo(b, j)) for j in range(d))


def _point_gap(a: str, b: str, d: int) -> Column:
    return _square(F.col(f"{a}x{j}") - F.col(f"{b}x{j}") for j in range(d))


def _sided(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}{c}") for c in df.columns])


def _coarse_keys(cells: DataFrame, d: int) -> list[Column]:
    """Coarse coordinates of a few dimensions in which the cells lie furthest apart.

    Cells that hold points within eps differ by at most ceil(sqrt(d)) steps, so by at most one coarse step.
    """
    step = int(np.ceil(np.sqrt(d)))
    coarse = [F.floor(F.col(f"c{j}") / step) for j in range(d)]
    kinds = cells.agg(*[F.approx_count_distinct(c).alias(f"{j}") for j, c in enumerate(coarse)]).first()
    widest = sorted(range(d), key=lambda j: -kinds[f"{j}"])[:COARSE_DIMS]
    return [coarse[j] for j in widest]


def _near_cells(cells: DataFrame, d: int, limit: float) -> DataFrame:
    """Pairs a < b of cells whose boxes are within eps, and whether all their points are (``whole``)."""
    keys = _coarse_keys(cells, d)
    boxes = [f"{side}{j}" for side in ("lo", "hi") for j in range(d)]
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    left = spread(cells).select(F.col("cell").alias("a"), *boxes, *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    for i in range(len(keys)):
        left = left.withColumn("_step", F.explode(steps)).withColumn(f"k{i}", F.col(f"k{i}") + F.col("_step"))
    left = left.drop("_step").withColumnsRenamed({c: f"a_{c}" for c in boxes})
    right = cells.select(F.col("cell").alias("b"), *boxes, *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    right = right.withColumnsRenamed({c: f"b_{c}" for c in boxes})
    return (
        left.join(right, [f"k{i}" for i in range(len(keys))])
        .where((F.col("a") < F.col("b")) & (_box_gap("a_", "b_", d) <= limit))
        .select("a", "b", (_box_reach("a_", "b_", d) <= limit).alias("whole"))
    )


def _grid(matrix: DataFrame, names: Sequence[str], key: str, eps: float, min_samples: int):
    """(rows, cells): every row with the id of its cell, and the cells with box, size and a representative point.

    A cell's id is the lowest key in it.
    """
    d = len(names)
    side = eps / np.sqrt(d) * (1 - 1e-9)
    coords = [f"c{j}" for j in range(d)]
    points = matrix.select(
        F.col(key).alias("key"),
        *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(names)],
    ).withColumns({c: F.floor(F.col(f"x{j}") / side) for j, c in enumerate(coords)})
    points = cut_lineage(points)
    first = F.min_by(F.struct(*[F.col(f"x{j}") for j in range(d)]), F.xxhash64("key"))
    cells = cut_lineage(
        points.groupBy(*coords)
        .agg(
            F.min("key").alias("cell"),
            F.count(F.lit(1)).alias("n"),
            *[F.min(f"x{j}").alias(f"lo{j}") for j in range(d)],
            *[F.max(f"x{j}").alias(f"hi{j}") for j in range(d)],
            first.alias("rep"),
        )
        .select("*", (F.col("n") >= min_samples).alias("dense"), "rep.*")
        .drop("rep")
    )
    ids = cells.select(*coords, "cell", "n", "dense")
    rows = lookup_join(points, ids, coords).drop(*coords)
    return cut_lineage(rows), cells


def _thin_candidates(thin: DataFrame, near: DataFrame, cells: DataFrame, d: int, limit: float) -> DataFrame:
    """Points p of thin cells against each other cell b that may hold neighbours: ``whole`` when all of b are."""
    around = near.select(F.col("a").alias("cell"), "b").unionByName(near.select(F.col("b").alias("cell"), F.col("a").alias("b")))
    as_box = spread(thin).select(
        F.col("key").alias("p"),
        "cell",
        *[F.col(f"x{j}").alias(f"p_lo{j}") for j in range(d)],
        *[F.col(f"x{j}").alias(f"p_hi{j}") for j in range(d)],
        *[F.col(f"x{j}").alias(f"p_x{j}") for j in range(d)],
    )
    other = _sided(cells.drop(*[f"c{j}" for j in range(d)]), "b_").withColumnRenamed("b_cell", "b")
    return (
        as_box.join(around, "cell")
        .join(other, "b")
        .where(_box_gap("p_", "b_", d) <= limit)
        .select(
            "p",
            "b",
            *[f"p_x{j}" for j in range(d)],
            F.col("b_n").alias("b_n"),
            (_box_reach("p_", "b_", d) <= limit).alias("whole"),
            (_point_gap("p_", "b_", d) <= limit).alias("hits_rep"),
        )
    )


def _core_points(rows: DataFrame, cells: DataFrame, near: DataFrame, d: int, limit: float, min_samples: int) -> DataFrame:
    """The points of thin cells with ``is_core``.

    The sure neighbours of a point (its own cell, cells wholly in reach, representatives in reach) mostly decide;
    only points left open are compared with the rows of the cells partly in reach.
    """
    thin = rows.where(~F.col("dense"))
    sure = F.when(F.col("whole"), F.col("b_n")).otherwise(F.col("hits_rep").cast("long"))
    known = (
        _thin_candidates(thin, near, cells, d, limit)
        .groupBy(F.col("p").alias("key"))
        .agg(F.sum(sure).alias("at_least"), F.sum(F.when(F.col("whole"), F.col("b_n")).otherwise(0)).alias("wholly"))
    )
    counted = cut_lineage(
        thin.join(known, "key", "left")
        .fillna(0, ["at_least", "wholly"])
        .withColumn("settled", F.col("n") + F.col("at_least") >= min_samples)
    )
    other = _sided(rows.select("cell", *[f"x{j}" for j in range(d)]), "b_").withColumnRenamed("b_cell", "b")
    seen = (
        _thin_candidates(counted.where(~F.col("settled")), near, cells, d, limit)
        .where(~F.col("whole"))
        .join(other, "b")
        .where(_point_gap("p_", "b_", d) <= limit)
        .groupBy(F.col("p").alias("key"))
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    total = F.col("n") + F.col("wholly") + F.coalesce("seen", F.lit(0))
    is_core = F.col("settled") | (total >= min_samples)
    return counted.join(seen, "key", "left").withColumn("is_core", is_core).drop("at_least", "wholly", "settled", "seen")


def _closest_links(core_rows: DataFrame, apart: DataFrame, boxes: DataFrame, d: int, limit: float) -> DataFrame:
    """The pairs (a, b) of ``apart`` of which some core point of b is within eps of the core point of a that lies nearest to the box of b.

    Every core point is looked at once for each pair its cell is in; it is compared with one point, not with a cell's.
    """
    xs = [f"a_x{j}" for j in range(d)]
    points = core_rows.select(
        F.col("cell").alias("a"),
        *[F.col(f"x{j}").alias(f"a_x{j}") for j in range(d)],
        *[F.col(f"x{j}").alias(f"p_{s}{j}") for s in ("lo", "hi") for j in range(d)],
    )
    nearest = F.min_by(F.struct(*xs), F.struct(_box_gap("p_", "o_", d), *xs)).alias("p")
    ends = apart.select("a", "b").join(points, "a").join(_sided(boxes, "o_").withColumnRenamed("o_cell", "b"), "b")
    ends = ends.groupBy("a", "b").agg(nearest).select("a", "b", "p.*")
    others = core_rows.select(F.col("cell").alias("b"), *[F.col(f"x{j}").alias(f"b_x{j}") for j in range(d)])
    least = F.min(_point_gap("a_", "b_", d)).alias("least")
    return ends.join(others, "b").groupBy("a", "b").agg(least).where(F.col("least") <= limit).select("a", "b")


def _merged(comps: DataFrame, touching: DataFrame) -> DataFrame:
    """``comps`` (node, comp) with the pairs (a, b) of components in ``touching`` united."""
    touching = cut_lineage(touching.distinct())
    if touching.isEmpty():
        return comps
    merged = connected_components(comps.select(F.col("comp").alias("node")).distinct(), touching)
    final = merged.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    return comps.join(final, "comp").select("node", F.col("root").alias("comp"))


def _join_components(
    core_rows: DataFrame, nodes: DataFrame, near: DataFrame, cells: DataFrame, d: int, limit: float
) -> DataFrame:
    """(node, comp) over the cells with core points.

    Cells wholly in reach of each other, or with representatives in reach, are linked first, then those whose points nearest
    to each other's box are. Only pairs of near cells that this leaves apart have their core points compared, and of those
    only points within eps of the other box.
    """
    reps = nodes.select("node", *[f"x{j}" for j in range(d)])
    pairs = (
        spread(near)
        .where(F.col("a") < F.col("b"))
        .join(_sided(reps, "a_").withColumnRenamed("a_node", "a"), "a")
        .join(_sided(reps, "b_").withColumnRenamed("b_node", "b"), "b")
        .select("a", "b", (F.col("whole") | (_point_gap("a_", "b_", d) <= limit)).alias("linked"))
    )
    pairs = cut_lineage(pairs)
    comps = connected_components(nodes, pairs.where("linked"))
    boxes = cells.select("cell", *[f"{s}{j}" for s in ("lo", "hi") for j in range(d)])

    def left_apart(of: DataFrame, comps: DataFrame) -> DataFrame:
        found = (
            of.select("a", "b")
            .join(comps.select(F.col("node").alias("a"), F.col("comp").alias("comp_a")), "a")
            .join(comps.select(F.col("node").alias("b"), F.col("comp").alias("comp_b")), "b")
            .where(F.col("comp_a") != F.col("comp_b"))
        )
        return cut_lineage(found.select("a", "b", "comp_a", "comp_b"))

    apart = left_apart(pairs.where(~F.col("linked")), comps)
    if apart.isEmpty():
        return comps
    close = apart.join(_closest_links(core_rows, apart, boxes, d, limit), ["a", "b"])
    comps = _merged(comps, close.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    apart = left_apart(apart, comps)

    def facing(own: str, other: str) -> DataFrame:
        """Core points of ``own`` within eps of the box of ``other``, for each pair left apart."""
        points = core_rows.select(
            F.col("cell").alias(own),
            *[F.col(f"x{j}").alias(f"{own}_x{j}") for j in range(d)],
            *[F.col(f"x{j}").alias(f"p_{s}{j}") for s in ("lo", "hi") for j in range(d)],
        )
        box = _sided(boxes, "o_").withColumnRenamed("o_cell", other)
        return (
            apart.join(points, own)
            .join(box, other)
            .where(_box_gap("p_", "o_", d) <= limit)
            .select("a", "b", "comp_a", "comp_b", *[f"{own}_x{j}" for j in range(d)])
        )

    touching = (
        facing("a", "b")
        .join(facing("b", "a").drop("comp_a", "comp_b"), ["a", "b"])
        .where(_point_gap("a_", "b_", d) <= limit)
        .select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    )
    return _merged(comps, touching)


def _coinciding_labels(matrix: DataFrame, columns: Sequence[str], min_samples: int, key: str) -> DataFrame:
    """Labels at a distance of 0, where only equal points are neighbours: each point of enough copies is a cluster."""
    rows = matrix.select(key, *columns)
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("lowest"))
    full = cut_lineage(groups.where(F.col("copies") >= min_samples))
    numbered = row_positions(full, "lowest").select(*columns, (F.col("position") - 1).cast("long").alias("label"))
    label = F.coalesce(F.col("label"), F.lit(-1)).cast("long")
    return rows.join(numbered, list(columns), "left").select(
        key, label.alias("dbscan_cluster"), (label == -1).alias("is_anomaly")
    )


def dbscan_labels(
    matrix: DataFrame, columns: Sequence[str], eps: float | None = None, min_samples: int = 5, key: str = "id"
) -> DataFrame:
    """(key, dbscan_cluster, is_anomaly): exact DBSCAN over every row; noise is -1.

    A point counts as its own neighbour. Clusters are numbered by their lowest core key, and a border point joins the
    lowest-numbered cluster in reach. Without ``eps`` the knee of the k-distances is used.
    """
    if eps is None:
        eps = find_eps(matrix, columns, min_samples, key)
    if eps <= 0:
        return _coinciding_labels(matrix, columns, min_samples, key)
    d, limit = len(columns), eps * eps
    rows, cells = _grid(matrix, columns, key, eps, min_samples)
    near = cut_lineage(_near_cells(cells, d, limit))
    xs = [f"x{j}" for j in range(d)]
    thin = cut_lineage(_core_points(rows, cells, near, d, limit, min_samples))
    thin_core = thin.where("is_core").select("key", "cell", *xs)
    thin_nodes = thin_core.groupBy("cell").agg(
        F.min("key").alias("core_key"), F.min_by(F.struct(*xs), F.xxhash64("key")).alias("rep")
    )
    nodes = cut_lineage(
        cells.where("dense")
        .select(F.col("cell").alias("node"), F.col("cell").alias("core_key"), *xs)
        .unionByName(thin_nodes.select(F.col("cell").alias("node"), "core_key", "rep.*"))
    )
    core_rows = rows.where("dense").select("key", "cell", *xs).unionByName(thin_core)
    comps = _join_components(core_rows, nodes, near, cells, d, limit)
    lowest = nodes.join(comps, "node").groupBy("comp").agg(F.min("core_key").alias("core_key"))
    numbered = row_positions(cut_lineage(lowest), "core_key")
    labels = cut_lineage(
        comps.join(numbered.select("comp", (F.col("position") - 1).alias("label")), "comp").select(
            F.col("node").alias("cell"), "label"
        )
    )
    border = _border_labels(core_rows, thin.where(~F.col("is_core")), near, cells, labels, d, limit)
    core = lookup_join(core_rows.select("key", "cell"), labels, ["cell"]).select("key", "label")
    found = core.unionByName(border)
    label = F.coalesce(F.col("label"), F.lit(-1)).cast("long")
    return rows.select("key").join(found, "key", "left").select(
        F.col("key").alias(key), label.alias("dbscan_cluster"), (label == -1).alias("is_anomaly")
    )


def _border_labels(
    core_rows: DataFrame, others: DataFrame, near: DataFrame, cells: DataFrame, labels: DataFrame, d: int, limit: float
) -> DataFrame:
    """(key, label) of the points in ``others``, no core points, that have a core point in reach."""
    own = others.join(labels, "cell").select("key", "label")
    reach = _thin_candidates(others, near, cells, d, limit).join(labels.withColumnRenamed("cell", "b"), "b")
    # All points of a cell wholly in reach are; of the others the core points are looked at.
    inside = reach.where("whole").select(F.col("p").alias("key"), "label")
    other = _sided(core_rows.drop("key"), "b_").withColumnRenamed("b_cell", "b")
    touched = (
        reach.where(~F.col("whole"))
        .join(other, "b")
        .where(_point_gap("p_", "b_", d) <= limit)
        .select(F.col("p").alias("key"), "label")
    )
    return own.unionByName(inside).unionByName(touched).groupBy("key").agg(F.min("label").alias("label"))


def _coinciding_silhouette(labelled: DataFrame) -> float:
    """The mean silhouette of clusters of equal points, however many: nothing is apart inside a cluster, so it is 1, and 0 for a lone point."""
    sizes = labelled.where(~F.col("is_anomaly")).groupBy("dbscan_cluster").agg(F.count(F.lit(1)).alias("size"))
    several = F.sum(F.when(F.col("size") > 1, F.col("size")).otherwise(0))
    return float(sizes.agg((several / F.sum("size")).alias("share")).first()["share"])


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows, noise points and clusters of density labels."""
    return labelled.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_anomaly").alias("noise"),
        F.count_distinct(F.when(~F.col("is_anomaly"), F.col("dbscan_cluster"))).alias("clusters"),
    )


def dbscan(
    matrix: DataFrame, columns: Sequence[str], eps: float | None = None, min_samples: int = 5, key: str = "id"
) -> DataFrame:
    """Summary of one run; the silhouette covers the clustered points when there are several clusters."""
    if eps is None:
        eps = find_eps(matrix, columns, min_samples, key)
    labelled = cut_lineage(dbscan_labels(matrix, columns, eps, min_samples, key))
    counts = label_counts(labelled).first()
    silhouette, clustered = None, 1 < counts["clusters"] < counts["n"] - counts["noise"]
    if clustered and eps <= 0:
        silhouette = _coinciding_silhouette(labelled)
    elif clustered:
        kept = matrix.join(labelled.where(~F.col("is_anomaly")), key)
        scores = cluster_metrics(kept.select(*columns, "dbscan_cluster"), columns, "dbscan_cluster")
        silhouette = scores.first()["silhouette"]
    return matrix.sparkSession.createDataFrame(
        [(eps, min_samples, counts["clusters"], counts["noise"], counts["noise"] * 100 / counts["n"], silhouette)],
        "eps double, min_samples int, n_clusters long, n_noise_points long, noise_percentage double, "
        "silhouette_score double",
    )
