"""Exact order statistics without sorting a whole column in one place.

Values are cut into range buckets of about equal row count. The bounds come from one pass of quantile sketches and
are literals from then on, so a recomputed task always sees the same buckets. Inside a bucket only distinct values
with their counts are ordered, which keeps a value shared by a third of all rows down to a single entry.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from marketloom.operators.lookup import bounded_local

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 16_384
SKETCH_FAN_IN = 64
SKETCH_GRID = 1024
ROWS_PER_TASK = 500_000


def usable(value: Column) -> Column:
    """True for a value that is neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def melt(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long form (ids..., column, value) of numeric columns, missing values dropped."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), "column", "value").where(usable(F.col("value")))


def _sketch(df: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """A fixed number of sorted summary points of ``value`` and the rows up to each.

    Sketches are merged in groups of map tasks, so no single task receives all of them.
    """
    points = [(i + 0.5) / SKETCH_GRID for i in range(SKETCH_GRID)]
    sketches = (
        df.select(F.col(value).alias("v"), (F.spark_partition_id() % SKETCH_FAN_IN).alias("part"))
        .groupBy("part")
        .agg(
            F.count("v").alias("n"),
            F.percentile_approx("v", F.array(*[F.lit(p) for p in points]), F.lit(4 * SKETCH_GRID)).alias("q"),
        )
        .where("n > 0")
        .collect()
    )
    values = np.array([v for row in sketches for v in row["q"]], dtype=float)
    weights = np.array([row["n"] / SKETCH_GRID for row in sketches for _ in row["q"]], dtype=float)
    order = np.argsort(values, kind="stable")
    return values[order], np.cumsum(weights[order])


def range_bounds(
    df: DataFrame, value: str, rows_per_bucket: int = ROWS_PER_BUCKET, *, sketch: tuple[np.ndarray, np.ndarray] | None = None
) -> list[float]:
    """Inner bounds that cut the rows of ``value`` into buckets of about equal size."""
    values, reached = _sketch(df, value) if sketch is None else sketch
    if not len(values):
        return []
    total = round(reached[-1])
    # A few buckets per reducer once there is work for them, and no bucket beyond its row budget.
    reducers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MAX_BUCKETS, max(min(4 * reducers, total // 5_000), -(-total // rows_per_bucket)))
    cuts = np.searchsorted(reached, total * np.arange(1, buckets) / max(buckets, 1))
    return np.unique(values[np.minimum(cuts, len(values) - 1)]).tolist()


def approximate_quantile(df: DataFrame, value: str, p: float) -> float:
    """A quantile within the sketch error, for iterations that need no exact cut."""
    values, reached = _sketch(df, value)
    return float(values[min(np.searchsorted(reached, p * reached[-1]), len(values) - 1)])


def with_bucket(df: DataFrame, value: str, bounds: Sequence[float]) -> DataFrame:
    """Add ``bucket``: equal values always share one, and buckets follow the order of the values."""
    if not bounds:
        return df.withColumn("bucket", F.lit(0))
    splits = [float("-inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=value, outputCol="bucket").transform(df)
    return cut.withColumn("bucket", F.col("bucket").cast("int"))


def _prepared(df: DataFrame, value: str, by: Sequence[str], weight: str | None = None) -> DataFrame:
    copies = F.col(weight) if weight else F.lit(1)
    rows = df.select(*by, F.col(value).cast("double").alias("value"), copies.cast("long").alias("copies"))
    rows = rows.where(usable(F.col("value")))
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    return rows


def _earlier_buckets(by: Sequence[str]) -> WindowSpec:
    # At most MAX_BUCKETS rows per group reach this window.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)


def _bucket_offsets(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., bucket, size) -> plus rows ``before`` the bucket and ``total`` rows of the group."""
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("size").over(_earlier_buckets(by)), F.lit(0))
    return counts.withColumn("before", before).withColumn("total", F.sum("size").over(whole))


def _counted(bucketed: DataFrame, by: Sequence[str], total: int) -> DataFrame:
    """Distinct (by..., bucket, value) with ``ties``. Beyond ``ROWS_PER_TASK`` rows whole buckets are dealt over as many tasks as the rows ask
    for, so no task grows with the table; equal values are added up within a batch before, so a hot value stays small."""
    keys = [*by, "bucket", "value"]
    if total > ROWS_PER_TASK:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sums = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([("copies", "sum")])
                yield from sums.select([*keys, "copies_sum"]).rename_columns([*keys, "copies"]).to_batches()

        rows = bucketed.select(*keys, "copies")
        bucketed = rows.mapInArrow(run, rows.schema).repartition(-(-total // ROWS_PER_TASK), *by, "bucket")
    return bucketed.groupBy(*keys).agg(F.sum("copies").alias("ties"))


def value_ladder(df: DataFrame, value: str, by: Sequence[str] = (), cap: int | None = None) -> DataFrame:
    """Distinct values of each group with ``ties`` (their count), ``below`` (rows with a smaller value), ``total``.

    The average-tie rank of a value is ``below + (ties + 1) / 2``. With ``cap`` there is also ``start``, the number of
    rows below when no value counts more than ``cap`` times.
    """
    rows = _prepared(df, value, by)
    sketch = _sketch(rows, "value")
    bucketed = with_bucket(rows, "value", range_bounds(rows, "value", sketch=sketch))
    distinct = _counted(bucketed, by, round(sketch[1][-1]) if len(sketch[1]) else 0)
    inside = Window.partitionBy(*by, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    kept = []
    placed = distinct.withColumn("within", F.coalesce(F.sum("ties").over(inside), F.lit(0)))
    if cap is not None:
        capped = F.least("ties", F.lit(cap).cast("long"))
        kept = ["start"]
        placed = placed.withColumn("start", F.coalesce(F.sum(capped).over(inside), F.lit(0)))
        sizes = distinct.groupBy(*by, "bucket").agg(F.sum("ties").alias("size"), F.sum(capped).alias("capped"))
    else:  # counted on the rows, so the values are shuffled once
        sizes = bucketed.groupBy(*by, "bucket").agg(F.sum("copies").alias("size"))
    offsets = _bucket_offsets(sizes, by)
    if cap is not None:
        earlier = _earlier_buckets(by)
        offsets = offsets.withColumn("capped_before", F.coalesce(F.sum("capped").over(earlier), F.lit(0)))
    ladder = placed.join(offsets, [*by, "bucket"]).withColumn("below", F.col("before") + F.col("within"))
    if cap is not None:
        ladder = ladder.withColumn("start", F.col("capped_before") + F.col("start"))
    return ladder.select(*by, "value", "ties", "below", "total", *kept)


def write_index(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """The order statistics of numeric columns as a table: every value with ``ties``, ``below`` and ``total``, in the order of the values,
    one folder per column. Operators on ranks take it as ``index`` and then order nothing themselves."""
    ladder = value_ladder(melt(df, columns), "value", ["column"])
    ladder.sortWithinPartitions("column", "value").write.mode("overwrite").partitionBy("column").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value double, ties long, below long, total long, column string").parquet(path)


def column_ladder(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """(column, value, ties, below, total) of the columns, from ``index`` where there is one."""
    if index is None:
        return value_ladder(melt(df, columns), "value", ["column"])
    return index.where(F.col("column").isin(*columns)).select("column", "value", "ties", "below", "total")


def ladder_quantiles(named: dict[str, float]) -> list[Column]:
    """Aggregates that read interpolated quantiles off ladder rows."""
    picks = []
    for name, p in named.items():
        place = (F.col("total") - 1) * p
        upto = F.col("below") + F.col("ties")
        low, high = F.floor(place), F.ceil(place)
        low_value = F.max(F.when((low >= F.col("below")) & (low < upto), F.col("value")))
        high_value = F.max(F.when((high >= F.col("below")) & (high < upto), F.col("value")))
        picks.append((low_value + (high_value - low_value) * F.max(place - low)).alias(name))
    return picks


def labelled_ladder(df: DataFrame, value: str, label: str) -> DataFrame:
    """Ladder over the pooled values, split by label: (bucket, value, label, cnt, ties, below, total).

    ``cnt`` counts the label's rows at a value; ``ties`` and ``below`` count the rows of all labels.
    """
    rows = _prepared(df, value, [label])
    bucketed = with_bucket(rows, "value", range_bounds(rows, "value"))
    cells = bucketed.groupBy("bucket", "value", label).agg(F.sum("copies").alias("cnt"))
    sizes = cells.groupBy("bucket").agg(F.sum("cnt").alias("size"))
    upto = Window.partitionBy("bucket").orderBy("value").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("bucket", "value")
    return (
        cells.withColumn("upto", F.sum("cnt").over(upto))
        .withColumn("ties", F.sum("cnt").over(same))
        .join(_bucket_offsets(sizes, ()), "bucket")
        .withColumn("below", F.col("before") + F.col("upto") - F.col("ties"))
        .select("bucket", "value", label, "cnt", "ties", "below", "total")
    )


def average_rank() -> Column:
    """Average-tie rank of a ladder row."""
    return F.col("below") + (F.col("ties") + 1) / 2


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Linear-interpolated quantiles as rows (by..., p, n, quantile); ``weight`` counts copies of a row.

    Only the buckets that hold a wanted order statistic are shuffled and ordered.
    """
    rows = _prepared(df, value, by, weight)
    bucketed = with_bucket(rows, "value", range_bounds(rows, "value"))
    sizes = bucketed.groupBy(*by, "bucket").agg(F.sum("copies").alias("size"))
    place = (F.col("total") - 1) * F.col("p")
    inside = lambda rank: (F.col(rank) >= F.col("before")) & (F.col(rank) < F.col("before") + F.col("size"))
    targets = (
        _bucket_offsets(sizes, by)
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("low", F.floor(place))
        .withColumn("high", F.ceil(place))
        .where(inside("low") | inside("high"))
        .withColumn("part", place - F.col("low"))
        .select(*by, "bucket", "before", "total", "p", "low", "high", "part")
    )
    local = bounded_local(targets)
    wanted, targets = (targets, targets) if local is None else (F.broadcast(local), F.broadcast(local))
    ordered = Window.partitionBy(*by, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.col("within")
    hit = lambda rank: F.max(
        F.when((F.col(rank) >= start) & (F.col(rank) < start + F.col("ties")), F.col("value"))
    )
    return (
        bucketed.join(wanted.select(*by, "bucket").distinct() if local is None else wanted, [*by, "bucket"], "left_semi")
        .groupBy(*by, "bucket", "value")
        .agg(F.sum("copies").alias("ties"))
        .withColumn("within", F.coalesce(F.sum("ties").over(ordered), F.lit(0)))
        .join(targets, [*by, "bucket"])
        .groupBy(*by, "p")
        .agg(
            F.max("total").alias("n"),
            hit("low").alias("low_value"),
            hit("high").alias("high_value"),
            F.max("part").alias("part"),
        )
        .select(
            *by,
            "p",
            "n",
            (F.col("low_value") + (F.col("high_value") - F.col("low_value")) * F.col("part")).alias("quantile"),
        )
    )


def quantile_table(
    df: DataFrame, value: str, named: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles side by side: one row per group, one column per name, plus the count ``n``."""
    long = exact_quantiles(df, value, sorted(set(named.values())), by)
    picks = [F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name) for name, p in named.items()]
    return long.groupBy(*by).agg(F.max("n").alias("n"), *picks)


def row_positions(df: DataFrame, key: str) -> DataFrame:
    """Add ``position`` (1..n) in the order of a unique numeric key."""
    rows = df.withColumn("_key", F.col(key).cast("double"))
    bucketed = with_bucket(rows, "_key", range_bounds(rows, "_key"))
    sizes = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    local = Window.partitionBy("bucket").orderBy(key)
    return (
        bucketed.withColumn("_local", F.row_number().over(local))
        .join(_bucket_offsets(sizes, ()).select("bucket", "before"), "bucket")
        .withColumn("position", F.col("before") + F.col("_local"))
        .drop("_key", "_local", "bucket", "before")
    )


def ordered_weighted_means(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(column, weighted_mean): values weighted 1..n in key order, n counting the column's non-missing rows.

    One ordering of the rows serves all columns. Inside a bucket the weights count from its start; what lies before it
    is added on the bucket sums.
    """
    missing = F.lit(None).cast("double")
    rows = df.select(
        F.col(key).cast("double").alias("_key"), key, *[F.nanvl(F.col(c).cast("double"), missing).alias(c) for c in columns]
    )
    bucketed = with_bucket(rows, "_key", range_bounds(rows, "_key"))
    upto = Window.partitionBy("bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = bucketed.select("bucket", *columns, *[F.count(c).over(upto).alias(f"_p_{c}") for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("size"),
            F.sum(c).alias("plain"),
            F.sum(F.col(c) * F.col(f"_p_{c}")).alias("local"),
        )
        for c in columns
    ]
    sums = placed.groupBy("bucket").agg(F.array(*cells).alias("cells")).select("bucket", F.inline("cells"))
    return (
        _bucket_offsets(sums, ["column"])
        .groupBy("column")
        .agg(F.sum(F.col("before") * F.col("plain") + F.col("local")).alias("weighted"), F.max("total").alias("n"))
        .where("n > 0")
        .select("column", (F.col("weighted") / (F.col("n") * (F.col("n") + 1.0) / 2)).alias("weighted_mean"))
    )
