"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Sizes are words. ``targets`` shares a budget among the sources by weight, with each target stopped at a multiple of its
source's size and the excess shared again. ``mix`` takes every document of a source a whole number of times and, for the rest of the target, one more copy of
the documents whose hash lies under the source's threshold. The threshold comes from histograms: words are summed by
source and hash bucket, the bucket in which the budget is reached is the only one refined, by the next bits of the hash, down
to single hashes. What a threshold leaves over, because the next document is too long for it, is given in
``FILLS`` further passes to documents beyond the threshold that are short enough. Nothing is sorted, and a hot source is only ever summed.

Nulls: a null text has size 0; a null source is a source of its own, last in order.  Documents with
equal hash (rows equal in doc_id and text) are taken together. With no words at all, targets are 0. Other columns
are carried along; those named like a column made here are replaced. Reruns agree, as the hash
depends on the row's content alone.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
BITS = 12
LEVELS = 5
FILLS = 3


def word_count(text: str = "text") -> F.Column:
    """Number of runs of characters that are no ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash() -> F.Column:
    """60 bits that depend on a row's doc_id and text alone."""
    digest = F.md5(F.concat_ws("\x1f", F.col("doc_id").cast("string"), F.col("text")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` without texts, with ``size``, ``source_key`` (never null) and ``hash``."""
    return docs.select(
        *[c for c in docs.columns if c not in ("text", "size", "source_key", "hash", "source_size", "target", "copies")],
        word_count().alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("source_key"),
        row_hash().alias("hash"),
    )


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """(source_key, source_size, target): one row per source; only totals reach the driver."""
    order = Window.orderBy(F.col("source_key") == "n", "source_key")  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    sources = cut_lineage(
        sizes.groupBy("source_key")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(order))
        .select("source_key", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("limit"))
    )
    total = share * (sources.agg(F.sum("source_size")).head()[0] or 0)
    free = F.lit(True)
    rate = 0.0
    while True:
        state = sources.select(free.alias("free"), "weight", "limit").agg(
            F.sum(F.when(F.col("free"), F.col("weight"))).alias("w"), F.sum(F.when(~F.col("free"), F.col("limit"))).alias("held")
        ).head()
        if not state["w"]:
            break
        rate = max(total - (state["held"] or 0.0), 0.0) / state["w"]
        over = free & (F.col("weight") * rate > F.col("limit"))
        if not sources.where(over).limit(1).count():
            break
        free = F.col("weight") * rate <= F.col("limit")
    return sources.select(
        "source_key", "source_size", F.least(F.col("limit"), F.when(free, F.col("weight") * rate).otherwise(F.col("limit"))).alias("target")
    )


def thresholds(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """(source_key, need, start, below, used): the words of hashes under ``below`` fit into ``need``; ``used`` is their sum.

    ``rows`` has source_key, hash, size; ``needs`` has source_key, need, start, which are carried along. Rows longer than the need or of
    hashes under ``start`` take no part. Each level sums the words of the boundary bucket by the next ``BITS`` bits, until
    that bucket holds one row or one hash.
    """
    named = ["source_key", "need", "start"]
    state = needs.select(*named, F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("used"))
    closed = needs.select(*named, F.lit(1 << 60).cast("long").alias("below"), F.lit(0).cast("long").alias("used")).limit(0)
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = rows.join(state, "source_key").where((F.col("size") <= F.col("need")) & (F.col("hash") >= F.col("start")))
        if level:
            inside = inside.where(F.shiftright("hash", shift + BITS) == F.col("prefix"))
        bucket = F.shiftright("hash", shift).alias("bucket")
        sums = inside.groupBy(*named, "used", bucket).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        upto = F.col("used") + F.sum("words").over(Window.partitionBy("source_key").orderBy("bucket"))
        over = F.struct("bucket", (F.col("upto") - F.col("words")).alias("used"), "n")
        edge = cut_lineage(
            sums.withColumn("upto", upto)
            .groupBy(*named)
            .agg(F.min(F.when(F.col("upto") > F.col("need"), over)).alias("edge"), F.max("upto").alias("all"))
        )
        state = edge.where(F.col("edge").isNotNull()).select(
            *named, F.col("edge.bucket").alias("prefix"), F.col("edge.used").alias("used"), F.col("edge.n").alias("n")
        )
        if not level:  # later levels start from a bucket that reaches the need
            closed = edge.where(F.col("edge").isNull()).select(*named, F.lit(1 << 60).cast("long").alias("below"), F.col("all").alias("used"))
        if not state.where(F.col("n") > 1).limit(1).count():
            break
        state = state.drop("n")
    return closed.unionByName(state.select(*named, F.shiftleft("prefix", shift).alias("below"), "used"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` without texts, plus size, source_key, hash, source_size, target and copies (0 to ``most``) of each row."""
    named = sized(docs)
    # Other columns have numbers for names in here, so that none meets a name that is used on the way.
    carried = {c: f"carried_{i}" for i, c in enumerate(named.columns[:-3])}
    sizes = cut_lineage(named.select(*[F.col(c).alias(n) for c, n in carried.items()], "size", "source_key", "hash"))
    aims = targets(sizes, weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    aims = cut_lineage(
        aims.withColumn("epochs", F.least(epochs, F.lit(most))).withColumn(
            "need", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))
        )
    )
    rows = sizes.select("source_key", "hash", "size").where(F.col("size") > 0)
    needs = aims.select("source_key", "need", F.lit(0).cast("long").alias("start"))
    passes = []
    for fill in range(1 + FILLS):
        found = cut_lineage(thresholds(rows, needs))
        passes.append(found.select("source_key", F.lit(fill).alias("fill"), "below", "need"))
        # A need never grows, so what is short enough for the next one was short enough for all before.
        needs = found.select("source_key", (F.col("need") - F.col("used")).alias("need"), F.greatest("start", "below").alias("start"))
    # One row per source with the bounds of all passes: the documents are joined once, and the driver broadcasts one small table.
    of = lambda fill, name: F.max(F.when(F.col("fill") == fill, F.col(name))).alias(f"{name}_{fill}")
    bounds = functools.reduce(DataFrame.unionByName, passes).groupBy("source_key").agg(
        *[of(fill, name) for fill in range(1 + FILLS) for name in ("below", "need")]
    )
    out = sizes.join(cut_lineage(aims.drop("need").join(bounds, "source_key", "left")), "source_key", "left")
    extra = F.lit(False)
    for fill in range(1 + FILLS):
        fits = (F.col("hash") < F.col(f"below_{fill}")) & (F.col("size") <= F.col(f"need_{fill}"))
        extra = extra | F.coalesce(fits & (F.col("size") > 0), F.lit(False))
    return out.withColumn("copies", F.least(F.col("epochs") + extra.cast("int"), F.lit(most))).select(
        *[F.col(n).alias(c) for c, n in carried.items()], "size", "source_key", "hash", "source_size", "target", "copies"
    )
