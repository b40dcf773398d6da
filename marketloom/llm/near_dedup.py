"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct word shingles. Documents with equal sets are one class from the first step on. Each class
gets a SetSketch: every element sends an ascending series of exponentially spaced points to random registers, a register
keeps the smallest point it has seen, and its value is the truncated logarithm of that point. Registers of a union are the larger of
two values (``merged``), and two sets agree in a register with a probability that follows their similarity.

Bands of register values put classes into buckets. In a bucket every class is compared with the bucket's most central
one, so a bucket of any size gives as many pairs as it has members. Such a pair is judged by the likelihood of its register
comparisons (``joint_estimate``, dropped only ``MARGIN`` standard errors below the threshold), then confirmed on the full
sets. Classes that are still in another component than a class of their bucket get an exact join on the full sets (``rest_pairs``):
shingles are ordered from rare to frequent, only the first of each set are joined, and a pair is a candidate only if the shingles behind
its first common one can still reach the threshold. So no link is lost by the hub, and no group gives all its pairs.

With 32 bands of 6 registers a pair at the threshold of 0.85 shares no band with a probability below 1e-7.

Nulls and short texts: fewer words than a shingle make one shingle of the whole sequence; a text without words, or a null,
has an empty set, is linked with nothing and is its own component. Rows that repeat a doc_id are rows of one id: each follows its
own text, and the component is named by the smallest id reachable. A null doc_id never names a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.keyfilter import key_bitmap, maybe_among, maybe_set
from marketloom.llm.words import Words, grams, mix, slices
from marketloom.operators.components import connected_components
from marketloom.session import cut_lineage

SHINGLE = 3
PERCENT = 85
REGISTERS = 192
ROWS = 6
BASE = 1.2
RATE = 20.0
TOP = 254
MARGIN = 6.0
HUB_ROWS = 500
COUNTERS = 1 << 16
REPEATED_BITS = 1 << 27  # of bitmaps of shingles and buckets that occur more than once
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SKETCHES = "doc_id long, code long, digest binary, n_shingles long, registers binary"


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of the distinct shingles of each text, in order."""
    words = Words(column, lower=True)
    codes, text, counts = words.codes(), words.text, words.counts
    whole = words.room(shingle)
    found = [(text[whole], grams(codes, shingle)[whole])]
    for n in range(1, shingle):
        short = words.first[:-1][counts == n]
        if len(short):
            found.append((text[short], mix(grams(codes, n)[short] + np.uint64(n))))
    text = np.concatenate([t for t, _ in found])
    code = np.concatenate([c for _, c in found])
    order = np.lexsort((code, text))
    text, code = text[order], code[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
    return text[new], code[new]


def sketches(text: np.ndarray, code: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of each text's set, by ascending points: an element stops once its next point is above all of
    its text's registers, so large sets need about one point per element."""
    least = np.full((texts, registers), np.inf)
    flat = least.reshape(-1)
    active, seed, at = text, code, np.zeros(len(text))
    while len(active):
        seed = mix(seed + GOLDEN)
        spread = mix(seed ^ np.uint64(0xA0761D6478BD642F))
        unit = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at = at - np.log(unit) / registers
        slot = active * registers + (spread % np.uint64(registers)).astype(np.int64)
        better = at < flat[slot]
        np.minimum.at(flat, slot[better], at[better])
        highest = least.max(axis=1)
        going = at < highest[active]
        active, seed, at = active[going], seed[going], at[going]
    with np.errstate(divide="ignore"):
        value = np.floor(1.0 - np.log(least / RATE) / np.log(BASE))
    return np.clip(np.nan_to_num(value, neginf=0.0), 0, TOP).astype(np.uint8)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, steps: int = 40) -> np.ndarray:
    """Jaccard similarity of the largest joint likelihood, given registers (rows) and the sizes of the two sets.

    The likelihood of the counts of larger, smaller and equal registers is unimodal in the similarity; golden section.
    """
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        more, less = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return above * np.log(more) + below * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))

    ratio = (np.sqrt(5) - 1) / 2
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(steps):
        c, d = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        left = likelihood(c) > likelihood(d)
        lo, hi = np.where(left, lo, c), np.where(left, d, hi)
    return (lo + hi) / 2


def document_sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a code of the text, a digest of the set, its size, and its registers, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            text, code = shingle_sets(rows.column("text"), shingle)
            n = rows.num_rows
            first = np.searchsorted(text, np.arange(n + 1))
            run_sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (mix(code), mix(code ^ GOLDEN))]
            digest = np.stack([r[first[1:]] - r[first[:-1]] for r in run_sums], 1)
            values = sketches(text, code, n)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("code"),
                    pa.array([d.tobytes() for d in digest], pa.binary()),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array([v.tobytes() for v in values], pa.binary()),
                ],
                names=["doc_id", "code", "digest", "n_shingles", "registers"],
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("code"), "text")
    return keyed.mapInArrow(run, SKETCHES)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        values = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint8).reshape(n, -1, ROWS).astype(np.uint64)
        band = np.broadcast_to(np.arange(values.shape[1], dtype=np.uint64), values.shape[:2]).copy()
        for r in range(ROWS):
            band = band * np.uint64(256) + values[:, :, r]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node").take(pa.array(np.repeat(np.arange(n), values.shape[1]))),
                pa.array(band.reshape(-1).view(np.int64)),
            ],
            names=["node", "bucket"],
        )


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def likely(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (hub, node) pairs that sizes and the joint likelihood of the registers do not rule out."""
    # registers of classes without a pair stay where they are
    paired = pairs.select(F.explode(F.array("hub", "node")).alias("node")).distinct().select(F.xxhash64("node").alias("at"))
    held = maybe_among(classes.select(F.xxhash64("node").alias("at"), "node", "n", "registers"), "at", paired)
    side = lambda key, s: held.select(F.col("node").alias(key), F.col("n").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))
    fit = (100 * F.least("n_a", "n_b")) >= percent * F.greatest("n_a", "n_b")
    joined = pairs.join(side("hub", "a"), "hub").join(side("node", "b"), "node").where(fit)
    threshold = percent / 100
    lowest = threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / REGISTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
            found = joint_estimate(_registers(batch.column("r_a")), _registers(batch.column("r_b")), size("n_a"), size("n_b"))
            yield batch.select(["hub", "node"]).filter(pa.array(found >= lowest))

    return joined.mapInArrow(run, "hub binary, node binary")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Each hub's text travels once for every ``HUB_ROWS`` partners."""
    salts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("salts"))
    partners = pairs.join(salts, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), "node")
    hubs = salts.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("hub").alias("node")
    )
    # hubs and partners meet the texts in one join, so all texts travel to it once
    both = hubs.unionByName(partners).join(texts, "node").select("hub", "salt", "role", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whose, own = None, np.zeros(0, np.uint64)
        for rows in slices(batches, "text"):
            text, code = shingle_sets(rows.column("text"), shingle)
            first = np.searchsorted(text, np.arange(rows.num_rows + 1))
            hub, node, role = (rows.column(c).to_pylist() for c in ("hub", "node", "role"))
            a, b = [], []
            for i in range(rows.num_rows):
                other = code[first[i] : first[i + 1]]
                if role[i] == 0:
                    whose, own = hub[i], other
                elif whose == hub[i] and len(own) and len(other):
                    small, large = (own, other) if len(own) < len(other) else (other, own)
                    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[place] == small).sum())
                    if 100 * both >= percent * (len(own) + len(other) - both):
                        a.append(hub[i])
                        b.append(node[i])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    dealt = both.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role")
    return dealt.mapInArrow(run, "a binary, b binary")


def rest_pairs(texts: DataFrame, apart: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(hub, node): pairs of ``apart`` (node, comp) in different components whose sets may be similar enough.

    A prefix join with a positional bound. Shingles that no other set of ``apart`` holds come first, so a set with too many of
    them is ruled out by their number; then rare ones, by counts in a table of fixed size. Any order is right: what the fixed-size
    tables can't tell apart only makes the join larger.
    """
    held = texts.join(apart, "node").select("node", "comp", "text")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(rows.column("text"), shingle)[1].view(np.int64))], names=["shingle"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            place = np.mod(batch.column("shingle").to_numpy(), COUNTERS)
            total += np.bincount(place, weights=batch.column("n").to_numpy(), minlength=COUNTERS).astype(np.int64)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], names=["slot", "n"])

    repeated = held.select("text").mapInArrow(tokens, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    repeated = cut_lineage(repeated)
    frequency = np.zeros(COUNTERS, np.int64)
    for r in repeated.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # COUNTERS rows
        frequency[r["slot"]] = r["n"]
    shared = texts.sparkSession.sparkContext.broadcast((frequency, key_bitmap(repeated, "shingle", REPEATED_BITS)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            text, code = shingle_sets(rows.column("text"), shingle)
            frequency, repeated_bits = shared.value
            key = code.view(np.int64)
            common = maybe_set(repeated_bits, key)
            order = np.lexsort((code, frequency[np.mod(key, COUNTERS)], common, text))
            text, code, common = text[order], code[order], common[order]
            size = np.bincount(text, minlength=rows.num_rows)
            place = np.arange(len(text)) - np.searchsorted(text, np.arange(rows.num_rows))[text]
            keep = common & (place <= size[text] - -(-size[text] * percent // 100))  # a shingle of one set meets nothing
            take = pa.array(text[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(code[keep].view(np.int64)), rows.column("node").take(take), rows.column("comp").take(take), pa.array(place[keep]), pa.array(size[text[keep]])],
                names=["shingle", "node", "comp", "place", "size"],
            )

    entries = held.mapInArrow(prefixes, "shingle long, node binary, comp binary, place long, size long")
    side = lambda s: entries.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "comp", "place", "size")])
    left, right = side("a"), side("b")
    reach = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) * (100 + percent)
    possible = (F.col("comp_a") < F.col("comp_b")) & (reach >= percent * (F.col("size_a") + F.col("size_b")))
    possible = possible & (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    return left.join(right, "shingle").where(possible).select(F.col("node_a").alias("hub"), F.col("node_b").alias("node")).distinct()


def components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, code of its text, n_shingles, component_id (smallest id reachable by links), kept."""
    rows = cut_lineage(document_sketches(docs, shingle))
    classes = cut_lineage(
        rows.where(F.col("n_shingles") > 0)
        .groupBy(F.col("digest").alias("node"))
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "code")).alias("own"),  # the row whose text stands for the class
            F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers"),
        )
    )
    bands = classes.select("node", "registers").mapInArrow(_bands, "node binary, bucket long")
    shared = cut_lineage(bands.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > 1))
    at = F.xxhash64("bucket").alias("at")  # buckets are alike in their last registers
    repeated = maybe_among(bands.select("*", at), "at", shared.select(at), REPEATED_BITS).drop("at")
    members = cut_lineage(repeated.join(shared, "bucket"))
    central = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(central, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top"))
    stars = (
        members.join(hubs.select("bucket", F.col("top.node").alias("hub")), "bucket")
        .where(F.col("hub") != F.col("node"))
        .select("hub", "node")
        .distinct()
    )
    candidates = cut_lineage(likely(stars, classes, percent))
    wanted = cut_lineage(central.select("node").join(classes.select("node", "own.*"), "node"))
    key = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("code"), "text")
    key = maybe_among(key, "code", wanted.select("code")).withColumn("row", F.xxhash64("doc_id", "code"))
    # joined by one code of id and text, so that repeated rows are found where they are
    wanted = wanted.select(F.xxhash64("doc_id", "code").alias("row"), F.col("doc_id").alias("own_id"), F.col("code").alias("own_code"), "node")
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("code") == F.col("own_code"))
    own = key.join(wanted, "row").groupBy("row", "node").agg(F.max(F.when(same, F.col("text"))).alias("text"))
    texts = cut_lineage(own.where(F.col("text").isNotNull()).select("node", "text"))
    links = cut_lineage(confirmed(candidates, texts, percent, shingle))
    reached = connected_components(central.select("node"), links)
    # what the hubs left apart: classes of buckets with several components
    placed = members.join(reached, "node")
    split = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("bucket")
    apart = cut_lineage(placed.join(split, "bucket").select("node", "comp").distinct())
    more = cut_lineage(confirmed(cut_lineage(rest_pairs(texts, apart, percent, shingle)), texts, percent, shingle))
    if more.limit(1).count():
        reached = connected_components(central.select("node"), links.unionByName(more))
    named = reached.join(classes.select("node", "least"), "node")
    names = named.groupBy("comp").agg(F.min("least").alias("name"))
    found = classes.select(F.col("node").alias("digest"), "least").join(
        named.join(names, "comp").select(F.col("node").alias("digest"), "name"), "digest", "left"
    )
    return (
        rows.select("doc_id", "code", "digest", "n_shingles")
        .join(found, "digest", "left")
        .select(
            "doc_id",
            "code",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("name", "least")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
