"""Documents whose sets of word n-grams are similar, by a rare-first prefix join.

A document's set is its distinct word n-grams; documents of equal sets are one class from the first step on. Two sets with a similarity of
``percent`` or more share an n-gram among the first of both, in any order of n-grams that all sets follow: among the first
n - ceil(t n) + 1 of the larger one (its probe prefix) and the first n - ceil(2 t n / (1 + t)) + 1 of the smaller one (its index prefix).

1. ``survivors``: such a set has at most n - ceil(t n) n-grams that no other set holds, so sets with more of them in the lower half of the code
   range are done. Documents with a common passage and a text of their own go here.
2. ``prefixes``: among the survivors n-grams are counted, and each class's n-grams are ordered from rare to frequent. Those that no other
   survivor holds come first and are only counted, so a class with many of them has no prefix left.
3. Prefix entries are joined on the n-gram. A pair is a candidate only if sizes fit (length filter) and the n-grams behind the common
   one can reach the threshold on both sides (positional filter). Pairs are made distinct, then compared by how many n-grams each has in
   ``BLOCKS`` blocks of the code range, which bounds how far the whole sets are apart (suffix filter), and verified once on the full sets.

A group of near copies shares nearly all its prefix n-grams, so pairs are taken in turns: first each class of an n-gram's group with the most
central one (whose n-grams are held most often), then what is left apart with others of the group's largest component, a different one
for every n-gram and turn; after each turn linked classes are one component. A turn gives no more pairs than entries. Only then the rest is
joined: pairs of an n-gram's group that lie in different components and were not verified before. No link between components is lost, and
groups whose members are linked cost no square.

Both counts go through ``dealt``: a task deals the different n-grams of a slice of documents into buckets by code, packed, each with the document that holds it or
a mark that several do; a bucket counts in how many slices and documents each occurs and answers every slice. So an n-gram that a third
of all documents hold comes once per slice. The first count knows an n-gram by its bucket and 32 more bits: what is taken for another n-gram by mistake only
lets a document survive.

N-grams are compared by 64-bit codes, classes by 64 bits over all codes of a set. Nulls and short texts: fewer words than an n-gram make one n-gram
of the whole sequence; a text without words, or a null, has an empty set, is linked with nothing and is its own component. Rows that
repeat a doc_id are rows of one id, each by its own text; a null doc_id never names a component. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.keyfilter import maybe_among
from marketloom.llm.near_dedup import shingle_sets
from marketloom.llm.words import mix, slices
from marketloom.operators.components import connected_components
from marketloom.session import cut_lineage

WORDS = 5
PERCENT = 80
BLOCKS = 32
TURNS = 3
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 4 << 20
SLICE_GRAMS = 1 << 20
BUCKET_GRAMS = 1 << 20
SEVERAL = 0xFFFF  # in place of a document's number in its slice
MOST_ROWS = 60_000
ROWS = "doc_id long, row long, class long, n long"
SETS = "class long, n int, blocks array<int>, grams array<long>"
DEALT = "slice long, bucket int, kind int, grams binary, owner binary, held binary"
PASSED = 0  # kinds of a dealt row: what the slice keeps for itself, and what a bucket counts
COUNTED = 1


def _allowed(n, percent: int):
    """How many n-grams of a set of ``n`` a partner of it may lack."""
    return n - -(-n * percent // 100)


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))


def document_rows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, a code of the row, and the class and size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            text, code = shingle_sets(rows.column("text"), words)
            first = np.searchsorted(text, np.arange(rows.num_rows + 1))
            size = np.diff(first)
            run_sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(code ^ GOLDEN))])
            class_of = mix(run_sum[first[1:]] - run_sum[first[:-1]] + size.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("row"), pa.array(class_of.view(np.int64)), pa.array(size, pa.int64())],
                names=["doc_id", "row", "class", "n"],
            )

    return _keyed(docs).mapInArrow(run, ROWS)


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("row"), "text")


def _bits(grams: int) -> int:
    """Bits of the code that name a bucket, so that a bucket holds about ``BUCKET_GRAMS``."""
    return max(3, int(np.ceil(np.log2(max(grams, 1) / BUCKET_GRAMS))))


def _row(number: int, bucket: int, kind: int, grams: np.ndarray, owner: np.ndarray, held: np.ndarray) -> tuple:
    return number, bucket, kind, grams.tobytes(), owner.tobytes(), held.tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["slice", "bucket", "kind", "grams", "owner", "held"])


def dealt(number: int, owner: np.ndarray, code: np.ndarray, bits: int, keep: np.ndarray) -> pa.RecordBatch:
    """The rows of one slice: its different codes by bucket, with their document (or ``SEVERAL``) and how many hold them, and one row that
    stays with the slice: ``keep`` and the (code, document) pairs of codes that several documents hold."""
    order = np.lexsort((owner, code))
    code, owner = code[order], owner[order].astype(np.uint16)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    held = np.diff(np.append(first, len(code)))
    several = np.repeat(held > 1, held)
    one, whose = code[first], np.where(held > 1, SEVERAL, owner[first]).astype(np.uint16)
    bucket = (one >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(one) else []
    rows = [_row(number, number % (1 << bits), PASSED, code[several], owner[several], keep)]
    for lo, hi in zip(cuts, np.append(cuts[1:], len(one)) if len(one) else []):
        rows.append(_row(number, int(bucket[lo]), COUNTED, one[lo:hi], whose[lo:hi], np.minimum(held[lo:hi], 1 << 30).astype(np.uint32)))
    return _batch(rows)


def _columns(rows: pa.Table, kind: int, code: type) -> tuple[list[int], list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    some = rows.filter(pa.compute.equal(rows.column("kind"), kind))
    read = lambda c, t: [np.frombuffer(v, t) for v in some.column(c).to_pylist()]
    return some.column("slice").to_pylist(), read("grams", code), read("owner", np.uint16), some.column("held").to_pylist()


def _answers(rows: pa.Table, code: type, unique: bool) -> pa.Table:
    """For every slice of a bucket: the owners of codes that nothing else holds (``unique``), or the codes held more than once with
    their owners and how often they are held; what slices keep for themselves is passed on."""
    number, grams, owner, held = _columns(rows, COUNTED, code)
    out = [rows.filter(pa.compute.equal(rows.column("kind"), PASSED)).select(["slice", "bucket", "kind", "grams", "owner", "held"])]
    if number:
        every = np.concatenate(grams)
        counts = np.concatenate([np.frombuffer(h, np.uint32) for h in held]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.append(True, every[order][1:] != every[order][:-1]))
        spans = np.diff(np.append(first, len(every)))
        total = np.empty(len(every), np.int64)
        total[order] = np.repeat(np.add.reduceat(counts[order], first), spans)
        ends = np.cumsum([len(g) for g in grams])
        found = []
        for i, g, o, end in zip(number, grams, owner, ends):
            own = total[end - len(g) : end]
            at = np.flatnonzero(own == 1) if unique else np.flatnonzero(own > 1)
            left = np.zeros(0, np.uint64) if unique else g[at]
            found.append(_row(i, 0, COUNTED, left, o[at], np.zeros(0, np.uint32) if unique else np.minimum(own[at], 1 << 30).astype(np.uint32)))
        out.append(pa.Table.from_batches([_batch(found)]))
    return pa.concat_tables([t.cast(out[-1].schema) for t in out])


def survivors(docs: DataFrame, rows: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(class, row): the classes that do not hold too many n-grams of their own, each with the row that stands for it."""
    bits = _bits((rows.agg(F.sum("n")).first()[0] or 0) // 2)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, "text", SLICE_BYTES):
            for at in range(0, part.num_rows, MOST_ROWS):
                some = part.slice(at, MOST_ROWS)
                text, code = shingle_sets(some.column("text"), words)
                size = np.bincount(text, minlength=some.num_rows)
                low = code >> np.uint64(63) == 0
                # The bit that is 0 is left out, so that buckets are full.
                batch = dealt(number, text[low], code[low] << np.uint64(1), bits, np.stack([some.column("row").to_numpy(), size], 1))
                number += 1
                kept = [g if k == PASSED else _after(g, bits) for g, k in zip(batch.column("grams").to_pylist(), batch.column("kind").to_pylist())]
                kept[0] = b""
                yield batch.set_column(3, "grams", pa.array(kept, pa.binary()))

    def single(part: pa.Table) -> pa.Table:
        _, _, owners, _ = _columns(part, COUNTED, np.uint64)
        _, _, _, keep = _columns(part, PASSED, np.uint64)
        row, size = np.frombuffer(keep[0], np.int64).reshape(-1, 2).T
        own = np.bincount(np.concatenate(owners) if owners else np.zeros(0, np.int64), minlength=len(row))
        fine = (size > 0) & (own <= _allowed(size, percent))
        return pa.table({"row": row[fine]})

    counted = _keyed(docs).select("row", "text").mapInArrow(deal, DEALT).groupBy("bucket")
    answers = counted.applyInArrow(lambda t: _answers(t, np.uint32, True), DEALT)
    found = cut_lineage(answers.groupBy("slice").applyInArrow(single, "row long"))
    own = rows.where(F.col("n") > 0).groupBy("class").agg(F.min("row").alias("row"))
    return own.join(found.distinct(), "row", "left_semi")


def _after(grams: bytes, bits: int) -> bytes:
    """The 32 bits behind the bucket's of each code."""
    codes = np.frombuffer(grams, np.uint64)
    return (codes << np.uint64(bits) >> np.uint64(32)).astype(np.uint32).tobytes()


def full_sets(docs: DataFrame, chosen: DataFrame, words: int = WORDS) -> DataFrame:
    """The sets of the chosen classes (class, row), with their sizes and their counts in blocks of the code range."""
    texts = maybe_among(_keyed(docs).select("row", "text"), "row", chosen.select("row")).join(chosen, "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            text, code = shingle_sets(rows.column("text"), words)
            n = rows.num_rows
            first = np.searchsorted(text, np.arange(n + 1))
            block = (code >> np.uint64(59)).astype(np.int64)
            counts = np.bincount(text * BLOCKS + block, minlength=n * BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("class"),
                    pa.array(np.diff(first), pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BLOCKS, pa.int32()), pa.array(counts, pa.int32())),
                    _lists(code, first),
                ],
                names=["class", "n", "blocks", "grams"],
            )

    return texts.select("class", "text").dropDuplicates(["class"]).mapInArrow(run, SETS)


def prefixes(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(gram, class, n, place, indexed, central): the probe prefix of each set from rare to frequent n-grams, those no other set holds
    left out; ``central`` is how often the set's n-grams are held on average."""
    bits = _bits(sets.agg(F.sum("n")).first()[0] or 0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = batch.column("n").to_numpy()
            ends = np.cumsum(size)
            at = 0
            while at < batch.num_rows:
                start = ends[at] - size[at]
                to = min(max(at + 1, int(np.searchsorted(ends, start + SLICE_GRAMS, "right"))), at + MOST_ROWS)
                codes = batch.column("grams").slice(at, to - at).flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(to - at), size[at:to])
                keep = np.stack([batch.column("class").to_numpy()[at:to], size[at:to].astype(np.int64)], 1)
                yield dealt(number, owner, codes, bits, keep)
                number, at = number + 1, to

    def ordered(part: pa.Table) -> pa.Table:
        _, grams, owners, held = _columns(part, COUNTED, np.uint64)
        _, shared, sharers, keep = _columns(part, PASSED, np.uint64)
        class_of, size = np.frombuffer(keep[0], np.int64).reshape(-1, 2).T
        code = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner = np.concatenate(owners).astype(np.int64) if grams else np.zeros(0, np.int64)
        count = np.concatenate([np.frombuffer(h, np.uint32) for h in held]) if grams else np.zeros(0, np.uint32)
        # Codes that several documents of the slice hold: their answer goes to each of them.
        many = np.flatnonzero(owner == SEVERAL)
        many = many[np.argsort(code[many])]
        at = many[np.searchsorted(code[many], shared[0])] if len(many) else np.zeros(0, np.int64)
        alone = owner != SEVERAL
        code, owner, count = (
            np.concatenate([code[alone], shared[0]]), np.concatenate([owner[alone], sharers[0].astype(np.int64)]), np.concatenate([count[alone], count[at]])
        )
        order = np.lexsort((code, count, owner))
        code, owner, held_by = code[order], owner[order], count[order]
        first = np.searchsorted(owner, np.arange(len(size) + 1))
        n = size[owner]
        place = n - np.diff(first)[owner] + np.arange(len(owner)) - first[owner]
        keep = place <= _allowed(n, percent)
        indexed = place <= n - -(-2 * n * percent // (100 + percent))
        return pa.table(
            {
                "gram": code[keep].view(np.int64),
                "class": class_of[owner[keep]],
                "n": pa.array(n[keep], pa.int32()),
                "place": pa.array(place[keep], pa.int32()),
                "indexed": indexed[keep],
                "central": (np.bincount(owner, weights=held_by, minlength=len(size)) / size)[owner[keep]],
            }
        )

    counted = sets.select("class", "n", "grams").mapInArrow(deal, DEALT).groupBy("bucket")
    answers = counted.applyInArrow(lambda t: _answers(t, np.uint64, False), DEALT)
    return answers.groupBy("slice").applyInArrow(ordered, "gram long, class long, n int, place int, indexed boolean, central double")


def _pairs(left: DataFrame, right: DataFrame, percent: int, apart: bool = True) -> DataFrame:
    """(a, b) with a < b: an n-gram in the index prefix of the smaller and the probe prefix of the larger set, filtered by
    length and position."""
    side = lambda d, s: d.select("gram", *[F.col(c).alias(f"{c}_{s}") for c in ("class", "n", "place", "indexed", "comp")])
    left, right = side(left, "a"), side(right, "b")
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    indexed = F.when(F.col("n_a") < F.col("n_b"), F.col("indexed_a")).when(F.col("n_a") > F.col("n_b"), F.col("indexed_b"))
    ahead = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) * (100 + percent)
    possible = (
        (F.col("comp_a") != F.col("comp_b"))
        & (100 * small >= percent * large)
        & indexed.otherwise(F.col("indexed_a") | F.col("indexed_b"))
        & (ahead >= percent * (F.col("n_a") + F.col("n_b")))
    )
    if not apart:
        possible = possible & (F.col("comp_a") < F.col("comp_b"))
    ends = F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")
    return left.join(right, "gram").where(possible).select(*ends).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full sets are similar enough, after the suffix filter."""
    side = lambda s, *columns: sets.select(F.col("class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    total = F.col("n_a") + F.col("n_b")
    needed = F.floor((total * percent + 100 + percent - 1) / (100 + percent))
    apart = F.aggregate(F.zip_with("blocks_a", "blocks_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda x, y: x + y)
    near = (
        pairs.join(side("a", "n", "blocks"), "a")
        .join(side("b", "n", "blocks"), "b")
        .where(apart <= total - 2 * needed)
        .select("a", "b", "n_a", "n_b")
    )
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    full = near.join(side("a", "grams"), "a").join(side("b", "grams"), "b")
    return full.where(100 * both >= percent * (total - both)).select("a", "b")


def links(sets: DataFrame, percent: int = PERCENT, turns: int = TURNS) -> DataFrame:
    """(node, comp): the component of every class of ``sets``; every link between two components would have been found."""
    entries = cut_lineage(prefixes(sets, percent))
    nodes = cut_lineage(entries.select(F.col("class").alias("node")).distinct())
    reached = nodes.select("node", F.col("node").alias("comp"))
    edges = tried = None
    for turn in range(turns + 1):
        placed = entries.join(reached.withColumnRenamed("node", "class"), "class")
        split = placed.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max("indexed").alias("any"))
        open_grams = split.where("low <> high and any").select("gram")
        placed = cut_lineage(placed.join(open_grams, "gram"))
        if turn < turns:
            # One class stands for each n-gram's group: the most central one, later any one of the largest component.
            if turn == 0:
                hubs = placed.groupBy("gram").agg(F.max(F.struct("central", "class"))["class"].alias("class"))
            else:
                draw = F.min_by("class", F.xxhash64("class", "gram", F.lit(turn))).alias("drawn")
                by_comp = placed.groupBy("gram", "comp").agg(F.count("*").alias("size"), draw)
                hubs = by_comp.groupBy("gram").agg(F.max(F.struct("size", "comp", "drawn"))["drawn"].alias("class"))
            pairs = _pairs(placed.join(hubs, ["gram", "class"], "left_semi"), placed, percent)
        else:
            pairs = _pairs(placed, placed, percent, apart=False)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        found = cut_lineage(verified(pairs, sets, percent))
        tried = pairs if tried is None else tried.unionByName(pairs)
        edges = found if edges is None else edges.unionByName(found)
        if found.limit(1).count():
            reached = connected_components(nodes, edges)
    return reached


def components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links) and class (equal for equal sets)."""
    rows = cut_lineage(document_rows(docs, words))
    sets = cut_lineage(full_sets(docs, cut_lineage(survivors(docs, rows, percent, words)), words))
    reached = links(sets, percent).select(F.col("node").alias("class"), "comp")
    least = rows.where(F.col("n") > 0).groupBy("class").agg(F.min("doc_id").alias("least"))
    named = least.join(reached, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    names = named.groupBy("comp").agg(F.min("least").alias("name"))
    found = named.join(names, "comp").select("class", "name")
    return (
        rows.select("doc_id", "class", F.col("n").alias("n_shingles"))
        .join(found, "class", "left")
        .select("doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id"), "class")
    )
