"""Keywords and word counts over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.listing import short_label
from marketloom.operators.groups import topk_by_count
from marketloom.operators.lookup import bounded_local, spread
from marketloom.session import cut_lineage

# Words hinting at quality and at a low price, and words left out of the word cloud.
QUALITY_WORDS = ("premium", "best", "quality", "certified", "genuine", "authentic")
BUDGET_WORDS = ("cheap", "budget", "economy", "basic", "simple")
CLOUD_STOP_WORDS = (
    "model", "type", "new", "quality", "best", "for", "the", "and", "with", "pro", "standard", "grade", "series",
    "version", "style", "a", "an",
)

# Default English function words left out before n-grams are built; callers may pass their own list.
ENGLISH_STOP_WORDS = tuple(
    """a about above after again against all almost alone along already also although always am among an and another any
    anyone anything are around as at back be became because become been before behind being below between beyond both
    but by can cannot could did do does done down due during each eight either else enough etc even ever every everyone
    everything except few first five for four from full further get give go had has have having he hence her here hers
    herself him himself his how however if in indeed into is it its itself just last least less made many may me might
    mine more moreover most mostly much must my myself namely neither never next nine no nobody none nor not nothing now
    of off often on once one only onto or other others our ours out over own per perhaps please rather same see seem she
    should since six so some someone still such ten than that the their them then there these they this those though
    three through thus to together too toward two under until up upon us very was we well were what when where which
    while who whole whose why will with within without would yet you your yours""".split()
)

WORD = r"[\p{L}\p{N}_]{2,}"
CLOUD_WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"
COLLOCATION_THRESHOLD = 30.0
CLOUD_LABEL = 18
MAX_FEATURES = 100
MASK_WORDS = 10_000


def word_list(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-case words of two or more characters, stop words removed, in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def _word_table(df: DataFrame, column: str, key: str, stop_words: Sequence[str]) -> DataFrame:
    """(doc, words). The one-row generator makes the words a stored column, so they are not recomputed at each use."""
    words = F.struct(word_list(F.col(column), stop_words).alias("words"))
    rows = spread(df.select(F.col(key).alias("doc"), column))
    return rows.select("doc", F.inline(F.array(words)))


def _ngrams(words: Column, longest: int) -> Column:
    """All 1..longest-grams; a null word breaks the n-grams across it."""
    grams = [words]
    for n in range(2, longest + 1):
        tail = F.slice(words, n, F.greatest(F.size(words), F.lit(1)))
        grams.append(F.zip_with(grams[-1], tail, lambda g, w: F.concat(g, F.lit(" "), w)))
    return F.filter(F.flatten(F.array(*grams)), lambda g: g.isNotNull())


def _frequent_words(docs: DataFrame, min_df: int, k: int) -> list[str] | None:
    """Words that can be part of a top-k term: at least as frequent as the k-th most frequent admissible word.

    A term never occurs more often than any of its words, so no other word can appear in one. None means there are too
    many to list (many ties), and nothing is ruled out.
    """
    lists = docs.select(F.posexplode(F.array("words", F.array_distinct("words"))).alias("distinct", "list"))
    counts = cut_lineage(  # read twice below
        lists.select("distinct", F.explode("list").alias("word"))
        .groupBy("word")
        .agg(F.count_if(F.col("distinct") == 0).alias("tf"), F.count_if(F.col("distinct") == 1).alias("df"))
        .where(F.col("df") >= min_df)
    )
    top = counts.orderBy(F.desc("tf")).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("tf").alias("floor")).first()
    floor = top["floor"] if top["n"] == k else 0
    rows = bounded_local(counts.where(F.col("tf") >= floor).select("word"), MASK_WORDS)
    return None if rows is None else [r["word"] for r in rows.collect()]


def tfidf_keywords(
    df: DataFrame,
    column: str = "product_name",
    key: str = "id",
    k: int = 30,
    max_features: int = MAX_FEATURES,
    min_df: int = 2,
    longest: int = 3,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Mean smoothed tf-idf weight over all documents of the most frequent 1..3-grams; the k heaviest terms.

    Terms in fewer than ``min_df`` documents are left out first; of the rest the ``max_features`` most frequent are
    kept, ties in alphabetical order. Documents are normalised over the kept terms.
    """
    docs = _word_table(df, column, key, stop_words)
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    frequent = _frequent_words(docs, min_df, max_features)
    if frequent is not None:
        docs = docs.withColumn("words", F.transform("words", lambda w: F.when(w.isin(*frequent), w)))
    counts = cut_lineage(  # read for the kept terms and for the weights, so that texts are not split again
        docs.select("doc", F.explode(_ngrams(F.col("words"), longest)).alias("term"))
        .groupBy("doc", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    kept = (
        counts.groupBy("term")
        .agg(F.sum("tf").alias("count"), F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= min_df)
        .orderBy(F.desc("count"), F.asc("term"))
        .limit(max_features)
    )
    weights = (
        # The kept terms are at most max_features rows.
        counts.join(F.broadcast(kept), "term")
        .withColumn("n_docs", n_docs)
        .withColumn("w", F.col("tf") * (F.ln((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1))
    )
    # A document's kept terms, at most max_features, meet once for its length.
    vectors = weights.where(F.col("doc").isNotNull()).groupBy("doc").agg(
        F.collect_list(F.struct("term", "w", "n_docs")).alias("terms"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length")
    )
    return (
        vectors.select("length", F.inline("terms"))
        .groupBy("term")
        .agg((F.sum(F.col("w") / F.col("length")) / F.max("n_docs")).alias("score"))
        .orderBy(F.desc("score"), F.asc("term"))
        .limit(k)
    )


def name_patterns(df: DataFrame) -> DataFrame:
    """Most frequent category with its count, and the mean name length."""
    top = topk_by_count(df, "category", 1)
    return top.select(
        F.col("category").alias("dominant_category"), F.col("count").alias("dominant_count")
    ).withColumn("avg_name_length", df.agg(F.avg(F.length("product_name"))).scalar())


def quality_word_counts(df: DataFrame, column: str = "product_name") -> DataFrame:
    """Per word set: hits (a row counts once per word it contains), rows with any hit, and hits per 100 rows."""
    text = F.lower(F.coalesce(F.col(column), F.lit("")))

    def hits(words: Sequence[str]) -> Column:
        return sum((text.contains(w).cast("int") for w in words), F.lit(0))

    sets = {"quality": QUALITY_WORDS, "budget": BUDGET_WORDS}
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(hits(w).cast("long")), F.lit(0)).alias(f"{name}_hits") for name, w in sets.items()],
        *[F.count_if(hits(w) > 0).alias(f"{name}_rows") for name, w in sets.items()],
    )
    cells = [
        F.struct(
            F.lit(name).alias("word_set"),
            F.col(f"{name}_hits").alias("hits"),
            F.col(f"{name}_rows").alias("rows_with_hit"),
            F.try_divide(F.col(f"{name}_hits") * 100, F.col("n")).alias("hits_pct"),
        )
        for name in sets
    ]
    return totals.select(F.inline(F.array(*cells)))


def word_frequencies(
    df: DataFrame, column: str = "product_name", k: int = 120, stop_words: Sequence[str] = CLOUD_STOP_WORDS
) -> DataFrame:
    """Most frequent words for a word cloud; the weight is relative to the most frequent one.

    Possessive endings are cut off, and bare numbers are left out.
    """
    raw = F.explode(F.regexp_extract_all(F.lower(F.col(column)), F.lit(CLOUD_WORD), 0))
    words = spread(df.select(column)).select(raw.alias("word")).select(F.regexp_replace("word", "'s$", "").alias("word"))
    words = words.where(~F.col("word").isin(*stop_words))
    words = words.where(~F.col("word").rlike(r"^\p{Nd}+$"))
    top = topk_by_count(words, "word", k)
    return top.withColumn("weight", F.col("count") / top.agg(F.max("count")).scalar())


def _log_likelihood_ratio(both: Column, first: Column, second: Column, n: Column) -> Column:
    """Dunning's ratio of a pair of neighbouring words against independence (Manning and Schuetze 1999, 5.3.4)."""

    def log_l(k: Column, of: Column, p: Column) -> Column:
        bounded = lambda x: F.ln(F.greatest(x, F.lit(1e-10)))
        return bounded(p) * k + bounded(1 - p) * (of - k)

    p, p1, p2 = second / n, both / first, F.try_divide(second - both, n - first)
    ratio = log_l(both, first, p) + log_l(second - both, n - first, p) - log_l(both, first, p1) - log_l(second - both, n - first, p2)
    return F.when((n <= first) | (n <= second), F.lit(0.0)).otherwise(-2 * ratio)


def _singular(word: Column) -> Column:
    """The word without its last s, where it may be a plural."""
    plural = word.endswith("s") & ~word.endswith("ss") & (F.length(word) > 1)
    return F.when(plural, word.substr(F.lit(1), F.length(word) - 1))


def _folded(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., word, count) with ``form``: the singular where that occurs too. The counts are stored, as both sides of a join read them."""
    counts = cut_lineage(counts)
    known = counts.select(*keys, F.col("word").alias("one"), F.lit(True).alias("known"))
    found = counts.withColumn("one", _singular(F.col("word"))).join(known, [*keys, "one"], "left")
    return found.select(*keys, "word", "count", F.when(F.col("known"), F.col("one")).otherwise(F.col("word")).alias("form"))


def _pair_counts(lists: DataFrame, stop_words: Sequence[str], frequent: Sequence[str] | None) -> DataFrame:
    """(first, word, count) of neighbouring words, none of them a stop word, at least one of them frequent."""
    after = F.slice("words", 2, F.greatest(F.size("words"), F.lit(1)))
    pair = F.inline(F.zip_with("words", after, lambda a, b: F.struct(a.alias("first"), b.alias("word"))))
    pairs = lists.select(pair).where(F.col("word").isNotNull() & ~F.col("first").isin(*stop_words) & ~F.col("word").isin(*stop_words))
    if frequent is not None:
        pairs = pairs.where(F.col("first").isin(*frequent) | F.col("word").isin(*frequent))
    return pairs.groupBy("first", "word").agg(F.count(F.lit(1)).alias("count"))


def word_cloud(
    df: DataFrame,
    column: str = "product_name",
    k: int = 120,
    stop_words: Sequence[str] = CLOUD_STOP_WORDS,
    threshold: float = COLLOCATION_THRESHOLD,
) -> DataFrame:
    """The k most frequent words and collocations of a word cloud, with their weight relative to the first and a cut label.

    Words are as in ``word_frequencies``; plurals count for their singular where that occurs. Two neighbouring words of a text, numbers
    left out, that occur together far more often than by chance (log-likelihood ratio above ``threshold``) are a term of their own,
    and its count is taken off both words.

    Only pairs with a frequent word are shuffled: a term never counts more than its words, so once the k-th count reaches the
    frequency asked for, nothing else could have mattered. Until it does, the frequency asked for is halved.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(CLOUD_WORD), 0)
    bare = F.transform(words, lambda w: F.regexp_replace(w, "'s$", ""))
    lists = spread(df.select(column)).select(F.filter(bare, lambda w: ~w.rlike(r"^\p{Nd}+$")).alias("words"))
    raw = lists.select(F.explode("words").alias("word")).where(~F.col("word").isin(*stop_words))
    forms = cut_lineage(_folded(raw.groupBy("word").agg(F.count(F.lit(1)).alias("count"))))
    counts = cut_lineage(forms.groupBy(F.col("form").alias("word")).agg(F.sum("count").alias("count")))
    n = counts.agg(F.sum("count")).first()[0] or 0
    top = counts.orderBy(F.desc("count")).limit(4 * k).agg(F.count("*").alias("n"), F.min("count").alias("floor")).first()
    floor = top["floor"] if top["n"] == 4 * k else 0
    sizes = cut_lineage(forms.select("word", "form").join(counts.select(F.col("word").alias("form"), F.col("count").alias("n")), "form"))
    size_of = lambda name, side: sizes.select(F.col("word").alias(name), F.col("form").alias(f"form_{side}"), F.col("n").alias(f"n_{side}"))
    while True:
        frequent = None
        if floor > 0:
            wanted = forms.join(counts.where(F.col("count") >= floor).select(F.col("word").alias("form")), "form", "left_semi")
            rows = bounded_local(wanted.select("word"), MASK_WORDS)
            frequent = None if rows is None else [r["word"] for r in rows.collect()]
        pairs = _folded(_pair_counts(lists, stop_words, frequent), ["first"])
        pairs = pairs.groupBy("first", F.col("form").alias("word")).agg(F.sum("count").alias("count"))
        sized = pairs.join(size_of("first", "a"), "first").join(size_of("word", "b"), "word")
        both, a, b = (F.col(c).cast("double") for c in ("count", "n_a", "n_b"))
        kept = cut_lineage(sized.where(_log_likelihood_ratio(both, a, b, F.lit(float(n))) > threshold))
        taken = kept.select(F.explode(F.array("form_a", "form_b")).alias("word"), "count").groupBy("word").agg(F.sum("count").alias("taken"))
        left = counts.join(taken, "word", "left").select("word", (F.col("count") - F.coalesce("taken", F.lit(0))).alias("count"))
        terms = left.where(F.col("count") > 0).unionByName(kept.select(F.concat_ws(" ", "first", "word").alias("word"), "count"))
        found = cut_lineage(terms.orderBy(F.desc("count"), F.asc("word")).limit(k))
        size = found.agg(F.count("*").alias("n"), F.min("count").alias("least"), F.max("count").alias("most")).first()
        if frequent is None or (size["n"] == k and size["least"] >= floor):
            label = short_label(F.col("word"), CLOUD_LABEL).alias("label")
            return found.select("word", "count", (F.col("count") / F.lit(size["most"])).alias("weight"), label)
        floor = floor // 2
