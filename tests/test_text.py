import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketloom.operators import text as T


def brute_tfidf(texts, stop, k, max_features, min_df):
    grams = []
    for t in texts:
        import regex

        words = [w for w in regex.findall(r"[\p{L}\p{N}_]{2,}", (t or "").lower()) if w not in stop]
        grams.append(Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)))
    total, df = Counter(), Counter()
    for g in grams:
        total.update(g)
        df.update(g.keys())
    kept = sorted((t for t in total if df[t] >= min_df), key=lambda t: (-total[t], t))[:max_features]
    score = Counter()
    for g in grams:
        w = {t: g[t] * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t in kept if t in g}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            score[t] += v / norm / len(texts)
    return sorted(((t, s) for t, s in score.items()), key=lambda p: (-p[1], p[0]))[:k]


def corpus(seed):
    rng = random.Random(seed)
    words = ["pump", "gear", "the", "of", "élan", "x", "motor", "valve9", "steel", "and", "hot-rolled", "Big"]
    texts = [" ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 30))) for _ in range(60)]
    return texts + ["pump gear pump gear " * 50, None, ""]


@pytest.mark.parametrize("max_features", [4, 25, 1000])
@pytest.mark.parametrize("mask", [10_000, 0])
def test_tfidf_equals_counting_everything(spark, monkeypatch, max_features, mask):
    monkeypatch.setattr(T, "MASK_WORDS", mask)
    texts = corpus(max_features)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, product_name string")
    got = T.tfidf_keywords(df, k=10, max_features=max_features).collect()
    want = brute_tfidf(texts, set(T.ENGLISH_STOP_WORDS), 10, max_features, 2)
    assert [r["term"] for r in got] == [t for t, _ in want]
    assert [r["score"] for r in got] == pytest.approx([s for _, s in want])


def test_no_documents(spark):
    df = spark.createDataFrame([], "id long, product_name string")
    assert T.tfidf_keywords(df).collect() == []
    assert T.word_frequencies(df).collect() == []
    assert [r["hits"] for r in T.quality_word_counts(df).collect()] == [0, 0]


def test_quality_words_count_once_per_word(spark):
    df = spark.createDataFrame([("Best premium best pump",), ("cheap",), (None,)], "product_name string")
    got = {r["word_set"]: (r["hits"], r["rows_with_hit"]) for r in T.quality_word_counts(df).collect()}
    assert got == {"quality": (2, 1), "budget": (1, 1)}


def test_word_frequencies(spark):
    df = spark.createDataFrame([("The seller's Pump 42 pump's",), ("pump model",)], "product_name string")
    got = {r["word"]: (r["count"], r["weight"]) for r in T.word_frequencies(df).collect()}
    assert got == {"pump": (3, 1.0), "seller": (1, 1 / 3)}


def brute_cloud(texts, k, threshold=30.0):
    import regex

    lists = []
    for t in texts:
        words = [regex.sub("'s$", "", w) for w in regex.findall(r"[\p{L}\p{N}_][\p{L}\p{N}_']*", (t or "").lower())]
        lists.append([w for w in words if not regex.fullmatch(r"\p{Nd}+", w)])
    stop = set(T.CLOUD_STOP_WORDS)

    def fold(counts, last=lambda w: w, cut=lambda w: w[:-1]):
        form = {}
        for w in counts:
            plural = last(w).endswith("s") and not last(w).endswith("ss") and len(last(w)) > 1
            form[w] = cut(w) if plural and cut(w) in counts else w
        out = Counter()
        for w, c in counts.items():
            out[form[w]] += c
        return out, form

    counts, form = fold(Counter(w for ws in lists for w in ws if w not in stop))
    raw_pairs = Counter((a, b) for ws in lists for a, b in zip(ws, ws[1:]) if a not in stop and b not in stop)
    pairs, _ = fold(raw_pairs, lambda p: p[1], lambda p: (p[0], p[1][:-1]))
    n, left = sum(counts.values()), Counter(counts)
    log_l = lambda k, of, p: math.log(max(p, 1e-10)) * k + math.log(max(1 - p, 1e-10)) * (of - k)
    for (a, b), c in pairs.items():
        a1, b1 = form[a], form[b]
        c1, c2 = counts[a1], counts[b1]
        if n <= c1 or n <= c2:
            continue
        p, p1, p2 = c2 / n, c / c1, (c2 - c) / (n - c1)
        if -2 * (log_l(c, c1, p) + log_l(c2 - c, n - c1, p) - log_l(c, c1, p1) - log_l(c2 - c, n - c1, p2)) > threshold:
            left[a1] -= c
            left[b1] -= c
            left[f"{a} {b}"] += c
    return sorted(((w, c) for w, c in left.items() if c > 0), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("k", [5, 40])
def test_word_cloud_counts_collocations_and_folds_plurals(spark, k):
    rng = random.Random(k)
    words = ["pump", "pumps", "gear", "gears", "glass", "the", "ball", "bearing", "bearings", "42", "Valve's", "rare", "élan", "x", "s"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 9)) + ["ball", "bearing" + "s" * rng.randint(0, 1)] * rng.randint(0, 2)) for _ in range(150)]
    texts += [None, "", *[f"word{i} other{i}" for i in range(60)]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, product_name string")
    got = [(r["word"], r["count"]) for r in T.word_cloud(df, k=k).orderBy(F.desc("count"), "word").collect()]
    assert got == brute_cloud(texts, k) and any(" " in w for w, _ in got)
    assert T.word_cloud(df.where("id < 0")).collect() == []


@pytest.mark.parametrize(("operator", "splits"), [("tfidf_keywords", 2), ("word_cloud", 2)])
def test_texts_are_split_once_for_words_and_once_for_terms(spark, tmp_path, operator, splits):
    """Counts that are read twice are stored; each text is looked at once to count words and once to count pairs or n-grams."""
    rows = [(i, f"red cars and a blue car near {i % 7} new york cities" + " city new york" * (i % 3)) for i in range(40)]
    spark.createDataFrame(rows, "id long, text string").repartition(8).write.parquet(f"{tmp_path}/texts")
    looked = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            looked.add(batch.num_rows)
            yield batch

    texts = spark.read.parquet(f"{tmp_path}/texts").mapInArrow(counting, "id long, text string")
    key = ["id"] if operator == "tfidf_keywords" else []
    found = getattr(T, operator)(texts.select("id", F.col("text").alias("text")), "text", *key, k=3).collect()
    assert len(found) == 3
    assert looked.value <= (splits + (operator == "tfidf_keywords")) * len(rows)  # the number of documents is counted once
