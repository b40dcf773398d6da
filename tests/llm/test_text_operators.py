import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm import decontaminate, near_dedup, substring_dedup
from marketloom.llm.words import ALPHANUMERIC, Words, grams, slices
from tests.llm.conftest import ALNUM, SPACED, lower


def test_words_and_grams_name_equal_runs_alike():
    texts = ["The cat  sat\n\x0bon", None, "", "cat the cat sat on mat", "éa b the"]
    words = Words(pa.array(texts), lower=True)
    assert words.counts.tolist() == [4, 0, 0, 6, 3]
    spelled = [w for t in texts for w in SPACED.findall(lower(t))]
    codes = words.codes()
    for n in (1, 2, 3, 5):
        seen = defaultdict(set)
        for i in np.flatnonzero(words.room(n)):
            seen[tuple(spelled[i : i + n])].add(int(grams(codes, n)[i]))
        assert all(len(v) == 1 for v in seen.values())
        assert len({next(iter(v)) for v in seen.values()}) == len(seen)


def test_alphanumeric_words():
    words = Words(pa.array(["A-b c9,été_x"]), ALPHANUMERIC, lower=True)
    assert [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)] == ALNUM.findall("a-b c9,été_x")


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "", "c"]})
    assert [r for s in slices(iter([batch]), "text", 20) for r in s.column("text").to_pylist()] == batch.column("text").to_pylist()


def brute_substring(rows, window):
    docs = [(i, SPACED.findall(t or "")) for i, t, _ in rows]
    count = Counter(tuple(w[k : k + window]) for _, w in docs for k in range(len(w) - window + 1))
    out = []
    for i, w in docs:
        gone = {p for k in range(len(w) - window + 1) if count[tuple(w[k : k + window])] > 1 for p in range(k, k + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [35, 6])
def test_substring_dedup(documents, odd_rows, window):
    rows = odd_rows + [
        (20, "lead " + " ".join(f"p{i}" for i in range(40)) + " tail", "a"),
        (21, " ".join(f"p{i}" for i in range(3, 40)) + " end q q", "a"),
        (22, " ".join(f"p{i}" for i in range(36)) + " p0", "a"),
    ]
    got = substring_dedup.digests(documents(rows), window).collect()
    assert sorted(map(tuple, got), key=str) == brute_substring(rows, window)


def test_substring_dedup_random(documents):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "c"], rng.integers(0, 60))), "s") for i in range(80)]
    got = substring_dedup.digests(documents(rows), 8).collect()
    assert sorted(map(tuple, got), key=str) == brute_substring(rows, 8)


def brute_components(rows, percent=85):
    sets = []
    for i, t, _ in rows:
        w = SPACED.findall(lower(t))
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        name = min(ids) if ids and sets[k] else i
        out.append((i, len(sets[k]), name, i == name))
    return sorted(out, key=str)


def test_near_dedup(documents, odd_rows):
    rng = np.random.default_rng(5)
    rows = list(odd_rows)
    for g in range(6):  # chains of copies with a few changed words
        words = [f"g{g}w{i}" for i in range(120)]
        for i in range(12):
            for place in rng.integers(0, 120, 2):
                words[place] = f"c{rng.integers(1e6)}"
            rows.append((100 * (g + 1) + i, " ".join(words), "s"))
    got = near_dedup.components(documents(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_joint_estimate_is_near_the_similarity():
    rng = np.random.default_rng(0)
    common, own = rng.integers(0, 1 << 63, 850, dtype=np.uint64), rng.integers(0, 1 << 63, (2, 75), dtype=np.uint64)
    code = np.concatenate([common, own[0], common, own[1]])
    text = np.repeat([0, 1], 925)
    values = near_dedup.sketches(text, code, 2, 4096)
    n = np.array([925.0])
    assert abs(near_dedup.joint_estimate(values[:1], values[1:], n, n)[0] - 0.85) < 0.03
    union = near_dedup.sketches(np.zeros(1850, int), code, 1, 4096)
    assert (near_dedup.merged(values[0], values[1]) == union[0]).all()


def brute_contamination(rows, items):
    windows = defaultdict(set)
    for item, t in items:
        w = ALNUM.findall(lower(t))
        for k in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[k : k + 13])].add("" if item is None else str(item))
    out = []
    for i, t, _ in rows:
        w = ALNUM.findall(lower(t))
        hit, names = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    names |= windows[tuple(w[k : k + size])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [(1, "Word3 word4, word5"), (2, " ".join(f"word{i}" for i in range(20, 36))), (3, None), (4, "..."), (10, "one"), (5, "x Y"), (5, "x Y")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination(spark, documents, odd_rows, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (13, block_bytes))
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(documents(odd_rows), benchmark)
    got = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=str) == brute_contamination(odd_rows, ITEMS)


def test_proximity_finds_the_terms_in_any_order(spark, documents):
    rows = [(1, "zero beta one alpha two", "s"), (2, "alpha one two three four beta", "s"), (3, "alpha", "s"), (4, "beta", "s")]
    docs = documents(rows)
    block = next(decontaminate.blocks(spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")))
    index = decontaminate.build_index(docs, block.terms)
    found = decontaminate.search(index, block, near=4).collect()
    assert [(list(r["starts"]), list(r["ends"]), list(r["items"])) for r in found] == [([1], [4], ["7"])]


def test_empty_tables(spark, documents):
    docs = documents([])
    assert substring_dedup.digests(docs).count() == 0
    assert near_dedup.components(docs).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, nothing).count() == 0
    assert decontaminate.contamination(documents([(1, "a b", "s")]), nothing).collect()[0]["n_words"] == 2
