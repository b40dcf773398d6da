import hashlib
import zlib

import numpy as np
import pytest

from marketloom.llm import gram_join, runs, vector_codes
from marketloom.llm.runs import Catchers
from tests.llm.conftest import SPACED, lower


def brute_runs(w, exponent, least):
    """{(start, end): smallest period} of all runs, by comparing every pair of words."""
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                out.setdefault((i, j + q), q)
            i = j + 1 if j > i else i + 1
    return sorted(((s, t, q) for (s, t), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("append", [1, 5, 1000])
def test_catchers_find_all_runs_for_any_split_into_appends(monkeypatch, append):
    monkeypatch.setattr(runs, "APPEND", append)
    rng = np.random.default_rng(append)
    for _ in range(150):
        exponent, least = int(rng.choice([2, 3, 4])), int(rng.choice([2, 6]))
        docs = []
        for _ in range(rng.integers(1, 4)):
            w = rng.integers(0, rng.integers(1, 4), rng.integers(0, 90))
            if len(w) > 10 and rng.random() < 0.5:
                a = rng.integers(0, len(w))
                w[a:] = w[a + np.arange(len(w) - a) % rng.integers(1, 2 + (len(w) - a) // 3)]
            docs.append(w)
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        codes = (np.concatenate(docs).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        catchers = Catchers(exponent, least)
        catchers.append(codes, np.repeat(first[:-1], np.diff(first)))
        want = [(s + at, t + at, q) for d, at in zip(docs, first) for s, t, q in brute_runs(list(d), exponent, least)]
        assert [tuple(r) for r in catchers.runs().tolist()] == want


def test_catchers_take_long_repeats_without_a_square_of_work():
    for period in (1, 2, 37, 4000):
        codes = np.tile(np.random.default_rng(period).integers(1, 1 << 62, period).astype(np.uint64), 120_000 // period)
        catchers = Catchers()
        catchers.append(codes, np.zeros(len(codes), np.int64))
        assert catchers.runs().tolist() == [[0, len(codes), period]]
    with pytest.raises(ValueError):
        Catchers(1)


def test_periodic_runs_of_odd_rows(spark, documents, odd_rows):
    rows = odd_rows + [(30, "say " + "ha " * 40 + "stop", "a"), (31, "x y z " * 5 + "x", "a"), (32, "a b\n" * 3, "a"), (33, "é è " * 4, "a")]
    docs = documents(rows).withColumnRenamed("hash", "runs")
    found = runs.periodic_runs(docs)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "runs", "collapsed"]
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()), key=str)
    want = []
    for i, t, _ in rows:
        w = SPACED.findall(t or "")
        held = brute_runs(w, 4, 6) if len(w) < 1000 else []
        gone = {p for s, e, q in held for p in range(s + q, e)}
        want.append((i, len(w), [(s, e - s, q) for s, e, q in held], " ".join(x for p, x in enumerate(w) if p not in gone)))
    assert got == sorted(want, key=str)
    assert runs.periodic_runs(documents([])).count() == 0


def test_planted_repeats_follow_the_rule(spark, documents):
    from marketloom.llm.queries import _with_repeats

    rows = [(i, " ".join(f"w{j}" for j in range(i % 60)), "s") for i in range(-5, 300)] + [(None, "a b", "s"), (7, None, "s")]
    got = {r["doc_id"]: r["text"] for r in _with_repeats(documents(rows)).collect() if r["text"] is not None}
    for i, t, _ in rows:
        if t is None:
            continue
        w, h = t.split(), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, len(w))]
        assert got[i].split() == w


def brute_components(rows, percent, words):
    sets = []
    for _, t, _ in rows:
        w = SPACED.findall(lower(t))
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for i, r in enumerate(rows):
        known = [x for x in (least.get(root(i)), r[0]) if x is not None]
        least[root(i)] = min(known, default=None)
    return sorted(((r[0], len(sets[i]), least[root(i)] if sets[i] else r[0]) for i, r in enumerate(rows)), key=str)


def linked(docs, *args):
    return sorted(map(tuple, gram_join.components(docs, *args).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_gram_join_of_odd_rows(documents, odd_rows):
    assert linked(documents(odd_rows)) == brute_components(odd_rows, 80, 5)
    assert linked(documents([])) == []
    none = [(1, None, "a"), (2, "", "a")]
    assert linked(documents(none)) == [(1, 0, 1), (2, 0, 2)]


def test_gram_join_of_chains_hubs_and_families(documents):
    """A chain of edits, a family just under the threshold, a hub that leaves real links apart, and random edits."""
    rng = np.random.default_rng(5)
    base = [f"c{i}" for i in range(110)]
    chain = list(base)
    rows = []
    for i in range(12):
        rows.append((100 + i, " ".join(chain), "s"))
        chain[9 * i % 110] = f"e{i}"
    for i in range(25):  # 5-gram sets of 96 that share 84: a similarity of 84 / 108
        rows.append((200 + i, " ".join([f"f{j}" for j in range(88)] + [f"u{i}x{j}" for j in range(12)]), "s"))
    left, right = [f"h{i}" for i in range(40)], [f"k{i}" for i in range(160)]
    for i in range(6):  # two halves of a family, each near its own members only
        rows.append((300 + i, " ".join(left + right[: 120 + i]), "s"))
        rows.append((320 + i, " ".join(left + right[30 : 150 + i]), "s"))
    for i in range(40):
        w = list(base)
        for at in rng.integers(0, 110, rng.integers(0, 6)):
            w[at] = f"r{i}x{at}"
        rows.append((400 + i, " ".join(w[: rng.integers(90, 111)]), "s"))
    want = brute_components(rows, 80, 5)
    assert linked(documents(rows)) == want
    assert len({c for _, _, c in want}) > 26
    assert linked(documents(rows), 50, 2) == brute_components(rows, 50, 2)


def test_gram_join_random(documents):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(rng.choice(list("abcd"), rng.integers(0, 14))), "s") for i in range(150)]
    assert linked(documents(rows), 60, 2) == brute_components(rows, 60, 2)


def brute_codes(rows, entries=256, parts=4, rounds=4):
    ok = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(1024 * x)) for x in r[1]]))
    if not ok:
        return [], None
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])]
    whole = [[int(np.floor(1024 * x)) for x in r[1]] + [0] * (-len(r[1]) % parts) for r in ok]
    width = len(whole[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [nearest(c[p], books[p])[1] for c in cut]
            for e in set(at):
                own = [c[p] for c, a in zip(cut, at) if a == e]
                books[p][e] = tuple(sum(col) // len(own) for col in zip(*own))
    out = []
    for r, c in zip(ok, cut):
        near = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{i:02x}" for _, i in near), sum(g for g, _ in near)))
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(out, key=str), hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("width", [8, 6])
def test_vector_codes(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, [float(np.float32(x)) for x in np.round(rng.normal(size=width) * 3) / 4], int(i % 3)) for i in range(90)]
    rows += [(200, None, 1), (201, [1.0] * (width - 1) + [None], 1), (202, [float("nan")] * width, 1), (203, [float("inf")] + [0.0] * (width - 1), 2)]
    rows += [(204, [], 1), (205, [1.0, 2.0], None), (5, [0.5] * width, None), (5, [0.5] * width, None), (None, [0.25] * width, 2)]
    frame = spark.createDataFrame([(*r, "own") for r in rows], "vec_id long, embedding array<float>, label int, code string")
    found, books = vector_codes.encode(frame, entries=16)
    want, digest = brute_codes(rows, 16)
    assert found.columns == ["vec_id", "label", "code", "error"]
    assert sorted(map(tuple, found.collect()), key=str) == want and vector_codes.digest(books) == digest
    few, books = vector_codes.encode(frame.where("vec_id < 4"))
    assert [r["error"] for r in few.collect()] == [0] * 4 and books.shape[1] == 4
    assert vector_codes.encode(frame.where("vec_id between 200 and 204"))[0].count() == 0
    with pytest.raises(ValueError):
        vector_codes.encode(frame, entries=300)


def test_orchard_search_is_exact_and_measures_less_than_all():
    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, (40, 8))
    entries = (centres[rng.integers(0, 40, 256)] + rng.integers(-60, 60, (256, 8))).astype(np.int64)
    entries[7] = entries[3]  # equal entries: the lower one
    points = (centres[rng.integers(0, 40, 3000)] + rng.integers(-80, 80, (3000, 8))).astype(np.int64)
    points[:256] = entries
    at, gap, measured = vector_codes.Codebook.of(entries).nearest(points)
    all_gaps = ((points[:, None, :] - entries[None]) ** 2).sum(2)
    assert (at == all_gaps.argmin(1)).all() and (gap == all_gaps.min(1)).all()
    assert measured < 0.4 * all_gaps.size
