import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import ann, chat, licenses, mixing, pii, toxicity, warc
from marketloom.session import shared_folder
from tests.llm.conftest import SPACED

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(d) if i % 2 == 0 else (int(d) * 2 - 9 if d > "4" else int(d) * 2) for i, d in enumerate(digits[::-1])) % 10 == 0
            if [True, kind == 1 and all(int(p) < 256 for p in m.group().split(".")), 13 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15][kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["4111111111111111", "4111 1111", "1111", "-", " ", ".", "+1", "255", "0", "a@b", "a.b@c.d", ".e", "(", "x"]
    for _ in range(20_000):
        text = "".join(rng.choice("0123459.-+@ ()ab,_\n") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text)
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == brute_spans(text)


def test_field_finds_a_repeated_number_in_another_spelling(documents):
    rng = random.Random(2)
    cards = ["4111111111111111", "5500005555555559", "4012888888881881"]
    rows = [(i, f"pay {rng.choice(cards)} now {rng.randint(1, 99)} or {rng.randint(10**8, 10**9)} ok", "s") for i in range(200)]
    rows += [(900, "card 4111 1111 1111 1111 then 4111.1111.1111.1111 and é 4111/1111/1111/1111", "s"), (901, "v 12 of 34 is 1.2 in 1999", "s")]
    rows += [(902, None, None), (903, "", "s"), (None, "mail a@b.c", "s")]
    docs = documents(rows)
    found = {r["doc_id"]: r for r in pii.digests(pii.detect(docs)).collect()}
    assert found[900]["n_card"] == 1 and found[900]["n_added"] == 2 and found[900]["spans"].startswith("card:5:24,card:30:49")
    assert found[901]["spans"] == "" and found[902]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found[None]["spans"] == "email:5:10"
    clean = {r["doc_id"]: r for r in pii.masked(docs).collect()}
    assert clean[900]["text"] == "card [CARD] then [CARD] and é [CARD]" and clean[902]["text"] is None and clean[901]["hash"] == "extra"
    assert pii.digests(pii.detect(documents([]))).count() == 0


def test_mixing(documents, odd_rows):
    rows = odd_rows + [(100 + i, "w " * (i % 7 + 1), f"s{i % 5}") for i in range(200)]
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(SPACED.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * rate > 3 * sizes[s]}
        if not over:
            target |= {s: weight[s] * rate for s in free}
            break
        target |= {s: 3 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert 0 <= r["copies"] <= 3 and math.isclose(r["target"], target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["copies"] * r["size"]
    for s in order:
        assert taken[s] <= target[s] + 1e-9
        assert target[s] - taken[s] <= max(len(SPACED.findall(t or "")) for _, t, x in rows if x == s)
    again = mixing.mix(documents(rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mix(documents([(1, None, None), (2, "", "a")])).where("target <> 0 or copies > 3").count() == 0


def test_mixing_joins_the_documents_once_however_many_passes_there_are(documents):
    """Every join of a table of sources is a broadcast that the driver holds."""
    mixed = mixing.mix(documents([(i, "w " * (i % 7 + 1), f"s{i % 5}") for i in range(200)]))
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert mixing.FILLS > 0 and len(re.findall(r"\bJoin ", plan)) == 1


def test_warc_round_trip(spark):
    rows = [(1, "http://a", "<p>x</p>"), (2, "http://b\n", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 400_000)]
    rows += [(None, "n", "<p>x</p>"), (6, "u", "six"), (6, "u", "six")] + [(10 + i, "u", f"{i % 9}") for i in range(200)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, frame string")
    folder = f"{shared_folder(spark)}/warc-test-{random.random()}"
    warc.write(warc.bundles(pages, frame_bytes=500, bundle_bytes=3000), folder)
    read = warc.read(spark, folder).collect()
    assert len(read) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    by = {}
    for r in read:
        by.setdefault(r["page_id"], []).append(r)
    for i, _, h in rows:
        data, r = (h or "").encode(), by[i][0]
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first[h or ""] == i else ("revisit", first[h or ""]))
        assert r["payload"] is None or bytes(r["payload"]) == data
    some = spark.createDataFrame([(by[5][0]["record_id"],), (by[12][0]["record_id"],)], "record_id string")
    assert {r["page_id"] for r in warc.read(spark, folder, some).collect()} == {5, 12}
    assert warc.record_index(spark, folder).count() == len(rows)
    import io

    import zstandard

    path = spark.read.format("binaryFile").load(folder).where("length > 0").select("content").head()[0]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bytes(path)), read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1\r\n")
    kinds = "page_id long, url string, html string"
    empty = f"{shared_folder(spark)}/warc-test-{random.random()}"
    warc.write(warc.bundles(spark.createDataFrame([], kinds)), empty)
    assert warc.read(spark, empty).count() == 0
    small = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], kinds)
    least = f"{shared_folder(spark)}/warc-test-{random.random()}"
    warc.write(warc.bundles(small, least_bytes=3), least)
    assert sorted((r["page_id"], r["record_type"]) for r in warc.read(spark, least).collect()) == [
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")
    ]


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|", "<\\\\|x", "<|", "a<|b<\\|c|>", "\\<|im_sep|>\\"])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_chat(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", "hi\n there  é "), (1, 1, "assistant", "  hello <\\| 🙂"), (1, 1, "assistant", "again"), (1, None, None, None)]
    rows += [(2, 0, "assistant", "x" * 200_000), (None, 0, "user", ""), (None, 1, "<|im_sep|>", said), (-1, 0, "user", said), (-1, 1, "assistant", said)]
    rows += [(3, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(500)]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, seq long")
    formatted = chat.formatted(turns)
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(formatted)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        learnt = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(learnt) and r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
        assert r["formatted_chars"] >= len(whole) - 2 * len(own)
    parts = sorted((r["seq"], r["token_start"], len(r["ids"]) // 4) for r in formatted.where("conv_id = 3").collect())
    assert [p[1] for p in parts] == np.concatenate([[0], np.cumsum([p[2] for p in parts])[:-1]]).tolist()
    assert chat.digests(chat.read_back(chat.formatted(turns.limit(0)))).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    vectors = [list(map(float, centres[i % 40] + rng.normal(size=16) * 0.1)) for i in range(3000)]
    vectors += [vectors[0]] * 60
    rows = [(i, v) for i, v in enumerate(vectors)]
    usable = rows + [(5000, [1.0, 2.0])]
    rows = usable + [(5001, None), (5002, []), (5003, [0.0] * 16), (5004, [None] + [1.0] * 15), (5005, [math.nan] * 16), (5006, [math.inf] * 16), (None, [1.0] * 16)]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, cell int")
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = np.array([v + [0.0] * (16 - len(v)) for _, v in usable])
    ids = np.array([i for i, _ in usable])
    found = total = 0
    assert set(got) == {i for i in ids if i % 100 == 0}
    for q, rows in got.items():
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        far[ids == q] = np.inf
        best = ids[np.lexsort((ids, far))[:10]].tolist()
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11))
        assert all(s == pytest.approx(far[ids == v][0], rel=1e-12) for _, v, s in rows)
        found, total = found + len(set(best) & {v for _, v, _ in rows}), total + 10
        if q == 0:
            assert [v for _, v, _ in rows] == best
    assert found >= 0.95 * total
    few = table.where("vec_id in (0, 7, 9)")
    assert [r["vec_id"] for r in ann.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()] in ([7, 9], [9, 7])
    assert ann.nearest(table.limit(0), F.lit(True)).count() == 0


def test_chi_square_quantile():
    assert ann.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert ann.chi_square_quantile(0.98, 8) == pytest.approx(18.168, abs=1e-3)


def test_licenses(documents):
    filler = " ".join(f"w{i}" for i in range(200))
    rows = [(1, f"{filler} Released under the MIT License. {filler}", "s"), (2, filler, "s"), (3, None, "s"), (4, "", None)]
    rows += [(5, "All rights reserved", "s"), (5, "All rights reserved", "s"), (None, f"é Licensed under the Apache License, Version 2.0. {filler * 50}", "s")]
    rows += [(6, "released mit under license the", "s")]
    got = sorted(map(tuple, licenses.licensed(documents(rows)).select("doc_id", "license", "first_word").collect()), key=str)
    assert [g[:2] for g in got] == [(1, "mit"), (5, "all-rights-reserved"), (None, "apache-2.0")]
    assert licenses.licensed(documents([])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(documents([]), {"short": "word"})


def test_license_texts_and_headers(documents):
    """Each real text is found between other words, wrapped as comment lines, and with some words changed."""
    filler = " ".join(f"w{i}" for i in range(300))
    long = {n: t for n, t in licenses.TEMPLATES.items() if len(t) > 150}
    assert {"mit-text", "apache-2.0-header", "gpl-header", "lgpl-header", "mpl-2.0-header", "bsd-3-text", "isc-text"} <= set(long)
    rows, names = [], {}
    for i, (name, text) in enumerate(sorted(long.items())):
        words = text.split()
        wrapped = "\n".join(" * " + " ".join(words[j : j + 9]) for j in range(0, len(words), 9))
        changed = " ".join("other" if j % 25 == 24 else w for j, w in enumerate(words))
        for j, found in enumerate((text, wrapped, changed)):
            rows.append((10 * i + j, f"{filler[: 70 * j]} {found} {filler}", "s"))
            names[10 * i + j] = name
    got = {(r["doc_id"], r["license"]) for r in licenses.licensed(documents(rows)).collect()}
    assert set(names.items()) <= got


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(4)
    bad = ["idiot", "scum", "trash", "moron"]
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "you idiot", "x")]
    labels += [(1000, 0), (None, 1), (7, None), (9999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity(judged):
    docs, labels, truth = judged
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert len(held) > 60 and all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == (1 if r["doc_id"] % 4 == 0 else 0) for r in held) >= 0.97 * len(held)
    assert next(r for r in got if r["doc_id"] is None)["predicted"] == 1
    assert next(r for r in got if r["doc_id"] == 1001)["predicted"] == 0


def test_toxicity_without_examples(judged, spark):
    docs, labels, _ = judged
    assert {r["predicted"] for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_block_max_search_equals_all_cosines():
    rng = np.random.default_rng(7)
    n, terms = 500, 60
    dense = (rng.random((n, terms)) < 0.08) * rng.integers(1, 4, (n, terms))
    row, slot = np.nonzero(dense)
    idf = rng.random(terms) + 0.5
    index = toxicity.pack(idf, row, slot, dense[row, slot].astype(float), rng.integers(0, 2, n).astype(float), np.ones(n), np.arange(n))
    ask = dense[:50]
    r, s = np.nonzero(ask)
    filled = np.unique(r)
    weights = toxicity.unit_weights(r, s, ask[r, s].astype(float), idf)
    who, cosine = index.nearest(np.searchsorted(filled, r), s, weights, 5)
    full = np.zeros((len(index.total), terms))
    for b, (held, lists) in enumerate(index.blocks):
        for j in range(lists.shape[1]):
            full[b * toxicity.BLOCK + j, held] = lists[:, j]
    for i, d in enumerate(filled):
        vector = np.zeros(terms)
        vector[s[r == d]] = weights[r == d]
        every = full @ vector
        best = np.lexsort((np.arange(len(every)), -np.round(every, 12)))[:5]
        assert who[i].tolist() == best.tolist() and np.allclose(cosine[i], every[best])


def test_whole_texts_against_all_cosines(spark):
    """Cosines over every word, also of words that no example holds; toxic wording too rare for a marker is found."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randint(0, 80)}" for _ in range(rng.randint(3, 30)))) for i in range(200)]
    rows += [(300 + i, f"{a} {b} sod off back home") for i, (a, b) in enumerate([("blot", "cur"), ("dolt", "cad")])]
    rows += [(400, "sod off back home unseen words"), (401, "unseen"), (402, "")]
    held = lambda i: zlib.crc32(str(i).encode()) % toxicity.FOLDS == 0
    labels = [(i, int(i >= 300)) for i, _ in rows if i < 400]
    got = {r["doc_id"]: r for r in toxicity.classify(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    ).collect()}
    terms = {i: Counter(t.split()) for i, t in rows}
    df = Counter(w for c in terms.values() for w in c)
    weigh = lambda c: {w: (1 + np.log(n)) * (np.log((len(rows) + 1) / (df[w] + 1)) + 1) for w, n in c.items()}
    vectors = {i: weigh(c) for i, c in terms.items()}
    norm = {i: np.sqrt(sum(x * x for x in v.values())) for i, v in vectors.items()}
    for i, v in vectors.items():
        full = sorted((-round(sum(x * vectors[j].get(w, 0) for w, x in v.items()) / (norm[i] * norm[j]), 12), j) for j, _ in labels if norm[i] and not held(j))
        want = [(j, -c) for c, j in full if c < 0][:3]
        assert [e["doc_id"] for e in got[i]["evidence"]] == [j for j, _ in want]
        assert [e["cosine"] for e in got[i]["evidence"]] == pytest.approx([c for _, c in want])
    assert got[400]["evidence"] and got[400]["score"] > got[402]["score"]
