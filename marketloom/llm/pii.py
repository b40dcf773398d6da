"""Personal data: exact detectors, and a skip-chain conditional random field that keeps labels consistent in a document.

``base_spans`` finds emails, addresses, card and phone numbers by rule. Nodes of the field are those spans, whose labels are given,
and every other word that holds a digit or an at sign. Edges join neighbouring words, and successive nodes that repeat or
resemble each other (equal digits, or equal text without case and outer punctuation) at any distance. All potentials are learnt by pseudo-likelihood from
a bounded sample of documents, with the detectors' labels; loopy sum-product message passing then gives each node's
marginals, and a node whose label is ``CERTAIN`` becomes a further span. So a number that is recognised in one place of a document is
found again where it is written in a way that the rules do not know. Detected spans always stay.

Edges are linear in the nodes of a document (each node is joined with its last like), so documents of any length and any number of repeats cost no
more than their words. Positions are code points, ends exclusive.

Nulls: a null text is an empty text and has no spans; a null doc_id is kept. Rows are handled one by one, so repeated rows give
repeated results. Without any detected span in the sample nothing is added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.words import slices, widened

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 4000
SAMPLE_NODES = 200_000
CERTAIN = 0.9
AGREE = 4.0  # what skip edges favour equal labels by where the sample says nothing
ROUNDS = 12
DAMPING = 0.3
LEAST_KEY_DIGITS = 7

_AT = re.compile("@")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SOME = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0d]")
_OUTER = ".,;:!?()[]{}<>\"'*#&%$|"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the rule-based matches: leftmost and non-overlapping per kind, failing ones dropped."""
    out, done = [], 0
    for m in _AT.finditer(text):
        start = at = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append((0, start, done))
    runs = [m.span() for m in _DIGITS.finditer(text)]
    i = 0
    while i + 3 < len(runs):
        if all(runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] == "." for j in range(i, i + 3)):
            parts = [text[a:b].lstrip("0") for a, b in runs[i : i + 4]]
            if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
                out.append((1, runs[i][0], runs[i + 3][1]))
            i += 4
        else:
            i += 1
    i = 0
    while i < len(runs):
        j = i
        while j + 1 < len(runs) and runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] in " -":
            j += 1
        if 13 <= sum(b - a for a, b in runs[i : j + 1]) <= 19 and _luhn("".join(text[a:b] for a, b in runs[i : j + 1])):
            out.append((2, runs[i][0], runs[j][1]))
        i = j + 1
    if runs and "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def words_with_digits(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words with a digit or an at sign that touch no taken span, without outer punctuation."""
    spans = sorted((a, b) for _, a, b in taken)
    out, at, nxt = [], 0, 0
    while m := _SOME.search(text, at):
        start = m.start()
        while start > at and not (text[start - 1] == " " or "\t" <= text[start - 1] <= "\r"):
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = at = stop.start() if stop else len(text)
        while nxt < len(spans) and spans[nxt][1] <= start:
            nxt += 1
        if nxt < len(spans) and spans[nxt][0] < end:
            continue
        while start < end and text[start] in _OUTER:
            start += 1
        while end > start and text[end - 1] in _OUTER:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def _key(piece: str) -> str:
    digits = re.sub(r"[^0-9]", "", piece)
    letters = sum(c.isalpha() for c in piece)
    return digits if len(digits) >= LEAST_KEY_DIGITS and not letters else piece.lower()


FEATURES = 14


def features(piece: str) -> list[float]:
    """The shape of a word: what can be seen without the rules' checks of validity."""
    digits = sum("0" <= c <= "9" for c in piece)
    letters = sum(c.isalpha() for c in piece)
    dots, dashes = piece.count("."), piece.count("-")
    name, _, host = piece.partition("@")
    return [
        1.0,
        float("@" in piece),
        float(bool(name) and "." in host),
        float(piece.startswith("+")),
        float(digits <= 4),
        float(5 <= digits <= 8),
        float(9 <= digits <= 12),
        float(13 <= digits <= 19),
        float(digits > 19),
        float(dots == 3 and not letters),
        float(dots > 0),
        float(dashes > 0),
        float(letters > 0),
        float(letters > digits),
    ]


@dataclass
class Field:
    """Potentials: label x feature, and label x label along the chain and along skip edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


@dataclass
class Graph:
    """Nodes of some documents: (document, start, end, label or -1), features, and both kinds of edges."""

    nodes: np.ndarray
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def graph(texts: list[str | None], found: list[list[tuple[int, int, int]]]) -> Graph:
    nodes, shapes, chain, skip = [], [], [], []
    for d, (text, spans) in enumerate(zip(texts, found)):
        if not text:
            continue
        free = words_with_digits(text, spans)
        own = sorted([(a, b, 1 + k) for k, a, b in spans] + [(a, b, -1) for a, b in free])
        last: dict[str, int] = {}
        for i, (a, b, label) in enumerate(own):
            at, piece = len(nodes), text[a:b]
            key = _key(piece)
            if key in last:
                skip.append((last[key], at))
            last[key] = at
            if i and not text[own[i - 1][1] : a].strip(" \t\n\x0b\x0c\r" + _OUTER) and a - own[i - 1][1] < 8:
                chain.append((at - 1, at))
            nodes.append((d, a, b, label))
            shapes.append(features(piece))
    edges = lambda e: np.array(e, np.int64).reshape(-1, 2)
    return Graph(
        np.array(nodes, np.int64).reshape(-1, 4), np.array(shapes, np.float64).reshape(-1, FEATURES), edges(chain), edges(skip)
    )


def marginals(field: Field, g: Graph) -> np.ndarray:
    """Label probabilities of each node by damped sum-product message passing along all edges, both ways."""
    labels = len(KINDS) + 1
    local = g.features @ field.unary.T
    given = g.nodes[:, 3] >= 0
    local[given] = -30.0
    local[given, g.nodes[given, 3]] = 0.0
    local -= local.max(1, keepdims=True)
    edges = np.concatenate([g.chain, g.skip])
    pair = np.concatenate([np.repeat(field.chain[None], len(g.chain), 0), np.repeat(field.skip[None], len(g.skip), 0)])
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.exp(np.concatenate([pair, pair.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(source), labels))
    for _ in range(ROUNDS if len(source) else 0):
        belief = local.copy()
        np.add.at(belief, target, message)
        cavity = belief[source] - message[back]
        cavity -= cavity.max(1, keepdims=True)
        sent = np.log(np.einsum("ei,eij->ej", np.exp(cavity), both) + 1e-300)
        sent -= sent.max(1, keepdims=True)
        change = np.abs(sent - message).max()
        message = DAMPING * message + (1 - DAMPING) * sent
        if change < 1e-4:
            break
    belief = local.copy()
    np.add.at(belief, target, message)
    belief = np.exp(belief - belief.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


TRAINING = "label int, shape array<double>, chain array<double>, skip array<double>"


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    labels = len(KINDS) + 1
    for rows in slices(batches, "text"):
        texts = rows.column("text").to_pylist()
        g = graph(texts, [base_spans(t) if t else [] for t in texts])
        label = np.maximum(g.nodes[:, 3], 0)
        near = []
        for edges in (g.chain, g.skip):
            heard = np.zeros((2, len(label), labels))  # from the left and from the right node of each edge
            np.add.at(heard[0], (edges[:, 1], label[edges[:, 0]]), 1)
            np.add.at(heard[1], (edges[:, 0], label[edges[:, 1]]), 1)
            near.append(heard.transpose(1, 0, 2).reshape(len(label), 2 * labels))
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int32())] + [pa.array(list(x), pa.list_(pa.float64())) for x in (g.features, *near)],
            names=["label", "shape", "chain", "skip"],
        )


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_nodes: int = SAMPLE_NODES) -> Field:
    """Potentials of the largest penalised pseudo-likelihood on at most ``sample_docs`` documents and ``sample_nodes`` nodes."""
    labels = len(KINDS) + 1
    key = F.xxhash64("doc_id", "text")
    low = docs.where(F.col("text").isNotNull()).select(key.alias("key")).orderBy("key").limit(sample_docs)
    bound = low.agg(F.max("key")).head()[0]
    if bound is None:
        return Field(np.zeros((labels, FEATURES)), np.zeros((labels, labels)), np.zeros((labels, labels)))
    table = docs.where(F.col("text").isNotNull() & (key <= bound)).select("text").mapInArrow(_training, TRAINING).limit(sample_nodes).toArrow()
    label = table.column("label").to_numpy()
    if not label.any():
        return Field(np.zeros((labels, FEATURES)), np.zeros((labels, labels)), np.zeros((labels, labels)))
    stack = lambda c: np.array(table.column(c).to_pylist(), np.float64).reshape(len(label), -1)
    x, chain, skip = stack("shape"), stack("chain"), stack("skip")
    u, c, s = np.zeros((labels, x.shape[1])), np.zeros((labels, labels)), AGREE * np.eye(labels)
    truth = np.eye(labels)[label]
    left, right = chain[:, :labels], chain[:, labels:]
    alike = skip[:, :labels] + skip[:, labels:]
    moments = [np.zeros_like(v) for v in (u, c, s)], [np.zeros_like(v) for v in (u, c, s)]
    for step in range(1, 301):  # a convex aim, by gradient steps scaled per parameter
        odds = x @ u.T + left @ c + right @ c.T + alike @ s
        odds -= odds.max(1, keepdims=True)
        p = np.exp(odds)
        off = (p / p.sum(1, keepdims=True) - truth) / len(label)
        gradients = (off.T @ x + 1e-4 * u, left.T @ off + (right.T @ off).T + 1e-4 * c, alike.T @ off + 1e-2 * (s - AGREE * np.eye(labels)))
        for v, gradient, first, second in zip((u, c, s), gradients, *moments):
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            v -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        s = (s + s.T) / 2
    return Field(u, c, s)


def document_spans(texts: list[str | None], field: Field) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """(detected, added) spans of each text, by kind and start."""
    base = [sorted(base_spans(t)) if t else [] for t in texts]
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    g = graph(texts, base)
    if len(g.nodes):
        p = marginals(field, g)
        best = p.argmax(1)
        for i in np.flatnonzero((g.nodes[:, 3] < 0) & (best > 0) & (p.max(1) >= CERTAIN)):
            d, a, b, _ = g.nodes[i]
            added[d].append((int(best[i]) - 1, int(a), int(b)))
    return base, [sorted(x) for x in added]


def detect(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, and ``base`` and ``added``: lists of (kind number, start, end), by kind and start."""
    field = fit(docs) if field is None else field

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        as_rows = lambda spans: pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in spans], kind)
        for rows in slices(batches, "text"):
            base, added = document_spans(rows.column("text").to_pylist(), field)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), as_rows(base), as_rows(added)], names=["doc_id", "base", "added"])

    span = "array<struct<kind:int,start:int,end:int>>"
    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, widened([docs.schema["doc_id"]], f"base {span}, added {span}"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, counts of detected spans per kind, base_sha256 and spans, in DataFrame operations."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    written = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(
        "doc_id",
        *[count(k) for k in range(len(KINDS))],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def masked(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with every span, detected or added, replaced by its kind in brackets; of overlapping spans the first names the
    kind and all their text goes."""
    field = fit(docs) if field is None else field
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            texts = rows.column("text").to_pylist()
            out = []
            for text, base, added in zip(texts, *document_spans(texts, field)):
                spans = sorted((a, b, kind) for kind, a, b in base + added)
                if not spans:
                    out.append(text)
                    continue
                pieces, at = [], 0
                for a, b, kind in spans:
                    if a >= at:
                        pieces += [text[at:a], f"[{KINDS[kind].upper()}]"]
                    at = max(at, b)
                out.append("".join(pieces) + text[at:])
            column = pa.array(out, rows.column("text").type)
            yield pa.RecordBatch.from_arrays([column if n == "text" else rows.column(n) for n in names], names=names)

    return docs.mapInArrow(run, docs.schema)
