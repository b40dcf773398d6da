"""Chat formatting at the level of tokens.

Every segment (a role, a text) is encoded on its own, as ordinary text, and the template's reserved ids are spliced in between:
start, role, separator, text, end. Reserved ids lie beyond the vocabulary, so no text can produce them; control strings that
occur in a text are escaped besides, so that the rendered string is unambiguous too. Token offsets and the loss mask follow
from prefix sums of segment lengths along a conversation. The output has a row for each turn, with its ids, its offset and
its masked range, so a conversation of any length is never one value.

Encoding, the costly part, happens before conversations are brought together, in any partition; the pass along a conversation only adds up,
row by row, in the order (turn, role, text).

Nulls: a null text or role is empty, a null turn comes first, a null conv_id is a conversation of its own. Repeated rows are
repeated turns. The vocabulary file is a parameter and must be readable by every executor.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
START, SEPARATOR, END = range(3)
LEARNT_ROLE = "assistant"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FORMATTED = "conv_id long, seq long, token_start long, loss_start long, loss_end long, ids binary"
SEGMENT_CHARS = 1 << 16

_coders: dict[str, object] = {}


def coder(path: str):
    """The tokenizer of a rank file, loaded once per Python worker."""
    if path not in _coders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        _coders[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _coders[path]


def escape(text: str) -> str:
    """``text`` without control strings: a backslash enters every opening of one, and lengthens those that look escaped."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _pieces(text: str) -> Iterator[str]:
    """Runs of at most ``SEGMENT_CHARS`` characters, so that very long texts are encoded in parts."""
    for at in range(0, len(text), SEGMENT_CHARS):
        yield text[at : at + SEGMENT_CHARS]


def encoded(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Each turn's ids with reserved ids spliced in, and where the text's ids begin and end among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(vocabulary)
        reserved = [code.n_vocab + i for i in range(len(CONTROLS))]
        encode = lambda t: [i for piece in _pieces(escape(t)) for i in code.encode_ordinary(piece)]
        for batch in batches:
            ids, lo, hi = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                head, body = encode(role), encode(text)
                ids.append(np.array([reserved[START], *head, reserved[SEPARATOR], *body, reserved[END]], np.int32).tobytes())
                lo.append(len(head) + 2)
                hi.append(len(head) + 2 + len(body))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                names=[*batch.schema.names, "ids", "body_start", "body_end"],
            )

    filled = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    kind = "conv_id long, turn long, role string, text string, ids binary, body_start long, body_end long"
    return filled.mapInArrow(run, kind)


def formatted(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per turn, in order ``seq`` of its conversation: token offset, masked range (in tokens of the conversation; empty if
    the turn isn't learnt), and the turn's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seq, offset = object(), 0, 0
        for batch in batches:
            n = batch.num_rows
            conv = batch.column("conv_id").to_pylist()
            sizes = [len(i) // 4 for i in batch.column("ids").to_pylist()]
            seqs, starts = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i in range(n):
                if conv[i] != current:
                    current, seq, offset = conv[i], 0, 0
                seqs[i], starts[i] = seq, offset
                seq, offset = seq + 1, offset + sizes[i]
            learnt = np.array([r == LEARNT_ROLE for r in batch.column("role").to_pylist()], bool)
            lo = starts + batch.column("body_start").to_numpy()
            hi = starts + batch.column("body_end").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(seqs), pa.array(starts), pa.array(lo), pa.array(np.where(learnt, hi, lo)), batch.column("ids")],
                names=["conv_id", "seq", "token_start", "loss_start", "loss_end", "ids"],
            )

    parts = encoded(turns, vocabulary).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return parts.mapInArrow(run, FORMATTED)


def read_back(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What the ids and masks of ``formatted`` say: conv_id, seq, role, text, the learnt text, and the rendered length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(vocabulary)
        base = code.n_vocab
        for batch in batches:
            roles, texts, learnt, chars = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("ids", "token_start", "loss_start", "loss_end"))
            for packed, start, lo, hi in zip(*columns):
                ids = np.frombuffer(packed, np.int32)
                marks = np.flatnonzero(ids >= base)
                if ids[marks].tolist() != [base + START, base + SEPARATOR, base + END] or marks[0] != 0 or marks[2] != len(ids) - 1:
                    raise ValueError("a turn is start, role, separator, text, end")
                text_of = lambda x: code.decode_bytes(x.tolist()).decode()
                role, body = text_of(ids[1 : marks[1]]), text_of(ids[marks[1] + 1 : -1])
                roles.append(unescape(role))
                texts.append(unescape(body))
                learnt.append(unescape(text_of(ids[lo - start : hi - start])))
                chars.append(sum(map(len, CONTROLS)) + len(role) + len(body))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("seq"), pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(learnt, pa.string()), pa.array(chars, pa.int64())],
                names=["conv_id", "seq", "role", "text", "learnt", "chars"],
            )

    return rows.mapInArrow(run, "conv_id long, seq long, role string, text string, learnt string, chars long")


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; rows are hashed one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        begun, state = False, None

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        def closed() -> tuple:
            conv, turns, whole, loss_chars, loss, chars = state
            return conv, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars

        for batch in batches:
            done = []
            for conv, role, text, learnt, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "learnt", "chars"))):
                if not begun or state[0] != conv:
                    if begun:
                        done.append(closed())
                    begun, state = True, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(learnt)
                state[4].update(learnt.encode())
                state[5] += chars
            if done:
                yield out(done)
        if begun:
            yield out([closed()])

    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(run, kind)
