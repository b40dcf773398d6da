import re

import pytest

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture
def documents(spark):
    """documents with an extra column whose name operators use inside."""

    def build(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "extra") for i, t, s in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, hash string"
        )

    return build


@pytest.fixture
def odd_rows():
    """(doc_id, text, source): nulls, empty, one word, a very long text, copies, repeated rows, a null id."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word30", "other")
    return [
        (1, base, "a"),
        (2, base, "a"),
        (3, near, "b"),
        (4, None, "a"),
        (5, "", None),
        (6, " \n\t ", "b"),
        (7, "One", "a"),
        (8, "one", None),
        (9, long, "c"),
        (10, "tail " + base.upper(), "c"),
        (11, "x y", "a"),
        (11, "x y", "a"),
        (None, "x y z null id", None),
        (12, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "a"),
    ]
