import random

import pytest

#: Clashing names that operators use themselves.
CLASHING = {"n": 1, "cls": "x", "rep": 2, "text_hash": 3, "kind": "k", "size": 4, "n_lines": 5, "n_dropped": 6, "score": 0.5, "key": "y", "copies": 7, "path": "p", "ids": "z"}


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of (doc_id, text, lang, source) rows, with more columns whose names clash."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), *CLASHING.values()) for r in rows]
        kinds = {int: "long", str: "string", float: "double"}
        schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{k} {kinds[type(v)]}" for k, v in CLASHING.items())
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, ids twice and rows without id."""
    rng = random.Random(5)
    long = " ".join(rng.choice("lorem ipsum dolor sit amet consectetur".split()) + str(rng.randrange(50)) for _ in range(60_000))
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n \x0b", None, None), (4, long, "en", "a"), (5, long, "de", "b"), (6, "one two three", "en", "a"),
        (6, "one two three", "en", "a"), (7, "ONE two Three", "en", "a"), (8, "same id first text here now", "en", "b"), (8, "same id second text here now", "en", "b"),
        (None, "a row without id that has words", "en", "a"), (None, None, None, None), (9, "x" * 200_000, "en", "c"), (10, "line one is long enough\nline one is long enough\n\nshort", "fr", "c"),
        (11, "  LINE one is long enough \nother", "fr", "c"), (12, "é" * 12 + "\n日本語 \U0001f600", "fr", "c"), (13, "é" * 12, "fr", "c"), (14, "a\x00b <|endoftext|>  c", "en", "a"),
    ]
