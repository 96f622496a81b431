from __future__ import annotations

import os

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"

FOLDER = "/root/testdata/sf0.001"
#: Texts that are awkward in one way or another.
ODD = [
    None, "", " ", "a", " a", "a ", "a  b\n\nc\t\td\n e", "x　y z\x85w  \xa0 q", "it's DON'T we'll 'S",
    "<|endoftext|>a <|endoftext|> b<|startoftext|>", "\0a b", "a\x1cb \x1c c", "ΑΣ ΣΑΣ İstanbul ẞ", "é ́x ﬁ Å",
    "😀 😀😀!!??...", "a" * 3000 + " " + "ab" * 40, "1234 56a7", "\n", "\n\nab", "ab \n", "  ", "naïve café—dash…",
    "same text", "same text", "word " * 30_000,
]


@pytest.fixture
def odd(spark):
    """Odd texts with null and repeated ids, and columns whose names operators might use themselves."""
    rows = [(i if i != 3 else None, t, "x", "y", 1, "c", 0.5, "w") for i, t in enumerate(ODD)]
    rows.append(rows[5])
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, score double, words string"
    )


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
