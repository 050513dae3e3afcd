"""Small tables with every awkward case: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
WORDS = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (3, ""), (4, None), (None, None), (None, "All rights reserved."), (None, "no id but words"),
    (5, LONG), (6, LONG + " tail"), (7, "  \t\n "), (8, "été ÉTÉ Straße ß 漢字   x\x1cy"),
    (9, "Licensed under CC BY-NC 4.0."), (9, "cc by, and CC-BY again. All Rights Reserved"), (10, "word"),
    (11, f"before {WORDS} after {WORDS.upper()}"), (12, f"A {WORDS.replace('five', 'five uh')} Z"),
    (13, "This work is licensed under the (new) GNU General Public License version 3"), (14, "'\"&<|endoftext|> a\tb  c\n\n"),
]
CLASHES = "id r1 r2 fp pos word term start len label base size shard slot h n cell tokens held_out score predicted row y".split()


@pytest.fixture(scope="session")
def docs(spark):
    extra = ", ".join(f"{c} string" for c in CLASHES)
    rows = [(i, t, "en" if i else None, "s", None, *["x"] * len(CLASHES)) for i, t in ROWS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").coalesce(2)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
