"""Paths, edge-case rows and comparisons the tests of this folder share."""

from __future__ import annotations

import pandas as pd

SF = "/root/testdata/sf0.001"
#: Columns that clash with names the operators use inside.
CLASH = ["rid", "norm", "blocks", "n", "shard_", "range", "fp", "words", "part", "score_", "k1", "odds"]
EDGE = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def edge_rows():
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "abc"), (5, "abc"), (6, "a  b c "), (None, "a b c"),
             (7, long), (8, long + " tail"), (8, "other words here"), (None, None), (9, "née\x0bÉ 日本 \U0001f600 x"),
             (10, long), (11, "one two three four five six"), (12, "one two three four five seven"), (13, "a <|endoftext|> b<|startoftext|>")]
    return [(d, t, "en", None, None, *["x"] * len(CLASH)) for d, t in texts]


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(found: pd.DataFrame, want: pd.DataFrame, key: str) -> None:
    a = found[list(want.columns)].sort_values(key).reset_index(drop=True)
    b = want.sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
