"""Small tables that every operator must take: nulls, empty and very long
texts, ties and repeated rows, an empty table, extra columns of clashing names."""

from __future__ import annotations

import random

WORDS = "the of and river stone Bridge été über token paper, light. Night; 42 3.14 don't we're it's co-op x".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ing", "é"]) for _ in range(n))


def texts(seed: int = 7) -> list[str | None]:
    rng = random.Random(seed)
    some = [sentence(rng, n) for n in (1, 3, 5, 9, 12, 40, 41, 300, 3000)]
    odd = [None, "", " \n\t ", "中文 字 mixed ﬁ text", "á é combining", "<|endoftext|> and <|startoftext|>", "x" * 3000, "!?" * 200, "tab\tand\x0bvt\x0cff\rcr"]
    return some + odd + [some[5], some[5], some[7] + " end"]


def docs(spark, rows=None):
    """documents with clashing extra columns; ids 0.., one repeated row, one null id."""
    if rows is None:
        rows = list(enumerate(texts()))
        rows += [rows[6], (None, "row without an id, but with some text in it")]
    extra = [(i, t, "x", 1, 2, [3]) for i, t in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, start string, n_tokens int, n int, keys array<int>")


def empty(spark):
    return docs(spark, [])


def pairs(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.collect()]
