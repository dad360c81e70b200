"""Token counts at every prefix of a text.

A dynamic program over the text: the count at a prefix is the count at the end
of the word before it plus the count of the part of its own word, and the
latter is worked out once per distinct word.  ``prefix_table`` stores the whole
table of a document as one signed step per UTF-8 byte; ``tokens_at`` and
``longest_prefix`` answer questions of budget and truncation from it without
encoding anything again.

Defined results: a null or empty text has 0 bytes, 0 tokens and an empty table;
a null id stays a null id; repeated rows give one result row each.  The table
is exact at every character, also inside long runs without white space
(``prefixbpe``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emporium.llm.common import batch_rows, id_and_text, slices
from emporium.llm.wordbpe import encoder

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

SCHEMA = "doc_id long, n_bytes long, n_tokens long, limit_bytes long, steps binary"


def steps_of(texts: list[bytes], tokenizer_path: str) -> list[np.ndarray]:
    """Change of the token count at each byte of each text."""
    enc = encoder(tokenizer_path)
    if not enc.by_word:
        raise ValueError(f"{tokenizer_path}: prefix counts need a tokenizer that never looks across white space")
    out = []
    for text, found in zip(texts, enc.steps(texts), strict=True):
        steps = np.zeros(len(text), "<i4")
        steps[~SPACE[np.frombuffer(text, np.uint8)]] = found
        out.append(steps)
    return out


def tokens_at(steps: np.ndarray, n_bytes: int) -> int:
    """Exact token count of the first ``n_bytes`` bytes (whole characters)."""
    return int(steps[:n_bytes].sum())


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Bytes of the longest prefix of at most ``budget`` tokens; ``counts`` are
    the counts after each byte."""
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    within = np.flatnonzero(counts <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def character_end(text: bytes, at: int) -> int:
    """The last character boundary at or before ``at``."""
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def prefix_table(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    keep_steps: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: bytes, tokens, the bytes of the longest prefix
    within ``limit`` tokens, and (``keep_steps``) the prefix table itself.
    No shuffle: one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            ids, texts = batch_rows(batch, "doc_id", "text")
            sizes, tokens, cuts, tables = [], [], [], []
            for text, steps in zip(texts, steps_of(texts, tokenizer_path), strict=True):
                counts = np.cumsum(steps, dtype=np.int64)
                sizes.append(len(text))
                tokens.append(int(counts[-1]) if len(counts) else 0)
                cuts.append(character_end(text, longest_prefix(counts, limit)))
                tables.append(steps.tobytes() if keep_steps else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(cuts, pa.int64()), pa.array(tables, pa.binary())],
                names=["doc_id", "n_bytes", "n_tokens", "limit_bytes", "steps"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
