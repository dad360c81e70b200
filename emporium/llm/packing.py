"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two, at
most ``max_len``: as many of ``max_len`` as fit, then the binary digits of the
rest, largest first.  Each piece is a sequence of its own: no sequence crosses
documents and none needs padding.  Sequences of one length form a bucket, from
which a trainer draws batches of equal shape; the bucket is the top part of
``sequence_id``, so a sort or range scan by it reads bucket after bucket.

Defined results: a null or empty text is the end token alone, one piece of
length 1; a null id stays a null id; repeated rows are packed again, under
sequence ids of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from emporium.llm.common import batch_rows, id_and_text, slices
from emporium.llm.wordbpe import encoder

SCHEMA = "doc_id long, start long, length long, doc_tokens long, bucket int, sequence_id long, offset long, ids binary"

# sequence_id: 5 bits of bucket, 24 of task, 34 of the task's own count.
TASK_BITS, COUNT_BITS = 24, 34


def piece_lengths(n: int, max_len: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens; ``max_len`` is a power of two."""
    full, rest = divmod(n, max_len)
    return [max_len] * full + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    max_len: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece, with its ids as little-endian 32-bit integers.

    One pass without a shuffle.  ``bucket`` is log2 of the length; sequence ids
    are unique and the same on every run over the same files, a retried task
    included."""
    if max_len & (max_len - 1) or max_len < 1:
        raise ValueError("max_len must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        if task >> TASK_BITS:
            raise OverflowError("more tasks than sequence ids allow")
        for batch in slices(batches, 200):
            rows = []
            docs, texts = batch_rows(batch, "doc_id", "text")
            for doc, found in zip(docs, enc.ids(texts), strict=True):
                ids = np.append(found.astype("<u4"), np.uint32(end_id))
                start = 0
                for length in piece_lengths(len(ids), max_len):
                    bucket = length.bit_length() - 1
                    sequence = (bucket << TASK_BITS | task) << COUNT_BITS | made
                    made += 1
                    rows.append((doc, start, length, len(ids), bucket, sequence, 0, ids[start : start + length].tobytes()))
                    start += length
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            types = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 2 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "bucket", "sequence_id", "offset", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
