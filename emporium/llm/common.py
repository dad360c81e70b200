"""Helpers shared by the operators: tables, scratch tables, word hashes.

Operators read only the id and text columns they are told to and return only
their own columns, so extra or clashing column names in the input never matter.
"""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.session import checkpoint_dir

# Odd 64-bit multipliers (fixed values) that give word positions different weights.
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
    dtype=np.uint64,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, never a machine-local one."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query are dropped when it has ended (else they stay
    until the driver collects its garbage)."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before) if before else spark.conf.unset(DROP_SHUFFLES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def batch_rows(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Columns as Python lists; strings come as UTF-8 bytes, null texts as b''."""
    out = []
    for name in names:
        column = batch.column(name)
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            out.append([x or b"" for x in column.cast(pa.large_binary()).to_pylist()])
        else:
            out.append(column.to_pylist())
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64-bit word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each window of ``k`` word hashes; a shorter sequence is
    one shingle, an empty one has none."""
    n = len(words)
    if n == 0:
        return words
    size = min(k, n)
    total = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        m = MULTIPLIERS[i % len(MULTIPLIERS)] + np.uint64(2 * (i // len(MULTIPLIERS)))
        total += mix(words[i : n - size + 1 + i] + np.uint64(i + 1)) * m
    return mix(total + np.uint64(size))


def sorted_distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x if len(x) < 2 else x[np.concatenate(([True], x[1:] != x[:-1]))]


class Numbers(dict):
    """Consecutive numbers for the keys met, in order of appearance."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def give_back() -> None:
    """Give the worker's unused memory back, as workers outlive tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut the batches of a partition into pieces of at most ``rows`` rows; in
    the end give unused memory back."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def drop_scratch(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete scratch tables that no later step reads (made by ``stored``)."""
    root = checkpoint_dir(spark)
    jvm = spark.sparkContext._jvm
    for df in frames:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(root).toUri().getPath() + "/"):
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


PART = 1 << 14  # numbers per row while arrays are added up
GATHER = 256  # rows that one task adds up at first


def array_rows(counts: np.ndarray, task: int) -> pa.RecordBatch:
    """An array of a task in rows of ``PART`` numbers, for ``summed_arrays``."""
    parts = range(-(-len(counts) // PART))
    ends = np.minimum(np.arange(len(parts) + 1) * PART, len(counts)) * 8
    numbers = pa.py_buffer(np.ascontiguousarray(counts, np.int64))  # not copied
    return pa.RecordBatch.from_arrays(
        [
            pa.array(parts, pa.int32()),
            pa.array([task // GATHER] * len(parts), pa.int32()),
            pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends.astype(np.int32)), numbers]),
        ],
        names=["part", "salt", "counts"],
    )


ARRAY_ROWS = "part int, salt int, counts binary"


def summed_arrays(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of the tasks' arrays of ``size`` numbers, which only the sum reaches
    the driver: first over ``GATHER`` tasks each, then over these."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table.column("counts")[0].as_buffer()) // 8, np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(x.as_buffer(), np.int64)
        return pa.table({"part": table.column("part")[:1], "salt": table.column("salt")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    parts = rows.groupBy("part", "salt").applyInArrow(add, ARRAY_ROWS).groupBy("part").applyInArrow(add, ARRAY_ROWS)
    out = np.zeros(size, np.int64)
    for row in parts.select("part", "counts").collect():
        at = row["part"] * PART
        out[at : at + PART] = np.frombuffer(row["counts"], np.int64)
    return out


FILTER_BITS = 1 << 28  # 32 MB at most, whatever the number of ids


class IdFilter:
    """A Bloom filter of a column of ids: 12 bits an id, rounded up to a power of
    two, between 128 KB and 32 MB.

    It holds every id it was made of; beyond some 20 million ids more and more
    others pass too, so it only ever saves work, such as texts that need not be
    read again.  Its words are combined in Spark; the driver gets the filter."""

    def __init__(self, ids: DataFrame, column: str):
        ids = stored(ids.select(F.col(column).cast("long").alias(column)).where(F.col(column).isNotNull()).distinct(), "filter-ids")
        self.size = min(FILTER_BITS, max(1 << 20, 1 << (12 * ids.count()).bit_length()))
        places = [F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(self.size)) for seed in range(3)]
        words = (
            ids.select(F.explode(F.array(*places)).alias("place"))
            .groupBy(F.expr("place >> 6").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
            .toArrow()
        )
        drop_scratch(ids.sparkSession, ids)
        table = np.zeros(self.size // 64, np.int64)
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        self.bits = ids.sparkSession.sparkContext.broadcast(table)

    def places(self, column: str) -> list:
        """Columns to pass along for ``holds``."""
        return [F.pmod(F.xxhash64(F.col(column).cast("long"), F.lit(seed)), F.lit(self.size)).alias(f"place{seed}") for seed in range(3)]

    def may_hold(self, column: str):
        """Column: may the id be one of the ids."""
        bits = self.bits

        @F.arrow_udf("boolean")
        def held(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
            out = np.ones(len(a), bool)
            for place in (x.to_numpy(zero_copy_only=False) for x in (a, b, c)):
                out &= (bits.value[place >> 6] >> (place & 63)) & 1 == 1
            return pa.array(out)

        return held(*self.places(column))

    def holds(self, batch: pa.RecordBatch) -> np.ndarray:
        """For each row whether its id may be one of the ids."""
        out = np.ones(batch.num_rows, bool)
        for seed in range(3):
            place = batch.column(f"place{seed}").to_numpy(zero_copy_only=False)
            out &= (self.bits.value[place >> 6] >> (place & 63)) & 1 == 1
        return out
