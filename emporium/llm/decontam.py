"""Benchmark decontamination by SimHash of item-sized windows.

Windows.  A benchmark item of m words is looked for in windows of m words of
each document (fewer at its ends).  Two texts without a common shingle have
similarity 0, so a window is made only where the document has a shingle of the
benchmark: at each such place, the windows that put it where the items have it.

Fingerprints.  A window's SimHash has 64 bits, each the sign of the sum of its
shingles' hash bits.  Per item size the index has eight blocks of eight bits: two
fingerprints within ``radius`` (at most 23) bits agree in some block up to two
bits, so looking up each block and its neighbours of up to two flipped bits
finds every item within the radius.  A window of m words meets items of m words
only; of those, blocks this short leave out few (one in three).

Verification.  Candidates are compared exactly: sum of weight x min(count) over
sum of weight x max(count) of the shingles of window and item.  The weight of a
shingle of the item is log2(1 + items / items that hold it), that of any other
log2(1 + items).  Pairs of ``threshold`` or more are reported, per document and
item the best window.

Words are runs without white space, A-Z lower-cased, ASCII punctuation dropped.
Holders are counted in Spark over the whole benchmark.  It is broadcast in slices
of about ``slice_items`` items, one after the other, each with a pass over the
documents, so a large benchmark costs passes, not memory, and results do not
depend on the slices.  Equal items (id and text) are one item.

Defined results: an item without words matches nothing; an item of fewer than k
words is one shingle, found by exact equality of its words; documents without
text match nothing; null ids are reported as null; each row of a repeated id is
searched, and reported, on its own.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import batch_rows, id_and_text, mix, slices, stored

SCHEMA = "doc_id long, item_id long, similarity double, hamming int, start_word long, n_words long, n_windows long"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # fixed values: ASCII punctuation
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLOCKS = 8

# Every byte at a distance of at most two bits from 0.
NEAR = [x for x in range(256) if x.bit_count() <= 2]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER, PUNCTUATION).split()


def shingles_of(words: list[bytes], k: int) -> list[bytes]:
    """Shingles in order; fewer than k words are one shingle."""
    if not words:
        return []
    return [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]


def hash_of(shingle: bytes) -> int:
    """Signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(shingle) - (1 << 63)


def simhash(counts: Counter) -> int:
    """Sign bits of the sums over the shingles' hash bits."""
    hashes = np.array([xxhash.xxh3_64_intdigest(s) for s in counts], np.uint64)
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    up = np.array(list(counts.values())) @ (2.0 * bits - 1.0) > 0
    return int(np.packbits(up).view(">u8")[0])


def blocks(fingerprint: int) -> list[int]:
    return [fingerprint >> 8 * b & 255 for b in range(BLOCKS)]


class Benchmark:
    """Items, shingle weights and the multi-index; rebuilt by each task from
    the broadcast texts.  For a slice, ``total`` is the number of all items and
    ``holders`` has the shingles, by hash, that several of all items hold."""

    def __init__(self, items: list[tuple[int, bytes]], k: int, radius: int, threshold: float, total: int | None = None, holders: dict[int, int] | None = None):
        if not 0 <= radius <= 3 * BLOCKS - 1:
            raise ValueError("the index covers radii of up to 23 bits")
        self.k, self.radius, self.threshold = k, radius, threshold
        words = [words_of(text) for _, text in items]
        self.ids = [i for i, _ in items]
        self.sizes = [len(w) for w in words]
        self.counts = [Counter(shingles_of(w, k)) for w in words]
        total = max(1, len(items) if total is None else total)
        held = Counter(hash_of(s) for c in self.counts for s in c) if holders is None else holders
        self.weight = lambda s: float(np.log2(1 + total / held.get(hash_of(s), 1)))
        self.weights = [{s: self.weight(s) for s in c} for c in self.counts]
        self.foreign = float(np.log2(1 + total))
        self.prints = np.array([simhash(c) if c else 0 for c in self.counts], np.uint64)
        # per item size, per block: value -> items
        self.index: dict[int, list[dict[int, list[int]]]] = {}
        for n, size in enumerate(self.sizes):
            if size:
                tables = self.index.setdefault(size, [defaultdict(list) for _ in range(BLOCKS)])
                for table, block in zip(tables, blocks(int(self.prints[n])), strict=True):
                    table[block].append(n)
        # numbers of the benchmark's words; 0 is any other word
        vocabulary = sorted({w for ws in words for w in ws})
        self.number = {w: i + 1 for i, w in enumerate(vocabulary)}.get
        # per shingle size (k, or a short item's length): code of the shingle -> (offset, item size)
        self.places: dict[int, dict[int, set[tuple[int, int]]]] = {}
        for w in words:
            size = min(k, len(w))
            codes = self.codes(self.numbers(w), size) if w else []
            for offset, code in enumerate(codes):
                self.places.setdefault(size, {}).setdefault(int(code), set()).add((offset, len(w)))
        self.known = {size: np.sort(np.array(list(p), np.uint64)) for size, p in self.places.items()}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self.number(w, 0) for w in words), np.uint64, len(words))

    @staticmethod
    def codes(numbers: np.ndarray, size: int) -> np.ndarray:
        n = len(numbers) - size + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        code = np.zeros(n, np.uint64)
        for i in range(size):
            code = mix(code + numbers[i : n + i] + np.uint64(1))
        return code

    def windows(self, words: list[bytes]) -> set[tuple[int, int, int]]:
        """(start, words, item size) of the windows that hold a benchmark shingle in place."""
        numbers, found = self.numbers(words), set()
        for size, known in self.known.items():
            codes = self.codes(numbers, size)
            if not len(codes):
                continue
            at = np.searchsorted(known, codes)
            at[at == len(known)] = 0
            for p in np.flatnonzero(known[at] == codes):
                for offset, length in self.places[size][int(codes[p])]:
                    start, end = max(0, int(p) - offset), min(len(words), int(p) - offset + length)
                    found.add((start, end - start, length))
        return found

    def near(self, fingerprint: int, size: int) -> list[int]:
        """Items of the size that agree with the fingerprint in a block up to two bits."""
        tables = zip(self.index.get(size, ()), blocks(fingerprint), strict=False)
        return sorted({n for table, block in tables for flip in NEAR for n in table.get(block ^ flip, ())})

    def within(self, fingerprint: int, size: int | None = None) -> list[tuple[int, int]]:
        """(item, distance) of every item of the size (of any, if none is given) within the radius."""
        near = np.array([n for m in (self.index if size is None else [size]) for n in self.near(fingerprint, m)], np.int64)
        apart = np.bitwise_count(self.prints[near] ^ np.uint64(fingerprint))
        return [(int(n), int(d)) for n, d in zip(near, apart, strict=True) if d <= self.radius]

    def similarity(self, window: Counter, item: int) -> float:
        other, weights = self.counts[item], self.weights[item]
        both = sum(w * min(window.get(s, 0), other[s]) for s, w in weights.items())
        each = sum(w * max(window.get(s, 0), other[s]) for s, w in weights.items()) + self.foreign * sum(n for s, n in window.items() if s not in other)
        return both / each if each else 0.0

    def matches(self, text: bytes) -> list[tuple[int, float, int, int, int, int]]:
        """Per item found: id, similarity, distance, start and length of the
        best window, and the number of windows that match."""
        words = words_of(text)
        best: dict[int, tuple] = {}
        times: Counter = Counter()
        for start, length, size in sorted(self.windows(words)):
            window = Counter(shingles_of(words[start : start + length], self.k))
            for item, apart in self.within(simhash(window), size):
                alike = self.similarity(window, item)
                if alike >= self.threshold:
                    times[item] += 1
                    best[item] = max(best.get(item, (0.0,)), (alike, -apart, -start, length))
        return [(self.ids[i], x[0], -x[1], -x[2], x[3], times[i]) for i, x in sorted(best.items())]


def numbered(items: DataFrame, k: int) -> DataFrame:
    """Distinct items with a number and the (hash, holders) of their shingles that several hold."""
    items = items.distinct().withColumn("item", F.xxhash64(F.col("item_id").isNull(), F.coalesce("item_id", F.lit(0)), F.col("text").isNull(), F.coalesce("text", F.lit(""))))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            numbers, texts = batch_rows(batch, "item", "text")
            rows = [(n, h) for n, text in zip(numbers, texts, strict=True) for h in {hash_of(s) for s in shingles_of(words_of(text), k)}]
            columns = list(zip(*rows, strict=True)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "hash"])

    held = items.select("item", "text").mapInArrow(shingles, "item long, hash long")
    common = held.groupBy("hash").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    own = held.join(common, "hash").groupBy("item").agg(F.collect_list(F.struct("hash", "holders")).alias("common"))
    return items.join(own, "item", "left")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = 5,
    threshold: float = 0.8,
    radius: int = 20,
    slice_items: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and benchmark item found in it.  One pass over the
    texts per slice of the benchmark, no shuffle of documents; several slices are
    worked one after the other, their matches written to the shared folder."""
    docs = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    items = stored(numbered(items, k), "benchmark")
    total = items.count()
    n_slices = max(1, -(-total // slice_items))

    def one(number: int) -> DataFrame:
        own = items.where(F.pmod("item", F.lit(n_slices)) == number).collect()
        holders = {c["hash"]: c["holders"] for r in own for c in r["common"] or ()}
        texts = sorted(((r["item_id"], (r["text"] or "").encode()) for r in own), key=lambda x: (x[0] is None, x))
        held = spark.sparkContext.broadcast((texts, holders))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, holders = held.value
            marks = Benchmark(texts, k, radius, threshold, total, holders)
            for batch in slices(batches, 1000):
                rows = [(doc, *m) for doc, text in zip(*batch_rows(batch, "doc_id", "text"), strict=True) for m in marks.matches(text)]
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "item_id", "similarity", "hamming", "start_word", "n_words", "n_windows"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        found = docs.mapInArrow(run, SCHEMA)
        if n_slices == 1:
            return found
        found = stored(found, "decontamination")
        held.destroy()
        return found

    return reduce(DataFrame.unionByName, map(one, range(n_slices)))
