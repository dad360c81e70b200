"""Interpolated modified Kneser-Ney bigram model over memory-mapped hash arrays.

Counting.  Each task counts the word pairs of its texts and sends them, grouped
by the hash of the first word, to shards; a shard adds up what all tasks sent.
Partial counts make a frequent pair one entry per flush of a task.  The number of
shards grows with the text (``SHARD_BYTES`` of text each), their size does not,
and a task merges one shard: a first pass over all texts finds the hot contexts, words that hold more than a
shard's share of the tokens, and their pairs go to shards by the hash of the
pair.  So every other context is smaller than a mean shard, and a hot one is
spread over all of them; there are at most a few hot contexts a shard.  Which
contexts are hot decides only where counts lie, never a score.

Storage.  A shard is a set of sorted arrays in the shared folder: pair hashes
with counts, context hashes with their totals and numbers of followers seen
once, twice and more often, word hashes with counts and numbers of distinct
predecessors.  Workers map the arrays into memory and search them; nothing of
the model passes through the driver but a dozen sums.  Files appear by an
atomic rename and hold the same bytes whichever attempt writes them, so lost
executors and repeated tasks do no harm.  The folder must be mounted on all
machines (a local path or file:// with a shared mount).

Model.  p(w|v) = max(c(vw) - D(c), 0) / c(v.) + g(v) p(w), with the discounts
D1, D2, D3+ of Chen and Goodman from the counts of counts; p(w) likewise from
the numbers of distinct predecessors, interpolated with 1/(V+1), which is also
the whole of an unknown word's share.

Tokens: A-Z lower-cased words, then one end token.  Defined results: a null or
empty text is the end token alone; with no training text every token has
p = 1/(V+1) = 1; null ids stay null; repeated rows are scored, and learned
from, each on their own.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import MULTIPLIERS, Numbers, batch_rows, drop_scratch, id_and_text, mix, slices, stored

START, END = 0, 1
RESERVED = mix(np.array([1, 2], np.uint64))  # hashes of the start and of the end
SHARD_BYTES = 24 << 20
FLUSH = 3_000_000  # tokens whose pairs are counted at once
OPEN = 4096  # arrays that a task keeps mapped
VOCABULARY = 2_000_000  # words that a task remembers; beyond it starts anew
CHUNKS = "kind int, shard int, contexts binary, runs binary, words binary, counts binary"
CHUNK_NAMES = ["kind", "shard", "contexts", "runs", "words", "counts"]


class Words:
    """Numbers and hashes of the words of a task; 0 is the start, 1 the end."""

    def __init__(self):
        self.number = Numbers({b"\x00 start": START, b"\x00 end": END})  # words hold no space
        self.hashes = RESERVED

    def tokens(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        out = np.empty(len(words) + 1, np.int64)
        out[:-1] = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        out[-1] = END
        return out

    def hashed(self) -> np.ndarray:
        if len(self.hashes) < len(self.number):
            new = list(self.number)[len(self.hashes) :]
            self.hashes = np.concatenate((self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))))
        return self.hashes


def pair_hash(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(contexts * MULTIPLIERS[0] + mix(words))


def pairs_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words, and what stands before each, of texts end to end."""
    words = np.concatenate(texts)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum([0] + [len(t) for t in texts[:-1]])] = START
    return before, words


def runs_of(x: np.ndarray) -> np.ndarray:
    """First places of the runs of equal values."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def pair_shards(contexts: np.ndarray, pairs: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """Shards of pairs: by the context, or by the pair if the context is hot."""
    return np.where(np.isin(contexts, hot), shard_of(pairs, bits), shard_of(contexts, bits))


def hot_contexts(texts: DataFrame, bits: int) -> np.ndarray:
    """Hashes of all contexts that hold more than one of ``1 << bits`` shares of
    the tokens, and of some that hold three quarters of that.

    A task reports, for every ``FLUSH`` of its tokens, the words that hold a
    quarter of such a share there, so at most ``4 << bits`` words.  Of a hot word
    less than a quarter of a share goes unreported."""
    if not bits:
        return np.zeros(0, np.uint64)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, starts, n = Counter(), 0, 0

        def report() -> pa.RecordBatch:
            often = [(xxhash.xxh3_64_intdigest(w), c) for w, c in seen.items() if c * (4 << bits) >= n]
            keys = np.array([int(RESERVED[0]), *(k for k, _ in often)], np.uint64).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([None, *keys.tolist()], pa.int64()), pa.array([n, starts, *(c for _, c in often)], pa.int64())], names=["key", "n"]
            )

        for batch in slices(batches, 1000):
            for text in batch_rows(batch, "text")[0]:
                words = text.lower().split()
                seen.update(words)
                starts, n = starts + 1, n + len(words) + 1
            if n >= FLUSH:
                yield report()
                seen, starts, n = Counter(), 0, 0
        if n:
            yield report()

    counts = stored(texts.mapInArrow(tally, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "kn-hot")
    total = counts.where("key is null").first()
    found = counts.where("key is not null").where(F.col("n") * (4 << bits) >= 3 * total["n"]).collect() if total else []
    drop_scratch(texts.sparkSession, counts)
    return np.sort(np.array([r["key"] for r in found], np.int64).astype(np.uint64))


def chunk(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=CHUNK_NAMES)


def _pair_chunks(words: Words, texts: list[np.ndarray], hot: np.ndarray, bits: int) -> list[tuple]:
    before, after = pairs_of(texts)
    hashes = words.hashed()
    codes = np.sort(before * len(hashes) + after)
    first = runs_of(codes)
    counts = np.diff(np.append(first, len(codes))).astype(np.uint32)
    contexts, followers = np.divmod(codes[first], len(hashes))
    shards = pair_shards(hashes[contexts], pair_hash(hashes[contexts], hashes[followers]), hot, bits)
    order = np.argsort(shards, kind="stable")
    edges = np.searchsorted(shards[order], np.arange((1 << bits) + 1))
    rows = []
    for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if a < b:
            own = order[a:b]
            at = runs_of(contexts[own])
            runs = np.diff(np.append(at, b - a)).astype(np.uint32)
            rows.append((2, s, hashes[contexts[own][at]].tobytes(), runs.tobytes(), hashes[followers[own]].tobytes(), counts[own].tobytes()))
    return rows


def _word_chunks(hashes: np.ndarray, counts: np.ndarray, bits: int, kind: int) -> list[tuple]:
    shards = shard_of(hashes, bits)
    rows = []
    for s in np.unique(shards):
        own = shards == s
        rows.append((kind, int(s), None, None, hashes[own].tobytes(), counts[own].astype(np.uint64).tobytes()))
    return rows


def _save(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(part, array)
    os.replace(part, f"{folder}/{name}.npy")


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, each with the sums of its values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = runs_of(keys)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype)


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of entries seen once to four times; one
    absolute discount where a number is missing or a discount leaves its range."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    if min(n) > 0:
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x < i + 1 for i, x in enumerate(d)):
            return d
    return (min(y, 0.9),) * 3


@dataclass(frozen=True)
class KneserNey:
    folder: str
    bits: int
    tokens: int  # N
    types: int  # V
    predecessors: int  # distinct pairs
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    rest: float  # share of the uniform distribution in p(w)
    hot: np.ndarray  # sorted hashes of the contexts whose pairs lie in all shards


def train(docs: DataFrame, path: str, text_col: str = "text", shard_bytes: int = SHARD_BYTES, flush_tokens: int = FLUSH, vocabulary: int = VOCABULARY) -> KneserNey:
    """Count ``docs`` and write the model's arrays below ``path``, a folder
    that all machines share."""
    place = urlparse(path)
    if place.scheme not in ("", "file"):
        raise ValueError(f"{path}: the model is memory-mapped and needs a folder mounted on all machines")
    folder = place.path
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, (max(1, size) // shard_bytes).bit_length())
    hot = hot_contexts(texts, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, n = Words(), [], 0
        totals = np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            nonlocal totals
            own = np.bincount(np.concatenate(held), minlength=len(words.number))
            own[: len(totals)] += totals
            totals = own
            return chunk(_pair_chunks(words, held, hot, bits))

        def word_counts() -> pa.RecordBatch:
            seen = np.flatnonzero(totals)
            return chunk(_word_chunks(words.hashed()[seen], totals[seen], bits, 1))

        for batch in slices(batches, 1000):
            for text in batch_rows(batch, "text")[0]:
                held.append(words.tokens(text))
                n += len(held[-1])
            if n >= flush_tokens:
                yield flush()
                held, n = [], 0
                if len(words.number) > vocabulary:
                    yield word_counts()
                    words, totals = Words(), np.zeros(0, np.int64)
        if held:
            yield flush()
        yield word_counts()

    def merge_pairs(table: pa.Table) -> pa.Table:
        kind, shard = table.column("kind")[0].as_py(), table.column("shard")[0].as_py()
        words = _joined(table.column("words"), np.uint64)
        if kind == 1:
            keys, counts = _summed(words, _joined(table.column("counts"), np.uint64))
            return pa.Table.from_batches([chunk([(1, shard, None, None, keys.tobytes(), counts.tobytes())])])
        contexts = np.repeat(_joined(table.column("contexts"), np.uint64), _joined(table.column("runs"), np.uint32))
        counts = _joined(table.column("counts"), np.uint32).astype(np.uint64)
        hashes = pair_hash(contexts, words)
        order = np.argsort(hashes)
        first = runs_of(hashes[order])
        counts = np.add.reduceat(counts[order], first)
        contexts, words = contexts[order][first], words[order][first]
        _save(folder, f"pairs-{shard}", hashes[order][first])
        _save(folder, f"pair-counts-{shard}", np.minimum(counts, 2**32 - 1).astype(np.uint32))
        keys, *numbers = _summed(contexts, counts, *((counts == i).astype(np.uint64) for i in (1, 2)), (counts > 2).astype(np.uint64))
        numbers, spread = np.stack(numbers, axis=1), np.isin(keys, hot)
        _save(folder, f"contexts-{shard}", keys[~spread])
        _save(folder, f"context-numbers-{shard}", numbers[~spread])
        parts = [(5, int(s), None, None, h.tobytes(), x.tobytes()) for s, h, x in zip(shard_of(keys[spread], bits), keys[spread], numbers[spread], strict=True)]
        followers, before = _summed(words, np.ones(len(words), np.uint64))
        stats = np.array([*counts_of_counts(counts), len(counts)], np.uint64)
        return pa.Table.from_batches([chunk([*_word_chunks(followers, before, bits, 2), *parts, (3, shard, None, None, None, stats.tobytes())])])

    def merge_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        kinds = table.column("kind").to_numpy()
        keys, values = [], []
        for kind, words, counts in zip(kinds, table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
            keys.append(np.frombuffer(words, np.uint64))
            own = np.zeros((len(keys[-1]), 2), np.uint64)
            own[:, kind - 1] = np.frombuffer(counts, np.uint64)
            values.append(own)
        numbers = np.concatenate(values)
        found, raw, before = _summed(np.concatenate(keys), numbers[:, 0], numbers[:, 1])
        _save(folder, f"words-{shard}", found)
        _save(folder, f"word-numbers-{shard}", np.stack((raw, before), axis=1))
        stats = np.array([*counts_of_counts(before), (before > 2).sum(), before.sum(), raw.sum(), len(found)], np.uint64)
        return pa.Table.from_batches([chunk([(4, shard, None, None, None, stats.tobytes())])])

    def merge_hot(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        numbers = _joined(table.column("counts"), np.uint64).reshape(-1, 4)
        keys, *sums = _summed(_joined(table.column("words"), np.uint64), *numbers.T)
        _save(folder, f"hot-contexts-{shard}", keys)
        _save(folder, f"hot-context-numbers-{shard}", np.stack(sums, axis=1))
        return pa.Table.from_batches([chunk([])])

    # a partition is a shard: hashing its number would put several into one task
    def of_shards(rows: DataFrame, *merges) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            for kinds, merge in merges:
                own = [b.filter(pa.array(np.isin(b.column("kind").to_numpy(), kinds))) for b in held]
                own = [b for b in own if b.num_rows]
                if own:
                    yield from merge(pa.Table.from_batches(own)).to_batches()

        return rows.repartitionById(1 << bits, F.col("shard")).mapInArrow(run, CHUNKS)

    first = stored(of_shards(texts.mapInArrow(count, CHUNKS), ([1], merge_pairs), ([2], merge_pairs)), "kn-words")
    pairs = [np.frombuffer(r["counts"], np.uint64) for r in first.where("kind = 3").select("counts").collect()]
    second = of_shards(first.where("kind <> 3"), ([1, 2], merge_words), ([5], merge_hot))
    words = [np.frombuffer(r["counts"], np.uint64) for r in second.select("counts").collect()]
    drop_scratch(docs.sparkSession, first)
    p = [int(x) for x in sum(pairs)] if pairs else [0] * 5
    w = [int(x) for x in sum(words)] if words else [0] * 8
    d = discounts(w[:4])
    rest = (d[0] * w[0] + d[1] * w[1] + d[2] * w[4]) / w[5] if w[5] else 1.0
    return KneserNey(folder, bits, w[6], w[7], w[5], discounts(p[:4]), d, rest, hot)


class Arrays:
    """The arrays of a model, mapped into this worker's memory when needed."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.open = lru_cache(maxsize=OPEN)(self._open)

    def _open(self, name: str, shard: int) -> np.ndarray | None:
        path = f"{self.model.folder}/{name}-{shard}.npy"
        return np.load(path, mmap_mode="r") if os.path.exists(path) else None

    def numbers(self, keys: str, numbers: str, shards: np.ndarray, hashes: np.ndarray, width: int) -> np.ndarray:
        """Rows of ``numbers`` at the hashes, zeros for hashes that are not there."""
        out = np.zeros((len(hashes), width), np.float64)
        if not len(hashes):
            return out
        order = np.argsort(shards.astype(np.uint16) if self.model.bits <= 16 else shards, kind="stable")
        starts = runs_of(shards[order])
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            s = int(shards[order[a]])
            known = self.open(keys, s)
            if known is not None and len(known):
                own = order[a:b]
                own = own[np.argsort(hashes[own])]  # in order, so that a search finds its pages in memory
                at = np.searchsorted(known, hashes[own])
                at[at == len(known)] = 0
                hit = known[at] == hashes[own]
                out[own[hit]] = np.asarray(self.open(numbers, s)[at[hit]]).reshape(-1, width)
        return out


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: KneserNey, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY) -> DataFrame:
    """Per document: tokens, tokens seen in training, the add-one unigram score
    and the model's log10 probability of the text.  No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, words, bits = Arrays(model), Words(), model.bits
        known = np.zeros((0, 2))  # count and distinct predecessors, by word number
        follow = np.zeros((0, 4))  # total, followers seen once, twice, more, by word number
        for batch in slices(batches, 1000):
            ids, texts = batch_rows(batch, "doc_id", "text")
            if len(words.number) > vocabulary:
                words, known, follow = Words(), known[:0], follow[:0]
            tokens = [words.tokens(t) for t in texts]
            hashes = words.hashed()
            new = hashes[len(known) :]
            known = np.concatenate((known, arrays.numbers("words", "word-numbers", shard_of(new, bits), new, 2)))
            own = arrays.numbers("contexts", "context-numbers", shard_of(new, bits), new, 4)
            own += arrays.numbers("hot-contexts", "hot-context-numbers", shard_of(new, bits), new, 4)
            follow = np.concatenate((follow, own))
            before, after = pairs_of(tokens)
            pairs = pair_hash(hashes[before], hashes[after])
            count = arrays.numbers("pairs", "pair-counts", pair_shards(hashes[before], pairs, model.hot, bits), pairs, 1)[:, 0]
            uniform = 1.0 / (model.types + 1)
            own = known[:, 1]
            single = discounted(own, model.word_discounts) / max(1, model.predecessors) + model.rest * uniform
            total = follow[:, 0]
            share = np.where(total > 0, follow[:, 1:] @ np.array(model.pair_discounts) / np.maximum(total, 1), 1.0)
            p = discounted(count, model.pair_discounts) / np.maximum(total, 1)[before] + share[before] * single[after]
            starts = np.cumsum([0] + [len(t) for t in tokens[:-1]])
            seen = known[after, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array(np.add.reduceat((seen > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(np.log10((seen + 1) / (model.tokens + model.types + 1)), starts)),
                    pa.array(np.add.reduceat(np.log10(p), starts)),
                ],
                names=[c.split()[0] for c in SCORES.split(", ")],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCORES)


def perplexity(n_tokens, log10_score):
    """Perplexity column of scored documents."""
    return F.pow(F.lit(10.0), -log10_score / n_tokens)
