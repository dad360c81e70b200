"""Quality rules and a log-likelihood-ratio verdict on every document.

Model.  Words and adjacent word pairs are hashed into ``buckets`` buckets.
Two multinomials over the buckets are counted in Spark: one over all documents
(the raw corpus), one over trusted documents (quality 1, not toxic).  A feature
weighs log (trusted + a) - log (expected + a), where expected is how often it
would occur in as much raw text and a is ``PRIOR``: a feature too rare to say
anything, seen in trusted text or not, weighs nearly nothing, whatever the size
of the table.  The score of a document is the mean over its words and pairs:
length-normalised, so long and short texts compare.

Threshold.  A quarter of the trusted documents, by a hash of the id, is left out
of the counts and scored with them.  A document is kept when it passes the base
rules and scores no less than their mean less ``DEVIATIONS`` standard deviations;
the same document always gets the same verdict.

The raw counts cover every document, the trusted ones every trusted document.
Texts that count are found by a join on the id: a filter of fixed size leaves out
nearly all others, so only they are shuffled, and none is stored.  Texts for the
threshold are scored where they are read; only ids and scores are joined.  A model
is ``buckets`` numbers whatever the corpus holds.

Defined results: a null or empty text has no words and fails the base rules;
a null id is scored but never trusted; without trusted documents every score
is 0, and with fewer than ``LEAST`` left-out ones there is no threshold: then only
the base rules decide; repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import ARRAY_ROWS, MULTIPLIERS, IdFilter, array_rows, batch_rows, drop_scratch, dropping_shuffles, give_back, id_and_text, mix, shingle_hashes, slices, stored, summed_arrays

SYMBOLS = "#*$%&|<>"  # fixed values
SPACES = " \t\n\r\x0b\x0c"  # fixed values: the characters between words

BUCKETS = 1 << 17
PRIOR = 2.0  # occurrences added to seen and to expected ones
DEVIATIONS = 3.0
FOLDS = 4  # one of them sets the threshold
LEAST = 8  # left-out documents that a threshold takes


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def features(words: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the words and of the adjacent pairs of a document."""
    pairs = words[:-1] * MULTIPLIERS[0] + words[1:] * MULTIPLIERS[1]
    return (mix(np.concatenate((words, pairs))) % np.uint64(buckets)).astype(np.int64)


def base_measures(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    characters = len(text.decode()) - sum(text.count(c.encode()) for c in SPACES)
    symbols = sum(text.count(c.encode()) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip(SPACES.encode())]
    repeated = 0
    if len(words) > 5:
        windows = shingle_hashes(hashes, 5)
        order = np.sort(windows)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            at = np.flatnonzero(np.isin(windows, twice))
            ends = np.zeros(len(words) + 1, np.int64)
            np.add.at(ends, at, 1)
            np.add.at(ends, at + 5, -1)
            repeated = int((np.cumsum(ends) > 0).sum())
    return characters, symbols, len(lines) - len(set(lines)), repeated


@dataclass(frozen=True)
class Model:
    """log p_trusted - log p_raw per bucket, as float32 bytes."""

    ratios: bytes
    threshold: float

    def scores(self) -> np.ndarray:
        return np.frombuffer(self.ratios, np.float32)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all trusted documents: labelled quality 1, never labelled otherwise or toxic."""
    rows = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = rows.agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 and t = 0")
    return good.select("doc_id")


def left_out(column: str = "doc_id"):
    """Column: is a trusted document kept for the threshold."""
    return F.pmod(F.xxhash64(F.col(column).cast("long"), F.lit(11)), F.lit(FOLDS)) == 0


def feature_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in the texts, added up in Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in slices(batches, 500):
            own = [features(word_hashes(t.split()), buckets) for t in batch_rows(batch, "text")[0]]
            sums += np.bincount(np.concatenate(own), minlength=buckets)
        yield array_rows(sums, TaskContext.get().partitionId())

    return summed_arrays(docs.select("text").mapInArrow(count, ARRAY_ROWS), buckets)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Count both multinomials, then set the threshold; the driver gets the sums
    (2 x ``buckets`` numbers) and the filter of the trusted ids."""
    docs = id_and_text(docs, id_col, text_col)
    chosen = stored(trusted_ids(labels).withColumn("held", left_out()), "quality-ids")
    counted, held = (chosen.where(side).select("doc_id") for side in ("not held", "held"))
    read = docs.where(IdFilter(counted, "doc_id").may_hold("doc_id"))
    with dropping_shuffles(docs.sparkSession):
        # always shuffled: filter and count in one stage would take two workers a task
        good = feature_counts(read.join(counted.hint("shuffle_merge"), "doc_id"), buckets)
    if not good.sum():
        drop_scratch(docs.sparkSession, chosen)
        return Model(np.zeros(buckets, np.float32).tobytes(), -np.inf)
    raw = feature_counts(docs, buckets)
    expected = raw * (good.sum() / raw.sum())
    ratios = (np.log(good + PRIOR) - np.log(expected + PRIOR)).astype(np.float32).tobytes()
    scores = passing_scores(docs, held, Model(ratios, -np.inf)).groupBy("doc_id").agg(F.avg("score").alias("score"))
    n, mean, spread = scores.agg(F.count(F.lit(1)), F.avg("score"), F.stddev_pop("score")).first()
    drop_scratch(docs.sparkSession, chosen)
    return Model(ratios, mean - DEVIATIONS * spread if n >= LEAST else -np.inf)


def passing_scores(docs: DataFrame, ids: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of the documents of ``ids`` that pass the base rules."""
    may = IdFilter(ids, "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            own, texts = batch_rows(batch.filter(pa.array(may.holds(batch))), "doc_id", "text")
            rows = measure(texts, shared.value.scores(), shared.value.threshold)
            passed = [(i, r[6]) for i, r in zip(own, rows, strict=True) if not r[5]]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in passed], pa.int64()), pa.array([x for _, x in passed], pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text", *may.places("doc_id")).mapInArrow(score, "doc_id long, score double").join(ids, "doc_id")


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def measure(texts: list[bytes], ratios: np.ndarray, threshold: float) -> list[tuple]:
    rows = []
    for text in texts:
        words = text.split()
        hashes = word_hashes(words)
        base = base_measures(text, words, hashes)
        failed = len(words) < 10 or 100 * base[3] > 20 * len(words)
        score = float(ratios[features(hashes, int(len(ratios)))].mean(dtype=np.float64)) if words else 0.0
        rows.append((len(words), *base, failed, score, not failed and score >= threshold))
    return rows


def judged(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column, the struct ``__verdict`` of the measures."""
    names = [c.split()[0] for c in MEASURES.split(", ")]
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(f"struct<{', '.join(c.replace(' ', ': ') for c in MEASURES.split(', '))}>")
    def verdict(texts: pa.Array) -> pa.Array:
        rows: list[tuple] = []
        for at in range(0, len(texts), 500):
            own = [x or b"" for x in texts.slice(at, 500).cast(pa.large_binary()).to_pylist()]
            rows += measure(own, shared.value.scores(), shared.value.threshold)
        give_back()
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, types[t.split()[1]]) for c, t in zip(columns, MEASURES.split(", "), strict=True)], names=names)

    return docs.withColumn("__verdict", verdict(F.col(text_col).cast("string")))


def verdicts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base measures, score and verdict."""
    return judged(id_and_text(docs, id_col, text_col), model).select("doc_id", "__verdict.*")
