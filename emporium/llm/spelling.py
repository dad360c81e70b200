"""Spelling variants: words one edit apart, by asymmetric q-chunks.

Words.  A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z
lower-cased.  Occurrences are counted where the texts are read, in a table of
bounded size, and added up by a shuffle.

Join.  Of two words one edit (a code point inserted, deleted or replaced)
apart, the longer one, of equally long ones the smaller, contributes two
disjoint chunks, its halves; the edit lies in one of them, so the other is
whole in the other word.  That one contributes its positional grams of the
same length, namely those that begin within one place of a chunk: an edit
before a chunk shifts it by one, no edit shifts it further.  The damaged chunk
consists of two halves too, of which the edit leaves one; this one, with its
shift, lengthens the key.  So the words meet at the key that leaves out the
quarter with the edit, whatever the words are, and a key stands for three
quarters of a word: frequent beginnings and endings do not make large groups.
Every key holds the place of its quarter and the length of the chunked word.

Verification.  Words that meet are compared by their edit distance.  Words of
equal length meet at one key only; for others the key counts that has the first
place at which they differ, so that no pair is found twice.

Forms.  The form of a word is its most frequent near word, if that is at least
``ratio`` times as frequent.  Counts grow along forms, so there are no circles,
and doubling the steps finds all roots in a number of rounds that grows with
the logarithm of the logarithm of the largest count.

Defined results: null and empty texts have no words; a null id counts as an
empty one where the id is hashed; repeated rows count each; runs of any length
are words; of equally frequent near words the smaller in code-point order is
the form; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import batch_rows, drop_scratch, id_and_text, slices, stored

QUARTERS = 4
HELD = 300_000  # words that a task counts before it hands them on
# Letters in Latin-1, A-Z as a-z; all else, and what Latin-1 lacks ('?'), separates words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words_of(text: bytes, shortest: int) -> list[bytes]:
    """The words of a UTF-8 text, in Latin-1, of at least ``shortest`` letters."""
    found = text.decode().encode("latin-1", "replace").translate(LETTERS).split()
    return [w for w in found if len(w) >= shortest]


def misspelt(word: bytes, prefix: int, one_in: int) -> bytes:
    """``word`` without one letter, for one word in ``one_in`` by the hash of id and word."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if h % one_in:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = 6, misspell: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``shortest`` letters in ``docs``.
    With ``misspell`` = m a letter is left out of one (id, word) in m first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, 1000):
            for i, text in zip(*batch_rows(batch, "doc_id", "text"), strict=True):
                own = Counter(words_of(text, shortest))
                if misspell:
                    prefix = zlib.crc32(b":" if i is None else b"%d:" % i)
                    for word, n in own.items():
                        seen = misspelt(word, prefix, misspell)
                        if len(seen) >= shortest:
                            total[seen] += n
                else:
                    total.update(own)
                if len(total) > HELD:
                    yield handed_on()
                    total.clear()
        yield handed_on()

    found = id_and_text(docs, id_col, text_col).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _cuts(length: Column) -> list[Column]:
    """Ends of the quarters of a word: halves of its halves."""
    half = F.floor(length / 2)
    return [F.lit(0).cast("long"), F.floor(half / 2), half, half + F.floor((length - half) / 2), length.cast("long")]


def _keys(longer: int) -> Column:
    """Keys of ``word`` towards words that are ``longer`` letters longer: per
    quarter what is left without it, the quarter being one shorter here."""
    length = F.length("word") + longer
    cuts = _cuts(length)
    out = []
    for k in range(QUARTERS):
        rest = F.concat(F.substr("word", F.lit(1), cuts[k].cast("int")), F.substr("word", (cuts[k + 1] + (1 - longer)).cast("int")))
        fits = cuts[k + 1] - longer >= cuts[k]
        row = F.struct(F.xxhash64(length, F.lit(k), rest).alias("key"), cuts[k + 1].cast("int").alias("upto"))
        out.append(F.when(fits, row))
    return F.array_compact(F.array(*out))


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (a, a_n, b, b_n) of distinct words that are one edit apart, each
    once.  ``words`` has distinct words."""
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.inline(_keys(0)))
    same = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.lit(False).alias("shifted"), F.inline(_keys(0))).drop("upto")
    shorter = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.lit(True).alias("shifted"), F.inline(_keys(1))).drop("upto")
    differ = F.substr("a", F.lit(1), F.col("upto")) != F.substr("b", F.lit(1), F.col("upto"))
    once = F.col("shifted") | (F.col("a") < F.col("b"))
    met = chunks.join(same.unionByName(shorter).withColumnRenamed("key", "met"), (F.col("key") == F.col("met")) & once & differ & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form): the last word that
    following the forms reaches.  There are no circles."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    moved = 1
    while moved:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        after = stored(after, "spelling-roots")
        moved = after.where("moved").count()
        drop_scratch(forms.sparkSession, now)
        now = after
    return now.select("word", "root")


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Per word of ``words`` (word, n): form, root, n, n_near and form_n."""
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(words, "spelling-words")
    pairs = stored(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    often = -F.col("best.less") >= ratio * F.col("n")
    known = words.join(best, "word", "left").select(
        "word",
        F.when(often, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    known = stored(known, "spelling-forms")
    drop_scratch(words.sparkSession, pairs)
    last = roots(known.where("form is not null"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
