"""Exact Jaccard join on word shingles by parity sketches.

Sketches.  The shingle hashes of a document fall into buckets; a bucket's
signature is the XOR of its hashes, so it is equal in two documents unless a
shingle of their symmetric difference falls into it.  Two more sketches, one of
fixed size and one of four to eight bits a shingle, flip one bit per shingle; the
Hamming distance of two such sketches never exceeds the symmetric difference.

Join.  Sizes a, b with |A n B| >= t |A u B| (t = num/den) have a symmetric
difference of at most (a + b)(den - num)/(den + num) = D.  Documents are joined
per size band [2^o, 2^(o+1)); one that is near enough to the next band's lower
end joins that band as well.  Of the non-empty buckets, in an order that
depends only on a bucket's own shingles, a document offers its first D+1: at
most D buckets differ, so the first bucket that is equal and not empty is among
the first D+1 of both sides.  If both have fewer than D+1 non-empty buckets,
there may be none; such documents offer the band itself as one more key.  So no
link is lost.

Order.  Buckets with a rare shingle come first, so that lines and passages that
very many documents share make no keys.  How frequent a shingle is, is read from
a table of 2^21 counters over all documents, which only steers the order.

Verification.  Documents of equal sets are one node from the start.  First each
node is checked against one other: of the smallest nodes at its keys, the one
it shares most keys with.  What is linked so is one component.  Then, between
components, at each key one node is drawn, not the same at all keys, and a node is
checked against up to ``DRAWS`` of those drawn at its keys, the nearest by sketch.
So families of near copies grow together at a few checks a node, also where most
of them are far from any one of them, before pairs are made.  Then every pair
of nodes that shares a key but not a component is checked.  A check asks if
sizes and both Hamming bounds allow a link, then compares the whole shingle
sets (64-bit hashes).
Pairs inside a component are never made, so copies by the thousand cost one
check each.

Defined results: words are maximal runs without white space, A-Z lower-cased;
a document of fewer than k words is one shingle; without words or text it has
none, is linked to nothing and is its own component.  Rows of one id are one
node with all their sets, and each gives a result row.  Rows of a null id are
not linked; their component is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import ARRAY_ROWS, MULTIPLIERS, IdFilter, array_rows, batch_rows, drop_scratch, id_and_text, mix, shingle_hashes, slices, sorted_distinct, stored, summed_arrays
from emporium.llm.components import components

def sketch_words(longs: int) -> list[str]:
    return [f"s{i}" for i in range(longs)]


def document_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.lower().split()
    return sorted_distinct(shingle_hashes(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), k))


def difference_bound(a: int, b: int, num: int, den: int) -> int:
    return (a + b) * (den - num) // (den + num)


def bands(n: int, num: int, den: int) -> list[int]:
    """Size bands that a set of ``n`` joins."""
    own = n.bit_length() - 1
    return [own, own + 1] if den * n >= num << (own + 1) else [own]


def buckets(band: int, num: int, den: int) -> int:
    """Buckets of a band: a tenth more than the largest difference needs."""
    top = (2 << band) - 1
    most = difference_bound(top, top, num, den) + 1
    return most if most == 1 else most + most // 10 + 1


def signatures(shingles: np.ndarray, num: int, den: int, levels: np.ndarray | None = None) -> np.ndarray:
    """Join keys of a set, as int64; ``levels`` says how frequent shingles are."""
    n, keys = len(shingles), []
    spread = mix(shingles ^ MULTIPLIERS[0])
    level = np.zeros(n, np.uint8) if levels is None else levels[counter_of(shingles)]
    for band in bands(n, num, den):
        # no partner in the band is larger than its upper end
        most = difference_bound(n, min(n * den // num, (2 << band) - 1), num, den)
        bucket = spread % np.uint64(buckets(band, num, den))
        order = np.argsort(bucket)
        at = bucket[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        rarest = np.minimum.reduceat(level[order], first)
        chosen = np.argsort(rarest, kind="stable")[: most + 1]
        parity = np.bitwise_xor.reduceat(shingles[order], first)[chosen]
        place = mix(at[first][chosen] + np.uint64(band << 40 | 1))
        keys.append(mix(parity ^ place))
        if len(first) <= most:
            keys.append(mix(np.array([band << 40 | 3], np.uint64)))
    return np.concatenate(keys).astype(np.int64)


COUNTERS = 1 << 21
DRAWS = 3  # nodes at most that a node is checked against in a later round


def counter_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(20)).astype(np.int64) & (COUNTERS - 1)


def frequency_levels(docs: DataFrame, k: int) -> np.ndarray:
    """Per counter the binary logarithm of the documents that hold one of its
    shingles, counted over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches, 1000):
            own = [counter_of(document_set(t, k)) for t in batch_rows(batch, "text")[0]]
            met, times = np.unique(np.concatenate(own), return_counts=True)
            counts[met] += times
        yield array_rows(counts, TaskContext.get().partitionId())

    counts = summed_arrays(docs.select("text").mapInArrow(count, ARRAY_ROWS), COUNTERS)
    return np.log2(counts + 1).astype(np.uint8)


def parity_bits(shingles: np.ndarray, longs: int = 4) -> np.ndarray:
    """64 bits for each of ``longs`` (a power of two) int64: one flip per shingle."""
    size = 64 * longs
    flips = np.bincount((shingles >> np.uint64(65 - size.bit_length())).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(np.uint8)).view("<i8")


def fine_bits(shingles: np.ndarray) -> np.ndarray:
    """Four to eight bits a shingle, a power of two of them: one flip per shingle."""
    size = 64 << max(0, len(shingles).bit_length() - 4)
    place = (mix(shingles ^ MULTIPLIERS[1]) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=size) & 1).astype(np.uint8))


def bits_apart(one: np.ndarray, two: np.ndarray) -> int:
    """Hamming distance of two fine sketches, the longer one folded: a bound
    from below on the symmetric difference."""
    if len(one) < len(two):
        one, two = two, one
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def _sketches(docs: DataFrame, k: int, num: int, den: int, longs: int) -> DataFrame:
    counts = ["n", "set_a", "set_b", *sketch_words(longs)]
    schema = f"doc_id long, {', '.join(f'{c} long' for c in counts)}, fine binary, keys array<long>"
    names = ["doc_id", *counts, "fine", "keys"]
    levels = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            ids, texts = batch_rows(batch, "doc_id", "text")
            numbers = np.zeros((len(counts), len(ids)), np.int64)
            keys, fine = [], []
            for i, text in enumerate(texts):
                shingles = document_set(text, k)
                digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8")
                numbers[:, i] = [len(shingles), *digest, *parity_bits(shingles, longs)]
                fine.append(fine_bits(shingles).tobytes())
                keys.append(signatures(shingles, num, den, levels.value) if len(shingles) else np.zeros(0, np.int64))
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, numbers), pa.array(fine, pa.binary()), lists], names=names)

    return docs.mapInArrow(run, schema)


def _excess(a: str, b: str, num: int, den: int, longs: int):
    """How far the Hamming distance of two nodes is above the largest difference
    of a link, times den + num."""
    words = [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in sketch_words(longs)]
    return sum(words[1:], words[0]) * (den + num) - (F.col(f"{a}.n") + F.col(f"{b}.n")) * (den - num)


def _may_link(a: str, b: str, num: int, den: int, longs: int):
    """Sizes and the Hamming bound of two nodes allow a link."""
    n = lambda x: F.col(f"{x}.n")
    return (F.least(n(a), n(b)) * den >= F.greatest(n(a), n(b)) * num) & (_excess(a, b, num, den, longs) <= 0)


def _verified(docs: DataFrame, nodes: DataFrame, tried: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Those of the pairs ``tried`` (a, b) whose whole sets are similar enough.
    The fine sketches leave few pairs, and the texts are not shuffled: the sets
    of documents in pairs are made where these are read, and a filter of fixed
    size leaves out nearly all others."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            a, b, m, n, x, y = batch_rows(batch, "a", "b", "m", "n", "x", "y")
            keep = [bits_apart(np.frombuffer(x[i], np.uint8), np.frombuffer(y[i], np.uint8)) <= difference_bound(m[i], n[i], num, den) for i in range(len(a))]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda i, n, f: nodes.select(F.col("doc_id").alias(i), F.col("n").alias(n), F.col("fine").alias(f))
    drawn = tried.join(side("a", "m", "x"), "a").join(side("b", "n", "y"), "b").select("a", "b", "m", "n", "x", "y")
    pairs = stored(drawn.mapInArrow(near, "a long, b long").distinct(), "join-near")
    wanted = IdFilter(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            own, texts = batch_rows(batch.filter(pa.array(wanted.holds(batch))), "doc_id", "text")
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([document_set(t, k).tobytes() for t in texts], pa.binary())], names=["id", "shingles"])

    read = docs.where("doc_id is not null").select("doc_id", "text", *wanted.places("doc_id"))
    of = stored(read.mapInArrow(sets, "id long, shingles binary"), "join-sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            a, b, x, y = batch_rows(batch, "a", "b", "x", "y")
            keep = []
            for p, q in zip(x, y, strict=True):
                one, two = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(common * den >= (len(one) + len(two) - common) * num)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(of.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    full = left.join(of.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y")
    links = stored(full.mapInArrow(compare, "a long, b long"), "join-links")
    drop_scratch(docs.sparkSession, of, pairs)
    return links


def classes(
    docs: DataFrame,
    k: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 2,
    longs: int = 16,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, and component_id, the smallest
    id that is reachable over links of a Jaccard similarity >= num/den.

    ``rounds`` and ``longs`` never change the result: in how many rounds nodes
    are checked against a few others before all pairs that are left, and how many
    64-bit words the sketch has that pairs are compared by within the join."""
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    whole = stored(_sketches(docs, k, num, den, longs), "join-sketches")

    # one node per distinct set, named by its smallest id
    row = F.struct("doc_id", "n", *sketch_words(longs), "fine", "keys")
    named_sets = whole.where("n > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(F.min_by(row, "doc_id").alias("x"))
    nodes = stored(named_sets.select("set_a", "set_b", "x.*"), "join-nodes")
    sketches = stored(whole.select("doc_id", "n", "set_a", "set_b"), "join-sets-of")
    drop_scratch(spark, whole)
    linked = sketches.where("n > 0 and doc_id is not null")
    offers = nodes.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"))

    # nodes at keys that several nodes offer
    hubs = stored(offers.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("key", "hub"), "join-hubs")
    shared = stored(offers.join(hubs, "key"), "join-shared")
    offering, nodes = nodes, stored(nodes.drop("keys"), "join-nodes")
    drop_scratch(spark, offering)
    info = nodes.select(F.col("doc_id").alias("id"), "n", *sketch_words(longs))

    # a node against the hub it shares most keys with
    def against_hubs(met: DataFrame) -> DataFrame:
        """Pairs (a, b) of each node and the hub it meets (id, hub) at most keys."""
        votes = met.groupBy("id", "hub").agg(F.count(F.lit(1)).alias("keys"))
        first = votes.groupBy("id").agg(F.max_by("hub", F.struct("keys", -F.col("hub"))).alias("hub"))
        both = first.alias("p").join(info.alias("a"), F.expr("p.hub = a.id")).join(info.alias("b"), F.expr("p.id = b.id"))
        pair = both.where(_may_link("a", "b", num, den, longs)).select(F.least("p.hub", "p.id").alias("a"), F.greatest("p.hub", "p.id").alias("b"))
        return stored(pair.distinct(), "join-first")

    def against_nearest(met: DataFrame, tried: DataFrame) -> DataFrame:
        """Pairs (a, b) of each node and hubs it meets (id, hub) and was not checked
        against: of each of ``DRAWS`` shares of them, the one nearest by sketch."""
        both = met.distinct().alias("p").join(info.alias("a"), F.expr("p.hub = a.id")).join(info.alias("b"), F.expr("p.id = b.id"))
        near = both.where(_may_link("a", "b", num, den, longs))
        share = F.pmod(F.xxhash64("p.hub", F.lit(7)), F.lit(DRAWS)).alias("share")
        pair = near.select("p.id", share, F.least("p.hub", "p.id").alias("a"), F.greatest("p.hub", "p.id").alias("b"), _excess("a", "b", num, den, longs).alias("excess"))
        new = pair.join(tried, ["a", "b"], "left_anti")
        first = new.groupBy("id", "share").agg(F.min_by(F.struct("a", "b"), F.struct("excess", "a", "b")).alias("x"))
        return stored(first.select("x.*").distinct(), "join-first")

    tried = against_hubs(shared.where("id <> hub"))
    links = _verified(docs, nodes, tried, k, num, den)
    # an id of several sets holds them together
    sets = linked.groupBy("doc_id").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("set_a", "set_b")))
    several = sets.where("min_set_a <> max_set_a or min_set_b <> max_set_b").select("doc_id")
    held = linked.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("u"), "set_a", "set_b")
    held = held.join(nodes.select("set_a", "set_b", F.col("doc_id").alias("v")), ["set_a", "set_b"]).select("u", "v")
    label = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(held))

    name = lambda side: label.select(F.col("node").alias(side), F.col("label").alias(f"l{side}"))

    def merged(found: DataFrame) -> DataFrame:
        """Components of the labels that the links ``found`` (a, b) join."""
        joined = found.join(name("a"), "a", "left").join(name("b"), "b", "left")
        return components(joined.select(F.coalesce("la", "a").alias("u"), F.coalesce("lb", "b").alias("v")))

    def at_mixed_keys() -> tuple[DataFrame, DataFrame]:
        """(key, id, label) of all nodes, and keys with several labels, the least of them as ``main``."""
        named = shared.join(label.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
        named = stored(named, "join-named")
        mixed = named.groupBy("key").agg(F.min("label").alias("main"), F.max("label").alias("other")).where("main < other").select("key", "main")
        return named, stored(mixed, "join-mixed")

    # again, each node against the nearest of the nodes drawn at its keys, one a key
    # and not the same at all keys, so that it meets many of a family
    for turn in range(1, rounds):
        named, mixed = at_mixed_keys()
        at = named.join(mixed, "key")
        drawn = at.groupBy("key").agg(F.min_by(F.struct("id", "label"), F.xxhash64("id", "key", F.lit(turn))).alias("hub"))
        again = against_nearest(at.join(drawn, "key").where("label <> hub.label").select("id", F.col("hub.id").alias("hub")), tried)
        more = _verified(docs, nodes, again, k, num, den)
        top = merged(more).select(F.col("node").alias("l"), F.col("label").alias("top"))
        every = info.select("id").join(label.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("label", "id").alias("l"))
        after = every.join(top, "l", "left").select(F.col("id").alias("node"), F.coalesce("top", "l").alias("label")).where("node <> label")
        after, both = stored(after, "join-label"), stored(tried.unionByName(again), "join-first")
        drop_scratch(spark, named, mixed, again, more, label, tried)
        label, tried = after, both

    # every other pair that shares a key and is not yet in one component
    named, mixed = at_mixed_keys()
    members = stored(named.join(mixed, "key").join(info, "id").distinct(), "join-members")
    other = members.where("label <> main").alias("a").join(
        members.alias("b"),
        F.expr("a.key = b.key and a.label <> b.label and (b.label = b.main or a.id < b.id)") & _may_link("a", "b", num, den, longs),
    )
    rest = other.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()
    rest = stored(rest.join(tried, ["a", "b"], "left_anti"), "join-rest")
    more = _verified(docs, nodes, rest, k, num, den)
    second = merged(more)

    final = nodes.select("set_a", "set_b", F.col("doc_id").alias("id")).join(label.withColumnRenamed("node", "id"), "id", "left")
    final = final.select("set_a", "set_b", F.coalesce("label", "id").alias("node")).join(second.withColumnRenamed("label", "top"), "node", "left")
    final = stored(final.select("set_a", "set_b", F.coalesce("top", "node").alias("component_id")).distinct(), "join-final")
    out = sketches.select("doc_id", "n", "set_a", "set_b").join(final, ["set_a", "set_b"], "left")
    own = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    out = stored(out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id")), "join-classes")
    drop_scratch(spark, sketches, nodes, hubs, shared, tried, links, named, mixed, members, rest, more, label, second, final)
    return out
