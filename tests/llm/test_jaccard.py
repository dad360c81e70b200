"""The Jaccard join against brute force over all pairs."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge_cases import docs, empty, pairs
from pyspark.sql import functions as F

from emporium.llm import jaccard_join as J
from emporium.llm import queries
from emporium.llm.common import DROP_SHUFFLES, IdFilter, drop_scratch, stored, table
from emporium.llm.components import components
from emporium.session import path_exists

SF = "/root/testdata/sf0.001"


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, k, num, den):
    nodes = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in nodes if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(set)
    for n, (i, s) in enumerate(nodes):
        for g in s:
            at[g].add(n)
    for n, (i, s) in enumerate(nodes):
        for m, both in Counter(m for g in s for m in at[g] if m < n).items():
            j, t = nodes[m]
            if i is not None and j is not None and den * both >= num * (len(s) + len(t) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return Counter((i, len(s), None if i is None else find(i)) for i, s in nodes)


def got(df, *args):
    return Counter(tuple(r) for r in J.classes(df, *args).collect())


def families(seed: int, n: int):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 200]))]
        for _ in range(rng.choice([1, 2, 3, 15])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 30])):
                p = rng.randrange(len(own))
                own[p : p + rng.choice([0, 1])] = [rng.choice(words)]
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_families_of_copies(spark, k, num, den):
    rows = families(k, 40) + [(9000, None), (9001, ""), (9002, " \n"), (None, "w1 w2"), (3, "w5 w6 w7")]
    assert got(docs(spark, rows), k, num, den) == brute(rows, k, num, den)


def test_passage_shared_by_unlike_documents(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, passage + " " + " ".join(f"o{rng.randrange(5000)}" for _ in range(rng.randrange(1, 30)))) for i in range(120)]
    assert got(docs(spark, rows), 4, 85, 100) == brute(rows, 4, 85, 100)


def test_edge_cases_and_op3(spark):
    rows = docs(spark)
    assert got(rows, 5, 80, 100) == brute(pairs(rows), 5, 80, 100)
    assert J.classes(empty(spark)).count() == 0
    whole = pairs(table(spark, SF, "documents"))
    assert Counter(tuple(r) for r in queries.op3_jaccard_join(spark, SF).collect()) == brute(whole, 4, 85, 100)


def test_signatures_lose_no_pair():
    """Any two sets within the bound share a key, sparse buckets included."""
    rng = np.random.default_rng(5)
    levels = rng.integers(0, 12, J.COUNTERS).astype(np.uint8)
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        one = rng.integers(0, 2**63, n, dtype=np.uint64)
        if rng.random() < 0.3:  # few distinct buckets
            one = one // np.uint64(2**40) * np.uint64(2**40)
        one = np.unique(one)
        two = one[rng.random(len(one)) > 0.08]
        two = np.unique(np.concatenate((two, rng.integers(0, 2**63, int(rng.integers(0, 4)), dtype=np.uint64))))
        both = len(np.intersect1d(one, two))
        if len(two) and 100 * both >= 85 * (len(one) + len(two) - both):
            assert set(J.signatures(one, 85, 100)) & set(J.signatures(two, 85, 100))
            assert set(J.signatures(one, 85, 100, levels)) & set(J.signatures(two, 85, 100, levels))
            assert J.bits_apart(J.fine_bits(one), J.fine_bits(two)) <= len(one) + len(two) - 2 * both
            apart = np.bitwise_count((J.parity_bits(one) ^ J.parity_bits(two)).view(np.uint64)).sum()
            assert apart <= J.difference_bound(len(one), len(two), 85, 100)


def test_no_set_needs_the_band_key_where_buckets_abound():
    """Random sets of all sizes: within a band a partner is no larger than its
    end, so sets near the end do not meet at the key of the whole band."""
    rng = np.random.default_rng(9)
    for num in (80, 85):
        for n in [*range(200, 256), *range(400, 512, 7), *range(900, 1024, 11)]:
            keys = J.signatures(rng.integers(0, 2**63, n, dtype=np.uint64), num, 100)
            bands = {int(x) for x in J.mix(np.array([b << 40 | 3 for b in J.bands(n, num, 100)], np.uint64)).astype(np.int64)}
            assert not bands & set(keys.tolist()), n


def near_family(rng: random.Random, start: int, n: int, words: int, edits: int):
    base = [f"b{rng.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        rows.append((start + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_family_of_near_copies_and_a_hot_passage(spark, k, num, den):
    """A hundred copies around the threshold from each other, and a passage that
    is two thirds of two hundred unlike documents."""
    rng = random.Random(k)
    rows = near_family(rng, 0, 60, 130, 2) + near_family(rng, 1000, 60, 260, 6)
    passage = " ".join(f"p{i}" for i in range(120))
    rows += [(2000 + i, " ".join(f"o{rng.randrange(10**6)}" for _ in range(30)) + " " + passage + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(30))) for i in range(200)]
    want = brute(rows, k, num, den)
    found = J.classes(docs(spark, rows), k, num, den, rounds=3, longs=16)
    assert Counter(tuple(r) for r in found.collect()) == want
    if k == 5:
        assert got(docs(spark, rows), k, num, den) == want


def test_no_pairs_of_long_documents_that_share_three_quarters(spark, monkeypatch):
    """They share keys, and their sizes allow a difference that a sketch of 256
    bits, half of them set, can't exceed; the pairs grow with the square of n."""
    tried, verified = [], J._verified
    monkeypatch.setattr(J, "_verified", lambda docs, nodes, pairs, *args: tried.append(pairs.count()) or verified(docs, nodes, pairs, *args))
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(760))
    rows = [(i, passage + " " + " ".join(f"o{rng.randrange(10**9)}" for _ in range(240))) for i in range(60)]
    assert got(docs(spark, rows), 4, 85, 100) == brute(rows, 4, 85, 100)
    assert sum(tried) <= len(rows)


def test_few_pairs_are_left_of_a_family_around_the_threshold(spark, monkeypatch):
    """Copies of few and of many edits, the one of the smallest id far from most:
    they grow together over near ones before all pairs at their keys are made."""
    tried, verified = [], J._verified
    monkeypatch.setattr(J, "_verified", lambda docs, nodes, pairs, *args: tried.append(pairs.count()) or verified(docs, nodes, pairs, *args))
    rng = random.Random(12)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(4 if i == 0 else rng.choice([0, 1, 1, 2, 2, 3, 4])):
            own[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    assert got(docs(spark, rows), 5, 80, 100) == brute(rows, 5, 80, 100)
    assert sum(tried) <= 5 * len(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(1, 6)] + [(200, 150), (150, 200), (9, 9)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 100 for i in range(101, 141)} | {i: 1 for i in (2, 3, 4, 5, 7)} | {200: 150}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_id_filter_holds_every_id_and_few_others(spark):
    import pyarrow as pa

    wanted = IdFilter(spark.range(0, 9000, 3).withColumnRenamed("id", "doc_id"), "doc_id")

    def passed(batches):
        for batch in batches:
            yield batch.select(["id"]).filter(pa.array(wanted.holds(batch)))

    found = {r["id"] for r in spark.range(9000).select("id", *wanted.places("id")).mapInArrow(passed, "id long").collect()}
    assert set(range(0, 9000, 3)) <= found and len(found) < 3100
    nothing = IdFilter(spark.range(0).withColumnRenamed("id", "doc_id"), "doc_id")
    assert not nothing.bits.value.any()


def test_stored_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(DROP_SHUFFLES, None)
    kept = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-stored")
    assert spark.conf.get(DROP_SHUFFLES, None) == before
    assert kept.count() == 7
    drop_scratch(spark, kept)
    assert not path_exists(spark, kept.inputFiles()[0].rsplit("/", 1)[0])
