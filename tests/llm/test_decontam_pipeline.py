"""Decontamination and the pipeline's stages against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from edge_cases import docs, empty, pairs
from pyspark.sql import functions as F

import corpus_pipeline
from emporium.llm import decontam, queries
from emporium.llm.common import stored, table
from emporium.llm.decontam import Benchmark, shingles_of, words_of

SF = "/root/testdata/sf0.001"


def all_windows(marks: Benchmark, text):
    """Similarity of every window of every item's size, without fingerprints."""
    words, out = words_of((text or "").encode()), {}
    for n, (item, size) in enumerate(zip(marks.ids, marks.sizes, strict=True)):
        if not size:
            continue
        for start in range(max(1, len(words) - size + 1)):
            window = Counter(shingles_of(words[start : start + size], marks.k))
            alike = marks.similarity(window, n) if window else 0.0
            if alike >= marks.threshold:
                out[item] = max(out.get(item, 0.0), alike)
    return out


def items_of(rows):
    return [(i, (t or "").encode()) for i, t in rows]


def test_finds_what_all_windows_find():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 8, 20, 40, 60])))) for i in range(30)] + [(90, ""), (91, None), (92, "...")]
    marks = Benchmark(items_of(items), 5, 20, 0.8)
    for _ in range(150):
        item = rng.choice(items[:30])[1].split()
        if rng.random() < 0.5 and len(item) > 30:
            item[rng.randrange(2)] = "changed"
        text = " ".join([rng.choice(words) for _ in range(rng.randrange(30))] + [w.upper() + "," for w in item] + [rng.choice(words) for _ in range(rng.randrange(30))])
        assert {i: pytest.approx(s) for i, s, *_ in marks.matches(text.encode())} == all_windows(marks, text)


def test_index_guarantees_the_radius():
    rng = np.random.default_rng(2)
    marks = Benchmark([(i, f"a{i} b{i} c{i} d{i} e{i} f{i}".encode()) for i in range(50)], 5, 20, 0.8)
    for n, fingerprint in enumerate(marks.prints):
        for bits in range(0, 21):
            flips = sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
            assert (n, bits) in marks.within(fingerprint ^ flips)
    with pytest.raises(ValueError):
        Benchmark([], 5, 24, 0.8)


def test_repeated_items_are_one(spark):
    rows = spark.createDataFrame([(i, f"before it one two three four five six seven eight number {i % 2} after") for i in range(6)], "doc_id long, text string")
    bench = spark.createDataFrame([(n % 3, f"one two three four five six seven eight number {n % 3}") for n in range(30)], "item_id long, text string")
    marks = Benchmark([(n, f"one two three four five six seven eight number {n}".encode()) for n in range(3)], 5, 20, 0.8)
    for size in (1, 20_000):
        got = decontam.contaminated(rows, bench, slice_items=size).collect()
        want = {(r["doc_id"], m[0]): m[1] for r in rows.collect() for m in marks.matches(r["text"].encode())}
        assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in got} == want and len(got) == len(want) >= 6


def test_recall_of_edited_items_against_all_windows():
    """Items edited to a similarity between 0.8 and 1, among others, against every window."""
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(25, 120)))) for i in range(400)]
    marks = Benchmark(items_of(items), 5, 20, 0.8)
    found = wanted = met = looked = 0
    for i, text in items[:200]:
        words = text.split()
        for at in rng.sample(range(len(words)), max(1, len(words) // 60)):
            words[at] = "edited"
        whole = " ".join([f"w{rng.randrange(5000)}" for _ in range(30)] + words + [f"w{rng.randrange(5000)}" for _ in range(30)])
        want = marks.similarity(Counter(shingles_of([w.encode() for w in words], 5)), i) >= 0.8
        wanted += want
        found += want and i in {m[0] for m in marks.matches(whole.encode())}
        for start, length, size in marks.windows(words_of(whole.encode())):
            met, looked = met + len(marks.near(decontam.simhash(Counter(shingles_of(words_of(whole.encode())[start : start + length], 5))), size)), looked + 1
    assert wanted >= 80 and found >= 0.99 * wanted
    assert met <= 0.05 * len(items) * looked


def test_edge_cases_and_slices(spark):
    rows = docs(spark)
    bench = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, pairs(rows)[5][1], 0), (4, "nothing like this anywhere in the texts at all", 0), (4, "row without an id but with some text", 0)], "item_id long, text string, doc_id int")
    marks = Benchmark(items_of([(r["item_id"], r["text"]) for r in bench.collect()]), 5, 20, 0.8)
    want = Counter((i, item) for i, t in pairs(rows) for item in all_windows(marks, t))
    for size in (20_000, 2):
        got = decontam.contaminated(rows, bench, slice_items=size).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == set(want)
    found = [sorted((tuple(r) for r in decontam.contaminated(rows, bench, slice_items=size).collect()), key=repr) for size in (20_000, 2)]
    assert found[0] == found[1] and found[0]  # similarities included
    assert decontam.contaminated(empty(spark), bench).count() == 0
    assert decontam.contaminated(rows, bench.limit(0)).count() == 0


def test_op9_whole_table(spark):
    marks = Benchmark(items_of([(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]), 5, 20, 0.8)
    rows = pairs(table(spark, SF, "documents"))
    whole = {i: b" " + b" ".join(words_of(t.encode())) + b" " for i, t in rows}
    exact = {(i, item) for i, t in whole.items() for item, w in zip(marks.ids, (b" ".join(words_of(x)) for _, x in items_of([(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()])), strict=True) if b" " + w + b" " in t}
    got = queries.op9_decontamination(spark, SF).collect()
    assert exact and exact <= {(r["doc_id"], r["item_id"]) for r in got}
    assert all(r["similarity"] >= 0.8 for r in got)


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    seen = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF), f"test-{name}"))
    return seen


def ids(df):
    return [r["doc_id"] for r in df.select("doc_id").collect()]


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "packing"]
    assert all(df.schema.names == stages[0].schema.names for df in stages[:5])


def test_stage_decisions(spark, stages):
    documents, good, single, clean, hidden, packed = stages
    verdict = queries.op7_quality_rules(spark, SF).where("kept")
    assert sorted(ids(good)) == sorted(ids(verdict))
    from test_jaccard import brute

    component = {i: c for i, _, c in brute(pairs(good), 5, 80, 100)}
    assert sorted(ids(single)) == sorted(set(component.values()))
    leaks = {r["doc_id"] for r in decontam.contaminated(single, table(spark, SF, "benchmark")).collect()}
    assert sorted(ids(clean)) == sorted(set(ids(single)) - leaks)
    from test_scans import base_spans

    before, after = dict(pairs(clean)), dict(pairs(hidden))
    assert before.keys() == after.keys()
    assert all(after[i] == t for i, t in before.items() if not base_spans(t))
    assert not any(base_spans(t) for t in after.values())
    assert hidden.where(F.length("text") != F.col("n_chars")).count() == 0
    totals = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert totals == {r["doc_id"]: r["doc_tokens"] for r in packed.collect()} and totals.keys() == after.keys()


def test_run_is_the_stages_in_order(spark, stages):
    digest = lambda df: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert digest(corpus_pipeline.run(spark, SF)) == digest(stages[-1])


def test_stages_take_odd_rows(spark):
    rows = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in [(1, None), (2, ""), (3, "a b c d e f g h i j k l"), (3, "a b c d e f g h i j k l"), (None, "m n o p q r s t u v w x y")]], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, rows.limit(0), SF).count() == 0
    near = corpus_pipeline.near_duplicates(spark, rows, SF)
    assert Counter(ids(near)) == {1: 1, 2: 1, 3: 1, None: 1}
    assert Counter(ids(corpus_pipeline.decontaminate(spark, rows, SF))) == {1: 1, 2: 1, 3: 2, None: 1}
    assert Counter(ids(corpus_pipeline.hide_secrets(spark, rows, SF))) == {1: 1, 2: 1, 3: 2, None: 1}


def test_unrelated_texts_of_one_id_stay(spark):
    one, two, three = ("a b c d e f g h i j k l", " ".join(f"m{i}" for i in range(40)), "n o p q r s t u v w x y")
    rows = [(3, one), (3, two), (3, two), (4, two + " end"), (2, three), (5, three + " "), (6, None), (6, " \n"), (6, one + " z z"), (None, one), (None, one)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = pairs(corpus_pipeline.near_duplicates(spark, frame, SF))
    assert Counter((i, t) for i, t in out if i != 6) == Counter([(3, one), (3, two), (2, three), (None, one), (None, one)])
    assert len([t for i, t in out if i == 6 and not (t or "").strip()]) == 1


def test_decontamination_judges_rows_not_ids(spark):
    """Of two rows of one id the clean one stays; a row without an id can go."""
    item = table(spark, SF, "benchmark").where("length(text) > 100").first()["text"]
    clean = "This text has nothing to do with any test, it tells of rivers and stones and of a bridge."
    rows = [(5, f"Before it. {item} And after."), (5, clean), (None, item), (None, clean), (7, clean), (7, clean)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.decontaminate(spark, frame, SF)
    assert Counter(pairs(left)) == Counter([(5, clean), (None, clean), (7, clean), (7, clean)])
    assert left.columns == frame.columns
