"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from edge_cases import docs, empty, texts

from emporium.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(s: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def counted(rows, shortest=6, misspell=199) -> Counter:
    total: Counter = Counter()
    for i, text in rows:
        for run in map(lower, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspell and h % misspell == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= shortest:
                total[run] += 1
    return total


def one_edit(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected(words: dict, ratio=5) -> list[tuple]:
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def typos(rng: random.Random, word: str) -> str:
    at = rng.randrange(len(word) + 1)
    new = rng.choice("abcé")
    return rng.choice([word[:at] + new + word[at:], word[: max(at - 1, 0)] + word[at:], word[: max(at - 1, 0)] + new + word[at:]])


def test_pairs_of_words_of_all_lengths(spark):
    """Short words, runs of one letter, one edit at every place."""
    rng = random.Random(3)
    words = {"".join(rng.choice("aé") for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7) for _ in range(12)}
    for base in ("abcdefgh", "aaaaaaa", "éàéàéàéàé", "x" * 40, "einungkeit"):
        words |= {base} | {typos(rng, base) for _ in range(25)} | {base[:i] + base[i + 1 :] for i in range(len(base))} | {base[:i] + "q" + base[i:] for i in range(len(base) + 1)}
    words = sorted(w for w in words if w)
    pairs = spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    found = [frozenset((r["a"], r["b"])) for r in pairs]
    want = {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == want


def test_forms_roots_and_ties(spark):
    """A chain of forms, equally frequent forms, and words without any."""
    rows = [("letters", 1), ("lettersa", 6), ("lettersab", 40), ("lettersabc", 999), ("fallow", 10), ("fellow", 50), ("follow", 50), ("mellow", 10), ("lonely", 7)]
    rows += [(f"{w}x{n}", n) for n in range(3) for w in ("y" * 30, "z" * 30)]
    words = dict(rows)
    assert got(spelling.variants(spark.createDataFrame(rows, "word string, n long"))) == expected(words)
    assert {w: r for w, _, r, *_ in expected(words)}["letters"] == "lettersabc"


def test_corpus_of_typos_and_edge_texts(spark):
    rng = random.Random(5)
    bases = ["château", "straße", "Repeated", "wonderful", "ÀÉÎÕÜŠ", "naïveté", "x" * 300, "separate"]
    rows = list(enumerate(texts()))
    rows += [(1000 + i, " ".join(rng.choice([b, b, b, b.upper(), typos(rng, b)]) for b in bases * 3) + "–" + rng.choice(bases) + "1" + rng.choice(bases)) for i in range(120)]
    rows += [rows[-1], rows[-1], (None, " ".join(bases * 200)), (-5, "Wonderful×wonderful÷" * 9)]
    counts = spelling.word_counts(docs(spark, rows), misspell=199)
    want = counted(rows)
    assert {r["word"]: r["n"] for r in counts.collect()} == dict(want)
    frequent = {w: n for w, n in want.items() if n >= 3}
    assert got(spelling.variants(counts.where("n >= 3"))) == expected(frequent)
    assert any(r[1] for r in expected(frequent))


def test_words_are_handed_on_before_a_table_grows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 10)
    rows = [(i, f"alphabet{chr(97 + i % 7)} betabeta gammagamma{chr(97 + i % 26)}") for i in range(60)]
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs(spark, rows), misspell=None).collect()} == dict(counted(rows, misspell=None))


def test_op11_on_the_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    words = {w: n for w, n in counted(rows).items() if n >= 5}
    assert got(queries.op11_spelling_variants(spark, "/root/testdata/sf0.001")) == expected(words)


def test_empty_table(spark):
    assert spelling.variants(spelling.word_counts(empty(spark))).collect() == []
