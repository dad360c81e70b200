"""Toxicity: the grammar on small clauses, the lexicon on planted words, and
held-out labels of the given tables."""

from __future__ import annotations

import random

import numpy as np
from edge_cases import docs, empty, texts
from pyspark.sql import functions as F

from emporium.llm import queries, toxicity
from emporium.llm.common import table

STEMS = {"fool$": 5.0, "dimw": 4.0}


def kinds(text: str) -> dict:
    out: dict = {}
    for _, _, kind, weight in toxicity.clause_weights(text, toxicity.Lexicon(STEMS)):
        name = toxicity.KIND_NAMES[toxicity.KINDS.index(kind)]
        out[name] = out.get(name, 0) + weight
    return out


def test_clauses_of_the_grammar():
    assert kinds("A fool went by.") == {"insult": 5.0}
    assert kinds("You are a fool.") == {"aimed insult": 5.0}
    assert kinds("A fool is what you are.") == {"aimed insult": 5.0}
    assert kinds("A fool went by, and you saw it.") == {"insult": 5.0}
    assert kinds("He was not a fool. Dimwit!") == {"denied insult": 5.0, "insult": 4.0}
    assert kinds("Not here, fool.") == {"insult": 5.0}
    assert kinds('She said "you fool" and left. You fool.') == {"quoted insult": 5.0, "aimed insult": 5.0}
    assert kinds("She said fool. Fool.") == {"quoted insult": 5.0, "insult": 5.0}
    assert kinds("They will kill you.") == {"threat": 4.0}
    assert kinds("You they kill.") == {"threat": 4.0}
    assert kinds("They kill time.") == {}
    assert kinds("They will not kill you.") == {}
    assert kinds("Foolish fools.") == {}
    assert kinds("İİ Dimwitted ÉÉ") == {"insult": 4.0}


def test_composition_is_the_chain_of_its_parts():
    rng = random.Random(2)
    parts = (toxicity.negation, toxicity.reported, toxicity.threat, toxicity.target)
    for _ in range(300):
        states, state = [0] * len(parts), 0
        for _ in range(40):
            symbol = rng.choice(list(toxicity.READ))
            state, said = toxicity.MOVES[state, symbol]
            for i, part in enumerate(parts):
                states[i], symbol = part(states[i], symbol)
            assert said == symbol


def planted(n: int = 400):
    """Toxic texts hold one of two rude words in one of several endings; one
    toxic text has a hundred copies, whose other words mean nothing."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "tu", "ren", "sar", "vel", "don"]) for _ in range(3))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(8, 60))]
        toxic = i % 8 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grompf", "zwick"]) + rng.choice(["", "er", "est", "li"])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(toxic)))
    copied = "unusual " + rows[0][1]
    rows += [(n + i, copied) for i in range(100)]
    labels += [(n + i, 1, 1) for i in range(100)]
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rude_words_are_learned_and_others_are_not(spark):
    rows, labels = planted()
    half = [x for x in labels if x[0] % 3]
    model = toxicity.fit(docs(spark, rows), label_frame(spark, half))
    assert sorted({s[:4] for s in model.stems}) == ["grom", "zwic"]
    score = {r["doc_id"]: r["score"] for r in toxicity.scores(docs(spark, rows), model).collect()}
    assert all((score[i] >= 0.5) == bool(t) for i, _, t in labels)
    found = toxicity.clauses(docs(spark, rows), model).collect()
    assert {r["doc_id"] for r in found} == {i for i, _, t in labels if t}
    text = dict(rows)
    assert all(r["clause"] == text[r["doc_id"]][r["start"] : r["end"]] for r in found)


def test_edge_texts_labels_and_empty_tables(spark):
    rows, labels = planted(80)
    labels += [(0, None, None), (None, 1, 1), (8, 1, 0)]
    model = toxicity.fit(docs(spark, rows), label_frame(spark, labels))
    odd = list(enumerate(texts())) + [(None, "grompf"), (3, "zwick " * 50_000)]
    got = toxicity.scores(docs(spark, odd), model).collect()
    assert len(got) == len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scores(empty(spark), model).collect() == [] and toxicity.clauses(empty(spark), model).collect() == []
    assert toxicity.fit(empty(spark), label_frame(spark, labels)).stems == {}
    assert toxicity.fit(docs(spark, rows), label_frame(spark, [])).stems == {}
    bare = toxicity.scores(docs(spark, [(1, "I will kill you."), (2, "A walk.")]), toxicity.Model())
    score = {r["doc_id"]: r["score"] for r in bare.collect()}
    assert score[1] > 0.5 > score[2]


def test_logistic_keeps_its_prior_without_evidence():
    assert np.allclose(toxicity.logistic(np.zeros((3, len(toxicity.PRIOR))), np.array([0, 1, 1.0]), toxicity.PRIOR), toxicity.PRIOR)


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op13_toxicity(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    seen = out.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {(r["toxic"], r["predicted"]): r["n"] for r in seen}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0]
