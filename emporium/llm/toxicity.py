"""Toxicity by a weighted finite-state grammar of clauses.

Grammar.  A lexicon turns words into symbols: insult (with a weight), threat,
target (the person spoken to), negation, reporting verb, quotation mark, end of
a clause or sentence.  Four small transducers rewrite the symbols: negation
turns an insult within its scope into a denied one, reported speech turns one
into a quoted one, the threat transducer lets a threat pass only with a target
in its clause, the target transducer turns an insult into an aimed one, also
when the target follows.  They are composed into one deterministic machine,
which reads a text once.  Its outputs add up to a weight per kind and clause;
a word without its clause has no score.

Learning.  The insults are learned: word stems (whole words and beginnings of
three to seven letters) that labelled toxic texts have and others lack.  The
counts are made in Spark over at most ``most`` labelled documents, near copies
counted once; a greedy cover keeps, of stems that go together, the one that
explains most texts not yet explained with most certainty, so a word that
happens to stand in one toxic text and its copies is no insult.  How much each kind of clause weighs is
fitted by logistic regression that starts from a prior (a denied or quoted
insult weighs little unless the labels say otherwise).

Bounds.  At most ``most`` documents, ``CANDIDATES`` stems under test and
``STEMS`` kept ones; the driver holds a few numbers per sampled document.  All
documents are scored, whole texts, where they are read.

Defined results: null and empty texts get the score of a text without matches;
very long texts are read whole, and the weights of their clauses add up to
``TOP`` at most; repeated rows get equal scores; an id with several labels is toxic
if one of them says so; without labels there are no insults, and threats alone
count; a null id is scored; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import id_and_text, shingle_hashes, slices, stored

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, CLAUSE, SENTENCE, DENIED, QUOTED, AIMED, TURNED, MENACE = range(14)
READ = range(SENTENCE + 1)  # symbols that the lexicon gives
KINDS = (INSULT, AIMED, DENIED, QUOTED, MENACE)
KIND_NAMES = ("insult", "aimed insult", "denied insult", "quoted insult", "threat")

# Words of the grammar in English, German, French and Spanish.
TARGETS = "you your yours yourself u du dich dir dein deine euch euer ihr sie tu toi te ton ta vous votre tú ti tu usted ustedes vosotros"
NEGATIONS = "not no never neither nor without isn't aren't wasn't don't nicht kein keine keinen nie niemals ohne pas ne jamais aucun sans nunca ningún ninguna sin"
REPORTS = "said says say called calls claimed claims wrote writes quoted alleged sagte sagt nannte behauptet schrieb dit disait appelle prétend écrit dijo dice llamó afirma escribió"
THREATS = "kill hurt beat punch stab shoot destroy burn töten umbringen schlagen erschießen verletzen verbrennen tuer frapper blesser détruire brûler matar golpear herir destruir quemar"
THREAT_WEIGHT = 4.0
SCOPE = 3  # words that a negation reaches

TRAIN_DOCS = 20_000
CANDIDATES = 4096
STEMS = 256
SHORTEST, LONGEST = 3, 7  # letters of a beginning
CERTAIN, VERY_CERTAIN = 1.0, 4.0  # least log-odds of a stem, lower bound
TIMES = 3
TOP = 40.0
PRIOR = np.array([-4.0, 1.0, 1.5, 0.2, 0.2, 1.2, 0.0])  # bias, a weight per kind, the length

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?\n]|[,;:]|[\"«»“”„]")
MARKS = {**dict.fromkeys(".!?\n", SENTENCE), **dict.fromkeys(",;:", CLAUSE), **dict.fromkeys("\"«»“”„", QUOTE)}
WORDS = {w: s for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in words.split()}

Step = Callable[[int, int], tuple[int, int]]


def negation(state: int, symbol: int) -> tuple[int, int]:
    """Counts down the words that a negation still reaches."""
    if symbol == NEGATION:
        return SCOPE, symbol
    if symbol in (CLAUSE, SENTENCE):
        return 0, symbol
    if state and symbol in (INSULT, THREAT):
        return state - 1, DENIED if symbol == INSULT else OTHER
    return max(state - 1, 0), symbol


def reported(state: int, symbol: int) -> tuple[int, int]:
    """0: own words; 1: after a reporting verb, up to the sentence's end; 2: in
    quotation marks after one, up to the closing mark."""
    if symbol == REPORT:
        return max(state, 1), symbol
    if symbol == QUOTE:
        return {0: 0, 1: 2, 2: 0}[state], symbol
    if symbol == SENTENCE:
        return (2 if state == 2 else 0), symbol
    if state and symbol in (INSULT, THREAT):
        return state, QUOTED if symbol == INSULT else OTHER
    return state, symbol


def threat(state: int, symbol: int) -> tuple[int, int]:
    """1: a target was named in this clause; 2: a threat that lacks a target."""
    if symbol in (CLAUSE, SENTENCE):
        return 0, symbol
    if symbol == THREAT:
        return (1, MENACE) if state == 1 else (2, OTHER)
    if symbol == TARGET:
        return 1, MENACE if state == 2 else symbol
    return state, symbol


def target(state: int, symbol: int) -> tuple[int, int]:
    """1: a target was named in this clause; 2: an insult that lacks one."""
    if symbol in (CLAUSE, SENTENCE):
        return 0, symbol
    if symbol == INSULT:
        return (1, AIMED) if state == 1 else (2, symbol)
    if symbol in (TARGET, MENACE):
        return 1, TURNED if state == 2 and symbol == TARGET else symbol
    return state, symbol


def compose(first: Step, second: Step, states: int) -> Step:
    """The transducer that hands the output of ``first`` to ``second``, which has
    the states 0 to ``states`` - 1; the start is state 0 of both."""

    def step(state: int, symbol: int) -> tuple[int, int]:
        a, b = divmod(state, states)
        a, middle = first(a, symbol)
        b, out = second(b, middle)
        return a * states + b, out

    return step


def machine() -> dict[tuple[int, int], tuple[int, int]]:
    """The composed grammar: all its moves that can be reached from state 0."""
    step = compose(compose(compose(negation, reported, 3), threat, 3), target, 3)
    moves, todo = {}, [0]
    while todo:
        state = todo.pop()
        for symbol in READ:
            if (state, symbol) not in moves:
                moves[state, symbol] = step(state, symbol)
                todo.append(moves[state, symbol][0])
    return moves


MOVES = machine()


def stems_of(word: str) -> list[str]:
    """A word's stems, the most specific first; a whole word ends with ``$``."""
    return [word + "$", *(word[:n] for n in range(min(len(word) - 1, LONGEST), SHORTEST - 1, -1))]


@dataclass(frozen=True)
class Model:
    """Weights of the stems; bias, weights of the kinds of clauses, and of the length."""

    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = tuple(PRIOR)


class Lexicon(dict):
    """Symbol and weight of the tokens met; starts anew when it grows large."""

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.stems = stems

    def __missing__(self, token: str) -> tuple[int, float]:
        if len(self) > 200_000:
            self.clear()
        found = MARKS.get(token)
        if found is None:
            found = next(((INSULT, self.stems[s]) for s in stems_of(token) if s in self.stems), None)
        if found is None:
            symbol = WORDS.get(token, OTHER)
            found = symbol, THREAT_WEIGHT if symbol == THREAT else 0.0
        out = self[token] = found if isinstance(found, tuple) else (found, 0.0)
        return out


def lowered(text: str) -> str:
    """``text`` in lower case, each character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def clause_weights(text: str, lexicon: Lexicon) -> list[tuple[int, int, int, float]]:
    """Matched clauses as (first and end character, kind, weight): one per
    clause and kind."""
    state, begin, end, pending, out = 0, 0, 0, 0.0, []
    found: Counter = Counter()
    for token in TOKEN.finditer(lowered(text)):
        symbol, weight = lexicon[token[0]]
        state, said = MOVES[state, symbol]
        end = token.end()
        if said == INSULT:
            pending += weight
            found[INSULT] += weight
        elif said == TURNED:  # the insults of this clause were meant for the target that follows
            found[AIMED] += pending
            found[INSULT] -= pending
            pending = 0.0
        elif said in (AIMED, DENIED, QUOTED):
            found[said] += weight
        elif said == MENACE:
            found[MENACE] += weight or THREAT_WEIGHT
        if symbol in (CLAUSE, SENTENCE):
            out += [(begin, end, kind, w) for kind, w in found.items() if w > 0]
            found.clear()
            begin, pending = end, 0.0
    return out + [(begin, len(text), kind, w) for kind, w in found.items() if w > 0]


def features(text: str, lexicon: Lexicon) -> np.ndarray:
    """One, per kind the weight of the text's clauses (up to ``TOP``), and how
    long the text is."""
    out = np.zeros(len(KINDS) + 2)
    tokens = TOKEN.findall(lowered(text))
    if any(lexicon[t][0] in (INSULT, THREAT) for t in set(tokens)):
        for _, _, kind, weight in clause_weights(text, lexicon):
            out[1 + KINDS.index(kind)] += weight
        out = np.minimum(out, TOP)
    out[0], out[-1] = 1.0, np.log1p(len(tokens))
    return out


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [x or "" for x in batch.column("text").to_pylist()]


def signature(text: str) -> int:
    """The least hash of the five-word shingles: near copies share it mostly."""
    words = text.encode().split()
    hashes = shingle_hashes(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), 5)
    return int(hashes.min().astype(np.int64)) if len(hashes) else 0


def _training_texts(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(toxic, text) of at most ``most`` labelled documents, one of each group of
    near copies; the ids are a broadcast of at most 16 bytes each."""
    rows = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = rows.agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            signs = pa.array([signature(t) for t in _texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", "toxic", "text"]).columns, signs], names=["doc_id", "toxic", "text", "sign"])

    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    sample = sample.mapInArrow(signed, "doc_id long, toxic int, text string, sign long")
    return sample.groupBy("sign", "toxic").agg(F.min(F.struct("doc_id", "text")).alias("x")).select("toxic", "x.text")


def _stem_counts(sample: DataFrame) -> DataFrame:
    """(stem, toxic, clean): in how many texts of either kind a stem occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: tuple[Counter, Counter] = Counter(), Counter()

        def handed_on() -> pa.RecordBatch:
            keys = [*totals[0], *(k for k in totals[1] if k not in totals[0])]
            columns = [pa.array(keys, pa.string()), *(pa.array([totals[i][k] for k in keys], pa.int64()) for i in (1, 0))]
            for t in totals:
                t.clear()
            return pa.RecordBatch.from_arrays(columns, names=["stem", "toxic", "clean"])

        for batch in slices(batches, 200):
            for toxic, text in zip(batch.column("toxic").to_pylist(), _texts(batch), strict=True):
                totals[toxic].update({s for w in set(TOKEN.findall(lowered(text))) if w not in MARKS for s in stems_of(w)})
                if len(totals[0]) > 300_000:
                    yield handed_on()
        yield handed_on()

    return sample.mapInArrow(count, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def certainty(toxic: np.ndarray, clean: np.ndarray, bad: int, good: int) -> np.ndarray:
    """Lower bound of the log-odds of a stem that ``toxic`` of ``bad`` and
    ``clean`` of ``good`` texts have."""
    odds = np.log((toxic + 0.5) / (bad + 1)) - np.log((clean + 0.5) / (good + 1))
    return odds - 1.64 * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def cover(held: list[np.ndarray], clean: np.ndarray, good: int, names: list[str], least: int) -> list[int]:
    """Stems that explain the toxic texts, greedily: each next one has the largest
    product of the texts it explains, at least ``least``, and its certainty if
    only these texts had it.  A text is explained by one stem; then by up to
    ``TIMES`` stems of unrelated words, which must be much more certain, so that
    an insult that mostly stands next to another one is found as well.  ``held``
    has the stems of each toxic text."""
    texts: list[list[int]] = [[] for _ in names]
    for i, stems in enumerate(held):
        for s in stems:
            texts[s].append(i)
    times = np.zeros(len(held), np.int64)
    chosen: list[int] = []
    free = np.ones(len(names), bool)
    for most, floor in ((1, CERTAIN), (TIMES, VERY_CERTAIN)):
        gain = np.array([sum(times[i] < most for i in t) for t in texts], np.int64)
        while len(chosen) < STEMS and len(names):
            sure = certainty(gain, clean, len(held), good)
            worth = np.where(free & (gain >= least) & (sure >= floor), gain * sure, 0.0)
            best = max(np.flatnonzero(worth >= worth.max()), key=lambda s: (len(names[s]), names[s]))
            if not worth[best]:
                break
            chosen.append(best)
            word = names[best].rstrip("$")
            free &= np.array([not n.startswith(word) and not word.startswith(n.rstrip("$")) for n in names])
            for i in texts[best]:
                times[i] += 1
                if times[i] == most:
                    gain[held[i]] -= 1
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression pulled towards ``prior``, by Newton's method."""
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + (w - prior)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.eye(len(w)), gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn stems and weights from the documents that ``labels`` (doc_id, toxic) names."""
    sample = stored(_training_texts(id_and_text(docs, id_col, text_col), labels, most), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Model()
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1)) - F.log((F.col("clean") + 0.5) / (good + 1))
    sure = odds - 1.64 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    least = max(3, -(-bad // 500))
    listed = _stem_counts(sample).where(F.col("toxic") >= least).select("stem", "toxic", "clean", odds.alias("odds"), sure.alias("sure"))
    listed = listed.where(F.col("sure") >= CERTAIN).orderBy((-F.col("toxic") * F.col("sure")), "stem").limit(CANDIDATES).collect()
    names = [r["stem"] for r in listed]
    number = {s: i for i, s in enumerate(names)}

    def holdings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            own = [sorted({number[s] for w in set(TOKEN.findall(lowered(t))) for s in stems_of(w) if s in number}) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([np.array(o, "<i4").tobytes() for o in own], pa.binary())], names=["held"])

    held = [np.frombuffer(r["held"], "<i4") for r in sample.where("toxic = 1").select("text").mapInArrow(holdings, "held binary").toLocalIterator()]
    chosen = cover(held, np.array([r["clean"] for r in listed], np.int64), good, names, least)
    stems = {names[i]: float(listed[i]["odds"]) for i in chosen}

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for batch in slices(batches, 500):
            rows = pa.array([features(t, lexicon).tolist() for t in _texts(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), rows], names=["toxic", "x"])

    rows = sample.mapInArrow(measured, "toxic int, x array<double>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["x"]))
    weights = logistic(np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float), PRIOR)
    return Model(stems, tuple(weights))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: score from 0 to 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = Lexicon(model.stems), np.array(model.weights)
        for batch in slices(batches, 1000):
            x = np.array([features(t, lexicon) for t in _texts(batch)]).reshape(-1, len(weights))
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def clauses(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every matched clause: (doc_id, start, end, kind, weight, clause), places in
    code points, end exclusive; a row per kind that a clause holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.stems)
        for batch in slices(batches, 200):
            rows = [(i, a, b, KIND_NAMES[KINDS.index(kind)], w, t[a:b]) for i, t in zip(batch.column("doc_id").to_pylist(), _texts(batch), strict=True) for a, b, kind, w in clause_weights(t, lexicon)]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "start", "end", "kind", "weight", "clause"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, start int, end int, kind string, weight double, clause string")
