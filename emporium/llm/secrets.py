"""Secret scans with DataFrame functions only.

Rules.  Three patterns, leftmost and non-overlapping per kind: ``assign`` (a
key word, a sign and a value of 8 or more characters), ``access`` (AKIA keys of
16 or more) and ``hex`` (runs of 32 or more).  A span is the whole match, in
code points, its end exclusive.

Randomness battery.  Every run of 20 or more characters of base64's alphabets
is a candidate.  Its encoding is the narrowest of hex, base32 and base64 that
has all its characters.  Three tests ask whether it could be a uniform draw from
that alphabet: chi-squared over the characters, Wald-Wolfowitz runs above and
below the alphabet's middle, and the lag-one serial correlation, each as a z
score; a z beyond 3.3 makes it no random string.

The same three are then held against ordinary identifiers, as log-likelihood
ratios of a uniform draw to an identifier: characters (the difference of the
two chi-squared statistics in their likelihood form: identifiers have the letter
frequencies of English, a fifth spread evenly), runs of lower case, upper case,
digits and signs (identifiers change class as in ``MOVES``), and the correlation
of neighbours (vowels and consonants alternate).  A ratio of x or more has a
probability of at most 1/x in an identifier, so three times (for the choice of
the encoding) the inverse of the product is a p-value; it falls with length.
Benjamini-Hochberg at ``FDR`` over all candidates of the corpus, per encoding and
in bands of doubling length, says which are reported as ``random``; those that a
test of uniformity rejects count with p = 1.  Candidates that overlap a rule's
span are not reported twice.

The procedure needs, per encoding and band, how many candidates lie in each of
601 bins of p: an aggregate of at most some ten thousand rows, whatever the
corpus.  Weights are whole thousandths, so that sums do not depend on order.

Long lists.  Places of matches are running sums; lists of n matches are worked
in blocks of about the root of n, so a text of many matches costs little more
than its length.

Defined results: a null or empty text has no spans; null ids stay null;
repeated rows are scanned each on their own (and count as candidates each).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import id_and_text

# The patterns of the rules, their least lengths, in order of kind.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ("assign", "access", "hex", "random")
SECRET_CHARS = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
ALPHABETS = {16: "0123456789abcdef", 32: "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 64: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
FDR = 0.01
BEYOND = 3.3
BINS = 600  # tenths of a power of ten

# Letters by frequency in English text, per 10,000.
LETTERS = "ETAOINSHRDLCUMWFGYPBVKJXQZ"
FREQUENCIES = [1270, 906, 817, 751, 697, 675, 633, 609, 599, 425, 403, 278, 276, 241, 236, 223, 202, 197, 193, 149, 98, 77, 15, 15, 10, 7]
EVEN = 0.2  # share of the letters that is spread evenly
# What follows what in identifiers: rows and columns are digit, lower, upper, sign.
# Hex and base32 hold no mixed case, so every change is alike there.
STAY = [[0.85 if i == j else 0.05 for j in range(4)] for i in range(4)]
MIXED = [[0.7, 0.1, 0.1, 0.1], [0.05, 0.85, 0.05, 0.05], [0.05, 0.2, 0.7, 0.05], [0.15, 0.4, 0.4, 0.05]]
MOVES = {16: STAY, 32: STAY, 64: MIXED}
VOWEL_AFTER = (0.5, 0.2)  # after a consonant, after a vowel


def _thousandths(ratio: float) -> int:
    return round(1000 * math.log(ratio))


def _letter_shares() -> list[float]:
    return [(1 - EVEN) * f / sum(FREQUENCIES) + EVEN / 26 for f in FREQUENCIES]


def _weights() -> tuple[list[int], dict[int, list[int]], list[int]]:
    """Log-likelihood ratios in thousandths: per letter (1 to 26, 0 is none), per
    encoding and step (4 x class before + class), per step of vowels (2 x before + own)."""
    shares = _letter_shares()
    letters = [0] + [_thousandths(1 / 26 / x) for x in shares]
    steps = {}
    for size, alphabet in ALPHABETS.items():
        digits, signs = sum(c.isdigit() for c in alphabet), 2 * (size == 64)
        cased = size - digits - signs
        one = [digits, cased if size < 64 else 26, cased if size < 64 else 26, signs]
        steps[size] = [_thousandths(one[k] / size / MOVES[size][before][k]) if one[k] else 0 for before in range(4) for k in range(4)]
    vowels = sum(x for x, c in zip(shares, LETTERS, strict=True) if c in "AEIOU")
    tones = [_thousandths(base / p) for q in VOWEL_AFTER for base, p in ((1 - vowels, 1 - q), (vowels, q))]
    return letters, steps, tones


SPAN = "struct<start:int,kind:int,stop:int>"
NONE = f"cast(array() as array<{SPAN}>)"
TEXT = "__secret_text"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``value``, worked out once, under ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _blocks(listed: str) -> str:
    """SQL: the array in blocks of about the root of its size; an empty one is one empty block."""
    width = f"greatest(64, cast(ceil(sqrt(size({listed}))) as int))"
    return f"transform(sequence(0, greatest(size({listed}) - 1, 0), {width}), i -> slice({listed}, i + 1, {width}))"


def _matches(pattern: str, group: int = 0) -> str:
    """SQL: array of (start, text of the match, text of the group).  What lies
    between the matches gives their places."""
    p = _quoted(pattern)
    hits, parts = f"regexp_extract_all({TEXT}, {p}, 0)", f"regexp_extract_all({TEXT}, {p}, {group})"
    each = _let("h", hits, f"zip_with(zip_with(h, {parts}, (x, y) -> named_struct('hit', x, 'part', y)), slice(split({TEXT}, {p}, -1), 1, size(h)), (x, y) -> named_struct('hit', x.hit, 'part', x.part, 'gap', y))")
    before = """aggregate(b, named_struct('at', 0, 'out', cast(array() as array<int>)), (s, own) -> named_struct(
        'at', s.at + aggregate(own, 0, (t, x) -> t + length(x.gap) + length(x.hit)), 'out', concat(s.out, array(s.at))), s -> s.out)"""
    placed = """aggregate(own, named_struct('at', at, 'out', cast(array() as array<struct<start:int,hit:string,part:string>>)),
        (s, x) -> named_struct(
            'at', s.at + length(x.gap) + length(x.hit),
            'out', concat(s.out, array(named_struct('start', s.at + length(x.gap), 'hit', x.hit, 'part', x.part)))),
        s -> s.out)"""
    return _let("m", each, _let("b", _blocks("m"), f"flatten(zip_with(b, {before}, (own, at) -> {placed}))"))


def _spans(kind: int, when: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    found = f"filter({_matches(pattern, group)}, x -> length(x.part) >= {least})"
    return F.expr(f"if({when}, transform({found}, x -> named_struct('start', x.start, 'kind', {kind}, 'stop', x.start + length(x.hit))), {NONE})")


def _array(numbers: list[int]) -> str:
    return f"array({', '.join(map(str, numbers))})"


def _candidates() -> Column:
    """Array of candidates with the bin of their p-value."""
    letters, steps, tones = _weights()
    alphabet = " ".join(f"when {a} then '{letters_}'" for a, letters_ in ALPHABETS.items())
    moves = " ".join(f"when {a} then {_array(w)}" for a, w in steps.items())
    vowels = ", ".join(str(LETTERS.index(c) + 1) for c in "AEIOU")
    coded = f"""transform({_matches(CANDIDATE)}, x -> named_struct('start', x.start, 'stop', x.start + length(x.hit), 'body', rtrim('=', x.hit)))"""
    sized = f"""transform({coded}, x -> named_struct('start', x.start, 'stop', x.stop, 'body', x.body, 'n', length(x.body), 'a',
        case when length(x.body) < 8 then 0 when x.body rlike '^(?:[0-9a-f]+|[0-9A-F]+)$' then 16 when x.body rlike '^[A-Z2-7]+$' then 32 else 64 end))"""
    listed = f"""transform(filter({sized}, x -> x.a > 0), x -> named_struct('start', x.start, 'stop', x.stop, 'n', x.n, 'a', x.a,
        'index', transform(split(if(x.a = 16, lower(x.body), translate(x.body, '-_', '+/')), ''), c -> instr(case x.a {alphabet} end, c) - 1),
        'letter', transform(split(upper(x.body), ''), c -> instr('{LETTERS}', c)),
        'class', transform(split(x.body, ''), c -> case when c between '0' and '9' then 0 when c between 'a' and 'z' then 1 when c between 'A' and 'Z' then 2 else 3 end)))"""
    tone = f"if(x.class[i] = x.class[i - 1] and x.class[i] in (1, 2), {_array(tones)}[2 * if(x.letter[i - 1] in ({vowels}), 1, 0) + if(x.letter[i] in ({vowels}), 1, 0)], 0)"
    summed = f"""transform({listed}, x -> named_struct('start', x.start, 'stop', x.stop, 'n', x.n, 'a', x.a,
        'squares', aggregate(sequence(0, x.a - 1), 0D, (s, k) -> s + power(size(filter(x.index, i -> i = k)), 2)),
        'runs', aggregate(sequence(1, x.n - 1), 1, (s, i) -> s + if((2 * x.index[i] >= x.a) <> (2 * x.index[i - 1] >= x.a), 1, 0)),
        'spread', aggregate(x.index, 0D, (s, i) -> s + power(i - (x.a - 1) / 2D, 2)),
        'along', aggregate(sequence(1, x.n - 1), 0D, (s, i) -> s + (x.index[i] - (x.a - 1) / 2D) * (x.index[i - 1] - (x.a - 1) / 2D)),
        'characters', aggregate(x.letter, 0, (s, k) -> s + {_array(letters)}[k] + case when k > 0 and x.a = 16 then {_thousandths(26 / 6)} when k = 0 and x.a = 32 then {_thousandths(10 / 6)} else 0 end),
        'classes', aggregate(sequence(1, x.n - 1), 0, (s, i) -> s + (case x.a {moves} end)[4 * x.class[i - 1] + x.class[i]]),
        'neighbours', aggregate(sequence(1, x.n - 1), 0, (s, i) -> s + {tone})))"""
    scored = f"""transform({summed}, x -> named_struct('start', x.start, 'stop', x.stop, 'n', x.n, 'a', x.a,
        'chi', (x.a / x.n * x.squares - x.n - (x.a - 1)) / sqrt(2D * (x.a - 1) * (x.n - 1) / x.n),
        'runs', (x.runs - 1 - (x.n - 1) / 2D) / (sqrt(x.n - 1) / 2D),
        'serial', x.along / x.spread * sqrt(x.n),
        'ratio', x.characters + x.classes + x.neighbours - {_thousandths(3)}))"""
    binned = f"""transform({scored}, x -> named_struct('start', x.start, 'stop', x.stop, 'band', 100 * x.a + cast(floor(log2(x.n)) as int),
        'bin', if(x.chi <= {BEYOND} and abs(x.runs) <= {BEYOND} and abs(x.serial) <= {BEYOND},
            cast(least({BINS}, greatest(0, floor(x.ratio / {100 * math.log(10)}D))) as int), 0)))"""
    empty = "cast(array() as array<struct<start:int,stop:int,band:int,bin:int>>)"
    return F.expr(f"if({TEXT} rlike '[A-Za-z0-9+/_=-]{{20}}', {binned}, {empty})")


def _found(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the rules' spans in order and the candidates."""
    keyword = r"(?i)(?:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]"
    base = [
        _spans(0, f"{TEXT} rlike {_quoted(keyword)}", ASSIGN, 2, SECRET_CHARS),
        _spans(1, f"contains({TEXT}, 'AKIA')", ACCESS),
        _spans(2, f"{TEXT} rlike '[0-9a-f]{{32}}'", HEX),
    ]
    texts = docs.withColumn(TEXT, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return texts.withColumns({"__base": F.array_sort(F.concat(*base)), "__candidates": _candidates()})


def thresholds(docs: DataFrame, text_col: str = "text", fdr: float = FDR) -> dict[int, int]:
    """Per encoding and length band the least bin that Benjamini-Hochberg reports."""
    one = _found(docs.select(text_col), text_col).select(F.explode("__candidates").alias("c"))
    bins = one.groupBy("c.band", "c.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for band in {r["band"] for r in bins}:
        counts = {r["bin"]: r["n"] for r in bins if r["band"] == band}
        total, above = sum(counts.values()), 0
        for b in sorted(counts, reverse=True):
            above += counts[b]
            if 10 ** (-b / 10) <= fdr * above / total:
                out[band] = b
    return out


def scanned(docs: DataFrame, text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """``docs`` with one more column, ``__spans``: array of (start, kind, stop)
    in order, kind an index of ``KINDS``.  Two passes over the texts, no
    shuffle but that of the bins' counts."""
    least = thresholds(docs, text_col, fdr)
    passes = reduce(lambda c, item: c + f" or (c.band = {item[0]} and c.bin >= {item[1]})", sorted(least.items()), "false")
    hits = f"transform(filter(__candidates, c -> {passes}), c -> named_struct('start', c.start, 'kind', 3, 'stop', c.stop))"
    near = "filter(__base, b -> b.start < own[size(own) - 1].stop and own[0].start < b.stop)"
    alone = _let("near", near, "filter(own, c -> not exists(near, b -> b.start < c.stop and c.start < b.stop))")
    random = _let("r", hits, f"flatten(transform({_blocks('r')}, own -> if(size(own) = 0, own, {alone})))")
    found = _found(docs, text_col).withColumn("__spans", F.expr(f"array_sort(concat(__base, {random}))"))
    return found.drop("__base", "__candidates", TEXT)


def joined(spans: str) -> str:
    """SQL: the spans as text, kind:start:stop joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.stop)), ',')"


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per document: id, spans per kind, digest of the rules' spans, all spans."""
    spans = scanned(id_and_text(docs, id_col, text_col), "text", fdr).select("doc_id", F.col("__spans").alias("found"))
    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(F.expr(joined("filter(found, s -> s.kind < 3)")), 256).alias("base_sha256"), F.expr(joined("found")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """``docs`` with each secret, overlapping ones as one, replaced by ``mark``."""
    text = f"`{text_col}`"
    ends = """aggregate(b, named_struct('at', 0, 'out', cast(array() as array<int>)),
        (s, own) -> named_struct('at', greatest(s.at, array_max(transform(own, x -> x.stop))), 'out', concat(s.out, array(s.at))), s -> concat(s.out, array(s.at)))"""
    block = f"""aggregate(own, named_struct('at', at, 'out', ''),
        (s, x) -> named_struct('at', greatest(s.at, x.stop), 'out',
            if(x.start >= s.at, concat(s.out, substring(part, s.at - at + 1, x.start - s.at), '{mark}'), s.out)),
        s -> s.out)"""
    part = f"substring({text}, at + 1, greatest(0, own[size(own) - 1].start - at))"
    pieces = f"zip_with(b, slice(e, 1, size(b)), (own, at) -> {_let('part', part, block)})"
    joined_up = _let("e", ends, f"concat(array_join({pieces}, ''), substring({text}, e[size(b)] + 1))")
    cut = _let("b", _blocks("__spans"), joined_up)
    return scanned(docs, text_col, fdr).withColumn(text_col, F.expr(f"if(size(__spans) > 0, {cut}, `{text_col}`)")).drop("__spans")
