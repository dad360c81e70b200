"""Exact token counts at every character of a long word, in one pass.

Three parts work from left to right.  Normalisation is taken per cluster (a
character and what can compose with it or be put in order before it), by the
library.  The split rule is followed character by character over the library's
own classes of characters.  Inside a piece, byte-pair encoding is followed byte
by byte: tokens that follow each other encode a text exactly if every two
neighbours encode to themselves when joined, so the last token at a place is
the one that fits the last token where it begins.  Tokens that end a piece
carry a suffix and no token follows them; they are looked for at each character
and not built upon.

Work per character is bounded by the longest token; only a run of over 32
combining marks is normalised and encoded again, by the library, at each mark.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

END = "</w>"
SPACE, LETTER, DIGIT, SIGN, CONTRACTION = range(5)
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")  # fixed values: the split rule's
LONG_CLUSTER = 32  # characters of a cluster from which its prefixes go to the library
FITS = 1 << 17  # pairs of tokens whose verdict a worker keeps


@lru_cache(maxsize=1)
def second_letters() -> frozenset[str]:
    """Characters that a canonical composition can take as its second."""
    jamo = [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]
    parts = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    return frozenset([chr(c) for c in jamo] + [chr(int(p[1], 16)) for p in parts if len(p) == 2 and "<" not in p[0]])


class PrefixCounter:
    def __init__(self, path: str, library, letters: dict[int, str]):
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        model = conf["model"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        made = {a + b: i for i, (a, b) in reversed(list(enumerate(merges)))}
        ordered = all(made.get(part, -1) < i for i, m in enumerate(merges) for part in m)
        if model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or not ordered:
            raise ValueError(f"{path}: prefix counts need merges that build on earlier ones only")
        self.known = frozenset(model["vocab"])
        self.longest = max(len(t.removesuffix(END)) for t in self.known)
        self.special = [t["content"] for t in conf["added_tokens"]]
        self.normalize = library.normalizer.normalize_str
        self.model = library.model
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.letters = letters
        self.fits: dict[tuple[str, str], bool] = {}
        self.kinds: dict[str, int] = {}
        self.normal: dict[str, str] = {}

    def kind(self, c: str) -> int:
        """Class of a normalised character."""
        k = self.kinds.get(c)
        if k is None:
            k = SPACE if not self.split(c) else LETTER if len(self.split("a" + c)) == 1 else SIGN if len(self.split("!" + c)) == 1 else DIGIT
            self.kinds[c] = k
        return k

    @staticmethod
    def begins(c: str) -> bool:
        """Does normalisation never look across the place before ``c``?"""
        first = unicodedata.normalize("NFD", c)[0]
        return unicodedata.combining(first) == 0 and first not in second_letters() and unicodedata.category(c) != "Cn"

    def merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            rank, at = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == len(self.rank):
                break
            symbols[at : at + 2] = ["".join(symbols[at : at + 2])]
        return symbols

    def fit(self, before: str, token: str) -> bool:
        """Do the two encode to themselves when joined?  An empty ``before`` is a piece's begin."""
        out = self.fits.get((before, token))
        if out is None:
            body = token.removesuffix(END)
            symbols = [*before, *body[:-1], body[-1] + token[len(body) :]]
            out = self.merged(symbols) == ([before, token] if before else [token])
            if len(self.fits) >= FITS:
                self.fits.clear()
            self.fits[before, token] = out
        return out

    def word(self, text: str) -> list[int]:
        """Token count of each prefix of a text."""
        out: list[int] = []
        walk, begin, cluster, at, tail = Walk(self, 0), 0, 0, 0, ""
        for i, c in enumerate(text):
            if i == begin or self.begins(c):
                if i - cluster > LONG_CLUSTER and i > begin:
                    walk.turn_to(at, tail, self.normalize(text[cluster:i]))
                cluster, at, tail = i, len(walk.chars), ""
            if cluster == i:
                now = self.normal.get(c)
                if now is None:
                    now = self.normal[c] = self.normalize(c)
            else:
                now = self.normalize(text[cluster : i + 1])
            if i - cluster >= LONG_CLUSTER:
                out.append(walk.total_with(at, now))
            else:
                walk.turn_to(at, tail, now)
                tail = now
                out.append(walk.totals[-1])
            for s in self.special:
                if text.endswith(s, begin, i + 1):
                    out[i] = (out[i - len(s)] if i >= len(s) else 0) + 1
                    walk, begin = Walk(self, out[i]), i + 1
                    break
        return out

    def piece(self, text: str) -> list[int]:
        """Token count of each prefix of a normalised run of letters or signs."""
        walk = Walk(self, 0)
        for c in text:
            walk.push(c, SIGN)
        return walk.totals[1:]


class Walk:
    """The state after each normalised character, so that the last can be taken back."""

    def __init__(self, counter: PrefixCounter, before: int):
        self.counter = counter
        self.chars: list[str] = []
        self.totals = [before]  # tokens up to here
        self.pieces = [(0, SPACE, before)]  # of the last piece: first character, kind, tokens before it
        self.bytes = [0]  # place in the three lists below
        self.symbols: list[str] = []
        self.tokens: list[str] = []  # last token, if the piece goes on
        self.counts: list[int] = []  # tokens of the piece, if it goes on

    def turn_to(self, at: int, old: str, new: str) -> None:
        """Replace ``old``, the characters from ``at``, by ``new``."""
        same = len(old)
        if not new.startswith(old):
            same = next((k for k, (a, b) in enumerate(zip(new, old, strict=False)) if a != b), min(len(new), len(old)))
        self.back_to(at + same)
        for x in new[same:]:
            self.push(x, self.counter.kind(x))

    def total_with(self, at: int, new: str) -> int:
        """Tokens up to ``at`` and ``new`` after it, by the library, from the
        last but one piece (a contraction reaches over two)."""
        start, _, before = self.pieces[self.pieces[at][0]]
        pieces = self.counter.split("".join(self.chars[start:at]) + new)
        return before + sum(len(self.counter.model.tokenize(p)) for p, _ in pieces)

    def back_to(self, n: int) -> None:
        if n < len(self.chars):
            del self.chars[n:], self.totals[n + 1 :], self.pieces[n + 1 :], self.bytes[n + 1 :]
            for x in (self.symbols, self.tokens, self.counts):
                del x[self.bytes[-1] :]

    def push(self, c: str, kind: int) -> None:
        n = len(self.chars)
        self.chars.append(c)
        start, last, before = self.pieces[n]
        self.symbols.extend(self.counter.letters[b] for b in c.encode())
        for back in (1, 2):  # a sign of its own becomes a contraction
            if n >= back and self.chars[n - back] == "'" and self.pieces[n - back + 1][:2] == (n - back, SIGN) and "".join(self.chars[n - back :]) in CONTRACTIONS:
                start, kind, before = n - back, CONTRACTION, self.totals[n - back]
                break
        else:
            if kind != last or kind not in (LETTER, SIGN):
                start, before = n, self.totals[n]
        new = range(self.bytes[n] + 1, len(self.symbols) + 1)
        if kind == CONTRACTION:  # no token goes on from it, and its sign and letters stay as they were for ``back_to``
            self.tokens.extend("" for _ in new)
            self.counts.extend(0 for _ in new)
            total = before + len(self.counter.merged([*self.chars[start:n], c + END]))
        else:
            first = self.bytes[start]
            for end in new:
                token, count = self.last(first, end, "")
                self.tokens.append(token)
                self.counts.append(count)
            total = before + (0 if kind == SPACE else self.last(first, len(self.symbols), END)[1])
        self.pieces.append((start, kind, before))
        self.bytes.append(len(self.symbols))
        self.totals.append(total)

    def last(self, first: int, end: int, suffix: str) -> tuple[str, int]:
        """Last token of the piece's bytes up to ``end``, and their number of tokens."""
        body = "".join(self.symbols[max(first, end - self.counter.longest) : end])
        for k in range(len(body)):
            token, at = body[k:] + suffix, end - len(body) + k
            if token in self.counter.known and self.counter.fit(self.tokens[at - 1] if at > first else "", token):
                return token, 1 + (self.counts[at - 1] if at > first else 0)
        raise ValueError(f"no token for {body!r}")
