"""Token ids of a lower-casing word-level BPE file, one distinct piece at a time.

The tokenizer's normalizer and pre-tokenizer never look across white space, so
the ids of a text are those of its pieces (runs of letters, single digits, runs
of signs, English contractions) in order.  Texts of ASCII and Latin-1 letters
are lower-cased and cut by the file's own split rule over whole batches of
bytes; each worker keeps the values of the pieces it has met in arrays, found
by a 64-bit hash, and only new pieces go to the library's BPE model.  A text of
other letters, or one that may hold a special token's string, is taken word by
word, and such words go through the whole library tokenizer.  A file of another
make goes through the library text by text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from emporium.llm.common import give_back, mix
from emporium.llm.prefixbpe import PrefixCounter

# Fixed values of the tokenizer file's format: the shape it must have for its
# texts to be cut at white space.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHORT_ENDINGS, LONG_ENDINGS = (b"s", b"t", b"m", b"d"), (b"re", b"ve", b"ll")

# The split rule for lower-cased texts of ASCII and Latin-1 letters.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\\s]+")
PLAIN = re.compile("[\\t-\\r -~À-ÖØ-öø-ÿ]*")

# Classes of bytes in a lower-cased plain text: 0 white space, 1 letter, 2 digit, 3 sign.
CLASS = np.full(256, 3, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = 0
CLASS[ord("a") : ord("z") + 1] = 1
CLASS[128:] = 1
CLASS[ord("0") : ord("9") + 1] = 2

CHUNK = 1 << 19  # bytes of text cut at once
KEPT = 1 << 19  # pieces that a worker keeps: about 30 MB with their hash table
LONG_PIECE = 64  # characters up to which every prefix of a piece is encoded on its own
SHORT = 6  # letters of a prefix whose count is kept: many words begin alike


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte (from the rule of byte-level BPE)."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceTable:
    """Hash of a piece -> a run of numbers; emptied when it is full."""

    def __init__(self, dtype, make: Callable[[str], np.ndarray]):
        self.dtype, self.make = np.dtype(dtype), make
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(2 * KEPT, np.uint64)
        self.at = np.full(2 * KEPT, -1, np.int32)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if it is new."""
        slot = (hashes & np.uint64(2 * KEPT - 1)).astype(np.int64)
        entry = self.at[slot]
        todo = np.flatnonzero((entry >= 0) & (self.keys[slot] != hashes))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (2 * KEPT - 1)
            entry[todo] = self.at[slot[todo]]
            todo = todo[(entry[todo] >= 0) & (self.keys[slot[todo]] != hashes[todo])]
        return entry

    def add(self, hashes: np.ndarray, values: list[np.ndarray]) -> None:
        """Distinct new hashes, at most ``KEPT`` with those held."""
        counts = np.array([len(v) for v in values], np.int64)
        start = len(self.flat) + np.cumsum(counts) - counts
        entry = np.arange(len(self.count), len(self.count) + len(hashes), dtype=np.int32)
        self.begin, self.count = np.concatenate((self.begin, start)), np.concatenate((self.count, counts))
        self.flat = np.concatenate((self.flat, *values))
        slot = (hashes & np.uint64(2 * KEPT - 1)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            free = todo[self.at[slot[todo]] < 0]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.at[slot[put]], self.keys[slot[put]] = entry[put], hashes[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (2 * KEPT - 1)

    def values(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of the entries end to end, and where each ends."""
        counts = self.count[entries]
        ends = np.cumsum(counts)
        shift = self.begin[entries] - (ends - counts)
        return self.flat[np.repeat(shift, counts) + np.arange(ends[-1] if len(ends) else 0)], ends


def cut(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the pieces of lower-cased plain text that begins
    and ends with a space."""
    kind = CLASS[buffer]
    start = np.empty(len(buffer), bool)
    start[0] = False
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == 2
    for q in np.flatnonzero((buffer[1:-3] == 39) & (kind[:-4] != 3)) + 1:
        after = buffer[q + 1 : q + 3].tobytes()
        length = 2 if after[:1] in SHORT_ENDINGS else 3 if after in LONG_ENDINGS else 0
        if length:
            start[q + 1 : q + length] = False
            start[q + length] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(buffer))
    inside = kind[starts] != 0
    return starts[inside], ends[inside]


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    size = CHUNK + LONG_PIECE
    up = np.cumprod(np.full(size, base, np.uint64))
    down = np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))
    return up, down


def piece_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers()
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64))


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        split = (conf.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            (conf.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and (split[0].get("pattern") or {}).get("Regex") == SPLIT
            and conf["model"].get("end_of_word_suffix") == "</w>"
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in conf["added_tokens"])
            and all("<|" in t["content"] for t in conf["added_tokens"])
        )
        self.letters = byte_letters()
        self.path, self.counter = path, None
        self.prefixes: dict[str, int] = {}
        self.piece_ids = PieceTable(self.dtype, self._piece_ids)
        self.piece_steps = PieceTable(np.int32, self._piece_steps)

    def _library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _model(self, piece: str) -> list:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return self.model.tokenize(piece)

    def _piece_ids(self, piece: str) -> np.ndarray:
        return np.array([t.id for t in self._model(piece)], self.dtype)

    def _prefix(self, prefix: str) -> int:
        n = self.prefixes.get(prefix)
        if n is None:
            n = len(self._model(prefix))
            if len(prefix) <= SHORT and len(self.prefixes) < KEPT // 4:
                self.prefixes[prefix] = n
        return n

    def _piece_steps(self, piece: str) -> np.ndarray:
        """Change of the count at each byte of a piece.  The prefixes of a
        contraction are cut otherwise than itself, so they go to the library."""
        if len(piece) > LONG_PIECE:
            return spread(piece, self._counter().piece(piece))
        if piece[0] == "'" and len(piece) > 1:
            return spread(piece, [len(self._library(piece[:i])) for i in range(1, len(piece) + 1)])
        return spread(piece, [self._prefix(piece[:i]) for i in range(1, len(piece) + 1)])

    def _word_steps(self, word: bytes) -> np.ndarray:
        text = word.decode()
        if len(text) <= LONG_PIECE:
            return spread(text, [len(self._library(text[:i])) for i in range(1, len(text) + 1)])
        return spread(text, self._counter().word(text))

    def _counter(self) -> PrefixCounter:
        if self.counter is None:
            self.counter = PrefixCounter(self.path, self.library, self.letters)
        return self.counter

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts, in the smallest width that holds the vocabulary."""
        if not self.by_word:
            return [np.array(self._library(t.decode()), self.dtype) for t in texts]
        return self._each(texts, self.piece_ids, lambda w: np.array(self._library(w.decode()), self.dtype))

    def steps(self, texts: list[bytes]) -> list[np.ndarray]:
        """Change of the token count at each byte of the texts that is not white space."""
        return self._each(texts, self.piece_steps, self._word_steps)

    def _each(self, texts: list[bytes], table: PieceTable, other: Callable[[bytes], np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, table.dtype)] * len(texts)
        held, size = [], 0
        for i, text in enumerate(texts):
            string = text.decode()
            if not PLAIN.fullmatch(string) or "<|" in string:
                # words that only plain text is made of still go by pieces
                words = text.split()
                plain = [bool(PLAIN.fullmatch(w.decode())) and b"<|" not in w for w in words]
                known = iter(self._each([w for w, p in zip(words, plain, strict=True) if p], table, other))
                parts = [next(known) if p else other(w) for w, p in zip(words, plain, strict=True)]
                out[i] = np.concatenate(parts) if parts else out[i]
                continue
            held.append((i, string.lower().encode()))
            size += len(text) + 1
            if size >= CHUNK // 2:
                self._plain(held, table, out)
                held, size = [], 0
        self._plain(held, table, out)
        return out

    def _plain(self, held: list[tuple[int, bytes]], table: PieceTable, out: list[np.ndarray]) -> None:
        if not held:
            return
        joined = b" " + b" ".join(t for _, t in held) + b"    "
        if len(joined) > CHUNK:  # one very long text: cut at white space
            if len(held) > 1:
                for one in held:
                    self._plain([one], table, out)
                return
            (i, text), parts, at = held[0], [], 0
            while at < len(text):
                end = at + CHUNK // 2
                if end < len(text):
                    gap = re.compile(rb"[\t-\r ]").search(text, end)
                    end = gap.start() if gap else len(text)
                piece = text[at:end]
                if len(piece) > CHUNK - 8:  # no white space for half a million bytes
                    parts.extend(table.make(p) for p in PIECES.findall(piece.decode()))
                else:
                    part = [np.zeros(0, table.dtype)]
                    self._plain([(0, piece)], table, part)
                    parts.append(part[0])
                at = end
            out[i] = np.concatenate(parts)
            return
        buffer = np.frombuffer(joined, np.uint8)
        starts, ends = cut(buffer)
        hashes = piece_hashes(buffer, starts, ends)
        entries = table.find(hashes)
        new = np.flatnonzero(entries < 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            if len(table.count) + len(fresh) > KEPT:
                table.clear()
                new = np.arange(len(hashes))
                fresh, first = np.unique(hashes, return_index=True)
            made = [table.make(joined[starts[p] : ends[p]].decode()) for p in new[first]]
            table.add(fresh, made)
            entries = table.find(hashes)
        values, value_ends = table.values(entries)
        lengths = np.array([len(t) + 1 for _, t in held])
        last = np.searchsorted(starts, np.cumsum(lengths), side="right")  # pieces up to each text's end
        bounds = np.concatenate(([0], np.append([0], value_ends)[last]))
        for (i, _), a, b in zip(held, bounds[:-1], bounds[1:], strict=True):
            out[i] = values[a:b]


def spread(text: str, counts: list[int]) -> np.ndarray:
    """Steps between the counts at the characters of ``text``, each at the
    character's last byte."""
    steps = array("i")
    before = 0
    for c, n in zip(text, counts, strict=True):
        if c > "\x7f":
            steps.extend([0] * (len(c.encode()) - 1))
        steps.append(n - before)
        before = n
    return np.array(steps, np.int32)


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    made = WordEncoder(path)
    give_back()  # what reading the file took
    return made
