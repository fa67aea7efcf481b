"""Noisy-channel restoration of disguised words.

A disguised word is a lattice: each written character stands for one or more intended strings, at a
cost. Viterbi decoding finds the path of least cost under the channel and a character language
model, which is counted over the whole corpus.
"""

import re
import string
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.token_ids import batches

#: Letters of the language model: 0 bounds words, 1 to 26 are a to z, 27 is any other letter.
LETTERS = 28
#: Paths that decoding keeps at a place; paths of one context are one already.
BEAM = 48
#: Words that a worker remembers.
REMEMBERED = 600_000

# What a sign or digit can stand for.
MEANT = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e",
    "£": "l", "¡": "i", "§": "s", "µ": "u",
}
# Signs that are put between letters, and signs that stand for any letter.
BETWEEN, ANY = " .-_~'`^/\\,:;", "*#%"

#: Costs, in natural logarithms: a sign read as a letter, dropped, as a bound; a repeated letter.
AS_LETTER, DROPPED, AS_BOUND, AS_ANY, REPEATED = 1.0, 2.5, 2.5, 3.0, 0.7

_CLASS = np.zeros(0x251, "uint8")
for _c in range(0x250):
    _base = unicodedata.normalize("NFD", chr(_c).lower())[0]
    if chr(_c).isalpha():
        _CLASS[_c] = ord(_base) - 96 if "a" <= _base <= "z" else 27
_CLASS[0x250] = 27
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_EDGES = "".join(x for x in string.punctuation if x not in "@$|!+")


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS[np.minimum(points, 0x250)]


def _grams(text: str) -> np.ndarray:
    """The four-letter grams of a text's words; letters before a word's start are bounds."""
    c = np.concatenate([np.zeros(3, "uint8"), _classes(text), np.zeros(1, "uint8")]).astype("int32")
    own, p1 = c[3:], c[2:-1]
    p2 = np.where(p1 == 0, 0, c[1:-2])
    p3 = np.where(p2 == 0, 0, c[:-3])
    gram = ((p3 * LETTERS + p2) * LETTERS + p1) * LETTERS + own
    return gram[(own > 0) | (p1 > 0)]


def gram_counts(docs: DataFrame) -> np.ndarray:
    """How often each four-letter gram occurs in all of ``docs``; at most ``LETTERS`` ** 4 come back."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**4, "int64")
        for part in parts:
            for texts in batches([x for x in part.column(0).to_pylist() if x]):
                total += np.bincount(_grams("\n".join(texts)), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    found = docs.select("text").mapInArrow(rows, "gram long, n long")
    found = found.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(LETTERS**4, "int64")
    counts[found["gram"].to_numpy(dtype="int64")] = found["n"].to_numpy(dtype="int64")
    return counts


def log_chances(counts: np.ndarray) -> np.ndarray:
    """Of each gram, the logarithm of its last letter's chance after the others.

    Shorter contexts are mixed in where a longer one was seen little.
    """
    n = counts.reshape([LETTERS] * 4).astype("float64")
    by_two = n.sum(axis=(0, 1))
    chance = (n.sum(axis=(0, 1, 2)) + 0.5) / (n.sum() + 0.5 * LETTERS)
    chance = (by_two + 20 * chance) / (by_two.sum(axis=-1, keepdims=True) + 20)
    by_three = n.sum(axis=0)
    chance = (by_three + 20 * chance) / (by_three.sum(axis=-1, keepdims=True) + 20)
    chance = (n + 10 * chance) / (n.sum(axis=-1, keepdims=True) + 10)
    return np.log(chance).astype("float32").ravel()


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Of each place, the strings it can stand for, with costs."""
    slots, i = [], 0
    while i < len(word):
        c, j = word[i], i
        while j < len(word) and word[j] == c:
            j += 1
        run, i = j - i, j
        if c in BETWEEN:
            slots.append([("", 0.3), (" ", 1.0)])
        elif c in MEANT:
            for _ in range(run):
                slots.append([(x, AS_LETTER) for x in MEANT[c]] + [("", DROPPED), (" ", AS_BOUND)])
        elif c in ANY:
            for _ in range(run):
                slots.append([(x, AS_ANY) for x in string.ascii_lowercase] + [("", 1.0), (" ", 1.5)])
        elif c.isalpha() and run > 1:
            once = REPEATED if run > 2 else 2 * REPEATED
            slots.append([(c, once), (c * 2, REPEATED if run > 2 else 0.0)])
        elif c.isalpha():
            slots.append([(c, 0.0)])
        else:
            slots.append([(" ", 0.0)])
    return slots


def decode(slots: list[list[tuple[str, float]]], chances: np.ndarray) -> str:
    """The string of least cost."""
    code: dict[str, int] = {}
    paths = {0: (0.0, None)}  # the last three letters: cost, (letter, path before)
    for slot in [*slots, [(" ", 0.0)]]:
        new: dict[int, tuple] = {}
        for context, (cost, path) in paths.items():
            for meant, extra in slot:
                c, at, way = cost + extra, context, path
                for letter in meant:
                    if letter not in code:
                        code[letter] = int(_classes(letter)[0]) if letter != " " else 0
                    k = code[letter]
                    if k or at % LETTERS:  # a bound after a bound is none
                        c -= chances[at * LETTERS + k]
                        way = (letter, way)
                    at = (at * LETTERS + k) % LETTERS**3 if k else 0
                if at not in new or c < new[at][0]:
                    new[at] = (c, way)
        if len(new) > BEAM:
            new = dict(sorted(new.items(), key=lambda x: x[1][0])[:BEAM])
        paths = new
    _, path = min(paths.values(), key=lambda x: x[0])
    out = []
    while path:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out)).strip()


_RUN_OF_THREE = re.compile(r"(.)\1\1", re.DOTALL).search
# three signs that stand alone; every run of single letters has them
_THREE_ALONE = re.compile(r"(?<!\S)\S\s+\S\s+\S(?!\S)").search


class Restorer:
    """Words of a text as they were meant; a plain word is itself, in lower case."""

    def __init__(self, chances: np.ndarray):
        self.chances = chances
        self.known: dict[str, tuple[str, ...]] = {}

    def _restore(self, token: str) -> tuple[str, ...]:
        if token.isalpha():  # no signs to strip
            word = token.lower()
        else:
            word = token.translate(_INVISIBLE).lower().strip(_EDGES).rstrip("!")
        if word == token:  # one string for both
            word = token
        if word.isalpha():
            return (word,) if not _RUN_OF_THREE(word) else self._decoded(word)
        letters = sum(map(str.isalpha, word))
        if not letters:
            return ()
        bare = word.strip(string.punctuation)
        if bare.isalpha() and word[0].isalpha():  # signs after a word: is it one without them?
            return (bare, *self._decoded(word))
        return self._decoded(word)

    def _decoded(self, word: str) -> tuple[str, ...]:
        return tuple(decode(lattice(word), self.chances).split())

    def words(self, text: str | None) -> set[str]:
        return self.found(text, self.known, lambda words: words)

    def found(self, text: str | None, known: dict, of: Callable[[tuple[str, ...]], tuple]) -> set:
        """What ``of`` gives for the words of a text; ``known`` keeps it token by token."""
        tokens = (text or "").split()
        if len(known) > REMEMBERED:
            known.clear()
        distinct = set(tokens)
        for token in distinct.difference(known):
            known[token] = of(self._restore(token))
        out = set().union(*map(known.__getitem__, distinct))
        for run in single_letters(tokens) if _THREE_ALONE(text or "") else ():
            out.update(of(self._decoded(run)))
        return out


def single_letters(tokens: list[str], least: int = 4) -> Iterator[str]:
    """Runs of single characters that stand alone, each run as one string with blanks."""
    length = np.fromiter(map(len, tokens), "int32", len(tokens))
    alone = np.concatenate([[0], (length == 1).astype("int8"), [0]])
    edge = np.diff(alone)
    for start, end in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        if end - start >= least - 1:
            last = [tokens[end][0]] if end < len(tokens) and length[end] == 2 else []
            run = [*tokens[start:end], *last]
            if len(run) >= least and len({*run}) > 1:
                yield " ".join(run).lower()
