"""Alignment of two tokenizers over the same text, by divide and conquer at shared cuts.

A blank and the text are cut into tokens by a byte-level vocabulary (A) and by a sentence-piece
vocabulary (B, which adds the blank itself). A shared cut is a byte offset where a token of each ends.
An interval of both token runs is divided at the shared cut nearest its middle: ends of A around the
middle are looked up among the ends of B by bisection, in windows that widen until one is found. Both
halves are divided again; an interval without a cut inside is a group. All intervals of a run of
texts take a step together, so a step is a few array operations. Blanks and line ends between words
are shared cuts of any text, so a word is divided once and its groups are used wherever it occurs;
texts where such a cut is not certain (runs of white space) are divided as a whole.

A link is a pair of an A and a B token that end together. Counts of id pairs are needed over all
texts, so texts are cut and divided once: tasks write their links as numbers of a dictionary of their
own, with the dictionary; the dictionaries, which are far smaller, are summed by pair and sent back
to the links that they belong to. Links meet their answers one dictionary at a time, so Arrow and
Python never hold those of another, however many a task gets.

Defined results: texts that are null, empty, or not the same bytes as the joined tokens of A or of B
(such as texts that hold U+2581) have no tokens: zeros and an empty hash. Special tokens' strings
inside a text are plain text. Every row is a document, whatever its id. An empty table has an empty
result. Other columns are ignored, whatever their names.
"""

import hashlib
import os
import re
import string
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import held, stored
from sitelens.llm.token_ids import batches, byte_letters, is_latin, numbered, parts, tokenizer_path

#: Pairs in a dictionary, at most (and one run of texts more); then a task begins another.
DICTIONARY = 1 << 19
#: Links under one dictionary, about: what a task reads together when the answers come back.
LINKS = 1 << 21
#: Words that a task remembers; then it starts anew. Bounds memory only.
REMEMBERED = 250_000
#: Characters of a run of texts, about.
RUN = 1_000_000
#: Words whose bytes are compared with their tokens' at once.
COMPARED = 256

_LETTERS = frozenset(string.ascii_letters)
_LINKED = pa.schema(
    [
        ("dictionary", pa.int64()),
        ("doc_id", pa.list_(pa.int64())),
        ("n_a", pa.list_(pa.int64())),
        ("n_b", pa.list_(pa.int64())),
        ("n_groups", pa.list_(pa.int64())),
        ("groups_sha256", pa.list_(pa.string())),
        ("codes", pa.binary()),
        ("pairs", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int64())),
    ]
)
_LINKED_SQL = (
    "dictionary long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>,"
    " groups_sha256 array<string>, codes binary, pairs array<long>, times array<long>"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string"
)


def shared_cuts(ends_a, ends_b, a_from, a_to, b_from, b_to) -> tuple[np.ndarray, np.ndarray]:
    """The last A token and the last B token of each group, in order.

    ``ends_a`` and ``ends_b`` are rising byte offsets. Text ``i`` has the A tokens ``a_from[i]`` to
    ``a_to[i]``, exclusive, and likewise of B; it has tokens, and its last two end together.
    """
    out = []
    wide = np.zeros(len(a_from), dtype=np.int64)
    rest = np.stack([a_from, a_to, b_from, b_to]).astype(np.int64)
    while rest.shape[1]:
        inner = (rest[1] - rest[0] > 1) & (rest[3] - rest[2] > 1)
        out.append(rest[:, ~inner][[1, 3]])
        rest, wide = rest[:, inner], wide[inner]
        if not rest.shape[1]:
            break
        a_lo, a_hi = rest[0], rest[1] - 2  # ends inside the interval
        mid = (a_lo + a_hi) >> 1
        low, high = np.maximum(a_lo, mid - wide), np.minimum(a_hi, mid + wide)
        sizes = high - low + 1
        first = np.cumsum(sizes) - sizes
        near = np.arange(sizes.sum()) + np.repeat(low - first, sizes)
        wanted = ends_a[near]
        met = ends_b[np.searchsorted(ends_b, wanted)] == wanted
        away = near - np.repeat(mid, sizes)
        rank = np.where(met, 2 * np.abs(away) + (away < 0), np.iinfo(np.int64).max)
        best = np.minimum.reduceat(rank, first)
        found = best < np.iinfo(np.int64).max
        leaf = ~found & (sizes == a_hi - a_lo + 1)
        out.append(rest[:, leaf][[1, 3]])
        cut_a = mid + np.where(best & 1, -(best >> 1), best >> 1) + 1
        cut_a[~found] = rest[1][~found]
        cut_b = np.searchsorted(ends_b, ends_a[cut_a - 1]) + 1
        kept = ~leaf
        parts = np.where(found, 2, 1)[kept]
        left = rest[:, kept].copy()
        left[1], left[3] = cut_a[kept], cut_b[kept]
        nxt = np.repeat(left, parts, axis=1)
        second = np.cumsum(parts)[parts == 2] - 1
        halves = rest[:, kept][:, parts == 2]
        nxt[0, second], nxt[2, second] = left[1, parts == 2], left[3, parts == 2]
        nxt[1, second], nxt[3, second] = halves[1], halves[3]
        # nothing near the middle: look four times as far
        wide = np.repeat(np.where(found, 0, 4 * wide + 2)[kept], parts)
        rest = nxt
    ends = np.concatenate(out, axis=1) if out else np.zeros((2, 0), dtype=np.int64)
    ends = ends[:, np.argsort(ends[0], kind="stable")] - 1
    return ends[0], ends[1]


class Pair:
    """Both vocabularies: ids, and the bytes of each token."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.bytes_b.append(b"")
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # what follows an id in the text of the groups: inside a part, at its end
        self.text = [f"{i}{x}" for i in range(len(self.bytes_a)) for x in ",|"]
        self.text += [f"{i}{x}" for i in range(len(self.bytes_b)) for x in ",;"]
        self.from_b = 2 * len(self.bytes_a)

        # no piece of B goes on after a blank or a line's end, so both end a token before either
        joints = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.cuts_at_blanks = not any(re.search("[^▁]▁|\n", x) for x in joints)
        self.lead = self.b.piece_to_id("▁")
        self.cuts_before_stops = not any(re.search("[A-Za-z][.,]", x) for x in joints)
        self.stops = (
            [x.ids for x in self.a.encode_batch_fast([".", ","], add_special_tokens=False)],
            [[self.b.piece_to_id(x)] for x in ".,"],
        )

    def ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for each text, led by a blank unless a line's end comes first; none where
        either's tokens are not its bytes."""
        return self._same([" " + x if x else "" for x in texts], self.b.encode(texts, num_threads=1))

    def word_ids(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """As ``ids``, of words: those with a line's end before them have no blank."""
        found = self.b.encode(words, num_threads=1)
        found = [x[1:] if w[0] == "\n" and x[:1] == [self.lead] else x for w, x in zip(words, found, strict=True)]
        return self._same([w if w[0] == "\n" else " " + w for w in words], found)

    def _ids_a(self, led: list[str]) -> list[list[int]]:
        """Ids of A. No rule cuts or changes a blank and Latin letters, so the merges apply to them as
        they are."""
        merged, rest, out = self.a.model.tokenize, [], []
        for i, text in enumerate(led):
            if text[:1] == " " and is_latin(text[1:]):
                out.append([x.id for x in merged(byte_letters(text))])
            else:
                rest.append(i)
                out.append([])
        for i, x in zip(rest, self.a.encode_batch_fast([led[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = x.ids
        return out

    def _same(self, led: list[str], found_b: list[list[int]]) -> tuple[list[list[int]], list[list[int]]]:
        found_a, tables = self._ids_a(led), (self.bytes_a, self.bytes_b)
        for at in range(0, len(led), COMPARED):
            some = range(at, min(at + COMPARED, len(led)))
            # a byte that no text has shows where each of them ends
            whole = b"\xff".join([led[i].encode() for i in some])
            if all(
                b"\xff".join([b"".join(map(table.__getitem__, ids[i])) for i in some]) == whole
                for table, ids in zip(tables, (found_a, found_b))
            ):
                continue
            for i in some:
                whole = led[i].encode()
                for table, ids in zip(tables, (found_a[i], found_b[i])):
                    if b"".join(map(table.__getitem__, ids)) != whole:
                        found_a[i], found_b[i] = [], []
        return found_a, found_b


def _byte_letters() -> dict[str, int]:
    """Byte of each letter that a byte-level vocabulary writes: printable ones stand for themselves,
    the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def pair(path_a: str, path_b: str) -> Pair:
    """The worker's own pair of vocabularies."""
    return held(f"{path_a}\0{path_b}", lambda: Pair(path_a, path_b))


class Divided(NamedTuple):
    """Texts one after the other: their ids, and the last tokens of all groups in either run. Text
    ``i`` ends before A token ``to_a[i]``, B token ``to_b[i]`` and group ``groups[i]``."""

    a: np.ndarray
    b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    to_a: np.ndarray
    to_b: np.ndarray
    groups: np.ndarray


def divided(both: Pair, ids_a: list[list[int]], ids_b: list[list[int]]) -> Divided:
    """The groups of texts, each given by its ids of A and of B (of both, or of neither)."""
    n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
    a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64) for ids in (ids_a, ids_b))
    to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
    ends_a, ends_b = np.cumsum(both.size_a[a]), np.cumsum(both.size_b[b])
    full = n_a > 0
    last_a, last_b = shared_cuts(
        ends_a, ends_b, (to_a - n_a)[full], to_a[full], (to_b - n_b)[full], to_b[full]
    )
    return Divided(a, b, last_a, last_b, to_a, to_b, np.searchsorted(last_a, to_a))


def groups_texts(both: Pair, x: Divided) -> list[str]:
    """Of each text ``a1,a2|b1;a3|b2,b3``: decimal ids, group by group."""
    return [said[:-1] for said in _ended_groups(both, x)]


def _ended_groups(both: Pair, x: Divided) -> list[str]:
    """As ``groups_texts``, with a ``;`` after each group."""
    per_a, per_b = np.diff(x.last_a, prepend=-1), np.diff(x.last_b, prepend=-1)
    order = np.empty(len(x.a) + len(x.b), dtype=np.int64)
    marked = 2 * x.a
    marked[x.last_a] += 1
    order[np.arange(len(x.a)) + np.repeat(x.last_b + 1 - per_b, per_a)] = marked
    marked = both.from_b + 2 * x.b
    marked[x.last_b] += 1
    order[np.arange(len(x.b)) + np.repeat(x.last_a + 1, per_b)] = marked
    said, ends = list(map(both.text.__getitem__, order.tolist())), (x.to_a + x.to_b).tolist()
    return ["".join(said[start:stop]) for start, stop in zip([0, *ends], ends)]


class _Words(NamedTuple):
    """Words in order, or texts: text of the groups, each with its end, numbers of the links, and
    tokens of either."""

    said: list[str]
    links: list[bytes]
    n_a: list[int]
    n_b: list[int]


class _Task:
    """What a task keeps: words with their groups and links, and the numbers of pairs.

    Both vocabularies end a token before a blank and before a line's end, so those are shared cuts
    in any text, and what lies between two of them is divided once for all its occurrences.
    """

    def __init__(self, both: Pair, number: int):
        self.both, self.number = both, number
        self.pairs = np.zeros(0, dtype=np.int64)  # sorted
        self.codes = np.zeros(0, dtype=np.int64)
        self.times = np.zeros(0, dtype=np.int64)  # by number
        self._forget()

    def begin(self, number: int) -> None:
        """Another dictionary, which goes on with the same numbers."""
        self.number = number
        self.times[:] = 0

    def _forget(self) -> None:
        # words, and of each what ``_Words`` holds; null texts where a word is not divided alone
        self.words, self.said = pa.array([], pa.large_string()), pa.array([], pa.large_string())
        self.links = pa.array([], pa.large_binary())
        self.n_a, self.n_b = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _code(self, pairs: np.ndarray) -> np.ndarray:
        found, inverse = np.unique(pairs, return_inverse=True)
        place = np.searchsorted(self.pairs, found)
        known = place < len(self.pairs)
        known[known] = self.pairs[place[known]] == found[known]
        codes = np.empty(len(found), dtype=np.int64)
        codes[known] = self.codes[place[known]]
        codes[~known] = len(self.times) + np.arange((~known).sum())
        self.times = np.concatenate([self.times, np.zeros((~known).sum(), dtype=np.int64)])
        self.pairs = np.insert(self.pairs, place[~known], found[~known])
        self.codes = np.insert(self.codes, place[~known], codes[~known])
        return codes[inverse]

    def _keep(self, ids_a: list, ids_b: list) -> _Words:
        found = divided(self.both, ids_a, ids_b)
        codes = self._code((found.a[found.last_a] << 32) | found.b[found.last_b])
        codes, ends = codes.astype("<u4").tobytes(), (4 * found.groups).tolist()
        links = [codes[at:stop] for at, stop in zip([0, *ends], ends)]
        return _Words(_ended_groups(self.both, found), links, [*map(len, ids_a)], [*map(len, ids_b)])

    def _learn(self, new: pa.Array) -> None:
        words, bare, ended = new.to_pylist(), [], []
        for word in words:
            # a full stop or comma after a letter, at a word's end, is a group of its own like a word
            if self.both.cuts_before_stops and word[-1:] in (".", ",") and word[-2:-1] in _LETTERS:
                if _certain(word):
                    ended.append(word)
            elif word.isalpha() or _certain(word):
                bare.append(word)
        place = {w: i for i, w in enumerate(bare)}
        for word in ended:
            if word[:-1] not in place:
                place[word[:-1]] = len(bare)
                bare.append(word[:-1])
        found = self._keep(*self.both.word_ids(bare))
        stops = dict(zip(".,", zip(*self._keep(*self.both.stops), strict=True), strict=True)) if ended else {}
        for word in ended:
            i = place[word[:-1]]
            said, links, n_a, n_b = stops[word[-1]]
            if not found.n_a[i]:
                continue
            place[word] = len(found.said)
            found.said.append(found.said[i] + said)
            found.links.append(found.links[i] + links)
            found.n_a.append(found.n_a[i] + n_a)
            found.n_b.append(found.n_b[i] + n_b)
        at = np.array([place.get(w, -1) for w in words], dtype=np.int64)
        n_a, n_b = (np.array([*x, 0], dtype=np.int64)[at] for x in (found.n_a, found.n_b))
        at = pa.array(at, mask=n_a == 0)
        said = pa.array(found.said, pa.large_string()).take(at)
        links = pa.array(found.links, pa.large_binary()).take(at)
        self.words, self.said = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.said, said])
        self.links = pa.concat_arrays([self.links, links])
        self.n_a, self.n_b = np.concatenate([self.n_a, n_a]), np.concatenate([self.n_b, n_b])

    def run(self, ids: list, texts: list[str]) -> dict:
        """The row of a run of texts."""
        if len(self.words) > REMEMBERED:
            self._forget()
        cut = pa.array([x.replace("\n", " \n") if x and self.both.cuts_at_blanks else "" for x in texts], pa.large_string())
        cut = pc.split_pattern(cut, " ")
        words = cut.values.dictionary_encode()
        place, new = numbered(words.dictionary, self.words)
        if len(new):
            self._learn(new)
        place = place.take(words.indices)
        starts = cut.offsets.to_numpy()
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[starts]).tolist()
        said, links = self.said.take(place), self.links.take(place)
        n_a, n_b = (sums(x[place.to_numpy()]) for x in (self.n_a, self.n_b))
        lost = sums(said.is_null().to_numpy(zero_copy_only=False))
        whole = [i for i, (text, n) in enumerate(zip(texts, lost, strict=True)) if text and n]
        hashes, codes = [], []
        for values, out, of in (said, hashes, _hash), (links, codes, bytes):
            ends, data = parts(values)
            at = ends[starts].tolist()
            out += [of(data[a:b]) for a, b in zip(at, at[1:])]
        if whole:
            found = self._keep(*self.both.ids([texts[i] for i in whole]))
            for i, groups, codes[i], n_a[i], n_b[i] in zip(whole, *found, strict=True):
                hashes[i] = _hash(groups.encode())
        n_groups = [len(x) // 4 for x in codes]
        codes = b"".join(codes)
        self.times += np.bincount(np.frombuffer(codes, dtype="<u4"), minlength=len(self.times))
        return {
            "dictionary": self.number,
            "doc_id": ids,
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "groups_sha256": hashes,
            "codes": _planes(codes),
        }

    def row(self) -> pa.RecordBatch:
        by_number = np.argsort(self.codes)
        row = {"dictionary": self.number, "pairs": self.pairs[by_number], "times": self.times}
        return _rows([row])


def _certain(word: str) -> bool:
    """Whether a word's tokens do not depend on what stands beside it."""
    inner = word[1:] if word[:1] == "\n" else word
    return bool(inner) and not (inner[0].isspace() or inner[-1].isspace())


def _hash(groups: bytes | memoryview) -> str:
    """Hash of the groups' text, which has an end after each; nothing where there are none."""
    return hashlib.sha256(groups[:-1]).hexdigest() if len(groups) else ""


def _rows(rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([r.get(f.name) for r in rows], type=f.type) for f in _LINKED]
    return pa.RecordBatch.from_arrays(columns, schema=_LINKED)


def _planes(numbers: bytes) -> bytes:
    """32-bit numbers, their lowest bytes first, then the next, as far as any number has more."""
    most = int(np.frombuffer(numbers, dtype="<u4").max(initial=0))
    wide = (most.bit_length() + 7) // 8 or 1
    return np.frombuffer(numbers, dtype=np.uint8).reshape(-1, 4)[:, :wide].T.tobytes()


def _numbers(planes: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``_planes``."""
    out = np.zeros((n, 4), dtype=np.uint8)
    if n:
        out[:, : len(planes) // n] = np.frombuffer(planes, dtype=np.uint8).reshape(-1, n).T
    return out.view("<u4").ravel()


def linked_runs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds: a run of texts with its links, and a dictionary of links."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        base, used = TaskContext.get().partitionId() << 32, 0
        own = _Task(both, base)
        for part in parts:
            ids, at = part.column(0).to_pylist(), 0
            for texts in batches([x or "" for x in part.column(1).to_pylist()], RUN):
                yield _rows([own.run(ids[at : at + len(texts)], texts)])
                at += len(texts)
                if own.times.sum() >= LINKS or len(own.times) >= DICTIONARY:
                    yield own.row()
                    used += 1
                    if len(own.times) >= DICTIONARY:
                        own = _Task(both, base + used)
                    else:
                        own.begin(base + used)
        yield own.row()

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return own.mapInArrow(work, _LINKED_SQL)


def pair_counts(runs: DataFrame) -> DataFrame:
    """``pair, k, best``: links of each pair over all texts, and whether its B id has no better."""
    entries = runs.where("pairs is not null").select(
        F.explode(F.arrays_zip("pairs", "times")).alias("x")
    )
    counts = entries.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("k"))
    own = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    return counts.withColumn("best", F.col("k") == F.max("k").over(own))


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """A row for each document, as ``RESULT``: its tokens, groups and links, and how its links rank.

    ``n_best`` counts links whose pair has its B id's highest count of all pairs; ``count_sum`` adds
    the counts of its links.
    """
    path_a = path_a or tokenizer_path("byte_bpe_50k.json")
    path_b = path_b or tokenizer_path("piece_bpe_32k.model")
    runs = stored(linked_runs(docs, path_a, path_b), "linked-runs")
    entries = runs.where("pairs is not null").select("dictionary", F.posexplode("pairs").alias("code", "pair"))
    known = entries.join(pair_counts(runs).hint("merge"), "pair")
    answers = known.select(F.col("dictionary").alias("own"), "code", "k", "best")
    parts = runs.where("pairs is null").drop("pairs", "times")
    return answers.groupBy("own").cogroup(parts.groupBy("dictionary")).applyInArrow(ranked, RESULT)


def ranked(answers: pa.Table, runs: pa.Table) -> pa.Table:
    """The documents of the runs of one dictionary, as ``RESULT``; ``answers`` has its ``code, k, best``."""
    held("cross_align.ranked", dict)  # vocabularies are of no use here
    at = answers["code"].to_numpy()
    figures = np.zeros((2, at.max(initial=-1) + 1), dtype=np.int64)
    figures[:, at] = answers["best"].to_numpy(), answers["k"].to_numpy()
    fields = [x.split() for x in RESULT.split(", ")]
    schema = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in fields])
    out = []
    for i in range(runs.num_rows):
        row = {c: runs[c][i] for c in runs.column_names}
        groups = row["n_groups"].values.to_numpy()
        stop = np.cumsum(groups)
        codes = _numbers(row["codes"].as_py(), int(groups.sum()))
        sums = []
        for figure in figures:
            run = np.zeros(len(codes) + 1, dtype=np.int64)
            np.cumsum(figure[codes], out=run[1:])
            sums.append(run[stop] - run[stop - groups])
        arrays = [row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")]
        arrays += [pa.array(x) for x in sums] + [row["groups_sha256"].values]
        out.append(pa.RecordBatch.from_arrays(arrays, schema=schema))
    return pa.Table.from_batches(out, schema)
