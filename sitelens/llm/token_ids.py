"""Token ids of whole texts by a tokenizer file, remembered word by word.

Both vocabularies cut a text at white space before anything else happens, so ids of a text are the
ids of its blank-separated words in a row. A worker keeps the ids of words it has met, and asks the
``tokenizers`` library only for new ones. A text where the cut is not certain (runs of white space,
strings that look like special tokens) goes to the library whole, so that ids are the library's in
every case.
"""

import os
import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sitelens.llm.common import held

#: Words that a worker remembers; then it starts anew. Bounds memory only.
REMEMBERED = 1_000_000

_LATIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+").fullmatch
# signs but for the apostrophe, which can begin a suffix
_SIGNS = string.punctuation.replace("'", "")
# byte-level vocabularies show a byte without a printable sign as one from U+0100 on, in order
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}


def is_latin(word: str) -> bool:
    """Whether a word is of Latin letters alone, of which no rule cuts a run."""
    return word.isascii() and word.isalpha() or _LATIN(word) is not None


def byte_letters(word: str) -> str:
    """A word as byte-level vocabularies write it."""
    return word.encode().decode("latin-1").translate(_SHOWN)


class WordEncoder:
    """``ids(texts)``: of each text its little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # a byte-level vocabulary keeps a word's leading blank, the other drops white space
        self.keeps_blanks = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
        self._forget()

    def _forget(self) -> None:
        # words, and the ids of each; null where a word has none of its own
        self.words, self.found = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _marked(self, text: str) -> str:
        """``text`` with a blank before each word that is remembered but the first one, which is marked
        where blanks are kept; there a line's first word starts with the line's end.
        """
        if not self.keeps_blanks:
            return text.replace("\n", " ")
        return "\0" + text.replace("\n", " \n")

    def _certain(self, word: str) -> bool:
        """Whether a word's ids do not depend on what stands beside it."""
        if not self.keeps_blanks:
            return "<|" not in word
        inner = word[1:] if word[:1] in ("\n", "\0") else word
        return bool(inner) and not (
            inner[0].isspace() or inner[-1].isspace() or "\0" in inner or "<|" in inner
        )

    def _learn(self, words: list[str]) -> list[bytes | None]:
        """The ids of new words; None where a word has none of its own."""
        # signs after letters are a piece of their own for either vocabulary, whatever the letters
        own, bare, ended, rest = {}, [], {}, []
        for word in words:
            if is_latin(word):
                bare.append(word)
            elif not self._certain(word):
                own[word] = None
            elif not word:
                own[word] = b""
            else:
                letters = word.rstrip(_SIGNS)
                if is_latin(letters):
                    ended[word] = letters, word[len(letters) :]
                else:
                    rest.append(word)
        more = [*{x for x, _ in ended.values()}.difference(bare)]
        place = pc.index_in(pa.array(more, pa.large_string()), self.words)
        own.update(zip(more, self.found.take(place).to_pylist(), strict=True))
        bare += [x for x in more if own[x] is None]
        own.update(zip(bare, self._letters(bare), strict=True))
        signs = [*{x for _, x in ended.values()}]
        given = [w.lstrip("\0") if w[0] in "\0\n" else " " + w for w in rest] if self.keeps_blanks else rest
        found = self._encode([*given, *signs])
        own.update(zip(rest, found))
        after = dict(zip(signs, found[len(rest) :], strict=True))
        for word, (letters, last) in ended.items():
            own[word] = own[letters] + after[last]
        return [own[x] for x in words]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters, of which no rule of either vocabulary cuts or changes any
        but for their case; so the merges apply to a word as it is.
        """
        merged, ids, ends = self.tokenizer.model.tokenize, array("I"), [0]
        for word in words:
            word = " " + word if self.keeps_blanks else word.lower()
            if self.keeps_blanks or not word.isascii():
                word = byte_letters(word)
            ids.extend([x.id for x in merged(word)])
            ends.append(4 * len(ids))
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > REMEMBERED:
            self._forget()
        cut = pc.split_pattern(pa.array(map(self._marked, texts), pa.large_string()), " ")
        words = cut.values.dictionary_encode()
        place, new = numbered(words.dictionary, self.words)
        if len(new):
            learned = pa.array(self._learn(new.to_pylist()), pa.large_binary())
            every = pa.concat_arrays([self.found, learned])
            # most new words never come again; those that do within the texts are worth their memory
            again = np.bincount(words.indices, minlength=len(place))[place.to_numpy() >= len(self.words)] > 1
            self.words = pa.concat_arrays([self.words, new.filter(again)])
            self.found = pa.concat_arrays([self.found, learned.filter(again)])
        # the ids of all words one after the other
        found = (every if len(new) else self.found).take(place).take(words.indices)
        ends, data = parts(found)
        starts = cut.offsets.to_numpy()
        at = ends[starts].tolist()
        out = [bytes(data[a:b]) for a, b in zip(at, at[1:])]
        if found.null_count:
            null = np.concatenate([[0], np.cumsum(found.is_null().to_numpy(zero_copy_only=False))])
            whole = np.flatnonzero(np.diff(null[starts])).tolist()
            for i, ids in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
                out[i] = ids
        return out


def numbered(words: pa.Array, known: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The place of each of ``words`` among ``known`` and then the new ones, and the new ones."""
    place = pc.index_in(words, known)
    new = words.filter(place.is_null())
    if len(new):
        places = place.to_numpy(zero_copy_only=False).copy()
        places[np.isnan(places)] = len(known) + np.arange(len(new))
        place = pa.array(places.astype("int64"))
    return place, new


def parts(values: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Where each of ``values`` (large binary or text, not sliced) starts, the end, and all bytes."""
    _, ends, data = values.buffers()
    return np.frombuffer(ends, "int64", len(values) + 1), memoryview(data or b"")


def encoder(path: str) -> WordEncoder:
    """The worker's own encoder for a tokenizer file."""
    return held(path, lambda: WordEncoder(path))


def batches(texts: list[str], chars: int = 4_000_000):
    """Runs of texts of about ``chars`` characters, so that a task's memory stays bounded."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def tokenizer_path(name: str) -> str:
    """Where the public tokenizers' file ``name`` lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
