import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitelens.llm.simple8b import Chunk, token_files, write_chunk
from sitelens.llm.token_ids import WordEncoder, tokenizer_path

IDS = st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, (1 << 64) - 1))


@given(st.lists(IDS, max_size=400))
@settings(max_examples=80, deadline=None)
def test_round_trip(ids):
    ids = np.array(ids, "uint64")
    chunk = Chunk(write_chunk([5, None], [len(ids), 0], ids))
    assert chunk.numbers == [5, None] and list(chunk.lengths) == [len(ids), 0]
    assert (chunk.ids() == ids).all() and len(chunk.ids()) == len(ids)
    for b in range(len(chunk.first)):
        assert (chunk.block_ids(b) == ids[128 * b : 128 * (b + 1)]).all()


def test_small_ids_share_words():
    assert len(Chunk(write_chunk([1], [1280], np.ones(1280, "uint64"))).words) == 30


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        Chunk(bytes(64))


def test_files_hold_every_document_in_order(frame, prose):
    rows = [(i, prose(i, 3 + i % 300)) for i in range(90)][::-1]
    rows += [(200, None), (201, ""), (None, prose(1)), (5, prose(5, 8)), (5, prose(5, 8)), (999, "x" * 9000)]
    got = token_files(frame(*rows)).toPandas()
    known = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = []
    for i, text in rows:
        ids = np.array([*known.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((-1 if i is None else i, len(ids), zlib.crc32(ids.tobytes())))
    got = got.fillna(-1).astype("int64").sort_values(["start"], ignore_index=True)
    assert sorted(got[["doc_id", "n_tokens", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    assert got["doc_id"].is_monotonic_increasing
    assert list(got["start"]) == list(got["n_tokens"].cumsum() - got["n_tokens"])


def test_empty(frame):
    assert token_files(frame()).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_remembered_words_have_the_ids_of_the_library(name):
    encoder = WordEncoder(tokenizer_path(name))
    letters = st.text("aBeEsStTyéÉßñÿÀ'×÷İſΣ́", max_size=7)
    signs = st.text(".,!$#*'’<|_-9 \n", max_size=4)

    @given(st.lists(st.tuples(letters, signs), max_size=12))
    @settings(max_examples=300, deadline=None)
    def check(words):
        text = " ".join(a + b for a, b in words)
        (got,) = encoder.ids([text])
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert list(np.frombuffer(got, "<u4")) == want

    check()


def test_remembered_words_are_small():
    """A word remembered is bytes in arrays, not objects."""
    known, before = WordEncoder(tokenizer_path("word_bpe_49k.json")), pa.total_allocated_bytes()
    words = [f"{a}{b}{c}" for a in "aeiou" for b in range(100, 150) for c in ("st", "re", "ing", "tion")]
    tracemalloc.start()
    ids = known.ids([" ".join(words)])
    held = tracemalloc.get_traced_memory()[0] - sum(map(len, ids)) + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 100 * len(words)
    assert ids == [b"".join(known.ids([w])[0] for w in words)]
