import base64
import hashlib
import tracemalloc

import numpy as np
import pytest
import tiktoken
from helpers import DOCS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from stagelight.llm import bpe

RANK_FILE, PATTERN = bpe.public_ranks()


@pytest.fixture(scope="module")
def library():
    with open(RANK_FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(RANK_FILE, "rb") as file:
        return bpe.Encoder(file.read(), PATTERN)


def ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], dtype="<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(own, library, text):
    assert ids(own, text) == library.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abeinost hrT'é\n0", max_size=200))
def test_word_like_text_as_the_library(own, library, text):
    assert ids(own, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 3000, "word " * 2000, "é" * 1500, "<|endoftext|>", "\U0001f600" * 300])
def test_long_pieces_and_ties(own, library, text):
    assert ids(own, text) == library.encode_ordinary(text)


def test_merges_do_not_depend_on_what_is_merged_beside(own):
    pieces = [p.encode() for p in ("reading", " writing", "xq", "antidisestablishmentarianism", "z", "aaaa")]
    together = bpe.merged(pieces, own.ranks)
    assert together == [bpe.merged([p], own.ranks)[0] for p in pieces]
    assert together == bpe.merged(pieces, own.ranks, cells=1)


def test_memory_of_pieces_is_bounded(library):
    with open(RANK_FILE, "rb") as file:
        small = bpe.Encoder(file.read(), PATTERN, remember=5)
    for text in ("one two three", "four five six seven", "one two", "eight nine ten eleven twelve thirteen"):
        assert ids(small, text) == library.encode_ordinary(text)


def test_merging_many_pieces_takes_little_memory_at_once(own):
    random = np.random.default_rng(5)
    pieces = [bytes(row) for row in random.integers(97, 123, (60_000, 8), dtype=np.uint8)]
    tracemalloc.start()
    found = bpe.merged(pieces, own.ranks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[:50] == [bpe.merged([p], own.ranks)[0] for p in pieces[:50]]
    assert peak < 32 << 20
    assert bpe.Encoder.__init__.__defaults__ == (200_000,)  # about 40 MB a worker


def test_round_trip_and_digests(spark, library):
    texts = ["Hello world", "", None, "  two\n\nlines é ", "x" * 70_000, "Hello world"]
    docs = documents(spark, texts, ids=[0, 1, 2, 3, 4, 4], clashing=("ids", "decoded", "n_tokens"))
    rows = bpe.encoded(docs, RANK_FILE, PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in rows) == sorted((t or "").encode() for t in texts)
    found = sorted(map(tuple, bpe.digests(docs, RANK_FILE, PATTERN).collect()))
    expected = []
    for i, text in zip([0, 1, 2, 3, 4, 4], texts, strict=True):
        own = np.array(library.encode_ordinary(text or ""), dtype="<u4")
        digests = (hashlib.sha256(x).hexdigest() for x in (own.tobytes(), (text or "").encode()))
        expected.append((i, len(own), *digests))
    assert found == sorted(expected)


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], DOCS), RANK_FILE, PATTERN).collect() == []
