import base64
import random

import numpy as np
import pytest
import tiktoken
from helpers import DOCS, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from stagelight.llm import bpe, token_output
from stagelight.llm.queries import op7_token_output
from stagelight.llm.token_output import Permutation, Shards

RANK_FILE, PATTERN = bpe.public_ranks()
END = 50_256


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**64 - 1))
def test_permutation_is_a_bijection(size, key):
    order = Permutation(size, key)
    slots = order.slots(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    assert np.array_equal(order.sequences(slots), np.arange(size))


def test_keys_and_size_matter():
    slots = [Permutation(10_000, key).slots(np.arange(10_000)) for key in (1, 2)]
    assert np.mean(slots[0] == slots[1]) < 0.01 and abs(np.corrcoef(slots[0], np.arange(10_000))[0, 1]) < 0.05


def library():
    with open(RANK_FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def stored_docs(spark, rng, tmp_path, texts=None):
    texts = texts or [prose(rng, rng.randrange(0, 300)) or None for _ in range(60)] + ["", None, "x y" * 20_000, "same", "same"]
    documents(spark, texts, clashing=("slot", "shard", "ids")).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return spark.read.parquet(str(tmp_path / "documents.parquet")), texts


@pytest.mark.parametrize("length, shard_bytes", [(16, 1 << 12), (512, 1 << 23), (7, 1)])
def test_shards_hold_the_stream_in_the_keyed_order(spark, rng, tmp_path, length, shard_bytes):
    docs, texts = stored_docs(spark, rng, tmp_path, None if length > 7 else ["a b c", "d e f g h i j k", "l"])
    path = str(tmp_path / "out")
    shards = token_output.materialised(docs, path, RANK_FILE, PATTERN, END, key=9, length=length, shard_bytes=shard_bytes)
    assert token_output.opened(spark, path) == shards
    rows = sorted(token_output.read(spark, shards).collect())
    assert [r["slot"] for r in rows] == list(range(shards.sequences))
    assert all(r["shard"] == r["slot"] // shards.per_shard for r in rows)
    assert all(r["byte_offset"] == r["slot"] % shards.per_shard * shards.stride for r in rows)
    order = np.argsort(shards.order.sequences(np.arange(shards.sequences)))
    stream = np.concatenate([np.frombuffer(rows[k]["ids"], dtype="<u2") for k in order])
    assert set(stream[shards.tokens :].tolist()) <= {END}
    encoder = library()
    expected = sorted(tuple(encoder.encode_ordinary(t)) for t in texts if t)
    ends = np.flatnonzero(stream[: shards.tokens] == END)
    parts = np.split(stream[: shards.tokens], ends + 1)[:-1]
    assert sorted(tuple(p[:-1].tolist()) for p in parts) == expected


@pytest.mark.parametrize("held, rounds", [(1 << 24, 1), (1 << 14, 9)])
def test_a_shard_gets_the_sequences_of_many_pieces_in_one_row(rng, held, rounds):
    stream = np.array([rng.randrange(1 << 16) for _ in range(9 * 2048)], dtype="<u2")
    shards = Shards("", sequences=-(-len(stream) // 7), length=7, width=2, per_shard=50, tokens=len(stream), key=3)
    cuts = np.sort([0, *rng.sample(range(1, len(stream)), 200), len(stream)])
    pieces = [(a, stream[a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
    rng.shuffle(pieces)
    rows = list(token_output.dealt(iter(pieces), shards, held))
    assert shards.count <= len(rows) <= shards.count * rounds  # with a piece alone about ten times as many
    filled = np.full((shards.sequences, 7), END, dtype="<u2")
    for shard, cells, ids in rows:
        assert set(cells[:, 0] // 50) == {shard} and cells[:, 2].sum() == len(ids)
        for (slot, place, count), end in zip(cells.tolist(), np.cumsum(cells[:, 2]).tolist(), strict=True):
            filled[slot, place : place + count] = ids[end - count : end]
    order = np.argsort(shards.order.sequences(np.arange(shards.sequences)))
    assert np.array_equal(filled[order].ravel()[: len(stream)], stream)
    assert list(token_output.dealt(iter([]), shards)) == []


def test_resume_reads_only_what_is_left(spark, rng, tmp_path):
    docs, _ = stored_docs(spark, rng, tmp_path)
    shards = token_output.materialised(docs, str(tmp_path / "out"), RANK_FILE, PATTERN, END, length=16, shard_bytes=1 << 12)
    whole = sorted(token_output.read(spark, shards).collect())
    middle = shards.per_shard + 5
    assert sorted(token_output.read(spark, shards, middle).collect()) == whole[middle:]
    assert sorted(token_output.read(spark, shards, 3, middle).collect()) == whole[3:middle]
    assert token_output.read(spark, shards, shards.sequences).collect() == []


def test_rows_that_change_when_read_again(spark, rng, tmp_path):
    docs, _ = stored_docs(spark, rng, tmp_path)
    changing = docs.selectExpr("doc_id", "if(rand() < 0.5, text, uuid()) as text")
    shards = token_output.materialised(changing, str(tmp_path / "out"), RANK_FILE, PATTERN, END, length=16)
    assert token_output.read(spark, shards).count() == shards.sequences


def test_empty_tables_and_wide_ids(spark, rng, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    none = token_output.materialised(empty, str(tmp_path / "none"), RANK_FILE, PATTERN, END)
    assert none.sequences == none.count == 0 and token_output.read(spark, none).collect() == []
    docs, _ = stored_docs(spark, rng, tmp_path)
    wide = token_output.materialised(docs, str(tmp_path / "wide"), RANK_FILE, PATTERN, 70_000)
    assert wide.width == 4 and token_output.read(spark, wide).count() == wide.sequences


def test_query(spark, rng, tmp_path):
    stored_docs(spark, rng, tmp_path)
    rows = op7_token_output(spark, str(tmp_path)).collect()
    assert sorted(r["sequence"] for r in rows) == sorted(r["slot"] for r in rows) == list(range(len(rows)))


@pytest.mark.parametrize("sequences", [2, 2**22 + 2, 2**31 + 2])
def test_query_counts_ids_beyond_32_bits(spark, tmp_path, monkeypatch, sequences):
    shards = Shards(str(tmp_path), sequences, length=512, width=2, per_shard=8184, tokens=sequences * 512 - 7, key=1)
    ends = [0, sequences - 1]
    rows = spark.createDataFrame([(k, k // 8184, 0, k, b"") for k in ends], "slot long, shard int, byte_offset long, sequence long, ids binary")
    monkeypatch.setattr(token_output, "materialised", lambda *args, **named: shards)
    monkeypatch.setattr(token_output, "read", lambda *args: rows)
    stored_docs(spark, random.Random(1), tmp_path, ["a"])
    found = op7_token_output(spark, str(tmp_path))
    assert dict(found.dtypes)["n_tokens"] == "int"
    assert {r["sequence"]: r["n_tokens"] for r in found.collect()} == {0: 512, sequences - 1: 505}


def test_the_mark_is_searched_for_and_read_as_text(rng):
    with open(RANK_FILE, "rb") as file:
        own = token_output.encoding(file.read(), PATTERN)
    assert own.special_tokens_set == {token_output.MARK}  # for none, the library stops at every character
    for text in ("", token_output.MARK, f"{prose(rng, 30)}{token_output.MARK * 2} {prose(rng, 3)}", "<|mark|>\0", "\0\0\0"):
        assert own.encode_to_numpy(text, disallowed_special=()).tolist() == library().encode_ordinary(text)
