import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from helpers import DOCS, by_id, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stagelight.llm import token_alignment as ta

JSON, MODEL = ta.public_files()


@pytest.fixture(scope="module")
def own():
    with open(JSON) as text, open(MODEL, "rb") as model:
        return ta.Tokenizers(text.read(), model.read())


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def whole(own, library, text):
    """Ids of the whole text by the libraries, and its groups by a set of ends; nothing where bytes differ."""
    if not text:
        return [], [], []
    ids_a = library[0].encode(" " + text, add_special_tokens=False).ids
    ids_b = library[1].encode(text)
    bytes_a, bytes_b = [own.bytes_a[x] for x in ids_a], [own.bytes_b[x] for x in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return [], [], []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    groups, start = [], 0
    for end in common:
        groups.append(
            (
                [x for x, e in zip(ids_a, ends_a) if start < e <= end],
                [x for x, e in zip(ids_b, ends_b) if start < e <= end],
            )
        )
        start = end
    return ids_a, ids_b, groups


def found(own, text, window=1 << 20):
    aligner = ta.Aligner(ta.Units(own), window)
    groups = []
    for _, ids_a, ids_b, cut_a, cut_b in aligner.parts([text]):
        starts = zip([0, *cut_a], [0, *cut_b])
        groups += [
            (ids_a[i:x].tolist(), ids_b[j:y].tolist()) for (i, j), x, y in zip(starts, cut_a, cut_b)
        ]
    return groups


ODD = " \t\n\r\x0b\x0c\x1c\x85  ▁　\x00ab1é中.,'\U0001f600"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=40) | st.text(max_size=40), st.sampled_from([4, 1 << 20]))
def test_any_text_as_the_libraries_on_the_whole_text(own, library, text, window):
    assert found(own, text, window) == whole(own, library, text)[2]


@pytest.mark.parametrize(
    "text",
    ["a b", "it's  two   spaces \n\n lines ", " " * 300, "a" * 3000, "<|endoftext|> <s> </s> <unk> <0x41>", "x▁y",
     "é" * 500, "   x", "word " * 1000],
)
def test_special_texts(own, library, text):
    assert found(own, text) == whole(own, library, text)[2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=50), st.lists(st.integers(0, 60), max_size=50), st.booleans())
def test_groups_are_the_common_ends(first, second, alike):
    ends_a = sorted({*first, 61})
    ends_b = sorted({*(first if alike else second), 61} - ({30} if alike else set()))
    cut_a, cut_b = ta.group_ends(ends_a, ends_b)
    common = sorted(set(ends_a) & set(ends_b))
    assert [ends_a[i - 1] for i in cut_a] == [ends_b[j - 1] for j in cut_b] == common


def test_long_stretches_one_to_one_are_skipped_whole():
    class Counting(list):
        looks = 0

        def __getitem__(self, at):
            Counting.looks += 1
            return super().__getitem__(at)

    ends = [*range(1, 5000), *range(6000, 9000)]
    cut_a, cut_b = ta.group_ends(Counting(ends), Counting([*range(1, 5000), 5500, *range(6000, 9000)]))
    assert len(cut_a) == len(ends) and cut_b[-1] == len(ends) + 1
    assert Counting.looks < 200


def expected_rows(own, library, texts):
    links = []
    groups = [whole(own, library, t or "")for t in texts]
    for _, _, own_groups in groups:
        links.append([(a[-1], b[-1]) for a, b in own_groups])
    counts = Counter(pair for own_links in links for pair in own_links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for (ids_a, ids_b, own_groups), own_links in zip(groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own_groups)
        rows.append(
            (
                len(ids_a), len(ids_b), len(own_groups), len(own_links),
                sum(counts[p] == best[p[1]] for p in own_links), sum(counts[p] for p in own_links),
                hashlib.sha256(text.encode()).hexdigest() if own_groups else "",
            )
        )
    return rows


def test_summaries_as_brute_force_with_nulls_repeats_and_clashing_columns(spark, own, library):
    texts = ["The quick brown fox, élan vital!", None, "", "x▁y", " ", "tie tie tie", "tie tie tie",
             "<|endoftext|>", "The quick brown fox, élan vital! " * 40, "12345 67 8", "\n\n a\tb "]
    ids = [*range(len(texts) - 2), None, 6]
    docs = documents(spark, texts, ids, clashing=("pairs", "ids_a", "n"))
    rows = ta.summarised(docs, JSON, MODEL)
    assert rows.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(
        repr((i, *row)) for i, row in zip(ids, expected_rows(own, library, texts), strict=True)
    )


def test_arrays_of_a_long_text_go_on_over_windows(spark, own, library, rng):
    text = " ".join("".join(rng.choice("abcdeé1.") for _ in range(rng.randrange(1, 12))) for _ in range(400_000))
    row = by_id(ta.aligned(documents(spark, [text, None]), JSON, MODEL))
    assert row[1]["ids_a"] == [] == row[1]["group_b"]
    assert row[0]["ids_a"] == library[0].encode(" " + text, add_special_tokens=False).ids
    assert row[0]["ids_b"] == library[1].encode(text)
    sizes = [np.cumsum([len(x[i]) for i in ids]) for x, ids in ((own.bytes_a, row[0]["ids_a"]), (own.bytes_b, row[0]["ids_b"]))]
    common = np.intersect1d(*sizes)
    for ends, column in zip(sizes, ("group_a", "group_b")):
        assert ends[np.array(row[0][column]) - 1].tolist() == common.tolist()


def test_linked_pairs_end_alike_so_that_vocabularies_bound_them(spark, own):
    texts = ["Any corpus links few pairs, however long it is."] * 3 + ["naïve café 2024-01-01\tx"]
    rows = ta.aligned(documents(spark, texts), JSON, MODEL).collect()
    for row in rows:
        for i, j in zip(row["group_a"], row["group_b"]):
            a, b = own.bytes_a[row["ids_a"][i - 1]], own.bytes_b[row["ids_b"][j - 1]]
            assert a.endswith(b) or b.endswith(a)
    assert own.most_pairs() < 1_000_000


def test_empty_table(spark):
    assert ta.summarised(spark.createDataFrame([], DOCS), JSON, MODEL).collect() == []
