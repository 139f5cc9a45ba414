import re
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from helpers import lowered

from stagelight.llm import collocations as col

DOCS = "doc_id long, text string, lang string"


def table(spark, rows, clashing=()):
    rows = [(k, text, lang) + ("x",) * len(clashing) for k, (text, lang) in enumerate(rows)]
    return spark.createDataFrame(rows, DOCS + "".join(f", {name} string" for name in clashing)).repartition(5)


def frequencies(rows, longest=4):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for k in range(1, longest + 1):
                counts.update(("und" if lang is None else lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return counts, totals


def expected(rows, least, top=2000, share=80):
    counts, totals = frequencies(rows)
    best = defaultdict(list)
    often = {key: a for key, a in counts.items() if a >= least}
    around = Counter()
    for (lang, words), a in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                around[lang, words[i : i + k]] = max(around[lang, words[i : i + k]], a)
    for (lang, words), a in often.items():
        if len(words) > 1 and not (around[lang, words] and 100 * around[lang, words] >= share * a):
            cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            best[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, found in best.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def prose(rng, count, words):
    marks = ["", "", "", "", ",", ".", "\n", "  ", "\t", " ?! "]
    return " ".join(rng.choice(words) + rng.choice(marks) for _ in range(count))


@pytest.fixture
def rows(rng):
    words = ["The", "the", "of", "cat", "Élan", "élan", "|", "a", "b", " ", "x\x0by", "中文"]
    rows = [(prose(rng, 60, words), rng.choice(["en", "fr", None, "und", ""])) for _ in range(120)]
    return rows + [(None, "en"), ("", "fr"), (" \n,", "en"), ("one", "de")] + [("new york city hall", "en")] * 9


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def test_as_brute_force_with_nulls_repeats_and_clashing_columns(spark, rows):
    docs = table(spark, rows, clashing=("phrase", "a", "piece"))
    assert found(col.mined(docs, least=5)) == expected(rows, 5)


def test_all_frequencies(spark, rows):
    counts, totals = frequencies(rows)
    whole, n = col.phrases(table(spark, rows), least=4)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["a"] for r in whole.collect()} == {
        key: a for key, a in counts.items() if a >= 4
    }
    assert {r["lang"]: r["n"] for r in n.collect()} == {k: v for k, v in totals.items() if v}


def test_small_blocks_full_bit_fields_and_split_prefixes_change_nothing(spark, rows, monkeypatch):
    counts, _ = frequencies(rows)
    monkeypatch.setattr(col, "HEAVY", 5)
    whole, _ = col.phrases(table(spark, rows), least=5, max_bits=1 << 16)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["a"] for r in whole.collect()} == {
        key: a for key, a in counts.items() if a >= 5
    }


def stripes_of(text, length, admitted=None):
    words = col.Words(np.frombuffer(text, dtype=np.uint8))
    return col.block_stripes(words, np.zeros(len(words.codes), dtype=np.int64), np.zeros(1, col.U64), length, admitted)


def test_a_prefix_keys_a_counter_of_next_words():
    _, prefixes, _, nexts, counts = stripes_of(b"to be or not to be, to go\n", 2)
    found = defaultdict(Counter)
    for prefix, names, own in zip(prefixes.to_pylist(), nexts.to_pylist(), counts.to_pylist()):
        found[prefix].update(dict(zip(names, own)))
    assert found == {"to": {"be": 2, "go": 1}, "be": {"or": 1}, "or": {"not": 1}, "not": {"to": 1}}


@pytest.mark.parametrize("text", [b"\n", b" . \n", b"one\n", b"one two\n", b"one.two three\n"])
@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_short_texts(text, length):
    admitted = col.Admitted(np.full(8192, 255, dtype=np.uint8), np.zeros(0, col.U64)) if length > 1 else None
    words = [re.findall(rb"[^ ]+", p) for p in text.strip(b"\n").split(b".")]
    expected = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    _, prefixes, _, nexts, counts = stripes_of(text, length, admitted)
    assert sum(map(sum, counts.to_pylist())) == sum(expected.values())
    assert len(prefixes) == len(nexts)


def test_windows_end_after_breaks():
    text = np.frombuffer(b"ab cd. ef, gh ij kl mn op\nq\n", dtype=np.uint8)
    for limit in (1, 4, 8, 100):
        parts = list(col.windows(text, limit))
        assert b"".join(text[a:b].tobytes() for a, b in parts) == text.tobytes()
        assert all(col.IS_BREAK[text[b - 1]] for _, b in parts)


def test_marks_of_blocks_and_of_merged_phrases_agree():
    text = "the cat sat on the élan mat\n".encode()
    words = col.Words(np.frombuffer(text, dtype=np.uint8))
    langs = pa.array(["fr"] * 6)
    starts = np.arange(6)
    marks = col._phrase_marks(langs, words.phrases(starts, 2))
    sums = col._word_hashes(pa.array(["fr"])) * col.MIX_1
    for place in (0, 1):
        sums = sums + col._placed(words.hashes, place)[words.codes[place : place + 6]]
    assert marks.tolist() == col.mixed(sums).tolist()


def test_stripes_of_one_key_are_added_over_batches(spark):
    rows = [("en", "a", 0, [f"w{k % 7}", "x"], [1, k]) for k in range(3000)] + [("en", "b", s, ["y"], [2]) for s in (0, 1)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        merged = col._merged(spark.createDataFrame(rows, col.STRIPES), 2).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    counts = Counter((r["phrase"], r["a"]) for r in merged)
    sums = Counter(k % 7 for k in range(3000))
    assert counts == Counter(
        [(f"a w{k}", n) for k, n in sums.items()] + [("a x", sum(range(3000)))] + [("b y", 2)] * 2
    )


def test_exact_arithmetic_ties_and_top(spark):
    big = 5_000_000_000_000_000
    rows = [("en", "a", 1, 3 * big), ("en", "b", 1, big), ("en", "c", 1, big + 1), ("en", "a b", 2, big), ("en", "b c", 2, big),
            ("en", "a b c", 3, big * 4 // 5)]
    found = spark.createDataFrame(rows, "lang string, phrase string, words int, a long")
    scores = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in col.scored(found).collect()}
    assert scores["a b"] == (3 * big, big, 500_000)
    assert scores["b c"] == (big, big + 1, 2_000_000 * big // (2 * big + 1))
    assert scores["a b c"] == (3 * big, big, 400_000)
    assert {r["phrase"] for r in col.subsumed(found).collect()} == {"a b", "b c"}
    rows = [(f"{a} {b}. " * 6, "en") for a, b in pairwise("abcdefgh")]
    top = found_rows = sorted(map(tuple, col.mined(table(spark, rows), least=3, top=3).collect()))
    assert top == expected(rows, 3, top=3) and len(found_rows) == 3


def test_a_very_long_text(spark, rng):
    rows = [(prose(rng, 300_000, [f"w{k}" for k in range(40)]), "en"), ("w1 w2", "en")]
    assert found(col.mined(table(spark, rows))) == expected(rows, 30)


def test_empty_table(spark):
    assert col.mined(spark.createDataFrame([], DOCS)).collect() == []
