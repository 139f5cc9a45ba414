import hashlib
import re

from helpers import DOCS, by_id, documents

from stagelight.llm import exact_dedup
from stagelight.llm.common import field_size


def brute(rows):
    groups = {}
    for i, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(norm, []).append((i, text or ""))
    result = {}
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0]))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        for i, _ in members:
            result[i] = (keep[0], len(members), i == keep[0], digest)
    return result


TEXTS = ["a b", "ab", "a  b", "é x", "éx", None, "", " \t\n\x0b\x0c\r", "a b", "x" * 100_000, "x" * 99_999 + " x", "A b"]


def test_as_brute_force(spark):
    docs = documents(spark, TEXTS + ["copy"] * 300, clashing=("keep_id", "maybe", "norm", "text_sha256"))
    found = by_id(exact_dedup.flagged(docs))
    expected = brute([(row["doc_id"], row["text"]) for row in docs.collect()])
    assert {i: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for i, r in found.items()} == expected


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = documents(spark, TEXTS + [f"text {k}" for k in range(200)])
    expected = sorted(map(tuple, exact_dedup.flagged(docs).collect()))
    monkeypatch.setattr(exact_dedup, "field_size", lambda rows, max_bits: 64)
    assert sorted(map(tuple, exact_dedup.flagged(docs).collect())) == expected


def test_one_row_of_each_group_stays_with_all_columns(spark):
    docs = documents(spark, [*TEXTS, "a b", None], ids=[*range(len(TEXTS)), 0, 5], clashing=("digest", "maybe", "row"))
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    found = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    assert found == [(2, "a  b"), (3, "é x"), (7, TEXTS[7]), (8, TEXTS[8]), (10, TEXTS[10]), (11, "A b")]


def test_null_ids_come_last(spark):
    docs = documents(spark, ["same", "same", "own"], ids=[None, 4, None])
    rows = sorted(exact_dedup.flagged(docs).collect(), key=lambda r: (r["group_size"], r["doc_id"] is None))
    assert [(r["doc_id"], r["keep_id"], r["kept"]) for r in rows] == [(None, None, True), (4, 4, True), (None, 4, False)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup.flagged(empty).collect() == [] and exact_dedup.deduplicated(empty).collect() == []


def test_filter_size_has_a_bound():
    assert field_size(10**12, 1 << 28) == 1 << 28 and field_size(0, 1 << 28) == 1 << 16
