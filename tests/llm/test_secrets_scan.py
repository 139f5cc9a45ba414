import hashlib
import re
import time
import zlib

import pytest
from helpers import DOCS, by_id, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from stagelight.llm.queries import op5_secret_scans
from stagelight.llm.secrets_scan import Scanner, base_62, base_digest, checksum_holds, joined, luhn_holds, scanned

EITHER = lambda word: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)
NAMES = "|".join([*map(EITHER, ("password", "passwd", "secret", "token")), EITHER("api") + "_?" + EITHER("key")])
ASSIGN = re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SCANNER = Scanner()


def brute(text):
    """The base spans by the plain patterns over the whole text."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def base(text):
    return [s for s in SCANNER.spans(text) if s[0] in ("assign", "access", "hex")]


PARTS = st.sampled_from(
    ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "api__key", "=", ":", " ", '"', "'", "abcdefgh", "x", "AKIA",
     "AKIAABCDEFGH1234", "akia", "0123456789abcdef" * 2, "f" * 31, "ſecret", "toKen", "é", "\U0001f600", "\n", "=" * 9, "."]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans_as_the_plain_patterns(text):
    assert base(text) == brute(text)


@pytest.mark.parametrize(
    "text",
    ["token=secret=abcd1234", "password:short token=longenough", "secrettoken = 'abcdefgh'", "İ token=abcdefgh", "AKIAAKIA" * 3,
     "api_key token=12345678", "password = password=abcdefgh", "password== x", "a" * 100, "token=" + "a" * 40],
)
def test_overlaps_and_letters_that_fold(text):
    assert base(text) == brute(text)


def checked(prefix, body="A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"):
    return prefix + body + base_62(zlib.crc32(body.encode()), 6)


def test_checksums():
    good = checked("ghp_")
    wrong = good[:-1] + ("x" if good[-1] != "x" else "y")
    text = f"é {good} {wrong} {checked('npm_')} GHP_{good[4:]} {good}A 4111 1111 1111 1111 4111 1111 1111 1112 5500-0055-5555-5559"
    kinds = [(kind, text[a:b]) for kind, a, b in SCANNER.spans(text)]
    assert kinds == [("forge", good), ("package", checked("npm_")), ("card", "4111 1111 1111 1111"), ("card", "5500-0055-5555-5559")]
    assert checksum_holds(good[4:]) and not checksum_holds(wrong[4:]) and luhn_holds("79927398713")


def test_query_digests(spark, tmp_path):
    texts = ["é token=abcdefgh " + "0" * 32, None, "", "plain", "x" * 200_000 + " AKIAABCDEFGH1234", "plain"]
    documents(spark, texts, ids=[0, 1, 2, 3, 4, 3], clashing=("spans", "kind")).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op5_secret_scans(spark, str(tmp_path)).collect()
    assert len(rows) == 6
    for row in rows:
        text = texts[row["doc_id"]] or ""
        counts = [sum(s[0] == kind for s in brute(text)) for kind in ("assign", "access", "hex")]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == counts
        assert row["base_sha256"] == hashlib.sha256(joined(brute(text)).encode()).hexdigest() == base_digest(SCANNER.spans(text))
        assert row["spans"] == joined(SCANNER.spans(text))


def test_null_ids_and_empty_table(spark):
    rows = scanned(documents(spark, ["token=abcdefgh"], ids=[None])).collect()
    assert rows[0]["doc_id"] is None and len(rows[0]["spans"]) == 1
    assert by_id(scanned(spark.createDataFrame([], DOCS))) == {}


def test_card_after_digits_that_fail():
    text = "2024 4111 1111 1111 1111, 12-31 5500-0055-5555-5559"
    cards = [text[s:e] for kind, s, e in Scanner().spans(text) if kind == "card"]
    assert cards == ["4111 1111 1111 1111", "5500-0055-5555-5559"]


def test_long_texts_take_linear_time():
    for part, count in (("1999 é ", 400_000), ("0123456789abcdef" * 2 + " é ", 80_000), ("token=abcdefgh ", 200_000)):
        text = part * count
        begun = time.perf_counter()
        found = SCANNER.spans(text)
        assert time.perf_counter() - begun < 20
        assert [s for s in found if s[0] in ("assign", "access", "hex")] == brute(text)
