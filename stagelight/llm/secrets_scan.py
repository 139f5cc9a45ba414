"""Secret scan: keywords by Aho-Corasick, anchored patterns only at the hits, then checksums inside the candidates.

Kinds ``assign``, ``access`` and ``hex`` are the base; ``forge`` and ``package`` (tokens of 36 characters that end in
their own CRC-32) and ``card`` (numbers with a Luhn digit) are added by the method.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from stagelight.llm.common import keyed_text, ship

#: The base patterns. Letters of the assignment's names may be in either case, in ASCII only.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Prefixes of public token formats with 30 random characters and a checksum of 6 in base 62.
CHECKED = {"ghp_": "forge", "gho_": "forge", "ghu_": "forge", "ghs_": "forge", "ghr_": "forge", "npm_": "package"}
CHECKED_TOKEN = re.compile(r"[A-Za-z0-9]{36}(?![A-Za-z0-9])")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")
CARD_LEADS = tuple("3456")
BASE_62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Order of kinds that begin at one place.
KINDS = ("assign", "access", "hex", "forge", "package", "card")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

_IS_HEX = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_IS_DIGIT = bytes(1 if chr(b) in "0123456789" else 0 for b in range(256))

Span = tuple[str, int, int]


def _keywords() -> ahocorasick.Automaton:
    """All keywords in lower case; the value tells which pattern to try."""
    found = ahocorasick.Automaton()
    for name in ASSIGN_NAMES:
        found.add_word(name, ("assign", len(name)))
    found.add_word("akia", ("access", 4))
    for prefix in CHECKED:
        found.add_word(prefix, ("checked", len(prefix)))
    found.make_automaton()
    return found


def base_62(number: int, digits: int) -> str:
    text = ""
    for _ in range(digits):
        number, rest = divmod(number, 62)
        text = BASE_62[rest] + text
    return text


def checksum_holds(token: str) -> bool:
    """Whether the last 6 of 36 characters are the CRC-32 of the first 30 in base 62."""
    return base_62(zlib.crc32(token[:30].encode()), 6) == token[30:]


def luhn_holds(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


class Points:
    """Code points before rising byte positions of a text, each counted on from the one before."""

    def __init__(self, raw: bytes):
        self.raw, self.byte, self.points = raw, 0, 0

    def before(self, byte: int) -> int:
        self.points += len(self.raw[self.byte : byte].decode())
        self.byte = byte
        return self.points


class Scanner:
    def __init__(self):
        self.keywords = _keywords()

    def spans(self, text: str) -> list[Span]:
        """All spans (kind, start, end) in code points, end exclusive, by start and then kind.

        Within a kind, matches are leftmost and do not overlap; one that fails its length or checksum is dropped but
        still takes its place, as it would for a scan with the pattern alone. After a number that is no card the search
        goes on at the next run of digits.
        """
        if not text:
            return []
        raw = text.encode()
        found: list[Span] = []
        upto = dict.fromkeys(KINDS, 0)
        # Lower case in ASCII only: positions stay, and no other letter turns into an ASCII one.
        for end, (kind, length) in self.keywords.iter(raw.lower().decode()):
            start = end - length + 1
            if kind == "assign" and start >= upto["assign"] and (match := ASSIGN.match(text, start)):
                upto["assign"] = match.end()
                if len(match[1]) >= LEAST_ASSIGNED:
                    found.append(("assign", start, match.end()))
            elif kind == "access" and start >= upto["access"] and (match := ACCESS.match(text, start)):
                upto["access"] = match.end()
                if match.end() - start >= LEAST_ACCESS:
                    found.append(("access", start, match.end()))
            elif kind == "checked" and text[start : end + 1] in CHECKED:
                match = CHECKED_TOKEN.match(text, end + 1)
                if match and checksum_holds(match[0]):
                    found.append((CHECKED[text[start : end + 1]], start, match.end()))
        found.extend(self._runs(raw, text))
        found.extend(self._cards(raw, text))
        return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))

    def _runs(self, raw: bytes, text: str) -> list[Span]:
        """Maximal runs of lower-case hexadecimal digits of full length."""
        marks, found, at, points = raw.translate(_IS_HEX), [], 0, Points(raw)
        while (at := marks.find(b"\1" * LEAST_HEX, at)) >= 0:
            end = marks.find(b"\0", at)
            end = len(marks) if end < 0 else end
            start = points.before(at)
            found.append(("hex", start, start + end - at))
            at = end
        return found

    def _cards(self, raw: bytes, text: str) -> list[Span]:
        """Card numbers, looked for only where four digits stand together; one that fails takes no place."""
        marks, found, at = raw.translate(_IS_DIGIT), [], 0
        tried, points = -1, Points(raw)
        while (at := marks.find(b"\1\1\1\1", at)) >= 0:
            begin = points.before(at)
            if begin > tried and (match := CARD.match(text, begin)):
                digits = re.sub("[ -]", "", match[0])
                if digits[0] in CARD_LEADS and luhn_holds(digits):
                    found.append(("card", begin, match.end()))
                    tried = match.end() - 1
            end = marks.find(b"\0", at)
            at = len(marks) if end < 0 else end
        return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_scanner: list[Scanner] = []


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and its spans, an array of (kind, start, end) by start and then kind.

    Positions count code points of the whole text, ends are exclusive; a null text counts as empty and has no spans.
    Repeated rows give repeated results, an empty table an empty one; other columns are not read. No shuffle.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _scanner:
            _scanner.append(Scanner())
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            rows = [
                [{"kind": k, "start": s, "end": e} for k, s, e in _scanner[0].spans(text)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(kind))], names=["doc_id", "spans"]
            )

    schema = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    return keyed_text(docs, id_col, text_col).mapInArrow(run, schema)


def base_digest(spans: list[Span]) -> str:
    """SHA-256 of the joined base spans, for tests."""
    return hashlib.sha256(joined([s for s in spans if s[0] in KINDS[:3]]).encode()).hexdigest()
