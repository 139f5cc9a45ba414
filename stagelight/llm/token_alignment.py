"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) and a SentencePiece BPE (B) cover the same bytes.

Both tokenizers read a space and the text. Wherever a token of A and one of B end at the same byte, a group ends; the two
tokens that end there are linked. Diagonal run skipping finds the groups: as long as both sides go on one to one, token i
of A ends with token i + shift of B, so runs of doubling length are compared at the current shift and skipped as a whole.
Where a comparison fails it is halved down to the token, the irregular group is resolved by stepping the side that lags,
and the shift that it leaves is the next one.

A text is cut before single spaces that no token of either side can cross. Such a unit has the same tokens wherever it
stands, so each distinct unit of a block is encoded once, and long texts are aligned window by window in bounded memory.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import in_pieces, ship, stored

#: The digit of a pair's key that holds the id of B; ids of A come above it.
B_BITS = 24
SPACE = 0x20


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: visible Latin-1 characters for themselves, then
    the characters from 256 on for the other bytes in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, byte_level_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            known = all(c in alphabet for c in entry)
            self.bytes_a[number] = bytes(alphabet[c] for c in entry) if known else entry.encode()
        self.bytes_b = [self._piece_bytes(number) for number in range(self.b.get_piece_size())]
        if len(self.bytes_b) > 1 << B_BITS:
            raise ValueError(f"B has {len(self.bytes_b)} pieces; pair keys hold {1 << B_BITS}")
        #: No piece of B goes on with a space after another character, so no token crosses a unit's end.
        self.separable = not any(b" " in piece.lstrip(b" ") for piece in self.bytes_b)

    def _piece_bytes(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def most_pairs(self) -> int:
        """A bound on the distinct linked pairs of any corpus: of two tokens that end together, the shorter one is a
        suffix of the other."""
        return sum(map(len, self.bytes_a)) + sum(map(len, self.bytes_b))


def unit_starts(text: np.ndarray, firsts: np.ndarray, separable: bool = True) -> np.ndarray:
    """Where units begin in texts laid end to end, each with its leading space; ``firsts`` are the texts' first bytes.

    A unit begins before a space that has no space before it, is not the last byte of its text, and has a visible ASCII
    character on one side at least. A's pattern always parts words there, also in runs of other white space.
    """
    begins = np.zeros(len(text), dtype=bool)
    if separable and len(text) > 2:
        visible = (text > SPACE) & (text < 0x7F)
        begins[1:-1] = (text[1:-1] == SPACE) & (text[:-2] != SPACE) & (visible[:-2] | visible[2:])
        begins[firsts[1:] - 1] = False
    begins[firsts] = True
    return np.flatnonzero(begins)


class Units:
    """Tokens of both sides for every distinct unit met so far; forgotten when there are more than ``remember``."""

    def __init__(self, tokenizers: Tokenizers, remember: int = 400_000):
        self.tokenizers, self.remember = tokenizers, remember
        self.size_a = np.array([len(x) for x in tokenizers.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in tokenizers.bytes_b], dtype=np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)]
        self.starts = [np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)]
        self.counts = [np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)]
        self.sound = np.zeros(0, dtype=bool)

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of each of the distinct ``units``; what is new is encoded, some thousands at a time."""
        if len(self.known) > self.remember:
            self._forget()
        known = self.known
        new = [u for u in units if u not in known]
        new.sort(key=lambda u: not "!" <= u[-1] <= "~")  # what can be encoded in a row comes first
        edge = sum("!" <= u[-1] <= "~" for u in new) if self.tokenizers.separable else 0
        cuts = [*range(0, edge, 8192), *range(edge, len(new), 8192), len(new)]
        encoded = [self._encoded(new[low:high]) for low, high in zip(cuts, cuts[1:])]
        for side in (0, 1) if new else ():
            counts = np.concatenate([part[side][1] for part in encoded])
            starts = len(self.ids[side]) + np.cumsum(counts) - counts
            self.ids[side] = np.concatenate([self.ids[side], *(part[side][0] for part in encoded)])
            self.starts[side] = np.concatenate((self.starts[side], starts.astype(np.int32)))
            self.counts[side] = np.concatenate((self.counts[side], counts))
        self.sound = np.concatenate([self.sound, *(part[2] for part in encoded)])
        known.update(zip(new, range(len(known), len(known) + len(new))))
        return np.array([known[u] for u in units], dtype=np.int64)

    def _encoded(self, units: list[str]) -> tuple:
        """Ids and counts of both sides, and whether the tokens of a unit join to its bytes on both.

        A unit that ends in a visible ASCII character parts from whatever unit follows it, so such units are encoded
        as one text in a row and told apart by their ends; the few others go one by one.
        """
        length = np.fromiter((len(u.encode()) for u in units), dtype=np.int64, count=len(units))
        in_row = all("!" <= u[-1] <= "~" for u in units)
        sides, sound = [], np.ones(len(units), dtype=bool)
        row = "".join(units)
        for encode, entries, sizes in (
            (self._encode_a, self.tokenizers.bytes_a, self.size_a),
            (self._encode_b, self.tokenizers.bytes_b, self.size_b),
        ):
            if in_row:
                ids = np.array(encode([row])[0], dtype=np.int32)
                if b"".join([entries[x] for x in ids.tolist()]) == row.encode():
                    until = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum(length)) + 1
                    sides.append((ids, np.diff(until, prepend=0).astype(np.int32)))
                    continue
            found = encode(units)
            sound &= [b"".join([entries[x] for x in own]) == u.encode() for own, u in zip(found, units, strict=True)]
            counts = np.fromiter(map(len, found), dtype=np.int32, count=len(found))
            sides.append((np.array([x for own in found for x in own], dtype=np.int32), counts))
        return *sides, sound

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizers.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.tokenizers.b.encode([text[1:] for text in texts], num_threads=1)

    def tokens(self, side: int, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a row of units, one after the other, and how many each unit has."""
        counts = self.counts[side][units].astype(np.int64)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[side][np.arange(total) + np.repeat(self.starts[side][units] - ends + counts, counts)], counts


def group_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Diagonal run skipping over two rising rows of byte ends that share their last one: for every group the number of
    tokens of A and of B up to its end."""
    i, j, count = 0, 0, len(ends_a)
    cut_a: list[int] = []
    cut_b: list[int] = []
    add_a, add_b = cut_a.append, cut_b.append
    while i < count:
        at_a, at_b = ends_a[i], ends_b[j]
        if at_a == at_b:  # a run at this shift: twice as long as long as it agrees, then as much of the rest as agrees
            begin, step = i, 2
            i, j = i + 1, j + 1
            while i < count and ends_a[i : i + step] == ends_b[j : j + step]:
                moved = min(step, count - i)
                i, j, step = i + moved, j + moved, 2 * step
            while i < count and step > 2:
                step //= 2
                if ends_a[i : i + step] == ends_b[j : j + step]:
                    moved = min(step, count - i)
                    i, j = i + moved, j + moved
            if i == begin + 1:
                add_a(i)
                add_b(j)
            else:
                cut_a += range(begin + 1, i + 1)
                cut_b += range(j - (i - begin) + 1, j + 1)
            continue
        while at_a != at_b:  # an irregular group: step the side that lags until both end together
            if at_a < at_b:
                i += 1
                at_a = ends_a[i]
            else:
                j += 1
                at_b = ends_b[j]
        i, j = i + 1, j + 1
        add_a(i)
        add_b(j)
    return cut_a, cut_b


class GroupText:
    """Writes groups as text: ids of A, a bar and ids of B; groups parted by semicolons."""

    def __init__(self, count_a: int, count_b: int):
        marks = ((count_a, ",", "|"), (count_b, ",", ";"))
        table = [f"{k}{mark}" for count, *both in marks for mark in both for k in range(count)]
        self.table, self.counts = pa.array(table, pa.binary()), (count_a, count_b)

    def __call__(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
        """The text, with a semicolon after the last group too: tokens are put in order as codes of the table."""
        count_a, count_b = self.counts
        codes = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        code_a, code_b = ids_a.astype(np.int64), ids_b + np.int64(2 * count_a)
        code_a[cut_a - 1] += count_a
        code_b[cut_b - 1] += count_b
        before_b = np.append(0, cut_b[:-1])
        codes[np.arange(len(ids_a)) + np.repeat(before_b, np.diff(cut_a, prepend=0))] = code_a
        codes[np.arange(len(ids_b)) + np.repeat(cut_a, np.diff(cut_b, prepend=0))] = code_b
        taken = self.table.take(pa.array(codes))
        return taken.buffers()[2].to_pybytes()


class Aligner:
    """Aligns blocks of texts, window by window."""

    def __init__(self, units: Units, window: int = 1 << 20):
        self.units, self.window = units, window
        self.text = GroupText(len(units.size_a), len(units.size_b))

    def parts(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text that has tokens, one part or more in order: its number, the ids of A and of B, and the groups'
        ends in them. Every part ends at the end of a unit."""
        full = [(k, f" {text}".encode()) for k, text in enumerate(texts) if text]
        if not full:
            return
        owners = np.array([k for k, _ in full])
        sizes = np.array([len(x) for _, x in full], dtype=np.int64)
        buffer = np.frombuffer(b"".join([x for _, x in full]), dtype=np.uint8)
        firsts = np.cumsum(sizes) - sizes
        starts = unit_starts(buffer, firsts, self.units.tokenizers.separable)
        offsets = np.append(starts, len(buffer))
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(buffer))
        coded = pieces.dictionary_encode()
        numbers = self.units.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        doc = np.searchsorted(firsts, starts, side="right") - 1
        broken = np.bincount(doc, weights=~self.units.sound[numbers], minlength=len(full)) > 0
        window = (starts - firsts[doc]) // self.window
        edges = np.flatnonzero(np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(window) != 0))))
        edges = np.append(edges, len(starts))
        batch = edges[np.searchsorted(starts[edges[:-1]], np.arange(0, len(buffer), self.window))]  # parts per gather
        for low, high in zip(np.unique(batch), np.append(np.unique(batch)[1:], len(starts))):
            yield from self._gathered(numbers, edges[(edges >= low) & (edges <= high)], doc, owners, broken)

    def _gathered(self, numbers, edges, doc, owners, broken) -> Iterator[tuple]:
        """The parts between ``edges``, whose tokens are put in place together."""
        low, high = edges[0], edges[-1]
        sides = []
        for side, sizes in enumerate((self.units.size_a, self.units.size_b)):
            ids, counts = self.units.tokens(side, numbers[low:high])
            sides.append((ids, np.cumsum(sizes[ids]), np.append(0, np.cumsum(counts))[edges - low]))
        (ids_a, ends_a, at_a), (ids_b, ends_b, at_b) = sides
        for k, begin in enumerate(edges[:-1]):
            if broken[doc[begin]]:
                continue
            a, b = slice(at_a[k], at_a[k + 1]), slice(at_b[k], at_b[k + 1])
            base_a, base_b = (ends[x.start - 1] if x.start else 0 for ends, x in ((ends_a, a), (ends_b, b)))
            cut_a, cut_b = group_ends((ends_a[a] - base_a).tolist(), (ends_b[b] - base_b).tolist())
            yield int(owners[doc[begin]]), ids_a[a], ids_b[b], np.array(cut_a), np.array(cut_b)


_aligners: dict[str, Aligner] = {}


def aligner_of(byte_level_json: str, piece_model: bytes) -> Aligner:
    """One aligner per worker and pair of vocabularies; what it remembers serves the worker's next tasks too."""
    key = hashlib.sha256(byte_level_json.encode() + piece_model).hexdigest()
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(Units(Tokenizers(byte_level_json, piece_model)))
    return _aligners[key]


def _mapped(docs: DataFrame, id_col: str, text_col: str, files: tuple[str, str], schema: str, rows) -> DataFrame:
    """``rows(texts, aligner)`` gives the columns after doc_id for a list of texts."""
    spark = docs.sparkSession
    ship(spark)
    content = []
    for file in files:
        with open(file, "rb") as opened:
            content.append(opened.read())
    shared = spark.sparkContext.broadcast((content[0].decode(), content[1]))  # two vocabulary files, a few MB
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or aligner_of(*shared.value)
            for piece in in_pieces(batch):
                texts = [text or "" for text in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *rows(texts, aligner)], names=names)

    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return keyed.mapInArrow(run, schema)


def _lists(values: list[list[np.ndarray]], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *(sum(map(len, own)) for own in values)])
    flat = [x for own in values for x in own]
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0), kind)
    )


def aligned(
    docs: DataFrame, byte_level_json: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids_a and ids_b, and group_a and group_b, where group k holds the tokens of
    A before group_a[k] and those of B before group_b[k] that no earlier group holds.

    ``byte_level_json`` and ``piece_model`` are the driver's paths of the two vocabulary files. Ids are integral. A text
    that is null or empty, or whose tokens on either side do not join to a space and the text, has no tokens. Repeated
    rows give repeated results, an empty table an empty one; other columns are not read. Texts of any length are
    encoded whole; memory grows with the longest text, and with the longest stretch without a space that parts units.
    There is no shuffle.
    """

    def rows(texts: list[str], aligner: Aligner) -> list[pa.Array]:
        found: list[list[list[np.ndarray]]] = [[[] for _ in texts] for _ in range(4)]
        for k, ids_a, ids_b, cut_a, cut_b in aligner.parts(texts):
            before_a, before_b = (sum(map(len, side[k])) for side in found[:2])
            parts = (ids_a, ids_b, cut_a + before_a, cut_b + before_b)
            for column, part in zip(found, parts, strict=True):
                column[k].append(part)
        return [_lists(column, pa.int32()) for column in found]

    schema = "doc_id long, ids_a array<int>, ids_b array<int>, group_a array<int>, group_b array<int>"
    return _mapped(docs, id_col, text_col, (byte_level_json, piece_model), schema, rows)


def _counted(texts: list[str], aligner: Aligner) -> list[pa.Array]:
    """Token and group counts, the digest of the groups, and every linked pair with how often the text has it."""
    counts = np.zeros((3, len(texts)), dtype=np.int64)
    digests = [None] * len(texts)
    keys: list[list[np.ndarray]] = [[] for _ in texts]
    for k, ids_a, ids_b, cut_a, cut_b in aligner.parts(texts):
        if digests[k] is None:
            digests[k] = hashlib.sha256()
        else:
            digests[k].update(b";")
        digests[k].update(aligner.text(ids_a, ids_b, cut_a, cut_b)[:-1])
        counts[:, k] += (len(ids_a), len(ids_b), len(cut_a))
        last_a, last_b = ids_a[cut_a - 1].astype(np.int64), ids_b[cut_b - 1]
        keys[k].append((last_a << B_BITS) | last_b)
    pairs, times = [], []
    for own in keys:
        found = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0), np.zeros(0))
        pairs.append([found[0]])
        times.append([found[1]])
    hexes = [d.hexdigest() if d else "" for d in digests]
    return [*map(pa.array, counts), pa.array(hexes, pa.string()), _lists(pairs, pa.int64()), _lists(times, pa.int64())]


def pair_counts(stored_rows: DataFrame) -> DataFrame:
    """How many links of the corpus hold each pair: key and n. A task adds its rows up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            new = np.concatenate((keys, batch.column("pairs").flatten().to_numpy()))
            counts = np.concatenate((sums, batch.column("times").flatten().to_numpy()))
            keys, place = np.unique(new, return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, place, counts)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["key", "n"])

    added = stored_rows.select("pairs", "times").mapInArrow(run, "key long, n long")
    return added.groupBy("key").agg(F.sum("n").alias("n"))


def summarised(
    docs: DataFrame, byte_level_json: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A pair's count is the number of links in all rows that hold it; n_best counts the links of a document whose pair
    has the highest count of its token of B, ties included; count_sum adds the counts of all its links.

    Texts are treated as in ``aligned`` and encoded once: every document's pairs go to the shared folder with their
    multiplicities. The table of counts goes through the driver to all tasks. Its size is bounded by the vocabularies
    (``Tokenizers.most_pairs``), not by the corpus: half a million pairs for the public ones.
    """
    spark = docs.sparkSession
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"
    )
    rows = stored(_mapped(docs, id_col, text_col, (byte_level_json, piece_model), schema, _counted), "aligned")
    table = pair_counts(rows).toArrow().sort_by("key")
    keys, counts = (table.column(name).to_numpy() for name in ("key", "n"))
    highest = np.zeros(1 << B_BITS if len(keys) else 0, dtype=np.int64)
    own_b = keys & ((1 << B_BITS) - 1)
    np.maximum.at(highest, own_b, counts)
    shared = spark.sparkContext.broadcast((keys, counts, counts == highest[own_b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, n, best = shared.value
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(known, pairs.flatten().to_numpy())
            bounds = np.cumsum(np.append(0, pairs.value_lengths().to_numpy()))
            columns = [batch.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")]
            for value in (times * best[at], times * n[at]):
                columns.append(pa.array(np.diff(np.append(0, np.cumsum(value))[bounds])))
            yield pa.RecordBatch.from_arrays([*columns, batch.column("groups_sha256")], names=names)

    out = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    names = [part.split()[0] for part in out.split(", ")]
    return rows.mapInArrow(run, out)


def public_files() -> tuple[str, str]:
    """Paths of the two public vocabularies that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
