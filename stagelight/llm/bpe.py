"""Byte-level BPE by ranks, encoding and decoding.

The text is split by the tokenizer's pattern; each piece is merged by itself. A segment tree over the byte positions of
a piece holds the smallest pair rank and, of equal ones, the leftmost place, so the root names the next merge. A merge
changes the pairs of two live neighbours, which are two point updates up the tree. Many pieces are merged side by side
in numpy arrays, one tree per row; every piece is merged once per worker and remembered.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stagelight.llm.common import in_pieces, keyed_text, ship

#: No pair, or a pair that does not merge.
NEVER = np.int64(1 << 62)


class Ranks:
    """A rank file: the bytes of every id, and which two ids merge into which."""

    def __init__(self, rank_file: bytes, pattern: str):
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.token_bytes = [b""] * self.size
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.ids = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.slots = 1 << (4 * len(pairs)).bit_length()
        self.keys = np.full(self.slots, -1, dtype=np.int64)
        self.ranks = np.full(self.slots, NEVER, dtype=np.int64)
        self.probes = 1
        for key, rank in pairs.items():
            slot, probe = self._slot(np.int64(key)), 1
            while self.keys[slot] >= 0:
                slot, probe = (slot + 1) % self.slots, probe + 1
            self.keys[slot], self.ranks[slot], self.probes = key, rank, max(self.probes, probe)

    def _slot(self, key):
        return ((key ^ (key >> 15)) * 0x9E3779B1 >> 7) & (self.slots - 1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``NEVER`` where they do not merge or one is missing (negative)."""
        keys = left * self.size + right
        slots = self._slot(keys)
        found = np.where(self.keys[slots] == keys, self.ranks[slots], NEVER)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & (self.slots - 1)
            at = slots[open_]
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit & (self.keys[at] >= 0)]
        found[(left < 0) | (right < 0)] = NEVER
        return found


def merged(pieces: list[bytes], ranks: Ranks, cells: int = 1 << 18) -> list[bytes]:
    """The ids of each piece as little-endian 32-bit integers.

    A piece that is a token as a whole is that token, even where merges would not lead there.
    Pieces are grouped by length up to the next power of two, so that a group fills one array of trees; a group is cut
    so that an array has about ``cells`` nodes, whatever the lengths. A single longer piece takes an array of its own.
    """
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    result = [ranks.ids[p].to_bytes(4, "little") if p in ranks.ids else b"" for p in pieces]
    lengths[[k for k, ids in enumerate(result) if ids]] = 0
    order = np.argsort(lengths, kind="stable")
    start = int(np.searchsorted(lengths[order], 1))
    while start < len(order):
        width = 1 << int(lengths[order[start]] - 1).bit_length()
        stop = int(np.searchsorted(lengths[order], width, side="right"))
        stop = min(stop, start + max(1, cells // (2 * width)))
        group = order[start:stop]
        for k, ids in zip(group, _merge_group([pieces[k] for k in group], width, ranks), strict=True):
            result[k] = ids
        start = stop
    return result


def _merge_group(pieces: list[bytes], width: int, ranks: Ranks) -> list[bytes]:
    """Merge pieces of at most ``width`` bytes, a power of two, side by side."""
    count = len(pieces)
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=count)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(count, width)
    place = np.arange(width)
    ids = np.where(place < sizes[:, None], ranks.byte_ids[raw], -1)
    after = np.where(place + 1 < sizes[:, None], place + 1, width)  # next live position; width: none
    before = np.broadcast_to(place - 1, (count, width)).copy()
    # A node holds rank * width + position, so its minimum is the smallest rank and then the leftmost place.
    tree = np.full((count, 2 * width), NEVER, dtype=np.int64)
    if width > 1:
        first = ranks.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(count, width - 1)
        tree[:, width:-1] = np.where(first < NEVER, first * width + place[:-1], NEVER)
    level = width
    while level > 1:
        half = level // 2
        np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, half:level])
        level = half
    root = 1 if width > 1 else 0
    rows = np.flatnonzero(tree[:, root] < NEVER)

    def update(rows: np.ndarray, at: np.ndarray, follow: np.ndarray) -> None:
        """Set the rank of the pair that begins at ``at`` and carry it up the tree."""
        exists = follow < width
        right = np.where(exists, ids[rows, np.minimum(follow, width - 1)], -1)
        rank = ranks.pair_ranks(ids[rows, at], right)
        node = at + width
        tree[rows, node] = np.where(rank < NEVER, rank * width + at, NEVER)
        while node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    while len(rows):
        best = tree[rows, root]
        left, rank = best % width, best // width
        right = after[rows, left]
        follow = after[rows, right]
        ids[rows, left], ids[rows, right] = rank, -1
        after[rows, left] = follow
        linked = follow < width
        before[rows[linked], follow[linked]] = left[linked]
        tree[rows, right + width] = NEVER
        update(rows, right, np.full(len(rows), width))
        update(rows, left, follow)
        earlier = before[rows, left]
        has = earlier >= 0
        if has.any():
            update(rows[has], earlier[has], left[has])
        rows = rows[tree[rows, root] < NEVER]
    live = ids >= 0
    flat = ids[live].astype("<u4").tobytes()
    stops = np.cumsum(live.sum(axis=1)) * 4
    return [flat[a:b] for a, b in zip(np.concatenate(([0], stops[:-1])).tolist(), stops.tolist(), strict=True)]


class Encoder:
    """Encodes and decodes whole texts; remembers pieces, at most ``remember`` of them: about 200 bytes each."""

    def __init__(self, rank_file: bytes, pattern: str, remember: int = 200_000):
        self.ranks = Ranks(rank_file, pattern)
        self.known: dict[str, bytes] = {}
        self.remember = remember

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, as ``Encoding.encode_ordinary`` would give them."""
        split = [self.ranks.pattern.findall(text) for text in texts]
        new = list(set().union(*split) - self.known.keys()) if split else []
        if len(self.known) + len(new) > self.remember:
            self.known = {}
            new = list(set().union(*split))
        self.known.update(zip(new, merged([p.encode() for p in new], self.ranks), strict=True))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.ranks.token_bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_encoders: dict[str, Encoder] = {}


def encoder(rank_file: bytes, pattern: str) -> Encoder:
    """One encoder per worker and rank file."""
    key = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(rank_file, pattern)
    return _encoders[key]


def encoded(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (little-endian 32-bit), n_tokens, decoded (the bytes of the ids).

    ``rank_file`` is the driver's path of a rank file; its content, of fixed size, travels to the tasks. A null text
    counts as empty and has no ids. Repeated rows give repeated results, an empty table an empty one. Texts of any
    length are encoded whole; other columns of ``docs`` are not read. There is no shuffle.
    """
    return _mapped(
        docs,
        rank_file,
        pattern,
        id_col,
        text_col,
        "doc_id long, n_tokens long, ids binary, decoded binary",
        lambda ids, decoded: [pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
    )


def digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encoded``, with SHA-256 digests in place of ids and decoded bytes: doc_id, n_tokens, ids_sha256,
    decoded_sha256."""

    def hashed(ids: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
        return [pa.array([hashlib.sha256(x).hexdigest() for x in column], pa.string()) for column in (ids, decoded)]

    return _mapped(
        docs,
        rank_file,
        pattern,
        id_col,
        text_col,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        hashed,
    )


def _mapped(docs: DataFrame, rank_file: str, pattern: str, id_col: str, text_col: str, schema: str, finish) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    with open(rank_file, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())  # one vocabulary file, under 1 MB
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, pattern)
        for batch in batches:
            for piece in in_pieces(batch):
                ids = own.encode(piece.column("text").to_pylist())
                decoded = [own.decode(x) for x in ids]
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), counts, *finish(ids, decoded)], names=names)

    return keyed_text(docs, id_col, text_col).mapInArrow(run, schema)


def public_ranks() -> tuple[str, str]:
    """Path and pattern of the public tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


