"""Training-order token shards: fixed-stride binary files in a keyed pseudo-random order.

The token ids of all documents, each with an end mark, form one stream that is cut into sequences of equal length. A
keyed Feistel permutation with cycle-walking gives every sequence its slot. Slots are dealt to shards in ranges, one
shard per task and file, so that a reader finds slot s at byte (s % per_shard) * stride of file s // per_shard and can
go on from any slot.

Texts are encoded once. The ids are written compressed, each piece with its place in its task's part of the stream; the
parts are then laid one after the other, so the stream is numbered without being moved. A task deals its pieces to the
shards together, so that a shard gets a few long rows from it, which pack well, and not one for each sequence.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.llm.common import in_pieces, keyed_text, ship, stored
from stagelight.llm.text_arrays import GOLDEN, mixed
from stagelight.plans.shared import scratch

U64 = np.uint64
#: Known to the library as a special token and never allowed as one, so texts with it are encoded like any others.
#: Without any special token the library would search for the empty string, at every character of a text.
MARK = "\0<|mark|>\0"
SEPARATOR = b"\n"  # the writer ends every record with it, so the stride is one byte longer than the ids


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of 0 .. size - 1: a balanced Feistel network over the next power of four, walked until the
    value falls below ``size``."""

    size: int
    key: int
    rounds: int = 6

    def _half(self) -> int:
        return max(1, ((max(self.size, 2) - 1).bit_length() + 1) // 2)

    def _round(self, half: np.ndarray, number: int) -> np.ndarray:
        key = mixed(np.array([(self.key + number * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF], dtype=U64))
        return mixed((half + U64(1)) * GOLDEN ^ key) & U64((1 << self._half()) - 1)

    def _network(self, values: np.ndarray, order: range) -> np.ndarray:
        bits, mask = U64(self._half()), U64((1 << self._half()) - 1)
        left, right = values >> bits, values & mask
        if order.step > 0:
            for number in order:
                left, right = right, left ^ self._round(right, number)
        else:
            for number in order:
                left, right = right ^ self._round(left, number), left
        return (left << bits) | right

    def _walk(self, values: np.ndarray, order: range) -> np.ndarray:
        values = self._network(values.astype(U64), order)
        outside = np.flatnonzero(values >= U64(self.size))
        while len(outside):
            values[outside] = self._network(values[outside], order)
            outside = outside[values[outside] >= U64(self.size)]
        return values.astype(np.int64)

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        """The slot of each sequence."""
        return self._walk(sequences, range(self.rounds))

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        """The sequence in each slot."""
        return self._walk(slots, range(self.rounds - 1, -1, -1))


@dataclass(frozen=True)
class Shards:
    """What a reader needs to know of written shards."""

    path: str
    sequences: int
    length: int  # ids of a sequence
    width: int  # bytes of an id, little-endian
    per_shard: int  # slots of a shard
    tokens: int  # of the stream; the last sequence is filled up with end marks
    key: int

    @property
    def stride(self) -> int:
        return self.length * self.width + len(SEPARATOR)

    @property
    def count(self) -> int:
        return -(-self.sequences // self.per_shard)

    @property
    def last_tokens(self) -> int:
        """Ids of the stream in the last sequence."""
        return self.tokens - self.length * (self.sequences - 1)

    @property
    def order(self) -> Permutation:
        return Permutation(self.sequences, self.key)


_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(rank_file: bytes, pattern: str) -> tiktoken.Encoding:
    """One encoding per worker and rank file."""
    key = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if key not in _encodings:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        _encodings.clear()
        special = {MARK: max(ranks.values()) + 1}
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _encodings[key]


def _packed(ids: bytes, level: int = 3) -> bytes:
    return bytes(pa.Codec("zstd", level).compress(ids))


def _unpacked(packed: bytes, size: int) -> bytes:
    return bytes(pa.Codec("zstd").decompress(packed, size))


def _encoded(rows: DataFrame, rank_file: bytes, pattern: str, end_id: int, kind: str) -> DataFrame:
    """part, start, tokens and packed ids: the ids of a few texts with their end marks, and where they begin in the
    part of the stream that the task has. Written out, so that every row has its place for good."""
    shared = rows.sparkSession.sparkContext.broadcast(rank_file)  # one vocabulary file, under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(shared.value, pattern).encode_to_numpy
        part, start, end = TaskContext.get().partitionId(), 0, np.array([end_id], dtype=kind)
        for batch in batches:
            for piece in in_pieces(batch, limit=1 << 21):
                texts = (text for text in piece.column("text").to_pylist() if text)
                found = [x for t in texts for x in (encode(t, disallowed_special=()).astype(kind), end)]
                if not found:
                    continue
                ids = np.concatenate(found)
                row = {"part": part, "start": start, "tokens": len(ids), "ids": _packed(ids.tobytes(), 7)}
                yield pa.RecordBatch.from_pylist([row])
                start += len(ids)

    return stored(rows.mapInArrow(run, "part long, start long, tokens long, ids binary"), "tokens")


def dealt(
    pieces: Iterable[tuple[int, np.ndarray]], shards: Shards, held: int = 1 << 24
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard: the slots that the pieces have ids of, with the place and the number of those ids, and the ids.

    A piece is a place in the stream and the ids from there on. A shard comes once for all pieces of ``held`` bytes: with
    many shards a piece has a sequence or two for each, which pack badly and make a row each.
    """

    def grouped(cells: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        edges = np.append(0, np.cumsum(cells[:, 2]))
        order = np.argsort(cells[:, 0], kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(cells[order, 0] // shards.per_shard)) + 1):
            parts = [ids[a:b] for a, b in zip(edges[own].tolist(), edges[own + 1].tolist(), strict=True)]
            yield int(cells[own[0], 0]) // shards.per_shard, cells[own], np.concatenate(parts)

    length, cells, runs, size = shards.length, [], [], 0
    for at, ids in pieces:
        numbers = np.arange(at // length, (at + len(ids) - 1) // length + 1)
        edges = np.clip(np.append(numbers, numbers[-1] + 1) * length - at, 0, len(ids))
        places = np.where(numbers * length >= at, 0, at % length)
        cells.append(np.stack([shards.order.slots(numbers), places, np.diff(edges)], axis=1))
        runs.append(ids)
        size += cells[-1].nbytes + ids.nbytes
        if size >= held:
            yield from grouped(np.concatenate(cells), np.concatenate(runs))
            cells, runs, size = [], [], 0
    if runs:
        yield from grouped(np.concatenate(cells), np.concatenate(runs))


def materialised(
    docs: DataFrame,
    path: str,
    rank_file: str,
    pattern: str,
    end_id: int,
    key: int = 1,
    length: int = 512,
    shard_bytes: int = 8 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Shards:
    """Write the token ids of ``docs`` in training order under ``path`` and return what a reader needs.

    Null and empty texts add nothing, not even an end mark. Repeated rows each add their tokens. An empty table gives no
    shards. Texts of any length are encoded whole. The order of the stream is that in which tasks read the table; the
    order in the shards follows from it and ``key``. Ids take two bytes if they and ``end_id`` fit, else four. A shard
    is put together and written by one task through Spark's committer, so a lost executor costs that task alone; it
    holds one shard of ``shard_bytes`` in memory, and a task that deals ids to shards about 16 MB of them.
    """
    ship(docs.sparkSession)
    with open(rank_file, "rb") as file:
        content = file.read()
    with scratch(docs.sparkSession):
        return _written(keyed_text(docs, id_col, text_col), path, content, pattern, end_id, key, length, shard_bytes)


def _written(
    rows: DataFrame, path: str, content: bytes, pattern: str, end_id: int, key: int, length: int, shard_bytes: int
) -> Shards:
    spark = rows.sparkSession
    largest = max(end_id, *(int(line.split()[1]) for line in content.splitlines()))
    width = 2 if largest < 1 << 16 else 4
    kind = f"<u{width}"
    encoded = _encoded(rows, content, pattern, end_id, kind)
    sizes = encoded.groupBy("part").agg(F.sum("tokens").alias("tokens")).orderBy("part").collect()  # a row per task
    begins, total = {}, 0
    for part, tokens in sizes:
        begins[part], total = total, total + tokens
    sequences = -(-total // length)
    stride = length * width + len(SEPARATOR)
    shards = Shards(path, sequences, length, width, max(1, shard_bytes // stride), total, key)
    if not sequences:
        return shards
    begin = spark.sparkContext.broadcast(begins)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                for k in range(batch.num_rows):  # one piece at a time: all of a batch would be much at once
                    part, start, tokens, packed = (column[k].as_py() for column in batch.columns)
                    yield begin.value[part] + start, np.frombuffer(_unpacked(packed, tokens * width), dtype=kind)

        found = dealt(pieces(), shards)
        while some := list(islice(found, 64)):
            numbers, cells, ids = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers, pa.int32()),
                    pa.array([x.tobytes() for x in cells], pa.binary()),
                    pa.array([_packed(x.tobytes()) for x in ids], pa.binary()),
                ],
                names=["shard", "cells", "ids"],
            )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Put the shard of a partition together and give its records in order."""
        filled, last = None, -1
        for batch in batches:
            for k in range(batch.num_rows):
                shard, raw, packed = (column[k].as_py() for column in batch.columns)
                if filled is None:
                    filled = np.full((shards.per_shard, length), end_id, dtype=kind)
                cells = np.frombuffer(raw, dtype=np.int64).reshape(-1, 3)
                ids, at = np.frombuffer(_unpacked(packed, int(cells[:, 2].sum()) * width), dtype=kind), 0
                for slot, place, count in cells.tolist():
                    filled[slot - shard * shards.per_shard, place : place + count] = ids[at : at + count]
                    at += count
                last = max(last, int(cells[:, 0].max()) - shard * shards.per_shard)
        for first in range(0, last + 1, 1024):
            records = [row.tobytes() for row in filled[first : min(first + 1024, last + 1)]]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    pieces = encoded.mapInArrow(cut, "shard int, cells binary, ids binary")
    records = pieces.repartitionById(shards.count, "shard").mapInArrow(whole, "record binary")
    # The text writer puts the bytes of a string as they are and ends each with the separator.
    records.select(F.col("record").cast("string")).write.option("lineSep", SEPARATOR.decode()).text(f"{path}/shards")
    spark.createDataFrame([(json.dumps(asdict(shards)),)], "value string").coalesce(1).write.text(f"{path}/about")
    return shards


def opened(spark: SparkSession, path: str) -> Shards:
    """The description of shards that ``materialised`` wrote."""
    return Shards(**json.loads(spark.read.text(f"{path}/about").first()[0]))


def read(spark: SparkSession, shards: Shards, first_slot: int = 0, last_slot: int | None = None) -> DataFrame:
    """slot, shard, byte_offset, sequence, ids (binary) of the slots from ``first_slot`` to before ``last_slot``.

    Only the files of those slots are read, each as a whole by one task; to resume, pass the next slot.
    """
    ship(spark)
    schema = "slot long, shard int, byte_offset long, sequence long, ids binary"
    last = shards.sequences if last_slot is None else min(last_slot, shards.sequences)
    if first_slot >= last:
        return spark.createDataFrame([], schema)
    stride, per_shard, ids_bytes = shards.stride, shards.per_shard, shards.stride - len(SEPARATOR)
    files = [f"part-{k:05d}-*" for k in range(first_slot // per_shard, (last - 1) // per_shard + 1)]
    wanted = "*.txt" if len(files) > 200 else "{" + ",".join(files) + "}"
    content = spark.read.format("binaryFile").option("pathGlobFilter", wanted).load(f"{shards.path}/shards")
    number = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int").alias("shard")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, raw = batch.column("shard")[k].as_py(), memoryview(batch.column("content")[k].as_buffer())
                if len(raw) % stride:
                    raise ValueError(f"shard {shard} holds {len(raw)} bytes, no multiple of {stride}")
                begin, end = max(0, first_slot - shard * per_shard), min(len(raw) // stride, last - shard * per_shard)
                for start in range(begin, end, 1024):
                    places = np.arange(start, min(start + 1024, end))
                    slots, offsets = shard * per_shard + places, places * stride
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(slots),
                            pa.array(np.full(len(places), shard, dtype=np.int32)),
                            pa.array(offsets),
                            pa.array(shards.order.sequences(slots)),
                            pa.array([bytes(raw[a : a + ids_bytes]) for a in offsets.tolist()], pa.binary()),
                        ],
                        names=["slot", "shard", "byte_offset", "sequence", "ids"],
                    )

    return content.select(number, "content").mapInArrow(records, schema)
