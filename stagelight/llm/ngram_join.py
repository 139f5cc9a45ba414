"""Documents linked by the Jaccard similarity of their word n-grams, as a blocked sparse matrix product.

The matrix has a row per distinct n-gram set and a column per n-gram. Its product with its own transpose holds the
overlap of every two sets; only the parts that can reach the threshold are computed:

1. Documents of one n-gram set are one row (a class). A class is active if enough n-grams among its smallest hashes
   occur in another class too; the overlap that the threshold demands bounds how many. Counting runs in column blocks:
   each task counts what it holds, then sends each block its n-grams, and an n-gram that a task holds twice is sent
   once, however many rows have it.
2. Among active classes, n-grams are ordered from rare to frequent. Two similar sets share one of their first
   n - ceil(0.8 n) + 1 n-grams, so only classes that meet in one of those columns are multiplied.
3. Where many classes meet, each is multiplied with two leaders first, and what links is contracted. A group of near
   copies then stands as one before its pairs are looked at, so its work grows with its classes.
4. Classes are dealt to row blocks by the most crowded of their columns, those of a contracted group together. Two blocks
   that meet in a column, with classes there that are still apart, are multiplied in one task: those classes, all their
   n-grams, in strips of columns, until no pair of sizes can reach the threshold any more. A block is bounded by its
   classes and by their n-grams. A task returns a spanning forest of the links it finds, so its output grows with the
   classes and not with their pairs; components of all links follow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import bit_field, bits_at, field_size, in_pieces, kept, keyed_text, ship, stored, unused
from stagelight.llm.components import components
from stagelight.llm.text_arrays import Block, distinct_per_doc, mixed, shingle_hashes
from stagelight.plans.shared import shared_path

U64 = np.uint64


@dataclass(frozen=True)
class Similarity:
    """Two sets of w-word shingles link when 100 * overlap >= percent * union."""

    width: int = 5
    percent: int = 80

    def least_overlap(self, n: np.ndarray) -> np.ndarray:
        """What a set of n shingles must share with any set it links to: ceil(percent / 100 * n)."""
        return (n * self.percent + 99) // 100

    def asked(self, n: np.ndarray) -> np.ndarray:
        """How many shared shingles a class counts on among its first ones: a tenth of n."""
        return np.maximum(1, np.minimum((n + 9) // 10, self.least_overlap(n)))

    def first(self, n: np.ndarray) -> np.ndarray:
        """How many of its first shingles a class shows to have ``asked`` of those in common with a linked class."""
        return n - self.least_overlap(n) + self.asked(n)

    def needed(self, n: np.ndarray) -> np.ndarray:
        """Shared shingles among the first without which a class links to nothing; its partners are smaller by percent."""
        return np.maximum(1, self.asked((n * self.percent + 99) // 100))


def shingle_sets(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts of a batch in rising order, and the bounds of each document's."""
    block = Block([t.encode() for t in batch.column("text").to_pylist()])
    starts, ends, docs = block.words()
    words = block.span_hashes(starts, ends, lower=True)
    return distinct_per_doc(*shingle_hashes(words, docs, block.count, width), block.count)


def class_key(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _classes(rows: DataFrame, like: Similarity) -> DataFrame:
    """Per row: doc_id, text_hash, n, class (null for an empty set), its first 8 bytes, the shared first shingles that it
    needs, and its first shingles as packed hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch):
                hashes, bounds = shingle_sets(piece, like.width)
                sizes = np.diff(bounds)
                first = like.first(sizes)
                keys = [class_key(hashes[a:b]) if b > a else None for a, b in zip(bounds, bounds[1:], strict=False)]
                heads = [hashes[a : a + k].tobytes() for a, k in zip(bounds, first, strict=False)]
                owners = [int.from_bytes(key[:8], "little", signed=True) if key else None for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("text_hash"),
                        pa.array(sizes),
                        pa.array(keys, pa.binary()),
                        pa.array(owners, pa.int64()),
                        pa.array(like.needed(sizes)),
                        pa.array(heads, pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n", "class", "owner", "needed", "head"],
                )

    schema = "doc_id long, text_hash long, n long, class binary, owner long, needed long, head binary"
    return rows.mapInArrow(run, schema)


def _active(classes: DataFrame, like: Similarity, block_rows: int) -> DataFrame:
    """Classes that share enough of their first shingles with other classes; a superset of those with a link.

    Classes stand by 64 bits of their key here; a clash only makes another class active.
    """
    total = classes.agg(F.sum(F.length("head"))).first()[0] or 0
    blocks = max(1, -(-total // (8 * block_rows)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Count shared shingles in the batch; send every shingle, and the counts, to a column block.

        A row holds hashes and the classes that have them, or classes and their counts.
        """
        for batch in (piece for whole in batches for piece in in_pieces(whole, "head")):
            heads = batch.column("head").to_pylist()
            sizes = np.fromiter((len(h) // 8 for h in heads), dtype=np.int64, count=len(heads))
            hashes = np.frombuffer(b"".join(heads), dtype=U64)
            owner = np.repeat(batch.column("owner").to_numpy(), sizes)
            hashes, owner, many = _shared(hashes, owner)
            seen, counts = np.unique(owner[many], return_counts=True)
            # A shingle that several classes of the batch hold goes as two nameless ones, not once per class.
            known = np.unique(hashes[many])
            sent = np.concatenate((hashes[~many], known, known))
            names = np.concatenate((owner[~many], np.zeros(len(known), np.int64), np.ones(len(known), np.int64)))
            to = (mixed(sent) % U64(blocks)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            parts = [p for p in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(p)]
            rows = [(int(to[p[0]]), False, sent[p].tobytes(), names[p].tobytes()) for p in parts]
            if len(seen):
                rows.append((int(seen[0] % blocks), True, seen.tobytes(), counts.astype(np.int64).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row[k] for row in rows], kind)
                    for k, kind in enumerate((pa.int32(), pa.bool_(), pa.binary(), pa.binary()))
                ],
                names=["block", "counted", "left", "right"],
            )

    def count(group: pa.Table) -> pa.Table:
        left, right = [], []
        for counted, a, b in zip(*(group[name].to_pylist() for name in ("counted", "left", "right")), strict=True):
            (left if counted else right).append((a, b))
        hashes = np.frombuffer(b"".join(a for a, _ in right), dtype=U64)
        owner = np.frombuffer(b"".join(b for _, b in right), dtype=np.int64)
        hashes, owner, many = _shared(hashes, owner)
        seen, counts = np.unique(owner[many & (owner != 0) & (owner != 1)], return_counts=True)
        seen = np.concatenate([seen, *(np.frombuffer(a, dtype=np.int64) for a, _ in left)])
        counts = np.concatenate([counts, *(np.frombuffer(b, dtype=np.int64) for _, b in left)])
        return pa.table({"owner": seen, "shared": counts})

    sent = classes.select("owner", "head").mapInArrow(spread, "block int, counted boolean, left binary, right binary")
    shared = sent.groupBy("block").applyInArrow(count, "owner long, shared long")
    return shared.groupBy("owner").agg(F.sum("shared").alias("shared"))


def _shared(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, owner) pairs by hash, and whether another owner has the hash too."""
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    if not len(hashes):
        return hashes, owner, np.zeros(0, dtype=bool)
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    same = hashes[1:] == hashes[:-1]
    return hashes, owner, np.concatenate(([False], same)) | np.concatenate((same, [False]))


def _sets(rows: DataFrame, active: DataFrame, width: int, max_bits: int) -> DataFrame:
    """class, n and set (rising hashes) of the active classes, read again from ``rows``.

    A bit field of the ids to read, of ``max_bits`` at most, spares a shuffle of the texts; what it lets through beyond
    them is dropped by class afterwards. A null id has a bit too.
    """
    spark = rows.sparkSession
    bits = field_size(active.count(), max_bits)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("at")
    wanted = spark.sparkContext.broadcast(bit_field(active.select(F.col("least_id").alias("doc_id")).select(place), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bits_at(wanted.value, batch.column("at").to_numpy())))
            for piece in in_pieces(batch):
                hashes, bounds = shingle_sets(piece, width)
                keep = [(a, b) for a, b in zip(bounds, bounds[1:], strict=False) if b > a]
                values = pa.ListArray.from_arrays(
                    pa.array(np.array([0, *np.cumsum([b - a for a, b in keep])], dtype=np.int32)),
                    pa.array(hashes.view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([class_key(hashes[a:b]) for a, b in keep], pa.binary()),
                        pa.array([b - a for a, b in keep], pa.int64()),
                        values,
                    ],
                    names=["class", "n", "set"],
                )

    found = rows.select("text", place).mapInArrow(run, "class binary, n long, set array<long>")
    return stored(found.join(active.select("class"), "class", "left_semi").dropDuplicates(["class"]), "sets")


def _columns(sets: DataFrame, like: Similarity) -> DataFrame:
    """hash, class and n for each first shingle in rare-first order that classes share, and how many classes meet there."""
    cells = sets.select("class", F.explode("set").alias("hash"))
    often = cells.groupBy("hash").count().where("count > 1")
    ordered = cells.join(often, "hash").groupBy("class").agg(F.collect_list(F.struct("count", "hash")).alias("cells"))
    # Shingles of one class alone come first; what is left of the first n - ceil(0.8 n) + 1 is taken from the shared.
    least = F.floor((F.col("n") * like.percent + 99) / 100)
    left = (F.size("cells") - least + 1).cast("int").alias("left")
    chosen = sets.select("class", "n").join(ordered, "class").select("class", "n", "cells", left).where("left > 0")
    first = F.explode(F.slice(F.sort_array("cells"), F.lit(1), F.col("left"))).alias("cell")
    placed = stored(chosen.select("class", "n", first).select("class", "n", "cell.hash"), "columns")
    meet = placed.groupBy("hash").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return stored(placed.join(meet, "hash"), "meetings")


@dataclass(frozen=True)
class Blocks:
    """How the classes are dealt to products; no choice changes a result."""

    rows: int = 512  # classes of a block
    shingles: int = 1 << 20  # of all classes of a block; a class alone may have more
    crowd: int = 64  # classes that meet in a column before leaders are asked, and that ask a leader in one task
    turns: int = 8  # of leaders, at most

    def parts(self, size: Column, total: Column, rows: int | None = None) -> Column:
        """Blocks for so many classes with so many shingles."""
        return F.ceil(F.greatest(size / (rows or self.rows), total / self.shingles))


def _apart(columns: DataFrame) -> DataFrame:
    """The rows of columns in which classes of several roots meet."""
    several = columns.groupBy("hash").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    return columns.join(several.select("hash"), "hash", "left_semi")


def _to_leaders(columns: DataFrame, like: Similarity, blocks: Blocks, turn: int) -> DataFrame:
    """low, high, block, class as in ``_block_pairs``, where a block of classes meets one leader.

    The leaders of a column are the first and the last of its classes in an order that a hash and ``turn`` decide. A
    class asks the first and the last of the leaders of its columns that have another root and a size that can link, so
    near copies, which share most of their columns, ask the same ones: two rows a class, however many meet.
    """
    one = F.struct(F.xxhash64("class", F.lit(turn)).alias("at"), "class", "root", "n")
    ends = columns.groupBy("hash").agg(F.array(F.min(one), F.max(one)).alias("leaders"))
    fits = F.least("n", "leader.n") * 100 >= F.greatest("n", "leader.n") * like.percent
    asked = (
        columns.join(ends, "hash")
        .select("class", "root", "n", F.explode("leaders").alias("leader"))
        .where((F.col("leader.root") != F.col("root")) & fits)
        .groupBy("class", "n")
        .agg(F.min("leader").alias("first"), F.max("leader").alias("last"))
        .select("class", "n", F.explode(F.array_distinct(F.array("first.class", "last.class"))).alias("leader"))
    )
    asked = stored(asked, "asked")
    sizes = asked.groupBy("leader").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    part = F.pmod(F.xxhash64("class"), blocks.parts(F.col("size"), F.col("total"), blocks.crowd))
    dealt = asked.join(sizes, "leader").select("class", "leader", part.alias("part"))
    low, high = F.xxhash64("leader", "part").alias("low"), F.xxhash64("leader", "part", F.lit(1)).alias("high")
    met = dealt.select(low, high, "class", "leader")
    leaders = met.select("low", "high", F.col("high").alias("block"), F.col("leader").alias("class")).distinct()
    return met.select("low", "high", F.col("low").alias("block"), "class").unionByName(leaders)


def _contracted(
    columns: DataFrame, sets: DataFrame, like: Similarity, blocks: Blocks
) -> tuple[DataFrame, DataFrame | None]:
    """``columns`` with the root of each class, and the links (a, b) that join a class to its root, None without any.

    Crowded columns ask leaders turn by turn, until a turn leaves more than half of the rows that it found apart. What
    is apart then is multiplied block by block, so an early end loses nothing.
    """
    rooted, near, before = columns.withColumn("root", F.col("class")), None, None
    for turn in range(blocks.turns):
        crowded = stored(_apart(rooted.where(F.col("members") >= blocks.crowd)), "crowded")
        count = crowded.count()
        if not count or (before is not None and 2 * count > before):
            break
        before = count
        found = _links(_to_leaders(crowded, like, blocks, turn), sets, like)
        roots = components(found if near is None else found.unionByName(near))
        near = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        known = roots.withColumnRenamed("node", "class")
        rooted = columns.join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))
    return rooted, near


def _block_pairs(columns: DataFrame, blocks: Blocks) -> DataFrame:
    """low, high, block, class: for every two row blocks that meet in a column, themselves included, who meets there.

    A contracted group is at home where most classes meet; a home is cut into blocks, a group never, unless it is more
    than a block: then it has a home of its own. A class is in the pair of its own and another block if that one has a
    class of another root in one of its columns. A column of m classes that are all apart sends m rows to each of its
    blocks, a ``blocks.rows``-th of its pairs at most; one of a single group sends none.
    """
    columns = stored(_apart(columns), "apart")
    at = F.max(F.struct("members", "hash")).alias("at")
    classes = stored(columns.groupBy("class", "root", "n").agg(at), "classes-apart")
    size, total = F.col("size"), F.col("total")
    groups = classes.groupBy("root").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    fits = blocks.parts(size, total) <= 1
    groups = groups.withColumns(
        {
            "home": F.when(fits, F.xxhash64("at.hash")).otherwise(F.xxhash64("root", F.lit(1))),
            "whole": fits,
        }
    )
    homes = groups.groupBy("home").agg(F.sum("size").alias("size"), F.sum("total").alias("total"))
    groups = groups.select("root", "home", "whole").join(homes, "home")
    own = F.when(F.col("whole"), F.xxhash64("root")).otherwise(F.xxhash64("class"))
    block = F.xxhash64("home", F.pmod(own, blocks.parts(size, total))).alias("block")
    dealt = classes.select("class", "root").join(groups, "root").select("class", block)
    placed = columns.select("hash", "class", "root").join(stored(dealt, "homes"), "class")
    ends = placed.groupBy("hash", "block").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    others = ends.groupBy("hash").agg(F.collect_list(F.struct("block", "least", "most")).alias("others"))
    met = placed.join(others, "hash").select("class", "root", "block", F.explode("others").alias("with"))
    met = met.where((F.col("with.least") != F.col("root")) | (F.col("with.most") != F.col("root")))
    other = F.col("with.block")
    low, high = F.least("block", other).alias("low"), F.greatest("block", other).alias("high")
    return met.select(low, high, "block", "class").distinct()


def forest(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, like: Similarity) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets at ``first`` and those at ``second``; both may be the same.

    Overlaps are counted over strips of the columns that two sets share or more. After each strip, what is left of two
    sets bounds their overlap from above; the count ends when no pair can reach the threshold or all are done.
    """
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    used = often[column]
    owner, column = owner[used], (np.cumsum(often) - 1)[column[used]]
    rest = np.bincount(owner, minlength=len(sets))
    total = sizes[first][:, None] + sizes[second][None, :]
    overlap = np.zeros(total.shape, dtype=np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    columns = int(often.sum())
    strip = max(1, min(max(64, (1 << 22) // len(sets)), columns))
    for start in range(0, columns, strip):
        cells = slice(*np.searchsorted(column, (start, start + strip)))
        incidence = np.zeros((len(sets), strip), dtype=np.float32)
        incidence[owner[cells], column[cells] - start] = 1
        overlap += (incidence[first] @ incidence[second].T).astype(np.int64)
        rest = rest - np.bincount(owner[cells], minlength=len(sets))
        reach = overlap + np.minimum(rest[first][:, None], rest[second][None, :])
        if not (reach * 100 >= (total - reach) * like.percent).any():
            return []
    parent = list(range(len(sets)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    links = []
    for i, j in zip(*np.nonzero(overlap * 100 >= (total - overlap) * like.percent), strict=True):
        a, b = root(int(first[i])), root(int(second[j]))
        if a != b:
            parent[a] = b
            links.append((int(first[i]), int(second[j])))
    return links


def _links(pairs: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """Links (a, b) that connect what the products of all block pairs connect."""
    rows = pairs.join(sets.select("class", "set"), "class")
    rows = rows.repartition("low", "high").sortWithinPartitions("low", "high", "class")

    def product(low: int, high: int, group: list[tuple[int, bytes, np.ndarray]]) -> Iterator[tuple[bytes, bytes]]:
        blocks = np.array([block for block, _, _ in group])
        first, second = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
        if len(group) > 1 and len(first) and len(second):
            for a, b in forest([own for _, _, own in group], first, second, like):
                yield tuple(sorted((group[a][1], group[b][1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, group = None, []
        for batch in batches:
            found = []
            sets = batch.column("set")
            values, bounds = sets.values.to_numpy(), sets.offsets.to_numpy()
            keys = zip(*(batch.column(c).to_pylist() for c in ("low", "high", "block", "class")), strict=True)
            for k, (low, high, block, key) in enumerate(keys):
                if (low, high) != pair:
                    found.extend(product(*pair, group) if pair else ())
                    pair, group = (low, high), []
                group.append((block, key, values[bounds[k] : bounds[k + 1]].copy()))
            yield _edges(found)
        yield _edges(list(product(*pair, group)) if pair else [])

    return rows.select("low", "high", "block", "class", "set").mapInArrow(run, "a binary, b binary")


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([pair[k] for pair in found], pa.binary()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def linked(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    like: Similarity = Similarity(),
    blocks: Blocks = Blocks(),
    max_bits: int = 1 << 28,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the least id reachable by links), text_hash, and
    first_hash, the least text_hash that comes with that id.

    Words are runs of characters other than ASCII white space, with A to Z lower-cased; a set holds the distinct
    shingles of the whole text, or the whole of a shorter text as one. Null and empty texts have an empty set and are
    linked with nothing, their component_id is their own id. Documents with equal sets link. A null id takes part; it
    counts last, so a component's id is null only where all ids in it are. Repeated rows are rows of their own with
    equal results. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = keyed_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    found, active = _found_and_active(rows, like)

    def roots() -> DataFrame:
        sets = _sets(rows, active, like.width, max_bits)
        columns, near = _contracted(_columns(sets, like), sets, like, blocks)
        links = _links(_block_pairs(columns, blocks), sets, like)
        return components(links if near is None else links.unionByName(near))

    def placed() -> DataFrame:
        root = F.coalesce("root", "class").alias("root")
        row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
        known = found.where("class is not null").groupBy("class").agg(F.min(row).alias("least"))
        linked = kept(spark, "roots", roots).withColumnRenamed("node", "class")
        placed = stored(known.join(linked, "class", "left").select("class", "least", root), "placed")
        least = placed.groupBy("root").agg(F.min("least").alias("least"))
        first = [F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("first_hash")]
        return placed.drop("least").join(least, "root").select("class", *first)

    named = kept(spark, "components", placed)
    own = found.where("class is null")
    own = own.withColumns({"component_id": F.col("doc_id"), "first_hash": F.col("text_hash")})
    result = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "first_hash"]
    return found.where("class is not null").join(named, "class").select(*result).unionByName(own.select(*result))


def _found_and_active(rows: DataFrame, like: Similarity) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_hash, n and class of every row, and class and least id of every active class."""
    spark = rows.sparkSession
    small = shared_path(spark, "llm-found")

    def active() -> DataFrame:
        classes = stored(_classes(rows, like), "classes")
        classes.select("doc_id", "text_hash", "n", "class").write.parquet(small)
        classes = classes.where("class is not null")
        known = classes.groupBy("class").agg(
            F.min("doc_id").alias("least_id"), F.max("owner").alias("owner"), F.max("needed").alias("needed")
        )
        shared = _active(classes, like, 1 << 15)
        return known.join(shared, "owner").where("shared >= needed").select("class", "least_id")

    actives = kept(spark, "active", active)
    return spark.read.schema("doc_id long, text_hash long, n long, class binary").parquet(small), actives


def one_per_component(
    docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the documents that link to one that comes first. ``found`` is the result of ``linked``.

    Rows are told apart by id and text, so a row that repeats the id of another text goes or stays by its own links. A
    row goes if its component has a smaller id. Where a component has no id at all, the text with the least hash stays.
    A row without an id in a component with ids stays, and rows that share the smallest id stay together.
    """
    own_id, own_hash = unused(docs, "gone_id"), unused(docs, "gone_hash")
    other = F.col("component_id").isNull() & (F.col("text_hash") != F.col("first_hash"))
    is_gone = F.coalesce(F.col("component_id") < F.col("doc_id"), F.lit(False)) | other
    gone = found.where(is_gone).select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).distinct()
    hashed = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own_id)) & (hashed == F.col(own_hash))
    return docs.join(gone, same, "left_anti")
