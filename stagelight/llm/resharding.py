"""Minimum-cost-flow resharding: move the fewest bytes from old shards to new capacities, rewrite only what moves.

Every old shard is laid out as a line of blocks in a fixed order. A flow from old shards to new ones, cheapest where
data stay, says how many bytes of each line go where; the lines are cut there, inside a block at a document. Shard and
block totals are all that the driver sees.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stagelight.llm.common import stored, unused
from stagelight.plans.shared import shared_path

#: Bytes that a row counts besides its text.
ROW_BYTES = 8


def min_cost_flow(supplies: list[int], capacities: list[int], cost) -> dict[tuple[int, int], int]:
    """Units from each source to each target that use every supply, fit every capacity and cost least.

    ``cost(source, target)`` is the price of a unit, not negative. Successive shortest augmenting paths with potentials
    over the graph source -> target; the graph has as many nodes as there are shards.
    """
    if sum(supplies) > sum(capacities):
        raise ValueError("the capacities are smaller than the shards")
    sources, targets = len(supplies), len(capacities)
    left, room = list(supplies), list(capacities)
    flow: dict[tuple[int, int], int] = {}
    potential = [0] * (sources + targets)
    while True:
        origin = [k for k in range(sources) if left[k]]
        if not origin:
            return {pair: units for pair, units in flow.items() if units}
        distance: dict[int, int] = dict.fromkeys(origin, 0)
        parent: dict[int, int] = {}
        queue = [(0, k) for k in origin]
        done: set[int] = set()
        while queue:
            d, node = heapq.heappop(queue)
            if node in done:
                continue
            done.add(node)
            if node < sources:
                steps = ((sources + t, cost(node, t)) for t in range(targets))
            else:
                back = [s for s in range(sources) if flow.get((s, node - sources), 0)]
                steps = ((s, -cost(s, node - sources)) for s in back)
            for other, price in steps:
                reach = d + price + potential[node] - potential[other]
                if other not in distance or reach < distance[other]:
                    distance[other], parent[other] = reach, node
                    heapq.heappush(queue, (reach, other))
        ends = [t for t in range(targets) if room[t] and sources + t in distance]
        end = sources + min(ends, key=lambda t: (distance[sources + t] + potential[sources + t], t))
        far = max(distance.values())
        potential = [p + distance.get(k, far) for k, p in enumerate(potential)]
        path, node = [], end
        while node in parent:
            path.append((parent[node], node))
            node = parent[node]
        units = min(left[node], room[end - sources])
        for a, b in path:
            if a >= sources:
                units = min(units, flow[(b, a - sources)])
        for a, b in path:
            if a < sources:
                flow[(a, b - sources)] = flow.get((a, b - sources), 0) + units
            else:
                flow[(b, a - sources)] -= units
        left[node] -= units
        room[end - sources] -= units


def even(total: int, count: int) -> list[int]:
    """``total`` in ``count`` capacities that differ by one at most."""
    return [total // count + (k < total % count) for k in range(count)]


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) and of its row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def identified(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with two columns that name each row, and their names: the file that holds it and its place there.

    So rows alike in all columns are rows of their own, and every reading of the table gives a row the same name. What
    is not read from files is stored first.
    """
    file, place = unused(docs, "row_file"), unused(docs, "row_place")
    named = {file: F.col("_metadata.file_path"), place: F.col("_metadata.row_index")}
    try:
        return docs.withColumns(named), [file, place]
    except AnalysisException:  # no files, or not only files, below
        return stored(docs, "identified").withColumns(named), [file, place]


@dataclass(frozen=True)
class Plan:
    """``docs``: the rows with names. ``moves``: bytes by (old shard, new shard). ``runs``: first and last block of a line
    that go to a new shard whole, as (old, first, last, new). ``parted``: the new shard of each row of the other blocks,
    of which there is one for each cut. ``old`` and ``block`` derive a row's place."""

    docs: DataFrame
    names: list[str]
    moves: dict[tuple[int, int], int]
    runs: list[tuple[int, int, int, int]]
    parted: DataFrame
    old: Column
    block: Column

    def assigned(self, shard_col: str) -> tuple[DataFrame, str]:
        """The rows with the new shard in ``shard_col`` and the old one in a further column, whose name is returned.

        Runs are a condition on the block number. Only rows of blocks that a cut parts are joined, by their names.
        """
        old, block, p_file, p_place, p_shard = (
            unused(self.docs, f"{shard_col}_{n}") for n in ("old", "block", "p_file", "p_place", "p_shard")
        )
        placed = self.docs.withColumns({old: self.old, block: self.block})
        target = F.lit(None).cast("int")
        for number, first, last, new in self.runs:
            inside = (F.col(old) == number) & F.col(block).between(first, last)
            target = F.when(inside, F.lit(new)).otherwise(target)
        placed = placed.withColumn(shard_col, target.cast("int"))
        file, place = self.names
        own = [F.col(f"`{c}`") for c in self.docs.columns if c not in self.names] + [F.col(old)]
        parted = self.parted.select(
            F.col("file").alias(p_file), F.col("place").alias(p_place), F.col("shard").alias(p_shard)
        )
        same = (F.col(file) == F.col(p_file)) & (F.col(place) == F.col(p_place))
        split = placed.where(F.col(shard_col).isNull()).join(parted, same)
        kept = placed.where(F.col(shard_col).isNotNull()).select(*own, shard_col)
        return kept.unionByName(split.select(*own, F.col(p_shard).alias(shard_col))), old


def planned(
    docs: DataFrame,
    old_shard: Column,
    capacities: list[int] | int,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int = 0,
) -> Plan:
    """Give every row of ``docs`` a new shard, moving as few bytes as the capacities allow.

    ``old_shard`` is an expression over ``docs`` with numbers from 0; null counts as 0. ``capacities`` are the bytes of
    the new shards, or their count for even ones; new shard k is the place of old shard k. A shard's size misses its
    capacity by less than one row for each cut of a line, of which there are fewer than old and new shards together.
    Null texts have no bytes but those of the row. Rows alike in id and text are rows of their own (``identified``), so
    any number of them is dealt to as many shards as it needs. An empty table gives an empty plan; other columns are
    not read.

    Rows fall into ``blocks`` blocks per old shard by a hash of their names; 0 stands for a block per 50,000 rows of the
    table, 512 at least. A hot old shard has as many blocks as any other, and the capacities cut it into many new ones.
    """
    docs, names = identified(docs)
    blocks = blocks or max(512, docs.count() // 50_000)
    old = F.coalesce(old_shard.cast("int"), F.lit(0))
    block = F.pmod(F.xxhash64(*names), F.lit(blocks)).cast("int")
    size = text_bytes(F.col(f"`{text_col}`").cast("string"))
    identity = F.col(f"`{id_col}`").cast("long").alias("doc_id")
    rows = docs.select(
        *(F.col(n).alias(own) for n, own in zip(names, ("file", "place"))), identity, old.alias("old_shard"),
        block.alias("block"), size.alias("size"),
    )
    lines = stored(rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes")), "lines")
    totals = dict(map(tuple, lines.groupBy("old_shard").agg(F.sum("bytes")).collect()))  # a row per old shard
    supplies = [totals.get(k, 0) for k in range(max(totals, default=-1) + 1)]
    room = even(sum(supplies), capacities) if isinstance(capacities, int) else capacities
    moves = min_cost_flow(supplies, room, lambda old, new: 0 if old == new else 1)
    cuts = _cuts(moves)
    # Where a block begins on its line: a running sum over the blocks of a shard.
    line = W.partitionBy("old_shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    begins = lines.withColumn("begin", F.coalesce(F.sum("bytes").over(line), F.lit(0)))
    first, last = _target(F.col("begin"), cuts), _target(F.col("begin") + F.col("bytes") - 1, cuts)
    begins = stored(begins.withColumn("shard", F.when(first == last, first)), "blocks")
    runs = begins.where("shard is not null").groupBy("old_shard", "shard").agg(F.min("block"), F.max("block"))
    runs = [(old, low, high, new) for old, new, low, high in map(tuple, runs.collect())]  # a row per part of a line
    cut = [tuple(r) for r in begins.where("shard is null").select("old_shard", "block", "begin").collect()]  # one a cut
    begin = F.lit(None).cast("long")
    for old_number, number, at in cut:
        begin = F.when((F.col("old_shard") == old_number) & (F.col("block") == number), F.lit(at)).otherwise(begin)
    inside = W.partitionBy("old_shard", "block").orderBy(F.desc("size"), "doc_id", "file", "place")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parted = rows.withColumn("begin", begin.cast("long")).where("begin is not null").withColumn("before", before)
    middle = F.col("begin") + F.col("before") + F.floor(F.col("size") / 2)
    parted = stored(parted.select("file", "place", _target(middle, cuts).alias("shard")), "parted")
    return Plan(docs, names, moves, runs, parted, old, block)


def _cuts(moves: dict[tuple[int, int], int]) -> dict[int, list[tuple[int, int]]]:
    """Per old shard the new shards of its line in order, each with the byte where its part ends. What stays is first."""
    cuts: dict[int, list[tuple[int, int]]] = {}
    for (old, new), units in sorted(moves.items(), key=lambda m: (m[0][0], m[0][0] != m[0][1], m[0][1])):
        begun = cuts.setdefault(old, [])
        begun.append((new, (begun[-1][1] if begun else 0) + units))
    return cuts


def _target(place: Column, cuts: dict[int, list[tuple[int, int]]]) -> Column:
    """The new shard of a place on a line."""
    target = F.lit(None).cast("int")
    for old, parts in cuts.items():
        part = F.lit(parts[-1][0])
        for new, end in reversed(parts[:-1]):
            part = F.when(place < end, F.lit(new)).otherwise(part)
        target = F.when(F.col("old_shard") == old, part).otherwise(target)
    return target.cast("int")


def rewritten(docs: DataFrame, plan: Plan, shard_col: str = "shard") -> DataFrame:
    """All rows of ``docs``, which the plan is for, with their new shard; the rows that move come from files rewritten by
    new shard.

    Rows that keep their shard are read where they are. The others are written to the shared folder, a folder per new
    shard. The new column is ``shard_col``, or as ``unused`` names it; all other columns stay.
    """
    shard = unused(docs, shard_col)
    placed, old = plan.assigned(shard)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    path = shared_path(docs.sparkSession, "llm-shards")
    moved = placed.where(F.col(shard) != F.col(old)).select(*columns, shard)
    moved.write.partitionBy(shard).parquet(path)
    again = docs.sparkSession.read.schema(moved.schema).parquet(path)
    return placed.where(F.col(shard) == F.col(old)).select(*columns, shard).unionByName(again)


def with_slots(rows: DataFrame, key_cols: list[str], shard_col: str = "shard", blocks: int = 0) -> DataFrame:
    """``rows`` with a column slot: gapless numbers from 0 within each shard, by block and then by ``key_cols``.

    No task holds a shard: rows are numbered within blocks, and blocks start at the sum of those before them. A block is
    chosen by a hash of a row's name (``identified``), so any number of rows alike in all ``key_cols`` is spread; they
    are numbered in the order of the file. 0 blocks stand for one per 50,000 rows of the table, 16 at least.
    """
    columns = rows.columns
    rows, names = identified(rows)
    blocks = blocks or max(16, rows.count() // 50_000)
    piece = [shard_col, "block"]
    rows = rows.withColumn("block", F.pmod(F.xxhash64(names[1], *key_cols), F.lit(blocks)))
    counts = stored(rows.groupBy(*piece).agg(F.count(F.lit(1)).alias("rows")), "counts")  # shards x blocks rows
    order = W.partitionBy(shard_col).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("rows").over(order), F.lit(0))).drop("rows")
    nth = F.row_number().over(W.partitionBy(*piece).orderBy(*key_cols, *names)) - 1
    numbered = rows.withColumn("nth", nth).join(starts, piece)
    return numbered.select(*columns, (F.col("start") + F.col("nth")).cast("long").alias("slot"))
