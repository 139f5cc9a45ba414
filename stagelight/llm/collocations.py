"""Phrase collocation mining with stripes.

A stripe is a counter of the next words of one prefix. Tasks count stripes in blocks of text; stripes of one prefix are
merged word by word. The merged stripes hold the frequency of every phrase of two words or more under its prefix and
last word, and the stripes of the empty prefix those of single words. From this one structure come extensions, the
totals that a phrase is scored against, and the highest frequency of a longer phrase around it.

Stripes are built by length. A phrase can only be frequent if the phrases it begins and ends with are, so a length is
counted where a bit field of the length before admits both; false positives cost space and change no count. A prefix
that holds a large part of all words has its stripes split by the next word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stagelight.llm.common import bit_field, bits_at, field_size, in_pieces, ship, stored
from stagelight.llm.text_arrays import GOLDEN, IS_SPACE, LOWER, MIX_1, U64, Block, mixed

#: What parts pieces, and what parts words in them.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[list(BREAKS)] = True
IS_GAP = IS_BREAK.copy()
IS_GAP[[0x20, 0x09]] = True
#: Bytes of text that are counted together.
BLOCK = 8 << 20
#: A prefix with one in so many of all words is split, into as many stripes as SLICES says.
HEAVY, SLICES = 1024, 64
#: Stripes the empty prefix of a language is split into.
WORD_SLICES = 512
STRIPES = "lang string, prefix string, slice int, nexts array<string>, counts array<long>"
MERGED = "lang string, phrase string, a long, mark long"


class Admitted(NamedTuple):
    """Phrases of the length before that are frequent, as bits, and the marks of those with very many words."""

    field: np.ndarray
    heavy: np.ndarray

    def admits(self, marks: np.ndarray) -> np.ndarray:
        return bits_at(self.field, (marks & U64(8 * len(self.field) - 1)).astype(np.int64))


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A hash per string of an array without nulls."""
    buffer, offsets = _bytes_of(words)
    return Block([buffer]).span_hashes(offsets[:-1], offsets[1:], lower=False)


def _bytes_of(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of all strings in a row, and their offsets."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (data.to_pybytes() if data else b"")[offsets[0] : offsets[-1]], offsets - offsets[0]


def _placed(hashes: np.ndarray, place: int | np.ndarray) -> np.ndarray:
    """The share of a word in its phrase's mark, by its place; shares are added."""
    return mixed(hashes + np.asarray(place, dtype=U64) * GOLDEN)


def _phrase_marks(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """The mark of each phrase, the same as a block finds word by word."""
    buffer, offsets = _bytes_of(phrases)
    block = Block([buffer])
    text = block.buffer[:-1]
    ends = np.zeros(len(text), dtype=bool)
    ends[offsets[1:] - 1] = True
    after = np.flatnonzero((text == 0x20) | ends)
    starts = np.append(0, after[:-1] + 1)
    is_last = ends[after]
    hashes = block.span_hashes(starts, after + is_last, lower=False)
    firsts = np.flatnonzero(np.append(True, is_last[:-1]))
    sizes = np.diff(np.append(firsts, len(starts)))
    shares = _placed(hashes, np.arange(len(starts)) - np.repeat(firsts, sizes))
    coded = langs.dictionary_encode()
    return mixed(np.add.reduceat(shares, firsts) + _word_hashes(coded.dictionary)[coded.indices.to_numpy()] * MIX_1)


class Words:
    """The words of texts laid end to end, each with a space after it."""

    def __init__(self, text: np.ndarray):
        gap = IS_GAP[text]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
        starts, ends = edges[0::2], edges[1::2]
        keep = ~gap
        keep[ends] = True
        spaced = text.copy()
        spaced[ends] = 0x20
        self.text = LOWER[spaced[keep]]
        self.at = starts
        self.piece = np.cumsum(IS_BREAK[text])[starts]
        self.offsets = np.append(0, np.cumsum(ends - starts + 1))
        strings = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(self.offsets), pa.py_buffer(self.text))
        coded = strings.dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.names = pc.utf8_rtrim(coded.dictionary, characters=" ")
        self.hashes = _word_hashes(self.names)

    def phrases(self, starts: np.ndarray, length: int) -> pa.Array:
        """The phrases of ``length`` words that begin at the given words."""
        sizes = self.offsets[starts + length] - self.offsets[starts] - 1 if length else np.zeros(len(starts), np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        taken = self.text[np.arange(total) + np.repeat(self.offsets[starts] - ends + sizes, sizes)]
        offsets = np.append(0, ends)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(taken))


def windows(text: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Parts of about ``limit`` bytes that end after a break; longer only where there is none. The last byte is one."""
    breaks = np.flatnonzero(IS_BREAK[text]) + 1
    start = 0
    while start < len(text):
        k = np.searchsorted(breaks, start + limit, side="right") - 1
        end = int(breaks[k]) if k >= 0 and breaks[k] > start else int(breaks[k + 1])
        yield start, end
        start = end


def block_stripes(words: Words, langs: np.ndarray, lang_hashes: np.ndarray, length: int, admitted: Admitted | None):
    """Stripes of one block for phrases of ``length`` words: language, prefix, slice, next words and counts.

    ``langs`` holds the language of every word.
    """
    count = len(words.codes) - length + 1
    starts = np.arange(max(count, 0))
    starts = starts[words.piece[starts] == words.piece[starts + length - 1]]
    marks = np.zeros(0, dtype=U64)
    if admitted is not None:
        runs = max(0, len(words.codes) - length + 2)
        sums = lang_hashes[langs[:runs]] * MIX_1
        for place in range(length - 1):
            sums = sums + _placed(words.hashes, place)[words.codes[place : place + runs]]
        marks = mixed(sums)
        fits = admitted.admits(marks)
        starts = starts[fits[starts] & fits[starts + 1]]
    size = len(words.names)
    prefix = langs[starts]
    for place in range(length - 1):
        prefix = np.unique(prefix * size + words.codes[starts + place], return_inverse=True)[1].reshape(-1)
    _, first, counts = np.unique(
        prefix * size + words.codes[starts + length - 1], return_index=True, return_counts=True
    )
    prefix, starts = prefix[first], starts[first]
    nexts = words.codes[starts + length - 1]
    heavy = np.ones(len(starts), dtype=bool) if admitted is None else np.isin(marks[starts], admitted.heavy)
    slices = np.where(heavy, words.hashes[nexts] % U64(WORD_SLICES if admitted is None else SLICES), U64(0)).astype(int)
    order = np.lexsort((slices, prefix))
    prefix, starts, nexts, slices, counts = (x[order] for x in (prefix, starts, nexts, slices, counts))
    edges = np.flatnonzero(np.diff(prefix, prepend=-1) | np.diff(slices, prepend=-1))
    bounds = pa.array(np.append(edges, len(prefix)), pa.int32())
    return (
        langs[starts[edges]],
        words.phrases(starts[edges], length - 1).cast(pa.string()),
        pa.array(slices[edges], pa.int32()),
        pa.ListArray.from_arrays(bounds, words.names.take(pa.array(nexts)).cast(pa.string())),
        pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int64())),
    )


def _stripes(docs: DataFrame, length: int, admitted: Broadcast | None) -> DataFrame:
    """Stripes of all blocks; ``docs`` has text and lang, neither null."""
    names = [part.split()[0] for part in STRIPES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = admitted.value if admitted else None
        for batch in batches:
            for piece in in_pieces(batch, limit=BLOCK):
                block = Block([text.encode() for text in piece.column("text").to_pylist()])
                coded = piece.column("lang").dictionary_encode()
                hashes, codes = _word_hashes(coded.dictionary), coded.indices.to_numpy().astype(np.int64)
                for start, end in windows(block.buffer, BLOCK):
                    words = Words(block.buffer[start:end])
                    langs = codes[np.searchsorted(block.ends, words.at + start)]
                    own, *columns = block_stripes(words, langs, hashes, length, known)
                    lang = coded.dictionary.take(pa.array(own)).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([lang, *columns], names=names)

    return docs.mapInArrow(run, STRIPES)


def merge_stripes(table: pa.Table, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Stripes sorted by key, added word by word: language, phrase and frequency of what has ``least`` or more.

    A row without a phrase holds the total of a language's words, from the stripes of the empty prefix.
    """
    lang, prefix, slices, nexts, counts = (table.column(k).combine_chunks() for k in range(5))
    codes = [x.dictionary_encode().indices.to_numpy() for x in (lang, prefix)]
    changed = np.diff(codes[0], prepend=-1) | np.diff(codes[1], prepend=-1) | np.diff(slices.to_numpy(), prepend=-1)
    key = np.cumsum(changed != 0) - 1
    rows = np.repeat(np.arange(len(table)), nexts.value_lengths().to_numpy())
    words = nexts.flatten().dictionary_encode()
    size = max(1, len(words.dictionary))
    pairs, first, place = np.unique(
        key[rows] * size + words.indices.to_numpy(), return_index=True, return_inverse=True
    )
    sums = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(sums, place.reshape(-1), counts.flatten().to_numpy())
    often = np.flatnonzero(sums >= least)
    at = pa.array(rows[first[often]])
    ends = words.dictionary.take(pa.array(pairs[often] % size))
    begins = prefix.take(at)
    phrases = pc.if_else(pc.equal(begins, ""), ends, pc.binary_join_element_wise(begins, ends, " "))
    whole = np.zeros(int(key[-1]) + 1, dtype=np.int64)
    np.add.at(whole, key[rows[first]], sums)
    empty = np.flatnonzero((np.diff(key, prepend=-1) != 0) & pc.equal(prefix, "").to_numpy(zero_copy_only=False))
    return (
        pa.concat_arrays([lang.take(at), lang.take(pa.array(empty))]),
        pa.concat_arrays([phrases, pa.nulls(len(empty), pa.string())]),
        pa.array(np.concatenate((sums[often], whole[key[empty]]))),
    )


def _one_stripe(table: pa.Table) -> pa.Table:
    """Stripes of one key as a single one."""
    if len(table) == 1:
        return table
    nexts, counts = (table.column(k).combine_chunks() for k in (3, 4))
    words = nexts.flatten().dictionary_encode()
    sums = np.zeros(len(words.dictionary), dtype=np.int64)
    np.add.at(sums, words.indices.to_numpy(), counts.flatten().to_numpy())
    bounds = pa.array([0, len(sums)], pa.int32())
    columns = [table.column(k).slice(0, 1).combine_chunks() for k in range(3)]
    columns += [pa.ListArray.from_arrays(bounds, x) for x in (words.dictionary, pa.array(sums))]
    return pa.Table.from_arrays(columns, schema=table.schema)


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """Frequent phrases with their frequency and mark, and totals of languages under a null phrase.

    Stripes are dealt by prefix and slice and merged from a sorted stream, so a task holds a batch and one stripe.
    """

    def rows(table: pa.Table) -> pa.RecordBatch:
        lang, phrase, a = merge_stripes(table, least)
        marks = np.zeros(len(a), dtype=U64)
        known = len(a) - phrase.null_count
        if known:
            marks[:known] = _phrase_marks(lang.slice(0, known), phrase.slice(0, known))
        return pa.RecordBatch.from_arrays([lang, phrase, a, pa.array(marks.view(np.int64))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([pending, table]) if pending is not None else table
            same = [pc.equal(table.column(k), table.column(k)[-1]) for k in range(3)]
            start = pc.index(pc.and_(pc.and_(*same[:2]), same[2]), True).as_py()
            if start:
                yield rows(table.slice(0, start))
            pending = _one_stripe(table.slice(start))  # its other stripes may be in the next batch
        if pending is not None:
            yield rows(pending)

    names = [part.split()[0] for part in MERGED.split(", ")]
    keys = ["lang", "prefix", "slice"]
    return stripes.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, MERGED)


def phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    longest: int = 4,
    max_bits: int = 1 << 28,
) -> tuple[DataFrame, DataFrame]:
    """Every phrase of one to ``longest`` words that occurs ``least`` times or more in its language, and totals.

    The first table has lang, phrase, words and a (its frequency), the second lang and n (all words). Both are stored.
    A null language is ``und``. Per length the texts are read once. A bit field of ``max_bits`` at most, sixteen for
    each frequent phrase, says what may be frequent one word further; beyond its size it admits more and the counts stay
    exact.
    """
    spark = docs.sparkSession
    ship(spark)
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang"))
    texts = texts.where(F.length("text") > 0)
    levels: list[DataFrame] = []
    totals, admitted = None, None
    for length in range(1, longest + 1):
        found = stored(_merged(_stripes(texts, length, admitted), least), f"phrases{length}")
        known = found.where(F.col("phrase").isNotNull())
        levels.append(known.select("lang", "phrase", F.lit(length).alias("words"), "a"))
        if totals is None:
            totals = found.where(F.col("phrase").isNull()).groupBy("lang").agg(F.sum("a").alias("n"))
        if length < longest:
            admitted = spark.sparkContext.broadcast(_admitted(known, totals, max_bits))
    return _union(levels), totals


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _admitted(known: DataFrame, totals: DataFrame, max_bits: int) -> Admitted:
    """What the next length admits. At most HEAVY phrases of one length can hold 1 / HEAVY of all words."""
    all_words = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = field_size(known.count(), max_bits)
    field = bit_field(known.select(F.col("mark").bitwiseAND(F.lit(bits - 1)).alias("at")), bits)
    heavy = known.where(F.col("a") >= all_words / HEAVY).select("mark").collect()
    return Admitted(field, np.array([row["mark"] for row in heavy], dtype=np.int64).view(U64))


def _exact(number: Column | str) -> Column:
    """Whole numbers in 38 digits: products may pass 64 bits."""
    return (F.col(number) if isinstance(number, str) else number).cast("decimal(19,0)")


def _first_of(words: str, start: str, count: str) -> Column:
    return F.expr(f"array_join(slice({words}, {start}, {count}), ' ')")


def scored(found: DataFrame) -> DataFrame:
    """Phrases of two words or more, each at its weakest cut: lang, phrase, words, a, l, r, score.

    Cut after its first k words, a phrase scores floor(2000000 * a / (l + r)) with the frequencies l and r of both
    parts; the lowest score counts, then the smallest k.
    """
    parts = found.where("words > 1").select("lang", "phrase", "words", "a", F.split("phrase", " ").alias("all"))
    parts = parts.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    parts = parts.select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        _first_of("all", "1", "k").alias("begin"),
        _first_of("all", "k + 1", "words - k").alias("rest"),
    )
    for part, name in (("begin", "l"), ("rest", "r")):
        parts = parts.join(found.select("lang", F.col("phrase").alias(part), F.col("a").alias(name)), ["lang", part])
    score = F.expr(
        "(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div"
        " (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    )
    cuts = parts.select("lang", "phrase", "words", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    weakest = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min("cut").alias("cut"))
    return weakest.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def subsumed(found: DataFrame, share: int = 80) -> DataFrame:
    """Language and phrase of what stands inside a longer phrase that occurs ``share`` per cent as often or more."""
    longer = found.where("words > 2").select("lang", "words", "a", F.split("phrase", " ").alias("all"))
    longer = longer.withColumn("count", F.explode(F.expr("sequence(2, words - 1)")))
    longer = longer.withColumn("start", F.explode(F.expr("sequence(1, words - count + 1)")))
    inside = longer.select("lang", _first_of("all", "start", "count").alias("phrase"), F.col("a").alias("around"))
    highest = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    both = highest.join(found.select("lang", "phrase", "a"), ["lang", "phrase"])
    return both.where(100 * _exact("around") >= share * _exact("a")).select("lang", "phrase")


def mined(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    longest: int = 4,
    share: int = 80,
    top: int = 2000,
    max_bits: int = 1 << 28,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates have two to ``longest`` words and occur ``least`` times or more in pieces of the texts, overlaps
    included; those that a longer one subsumes are left out. Order: score and a from high to low, then the phrase by its
    bytes. A null language is ``und``; null and empty texts have no words; every row counts, repeated ones too; an
    empty table gives no rows. Texts of any length are read whole, in windows that end between pieces; memory grows
    with the longest piece. Other columns are not read.

    The ranks of a language are taken among the best of sixteen parts of it, so no task sorts a whole language.
    """
    found, totals = phrases(docs, text_col, lang_col, least, longest, max_bits)
    kept = scored(found).join(subsumed(found, share), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(16)).alias("part")
    best = kept.select("*", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
